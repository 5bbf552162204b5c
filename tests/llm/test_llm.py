"""The training-data operators against brute force, round trips and held-out labels, with odd rows."""

import hashlib
import itertools
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from bibspark.llm import ann, bpe, chat, counts, lexicon, licenses, mixing, ngram_join, quality, queries, shared, toxicity, vector_dedup

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "text string, doc_id long, extra int, n int, row string, size string"  # extra columns, some with names used inside


def docs_of(spark, texts, ids=None):
    ids = range(1, len(texts) + 1) if ids is None else ids
    return spark.createDataFrame([(t, i, 1, 2, "r", "s") for t, i in zip(texts, ids, strict=True)], DOC)


def rows(df):
    return [tuple(r) for r in df.collect()]


def prose(rng, n, kinds=400):
    return " ".join(f"w{rng.randrange(kinds)}" for _ in range(n))


# 1: n-gram join

def word_sets(texts, k):
    out = []
    for t in texts:
        ws = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append({tuple(ws[i:i + k]) for i in range(max(1, len(ws) - k + 1))} if ws else set())
    return out


def brute_components(ids, sets, percent):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * len(sets[i] | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, d in enumerate(ids):
        r = find(i)
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return [(d, len(s), least.get(find(i)) if s else d) for i, (d, s) in enumerate(zip(ids, sets, strict=True))]


@pytest.mark.parametrize("k,percent", [(4, 85), (5, 80)])
def test_ngram_components(spark, k, percent):
    rng = random.Random(k)
    texts = [None, "", "  \n", "A b", "a  B", "one", "x y z", "x y z", prose(rng, 20_000)]
    common = prose(rng, 60)
    for _ in range(12):  # chains and stars of near copies, with a passage in all of them
        base = prose(rng, rng.randrange(8, 160)).split() + common.split() * rng.randrange(2)
        for _ in range(rng.randrange(1, 9)):
            own = list(base)
            for _ in range(rng.randrange(0, 4)):
                own[rng.randrange(len(own))] = f"x{rng.random()}"
            texts.append(" ".join(own[rng.randrange(2):]))
    texts += [texts[-1]] * 5
    ids = [1000 - 7 * i for i in range(len(texts))]
    ids[-1], ids[-2] = None, ids[-3]
    got = rows(ngram_join.ngram_components(docs_of(spark, texts, ids), k, percent).select("doc_id", "n_shingles", "component_id"))
    assert Counter(got) == Counter(brute_components(ids, word_sets(texts, k), percent))


def test_ngram_components_empty_and_all_alone(spark):
    assert rows(ngram_join.ngram_components(docs_of(spark, []))) == []
    assert sorted(rows(ngram_join.ngram_components(docs_of(spark, ["a b c d", "e f g h"])))) == [(1, 1, 1), (2, 1, 2)]


def test_components_of_a_long_path_and_a_star(spark):
    rng = random.Random(5)
    names = list(range(3000))
    rng.shuffle(names)
    edges = [(names[i], names[i + 1]) for i in range(1499)] + [(2 * 10**6, 2 * 10**6 + i) for i in range(1, 500)] + [(7, 7)]
    rng.shuffle(edges)
    got = dict(rows(shared.components(spark.createDataFrame(edges, "x long, y long").repartition(9), "x", "y")))
    low = min(names[:1500])
    assert all(got[n] == low for n in names[:1500])
    assert all(got[2 * 10**6 + i] == 2 * 10**6 for i in range(500)) and len(got) == 2000


def test_components_end_when_partitions_are_contracted_in_pieces(spark, monkeypatch):
    rng = random.Random(6)
    edges = [(10 * i + j, 10 * i + j + 1) for i in range(400) for j in range(rng.randint(1, 6))]
    rng.shuffle(edges)
    rounds, kept = [], shared.keep

    def keep(df, name):
        rounds.append(name)
        assert len(rounds) <= 12, "components() does not end"
        return kept(df, name)

    monkeypatch.setattr(shared, "keep", keep)
    before = {k: spark.conf.get(k) for k in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 16)
        spark.conf.set("spark.sql.shuffle.partitions", 2)
        got = dict(rows(shared.components(spark.createDataFrame(edges, "x long, y long").repartition(3), "x", "y", most=50)))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    u, v = shared.forest(*np.array(edges).T)
    assert got == {**{int(b): int(b) for b in v}, **dict(zip(u.tolist(), v.tolist(), strict=True))}


# 2 and 9: classifiers

def judged(spark, module, label, folds, fold):
    out = queries.QUERIES["op2_quality_classifier" if module is quality else "op9_toxicity"](spark, "/root/testdata/sf0.01").toPandas()
    known = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas().set_index("doc_id")[label].to_dict()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % folds == fold for i in out.doc_id]).all()
    assert out.score.between(0, 1).all() and (out.predicted == (out.score >= 0.3)).all() and len(out) == 1000
    held = out[out.held_out & out.doc_id.isin(known)]
    return np.mean([known[i] == p for i, p in zip(held.doc_id, held.predicted, strict=True)])


def test_quality_held_out(spark):
    assert judged(spark, quality, "quality", 5, 0) >= 0.95


def test_toxicity_held_out(spark):
    assert judged(spark, toxicity, "toxic", 4, 2) >= 0.93


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifiers_take_odd_rows(spark, module):
    texts = [None, "", " \n", "You idiot.", "x" * 100_000, "good words here"] * 2
    docs = docs_of(spark, texts, [1, 2, 3, 4, 5, 6, None, 2, 3, 4, 5, 6])
    for labels in ([], [(1, 1)], [(1, 0), (4, 1), (4, 0), (99, 1), (None, 1), (5, None), (6, 7)]):
        score = module.scorer(docs, spark.createDataFrame(labels, "doc_id long, label int"))
        got = [r[0] for r in docs.select(score("text")).collect()]
        assert len(got) == 12 and all(0 <= s <= 1 for s in got) and got[:6] == got[6:]
        assert got[0] == got[1] == got[2]
    empty = docs_of(spark, [])
    assert empty.select(module.scorer(empty, spark.createDataFrame([], "doc_id long, label int"))("text")).collect() == []


def test_exact_neighbours(spark):
    """The votes are those of the exact cosine of every labelled vector."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    model = quality.fit(docs, labels)
    import pyarrow as pa

    texts = [r["text"] for r in docs.limit(40).collect()]
    for t, got in zip(texts, model.scores(pa.array(texts)), strict=True):
        (_, f, c), = quality.features(pa.array([t]))
        z = quality.weigh(f, c, model.idf) @ model.axes[f]
        cos = model.vectors @ (z / np.linalg.norm(z))
        top = np.argsort(-cos, kind="stable")[: quality.NEIGHBOURS]
        w = cos[top].clip(0) ** quality.POWER * model.votes[top]
        assert abs((w * model.good[top]).sum() / w.sum() - got) < 1e-6


@pytest.mark.parametrize("text,kind", [
    ("What an idiot", toxicity.INSULT), ("You idiot", toxicity.DIRECTED), ("Idiot are you", toxicity.POINTED), ("She is not stupid", toxicity.NEGATED),
    ("Someone wrote that all is trash", toxicity.REPORTED), ("I will kill you", toxicity.MENACE)])
def test_grammar(text, kind):
    import pyarrow as pa

    got = toxicity.Model([], toxicity.PRIOR, toxicity.BASE).kinds(pa.array([text, "Killing time. You said nothing.", None]))
    assert got[0][toxicity.KINDS.index(kind)] == 1 and not got[1:].any()
    # clauses end what a word reaches
    assert not toxicity.Model([], toxicity.PRIOR, toxicity.BASE).kinds(pa.array(["I kill. You"]))[0].any()


def test_composition_is_one_after_the_other():
    machines = [toxicity.negation(), toxicity.report(), toxicity.target(), toxicity.threat()]
    nxt, out = toxicity.grammar()
    rng = random.Random(3)
    for _ in range(300):
        word = [rng.randrange(6) for _ in range(12)]
        expect = word
        for m in machines:
            state, line = 0, []
            for x in expect:
                state, y = m[state, x]
                line.append(y)
            expect = line
        state, got = 0, []
        for x in word:
            got.append(out[state][x])
            state = nxt[state][x]
        assert got == expect


# 3 and 4: vectors

def vectors(spark, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((400, 16))
    near = x[0] + 0.05 * rng.standard_normal((150, 16))
    edge = x[1] + 0.42 * rng.standard_normal((100, 16))
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0] * 3]
    all_ = [*x.tolist(), *near.tolist(), *edge.tolist(), *[x[5].tolist()] * 40, (x[6] * 1e150).tolist(), (x[6] * 1e-150).tolist(), *odd]
    df = spark.createDataFrame([(i, v, 1, "k") for i, v in enumerate(all_)], "vec_id long, embedding array<double>, node int, key string")
    return df, all_, len(odd)


def test_near_duplicates(spark):
    df, x, odd = vectors(spark)
    got = {r["vec_id"]: r for r in vector_dedup.near_duplicates(df, block=32).collect()}
    a = np.array(x[: len(x) - odd])
    a = a / np.abs(a).max(1, keepdims=True)
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    hit = a @ a.T >= 0.9
    np.fill_diagonal(hit, False)
    u, v = np.nonzero(hit)
    root = dict(zip(*(z.tolist() for z in shared.forest(u, v)), strict=True))
    links = [got[i]["n_links"] for i in range(len(a))]
    assert np.array_equal(links, hit.sum(1))  # here every link lies in a component that the passes find
    assert all(got[i]["component_id"] == root.get(i, i) and got[i]["kept"] == (root.get(i, i) == i) for i in range(len(a)))
    assert all((got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True) for i in range(len(a), len(x)))
    assert rows(vector_dedup.near_duplicates(df.limit(0))) == []


def lone_pairs(n, cosine, common, seed=2, dim=64):
    """n unit vectors of evenly spread directions and a common one: every tenth has a partner of this cosine."""
    rng = np.random.default_rng(seed)
    x = vector_dedup.unit(rng.standard_normal((n, dim)) + common * np.sqrt(dim) * np.eye(dim)[0])
    a = x[: n // 10]
    side = rng.standard_normal(a.shape)
    side = vector_dedup.unit(side - (side * a).sum(1, keepdims=True) * a)
    x[n // 10 : 2 * (n // 10)] = (cosine + 1e-9) * a + np.sqrt(1 - (cosine + 1e-9) ** 2) * side
    return x


@pytest.mark.parametrize("common", [0.0, 1.0])
def test_passes_find_lone_pairs(spark, common):
    n = 12_000
    x = lone_pairs(n, 0.9, common)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = dict(vector_dedup.near_duplicates(df, window=4).select("vec_id", "component_id").collect())
    found = sum(got[i + n // 10] == got[i] for i in range(n // 10))
    assert found >= 0.995 * (n // 10)


def test_links_over_partition_edges(spark):
    rng = np.random.default_rng(3)
    x = np.repeat(rng.standard_normal((30, 8)), 4, axis=0) + 0.01 * rng.standard_normal((120, 8))
    line = spark.createDataFrame([(i // 60, i, v) for i, v in enumerate(x.tolist())], "pass int, node long, embedding array<double>")
    a = vector_dedup.unit(x)
    u, v = np.nonzero(np.tril(a @ a.T >= 0.9, -1))
    near = (u - v <= 7) & (u // 60 == v // 60)
    expect = shared.forest(u[near], v[near])
    for parts in (1, 11, 50):  # down to partitions smaller than a window
        cut = line.repartitionByRange(parts, "node").sortWithinPartitions("node")
        got = np.array(rows(vector_dedup.window_links(cut, 7, 0.9)))
        assert all(np.array_equal(p, q) for p, q in zip(shared.forest(got[:, 0], got[:, 1]), expect, strict=True))


def test_nearest_neighbours(spark):
    df, x, odd = vectors(spark, 1)
    n = len(x) - odd - 2  # without the two huge and tiny ones
    df = df.where(f"vec_id < {n} OR vec_id >= {n + 2}")
    full = ann.nearest_neighbours(df, F.col("vec_id") % 10 == 0, k=10, share=1.0, chunk=50).toPandas()
    a = np.array(x[:n])
    for q in range(0, n, 10):
        d = np.sqrt(((a - a[q]) ** 2).sum(1))
        d[q] = np.inf
        own = full[full.query_id == q].sort_values("rank")
        assert own.vec_id.tolist() == np.lexsort((np.arange(n), d))[:10].tolist()
        assert np.allclose(own.score, np.sort(d)[:10], rtol=1e-12) and own["rank"].tolist() == list(range(1, 11))
    assert set(full.query_id) == set(range(0, n, 10))
    few = ann.nearest_neighbours(df.where("vec_id < 4"), F.col("vec_id") == 0, k=10).toPandas()
    assert sorted(few.vec_id) == [1, 2, 3]
    assert rows(ann.nearest_neighbours(df.limit(0), F.lit(True))) == []
    assert rows(ann.nearest_neighbours(df, F.lit(False))) == []


def test_neighbour_recall(spark):
    got = queries.QUERIES["op4_nearest_neighbours"](spark, "/root/testdata/sf0.1").toPandas()
    t = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas().sort_values("vec_id")
    x, ids, hits = np.array(t.embedding.tolist(), float), t.vec_id.to_numpy(), 0
    for q in np.flatnonzero(ids % 100 == 0):
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        hits += len(set(got[got.query_id == ids[q]].vec_id) & set(ids[np.lexsort((ids, d))[:10]]))
    assert hits >= 0.9 * len(got)


def test_neighbour_recall_when_cells_are_left_out(spark):
    x = np.random.default_rng(9).standard_normal((6000, 32))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = {share: ann.nearest_neighbours(df, F.col("vec_id") % 100 == 0, k=10, share=share, least=0).toPandas() for share in (ann.SHARE, 0.02)}
    recall = {}
    for share, found in got.items():
        hits = 0
        for q in range(0, 6000, 100):
            d = ((x - x[q]) ** 2).sum(1)
            d[q] = np.inf
            hits += len(set(found[found.query_id == q].vec_id) & set(np.argsort(d)[:10].tolist()))
        recall[share] = hits / 600
    print(recall)
    assert recall[ann.SHARE] >= 0.9 and recall[0.02] < 0.9  # few cells lose neighbours, so the index was used


def test_traverse_goes_by_summed_distance():
    rng = np.random.default_rng(2)
    a, b, sizes = rng.random(7), rng.random(9), rng.integers(0, 5, 63)
    cells = ann.traverse(a, b, sizes, 10**9)
    cost = [a[c // 9] + b[c % 9] for c in cells]
    assert cost == sorted(cost) and sorted(cells) == np.flatnonzero(sizes).tolist()
    few = ann.traverse(a, b, sizes, 20)
    assert few == cells[: len(few)] and sizes[few].sum() >= 20 > sizes[few[:-1]].sum()


# 5: BPE

ODD = [None, "", " ", "Hello  World's 'S", "\x1cabc\x1d d", "ΣΑΣ İstanbul ΑΣ", "a<|endoftext|>b<|startoftext|> <|EndOfText|> <|ENDOFTEXT|>", "é ́x", "日本語", "😀 zwj👨‍👩‍👧",
       "1234 ½ ²", "x" * 3000, "a b c​d   e", "İẞ ǅ", "it's we'll I'D'd", "\x00\x01", "ab" * 40, "the the\tthe"]


@pytest.mark.parametrize("frequent", [0, 50, 100_000])
def test_bpe_is_the_librarys(spark, frequent):
    from tokenizers import Tokenizer

    path = queries.tokenizer_file(queries.BPE_FILE)
    t = Tokenizer.from_file(path)
    texts = ODD + [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).collect()]
    got = {r["doc_id"]: r for r in bpe.digests(bpe.encoded(docs_of(spark, texts), path, frequent)).collect()}
    for i, text in enumerate(texts, 1):
        ids = t.encode(text or "", add_special_tokens=False).ids
        back = t.decode(ids, skip_special_tokens=False)
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == (
            len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(back.encode()).hexdigest()), text


def test_bpe_of_an_empty_table(spark):
    assert rows(bpe.encoded(docs_of(spark, []), queries.tokenizer_file(queries.BPE_FILE))) == []


def test_lexicon(tmp_path):
    rng = random.Random(4)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(1, 7))).encode(): [rng.randrange(1000) for _ in range(rng.randrange(0, 4))] for _ in range(500)}
    (tmp_path / "lexicon").write_bytes(lexicon.compile_lexicon(words))
    lex = lexicon.Lexicon(str(tmp_path / "lexicon"))
    asked = [*words, b"zz", b"abababababab", b""]
    assert lex.tokens(lex.ranks(asked)) == [words.get(w) for w in asked]
    assert len(lex.final) < sum(map(len, words))  # suffixes are shared
    ends = [w + b"ing" for w in (b"a", b"b", b"c")]
    (tmp_path / "small").write_bytes(lexicon.compile_lexicon({w: [1] for w in ends}))
    assert len(lexicon.Lexicon(str(tmp_path / "small")).final) == 5
    (tmp_path / "none").write_bytes(lexicon.compile_lexicon({}))
    assert lexicon.Lexicon(str(tmp_path / "none")).ranks([b"a"]).tolist() == [-1]


# 6: licences

def brute_licenses(doc, text):
    words = lambda t: re.findall(r"(?:[0-9a-z]|[^\x00-\x7f])+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    grams = lambda t: (lambda w: set(zip(w, w[1:], strict=False)))(words(t))

    def best(t):
        g, out = grams(t), None
        for name in sorted(licenses.TEMPLATES):
            own = grams(licenses.TEMPLATES[name])
            dice = 2 * len(g & own) / max(1, len(g) + len(own))
            if g and dice >= licenses.THRESHOLD and (out is None or dice > out[0]):
                out = dice, name
        return out

    lines = (text or "").split("\n")
    full = [i for i, line in enumerate(lines) if words(line)]
    blocks = []
    for i in full:
        if blocks and blocks[-1][1] == i - 1:
            blocks[-1][1] = i
        else:
            blocks.append([i, i])
    units = [("line", i, i) for i in full] + [("block", a, b) for a, b in blocks if b > a] + ([("text", full[0], full[-1])] if len(blocks) > 1 else [])
    return [(doc, kind, a, b - a + 1, m[1], round(m[0], 9)) for kind, a, b in units if (m := best("\n".join(lines[a:b + 1])))]


def test_licenses(spark):
    t = licenses.TEMPLATES
    texts = [None, "", "\n\n", "MIT", t["MIT"], t["MIT"].replace(". ", ".\n"), "x\n\n" + t["ISC"].replace(", ", ",\n\n") + "\n", t["MIT notice"] + "\n" + t["MIT notice"],
             "a b\nLicensed under CC BY-NC 4.0\r\n\nfoo", t["BSD-3-Clause"] + " more words", "p q " * 20_000 + "\n" + t["MIT notice"]]
    texts += [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(300).collect()]
    got = [(r["doc_id"], r["unit"], r["first_line"], r["n_lines"], r["license"], round(r["dice"], 9)) for r in licenses.license_hits(docs_of(spark, texts)).collect()]
    assert sorted(got) == sorted(x for i, text in enumerate(texts, 1) for x in brute_licenses(i, text)) and len(got) > 10


def test_licenses_that_are_no_unit(spark):
    t = licenses.TEMPLATES
    fill = " ".join(f"word{i}" for i in range(120))
    mit = t["MIT"].replace("conditions: The", "conditions:\n\nThe").replace("Software. THE", "Software.\n\nTHE")
    assert mit.count("\n\n") == 2
    apache = t["Apache-2.0 header"].replace("License. You", "License.\n\nYou").replace("2.0 Unless", "2.0\n\nUnless")
    cases = [
        (f"{fill}\n\n{mit}\n\n{fill}", {("MIT", 2, 5)}),
        (f"{fill} {t['MIT']} {fill}", {("MIT", 0, 1)}),
        (f"{fill}\n\n{apache}\n\n{fill}", {("Apache-2.0 header", 2, 5)}),
        (f"{fill} {t['BSD-2-Clause']} {fill}", {("BSD-2-Clause", 0, 1)}),
        (f"{fill} {t['BSD-3-Clause']} {fill}", {("BSD-3-Clause", 0, 1)}),
        (f"{fill} {t['MIT']} {fill} {t['ISC']} {t['MIT']}", {("MIT", 0, 1), ("ISC", 0, 1)}),
        ("Released under the MIT License. See LICENSE.", {("MIT notice", 0, 1)}),
        ("Copyright 2020 Foo. Released under the MIT License.", {("MIT notice", 0, 1)}),
        ("Licensed under the Apache License, Version 2.0. All rights reserved.", {("Apache-2.0 notice", 0, 1)}),
        (t["ISC"] + "\nCopyright 2020 Foo. Released under the MIT License. See LICENSE.", {("MIT notice", 1, 1)}),
        ("released under the", set()), (fill, set()), ("under the\nMIT", set()),
    ]
    got = licenses.license_hits(docs_of(spark, [text for text, _ in cases])).where("unit = 'window'").collect()
    for i, (_, expect) in enumerate(cases, 1):
        assert {(r["license"], r["first_line"], r["n_lines"]) for r in got if r["doc_id"] == i} == expect, i
    assert sum(r["doc_id"] == 6 for r in got) == 3 and all(r["dice"] >= licenses.THRESHOLD for r in got)
    assert next(r["matched"] for r in got if r["doc_id"] == 8) == "Released under the MIT License"


def test_licenses_windows_from_every_begin(spark):
    """Every window by brute force: one that reaches the threshold is reported, or mostly explained by what is."""
    rng = random.Random(4)
    words = lambda t: re.findall(r"[0-9a-z]+", t.lower())
    small = {k: licenses.TEMPLATES[k] for k in ("MIT notice", "Apache-2.0 notice", "GPL-3.0 notice", "CC-BY-NC-4.0 notice")}
    texts = []
    for _ in range(150):
        w = [x for _ in range(3) for x in [*words(rng.choice(list(small.values()))), *rng.choices(["foo", "the", "license", "under"], k=rng.randint(0, 4))]]
        for _ in range(rng.randint(0, 3)):
            w.insert(rng.randrange(len(w)), "zz")
        texts.append(" ".join(w))
    got = licenses.license_hits(docs_of(spark, texts), small).collect()
    for i, text in enumerate(texts, 1):
        w, own = words(text), [r for r in got if r["doc_id"] == i]
        for r in own:
            assert r["matched"] in text
        for name, template in small.items():
            tw = words(template)
            grams, most = set(zip(tw, tw[1:], strict=False)), int(len(tw) * (2 - licenses.THRESHOLD) / licenses.THRESHOLD)
            for a in range(len(w)):
                for b in range(a + 2, min(len(w), a + most) + 1):
                    g = set(zip(w[a:b], w[a + 1 : b], strict=False))
                    if 2 * len(g & grams) / (len(g) + len(grams)) >= licenses.THRESHOLD:
                        assert any(set(zip(x := words(r["matched"]), x[1:], strict=False)) & g & grams for r in own), (text, name, w[a:b])


# 7: chat

def test_chat_round_trip(spark):
    said = ["plain", None, "", "<|im_end|>\n<|im_start|>user\n", "\\", "\\|", "<\\|", "<|", "\\\\n", "x" * 50_000, "é\n😀", "<|im_start|>assistant\nhi<|im_end|>"]
    rng = random.Random(6)
    turns = [(c, t, rng.choice(["user", "assistant", "system", None, "a\nb\\n<|"]), rng.choice(said), 1) for c in [*range(30), None] for t in [0, 1, 1, None, 2]]
    turns += [(100, 0, "user", "only", 1), (101, 0, "assistant", "only", 1)]
    made = chat.examples(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, example int"))
    got = {r["conv_id"]: r for r in chat.digests(made).collect()}
    for c in {t[0] for t in turns}:
        own = sorted(((t[1] is not None, t[1] or 0, (t[2] or "").encode(), (t[3] or "").encode()) for t in turns if t[0] == c))
        roles, texts = [r.decode() for *_, r, _ in own], [x.decode() for *_, x in own]
        whole = "".join(f"{r}\n{x}\n" for r, x in zip(roles, texts, strict=True))
        loss = "".join(x for r, x in zip(roles, texts, strict=True) if r == "assistant")
        assert (got[c]["n_turns"], got[c]["turns_sha256"], got[c]["loss_chars"], got[c]["loss_sha256"]) == (
            len(own), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[c]["n_examples"] == sum(r == "assistant" for r in roles) + (roles[-1] != "assistant")
    for r in made.where("loss_chars > 0").limit(50).collect():
        assert r["formatted"][r["loss_start"] + r["loss_chars"]:] == "<|im_end|>\n" and r["formatted"][: r["loss_start"]].endswith("<|im_start|>assistant\n")
    assert rows(chat.examples(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))) == []


# 8: mixing

def brute_targets(sizes, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    cap, budget, full = {s: 2 * sizes[s] for s in order}, 1.5 * sum(sizes.values()), set()
    while True:
        rest, of = budget - sum(cap[s] for s in full), sum(w[s] for s in order if s not in full)
        more = {s for s in order if s not in full and cap[s] <= rest * w[s] / of}
        if not more:
            return {s: float(cap[s]) if s in full else rest * w[s] / of for s in order}
        full |= more


def test_mixing(spark):
    rng = random.Random(8)
    data = [(i, rng.choice([None, "a", "B", "é", "b", "b", "b", "zero"]), prose(rng, rng.randrange(1, 60)), "x", 5) for i in range(600)]
    data = [(i, s, None if s == "zero" else t, x, z) for i, s, t, x, z in data] + [(None, "a", "", "x", 5), (None, None, " \n", "x", 5), data[0], data[0]]
    df = spark.createDataFrame(data, "doc_id long, source string, text string, size string, target int")
    got = mixing.mixed(df).select("row.doc_id", "row.source", "size", "source_size", "target", "times").collect()
    n = [len(WORD.findall(t or "")) for _, _, t, *_ in data]
    sizes = Counter()
    for (_, s, *_), k in zip(data, n, strict=True):
        sizes[s] += k
    target = brute_targets(sizes)
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter((d[0], d[1], k) for d, k in zip(data, n, strict=True))
    taken = Counter()
    for r in got:
        taken[r["source"]] += r["size"] * r["times"]
        assert r["times"] in (0, 1, 2) and r["source_size"] == sizes[r["source"]] and abs(r["target"] - target[r["source"]]) < 1e-6
    assert all(abs(taken[s] - target[s]) <= 200 for s in target)
    assert sum(taken.values()) <= 1.5 * sum(sizes.values())
    again = mixing.mixed(df.repartition(7)).select("row.doc_id", "row.source", "size", "source_size", "target", "times").collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert rows(mixing.mixed(df.limit(0))) == []


def test_mix_follows_finish_times(spark):
    """What is taken is the prefix of all readings by finish time that the budget holds."""
    rng = random.Random(9)
    data = [(i, rng.choice("abc"), prose(rng, rng.randrange(1, 30))) for i in range(200)]
    got = {r["doc_id"]: r for r in mixing.mixed(spark.createDataFrame(data, "doc_id long, source string, text string"))
           .select("row.doc_id", "size", "target", "times").collect()}
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    reads = []
    for s in "abc":
        own = sorted((md5(f"0|{i}|{md5(t)}"), i) for i, q, t in data if q == s)
        total, upto = sum(got[i]["size"] for _, i in own), 0
        for place, i in own:
            upto += got[i]["size"]
            reads += [((upto + e * total) / got[i]["target"], s, e, place, i) for e in (0, 1)]
    budget, times, held = 1.5 * sum(r["size"] for r in got.values()), Counter(), 0
    for *_, i in sorted(reads):
        held += got[i]["size"]
        if held > budget:
            break
        times[i] += 1
    assert all(times[i] == got[i]["times"] for i in got)


# 10: token counts

def test_token_counts_are_the_librarys(spark):
    import sentencepiece
    from tokenizers import Tokenizer, models

    path = queries.tokenizer_file(queries.PIECE_FILE)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    library = Tokenizer(models.Unigram([(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())], 0, True))
    texts = [*ODD, "▁▁a ▁b  c", "  lead and trail  ", " " * 40, "a" * 5000]
    texts += [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).collect()]
    got = {r["doc_id"]: r["n_tokens"] for r in counts.token_counts(docs_of(spark, texts), path).collect()}
    for i, t in enumerate(texts, 1):
        assert got[i] == (len(library.encode("▁" + t.replace(" ", "▁")).ids) if t else 0), t
    assert rows(counts.token_counts(docs_of(spark, []), path)) == []


def test_count_only_viterbi_against_all_segmentations():
    rng = random.Random(10)
    for _ in range(150):
        pieces = tuple({"".join(rng.choice("ab▁") for _ in range(rng.randrange(1, 4))): float(-rng.randrange(1, 5)) for _ in range(6)}.items())
        seg = counts.Segmenter(pieces)
        text = "".join(rng.choice("abc ") for _ in range(9))
        marked, best = "▁" + text.replace(" ", "▁"), None
        table = dict(pieces)

        def ways(at, score, n):
            nonlocal best
            if at == len(marked):
                best = max(best, score) if best is not None else score
                return
            for end in range(at + 1, len(marked) + 1):
                if marked[at:end] in table:
                    ways(end, score + table[marked[at:end]], n + 1)
            if marked[at] not in table:
                ways(at + 1, score + seg.unknown, n + 1)

        ways(0, 0.0, 0)
        assert seg.count(text)[1] == best


def test_chat_roles_and_texts_of_marks(spark):
    said = ["".join(x) for n in range(6) for x in itertools.product("\\|<bn\n", repeat=n)]
    df = spark.createDataFrame([(s,) for s in said], "s string")
    back = df.where((chat.unescape_role(chat.escape_role(F.col("s"))) != F.col("s")) | (chat.unescape(chat.escape(F.col("s"))) != F.col("s")))
    assert back.count() == 0
    assert df.where(chat.escape_role(F.col("s")).contains("\n") | chat.escape_role(F.col("s")).contains("<|")).count() == 0
    role = "<|bot|>"
    got = chat.digests(chat.examples(spark.createDataFrame([(1, 0, role, "x")], "conv_id long, turn long, role string, text string"))).collect()
    assert got[0]["turns_sha256"] == hashlib.sha256(f"{role}\nx\n".encode()).hexdigest()


def test_ngram_join_with_a_full_map_and_copies(spark, monkeypatch):
    """All documents share the bits of the map: copies still meet a linked text once a class."""
    monkeypatch.setattr(ngram_join, "WANTED", 64)
    rng = random.Random(21)
    base = prose(rng, 60)
    near = " ".join(base.split()[:-2])
    texts = [base] * 400 + [near] * 400 + [prose(rng, 40) for _ in range(60)]
    ids = [*range(1, 801), *[None] * 10, *range(900, 950)]
    got = ngram_join.ngram_components(docs_of(spark, texts, ids), k=4, percent=85).collect()
    by_id = {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None}
    assert {by_id[i] for i in range(1, 801)} == {1} and all(by_id[i] == i for i in range(900, 950))


def test_ngram_fragments_cut_equal_counts():
    often = np.zeros(ngram_join.BUCKETS, np.uint32)
    often[::7] = 3
    cuts = ngram_join._pivots(often, 8)
    held = np.searchsorted(cuts, ngram_join._place(often, np.flatnonzero(often).astype(np.uint64) << np.uint64(44)), side="right")
    assert len(cuts) == 7 and np.ptp(np.bincount(held)) < 10


def test_toxicity_reads_words_beside_typographic_marks():
    model = toxicity.Model([], toxicity.PRIOR, toxicity.BASE)
    texts = ["You idiot", "You \u201cidiot\u201d", "You\u2014idiot", "You idiot\u2026", "\u00abidiot\u00bb you", "you don\u2019t idiot"]
    got = model.kinds(pa.array([*texts, "you don't idiot", "lovely caf\u00e9"]))
    assert (got[:4] == got[0]).all() and got[4].sum() > 0 and (got[5] == got[6]).all() and got[7].sum() == 0


def test_projection_keys_do_not_depend_on_slices_and_bound_memory():
    import tracemalloc
    rng = np.random.default_rng(22)
    x = rng.standard_normal((3000, 64))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(3000)), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), 64).cast(pa.list_(pa.float64()))], ["node", "embedding"])
    one = pa.Table.from_batches(vector_dedup._keyed(64, 5, 1, np.zeros(64))([batch]))
    many = pa.Table.from_batches(vector_dedup._keyed(64, 5, 1, np.zeros(64), 4000)([batch]))
    assert one.combine_chunks().equals(many.combine_chunks())
    tracemalloc.start()
    n = sum(b.num_rows for b in vector_dedup._keyed(64, 200, 1, np.zeros(64))([batch]))
    assert n == 600_000 and tracemalloc.get_traced_memory()[1] < 150e6
    tracemalloc.stop()


# the pipeline

def test_pipeline_stages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas().set_index("doc_id")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = shared.keep(stage(spark, docs, "/root/testdata/sf0.01"), "test")
        assert name == "encode" or out.columns == docs.columns
        kept[name], docs = out.toPandas(), out
    ids = {n: set(k.doc_id) for n, k in kept.items()}
    assert ids["toxicity"] <= ids["quality"] and ids["dedup"] <= ids["toxicity"] and ids["mix"] <= ids["dedup"] and ids["encode"] == ids["mix"]
    assert not ids["quality"] & set(labels[labels.quality == 0].index) - set(labels[labels.quality == 1].index) or \
        len(ids["quality"] & set(labels[labels.quality == 0].index)) <= 0.1 * (labels.quality == 0).sum()
    assert len(set(labels[labels.quality == 1].index) - ids["quality"]) <= 0.02 * (labels.quality == 1).sum()
    before, after = kept["toxicity"], kept["dedup"]
    expect = brute_components(before.doc_id.tolist(), word_sets(before.text.tolist(), 5), 80)
    assert sorted(after.doc_id) == sorted(d for d, _, c in expect if d == c)
    assert kept["mix"].groupby("doc_id").size().max() <= 2 and len(kept["encode"]) == len(kept["mix"])
    words = lambda k: sum(len(WORD.findall(t)) for t in k.text)
    assert abs(words(kept["mix"]) / words(kept["dedup"]) - 1.5) < 0.02


def test_pipeline_takes_odd_rows(spark, tmp_path):
    texts = [None, "", "word " * 3000, "a b c d e f g", "a b c d e f g", "You idiot, you moron!"]
    made = spark.createDataFrame([(i, t, "en", s, 1) for i, (t, s) in enumerate(zip(texts, ["x", None] * 3, strict=True))] + [(None, "no id here", "en", "x", 1), (3, "a b c d e f g", "en", "x", 1)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    made.write.parquet(str(tmp_path / "in/documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "in/labels.parquet"))
    kept = corpus_pipeline.distinct_documents(spark, made.unionByName(made.limit(0)), "").toPandas()
    assert sorted(kept.doc_id.dropna()) == [0, 1, 2, 3, 5] and kept.doc_id.isna().sum() == 1
    more = made.unionByName(spark.createDataFrame([(5, "another text under the same id", "en", "x", 1)], made.schema))
    assert (corpus_pipeline.distinct_documents(spark, more, "").toPandas().doc_id == 5).sum() == 2
    got = corpus_pipeline.run(spark, str(tmp_path / "in")).toPandas()
    assert 5 not in set(got.doc_id) and 4 not in set(got.doc_id) and got.groupby("doc_id").size().max() <= 2
    made.limit(0).write.parquet(str(tmp_path / "none/documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "none/labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
