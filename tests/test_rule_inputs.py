"""What a rule reads of its input: only the fields of its own tags are made, moved and nested."""

from bibspark import fixtures
from bibspark.operators import decode as D
from bibspark.operators import windows as W
from bibspark.plans import common as C
from bibspark.session import compiled
from conftest import SF_SMALL

SUB = "record_id string, ord int, tag string, ind1 string, ind2 string, sf_ord int, code string, value string"


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_rules_filter_reaches_its_source(spark):
    fx = fixtures.Fixtures(spark, SF_SMALL)
    own = C.effective(fx.nested("fx_all"), "490").select("record_id", "ord", "sfs")
    assert "c_mktsegment" not in _plan(own)      # 100 alone reads customers
    assert "unmediated" not in _plan(own)        # 337
    assert "c_mktsegment" in _plan(C.effective(fx.nested("fx_all"), "100"))
    written = {k[2] for k in fixtures._WRITTEN if k[1] == SF_SMALL}
    assert not written & {"fx_subfields", "fx_more", "fx_notes", "fx_records", "nested:fx_all"}


def test_effective_fields(spark):
    rows = [("r", 1, "245", "1", "0", 1, "a", "T"), ("r", 2, "880", "1", "0", 1, "6", "245-01"), ("r", 3, "880", "1", "0", 1, "a", "no $6"),
            ("r", 4, "880", "1", "0", 1, "6", "100-01"), ("r", 5, "246", "1", "0", 1, "6", "245-02"), ("r", 6, None, "1", "0", 1, "6", "245-03")]
    f = C.with_eff_tag(C.nest_fields(spark.createDataFrame(rows, SUB)))
    assert sorted(r.ord for r in C.effective(f, "245").collect()) == [1, 2]


def test_effective_tag_moves_linked_rows_only(spark):
    rows = [("r", 1, "245", "1", "0", 1, "a", "T"), ("r", 2, "880", "1", "0", 1, "6", "245-01"), ("r", 2, "880", "1", "0", 2, "a", "x"),
            ("r", 3, "880", "1", "0", 1, "a", "no $6"), ("r", 4, "500", "1", "0", 1, "6", "100-01"), ("r", 4, "880", "1", "0", 2, "a", "shares its place"),
            ("r", 5, None, "1", "0", 1, None, "x")]
    out = D.effective_tag(spark.createDataFrame(rows, SUB))
    got = sorted(((r.ord, r.sf_ord, r.eff_tag) for r in out.collect()), key=str)
    assert got == sorted([(1, 1, "245"), (2, 1, "245"), (2, 2, "245"), (3, 1, None), (4, 1, "500"), (4, 2, "100"), (5, 1, None)], key=str)


def test_next_field_of_flat_and_nested(spark):
    rows = [("a", 1, "533", " ", " ", 1, "a", "x"), ("a", 2, "535", "2", " ", 1, "a", "x"), ("a", 2, "535", "2", " ", 2, "a", "x"),
            ("b", 1, "533", " ", " ", 1, "a", "x"), ("b", 2, "500", " ", " ", 1, "a", "x"), ("b", 3, "535", "2", " ", 1, "a", "x"),
            ("c", 1, "534", " ", " ", 1, "a", "x"), ("c", 2, "880", "1", " ", 1, "6", "535-01"), ("d", 1, "533", " ", " ", 1, "6", "535-9"),
            ("e", 1, "533", " ", " ", 1, "a", "x"), ("e", 2, None, "2", " ", 1, "6", "535-01")]
    flat = spark.createDataFrame(rows, SUB)
    want = [("a", 2), ("b", None), ("c", 2), ("d", None), ("e", None)]
    for fields in (W.field_heads(flat), C.nest_fields(flat)):
        assert sorted((r.record_id, r.holding_ord) for r in W.next_field_holding(fields).collect()) == want
    assert "collect_list" not in _plan(W.next_field_holding(C.nest_fields(flat.where("tag <> '880'"))))


def test_places_of_a_record_are_shuffled_once(spark):
    rows = [("a", 5, "500", " ", " ", 1, "a", "x"), ("a", 5, "500", " ", " ", 2, "a", "y"), ("a", 2, "245", " ", " ", 1, "a", "x"),
            (None, 1, "245", " ", " ", 1, "a", "x"), ("b", 9, None, " ", " ", 1, "a", "x")]
    out = W.tag_ordinal(W.places(spark.createDataFrame(rows, SUB)))
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted([("a", 2, "245", 1), ("a", 5, "500", 2), (None, 1, "245", 1), ("b", 9, None, 1)], key=str)
    from bibspark.queries import queries
    plan = queries()["tag_ordinal"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(record_id") == 1  # one, and by nothing else than the record


def test_nested_fields_are_shuffled_once(spark):
    """Nested, joined to their records and windowed by record: dealt once, and sorted nowhere before that."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(key)
    rows = [("a", 1, "245", "1", "0", 2, "b", "y"), ("a", 1, "245", "1", "0", 1, "a", "x"), ("a", 2, "500", " ", " ", 1, "a", "n"),
            (None, 1, "245", "1", "0", 1, "a", "x"), ("c", 1, "245", "1", "0", 1, "a", "no record")]
    spark.conf.set(key, "-1")
    compiled(spark)
    try:
        uris = spark.createDataFrame([("a", "ra"), ("a", "twice"), ("b", "rb")], "record_id string, ruri string")
        out = W.tag_ordinal(C.nest_fields(spark.createDataFrame(rows, SUB)).join(uris, "record_id").where("ruri = 'ra'"))
        got = sorted((r.record_id, r.ord, r.ruri, r.position, [tuple(s) for s in r.sfs]) for r in out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    finally:
        spark.conf.set(key, was)
    assert got == [("a", 1, "ra", 1, [(1, "a", "x"), (2, "b", "y")]), ("a", 2, "ra", 2, [(1, "a", "n")])]
    assert plan.count("Exchange hashpartitioning(") == 2  # the subfields and the record URIs
    assert "SortAggregate(key=[record_id" in plan and "partial_" not in plan  # one aggregate, over sorted rows
    assert plan.count("Sort [record_id") == 3 and "Exchange" in plan.split("SortAggregate")[1]  # subfields, URIs, window; none before the shuffle


def test_versions_are_written_side_by_side(spark, monkeypatch, tmp_path):
    from bibspark.queries import REGISTRY, streams
    monkeypatch.setattr(streams, "scratch_path", lambda s, name: f"{tmp_path}/{name}")
    REGISTRY["record_replace"][0](spark, SF_SMALL).count()
    assert len(list(tmp_path.glob("versions-in/*.parquet"))) > 3  # three versions, none through one task
    assert len(list(tmp_path.glob("ckpt/commits/[0-9]*"))) == 3   # a batch each


def test_generated_methods_stay_compiled(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.unset(key)
    fixtures.Fixtures(spark, SF_SMALL)
    assert spark.conf.get(key) == "8000"
    spark.conf.set(key, "9000")  # the session's own word counts
    fixtures.Fixtures(spark, SF_SMALL)
    assert spark.conf.get(key) == "9000"
    spark.conf.unset(key)


def test_frames_are_written_side_by_side(spark, monkeypatch, tmp_path):
    from bibspark.queries import REGISTRY, conversion
    rows = []

    def batch(out, rejects):
        def fn(df, epoch):
            rows.append(df.count())
            df.selectExpr("string(frame) record_id", "'s' subj", "'p' pred", "'o' obj", "'uri' obj_kind", "'' lang", "'' datatype").write.parquet(f"{out}/epoch={epoch}")
        return fn
    monkeypatch.setattr(conversion, "scratch_path", lambda s, name: f"{tmp_path}/{name}")
    monkeypatch.setattr(conversion, "frames_of_fixture", lambda fx: spark.sql("SELECT id AS k, binary(concat('r', id, chr(29))) AS frame FROM range(500)"))
    monkeypatch.setattr(conversion.S, "graph_batch", batch)
    assert REGISTRY["stream_graph"][0](spark, SF_SMALL).count() == 500
    assert len(rows) == 2 and sum(rows) == 500                   # two batches
    assert len(list(tmp_path.glob("frames-in/*.txt"))) > 2       # of several files each
