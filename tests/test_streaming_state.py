"""The replaced graph, the growing log and groups by count or time."""

import os
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from bibspark.plans.store import GraphStore, replace_batch
from bibspark.sources import tail
from bibspark.streaming import groups

TRIPLE = "record_id string, version int, subj string, pred string, obj string, obj_kind string"


def versions(spark, rows):
    return spark.createDataFrame([(r, v, f"s{r}", "p", o, "literal") for r, v, o in rows], TRIPLE)


def stored(store, records=None):
    return sorted((r["record_id"], r["obj"]) for r in store.read(records).collect())


def test_records_are_replaced_as_in_a_full_rebuild(spark, tmp_path):
    store = GraphStore(spark, str(tmp_path / "store"), fan=3)
    assert stored(store) == []
    truth, sink = {}, replace_batch(store, "version")
    for epoch in range(7):
        rows = [(f"r{i}", epoch, f"{epoch}-{i}-{k}") for i in range(epoch, epoch + 4) for k in range(2)]
        rows += [(f"r{epoch}", epoch - 1, "old")]  # an older version in the same batch
        for i in range(epoch, epoch + 4):
            truth[f"r{i}"] = [f"{epoch}-{i}-0", f"{epoch}-{i}-1"]
        batch = versions(spark, rows)
        sink(batch, epoch)
        if epoch in (2, 5):
            before = store.manifest()
            sink(versions(spark, [("r0", 99, "replayed")]), epoch)  # a replay changes nothing
            assert store.manifest() == before
    want = sorted((r, o) for r, os_ in truth.items() for o in os_)
    assert stored(store) == want
    assert len(store.manifest()["runs"]) < 7
    assert stored(store, spark.createDataFrame([("r3",), ("none",)], "record_id string")) == [x for x in want if x[0] == "r3"]
    store.replace(versions(spark, [("r3", 1, "late")]), "version")  # an older version that comes late
    assert stored(store) == want
    store.replace(versions(spark, [("new", 1, "x")]), "version", removed=spark.createDataFrame([("r3", 9)], "record_id string, version int"))
    want = sorted([x for x in want if x[0] != "r3"] + [("new", "x")])
    assert stored(store) == want
    store.compact(whole=True)
    assert stored(store) == want and len(store.manifest()["runs"]) == 1


def test_a_second_writer_is_an_error(spark, tmp_path):
    store = GraphStore(spark, str(tmp_path / "store"))
    store.replace(versions(spark, [("a", 1, "x")]))
    old = store.manifest() | {"version": 0}
    with pytest.raises(RuntimeError):
        store._switch(old)
    assert stored(store) == [("a", "x")]


def test_batch_does_not_read_the_store(spark, tmp_path):
    """A batch's run holds the batch alone, whatever is stored."""
    store = GraphStore(spark, str(tmp_path / "store"), fan=100)
    store.replace(versions(spark, [(f"r{i}", 1, "x" * 50) for i in range(2000)]))
    store.replace(versions(spark, [("r7", 2, "y")]))
    last = store.manifest()["runs"][-1]
    assert spark.read.parquet(f"{store.path}/{last['folder']}").count() == 2


def run_tail(spark, folder, out, check):
    spark.dataSource.register(tail.LogTail)
    stream = spark.readStream.format("log_tail").option("path", folder).load()
    (stream.writeStream.option("checkpointLocation", check).trigger(availableNow=True)
     .format("parquet").option("path", out).start().awaitTermination())
    return sorted((r["file"], r["line"]) for r in spark.read.parquet(out).collect())


def append(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "a", encoding="utf-8") as f:
        f.write(text)


def test_appended_lines_come_once_over_a_restart_and_a_new_day(spark, tmp_path):
    folder, out, check = (str(tmp_path / n) for n in ("log", "out", "check"))
    append(folder, "20240101.log", "a\nb é\nhalf")
    assert run_tail(spark, folder, out, check) == [("20240101.log", "a"), ("20240101.log", "b é")]
    append(folder, "20240101.log", " line\nc\n")
    append(folder, "20240102.log", "d\n\n")
    want = [("20240101.log", x) for x in ("a", "b é", "c", "half line")] + [("20240102.log", ""), ("20240102.log", "d")]
    assert run_tail(spark, folder, out, check) == want
    assert run_tail(spark, folder, out, check) == want


def test_pieces_cover_every_line_once(tmp_path, monkeypatch):
    monkeypatch.setattr(tail, "PIECE", 7)
    monkeypatch.setattr(tail, "_BACK", 5)
    lines = ["", "x", "yy" * 20, "z", "", "1234567", "123456", "end"]
    append(str(tmp_path), "a.log", "\n".join(lines) + "\nunfinished")
    reader = tail.LogTailReader({"path": str(tmp_path)})
    end = reader.latestOffset()
    got = [r[2] for p in reader.partitions({}, end) for r in reader.read(p)]
    assert got == lines
    small = tail.LogTailReader({"path": str(tmp_path), "maxBytesPerTrigger": "10"})
    got, at = [], {}
    while (end := small.latestOffset()) != at:
        got += [r[2] for p in small.partitions(at, end) for r in small.read(p)]
        at = end
    assert got == lines


def test_groups_by_count_and_time(spark, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    src, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    batches = [[f"k{i % 23}" for i in range(60)], [f"k{i}" for i in range(40)], [f"m{i}" for i in range(3)]]
    shards, most = 2, 5

    def put(items):
        spark.createDataFrame([(x,) for x in items], "item string").coalesce(1).write.mode("append").text(src)

    put(batches[0])
    stream = groups.grouped(spark.readStream.text(src), "value", most, 3, shards)
    query = stream.writeStream.option("checkpointLocation", check).format("parquet").option("path", out).outputMode("append").start()
    wanted = {x for b in batches for x in b}
    try:  # timers keep the query busy: wait for what has to come
        for more in batches[1:]:
            time.sleep(3)
            put(more)
        deadline = time.time() + 120
        while time.time() < deadline:
            time.sleep(2)
            seen = {x for r in spark.read.schema(groups.GROUP).parquet(out).collect() for x in r["items"]} if os.path.isdir(out) else set()
            if seen == wanted:
                break
    finally:
        query.stop()
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    rows = spark.read.parquet(out).collect()
    by_shard = defaultdict(list)
    for r in sorted(rows, key=lambda r: r["number"]):
        assert len(set(r["items"])) == r["n"] <= most and r["full"] == (r["n"] == most)
        by_shard[r["shard"]].append(r)
    for groups_ in by_shard.values():
        assert [r["number"] for r in groups_] == list(range(len(groups_)))
    assert {x for r in rows for x in r["items"]} == wanted
    assert any(not r["full"] for r in rows)
    known = spark.createDataFrame([(x,) for b in batches for x in b], "item string").distinct()
    shard_of = {r["item"]: r["s"] for r in known.select("item", F.pmod(F.xxhash64("item"), F.lit(shards)).cast("int").alias("s")).collect()}
    assert all(shard_of[x] == r["shard"] for r in rows for x in r["items"])
