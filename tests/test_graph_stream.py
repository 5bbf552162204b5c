"""Graph properties and batch == stream."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from bibspark.fixtures import Fixtures
from bibspark.plans import graph as G
from bibspark.plans import record as REC
from conftest import SF_SMALL


def test_reinsert_changes_nothing(spark):
    t = Fixtures(spark, SF_SMALL).fx_triples
    store = G.insert_triples(t.where(F.col("v") == 1).limit(0), t.where(F.col("v") == 1))
    again = G.insert_triples(store, store)
    assert again.count() == store.count()
    assert again.subtract(store).count() == 0


def test_work_instance_links_inverse(spark):
    h = REC.headers_with_uri(Fixtures(spark, SF_SMALL).fx_records)
    g = REC.record_frame(h)
    has = g.where(F.col("pred").endswith("hasInstance")).select(F.col("subj").alias("w"), F.col("obj").alias("i"))
    of = g.where(F.col("pred").endswith("instanceOf")).select(F.col("obj").alias("w"), F.col("subj").alias("i"))
    assert has.count() == h.count()
    assert has.subtract(of).count() == 0 and of.subtract(has).count() == 0


def test_stream_equals_batch(spark):
    q = entry.queries()
    stream = q["stream_decode"](spark, SF_SMALL)
    batch = q["decode_fields"](spark, SF_SMALL).drop("k")
    assert stream.count() == batch.count()
    assert stream.subtract(batch).count() == 0


def test_restart_processes_each_frame_once(spark):
    q = entry.queries()
    once = q["stream_restart"](spark, SF_SMALL)
    assert once.count() == once.distinct().count() == q["decode_fields"](spark, SF_SMALL).count()


def test_no_python_udf_in_plans(spark):
    q = entry.queries()
    for name in ["contributions", "record_graph", "series_match", "url_encode", "naco_key", "timing_summary"]:
        plan = q[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_stream_routes_bad_frames_to_rejects(spark):
    from bibspark.operators import decode as D
    from bibspark.session import scratch_path
    from bibspark.sources import frames as FR
    from bibspark.streaming import convert as S
    fx = Fixtures(spark, SF_SMALL)
    bad = fx.fx_bad_frames
    src, out, rej, ck = (scratch_path(spark, n) for n in ("bad-in", "fields", "rejects", "ckpt"))
    body = F.when(F.col("frame").endswith("\x1d"), F.expr("substr(frame, 1, length(frame) - 1)")).otherwise(F.col("frame"))
    bad.select(body.alias("value")).repartition(3).write.option("lineSep", "\x1d").text(src)
    counters = {}
    S.run_available(S.file_frames(spark, src, max_files=1), None, ck,
                    foreach_batch=S.convert_batch(out, rej, counters=counters))
    expected_bad = FR.split_frames(bad, "frame", keep=["k"]).where(D.frame_status("frame").isNotNull()).count()
    assert spark.read.parquet(rej).count() == expected_bad
    good_frames = bad.count() - expected_bad
    assert sum(m["frames"] for m in counters.values()) == good_frames
    assert spark.read.parquet(out).select("record_id").distinct().count() == good_frames
