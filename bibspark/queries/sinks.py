"""Queries for the sinks (K01-K05, K08) and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import Fixtures
from ..operators import decode as D
from ..plans import metrics as M
from ..session import scratch_path
from ..sinks import writers as K
from . import query


def _files(fx):
    pages = fx.table("pages")
    return pages.select(F.element_at(F.split("url", "/"), -1).alias("name"), F.col("page_id"),
                        F.encode("html", "UTF-8").alias("content"))


@query("sink_payload", """
SELECT 'marc21' AS topic, NULL::VARCHAR AS key, CAST(strlen(frame) AS INT) AS n_bytes, md5(frame) AS md5 FROM fx_frames
UNION ALL SELECT 'marc21', string_split(url, '/')[-1], CAST(strlen(html) AS INT), md5(html) FROM pages
UNION ALL SELECT 'bibframe', NULL, CAST(strlen(line) AS INT), md5(line) FROM fx_log""")
def sink_payload(spark, sf_dir):
    """Frame topic (no key), file topic (key = file name), RDF topic (value only)."""
    fx = Fixtures(spark, sf_dir)
    frames = K.kafka_payload(fx.fx_frames, "marc21", "frame")
    files = K.kafka_payload(_files(fx), "marc21", "content", key="name")
    rdf = K.kafka_payload(fx.fx_log, "bibframe", "line")
    p = frames.unionByName(files).unionByName(rdf)
    return p.select("topic", "key", F.length("value").cast("int").alias("n_bytes"), F.md5("value").alias("md5"))


@query("split_by_control_number", """
SELECT 'p' || CAST(k AS VARCHAR) || '.mrc' AS name, CAST(strlen(frame) AS INT) AS n_bytes, md5(frame) AS md5 FROM fx_frames""")
def split_by_control_number(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    frames = fx.fx_frames.select("k", F.encode("frame", "UTF-8").alias("frame"))
    recs = K.records_by_control_number(D.decode_fields(frames, keep=["frame"]))
    path = scratch_path(spark, "records")
    K.write_table(recs, path, partition_hash="name", n=8)
    return K.manifest(spark.read.parquet(path), "name", "frame")


@query("copy_manifest", """
SELECT string_split(url, '/')[-1] AS name, CAST(strlen(html) AS INT) AS n_bytes, md5(html) AS md5, TRUE AS same FROM pages""")
def copy_manifest(spark, sf_dir):
    """Copy every (name, bytes), then verify the copy by hash."""
    fx = Fixtures(spark, sf_dir)
    src = _files(fx).select("page_id", "name", "content")
    path = scratch_path(spark, "copy")
    K.write_table(src, path)
    copy = spark.read.parquet(path)
    a = src.select("page_id", "name", F.md5("content").alias("md5"), F.length("content").cast("int").alias("n_bytes"))
    b = copy.select("page_id", F.md5("content").alias("md5_copy"))
    return a.join(b, "page_id", "left").select("name", "n_bytes", "md5", (F.col("md5") == F.col("md5_copy")).alias("same"))


@query("pack_files", """
SELECT name, n_bytes, md5 FROM (SELECT string_split(url, '/')[-1] AS name, page_id, CAST(strlen(html) AS INT) AS n_bytes,
  md5(html) AS md5 FROM pages ORDER BY name, page_id LIMIT 4000) t""")
def pack_files(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    packed = _files(fx).orderBy("name", "page_id").limit(K.MAX_PACKED_FILES)
    return K.manifest(packed, "name", "content")


@query("stage_counts", """
SELECT event_type AS stage, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY event_type""")
def stage_counts(spark, sf_dir):
    ev = Fixtures(spark, sf_dir).table("events").withColumnRenamed("event_type", "stage")
    observed, _obs = M.observe_stages(ev)
    return M.stage_counts(observed)


@query("timing_summary", """
SELECT event_type, CAST(count(value) AS BIGINT) AS n, min(value) AS min, max(value) AS max, round(avg(value), 6) AS mean,
  round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75,
  round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99
FROM events GROUP BY event_type""")
def timing_summary(spark, sf_dir):
    ev = Fixtures(spark, sf_dir).table("events")
    return M.timing_summary(ev, "event_type", "value")


@query("elapsed_per_run", """
SELECT user_id, CAST(count(*) AS BIGINT) AS n, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 3) AS elapsed_sec
FROM events GROUP BY user_id""")
def elapsed_per_run(spark, sf_dir):
    ev = Fixtures(spark, sf_dir).table("events")
    return M.elapsed_per_run(ev, "user_id", "ts")
