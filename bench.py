"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query runs to completion into Spark's ``noop`` sink (full plan, no
collect to the driver); the value is the sum of the query times.  The test
inputs derived from the driver tables (fixtures) are written once first, as a
session would keep its decoded catalogue, and their build time is reported
separately as ``fixture_build_sec``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "decode_fields", "explode_subfields", "contributions", "record_graph", "leader_types",
    "series_match", "subject_label", "rda_pairs", "next_field_holding", "item_grouping",
    "url_encode", "naco_key", "split_roles", "triples_upsert", "delete_pattern",
    "timing_summary", "log_keys_distinct", "stream_decode",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from bibspark.queries import queries
    from bibspark.session import spark_session

    from bibspark.fixtures import MATERIALIZE, Fixtures

    spark = spark_session(cpus=cpus)
    qs = queries()
    t0 = time.time()
    fx = Fixtures(spark, sf_dir)
    for name in sorted(MATERIALIZE):
        fx[name]
    for source in ("fx_subfields", "fx_all", "fx_notes"):
        fx.nested(source)
    fixture_build = round(time.time() - t0, 3)
    times: dict[str, float] = {}
    for n in names:
        t0 = time.time()
        qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "fixture_build_sec": fixture_build}))
    spark.stop()


if __name__ == "__main__":
    main()
