"""Order-dependent operators on a skewed key: one group holds a third of all rows."""

import numpy as np
from pyspark.sql import functions as F

from bibspark.operators import ordered as O
from conftest import SF_SMALL


def _skewed(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    grp = F.when(F.col("event_id") % 3 == 0, F.lit("hot")).otherwise(F.col("event_type"))
    return ev.select("event_id", grp.alias("grp"), "value")


def test_row_index_is_a_permutation(spark):
    df = _skewed(spark)
    idx = O.row_index(df, ["grp", "event_id"], partitions=7).select("grp", "event_id", "idx").toPandas()
    assert sorted(idx["idx"]) == list(range(len(idx)))
    ref = idx.sort_values(["grp", "event_id"]).reset_index(drop=True)
    assert (ref["idx"].values == np.arange(len(ref))).all()


def test_group_chunks_on_hot_key(spark):
    df = _skewed(spark)
    got = O.group_chunks(df, ["grp"], ["event_id"], 50).select("grp", "event_id", "chunk").toPandas()
    ref = got.sort_values(["grp", "event_id"]).copy()
    ref["exp"] = ref.groupby("grp").cumcount() // 50
    assert (ref["chunk"].values == ref["exp"].values).all()
    assert (got["grp"] == "hot").mean() > 0.3


def test_exact_quantiles_match_numpy(spark):
    df = _skewed(spark)
    qs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {(r["grp"], r["q"]): r["quantile"] for r in O.exact_quantiles(df, "grp", "value", qs).collect()}
    pdf = df.toPandas()
    for g, sub in pdf.groupby("grp"):
        for q in qs:
            assert abs(got[(g, q)] - float(np.quantile(sub["value"].values, q))) < 1e-9
