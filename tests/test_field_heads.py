"""The heads of fields are dealt by record once, and a record's linked fields meet its others."""

import random

from bibspark.operators import windows as W

SUB = "record_id string, ord int, tag string, ind1 string, ind2 string, sf_ord int, code string, value string"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows():
    """Thousands of records with a 533 and some field after it, a linked one in few."""
    rnd, rows, want = random.Random(4), [], {}
    for k in range(6000):
        rid, kind = f"r{k}", rnd.choice(["535", "500"] * 20 + ["880-535", "880-245", "880-none"])
        rows += [(rid, 1, "533", " ", " ", i, "a", "x") for i in range(1, 4)]
        tag, link = kind[:3], kind[4:]
        rows += [(rid, 2, tag, "2", " ", 2, "a", "y"), (rid, 2, tag, "2", " ", 1, "6" if link in ("535", "245") else "b", f"{link}-01")]
        rows.append((rid, 2, tag, "2", " ", 3, "6", "245-02") if tag == "880" else (rid, 2, tag, "2", " ", 3, "c", "z"))
        want[rid] = 2 if kind in ("535", "880-535") else None
    rnd.shuffle(rows)
    return rows, want


def test_linked_fields_meet_the_others_of_their_record(spark, tmp_path):
    rows, want = _rows()
    spark.createDataFrame(rows, SUB).repartition(5).write.parquet(str(tmp_path / "s"))
    got = W.next_field_holding(W.field_heads(spark.read.parquet(str(tmp_path / "s"))))
    assert {r["record_id"]: r["holding_ord"] for r in got.collect()} == want
    flat = spark.read.parquet(str(tmp_path / "s"))
    assert _plan(W.next_field_holding(W.field_heads(flat))).count("Exchange ") == 2  # the others and the linked, no third for the window
