"""whole catalogues are nested in more parts than the session's, so that a task's rows are not spilled."""

import __spark_entry__ as entry
from bibspark.plans import common as C
from bibspark.session import many_parts
from conftest import SF_SMALL


def test_whole_catalogues_are_dealt_to_many_parts(spark):
    for name in ("marc_key", "field_label"):
        plan = entry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert f", {many_parts(spark)}), REPARTITION_BY_NUM" in plan


def test_the_number_of_parts_changes_no_field(spark):
    rows = [("r", 1, "245", "1", None, 2, "b", "y"), ("r", 1, "245", "1", None, 1, "a", None), ("r", 1, "245", "1", None, 1, None, "z"), (None, 2, "500", " ", " ", 1, "a", "x")]
    df = spark.createDataFrame(rows + rows[:1], "record_id string, ord int, tag string, ind1 string, ind2 string, sf_ord int, code string, value string")
    few, many = (sorted(map(str, C.nest_fields(df, n).collect())) for n in (None, 40))
    assert few == many and len(few) == 2
