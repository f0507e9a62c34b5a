"""A row's range costs comparisons only: what ``by`` is computed from isn't computed again for each cut."""

from aircascade import queries
from aircascade.operators import ordering
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"


def test_no_path_is_made_again_for_a_cut(spark):
    plan = queries.QUERIES["file_slice"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert "filter([" not in plan and "lambda" not in plan, plan


def test_ranges_are_in_order(spark):
    rows = spark.createDataFrame([(x,) for x in [None, "", "Z", "a", "é", "￿", "\U0001f600"] + [f"k{i}" for i in range(300)]], "path string")
    got = rows.withColumn("r", ordering._range_of(rows, "path", 10)).orderBy("path").collect()
    r = [x.r for x in got]
    assert r == sorted(r) and r[0] == 0 and len(set(r)) > 40
