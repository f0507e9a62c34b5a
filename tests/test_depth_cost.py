"""A drawn depth names each digest once: what one row costs doesn't multiply with its terms."""

from aircascade.functions import shower_depth
from pyspark.sql import functions as F


def test_digests_are_named_once(spark):
    df = spark.range(10).select(F.col("id"), F.lit(19.0).alias("e"), F.lit(4.0).alias("m"))
    plan = df.select(shower_depth.drawn_depth(F.col("e"), F.col("m"), [F.col("id")]).alias("x"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("md5(") == 2  # a candidate's, and the one of the step down
