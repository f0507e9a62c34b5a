from aircascade.functions import names
from pyspark.sql import functions as F


def test_dates_are_six_digits(spark):
    df = spark.createDataFrame([("tasdcalibev_pass2_160501.dst",), ("tasdcalibev_pass2_1000003.dst",), ("tasdcalibev_pass2_9999999.dst",)], "n string")
    got = df.select(names.observation_date(F.col("n")), names.date_at_most(F.col("n"))).collect()
    assert [tuple(r) for r in got] == [(160501, True), (100000, True), (999999, False)]
