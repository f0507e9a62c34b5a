"""Waveform lines: their text is that of the numbers, and it is cut and read once."""

from aircascade import queries, queries_whole as W  # noqa: F401  queries_whole is registered by queries
from aircascade.functions import traces
from aircascade.schema import BINS
from aircascade.sources import dumps
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"


def test_lines_hold_the_numbers(spark):
    a, line = W.event_waveforms(spark, DATA), W.waveform_lines(spark, DATA)
    for r in a.join(line, ["file_name", "event_idx"]).limit(40).collect():
        layer = lambda w, step, size: [(w.xxyy + b * step + w.wf_idx) % size for b in range(BINS)]
        want = [n for w in r.a for n in (w.xxyy, r.event_idx % 1000 * 7 + w.wf_idx, 50_000_000, *layer(w, 3, 97), *layer(w, 5, 89))]
        assert [w.wf_idx for w in r.a] == list(range(len(r.a))) and r.line == " ".join(map(str, want))


def test_numbers_are_cut_once(spark):
    rows = spark.createDataFrame([("f", 0, "1 2 3")], "file_name string, event_idx int, line string")
    plan = dumps.cut_records(rows, 3, "k", "int")._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan and plan.count("split(trim(line") == 2, plan  # one cut at single blanks, one by the pattern for other lines


def test_blanks_of_any_kind(spark):
    lines = ["1 2 3", " 1  2\t3 ", "1\t2\t3", "1 \t2 3", "1 \t 2 3", "", "  ", "7"]
    rows = spark.createDataFrame([(x,) for x in lines], "line string")
    got = [(r.i, r.d) for r in rows.select(traces.numbers(F.col("line"), "int").alias("i"), traces.numbers(F.col("line")).alias("d")).collect()]
    assert got == [([int(n) for n in x.split()], [float(n) for n in x.split()]) for x in lines]
