"""Lines and waveforms are never broadcast: their size on disk says nothing of their size in memory."""

from aircascade import queries, queries_whole
from aircascade.operators import ragged, tiles

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_dump_lines_are_merged(spark):
    for lines in (queries.whole_dump(spark, DATA), queries_whole.full_dump(spark, DATA)):
        assert "BroadcastHashJoin" not in plan(lines)


def test_waveforms_are_merged(spark):
    key = "'a' as file_name, id as event_idx"
    hits = spark.range(3).selectExpr(*key.split(", "), "0 as hit_idx", "5 as xxyy", "4 as isgood", "1.0D as vem_low", "1.0D as vem_up", "1 as nfold")
    waves = spark.range(3).selectExpr(*key.split(", "), "0 as wf_idx", "5 as xxyy", "array_repeat(1, 128) as fadc_low", "array_repeat(1, 128) as fadc_up")
    cell = hits.select("file_name", "event_idx", "xxyy")
    for df in (tiles.with_traces(cell, tiles.traces_of(hits, waves)), ragged.trace_rows(hits, waves)):
        assert "Broadcast" not in plan(df) and df.count() == 3
