"""An event's hits, bad detectors and waveforms meet as they are dealt: once, in narrow rows, before cells are made."""

import re

import pytest
from aircascade import queries
from aircascade.operators import hits as H
from aircascade.operators import tiles

DATA = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name, most", [("tile_signals", 2), ("tile_layers", 2), ("tile_dense", 1), ("tile_cells", 2)])
def test_tiles_deal_hits_once(spark, name, most):
    plan = plan_of(queries.QUERIES[name](spark, DATA))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) <= most
    above = plan[: plan.index("Generate explode")] if "Generate explode" in plan else ""
    assert "Sort [" not in above and "SortMergeJoin" not in above, above  # no cell is sorted


def test_hits_move_without_columns_made_of_others(spark):
    plan = plan_of(queries.hits(spark, DATA))
    moved = re.search(r"Exchange hashpartitioning.*?\n.*?Project \[(.*?)\]\n", plan, re.S).group(1)
    assert "pulsa" not in moved and "isgood" not in moved, moved


def test_cells_carry_the_hit_at_their_detector(spark):
    columns = "file_name string, event_idx long, hit_idx int, xxyy int, isgood int, reltime_low double, reltime_up double, pulsa_low double, pulsa_up double, nfold int"
    rows = [("a", 1, 0, None, 5, 9.0, 9.0, 1.0, 1.0, 9), ("a", 1, 1, 505, 5, 1.0, 3.0, 8.0, 10.0, 2), ("a", 1, 2, 606, 4, 2.0, 2.0, 3.0, 5.0, 1), ("a", 1, 3, 606, 5, 7.0, 7.0, 7.0, 7.0, 7), ("b", 1, 0, 100, 1, 1.0, 1.0, 1.0, 1.0, 1)]
    hits = H.tile_hits(spark.createDataFrame(rows, columns))
    bad = spark.createDataFrame([("a", 1, 606), ("b", 1, 505)], "file_name string, event_idx long, xxyy int")
    detectors = spark.createDataFrame([(505, 1.0, 1.0, 1.0), (606, 2.0, 2.0, 2.0)], "xxyy int, x_cm double, y_cm double, z_cm double")
    cell = tiles.geometry(tiles.cells(hits, 3, bad=bad, carry=tiles.reading_columns("mean")), detectors)
    got = {r.xxyy: (r.i, r.j, r.state, r.arrival_times, r.total_signals, r.nfold) for r in tiles.readings(cell, "mean").collect()}
    assert len(got) == 9 and got[505] == (1, 1, True, 8000.0, 9.0, 2) and got[606] == (2, 2, False, 0.0, 4.0, 1) and got[404] == (0, 0, False, 0.0, 0.0, 0)
    dense = tiles.dense(hits, 3, tiles.ArrayLayout(), {"s": tiles.reading_columns("mean")["total_signals"]}).collect()
    assert [r.s for r in dense] == [[[0.0, 0.0, 0.0], [0.0, 9.0, 0.0], [0.0, 0.0, 4.0]]]


@pytest.mark.parametrize("name", ["positional_match", "folded_traces"])
def test_waveforms_meet_hits_by_event(spark, name):
    dealt = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan_of(queries.QUERIES[name](spark, DATA)))
    assert not any("wf_idx" in d for d in dealt), dealt


def test_a_hit_takes_the_waveforms_of_its_range(spark):
    hits = spark.createDataFrame([("a", 1, 0, 7, 2), ("a", 1, 1, 8, 0), ("a", 1, 2, 9, 3), ("a", 1, 3, 9, None)], "file_name string, event_idx long, hit_idx int, xxyy int, nfold int")
    waves = spark.createDataFrame([("a", 1, k, 7, None if k is None else k * 10) for k in (0, 1, 1, 3, 4, 5, None)] + [("b", 1, 0, 7, 0)], "file_name string, event_idx long, wf_idx int, xxyy int, value int")
    got = sorted((r.hit_idx, r.fold_idx, r.wf_idx, r.value) for r in H.positional_match(hits, waves).collect())
    assert got == [(0, 0, 0, 0), (0, 1, 1, 10), (0, 1, 1, 10), (2, 1, 3, 30), (2, 2, 4, 40)]


def test_hit_lines_are_gathered_and_cut_without_lists_of_records(spark):
    plan = plan_of(queries.QUERIES["dump_roundtrip_hits"](spark, DATA))
    assert "ObjectHashAggregate" not in plan and "slice(" not in plan, plan
