"""Whole dumps: lines are made where they are written, checked once, and their numbers cut by whole buffers."""

import pyarrow as pa
import pytest
from aircascade import queries, queries_whole
from aircascade.operators import hits as H
from aircascade.operators import tiles
from aircascade.plans import datasets
from aircascade.schema import BINS, SECTIONS, WAVEFORM_SIZE
from aircascade.sources import dumps, records, splits
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_numbers_are_cut_by_buffers():
    lines = ["1 22 333", "", None, " 5 ", "0 123456789 10"]
    values, n = records.cut(pa.array(lines))
    assert values.tolist() == [1, 22, 333, 5, 0, 123456789, 10] and n.tolist() == [3, 0, 0, 1, 3]
    values, n = records.cut(pa.array(["1 2", "-3\t+4  007", "2147483647"]))
    assert values.tolist() == [1, 2, -3, 4, 7, 2147483647] and n.tolist() == [2, 3, 1]
    for wrong in ("1 x", "1.5", "2147483648", "\t1"):
        with pytest.raises(ValueError):
            records.cut(pa.array(["1 2", wrong]))
    assert records.counts(pa.array([*lines, " 1  2\t3 ", "\t1", "1\t"])).tolist() == [3, 0, 0, 1, 3, 3, 2, 2]
    m, line, place = records.whole_records(pa.array(["1 2 3 4", "1 2 3", "", "5 6"]), 2)
    assert m.tolist() == [[1, 2], [3, 4], [5, 6]] and line.tolist() == [0, 0, 3] and place.tolist() == [0, 1, 0]
    batch = pa.RecordBatch.from_arrays([pa.array(["1" * records.CHUNK, "2", "3", None, "4" * records.CHUNK])], ["line"])
    parts = list(records.chunks(batch))
    assert len(parts) > 1 and sum((p.column("line").to_pylist() for p in parts), []) == batch.column("line").to_pylist()


def test_waveforms_are_cut_in_batches(spark):
    one = " ".join(map(str, range(WAVEFORM_SIZE)))
    rows = spark.createDataFrame([("f", 0, f"{one} {one}"), ("f", 1, ""), ("f", 2, "1 2"), ("f", 3, one.replace(" ", "  ", 1)), ("f", 4, None)], "file_name string, event_idx int, line string")
    df = dumps.waveform_rows(rows)
    assert "split(" not in optimized(df)
    got = sorted((r.event_idx, r.wf_idx, r.xxyy, r.clkcnt, r.mclkcnt, r.fadc_low, r.fadc_up) for r in df.collect())
    values = list(range(WAVEFORM_SIZE))
    assert got == [(e, k, 0, 1, 2, values[3 : 3 + BINS], values[3 + BINS :]) for e, k in ((0, 0), (0, 1), (3, 0))]


def test_lines_are_checked_once_for_all_tables(spark):
    rows = spark.createDataFrame([("a", s, 0, "") for s in SECTIONS.values()] + [("b", "event", 0, "1 2")], "file_name string, section string, event_idx int, line string")
    d = dumps.parse_tagged(rows)
    assert {r.file_name: r.reason[:7] for r in d.quarantine.collect()} == {"a": "event 0", "b": "section"}
    assert not any("Aggregate" in optimized(getattr(d, t)) for t in ("events", "hits", "waveforms", "bad_detectors", "quarantine"))


def test_no_window_or_sort_moves_text(spark):
    rows = dumps.tagged_rows(queries_whole.dump_rows(spark, DATA), queries_whole.dump_line())
    assert "line" not in rows.columns and not rows.schema["_section"].nullable
    # Text is made to find markers, and for no column that is kept.
    assert all("array_join" not in x or "_opens" in x for x in optimized(rows).split("\n"))


def test_staged_lines_need_no_sort_of_their_own(spark, tmp_path):
    line = queries_whole.dump_line()
    rows = dumps.tagged_rows(queries_whole.dump_rows(spark, DATA), line)
    lines = dumps.staged_rows(rows, line, str(tmp_path / "x"))
    want = dumps.tagged(queries_whole.full_dump(spark, DATA)).select(*lines.columns)
    assert lines.exceptAll(want).count() == 0 and want.exceptAll(lines).count() == 0
    part = lines.withColumn("_f", F.input_file_name()).withColumn("_n", F.monotonically_increasing_id()).where("section = 'event'").select("_f", "_n", "file_name", "event_idx").collect()
    for f in {r._f for r in part}:
        keys = [(r.file_name, r.event_idx) for r in sorted((r for r in part if r._f == f), key=lambda r: r._n)]
        assert keys == sorted(keys)


def test_carriage_returns_are_looked_for_before_the_pattern_runs(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"EVENT DATA\r\na\r\nb\rc\nd")
    df = splits.split_lines(spark, str(tmp_path))
    assert [r.line for r in df.orderBy("pos").collect()] == ["EVENT DATA", "a", "b\rc", "d"]
    assert "CASE WHEN (((EndsWith(value" in optimized(df)


def test_markers(spark):
    lines = ["# EVENT DATA", "SD meta DATA x", "SD waveform DATA", "badsdinfo", "DATA", "1 2", "", None]
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "k int, line string").select("k", splits.opens(F.col("line")).alias("s"))
    assert [r.s for r in rows.orderBy("k").collect()] == ["event", "hit", "waveform", "bad", None, None, None, None]


def test_ingested_files_move_as_rows_and_not_as_text(spark):
    made, *below = optimized(queries_whole.dump_texts(spark, DATA)).split("\n")
    assert "array_join" in made and not any("array_join" in x for x in below)
    assert queries_whole.dump_texts(spark, DATA).columns == ["value"]


def test_lines_without_waveforms_move_as_rows(spark):
    rows = queries_whole.dump_rows(spark, DATA, waveforms=False)
    assert "array_join" not in optimized(rows)
    assert queries.whole_dump(spark, DATA).where("line = 'SD waveform DATA'").count() > 0


def test_stored_hits_are_dealt_by_their_event_once(spark, tmp_path):
    queries.hits(spark, DATA).write.parquet(str(tmp_path / "hits"))
    stored = spark.read.parquet(str(tmp_path / "hits"))
    plan = tiles.cells(H.tile_hits(stored), 3, queries.LAYOUT)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    rows = spark.createDataFrame([("a", 1, k, x) for k, x in enumerate((7, None, 5, 7, None, 5, 6))] + [("b", 1, 0, 6)], "file_name string, event_idx int, hit_idx int, xxyy int")
    assert sorted((r.file_name, r.hit_idx) for r in H.first_hits(rows).collect()) == [("a", 0), ("a", 1), ("a", 2), ("a", 6), ("b", 0)]


def test_wide_tables_are_not_stored_beside_their_lines(spark, tmp_path):
    rows = spark.createDataFrame([("a", k, x) for k, x in enumerate(("EVENT DATA", " ".join(["1"] * 61), "SD meta DATA", "", "SD waveform DATA", "", "badsdinfo"))], "file_name string, line_no int, line string")
    d = datasets.parsed_in_steps(rows, str(tmp_path / "x"))
    assert sorted(p.name for p in (tmp_path / "x/parsed").iterdir()) == ["bad_detectors", "hits", "quarantine"]
    assert (d.events.count(), d.hits.count(), d.waveforms.count(), d.quarantine.count()) == (1, 0, 0, 0)


def test_traces_meet_an_events_arrays(spark):
    key = "file_name string, event_idx long, "
    arrays = spark.createDataFrame([("a", 1, [[5, 6], [7, -1]]), ("a", 2, [[1, 2], [3, 4]])], key + "xxyy array<array<int>>")
    trace = spark.createDataFrame([("a", 1, 7, [1.0] * BINS), ("a", 1, 9, [2.0] * BINS)], key + "xxyy int, time_traces array<double>")
    got = {r.event_idx: [[sum(t) for t in row] for row in r.time_traces] for r in tiles.filled_traces(arrays, trace).collect()}
    assert got == {1: [[0, 0], [BINS, 0]], 2: [[0, 0], [0, 0]]}


def tile_inputs(spark):
    h = queries.hits(spark, DATA)
    w = H.folds(h).select("file_name", "event_idx", "wf_idx", "xxyy", F.array_repeat(F.lit(1), BINS).alias("fadc_low"), F.array_repeat(F.lit(2), BINS).alias("fadc_up"))
    e = dumps.event_rows(queries.event_lines(spark, DATA))
    return dumps.Dumps(e, h, w, queries.bad(spark, DATA), e), queries.detectors(spark, DATA)


def test_cells_are_nested_without_traces(spark, monkeypatch):
    d, detectors = tile_inputs(spark)
    nested, seen = tiles.nested, []
    monkeypatch.setattr(tiles, "nested", lambda cell, n, columns: seen.append([*cell.columns, *columns]) or nested(cell, n, columns))
    out = datasets.tile_dataset(d, detectors, datasets.TileOptions(ntile=3, layout=queries.LAYOUT))
    assert len(seen) == 1 and not any("time_traces" in c for c in seen[0]) and {"time_traces_low", "time_traces_up"} < set(out.columns) and "xxyy" not in out.columns


def test_traces_are_made_for_hits_in_cells_only(spark):
    d, detectors = tile_inputs(spark)
    options = datasets.TileOptions(ntile=3, layers="mean", layout=queries.LAYOUT)
    cell = datasets.tile_cells(d, detectors, options)
    assert not [c for c in cell.columns if c.startswith("_")]
    traced = cell.where(F.exists("time_traces", lambda x: x != 0)).count()
    assert 0 < traced == datasets._traces(d, datasets._untraced(d, detectors, options), options).count() < H.tile_hits(d.hits).count()
