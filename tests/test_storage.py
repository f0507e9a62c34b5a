"""Splits of dumps, audited storage, groups of outputs, slices, levels and quarantine on small tables."""

import random

import pytest
from aircascade.operators import checks, profile
from aircascade.plans import datasets, jobs
from aircascade.sources import dumps, index, splits, storage, tables
from pyspark.sql import functions as F

from .dump_fixture import plain_events, text_of


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "10"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def whole_file_tags(text):
    """file-free oracle: (section, event_idx, line) by a loop over the lines."""
    out, section, n = [], None, {}
    for line in text.strip().split("\n"):
        line = line.removesuffix("\r")
        opened = next((s for m, s in (("EVENT DATA", "event"), ("SD meta DATA", "hit"), ("SD waveform DATA", "waveform"), ("badsdinfo", "bad")) if m in line), None)
        if opened:
            section = opened
        elif section:
            out.append((section, n.get(section, 0), line.strip()))
            n[section] = n.get(section, 0) + 1
    return out


def test_splits_of_a_file_give_its_sections(spark, tmp_path, small_splits):
    rng = random.Random(2)
    again = "\n".join(rng.choice(["EVENT DATA", "SD meta DATA", "badsdinfo", *[f"{k} {k}" for k in range(12)], ""]) for _ in range(900))
    texts = {"plain": text_of(plain_events(6)), "again": "\n\n" + again + "\n \n\n", "crlf": "EVENT DATA\r\n1\r\n2\r\nbadsdinfo\r\n3 4\r\n", "none": "no\nmarkers\n", "blank": " \n\n", "empty": ""}
    for name, text in texts.items():
        (tmp_path / f"{name}.txt").write_bytes(text.encode())
    got = splits.read_tagged(spark, str(tmp_path))
    assert splits.split_lines(spark, str(tmp_path)).select("file_name", "block").distinct().count() > 20
    rows = {}
    for r in got.collect():
        rows.setdefault(r.file_name.split("/")[-1][:-4], []).append((r.section, r.event_idx, r.line.strip()))
    assert {k: sorted(v) for k, v in rows.items()} == {k: sorted(whole_file_tags(t)) for k, t in texts.items() if whole_file_tags(t)}


def test_no_window_or_whole_file_touches_a_line(spark, tmp_path, small_splits):
    (tmp_path / "a.txt").write_text(text_of(plain_events(4)))
    plan = splits.read_tagged(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "wholetext" not in plan


def test_lines_meet_few_runs(spark, tmp_path):
    text = "".join(f"EVENT DATA\n{k}\n" for k in range(3000)) + "badsdinfo\n" + "7\n" * 3000
    (tmp_path / "a.txt").write_text(text)
    found = splits.runs(splits.summed_splits(splits.split_lines(spark, str(tmp_path))))
    assert found.count() <= 2 * 3001 + 1 and found.groupBy("file_name", "part").count().agg(F.max("count")).first()[0] < 10
    got = splits.read_tagged(spark, str(tmp_path)).groupBy("section").agg(F.count("*"), F.countDistinct("event_idx"), F.max("event_idx")).orderBy("section").collect()
    assert [tuple(r) for r in got] == [("bad", 3000, 3000, 2999), ("event", 3000, 3000, 2999)]


def test_splits_that_changed_between_passes_are_an_error(spark, tmp_path, small_splits):
    (tmp_path / "a.txt").write_text(text_of(plain_events(4)))
    lines = splits.split_lines(spark, str(tmp_path))
    other = splits.summed_splits(lines).withColumn("length", F.col("length") + 1)
    with pytest.raises(Exception, match="splits changed"):
        splits.numbered(lines, other).collect()


def test_staged_lines_are_read_by_section(spark, tmp_path):
    (tmp_path / "a.txt").write_text(text_of(plain_events(4)))
    rows = dumps.staged(splits.read_tagged(spark, str(tmp_path / "a.txt")), str(tmp_path / "lines"))
    plan = dumps.hit_rows(rows.where("section = 'hit'"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(section" in plan and plan.count("FileScan") == 1
    assert dumps.parse_tagged(rows).hits.count() == dumps.read_dumps(spark, str(tmp_path / "a.txt")).hits.count() > 0


def arrays(spark):
    rows = [(i, [0.0] * 20 + [float(i)] + [0.0] * (i % 3), [1.5, 0.0, float(i)], [0, 0, 0, i], [[0.0, 1.0], [2.0]], "x") for i in range(50)]
    rows += [(100, [], [None, 0.0], [0, None, 0], [], None), (101, None, [float("nan")], None, None, "y"), (102, [-0.0] * 30, [-0.0], [0] * 9, [[0.0]], "")]
    return spark.createDataFrame(rows, "k int, thin array<double>, thick array<double>, whole array<int>, deep array<array<double>>, note string")


def test_arrays_take_the_smaller_form_and_come_back(spark, tmp_path):
    df, path = arrays(spark), str(tmp_path / "t")
    assert storage.write_audited(df, path) == 53
    stored = spark.read.parquet(path)
    assert {f.name for f in stored.schema if (f.metadata or {}).get("sparse")} == {"thin", "whole"}
    back = storage.read_audited(spark, path)
    assert back.dtypes == df.dtypes
    even = lambda r: repr([[x + 0.0 if isinstance(x, float) else x for x in v] if isinstance(v, list) and not (v and isinstance(v[0], list)) else v for v in r])
    assert sorted(map(even, back.collect())) == sorted(map(even, df.collect()))


def test_a_damaged_write_is_tried_again_and_never_published(spark, tmp_path):
    df, calls = arrays(spark), []

    def damage(until):
        def run(folder):
            calls.append(folder)
            if len(calls) <= until:
                spark.range(1).select(F.lit(7).alias("k")).write.mode("append").parquet(folder)

        return run

    assert storage.write_audited(df, str(tmp_path / "a"), after_write=damage(2)) == 53 and len(calls) == 3
    calls.clear()
    with pytest.raises(ValueError, match="5 writes read back otherwise"):
        storage.write_audited(df, str(tmp_path / "b"), after_write=damage(9))
    assert not (tmp_path / "b").exists() and not [p for p in tmp_path.iterdir() if "_staging_" in p.name]
    with pytest.raises(FileExistsError):
        storage.write_audited(df, str(tmp_path / "a"))


def test_empty_and_plain_tables(spark, tmp_path):
    assert storage.write_audited(arrays(spark).where("k < 0"), str(tmp_path / "e")) == 0
    assert storage.write_audited(spark.range(5), str(tmp_path / "p")) == 5 and storage.read_audited(spark, str(tmp_path / "p")).count() == 5


def test_export_of_both_kinds(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "DAT000101_a.txt").write_text(text_of(plain_events(5)))
    from .dump_fixture import catalogue

    det = spark.createDataFrame(catalogue(), "xxyy int, x_cm double, y_cm double, z_cm double")
    n = datasets.export(spark, [str(tmp_path / "in")], str(tmp_path / "r"))
    assert n["events"] == 5 and n["traces"] > 0
    t = datasets.export(spark, [str(tmp_path / "in")], str(tmp_path / "t"), det, datasets.TileOptions(ntile=3))
    assert 0 < t["tiles"] <= 5 and storage.read_audited(spark, str(tmp_path / "t" / "tiles")).count() == t["tiles"]


def group_rows(spark, files):
    return spark.createDataFrame([(f, i, i * 1.0) for f in files for i in range(3)], "file_name string, event_idx int, x double")


def group_plan(spark, groups):
    return spark.createDataFrame(list(groups.items()), "output string, inputs array<string>")


def test_passes_write_only_what_changed(spark, tmp_path):
    out = str(tmp_path / "out")
    rows, groups = group_rows(spark, "abcdef"), {"one": ["a", "b"], "two": ["c"], "three": ["d", "e"], "none": ["zz"]}
    count = lambda: {r.output: r.n for r in jobs.outputs_of(spark, out).groupBy("output").agg(F.count("*").alias("n")).collect()}
    assert jobs.run_pass(rows, group_plan(spark, groups), out, file_rows=2) == 4
    assert count() == {"one": 6, "two": 3, "three": 6}
    assert max(spark.read.parquet(str(p)).count() for p in (tmp_path / "out" / "rows").rglob("*.parquet")) <= 2
    assert jobs.run_pass(rows, group_plan(spark, groups | {"one": ["b", "a"]}), out) == 0  # the order of inputs doesn't count
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "out" / "rows").rglob("*.parquet")}
    assert jobs.run_pass(rows, group_plan(spark, groups | {"two": ["c", "f"], "three": ["zz"]}), out) == 2
    assert count() == {"one": 6, "two": 6}  # an output whose inputs hold nothing is empty, not its old self
    assert all(p.exists() and p.stat().st_mtime_ns == t for p, t in before.items() if "output=one" in str(p))


def test_a_run_that_failed_before_its_commit_counts_for_nothing(spark, tmp_path):
    out, rows = str(tmp_path / "out"), group_rows(spark, "ab")
    jobs.run_pass(rows, group_plan(spark, {"one": ["a"]}), out)
    torn = jobs.versioned(group_plan(spark, {"one": ["a", "b"]})).first().version
    rows.withColumns({"output": F.lit("one"), "version": F.lit(torn)}).limit(1).write.mode("append").partitionBy("output", "version").parquet(f"{out}/rows")
    assert jobs.outputs_of(spark, out).count() == 3
    assert jobs.run_pass(rows, group_plan(spark, {"one": ["a", "b"]}), out) == 1 and jobs.outputs_of(spark, out).count() == 6


def test_slices_open_the_files_they_need(spark, tmp_path):
    path, by = str(tmp_path / "t"), ["file_name", "event_idx"]
    rows = spark.range(1000).select(F.concat(F.lit("f"), F.col("id") % 7).alias("file_name"), F.col("id").alias("event_idx"))
    assert [index.append_ordered(rows.where(F.col("event_idx") % 2 == k), path, by, 8) for k in range(2)] == [0, 1]
    want = sorted((int(r.event_idx % 2), r.file_name, r.event_idx) for r in rows.collect())
    some = index.sliced_rows(spark, path, by, 490, 620)
    assert sorted((r.gidx, r.file_name, r.event_idx) for r in some.collect()) == [(i, *want[i][1:]) for i in range(490, 620)]
    assert len(some.inputFiles()) < index.index_of(spark, path).count() / 2
    assert index.sliced_rows(spark, path, by, 5, 5).count() == index.sliced_rows(spark, path, by, 2000, 3000).count() == 0
    for bad in ((0, 5, 2), (-1, 5, 1), (5, 4, 1)):
        with pytest.raises(ValueError):
            index.sliced_rows(spark, path, by, *bad)
    # An append whose index was not written is not read, and is written over.
    spark.range(5).select(F.lit("x").alias("file_name"), F.col("id").alias("event_idx")).write.parquet(f"{path}/data/chunk=2")
    assert index.sliced_rows(spark, path, by, 0, 9999).count() == 1000
    assert index.append_ordered(rows.limit(3), path, by, 2) == 2 and index.sliced_rows(spark, path, by, 0, 9999).count() == 1003


def test_levels_of_tables(spark):
    rows = lambda **n: spark.createDataFrame([(f, 0) for f, k in n.items() for _ in range(k)], "file_name string, x int")
    known = {"event": rows(a=2, b=1), "hit": rows(a=5, b=4), "trace": rows(a=5, b=4), "none": rows()}
    got = {r.table: (r.level, r.matches, r.n_rows) for r in profile.levels({"e": rows(a=2, b=1), "both": rows(a=5, b=4), "part": rows(a=2), "more": rows(a=2, b=1, c=1), "empty": rows()}, known).collect()}
    assert got == {"e": ("event", "event", 3), "both": (None, "hit,trace", 9), "part": (None, "", 2), "more": (None, "", 4), "empty": ("none", "none", 0)}


def test_faulty_files_go_as_a_whole(spark):
    e = spark.createDataFrame([(f, k, 2) for f in "abcdefg" for k in range(3)] + [("g", 1, 2)], "file_name string, event_idx int, nhits int")
    h = spark.createDataFrame([(f, k, i, 1) for f in "abcdefg" for k in range(3) for i in range(2) if (f, k, i) != ("b", 1, 0)] + [("c", 9, 0, 1)], "file_name string, event_idx int, hit_idx int, nfold int")
    w = spark.createDataFrame([(f, k, i) for f in "abcdefg" for k in range(3) for i in range(2) if f != "d"] + [("e", 2, 2)], "file_name string, event_idx int, wf_idx int")
    wrong = checks.faulty_files(e, h, w)
    got = {r.file_name: (r.n_faulty, r.first_event, r.reason) for r in wrong.collect()}
    assert got == {"b": (1, 1, "other hits than stated"), "c": (1, 9, "rows without an event"), "d": (3, 0, "other waveforms than folds"), "e": (1, 2, "other waveforms than folds"), "g": (1, 1, "an event twice")}
    kept = checks.without_files({"events": e, "hits": h, "waveforms": w}, wrong)
    assert {n: {r.file_name for r in df.collect()} for n, df in kept.items()} == {n: {"a", "f"} for n in kept}
    assert checks.faulty_files(e.limit(0), h.limit(0), w.limit(0)).count() == 0


def test_written_rows_are_compared_with_what_the_table_holds(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(i, i % 3, i / 7) for i in range(200)], "n long, part long, x double")
    path = str(tmp_path / "t")
    assert tables.write_table(rows, path, partition_by=["part"], sort_by=["n"], floats=True) == 200
    assert tables.write_table(rows.where("n < 0"), str(tmp_path / "none")) == 0
    assert tables.write_table(rows.where("n < 50"), path, partition_by=["part"], mode="append", floats=True) == 250
    assert tables.write_table(rows, str(tmp_path / "new"), mode="append") == 200
    assert tables.write_table(rows.where("n < 9"), str(tmp_path / "new"), mode="overwrite") == 9
    monkeypatch.setattr(tables, "_rows_at", lambda *_: 251)  # as if rows had gone meanwhile
    with pytest.raises(ValueError, match="holds 260 rows, not 261"):
        tables.write_table(rows.where("n < 10"), path, partition_by=["part"], mode="append", floats=True)
