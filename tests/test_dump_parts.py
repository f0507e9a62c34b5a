"""Dumps in compressed parts: parts are read as one dump in the order of their names, and text is made only where it is written."""

import gzip

from aircascade import queries, queries_whole
from aircascade.sources import splits


def test_sections_run_on_from_part_to_part(spark, tmp_path):
    parts = {"part-0.txt.gz": "EVENT DATA\na\nb\n", "part-1.txt.gz": "c\nSD meta DATA\n", "part-2.txt.gz": "d\n\ne\n"}
    for name, text in parts.items():
        (tmp_path / "x").mkdir(exist_ok=True)
        (tmp_path / "x" / name).write_bytes(gzip.compress(text.encode()))
    got = splits.read_tagged(spark, str(tmp_path / "x"), parts=True).collect()
    assert sorted((r.section, r.event_idx, r.line) for r in got) == [("event", 0, "a"), ("event", 1, "b"), ("event", 2, "c"), ("hit", 0, "d"), ("hit", 1, ""), ("hit", 2, "e")]
    assert {r.file_name.rsplit("/", 1)[1] for r in got} == {"x"}


def test_rows_of_a_dump_hold_no_text(spark):
    assert queries.QUERIES["split_dump_tables"]
    rows = queries_whole.dump_rows(spark, "/root/testdata/sf0.001")
    assert "array_join" not in rows._jdf.queryExecution().optimizedPlan().toString() and "line" not in rows.columns
