"""The filter audit against DuckDB and against filters applied one after the other."""

import re
from itertools import permutations

import duckdb
from aircascade.llm import audit

from .helpers import documents, odd_texts, rows_of

LABELS = "doc_id long, quality int, toxic int, text string"
COLUMNS = ["part", "filter_order", "step", *audit.COUNTS]


def labelled(spark, ids):
    rows = [(i, [1, 0, None][k % 3], [0, None, 1, 1][k % 4], "x") for k, i in enumerate(ids)]
    return spark.createDataFrame(rows + [(3, 1, 1, "again"), (None, 1, 1, "none"), (10**9, 1, 1, "far")], LABELS)


def brute(docs, labels):
    """Apply each order to the documents, filter by filter."""
    first, marks = {}, {}
    for r in docs:
        if r.doc_id is not None:
            first[r.text or ""] = min(first.get(r.text or "", r.doc_id), r.doc_id)
    for r in labels:
        good, toxic = marks.get(r.doc_id, (False, False))
        marks[r.doc_id] = (good or r.quality == 1, toxic or r.toxic == 1)
    rows = []
    for r in docs:
        text = r.text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        f = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text), "D": bool(re.search(r"[#$%&*|]", text))}
        f["E"] = r.doc_id is not None and text in first and first[text] < r.doc_id
        rows.append((r.source or "", f, *(marks.get(r.doc_id, (False, False)) if r.doc_id is not None else (False, False))))
    out, shapley = [], {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, c in enumerate(order, 1):
                gone, failing = [r for r in left if r[1][c]], [r for r in mine if r[1][c]]
                left = [r for r in left if not r[1][c]]
                shapley[part, c] = shapley.get((part, c), 0) + len(gone)
                out.append([part, order, step, len(left), len(gone), len(failing) - len(gone), sum(sum(r[1].values()) == 1 for r in failing), sum(r[2] for r in gone), sum(r[3] for r in gone)])
    return sorted((tuple([*r, shapley[r[0], r[1][r[2] - 1]]]) for r in out), key=repr)


def in_duckdb(docs, labels):
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    con.register("labels", labels.toArrow())
    return sorted(con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({audit.SQL})").fetchall(), key=repr)


def test_equals_sql_and_filters_in_turn(spark):
    texts = odd_texts() + ["A B C " * 80, "SHOUT " * 250, "price 5$ " + " ".join(f"w{i}" for i in range(250)), "", None, "A B C " * 80]
    ids = list(range(len(texts)))
    ids[5], ids[20], ids[21] = 4, None, 19  # a repeated and a missing id
    docs, labels = documents(spark, texts, ids), labelled(spark, [i for i in ids if i is not None])
    got = rows_of(audit.audited(docs, labels).select(COLUMNS))
    assert got == in_duckdb(docs, labels)
    assert got == brute(docs.collect(), labels.collect())
    assert len(got) == 600 * len({r[0] for r in got}) and any(r[0] == "" for r in got)


def test_steps_of_an_order_add_up(spark):
    docs = documents(spark)
    rows = audit.audited(docs, labelled(spark, range(10))).collect()
    n = {r["part"]: r["n"] for r in docs.selectExpr("coalesce(source, '') as part").groupBy("part").count().withColumnRenamed("count", "n").collect()}
    for r in rows:
        before = n[r.part] if r.step == 1 else next(x.kept for x in rows if (x.part, x.filter_order, x.step) == (r.part, r.filter_order, r.step - 1))
        assert r.kept + r.removed == before


def test_hot_text_and_null_and_empty_source_are_one_part(spark):
    rows = [(i, "same text", [None, ""][i % 2]) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = audit.audited(docs, spark.createDataFrame([], LABELS)).where("filter_order = 'EABCD'").orderBy("step").collect()
    assert [r.part for r in got] == [""] * 5 and got[0].removed == 499 and got[1].removed == 1 and {r.good_lost for r in got} == {0}


def test_empty_tables(spark):
    assert audit.audited(documents(spark, []), labelled(spark, [1])).count() == 0
