"""Quality rules and source mixing against DuckDB and plain Python."""

import re
from collections import Counter, defaultdict

import duckdb
import pytest
from aircascade.llm import chat, minhash, mixing, quality

from .helpers import documents, odd_texts


def in_duckdb(df, sql, name="documents"):
    t = df.toArrow()
    con = duckdb.connect()
    con.register(name, t)
    return sorted(con.sql(sql).fetchall(), key=repr)


def test_quality_equals_sql(spark):
    docs = documents(spark)
    got = quality.judged(docs).select("doc_id", *quality.COUNTS, "base_failed", "kept")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == in_duckdb(docs, quality.sql())


def test_repeat_counts():
    def brute(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        c = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        return len({i + k for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for k in range(3)})

    assert brute("a b c a b c d") == 6 and brute("a b") == 0


def test_bad_host_takes_its_documents_down(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, good if i % 10 == 0 else "short", "bad") for i in range(100)] + [(100 + i, good, "fine") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id for r in quality.judged(docs).where("kept").collect()}
    assert kept == set(range(100, 200))


def test_quality_empty(spark):
    assert quality.judged(documents(spark, [])).count() == 0


def test_mix_equals_sql(spark):
    docs = documents(spark)
    got = mixing.mixed(docs)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == in_duckdb(docs, f"SELECT doc_id, size, source_size, target, taken FROM ({mixing.SQL})")


def test_targets_and_totals(spark):
    rows = [(i, "w " * (1 + i % 50), ["a", "b", "c", None][i % 4] if i % 3 else "hot") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixed(docs).collect()
    taken, target, size = defaultdict(int), {}, defaultdict(int)
    for r in got:
        s = rows[r.doc_id][2]
        taken[s] += r.taken
        target[s] = r.target
        size[s] += r.size
        assert r.taken <= 3 * r.size
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    for s, t in target.items():
        assert abs(taken[s] - t) <= 50 and t <= 3 * size[s] + 1e-6
    again = mixing.mixed(docs.repartition(7)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    n = Counter(r.doc_id for r in mixing.repeated(docs).collect())
    assert all(n[r.doc_id] * r.size == r.taken for r in got)


def test_mix_null_and_repeated_ids_and_empty(spark):
    docs = documents(spark, ["a b", "a b", None, "c"], [1, 1, None, None])
    got = mixing.mixed(docs).collect()
    assert len(got) == 4 and len({r.taken for r in got if r.doc_id == 1}) == 1
    assert mixing.mixed(documents(spark, [])).count() == 0
    assert mixing.repeated(documents(spark, [])).count() == 0


def test_empty_texts_keep_the_cap(spark):
    """A source that is wanted three times in whole gives each of its documents three times, those of size 0 too."""
    rows = [(i, ["", None, "w"][i % 3], "small") for i in range(60)] + [(100 + i, "w " * 500, "large") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    n = Counter(r.doc_id for r in mixing.repeated(docs).collect())
    assert max(n.values()) <= 3 and {n[i] for i in range(60)} == {3}


def test_near_duplicates_and_chats_equal_sql(spark):
    docs = documents(spark)
    assert sorted((tuple(r) for r in minhash.near_duplicates(docs).collect()), key=repr) == in_duckdb(docs, minhash.SQL)
    from .test_chat import SCHEMA, conversations

    rows = spark.createDataFrame(conversations(), SCHEMA)
    got = sorted((tuple(r) for r in chat.round_trip(rows).collect()), key=repr)
    assert got == in_duckdb(rows, f"WITH c AS (SELECT * FROM conversations){chat.SQL}", "conversations")
