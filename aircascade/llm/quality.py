"""Quality rules with a host-level verdict; DataFrame functions only.

Every text gets its counts and the base rules.  The failures are then summed by
host (``source``), each host's failure rate is shrunk towards the corpus by a
beta prior fitted to all hosts by moments, and a host whose shrunken rate is
above ``reject_rate`` takes its other documents down with it.

Defined results: a null text has no words, so it fails; a null host is a host of
its own; rows with a null or repeated doc_id are judged one by one; a very long
text is judged as a whole, as one array of words in one task; an empty table
gives no rows.  ``judged`` replaces input columns that clash with the added ones;
``kept_rows`` leaves all columns as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, stored, words

#: Fixed values of the base rules.
LEAST_WORDS, MOST_REPEATED_PERCENT, WINDOW = 50, 50, 3
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeated(hashes: Column) -> Column:
    """How many words stand in windows found twice or more, given the windows' hashes in order."""
    order = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(s: Column) -> Column:
        same = F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]))
        return F.size(F.array_distinct(F.flatten(F.transform(same, lambda x: F.sequence(x["i"], x["i"] + WINDOW - 1)))))

    # One pass binds the sorted array to a name, so it is sorted once.
    return F.aggregate(F.array(order), F.lit(0), lambda _, s: places(s))


def counted(docs: DataFrame) -> DataFrame:
    """Add the counts and ``base_failed`` to every row."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(WORD)))
    windows = F.transform(F.col("_words"), lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)))
    out = docs.drop(*COUNTS, "base_failed", "kept", "_words", "_windows", "_lines")
    out = out.withColumns({"_words": words(F.col("text")), "_lines": lines})
    out = out.withColumns({"n_words": F.size("_words").cast("long"), "_windows": F.slice(windows, 1, F.greatest(F.size("_words") - (WINDOW - 1), F.lit(0)))})
    out = out.withColumns(
        {
            "word_chars": F.length(F.translate(text, SPACES, "")).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), _repeated(F.col("_windows"))).otherwise(0).cast("long"),
        }
    ).drop("_words", "_windows", "_lines")
    return out.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")))


def rejected_hosts(rows: DataFrame, reject_rate: float) -> DataFrame:
    """Hosts whose shrunken failure rate is above ``reject_rate``, of rows with ``source`` and ``base_failed``."""
    hosts = rows.groupBy("source").agg(F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("f"))
    # One row of sums: the prior's two numbers.
    s = hosts.agg(F.count("*").alias("h"), F.sum("n").alias("n"), F.sum("f").alias("f"), F.sum(F.col("f") * F.col("f") / F.col("n")).alias("ff")).first()
    mean = (s.f / s.n) if s.n else 0.0
    # The spread of the hosts' rates, less what chance alone makes of one common rate.
    spread = (s.ff / s.n - mean * mean - (s.h - 1) * mean * (1 - mean) / s.n) if s.n else 0.0
    weight = max(mean * (1 - mean) / spread - 1, 0.0) if spread > 1e-12 else 1e9
    return hosts.where((F.col("f") + mean * weight) / (F.col("n") + weight) > reject_rate).select("source", F.lit(True).alias("_rejected"))


def judged(docs: DataFrame, reject_rate: float = 0.5, keep: list[str] | None = None) -> DataFrame:
    """All columns of ``docs`` (or those of ``keep``) with the counts, ``base_failed`` and ``kept``.

    The counted rows are written once, as the hosts' sums and the verdict both need them.
    """
    rows = counted(docs)
    rows = stored(rows.select(*keep, *COUNTS, "base_failed") if keep else rows, "quality")
    # Written, so that Spark knows its size: a short list is broadcast and no text moves, a long one is joined by shuffle.
    bad = stored(rejected_hosts(rows, reject_rate), "hosts")
    at = rows.drop("_rejected").join(bad.withColumnRenamed("source", "_host"), F.col("source").eqNullSafe(F.col("_host")), "left").drop("_host")
    return at.withColumn("kept", ~F.col("base_failed") & F.col("_rejected").isNull()).drop("_rejected")


def kept_rows(docs: DataFrame, reject_rate: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns.  Rows that fail the base rules are written without their columns."""
    whole = docs.select(F.struct("*").alias("row"))
    rows = counted(whole.select("row", "row.text", "row.source"))
    rows = stored(rows.select(F.when(~F.col("base_failed"), F.col("row")).alias("row"), "source", "base_failed"), "quality")
    bad = stored(rejected_hosts(rows, reject_rate), "hosts")
    good = rows.where("not base_failed").select("row")
    return good.join(bad, F.col("row.source").eqNullSafe(bad["source"]), "left_anti").select("row.*")


def sql(reject_rate: float = 0.5) -> str:
    """The verdicts of ``documents`` in DuckDB's SQL."""
    return rf"""
WITH w AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
tri AS (SELECT doc_id, i, (ws[i], ws[i + 1], ws[i + 2]) AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
f AS (SELECT w.doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
  CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN rep ON w.doc_id = rep.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
h AS (SELECT source, count(*) AS n, CAST(sum(CAST(base_failed AS INTEGER)) AS BIGINT) AS f FROM b GROUP BY source),
r AS (SELECT sum(f) / sum(n) AS m, sum(CAST(f * f AS DOUBLE) / n) / sum(n) AS ff, count(*) AS h, sum(n) AS n FROM h),
s AS (SELECT m, ff - m * m - (h - 1) * m * (1 - m) / n AS v FROM r),
k AS (SELECT m, CASE WHEN v > 1e-12 THEN greatest(m * (1 - m) / v - 1, 0) ELSE 1e9 END AS w FROM s),
bad AS (SELECT source FROM h, k WHERE (f + m * w) / (n + w) > {reject_rate})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT EXISTS (SELECT 1 FROM bad WHERE bad.source IS NOT DISTINCT FROM b.source) AS kept
FROM b"""
