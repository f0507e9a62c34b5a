"""Audit of a chain of filters: what each would remove at each place of each order.

A document's five verdicts make one of 32 patterns.  Counting documents by part
and pattern is all that grows with the corpus; what follows works on tensors.

1. One pass over the texts gives narrow rows: id, part, the verdicts that depend on
   the text alone, and the text's SHA-256, by which exact copies are found.
2. Copies learn the smallest doc_id of their text, documents their labels; both
   joins are salted, as one text or one id may have a third of all rows.
3. Documents, good ones and toxic ones are counted by part and pattern.
4. A part's counts are reshaped to 2 x 2 x 2 x 2 x 2, an axis a filter (0 passes, 1
   fails).  A step of an order takes pass, fail or all along each axis: earlier
   filters pass, its own fails, later ones are summed over.  One einsum does that
   for all steps of all orders, in whole numbers.

Defined results: a null text is empty; null and empty sources are one part, the
empty string.  Texts are the same if their SHA-256 is (no collision is known).  Rows
that share a doc_id aren't earlier than each other; a null doc_id is neither earlier
nor later than any, and has no labels.  A document with several labels is good (toxic)
if one of them says so.  Very long texts count whole, like any other.  Without
documents there are no rows; without labels nothing is good or toxic.  Columns other
than doc_id, text and source are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import salted_join, stored, words

#: The filters, in the order of the tensor's axes.
FILTERS = "ABCDE"
MEASURES = ["n", "good", "toxic"]
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
#: Parts whose tensors are contracted at once.
PARTS = 32


def text_verdicts(text: Column, ws: Column) -> Column:
    """Bits 0 to 3: the filters A to D fail; ``ws`` are the text's words."""
    n, distinct = F.size(ws), F.size(F.array_distinct(ws))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [n < 200, 100 * distinct < 50 * n, 100 * capitals > 2 * F.length(text), F.rlike(text, F.lit(r"[#$%&*|]"))]
    bits = [F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, pattern (bit k: filter k fails), good, toxic of every document."""
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("words", words(F.col("text")))
    rows = stored(rows.select("doc_id", "part", text_verdicts(F.col("text"), F.col("words")).alias("bits"), F.unhex(F.sha2("text", 256)).alias("same")), "verdicts")
    first = rows.groupBy("same").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("same", "first")
    rows = salted_join(rows, first, "same", "left")
    said = labels.where("quality = 1 or toxic = 1").groupBy("doc_id").agg(*[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(to) for c, to in (("quality", "good"), ("toxic", "toxic"))])
    rows = salted_join(rows, said, "doc_id", "left")
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return rows.select("part", (F.col("bits") + F.when(later, 16).otherwise(0)).alias("pattern"), zero("good"), zero("toxic"))


def tensors(rows: DataFrame) -> DataFrame:
    """part and its counts: a row (pattern, n, good, toxic) for each of at most 32 patterns."""
    n = rows.groupBy("part", "pattern").agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    return n.groupBy("part").agg(F.collect_list(F.struct("pattern", *MEASURES)).alias("counts"))


def steps() -> tuple[list[str], np.ndarray, np.ndarray]:
    """All orders, and for each of their steps the filter and the earlier ones (a truth value an axis)."""
    orders = ["".join(p) for p in permutations(FILTERS)]
    at = np.array([[FILTERS.index(f) for f in o] for o in orders]).reshape(-1)
    place = np.array([[o.index(f) for f in FILTERS] for o in orders])
    earlier = place[:, None, :] < np.arange(len(FILTERS))[None, :, None]
    return orders, at, earlier.reshape(-1, len(FILTERS))


def contracted(counts: np.ndarray) -> dict[str, np.ndarray]:
    """The audit's counts, parts x steps, of tensors parts x measures x 2 x 2 x 2 x 2 x 2."""
    _, own, earlier = steps()
    passes, fails, all_ = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])
    mine = np.arange(len(FILTERS)) == own[:, None]

    def take(before: np.ndarray, here: np.ndarray, after: np.ndarray, measures: int = 1) -> np.ndarray:
        """Contract all axes: by ``before`` those of earlier filters, by ``here`` the step's own, by ``after`` the others."""
        s = np.where(earlier[:, :, None], before, np.where(mine[:, :, None], here, after)).astype(np.int64)
        return np.einsum("pmabcde,ka,kb,kc,kd,ke->pmk", counts[:, :measures], *(s[:, axis] for axis in range(len(FILTERS))))

    lost = take(passes, fails, all_, measures=3)
    removed = lost[:, 0]
    failing = take(all_, fails, all_)[:, 0]
    share = np.zeros((len(counts), len(FILTERS)), np.int64)
    for f in range(len(FILTERS)):
        share[:, f] = removed[:, own == f].sum(axis=1)
    return {
        "kept": take(passes, passes, all_)[:, 0], "removed": removed, "redundant": failing - removed, "unique_fails": take(passes, fails, passes)[:, 0],
        "good_lost": lost[:, 1], "toxic_lost": lost[:, 2], "shapley": share[:, own],
    }


def contraction(parts: DataFrame) -> DataFrame:
    """part, filter_order, step and the counts, 600 rows a part."""
    orders, _, _ = steps()
    depth = len(FILTERS)
    order, step = np.repeat(orders, depth), np.tile(np.arange(1, depth + 1), len(orders)).astype(np.int32)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, PARTS):
                part, rows = b.column(0).slice(k, PARTS), b.column(1).slice(k, PARTS).to_pylist()
                flat = np.zeros((len(rows), len(MEASURES), 1 << depth), np.int64)
                for i, row in enumerate(rows):
                    for r in row:
                        flat[i, :, r["pattern"]] = [r[m] for m in MEASURES]
                # The highest bit is the first axis of a reshape, so axes are turned round to stand in the filters' order.
                counts = flat.reshape(len(rows), len(MEASURES), *[2] * depth).transpose(0, 1, *range(depth + 1, 1, -1))
                found = contracted(counts)
                columns = [part.take(pa.array(np.repeat(np.arange(len(rows)), len(step)))), pa.array(np.tile(order, len(rows))), pa.array(np.tile(step, len(rows)))]
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array(found[c].reshape(-1)) for c in COUNTS)], ["part", "filter_order", "step", *COUNTS])

    return parts.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of ``docs`` (doc_id, text, source) with ``labels`` (doc_id, quality, toxic)."""
    return contraction(tensors(verdicts(docs, labels)))


#: The same audit in DuckDB's SQL: counts by part and pattern meet the 600 steps.
SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
v AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
  [len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws), 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 2 * length(text), regexp_matches(text, '[#$%&*|]'),
   coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY text), false)] AS f FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
c AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM v GROUP BY part, f),
x(k) AS (SELECT unnest([1, 2, 3, 4, 5])),
o AS (SELECT [a.k, b.k, c.k, d.k, e.k] AS p FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
s AS (SELECT p, array_to_string(list_transform(p, lambda k: 'ABCDE'[k]), '') AS filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM o),
j AS (SELECT part, filter_order, step, p[step] AS own, n, good, toxic, f[p[step]] AS fails, list_bool_or(list_transform(p[1:step - 1], lambda k: f[k])) AS gone,
  len(list_filter(f, lambda y: y)) AS n_fails FROM c, s),
r AS (SELECT part, filter_order, step, own, sum(CASE WHEN NOT coalesce(gone, false) AND NOT fails THEN n ELSE 0 END) AS kept, sum(CASE WHEN NOT coalesce(gone, false) AND fails THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN coalesce(gone, false) AND fails THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails AND n_fails = 1 THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN NOT coalesce(gone, false) AND fails THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN NOT coalesce(gone, false) AND fails THEN toxic ELSE 0 END) AS toxic_lost
  FROM j GROUP BY part, filter_order, step, own)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r"""
