"""Deterministic samples and leak-free train/test sets.

Random order is that of an md5 of the event's key and a seed, with the key to
break ties, so a sample doesn't depend on how rows are split or sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import EVENT

TEST_FRACTION, SMALL_TEST, SMALL_TRAIN = 0.2, 0.25, 0.1
MAX_TRAIN, MAX_TEST = 20, 4


def random_order(key: list[str], seed: int) -> list[Column]:
    return [F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed)))), *[F.col(k) for k in key]]


def pick_random(events: DataFrame, n: int | None, seed: int = 1, condition: Column | None = None, event: list[str] = EVENT) -> DataFrame:
    """Up to n random events (all without a limit)."""
    rows = events if condition is None else events.where(condition)
    return rows if n is None else rows.orderBy(*random_order(event, seed)).limit(n)


def pick_per_stratum(events: DataFrame, strata: list[str], n: int | None, seed: int = 1, condition: Column | None = None, event: list[str] = EVENT) -> DataFrame:
    """Up to n random events of each stratum."""
    rows = events if condition is None else events.where(condition)
    if n is None:
        return rows
    w = Window.partitionBy(*strata).orderBy(*random_order(event, seed))
    return rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def _placed(picked: DataFrame, strata: list[str], event: list[str]) -> DataFrame:
    of = Window.partitionBy(*strata)
    return picked.withColumns({"_k": F.row_number().over(of.orderBy(*event)) - 1, "_n": F.count("*").over(of)})


def _part(rows: DataFrame, condition: Column, split: str) -> DataFrame:
    return rows.where(condition).withColumn("split", F.lit(split))


def split_train_test(picked: DataFrame, strata: list[str], event: list[str] = EVENT) -> DataFrame:
    """Add ``split``: in key order the first are train, the last fifth test; the first of each are also small_train and small_test."""
    rows = _placed(picked, strata, event)
    rows = rows.withColumn("_test", F.floor(F.col("_n") * F.lit(TEST_FRACTION)))
    rows = rows.withColumn("_train", F.col("_n") - F.col("_test"))
    first = lambda n, fraction: F.greatest(F.floor(n * F.lit(fraction)), F.lit(1))
    k, train, test = F.col("_k"), F.col("_train"), F.col("_test")
    # One pass: a row's splits as an array.
    splits = F.array(
        F.when(k < train, "train"), F.when(k < F.greatest(F.floor(train / 10), F.lit(1)), "small_train"),
        F.when(k >= train, "test"), F.when((k >= train) & (k < train + first(test, SMALL_TEST)), "small_test"),
    )
    return rows.withColumn("split", F.explode(F.array_compact(splits))).drop("_k", "_n", "_test", "_train")


def large_small(picked: DataFrame, strata: list[str], name: str, fraction: float, event: list[str] = EVENT) -> DataFrame:
    """All picked as ``name``, and the first in key order also as ``small_<name>``."""
    rows = _placed(picked, strata, event)
    small = F.col("_k") < F.greatest(F.floor(F.col("_n") * F.lit(fraction)), F.lit(1))
    return rows.withColumn("split", F.explode(F.array_compact(F.array(F.lit(name), F.when(small, f"small_{name}"))))).drop("_k", "_n")


def any_tiles(events: DataFrame, full_train: DataFrame, strata: list[str], seed: int = 1, max_train: int = MAX_TRAIN, max_test: int = MAX_TEST, event: list[str] = EVENT) -> DataFrame:
    """Test events that full-tile training hasn't seen; train events from what isn't in this test set."""
    key = full_train.select(*event).distinct()
    test = pick_per_stratum(events.join(key, event, "left_anti"), strata, max_test, seed, event=event)
    train = pick_per_stratum(events.join(test.select(*event), event, "left_anti"), strata, max_train, seed, event=event)
    return large_small(test, strata, "test", SMALL_TEST, event).unionByName(large_small(train, strata, "train", SMALL_TRAIN, event))


def tile_types(events: DataFrame, strata: list[str], max_train: int = MAX_TRAIN, max_test: int = MAX_TEST, seed: int = 1, event: list[str] = EVENT) -> DataFrame:
    """event, strata, full, tile_type, split of events with a boolean ``full``."""
    rows = events.select(*dict.fromkeys([*event, *strata, "full"]))
    both = max_train + max_test
    full = split_train_test(pick_per_stratum(rows, strata, both, seed, F.col("full"), event), strata, event)
    part = split_train_test(pick_per_stratum(rows, strata, both, seed, ~F.col("full"), event), strata, event)
    rest = any_tiles(rows, full.where("split = 'train'"), strata, seed, max_train, max_test, event)
    named = lambda df, t: df.withColumn("tile_type", F.lit(t))
    return named(full, "full_tiles").unionByName(named(part, "partial_tiles")).unionByName(named(rest, "any_tiles"))


def split_report(picked: DataFrame) -> DataFrame:
    """tile_type, split, n, full_fraction."""
    return picked.groupBy("tile_type", "split").agg(F.count("*").alias("n"), F.avg(F.col("full").cast("double")).alias("full_fraction"))


def overlap(a: DataFrame, b: DataFrame, event: list[str] = EVENT) -> DataFrame:
    """Events of both sets."""
    return a.select(*event).distinct().join(b.select(*event), event, "left_semi")


def subtract(a: DataFrame, b: DataFrame, event: list[str] = EVENT, strict: bool = False) -> DataFrame:
    """Events of a that aren't in b; ``strict`` demands that b is a part of a."""
    if strict and not b.join(a.select(*event), event, "left_anti").isEmpty():
        raise ValueError("the events to take away are no subset")
    return a.join(b.select(*event), event, "left_anti")
