"""Incremental ingest: each run takes the dumps that no run took before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.dumps import parse_tagged
from ..sources.splits import placed, split_columns, tagged_splits

TABLES = ["events", "hits", "waveforms", "bad_detectors", "quarantine"]


def ingest(spark: SparkSession, source: str, out: str, checkpoint: str, glob: str = "*", files_per_batch: int = 1000) -> None:
    """Read new dumps below ``source`` once and append their tables below ``out``.

    The checkpoint knows the files that are done.  A batch is written under its
    number, so a batch that is run again after a failure replaces what it had
    written and nothing comes twice.
    """
    files = spark.readStream.format("text").option("lineSep", "\n").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_batch).load(source)
    files = split_columns(files)

    def write(batch: DataFrame, number: int) -> None:
        lines = tagged_splits(placed(batch)).persist()  # five tables come from the same lines
        tables = parse_tagged(lines)
        for name in TABLES:
            getattr(tables, name).write.mode("overwrite").parquet(f"{out}/{name}/batch={number}")
        lines.unpersist()

    files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
