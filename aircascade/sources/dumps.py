"""Text dumps of events: from their lines to keyed tables."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import names, traces
from ..schema import BINS, EVENT, RAW_EVENT, RAW_HIT, SECTIONS, WAVEFORM_SIZE
from . import records
from .splits import opens, read_tagged, written


@dataclass(frozen=True)
class Dumps:
    """The four tables, and the files or lines that could not be used, with a reason."""

    events: DataFrame
    hits: DataFrame
    waveforms: DataFrame
    bad_detectors: DataFrame
    quarantine: DataFrame


def tagged_rows(rows: DataFrame, line: Column) -> DataFrame:
    """Rows (file_name, line_no, ...) of which ``line`` makes a dump's lines, with _section and _at (the event's number) beside their columns; markers are left out.

    What is dealt and sorted are the rows as they come: texts, which may be wider by far, aren't.
    """
    by_line = Window.partitionBy("file_name").orderBy("line_no")
    rows = rows.withColumn("_opens", opens(line)).withColumn("_section", F.last("_opens", ignorenulls=True).over(by_line))
    rows = rows.where("_opens is null and _section is not null")
    at = F.row_number().over(Window.partitionBy("file_name", "_section").orderBy("line_no")) - 1
    # No partition of a written table may have a null or empty name; Spark would see to that by a sort.
    return rows.withColumns({"_at": at, "_section": F.coalesce("_section", F.lit(""))}).drop("_opens")


def lines_of(rows: DataFrame, line: Column) -> DataFrame:
    """file_name, section, event_idx, line of ``tagged_rows``."""
    # In two steps: ``line`` may be made of a column event_idx, and would take the new one for it.
    return rows.select("file_name", "_section", "_at", line.alias("line")).withColumnsRenamed({"_section": "section", "_at": "event_idx"})


def tagged(lines: DataFrame) -> DataFrame:
    """file_name, section, event_idx, line: marker lines open a section, and its lines are numbered from 0."""
    return lines_of(tagged_rows(lines, F.col("line")), F.col("line"))


def disagreeing(sections: DataFrame) -> DataFrame:
    """file_name, reason of files whose sections differ in length; missing trailing bad-detector lines count as empty."""
    n = sections.groupBy("file_name").agg(*[F.count_if(F.col("section") == s).alias(s) for s in SECTIONS.values()])
    wrong = (F.col("hit") != F.col("event")) | (F.col("waveform") != F.col("event")) | (F.col("bad") > F.col("event"))
    return n.where(wrong).select("file_name", F.format_string("section lengths differ: event %d, hit %d, waveform %d, bad %d", "event", "hit", "waveform", "bad").alias("reason"))


def event_rows(rows: DataFrame) -> DataFrame:
    """Event lines (key, line) to one column for each of the 61 numbers."""
    v = rows.select(*EVENT, traces.numbers(F.col("line")).alias("v"))
    return v.select(*EVENT, *[F.get("v", i).alias(name) for i, name in enumerate(RAW_EVENT)])


def cut_records(rows: DataFrame, size: int, index: str, kind: str = "double") -> DataFrame:
    """Lines (key, line) to rows (key, ``index``, record); lines that don't divide into records give none."""
    v = rows.select(*EVENT, traces.numbers(F.col("line"), kind).alias("v"))
    # Not a filter: Spark would move it in front of the numbers and compute them twice.
    return v.select(*EVENT, F.posexplode(F.when(traces.whole_records(F.col("v"), size), traces.records(F.col("v"), size))).alias(index, "record"))


def hit_rows(rows: DataFrame) -> DataFrame:
    """Hit lines (key, line) to a row a hit; lines that don't divide into records give none.

    A record's numbers are taken from the line's by their place: they are few, and cutting records out costs more than carrying them.
    """
    size = len(RAW_HIT)
    v = rows.select(*EVENT, traces.numbers(F.col("line")).alias("v"))
    # Not a filter: Spark would move it in front of the numbers and compute them twice.
    at = F.when(traces.whole_records(F.col("v"), size) & (F.size("v") > 0), F.sequence(F.lit(0), (F.size("v") / size).cast("int") - 1))
    r = v.select(*EVENT, "v", F.explode(at).alias("hit_idx"))
    return r.select(*EVENT, "hit_idx", *[F.get("v", F.col("hit_idx") * size + i).cast(kind).alias(name) for i, (name, kind) in enumerate(RAW_HIT.items())])


def waveform_rows(rows: DataFrame) -> DataFrame:
    """Waveform lines (key, line) to a row a waveform; lines that don't divide into records give none.  The numbers, nearly all of a dump's, are cut in Arrow batches."""
    out = f"file_name string, event_idx {rows.schema['event_idx'].dataType.simpleString()}, wf_idx int, xxyy int, clkcnt int, mclkcnt int, fadc_low array<int>, fadc_up array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in records.chunks(batch):
                m, line, place = records.whole_records(part.column("line"), WAVEFORM_SIZE)
                key = [part.column(c).take(pa.array(line)) for c in EVENT]
                numbers = [pa.array(place.astype(np.int32)), *(pa.array(np.ascontiguousarray(m[:, i])) for i in range(3))]
                layers = [records.lists(m[:, 3 + i : 3 + i + BINS]) for i in (0, BINS)]
                yield pa.RecordBatch.from_arrays([*key, *numbers, *layers], [*EVENT, "wf_idx", "xxyy", "clkcnt", "mclkcnt", "fadc_low", "fadc_up"])

    return rows.select(*EVENT, "line").mapInArrow(run, out)


def bad_rows(rows: DataFrame) -> DataFrame:
    r = cut_records(rows, 2, "bad_idx", "int")
    return r.select(*EVENT, F.get("record", 0).alias("xxyy"), F.get("record", 1).alias("bitf"))


def misshapen(rows: DataFrame, size: int, what: str) -> DataFrame:
    v = rows.withColumn("v", traces.numbers(F.col("line")))
    return v.where(~traces.whole_records(F.col("v"), size)).select("file_name", F.format_string(f"event %d: {what} line is no whole number of records", "event_idx").alias("reason"))


#: Numbers of an event line, and of a record in the lines of other sections.
SIZES = {"event": len(RAW_EVENT), "hit": len(RAW_HIT), "waveform": WAVEFORM_SIZE, "bad": 2}


def odd_lines(rows: DataFrame) -> DataFrame:
    """file_name, section, event_idx, odd of tagged lines: whether a line is no whole number of records, or no event.  Numbers are counted in Arrow batches."""
    out = f"file_name string, section string, event_idx {rows.schema['event_idx'].dataType.simpleString()}, odd boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in records.chunks(batch):
                line, section = part.column("line"), part.column("section")
                n, odd = records.counts(line), np.zeros(len(line), bool)
                for name, size in SIZES.items():
                    here = np.array(section.to_numpy(zero_copy_only=False) == name)
                    odd |= here & (n != size if name == "event" else n % size != 0)
                odd &= line.is_valid().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([part.column("file_name"), section, part.column("event_idx"), pa.array(odd)], ["file_name", "section", "event_idx", "odd"])

    return rows.select("file_name", "section", "event_idx", "line").mapInArrow(run, out)


def faulty_files(rows: DataFrame) -> DataFrame:
    """file_name, reason of files that can't be used, in one pass over their tagged lines."""
    first = F.min(F.when(F.col("odd"), F.struct("event_idx", "section")))
    per = odd_lines(rows).groupBy("file_name").agg(*[F.count_if(F.col("section") == s).alias(s) for s in SIZES], first.alias("odd"))
    differ = (F.col("hit") != F.col("event")) | (F.col("waveform") != F.col("event")) | (F.col("bad") > F.col("event"))
    lengths = F.format_string("section lengths differ: event %d, hit %d, waveform %d, bad %d", *SIZES)
    shape = F.format_string("event %d: %s line is no whole number of records", "odd.event_idx", "odd.section")
    return per.where(differ | F.col("odd").isNotNull()).select("file_name", F.when(differ, lengths).otherwise(shape).alias("reason"))


def parse(lines: DataFrame, strict: bool = False) -> Dumps:
    """Lines (file_name, line_no, line) to tables; ``strict`` raises on the first bad file instead of leaving it out."""
    return parse_tagged(tagged(lines), strict)


def parse_tagged(rows: DataFrame, strict: bool = False) -> Dumps:
    """Tagged lines (file_name, section, event_idx, line) to tables.

    Each table is a plan of its own over the lines, so jobs that need several of
    them stage the lines first (``staged``).  The lines are checked at once, and once for all tables.
    """
    wrong = written(faulty_files(rows), "faulty")
    if strict and (first := wrong.first()):
        raise ValueError(f"{first.file_name}: {first.reason}")
    good = rows.join(wrong.select("file_name"), "file_name", "left_anti")
    pick = lambda s: good.where(F.col("section") == s)
    return Dumps(event_rows(pick("event")), hit_rows(pick("hit")), waveform_rows(pick("waveform")), bad_rows(pick("bad")), wrong)


def read_dumps(spark: SparkSession, paths: str | list[str], strict: bool = False) -> Dumps:
    """The tables of dump files, which are read by splits: a file may have any size."""
    return parse_tagged(read_tagged(spark, paths), strict)


def staged(rows: DataFrame, path: str) -> DataFrame:
    """Tagged lines written once below ``path``, a folder a section, and read back: a table then reads the lines of its section only."""
    rows.write.partitionBy("section").option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def staged_rows(rows: DataFrame, line: Column, path: str) -> DataFrame:
    """``staged`` lines of tagged rows, which are put in the order of their sections and events before they are made lines."""
    return staged(lines_of(rows.sortWithinPartitions("_section", "file_name", "_at"), line), path)


def with_name_ids(events: DataFrame, datasets: DataFrame | None = None) -> DataFrame:
    """Add id_event (dense within the file) and what the file's name carries; with ``datasets`` (dir, id_data_set) that id too."""
    name = names.base_name(F.col("file_name"))
    dense = F.row_number().over(Window.partitionBy("file_name").orderBy("event_idx")) - 1
    out = events.withColumns({"id_event": dense.cast("long"), "id_corsika_shower": names.shower_id(name), "id_energy_bin": names.energy_bin(name), "ta_obs_date": names.observation_date(name)})
    if datasets is not None:
        out = out.withColumn("dir", names.directory(F.col("file_name"))).join(datasets, "dir", "left").drop("dir")
    return out


def text_of(record: Column) -> Column:
    """An array of numbers as a line of a dump."""
    return F.array_join(F.transform(record, lambda x: x.cast("string")), " ")
