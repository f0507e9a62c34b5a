"""Registered queries of reading by splits, audited and indexed storage, passes of outputs, levels and quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import traces
from .operators import checks, profile
from .plans import datasets, jobs, projections
from .queries import DETECTORS, EVENTS, FOLDS, HITS, LAYOUT, NAMES, TILE, TRACES, bad, detectors, dump_lines, embeddings, event_lines, events, hits, name_table, query, waveforms
from .queries_whole import FOLDED, dump_line, dump_rows
from .schema import EVENT
from .sources import dumps, files, index, splits, storage, tables

# Dumps by splits


def written_dumps(lines: DataFrame, name: str) -> str:
    """Dump lines (file_name, line_no, line) as text files, one a dump; gives their folder."""
    path = tables.work_path(lines.sparkSession, name)
    order = lines.repartition("file_name").sortWithinPartitions("file_name", "line_no")
    order.select("file_name", F.col("line").alias("value")).write.partitionBy("file_name").text(path)
    return path


def written_parts(rows: DataFrame, line: Column, name: str, most: int = 20_000) -> str:
    """Dumps in parts of ``most`` lines, gzip files in the order of their names; gives their folder.

    Lines are made where they are written: what is dealt and sorted is ``rows`` (file_name, line_no, ...).
    """
    path = tables.work_path(rows.sparkSession, name)
    order = rows.repartitionByRange("file_name", "line_no").sortWithinPartitions("file_name", "line_no")
    order.select("file_name", line.alias("value")).write.partitionBy("file_name").option("compression", "gzip").option("maxRecordsPerFile", most).text(path)
    return path


def named(rows: DataFrame) -> DataFrame:
    return rows.withColumn("file_name", F.regexp_extract("file_name", "file_name=([^/]+)", 1))


@query(f"""WITH {EVENTS}, n AS (SELECT 'd' || (event_idx % 3) AS file_name, event_idx, row_number() OVER (PARTITION BY event_idx % 3 ORDER BY event_idx) - 1 AS line_no FROM events),
s AS (SELECT *, CASE (line_no // 40) % 4 WHEN 0 THEN 'event' WHEN 1 THEN 'hit' WHEN 2 THEN 'waveform' ELSE 'bad' END AS section FROM n WHERE line_no % 40 <> 0)
SELECT file_name, section, CAST(row_number() OVER (PARTITION BY file_name, section ORDER BY line_no) - 1 AS INTEGER) AS event_idx, CAST(event_idx AS VARCHAR) AS line FROM s""")
def split_section_tag(spark, d):
    """Sections and event numbers of text files that are read by splits: three dumps that grow with the table, in which sections open again and again."""
    path = written_dumps(dump_lines(spark, d, F.concat(F.lit("d"), (F.col("event_idx") % 3).cast("string"))), "split-lines")
    return named(splits.read_tagged(spark, path))


@query(f"""WITH {EVENTS}, {FOLDED}, e AS (SELECT file_name, event_idx, row_number() OVER (PARTITION BY event_idx % 2 ORDER BY file_name, event_idx) - 1 AS k FROM events),
h AS (SELECT event_idx, count(*) AS n_hits, round(sum(pulsa_up), 4) AS signal FROM hits GROUP BY event_idx), w AS (SELECT event_idx, count(*) AS n_waveforms, CAST(sum(xxyy) AS BIGINT) AS ids FROM wf GROUP BY event_idx)
SELECT 'd' || (e.event_idx % 2) AS file_name, CAST(k AS INTEGER) AS event_idx, coalesce(n_hits, 0) AS n_hits, coalesce(signal, 0) AS signal, coalesce(n_waveforms, 0) AS n_waveforms, coalesce(ids, 0) AS ids FROM e LEFT JOIN h ON e.event_idx = h.event_idx LEFT JOIN w ON e.event_idx = w.event_idx""")
def split_dump_tables(spark, d):
    """Two whole dumps with waveforms in compressed parts, read by splits and tagged once; levels are read back by section."""
    path = tables.work_path(spark, "staged")
    rows = dump_rows(spark, d, F.concat(F.lit("d"), (F.col("event_idx") % 2).cast("string")))
    lines = dumps.staged(splits.read_tagged(spark, written_parts(rows, dump_line(), "split-dumps"), parts=True), path)
    t = dumps.parse_tagged(lines)
    h = t.hits.groupBy(*EVENT).agg(F.count("*").alias("n_hits"), F.round(F.sum("pulsa_up"), 4).alias("signal"))
    w = t.waveforms.groupBy(*EVENT).agg(F.count("*").alias("n_waveforms"), F.sum("xxyy").alias("ids"))
    out = t.events.select(*EVENT).join(h, EVENT, "left").join(w, EVENT, "left").na.fill(0)
    return named(out)


# Storage


@query(f"""WITH {TRACES} SELECT vec_id, CAST(count(*) AS INTEGER) AS n, round(sum(x), 9) AS dense_sum, round(sum(CASE WHEN x > 0.25 THEN x ELSE 0 END), 9) AS thin_sum, CAST(sum(CASE WHEN x > 0.25 THEN k ELSE 0 END) AS BIGINT) AS places, 'thin' AS stored_sparse
FROM (SELECT vec_id, unnest(trace) AS x, unnest(range(len(trace))) AS k FROM traces) GROUP BY vec_id""")
def adaptive_storage(spark, d):
    """Traces, and their high bins alone, stored as each is smaller, audited, and restored."""
    path = tables.work_path(spark, "audited")
    rows = embeddings(spark, d).select("vec_id", "trace", F.transform("trace", lambda x: F.when(x > 0.25, x).otherwise(0.0)).alias("thin"))
    storage.write_audited(rows, path)
    sparse = ",".join(f.name for f in spark.read.parquet(path).schema if (f.metadata or {}).get(storage.SPARSE))
    back = storage.read_audited(spark, path)
    places = F.aggregate(F.transform("thin", lambda x, i: F.when(x != 0, i).otherwise(0)), F.lit(0).cast("long"), lambda a, x: a + x)
    return back.select("vec_id", F.size("trace").alias("n"), F.round(traces.total(F.col("trace")), 9).alias("dense_sum"), F.round(traces.total(F.col("thin")), 9).alias("thin_sum"), places.alias("places"), F.lit(sparse).alias("stored_sparse"))


def group_plan(rows: DataFrame) -> DataFrame:
    """output, inputs: files by their number's rest by 7."""
    name = F.format_string("temp_%05d", F.regexp_extract("file_name", r"(\d+)", 1).cast("int") % 7)
    return rows.select("file_name").distinct().groupBy(name.alias("output")).agg(F.collect_list("file_name").alias("inputs"))


_GROUPS = """g AS (SELECT event_idx, price, file_name, printf('temp_%05d', CAST(substr(file_name, 2) AS INTEGER) % 7) AS output FROM events)"""


@query(f"""WITH {EVENTS}, {_GROUPS} SELECT CAST(1 AS INTEGER) AS pass, output, count(*) AS n, CAST(count(DISTINCT file_name) AS INTEGER) AS n_inputs, round(sum(price), 2) AS total FROM g GROUP BY output
UNION ALL SELECT 2, 'part_' || (CAST(substr(output, 6) AS INTEGER) % 2), count(*), CAST(count(DISTINCT output) AS INTEGER), round(sum(price), 2) FROM g GROUP BY ALL""")
def group_passes(spark, d):
    """Files into group outputs, and those into larger ones, each pass one job."""
    path = tables.work_path(spark, "passes")
    e = events(spark, d).select(*EVENT, "price")
    jobs.run_pass(e, group_plan(e), f"{path}/1", file_rows=5000)
    second = jobs.as_inputs(jobs.outputs_of(spark, f"{path}/1"))
    part = F.concat(F.lit("part_"), (F.regexp_extract("input", r"temp_(\d+)", 1).cast("int") % 2).cast("string"))
    jobs.run_pass(second, second.select("input").distinct().groupBy(part.alias("output")).agg(F.collect_list("input").alias("inputs")), f"{path}/2", by="input", file_rows=5000)
    out = None
    for k in (1, 2):
        n = jobs.outputs_of(spark, f"{path}/{k}").groupBy("output").agg(F.count("*").alias("n"), F.round(F.sum("price"), 2).alias("total"))
        n = n.join(jobs.current(jobs.commits(spark, f"{path}/{k}")), "output").select(F.lit(k).alias("pass"), "output", "n", "n_inputs", "total")
        out = n if out is None else out.unionByName(n)
    return out


@query(f"""WITH {EVENTS}, {_GROUPS}, f AS (SELECT min(CAST(substr(file_name, 2) AS INTEGER)) AS k FROM g WHERE output = 'temp_00003'),
n AS (SELECT output, count(*) AS n FROM g, f WHERE file_name <> 'f' || coalesce(k, -1) GROUP BY output)
SELECT output, n, CASE WHEN output = 'temp_00003' THEN 2 ELSE 1 END AS n_commits, CAST(CASE WHEN output = 'temp_00003' THEN 2 ELSE 1 END AS INTEGER) AS last_run FROM n""")
def group_resume(spark, d):
    """A file leaves one group: the next run writes that group anew and no other; a third run writes nothing."""
    path = tables.work_path(spark, "resume")
    e = events(spark, d).select(*EVENT, "price")
    jobs.run_pass(e, group_plan(e), path)
    number = F.regexp_extract("file_name", r"(\d+)", 1).cast("int")
    least = e.where(number % 7 == 3).agg(F.min(number).alias("_k"))
    fewer = e.join(least, number == F.col("_k"), "left_anti")
    jobs.run_pass(fewer, group_plan(fewer), path)
    if jobs.run_pass(fewer, group_plan(fewer), path):
        raise ValueError("a run without changes wrote something")
    n = jobs.outputs_of(spark, path).groupBy("output").agg(F.count("*").alias("n"))
    return n.join(jobs.commits(spark, path).groupBy("output").agg(F.count("*").alias("n_commits"), F.max("run").alias("last_run")), "output")


@query(f"WITH {EVENTS}, g AS (SELECT file_name, event_idx, price, row_number() OVER (ORDER BY file_name, event_idx) - 1 AS gidx FROM events) SELECT * FROM g WHERE gidx >= 100 AND gidx < 5000")
def indexed_slice(spark, d):
    """The slice of ``global_index_slice`` from a stored table, of which only the files that hold it are opened."""
    path = tables.work_path(spark, "indexed")
    index.append_ordered(events(spark, d).select(*EVENT, "price"), path, EVENT, 32)
    return index.sliced_rows(spark, path, EVENT, 100, 5000).select(*EVENT, "price", "gidx")


@query(f"""WITH {EVENTS}, g AS (SELECT CAST(event_idx % 3 AS INTEGER) AS chunk, file_name, event_idx, row_number() OVER (ORDER BY event_idx % 3, file_name, event_idx) - 1 AS gidx FROM events)
SELECT chunk, count(*) AS n, min(gidx) AS start, max(gidx) + 1 AS stop FROM g GROUP BY chunk""")
def appended_offsets(spark, d):
    """Three chunks appended one after the other: the kept index gives what counting all anew gives."""
    path = tables.work_path(spark, "appended")
    for k in range(3):
        index.append_ordered(events(spark, d).select(*EVENT).where(F.col("event_idx") % 3 == k), path, EVENT, 4)
    i = index.index_of(spark, path)
    return i.groupBy("chunk").agg(F.sum("n").alias("n"), F.min("start").alias("start"), F.max(F.col("start") + F.col("n")).alias("stop"))


# Levels and quarantine


@query(f"""WITH {EVENTS}, {HITS}, {FOLDS} SELECT 'energies' AS "table", 'event' AS level, 'event' AS matches, count(*) AS n_rows FROM events UNION ALL SELECT 'pulses', 'hit', 'hit', count(*) FROM hits UNION ALL SELECT 'shapes', 'trace', 'trace', count(*) FROM folds
UNION ALL SELECT 'picked', NULL, '', count(*) FROM hits WHERE isgood > 4 UNION ALL SELECT 'nothing', NULL, '', 0""")
def field_levels(spark, d):
    """The levels of tables that don't tell theirs, by their rows in each file."""
    e, h, w = events(spark, d), hits(spark, d), waveforms(spark, d)
    unknown = {"energies": e.select("file_name", "price"), "pulses": h.select("file_name", "pulsa_up"), "shapes": w.select("file_name", "value"), "picked": h.where("isgood > 4").select("file_name"), "nothing": e.where("price < 0").select("file_name")}
    return profile.levels(unknown, {"event": e, "hit": h, "trace": w})


@query(f"""WITH {EVENTS}, {HITS}, {FOLDS}, wrong AS (SELECT DISTINCT file_name FROM events e WHERE event_idx % 3000 = 1234 AND EXISTS (SELECT 1 FROM hits h WHERE h.event_idx = e.event_idx)
  UNION SELECT DISTINCT file_name FROM folds WHERE event_idx % 4000 = 777),
l AS (SELECT 'events' AS level, file_name FROM events UNION ALL SELECT 'hits', file_name FROM hits WHERE NOT (event_idx % 3000 = 1234 AND hit_idx = 0) UNION ALL SELECT 'waveforms', file_name FROM folds WHERE NOT (event_idx % 4000 = 777 AND wf_idx = 0))
SELECT level, count(*) FILTER (WHERE file_name NOT IN (SELECT file_name FROM wrong)) AS kept, count(*) FILTER (WHERE file_name IN (SELECT file_name FROM wrong)) AS dropped FROM l GROUP BY level""")
def file_quarantine(spark, d):
    """Planted faults, a hit or a waveform that is missing, take their whole files out of all levels."""
    h, w = hits(spark, d), waveforms(spark, d)
    e = events(spark, d).join(h.groupBy(*EVENT).agg(F.count("*").alias("nhits")), EVENT, "left").select(*EVENT, F.coalesce("nhits", F.lit(0)).alias("nhits"))
    levels = {"events": e, "hits": h.where(~((F.col("event_idx") % 3000 == 1234) & (F.col("hit_idx") == 0))), "waveforms": w.where(~((F.col("event_idx") % 4000 == 777) & (F.col("wf_idx") == 0)))}
    kept = checks.without_files(levels, checks.faulty_files(*levels.values()))
    out = None
    for name, df in levels.items():
        n = df.agg(F.count("*").alias("n"), F.lit(0).alias("kept")).unionByName(kept[name].agg(F.lit(0).alias("n"), F.count("*").alias("kept")))
        n = n.agg(F.sum("kept").alias("kept"), (F.sum("n") - F.sum("kept")).alias("dropped")).select(F.lit(name).alias("level"), "kept", "dropped")
        out = n if out is None else out.unionByName(n)
    return out


# Hooks and readers


def named_files(spark: SparkSession, d: str) -> str:
    """A file with the keys of all names of one kind and energy bin, below folders of runs; gives the folder."""
    path = tables.work_path(spark, "manifest")
    n = name_table(spark, d).select(F.col("key").cast("string").alias("value"), F.regexp_extract("path", "/data/(run[0-9])/", 1).alias("run"), F.regexp_replace("name", "^(DAT)[0-9]{4}|(_pass2)_.*|[.]dst$", "$1$2").alias("name"))
    n.repartition("run", "name").write.partitionBy("run", "name").text(path)
    return path


@query(f"""WITH {NAMES} SELECT 'run=run' || (key % 5) || '/name=DAT' || substr(name, 8, 2) || '_gea' AS dir, count(*) AS n FROM paths WHERE name LIKE 'DAT%' AND CAST(substr(name, 8, 2) AS INTEGER) < 30 GROUP BY ALL""")
def manifest_hook(spark, d):
    """Files found below two lists of folders by globs, each once, and filtered by a hook."""
    path = named_files(spark, d)
    keep = lambda f: f.where(F.regexp_extract("dir", "name=DAT([0-9]{2})_", 1).try_cast("int") < 30)
    found = files.manifest(spark, [path, f"{path}/run=run0"], "*.txt, part-*", keep)
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"))
    said = rows.select(F.regexp_replace("path", "^file:/+", "/").alias("path"), F.lit(1).alias("line")).join(found.select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "dir"), "path")
    return said.groupBy(F.regexp_extract("dir", "(run=[^/]+/name=[^/]+)$", 1).alias("dir")).agg(F.count("*").alias("n"))


@query(f"WITH {DETECTORS} SELECT * FROM detectors")
def detector_catalogue(spark, d):
    """A catalogue written as CSV and as Parquet reads back the same."""
    path = tables.work_path(spark, "catalogue")
    rows = detectors(spark, d)
    rows.coalesce(1).write.option("header", True).csv(f"{path}/a.csv")
    rows.write.parquet(f"{path}/b")
    both = tables.read_detectors(spark, f"{path}/a.csv").unionByName(tables.read_detectors(spark, f"{path}/b"))
    return both.groupBy(*both.columns).agg(F.count("*").alias("n")).where("n = 2").drop("n")


@query(f"""WITH {EVENTS}, {HITS}, {DETECTORS}, {TILE}, c AS (SELECT event_idx, CAST(count(*) FILTER (WHERE exists_ AND good) AS INTEGER) AS n_states FROM geo GROUP BY event_idx)
SELECT e.file_name, e.event_idx, price + 1 AS energy, n_states, CAST(cust % 5 AS BIGINT) AS id_data_set, CAST(0 AS INTEGER) AS n_optional FROM events e JOIN c ON e.event_idx = c.event_idx""")
def tile_hooks(spark, d):
    """A tile dataset with one set of options: no optional fits, no traces, and ids added by a hook."""
    sets = events(spark, d).select(*EVENT, (F.col("cust") % 5).alias("id_data_set"))
    options = datasets.TileOptions(ntile=3, traces=False, layout=LAYOUT, events=projections.EventOptions(combined_fit=False, fixed_curvature_fit=False), add_ids=lambda t: t.join(sets, EVENT, "left"))
    parsed = dumps.Dumps(dumps.event_rows(event_lines(spark, d)), hits(spark, d), waveforms(spark, d), bad(spark, d), events(spark, d))
    out = datasets.tile_dataset(parsed, detectors(spark, d), options)
    n = sum("combined" in c or "fixed_curve" in c for c in out.columns)
    return out.select(*EVENT, "energy", F.size(F.filter(F.flatten("detector_states"), lambda x: x)).alias("n_states"), "id_data_set", F.lit(n).alias("n_optional"))
