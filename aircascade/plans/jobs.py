"""Groups of inputs to outputs in passes, with a commit table, so that a run does only what isn't done.

A plan has a row an output: its name and its inputs.  A pass writes the rows of all outputs that
are to do in one job, as a folder an output and version; the version is a hash of the
output's sorted inputs.  Then it commits them.  Readers take the committed version
of each output only, so what a run that failed has left counts for nothing and is
written over by the next.  An output whose inputs are the same as at its last commit is left alone.

A second pass takes the first one's outputs, with their versions, as its inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..sources.splits import written

#: Tasks that a large output is dealt to, and rows of one of its files.
SALTS, FILE_ROWS = 16, 1_000_000
COMMITS = "output string, version string, n_inputs int, run int"


def versioned(plan: DataFrame) -> DataFrame:
    """Add ``version``: the SHA-256 of the sorted ``inputs``."""
    return plan.withColumn("version", F.sha2(F.array_join(F.array_sort("inputs"), "\n"), 256))


def commits(spark: SparkSession, out: str) -> DataFrame:
    """output, version, n_inputs, run of all that was ever committed."""
    try:
        return spark.read.schema(COMMITS).parquet(f"{out}/commits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMITS)


def current(commits: DataFrame) -> DataFrame:
    """output, version, n_inputs of each output's last commit."""
    last = F.max_by(F.struct("version", "n_inputs"), "run").alias("last")
    return commits.groupBy("output").agg(last).select("output", "last.*")


def run_pass(rows: DataFrame, plan: DataFrame, out: str, by: str = "file_name", file_rows: int = FILE_ROWS) -> int:
    """Write what ``plan`` (output, inputs) has that isn't committed, from ``rows`` whose column ``by`` names their input.  Gives the number of outputs written."""
    spark = rows.sparkSession
    done = commits(spark, out)
    todo = versioned(plan).join(current(done).select("output", "version"), ["output", "version"], "left_anti")
    run = (done.agg(F.max("run")).first()[0] or 0) + 1
    todo = written(todo.select("output", "version", "inputs", F.size("inputs").cast("int").alias("n_inputs"), F.lit(run).cast("int").alias("run")), "todo")
    n = todo.count()
    if n:
        inputs = todo.select("output", "version", F.explode("inputs").alias(by))
        part = rows.join(inputs, by).repartition("output", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)))
        w = part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", file_rows)
        w.partitionBy("output", "version").parquet(f"{out}/rows")
        todo.select("output", "version", "n_inputs", "run").write.mode("append").parquet(f"{out}/commits")
    return n


def outputs_of(spark: SparkSession, out: str) -> DataFrame:
    """The rows of all outputs as committed last, with ``output`` and ``version``."""
    return spark.read.parquet(f"{out}/rows").join(current(commits(spark, out)), ["output", "version"], "left_semi")


def as_inputs(rows: DataFrame, by: str = "input") -> DataFrame:
    """Rows of a pass as those of the next: ``by`` names the output and version they come from."""
    return rows.withColumn(by, F.concat_ws("@", "output", "version")).drop("output", "version")
