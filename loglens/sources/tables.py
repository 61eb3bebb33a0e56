"""The stored tables: lines, ingest report, archive errors and ledger, all Parquet.

Every ingest batch writes its own ``batch=<id>`` directories and counts only once the ledger names it, so
a run that dies half way leaves nothing visible. Line documents are never rewritten: which ingest of a
file is current follows from the report, one row per file and batch.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from loglens import schema as S
from loglens.functions.paths import _col, dir_name
from loglens.operators.ledger import Ledger
from loglens.session import cut, is_small, join_checked


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Create an empty table with a fixed schema unless something is there already."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def latest_documents(lines: DataFrame, key: str = "doc_id", at: str = "categorize_time") -> DataFrame:
    """Latest document of every id: a re-sent id overwrites, ids not sent again stay. Of several at the same time one stays.

    Only ids and times are shuffled to find the ids that were sent again. If these were counted and are few, documents of other ids
    stay where they are, and of the re-sent ones only the latest are shuffled.
    """
    names = [F.col(f"`{n}`") for n in lines.columns]
    sent = lines.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_times"), F.max(at).alias("_at"))
    again = cut(sent.where("_times > 1").select("_key", "_at", F.lit(True).alias("_again")))
    if not is_small(again):
        newest = F.max_by(F.struct(*names), F.col(at)).alias("newest")
        return lines.groupBy(F.col(key).alias("_key")).agg(newest).select("newest.*")
    met = lines.join(F.broadcast(again), F.col(key).eqNullSafe(F.col("_key")), "left")
    resent = F.coalesce("_again", F.lit(False))
    latest = met.where(resent & F.col(at).eqNullSafe(F.col("_at"))).dropDuplicates([key])
    return met.where(~resent).select(*names).unionByName(latest.select(*names))


def superseded_files(report: DataFrame) -> DataFrame:
    """``(relpath, batch)`` of ingests of a file that a later ingest of the same file replaces."""
    newest = report.groupBy("relpath").agg(
        F.max_by("batch", F.struct("categorize_time", "batch")).alias("newest"),
        F.count(F.lit(1)).alias("times"))
    return (report.join(newest.where(F.col("times") > 1), "relpath")
            .where(F.col("batch") != F.col("newest")).select("relpath", "batch"))


def ingest_report(lines: DataFrame, files: DataFrame) -> DataFrame:
    """Outcome per file: ``ok`` if every line that should be there is there.

    Files read in one pass come without ``expected`` lines; all of theirs are there.
    """
    counted = lines.groupBy("relpath").agg(F.count(F.lit(1)).alias("lines"))
    return (files.join(counted, "relpath", "left")
            .withColumn("lines", F.coalesce("lines", F.lit(0)))
            .withColumn("expected", F.coalesce("expected", "lines"))
            .withColumn("ok", F.col("lines") == F.col("expected"))
            .select(*[F.col(f"`{n}`") for n in S.INGEST_REPORT.names]))


def find_lines(lines: DataFrame, field: str, value, limit: int | None = None,
               order: tuple[str, ...] = ("relpath", "line_no")) -> DataFrame:
    """Lines whose field has a value, in file order; the first ``limit`` of them if asked for (a page)."""
    found = lines.where(_col(f"`{field}`") == F.lit(value)).orderBy(*order)
    return found if limit is None else found.limit(limit)


def table_stats(lines: DataFrame, path: str | None = None) -> DataFrame:
    """Number of documents and, for a stored table, of the bytes of its files."""
    docs = lines.agg(F.count(F.lit(1)).alias("docs"))
    if path is None:
        return docs
    stored = (lines.sparkSession.read.format("binaryFile").option("recursiveFileLookup", True)
              .option("pathGlobFilter", "*.parquet").load(path))
    size = stored.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()["bytes"]
    return docs.withColumn("bytes", F.lit(size).cast("bigint"))


class LogTable:
    """All tables of one log store below one directory."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        ensure_table(spark, f"{self.path}/ledger", S.LEDGER)
        self.ledger = Ledger(spark, f"{self.path}/ledger")

    def batch_path(self, name: str, batch: str) -> str:
        return f"{self.path}/{name}/batch={batch}"

    def write(self, name: str, batch: str, df: DataFrame) -> None:
        """Write one batch of a table. The batch directory is new, so a retry cannot double rows."""
        df.write.mode("errorifexists").parquet(self.batch_path(name, batch))

    def read(self, name: str, schema: T.StructType, batches: list[str] | None = None) -> DataFrame:
        """Rows of the committed batches, with their ``batch``. Other directories are not even listed."""
        batches = self.ledger.batches() if batches is None else batches
        full = T.StructType([*schema.fields, T.StructField("batch", T.StringType())])
        if not batches:
            return self.spark.createDataFrame([], full)
        return (self.spark.read.schema(full).option("basePath", f"{self.path}/{name}")
                .parquet(*[self.batch_path(name, b) for b in batches]))

    def all_lines(self) -> DataFrame:
        return self.read("lines", S.LOG_LINES)

    def report(self) -> DataFrame:
        return self.read("report", S.INGEST_REPORT)

    def errors(self) -> DataFrame:
        return self.read("errors", S.ARCHIVE_ERRORS)

    def corrections(self) -> DataFrame:
        """Fields that directories were given after lines of theirs were stored, with the time of each."""
        batches = [b for b in self.ledger.batches() if b.startswith(S.SCOPED_BATCH)]
        return self.read("scopes", S.CORRECTIONS, batches)

    def _corrected(self, lines: DataFrame) -> DataFrame:
        """``lines`` with the latest fields of their directories, where these came after the lines."""
        rows = self.corrections()
        newest = F.max_by(F.struct("categorize_time", *S.SCOPE_FIELDS), F.struct("categorize_time", "batch")).alias("_new")
        latest = rows.groupBy(F.col("dir").alias("_dir")).agg(newest)
        if latest.isEmpty():
            return lines
        met = join_checked(lines.withColumn("_dir", dir_name("relpath")), latest, "_dir", "left")
        newer = F.col("_new.categorize_time") > F.col("categorize_time")
        return met.withColumns({n: F.when(newer, F.col(f"_new.{n}")).otherwise(F.col(n)) for n in S.SCOPE_FIELDS}).drop("_dir", "_new")

    def current_lines(self, mode: str = "file") -> DataFrame:
        """Lines in force.

        ``file``: the latest ingest of a file replaces all its earlier lines. ``upsert``: only lines with
        the same id are replaced, so lines of a longer earlier version of a file stay.
        """
        lines = self.all_lines()
        if mode == "upsert":
            return self._corrected(self._upserted(lines)).select(*[f"`{n}`" for n in S.LOG_LINES.names])
        if mode != "file":
            raise ValueError(f"unknown mode {mode!r}")
        old = cut(superseded_files(self.report()))          # small, and looked at more than once
        if not old.isEmpty():
            lines = join_checked(lines, old, ["relpath", "batch"], "left_anti")
        return self._corrected(lines).select(*[f"`{n}`" for n in S.LOG_LINES.names])

    def _upserted(self, lines: DataFrame) -> DataFrame:
        """Latest line of every id. Lines of files that were ingested once can't have been sent again."""
        report = self.report()
        again = cut(report.groupBy("relpath").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("relpath"))
        if again.isEmpty():
            return lines
        latest = latest_documents(join_checked(lines, again, "relpath", "left_semi"))
        return join_checked(lines, again, "relpath", "left_anti").unionByName(latest)

    def compact(self, path: str, partitions: int | None = None) -> None:
        """Write the lines in force to a new directory, clustered by version for file pruning."""
        lines = self.current_lines()
        keys = ["major_version", "minor_version", "node_name", "relpath"]
        ranged = lines.repartitionByRange(partitions, *keys) if partitions else lines.repartitionByRange(*keys)
        ranged.sortWithinPartitions(*keys).write.mode("errorifexists").parquet(path)
