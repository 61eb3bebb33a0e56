"""Session settings, shared staging space and joins that check sizes before broadcasting."""

import ctypes
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Rows a side may have to be broadcast. Rows here are short (paths, names, counters).
BROADCAST_ROWS = 400_000
SALTS = 32

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app: str = "loglens", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per context, for the functions that run in tasks."""
    context, package = spark.sparkContext, Path(__file__).parent
    if package.is_dir() and not getattr(context, "_loglens_shipped", False):
        target = f"{tempfile.mkdtemp(prefix='loglens-package-')}/{package.name}"
        context.addPyFile(shutil.make_archive(target, "zip", package.parent, package.name))
        context._loglens_shipped = True


def give_back() -> None:
    """Give memory that this process has freed back to the system, where the C library can."""
    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def shared_dir(spark: SparkSession) -> str:
    """The folder the session names for checkpoints. On a cluster one must be named; only a local master gets its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="loglens-checkpoint-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder. For tables that are small next to the data."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


class Staging:
    """Parquet tables under the shared folder that cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/loglens-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and read it back with the same schema."""
        where = f"{self.path}/{name}"
        df.write.mode("errorifexists").parquet(where)
        return self.spark.read.schema(df.schema).parquet(where)

    def drop(self, name: str = "") -> None:
        """Delete this object's own tables, or the one of ``name``, or those below it. Call it when nothing reads them any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``rows`` rows. Reads no more than needed to tell."""
    return df.limit(rows + 1).count() <= rows


def join_checked(big: DataFrame, side: DataFrame, on, how: str = "inner",
                 rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join that broadcasts ``side`` only if it was counted and is small.

    Beyond that Spark shuffles both sides; adaptive skew handling splits hot keys of ``big``.
    """
    if is_small(side, rows):
        side = F.broadcast(side)
    return big.join(side, on, how)


def salt_of(*cols, salts: int = SALTS) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(salts)).cast("int")


def every_salt(salts: int = SALTS) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))


def join_salted(big: DataFrame, side: DataFrame, on: list[str], by: str, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join where one key may hold very many rows of ``big``.

    ``side`` is broadcast if it was counted and is small; otherwise every key is spread by column ``by``.
    """
    if is_small(side, rows):
        return big.join(F.broadcast(side), on)
    return (big.withColumn("_salt", salt_of(by)).join(side.withColumn("_salt", every_salt()), [*on, "_salt"])
            .drop("_salt"))
