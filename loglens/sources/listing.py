"""Files of an input directory as a table of paths, times and sizes."""

import re
from functools import partial
from urllib.parse import quote, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loglens import schema as S
from loglens.functions.paths import ancestors, dir_name, is_archive
from loglens.session import ship_package

CASE_GLOB = "[0-9]" * 10
# Files that a listing task hands over at a time.
LISTED_ROWS = 50_000


def glob_escape(path: str) -> str:
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def qualify(spark: SparkSession, path: str) -> str:
    """Fully qualified form of a directory name, as Spark shows it in file metadata."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(hadoop_path).toString().rstrip("/")


def root_path(spark: SparkSession, root: str) -> str:
    """Path part of a root directory, without scheme and authority."""
    return re.sub("^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", qualify(spark, root)) or "/"


def list_cases(spark: SparkSession, root: str) -> list[str]:
    """Names of the case directories directly below ``root``, in scan order.

    Only the top level is listed here; everything below is listed by Spark, in parallel.
    """
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{glob_escape(root.rstrip('/'))}/{CASE_GLOB}")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted((s.getPath().getName() for s in found or [] if s.isDirectory()), reverse=True)


def case_paths(root: str, cases: list[str]) -> list[str]:
    return [f"{glob_escape(root.rstrip('/'))}/{case}" for case in cases]


def _list(batches, root):
    from pyarrow import fs
    store, base = open_store(root)
    base = base.rstrip("/")
    for batch in batches:
        for name in batch["name"]:
            infos = store.get_file_info(fs.FileSelector(f"{base}/{name}".rstrip("/"), recursive=True, allow_not_found=True))
            for at in range(0, len(infos), LISTED_ROWS):
                found = [(i.path[len(base):].lstrip("/"), i.mtime_ns // 1_000_000, max(i.size or 0, 0), i.type == fs.FileType.Directory)
                         for i in infos[at:at + LISTED_ROWS]]
                yield pd.DataFrame(found, columns=["relpath", "millis", "length", "is_dir"])


def list_tree(spark: SparkSession, root: str, names: list[str] | None = None) -> DataFrame:
    """Every file and directory below ``root``, or below its directories ``names``: one listing task a name.

    Tasks ask the store, so empty files, empty directories and hidden names are there too.
    """
    names = [""] if names is None else names
    where = qualify(spark, root)
    asked = spark.createDataFrame([(n,) for n in names], "name string")
    asked = asked.repartition(max(1, min(len(names), 4 * spark.sparkContext.defaultParallelism)))
    ship_package(spark)
    listed = asked.mapInPandas(partial(_list, root=where), "relpath string, millis long, length long, is_dir boolean")
    return with_uri(listed, where)


def with_uri(listed: DataFrame, where: str) -> DataFrame:
    """``schema.FILES`` and ``is_dir`` of listed ``(relpath, millis, length, is_dir)`` below the qualified directory ``where``."""
    return (listed.withColumn("uri", F.concat(F.lit(quote(f"{where}/", safe="/:@")), F.replace(F.url_encode("relpath"), F.lit("%2F"), F.lit("/"))))
            .withColumn("uri", F.replace("uri", F.lit("+"), F.lit("%20")))
            .withColumn("mtime", F.timestamp_millis("millis")).withColumn("is_archive", is_archive("relpath"))
            .select(*S.FILES.names, "is_dir"))


def list_files(spark: SparkSession, root: str, names: list[str] | None = None) -> DataFrame:
    """Every file of ``list_tree``. File contents are never read."""
    return list_tree(spark, root, names).where(~F.col("is_dir")).drop("is_dir")


def read_directly(path="relpath") -> Column:
    """Whether Spark's readers would not show a file as it is: hidden names, and endings they decompress by."""
    path = F.col(path) if isinstance(path, str) else path
    return path.rlike(r"(^|/)(\.|_[^/=]*(/|$))") | path.rlike(r"\._COPYING_$") | path.rlike(r"\.(bz2|deflate|snappy|lz4|zstd?|xz|lzo)$")


def only_case_files(files: DataFrame) -> DataFrame:
    """Keep files inside a directory named by ten digits; drop everything else at the top level."""
    return files.where(F.col("relpath").rlike("^[0-9]{10}/"))


def directories(files: DataFrame) -> DataFrame:
    """Distinct directories that directly hold a file."""
    return files.select(dir_name("relpath").alias("dir")).distinct()


def existing_paths(files: DataFrame) -> DataFrame:
    """Paths of all files and of all directories above them."""
    above = directories(files).select(F.explode(ancestors("dir")).alias("path"))
    return files.select(F.col("relpath").alias("path")).union(above).distinct()


def open_store(uri: str):
    """``(filesystem, path)`` of a file URI or plain path. Runs inside tasks."""
    from pyarrow import fs
    if urlsplit(uri).scheme in ("", "file"):
        return fs.LocalFileSystem(), re.sub("^file:(//[^/]*)?", "", uri)
    scheme, rest = uri.split(":", 1)
    return fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}:{quote(rest, safe='/:@=+,~%')}")
