"""Log-shaped views of the check tables: one document is one log file, its text the file's content."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from loglens.functions.text import tokenize

# The same text is valid in Spark SQL and in ANSI SQL engines.
DOC_FILES = """
SELECT doc_id,
  CAST(2000000000 + doc_id % 40 AS VARCHAR(20)) AS case_num,
  'grid_' || CAST(doc_id % 7 AS VARCHAR(20)) AS grid_id,
  CASE WHEN source = 'src0' THEN 'Unknown'
       ELSE source || '-n' || CAST(doc_id % 13 AS VARCHAR(20)) END AS node_name,
  CASE lang WHEN 'en' THEN 'vSphere' WHEN 'de' THEN 'SGA' ELSE 'Unknown' END AS platform,
  CAST(CASE doc_id % 5 WHEN 0 THEN 9 WHEN 1 THEN 10 WHEN 2 THEN 10 WHEN 3 THEN 11 ELSE -1 END AS INTEGER)
    AS major_version,
  CAST(CASE doc_id % 5 WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 2 THEN 4 WHEN 3 THEN 1 ELSE -1 END AS INTEGER)
    AS minor_version,
  text
FROM {documents}"""


# A table up to this size per core is dealt out over all cores: it may well be a single row group, and
# what is done with its texts costs far more than moving them. Larger tables are never moved.
SPREAD_BYTES_PER_CORE = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    cores = spark.sparkContext.defaultParallelism
    stored = spark.read.format("binaryFile").load(f"{sf_dir.rstrip('/')}/{name}.parquet")
    size = stored.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()["bytes"]
    return df.repartition(cores) if size <= cores * SPREAD_BYTES_PER_CORE else df


def doc_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(DOC_FILES.format(documents="{documents}"), documents=table(spark, sf_dir, "documents"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents, with the fields of their file."""
    files = spread(doc_files(spark, sf_dir), spark, sf_dir, "documents")
    return files.select("doc_id", "case_num", "grid_id", "node_name", "platform", "major_version",
                        "minor_version", F.posexplode(F.split("text", "\n", -1)).alias("pos", "message")
                        ).withColumn("line_no", F.col("pos") + 1).drop("pos")


def tokenized_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_lines(spark, sf_dir).withColumn("tokens", tokenize("message"))
