"""Choices offered for an occurrence question."""

from pyspark.sql import DataFrame, SparkSession

from loglens import schema as S


def _options(spark: SparkSession, choices: list[str], name: str) -> DataFrame:
    return spark.createDataFrame(list(enumerate(choices)), f"position int, {name} string")


def platform_options(spark: SparkSession) -> DataFrame:
    return _options(spark, S.PLATFORM_CHOICES, "platform")


def version_options(spark: SparkSession) -> DataFrame:
    return _options(spark, S.VERSION_CHOICES, "version")
