"""Which files are product logs."""

from pyspark.sql import Column, DataFrame, functions as F

from loglens import schema as S
from loglens.functions.predicates import is_log_name


def mentions_token(files: DataFrame, lines: DataFrame, key: str = "relpath") -> DataFrame:
    """Files whose path, or any line of which, holds the product token."""
    # Reduced to distinct files before the join, so a file with many mentions is one row.
    mentioned = lines.where(F.col("message").contains(S.PRODUCT_TOKEN)).select(key).distinct()
    by_path = files.where(F.col("relpath").contains(S.PRODUCT_TOKEN))
    rest = files.where(~F.col("relpath").contains(S.PRODUCT_TOKEN))
    return by_path.unionByName(rest.join(mentioned, key, "left_semi"))


def is_relevant(mentions: Column, path="relpath", node="node_name") -> Column:
    """A log name, and either inside a known node or with the product token in its path or a line."""
    in_path = F.col(path).contains(S.PRODUCT_TOKEN)
    return is_log_name(path) & ((F.col(node) != S.MISSING_NODE) | in_path | F.coalesce(mentions, F.lit(False)))


def relevant_files(files: DataFrame, lines: DataFrame, key: str = "relpath") -> DataFrame:
    """Relevant files among ``files`` (with ``node_name``). Only log names are joined with lines."""
    named = files.where(is_log_name())
    inside = named.where(F.col("node_name") != S.MISSING_NODE)
    outside = named.where(F.col("node_name") == S.MISSING_NODE)
    return inside.unionByName(mentions_token(outside, lines, key))
