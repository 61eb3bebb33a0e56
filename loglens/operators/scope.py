"""Node fields: read once per marker directory, inherited by everything below it."""

from pyspark.sql import DataFrame, functions as F

from loglens import schema as S
from loglens.functions import fields
from loglens.functions.paths import ancestors, base_name, dir_name
from loglens.session import BROADCAST_ROWS, every_salt, is_small, salt_of

SIDECAR_PATTERN = f"(^|/)({S.VERSION_SIDECAR}|{S.PLATFORM_SIDECAR})$"

MISSING = {"node_name": S.MISSING_NODE, "grid_id": S.MISSING_GRID, "time_span": S.MISSING_TIME_SPAN,
           "category": S.MISSING_CATEGORY, "platform": S.MISSING_PLATFORM,
           "major_version": S.MISSING_VERSION, "minor_version": S.MISSING_VERSION}


def marker_dirs(files: DataFrame) -> DataFrame:
    """Directories that directly hold a marker file."""
    return (files.where(base_name("relpath") == S.MARKER_FILE)
            .select(dir_name("relpath").alias("dir")).distinct())


def sidecar_fields(lines: DataFrame) -> DataFrame:
    """Version and platform per directory from sidecar lines ``(relpath, block, mid, value)``.

    ``(block, mid)`` orders the lines of a file. A carriage return also ends a sidecar line. The first
    line with the release mark decides the version even if it does not parse; for the platform the first
    line that names a known one counts. Lines from the first undecodable one on are not looked at.
    """
    lines = lines.select("relpath", "block", "mid", F.posexplode(F.split("value", "\r", -1)).alias("sub", "line"),
                         F.is_valid_utf8("value").alias("valid"))
    is_version = base_name("relpath") == S.VERSION_SIDECAR
    owner = F.when(is_version, dir_name("relpath")).otherwise(
        F.regexp_replace("relpath", f"(^|/){S.PLATFORM_SIDECAR}$", ""))
    at = F.struct("block", "mid", "sub")
    release = is_version & F.col("line").contains(S.RELEASE_MARK)
    platform = F.when(~is_version, fields.platform_of("line"))
    per_file = lines.groupBy(owner.alias("dir"), is_version.alias("is_version")).agg(
        F.min(F.when(~F.col("valid"), at)).alias("bad_at"),
        F.min(F.when(release, at)).alias("release_at"),
        F.min_by(F.col("line"), F.when(release, at)).alias("release_line"),
        F.min(F.when(platform.isNotNull(), at)).alias("platform_at"),
        F.min_by(platform, F.when(platform.isNotNull(), at)).alias("platform"))

    def readable(found_at):
        return F.col("bad_at").isNull() | (F.col(found_at) < F.col("bad_at"))

    version = fields.release_version("release_line")
    found = F.col("release_line").isNotNull() & readable("release_at")
    return (per_file
            .select("dir", F.when(found, version).alias("version"),
                    F.when(readable("platform_at"), F.col("platform")).alias("platform"))
            .groupBy("dir").agg(F.max("version").alias("version"), F.max("platform").alias("platform"))
            .select("dir", "platform", "version.major_version", "version.minor_version"))


def node_scopes(files: DataFrame, sidecar_lines: DataFrame, root_path: str) -> DataFrame:
    """One row of ``schema.SCOPES`` per marker directory. Directory names are read off absolute paths."""
    scopes = marker_dirs(files).join(sidecar_fields(sidecar_lines), "dir", "left")
    whole = F.concat(F.lit(root_path.rstrip("/") + "/"), F.col("dir"))
    found = {"node_name": fields.node_name(whole), "grid_id": fields.grid_id(whole),
             "time_span": fields.time_span(whole), "category": fields.category_of(whole)}
    return scopes.select(
        "dir", F.size(F.split("dir", "/")).alias("depth"),
        *[F.coalesce(found[name] if name in found else F.col(name),
                     F.lit(MISSING[name])).alias(name) for name in S.SCOPE_FIELDS])


def resolve_scope(dirs: DataFrame, scopes: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Fields of each directory, every missing one taken from the nearest enclosing scope that has it.

    Works on distinct directories, never on lines. Scopes are broadcast if they were counted and are few.
    Otherwise the join on the ancestor path is salted: a directory near the root is an ancestor of very
    many others.
    """
    above = dirs.select("dir", F.explode(ancestors("dir")).alias("scope_dir"))
    sides = scopes.withColumnRenamed("dir", "scope_dir")
    if is_small(scopes, rows):
        met = above.join(F.broadcast(sides), "scope_dir")
    else:
        met = (above.withColumn("salt", salt_of("dir"))
               .join(sides.withColumn("salt", every_salt()), ["scope_dir", "salt"]))

    def nearest(name):
        given = F.col(name) != F.lit(MISSING[name])
        return F.max_by(F.when(given, F.col(name)), F.when(given, F.col("depth"))).alias(name)

    version_given = ((F.col("major_version") != S.MISSING_VERSION)
                     | (F.col("minor_version") != S.MISSING_VERSION))
    version = F.max_by(F.struct("major_version", "minor_version"),
                       F.when(version_given, F.col("depth"))).alias("version")
    names = [n for n in S.SCOPE_FIELDS if not n.endswith("_version")]
    nearest_fields = (met.groupBy("dir").agg(*map(nearest, names), version)
                      .select("dir", *names, "version.major_version", "version.minor_version"))
    return dirs.join(nearest_fields, "dir", "left").select(
        "dir", *[F.coalesce(F.col(n), F.lit(MISSING[n])).alias(n) for n in S.SCOPE_FIELDS])
