"""Metadata fields read from directory names and sidecar lines."""

from pyspark.sql import Column, functions as F

from loglens import schema as S
from loglens.functions.paths import _col, base_name


def case_number(path) -> Column:
    base = base_name(path)
    return F.when(base.rlike("^[0-9]{10}$"), base).otherwise(S.MISSING_CASE)


def time_span(path) -> Column:
    base = base_name(path)
    return F.when(base.rlike("^[0-9]+-[0-9]+$"), base).otherwise(S.MISSING_TIME_SPAN)


def node_name(abs_dir) -> Column:
    """Name of the directory above the marker directory."""
    return F.coalesce(F.try_element_at(F.split(_col(abs_dir), "/"), F.lit(-2)), F.lit(""))


def grid_id(abs_dir) -> Column:
    """Name of the directory two above the marker directory."""
    return F.coalesce(F.try_element_at(F.split(_col(abs_dir), "/"), F.lit(-3)), F.lit(""))


def category_of(path) -> Column:
    """First category whose pattern is found in a suffix of the path, shortest suffix first.

    The whole path is never tested, so a single name has no category of its own.
    """
    split = F.split(F.replace(_col(path), F.lit("\\"), F.lit("/")), "/")

    # Lambda variables hold the parts and each suffix, so that neither is worked out once per pattern.
    def suffixes(parts):
        return F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))),
                           lambda i: F.array_join(F.slice(parts, -i, i), "/"))

    def of_suffix(suffix):
        hit = F.lit(None).cast("string")
        for name, pattern in reversed(S.CATEGORY_PATTERNS.items()):
            # A search finds the pattern anywhere; leading and trailing ".*" only make it quadratic.
            core = pattern.removeprefix(".*").removesuffix(".*")
            hit = F.when(suffix.rlike(core), F.lit(name)).otherwise(hit)
        return hit

    per_suffix = F.transform(F.flatten(F.transform(F.array(split), suffixes)), of_suffix)
    first = F.try_element_at(F.filter(per_suffix, lambda c: c.isNotNull()), F.lit(1))
    return F.when(F.size(split) > 1, F.coalesce(first, F.lit(S.MISSING_CATEGORY))).otherwise(
        S.MISSING_CATEGORY)


def release_version(line) -> Column:
    """``struct(major, minor)`` from a line that holds the release mark; -1,-1 when it does not parse."""
    pieces = F.split(_col(line), S.RELEASE_MARK, -1)
    numbers = F.split(F.try_element_at(pieces, F.lit(2)), r"\.", -1)

    def whole_number(i):
        digits = F.regexp_extract(F.try_element_at(numbers, F.lit(i)),
                                  r"^\s*([+-]?\d+(?:_\d+)*)\s*$", 1)
        return F.replace(digits, F.lit("_"), F.lit("")).try_cast("int")

    major, minor = whole_number(1), whole_number(2)
    good = (F.size(pieces) == 2) & major.isNotNull() & minor.isNotNull()
    return F.struct(
        F.when(good, major).otherwise(S.MISSING_VERSION).cast("int").alias("major_version"),
        F.when(good, minor).otherwise(S.MISSING_VERSION).cast("int").alias("minor_version"))


def platform_of(line) -> Column:
    """Known platform named by a line, else null."""
    line = _col(line)
    value = F.btrim(F.split_part(line, F.lit("="), F.lit(2)), F.lit("\n\"'; "))
    given = line.contains(S.PLATFORM_KEY) & line.contains("=")
    return F.when(given & value.isin(S.KNOWN_PLATFORMS), value)


def version_label(major, minor) -> Column:
    """Version as offered for choice: ``Unknown``, ``Pre-10`` or ``major.minor``."""
    major, minor = _col(major), _col(minor)
    return (F.when(major == S.MISSING_VERSION, F.lit(S.UNKNOWN))
            .when((major > 0) & (major < 10), F.lit(S.PRE_10))
            .otherwise(F.concat_ws(".", major.cast("string"), minor.cast("string"))))


def platform_alias(platform) -> Column:
    """Stored platform name for a choice shown to users."""
    p = _col(platform)
    out = p
    for shown, stored in S.PLATFORM_ALIASES.items():
        out = F.when(p == shown, F.lit(stored)).otherwise(out)
    return out
