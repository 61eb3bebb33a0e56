"""Row predicates over files and stored lines."""

import re

from pyspark.sql import Column, functions as F

from loglens import schema as S
from loglens.functions.paths import _col, file_ext, file_stem


def in_window(start: int, stop: int, mtime="mtime") -> Column:
    """Modification time in whole seconds lies in ``[start, stop)``."""
    seconds = F.unix_seconds(_col(mtime))
    return (seconds >= start) & (seconds < stop)


def is_log_name(path="relpath") -> Column:
    return file_ext(path).isin(S.LOG_EXTENSIONS) | file_stem(path).isin(S.LOG_STEMS)


def parse_version(version: str | None) -> tuple[str, int | None, int | None]:
    """Kind of version choice (``all``, ``pre10``, ``exact``) with its numbers."""
    if not version or version == S.ALL_VERSIONS:
        return "all", None, None
    if version == S.PRE_10:
        return "pre10", None, None
    if version == S.UNKNOWN:
        return "exact", S.MISSING_VERSION, S.MISSING_VERSION
    numbers = re.match(r"^(-?\d+)\.(-?\d+)(?:\.|$)", version)
    if numbers is None:
        raise ValueError(f"not a version choice: {version!r}")
    return "exact", int(numbers[1]), int(numbers[2])


def version_filter(version: str | None, major="major_version", minor="minor_version") -> Column:
    kind, want_major, want_minor = parse_version(version)
    if kind == "all":
        return F.lit(True)
    if kind == "pre10":
        return (_col(major) > 0) & (_col(major) < 10)
    return (_col(major) == want_major) & (_col(minor) == want_minor)


def platform_filter(platform: str | None, column="platform") -> Column:
    if platform is None or platform == S.ALL_PLATFORMS:
        return F.lit(True)
    return _col(column) == S.PLATFORM_ALIASES.get(platform, platform)
