"""Path functions as column expressions."""

from pyspark.sql import Column, functions as F

from loglens import schema as S

_EXT_ALTERNATION = "|".join(e.lstrip(".") for e in S.ARCHIVE_EXTENSIONS)


def _col(p) -> Column:
    return F.col(p) if isinstance(p, str) else p


def trim_path(p, keep_root: bool = False) -> Column:
    """Drop trailing slashes. With ``keep_root`` a path made only of slashes stays ``/``."""
    p = _col(p)
    trimmed = F.regexp_replace(p, "/+$", "")
    if keep_root:
        return F.when((trimmed == "") & (p != ""), F.lit("/")).otherwise(trimmed)
    return trimmed


def join_path(a, b) -> Column:
    """Append ``b`` below ``a``. An absolute ``b`` is an error."""
    a, b = _col(a), _col(b)
    joined = (F.when(a == "", b)
              .when(a.endswith("/"), F.concat(a, b))
              .otherwise(F.concat(a, F.lit("/"), b)))
    complaint = F.raise_error(F.concat(F.lit("path to append is absolute: "), b)).cast("string")
    return F.when(b.startswith("/"), complaint).otherwise(joined)


def normalize_path(p) -> Column:
    """Absolute path with ``.``, ``..`` and empty components resolved."""
    empty = F.array().cast("array<string>")
    kept = F.aggregate(
        F.split(_col(p), "/"), empty,
        lambda acc, x: (F.when(x.isin("", "."), acc)
                        .when(x == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
                        .otherwise(F.array_append(acc, x))))
    return F.concat(F.lit("/"), F.array_join(kept, "/"))


def dir_name(p) -> Column:
    """Parent directory; empty for a path of one component."""
    head = F.regexp_extract(_col(p), "(?s)^(.*/)[^/]*$", 1)
    return F.when(head.rlike("^/*$"), head).otherwise(F.regexp_replace(head, "/+$", ""))


def base_name(p) -> Column:
    return F.try_element_at(F.split(_col(p), "/"), F.lit(-1))


def file_ext(p) -> Column:
    """Extension with its dot. Leading dots of the name start no extension."""
    return F.regexp_extract(base_name(p), r"(?s)^\.*[^.].*(\.[^.]*)$", 1)


def file_stem(p) -> Column:
    """Last component without its extension."""
    return F.regexp_replace(base_name(p), r"(?s)^(\.*[^.].*)\.[^.]*$", "$1")


def is_archive(p) -> Column:
    return file_ext(p).isin(S.ARCHIVE_EXTENSIONS)


def strip_archive_ext(p) -> Column:
    """Strip one archive extension, if there is one."""
    return F.regexp_replace(_col(p), rf"(?s)^(.*?[^./][^/]*)\.(?:{_EXT_ALTERNATION})$", "$1")


def strip_all_archive_exts(p) -> Column:
    """Strip archive extensions until none is left."""
    return F.regexp_replace(_col(p), rf"(?s)^(.*?[^./][^/]*?)((?:\.(?:{_EXT_ALTERNATION}))+)$", "$1")


def ancestors(dir_col, include_self: bool = True) -> Column:
    """All directories from the first component down to ``dir_col``, shortest first."""
    parts = F.split(_col(dir_col), "/")
    n = F.size(parts) if include_self else F.size(parts) - 1
    return F.when((_col(dir_col) == "") | (n < 1), F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                    lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/")))


def uri_path(uri) -> Column:
    """Path part of a file URI as file metadata shows it (percent-escapes resolved)."""
    bare = F.regexp_replace(_col(uri), "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    return plain_uri(bare)


def plain_uri(uri) -> Column:
    """File URI with percent-escapes resolved, as a store names the file."""
    return F.url_decode(F.replace(_col(uri), F.lit("+"), F.lit("%2B")))


def rel_path(uri, root_path: str) -> Column:
    """Path below ``root_path`` (a plain absolute path) of a file URI."""
    prefix = root_path.rstrip("/") + "/"
    return F.substring(uri_path(uri), len(prefix) + 1, 2 ** 31 - 1)
