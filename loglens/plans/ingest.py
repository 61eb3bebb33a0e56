"""Full ingest: from a tree of support bundles to stored line documents.

A run works through batches of cases. Each batch is one Spark plan over all files of its cases, commits by
one ledger append, and is skipped when a later run resumes the same window. Small tables (listing, scopes,
ranges) are staged in the shared folder between the passes. A first pass notes of each file whether it counts and
how many lines it must have, a second reads the lines of those that do; their text is not shuffled. Tasks list the files and
tasks open them, so the driver holds no list of them.
"""

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from loglens import schema as S
from loglens.functions.fields import case_number
from loglens.functions.paths import dir_name
from loglens.functions.predicates import in_window, is_log_name
from loglens.operators.documents import CARRIED, as_documents, with_ingest_time
from loglens.operators.relevance import is_relevant
from loglens.operators.scope import SIDECAR_PATTERN, node_scopes, resolve_scope
from loglens.session import Staging, is_small, join_checked
from loglens.sources.archives import archive_errors, good_members, member_lines, skip_unpacked
from loglens.sources.bundles import file_ranges, range_chunks
from loglens.sources.lines import WHOLE_BYTES, with_facts
from loglens.sources.listing import list_cases, list_tree, qualify, root_path
from loglens.sources.parts import expand_in_parts
from loglens.sources.tables import LogTable, ingest_report

_DOC_FIELDS = CARRIED  # what a line takes over from its file

# Rows of files or directories, with their paths and fields, that may be broadcast: some 25 MB, which the driver holds several times.
FILE_ROWS = 50_000


@dataclass(frozen=True)
class IngestRun:
    start: int
    stop: int
    cases: int
    batches: tuple[str, ...]
    complete: bool


def ingest(spark: SparkSession, root: str, table: str, *, now: int | None = None,
           lag_s: int = S.SAFETY_LAG_S, cases_per_batch: int = 256,
           should_stop: Callable[[], bool] = lambda: False) -> IngestRun:
    """Ingest what is new below ``root`` since the last run into the log store at ``table``.

    ``should_stop`` is asked before every batch. A run stopped that way, or killed, leaves its window open:
    the next run takes up the same window at the cases that are not committed yet.
    """
    store, where = LogTable(spark, table), qualify(spark, root)
    window = store.ledger.next_window(where, now, lag_s)
    start, stop = window["start"], window["stop"]
    cases = store.ledger.pending_cases(where, list_cases(spark, root))
    done, batches = 0, []
    for at in range(0, len(cases), cases_per_batch):
        if should_stop():
            return IngestRun(start, stop, done, tuple(batches), False)
        group = cases[at:at + cases_per_batch]
        batches.append(ingest_batch(spark, store, root, group, start, stop))
        store.ledger.append(start, stop, where, group, batches[-1])
        done += len(group)
    if should_stop():
        return IngestRun(start, stop, done, tuple(batches), False)
    store.ledger.append(start, stop, where, [], None)
    return IngestRun(start, stop, done, tuple(batches), True)


def ingest_batch(spark: SparkSession, store: LogTable, root: str, cases: list[str], start: int, stop: int,
                 only: DataFrame | None = None) -> str:
    """Write one batch, without committing it, and return its id.

    ``only`` (``relpath``) limits it to some files; the listing of the whole cases still decides which scopes they are in.
    """
    millis = int(round(time.time() * 1000))
    batch = f"{millis}-{uuid.uuid4().hex[:8]}"
    staging = Staging(spark)
    try:
        _write_batch(spark, store, staging, root, cases, start, stop, millis, batch, only)
    finally:
        staging.drop()
    return batch


def _write_batch(spark: SparkSession, store: LogTable, staging: Staging, root: str, cases: list[str], start: int, stop: int,
                 millis: int, batch: str, only: DataFrame | None) -> None:
    base = root_path(spark, root)
    tree = staging.table(list_tree(spark, root, cases), "listed")
    listed = tree.where(~F.col("is_dir"))
    current = listed.where(in_window(start, stop))
    if only is not None:
        current = join_checked(current, only, "relpath", "left_semi", FILE_ROWS)
    fields = [f"`{c}`" for c in _DOC_FIELDS]
    is_sidecar = F.col("relpath").rlike(SIDECAR_PATTERN)
    plain = current.where(~F.col("is_archive") & is_log_name())
    tasks, spare = _output_tasks(current), 4 * spark.sparkContext.defaultParallelism

    members, errors = _unpack(staging, tree, current)
    names = members.select("relpath", "archive").distinct() if members is not None else None

    # Scopes
    asked = file_ranges(listed.where(~F.col("is_archive") & is_sidecar), max(WHOLE_BYTES, 1)).repartition(spare, "relpath", "part")
    sidecars = member_lines(range_chunks(asked, max(WHOLE_BYTES, 1), gone=True), "part").select(
        "relpath", F.col("part").cast("bigint").alias("block"), F.col("line_no").alias("mid"), "value")
    everything, named = listed.select("relpath"), plain.select("relpath")
    if members is not None:
        inside = member_lines(members.where(is_sidecar))
        sidecars = sidecars.unionByName(inside.select("relpath", F.lit(0).cast("bigint").alias("block"), F.col("line_no").alias("mid"), "value"))
        everything, named = everything.union(names.select("relpath")), named.union(names.where(is_log_name()).select("relpath"))
    scopes = staging.table(node_scopes(everything, sidecars, base), "scopes")
    dirs = named.select(dir_name("relpath").alias("dir")).distinct()
    scoped = staging.table(resolve_scope(dirs, scopes, FILE_ROWS), "scoped")

    def with_scope(files: DataFrame) -> DataFrame:
        return (join_checked(files.withColumn("dir", dir_name("relpath")), scoped, ["dir"], rows=FILE_ROWS)
                .withColumn("case", case_number(F.substring_index("relpath", "/", 1))))

    asked = file_ranges(plain, max(WHOLE_BYTES, 1), F.unix_seconds("mtime").alias("seconds"))
    lines, considered, expected = plain_lines(staging, asked, with_scope, tasks)

    # Members: staged once, so a pass over their chunks, one over their lines
    if members is not None:
        logs = members.where(is_log_name())
        about = with_scope(member_stats(logs)).where(is_relevant(F.col("mentions")))
        about = staging.table(about.select("archive", "relpath", "expected", *fields), "about")
        lines = lines.unionByName(member_documents(logs.coalesce(tasks), about))
        considered = considered.union(names.where(is_log_name()).select("relpath"))
        expected = expected.union(about.select("relpath", "expected"))

    documents = as_documents(with_ingest_time(lines, millis)).coalesce(tasks)
    store.write("lines", batch, documents)
    written = spark.read.schema(S.LOG_LINES).parquet(store.batch_path("lines", batch))
    files = (considered.join(expected, "relpath", "left").withColumn("expected", F.coalesce("expected", F.lit(0)))
             .withColumn("case", case_number(F.substring_index("relpath", "/", 1))))
    store.write("report", batch, ingest_report(written, with_ingest_time(files, millis)))
    store.write("errors", batch, errors if errors is not None
                else spark.createDataFrame([], S.ARCHIVE_ERRORS).coalesce(1))


def plain_lines(staging: Staging, ranges: DataFrame, with_scope: Callable[[DataFrame], DataFrame], tasks: int):
    """Lines of the files of ``ranges`` (see ``file_ranges``) that count, the names of all of them, and how many lines each must have.

    A pass over the files notes of each range how many lines it has, its first undecodable line and its first mention of the product,
    which is a small table. A second reads the ranges of the files that count; what their lines take over goes through the tasks that
    read, so text is neither shuffled nor joined.
    """
    size = max(WHOLE_BYTES, 1)
    facts = with_facts(range_chunks(ranges.repartition(tasks, "relpath", "part"), size)).drop("content", "first_line").repartition("relpath")
    stats = facts.groupBy(*ranges.columns).agg(F.max("last").alias("n"), F.min("bad").alias("bad"), F.min("token").alias("token"))
    whole = Window.partitionBy("relpath")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    counted = F.coalesce(F.min(F.col("bad") + F.col("base")).over(whole) - 1, F.sum("n").over(whole))
    mentions = F.coalesce(F.min(F.col("token") + F.col("base")).over(whole) <= F.col("expected"), F.lit(False))
    stats = staging.table(stats.withColumn("expected", counted).withColumn("mentions", mentions).drop("n", "bad", "token"), "plain-stats")
    placed = with_scope(stats).where(is_relevant(F.col("mentions")))
    fields = [f"`{c}`" for c in _DOC_FIELDS]
    kept = [c for c in ranges.columns if c in ("relpath", "source", "length", "part", "seconds")]
    placed = staging.table(placed.select(*kept, "base", "expected", *fields), "plain-placed")
    asked = placed.where("base < expected").repartition(tasks, "relpath", "part")
    read = range_chunks(asked, size).withColumn("first_line", F.col("first_line") + F.col("base"))
    lines = member_lines(read, "expected", *fields).where(F.col("line_no") <= F.col("expected"))
    return (lines.select("relpath", "line_no", F.col("value").alias("message"), *fields), stats.where("part = 0").select("relpath"),
            placed.where("part = 0").select("relpath", "expected"))


def member_documents(members: DataFrame, about: DataFrame) -> DataFrame:
    """Lines of the members in ``about``, with its fields. A member is one row of ``about``: beyond the limit none is copied."""
    fields = [f"`{c}`" for c in _DOC_FIELDS]
    chunks = join_checked(members, about, ["archive", "relpath"], rows=FILE_ROWS)
    lines = member_lines(chunks, "expected", *fields).where(F.col("line_no") <= F.col("expected"))
    return lines.select("relpath", "line_no", F.col("value").alias("message"), *fields)


def _output_tasks(files: DataFrame, target_bytes: int = 128 << 20, unpacked: int = 8) -> int:
    """Tasks that each write documents of about ``target_bytes`` of text, but enough to keep all cores busy."""
    size = F.when(F.col("is_archive"), F.col("length") * unpacked).otherwise(F.col("length"))
    total = files.agg(F.sum(size).alias("bytes")).first()["bytes"] or 0
    return max(4 * files.sparkSession.sparkContext.defaultParallelism, total // target_bytes + 1)


def _unpack(staging: Staging, tree: DataFrame, current: DataFrame):
    """Members and errors of the archives of a batch, expanded once; ``None, None`` without archives."""
    found = current.where("is_archive")
    if found.isEmpty():
        return None, None
    archives = staging.table(skip_unpacked(found, tree.select(F.col("relpath").alias("path"))), "archives")
    named = is_log_name() | F.col("relpath").rlike(SIDECAR_PATTERN)
    expanded = staging.table(expand_in_parts(archives, staging, named), "members")
    members = good_members(expanded)
    # Two archives may hold the same path; the one later in scan order is the one that stays.
    owners = members.groupBy("relpath").agg(F.min("archive").alias("archive"),
                                            F.count_distinct("archive").alias("owners"))
    losers = (members.select("relpath", "archive").distinct()
              .join(owners.where(F.col("owners") > 1).withColumnRenamed("archive", "owner"), "relpath")
              .where(F.col("archive") != F.col("owner")).select("relpath", "archive"))
    losers = staging.table(losers, "losers")
    if not losers.isEmpty():
        members = members.join(F.broadcast(losers) if is_small(losers) else losers,
                               ["relpath", "archive"], "left_anti")
    return members, archive_errors(expanded)


def member_stats(members: DataFrame) -> DataFrame:
    """Per member: how many of its lines count, and whether one of them mentions the product."""
    stats = with_facts(members).groupBy("archive", "relpath").agg(
        F.max("last").alias("last"), F.min("bad").alias("bad"), F.min("token").alias("token"))
    counted = F.coalesce(F.col("bad") - 1, F.col("last"))
    return stats.select("archive", "relpath", counted.alias("expected"),
                        F.coalesce(F.col("token") <= counted, F.lit(False)).alias("mentions"))
