"""Continuous ingest that keeps the scopes of each case in state, so that files may come in any order.

Files of the ``bundle_files`` stream are keyed by case. The state of a case holds its scopes (marker directories and what their sidecars say),
the fields last given to each directory with files, and the files that still wait: those outside any node, which count only if they
mention the product, and archives, whose members take over fields of the directories around them. Many files that come at once wait in
packs, a row of the state each. It holds no lines, and nothing is listed again.

- A new file is read with the fields its directory has by then.
- A marker or sidecar that comes later corrects what is stored: each directory whose fields it changes gives a row of the ``scopes`` table, which
  ``LogTable.current_lines`` puts over older lines. Waiting files that lie in a node now are read again.
- With a processing-time trigger, files that have waited for ``wait_s`` are forgotten: a timer bounds the state.

Markers and sidecars that lie within archives count for members of the same archive. A sidecar is looked at in one piece.
"""

import pickle
import time
import uuid
import zlib
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from loglens import schema as S
from loglens.functions import fields
from loglens.functions.paths import base_name, dir_name, plain_uri, strip_all_archive_exts
from loglens.functions.predicates import is_log_name
from loglens.operators.documents import CARRIED, as_documents, with_ingest_time
from loglens.operators.relevance import is_relevant
from loglens.operators.scope import MISSING, SIDECAR_PATTERN, node_scopes, resolve_scope
from loglens.plans.ingest import FILE_ROWS, _output_tasks, _unpack, member_documents, member_stats, plain_lines
from loglens.session import Staging, join_checked, ship_package
from loglens.sources.archives import _open, member_lines
from loglens.sources.bundles import bundle_stream, file_ranges
from loglens.sources.lines import WHOLE_BYTES, content_lines
from loglens.sources.listing import open_store, qualify, root_path
from loglens.sources.tables import LogTable, ingest_report

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
WAIT_S = 24 * 60 * 60

# Waiting files of a case from which on they are kept in packs, files of a pack, and files in new packs from which on packs are put together.
PACK_FROM = 1_000
PACK_ROWS = 10_000
FOLD_FROM = 100_000

_FIELDS = "node_name string, grid_id string, time_span string, category string, platform string, major_version int, minor_version int"
_FILE = "relpath string, dir string, uri string, mtime timestamp, length long, is_archive boolean"
CHANGES = f"kind string, {_FILE}, {_FIELDS}"
_NAMES = [c.strip().split(" ")[0] for c in CHANGES.split(",")]
_NONE = tuple(MISSING[n] for n in S.SCOPE_FIELDS)


# --- from files to what they say ------------------------------------------------------------------------


def _with_content(batches):
    """The content of sidecars, none of other files."""
    for batch in batches:
        contents = []
        for source in batch["sidecar"]:
            if source is None or pd.isna(source):
                contents.append(None)
                continue
            with _open(source) as stream:
                contents.append(stream.read())
        yield batch.drop(columns="sidecar").assign(content=contents)


def file_events(files: DataFrame, base: str) -> DataFrame:
    """One row per file with its ``kind`` (marker, version, platform, file), the directory it speaks for, and what it says of it."""
    ship_package(files.sparkSession)
    name, is_sidecar = base_name("relpath"), F.col("relpath").rlike(SIDECAR_PATTERN)
    kinds = F.array_compact(F.array(
        F.when(name == S.MARKER_FILE, F.lit("marker")), F.when(name == S.VERSION_SIDECAR, F.lit("version")),
        F.when(is_sidecar & (name != S.VERSION_SIDECAR), F.lit("platform")),
        F.when(F.col("is_archive") | is_log_name(), F.lit("file"))))
    asked = files.select(*S.FILES.names, F.when(is_sidecar, plain_uri("uri")).alias("sidecar"))
    read = asked.mapInPandas(_with_content, "relpath string, uri string, mtime timestamp, length long, is_archive boolean, content binary")
    lines = content_lines(F.col("content"))
    bad = F.array_position(F.transform(lines, lambda x: ~F.is_valid_utf8(x)), F.lit(True))
    readable = F.flatten(F.transform(F.when(bad > 0, F.slice(lines, F.lit(1), (bad - 1).cast("int"))).otherwise(lines),
                                     lambda x: F.split(x, "\r", -1)))
    release = fields.release_version(F.try_element_at(F.filter(readable, lambda x: x.contains(S.RELEASE_MARK)), F.lit(1)))
    platform = F.try_element_at(F.filter(F.transform(readable, fields.platform_of), lambda x: x.isNotNull()), F.lit(1))
    owner = F.when(F.col("kind") == "platform", F.regexp_replace("relpath", f"(^|/){S.PLATFORM_SIDECAR}$", "")).otherwise(dir_name("relpath"))
    whole = F.concat(F.lit(base.rstrip("/") + "/"), F.col("dir"))
    return (read.withColumn("kind", F.explode(kinds)).withColumn("dir", owner)
            .withColumn("release", F.when(F.col("kind") == "version", release))
            .select(F.substring_index("relpath", "/", 1).alias("case"), "kind", *[c.strip().split(" ")[0] for c in _FILE.split(",")],
                    fields.node_name(whole).alias("node_name"), fields.grid_id(whole).alias("grid_id"), fields.time_span(whole).alias("time_span"),
                    fields.category_of(whole).alias("category"), F.when(F.col("kind") == "platform", platform).alias("platform"),
                    F.coalesce("release.major_version", F.lit(S.MISSING_VERSION)).alias("major_version"),
                    F.coalesce("release.minor_version", F.lit(S.MISSING_VERSION)).alias("minor_version")))


# --- the state of a case --------------------------------------------------------------------------------


def resolved(directory: str, scopes: dict) -> tuple:
    """Fields of a directory, every missing one from the nearest scope around it that has it."""
    out, parts = list(_NONE), directory.split("/")
    version = len(_NONE) - 2
    for n in range(len(parts), 0, -1):
        marker, *given = scopes.get("/".join(parts[:n]), (False,))
        if marker:
            for i in range(version):
                if out[i] == _NONE[i] and given[i] is not None:
                    out[i] = given[i]
            if tuple(out[version:]) == _NONE[version:]:
                out[version:] = given[version:]
    return tuple(out)


class CaseScopes(StatefulProcessor):
    def __init__(self, wait_s: int, timers: bool):
        self.wait_ms, self.timers, self.packs = wait_s * 1000, timers, None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.scopes = handle.getMapState("scopes", "dir string", f"marker boolean, {_FIELDS}")
        self.dirs = handle.getMapState("dirs", "dir string", _FIELDS)
        self.waiting = handle.getMapState("waiting", "relpath string", f"{_FILE.split(', ', 1)[1]}, {_FIELDS}, since long")
        self.packs = handle.getMapState("packs", "id string, whole boolean, files int", "since long, content binary")

    @staticmethod
    def _learn(row, scopes: dict) -> bool:
        """Take in a marker or a sidecar; whether that changes anything."""
        old = scopes.get(row.dir, (False, *_NONE))
        new = list(old)
        if row.kind == "marker":
            new[:5] = True, row.node_name, row.grid_id, row.time_span, row.category
        elif row.kind == "version":
            new[6:] = int(row.major_version), int(row.minor_version)
        else:
            new[5] = MISSING["platform"] if row.platform is None or pd.isna(row.platform) else row.platform
        scopes[row.dir] = tuple(new)
        return tuple(new) != tuple(old)

    def handleInputRows(self, key, rows, timerValues):
        scopes, changed, files = {k[0]: tuple(v) for k, v in self.scopes.iterator()}, set(), []
        for batch in rows:
            is_file = batch["kind"] == "file"
            files.append(batch[is_file])
            changed.update(row.dir for row in batch[~is_file].itertuples(index=False) if self._learn(row, scopes))
        for directory in changed:                               # once a directory, however many of its files speak for it
            self.scopes.updateValue((directory,), scopes[directory])
        if changed:
            yield from _frames(self._corrected(scopes, {path for part in files for path in part["relpath"]}))
        yield from _frames(self._arrived(files, scopes))

    def _arrived(self, files: list[pd.DataFrame], scopes: dict):
        now, given, wait = int(time.time() * 1000), {}, []
        for row in (row for part in files for row in part.itertuples(index=False)):
            known = given.get(row.dir)
            if known is None:                               # the state is asked once a directory, not once a file
                known = given[row.dir] = resolved(row.dir, scopes)
                self.dirs.updateValue((row.dir,), known)
            file = (row.dir, row.uri, row.mtime.to_pydatetime(), int(row.length), bool(row.is_archive))
            yield ("read", row.relpath, *file, *known)
            if row.is_archive or known[0] == MISSING["node_name"]:
                wait.append((row.relpath, *file, *known, now))
        self._keep(wait)
        if wait and self.timers:
            self.handle.registerTimer(now + self.wait_ms)

    def _keep(self, wait: list[tuple]) -> None:
        """Have files wait: a few as a row each, many in packs, for each row of a state costs a call."""
        if len(wait) <= PACK_FROM:
            for relpath, *file in wait:
                self.waiting.updateValue((relpath,), tuple(file))
            return
        held = [tuple(k) for k in self.packs.keys()]
        whole = sum(files for _, is_whole, files in held if is_whole)
        fold = sum(files for _, is_whole, files in held if not is_whole) > max(whole, FOLD_FROM)
        if fold:                                            # older packs still have files that came again
            latest = {file[0]: file for _, files in self._waits() for file in files}
            wait = list({**latest, **{file[0]: file for file in wait}}.values())
            for key in held:
                self.packs.removeKey(key)
            for (relpath,) in list(self.waiting.keys()):
                self.waiting.removeKey((relpath,))
        for at in range(0, len(wait), PACK_ROWS):
            part = wait[at:at + PACK_ROWS]
            self.packs.updateValue((uuid.uuid4().hex, fold, len(part)), _packed(part))

    def _waits(self, newest_first: bool = False):
        """``(key, waiting files)`` of all rows of the state, by the time at which the last of them came; one pack is unpacked at a time."""
        rows = [(file[-1], 1, key, (*key, *file)) for key, file in ((tuple(k), tuple(v)) for k, v in self.waiting.iterator())]
        if self.packs is not None:
            rows += [(since, 0, tuple(key), content) for key, (since, content) in self.packs.iterator()]
        for _, _, key, files in sorted(rows, key=lambda row: row[:3], reverse=newest_first):
            yield key, [files] if len(key) == 1 else pickle.loads(zlib.decompress(files))

    def _corrected(self, scopes: dict, arrived: set):
        """Corrections of directories, and the waiting files to read again; those that have just ``arrived`` are read anyway."""
        for (directory,), old in list(self.dirs.iterator()):
            new = resolved(directory, scopes)
            if new != tuple(old):
                self.dirs.updateValue((directory,), new)
                yield ("scope", None, directory, None, None, None, None, *new)
        given = {}

        def now_in(directory):
            if directory not in given:
                given[directory] = resolved(directory, scopes)
            return given[directory]

        seen = set(arrived)
        for key, files in self._waits(newest_first=True):       # of a file that came again, the latest counts
            kept, same = [], True
            for relpath, *rest, since in files:
                file, old, new = tuple(rest[:5]), tuple(rest[5:]), now_in(rest[0])
                if relpath in seen:
                    same = False
                    continue
                seen.add(relpath)
                if new != old:
                    same = False
                    yield ("read", relpath, *file, *new)
                    if not (file[4] or new[0] == MISSING["node_name"]):
                        continue
                kept.append((relpath, *file, *new, since))
            self._replace(key, kept, same)

    def _replace(self, key: tuple, kept: list[tuple], same: bool) -> None:
        if same:
            return
        state, value = (self.waiting, kept and kept[0][1:]) if len(key) == 1 else (self.packs, kept and _packed(kept))
        if kept:
            state.updateValue(key, value)
        else:
            state.removeKey(key)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        until = timerValues.getCurrentProcessingTimeInMs() - self.wait_ms
        for held, files in self._waits():
            kept = [file for file in files if file[-1] > until]
            self._replace(held, kept, len(kept) == len(files))
        yield pd.DataFrame([], columns=_NAMES)

    def close(self) -> None:
        pass


def _packed(files: list[tuple]) -> tuple:
    """A pack of waiting files, each with its path in front and the time at which it came behind."""
    return max(file[-1] for file in files), zlib.compress(pickle.dumps(files), 1)


def _frames(rows, size: int = 10_000):
    """Rows as data frames, at least one."""
    rows, some = iter(rows), False
    while part := list(islice(rows, size)):
        some = True
        yield pd.DataFrame(part, columns=_NAMES)
    if not some:
        yield pd.DataFrame([], columns=_NAMES)


# --- what a micro-batch writes -----------------------------------------------------------------------------


def _existing(batches):
    from pyarrow import fs
    for batch in batches:
        there = []
        for target in batch["target"]:
            store, path = open_store(target)
            there.append(store.get_file_info(path).type != fs.FileType.NotFound)
        yield batch[there][["relpath"]]


def write_files(spark: SparkSession, store: LogTable, staging: Staging, base: str, reads: DataFrame, millis: int, batch: str) -> None:
    """Lines, report and errors of ``reads``: files with the fields of their directories."""
    targets = reads.where("is_archive").select(strip_all_archive_exts("relpath").alias("relpath"),
                                               strip_all_archive_exts(plain_uri("uri")).alias("target"))
    ship_package(spark)
    members, errors = _unpack(staging, targets.mapInPandas(_existing, "relpath string"), reads)
    tasks, case = _output_tasks(reads), F.substring_index("relpath", "/", 1).alias("case")
    plain = file_ranges(reads.where(~F.col("is_archive") & is_log_name()), max(WHOLE_BYTES, 1), case, *S.SCOPE_FIELDS)
    lines, considered, expected = plain_lines(staging, plain, lambda files: files, tasks)
    if members is not None:
        fields_of = [f"`{c}`" for c in CARRIED]
        packed = staging.table(members.select("relpath", "archive").distinct(), "names")
        inside = member_lines(members.where(F.col("relpath").rlike(SIDECAR_PATTERN)))
        sidecars = inside.select("relpath", F.lit(0).cast("bigint").alias("block"), F.col("line_no").alias("mid"), "value")
        around = reads.where("is_archive").select("dir", F.size(F.split("dir", "/")).alias("depth"), *S.SCOPE_FIELDS).distinct()
        scopes = staging.table(node_scopes(packed, sidecars, base).unionByName(around), "scopes")
        names = packed.where(is_log_name()).select("relpath")
        scoped = staging.table(resolve_scope(names.select(dir_name("relpath").alias("dir")).distinct(), scopes, FILE_ROWS), "scoped")
        logs = members.where(is_log_name())
        about = (join_checked(member_stats(logs).withColumn("dir", dir_name("relpath")), scoped, ["dir"], rows=FILE_ROWS)
                 .withColumn("case", F.substring_index("relpath", "/", 1)))
        about = staging.table(about.where(is_relevant(F.col("mentions"))).select("archive", "relpath", "expected", *fields_of), "about")
        lines = lines.unionByName(member_documents(logs.coalesce(tasks), about))
        considered, expected = considered.union(names), expected.union(about.select("relpath", "expected"))
    documents = as_documents(with_ingest_time(lines, millis)).coalesce(tasks)
    store.write("lines", batch, documents)
    written = spark.read.schema(S.LOG_LINES).parquet(store.batch_path("lines", batch))
    files = (considered.join(expected, "relpath", "left")
             .withColumn("expected", F.coalesce("expected", F.lit(0))).withColumn("case", F.substring_index("relpath", "/", 1)))
    store.write("report", batch, ingest_report(written, with_ingest_time(files, millis)))
    store.write("errors", batch, errors if errors is not None else spark.createDataFrame([], S.ARCHIVE_ERRORS).coalesce(1))


def stream_scoped_ingest(spark: SparkSession, root: str, table: str, checkpoint: str, lag_s: int = S.SAFETY_LAG_S,
                         wait_s: int = WAIT_S, **trigger) -> StreamingQuery:
    """Ingest files below the case directories of ``root`` as they appear, in whatever order markers, sidecars and logs come.

    A micro-batch replayed after a failure replaces the files it ingested the first time. ``trigger`` defaults to ``availableNow=True``,
    under which nothing is forgotten: processing-time timers would keep such a query from ending.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    store, where, base = LogTable(spark, table), qualify(spark, root), root_path(spark, root)
    trigger = trigger or {"availableNow": True}
    timers = "processingTime" in trigger
    changes = file_events(bundle_stream(spark, root, lag_s), base).groupBy("case").transformWithStateInPandas(
        CaseScopes(wait_s, timers), CHANGES, "Update", "ProcessingTime" if timers else "None")

    def step(found: DataFrame, _: int) -> None:
        session = found.sparkSession
        staging, millis, held = Staging(session), int(round(time.time() * 1000)), session.conf.get("spark.sql.shuffle.partitions")
        try:
            changed = staging.table(found, "changes")
            session.conf.set("spark.sql.shuffle.partitions", partitions)
            if changed.isEmpty():
                return
            batch = f"{S.SCOPED_BATCH}{millis}-{uuid.uuid4().hex[:8]}"
            corrections = changed.where("kind = 'scope'").select("dir", *S.SCOPE_FIELDS)
            store.write("scopes", batch, with_ingest_time(corrections, millis).repartition("dir"))
            write_files(session, store, staging, base, changed.where("kind = 'read'").drop("kind"), millis, batch)
            cases = changed.select(F.substring_index("dir", "/", 1).alias("case")).distinct()
            cases = sorted(r["case"] for r in cases.collect())       # as many as there are case directories, which the stream lists too
            store.ledger.append(S.FIRST_WINDOW_START, millis // 1000 + 1, f"stream:{where}", cases, batch)
        finally:
            session.conf.set("spark.sql.shuffle.partitions", held)
            staging.drop()

    # A partition of the state holds cases, which are few, and each is opened for every micro-batch. The query keeps the number it starts with.
    spark.conf.set("spark.sql.shuffle.partitions", min(int(partitions), 4 * spark.sparkContext.defaultParallelism))
    try:
        return _started(changes, step, checkpoint, trigger)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)


def _started(changes: DataFrame, step, checkpoint: str, trigger: dict) -> StreamingQuery:
    return (changes.writeStream.outputMode("update").foreachBatch(step).option("checkpointLocation", checkpoint)
            .trigger(**trigger).start())
