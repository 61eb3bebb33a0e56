"""Archives and directory trees made from the documents, by tasks, for the checks that need files."""

import gzip
import io
import re
import tarfile
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.tables import table
from loglens.session import give_back, shared_dir
from loglens.sources.listing import list_files, open_store, qualify


# Bytes of text that one task makes files from, and directories that files are put in to be listed side by side.
TASK_BYTES = 8 << 20
SHARDS = 256


def dealt(docs: DataFrame, *keys: str) -> DataFrame:
    """``docs`` dealt by ``keys`` over all cores, and over more tasks the more text there is."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    return docs.repartition(max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES)), *keys)


def _tar(members: dict[str, bytes], mode: str = "w") -> bytes:
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode=mode) as tar:
        for name, data in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    return out.getvalue()


def _zip(members: dict[str, bytes], method: int = zipfile.ZIP_DEFLATED) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as archive:
        for name, data in members.items():
            archive.writestr(name, data)
    return out.getvalue()


def _pack(doc_id: int, text: bytes) -> tuple[str, bytes]:
    name = f"a{doc_id}"
    return [
        lambda: (f"{name}.log.gz", gzip.compress(text)),
        lambda: (f"{name}.tar", _tar({"d/x.log": text, "n.zip": _zip({"inner.txt": text})})),
        lambda: (f"{name}.tgz", _tar({"x.log": text}, "w:gz")),
        lambda: (f"{name}.zip", _zip({"one.log": text, "sub/two.log": text})),
        lambda: (f"{name}.log.zip", _zip({f"{name}.log": text})),
        lambda: (f"{name}.zip", b"not an archive " + text),
    ][doc_id % 6]()


def _pack_batches(batches):
    for batch in batches:
        rows = [_pack(d, t.encode()) for d, t in zip(batch["doc_id"], batch["text"])]
        yield pd.DataFrame({"relpath": [r[0] for r in rows], "content": [r[1] for r in rows]})
    give_back()


def _spoil_batches(batches):
    for batch in batches:
        data = [gzip.compress(t.encode() + (b"\n\xff\xfe\n" + t.encode() if d % 3 == 0 else b""))
                for d, t in zip(batch["doc_id"], batch["text"])]
        yield pd.DataFrame({"relpath": [f"{d}.log.gz" for d in batch["doc_id"]], "content": data})
    give_back()


def _made(spark: SparkSession, sf_dir: str, make) -> DataFrame:
    from loglens.session import ship_package
    ship_package(spark)
    made = dealt(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return (made.mapInPandas(make, "relpath string, content binary")
            .withColumn("mtime", F.timestamp_seconds(F.lit(0))))


def packed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in an archive of one of six kinds; the last kind is unreadable."""
    return _made(spark, sf_dir, by_value(_pack_batches))


def _bundle_batches(batches):
    """Each bundle of documents in a deflated zip, a stored zip or a tar, with a member that is no log before each document."""
    for batch in batches:
        rows = []
        for bundle, docs in batch.itertuples(index=False):
            members = {}
            for doc in docs:
                members[f"bin/{doc['doc_id']}.dat"] = bytes(range(256))
                members[f"logs/{doc['doc_id']}.log"] = doc["text"].encode()
            make, ext = [(_zip, "zip"), (lambda m: _zip(m, zipfile.ZIP_STORED), "zip"), (_tar, "tar")][bundle % 3]
            rows.append((f"b{bundle}.{ext}", make(members)))
        yield pd.DataFrame(rows, columns=["relpath", "content"])


def bundled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in archives of 64 each, listed from the shared folder."""
    from loglens.session import ship_package
    ship_package(spark)
    docs = table(spark, sf_dir, "documents").where("doc_id is not null").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    bundles = (dealt(docs.withColumn("bundle", F.expr("doc_id div 64")), "bundle").groupBy("bundle")
               .agg(F.collect_list(F.struct("doc_id", "text")).alias("docs")))
    return stored(spark, bundles.mapInPandas(by_value(_bundle_batches), "relpath string, content binary"))


ODD_NAMES = """
SELECT doc_id, CAST(3000000000 + doc_id % 40 AS VARCHAR(20)) || CASE doc_id % 7 WHEN 0 THEN '/.hidden/' || CAST(doc_id AS VARCHAR(20)) || '.log'
    WHEN 1 THEN '/_under/' || CAST(doc_id AS VARCHAR(20)) WHEN 2 THEN '/a/b/c/d/e/f/g/h/' || CAST(doc_id AS VARCHAR(20)) || '.bz2'
    WHEN 3 THEN '/x y+%20=é ' || CAST(doc_id AS VARCHAR(20)) || '.log' WHEN 4 THEN '/empty/' || CAST(doc_id AS VARCHAR(20)) || '.log'
    WHEN 5 THEN '/s/' || CAST(doc_id AS VARCHAR(20)) || '.snappy' ELSE '/p/' || CAST(doc_id AS VARCHAR(20)) || '.txt' END AS relpath,
  CASE WHEN doc_id % 7 = 4 THEN '' ELSE text END AS text FROM {documents}"""


def odd_tree(spark: SparkSession, sf_dir: str) -> str:
    """Every document as a file whose name or content other readers may pass over; returns the directory."""
    from loglens.session import ship_package
    ship_package(spark)
    files = spark.sql(ODD_NAMES.format(documents="{documents}"), documents=table(spark, sf_dir, "documents"))
    return written(spark, dealt(files, "doc_id").select("relpath", F.col("text").cast("binary").alias("content")))


def spoiled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document gzipped; every third goes on after an undecodable line."""
    return _made(spark, sf_dir, by_value(_spoil_batches))


def by_value(function):
    """Have the functions of this module sent to the tasks with the job; executors need not have it."""
    import sys
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    return function


def _write_batches(batches):
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            filesystem, name = open_store(path)
            filesystem.create_dir(name.rsplit("/", 1)[0], recursive=True)
            with filesystem.open_output_stream(name, compression=None) as out:
                out.write(content)
        yield pd.DataFrame({"written": [len(batch)]})


def _tree_batches(batches):
    """Files of the tree: where a document lies decides its node, version and platform."""
    for batch in batches:
        rows = []
        for doc, case, grid, node, lang, text in batch.itertuples(index=False):
            data, major = text.encode(), [9, 10, 10, 11, -1][doc % 5]
            if node == "Unknown":
                name = f"{case}/loose{doc % 3}/{'bycast_' if doc % 2 else ''}{doc}.txt"
                rows.append((name, data))
                continue
            span = f"{case}/{grid}-{lang}/{node}/{20000000 + doc % 5}-30000000"
            rows.append((f"{span}/lumberjack.log", b"marker\n"))
            if major >= 0:
                rows.append((f"{span}/system_commands",
                             f"x\nstorage-grid-release-{major}.{[0, 2, 4, 1][doc % 5]}.0-1\n".encode()))
            if lang in ("en", "de"):
                rows.append((f"{span}/os/etc/user_data", f"HV_ENV={'vSphere' if lang == 'en' else 'SGA'}\n".encode()))
            inside = f"{span}/logs/{doc}.log"
            if doc % 10 == 7:
                rows.append((f"{inside}.gz", gzip.compress(data)))
            elif doc % 10 == 8:
                rows.append((f"{span}/pack{doc}.tar", _tar({f"in/{doc}.log": data})))
            else:
                rows.append((inside, data))
        yield pd.DataFrame({"relpath": [r[0] for r in rows], "content": [r[1] for r in rows]})


def tree_files(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Files of a tree of support bundles that holds the documents of ``DOC_FILES``."""
    by_value(_tree_batches)
    return (dealt(files, "doc_id").mapInPandas(_tree_batches, "relpath string, content binary")
            .groupBy("relpath").agg(F.max("content").alias("content")))


def write_tree(spark: SparkSession, files: DataFrame) -> str:
    """Write the documents of ``DOC_FILES`` as a tree of support bundles; returns its root."""
    return written(spark, tree_files(spark, files))


def written(spark: SparkSession, files: DataFrame, root: str | None = None) -> str:
    """Write ``files`` (``relpath``, ``content``) to a directory, by default a new one in the shared folder; returns it."""
    import uuid
    by_value(_write_batches)
    root = root or f"{shared_dir(spark)}/loglens-tree-{uuid.uuid4().hex}/in"
    uri = re.sub("^file:/+", "file:///", qualify(spark, root))
    paths = files.select(F.concat(F.lit(f"{uri}/"), "relpath").alias("path"), "content")
    paths.mapInPandas(_write_batches, "written long").agg(F.sum("written")).collect()
    return root


def stored(spark: SparkSession, files: DataFrame) -> DataFrame:
    """``files``, written to the shared folder, each to one of ``SHARDS`` directories, and listed by their names there."""
    shard = F.pmod(F.xxhash64("relpath"), F.lit(SHARDS)).cast("string")
    root = written(spark, files.withColumn("relpath", F.concat_ws("/", shard, "relpath")))
    listed = list_files(spark, root, [str(i) for i in range(SHARDS)])
    return listed.withColumn("relpath", F.regexp_replace("relpath", "^[0-9]+/", ""))
