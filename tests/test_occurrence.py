import random

from pyspark.sql import functions as F
import pytest

from loglens import schema as S
from loglens.functions.text import tokenize
from loglens.plans import occurrence as O
from loglens.plans.postings import build_index, indexed_occurrences
from loglens.session import Staging
from loglens.streaming.occurrences import saved_snippets, stream_occurrences

COLUMNS = "node_name string, major_version int, minor_version int, platform string, message string"
WORDS = ["disk", "error", "on", "volume", "the", "a", "of", "node-1", "10.5", "timeout"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    for node in range(40):
        major, minor = rng.choice([(9, 0), (10, 2), (10, 4), (11, 1), (-1, -1)])
        for _ in range(rng.randint(1, 12)):
            out.append((f"n{node}", major, minor, rng.choice(["vSphere", "SGA", "Unknown"]),
                        " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 8)))))
    # one node and one line make up a third of everything
    return out + [("Unknown", -1, -1, "Unknown", "disk error on volume")] * (len(out) // 2)


@pytest.fixture(scope="module")
def lines(spark, rows):
    return spark.createDataFrame(rows, COLUMNS).repartition(4).cache()


def words_of(text):
    return text.replace("node-1", "node 1").split()


def hit(message, snippet):
    wanted = words_of(snippet)
    return sum(w in words_of(message) for w in wanted) >= max(1, len(wanted) * 75 // 100) if wanted else False


def brute(rows, snippet, keep=lambda r: True, version_chart=True, platform_chart=True, cap=None):
    kept = [r for r in rows if keep(r)]
    hits = [r for r in kept if hit(r[4], snippet)]
    matched = {r[0] for r in hits}
    out = {("Occurances", "Occurs", len(matched)), ("Occurances", "Does not occur", len({r[0] for r in kept} - matched))}
    for chart, label, wanted in (("Occurances by Version", lambda r: "Unknown" if r[1] == -1 else str(r[1]), version_chart),
                                 ("Occurances by Platform", lambda r: r[3], platform_chart)):
        for value in {label(r) for r in hits} if wanted else ():
            count = len({r[0] for r in hits if label(r) == value})
            out.add((chart, value, min(count, cap) if cap else count))
    return out


def got(df):
    return {tuple(r) for r in df.collect()}


SNIPPETS = ["disk error", "disk disk error on the volume", "timeout of node-1 10.5", "nothing like this at all", "the", "..."]


@pytest.mark.parametrize("snippet", SNIPPETS)
def test_single(lines, rows, snippet):
    assert got(O.occurrences(lines, snippet)) == brute(rows, snippet)


@pytest.mark.parametrize("version, keep", [
    ("Pre-10", lambda r: 0 < r[1] < 10), ("10.4", lambda r: r[1:3] == (10, 4)), ("Unknown", lambda r: r[1] == -1), ("", lambda r: True), (None, lambda r: True)])
def test_versions(lines, rows, version, keep):
    assert got(O.occurrences(lines, "disk error", version)) == brute(rows, "disk error", keep, version_chart=False)


@pytest.mark.parametrize("platform, stored", [("StorageGRID appliance", "SGA"), ("vSphere", "vSphere"), ("Container", "Container"), (None, None)])
def test_platforms(lines, rows, platform, stored):
    want = brute(rows, "disk error", lambda r: stored in (None, r[3]), platform_chart=False)
    assert got(O.occurrences(lines, "disk error", platform=platform)) == want


def test_options(lines, rows):
    assert got(O.occurrences(lines, "disk error", bucket_cap=3)) == brute(rows, "disk error", cap=3)
    assert got(O.occurrences(lines, "disk error", include_unknown=False)) == brute(rows, "disk error", lambda r: r[0] != "Unknown")
    by_label = {(c, l) for c, l, _ in got(O.occurrences(lines, "the", by="label")) if c == "Occurances by Version"}
    assert by_label == {("Occurances by Version", l) for l in ("Pre-10", "10.2", "10.4", "11.1", "Unknown")}
    total = {(l, v) for c, l, v in got(O.occurrences(lines, "disk error", node_cap=5)) if c == "Occurances"}
    assert total == {("Occurs", 5), ("Does not occur", 0)}
    for text in (None, ""):
        with pytest.raises(ValueError):
            O.occurrences(lines, text)
    with pytest.raises(ValueError):
        O.occurrences(lines, "x", "ten")


def test_charts_and_results(lines):
    charts = {r.title: (r.labels, r["values"]) for r in O.as_charts(O.occurrences(lines, "disk error", with_doc_counts=True)).collect()}
    assert charts["Occurances"][0] == ["Occurs", "Does not occur"] and set(charts) == {"Occurances", "Occurances by Version", "Occurances by Platform"}
    assert charts["Occurances by Version"][0][0] == "Unknown"       # most documents
    assert O.has_results(O.occurrences(lines, "disk error")).first()[0] is True
    assert O.has_results(O.occurrences(lines, "zzz")).first()[0] is False


def test_node_lists(lines, rows):
    counts = {}
    for r in rows:
        counts[r[0]] = counts.get(r[0], 0) + 1
    top = O.node_counts(lines, 5).collect()
    assert [(r.node_name, r.docs) for r in top] == sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:5]
    without = {r.node_name for r in O.nodes_without_match(lines, "disk error on volume").collect()}
    assert without == set(counts) - {r[0] for r in rows if hit(r[4], "disk error on volume")}


@pytest.fixture(scope="module")
def requests(spark):
    asked = [(i, text, "All Versions", "All Platforms") for i, text in enumerate(SNIPPETS)]
    asked += [(10, "disk error", "Pre-10", None), (11, "disk error", "10.4", "StorageGRID appliance"), (12, "the", "Unknown", "vSphere"),
              (13, "the", None, "All Platforms"), (14, "the", "ten", "All Platforms")]
    return spark.createDataFrame(asked, S.REQUESTS)


@pytest.mark.parametrize("broadcast", [True, False])
def test_batch_equals_single(lines, requests, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(O, "is_small", lambda *a, **k: False)
    batch = {}
    for r in O.occurrences_batch(lines, requests).collect():
        batch.setdefault(r.query_id, set()).add((r.chart, r.label, r.value, r.docs))
    for r in requests.collect():
        want = ({("Occurances", "Occurs", 0, 0), ("Occurances", "Does not occur", 0, 0)} if r.version == "ten"
                else got(O.occurrences(lines, r.log_text, r.version, r.platform, with_doc_counts=True)))
        assert batch[r.query_id] == want, r


def test_index_equals_scan(spark, lines, tmp_path):
    stored = (lines.withColumn("tokens", tokenize("message")).withColumn("relpath", F.col("node_name"))
              .withColumn("line_no", F.monotonically_increasing_id()).cache())
    build_index(stored, str(tmp_path / "index"))
    for snippet in SNIPPETS:
        for version, platform in (("All Versions", "All Platforms"), ("Pre-10", "SGA")):
            assert got(indexed_occurrences(spark, str(tmp_path / "index"), snippet, version, platform)) == got(
                O.occurrences(lines, snippet, version, platform)), snippet


def test_index_reads_only_its_words(spark, lines, tmp_path):
    stored = (lines.withColumn("tokens", tokenize("message")).withColumn("relpath", F.col("node_name"))
              .withColumn("line_no", F.monotonically_increasing_id()))
    build_index(stored, str(tmp_path / "index"))
    plan = indexed_occurrences(spark, str(tmp_path / "index"), "disk error")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(word" in plan or "In(word, [" in plan


def test_stream(spark, lines, requests, rows, tmp_path):
    lines.coalesce(3).write.parquet(str(tmp_path / "lines"))
    stream = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "lines"))
    counts, where = stream_occurrences(stream, saved_snippets(requests)), Staging(spark).path
    (counts.writeStream.outputMode("complete").foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(f"{where}/out"))
     .option("checkpointLocation", str(tmp_path / "seen")).trigger(availableNow=True).start().awaitTermination())
    found = {r.query_id: r.nodes for r in spark.read.parquet(f"{where}/out").collect()}
    batch = {r.query_id: r.value for r in O.occurrences_batch(lines, requests).collect() if r.label == "Occurs"}
    assert found == {q: n for q, n in batch.items() if n}


def test_lines_are_cut_into_words_once(lines):
    plan = O.occurrences(lines, "disk error on volume")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(regexp_replace(lower(") <= 2        # the two branches of one expression


def test_index_cuts_each_line_once(spark, lines, tmp_path):
    cut = spark.sparkContext.accumulator(0)

    def words(message):
        cut.add(1)
        return (message or "").split()

    stored = (lines.withColumn("tokens", F.udf(words, "array<string>")("message")).withColumn("relpath", F.col("node_name"))
              .withColumn("line_no", F.monotonically_increasing_id()))
    build_index(stored, str(tmp_path / "index"))
    assert cut.value == lines.count()
