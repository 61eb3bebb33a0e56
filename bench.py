"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is run to the end (all its rows are computed, none is fetched). ``sql_engine`` holds, as a
yardstick, the time a single-node SQL engine takes for the SQL of the same query on the same tables.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES, SQL, _tree  # noqa: E402
from loglens.plans.ingest import ingest  # noqa: E402
from loglens.session import build_session  # noqa: E402
from loglens.sources.tables import LogTable  # noqa: E402

HEADLINE = ["occurrence_report", "occurrence_total", "occurrence_by_version", "occurrence_pre10", "occurrence_exact_version",
            "occurrence_batch", "nodes_without_match", "node_counts_topn", "token_counts", "documents_of_lines",
            "find_lines", "version_labels", "path_parts", "category_of_paths", "release_version", "scope_resolution",
            "relevant", "unpacked_skipped", "window_filter", "pending_files", "ledger_roundtrip", "latest_lines",
            "superseded_ingests", "archive_members", "utf8_cut", "occurrence_stream"]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def ingest_speed(spark, sf_dir: str) -> dict:
    """Lines per second from a tree of bundles to committed documents; building the tree is not timed."""
    root = _tree(spark, sf_dir)
    store = root.removesuffix("/in") + "/store"
    seconds = timed(lambda: ingest(spark, root, store, lag_s=-3600))
    table = LogTable(spark, store)
    lines, files = table.current_lines().count(), table.report().count()
    question = timed(lambda: run(_ask(table)))
    return {"seconds": seconds, "lines": lines, "files": files, "lines_per_second": round(lines / seconds, 1),
            "question_on_stored_table": question}


def _ask(table: LogTable):
    from loglens.plans.occurrence import occurrences
    return occurrences(table.current_lines(), "and the of with error")


def yardstick(sf_dir: str, names: list[str]) -> dict:
    try:
        import duckdb
    except ImportError:
        return {}
    engine, times = duckdb.connect(), {}
    engine.execute(f"SET threads TO {int(os.environ.get('BENCH_CPUS', '8'))}")
    for path in Path(sf_dir).glob("*.parquet"):
        engine.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    for name in names:
        times[name] = timed(lambda: engine.execute(SQL[name]).fetchall())
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    run(QUERIES["table_stats"](spark, sf_dir))                  # the first job pays for starting up
    times = {}
    for name in names:
        times[name] = timed(lambda: run(QUERIES[name](spark, sf_dir)))
    speed = ingest_speed(spark, sf_dir) if not os.environ.get("BENCH_QUERIES") else {}
    if speed:
        times["ingest"] = speed["seconds"]
        times["occurrence_on_stored_table"] = speed["question_on_stored_table"]
    print(json.dumps({"metric": "headline queries, total time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(cpus),
                      "ingest": speed, "sql_engine": yardstick(sf_dir, names)}))
    spark.stop()


if __name__ == "__main__":
    main()
