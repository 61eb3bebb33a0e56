"""The pipeline, stage by stage, on planted cases."""

import random

import corpus_pipeline
import pytest
from test_quality import sentences

HEX = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b2b0b822c"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    item = " ".join(f"item{c}" for c in "abcdefghijkl")
    draw = random.Random(9)
    word = lambda: "".join(draw.choice(["an", "be", "cor", "du", "el"]) for _ in range(draw.randrange(2, 6)))
    clean = [f"{t} {' '.join(word() for _ in range(60))}" for t in sentences(6, 120)]
    rows = [(i, t) for i, t in enumerate(clean)]
    rows += [(200, clean[3]), (201, clean[3] + " the"), (202, "%&# " * 80), (203, f"{' '.join(word() for _ in range(60))} {item}"), (204, f'{clean[7]} token="{HEX}" {clean[8]}'), (205, None)]
    spark.createDataFrame([(i, t, "aa", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long"
                          ).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(120)] + [(203, 1, 0), (204, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root)


def test_each_stage_decides_on_its_own_input(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns, ids = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables)
        if name != "best_fit_packing":
            assert docs.columns == columns
            ids[name] = {r.doc_id for r in docs.collect()}
    kept = ids["quality_classifier"]
    assert not kept & {202, 205} and {203, 204, 200, 201} <= kept and len(kept & set(range(120))) >= 114
    assert ids["near_dedup"] == kept - {200, 201}
    assert ids["benchmark_decontamination"] == ids["near_dedup"] - {203}
    assert ids["secret_scans"] == ids["benchmark_decontamination"]
    assert {r.doc_id for r in docs.collect()} == ids["secret_scans"]


def test_run_redacts_and_packs(spark, tables):
    rows = corpus_pipeline.run(spark, tables).collect()
    assert rows and all(r.offset + r.length <= 4096 for r in rows)
    docs = spark.read.parquet(f"{tables}/documents.parquet").where("doc_id = 204")
    redacted = dict(corpus_pipeline.STAGES)["secret_scans"](spark, docs, tables).first()
    assert HEX not in redacted.text and redacted.n_chars == len(redacted.text)
