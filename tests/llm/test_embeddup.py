"""Near-duplicates of embeddings against all pairs."""

import math
import random

import pytest
from loglens.llm import embeddup

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows):
    import numpy as np
    good = lambda v: v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)
    vectors = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if good(v) and i is not None and label is not None else None
               for i, v, label in rows]
    group, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(vectors):
        for j in range(i):
            b = vectors[j]
            if a is not None and b is not None and len(a) == len(b) and rows[i][2] == rows[j][2] and float(a @ b) >= 0.98:
                links[i] += 1
                links[j] += 1
                group[root(i)] = root(j)
    least = {}
    for i, (vec_id, _, _) in enumerate(rows):
        if vec_id is not None:
            least[root(i)] = min(least.get(root(i), vec_id), vec_id)
    return sorted((str(vec_id), links[i], str(least.get(root(i)))) for i, (vec_id, _, _) in enumerate(rows))


def found(spark, rows, **more):
    given = spark.createDataFrame(rows, SCHEMA)
    out = embeddup.near_vectors(given, **more).collect()
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in out)
    return sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in out)


def clouds(seed, groups, size, dims=24):
    """Groups of vectors around a centre whose cosines lie on both sides of the limit, with exact copies."""
    draw, rows = random.Random(seed), []
    for _ in range(groups):
        centre, spread = [draw.gauss(0, 1) for _ in range(dims)], draw.choice([0.02, 0.1, 0.13, 0.16])
        for _ in range(draw.randrange(1, size)):
            vector = [round(x + draw.gauss(0, spread), 3) for x in centre]
            rows += [(vector, draw.randrange(2))] * draw.choice([1, 1, 1, 3])
    draw.shuffle(rows)
    return [(i, v, label) for i, (v, label) in enumerate(rows)]


@pytest.mark.parametrize("block", [2048, 7])
def test_links_are_those_of_all_pairs(spark, block):
    rows = clouds(block, 8, 40)
    assert found(spark, rows, miss=1e-9, block=block) == brute_force(rows)


def test_recall_at_the_default_number_of_tables(spark):
    rows = clouds(3, 30, 12)
    want = {r[0]: r[1] for r in brute_force(rows)}
    got = {r[0]: r[1] for r in found(spark, rows)}
    assert all(got[k] <= want[k] for k in want) and sum(got.values()) >= 0.99 * sum(want.values()) > 0


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(9, [1.0, 2.0], 1), (4, [2.0, 4.0], 1), (7, [1.0, 2.0], 2), (3, [1.0, 2.0], None), (1, None, 1), (2, [0.0, 0.0], 1), (5, [], 1),
            (6, [1.0, None], 1), (8, [nan, 2.0], 1), (10, [inf, 2.0], 1), (11, [1.0, 2.0, 0.0], 1), (12, [1e38, 2e38], 1), (13, [1e-40, 2e-40], 1),
            (None, [1.0, 2.0], 1), (14, [-1.0, -2.0], 1), (15, [-1.0, -2.0], 1), (15, [-1.0, -2.0], 1), (16, [-0.0, 1.0], 1), (17, [0.0, 1.0], 1)]
    assert found(spark, rows) == brute_force(rows)


def test_no_rows_and_clashing_columns(spark):
    assert found(spark, []) == []
    given = spark.createDataFrame([(1, [1.0, 0.5], 1, "x", 2), (2, [1.0, 0.5], 1, "y", 3)], SCHEMA + ", component_id string, node int")
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddup.near_vectors(given).orderBy("vec_id").collect()] == [
        (1, 1, 1, True), (2, 1, 1, False)]


def test_tables_follow_bits():
    for vectors in (1, 100, 10**6, 10**9):
        bits, tables = embeddup.shape(vectors)
        assert 2 ** bits >= 64 * vectors
        assert (1 - (1 - math.acos(0.98) / math.pi) ** bits) ** tables <= 1e-4
