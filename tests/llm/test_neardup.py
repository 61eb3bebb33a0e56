"""Near-duplicates against all pairs."""

import random
import re

import pytest
from loglens.llm import neardup

SCHEMA = "doc_id long, text string"


def brute_force(rows):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(words[i:i + 2]) for i in range(len(words) - 1)} or ({tuple(words)} if words else set()))
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                group[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return {doc_id: (len(sets[i]), least[root(i)]) for i, (doc_id, _) in enumerate(rows)}


def copies(seed, groups, size):
    """Groups of copies with more and more words changed, so that many pairs are near the limit."""
    draw = random.Random(seed)
    rows, word = [], lambda: f"w{draw.randrange(3000)}"
    for _ in range(groups):
        base = [word() for _ in range(draw.choice([1, 2, 3, 30, 120]))]
        for _ in range(draw.randrange(1, size)):
            text = [word() if draw.random() < draw.choice([0, 0.02, 0.05]) else w for w in base]
            rows.append(" ".join(text))
    draw.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("rounds", [0, 3])
def test_components_are_those_of_all_pairs(spark, monkeypatch, rounds):
    monkeypatch.setattr(neardup, "ROUNDS", rounds)
    rows = copies(rounds, 12, 40)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == brute_force(rows)


def test_defined_cases(spark):
    rows = [(5, "Alpha  Beta\tgamma"), (3, "alpha beta gamma"), (3, "alpha beta gamma"), (9, None), (8, ""), (7, " \t"), (2, "word"),
            (1, "WORD"), (None, "alpha beta gamma"), (10, "É é"), (11, "é é")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", component_id string")
    found = sorted((str(r.doc_id), r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(docs).collect())
    assert found == sorted([("5", 2, 3, False), ("3", 2, 3, True), ("3", 2, 3, True), ("9", 0, 9, True), ("8", 0, 8, True), ("7", 0, 7, True),
                            ("2", 1, 1, False), ("1", 1, 1, True), ("None", 2, None, True), ("10", 1, 10, True), ("11", 1, 11, True)])
    kept = neardup.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["3", "3", "9", "8", "7", "1", "None", "10", "11"])


def test_no_rows(spark):
    assert neardup.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_components_of_a_chain_and_a_star(spark):
    from loglens.session import Staging
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(50, 60), (55, 60), (54, 55)]
    found = neardup.components(spark.createDataFrame(links, "a long, b long"), Staging(spark), "c").collect()
    assert {r.id: r.component_id for r in found} == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)},
                                                     **{i: 50 for i in (54, 55, 60)}}


def test_components_grow_by_new_links(spark):
    from loglens.session import Staging
    draw, staging, found, links = random.Random(8), Staging(spark), None, []
    for step in range(3):
        new = [tuple(sorted(draw.sample(range(60), 2))) for _ in range(12)] + ([(0, 1)] if step else [])
        links += new
        found = neardup.grown(found, spark.createDataFrame(new, "a long, b long"), staging, f"c{step}")
        least = {i: i for i in range(60)}
        for _ in range(60):
            for x, y in links:
                least[x] = least[y] = min(least[x], least[y])
        assert sorted(tuple(r) for r in found.select("id", "component_id").collect()) == sorted((i, c) for i, c in least.items() if c != i)


def test_tables_of_rounds_are_deleted(spark, monkeypatch):
    """A disk holds what one round reads and writes, not all tables of all rounds."""
    import glob
    from loglens.session import Staging
    made, kept = [], Staging.table
    monkeypatch.setattr(Staging, "table", lambda self, df, name: made.append(self.path) or kept(self, df, name))
    draw = random.Random(5)
    base = [f"w{draw.randrange(3000)}" for _ in range(150)]
    rows = [(i, " ".join(f"x{draw.randrange(10**6)}" if draw.random() < 0.029 else w for w in base)) for i in range(60)]
    out = neardup.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out.collect()} == brute_force(rows)
    left = glob.glob(f"{made[0].removeprefix('file:')}/**/*.parquet", recursive=True)
    tables = {f.removeprefix(f"{made[0].removeprefix('file:')}/").rsplit("/", 1)[0].split("/")[0] for f in left}
    assert len(made) > 8 and "nodes" in tables and not tables & {"buckets", "members", "asked-1", "sets-1"}
    assert sum(t.startswith("round-") for t in tables) == 1


def test_members_of_a_large_group_meet_few_others(spark, monkeypatch):
    """Texts of which some pairs are just above the limit and most just below, so that rounds leave many out of their component."""
    draw = random.Random(5)
    base = [f"w{draw.randrange(3000)}" for _ in range(150)]
    rows = [(i, " ".join(f"x{draw.randrange(10**6)}" if draw.random() < 0.029 else w for w in base)) for i in range(240)]
    left, made = [], neardup._all_pairs

    def counted(*args):
        pairs = made(*args)
        left.append(pairs.count())
        return pairs

    monkeypatch.setattr(neardup, "_all_pairs", counted)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == brute_force(rows)
    assert sum(left) < 1500
