"""Near-duplicates of embeddings by random-hyperplane signs in several tables.

A vector's key in a table is on which side of ``bits`` random hyperplanes it lies. Vectors of equal label that share
a key of any table are compared by their exact cosine; linked vectors form components. Equal vectors are one node from
the start and counted as so many.

``bits`` follows the size of the largest label, so that unrelated vectors rarely share a key; the number of tables
follows ``bits``, so that a pair at exactly the limit shares no key with a chance of at most ``MISS`` (less above it).

No pairs are written. A bucket is compared in cells of at most two blocks of ``BLOCK`` members, each cell in one place;
out of it come a count for each member and the edges of a spanning forest. A pair that shares several keys is counted
under the first. A bucket of very many vectors that differ costs their number squared in multiplications, spread over
cells: the number of links of each must be known.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows without label or
vec_id, are linked with nothing. Vectors of different lengths are not linked. Rows that repeat a vec_id are
vectors of their own, and all count as others; the smallest vec_id of a component is that of its rows. Without vec_id,
component_id is null and the row is kept. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from loglens.llm.common import mix64, on_executors
from loglens.llm.neardup import components
from loglens.session import Staging, join_checked

SIMILAR = 0.98
# The chance that no table holds a pair at exactly the limit.
MISS = 1e-4
# Bits beyond the logarithm of the vectors of a label: one in so many powers of two of unrelated vectors shares a key.
SPARE_BITS = 6
# Members of a bucket that are compared with each other in one place.
BLOCK = 2048
STRIPE = 256
# Cosines so close to the limit are added up again exactly, so that all tables say the same of a pair.
CLOSE = 1e-9
SEED = 20_011

ROWS = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("unit", pa.binary()), ("high", pa.int64()), ("low", pa.int64())])


def shape(vectors: int, similar: float = SIMILAR, miss: float = MISS) -> tuple[int, int]:
    """Bits and tables for a label of so many vectors."""
    bits = min(60, SPARE_BITS + math.ceil(math.log2(max(vectors, 2))))
    together = (1 - math.acos(similar) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-together))


def units(lists: pa.Array) -> list[bytes | None]:
    """Each vector at length one, as bytes of doubles; None where it can't be linked."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.cast(lists.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    out: list[bytes | None] = [None] * len(sizes)
    full = np.flatnonzero(sizes)
    if len(full):
        n = sizes[full]
        starts = np.cumsum(n) - n
        with np.errstate(all="ignore"):
            peak = np.maximum.reduceat(np.abs(flat), starts)
            flat = flat / np.repeat(peak, n)                    # squares can't overflow then
            flat = flat / np.repeat(np.sqrt(np.add.reduceat(flat * flat, starts)), n) + 0.0
        for row, start, size in zip(full[ok := np.isfinite(peak) & (peak > 0)], starts[ok], n[ok]):
            out[row] = flat[start:start + size].tobytes()
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash
    for batch in batches:
        labels = batch["label"].to_pylist()
        unit = [u if label is not None else None for u, label in zip(units(batch["embedding"]), labels)]
        digests = [None if u is None else xxhash.xxh3_128_digest(b"%d:%b%b" % (len(u), u, label.encode())) for u, label in zip(unit, labels)]
        high, low = ([None if d is None else int.from_bytes(d[at:at + 8], "big", signed=True) for d in digests] for at in (0, 8))
        yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["label"], pa.array(unit, pa.binary()), pa.array(high, pa.int64()),
                                          pa.array(low, pa.int64())], schema=ROWS)


class Hyperplanes:
    """Keys of vectors: one row a vector, one column a table."""

    def __init__(self, bits: int, tables: int):
        self.bits, self.tables, self.planes = bits, tables, {}
        self.powers = np.uint64(1) << np.arange(bits, dtype=np.uint64)

    def keys(self, vectors: np.ndarray, label: str) -> np.ndarray:
        import xxhash
        size = vectors.shape[1]
        if size not in self.planes:
            self.planes[size] = np.random.default_rng([SEED, size]).standard_normal((size, self.tables * self.bits))
        sides = (vectors @ self.planes[size] > 0).reshape(len(vectors), self.tables, self.bits)
        codes = (sides * self.powers).sum(axis=2, dtype=np.uint64)
        tables = mix64(np.arange(self.tables, dtype=np.uint64) + np.uint64(xxhash.xxh3_64_intdigest(f"{size}:{label}")))
        return mix64(codes ^ tables).view(np.int64)


def _stacked(vectors) -> np.ndarray:
    return np.frombuffer(b"".join(vectors)).reshape(len(vectors), -1)


def _keys(batches: Iterator[pd.DataFrame], bits: int, tables: int) -> Iterator[pd.DataFrame]:
    planes = Hyperplanes(bits, tables)
    for batch in batches:
        for start in range(0, len(batch), STRIPE):
            part = batch.iloc[start:start + STRIPE]
            for (label, _), rows in part.groupby([part["label"], part["unit"].str.len()], sort=False):
                keys = planes.keys(_stacked(rows["unit"]), label)
                yield pd.DataFrame({"key": keys.ravel(), "node": np.repeat(rows["node"].to_numpy(), tables)})


def _similar_pairs(vectors: np.ndarray, own: np.ndarray, across: bool, similar: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of similar pairs, a stripe of rows at a time."""
    for start in range(0, len(vectors), STRIPE):
        cosines = vectors[start:start + STRIPE] @ vectors.T
        a, b = np.nonzero(cosines >= similar - CLOSE)
        keep = b > a + start
        if across:
            keep &= own[a + start] != own[b]
        a, b = a[keep], b[keep]
        sure = cosines[a, b] > similar + CLOSE
        for i in np.flatnonzero(~sure):
            sure[i] = math.fsum((vectors[a[i] + start] * vectors[b[i]]).tolist()) >= similar
        yield a[sure] + start, b[sure]


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The first place of each place's component."""
    roots = np.arange(n)
    while True:
        new = roots.copy()
        np.minimum.at(new, a, roots[b])
        np.minimum.at(new, b, roots[a])
        new = new[new]
        if (new == roots).all():
            return roots
        roots = new


def _compared(cell: pd.DataFrame, planes: Hyperplanes, similar: float) -> pd.DataFrame | None:
    cell = cell.sort_values("node")
    vectors, own = _stacked(cell["unit"]), cell["own"].to_numpy()
    key, label, across = cell["key"].iat[0], cell["label"].iat[0], cell["i"].iat[0] != cell["j"].iat[0]
    nodes, copies = cell["node"].to_numpy(), cell["copies"].to_numpy()
    links, firsts, keys = np.zeros(len(cell), np.int64), [], None
    for a, b in _similar_pairs(vectors, own, across, similar):
        if not len(a):
            continue
        if keys is None:
            keys = planes.keys(vectors, label)
            table = int(np.flatnonzero((keys == key).any(axis=0))[0])
            earlier = keys[:, :table]
        first = np.concatenate([~(earlier[x] == earlier[y]).any(axis=1) for x, y in
                                ((a[s:s + 65536], b[s:s + 65536]) for s in range(0, len(a), 65536))])
        a, b = a[first], b[first]
        links += np.bincount(a, copies[b], len(cell)).astype(np.int64) + np.bincount(b, copies[a], len(cell)).astype(np.int64)
        firsts.append((a, b))
    if not links.any():
        return None
    roots = _roots(len(cell), *map(np.concatenate, zip(*firsts)))
    linked = links > 0
    return pd.DataFrame({"node": nodes[linked], "links": links[linked], "root": nodes[roots[linked]]})


def _cells(batches: Iterator[pd.DataFrame], bits: int, tables: int, similar: float) -> Iterator[pd.DataFrame]:
    """Compare cells; rows arrive sorted by cell."""
    planes, waiting = Hyperplanes(bits, tables), None
    columns = ["key", "i", "j"]

    def compared(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        found = [x for _, cell in rows.groupby(columns, sort=False) if len(cell) > 1 and (x := _compared(cell, planes, similar)) is not None]
        if found:
            yield pd.concat(found)

    for batch in batches:
        if not len(batch):
            continue
        rows = batch if waiting is None else pd.concat([waiting, batch], ignore_index=True)
        last = (rows[columns] == rows[columns].iloc[-1]).all(axis=1).to_numpy()
        waiting = rows[last]
        yield from compared(rows[~last])
    if waiting is not None:
        yield from compared(waiting)


def near_vectors(vectors: DataFrame, similar: float = SIMILAR, miss: float = MISS, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept for each of ``vectors`` (vec_id, label, embedding)."""
    work, kept = Staging(vectors.sparkSession), Staging(vectors.sparkSession)
    given = on_executors(vectors).select(F.col("vec_id").cast("long"), F.col("label").cast("string"), F.col("embedding").cast("array<double>"))
    rows = work.table(given.mapInArrow(_rows, "vec_id long, label string, unit binary, high long, low long"), "rows")
    nodes = work.table(
        rows.where("unit is not null and vec_id is not null").groupBy("high", "low").agg(
            F.min("vec_id").alias("low_id"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("unit").alias("unit"))
        .withColumn("node", F.monotonically_increasing_id()), "nodes")
    largest = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = shape(largest, similar, miss)
    keys = nodes.select("node", "label", "unit").mapInPandas(lambda batches: _keys(batches, bits, tables), "key long, node long")
    shared = keys.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    blocks = F.ceil(F.col("members") / F.lit(block)).cast("int")
    members = (keys.join(shared, "key").withColumn("blocks", blocks)
               .withColumn("own", F.pmod(F.xxhash64("node", "key"), F.col("blocks")).cast("int"))
               .join(nodes.select("node", "label", "copies", "unit"), "node")
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
               .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")))
    cells = members.select("key", "i", "j", "own", "node", "copies", "label", "unit").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    partial = work.table(cells.mapInPandas(lambda batches: _cells(batches, bits, tables, similar), "node long, links long, root long"), "partial")
    found = components(partial.where("root < node").select(F.col("root").alias("a"), F.col("node").alias("b")), work, "components")
    linked = partial.groupBy("node").agg(F.sum("links").alias("links"))
    linked = linked.join(found.withColumnRenamed("id", "node"), "node", "left").withColumn("root", F.coalesce("component_id", "node")).drop("component_id")
    linked = work.table(linked.join(nodes.select("node", "low_id"), "node"), "linked")
    least = linked.groupBy("root").agg(F.min("low_id").alias("component_id"))
    linked = join_checked(linked, least, "root").select("node", "links", "component_id")
    groups = (nodes.select("node", "high", "low", "low_id", "copies").join(linked, "node", "left").where("copies > 1 or links is not null")
              .select("high", "low", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("others"),
                      F.coalesce("component_id", "low_id").alias("component_id")))
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    n_links = F.when(F.col("vec_id").isNotNull(), F.coalesce("others", F.lit(0))).otherwise(0).cast("long")
    result = rows.select("vec_id", "high", "low").join(groups, ["high", "low"], "left").select(
        "vec_id", n_links.alias("n_links"), component.alias("component_id"), (component.isNull() | (F.col("vec_id") == component)).alias("kept"))
    result = kept.table(result, "result")
    work.drop()
    return result
