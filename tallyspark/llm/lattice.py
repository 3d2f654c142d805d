"""Embedding near-duplicates by E8 lattice hashing.

Unit vectors are projected to a few random directions and decoded to the nearest points
of the lattice E8, in several tables. A vector is stored in the cell of its own point and
probes the cells of the points next nearest to its projection. Stored and probing vectors
of a cell are compared by cosine in double precision.

Equal vectors are one vector with a weight from the start. No pairs are emitted: a cell
gives, for each vector, the weight of its links and one edge towards its group. A pair that
meets in several cells counts in the first only, which both vectors' codes tell. A crowded
cell is dealt out as pairs of slices, so that every task holds two slices at most.
"""

import functools
import itertools
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.components import connected_components
from tallyspark.session import stored

# Vectors of a cell that one task compares with each other; a larger cell is cut into slices of this size.
SLICE = 2000
# Lengths of at most so many vectors have one cell for all of them, so that they are compared exactly.
ONE_CELL = 64
# Rows of smaller cells that one group gathers; the number of groups grows with the table.
GATHERED = 20_000


@dataclass(frozen=True)
class Lattice:
    """``blocks`` lattice points side by side make a code; ``probes`` neighbouring cells are searched per table."""

    dimension: int
    blocks: int
    tables: int
    probes: int = 3
    scale: float = 4.0
    seed: int = 1

    @classmethod
    def for_size(cls, count, dimension):
        """More blocks for more vectors, so that cells stay small, and more tables to keep the recall.

        A block tells some 65 cells of unrelated vectors apart (240 at the scale of a single one),
        and a table finds a pair at a cosine of 0.95 with a chance of about 0.75 per block (0.9) if three
        cells are probed for each; tables are added until 0.98 of such pairs are found.
        """
        blocks = max(1, int(np.ceil(np.log(max(count, 1) / 1000) / np.log(65))))
        chance = 0.9 if blocks == 1 else 0.75**blocks
        tables = max(3, int(np.ceil(np.log(0.02) / np.log(1 - chance))))
        return cls(dimension, blocks, tables, probes=3 * blocks, scale=4.0 if blocks == 1 else 3.4)


def roots():
    """The 240 shortest vectors of E8."""
    whole = [
        [s if k == i else t if k == j else 0 for k in range(8)]
        for i, j in itertools.combinations(range(8), 2) for s in (1, -1) for t in (1, -1)
    ]
    half = [[0.5 * s for s in signs] for signs in itertools.product((1, -1), repeat=8) if np.prod(signs) > 0]
    return np.array(whole + half)


def _nearest_d8(x):
    """The nearest points with whole coordinates of even sum."""
    near = np.rint(x)
    gap = x - near
    odd = near.sum(axis=-1) % 2 != 0
    worst = np.abs(gap).argmax(axis=-1)[..., None]
    step = np.where(np.take_along_axis(gap, worst, -1) >= 0, 1.0, -1.0)
    moved = near.copy()
    np.put_along_axis(moved, worst, np.take_along_axis(near, worst, -1) + step, -1)
    return np.where(odd[..., None], moved, near)


def nearest_e8(x):
    """The nearest point of E8 to each row of 8 numbers: of whole or of half coordinates."""
    whole = _nearest_d8(x)
    half = _nearest_d8(x - 0.5) + 0.5
    closer = ((x - half) ** 2).sum(-1) < ((x - whole) ** 2).sum(-1)
    return np.where(closer[..., None], half, whole)


@functools.lru_cache(maxsize=4)
def _projections(lattice):
    """One matrix per table, with orthonormal columns where the dimension allows, and the hash factors of the codes."""
    random = np.random.default_rng(lattice.seed)
    width, made = 8 * lattice.blocks, []
    for _ in range(lattice.tables):
        columns = [np.linalg.qr(random.standard_normal((max(lattice.dimension, 8), 8)))[0][: lattice.dimension] for _ in range(lattice.blocks)]
        made.append(np.concatenate(columns, axis=1) * lattice.scale * np.sqrt(lattice.dimension / 64))
    factors = random.integers(1, 1 << 63, size=(lattice.tables, width), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return made, factors, roots()


def codes(unit, lattice):
    """Cells of unit vectors: own (rows x tables) and probed (rows x tables x probes), as 64-bit hashes of the points."""
    matrices, factors, short = _projections(lattice)
    n = len(unit)
    own = np.empty((n, lattice.tables), dtype=np.uint64)
    probed = np.empty((n, lattice.tables, lattice.probes), dtype=np.uint64)
    for t, matrix in enumerate(matrices):
        x = (unit @ matrix).reshape(n, lattice.blocks, 8)
        point = nearest_e8(x)
        doubled = (2 * point).astype(np.int64).view(np.uint64).reshape(n, -1)
        own[:, t] = _mixed((doubled * factors[t]).sum(axis=1, dtype=np.uint64), t)
        gain = ((x - point) @ short.T).reshape(n, -1)
        best = np.argsort(-gain, axis=1, kind="stable")[:, : lattice.probes]
        step = (2 * short).astype(np.int64).view(np.uint64)
        for k in range(lattice.probes):
            block, root = best[:, k] // len(short), best[:, k] % len(short)
            weights = factors[t].reshape(lattice.blocks, 8)[block]
            moved = (doubled * factors[t]).sum(axis=1, dtype=np.uint64) + (step[root] * weights).sum(axis=1, dtype=np.uint64)
            probed[:, t, k] = _mixed(moved, t)
    return own, probed


def cells_of(unit, length, count, lattice=None):
    """Own and probed cells of unit vectors of a length that ``count`` vectors have."""
    if lattice is None and count <= ONE_CELL:
        one = _mixed(np.full((len(unit), 1), length, dtype=np.uint64), 255)
        return one, np.empty((len(unit), 1, 0), dtype=np.uint64)
    return codes(unit, lattice or Lattice.for_size(count, length))


def _mixed(code, table):
    code = (code ^ (code >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(table)
    return code ^ (code >> np.uint64(29))


def unit_rows(raw, kind):
    """Unit vectors in double precision from packed ones; all are finite and none is zero."""
    x = np.frombuffer(b"".join(raw), dtype=kind).reshape(len(raw), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def compare(unit, own, probed, weight, stored_here, cell, side, threshold):
    """Links of the vectors of one cell: (weight of links that first meet here, group) per row.

    ``own`` and ``probed``: the codes of the rows. ``stored_here`` tells stored from probing rows; two
    probing rows do not meet. With ``side`` (a boolean per row) only rows of different sides are
    compared. ``group`` is the least row number that a row is connected to here.
    """
    n = len(unit)
    links, group = np.zeros(n, dtype=np.int64), np.arange(n)
    pairs_a, pairs_b = [], []
    for start in range(0, n, 256):
        block = slice(start, min(n, start + 256))
        close = unit[block] @ unit.T >= threshold
        close &= stored_here[block][:, None] | stored_here[None, :]
        if side is not None:
            close &= side[block][:, None] != side[None, :]
        a, b = np.nonzero(close)
        a += start
        keep = a < b
        a, b = a[keep], b[keep]
        if not len(a):
            continue
        first = first_meeting(own[a], probed[a], own[b], probed[b]) == cell
        np.add.at(links, a[first], weight[b[first]])
        np.add.at(links, b[first], weight[a[first]])
        pairs_a.append(a)
        pairs_b.append(b)
    if pairs_a:
        group = _groups(n, np.concatenate(pairs_a), np.concatenate(pairs_b))
    return links, group


def _groups(n, a, b):
    """The least row reachable from each row over the pairs."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def first_meeting(own_a, probed_a, own_b, probed_b):
    """The cell in which each pair meets first, in the order of tables: both stored there, or one of them probing."""
    n, tables, probes = probed_a.shape
    result, open_ = np.zeros(n, dtype=np.uint64), np.ones(n, dtype=bool)

    def settle(hit, cells):
        hit = hit & open_
        result[hit] = cells[hit]
        open_[hit] = False

    for t in range(tables):
        settle(own_a[:, t] == own_b[:, t], own_a[:, t])
        for k in range(probes):
            settle(probed_a[:, t, k] == own_b[:, t], own_b[:, t])
            settle(probed_b[:, t, k] == own_a[:, t], own_a[:, t])
    return result


def _prepared(vectors, ids, embedding):
    """Distinct usable vectors: (id: the least, mark: a hash, weight, raw: packed), and the type of the packed numbers."""
    kind = "<f4" if dict(vectors.dtypes)[embedding] == "array<float>" else "<f8"
    column = vectors[embedding] if kind == "<f4" else vectors[embedding].cast("array<double>")
    usable = (F.size(column) > 0) & F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(column, lambda x: x != 0)
    rows = vectors.select(
        vectors[ids].cast("bigint").alias("vec_id"), F.when(F.coalesce(usable, F.lit(False)) & vectors[ids].isNotNull(), column).alias("vector")
    )
    return rows, kind


def near_duplicates(vectors: DataFrame, ids="vec_id", embedding="embedding", threshold=0.95, lattice=None) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors``.

    A vector that is null, empty, zero or holds a null or a non-finite number, and a row with a null
    id, links with nothing: no links, its own id as component. Vectors of different lengths never
    link. Rows that repeat an id are vectors of their own with that id. Other columns do not
    matter; an empty table gives an empty table. ``lattice``: the tables to use, by default
    chosen from the number of vectors and their length.
    """
    rows, kind = _prepared(vectors, ids, embedding)
    rows = stored(rows.withColumn("mark", F.xxhash64("vector")).withColumn("length", F.size("vector")), "vectors")
    usable = rows.where("vector is not null")
    distinct = stored(
        usable.groupBy("length", "mark", "vector").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight")), "distinct"
    )
    # One row per length; the lattice of a length follows from its count.
    counts = distinct.groupBy("length").agg(F.count("*").alias("of_length"))
    sent = stored(_cells(distinct.join(counts, "length"), kind, lattice), "cells")
    used = sent.groupBy("cell").agg(F.count("*").alias("n"), F.count_if(~F.col("probing")).alias("own")).where("own > 0 and n > 1")
    groups = 1 + sent.count() // GATHERED
    slices = F.ceil(F.col("n") / SLICE).cast("int")
    dealt = (
        sent.join(used, "cell")
        .withColumn("slices", slices)
        .withColumn("slice", F.pmod(F.xxhash64("id", "mark"), F.col("slices")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        .withColumn("first", F.least("slice", "other"))
        .withColumn("second", F.greatest("slice", "other"))
        .withColumn("gathered", F.when(F.col("slices") == 1, F.pmod("cell", F.lit(groups))).otherwise(F.col("cell")))
        .select("gathered", "cell", "first", "second", "slice", "slices", "length", "of_length", "id", "mark", "weight", "probing", "raw")
    )

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        # A vector may be stored in a cell and probe it from another table: the stored row stands for it.
        rows = rows.sort_values(["cell", "id", "mark", "probing"]).drop_duplicates(["cell", "id", "mark"])
        length, count = int(rows["length"].iloc[0]), int(rows["of_length"].iloc[0])
        id_, mark, weight = (rows[c].to_numpy() for c in ("id", "mark", "weight"))
        cell, here, side = rows["cell"].to_numpy().view(np.uint64), ~rows["probing"].to_numpy(), (rows["slice"] == rows["first"]).to_numpy()
        two_sides = rows["first"].iloc[0] != rows["second"].iloc[0]
        unit = unit_rows(rows["raw"], kind)
        own, probed = cells_of(unit, length, count, lattice)
        out = []
        starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        for a, b in zip(starts, np.r_[starts[1:], len(rows)]):
            if b - a < 2:
                continue
            part = slice(a, b)
            links, group = compare(
                unit[part], own[part], probed[part], weight[part], here[part], cell[a], side[part] if two_sides else None, threshold
            )
            told = np.flatnonzero((links > 0) | (group != np.arange(b - a)))
            to = a + group[told]
            out.append(pd.DataFrame({"id": id_[a + told], "mark": mark[a + told], "links": links[told], "to_id": id_[to], "to_mark": mark[to]}))
        return pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype="int64") for c in ("id", "mark", "links", "to_id", "to_mark")})

    found = stored(
        dealt.groupBy("gathered", "length", "slices", "first", "second").applyInPandas(
            meet, "id bigint, mark bigint, links bigint, to_id bigint, to_mark bigint"
        ),
        "links",
    )
    counted = found.groupBy("id", "mark").agg(F.sum("links").alias("links"))
    edges = found.select(F.struct("id", "mark").alias("a"), F.struct(F.col("to_id").alias("id"), F.col("to_mark").alias("mark")).alias("b"))
    components = connected_components(edges).select(
        F.col("node.id").alias("id"), F.col("node.mark").alias("mark"), F.col("label.id").alias("component")
    )
    described = (
        distinct.join(counted, ["id", "mark"], "left").join(components, ["id", "mark"], "left")
        .select("vector", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    )
    linked = usable.join(described, "vector").select("vec_id", "n_links", "component_id")
    alone = rows.where("vector is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _cells(distinct, kind, lattice):
    """A row for each distinct vector and cell that it is stored in or probes."""

    def run(batches):
        for batch in batches:
            frame = batch.to_pandas()
            for (length, count), part in frame.groupby(["length", "of_length"]):
                for start in range(0, len(part), 2000):
                    chunk = part.iloc[start : start + 2000]
                    raw = [np.asarray(v, dtype=kind).tobytes() for v in chunk["vector"]]
                    own, probed = cells_of(unit_rows(raw, kind), int(length), int(count), lattice)
                    cells = np.concatenate([own, probed.reshape(len(raw), -1)], axis=1)
                    copies = cells.shape[1]
                    at = np.repeat(np.arange(len(raw)), copies)
                    yield pa.RecordBatch.from_pydict({
                        "cell": cells.ravel().view(np.int64),
                        "length": np.full(len(at), length, dtype=np.int32),
                        "of_length": np.full(len(at), count, dtype=np.int64),
                        "id": chunk["id"].to_numpy()[at],
                        "mark": chunk["mark"].to_numpy()[at],
                        "weight": chunk["weight"].to_numpy()[at],
                        "probing": np.tile(np.arange(copies) >= own.shape[1], len(raw)),
                        "raw": pa.array(raw, pa.binary()).take(pa.array(at)),
                    })

    return distinct.mapInArrow(run, "cell bigint, length int, of_length bigint, id bigint, mark bigint, weight bigint, probing boolean, raw binary")
