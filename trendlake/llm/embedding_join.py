"""Exact cosine near-duplicates by a subspace pigeonhole join.

For unit vectors ``cos >= c`` means ``|x - y|^2 <= 2 - 2c``.  Vectors are rotated by
a fixed random rotation, so that distances spread evenly, and split into blocks of
few coordinates.  If the whole squared distance keeps the budget, at least one block
keeps its part of it (its share of the coordinates).  So every block is range-joined
by itself: along its first three coordinates vectors fall into cells as wide as twice the
block's radius, and a vector visits those neighbouring cells that its radius reaches and
that come after its own, so that two cells meet once.  Pairs within a block's budget are
verified exactly in double precision, each pair in the first block that finds it only.

Equal vectors of a label form a class and travel once to each place.  A cell too large for one
task is cut into chunks, and every pair of chunks is joined by a task of its own.
Pairs are never listed: tasks return link counts and a spanning forest of their links.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.llm.common import cut
from trendlake.llm.components import connected_components

BLOCKS = 8
#: Coordinates of a block that make its cells.
AXES = 3
#: Vectors of a label that share a chunk of a cell.
CHUNK = 16_384
SLACK = 1e-6  # for rounding in the rotated coordinates; the verification has none


def rotation(dim: int):
    """A fixed rotation of ``dim`` coordinates."""
    import numpy as np

    q, r = np.linalg.qr(np.random.default_rng(dim).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def block_budgets(dim: int, min_cosine: float):
    """Slices of the coordinates, and the squared distance each may use."""
    import numpy as np

    parts = np.array_split(np.arange(dim), min(BLOCKS, dim))
    return [(slice(p[0], p[-1] + 1), (2 - 2 * min_cosine) * len(p) / dim + SLACK) for p in parts]


def _unit(vectors):
    import numpy as np

    v = vectors.astype(np.float64)
    top = np.abs(v).max(axis=1, keepdims=True)  # no overflow or underflow in the norm
    v = v / top
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def cells(x, budget: float):
    """(row, code of the cell, whether at home there) for each row's own cell of width twice the
    radius, and for the neighbours within ``budget`` of squared distance that come after it."""
    import numpy as np

    width = 2 * math.sqrt(budget)
    own = np.floor(x / width).astype(np.int64)
    ahead = x / width - own >= 0.5
    side = np.where(ahead, 1, -1)
    gap = np.where(ahead, (own + 1) * width - x, x - own * width) ** 2
    rows, codes, home = [], [], []
    for move in itertools.product((0, 1), repeat=x.shape[1]):
        step = side * np.array(move)
        sign = np.zeros(len(x), np.int64)
        code = np.zeros(len(x), np.int64)
        for k in range(x.shape[1]):
            sign = np.where(sign == 0, step[:, k], sign)
            code = (code << 21) + (own[:, k] + step[:, k] + (1 << 20))  # the budget's slack keeps cells below 2^20
        near = np.flatnonzero((gap @ np.array(move, float) <= budget) & (sign >= 0) & ((sign > 0) | (not any(move))))
        rows.append(near)
        codes.append(code[near])
        home.append(np.full(len(near), not any(move)))
    return np.concatenate(rows), np.concatenate(codes), np.concatenate(home)


def join_cell(home, every, visits, vectors, blocks, number: int, min_cosine: float):
    """Index pairs (a, b) with cosine >= min_cosine whose first block within budget is
    ``number``: ``a`` at home, and ``b`` a visitor or at home and after ``a``."""
    import numpy as np

    unit = _unit(vectors)
    turned = unit @ rotation(vectors.shape[1])
    part, budget = blocks[number]
    x = turned[:, part]
    square = (x * x).sum(axis=1)
    for i in range(0, len(home), 512):
        rows = home[i : i + 512]
        near = square[rows][:, None] + square[every][None, :] - 2 * (x[rows] @ x[every].T) <= budget
        near &= visits[every][None, :] | (rows[:, None] < every[None, :])
        a, b = np.nonzero(near)
        for k in range(0, len(a), 100_000):
            p, q = rows[a[k : k + 100_000]], every[b[k : k + 100_000]]
            first = np.ones(len(p), bool)
            for other, limit in blocks[:number]:
                d = turned[p, other] - turned[q, other]
                first &= (d * d).sum(axis=1) > limit
            p, q = p[first], q[first]
            ok = np.einsum("ij,ij->i", unit[p], unit[q]) >= min_cosine
            yield p[ok], q[ok]


def embedding_components(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                         min_cosine: float = 0.93) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``vectors``.

    Vectors are compared only if their labels are equal and not null and their lengths
    are equal. Vectors that are null, empty, all zero or hold null or non-finite components
    link with nothing: no links, a component of their own. Repeated rows are vectors of
    their own, linked with each other. Null ids are passed over in a component's least
    id; a component of null ids has a null id and is not kept. Other columns are not read.
    An empty table gives an empty result.
    """
    if not 0 < min_cosine <= 1:
        raise ValueError("min_cosine must be in (0, 1]")
    # vectors of floats travel as such; all sums are in doubles
    stored = "float32" if isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType) else "float64"
    v = F.col("v")
    usable = v.isNotNull() & F.col("label").isNotNull() & (F.size(v) > 0) & F.exists(v, lambda x: x != 0) & ~F.exists(
        v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v")) \
        .withColumn("ok", F.coalesce(usable, F.lit(False)))
    keyed = rows.withColumn("cls", F.when(F.col("ok"), F.xxhash64(F.size("v"), "label", "v")))
    classes = cut(keyed.where("ok").groupBy("label", "v").agg(
        F.first("cls").alias("cls"), F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies")), "vector-classes")
    per_label = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    sized = classes.join(per_label, "label").select("cls", F.xxhash64("label").alias("label"), "copies",
                                                    F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"), "v")

    def spread(batches) -> Iterator:
        """Each vector's places: block, cell, whether at home there."""
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            cls, label, copies, chunks, lists = batch.columns
            length = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy()
            begin = np.r_[0, np.cumsum(length)]
            for dim in np.unique(length).tolist():
                at = np.flatnonzero(length == dim)
                own = np.stack([flat[begin[i] : begin[i] + dim] for i in at])
                turned = _unit(own) @ rotation(dim)
                raw = np.array([x.tobytes() for x in own.astype(stored)], object)
                for number, (part, budget) in enumerate(block_budgets(dim, min_cosine)):
                    rows, cell, home = cells(turned[:, part][:, :AXES], budget)
                    which, n = pa.array(at[rows]), len(rows)
                    yield pa.RecordBatch.from_arrays([
                        label.take(which), pa.array(np.full(n, dim)), pa.array(np.full(n, number)), pa.array(cell), pa.array(home),
                        cls.take(which), copies.take(which), chunks.take(which), pa.array(raw[rows], pa.binary())],
                        names=["label", "dim", "block", "cell", "home", "cls", "copies", "chunks", "raw"])

    def joined(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def links(tile, group):
            names, role, copies, vecs = (np.concatenate(x) for x in zip(*group))
            cls, at, where = np.unique(names, return_index=True, return_inverse=True)
            home, every = np.unique(where[role & 1 > 0]), np.unique(where[role & 6 > 0])
            if not len(home) or len(cls) < 2:
                return
            visits = np.zeros(len(cls), bool)
            visits[where[role == 4]] = True
            copies, vecs = copies[at], vecs[at]
            weight = np.zeros(len(cls), np.int64)
            root = np.arange(len(cls))

            def find(x):
                while root[x] != x:
                    x = root[x]
                return x

            for a, b in join_cell(home, every, visits, vecs, block_budgets(tile[1], min_cosine), tile[2], min_cosine):
                np.add.at(weight, a, copies[b])
                np.add.at(weight, b, copies[a])
                while (root[root] != root).any():
                    root = root[root]
                open_pairs = np.unique(np.column_stack([root[a], root[b]])[root[a] != root[b]], axis=0)
                for p, q in open_pairs.tolist():
                    p, q = find(p), find(q)
                    if p != q:
                        root[max(p, q)] = min(p, q)
            top = np.array([find(i) for i in range(len(cls))])
            some = weight > 0
            if some.any():
                yield pa.RecordBatch.from_arrays([pa.array(cls[some]), pa.array(cls[top[some]]), pa.array(weight[some])], names=["a", "b", "links"])

        tile, group = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.column_stack([c.to_numpy() for c in batch.columns[:6]])
            cls, role, copies = (c.to_numpy() for c in batch.columns[6:9])
            _, offsets, data = batch.column(9).buffers()
            begin = np.frombuffer(offsets, np.int32)[batch.column(9).offset :]
            bounds = np.r_[0, np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, len(keys)].tolist()
            for a, b in zip(bounds[:-1], bounds[1:]):
                if tuple(keys[a].tolist()) != tile:
                    if group:
                        yield from links(tile, group)
                    tile, group = tuple(keys[a].tolist()), []
                size = int(begin[b] - begin[a]) // np.dtype(stored).itemsize
                vecs = np.frombuffer(data, stored, size, int(begin[a])).reshape(b - a, -1)
                group.append(tuple(x.copy() for x in (cls[a:b], role[a:b], copies[a:b], vecs)))
        if group:
            yield from links(tile, group)

    placed = sized.select("cls", "label", "copies", "chunks", "v").mapInArrow(
        spread, "label long, dim long, block long, cell long, home boolean, cls long, copies long, chunks int, raw binary")
    chunk = F.pmod(F.xxhash64("cls"), "chunks").cast("int")
    others = F.sequence(F.lit(0), F.col("chunks") - 1)
    # bits of a role: 1 row of the tile, at home; 2 column, at home; 4 column, a visitor
    column = F.when(F.col("home"), 2).otherwise(4)
    many = F.concat(
        F.transform(others, lambda o: F.struct(o.alias("i"), F.col("chunk").alias("j"), column.alias("role"))),
        F.when(F.col("home"), F.transform(others, lambda o: F.struct(F.col("chunk").alias("i"), o.alias("j"), F.lit(1).alias("role"))))
        .otherwise(F.array().cast("array<struct<i:int,j:int,role:int>>")))
    one = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.when(F.col("home"), 3).otherwise(4).alias("role")))
    roles = F.when(F.col("chunks") == 1, one).otherwise(many)
    tile = ["label", "dim", "block", "cell", "i", "j"]
    tiles = placed.withColumn("chunk", chunk).withColumn("t", F.explode(roles)).select(
        "label", "dim", "block", "cell", "t.i", "t.j", "cls", "t.role", "copies", "raw")
    found = cut(tiles.repartition(*tile).sortWithinPartitions(*tile).mapInArrow(joined, "a long, b long, links long"), "vector-links")

    group = connected_components(found.select("a", "b")).withColumnRenamed("node", "cls")
    links = found.groupBy(F.col("a").alias("cls")).agg(F.sum("links").alias("links"))
    full = classes.select("cls", "least", "copies").join(group, "cls", "left").join(links, "cls", "left") \
        .withColumn("component", F.coalesce("component", "cls"))
    least = full.groupBy("component").agg(F.min("least").alias("component_id"))
    named = cut(full.join(least, "component").select(
        "cls", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "vector-components")
    out = keyed.select("vec_id", "cls").join(named, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
