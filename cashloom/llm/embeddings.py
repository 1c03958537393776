"""Near-duplicate vectors by a forest of random-projection trees.

Each tree splits the vectors again and again at the median of their projection on a random
direction; a vector near the median goes to both sides. Vectors are compared within leaves of
all trees. The trees' directions and medians are fitted on a bounded sample; every vector is
then sent to its leaves and compared there. Exact copies are one vector with a count.

A group of near copies larger than a leaf would be cut inside at each further median, so such
groups are taken out first as cells. A cell has a centre found on the sample; the vectors that
link with the centre are its core. What links with a core vector lies within twice the
threshold's angle of the centre, so a cell compares its core in full with everything there, in
pairs of blocks, and loses nothing. Where vectors all lean to one side, most of them are that near
to any centre: a cell then takes a narrower core, which has to look less far, if that holds
nearly all of the group. Only vectors in no core go to the trees.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import spread_join
from ..sources.staging import shared_copy
from .components import connected_components
from .ngram import mix

SAMPLE = 131_072
"""Vectors that the trees are fitted on, about; every vector is indexed and compared."""

TREES = 8
LEAF = 512
"""Vectors of a leaf, as long as the sample has enough points to split by."""

SPILL = 0.05
"""Share of a node's vectors on either side of the median that go to both sides."""

LEAST_SAMPLED = 8
"""Sampled points in a leaf, at least."""

PROBED = 512
"""Sampled points of a node that are compared with each other to find a crowded place."""

SURROUNDED = 24
"""Vectors around a cell as a multiple of its core, at most; where more lie around, trees are used."""

CORES = (1.0, 0.8, 0.6)
"""A core's angle, in angles of the threshold; a smaller core has less around it."""

COVERED = 0.9
"""Share of the widest core that a smaller one has to hold."""

BLOCK_BYTES = 4 << 20
"""Vectors' bytes in a block of a cell."""


class Forest(NamedTuple):
    """For each tree and inner node a direction and the bounds of its spill zone; nodes in heap order."""

    directions: np.ndarray
    low: np.ndarray
    high: np.ndarray
    depth: int


class Cells(NamedTuple):
    """Centres, the cosines that bound each one's core and surroundings, and the blocks that each cell is cut into."""

    centres: np.ndarray
    core: np.ndarray
    around: np.ndarray
    blocks: np.ndarray


def _bounds(threshold: float, share: float) -> tuple[float, float]:
    """Cosines of a core of ``share`` of the threshold's angle, and of the angle of its links, lowered by what rounding may take."""
    angle = math.acos(threshold)
    beyond = (1 + share) * angle
    return (threshold if share == 1 else math.cos(share * angle)), (math.cos(beyond) - 1e-6 if beyond < math.pi else -2.0)


def find_cells(sample: np.ndarray, rows: int, threshold: float, *, leaf: int = LEAF, seed: int = 12) -> tuple[Cells, np.ndarray]:
    """Cells around groups of more than about half a leaf's vectors, and which sampled points lie in no core.

    Groups are looked for in the nodes of two trees of medians, large ones at their tops.
    """
    n, width = sample.shape
    single, draw = sample.astype(np.float32), np.random.default_rng(seed)
    free, untried = np.ones(n, bool), np.ones(n, bool)
    centres, sizes, bounds = [], [], []
    per_point = rows / max(n, 1)
    least = max(LEAST_SAMPLED / 2, leaf / 2 / per_point) if n else 1

    def crowded(part: np.ndarray) -> bool:
        """Makes the cell of the most crowded place of a node; False if there is none."""
        probe = part if len(part) <= PROBED else draw.choice(part, PROBED, replace=False)
        near = single[probe] @ single[probe].T >= threshold
        count = near.sum(axis=1) * untried[probe]
        best = int(count.argmax())
        if count[best] < LEAST_SAMPLED / 2 or count[best] * len(part) < least * len(probe):
            return False
        at = probe[near[best]]
        for _ in range(2):
            centre = sample[at].mean(axis=0)
            centre /= np.linalg.norm(centre)
            cosine = sample @ centre
            at = np.flatnonzero(free & (cosine >= threshold))
            if not len(at):
                break
        untried[probe[near[best]]] = False
        if len(at):
            widest, fitting = len(at), []
            for core, around in (_bounds(threshold, share) for share in CORES):
                held, size = np.count_nonzero(free & (cosine >= core)), np.count_nonzero(free & (cosine >= around))
                if held >= COVERED * widest and size <= SURROUNDED * held:
                    fitting.append((size / held, -core, core, around, size))
            if fitting:
                *_, core, around, size = min(fitting)
                centres.append(centre)
                sizes.append(size * per_point)
                bounds.append((core, around))
                free[cosine >= core] = False
        return True

    for _ in range(2):
        nodes = [np.flatnonzero(free)]
        while nodes:
            part = nodes.pop()
            part = part[free[part]]
            while len(part) >= least and crowded(part):
                part = part[free[part]]
            if len(part) >= 2 * least:
                half = len(part) // 2
                part = part[np.argpartition(single[part] @ draw.standard_normal(width).astype(np.float32), half)]
                nodes += [part[half:], part[:half]]
    blocks = np.ceil(np.array(sizes) / max(1024, BLOCK_BYTES // (8 * width))).astype(np.int64)
    core, around = np.array(bounds).reshape(-1, 2).T
    return Cells(np.array(centres).reshape(-1, width), core, around, blocks), free


def cells_of(unit: np.ndarray, rep: np.ndarray, cells: Cells) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Which vectors are in no core; and row numbers, codes, blocks and whether in the core, for each pair of blocks of each cell.

    A vector belongs to the core of the first cell that has it there, and meets that cell and,
    from outside, the cells before it; so each pair meets once.
    """
    if not len(cells.centres):
        none = np.empty(0, np.int64)
        return np.ones(len(unit), bool), none, none, none, none.astype(bool)
    cosine = unit @ cells.centres.T
    inside = cosine >= cells.core
    none = ~inside.any(axis=1)
    owner = np.where(none, len(cells.centres), inside.argmax(axis=1))
    row, cell = np.nonzero((cosine >= cells.around) & (np.arange(len(cells.centres)) <= owner[:, None]))
    blocks = cells.blocks[cell]
    block = (mix(rep[row].astype(np.uint64)) % blocks.astype(np.uint64)).astype(np.int64)
    other = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    row, cell, block, blocks = (np.repeat(x, blocks) for x in (row, cell, block, blocks))
    first = np.cumsum(cells.blocks**2) - cells.blocks**2
    # below zero, where no leaf's code is
    code = -1 - first[cell] - np.minimum(block, other) * blocks - np.maximum(block, other)
    return none, row, code, block, owner[row] == cell


def fit_forest(sample: np.ndarray, rows: int, *, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL, seed: int = 11) -> Forest:
    """Trees over unit vectors, deep enough for ``rows`` vectors as far as the sample allows."""
    wanted = math.ceil(math.log2(max(rows / leaf, 1)))
    depth = max(0, min(wanted, int(math.log2(max(len(sample) / LEAST_SAMPLED, 1)))))
    width, inner = sample.shape[1], 2**depth - 1
    draw = np.random.default_rng(seed)
    directions = draw.standard_normal((trees, inner, width)).astype(np.float32)
    low, high = np.zeros((trees, inner), np.float32), np.zeros((trees, inner), np.float32)
    for t in range(trees):
        order, bounds = np.arange(len(sample)), [(0, len(sample))]
        for node in range(inner):
            start, stop = bounds[node]
            part = order[start:stop]
            projected = sample[part] @ directions[t, node]
            if len(part):
                low[t, node], high[t, node] = np.quantile(projected, (0.5 - spill, 0.5 + spill))
            rank = np.argsort(projected, kind="stable")
            order[start:stop] = part[rank]
            middle = start + len(part) // 2
            bounds += [(start, middle), (middle, stop)]
    return Forest(directions, low, high, depth)


def leaves_of(unit: np.ndarray, forest: Forest) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and leaf codes (tree and leaf in one number) of all leaves of the given vectors."""
    rows, codes = [], []
    for t in range(len(forest.directions)):
        row, node = np.arange(len(unit)), np.zeros(len(unit), np.int64)
        for _ in range(forest.depth):
            projected = np.einsum("ij,ij->i", unit[row], forest.directions[t, node])
            left, right = projected <= forest.high[t, node], projected >= forest.low[t, node]
            row, node = np.concatenate([row[left], row[right]]), np.concatenate([2 * node[left] + 1, 2 * node[right] + 2])
        rows.append(row)
        codes.append(np.int64(t) << 32 | node)
    return np.concatenate(rows), np.concatenate(codes)


def _unit(values: np.ndarray) -> np.ndarray:
    # scaled first, so that squares of very large or small components stay finite
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def vector_classes(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """The rows (vec_id, vector; NULL for one that links with nothing) and the classes of equal vectors.

    A vector links with nothing if it or its id is NULL, if it is empty or zero, or if it has a
    NULL or non-finite component. Vectors of different lengths never link.
    """
    at = F.col(vector)
    usable = (
        F.col(key).isNotNull()
        & at.isNotNull()
        & F.forall(at, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists(at, lambda x: x != 0)
    )
    rows = vectors.select(F.col(key).alias("vec_id"), F.when(usable, F.transform(at, lambda x: x.cast("double") + F.lit(0.0))).alias("v"))
    classes = rows.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"))
    return rows, classes


def _compare(table: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one leaf or pair of blocks: the linked classes' ids, their links first found here, and the smallest id each reaches here.

    A pair that meets in several leaves is counted in the one with the smallest code. Of a cell's
    blocks, pairs count of which one is in the core, and of two blocks those from one to the other.
    """
    here = table.column("leaf")[0].as_py()
    ids, n = table.column("rep").to_numpy(), table.column("n").to_numpy()
    order = np.argsort(ids)
    table, ids, n = table.take(pa.array(order)), ids[order], n[order]
    unit = _unit(_matrix(table.column("v").combine_chunks()))
    codes = table.column("codes").combine_chunks()
    owner = np.repeat(np.arange(len(ids)), np.diff(codes.offsets.to_numpy()))
    earlier = codes.flatten().to_numpy()
    owner, earlier = owner[earlier < here], earlier[earlier < here]
    _, earlier = np.unique(earlier, return_inverse=True)
    side, core = table.column("block").to_numpy(), table.column("core").to_numpy(zero_copy_only=False)
    sides = [np.flatnonzero(side == k) for k in np.unique(side)]

    links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = k = root[root[k]]
        return k

    def found(of: np.ndarray) -> np.ndarray:
        at = root[of]
        while (root[at] != at).any():
            at = root[at]
        return at

    block = 1024
    for start in range(0, len(sides[0]), block):
        left = sides[0][start : start + block]
        for other in range(start if len(sides) == 1 else 0, len(sides[-1]), block):
            right = sides[-1][other : other + block]
            same = len(sides) == 1 and other == start
            close = unit[left] @ unit[right].T >= threshold
            if not core[left].all():
                close &= core[left, None] | core[right]
            if same:
                np.fill_diagonal(close, False)
            if not close.any():
                continue
            # leaves before this one that two vectors share
            fresh = close & ~_shared(owner, earlier, left, right) if len(earlier) else close
            links[left] += fresh @ n[right]
            if not same:
                links[right] += fresh.T @ n[left]
            apart = close & (found(left)[:, None] != found(right))
            for k in np.flatnonzero(apart.any(axis=1)).tolist():
                # the first of each tree of links is enough, and the smaller place is the smaller id
                partners = np.unique(root[right[apart[k]]])
                for p in partners.tolist():
                    x, y = find(left[k]), find(p)
                    root[max(x, y)] = min(x, y)
    ends = np.array([find(k) for k in range(len(ids))], np.int64)
    some = (links > 0) | (ends != np.arange(len(ids)))
    return ids[some], links[some], ids[ends[some]]


def _shared(owner: np.ndarray, code: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether the vectors of two blocks have a code in common."""
    if not len(code):
        return np.zeros((len(left), len(right)), bool)

    def member(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        inside = (owner >= block[0]) & (owner <= block[-1])
        return owner[inside] - block[0], code[inside]

    (lo, lc), (ro, rc) = member(left), member(right)
    common = np.intersect1d(lc, rc)
    counts = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, len(common), 2048):
        part = common[start : start + 2048]

        def table(of: np.ndarray, codes: np.ndarray, size: int) -> np.ndarray:
            at = np.clip(np.searchsorted(part, codes), 0, len(part) - 1)
            hit = part[at] == codes
            made = np.zeros((size, len(part)), np.float32)
            made[of[hit], at[hit]] = 1
            return made

        counts += table(lo, lc, len(left)) @ table(ro, rc, len(right)).T
    return counts > 0


def _links(classes: DataFrame, total: int, *, threshold: float, trees: int, leaf: int, spill: float, sample: int) -> DataFrame:
    """rep, links and root of the linked classes of vectors of one length; ``total``: the classes there are."""
    parts = max(1, -(-total // sample))
    sampled = classes.where(F.pmod(F.xxhash64("rep"), F.lit(parts)) == 0).select("v").toArrow()
    points = _matrix(sampled.column("v").combine_chunks()) if sampled.num_rows else np.zeros((0, 1))
    points = _unit(points) if len(points) else points
    cells, free = find_cells(points, total, threshold, leaf=leaf)
    outside = points[free].astype(np.float32)
    forest = fit_forest(outside, -(-total * len(outside) // max(len(points), 1)), trees=trees, leaf=leaf, spill=spill)
    step = max(64, min(2048, (1 << 22) // (len(cells.centres) + 1)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                unit = _unit(_matrix(batch.column("v")))
                none, *cell = cells_of(unit, batch.column("rep").to_numpy(), cells)
                none = np.flatnonzero(none)
                row, code = leaves_of(unit[none].astype(np.float32), forest)
                row = none[row]
                order = np.argsort(row, kind="stable")
                row, code = row[order], code[order]
                offsets = np.searchsorted(row, np.arange(batch.num_rows + 1))
                leaves = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(code))
                for at, where, block, core, codes in (
                    (row, code, np.zeros(len(row), np.int64), np.ones(len(row), bool), leaves.take(pa.array(row))),
                    (*cell, pa.array([[]] * len(cell[0]), pa.list_(pa.int64()))),
                ):
                    for k in range(0, len(at), 1 << 14):
                        part = slice(k, k + (1 << 14))
                        taken = batch.take(pa.array(at[part]))
                        columns = [where[part], taken.column("rep"), taken.column("n"), taken.column("v"), codes[part], block[part], core[part]]
                        yield pa.RecordBatch.from_arrays(
                            [x if isinstance(x, pa.Array) else pa.array(x) for x in columns], names=["leaf", "rep", "n", "v", "codes", "block", "core"]
                        )

    def compare(table: pa.Table) -> pa.Table:
        ids, links, roots = _compare(table, threshold)
        return pa.table({"rep": pa.array(ids, pa.int64()), "links": pa.array(links, pa.int64()), "root": pa.array(roots, pa.int64())})

    sent = classes.mapInArrow(assign, "leaf long, rep long, n long, v array<double>, codes array<long>, block long, core boolean")
    return sent.groupBy("leaf").applyInArrow(compare, "rep long, links long, root long")


def near_duplicates(
    vectors: DataFrame,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    threshold: float = 0.95,
    trees: int = TREES,
    leaf: int = LEAF,
    spill: float = SPILL,
    sample: int = SAMPLE,
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row; see :func:`vector_classes` for rows without links.

    Repeated rows are vectors of their own and link with each other. Every link reported is
    verified in double precision. Links of vectors in a cell's core are all found; what is
    found of others depends on the number of trees.
    """
    rows, found = vector_classes(vectors, key=key, vector=vector)
    rows, classes = shared_copy(rows), shared_copy(found)
    classes = classes.withColumn("rep", F.col("rep").cast("long"))
    # one row for each length; vectors of one model have one
    lengths = classes.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy("size").collect()
    parts = [
        _links(classes.where(F.size("v") == r.size), r.n, threshold=threshold, trees=trees, leaf=leaf, spill=spill, sample=sample) for r in lengths
    ]
    none = classes.sparkSession.createDataFrame([], "rep long, links long, root long")
    compared = shared_copy(reduce(DataFrame.unionByName, parts, none))
    nodes = connected_components(compared, "rep", "root").withColumnRenamed("node", "rep")
    counted = compared.groupBy("rep").agg(F.sum("links").alias("links"))
    classed = (
        classes.select("v", "rep", "n")
        .join(counted, "rep", "left")
        .join(nodes, "rep", "left")
        .where("n > 1 or component is not null")
        .select("v", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    known = spread_join(rows.where("v is not null"), classed, "v", "left").drop("v")
    alone = rows.where("v is null").select("vec_id", F.lit(None).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id"))
    return known.unionByName(alone).select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(False)).alias("kept"),
    )
