"""Near-duplicate vectors by dual traversal of cover trees; exact pairs at a cosine threshold.

The upper levels of the tree are tables: a cell with too many vectors is split among centres drawn from it, each vector
going to the nearest, until cells are small (`dealt`); pairs of cells are followed from the root down, and those that
their centres and covering radii put out of reach are dropped (`met`). Each pair of small cells is one task, which
builds the lower levels and traverses both trees (`Traversal`).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farfield.llm.common import stored
from farfield.llm.components import components

COSINE = 0.93
#: Vectors in a cell that is not split further; a task compares two cells.
BLOCK_ROWS = 2000
#: Centres that a cell is split among, at most about.
FAN = 32
#: Rounds of splitting; what is larger then is cut by a hash of the row.
ROUNDS = 6
#: Vectors of a cell that one task deals to its centres, about.
CHUNK_ROWS = 5000
#: Room for rounding in distance bounds.
SLACK = 1e-6
#: Node pairs whose distances are taken at once.
AT_ONCE = 50_000
CELL = ["label", "d", "cell"]


def unit_rows(v: np.ndarray) -> np.ndarray:
    """The vectors at length 1; scaled by their largest component first, so that squares neither vanish nor overflow."""
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def reach_of(cosine: float) -> float:
    """The distance of unit vectors at that cosine."""
    return float(np.sqrt(max(0.0, 2 - 2 * cosine)))


class CoverTree:
    """Nested covers of unit vectors: the nodes of level k lie more than 2 / 2**k apart within their parent, and hold
    what is within that distance. A node is a run of rows (in the tree's order) that begins with its centre.

    begins, radii, firsts: by level, of each node its first row, covering radius and first child; each has one entry
    more. The last level has a node for each row. Nodes of less than an eighth of the reach aren't split but into rows.
    """

    def __init__(self, unit: np.ndarray, reach: float):
        self.order = np.arange(len(unit))
        self.begins, self.radii, self.firsts = [np.array([0, len(unit)])], [np.array([self._radius(unit, self.order)])], []
        scale = 2.0
        while scale > reach / 8:
            scale /= 2
            self._split(unit, scale)
        self.firsts.append(self.begins[-1])
        self.begins.append(np.arange(len(unit) + 1))
        self.radii.append(np.zeros(len(unit)))
        self.unit = unit[self.order]

    @staticmethod
    def _radius(unit: np.ndarray, rows: np.ndarray) -> float:
        return float(np.sqrt(np.maximum(0, ((unit[rows] - unit[rows[0]]) ** 2).sum(1).max())))

    def _split(self, unit: np.ndarray, scale: float) -> None:
        begins, radii, firsts = [], [], []
        for k, (s, e) in enumerate(zip(self.begins[-1].tolist(), self.begins[-1][1:].tolist(), strict=False)):
            firsts.append(len(begins))
            if self.radii[-1][k] <= scale:
                begins.append(s)
                radii.append(self.radii[-1][k])
                continue
            left, held, at = self.order[s:e], [], s
            while len(left):
                far = np.sqrt(np.maximum(0, ((unit[left] - unit[left[0]]) ** 2).sum(1)))
                near = far <= scale
                near[0] = True
                held.append(left[near])
                begins.append(at)
                radii.append(float(far[near].max()))
                at += len(held[-1])
                left = left[~near]
            self.order[s:e] = np.concatenate(held)
        self.begins.append(np.array([*begins, len(self.order)]))
        self.radii.append(np.array(radii))
        self.firsts.append(np.array([*firsts, len(begins)]))


def joined(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of each of n nodes, the least that edges (a, b) connect it with."""
    root = np.arange(n)
    while True:
        before = root
        root, low = root.copy(), np.minimum(root[a], root[b])
        np.minimum.at(root, before[a], low)
        np.minimum.at(root, before[b], low)
        while not np.array_equal(root, root[root]):
            root = root[root]
        if np.array_equal(root, before):
            return root


class Traversal:
    """Both trees level by level, node pair by node pair; within one tree if the other is None.

    A pair whose centres are further apart than both radii and the reach is dropped; one where they and both radii
    lie within the reach is linked as a whole, without looking at its rows. links: weight of the rows each row is
    linked with, left's rows first; roots: the least row that each hangs together with; looked: distances of centres that
    were taken, and compared: those of them between single rows.
    """

    def __init__(self, left: np.ndarray, left_weights: np.ndarray, right: np.ndarray | None = None, right_weights: np.ndarray | None = None, cosine: float = COSINE):
        self.reach, self.cosine = reach_of(cosine), cosine
        self.a = CoverTree(left, self.reach)
        self.same = right is None
        self.b = self.a if self.same else CoverTree(right, self.reach)
        self.weights = [left_weights[self.a.order], (left_weights if self.same else right_weights)[self.b.order]]
        self.sums = [np.concatenate([[0], np.cumsum(w)]) for w in self.weights]
        # of each row: weight it is linked with as part of a node (by differences), by itself, and whether it hangs on the row before
        self.steps = [np.zeros(len(w) + 1, dtype=np.int64) for w in self.weights]
        self.single = [np.zeros(len(w), dtype=np.int64) for w in self.weights]
        self.chain = [np.zeros(len(w) + 1, dtype=np.int64) for w in self.weights]
        self.own = np.zeros(len(left) + 1, dtype=np.int64)  # times a row is in a node linked with itself
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []
        self.looked = self.compared = 0
        zero = np.zeros(1, dtype=np.int64)
        todo = [(0, zero, zero)]
        while todo:
            level, i, j = todo.pop()
            todo += self.met(level, i, j)
        self.finish(len(left))

    def met(self, level: int, i: np.ndarray, j: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """Follows node pairs of a level to those of their children that are still open."""
        first_a, first_b = self.a.firsts[level], self.b.firsts[level]
        n, m = first_a[i + 1] - first_a[i], first_b[j + 1] - first_b[j]
        both = n * m
        if len(i) == 1:
            p, q = np.arange(first_a[i[0]], first_a[i[0] + 1]), np.arange(first_b[j[0]], first_b[j[0] + 1])
            step = max(1, 16 * AT_ONCE // max(1, len(q)))
            out = []
            for at in range(0, len(p), step):
                some = p[at : at + step]
                dots = self.a.unit[self.a.begins[level + 1][some]] @ self.b.unit[self.b.begins[level + 1][q]].T
                near = dots >= self.bound(self.a.radii[level + 1][some][:, None] + self.b.radii[level + 1][q][None, :])
                pairs = dots.size
                if self.same and i[0] == j[0]:
                    once = some[:, None] <= q[None, :]
                    near, pairs = near & once, int(once.sum())
                self.looked += pairs
                self.compared += pairs * (level + 2 == len(self.a.begins))
                x, y = np.nonzero(near)
                out += self.judged(level + 1, some[x], q[y], dots[x, y])
            return out
        large = np.flatnonzero(both > 4096)
        out = [(level, i[k : k + 1], j[k : k + 1]) for k in large.tolist()]
        small = np.flatnonzero(both <= 4096)
        ends = np.cumsum(both[small])
        cuts = np.searchsorted(ends, np.arange(AT_ONCE, (ends[-1] if len(ends) else 0) + AT_ONCE, AT_ONCE), side="left")
        for k in np.split(small, np.unique(np.minimum(cuts + 1, len(small)))):
            if not len(k):
                continue
            t = np.repeat(np.arange(len(k)), both[k])
            nth = np.arange(len(t)) - np.repeat(np.cumsum(both[k]) - both[k], both[k])
            p, q = first_a[i[k]][t] + nth // m[k][t], first_b[j[k]][t] + nth % m[k][t]
            if self.same:
                keep = (i[k] != j[k])[t] | (p <= q)
                p, q = p[keep], q[keep]
            dots = np.einsum("ij,ij->i", self.a.unit[self.a.begins[level + 1][p]], self.b.unit[self.b.begins[level + 1][q]])
            self.looked += len(dots)
            self.compared += len(dots) * (level + 2 == len(self.a.begins))
            near = dots >= self.bound(self.a.radii[level + 1][p] + self.b.radii[level + 1][q])
            out += self.judged(level + 1, p[near], q[near], dots[near])
        return out

    def bound(self, radii: np.ndarray) -> np.ndarray:
        """The least cosine of centres whose nodes, with these radii together, are within reach."""
        return 1 - np.minimum(2, self.reach + SLACK + radii) ** 2 / 2

    def judged(self, level: int, p: np.ndarray, q: np.ndarray, dots: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        if level + 1 == len(self.a.begins):
            keep = dots >= self.cosine
            if self.same:
                keep &= p != q
            p, q = p[keep], q[keep]
            np.add.at(self.single[0], p, self.weights[1][q])
            np.add.at(self.single[1], q, self.weights[0][p])
            self.edges.append((p, q))
            return []
        whole = np.sqrt(np.maximum(0, 2 - 2 * dots)) + self.a.radii[level][p] + self.b.radii[level][q] <= self.reach - SLACK
        self.linked(level, p[whole], q[whole])
        return [(level, p[~whole], q[~whole])] if not whole.all() else []

    def linked(self, level: int, p: np.ndarray, q: np.ndarray) -> None:
        """All rows of nodes p with all of q."""
        one, two = self.a.begins[level], self.b.begins[level]
        inner = (p == q) if self.same else np.zeros(len(p), dtype=bool)
        for k, x, bounds, y, others in ((0, p, one, q, two), (1, q, two, p, one)):
            # a node with itself: once is enough
            some = np.flatnonzero(~inner) if k else np.arange(len(p))
            weight = self.sums[1 - k][others[y[some] + 1]] - self.sums[1 - k][others[y[some]]]
            np.add.at(self.steps[k], bounds[x[some]], weight)
            np.add.at(self.steps[k], bounds[x[some] + 1], -weight)
            np.add.at(self.chain[k], bounds[x[some]] + 1, 1)
            np.add.at(self.chain[k], np.maximum(bounds[x[some] + 1], bounds[x[some]] + 1), -1)
        np.add.at(self.own, one[p[inner]], 1)
        np.add.at(self.own, one[p[inner] + 1], -1)
        self.edges.append((one[p], two[q]))

    def finish(self, n: int) -> None:
        counts = [np.cumsum(s[:-1]) + x for s, x in zip(self.steps, self.single, strict=True)]
        shift = 0 if self.same else n
        total = n if self.same else n + len(self.weights[1])
        if self.same:
            held = counts[0] + counts[1] - np.cumsum(self.own[:-1]) * self.weights[0]
            self.links = np.empty(n, dtype=np.int64)
            self.links[self.a.order] = held
        else:
            self.links = np.empty(total, dtype=np.int64)
            self.links[self.a.order], self.links[n + self.b.order] = counts
        ends = [(p, q + shift) for p, q in self.edges]
        for k, off in ((0, 0), (1, shift)):
            hang = np.flatnonzero(np.cumsum(self.chain[k][:-1]) > 0)
            ends.append((hang - 1 + off, hang + off))
        place = self.a.order if self.same else np.concatenate([self.a.order, n + self.b.order])
        one, two = (place[np.concatenate([e[k] for e in ends])] for k in (0, 1))
        self.roots = joined(total, one, two)


def linked_pairs(left: np.ndarray, right: np.ndarray | None = None, cosine: float = COSINE) -> Traversal:
    """The traversal of vectors that each count as one."""
    ones = lambda x: np.ones(len(x), dtype=np.int64)
    return Traversal(unit_rows(left), ones(left), None if right is None else unit_rows(right), None if right is None else ones(right), cosine)


def _usable(vector: Column) -> Column:
    """Not null, finite throughout, and not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    n = len(column)
    return np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]).reshape(n, -1) if n else np.empty((0, 1))


def _assigned(rows: pa.Table, centres: pa.Table) -> pa.Table:
    """Each row with its nearest centre, which names its new cell, and the distance; without centres it stays in its cell."""
    vectors = _matrix(rows.column("v"))
    if not centres.num_rows:
        cell, dist, centre = rows.column("cell"), np.full(len(vectors), 2.0), vectors
    else:
        order = np.argsort(centres.column("centre").to_numpy())
        heads = _matrix(centres.column("c"))[order]
        nearest = np.argmax(vectors @ heads.T, axis=1)
        names = [f"{rows.column('cell')[0].as_py()}.{k}" for k in range(len(order))]
        cell, centre = pa.array([names[k] for k in nearest.tolist()]), heads[nearest]
        dist = np.sqrt(((vectors - centre) ** 2).sum(1))
    of = lambda m: pa.FixedSizeListArray.from_arrays(pa.array(m.reshape(-1)), m.shape[1]).cast(pa.list_(pa.float64()))
    first = np.concatenate([[True], np.zeros(max(0, len(vectors) - 1), dtype=bool)])
    if centres.num_rows:  # one row of each cell in this chunk carries the centre
        first = np.zeros(len(vectors), dtype=bool)
        first[np.unique(nearest, return_index=True)[1]] = True
    carried = of(centre).filter(pa.array(first))
    at = np.where(first, np.cumsum(first) - 1, -1)
    return pa.table({
        "label": rows.column("label"), "d": rows.column("d"), "cell": cell, "parent": rows.column("cell"), "uid": rows.column("uid"), "copies": rows.column("copies"), "v": rows.column("v"),
        "dist": pa.array(dist), "centre": carried.take(pa.array(at, mask=at < 0)),
    })


def dealt(reps: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, list[DataFrame]]:
    """(reps with their cells, the balls of each round). reps: uid, label, d, v (of length 1), copies.

    A round splits the cells that hold more than block_rows vectors, by centres drawn by a hash of the uid: as many
    as cells of block_rows need, and a half more; FAN at most, about. Chunks of a cell are dealt each by one task. Balls:
    cell, parent (the cell itself if it wasn't split), r, c (null: no bound is known).
    """
    now, rounds = reps.withColumn("cell", F.lit("")), []
    last = now.select(*CELL).distinct().select(*CELL, F.lit(2.0).alias("r"), F.lit(None).cast("array<double>").alias("c"))
    for k in range(ROUNDS):
        sizes = stored(now.groupBy(*CELL).agg(F.count("*").alias("n")).where(F.col("n") > block_rows), "crowded")
        if not sizes.take(1):
            break
        part = F.greatest(F.lit(1), F.floor(F.col("n") / F.least(F.lit(FAN), F.ceil(1.5 * F.col("n") / block_rows))))
        rows = now.join(sizes, CELL).withColumn("chunks", F.ceil(F.col("n") / CHUNK_ROWS))
        centres = rows.where(F.pmod(F.xxhash64("uid", F.lit(k)), part) == 0)
        centres = stored(centres.select(*CELL, F.col("uid").alias("centre"), F.col("v").alias("c"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk")), "centres")
        rows = rows.withColumn("chunk", F.pmod(F.xxhash64("uid"), F.col("chunks"))).select(*CELL, "chunk", "uid", "copies", "v")
        new = rows.groupBy(*CELL, "chunk").cogroup(centres.groupBy(*CELL, "chunk"))
        schema = "label string, d int, cell string, parent string, uid long, copies long, v array<double>, dist double, centre array<double>"
        new = stored(new.applyInArrow(lambda x, y: _assigned(x, y) if x.num_rows else _nothing(), schema), "dealt")
        rest = now.join(sizes, CELL, "left_anti")
        balls = new.groupBy(*CELL, "parent").agg(F.max("dist").alias("r"), F.max("centre").alias("c"))
        same = last.join(sizes, CELL, "left_anti").withColumn("parent", F.col("cell"))
        rounds.append(stored(balls.unionByName(same), "balls"))
        last = rounds[-1].drop("parent")
        now = stored(new.select(*CELL, "uid", "copies", "v").unionByName(rest.select(*CELL, "uid", "copies", "v")), "cells")
    return now, rounds


def _nothing() -> pa.Table:
    kinds = [("label", pa.string()), ("d", pa.int32()), ("cell", pa.string()), ("parent", pa.string()), ("uid", pa.int64()), ("copies", pa.int64()), ("v", pa.list_(pa.float64())), ("dist", pa.float64()), ("centre", pa.list_(pa.float64()))]
    return pa.table({k: pa.array([], type=t) for k, t in kinds})


def met(cells: DataFrame, rounds: list[DataFrame], cosine: float = COSINE) -> DataFrame:
    """label, d, x, y: pairs of cells (one with itself, too) that may hold links, from the root down."""
    apart = lambda p, q: F.sqrt(F.aggregate(F.zip_with(p, q, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    pairs = cells.select("label", "d").distinct().withColumns({"x": F.lit(""), "y": F.lit("")})
    for balls in rounds:
        p = balls.select("label", "d", F.col("parent").alias("x"), F.col("cell").alias("p"), F.col("r").alias("p_r"), F.col("c").alias("p_c"))
        q = balls.select("label", "d", F.col("parent").alias("y"), F.col("cell").alias("q"), F.col("r").alias("q_r"), F.col("c").alias("q_c"))
        both = pairs.join(p, ["label", "d", "x"]).join(q, ["label", "d", "y"]).where((F.col("x") != F.col("y")) | (F.col("p") <= F.col("q")))
        near = F.coalesce(apart(F.col("p_c"), F.col("q_c")) <= F.col("p_r") + F.col("q_r") + reach_of(cosine) + SLACK, F.lit(True))
        pairs = stored(both.where((F.col("p") == F.col("q")) | near).select("label", "d", F.col("p").alias("x"), F.col("q").alias("y")), "pairs")
    return pairs


def link_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept.

    Vectors link when their labels are equal and not null and their cosine reaches the threshold; null, zero, and
    non-finite ones link with nothing, nor do rows without an id or vectors of different lengths. Equal vectors of a
    label (told by 128 bits of hashes) are folded into one with a count before anything is compared. Rows that share
    an id are a vector each, and count in each other's links if their vectors link. An empty table gives an empty
    result; other columns are ignored. A task of the traversal returns a row per vector, never its pairs. In data of
    high intrinsic dimension, where balls of any size below the whole hold hardly anything, all centres of a label
    are compared with all; groups of near vectors are still compared as one.
    """
    wide = F.transform(vector_col, lambda x: x.cast("double") + F.lit(0.0))  # -0.0 and 0.0 are one value
    own = vectors.select(F.col(id_col).cast("long").alias("id"), wide.alias("v"), F.col(label_col).cast("string").alias("label"))
    fine = F.col("label").isNotNull() & F.col("id").isNotNull() & _usable(F.col("v"))
    own = own.withColumn("fine", fine).withColumns({"h": F.when(F.col("fine"), F.xxhash64("v")), "g": F.when(F.col("fine"), F.xxhash64(F.lit(7), "v"))})
    folded = own.where("fine").groupBy("label", "h", "g").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first("v").alias("v"))
    # length 1, through the largest component, so that squares neither vanish nor overflow
    reps = stored(folded.withColumn("uid", F.monotonically_increasing_id()), "reps")
    reps_v = reps.withColumn("top", F.aggregate("v", F.lit(0.0), lambda s, y: F.greatest(s, F.abs(y)))).withColumn("v", F.transform("v", lambda x: x / F.col("top")))
    reps_v = reps_v.withColumn("length", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).withColumn("v", F.transform("v", lambda x: x / F.col("length")))
    cells, rounds = dealt(stored(reps_v.select("uid", "label", F.size("v").alias("d"), "v", "copies"), "units"), block_rows)
    pairs = met(cells, rounds, cosine)
    # what is still larger than a block is cut by a hash of the row
    held = cells.groupBy(*CELL).agg(F.ceil(F.count("*") / block_rows).alias("parts"))
    held = stored(held, "parts")
    many = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    one, two = (held.select("label", "d", F.col("cell").alias(c), F.col("parts").alias(f"{c}_parts")) for c in ("x", "y"))
    pairs = pairs.join(one, ["label", "d", "x"]).join(two, ["label", "d", "y"]).withColumn("i", many("x_parts")).withColumn("j", many("y_parts")).where("x <> y or i <= j")
    pairs = stored(pairs.select("label", "d", "x", "i", "y", "j"), "tasks")
    task = F.struct("label", "d", "x", "i", "y", "j").alias("task")
    alone = (F.col("x") == F.col("y")) & (F.col("i") == F.col("j"))
    sides = pairs.select(task, "label", "d", F.col("x").alias("cell"), F.col("i").alias("part"), F.lit(0).alias("side")).unionByName(
        pairs.where(~alone).select(task, "label", "d", F.col("y").alias("cell"), F.col("j").alias("part"), F.lit(1).alias("side"))
    )
    rows = cells.join(held, CELL).withColumn("part", F.pmod(F.xxhash64("uid", F.lit(1)), F.col("parts")))
    tasks = sides.join(rows, [*CELL, "part"]).select("task", "side", "uid", "copies", "v")

    def compare(group: pa.Table) -> pa.Table:
        group = group.sort_by([("side", "ascending"), ("uid", "ascending")])
        n = int(np.searchsorted(group.column("side").to_numpy(), 1))
        uid, copies, unit = group.column("uid").to_numpy(), group.column("copies").to_numpy(), _matrix(group.column("v"))
        if not n:
            return pa.table({k: pa.array([], type=pa.int64()) for k in ("uid", "n", "to")})
        found = Traversal(unit[:n], copies[:n], *([unit[n:], copies[n:]] if n < len(uid) else [None, None]), cosine)
        some = found.links > 0
        return pa.table({"uid": uid[some], "n": found.links[some], "to": uid[found.roots[some]]})

    found = stored(tasks.groupBy("task").applyInArrow(compare, "uid long, n long, to long"), "links")
    links = found.groupBy("uid").agg(F.sum("n").alias("n"))
    roots = components(found.select(F.col("uid").alias("a"), F.col("to").alias("b"))).withColumnRenamed("id", "uid")
    rows = reps.drop("v").join(links, "uid", "left").join(roots, "uid", "left").withColumn("component", F.coalesce("component", "uid"))
    rows = stored(rows, "classes")
    least = rows.groupBy("component").agg(F.min("id").alias("component_id"))
    rows = rows.join(least, "component").select("label", "h", "g", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id")
    lone = own.where("not fine").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = own.where("fine").select("id", "label", "h", "g").join(rows, ["label", "h", "g"]).select("id", "n_links", "component_id").unionByName(lone)
    return out.select(F.col("id").alias(id_col), F.col("n_links").cast("long").alias("n_links"), "component_id", F.coalesce(F.col("component_id") == F.col("id"), F.lit(True)).alias("kept"))
