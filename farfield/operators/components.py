"""Connected components of cells under 8-neighbourhood: blocks are labelled locally, borders are joined."""

from __future__ import annotations

import tempfile

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 64
ROUNDS = 64


def least_joined(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of each of n nodes, the least that edges (a, b) connect it with."""
    root = np.arange(n)
    while True:
        before, root = root, root.copy()
        low = np.minimum(before[a], before[b])
        np.minimum.at(root, before[a], low)
        np.minimum.at(root, before[b], low)
        while not np.array_equal(root, root[root]):
            root = root[root]
        if np.array_equal(root, before):
            return root


def _label(pdf: pd.DataFrame) -> pd.DataFrame:
    """Least key of each cell's component within a block, by the four neighbours that come later."""
    pdf = pdf.drop_duplicates().sort_values(["g", "row", "col"]).reset_index(drop=True)
    row, col = pdf.row.to_numpy(dtype=np.int64), pdf.col.to_numpy(dtype=np.int64)
    row, col = row - row.min() + 1, col - col.min() + 1
    wide, high = col.max() + 2, row.max() + 2
    key = (pd.factorize(pdf.g)[0] * high + row) * wide + col
    ends = []
    for step in (1, wide - 1, wide, wide + 1):
        at = np.minimum(np.searchsorted(key, key + step), len(key) - 1)
        near = np.flatnonzero(key[at] == key + step)
        ends.append((near, at[near]))
    first = least_joined(len(key), *(np.concatenate([e[k] for e in ends]) for k in (0, 1)))
    return pdf.assign(lr=pdf.row.to_numpy()[first], lc=pdf.col.to_numpy()[first])


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage in the folder that the session names. Within one process (tests) a temporary one will do; on a
    cluster executors couldn't see it, so the setting is needed."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and sc.master.partition("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="farfield-"))
    return df.checkpoint()


def label_components(cells: DataFrame, group: str | None = None, block: int = BLOCK, width: int = 1 << 20) -> DataFrame:
    """row, col (and group), label: the least row * width + col of the cell's component; components of different
    groups are apart. Cells without duplicates."""
    own = cells.select(F.col(group).cast("string").alias("g") if group else F.lit("").alias("g"), "row", "col")
    keyed = own.withColumn("_br", F.floor(F.col("row") / block)).withColumn("_bc", F.floor(F.col("col") / block))
    local = keyed.groupBy("g", "_br", "_bc").applyInPandas(lambda pdf: _label(pdf[["g", "row", "col"]]), "g string, row long, col long, lr long, lc long")
    local = checkpointed(local.withColumn("label", F.col("lr") * width + F.col("lc")).drop("lr", "lc"))
    # only cells on a block's border have neighbours in another
    edge = local.where(f"row % {block} in (0, {block - 1}) or col % {block} in (0, {block - 1})")
    near = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1) if a or b]))
    moved = edge.withColumn("_n", near).select("g", (F.col("row") + F.col("_n.a")).alias("row"), (F.col("col") + F.col("_n.b")).alias("col"), F.col("label").alias("other"))
    links = moved.join(edge, ["g", "row", "col"]).where("label <> other").select("g", "label", "other").distinct()
    links = checkpointed(links)
    roots = links.select("g", "label", F.col("label").alias("root")).distinct()
    for _ in range(ROUNDS):
        low = links.join(roots.select("g", F.col("label").alias("other"), F.col("root").alias("r")), ["g", "other"]).groupBy("g", "label").agg(F.min("r").alias("r"))
        stepped = roots.join(low, ["g", "label"], "left").select("g", "label", "root", F.least("root", F.coalesce("r", "root")).alias("new"))
        # jump: the root of one's root
        jump = stepped.select("g", F.col("label").alias("new"), F.col("new").alias("next"))
        stepped = checkpointed(stepped.join(jump, ["g", "new"], "left").select("g", "label", "root", F.least("new", F.coalesce("next", "new")).alias("new")))
        changed = stepped.where("root <> new").take(1)
        roots = stepped.select("g", "label", F.col("new").alias("root"))
        if not changed:
            break
    else:
        raise RuntimeError("components did not settle")
    out = local.join(roots, ["g", "label"], "left").select("g", "row", "col", F.coalesce("root", "label").alias("label"))
    return out.withColumnRenamed("g", group) if group else out.drop("g")


def dead_cells(members: DataFrame, keys: list[str], wide: bool, window: tuple[int, int, int, int] | None = None) -> DataFrame:
    """Cells of a component that can hold no new place: all but the window's outermost ring where the threshold is
    some cells wide, else those whose eight neighbours are members too."""
    if wide:
        r0, r1, c0, c1 = window
        return members.where((F.col("row") > r0) & (F.col("row") < r1) & (F.col("col") > c0) & (F.col("col") < c1))
    offsets = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)]))
    votes = members.withColumn("_n", offsets).select(*keys, (F.col("row") + F.col("_n.a")).alias("row"), (F.col("col") + F.col("_n.b")).alias("col"))
    return votes.groupBy(*keys, "row", "col").agg(F.count("*").alias("_k")).where("_k = 9").drop("_k")
