"""Rings from ways: lines that share end points are joined into closed rings; what stays open is told apart."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assemble(lines: DataFrame, key: str = "area_id") -> DataFrame:
    """key, ring, seq, node, closed of each area's lines (key, way_id, seq, node): rings in the order of their least way.

    An area's lines fit into one task: its members are a bounded list.
    """

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        ways = {w: g.sort_values("seq").node.tolist() for w, g in pdf.groupby("way_id")}
        left, out, ring = dict(sorted(ways.items())), [], 0
        while left:
            first = next(iter(left))
            chain = left.pop(first)
            grown = True
            while chain[0] != chain[-1] and grown:
                grown = False
                for way, nodes in list(left.items()):
                    if nodes[0] == chain[-1]:
                        chain = chain + nodes[1:]
                    elif nodes[-1] == chain[-1]:
                        chain = chain + nodes[-2::-1]
                    elif nodes[-1] == chain[0]:
                        chain = nodes[:-1] + chain
                    elif nodes[0] == chain[0]:
                        chain = nodes[:0:-1] + chain
                    else:
                        continue
                    del left[way]
                    grown = True
                    break
            closed = chain[0] == chain[-1] and len(chain) >= 4
            out += [(pdf[key].iloc[0], ring, i, n, closed) for i, n in enumerate(chain)]
            ring += 1
        return pd.DataFrame(out, columns=[key, "ring", "seq", "node", "closed"])

    kind = dict(lines.dtypes)[key]
    return lines.groupBy(key).applyInPandas(join, f"{key} {kind}, ring long, seq long, node long, closed boolean")


def completeness(members: DataFrame, ways: DataFrame, key: str = "area_id") -> DataFrame:
    """key, members, missing, complete: whether every member way of an area is there."""
    rows = members.join(ways.select("way_id").distinct().withColumn("_on", F.lit(1)), "way_id", "left")
    return rows.groupBy(key).agg(F.count("*").alias("members"), F.count_if(F.col("_on").isNull()).alias("missing")).withColumn("complete", F.col("missing") == 0)
