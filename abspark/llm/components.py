"""Connected components of an edge table by alternating star contraction.

Large-star links every larger neighbour of a node to the smallest one around
it, small-star links the smaller neighbours to each other's minimum; the two
alternate until no edge changes (a logarithmic number of rounds in practice).
Each half-round is one aggregation by node plus one join; nothing is gathered
per component, and the edge table is written between rounds so that a lost
executor recomputes one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abspark.llm.common import new_folder, staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (a, b), each once, a > b.  Returns edges of the same form."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    # The minimum around each node is a partial aggregate, so a hub is summed before the shuffle.
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    low = low.select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    out = both.join(low, both.u == low.k).select("u", "v", "m")
    if large:
        out = out.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = out.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(
            low.select(F.col("k").alias("a"), F.col("m").alias("b"))
        )
    return out.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node of its component.

    Self loops and nulls are ignored; an empty edge table gives an empty result.
    """
    folder = new_folder(edges.sparkSession, "components")
    cur = staged(
        edges.filter("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "0", folder,
    )
    total = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before = total(cur)
    for i in range(1, max_rounds + 1):
        if not before[0]:
            break
        cur = staged(_star(_star(cur, True), False), str(i), folder)
        now = total(cur)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = cur.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
