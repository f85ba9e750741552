"""The N best items of every group, however large a group is.

Each group is hashed into subgroups by item, so all mentions of one item meet in one
subgroup; there mentions are folded to the best score and the first N ranked; the survivors
of a group (at most N a subgroup) are ranked again by score and identifier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def list_items(df: DataFrame, group: str, ids: str, scores: str, prefixes: tuple[str, ...] = ("S2-", "S3-")) -> DataFrame:
    """Comma-joined cells with parallel score arrays -> rows (group, item, score).

    Blanks around ids are dropped; only ids with one of the prefixes and a non-NULL score stay.
    NULL or empty cells, a NULL or too short array and a NULL group give no rows.
    """
    pairs = F.arrays_zip(F.split(F.col(ids), ",", -1).alias("item"), F.col(scores).cast("array<double>").alias("score"))
    item = F.trim(F.col("p.item"))
    wanted = F.lit(False)
    for p in prefixes:
        wanted = wanted | item.startswith(p)
    return (
        df.filter(F.col(group).isNotNull() & F.col(ids).isNotNull())
        .select(F.col(group).alias("grp"), F.explode(pairs).alias("p"))
        .filter(F.col("p.score").isNotNull() & ~F.isnan("p.score") & wanted)
        .select("grp", item.alias("item"), F.col("p.score").alias("score"))
    )


def top_n(items: DataFrame, n: int, subgroups: int = 64) -> DataFrame:
    """``items(grp, item, score)`` -> (grp, item, rank_no): the first ``n`` different items of each group.

    A repeated item counts once with its highest score; equal scores are ordered by item
    ascending.  Groups with fewer items give fewer rows; an empty table gives none.
    """
    best = (
        items.withColumn("sub", F.pmod(F.xxhash64("item"), F.lit(subgroups)).cast("int"))
        .groupBy("grp", "sub", "item")
        .agg(F.max("score").alias("score"))
    )
    order = [F.col("score").desc(), F.col("item").asc()]
    first = best.withColumn("r", F.row_number().over(Window.partitionBy("grp", "sub").orderBy(*order))).filter(F.col("r") <= n)
    return (
        first.withColumn("rank_no", F.row_number().over(Window.partitionBy("grp").orderBy(*order)))
        .filter(F.col("rank_no") <= n)
        .select("grp", "item", "rank_no")
    )
