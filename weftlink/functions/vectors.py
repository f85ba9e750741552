"""Dense vectors in array columns, and the hashing encoder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """0 where one side has no length."""
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(size > 0, dot(a, b) / size).otherwise(0.0)


def hashing_embedding(df: DataFrame, id_col: str, text_col: str, dim: int = 256, grams: tuple[int, int] = (3, 4)) -> DataFrame:
    """(id, dim_no, value): unit-length signed hashes of the character n-grams of ^text$, zero entries left out.

    A gram's CRC-32 gives its dimension (modulo ``dim``) and, by bit 20, its sign.
    """
    text = F.concat(F.lit("^"), F.coalesce(F.col(text_col), F.lit("")), F.lit("$"))
    low, high = grams
    each = df.select(F.col(id_col).alias("id"), text.alias("t")).select("id", "t", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("n"))
    pieces = each.filter("length(t) >= n").select("id", F.explode(F.expr("transform(sequence(1, length(t) - n + 1), i -> substring(t, i, n))")).alias("g"))
    h = F.crc32(F.encode("g", "utf-8"))
    summed = (
        pieces.select("id", F.pmod(h, F.lit(dim)).cast("int").alias("dim_no"), F.when(F.shiftright(h, 20).bitwiseAND(F.lit(1)) == 1, 1.0).otherwise(-1.0).alias("s"))
        .groupBy("id", "dim_no")
        .agg(F.sum("s").alias("s"))
        .filter("s <> 0")
    )
    length = summed.groupBy("id").agg(F.sqrt(F.sum(F.col("s") * F.col("s"))).alias("l"))
    return summed.join(length, "id").select("id", "dim_no", (F.col("s") / F.col("l")).alias("value"))
