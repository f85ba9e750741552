"""From scored pairs to matches: thresholds, rescue, rerank band, one owner a target, grouped lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftlink.functions.text import bigram_similarity


def routed(scored: DataFrame, warm: float, cold: float | None, seen: DataFrame) -> DataFrame:
    """Adds ``threshold`` by a pair's ``country_key``: countries that are not in ``seen(country_key)`` get the cold one."""
    if cold is None:
        return scored.withColumn("threshold", F.lit(warm))
    known = seen.select("country_key").distinct().withColumn("known", F.lit(True))
    return scored.join(known, "country_key", "left").withColumn("threshold", F.when(F.col("known"), F.lit(warm)).otherwise(F.lit(cold))).drop("known")


def above(scored: DataFrame, threshold: Column | float) -> DataFrame:
    return scored.filter(F.col("score") >= (threshold if isinstance(threshold, Column) else F.lit(threshold)))


def corroborated(scored: DataFrame, threshold: Column | float, delta: float, addr_cosine: float = 0.75) -> DataFrame:
    """Pairs above the threshold, and those at most ``delta`` below whose address speaks for them."""
    t = threshold if isinstance(threshold, Column) else F.lit(threshold)
    support = (F.col("postal_equal") == 1) | (F.col("addr_cos") >= addr_cosine)
    rescued = (F.col("score") >= t - delta) & support if delta > 0 else F.lit(False)
    return scored.filter((F.col("score") >= t) | rescued)


def blended(scored: DataFrame, threshold: Column | float, band: float, weight: float, second: Column | None = None) -> DataFrame:
    """Reranks the band around each pair's threshold: kept if (1 - w) score + w second >= threshold; sure pairs stay as they are.

    Without ``second`` the stand-in is the bigram overlap of ``a_text`` and ``b_text``.
    """
    threshold = threshold if isinstance(threshold, Column) else F.lit(threshold)
    sure = scored.filter(F.col("score") >= threshold + band)
    middle = scored.filter((F.col("score") >= threshold - band) & (F.col("score") < threshold + band))
    other = bigram_similarity(F.col("a_text"), F.col("b_text")) if second is None else second
    mixed = middle.withColumn("score", F.round((1 - weight) * F.col("score") + weight * other, 6)).filter(F.col("score") >= threshold)
    return sure.unionByName(mixed)


def one_owner(scored: DataFrame) -> DataFrame:
    """Keeps every target only for its best-scoring S1 record; ties go to the smaller S1 id."""
    best = Window.partitionBy("cand_id").orderBy(F.col("score").desc(), "s1_id")
    return scored.withColumn("r", F.row_number().over(best)).filter("r = 1").drop("r")


def grouped_lists(pairs: DataFrame, all_ids: DataFrame, by_score: bool = True) -> DataFrame:
    """(id, ids): one row for every id of ``all_ids(id)``; lists by score descending then id, or by source then id."""
    lead = -F.col("score") if by_score else F.col("cand_source").cast("double")
    lists = pairs.groupBy(F.col("s1_id").alias("id")).agg(F.sort_array(F.collect_set(F.struct(lead.alias("o"), F.col("cand_id").alias("c")))).alias("l"))
    none = F.array().cast("array<string>")
    return all_ids.select("id").distinct().join(lists, "id", "left").select("id", F.coalesce(F.array_distinct(F.transform("l", lambda x: x.c)), none).alias("ids"))
