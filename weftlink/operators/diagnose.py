"""What exact keys say about the labels: match structure, rule quality, reach, and what is left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftlink.functions import text as X


def match_structure(truth: DataFrame) -> DataFrame:
    """One row over ``truth(source1_entity_id, matched)``: how many matches records have, and where."""
    n = F.size("matched")
    third = F.size(F.filter("matched", lambda x: x.startswith("S3")))
    return truth.agg(
        F.count(F.lit(1)).alias("n_ids"),
        F.sum((n == 0).cast("long")).alias("singletons"),
        F.sum((n > 0).cast("long")).alias("matched_ids"),
        F.round(F.avg(F.when(n > 0, n)), 6).alias("mean_matches"),
        F.max(n).cast("long").alias("max_matches"),
        F.sum((n == 1).cast("long")).alias("one"),
        F.sum((n == 2).cast("long")).alias("two"),
        F.sum((n >= 3).cast("long")).alias("three_up"),
        F.sum(n - third).cast("long").alias("s2_matches"),
        F.sum(third).cast("long").alias("s3_matches"),
    )


def exact_keys(raw: DataFrame, normal: DataFrame) -> DataFrame:
    """(entity_id, source, key_name, value): the values of every exact key of every record."""
    blob = F.lower(F.concat_ws(" ", F.coalesce("business_name", F.lit("")), F.coalesce("business_address", F.lit(""))))
    sets = X.contact_keys(blob)
    joined = normal.join(raw.select("entity_id", blob.alias("blob")), "entity_id").select("*", *[v.alias(k) for k, v in X.contact_keys(F.col("blob")).items()])
    both = F.when((F.col("core_name") != "") & (F.col("postal") != ""), F.concat_ws("|", "core_name", "postal")).otherwise("")
    single = {"exact_name": F.col("core_name"), "squished_name": F.col("name_squish"), "exact_address": F.col("norm_addr"), "postal": F.col("postal"), "name_postal": both}

    def named(key: str, values: Column) -> Column:
        return F.transform(values, lambda x: F.struct(F.lit(key).alias("key_name"), x.alias("value")))

    keys = F.concat(*[named(k, F.array(v)) for k, v in single.items()], *[named(k, F.col(k)) for k in sets])
    return joined.select("entity_id", "source", F.explode(keys).alias("k")).select("entity_id", "source", "k.*").filter("value <> ''")


def key_pairs(keys: DataFrame, cap: int = 40) -> DataFrame:
    """(key_name, s1_id, cand_id, value): pairs that share a value which at most ``cap`` records have on either side."""
    side = F.when(F.col("source") == 1, "a").otherwise("b")
    counts = keys.withColumn("side", side).groupBy("key_name", "value", "side").count()
    rare = counts.groupBy("key_name", "value").agg(F.max("count").alias("m"), F.count(F.lit(1)).alias("sides")).filter((F.col("m") <= cap) & (F.col("sides") == 2))
    kept = keys.join(rare.select("key_name", "value"), ["key_name", "value"], "left_semi")
    a = kept.filter("source = 1").select("key_name", "value", F.col("entity_id").alias("s1_id"))
    b = kept.filter("source > 1").select("key_name", "value", F.col("entity_id").alias("cand_id"))
    return a.join(b, ["key_name", "value"])


def key_quality(pairs: DataFrame, truth: DataFrame, judged: DataFrame) -> DataFrame:
    """(key_name, n_rows, n_true_rows, precision, n_true_pairs, recall) over pairs of the labelled S1 ids.

    Precision counts joined rows, a pair once for each value it shares; recall counts pairs.
    """
    known = pairs.join(judged.select("s1_id").distinct(), "s1_id", "left_semi")
    hit = truth.select("s1_id", "cand_id").distinct().withColumn("t", F.lit(1))
    total = truth.select("s1_id", "cand_id").distinct().agg(F.count(F.lit(1)).alias("total"))
    rows = known.join(hit, ["s1_id", "cand_id"], "left")
    per = rows.groupBy("key_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("t").alias("n_true_rows"), F.countDistinct(F.when(F.col("t") == 1, F.struct("s1_id", "cand_id"))).alias("n_true_pairs")
    )
    return per.crossJoin(F.broadcast(total)).select(
        "key_name", "n_rows", "n_true_rows", F.round(F.col("n_true_rows") / F.col("n_rows"), 6).alias("precision"), "n_true_pairs",
        F.round(F.col("n_true_pairs") / F.col("total"), 6).alias("recall"),
    )


def deterministic_reach(pairs: DataFrame, truth: DataFrame, quality: DataFrame, least: float = 0.9) -> DataFrame:
    """One row: true pairs that any key of at least this precision finds."""
    good = quality.filter(F.col("precision") >= least).select("key_name")
    found = pairs.join(F.broadcast(good), "key_name", "left_semi").select("s1_id", "cand_id").distinct().withColumn("f", F.lit(1))
    every = truth.select("s1_id", "cand_id").distinct().join(found, ["s1_id", "cand_id"], "left")
    return every.agg(F.count(F.lit(1)).alias("n_true"), F.count("f").alias("n_reached"), F.round(F.count("f") / F.greatest(F.count(F.lit(1)), F.lit(1)), 6).alias("reach"))


def residual_hardness(pairs: DataFrame, truth: DataFrame, normal: DataFrame) -> DataFrame:
    """One row over true pairs that no key finds: bigram overlap of the core names."""
    left = truth.select("s1_id", "cand_id").distinct().join(pairs.select("s1_id", "cand_id").distinct(), ["s1_id", "cand_id"], "left_anti")
    a = normal.select(F.col("entity_id").alias("s1_id"), X.bigrams(F.col("core_name")).alias("ga"))
    b = normal.select(F.col("entity_id").alias("cand_id"), X.bigrams(F.col("core_name")).alias("gb"))
    j = left.join(a, "s1_id").join(b, "cand_id").select(X.jaccard(F.col("ga"), F.col("gb")).alias("j"))
    return j.agg(
        F.count(F.lit(1)).alias("n_left"), F.round(F.coalesce(F.avg("j"), F.lit(0.0)), 6).alias("mean_overlap"),
        F.round(F.coalesce(F.avg((F.col("j") >= 0.6).cast("double")), F.lit(0.0)), 6).alias("share_easy"),
        F.round(F.coalesce(F.avg((F.col("j") < 0.3).cast("double")), F.lit(0.0)), 6).alias("share_hard"),
    )
