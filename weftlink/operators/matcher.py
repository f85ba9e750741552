"""The pair classifier: gradient-boosted trees, its training samples, and thresholds for unseen countries."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftlink.config import Config
from weftlink.operators.decision import one_owner
from weftlink.operators.features import FEATURES
from weftlink.operators.metrics import best_threshold, first_rows, threshold_curve


def train(rows: DataFrame, cfg: Config, trees: int | None = None) -> PipelineModel:
    """Fits on ``rows`` with the features and ``label``; with a boolean ``validation`` column of two classes, stops early on it."""
    booster = GBTClassifier(
        labelCol="label", featuresCol="features", maxIter=trees or cfg.trees, stepSize=cfg.learning_rate, maxDepth=cfg.max_depth,
        subsamplingRate=cfg.subsample, featureSubsetStrategy="0.8", minInstancesPerNode=cfg.min_child, seed=cfg.seed,
    )
    if "validation" in rows.columns and rows.filter("validation").select("label").distinct().limit(2).count() == 2:
        booster = booster.setValidationIndicatorCol("validation")
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    fitted = booster.fit(assembler.transform(rows.withColumn("label", F.col("label").cast("double"))))
    return PipelineModel([assembler, fitted])


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Adds ``score``: the probability of a match, rounded to six places."""
    out = model.transform(rows).withColumn("score", F.round(vector_to_array("probability")[1], 6))
    return out.drop("features", "rawPrediction", "probability", "prediction")


def importances(model: PipelineModel) -> DataFrame:
    """(feature, importance), the largest first."""
    booster: GBTClassificationModel = model.stages[-1]
    from pyspark.sql import SparkSession

    rows = [(f, float(v)) for f, v in zip(FEATURES, booster.featureImportances.toArray())]
    return SparkSession.active().createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")


def final_trees(model: PipelineModel, cfg: Config) -> int:
    """Trees for the refit on all rows: what early stopping kept, at least the minimum, at most the limit."""
    return min(max(model.stages[-1].getNumTrees, cfg.min_trees), cfg.trees)


def cold_threshold(rows: DataFrame, injected: DataFrame, truth: DataFrame, ids: DataFrame, cfg: Config, warm: float) -> tuple[float, list[tuple[str, float]]]:
    """(threshold for countries not seen in training, [(country, its threshold)]): leave one country out.

    ``rows`` and ``injected`` have features, ``label``, s1_id, cand_id and ``country_key``;
    ``ids(s1_id, country_key)`` are all sampled records.  A country counts with enough positives
    among the blocked pairs; with fewer than two such countries the warm threshold holds.
    """
    counts = rows.filter("label = 1").groupBy("country_key").count().filter(F.col("count") >= cfg.loco_min_positives)
    # a fit a country: there are as many as have enough labelled positives
    usable = [r["country_key"] for r in counts.orderBy(F.col("count").desc(), "country_key").collect()]
    if len(usable) < 2:
        return warm, []
    found = []
    for country in usable:
        rest = rows.filter(F.col("country_key") != country)
        extra = injected.filter(F.col("country_key") != country)
        fold = rest.unionByName(extra.select(*rest.columns))
        if fold.select("label").distinct().limit(2).count() < 2:
            continue
        model = train(fold.drop("validation"), cfg, cfg.loco_trees)
        scored = one_owner(score(model, rows.filter(F.col("country_key") == country)))
        curve = threshold_curve(scored, truth, ids.filter(F.col("country_key") == country), cfg.threshold_steps, cfg.beta)
        found.append((country, float(best_threshold(curve).first()["t"])))
    if not found:
        return warm, []
    return clipped_median([t for _, t in found], cfg.loco_range), found


def clipped_median(values: list[float], limits: tuple[float, float]) -> float:
    ordered = sorted(values)
    n = len(ordered)
    middle = ordered[n // 2] if n % 2 else (ordered[n // 2 - 1] + ordered[n // 2]) / 2
    return min(max(middle, limits[0]), limits[1])


def sampled_ids(ids: DataFrame, most: int, seed: int = 42) -> DataFrame:
    """At most ``most`` S1 ids by a seeded hash; all for most <= 0."""
    distinct = ids.select("s1_id").distinct()
    if most <= 0:
        return distinct
    hashed = distinct.withColumn("h", F.md5(F.concat(F.lit(f"{seed}|"), "s1_id")))
    return first_rows(hashed, F.left("h", F.lit(4)), ["h", "s1_id"], most).filter("first").select("s1_id")


def mined_pairs(labelled: DataFrame, missed: DataFrame, cfg: Config) -> DataFrame:
    """Training pairs for a reranker: (s1_id, cand_id, label, kind).

    All positives, blocked or missed, and per positive ``negatives_per_positive`` negatives:
    the hardest by name cosine first, the rest by a seeded hash.
    """
    positives = labelled.filter("label = 1").select("s1_id", "cand_id").unionByName(missed.select("s1_id", "cand_id")).distinct()
    negatives = labelled.filter("label = 0").select("s1_id", "cand_id", "name_cos").distinct()
    n_pos, n_neg = positives.count(), negatives.count()
    want = min(n_neg, int(cfg.negatives_per_positive * n_pos + 0.5))
    n_hard = int(cfg.hard_fraction * want + 0.5)
    by_cos = first_rows(negatives, F.floor(-F.col("name_cos") * 10_000), [F.col("name_cos").desc(), "s1_id", "cand_id"], n_hard)
    hard = by_cos.filter("first").drop("first")
    rest = by_cos.filter("NOT first").select("s1_id", "cand_id", F.md5(F.concat_ws("|", F.lit(str(cfg.seed)), "s1_id", "cand_id")).alias("h"))
    easy = first_rows(rest, F.left("h", F.lit(4)), ["h", "s1_id", "cand_id"], want - n_hard).filter("first")
    out = (
        positives.select("s1_id", "cand_id", F.lit(1).alias("label"), F.lit("positive").alias("kind"))
        .unionByName(hard.select("s1_id", "cand_id", F.lit(0).alias("label"), F.lit("hard").alias("kind")))
        .unionByName(easy.select("s1_id", "cand_id", F.lit(0).alias("label"), F.lit("random").alias("kind")))
    )
    if n_pos + want > cfg.max_training_pairs:
        hashed = out.withColumn("h", F.md5(F.concat_ws("|", "s1_id", "cand_id")))
        out = first_rows(hashed, F.left("h", F.lit(4)), ["h", "s1_id", "cand_id"], cfg.max_training_pairs).filter("first").drop("h", "first")
    return out


def reranker_split(pairs: DataFrame, most: int = 40_000, seed: int = 42) -> DataFrame:
    """Training pairs with ``part``: a fifth of them, at most ``most``, is 'val' by a seeded hash, the rest 'train'."""
    hashed = pairs.withColumn("h", F.md5(F.concat_ws("|", F.lit(f"{seed}"), "s1_id", "cand_id")))
    n = hashed.count()
    split = first_rows(hashed, F.left("h", F.lit(4)), ["h", "s1_id", "cand_id"], min(most, n // 5))
    return split.withColumn("part", F.when(F.col("first"), "val").otherwise("train")).drop("h", "first")


def split_report(split: DataFrame) -> DataFrame:
    """(part, kind, label, n): what a training run of a reranker would read."""
    return split.groupBy("part", "kind", "label").agg(F.count(F.lit(1)).alias("n"))
