"""Set metrics of linkage, and the threshold that does best by them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def f_beta(tp: Column, n_pred: Column, n_true: Column, beta: float = 0.5) -> Column:
    """Both sets empty: 1; one empty or nothing shared: 0."""
    p, r = tp / n_pred, tp / n_true
    b2 = beta * beta
    return F.when((n_pred == 0) & (n_true == 0), 1.0).when((n_pred == 0) | (n_true == 0) | (tp == 0), 0.0).otherwise((1 + b2) * p * r / (b2 * p + r))


def entity_counts(pred: DataFrame, truth: DataFrame, ids: DataFrame) -> DataFrame:
    """(s1_id, n_pred, n_true, tp) for every S1 id of ``ids(s1_id)``."""
    both = pred.select("s1_id", "cand_id").distinct().withColumn("p", F.lit(1)).join(truth.select("s1_id", "cand_id").distinct().withColumn("t", F.lit(1)), ["s1_id", "cand_id"], "full")
    sums = both.groupBy("s1_id").agg(F.sum(F.coalesce("p", F.lit(0))).alias("n_pred"), F.sum(F.coalesce("t", F.lit(0))).alias("n_true"), F.sum(F.coalesce(F.col("p") * F.col("t"), F.lit(0))).alias("tp"))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_pred", "n_true", "tp")]
    return ids.select("s1_id").distinct().join(sums, "s1_id", "left").select("s1_id", *zero)


def detailed_scores(pred: DataFrame, truth: DataFrame, ids: DataFrame, beta: float = 0.5) -> DataFrame:
    """One row: macro F over all ids, mean precision and recall over ids where both sets are not empty."""
    counts = entity_counts(pred, truth, ids)
    both = (F.col("n_pred") > 0) & (F.col("n_true") > 0)
    return counts.agg(
        F.count(F.lit(1)).alias("n_ids"),
        F.round(F.coalesce(F.avg(f_beta(F.col("tp"), F.col("n_pred"), F.col("n_true"), beta)), F.lit(0.0)), 6).alias("macro_f"),
        F.round(F.coalesce(F.avg(F.when(both, F.col("tp") / F.col("n_pred"))), F.lit(0.0)), 6).alias("mean_precision"),
        F.round(F.coalesce(F.avg(F.when(both, F.col("tp") / F.col("n_true"))), F.lit(0.0)), 6).alias("mean_recall"),
    )


def threshold_curve(owned: DataFrame, truth: DataFrame, ids: DataFrame, grid: tuple[int, int] = (36, 95), beta: float = 0.5) -> DataFrame:
    """(t, macro_f) for t = low/100 ... high/100, in one pass over all pairs.

    ``owned`` has at most one pair a target already: the owner does not depend on the threshold.
    A pair counts for every grid point up to its score, so pairs are first folded to counts by
    (id, score step) and summed downwards within each id; ids without any change add a constant.
    """
    low, high = grid
    people = ids.select("s1_id").distinct()
    n_true = truth.select("s1_id", "cand_id").distinct().join(people, "s1_id", "left_semi").groupBy("s1_id").agg(F.count(F.lit(1)).alias("n_true"))
    hits = owned.select("s1_id", "cand_id", "score").join(truth.select("s1_id", "cand_id").distinct().withColumn("hit", F.lit(1)), ["s1_id", "cand_id"], "left")
    step = F.least(F.floor(F.round(F.col("score") * 100, 6)).cast("int"), F.lit(high))
    steps = hits.withColumn("step", step).filter(F.col("step") >= low).groupBy("s1_id", "step").agg(F.count(F.lit(1)).alias("k"), F.sum(F.coalesce("hit", F.lit(0))).alias("h"))
    grid_rows = steps.select("s1_id", F.explode(F.sequence(F.lit(low), F.col("step"))).alias("t"), "k", "h").groupBy("s1_id", "t").agg(F.sum("k").alias("n_pred"), F.sum("h").alias("tp"))
    known = people.join(n_true, "s1_id", "left").withColumn("n_true", F.coalesce("n_true", F.lit(0)))
    empty = known.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("n_true") == 0).cast("long")).alias("all_empty"))
    part = grid_rows.join(known, "s1_id").groupBy("t").agg(
        F.sum(f_beta(F.col("tp"), F.col("n_pred"), F.col("n_true"), beta)).alias("f"), F.sum((F.col("n_true") == 0).cast("long")).alias("spoiled")
    )
    points = owned.sparkSession.range(low, high + 1).select(F.col("id").cast("int").alias("t"))
    whole = points.join(F.broadcast(part), "t", "left").crossJoin(F.broadcast(empty))
    score = (F.coalesce("f", F.lit(0.0)) + F.col("all_empty") - F.coalesce("spoiled", F.lit(0))) / F.col("n")
    return whole.select((F.col("t") / 100).alias("t"), F.round(F.when(F.col("n") > 0, score).otherwise(0.0), 6).alias("macro_f"))


def best_threshold(curve: DataFrame) -> DataFrame:
    return curve.orderBy(F.col("macro_f").desc(), "t").limit(1)


def entity_split(ids: DataFrame, fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """(s1_id, part): 'val' for the first round(n * fraction) ids by a hash with the seed, else 'train'.

    The cut is found from hash prefixes, so no window runs over all ids in one task.
    """
    hashed = ids.select("s1_id").distinct().withColumn("h", F.md5(F.concat(F.lit(f"{seed}|"), "s1_id")))
    n = hashed.count()
    want = int(n * fraction + 0.5)
    return first_rows(hashed, F.left("h", F.lit(4)), ["h", "s1_id"], want).withColumn("part", F.when(F.col("first"), "val").otherwise("train")).drop("first", "h")


def first_rows(rows: DataFrame, bucket: Column, order: list, want: int) -> DataFrame:
    """Adds ``first``: whether a row is among the first ``want`` by ``order``.

    ``bucket`` is a coarse form of the order, of at most some ten thousand values: whole buckets are in or
    out, and only the one at the edge is ranked.
    """
    counts = sorted((r["b"], r["n"]) for r in rows.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect())  # one row a bucket
    upto, edge = 0, None
    for b, n in counts:
        if upto + n > want:
            edge = b
            break
        upto += n
    if edge is None:
        return rows.withColumn("first", F.lit(True))
    placed = rows.withColumn("b", bucket)
    rank = F.row_number().over(Window.partitionBy("b").orderBy(*order))
    at_edge = placed.filter(F.col("b") == edge).withColumn("first", rank <= want - upto)
    return placed.filter(F.col("b") != edge).withColumn("first", F.col("b") < edge).unionByName(at_edge).drop("b")
