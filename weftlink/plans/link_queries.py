"""Queries over the record-linkage operators; each reads its whole tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.config import Config
from weftlink.functions import fuzzy
from weftlink.functions import text as X
from weftlink.functions.vectors import hashing_embedding
from weftlink.operators import blocking as B
from weftlink.operators import decision as D
from weftlink.operators import diagnose as G
from weftlink.operators import features as P
from weftlink.operators import matcher as M
from weftlink.operators import metrics as E
from weftlink.operators import synth, tfidf, validate
from weftlink.plans import pipeline
from weftlink.session import cut, table
from weftlink.sources import records as S

CFG = Config()
#: The list data gives no country to score by, so queries route by this one, as if it had been held out.
HELD_OUT = "france"


def _normal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.normalised(S.all_records(spark, sf_dir))


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s1_id, cand_id, score): every stored score of every candidate pair."""
    t = table(spark, sf_dir, "candidate_pairs")
    z = F.arrays_zip(F.split("candidate_entity_ids", ",", -1).alias("i"), F.col("candidate_scores").alias("s"))
    rows = t.filter("candidate_entity_ids IS NOT NULL").select(F.col("source1_entity_id").alias("s1_id"), F.explode(z).alias("z"))
    return rows.select("s1_id", F.trim("z.i").alias("cand_id"), F.col("z.s").alias("score")).filter("score IS NOT NULL AND (cand_id LIKE 'S2-%' OR cand_id LIKE 'S3-%')")


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s1_id, cand_id, cand_source, score): the best stored score of every candidate pair."""
    return _stored(spark, sf_dir).groupBy("s1_id", "cand_id").agg(F.max("score").alias("score")).select("s1_id", "cand_id", S.source_number(F.col("cand_id")).alias("cand_source"), "score")


def _truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.latest_truth(table(spark, sf_dir, "match_labels"))


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _truth(spark, sf_dir).select(F.col("source1_entity_id").alias("s1_id"))


def _true_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.truth_pairs(_truth(spark, sf_dir))


def normalize_records(spark, sf_dir):
    return _normal(spark, sf_dir)


def contact_keys(spark, sf_dir):
    blob = F.lower(F.concat_ws(" ", "business_name", "business_address"))
    return S.all_records(spark, sf_dir).select("entity_id", *[F.array_join(F.sort_array(v), ",").alias(k) for k, v in X.contact_keys(blob).items()])


def truth_lists(spark, sf_dir):
    return _truth(spark, sf_dir).select("source1_entity_id", F.array_join("matched", ",").alias("matched_ids"))


def char_ngrams(spark, sf_dir):
    return tfidf.char_grams(_normal(spark, sf_dir), ["entity_id"], "core_name", *CFG.name_grams)


def gram_statistics(spark, sf_dir):
    n = _normal(spark, sf_dir)
    g = tfidf.char_grams(n, ["entity_id"], "core_name", *CFG.name_grams)
    return tfidf.gram_statistics(g, n.count()).withColumn("idf", F.round("idf", 6))


def tfidf_weights(spark, sf_dir):
    return B.name_weights(_normal(spark, sf_dir), CFG).select("entity_id", "gram", F.round("w", 6).alias("w"))


def squish_weights(spark, sf_dir):
    return B.squish_weights(_normal(spark, sf_dir), CFG).select("entity_id", "gram", F.round("w", 6).alias("w"))


def block_name_topk(spark, sf_dir):
    return tfidf.top_k(cut(B.name_vectors(_normal(spark, sf_dir), CFG)), CFG.knn_name, CFG.min_name_cosine)


def block_addr_topk(spark, sf_dir):
    return tfidf.top_k(cut(B.address_vectors(_normal(spark, sf_dir), CFG)), CFG.knn_addr, CFG.min_addr_cosine)


def block_squish_topk(spark, sf_dir):
    return tfidf.top_k(cut(B.squish_vectors(_normal(spark, sf_dir), CFG)), CFG.knn_squish, CFG.min_squish_cosine)


def block_postal_capped(spark, sf_dir):
    return B.postal_pairs(_normal(spark, sf_dir), CFG.postal_cap)


def _dense(spark, sf_dir):
    t = table(spark, sf_dir, "embeddings")
    return t.select("vec_id", F.concat(F.lit("V"), F.col("vec_id").cast("string")).alias("id"), (F.col("vec_id") % 3 + 1).cast("int").alias("source"), F.col("label").cast("string").alias("country_key"), F.col("embedding").alias("v"))


def block_embedding_topk(spark, sf_dir):
    return B.vector_top_k(_dense(spark, sf_dir), CFG.knn_embed, 0.1)


def candidates_union(spark, sf_dir):
    normal = cut(_normal(spark, sf_dir).select("entity_id", "source", "country_key", "core_name", "norm_addr", "postal"))
    return B.candidates(normal.withColumn("name_squish", F.replace("core_name", F.lit(" "), F.lit(""))), CFG)


def hashing_vectors(spark, sf_dir):
    return hashing_embedding(S.all_records(spark, sf_dir), "entity_id", "business_name").withColumn("value", F.round("value", 6))


def pair_features_native(spark, sf_dir):
    normal = cut(_normal(spark, sf_dir).select("entity_id", "source", "country_key", "core_name", "norm_addr", "postal"))
    normal = normal.withColumn("name_squish", F.replace("core_name", F.lit(" "), F.lit("")))
    met = P.attached_with_cosines(_stored(spark, sf_dir), normal, B.text_indexes(normal, CFG, "addr_cos", "squish_cos"), best="score")
    out = P.native_features(met.withColumn("cand_source", S.source_number(F.col("cand_id"))).withColumnRenamed("score", "name_cos"))
    names = [f for f in P.FEATURES if not f.startswith("rf_")]
    return out.select("s1_id", "cand_id", *[F.round(F.col(f).cast("double"), 6).alias(f) for f in names])


def pair_features_fuzzy(spark, sf_dir):
    out = P.pair_similarities(_stored(spark, sf_dir), _normal(spark, sf_dir), best="score")
    return out.select("s1_id", "cand_id", *[F.round(f, 6).alias(f) for f in P.FEATURES if f.startswith("rf_")])


def label_pairs(spark, sf_dir):
    judged = _scored(spark, sf_dir).join(_judged(spark, sf_dir), "s1_id", "left_semi")
    return B.label_pairs(judged, _true_pairs(spark, sf_dir))


def missed_positives(spark, sf_dir):
    records = S.all_records(spark, sf_dir)
    return B.missed_pairs(_scored(spark, sf_dir), _true_pairs(spark, sf_dir), _judged(spark, sf_dir), records).select("s1_id", "cand_id", "cand_source")


def blocking_recall(spark, sf_dir):
    return B.blocking_recall(_scored(spark, sf_dir), _true_pairs(spark, sf_dir))


def assign_unique(spark, sf_dir):
    return D.one_owner(D.above(_scored(spark, sf_dir), 0.5))


def matches_by_s1(spark, sf_dir):
    lists = D.grouped_lists(D.one_owner(D.above(_scored(spark, sf_dir), 0.5)), _ids(spark, sf_dir).withColumnRenamed("s1_id", "id"))
    return lists.select("id", F.array_join("ids", ",").alias("ids"))


def _ids(spark, sf_dir):
    return table(spark, sf_dir, "source1").select(F.col("entity_id").alias("s1_id"))


def grouped_id_lists(spark, sf_dir):
    lists = D.grouped_lists(_scored(spark, sf_dir), _ids(spark, sf_dir).withColumnRenamed("s1_id", "id"), by_score=False)
    return lists.select("id", F.array_join("ids", ",").alias("ids"))


def entity_fbeta(spark, sf_dir):
    c = E.entity_counts(D.one_owner(D.above(_scored(spark, sf_dir), 0.5)), _true_pairs(spark, sf_dir), _judged(spark, sf_dir))
    return c.withColumn("f", F.round(E.f_beta(F.col("tp"), F.col("n_pred"), F.col("n_true")), 6))


def macro_fbeta(spark, sf_dir):
    return E.detailed_scores(D.one_owner(D.above(_scored(spark, sf_dir), 0.5)), _true_pairs(spark, sf_dir), _judged(spark, sf_dir))


def threshold_curve(spark, sf_dir):
    owned = D.one_owner(_scored(spark, sf_dir)).join(_judged(spark, sf_dir), "s1_id", "left_semi")
    return E.threshold_curve(owned, _true_pairs(spark, sf_dir), _judged(spark, sf_dir))


def tune_threshold(spark, sf_dir):
    return E.best_threshold(threshold_curve(spark, sf_dir))


def entity_split(spark, sf_dir):
    return E.entity_split(_judged(spark, sf_dir), CFG.val_fraction, CFG.seed)


def sample_entities(spark, sf_dir):
    return M.sampled_ids(_ids(spark, sf_dir), 500, CFG.seed)


def _with_addr(spark, sf_dir):
    normal = cut(_normal(spark, sf_dir))
    pairs = tfidf.paired_cosine(_scored(spark, sf_dir), B.address_vectors(normal, CFG), "addr_cos")
    return P.native_features(P.attach(pairs, normal)), normal


def corroborate(spark, sf_dir):
    out, _ = _with_addr(spark, sf_dir)
    return D.corroborated(out, 0.6, 0.25).select("s1_id", "cand_id", "score", "postal_equal", "addr_cos")


def band_rerank_stub(spark, sf_dir):
    records = S.all_records(spark, sf_dir).select("entity_id", X.composed(F.col("business_name"), F.col("business_address"), F.col("country")).alias("t"))
    a = records.select(F.col("entity_id").alias("s1_id"), F.col("t").alias("a_text"))
    b = records.select(F.col("entity_id").alias("cand_id"), F.col("t").alias("b_text"))
    pairs = _scored(spark, sf_dir).filter(F.col("score") >= 0.3).join(a, "s1_id").join(b, "cand_id")
    return D.blended(pairs, 0.5, 0.15, 0.5).select("s1_id", "cand_id", "score")


def cold_threshold_routing(spark, sf_dir):
    country = _normal(spark, sf_dir).select(F.col("entity_id").alias("s1_id"), "country_key")
    seen = country.select("country_key").distinct().filter(F.col("country_key") != HELD_OUT)
    scored = D.routed(_scored(spark, sf_dir).join(country, "s1_id"), 0.5, M.clipped_median([0.36, 0.91, 0.7], CFG.loco_range), seen)
    return D.above(scored, F.col("threshold")).select("s1_id", "cand_id", "cand_source", "score", "country_key")


def match_structure(spark, sf_dir):
    return G.match_structure(_truth(spark, sf_dir))


def _key_pairs(spark, sf_dir):
    records = S.all_records(spark, sf_dir)
    return G.key_pairs(G.exact_keys(records, S.normalised(records)))


def exact_key_pairs(spark, sf_dir):
    return _key_pairs(spark, sf_dir)


def exact_key_analysis(spark, sf_dir):
    return G.key_quality(_key_pairs(spark, sf_dir), _true_pairs(spark, sf_dir), _judged(spark, sf_dir))


def deterministic_reach(spark, sf_dir):
    pairs = cut(_key_pairs(spark, sf_dir))
    truth = _true_pairs(spark, sf_dir)
    return G.deterministic_reach(pairs, truth, G.key_quality(pairs, truth, _judged(spark, sf_dir)))


def residual_bigram(spark, sf_dir):
    return G.residual_hardness(_key_pairs(spark, sf_dir), _true_pairs(spark, sf_dir), _normal(spark, sf_dir))


def hard_negative_mining(spark, sf_dir):
    judged = B.label_pairs(_scored(spark, sf_dir).join(_judged(spark, sf_dir), "s1_id", "left_semi"), _true_pairs(spark, sf_dir)).withColumnRenamed("score", "name_cos")
    missed = B.missed_pairs(judged, _true_pairs(spark, sf_dir), _judged(spark, sf_dir), S.all_records(spark, sf_dir))
    return M.mined_pairs(cut(judged), missed, CFG)


def _lines(spark, sf_dir):
    """The candidate table as a result file with its dirt: one line a stored cell."""
    t = table(spark, sf_dir, "candidate_pairs").select(F.concat_ws("\t", "source1_entity_id", F.coalesce("candidate_entity_ids", F.lit(""))).alias("value"))
    header = spark.createDataFrame([("source1_entity_id\tcandidate_entity_ids",)], "value string")
    return header.withColumn("line_no", F.lit(1).cast("long")).unionByName(t.withColumn("line_no", F.monotonically_increasing_id() + 2))


def validate_candidates(spark, sf_dir):
    targets = table(spark, sf_dir, "source2").select("entity_id").unionByName(table(spark, sf_dir, "source3").select("entity_id"))
    found = validate.validate_lines(_lines(spark, sf_dir), "candidate_pairs", "candidate_entity_ids", _ids(spark, sf_dir), targets)
    return found.select("file", "rule", "level", "n", "examples")


#: A result file that breaks every rule.
BROKEN = ["s1_entity_id\tmatched", "S1-1\tS2-1,S2-1", "S1-1\tS1-9", "S1-8\tX-1", "S1-2", "S1-3\tS2-404\tmore", "S1-4\tS3-404"]


def validate_broken(spark, sf_dir):
    """Every rule on a file of its own, in both modes."""
    lines = spark.createDataFrame(list(enumerate(BROKEN, 1)), "line_no long, value string")
    ids = spark.createDataFrame([(f"S1-{i}",) for i in range(1, 5)], "id string")
    targets = spark.createDataFrame([("S2-1",)], "id string")
    each = [validate.validate_lines(lines, mode, "matched_entity_ids", ids, targets, mode) for mode in ("official", "strict")]
    return each[0].unionByName(each[1])


def fuzzy_ratios(spark, sf_dir):
    """The string similarities on pairs of texts whose values were worked out by hand."""
    rows = [("abcd", "abed"), ("new york mets", "mets new york"), ("a b", "a b c"), ("", ""), ("", "x"), ("apex foods", "apex motors"), ("abc", "xxabcxx"), ("ab", "bxxxa")]
    df = spark.createDataFrame(rows, "a string, b string")
    s = fuzzy.scores_of("a", "b", "a", "b")
    return df.select("a", "b", s.alias("s")).select("a", "b", *[F.round(f"s.{c}", 6).alias(c) for c in ("token_set", "token_sort", "partial")])


def approximate_neighbours(spark, sf_dir):
    """One row: whether the search by lists of centroids finds nine in ten of the exact nearest, over all embeddings."""
    vectors = cut(_dense(spark, sf_dir).withColumn("country_key", F.lit("")))
    exact = B.vector_top_k(vectors, CFG.knn_embed, 0.1).select("s1_id", "cand_id")
    near = B.approximate_top_k(vectors, CFG.knn_embed, 0.1).select("s1_id", "cand_id", F.lit(1).alias("hit"))
    found = exact.join(near, ["s1_id", "cand_id"], "left").agg(F.count(F.lit(1)).alias("n_exact"), F.count("hit").alias("n"))
    return found.select("n_exact", (F.col("n") >= 0.9 * F.col("n_exact")).alias("nine_in_ten"))


def rerank_cold(spark, sf_dir):
    """The band around each pair's own threshold, reranked: warm pairs at 0.5, those of the held-out country at 0.7."""
    normal = cut(_normal(spark, sf_dir))
    country = normal.select(F.col("entity_id").alias("s1_id"), "country_key")
    seen = country.select("country_key").distinct().filter(F.col("country_key") != HELD_OUT)
    scored = D.routed(_scored(spark, sf_dir).join(country, "s1_id"), 0.5, 0.7, seen)
    return pipeline.decided(scored, normal, replace(CFG, use_cross_encoder=True)).select("s1_id", "cand_id", "score")


def reranker_split(spark, sf_dir):
    return M.split_report(M.reranker_split(hard_negative_mining(spark, sf_dir)))


def validate_subset(spark, sf_dir):
    return validate.validate_subset(_true_pairs(spark, sf_dir), _scored(spark, sf_dir), "strict")


def _training_rows(spark, sf_dir):
    """(rows, extra): the judged pairs with all features and the true pairs that blocking missed, as the pipeline trains on them."""
    normal = cut(_normal(spark, sf_dir))
    ids, true = _judged(spark, sf_dir), _true_pairs(spark, sf_dir)
    judged = cut(B.label_pairs(_scored(spark, sf_dir).join(ids, "s1_id", "left_semi"), true).withColumnRenamed("score", "name_cos").withColumn("missed", F.lit(False)))
    missed = B.missed_pairs(judged, true, ids, normal).withColumn("label", F.lit(1)).withColumn("missed", F.lit(True))
    parts = E.entity_split(ids, CFG.val_fraction, CFG.seed).withColumn("validation", F.col("part") == "val").drop("part")
    country = normal.filter("source = 1").select(F.col("entity_id").alias("s1_id"), "country_key")
    pairs = cut(judged.unionByName(tfidf.paired_cosine(missed, B.name_vectors(normal, CFG), "name_cos")).join(parts, "s1_id").join(country, "s1_id"))
    pairs = tfidf.paired_cosines(pairs, {"addr_cos": B.address_vectors(normal, CFG), "squish_cos": B.squish_vectors(normal, CFG)})
    every = cut(P.all_features(pairs, normal))
    return every.filter("NOT missed").drop("missed"), every.filter("missed").drop("missed")


def _fitted(rows: DataFrame, extra: DataFrame):
    return M.train(rows.unionByName(extra.filter("NOT validation")), CFG)


def matcher_scores(spark, sf_dir):
    rows, extra = _training_rows(spark, sf_dir)
    return M.score(_fitted(rows, extra), rows.filter("validation")).select("s1_id", "cand_id", "label", "score")


def feature_importance(spark, sf_dir):
    return M.importances(_fitted(*_training_rows(spark, sf_dir)))


def cold_country_threshold(spark, sf_dir):
    rows, extra = _training_rows(spark, sf_dir)
    country = _normal(spark, sf_dir).filter("source = 1").select(F.col("entity_id").alias("s1_id"), "country_key")
    ids = _judged(spark, sf_dir).join(country, "s1_id")
    cold, folds = M.cold_threshold(rows, extra, _true_pairs(spark, sf_dir), ids, CFG, 0.5)
    return spark.createDataFrame([*folds, ("unseen", cold)], "country_key string, t double")


def synthetic_split(spark, sf_dir):
    made = synth.split(spark, {"US": 400, "India": 400})
    return made["source1"].unionByName(made["source2"]).unionByName(made["source3"])


QUERIES = {
    f.__name__: f
    for f in (
        normalize_records, contact_keys, truth_lists, char_ngrams, gram_statistics, tfidf_weights, squish_weights, block_name_topk, block_addr_topk,
        block_squish_topk, block_postal_capped, block_embedding_topk, candidates_union, hashing_vectors, pair_features_native, pair_features_fuzzy,
        label_pairs, missed_positives, blocking_recall, assign_unique, matches_by_s1, grouped_id_lists, entity_fbeta, macro_fbeta, threshold_curve,
        tune_threshold, entity_split, sample_entities, corroborate, band_rerank_stub, cold_threshold_routing, match_structure, exact_key_pairs,
        exact_key_analysis, deterministic_reach, residual_bigram, hard_negative_mining, validate_candidates, validate_subset, matcher_scores,
        feature_importance, cold_country_threshold, synthetic_split, validate_broken, fuzzy_ratios, approximate_neighbours, rerank_cold, reranker_split,
    )
}
