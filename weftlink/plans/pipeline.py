"""The linkage pipeline end to end: train on a labelled split, predict another, write result files."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.config import Config
from weftlink.functions import text as X
from weftlink.operators import blocking as B
from weftlink.operators import decision as D
from weftlink.operators import features as P
from weftlink.operators import matcher as M
from weftlink.operators import metrics as E
from weftlink.operators.encoders import load_reranker
from weftlink.operators.tfidf import paired_cosine, paired_cosines
from weftlink.session import Keep, cache, cut, file_of, written
from weftlink.sources import records as S


@dataclass
class Trained:
    """A fitted matcher with its thresholds and the countries it has seen."""

    model: PipelineModel
    threshold: float
    seen: DataFrame
    cold: float | None = None
    report: dict = field(default_factory=dict)

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        self.seen.write.mode("overwrite").parquet(f"{path}/seen")
        meta = {"threshold": self.threshold, "cold": self.cold, "report": self.report}
        spark = SparkSession.active()
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Trained":
        meta = json.loads(spark.read.text(f"{path}/meta").first()["value"])
        return cls(PipelineModel.load(f"{path}/model"), seen=spark.read.parquet(f"{path}/seen"), **meta)


def _prepared(records: DataFrame, cfg: Config, keep: Keep = written) -> tuple[DataFrame, DataFrame, dict[str, DataFrame]]:
    """Normal forms, candidates, and the vectors of each cosine, all written once."""
    normal = keep("records", lambda: S.normalised(records))
    vectors = B.record_vectors(normal, cfg, keep)
    return normal, keep("candidates", lambda: B.candidates(normal, cfg, vectors)), vectors


def _features(pairs: DataFrame, normal: DataFrame, vectors: dict[str, DataFrame]) -> DataFrame:
    return P.all_features(paired_cosines(pairs, {k: v for k, v in vectors.items() if k != "name_cos"}), normal)


def train(records: DataFrame, truth: DataFrame, cfg: Config, keep: Keep = written) -> Trained:
    """Blocks, labels, fits, tunes and refits; ``truth(source1_entity_id, matched)`` covers the S1 records of the split."""
    true = S.truth_pairs(truth)
    ids = cut(M.sampled_ids(truth.select(F.col("source1_entity_id").alias("s1_id")), cfg.max_train_entities, cfg.seed))
    normal, candidates, vectors = _prepared(records, cfg, keep)
    mine = candidates.join(ids, "s1_id", "left_semi")
    country = normal.filter("source = 1").select(F.col("entity_id").alias("s1_id"), "country_key")
    parts = cut(E.entity_split(ids, cfg.val_fraction, cfg.seed))
    labelled = B.label_pairs(mine, true).join(parts, "s1_id").withColumn("validation", F.col("part") == "val").join(country, "s1_id")
    rows = cut(_features(labelled.drop("part"), normal, vectors))
    missed = B.missed_pairs(mine, true, ids, normal)
    injected = paired_cosine(missed, vectors["name_cos"], "name_cos").join(parts, "s1_id").withColumn("validation", F.col("part") == "val").join(country, "s1_id").withColumn("label", F.lit(1))
    extra = cut(_features(injected.drop("part"), normal, vectors).select(*rows.columns))
    fit_rows = rows.unionByName(extra.filter("NOT validation")) if cfg.inject_missed else rows
    model = M.train(fit_rows, cfg)
    val_ids = parts.filter("part = 'val'").select("s1_id")
    val_true = true.join(val_ids, "s1_id", "left_semi")
    scored = cut(M.score(model, rows.filter("validation")))
    owned = D.one_owner(scored) if cfg.target_uniqueness else scored
    best = E.best_threshold(E.threshold_curve(owned, val_true, val_ids, cfg.threshold_steps, cfg.beta)).first()
    warm = float(best["t"])
    report = E.detailed_scores(D.above(owned, warm), val_true, val_ids, cfg.beta).first().asDict()
    report["blocking_recall"] = B.blocking_recall(mine, true.join(ids, "s1_id", "left_semi")).first()["recall"]
    cold = cfg.cold_threshold
    if cold is None and cfg.cold_country:
        cold, report["folds"] = M.cold_threshold(rows, extra, true.join(ids, "s1_id", "left_semi"), ids.join(country, "s1_id"), cfg, warm)
    seen = cut(normal.select("country_key").distinct())
    whole = rows.unionByName(extra) if cfg.inject_missed else rows
    final = M.train(whole.drop("validation"), cfg, M.final_trees(model, cfg))
    return Trained(final, warm, seen, cold, report)


def predict(records: DataFrame, trained: Trained, cfg: Config, keep: Keep = written) -> tuple[DataFrame, DataFrame]:
    """(candidates, matches): every match is a candidate, and a target has one S1 record."""
    normal, candidates, vectors = _prepared(records, cfg, keep)
    country = normal.filter("source = 1").select(F.col("entity_id").alias("s1_id"), "country_key")
    scored = M.score(trained.model, _features(candidates, normal, vectors)).join(country, "s1_id")
    kept = decided(D.routed(scored, trained.threshold, trained.cold, trained.seen), normal, cfg)
    return candidates, D.one_owner(kept) if cfg.target_uniqueness else kept


def decided(scored: DataFrame, normal: DataFrame, cfg: Config) -> DataFrame:
    """The pairs that each pair's own ``threshold`` lets through, reranked or corroborated near it."""
    threshold = F.col("threshold")
    if not cfg.use_cross_encoder:
        return D.corroborated(scored, threshold, cfg.corroboration_delta, cfg.corroboration_addr_cosine)
    texts = normal.select("entity_id", X.composed(F.col("core_name"), F.col("norm_addr"), F.col("country_key")).alias("t"))
    a = texts.select(F.col("entity_id").alias("s1_id"), F.col("t").alias("a_text"))
    b = texts.select(F.col("entity_id").alias("cand_id"), F.col("t").alias("b_text"))
    # pairs below the band do not reach the text join
    near = scored.filter(F.col("score") >= threshold - cfg.cross_encoder_band).join(a, "s1_id").join(b, "cand_id")
    second = load_reranker(cfg)(F.col("a_text"), F.col("b_text"))
    return D.blended(near, threshold, cfg.cross_encoder_band, cfg.cross_encoder_weight, second)


def load_split(spark: SparkSession, cfg: Config, split: str) -> tuple[DataFrame, DataFrame | None]:
    paths = S.resolve_paths(spark, cfg.data_dir, split)
    parts = [S.read_source(spark, paths[f"source{i}"]) for i in (1, 2, 3)]
    truth = S.read_ground_truth(spark, paths["ground_truth"]) if "ground_truth" in paths else None
    return parts[0].unionByName(parts[1]).unionByName(parts[2]), truth


def keeper(spark: SparkSession, cfg: Config, split: str) -> Keep:
    """Where a split's records, vectors and candidates are kept: the cache folder, by configuration and state of the input files, or this run only."""
    if not cfg.use_cache:
        return written
    state = []
    for kind, path in sorted(S.resolve_paths(spark, cfg.data_dir, split).items()):
        fs, p = file_of(spark, path)
        status = fs.getFileStatus(p)
        state.append([kind, path, status.getLen(), status.getModificationTime()])
    return cache(spark, f"{cfg.cache_dir}/{cfg.key(state)}/{split}")


def write_results(order: DataFrame, candidates: DataFrame, matches: DataFrame, cfg: Config) -> None:
    """candidate_pairs and matching_results, one row for every S1 record of ``order(id, at)``, in that order."""
    ids = order.select("id")
    for name, column, lists in (
        ("candidate_pairs", "candidate_entity_ids", D.grouped_lists(candidates, ids, by_score=False)),
        ("matching_results", "matched_entity_ids", D.grouped_lists(matches, ids)),
    ):
        S.write_id_lists(lists.join(order, "id"), f"{cfg.output_dir}/{name}.tsv", "source1_entity_id", column)


def run(spark: SparkSession, cfg: Config, mode: str = "run") -> Trained | None:
    """run: train, then predict the test split if there is one; train or predict: only that."""
    trained = None
    if mode in ("run", "train"):
        records, truth = load_split(spark, cfg, "train")
        trained = train(records, truth, cfg, keeper(spark, cfg, "train"))
        trained.save(cfg.model_dir)
    if mode in ("run", "predict"):
        try:
            records, _ = load_split(spark, cfg, "test")
        except FileNotFoundError:
            if mode == "predict":
                raise
            return trained
        trained = trained or Trained.load(spark, cfg.model_dir)
        candidates, matches = predict(records, trained, cfg, keeper(spark, cfg, "test"))
        order = cut(S.ids_in_file_order(spark, S.resolve_paths(spark, cfg.data_dir, "test")["source1"]))
        write_results(order, candidates, cut(matches), cfg)
    return trained


def configured(**knobs) -> Config:
    return replace(Config(), **knobs)
