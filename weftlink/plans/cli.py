"""Command line: ``python -m weftlink.plans.cli run --data-dir data ...``."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from weftlink.config import Config
from weftlink.plans.pipeline import configured
from weftlink.session import cut


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="weftlink")
    p.add_argument("command", nargs="?", choices=["run", "train", "predict", "validate", "diagnose", "generate", "mine"])
    p.add_argument("--mode", choices=["run", "train", "predict"], default="run")
    for flag, kind in (
        ("data-dir", str), ("output-dir", str), ("model-dir", str), ("cache-dir", str), ("knn", int), ("min-threshold", float), ("val-fraction", float),
        ("max-train-entities", int), ("max-features", int), ("cold-threshold", float), ("corroboration-delta", float), ("embed-backend", str),
        ("embed-model", str), ("embed-device", str), ("batch-size", int), ("knn-embed", int), ("embed-min-cosine", float), ("cross-encoder-backend", str), ("cross-encoder-model", str), ("cross-encoder-band", float),
    ):
        p.add_argument(f"--{flag}", type=kind)
    p.add_argument("--split", default="train", help="diagnose: which split to read")
    p.add_argument("--candidates", help="validate: the candidate file, by default that of the output folder")
    p.add_argument("--matches", help="validate: the result file, by default that of the output folder")
    p.add_argument("--rules", choices=["official", "strict"], default="official", help="validate: how strict")
    p.add_argument("--check-ids", action="store_true", help="validate: look target ids up even if not strict")
    p.add_argument("--entities", type=int, default=800, help="generate: organisations a country")
    p.add_argument("--dry-run", action="store_true", help="mine: only report what a training run would read")
    for flag in ("no-cache", "no-postal", "no-target-uniqueness", "no-cold-country", "use-embeddings", "use-cross-encoder"):
        p.add_argument(f"--{flag}", action="store_true")
    return p


def config_of(argv: Sequence[str]) -> tuple[str, Config]:
    a = parser().parse_args(argv)
    same = ("data_dir", "output_dir", "model_dir", "cache_dir", "min_threshold", "val_fraction", "max_train_entities", "max_features", "cold_threshold", "corroboration_delta", "embed_backend", "embed_model", "embed_device", "batch_size", "knn_embed", "cross_encoder_backend", "cross_encoder_model", "cross_encoder_band")
    knobs = {k: getattr(a, k) for k in same if getattr(a, k) is not None}
    if a.knn is not None:
        knobs["knn_name"] = a.knn
    if a.embed_min_cosine is not None:
        knobs["min_embed_cosine"] = a.embed_min_cosine
    if a.min_threshold is not None:
        knobs["threshold_steps"] = (int(a.min_threshold * 100) + 1, 95)
    for flag, knob, value in (
        ("no_cache", "use_cache", False), ("no_postal", "use_postal_blocker", False), ("no_target_uniqueness", "target_uniqueness", False),
        ("no_cold_country", "cold_country", False), ("use_embeddings", "use_embeddings", True), ("use_cross_encoder", "use_cross_encoder", True),
    ):
        if getattr(a, flag):
            knobs[knob] = value
    return a.command or a.mode, configured(**knobs)


def _validate(spark: SparkSession, cfg: Config, a: argparse.Namespace) -> int:
    from weftlink.operators import validate

    candidates = a.candidates or f"{cfg.output_dir}/candidate_pairs.tsv"
    matches = a.matches or f"{cfg.output_dir}/matching_results.tsv"
    issues = cut(validate.validate_files(spark, candidates, matches, cfg.data_dir, a.rules, a.check_ids))
    for r in issues.orderBy("file", "level", "rule").collect():  # at most one row a rule and file
        print(f"{r['level']}: {r['file']}: {r['rule']}: {r['n']} ({r['examples']})")
    return validate.exit_code(issues)


def _diagnose(spark: SparkSession, cfg: Config, split: str) -> int:
    from weftlink.operators import diagnose
    from weftlink.plans import pipeline
    from weftlink.sources import records as S

    records, truth = pipeline.load_split(spark, cfg, split)
    if truth is None:
        print(f"the split {split} has no labels")
        return 1
    normal, true = cut(S.normalised(records)), cut(S.truth_pairs(truth))
    pairs = cut(diagnose.key_pairs(diagnose.exact_keys(records, normal)))
    judged = truth.select(F.col("source1_entity_id").alias("s1_id"))
    quality = cut(diagnose.key_quality(pairs, true, judged))
    for part in (diagnose.match_structure(truth), quality.orderBy("key_name"), diagnose.deterministic_reach(pairs, true, quality), diagnose.residual_hardness(pairs, true, normal)):
        part.show(50, truncate=False)
    return 0


def _mine(spark: SparkSession, cfg: Config, dry_run: bool) -> int:
    """Training pairs for a reranker, split, as a table beside the model; or only their counts."""
    from weftlink.operators import blocking, matcher
    from weftlink.plans import pipeline
    from weftlink.sources import records as S

    records, truth = pipeline.load_split(spark, cfg, "train")
    true = S.truth_pairs(truth)
    ids = truth.select(F.col("source1_entity_id").alias("s1_id"))
    normal, candidates, _ = pipeline._prepared(records, cfg, pipeline.keeper(spark, cfg, "train"))
    labelled = cut(blocking.label_pairs(candidates.join(ids, "s1_id", "left_semi"), true))
    split = cut(matcher.reranker_split(matcher.mined_pairs(labelled, blocking.missed_pairs(labelled, true, ids, normal), cfg), seed=cfg.seed))
    matcher.split_report(split).orderBy("part", "kind").show(truncate=False)
    if not dry_run:
        split.write.mode("overwrite").parquet(f"{cfg.model_dir}/reranker_pairs")
    return 0


def main(argv: Sequence[str] | None = None) -> int:
    from weftlink.operators import synth
    from weftlink.plans import pipeline

    argv = sys.argv[1:] if argv is None else argv
    a = parser().parse_args(argv)
    command, cfg = config_of(argv)
    spark = SparkSession.builder.appName("weftlink").getOrCreate()
    if command == "validate":
        return _validate(spark, cfg, a)
    if command == "diagnose":
        return _diagnose(spark, cfg, a.split)
    if command == "mine":
        return _mine(spark, cfg, a.dry_run)
    if command == "generate":
        synth.write_both(spark, cfg.data_dir, a.entities, seed=cfg.seed)
        return 0
    trained = pipeline.run(spark, cfg, command)
    if trained is not None:
        print(trained.threshold, trained.cold, trained.report)
    return 0


if __name__ == "__main__":
    sys.exit(main())
