"""Candidate generators and what is asked of their union."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftlink.config import Config
from weftlink.operators.blocks import best_in_blocks, ranked
from weftlink.operators.encoders import Encoder, load_encoder
from weftlink.operators.features import text_cosines
from weftlink.operators.tfidf import Vocabulary, paired_cosine, text_top_k, text_vectors, text_weights, top_k, vocabulary
from weftlink.session import Keep, cut, written
from weftlink.sources.records import source_number

PAIR = ["s1_id", "cand_id", "cand_source"]


def postal_pairs(records: DataFrame, cap: int = 40, within_country: bool = True) -> DataFrame:
    """Pairs that share a postcode which at most ``cap`` records of the target source (and country) have."""
    some = records.filter("postal <> ''").select("entity_id", "source", "postal", F.col("country_key") if within_country else F.lit("").alias("country_key"))
    targets = some.filter("source > 1")
    rare = targets.groupBy("country_key", "source", "postal").count().filter(F.col("count") <= cap).drop("count")
    kept = targets.join(rare, ["country_key", "source", "postal"], "left_semi")
    ours = some.filter("source = 1").select(F.col("entity_id").alias("s1_id"), "country_key", "postal")
    return ours.join(kept, ["country_key", "postal"]).select("s1_id", F.col("entity_id").alias("cand_id"), F.col("source").alias("cand_source"))


def _matrix(t: pa.Table) -> np.ndarray:
    """Unit vectors, one a row; rows without length stay 0."""
    whole = t["v"].combine_chunks()
    m = whole.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(t.num_rows, -1)
    size = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, size, out=np.zeros_like(m), where=size > 0)


def _near(k: int, floor: float):
    def run(q: pa.Table, t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mine, other, source = _matrix(q), _matrix(t).T, t["source"].to_numpy()
        step = max(1, 2_000_000 // other.shape[1])
        out = []
        for low in range(0, len(mine), step):
            cos = mine[low : low + step] @ other
            row, target = np.nonzero(cos >= floor - 1e-6)
            cos = np.round(cos[row, target], 6)
            kept = cos >= floor
            row, target, cos = row[kept], target[kept], cos[kept]
            best = ranked(row * 4 + source[target], cos, k)
            out.append((row[best] + low, target[best], cos[best]))
        return tuple(np.concatenate(x) for x in zip(*out))

    return run


def vector_top_k(vectors: DataFrame, k: int, floor: float) -> DataFrame:
    """``vectors(id, source, country_key, v)``: exact k nearest targets of each S1 vector in its country, by cosine.

    Blocks of vectors are multiplied as matrices.  All vectors have one dimension; NULL ones take no part.
    """
    rows = vectors.filter("v IS NOT NULL").withColumnRenamed("id", "entity_id")
    return best_in_blocks(rows, ["v"], _near(k, floor), k).select(*PAIR, "cos")


def _centroids(sample: np.ndarray, lists: int, rounds: int = 8) -> np.ndarray:
    """Unit centroids by spherical k-means."""
    rng = np.random.default_rng(11)
    at = sample[rng.choice(len(sample), min(lists, len(sample)), replace=False)]
    for _ in range(rounds):
        near = (sample @ at.T).argmax(axis=1)
        sums = np.zeros_like(at)
        np.add.at(sums, near, sample)
        size = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        at = np.where(size > 0, sums / np.where(size > 0, size, 1), at)
    return at


def _probes(sample: np.ndarray, source: np.ndarray, centers: np.ndarray, k: int, wanted: float) -> int:
    """The fewest lists in which a share ``wanted`` of the nearest of each source is found, for at most 500 of the sample."""
    asked = sample[:500]
    rank = np.argsort(np.argsort(-(asked @ centers.T), axis=1), axis=1)
    at = [np.zeros(0, int)]
    for s in np.unique(source[source > 1]):
        there = sample[source == s]
        cos = asked @ there.T
        # a vector is not its own neighbour
        places = np.flatnonzero(source == s)
        mine = places < len(asked)
        cos[places[mine], np.flatnonzero(mine)] = -2.0
        near = np.argsort(-cos, axis=1)[:, : min(k, len(there))]
        at.append(np.take_along_axis(rank, (there @ centers.T).argmax(axis=1)[near], axis=1).ravel())
    every = np.concatenate(at)
    return int(np.quantile(every, wanted, method="higher")) + 1 if every.size else len(centers)


def approximate_top_k(vectors: DataFrame, k: int, floor: float, lists: int = 64, recall: float = 0.95, fit_on: int = 20_000) -> DataFrame:
    """As ``vector_top_k``, but every S1 vector meets only the targets of the lists nearest to it.

    Every target is in the list of its nearest centroid.  Centroids are fitted on at most ``fit_on`` vectors,
    chosen by a hash of the id, and so is the number of lists to search, for the wanted ``recall``; all
    vectors are indexed.  For sides of which the exact join is too much; ``lists`` is meant to
    grow with the square root of a country's targets.
    """
    rows = vectors.filter("v IS NOT NULL")
    n = max(1, rows.count())
    # a hash cut keeps the sample near its size without a sort of all rows
    share = min(1.0, fit_on / n)
    chosen = rows.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))).select("source", "v").limit(2 * fit_on).toArrow()
    if not chosen.num_rows:
        return vector_top_k(vectors, k, floor)
    sample = _matrix(chosen)
    fitted = _centroids(sample, lists)
    probes = _probes(sample, chosen["source"].to_numpy(), fitted, k, recall)
    shared = vectors.sparkSession.sparkContext.broadcast(fitted)
    schema = "id string, source int, country_key string, v array<double>"

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centers = shared.value
        for b in batches:
            t = pa.Table.from_batches([b])
            if not t.num_rows:
                continue
            cos = _matrix(t) @ centers.T
            own = t["source"].to_numpy() == 1
            wanted = np.where(own, min(probes, len(centers)), 1)
            order = np.argsort(-cos, axis=1, kind="stable")
            at = np.repeat(np.arange(len(own)), wanted)
            nth = np.arange(len(at)) - np.repeat(np.cumsum(wanted) - wanted, wanted)
            out = t.take(pa.array(at))
            keys = pa.array([f"{c}\u0001{n}" for c, n in zip(out["country_key"].to_pylist(), order[at, nth])])
            yield from out.set_column(out.schema.get_field_index("country_key"), "country_key", keys).to_batches()

    placed = rows.select(F.col("id").cast("string").alias("id"), F.col("source").cast("int").alias("source"), F.coalesce("country_key", F.lit("")).alias("country_key"), F.col("v").cast("array<double>").alias("v"))
    return vector_top_k(cut(placed.mapInArrow(listed, schema)), k, floor)


def _caps(cfg: Config) -> dict[str, int]:
    return {"min_df": cfg.min_df, "max_df": cfg.max_df, "max_features": cfg.max_features}


def name_weights(records: DataFrame, cfg: Config) -> DataFrame:
    return text_weights(records, "core_name", *cfg.name_grams, **_caps(cfg))


def squish_weights(records: DataFrame, cfg: Config) -> DataFrame:
    return text_weights(records, "name_squish", *cfg.squish_grams, within_words=False, **_caps(cfg))


def name_vectors(records: DataFrame, cfg: Config) -> DataFrame:
    return text_vectors(records, "core_name", *cfg.name_grams, **_caps(cfg))


def address_vectors(records: DataFrame, cfg: Config) -> DataFrame:
    return text_vectors(records, "norm_addr", *cfg.addr_grams, **_caps(cfg))


def squish_vectors(records: DataFrame, cfg: Config) -> DataFrame:
    return text_vectors(records, "name_squish", *cfg.squish_grams, within_words=False, **_caps(cfg))


def text_indexes(records: DataFrame, cfg: Config, *names: str) -> dict[str, tuple[str, Vocabulary]]:
    """(text column, vocabulary) of the cosines of these names."""
    kinds = {"name_cos": ("core_name", cfg.name_grams, True), "addr_cos": ("norm_addr", cfg.addr_grams, True), "squish_cos": ("name_squish", cfg.squish_grams, False)}
    return {n: (c, vocabulary(records, c, *grams, within_words=within, **_caps(cfg))) for n, (c, grams, within) in kinds.items() if n in names}


def embedding_vectors(records: DataFrame, cfg: Config, encoder: Encoder | None = None) -> DataFrame:
    """(entity_id, source, country_key, grams, w): the encoder's vector of every core name, a dimension as a gram."""
    encoder = encoder or load_encoder(cfg)
    return encoder(records.select("entity_id", "source", "country_key", F.col("core_name").alias("text")))


def record_vectors(records: DataFrame, cfg: Config, keep: Keep = written) -> dict[str, DataFrame]:
    """The vectors of each cosine, by the name of its feature; each is written once."""
    makers = {"name_cos": name_vectors, "addr_cos": address_vectors, "squish_cos": squish_vectors}
    if cfg.use_embeddings:
        makers["embed_cos"] = embedding_vectors
    return {name: keep(name, lambda make=make: make(records, cfg)) for name, make in makers.items()}


def embedding_top_k(vectors: DataFrame, cfg: Config) -> DataFrame:
    """Nearest targets by embedding: exact, or by lists of centroids where a country has more than ``exact_embed_targets`` targets."""
    dims = F.sequence(F.lit(0), F.lit(cfg.embed_dim - 1))
    at = F.map_from_arrays("grams", "w")
    dense = F.transform(dims, lambda i: F.coalesce(F.element_at(at, i.cast("bigint")), F.lit(0.0)))
    country = F.col("country_key") if cfg.block_within_country else F.lit("")
    rows = vectors.select(F.col("entity_id").alias("id"), "source", country.alias("country_key"), dense.alias("v"))
    most = vectors.filter("source > 1").groupBy(country.alias("c")).count().agg(F.max("count")).first()[0] or 0
    if most <= cfg.exact_embed_targets:
        return vector_top_k(rows, cfg.knn_embed, cfg.min_embed_cosine)
    return approximate_top_k(rows, cfg.knn_embed, cfg.min_embed_cosine, int(most**0.5))


def union_pairs(*blocks: DataFrame) -> DataFrame:
    """Distinct pairs of all blockers."""
    out = blocks[0].select(*PAIR)
    for b in blocks[1:]:
        out = out.unionByName(b.select(*PAIR))
    return out.distinct()


def candidates(records: DataFrame, cfg: Config, vectors: dict[str, DataFrame] | None = None) -> DataFrame:
    """(s1_id, cand_id, cand_source, name_cos): the union of the enabled blockers.

    ``vectors`` are those of ``record_vectors``; where they are not given, texts are met instead of arrays, and none is written.
    """
    within = cfg.block_within_country
    wanted = {"name_cos": (cfg.knn_name, cfg.min_name_cosine)}
    if cfg.use_addr_blocker:
        wanted["addr_cos"] = cfg.knn_addr, cfg.min_addr_cosine
    if cfg.use_squish_blocker:
        wanted["squish_cos"] = cfg.knn_squish, cfg.min_squish_cosine
    if vectors is None:
        indexes = text_indexes(records, cfg, *wanted)
        blocks = [text_top_k(records, *indexes[n], k, floor, within) for n, (k, floor) in wanted.items()]
    else:
        blocks = [top_k(vectors[n], k, floor, within) for n, (k, floor) in wanted.items()]
    if cfg.use_embeddings:
        blocks.append(embedding_top_k(embedding_vectors(records, cfg) if vectors is None else vectors["embed_cos"], cfg))
    if cfg.use_postal_blocker:
        blocks.append(postal_pairs(records, cfg.postal_cap, within))
    if vectors is not None:
        return paired_cosine(union_pairs(*blocks), vectors["name_cos"], "name_cos")
    found = cut(union_pairs(*blocks))
    return text_cosines(found, records, {"name_cos": indexes["name_cos"]}).withColumn("name_cos", F.round("name_cos", 6))


def label_pairs(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """Adds ``label``: 1 for pairs in ``truth(s1_id, cand_id)``, else 0."""
    known = truth.select("s1_id", "cand_id").distinct().withColumn("label", F.lit(1))
    return pairs.join(known, ["s1_id", "cand_id"], "left").withColumn("label", F.coalesce("label", F.lit(0)))


def missed_pairs(pairs: DataFrame, truth: DataFrame, sample: DataFrame, records: DataFrame) -> DataFrame:
    """True pairs of the sampled S1 ids (column s1_id) whose target exists and that blocking has not found."""
    there = records.select(F.col("entity_id").alias("cand_id")).distinct()
    wanted = truth.select("s1_id", "cand_id").distinct().join(sample.select("s1_id").distinct(), "s1_id", "left_semi").join(there, "cand_id", "left_semi")
    return wanted.join(pairs.select("s1_id", "cand_id"), ["s1_id", "cand_id"], "left_anti").withColumn("cand_source", source_number(F.col("cand_id")))


def blocking_recall(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: recall over all true pairs (1 without any), the pairs, and the S1 ids found in full."""
    found = label_pairs(truth.select("s1_id", "cand_id").distinct(), pairs.select("s1_id", "cand_id"))
    by_id = found.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("hit"))
    total = by_id.agg(F.sum("n").alias("n"), F.sum("hit").alias("hit"), F.sum((F.col("n") == F.col("hit")).cast("long")).alias("full_ids"))
    count = pairs.select("s1_id", "cand_id").distinct().agg(F.count(F.lit(1)).alias("n_pairs"))
    return total.crossJoin(F.broadcast(count)).select(
        F.when(F.coalesce("n", F.lit(0)) == 0, 1.0).otherwise(F.round(F.col("hit") / F.col("n"), 6)).alias("recall"),
        F.coalesce("n", F.lit(0)).alias("n_true"), F.coalesce("hit", F.lit(0)).alias("n_found"), F.coalesce("full_ids", F.lit(0)).alias("full_ids"), "n_pairs",
    )
