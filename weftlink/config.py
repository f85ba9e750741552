"""Knobs of the record-linkage pipeline, with the defaults that results depend on."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass


# The defaults of the knobs.
@dataclass(frozen=True)
class Config:
    data_dir: str = "data"
    output_dir: str = "output"
    model_dir: str = "model"
    cache_dir: str = "cache"
    use_cache: bool = True
    seed: int = 42
    name_grams: tuple[int, int] = (4, 5)
    addr_grams: tuple[int, int] = (3, 4)
    squish_grams: tuple[int, int] = (4, 5)
    min_df: int = 2
    max_df: int = 12_000
    max_features: int = 400_000
    knn_name: int = 25
    min_name_cosine: float = 0.06
    use_addr_blocker: bool = True
    knn_addr: int = 12
    min_addr_cosine: float = 0.30
    use_squish_blocker: bool = True
    knn_squish: int = 12
    min_squish_cosine: float = 0.30
    use_postal_blocker: bool = True
    postal_cap: int = 40
    block_within_country: bool = True
    use_embeddings: bool = False
    embed_backend: str = "hashing"
    embed_model: str = ""
    embed_device: str = "cpu"
    batch_size: int = 256
    embed_dim: int = 256
    embed_grams: tuple[int, int] = (3, 4)
    knn_embed: int = 15
    exact_embed_targets: int = 200_000
    min_embed_cosine: float = 0.55
    max_train_entities: int = 150_000
    inject_missed: bool = True
    trees: int = 500
    min_trees: int = 150
    learning_rate: float = 0.05
    max_depth: int = 6
    min_child: int = 50
    subsample: float = 0.8
    early_stop: int = 50
    val_fraction: float = 0.2
    beta: float = 0.5
    min_threshold: float = 0.35
    threshold_steps: tuple[int, int] = (36, 95)
    target_uniqueness: bool = True
    cold_country: bool = True
    cold_threshold: float | None = None
    loco_min_positives: int = 100
    loco_trees: int = 200
    loco_range: tuple[float, float] = (0.20, 0.95)
    corroboration_delta: float = 0.0
    corroboration_addr_cosine: float = 0.75
    use_cross_encoder: bool = False
    cross_encoder_backend: str = "stub"
    cross_encoder_model: str = ""
    cross_encoder_band: float = 0.15
    cross_encoder_weight: float = 0.5
    negatives_per_positive: int = 4
    hard_fraction: float = 0.7
    max_training_pairs: int = 1_500_000

    def key(self, *more: object) -> str:
        """Names a cache: other knobs, or other inputs (``more`` tells them apart), give another key."""
        return hashlib.sha256(json.dumps([asdict(self), *more], sort_keys=True).encode()).hexdigest()[:16]
