"""Text encoders and pair rerankers behind one interface each, chosen by a knob of the configuration.

An encoder takes (entity_id, source, country_key, text) and gives (entity_id, source, country_key, grams, w): the
dimensions of a unit vector that are not 0, in ascending order, and their values.  A reranker takes a
frame with a_text and b_text and gives a column in 0..1.  Only the built-in ones need no model files;
any other backend is an importable ``module:function``, called on Arrow batches.
"""

from __future__ import annotations

import importlib
import importlib.util
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftlink.config import Config
from weftlink.functions.text import bigram_similarity
from weftlink.functions.vectors import hashing_embedding

Encoder = Callable[[DataFrame], DataFrame]
Reranker = Callable[[Column, Column], Column]
_VECTOR = "entity_id string, source int, country_key string, grams array<bigint>, w array<double>"


def _function(path: str) -> Callable:
    module, _, name = path.partition(":")
    if not name:
        raise ValueError(f"no backend {path!r}: give 'hashing' or 'stub', or an importable module:function")
    return getattr(importlib.import_module(module), name)


def _sentence_transformers() -> None:
    if importlib.util.find_spec("sentence_transformers") is None:
        raise ValueError("the backend 'sentence-transformers' needs the package of that name")


def sentence_model(model: str, device: str) -> Callable[[list[str]], np.ndarray]:
    from sentence_transformers import SentenceTransformer

    return SentenceTransformer(model, device=device).encode


def pair_model(model: str, device: str) -> Callable[[list[tuple[str, str]]], np.ndarray]:
    from sentence_transformers import CrossEncoder

    return CrossEncoder(model, device=device).predict


def hashing_encoder(cfg: Config) -> Encoder:
    def encode(rows: DataFrame) -> DataFrame:
        long = hashing_embedding(rows, "entity_id", "text", cfg.embed_dim, cfg.embed_grams)
        folded = long.groupBy("id").agg(F.sort_array(F.collect_list(F.struct(F.col("dim_no").cast("bigint").alias("g"), "value"))).alias("e"))
        arrays = folded.select(F.col("id").alias("entity_id"), F.transform("e", lambda e: e["g"]).alias("grams"), F.transform("e", lambda e: e["value"]).alias("w"))
        return rows.select("entity_id", "source", "country_key").join(arrays, "entity_id")

    return encode


def model_encoder(load: Callable[[str, str], Callable[[list[str]], np.ndarray]], model: str, device: str, batch: int) -> Encoder:
    """An encoder of ``load(model, device)``: called once a task, it gives a function from texts to a matrix."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = load(model, device)
        for pdf in batches:
            for at in range(0, len(pdf), batch):
                part = pdf.iloc[at : at + batch]
                v = np.asarray(encode(part["text"].fillna("").tolist()), dtype=np.float64)
                size = np.sqrt((v * v).sum(axis=1, keepdims=True))
                v = np.divide(v, size, out=np.zeros_like(v), where=size > 0)
                some = [np.flatnonzero(row) for row in v]
                w = pd.Series([row[i] for row, i in zip(v, some)], part.index, object)
                yield part[["entity_id", "source", "country_key"]].assign(grams=pd.Series(some, part.index, object), w=w)

    return lambda rows: rows.select("entity_id", "source", "country_key", "text").mapInPandas(run, _VECTOR)


def load_encoder(cfg: Config) -> Encoder:
    """The encoder that ``embed_backend`` names: 'hashing', 'sentence-transformers', or module:function."""
    if cfg.embed_backend == "hashing":
        return hashing_encoder(cfg)
    if cfg.embed_backend == "sentence-transformers":
        _sentence_transformers()
        return model_encoder(sentence_model, cfg.embed_model, cfg.embed_device, cfg.batch_size)
    return model_encoder(_function(cfg.embed_backend), cfg.embed_model, cfg.embed_device, cfg.batch_size)


def model_reranker(load: Callable[[str, str], Callable[[list[tuple[str, str]]], np.ndarray]], model: str, device: str, batch: int) -> Reranker:
    """Scores of pairs of texts by ``load(model, device)``; if a batch has one outside 0..1 its logistic function is taken."""

    @F.pandas_udf("double")
    def score(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        predict = load(model, device)
        for a, b in parts:
            pairs = list(zip(a.fillna(""), b.fillna("")))
            out = []
            for at in range(0, len(pairs), batch):
                s = np.asarray(predict(pairs[at : at + batch]), dtype=np.float64)
                out.append(1 / (1 + np.exp(-s)) if len(s) and (s.min() < 0 or s.max() > 1) else s)
            yield pd.Series(np.concatenate(out) if out else [], dtype=float)

    return score


def load_reranker(cfg: Config) -> Reranker:
    """The reranker that ``cross_encoder_backend`` names: 'stub' (letter pairs in common), 'sentence-transformers', or module:function."""
    if cfg.cross_encoder_backend == "stub":
        return bigram_similarity
    if cfg.cross_encoder_backend == "sentence-transformers":
        _sentence_transformers()
        return model_reranker(pair_model, cfg.cross_encoder_model, cfg.embed_device, cfg.batch_size)
    return model_reranker(_function(cfg.cross_encoder_backend), cfg.cross_encoder_model, cfg.embed_device, cfg.batch_size)
