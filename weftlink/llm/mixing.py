"""Mixes sources to target shares of tokens by entropy balancing.

Among all document rates between 0 and the source's repeat cap, the one closest in entropy
to "every document once" that meets the token targets is rate = min(cap, exp(lambda * tokens / scale)),
with one multiplier a mix and source.  The multipliers solve a convex dual; each
Newton step is one distributed aggregation over all (source, tokens) classes.  Rates are
rounded to copies so that the expected tokens stay as solved.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftlink.llm.tokens import TOKENIZER, measured
from weftlink.session import cut

_MOST_TARGETS = 10_000


def _classes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source", "tokens").agg(F.count(F.lit(1)).alias("n"))


def solve(classes: DataFrame, targets: DataFrame, steps: int = 40, tolerance: float = 1e-9) -> list[dict]:
    """The multiplier of each target row: mix_id, source, cap, want, size, scale, lam, reachable.

    A target beyond cap x size has no dual solution: its rate is the cap for every document
    (lam = inf).  A target of 0, or a source without tokens, gives lam = -inf.
    """
    spark = classes.sparkSession
    sizes = classes.groupBy("source").agg(F.sum(F.col("n") * F.col("tokens")).alias("size"), F.sum("n").alias("docs"), F.sum(F.col("n") * F.col("tokens") * F.col("tokens")).alias("sq"))
    asked = targets.select("mix_id", "source", F.col("target_share").cast("double").alias("share"), F.col("max_repeats").cast("long").alias("cap"))
    total = classes.agg(F.sum(F.col("n") * F.col("tokens")).alias("t")).first()["t"] or 0
    duals = []
    for r in asked.join(sizes, "source", "left").limit(_MOST_TARGETS + 1).collect():
        size, cap, share = r["size"] or 0, max(0, r["cap"] or 0), r["share"] or 0.0
        duals.append({"mix_id": r["mix_id"], "source": r["source"], "cap": cap, "share": share, "want": share * total, "size": size})
        d = duals[-1]
        # the size-weighted mean of the lengths: a multiplier of 1 then means a factor of e
        d["scale"] = (r["sq"] / size) if size else 1.0
        d["reachable"] = d["want"] <= cap * size
        if not d["reachable"]:
            d["lam"] = math.inf
        elif d["want"] <= 0 or size == 0 or cap == 0:
            d["lam"] = -math.inf
        else:
            d["lam"] = math.log(min(d["want"] / size, cap))
        d |= {"low": -math.inf, "high": math.inf, "done": math.isinf(d["lam"])}
    if len(duals) > _MOST_TARGETS:
        raise ValueError(f"more than {_MOST_TARGETS} target rows")
    for _ in range(steps):
        live = [(i, d["source"], float(d["cap"]), float(d["scale"]), float(d["lam"])) for i, d in enumerate(duals) if not d["done"]]
        if not live:
            break
        at = spark.createDataFrame(live, "i int, source string, cap double, scale double, lam double")
        power = F.exp(F.col("lam") * F.col("tokens") / F.col("scale"))
        mass = F.col("n") * F.col("tokens")
        sums = (
            classes.join(F.broadcast(at), "source")
            .groupBy("i")
            .agg(
                F.sum(mass * F.least(power, F.col("cap"))).alias("g"),
                F.sum(F.when(power < F.col("cap"), mass * power * F.col("tokens") / F.col("scale")).otherwise(0.0)).alias("h"),
            )
        )
        for r in sums.collect():
            d = duals[r["i"]]
            miss = r["g"] - d["want"]
            if abs(miss) <= tolerance * max(1.0, d["want"]):
                d["done"] = True
                continue
            d["low" if miss < 0 else "high"] = d["lam"]
            step = d["lam"] - miss / r["h"] if r["h"] > 0 else math.nan
            if not d["low"] < step < d["high"]:  # outside the bracket or no slope
                ends = (d["low"], d["high"])
                step = sum(ends) / 2 if all(map(math.isfinite, ends)) else d["lam"] + (2.0 if miss < 0 else -2.0)
            d["done"] = step == d["lam"]
            d["lam"] = step
    return duals


def _rates(tokens: np.ndarray, dual: dict) -> np.ndarray:
    if math.isinf(dual["lam"]):
        return np.full(len(tokens), float(dual["cap"]) if dual["lam"] > 0 else 0.0)
    return np.minimum(dual["cap"], np.exp(np.minimum(700.0, dual["lam"] * tokens / dual["scale"])))


def _round(rows: DataFrame, duals: list[dict]) -> DataFrame:
    """Rates to whole copies: long documents first, each split hands the tokens it is short of to its next document."""
    shared = rows.sparkSession.sparkContext.broadcast(duals)
    id_type = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carried: dict[tuple, float] = {}
        for pdf in batches:
            for source, part in pdf.groupby("source"):
                part = part.sort_values("tokens", ascending=False, kind="stable")
                tokens = part["tokens"].to_numpy(np.int64)
                for dual in shared.value:
                    if dual["source"] != source:
                        continue
                    rate = _rates(tokens, dual)
                    short = carried.get((dual["mix_id"], source), 0.0)
                    copies = np.zeros(len(part), np.int64)
                    for i, (t, r) in enumerate(zip(tokens.tolist(), rate.tolist())):
                        low = math.floor(r)
                        if r > low:
                            low += (short + (r - low) * t) * 2 >= t if t else r - low >= 0.5
                        copies[i] = low
                        short += (r - low) * t
                    carried[dual["mix_id"], source] = short
                    out = pd.DataFrame({"mix_id": dual["mix_id"], "doc_id": part["id"], "source": source, "tokens": tokens, "rate": rate, "copies": copies})
                    yield out[out["copies"] > 0]

    return rows.filter("source IS NOT NULL").mapInPandas(
        run, f"mix_id int, doc_id {id_type}, source string, tokens bigint, rate double, copies bigint"
    )


def mix(df: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", tokenizer: str = TOKENIZER) -> tuple[DataFrame, DataFrame]:
    """(copies, shares).

    copies(mix_id, doc_id, source, tokens, rate, copies): the chosen repeats, rows with 0 copies
    left out.  shares(mix_id, source, target_share, max_repeats, reachable, size_tokens,
    mixed_tokens, actual_share, solved_tokens).  A mix is as large as all texts together.
    NULL texts take no part; a NULL source belongs to no target; an empty table reaches no
    positive share.
    """
    spark = df.sparkSession
    rows = cut(measured(df.select(df[id_col].alias("id"), df[source_col].alias("source"), df[text_col].alias("text")), "id", "text", ("source",), tokenizer, vectors=False))
    classes = cut(_classes(rows))
    duals = solve(classes, targets)
    table = spark.createDataFrame(
        [(d["mix_id"], d["source"], float(d["share"]), d["cap"], d["reachable"], int(d["size"]), float(d["scale"]), float(d["lam"]), float(d["want"])) for d in duals],
        "mix_id int, source string, target_share double, max_repeats long, reachable boolean, size_tokens long, scale double, lam double, want double",
    )
    copies = _round(rows, duals)
    reached = copies.groupBy("mix_id", "source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("mixed_tokens"))
    joined = table.join(reached, ["mix_id", "source"], "left").withColumn("mixed_tokens", F.coalesce("mixed_tokens", F.lit(0)))
    sums = joined.groupBy("mix_id").agg(F.sum("mixed_tokens").alias("all_tokens"))
    shares = joined.join(sums, "mix_id").select(
        "mix_id", "source", "target_share", "max_repeats", "reachable", "size_tokens", "mixed_tokens",
        F.when(F.col("all_tokens") > 0, F.col("mixed_tokens") / F.col("all_tokens")).otherwise(0.0).alias("actual_share"),
        F.least(F.col("want"), F.col("max_repeats") * F.col("size_tokens").cast("double")).alias("solved_tokens"),
    )
    return copies, shares
