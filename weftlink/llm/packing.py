"""Packs texts into containers of fixed capacity along a space-filling curve.

Hashed document vectors are projected to three dimensions; their Hilbert key orders the
documents so that similar ones lie together.  The rows are range-partitioned and sorted by
that key, and every range is packed on its own with a bounded number of open containers
(best fit).  A text longer than the capacity is cut into pieces of exactly the capacity; its
rest is an item like any other.  No other text is split.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftlink.llm.tokens import DIMS, TOKENIZER, measured
from weftlink.session import cut

BITS = 10


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert keys of integer points (n, d) with coordinates below 2 ** bits."""
    x = points.astype(np.int64).T.copy()
    d = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(d):
            on = (x[i] & q) > 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = top
    while q > 1:
        t = np.where((x[d - 1] & q) > 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def curve_keys(rows: DataFrame) -> DataFrame:
    """Adds ``curve``: the Hilbert key of (v0, v1, v2), scaled by mean and deviation over all rows."""
    stats = rows.agg(*[f(f"v{d}").alias(f"{n}{d}") for d in range(DIMS) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    mean = [float(stats[f"m{d}"] or 0.0) for d in range(DIMS)]
    wide = [2.5 * float(stats[f"s{d}"] or 0.0) or 1.0 for d in range(DIMS)]

    @F.pandas_udf("bigint")
    def key(v0: pd.Series, v1: pd.Series, v2: pd.Series) -> pd.Series:
        at = (np.stack([v0, v1, v2], axis=1) - mean) / wide
        return pd.Series(hilbert(np.clip((at + 1) / 2 * (1 << BITS), 0, (1 << BITS) - 1)))

    return rows.withColumn("curve", key("v0", "v1", "v2"))


class Containers:
    """Containers of one capacity that are filled in order by best fit.

    With ``open_most`` open the fullest is closed before another is opened, so nothing grows with the items.
    """

    def __init__(self, capacity: int, open_most: int = 64):
        self.capacity, self.open_most = capacity, open_most
        self.room: list[tuple[int, int]] = []
        self.made = 0

    def put(self, size: int) -> int:
        """The number of the container that the item goes into."""
        at = bisect_left(self.room, (size, -1))
        if at < len(self.room):
            left, number = self.room.pop(at)
        else:
            if len(self.room) >= self.open_most:
                self.room.pop(0)
            left, number = self.capacity, self.made
            self.made += 1
        if left - size > 0:
            insort(self.room, (left - size, number))
        return number


def pack(df: DataFrame, id_col: str, text_col: str, specs: DataFrame, tokenizer: str = TOKENIZER, range_tokens: int = 2_000_000, max_ranges: int = 4096) -> DataFrame:
    """(pack_id, pack_name, doc_id, piece_no, n_pieces, tokens, container_id) for every capacity in ``specs``.

    ``specs(pack_id, pack_name, capacity_tokens)`` is a parameter table of a few rows; rows
    with a NULL or non-positive capacity are left out.  A NULL text has no container; '' is an
    item of size 0.  Rows that repeat an id are items of their own.  An empty table gives no rows.
    A range holds about ``range_tokens`` tokens, so its unfinished containers weigh little; there are at most
    ``max_ranges``, which hold more then.  A range is filled as it is read.
    """
    capacities = [(r["pack_id"], r["pack_name"], int(r["capacity_tokens"])) for r in specs.limit(1001).collect() if (r["capacity_tokens"] or 0) > 0]
    if len(capacities) > 1000:
        raise ValueError("more than 1,000 capacities")
    rows = cut(measured(df, id_col, text_col, tokenizer=tokenizer))
    total = rows.agg(F.sum("tokens").alias("t")).first()["t"] or 0
    parts = min(max_ranges, max(1, math.ceil(total / range_tokens)))
    placed = curve_keys(rows).select("id", "tokens", "curve", F.xxhash64("id").alias("tie"))
    placed = placed.repartitionByRange(parts, "curve", "tie").sortWithinPartitions("curve", "tie", "id")
    id_type = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filled = [Containers(capacity) for *_, capacity in capacities]
        for pdf in batches:
            if not len(pdf):
                continue
            ids, sizes = pdf["id"].tolist(), pdf["tokens"].tolist()
            tag = int(pdf["part"].iloc[0])
            for (pack_id, name, capacity), containers in zip(capacities, filled):
                pieces = [max(1, -(-size // capacity)) for size in sizes]
                out = [(i, k, min(capacity, size - k * capacity)) for i, size in enumerate(sizes) for k in range(pieces[i])]
                yield pd.DataFrame(
                    {
                        "pack_id": pack_id,
                        "pack_name": name,
                        "doc_id": [ids[i] for i, *_ in out],
                        "piece_no": [k for _, k, _ in out],
                        "n_pieces": [pieces[i] for i, *_ in out],
                        "tokens": [s for *_, s in out],
                        "container_id": [f"{tag}-{containers.put(s)}" for *_, s in out],
                    }
                )

    return placed.withColumn("part", F.spark_partition_id()).mapInPandas(
        run, f"pack_id int, pack_name string, doc_id {id_type}, piece_no int, n_pieces int, tokens bigint, container_id string"
    )


def usage(packed: DataFrame, specs: DataFrame) -> DataFrame:
    """(pack_name, n_containers, n_items, tokens, filled): how full the containers are."""
    per = packed.groupBy("pack_name").agg(
        F.countDistinct("container_id").alias("n_containers"), F.count(F.lit(1)).alias("n_items"), F.sum("tokens").alias("tokens")
    )
    return per.join(specs.select("pack_name", "capacity_tokens"), "pack_name").select(
        "pack_name", "n_containers", "n_items", "tokens", (F.col("tokens") / (F.col("n_containers") * F.col("capacity_tokens"))).alias("filled")
    )
