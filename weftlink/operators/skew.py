"""Per-key results when a few keys hold most rows.

Every input split encodes the keys it meets in a dictionary of its own and adds its rows, as they are
read, into dense numpy accumulators by ``bincount``: the counts of a key, and the histogram of its
value lengths in blocks of ``LENGTHS`` slots.  A split gives one array a key and block, however many rows it has,
so a hot key costs no more than a rare one; the arrays of all splits are summed by a
two-level distributed reduction.  Only different values are shuffled by (key, value), which spreads a
hot key over all of its values, and they go through the same accumulators.  No key is collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LENGTHS = 64
#: A split hands its arrays on when its dictionary has so many keys, so its memory is bounded.
KEYS = 1 << 15
#: The block of a key that holds its counts; blocks of its histogram count from 0.
COUNTS = -1
_BLOCKS = "key string, block long, sums array<bigint>"


def clean_key(col: Column) -> Column:
    """Without blanks at both ends, in lower case; NULL becomes ''."""
    return F.lower(F.trim(F.coalesce(col.cast("string"), F.lit(""))))


class Accumulators:
    """Dense arrays of one split, by code of its own dictionary."""

    def __init__(self):
        self.codes: dict[str, int] = {}
        self.counts = np.zeros((0, 2), np.int64)
        self.lengths: dict[tuple[int, int], np.ndarray] = {}

    def add(self, keys: pd.Series, sizes: np.ndarray, column: int, histogram: bool) -> None:
        """One row a key; a size below 0 stands for no value."""
        local, found = pd.factorize(keys)
        own = np.array([self.codes.setdefault(k, len(self.codes)) for k in found], np.int64)
        if len(self.codes) > len(self.counts):
            self.counts = np.vstack([self.counts, np.zeros((max(len(self.codes) - len(self.counts), len(self.counts)), 2), np.int64)])
        codes = own[local]
        self.counts[:, column] += np.bincount(codes, minlength=len(self.counts))
        if not histogram:
            return
        there = sizes >= 0
        codes, sizes = codes[there], sizes[there]
        span = int(sizes.max(initial=0)) // LENGTHS + 1
        slots, dense = np.unique(codes * span + sizes // LENGTHS, return_inverse=True)
        counts = np.bincount(dense * LENGTHS + sizes % LENGTHS, minlength=len(slots) * LENGTHS)
        for slot, part in zip(slots.tolist(), counts.reshape(-1, LENGTHS)):
            at = (slot // span, slot % span)
            self.lengths[at] = self.lengths[at] + part if at in self.lengths else part

    def blocks(self) -> pd.DataFrame:
        names = list(self.codes)
        rows = [(k, COUNTS, self.counts[i]) for i, k in enumerate(names)]
        rows += [(names[code], block, sums) for (code, block), sums in self.lengths.items()]
        return pd.DataFrame(rows, columns=["key", "block", "sums"])


def accumulated(rows: DataFrame, column: int, histogram: bool) -> DataFrame:
    """``rows(key, len)`` -> (key, block, sums): the arrays of every split, counts in ``column``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Accumulators()
        for pdf in batches:
            own.add(pdf["key"], pdf["len"].to_numpy(np.int64), column, histogram)
            if len(own.codes) > KEYS or len(own.lengths) > KEYS:
                yield own.blocks()
                own = Accumulators()
        if own.codes:
            yield own.blocks()

    return rows.mapInPandas(run, _BLOCKS)


def _summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: dict[tuple[str, int], np.ndarray] = {}
    for pdf in batches:
        for key, block, sums in zip(pdf["key"], pdf["block"].tolist(), pdf["sums"]):
            at = (key, block)
            total[at] = total[at] + sums if at in total else np.asarray(sums, np.int64)
        if len(total) > 4 * KEYS:
            yield pd.DataFrame([(k, b, v) for (k, b), v in total.items()], columns=["key", "block", "sums"])
            total.clear()
    if total:
        yield pd.DataFrame([(k, b, v) for (k, b), v in total.items()], columns=["key", "block", "sums"])


def reduced(blocks: DataFrame, fan: int = 16) -> DataFrame:
    """(key, block, pos, n): equal blocks summed, first within ``fan`` groups of splits, then over the groups.

    A task that meets very many keys hands its sums on in parts, so the last sums are taken slot by slot.
    """
    salted = blocks.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(fan)))
    first = salted.repartition("key", "block", "salt").drop("salt").mapInPandas(_summed, _BLOCKS)
    second = first.repartition("key", "block").mapInPandas(_summed, _BLOCKS)
    cells = second.select("key", "block", F.posexplode("sums").alias("pos", "n")).filter("n > 0")
    return cells.groupBy("key", "block", "pos").agg(F.sum("n").alias("n"))


def key_profile(df: DataFrame, key: str, value: str) -> DataFrame:
    """One row a cleaned key: ``key, n_records, n_names, mid_len``.

    ``n_names`` counts different values leaving out NULL and ''; ``mid_len`` is the lower median
    of their lengths in code points over the rows, NULL where the key has no such value.  An
    empty table gives no rows; repeated rows count.  Columns other than the two are not read.
    """
    rows = df.select(clean_key(F.col(key)).alias("key"), F.nullif(F.col(value).cast("string"), F.lit("")).alias("value"))
    records = rows.select("key", F.coalesce(F.length("value"), F.lit(-1)).alias("len"))
    names = rows.filter("value IS NOT NULL").distinct().select("key", F.lit(-1).alias("len"))
    cells = reduced(accumulated(records, 0, True).unionByName(accumulated(names, 1, False)))
    length = F.col("block") * LENGTHS + F.col("pos")
    upto = Window.partitionBy("key").orderBy("len")
    whole = Window.partitionBy("key")
    # a key's cells are its different lengths, not its rows
    mids = (
        cells.filter(F.col("block") != COUNTS)
        .select("key", length.alias("len"), "n")
        .withColumn("upto", F.sum("n").over(upto))
        .withColumn("k", F.sum("n").over(whole))
        .filter("upto >= ceil(k / 2)")
        .groupBy("key")
        .agg(F.min("len").alias("mid_len"))
    )
    counts = cells.filter(F.col("block") == COUNTS).groupBy("key").agg(
        F.sum(F.when(F.col("pos") == 0, F.col("n"))).alias("n_records"), F.coalesce(F.sum(F.when(F.col("pos") == 1, F.col("n"))), F.lit(0)).alias("n_names")
    )
    return counts.join(mids, "key", "left").select("key", "n_records", "n_names", F.col("mid_len").cast("long").alias("mid_len"))
