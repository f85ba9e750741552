"""Blocks of queries met with blocks of targets, for top-k joins that compare within a country.

Every query block of a country meets every target block of it in a task of its own, so a hot country
is spread over as many tasks as it needs, and no task holds more than one block of each side.
Targets are sent once a query block; query blocks grow with the square root of a country.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TARGETS = 1 << 16
QUERIES = 1 << 11
_PAIRS = pa.schema([("s1_id", pa.string()), ("cand_id", pa.string()), ("cand_source", pa.int32()), ("cos", pa.float64())])


def ranked(group: np.ndarray, cos: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each group by falling cosine; equal cosines stay in order."""
    order = np.lexsort((-cos, group))
    g = group[order]
    new = np.append(True, g[1:] != g[:-1]) if len(g) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(new, np.arange(len(g)), 0)) if len(g) else np.zeros(0, int)
    return order[np.arange(len(g)) - start < k]


def best_in_blocks(vectors: DataFrame, columns: list[str], similar: Callable, k: int, within_country: bool = True) -> DataFrame:
    """(s1_id, cand_id, cand_source, cos): the k best targets of each source of every S1 record.

    ``vectors`` have entity_id, source, country_key and ``columns``.  ``similar(q, t)`` gets two Arrow tables,
    each in the order of its ids, and returns row numbers of both and cosines: at least the k best of its block.
    """
    country = F.coalesce(F.col("country_key"), F.lit("")) if within_country else F.lit("")
    every = vectors.select(F.col("entity_id").cast("string").alias("entity_id"), F.col("source").cast("int").alias("source"), country.alias("country_key"), *columns)
    counts = every.groupBy("country_key").agg(F.count_if(F.col("source") == 1).alias("n_q"), F.count_if(F.col("source") > 1).alias("n_t")).filter("n_q > 0 AND n_t > 0")
    blocks = counts.select(
        "country_key",
        F.ceil(F.col("n_q") / F.greatest(F.lit(QUERIES), 32 * F.sqrt("n_q"))).cast("int").alias("n_qb"),
        F.ceil(F.col("n_t") / TARGETS).cast("int").alias("n_tb"),
    )
    placed = every.join(blocks, "country_key")
    own = lambda n: F.pmod(F.xxhash64("entity_id"), F.col(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    kept = ["country_key", "entity_id", "source", *columns]
    q = placed.filter("source = 1").select(*kept, own("n_qb").alias("qb"), all_of("n_tb").alias("tb"))
    t = placed.filter("source > 1").select(*kept, own("n_tb").alias("tb"), all_of("n_qb").alias("qb"))
    # two sides of one frame need columns of their own to be grouped together
    t = t.select([F.col(c).alias(f"t_{c}") for c in t.columns])

    def meet(q: pa.Table, t: pa.Table) -> pa.Table:
        if not q.num_rows or not t.num_rows:
            return _PAIRS.empty_table()
        q, t = q.sort_by("entity_id"), t.rename_columns([c[2:] for c in t.column_names]).sort_by("entity_id")
        a, b, cos = similar(q, t)
        return pa.table([q["entity_id"].take(pa.array(a)), t["entity_id"].take(pa.array(b)), pc.cast(t["source"].take(pa.array(b)), pa.int32()), pa.array(cos)], schema=_PAIRS)

    keys = ["country_key", "qb", "tb"]
    found = q.groupBy(*keys).cogroup(t.groupBy(*[f"t_{k}" for k in keys])).applyInArrow(meet, "s1_id string, cand_id string, cand_source int, cos double")
    best = Window.partitionBy("s1_id", "cand_source").orderBy(F.col("cos").desc(), "cand_id")
    return found.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k).drop("r")
