"""Pairs met with the attributes of both their records, in blocks.

Hashes of both ids cut the pairs into blocks, rows by columns.  A block gets its pairs, and every record of its row and of
its column once, as compressed columns: no text and no array of a record is written once a pair.  Blocks are many
enough that none has much more than ``PAIRS`` pairs; a record of very many pairs is spread over all blocks of its row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pairs of a block, about.
PAIRS = 600_000
#: Rows that are packed at once, and pairs that are worked on at once.
_PACKED = 1_000_000
_AT_ONCE = 10_000

#: Gives the columns of some pairs from (the pairs, places of their records in both tables).
Work = Callable[[pa.Table, np.ndarray, np.ndarray], dict[str, pa.Array]]


def _packed(rows: DataFrame, key: Column) -> DataFrame:
    """(k, blob): the rows of each key, as far as they are in one part, as a compressed Arrow stream."""

    def flush(some: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(some)
        k = t["k"].to_numpy()
        order = np.argsort(k, kind="stable")
        keys, starts = np.unique(k[order], return_index=True)
        t = t.drop_columns(["k"]).take(pa.array(order)).combine_chunks()
        for key, low, high in zip(keys, starts, [*starts[1:], len(k)]):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_table(t.slice(low, high - low))
            yield pa.record_batch([pa.array([key], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["k", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, n = [], 0
        for b in batches:
            some.append(b)
            n += b.num_rows
            if n >= _PACKED:
                yield from flush(some)
                some, n = [], 0
        if n:
            yield from flush(some)

    return rows.withColumn("k", key.cast("int")).mapInArrow(run, "k int, blob binary")


def _unpacked(blobs: list[bytes]) -> pa.Table | None:
    return pa.concat_tables([pa.ipc.open_stream(b).read_all() for b in blobs]).combine_chunks() if blobs else None


def _found(ids: pa.ChunkedArray, at: np.ndarray, records: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(which of ``at``, place of a record) for every record of each id; ids that no record has are left out."""
    known = pc.unique(records["entity_id"])
    number = pc.index_in(records["entity_id"], value_set=known).to_numpy()
    order = np.argsort(number, kind="stable")
    counts = np.bincount(number, minlength=len(known))
    starts = np.cumsum(counts) - counts
    wanted = pc.fill_null(pc.index_in(ids, value_set=known), -1).to_numpy()[at]
    there = np.flatnonzero(wanted >= 0)
    times = counts[wanted[there]]
    nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    return np.repeat(there, times), order[np.repeat(starts[wanted[there]], times) + nth]


def met(pairs: DataFrame, records: DataFrame, begin: Callable[[pa.Table, pa.Table], Work], schema: str, best: str | None = None) -> DataFrame:
    """``pairs(s1_id, cand_id, ...)`` of which both records are there, with the columns of ``schema``.

    ``begin`` gets both record tables of a block, and what it returns gets pairs of it, a few at a time.  Of pairs that
    are repeated the one with the largest ``best`` counts.  Where several records have one id, a pair meets them all.
    """
    own = lambda c: F.col(c).startswith("S1")
    n, ours, theirs = pairs.agg(F.count(F.lit(1)), F.coalesce(F.min(own("s1_id")), F.lit(False)), F.coalesce(F.max(own("cand_id")), F.lit(True))).first()
    side = max(1, min(4, int((n / 20_000) ** 0.5)), int(np.ceil((n / PAIRS) ** 0.5)))
    part = lambda c: F.pmod(F.xxhash64(c), F.lit(side))
    all_of = F.explode(F.sequence(F.lit(0), F.lit(side - 1)))
    kept = [f.name for f in pairs.schema.fields if f.name not in ("s1_id", "cand_id")]
    fields = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in pairs.schema.fields])
    a = _packed(records.filter(own("entity_id")) if ours else records, part("entity_id")).select(F.col("k").alias("row"), all_of.alias("col"), F.lit(1).alias("role"), "blob")
    b = _packed(records if theirs else records.filter(~own("entity_id")), part("entity_id")).select(all_of.alias("row"), F.col("k").alias("col"), F.lit(2).alias("role"), "blob")
    mine = _packed(pairs, part("s1_id") * side + part("cand_id")).select(F.lit(0).alias("role"), F.col("k").alias("block"), "blob")
    block = (F.col("row") * side + F.col("col")).alias("block")
    every = mine.unionByName(a.select("role", block, "blob")).unionByName(b.select("role", block, "blob"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: dict[int, tuple[list, list, list]] = {}
        for batch in batches:
            for role, k, blob in zip(*(c.to_pylist() for c in batch.columns)):
                blobs.setdefault(k, ([], [], []))[role].append(blob)
        for k in sorted(blobs):
            p, a, b = (_unpacked(x) for x in blobs.pop(k))
            if p is None or a is None or b is None:
                continue
            at, ia = _found(p["s1_id"], np.arange(p.num_rows), a)
            again, ib = _found(p["cand_id"], at, b)
            at, ia = at[again], ia[again]
            by = [p[best].to_numpy()[at]] if best else []
            order = np.lexsort((*by, ib, ia))
            at, ia, ib = at[order], ia[order], ib[order]
            if best and len(at):
                last = np.append((ia[1:] != ia[:-1]) | (ib[1:] != ib[:-1]), True)
                at, ia, ib = at[last], ia[last], ib[last]
            work = begin(a, b)
            for low in range(0, len(at), _AT_ONCE):
                some = slice(low, low + _AT_ONCE)
                t = p.take(pa.array(at[some]))
                out = {c: t[c] for c in ("s1_id", "cand_id", *kept)} | work(t, ia[some], ib[some])
                yield from pa.table(out).to_batches()

    return every.select("role", "block", "blob").repartitionById(side * side, F.col("block")).mapInArrow(run, f"{fields}, {schema}")
