"""Character n-gram TF-IDF, and top-k similarity joins over inverted indexes.

A record's weights are two sorted arrays, gram codes and weights.  ``top_k`` sends blocks of queries
and blocks of targets of one country to one task, which indexes its targets by gram and adds up
the products of whole batches of queries in flat arrays; pairs that share no gram cost nothing,
and no pair of records is shuffled before its similarity is known and it is one of the best of its block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from weftlink.operators.blocks import best_in_blocks, ranked

#: Gram codes have so many bits, which leaves room for the number of a pair in a batch.
CODE_BITS = 48
#: Products that are added up at once.
_AT_ONCE = 2_000_000


def char_grams(df: DataFrame, id_cols: list[str], text_col: str, low: int, high: int, within_words: bool = True) -> DataFrame:
    """(ids, gram, tf).  Within words: each word padded by one blank a side; a padded word no longer
    than n is one gram, once, and larger n are skipped.  Otherwise all windows of the whole text."""
    if within_words:
        words = df.select(*id_cols, F.explode(F.split(text_col, r"\s+")).alias("w")).filter("w <> ''").select(*id_cols, F.concat(F.lit(" "), "w", F.lit(" ")).alias("w"))
        sizes = f"sequence({low}, least({high}, greatest({low}, length(w))))"
        pieces = f"flatten(transform({sizes}, n -> transform(sequence(1, greatest(length(w) - n, 0) + 1), i -> substring(w, i, n))))"
    else:
        words = df.select(*id_cols, F.col(text_col).alias("w")).filter(f"length(w) >= {low}")
        sizes = f"sequence({low}, least({high}, length(w)))"
        pieces = f"flatten(transform({sizes}, n -> transform(sequence(1, length(w) - n + 1), i -> substring(w, i, n))))"
    return words.select(*id_cols, F.explode(F.expr(pieces)).alias("gram")).groupBy(*id_cols, "gram").agg(F.count(F.lit(1)).alias("tf"))


def gram_statistics(grams: DataFrame, n_records: int, min_df: int = 2, max_df: int = 12_000, max_features: int = 400_000) -> DataFrame:
    """(gram, df, total, idf) of the grams kept: by document frequency, then the most frequent ones (ties by gram)."""
    return kept_grams(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total")), n_records, min_df, max_df, max_features)


def kept_grams(counted: DataFrame, n_records: int, min_df: int = 2, max_df: int = 12_000, max_features: int = 400_000) -> DataFrame:
    """``gram_statistics`` from (gram, df, total) of all grams."""
    stats = counted.filter(F.col("df").between(min_df, max_df))
    # the limit is the vocabulary size, a feature of the index
    kept = stats.orderBy(F.col("total").desc(), "gram").limit(max_features)
    return kept.withColumn("idf", F.log((1 + F.lit(n_records)) / (1 + F.col("df"))) + 1)


def gram_code(gram: Column) -> Column:
    return F.xxhash64(gram).bitwiseAND(F.lit((1 << CODE_BITS) - 1))


def gram_weights(grams: DataFrame, statistics: DataFrame, id_cols: list[str]) -> DataFrame:
    """(ids, gram, x): tf x idf, not yet of unit length."""
    return grams.join(statistics.select("gram", "idf"), "gram").select(*id_cols, "gram", (F.col("tf") * F.col("idf")).alias("x"))


def weights(grams: DataFrame, statistics: DataFrame, id_cols: list[str]) -> DataFrame:
    """(ids, gram, w): tf x idf, unit length a record."""
    raw = gram_weights(grams, statistics, id_cols)
    length = raw.groupBy("entity_id").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("l"))
    return raw.join(length, "entity_id").select(*id_cols, "gram", (F.col("x") / F.col("l")).alias("w"))


def text_grams(records: DataFrame, text_col: str, low: int, high: int, within_words: bool = True, n_records: int | None = None, **caps: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """(grams, statistics, ids) of one text column over all records."""
    ids = ["entity_id", "source", "country_key"]
    grams = char_grams(records, ids, text_col, low, high, within_words)
    n = records.count() if n_records is None else n_records
    return grams, gram_statistics(grams, n, **caps), ids


def text_weights(records: DataFrame, text_col: str, low: int, high: int, within_words: bool = True, **caps: int) -> DataFrame:
    """(entity_id, source, country_key, gram, w) of one text column over all records."""
    return weights(*text_grams(records, text_col, low, high, within_words, **caps))


def _pieces(text: str, low: int, high: int, within_words: bool) -> list[str]:
    """The grams of ``char_grams``, of one text."""
    words = [f" {w} " for w in text.split()] if within_words else [text] if len(text) >= low else []
    return [w[i : i + n] for w in words for n in range(low, min(high, max(low, len(w))) + 1) for i in range(max(len(w) - n, 0) + 1)]


def _code(gram: str) -> int:
    """One number a gram: its bytes, or where these are too many a hash below 0."""
    if gram.isascii() and len(gram) <= 7 and "\0" not in gram:
        return int.from_bytes(gram.encode(), "little")
    return -1 - (xxhash.xxh64_intdigest(gram) >> 2)


def _occurrences(texts: list[str], low: int, high: int, within_words: bool) -> tuple[np.ndarray, np.ndarray, dict[int, str]]:
    """(row, code) of every gram of ``_pieces`` of every text, and the grams whose codes are hashes."""
    if within_words:
        # every word between two blanks of its own
        texts = [f" {t} ".replace(" ", "  ")[1:-1] if t else "" for t in (" ".join(t.split()) for t in texts)]
    whole = "".join(texts)
    if not whole.isascii() or "\0" in whole or high > 7:
        hashed: dict[int, str] = {}
        rows, codes = [], []
        for i, t in enumerate(texts):
            for p in _pieces(t, low, high, within_words):
                rows.append(i)
                codes.append(c := _code(p))
                if c < 0:
                    hashed[c] = p
        return np.array(rows, np.int64), np.array(codes, np.int64), hashed
    letters = np.frombuffer(whole.encode(), np.uint8).astype(np.int64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    row = np.repeat(np.arange(len(texts)), sizes)
    if within_words:
        blank = np.append(letters == 32, True)
        start = np.flatnonzero(blank[:-1] & ~blank[1:])
        lens = np.flatnonzero(blank[1:-1] & ~blank[:-2]) + 2 - start if len(letters) else start
    else:
        lens = sizes[sizes >= low]
        start = (np.cumsum(sizes) - sizes)[sizes >= low]
    left = np.zeros(len(letters), np.int64)
    inside = np.repeat(start, lens) + (at := np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens))
    left[inside] = np.repeat(lens, lens) - at
    out_rows, out_codes = [], []
    code = np.zeros(len(letters), np.int64)
    for n in range(1, high + 1):
        code[: max(0, len(letters) - n + 1)] |= letters[n - 1 :] << (8 * (n - 1))
        # a word shorter than all grams is one itself
        here = np.flatnonzero(left >= n) if n >= low else start[lens == n]
        out_rows.append(row[here])
        out_codes.append(code[here])
    return np.concatenate(out_rows), np.concatenate(out_codes), {}


def _counted(texts: DataFrame, text_col: str, low: int, high: int, within_words: bool) -> DataFrame:
    """(gram, df, total) of each part of the records, every record counted as one."""

    def summed(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return codes, *(np.bincount(at, np.concatenate([p[i] for p in parts]), len(codes)).astype(np.int64) for i in (1, 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, names = [], {}
        for b in batches:
            rows, codes, hashed = _occurrences(pc.fill_null(b[text_col], "").to_pylist(), low, high, within_words)
            names |= hashed
            known, at = np.unique(codes, return_inverse=True)
            once = np.unique(rows * max(1, len(known)) + at) % max(1, len(known))
            parts.append((known, np.bincount(once, minlength=len(known)), np.bincount(at, minlength=len(known))))
            if sum(len(p[0]) for p in parts) > 2_000_000:
                parts = [summed(parts)]
        if not parts:
            return
        codes, df, total = summed(parts)
        for i in range(0, len(codes), 100_000):
            some = codes[i : i + 100_000]
            # names of codes above 0 are their bytes
            text = [names[c] if c < 0 else x.decode() for c, x in zip(some.tolist(), some.astype("<i8").view("S8").tolist())]
            yield pa.record_batch([pa.array(text, pa.string()), pa.array(df[i : i + 100_000]), pa.array(total[i : i + 100_000])], ["gram", "df", "total"])

    return texts.select(text_col).mapInArrow(run, "gram string, df long, total long")


class Vocabulary:
    """The grams of an index with their weights; turns texts into counts of them."""

    def __init__(self, grams: list[str], idf: np.ndarray, low: int, high: int, within_words: bool):
        hashes = np.array([xxhash.xxh64_intdigest(g, 42) & ((1 << CODE_BITS) - 1) for g in grams], np.int64)
        order = np.argsort(hashes)
        self.hashes, self.idf = hashes[order], np.asarray(idf, np.float64)[order]
        codes = np.array([_code(grams[i]) for i in order], np.int64)
        self.place = np.argsort(codes).astype(np.int64)
        self.codes = codes[self.place]
        self.kind = low, high, within_words

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start of each text and the end, places of its grams in order, how often each is there)."""
        rows, codes, _ = _occurrences(texts, *self.kind)
        if not len(codes) or not len(self.codes):
            return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.searchsorted(self.codes, codes)
        at[at == len(self.codes)] = 0
        hit = self.codes[at] == codes
        key = rows[hit] * len(self.codes) + self.place[at[hit]]
        key, tf = np.unique(key, return_counts=True)
        row, place = np.divmod(key, len(self.codes))
        return np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(texts)))]), place, tf

    def weights(self, starts: np.ndarray, places: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """tf x idf, unit length a text."""
        x = tf * self.idf[places]
        row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        return x / np.sqrt(np.bincount(row, x * x, len(starts) - 1))[row]


def vocabulary(records: DataFrame, text_col: str, low: int, high: int, within_words: bool = True, **caps: int) -> Vocabulary:
    """The vocabulary of one text column over all records; at most ``max_features`` grams come to the driver.

    Grams are counted part by part, and only the counts are shuffled, unless several records have one id, whose
    grams count together.
    """
    n, ids = records.agg(F.count(F.lit(1)), F.count_distinct("entity_id")).first()
    if n == ids:
        counted = _counted(records, text_col, low, high, within_words).groupBy("gram").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))
        statistics = kept_grams(counted, n, **caps)
    else:
        statistics = text_grams(records, text_col, low, high, within_words, n, **caps)[1]
    known = statistics.select("gram", "idf").toArrow()
    return Vocabulary(known["gram"].to_pylist(), known["idf"].to_numpy(), low, high, within_words)


def text_vectors(records: DataFrame, text_col: str, low: int, high: int, within_words: bool = True, **caps: int) -> DataFrame:
    """(entity_id, source, country_key, grams, w): the same weights as two arrays a record; write them before they are used twice.

    The vocabulary, bounded by ``max_features``, is shared with all workers, so no gram is shuffled again for its weight.
    """
    ids = ["entity_id", "source", "country_key"]
    shared = records.sparkSession.sparkContext.broadcast(vocabulary(records, text_col, low, high, within_words, **caps))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in batches:
            starts, places, tf = known.counts(pc.fill_null(b[text_col], "").to_pylist())
            at = pa.array(starts, pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(x)) for x in (known.hashes[places], known.weights(starts, places, tf))]
            out = pa.record_batch([*[b[c] for c in ids], *lists], [*ids, "grams", "w"])
            yield out.filter(pa.array(np.diff(starts) > 0))

    schema = "entity_id string, source int, country_key string, grams array<bigint>, w array<double>"
    return records.select(*ids, text_col).mapInArrow(run, schema)


def _flat(col: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, number of the row of each) of a list column; NULL lists have none."""
    whole = pa.concat_arrays(col.chunks) if isinstance(col, pa.ChunkedArray) and col.num_chunks else col
    if isinstance(whole, pa.ChunkedArray):
        return np.zeros(0), np.zeros(0, np.int64)
    lengths = pc.fill_null(pc.list_value_length(whole), 0).to_numpy(zero_copy_only=False)
    return whole.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(lengths)), lengths)


class Index:
    """Targets by gram: for every gram the targets that hold it, in order of their ids."""

    def __init__(self, codes: np.ndarray, rows: np.ndarray, w: np.ndarray):
        order = np.argsort(codes, kind="stable")
        self.codes, self.starts, self.counts = np.unique(codes[order], return_index=True, return_counts=True)
        self.rows, self.w = rows[order], w[order]

    def entries(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether the gram is there, its place) of each code."""
        at = np.searchsorted(self.codes, codes)
        at[at == len(self.codes)] = 0
        return self.codes[at] == codes if len(self.codes) else np.zeros(len(codes), bool), at


def _similar(k: int, floor: float):
    def run(q: pa.Table, t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of queries and targets (in the order of their ids), and cosines, of the k best of each source."""
        codes, rows = _flat(t["grams"])
        index = Index(codes, rows, _flat(t["w"])[0])
        source = t["source"].to_numpy()
        qc, qr = _flat(q["grams"])
        qw = _flat(q["w"])[0]
        there, at = index.entries(qc)
        qr, qw, at = qr[there], qw[there], at[there]
        n_t, n_q = len(source), q.num_rows
        size = index.counts[at]
        # queries are taken in batches of a bounded number of products and of cells
        work = np.cumsum(np.bincount(qr, weights=size, minlength=n_q) + n_t)
        batch = (work // _AT_ONCE).astype(np.int64)
        first = np.searchsorted(batch, np.arange(batch[-1] + 2)) if n_q else np.zeros(1, int)
        out = []
        for low, high in zip(first[:-1], first[1:]):
            if low == high:
                continue
            a, b = np.searchsorted(qr, [low, high])
            lens = size[a:b]
            total = int(lens.sum())
            if not total:
                continue
            place = np.arange(total) + np.repeat(index.starts[at[a:b]] - (np.cumsum(lens) - lens), lens)
            cell = index.rows[place] + np.repeat((qr[a:b] - low) * n_t, lens)
            cos = np.bincount(cell, weights=index.w[place] * np.repeat(qw[a:b], lens))
            hit = np.flatnonzero(cos > max(0.0, floor - 1e-6))
            cos = np.round(cos[hit], 6)
            hit, cos = hit[cos >= floor], cos[cos >= floor]
            row, target = hit // n_t, hit % n_t
            best = ranked(row * 4 + source[target], cos, k)
            out.append((row[best] + low, target[best], cos[best]))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))

    return run


def top_k(vectors: DataFrame, k: int, floor: float, within_country: bool = True) -> DataFrame:
    """(s1_id, cand_id, cand_source, cos): for every S1 record its k most similar of each target source.

    ``vectors`` are as of ``text_vectors``.  Cosines are rounded to six places, compared to the floor, and ties go by id.
    """
    return best_in_blocks(vectors, ["grams", "w"], _similar(k, floor), k, within_country)


def text_top_k(records: DataFrame, text_col: str, known: Vocabulary, k: int, floor: float, within_country: bool = True) -> DataFrame:
    """``top_k`` of the vectors of a text column; texts are shuffled, and become arrays in the block where they are met."""
    shared = records.sparkSession.sparkContext.broadcast(known)
    similar = _similar(k, floor)

    def vectors(t: pa.Table) -> pa.Table:
        starts, places, tf = shared.value.counts(t[text_col].fill_null("").to_pylist())
        at = pa.array(starts, pa.int32())
        lists = [pa.ListArray.from_arrays(at, pa.array(x)) for x in (shared.value.hashes[places], shared.value.weights(starts, places, tf))]
        return pa.table([t["source"], *lists], ["source", "grams", "w"])

    return best_in_blocks(records, [text_col], lambda q, t: similar(vectors(q), vectors(t)), k, within_country)


@F.arrow_udf(DoubleType())
def _shared(ga: pa.Array, wa: pa.Array, gb: pa.Array, wb: pa.Array) -> pa.Array:
    out = []
    step = 1 << (62 - CODE_BITS)
    for at in range(0, len(ga), step):
        (ca, ra), (cb, rb) = _flat(ga.slice(at, step)), _flat(gb.slice(at, step))
        n = len(ga.slice(at, step))
        x, y = _flat(wa.slice(at, step))[0], _flat(wb.slice(at, step))[0]
        ka, kb = (ra << CODE_BITS) | ca.astype(np.int64), (rb << CODE_BITS) | cb.astype(np.int64)
        if not len(ka) or not len(kb):
            out.append(np.zeros(n))
            continue
        place = np.minimum(np.searchsorted(ka, kb), len(ka) - 1)
        same = ka[place] == kb
        out.append(np.bincount(rb[same], weights=x[place[same]] * y[same], minlength=n))
    return pa.array(np.concatenate(out) if out else np.zeros(0))


def paired_cosines(pairs: DataFrame, vectors: dict[str, DataFrame]) -> DataFrame:
    """``pairs(s1_id, cand_id, ...)`` with a column for each of ``vectors``: the cosine of both records, 0 where nothing is shared.

    All arrays of a record travel together, so every record is joined twice, however many cosines there are.
    """
    every = None
    for i, v in enumerate(vectors.values()):
        part = v.select("entity_id", F.col("grams").alias(f"g{i}"), F.col("w").alias(f"w{i}"))
        every = part if every is None else every.join(part, "entity_id", "full")
    cols = [c for c in every.columns if c != "entity_id"]
    a = every.select(F.col("entity_id").alias("s1_id"), *[F.col(c).alias(f"__a_{c}") for c in cols])
    b = every.select(F.col("entity_id").alias("cand_id"), *[F.col(c).alias(f"__b_{c}") for c in cols])
    met = pairs.join(a, "s1_id", "left").join(b, "cand_id", "left")
    # rounded here, or a projection that wants one cosine would be evaluated with the arrays of all
    return met.select(
        *[c for c in pairs.columns if c not in vectors],
        *[F.round(_shared(f"__a_g{i}", f"__a_w{i}", f"__b_g{i}", f"__b_w{i}"), 6).alias(name) for i, name in enumerate(vectors)],
    )


def paired_cosine(pairs: DataFrame, vectors: DataFrame, name: str) -> DataFrame:
    return paired_cosines(pairs, {name: vectors})
