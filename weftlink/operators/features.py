"""The 22 features of a pair, in their fixed order."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftlink.functions import fuzzy
from weftlink.functions.text import tokens
from weftlink.operators.pairs import Work, met
from weftlink.operators.tfidf import Vocabulary
from weftlink.sources.records import forms_of

# The features in the order that a fitted model expects.
FEATURES = (
    "name_cos addr_cos rf_name_token_set rf_name_token_sort rf_name_partial rf_addr_token_set first_token_match acronym_match "
    "name_len_ratio postal_both_present postal_equal num_overlap num_any_match country_match cand_is_s3 squish_cos num_exact "
    "addr_containment region_match postal_prefix_match shared_long_token embed_cos"
).split()
_USED = ["country_key", "core_name", "first_token", "acronym", "core_len", "norm_addr", "postal", "nums"]


def attach(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """Pairs with the attributes of both records, prefixed a_ and b_."""
    a = records.select(F.col("entity_id").alias("s1_id"), *[F.col(c).alias(f"a_{c}") for c in _USED])
    b = records.select(F.col("entity_id").alias("cand_id"), *[F.col(c).alias(f"b_{c}") for c in _USED])
    return pairs.join(a, "s1_id").join(b, "cand_id")


def _texts(t: pa.Table, column: str, rows: np.ndarray | slice = slice(None)) -> list[str]:
    """A text column of records, of which the squished name is made here."""
    squished = column == "name_squish"
    some = t["core_name" if squished else column]
    some = (some[rows] if isinstance(rows, slice) else some.take(pa.array(rows))).fill_null("").to_pylist()
    return [x.replace(" ", "") for x in some] if squished else some


def _ranges(starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``rows``, place in the flat lists) of everything in the lists of these rows."""
    lens = starts[rows + 1] - starts[rows]
    at = np.repeat(starts[rows] - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())
    return np.repeat(np.arange(len(rows)), lens), at


class _Cosines:
    """Cosines of one text column for pairs of a block; the targets' grams are counted once, those of the others as they come."""

    def __init__(self, known: Vocabulary, column: str, a: pa.Table, b: pa.Table, step: int = 10_000):
        self.known, self.column, self.a = known, column, a
        parts = [known.counts(_texts(b, column, slice(low, low + step))) for low in range(0, b.num_rows, step)]
        self.starts = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p[0]) for p in parts]))])
        self.places, self.tf = np.concatenate([p[1].astype(np.int32) for p in parts]), np.concatenate([p[2].astype(np.int32) for p in parts])

    def __call__(self, ia: np.ndarray, ib: np.ndarray) -> np.ndarray:
        ours, number = np.unique(ia, return_inverse=True)
        starts, places, tf = self.known.counts(_texts(self.a, self.column, ours))
        x = self.known.weights(starts, places, tf)
        rows, at = _ranges(starts, number)
        key, x = rows * len(self.known.idf) + places[at], x[at]
        theirs, number = np.unique(ib, return_inverse=True)
        _, at = _ranges(self.starts, theirs)
        starts = np.concatenate([[0], np.cumsum(self.starts[theirs + 1] - self.starts[theirs])])
        places = self.places[at]
        y = self.known.weights(starts, places, self.tf[at])
        rows, at = _ranges(starts, number)
        if not len(key) or not len(at):
            return np.zeros(len(ia))
        wanted, y = rows * len(self.known.idf) + places[at], y[at]
        place = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
        same = key[place] == wanted
        # of no products numpy gives whole numbers
        return np.bincount(rows[same], x[place[same]] * y[same], len(ia)).astype(np.float64)


#: The attributes that travel; the others are made of them.
_SENT = ("country_key", "core_name", "norm_addr", "postal")


def text_cosines(pairs: DataFrame, records: DataFrame, indexes: dict[str, tuple[str, Vocabulary]], best: str | None = None, sent: tuple[str, ...] = ()) -> DataFrame:
    """``pairs`` of which both records are there, with a cosine for each of ``indexes`` (text column, vocabulary), 0 where nothing is shared,
    and the columns ``sent`` of both records, prefixed a_ and b_."""
    shared = pairs.sparkSession.sparkContext.broadcast(indexes)

    def begin(a: pa.Table, b: pa.Table) -> Work:
        cosines = {name: _Cosines(known, column, a, b) for name, (column, known) in shared.value.items()}

        def work(_: pa.Table, ia: np.ndarray, ib: np.ndarray) -> dict[str, pa.Array]:
            sides = {f"{s}_{c}": t[c].take(pa.array(i)) for s, t, i in (("a", a, ia), ("b", b, ib)) for c in sent}
            return {name: pa.array(c(ia, ib)) for name, c in cosines.items()} | sides

        return work

    schema = ", ".join([f"{name} double" for name in indexes] + [f"{s}_{c} string" for s in "ab" for c in sent])
    texts = ["core_name" if c == "name_squish" else c for c, _ in indexes.values()]
    return met(pairs, records.select("entity_id", *dict.fromkeys([*sent, *texts])), begin, schema, best)


def attached_with_cosines(pairs: DataFrame, records: DataFrame, indexes: dict[str, tuple[str, Vocabulary]], best: str | None = None) -> DataFrame:
    """``attach``, and a cosine for each of ``indexes``.  Repeated pairs count once, with the largest ``best``."""
    out = text_cosines(pairs, records, indexes, best, _SENT)
    made = {f"{s}_{k}": v for s in "ab" for k, v in forms_of(F.col(f"{s}_core_name"), F.col(f"{s}_norm_addr")).items() if k in _USED}
    return out.withColumns({name: F.round(name, 6) for name in indexes} | made)


def pair_similarities(pairs: DataFrame, records: DataFrame, best: str | None = None) -> DataFrame:
    """``pairs`` of which both records are there, with the similarities of ``fuzzy_features``."""
    names = {"rf_name_token_set": "token_set", "rf_name_token_sort": "token_sort", "rf_name_partial": "partial", "rf_addr_token_set": "addr_token_set"}

    def begin(a: pa.Table, b: pa.Table) -> Work:
        def work(_: pa.Table, ia: np.ndarray, ib: np.ndarray) -> dict[str, pa.Array]:
            found = fuzzy.scores(*[_texts(t, c, i) for c in ("core_name", "norm_addr") for t, i in ((a, ia), (b, ib))])
            return {f: pa.array(found[n]) for f, n in names.items()}

        return work

    return met(pairs, records.select("entity_id", "core_name", "norm_addr"), begin, ", ".join(f"{f} double" for f in names), best)


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("double")


def native_features(attached: DataFrame) -> DataFrame:
    """The features that expressions give; needs name_cos, and takes addr_cos, squish_cos, embed_cos as 0 where absent."""
    for c in ("name_cos", "addr_cos", "squish_cos", "embed_cos"):
        if c not in attached.columns:
            attached = attached.withColumn(c, F.lit(0.0))
    c = F.col
    # what several features use is a column first, or each of them would work it out again
    lists = {f"__{k}{s}": tokens(c(f"{s}_{of}")) for k, of in (("n", "nums"), ("t", "norm_addr")) for s in "ab"}
    lists |= {f"__l{s}": F.filter(tokens(c(f"{s}_core_name")), lambda t: F.length(t) >= 5) for s in "ab"}
    attached = attached.withColumns(lists).withColumns({f"__{k}": F.size(F.array_intersect(f"__{k}a", f"__{k}b")) for k in "nt"})
    na, nb, ta, tb = c("__na"), c("__nb"), c("__ta"), c("__tb")
    both_numbers = (F.size(na) > 0) & (F.size(nb) > 0)
    both_addr = (F.size(ta) > 0) & (F.size(tb) > 0)
    both_postal = (c("a_postal") != "") & (c("b_postal") != "")
    longest = F.greatest("a_core_len", "b_core_len")
    last = lambda of: F.substring_index(of, " ", -1)
    return attached.withColumns(
        {
            "first_token_match": _flag((c("a_first_token") == c("b_first_token")) & (c("a_first_token") != "")),
            "acronym_match": _flag((c("a_acronym") == c("b_acronym")) & (F.length("a_acronym") >= 2)),
            "name_len_ratio": F.when(longest > 0, F.least("a_core_len", "b_core_len") / longest).otherwise(0.0),
            "postal_both_present": _flag(both_postal),
            "postal_equal": _flag(both_postal & (c("a_postal") == c("b_postal"))),
            # tokens are distinct, so the union has those of both less the shared ones
            "num_overlap": F.when(both_numbers, c("__n") / (F.size(na) + F.size(nb) - c("__n"))).otherwise(0.0),
            "num_any_match": _flag(c("__n") > 0),
            "country_match": _flag(c("a_country_key") == c("b_country_key")),
            "cand_is_s3": _flag(c("cand_source") == 3),
            "num_exact": _flag(both_numbers & (F.size(na) == F.size(nb)) & (c("__n") == F.size(na))),
            "addr_containment": F.when(both_addr, c("__t") / F.least(F.size(ta), F.size(tb))).otherwise(0.0),
            "region_match": _flag(both_addr & (last("a_norm_addr") == last("b_norm_addr"))),
            "postal_prefix_match": _flag(both_postal & (F.left("a_postal", F.lit(2)) == F.left("b_postal", F.lit(2)))),
            "shared_long_token": _flag(F.arrays_overlap("__la", "__lb")),
        }
    ).drop(*lists, "__n", "__t")


def fuzzy_features(attached: DataFrame) -> DataFrame:
    scored = attached.withColumn("__fuzzy", fuzzy.scores_of("a_core_name", "b_core_name", "a_norm_addr", "b_norm_addr"))
    names = {"rf_name_token_set": "token_set", "rf_name_token_sort": "token_sort", "rf_name_partial": "partial", "rf_addr_token_set": "addr_token_set"}
    return scored.withColumns({f: F.col(f"__fuzzy.{n}") for f, n in names.items()}).drop("__fuzzy")


def all_features(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """``pairs`` (s1_id, cand_id, cand_source and cosines) with all 22 features."""
    out = fuzzy_features(native_features(attach(pairs, records)))
    kept = [c for c in pairs.columns if c not in FEATURES]
    return out.select(*kept, *[F.col(f).cast("double").alias(f) for f in FEATURES])
