"""String similarities on 0..1 that expressions lack, as Arrow-batched functions.

ratio is twice the longest common subsequence over both lengths, computed bit-parallel.  The functions of two
texts say what is worked out; ``scores`` works it out for whole batches of pairs, a letter of all of them at once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence: one machine word operation a letter of ``b``."""
    if not a or not b:
        return 0
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | (1 << i)
    mask = (1 << len(a)) - 1
    row = mask
    for c in b:
        hit = row & where.get(c, 0)
        row = ((row + hit) | (row - hit)) & mask
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    return 1.0 if not a and not b else 2 * _common(a, b) / (len(a) + len(b))


def token_sort(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    """1 if one token set holds the other; else the best of shared against whole sets."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = sorted(x & y)
    if both and (x <= y or y <= x):
        return 1.0
    shared = " ".join(both)
    left = " ".join(both + sorted(x - y))
    right = " ".join(both + sorted(y - x))
    best = ratio(left, right)
    return max(best, ratio(shared, left), ratio(shared, right)) if both else best


def _windows(short: str, long: str) -> float:
    n = len(short)
    best = 0.0
    for end in range(1, len(long) + n):
        part = long[max(0, end - n) : end]
        best = max(best, ratio(short, part))
        if best == 1.0:
            break
    return best


def partial(a: str, b: str) -> float:
    """The best ratio of the shorter against any window of the longer, cut windows at both ends included."""
    if not a or not b:
        return 1.0 if a == b else 0.0
    if len(a) == len(b):
        return max(_windows(a, b), _windows(b, a))
    return _windows(*sorted((a, b), key=len))


#: Pairs whose letters are looked up at once, small enough for a processor's cache.
_AT_ONCE = 4096
_WORD = 64


def _letters(*sides: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
    """(numbers of all letters, start of each text and the end) of each side, and how many letters there are."""
    whole = np.frombuffer("".join(t for side in sides for t in side).encode("utf-32-le", "surrogatepass"), "<u4")
    if whole.max(initial=0) < 4096:
        known = np.flatnonzero(np.bincount(whole))
        table = np.zeros(4096, np.int64)
        table[known] = np.arange(len(known))
        number = table[whole]
    else:
        known, number = np.unique(whole, return_inverse=True)
    out, at = [], 0
    for side in sides:
        starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, side), np.int64, len(side)))])
        out.append((number[at : at + starts[-1]], starts))
        at += starts[-1]
    return out, len(known)


def _masks(letters: np.ndarray, start: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
    """For each text and letter the places where it stands, as bits; flat, ``width`` letters a text."""
    out = np.zeros(len(size) * width, np.uint64)
    base = np.arange(len(size)) * width
    for i in range(int(size.max(initial=0))):
        on = np.flatnonzero(size > i)
        out[base[on] + letters[start[on] + i]] |= np.uint64(1 << i)
    return out


def _run(masks: np.ndarray, base: np.ndarray, bits: np.ndarray, letters: np.ndarray, start: np.ndarray, size: np.ndarray, step: int = 1, seen=None) -> np.ndarray:
    """Common subsequences of pieces (``size`` letters from ``start``, by ``step``) with the texts whose bits are at ``base``.

    ``seen(i, places, common)`` is told what is common after every letter.
    """
    order = np.argsort(-size, kind="stable")
    base, start, sizes = base[order], start[order], size[order]
    full = np.where(bits >= _WORD, np.uint64(2**64 - 1), (np.uint64(1) << np.minimum(bits, _WORD - 1).astype(np.uint64)) - np.uint64(1))[order]
    row = full.copy()
    active = len(row) - np.searchsorted(sizes[::-1], np.arange(int(size.max(initial=0))), side="right")
    for i, n in enumerate(active):
        r = row[:n]
        hit = r & masks[base[:n] + letters[start[:n] + i * step]]
        # letters above a text's own bits are carried away and never come back
        row[:n] = (r + hit) | (r - hit)
        if seen is not None:
            seen(i, order[:n], bits[order[:n]] - np.bitwise_count(row[:n] & full[:n]))
    out = np.empty(len(row), np.int64)
    out[order] = bits[order] - np.bitwise_count(row & full)
    return out


def _common_of(a: list[str], b: list[str]) -> np.ndarray:
    """``_common`` of every pair of texts."""
    short, long = [x if len(x) <= len(y) else y for x, y in zip(a, b)], [y if len(x) <= len(y) else x for x, y in zip(a, b)]
    out = np.zeros(len(a), np.int64)
    for low in range(0, len(a), _AT_ONCE):
        x, y = short[low : low + _AT_ONCE], long[low : low + _AT_ONCE]
        ((lx, sx), (ly, sy)), width = _letters(x, y)
        size = np.diff(sx)
        fits = np.flatnonzero((size > 0) & (size <= _WORD))
        if len(fits):
            masks = _masks(lx, sx[fits], size[fits], width)
            out[low + fits] = _run(masks, np.arange(len(fits)) * width, size[fits], ly, sy[fits], np.diff(sy)[fits])
        for i in np.flatnonzero(size > _WORD):
            out[low + i] = _common(x[i], y[i])
    return out


def _windows_of(short: list[str], long: list[str]) -> np.ndarray:
    """``_windows`` of every pair of texts, none of them empty and no ``short`` longer than its ``long``."""
    out = np.zeros(len(short))
    for low in range(0, len(short), _AT_ONCE):
        x, y = short[low : low + _AT_ONCE], long[low : low + _AT_ONCE]
        ((lx, sx), (ly, sy)), width = _letters(x, y)
        n, m = np.diff(sx), np.diff(sy)
        fits = np.flatnonzero(n <= _WORD)
        best = np.zeros(len(x))
        if len(fits):
            bits, first = n[fits], sy[fits]
            masks = _masks(lx, sx[fits], bits, width)
            base = np.arange(len(fits)) * width
            most = np.zeros(len(fits))

            def seen(i: int, at: np.ndarray, common: np.ndarray) -> None:
                most[at] = np.maximum(most[at], 2 * common / (bits[at] + i + 1))

            # windows cut at the start, in one pass over the first letters
            _run(masks, base, bits, ly, first, bits, seen=seen)
            # whole windows that begin later
            later = m[fits] - bits
            which = np.repeat(np.arange(len(fits)), later)
            begin = np.arange(len(which)) - np.repeat(np.cumsum(later) - later, later) + 1
            for at in range(0, len(which), 16 * _AT_ONCE):
                w, s = which[at : at + 16 * _AT_ONCE], begin[at : at + 16 * _AT_ONCE]
                common = _run(masks, base[w], bits[w], ly, first[w] + s, bits[w])
                np.maximum.at(most, w, 2 * common / (bits[w] + bits[w]))
            # windows cut at the end: both texts from their ends
            back = np.concatenate([lx[s : s + k][::-1] for s, k in zip(sx[fits], bits)])
            masks = _masks(back, np.cumsum(bits) - bits, bits, width)
            _run(masks, base, bits, ly, sy[1:][fits] - 1, bits, step=-1, seen=seen)
            best[fits] = most
        for i in np.flatnonzero(n > _WORD):
            best[i] = _windows(x[i], y[i])
        out[low : low + _AT_ONCE] = best
    return out


def _ratios(common: np.ndarray, a: list[str], b: list[str]) -> np.ndarray:
    total = np.fromiter(map(len, a), np.int64, len(a)) + np.fromiter(map(len, b), np.int64, len(b))
    return np.where(total > 0, 2 * common / np.maximum(total, 1), 1.0)


class _Tokens:
    """(sorted tokens, token set, the set in order, the set in order as text) of texts, each split once."""

    def __init__(self):
        self.kept: dict[str, tuple[str, set[str], list[str], str]] = {}

    def __call__(self, text: str) -> tuple[str, set[str], list[str], str]:
        if text not in self.kept:
            words = sorted(text.split())
            known = set(words)
            once = words if len(known) == len(words) else sorted(known)
            self.kept[text] = " ".join(words), known, once, " ".join(once)
        return self.kept[text]


def _token_sets(a: list[str], b: list[str], of: _Tokens) -> np.ndarray:
    """``token_set`` of every pair of texts."""
    out = np.zeros(len(a))
    at, left, right, fixed = [], [], [], []
    for i, (s, t) in enumerate(zip(a, b)):
        _, x, p, whole = of(s)
        _, y, q, other = of(t)
        if x.isdisjoint(y):
            if not x or not y:
                continue
            fixed.append(0)
        else:
            own, more = [w for w in p if w not in y], [w for w in q if w not in x]
            if not own or not more:
                out[i] = 1.0
                continue
            rest, extra = " ".join(own), " ".join(more)
            # the shared tokens and a blank stand before the others
            fixed.append(len(whole) - len(rest))
            whole, other = rest, extra
        at.append(i)
        left.append(whole)
        right.append(other)
    if at:
        fixed = np.array(fixed)
        shared = np.maximum(fixed - 1, 0)
        nl, nr = (np.fromiter(map(len, side), np.int64, len(at)) + fixed for side in (left, right))
        best = 2 * (_common_of(left, right) + fixed) / (nl + nr)
        # the shared tokens begin both texts, so they are all in common with each
        best = np.where(shared > 0, np.maximum(best, np.maximum(2 * shared / (shared + nl), 2 * shared / (shared + nr))), best)
        out[at] = best
    return out


def scores(a: list[str], b: list[str], addr_a: list[str], addr_b: list[str]) -> dict[str, np.ndarray]:
    """``token_set``, ``token_sort`` and ``partial`` of pairs of names, and ``token_set`` of their addresses; a pair of texts is compared once."""
    names: dict[tuple[str, str], int] = {}
    which = np.fromiter((names.setdefault(p, len(names)) for p in zip(a, b)), np.int64, len(a))
    addresses: dict[tuple[str, str], int] = {}
    place = np.fromiter((addresses.setdefault(p, len(addresses)) for p in zip(addr_a, addr_b)), np.int64, len(a))
    x, y = [p[0] for p in names], [p[1] for p in names]
    of = _Tokens()
    sets = np.where([s == t != "" for s, t in names], 1.0, _token_sets(x, y, of))
    sx, sy = [of(t)[0] for t in x], [of(t)[0] for t in y]
    sort = _ratios(_common_of(sx, sy), sx, sy)
    part = np.array([1.0 if s == t else 0.0 for s, t in names])
    at = [i for i, (s, t) in enumerate(names) if s and t and s != t]
    if at:
        short, long = [min(x[i], y[i], key=len) for i in at], [x[i] if min(x[i], y[i], key=len) is y[i] else y[i] for i in at]
        part[at] = _windows_of(short, long)
        # of texts of one length each is the window's text once
        same = [k for k, (s, t) in enumerate(zip(short, long)) if len(s) == len(t)]
        if same:
            back = _windows_of([long[k] for k in same], [short[k] for k in same])
            places = np.array(at)[same]
            part[places] = np.maximum(part[places], back)
    every = _token_sets([p[0] for p in addresses], [p[1] for p in addresses], of)
    return {"token_set": sets[which], "token_sort": sort[which], "partial": part[which], "addr_token_set": every[place]}


_SCORES = StructType([StructField(n, DoubleType()) for n in ("token_set", "token_sort", "partial", "addr_token_set")])


@F.pandas_udf(_SCORES)
def scores_of(a: pd.Series, b: pd.Series, addr_a: pd.Series, addr_b: pd.Series) -> pd.DataFrame:
    """All similarities of two names and two addresses in one pass."""
    return pd.DataFrame(scores(*[s.fillna("").tolist() for s in (a, b, addr_a, addr_b)]), columns=_SCORES.names)
