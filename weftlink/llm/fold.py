"""Folding of names and addresses to plain lower-case letters, and edit distances."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np

from weftlink.llm.lookalike import table_of_characters

#: Cyrillic letters in Latin script, and letters that accents do not explain.
LATIN = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "e", "ж": "zh", "з": "z", "и": "i", "й": "y", "к": "k",
    "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "h", "ц": "ts",
    "ч": "ch", "ш": "sh", "щ": "sht", "ъ": "a", "ы": "y", "ь": "", "э": "e", "ю": "yu", "я": "ya", "і": "i", "ѕ": "s", "ј": "j",
    "ß": "ss", "ł": "l", "ø": "o", "đ": "d", "æ": "ae", "œ": "oe", "ı": "i", "ð": "d", "þ": "th",
}
_LATIN = str.maketrans(LATIN)
_CYRILLIC = re.compile("[а-яА-ЯёЁіѕјІЅЈ]")
_TRUE_CYRILLIC = re.compile("[бгджзийлнпфцчшщъыьэюяБГДЖЗИЙЛПФЦЧШЩЪЫЬЭЮЯ]")


@lru_cache(maxsize=1)
def _tables() -> tuple[dict[int, str], dict[int, str]]:
    every = table_of_characters()
    keep = {cp: to for cp, to in every.items() if not 0x400 <= cp <= 0x52F}
    return every, keep


def fold(text: str) -> str:
    """Look-alikes mapped, accents dropped, other scripts transliterated, lower case.

    A word with letters that only Cyrillic has is read as Cyrillic, any other as Latin.
    """
    if text.isascii():
        return text.lower()
    every, keep = _tables()
    text = unicodedata.normalize("NFC", text)
    if _CYRILLIC.search(text):
        words = text.translate(keep).split(" ")
        text = " ".join(w if _TRUE_CYRILLIC.search(w) else w.translate(every) for w in words)
    else:
        text = text.translate(every)
    text = text.lower().translate(_LATIN)
    if text.isascii():
        return text
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).translate(_LATIN)


_SOUNDS = [(re.compile(a), b) for a, b in (("ph", "f"), ("ck", "k"), ("[aou]e", lambda m: m[0][0]), ("oo", "u"), ("ee", "i"), ("y", "i"), (r"(.)\1+", r"\1"))]


@lru_cache(maxsize=200_000)
def skeleton(word: str) -> str:
    """A word's letters as they sound: spellings of one sound and doubled letters fall together."""
    for a, b in _SOUNDS:
        word = a.sub(b, word)
    return word


def osa(a: str, b: str, most: int) -> int:
    """Edit distance with swaps of neighbours, up to ``most``; ``most + 1`` beyond (banded)."""
    la, lb = len(a), len(b)
    if abs(la - lb) > most:
        return most + 1
    if a == b:
        return 0
    while la and lb and a[0] == b[0]:
        a, b, la, lb = a[1:], b[1:], la - 1, lb - 1
    while la and lb and a[-1] == b[-1]:
        a, b, la, lb = a[:-1], b[:-1], la - 1, lb - 1
    if not la or not lb:
        return min(la + lb, most + 1)
    big = most + 1
    before, last = None, list(range(lb + 1))
    for i in range(1, la + 1):
        row = [big] * (lb + 1)
        low, high = max(1, i - most), min(lb, i + most)
        if low == 1:
            row[0] = i
        best = big
        for j in range(low, high + 1):
            d = last[j - 1] + (a[i - 1] != b[j - 1])
            if last[j] + 1 < d:
                d = last[j] + 1
            if row[j - 1] + 1 < d:
                d = row[j - 1] + 1
            if before and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1] and before[j - 2] + 1 < d:
                d = before[j - 2] + 1
            row[j] = d
            if d < best:
                best = d
        if best > most and (not before or min(last) >= most):
            return big
        before, last = last, row
    return min(last[lb], big)


def bags(words: list[str]) -> np.ndarray:
    """The letters of each word as bits: those it has, and those it has twice; some letters share a bit."""
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32) % 32
    often = np.bincount(row * 32 + letters, minlength=32 * len(words)).reshape(-1, 32)
    bits = np.concatenate([often > 0, often > 1], axis=1)
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).reshape(-1)


def may_be_near(a: np.ndarray, b: np.ndarray, most: np.ndarray | int) -> np.ndarray:
    """Whether words of these ``bags`` can be within so many edits: an edit takes at most one letter away, and adds at most one."""
    return (np.bitwise_count(a & ~b) <= most) & (np.bitwise_count(b & ~a) <= most)
