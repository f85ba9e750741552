"""Which spellings of names denote the same organisation.

Names are folded, legal forms and trading prefixes dropped, nicknames and abbreviations spelled
out.  Words that very many names use (counted over all names) only confirm a match; the rest,
joined, is the core.  Cores within a few edits are found by a pigeonhole segment join: an
indexed core is cut into k + 1 segments, one of which survives k edits; every probe looks up its
substrings at the positions to which such a segment can have moved.  Banded edit distance
verifies.  Reordered parts are indexed as further arrangements of a core.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftlink.llm.fold import bags, fold, may_be_near, osa
from weftlink.session import cut

#: Legal forms, connectives, nicknames and common business abbreviations.
LEGAL = set(
    """limited ltd ltda limitada lda private pvt pte pty corporation corp corpn incorporated inc company co cmpny compagnie llc llp lp plc
    sa sas sasu sarl eurl snc sci srl srls spa ag gmbh mbh kg ohg ug bv nv vof sl slu sociedad anonima sab cv spzoo zoo spolka sp ood eood ad ead oyj oy ab as""".split()
)
CONNECTIVES = set("and et und y e i the of de del da di des du la le el los las en".split())
NICKNAMES = {
    "robert": "bob bobby rob robbie bert", "william": "bill billy will willie liam", "james": "jim jimmy jamie", "richard": "dick rick ricky rich richie",
    "edward": "ed eddie eddy ned", "theodore": "ted teddy theo", "henry": "hank harry", "charles": "chuck charlie charley",
    "margaret": "peggy meg maggie marge greta madge", "elizabeth": "liz lizzie beth betty eliza bess", "katherine": "kate kathy katie kit kathie kay",
    "susannah": "sue susie susan suzy", "dorothy": "dolly dot dottie dora", "patricia": "pat patty tricia trish", "alexander": "alex sandy xander alec",
    "francis": "fran frank frankie", "john": "jack johnny jon", "michael": "mike mick", "thomas": "tom tommy", "joseph": "joe joey", "anthony": "tony",
    "daniel": "dan danny", "samuel": "sam sammy", "benjamin": "ben benny", "nicholas": "nick", "andrew": "andy drew", "christopher": "chris",
}
_NICK = {v.replace("y", "i"): k.replace("y", "i") for k, vs in NICKNAMES.items() for v in vs.split()}
ABBREVIATIONS = {
    "engineering": "eng engg", "manufacturing": "mfg", "distributors": "dist", "brothers": "bros", "laboratories": "labs lab", "national": "natl",
    "international": "intl", "services": "svcs svc service", "industries": "inds ind", "association": "assn assoc", "department": "dept", "group": "grp",
    "enterprises": "ent", "marketing": "mktg", "technologies": "tech", "systems": "sys",
}
_ABBREVIATED = {v.replace("y", "i"): k.replace("y", "i") for k, vs in ABBREVIATIONS.items() for v in vs.split()}
_DROPPED = {w.replace("y", "i") for w in LEGAL | CONNECTIVES}
_TRADING = re.compile(r"^.{2,}?\b(?:d ?/ ?b ?/ ?a|dba|t ?/ ?a|trading as|doing business as|a ?/ ?k ?/ ?a|aka)\b[\s:]*", re.S)
_SITE = re.compile(r"^(?:https?://)?(?:www\.)?@?([a-z0-9_-]{4,})(?:\.[a-z]{2,})*/?$")
_LETTERS = re.compile(r"\b([a-z])[. ]+(?=[a-z]\b)")
_SPLIT = re.compile(r"[^a-z0-9]+")
_PLAIN = re.compile("([aou])e(?=[^aeiou])")


def _shorter(word: str, most: int) -> set[str]:
    """The word and what is left of it without up to ``most`` letters."""
    out, last = {word}, {word}
    for _ in range(most):
        last = {w[:i] + w[i + 1 :] for w in last for i in range(len(w))}
        out |= last
    return out


#: Long legal forms by what is left of them without a letter: misspelled ones are dropped too.
_LEGAL_LONG = ("limited", "private", "corporation", "incorporated", "compani", "limitada", "sociedad")
_LEGAL_NEAR = {x: w for w in _LEGAL_LONG for x in _shorter(w, 1)}
#: One edit leaves three letters at the start or at the end as they are.
_LEGAL_STARTS, _LEGAL_ENDS = tuple({w[:3] for w in _LEGAL_LONG}), tuple({w[-3:] for w in _LEGAL_LONG})


def words_of(name: str) -> list[str]:
    """Words of a name: folded, without trading prefix, legal forms and connectives, nicknames spelled out."""
    text = fold(name).strip()
    text = re.sub(r"^m ?/ ?s\b\.?", "", _TRADING.sub("", text)).strip()
    if " " not in text:
        m = _SITE.match(text)
        text = m[1] if m else text
    text = _LETTERS.sub(r"\1", text.replace("(", " ").replace(")", " ").replace("&", " and ").replace("+", " and ").replace("'", ""))
    every = [_PLAIN.sub(r"\1", w).replace("y", "i") for w in _SPLIT.split(text) if w]
    out = []
    for w in every:
        if w in _DROPPED:
            continue
        if len(w) >= 6 and (w.startswith(_LEGAL_STARTS) or w.endswith(_LEGAL_ENDS)) and any(x in _LEGAL_NEAR and osa(w, _LEGAL_NEAR[x], 1) <= 1 for x in _shorter(w, 1)):
            continue
        if len(w) == 1 and len(every) > 2 and w == "p":
            continue
        out.append(_ABBREVIATED.get(w, _NICK.get(w, w)))
    return out or every


def short_for(a: str, b: str) -> bool:
    """Whether ``a`` abbreviates ``b``: its start, or its first letter and then some of its letters in order without vowels
    (a last one aside)."""
    if len(a) < 4 or len(a) >= len(b) - 1 or a[0] != b[0]:
        return False
    if b.startswith(a):
        return True
    if any(c in "aeiou" for c in a[1:-1]):
        return False
    rest = iter(b)
    return all(c in rest for c in a)


def _edits(word: str) -> int:
    return 0 if len(word) < 5 else 1 if len(word) < 8 else 2


class Lexicon:
    """The words that very many names use, the most frequent first."""

    def __init__(self, common: list[str]):
        self.common = set(common)
        self.long = sorted((w for w in common if len(w) >= 4), key=lambda w: (-len(w), w))
        self.by_first: dict[str, list[str]] = {}
        self.bags = bags(self.long) if self.long else None
        for w in common:
            self.by_first.setdefault(w[0], []).append(w)
        self.kept: dict[str, str | None] = {}
        # of a common word, its plural, and its abbreviation without vowels, all in use, one form stands for all
        self.form = {w: max(f for f in (w + "s", w + "es") if f in self.common) for w in common if {w + "s", w + "es"} & self.common}
        for w in common:
            if 4 <= len(w) <= 6 and not any(c in "aeiou" for c in w[1:-1]):
                longer = [c for c in self.by_first[w[0]] if len(c) >= 6 and short_for(w, c)]
                if longer:
                    self.form[w] = self.form.get(longer[0], longer[0])

    def known(self, word: str) -> str | None:
        """The common word that ``word`` is, misspells or abbreviates."""
        if word in self.common:
            return self.form.get(word, word)
        if word not in self.kept:
            self.meet([word])
        return self.kept[word]

    def meet(self, words: list[str]) -> None:
        """Finds what ``known`` gives for words that are not common, all of them at once."""
        if len(self.kept) > 200_000:
            self.kept.clear()
        words = [w for w in dict.fromkeys(words) if w not in self.common and w not in self.kept]
        near = self._misspelled([w for w in words if 5 <= len(w) <= 24])
        for word in words:
            hit = near.get(word)
            if hit is None:
                hit = next((f for f in (word + "s", word + "es") if len(word) >= 4 and f in self.common), None)
            if hit is None and 4 <= len(word) <= 8:
                # longer words abbreviate only what they begin
                whole = len(word) > 6 or any(c in "aeiou" for c in word[1:-1])
                longer = (c for c in self.by_first.get(word[0], ()) if len(c) >= 6 and (not whole or c.startswith(word)) and short_for(word, c))
                hit = next(longer, None)
            self.kept[word] = self.form.get(hit, hit)

    def _misspelled(self, words: list[str]) -> dict[str, str]:
        """The nearest common word of at least four letters within the edits of a word (the first in the alphabet of equally near ones)."""
        out: dict[str, str] = {}
        if not self.long:
            return out
        sizes = np.array([len(w) for w in self.long])
        for at in range(0, len(words), 2000):
            some = words[at : at + 2000]
            most = np.array([_edits(w) for w in some])
            own = np.array([len(w) for w in some])
            near = may_be_near(bags(some)[:, None], self.bags[None, :], most[:, None])
            row, col = np.nonzero(near & (np.abs(own[:, None] - sizes[None, :]) <= most[:, None]))
            best: dict[int, tuple[int, str]] = {}
            for r, c in zip(row.tolist(), col.tolist()):
                found = (osa(some[r], self.long[c], most[r]), self.long[c])
                if found[0] <= most[r] and (r not in best or found < best[r]):
                    best[r] = found
            out |= {some[r]: c for r, (_, c) in best.items()}
        return out

    def split(self, words: list[str]) -> tuple[list[str], list[str], list[str]]:
        """(core words, common words, initials)."""
        core, common, initials = [], [], []
        whole = list(words)
        for i in range(len(words) - 1):
            # a common word written as two
            if words[i] + words[i + 1] in self.common and words[i] and words[i + 1]:
                whole[i : i + 2] = [words[i] + words[i + 1], ""]
        for w in filter(None, whole):
            if len(w) == 1:
                initials.append(w)
                continue
            c = self.known(w)
            if c:
                common.append(c)
                continue
            # a name written as one word, as sites and handles are
            changed = len(words) == 1 and len(w) >= 10
            while changed:
                changed = False
                for c in self.long:
                    if len(w) - len(c) >= 3 and (w.endswith(c) or w.startswith(c)):
                        w = w[: -len(c)] if w.endswith(c) else w[len(c) :]
                        common.append(self.form.get(c, c))
                        changed = len(w) >= 8
                        break
            core.append(w)
        return core, sorted(set(common)), initials


def allowed(length: int) -> int:
    """Edits for a core of so many letters; a swap of neighbours is one edit."""
    return 0 if length < 6 else 1 if length < 10 else 2 if length < 20 else 3


def arrangements(core: list[str]) -> list[str]:
    """The core as written, and with its words turned around: sorted, and all rotations of up to five words."""
    turned = [core[i:] + core[:i] for i in range(1, len(core))] if len(core) <= 5 else []
    return list(dict.fromkeys("".join(x) for x in [core, sorted(core), *turned]))


def segments(length: int, edits: int, shift: int) -> list[tuple[int, int]]:
    """(start, size) of edits + 1 segments of about equal size, inner borders moved by ``shift``."""
    n = edits + 1
    borders = [0, *(i * length // n + shift for i in range(1, n)), length]
    return [(x, y - x) for x, y in zip(borders, borders[1:])]


#: An edit spoils one segment, a swap across a border two: a second cut has its borders elsewhere.
_SHIFTS = (0, 1)


def alike(a: list[str], b: list[str]) -> bool:
    """Whether two sets of common words can belong to one organisation: one shared, or one set empty."""
    if not len(a) or not len(b) or set(a) & set(b):
        return True
    return any(x.startswith(y[:4]) or y.startswith(x[:4]) or short_for(x, y) or short_for(y, x) for x in a for y in b)


def analysed(df: DataFrame, name_col: str, floor: int = 25, share: float = 0.001, forms: bool = False) -> DataFrame:
    """(name, core, arranged, parts, common, initials) of every different non-blank name, checkpointed.

    With ``forms`` also plain, letters, head and acronym: words in order of the alphabet, sorted initials, whether the name is one,
    and then its first letter.

    A word is common if at least ``share`` of all names and at least ``floor`` names use it; there
    can be no more of them than a name has words on average, by ``share``, however many names there are.
    Forenames and trades that have nicknames and abbreviations here are common in any case.
    """
    names = df.select(F.col(name_col).cast("string").alias("name")).filter("trim(name) <> ''").distinct()

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(words=[words_of(n) for n in pdf["name"]])

    worded = cut(names.mapInPandas(split, "name string, words array<string>"))
    n = worded.count()
    counts = worded.select(F.explode(F.array_distinct("words")).alias("w")).filter("length(w) >= 3").groupBy("w").count()
    least = max(floor, int(share * n))
    found = counts.filter(F.col("count") >= least).collect()  # at most (words a name) / share rows
    often = {w: 0 for w in (*_ABBREVIATED.values(), *_NICK.values())} | {r["w"]: r["count"] for r in found}
    shared = df.sparkSession.sparkContext.broadcast(sorted(often, key=lambda w: (-often[w], w)))

    def cores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(shared.value)
        for pdf in batches:
            every = [w.tolist() for w in pdf["words"]]
            lexicon.meet([x for w in every for x in w if len(x) > 1])
            got = [lexicon.split(w) for w in every]
            out = pd.DataFrame(
                {
                    "name": pdf["name"].to_numpy(),
                    "core": ["".join(c) for c, _, _ in got],
                    "arranged": [arrangements(c) if c else [] for c, _, _ in got],
                    "parts": [c for c, _, _ in got],
                    "common": [m for _, m, _ in got],
                    "initials": [i for *_, i in got],
                }
            )
            if forms:
                one = [len(w) == 1 and 2 <= len(w[0]) <= 5 and len(n.strip()) <= 30 for w, n in zip(every, pdf["name"])]
                out["plain"] = [" ".join(sorted(fold(n).split())) for n in pdf["name"]]
                out["letters"] = ["".join(sorted(w[0] if o else "".join(x[0] for x in w))) for w, o in zip(every, one)]
                out["head"] = [w[0][0] if o else "" for w, o in zip(every, one)]
                out["acronym"] = one
            yield out

    more = ", plain string, letters string, head string, acronym boolean" if forms else ""
    return cut(worded.mapInPandas(cores, "name string, core string, arranged array<string>, parts array<string>, common array<string>, initials array<string>" + more))


#: Units of which one part of a group that nearly all cores meet is made.
_PART = 200_000
#: Pairs, and letters of texts, that are held at once.
_PAIRS, _CELLS = 200_000, 2_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _windows(texts: list[str], parts: list[tuple[int, int]]) -> list[np.ndarray]:
    """Hashes of the substrings (start, size) of texts of one length."""
    letters = np.array(texts, dtype=f"U{len(texts[0])}").view(np.uint32).reshape(len(texts), -1).astype(np.uint64)
    upto = np.zeros((letters.shape[1] + 1, len(texts)), np.uint64)
    for j in range(letters.shape[1]):
        upto[j + 1] = upto[j] * _BASE + letters[:, j] + np.uint64(1)
    power = np.multiply.accumulate(np.full(letters.shape[1], _BASE))  # products wrap
    return [upto[at + size] - upto[at] * power[size - 1] for at, size in parts]


def _near_in(length: int, indexed: list[tuple[str, list[str]]], probing: list[tuple[str, list[str]]]) -> Iterator[tuple[str, str]]:
    """(a, b) of one group: probing cores within the allowed edits of indexed ones, all of ``length``, that come first."""
    edits = allowed(length)
    cuts = [(s, i, at, size) for s in _SHIFTS for i, (at, size) in enumerate(segments(length, edits, s))]
    texts_b = [(n, t) for n, (_, ts) in enumerate(indexed) for t in ts]
    step = max(1, _CELLS // length)
    keys = [np.concatenate(k) for k in zip(*[_windows([t for _, t in texts_b[x : x + step]], [c[2:] for c in cuts]) for x in range(0, len(texts_b), step)])]
    orders = [np.argsort(k, kind="stable") for k in keys]
    keys = [k[o] for k, o in zip(keys, orders)]
    bags_b = bags([t for _, t in texts_b])
    by_length: dict[int, list[tuple[str, list[str]]]] = {}
    for p in probing:
        by_length.setdefault(len(p[0]), []).append(p)
    for mine, every in by_length.items():
        delta = mine - length
        for x in range(0, len(every), max(1, _CELLS // mine // 4)):
            chosen = every[x : x + max(1, _CELLS // mine // 4)]
            # rotations are indexed; of three words or more the sorted form is looked up as well
            texts_a = [(n, t) for n, (_, ts) in enumerate(chosen) for t in ts[: 1 + (len(ts) > 2)]]
            bags_a = bags([t for _, t in texts_a])
            # a segment can have moved by the edits before it, and by those after it seen from the end
            moved = [range(max(0, at - i, at + delta - (edits - i)), min(mine - size, at + i, at + delta + (edits - i)) + 1) for _, i, at, size in cuts]
            wanted = sorted({(p, size) for (*_, size), ps in zip(cuts, moved) for p in ps})
            hashes = dict(zip(wanted, _windows([t for _, t in texts_a], wanted)))
            met: list[np.ndarray] = []
            for (*_, size), ps, ours, order in zip(cuts, moved, keys, orders):
                for asked in (hashes[p, size] for p in ps):
                    first = np.searchsorted(ours, asked, "left")
                    many = np.searchsorted(ours, asked, "right") - first
                    hit = np.flatnonzero(many)
                    total = np.cumsum(many[hit])
                    for y in range(0, int(total[-1]) if len(total) else 0, _PAIRS):
                        # the pairs number y and on
                        number = np.arange(y, min(y + _PAIRS, int(total[-1])))
                        row = np.searchsorted(total, number, "right")
                        ta = hit[row]
                        tb = order[first[ta] + number - (total[row] - many[ta])]
                        near = may_be_near(bags_a[ta], bags_b[tb], edits)
                        met.append(np.unique(ta[near] * np.int64(len(texts_b)) + tb[near]))
            found = set()
            for pair in np.unique(np.concatenate(met)) if met else ():
                (na, ta), (nb, tb) = texts_a[pair // len(texts_b)], texts_b[pair % len(texts_b)]
                a, b = chosen[na][0], indexed[nb][0]
                if (mine > length or a > b) and (a, b) not in found and osa(ta, tb, edits) <= edits:
                    found.add((a, b))
            yield from found


def near_cores(units: DataFrame) -> DataFrame:
    """``units(core, arranged, commons)``, one row a core -> (a, b): different cores within the allowed
    edits that share a common word, or of which one has none.

    Cores meet in groups by common word and length of the indexed one, so the names of one trade meet only each other;
    cores without any are met in groups of their own, in parts where there are many. Segments are
    cut, met and verified within a task: only cores are shuffled, a few times each, not their keys.
    """
    parts = max(1, units.count() // _PART)
    rows = units.filter("length(core) >= 6").select("core", F.array_join("arranged", " ").alias("arranged"), F.coalesce("commons", F.array().cast("array<string>")).alias("m"), F.length("core").alias("n"))
    part = F.pmod(F.xxhash64("core"), F.lit(parts)).cast("int")
    each = F.sequence(F.lit(0), F.lit(parts - 1))
    fixed = lambda mark, p: F.struct(F.lit(mark).alias("mark"), p.cast("int").alias("part"))
    marks = F.transform("m", lambda w: F.struct(w.alias("mark"), F.lit(0).alias("part")))
    # in the groups "*" (all cores) the indexed ones are dealt to parts, in "-" (those without a common word) the probing ones
    indexed = F.when(F.size("m") > 0, F.concat(marks, F.array(fixed("*", part)))).otherwise(
        F.concat(F.array(fixed("*", part)), F.transform(each, lambda p: fixed("-", p)))
    )
    probing = F.when(F.size("m") > 0, F.concat(marks, F.array(fixed("-", part)))).otherwise(F.transform(each, lambda p: fixed("*", p)))
    edits = lambda n: F.when(n < 10, 1).when(n < 20, 2).otherwise(3)
    lengths = F.filter(F.sequence(F.greatest(F.lit(6), F.col("n") - 3), F.col("n")), lambda x: F.col("n") - x <= edits(x))
    grouped = (
        rows.select("core", "arranged", F.lit(False).alias("probes"), F.explode(indexed).alias("g"), F.col("n").alias("at"))
        .unionByName(rows.select("core", "arranged", F.lit(True).alias("probes"), F.explode(probing).alias("g"), lengths.alias("at")).withColumn("at", F.explode("at")))
        .select("core", "arranged", "probes", F.xxhash64("g.mark", "g.part", "at").alias("k"), "at")
    )

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # rows come sorted by group
        now, sides = (None, 0), ([], [])
        out: list[tuple[str, str]] = []
        for pdf in batches:
            for core, arranged, probes, k, at in zip(pdf["core"], pdf["arranged"], pdf["probes"], pdf["k"], pdf["at"]):
                if (k, at) != now:
                    if sides[0] and sides[1]:
                        out += _near_in(now[1], *sides)
                    now, sides = (k, at), ([], [])
                sides[probes].append((core, arranged.split(" ")))
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=["a", "b"])
                out = []
        if sides[0] and sides[1]:
            out += _near_in(now[1], *sides)
        yield pd.DataFrame(out, columns=["a", "b"])

    return grouped.repartition("k").sortWithinPartitions("k", "at").mapInPandas(meet, "a string, b string").distinct()


def name_classes(df: DataFrame, name_col: str, forms: bool = False) -> DataFrame:
    """(name, class_id, core, parts, common, initials) of every different name, with ``forms`` those of ``analysed``: names
    of one organisation share ``class_id``.

    A core is drawn to the most frequent core near it whose common words agree (of equally frequent
    ones to the first in the alphabet), and on from there to the end.  Names without a core of
    their own (only common words) are a class by their words.  NULL and blank names have no class.
    """
    return _classed(df, name_col, forms)[0]


def _classed(df: DataFrame, name_col: str, forms: bool = False) -> tuple[DataFrame, DataFrame]:
    """``name_classes``, and (a, class_a, b, class_b): near cores with agreeing common words that were drawn to different classes."""
    every = analysed(df, name_col, forms=forms)
    # the unit of a class: a core with the common words that mark its trade
    units = every.groupBy("core").agg(
        F.count(F.lit(1)).alias("n"), F.min("arranged").alias("arranged"), F.array_distinct(F.flatten(F.collect_set("common"))).alias("commons")
    )
    units = cut(units.filter("core <> ''"))
    edges = near_cores(units.select("core", "arranged", "commons"))
    known = units.select("core", "n", "commons")

    @F.pandas_udf("boolean")
    def agree(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([alike(list(s), list(t)) for s, t in zip(x, y)])

    left = known.select(F.col("core").alias("a"), F.col("n").alias("na"), F.col("commons").alias("ca"))
    right = known.select(F.col("core").alias("b"), F.col("n").alias("nb"), F.col("commons").alias("cb"))
    links = cut(edges.join(left.hint("merge"), "a").join(right.hint("merge"), "b").filter(agree("ca", "cb")).select("a", "na", "b", "nb"))
    up = F.expr("nb > na OR (nb = na AND b < a)")
    drawn = links.select(F.when(up, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(up, F.struct("nb", "b")).otherwise(F.struct(F.col("na").alias("nb"), F.col("a").alias("b"))).alias("x"))
    to = drawn.groupBy("a").agg(F.min(F.struct(-F.col("x.nb"), F.col("x.b").alias("b"))).b.alias("to"))
    ends = cut(units.join(to.hint("merge"), units["core"] == to["a"], "left").select("core", F.coalesce("to", "core").alias("to"), F.col("to").isNotNull().alias("moved")))
    # every round doubles the steps; no step leads back, as each goes to a more frequent core or an earlier one of the same count
    while ends.filter("moved").limit(1).count():
        hop = ends.select(F.col("core").alias("to"), F.col("to").alias("to2"))
        ends = cut(ends.join(hop.hint("merge"), "to").select("core", F.col("to2").alias("to"), (F.col("to") != F.col("to2")).alias("moved")))
    ends = ends.select("core", F.col("to").alias("class_core"))
    out = every.join(ends.hint("merge"), "core", "left")
    words = F.concat(F.lit("="), F.array_join("common", " "), F.lit("|"), F.array_join("initials", " "), F.lit("|"), "core")
    more = ["plain", "letters", "head", "acronym"] if forms else []
    named = out.select("name", F.coalesce("class_core", words).alias("class_id"), "core", "parts", "common", "initials", *more)
    class_a = ends.select(F.col("core").alias("a"), F.col("class_core").alias("class_a"))
    class_b = ends.select(F.col("core").alias("b"), F.col("class_core").alias("class_b"))
    apart = links.select("a", "b").join(class_a.hint("merge"), "a").join(class_b.hint("merge"), "b").filter("class_a <> class_b")
    return _initialled(cut(named)), apart


def _initialled(named: DataFrame) -> DataFrame:
    """Gives names with an initial for a word ("K. Halhal Toys") the class of the one organisation they can mean."""
    full = named.filter("size(parts) BETWEEN 2 AND 5 AND size(initials) = 0")
    short = named.filter("size(parts) BETWEEN 1 AND 4 AND size(initials) BETWEEN 1 AND 2 AND size(common) > 0")
    rest = "sort_array(filter(parts, (x, j) -> j <> i))"
    one = full.select(
        F.explode(F.expr(f"transform(sequence(0, size(parts) - 1), i -> concat(left(parts[i], 1), '|', array_join({rest}, ' ')))")).alias("k"),
        F.col("class_id").alias("full_class"), F.col("common").alias("full_common"),
    ).groupBy("k", "full_class").agg(F.array_distinct(F.flatten(F.collect_set("full_common"))).alias("full_common"))
    asked = short.select("name", "common", F.concat(F.element_at("initials", 1), F.lit("|"), F.array_join(F.sort_array("parts"), " ")).alias("k"))
    met = asked.join(one.hint("merge"), "k").filter(F.arrays_overlap("common", "full_common"))
    sure = met.groupBy("name").agg(F.min("full_class").alias("to"), F.countDistinct("full_class").alias("m")).filter("m = 1")
    return named.join(sure.select("name", "to").hint("merge"), "name", "left").withColumn("class_id", F.coalesce("to", "class_id")).drop("to")


def same_organisation(df: DataFrame, id_col: str, name_col: str) -> DataFrame:
    """(id_a, id_b): different records whose names denote one organisation, smaller id first.

    These are the names of one class, and those of near cores that were drawn to different classes
    (but for names with an initial that ``_initialled`` has given to another organisation).
    Identical names always pair.  Rows with a NULL id, or a NULL or blank name, give none.
    """
    classes, apart = _classed(df, name_col)
    rows = df.select(F.col(id_col).cast("string").alias("id"), F.col(name_col).cast("string").alias("name")).filter("id IS NOT NULL AND trim(name) <> ''").distinct()
    at = rows.join(classes.hint("merge"), "name").select("id", "class_id", "core", "common")
    a = at.select(F.col("id").alias("id_a"), "class_id", F.col("common").alias("ca"))
    b = at.select(F.col("id").alias("id_b"), "class_id", F.col("common").alias("cb"))

    @F.pandas_udf("boolean")
    def agree(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([alike(list(s), list(t)) for s, t in zip(x, y)])

    inside = a.join(b.hint("merge"), "class_id").filter("id_a < id_b").select("id_a", "ca", "id_b", "cb")
    near_a = at.select(F.col("id").alias("id_a"), F.col("core").alias("a"), F.col("class_id").alias("class_a"), F.col("common").alias("ca"))
    near_b = at.select(F.col("id").alias("id_b"), F.col("core").alias("b"), F.col("class_id").alias("class_b"), F.col("common").alias("cb"))
    across = apart.join(near_a.hint("merge"), ["a", "class_a"]).join(near_b.hint("merge"), ["b", "class_b"]).filter("id_a <> id_b").select("id_a", "ca", "id_b", "cb")
    met = inside.unionByName(across).filter(agree("ca", "cb"))
    return met.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b")).distinct()
