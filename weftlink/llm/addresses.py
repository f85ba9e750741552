"""Which addresses denote the same building.

A gazetteer is built from the data itself: addresses are parsed into street, town, postcode,
number and unit; complete ones are counted as entries; spellings of a street within a locality
(one postcode, or one town) are clustered around the most frequent, which gets the street
identifier.  Every different (street, town, postcode) is then resolved by beam search over the
entries that an index of postcodes, and of street spellings within towns, offers: localities first, streets
within the best of them next.  Records are joined on street identifier and number; the unit
is a column of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftlink.llm.fold import fold, osa, skeleton
from weftlink.session import cut

#: Words for kinds of street, kinds of unit, and places that an address lies near to.
KINDS = set(
    """road rd street st str avenue ave av avda avenida drive dr lane ln la boulevard blvd bvd bd bld bulevard bul market mkt
    marg mrg mg nagar ngr nagr colony col cly place pl plaza pza plac via v rue r calle cl c rua travessa trav tv aleja al ulica ul
    ulitsa corso cso piazza platz plz strasse weg wg laan straat highway hwy square sq court ct terrace way parkway de du des la le del di da do""".split()
)
_NEAR = re.compile(
    r"\b(?:near|nr|next to|opp|opposite|beside|behind|above|below|adj|adjacent to|adjoining|across from|close to)\b\.?(?: to)?\s+"
    r"(?!\d|#)([^,/#\d]*?)(?=\s*(?:[,/#]|$|\d)|(?:(?<=[a-z])\s+(?:apt|unit|ste|suite|shop|bldg|fl|no|h)\b))"
)
_UNIT = re.compile(r"\b(?:apt|apartment|unit|ste|suite|shop|bldg|building|fl|floor|flat|room|rm)\b\.?\s*#?\s*((?:\d+[a-z]{0,2}|[a-z]\d+))\b|\b(\d+[a-z]{0,2}|[a-z]\d+)\s+(?:floor|flr|fl)\b")
_NUMBER_SIGN = re.compile(r"\b(?:h\.? ?no|house no|no|nr|num)\b\.?\s*(?=\d)")
_HASH = re.compile(r"#\s*(\d+[a-z]{0,2}|[a-z]\d+)\b")
_POST = re.compile(r"(?<![\d])(\d{3}) (\d{3})(?!\d)|(?<!\d)(\d{5,6})(?!\d)")
_HOUSE = re.compile(r"(?<![\da-z])(\d{1,4}[a-z]?)(?![\da-z])")
_WORD = re.compile(r"[a-z]+\.?")
_GLUED = re.compile(r"(?<=[a-z])(?=\d{5,6}\b)")
_PARTS = re.compile(r"[,/]|\s-\s|-(?=\s*$)")
_TAIL = re.compile(r"(?<=[a-z]{4})(?:strasse|straat|platz|plz|pl|laan|weg|wg|str|ln)$")


def parse(address: str, country: str = "", labels: frozenset[str] = frozenset()) -> tuple[str, str, str, str, str]:
    """(street, town, postcode, number, unit) of an address, each '' where there is none.

    Street and town are their folded words without kinds of street.  A last part that is a
    country label is dropped.
    """
    text = " ".join(fold(address).split()).replace(";", ",").strip(" ,/")
    head, sep, last = text.rpartition(",") if "," in text else text.rpartition("/") if "/" in text else text.rpartition(" ")
    last = last.strip(" .")
    if sep and last and (last in labels or last == fold(country or "").strip()):
        text = head
    if "c/" in text or "c.so" in text:
        text = re.sub(r"\bc\.so\b", "corso", re.sub(r"\bc/", "calle ", text))
    text = _NEAR.sub(" , ", text + " ")
    unit = ""

    def take(m: re.Match) -> str:
        nonlocal unit
        unit = unit or next(g for g in m.groups() if g)
        return " , "

    text = _UNIT.sub(take, text)
    text = _GLUED.sub(" ", text)
    posts = list(_POST.finditer(text))
    post = ""
    if posts:
        m = posts[-1]
        post = m[3] or m[1] + m[2]
        if not m[3] and m.start() == 0:
            post, posts = "", []
        else:
            text = text[: m.start()] + " , " + text[m.end() :]
    text = _NUMBER_SIGN.sub("", text)
    if "#" in text:
        hashes = list(_HASH.finditer(text))
        plain = _HOUSE.search(_HASH.sub(" ", text))
        if hashes and (plain or not hashes[0][1][0].isdigit()):
            unit = unit or hashes[0][1]
            text = _HASH.sub(" , ", text)
        text = text.replace("#", "")
    parts = [p.strip(" .") for p in _PARTS.split(text)]
    number, street, town, bare = "", [], [], False
    for part in filter(None, parts):
        house = None if number else _HOUSE.search(part)
        words = [(m.start(), m[0]) for m in _WORD.finditer(part)]
        kinds = [w.strip(".") in KINDS for _, w in words]
        long = [(at, w) for (at, w), k in zip(words, kinds) if not k and len(w.strip(".")) > 2]
        if house:
            number = house[1]
            bare = not long and not street
            before = [w for at, w in long if at < house.start()]
            after = [w for at, w in long if at > house.start()]
            kind_at = [at for (at, _), k in zip(words, kinds) if k]
            if before and after and kind_at and min(kind_at) > house.start():
                town += before
                street += after
            elif before:
                street += before
                town += after
            elif not street:
                # the first word, up to a kind of street, names the street
                at_kind = next((at for (at, w), k in zip(words, kinds) if k and long and at > long[0][0]), None)
                cutoff = at_kind if at_kind is not None else (long[0][0] if long else 0)
                street += [w for at, w in long if at <= cutoff][:3] if at_kind is not None else [w for _, w in long[:1]]
                used = len(street)
                town += [w for _, w in long[used:]]
            else:
                town += after
        elif long and not street and (bare or any(kinds)):
            # a kind of street, or the part after a number that stands alone
            street += [w for _, w in long]
        else:
            town += [w for _, w in long]
    name = _TAIL.sub("", "".join(w.strip(".") for w in street))
    place = "".join(w.strip(".") for w in town)
    return name, place, post, number, unit


_PARSED = "street string, town string, post string, number string, unit string"


def parsed(df: DataFrame, id_col: str, address_col: str, country_col: str | None = None) -> DataFrame:
    """(id, address, street, town, post, number, unit) of every row with an address; each different address is parsed once."""
    spark = df.sparkSession
    rows = df.select(
        F.col(id_col).cast("string").alias("id"),
        F.col(address_col).cast("string").alias("address"),
        (F.coalesce(F.lower(F.trim(F.col(country_col))), F.lit("")) if country_col else F.lit("")).alias("country"),
    ).filter("id IS NOT NULL AND trim(address) <> ''")
    labels = frozenset()
    if country_col:
        # an address can end in another record's label; a row's own is known in any case
        top = rows.filter("country <> ''").groupBy("country").count().orderBy(F.col("count").desc(), "country").limit(200).collect()
        labels = frozenset(fold(r["country"]) for r in top)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [parse(a, c, labels) for a, c in zip(pdf["address"], pdf["country"])]
            yield pd.concat([pdf[["address", "country"]].reset_index(drop=True), pd.DataFrame(got, columns=["street", "town", "post", "number", "unit"])], axis=1)

    once = rows.select("address", "country").distinct().mapInPandas(run, "address string, country string, " + _PARSED)
    return rows.join(once.hint("merge"), ["address", "country"]).drop("country")


def _near(a: str, b: str) -> int:
    """Edits between two spellings or their sounds, or 9 where they are too many for their length."""
    if a == b:
        return 0
    least = min(len(a), len(b))
    most = 0 if least < 4 else 1 if least < 6 else 2 if least < 12 else 3
    d = osa(a, b, most)
    if d > 1:
        d = min(d, max(1, osa(skeleton(a), skeleton(b), most)))
    return d if d <= most else 9


def town_cost(a: str, b: str) -> float:
    if not a or not b:
        return 0.6
    if a == b:
        return 0.0
    a, b = sorted((a, b), key=len)
    if 3 <= len(a) <= 6 and len(b) > len(a):
        # an abbreviation: the start of the name, perhaps with an error
        d = min(osa(a, b[:n], 1) for n in (len(a) - 1, len(a), len(a) + 1))
        if d <= 1:
            return 0.2 + 0.4 * d
    d = _near(a, b)
    return 0.4 * d if d < 9 else 3.0


def post_cost(a: str, b: str) -> float:
    if not a or not b:
        return 0.6
    if a == b:
        return 0.0
    return 1.0 if len(a) == len(b) and osa(a, b, 1) == 1 else 3.0


def beam(street: str, town: str, post: str, entries: list, width: int = 12, most: float = 2.9) -> str | None:
    """The best gazetteer entry for a phrase, or None: localities first, then streets within them.

    ``entries`` are (entry_id, street, town, post, n).  Ties go to the entry with most records,
    then to the smallest id; with neither town nor postcode only a unique locality counts.
    """
    localities: dict[tuple[str, str], list] = {}
    for e in entries:
        localities.setdefault((e[2], e[3]), []).append(e)
    first = sorted((town_cost(town, t) + post_cost(post, p), t, p) for t, p in localities)
    # equal costs at the edge of the beam stay in it
    edge = first[min(width, len(first)) - 1][0] if first else 0.0
    best: list[tuple[float, int, str, tuple[str, str]]] = []
    for cost, t, p in first:
        if cost > edge or cost > most:
            break
        for entry_id, s, _, _, n in localities[t, p]:
            d = _near(street, s)
            if d < 9 and cost + 0.7 * d <= most:
                best.append((cost + 0.7 * d, -n, entry_id, (t, p)))
    if not best:
        return None
    best.sort()
    if not town and not post and len({b[3] for b in best if b[0] <= best[0][0] + 0.3}) > 1:
        return None
    return best[0][2]


def _apart(s: str, s2: str, t: str, t2: str, p: str, p2: str) -> float:
    """The cost of a street in a locality for another; streets of localities too far apart are not compared."""
    town, post = town_cost(t, t2), post_cost(p, p2)
    return 3.0 if town >= 3.0 or post >= 3.0 else 0.7 * _near(s, s2) + town + post


def _spellings(col: str) -> Column:
    """The string and, for five letters or more, all forms with one letter left out."""
    gone = F.expr(f"transform(sequence(1, length({col})), i -> concat(substring({col}, 1, i - 1), substring({col}, i + 1)))")
    return F.when(F.length(col) >= 5, F.array_distinct(F.concat(F.array(F.col(col)), gone))).otherwise(F.array(F.col(col)))


def _near_enough(a: str, b: str) -> Column:
    """A cheap test that every pair of spellings ``_near`` accepts passes."""
    least = F.least(F.length(a), F.length(b))
    most = F.when(least < 4, 0).when(least < 6, 1).when(least < 12, 2).otherwise(3)
    # spellings that only sound alike can differ by more letters
    return F.levenshtein(a, b) <= 2 * most + 2


def _towns(town: str) -> Column:
    """Coarse forms of a town that survive an error or an abbreviation: its start and its end."""
    return F.array_distinct(F.array(F.concat(F.lit("<"), F.left(town, F.lit(3))), F.concat(F.lit(">"), F.right(town, F.lit(3)))))


def street_keys(street: str, town: str, post: str, ends: bool) -> Column:
    """Keys under which near streets of near localities meet; every key holds a locality.

    In one postcode: any street, or with ``ends`` those of one start or end.  In towns of one start or end: streets
    of the same letters but for one.
    """
    none = F.array().cast("array<bigint>")
    if ends:
        inside = F.array(F.xxhash64(F.lit("p"), post, F.lit("<"), F.left(street, F.lit(3))), F.xxhash64(F.lit("p"), post, F.lit(">"), F.right(street, F.lit(3))))
    else:
        inside = F.array(F.xxhash64(F.lit("p"), post))
    near = F.flatten(F.transform(_towns(town), lambda t: F.transform(_spellings(street), lambda s: F.xxhash64(F.lit("t"), t, s))))
    return F.concat(F.when(F.col(post) != "", inside).otherwise(none), F.when(F.col(town) != "", near).otherwise(none))


def gazetteer(phrases: DataFrame) -> DataFrame:
    """``phrases(street, town, post, n)`` -> entries (entry_id, street, town, post, n, center).

    A spelling is drawn to the most frequent entry near in street and locality, and on from there to the end;
    ``center`` is that entry, the entry itself where there is none.
    """
    full = phrases.filter("length(street) >= 3 AND town <> '' AND post <> ''").select(
        F.sha1(F.concat_ws("|", "street", "town", "post")).alias("entry_id"), "street", "town", "post", "n"
    )
    full = cut(full)

    @F.pandas_udf("double")
    def apart(s: pd.Series, s2: pd.Series, t: pd.Series, t2: pd.Series, p: pd.Series, p2: pd.Series) -> pd.Series:
        return pd.Series([_apart(*x) for x in zip(s, s2, t, t2, p, p2)])

    weaker = (F.col("n_") > F.col("n")) | ((F.col("n_") == F.col("n")) & (F.col("entry_id_") < F.col("entry_id")))
    # `post_cost` lets no other postcodes pass
    posts = (F.col("post") == F.col("post_")) | ((F.length("post") == F.length("post_")) & (F.levenshtein("post", "post_", 2) >= 0))
    keyed = full.select("*", F.explode(F.array_distinct(street_keys("street", "town", "post", True))).alias("k"))
    keyed = keyed.repartition("k")  # written once for both sides
    other = keyed.select("k", *[F.col(c).alias(f"{c}_") for c in full.columns])
    # of a pair in one postcode with one start or end, the rows under its other keys are left out
    here = F.col("post") == F.col("post_")
    first = F.when(here & (F.left("street", F.lit(3)) == F.left("street_", F.lit(3))), F.col("k") == F.xxhash64(F.lit("p"), "post", F.lit("<"), F.left("street", F.lit(3))))
    first = first.when(here & (F.right("street", F.lit(3)) == F.right("street_", F.lit(3))), F.col("k") == F.xxhash64(F.lit("p"), "post", F.lit(">"), F.right("street", F.lit(3))))
    pairs = (
        keyed.join(other.hint("merge"), "k")
        .filter(weaker & posts & first.otherwise(True) & _near_enough("street", "street_"))
        .drop("k")
        .dropDuplicates(["entry_id", "entry_id_"])
        .withColumn("apart", apart("street", "street_", "town", "town_", "post", "post_"))
        .filter("apart <= 2.9")
    )
    drawn = pairs.groupBy("entry_id").agg(F.max(F.struct("n_", F.col("entry_id_").alias("c"))).c.alias("to"))
    ends = cut(full.select("entry_id").join(drawn.hint("merge"), "entry_id", "left").select("entry_id", F.coalesce("to", "entry_id").alias("to"), F.col("to").isNotNull().alias("moved")))
    # every round doubles the steps; no step leads back, as each goes to a more frequent entry or an earlier one of the same count
    while ends.filter("moved").limit(1).count():
        hop = ends.select(F.col("entry_id").alias("to"), F.col("to").alias("to2"))
        ends = cut(ends.join(hop.hint("merge"), "to").select("entry_id", F.col("to2").alias("to"), (F.col("to") != F.col("to2")).alias("moved")))
    return full.join(ends.select("entry_id", F.col("to").alias("center")).hint("merge"), "entry_id")


def resolve(phrases: DataFrame, entries: DataFrame) -> DataFrame:
    """(street, town, post, street_id): every phrase's gazetteer street, or a name of its own.

    A phrase is offered the entries of its postcode, and those near in street of towns that start or end as its own;
    one with neither is offered an entry only if no other locality has a street of that spelling.  What
    one phrase is offered is bounded by the streets of a postcode and of like-named towns, not by the number of records.
    """
    centers = entries.filter("entry_id = center").select("entry_id", F.col("street").alias("s"), F.col("town").alias("t"), F.col("post").alias("p"), "n")
    e = F.struct("entry_id", "s", "t", "p", "n").alias("e")
    offered = centers.select(F.explode(F.array_distinct(street_keys("s", "t", "p", False))).alias("k"), e)
    asked = phrases.filter("length(street) >= 3").select("street", "town", "post")
    keys = asked.select("street", "town", "post", F.explode(F.array_distinct(street_keys("street", "town", "post", False))).alias("k"))
    # of a pair in one postcode, the rows under its other keys are left out
    once = F.when(F.col("post") == F.col("e.p"), F.col("k") == F.xxhash64(F.lit("p"), "post")).otherwise(True)
    met = keys.join(offered.hint("merge"), "k").filter(once & _near_enough("street", "e.s")).select("street", "town", "post", "e")
    spelled = centers.select(F.explode(_spellings("s")).alias("k"), e)
    only = spelled.groupBy("k").agg(F.min("e").alias("e"), F.min(F.struct("e.t", "e.p")).alias("low"), F.max(F.struct("e.t", "e.p")).alias("high")).filter("low = high").select("k", "e")
    lone = asked.filter("town = '' AND post = ''").select("street", "town", "post", F.explode(_spellings("street")).alias("k"))
    unplaced = lone.join(only.hint("merge"), "k").filter(_near_enough("street", "e.s")).select("street", "town", "post", "e")
    found = met.unionByName(unplaced).groupBy("street", "town", "post").agg(F.collect_set("e").alias("found"))

    @F.pandas_udf("string")
    def pick(street: pd.Series, town: pd.Series, post: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([beam(s, t, p, [tuple(x.values()) for x in e]) for s, t, p, e in zip(street, town, post, found)], dtype=object)

    picked = found.select("street", "town", "post", pick("street", "town", "post", "found").alias("entry_id"))
    own = F.concat_ws("|", F.lit("own"), "street", F.when(F.col("post") != "", F.col("post")).otherwise(F.col("town")))
    known = entries.select("street", "town", "post", "center")
    return (
        phrases.select("street", "town", "post")
        .join(picked.hint("merge"), ["street", "town", "post"], "left")
        .join(known.hint("merge"), ["street", "town", "post"], "left")
        .select("street", "town", "post", F.coalesce("entry_id", "center", own).alias("street_id"))
    )


def buildings(df: DataFrame, id_col: str, address_col: str, country_col: str | None = None) -> DataFrame:
    """(id, building, street_id, number, unit, street, town, post) of every row with an address.

    ``building`` joins street identifier and number; an address without a street or number is
    a building of its own text.  NULL and blank addresses and NULL ids give no rows; an empty
    table gives none; extra columns are not read.
    """
    rows = cut(parsed(df, id_col, address_col, country_col))
    phrases = cut(rows.groupBy("street", "town", "post").agg(F.count(F.lit(1)).alias("n")))
    known = resolve(phrases, gazetteer(phrases))
    out = rows.join(known.hint("merge"), ["street", "town", "post"])
    whole = F.concat(F.lit("text|"), F.trim(F.lower(F.regexp_replace("address", r"[\s,.]+", " "))))
    usable = (F.col("number") != "") & (F.length("street") >= 3)
    return out.select(
        "id", F.when(usable, F.concat_ws("#", "street_id", "number")).otherwise(whole).alias("building"), "street_id", "number", "unit", "street", "town", "post"
    )


def same_building(df: DataFrame, id_col: str, address_col: str, country_col: str | None = None) -> DataFrame:
    """(id_a, id_b): different records at one building, smaller id first."""
    at = buildings(df, id_col, address_col, country_col).select("id", "building").distinct()
    a = at.select(F.col("id").alias("id_a"), "building")
    b = at.select(F.col("id").alias("id_b"), "building")
    return a.join(b.hint("merge"), "building").filter("id_a < id_b").select("id_a", "id_b").distinct()
