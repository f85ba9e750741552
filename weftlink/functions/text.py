"""Normalisation of names, addresses and countries as column expressions; nothing leaves the JVM."""

from __future__ import annotations

import json
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The vocabulary of the normalised form.
NAME_ABBREVIATIONS = {
    "pvt": "private", "ltd": "limited", "corp": "corporation", "inc": "incorporated", "co": "company", "intl": "international",
    "natl": "national", "assn": "association", "assoc": "association", "bros": "brothers", "mfg": "manufacturing", "dept": "department",
    "svc": "service", "svcs": "services", "mktg": "marketing", "dist": "distributors", "ent": "enterprises", "grp": "group",
}
LEGAL_TOKENS = (
    "corporation incorporated company limited private llc llp plc gmbh ag sa sas srl bv nv pte pty ltda corp inc co ltd pvt "
    "kg oy ab spa sarl sasu eurl sci scp sca snc"
).split()
CONNECTOR_TOKENS = "and the of for".split()
ADDRESS_ABBREVIATIONS = {
    "rd": "road", "st": "street", "ave": "avenue", "av": "avenue", "blvd": "boulevard", "ln": "lane", "dr": "drive", "hwy": "highway",
    "sq": "square", "apt": "apartment", "bldg": "building", "fl": "floor", "flr": "floor", "ste": "suite", "opp": "opposite",
    "nr": "near", "jn": "junction", "jnc": "junction", "mkt": "market", "ngr": "nagar", "cly": "colony", "sec": "sector", "no": "number",
}


@lru_cache(maxsize=1)
def ascii_forms() -> tuple[str, str, dict[str, str]]:
    """What compatibility decomposition leaves in ASCII: single characters as translate strings, the rest as a map."""
    one, many = [], {}
    for cp in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= cp <= 0xDFFF or 0x3400 <= cp <= 0x9FFF or 0xAC00 <= cp <= 0xD7A3:
            continue
        to = unicodedata.normalize("NFKD", chr(cp)).encode("ascii", "ignore").decode()
        if len(to) == 1:
            one.append((chr(cp), to))
        elif to:
            many[chr(cp)] = to
    return "".join(a for a, _ in one), "".join(b for _, b in one), many


def ascii_fold(col: Column) -> Column:
    """Compatibility decomposition without anything that is not ASCII; NULL becomes ''."""
    source, target, many = ascii_forms()
    single = F.translate(F.coalesce(col, F.lit("")), source, target)
    table = F.from_json(F.lit(json.dumps(many)), "map<string,string>")
    longer = F.array_join(F.transform(F.split(single, ""), lambda c: F.coalesce(table[c], c)), "")
    whole = F.when(single.rlike(r"[^\x00-\x7F]"), F.regexp_replace(longer, r"[^\x00-\x7F]", "")).otherwise(single)
    return whole


def strip(col: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(F.coalesce(col, F.lit("")), r"^\s+|\s+$", "")


def clean(col: Column) -> Column:
    """Folded, lower case, & spelled out, everything else than letters and digits one blank."""
    text = F.replace(F.lower(ascii_fold(col)), F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(text, "[^0-9a-z]+", " "))


def expand(col: Column, table: dict[str, str]) -> Column:
    """Every token replaced by what it abbreviates, in one pass."""
    spelled = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.array_join(F.transform(F.split(col, " "), lambda t: F.coalesce(spelled[t], t)), " ")


#: The patterns of what a web site's name has around it, and of a postal code.
SITE_PARTS = ("https?://", r"www\.", "@", r"\.(com|in|co|org|net|io|biz|info|us|fr)\b")
POSTAL = "([0-9]{5,6})[^0-9]*$"


def without_sites(col: Column) -> Column:
    """Lower-case name with schemes, www., @ and common top-level domains turned into blanks."""
    out = F.lower(F.coalesce(col, F.lit("")))
    for pattern in SITE_PARTS:
        out = F.regexp_replace(out, pattern, " ")
    return out


def norm_name(col: Column) -> Column:
    return expand(clean(without_sites(col)), NAME_ABBREVIATIONS)


def core_name(norm: Column) -> Column:
    """Without legal forms and connectors anywhere; the normal name if nothing is left."""
    dropped = F.array(*[F.lit(t) for t in LEGAL_TOKENS + CONNECTOR_TOKENS])
    core = F.array_join(F.filter(F.split(norm, " "), lambda t: (t != "") & ~F.array_contains(dropped, t)), " ")
    return F.when(core == "", norm).otherwise(core)


def norm_address(col: Column) -> Column:
    return expand(clean(col), ADDRESS_ABBREVIATIONS)


def postal_code(col: Column) -> Column:
    """The last run of 5 digits or more that only other characters follow, its last six digits at most."""
    return F.regexp_extract(F.lower(ascii_fold(col)), POSTAL, 1)


def numbers(norm: Column) -> Column:
    return F.trim(F.regexp_replace(norm, "[^0-9]+", " "))


def acronym(core: Column) -> Column:
    return F.array_join(F.transform(F.split(core, " "), lambda t: F.left(t, F.lit(1))), "")


def id_list(col: Column) -> Column:
    """A comma-joined cell as an array: trimmed, without empty positions and repeats, in order."""
    parts = F.transform(F.split(F.coalesce(col, F.lit("")), ","), lambda x: F.trim(x))
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def bigrams(col: Column) -> Column:
    """The set of character pairs; a text of one character or none is its own only member."""
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.length(col) - 1, F.lit(1))), lambda i: F.substr(col, i, F.lit(2)))
    return F.array_distinct(pairs)


def jaccard(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))


def bigram_similarity(a: Column, b: Column) -> Column:
    """Letter pairs in common of two texts, whatever their case."""
    return jaccard(bigrams(F.lower(a)), bigrams(F.lower(b)))


def tokens(col: Column) -> Column:
    """Distinct tokens of a normal form; none for ''."""
    return F.array_distinct(F.filter(F.split(col, " "), lambda t: t != ""))


#: The patterns of contact keys; phones are looked for where everything but digits is blank.
PHONE = r"\d{10,12}"
EMAIL = r"[a-z0-9._%+-]+@[a-z0-9-]+\.[a-z0-9.-]+"
DOMAIN = r"[a-z0-9][a-z0-9-]*\.(?:com|in|co|org|net|io|biz|info|us|fr)"
LONG_NUMBER = r"\p{Nd}{7,}"


def contact_keys(blob: Column) -> dict[str, Column]:
    """Sets of phones (their last ten digits), e-mails, domains and long numbers in a lower-case text."""
    every = lambda text, pattern: F.regexp_extract_all(text, F.lit(f"({pattern})"), 1)
    return {
        "phones": F.array_distinct(F.transform(every(F.regexp_replace(blob, "[^0-9]", " "), PHONE), lambda x: F.right(x, F.lit(10)))),
        "emails": F.array_distinct(every(blob, EMAIL)),
        "domains": F.array_distinct(every(blob, DOMAIN)),
        "long_numbers": F.array_distinct(every(blob, LONG_NUMBER)),
    }


def composed(name: Column, address: Column, country: Column) -> Column:
    """One line of text for a reranker."""
    return F.trim(F.concat_ws(" | ", *[F.coalesce(c, F.lit("")) for c in (name, address, country)]))
