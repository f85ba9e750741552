"""One form for text that looks the same in print but differs in its characters.

Look-alike letters, width and font forms, spaces and invisible characters are mapped by
``translate`` inside the JVM; values are then grouped in SQL under the accent-sensitive
collation UNICODE (it takes differently encoded accents as equal and keeps case, accents and
punctuation apart), a deterministic member of each class is its canonical form, and joined back.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters of other scripts that look like a Latin letter.
LOOKALIKES = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "У": "Y",
    "І": "I", "Ј": "J", "Ѕ": "S", "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ј": "j",
    "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "Ԛ": "Q", "Ԝ": "W", "Һ": "H", "Ү": "Y",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T",
    "Υ": "Y", "Χ": "X", "ο": "o", "ϲ": "c", "ϳ": "j", "Ϲ": "C", "Ϳ": "J", "ɑ": "a", "ɡ": "g", "օ": "o", "ѵ": "v",
    "‐": "-", "‑": "-",
}


def _one(ch: str) -> str | None:
    """What ``ch`` is written as; None where it stays."""
    if ch in LOOKALIKES:
        return LOOKALIKES[ch]
    cat = unicodedata.category(ch)
    if cat == "Cf" or ch in "͏ᅟᅠ឴឵ㅤﾠ" or 0xFE00 <= ord(ch) <= 0xFE0F:
        return ""
    if cat == "Zs" or ch in "\t\n\r\x0b\x0c\x85  ":
        return " " if ch != " " else None
    tag = unicodedata.decomposition(ch).split(" ")[0]
    if tag in ("<wide>", "<narrow>", "<font>", "<compat>"):
        to = unicodedata.normalize("NFKC", ch)
        return "".join(LOOKALIKES.get(c, c) for c in to) if to[:1] != " " else None
    plain = unicodedata.normalize("NFD", ch)
    if len(plain) > 1 and plain[0] in LOOKALIKES and all(unicodedata.combining(c) for c in plain[1:]):
        return unicodedata.normalize("NFC", LOOKALIKES[plain[0]] + plain[1:])
    return None


@lru_cache(maxsize=1)
def rules() -> tuple[str, str, dict[str, str]]:
    """Source and target of ``translate`` (deletions last), and the forms of several characters."""
    single, gone, several = [], [], {}
    for cp in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= cp <= 0xDFFF or 0xAC00 <= cp <= 0xD7A3 or 0xF900 <= cp <= 0xFAD9 or cp >= 0x1F100 and cp < 0xE0000:
            continue
        to = _one(chr(cp))
        if to is None:
            continue
        if to == "":
            gone.append(chr(cp))
        elif len(to) == 1:
            single.append((chr(cp), to))
        elif ord(chr(cp)) < 0x3000 or 0xFB00 <= cp <= 0xFB06:
            if all(ord(c) < 0x250 for c in to):
                several[chr(cp)] = to
    for ch in "\t\n\r\x0b\x0c":
        single.append((ch, " "))
    return "".join(a for a, _ in single) + "".join(gone), "".join(b for _, b in single), several


def mapped(col: Column) -> Column:
    """The look-alike form of a text: one space for each run of blanks, none at the ends."""
    source, target, several = rules()
    out = F.translate(col, source, target)
    if several:
        wide = out
        for a, b in several.items():
            wide = F.replace(wide, F.lit(a), F.lit(b))
        out = F.when(out.rlike("[" + "".join(several) + "]"), wide).otherwise(out)
    return F.trim(F.regexp_replace(out, " {2,}", " "))


def table_of_characters() -> dict[int, str]:
    """The same rules for ``str.translate``."""
    source, target, several = rules()
    return {ord(a): (target[i] if i < len(target) else "") for i, a in enumerate(source)} | {ord(a): b for a, b in several.items()}


def canonical_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(field_name, value, canonical, n_forms): each different non-empty value and its canonical form.

    The canonical form of a class is the value that is its own mapped form if there is one,
    else the first by code points.  ``n_forms`` is the number of different values in the class.
    Values are folded before anything is grouped, so repeated values cost nothing.
    """
    spark = df.sparkSession
    values = None
    for c in columns:
        part = df.select(F.lit(c).alias("field_name"), F.col(c).cast("string").alias("value")).filter("value <> ''").distinct()
        values = part if values is None else values.unionByName(part)
    forms = values.withColumn("mapped", mapped(F.col("value")))
    return spark.sql(
        """
        WITH keyed AS (SELECT field_name, value, mapped, collate(mapped, 'UNICODE') AS look FROM {forms}),
        classes AS (
          SELECT field_name, look, count(*) AS n_forms,
                 min(struct(CASE WHEN value = mapped THEN 0 ELSE 1 END AS changed, value)).value AS canonical
          FROM keyed GROUP BY field_name, look)
        SELECT k.field_name, k.value, c.canonical, c.n_forms
        FROM keyed k JOIN classes c ON k.field_name = c.field_name AND k.look = c.look
        """,
        forms=forms,
    )


def canonicalise(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with every value of ``columns`` in its canonical form; NULL and '' stay as they are.

    Other columns are kept, whatever their names.
    """
    forms = canonical_values(df, columns)
    out = df
    for i, c in enumerate(columns):
        v, w = f"__value_{i}", f"__canonical_{i}"
        side = forms.filter((F.col("field_name") == c) & (F.col("value") != F.col("canonical"))).select(
            F.col("value").alias(v), F.col("canonical").alias(w)
        )
        out = out.join(side, F.col(c) == F.col(v), "left").withColumn(c, F.coalesce(F.col(w), F.col(c))).drop(v, w)
    return out


def same_look_pairs(df: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """(id_a, id_b, field_name): records whose values look the same but are different strings.

    Only classes of several forms take part.  Rows with a NULL id, NULL or '' give none.
    """
    forms = canonical_values(df, columns).filter("n_forms > 1")
    rows = None
    for c in columns:
        part = df.select(F.col(id_col).cast("string").alias("id"), F.lit(c).alias("field_name"), F.col(c).cast("string").alias("value"))
        rows = part if rows is None else rows.unionByName(part)
    rows = rows.filter("id IS NOT NULL AND value <> ''").distinct()
    member = rows.join(forms, ["field_name", "value"]).select("id", "field_name", "value", "canonical")
    a, b = member.alias("a"), member.alias("b")
    return (
        a.join(b, (F.col("a.field_name") == F.col("b.field_name")) & (F.col("a.canonical") == F.col("b.canonical")) & (F.col("a.value") != F.col("b.value")) & (F.col("a.id") < F.col("b.id")))
        .select(F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b"), F.col("a.field_name").alias("field_name"))
        .distinct()
    )
