"""Synthetic sources with noise, hard negatives, distractors and hidden truth, as one declarative plan.

Every random draw is a hash of the seed, the entity and the draw's name, so rows do not depend
on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.sources.records import write_file

SYLLABLES = "ba ren to mi lar ves kon du sel pra nor ti gal ome zu fer lin dos har vex".split()
SECTORS = "Foods Textiles Motors Pharma Logistics Steel Media Software Energy Chemicals".split()
SUFFIXES = {"US": ["Inc", "LLC", "Corp", "Company"], "India": ["Pvt Ltd", "Limited", "LLP"], "France": ["SARL", "SAS", "SA"]}
CITIES = {"US": "Austin Boston Denver Seattle Chicago".split(), "India": "Pune Mumbai Chennai Delhi Jaipur".split(), "France": "Lyon Nantes Lille Paris Nice".split()}
STREETS = {"US": "Oak Main Cedar Pine Lake".split(), "India": "Gandhi Nehru Tilak Station Temple".split(), "France": "Victor Hugo Pasteur Moulin Gare".split()}
LANDMARKS = ["Near City Mall", "Opp Central Station", "Behind Town Hall", "Next to Old Market", "Beside the Clock Tower"]
SHORT = {"Limited": "Ltd", "Company": "Co", "Corp": "Corporation", "Inc": "Incorporated", "Road": "Rd", "Street": "St", "Avenue": "Ave"}


def _u(seed: int, *parts: object) -> Column:
    """A uniform number in [0, 1) from a hash of the parts."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 40)) / F.lit(float(1 << 40))


def _pick(values: list[str], u: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.floor(u * len(values)) + 1).cast("int"))


def _by_country(table: dict[str, list[str]], u: Column) -> Column:
    out = F.lit("")
    for country, values in table.items():
        out = F.when(F.col("country") == country, _pick(values, u)).otherwise(out)
    return out


def _word(seed: int, tag: str) -> Column:
    return F.initcap(F.concat(*[_pick(SYLLABLES, _u(seed, F.col("e"), tag, i)) for i in range(3)]))


def typo(col: Column, seed: int, *tag: object) -> Column:
    """One letter swapped with the next, left out or doubled; texts under four letters stay."""
    at = (F.floor(_u(seed, col, *tag, "at") * (F.length(col) - 2)) + 2).cast("int")
    kind = F.floor(_u(seed, col, *tag, "kind") * 3)
    head, one, two, rest = F.substr(col, F.lit(1), at - 1), F.substr(col, at, F.lit(1)), F.substr(col, at + 1, F.lit(1)), F.substr(col, at + 2)
    changed = F.when(kind == 0, F.concat(head, two, one, rest)).when(kind == 1, F.concat(head, two, rest)).otherwise(F.concat(head, one, one, two, rest))
    return F.when(F.length(col) >= 4, changed).otherwise(col)


def _swap_forms(col: Column, u: Column) -> Column:
    """Long forms abbreviated (0.6) or short ones spelled out (0.3), token by token."""
    short = F.create_map(*[F.lit(x) for kv in SHORT.items() for x in kv])
    long = F.create_map(*[F.lit(x) for k, v in SHORT.items() for x in (v, k)])
    each = F.split(col, " ")
    return F.when(u < 0.6, F.array_join(F.transform(each, lambda t: F.coalesce(short[t], t)), " ")).when(u < 0.9, F.array_join(F.transform(each, lambda t: F.coalesce(long[t], t)), " ")).otherwise(col)


def _brand(seed: int, n: int) -> Column:
    """A word of syllables that no other of the ``n`` entities has: the entity's number, mixed one to one, in base 20."""
    size = 3
    while len(SYLLABLES) ** size < n:
        size += 1
    # the factor has no divisor in common with the base
    mixed = F.pmod(F.col("e") * 7919 + seed, F.lit(len(SYLLABLES) ** size))
    digit = lambda i: F.pmod(F.floor(mixed / F.lit(len(SYLLABLES) ** i)), F.lit(len(SYLLABLES)))
    return F.initcap(F.concat(*[F.element_at(F.array(*[F.lit(v) for v in SYLLABLES]), (digit(i) + 1).cast("int")) for i in range(size)]))


def entities(spark: SparkSession, countries: dict[str, int], seed: int = 42) -> DataFrame:
    """(e, country, name, address): canonical organisations, so many a country, each with a first word of its own."""
    rows, start = None, 0
    for country, n in countries.items():
        part = spark.range(start, start + n).select(F.col("id").alias("e"), F.lit(country).alias("country"))
        rows = part if rows is None else rows.unionByName(part)
        start += n
    second = F.when(_u(seed, F.col("e"), "two") < 0.5, F.concat(F.lit(" "), _word(seed, "b"))).otherwise("")
    name = F.concat(_brand(seed, start), second, F.lit(" "), _pick(SECTORS, _u(seed, F.col("e"), "sector")), F.lit(" "), _by_country(SUFFIXES, _u(seed, F.col("e"), "suffix")))
    number = (F.floor(_u(seed, F.col("e"), "no") * 899) + 100).cast("int")
    code = F.when(F.col("country") == "India", F.floor(_u(seed, F.col("e"), "zip") * 899_999) + 100_000).otherwise(F.floor(_u(seed, F.col("e"), "zip") * 89_999) + 10_000).cast("int")
    street, city = _by_country(STREETS, _u(seed, F.col("e"), "street")), _by_country(CITIES, _u(seed, F.col("e"), "city"))
    drawn = rows.select("e", "country", name.alias("name"), number.alias("no"), code.alias("code"), street.alias("street"), city.alias("city"))
    address = (
        F.when(F.col("country") == "US", F.format_string("%d %s Street, %s %d", "no", "street", "city", "code"))
        .when(F.col("country") == "India", F.format_string("%d %s Road, %s - %d", "no", "street", "city", "code"))
        .otherwise(F.format_string("%d Rue %s, %d %s", "no", "street", "code", "city"))
    )
    return drawn.select("e", "country", "name", address.alias("address"))


def noisy(rows: DataFrame, seed: int) -> DataFrame:
    """Names and addresses of copies (e, copy, country, name, address) with spelling habits, errors and gaps."""
    u = lambda *t: _u(seed, F.col("e"), F.col("copy"), *t)
    w = F.split("n2", " ")
    kind = F.col("kind")
    # one column a step, so that no expression is written out twice in the plan
    steps = {
        "bare": F.array_join(F.slice(F.split("name", " "), 1, F.greatest(F.size(F.split("name", " ")) - 1, F.lit(1))), " "),
        "n1": _swap_forms(F.col("name"), u("forms")),
        "n2": F.when(u("drop") < 0.15, F.col("bare")).otherwise(F.col("n1")),
        "n3": F.when((u("swap") < 0.3) & (F.size(w) > 2), F.concat_ws(" ", w[1], w[0], F.array_join(F.slice(w, 3, 20), " "))).otherwise(F.col("n2")),
        # the error is in one word of the name
        "bad": (F.floor(u("word") * F.size(F.split("n3", " ")))).cast("int"),
        "n4": F.when(
            u("typo") < 0.4,
            F.array_join(F.transform(F.split("n3", " "), lambda t, i: F.when(i == F.col("bad"), typo(t, seed, "name")).otherwise(t)), " "),
        ).otherwise(F.col("n3")),
        "squish": F.lower(F.replace("bare", F.lit(" "), F.lit(""))),
        "kind": u("kind"),
        "rebrand": F.concat(_word(seed, "rebrand"), F.lit(" "), F.element_at(F.split("name", " "), -1)),
        "business_name": F.trim(
            F.when(kind < 0.15, F.concat(F.lit("www."), F.col("squish"), F.lit(".com")))
            .when(kind < 0.22, F.concat(F.lit("@"), F.col("squish")))
            .when(kind < 0.32, F.col("rebrand"))
            .otherwise(F.col("n4"))
        ),
        "a1": F.when(u("code") < 0.35, F.regexp_replace("address", r"[ -]*[0-9]{5,6}", "")).otherwise(F.col("address")),
        "a2": F.when((u("part") < 0.30) & F.col("a1").contains(", "), F.split("a1", ", ")[0]).otherwise(F.col("a1")),
        "a3": F.when(u("mark") < 0.25, F.concat("a2", F.lit(", "), _pick(LANDMARKS, u("place")))).otherwise(F.col("a2")),
        # parts in an order of their own, the same on every run
        "order": F.sort_array(F.transform(F.split("a3", ", "), lambda p, i: F.struct(F.xxhash64(F.lit(seed), "e", "copy", i).alias("h"), p.alias("p")))),
        "a4": F.when(u("turn") < 0.20, F.array_join(F.transform("order", lambda x: x.p), ", ")).otherwise(F.col("a3")),
        "business_address": F.trim(_swap_forms(F.col("a4"), u("addr"))),
    }
    out = rows
    for name, column in steps.items():
        out = out.withColumn(name, column)
    return out.drop(*[n for n in steps if not n.startswith("business_")])


def split(spark: SparkSession, countries: dict[str, int], seed: int = 42) -> dict[str, DataFrame]:
    """source1, source2, source3 and ground_truth of one split."""
    base = entities(spark, countries, seed)
    s1_id = F.format_string("S1-%08d", "e")
    u = lambda *t: _u(seed, F.col("e"), *t)
    n2 = F.when(u("n2") < 0.35, 0).when(u("n2") < 0.85, 1).otherwise(2)
    n3 = F.when(u("n3") < 0.45, 0).when(u("n3") < 0.90, 1).otherwise(2)
    out = {"source1": base.select(s1_id.alias("entity_id"), F.col("name").alias("business_name"), F.col("address").alias("business_address"), "country")}
    pairs = None
    for k, n in ((2, n2), (3, n3)):
        copies = base.withColumn("copy", F.explode(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))))
        right = noisy(copies, seed + k).withColumn("tag", F.lit("m"))
        # the same name somewhere else, and organisations that source 1 does not have
        elsewhere = base.filter(u("hard", k) < 0.35).withColumn("copy", F.lit(90 + k))
        moved = elsewhere.withColumn("address", F.regexp_replace("address", "^[0-9]+", (F.floor(u("moved", k) * 899) + 1000).cast("string")))
        hard = noisy(moved, seed + k).withColumn("tag", F.lit("h"))
        strangers = base.filter(u("stranger", k) < 0.60).withColumn("copy", F.lit(70 + k))
        other = noisy(strangers.withColumns({"name": F.concat(_word(seed + 7, f"s{k}"), F.lit(" "), F.element_at(F.split("name", " "), -1)), "address": F.regexp_replace("address", "^[0-9]+", (F.floor(u("far", k) * 899) + 2000).cast("string"))}), seed + k).withColumn("tag", F.lit("d"))
        target_id = F.concat(F.lit(f"S{k}-"), F.format_string("%08d%s%02d", "e", "tag", "copy"))
        rows = right.unionByName(hard).unionByName(other).withColumn("entity_id", target_id)
        out[f"source{k}"] = rows.select("entity_id", "business_name", "business_address", "country")
        these = rows.filter("tag = 'm'").select(s1_id.alias("id"), "entity_id")
        pairs = these if pairs is None else pairs.unionByName(these)
    lists = pairs.groupBy("id").agg(F.sort_array(F.collect_list("entity_id")).alias("l"))
    out["ground_truth"] = out["source1"].select(F.col("entity_id").alias("id")).join(lists, "id", "left").select(
        F.col("id").alias("source1_entity_id"), F.coalesce(F.array_join("l", ","), F.lit("")).alias("matched_entity_ids")
    )
    return out


def write_split(spark: SparkSession, folder: str, name: str, countries: dict[str, int], seed: int = 42, hidden: bool = False) -> None:
    """One split as files; the truth of a hidden one goes to a file that no path layout finds."""
    for kind, rows in split(spark, countries, seed).items():
        truth = f"{folder}/hidden/{name}_{kind}.tsv" if hidden else f"{folder}/{name}/{name}_{kind}.tsv"
        write_file(rows, truth if kind == "ground_truth" else f"{folder}/{name}/{name}_{kind}.tsv")


def write_both(spark: SparkSession, folder: str, per_country: int = 800, unseen: int = 300, seed: int = 42) -> None:
    """A train split of two countries, and a test split with a third one that training has not seen; its truth is hidden."""
    write_split(spark, folder, "train", {"US": per_country, "India": per_country}, seed)
    write_split(spark, folder, "test", {"US": per_country, "India": per_country, "France": unseen}, seed + 1, hidden=True)
