"""Matches records of one source to others that share no key, by a cascade of exact joins.

Every record gets attributes: its building (gazetteer), the class of its name (segment join) and
weaker forms of both.  Rules join on ever weaker combinations of them, a few of like strength a pass; targets that a
pass resolves are taken out before the next.  Where a record has one key, the join meets one row a key on the
reference side; where pairs can share several, a target is compared with every different name in its building. In
buildings of very many names only those that share a key are met, and keys of very many such rows are salted.  A rule's confidence is its precision on the labelled records,
smoothed; rules below the least confidence give no matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftlink.llm.addresses import buildings
from weftlink.llm.names import name_classes
from weftlink.session import cut


def described(sources: DataFrame) -> DataFrame:
    """``sources(id, name, address, country, side)`` with all attributes that rules use, one row an id, checkpointed.

    Of rows that repeat an id the least (by side, name, address, country) counts.
    """
    once = cut(sources.filter("id IS NOT NULL").groupBy("id").agg(F.min(F.struct("side", "name", "address", "country")).alias("r")).select("id", "r.*"))
    at = buildings(once, "id", "address", "country").select("id", "building", "number", "street", "town", "post")
    named = name_classes(once, "name", forms=True).drop("initials")
    return cut(
        once.join(at.hint("merge"), "id", "left")
        .join(named.hint("merge"), "name", "left")
        .select(
            "id", "side", "class_id", "core", "parts", "common", "plain", "letters", "head", F.coalesce("acronym", F.lit(False)).alias("acronym"),
            "building", "number", "street", "town", "post", F.lower(F.regexp_replace("address", r"[\s,.]+", " ")).alias("line"),
        )
    )


def _both(*cols: Column) -> Column:
    """One key of several attributes; NULL if one is missing or empty."""
    whole = F.lit(True)
    for c in cols:
        whole = whole & c.isNotNull() & (c.cast("string") != "")
    return F.when(whole, F.concat_ws("\u0001", *[c.cast("string") for c in cols]))


#: Words of which two records of one building can share several: those of at least four letters, and those of at least five
#: with all forms that lack a letter.
_WORDS = "filter(parts, w -> length(w) >= 4)"
_SPELLED = (
    "flatten(transform(filter(parts, p -> length(p) >= 5), p -> concat(array(p), "
    "transform(sequence(1, length(p)), i -> concat(substring(p, 1, i - 1), substring(p, i + 1))))))"
)


Rule = tuple[str, Column, Column, Column, Column, bool]


def passes() -> list[list[Rule]]:
    """Rules by pass, each weaker than those before it: (name, reference keys, target keys,
    reference condition, target condition, only if one reference record has the key)."""
    c = F.col
    always = F.lit(True)
    no_address = c("building").isNull()
    no_name = c("class_id").isNull()
    one = lambda k: F.array(k)
    part = F.transform(F.expr(_WORDS), lambda w: _both(w, c("building")))
    word = F.transform(c("common"), lambda w: _both(w, c("building")))
    # errors that swap letters leave the letters as they are; others leave all but one
    sorted_letters = F.when(F.length("core") >= 6, F.array_join(F.sort_array(F.split("core", "")), ""))
    spelled = F.transform(F.expr(_SPELLED), lambda w: _both(w, c("building")))
    start = F.transform(c("common"), lambda w: _both(w, F.when(F.length("core") >= 6, F.left(c("core"), F.lit(3))), c("building")))
    end = F.transform(c("common"), lambda w: _both(w, F.when(F.length("core") >= 6, F.right(c("core"), F.lit(3))), c("building")))
    every = [
        ("same name and address", one(_both(c("plain"), c("line"))), one(_both(c("plain"), c("line"))), always, always, False),
        ("same name, building", one(_both(c("plain"), c("building"))), one(_both(c("plain"), c("building"))), always, always, False),
        ("name class, same address", one(_both(c("class_id"), c("line"))), one(_both(c("class_id"), c("line"))), always, always, False),
        ("name class, building", one(_both(c("class_id"), c("building"))), one(_both(c("class_id"), c("building"))), always, always, False),
        ("word of the name, building", part, part, always, always, False),
        ("initials, building", one(_both(c("letters"), c("building"))), one(_both(c("letters"), c("building"))), ~c("acronym"), c("acronym"), False),
        ("acronym of the reference, building", one(_both(c("letters"), c("building"))), one(_both(c("letters"), c("building"))), c("acronym"), ~c("acronym"), False),
        ("first letter of an acronym, building", one(_both(F.left(c("core"), F.lit(1)), c("building"))), one(_both(c("head"), c("building"))), ~c("acronym"), c("acronym"), True),
        ("letters of the name, building", one(_both(sorted_letters, c("building"))), one(_both(sorted_letters, c("building"))), always, always, False),
        ("word within a letter, building", spelled, spelled, always, always, False),
        ("start of the name, trade, building", start, start, always, always, True),
        ("end of the name, trade, building", end, end, always, always, True),
        ("name class, number, postcode", one(_both(c("class_id"), c("number"), c("post"))), one(_both(c("class_id"), c("number"), c("post"))), always, always, False),
        ("name class, number, street", one(_both(c("class_id"), c("number"), c("street"))), one(_both(c("class_id"), c("number"), c("street"))), always, always, False),
        ("name class, number, town", one(_both(c("class_id"), c("number"), c("town"))), one(_both(c("class_id"), c("number"), c("town"))), always, always, False),
        ("name class, no address of the target", one(_both(c("class_id"))), one(_both(c("class_id"))), always, no_address, True),
        ("name class, no address of the reference", one(_both(c("class_id"))), one(_both(c("class_id"))), no_address, always, True),
        ("building, no name of the target", one(_both(c("building"))), one(_both(c("building"))), always, no_name, True),
        ("building, no name of the reference", one(_both(c("building"))), one(_both(c("building"))), no_name, always, True),
        ("trade, building", word, word, always, always, True),
    ]
    sizes = [4, 4, 4, 3, 4, 1]
    starts = [sum(sizes[:i]) for i in range(len(sizes))]
    return [every[a : a + n] for a, n in zip(starts, sizes)]


#: Rules of which a pair can share several keys, all made of the parts of the name and the building: whom most keys
#: name is only known once every record of a key is met.
_SEVERAL = {"word of the name, building": _WORDS, "word within a letter, building": _SPELLED}
#: Rows of one key that a task meets at once.
_HOT = 1000
#: Different names up to which all of a building are compared with a target as they are; in others keys are met.
_CROWD = 32


def cascade(reference: DataFrame, targets: DataFrame, labels: DataFrame, least: float = 0.5, prior: float = 0.5, weight: float = 4.0) -> DataFrame:
    """(reference_id, target_id, rule_no, rule, confidence).

    ``reference`` and ``targets`` have id, name, address, country; ``labels(id, ids)`` is the
    set of right targets of labelled reference records.  A target gets at most one reference
    record: of the first rule that finds one, with most keys in common, then the smallest id;
    rules marked so skip keys that several reference records share.  Missing names and addresses
    take part in the rules for what is left; without both a record matches nothing.  Repeated
    target ids count once.  Confidence is (right + prior * weight) / (judged + weight) over a
    rule's pairs with a labelled reference record.
    """
    records = described(reference.withColumn("side", F.lit(0)).unionByName(targets.withColumn("side", F.lit(1))).select("id", "name", "address", "country", "side"))
    ours, theirs = records.filter("side = 0"), records.filter("side = 1")
    truth = cut(labels.select("id", F.explode_outer("ids").alias("right_id")))
    judged = truth.select("id").distinct()
    right = truth.filter("right_id IS NOT NULL").distinct()
    # records of the same parts in one building share the same keys with any target: the smallest id stands for them
    alike = ours.filter("building <> '' AND size(parts) > 0").groupBy("building", "parts").agg(F.min("id").alias("id"))
    alike = cut(alike.withColumn("crowd", F.count(F.lit(1)).over(Window.partitionBy("building"))))
    done, names, first = None, {}, 1
    for group in passes():
        numbered = dict(enumerate(group, first))
        first += len(group)
        names |= {k: r[0] for k, r in numbered.items()}
        single = [k for k, r in numbered.items() if r[5]]
        several = {k: (r[3], r[1]) for k, r in numbered.items() if r[0] in _SEVERAL}
        one = _keyed(ours, {k: (r[3], r[1]) for k, r in numbered.items() if k not in several})
        by_key = one.groupBy("k", "k2", "rule_no").agg(F.min("id").alias("reference_id"), F.count(F.lit(1)).alias("m"))
        by_key = by_key.filter((F.col("m") == 1) | ~F.col("rule_no").isin(single)).drop("m")
        left_over = theirs if done is None else theirs.join(done.select(F.col("target_id").alias("id")).hint("merge"), "id", "left_anti")
        asked = _keyed(left_over, {k: (r[4], r[2]) for k, r in numbered.items() if k not in several}).withColumnRenamed("id", "target_id")
        met = asked.join(by_key.hint("merge"), ["k", "k2", "rule_no"])
        hits = met.repartition("target_id").groupBy("target_id", "rule_no", "reference_id").agg(F.count(F.lit(1)).alias("shared"))
        if several:
            hits = hits.unionByName(_beside(left_over, alike, {k: _SEVERAL[names[k]] for k in several}))
            # where a building has very many names, only those that share a key are met
            crowded = alike.filter(F.col("crowd") > _CROWD)
            among = left_over.join(crowded.select("building").distinct(), "building", "left_semi")
            asked = _keyed(among, {k: (r[4], r[2]) for k, r in numbered.items() if k in several}).withColumnRenamed("id", "target_id")
            hits = hits.unionByName(_met(asked, _keyed(crowded, several)).repartition("target_id").groupBy("target_id", "rule_no", "reference_id").agg(F.count(F.lit(1)).alias("shared")))
        best = hits.groupBy("target_id", "rule_no").agg(F.min(F.struct(-F.col("shared"), "reference_id")).reference_id.alias("reference_id"))
        found = cut(best)
        trusted = set(numbered)
        while True:
            chosen = found.filter(F.col("rule_no").isin(sorted(trusted))).groupBy("target_id").agg(F.min(F.struct("rule_no", "reference_id")).alias("x")).select("target_id", "x.*")
            poor = {k for k, c in _precision(chosen, judged, right, prior, weight).items() if c < least}
            if not poor:
                break
            trusted -= poor
        # all that is resolved is written again with each pass: it is small, and so are the plans that read it
        done = cut(chosen if done is None else done.unionByName(chosen))
    confidence = _precision(done, judged, right, prior, weight)
    of = lambda values: F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[F.col("rule_no")]
    sure = {k: confidence.get(k, prior) for k in names}
    return done.select("reference_id", "target_id", "rule_no", of(names).alias("rule"), of(sure).alias("confidence"))


def _beside(targets: DataFrame, alike: DataFrame, words: dict[int, str]) -> DataFrame:
    """(target_id, rule_no, reference_id, shared): how many words targets share with the reference records of their building."""
    of = {k: F.array_distinct(F.expr(w)) for k, w in words.items()}
    theirs = targets.filter("building <> '' AND size(parts) > 0").select("building", F.col("id").alias("target_id"), *[w.alias(f"t{k}") for k, w in of.items()])
    ours = alike.filter(F.col("crowd") <= _CROWD).select("building", F.col("id").alias("reference_id"), *[w.alias(f"r{k}") for k, w in of.items()])
    shared = [F.struct(F.lit(k).alias("rule_no"), F.size(F.array_intersect(f"t{k}", f"r{k}")).cast("long").alias("shared")) for k in words]
    rows = theirs.join(ours.hint("merge"), "building").select("target_id", "reference_id", F.explode(F.array(*shared)).alias("s"))
    return rows.select("target_id", "s.rule_no", "reference_id", "s.shared").filter("shared > 0")


def _met(asked: DataFrame, every: DataFrame) -> DataFrame:
    """(target_id, rule_no, k, k2, reference_id): every target with every reference record of its key, hot keys salted."""
    # at most one key in a thousand rows is here; whether that is little enough to be broadcast, the measured size decides
    hot = every.groupBy("k", "k2", "rule_no").agg(F.ceil(F.count(F.lit(1)) / _HOT).cast("int").alias("salts")).filter("salts > 1")
    ours = every.withColumnRenamed("id", "reference_id").join(hot, ["k", "k2", "rule_no"], "left")
    ours = ours.withColumn("salt", F.pmod(F.xxhash64("reference_id"), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")
    theirs = asked.join(hot, ["k", "k2", "rule_no"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
    return theirs.join(ours.hint("merge"), ["k", "k2", "rule_no", "salt"]).drop("salt")


def _keyed(records: DataFrame, keys: dict[int, tuple[Column, Column]]) -> DataFrame:
    """(id, rule_no, k, k2): the keys of every rule whose condition holds, as two hashes, 128 bits of rule and key."""
    each = [
        F.when(condition, F.transform(F.array_distinct(array), lambda x: F.struct(F.lit(k).alias("rule_no"), x.alias("k")))) for k, (condition, array) in keys.items()
    ]
    none = F.array().cast("array<struct<rule_no:int,k:string>>")
    every = F.flatten(F.array(*[F.coalesce(e, none) for e in each]))
    rows = records.select("id", F.explode(F.filter(every, lambda r: r.k.isNotNull())).alias("r"))
    return rows.select("id", "r.rule_no", F.xxhash64("r.rule_no", "r.k").alias("k"), F.xxhash64("r.k", "r.rule_no").alias("k2"))


def _precision(found: DataFrame, judged: DataFrame, right: DataFrame, prior: float, weight: float) -> dict[int, float]:
    """Smoothed share of right pairs by rule, over pairs with a labelled reference record."""
    rows = (
        found.join(judged.hint("merge"), F.col("reference_id") == judged["id"], "left_semi")
        .join(right.hint("merge"), (F.col("reference_id") == right["id"]) & (F.col("target_id") == right["right_id"]), "left")
        .groupBy("rule_no")
        .agg(F.count(F.lit(1)).alias("n"), F.count("right_id").alias("tp"))
        .collect()
    )
    return {r["rule_no"]: (r["tp"] + prior * weight) / (r["n"] + weight) for r in rows}


def latest_labels(labels: DataFrame, id_col: str, ids_col: str, at_col: str) -> DataFrame:
    """(id, ids): the list of each id's latest row; NULL or empty lists become empty arrays."""
    ids = F.array_distinct(F.filter(F.transform(F.split(F.coalesce(F.col(ids_col), F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != ""))
    rows = labels.select(F.col(id_col).alias("id"), F.coalesce(F.col(at_col).cast("timestamp"), F.lit("1900-01-01").cast("timestamp")).alias("at"), F.sort_array(ids).alias("ids"))
    return rows.filter("id IS NOT NULL").groupBy("id").agg(F.max(F.struct("at", "ids")).ids.alias("ids"))
