"""Conformance of result files: every broken rule as a row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftlink.functions import text as X
from weftlink.sources import records as S

ISSUES = "file string, rule string, level string, n bigint, examples string"


def _issues(offenders: DataFrame, file: str) -> DataFrame:
    """``offenders(rule, level, x)`` -> one row a rule: how many, and the first five of ``x`` in order.

    Ranks are cut to five within each subgroup before the subgroups meet, so one rule broken by all rows is no hot group.
    """
    rows = offenders.withColumn("salt", F.pmod(F.xxhash64("x"), F.lit(64)))
    counted = rows.groupBy("rule", "level", "salt").agg(F.count(F.lit(1)).alias("n")).groupBy("rule", "level").agg(F.sum("n").alias("n"))
    near = rows.withColumn("r", F.row_number().over(Window.partitionBy("rule", "level", "salt").orderBy("x"))).filter("r <= 5")
    first = near.withColumn("r", F.row_number().over(Window.partitionBy("rule", "level").orderBy("x"))).filter("r <= 5")
    examples = first.groupBy("rule", "level").agg(F.array_join(F.sort_array(F.collect_list("x")), ",").alias("examples"))
    return counted.join(examples, ["rule", "level"]).select(F.lit(file).alias("file"), "rule", "level", "n", "examples")


def validate_lines(lines: DataFrame, file: str, list_col: str, s1_ids: DataFrame, target_ids: DataFrame | None, mode: str = "official") -> DataFrame:
    """Issues of one two-column file given as ``lines(line_no, value)``, line 1 being the header.

    strict: a missing tab is tolerated and target ids are always looked up (give them).
    official: a line without a tab is an error, blank lines are skipped, ids are looked up only
    if ``target_ids`` is given.  A row of a repeated id is an issue; so are ids missing or
    unexpected, ids repeated in a list, S1 ids in a list, ids of another prefix.  A file without lines has a wrong header.
    """
    spark = lines.sparkSession
    cells = F.split("value", "\t", -1)
    blank = F.trim("value") == ""
    n_cells = F.size(cells)
    head = F.col("line_no") == 1
    bad = ~head & ((n_cells > 2) | ((n_cells < 2) & F.lit(mode == "official")))
    listed = F.filter(F.transform(F.split(F.coalesce(F.try_element_at(cells, F.lit(2)), F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    rows = lines.filter(~blank | head | F.lit(mode == "strict")).select(
        "line_no", head.alias("head"), bad.alias("bad"), F.lower(F.trim("value")).alias("h"), F.trim(cells[0]).alias("id"), listed.alias("ids")
    )
    found = lambda rule, condition, x: F.when(condition, F.array(F.struct(F.lit(rule).alias("rule"), x.cast("string").alias("x")))).otherwise(F.array().cast("array<struct<rule:string,x:string>>"))
    good = ~F.col("head") & ~F.col("bad")
    each = lambda rule, test: F.when(good, F.transform(F.filter("ids", test), lambda t: F.struct(F.lit(rule).alias("rule"), t.alias("x")))).otherwise(F.array().cast("array<struct<rule:string,x:string>>"))
    # the rules that a line breaks by itself, in one pass over the file
    own = rows.select(
        F.explode(
            F.concat(
                found("header", F.col("head") & (F.col("h") != f"source1_entity_id\t{list_col}"), F.col("h")),
                found("columns", F.col("bad"), F.col("line_no")),
                found("repeated id in list", good & (F.size("ids") != F.size(F.array_distinct("ids"))), F.col("id")),
                each("self match", lambda t: t.startswith("S1-")),
                each("wrong prefix", lambda t: ~t.startswith("S1-") & ~t.rlike("^S[23]-")),
            )
        ).alias("o")
    ).select("o.rule", "o.x")
    listed_ids = rows.filter(good).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    expected = s1_ids.select(F.col(s1_ids.columns[0]).alias("id")).distinct().withColumn("wanted", F.lit(True))
    both = listed_ids.join(expected, "id", "full").select(
        F.explode(
            F.concat(
                found("repeated row", F.col("n") > 1, F.col("id")),
                found("unexpected id", F.col("wanted").isNull(), F.col("id")),
                found("missing id", F.col("n").isNull(), F.col("id")),
            )
        ).alias("o")
    ).select("o.rule", "o.x")
    out = own.unionByName(both).unionByName(_no_header(lines, spark))
    if target_ids is not None:
        known = target_ids.select(F.col(target_ids.columns[0]).alias("t")).distinct()
        some = rows.filter(good).select(F.explode("ids").alias("t")).filter(F.col("t").rlike("^S[23]-")).distinct()
        out = out.unionByName(some.join(known, "t", "left_anti").select(F.lit("unknown target").alias("rule"), F.col("t").alias("x")))
    return _issues(out.withColumn("level", F.lit("error")), file)


def _no_header(lines: DataFrame, spark: SparkSession) -> DataFrame:
    """The header's issue of a file without any line."""
    one = spark.range(1).select(F.lit(1).cast("bigint").alias("line_no"))
    there = lines.filter("line_no = 1").select(F.col("line_no").cast("bigint").alias("line_no"))
    return one.join(there, "line_no", "left_anti").select(F.lit("header").alias("rule"), F.lit("").alias("x"))


def validate_subset(matches: DataFrame, candidates: DataFrame, mode: str = "official") -> DataFrame:
    """An issue if a matched (s1_id, cand_id) is not a candidate: an error when strict, else a warning."""
    outside = matches.select("s1_id", "cand_id").distinct().join(candidates.select("s1_id", "cand_id").distinct(), ["s1_id", "cand_id"], "left_anti")
    pair = outside.select(F.concat_ws(">", "s1_id", "cand_id").alias("pair"))
    level = "error" if mode == "strict" else "warning"
    return _issues(pair.select(F.lit("match is no candidate").alias("rule"), F.lit(level).alias("level"), F.col("pair").alias("x")), "matching_results")


def exit_code(issues: DataFrame) -> int:
    """1 if there is any error; warnings alone give 0."""
    return int(issues.filter("level = 'error'").limit(1).count() > 0)


def validate_files(spark: SparkSession, candidates: str, matches: str, data_dir: str, mode: str = "official", check_ids: bool = False) -> DataFrame:
    """Issues of both result files against the sources of the test split.

    Target ids are looked up when strict, or when ``check_ids`` is set; a missing source is a warning then and its look-up is skipped.
    """
    try:
        paths = S.resolve_paths(spark, data_dir, "test")
        targets = S.read_ids(spark, paths["source2"]).unionByName(S.read_ids(spark, paths["source3"])) if mode == "strict" or check_ids else None
        skipped = None
    except FileNotFoundError as e:
        paths, targets = S.resolve_paths(spark, data_dir, "test", ("source1",)), None
        skipped = spark.createDataFrame([("matching_results", "target look-up skipped", "warning", 1, str(e))], ISSUES)
    ids = S.read_ids(spark, paths["source1"])
    out, pairs = skipped, {}
    for file, column, path in (("candidate_pairs", "candidate_entity_ids", candidates), ("matching_results", "matched_entity_ids", matches)):
        lines = S.read_lines(spark, path)
        found = validate_lines(lines, file, column, ids, targets, mode)
        out = found if out is None else out.unionByName(found)
        cells = F.split("value", "\t", -1)
        pairs[file] = lines.filter("line_no > 1").select(F.trim(cells[0]).alias("s1_id"), F.explode(X.id_list(F.try_element_at(cells, F.lit(2)))).alias("cand_id"))
    return out.unionByName(validate_subset(pairs["matching_results"], pairs["candidate_pairs"], mode))
