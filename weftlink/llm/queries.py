"""Queries of the subpackage; each reads whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.llm import addresses, langid, lookalike, matching, mixing, names, packing, topn
from weftlink.session import cut, table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = topn.list_items(table(spark, sf_dir, "candidate_pairs"), "source1_entity_id", "candidate_entity_ids", "candidate_scores")
    return topn.top_n(items, 5).select(
        F.col("grp").alias("source1_entity_id"), F.col("item").alias("candidate_entity_id"), "rank_no"
    )


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.same_look_pairs(table(spark, sf_dir, "source1"), "entity_id", ["business_name", "business_address"])


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return addresses.same_building(table(spark, sf_dir, "source1"), "entity_id", "business_address", "country")


def p4_buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return addresses.buildings(table(spark, sf_dir, "source1"), "entity_id", "business_address", "country")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.same_organisation(table(spark, sf_dir, "source1"), "entity_id", "business_name")


def p5_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.name_classes(table(spark, sf_dir, "source1"), "business_name").select("name", "class_id")


def p6_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    def records(name: str) -> DataFrame:
        t = table(spark, sf_dir, name)
        return t.select(F.col("entity_id").alias("id"), F.col("business_name").alias("name"), F.col("business_address").alias("address"), "country")

    labels = matching.latest_labels(table(spark, sf_dir, "match_labels"), "source1_entity_id", "matched_entity_ids", "labelled_at")
    return matching.cascade(records("source1"), records("source2").unionByName(records("source3")), labels)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_matches(spark, sf_dir).select(
        F.col("reference_id").alias("source1_entity_id"), F.col("target_id").alias("matched_entity_id")
    )


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "pack_specs"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packed(spark, sf_dir).filter("pack_name = 'large' AND n_pieces > 1").select("doc_id").distinct()


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packed(spark, sf_dir)


def p7_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.usage(_packed(spark, sf_dir), table(spark, sf_dir, "pack_specs"))


def _mixed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixed(spark, sf_dir)[1].filter("NOT reachable").select("mix_id", "source")


def p8_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixed(spark, sf_dir)[0]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixed(spark, sf_dir)[1]


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.segments(docs, "doc_id", "text", "lang", langid.train(docs, "doc_id", "text", "lang"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.mislabelled(_segments(spark, sf_dir))


def p9_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(spark, sf_dir)


def p9_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs, "doc_id", "text", "lang")
    parts = cut(langid.segments(docs, "doc_id", "text", "lang", model))
    return langid.document_languages(parts).unionByName(langid.unsure_languages(docs, "doc_id", "text", "lang", model, parts))


QUERIES = {
    "p2_found": p2_found,
    "p3_found": p3_found,
    "p4_found": p4_found,
    "p4_buildings": p4_buildings,
    "p5_found": p5_found,
    "p5_classes": p5_classes,
    "p6_found": p6_found,
    "p6_matches": p6_matches,
    "p7_found": p7_found,
    "p7_containers": p7_containers,
    "p7_usage": p7_usage,
    "p8_found": p8_found,
    "p8_copies": p8_copies,
    "p8_shares": p8_shares,
    "p9_found": p9_found,
    "p9_segments": p9_segments,
    "p9_documents": p9_documents,
}
