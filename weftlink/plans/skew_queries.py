"""Queries over the skewed key problem, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.operators.skew import key_profile
from weftlink.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_profile(table(spark, sf_dir, "source1"), "country", "business_name").select(
        F.col("key").alias("country_key"), "n_records", "n_names", "mid_len"
    )


QUERIES = {"p1_found": p1_found}

SQL = {
    "p1_found": """
        WITH r AS (SELECT lower(trim(coalesce(country, ''))) AS country_key, nullif(business_name, '') AS v FROM source1),
        s AS (SELECT country_key, length(v) AS len, row_number() OVER (PARTITION BY country_key ORDER BY length(v)) AS i,
                     count(*) OVER (PARTITION BY country_key) AS k FROM r WHERE v IS NOT NULL)
        SELECT r.country_key, count(*) AS n_records, count(DISTINCT v) AS n_names,
               (SELECT CAST(max(len) AS BIGINT) FROM s WHERE s.country_key = r.country_key AND i = (k + 1) // 2) AS mid_len
        FROM r GROUP BY r.country_key
    """
}
