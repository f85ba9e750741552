"""DuckDB SQL of the queries that SQL can express over whole tables."""

from __future__ import annotations

from weftlink.llm.lookalike import rules


def _look(column: str) -> str:
    source, target, several = rules()
    # DuckDB's translate drops the characters beyond the target as well
    quoted = [x.replace("'", "''") for x in (source, target)]
    out = f"translate({column}, '{quoted[0]}', '{quoted[1]}')"
    for a, b in several.items():
        out = f"replace({out}, '{a}', '{b.replace("'", "''")}')"
    return f"nfc_normalize(trim(regexp_replace({out}, ' {{2,}}', ' ', 'g')))"


SQL = {
    "p2_found": """
        WITH e AS (
          SELECT source1_entity_id, unnest(string_split(candidate_entity_ids, ',')) AS item, unnest(candidate_scores) AS score
          FROM candidate_pairs WHERE candidate_entity_ids IS NOT NULL AND source1_entity_id IS NOT NULL),
        b AS (
          SELECT source1_entity_id, trim(item) AS candidate_entity_id, max(score) AS score FROM e
          WHERE score IS NOT NULL AND (trim(item) LIKE 'S2-%' OR trim(item) LIKE 'S3-%') GROUP BY 1, 2),
        r AS (
          SELECT *, row_number() OVER (PARTITION BY source1_entity_id ORDER BY score DESC, candidate_entity_id) AS rank_no FROM b)
        SELECT source1_entity_id, candidate_entity_id, CAST(rank_no AS INT) AS rank_no FROM r WHERE rank_no <= 5
    """,
    "p3_found": f"""
        WITH v AS (
          SELECT DISTINCT entity_id AS id, 'business_name' AS field_name, business_name AS value FROM source1 WHERE business_name <> ''
          UNION ALL
          SELECT DISTINCT entity_id, 'business_address', business_address FROM source1 WHERE business_address <> ''),
        k AS (SELECT id, field_name, value, {_look("value")} AS look FROM v)
        SELECT DISTINCT a.id AS id_a, b.id AS id_b, a.field_name
        FROM k a JOIN k b ON a.field_name = b.field_name AND a.look = b.look AND a.value <> b.value AND a.id < b.id
    """,
}
