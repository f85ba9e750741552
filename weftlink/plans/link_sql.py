"""DuckDB SQL of the record-linkage queries."""

from __future__ import annotations

from weftlink.functions import text as X


def _q(text: str) -> str:
    return text.replace("'", "''")


def _fold(col: str) -> str:
    source, target, many = X.ascii_forms()
    out = f"translate(coalesce({col}, ''), '{_q(source)}', '{_q(target)}')"
    for a, b in many.items():
        if 0xFB00 <= ord(a) <= 0xFB06 or a in "…½¼¾№":
            out = f"replace({out}, '{a}', '{_q(b)}')"
    return f"regexp_replace({out}, '[^\\x00-\\x7F]', '', 'g')"


def _clean(col: str) -> str:
    return f"trim(regexp_replace(replace(lower({_fold(col)}), '&', ' and '), '[^0-9a-z]+', ' ', 'g'))"


def _expand(col: str, table: dict[str, str]) -> str:
    keys = ", ".join(f"'{k}'" for k in table)
    values = ", ".join(f"'{v}'" for v in table.values())
    return f"array_to_string(list_transform(string_split({col}, ' '), lambda t: coalesce(list_extract([{values}], list_position([{keys}], t)), t)), ' ')"


def _strip(col: str) -> str:
    return f"regexp_replace(coalesce({col}, ''), '^\\s+|\\s+$', '', 'g')"


_SITES = "lower(business_name)"
for _p in ("https?://", r"www\.", "@", r"\.(com|in|co|org|net|io|biz|info|us|fr)\b"):
    _SITES = f"regexp_replace({_SITES}, '{_p}', ' ', 'g')"

_DROPPED = ", ".join(f"'{t}'" for t in X.LEGAL_TOKENS + X.CONNECTOR_TOKENS)

RAW = f"""
raw AS (
  SELECT DISTINCT {_strip('entity_id')} AS entity_id, {_strip('business_name')} AS business_name, {_strip('business_address')} AS business_address, {_strip('country')} AS country
  FROM (SELECT entity_id, business_name, business_address, country FROM source1 UNION ALL SELECT entity_id, business_name, business_address, country FROM source2
        UNION ALL SELECT entity_id, business_name, business_address, country FROM source3)
  WHERE {_strip('entity_id')} <> '')"""

NORM = (
    RAW
    + f""",
cleaned AS (
  SELECT entity_id, CAST(substr(entity_id, 2, 1) AS INT) AS source, {_clean('country')} AS country_key, {_clean(_SITES)} AS n0, {_clean('business_address')} AS a0,
         regexp_extract(lower({_fold('business_address')}), '([0-9]{{5,6}})[^0-9]*$', 1) AS postal FROM raw),
expanded AS (SELECT entity_id, source, country_key, postal, {_expand('n0', X.NAME_ABBREVIATIONS)} AS norm_name, {_expand('a0', X.ADDRESS_ABBREVIATIONS)} AS norm_addr FROM cleaned),
cored AS (SELECT *, array_to_string(list_filter(string_split(norm_name, ' '), lambda t: t <> '' AND NOT list_contains([{_DROPPED}], t)), ' ') AS c0 FROM expanded),
norm AS (
  SELECT entity_id, source, country_key, norm_name, CASE WHEN c0 = '' THEN norm_name ELSE c0 END AS core_name,
         replace(CASE WHEN c0 = '' THEN norm_name ELSE c0 END, ' ', '') AS name_squish,
         string_split(CASE WHEN c0 = '' THEN norm_name ELSE c0 END, ' ')[1] AS first_token,
         array_to_string(list_transform(string_split(CASE WHEN c0 = '' THEN norm_name ELSE c0 END, ' '), lambda t: substr(t, 1, 1)), '') AS acronym,
         CAST(length(CASE WHEN c0 = '' THEN norm_name ELSE c0 END) AS INT) AS core_len, norm_addr, postal, trim(regexp_replace(norm_addr, '[^0-9]+', ' ', 'g')) AS nums FROM cored)"""
)

SCORED = """
cells AS (SELECT source1_entity_id AS s1_id, unnest(string_split(candidate_entity_ids, ',')) AS i, unnest(candidate_scores) AS s FROM candidate_pairs WHERE candidate_entity_ids IS NOT NULL),
scored AS (
  SELECT s1_id, trim(i) AS cand_id, CAST(CASE WHEN trim(i) LIKE 'S3%' THEN 3 ELSE 2 END AS INT) AS cand_source, max(s) AS score FROM cells
  WHERE s IS NOT NULL AND (trim(i) LIKE 'S2-%' OR trim(i) LIKE 'S3-%') GROUP BY 1, 2, 3)"""

TRUTH = """
lists AS (
  SELECT trim(source1_entity_id) AS s1_id, labelled_at,
         list_sort(list_distinct(list_filter(list_transform(string_split(coalesce(matched_entity_ids, ''), ','), lambda x: trim(x)), lambda x: x <> ''))) AS matched FROM match_labels),
best AS (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY labelled_at DESC, matched DESC) AS r FROM lists),
truth AS (SELECT s1_id, matched FROM best WHERE r = 1),
pairs AS (SELECT s1_id, unnest(matched) AS cand_id FROM truth)"""

OWNED = """
owned AS (SELECT s1_id, cand_id, cand_source, score FROM (SELECT *, row_number() OVER (PARTITION BY cand_id ORDER BY score DESC, s1_id) AS r FROM scored WHERE score >= {least}) WHERE r = 1)"""


def _grams(text: str, low: int, high: int, words: bool) -> str:
    if words:
        pieces = f"words AS (SELECT entity_id, source, country_key, ' ' || unnest(string_split({text}, ' ')) || ' ' AS w FROM norm WHERE {text} <> ''), "
        n = f"unnest(range({low}, least({high}, greatest({low}, CAST(length(w) AS INT))) + 1))"
    else:
        pieces = f"words AS (SELECT entity_id, source, country_key, {text} AS w FROM norm WHERE length({text}) >= {low}), "
        n = f"unnest(range({low}, least({high}, CAST(length(w) AS INT)) + 1))"
    return (
        pieces + f"sized AS (SELECT entity_id, source, country_key, w, CAST({n} AS INT) AS n FROM words), "
        "grams AS (SELECT entity_id, source, country_key, gram, count(*) AS tf FROM (SELECT entity_id, source, country_key, "
        "unnest(list_transform(range(1, greatest(CAST(length(w) AS INT) - n, 0) + 2), lambda i: substr(w, i, n))) AS gram FROM sized) GROUP BY ALL), "
        "stats AS (SELECT gram, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total, ln((1.0 + (SELECT count(*) FROM norm)) / (1.0 + count(*))) + 1 AS idf FROM grams GROUP BY gram HAVING count(*) BETWEEN 2 AND 12000 ORDER BY total DESC, gram LIMIT 400000), "
        "raws AS (SELECT g.*, tf * idf AS x FROM grams g JOIN stats USING (gram)), "
        "weights AS (SELECT entity_id, source, country_key, gram, x / sqrt(sum(x * x) OVER (PARTITION BY entity_id)) AS w FROM raws)"
    )


def _topk(k: int, floor: float) -> str:
    return (
        "sims AS (SELECT a.entity_id AS s1_id, b.entity_id AS cand_id, b.source AS cand_source, round(sum(a.w * b.w), 6) AS cos FROM weights a JOIN weights b ON a.country_key = b.country_key AND a.gram = b.gram "
        "WHERE a.source = 1 AND b.source > 1 GROUP BY 1, 2, 3), "
        f"ranked AS (SELECT *, row_number() OVER (PARTITION BY s1_id, cand_source ORDER BY cos DESC, cand_id) AS r FROM sims WHERE cos >= {floor}), "
        f"top AS (SELECT s1_id, cand_id, cand_source, cos FROM ranked WHERE r <= {k})"
    )


def _named(prefix: str, ctes: str, names: list[str]) -> str:
    """The common table expressions with the given names prefixed, so that several chains fit one query."""
    import re

    for n in names:
        ctes = re.sub(rf"\b{n}\b(?! *\()", f"{prefix}{n}", ctes)
    return ctes


_CHAIN = ["words", "sized", "grams", "stats", "raws", "weights", "sims", "ranked", "top"]
_POSTAL = """postal_rare AS (SELECT country_key, source, postal FROM norm WHERE source > 1 AND postal <> '' GROUP BY ALL HAVING count(*) <= 40),
postal_pairs AS (SELECT a.entity_id AS s1_id, b.entity_id AS cand_id, b.source AS cand_source FROM norm a JOIN norm b ON a.country_key = b.country_key AND a.postal = b.postal
  JOIN postal_rare r ON r.country_key = b.country_key AND r.source = b.source AND r.postal = b.postal WHERE a.source = 1 AND b.source > 1 AND a.postal <> '')"""


def _cos(prefix: str, alias: str) -> str:
    """Cosine of scored pairs over one chain of weights."""
    return f"{alias} AS (SELECT p.s1_id, p.cand_id, sum(a.w * b.w) AS dot FROM scored p JOIN {prefix}weights a ON a.entity_id = p.s1_id JOIN {prefix}weights b ON b.entity_id = p.cand_id AND a.gram = b.gram GROUP BY 1, 2)"


_TOK = "list_distinct(list_filter(string_split({c}, ' '), lambda t: t <> ''))"
_F = """
attached AS (SELECT p.*, {extra} a.country_key AS a_c, b.country_key AS b_c, a.first_token AS a_f, b.first_token AS b_f, a.acronym AS a_a, b.acronym AS b_a, a.core_len AS a_l, b.core_len AS b_l,
  a.postal AS a_p, b.postal AS b_p, a.norm_addr AS a_n, b.norm_addr AS b_n,
  """ + ", ".join(f"{_TOK.format(c=f'{s}.{c}')} AS {s}_{n}" for s in "ab" for c, n in (("nums", "nums"), ("norm_addr", "t"), ("core_name", "core"))) + """
  FROM scored p JOIN norm a ON a.entity_id = p.s1_id JOIN norm b ON b.entity_id = p.cand_id {joins})"""
_UNION = "list_distinct(list_concat({a}, {b}))"

SQL = {
    "normalize_records": f"WITH {NORM} SELECT * FROM norm",
    "truth_lists": f"WITH {TRUTH} SELECT s1_id AS source1_entity_id, array_to_string(matched, ',') AS matched_ids FROM truth",
    "char_ngrams": f"WITH {NORM}, {_grams('core_name', 4, 5, True)} SELECT entity_id, gram, tf FROM grams",
    "gram_statistics": f"WITH {NORM}, {_grams('core_name', 4, 5, True)} SELECT gram, df, total, round(idf, 6) AS idf FROM stats",
    "tfidf_weights": f"WITH {NORM}, {_grams('core_name', 4, 5, True)} SELECT entity_id, gram, round(w, 6) AS w FROM weights",
    "squish_weights": f"WITH {NORM}, {_grams('name_squish', 4, 5, False)} SELECT entity_id, gram, round(w, 6) AS w FROM weights",
    "block_name_topk": f"WITH {NORM}, {_grams('core_name', 4, 5, True)}, {_topk(25, 0.06)} SELECT * FROM top",
    "block_addr_topk": f"WITH {NORM}, {_grams('norm_addr', 3, 4, True)}, {_topk(12, 0.30)} SELECT * FROM top",
    "block_squish_topk": f"WITH {NORM}, {_grams('name_squish', 4, 5, False)}, {_topk(12, 0.30)} SELECT * FROM top",
    "block_postal_capped": f"WITH {NORM}, {_POSTAL} SELECT * FROM postal_pairs",
    "block_embedding_topk": """
        WITH v AS (SELECT 'V' || vec_id AS id, CAST(vec_id % 3 + 1 AS INT) AS source, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
        s AS (SELECT a.id AS s1_id, b.id AS cand_id, b.source AS cand_source, round(list_cosine_similarity(a.v, b.v), 6) AS cos FROM v a JOIN v b ON a.label = b.label WHERE a.source = 1 AND b.source > 1),
        r AS (SELECT *, row_number() OVER (PARTITION BY s1_id, cand_source ORDER BY cos DESC, cand_id) AS r FROM s WHERE cos >= 0.1)
        SELECT s1_id, cand_id, cand_source, cos FROM r WHERE r <= 15""",
    "candidates_union": "WITH "
    + ", ".join(
        [
            NORM,
            _named("nm_", f"{_grams('core_name', 4, 5, True)}, {_topk(25, 0.06)}", _CHAIN),
            _named("ad_", f"{_grams('norm_addr', 3, 4, True)}, {_topk(12, 0.30)}", _CHAIN),
            _named("sq_", f"{_grams('name_squish', 4, 5, False)}, {_topk(12, 0.30)}", _CHAIN),
            _POSTAL,
            "every AS (SELECT s1_id, cand_id, cand_source FROM nm_top UNION SELECT s1_id, cand_id, cand_source FROM ad_top UNION SELECT s1_id, cand_id, cand_source FROM sq_top UNION SELECT s1_id, cand_id, cand_source FROM postal_pairs)",
            "dots AS (SELECT p.s1_id, p.cand_id, sum(a.w * b.w) AS dot FROM every p JOIN nm_weights a ON a.entity_id = p.s1_id JOIN nm_weights b ON b.entity_id = p.cand_id AND a.gram = b.gram GROUP BY 1, 2)",
        ]
    )
    + " SELECT e.s1_id, e.cand_id, e.cand_source, round(coalesce(dot, 0.0), 6) AS name_cos FROM every e LEFT JOIN dots USING (s1_id, cand_id)",
    "label_pairs": f"WITH {SCORED}, {TRUTH} SELECT s.*, CAST(p.cand_id IS NOT NULL AS INT) AS label FROM scored s JOIN truth t USING (s1_id) LEFT JOIN pairs p ON p.s1_id = s.s1_id AND p.cand_id = s.cand_id",
    "missed_positives": f"""WITH {SCORED}, {TRUTH}, {RAW} SELECT DISTINCT p.s1_id, p.cand_id, CAST(CASE WHEN p.cand_id LIKE 'S3%' THEN 3 ELSE 2 END AS INT) AS cand_source
        FROM pairs p SEMI JOIN raw r ON r.entity_id = p.cand_id ANTI JOIN scored s ON s.s1_id = p.s1_id AND s.cand_id = p.cand_id""",
    "blocking_recall": f"""WITH {SCORED}, {TRUTH}, hit AS (SELECT p.s1_id, count(*) AS n, count(s.cand_id) AS h FROM pairs p LEFT JOIN scored s ON s.s1_id = p.s1_id AND s.cand_id = p.cand_id GROUP BY 1)
        SELECT round(sum(h) / sum(n), 6) AS recall, CAST(sum(n) AS BIGINT) AS n_true, CAST(sum(h) AS BIGINT) AS n_found, CAST(sum(CASE WHEN n = h THEN 1 ELSE 0 END) AS BIGINT) AS full_ids, (SELECT count(*) FROM scored) AS n_pairs FROM hit""",
    "assign_unique": f"WITH {SCORED}, {OWNED.format(least=0.5)} SELECT * FROM owned",
    "matches_by_s1": f"WITH {SCORED}, {OWNED.format(least=0.5)} SELECT e.entity_id AS id, coalesce(string_agg(cand_id, ',' ORDER BY score DESC, cand_id), '') AS ids FROM (SELECT DISTINCT entity_id FROM source1) e LEFT JOIN owned o ON o.s1_id = e.entity_id GROUP BY 1",
    "grouped_id_lists": f"WITH {SCORED} SELECT e.entity_id AS id, coalesce(string_agg(cand_id, ',' ORDER BY cand_source, cand_id), '') AS ids FROM (SELECT DISTINCT entity_id FROM source1) e LEFT JOIN scored o ON o.s1_id = e.entity_id GROUP BY 1",
}

_COUNTS = f"""{SCORED}, {TRUTH}, {OWNED.format(least=0.5)},
p AS (SELECT s1_id, count(*) AS n FROM owned GROUP BY 1), t AS (SELECT s1_id, len(matched) AS n FROM truth),
h AS (SELECT o.s1_id, count(*) AS n FROM owned o SEMI JOIN pairs q ON q.s1_id = o.s1_id AND q.cand_id = o.cand_id GROUP BY 1),
c AS (SELECT t.s1_id, CAST(coalesce(p.n, 0) AS BIGINT) AS n_pred, CAST(t.n AS BIGINT) AS n_true, CAST(coalesce(h.n, 0) AS BIGINT) AS tp FROM t LEFT JOIN p USING (s1_id) LEFT JOIN h USING (s1_id)),
f AS (SELECT *, CASE WHEN n_pred = 0 AND n_true = 0 THEN 1.0 WHEN tp = 0 THEN 0.0 ELSE 1.25 * (tp / n_pred) * (tp / n_true) / (0.25 * tp / n_pred + tp / n_true) END AS f FROM c)"""

_CURVE = f"""{SCORED}, {TRUTH}, {OWNED.format(least=-1)}, grid AS (SELECT unnest(range(36, 96)) AS g),
j AS (SELECT o.s1_id, o.score, CAST(q.cand_id IS NOT NULL AS INT) AS hit FROM owned o SEMI JOIN truth t USING (s1_id) LEFT JOIN pairs q ON q.s1_id = o.s1_id AND q.cand_id = o.cand_id),
k AS (SELECT g, s1_id, count(*) AS n, sum(hit) AS h FROM grid JOIN j ON floor(round(j.score * 100, 6)) >= g GROUP BY 1, 2),
c AS (SELECT g, t.s1_id, len(matched) AS n_true, coalesce(n, 0) AS n, coalesce(h, 0) AS h FROM grid CROSS JOIN truth t LEFT JOIN k USING (g, s1_id)),
curve AS (SELECT g / 100 AS t, round(avg(CASE WHEN n = 0 AND n_true = 0 THEN 1.0 WHEN h = 0 THEN 0.0 ELSE 1.25 * (h / n) * (h / n_true) / (0.25 * h / n + h / n_true) END), 6) AS macro_f FROM c GROUP BY g)"""

SQL |= {
    "entity_fbeta": f"WITH {_COUNTS} SELECT s1_id, n_pred, n_true, tp, round(f, 6) AS f FROM f",
    "macro_fbeta": f"""WITH {_COUNTS} SELECT count(*) AS n_ids, round(avg(f), 6) AS macro_f, round(coalesce(avg(CASE WHEN n_pred > 0 AND n_true > 0 THEN tp / n_pred END), 0), 6) AS mean_precision,
        round(coalesce(avg(CASE WHEN n_pred > 0 AND n_true > 0 THEN tp / n_true END), 0), 6) AS mean_recall FROM f""",
    "threshold_curve": f"WITH {_CURVE} SELECT * FROM curve",
    "tune_threshold": f"WITH {_CURVE} SELECT * FROM curve ORDER BY macro_f DESC, t LIMIT 1",
    "entity_split": f"WITH {TRUTH} SELECT s1_id, CASE WHEN row_number() OVER (ORDER BY md5('42|' || s1_id), s1_id) <= CAST(floor((SELECT count(*) FROM truth) * 0.2 + 0.5) AS INT) THEN 'val' ELSE 'train' END AS part FROM truth",
    "sample_entities": "SELECT entity_id AS s1_id FROM (SELECT DISTINCT entity_id FROM source1) ORDER BY md5('42|' || entity_id), entity_id LIMIT 500",
    "cold_threshold_routing": f"""WITH {NORM}, {SCORED} SELECT s.s1_id, s.cand_id, s.cand_source, s.score, n.country_key FROM scored s JOIN norm n ON n.entity_id = s.s1_id
        WHERE s.score >= CASE WHEN n.country_key = 'france' THEN 0.7 ELSE 0.5 END""",
    "match_structure": f"""WITH {TRUTH}, m AS (SELECT len(matched) AS n, len(list_filter(matched, lambda x: x LIKE 'S3%')) AS s3 FROM truth)
        SELECT count(*) AS n_ids, CAST(count_if(n = 0) AS BIGINT) AS singletons, CAST(count_if(n > 0) AS BIGINT) AS matched_ids, round(avg(CASE WHEN n > 0 THEN n END), 6) AS mean_matches, CAST(max(n) AS BIGINT) AS max_matches,
        CAST(count_if(n = 1) AS BIGINT) AS one, CAST(count_if(n = 2) AS BIGINT) AS two, CAST(count_if(n >= 3) AS BIGINT) AS three_up, CAST(sum(n - s3) AS BIGINT) AS s2_matches, CAST(sum(s3) AS BIGINT) AS s3_matches FROM m""",
    "validate_subset": f"""WITH {SCORED}, {TRUTH}, o AS (SELECT DISTINCT p.s1_id || '>' || p.cand_id AS pair FROM pairs p ANTI JOIN scored s ON s.s1_id = p.s1_id AND s.cand_id = p.cand_id)
        SELECT 'matching_results' AS file, 'match is no candidate' AS rule, 'error' AS level, count(*) AS n, (SELECT string_agg(pair, ',' ORDER BY pair) FROM (SELECT pair FROM o ORDER BY pair LIMIT 5)) AS examples FROM o HAVING count(*) > 0""",
    "pair_features_native": "WITH "
    + ", ".join(
        [
            NORM, SCORED,
            _named("ad_", _grams("norm_addr", 3, 4, True), _CHAIN), _named("sq_", _grams("name_squish", 4, 5, False), _CHAIN),
            _cos("ad_", "ad_dots"), _cos("sq_", "sq_dots"),
            _F.format(extra="x.dot AS ad, y.dot AS sq,", joins="LEFT JOIN ad_dots x ON x.s1_id = p.s1_id AND x.cand_id = p.cand_id LEFT JOIN sq_dots y ON y.s1_id = p.s1_id AND y.cand_id = p.cand_id"),
        ]
    )
    + f""" SELECT s1_id, cand_id, round(score, 6) AS name_cos, round(coalesce(ad, 0.0), 6) AS addr_cos, CAST(a_f = b_f AND a_f <> '' AS DOUBLE) AS first_token_match,
        CAST(a_a = b_a AND length(a_a) >= 2 AS DOUBLE) AS acronym_match, CASE WHEN greatest(a_l, b_l) > 0 THEN round(least(a_l, b_l) / greatest(a_l, b_l), 6) ELSE 0.0 END AS name_len_ratio,
        CAST(a_p <> '' AND b_p <> '' AS DOUBLE) AS postal_both_present, CAST(a_p <> '' AND a_p = b_p AS DOUBLE) AS postal_equal,
        CASE WHEN len(a_nums) > 0 AND len(b_nums) > 0 THEN round(len(list_intersect(a_nums, b_nums)) / len({_UNION.format(a='a_nums', b='b_nums')}), 6) ELSE 0.0 END AS num_overlap,
        CAST(len(list_intersect(a_nums, b_nums)) > 0 AS DOUBLE) AS num_any_match, CAST(a_c = b_c AS DOUBLE) AS country_match, CAST(cand_source = 3 AS DOUBLE) AS cand_is_s3, round(coalesce(sq, 0.0), 6) AS squish_cos,
        CAST(len(a_nums) > 0 AND list_sort(a_nums) = list_sort(b_nums) AS DOUBLE) AS num_exact,
        CASE WHEN len(a_t) > 0 AND len(b_t) > 0 THEN round(len(list_intersect(a_t, b_t)) / least(len(a_t), len(b_t)), 6) ELSE 0.0 END AS addr_containment,
        CAST(len(a_t) > 0 AND len(b_t) > 0 AND string_split(a_n, ' ')[-1] = string_split(b_n, ' ')[-1] AS DOUBLE) AS region_match,
        CAST(a_p <> '' AND b_p <> '' AND substr(a_p, 1, 2) = substr(b_p, 1, 2) AS DOUBLE) AS postal_prefix_match,
        CAST(len(list_intersect(list_filter(a_core, lambda t: length(t) >= 5), list_filter(b_core, lambda t: length(t) >= 5))) > 0 AS DOUBLE) AS shared_long_token, 0.0 AS embed_cos FROM attached""",
    "corroborate": "WITH "
    + ", ".join([NORM, SCORED, _named("ad_", _grams("norm_addr", 3, 4, True), _CHAIN), _cos("ad_", "ad_dots")])
    + """, o AS (SELECT p.s1_id, p.cand_id, p.score, CAST(a.postal <> '' AND a.postal = b.postal AS DOUBLE) AS postal_equal, round(coalesce(d.dot, 0.0), 6) AS addr_cos FROM scored p JOIN norm a ON a.entity_id = p.s1_id
        JOIN norm b ON b.entity_id = p.cand_id LEFT JOIN ad_dots d ON d.s1_id = p.s1_id AND d.cand_id = p.cand_id)
        SELECT * FROM o WHERE score >= 0.6 OR (score >= 0.6 - 0.25 AND (postal_equal = 1 OR addr_cos >= 0.75))""",
}

_BI = "list_distinct(list_transform(range(1, greatest(CAST(length({c}) AS INT) - 1, 1) + 1), lambda i: substr({c}, i, 2)))"
_J = "len(list_intersect({a}, {b})) / len(list_distinct(list_concat({a}, {b})))"
_KEYS = f"""{NORM},
blobs AS (SELECT entity_id, lower(business_name || ' ' || business_address) AS blob FROM raw),
keys AS (SELECT DISTINCT * FROM (
  SELECT entity_id, source, 'exact_name' AS key_name, core_name AS value FROM norm UNION ALL SELECT entity_id, source, 'squished_name', name_squish FROM norm
  UNION ALL SELECT entity_id, source, 'exact_address', norm_addr FROM norm UNION ALL SELECT entity_id, source, 'postal', postal FROM norm
  UNION ALL SELECT entity_id, source, 'name_postal', CASE WHEN core_name <> '' AND postal <> '' THEN core_name || '|' || postal ELSE '' END FROM norm
  UNION ALL SELECT n.entity_id, n.source, 'phones', unnest(list_transform(regexp_extract_all(regexp_replace(blob, '[^0-9]+', ' ', 'g'), '\\b([0-9]{{10,12}})\\b', 1), lambda x: right(x, 10))) FROM norm n JOIN blobs USING (entity_id)
  UNION ALL SELECT n.entity_id, n.source, 'emails', unnest(regexp_extract_all(blob, '([a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{{2,}})', 1)) FROM norm n JOIN blobs USING (entity_id)
  UNION ALL SELECT n.entity_id, n.source, 'domains', unnest(regexp_extract_all(blob, '([a-z0-9-]+\\.(?:com|in|co|org|net|io|biz|info|us|fr))\\b', 1)) FROM norm n JOIN blobs USING (entity_id)
  UNION ALL SELECT n.entity_id, n.source, 'long_numbers', unnest(regexp_extract_all(blob, '([0-9]{{7,}})', 1)) FROM norm n JOIN blobs USING (entity_id)) WHERE value <> ''),
counts AS (SELECT key_name, value, count(*) FILTER (WHERE source = 1) AS a, count(*) FILTER (WHERE source > 1) AS b FROM keys GROUP BY ALL),
kp AS (SELECT x.key_name, x.value, x.entity_id AS s1_id, y.entity_id AS cand_id FROM keys x JOIN keys y ON x.key_name = y.key_name AND x.value = y.value
  JOIN counts c ON c.key_name = x.key_name AND c.value = x.value WHERE x.source = 1 AND y.source > 1 AND c.a BETWEEN 1 AND 40 AND c.b BETWEEN 1 AND 40)"""
_QUALITY = """quality AS (SELECT k.key_name, count(*) AS n_rows, count(p.cand_id) AS n_true_rows, round(count(p.cand_id) / count(*), 6) AS "precision",
  count(DISTINCT CASE WHEN p.cand_id IS NOT NULL THEN k.s1_id || '>' || k.cand_id END) AS n_true_pairs, round(count(DISTINCT CASE WHEN p.cand_id IS NOT NULL THEN k.s1_id || '>' || k.cand_id END) / (SELECT count(*) FROM pairs), 6) AS recall
  FROM kp k SEMI JOIN truth t ON t.s1_id = k.s1_id LEFT JOIN pairs p ON p.s1_id = k.s1_id AND p.cand_id = k.cand_id GROUP BY 1)"""

SQL |= {
    "contact_keys": f"""WITH {RAW}, b AS (SELECT entity_id, lower(business_name || ' ' || business_address) AS blob FROM raw)
        SELECT entity_id, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(regexp_replace(blob, '[^0-9]', ' ', 'g'), '[0-9]{{10,12}}'), lambda x: right(x, 10)))), ',') AS phones,
        array_to_string(list_sort(list_distinct(regexp_extract_all(blob, '[a-z0-9._%+-]+@[a-z0-9-]+\\.[a-z0-9.-]+'))), ',') AS emails,
        array_to_string(list_sort(list_distinct(regexp_extract_all(blob, '[a-z0-9][a-z0-9-]*\\.(?:com|in|co|org|net|io|biz|info|us|fr)'))), ',') AS domains,
        array_to_string(list_sort(list_distinct(regexp_extract_all(blob, '\\p{{Nd}}{{7,}}'))), ',') AS long_numbers FROM b""",
    "band_rerank_stub": f"""WITH {RAW}, {SCORED}, texts AS (SELECT entity_id, lower(trim(business_name || ' | ' || business_address || ' | ' || country)) AS t FROM raw),
        sets AS (SELECT entity_id, {_BI.format(c='t')} AS g FROM texts),
        j AS (SELECT s.s1_id, s.cand_id, s.score, {_J.format(a='a.g', b='b.g')} AS second FROM scored s JOIN sets a ON a.entity_id = s.s1_id JOIN sets b ON b.entity_id = s.cand_id WHERE score >= 0.3)
        SELECT s1_id, cand_id, score FROM j WHERE score >= 0.5 + 0.15 UNION ALL
        SELECT s1_id, cand_id, round(0.5 * score + 0.5 * second, 6) AS score FROM j WHERE score >= 0.5 - 0.15 AND score < 0.5 + 0.15 AND round(0.5 * score + 0.5 * second, 6) >= 0.5""",
    "exact_key_pairs": f"WITH {_KEYS} SELECT key_name, value, s1_id, cand_id FROM kp",
    "exact_key_analysis": f"WITH {_KEYS}, {TRUTH}, {_QUALITY} SELECT * FROM quality",
    "deterministic_reach": f"""WITH {_KEYS}, {TRUTH}, {_QUALITY}, found AS (SELECT DISTINCT k.s1_id, k.cand_id FROM kp k JOIN quality q USING (key_name) WHERE q."precision" >= 0.9)
        SELECT count(*) AS n_true, count(f.cand_id) AS n_reached, round(count(f.cand_id) / greatest(count(*), 1), 6) AS reach FROM pairs p LEFT JOIN found f ON f.s1_id = p.s1_id AND f.cand_id = p.cand_id""",
    "residual_bigram": f"""WITH {_KEYS}, {TRUTH}, rest AS (SELECT DISTINCT s1_id, cand_id FROM pairs p ANTI JOIN kp k ON k.s1_id = p.s1_id AND k.cand_id = p.cand_id),
        sets AS (SELECT entity_id, {_BI.format(c='core_name')} AS g FROM norm),
        j AS (SELECT {_J.format(a='a.g', b='b.g')} AS j FROM rest r JOIN sets a ON a.entity_id = r.s1_id JOIN sets b ON b.entity_id = r.cand_id)
        SELECT count(*) AS n_left, round(coalesce(avg(j), 0), 6) AS mean_overlap, round(coalesce(avg(CAST(j >= 0.6 AS INT)), 0), 6) AS share_easy, round(coalesce(avg(CAST(j < 0.3 AS INT)), 0), 6) AS share_hard FROM j""",
    "hard_negative_mining": f"""WITH {SCORED}, {TRUTH}, {RAW}, j AS (SELECT s.s1_id, s.cand_id, s.score, p.cand_id IS NOT NULL AS y FROM scored s SEMI JOIN truth t USING (s1_id) LEFT JOIN pairs p ON p.s1_id = s.s1_id AND p.cand_id = s.cand_id),
        pos AS (SELECT s1_id, cand_id FROM j WHERE y UNION SELECT p.s1_id, p.cand_id FROM pairs p SEMI JOIN raw r ON r.entity_id = p.cand_id ANTI JOIN scored s ON s.s1_id = p.s1_id AND s.cand_id = p.cand_id),
        neg AS (SELECT *, row_number() OVER (ORDER BY score DESC, s1_id, cand_id) AS r FROM j WHERE NOT y),
        size AS (SELECT least((SELECT count(*) FROM neg), 4 * (SELECT count(*) FROM pos)) AS w), cuts AS (SELECT w, CAST(floor(0.7 * w + 0.5) AS BIGINT) AS h FROM size),
        rest AS (SELECT *, row_number() OVER (ORDER BY md5('42|' || s1_id || '|' || cand_id), s1_id, cand_id) AS q FROM neg WHERE r > (SELECT h FROM cuts))
        SELECT s1_id, cand_id, 1 AS label, 'positive' AS kind FROM pos UNION ALL SELECT s1_id, cand_id, 0, 'hard' FROM neg WHERE r <= (SELECT h FROM cuts)
        UNION ALL SELECT s1_id, cand_id, 0, 'random' FROM rest WHERE q <= (SELECT w - h FROM cuts)""",
    "validate_candidates": """WITH l AS (SELECT trim(source1_entity_id) AS id, list_filter(list_transform(string_split(coalesce(candidate_entity_ids, ''), ','), lambda x: trim(x)), lambda x: x <> '') AS ids FROM candidate_pairs),
        e AS (SELECT id, unnest(ids) AS t FROM l), s1 AS (SELECT DISTINCT entity_id AS id FROM source1), known AS (SELECT entity_id AS t FROM source2 UNION SELECT entity_id FROM source3),
        i AS (
          SELECT 'repeated row' AS rule, id AS x FROM l GROUP BY id HAVING count(*) > 1 UNION ALL SELECT 'unexpected id', id FROM (SELECT DISTINCT id FROM l) a ANTI JOIN s1 USING (id)
          UNION ALL SELECT 'missing id', id FROM s1 ANTI JOIN l USING (id) UNION ALL SELECT 'repeated id in list', id FROM l WHERE len(ids) <> len(list_distinct(ids))
          UNION ALL SELECT 'self match', t FROM e WHERE t LIKE 'S1-%' UNION ALL SELECT 'wrong prefix', t FROM e WHERE t NOT LIKE 'S1-%' AND NOT regexp_matches(t, '^S[23]-')
          UNION ALL SELECT 'unknown target', t FROM (SELECT DISTINCT t FROM e WHERE regexp_matches(t, '^S[23]-')) a ANTI JOIN known USING (t)),
        r AS (SELECT rule, x, row_number() OVER (PARTITION BY rule ORDER BY x) AS k, count(*) OVER (PARTITION BY rule) AS n FROM i)
        SELECT 'candidate_pairs' AS file, rule, 'error' AS level, max(n) AS n, string_agg(x, ',' ORDER BY x) FILTER (WHERE k <= 5) AS examples FROM r GROUP BY rule""",
}

_HEADER = "'s1_entity_id' || chr(9) || 'matched'"
SQL |= {
    # worked out by hand from the rules
    "validate_broken": f"""SELECT file, rule, 'error' AS level, CAST(n AS BIGINT) AS n, examples FROM (VALUES
        ('official', 'header', 1, {_HEADER}), ('official', 'columns', 2, '5,6'), ('official', 'repeated row', 1, 'S1-1'), ('official', 'unexpected id', 1, 'S1-8'),
        ('official', 'missing id', 2, 'S1-2,S1-3'), ('official', 'repeated id in list', 1, 'S1-1'), ('official', 'self match', 1, 'S1-9'), ('official', 'wrong prefix', 1, 'X-1'),
        ('official', 'unknown target', 1, 'S3-404'),
        ('strict', 'header', 1, {_HEADER}), ('strict', 'columns', 1, '6'), ('strict', 'repeated row', 1, 'S1-1'), ('strict', 'unexpected id', 1, 'S1-8'),
        ('strict', 'missing id', 1, 'S1-3'), ('strict', 'repeated id in list', 1, 'S1-1'), ('strict', 'self match', 1, 'S1-9'), ('strict', 'wrong prefix', 1, 'X-1'),
        ('strict', 'unknown target', 1, 'S3-404')) t(file, rule, n, examples)""",
    "fuzzy_ratios": """SELECT a, b, CAST(x AS DOUBLE) AS token_set, CAST(y AS DOUBLE) AS token_sort, CAST(z AS DOUBLE) AS "partial" FROM (VALUES
        ('abcd', 'abed', 0.75, 0.75, 0.75), ('new york mets', 'mets new york', 1, 1, 0.761905), ('a b', 'a b c', 1, 0.75, 1), ('', '', 0, 1, 1), ('', 'x', 0, 0, 0),
        ('apex foods', 'apex motors', 0.761905, 0.761905, 0.736842), ('abc', 'xxabcxx', 0.6, 0.6, 1), ('ab', 'bxxxa', 0.285714, 0.285714, 0.666667)) t(a, b, x, y, z)""",
    "approximate_neighbours": """
        WITH v AS (SELECT 'V' || vec_id AS id, CAST(vec_id % 3 + 1 AS INT) AS source, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
        s AS (SELECT a.id AS s1_id, b.id AS cand_id, b.source AS cand_source, round(list_cosine_similarity(a.v, b.v), 6) AS cos FROM v a JOIN v b ON a.source = 1 AND b.source > 1),
        r AS (SELECT *, row_number() OVER (PARTITION BY s1_id, cand_source ORDER BY cos DESC, cand_id) AS r FROM s WHERE cos >= 0.1)
        SELECT count(*) AS n_exact, true AS nine_in_ten FROM r WHERE r <= 15""",
    "rerank_cold": f"""WITH {NORM}, {SCORED}, sets AS (SELECT entity_id, country_key, {_BI.format(c="t")} AS g FROM (SELECT entity_id, country_key, lower(trim(core_name || ' | ' || norm_addr || ' | ' || country_key)) AS t FROM norm)),
        j AS (SELECT s.s1_id, s.cand_id, s.score, {_J.format(a="a.g", b="b.g")} AS second, CASE WHEN a.country_key = 'france' THEN 0.7 ELSE 0.5 END AS t FROM scored s JOIN sets a ON a.entity_id = s.s1_id JOIN sets b ON b.entity_id = s.cand_id)
        SELECT s1_id, cand_id, score FROM j WHERE score >= t + 0.15 UNION ALL
        SELECT s1_id, cand_id, round(0.5 * score + 0.5 * second, 6) AS score FROM j WHERE score >= t - 0.15 AND score < t + 0.15 AND round(0.5 * score + 0.5 * second, 6) >= t""",
}
SQL["reranker_split"] = f"""WITH mined AS ({SQL["hard_negative_mining"]}), h AS (SELECT *, row_number() OVER (ORDER BY md5('42|' || s1_id || '|' || cand_id), s1_id, cand_id) AS r, count(*) OVER () AS n FROM mined)
    SELECT CASE WHEN r <= least(40000, n // 5) THEN 'val' ELSE 'train' END AS part, kind, label, count(*) AS n FROM h GROUP BY 1, 2, 3"""
