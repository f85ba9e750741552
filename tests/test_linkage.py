import pytest
from pyspark.sql import functions as F

from weftlink.operators import blocking as B
from weftlink.operators import decision as D
from weftlink.operators import metrics as E
from weftlink.operators import synth, validate
from weftlink.operators.features import FEATURES, all_features
from weftlink.operators.matcher import clipped_median
from weftlink.operators.tfidf import paired_cosine, text_vectors, text_weights, top_k
from weftlink.plans.cli import config_of
from weftlink.sources import records as S


@pytest.fixture(scope="module")
def records(spark):
    rows = [
        ("S1-1", "Apex Star Foods Pvt Ltd", "12 Main Rd, 560001", "India"),
        ("S1-2", "Moon Motors Inc", "9 Oak St, NY 10001", "US"),
        ("S1-3", "", "", ""),
        ("S2-1", "Apex Star Food", "12 Main Road 560001", "india"),
        ("S2-2", "Moon Motor Corp", "9 Oak Street, NY 10001", "us"),
        ("S3-1", "Star Apex Foods", "", "India"),
        ("S3-2", "Other Thing", "1 Far Away 99999", "US"),
    ]
    return S.normalised(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string"))


def test_missing_column(spark):
    with pytest.raises(ValueError):
        S.as_records(spark.createDataFrame([("1",)], "entity_id string"))


def test_top_k_and_floor(records):
    w = text_vectors(records, "core_name", 3, 4, min_df=1)
    got = {(r["s1_id"], r["cand_id"]): r["cos"] for r in top_k(w, 1, 0.1).collect()}
    assert {("S1-1", "S2-1"), ("S1-1", "S3-1"), ("S1-2", "S2-2")} == set(got)
    assert all(0.1 <= v <= 1 for v in got.values())


def test_vectors_are_the_weights(records):
    """Arrays and long rows hold the same weights; cosines and the best targets are those of all pairs compared one by one."""
    for within in (True, False):
        long, plain = text_weights(records, "core_name", 3, 4, within, min_df=1), {}
        for r in long.collect():
            plain.setdefault((r["entity_id"], r["source"], r["country_key"]), {})[r["gram"]] = r["w"]
        vectors = text_vectors(records, "core_name", 3, 4, within, min_df=1)
        assert {r["entity_id"]: sorted(round(x, 9) for x in r["w"]) for r in vectors.collect()} == {k[0]: sorted(round(x, 9) for x in v.values()) for k, v in plain.items()}
        assert all(r["grams"] == sorted(r["grams"]) for r in vectors.collect())
        cos = {(a[0], b[0]): round(sum(x * plain[b].get(g, 0.0) for g, x in plain[a].items()), 6) for a in plain for b in plain if a[1] == 1 and b[1] > 1 and a[2] == b[2]}
        got = {(r["s1_id"], r["cand_id"]): r["cos"] for r in top_k(vectors, 9, 0.0).collect()}
        assert got == {k: pytest.approx(v) for k, v in cos.items() if v > 0}
        pairs = records.sparkSession.createDataFrame([*cos, ("S1-1", "none")], "s1_id string, cand_id string")
        assert {(r["s1_id"], r["cand_id"]): r["c"] for r in paired_cosine(pairs, vectors, "c").collect()} == {k: pytest.approx(v) for k, v in {**cos, ("S1-1", "none"): 0.0}.items()}
    assert top_k(text_vectors(records.limit(0), "core_name", 3, 4), 3, 0.1).count() == 0


def test_blocks_do_not_change_results(records, monkeypatch):
    from weftlink.operators import blocks

    vectors = text_vectors(records, "core_name", 3, 4, min_df=1).cache()
    whole = sorted(top_k(vectors, 1, 0.05).collect())
    monkeypatch.setattr(blocks, "TARGETS", 1)
    monkeypatch.setattr(blocks, "QUERIES", 0)
    assert sorted(top_k(vectors, 1, 0.05).collect()) == whole


def test_approximate_neighbours_find_nine_in_ten(spark):
    import numpy as np

    rng = np.random.default_rng(4)
    centers = rng.normal(size=(12, 16))
    v = centers[rng.integers(0, 12, 900)] + 0.4 * rng.normal(size=(900, 16))
    rows = [(f"{i:04d}", i % 3 + 1, "x", [float(x) for x in v[i]]) for i in range(900)] + [("null", 2, "x", None), ("zero", 2, "x", [0.0] * 16)]
    df = spark.createDataFrame(rows, "id string, source int, country_key string, v array<double>")
    exact = {(r["s1_id"], r["cand_id"]) for r in B.vector_top_k(df, 5, 0.1).collect()}
    near = {(r["s1_id"], r["cand_id"]) for r in B.approximate_top_k(df, 5, 0.1, lists=16).collect()}
    assert len(exact & near) >= 0.9 * len(exact) and near
    assert B.approximate_top_k(df.limit(0), 5, 0.1).count() == 0


def test_postal_cap(spark):
    rows = [("S1-1", 1, "us", "10001"), *[(f"S2-{i}", 2, "us", "10001") for i in range(41)], ("S3-1", 3, "us", "10001"), ("S3-2", 3, "fr", "10001"), ("S2-x", 2, "us", "")]
    df = spark.createDataFrame(rows, "entity_id string, source int, country_key string, postal string")
    assert [(r["s1_id"], r["cand_id"]) for r in B.postal_pairs(df).collect()] == [("S1-1", "S3-1")]


def test_vector_top_k_is_exact(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    v = rng.normal(size=(40, 4))
    rows = [(f"{i}", i % 3 + 1, "x" if i % 2 else "y", [float(x) for x in v[i]]) for i in range(40)]
    df = spark.createDataFrame(rows, "id string, source int, country_key string, v array<float>")
    got = {(r["s1_id"], r["cand_id"]) for r in B.vector_top_k(df, 2, -1.0).collect()}
    plain = set()
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    for i in range(0, 40, 3):
        for source in (2, 3):
            near = sorted((-round(float(unit[i] @ unit[j]), 5), str(j)) for j in range(40) if j % 3 + 1 == source and i % 2 == j % 2)
            plain |= {(str(i), j) for _, j in near[:2]}
    assert got == plain


def test_features(records):
    pairs = B.union_pairs(records.filter("source = 1").select(F.col("entity_id").alias("s1_id")).crossJoin(records.filter("source > 1").select(F.col("entity_id").alias("cand_id"), F.col("source").alias("cand_source"))))
    rows = {(r["s1_id"], r["cand_id"]): r for r in all_features(pairs.withColumn("name_cos", F.lit(0.5)), records).collect()}
    assert len(rows) == 12
    one = rows["S1-1", "S2-1"]
    assert [one[f] for f in ("first_token_match", "postal_equal", "num_exact", "addr_containment", "region_match", "country_match", "cand_is_s3")] == [1, 1, 1, 1, 1, 1, 0]
    blank = rows["S1-3", "S3-1"]
    assert all(blank[f] == 0 for f in FEATURES if f not in ("name_cos", "cand_is_s3"))


def test_one_owner_and_lists(spark):
    scored = spark.createDataFrame([("a", "c", 0.9, 2), ("b", "c", 0.8, 2), ("a", "d", 0.7, 3), ("b", "e", 0.7, 2), ("a", "e", 0.7, 2)], "s1_id string, cand_id string, score double, cand_source int")
    owned = D.one_owner(D.above(scored, 0.5))
    assert {(r["s1_id"], r["cand_id"]) for r in owned.collect()} == {("a", "c"), ("a", "d"), ("a", "e")}
    ids = spark.createDataFrame([("a",), ("b",)], "id string")
    assert {r["id"]: r["ids"] for r in D.grouped_lists(owned, ids).collect()} == {"a": ["c", "d", "e"], "b": []}
    assert {r["id"]: r["ids"] for r in D.grouped_lists(owned, ids, by_score=False).collect()}["a"] == ["c", "e", "d"]


def test_f_beta(spark):
    rows = [(2, 3, 2, 0.714286), (0, 0, 0, 1.0), (0, 2, 0, 0.0), (0, 0, 2, 0.0)]
    df = spark.createDataFrame(rows, "tp int, n_pred int, n_true int, f double")
    for r in df.select(F.round(E.f_beta(F.col("tp"), F.col("n_pred"), F.col("n_true")), 6).alias("g"), "f").collect():
        assert r["g"] == r["f"]


def test_threshold_curve_against_plain_loop(spark):
    import random

    rng = random.Random(2)
    ids = [f"s{i}" for i in range(12)]
    truth = [(s, f"c{s}{k}") for s in ids[:8] for k in range(rng.randint(0, 2))]
    pairs = [(s, f"c{s}{k}", rng.randint(20, 100) / 100) for s in ids for k in range(3)]
    make = lambda rows, schema: spark.createDataFrame(rows, schema)
    curve = E.threshold_curve(make(pairs, "s1_id string, cand_id string, score double"), make(truth, "s1_id string, cand_id string"), make([(s,) for s in ids], "s1_id string"))
    got = {round(r["t"] * 100): r["macro_f"] for r in curve.collect()}
    assert sorted(got) == list(range(36, 96))
    for t, f in got.items():
        total = 0.0
        for s in ids:
            pred = {c for x, c, v in pairs if x == s and round(v * 100) >= t}
            true = {c for x, c in truth if x == s}
            hit = len(pred & true)
            total += 1.0 if not pred and not true else 0.0 if not hit else 1.25 * hit / len(pred) * hit / len(true) / (0.25 * hit / len(pred) + hit / len(true))
        assert f == pytest.approx(total / len(ids), abs=1e-6)


def test_entity_split_is_stable(spark):
    import hashlib

    ids = [f"e{i}" for i in range(50)]
    df = spark.createDataFrame([(i,) for i in ids], "s1_id string")
    got = {r["s1_id"] for r in E.entity_split(df.repartition(3)).filter("part = 'val'").collect()}
    assert got == set(sorted(ids, key=lambda s: hashlib.md5(f"42|{s}".encode()).hexdigest())[:10])


def test_blocking_recall_without_truth(spark):
    none = spark.createDataFrame([], "s1_id string, cand_id string")
    some = spark.createDataFrame([("a", "b")], "s1_id string, cand_id string")
    assert B.blocking_recall(some, none).first()["recall"] == 1.0
    assert B.blocking_recall(none, some).first()["recall"] == 0.0


def test_tsv_round_trip(spark, tmp_path):
    lists = spark.createDataFrame([("S1-1", ["S2-1", "S3-1", "S2-1"], 2), ("S1-2", [], 1)], "id string, ids array<string>, at int").repartition(2)
    for _ in range(2):
        S.write_id_lists(lists, str(tmp_path / "out"), "source1_entity_id", "matched_entity_ids")
        assert (tmp_path / "out").read_text().splitlines() == ["source1_entity_id\tmatched_entity_ids", "S1-2\t", "S1-1\tS2-1,S3-1"]
    (tmp_path / "train").mkdir()
    for n in ("source1", "source2", "source3"):
        (tmp_path / "train" / f"{n}.tsv").write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\textra\n S1-1 \t"quoted\tNA\t\tz\n\tno id\t\t\t\n')
    (tmp_path / "train" / "ground_truth.tsv").write_text("ID\tLIST\nS1-1\tS2-1\nS1-1\tS2-2, S2-3\nS1-2\t\n")
    paths = S.resolve_paths(spark, str(tmp_path), "train")
    assert [tuple(r) for r in S.read_source(spark, paths["source1"]).collect()] == [("S1-1", '"quoted', "NA", "")]
    assert {r[0]: r[1] for r in S.read_ground_truth(spark, paths["ground_truth"]).collect()} == {"S1-1": ["S2-2", "S2-3"], "S1-2": []}
    with pytest.raises(FileNotFoundError):
        S.resolve_paths(spark, str(tmp_path / "none"), "test")


def test_validation(spark):
    text = ["source1_entity_id\tmatched_entity_ids", "S1-1\tS2-1,S2-1", "S1-1\tS1-9", "S1-8\tX-1", "S1-2", "S1-3\tS2-404"]
    lines = spark.createDataFrame(list(enumerate(text, 1)), "line_no long, value string")
    s1 = spark.createDataFrame([("S1-1",), ("S1-2",), ("S1-3",)], "id string")
    targets = spark.createDataFrame([("S2-1",)], "id string")
    got = {r["rule"]: (r["n"], r["examples"]) for r in validate.validate_lines(lines, "f", "matched_entity_ids", s1, targets).collect()}
    assert got == {
        "columns": (1, "5"), "repeated row": (1, "S1-1"), "unexpected id": (1, "S1-8"), "missing id": (1, "S1-2"), "repeated id in list": (1, "S1-1"),
        "self match": (1, "S1-9"), "wrong prefix": (1, "X-1"), "unknown target": (1, "S2-404"),
    }
    strict = {r["rule"] for r in validate.validate_lines(lines, "f", "matched_entity_ids", s1, targets, "strict").collect()}
    assert "columns" not in strict and "missing id" not in strict
    pair = spark.createDataFrame([("a", "b")], "s1_id string, cand_id string")
    assert validate.exit_code(validate.validate_subset(pair, pair.limit(0))) == 0
    assert validate.exit_code(validate.validate_subset(pair, pair.limit(0), "strict")) == 1


def test_file_order_and_lines(spark, tmp_path):
    """Lines, ids and repeated labels follow the file, whatever parts it is read in."""
    n = 3000
    path = tmp_path / "ground_truth.tsv"
    path.write_text("source1_entity_id\tmatched_entity_ids\n" + "".join(f"S1-{i % 1000}\tS2-{i}\n" for i in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        lines = {r["line_no"]: r["value"] for r in S.read_lines(spark, str(path)).collect()}
        assert len(lines) == n + 1 and lines[1].startswith("source1") and all(lines[i + 2] == f"S1-{i % 1000}\tS2-{i}" for i in range(n))
        assert {r[0]: r[1] for r in S.read_ground_truth(spark, str(path)).collect()} == {f"S1-{i}": [f"S2-{i + 2000}"] for i in range(1000)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_validated_files(spark, tmp_path):
    (tmp_path / "test").mkdir()
    for k, ids in ((1, ["S1-1", "S1-2"]), (2, ["S2-1"]), (3, ["S3-1"])):
        (tmp_path / "test" / f"source{k}.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\n" + "".join(f"{i}\tn\ta\tc\n" for i in ids))
    good, bad = tmp_path / "c.tsv", tmp_path / "m.tsv"
    good.write_text("source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-1\nS1-2\t\n")
    bad.write_text("S1\tmatched\nS1-1\tS3-1,S2-9\nS1-2\t\textra\n")
    got = {(r["file"], r["rule"], r["level"]) for r in validate.validate_files(spark, str(good), str(bad), str(tmp_path), check_ids=True).collect()}
    assert got == {("matching_results", x, "error") for x in ("header", "columns", "missing id", "unknown target")} | {("matching_results", "match is no candidate", "warning")}
    assert validate.exit_code(validate.validate_files(spark, str(good), str(good), str(tmp_path)).filter("rule <> 'header'")) == 0
    (tmp_path / "test" / "source3.tsv").unlink()
    skipped = validate.validate_files(spark, str(good), str(bad), str(tmp_path)).filter("level = 'warning'").collect()
    assert {r["rule"] for r in skipped} == {"target look-up skipped", "match is no candidate"}
    empty = spark.createDataFrame([], "line_no long, value string")
    ids = spark.createDataFrame([("S1-1",)], "id string")
    assert {r["rule"] for r in validate.validate_lines(empty, "f", "x", ids, None).collect()} == {"header", "missing id"}


def test_knobs():
    mode, cfg = config_of(["predict", "--knn", "7", "--no-postal", "--cross-encoder-band", "0.1"])
    assert (mode, cfg.knn_name, cfg.use_postal_blocker, cfg.cross_encoder_band) == ("predict", 7, False, 0.1)
    assert cfg.key() != config_of([])[1].key()
    assert config_of(["--mode", "train", "--embed-model", "m", "--embed-device", "cuda", "--batch-size", "9"])[1].batch_size == 9
    assert config_of(["--mode", "train"])[0] == "train" and config_of([])[0] == "run"
    assert clipped_median([0.1, 0.1], (0.2, 0.95)) == 0.2 and clipped_median([0.3, 0.5, 0.9], (0.2, 0.95)) == 0.5


def test_synthetic_truth_holds(spark):
    made = synth.split(spark, {"US": 30, "France": 10})
    truth = S.truth_pairs(made["ground_truth"].select("source1_entity_id", F.expr("filter(split(matched_entity_ids, ','), x -> x <> '')").alias("matched")))
    targets = made["source2"].unionByName(made["source3"])
    assert made["source1"].count() == 40 and made["ground_truth"].count() == 40
    assert truth.count() > 20
    assert synth.entities(spark, {"US": 9000}).select(F.split("name", " ")[0]).distinct().count() == 9000
    assert truth.join(targets, truth["cand_id"] == targets["entity_id"], "left_anti").count() == 0
    assert targets.select("entity_id").distinct().count() == targets.count()


def test_matcher_queries_train_on_the_whole_job(spark, monkeypatch):
    """The queries fit with Config's defaults on all cosines, with the missed positives injected."""
    from weftlink.plans import link_queries as Q

    rows, extra = Q._training_rows(spark, "/root/testdata/sf0.01")
    assert rows.filter("squish_cos > 0").count() and rows.filter("addr_cos > 0").count()
    found = rows.filter("label = 1").select("s1_id", "cand_id").distinct()
    assert extra.count() and extra.filter("label <> 1").count() == 0
    assert extra.join(found, ["s1_id", "cand_id"], "left_semi").count() == 0
    fits, colds = [], []
    monkeypatch.setattr(Q.M, "train", lambda r, cfg, trees=None: fits.append((r, cfg, trees)))
    monkeypatch.setattr(Q.M, "importances", lambda model: None)
    monkeypatch.setattr(Q.M, "cold_threshold", lambda r, e, truth, ids, cfg, warm: colds.append((e.count(), cfg)) or (warm, []))
    Q.feature_importance(spark, "/root/testdata/sf0.01")
    ((fitted, cfg, trees),) = fits
    assert cfg == Q.Config() and trees is None
    assert fitted.count() == rows.count() + extra.filter("NOT validation").count()
    Q.cold_country_threshold(spark, "/root/testdata/sf0.01")
    assert colds == [(extra.count(), Q.Config())]


def test_pairs_meet_in_blocks(spark, records, monkeypatch):
    """Blocks give what joins of whole arrays give: repeated pairs, pairs without a record, and several records of one id included."""
    from weftlink.operators import features, pairs, tfidf

    again = spark.createDataFrame([("S2-1", "Apéx Star", "12 Main Rd 2", "India")], "entity_id string, business_name string, business_address string, country string")
    records = records.unionByName(S.normalised(again))
    found = [(a, b, s) for a in ("S1-1", "S1-2", "S1-3", "S1-9") for b in ("S2-1", "S2-2", "S3-1", "S3-2", "S3-9") for s in (0.25, 0.5)]
    stored = spark.createDataFrame(found, "s1_id string, cand_id string, name_cos double")
    once = stored.groupBy("s1_id", "cand_id").agg(F.max("name_cos").alias("name_cos")).withColumn("cand_source", S.source_number(F.col("cand_id")))
    index = {"addr_cos": ("norm_addr", tfidf.vocabulary(records, "norm_addr", 3, 4, min_df=1)), "squish_cos": ("name_squish", tfidf.vocabulary(records, "name_squish", 4, 5, False, min_df=1))}
    plain = features.fuzzy_features(features.native_features(features.attach(once, records)))
    kept = ["s1_id", "cand_id", *[f for f in FEATURES if f not in ("addr_cos", "squish_cos", "embed_cos")]]
    want = sorted(plain.select(kept).collect())
    assert len(want) == 15
    cosines = tfidf.paired_cosines(once, {k: text_vectors(records, c, *n, within_words=w, min_df=1) for k, c, n, w in (("addr_cos", "norm_addr", (3, 4), True), ("squish_cos", "name_squish", (4, 5), False))})
    cosines = {(r["s1_id"], r["cand_id"]): (r["addr_cos"], r["squish_cos"]) for r in cosines.collect()}
    for size in (600_000, 1):
        monkeypatch.setattr(pairs, "PAIRS", size)
        met = features.attached_with_cosines(stored, records, index, best="name_cos").withColumn("cand_source", S.source_number(F.col("cand_id")))
        got = features.native_features(met).drop("embed_cos")
        also = features.pair_similarities(stored, records.select("entity_id", "core_name", "norm_addr"), best="name_cos").select("s1_id", "cand_id", *[f for f in FEATURES if f.startswith("rf_")]).collect()
        assert sorted(also) == sorted(plain.select("s1_id", "cand_id", *[f for f in FEATURES if f.startswith("rf_")]).collect())
        native = [c for c in kept if not c.startswith("rf_")]
        assert sorted(got.select(native).collect()) == sorted(plain.select(native).collect())
        assert {(r["s1_id"], r["cand_id"]): (r["addr_cos"], r["squish_cos"]) for r in got.collect() if r["cand_id"] != "S2-1"} == {k: v for k, v in cosines.items() if k in {(r[0], r[1]) for r in want} and k[1] != "S2-1"}


def test_grams_of_batches_are_those_of_single_texts(records):
    from weftlink.operators import tfidf

    texts = ["ab  cde", "", "a", "é ab\0c", "abcdefgh"]
    for some in (texts, texts[:3] + texts[4:]):
        for low, high, within in ((1, 3, True), (3, 4, True), (3, 9, True), (2, 3, False)):
            rows, codes, _ = tfidf._occurrences(some, low, high, within)
            assert sorted(zip(rows.tolist(), codes.tolist())) == sorted((i, tfidf._code(p)) for i, t in enumerate(some) for p in tfidf._pieces(t, low, high, within))
    # records of one id count their grams together, as the long rows do
    twice = records.unionByName(records.filter("entity_id = 'S1-1'").withColumn("core_name", F.lit("apex apex apex")))
    for rows in (records, twice):
        known = tfidf.vocabulary(rows, "core_name", 3, 4, min_df=1)
        want = tfidf.text_grams(rows, "core_name", 3, 4, min_df=1)[1].count()
        assert len(known.codes) == want


def test_candidates_by_texts_are_those_by_arrays(records, monkeypatch):
    """Without vectors none is made or written: texts are met, with the pairs and cosines that arrays give."""
    from weftlink.config import Config

    cfg = Config(min_df=1, min_name_cosine=0.01, min_addr_cosine=0.01, min_squish_cosine=0.01)
    want = sorted(B.candidates(records, cfg, B.record_vectors(records, cfg)).select("s1_id", "cand_id", "cand_source", "name_cos").collect())
    monkeypatch.setattr(B, "record_vectors", None)
    got = sorted(B.candidates(records, cfg).select("s1_id", "cand_id", "cand_source", "name_cos").collect())
    assert len(got) >= 3 and [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want])
