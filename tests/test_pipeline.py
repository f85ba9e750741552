import pytest

from weftlink.operators import blocking as B
from weftlink.operators import synth
from weftlink.plans import pipeline
from weftlink.sources import records as S


def test_train_and_predict(spark, tmp_path):
    """End to end over files: every S1 record has a line, a target one owner, and matches are candidates."""
    for name, countries, seed in (("train", {"US": 40, "India": 40}, 1), ("test", {"US": 15, "France": 10}, 2)):
        for kind, rows in synth.split(spark, countries, seed).items():
            lines = ["\t".join(r) for r in rows.collect()]
            (tmp_path / f"{name}_{kind}.tsv").write_text("\n".join(["\t".join(rows.columns), *lines]) + "\n")
    cfg = pipeline.configured(
        data_dir=str(tmp_path), output_dir=str(tmp_path / "out"), model_dir=str(tmp_path / "model"), cache_dir=str(tmp_path / "cache"), trees=5, min_trees=5, max_depth=3, min_child=2, knn_name=5, loco_min_positives=10_000
    )
    trained = pipeline.run(spark, cfg, "run")
    assert 0.36 <= trained.threshold <= 0.95 and trained.report["macro_f"] > 0.3
    out = {}
    for name in ("candidate_pairs", "matching_results"):
        rows = S.read_tsv(spark, str(tmp_path / "out" / f"{name}.tsv")).collect()
        assert len(rows) == 25
        out[name] = {r[0]: {x for x in r[1].split(",") if x} for r in rows}
    assert all(ids <= out["candidate_pairs"][s] for s, ids in out["matching_results"].items())
    owned = [t for ids in out["matching_results"].values() for t in ids]
    assert owned and len(owned) == len(set(owned))
    again = pipeline.Trained.load(spark, cfg.model_dir)
    assert again.threshold == trained.threshold
    assert {r[0] for r in again.seen.collect()} == {r[0] for r in trained.seen.collect()} == {"us", "india"}
    order = [x.split("\t")[0] for x in (tmp_path / "test_source1.tsv").read_text().splitlines()[1:]]
    assert [x.split("\t")[0] for x in (tmp_path / "out" / "matching_results.tsv").read_text().splitlines()[1:]] == order
    # a second run reads what the first one kept; other knobs or other inputs have folders of their own
    made = []
    keep = pipeline.keeper(spark, cfg, "test")
    for name in ("records", "candidates", "name_cos"):
        assert keep(name, lambda: made.append(name)).count()
    assert not made
    with pytest.raises(ZeroDivisionError):
        pipeline.keeper(spark, pipeline.configured(cache_dir=cfg.cache_dir, data_dir=cfg.data_dir, knn_name=6), "test")("records", lambda: 1 // 0)
    (next((tmp_path / "cache").glob("*/test/records")) / "_SUCCESS").unlink()
    with pytest.raises(ZeroDivisionError):
        keep("records", lambda: 1 // 0)


def test_embeddings_reach_candidates_and_features(spark):
    """A pair of which only the embedding blocker knows is a candidate, with its cosine as a feature."""
    rows = [("S1-1", "Lisrober Vonakmo", "", "India"), ("S2-1", "Lisrober Vonakmi", "", "India"), ("S2-2", "Dufenmi Halbital", "", "India")]
    records = spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string")
    only = dict(knn_name=1, min_name_cosine=2.0, use_addr_blocker=False, use_squish_blocker=False, use_postal_blocker=False)
    assert pipeline._prepared(records, pipeline.configured(**only))[1].count() == 0
    normal, found, vectors = pipeline._prepared(records, pipeline.configured(use_embeddings=True, **only))
    assert [(r["s1_id"], r["cand_id"]) for r in found.collect()] == [("S1-1", "S2-1")]
    assert 0.55 <= pipeline._features(found, normal, vectors).first()["embed_cos"] < 1
    near = pipeline.configured(use_embeddings=True, exact_embed_targets=1, **only)
    assert [(r["s1_id"], r["cand_id"]) for r in pipeline._prepared(records, near)[1].collect()] == [("S1-1", "S2-1")]
    cfg = pipeline.configured(use_embeddings=True, embed_backend="sentence-transformers", **only)
    with pytest.raises(ValueError):
        pipeline._prepared(records, cfg)
    with pytest.raises(ValueError):
        B.candidates(normal, cfg)
    # any importable function can take the model's place
    other = pipeline.configured(use_embeddings=True, embed_backend="numpy:module_of_no_such_name", **only)
    with pytest.raises(AttributeError):
        B.candidates(normal, other)


def test_models_are_pluggable(spark):
    import numpy as np

    from weftlink.operators import encoders

    rows = spark.createDataFrame([("a", 1, "x", "aab"), ("b", 2, "x", ""), ("c", 2, "x", None)], "entity_id string, source int, country_key string, text string")
    counts = lambda model, device: lambda texts: np.array([[t.count("a"), t.count("b")] for t in texts])
    got = {r["entity_id"]: (r["grams"], r["w"]) for r in encoders.model_encoder(counts, "", "cpu", 2)(rows).collect()}
    assert got["a"] == ([0, 1], pytest.approx([2 / 5**0.5, 1 / 5**0.5])) and got["b"] == got["c"] == ([], [])
    pairs = spark.createDataFrame([("a", "a"), ("a", None)], "a string, b string")
    same = lambda model, device: lambda ps: [3.0 if x == y else -3.0 for x, y in ps]
    scores = [r[0] for r in pairs.select(encoders.model_reranker(same, "", "cpu", 8)("a", "b")).collect()]
    assert scores == pytest.approx([1 / (1 + np.exp(-3.0)), 1 / (1 + np.exp(3.0))])


def test_reranking_uses_each_pairs_threshold(spark):
    """A cold pair in its own band is reranked, and one that only the warm threshold would let through is dropped."""
    rows = [(f"S1-{i}", i, "France" if cold else "India") for i, cold in enumerate((False, True, True))]
    normal = spark.createDataFrame([(r[0], "same", "", "") for r in rows] + [(f"S2-{i}", "same", "", "") for i in range(3)], "entity_id string, core_name string, norm_addr string, country_key string")
    scored = spark.createDataFrame([("S1-0", "S2-0", 2, 0.45, "india"), ("S1-1", "S2-1", 2, 0.70, "france"), ("S1-2", "S2-2", 2, 0.60, "france")], "s1_id string, cand_id string, cand_source int, score double, country_key string")
    seen = spark.createDataFrame([("india",)], "country_key string")
    cfg = pipeline.configured(use_cross_encoder=True)
    kept = pipeline.decided(pipeline.D.routed(scored, 0.5, 0.8, seen), normal, cfg)
    assert {r["s1_id"]: r["score"] for r in kept.collect()} == {"S1-0": 0.725, "S1-1": 0.85}
