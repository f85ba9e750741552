import random

from weftlink.llm import lookalike, topn


def ranked(df, n=5, **knobs):
    items = topn.list_items(df, "g", "ids", "scores")
    return sorted((r["grp"], r["rank_no"], r["item"]) for r in topn.top_n(items, n, **knobs).collect())


def test_top_n_against_plain_loop(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(300):
        g = "hot" if rng.random() < 0.5 else f"g{rng.randint(1, 20)}"
        ids = [rng.choice(["", " ", "X9-1", f" S2-{rng.randint(1, 60):03d} ", f"S3-{rng.randint(1, 60):03d}"]) for _ in range(rng.randint(1, 12))]
        rows.append((g, ",".join(ids), [rng.choice([None, round(rng.random(), 1)]) for _ in ids]))
    rows += [(None, "S2-1", [1.0]), ("null", None, []), ("empty", "", []), ("short", "S2-1,S2-2", [0.5]), rows[0], rows[0]]
    best = {}
    for g, ids, scores in rows:
        for i, s in zip((ids or "").split(","), scores):
            i = i.strip()
            if g and s is not None and i[:3] in ("S2-", "S3-"):
                best.setdefault(g, {})
                best[g][i] = max(best[g].get(i, -1), s)
    want = sorted((g, k, i) for g, d in best.items() for k, (_, i) in enumerate(sorted((-s, i) for i, s in d.items())[:5], 1))
    df = spark.createDataFrame(rows, "g string, ids string, scores array<double>")
    assert ranked(df) == want
    assert ranked(df, subgroups=1) == want and ranked(df, subgroups=1000) == want


def test_top_n_of_nothing_and_clashing_columns(spark):
    assert ranked(spark.createDataFrame([], "g string, ids string, scores array<double>")) == []
    df = spark.createDataFrame([("a", "S2-1", [1.0], "x", 3, 2)], "g string, ids string, scores array<double>, item string, score int, sub int")
    assert ranked(df) == [("a", 1, "S2-1")]


SAME = [
    ("Café Ｒｏｕｇｅ", "Café Rouge"), ("Office Park", "Oﬃce Park"), ("A B", "A B"), ("A B", "A　B"), ("AB", "A​B"), ("Paco", "Расо"),
    ("co-op", "co‑op"), ("Ёlka", "Ëlka"), ("Ohm", "Ο‍hm"), ("12", "１２"),
]
DIFFERENT = [("cafe", "café"), ("Abc", "abc"), ("a b", "b a"), ("a.b", "ab"), ("a-b", "ab"), ("strasse", "straße"), ("l", "ł"), ("x2", "x²")]


def test_what_shows_and_what_does_not(spark):
    rows = [(f"s{i}{k}", v, None) for i, p in enumerate(SAME) for k, v in enumerate(p)] + [(f"d{i}{k}", v, "") for i, p in enumerate(DIFFERENT) for k, v in enumerate(p)]
    df = spark.createDataFrame(rows, "id string, name string, addr string")
    got = {(r["id_a"], r["id_b"]) for r in lookalike.same_look_pairs(df, "id", ["name", "addr"]).collect()}
    assert {(f"s{i}0", f"s{i}1") for i in range(len(SAME))} <= got
    assert not any(a[0] == "d" for p in got for a in p)


def test_one_form(spark):
    long = "Ａ" * 50_000
    rows = [("1", "Ａb", "x", "c"), ("2", "Ab", "x", "c"), ("3", None, "x", "c"), ("4", "", "x", "c"), ("5", long, "x", "c"), ("6", "A" * 50_000, "x", "c"), ("2", "Ab", "x", "c")]
    df = spark.createDataFrame(rows, "id string, name string, value string, canonical string")
    out = {(r["id"], r["name"]) for r in lookalike.canonicalise(df, ["name"]).collect()}
    assert out == {("1", "Ab"), ("2", "Ab"), ("3", None), ("4", ""), ("5", "A" * 50_000), ("6", "A" * 50_000)}
    assert lookalike.canonicalise(df, ["name"]).columns == df.columns
    pairs = lookalike.same_look_pairs(df, "id", ["name"])
    assert {(r["id_a"], r["id_b"]) for r in pairs.collect()} == {("1", "2"), ("5", "6")}
    assert lookalike.same_look_pairs(df.limit(0), "id", ["name"]).count() == 0
