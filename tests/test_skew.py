import random

import pytest

from weftlink.operators import skew
from weftlink.operators.skew import key_profile


def plain(rows):
    out = {}
    for key, name in rows:
        out.setdefault((key or "").strip(" ").lower(), []).append(name)
    return {
        k: (len(v), len({x for x in v if x}), sorted(len(x) for x in v if x)[(sum(map(bool, v)) + 1) // 2 - 1] if any(v) else None) for k, v in out.items()
    }


def profile(df):
    return {r["key"]: (r["n_records"], r["n_names"], r["mid_len"]) for r in key_profile(df, "country", "name").collect()}


@pytest.mark.parametrize("most", [1 << 15, 2])
def test_against_plain_loop(spark, most, monkeypatch):
    """Also where a split hands its arrays on after every few keys."""
    monkeypatch.setattr(skew, "KEYS", most)
    rng = random.Random(1)
    hot = [(rng.choice(["US", " us", "Us "]), rng.choice(["a" * rng.randint(1, 300), None, ""])) for _ in range(900)]
    cold = [(rng.choice(["fr", "DE", None, "", "  "]), "é" * rng.randint(1, 40)) for _ in range(300)]
    rows = hot + cold + [("only", None), ("long", "x" * 200_000)]
    df = spark.createDataFrame(rows, "country string, name string").repartition(5)
    assert profile(df) == plain(rows)


def test_more_keys_than_a_dictionary_holds(spark):
    df = spark.range(150_000).selectExpr("concat('k', id % 70000) AS country", "repeat('x', cast(id % 7 AS int)) AS name")
    got = key_profile(df, "country", "name").agg({"n_records": "sum", "key": "count", "n_names": "sum"}).first().asDict()
    assert got == {"sum(n_records)": 150_000, "count(key)": 70_000, "sum(n_names)": df.filter("name <> ''").distinct().count()}


def test_empty_and_clashing_columns(spark):
    assert profile(spark.createDataFrame([], "country string, name string")) == {}
    df = spark.createDataFrame([("a", "b", "x", "y", 1)], "country string, name string, key string, n string, len int")
    assert profile(df) == {"a": (1, 1, 1)}
