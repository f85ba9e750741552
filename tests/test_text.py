import pytest
from pyspark.sql import functions as F

from weftlink.functions import fuzzy
from weftlink.functions import text as X
from weftlink.functions.vectors import cosine, hashing_embedding
from weftlink.operators.tfidf import char_grams


def value(spark, column, text):
    return spark.createDataFrame([(text,)], "x string").select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("text", "postal"),
    [("12 Main, NY 10001", "10001"), ("1 A 1234567", "234567"), ("12345-6789", ""), ("560001 12", ""), ("400 001", ""), ("560001, near ATM", "560001"), (None, "")],
)
def test_postal(spark, text, postal):
    assert value(spark, X.postal_code, text) == postal


def test_fold_drops_what_has_no_ascii_form(spark):
    assert value(spark, X.ascii_fold, "Société Łódź straße ﬁ") == "Societe odz strae fi"
    assert value(spark, X.ascii_fold, "Ｄｒｉｖｅ ½ №") == "Drive 12 No"
    assert value(spark, X.ascii_fold, None) == ""


def test_names(spark):
    assert value(spark, X.without_sites, "acme.com.inc st.company foo.co.in a.income") == "acme .inc st.company foo   a.income"
    core = lambda c: X.core_name(X.norm_name(c))
    assert value(spark, core, "Apex & Star Foods Pvt. Ltd.") == "apex star foods"
    assert value(spark, core, "The Company") == "the company"
    assert value(spark, core, "") == ""
    assert value(spark, lambda c: X.acronym(core(c)), "Apex & Star Foods Pvt. Ltd.") == "asf"
    assert value(spark, X.norm_address, "12 MG Rd, Opp Bus Stand") == "12 mg road opposite bus stand"
    assert value(spark, X.id_list, "S2-1, S3-2,,S2-1") == ["S2-1", "S3-2"]
    assert value(spark, X.id_list, " S2-10,S3-00") == ["S2-10", "S3-00"]


def test_bigrams(spark):
    assert value(spark, X.bigrams, "a") == ["a"]
    assert value(spark, X.bigrams, "") == [""]
    row = spark.sql("SELECT 'ab' a, 'abc' b").select(X.jaccard(X.bigrams(F.col("a")), X.bigrams(F.col("b"))).alias("j")).first()
    assert row["j"] == 0.5


def test_contact_keys(spark):
    keys = X.contact_keys(F.lit("call +91 9876543210 or mail a.b@x.com, www.shop.co 1234567"))
    row = spark.range(1).select(*[v.alias(k) for k, v in keys.items()]).first()
    assert row["emails"] == ["a.b@x.com"] and "shop.co" in row["domains"] and "1234567" in row["long_numbers"]
    keys = X.contact_keys(F.lit("9876543210123 acme.company x@y.z9"))
    row = spark.range(1).select(*[v.alias(k) for k, v in keys.items()]).first()
    assert row["phones"] == ["7654321012"] and row["domains"] == ["acme.com"] and row["emails"] == ["x@y.z9"] and row["long_numbers"] == ["9876543210123"]


def test_char_grams(spark):
    df = spark.createDataFrame([("1", "ab"), ("2", "abc"), ("3", "")], "id string, t string")
    got = {(r["id"], r["gram"]) for r in char_grams(df, ["id"], "t", 4, 5).collect()}
    assert got == {("1", " ab "), ("2", " abc"), ("2", "abc "), ("2", " abc ")}
    plain = {r["gram"] for r in char_grams(df, ["id"], "t", 2, 3, within_words=False).collect()}
    assert plain == {"ab", "bc", "abc"}


def test_fuzzy():
    assert fuzzy.ratio("", "") == 1 and fuzzy.ratio("abcd", "abd") == pytest.approx(6 / 7)
    assert fuzzy.token_sort("star apex", "apex star") == 1
    assert fuzzy.token_set("apex star foods", "apex star") == 1 and fuzzy.token_set("", "a") == 0
    assert fuzzy.partial("star", "apex star foods") == 1 and fuzzy.partial("", "a") == 0
    assert 0 < fuzzy.token_set("apex star", "apex moon") < 1


def test_fuzzy_against_plain_dynamic_programme():
    from hypothesis import given
    from hypothesis import strategies as st

    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b):
                last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
        return row[-1]

    @given(st.text("abc ", max_size=12), st.text("abc ", max_size=12))
    def check(a, b):
        assert fuzzy._common(a, b) == lcs(a, b)

    check()


def test_hashing_embedding(spark):
    import zlib

    df = spark.createDataFrame([("1", "abc"), ("2", ""), ("3", None)], "id string, t string")
    got = {(r["id"], r["dim_no"]): r["value"] for r in hashing_embedding(df, "id", "t").collect()}
    plain = {}
    for n in (3, 4):
        for i in range(len("^abc$") - n + 1):
            h = zlib.crc32("^abc$"[i : i + n].encode())
            plain[h % 256] = plain.get(h % 256, 0) + (1 if h >> 20 & 1 else -1)
    length = sum(v * v for v in plain.values()) ** 0.5
    assert got == {("1", d): pytest.approx(v / length) for d, v in plain.items() if v}


def test_cosine(spark):
    row = spark.sql("SELECT array(1f, 0f) a, array(1f, 1f) b, array(0f, 0f) z").select(cosine(F.col("a"), F.col("b")).alias("c"), cosine(F.col("a"), F.col("z")).alias("z")).first()
    assert row["c"] == pytest.approx(2**-0.5) and row["z"] == 0


def test_fuzzy_of_batches_is_that_of_single_pairs():
    from hypothesis import given
    from hypothesis import strategies as st

    texts = st.lists(st.tuples(*[st.text("ab é漢 ", max_size=12) | st.text("abc ", min_size=60, max_size=70)] * 4), max_size=5)

    @given(texts)
    def check(rows):
        a, b, c, d = ([r[i] for r in rows] for i in range(4))
        got = fuzzy.scores(a, b, c, d)
        assert got["partial"].tolist() == [fuzzy.partial(x, y) for x, y in zip(a, b)]
        assert got["token_sort"].tolist() == [fuzzy.token_sort(x, y) for x, y in zip(a, b)]
        assert got["token_set"].tolist() == [1.0 if x == y != "" else fuzzy.token_set(x, y) for x, y in zip(a, b)]
        assert got["addr_token_set"].tolist() == [fuzzy.token_set(x, y) for x, y in zip(c, d)]

    check()
