import itertools
import random

import pytest
from pyspark.sql import functions as F

from weftlink.llm import addresses, matching, names
from weftlink.llm.fold import fold, osa

ADDRESSES = [
    ("a1", "12 Robitaruk Marg, Kamita, BI 378797"), ("a2", "#12 Robitaruk Mrg, Kamita - 378 797, Opp. Clock Tower"), ("a3", "Kamita, BI 378797, No. 12 Robitarruk Marg"),
    ("a4", "１２ Robitaruk Marg, Suite 4B, Kami., 378797"), ("a5", "12 Robitaruk Marg, Polzanruk, MO 655645"), ("a6", "13 Robitaruk Marg, Kamita, BI 378797"),
    ("a7", "Fl 12, 13 Robitaruk Marg, Kamita, BI 378797"), ("a8", None), ("a9", ""), ("b1", "no number here"), ("b2", "No number here."), ("c1", "x" * 30_000), (None, "12 Robitaruk Marg, Kamita"),
]


def test_parse():
    assert addresses.parse("H.No. 85 Robitaruk Marg, Apt G4, Kamita, BI, 378797") == ("robitaruk", "kamita", "378797", "85", "g4")
    assert addresses.parse("Opposite Tram Shed, 119 Midelhalnor Mkt., Vimokapur, RO 536346, India", "", frozenset(["india"])) == ("midelhalnor", "vimokapur", "536346", "119", "")
    assert addresses.parse("54, bd de Sarnakgarwe, 14525 Kepolhal")[:4] == ("sarnakgarwe", "kepolhal", "14525", "54")
    assert addresses.parse("") == ("", "", "", "", "")


def test_same_building(spark):
    more = [(f"z{i}", f"{100 + i} Robitaruk Marg, Kamita, BI 378797") for i in range(5)] + [(f"y{i}", f"{100 + i} Robitaruk Marg, Polzanruk, MO 655645") for i in range(5)]
    df = spark.createDataFrame([(i, a, "India", "s") for i, a in ADDRESSES + more], "id string, address string, country string, street string")
    got = {(r["id_a"], r["id_b"]) for r in addresses.same_building(df, "id", "address", "country").collect()}
    assert got == {*itertools.combinations(["a1", "a2", "a3", "a4"], 2), ("a6", "a7"), ("b1", "b2")}
    assert addresses.same_building(df.limit(0), "id", "address", "country").count() == 0
    again = addresses.same_building(df.unionAll(df), "id", "address", "country")
    assert again.count() == len(got)


def test_osa_against_plain():
    rng = random.Random(5)

    def plain(a, b):
        d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
        for i in range(len(a)):
            for j in range(len(b)):
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
                if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a) - 1, len(b) - 1]

    for _ in range(3000):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 8))) for _ in "xy")
        for most in (1, 2, 3):
            assert osa(a, b, most) == min(plain(a, b), most + 1), (a, b, most)


def test_segment_join_against_all_pairs(spark):
    rng = random.Random(6)
    base = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(6, 24))) for _ in range(40)]
    cores = set(base)
    for c in base:
        for _ in range(3):
            t = list(c)
            for _ in range(rng.randint(1, names.allowed(len(c)))):
                i = rng.randrange(len(t) - 1)
                kind = rng.choice("sdi")
                if kind == "s":
                    t[i] = rng.choice("abcdefgh")
                elif kind == "d":
                    del t[i]
                else:
                    t.insert(i, rng.choice("abcdefgh"))
            cores.add("".join(t))
    cores = sorted(cores)
    df = spark.createDataFrame([(c, [c], ["w"] if i % 3 else []) for i, c in enumerate(cores)], "core string, arranged array<string>, commons array<string>")
    got = {tuple(sorted((r["a"], r["b"]))) for r in names.near_cores(df).collect()}
    want = {
        (a, b) for a, b in itertools.combinations(cores, 2) if min(len(a), len(b)) >= 6 and osa(a, b, 3) <= names.allowed(min(len(a), len(b)))
    }
    # edits without swaps: every pair must be found
    assert got <= want
    plain = {(a, b) for a, b in want if _levenshtein(a, b) <= names.allowed(min(len(a), len(b)))}
    assert plain <= got


def _levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


NAMES = [
    ("n1", "Lisrober Vonakmo Carpets Manufacturing Pvt Ltd"), ("n2", "Carpets Lisrober Vonakmo Mfg. Pvt. Ltd"), ("n3", "LISROBER VONAKKMO CARPETS"), ("n4", "lisrobervonakmocarpets.example"),
    ("n5", "Sarfen t/a Vonakmo Lisrober Carpets LLP"), ("n6", "Lisrober Dufenmi Carpets Ltd"), ("n7", None), ("n8", ""), ("n9", "Ｌｉｓｒｏｂｅｒ Vоnаkmо Carpets"), ("m1", "Талрирук Полталис ООД"), ("m2", "Talriruk Poltalis OOD"),
    ("m3", "x" * 20_000), (None, "Lisrober Vonakmo Carpets"),
]


def test_same_organisation(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(4)).title()
    other = [(f"z{i}", f"{word()} {word()} Carpets") for i in range(40)]
    df = spark.createDataFrame([(i, n, "c") for i, n in NAMES + other], "id string, name string, core string")
    got = {(r["id_a"], r["id_b"]) for r in names.same_organisation(df, "id", "name").collect()}
    linked = {*itertools.combinations(["n1", "n2", "n3", "n4", "n5", "n9"], 2), ("m1", "m2")}
    assert {p for p in linked if p[0] < p[1]} <= {tuple(sorted(p)) for p in got}
    assert not any(x in p for p in got for x in ("n6", "n7", "n8", "m3"))
    assert names.same_organisation(df.limit(0), "id", "name").count() == 0


def test_no_near_core_is_dropped(spark):
    """Five equally rare spellings near each other are one class; a spelling between two classes pairs with both."""
    five = [f"Brontavilka{x} Carpets" for x in ("", "r", "s", "t", "v")]
    # the one between is drawn to the first of two equally frequent cores that are not near each other
    between = ["Gomsteradinu Carpets", "Gomsteradinu Carpets Ltd", "Gomsteradivx Carpets", "Gomsterakqvx Carpets", "Gomsterakqvx Carpets Ltd"]
    df = spark.createDataFrame([(f"a{i}", n) for i, n in enumerate(five)] + [(f"b{i}", n) for i, n in enumerate(between)], "id string, name string")
    classes = {r["name"]: r["class_id"] for r in names.name_classes(df, "name").collect()}
    assert len({classes[n] for n in five}) == 1
    assert classes[between[0]] == classes[between[2]] != classes[between[3]]
    got = {(r["id_a"], r["id_b"]) for r in names.same_organisation(df, "id", "name").collect()}
    assert {*itertools.combinations([f"a{i}" for i in range(5)], 2)} <= got
    near = {("b0", "b1"), ("b0", "b2"), ("b1", "b2"), ("b2", "b3"), ("b2", "b4"), ("b3", "b4")}
    assert {p for p in got if p[0][0] == "b"} == near


def test_words():
    assert names.words_of("M/s. James Talwero & Rigaro Tyres (P) Ltd.") == ["james", "talwero", "rigaro", "tires"]
    assert names.words_of("Jim Talwero L.L.C.") == ["james", "talwero"]
    assert names.words_of("Ltd") == ["ltd"]
    assert fold("Straße Łódź") == "strasse lodz"


def test_cascade(spark):
    make = lambda rows: spark.createDataFrame(rows, "id string, name string, address string, country string")
    ours = make([("S1-1", "Lisrober Vonakmo Carpets Ltd", "12 Robitaruk Marg, Kamita, BI 378797", "India"), ("S1-2", "Dufenmi Halbital Tyres", "13 Robitaruk Marg, Kamita, BI 378797", None), ("S1-3", None, None, None), ("S1-4", "", "90 Nerukgar Nagar, Kamita, BI 378111", "")])
    theirs = make(
        [
            ("S2-1", "Carpets Lisrober Vonakmo", "#12 Robitaruk Mrg, Kamita 378797", "india"), ("S2-2", "LVC Ltd", "12 Robitaruk Marg, Kamita, BI 378797", "x"), ("S2-3", "Lisrober Vonakmo Carpets", None, ""),
            ("S2-4", "Lisrober Vonakmo Carpets", "77 Nejagulis Road, Dorkaja, RO 122947", ""), ("S2-5", "Somebody Else Dairy", "12 Robitaruk Marg, Kamita, BI 378797", ""), ("S3-1", None, "13 Robitaruk Marg, Kamita, BI 378797", ""),
            ("S3-2", None, None, None), ("S2-1", "Carpets Lisrober Vonakmo", "#12 Robitaruk Mrg, Kamita 378797", "india"),
        ]
    )
    labels = spark.createDataFrame([("S1-1", ["S2-1", "S2-2", "S2-3"]), ("S1-2", [])], "id string, ids array<string>")
    out = matching.cascade(ours, theirs, labels, least=0.3)
    got = {(r["reference_id"], r["target_id"]): r["confidence"] for r in out.collect()}
    assert {("S1-1", "S2-1"), ("S1-1", "S2-2"), ("S1-1", "S2-3"), ("S1-2", "S3-1")} <= set(got)
    assert not {t for _, t in got} & {"S2-4", "S3-2"}
    assert all(0 <= c <= 1 for c in got.values()) and len({t for _, t in got}) == len(got)
    assert matching.cascade(ours.limit(0), theirs, labels.limit(0)).count() == 0


@pytest.mark.parametrize("hot", [1000, 1])
def test_most_shared_keys_win(spark, monkeypatch, hot):
    """Of records in one building that share words with a target, the one that shares most counts, not the smallest id."""
    monkeypatch.setattr(matching, "_HOT", hot)
    make = lambda rows: spark.createDataFrame(rows, "id string, name string, address string, country string")
    at = "12 Robitaruk Marg, Kamita, BI 378797"
    ours = make([("S1-1", "Alvorita Bruskanel", at, "India"), ("S1-2", "Bruskanel Charmodil", at, "India"), ("S1-3", "Charmodil Bruskanel", at, "India")])
    theirs = make([("S2-1", "Charmodil Bruskanel Xemprovat", at, "India"), ("S2-2", "Bruskannel Charmodill Zugrewitol", at, "India")])
    out = matching.cascade(ours, theirs, spark.createDataFrame([], "id string, ids array<string>"), least=0.3)
    got = {r["target_id"]: (r["reference_id"], r["rule"]) for r in out.collect()}
    assert got == {"S2-1": ("S1-2", "word of the name, building"), "S2-2": ("S1-2", "word within a letter, building")}


def test_latest_labels(spark):
    rows = [("S1-1", "S2-1", "2025-01-01"), ("S1-1", " S2-2,,S2-2 ,S3-10", "2025-02-01"), ("S1-2", None, "2025-01-01"), ("S1-2", None, "2025-01-01"), (None, "S2-1", None)]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    assert {r["id"]: r["ids"] for r in matching.latest_labels(df, "a", "b", "c").collect()} == {"S1-1": ["S2-2", "S3-10"], "S1-2": []}


@pytest.mark.parametrize(("a", "b", "short"), [("plst", "plastics", True), ("manu", "manufacturing", True), ("hdm", "handloom", False), ("abc", "abd", False)])
def test_abbreviations(a, b, short):
    assert names.short_for(a, b) is short


def test_one_street_name_in_many_towns(spark):
    """Streets of one name in ten thousand towns are not compared with each other: keys hold the locality."""
    from weftlink.llm.addresses import gazetteer, resolve, street_keys

    rng = random.Random(7)
    towns = sorted({"".join(rng.choice("bcdfghjklmnprstvz") + rng.choice("aeiou") for _ in range(4)) for _ in range(11_000)})[:10_000]
    # any two postcodes differ in two digits or more, so no locality is taken for a misspelling of another
    posts = [f"{i:04d}{i * 37 % 97:02d}" for i in range(len(towns))]
    rows = [("mainstreet", t, p, 3) for t, p in zip(towns, posts)] + [("mainstrete", towns[5], posts[5], 1), ("mainstreet", "", "", 1)]
    df = spark.createDataFrame(rows, "street string, town string, post string, n long")
    per_key = df.select(F.explode(F.array_distinct(street_keys("street", "town", "post", True))).alias("k")).groupBy("k").count()
    assert per_key.agg(F.sum(F.col("count") * F.col("count"))).first()[0] < 100 * 22 * len(rows)
    entries = gazetteer(df).cache()
    centers = {(r["street"], r["town"]): r["center"] for r in entries.collect()}
    assert len(set(centers.values())) == len(towns) and centers["mainstrete", towns[5]] == centers["mainstreet", towns[5]]
    found = {(r["street"], r["town"]): r["street_id"] for r in resolve(df, entries).collect()}
    assert found["mainstrete", towns[5]] == found["mainstreet", towns[5]] and found["mainstreet", ""].startswith("own|")
    assert len(set(found.values())) == len(towns) + 1


def test_drawing_goes_on_to_the_end(spark):
    """Spellings that are drawn one to the next all have the last one's identifier."""
    from weftlink.llm.addresses import gazetteer

    chain = ["abcdefghijklmnopqrst", "abcdefghijklmnopqr", "abcdefghijklmnop", "abcdefghijklmn", "abcdefghijkl", "abcdefghij"]
    df = spark.createDataFrame([(s, "town", "10001", 10 - i) for i, s in enumerate(chain)], "street string, town string, post string, n long")
    assert len({r["center"] for r in gazetteer(df).collect()}) == 1


def _shuffled_rows(df):
    """Rows that the plan of a frame that was run has written to shuffles."""

    def walk(plan):
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(plan.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(plan.plan())
        found = plan.metrics().get("shuffleRecordsWritten")
        return (found.get().value() if found.isDefined() else 0) + sum(walk(plan.children().apply(i)) for i in range(plan.children().size()))

    df.collect()
    return walk(df._jdf.queryExecution().executedPlan())


def _spellings_of(n, seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(6, 24))) for _ in range(n)]
    wrong = [c[:i] + rng.choice("abcdefgh") + c[i + 1 :] for c in base for i in [rng.randrange(len(c))]]
    return [(c, [c], [f"w{i % 7}"] if i % 9 else []) for i, c in enumerate(sorted({*base, *wrong}))]


def test_near_cores_shuffle_cores_not_keys(spark):
    """A core goes to a few groups, not to one for each of its segments."""
    rows = _spellings_of(400, 11)
    df = spark.createDataFrame(rows, "core string, arranged array<string>, commons array<string>")
    assert 0 < _shuffled_rows(names.near_cores(df)) < 12 * len(rows)


def test_near_cores_in_parts(spark, monkeypatch):
    """Parts of the groups that all cores meet, and small batches of pairs, change nothing."""
    df = spark.createDataFrame(_spellings_of(150, 12), "core string, arranged array<string>, commons array<string>")
    want = {(r["a"], r["b"]) for r in names.near_cores(df).collect()}
    core = {r["core"]: set(r["commons"]) for r in df.collect()}
    assert want and all(not core[a] or not core[b] or core[a] & core[b] for a, b in want)
    monkeypatch.setattr(names, "_PART", 40)
    assert {(r["a"], r["b"]) for r in names.near_cores(df).collect()} == want
    few = [(c, [c]) for c in core if len(c) == 8]
    whole = set(names._near_in(8, few, few))
    monkeypatch.setattr(names, "_PAIRS", 3)
    monkeypatch.setattr(names, "_CELLS", 64)
    assert whole and set(names._near_in(8, few, few)) == whole


def test_known_words_against_all_of_them():
    rng = random.Random(13)
    common = sorted({"".join(rng.choice("abcde") for _ in range(rng.randint(3, 10))) for _ in range(200)})
    for w in ["".join(rng.choice("abcde") for _ in range(rng.randint(5, 10))) for _ in range(500)]:
        most = names._edits(w)
        near = sorted((osa(w, c, most), c) for c in common if len(c) >= 4)
        if w not in common and near[0][0] <= most:
            lexicon = names.Lexicon(common)
            assert lexicon.known(w) == lexicon.form.get(near[0][1], near[0][1])


@pytest.mark.parametrize("crowd", [32, 1, 0])
def test_crowded_buildings_match_as_others(spark, monkeypatch, crowd):
    """Whether a building's names are compared as they are or met by key, the same record wins."""
    make = lambda rows: spark.createDataFrame(rows, "id string, name string, address string, country string")
    at, by = "12 Robitaruk Marg, Kamita, BI 378797", "15 Robitaruk Marg, Kamita, BI 378797"
    ours = make([("S1-1", "Alvorita Bruskanel", at, ""), ("S1-2", "Bruskanel Charmodil", at, ""), ("S1-3", "Gantovirel Dufenmi", by, ""), ("S1-4", None, by, ""), ("S1-5", "Bruskanel", None, "")])
    theirs = make([("S2-1", "Charmodil Bruskanel Xemprovat", at, ""), ("S2-2", "Bruskannel Charmodill Zugrewitol", at, ""), ("S2-3", "Gantovirell Holmapetun", by, ""), ("S2-4", "Bruskanel Worpatemi", None, "")])
    monkeypatch.setattr(matching, "_CROWD", crowd)
    monkeypatch.setattr(matching, "_HOT", 1)
    out = matching.cascade(ours, theirs, spark.createDataFrame([], "id string, ids array<string>"), least=0.3)
    got = {r["target_id"]: (r["reference_id"], r["rule"]) for r in out.collect()}
    spelled = "word within a letter, building"
    assert got == {"S2-1": ("S1-2", "word of the name, building"), "S2-2": ("S1-2", spelled), "S2-3": ("S1-3", spelled)}
