import os
import random

import numpy as np
import pytest

from weftlink.llm import langid, mixing, packing, tokens

pytestmark = pytest.mark.skipif(not os.path.exists(tokens.TOKENIZER), reason="no tokenizer files")


def test_counts_equal_the_whole_encoding():
    rng = random.Random(7)
    p = tokens.pieces(tokens.TOKENIZER)
    texts = ["", " ", "a", "  a  b   c ", "x\n\n y \t z ", "don't  stop  now", "éa 你好 12 3"] + ["".join(rng.choice(["a", "b", " ", "  ", "\n", "'s", "9", ".", "é", "\t"]) for _ in range(60)) for _ in range(300)]
    sizes, vectors = p.measure(texts)
    assert sizes.tolist() == [len(p.encoding.encode_ordinary(t)) for t in texts]
    assert vectors.shape == (len(texts), tokens.DIMS) and np.isfinite(vectors).all()


def test_hilbert_neighbours():
    n = 8
    grid = np.array([(x, y, z) for x in range(n) for y in range(n) for z in range(n)])
    order = grid[np.argsort(packing.hilbert(grid, 3))]
    assert len(set(packing.hilbert(grid, 3))) == n**3
    assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


SPECS = "pack_id int, pack_name string, capacity_tokens int"


def test_packing(spark):
    rng = random.Random(8)
    rows = [(i, " ".join("word" for _ in range(rng.randint(1, 90)))) for i in range(200)] + [(900, None), (901, ""), (902, "word " * 1000), (5, "again")]
    df = spark.createDataFrame([(i, t, 1, "c") for i, t in rows], "doc_id long, text string, tokens int, id string")
    specs = spark.createDataFrame([(1, "small", 100), (2, "large", 400), (3, "none", None)], SPECS)
    out = packing.pack(df, "doc_id", "text", specs, range_tokens=3000).collect()
    sizes = {}
    for i, t in rows:
        if t is not None:
            sizes.setdefault(i, []).append(len(tokens.pieces(tokens.TOKENIZER).encoding.encode_ordinary(t)))
    for name, capacity in (("small", 100), ("large", 400)):
        mine = [r for r in out if r["pack_name"] == name]
        boxes, docs = {}, {}
        for r in mine:
            boxes[r["container_id"]] = boxes.get(r["container_id"], 0) + r["tokens"]
            docs[r["doc_id"]] = docs.get(r["doc_id"], 0) + r["tokens"]
        assert docs == {i: sum(s) for i, s in sizes.items()}
        assert max(boxes.values()) <= capacity
        assert {r["doc_id"] for r in mine if r["n_pieces"] > 1} == {i for i, s in sizes.items() if max(s) > capacity}
        assert sum(boxes.values()) / (len(boxes) * capacity) > 0.85
    assert packing.pack(df.limit(0), "doc_id", "text", specs).count() == 0


def test_mixing(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice("aab"), "word " * rng.randint(1, 60)) for i in range(400)] + [(800, "a", None), (801, None, "word"), (802, "b", "")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, source string, text string, tokens int, mix_id int")
    targets = spark.createDataFrame([(1, "a", 0.4, 2), (1, "b", 0.6, 3), (2, "a", 0.1, 1), (2, "b", 0.9, 1), (3, "a", 0.0, 4), (3, "none", 0.5, 4)], "mix_id int, source string, target_share double, max_repeats int")
    copies, shares = mixing.mix(df, targets)
    size = {}
    for i, s, t in rows:
        if t is not None:
            n = len(tokens.pieces(tokens.TOKENIZER).encoding.encode_ordinary(t))
            size[s] = size.get(s, 0) + n
    total = sum(size.values())
    got = {(r["mix_id"], r["source"]): r for r in shares.collect()}
    for (mix, source), r in got.items():
        want = r["target_share"] * total
        assert r["reachable"] == (want <= r["max_repeats"] * size.get(source, 0))
        if r["reachable"]:
            assert abs(r["mixed_tokens"] - want) < 0.02 * total
        else:
            assert r["mixed_tokens"] == r["max_repeats"] * size.get(source, 0)
    assert not got[2, "b"]["reachable"] and not got[3, "none"]["reachable"] and got[3, "a"]["mixed_tokens"] == 0
    top = {r["source"]: r["n"] for r in copies.filter("mix_id = 1").groupBy("source").agg({"copies": "max"}).withColumnRenamed("max(copies)", "n").collect()}
    assert top["a"] <= 2 and top["b"] <= 3
    empty = mixing.mix(df.limit(0), targets)[1]
    assert empty.count() == 6 and empty.filter("mixed_tokens > 0").count() == 0


SENTENCES = {
    "en": ["The old mill was moved to the other side of the river.", "Nobody knows who wrote the first letter about the town.", "There were many houses but only a few had glass windows.", "The council could not pay the taxes any longer this year."],
    "de": ["Die alte Mühle wurde auf die andere Seite des Flusses verlegt.", "Niemand weiß, wer den ersten Brief über die Stadt geschrieben hat.", "Es gab viele Häuser, aber nur wenige hatten Fenster aus Glas.", "Der Rat konnte die Steuern in diesem Jahr nicht mehr bezahlen."],
    "fr": ["Le vieux moulin fut déplacé de l'autre côté de la rivière.", "Personne ne sait qui a écrit la première lettre sur la ville.", "Il y avait beaucoup de maisons mais peu avaient des vitres.", "Le conseil ne pouvait plus payer les impôts cette année."],
}


def documents(rng):
    rows = []
    for i in range(240):
        lang = rng.choice(list(SENTENCES))
        body = " ".join(rng.sample(SENTENCES[lang], 3)) * 2
        label = lang if rng.random() < 0.85 else rng.choice([None, "", "und", "EN", "deu", "fr-BE"])
        rows.append((i, f"{{{{Infobox|name = x}}}}\n== Titel ==\n{body}\n\n* {rng.choice(SENTENCES[lang])}", label, lang))
    return rows


def test_languages(spark):
    rng = random.Random(10)
    rows = documents(rng)
    mixed = SENTENCES["en"][0] + " " + SENTENCES["en"][2] + "\n\n" + SENTENCES["de"][1] + " " + SENTENCES["de"][3]
    extra = [(900, mixed, "en", ""), (901, None, "en", ""), (902, "", None, ""), (903, "#REDIRECT [[Der alte Ort#Geschichte]]", "en", ""), (904, "zzz zzz zzz zzz zzz.", "en", ""), (905, SENTENCES["fr"][0] * 3000, "fr", "")]
    df = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string, label string")
    model = langid.train(df, "doc_id", "text", "lang")
    assert model.languages == ["de", "en", "fr"]
    parts = langid.segments(df, "doc_id", "text", "lang", model).cache()
    main = {r["doc_id"]: r["lang"] for r in langid.document_languages(parts).filter("main").collect()}
    right = sum(main[i] == lang for i, _, _, lang in rows) / len(rows)
    assert right >= 0.99
    two = sorted((r["seg_no"], r["lang"], r["n_sentences"]) for r in parts.filter("doc_id = 900").collect())
    assert two == [(0, "en", 2), (1, "de", 2)]
    found = {(r["doc_id"], r["lang"]) for r in langid.mislabelled(parts).collect()}
    code = {None: None, "": None, "und": None, "EN": "en", "deu": "de", "fr-BE": "fr"}
    assert found - {(900, "en"), (900, "de")} == {(i, lang) for i, _, label, lang in rows if code.get(label, label) != lang}
    assert {(900, "en"), (900, "de")} <= found
    assert not {r["doc_id"] for r in parts.collect()} & {901, 902, 903, 904}
    none = df.limit(0)
    assert langid.train(none, "doc_id", "text", "lang") is None
    assert langid.segments(none, "doc_id", "text", "lang", None).count() == 0


def test_every_text_has_a_language(spark, tmp_path):
    """p9_documents gives texts without a confident sentence their best language, and NULL where there are no letters."""
    from weftlink.llm import queries

    extra = [(900, "== Der alte Ort ==", None, ""), (901, "12 34", "en", ""), (902, "", "en", ""), (903, None, "en", ""), (904, "  ", "en", "")]
    df = spark.createDataFrame(documents(random.Random(10)) + extra, "doc_id long, text string, lang string, label string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.p9_documents(spark, str(tmp_path)).filter("main").collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(by_id) == 243 and not {902, 903} & set(by_id)
    assert by_id[900]["lang"] == "de" and 0 < by_id[900]["confidence"] <= 1
    assert all(by_id[i]["lang"] is None and by_id[i]["confidence"] is None for i in (901, 904))


def test_markup():
    text = "{{A|{{b}}}}''Kept'' [[Link|word]] here.<ref name=x>gone</ref> <!-- gone -->\n{| class\n| gone\n|}\nOpen table:\n{|\n| gone\nLast whole line stays here."
    assert langid.sentences(text) == ["Kept word here.", "Last whole line stays here."]


def test_sentences_inside_markup():
    """Whole sentences of quotations, table cells and captions count; fields, heads and categories do not."""
    quote = "Vor {{Quote|text=Niemand weiß, wer das [[Alte Karte|Blatt]] gezeichnet hat. Es blieb verschollen bis heute.|source=Ort}} nach."
    assert langid.sentences(quote) == ["Niemand weiß, wer das Blatt gezeichnet hat.", "Es blieb verschollen bis heute."]
    table = '{| class="wikitable"\n|+ The best known table of them all.\n! A head of words that ends here. !! B\n|-\n| 12 || style="x" | The mill was moved to the other bank.\n| Les impôts ne furent jamais payés.\n|}'
    assert [s for s in langid.sentences(table) if langid.prose(s)] == ["The mill was moved to the other bank.", "Les impôts ne furent jamais payés."]
    picture = "[[File:Old.jpg|thumb|Le vieux moulin de [[Nancy|la ville]] fut déplacé.]]Text goes on here after it.\n[[Category:Mills of the old town.]]"
    assert langid.sentences(picture) == ["Le vieux moulin de la ville fut déplacé.", "Text goes on here after it."]
    fields = "{{Infobox site\n| motto = We shall not pay the taxes.\n| map = {{map|a.png|size=3}}\n}}\n| motto = We shall not pay the taxes."
    assert langid.sentences(fields) == []


#: Pages whose languages were set by hand.
BY_HAND = [
    ("The old mill was moved to the other side of the river.\n{{Quote|text=Niemand weiß, wer den ersten Brief über die Stadt geschrieben hat.|source=X}}", "en", {"en", "de"}),
    ('{| class="wikitable"\n! Jahr !! Ort\n|-\n| 1800 || Es gab viele Häuser, aber nur wenige hatten Fenster aus Glas.\n|}\nNobody knows who wrote the first letter about the town.', "en", {"en", "de"}),
    ("[[File:A.jpg|thumb|Personne ne sait qui a écrit la première lettre sur [[X|la ville]].]]\nThe council could not pay the taxes any longer this year.", "en", {"en", "fr"}),
    ("{{Quote|text=Le conseil ne pouvait plus payer les impôts cette année.}}", "en", {"fr"}),
    ("== Die alte Stadt ==\nThere were many houses but only a few had glass windows (''die alte Stadt'').", "en", set()),
    ("{| class=x\n! Jahr der Gründung der Stadt\n|-\n| 12\n|}", None, set()),
    ("#REDIRECT [[Die alte Stadt an der Elbe]]", None, set()),
]


def test_languages_of_pages_labelled_by_hand(spark):
    rows = documents(random.Random(11)) + [(1000 + i, text, label, "") for i, (text, label, _) in enumerate(BY_HAND)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, label string")
    parts = langid.segments(df, "doc_id", "text", "lang", langid.train(df, "doc_id", "text", "lang"))
    found = {(r["doc_id"], r["lang"]) for r in langid.mislabelled(parts).filter("doc_id >= 1000").collect()}
    assert found == {(1000 + i, lang) for i, (_, _, langs) in enumerate(BY_HAND) for lang in langs}
