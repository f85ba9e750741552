"""Languages of documents and of their segments in other languages.

A sparse multinomial logistic regression on TF-IDF character n-grams within words, trained
by follow-the-regularised-leader with elastic-net penalties on a bounded sample of labelled
documents, then calibrated by a temperature on held-out documents.  Document frequencies are
counted over all documents.  Texts are stripped of markup and cut into sentences; a sentence's
logits are sums over its words, so every word is scored once a worker.

The TF-IDF vector of a sentence is scaled by the square root of its number of n-grams, which
keeps its logits additive over words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1 << 14
GRAMS = (1, 2, 3, 4)
#: Three-letter codes of the labels' languages.
THREE = {
    "deu": "de", "ger": "de", "eng": "en", "spa": "es", "fra": "fr", "fre": "fr", "ita": "it", "nld": "nl", "dut": "nl",
    "pol": "pl", "por": "pt", "rus": "ru",
}

_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.S)
_REF = re.compile(r"<ref[^>/]*/>|<ref[^>]*>.*?</ref>", re.S)
_TEMPLATE = re.compile(r"\{\{([^{}]*)\}\}|\{\{\{[^{}]*\}\}\}")
#: Templates whose arguments are fields, not prose.
_FIELDS = re.compile(r"\s*(?:infobox|navbox|taxobox|#)", re.I)
_LINK = re.compile(r"\[\[([^\[\]]*)\]\]")
#: Names of the namespaces of pictures and categories in the languages told apart here.
_PICTURES = set("file image media datei bild archivo imagen fichier immagine bestand afbeelding plik grafika ficheiro imagem файл изображение".split())
_CATEGORIES = set("category kategorie categoría catégorie categoria categorie kategoria категория".split())
_TAG = re.compile(r"<[^<>]{0,200}>")
_QUOTE = re.compile(r"'{2,}")
_SKIP = re.compile(r"^\s*(?:[=!{}#;]|\|\s*(?:[-}+]|[\w -]*=[^|]*$)|\*\s*\[)")
_END = re.compile(r"(?<=[.!?…])[\"'»”’)]*\s+(?=\S)")
_EDGE = "\"'«»“”„’‘()[]{}<>.,;:!?…-–—*=|/\\0123456789%#&+_"


def label_code(col: Column) -> Column:
    """A label in any spelling -> two-letter code; NULL for NULL, '', 'und' and unknown forms."""
    base = F.lower(F.regexp_extract(F.trim(col), r"^([A-Za-z]{2,3})(?:[-_].*)?$", 1))
    three = F.create_map(*[F.lit(x) for kv in THREE.items() for x in kv])
    return F.when(F.length(base) == 2, base).when(F.length(base) == 3, three[base])


def _argued(m: re.Match) -> str:
    """What stays of a template: arguments that are sentences, as of quotations, each on a line of its own."""
    if not m[1] or len(m[1]) < 25 or _FIELDS.match(m[1]):
        return " "
    kept = [a for a in (x.partition("=")[2].strip() or x.strip() for x in m[1].split("|")[1:]) if a.count(" ") >= 3 and a.rstrip("\"'»”’) ")[-1:] in ".!?…"]
    return "\n" + "\n".join(kept) + "\n" if kept else " "


def _linked(m: re.Match) -> str:
    """What stays of a link: its text; of a picture its caption, on a line of its own; of a category nothing."""
    target, more, shown = m[1].partition("|")
    shown = shown.rpartition("|")[2] if more else target
    if ":" in target:
        space = target.partition(":")[0].strip().lower()
        if space in _CATEGORIES:
            return " "
        if space in _PICTURES:
            return f"\n{shown}\n" if more else " "
    return shown


def strip_markup(text: str) -> str:
    """Prose of a page: no comments, references, fields, tags or link targets; table lines stay as they are.

    Sentences in arguments of templates (quotations) and captions of pictures stay, as lines of their own.
    """
    if "<" in text:
        text = _COMMENT.sub(" ", text)
        text = _REF.sub(" ", text)
    # links first: their bars are none of a template's, and a caption can hold links of its own
    for pattern, put, sign in ((_LINK, _linked, "[["), (_TEMPLATE, _argued, "{{")):
        for _ in range(12):
            if sign not in text:
                break
            text, n = pattern.subn(put, text)
            if not n:
                break
    if "''" in text:
        text = _QUOTE.sub("", text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = text.replace("&nbsp;", " ").replace("&amp;", "&")
    return text


def sentences(text: str) -> list[str]:
    """Sentences of the prose lines and table cells of a text, in order; headings and table heads have none."""
    out = []
    for line in strip_markup(text).split("\n"):
        if len(line) <= 12 or " " not in line or _SKIP.match(line):
            continue
        if line.lstrip()[0] == "|":
            # the last part of a cell is its text, any before it are its style
            for cell in line.strip()[1:].split("||"):
                cell = cell.rpartition("|")[2].strip(" *:\t")
                if len(cell) > 12:
                    out += _END.split(cell)
        else:
            out += _END.split(line.strip(" *:\t"))
    return out


def words(sentence: str) -> list[str]:
    return sentence.lower().split()


def slots(word: str) -> list[int]:
    """Hashed character n-grams of a padded word; the word itself for blanks and signs is none."""
    core = word.strip(_EDGE)
    if not core or not any(map(str.isalpha, core)):
        return []
    core = f" {core} "
    return [zlib.crc32(core[i : i + n].encode()) % BUCKETS for n in GRAMS for i in range(len(core) - n + 1)]


def gram_frequencies(docs: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """(document-word incidences of every n-gram bucket, all incidences), over all documents."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for pdf in batches:
            for text in pdf["text"]:
                seen.update(set(text.lower().split()))
            if len(seen) > 200_000:
                yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})
                seen.clear()
        if seen:
            yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(BUCKETS)
        every = 0
        for pdf in batches:
            for word, n in zip(pdf["word"], pdf["n"].tolist()):
                got = set(slots(word))
                if got:
                    total[list(got)] += n
                    every += n
        if every:
            at = np.flatnonzero(total)
            yield pd.DataFrame({"slot": np.append(at, -1), "n": np.append(total[at], every).astype(np.int64)})

    texts = docs.select(F.col(text_col).alias("text")).filter("text <> ''")
    by_word = texts.mapInPandas(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    rows = by_word.mapInPandas(spread, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).collect()  # at most BUCKETS + 1 rows
    df = np.zeros(BUCKETS)
    every = 0
    for r in rows:
        if r["slot"] < 0:
            every = r["n"]
        else:
            df[r["slot"]] = r["n"]
    return df, every


def training_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int, per_document: int, min_chars: int = 200, max_chars: int = 20_000) -> pd.DataFrame:
    """(lang, found) of at most ``per_language`` labelled documents of each language, chosen by a hash of the id.

    ``found`` has the first ``per_document`` different sentences.  Documents of ``min_chars`` to ``max_chars``
    characters are fitted on (all are classified).  Labels are two letters, so there can be no more than
    676 languages, and that many times ``per_language`` rows here.
    """
    rows = docs.select(F.col(id_col).alias("id"), label_code(F.col(lang_col)).alias("lang"), F.col(text_col).alias("text"))
    usable = rows.filter(F.col("lang").isNotNull() & F.length("text").between(min_chars, max_chars))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = usable.select("id", "lang").withColumn("r", F.row_number().over(order)).filter(F.col("r") <= per_language).select("id", "lang").distinct()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [[s for s in dict.fromkeys(sentences(t)) if prose(s)][:per_document] for t in pdf["text"]]
            yield pdf[["id", "lang"]].assign(found=found)

    # few and bounded rows, so the texts are not shuffled
    got = usable.join(F.broadcast(chosen), ["id", "lang"], "left_semi").select("id", "lang", "text")
    got = got.mapInPandas(cut, f"id {dict(rows.dtypes)['id']}, lang string, found array<string>")
    return got.toPandas().sort_values(["id", "lang"], kind="stable")


class Model:
    """Weights by n-gram bucket and language, and the calibration temperature."""

    def __init__(self, languages: list[str], idf: np.ndarray):
        self.languages, self.idf = languages, idf
        self.weights = np.zeros((BUCKETS, len(languages)), np.float32)
        self.temperature = 1.0
        self._kept: dict[str, int] = {}
        self._scores: list[np.ndarray] = []
        self._counts: list[int] = []

    def vector(self, sentence: str) -> tuple[np.ndarray, np.ndarray]:
        every = [s for w in words(sentence) for s in slots(w)]
        if not every:
            return np.zeros(0, np.int64), np.zeros(0)
        at, tf = np.unique(every, return_counts=True)
        return at, tf * self.idf[at] / np.sqrt(len(every))

    def fit(self, xs: list, ys: np.ndarray, epochs: int = 2, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.005, l2: float = 0.01) -> None:
        """FTRL-proximal, one sentence at a time; l1 and l2 are the elastic-net penalties."""
        k = len(self.languages)
        z, n = np.zeros((BUCKETS, k)), np.zeros((BUCKETS, k))
        rng = np.random.default_rng(3)
        for _ in range(epochs):
            for i in rng.permutation(len(xs)):
                at, x = xs[i]
                za, na = z[at], n[at]
                root = np.sqrt(na)
                w = np.where(np.abs(za) <= l1, 0.0, (np.sign(za) * l1 - za) / ((beta + root) / alpha + l2))
                s = x @ w
                p = np.exp(s - s.max())
                p /= p.sum()
                p[ys[i]] -= 1
                g = x[:, None] * p
                sq = g * g
                z[at] = za + g - (np.sqrt(na + sq) - root) / alpha * w
                n[at] = na + sq
        self.weights = np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2)).astype(np.float32)
        self.scaled = self.weights * self.idf[:, None].astype(np.float32)

    def calibrate(self, logits: np.ndarray, ys: np.ndarray) -> None:
        """The temperature of least log loss on held-out sentences."""
        best = (np.inf, 1.0)
        for t in np.exp(np.linspace(np.log(0.2), np.log(20), 80)):
            s = logits / t
            s = s - s.max(axis=1, keepdims=True)
            loss = float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(ys)), ys])) if len(ys) else 0.0
            best = min(best, (loss, float(t)))
        self.temperature = best[1]

    def logits(self, every: list[str]) -> np.ndarray:
        kept = self._kept
        if len(kept) > 300_000:
            kept.clear(), self._scores.clear(), self._counts.clear()
        flat: list[int] = []
        ends = []
        for s in every:
            ids = list(map(kept.get, ws := words(s)))
            if None in ids:
                ids = [self._add(w) if i is None else i for w, i in zip(ws, ids)]
            flat += ids
            ends.append(len(flat))
        if not flat:
            return np.zeros((len(every), len(self.languages)))
        table, sizes = np.array(self._scores), np.array(self._counts)
        at, ends = np.array(flat), np.array(ends)
        starts = np.append(0, ends[:-1])
        total = np.concatenate([np.zeros((1, table.shape[1])), np.cumsum(table[at].astype(np.float64), axis=0)])
        grams = np.append(0, np.cumsum(sizes[at]))
        return (total[ends] - total[starts]) / np.sqrt(np.maximum(1, grams[ends] - grams[starts]))[:, None]

    def _add(self, word: str) -> int:
        got = self._kept.get(word)
        if got is None:
            got = self._kept[word] = len(self._scores)
            at = slots(word)
            self._scores.append(self.scaled[at].sum(axis=0) if at else np.zeros(len(self.languages), np.float32))
            self._counts.append(len(at))
        return got

    def probabilities(self, every: list[str]) -> np.ndarray:
        s = self.logits(every) / self.temperature
        s = np.exp(s - s.max(axis=1, keepdims=True))
        return s / s.sum(axis=1, keepdims=True)

    def __getstate__(self):
        return {"languages": self.languages, "idf": self.idf, "weights": self.weights, "scaled": self.scaled, "temperature": self.temperature}

    def __setstate__(self, state):
        self.__dict__ |= state | {"_kept": {}, "_scores": [], "_counts": []}


def prose(sentence: str) -> bool:
    """Whether this is a whole sentence of prose: ends like one and has at least four words of letters."""
    body = sentence.rstrip("\"'»”’) ")
    if not body or body[-1] not in ".!?…":
        return False
    ws = [w for w in (x.strip(_EDGE) for x in body.split()) if w]
    letters = [w for w in ws if w.replace("'", "").replace("’", "").replace("-", "").isalpha()]
    return len(letters) >= 4 and 2 * len(letters) >= len(ws) and max(map(len, letters)) <= 40 and len({w.lower() for w in letters}) * 2 > len(letters)


def train(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int = 200, per_document: int = 8) -> Model | None:
    """Fits on at most ``per_language`` documents a language and ``per_document`` sentences of each.

    A first fit finds the sampled documents whose label disagrees with most of their own
    sentences; they are left out of the second fit.  A fifth of the documents is held out for
    the temperature.  None where no document has both a label and prose.
    """
    frequency, every = gram_frequencies(docs, text_col)
    idf = np.log((1 + every) / (1 + frequency)) + 1
    # scaled to a mean square of 1 over the corpus, so that sentences are about unit vectors
    idf /= np.sqrt(np.average(idf**2, weights=frequency + 1e-9))
    sample = training_sample(docs, id_col, text_col, lang_col, per_language, per_document)
    languages = sorted(sample["lang"].unique())
    if not languages:
        return None
    model = Model(languages, idf)
    xs, ys, of, texts = [], [], [], []
    for d, (lang, found) in enumerate(zip(sample["lang"], sample["found"])):
        for s in found:
            xs.append(model.vector(s))
            ys.append(languages.index(lang))
            of.append(d)
            texts.append(s)
    if not xs:
        return None
    ys, of = np.array(ys), np.array(of)
    first = np.arange(len(xs)) % 3 == 0
    model.fit([x for x, f in zip(xs, first) if f], ys[first], epochs=1)
    guess = model.logits(texts).argmax(axis=1)
    agree = np.bincount(of, weights=guess == ys, minlength=len(sample)) / np.maximum(1, np.bincount(of, minlength=len(sample)))
    clean = agree[of] > 0.5
    held = of % 5 == 4
    if not (clean & ~held).any():
        clean[:] = True
    fitted = np.flatnonzero(clean & ~held) if (clean & ~held).any() else np.arange(len(xs))
    model.fit([xs[i] for i in fitted], ys[fitted])
    model._kept, model._scores, model._counts = {}, [], []
    test = np.flatnonzero(clean & held)
    if len(test):
        model.calibrate(model.logits([texts[i] for i in test]), ys[test])
    return model


SEGMENTS = "doc_id {id}, label string, seg_no int, lang string, n_sentences int, n_chars bigint, confidence double"


def segments(docs: DataFrame, id_col: str, text_col: str, lang_col: str, model: Model | None, least: float = 0.5) -> DataFrame:
    """(doc_id, label, seg_no, lang, n_sentences, n_chars, confidence): runs of sentences in one language.

    Only whole sentences of prose take part, with at least ``least`` confidence of their own;
    a segment's confidence is the mean over its sentences.  NULL, empty and prose-free texts
    give no rows; rows that repeat a document are reported each.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), label_code(F.col(lang_col)).alias("label"), F.col(text_col).alias("text")).filter("text <> ''")
    schema = SEGMENTS.format(id=dict(rows.dtypes)["doc_id"])
    if model is None:
        return docs.sparkSession.createDataFrame([], schema)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for pdf in batches:
            for start in range(0, len(pdf), 500):
                part = pdf.iloc[start : start + 500]
                every, of = [], []
                for i, text in enumerate(part["text"].tolist()):
                    got = [s for s in sentences(text) if prose(s)]
                    every += got
                    of += [i] * len(got)
                if not every:
                    continue
                p = m.probabilities(every)
                best, conf = p.argmax(axis=1), p.max(axis=1)
                sure = conf >= least
                best, conf, of = best[sure], conf[sure], np.array(of)[sure]
                if not len(of):
                    continue
                size = np.array([len(s) for s in every])[sure]
                new = np.append(True, (of[1:] != of[:-1]) | (best[1:] != best[:-1]))
                at = np.flatnonzero(new)
                count = np.diff(np.append(at, len(of)))
                doc = of[at]
                starts = np.append(True, doc[1:] != doc[:-1])
                number = np.arange(len(at)) - np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"].to_numpy()[doc],
                        "label": part["label"].to_numpy()[doc],
                        "seg_no": number,
                        "lang": np.array(m.languages, object)[best[at]],
                        "n_sentences": count,
                        "n_chars": np.add.reduceat(size, at),
                        "confidence": np.add.reduceat(conf, at) / count,
                    }
                )

    return rows.mapInPandas(run, schema)


def document_languages(parts: DataFrame) -> DataFrame:
    """(doc_id, label, lang, n_sentences, confidence, main): one row a document and language in it.

    ``main`` marks the language of most characters (ties: first by code).
    """
    per = parts.groupBy("doc_id", "label", "lang").agg(
        F.sum("n_sentences").alias("n_sentences"),
        F.sum("n_chars").alias("n_chars"),
        (F.sum(F.col("confidence") * F.col("n_sentences")) / F.sum("n_sentences")).alias("confidence"),
    )
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.col("n_chars").desc(), "lang")) == 1
    return per.withColumn("main", first).drop("n_chars")


def unsure_languages(docs: DataFrame, id_col: str, text_col: str, lang_col: str, model: Model | None, parts: DataFrame) -> DataFrame:
    """Rows as of ``document_languages`` for the non-empty texts without any segment: the best language of the whole text.

    The confidence is that of the text without its markup, or as it is where nothing else is left; there are no
    sentences to count.  Without letters, or without a model, language and confidence are NULL.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), label_code(F.col(lang_col)).alias("label"), F.col(text_col).alias("text")).filter("text <> ''")
    there = parts.select(F.col("doc_id").alias("there")).distinct()
    left = rows.join(there, F.col("doc_id").eqNullSafe(F.col("there")), "left_anti")
    # of rows that repeat a document, one counts
    left = left.groupBy("doc_id").agg(F.min(F.struct("label", "text")).alias("r")).select("doc_id", "r.*")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for pdf in batches:
            texts = [s if any(map(str.isalpha, s := strip_markup(t))) else t for t in pdf["text"]]
            lang, conf = [None] * len(texts), [None] * len(texts)
            at = [i for i, t in enumerate(texts) if any(map(str.isalpha, t))] if m is not None else []
            for i, p in zip(at, m.probabilities([texts[i] for i in at]) if at else ()):
                lang[i], conf[i] = m.languages[p.argmax()], float(p.max())
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "label": pdf["label"], "lang": pd.Series(lang, pdf.index, object), "confidence": pd.Series(conf, pdf.index, float)})

    out = left.mapInPandas(run, f"doc_id {dict(rows.dtypes)['doc_id']}, label string, lang string, confidence double")
    return out.select("doc_id", "label", "lang", F.lit(0).cast("bigint").alias("n_sentences"), F.when(F.col("lang").isNotNull(), F.col("confidence")).alias("confidence"), F.lit(True).alias("main"))


def mislabelled(parts: DataFrame, least: float = 0.6) -> DataFrame:
    """(doc_id, lang): documents without a label, with another language's label, or in several languages.

    A language counts if its mean confidence in the document is at least ``least``.
    """
    langs = parts.groupBy("doc_id", "lang").agg(
        F.first("label").alias("label"), (F.sum(F.col("confidence") * F.col("n_sentences")) / F.sum("n_sentences")).alias("c")
    ).filter(F.col("c") >= least)
    per = langs.groupBy("doc_id").agg(F.collect_set("lang").alias("langs"), F.first("label", ignorenulls=True).alias("label"))
    right = (F.size("langs") == 1) & F.coalesce(F.col("label") == F.col("langs")[0], F.lit(False))
    return per.filter(~right).select("doc_id", F.explode("langs").alias("lang"))
