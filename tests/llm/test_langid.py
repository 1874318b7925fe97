import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratum.llm import langid, queries
from tests.llm.helpers import DOCS, documents


class Plain:
    """Interpolated Kneser-Ney over words, spelled out with dictionaries."""

    def __init__(self, words, order, alphabet, discount=langid.DISCOUNT):
        self.order, self.alphabet, self.d = order, alphabet, discount
        raw = {}
        for word, n in words.items():
            text = "<" + word + ">"
            for end in range(1, len(text)):
                for size in range(1, min(order, end + 1) + 1):
                    gram = text[end - size + 1 : end + 1]
                    raw[gram] = raw.get(gram, 0) + n
        self.count = {}
        for gram, n in raw.items():
            if len(gram) < order and gram[0] != "<":
                n = len([g for g in raw if len(g) == len(gram) + 1 and g[1:] == gram])
            self.count[gram] = n

    def p(self, gram):
        if not gram:
            return 1 / self.alphabet
        inside = [n for g, n in self.count.items() if len(g) == len(gram) and g[:-1] == gram[:-1]]
        if not inside:
            return self.p(gram[1:])
        total = sum(inside)
        return max(self.count.get(gram, 0) - self.d, 0) / total + self.d * len(inside) / total * self.p(gram[1:])

    def log_p(self, word):
        text = "<" + word + ">"
        return sum(np.log2(self.p(text[max(0, e - self.order + 1) : e + 1])) for e in range(1, len(text)))


def test_probabilities_are_those_of_the_formula():
    data = [{"banana": 3, "ban": 1, "nab": 2, "a": 5}, {"cab": 2, "abba": 1, "bad": 4}]
    alphabet = len(set("".join(w for d in data for w in d))) + 2
    learned = [langid._learn(pa.array(list(d)), np.array(list(d.values())), 3, alphabet) for d in data]
    levels = [langid.Level(*langid._level([p[n][0] for p in learned]), *langid._level([p[n][1] for p in learned])) for n in range(3)]
    model = langid.Model(["x", "y"], levels, float(-np.log2(alphabet)))
    texts = ["banana", "a", "dab", "zebra", "bananab"]
    words = langid.LetterWords(pa.array(texts))
    got = model.word_scores(words.characters(np.arange(len(words.starts))))
    for column, d in enumerate(data):
        plain = Plain(d, 3, alphabet)
        assert got[:, column] == pytest.approx([plain.log_p(w) for w in texts], abs=1e-4)
    cache = {}
    bits, length = model.entropies(pa.array(["Banana, a! 7", "", None, "..."]), cache)
    assert length.tolist() == [9, 0, 0, 0] and np.isnan(bits[1:]).all()
    again, _ = model.entropies(pa.array(["x", "banana a"]), cache)
    assert again[1] == pytest.approx(bits[0])


def test_words_are_runs_of_letters():
    words = langid.LetterWords(pa.array(["Ab1cÉ-ß", None, "𐐀b 世x", "İ"]))
    spelled = ["".join(map(chr, words.codes[a:b])) for a, b in zip(words.starts, words.ends)]
    assert spelled == ["ab", "cé", "ß", "𐐨b", "世x", "İ"] and words.first.tolist() == [0, 3, 3, 5, 6]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    found = queries.op8_language_id(spark, sf).drop("rejected").join(
        spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held_out = [r for r in found if r.held_out]
    assert len(found) == 1000 and len(held_out) > 200
    assert sum(r.lang == r.lang_pred for r in held_out) >= 0.97 * len(held_out)
    assert all(0 <= r.score <= 1 for r in found)


def training(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_odd_texts(spark):
    model = langid.train(training(spark))
    rows = [(1, None), (2, ""), (3, "12 -- ?!"), (4, "the and of that"), (4, "the and of that"), (None, "der die und"),
            (5, "the " * 60_000), (6, "ΩΨ ДЖ 世界 " * 30), (7, "x")]
    docs = documents(spark, rows, score=F.lit("s"), lang_pred=F.lit(1), found=F.lit(2))
    found = langid.predictions(docs, model)
    got = sorted(((r.row.doc_id, r.lang_pred, r.rejected) for r in found.collect()), key=str)
    assert [g for g in got if g[0] in (1, 2, 3)] == [(1, "und", True), (2, "und", True), (3, "und", True)]
    assert got.count((4, "en", False)) == 2 and (None, "de", False) in got and (5, "en", False) in got
    assert (6, True) in {(g[0], g[2]) for g in got}
    kept = langid.accepted(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {4, 5, None}


def test_clean_documents_are_kept(spark):
    docs = training(spark)
    assert langid.accepted(docs, langid.train(docs)).count() >= 0.995 * docs.count()


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], DOCS)
    assert langid.train(empty) is None
    rows = documents(spark, [(1, "abc"), (2, None)]).withColumn("lang", F.lit(None).cast("string"))
    model = langid.train(rows)
    assert model is None
    assert [(r.lang_pred, r.score, r.rejected) for r in langid.predictions(rows, model).collect()] == [("und", 0.0, True)] * 2
    assert langid.predictions(empty, langid.train(training(spark))).collect() == []


def test_a_rare_language_among_many_documents(spark):
    text = F.concat(F.lit("the and of that "), F.col("id").cast("string"))
    many = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), text.alias("text"))
    rare = spark.createDataFrame([(-i, f"x{i}", "ja ei ole kuin " * 3 + "y" * i) for i in range(1, 9)] + [(-20, None, "z")], "doc_id long, lang string, text string")
    model = langid.train(many.unionByName(rare), per_language=100)
    assert model.languages == ["en", *(f"x{i}" for i in range(1, 9))]  # also those whose one document is set apart
    found = langid.predictions(rare.where("lang is not null"), model).collect()
    assert all(r.lang_pred.startswith("x") and not r.rejected for r in found)


def test_too_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 2)
    rows = spark.createDataFrame([(i, f"l{i}", "a b c") for i in range(3)], "doc_id long, lang string, text string")
    with pytest.raises(ValueError):
        langid.train(rows)
    assert langid.train(rows.limit(2)).languages
