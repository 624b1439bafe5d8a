"""Language mixtures: a plain estimate, mixed texts of known parts, held-out accuracy, odd inputs."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from streakline.llm import language_mixture as lm

SYLLABLES = {"aa": ["ka", "to", "mi", "ru", "sel"], "bb": ["schn", "ürg", "ött", "pfl", "eng"], "cc": ["żył", "cze", "ośw", "ńska", "brz"]}
DOCS = "doc_id bigint, text string, lang string"


def _prose(lang, n, seed):
    rnd = random.Random(f"{lang}{seed}")
    return " ".join("".join(rnd.choices(SYLLABLES[lang], k=rnd.randint(1, 3))) for _ in range(n))


def _labelled(count=20):
    langs = list(SYLLABLES)
    return [(i, _prose(langs[i % 3], 60, i), langs[i % 3]) for i in range(3 * count)]


@pytest.fixture(scope="module")
def model(spark):
    return lm.learn(spark.createDataFrame(_labelled(), DOCS).repartition(3))


def _plain_grams(text, order=3):
    """Letters of the lower-cased text between single borders, every stretch whose second place is a letter."""
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    line = " " + " ".join(letters.split()) + " "
    return [line[i : i + order] for i in range(len(line) - order + 1) if line[i + (order > 1)] != " "]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_grams(order):
    texts = ["", "Ab, cd!", "x", " -- ", "Straße 12 ÀÉ\n\nz", "𝒳y\U00010400", "a" * 50]
    gram, of = lm.grams_of(texts, order)
    found = Counter(zip(of.tolist(), gram.tolist(), strict=True))
    want = Counter()
    for i, text in enumerate(texts):
        for g in _plain_grams(text, order):
            key = 0
            for c in g:
                key = key << 21 | (0 if c == " " else ord(c))
            want[i, key] += 1
    assert found == want


def test_counts_of_all_rows(spark, model):
    counts = Counter()
    for _, text, lang in _labelled():
        counts.update((lang, g) for g in _plain_grams(text))
    grams = sorted({g for _, g in counts})
    assert model.langs == ("aa", "bb", "cc") and len(model.grams) == len(grams)
    keys = {sum((0 if c == " " else ord(c)) << 21 * (2 - i) for i, c in enumerate(g)): g for g in grams}
    smooth = lm.MixtureParams().smoothing
    for j, lang in enumerate(model.langs):
        total = sum(n for (x, _), n in counts.items() if x == lang) + smooth * (len(grams) + 1)
        for i, key in enumerate(model.grams.tolist()):
            assert math.isclose(math.exp(model.logp[i, j]), (counts[lang, keys[key]] + smooth) / total)


def _plain_mixture(text, model, params):
    """The same estimate for one text, language sets tried one by one."""
    at = {g: i for i, g in enumerate(model.grams.tolist())}
    gram, _ = lm.grams_of([text], model.order)
    seen = Counter(at[g] for g in gram.tolist() if g in at)
    k = len(model.langs)
    if not seen:
        return [0.0] * k
    size = sum(seen.values()) / model.order

    def estimate(pi):
        for _ in range(params.steps):
            new = [0.0] * k
            for row, n in seen.items():
                joint = [pi[j] * math.exp(model.logp[row, j]) for j in range(k)]
                for j in range(k):
                    new[j] += n / model.order * joint[j] / sum(joint) / size
            moved, pi = max(abs(a - b) for a, b in zip(new, pi, strict=True)), new
            if moved < params.tolerance:
                break
        return pi

    def like(pi):
        return sum(n / model.order * math.log(sum(pi[j] * math.exp(model.logp[row, j]) for j in range(k))) for row, n in seen.items())

    whole = estimate([1 / k] * k)
    order = sorted(range(k), key=lambda j: -whole[j])
    singles = [[float(i == j) for i in range(k)] for j in range(k)]
    sets = [max(singles, key=like)]
    for m in range(2, k + 1):
        start = [max(whole[j], 1e-6) if j in order[:m] else 0.0 for j in range(k)]
        sets.append(estimate([x / sum(start) for x in start]))
    best, value = None, -math.inf
    for m, pi in enumerate(sets):
        now = like(pi) - params.penalty * 0.5 * math.log1p(size) * m
        if now <= value:
            break
        best, value = pi, now
    return best


def test_as_plain_estimate(model):
    params = lm.MixtureParams(steps=200, tolerance=1e-9)
    texts = [_prose("aa", 30, "t"), _prose("bb", 30, "t") + " " + _prose("cc", 15, "t"), "ka schn", "Qqq www", "", " ".join(_prose(x, 20, "u") for x in SYLLABLES)]
    for text in texts:  # alone, so that the steps end at the same time
        found = lm.mixtures([text], model, params)
        assert np.allclose(found[0], _plain_mixture(text, model, params), atol=1e-6), text
    together = lm.mixtures(texts, model, params)
    assert np.allclose(together, [_plain_mixture(t, model, params) for t in texts], atol=1e-6)


def test_parts_of_a_mixture(spark, model):
    rows = [(1, _prose("aa", 200, "p"), None), (2, _prose("aa", 140, "p") + ". " + _prose("bb", 60, "p"), None), (3, " ".join(_prose(x, 90, "q") for x in SYLLABLES), None)]
    found = {r["doc_id"]: {e["lang"]: e["proportion"] for e in r["languages"]} for r in lm.predict(spark.createDataFrame(rows, DOCS), model).collect()}
    assert set(found[1]) == {"aa"} and set(found[2]) == {"aa", "bb"} and set(found[3]) == {"aa", "bb", "cc"}
    letters = [sum(map(str.isalpha, _prose(x, n, "p"))) for x, n in (("aa", 140), ("bb", 60))]
    assert abs(found[2]["aa"] - letters[0] / sum(letters)) < 0.1


def test_held_out_accuracy(spark, sf_dir):
    """Languages of documents that were not learnt from."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = lm.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    row = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("right"), F.min("score").alias("least"), F.max("score").alias("most")).first()
    assert row["right"] > 0.98 and 0 <= row["least"] and row["most"] <= 1


def test_only_text_and_training_labels_count(spark):
    """Neither labels of held-out rows nor sources change anything; equal texts get equal results."""
    rows = _labelled()
    plain = spark.createDataFrame(rows, DOCS)
    out = lm.held_out(F.col("doc_id"))
    other = plain.withColumn("lang", F.when(out, F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.col("doc_id"))
    pick = lambda df: sorted(tuple(r) for r in lm.languages(df).select("doc_id", "held_out", "lang_pred", "score").collect())
    assert pick(plain) == pick(other)
    copies = plain.unionByName(plain)
    found = lm.languages(copies).groupBy("doc_id").agg(F.countDistinct("lang_pred", "score").alias("n")).where("n > 1")
    assert found.count() == 0


def test_odd_texts(spark, model):
    rows = [(1, None, None), (2, "", None), (3, "12 -- 34 ... \n", None), (4, "日本", None), (None, _prose("cc", 9, 1), None), (6, "ka to mi ru " * 50_000, None)]
    found = {r["doc_id"]: r for r in lm.predict(spark.createDataFrame(rows, DOCS), model).collect()}
    for i in (1, 2, 3):
        assert (found[i]["lang_pred"], found[i]["score"], found[i]["languages"]) == ("und", 0.0, [])
    assert found[4]["lang_pred"] in model.langs and math.isclose(found[4]["score"], 1 / 3)
    assert found[None]["lang_pred"] == "cc" and found[6]["lang_pred"] == "aa"


def test_empty_tables_and_clashing_columns(spark, model):
    empty = spark.createDataFrame([], DOCS)
    assert lm.languages(empty).count() == 0
    unlabelled = spark.createDataFrame([(1, "ka to", None), (2, None, "aa")], DOCS)
    assert {r["lang_pred"] for r in lm.languages(unlabelled).collect()} == {"und"}
    df = spark.createDataFrame([(1, "ka to mi", "aa", 5, "x")], DOCS + ", score int, languages string")
    assert lm.predict(df, model).columns == ["doc_id", "text", "lang", "lang_pred", "score", "languages"]


def test_ties_of_grams_are_settled_by_gram(spark):
    rows = spark.createDataFrame(_labelled(3), DOCS)
    a = lm.learn(rows.repartition(4), params=lm.MixtureParams(grams=40))
    b = lm.learn(rows.coalesce(1), params=lm.MixtureParams(grams=40))
    assert len(a.grams) == 40 and (a.grams == b.grams).all() and np.allclose(a.logp, b.logp)
