"""The language model against a plain one, what it learns from, and what it rejects."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from webcorpus.llm.hashing import mix
from webcorpus.llm.language_id import FEATURES, fit, identify_language

SF = "/root/testdata/sf0.01/documents.parquet"
OTHERS = (
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem. ",
    "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью. ",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki. ",
)


@pytest.fixture(scope="module")
def learned(spark):
    docs = spark.read.parquet(SF)
    return docs, fit(docs)


def plain_features(text):
    """Square roots of the shares of hashed trigrams, one trigram at a time."""
    clean = bytearray()
    data = text.encode()
    for i, b in enumerate(data):
        c = ord(chr(b).lower()) if b < 128 and chr(b).isalpha() else b if b >= 128 else 32
        if i and data[i - 1] == 0xC3 and 0x80 <= b <= 0x9E and b != 0x97:
            c = b + 0x20
        clean.append(c)
    counts = {}
    for a, b, c in zip(clean, clean[1:], clean[2:]):
        if b != 32 and (a != 32 or c != 32):
            cell = int(mix(np.array([a | b << 8 | c << 16], dtype=np.uint64))[0] % np.uint64(FEATURES))
            counts[cell] = counts.get(cell, 0) + 1
    total = sum(counts.values())
    return {k: math.sqrt(v / total) for k, v in counts.items()}


def plain_prediction(model, text):
    x = plain_features(text)
    value = lambda w: sum(float(w[k]) * v for k, v in x.items()) + float(w[-1])
    family = max(range(len(model.families)), key=lambda f: value(model.by_family[f]))
    margin = value(model.by_family[family])
    members = [k for k in range(len(model.languages)) if model.family[k] == family]
    wins = {k: [] for k in members}
    for (a, b), w in zip(model.pairs, model.by_pair):
        if a in wins:
            v = value(w)
            wins[a].append(v)
            wins[b].append(-v)
    best = max(members, key=lambda k: sum((v >= 0) + 1e-3 * math.tanh(v) for v in wins[k]))
    return model.languages[best], 1 / (1 + math.exp(-2 * min([margin, *wins[best]])))


def test_prediction_by_hand(learned):
    docs, model = learned
    for r in identify_language(docs.where("text is not null").limit(40), model).collect():
        if any(c.isalpha() for c in r["text"]):
            lang, score = plain_prediction(model, r["text"])
            assert r["lang_pred"] == lang and abs(r["score"] - score) < 1e-3


def test_unlearned_languages_and_letter_junk_are_rejected(spark, learned):
    _, model = learned
    rng = random.Random(1)
    junk = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8)) for _ in range(80))
    rows = [(i, t) for i, t in enumerate([*(t * 3 for t in OTHERS), junk, "", None, "12 34"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
    assert all(r["rejected"] for r in identify_language(docs, model).collect())


def test_copies_crowd_out_nothing(spark):
    """Of a text that stands thousands of times one copy is learned, however the rows are split."""
    docs = spark.read.parquet(SF)
    hot = docs.where("lang = 'en' and length(text) > 500").limit(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(9000))))
    hot = hot.withColumn("doc_id", F.col("n") + 10**6).drop("n")
    one, two = fit(docs.union(hot).repartition(3)), fit(docs.union(hot).repartition(7))
    assert one.languages == two.languages == ["de", "en", "es", "fr"]
    assert all(np.allclose(a, b) for a, b in zip(one.by_family + one.by_pair, two.by_family + two.by_pair))
