"""The quality discriminant against closed forms, brute-force statistics and held-out labels."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyglass.llm import quality
from tallyglass.llm.queries import QUERIES

DOCS = "doc_id long, text string, fold string, x int, quality string, score int"
LABELS = "doc_id long, quality int, text string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "f", 1, "q", 2) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def corpus():
    """Plain sentences, and texts with symbols after their words, in capitals, or that stutter."""
    rng = random.Random(3)
    vocabulary = ["the", "Of", "stone", "river", "and", "élan", "bright", "with", "über", "2024"]
    docs, labels = [], []
    for i in range(600):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(5, 120))]
        bad = i % 4 == 0
        if bad:
            words = [w + "###" for w in words] if i % 3 == 0 else [w.upper() + "!!" for w in words] if i % 3 == 1 else [w for w in words for _ in range(4)]
        docs.append((i, " ".join(words) + ".\n"))
        labels.append((i, int(not bad), "x"))
    return docs, labels


def brute_statistics(text):
    words, chars = text.split(), Counter(text)
    solid = sum(not c.isspace() for c in text)
    letters = sum(c.isalpha() for c in text)
    upper = sum(c.isalpha() and c.isupper() for c in text)
    odds = lambda k, n: math.log((k + 0.5) / (n - k + 0.5))
    return {
        "words": math.log1p(len(words)),
        "word_length": math.log((solid + 1) / (len(words) + 1)),
        "letters": odds(letters, solid),
        "upper": odds(upper, letters),
        "spaces": odds(len(text) - solid, len(text)),
        "upper_words": odds(sum(w.isupper() and len(w) > 1 for w in words), len(words)),
        "capitalised": odds(sum(w[0].isupper() for w in words), len(words)),
        "bare_words": odds(sum(not any(c.isalnum() for c in w) for w in words), len(words)),
        "stuttered": odds(sum(a == b for a, b in zip(words, words[1:])), len(words)),
        "distinct": odds(len({w.casefold() for w in words}), len(words)),
        "lines": math.log((chars["\n"] + 1) / (len(words) + 1)),
        "entropy": -sum(n / len(text) * math.log(n / len(text)) for n in chars.values()),
    }


def test_statistics_match_brute_force(corpus, monkeypatch):
    texts = [t for _, t in corpus[0][:60]] + ["", " ", "a", "A a a\n\na A", "| | x", "no-break space　wide", "é" * 5000, "a b " * 9000]
    whole = [quality.statistics(t) for t in texts]
    for text, found in zip(texts, whole):
        for name, value in brute_statistics(text).items():
            assert dict(zip(quality.STATISTICS, found))[name] == pytest.approx(value), (name, text[:50])
        assert np.isfinite(found).all()
    # A text handled in small pieces has the same statistics, all but the compressed size to the last digit.
    monkeypatch.setattr(quality, "SEGMENT", 7)
    for text, found in zip(texts, whole):
        assert quality.statistics(text) == pytest.approx(found, abs=0.02)


def test_discriminant_is_the_density_ratio():
    rng = np.random.default_rng(1)
    x = [rng.normal(size=(400, 3)) @ rng.normal(size=(3, 3)) + m for m in (0.0, 2.0)]
    moments = np.array([(h := np.hstack([v, np.ones((len(v), 1))])).T @ h for v in x])
    model = quality.fit(moments, 0.3, 0.1)
    cov = [np.cov(v.T, bias=True) for v in x]
    pooled = (cov[0] + cov[1]) / 2
    at = rng.normal(size=(5, 3))
    want = 0.0
    for sign, v, c in ((-1, x[0], cov[0]), (1, x[1], cov[1])):
        s = 0.9 * (0.7 * c + 0.3 * pooled) + 0.1 * np.diag(np.diag(pooled))
        d = at - v.mean(axis=0)
        want = want + sign * -0.5 * ((d @ np.linalg.inv(s) * d).sum(axis=1) + np.log(np.linalg.det(s)))
    assert model.odds(at) == pytest.approx(want)


def test_model_equals_one_fitted_without_spark(spark, corpus):
    docs, labels = corpus
    measured = quality.measure(frame(spark, docs))
    model = quality.train(measured, spark.createDataFrame(labels, LABELS))
    seen = [(np.array(quality.statistics(t)), y) for (i, t), (_, y, _) in zip(docs, labels) if zlib.crc32(str(i).encode()) % 4 != 2]
    for c in (0, 1):
        assert model.means[c] == pytest.approx(np.mean([x for x, y in seen if y == c], axis=0))
    scores = {r["doc_id"]: r["score"] for r in quality.score(measured, model).collect()}
    assert all(scores[i] == pytest.approx(float(model.score(np.array([quality.statistics(t)]))[0])) for i, t in docs)
    kept = [(scores[i], y) for i, y, _ in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(kept) > 100 and np.mean([(s >= 0.7) == y for s, y in kept]) > 0.97


def test_held_out_labels_and_ids_do_not_matter(spark, corpus):
    docs, labels = corpus
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y, t) for i, y, t in labels]
    same = [quality.train(quality.measure(frame(spark, docs)), spark.createDataFrame(x, LABELS)) for x in (labels, turned)]
    assert np.allclose(same[0].means, same[1].means) and same[0].scale == same[1].scale


def test_odd_rows(spark, corpus):
    docs, labels = corpus
    odd = [(None, None), (None, docs[5][1]), (7000, ""), (7001, None), (7002, "a b " * 400_000), *[(5, docs[5][1])] * 300]
    extra = [(None, 0, "x"), (8, None, "x"), (5, 1, "y"), (9, 5, "z"), (9_999_999, 1, "no such row")]
    found = quality.classify(frame(spark, docs + odd), spark.createDataFrame(labels + extra, LABELS)).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(i for i, _ in docs + odd)
    assert all(0 <= r["score"] <= 1 for r in found)
    assert len({r["score"] for r in found if r["doc_id"] == 5}) == 1


def test_few_or_no_labels(spark, corpus):
    docs, labels = corpus
    none = spark.createDataFrame([], LABELS)
    assert quality.classify(frame(spark, []), none).collect() == []
    assert {r["score"] for r in quality.classify(frame(spark, docs[:20]), none).collect()} == {0.5}
    good = spark.createDataFrame([x for x in labels if x[1] == 1], LABELS)
    assert all(r["score"] > 0.9 for r in quality.classify(frame(spark, docs[:50]), good).collect())


def test_registered_query_finds_held_out_labels(spark, sf_dir):
    rows = QUERIES["op11_quality_classifier"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert rows.count() == docs.count()
    known = rows.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where("held_out AND quality IS NOT NULL")
    right = known.agg(F.count("*").alias("n"), F.avg((F.col("predicted") == F.col("quality")).cast("int")).alias("share")).first()
    assert right["n"] >= 5 and right["share"] >= 0.9
