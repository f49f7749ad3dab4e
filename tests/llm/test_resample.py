"""Importance resampling against a brute-force version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyglass.llm import resample
from tallyglass.llm.resample import Draw

SCHEMA = "doc_id long, text string, row int, score string, rank int, buckets string, `a.b` int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 2, "y", 3) for i, t in rows], SCHEMA)


def features(text, draw):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", text) if w]
    runs = [" ".join(words[i : i + n]) for n in range(draw.least, draw.most + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % draw.buckets for r in runs]


def brute(rows, target, draw):
    """doc_id, n_words, n_features, weight, score of every row, and the drawn (id, score) in their order."""
    found = [(i, *features(t, draw)) for i, t in rows]
    s, t = Counter(b for *_, f in found for b in f), Counter(b for x in target for b in features(x, draw)[1])
    whole, aimed = sum(s.values()) + draw.buckets, sum(t.values()) + draw.buckets
    out = []
    for i, n, f in found:
        gains = [math.floor(1000 * math.log((t[b] + 1) * whole / ((s[b] + 1) * aimed))) for b in f]
        weight = math.floor(sum(gains) / len(gains)) if gains else 0
        h = int(hashlib.sha256(f"{draw.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted(((-x[4], x[0] is None, x[0] or 0) for x in out if x[1] >= draw.min_words))
    return out, able[: len(able) * draw.percent // 100]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    vocabulary = [*(f"w{i}" for i in range(60)), "Éa", "éA", "日本", "İx", "ABC", "10"]
    rows = [(None, None), (None, "one two"), (1, ""), (2, " \t-!"), (3, "a"), (4, "x " * 25), (5, "-A--b_C\n" * 9)]
    rows += [(i, rng.choice([" ", ", ", "--\n"]).join(rng.choice(vocabulary) for _ in range(rng.randint(1, 60)))) for i in range(10, 250)]
    rows += [(11, "other words under a used id " * 5), *[(300, "the same row again and again " * 5)] * 40, *[(None, "no id at all here " * 6)] * 30]
    return rows + [(400, " ".join(rng.choice(vocabulary) for _ in range(50_000)))]


TARGET = [None, "", "w1 w2 w3 w4 W5", "日本 éa " * 30, "w1 w2"]


@pytest.mark.parametrize("draw", [Draw(), Draw(1, 2, buckets=100, percent=37, min_words=5, seed=1), Draw(2, 3, buckets=70_000, percent=100, min_words=0)])
@pytest.mark.parametrize("rows_per_range", [500_000, 20])
def test_matches_brute_force(spark, texts, draw, rows_per_range):
    target = spark.createDataFrame([(i, t, "id") for i, t in enumerate(TARGET)], "item_id long, text string, doc_id string")
    found = resample.resample(frame(spark, texts), target, draw, rows_per_range=rows_per_range).collect()
    want, drawn = brute(texts, TARGET, draw)
    assert sorted((tuple(r[:5]) for r in found), key=repr) == sorted(want, key=repr)
    ranked = sorted((r for r in found if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(-r["score"], r["doc_id"] is None, r["doc_id"] or 0) for r in ranked] == drawn


def test_ngrams_overlap(spark):
    assert list(resample.ngrams(b"a b a b", 1, 1)) == [b"a", b"b", b"a", b"b"]
    assert list(resample.ngrams(b"aa b c", 2, 3)) == [b"aa b", b"b c", b"aa b c"]
    assert list(resample.ngrams(b"", 1, 4)) == list(resample.ngrams(b"a b", 3, 3)) == []


def test_carried_columns_stay_on_their_rows(spark, texts):
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    unique = [(i, t) for i, t in texts if i is not None and 10 <= i < 250]
    docs = frame(spark, unique).withColumn("rank", F.xxhash64("doc_id", "text"))
    found = resample.resample(docs, target, carry=("text", "rank", "a.b"))
    assert found.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank", "text", "rank", "a.b"]
    rows = found.toDF("doc_id", "n_words", "n_features", "weight", "score", "place", "text", "hash", "ab")
    assert rows.where("hash = xxhash64(doc_id, text) AND ab = 3").count() == len(unique)
    plain = resample.resample(docs, target)
    assert rows.select("doc_id", "n_words", "weight", "place").exceptAll(plain.select("doc_id", "n_words", "weight", "rank")).count() == 0


def test_a_rare_word_of_the_target_is_drawn(spark):
    rows = [(i, "common words " * 20 + ("wanted " * 20 if i % 10 == 0 else "other " * 20)) for i in range(400)]
    found = resample.resample(frame(spark, rows), spark.createDataFrame([("wanted " * 500,)], "text string"))
    drawn = [r["doc_id"] for r in found.collect() if r["rank"] is not None]
    # By chance four of them would be among the drawn.
    assert len(drawn) == 40 and sum(i % 10 == 0 for i in drawn) >= 4 * 4


def test_empty_tables(spark, texts):
    none = spark.createDataFrame([], "text string")
    assert resample.resample(frame(spark, []), none).collect() == []
    assert {r["weight"] for r in resample.resample(frame(spark, [(1, None), (2, "")]), none).collect()} == {0}
