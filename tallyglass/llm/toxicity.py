"""Toxicity by multiple-instance learning: sentences are scored, documents carry the labels.

A sentence is toxic with probability sigmoid(bias + sum of the weights of its words and word beginnings); a document is toxic if any sentence is (noisy-or).
Weights are learned from document labels alone, by gradient descent through the noisy-or with an L1 penalty, on a bounded
sample of labelled documents; the same sentence scores then say where a document offends.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyglass.llm.rows import chunks, identified, stored

#: Labelled documents the model is fitted on, if there are so many (give or take the chance of a hash).
SAMPLE = 8000
#: Documents of the sample a word must occur in.
MIN_DOCS = 3
THRESHOLD = 0.7
_TOKENS = re.compile(r"[^\W\d_]+|[.!?\n]")
_STOPS = frozenset(".!?\n")
#: Lengths of word beginnings that are features beside the whole word.
PREFIXES = (3, 4, 5, 6)
_known: dict[str, list[int]] = {}


def held_out(doc_id: Column) -> Column:
    """Rows no model learns from: crc32 of the id as text, modulo 3, is 1. A null id is not held out, but has no label."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _marks(word: str) -> list[int]:
    """Hashes of a word and of its beginnings, which inflected forms of a word share."""
    return [xxhash.xxh3_64_intdigest(word), *(xxhash.xxh3_64_intdigest("^" + word[:n]) for n in PREFIXES if len(word) >= n)]


def _sentences(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features and their sentence's number, for every word."""
    hashes, sentence, number = [], [], 0
    for token in _TOKENS.findall(text.lower()):
        if token in _STOPS:
            number += 1
            continue
        marks = _known.get(token)
        if marks is None:
            if len(_known) > 100_000:
                _known.clear()
            marks = _known[token] = _marks(token)
        hashes += marks
        sentence += [number] * len(marks)
    return np.array(hashes, dtype=np.uint64), np.array(sentence, dtype=np.int64)


@dataclass(frozen=True)
class Model:
    words: np.ndarray  # hashes, ascending
    weights: np.ndarray
    bias: float

    def of(self, text: str | None) -> tuple[float, np.ndarray]:
        """The document's probability and those of its sentences that have words of weight."""
        if not text or not len(self.words):
            return 0.0, np.zeros(0)
        hashes, sentence = _sentences(text)
        if not len(hashes):
            return 0.0, np.zeros(0)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        weight = np.where(self.words[at] == hashes, self.weights[at], 0.0)
        # A sentence without any known mark is no evidence, so long harmless texts do not add up.
        some = np.bincount(sentence, weight != 0) > 0
        p = np.where(some, _sigmoid(self.bias + np.bincount(sentence, weight)), 0.0)
        return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-9)).sum())), p

    def offending(self, text: str, p: np.ndarray, least: float = 0.5) -> list[dict]:
        """Start, end (code points) and probability of sentences of at least ``least``."""
        out, start, number = [], 0, 0
        for stop in [*re.finditer(r"[.!?\n]", text), None]:
            end = stop.start() if stop else len(text)
            if number < len(p) and p[number] >= least:
                out.append({"start": start, "end": end, "score": float(p[number])})
            start, number = end + 1, number + 1
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(
    documents: list[tuple[np.ndarray, np.ndarray, int]],
    rounds: int = 400,
    rate: float = 0.3,
    l1: float = 2e-4,
    shown: float = 0.25,
) -> Model:
    """Weights from (feature hashes, sentence numbers, label) of each document.

    Each round shows a random part of the sentences (``shown``), so that one offence cannot explain the others in its
    document away: every offending word has to account for labels by itself in some rounds.
    """
    n = len(documents)
    hashes = np.concatenate([np.zeros(0, np.uint64), *(h for h, _, _ in documents)])
    if not len(hashes):
        return Model(np.zeros(0, np.uint64), np.zeros(0), -30.0)
    label = np.array([y for _, _, y in documents], dtype=float)
    doc = np.repeat(np.arange(n), [len(h) for h, _, _ in documents])
    # Sentences with features are numbered through all documents; features stand in the order of their sentences.
    _, sentence = np.unique(doc * (1 << 32) + np.concatenate([s for _, s, _ in documents]), return_inverse=True)
    words, at = np.unique(hashes, return_inverse=True)
    n_sentences = int(sentence[-1]) + 1
    doc_of = np.zeros(n_sentences, dtype=np.int64)
    doc_of[sentence] = doc
    first = np.concatenate([[0], np.cumsum(np.bincount(sentence, minlength=n_sentences))])
    weights, memory = np.zeros(len(words)), np.full(len(words) + 1, 1e-6)
    bias, rng = -4.0, np.random.default_rng(11)
    for _ in range(rounds):
        seen = np.flatnonzero(rng.random(n_sentences) < shown)
        sizes = first[seen + 1] - first[seen]
        of = np.repeat(np.arange(len(seen)), sizes)
        word = at[np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[seen][of]]
        p = np.minimum(_sigmoid(bias + np.bincount(of, weights[word], minlength=len(seen))), 1 - 1e-9)
        whole = np.maximum(-np.expm1(np.bincount(doc_of[seen], np.log1p(-p), minlength=n)), 1e-9)
        # Derivative of the documents' log loss by each sentence's logit.
        slope = p * (1 - (label / whole)[doc_of[seen]])
        gradient = np.append(np.bincount(word, slope[of], minlength=len(words)), slope.sum()) / n
        memory += gradient**2
        step = rate / np.sqrt(memory)
        moved = weights - step[:-1] * gradient[:-1]
        weights = np.sign(moved) * np.maximum(np.abs(moved) - step[:-1] * l1, 0)
        bias -= step[-1] * gradient[-1]
    some = np.abs(weights) > 1e-3
    return Model(words[some], weights[some], float(bias))


def _marks_by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist(), strict=True):
            marks = np.unique(_sentences((text or b"").decode("utf-8", "replace"))[0]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(marks), pa.array(np.full(len(marks), toxic), pa.int32())], names=["mark", "toxic"]
            )


def _suspects(suspects: np.ndarray):
    """Each document's suspicious features, by number, and their sentences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            both = [_sentences((t or b"").decode("utf-8", "replace")) for t in batch.column("text").to_pylist()]
            both = [(np.searchsorted(suspects, h[k]), s[k]) for h, s in both for k in [np.isin(h, suspects)]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("toxic"),
                    pa.array([h.astype(np.int32).tobytes() for h, _ in both], pa.binary()),
                    pa.array([s.astype(np.int32).tobytes() for _, s in both], pa.binary()),
                ],
                names=["toxic", "words", "sentences"],
            )

    return run


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, min_docs: int = MIN_DOCS) -> Model:
    """Fit on about ``sample`` labelled documents (or all, if fewer) that are not held out, chosen by a hash of their id; on two texts for each at most,
    on average, should ids be repeated.

    A document with several labels is toxic if one says so; null labels say nothing. Features that stand in toxic documents
    no more often than in others are left out: under noisy-or a word can only add suspicion.
    """
    labelled = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    # A threshold on the hash, so that no task or driver sees more than the sample.
    share = min(1.0, sample / max(1, labelled.count()))
    chosen = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    # ``sample`` rows of two numbers.
    with_id = identified(docs).join(F.broadcast(chosen), "doc_id")
    # Ids may be repeated: rows equal in id and text are one example, and beyond two per document they are drawn by their hash.
    distinct = with_id.select("doc_id", "text_hash").distinct().count()
    kept = 1.0 if distinct <= 2 * sample else sample / distinct
    drawn = with_id.where(F.pmod(F.xxhash64("text_hash", "doc_id"), F.lit(1 << 30)) < int(kept * (1 << 30)))
    rows = stored(
        # Partial aggregation leaves one row of a task however many copies it reads.
        drawn.groupBy("doc_id", "text_hash").agg(F.first("toxic").alias("toxic"), F.first("text").alias("text")).drop("text_hash"),
        "labelled-sample",
    ).repartition("doc_id")
    n, toxic = rows.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    expected = F.col("in_docs") * F.lit((toxic or 0) / max(n, 1))
    suspects = (
        rows.mapInArrow(_marks_by_document, "mark long, toxic int")
        .groupBy("mark")
        .agg(F.count(F.lit(1)).alias("in_docs"), F.sum("toxic").alias("in_toxic"))
        .where((F.col("in_docs") >= min_docs) & (F.col("in_toxic") - expected >= 3 * F.sqrt(expected)))
        .select("mark")
        .toArrow()
    )
    marks = np.sort(suspects.column("mark").to_numpy().view(np.uint64))
    found = rows.mapInArrow(_suspects(marks), "toxic int, words binary, sentences binary").toArrow()
    # Sorted, so that the fit does not depend on the order in which tasks end.
    found = sorted(zip(*(found.column(c).to_pylist() for c in ("words", "sentences", "toxic")), strict=True))
    return fit(
        [(marks[np.frombuffer(w, np.int32)], np.frombuffer(s, np.int32).astype(np.int64), y) for w, s, y in found]
    )


def _scored(model: Model, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        for batch in chunks(batches, "__text"):
            scores, where = [], []
            for text in batch.column("__text").to_pylist():
                text = (text or b"").decode("utf-8", "replace")
                score, p = model.of(text)
                scores.append(score)
                where.append(model.offending(text, p) if score >= threshold else [])
            names = [c for c in batch.schema.names if c != "__text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(scores, pa.float64()), pa.array(where, kind)],
                names=[*names, "__score", "__offending"],
            )

    return run


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, offending``: the probability of toxicity, and the spans of sentences of at least 0.5.

    Null and empty texts score 0, as does everything if there was nothing to learn from. A null or repeated ``doc_id``
    is carried along, row by row. Extra columns are ignored, whatever their names.
    """
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("__text"))
        .mapInArrow(_scored(model, threshold), "doc_id long, __score double, __offending array<struct<start: long, end: long, score: double>>")
        .select("doc_id", F.col("__score").alias("score"), F.col("__offending").alias("offending"))
    )


def keep_civil(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below ``threshold``, with all their columns."""
    # Columns are numbered on the way through Python, so that no name can clash.
    numbered = docs.toDF(*(f"__c{i}" for i in range(len(docs.columns))))
    text = numbered.columns[docs.columns.index("text")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in numbered.schema)
    kept = (
        numbered.withColumn("__text", F.col(text).cast("string").cast("binary"))
        .mapInArrow(
            _scored(model, threshold), f"{schema}, __score double, __offending array<struct<start: long, end: long, score: double>>"
        )
        .where(F.col("__score") < threshold)
    )
    return kept.select(*numbered.columns).toDF(*docs.columns)
