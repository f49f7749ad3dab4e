"""Language identification by error-correcting output codes.

Every language has a codeword of bits; for each bit a binary classifier over hashed character n-grams is trained. A
text's bit margins are decoded to the codeword of least weighted logistic loss, where a bit weighs by how
well it was learned; the loss gap to the runner-up flags ambiguous texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyglass.llm.rows import chunks, small, stored
from tallyglass.llm.toxicity import held_out

#: Documents of each language that the bits are learned from, at most.
SAMPLE = 600
#: Documents of all languages together, at most: with more than 64 languages each has fewer (one at least).
TOTAL = 64 * SAMPLE
#: Hashed n-gram features, a power of two.
FEATURES = 4096
GRAMS = (1, 2, 3)
#: Documents that are fitted at full width at a time (64 MB).
BLOCK = 4096
UNKNOWN = "und"
#: Below this probability of the chosen language a text is ambiguous.
CLEAR = 0.6
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def features(text: str, size: int = FEATURES) -> np.ndarray | None:
    """Square roots of n-gram shares, of length one; None without a letter. Letters are lower-cased, all else is a gap."""
    letters = _NOT_LETTERS.sub(" ", text.lower())
    if not any(map(str.isalpha, set(letters))):
        return None
    codes = np.frombuffer(f" {letters.strip()} ".encode("utf-32-le", "replace"), dtype="<u4")
    total = np.zeros(size)
    shift = np.uint32(32 - int(log2(size)))
    for n in GRAMS:
        h = np.full(max(0, len(codes) - n + 1), n, dtype=np.uint32)
        for i in range(n):
            h = (h ^ codes[i : i + len(h)]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
        total += np.bincount((h * np.uint32(0x85EBCA6B)) >> shift, minlength=size)
    total = np.sqrt(total)
    return total / np.linalg.norm(total)


def _least_distance(code: np.ndarray, rows: int = 1024) -> float:
    """Twice the least number of bits in which two codewords differ."""
    least = np.inf
    for start in range(0, len(code), rows):
        distance = code.shape[1] - code[start : start + rows] @ code.T
        distance[np.arange(len(distance)), start + np.arange(len(distance))] = np.inf
        least = min(least, distance.min())
    return least


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """Bits (-1, 1) of ``n`` codewords: all ways to part up to six languages, else random ones that differ widely."""
    if n <= 6:
        bits = [[1 if part >> i & 1 else -1 for i in range(n)] for part in range(1, 1 << (n - 1))]
        return np.array(bits, dtype=float).reshape(-1, n).T
    rng, width = np.random.default_rng(seed), 10 * ceil(log2(n))
    best, spread = None, -1
    # Fewer are tried of very many codewords, of which all pairs are compared.
    tries = 200 if n <= 200 else max(1, 200 * 200**2 // n**2)
    while tries > 0 or best is None:
        tries -= 1
        code = rng.choice([-1.0, 1.0], size=(n, width))
        distance = _least_distance(code)
        usable = (np.abs(code.sum(axis=0)) < n).all()
        if usable and distance > spread:
            best, spread = code, distance
    return best


@dataclass(frozen=True)
class Codes:
    languages: tuple[str, ...]
    code: np.ndarray  # language, bit
    weights: np.ndarray  # feature, bit
    bias: np.ndarray
    trust: np.ndarray  # bit

    def of(self, text: str | None) -> tuple[str, float, bool]:
        """Language, its probability, and whether the text is ambiguous."""
        x = features(text) if text and self.languages else None
        if x is None:
            return UNKNOWN, 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        margins = x @ self.weights + self.bias
        loss = (np.logaddexp(0, -self.code * margins) * self.trust).sum(axis=1)
        p = np.exp(loss.min() - loss)
        p /= p.sum()
        best = int(np.argmin(loss))
        return self.languages[best], float(p[best]), bool(p[best] < CLEAR)


@dataclass(frozen=True)
class Sparse:
    """Rows of features, of which only the set ones are held; a block of rows is spread out at a time."""

    rows: list[tuple[np.ndarray, np.ndarray]]  # features, values
    shape: tuple[int, int]

    def __getitem__(self, rows: slice) -> np.ndarray:
        part = self.rows[rows]
        out = np.zeros((len(part), self.shape[1]), dtype=np.float32)
        for row, (at, values) in zip(out, part, strict=True):
            row[at] = values
        return out


def fit(x: np.ndarray | Sparse, languages: list[str], rounds: int = 120, rate: float = 4.0, l2: float = 1e-5) -> Codes:
    """One logistic classifier per bit, each language weighing the same. Rows are taken in blocks, so the driver holds few at full width."""
    names = tuple(sorted(set(languages)))
    if len(names) < 2:
        return Codes(names, np.ones((len(names), 0)), np.zeros((FEATURES, 0)), np.zeros(0), np.zeros(0))
    number = {name: i for i, name in enumerate(names)}
    y = np.array([number[v] for v in languages])
    code = codewords(len(names))
    target = code[y].astype(np.float32)
    weigh = (1 / np.bincount(y)[y] / len(names))[:, None].astype(np.float32)
    weights, bias = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    speed = np.zeros_like(weights)
    parts = [slice(start, start + BLOCK) for start in range(0, x.shape[0], BLOCK)]
    only = x[parts[0]] if len(parts) == 1 else None

    def blocks() -> Iterator[tuple[slice, np.ndarray]]:
        yield from ((part, x[part] if only is None else only) for part in parts)

    for _ in range(rounds):
        gradient, shift = np.zeros_like(weights), np.zeros_like(bias)
        for part, rows in blocks():
            slope = -target[part] / (1 + np.exp(np.clip(target[part] * (rows @ weights + bias), -30, 30))) * weigh[part]
            gradient += rows.T @ slope
            shift += slope.sum(axis=0)
        speed = np.float32(0.9) * speed + gradient + np.float32(l2) * weights
        weights = weights - np.float32(rate) * speed
        bias = bias - np.float32(rate) * shift
    right = sum(((np.sign(rows @ weights + bias) == target[part]) * weigh[part]).sum(axis=0) for part, rows in blocks())
    # A bit no better than chance has no say; the weights sum to the number of bits.
    trust = np.clip(2 * right - 1, 0.01, 1)
    return Codes(names, code, weights, bias, trust * len(trust) / trust.sum())


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        rows = [
            (lang, np.flatnonzero(x).astype(np.int16).tobytes(), x[x != 0].astype(np.float32).tobytes())
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True)
            if (x := features((text or b"").decode("utf-8", "replace"))) is not None
        ]
        langs, at, xs = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(at, pa.binary()), pa.array(xs, pa.binary())], names=["lang", "at", "x"]
        )


def train(docs: DataFrame, sample: int = SAMPLE, total: int = TOTAL) -> Codes:
    """Fit on at most ``sample`` documents of each language, none of them held out, and on ``total`` of all.

    Documents are chosen by a hash of id and text; null languages are left out. Every other language is learned, the rarest too.
    """
    known = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").cast("binary").alias("text"),
    ).where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    counts = stored(known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    sample = max(1, min(sample, total // max(1, counts.count())))
    # A threshold on the hash keeps about twice the sample of each language; the exact bound follows.
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    below = F.least(F.lit(1 << 30), F.floor(2.0 * sample / F.col("n") * (1 << 30)) + 1)
    chosen = stored(
        known.withColumn("draw", draw).join(small(counts), "lang").where(F.col("draw") < below).select("lang", "draw", "doc_id", "text"),
        "language-sample",
    )
    first = Window.partitionBy("lang").orderBy("draw", "doc_id")
    rows = chosen.withColumn("number", F.row_number().over(first)).where(F.col("number") <= sample)
    found = rows.select("lang", "text").mapInArrow(_features, "lang string, at binary, x binary").toArrow()
    # Sorted, so that the fit does not depend on the order in which tasks end.
    found = sorted(zip(*(found.column(c).to_pylist() for c in ("lang", "at", "x")), strict=True))
    rows = [(np.frombuffer(at, np.int16), np.frombuffer(values, np.float32)) for _, at, values in found]
    return fit(Sparse(rows, (len(rows), FEATURES)), [lang for lang, *_ in found])


def _identified(codes: Codes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            found = [codes.of((t or b"").decode("utf-8", "replace")) for t in batch.column("text").to_pylist()]
            language, score, ambiguous = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(language, pa.string()), pa.array(score, pa.float64()), pa.array(ambiguous, pa.bool_())],
                names=["doc_id", "lang_pred", "score", "ambiguous"],
            )

    return run


def identify(docs: DataFrame, codes: Codes) -> DataFrame:
    """``doc_id, lang_pred, score, ambiguous``, one row per row of ``docs``.

    Null texts and texts without a letter are ``und`` with score 0, as is every text if nothing was learned. A null
    or repeated ``doc_id`` is carried along. Extra columns are ignored, whatever their names.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(
        _identified(codes), "doc_id long, lang_pred string, score double, ambiguous boolean"
    )
