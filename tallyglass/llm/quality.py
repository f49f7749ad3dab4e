"""Document quality by a regularised quadratic discriminant over transformed document statistics.

Each text is reduced to some twenty statistics (counts as logarithms, shares as smoothed log odds), read in one pass and stored.
Both classes are normal densities with a mean and a covariance of their own. Covariances are shrunk towards the pooled one and that
towards a multiple of the identity; how far is chosen by cross-validation. All a fit needs are sums and sums of products, so
it learns from every labelled row: tasks add up their rows, Spark adds up the tasks, and the driver sees some hundred numbers a fold.
A score is the logistic of the classes' log-density difference, from Mahalanobis distances by Cholesky factors kept in the model.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyglass.llm.rows import chunks, stored

THRESHOLD = 0.7
FOLDS = 5
#: Characters of a text whose words are held at a time.
SEGMENT = 1 << 20
#: What cross-validation chooses from: shares of the pooled covariance and of the identity, and the scale of the log odds.
POOLED = (0.02, 0.1, 0.3, 0.7)
ROUND = (0.005, 0.05, 0.2)
SCALES = (1.0, 0.5, 0.2, 0.1)

STATISTICS = (
    "words", "word_length", "letters", "upper", "digits", "symbols", "punctuation", "spaces", "bare_words", "upper_words",
    "capitalised", "stuttered", "distinct", "commonest", "squeezed", "lines", "sentences", "entropy", "length_spread",
)
_SPACE = re.compile(r"\s")
_PUNCTUATION = frozenset(".,;:!?'\"-()’“”«»¿¡…")


def held_out(doc_id: Column) -> Column:
    """Rows no model learns from: crc32 of the id as text, modulo 4, is 2. A null id is not held out, but has no label."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@lru_cache(maxsize=1 << 16)
def _class(char: str) -> str:
    if char.isspace():
        return "space"
    if char.isalpha() or unicodedata.category(char).startswith("M"):
        return "upper" if char.isupper() else "letter"
    if char.isnumeric():
        return "digit"
    return "punctuation" if char in _PUNCTUATION else "symbol"


def _segments(text: str) -> Iterator[str]:
    """A text in pieces of about SEGMENT characters, cut at white space."""
    start = 0
    while start < len(text):
        stop = _SPACE.search(text, start + SEGMENT)
        end = stop.end() if stop else len(text)
        yield text[start:end]
        start = end


def _odds(part: float, whole: float) -> float:
    """Log odds of a share, finite at none and all of nothing and something."""
    return math.log((part + 0.5) / (whole - part + 0.5))


def statistics(text: str) -> list[float]:
    """The transformed statistics of a whole text; an empty one has finite ones too."""
    chars, words, last = Counter(), Counter(), None
    n_words = stuttered = squeezed = sized = 0
    packer = zlib.compressobj(1)
    for segment in _segments(text):
        chars.update(segment)
        found = segment.split()
        n_words += len(found)
        stuttered += sum(map(eq, found, found[1:])) + (bool(found) and found[0] == last)
        last = found[-1] if found else last
        words.update(found)
        raw = segment.encode("utf-8", "replace")
        sized, squeezed = sized + len(raw), squeezed + len(packer.compress(raw))
    squeezed += len(packer.flush())
    kinds = Counter()
    for char, n in chars.items():
        kinds[_class(char)] += n
    n_chars, letters = sum(chars.values()), kinds["letter"] + kinds["upper"]
    solid = n_chars - kinds["space"]
    bare = shouted = capitalised = spread = 0
    folded = Counter()
    mean = solid / max(n_words, 1)
    for word, n in words.items():
        spread += n * (len(word) - mean) ** 2
        folded[word.casefold()] += n
        # Both are false for words without any letter.
        if word.isupper() and len(word) > 1:
            shouted += n
        if word[0].isupper():
            capitalised += n
        if not any(map(str.isalnum, word)):
            bare += n
    entropy = -sum(n / n_chars * math.log(n / n_chars) for n in chars.values())
    return [
        math.log1p(n_words),
        math.log((solid + 1) / (n_words + 1)),
        _odds(letters, solid),
        _odds(kinds["upper"], letters),
        _odds(kinds["digit"], solid),
        _odds(kinds["symbol"], solid),
        _odds(kinds["punctuation"], solid),
        _odds(kinds["space"], n_chars),
        _odds(bare, n_words),
        _odds(shouted, n_words),
        _odds(capitalised, n_words),
        _odds(stuttered, n_words),
        _odds(len(folded), n_words),
        _odds(max(folded.values(), default=0), n_words),
        math.log((squeezed + 16) / (sized + 16)),
        math.log((chars["\n"] + 1) / (n_words + 1)),
        math.log((chars["."] + chars["!"] + chars["?"] + 1) / (n_words + 1)),
        entropy,
        math.log(spread / max(n_words, 1) + 0.1),
    ]


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        found = [statistics((t or b"").decode("utf-8", "replace")) for t in batch.column("text").to_pylist()]
        kept = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in kept), pa.array(found, pa.list_(pa.float64()))], names=[*kept, "x"]
        )


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id, fold, x``, stored: the statistics of every row. Equal texts are in one fold. Nulls count as empty texts."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.pmod(F.xxhash64(text), F.lit(FOLDS)).cast("int").alias("fold"),
        text.cast("binary").alias("text"),
    )
    return stored(rows.mapInArrow(_measured, "doc_id long, fold int, x array<double>"), "statistics")


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of products of the statistics and 1, by fold and class."""
    total = np.zeros((FOLDS, 2, len(STATISTICS) + 1, len(STATISTICS) + 1))
    for batch in batches:
        x = np.hstack([_rows(batch), np.ones((batch.num_rows, 1))])
        fold, good = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("fold", "quality"))
        for f in range(FOLDS):
            for c in (0, 1):
                some = x[(fold == f) & (good == c)]
                total[f, c] += some.T @ some
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total.ravel()[at])], names=["at", "total"])


def _moments(labelled: DataFrame) -> np.ndarray:
    size = len(STATISTICS) + 1
    out = np.zeros(FOLDS * 2 * size * size)
    found = labelled.select("fold", "quality", "x").mapInArrow(_summed, "at int, total double").groupBy("at").agg(F.sum("total").alias("total"))
    for at, total in found.collect():
        out[at] = total
    return out.reshape(FOLDS, 2, size, size)


@dataclass(frozen=True)
class Model:
    """Means, inverse Cholesky factors and log densities' constants of both classes; ``scale`` of the log odds."""

    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray
    scale: float = 1.0

    def odds(self, x: np.ndarray) -> np.ndarray:
        """Difference of the log densities, priors included, of good and other documents."""
        both = [c - 0.5 * (((x - m) @ w.T) ** 2).sum(axis=1) for m, w, c in zip(self.means, self.factors, self.constants)]
        return both[1] - both[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.odds(x), -700, 700)))


def fit(moments: np.ndarray, pooled: float, round_: float, scale: float = 1.0) -> Model:
    """The densities of sums of products by class; a class without rows has the moments of the other."""
    n = moments[:, -1, -1]
    whole = moments.sum(axis=0)
    means, scatters = [], []
    for rows, m in zip(n, moments):
        rows, m = (rows, m) if rows else (whole[-1, -1], whole)
        mean = m[-1, :-1] / max(rows, 1)
        means.append(mean)
        scatters.append(m[:-1, :-1] - rows * np.outer(mean, mean))
    common = sum((s for s, rows in zip(scatters, n) if rows), np.zeros_like(scatters[0])) / max(n.sum(), 1)
    # Statistics have units of their own: round means equal variances on the pooled scale.
    sizes = np.diag(np.maximum(np.diag(common), 1e-4))
    factors, constants = [], []
    for rows, s in zip(n, scatters):
        own = s / rows if rows else common
        shrunk = (1 - pooled) * own + pooled * common
        factor = np.linalg.cholesky((1 - round_) * shrunk + round_ * sizes)
        factors.append(np.linalg.inv(factor))
        constants.append(math.log((rows + 1) / (n.sum() + 2)) - np.log(np.diag(factor)).sum())
    return Model(np.array(means), np.array(factors), np.array(constants), scale)


def _losses(models: dict[int, list[Model]]):
    """Log loss of the labelled rows under each model that did not see their fold, summed up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(models[0]), len(SCALES)))
        for batch in batches:
            x, fold, good = _rows(batch), *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("fold", "quality"))
            for f in np.unique(fold):
                some, sign = x[fold == f], 2.0 * good[fold == f] - 1
                for i, model in enumerate(models[f]):
                    odds = sign * model.odds(some)
                    total[i] += [np.logaddexp(0, -scale * odds).sum() for scale in SCALES]
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], names=["at", "loss"])

    return run


def train(measured: DataFrame, labels: DataFrame) -> Model:
    """Fit on all labelled rows that are not held out.

    A document with several labels is as good as the worst of them says; null labels say nothing. Rows that repeat a
    ``doc_id`` share its label and count each. Without any label, or with labels of one class, both densities are the same and scores
    follow the classes' shares.
    """
    # Stored before the join, so that both sides of it are shuffled and a hot id can be split.
    known = stored(
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality")),
        "labels",
    )
    labelled = stored(measured.join(known, "doc_id").select("fold", "quality", "x"), "labelled")
    moments = _moments(labelled)
    grid = [(p, r) for p in POOLED for r in ROUND]
    whole = moments.sum(axis=0)
    if not whole[:, -1, -1].all():
        return fit(whole, *grid[-1])
    models = {f: [fit(whole - moments[f], *g) for g in grid] for f in range(FOLDS)}
    found = labelled.mapInArrow(_losses(models), "at int, loss double").groupBy("at").agg(F.sum("loss").alias("loss")).collect()
    best = min(found, key=lambda r: (r["loss"], r["at"]))["at"]
    return fit(whole, *grid[best // len(SCALES)], SCALES[best % len(SCALES)])


def score(measured: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score``: the probability that a document is good, for every measured row, empty texts included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(_rows(batch)))], names=["doc_id", "score"])

    return measured.select("doc_id", "x").mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, score`` of every row of ``docs``, by a model of the labelled ones.

    Null texts score as empty ones do. A null ``doc_id`` is carried along and has no label. Rows of one text score alike. Extra columns are
    ignored, whatever their names; an empty table gives an empty result.
    """
    measured = measure(docs)
    return score(measured, train(measured, labels))
