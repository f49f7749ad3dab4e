"""Secrets in text: fixed patterns, and probabilistic automata inferred from what the patterns find.

Credentials that the patterns find are the labelled examples of their kind. From a bounded sample of each kind
a prefix tree is built over classes of characters, and states whose continuations do not differ significantly
(Hoeffding bound, as in the ALERGIA algorithm) are merged into a probabilistic automaton. Ordinary strings give one in
the same way. Every string of eight or more credential characters that no pattern covers, words included, is then scored by how much
likelier its format is under the best credential automaton than under the ordinary one.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from math import log, log2, sqrt

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyglass.llm.rows import chunks, stored

# The base patterns, the least length of what counts, and the group that holds the credential.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex")
LEARNED = "learned"

#: Shortest string that is scored beside the patterns: the shortest credential they find.
LEAST = 8
#: Examples per kind that an automaton is inferred from, at most.
SAMPLE = 400
#: Bits a string must gain under a credential automaton, in all and per character.
GAIN, GAIN_EACH = 12.0, 0.5
#: All characters of credentials; a full stop at the end is the sentence's.
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=.-]{{{LEAST - 1},}}[A-Za-z0-9+/_=-]")
#: Characters beyond which a string has no format to learn.
LONGEST = 512
_CLASSES = ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "+/=", "_-.")
_CLASS_OF = {c: i for i, cs in enumerate(_CLASSES) for c in cs}
_WIDTH = [log2(len(cs)) for cs in _CLASSES]


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """Start, end, kind and credential of the patterns' matches, by start, then kind. Spans are whole matches."""
    found = [(m.start(), m.end(), "assign", m.group(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    found += [(m.start(), m.end(), "access", m.group()) for m in ACCESS.finditer(text) if len(m.group()) >= 16]
    # Of a run of hexadecimal digits the whole is matched, so the length may stand in the pattern.
    found += [(m.start(), m.end(), "hex", m.group()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def _touched(start: int, end: int, spans: Iterable[tuple[int, int]]) -> bool:
    """Whether one of ``spans``, sorted by start, reaches into a range."""
    for s, e in spans:
        if s >= end:
            return False
        if e > start:
            return True
    return False


def candidates(text: str, spans: list[tuple[int, int, str, str]]) -> list[tuple[int, int]]:
    """Strings of credential characters that touch no span."""
    out, rest = [], deque(sorted((s, e) for s, e, *_ in spans))
    for m in _CANDIDATE.finditer(text):
        while rest and rest[0][1] <= m.start():
            rest.popleft()
        if not _touched(m.start(), m.end(), rest):
            out.append(m.span())
    return out


@dataclass
class _State:
    visits: int = 0
    stops: int = 0
    next: dict[int, int] = field(default_factory=dict)  # class: state
    counts: Counter = field(default_factory=Counter)  # class: how often taken


@dataclass(frozen=True)
class Automaton:
    """State, by class: successor and log2 probability; and the log2 probability of stopping."""

    moves: tuple[dict[int, tuple[int, float]], ...]
    stops: tuple[float, ...]
    other: float = -12.0

    def bits(self, text: str) -> float:
        """log2 likelihood of a string: classes by the automaton, characters evenly within their class."""
        state, total = 0, 0.0
        for c in text:
            kind = _CLASS_OF[c]
            total -= _WIDTH[kind]
            state, gained = self.moves[state].get(kind, (state, self.other))
            total += gained
        return total + self.stops[state]


def infer(examples: Iterable[str], alpha: float = 0.05) -> Automaton:
    """Merge the compatible states of the examples' prefix tree."""
    states = [_State()]
    for text in sorted(examples):
        at = 0
        states[0].visits += 1
        for c in text:
            kind = _CLASS_OF[c]
            if kind not in states[at].next:
                states[at].next[kind] = len(states)
                states.append(_State())
            states[at].counts[kind] += 1
            at = states[at].next[kind]
            states[at].visits += 1
        states[at].stops += 1

    bound = sqrt(0.5 * log(2 / alpha))

    def differ(a: int, n: int, b: int, m: int) -> bool:
        return bool(n and m) and abs(a / n - b / m) > bound * (1 / sqrt(n) + 1 / sqrt(m))

    def compatible(a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            x, y = states[a], states[b]
            if differ(x.stops, x.visits, y.stops, y.visits):
                return False
            if any(differ(x.counts[k], x.visits, y.counts[k], y.visits) for k in {*x.counts, *y.counts}):
                return False
            todo += [(x.next[k], y.next[k]) for k in x.next.keys() & y.next.keys()]
        return True

    def fold(a: int, b: int) -> None:
        """Add the tree below ``b`` to what lies below ``a``."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            x, y = states[a], states[b]
            x.visits += y.visits
            x.stops += y.stops
            x.counts += y.counts
            for k, child in y.next.items():
                if k in x.next:
                    todo.append((x.next[k], child))
                else:
                    x.next[k] = child

    kept, border = [0], deque((0, k) for k in sorted(states[0].next))
    while border:
        parent, kind = border.popleft()
        state = states[parent].next[kind]
        if state in kept:
            continue
        same = next((k for k in kept if compatible(k, state)), None)
        if same is None:
            kept.append(state)
            border.extend((state, k) for k in sorted(states[state].next))
        else:
            states[parent].next[kind] = same
            fold(same, state)
            # Folding may have given kept states new branches.
            border.extend((k, c) for k in kept for c in sorted(states[k].next) if states[k].next[c] not in kept)
    number = {state: i for i, state in enumerate(kept)}
    moves, stops = [], []
    for k in kept:
        s = states[k]
        whole = s.visits + 1
        moves.append({c: (number[t], log2((s.counts[c] + 0.05) / whole)) for c, t in s.next.items()})
        stops.append(log2((s.stops + 0.05) / whole))
    return Automaton(tuple(moves), tuple(stops))


@dataclass(frozen=True)
class Formats:
    """Automata of credentials by kind, and that of ordinary strings."""

    credentials: dict[str, Automaton]
    ordinary: Automaton | None

    def gain(self, text: str) -> float:
        """Bits by which the likeliest credential format beats the ordinary one."""
        if not self.credentials or self.ordinary is None:
            return float("-inf")
        return max(a.bits(text) for a in self.credentials.values()) - self.ordinary.bits(text)

    def is_credential(self, text: str) -> bool:
        gain = self.gain(text)
        return gain >= GAIN and gain >= GAIN_EACH * len(text)


class _Least:
    """The ``size`` distinct strings of the least hash, of any number that are added."""

    def __init__(self, size: int):
        self.size, self.held, self.bound = size, {}, 1 << 64

    def add(self, text: str) -> None:
        drawn = xxhash.xxh64_intdigest(text.encode(), 42)
        if drawn <= self.bound:
            self.held[text] = drawn
            if len(self.held) > 4 * self.size:
                self.held = {t: d for d, t in self.first()}
                self.bound = max(self.held.values())

    def first(self) -> list[tuple[int, str]]:
        return sorted((d, t) for t, d in self.held.items())[: self.size]


def _examples(sample: int):
    """Of each kind the task's ``sample`` strings of the least hash; so the least of all tasks are among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = {kind: _Least(sample) for kind in (*KINDS, LEARNED)}
        for batch in chunks(batches):
            for text in batch.column("text").to_pylist():
                text = (text or b"").decode("utf-8", "replace")
                spans = base_spans(text)
                for _, _, kind, credential in spans:
                    if len(credential) <= LONGEST:
                        least[kind].add(credential)
                for start, end in candidates(text, spans):
                    if end - start <= LONGEST:
                        least[LEARNED].add(text[start:end])
        rows = [(kind, t) for kind, found in least.items() for _, t in found.first()]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.string()), pa.array([t for _, t in rows], pa.string())], names=["kind", "example"])

    return run


def learn(docs: DataFrame, sample: int = SAMPLE) -> Formats:
    """Infer the formats from at most ``sample`` distinct examples of each kind and of ordinary strings.

    The examples are those of the least hash; ones beyond 512 characters have no format and are not learned from.
    """
    text = F.col("text").cast("string").cast("binary").alias("text")
    found = stored(docs.select(text).mapInArrow(_examples(sample), "kind string, example string").distinct(), "credential-examples")
    # As unsigned numbers, as the tasks compare them.
    draw = F.xxhash64("example").bitwiseXOR(F.lit(-(1 << 63)))
    rows = {
        kind: [r[0] for r in found.where(F.col("kind") == kind).orderBy(draw, "example").limit(sample).select("example").collect()]
        for kind in (*KINDS, LEARNED)
    }
    return Formats({k: infer(rows[k]) for k in KINDS if rows.get(k)}, infer(rows[LEARNED]) if rows.get(LEARNED) else None)


#: Under the empty string: the formats that judged.
_verdicts: dict[str, bool | Formats] = {}


def _judged(formats: Formats, text: str) -> bool:
    """``is_credential``, remembered for words that come again. A worker judges by one set of formats at a time."""
    if _verdicts.get("") is not formats:
        _verdicts.clear()
        _verdicts[""] = formats
    found = _verdicts.get(text)
    if found is None:
        if len(_verdicts) > 200_000:
            _verdicts.clear()
            _verdicts[""] = formats
        found = formats.is_credential(text)
        if len(text) <= 64:
            _verdicts[text] = found
    return found


def all_spans(text: str, formats: Formats) -> list[tuple[int, int, str, str]]:
    """The patterns' spans and the learned ones, by start, then kind."""
    base = base_spans(text)
    more = [(s, e, LEARNED, text[s:e]) for s, e in candidates(text, base) if _judged(formats, text[s:e])]
    return sorted([*base, *more], key=lambda x: (x[0], (*KINDS, LEARNED).index(x[2])))


def _found(formats: Formats):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in chunks(batches):
            rows = []
            for text in batch.column("text").to_pylist():
                spans = all_spans((text or b"").decode("utf-8", "replace"), formats)
                rows.append([{"kind": k, "start": s, "end": e} for s, e, k, _ in spans])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kind)], names=["doc_id", "spans"])

    return run


def scan(docs: DataFrame, formats: Formats) -> DataFrame:
    """``doc_id, spans``: kind, start and end (code points, end exclusive) of every secret, by start, then kind.

    Null and empty texts have none. A null or repeated ``doc_id`` is carried along, row by row. Extra
    columns are ignored, whatever their names; an empty table gives an empty result.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(
        _found(formats), "doc_id long, spans array<struct<kind: string, start: long, end: long>>"
    )
