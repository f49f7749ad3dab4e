"""Text operators against brute force, on small tables with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tallyglass.llm import components, credentials, decontaminate, line_dedup, packing, simhash, substring_dedup

# Columns whose names operators use inside.
SCHEMA = "doc_id long, text string, lang string, n_words long, spans string, __starts int, text_hash long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", 1, "x", 2, 3) for i, t in rows], SCHEMA)


def words(text):
    return text.encode().split() if text else []


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(90)]
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "a " * 80), (6, "x y " * 50), (None, "tail " + " ".join(passage))]
    for i in range(10, 40):
        own = [rng.choice(vocabulary) for _ in range(rng.randint(20, 160))]
        if i % 3 == 0:
            at, cut = rng.randint(0, len(own)), rng.randint(0, 50)
            own[at:at] = passage[cut : cut + rng.randint(30, 60)]
        rows.append((i, rng.choice([" ", "\n", "  ", "  "]).join(own)))
    rows += [(11, rows[8][1]), (70, rows[9][1]), (71, rows[9][1] + " end"), (11, "another text under a used id")]
    rows.append((90, " ".join(rng.choice(vocabulary) for _ in range(20_000)) + " " + " ".join(passage)))
    return rows


def brute_repeats(rows, window):
    seen = Counter()
    for _, text in rows:
        w = words(text)
        seen.update(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
    out = []
    for doc_id, text in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((doc_id, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("window", "k"), [(35, 8), (5, 2), (3, 3)])
def test_repeats_match_brute_force(spark, texts, window, k):
    found = substring_dedup.remove_repeats(frame(spark, texts), window, k).collect()
    assert sorted(map(tuple, found), key=repr) == brute_repeats(texts, window)


def test_repeats_of_empty_tables(spark):
    assert substring_dedup.remove_repeats(frame(spark, [])).collect() == []


def brute_lines(rows, window=3):
    order = sorted(range(len(rows)), key=lambda r: (rows[r][0] is not None, rows[r][0] or 0))
    first = {}
    for r in order:
        lines = [] if rows[r][1] is None else rows[r][1].split("\n")
        for i in range(len(lines) - window + 1):
            first.setdefault(tuple(lines[i : i + window]), (rows[r], i))
    out = []
    for row in rows:
        lines = [] if row[1] is None else row[1].split("\n")
        gone = set()
        for i in range(len(lines) - window + 1):
            if first[tuple(lines[i : i + window])] != (row, i):
                gone.update(range(i, i + window))
        kept = None if row[1] is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out.append((row[0], len(lines), len(gone), kept))
    return sorted(out, key=repr)


def test_line_windows_match_brute_force(spark):
    rng = random.Random(8)
    rows = [(1, None), (2, ""), (3, "a\nb"), (4, "a\na\na\na\na"), (None, "p\nq\nr\ns")]
    rows += [(i, "\n".join(rng.choice("abc") for _ in range(rng.randint(1, 30)))) for i in range(10, 30)]
    rows += [(50, "p\nq\nr\ns"), (51, "p\nq\nr\ns"), (50, "p\nq\nr\ns"), (60, "\n" * 9000)]
    found = line_dedup.remove_lines(frame(spark, rows), carry=("lang", "n_words", "__starts"))
    assert found.columns == ["doc_id", "n_lines", "n_removed", "text", "lang", "n_words", "__starts"]
    assert sorted([tuple(r)[:4] for r in found.collect()], key=repr) == brute_lines(rows)
    assert line_dedup.remove_lines(frame(spark, [])).collect() == []


def brute_fingerprint(text):
    w = [x.lower() for x in words(text)]
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_classes(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 3:
            root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)].append(doc_id)
    return sorted(((rows[i][0], fps[i], min(least[find(i)], default=None)) for i in range(len(rows))), key=repr)


def test_simhash_classes_match_brute_force(spark, texts):
    rows = [*texts, (100, "A b C"), (101, "a B c"), (102, "one"), (103, "ONE"), (104, "É é"), (105, "é é")]
    found = simhash.classes(frame(spark, rows)).collect()
    assert sorted([(r[0], r[1] % (1 << 64), r[2]) for r in found], key=repr) == brute_classes(rows)
    assert simhash.classes(frame(spark, [])).collect() == []
    kept = simhash.keep_one(frame(spark, rows))
    assert kept.columns == frame(spark, []).columns
    expected = [i for i, _, c in brute_classes(rows) if i is None or i == c]
    assert sorted([r[0] for r in kept.collect()], key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("cell", [5, 2048])
def test_links_lose_no_near_pair(spark, cell):
    rng = random.Random(2)
    centre = rng.getrandbits(64)
    near = {centre} | {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))) for _ in range(150)}
    fps = sorted(near | {rng.getrandbits(64) for _ in range(200)})
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    found = simhash.links(spark.createDataFrame(signed, "fp long"), cell=cell).collect()

    def groups(pairs):
        root = {x: x for x in fps}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            root[find(a)] = find(b)
        parts = defaultdict(set)
        for x in fps:
            parts[find(x)].add(x)
        return {frozenset(p) for p in parts.values()}

    pairs = [(r[0] % (1 << 64), r[1] % (1 << 64)) for r in found]
    assert all((a ^ b).bit_count() <= 3 for a, b in pairs)
    assert groups(pairs) == groups([(a, b) for a, b in combinations(fps, 2) if (a ^ b).bit_count() <= 3])


def test_components_of_long_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(100)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    edges = spark.createDataFrame([*path[::-1], *star, (2000, 2000), (3, 1)], "a long, b long")
    found = {r["node"]: r["root"] for r in components.components(edges).collect()}
    assert found == {**{i: 0 for i in range(1, 101)}, **{1000 + i: 1000 for i in range(1, 50)}}
    assert components.components(edges.where("a < 0")).collect() == []


def low(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def brute_contamination(rows, items, window=10):
    out = []
    for doc_id, text in rows:
        w, hit, names = low(text), set(), set()
        for item_id, item in items:
            iw = low(item)
            n = min(window, len(iw))
            if not n or item_id is None:
                continue
            wanted = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)}
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in wanted:
                    hit.update(range(i, i + n))
                    names.add(str(item_id))
        out.append((doc_id, len(w), len(hit), sorted(names)))
    return sorted(out, key=repr)


def test_contamination_matches_brute_force(spark, texts):
    rng = random.Random(6)
    passage = texts[6][1]
    rows = [*texts, (200, "Überall IST eine Katze, und ÉTÉ!"), (201, "ist eine"), (202, "a-b-c a b c")]
    items = [(1, passage), (1, "ist eine"), (2, "Überall ist"), (3, None), (4, " .,"), (None, "one"), (5, "one"), (6, "A B C"), (10, passage[:200])]
    items += [(20 + i, " ".join(rng.sample((texts[10][1] or "").split(), 5))) for i in range(3)]
    bench = spark.createDataFrame([(i, t, 1, "q") for i, t in items], "item_id long, text string, n_words int, words string")
    found = decontaminate.contaminated(frame(spark, rows), bench).collect()
    assert sorted([tuple(r) for r in found], key=repr) == brute_contamination(rows, items)
    clean = decontaminate.keep_clean(frame(spark, rows), bench)
    assert clean.columns == frame(spark, []).columns
    expected = [i for i, _, n, _ in brute_contamination(rows, items) if not n]
    assert sorted([r[0] for r in clean.collect()], key=repr) == sorted(expected, key=repr)
    empty = decontaminate.contaminated(frame(spark, rows), bench.where("item_id < 0")).collect()
    assert {(r["n_hit"], len(r["item_ids"])) for r in empty} == {(0, 0)}
    assert decontaminate.contaminated(frame(spark, []), bench).collect() == []


def test_packing_keeps_every_token_once(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    rows = [*texts, (300, "<|endoftext|> ¡hola! 　 漢字 's"), (301, " " * 12_000), (302, "word " * 2047), (303, "word " * 5000)]
    found = packing.pack(frame(spark, rows)).collect()
    documents = Counter((i, tuple([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0])) for i, t in rows)

    def ids(r):
        return [int.from_bytes(r["ids"][i : i + 4], "little") for i in range(0, len(r["ids"]), 4)]

    assert all(len(ids(r)) == r["length"] <= packing.CAPACITY for r in found)
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in sequences.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= packing.CAPACITY
    # Pieces of documents with an id of their own come together again.
    alone = {i for i, n in Counter(i for i, _ in rows).items() if n == 1}
    rebuilt = defaultdict(dict)
    for r in found:
        rebuilt[r["doc_id"]][r["start"]] = (r["piece"], ids(r))
    for (doc_id, tokens), _ in documents.items():
        if doc_id in alone:
            pieces = [rebuilt[doc_id][s] for s in sorted(rebuilt[doc_id])]
            assert [n for n, _ in pieces] == list(range(len(pieces)))
            assert [x for _, p in pieces for x in p] == list(tokens)
            assert all(len(p) == packing.CAPACITY for _, p in pieces[1:])
    assert sum(r["length"] for r in found) == sum(len(t) * n for (_, t), n in documents.items())
    assert packing.pack(frame(spark, [])).collect() == []


def test_packing_plan_fills_exactly_where_it_can():
    assert packing.plan({1000: 3, 1048: 3}) == [([1048, 1000], 3)]
    assert packing.plan({2000: 2, 20: 2, 28: 2}) == [([2000, 28, 20], 2)]
    assert packing.plan({2000: 1, 8: 1, 16: 1, 24: 1}) == [([2000, 24, 16, 8], 1)]
    assert packing.plan({1024: 5}) == [([1024, 1024], 2), ([1024], 1)]
    rng = random.Random(1)
    counts = Counter(min(2048, int(rng.lognormvariate(5.5, 1.1)) + 1) for _ in range(20_000))
    patterns = packing.plan(counts)
    used = Counter()
    for pattern, times in patterns:
        assert sum(pattern) <= 2048
        for length in pattern:
            used[length] += times
    assert used == counts
    least = -(-sum(k * v for k, v in counts.items()) // 2048)
    assert sum(times for _, times in patterns) <= least + 2


def brute_base(text):
    spans = []
    keys = r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    for m in re.finditer(keys + r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text or ""):
        if len(m.group(1)) >= 8:
            spans.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text or ""):
        if m.end() - m.start() >= 16:
            spans.append((m.start(), 1, f"access:{m.start()}:{m.end()}"))
    for m in re.finditer(r"[0-9a-f]+", text or ""):
        if m.end() - m.start() >= 32:
            spans.append((m.start(), 2, f"hex:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(spans)]


def test_base_spans_match_the_patterns(spark):
    rng = random.Random(9)

    def some(alphabet, n):
        return "".join(rng.choice(alphabet) for _ in range(n))

    texts = [None, "", 'token = "' + some("0123456789abcdef", 40) + '"', "é PassWord:hunter2hunter2", "password:token:abcdefghijk",
             "api_key==abcdefgh secret = short", "APIKEY='" + some("abcXYZ019+/", 30) + "'", "AKIA" + some("ABCDEF012", 12), "AKIAAKIA", "ſecret=abcdefgh1234",
             some("0123456789abcdef", 31), some("0123456789abcdef", 32) + "g", "AKIA" + "A" * 40 + " token=" + "deadbeef" * 8, "x" * 50_000 + " tok" + "en=" + "a" * 20_000]
    rows = list(enumerate(texts)) + [(None, texts[2]), (2, texts[2])]
    formats = credentials.learn(frame(spark, rows))
    for doc_id, spans in credentials.scan(frame(spark, rows), formats).collect():
        text = texts[doc_id if doc_id is not None else 2]
        base = [f"{s['kind']}:{s['start']}:{s['end']}" for s in spans if s["kind"] != credentials.LEARNED]
        assert base == brute_base(text)
        assert all(a["start"] <= b["start"] for a, b in zip(spans, spans[1:], strict=False))
    nothing = credentials.learn(frame(spark, []))
    assert credentials.scan(frame(spark, [(1, None), (2, "x")]), nothing).where(F.size("spans") > 0).count() == 0


def test_formats_tell_credentials_from_words():
    rng = random.Random(5)

    def some(alphabet, n):
        return "".join(rng.choice(alphabet) for _ in range(n))

    digits = "0123456789"
    hexes = [some(digits + "abcdef", 40) for _ in range(200)]
    cards = [some(digits, 16) for _ in range(200)]
    formats = credentials.Formats({"hex": credentials.infer(hexes)}, credentials.infer(cards))
    assert sum(formats.is_credential(some(digits + "abcdef", 28)) for _ in range(100)) >= 95
    assert sum(formats.is_credential(some(digits, 16)) for _ in range(100)) <= 2
    # Prefixed keys: states for the prefix stay apart from those of the random part.
    keys = credentials.infer("AKIA" + some("ABCDEFGHIJKLMNOPQRSTUVWXYZ" + digits, 16) for _ in range(300))
    assert keys.bits("AKIA" + some("ABCDEF" + digits, 16)) > keys.bits(some("abcdef" + digits, 20)) + 20


def test_pipeline_stages_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before, columns = docs, docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf_dir)
        assert after.columns == columns
        assert [f.dataType for f in after.schema] == [f.dataType for f in docs.schema]
        after = spark.createDataFrame([tuple(r) for r in after.collect()], docs.schema)
        kept[name] = {r["doc_id"]: r["text"] for r in after.collect()}
        given = {r["doc_id"]: r["text"] for r in before.collect()}
        assert set(kept[name]) <= set(given)
        rows = sorted(given.items())
        if name == "line dedup":
            assert sorted((i, t) for i, t in kept[name].items()) == sorted((i, t) for i, _, _, t in brute_lines(rows))
            assert all(r["n_chars"] == len(r["text"]) for r in after.collect())
        elif name == "SimHash near-dedup":
            assert set(kept[name]) == {c for _, _, c in brute_classes(rows)}
        elif name == "benchmark decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
            assert set(kept[name]) == {i for i, _, n, _ in brute_contamination(rows, items) if not n}
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, before, sf_dir).collect()
    assert {r["doc_id"] for r in packed} == set(kept["benchmark decontamination"])
    assert corpus_pipeline.ORACLE_SQL is None


def test_one_row_of_each_group_stays(spark):
    """Rows repeated in full, rows without an id and used ids: one row of each component, whatever repeats."""
    lines = [" ".join(f"w{i}x{j}" for j in range(12)) for i in range(40)]
    rows = [(1, lines[0]), (1, lines[0]), (2, lines[0]), (None, lines[1]), (None, lines[1]), (None, lines[1]), (7, lines[2]), (None, lines[2])]
    rows += [(8, lines[3]), (8, lines[4]), (None, None), (9, ""), (None, "")] + [(None, lines[5])] * 50 + [(20 + i, lines[6]) for i in range(30)]
    given = spark.createDataFrame([(i, t, "en", n % 3, "x", 2, 3) for n, (i, t) in enumerate(rows)], SCHEMA)
    kept = simhash.one_of_each(given)
    assert kept.columns == given.columns and kept.dtypes == given.dtypes
    want = [(1, lines[0]), (None, lines[1]), (7, lines[2]), (8, lines[3]), (8, lines[4]), (9, ""), (None, lines[5]), (20, lines[6])]
    found = kept.collect()
    assert sorted([tuple(r)[:2] for r in found], key=repr) == sorted(want, key=repr)
    assert {tuple(r) for r in found} <= {tuple(r) for r in given.collect()}
    assert simhash.one_of_each(given.where("doc_id < 0")).collect() == []


def test_a_file_read_twice_passes_the_pipeline_once(spark, sf_dir):
    once = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 60")
    twice = once.unionByName(once).unionByName(once.withColumn("doc_id", F.lit(None).cast("long")))
    stages = dict(corpus_pipeline.STAGES)
    found = []
    for docs in (once, twice):
        deduplicated = stages["SimHash near-dedup"](spark, docs, sf_dir)
        found.append(sorted((tuple(r) for r in deduplicated.collect()), key=repr))
    assert found[0] == found[1]


def test_later_copies_of_a_row_lose_their_windows(spark):
    rows = [(1, "a\nb\nc\nd"), (1, "a\nb\nc\nd"), (1, "a\nb\nc\nd"), (2, "x\na\nb\nc"), (3, "a\nb"), (3, "a\nb"), (None, "k\nl\nm"), (None, "k\nl\nm")]
    found = line_dedup.remove_lines(frame(spark, rows), carry=("lang",)).collect()
    want = [(1, 4, 0, "a\nb\nc\nd"), (1, 4, 4, ""), (1, 4, 4, ""), (2, 4, 3, "x"), (3, 2, 0, "a\nb"), (3, 2, 0, "a\nb"), (None, 3, 0, "k\nl\nm"), (None, 3, 3, "")]
    assert sorted([tuple(r)[:4] for r in found], key=repr) == sorted(want, key=repr)


def test_kept_text_digest_is_of_its_bytes(spark):
    row = substring_dedup.remove_repeats(frame(spark, [(1, "é  b\tc")])).select(F.sha2(F.col("text").cast("binary"), 256)).first()
    assert row[0] == hashlib.sha256("é b c".encode()).hexdigest()
