"""Page extraction, vector search and the trained models, against brute force and held-out rows."""

import random
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyglass.llm import ann, html_extract, language, toxicity

PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var x = '</p>';</script></head><body>"
    "<header>Site</header><nav><ul><li>Home</li></ul></nav><!-- x --><div class='ad'>Buy now</div>{}"
    "<div id='comments'><p>First!</p></div><aside>See also</aside><form>Mail <input></form><footer>&copy; us</footer></body></html>"
)


def article(body):
    return PAGE.format(f"<article>{body}</article>")


def plain(body):
    return PAGE.format(f"<div>Part of Example</div>{body}<div>All rights kept</div>")


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "k", "s") for i, u, h in rows], "page_id long, url string, html string, keys string, shared string")


def texts(df):
    return {(r["page_id"], r["url"]): r["text"] for r in df.collect()}


def test_extracts_articles_and_differences_neighbours(spark):
    rows = [
        (1, "http://a.org/x/1", article("<h1>A &amp; B</h1><p>one\n two<p><b>thr</b>ee<br>four&nbsp; five &lt;i&gt;")),
        (2, "http://a.org/x/2", article("<h1>A &amp; B</h1><p>one\n two")),
        # No article: what the neighbour shares is template.
        (3, "http://b.org/y/1?q=1", plain("<p>own text</p><p>more</p>")),
        (4, "http://b.org/y/2#top", plain("<p>other text</p>")),
        (5, "http://alone.org/z", plain("<p>alone</p>")),
        (6, None, None),
        (7, "http://[bad", ""),
        (None, "http://b.org/y/1", plain("<p>third</p>")),
        (8, "http://c.org/cut", "<html><body><article><p>kept &am<div class='x"),
        (9, "http://c.org/cut", "<article>a<!-- open"),
        (10, "http://c.org/long", "<article>" + "<p>w</p>" * 30_000),
        (5, "http://alone.org/z", plain("<p>alone</p>")),
    ]
    found = html_extract.extract(pages(spark, rows))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = texts(found)
    assert found.count() == len(rows)
    assert got[1, "http://a.org/x/1"] == "A & B one two three four five <i>"
    assert got[2, "http://a.org/x/2"] == "A & B one two"
    assert got[3, "http://b.org/y/1?q=1"] == "own text more"
    assert got[4, "http://b.org/y/2#top"] == "other text"
    assert got[None, "http://b.org/y/1"] == "third"
    assert got[6, None] == got[7, "http://[bad"] == ""
    assert got[8, "http://c.org/cut"] == "kept &am"
    assert got[9, "http://c.org/cut"] == "a"
    assert got[10, "http://c.org/long"] == " ".join(["w"] * 30_000)
    assert html_extract.extract(pages(spark, [])).collect() == []


def test_copies_do_not_delete_each_other(spark):
    """Recrawls and mirrors share all lines, which does not make them template."""
    long = " ".join(["a long text."] * 20)
    rows = [
        (1, "http://alone.org/z", plain("<p>alone</p>")),
        (1, "http://alone.org/z", plain("<p>alone</p>")),
        (2, "http://d.org/a/1", plain("<p>first</p>")),
        *[(i, f"http://d.org/a/{i}", plain("<p>copied</p>")) for i in range(3, 30)],
        (30, "http://d.org/b", plain("<p>last</p>")),
        (39, "http://e.org/s", plain("<p>another</p>")),
        (40, "http://e.org/t", plain(f"<p>{long}</p><p>crawled on day 1</p>")),
        (41, "http://e.org/t", plain(f"<p>{long}</p><p>crawled on day 2</p>")),
        (42, "http://e.org/u", plain("<p>other</p>")),
    ]
    got = texts(html_extract.extract(pages(spark, rows)))
    assert got[1, "http://alone.org/z"] == "Part of Example alone All rights kept"
    assert {got[i, f"http://d.org/a/{i}"] for i in range(3, 30)} == {"copied"}
    assert got[2, "http://d.org/a/1"] == "first"
    assert got[30, "http://d.org/b"] == "last"
    assert got[42, "http://e.org/u"] == "other"
    assert got[39, "http://e.org/s"] == "another"
    # Each of the near copies is compared with the page on its other side.
    assert got[40, "http://e.org/t"] == f"{long} crawled on day 1"
    assert got[41, "http://e.org/t"] == f"{long} crawled on day 2"


def test_template_elements():
    kept = {
        "<div class='post-header'>no</div>": "",
        "<article><div class='post-header'>Title</div><footer>no</footer>text</article>": "Title text",
        "<div title='a hidden id=nav'>yes</div>": "yes",
        "<div hidden>no</div><p aria-hidden='true'>no</p><p>yes</p>": "yes",
        "<p class=\"cookie-notice\">no<p id=main>a<b>b</b> c<script>x</script> d": "ab c d",
        "<ul class=menu><li>no</ul><table><tr><td>1<td>2</table>": "1 2",
        "a &amp;lt; &#233; &nbsp; b < c": "a &lt; é b < c",
        "<article><div class='comments'>no</div><p>x</article><p role=navigation>no": "x",
    }
    for page, text in kept.items():
        assert " ".join(x.text for x in html_extract.lines_of(page) if not x.template) == text, page


def test_end_tags_left_out():
    """What HTML ends before a start tag makes nothing after it template."""
    kept = {
        "<p class=notice>no<div>yes</div>": "yes",
        "<p class=ad>no<h1>a</h1><ul><li>b</ul>": "a b",
        "<body><p class=cookie>no <b>no<article><p>yes</article>": "yes",
        "<p class=ad>no<hr>yes": "yes",
        "<ul><li class=promo>no<li>yes<ul><li class=ad>no</ul>yes<li>yes</ul>": "yes yes yes",
        "<ul><li class=promo><div>no<ul><li>no</ul></div><li>yes</ul>": "yes",
        "<dl><dt class=ad>no<dd>yes<dt>yes</dl>": "yes yes",
        "<table><tr><td class=ad>no<td>yes<tr class=promo><td>no<tr><td>yes<table><tr><td class=ad>no</table>yes</table>": "yes yes yes",
        "<table><thead class=menu><tr><td>no<tbody><tr><td>yes</table>": "yes",
        "<table><tr><td><p class=ad>no<table><tr><td>yes</table></table>": "yes",
        "<p class=ad>no<table><tr><td><p>yes</table>": "yes",
        "<head><title>no</title><meta charset=utf-8><body><p>yes": "yes",
        "<head><title>no</title>yes": "yes",
        "<form><div>no</div><article><p>yes<form>no</form></article><main>yes</main>no</form>": "yes yes",
        "<form class=search><article>no</article></form><div class=comments><article>no</article></div>": "",
        "<nav><form><article>no</article></form></nav><form><aside><article>no</article></aside></form>": "",
    }
    for page, text in kept.items():
        assert " ".join(x.text for x in html_extract.lines_of(page) if not x.template) == text, page


def test_result_does_not_depend_on_partitions(spark):
    rows = [(i, f"http://h{i % 3}.org/{i % 7}/{i}", plain(f"<p>text {i}</p>")) for i in range(60)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    for n in ("1", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found.append(texts(html_extract.extract(pages(spark, rows))))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found[0] == found[1] == {(i, u): f"text {i}" for i, u, _ in rows}


def test_common_subsequence_is_longest():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 14))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        found = sorted(html_extract.common(a, b))
        rest = iter(b)
        assert len(found) == best[-1][-1]
        assert all(any(y == a[i] for y in rest) for i in found)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 0.5, "b") for i, v in rows], "vec_id long, embedding array<float>, id int, distance double, block string")


def brute_nearest(rows, step, k=10):
    kept = {(i, tuple(v)) for i, v in rows if i is not None and v and len(v) == 8 and None not in v and np.isfinite(v).all() and any(v)}
    out = {}
    for i, v in kept:
        if i % step == 0:
            order = sorted((float(np.sqrt(((np.float64(np.float32(v)) - np.float64(np.float32(w))) ** 2).sum())), j) for j, w in kept if j != i)
            out[i] = [j for _, j in order[:k]], [d for d, _ in order[:k]]
    return out


def test_small_tables_are_searched_exactly(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in np.float32(rng.normal(size=8))]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(40)] + [(2000, rows[7][1]), (7, rows[7][1])]
    rows += [(500, None), (501, [0.0] * 8), (502, [float("nan")] * 8), (503, [1.0] * 7 + [None]), (504, [float("inf")] * 8), (505, [1.0] * 9), (None, rows[0][1])]
    found = ann.search(vectors(spark, rows), F.col("vec_id") % 20 == 0)
    got = {}
    for r in sorted(found.collect()):
        got.setdefault(r["query_id"], ([], []))
        assert r["rank"] == len(got[r["query_id"]][0]) + 1
        got[r["query_id"]][0].append(r["vec_id"])
        got[r["query_id"]][1].append(r["score"])
    want = brute_nearest(rows, 20)
    assert got.keys() == want.keys()
    for q in want:
        assert got[q][0] == want[q][0]
        assert got[q][1] == pytest.approx(want[q][1], rel=1e-12)
    few = ann.search(vectors(spark, rows[:4]), F.col("vec_id") == 0).collect()
    assert [r["rank"] for r in sorted(few)] == [1, 2, 3]
    assert ann.search(vectors(spark, []), F.col("vec_id") == 0).collect() == []


def test_one_id_under_several_vectors(spark):
    """Each vector is indexed and asked by itself, at its own distance."""
    rng = np.random.default_rng(8)
    rows = [(int(i), [float(x) for x in np.float32(rng.normal(size=8))]) for i in range(60)]
    again = [[float(x) for x in np.float32(rng.normal(size=8))] for _ in range(4)]
    rows += [(0, again[0]), (0, again[1]), (5, again[2]), (30, again[3]), (77, again[2])]
    got = {}
    for r in sorted(ann.search(vectors(spark, rows), F.col("vec_id") % 20 == 0).collect()):
        got.setdefault((r["query_id"], r["rank"]), []).append((r["vec_id"], r["score"]))
    want = {}
    for q, v in rows:
        if q % 20 == 0:
            order = sorted((float(np.sqrt(((np.float64(v) - np.float64(w)) ** 2).sum())), j) for j, w in rows if j != q)
            for rank, (d, j) in enumerate(order[:10], 1):
                want.setdefault((q, rank), []).append((j, pytest.approx(d, rel=1e-12)))
    assert got.keys() == want.keys()
    for place, found in got.items():
        assert found == sorted(want[place], key=lambda x: (x[0], x[1].expected)), place


def test_recall_on_scattered_vectors(spark):
    """Vectors without any clusters, the hardest case; the leaves opened hold a part of them only."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(12_000, 32))
    x = np.float32(x / np.linalg.norm(x, axis=1, keepdims=True))
    frame = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in ann.search(frame, F.col("vec_id") % 200 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    right = 0
    for q, found in got.items():
        d = ((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1)
        d[q] = np.inf
        right += len(found & set(np.argsort(d, kind="stable")[:10].tolist()))
    assert len(got) == 60
    assert right / 600 >= 0.9


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, "x") for i, t, lang in rows], "doc_id long, text string, lang string, score string")


@pytest.fixture(scope="module")
def told():
    """Documents of which some hold an offensive word in one sentence, in forms that share a stem."""
    rng = random.Random(12)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(300)]
    rows, labels = [], []
    for i in range(900):
        sentences = [" ".join(rng.choice(vocabulary) for _ in range(8)) for _ in range(rng.randint(1, 12))]
        toxic = i % 5 == 0
        if toxic:
            at = rng.randrange(len(sentences))
            sentences[at] += " " + rng.choice(["zorkest", "zorkig", "zorkum", "blarg"])
        rows.append((i, ". ".join(sentences) + ".", "en"))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_documents(spark, told):
    rows, labels = told
    labels = [*labels, (None, 1, 1), (5, 1, None), (5, 1, 1)]
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(documents(spark, rows), marked)
    extra = [(5000, None, "en"), (5001, "", "en"), (None, "Zorkiges here. fine words.", "en"), (5002, "... !!! \n", "en"), (5003, "fine " * 100_000, "en")]
    found = {r["doc_id"]: r for r in toxicity.score(documents(spark, rows + extra), model).collect()}
    assert len(found) == len(rows) + len(extra)
    assert all(0 <= r["score"] <= 1 for r in found.values())
    held = [i for i, *_ in rows if zlib_mod(i) == 1]
    right = sum((found[i]["score"] >= toxicity.THRESHOLD) == (i % 5 == 0) for i in held)
    assert right / len(held) >= 0.97
    # The offending sentence is found, not its neighbours.
    for i in held:
        if i % 5 == 0 and found[i]["offending"]:
            text = rows[i][1]
            assert all(any(w in text[s["start"] : s["end"]] for w in ("zork", "blarg")) for s in found[i]["offending"])
    assert found[None]["score"] >= toxicity.THRESHOLD
    assert found[5000]["score"] == found[5001]["score"] == found[5002]["score"] == 0
    kept = toxicity.keep_civil(documents(spark, rows + extra), model)
    assert kept.columns == ["doc_id", "text", "lang", "score"]
    expected = {i for i, r in found.items() if r["score"] < toxicity.THRESHOLD}
    assert {r["doc_id"] for r in kept.collect()} == expected
    nothing = toxicity.train(documents(spark, rows), marked.where("doc_id < 0"))
    assert {r["score"] for r in toxicity.score(documents(spark, rows[:3]), nothing).collect()} == {0.0}


def zlib_mod(doc_id):
    import zlib

    return zlib.crc32(str(doc_id).encode()) % 3


def test_languages_on_held_out_documents(spark, sf_dir):
    table = pq.read_table(f"{sf_dir}/documents.parquet").select(["doc_id", "text", "lang"]).to_pylist()
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in table]
    rows += [(9000, "hello", None), (9001, None, "en"), (9002, "123 ... ½ ²", "de"), (9003, "", None), (None, rows[0][1], rows[0][2])]
    docs = documents(spark, rows)
    codes = language.train(docs)
    found = {r["doc_id"]: r for r in language.identify(docs, codes).collect()}
    assert len(found) == len(rows)
    held = [(i, lang) for i, text, lang in rows if i is not None and zlib_mod(i) == 1 and lang and text and i < 9000]
    assert np.mean([found[i]["lang_pred"] == lang for i, lang in held]) >= 0.95
    for i in (9001, 9002, 9003):
        assert (found[i]["lang_pred"], found[i]["score"]) == ("und", 0.0)
    assert all(0 <= r["score"] <= 1 for r in found.values())
    none = language.train(docs.where("lang is null"))
    assert {r["lang_pred"] for r in language.identify(docs, none).collect()} == {"und"}
    one = language.train(docs.where("lang = 'en'"))
    assert Counter(r["lang_pred"] for r in language.identify(docs.where("doc_id < 20"), one).collect()).keys() == {"en"}


def test_every_language_is_learned(spark):
    """More than 64 languages, of which the rare ones get their own label too."""
    rng = random.Random(21)
    rows = []
    for n in range(80):
        letters = rng.sample("abcdefghijklmnopqrstuvwxyz", 5)
        for _ in range(12 if n < 70 else 6):
            rows.append((len(rows), " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(40)), f"l{n:02}"))
    docs = documents(spark, rows)
    codes = language.train(docs)
    assert codes.languages == tuple(sorted({lang for *_, lang in rows}))
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs, codes).collect()}
    held = [(i, lang) for i, _, lang in rows if zlib_mod(i) == 1]
    assert np.mean([found[i] == lang for i, lang in held]) >= 0.95
    few = language.train(docs, total=160)
    assert few.languages == codes.languages


@pytest.mark.parametrize("n", [2, 4, 6, 7, 20])
def test_codewords_tell_languages_apart(n):
    code = language.codewords(n)
    distance = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
    assert min(distance) >= (1 if n == 2 else 2)
    # No bit is the same for all languages.
    assert (np.abs(code.sum(axis=0)) < n).all()
