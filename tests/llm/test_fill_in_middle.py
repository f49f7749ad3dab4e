"""Fill-in-middle against a brute-force version, with every kind of text."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tallyglass.llm import fill_in_middle
from tallyglass.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, n long, form string, __n int, __text string, output string, `a.b` int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 2, "y", "z", 3) for i, t in rows], SCHEMA)


def brute(doc_id, text, rates):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{rates.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    a, b = sorted((h1 % (len(lines) + 1), h2 % (len(lines) + 1)))
    prefix, middle, suffix = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rates.fim:
        return doc_id, text, len(lines), "plain", text, None, None, None
    if h4 % 100 < rates.spm:
        return doc_id, text, len(lines), "spm", f"<S>{suffix}<P>{prefix}<M>{middle}", prefix, middle, suffix
    return doc_id, text, len(lines), "psm", f"<P>{prefix}<S>{suffix}<M>{middle}", prefix, middle, suffix


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    alphabet = ["a", "<", "P>", "S", ">", "M", "$1", "\\", "\n", "\n\n", "\r", " ", "é", "𝒳", " ", "(?", "\x00", "\u0085"]
    rows = [(None, None), (None, "x\ny"), (0, ""), (1, "\n"), (2, "a"), (3, "<P>"), (4, "a\n<M>b\n"), (5, "<\nP>")]
    rows += [(i, "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60)))) for i in range(10, 300)]
    rows += [(11, "another\ntext\nunder a used id"), rows[20], rows[20], (-7, "negative\nid")]
    rows += [(500, "line\n" * 200_000 + "end"), (501, "\n" * 300_000), (502, "x" * 1_000_000)]
    return rows


@pytest.mark.parametrize("rates", [fill_in_middle.Rates(), fill_in_middle.Rates(seed=3, fim=60, spm=0), fill_in_middle.Rates(fim=0)])
def test_matches_brute_force(spark, texts, rates):
    rows = fill_in_middle.transform(frame(spark, texts), rates)
    found = rows.select("*", *fill_in_middle.parts(F.col("form"), F.col("output"))).collect()
    assert sorted(map(tuple, found), key=repr) == sorted((brute(i, t, rates) for i, t in texts), key=repr)
    forms = {r["form"] for r in found}
    assert forms == ({"plain"} if not rates.fim else {"plain", "psm", "spm"} if rates.spm else {"plain", "psm"})


def test_round_trip(spark, texts):
    rows = fill_in_middle.transform(frame(spark, texts), carry=("form", "a.b"))
    assert rows.columns == ["doc_id", "text", "n", "form", "output", "form", "a.b"]
    rows = fill_in_middle.transform(frame(spark, texts))
    restored = rows.where(fill_in_middle.restore(F.col("form"), F.col("output")) == F.col("text"))
    assert restored.count() == rows.count() == len(texts)


def test_empty_table(spark):
    assert fill_in_middle.transform(frame(spark, [])).collect() == []


def test_registered_query_reads_every_row_without_a_shuffle(spark, sf_dir):
    rows = QUERIES["op13_fill_in_middle"](spark, sf_dir)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Exchange", "Python", "Arrow"))
    for row in rows.join(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id").collect():
        _, text, n, form, output, prefix, middle, _ = brute(row["doc_id"], row["text"], fill_in_middle.Rates())
        assert (row["n"], row["form"]) == (n, form)
        assert row["prefix_chars"] == (None if prefix is None else len(prefix)) and row["middle_chars"] == (None if middle is None else len(middle))
        assert row["output_sha256"] == hashlib.sha256(output.encode()).hexdigest()
        assert row["restored_sha256"] == hashlib.sha256(text.encode()).hexdigest()
