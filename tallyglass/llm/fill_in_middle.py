"""Fill-in-middle transformation: each document is cut at two line ends and its parts are put in another order.

A line count comes from ``regexp_count``. The cuts are written into a pattern of the row's own, ``(unit{a})(unit{b-a})(rest)``, so that one
match finds prefix, middle and suffix, and the replacement string of the same call puts them in order. The counted groups are
possessive: they are matched in a loop, without a stack of places to come back to, so texts of any number of lines are cut.
Everything is one projection of Spark's own functions; nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: A line with its end, or what follows the last end.
UNIT = r"[^\n]*\n|[^\n]+"
#: The same, never given back once matched.
_UNIT = r"(?:[^\n]*+\n|[^\n]++)"


@dataclass(frozen=True)
class Rates:
    """``fim`` of a hundred documents are cut, ``spm`` of a hundred cut ones are written suffix first; ``seed`` draws them."""

    seed: int = 7
    fim: int = 100
    spm: int = 50


def _draws(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the hash of seed and id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digest = F.sha2(key.cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def transform(docs: DataFrame, rates: Rates = Rates(), carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, text, n, form, output``, then the columns of ``carry``: one row per row of ``docs``.

    ``form`` is ``psm`` (prefix, suffix, middle), ``spm`` (suffix, prefix, middle) or ``plain``: an empty text, one that holds a
    marker itself, and one that was not drawn stay as they are. A null text is empty. A null ``doc_id`` draws as the
    empty string; rows that repeat a ``doc_id`` draw alike. Columns that are not carried are ignored, whatever their
    names, and so is the order of rows; an empty table gives an empty result.
    """
    h1, h2, h3, h4 = _draws(F.col("doc_id"), rates.seed)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # Columns get names of their own on the way, so that carried ones cannot clash.
    rows = docs.select(
        F.col("doc_id").cast("long").alias("__doc_id"),
        text.alias("__text"),
        F.regexp_count(text, F.lit(UNIT)).cast("long").alias("__n"),
        *(d.alias(f"__h{i}") for i, d in enumerate((h1, h2, h3, h4), 1)),
        *(F.col(f"`{c}`").alias(f"__carry_{i}") for i, c in enumerate(carry)),
    )
    n, subject = F.col("__n"), F.col("__text")
    first, second = (F.col(c) % (n + 1) for c in ("__h1", "__h2"))
    a, b = F.least(first, second), F.greatest(first, second)
    marked = subject.contains(PREFIX) | subject.contains(SUFFIX) | subject.contains(MIDDLE)
    plain = (subject == "") | marked | (F.col("__h3") % 100 >= rates.fim)
    form = F.when(plain, "plain").when(F.col("__h4") % 100 < rates.spm, "spm").otherwise("psm")
    carried = [F.col(f"__carry_{i}") for i in range(len(carry))]
    cut = rows.select(
        "__doc_id",
        "__text",
        "__n",
        form.alias("__form"),
        F.concat(
            F.lit(rf"\A({_UNIT}{{"), a, F.lit(rf"}}+)({_UNIT}{{"), b - a, F.lit(r"}+)((?s:.*+))\z")
        ).alias("__pattern"),
        *carried,
    )
    order = F.when(F.col("__form") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    moved = F.regexp_replace(subject, F.col("__pattern"), order)
    whole = cut.select(
        F.col("__doc_id").alias("doc_id"),
        subject.alias("text"),
        n.alias("n"),
        F.col("__form").alias("form"),
        F.when(F.col("__form") == "plain", subject).otherwise(moved).alias("output"),
        *carried,
    )
    return whole.toDF("doc_id", "text", "n", "form", "output", *carry)


def parts(form: Column, output: Column) -> tuple[Column, Column, Column]:
    """Prefix, middle and suffix of an output, null for the plain form.

    Cut texts hold no marker, and no marker can begin in a part and end in another, so each is found where it was put.
    """

    def between(start: str, end: str) -> Column:
        return F.substring_index(F.substring_index(output, start, -1), end, 1)

    cut = form != "plain"
    prefix = F.when(form == "psm", between(PREFIX, SUFFIX)).when(form == "spm", between(PREFIX, MIDDLE))
    suffix = F.when(form == "psm", between(SUFFIX, MIDDLE)).when(form == "spm", between(SUFFIX, PREFIX))
    return prefix, F.when(cut, F.substring_index(output, MIDDLE, -1)), suffix


def restore(form: Column, output: Column) -> Column:
    """The text an output was made from."""
    prefix, middle, suffix = parts(form, output)
    return F.when(form == "plain", output).otherwise(F.concat(prefix, middle, suffix))
