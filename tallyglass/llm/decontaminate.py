"""Benchmark passages in documents: a prefix-filtered set join, in DataFrame operations only.

A window of an item is seen as the set of its shingles (five consecutive words). For a window to lie in a
document all its shingles must, so its *rarest* shingle is a sufficient prefix to look for:

1. places where a document has any shingle of the benchmark (the one pass over all words);
2. shingles ordered by how often they occur there; the rarest of each window is its prefix;
3. places of prefixes give candidate starts; starts before the text or ends behind it are ruled out
   (position and length bounds);
4. the words at each candidate start are compared with the window's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyglass.llm.rows import identified, join_rows, small, stored

WINDOW = 10
SHINGLE = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_OTHER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Runs of digits, letters and characters beyond ASCII; A-Z lower-cased. Null has none."""
    text = text.cast("string")
    lowered = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.filter(F.split(F.coalesce(lowered, F.lit("")), _OTHER), lambda w: w != "")


def _shingles(words: str, size: Column | int) -> Column:
    """``at`` (from 1) and ``shingle`` of each run of ``size`` words."""
    return F.transform(
        F.sequence(F.lit(1), F.size(words) - size + 1),
        lambda i: F.struct(i.cast("int").alias("at"), F.xxhash64(F.slice(words, i, size)).alias("shingle")),
    )


def item_windows(benchmark: DataFrame, window: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """The distinct windows (``window_id, words``) and which items have them (``window_id, item_id``)."""
    words = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where("item_id is not null and size(words) > 0")
    size = F.least(F.lit(window), F.size("words"))
    of_item = words.select(
        "item_id",
        F.explode(
            F.transform(F.sequence(F.lit(1), F.size("words") - size + 1), lambda i: F.slice("words", i, size))
        ).alias("words"),
    ).select("item_id", "words", F.sha2(F.concat_ws(" ", "words"), 256).alias("window_id"))
    of_item = stored(of_item, "item-windows")
    windows = of_item.groupBy("window_id").agg(F.first("words").alias("words")).select(
        "window_id", "words", F.least(F.lit(shingle), F.size("words")).alias("size")
    )
    return stored(windows, "windows"), of_item.select("window_id", "item_id").distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, n_words, n_hit, item_ids``, one row per row of ``docs``.

    A word is hit if it lies in any occurrence of a window: ``window`` consecutive words of an item, or all
    words of a shorter one. ``item_ids`` holds the ids of occurring items as strings, sorted.

    Null and empty texts have no words and are never hit; items without words or without an id take no part.
    Items that repeat an id are one item with the windows of all. Rows equal in ``doc_id`` and text get equal
    results. An empty table on either side is allowed. Extra columns are ignored, whatever their names.
    """
    return _judged(docs, benchmark, window, shingle).drop("text_hash")


def _judged(docs: DataFrame, benchmark: DataFrame, window: int, shingle: int) -> DataFrame:
    rows = identified(docs)
    windows, items = item_windows(benchmark, window, shingle)
    tokens = stored(
        windows.select("window_id", "size", F.explode(_shingles("words", F.col("size"))).alias("s")).select(
            "window_id", "size", "s.*"
        ),
        "window-shingles",
    )
    # At most ``shingle`` rows: windows shorter than a shingle are looked for by all their words.
    sizes = [r[0] for r in tokens.select("size").distinct().collect()]
    wanted = small(tokens.select("size", "shingle").distinct())
    words = rows.select("doc_id", "text_hash", words_of(F.col("text")).alias("words"))
    found = []
    for size in sizes:
        places = (
            words.where(F.size("words") >= size)
            .select("doc_id", "text_hash", F.size("words").alias("n_words"), F.explode(_shingles("words", size)).alias("s"))
            .select("doc_id", "text_hash", "n_words", "s.*")
        )
        found.append(places.join(wanted.where(F.col("size") == size), "shingle").select("doc_id", "text_hash", "n_words", "at", "size", "shingle"))
    if not found:
        return rows.select(
            "doc_id", "text_hash", F.size(words_of(F.col("text"))).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
            F.array().cast("array<string>").alias("item_ids"),
        )
    places = found[0]
    for more in found[1:]:
        places = places.unionByName(more)
    places = stored(places, "shingle-places")

    often = places.groupBy("size", "shingle").agg(F.count(F.lit(1)).alias("times"))
    prefixes = (
        tokens.join(often, ["size", "shingle"], "left")
        .groupBy("window_id")
        .agg(F.min(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "shingle", "at", "size")).alias("p"))
        .where("p.times > 0")
        .select("window_id", "p.shingle", "p.size", F.col("p.at").alias("offset"))
        .join(windows.select("window_id", "words"), "window_id")
    )
    prefixes = small(stored(prefixes, "prefixes"))
    candidates = (
        places.join(prefixes, ["size", "shingle"])
        .withColumn("start", F.col("at") - F.col("offset") + 1)
        .where((F.col("start") >= 1) & (F.col("start") + F.size("words") - 1 <= F.col("n_words")))
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("start", "window_id", "words")).alias("candidates"))
    )
    candidates = stored(candidates, "candidates")
    verified = (
        join_rows(rows, candidates, "left")
        .select("doc_id", "text_hash", words_of(F.col("text")).alias("words"), "candidates")
        .select(
            "doc_id", "text_hash", F.size("words").cast("long").alias("n_words"),
            F.filter("candidates", lambda c: F.slice("words", c["start"], F.size(c["words"])) == c["words"]).alias("hits"),
        )
        .select(
            "doc_id", "text_hash", "n_words",
            F.coalesce(
                F.size(
                    F.array_distinct(
                        F.flatten(F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + F.size(h["words"]) - 1)))
                    )
                ),
                F.lit(0),
            ).cast("long").alias("n_hit"),
            F.array_distinct(F.transform("hits", lambda h: h["window_id"])).alias("windows"),
        )
    )
    verified = stored(verified, "verified")
    hit_items = (
        verified.where("n_hit > 0")
        .select("doc_id", "text_hash", F.explode("windows").alias("window_id"))
        .join(items, "window_id")
        .groupBy("doc_id", "text_hash")
        .agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    )
    return join_rows(verified, hit_items, "left").select(
        "doc_id", "text_hash", "n_words", "n_hit", F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids")
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """The documents without any occurrence of a window, with all their columns; each row is judged by its own text."""
    hit = _judged(docs, benchmark, window, shingle).where("n_hit > 0")
    hit = hit.select(F.col("doc_id").alias("__doc_id"), F.col("text_hash").alias("__text_hash")).distinct()
    same = docs["doc_id"].eqNullSafe(hit["__doc_id"]) & (F.xxhash64(docs["text"].cast("string")) == hit["__text_hash"])
    return docs.join(hit, same, "left_anti")
