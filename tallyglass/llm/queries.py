"""The registered queries over the text, page and vector tables, and their SQL equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tallyglass.llm import (
    ann,
    credentials,
    decontaminate,
    fill_in_middle,
    html_extract,
    language,
    line_dedup,
    packing,
    quality,
    resample,
    simhash,
    substring_dedup,
    toxicity,
)
from tallyglass.llm.rows import table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.classes(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.remove_lines(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        "offending",
    )


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    spans = credentials.scan(docs, credentials.learn(docs)).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["kind"] != credentials.LEARNED)

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        # A function of one argument: a second one would be the element's index.
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in credentials.KINDS]
    return spans.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.train(docs)).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous"
    )


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_in_middle.transform(table(spark, sf_dir, "documents"))
    form, output = F.col("form"), F.col("output")
    prefix, middle, _ = fill_in_middle.parts(form, output)
    digests = {"output_sha256": output, "restored_sha256": fill_in_middle.restore(form, output)}
    return rows.select(
        "doc_id",
        "n",
        "form",
        F.length(prefix).cast("long").alias("prefix_chars"),
        F.length(middle).cast("long").alias("middle_chars"),
        *(F.sha2(x.cast("binary"), 256).alias(name) for name, x in digests.items()),
    )


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_html_extraction": op2_html_extraction,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_line_dedup": op5_line_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_secret_scan": op8_secret_scan,
    "op9_language": op9_language,
    "op10_nearest_neighbours": op10_nearest_neighbours,
    "op11_quality_classifier": op11_quality_classifier,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_fill_in_middle": op13_fill_in_middle,
    "pipeline": corpus_pipeline.run,
}

_OP1 = r"""
with words as materialized (
    select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
    from documents),
windows as materialized (
    select doc_id, i, sha256(array_to_string(w[i : i + 34], ' ')) as h
    from (select doc_id, w, unnest(range(1, len(w) - 33)) as i from words where len(w) >= 35)),
repeated as (select h from windows group by h having count(*) > 1),
gone as (
    select doc_id, list(distinct p) as ps
    from (select doc_id, unnest(range(i, i + 35)) as p from windows join repeated using (h))
    group by doc_id)
select words.doc_id, len(w)::bigint as n_words, coalesce(len(ps), 0)::bigint as n_removed,
       sha256(coalesce(array_to_string(
           case when ps is null then w
                else list_filter(list_transform(w, lambda x, i: case when list_contains(ps, i) then null else x end),
                                 lambda x: x is not null) end, ' '), '')) as kept_sha256
from words left join gone on words.doc_id is not distinct from gone.doc_id
"""

_OP4 = r"""
with doc_words as materialized (
    select doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
    from documents),
item_words as (
    select item_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
    from benchmark where item_id is not null),
windows as (
    select distinct item_id, least(10, len(w)) as n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') as t
    from (select item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i from item_words where len(w) > 0)),
places as (
    select doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') as t
    from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i
          from doc_words cross join (select distinct n from windows) where len(w) >= n)),
hits as (select distinct doc_id, item_id, p.n, i from places p join windows using (n, t)),
per_doc as (
    select doc_id, count(distinct q) as n_hit
    from (select doc_id, unnest(range(i, i + n)) as q from hits) group by doc_id),
items as (
    select doc_id, count(*) as n_items, string_agg(s, ',' order by s) as ids
    from (select distinct doc_id, item_id::varchar as s from hits) group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc_words d left join per_doc using (doc_id) left join items using (doc_id)
"""

_OP5 = r"""
with docs as materialized (select doc_id, string_split(text, chr(10)) as l, text from documents),
windows as materialized (
    select doc_id, i, l[i : i + 2] as t
    from (select doc_id, l, unnest(range(1, len(l) - 1)) as i from docs where len(l) >= 3)),
later as (
    select doc_id, i from (
        select doc_id, i, row_number() over (partition by t order by doc_id, i) as n from windows) where n > 1),
gone as (select doc_id, list(distinct p) as ps from (select doc_id, unnest(range(i, i + 3)) as p from later) group by doc_id)
select docs.doc_id, coalesce(len(l), 0)::bigint as n_lines, coalesce(len(ps), 0)::bigint as n_removed,
       sha256(case when ps is null then text
                   else array_to_string(list_filter(
                       list_transform(l, lambda x, i: case when list_contains(ps, i) then null else x end),
                       lambda x: x is not null), chr(10)) end) as kept_sha256
from docs left join gone on docs.doc_id is not distinct from gone.doc_id
"""

# DuckDB has no CRC: the table of all byte remainders is made by the rule, and each distinct word is folded over it.
_OP12 = r"""
with recursive steps(i, k, c) as (
    select i::bigint, 0, i::bigint from range(256) t(i)
    union all
    select i, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from steps where k < 8),
crcs as materialized (select list(c order by i) as r from steps where k = 8),
doc_words as materialized (
    select doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
    from documents),
doc_counts as materialized (select doc_id, t, count(*) as n from (select doc_id, unnest(w) as t from doc_words) group by all),
item_counts as materialized (
    select t, count(*) as n from (
        select unnest(list_filter(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')) as t from benchmark) group by t),
buckets as materialized (
    select t, xor(list_reduce(
        list_transform(range(1, length(x), 2), lambda i: ('0x' || x[i : i + 1])::bigint),
        lambda a, b: xor(a >> 8, r[xor(a & 255, b) + 1]), 4294967295), 4294967295) % 10000 as bucket
    from (select t, hex(encode(t)) as x from (select t from doc_counts union select t from item_counts)), crcs),
bucket_counts as (
    select b as bucket, coalesce(s, 0) as s, coalesce(t, 0) as t
    from range(10000) every(b)
    left join (select bucket, sum(n)::bigint as s from doc_counts join buckets using (t) group by bucket) on b = bucket
    left join (select bucket as target, sum(n)::bigint as t from item_counts join buckets using (t) group by bucket) on b = target),
gains as materialized (
    select bucket, floor(1000 * ln(((t + 1)::double * (sum(s) over () + 10000)::double)
                                   / ((s + 1)::double * (sum(t) over () + 10000)::double)))::bigint as gain
    from bucket_counts),
weights as (
    select doc_id, sum(n * gain)::bigint as total, sum(n)::bigint as n
    from doc_counts join buckets using (t) join gains using (bucket) group by doc_id),
scored as (
    select d.doc_id, coalesce(n, 0) as n_features,
           case when n is null then 0 else (total - ((total % n) + n) % n) // n end as weight,
           ('0x' || sha256('2024:' || coalesce(d.doc_id::varchar, ''))[1:8])::bigint as h
    from doc_words d left join weights on d.doc_id is not distinct from weights.doc_id),
noisy as (
    select doc_id, n_features, weight, (weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296))))::bigint as score from scored),
ranked as (
    select *, case when n_features >= 20 then row_number() over (partition by n_features >= 20 order by score desc, doc_id) end as place,
           count(*) filter (where n_features >= 20) over () as eligible
    from noisy)
select doc_id, n_features::bigint as n_features, weight::bigint as weight, score,
       case when place <= 10 * eligible // 100 then place::bigint end as rank
from ranked
"""

_OP13 = r"""
with docs as (
    select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as l,
           sha256('7:' || coalesce(doc_id::varchar, '')) as h
    from documents),
draws as (
    select doc_id, text, l, len(l) as n, ('0x' || h[1:8])::ubigint as h1, ('0x' || h[9:16])::ubigint as h2,
           ('0x' || h[17:24])::ubigint as h3, ('0x' || h[25:32])::ubigint as h4
    from docs),
cuts as (
    select doc_id, text, l, n, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
           case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 100 then 'plain'
                when h4 % 100 < 50 then 'spm' else 'psm' end as form
    from draws),
parts as (
    select doc_id, text, n, form, array_to_string(l[1 : a], '') as prefix, array_to_string(l[a + 1 : b], '') as middle,
           array_to_string(l[b + 1 : n], '') as suffix
    from cuts)
select doc_id, n::bigint as n, form, case when form <> 'plain' then length(prefix)::bigint end as prefix_chars,
       case when form <> 'plain' then length(middle)::bigint end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(text) as restored_sha256
from parts
"""

ORACLES = {
    "op1_substring_dedup": _OP1,
    "op4_benchmark_decontamination": _OP4,
    "op5_line_dedup": _OP5,
    "op12_importance_resampling": _OP12,
    "op13_fill_in_middle": _OP13,
}
