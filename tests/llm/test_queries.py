"""The registered text queries on the test tables, against SQL where there is any."""

import hashlib

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tallyglass.llm.credentials import KINDS, base_spans
from tallyglass.llm.queries import ORACLES, QUERIES

COLUMNS = {
    "op1_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op2_html_extraction": ["page_id", "url", "text", "n_chars"],
    "op3_simhash_near_dedup": ["doc_id", "fingerprint", "component_id"],
    "op4_benchmark_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op5_line_dedup": ["doc_id", "n_lines", "n_removed", "kept_sha256"],
    "op6_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op7_best_fit_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op8_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op9_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op10_nearest_neighbours": ["query_id", "rank", "vec_id", "score"],
    "op11_quality_classifier": ["doc_id", "held_out", "score", "predicted"],
    "op12_importance_resampling": ["doc_id", "n_features", "weight", "score", "rank"],
    "op13_fill_in_middle": ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"],
    "pipeline": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
}


def test_every_operator_is_registered():
    assert set(QUERIES) == set(COLUMNS)
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    want = con.execute(ORACLES[name])
    order = [d[0] for d in want.description]
    found = QUERIES[name](spark, sf_dir)
    assert sorted(found.columns) == sorted(order)
    assert sorted(map(tuple, found.select(order).collect()), key=repr) == sorted(want.fetchall(), key=repr)


#: What has a row per row of a table.
SOURCES = {"op2_html_extraction": "pages"} | dict.fromkeys(
    ["op3_simhash_near_dedup", "op6_toxicity", "op8_secret_scan", "op9_language", "op11_quality_classifier"], "documents"
)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_contract_columns_come_first(spark, sf_dir, name):
    found = QUERIES[name](spark, sf_dir)
    assert found.columns[: len(COLUMNS[name])] == COLUMNS[name]
    rows = found.select(COLUMNS[name][0]).collect()
    assert rows
    if name in SOURCES:
        table = spark.read.parquet(f"{sf_dir}/{SOURCES[name]}.parquet")
        assert sorted(r[0] for r in rows) == sorted(r[0] for r in table.select(COLUMNS[name][0]).collect())


def test_secret_digests_are_those_of_the_patterns(spark, sf_dir, tmp_path):
    texts = pq.read_table(f"{sf_dir}/documents.parquet").select(["doc_id", "text"]).to_pylist()
    for i, row in enumerate(texts):
        key = hashlib.sha256(str(i).encode()).hexdigest()
        row["text"] = [None, f"é token = '{key}' {row['text']}", f"AKIA{key[:16].upper()} {key}", row["text"]][i % 4]
    pq.write_table(pa.Table.from_pylist(texts), tmp_path / "documents.parquet")
    found = {r["doc_id"]: r for r in QUERIES["op8_secret_scan"](spark, str(tmp_path)).collect()}
    assert len(found) == len(texts)
    for row in texts:
        spans, got = base_spans(row["text"] or ""), found[row["doc_id"]]
        joined = ",".join(f"{k}:{s}:{e}" for s, e, k, _ in spans)
        assert got["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [got[f"n_{k}"] for k in KINDS] == [sum(x[2] == k for x in spans) for k in KINDS]
        assert set(joined.split(",")) - {""} <= set(got["spans"].split(","))
    assert sum(r["n_assign"] for r in found.values()) > 0


def test_decontamination_runs_no_python(spark, sf_dir):
    plan = QUERIES["op4_benchmark_decontamination"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
