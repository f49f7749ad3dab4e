"""Commits of several writers, damaged models, one-pass streams, repeated batches, duplicates, compaction."""

import datetime as dt
import glob
import json
import os
import warnings
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tallyglass.config import Settings
from tallyglass.operators.model import load_model, model_info, save_model, train_model
from tallyglass.plans.queries import formula_scorer
from tallyglass.session import scratch_path
from tallyglass.sinks import commits
from tallyglass.sinks.compaction import compact, vacuum
from tallyglass.sinks.tables import save_snapshot
from tallyglass.sources.predictions import committed_folders, read_predictions
from tallyglass.sources.snapshots import commits as snapshot_commits
from tallyglass.sources.snapshots import read_snapshot
from tallyglass.streaming.scoring import (
    VERDICT_SCHEMA,
    Dedup,
    judged_requests,
    parse_documents,
    read_rejects,
    read_requests,
    rejected,
    start_two_sinks,
    write_batch,
)

AS_OF = dt.date(2024, 1, 30)
NOW = dt.datetime(2024, 1, 30, 12)
SETTINGS = Settings(as_of=AS_OF)
GOOD = {
    "user_id": "u1", "stock_id": "AAPL", "close_price": 150.25, "open_price": 148.5, "high_price": 151.1, "low_price": 147.9, "volume": 75,
    "avg_volume_30d": 80, "sector": "Technology", "market_cap_category": "Large", "day_of_week": "Monday", "days_since_last_purchase": 5,
    "portfolio_diversity_score": 0.75, "risk_tolerance": 0.8,
}


def write(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as f:
        f.write("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")


def request(user, **changes):
    return GOOD | {"user_id": user} | changes


def run(spark, root, dedup=None, files=1000):
    arriving = read_requests(spark, f"{root}/in", files_per_batch=files, dedup=dedup)
    query = start_two_sinks(judged_requests(arriving, formula_scorer, 0.5, SETTINGS, NOW, dedup), f"{root}/out", f"{root}/ck")
    query.awaitTermination()
    return query


def forget_batch(root, number):
    """Take a batch out of the checkpoint, so that the stream runs it again."""
    for name in (f"{number}", f".{number}.crc"):
        os.remove(f"{root}/ck/commits/{name}")


def users(spark, root):
    return sorted(r.user_id for r in read_predictions(spark, [f"{root}/out"], AS_OF).collect())


# --- commits ---


def test_writers_at_a_time_get_numbers_of_their_own(spark):
    root = scratch_path(spark, "commits")
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda i: commits.append(spark, root, {"writer": i}), range(40)))
    assert sorted(numbers) == list(range(1, 41)) and commits.last_number(spark, root) == 40
    rows = spark.read.json(root).collect()
    assert {(r.number, r.writer) for r in rows} == set(zip(numbers, range(40)))
    assert not commits.create(spark, root, f"{7:012d}", {"writer": "late"}) and spark.read.json(root).count() == 40
    assert not [f for f in os.listdir(root) if "-" in f and not f.endswith(".crc")]


def test_snapshots_written_at_a_time(spark):
    root = scratch_path(spark, "snapshots")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: save_snapshot(spark.range(n), root, "20240130_000000"), range(3, 7)))
    known = snapshot_commits(spark, root).collect()
    assert sorted(r.number for r in known) == [1, 2, 3, 4]
    newest = max(known, key=lambda r: r.number)
    assert read_snapshot(spark, root).count() == newest.rows


@pytest.fixture(scope="module")
def models(spark):
    """Three versions below one root, one below another."""
    rows = spark.range(300).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 2).cast("int").alias("y"))
    settings = Settings(feature_columns=("a",), numerical_columns=(), label_column="y", key_columns=("id",), boosting_rounds=1, max_depth=1, booster="gbtree")
    path = scratch_path(spark, "rows")
    rows.write.parquet(path)
    model = train_model(spark.read.parquet(path), settings)
    root, other = scratch_path(spark, "models"), scratch_path(spark, "fallback")
    assert [save_model(spark, replace(model, threshold=t, info=model.info | {"threshold": t}), root) for t in (0.1, 0.2, 0.3)] == [1, 2, 3]
    save_model(spark, replace(model, info=model.info | {"threshold": 0.9}), other)
    return root, other


def test_damaged_models_are_passed_over(spark, models):
    root, other = models
    assert load_model(spark, root, other).threshold == 0.3 and model_info(spark, root).first().number == 3
    folders = {r.number: f"{root}/{r.folder}" for r in spark.read.json(f"{root}/info").collect()}
    part = next(f for f in sorted(glob.glob(f"{folders[3]}/stages/*/metadata/part-*")))
    os.remove(part)
    with pytest.warns(UserWarning, match="model 3 below"):
        found = load_model(spark, root, other)
    assert found.threshold == 0.2 and found.info["passed_over"] == [f"{root}#3"]
    part = next(f for f in sorted(glob.glob(f"{folders[2]}/stages/*/metadata/part-*")))
    os.remove(f"{os.path.dirname(part)}/.{os.path.basename(part)}.crc")
    with open(part, "a") as f:
        f.write(" ")
    for f in glob.glob(f"{folders[1]}/metadata/part-*"):
        os.remove(f)
    with pytest.warns(UserWarning):
        found = load_model(spark, root, f"{root}-none", other)
        assert (found.threshold, found.info["root"], len(found.info["passed_over"])) == (0.9, other, 3)
        assert load_model(spark, root) is None
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        assert load_model(spark, f"{root}-none") is None and load_model(spark, other).info["passed_over"] == []


# --- documents ---


def test_documents_are_read_element_by_element(spark):
    good = json.dumps(GOOD)
    wrong = json.dumps(GOOD | {"volume": "many"})
    less = json.dumps({k: v for k, v in GOOD.items() if k not in ("sector", "volume")})
    lines = [
        good, f'{{"features": [{good}, {wrong}, {less}, null, 17, "x", [], {good}]}}', f"[{good}, {{}}]", '{"features": []}', "[]", "  ",
        "no json", '{"features": 5}', "[1, {", "null", '{"features": [' + good,
    ]
    rows = parse_documents(spark.createDataFrame([(x,) for x in lines], "value string"))
    kept = rows.where("_corrupt_record IS NULL AND user_id = 'u1' AND sector IS NOT NULL AND volume = 75")
    assert sorted(r.position if r.position is not None else -1 for r in kept.collect()) == [-1, 0, 0, 7]
    bad = [(r.reason, r.record) for r in rejected(rows).collect()]
    reasons = [reason for reason, _ in bad]
    missing = [r for r in reasons if r.startswith("missing")]
    assert sorted(missing, key=len)[0] == "missing volume,sector" and len(missing) == 2
    # The wrong type, null, 17, "x" and []; the text, a number for a list, two cut documents, and null.
    assert reasons.count("malformed") == 10 and len(bad) == 12
    assert "no json" in {record for _, record in bad}


# --- one pass ---


def test_one_pass_serves_both_sinks_and_batches_are_written_once(spark):
    root = scratch_path(spark, "stream")
    write(f"{root}/in", "1", [request("a"), "junk", {"features": [request("b"), 3]}])
    write(f"{root}/in", "2", [request("c")])
    query = run(spark, root, files=1)
    assert sum(p.numInputRows for p in query.recentProgress) == 4
    assert users(spark, root) == ["a", "b", "c"]
    assert sorted((r.record, r.reason, r.position) for r in read_rejects(spark, f"{root}/out").collect()) == [("3", "malformed", 1), ("junk", "malformed", None)]
    write(f"{root}/in", "3", [request("d"), "more"])
    run(spark, root)
    assert users(spark, root) == ["a", "b", "c", "d"]
    # The last batch is lost from the checkpoint, as if the job had died after writing it.
    forget_batch(root, 2)
    before = sorted(glob.glob(f"{root}/out/rows/*"))
    run(spark, root)
    assert users(spark, root) == ["a", "b", "c", "d"] and sorted(glob.glob(f"{root}/out/rows/*")) == before
    # And as if it had died between writing and committing it.
    os.remove(max(glob.glob(f"{root}/out/commits/*/*.json")))
    forget_batch(root, 2)
    assert users(spark, root) == ["a", "b", "c"]
    run(spark, root)
    assert users(spark, root) == ["a", "b", "c", "d"] and read_rejects(spark, f"{root}/out").count() == 3
    assert len(glob.glob(f"{root}/out/rows/*")) == len(before) + 1
    assert read_predictions(spark, [f"{root}/out"], dt.date(2024, 3, 1)).count() == 0


def test_a_repeated_batch_is_not_evaluated(spark):
    root = scratch_path(spark, "batch")
    rows = spark.createDataFrame([("a", "AAPL", 0.5, 1, NOW, "1", AS_OF, None, None, None, True)], VERDICT_SCHEMA)
    assert write_batch(rows, root, 5, "s") and not write_batch(rows.withColumn("user_id", F.raise_error("evaluated")), root, 5, "s")
    assert write_batch(rows, root, 5, "another stream") and write_batch(rows.limit(0), root, 6, "s")
    assert read_predictions(spark, [root], AS_OF).count() == 2 and len(committed_folders(spark, root)) == 2


# --- duplicates ---


def test_repeated_requests_are_scored_once_and_none_vanishes(spark):
    root, dedup = scratch_path(spark, "dedup"), Dedup(delay=dt.timedelta(hours=6), skew=dt.timedelta(hours=1))

    def sent(user, key, hours):
        return request(user, request_id=key, requested_at=(NOW - dt.timedelta(hours=hours)).isoformat())

    write(f"{root}/in", "1", [sent("a", "k1", 0), sent("b", "k2", 5), sent("a", "k1", 0), sent("late", "k3", 7), "junk", "junk"])
    write(f"{root}/in", "2", [sent("a", "k1", 0), sent("ahead", "k4", -2), sent("soon", "k5", -0.5), sent("old", "k6", 5.9)])
    run(spark, root, dedup, files=1)
    # After a restart: a repeat, one out of order, one without an id, one with the id of a rejected request.
    write(f"{root}/in", "3", [sent("b", "k2", 5), sent("c", "k7", 4), request("none"), sent("c", "k3", 1)])
    run(spark, root, dedup)
    assert users(spark, root) == ["a", "b", "c", "c", "old", "soon"]
    reasons = sorted(r.reason for r in read_rejects(spark, f"{root}/out").collect())
    assert reasons == ["ahead of time", "late", "malformed", "malformed", "missing request_id,requested_at"]
    batch = spark.createDataFrame([(json.dumps(x),) for x in (sent("a", "k1", 0), sent("a", "k1", 2), sent("b", "k2", 0), sent("x", "k9", 8))], "value string")
    fields = read_requests(spark, f"{root}/in", dedup=dedup).schema
    known = parse_documents(batch, type(VERDICT_SCHEMA)([f for f in fields if f.name not in ("_corrupt_record", "position")]))
    judged = judged_requests(known, formula_scorer, 0.5, SETTINGS, NOW, dedup).collect()
    assert sorted((r.user_id or "", r.reason or "") for r in judged) == [("", "late"), ("a", ""), ("b", "")]


# --- compaction ---


def test_compaction_keeps_every_row_once(spark):
    root = scratch_path(spark, "stream")
    for i in range(5):
        write(f"{root}/in", str(i), [*(request(f"u{i}-{j}") for j in range(4)), "junk"])
    run(spark, root, files=1)
    out = f"{root}/out"
    every = users(spark, root)
    reading = read_predictions(spark, [out], AS_OF)
    assert len(every) == 20 and compact(spark, out, "2024-01-29", VERDICT_SCHEMA) is None
    assert compact(spark, out, "2024-01-30", VERDICT_SCHEMA) == 5
    assert reading.count() == 20 and users(spark, root) == every and read_rejects(spark, out).count() == 5
    assert len(committed_folders(spark, out)) == 1 and compact(spark, out, "2024-01-30", VERDICT_SCHEMA) is None
    write(f"{root}/in", "5", [request("new")])
    run(spark, root)
    with ThreadPoolExecutor(2) as pool:
        done = list(pool.map(lambda _: compact(spark, out, "2024-01-30", VERDICT_SCHEMA), range(2)))
    assert sorted(done, key=str) in ([2, None], [2, 2]) and users(spark, root) == sorted([*every, "new"])
    assert vacuum(spark, out) >= 6 and vacuum(spark, out) == 0
    assert users(spark, root) == sorted([*every, "new"]) and read_rejects(spark, out).count() == 5
    assert len(read_predictions(spark, [out], AS_OF).inputFiles()) < 5
