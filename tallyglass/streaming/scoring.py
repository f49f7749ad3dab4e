"""Scoring requests as they arrive.

The job is stateless unless duplicates are asked to go: rows are projected, scored and appended, without a shuffle, so it scales with
the number of input files and keeps no state that could grow. ``start_two_sinks`` reads and scores each file once for predictions and
rejects; ``start_scoring`` and ``start_rejects`` are plain file sinks, one for each.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyglass.config import Settings
from tallyglass.functions.expressions import decide, moment
from tallyglass.operators.encode import fill_missing
from tallyglass.operators.features import request_features
from tallyglass.sinks import commits
from tallyglass.sources.predictions import PREDICTION_SCHEMA, read_committed

# Names and types of a request.
REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("stock_id", T.StringType()),
        T.StructField("close_price", T.DoubleType()),
        T.StructField("open_price", T.DoubleType()),
        T.StructField("high_price", T.DoubleType()),
        T.StructField("low_price", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("avg_volume_30d", T.LongType()),
        T.StructField("sector", T.StringType()),
        T.StructField("market_cap_category", T.StringType()),
        T.StructField("day_of_week", T.StringType()),
        T.StructField("days_since_last_purchase", T.IntegerType()),
        T.StructField("portfolio_diversity_score", T.DoubleType()),
        T.StructField("risk_tolerance", T.DoubleType()),
    ]
)

# What a JSON reader could not read as a request, whole.
CORRUPT = "_corrupt_record"

# The place of a request in its document, from 0; null for a document that is one request.
POSITION = "position"

Scorer = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Dedup:
    """Requests that repeat a ``request_id`` within ``delay`` are scored once.

    Requests then carry an id and ``requested_at``. One that is older than ``delay`` when its batch starts, or from more than
    ``skew`` ahead of it, is rejected; so the watermark, ``delay + skew`` behind the newest request, never passes one that was let in, and
    Spark drops nothing but repeats. State is one id per request of that time.
    """

    delay: dt.timedelta = dt.timedelta(days=1)
    skew: dt.timedelta = dt.timedelta(hours=1)

    FIELDS = (T.StructField("request_id", T.StringType()), T.StructField("requested_at", T.TimestampType()))


def read_requests(
    spark: SparkSession, path: str, fmt: str = "json", files_per_batch: int = 1000, dedup: Dedup | None = None
) -> DataFrame:
    """Requests as they arrive; JSON documents, one a line, are single requests or lists of them (``parse_documents``)."""
    schema = T.StructType([*REQUEST_SCHEMA, *(dedup.FIELDS if dedup else ())])
    stream = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    if fmt != "json":
        return stream.schema(schema).format(fmt).load(path)
    return parse_documents(stream.text(path), schema)


def parse_documents(lines: DataFrame, schema: T.StructType = REQUEST_SCHEMA) -> DataFrame:
    """``value`` (a JSON document) to its requests: fields, ``position`` and, for what is no request, its text in ``_corrupt_record``.

    A document is a request, a list of requests, or ``{"features": [...]}``. Elements are read one by one, so a bad one does
    not spoil the others. An empty list has no requests; blank lines are no documents.
    """
    value = F.col("value")
    many = F.from_json(value, "features array<string>")["features"]
    listed = F.ltrim(value).startswith("[")
    # Parsing a document for a key it cannot have costs as much as reading it; a backslash may spell the key in escapes.
    may_wrap = value.contains("features") | value.contains("\\")
    wrapped = may_wrap & F.get_json_object(value, "$.features").isNotNull()
    elements = (
        F.when(listed, F.coalesce(F.from_json(value, "array<string>"), F.array(F.lit(None).cast("string"))))
        .when(wrapped, F.coalesce(many, F.array(F.lit(None).cast("string"))))
        .otherwise(F.array(value))
    )
    rows = lines.where(F.trim(value) != "").select("value", (listed | wrapped).alias("in_list"), F.posexplode(elements).alias(POSITION, "element"))
    options = {"columnNameOfCorruptRecord": CORRUPT}
    whole = T.StructType([*schema, T.StructField(CORRUPT, T.StringType())])
    # An object; numbers and texts are no requests, though a parser may take them for empty ones.
    is_object = F.ltrim("element").startswith("{")
    found = rows.withColumn("request", F.when(is_object, F.from_json("element", whole, options)))
    bad = F.col("request").isNull() | F.col(f"request.{CORRUPT}").isNotNull()
    return found.select(
        *[F.when(~bad, F.col(f"request.{f}")).alias(f) for f in schema.fieldNames()],
        F.when(bad, F.coalesce("element", "value")).alias(CORRUPT),
        F.when(F.col("in_list"), F.col(POSITION)).alias(POSITION),
    )


def checked_requests(requests: DataFrame) -> DataFrame:
    """The requests with ``reason``: why a row is no request, null where it is one.

    Every field is required. A line that is no JSON, or has a value of the wrong type, is malformed.
    """
    names = [*REQUEST_SCHEMA.fieldNames(), *(f.name for f in Dedup.FIELDS if f.name in requests.columns)]
    fields = [F.col(f) if f in requests.columns else F.lit(None) for f in names]
    missing = F.concat_ws(",", *[F.when(c.isNull(), F.lit(n)) for c, n in zip(fields, names)])
    reason = F.when(missing != "", F.concat(F.lit("missing "), missing))
    if CORRUPT in requests.columns:
        reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed")).otherwise(reason)
    return requests.withColumn("reason", reason)


def accepted(requests: DataFrame) -> DataFrame:
    rows = checked_requests(requests)
    return rows.where("reason IS NULL").drop("reason", CORRUPT, POSITION)


def rejected(requests: DataFrame) -> DataFrame:
    """``record`` and ``reason`` of the rows that are no requests."""
    return checked_requests(requests).where("reason IS NOT NULL").select(_record(requests).alias("record"), "reason")


def _record(requests: DataFrame) -> Column:
    """What arrived, as text."""
    record = F.to_json(F.struct(*[c for c in requests.columns if c not in (CORRUPT, POSITION)]))
    return F.coalesce(F.col(CORRUPT), record) if CORRUPT in requests.columns else record


def score_requests(
    requests: DataFrame, scorer: Scorer, threshold: float, settings: Settings, scored_at: dt.datetime | None = None
) -> DataFrame:
    """Ids, probability, decision and constants of every request, batch or streaming alike.

    Rows that are no requests are left out; ``rejected`` has them. Without ``scored_at`` the time and date
    are those of the micro-batch, for a stream that keeps running.
    """
    features = request_features(accepted(requests), settings).transform(
        fill_missing, settings.feature_columns, settings.fill_value
    )
    time = F.current_timestamp() if scored_at is None else moment(scored_at)
    date = F.to_date(time) if scored_at is None else F.lit(settings.as_of)
    return features.transform(scorer).select(
        "user_id",
        "stock_id",
        "probability",
        decide(F.col("probability"), threshold).alias("prediction"),
        time.alias("prediction_time"),
        F.lit(settings.model_version).alias("model_version"),
        date.alias("prediction_date"),
    )


def batch_response(scored: DataFrame, model_version: str) -> DataFrame:
    """One row about a scored batch: how many predictions, by which model."""
    return scored.agg(F.count(F.lit(1)).alias("count")).withColumn("model_version", F.lit(model_version))


def start_scoring(
    scored: DataFrame, root: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append to a prediction root of the stream's own; file log and checkpoint make the output
    exactly-once. Everything available is processed in bounded batches, then the query ends; with
    ``every`` (such as "10 seconds") it keeps waiting for new files."""
    when = {"processingTime": every} if every else {"availableNow": True}
    return (
        scored.select(PREDICTION_SCHEMA.fieldNames())
        .writeStream.format("parquet")
        .partitionBy("prediction_date")
        .option("checkpointLocation", checkpoint)
        .trigger(**when)
        .start(root)
    )


def start_rejects(requests: DataFrame, root: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append what is no request to a table of its own, from the same files, with its own checkpoint."""
    when = {"processingTime": every} if every else {"availableNow": True}
    return (
        rejected(requests)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(**when)
        .start(root)
    )


#: Rows of a root that ``start_two_sinks`` writes: predictions, and what was rejected with the reason.
VERDICT_SCHEMA = T.StructType(
    [
        *PREDICTION_SCHEMA,
        T.StructField(POSITION, T.IntegerType()),
        T.StructField("record", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("accepted", T.BooleanType()),
    ]
)


def judged_requests(
    requests: DataFrame, scorer: Scorer, threshold: float, settings: Settings, scored_at: dt.datetime | None = None, dedup: Dedup | None = None
) -> DataFrame:
    """Every request once, batch or streaming alike: its prediction if it is accepted, its text and the reason if not."""
    time = F.current_timestamp() if scored_at is None else moment(scored_at)
    date = F.to_date(time) if scored_at is None else F.lit(settings.as_of)
    rows = checked_requests(requests)
    if dedup:
        late = F.when(F.col("requested_at") < time - F.lit(dedup.delay), "late").when(F.col("requested_at") > time + F.lit(dedup.skew), "ahead of time")
        rows = rows.withColumn("reason", F.coalesce("reason", late))
        good = F.col("reason").isNull()
        # Rejects repeat nothing: each is its own key.
        rows = (
            rows.withColumn("event_at", F.when(good, F.col("requested_at")).otherwise(time))
            .withColumn("event_key", F.when(good, F.concat(F.lit("r"), "request_id")).otherwise(F.uuid()))
            .withWatermark("event_at", f"{int((dedup.delay + dedup.skew).total_seconds())} seconds")
            .dropDuplicatesWithinWatermark(["event_key"])
            if requests.isStreaming
            else _first_of_each(rows, good)
        )
    # Only rejects are written as text again.
    rows = rows.withColumn("record", F.when(F.col("reason").isNotNull(), _record(requests)))
    carried = [c for c in (POSITION, "record", "reason") if c in rows.columns]
    features = request_features(rows, settings, carried).transform(fill_missing, settings.feature_columns, settings.fill_value)
    good = F.col("reason").isNull()
    values = {
        "user_id": F.col("user_id"),
        "stock_id": F.col("stock_id"),
        "probability": F.col("probability"),
        "prediction": decide(F.col("probability"), threshold),
        "prediction_time": time,
        "model_version": F.lit(settings.model_version),
    }
    position = F.col(POSITION) if POSITION in requests.columns else F.lit(None)
    return features.transform(scorer).select(
        *[F.when(good, c).cast(PREDICTION_SCHEMA[n].dataType).alias(n) for n, c in values.items()],
        date.alias("prediction_date"),
        position.cast("int").alias(POSITION),
        "record",
        "reason",
        good.alias("accepted"),
    )


def _first_of_each(rows: DataFrame, good: Column) -> DataFrame:
    """The same for a batch: of requests with one id the first stays."""
    first = Window.partitionBy(F.when(good, F.concat(F.lit("r"), "request_id")).otherwise(F.uuid())).orderBy("requested_at")
    return rows.withColumn("nth", F.row_number().over(first)).where("nth = 1").drop("nth")


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The name a stream keeps through restarts, as its checkpoint has it."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first().value)["id"]


def write_batch(judged: DataFrame, root: str, batch: int, stream: str) -> bool:
    """Write a micro-batch's predictions and rejects in one job and commit both at once; False if the batch had been committed before.

    Rows lie in a folder that only the commit names. So a batch that is repeated after a failure leaves unread files
    at most, and one that was committed is not even evaluated again.
    """
    spark = judged.sparkSession
    name = f"{stream}-{batch:012d}"
    if commits.exists_below(spark, f"{root}/commits", name):
        return False
    folder = f"batch={name}-{uuid.uuid4().hex}"
    seen = Observation()
    judged.observe(
        seen, F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("rejected"), F.collect_set("prediction_date").alias("dates")
    ).write.partitionBy("accepted", "prediction_date").parquet(f"{root}/rows/{folder}")
    counts = seen.get
    if not counts["accepted"] + counts["rejected"]:
        return True
    # The time of a batch is one, so is its date; a repeated batch has the same.
    (date,) = counts["dates"]
    values = {"folder": folder, "accepted": counts["accepted"], "rejected": counts["rejected"]}
    return commits.create(spark, f"{root}/commits/prediction_date={date}", name, values)


def start_two_sinks(judged: DataFrame, root: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Predictions and rejects below one root, from one pass over each file; ``read_predictions`` and ``read_rejects`` read them."""
    when = {"processingTime": every} if every else {"availableNow": True}
    stream = []

    def write(batch: DataFrame, number: int) -> None:
        if not stream:
            stream.append(_stream_id(batch.sparkSession, checkpoint))
        write_batch(batch, root, number, stream[0])

    return judged.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**when).start()


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """``record, reason, position`` of what the stream rejected."""
    rows = read_committed(spark, root, None, VERDICT_SCHEMA, accepted=False)
    if rows is None:
        return spark.createDataFrame([], "record string, reason string, position int")
    return rows.select("record", "reason", POSITION)
