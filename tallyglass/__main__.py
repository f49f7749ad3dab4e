"""Jobs for spark-submit: train and score, monitor, or score a stream of requests."""

from __future__ import annotations

import argparse
import datetime as dt

from tallyglass.config import Settings
from tallyglass.operators.model import load_model
from tallyglass.plans.batch import all_stored_features, run_batch, training_window, yesterday_features
from tallyglass.plans.monitoring import run_daily_monitoring
from tallyglass.session import job_session
from tallyglass.streaming.scoring import Dedup, judged_requests, read_requests, start_two_sinks


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tallyglass", description=__doc__)
    parser.add_argument("job", choices=["batch", "monitor", "stream"])
    parser.add_argument("--config", required=True)
    parser.add_argument("--as-of", type=dt.date.fromisoformat, required=True)
    parser.add_argument("--training-days", type=int, help="train on the last days; default all rows")
    parser.add_argument("--score-yesterday", action="store_true", help="score yesterday's rows only")
    parser.add_argument("--requests", help="folder of request files, for the stream job")
    parser.add_argument("--dedup-hours", type=float, help="score requests that repeat an id within so many hours once, in the stream job")
    parser.add_argument("--every", help="keep the stream job running at this interval")
    parser.add_argument("--retrain", action="store_true", help="train anew even if there is a model")
    parser.add_argument("--at", type=dt.time.fromisoformat, default=dt.time(), help="time of the run; default midnight")
    given = parser.parse_args(arguments)

    settings = Settings.from_json(given.config, as_of=given.as_of)
    spark = job_session(f"tallyglass-{given.job}")
    now = dt.datetime.combine(given.as_of, given.at)
    if given.job == "batch":
        if given.training_days is None:
            rows = all_stored_features(spark, settings)
        else:
            rows = training_window(spark, settings, given.training_days)
        scoring = yesterday_features(spark, settings) if given.score_yesterday else None
        print(run_batch(rows, settings, settings.store_path, scoring, given.retrain))
    elif given.job == "monitor":
        result = run_daily_monitoring(spark, settings, now)
        for alert in result.alerts.collect():
            print(f"ALERT {alert.alert}: {alert.value:.4f}")
        print(result.report_path)
    else:
        store = settings.store_path
        model = load_model(spark, f"{store}/{settings.model_prefix}", *settings.model_fallbacks)
        if model is None:
            raise SystemExit(f"no model below {store}")
        dedup = Dedup(delay=dt.timedelta(hours=given.dedup_hours)) if given.dedup_hours else None
        requests = read_requests(spark, given.requests, dedup=dedup)
        # A stream that keeps running stamps each micro-batch with its own time.
        scored_at = None if given.every else now
        judged = judged_requests(requests, model.score, model.threshold, settings, scored_at, dedup)
        start_two_sinks(judged, f"{store}/online_predictions", f"{store}/stream_checkpoint", given.every).awaitTermination()


if __name__ == "__main__":
    main()
