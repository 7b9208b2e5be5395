"""Event logs as streams: metrics read from JSON lines, early stopping with state per run."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

EVENTS = "run string, epoch bigint, metric double, at timestamp"


def metric_events(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of (run, epoch, metric, at) from a folder of JSON-lines files; new files are read as they arrive."""
    return spark.readStream.schema(EVENTS).json(folder)


def minute_means(events: DataFrame, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Mean metric per run and time window; events later than `late` are left out."""
    return events.withWatermark("at", late).groupBy(F.window("at", width), "run").agg(F.count("*").alias("n"), F.avg("metric").alias("mean_metric"))


def early_stops(events: DataFrame, min_epochs: int = 10, patience: int = 8, min_delta: float = 0.001, idle_minutes: int = 24 * 60, late: str = "10 minutes") -> DataFrame:
    """(run, epoch, best_epoch, best_metric, stopped, n_late) after each batch of each run, with the state kept between batches.

    Epochs of a batch are taken in order; an epoch that comes after a later one was taken is ignored and counted as late, as is
    everything after the stop. The state of a run is dropped once the watermark (the latest event less `late`) has passed
    its last event by `idle_minutes`, so the state does not grow with all runs ever seen; a run that goes on after that
    begins anew.
    """
    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        best, at, bad, last, stopped, missed = state.get if state.exists else (float("-inf"), -1, 0, -1, False, 0)
        rows = pd.concat(list(parts)).sort_values("epoch")
        for epoch, metric in zip(rows["epoch"], rows["metric"], strict=True):
            if pd.isna(metric) or pd.isna(epoch):
                continue
            if stopped or epoch <= last:
                missed += 1
                continue
            last = int(epoch)
            if metric > best + min_delta:
                best, at, bad = float(metric), last, 0
            else:
                bad += 1
            stopped = last >= min_epochs and bad >= patience
        state.update((best, at, bad, last, stopped, missed))
        seen = rows["at"].max()
        now = state.getCurrentWatermarkMs()
        state.setTimeoutTimestamp((now if pd.isna(seen) else max(now, int(seen.timestamp() * 1000))) + idle_minutes * 60_000)
        yield pd.DataFrame({"run": [key[0]], "epoch": [last], "best_epoch": [at], "best_metric": [best], "stopped": [stopped], "n_late": [missed]})

    return events.withWatermark("at", late).groupBy("run").applyInPandasWithState(
        step, "run string, epoch bigint, best_epoch bigint, best_metric double, stopped boolean, n_late bigint", "best double, at bigint, bad bigint, last bigint, stopped boolean, missed bigint", "update", GroupStateTimeout.EventTimeTimeout
    )
