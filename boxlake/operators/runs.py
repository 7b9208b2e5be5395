"""Training runs: early stopping, learning rate, best trials, seed aggregates, flattened metrics."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.functions.labels import number_or_null, sanitised


def early_stopping(history: DataFrame, run: str, epoch: str, metric: str, min_epochs: int = 10, patience: int = 8, min_delta: float = 0.001) -> DataFrame:
    """(run, stop_epoch, best_epoch, best_metric, top_epoch, top_metric, n_epochs) of every run.

    An epoch is better if it beats the best so far by more than min_delta; the run stops at the first epoch from
    min_epochs on with `patience` epochs in a row that are not (null: never). best is as of the stop (or the end); top
    is the strictly greatest value (earliest on ties) up to there. A run's epochs are folded in order inside one row. A
    metric that is not finite raises, as in Spark NaN would be the greatest number and end all improvement.
    """
    value = F.col(metric).cast("double")
    odd = F.raise_error(F.concat(F.lit("metric is not finite in epoch "), F.col(epoch).cast("string"))).cast("double")
    history = history.withColumn(metric, F.when(F.isnan(value) | (F.abs(value) == F.lit(float("inf"))), odd).otherwise(value))
    rows = history.filter(F.col(metric).isNotNull()).groupBy(run).agg(F.array_sort(F.collect_list(F.struct(F.col(epoch).cast("bigint").alias("e"), F.col(metric).cast("double").alias("m")))).alias("h"))
    start = F.struct(F.lit(float("-inf")).alias("best"), F.lit(None).cast("bigint").alias("at"), F.lit(0).alias("bad"), F.lit(None).cast("bigint").alias("stop"), F.lit(float("-inf")).alias("top"), F.lit(None).cast("bigint").alias("top_at"))

    def step(s: Column, x: Column) -> Column:
        better = x["m"] > s["best"] + F.lit(min_delta)
        bad = F.when(better, F.lit(0)).otherwise(s["bad"] + 1)
        higher = x["m"] > s["top"]
        new = F.struct(
            F.when(better, x["m"]).otherwise(s["best"]).alias("best"), F.when(better, x["e"]).otherwise(s["at"]).alias("at"), bad.alias("bad"),
            F.when((x["e"] >= min_epochs) & (bad >= patience), x["e"]).alias("stop"), F.when(higher, x["m"]).otherwise(s["top"]).alias("top"), F.when(higher, x["e"]).otherwise(s["top_at"]).alias("top_at"),
        )
        return F.when(s["stop"].isNotNull(), s).otherwise(new)

    return rows.select(F.col(run), F.aggregate("h", start, step).alias("s"), F.size("h").alias("n_epochs")).select(run, F.col("s.stop").alias("stop_epoch"), F.col("s.at").alias("best_epoch"), F.col("s.best").alias("best_metric"), F.col("s.top_at").alias("top_epoch"), F.col("s.top").alias("top_metric"), "n_epochs")


def warmup_cosine(step: Column, warmup: int, total: int, floor: float) -> Column:
    """The learning-rate factor: linear to 1 over `warmup` steps, then a half cosine down to `floor` at `total`."""
    if warmup < 0 or total <= 0 or warmup >= total or not 0 <= floor <= 1:
        raise ValueError("need 0 <= warmup < total and a floor within 0..1")
    progress = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (step - warmup) / max(1, total - warmup)))
    return F.when(step < warmup, step / max(1, warmup)).otherwise(floor + 0.5 * (1 - floor) * (1 + F.cos(F.lit(math.pi) * progress)))


def best_trial(trials: DataFrame, trial: str, metric: str, maximise: bool = True, by: tuple[str, ...] = ()) -> DataFrame:
    """The best finished trial (the earliest on ties) and its value; failed trials have a null metric."""
    score = F.col(metric) if maximise else -F.col(metric)
    best = F.max(F.struct(score.alias("m"), (-F.col(trial)).alias("t"))).alias("b")
    value = F.col("b.m") if maximise else -F.col("b.m")
    return trials.filter(F.col(metric).isNotNull() & ~F.isnan(metric)).groupBy(*by).agg(best).select(*by, (-F.col("b.t")).alias(trial), value.alias(metric))


def last_value(history: DataFrame, run: str, step: str, value: str) -> DataFrame:
    """The value of the last row that has one, per run."""
    return history.filter(F.col(value).isNotNull()).groupBy(run).agg(F.max_by(value, step).alias(value))


def seed_aggregate(results: DataFrame, seed: str, metric: str, value: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, metric, mean, std, n, values) of metrics that every successful seed has; std is the sample's, 0 for one seed."""
    ok = results.filter(F.col(value).isNotNull() & ~F.isnan(value))
    seeds = ok.groupBy(*by).agg(F.count_distinct(seed).alias("__n"))
    held = ok.groupBy(*by, metric).agg(
        F.avg(value).alias("mean"), F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("std"), F.count_distinct(seed).alias("n"), F.transform(F.array_sort(F.collect_list(F.struct(seed, value))), lambda x: x[value]).alias("values")
    )
    if by:
        return held.join(seeds, list(by)).filter("n = __n").drop("__n")
    return held.crossJoin(seeds).filter("n = __n").drop("__n")  # seeds is one row here


def flattened(result: DataFrame, base: str) -> DataFrame:
    """(key, value) of evaluate()'s rows: base/metric overall, base/per_scope/group/metric else; only finite values."""
    name = F.when(F.col("scope") == "overall", F.concat_ws("/", F.lit(base), sanitised(F.col("metric")))).otherwise(F.concat_ws("/", F.lit(base), F.concat(F.lit("per_"), F.col("scope")), sanitised(F.col("grp")), sanitised(F.col("metric"))))
    return result.select(name.alias("key"), "value").filter(F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") < F.lit(float("inf"))))


def flattened_log(rows: DataFrame, event: str, entries: str, prefix: str, keep_prefix: bool = False) -> DataFrame:
    """(event, key, value) of maps of text values: numeric entries under prefix/, 'step' aside.

    With keep_prefix a key that already begins with the prefix keeps its parts, and '/' separates parts; else '/' is
    replaced as any other sign.
    """
    e = rows.select(event, F.explode(entries).alias("k", "v")).filter("k <> 'step'").withColumn("value", number_or_null(F.col("v"))).filter("value is not null")
    if keep_prefix:
        parts = F.transform(F.filter(F.split("k", "/"), lambda p: F.trim(p) != ""), sanitised)
        key = F.when(F.get(parts, F.lit(0)) == prefix, F.array_join(parts, "/")).otherwise(F.concat(F.lit(prefix + "/"), F.array_join(parts, "/")))
        return e.filter(F.size(parts) > 0).select(event, key.alias("key"), "value")
    return e.select(event, F.concat(F.lit(prefix + "/"), sanitised(F.col("k"))).alias("key"), "value")


def log_step(entries: Column) -> Column:
    """The step of a log row: its 'step', else its 'epoch'."""
    return F.coalesce(number_or_null(F.try_element_at(entries, F.lit("step"))), number_or_null(F.try_element_at(entries, F.lit("epoch")))).cast("bigint")


def rate(n: Column, seconds: Column) -> Column:
    """Items per second; 0 if no time passed."""
    return F.coalesce(F.try_divide(n.cast("double"), seconds.cast("double")), F.lit(0.0))


def boundary(value: Column, low: float, high: float, margin: float = 0.05) -> Column:
    """'lower' or 'upper' if a value lies within `margin` of a range's end on a log scale; null if not, or not positive."""
    if low <= 0 or high <= low:
        return F.lit(None).cast("string")
    position = (F.ln(value) - math.log(low)) / (math.log(high) - math.log(low))
    return F.when(value > 0, F.when(position <= margin, "lower").when(position >= 1 - margin, "upper"))
