"""Metric frames over languages and annotators, experiment rankings, match rates, usage totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.text import safe_ratio


def cross_language(frame: DataFrame, metrics: Sequence[str], summed: Sequence[str] = ("invalid",), by: str = "annotator") -> DataFrame:
    """Mean of every metric over an annotator's rows (NULLs add nothing but count as rows); ``summed`` ones are added up."""
    mean = lambda m: (F.sum(F.coalesce(F.col(m), F.lit(0.0))) / F.count("*")).alias(m)
    return frame.groupBy(by).agg(*[F.sum(m).cast("bigint").alias(m) if m in summed else mean(m) for m in metrics])


def one_confusion(cm: DataFrame, keys: Sequence[str] = ("annotator", "lang"), source: str = "file") -> DataFrame:
    """Confusion counts as they are; raises unless every annotator and language has them from exactly one source."""
    n = cm.groupBy(*keys).agg(F.count_distinct(source).alias("_n"))
    bad = F.when(F.col("_n") > 1, F.raise_error(F.concat_ws(" ", F.lit("several confusion matrices of"), *keys)).cast("boolean")).otherwise(True)
    return cm.join(n.filter(bad).drop("_n"), list(keys))


def cross_language_confusion(cm: DataFrame, by: str = "annotator") -> DataFrame:
    return cm.groupBy(by, "label", "prediction").agg(F.sum("n").alias("n"))


def long_metrics(frame: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """One row per key, metric and value."""
    z = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    return frame.select(*keys, F.inline(z))


def top_n(long: DataFrame, n: int, lower_is_better: Sequence[str] = ("mae", "mse", "invalid"), lang: str = "lang", who: str = "annotator") -> DataFrame:
    """``metric, annotator, top_n, n``: in how many languages an annotator is among the best 1..n, ties kept, zeros included."""
    v = F.when(F.col("metric").isin(*lower_is_better), F.col("value")).otherwise(-F.col("value"))
    r = long.withColumn("r", F.when(v.isNotNull(), F.rank().over(Window.partitionBy(lang, "metric").orderBy(v.asc_nulls_last()))))
    levels = F.explode(F.sequence(F.lit(1), F.lit(n))).alias("top_n")
    return r.select("metric", who, "r", levels).groupBy("metric", who, "top_n").agg(F.count_if(F.col("r") <= F.col("top_n")).alias("n"))


def best_flags(frame: DataFrame, metrics: Sequence[str], lower_is_better: Sequence[str] = ("mae", "mse", "invalid"), keys: Sequence[str] = ("annotator",)) -> DataFrame:
    """Per metric whether the row holds the best value of the column."""
    best = frame.agg(*[(F.min(m) if m in lower_is_better else F.max(m)).alias(f"_{m}") for m in metrics])
    return frame.crossJoin(F.broadcast(best)).select(*keys, *[(F.col(m) == F.col(f"_{m}")).alias(f"{m}_best") for m in metrics])  # best: one row


def pivot_metric(frame: DataFrame, rows: str, columns: str, value: str, values: Sequence[str] | None = None) -> DataFrame:
    """Rows by columns; with the column values given no extra pass over the data is needed. A cell with two values raises."""
    one = F.when(F.count(value) > 1, F.raise_error(F.lit("two values in one cell")).cast("double")).otherwise(F.max(value))
    return frame.groupBy(rows).pivot(columns, list(values) if values else None).agg(one)


def rank_experiments(frame: DataFrame, sort: Sequence[tuple[str, bool]], metric: str) -> DataFrame:
    """Experiments ordered by several columns, each ascending or not, with their place as ``rank``; the metric has to be numeric."""
    if frame.schema[metric].dataType.typeName() not in ("double", "float", "integer", "long", "short", "decimal"):
        raise ValueError(f"{metric} is no number")
    order = [F.col(c).asc() if up else F.col(c).desc() for c, up in sort]
    return frame.withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # one row an experiment


def match_rate(statuses: DataFrame, column: str = "document_processing_status") -> DataFrame:
    """Mean over vote positions of the share of ``success``; 0.0 without any status."""
    e = statuses.select(F.posexplode(column).alias("pos", "s"))
    per = e.groupBy("pos").agg(F.avg((F.col("s") == "success").cast("double")).alias("r"))
    return per.agg(F.coalesce(F.avg("r"), F.lit(0.0)).alias("match_rate"))


def throughput(rows: DataFrame, start: str, end: str, tokens_per_second: str) -> DataFrame:
    """``n_docs, elapsed_s, docs_per_s, mean_tokens_per_s``; NULL rates without documents or time. Times are epoch seconds."""
    g = rows.agg(F.count("*").alias("n_docs"), (F.max(end) - F.min(start)).cast("double").alias("elapsed_s"), F.avg(tokens_per_second).alias("mean_tokens_per_s"))
    return g.select("n_docs", "elapsed_s", safe_ratio(F.col("n_docs"), F.col("elapsed_s")).alias("docs_per_s"), "mean_tokens_per_s")


def longest_prefix(names: DataFrame, name: str, table: DataFrame, key: str, max_rows: int = 10_000) -> DataFrame:
    """Names with the row of the small table whose key is their longest prefix; names without one keep NULLs.

    Distinct names are matched by their prefixes: an equi-join on every prefix length that occurs in the table, no cross join.
    """
    lengths = [r[0] for r in table.select(F.length(key).alias("n")).filter("n > 0").distinct().limit(max_rows + 1).collect()]
    if len(lengths) > max_rows:
        raise ValueError(f"keys of more than {max_rows} lengths")
    distinct = names.select(name).filter(F.col(name).isNotNull()).distinct()
    arr = F.array(*[F.when(F.length(name) >= n, F.substring(name, 1, int(n))) for n in sorted(lengths)]) if lengths else F.array(F.lit(None).cast("string"))
    hit = distinct.select(name, F.explode(F.array_compact(arr)).alias(key)).join(table.select(key), key).groupBy(name).agg(F.max_by(key, F.length(key)).alias(key))
    return names.join(hit, name, "left").join(table, key, "left")


def usage_cost(usage: DataFrame, rates: DataFrame, model: str = "model") -> DataFrame:
    """Usage rows with ``cost`` per million tokens by the caller's rate table (``rate_key, input, cached_input, output``); unknown models cost 0."""
    j = longest_prefix(usage, model, rates, "rate_key")
    cached = F.when(F.col("cached_input").isNotNull(), F.coalesce("cached_tokens", F.lit(0))).otherwise(0)
    cost = (F.col("prompt_tokens") - F.coalesce("cached_tokens", F.lit(0))) * F.col("input") + cached * F.coalesce("cached_input", F.lit(0.0)) + F.col("completion_tokens") * F.col("output")
    return j.withColumn("cost", F.coalesce(cost / 1e6, F.lit(0.0)))


def usage_by_folder(usage: DataFrame, folder: str = "folder", model: str = "model", values: Sequence[str] = ("prompt_tokens", "completion_tokens", "cost")) -> DataFrame:
    """Sums per folder with the sorted distinct models as one string."""
    return usage.groupBy(folder).agg(*[F.sum(v).alias(v) for v in values], F.array_join(F.array_sort(F.collect_set(model)), ", ").alias("models"))


def grand_totals(folders: DataFrame, values: Sequence[str], factor: int) -> DataFrame:
    """Totals, means per folder and the mean times ``factor``."""
    cols: list[Column] = []
    for v in values:
        cols += [F.sum(v).alias(f"{v}_total"), F.avg(v).alias(f"{v}_mean"), (F.avg(v) * factor).alias(f"{v}_extrapolated")]
    return folders.agg(*cols)
