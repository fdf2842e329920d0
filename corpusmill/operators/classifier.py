"""Metrics of predicted against true labels, for one or many tasks, from counted (truth, prediction) pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.text import safe_ratio
from corpusmill.operators import agreement


def class_table(df: DataFrame, truth: Column, pred: Column, keys: Sequence[str] = ("task",)) -> DataFrame:
    """``<keys>, class, tp, fp, fn``; classes are the union of what occurs in truth and prediction, aligned by value."""
    k = list(keys)
    return _class_counts(df.select(*k, truth.alias("t"), pred.alias("p")).filter("t is not null and p is not null").groupBy(*k, "t", "p").agg(F.count("*").alias("n")), k)


def _class_counts(ct: DataFrame, k: list[str]) -> DataFrame:
    both = F.array_distinct(F.array("t", "p"))
    e = ct.select(*k, "t", "p", "n", F.explode(both).alias("class"))
    s = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    t, p, c = F.col("t"), F.col("p"), F.col("class")
    return e.groupBy(*k, "class").agg(s((t == c) & (p == c)).alias("tp"), s((t != c) & (p == c)).alias("fp"), s((t == c) & (p != c)).alias("fn"))


def report(table: DataFrame, keys: Sequence[str] = ("task",)) -> DataFrame:
    """Precision, recall, F1 and support of every class (0 where undefined), with accuracy, macro and weighted averages on each row."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    z = lambda a, b: F.coalesce(safe_ratio(a, b), F.lit(0.0))
    w = Window.partitionBy(*keys)
    d = table.select(*keys, "class", z(tp, tp + fp).alias("precision"), z(tp, tp + fn).alias("recall"), z(2 * tp, 2 * tp + fp + fn).alias("f1"), (tp + fn).alias("support"), tp.alias("_tp"))
    n = F.sum("support").over(w)
    mean = [F.avg(m).over(w).alias(f"macro_{m}") for m in ("precision", "recall", "f1")]
    weighted = [z(F.sum(F.col(m) * F.col("support")).over(w), n).alias(f"weighted_{m}") for m in ("precision", "recall", "f1")]
    return d.select("*", z(F.sum("_tp").over(w), n).alias("accuracy"), *mean, *weighted, n.alias("n")).drop("_tp")


def confusion(df: DataFrame, truth: Column, pred: Column, keys: Sequence[str] = ("task",)) -> DataFrame:
    """``<keys>, truth, pred, n`` over the union of the classes, zeros included."""
    k = list(keys)
    ct = df.select(*k, truth.alias("truth"), pred.alias("pred")).filter("truth is not null and pred is not null").groupBy(*k, "truth", "pred").agg(F.count("*").alias("n"))
    c = ct.select(*k, F.explode(F.array("truth", "pred")).alias("c")).distinct()
    grid = c.withColumnRenamed("c", "truth").join(c.withColumnRenamed("c", "pred"), k)  # classes squared
    return grid.join(ct, [*k, "truth", "pred"], "left").select(*k, "truth", "pred", F.coalesce("n", F.lit(0)).alias("n"))


def _f1s(table: DataFrame, keys: Sequence[str], prefix: Column) -> DataFrame:
    """``<keys>, metric, value`` of accuracy and the three F1 averages of a class table."""
    r = report(table, keys).groupBy(*keys).agg(F.max("accuracy").alias("accuracy"), F.max("weighted_f1").alias("f1_weighted"), F.max("macro_f1").alias("f1_macro"))
    names = {"accuracy": "accuracy", "f1_weighted": "f1_weighted", "f1_micro": "accuracy", "f1_macro": "f1_macro"}  # one label a row: micro F1 is the accuracy
    return r.select(*keys, F.explode(F.array(*[F.struct(F.concat(prefix, F.lit(n)).alias("metric"), F.col(c).alias("value")) for n, c in names.items()])).alias("z")).select(*keys, "z.*")


def metrics(df: DataFrame, targets: dict[str, int]) -> DataFrame:
    """``task, metric, value``: all metrics of ``task, truth, pred`` for tasks with their numbers of classes.

    Predictions are rounded half to even for classes and thresholds (1 to targets - 1 of each task), errors and Spearman take them as they
    are. Accuracy, F1 averages and per-class F1 (classes of the truth, aligned by value) only where all labels of a task are integers.
    """
    d = df.filter("truth is not null and pred is not null").select("task", "truth", "pred", F.rint("pred").alias("r")).filter(F.col("task").isin(*targets))
    ct = d.groupBy("task", "truth", "r").agg(F.count("*").alias("n"))
    table = _class_counts(ct.select("task", F.col("truth").alias("t"), F.col("r").alias("p"), "n"), ["task"])
    whole = ct.groupBy("task").agg(F.max((F.col("truth") != F.floor("truth")).cast("int")).alias("c")).filter("c = 0").select("task")
    out = _f1s(table, ["task"], F.lit("classification/")).join(whole, "task")
    one = report(table).join(whole, "task").join(ct.select("task", F.col("truth").alias("class")).distinct(), ["task", "class"])
    out = out.unionByName(one.select("task", F.concat(F.lit("class_f1/f1_class_"), F.col("class").cast("bigint").cast("string")).alias("metric"), F.col("f1").alias("value")))
    steps = F.create_map(*[x for t, k in targets.items() for x in (F.lit(t), F.array(*[F.lit(i) for i in range(1, k)]).cast("array<int>"))])
    b = ct.select("task", "truth", "r", "n", F.explode(steps[F.col("task")]).alias("x"))
    b = b.groupBy("task", "x", (F.col("truth") >= F.col("x")).cast("double").alias("t"), (F.col("r") >= F.col("x")).cast("double").alias("p")).agg(F.sum("n").alias("n"))
    prefix = F.concat(F.lit("binary/t"), F.col("x").cast("string"), F.lit("/"))
    out = out.unionByName(_f1s(_class_counts(b, ["task", "x"]), ["task", "x"], prefix).drop("x"))
    e = d.groupBy("task").agg(F.avg((F.col("truth") - F.col("pred")) ** 2).alias("regression/mse"), F.avg(F.abs(F.col("truth") - F.col("pred"))).alias("regression/mae"))
    e = e.join(spearman(d), "task").withColumnRenamed("spearman", "spearman_corr")
    names = [c for c in e.columns if c != "task"]
    return out.unionByName(e.select("task", F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(f"`{c}`").alias("value")) for c in names]))))


def regression(df: DataFrame, keys: Sequence[str] = ("task",), thresholds: Sequence[float] = ()) -> DataFrame:
    """``n, mse, mae, accuracy`` (half-even rounded predictions) and the accuracy at every threshold, per task."""
    t, p = F.col("truth"), F.col("pred")
    r = F.rint(p)
    cols = [F.avg((t - p) ** 2).alias("mse"), F.avg(F.abs(t - p)).alias("mae"), F.avg((t == r).cast("double")).alias("accuracy")]
    cols += [F.avg(((t >= x) == (r >= x)).cast("double")).alias(f"acc_{x:g}".replace(".", "_")) for x in thresholds]
    return df.filter("truth is not null and pred is not null").groupBy(*keys).agg(F.count("*").alias("n"), *cols)


def spearman(df: DataFrame, keys: Sequence[str] = ("task",)) -> DataFrame:
    ct = df.filter("truth is not null and pred is not null").groupBy(*keys, F.col("truth").alias("score_0"), F.col("pred").alias("score_1")).agg(F.count("*").alias("n"))
    return agreement.spearman(ct, keys)


def squared_error(df: DataFrame, reduction: str = "mean", mask: float = -100.0) -> DataFrame:
    """``loss`` over rows whose truth is not the mask: mean, sum or (none) one row each."""
    d = df.filter(F.col("truth") != mask).select("*", ((F.col("truth") - F.col("pred")) ** 2).alias("loss"))
    if reduction == "none":
        return d
    if reduction not in ("mean", "sum"):
        raise ValueError(f"unknown reduction {reduction!r}")
    return d.agg((F.avg if reduction == "mean" else F.sum)("loss").alias("loss"))
