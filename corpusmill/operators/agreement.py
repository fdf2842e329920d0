"""Agreement between annotators, for all pairs at once.

Documents are shuffled once: pairs of scores are counted into a contingency table (annotators, score_0, score_1, n), which
has at most labels^2 rows per pair for discrete scores. Every statistic is a closed form over that table.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.text import round_half_up, safe_ratio

PAIR = ["annotator_0", "annotator_1"]


def pairs(scores: DataFrame, by: Sequence[str] = ("doc_id", "prompt")) -> DataFrame:
    """Annotations of two annotators of the same document and prompt; repeated annotations multiply."""
    keep = [*by, "annotator", "score"]
    a = scores.select(*keep).withColumnsRenamed({"annotator": "annotator_0", "score": "score_0"})
    b = scores.select(*keep).withColumnsRenamed({"annotator": "annotator_1", "score": "score_1"})
    return a.join(b, list(by)).filter("annotator_0 < annotator_1")


def contingency(pair_rows: DataFrame, keys: Sequence[str] = PAIR) -> DataFrame:
    """``<keys>, score_0, score_1, n`` of the pairs whose scores are both valid."""
    ok = pair_rows.filter("score_0 is not null and score_1 is not null")
    return ok.groupBy(*keys, "score_0", "score_1").agg(F.count("*").alias("n"))


def rounded(ct: DataFrame, keys: Sequence[str] = PAIR) -> DataFrame:
    """The table over half-up rounded scores."""
    r = ct.select(*keys, round_half_up(F.col("score_0")).cast("double").alias("score_0"), round_half_up(F.col("score_1")).cast("double").alias("score_1"), "n")
    return r.groupBy(*keys, "score_0", "score_1").agg(F.sum("n").alias("n"))


def _margin(ct: DataFrame, keys: Sequence[str], side: int) -> DataFrame:
    return ct.groupBy(*keys, F.col(f"score_{side}").alias("s")).agg(F.sum("n").alias("m"))


def spearman(ct: DataFrame, keys: Sequence[str] = PAIR) -> DataFrame:
    """Correlation of average ranks; NULL for constant scores."""
    out = ct
    for side in (0, 1):
        w = Window.partitionBy(*keys).orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
        m = _margin(ct, keys, side).select(*keys, F.col("s").alias(f"score_{side}"), (F.coalesce(F.sum("m").over(w), F.lit(0)) + (F.col("m") + 1) / 2).alias(f"r{side}"))
        out = out.join(m, [*keys, f"score_{side}"])
    n, x, y = F.col("n"), F.col("r0"), F.col("r1")
    g = out.groupBy(*keys).agg(F.sum("n").alias("t"), F.sum(n * x).alias("x"), F.sum(n * y).alias("y"), F.sum(n * x * y).alias("xy"), F.sum(n * x * x).alias("xx"), F.sum(n * y * y).alias("yy"))
    t = F.col("t")
    cov = t * F.col("xy") - F.col("x") * F.col("y")
    var = (t * F.col("xx") - F.col("x") ** 2) * (t * F.col("yy") - F.col("y") ** 2)
    return g.select(*keys, F.try_divide(cov, F.sqrt(F.greatest(var, F.lit(0.0)))).alias("spearman"))


def kendall(ct: DataFrame, keys: Sequence[str] = PAIR) -> DataFrame:
    """Tau-b by sums over the grid of a pair's scores; the cells of a pair are one small table."""
    k = list(keys)
    schema = ", ".join(f"`{c}` {ct.schema[c].dataType.simpleString()}" for c in k) + ", kendall double"

    def one(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        grid, mx, my, _, _ = _grid(*(p[c].to_numpy(float) for c in ("score_0", "score_1", "n")))
        return pd.DataFrame([[*key, _tau(grid, mx, my)]], columns=[*k, "kendall"])

    return ct.groupBy(*k).applyInPandas(one, schema)


def _grid(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Counts over the scores that occur, their margins, and the place of each cell."""
    ux, ix = np.unique(x, return_inverse=True)
    uy, iy = np.unique(y, return_inverse=True)
    grid = np.zeros((len(ux), len(uy)))
    np.add.at(grid, (ix, iy), n)
    return grid, grid.sum(1), grid.sum(0), ix, iy


def _tau(grid: np.ndarray, mx: np.ndarray, my: np.ndarray) -> float | None:
    left = np.cumsum(grid, 0) - grid  # smaller score_0, by score_1
    below = np.cumsum(left, 1) - left
    num, t = (grid * (2 * below + left - left.sum(1, keepdims=True))).sum(), grid.sum()
    n0, t0, t1 = t * (t - 1) / 2, (mx * (mx - 1) / 2).sum(), (my * (my - 1) / 2).sum()
    return float(num / np.sqrt((n0 - t0) * (n0 - t1))) if (n0 - t0) * (n0 - t1) > 0 else None


def cohen(ct: DataFrame, keys: Sequence[str] = PAIR) -> DataFrame:
    """Unweighted kappa of the table as given (rounded scores for the usual reading)."""
    k = list(keys)
    m = _margin(ct, k, 0).join(_margin(ct, k, 1).withColumnRenamed("m", "m1"), [*k, "s"]).groupBy(*k).agg(F.sum(F.col("m") * F.col("m1")).cast("double").alias("e"))
    g = ct.groupBy(*k).agg(F.sum("n").cast("double").alias("t"), F.sum(F.when(F.col("score_0") == F.col("score_1"), F.col("n")).otherwise(0)).cast("double").alias("o"))
    po, pe = F.col("o") / F.col("t"), F.coalesce("e", F.lit(0.0)) / (F.col("t") * F.col("t"))
    return g.join(m, k, "left").select(*k, F.try_divide(po - pe, 1 - pe).alias("cohen"))


def fleiss(ratings: DataFrame, keys: Sequence[str] = (), item: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Fleiss' kappa per key of ``<keys>, <item>, score``; only items with the largest number of raters of their key count."""
    k, i = list(keys), list(item)
    cells = ratings.filter("score is not null").groupBy(*k, *i, round_half_up(F.col("score")).alias("s")).agg(F.count("*").alias("c"))
    per = cells.groupBy(*k, *i).agg(F.sum("c").alias("r"), F.sum(F.col("c") * F.col("c")).alias("q"))
    w = per.groupBy(*k).agg(F.max("r").alias("n"))
    per = per.join(F.broadcast(w), k).filter("r = n and n > 1") if k else per.crossJoin(F.broadcast(w)).filter("r = n and n > 1")
    p = per.groupBy(*k).agg(F.avg((F.col("q") - F.col("n")) / (F.col("n") * (F.col("n") - 1))).alias("p"), F.sum("n").alias("t"))
    keep = per.select(*k, *i)
    share = cells.join(keep, [*k, *i]).groupBy(*k, "s").agg(F.sum("c").alias("m"))
    j = share.join(p, k) if k else share.crossJoin(F.broadcast(p))
    e = j.groupBy(*k, "p").agg(F.sum((F.col("m") / F.col("t")) ** 2).alias("e"))
    return e.select(*k, F.try_divide(F.col("p") - F.col("e"), 1 - F.col("e")).alias("fleiss"))


def krippendorff(values: DataFrame, keys: Sequence[str] = (), item: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Ordinal alpha of ``<keys>, <item>, score`` for any number of raters; items with one valid score drop out."""
    k, i = list(keys), list(item)
    cells = values.filter("score is not null").groupBy(*k, *i, "score").agg(F.count("*").alias("c"))
    per = cells.groupBy(*k, *i).agg(F.sum("c").alias("m"), F.collect_list(F.struct("score", "c")).alias("v")).filter("m > 1")  # distinct scores of one item
    o = per.select(*k, "m", F.explode("v").alias("a"), "v").select(*k, "m", "a", F.explode("v").alias("b"))
    n_pairs = F.when(F.col("a.score") == F.col("b.score"), F.col("a.c") * (F.col("a.c") - 1)).otherwise(F.col("a.c") * F.col("b.c"))
    co = o.groupBy(*k, F.col("a.score").alias("x"), F.col("b.score").alias("y")).agg(F.sum(n_pairs / (F.col("m") - 1)).alias("o"))
    return alpha(co, k)


def alpha(co: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Ordinal alpha from coincidences ``<keys>, x, y, o``."""
    k = list(keys)
    w = Window.partitionBy(*k) if k else Window.partitionBy(F.lit(1))
    nx = co.groupBy(*k, "x").agg(F.sum("o").alias("nx")).withColumn("cum", F.sum("nx").over(w.orderBy("x"))).withColumn("n", F.sum("nx").over(w))
    a = nx.select(*k, "x", F.col("nx").alias("na"), F.col("cum").alias("ca"), "n")
    b = nx.select(*k, F.col("x").alias("y"), F.col("nx").alias("nb"), F.col("cum").alias("cb"))
    grid = a.join(b, k) if k else a.crossJoin(b)  # distinct scores squared
    lo = F.when(F.col("x") <= F.col("y"), F.col("ca") - F.col("na")).otherwise(F.col("cb") - F.col("nb"))
    hi = F.when(F.col("x") <= F.col("y"), F.col("cb")).otherwise(F.col("ca"))
    d2 = F.when(F.col("x") == F.col("y"), 0.0).otherwise((hi - lo - (F.col("na") + F.col("nb")) / 2) ** 2)
    g = grid.withColumn("d2", d2).join(co, [*k, "x", "y"], "left")
    s = g.groupBy(*k).agg(F.sum(F.coalesce("o", F.lit(0.0)) * F.col("d2")).alias("do"), F.sum(F.col("na") * F.col("nb") * F.col("d2")).alias("de"), F.first("n").alias("n"))
    return s.select(*k, (1 - F.try_divide((F.col("n") - 1) * F.col("do"), F.col("de"))).alias("krippendorff"))


def counted(pair_rows: DataFrame, keys: Sequence[str] = PAIR) -> DataFrame:
    """The contingency table with invalid scores (NULL) kept."""
    return pair_rows.groupBy(*keys, "score_0", "score_1").agg(F.count("*").alias("n"))


def summary(table: DataFrame, thresholds: Sequence[float] = (3.0,), keys: Sequence[str] = PAIR) -> DataFrame:
    """``n_common, n_valid, invalid, mae, mse, acc, ta_<t>`` per pair from a counted table."""
    s0, s1, n = F.col("score_0"), F.col("score_1"), F.col("n")
    both = s0.isNotNull() & s1.isNotNull()
    valid = F.sum(F.when(both, n).otherwise(0))
    mean = lambda x, name: F.try_divide(F.sum(F.when(both, n * x)), valid.cast("double")).alias(name)
    d = s0 - s1
    cols = [mean(F.abs(d), "mae"), mean(d * d, "mse"), mean((round_half_up(s0) == round_half_up(s1)).cast("double"), "acc")]
    cols += [mean(((s0 >= t) == (s1 >= t)).cast("double"), f"ta_{t:g}".replace(".", "_")) for t in thresholds]
    return table.groupBy(*keys).agg(F.sum("n").alias("n_common"), valid.alias("n_valid"), (F.sum("n") - valid).alias("invalid"), *cols)


def against(pair_rows: DataFrame, truth: str) -> DataFrame:
    """Pairs turned so that ``truth`` is score_0: ``annotator, truth, pred`` (unrounded)."""
    a = pair_rows.filter(F.col("annotator_0") == truth).select(F.col("annotator_1").alias("annotator"), F.col("score_0").alias("truth"), F.col("score_1").alias("pred"), *_rest(pair_rows))
    b = pair_rows.filter(F.col("annotator_1") == truth).select(F.col("annotator_0").alias("annotator"), F.col("score_1").alias("truth"), F.col("score_0").alias("pred"), *_rest(pair_rows))
    return a.unionByName(b)


def _rest(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (*PAIR, "score_0", "score_1")]


def class_counts(gt: DataFrame, keys: Sequence[str] = ("annotator",), labels: Sequence[int] = range(6)) -> DataFrame:
    """``<keys>, label, tp, fp, fn`` on rounded, valid pairs, for every label."""
    k = list(keys)
    v = gt.filter("truth is not null and pred is not null").select(*k, round_half_up(F.col("truth")).alias("t"), round_half_up(F.col("pred")).alias("p"))
    ct = v.groupBy(*k, "t", "p").agg(F.count("*").alias("n"))
    e = ct.select(*k, "t", "p", "n", F.explode(F.array(*[F.lit(int(x)).cast("bigint") for x in labels])).alias("label"))
    s = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    t, p, lab = F.col("t"), F.col("p"), F.col("label")
    return e.groupBy(*k, "label").agg(s((t == lab) & (p == lab)).alias("tp"), s((t != lab) & (p == lab)).alias("fp"), s((t == lab) & (p != lab)).alias("fn"))


def class_accuracy(counts: DataFrame, keys: Sequence[str] = ("annotator",)) -> DataFrame:
    """Share of a class's documents that got its label, 0.0 for classes without documents."""
    return counts.select(*keys, "label", F.coalesce(safe_ratio(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0)).alias("class_accuracy"))


def f1_scores(counts: DataFrame, keys: Sequence[str] = ("annotator",)) -> DataFrame:
    """``label, f1`` with macro (over labels that occur) and micro F1 of the annotator on every row."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    f1 = F.coalesce(safe_ratio(2 * tp, 2 * tp + fp + fn), F.lit(0.0))
    w = Window.partitionBy(*keys)
    micro = safe_ratio(2 * F.sum(tp).over(w), 2 * F.sum(tp).over(w) + F.sum(fp).over(w) + F.sum(fn).over(w))
    return counts.select(*keys, "label", f1.alias("f1"), F.avg(F.when(tp + fp + fn > 0, f1)).over(w).alias("macro_f1"), micro.alias("micro_f1"))


def confusion(gt: DataFrame, keys: Sequence[str] = ("annotator",), labels: Sequence[int] = range(6)) -> DataFrame:
    """``<keys>, label, prediction, n``: every label by -1 (invalid) and every label, zeros included.

    Rows whose truth is invalid or no label are left out.
    """
    k, labs = list(keys), [int(x) for x in labels]
    t, p = round_half_up(F.col("truth")), F.coalesce(round_half_up(F.col("pred")), F.lit(-1))
    n = gt.filter("truth is not null").select(*k, t.alias("label"), F.when(p.isin(*labs), p).otherwise(-1).cast("bigint").alias("prediction")).groupBy(*k, "label", "prediction").agg(F.count("*").alias("n"))
    arr = lambda xs: F.array(*[F.lit(x).cast("bigint") for x in xs])
    grid = gt.select(*k).distinct().select(*k, F.explode(arr(labs)).alias("label")).select(*k, "label", F.explode(arr([-1, *labs])).alias("prediction"))
    return grid.join(n, [*k, "label", "prediction"], "left").select(*k, "label", "prediction", F.coalesce("n", F.lit(0)).alias("n"))


def normalised(cm: DataFrame, keys: Sequence[str] = ("annotator",)) -> DataFrame:
    """Confusion rows as shares; 0 for an empty row."""
    tot = F.sum("n").over(Window.partitionBy(*keys, "label"))
    return cm.select(*keys, "label", "prediction", F.coalesce(safe_ratio(F.col("n"), tot), F.lit(0.0)).alias("share"))


def histogram(df: DataFrame, value: str, keys: Sequence[str], bins: int = 30, weight: str | None = None) -> DataFrame:
    """Equal-width bins between each group's minimum and maximum, the maximum in the last bin; a single value lies in bin 1. Rows count ``weight`` times."""
    k = list(keys)
    v = df.filter(F.col(value).isNotNull()).groupBy(*k, F.col(value).alias("x")).agg((F.sum(weight) if weight else F.count("*")).alias("n"))
    w = Window.partitionBy(*k)
    v = v.withColumn("lo", F.min("x").over(w)).withColumn("hi", F.max("x").over(w))
    b = F.when(F.col("hi") == F.col("lo"), 1).otherwise(F.least(F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins) + 1, F.lit(bins)))
    return v.groupBy(*k, b.cast("bigint").alias("bin")).agg(F.sum("n").alias("n"))


def difference_quartiles(pair_rows: DataFrame, keys: Sequence[str] = PAIR) -> DataFrame:
    """Quartiles, mean and count of ``score_1 - score_0``; by counted differences, so memory follows distinct values."""
    d = contingency(pair_rows, keys).select(*keys, (F.col("score_1") - F.col("score_0")).alias("d"), "n")
    d = d.groupBy(*keys, "d").agg(F.sum("n").alias("n"))
    q = F.percentile("d", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n"))
    g = d.groupBy(*keys).agg(F.sum("n").alias("n"), (F.sum(F.col("d") * F.col("n")) / F.sum("n")).alias("mean"), q.alias("q"))
    return g.select(*keys, "n", "mean", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))


def difference_histogram(pair_rows: DataFrame, keys: Sequence[str] = PAIR, bins: int = 30) -> DataFrame:
    """``histogram`` of ``score_1 - score_0`` of the valid pairs."""
    d = contingency(pair_rows, keys).select(*keys, (F.col("score_1") - F.col("score_0")).alias("difference"), "n")
    return histogram(d, "difference", keys, bins, "n")


def truth_metrics(gt: DataFrame, keys: Sequence[str] = ("annotator",)) -> DataFrame:
    """``n, acc, mae, mse`` of valid predictions against the truth: accuracy on rounded scores, errors on the scores as they are."""
    g = gt.filter("truth is not null and pred is not null")
    diff = F.col("truth") - F.col("pred")
    same = (round_half_up(F.col("truth")) == round_half_up(F.col("pred"))).cast("double")
    return g.groupBy(*keys).agg(F.count("*").alias("n"), F.avg(same).alias("acc"), F.avg(F.abs(diff)).alias("mae"), F.avg(diff * diff).alias("mse"))


def invalid_truth_histogram(gt: DataFrame, keys: Sequence[str] = ("annotator",)) -> DataFrame:
    """Truth of the documents without a valid prediction, edges 0, 0.5, 1.5, ..., 5.5."""
    x = F.col("truth")
    b = F.when(x < 0.5, 0).otherwise(F.floor(x + F.lit(0.5))).cast("bigint")
    return gt.filter((x >= 0) & (x <= 5.5) & F.col("pred").isNull()).groupBy(*keys, F.least(b, F.lit(5)).alias("bin")).agg(F.count("*").alias("n"))


def comparison(pair_rows: DataFrame, keys: Sequence[str] = PAIR) -> DataFrame:
    """Counts of equal, close, far and larger scores, and of scores of at least 2 and 3 on one or both sides."""
    a, b = F.col("score_0"), F.col("score_1")
    d = F.abs(a - b)
    n = lambda c: F.count_if(c)
    return pair_rows.filter("score_0 is not null and score_1 is not null").groupBy(*keys).agg(
        n(a == b).alias("same"), n(d <= 1).alias("within_1"), n(d > 1).alias("over_1"), n(d > 2).alias("over_2"), n(a > b).alias("larger_0"), n(b > a).alias("larger_1"),
        n((a >= 2) & (b >= 2)).alias("both_2"), n((a >= 2) | (b >= 2)).alias("one_2"), n((a >= 3) & (b >= 3)).alias("both_3"), n((a >= 3) | (b >= 3)).alias("one_3"),
        F.avg(a).alias("mean_0"), F.avg(b).alias("mean_1"),
    )


def metrics(pair_rows: DataFrame, thresholds: Sequence[float] = (3.0,), keys: Sequence[str] = PAIR) -> DataFrame:
    """All pair metrics side by side: ``summary``, ``spearman``, ``kendall`` and ``cohen``, which are defined there.

    Documents are shuffled once and counted; the cells of a pair, as many as its distinct scores squared at most, are then one small
    table, of which one grouped pass takes every statistic.
    """
    k = list(keys)
    table = counted(pair_rows, k)
    tas = [f"ta_{t:g}".replace(".", "_") for t in thresholds]
    names = ["n_common", "n_valid", "invalid", "mae", "mse", "acc", *tas, "spearman", "kendall", "cohen"]
    schema = ", ".join(f"`{c}` {table.schema[c].dataType.simpleString()}" for c in k) + "".join(f", {n} {'bigint' if n in names[:3] else 'double'}" for n in names)

    def one(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        total = int(p["n"].sum())
        p = p[p["score_0"].notna() & p["score_1"].notna()]
        x, y, n = (p[c].to_numpy(float) for c in ("score_0", "score_1", "n"))
        return pd.DataFrame([[*key, total, int(n.sum()), total - int(n.sum()), *_statistics(x, y, n, thresholds)]], columns=[*k, *names])

    return table.groupBy(*k).applyInPandas(one, schema)


def _statistics(x: np.ndarray, y: np.ndarray, n: np.ndarray, thresholds: Sequence[float]) -> list[float | None]:
    """Errors, shares and correlations of cells (x, y) that n pairs have; None where undefined."""
    t = n.sum()
    if not t:
        return [None] * (6 + len(thresholds))
    if min(x.min(), y.min()) < 0:
        raise ValueError("scores must not be negative")
    d, rx, ry = x - y, np.floor(x + 0.5), np.floor(y + 0.5)
    out = [(n * np.abs(d)).sum() / t, (n * d * d).sum() / t, (n * (rx == ry)).sum() / t]
    out += [(n * ((x >= c) == (y >= c))).sum() / t for c in thresholds]
    grid, mx, my, ix, iy = _grid(x, y, n)
    rank = lambda m: np.cumsum(m) - m + (m + 1) / 2
    a, b = rank(mx)[ix], rank(my)[iy]
    var = (t * (n * a * a).sum() - (n * a).sum() ** 2) * (t * (n * b * b).sum() - (n * b).sum() ** 2)
    out.append((t * (n * a * b).sum() - (n * a).sum() * (n * b).sum()) / np.sqrt(var) if var > 0 else None)
    out.append(_tau(grid, mx, my))
    labels = np.unique(np.concatenate([rx, ry]))
    e = sum(n[rx == c].sum() * n[ry == c].sum() for c in labels) / (t * t)
    out.append((out[2] - e) / (1 - e) if e != 1 else None)
    return [None if v is None else float(v) for v in out]


def pair_fleiss(ct: DataFrame, keys: Sequence[str] = PAIR) -> DataFrame:
    """Fleiss' kappa of two raters from their (rounded) table: every pair of scores is an item."""
    k = list(keys)
    g = ct.groupBy(*k).agg((F.sum(F.when(F.col("score_0") == F.col("score_1"), F.col("n")).otherwise(0)) / F.sum("n")).alias("p"), F.sum("n").alias("t"))
    both = ct.select(*k, "score_0", "score_1", "n")
    m = both.select(*k, F.explode(F.array("score_0", "score_1")).alias("s"), "n").groupBy(*k, "s").agg(F.sum("n").alias("m")).join(g, k)
    e = m.groupBy(*k, "p").agg(F.sum((F.col("m") / (2 * F.col("t"))) ** 2).alias("e"))
    return e.select(*k, F.try_divide(F.col("p") - F.col("e"), 1 - F.col("e")).alias("fleiss"))


def pair_krippendorff(ct: DataFrame, keys: Sequence[str] = PAIR) -> DataFrame:
    """Ordinal alpha of two raters from their table: a cell adds its count to both orders of its scores."""
    k = list(keys)
    o = ct.select(*k, F.explode(F.array(F.struct(F.col("score_0").alias("x"), F.col("score_1").alias("y")), F.struct(F.col("score_1").alias("x"), F.col("score_0").alias("y")))).alias("z"), "n")
    return alpha(o.groupBy(*k, F.col("z.x").alias("x"), F.col("z.y").alias("y")).agg(F.sum("n").cast("double").alias("o")), k)


def full_report(pair_rows: DataFrame, truth: str, thresholds: Sequence[float] = (3.0,), labels: Sequence[int] = range(6)) -> tuple[DataFrame, DataFrame]:
    """(pair metrics with Fleiss and Krippendorff; per annotator against the truth ``CA-l``, ``F1-l``, macro and micro F1 as a map)."""
    ct = contingency(pair_rows)
    m = metrics(pair_rows, thresholds).join(pair_fleiss(rounded(ct)), PAIR, "left").join(pair_krippendorff(ct), PAIR, "left")
    c = class_counts(against(pair_rows, truth), labels=labels)
    f = f1_scores(c).join(class_accuracy(c), ["annotator", "label"])
    per = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.concat(F.lit("CA-"), F.col("label").cast("string")), F.col("class_accuracy")))))  # a row a label
    f1 = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.concat(F.lit("F1-"), F.col("label").cast("string")), F.col("f1")))))
    g = f.groupBy("annotator").agg(F.map_concat(per, f1).alias("classes"), F.max("macro_f1").alias("macro_f1"), F.max("micro_f1").alias("micro_f1"))
    return m, g
