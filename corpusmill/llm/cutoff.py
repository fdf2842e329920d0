"""Score cutoffs that keep a target fraction of each source's records.

Distinct scores are counted per source (partial counts before the shuffle). The cutoff is searched in two levels: over
at most ``BINS`` score ranges per source, then over the distinct scores of the one range that holds it, so a source with
very many distinct scores is never summed up in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import recorded_language, row_key, valid_score

BINS = 1024


def scored(docs: DataFrame, doc: str = "document_id", source: str = "metadata.language", score: str = "scores.score") -> DataFrame:
    """(document_id, lang_code, score, k): distinct rows with a recorded language and a valid score."""
    d = docs.select(F.col(doc).alias("document_id"), recorded_language(source).alias("lang_code"), F.col(score).cast("double").alias("score"), row_key(docs).alias("k"))
    return d.filter(F.col("lang_code").isNotNull() & valid_score("score")).dropDuplicates(["document_id", "k"])


def cutoffs(docs: DataFrame, targets: DataFrame, rule: str = "at_least") -> DataFrame:
    """``lang_code, keep_pct, n_docs, cutoff, n_kept``, one row per target whose source has records.

    rule ``at_least``: the highest occurring score from which on at least keep_pct percent are kept. rule ``closest``: of
    that score and the next higher one, the one whose kept share is nearer to the target (ties keep more). A target of 0
    or less keeps the top score under ``at_least``; NULL targets are dropped; the largest keep_pct of a source wins.
    """
    t = targets.select("lang_code", F.col("keep_pct").cast("double").alias("keep_pct")).filter("lang_code is not null and keep_pct is not null").groupBy("lang_code").agg(F.max("keep_pct").alias("keep_pct"))
    counts = scored(docs).groupBy("lang_code", "score").agg(F.count("*").alias("n")).join(t, "lang_code")
    counts = counts.withColumn("bin", F.floor(F.col("score") * (BINS / 5.0)))
    bins = counts.groupBy("lang_code", "keep_pct", "bin").agg(F.sum("n").alias("n"))
    down = Window.partitionBy("lang_code").orderBy(F.desc("bin"))
    bins = bins.select("*", F.sum("n").over(down).alias("upto"), F.sum("n").over(Window.partitionBy("lang_code")).alias("n_docs")).withColumn("above", F.col("upto") - F.col("n"))
    need = F.greatest(F.col("keep_pct") * F.col("n_docs"), F.lit(1.0))
    hit = bins.filter((F.col("upto") * 100 >= need) & (F.col("above") * 100 < need))
    inside = counts.select("lang_code", "bin", "score", "n").join(hit.select("lang_code", "bin", "keep_pct", "n_docs", "above"), ["lang_code", "bin"])
    inside = inside.withColumn("n_kept", F.col("above") + F.sum("n").over(Window.partitionBy("lang_code").orderBy(F.desc("score"))))
    best = inside.filter(F.col("n_kept") * 100 >= need).groupBy("lang_code", "keep_pct", "n_docs").agg(F.max_by("score", F.struct(F.col("score"))).alias("cutoff"), F.min("n_kept").alias("n_kept"))
    if rule == "at_least":
        return best.select("lang_code", "keep_pct", "n_docs", "cutoff", "n_kept")
    if rule != "closest":
        raise ValueError(f"unknown rule {rule!r}")
    over = counts.select("lang_code", "score", "n").join(best.select("lang_code", F.col("cutoff").alias("c")), "lang_code").filter("score > c")
    upper = over.groupBy("lang_code").agg(F.min("score").alias("next_cutoff"), F.sum("n").alias("next_kept"))
    both = best.join(upper, "lang_code", "left")
    want = F.col("keep_pct") * F.col("n_docs") / 100
    up = F.coalesce(F.abs(F.col("next_kept") - want) < F.abs(F.col("n_kept") - want), F.lit(False))
    return both.select("lang_code", "keep_pct", "n_docs", F.when(up, F.col("next_cutoff")).otherwise(F.col("cutoff")).alias("cutoff"), F.when(up, F.col("next_kept")).otherwise(F.col("n_kept")).alias("n_kept"))


def kept(docs: DataFrame, targets: DataFrame, rule: str = "at_least") -> DataFrame:
    """``lang_code, document_id`` of the records at or above their source's cutoff; sources without target keep none."""
    c = cutoffs(docs, targets, rule).select("lang_code", "cutoff")
    d = scored(docs)
    return d.join(c, "lang_code").filter("score >= cutoff").select("lang_code", "document_id").distinct()
