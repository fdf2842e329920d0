"""Score frames from annotations, and their return to the raw documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.functions import votes as vt
from corpusmill.schemas import LABELS


def score_frame(annotations: DataFrame, strategy: str = "majority", labels: Sequence[float] = LABELS, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id, annotator, prompt, prompt_lang, raw_data_file_path, score`` and ``keep``, one row per annotation; invalid is NULL."""
    m = F.col("meta_information")
    return annotations.select(
        F.col("document_id").alias("doc_id"), tx.annotator_name(m["model"]).alias("annotator"), m["prompt_name"].alias("prompt"),
        m["prompt_lang"].alias("prompt_lang"), m["raw_data_file_path"].alias("raw_data_file_path"), vt.aggregate(F.col("scores"), strategy, labels).alias("score"), *keep,
    )


def vote_rows(annotations: DataFrame, labels: Sequence[float] = LABELS) -> DataFrame:
    """``doc_id, annotator, prompt, k, score``: one row per vote, invalid votes as NULL."""
    m = F.col("meta_information")
    e = annotations.select(F.col("document_id").alias("doc_id"), tx.annotator_name(m["model"]).alias("annotator"), m["prompt_name"].alias("prompt"), F.posexplode("scores").alias("k", "v"))
    ok = F.col("v").isin(*[float(x) for x in labels])
    return e.select("doc_id", "annotator", "prompt", "k", F.when(ok, F.col("v")).alias("score"))


def variation(annotations: DataFrame, labels: Sequence[float] = LABELS) -> DataFrame:
    """Range of the valid votes per annotation and how often each occurs, with mean and sample deviation over all."""
    v = vt.valid_votes(F.col("scores"), labels)
    r = annotations.select((F.array_max(v) - F.array_min(v)).alias("variation")).filter("variation is not null")
    total = r.agg(F.avg("variation").alias("mean"), F.stddev_samp("variation").alias("stddev"))
    return r.groupBy("variation").agg(F.count("*").alias("n")).crossJoin(F.broadcast(total))  # total: one row


def last_scores(scores: DataFrame, *order: str, by: Sequence[str] = ()) -> DataFrame:
    """One score per raw file and document (and ``by``): the last one in file order wins."""
    keys = ["raw_data_file_path", "doc_id", *by]
    return scores.groupBy(*keys).agg(F.max_by(F.struct("score"), F.struct(*order)).alias("s")).select(*keys, F.col("s.score").alias("score"))


def join_scores(raw: DataFrame, scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Raw documents (``file_path, doc_id`` and what else they have) with their score and ``complete``: whether every document of the file has one.

    A document whose score is invalid (NULL) is matched; only documents without any annotation count as missing. ``by`` names
    further keys on both sides, each value of which is a case of its own (an annotator).
    """
    s = scores.select(F.col("raw_data_file_path").alias("file_path"), "doc_id", *by, "score", F.lit(True).alias("hit"))
    j = raw.join(s, ["file_path", "doc_id", *by], "left")
    gate = j.groupBy("file_path", *by).agg((F.count_if(F.col("hit").isNull()) == 0).alias("complete"))
    return j.join(gate, ["file_path", *by]).select(*raw.columns, "score", F.coalesce("hit", F.lit(False)).alias("matched"), "complete")


def retargeted(scores: DataFrame, raw_files: DataFrame, path: str = "file_path") -> DataFrame:
    """Scores whose raw file is looked up by base name among other files; scores of files that aren't there drop out, base names must be unique."""
    base = lambda c: F.regexp_extract(c, r"([^/]+)$", 1)
    there = raw_files.select(F.col(path).alias("_to")).distinct().groupBy(base(F.col("_to")).alias("_base")).agg(F.min("_to").alias("_to"), F.count("*").alias("_n"))
    there = there.filter(F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("several files are called "), "_base")).cast("boolean")).otherwise(True)).drop("_n")
    j = scores.withColumn("_base", base(F.col("raw_data_file_path"))).join(there, "_base")
    return j.withColumn("raw_data_file_path", F.col("_to")).drop("_base", "_to")
