"""Corpus maintenance: deduplication, merging, chunking, splitting, sampling, counting, hashing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.text import TRANSFORMS, word_count, words


def dedup(df: DataFrame, id: str, text: str, order: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """First row of every id, and of these the first of every text (by SHA-256), in the given order.

    NULL ids share one key, NULL text counts as empty. A repeated id does not register its text. With ``within`` every group
    (a file, a source) is deduplicated on its own. Both stages are minimum aggregates that combine before the shuffle, so a
    key that holds very many rows is no hot window.
    """
    g = list(within)
    row = F.struct(*order, *[c for c in df.columns if c not in order])
    h = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    first = df.select(*g, F.col(id).alias("_id"), h.alias("_h"), row.alias("_row")).groupBy(*g, "_id").agg(F.min_by(F.struct("_h", "_row"), F.struct(*[F.col(f"_row.{c}") for c in order])).alias("_f"))
    first = first.select(*g, F.col("_f._h").alias("_h"), F.col("_f._row").alias("_row"))
    kept = first.groupBy(*g, "_h").agg(F.min_by("_row", F.struct(*[F.col(f"_row.{c}") for c in order])).alias("_row"))
    return kept.select(*[F.col(f"_row.{c}").alias(c) for c in df.columns])


def merge_sorted(frames: Sequence[DataFrame], id: str, tie: Sequence[str] = ()) -> DataFrame:
    """All rows of all frames, in numeric order of a string id (a range-partitioned sort)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.orderBy(F.col(id).cast("bigint"), *tie)


def global_index(df: DataFrame, order: Sequence[str], name: str = "line") -> DataFrame:
    """Rows numbered from 0 in the given order, without sorting everything in one task.

    Rows are range-partitioned and sorted, partitions are counted, and each partition numbers its rows from its offset.
    """
    srt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id()).persist()
    n = srt.groupBy("_p").agg(F.count("*").alias("n"), F.min("_i").alias("lo"))
    start = n.select("_p", "lo", (F.sum("n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"))  # one row a partition
    return srt.join(F.broadcast(start), "_p").select(*df.columns, (F.col("before") + F.col("_i") - F.col("lo")).cast("bigint").alias(name))


def numbered(df: DataFrame, by: str, line: str, name: str, block: int = 65_536) -> DataFrame:
    """Rows of every group numbered from 0 without gaps, in the order of an integer column; blocks of it are counted first, so no group is sorted in one task."""
    d = df.withColumn("_b", F.floor(F.col(line) / block))
    n = d.groupBy(by, "_b").agg(F.count("*").alias("_n"))
    before = n.select(by, "_b", (F.sum("_n").over(Window.partitionBy(by).orderBy("_b")) - F.col("_n")).alias("_before"))
    r = F.row_number().over(Window.partitionBy(by, "_b").orderBy(line)) - 1
    return d.join(before, [by, "_b"]).withColumn(name, (F.col("_before") + r).cast("bigint")).drop("_b", "_before")


def chunked(df: DataFrame, order: Sequence[str], lines: int) -> DataFrame:
    """``chunk`` and ``line``: chunks of exactly ``lines`` rows (the last may be shorter), numbered from 0."""
    return global_index(df, order).withColumn("chunk", F.floor(F.col("line") / lines))


def limit_per(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """First n rows of every group."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("_r") <= n).drop("_r")


def seeded_order(seed: int, id: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id).cast("string")))


def stratified_sample(df: DataFrame, column: str, sizes: dict[str, int], id: str, seed: int = 42) -> DataFrame:
    """``min(group, n)`` rows of every listed value (compared as strings), chosen by a seeded hash order.

    Groups are counted in 4096 hash ranges first; only ranges that hold wanted ranks are sorted, each on its own.
    """
    n = F.create_map(*[F.lit(x) for kv in sizes.items() for x in kv])
    part = df.filter(F.col(column).cast("string").isin(*sizes)).withColumn("_h", seeded_order(seed, id)).withColumn("_r", F.substring("_h", 1, 3)).withColumn("_v", F.col(column).cast("string"))
    count = part.groupBy("_v", "_r").agg(F.count("*").alias("_n"))
    start = count.select("_v", "_r", (F.sum("_n").over(Window.partitionBy("_v").orderBy("_r")) - F.col("_n")).alias("_before")).filter(F.col("_before") < n[F.col("_v")])
    rank = F.col("_before") + F.row_number().over(Window.partitionBy("_v", "_r").orderBy("_h", id))
    return part.join(start, ["_v", "_r"]).withColumn("_k", rank).filter(F.col("_k") <= n[F.col("_v")]).select(*df.columns)


def exact_split(df: DataFrame, id: str, ratios: Sequence[float] = (0.8, 0.1, 0.1), seed: int = 42) -> DataFrame:
    """``split``: exactly int(n * r) rows of train and val and the rest as test, by a seeded hash order of the ids."""
    if abs(sum(ratios) - 1) > 1e-9 or min(ratios) < 0:
        raise ValueError("ratios must sum to 1")
    d = global_index(df.withColumn("_h", seeded_order(seed, id)), ["_h", id], "_line").drop("_h")
    n = df.count()
    a, b = int(n * ratios[0]), int(n * ratios[0]) + int(n * ratios[1])
    return d.withColumn("split", F.when(F.col("_line") < a, "train").when(F.col("_line") < b, "val").otherwise("test")).drop("_line")


def transformed(df: DataFrame, score: Column, id: str, names: Sequence[str], seed: int = 42) -> DataFrame:
    """``id`` and one column per named transform, for rows that have a score."""
    x = score.cast("double")
    return df.filter(score.isNotNull()).select(id, *[TRANSFORMS[n](x, F.col(id), seed).alias(n) for n in names])


def word_histogram(df: DataFrame, text: str) -> DataFrame:
    return df.filter(F.col(text).isNotNull()).groupBy(word_count(F.col(text)).cast("bigint").alias("n_words")).agg(F.count("*").alias("n_docs"))


def word_totals(df: DataFrame, text: str, by: Sequence[str] = ()) -> DataFrame:
    """``n_docs, n_words, n_chars`` over all rows with a text, or per group; groups without texts count 0."""
    c = F.col(text)
    return df.groupBy(*by).agg(
        F.count(c).alias("n_docs"), F.coalesce(F.sum(F.when(c.isNotNull(), F.size(words(c)))), F.lit(0)).alias("n_words"), F.coalesce(F.sum(F.length(c)), F.lit(0)).alias("n_chars")
    )


def unprocessed(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Work not on the list of what is done."""
    return work.join(done.select(key).distinct(), key, "left_anti")


def id_sets(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """``side, n``: ids in both, only in the first and only in the second."""
    x = a.select(key).distinct().withColumn("a", F.lit(True))
    y = b.select(key).distinct().withColumn("b", F.lit(True))
    j = x.join(y, key, "full_outer")
    side = F.when(F.col("a").isNull(), "second").when(F.col("b").isNull(), "first").otherwise("both")
    return j.groupBy(side.alias("side")).agg(F.count("*").alias("n"))


def equal_ids(truth: DataFrame, pred: DataFrame, key: str) -> DataFrame:
    """Inner join by id that raises when an id is missing on either side."""
    j = truth.withColumn("_t", F.lit(1)).join(pred.withColumn("_p", F.lit(1)), key, "full_outer")
    bad = F.col("_t").isNull() | F.col("_p").isNull()
    return j.filter(F.when(bad, F.raise_error(F.concat(F.lit("ids differ: "), F.col(key).cast("string"))).cast("boolean")).otherwise(True)).drop("_t", "_p")


def kept_records(df: DataFrame, id: str, excluded: Sequence[str], score: str | None = None, domain: Sequence[float] | None = None) -> DataFrame:
    """Rows whose id is not on a short list and whose score, if asked for, is one of ``domain``; NULL ids and scores drop out."""
    d = df.filter(F.col(id).isNotNull() & ~F.col(id).isin(*excluded)) if excluded else df.filter(F.col(id).isNotNull())
    return d.filter(F.col(score).isin(*[float(x) for x in domain])) if score is not None and domain is not None else d


def digests(df: DataFrame, id: str, text: str) -> DataFrame:
    return df.select(id, F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("md5"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("sha256"))


def consistent_part(names: Sequence[str], delimiter: str = "_", keep: Sequence[int] = (0,)) -> str:
    """The kept parts of file stems joined again; ValueError when the files disagree."""
    parts = {delimiter.join(n.split(delimiter)[i] for i in keep) for n in names}
    if len(parts) != 1:
        raise ValueError(f"file names differ in the kept parts: {sorted(parts)}")
    return parts.pop()
