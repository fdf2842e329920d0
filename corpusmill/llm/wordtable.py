"""Distinct-word table: split texts in Spark, work once per distinct word, join the results back by position.

``blocks`` turns documents into rows that each hold a bounded number of tokens: the block's own distinct words and, per
token, the position of its word among them. Everything that is a function of a word (ids, token counts, language scores)
is computed on the table of all distinct words and joined to the words of the blocks, which are far fewer than the tokens;
a token then finds its result by position. The blocks are cut from their lineage, so texts are split once.

Words that stand in very many blocks would be hot keys of that join. Their results travel by broadcast (``HOT_WORDS`` of them at most); which words those
are is told by some blocks, and makes no difference to any result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.tokenizer import SPLIT
from corpusmill.session import shared_folder

#: A block ends with the document that brings it to this many tokens.
BLOCK_TOKENS = 400_000
#: Bound of the words whose results are broadcast, and of the blocks that are asked for them.
HOT_WORDS, ASKED_BLOCKS = 20_000, 64


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def _narrow(idx: np.ndarray, words: int) -> bytes:
    """Positions as little-endian integers of two bytes, or of four where a block has more words than those can tell."""
    return idx.astype("<u2" if words <= 1 << 16 else "<u4").tobytes()


def positions(row: dict) -> np.ndarray:
    """The word position of every token of a block."""
    raw, ends = row["idx"].as_py(), row["ends"]
    n = ends[len(ends) - 1].as_py() if len(ends) else 0
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype(np.int64)


def blocks(docs: DataFrame, keys: list[str], text: str = "text", doc_freq: bool = False) -> DataFrame:
    """Rows ``block, words, ends, idx, df, <keys>``; key columns become arrays with one entry per document.

    ``ends`` holds each document's end in ``idx``, whose bytes ``positions`` reads; null texts have no tokens. ``df`` counts the documents of the block
    that hold each word (empty unless asked for).
    """
    d = docs.select(*keys, F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit("(?U)" + SPLIT), F.lit(0)).alias("_w"))
    fields = [T.StructField("block", T.BinaryType()), T.StructField("words", T.ArrayType(T.StringType())), T.StructField("ends", T.ArrayType(T.IntegerType()))]
    fields += [T.StructField("idx", T.BinaryType()), T.StructField("df", T.ArrayType(T.IntegerType()))]
    fields += [T.StructField(k, T.ArrayType(d.schema[k].dataType)) for k in keys]

    def one(rows: pa.RecordBatch) -> pa.RecordBatch:
        w = rows.column("_w")
        off = w.offsets.to_numpy()
        enc = w.values.slice(off[0], off[-1] - off[0]).dictionary_encode()
        idx = enc.indices.to_numpy(zero_copy_only=False).astype(np.int32)
        ends = (off[1:] - off[0]).astype(np.int32)
        df = np.zeros(0, np.int32)
        if doc_freq:
            doc = np.repeat(np.arange(len(ends)), np.diff(np.concatenate([[0], ends])))
            seen = np.unique(doc * np.int64(len(enc.dictionary) + 1) + idx)
            df = np.bincount(seen % (len(enc.dictionary) + 1), minlength=len(enc.dictionary)).astype(np.int32)
        wrap = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
        cols = [pa.array([uuid.uuid4().bytes], pa.binary()), wrap(enc.dictionary), wrap(pa.array(ends)), pa.array([_narrow(idx, len(enc.dictionary))], pa.binary()), wrap(pa.array(df))]
        return pa.RecordBatch.from_arrays(cols + [wrap(rows.column(k)) for k in keys], ["block", "words", "ends", "idx", "df", *keys])

    def part(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in it:
            off = rows.column("_w").offsets.to_numpy()
            lo = 0
            while lo < rows.num_rows:
                hi = max(lo + 1, int(np.searchsorted(off, off[lo] + BLOCK_TOKENS)))
                yield one(rows.slice(lo, hi - lo))
                lo = hi

    return cut(d.mapInArrow(part, T.StructType(fields)))


def distinct_words(b: DataFrame) -> DataFrame:
    return b.select(F.explode("words").alias("word")).distinct()


def word_values(words: DataFrame, fn: Callable[[list[str]], list], kind: str) -> DataFrame:
    """``word, value``: fn over lists of distinct words."""

    def part(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            w = pdf["word"].tolist()
            yield pd.DataFrame({"word": w, "value": fn(w)})

    return words.mapInPandas(part, f"word string, value {kind}")


@dataclass
class Attached:
    """Blocks with ``at, value`` of their rarer words, and the results of the frequent ones."""

    df: DataFrame
    words: pa.Array
    values: pa.Array


def hot_words(b: DataFrame) -> list[str]:
    """The words that stand in most of some blocks: at least two and a quarter of them."""
    n = b.count()
    some = b if n <= ASKED_BLOCKS else b.filter(F.pmod(F.xxhash64("block"), F.lit(n)) < ASKED_BLOCKS)
    counts = some.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= max(2, min(n, ASKED_BLOCKS) // 4))
    return [r[0] for r in counts.orderBy(F.desc("n"), "word").limit(HOT_WORDS).collect()]


def attach(b: DataFrame, words: DataFrame, values_of: Callable[[DataFrame], DataFrame]) -> Attached:
    """Blocks with the values of their words; values_of makes ``word, value`` of any rows of ``words``, which hold each distinct word once."""
    hot = b.sparkSession.createDataFrame([(w,) for w in hot_words(b)], "word string")
    table = values_of(words.join(F.broadcast(hot), "word", "left_semi")).select("word", "value").toArrow().combine_chunks()
    values = values_of(words.join(F.broadcast(hot), "word", "left_anti"))
    chunk = lambda name: pa.concat_arrays(c) if (c := table.column(name).chunks) else pa.array([], table.schema.field(name).type)
    x = b.select("block", F.posexplode("words").alias("i", "word")).join(F.broadcast(hot), "word", "left_anti").join(values, "word")
    per = x.groupBy("block").agg(F.collect_list(F.struct("i", "value")).alias("v"))
    per = per.select("block", F.transform("v", lambda s: s["i"]).alias("at"), F.transform("v", lambda s: s["value"]).alias("value"))
    return Attached(b.join(per, "block", "left"), chunk("word").cast(pa.string()), chunk("value"))


def _values(row: dict, words: pa.Array, values: pa.Array) -> pa.Array:
    """The values of a block's words, in their order, from its own and the broadcast ones."""
    own, at = row["value"], row.pop("at").to_numpy(zero_copy_only=False).astype(np.int64)
    mine = row.pop("words")
    place = pc.index_in(mine, words)
    hot = place.is_valid().to_numpy(zero_copy_only=False)
    where = np.zeros(len(mine), np.int64)
    where[hot] = len(own) + place.drop_null().to_numpy().astype(np.int64)
    where[at] = np.arange(len(at))
    both = pa.concat_arrays([own, values.cast(own.type)]) if len(values) else own
    return both.take(pa.array(where))


def per_block(a: Attached, fn: Callable[[dict], pa.RecordBatch], schema: str) -> DataFrame:
    """fn gets one block as a dict of Arrow arrays (list columns unpacked), with ``value`` for each of its words, and gives the rows of its documents."""
    bc = a.df.sparkSession.sparkContext.broadcast((a.words, a.values))  # HOT_WORDS entries at most

    def part(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, values = bc.value
        for rows in it:
            for r in range(rows.num_rows):
                row = {}
                for name, col in zip(rows.schema.names, rows.columns):
                    if pa.types.is_list(col.type):
                        row[name] = col.slice(r, 1).flatten()
                    else:
                        row[name] = col[r]
                row["value"] = _values(row, words, values)
                yield fn(row)

    return a.df.mapInArrow(part, schema)


def token_sums(row: dict, per_word: np.ndarray) -> np.ndarray:
    """Sum of a per-word number over the tokens of each document of a block."""
    idx, ends = positions(row), row["ends"].to_numpy()
    run = np.concatenate([[0], np.cumsum(per_word[idx])]) if len(idx) else np.zeros(1)
    return run[ends] - run[np.concatenate([[0], ends[:-1]])] if len(ends) else np.zeros(0)


__all__ = ["Attached", "attach", "blocks", "cut", "distinct_words", "per_block", "positions", "token_sums", "word_values"]
