"""Encoding a corpus with a public byte-level BPE vocabulary, and decoding it again.

Texts are split in Spark, each distinct word is encoded once, and ids go back to the tokens by position (wordtable).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import tokenizer, wordtable


def _encode_words(name: str, folder: str):
    def fn(words: list[str]) -> list[list[int]]:
        enc = tokenizer.byte_bpe(name, folder)
        return [enc.encode_ordinary(w) for w in words]

    return fn


def encode(docs: DataFrame, doc: str = "doc_id", text: str = "text", name: str = "byte_bpe_50k", folder: str = tokenizer.DEFAULT_DIR) -> DataFrame:
    """``doc_id, ids array<int>``: one row per input row; null and empty texts have the empty list.

    Special tokens in a text are ordinary text. Null ids and repeated rows are kept as they are.
    """
    b = wordtable.blocks(docs.select(F.col(doc).alias("doc_id"), F.col(text).alias("text")), ["doc_id"])

    def back(row: dict) -> pa.RecordBatch:
        idx, ends = wordtable.positions(row), row["ends"].to_numpy()
        lists = row["value"]
        if len(idx):
            off, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            size = np.diff(off)[idx]
            stop = np.cumsum(size, dtype=np.int64)
            ids = flat[np.repeat(off[:-1][idx] - (stop - size), size) + np.arange(stop[-1])]
            at = np.concatenate([[0], stop])[np.concatenate([[0], ends])]
        else:
            ids, at = np.zeros(0, np.int32), np.zeros(len(ends) + 1, np.int64)
        out = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))
        return pa.RecordBatch.from_arrays([row["doc_id"], out], ["doc_id", "ids"])

    kind = docs.schema[doc].dataType.simpleString()
    ids = lambda words: wordtable.word_values(words, _encode_words(name, folder), "array<int>")
    return wordtable.per_block(wordtable.attach(b, wordtable.distinct_words(b), ids), back, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, doc: str = "doc_id", ids: str = "ids", name: str = "byte_bpe_50k", folder: str = tokenizer.DEFAULT_DIR) -> DataFrame:
    """``doc_id, text``: ids joined to their pieces, pieces put together by position.

    The piece table is broadcast: its size is that of the vocabulary (about 50,000 rows). Empty lists give the empty text,
    null lists a null text, ids outside the vocabulary nothing. Pieces travel as hexadecimal digits, so that a text is put together once.
    """
    spark = encoded.sparkSession
    pieces = spark.createDataFrame([(i, p.hex()) for p, i in tokenizer.ranks(name, folder).items()], "id int, piece string")
    e = encoded.select(F.col(doc).alias("doc_id"), F.col(ids).alias("ids")).withColumn("row", F.monotonically_increasing_id())
    e = wordtable.cut(e.repartition("row"))  # the parts of a row stay in its task
    at = e.select("row", F.posexplode("ids").alias("pos", "id")).join(F.broadcast(pieces), "id")
    text = at.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("pos", "piece"))).alias("p"))
    text = text.select("row", F.decode(F.unhex(F.array_join(F.transform("p", lambda x: x["piece"]), "")), "UTF-8").alias("t"))
    return e.join(text, "row", "left").select("doc_id", F.when(F.col("ids").isNotNull(), F.coalesce("t", F.lit(""))).alias("text"))
