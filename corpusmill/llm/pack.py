"""Filling containers of fixed token capacity with documents that belong together.

Documents are sharded (bounded shards, sites kept together, large sites split by hash); every shard builds a BM25 inverted index over all terms that
stand in two documents or more, weighted with document frequencies of the whole corpus. The longest unused document seeds a container,
its best-scoring unused neighbours fill the window greedily, and what space is left goes to the longest unused document that fits.
Only documents longer than the capacity are cut: into full containers and a rest that is packed like a document.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import tokenizer, wordtable

#: Documents of a shard, about; a shard is one task's index.
SHARD_DOCS = 4096
#: Scores an index remembers; those beyond are computed again.
KEPT_SCORES = 20_000_000
K1, B = 1.2, 0.75


def _sharded(docs: DataFrame, doc: str, text: str, site: str | None) -> tuple[DataFrame, int, float]:
    """``doc_id, shard, text``, with the number of documents and their mean length in words of six characters."""
    d = docs.select(F.col(doc).alias("doc_id"), F.coalesce((F.col(site) if site else F.lit("")).cast("string"), F.lit("")).alias("site"), F.col(text).alias("text"))
    n_docs, mean_words = d.agg(F.count("*"), F.avg(F.coalesce(F.length("text"), F.lit(0)) / 6.0)).first()
    bins = max(1, round(n_docs / SHARD_DOCS))
    big = d.groupBy("site").agg(F.count("*").alias("n_site")).filter(F.col("n_site") >= SHARD_DOCS // 2)  # at most two a shard
    salt = F.pmod(F.xxhash64("doc_id"), F.greatest(F.lit(1), F.round(F.col("n_site") / SHARD_DOCS).cast("int")))
    shard = F.when(F.col("n_site").isNotNull(), F.concat_ws(":", F.lit("s"), "site", salt)).otherwise(F.concat(F.lit("m:"), F.pmod(F.xxhash64("site"), F.lit(bins))))
    return d.join(F.broadcast(big), "site", "left").select("doc_id", shard.alias("shard"), "text"), n_docs, float(mean_words or 1.0) or 1.0


def _terms(docs: DataFrame, doc: str, text: str, site: str | None, name: str, folder: str) -> DataFrame:
    """``doc_id, shard, n_tokens, terms, weights``: token counts and BM25 weights of all terms that others share, from one split of the texts."""
    d, n_docs, mean_words = _sharded(docs, doc, text, site)
    b = wordtable.blocks(d, ["doc_id", "shard"], doc_freq=True)
    freq = b.select(F.explode(F.arrays_zip("words", "df")).alias("z")).groupBy(F.col("z.words").alias("word")).agg(F.sum("z.df").alias("freq"))

    def count(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = tokenizer.byte_bpe(name, folder)
        for p in it:
            is_term = [w.strip().isalpha() for w in p["word"]]
            yield pd.DataFrame({"word": p["word"], "tokens": [len(enc.encode_ordinary(w)) for w in p["word"]], "freq": np.where(is_term, p["freq"], 0)})

    values_of = lambda words: words.mapInPandas(count, "word string, tokens int, freq bigint").select("word", F.struct("tokens", "freq", F.xxhash64("word").alias("term")).alias("value"))

    def back(row: dict) -> pa.RecordBatch:
        idx, ends, v = wordtable.positions(row), row["ends"].to_numpy(), row["value"]
        m = len(ends)
        if not len(v):
            empty = pa.ListArray.from_arrays(pa.array(np.zeros(m + 1), pa.int32()), pa.array([], pa.int64()))
            flat = pa.ListArray.from_arrays(pa.array(np.zeros(m + 1), pa.int32()), pa.array([], pa.float32()))
            return pa.RecordBatch.from_arrays([row["doc_id"], row["shard"], pa.array(np.zeros(m, np.int64)), empty, flat], ["doc_id", "shard", "n_tokens", "terms", "weights"])
        tok, fr, term = (v.field(k).to_numpy() for k in ("tokens", "freq", "term"))
        n_tokens = wordtable.token_sums(row, tok.astype(np.int64)).astype(np.int64)
        size = np.diff(np.concatenate([[0], ends]))
        code, tf = np.unique(np.repeat(np.arange(m), size) * np.int64(len(tok)) + idx, return_counts=True)
        dd, ww = code // len(tok), code % len(tok)
        idf = np.log(1 + (n_docs - fr[ww] + 0.5) / (fr[ww] + 0.5))
        wt = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[dd] / mean_words))
        ok = fr[ww] > 1  # a term of one document leads to no neighbour
        dd, ww, wt = dd[ok], ww[ok], wt[ok]
        off = pa.array(np.searchsorted(dd, np.arange(m + 1)), pa.int32())
        return pa.RecordBatch.from_arrays(
            [row["doc_id"], row["shard"], pa.array(n_tokens), pa.ListArray.from_arrays(off, pa.array(term[ww])), pa.ListArray.from_arrays(off, pa.array(wt.astype(np.float32)))],
            ["doc_id", "shard", "n_tokens", "terms", "weights"],
        )

    kind = docs.schema[doc].dataType.simpleString()
    return wordtable.per_block(wordtable.attach(b.drop("df"), freq, values_of), back, f"doc_id {kind}, shard string, n_tokens bigint, terms array<bigint>, weights array<float>")


class Index:
    """BM25 scores of all items of a shard for the terms of one of them; kept, as the same items are seeds of several capacities."""

    def __init__(self, terms: list[np.ndarray], weights: list[np.ndarray]):
        n = self.n = len(terms)
        lens = [len(t) for t in terms]
        flat = np.concatenate(terms) if n else np.zeros(0, np.int64)
        vocab, tid = np.unique(flat, return_inverse=True)
        order = np.argsort(tid, kind="stable")
        self.owner = np.repeat(np.arange(n), lens)[order]
        self.weight = (np.concatenate(weights).astype(np.float64) if n else np.zeros(0))[order]
        self.start = np.searchsorted(tid[order], np.arange(len(vocab) + 1))
        self.tid, self.at = tid, np.concatenate([[0], np.cumsum(lens)]).astype(int)
        self.known: dict[int, np.ndarray] = {}

    def scores(self, item: int) -> np.ndarray:
        got = self.known.get(item)
        if got is None:
            q = self.tid[self.at[item] : self.at[item + 1]]
            lo, size = self.start[q], self.start[q + 1] - self.start[q]
            at = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())
            got = np.bincount(self.owner[at], self.weight[at], self.n).astype(np.float32)
            if len(self.known) * self.n < KEPT_SCORES:
                self.known[item] = got
        return got


def fill(sizes: np.ndarray, scores: Callable[[int], np.ndarray], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Containers as lists of (item, start, length). Items of size 0 stay out."""
    out: list[list[tuple[int, int, int]]] = []
    n = len(sizes)
    full = np.maximum(0, (sizes - 1) // capacity)
    for i in np.nonzero(full)[0]:
        out += [[(int(i), int(k * capacity), capacity)] for k in range(full[i])]
    rest = sizes - full * capacity
    begin = full * capacity
    free = rest > 0
    by_size = sorted((int(rest[i]), i) for i in range(n) if free[i])  # shrinks as items are used
    gone = np.zeros(n, bool)

    def take_fitting(room: int) -> int | None:
        at = bisect.bisect_right(by_size, (room, n))
        while at:
            at -= 1
            i = by_size[at][1]
            if gone[i]:
                del by_size[at]
            else:
                del by_size[at]
                return i
        return None

    while True:
        seed = take_fitting(capacity)
        if seed is None:
            return out
        gone[seed] = True
        box, room = [(int(seed), int(begin[seed]), int(rest[seed]))], capacity - int(rest[seed])
        if room and by_size:
            score = scores(seed)
            who = np.nonzero((score > 0) & ~gone & (rest > 0) & (rest <= room))[0]
            while len(who):
                i = who[np.argmax(score[who])]
                box.append((int(i), int(begin[i]), int(rest[i])))
                gone[i] = True
                room -= int(rest[i])
                who = who[(rest[who] <= room) & ~gone[who]]
        while room > 0 and (i := take_fitting(room)) is not None:
            box.append((int(i), int(begin[i]), int(rest[i])))
            gone[i] = True
            room -= int(rest[i])
        out.append(box)


def pack(
    docs: DataFrame, capacities: DataFrame, doc: str = "doc_id", text: str = "text", site: str | None = "source", name: str = "byte_bpe_50k", folder: str = tokenizer.DEFAULT_DIR
) -> DataFrame:
    """``capacity_id, container_id, doc_id, piece_no, token_start, n_tokens``: where every document went, per capacity.

    A document is one piece unless it is longer than the capacity. Documents without tokens (null, empty) appear once per capacity with a
    NULL container and 0 tokens. Capacities that are NULL or below 1 are left out. Doc ids need not be unique.
    """
    spark = docs.sparkSession
    caps = [(r[0], int(r[1])) for r in capacities.select("capacity_id", "capacity_tokens").distinct().filter("capacity_tokens >= 1").limit(101).collect()]
    if len(caps) > 100:
        raise ValueError("more than 100 capacities")
    caps.sort()
    kind = docs.schema[doc].dataType.simpleString()
    schema = f"capacity_id bigint, container_id string, doc_id {kind}, piece_no int, token_start bigint, n_tokens bigint"
    if not caps:
        return spark.createDataFrame([], schema)
    items = _terms(docs, doc, text, site, name, folder)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_tokens", "doc_id"], kind="stable").reset_index(drop=True)
        sizes = pdf["n_tokens"].to_numpy(np.int64)
        index = Index([np.asarray(t, np.int64) for t in pdf["terms"]], [np.asarray(t, np.float32) for t in pdf["weights"]])
        tag, rows = pdf["shard"].iloc[0], []
        for cid, cap in caps:
            for k, box in enumerate(fill(sizes, index.scores, cap)):
                rows += [(cid, f"{tag}/{k}", i, start // cap, start, length) for i, start, length in box]
            rows += [(cid, None, int(i), 0, 0, 0) for i in np.nonzero(sizes == 0)[0]]
        out = pd.DataFrame(rows, columns=["capacity_id", "container_id", "i", "piece_no", "token_start", "n_tokens"])
        out["doc_id"] = pdf["doc_id"].to_numpy()[out.pop("i").to_numpy(int)]
        return out[["capacity_id", "container_id", "doc_id", "piece_no", "token_start", "n_tokens"]]

    return items.groupBy("shard").applyInPandas(one, schema)


def fill_report(packed: DataFrame, capacities: DataFrame) -> DataFrame:
    """``capacity_id, n_containers, n_tokens, fill``: share of the containers' room that is used."""
    c = packed.filter("container_id is not null").groupBy("capacity_id").agg(F.countDistinct("container_id").alias("n_containers"), F.sum("n_tokens").alias("n_tokens"))
    return c.join(F.broadcast(capacities.select("capacity_id", "capacity_tokens").distinct().limit(101)), "capacity_id").select(
        "capacity_id", "n_containers", "n_tokens", (F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens"))).alias("fill")
    )
