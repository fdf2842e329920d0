"""Texts of evaluation splits that also stand, the same or lightly edited, in the training split.

Texts become word sequences (case, accents, punctuation, spacing and invisible characters do not count) and exact copies
collapse to classes. An evaluation sequence of n words is cut into disjoint segments; as long as no more words change than
k = floor(MAX_EDITS n), any k + 1 of its segments hold one, and any k + 2 of them two, that stand unchanged in the training sequence, not further from
its place than moved words can shift it. Which k + 2 are matched is free, so the segments are counted among the training
substrings and the rarest are taken: sentence forms that very many texts share are left aside without losing a pair. The chosen
segments are joined with the training substrings at the allowed positions, and candidates are verified by banded
dynamic programming over words, many pairs at a time.

Training substrings are held back by a bitmap of the wanted keys (of bounded size; it only saves work) before anything is shuffled.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.bitmap import key_filter, passes
from corpusmill.llm.wordtable import cut

#: Segment length in words; texts of SHORTEST words or one more have shorter ones, still shorter texts only pair when they are equal.
SEGMENT, SHORT_SEGMENT, SHORTEST = 4, 3, 6
#: Share of the words that may be changed, added or missing, and share that may stand elsewhere (passages are moved as a whole).
MAX_EDITS, MAX_MOVED = 0.15, 0.25
#: Up to LONG words, segments enough for a fifth of broken ones are matched: in short texts moved words, which break two each, weigh more.
LONG, MOVED_SHORT = 64, 0.2
#: Numbers that a batch of verified pairs holds in a row of the table.
CELLS = 1 << 21


@lru_cache(maxsize=2)
def _ignored(lo: int, hi: int) -> re.Pattern:
    """Marks and format characters of a range; a class within the first plane is one look-up a character."""
    return re.compile("[" + "".join(re.escape(chr(c)) for c in range(lo, hi) if unicodedata.category(chr(c)) in ("Mn", "Cf")) + "]+")


_WORD = re.compile(r"[^\W_]+")


def word_list(text: str) -> list[str]:
    if text.isascii():
        return _WORD.findall(text.lower())
    t = _ignored(0, 1 << 16).sub("", unicodedata.normalize("NFKD", text).casefold())
    return _WORD.findall(_ignored(1 << 16, sys.maxunicode + 1).sub("", t) if max(t, default="") > "\uffff" else t)


_HASH: dict[str, int] = {}


def _word_ids(words: list[str]) -> np.ndarray:
    """32-bit hashes of words."""
    import xxhash

    if len(_HASH) > 2_000_000:
        _HASH.clear()
    for w in words:
        if w not in _HASH:
            _HASH[w] = xxhash.xxh3_64_intdigest(w) & 0x7FFFFFFF
    return np.fromiter((_HASH[w] for w in words), np.int32, len(words))


def _windows(ids: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    acc = np.full(n, size, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            acc = (acc ^ ids[j : j + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            acc ^= acc >> np.uint64(29)
    return acc.astype(np.int64)


def most_broken(n: int) -> int:
    """How many segments of a text of n words edits may break (a training text may be longer by them)."""
    return int((MOVED_SHORT * n if n <= LONG else MAX_EDITS * int(n / (1 - MAX_EDITS) + 1e-9)) + 1e-9)


def _keys(flat: np.ndarray, off: np.ndarray, side: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, row, position) of all segments (side b) or substrings (side a) of the sequences ``flat[off[r] : off[r + 1]]``."""
    size = np.diff(off)
    row = np.repeat(np.arange(len(size)), size)
    pos = np.arange(len(flat)) - off[:-1][row]
    n = size[row]
    keys, rows, at = [], [], []
    for q in (SEGMENT, SHORT_SEGMENT):
        w = _windows(flat, q)
        p, m = pos[: len(w)], n[: len(w)]
        if side == "b":
            ok = (p % q == 0) & ((m > SHORTEST + 1) if q == SEGMENT else (m >= SHORTEST) & (m <= SHORTEST + 1))
        else:
            ok = (m > SHORTEST) if q == SEGMENT else (m >= SHORTEST) & (m <= SHORTEST + 2)
        ok &= p + q <= m
        keys.append(w[ok])
        rows.append(row[: len(w)][ok])
        at.append(p[ok])
    return np.concatenate(keys), np.concatenate(rows), np.concatenate(at)


def _sequences(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word ids of a binary column, one behind the other, and where each row begins."""
    off = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    if off[-1] == off[0]:
        return np.zeros(0, np.int32), off * 0
    return np.frombuffer(col.buffers()[2], np.uint8)[off[0] : off[-1]].view("<i4"), (off - off[0]) // 4


def banded_distance(a: list[np.ndarray], b: list[np.ndarray], limit: np.ndarray, band: np.ndarray | None = None) -> np.ndarray:
    """Word edit distances of many pairs at once, exact up to each pair's limit, larger than it beyond.

    Cell (i, d) compares the first i words of a with the first i + d - K of b, in a band of K on both sides (the limit, or the largest
    ``band``: then exact where no path leaves it, never too small). A whole row of all pairs is one step; insertions along a row are a running minimum.
    """
    m = len(a)
    if not m:
        return np.zeros(0, np.int64)
    K = int((limit if band is None else band).max()) + 1
    la, lb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    A = np.full((m, max(1, la.max())), -1, np.int64)
    B = np.full((m, max(1, lb.max()) + 2 * K + la.max() + 1), -2, np.int64)
    for r in range(m):
        A[r, : la[r]] = a[r]
        B[r, K : K + lb[r]] = b[r]
    width, big = 2 * K + 1, 1 << 29
    off = np.arange(width) - K
    cur = np.where(off >= 0, off, big)[None, :].repeat(m, 0).astype(np.int64)
    cur = np.where(off[None, :] > lb[:, None], big, cur)
    out = np.where((la == 0) & (lb <= K), lb, big).astype(np.int64)
    for i in range(1, int(la.max()) + 1):
        sub = cur + (B[:, i - 1 : i - 1 + width] != A[:, i - 1 : i])
        dele = np.concatenate([cur[:, 1:], np.full((m, 1), big)], 1) + 1
        new = np.minimum(sub, dele)
        j = i + off
        new[:, j < 0] = big
        new = np.where(j[None, :] > lb[:, None], big, new)
        if 0 <= K - i:
            new[:, K - i] = i
        new = np.minimum.accumulate(new - off[None, :], 1) + off[None, :]
        new = np.where((j[None, :] > lb[:, None]) | (j[None, :] < 0), big, new)
        cur = new
        done = la == i
        if done.any():
            d = lb - i + K
            ok = done & (d >= 0) & (d < width)
            out[ok] = cur[ok, d[ok]]
    return out


def _same_words(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the multisets of words differ by few enough; cheap, and necessary for any light edit."""
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    common = np.minimum(ca[ia], cb[ib]).sum()
    return max(len(a), len(b)) - common <= MAX_EDITS * max(len(a), len(b))


def _trimmed(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without their common beginning and end, which no distance needs."""
    n = min(len(a), len(b))
    diff = np.flatnonzero(a[:n] != b[:n])
    lo = diff[0] if len(diff) else n
    diff = np.flatnonzero(a[::-1][: n - lo] != b[::-1][: n - lo])
    hi = diff[0] if len(diff) else n - lo
    return a[lo : len(a) - hi], b[lo : len(b) - hi]


def light_edits(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Edit distance of every pair that is a light edit, -1 for the others.

    Two sequences are one when at most MAX_EDITS of the longer one's words are no common words (whatever their places), and the edit
    distance, in which a moved word counts as a missing and an added one, is at most twice MAX_MOVED. The band is as wide as moved words can shift others.
    """
    out = np.full(len(a), -1, np.int64)
    longest = np.array([max(len(x), len(y)) for x, y in zip(a, b)], np.int64)
    keep = [i for i in np.argsort(longest, kind="stable") if _same_words(a[i], b[i])]
    at = 0
    while at < len(keep):
        end = at + 1
        while end < len(keep) and (end + 1 - at) * longest[keep[end]] <= CELLS:
            end += 1
        who = keep[at:end]
        cut_ = [_trimmed(a[i], b[i]) for i in who]
        limit = np.floor(2 * MAX_MOVED * longest[who] + 1e-9).astype(int)
        d = banded_distance([x for x, _ in cut_], [y for _, y in cut_], limit, np.floor(MAX_MOVED * longest[who] + 1e-9).astype(int))
        for i, x, top in zip(who, d, limit):
            if x <= top:
                out[i] = x
        at = end
    return out


def _verify(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in it:
        words = [np.frombuffer(x.as_buffer(), "<i4") for c in ("wa", "wb") for x in rows.column(c)]
        n = rows.num_rows
        d = light_edits(words[:n], words[n:])
        ok = pa.array(d >= 0)
        yield pa.RecordBatch.from_arrays([rows.column("ca").filter(ok), rows.column("cb").filter(ok), pa.array(d[d >= 0])], ["ca", "cb", "distance"])


def _parsed(rows: DataFrame) -> DataFrame:
    """``row, id, side, cls, ids``: records with a number, the class of their word sequence (texts without any word: of the text) and its word ids."""

    def part(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        for batch in it:
            keep, cls, ids = [], [], []
            for r, t in enumerate(batch.column("text").to_pylist()):
                w = word_list(t)
                if not w and not t.strip():
                    continue
                keep.append(r)
                cls.append(xxhash.xxh3_128_digest("\x1f".join(w) if w else "\x1e" + "".join(t.split())))
                ids.append(_word_ids(w).tobytes())
            take = pa.array(keep, pa.int32())
            number = pa.array(np.arange(row, row + len(keep)), pa.int64())
            row += len(keep)
            yield pa.RecordBatch.from_arrays([number, batch.column("id").take(take), batch.column("side").take(take), pa.array(cls, pa.binary()), pa.array(ids, pa.binary())], ["row", "id", "side", "cls", "ids"])

    return rows.mapInArrow(part, "row bigint, id string, side string, cls binary, ids binary")


def _spread(classes: DataFrame, side: str, wanted: np.ndarray | None = None, only_keys: bool = False) -> DataFrame:
    """``c<side>, n<side>, key, p<side>`` of all segments or substrings (or their keys alone) that pass the bitmap."""
    bc = classes.sparkSession.sparkContext.broadcast(wanted) if wanted is not None else None  # of bounded size

    def part(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in it:
            flat, off = _sequences(rows.column("ids"))
            key, row, pos = _keys(flat, off, side)
            if bc is not None:
                ok = passes(bc.value, key)
                key, row, pos = key[ok], row[ok], pos[ok]
            cols = {"key": pa.array(key)}
            if not only_keys:
                cols |= {"c" + side: rows.column("cls").take(pa.array(row)), "n" + side: pa.array(np.diff(off)[row].astype(np.int32)), "p" + side: pa.array(pos.astype(np.int32))}
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    return classes.select("cls", "ids").mapInArrow(part, "key bigint" + ("" if only_keys else f", c{side} binary, n{side} int, p{side} int"))


def _broken(n: Column) -> Column:
    """``most_broken`` as a column."""
    return F.floor(F.when(n <= LONG, n * MOVED_SHORT).otherwise(F.floor(n / (1 - MAX_EDITS) + 1e-9) * MAX_EDITS) + 1e-9)


def candidates(a: DataFrame, b: DataFrame) -> DataFrame:
    """``ca, cb``: pairs of classes (``cls, ids`` each) with enough of the evaluation text's rarest segments in common, at allowed places.

    With k segments that edits may break, k + 2 are matched and two of them have to agree; where a text has but k + 1, one.
    """
    n_keys = b.agg(F.coalesce(F.sum(F.length("ids") / 4 / SEGMENT), F.lit(0))).first()[0]
    wanted = key_filter(b.select("ids"), lambda rows: _keys(*_sequences(rows.column("ids")), "b")[0], int(n_keys))
    freq = _spread(a, "a", wanted, only_keys=True).groupBy("key").agg(F.count("*").alias("freq"))
    seg = _spread(b, "b").join(freq, "key")  # segments that stand nowhere in training are the rarest: they fill the choice first, and match nothing
    of = seg.groupBy("cb", "nb").agg(F.sort_array(F.collect_list(F.struct("freq", "key", "pb"))).alias("s"))  # a text's own segments
    total = F.floor(F.col("nb") / F.when(F.col("nb") > SHORTEST + 1, SEGMENT).otherwise(SHORT_SEGMENT))
    of = of.withColumn("want", F.least(total, _broken(F.col("nb")) + 2)).withColumn("least", F.greatest(F.col("want") - _broken(F.col("nb")), F.lit(1)).cast("int"))
    left = F.greatest(F.col("want") - (total - F.size("s")), F.lit(0)).cast("int")
    chosen = of.select("cb", "nb", "least", F.explode(F.slice("s", F.lit(1), left)).alias("s")).select("cb", "nb", "least", "s.key", "s.pb")
    chosen = cut(chosen)
    again = key_filter(chosen.select("key"), lambda rows: rows.column("key").to_numpy(zero_copy_only=False), chosen.count())
    sub = _spread(a, "a", again)
    longer = F.greatest("na", "nb")
    near = (F.abs(F.col("pa") - F.col("pb")) <= longer * MAX_MOVED + 1) & (F.abs(F.col("na") - F.col("nb")) <= longer * MAX_EDITS) & (F.col("ca") != F.col("cb"))
    hits = chosen.join(sub, "key").filter(near).select("ca", "cb", "least", "pb").distinct()
    return hits.groupBy("ca", "cb", "least").agg(F.count("*").alias("n")).filter(F.col("n") >= F.col("least")).select("ca", "cb")


def class_links(docs: DataFrame, id: str = "id", text: str = "text", split: str = "split", train: str = "train", evaluation: tuple[str, ...] = ("val", "test")) -> tuple[DataFrame, DataFrame]:
    """(members, links): records with their class, and pairs of an evaluation class with a training class
    that are equal (distance 0) or lightly edited."""
    rows = docs.select(F.col(id).cast("string").alias("id"), F.when(F.col(split) == train, "a").when(F.col(split).isin(*evaluation), "b").alias("side"), F.col(text).alias("text"))
    parsed = cut(_parsed(rows.filter("side is not null and id is not null and length(text) > 0")))
    # one record stands for each class; only classes with copies have to be looked up, and a group of copies is counted before it is shuffled
    copies = parsed.groupBy("side", "cls").agg(F.min("row").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    one = parsed.filter("length(ids) > 0").join(copies, ["side", "cls"], "left").filter("first is null or first = row").select("side", "cls", "ids")
    one = cut(one)
    a, b = (one.filter(F.col("side") == s).select("cls", "ids") for s in "ab")
    pairs = candidates(a, b).join(a.select(F.col("cls").alias("ca"), F.col("ids").alias("wa")), "ca").join(b.select(F.col("cls").alias("cb"), F.col("ids").alias("wb")), "cb")
    edited = pairs.mapInArrow(_verify, "ca binary, cb binary, distance bigint").distinct()
    members = parsed.select("id", "side", "cls").distinct()
    cls = lambda s: members.filter(F.col("side") == s).select(F.col("cls").alias("c" + s)).distinct()
    equal = cls("a").join(cls("b"), F.col("ca") == F.col("cb")).select("ca", "cb", F.lit(0).cast("bigint").alias("distance"))
    return members, equal.unionByName(edited)


def pairs(docs: DataFrame, **how) -> DataFrame:
    """``id_a, id_b, train_id, eval_id, distance``: every pair of a training and an evaluation record, smaller id first.

    Null and empty texts, null ids and other splits give no rows; records repeated in full count once; equal texts without
    any word (punctuation only) pair when they are equal but for white space.
    """
    members, links = class_links(docs, **how)
    a = members.filter("side = 'a'").select(F.col("cls").alias("ca"), F.col("id").alias("train_id"))
    b = members.filter("side = 'b'").select(F.col("cls").alias("cb"), F.col("id").alias("eval_id"))
    p = links.join(a, "ca").join(b, "cb")
    return p.select(F.least("train_id", "eval_id").alias("id_a"), F.greatest("train_id", "eval_id").alias("id_b"), "train_id", "eval_id", "distance").distinct()


def found(docs: DataFrame, **how) -> DataFrame:
    return pairs(docs, **how).select("id_a", "id_b").distinct()


def report(docs: DataFrame, source: str = "source", **how) -> DataFrame:
    """``split, source, train_source, n_pairs, n_eval, n_exact``: overlaps per evaluation split and source."""
    idc, split = how.get("id", "id"), how.get("split", "split")
    meta = docs.select(F.col(idc).cast("string").alias("id"), F.col(split).alias("split"), F.col(source).alias("source")).distinct()
    p = pairs(docs, **how)
    p = p.join(meta.select(F.col("id").alias("eval_id"), "split", "source"), "eval_id").join(meta.select(F.col("id").alias("train_id"), F.col("source").alias("train_source")), "train_id")
    return p.groupBy("split", "source", "train_source").agg(F.count("*").alias("n_pairs"), F.countDistinct("eval_id").alias("n_eval"), F.count_if(F.col("distance") == 0).alias("n_exact"))


__all__ = ["banded_distance", "class_links", "found", "light_edits", "most_broken", "pairs", "report", "word_list"]
