"""Token counts per document and token budgets per slice.

Every distinct word of the word table is counted once, by a Viterbi pass over a double-array trie of the vocabulary's pieces that keeps only
the length of the best path per end. Unigram vocabularies weigh paths by their pieces' scores. A byte-level BPE vocabulary has no scores: there
a path is right if no two neighbours would merge otherwise, which exactly one path is, so the same pass gives the tokenizer's own counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import tokenizer, wordtable
from corpusmill.llm.common import recorded_language, row_key, site_of, words_of


class DoubleArrayTrie:
    """Pieces as byte strings in two integer arrays: state s goes by byte b to ``base[s] + b + 1`` if ``check`` there is s."""

    def __init__(self, pieces: list[bytes], scores: list[float]):
        tree: list[dict[int, int]] = [{}]
        leaf: dict[int, int] = {}
        for n, p in enumerate(pieces):
            at = 0
            for b in p:
                nxt = tree[at].get(b)
                if nxt is None:
                    nxt = tree[at][b] = len(tree)
                    tree.append({})
                at = nxt
            if at and (at not in leaf or scores[n] > scores[leaf[at]]):
                leaf[at] = n
        size = 2 * len(tree) + 600
        base, check, piece = [0] * size, [-1] * size, [-1] * size
        check[0] = 0
        place, free, high, todo = {0: 0}, 257, 257, [0]  # lower slots would fit too few bytes
        for node in todo:
            kids = sorted(tree[node].items())
            if not kids:
                continue
            while check[free] != -1:
                free += 1
            # single children fill the first gap and larger families go behind all others: no search
            b = max(0, (free if len(kids) == 1 else high + 1) - kids[0][0] - 1)
            while True:
                if b + 258 > len(check):
                    n = len(check)
                    base += [0] * n
                    check += [-1] * n
                    piece += [-1] * n
                if all(check[b + k + 1] == -1 for k, _ in kids):
                    break
                b += 1
            base[place[node]] = b
            for k, child in kids:
                at = b + k + 1
                check[at], place[child], high = place[node], at, max(high, at)
                piece[at] = leaf.get(child, -1)
                todo.append(child)
        self.base, self.check, self.piece = base, check, piece
        self.scores = scores
        self.unknown = (min(scores) if scores else 0.0) - 10.0

    def pieces_from(self, text: bytes, at: int) -> list[tuple[int, int]]:
        """(end, piece) of every piece that begins at a place, shortest first."""
        base, check, piece, out, s = self.base, self.check, self.piece, [], 0
        for j in range(at, len(text)):
            t = base[s] + text[j] + 1
            if t >= len(check) or check[t] != s or t == 0:
                break
            s = t
            if piece[s] >= 0:
                out.append((j + 1, piece[s]))
        return out

    def count(self, word: str) -> int:
        """Pieces on the best path over one segment; a character that no piece covers counts as one unknown piece."""
        text = word.encode()
        n = len(text)
        best = [-1e300] * (n + 1)
        best[0] = 0.0
        steps = [0] * (n + 1)
        for i in range(n):
            here = best[i]
            if here == -1e300 or text[i] & 0xC0 == 0x80:
                continue
            width = 1 + (text[i] >= 0xC0) + (text[i] >= 0xE0) + (text[i] >= 0xF0)
            if here + self.unknown > best[i + width]:
                best[i + width], steps[i + width] = here + self.unknown, steps[i] + 1
            for end, p in self.pieces_from(text, i):
                v = here + self.scores[p]
                if v > best[end]:
                    best[end], steps[end] = v, steps[i] + 1
        return steps[n]


class MergePaths:
    """Token counts of a byte-level BPE vocabulary by the same pass over the trie, without merging a word.

    In place of scores, two pieces may follow each other on a path if merging their bytes leaves just these two. Every prefix of a word has
    exactly one path of such pieces, and it is the tokenizer's: so the pass keeps, per end, the one last piece whose neighbour on the left is the last
    piece of the path before it. Whether two pieces may meet is found out once per pair.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.bytes = [p for p, _ in sorted(ranks.items(), key=lambda x: x[1])]
        self.ranks = ranks
        self.trie = DoubleArrayTrie(self.bytes, [0.0] * len(self.bytes))
        self.meet: dict[tuple[int, int], bool] = {}  # -1: nothing on the left

    def _merged(self, text: bytes) -> list[bytes]:
        """Merges of lowest rank first, over the bytes of two pieces."""
        parts, rank = [text[i : i + 1] for i in range(len(text))], self.ranks
        while len(parts) > 1:
            at = min(range(len(parts) - 1), key=lambda i: rank.get(parts[i] + parts[i + 1], 1 << 40))
            if parts[at] + parts[at + 1] not in rank:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def may_meet(self, a: int, b: int) -> bool:
        ok = self.meet.get((a, b))
        if ok is None:
            if len(self.meet) > 5_000_000:
                self.meet.clear()
            x, y = [self.bytes[a]] if a >= 0 else [], self.bytes[b]
            ok = self.meet[a, b] = self._merged(b"".join(x) + y) == [*x, y]
        return ok

    def count(self, word: str) -> int:
        """Tokens of one segment of the split."""
        text = word.encode()
        n = len(text)
        last, steps = [-1] * (n + 1), [0] * (n + 1)
        if text in self.ranks:  # a segment that is a piece is one token
            return 1
        for i in range(n):
            left = last[i]
            if i and left < 0:
                continue
            for end, p in self.trie.pieces_from(text, i):
                if last[end] < 0 and self.may_meet(left, p):
                    last[end], steps[end] = p, steps[i] + 1
        return steps[n]


_TRIES: dict[tuple[str, str], DoubleArrayTrie | MergePaths] = {}


def _path_counts(name: str, folder: str):
    def fn(words: list[str]) -> list[int]:
        paths = _TRIES.get((name, folder))
        if paths is None:
            paths = _TRIES[name, folder] = MergePaths(tokenizer.ranks(name, folder))
        return [paths.count(w) for w in words]

    return fn


def _unigram_counts(name: str, folder: str):
    """Segments are words with their leading blank as the piece vocabularies' blank mark; other white space counts nothing."""

    def fn(words: list[str]) -> list[int]:
        trie = _TRIES.get((name, folder))
        if trie is None:
            pieces, scores = tokenizer.pieces(name, folder)
            keep = [(p.encode(), s) for p, s in zip(pieces, scores) if not (p.startswith("<") and p.endswith(">") and len(p) > 2)]
            if all(float(s).is_integer() for _, s in keep):
                raise ValueError(f"{name} has merge ranks and no scores: it is no unigram vocabulary")
            trie = _TRIES[name, folder] = DoubleArrayTrie([p for p, _ in keep], [s for _, s in keep])
        return [trie.count(w.replace(" ", "▁")) if w.strip() else 0 for w in words]

    return fn


def token_counts(docs: DataFrame, keys: list[str], text: str = "text", vocabulary: str = "byte_bpe_50k", kind: str = "bpe", folder: str = tokenizer.DEFAULT_DIR) -> DataFrame:
    """``<keys>, n_tokens``: one row per input row, without special tokens; null and empty texts have 0 tokens."""
    fn = {"bpe": _path_counts, "unigram": _unigram_counts}[kind](vocabulary, folder)
    b = wordtable.blocks(docs, keys, text)

    def back(row: dict) -> pa.RecordBatch:
        per_word = row["value"].to_numpy(zero_copy_only=False).astype(np.int64) if len(row["value"]) else np.zeros(0, np.int64)
        n = wordtable.token_sums(row, per_word).astype(np.int64)
        return pa.RecordBatch.from_arrays([*(row[k] for k in keys), pa.array(n)], [*keys, "n_tokens"])

    schema = ", ".join(f"{k} {docs.schema[k].dataType.simpleString()}" for k in keys)
    return wordtable.per_block(wordtable.attach(b, wordtable.distinct_words(b), lambda words: wordtable.word_values(words, fn, "int")), back, schema + ", n_tokens bigint")


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select(
        "document_id", "text", F.col("metadata.token_count").cast("bigint").alias("recorded"), F.size(words_of("text")).alias("n_words"),
        F.col("metadata.dump").alias("dump"), recorded_language("metadata.language").alias("lang_code"), site_of("metadata.url").alias("site"), row_key(docs).alias("k"),
    )


def untrusted(docs: DataFrame, min_words: int = 20, factor: float = 2.0, **how) -> DataFrame:
    """``document_id`` of texts of at least ``min_words`` words whose recorded token count is null, not positive, or more than
    ``factor`` times or less than 1/``factor`` of the counted tokens. Repeated rows give one row; null texts none."""
    d = _slim(docs).filter(F.col("n_words") >= min_words).select("document_id", "text", "recorded")
    n = token_counts(d, ["document_id", "recorded"], **how)
    bad = F.col("recorded").isNull() | (F.col("recorded") <= 0) | (F.col("recorded") > F.col("n_tokens") * factor) | (F.col("recorded") * factor < F.col("n_tokens"))
    return n.filter(bad).select("document_id").distinct()


def budget(docs: DataFrame, **how) -> DataFrame:
    """``dump, lang_code, site, n_docs, n_tokens, recorded_tokens``: counted and recorded tokens of every slice.

    Rows repeated in full count once; missing dumps, languages and sites form slices of their own (NULL).
    """
    keys = ["dump", "lang_code", "site", "recorded", "k", "document_id"]
    n = token_counts(_slim(docs), keys, **how).dropDuplicates(["document_id", "k"])
    return n.groupBy("dump", "lang_code", "site").agg(
        F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), F.sum(F.when(F.col("recorded") > 0, F.col("recorded"))).alias("recorded_tokens")
    )
