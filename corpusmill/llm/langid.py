"""Language of documents and of the lines in them, by words first and character n-grams behind them.

A word that the model knows is scored by its log relative frequency in each language. A word that it doesn't know is scored
by the mean over its longest character n-grams that the model knows (5 down to 1), so invented and rare words still point to a language.
Every distinct word is scored once (wordtable); documents and lines are sums over their tokens. The model is trained on a
bounded sample of labelled rows; everything else runs over all texts.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import wordtable
from corpusmill.llm.common import recorded_language

#: Bound of the training sample: about this many labelled documents of each label, chosen by a hash of the id.
SAMPLE_DOCS = 250
#: Documents that a label needs to be learnt, and bound of the labels; more are rejected, never cut.
LEAST_DOCS, MAX_LABELS = 4, 300
MAX_N = 5
#: A line counts as foreign when its words favour its language over the document's by this much (log10, summed).
LINE_MARGIN = 3.0
#: Log10 relative frequency of what a language doesn't have.
FLOOR = -7.0


@dataclass
class Model:
    languages: tuple[str, ...]
    words: dict[str, np.ndarray]
    grams: list[dict[str, np.ndarray]]  # by length, from 1

    def score(self, word: str) -> np.ndarray:
        hit = self.words.get(word)
        if hit is not None:
            return hit
        padded = f" {word} "
        for n in range(min(MAX_N, len(padded)), 0, -1):
            table = self.grams[n - 1]
            rows = [v for i in range(len(padded) - n + 1) if (v := table.get(padded[i : i + n])) is not None]
            if rows:
                return np.mean(rows, axis=0)
        return np.full(len(self.languages), FLOOR, np.float32)


def _log_table(counts: list[Counter], least: int) -> dict[str, np.ndarray]:
    total = [max(1, sum(c.values())) for c in counts]
    keep = Counter()
    for c in counts:
        keep.update(c)
    out = {}
    for w, n in keep.items():
        if n >= least:
            out[w] = np.array([max(FLOOR, math.log10(c[w] / t)) if c[w] else FLOOR for c, t in zip(counts, total)], np.float32)
    return out


def _letters(text: str) -> list[str]:
    import regex

    return regex.findall(r"\p{L}+", text.lower())


def _model(data: list[tuple[int, list[str]]], languages: tuple[str, ...]) -> Model:
    words, docs = [Counter() for _ in languages], Counter()
    grams = [[Counter() for _ in languages] for _ in range(MAX_N)]
    for lab, ws in data:
        words[lab].update(ws)
        docs.update(set(ws))
    for lab, c in enumerate(words):
        for w, n in c.items():
            p = f" {w} "
            for k in range(1, MAX_N + 1):
                g = grams[k - 1][lab]
                for i in range(len(p) - k + 1):
                    g[p[i : i + k]] += n
    for c in words:  # a word of fewer than three documents is left to its n-grams
        for w in [w for w in c if docs[w] < 3]:
            del c[w]
    return Model(languages, _log_table(words, 1), [_log_table(g, 2) for g in grams])


def _best(model: Model, words: list[str]) -> int:
    return int(np.argmax(sum(n * model.score(w) for w, n in Counter(words).items())))


def fit(samples: list[tuple[str, str]]) -> Model:
    """Model of (label, text) pairs, with the languages that the labels name.

    Each half of the texts is told by a model of the other half. A label most of whose texts are told to be something else names no language
    (``und``, ``unknown``) and is left out, and so are single texts that are told otherwise; the model is made of the others.
    """
    names = tuple(sorted({lab for lab, t in samples if t}))
    at = {x: i for i, x in enumerate(names)}
    data = [(at[lab], ws) for lab, t in samples if t and (ws := _letters(t))]
    halves = [data[::2], data[1::2]]
    models = [_model(h, names) for h in halves]
    told = [(lab, ws, _best(models[1 - i], ws)) for i, h in enumerate(halves) for lab, ws in h]
    texts, right = Counter(lab for lab, _, _ in told), Counter(lab for lab, _, best in told if lab == best)
    real = [i for i in range(len(names)) if 2 * right[i] >= texts[i] > 0]
    new = {old: i for i, old in enumerate(real)}
    return _model([(new[lab], ws) for lab, ws, best in told if lab == best and lab in new], tuple(names[i] for i in real))


def training_sample(docs: DataFrame, bound: int = SAMPLE_DOCS, doc: str = "document_id", text: str = "text", language: str = "metadata.language") -> list[tuple[str, str]]:
    """(label, text) of about ``bound`` documents of every label that ``LEAST_DOCS`` documents have."""
    d = docs.select(F.col(doc).alias("id"), F.col(text).alias("text"), recorded_language(language).alias("lab")).filter("lab is not null and length(text) > 0")
    n = d.groupBy("lab").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_DOCS).limit(MAX_LABELS + 1).collect()
    if len(n) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} language labels")
    if not n:
        return []
    share = F.create_map(*[x for r in n for x in (F.lit(r["lab"]), F.lit(min(1 << 20, int(bound * (1 << 20) / r["n"]) + 1)))])
    rows = d.filter(F.pmod(F.xxhash64("id", F.lit("langid")), F.lit(1 << 20)) < share[F.col("lab")]).select("lab", "text").collect()
    return sorted((r["lab"], r["text"]) for r in rows)


def _word_scores(bc):
    def fn(words: list[str]) -> list[list[float]]:
        model, out = bc.value, []
        for w in words:
            w = w.strip().lower()
            out.append(model.score(w).tolist() if w.isalpha() and model.languages else [])
        return out

    return fn


def _confidence(scores: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Softmax over mean log scores, sharpened with the number of words (at most 20)."""
    mean = scores / np.maximum(n_words, 1)[:, None]
    z = (mean - mean.max(1, keepdims=True)) * np.log(10) * np.minimum(n_words, 20)[:, None] / 4
    return 1 / np.exp(z).sum(1)


def segments(docs: DataFrame, keys: list[str], text: str = "text", model: Model | None = None, doc: str = "document_id", language: str = "metadata.language") -> DataFrame:
    """``<keys>, line_no, lang_code, confidence, n_words, doc_lang, doc_words, margin``: line 0 is the document, the others its lines with words.

    The document's language is the one of most of its words, each counted with its line (lines of fewer than four scored
    words only count if there are no longer ones). Without any scored word lang_code is NULL and confidence 0.
    n_words counts pieces between white space; margin is a line's log10 advantage over doc_lang, 0 where fewer than half of its
    pieces are words. Null and empty texts have line 0 only.
    """
    if model is None:
        model = fit(training_sample(docs, doc=doc, text=text, language=language))
    bc = docs.sparkSession.sparkContext.broadcast(model)  # bounded with the training sample
    flat = docs.select(*[F.col(k).alias(k) if "." not in k else F.col(k) for k in keys], F.col(text).alias("text"))
    b = wordtable.blocks(flat, keys)
    # position in words decides newlines and blanks, so those travel as flags beside the scores
    flag = F.struct(
        F.col("value").alias("s"),
        (F.length("word") - F.length(F.replace("word", F.lit("\n"), F.lit("")))).alias("nl"),
        F.when(F.col("word").rlike(r"(?U)^\s+$"), 2).when(F.col("word").startswith(" "), 1).otherwise(0).alias("ws"),
    )
    langs = model.languages or ("",)  # without any label nothing is scored
    L = len(langs)

    def back(row: dict) -> pa.RecordBatch:
        idx, ends, v = wordtable.positions(row), row["ends"].to_numpy(), row["value"]
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        n_docs = len(ends)
        if len(v):
            s = v.field("s")
            size = np.diff(s.offsets.to_numpy())
            table = np.zeros((len(v), L), np.float32)
            table[size > 0] = s.flatten().to_numpy().reshape(-1, L)
            nl, ws = v.field("nl").to_numpy(), v.field("ws").to_numpy()
        else:
            table, size, nl, ws = np.zeros((1, L), np.float32), np.zeros(1, int), np.zeros(1, int), np.zeros(1, int)
            idx = np.zeros(0, np.int32)
        doc = np.repeat(np.arange(n_docs), ends - starts)
        line = np.cumsum(nl[idx]) if len(idx) else np.zeros(0, np.int64)
        base = np.concatenate([[0], line])[starts]  # newlines before the document
        line = line - base[doc] + 1
        kind = ws[idx]
        first = np.zeros(len(idx), bool)
        first[starts[starts < ends]] = True
        after_blank = np.concatenate([[False], kind[:-1] == 2]) if len(idx) else np.zeros(0, bool)
        word_start = (kind != 2) & ((kind == 1) | first | after_blank)
        scored = size[idx] > 0
        key = doc * np.int64(1 << 31) + line
        content = kind != 2
        k2, where = np.unique(key[content], return_inverse=True)
        m = len(k2)
        tok = idx[content]
        order = np.argsort(where, kind="stable")
        cut_at = np.searchsorted(where[order], np.arange(m))
        sums = np.add.reduceat(table[tok][order], cut_at, axis=0) if m else np.zeros((0, L), np.float32)
        n_scored = np.bincount(where, weights=scored[content], minlength=m)
        n_words = np.bincount(where, weights=word_start[content], minlength=m)
        ldoc, lno = k2 >> 31, k2 & ((1 << 31) - 1)
        best = sums.argmax(1) if m else np.zeros(0, int)
        conf = _confidence(sums, n_scored) if m else np.zeros(0)
        mass = np.zeros((n_docs, L))
        small = np.zeros((n_docs, L))
        long = n_scored >= 4
        np.add.at(mass, (ldoc[long], best[long]), n_scored[long])
        np.add.at(small, (ldoc[~long], best[~long]), n_scored[~long])
        use = np.where(mass.sum(1, keepdims=True) > 0, mass, small)
        dbest, dn = use.argmax(1), use.sum(1)
        dconf = np.where(dn > 0, use.max(1, initial=0) / np.maximum(dn, 1), 0.0)
        dwords = np.bincount(doc, weights=word_start, minlength=n_docs)
        edge = (sums.max(1) - sums[np.arange(m), dbest[ldoc]]) * (2 * n_scored >= n_words) * (n_scored >= 5) if m else np.zeros(0)
        take = np.concatenate([np.arange(n_docs), ldoc]).astype(np.int64)
        names = np.array(langs, object)
        lang = np.concatenate([np.where(dn > 0, names[dbest], None), np.where(n_scored > 0, names[best], None)])
        cols = [row[k].take(pa.array(take)) for k in keys]
        cols += [pa.array(np.concatenate([np.zeros(n_docs), lno]).astype(np.int64)), pa.array(lang, pa.string()), pa.array(np.concatenate([dconf, np.where(n_scored > 0, conf, 0.0)]))]
        cols += [pa.array(np.concatenate([dwords, n_words]).astype(np.int64)), pa.array(lang[take], pa.string()), pa.array(dwords[take].astype(np.int64))]
        cols += [pa.array(np.concatenate([np.zeros(n_docs), edge]).astype(np.float64))]
        return pa.RecordBatch.from_arrays(cols, [*keys, "line_no", "lang_code", "confidence", "n_words", "doc_lang", "doc_words", "margin"])

    schema = ", ".join(f"{k} {flat.schema[k].dataType.simpleString()}" for k in keys)
    return wordtable.per_block(wordtable.attach(b, wordtable.distinct_words(b), lambda words: wordtable.word_values(words, _word_scores(bc), "array<float>").select("word", flag.alias("value"))), back, schema + ", line_no bigint, lang_code string, confidence double, n_words bigint, doc_lang string, doc_words bigint, margin double")


def found(docs: DataFrame, doc: str = "document_id", text: str = "text", language: str = "metadata.language", min_words: int = 20, line_words: int = 8, model: Model | None = None) -> DataFrame:
    """``document_id, line_no, lang_code``: documents (line 0) whose recorded language is missing or not the text's, and lines
    of at least ``line_words`` words in another language than the document. Texts under ``min_words`` words give nothing."""
    d = docs.select(F.col(doc).alias("document_id"), F.col(text).alias("text"), recorded_language(language).alias("recorded"))
    if model is None:
        model = fit(training_sample(docs, doc=doc, text=text, language=language))
    seg = segments(d, ["document_id", "recorded"], model=model).filter(F.col("doc_words") >= min_words)
    wrong = (F.col("line_no") == 0) & (F.col("recorded").isNull() | (F.col("recorded") != F.col("lang_code")))
    other = (F.col("line_no") > 0) & (F.col("n_words") >= line_words) & (F.col("lang_code") != F.col("doc_lang")) & (F.col("margin") >= LINE_MARGIN)
    return seg.filter(wrong | other).filter("lang_code is not null").select("document_id", "line_no", "lang_code").distinct()
