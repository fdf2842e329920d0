"""Consensus labels from disagreeing annotators (triplet moment method).

Annotators give each document votes on an ordinal scale 0..K-1. For every threshold t the votes become the binary event
``vote >= t``. Two annotators who err independently given the true event have

    cov_ij = p(1-p) d_i d_j          (agreement beyond chance)

with d = P(event | true event) - P(event | no true event), so each triplet (i, j, k) gives ``p(1-p) d_i^2 = cov_ij cov_ik / cov_jk``.
Pairs whose covariance stays far above what the solved accuracies explain are dependent: they are left out of the triplets and share one voice.

A threshold says nothing about which class below it is true, so these accuracies only start the solution. The joint vote rates of
triplets fix the whole table of an annotator (any vote s given the true class c) and the shares p_c of the classes:

    rate(i votes r, j votes s, k votes t) = sum over c of p_c L_i(r|c) L_j(s|c) L_k(t|c)

which is solved for one annotator at a time, all triplets of independent annotators together, each weighted by its number of common documents. Triplets are
taken among the ``REFERENCES`` annotators that say most; the tables of all others follow from their pair rates with these.
Inverted and shifted annotators keep their information. Votes are combined by summing log-odds of the tables.

The documents are read for moments only; the sums that reach the driver are bounded by annotators^2 x classes and
references^3 x classes^3, whatever the number of documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import row_key, valid_score
from corpusmill.llm.wordtable import cut

#: More annotators than this would make the driver's moment matrix large.
MAX_ANNOTATORS = 500
#: Annotators whose triplets are counted, and partners of one annotator in the start solution: those that say most, at every size.
REFERENCES, PARTNERS = 12, 40
#: Common documents from which a pair counts.
LEAST_COMMON = 5
#: Correlation of errors above which, and above its chance, a pair is dependent.
DEPENDENT = 0.3
#: Documents' worth of the start solution that a table keeps.
PRIOR_DOCS = 5.0
ROUNDS, TOLERANCE = 60, 1e-5
#: Partial sums that reach the driver.
SUMS = 8


def canonical_model(col):
    """The slash of a model name is also written ``__`` or ``--``."""
    return F.regexp_replace(F.trim(col), "__|--", "/")


def vote_table(annotations: DataFrame, doc: str = "document_id", model: str = "meta_information.model", scores: str = "scores") -> DataFrame:
    """(document_id, votes array<struct<annotator, label, n>>): one row per document with at least one valid vote.

    A row repeated in full counts once; null, non-finite and out-of-range votes, empty lists, null ids and null models
    contribute nothing. Non-integer votes round half up. Each document holds at most annotators x classes entries.
    """
    rows = annotations.select(
        F.col(doc).alias("document_id"), canonical_model(F.col(model)).alias("annotator"), F.col(scores).alias("s"), row_key(annotations).alias("k")
    ).filter("document_id is not null and annotator is not null")
    rows = rows.dropDuplicates(["document_id", "annotator", "k"])
    votes = rows.select("document_id", "annotator", F.explode("s").alias("v")).filter(valid_score("v"))
    counts = votes.groupBy("document_id", "annotator", F.floor(F.col("v") + 0.5).cast("int").alias("label")).agg(F.count("*").alias("n"))
    return counts.groupBy("document_id").agg(F.sort_array(F.collect_list(F.struct("annotator", "label", "n"))).alias("votes"))


def _design(votes: pa.Array, names: list[str], classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Share of each annotator's votes per class (docs x annotators x classes) and presence (docs x annotators)."""
    off = votes.offsets.to_numpy().astype(np.int64)
    v = votes.flatten()
    doc = np.repeat(np.arange(len(votes)), np.diff(off))
    who = pc.index_in(v.field("annotator"), pa.array(names, pa.string())).to_numpy(zero_copy_only=False)
    cell = (doc * len(names) + who) * classes + v.field("label").to_numpy(zero_copy_only=False)
    x = np.bincount(cell, v.field("n").to_numpy(zero_copy_only=False), len(votes) * len(names) * classes).reshape(len(votes), len(names), classes)
    tot = x.sum(2)
    return x / np.maximum(tot, 1)[:, :, None], (tot > 0).astype(float)


def _batches(it: Iterator[pa.RecordBatch], names: list[str], classes: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    step = max(1, 4_000_000 // max(1, len(names) * classes))
    for rows in it:
        for lo in range(0, rows.num_rows, step):
            part = rows.slice(lo, step)
            yield part, *_design(part.column(part.schema.get_field_index("votes")), names, classes)


def _sums(votes: DataFrame, names: list[str], classes: int, shapes: dict[str, tuple], add: Callable) -> dict[str, np.ndarray]:
    """Sums of ``add(acc, x, m)`` over all documents: one vector a partition, ``SUMS`` of them for the driver."""

    def part(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = {k: np.zeros(s) for k, s in shapes.items()}
        for _, x, m in _batches(it, names, classes):
            add(acc, x, m)
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([a.ravel() for a in acc.values()]).tobytes()], pa.binary())], ["v"])

    def total(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = None
        for rows in it:
            for v in rows.column("v"):
                v = np.frombuffer(v.as_buffer())
                acc = v if acc is None else acc + v
        if acc is not None:
            yield pa.RecordBatch.from_arrays([pa.array([acc.tobytes()], pa.binary())], ["v"])

    flat = np.zeros(sum(int(np.prod(s)) for s in shapes.values()))
    for r in votes.select("votes").mapInArrow(part, "v binary").repartition(SUMS).mapInArrow(total, "v binary").collect():
        flat = flat + np.frombuffer(bytes(r["v"]))
    out, at = {}, 0
    for k, s in shapes.items():
        out[k] = flat[at : at + int(np.prod(s))].reshape(s)
        at += int(np.prod(s))
    return out


def pair_moments(votes: DataFrame, names: list[str], classes: int) -> dict[str, np.ndarray]:
    """n[i, j]: common documents; s[i, j, s]: vote shares of i on them; ge[t, i, j]: both votes >= t + 1."""
    A, T = len(names), classes - 1

    def add(acc, x, m):
        acc["n"] += m.T @ m
        for s in range(classes):
            acc["s"][:, :, s] += x[:, :, s].T @ m
        e = np.flip(np.cumsum(np.flip(x, 2), 2), 2)
        for t in range(T):
            acc["ge"][t] += e[:, :, t + 1].T @ e[:, :, t + 1]

    return _sums(votes, names, classes, {"n": (A, A), "s": (A, A, classes), "ge": (T, A, A)}, add)


def reference_moments(votes: DataFrame, names: list[str], classes: int, refs: list[int]) -> dict[str, np.ndarray]:
    """pair[i, s, r, u]: votes of any annotator with those of reference r; three[q, s, u, r, v]: votes of the q-th pair of references with those of r."""
    A, R, K = len(names), len(refs), classes
    couples = list(combinations(range(R), 2))

    def add(acc, x, m):
        y, my = x[:, refs], m[:, refs]
        acc["pair"] += (x.reshape(len(x), -1).T @ y.reshape(len(x), -1)).reshape(A, K, R, K)
        for q, (i, j) in enumerate(couples):
            both = np.flatnonzero(my[:, i] * my[:, j])
            if len(both):
                product = (y[both, i][:, :, None] * y[both, j][:, None, :]).reshape(len(both), K * K)
                acc["three"][q] += (product.T @ y[both].reshape(len(both), -1)).reshape(K, K, R, K)
                acc["n3"][q] += my[both].sum(0)

    return _sums(votes, names, classes, {"pair": (A, K, R, K), "three": (len(couples), K, K, R, K), "n3": (len(couples), R)}, add)


def _triplets(cov: np.ndarray, use: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Signed sqrt(p(1-p)) d per annotator: median over the triplets with its best partners, signs by the majority of covariance mass."""
    A = len(cov)
    sq = np.zeros(A)
    for i in range(A):
        near = [j for j in np.argsort(-n[i], kind="stable") if use[i, j]][:PARTNERS]
        j, k = np.triu_indices(len(near), 1)
        j, k = np.array(near, int)[j], np.array(near, int)[k]
        ok = use[j, k] & (np.abs(cov[j, k]) > 0.01)
        j, k = j[ok], k[ok]
        if len(j):
            v, w = cov[i, j] * cov[i, k] / cov[j, k], np.abs(cov[j, k])
            o = np.argsort(v)
            c = np.cumsum(w[o])
            sq[i] = max(0.0, v[o][np.searchsorted(c, c[-1] / 2)])
    a = np.sqrt(np.clip(sq, 0, 0.25))
    if A:
        w = np.where(use, cov, 0)
        np.fill_diagonal(w, 0)
        sign = np.sign(np.linalg.eigh((w + w.T) / 2)[1][:, -1])
        sign = sign * (1 if (sign * a).sum() >= 0 else -1)
        a = a * np.where(sign == 0, 1, sign)
    return a


def start(mom: dict[str, np.ndarray], classes: int) -> dict[str, np.ndarray]:
    """Accuracies of the threshold events, dependent pairs with their groups, and first class shares, from pairs alone."""
    n = mom["n"]
    A, T = len(n), classes - 1
    nn = np.maximum(n, 1)
    share = mom["s"] / nn[:, :, None]  # [i, j, s]: share of vote s of i on documents shared with j
    ge = np.flip(np.cumsum(np.flip(share, 2), 2), 2)[:, :, 1:]
    cov = np.stack([mom["ge"][t] / nn - ge[:, :, t] * ge[:, :, t].T for t in range(T)])
    enough = (n >= LEAST_COMMON) & ~np.eye(A, dtype=bool)
    use = enough.copy()
    for _ in range(3):
        a = np.stack([_triplets(cov[t], use, n) for t in range(T)])
        resid = np.mean([cov[t] - np.outer(a[t], a[t]) for t in range(T)], axis=0)
        own_error = np.sqrt(np.maximum(np.diag(resid), 0))
        dep = enough & (resid > DEPENDENT * np.outer(own_error, own_error) + 3 / np.sqrt(nn) * 0.25)
        if (use == (enough & ~dep)).all():
            break
        use = enough & ~dep
    else:
        dep = enough & ~use
    own = np.stack([share[i, i] for i in range(A)]) if A else np.zeros((0, classes))
    prior_ge = np.zeros(T)
    for t in range(T):
        base, w = own[:, t + 1 :].sum(1), np.maximum(a[t], 0) ** 2
        prior_ge[t] = np.clip((w * base).sum() / w.sum() if w.sum() > 0 else base.mean() if A else 0.5, 0.01, 0.99)
    prior_ge = np.minimum.accumulate(prior_ge)
    edges = np.concatenate([[1.0], prior_ge, [0.0]])
    prior = np.maximum(edges[:-1] - edges[1:], 0.005)
    group = np.arange(A)
    for i in range(A):
        for j in np.flatnonzero(dep[i, :i]):
            group[group == group[i]] = group[j]
    return {"a": a, "prior_ge": prior_ge, "prior": prior / prior.sum(), "use": use, "dependent": dep, "group": group, "own": own, "share": share, "ge": ge, "n": n}


def references(first: dict[str, np.ndarray]) -> list[int]:
    """The annotators with the largest accuracy, whatever its sign, over the most documents."""
    weight = (first["a"] ** 2).sum(0) * np.sqrt(np.diag(first["n"])) + 1e-9 * np.diag(first["n"])
    return sorted(np.argsort(-weight, kind="stable")[:REFERENCES].tolist())


def _first_tables(first: dict[str, np.ndarray], pair: np.ndarray, refs: list[int], classes: int) -> np.ndarray:
    """Tables from pairs with references, as far as threshold events tell: P(vote s, truth >= t) is linear in the pair rates."""
    n, use, a, prior_ge, own, share, ge = (first[k] for k in ("n", "use", "a", "prior_ge", "own", "share", "ge"))
    A, T = len(n), classes - 1
    like = np.zeros((A, classes, classes))
    for i in range(A):
        joint = np.zeros((classes, classes + 1))  # [s, c] = P(vote s, truth >= c)
        joint[:, 0] = own[i]
        for t in range(T):
            p, num, den = prior_ge[t], np.zeros(classes), 0.0
            for r, j in enumerate(refs):
                if use[i, j] and a[t, j] != 0:
                    num += n[i, j] * (pair[i, :, r, t + 1 :].sum(1) / n[i, j] - share[i, j] * ge[j, i, t]) * a[t, j]
                    den += n[i, j] * a[t, j] ** 2
            joint[:, t + 1] = own[i] * p + (num / den * np.sqrt(p * (1 - p)) if den > 0 else 0.0)
        cell = np.maximum(joint[:, :-1] - joint[:, 1:], 0) + 0.004 * own[i][:, None] + 1e-4
        like[i] = cell / cell.sum(0)
    return like


def _table(rates: np.ndarray, gram: np.ndarray, old: np.ndarray, prior: np.ndarray, first: np.ndarray, docs: float, inner: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative least squares for one annotator's joint table X (vote, class): X gram = rates, by multiplicative steps from the old one."""
    x = old * prior
    for _ in range(inner if gram.any() else 0):
        x = x * np.maximum(rates, 1e-12) / np.maximum(x @ gram, 1e-12)
    y = docs * x + PRIOR_DOCS * first * prior + 1e-9
    return y / y.sum(0), x.sum(0)


def solve(first: dict[str, np.ndarray], ref: dict[str, np.ndarray], refs: list[int], classes: int) -> dict[str, np.ndarray]:
    """Class shares and tables (annotator, vote, class) from the triplets of the references and the pairs with them."""
    n, use, K, R = first["n"], first["use"], classes, len(refs)
    begin = _first_tables(first, ref["pair"], refs, K)
    like, prior = begin.copy(), first["prior"].copy()
    rates: list[list] = [[] for _ in refs]  # by reference: (weight, other, other, rates with the reference's votes first)
    for q, (i, j) in enumerate(combinations(range(R), 2)):
        for k in range(j + 1, R):
            common = ref["n3"][q, k]
            if common > 0 and use[refs[i], refs[j]] and use[refs[i], refs[k]] and use[refs[j], refs[k]]:
                r3 = ref["three"][q, :, :, k] / common
                for at, (own, b, c) in enumerate(((i, j, k), (j, i, k), (k, i, j))):
                    rates[own].append((common, refs[b], refs[c], np.moveaxis(r3, at, 0)))
    for _ in range(ROUNDS):
        before, shares = like[refs].copy(), np.zeros(K)
        for r, i in enumerate(refs):
            top, gram = np.zeros((K, K)), np.zeros((K, K))
            for w, j, k, r3 in rates[r]:
                top += w * np.einsum("stu,tc,uc->sc", r3, like[j], like[k], optimize=True)
                gram += w * (like[j].T @ like[j]) * (like[k].T @ like[k])
            like[i], mass = _table(top, gram, like[i], prior, begin[i], n[i, i])
            shares += n[i, i] * mass
        if shares.sum() > 0:
            prior = np.maximum(shares / shares.sum(), 1e-3)
            prior /= prior.sum()
        if R == 0 or np.abs(like[refs] - before).max() < TOLERANCE:
            break
    for i in set(range(len(n))) - set(refs):
        top, gram = np.zeros((K, K)), np.zeros((K, K))
        for r, j in enumerate(refs):
            if use[i, j]:
                top += ref["pair"][i, :, r] @ like[j]
                gram += n[i, j] * (like[j].T @ like[j])
        like[i], _ = _table(top, gram, like[i], prior, begin[i], n[i, i], 200)
    return {"prior": prior, "like": like, "group": first["group"], "dependent": first["dependent"]}


def _posterior(x: np.ndarray, m: np.ndarray, sol: dict[str, np.ndarray]) -> np.ndarray:
    """Log posterior per document and class: log-odds weights summed; dependent annotators share one voice."""
    same = (sol["group"][:, None] == sol["group"][None, :]).astype(float)
    w = m / np.maximum(m @ same, 1)
    return np.log(sol["prior"]) + (x * w[:, :, None]).reshape(len(x), -1) @ np.log(sol["like"]).reshape(-1, len(sol["prior"]))


def reliability(sol: dict[str, np.ndarray]) -> np.ndarray:
    """Per annotator the mean over thresholds of P(vote >= t | truth >= t) - P(vote >= t | truth < t)."""
    prior, like = sol["prior"], sol["like"]
    out = []
    for t in range(1, len(prior)):
        hit = like[:, t:].sum(1)
        out.append(hit[:, t:] @ prior[t:] / prior[t:].sum() - hit[:, :t] @ prior[:t] / prior[:t].sum())
    return np.mean(out, axis=0)


def consensus(annotations: DataFrame, doc: str = "document_id", model: str = "meta_information.model", scores: str = "scores", classes: int = 6) -> tuple[DataFrame, DataFrame]:
    """(labels, annotators).

    labels: ``document_id, label, confidence, agreement, n_annotators``, one row per document with a valid vote; confidence
    is the posterior of the label, agreement the share of annotator pairs of the document with the same leading vote
    (NULL with one annotator). annotators: ``annotator, accuracy, reliability, inverted, dependent_on``; accuracy is the share of right
    votes. Empty input gives two empty frames. Ties between labels go to the lower label. More than ``MAX_ANNOTATORS`` annotators raise.
    """
    spark = annotations.sparkSession
    votes = cut(vote_table(annotations, doc, model, scores))
    names = [r[0] for r in votes.select(F.explode("votes.annotator").alias("a")).distinct().limit(MAX_ANNOTATORS + 1).collect()]
    if len(names) > MAX_ANNOTATORS:
        raise ValueError(f"more than {MAX_ANNOTATORS} annotators")
    names.sort()
    first = start(pair_moments(votes, names, classes), classes)
    refs = references(first)
    sol = solve(first, reference_moments(votes, names, classes, refs), refs, classes)

    def combine(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, x, m in _batches(it, names, classes):
            post = _posterior(x, m, sol)
            lab = post.argmax(1)
            post = np.exp(post - post.max(1, keepdims=True))
            lead = np.where(m > 0, x.argmax(2), -1)
            k = m.sum(1)
            hits = np.stack([(lead == c).sum(1) for c in range(classes)], 1)
            pairs = k * (k - 1) / 2
            agree = (hits * (hits - 1) / 2).sum(1) / np.maximum(pairs, 1)
            cols = {"document_id": rows.column("document_id"), "label": pa.array(lab.astype(np.int64)), "confidence": pa.array(post.max(1) / post.sum(1))}
            cols |= {"agreement": pa.array(agree, mask=pairs == 0), "n_annotators": pa.array(k.astype(np.int64))}
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    labels = votes.mapInArrow(combine, "document_id string, label bigint, confidence double, agreement double, n_annotators bigint")
    rel = reliability(sol)
    right = np.einsum("c,icc->i", sol["prior"], sol["like"])
    rows = [(a, float(right[i]), float(rel[i]), bool(rel[i] < 0), [names[j] for j in np.flatnonzero(sol["dependent"][i])]) for i, a in enumerate(names)]
    return labels, spark.createDataFrame(rows, "annotator string, accuracy double, reliability double, inverted boolean, dependent_on array<string>")
