"""A small regression head (linear, ReLU, linear) on precomputed embeddings.

Training reads batches of gradients summed per partition, so the data stay distributed and only weights travel; prediction is one
Arrow pass with broadcast weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Head:
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    @staticmethod
    def fresh(dim: int, hidden: int, tasks: int, seed: int = 42, scale: float = 10.0, bias: float = 2.5) -> Head:
        """Random weights; the last layer's are multiplied by ``scale`` and its bias set to the middle of the label range."""
        r = np.random.default_rng(seed)
        a, b = 1 / np.sqrt(dim), 1 / np.sqrt(hidden)
        return Head(r.uniform(-a, a, (dim, hidden)), np.zeros(hidden), r.uniform(-b, b, (hidden, tasks)) * scale, np.full(tasks, bias))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def gradients(self, x: np.ndarray, y: np.ndarray, mask: float = -100.0) -> tuple[list[np.ndarray], float, float]:
        """Summed gradients of the squared error, its sum and the number of unmasked labels."""
        h = np.maximum(x @ self.w1 + self.b1, 0)
        ok = y != mask
        d = np.where(ok, h @ self.w2 + self.b2 - y, 0.0)
        dh = (d @ self.w2.T) * (h > 0)
        return [2 * x.T @ dh, 2 * dh.sum(0), 2 * h.T @ d, 2 * d.sum(0)], float((d * d).sum()), float(ok.sum())

    def parts(self) -> list[np.ndarray]:
        return [self.w1, self.b1, self.w2, self.b2]


class EarlyStop:
    """The first value sets the best; an improvement under ``least`` is a bad round; stop after ``patience`` of them."""

    def __init__(self, patience: int = 5, least: float = 1e-3):
        self.best: float | None = None
        self.bad, self.patience, self.least = 0, patience, least

    def __call__(self, value: float) -> bool:
        if self.best is None or value - self.best >= self.least:
            self.best, self.bad = value, 0
        else:
            self.bad += 1
        return self.bad >= self.patience


def check_metric(metric: str, splits: list[str]) -> None:
    """``eval_<split>_...`` has to name a loaded split."""
    if not any(metric.startswith(f"eval_{s}_") for s in splits):
        raise ValueError(f"{metric} names none of the splits {splits}")


def train(
    df: DataFrame, x: str, y: str, head: Head, epochs: int = 20, rate: float = 0.01, stop: EarlyStop | None = None, steps: int = 1,
    evaluation: dict[str, DataFrame] | None = None, metric: str = "eval_val_loss",
) -> tuple[Head, list[float]]:
    """Adam with a cosine schedule. An epoch has ``steps`` mini-batches, drawn by a hash of the row and the epoch; each is one distributed
    gradient pass, of which one row a partition comes back. Returns the head and its training losses.

    With ``evaluation`` sets, ``metric`` (``eval_<set>_loss`` or ``eval_<set>_mae``) is measured after every epoch; the head of the best epoch is
    returned, and ``stop`` watches that metric (as a value of which more is better: its negative).
    """
    d = df.select(F.col(x).alias("x"), F.col(y).alias("y"), F.xxhash64(F.col(x), F.col(y)).alias("h")).filter("x is not null and y is not null").persist()
    if evaluation is not None:
        check_metric(metric, list(evaluation))
    m = [np.zeros_like(p) for p in head.parts()]
    v = [np.zeros_like(p) for p in head.parts()]
    losses: list[float] = []
    best, top, turn = head, np.inf, 0
    for ep in range(epochs):
        total = rows_seen = 0.0
        for k in range(steps):
            part = d.filter(F.pmod(F.xxhash64("h", F.lit(ep)), F.lit(steps)) == k) if steps > 1 else d
            flat, loss, n = _gradient(part, head)
            if flat is None:
                continue
            total, rows_seen, turn = total + loss, rows_seen + n, turn + 1
            lr, at, new = rate * 0.5 * (1 + np.cos(np.pi * (ep + k / steps) / epochs)), 0, []
            for i, p in enumerate(head.parts()):
                g = flat[at : at + p.size].reshape(p.shape)
                at += p.size
                m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
                new.append(p - lr * (m[i] / (1 - 0.9**turn)) / (np.sqrt(v[i] / (1 - 0.999**turn)) + 1e-8))
            head = Head(*new)
        losses.append(total / (rows_seen or 1.0))
        value = losses[-1]
        if evaluation is not None:
            name = next(s for s in sorted(evaluation, key=len, reverse=True) if metric.startswith(f"eval_{s}_"))
            value = error(evaluation[name], x, y, head, metric.removeprefix(f"eval_{name}_"))
            if value < top:
                best, top = head, value
        if stop is not None and stop(-value):
            break
    d.unpersist()
    return (best if evaluation is not None else head), losses


def _gradient(d: DataFrame, head: Head) -> tuple[np.ndarray | None, float, float]:
    bc = d.sparkSession.sparkContext.broadcast(head)

    def grad(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc, loss, n = None, 0.0, 0.0
        for p in it:
            if len(p):
                g, ls, c = bc.value.gradients(np.stack(p["x"]).astype(float), np.stack([np.atleast_1d(t) for t in p["y"]]).astype(float))
                acc = g if acc is None else [a + b for a, b in zip(acc, g)]
                loss, n = loss + ls, n + c
        if acc is not None:
            yield pd.DataFrame({"g": [np.concatenate([a.ravel() for a in acc])], "loss": [loss], "n": [n]})

    rows = d.select("x", "y").mapInPandas(grad, "g array<double>, loss double, n double").collect()  # one row a partition, as long as the weights
    n = sum(r["n"] for r in rows)
    if not n:
        return None, 0.0, 0.0
    return np.sum([np.asarray(r["g"]) for r in rows], axis=0) / n, sum(r["loss"] for r in rows), n


def error(df: DataFrame, x: str, y: str, head: Head, which: str = "loss") -> float:
    """Mean squared (``loss``) or absolute (``mae``) error over all labels that are not masked."""
    if which not in ("loss", "mae"):
        raise ValueError(f"unknown metric {which!r}")
    d = predict(df.withColumn("_id", F.col(y).cast("array<double>")), "_id", x, head).filter("_id is not null and prediction is not null")
    e = d.select(F.explode(F.arrays_zip(F.col("_id").alias("t"), F.col("prediction").alias("p"))).alias("z")).filter("z.t != -100")
    diff = F.col("z.t") - F.col("z.p")
    return float(e.agg(F.avg(diff * diff if which == "loss" else F.abs(diff))).first()[0] or 0.0)


def predict(df: DataFrame, id: str, x: str, head: Head) -> DataFrame:
    """``id, prediction array<double>``; rows without embedding have NULL."""
    bc = df.sparkSession.sparkContext.broadcast(head)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in it:
            out: list = [None] * len(p)
            ok = [i for i, e in enumerate(p["x"]) if e is not None]
            if ok:
                for i, r in zip(ok, bc.value(np.stack([p["x"].iloc[i] for i in ok]).astype(float))):
                    out[i] = r.tolist()
            yield pd.DataFrame({id: p[id], "prediction": out})

    return df.select(F.col(id).alias(id), F.col(x).alias("x")).mapInPandas(run, f"{id} {df.schema[id].dataType.simpleString()}, prediction array<double>")
