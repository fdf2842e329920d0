"""Samples that match target category proportions, by divisor-method priorities.

Within a category records get a random rank; a record's priority is ``(rank - 0.5) / target``. The records that fill the
category's minimum come first, then the smallest priorities over all categories. Because priorities rise with the rank
inside a category, the seats of each category follow from the category counts alone, and drawing is ``rank <= seats``:
no global sort, and seats of exhausted categories go to the others.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import hash_order, recorded_language, row_key, valid_score

#: Cells of all plans together; they are held on the driver. Larger plans are rejected, never cut.
MAX_CELLS = 20_000


def eligible(docs: DataFrame, doc: str = "document_id", language: str = "metadata.language", score: str = "scores.score") -> DataFrame:
    """(document_id, lang, score, k): distinct rows with a valid score and a recorded language."""
    d = docs.select(F.col(doc).alias("document_id"), recorded_language(language).alias("lang"), F.col(score).cast("double").alias("score"), row_key(docs).alias("k"))
    return d.filter(F.col("lang").isNotNull() & valid_score("score")).dropDuplicates(["document_id", "k"])


def read_cells(targets: DataFrame) -> list[dict]:
    """The plans' cells as plain records, sorted; NULL plan names or cell numbers are dropped."""
    cols = ["plan_name", "cell_no", "lang_code", "score_min", "score_max", "target_pct", "min_docs", "sample_pct"]
    rows = targets.select(*cols).distinct().filter("plan_name is not null and cell_no is not null").limit(MAX_CELLS + 1).collect()
    if len(rows) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} cells")
    return sorted((r.asDict() for r in rows), key=lambda r: (r["plan_name"], r["cell_no"]))


def _cell_frame(spark: SparkSession, cells: list[dict], extra: dict[str, list] | None = None) -> DataFrame:
    """The cells by their index, with the key under which records look for them (a language or ``*``)."""
    extra = extra or {}
    rows = [(i, c["lang_code"] if c["lang_code"] is not None else "*", c["score_min"], c["score_max"], c["plan_name"], c["cell_no"], *(v[i] for v in extra.values())) for i, c in enumerate(cells)]
    return spark.createDataFrame(rows, "cell int, key string, score_min double, score_max double, plan_name string, cell_no bigint" + "".join(f", {k} bigint" for k in extra))


def _in_cells(records: DataFrame, cells: DataFrame) -> DataFrame:
    """Records with each of the cells they lie in. The cells are broadcast: ``MAX_CELLS`` rows at most."""
    d = records.withColumn("key", F.explode(F.array(F.col("lang"), F.lit("*"))))
    inside = (F.col("score_min").isNull() | (F.col("score") >= F.col("score_min"))) & (F.col("score_max").isNull() | (F.col("score") < F.col("score_max")))
    return d.join(F.broadcast(cells), "key").filter(inside)


def cell_counts(docs: DataFrame, cells: list[dict]) -> tuple[int, dict[int, int]]:
    """Number of eligible records and of those in each cell, from counts by language and distinct score."""
    compact = eligible(docs).groupBy("lang", "score").agg(F.count("*").alias("n")).persist()
    total = compact.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rows = _in_cells(compact, _cell_frame(docs.sparkSession, cells)).groupBy("cell").agg(F.sum("n").alias("n")).collect() if cells else []
    compact.unpersist()
    return total, {r["cell"]: r["n"] for r in rows}


def seats(counts: list[int], weights: list[float], minimum: list[int], size: int) -> list[int]:
    """Seats per category: minimum first, then the smallest ``(rank - 0.5) / weight``; ties by category order.

    Never more than a category holds. If the minima alone exceed ``size`` they are all kept.
    """
    have = [min(m, c) for m, c in zip(minimum, counts)]
    left = min(size, sum(c for c, w in zip(counts, weights) if w > 0) + sum(h for h, w in zip(have, weights) if w <= 0)) - sum(have)
    if left <= 0:
        return have
    at = lambda t: [max(h, min(c, math.floor(t * w + 0.5))) if w > 0 else h for h, c, w in zip(have, counts, weights)]
    lo, hi = 0.0, 1.0
    goal = sum(have) + left
    while sum(at(hi)) < goal:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        if sum(at(mid)) <= goal:
            lo = mid
        else:
            hi = mid
    got = at(lo)
    heap = [((g + 0.5) / w, i) for i, (g, w, c) in enumerate(zip(got, weights, counts)) if w > 0 and g < c]
    heapq.heapify(heap)
    for _ in range(goal - sum(got)):
        _, i = heapq.heappop(heap)
        got[i] += 1
        if got[i] < counts[i]:
            heapq.heappush(heap, ((got[i] + 0.5) / weights[i], i))
    return got


def plan_seats(cells: list[dict], total: int, per: dict[int, int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for plan in {c["plan_name"] for c in cells}:
        ids = [i for i, c in enumerate(cells) if c["plan_name"] == plan]
        size = max((cells[i]["sample_pct"] or 0) for i in ids) * total // 100
        got = seats([per.get(i, 0) for i in ids], [cells[i]["target_pct"] or 0 for i in ids], [cells[i]["min_docs"] or 0 for i in ids], size)
        out |= dict(zip(ids, got))
    return out


def _drawn(docs: DataFrame, cells: list[dict], got: dict[int, int], seed: int) -> DataFrame:
    info = _cell_frame(docs.sparkSession, cells, {"seats": [got[i] for i in range(len(cells))]})
    d = _in_cells(eligible(docs).withColumn("h", hash_order(seed, "document_id")), info).select("cell", "plan_name", "cell_no", "seats", "document_id", "k", "h", F.substring("h", 1, 3).alias("r"))
    sizes = d.groupBy("cell", "seats", "r").agg(F.count("*").alias("n"))
    before = sizes.select("cell", "seats", "r", (F.sum("n").over(Window.partitionBy("cell").orderBy("r")) - F.col("n")).alias("before"))  # 4096 rows a cell
    start = before.filter("before < seats").select("cell", "r", "before")  # ranges wholly beyond the seats are not ranked
    ranked = d.join(start, ["cell", "r"]).withColumn("cell_rank", F.col("before") + F.row_number().over(Window.partitionBy("cell", "r").orderBy("h", "document_id", "k")))
    return ranked.filter("cell_rank <= seats").select("cell", "plan_name", "cell_no", "document_id", F.col("cell_rank").cast("bigint").alias("cell_rank"))


def sample(docs: DataFrame, targets: DataFrame, seed: int = 42) -> DataFrame:
    """``plan_name, cell_no, document_id, cell_rank``: the drawn records of every plan.

    A record that lies in several cells of a plan is drawn for each of them on its own. Ranks are row numbers in a
    seeded hash order. They are built from 4096 hash ranges per cell (a count per range, then a row number inside it), so
    that no cell, however large, is sorted in one task.
    """
    cells = read_cells(targets)
    if not cells:
        return docs.sparkSession.createDataFrame([], "plan_name string, cell_no bigint, document_id string, cell_rank bigint")
    return _drawn(docs, cells, plan_seats(cells, *cell_counts(docs, cells)), seed).drop("cell")


def report(docs: DataFrame, targets: DataFrame, seed: int = 42) -> DataFrame:
    """One row per cell: records available, wanted, drawn by ``sample``, and whether target and minimum can be met.

    With N eligible records and c in the cell, the target can be met unless ``c * 10000 < target_pct * sample_pct * N`` and the minimum unless
    ``c < min_docs``. NULL targets count as 0. Empty targets give no rows; with no eligible records every cell with a minimum is unmet.
    """
    spark, cells = docs.sparkSession, read_cells(targets)
    schema = "plan_name string, cell_no bigint, available bigint, wanted double, drawn bigint, target_met boolean, minimum_met boolean"
    if not cells:
        return spark.createDataFrame([], schema)
    total, per = cell_counts(docs, cells)
    drawn = _drawn(docs, cells, plan_seats(cells, total, per), seed).groupBy("cell").agg(F.count("*").alias("drawn"))
    wanted = [(c["target_pct"] or 0) * (c["sample_pct"] or 0) * total for c in cells]
    info = _cell_frame(spark, cells, {"available": [per.get(i, 0) for i in range(len(cells))], "wanted": wanted, "least": [c["min_docs"] or 0 for c in cells]})
    r = info.join(drawn, "cell", "left").withColumn("drawn", F.coalesce("drawn", F.lit(0)))
    # what was drawn falls short wherever a cell can't be met; whether it could have been more is checked behind it
    short, few = F.col("drawn") * 10000 < F.col("wanted"), F.col("drawn") < F.col("least")
    target = ~(short & (F.col("available") * 10000 < F.col("wanted")))
    return r.select("plan_name", "cell_no", "available", (F.col("wanted") / 10000).alias("wanted"), "drawn", target.alias("target_met"), (~(few & (F.col("available") < F.col("least")))).alias("minimum_met"))


def unmet(docs: DataFrame, targets: DataFrame, seed: int = 42) -> DataFrame:
    """``plan_name, cell_no`` of the cells whose sample falls short of target or minimum because they hold too few records."""
    return report(docs, targets, seed).filter("not target_met or not minimum_met").select("plan_name", "cell_no")
