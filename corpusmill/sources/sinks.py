"""Writers. Order inside an output file is the order of (file, line); reports are small and written by the driver."""

from __future__ import annotations

import csv
import hashlib
import json
from collections.abc import Iterator, Sequence
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from corpusmill.operators import corpus, votes


#: Rows of a report that is held on the driver; larger frames are rejected, never cut.
MAX_ROWS = 10_000


def _rows(df: DataFrame, limit: int | None = None) -> list[Row]:
    limit = MAX_ROWS if limit is None else limit
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows")
    return rows


def annotation_name(stem: str, model: str, prompt: str, lang: str, suffix: str = "") -> str:
    parts = [stem, "_annotations", model.replace("/", "--"), prompt, lang]
    return "_".join([*parts, suffix] if suffix else parts) + ".jsonl"


def stem_of(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)


def folder_below(path: Column, root: str) -> Column:
    """The folders between ``root`` and the file, with a slash behind them."""
    rest = F.when(path.startswith(root.rstrip("/") + "/"), F.substr(path, F.lit(len(root.rstrip("/")) + 2))).otherwise(path) if root else path
    return F.regexp_extract(rest, r"^/*(.*/)?[^/]+$", 1)


def annotation_file(source: Column, model: Column, prompt: Column, lang: Column) -> Column:
    """``annotation_name`` as a column; unknown parts are empty."""
    e = lambda c: F.coalesce(c, F.lit(""))
    return F.concat(F.concat_ws("_", e(stem_of(source)), F.lit("_annotations"), F.replace(e(model), F.lit("/"), F.lit("--")), e(prompt), e(lang)), F.lit(".jsonl"))


def named_lines(df: DataFrame, folder: str, name: str, order: Sequence[str], value: str = "value", append: bool = False) -> None:
    """One file per value of ``name`` (a path under ``folder``), its lines in order.

    Rows are placed by file and sorted in their task (spilling); a task streams each file into a temporary one and renames it, so a
    repeated task replaces its own work and a broken run leaves no half files. ``append`` puts the new lines behind those of an existing file.
    """

    def write(rows: Iterator[Row]) -> None:
        import itertools
        import os
        import shutil
        import uuid

        for f, group in itertools.groupby(rows, lambda r: r["_name"]):
            at = Path(folder) / f
            at.parent.mkdir(parents=True, exist_ok=True)
            tmp = at.with_name(f".{at.name}.{uuid.uuid4().hex}")
            with open(tmp, "w", encoding="utf-8", newline="\n") as out:
                if append and at.exists():
                    with open(at, encoding="utf-8") as old:
                        shutil.copyfileobj(old, out)
                out.writelines(r["_value"] + "\n" for r in group)
            os.replace(tmp, at)

    keys = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]
    d = df.select(F.col(name).alias("_name"), F.col(value).alias("_value"), *keys).filter("_name is not null and _value is not null")
    d.repartition("_name").sortWithinPartitions("_name", *[f"_o{i}" for i in range(len(order))]).foreachPartition(write)


def ordered_json(df: DataFrame, path: str, by: Sequence[str], order: Sequence[str], drop_order: bool = True, mode: str = "overwrite") -> None:
    """One folder per value of ``by``, its lines in order: rows are placed by ``by``, sorted in their task (spilling) and written as they come."""
    d = df.repartition(*by).sortWithinPartitions(*by, *order)
    d = d.drop(*[c for c in order if c not in by]) if drop_order else d
    d.write.mode(mode).partitionBy(*by).json(path)


def chunks(df: DataFrame, path: str, mode: str = "overwrite", drop_order: bool = True) -> None:
    """``chunk=i`` folders of a chunked frame."""
    ordered_json(df, path, ["chunk"], ["line"], drop_order, mode)


def splits(df: DataFrame, path: str, order: Sequence[str]) -> None:
    ordered_json(df, path, ["split"], order, drop_order=False)


def score_lines(df: DataFrame, strategy: str, id_field: str = "id") -> Column:
    """``{<id_field>, score, aggregation_type}`` as a JSON line; scores are numbers, and the text "invalid" where they are NULL."""
    line = lambda x: F.to_json(F.struct(F.col("doc_id").alias(id_field), x.alias("score"), F.lit(strategy).alias("aggregation_type")))
    return F.when(F.col("score").isNull(), line(F.lit("invalid"))).otherwise(line(F.col("score")))


def aggregated_scores(raw: DataFrame, scores: DataFrame, path: str, strategy: str, id_field: str = "id", annotator: str = "", root: str = "") -> list[str]:
    """Scores of complete files only, in raw order, one file ``<folders below root>/<stem>_<annotator>_aggregated_scores_<strategy>.jsonl`` for each.

    raw: ``file_path, doc_id, line_no``. Returns the files left out because a document had no annotation.
    """
    j = votes.join_scores(raw, scores)
    left_out = sorted(r[0] for r in _rows(j.filter("not complete").select("file_path").distinct()))
    tag = f"_{annotator}" if annotator else ""
    ok = j.filter("complete").select("line_no", score_lines(j, strategy, id_field).alias("value"), F.concat(folder_below(F.col("file_path"), root), stem_of(F.col("file_path")), F.lit(f"{tag}_aggregated_scores_{strategy}.jsonl")).alias("name"))
    named_lines(ok, path, "name", ["line_no"])
    return left_out


def append_hashes(new: DataFrame, path: str) -> None:
    """New rows behind an existing list; the header only when the file is new."""
    first = not Path(path).exists()
    with open(path, "a", encoding="utf-8", newline="") as f:
        w = csv.writer(f, lineterminator="\n")
        if first:
            w.writerow(["file_path", "md5"])
        w.writerows((r["file_path"], r["md5"]) for r in new.orderBy("file_path").toLocalIterator())


def without_field(lines: DataFrame, field: str, folder: str) -> None:
    """JSON-line files (``name, line_no, value``) written again without a top-level field; blank lines go."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in it:
            yield p.assign(value=[json.dumps({k: v for k, v in json.loads(x).items() if k != field}, ensure_ascii=False) for x in p["value"]])

    d = lines.select("name", "line_no", "value").filter(F.trim("value") != "")
    named_lines(d.mapInPandas(run, "name string, line_no bigint, value string"), folder, "name", ["line_no"])


def batch_requests(requests: DataFrame, folder: str, size: int = 50_000, limit: int | None = None) -> None:
    """``<stem>/offset_<i>.jsonl`` of at most ``size`` requests in input order, at most ``limit`` of a file. requests: ``file, line_no, value``."""
    named_lines(request_slices(requests, size, limit), folder, "name", ["line_no"])


def request_slices(requests: DataFrame, size: int = 50_000, limit: int | None = None) -> DataFrame:
    """``name, line_no, value``: requests numbered in their file without gaps, and the slice each of them goes to."""
    n = corpus.numbered(requests, "file", "line_no", "at")
    n = n.filter(F.col("at") < limit) if limit is not None else n
    return n.select(F.concat(stem_of(F.col("file")), F.lit("/offset_"), (F.floor(F.col("at") / size) * size).cast("string"), F.lit(".jsonl")).alias("name"), F.col("at").alias("line_no"), "value")


def predictions(df: DataFrame, path: str, keys: dict[str, str], name: str, order: Sequence[str]) -> None:
    """``{<key>: value}`` JSON lines, one file per value of ``name``; keys: prediction key by column."""
    named_lines(df.withColumn("_v", F.to_json(F.struct(*[F.col(c).alias(k) for c, k in keys.items()]))), path, name, order, "_v")


def drop_field(df: DataFrame, field: str) -> DataFrame:
    """Without a field, nested ones by dotted path."""
    head, _, rest = field.partition(".")
    return df.withColumn(head, F.col(head).dropFields(rest)) if rest else df.drop(field)


def json_report(df: DataFrame, path: str) -> None:
    """A frame of any size as a JSON list, keys in column order; its rows pass through the driver a partition at a time."""
    with open(path, "w", encoding="utf-8") as f:
        n = 0
        for n, r in enumerate(df.toLocalIterator(), 1):
            f.write(("[\n  " if n == 1 else ",\n  ") + json.dumps(r.asDict(recursive=True), ensure_ascii=False, indent=2, default=str).replace("\n", "\n  "))
        f.write("\n]" if n else "[]")


def pair_metrics_json(metrics: DataFrame, cm: DataFrame | None, folder: str, classes: DataFrame | None = None) -> list[str]:
    """``ir_<a>_<b>.json`` per pair with its metrics and, for pairs with the truth, confusion matrix and class metrics (``annotator, classes, macro_f1, micro_f1``)."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    tables: dict[str, dict] = {}
    for r in cm.collect() if cm is not None else []:  # annotators x labels^2 rows
        tables.setdefault(r["annotator"], {}).setdefault(str(r["label"]), {})[str(r["prediction"])] = r["n"]
    more = {r["annotator"]: {"Macro-F1": r["macro_f1"], "Micro-F1": r["micro_f1"], **r["classes"]} for r in classes.collect()} if classes is not None else {}  # one row an annotator
    out = []
    for r in metrics.collect():  # one row a pair
        d = r.asDict()
        a, b = d.pop("annotator_0"), d.pop("annotator_1")
        p = Path(folder) / f"ir_{a}_{b}.json"
        p.write_text(json.dumps({"metrics": d | more.get(b, more.get(a, {})), "CM": tables.get(b) or tables.get(a) or {}}), encoding="utf-8")
        out.append(str(p))
    return sorted(out)


def markdown(df: DataFrame, limit: int | None = None) -> str:
    rows = _rows(df, limit)
    cell = lambda v: f"{v:.4f}" if isinstance(v, float) else "" if v is None else str(v)
    head = "| " + " | ".join(df.columns) + " |\n|" + " --- |" * len(df.columns) + "\n"
    return head + "".join("| " + " | ".join(cell(v) for v in r) + " |\n" for r in rows)


def latex(df: DataFrame, best: dict[str, str], limit: int | None = None) -> str:
    """A tabular whose best values (``max`` or ``min`` per column) are bold."""
    rows = _rows(df, limit)
    top = {c: (max if how == "max" else min)((r[c] for r in rows if r[c] is not None), default=None) for c, how in best.items()}
    esc = lambda v: f"{v:.3f}" if isinstance(v, float) else "" if v is None else str(v).replace("_", r"\_")
    body = "".join(" & ".join(rf"\textbf{{{esc(r[c])}}}" if c in top and r[c] is not None and r[c] == top[c] else esc(r[c]) for c in df.columns) + " \\\\\n" for r in rows)
    return "\\begin{tabular}{" + "l" * len(df.columns) + "}\n" + " & ".join(c.replace("_", r"\_") for c in df.columns) + " \\\\\n" + body + "\\end{tabular}\n"


def config_digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()[:8]


def experiment_report(df: DataFrame, config: str, folder: str) -> tuple[str, str]:
    """Markdown and CSV of a ranked experiment frame, named by the configuration's digest."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    md, cs = (Path(folder) / f"comparison_{config_digest(config)}.{x}" for x in ("md", "csv"))
    md.write_text(markdown(df), encoding="utf-8")
    df.limit(MAX_ROWS).toPandas().to_csv(cs, index=False)  # markdown has rejected more
    return str(md), str(cs)
