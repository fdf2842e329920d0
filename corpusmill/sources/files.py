"""Readers. JSON lines keep their file and line number, so file order survives distribution."""

from __future__ import annotations

import os
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill import schemas


def find(folder: str, pattern: str = "*.jsonl", recursive: bool = True, required: bool = False) -> list[str]:
    """Sorted file paths; FileNotFoundError when some are required and none exist."""
    root = Path(folder)
    got = sorted(str(p) for p in (root.rglob(pattern) if recursive else root.glob(pattern)) if p.is_file())
    if required and not got:
        raise FileNotFoundError(f"no {pattern} under {folder}")
    return got


def lines(spark: SparkSession, paths: str | Sequence[str], pattern: str | None = None, recursive: bool = False) -> DataFrame:
    """``file, line_no, value``: physical lines from 0, blank and malformed ones included.

    Splits of a file are numbered on their own and shifted by the counts of the splits before them: no file is sorted in one
    task.
    """
    r = spark.read.option("recursiveFileLookup", str(recursive).lower())
    if pattern:
        r = r.option("pathGlobFilter", pattern)
    m = F.col("_metadata")
    raw = r.text([paths] if isinstance(paths, str) else list(paths)).select(m["file_path"].alias("file"), m["file_block_start"].alias("block"), "value").withColumn("i", F.monotonically_increasing_id())
    n = raw.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("i").alias("lo"))
    start = n.select("file", "block", "lo", (F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"))
    return raw.join(start, ["file", "block"]).select("file", (F.col("before") + F.col("i") - F.col("lo")).cast("bigint").alias("line_no"), "value")


def json_lines(spark: SparkSession, paths: str | Sequence[str], schema: str, start: dict[str, int] | int = 0, keep_bad: bool = False, **how) -> DataFrame:
    """``file, line_no, <fields>``: parsed lines from each file's start line on; blank lines are dropped and malformed ones too, unless
    kept (all fields NULL, text in ``_corrupt_record``)."""
    src = lines(spark, paths, **how)
    if isinstance(start, dict):
        at = F.coalesce(*[F.when(F.col("file").endswith(k), F.lit(v)) for k, v in start.items()], F.lit(0)) if start else F.lit(0)
    else:
        at = F.lit(start)
    src = src.filter((F.col("line_no") >= at) & (F.trim("value") != ""))
    p = src.select("file", "line_no", "value", F.from_json("value", f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("r"))
    out = p.select("file", "line_no", "r.*")
    return out if keep_bad else out.filter("_corrupt_record is null").drop("_corrupt_record")


def documents(spark: SparkSession, paths, schema: str = schemas.RAW_DOCUMENT, language: str = "metadata.language", strict: bool = False, **how) -> DataFrame:
    """Raw documents with ``language`` from a dotted path and ``raw_data_file_path``; with ``strict`` a document without language raises."""
    d = json_lines(spark, paths, schema, **how)
    d = d.withColumn("language", F.col(language)).withColumn("raw_data_file_path", F.regexp_replace("file", "^file:(//)?", ""))
    if strict:
        none = F.coalesce(F.length("language"), F.lit(0)) == 0
        d = d.filter(F.when(none, F.raise_error(F.concat(F.lit(f"no {language} in "), "file", F.lit(" line "), F.col("line_no").cast("string"))).cast("boolean")).otherwise(True))
    return d


def labelled_texts(spark: SparkSession, path: str, text: str = "text", score: str = "scores struct<score:double>") -> DataFrame:
    """``file, line_no, text, <scores>`` of a JSON-line file or of all such files below a folder; FileNotFoundError where nothing is, ValueError for anything else."""
    p = Path(path)
    if not p.exists():
        raise FileNotFoundError(path)
    found = [path] if p.is_file() and p.suffix == ".jsonl" else find(path) if p.is_dir() else []
    if not found:
        raise ValueError(f"{path} is no JSON-line file and no folder that holds some")
    return json_lines(spark, found, f"`{text}` string, {score}")


def annotations(spark: SparkSession, paths, first_line_meta: bool = False, **how) -> DataFrame:
    """Annotation rows; rows without document id or scores raise. ``first_line_meta`` gives all rows of a file the prompt and model of its first."""
    d = json_lines(spark, paths, schemas.ANNOTATION, **how)
    bad = F.col("document_id").isNull() | F.col("scores").isNull()
    d = d.filter(F.when(bad, F.raise_error(F.concat(F.lit("annotation without document_id or scores: "), "file")).cast("boolean")).otherwise(True))
    if first_line_meta:
        f = d.groupBy("file").agg(F.min_by(F.struct("meta_information"), "line_no").alias("_m"))  # one row a file
        d = d.join(f, "file").withColumn("meta_information", F.col("_m.meta_information").withField("raw_data_file_path", F.col("meta_information.raw_data_file_path"))).drop("_m")
    return d


def human_annotations(spark: SparkSession, paths, **how) -> DataFrame:
    return json_lines(spark, paths, "document_id string, scores array<double>", **how)


def metric_results(spark: SparkSession, folder: str) -> DataFrame:
    """``lang, annotator, metrics, CM`` of ``ir_<annotator>_gt.json`` and ``ir_gt_<annotator>.json`` files; language is the parent folder.

    Annotators may hold any character. A file without ``gt`` in first or last place raises; broken files are left out.
    """
    d = spark.read.option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "ir_*.json").option("mode", "DROPMALFORMED").schema(schemas.IR_RESULT).json(folder)
    d = d.withColumn("file", F.col("_metadata.file_path"))
    stem = F.url_decode(F.replace(F.regexp_extract("file", r"([^/]+)\.json$", 1), F.lit("+"), F.lit("%2B")))
    first, last = F.regexp_extract(stem, "^ir_gt_(.+)$", 1), F.regexp_extract(stem, "^ir_(.+)_gt$", 1)
    who = F.when(first != "", first).when(last != "", last).otherwise(F.raise_error(F.concat(F.lit("no ground truth in "), "file")))
    return d.select(F.regexp_extract("file", r"([^/]+)/[^/]+$", 1).alias("lang"), who.alias("annotator"), "metrics", "CM", "file")


def batch_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``file, line_no, response, _corrupt_record`` of all ``batch_results.jsonl`` below a folder, malformed lines with their text."""
    paths = find(folder, "batch_results.jsonl")
    if not paths:
        return spark.createDataFrame([], f"file string, line_no bigint, {schemas.BATCH_RESULT}, _corrupt_record string")
    return json_lines(spark, paths, schemas.BATCH_RESULT, keep_bad=True)


def batch_results(spark: SparkSession, folder: str) -> DataFrame:
    """``folder, model, prompt_tokens, cached_tokens, completion_tokens, total_tokens``; results without body, usage or model are dropped, as are malformed lines."""
    b = F.col("response.body")
    return batch_lines(spark, folder).select(
        F.regexp_extract(F.col("file"), r"([^/]+)/[^/]+$", 1).alias("folder"), b["model"].alias("model"), b["usage"]["prompt_tokens"].alias("prompt_tokens"),
        F.coalesce(b["usage"]["prompt_tokens_details"]["cached_tokens"], F.lit(0)).alias("cached_tokens"), b["usage"]["completion_tokens"].alias("completion_tokens"), b["usage"]["total_tokens"].alias("total_tokens"),
    ).filter("model is not null and prompt_tokens is not null")


def batch_losses(spark: SparkSession, folder: str) -> DataFrame:
    """``folder, malformed, incomplete``: lines of each folder that ``batch_results`` leaves out."""
    b = F.col("response.body")
    bad = F.col("_corrupt_record").isNotNull()
    less = ~bad & (b["model"].isNull() | b["usage"]["prompt_tokens"].isNull())
    return batch_lines(spark, folder).groupBy(F.regexp_extract(F.col("file"), r"([^/]+)/[^/]+$", 1).alias("folder")).agg(F.count_if(bad).alias("malformed"), F.count_if(F.coalesce(less, F.lit(True)) & ~bad).alias("incomplete"))


def hash_list(spark: SparkSession, path: str) -> DataFrame:
    schema = "file_path string, md5 string"
    if not os.path.exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).csv(path, header=True)


def file_digests(spark: SparkSession, paths: Sequence[str], chunk: int = 1 << 20) -> DataFrame:
    """``file_path, md5`` of whole files, read in pieces inside the tasks, so files of any size do."""
    import hashlib

    import pandas as pd

    def run(it):
        for p in it:
            out = []
            for f in p["file_path"]:
                h = hashlib.md5()
                with open(f, "rb") as fh:
                    while b := fh.read(chunk):
                        h.update(b)
                out.append(h.hexdigest())
            yield pd.DataFrame({"file_path": p["file_path"], "md5": out})

    d = spark.createDataFrame([(p,) for p in paths], "file_path string").repartition(max(1, min(len(paths), 1000)))
    return d.mapInPandas(run, "file_path string, md5 string")


def embeddings(spark: SparkSession, path: str, x: str = "embedding", y: str = "label", training: bool = True) -> DataFrame:
    """Embedding sets are Parquet here; HDF5 shards are read when h5py can be imported. A broken or empty shard raises in training and is left out elsewhere."""
    if path.endswith((".h5", ".hdf5")) or find(path, "*.h5") or find(path, "*.hdf5"):
        try:
            import h5py  # noqa: F401
        except ImportError as e:
            raise RuntimeError("HDF5 shards need h5py; convert them to Parquet") from e
        return _hdf5(spark, [path] if path.endswith((".h5", ".hdf5")) else [*find(path, "*.h5"), *find(path, "*.hdf5")], training)
    return spark.read.parquet(path).select(F.col(x).cast("array<float>").alias("embedding"), F.col(y).alias("label"))


def _hdf5(spark: SparkSession, paths: list[str], training: bool, group: str | None = None) -> DataFrame:
    import pandas as pd

    def run(it):
        import h5py

        for p in it:
            for f in p["path"]:
                try:
                    with h5py.File(f) as h:
                        g = h[group] if group in h else h[next(iter(h))]
                        if not len(g["embeddings"]):
                            raise ValueError(f"{f} is empty")
                        for lo in range(0, len(g["embeddings"]), 4096):
                            yield pd.DataFrame({"embedding": list(g["embeddings"][lo : lo + 4096]), "label": list(g["labels"][lo : lo + 4096])})
                except (OSError, KeyError, StopIteration, ValueError) as e:
                    if training:
                        raise RuntimeError(f"broken shard {f}") from e

    return spark.createDataFrame([(p,) for p in paths], "path string").repartition(len(paths)).mapInPandas(run, "embedding array<float>, label array<float>")


def yaml_file(path: str) -> dict:
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f)
