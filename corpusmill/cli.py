"""Command line: ``python -m corpusmill.cli <command> --help``."""

from __future__ import annotations

import argparse
import json
import os
import sys
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import functions as F

from corpusmill import schemas, session
from corpusmill.functions import text as tx
from corpusmill.functions import votes as votes_fn
from corpusmill.operators import agreement, annotate, classifier, corpus, head, report, tokens, votes
from corpusmill.sources import files, sinks

COMMANDS: dict[str, tuple[Callable, list[tuple]]] = {}


def command(*options: tuple):
    def deco(fn):
        COMMANDS[fn.__name__] = (fn, list(options))
        return fn

    return deco


def _local(client: str):
    """``module:function`` of a model client or translator."""
    mod, _, name = client.partition(":")
    return getattr(__import__(mod, fromlist=[name]), name)


IN, OUT = ("--input", {"required": True}), ("--output", {"required": True})


RUN = (
    ("--prompt", {"required": True}), ("--model", {"default": "model"}), ("--lang", {"default": "en"}), ("--id", {"default": "id"}), ("--language-field", {"default": "metadata.language"}),
    ("--max-tokens", {"type": int}), ("--tokenizer", {"default": "corpusmill.operators.tokens:WordTokenizer"}), ("--remove", {"action": "append", "default": []}), ("--start", {"type": int, "default": 0}),
)


def _prompted(spark, a):
    """(prompts of the valid documents with their places, prompt file); the others are written beside the output."""
    paths = [a.input] if Path(a.input).is_file() else files.find(a.input, required=True)
    docs = files.documents(spark, paths, f"{a.id} string, text string, metadata struct<language:string>" if a.id != "id" else schemas.RAW_DOCUMENT, a.language_field, start=a.start)
    ok, bad = annotate.valid_documents(docs, a.id, "text", "language")
    sinks.named_lines(bad.select(F.lit("rejected.jsonl").alias("name"), "file", "line_no", F.to_json(F.struct("file", "line_no")).alias("value")), a.output, "name", ["file", "line_no"])
    p = files.yaml_file(a.prompt)
    if a.max_tokens is None:
        pr = annotate.prompts(ok, "text", p["prompt"], "placeholder", remove=a.remove)
    else:
        pr = tokens.truncated_prompts(ok, "text", p["prompt"], "placeholder", _local(a.tokenizer)(), a.max_tokens, remove=a.remove)
    return pr, p, Path(paths[0]).parent if len(paths) == 1 else Path(os.path.commonpath(paths))


def _annotation_lines(rows, root, model: str, prompt: str, lang: str):
    names = [c.split()[0] for c in schemas.ANNOTATION.split(", ")] + (["request"] if "request" in rows.columns else [])
    src = F.col("meta_information.raw_data_file_path")
    name = F.concat(F.lit("generated_annotations/"), sinks.folder_below(src, str(root)), sinks.annotation_file(src, F.lit(model), F.lit(prompt), F.lit(lang)))
    return rows.select(name.alias("name"), "line_no", F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("value"))


@command(IN, OUT, *RUN, ("--client", {"required": True}), ("--metric", {"default": "educational_score"}), ("--retries", {"type": int, "default": 2}), ("--backoff", {"type": float, "default": 0.4}))
def score_documents(spark, a):
    """One annotation file for each input file, in its order, and throughput.json; a ServerError ends the run without it."""
    began = time.time()
    pr, p, root = _prompted(spark, a)
    client = annotate.with_retries(_local(a.client), a.retries, a.backoff)
    name = p.get("prompt_name", "")
    rows = annotate.annotate(pr, client, a.id, a.metric, name, a.lang, a.model, "raw_data_file_path", keep=["line_no"])
    sinks.named_lines(_annotation_lines(rows, root, a.model, name, a.lang), a.output, "name", ["line_no"], append=a.start > 0)
    done = files.annotations(spark, files.find(f"{a.output}/generated_annotations", required=True)) if files.find(f"{a.output}/generated_annotations") else None
    n, rate = done.agg(F.count("*"), F.avg("meta_information.out_tokens_per_second")).first() if done is not None else (0, None)
    took = time.time() - began
    record = {"mean_out_tokens_per_second": rate, "num_documents_written": n, "elapsed_time_s": took, "documents_per_second": n / took, "model_name": a.model}
    Path(a.output, "throughput.json").write_text(json.dumps(record), encoding="utf-8")


@command(IN, OUT, *RUN, ("--options", {"default": "{}", "help": "generation options as JSON"}))
def collect_requests(spark, a):
    """Annotation files that hold requests in place of answers."""
    pr, p, root = _prompted(spark, a)
    name = p.get("prompt_name", "")
    r = annotate.requests(pr, a.id, a.model, json.loads(a.options))
    none = lambda kind: F.array().cast(f"array<{kind}>")
    meta = F.struct(F.lit(name).alias("prompt_name"), F.lit(a.lang).alias("prompt_lang"), F.lit(a.model).alias("model"), F.col("raw_data_file_path"), F.lit(None).cast("double").alias("out_tokens_per_second"))
    cols = {"document_id": F.col("custom_id"), "scores": none("double"), "explanations": none("string"), "errors": none("array<string>"), "time_stamps": none("bigint"), "document_processing_status": F.array(F.lit("request_collected")), "meta_information": meta}
    rows = r.select(*[c.alias(k) for k, c in cols.items()], F.struct("custom_id", "method", "url", "body").alias("request"), "line_no")
    sinks.named_lines(_annotation_lines(rows, root, a.model, name, a.lang), a.output, "name", ["line_no"])


@command(IN, OUT, ("--sort", {"default": "mean_regex_match_rate:desc", "help": "column:asc,column:desc"}), ("--metric", {"default": "mean_regex_match_rate"}))
def compare_experiments(spark, a):
    """Experiments below a folder (each with throughput.json and annotation files) or, from a JSON-line file, rows of their metrics, ranked."""
    if Path(a.input).is_dir():
        rows = []
        for t in files.find(a.input, "throughput.json", required=True):  # one round an experiment
            ann = files.annotations(spark, files.find(str(Path(t).parent), "*annotations_*.jsonl", required=True))
            common = ann.select(votes_fn.most_common(votes_fn.valid_votes(F.col("scores"))).alias("score")).agg(F.avg("score")).first()[0]
            rows.append(json.loads(Path(t).read_text(encoding="utf-8")) | {"mean_regex_match_rate": report.match_rate(ann).first()[0], "mean_score": common, "experiment_path": str(Path(t).parent)})
        d = _frame(spark, rows)
    else:
        d = spark.read.json(a.input)
    sort = [(c.split(":")[0], not c.endswith(":desc")) for c in a.sort.split(",")]
    print(*sinks.experiment_report(report.rank_experiments(d, sort, a.metric), json.dumps(vars(a), default=str), a.output))


def _frame(spark, rows: list[dict]):
    """Records with numbers and texts as a frame; numbers are doubles."""
    names = sorted({k for r in rows for k in r})
    num = {k for k in names if all(isinstance(r.get(k), (int, float, type(None))) for r in rows)}
    data = [tuple(None if r.get(k) is None else float(r[k]) if k in num else str(r[k]) for k in names) for r in rows]
    return spark.createDataFrame(data, ", ".join(f"`{k}` {'double' if k in num else 'string'}" for k in names))


@command(IN, OUT, ("--lines", {"type": int, "required": True}))
def chunk_jsonl(spark, a):
    d = files.lines(spark, a.input)
    sinks.chunks(corpus.chunked(d, ["file", "line_no"], a.lines).select("chunk", "line", "value"), a.output)


@command(IN, OUT)
def add_target_language_to_prompt_yaml(spark, a):
    import yaml

    p = files.yaml_file(a.input)
    Path(a.output).mkdir(parents=True, exist_ok=True)
    for code, text in annotate.prompts_by_language(p["prompt"], schemas.LANGUAGES).items():
        (Path(a.output) / f"{Path(a.input).stem}_{code}.yaml").write_text(yaml.safe_dump({**p, "prompt": text}, allow_unicode=True), encoding="utf-8")


@command(IN, OUT, ("--translator", {"required": True}), ("--source", {"default": "en"}), ("--targets", {"required": True}))
def translate_flat_yaml(spark, a):
    import yaml

    d, tr = files.yaml_file(a.input), _local(a.translator)
    for code in tx_list(a.targets):
        keys = [k for k, v in d.items() if isinstance(v, str)]
        new = {**d, **dict(zip(keys, tr([d[k] for k in keys], a.source, code)))}
        Path(a.output).mkdir(parents=True, exist_ok=True)
        (Path(a.output) / f"{Path(a.input).stem}_{code}.yaml").write_text(yaml.safe_dump(new, allow_unicode=True), encoding="utf-8")


@command(IN, OUT, ("--translator", {"required": True}), ("--source", {"default": "en"}), ("--targets", {"required": True}))
def translate_jsonl_to_multiple_languages_cli(spark, a):
    d = spark.read.json(a.input)
    annotate.translate(d, "text", a.source, tx_list(a.targets), _local(a.translator), list(schemas.LANGUAGES)).write.mode("overwrite").partitionBy("target_code").json(a.output)


def tx_list(s: str) -> list[str]:
    return [x.strip().lower() for x in s.split(",") if x.strip()]


def _scores(spark, a):
    return votes.score_frame(files.annotations(spark, files.find(a.input, "*annotations_*.jsonl", required=True)), a.aggregation)


AGG = ("--aggregation", {"default": "majority", "choices": ["min", "max", "mean", "majority"]})


@command(IN, OUT, AGG, ("--truth", {"default": "gt"}))
def plot_scores(spark, a):
    """The data of all plots: score and difference histograms, quartiles, confusion shares and truth of invalid predictions."""
    sc = _scores(spark, a)
    Path(a.output).mkdir(parents=True, exist_ok=True)
    p = agreement.pairs(sc).cache()
    gt = agreement.against(p, a.truth)
    frames = {
        "histogram": agreement.histogram(sc, "score", ["prompt", "annotator"]), "differences": agreement.difference_histogram(p), "quartiles": agreement.difference_quartiles(p),
        "confusion": agreement.normalised(agreement.confusion(gt)), "invalid": agreement.invalid_truth_histogram(gt),
    }
    for name, f in frames.items():
        sinks.json_report(f.orderBy(*f.columns), f"{a.output}/{name}.json")
    p.unpersist()


@command(IN, OUT, AGG, ("--truth", {"default": "gt"}), ("--thresholds", {"default": "3"}))
def evaluate_predicted_annotations(spark, a):
    """``<output>/<language>/ir_<a>_<b>.json``; the language is the folder of the annotation file."""
    ann = files.annotations(spark, files.find(a.input, "*annotations_*.jsonl", required=True), first_line_meta=True)
    sc = votes.score_frame(ann, a.aggregation, keep=["file"]).withColumn("lang", F.regexp_extract("file", r"([^/]+)/[^/]+$", 1)).cache()
    truth = sc.filter(F.col("annotator") == a.truth)
    for lang in sorted(r[0] for r in sc.filter(F.col("annotator") != a.truth).select("lang").distinct().collect()):  # one round a language
        own = sc.filter((F.col("lang") == lang) & (F.col("annotator") != a.truth))
        p = agreement.pairs(own.unionByName(truth)).filter((F.col("annotator_0") == a.truth) | (F.col("annotator_1") == a.truth)).cache()
        m, classes = agreement.full_report(p, a.truth, [float(x) for x in a.thresholds.split(",")])
        print(*sinks.pair_metrics_json(m, agreement.confusion(agreement.against(p, a.truth)), f"{a.output}/{lang}", classes), sep="\n")
        p.unpersist()
    sc.unpersist()


@command(IN, OUT, AGG, ("--raw", {"required": True}), ("--raw-lookup", {"help": "folder whose files stand for raw files of the same name"}), ("--id", {"default": "id"}))
def aggregate_scores(spark, a):
    ann = files.annotations(spark, files.find(a.input, "*annotations_*.jsonl", required=True), first_line_meta=True)
    s = votes.score_frame(ann, a.aggregation, keep=["file", "line_no"])
    paths = files.find(a.raw_lookup or a.raw, required=True) if Path(a.raw_lookup or a.raw).is_dir() else [a.raw_lookup or a.raw]
    raw = files.json_lines(spark, paths, f"{a.id} string").select(F.regexp_replace("file", "^file:(//)?", "").alias("file_path"), F.col(a.id).alias("doc_id"), "line_no")
    if a.raw_lookup:
        s = votes.retargeted(s, raw)
    s = s.cache()
    for who in sorted(r[0] for r in s.select("annotator").distinct().collect()):  # one round an annotator
        last = votes.last_scores(s.filter(F.col("annotator") == who), "file", "line_no")
        mine = raw.join(last.select(F.col("raw_data_file_path").alias("file_path")).distinct(), "file_path", "left_semi")
        left_out = sinks.aggregated_scores(mine, last, a.output, a.aggregation, a.id, who, os.path.commonpath([str(Path(p).parent) for p in paths]))
        print(who, "incomplete files:", left_out)
    s.unpersist()


@command(IN, OUT, AGG)
def aggregate_human_annotations(spark, a):
    """Every line of a human annotation file with its aggregated score, and without the single votes."""
    d = files.human_annotations(spark, a.input)
    d = d.select(F.concat(sinks.stem_of(F.col("file")), F.lit(f"_aggregated_scores_{a.aggregation}.jsonl")).alias("name"), "line_no", F.col("document_id").alias("doc_id"), votes_fn.aggregate(F.col("scores"), a.aggregation).alias("score"))
    sinks.named_lines(d.withColumn("value", sinks.score_lines(d, a.aggregation, "document_id")), a.output, "name", ["line_no"])


@command(IN, OUT, ("--field", {"required": True}))
def remove_field_from_jsonl_file(spark, a):
    d = files.lines(spark, [a.input] if Path(a.input).is_file() else files.find(a.input, required=True))
    sinks.without_field(d.withColumn("name", F.regexp_extract("file", r"([^/]+)$", 1)), a.field, a.output)


@command(IN, OUT, ("--top-n", {"type": int, "default": 4}), ("--metrics", {"help": "comma list of the reported metrics, all by default"}))
def collect_ir_metrics(spark, a):
    d = files.metric_results(spark, a.input).cache()
    long = d.select("lang", "annotator", F.explode("metrics").alias("metric", "value"))
    names = sorted(r[0] for r in long.select("metric").distinct().collect())
    names = [n for n in names if not a.metrics or n in a.metrics.split(",")]
    wide = long.groupBy("lang", "annotator").pivot("metric", names).agg(F.first("value"))
    total = report.cross_language(wide, names, [n for n in names if n.lower() == "invalid"]).orderBy("annotator")
    low = [n for n in names if n.lower() in ("mae", "mse", "invalid")]
    Path(a.output).mkdir(parents=True, exist_ok=True)
    Path(a.output, "ir_summary_gt.tex").write_text(sinks.latex(total, {n: "min" if n in low else "max" for n in names}), encoding="utf-8")
    sinks.json_report(report.top_n(long.filter(F.col("metric").isin(*names)), a.top_n, low), f"{a.output}/top_n.json")
    cm = report.one_confusion(d.select("lang", "annotator", "file", F.explode("CM").alias("label", "row")).select("lang", "annotator", "file", "label", F.explode("row").alias("prediction", "n")))
    sinks.json_report(agreement.normalised(report.cross_language_confusion(cm)).orderBy("annotator", "label", "prediction"), f"{a.output}/confusion.json")
    if "spearman" in names:
        sinks.json_report(report.pivot_metric(wide, "lang", "annotator", "spearman").orderBy("lang"), f"{a.output}/spearman.json")
    d.unpersist()


@command(IN, OUT)
def compute_num_words_in_jsonl_cli(spark, a):
    d = spark.read.schema("text string").json(a.input)
    sinks.json_report(corpus.word_totals(d, "text"), a.output)
    sinks.json_report(corpus.word_histogram(d, "text").orderBy("n_words"), a.output + ".histogram.json")


@command(IN, OUT)
def count_words_in_jsonl_files_cli(spark, a):
    d = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl").schema("text string").json(a.input).select("text", F.col("_metadata.file_path").alias("file"))
    every = spark.createDataFrame([(f"file://{p}",) for p in files.find(a.input)], "file string")
    sinks.json_report(every.join(corpus.word_totals(d, "text", ["file"]), "file", "left").fillna(0).orderBy("file"), a.output)


@command(IN, OUT, ("--column", {"required": True}), ("--sizes", {"required": True, "help": "value:n,value:n"}), ("--id", {"default": "id"}), ("--seed", {"type": int, "default": 42}))
def sample_from_hf_dataset(spark, a):
    sizes = {k: int(n) for k, n in (x.rsplit(":", 1) for x in a.sizes.split(","))}
    corpus.stratified_sample(spark.read.json(a.input), a.column, sizes, a.id, a.seed).write.mode("overwrite").json(a.output)


@command(IN, OUT, ("--model", {"required": True}), ("--limit", {"type": int}), ("--size", {"type": int, "default": 50_000}))
def submit_batch_requests(spark, a):
    """Collected requests as batch files of at most ``size``, under ``<output>/<input stem>/offset_<i>.jsonl``. They are not sent: that needs the service."""
    sinks.batch_requests(annotate.readdressed(files.lines(spark, files.find(a.input, required=True)), a.model), a.output, a.size, a.limit)
    print("written, not sent: sending needs an external service")


def _upload(spark, a):
    raise SystemExit("not supported: uploading needs an external service")


COMMANDS["upload_file_to_hf"] = (_upload, [IN])


@command(IN, OUT, ("--id", {"default": "id"}), ("--keep-parts", {"default": "0"}))
def merge_and_sort_jsonl_files_cli(spark, a):
    paths = files.find(a.input, recursive=False, required=True)
    corpus.consistent_part([Path(p).stem for p in paths], "_", [int(x) for x in a.keep_parts.split(",")])
    corpus.merge_sorted([spark.read.json(paths)], a.id).write.mode("overwrite").json(a.output)


@command(IN, OUT, ("--id", {"default": "id"}), ("--text", {"default": "text"}))
def deduplicate_jsonl(spark, a):
    d = files.json_lines(spark, a.input, f"{a.id} string, {a.text} string")
    corpus.dedup(d, a.id, a.text, ["file", "line_no"]).orderBy("file", "line_no").select(a.id, a.text).write.mode("overwrite").json(a.output)


@command(IN, OUT, ("--id", {"default": "id"}), ("--text", {"default": "text"}))
def deduplicate_dir(spark, a):
    d = files.json_lines(spark, files.find(a.input, recursive=False, required=True), f"{a.id} string, {a.text} string")
    sinks.ordered_json(corpus.dedup(d, a.id, a.text, ["line_no"], ["file"]), a.output, ["file"], ["line_no"])


@command(IN, OUT, ("--text", {"default": "text"}), ("--score", {"default": "score"}))
def convert_hf_dataset_to_jsonl(spark, a):
    d = spark.read.parquet(a.input).withColumn("_o", F.monotonically_increasing_id())
    d = corpus.global_index(d, ["_o"])
    d.select(F.col("line").cast("string").alias("id"), F.col(a.text).alias("text"), F.struct(F.col(a.score).alias("score")).alias("scores")).write.mode("overwrite").json(a.output)


@command(IN, OUT, ("--id", {"default": "id"}), ("--ratios", {"default": "0.8,0.1,0.1"}), ("--seed", {"type": int, "default": 42}))
def create_train_val_test_split(spark, a):
    d = spark.read.json(a.input)
    sinks.splits(corpus.exact_split(d, a.id, [float(x) for x in a.ratios.split(",")], a.seed), a.output, [a.id])


@command(IN, OUT, ("--id", {"default": "id"}), ("--transforms", {"default": ",".join(tx.TRANSFORMS)}), ("--seed", {"type": int, "default": 42}))
def apply_score_transforms(spark, a):
    d = spark.read.json(a.input)
    corpus.transformed(d, F.col("scores.score"), a.id, a.transforms.split(","), a.seed).write.mode("overwrite").json(a.output)


@command(IN, OUT)
def hash_files_to_csv(spark, a):
    there = spark.createDataFrame([(p,) for p in files.find(a.input, "*")], "file_path string")
    new = [r[0] for r in corpus.unprocessed(there, files.hash_list(spark, a.output), "file_path").collect()]  # as many as the listing
    if new:
        sinks.append_hashes(files.file_digests(spark, sorted(new)), a.output)


@command(IN, OUT, ("--rates", {"required": True, "help": "JSON lines: rate_key, input, cached_input, output"}))
def get_costs_of_openai_batched_requests(spark, a):
    rates = spark.read.schema("rate_key string, input double, cached_input double, output double").json(a.rates)
    f = report.usage_by_folder(report.usage_cost(files.batch_results(spark, a.input), rates)).orderBy("folder")
    total = report.grand_totals(f, ["prompt_tokens", "completion_tokens", "cost"], len(schemas.LANGUAGES))
    Path(a.output).write_text(sinks.markdown(f) + "\n" + sinks.markdown(total), encoding="utf-8")


@command(IN, OUT, ("--hidden", {"type": int, "default": 64}), ("--epochs", {"type": int, "default": 20}), ("--steps", {"type": int, "default": 1, "help": "mini-batches of an epoch"}), ("--seed", {"type": int, "default": 42}), ("--evaluation", {"action": "append", "default": [], "help": "name=path"}), ("--metric", {"default": "eval_val_loss"}))
def train_with_embeddings(spark, a):
    labelled = lambda path, training: files.embeddings(spark, path, training=training).withColumn("label", F.array(F.col("label").cast("double"))).filter("embedding is not null")
    d = labelled(a.input, True)
    dim = d.agg(F.max(F.size("embedding"))).first()[0]
    if not dim:
        raise SystemExit("no embeddings to train on")
    sets = {k: labelled(v, False) for k, _, v in (x.partition("=") for x in a.evaluation)} or None
    h, losses = head.train(d, "embedding", "label", head.Head.fresh(dim, a.hidden, 1, a.seed), a.epochs, stop=head.EarlyStop(), steps=a.steps, evaluation=sets, metric=a.metric)
    at = Path(a.output, "final")
    at.mkdir(parents=True, exist_ok=True)
    (at / "head.json").write_text(json.dumps({"losses": losses, "weights": [w.tolist() for w in h.parts()]}), encoding="utf-8")


@command(IN, OUT)
def calculate_classification_metrics(spark, a):
    d = spark.read.json(a.input).withColumn("task", F.lit("all"))
    sinks.json_report(classifier.report(classifier.class_table(d, F.col("truth"), F.col("pred"))), a.output)
    sinks.json_report(classifier.confusion(d, F.col("truth"), F.col("pred")).orderBy("truth", "pred"), a.output + ".confusion.json")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="corpusmill")
    sub = ap.add_subparsers(dest="command", required=True)
    for name, (_, options) in COMMANDS.items():
        p = sub.add_parser(name)
        for flag, kw in options:
            p.add_argument(flag, **kw)
    a = ap.parse_args(argv)
    COMMANDS[a.command][0](session.session(), a)
    return 0


if __name__ == "__main__":
    sys.exit(main())
