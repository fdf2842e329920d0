"""Goldens and edge cases of the core operators."""

import json
import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from corpusmill import schemas
from corpusmill.functions import text as tx
from corpusmill.functions import votes as vt
from corpusmill.operators import agreement, annotate, classifier, corpus, head, project, report, tokens, votes
from corpusmill.sources import files, sinks
from corpusmill.streaming import incremental

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import this module


def one(spark, expr_df):
    return expr_df.first()[0]


@pytest.mark.parametrize("v,majority,common,mean", [([4, 2, 2, 3, 3, 5], 2.5, 2, 19 / 6), ([], None, None, None), ([None, 1, 9, float("nan")], 1.0, 1, 1.0), ([3, 3, 1], 3.0, 3, 7 / 3), ([5, 1], 3.0, 5, 3.0)])
def test_vote_aggregation(spark, v, majority, common, mean):
    df = spark.createDataFrame([([None if x is None else float(x) for x in v],)], "scores array<double>")
    got = df.select(vt.aggregate(F.col("scores"), "majority"), vt.most_common(vt.valid_votes(F.col("scores"))), vt.aggregate(F.col("scores"), "mean")).first()
    assert [None if x is None else round(x, 9) for x in got] == [None if x is None else round(x, 9) for x in (majority, common, mean)]


def test_unknown_strategy_and_metric():
    with pytest.raises(NotImplementedError):
        vt.aggregate(F.lit(None), "median")
    with pytest.raises(ValueError):
        tx.SCORE_PATTERNS.pop("x", None)
        tx.extract_score("t", "x")


def test_text_functions(spark):
    df = spark.createDataFrame([("a\r\nb\x1c <x> c ",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(tx.clean_text(F.col("t"), ["<x>"])).collect()] == ["a b c ", None, ""]
    s = spark.createDataFrame([("Educational score: 3, then Educational score:\n4.5",), ("educational score: 3",), ("none",), ("Educational score: ٣",)], "t string")
    assert [r[0] for r in s.select(tx.extract_score(F.col("t"), "educational_score")).collect()] == [4.5, None, None, 3.0]
    assert [len(r[0]) for r in df.filter("t is not null").select(tx.words(F.col("t"))).collect()] == [4, 0]
    p = df.limit(1).select(tx.fill_prompt("{{x}} {t}!", "t", F.lit("{raw}"))).first()[0]
    assert p == "{x} {raw}!"
    r = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (None,)], "x double")
    assert [x[0] for x in r.select(tx.round_half_up(F.col("x"))).collect()] == [1, 2, 3, None]
    assert [x[0] for x in r.select(tx.round_half_even(F.col("x"))).collect()] == [0, 2, 2, None]


def rater_pairs(spark, rows):
    return spark.createDataFrame([("a", "b", str(i), float(x), float(y)) if x is not None and y is not None else ("a", "b", str(i), x, y) for i, (x, y) in enumerate(rows)], "annotator_0 string, annotator_1 string, doc_id string, score_0 double, score_1 double")


def test_perfect_agreement_and_invalid(spark):
    m = agreement.metrics(rater_pairs(spark, [(1, 1), (2, 2), (3, 3), (None, 2.0)])).first()
    assert (m.n_common, m.n_valid, m.invalid) == (4, 3, 1)
    assert [m.spearman, m.kendall, m.cohen, m.acc, m.ta_3] == pytest.approx([1] * 5) and m.mae == 0


def test_constant_and_empty_pairs(spark):
    m = agreement.metrics(rater_pairs(spark, [(2, 2), (2, 2)])).first()
    assert m.spearman is None and m.kendall is None and m.cohen is None
    assert agreement.metrics(rater_pairs(spark, []).limit(0)).count() == 0


def test_kendall_and_spearman_brute_force(spark):
    r = random.Random(1)
    rows = [(r.randint(0, 5), r.randint(0, 5)) for _ in range(80)]
    m = agreement.metrics(rater_pairs(spark, rows)).first()
    sign = lambda x: (x > 0) - (x < 0)
    num = t0 = t1 = 0
    for i in range(80):
        for j in range(i):
            a, b = sign(rows[i][0] - rows[j][0]), sign(rows[i][1] - rows[j][1])
            num, t0, t1 = num + a * b, t0 + (a != 0), t1 + (b != 0)
    assert m.kendall == pytest.approx(num / (t0 * t1) ** 0.5)
    rank = lambda v: [sum(y < x for y in v) + (sum(y == x for y in v) + 1) / 2 for x in v]
    x, y = rank([a for a, _ in rows]), rank([b for _, b in rows])
    mx, my = sum(x) / 80, sum(y) / 80
    cov = sum((a - mx) * (b - my) for a, b in zip(x, y))
    assert m.spearman == pytest.approx(cov / (sum((a - mx) ** 2 for a in x) * sum((b - my) ** 2 for b in y)) ** 0.5)


def test_krippendorff_and_fleiss_goldens(spark):
    # the textbook table of ten subjects, five categories and fourteen raters
    table = [[0, 0, 0, 0, 14], [0, 2, 6, 4, 2], [0, 0, 3, 5, 6], [0, 3, 9, 2, 0], [2, 2, 8, 1, 1], [7, 7, 0, 0, 0], [3, 2, 6, 3, 0], [2, 5, 3, 2, 2], [6, 5, 2, 1, 0], [0, 2, 2, 3, 7]]
    rows = [(str(i), float(s)) for i, r in enumerate(table) for s, n in enumerate(r) for _ in range(n)]
    k = agreement.fleiss(spark.createDataFrame(rows, "doc_id string, score double")).first()[0]
    assert k == pytest.approx(0.2099, abs=1e-4)
    same = spark.createDataFrame([("1", 1.0), ("1", 1.0), ("2", 4.0), ("2", 4.0), ("3", 2.0)], "doc_id string, score double")
    assert agreement.krippendorff(same).first()[0] == pytest.approx(1.0)


def test_truth_metrics_golden(spark):
    gt = spark.createDataFrame([("m", 1.0, 1.0), ("m", 2.0, 3.0), ("m", 3.0, 2.0), ("m", 4.0, None)], "annotator string, truth double, pred double")
    c = agreement.class_counts(gt).cache()
    assert {r.label: r.class_accuracy for r in agreement.class_accuracy(c).collect()} == {0: 0, 1: 1, 2: 0, 3: 0, 4: 0, 5: 0}
    f = agreement.f1_scores(c).first()
    assert f.macro_f1 == pytest.approx(1 / 3) and f.micro_f1 == pytest.approx(1 / 3)
    cm = {(r.label, r.prediction): r.n for r in agreement.confusion(gt).collect()}
    assert len(cm) == 42 and cm[4, -1] == 1 and cm[2, 3] == 1 and sum(cm.values()) == 4


def brute_dedup(rows):
    ids, texts, out = set(), set(), []
    for i, t in rows:
        if i in ids:
            continue
        ids.add(i)
        if (t or "") in texts:
            continue
        texts.add(t or "")
        out.append((i, t))
    return out


def test_dedup_equals_the_sequential_rule(spark):
    r = random.Random(2)
    rows = [(r.choice(["a", "b", "c", "d", None]), r.choice(["x", "y", "z", "", None])) for _ in range(60)]
    df = spark.createDataFrame([(n, i, t) for n, (i, t) in enumerate(rows)], "n int, id string, text string")
    got = [(x.id, x.text) for x in corpus.dedup(df, "id", "text", ["n"]).orderBy("n").collect()]
    assert got == brute_dedup(rows)
    assert corpus.dedup(df.limit(0), "id", "text", ["n"]).count() == 0


def test_numbering_splitting_sampling(spark):
    df = spark.range(103).withColumnRenamed("id", "i").repartition(7)
    n = corpus.chunked(df, ["i"], 10).collect()
    assert all(x.i == x.line and x.chunk == x.i // 10 for x in n) and len(n) == 103
    a = {x.i: x.split for x in corpus.exact_split(df, "i", (0.7, 0.2, 0.1)).collect()}
    assert a == {x.i: x.split for x in corpus.exact_split(df.repartition(3), "i", (0.7, 0.2, 0.1)).collect()}
    assert sorted(list(a.values()).count(s) for s in ("train", "val", "test")) == [11, 20, 72]
    with pytest.raises(ValueError):
        corpus.exact_split(df, "i", (0.7, 0.2, 0.2))
    g = df.withColumn("v", F.col("i") % 3)
    assert {r.v: r.n for r in corpus.stratified_sample(g, "v", {"0": 5, "1": 1000}, "i").groupBy("v").agg(F.count("*").alias("n")).collect()} == {0: 5, 1: 34}
    m = corpus.merge_sorted([spark.createDataFrame([("10",), ("2",)], "id string"), spark.createDataFrame([("3",), ("1",)], "id string")], "id")
    assert [r.id for r in m.collect()] == ["1", "2", "3", "10"]
    with pytest.raises(Exception, match="ids differ"):
        corpus.equal_ids(df, df.filter("i > 0"), "i").count()
    with pytest.raises(ValueError):
        corpus.consistent_part(["a_1", "b_2"])


def test_files_keep_lines_and_starts(spark, tmp_path):
    for name, n in (("a", 40), ("b", 3)):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(json.dumps({"id": str(i), "text": "t"}) if i != 1 else "{bad" for i in range(n)) + "\n\n")
    paths = files.find(str(tmp_path))
    got = files.json_lines(spark, paths, "id string, text string", start={"a.jsonl": 5}).collect()
    assert sorted((r.line_no, r.id) for r in got if r.file.endswith("a.jsonl")) == [(i, str(i)) for i in range(5, 40)]
    assert [r.id for r in sorted((r for r in got if r.file.endswith("b.jsonl")), key=lambda r: r.line_no)] == ["0", "2"]
    with pytest.raises(FileNotFoundError):
        files.find(str(tmp_path), "*.none", required=True)
    d = files.file_digests(spark, paths).collect()
    assert len(d) == 2 and all(len(r.md5) == 32 for r in d)
    sinks.append_hashes(files.file_digests(spark, paths[:1]), str(tmp_path / "h.csv"))
    sinks.append_hashes(files.file_digests(spark, paths[1:]), str(tmp_path / "h.csv"))
    assert files.hash_list(spark, str(tmp_path / "h.csv")).count() == 2 and files.hash_list(spark, str(tmp_path / "no.csv")).count() == 0


def test_aggregated_scores_only_for_complete_files(spark, tmp_path):
    raw = spark.createDataFrame([("f", "1", 1), ("f", "2", 0), ("g", "1", 0), ("g", "9", 1)], "file_path string, doc_id string, line_no int")
    sc = spark.createDataFrame([("f", "1", None, 0), ("f", "2", 4.0, 0), ("f", "2", 2.0, 1), ("g", "1", 3.0, 0)], "raw_data_file_path string, doc_id string, score double, o int")
    assert sinks.aggregated_scores(raw, votes.last_scores(sc, "o"), str(tmp_path / "o"), "mean") == ["g"]
    rows = [json.loads(x) for p in (tmp_path / "o").rglob("*.jsonl") for x in p.read_text().splitlines()]
    assert [(r["id"], r["score"]) for r in rows] == [("2", 2.0), ("1", "invalid")] and [p.name for p in (tmp_path / "o").iterdir()] == ["f_aggregated_scores_mean.jsonl"]


def test_annotation_statuses(spark):
    docs = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c"), ("4", "d")], "id string, text string")
    answers = {"a": ["Educational score: 2", "x"], "b": ConnectionError("down"), "c": [None, ""], "d": ["Educational score: 5"]}
    p = annotate.prompts(docs, "text", "{t}", "t")
    a = {r.document_id: r for r in annotate.annotate(p, lambda ps: [answers[x] for x in ps], "id", "educational_score", "n", "en", "m/x").collect()}
    assert list(a["1"].document_processing_status) == ["success", "error_faulty_score"] and list(a["1"].scores) == [2.0, None]
    assert list(a["2"].document_processing_status) == ["error_server"] and list(a["3"].document_processing_status) == ["error_no_generated_text"] * 2
    assert a["4"].meta_information.model == "m/x"
    waits = []

    def down(ps):
        raise ConnectionError("x")

    assert isinstance(annotate.with_retries(down, 2, 0.4, waits.append)(["p"])[0], ConnectionError) and waits == [0.4, 0.8]
    with pytest.raises(Exception, match="500"):
        annotate.annotate(p, lambda ps: [annotate.ServerError("500")] * len(ps), "id", "educational_score", "n", "en", "m").count()
    assert tokens.differing_characters("abc", "abd") == 2
    with pytest.raises(ValueError):
        annotate.translate(docs, "text", "en", ["qq"], None, ["en"])
    assert len(schemas.LANGUAGES) == 37 == len(annotate.prompts_by_language("in {##TARGET_LANGUAGE##}", schemas.LANGUAGES))


def test_reports(spark):
    f = spark.createDataFrame([("en", "x", 1.0, 2), ("de", "x", None, 3), ("en", "y", 0.5, 0)], "lang string, annotator string, acc double, invalid int")
    got = {r.annotator: (r.acc, r.invalid) for r in report.cross_language(f, ["acc", "invalid"]).collect()}
    assert got == {"x": (0.5, 5), "y": (0.5, 0)}
    t = {(r.metric, r.annotator, r.top_n): r.n for r in report.top_n(report.long_metrics(f, ["lang", "annotator"], ["acc", "invalid"]), 2).collect()}
    assert t["acc", "x", 1] == 1 and t["acc", "y", 1] == 0 and t["acc", "y", 2] == 1 and t["invalid", "y", 1] == 1
    names = spark.createDataFrame([("m-1-mini",), ("m-1",), ("z",), (None,)], "model string")
    keys = spark.createDataFrame([("m", 1), ("m-1", 2), ("m-1-m", 3)], "rate_key string, r int")
    assert {r.model: r.r for r in report.longest_prefix(names, "model", keys, "rate_key").collect()} == {"m-1-mini": 3, "m-1": 2, "z": None, None: None}
    u = spark.createDataFrame([("a", "m-1-x", 1000, 400, 100), ("a", "none", 5, 0, 5)], "folder string, model string, prompt_tokens int, cached_tokens int, completion_tokens int")
    rates = spark.createDataFrame([("m-1", 2.0, 0.5, 8.0)], "rate_key string, input double, cached_input double, output double")
    assert report.usage_cost(u, rates).agg(F.sum("cost")).first()[0] == pytest.approx((600 * 2 + 400 * 0.5 + 100 * 8) / 1e6)
    assert report.match_rate(spark.createDataFrame([], "document_processing_status array<string>")).first()[0] == 0.0
    with pytest.raises(ValueError):
        report.rank_experiments(f, [("acc", False)], "lang")
    assert "\\textbf{1.000}" in sinks.latex(f.orderBy("acc"), {"acc": "max"})


def test_classifier_and_head(spark):
    d = spark.createDataFrame([("a", 1.0, 1.0), ("a", 2.0, 3.0), ("a", 3.0, 2.0), ("a", 1.0, 1.4)], "task string, truth double, pred double")
    r = {x["class"]: x for x in classifier.report(classifier.class_table(d, F.col("truth"), F.rint("pred"))).collect()}
    assert r[1.0].f1 == 1.0 and r[1.0].support == 2 and r[2.0].f1 == 0.0 and r[1.0].accuracy == 0.5
    assert classifier.squared_error(d.withColumn("truth", F.when(F.col("pred") > 2.5, -100.0).otherwise(F.col("truth"))), "sum").first()[0] == pytest.approx(1.16)
    with pytest.raises(ValueError):
        classifier.squared_error(d, "max")
    rnd = random.Random(3)
    e = [[rnd.uniform(-1, 1) for _ in range(8)] for _ in range(200)]
    df = spark.createDataFrame([(i, x, [2.5 + x[0] * 2]) for i, x in enumerate(e)], "i int, x array<float>, y array<double>")
    h, losses = head.train(df, "x", "y", head.Head.fresh(8, 16, 1), epochs=30, rate=0.05)
    assert losses[-1] < losses[0] / 2
    assert head.predict(df, "i", "x", h).count() == 200
    stop = head.EarlyStop(2)
    assert [stop(x) for x in (1.0, 1.0005, 1.0, 2.0)] == [False, False, True, False]
    with pytest.raises(ValueError):
        head.check_metric("eval_dev_acc", ["val"])


def test_incremental_files_are_processed_once(spark, tmp_path):
    src, out, cp = (tmp_path / x for x in ("in", "out", "cp"))
    src.mkdir()
    (src / "a.json").write_text('{"id": "1"}\n')
    run = lambda: incremental.process_new_files(spark, str(src), "id string", lambda d: d.withColumn("n", F.lit(1)), str(out), str(cp)).awaitTermination(60)
    run()
    (src / "b.json").write_text('{"id": "2"}\n')
    run()
    assert sorted(r.id for r in spark.read.parquet(str(out)).collect()) == ["1", "2"]


def test_commands_cover_the_interface():
    from corpusmill import cli

    assert {"score_documents", "aggregate_scores", "collect_ir_metrics", "apply_score_transforms", "train_with_embeddings"} <= set(cli.COMMANDS) and len(cli.COMMANDS) >= 25


def test_command_line_runs(spark, tmp_path):
    from corpusmill import cli

    (tmp_path / "in.jsonl").write_text("".join(json.dumps({"id": str(i % 4), "text": f"w {i % 3}"}) + "\n" for i in range(8)))
    assert cli.main(["deduplicate_jsonl", "--input", str(tmp_path / "in.jsonl"), "--output", str(tmp_path / "o")]) == 0
    rows = [json.loads(x) for p in sorted((tmp_path / "o").rglob("*.json")) for x in p.read_text().splitlines()]
    assert [r["id"] for r in rows] == ["0", "1", "2"]
    assert cli.main(["chunk_jsonl", "--input", str(tmp_path / "in.jsonl"), "--output", str(tmp_path / "c"), "--lines", "3"]) == 0
    assert len(list((tmp_path / "c").glob("chunk=*"))) == 3
    assert cli.main(["compute_num_words_in_jsonl_cli", "--input", str(tmp_path / "in.jsonl"), "--output", str(tmp_path / "w.json")]) == 0
    assert json.loads((tmp_path / "w.json").read_text())[0]["n_words"] == 16


def test_entry_without_the_optional_subpackage():
    import __spark_entry__ as e
    from corpusmill.plans import catalog

    assert set(catalog.ORACLE) <= set(catalog.QUERIES) <= set(e.queries())


def test_reports_hold_all_rows_or_fail(spark, tmp_path):
    sinks.json_report(spark.range(100_001), str(tmp_path / "r.json"))
    assert [r["id"] for r in json.loads((tmp_path / "r.json").read_text())] == list(range(100_001))
    sinks.json_report(spark.createDataFrame([("a", [1])], "x string, y array<int>"), str(tmp_path / "s.json"))
    assert (tmp_path / "s.json").read_text() == json.dumps([{"x": "a", "y": [1]}], indent=2)
    sinks.json_report(spark.range(0), str(tmp_path / "e.json"))
    assert (tmp_path / "e.json").read_text() == "[]"
    more = spark.range(10_001)
    raw = more.select(F.col("id").cast("string").alias("file_path"), F.lit("d").alias("doc_id"), F.lit(1).alias("line_no"))
    scores = spark.createDataFrame([], "raw_data_file_path string, doc_id string, score double")
    for fn in (sinks.markdown, lambda d: sinks.latex(d, {"id": "max"}), lambda d: sinks.experiment_report(d, "c", str(tmp_path)), lambda d: sinks.aggregated_scores(raw, scores, str(tmp_path / "a"), "mean")):
        with pytest.raises(ValueError, match="more than 10000 rows"):
            fn(more)


def lines_of(path):
    return [json.loads(x) for x in path.read_text(encoding="utf-8").splitlines()]


def answers(prompts):
    return [[f"Educational score: {len(p) % 6}", "none"] for p in prompts]


def refusing(prompts):
    return [annotate.ServerError("500") for _ in prompts]


def test_documents_are_scored_file_by_file_in_order(spark, tmp_path):
    from corpusmill import cli

    for lang, name, n in (("de", "a", 30), ("en", "b", 5)):
        (tmp_path / "raw" / lang).mkdir(parents=True)
        rows = [{"id": str(i), "text": "t" * i, "metadata": {"language": lang}} for i in range(n)]
        (tmp_path / "raw" / lang / f"{name}.jsonl").write_text("\n".join(map(json.dumps, rows)) + "\nbroken\n")
    (tmp_path / "p.yaml").write_text("prompt: 'Rate {placeholder}'\nprompt_name: edu\n")
    run = lambda out, client, *more: cli.main(["score_documents", "--input", str(tmp_path / "raw"), "--output", str(tmp_path / out), "--prompt", str(tmp_path / "p.yaml"), "--client", f"{__name__}:{client}", "--model", "velm/x-1", *more])
    run("o", "answers")
    got = {p.relative_to(tmp_path / "o").as_posix(): [r["document_id"] for r in lines_of(p)] for p in (tmp_path / "o").rglob("*annotations*.jsonl")}
    assert got == {"generated_annotations/de/a__annotations_velm--x-1_edu_en.jsonl": [str(i) for i in range(1, 30)], "generated_annotations/en/b__annotations_velm--x-1_edu_en.jsonl": [str(i) for i in range(1, 5)]}
    row = lines_of(tmp_path / "o" / "generated_annotations/en/b__annotations_velm--x-1_edu_en.jsonl")[0]
    assert row["scores"] == [0.0, None] and row["meta_information"]["model"] == "velm/x-1" and row["meta_information"]["raw_data_file_path"].endswith("raw/en/b.jsonl")
    assert json.loads((tmp_path / "o" / "throughput.json").read_text())["num_documents_written"] == 33
    assert len(lines_of(tmp_path / "o" / "rejected.jsonl")) == 2  # empty texts
    run("s", "answers", "--start", "3")
    assert [r["document_id"] for r in lines_of(next((tmp_path / "s").rglob("b__*.jsonl")))] == ["3", "4"]
    assert cli.main(["compare_experiments", "--input", str(tmp_path), "--output", str(tmp_path / "r")]) == 0
    table = next((tmp_path / "r").glob("*.md")).read_text()
    assert "velm/x-1" in table and table.count("\n") == 4 and "0.5000" in table  # one of two votes has a score
    with pytest.raises(Exception, match="500"):
        run("x", "refusing")
    assert not (tmp_path / "x" / "throughput.json").exists()


def annotation(doc, model, scores, file):
    meta = {"prompt_name": "edu", "prompt_lang": "en", "model": model, "raw_data_file_path": file, "out_tokens_per_second": 1.0}
    n = len(scores)
    return {"document_id": doc, "scores": scores, "explanations": [""] * n, "errors": [[]] * n, "time_stamps": [1] * n, "document_processing_status": ["success"] * n, "meta_information": meta}


def test_evaluation_and_collection_keep_models_with_slashes(spark, tmp_path):
    from corpusmill import cli

    truth = {str(i): i % 6 for i in range(40)}
    for lang, off in (("de", 7), ("en", 9)):
        (tmp_path / "ann" / lang).mkdir(parents=True)
        for model in ("velmora/velm_32b", "plain"):
            (tmp_path / "ann" / lang / f"annotations_{model.replace('/', '--')}.jsonl").write_text("".join(json.dumps(annotation(d, model, [float(s if int(d) % off else 5 - s)], "r.jsonl")) + "\n" for d, s in truth.items()))
    (tmp_path / "ann" / "annotations_gt.jsonl").write_text("".join(json.dumps(annotation(d, "gt", [float(s)], "r.jsonl")) + "\n" for d, s in truth.items()))
    assert cli.main(["evaluate_predicted_annotations", "--input", str(tmp_path / "ann"), "--output", str(tmp_path / "ir")]) == 0
    one = json.loads((tmp_path / "ir" / "de" / "ir_gt_velmora__velm_32b.json").read_text())
    assert {"fleiss", "krippendorff", "spearman", "CA-3", "F1-0", "Macro-F1"} <= set(one["metrics"]) and one["CM"]["0"]["0"] + one["CM"]["0"]["5"] == 7
    assert cli.main(["collect_ir_metrics", "--input", str(tmp_path / "ir"), "--output", str(tmp_path / "sum")]) == 0
    assert {r["annotator"] for r in json.loads((tmp_path / "sum" / "top_n.json").read_text())} == {"velmora__velm_32b", "plain"}
    assert "velm\\_32b" in (tmp_path / "sum" / "ir_summary_gt.tex").read_text()
    (tmp_path / "ir" / "de" / "ir_a_b.json").write_text("{}")
    with pytest.raises(Exception, match="no ground truth"):
        files.metric_results(spark, str(tmp_path / "ir")).collect()
    assert cli.main(["plot_scores", "--input", str(tmp_path / "ann"), "--output", str(tmp_path / "plot")]) == 0
    assert all((tmp_path / "plot" / f"{n}.json").exists() for n in ("histogram", "differences", "quartiles", "confusion", "invalid"))


def test_pair_statistics_from_cells_equal_those_of_items(spark):
    r = random.Random(5)
    rows = [(float(r.randint(0, 5)), float(r.randint(0, 5))) for _ in range(60)]
    p = rater_pairs(spark, rows)
    items = p.select("annotator_0", "annotator_1", "doc_id", F.explode(F.array("score_0", "score_1")).alias("score"))
    ct = agreement.contingency(p)
    assert agreement.pair_fleiss(ct).first().fleiss == pytest.approx(agreement.fleiss(items, agreement.PAIR).first().fleiss)
    assert agreement.pair_krippendorff(ct).first().krippendorff == pytest.approx(agreement.krippendorff(items, agreement.PAIR).first().krippendorff)


def test_scores_go_back_to_raw_files_of_the_same_name(spark, tmp_path):
    from corpusmill import cli

    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "r.jsonl").write_text("".join(json.dumps({"id": str(i)}) + "\n" for i in (2, 1, 0)))
    (tmp_path / "annotations_m.jsonl").write_text("".join(json.dumps(annotation(str(i), "a/m", [s], "/old/place/r.jsonl")) + "\n" for i, s in ((0, 1.0), (1, 2.5), (2, 3.0), (0, 4.0))))
    assert cli.main(["aggregate_scores", "--input", str(tmp_path), "--output", str(tmp_path / "o"), "--raw", str(tmp_path / "raw"), "--raw-lookup", str(tmp_path / "raw"), "--aggregation", "max"]) == 0
    got = lines_of(tmp_path / "o" / "r_a__m_aggregated_scores_max.jsonl")
    assert [(r["id"], r["score"]) for r in got] == [("2", 3.0), ("1", "invalid"), ("0", 4.0)]  # the last annotation of a document wins
    (tmp_path / "h.jsonl").write_text('{"document_id": "7", "scores": [1, 1, 3]}\n')
    assert cli.main(["aggregate_human_annotations", "--input", str(tmp_path / "h.jsonl"), "--output", str(tmp_path / "h")]) == 0
    assert lines_of(tmp_path / "h" / "h_aggregated_scores_majority.jsonl") == [{"document_id": "7", "score": 1.0, "aggregation_type": "majority"}]
    assert cli.main(["remove_field_from_jsonl_file", "--input", str(tmp_path / "h.jsonl"), "--output", str(tmp_path / "c"), "--field", "scores"]) == 0
    assert lines_of(tmp_path / "c" / "h.jsonl") == [{"document_id": "7"}]


def test_batch_requests_are_sliced_per_file(spark, tmp_path):
    from corpusmill import cli

    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.jsonl").write_text("".join(json.dumps({"id": str(i), "text": "x", "metadata": {"language": "en"}}) + "\n\n" for i in range(25)))
    (tmp_path / "p.yaml").write_text("prompt: 'Rate {placeholder}'\nprompt_name: edu\n")
    assert cli.main(["collect_requests", "--input", str(tmp_path / "raw"), "--output", str(tmp_path / "c"), "--prompt", str(tmp_path / "p.yaml"), "--options", '{"max_tokens": 5, "seed": 1}']) == 0
    assert cli.main(["submit_batch_requests", "--input", str(tmp_path / "c" / "generated_annotations"), "--output", str(tmp_path / "b"), "--model", "gpt-5-mini", "--size", "10", "--limit", "22"]) == 0
    got = {p.name: [r["custom_id"] for r in lines_of(p)] for p in (tmp_path / "b").rglob("*.jsonl")}
    assert got == {"offset_0.jsonl": [str(i) for i in range(10)], "offset_10.jsonl": [str(i) for i in range(10, 20)], "offset_20.jsonl": ["20", "21"]}
    r = lines_of(next((tmp_path / "b").rglob("offset_0.jsonl")))[0]
    assert r["body"]["model"] == "gpt-5-mini" and r["body"]["seed"] == 1 and "max_tokens" not in r["body"] and r["body"]["messages"][0]["content"] == "Rate x"
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "n.jsonl").write_text(json.dumps(annotation("1", "m", [1.0], "f")) + "\n")
    with pytest.raises(Exception, match="no request"):
        cli.main(["submit_batch_requests", "--input", str(tmp_path / "plain"), "--output", str(tmp_path / "d"), "--model", "m"])


class Lossy(tokens.CharacterTokenizer):
    def decode(self, ids):
        return super().decode(ids).lower()

    def template(self, messages):
        return "".join(f"<{m['role']}>{m['content']}" for m in messages)


def test_prompts_are_cut_to_tokens(spark):
    d = spark.createDataFrame([(1, "ABCDEFGHIJ"), (2, "abc"), (3, None), (4, "")], "i int, text string")
    got = {r.i: r for r in tokens.truncated_prompts(d, "text", "R {{x}} {t}!", "t", Lossy(), 20, [{"role": "system", "content": "s"}]).collect()}
    assert got[1].prompt is not None and list(got[1].tags) == ["truncated", "detokenization_mismatch"] or list(got[1].tags) == ["truncated"]
    assert got[2].tags == [] or list(got[2].tags) == ["truncated"]
    assert got[3].prompt is None and got[4].prompt == "<system>s<user>R {x} !"
    wide = {r.i: r for r in tokens.truncated_prompts(d, "text", "R {t}", "t", Lossy(), 8 + 4, []).collect()}
    assert wide[1].prompt == "<user>R abcd" and list(wide[1].tags) == ["truncated", "detokenization_mismatch"] and "8 differing" in wide[1].errors[0]
    assert wide[2].prompt == "<user>R abc" and wide[2].tags == []
    t = {r.i: r for r in tokens.tokenised(d, ["i"], "text", tokens.CharacterTokenizer(), 4, F.array(F.lit(1.0))).collect()}
    assert list(t[2].input_ids) == [97, 98, 99, 0] and list(t[2].attention_mask) == [1, 1, 1, 0] and list(t[1].input_ids) == [65, 66, 67, 68] and list(t[3].input_ids) == [0] * 4
    with pytest.raises(Exception, match="more than 4 tokens"):
        tokens.tokenised(d, ["i"], "text", tokens.CharacterTokenizer(), 4, truncation=False).collect()
    w = tokens.WordTokenizer()
    assert w.decode(w.encode("a  b\nc ")) == "a  b\nc "


def test_all_classifier_metrics(spark):
    r = random.Random(6)
    rows = [("a", float(r.randint(0, 3)), r.random() * 3) for _ in range(100)] + [("b", r.random(), r.random()) for _ in range(20)]
    got = {(x.task, x.metric): x.value for x in classifier.metrics(spark.createDataFrame(rows, "task string, truth double, pred double"), {"a": 4, "b": 2}).collect()}
    t, p = [x[1] for x in rows[:100]], [float(round(x[2])) for x in rows[:100]]
    f1 = lambda c: 2 * sum(a == c and b == c for a, b in zip(t, p)) / max(1, sum(a == c for a in t) + sum(b == c for b in p))
    classes = sorted(set(t) | set(p))
    assert got["a", "classification/accuracy"] == pytest.approx(sum(a == b for a, b in zip(t, p)) / 100)
    assert got["a", "classification/f1_macro"] == pytest.approx(sum(map(f1, classes)) / len(classes))
    assert got["a", "classification/f1_weighted"] == pytest.approx(sum(f1(c) * t.count(c) for c in classes) / 100)
    assert got["a", "class_f1/f1_class_2"] == pytest.approx(f1(2.0))
    tb, pb = [float(x >= 2) for x in t], [float(x >= 2) for x in p]
    fb = lambda c: 2 * sum(a == c and b == c for a, b in zip(tb, pb)) / (tb.count(c) + pb.count(c))
    assert got["a", "binary/t2/f1_macro"] == pytest.approx((fb(0.0) + fb(1.0)) / 2) and ("a", "binary/t4/accuracy") not in got
    assert ("b", "classification/accuracy") not in got and ("b", "binary/t1/accuracy") in got and ("b", "spearman_corr") in got


def test_head_with_evaluation_and_axes(spark):
    h = head.Head.fresh(4, 8, 1, scale=10)
    assert abs(h.w2).max() > 1 / 8**0.5 and h.b2[0] == 2.5
    r = random.Random(3)
    e = [[r.uniform(-1, 1) for _ in range(4)] for _ in range(240)]
    df = spark.createDataFrame([(i, x, [2.5 + x[0]]) for i, x in enumerate(e)], "i int, x array<float>, y array<double>")
    got, losses = head.train(df.filter("i < 200"), "x", "y", h, epochs=8, rate=0.05, steps=3, evaluation={"val": df.filter("i >= 200")})
    assert losses[-1] < losses[0] and head.error(df.filter("i >= 200"), "x", "y", got) < head.error(df.filter("i >= 200"), "x", "y", h)
    with pytest.raises(ValueError):
        head.train(df, "x", "y", h, epochs=1, evaluation={"val": df}, metric="eval_test_loss")
    c, share = project.principal_components(df, "i", "x", 2)
    assert c.count() == 240 and 0 < share[1] <= share[0] < 1


def test_small_readers_and_gates(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.labelled_texts(spark, str(tmp_path / "no"))
    with pytest.raises(ValueError):
        files.labelled_texts(spark, str(tmp_path))
    (tmp_path / "t.jsonl").write_text('{"text": "a", "scores": {"score": 2}}\n')
    assert files.labelled_texts(spark, str(tmp_path)).first().scores.score == 2
    (tmp_path / "batch_results.jsonl").write_text('{"response": {"body": {"model": "m", "usage": {"prompt_tokens": 1, "completion_tokens": 2, "total_tokens": 3}}}}\n{bad\n{"response": null}\n')
    assert files.batch_results(spark, str(tmp_path)).first().cached_tokens == 0
    assert tuple(files.batch_losses(spark, str(tmp_path)).first())[1:] == (1, 1)
    (tmp_path / "d.jsonl").write_text('{"id": "1", "text": "a", "metadata": {"language": ""}}\n')
    with pytest.raises(Exception, match="no metadata.language"):
        files.documents(spark, str(tmp_path / "d.jsonl"), strict=True).collect()
    cm = spark.createDataFrame([("m", "de", "f1", 1), ("m", "de", "f2", 1)], "annotator string, lang string, file string, n int")
    with pytest.raises(Exception, match="several confusion"):
        report.one_confusion(cm).collect()
    with pytest.raises(ValueError):
        report.longest_prefix(cm, "lang", spark.createDataFrame([("a" * i,) for i in range(1, 5)], "k string"), "k", 3)
    x = annotate.translate(spark.createDataFrame([("a <keep>b c</keep> d",)], "t string"), "t", "en", ["de"], lambda ts, s, c: [f"[{t}]" for t in ts], ["en", "de"], ignore="keep")
    assert x.first().translated == "[a ]b c[ d]"
    n = corpus.numbered(spark.createDataFrame([("f", i * 50_000) for i in range(9)] + [("g", 3)], "file string, line_no bigint"), "file", "line_no", "at")
    assert sorted((r.file, r.line_no, r["at"]) for r in n.collect()) == [("f", i * 50_000, i) for i in range(9)] + [("g", 3, 0)]


def test_streamed_counts_drop_late_rows(spark, tmp_path):
    src, cp = tmp_path / "s", tmp_path / "c"
    src.mkdir()
    put = lambda n, rows: (src / f"{n}.json").write_text("".join(json.dumps({"t": t, "k": k}) + "\n" for t, k in rows))
    put("a", [("2024-01-01T00:10:00", "x"), ("2024-01-01T00:20:00", "x"), ("2024-01-01T05:00:00", "y")])
    q = incremental.vote_rates(spark, str(src), "t timestamp, k string", "t", "k")

    def run():
        got = []
        q.writeStream.outputMode("append").option("checkpointLocation", str(cp)).foreachBatch(lambda b, n: got.extend(b.collect())).trigger(availableNow=True).start().awaitTermination(60)
        return sorted((str(r.window.start)[11:16], r.k, r.n) for r in got)

    first = run()
    put("b", [("2024-01-01T00:30:00", "x"), ("2024-01-01T09:00:00", "z")])
    assert first == [("00:00", "x", 2)] and run() == [("05:00", "y", 1)]  # the row of 00:30 came after the watermark
