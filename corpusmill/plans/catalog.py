"""Named queries over the project's tables, and the same in SQL for the comparison with another engine.

Double results are rounded to six digits on both sides; the SQL is written from the definitions, not from the plans.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill import schemas
from corpusmill.functions import text as tx
from corpusmill.functions import votes as vt
from corpusmill.operators import agreement, annotate, classifier, corpus, head, project, report, tokens, votes
from corpusmill.session import scratch
from corpusmill.sources import files, sinks

TRUTH = "human-panel__round-2"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def deco(fn):
        QUERIES[fn.__name__] = lambda s, d: r6(fn(s, d))
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return deco


def r6(df: DataFrame) -> DataFrame:
    return df.select(*[(F.round(c, 6) + F.lit(0.0)).alias(c) if k == "double" else F.col(c) for c, k in df.dtypes])


def t(s: SparkSession, d: str, name: str) -> DataFrame:
    return s.read.parquet(f"{d}/{name}.parquet")


def scores(s: SparkSession, d: str, strategy: str = "majority") -> DataFrame:
    f = votes.score_frame(t(s, d, "annotations"), strategy)
    return f.withColumn("lang", tx.path_part(F.col("raw_data_file_path"), "lang"))


def pair_rows(s: SparkSession, d: str) -> DataFrame:
    return agreement.pairs(scores(s, d), ("doc_id", "prompt", "lang"))


def truth_rows(s: SparkSession, d: str) -> DataFrame:
    return agreement.against(pair_rows(s, d), TRUTH)


# ------------------------------------------------------------------------------------------------ SQL building blocks


def R(x: str, name: str) -> str:
    return f"round({x}, 6) + 0.0::double as {name}"


V = "list_filter(scores, lambda x: x in (0, 1, 2, 3, 4, 5))"
CNT = "len(list_filter(v, lambda y: y = {}))"
MAJ = "list_avg(list_filter(list_distinct(v), lambda m: len(list_filter(v, lambda y: y = m)) = list_max(list_transform(v, lambda z: len(list_filter(v, lambda w: w = z))))))"
AGG = {"min": "list_min(v)", "max": "list_max(v)", "mean": "list_avg(v)", "majority": MAJ}
MODEL = "regexp_replace(meta_information.model, '/|--', '__', 'g')"
ANN = f"select document_id as doc_id, {MODEL} as annotator, meta_information.prompt_name as prompt, meta_information.raw_data_file_path as path, regexp_extract(meta_information.raw_data_file_path, '([^/]+)/[^/]+$', 1) as lang, scores, {V} as v from annotations"


def S(strategy: str = "majority") -> str:
    return f"s as (select doc_id, annotator, prompt, path, lang, {AGG[strategy]} as score from ({ANN}))"


P = f"{S()}, p as (select a.doc_id, a.prompt, a.lang, a.annotator as annotator_0, b.annotator as annotator_1, a.score as score_0, b.score as score_1 from s a join s b on a.doc_id = b.doc_id and a.prompt = b.prompt and a.lang = b.lang where a.annotator < b.annotator)"
VP = P + ", q as (select *, floor(score_0 + 0.5) as r0, floor(score_1 + 0.5) as r1 from p where score_0 is not null and score_1 is not null)"
CT = VP + ", ct as (select annotator_0, annotator_1, score_0 as x, score_1 as y, count(*)::double as n from q group by all)"
G = P + f", g as (select annotator_1 as annotator, lang, score_0 as truth, score_1 as pred from p where annotator_0 = '{TRUTH}' union all select annotator_0, lang, score_1, score_0 from p where annotator_1 = '{TRUTH}')"
LABELS = "l as (select unnest([0, 1, 2, 3, 4, 5])::bigint as label)"
GC = G + f", {LABELS}, c as (select annotator, label, count(*) filter (floor(truth + 0.5) = label and floor(pred + 0.5) = label) as tp, count(*) filter (floor(truth + 0.5) <> label and floor(pred + 0.5) = label) as fp, count(*) filter (floor(truth + 0.5) = label and floor(pred + 0.5) <> label) as fn from g, l where truth is not null and pred is not null group by all)"
CM = G + f", {LABELS}, pr as (select unnest([-1, 0, 1, 2, 3, 4, 5])::bigint as prediction), n as (select annotator, lang, floor(truth + 0.5)::bigint as label, coalesce(floor(pred + 0.5), -1)::bigint as prediction, count(*) as n from g where truth is not null group by all)"
PK = "annotator_0, annotator_1"
SPEAR = "select annotator_0, annotator_1, rank() over (partition by annotator_0, annotator_1 order by score_0) + (count(*) over (partition by annotator_0, annotator_1, score_0) - 1) / 2.0 as a, rank() over (partition by annotator_0, annotator_1 order by score_1) + (count(*) over (partition by annotator_0, annotator_1, score_1) - 1) / 2.0 as b from q"
TAU = """num as (select c.annotator_0, c.annotator_1, sum(c.n * e.n * sign(c.x - e.x) * sign(c.y - e.y)) / 2 as num from ct c join ct e using (annotator_0, annotator_1) group by 1, 2),
n0 as (select annotator_0, annotator_1, sum(n) * (sum(n) - 1) / 2 as n0 from ct group by 1, 2),
t0 as (select annotator_0, annotator_1, sum(m * (m - 1) / 2) as t0 from (select annotator_0, annotator_1, x, sum(n) as m from ct group by 1, 2, 3) group by 1, 2),
t1 as (select annotator_0, annotator_1, sum(m * (m - 1) / 2) as t1 from (select annotator_0, annotator_1, y, sum(n) as m from ct group by 1, 2, 3) group by 1, 2),
tau as (select annotator_0, annotator_1, case when (n0 - t0) * (n0 - t1) > 0 then num / sqrt((n0 - t0) * (n0 - t1)) end as kendall from num join n0 using (annotator_0, annotator_1) join t0 using (annotator_0, annotator_1) join t1 using (annotator_0, annotator_1))"""
COHEN = """tot as (select annotator_0, annotator_1, count(*)::double as t, count(*) filter (r0 = r1) as o from q group by 1, 2),
e0 as (select annotator_0, annotator_1, r0 as r, count(*) as m from q group by 1, 2, 3), e1 as (select annotator_0, annotator_1, r1 as r, count(*) as m from q group by 1, 2, 3),
pe as (select annotator_0, annotator_1, sum(e0.m * e1.m) as e from e0 join e1 using (annotator_0, annotator_1, r) group by 1, 2),
coh as (select annotator_0, annotator_1, case when coalesce(e, 0) <> t * t then (o / t - coalesce(e, 0) / (t * t)) / (1 - coalesce(e, 0) / (t * t)) end as cohen from tot left join pe using (annotator_0, annotator_1))"""

# ------------------------------------------------------------------------------------------------------------ agreement


@query(
    f"with {CT}, {TAU}, {COHEN}, sp as (select {PK}, corr(a, b) as spearman from ({SPEAR}) group by 1, 2) select p.annotator_0, p.annotator_1, count(*) as n_common, count(*) filter (score_0 is not null and score_1 is not null) as n_valid, "
    f"count(*) filter (score_0 is null or score_1 is null) as invalid, {R('avg(abs(score_0 - score_1))', 'mae')}, {R('avg((score_0 - score_1) * (score_0 - score_1))', 'mse')}, "
    f"{R('avg((floor(score_0 + 0.5) = floor(score_1 + 0.5))::int)', 'acc')}, {R('avg(((score_0 >= 3) = (score_1 >= 3))::int)', 'ta_3')}, "
    f"{R('any_value(spearman)', 'spearman')}, {R('any_value(kendall)', 'kendall')}, {R('any_value(cohen)', 'cohen')} from p left join sp using ({PK}) left join tau using ({PK}) left join coh using ({PK}) group by 1, 2"
)
def agreement_flagship(s, d):
    return agreement.metrics(pair_rows(s, d))


def _vote(strategy: str):
    def fn(s, d):
        return scores(s, d, strategy).select("doc_id", "annotator", "prompt", "score")

    fn.__name__ = f"vote_{strategy}"
    return query(f"with {S(strategy)} select doc_id, annotator, prompt, {R('score', 'score')} from s")(fn)


vote_min, vote_max, vote_mean, vote_majority = (_vote(x) for x in vt.STRATEGIES)


@query(f"select doc_id, annotator, v[list_indexof(list_transform(v, lambda x: len(list_filter(v, lambda y: y = x))), list_max(list_transform(v, lambda z: len(list_filter(v, lambda w: w = z)))))] as score from ({ANN})")
def vote_most_common(s, d):
    a = t(s, d, "annotations")
    return a.select(F.col("document_id").alias("doc_id"), tx.annotator_name(F.col("meta_information.model")).alias("annotator"), vt.most_common(vt.valid_votes(F.col("scores"))).alias("score"))


@query(f"with r as (select list_max(v) - list_min(v) as variation from ({ANN}) where len(v) > 0) select variation, count(*) as n, (select {R('avg(variation)', 'x')} from r) as mean, (select {R('stddev_samp(variation)', 'x')} from r) as stddev from r group by 1")
def vote_variation(s, d):
    return votes.variation(t(s, d, "annotations"))


@query(f"select doc_id, annotator, (unnest(generate_series(1, len(scores))) - 1)::int as k, unnest(list_transform(scores, lambda x: case when x in (0, 1, 2, 3, 4, 5) then x end)) as score from ({ANN})")
def vote_rows(s, d):
    return votes.vote_rows(t(s, d, "annotations")).select("doc_id", "annotator", "k", "score")


SINGLE = f"{S()}, u as (select doc_id, prompt, annotator, max(score) as score from s group by 1, 2, 3)"


def single(s, d):
    return scores(s, d).groupBy("doc_id", "prompt", "annotator").agg(F.max("score").alias("score"))


@query(
    f"with {SINGLE}, z as (select a.annotator as annotator_0, b.annotator as annotator_1, floor(a.score + 0.5) as x, floor(b.score + 0.5) as y from u a join u b using (doc_id, prompt) where a.annotator < b.annotator and a.score is not null and b.score is not null), "
    f"o as (select {PK}, avg((x = y)::int) as p, count(*)::double * 2 as t from z group by 1, 2), m as (select {PK}, r, count(*) as m from (select {PK}, x as r from z union all select {PK}, y from z) group by 1, 2, 3), "
    f"e as (select {PK}, any_value(p) as p, sum((m / t) * (m / t)) as e from m join o using ({PK}) group by 1, 2) select {PK}, {R('case when e <> 1 then (p - e) / (1 - e) end', 'fleiss')} from e"
)
def fleiss_kappa(s, d):
    p = agreement.pairs(single(s, d)).filter("score_0 is not null and score_1 is not null")
    z = p.select(*agreement.PAIR, "doc_id", "prompt", F.explode(F.array("score_0", "score_1")).alias("score"))
    return agreement.fleiss(z, agreement.PAIR, ("doc_id", "prompt"))


@query(f"with {VP} select {PK}, {R('corr(a, b)', 'spearman')} from ({SPEAR}) group by 1, 2")
def spearman_rank(s, d):
    return agreement.spearman(agreement.contingency(pair_rows(s, d)))


@query(f"with {CT}, {TAU} select {PK}, {R('kendall', 'kendall')} from tau")
def kendall_tau_b(s, d):
    return agreement.kendall(agreement.contingency(pair_rows(s, d)))


@query(f"with {VP}, {COHEN} select {PK}, {R('cohen', 'cohen')} from coh")
def cohen_kappa(s, d):
    return agreement.cohen(agreement.rounded(agreement.contingency(pair_rows(s, d))))


@query(
    f"with {SINGLE}, u2 as (select * from u where score is not null), mm as (select prompt, doc_id, count(*) as m from u2 group by 1, 2 having count(*) > 1), "
    "co as (select a.prompt, a.score as x, b.score as y, sum(1.0::double / (m - 1)) as o from u2 a join u2 b on a.prompt = b.prompt and a.doc_id = b.doc_id and a.annotator <> b.annotator join mm on mm.prompt = a.prompt and mm.doc_id = a.doc_id group by 1, 2, 3), "
    "nx as (select prompt, x, sum(o) as n, sum(sum(o)) over (partition by prompt order by x) as cum, sum(sum(o)) over (partition by prompt) as t from co group by 1, 2), "
    "dd as (select a.prompt, a.t, a.n * b.n as nn, coalesce(co.o, 0) as o, case when a.x = b.x then 0 else greatest(a.cum, b.cum) - least(a.cum - a.n, b.cum - b.n) - (a.n + b.n) / 2 end as dist from nx a join nx b on a.prompt = b.prompt left join co on co.prompt = a.prompt and co.x = a.x and co.y = b.x) "
    f"select prompt, {R('1 - (any_value(t) - 1) * sum(o * dist * dist) / sum(nn * dist * dist)', 'krippendorff')} from dd group by 1"
)
def krippendorff_alpha(s, d):
    return agreement.krippendorff(single(s, d), ["prompt"])


@query(f"with {P} select {PK}, count(*) as n_common, count(*) filter (score_0 is null or score_1 is null) as invalid from p group by 1, 2")
def invalid_count(s, d):
    return agreement.summary(agreement.counted(pair_rows(s, d))).select(*agreement.PAIR, "n_common", "invalid")


@query(f"with {VP} select {PK}, " + ", ".join(R(f"avg(((score_0 >= {x}) = (score_1 >= {x}))::int)", f"ta_{x}") for x in (1, 2, 3, 4)) + " from q group by 1, 2")
def threshold_agreement(s, d):
    f = agreement.summary(agreement.contingency(pair_rows(s, d)), (1.0, 2.0, 3.0, 4.0))
    return f.select(*agreement.PAIR, "ta_1", "ta_2", "ta_3", "ta_4")


@query(f"with {G} select annotator, count(*) as n, {R('avg((floor(truth + 0.5) = floor(pred + 0.5))::int)', 'acc')}, {R('avg(abs(truth - pred))', 'mae')}, {R('avg((truth - pred) * (truth - pred))', 'mse')} from g where truth is not null and pred is not null group by 1")
def gt_error_metrics(s, d):
    return agreement.truth_metrics(truth_rows(s, d))


@query(f"with {GC} select annotator, label, {R('case when tp + fn > 0 then tp / (tp + fn)::double else 0 end', 'class_accuracy')} from c")
def class_accuracy(s, d):
    return agreement.class_accuracy(agreement.class_counts(truth_rows(s, d)))


@query(
    f"with {GC}, f as (select *, case when 2 * tp + fp + fn > 0 then 2 * tp / (2 * tp + fp + fn)::double else 0 end as f1 from c) select annotator, label, {R('f1', 'f1')}, "
    f"{R('avg(f1) filter (tp + fp + fn > 0) over (partition by annotator)', 'macro_f1')}, {R('2 * sum(tp) over (partition by annotator) / (sum(2 * tp + fp + fn) over (partition by annotator))::double', 'micro_f1')} from f"
)
def f1_scores(s, d):
    return agreement.f1_scores(agreement.class_counts(truth_rows(s, d)))


CMA = "cm as (select k.annotator, l.label, pr.prediction, coalesce(sum(n.n), 0)::bigint as n from (select distinct annotator from g) k cross join l cross join pr left join n using (annotator, label, prediction) group by all)"


@query(f"with {CM}, {CMA} select * from cm")
def confusion_matrix(s, d):
    return agreement.confusion(truth_rows(s, d))


@query(f"with {CM}, {CMA} select annotator, label, prediction, {R('case when sum(n) over (partition by annotator, label) > 0 then n / (sum(n) over (partition by annotator, label))::double else 0 end', 'share')} from cm")
def confusion_normalised(s, d):
    return agreement.normalised(agreement.confusion(truth_rows(s, d)))


@query(
    f"with {S('mean')}, v as (select prompt, annotator, score as x, min(score) over (partition by prompt, annotator) as lo, max(score) over (partition by prompt, annotator) as hi from s where score is not null) "
    "select prompt, annotator, case when hi = lo then 1 else least(floor((x - lo) / (hi - lo) * 30) + 1, 30) end::bigint as bin, count(*) as n from v group by all"
)
def score_histogram(s, d):
    return agreement.histogram(scores(s, d, "mean"), "score", ["prompt", "annotator"])


@query(f"with {VP}, e as (select {PK}, score_1 - score_0 as d from q) select {PK}, count(*) as n, {R('avg(d)', 'mean')}, {R('quantile_cont(d, 0.25)', 'q1')}, {R('median(d)', 'median')}, {R('quantile_cont(d, 0.75)', 'q3')} from e group by 1, 2")
def score_difference_quartiles(s, d):
    return agreement.difference_quartiles(pair_rows(s, d))


@query(f"with {G} select annotator, least(case when truth < 0.5 then 0 else floor(truth + 0.5) end, 5)::bigint as bin, count(*) as n from g where truth between 0 and 5.5 and pred is null group by all")
def invalid_truth_histogram(s, d):
    return agreement.invalid_truth_histogram(truth_rows(s, d))


def lang_metrics(s, d):
    g = truth_rows(s, d)
    ok = F.col("truth").isNotNull() & F.col("pred").isNotNull()
    e = F.col("truth") - F.col("pred")
    return g.groupBy("lang", "annotator").agg(F.avg(F.when(ok, (tx.round_half_up(F.col("truth")) == tx.round_half_up(F.col("pred"))).cast("double"))).alias("acc"), F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"), F.count_if(~ok).alias("invalid"))


LM = G + ", lm as (select lang, annotator, avg((floor(truth + 0.5) = floor(pred + 0.5))::int) as acc, avg(abs(truth - pred)) as mae, avg((truth - pred) * (truth - pred)) as mse, count(*) filter (truth is null or pred is null) as invalid from g group by 1, 2)"


@query(f"with {LM} select annotator, " + ", ".join(R(f"sum(coalesce({m}, 0)) / count(*)", m) for m in ("acc", "mae", "mse")) + ", sum(invalid)::bigint as invalid from lm group by 1")
def cross_language_metrics(s, d):
    return report.cross_language(lang_metrics(s, d), ["acc", "mae", "mse", "invalid"])


@query(f"with {CM} select annotator, label, prediction, sum(n)::bigint as n from n group by all")
def cross_language_cm(s, d):
    return report.cross_language_confusion(agreement.confusion(truth_rows(s, d), ("annotator", "lang"))).filter("n > 0")


@query(
    f"with {LM}, long as (unpivot (select lang, annotator, acc::double as acc, mae::double as mae, mse::double as mse, invalid::double as invalid from lm) on acc, mae, mse, invalid into name metric value value), "
    "r as (select *, rank() over (partition by lang, metric order by case when metric in ('mae', 'mse', 'invalid') then value else -value end) as r from long) "
    "select metric, annotator, k as top_n, count(*) filter (r <= k) as n from r, (select unnest([1, 2, 3, 4])::int as k) group by 1, 2, 3"
)
def top_n_annotators(s, d):
    return report.top_n(report.long_metrics(lang_metrics(s, d), ["lang", "annotator"], ["acc", "mae", "mse", "invalid"]), 4)


@query(f"with {LM}, w as (select annotator, avg(acc) as acc, avg(mae) as mae, sum(invalid) as invalid from lm group by 1) select annotator, acc = max(acc) over () as acc_best, mae = min(mae) over () as mae_best, invalid = min(invalid) over () as invalid_best from w")
def best_flags(s, d):
    w = lang_metrics(s, d).groupBy("annotator").agg(F.avg("acc").alias("acc"), F.avg("mae").alias("mae"), F.sum("invalid").alias("invalid"))
    return report.best_flags(w.cache(), ["acc", "mae", "invalid"])


NINE = ("brenno__brenno-14b-it", "kelvar__kelvar-9b-chat", "mirvel__mirvel-27b-it", "orvane__orva-70b-chat", "ossian__oss-mini", "quorlen__q-edu-7b", "sandor-lab__sl-3b", "talisk__talisk-8b", "velmora__velm-32b-instruct")


@query(f"with {LM} select lang, " + ", ".join(f"round(max(mae) filter (annotator = '{a}'), 6) + 0.0::double as \"{a}\"" for a in NINE) + " from lm group by 1")
def metric_pivot(s, d):
    return report.pivot_metric(lang_metrics(s, d), "lang", "annotator", "mae")


DIFF = "d as (select annotator_0, annotator_1, score_1 - score_0 as x, min(score_1 - score_0) over (partition by annotator_0, annotator_1) as lo, max(score_1 - score_0) over (partition by annotator_0, annotator_1) as hi from q)"


@query(f"with {VP}, {DIFF} select {PK}, case when hi = lo then 1 else least(floor((x - lo) / (hi - lo) * 30) + 1, 30) end::bigint as bin, count(*) as n from d group by all")
def difference_histogram(s, d):
    return agreement.difference_histogram(pair_rows(s, d))


@query(
    f"with {VP}, o as (select {PK}, avg((r0 = r1)::int) as p, count(*)::double * 2 as t from q group by 1, 2), m as (select {PK}, r, count(*) as m from (select {PK}, r0 as r from q union all select {PK}, r1 from q) group by 1, 2, 3), "
    f"e as (select {PK}, any_value(p) as p, sum((m / t) * (m / t)) as e from m join o using ({PK}) group by 1, 2) select {PK}, {R('case when e <> 1 then (p - e) / (1 - e) end', 'fleiss')} from e"
)
def pair_fleiss(s, d):
    return agreement.pair_fleiss(agreement.rounded(agreement.contingency(pair_rows(s, d))))


@query(
    f"with {VP}, z as (select {PK}, score_0 as x, score_1 as y from q union all select {PK}, score_1, score_0 from q), co as (select {PK}, x, y, count(*)::double as o from z group by all), "
    f"nx as (select {PK}, x, sum(o) as n, sum(sum(o)) over (partition by {PK} order by x) as cum, sum(sum(o)) over (partition by {PK}) as t from co group by {PK}, x), "
    "dd as (select a.annotator_0, a.annotator_1, a.t, a.n * b.n as nn, coalesce(co.o, 0) as o, case when a.x = b.x then 0 else greatest(a.cum, b.cum) - least(a.cum - a.n, b.cum - b.n) - (a.n + b.n) / 2 end as dist "
    "from nx a join nx b using (annotator_0, annotator_1) left join co on co.annotator_0 = a.annotator_0 and co.annotator_1 = a.annotator_1 and co.x = a.x and co.y = b.x) "
    f"select {PK}, {R('1 - (any_value(t) - 1) * sum(o * dist * dist) / sum(nn * dist * dist)', 'krippendorff')} from dd group by 1, 2"
)
def pair_krippendorff(s, d):
    return agreement.pair_krippendorff(agreement.contingency(pair_rows(s, d)))


@query(f"with {VP} select {PK}, count(*) filter (score_0 = score_1) as same, count(*) filter (abs(score_0 - score_1) <= 1) as within_1, count(*) filter (abs(score_0 - score_1) > 1) as over_1, count(*) filter (abs(score_0 - score_1) > 2) as over_2, count(*) filter (score_0 > score_1) as larger_0, count(*) filter (score_1 > score_0) as larger_1, count(*) filter (score_0 >= 2 and score_1 >= 2) as both_2, count(*) filter (score_0 >= 2 or score_1 >= 2) as one_2, count(*) filter (score_0 >= 3 and score_1 >= 3) as both_3, count(*) filter (score_0 >= 3 or score_1 >= 3) as one_3, {R('avg(score_0)', 'mean_0')}, {R('avg(score_1)', 'mean_1')} from q group by 1, 2")
def score_comparison(s, d):
    return agreement.comparison(pair_rows(s, d))


@query("with e as (select unnest(document_processing_status) as s, unnest(generate_series(1, len(document_processing_status))) as k from annotations), p as (select k, avg((s = 'success')::int) as r from e group by 1) " f"select {R('coalesce(avg(r), 0)', 'match_rate')} from p")
def match_rate(s, d):
    return report.match_rate(t(s, d, "annotations"))


@query(f"select count(*) as n_docs, (max(epoch(ts)::bigint) - min(epoch(ts)::bigint))::double as elapsed_s, {R('count(*) / (max(epoch(ts)::bigint) - min(epoch(ts)::bigint))::double', 'docs_per_s')}, {R('avg(value)', 'mean_tokens_per_s')} from (select date_trunc('second', ts) as ts, value from events)")
def throughput_stats(s, d):
    e = t(s, d, "events").select(F.unix_timestamp("ts").alias("a"), "value")
    return report.throughput(e, "a", "a", "value")


@query(f"with {S()}, a as (select annotator, count(*) as n, avg(score) as mean from s group by 1) select annotator, n, {R('mean', 'mean')}, row_number() over (order by n desc, annotator)::int as rank from a")
def experiment_ranking(s, d):
    a = scores(s, d).groupBy("annotator").agg(F.count("*").alias("n"), F.avg("score").alias("mean"))
    return report.rank_experiments(a, [("n", False), ("annotator", True)], "mean")


@query(f"with {ANN.replace('select', 'x as (select', 1)}), k as (select unnest(['velmora', 'velmora/velm', 'talisk', 'human']) as rate_key, unnest([1.0, 2.0, 3.0, 4.0])::double as rate), m as (select distinct meta_information.model as model from annotations) select model, rate_key, rate from (select model, rate_key, rate, row_number() over (partition by model order by length(rate_key) desc nulls last) as r from m left join k on starts_with(model, rate_key)) where r = 1")
def longest_prefix_join(s, d):
    keys = s.createDataFrame([("velmora", 1.0), ("velmora/velm", 2.0), ("talisk", 3.0), ("human", 4.0)], "rate_key string, rate double")
    m = t(s, d, "annotations").select(F.col("meta_information.model").alias("model")).distinct()
    return report.longest_prefix(m, "model", keys, "rate_key").select("model", "rate_key", "rate")


@query(f"select source, sum(n_chars // 4)::bigint as prompt_tokens, count(distinct lang) as models from documents group by 1")
def usage_by_source(s, d):
    u = t(s, d, "documents").select("source", "lang", F.expr("n_chars div 4").alias("prompt_tokens"))
    f = report.usage_by_folder(u.withColumnRenamed("source", "folder"), "folder", "lang", ["prompt_tokens"])
    return f.select(F.col("folder").alias("source"), "prompt_tokens", F.when(F.col("models") == "", 0).otherwise(F.size(F.split("models", ", "))).cast("bigint").alias("models"))


@query(f"with f as (select source, sum(n_chars)::bigint as n from documents group by 1) select sum(n)::bigint as n_total, {R('avg(n)', 'n_mean')}, {R('avg(n) * 37', 'n_extrapolated')} from f")
def totals_extrapolated(s, d):
    f = t(s, d, "documents").groupBy("source").agg(F.sum("n_chars").alias("n"))
    return report.grand_totals(f, ["n"], len(schemas.LANGUAGES))


# --------------------------------------------------------------------------------------------------------------- corpus

# white space as Python splits it: DuckDB's \s is ASCII only
PYWS = "[\\s\\x0b\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+"
NW = f"len(list_filter(regexp_split_to_array(text, '{PYWS}'), lambda x: x <> ''))"


@query(f"select {NW}::bigint as n_words, count(*) as n_docs from documents where text is not null group by 1")
def word_stats_histogram(s, d):
    return corpus.word_histogram(t(s, d, "documents"), "text")


@query(f"select count(text) as n_docs, coalesce(sum({NW}), 0)::bigint as n_words, coalesce(sum(length(text)), 0)::bigint as n_chars from documents")
def word_stats_totals(s, d):
    return corpus.word_totals(t(s, d, "documents"), "text")


@query(f"select source, count(text) as n_docs, coalesce(sum({NW}), 0)::bigint as n_words, coalesce(sum(length(text)), 0)::bigint as n_chars from documents group by 1")
def words_per_source(s, d):
    return corpus.word_totals(t(s, d, "documents"), "text", ["source"])


@query("with a as (select *, row_number() over (partition by lang order by doc_id) as r from documents), b as (select *, sha256(coalesce(text, '')) as h from a where r = 1), c as (select *, row_number() over (partition by h order by doc_id) as k from b) select doc_id, text from c where k = 1")
def dedup_by_language_key(s, d):
    return corpus.dedup(t(s, d, "documents").select("doc_id", "lang", "text"), "lang", "text", ["doc_id"]).select("doc_id", "text")


@query("with b as (select doc_id, row_number() over (partition by sha256(coalesce(text, '')) order by doc_id) as k from documents) select doc_id from b where k = 1")
def dedup_exact(s, d):
    return corpus.dedup(t(s, d, "documents").select("doc_id", "text"), "doc_id", "text", ["doc_id"]).select("doc_id")


@query("with b as (select source, doc_id, row_number() over (partition by source, sha256(coalesce(text, '')) order by doc_id) as k from documents) select source, doc_id from b where k = 1")
def dedup_per_source(s, d):
    return corpus.dedup(t(s, d, "documents").select("doc_id", "source", "text"), "doc_id", "text", ["doc_id"], ["source"]).select("source", "doc_id")


@query("select id, side from (select id, 'a' as side from labelled_texts where split = 'train' union all select id, 'b' from labelled_texts where split <> 'train')")
def merge_sort(s, d):
    x = t(s, d, "labelled_texts")
    a, b = x.filter("split = 'train'").select("id", F.lit("a").alias("side")), x.filter("split <> 'train'").select("id", F.lit("b").alias("side"))
    return corpus.merge_sorted([a, b], "id", ["side"])


@query("select doc_id, (row_number() over (order by doc_id) - 1)::bigint as line, ((row_number() over (order by doc_id) - 1) // 64)::bigint as chunk from documents")
def chunk_lines(s, d):
    return corpus.chunked(t(s, d, "documents").select("doc_id"), ["doc_id"], 64).select("doc_id", "line", "chunk")


@query("select source, doc_id from (select source, doc_id, row_number() over (partition by source order by doc_id) as r from documents) where r <= 3")
def limit_per_source(s, d):
    return corpus.limit_per(t(s, d, "documents").select("source", "doc_id"), ["source"], ["doc_id"], 3)


@query("select lang, doc_id from (select lang, doc_id, row_number() over (partition by lang order by md5('42:' || doc_id), doc_id) as r from documents) where r <= case lang when 'en' then 50 when 'de' then 30 when 'fr' then 100000 else 0 end")
def stratified_sample(s, d):
    return corpus.stratified_sample(t(s, d, "documents").select("lang", "doc_id"), "lang", {"en": 50, "de": 30, "fr": 100_000}, "doc_id")


@query("with o as (select doc_id, row_number() over (order by md5('42:' || doc_id), doc_id) - 1 as r, count(*) over () as n from documents) select doc_id, case when r < floor(n * 0.8) then 'train' when r < floor(n * 0.8) + floor(n * 0.1) then 'val' else 'test' end as split from o")
def exact_split(s, d):
    return corpus.exact_split(t(s, d, "documents").select("doc_id"), "doc_id")


@query(f"select doc_id, regexp_replace(translate(text, chr(10) || chr(13), '  '), '{PYWS}', ' ', 'g') as clean from documents")
def clean_text(s, d):
    return t(s, d, "documents").select("doc_id", tx.clean_text(F.col("text")).alias("clean"))


@query("with e as (select document_id, unnest(explanations) as x, unnest(generate_series(1, len(explanations))) - 1 as k from annotations) select document_id, k::int as k, try_cast(regexp_extract(replace(x, 'Score:', 'Educational score:'), '.*Educational score:\\s*(\\d+(?:\\.\\d+)?)', 1) as double) as score from e")
def extract_score(s, d):
    e = t(s, d, "annotations").select("document_id", F.posexplode("explanations").alias("k", "x"))
    return e.select("document_id", "k", tx.extract_score(F.replace("x", F.lit("Score:"), F.lit("Educational score:")), "educational_score").alias("score"))


NOISE = "('0x' || substr(md5('42:' || id), 1, 8))::bigint / 4294967296.0::double"


@query(f"select id, floor(scores.score + 0.5)::double as score, least(scores.score + 1, 5)::double as shift_up_capped, {R(f'greatest(0, least(5, scores.score + {NOISE} - 0.5::double))', 'add_noise_clamped')}, (scores.score >= 3)::int::double as binary_threshold from labelled_texts where scores.score is not null")
def score_transforms(s, d):
    return corpus.transformed(t(s, d, "labelled_texts"), F.col("scores.score"), "id", ["score", "shift_up_capped", "add_noise_clamped", "binary_threshold"])


@query(f"with {S('mean')} select score, floor(score + 0.5)::bigint as half_up, round_even(score, 0) + 0.0::double as half_even, count(*) as n from (select round(score, 6) + 0.0::double as score from s where score is not null) group by all")
def rounding(s, d):
    x = scores(s, d, "mean").filter("score is not null").select(F.round("score", 6).alias("score"))
    return x.groupBy("score", tx.round_half_up(F.col("score")).alias("half_up"), tx.round_half_even(F.col("score")).alias("half_even")).agg(F.count("*").alias("n"))


@query("select doc_id, 'Judge {this}: ' || text || ' End.' as prompt, len([x for x in ['system', 'user']])::int as n_messages from documents")
def prompt_build(s, d):
    x = t(s, d, "documents").select("doc_id", tx.fill_prompt("Judge {{this}}: {text} End.", "text", F.col("text")).alias("prompt"))
    return x.withColumn("n_messages", F.size(tx.messages([{"role": "system", "content": "You judge texts."}], F.col("prompt"))))


@query("select doc_id, c as target_code from documents, (select unnest(['de', 'fr', 'it']) as c)")
def language_fanout(s, d):
    return annotate.fan_out(t(s, d, "documents").select("doc_id"), {c: schemas.LANGUAGES[c] for c in ("de", "fr", "it")}).select("doc_id", "target_code")


@query("select file_path, md5 from raw_files where file_path not in (select meta_information.raw_data_file_path from annotations where meta_information.raw_data_file_path is not null)")
def anti_join_processed(s, d):
    done = t(s, d, "annotations").select(F.col("meta_information.raw_data_file_path").alias("file_path"))
    return corpus.unprocessed(t(s, d, "raw_files").select("file_path", "md5"), done, "file_path")


@query("with a as (select distinct document_id as i from random_documents), b as (select distinct document_id as i from annotations) select side, count(*) as n from (select case when a.i is null then 'second' when b.i is null then 'first' else 'both' end as side from a full join b on a.i = b.i) group by 1")
def id_set_ops(s, d):
    return corpus.id_sets(t(s, d, "random_documents"), t(s, d, "annotations"), "document_id")


@query(
    f"with {S()}, l as (select doc_id, path, annotator, max(score) as score from s group by 1, 2, 3), k as (select distinct annotator from s), "
    "r as (select distinct document_id as doc_id, metadata.file_path as file_path, annotator from random_documents cross join k), j as (select r.*, l.score, l.doc_id is not null as matched from r left join l on l.doc_id = r.doc_id and l.path = r.file_path and l.annotator = r.annotator) "
    f"select file_path, doc_id, annotator, {R('score', 'score')}, matched, count(*) filter (not matched) over (partition by file_path, annotator) = 0 as complete from j"
)
def docs_with_score_gate(s, d):
    sc = scores(s, d)
    last = votes.last_scores(sc.withColumn("o", F.coalesce("score", F.lit(-1.0))), "o", by=["annotator"])
    who = F.broadcast(sc.select("annotator").distinct())  # ten rows
    raw = t(s, d, "random_documents").select(F.col("document_id").alias("doc_id"), F.col("metadata.file_path").alias("file_path")).distinct().join(who)
    return votes.join_scores(raw, last, ["annotator"]).select("file_path", "doc_id", "annotator", "score", "matched", "complete")


@query(f"with {S()} select doc_id, annotator, 'moved/' || replace(path, '/', '_') as raw_data_file_path, {R('score', 'score')} from s where replace(path, '/', '_') in (select replace(file_path, '/', '_') from raw_files)")
def scores_retargeted(s, d):
    flat = lambda c, folder: F.concat(F.lit(folder), F.replace(c, F.lit("/"), F.lit("_")))
    there = t(s, d, "raw_files").select(flat(F.col("file_path"), "moved/").alias("file_path"))
    old = scores(s, d).withColumn("raw_data_file_path", flat(F.col("raw_data_file_path"), "old/place/"))
    return votes.retargeted(old, there).select("doc_id", "annotator", "raw_data_file_path", "score")


@query("select doc_id from documents where length(text) > 0 and length(doc_id::varchar) > 0 and length(lang) > 0")
def valid_documents(s, d):
    return annotate.valid_documents(t(s, d, "documents"), "doc_id", "text", "lang")[0].select("doc_id")


@query("select event_id, (props::json ->> '$.k') as k from events")
def json_field(s, d):
    return t(s, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("select distinct regexp_replace(meta_information.model, '/|--', '__', 'g') as annotator, meta_information.prompt_name as prompt from annotations")
def distinct_annotators(s, d):
    return scores(s, d).select("annotator", "prompt").distinct()


@query("select doc_id, md5(coalesce(text, '')) as md5, sha256(coalesce(text, '')) as sha256 from documents")
def text_digests(s, d):
    return corpus.digests(t(s, d, "documents"), "doc_id", "text")


@query("select file_path, regexp_extract(file_path, '([^/]+)/([^/]+)/[^/]+$', 1) as dump, regexp_extract(file_path, '([^/]+)/([^/]+)/[^/]+$', 2) as lang from raw_files")
def path_parts(s, d):
    f = t(s, d, "raw_files")
    return f.select("file_path", tx.path_part(F.col("file_path"), "dump").alias("dump"), tx.path_part(F.col("file_path"), "lang").alias("lang"))


# ----------------------------------------------------------------------------------------------------------- classifiers

PRED = "select 'a' as task, l.scores.score::double as truth, ((l.scores.score + length(l.text) % 3) % 6)::double + 0.25 as pred from labelled_texts l where l.scores.score is not null and l.text is not null"


def predictions(s, d):
    x = t(s, d, "labelled_texts").filter("scores.score is not null and text is not null")
    y = F.col("scores.score")
    return x.select(F.lit("a").alias("task"), y.cast("double").alias("truth"), (((y + F.length("text") % 3) % 6).cast("double") + 0.25).alias("pred"))


@query(f"with p as ({PRED}) select task, count(*) as n, {R('avg((truth - pred) * (truth - pred))', 'mse')}, {R('avg(abs(truth - pred))', 'mae')}, {R('avg((truth = round_even(pred, 0))::int)', 'accuracy')}, {R('avg(((truth >= 2) = (round_even(pred, 0) >= 2))::int)', 'acc_2')}, {R('avg(((truth >= 3) = (round_even(pred, 0) >= 3))::int)', 'acc_3')} from p group by 1")
def classifier_metrics(s, d):
    return classifier.regression(predictions(s, d), thresholds=(2.0, 3.0))


@query(f"with p as ({PRED}), q as (select task, rank() over (order by truth) + (count(*) over (partition by truth) - 1) / 2.0 as a, rank() over (order by pred) + (count(*) over (partition by pred) - 1) / 2.0 as b from p) select task, {R('corr(a, b)', 'spearman')} from q group by 1")
def classifier_spearman(s, d):
    return classifier.spearman(predictions(s, d))


CT3 = "c as (select task, class, count(*) filter (truth = class and pred = class) as tp, count(*) filter (truth <> class and pred = class) as fp, count(*) filter (truth = class and pred <> class) as fn from p, k group by 1, 2), m as (select *, case when tp + fp > 0 then tp / (tp + fp)::double else 0 end as precision, case when tp + fn > 0 then tp / (tp + fn)::double else 0 end as recall, 2 * tp / (2 * tp + fp + fn)::double as f1, tp + fn as support from c)"
ROUNDED = f"p as (select task, truth, round_even(pred, 0) as pred from ({PRED})), k as (select distinct truth as class from p union select distinct pred from p)"


@query(
    f"with {ROUNDED}, {CT3} select task, class, {R('precision', 'precision')}, {R('recall', 'recall')}, {R('f1', 'f1')}, support, {R('sum(tp) over () / (sum(support) over ())::double', 'accuracy')}, "
    + ", ".join(R(f"avg({x}) over ()", f"macro_{x}") + ", " + R(f"sum({x} * support) over () / (sum(support) over ())::double", f"weighted_{x}") for x in ("precision", "recall", "f1"))
    + ", (sum(support) over ())::bigint as n from m"
)
def classification_report(s, d):
    return classifier.report(classifier.class_table(predictions(s, d), F.col("truth"), F.rint("pred")))


@query(f"with {ROUNDED} select a.task, a.class as truth, b.class as pred, (select count(*) from p where truth = a.class and pred = b.class) as n from (select 'a' as task, class from k) a, k b")
def classification_confusion(s, d):
    return classifier.confusion(predictions(s, d), F.col("truth"), F.rint("pred"))


def _averages(prefix: str) -> str:
    f1 = "avg(f1)"
    cols = {"accuracy": "sum(tp) / sum(support)::double", "f1_micro": "sum(tp) / sum(support)::double", "f1_macro": f1, "f1_weighted": "sum(f1 * support) / sum(support)::double"}
    return " union all ".join(f"select 'a' as task, {prefix} || '{n}' as metric, {x} as value from {{m}}" for n, x in cols.items())


def _binary(t: int) -> str:
    return (
        f"m{t} as (select *, 2 * tp / (2 * tp + fp + fn)::double as f1, tp + fn as support from (select class, count(*) filter (truth = class and pred = class) as tp, count(*) filter (truth <> class and pred = class) as fp, "
        f"count(*) filter (truth = class and pred <> class) as fn from (select (truth >= {t})::int as truth, (pred >= {t})::int as pred from p), (select unnest([0, 1]) as class) group by 1))"
    )


@query(
    f"with {ROUNDED}, {CT3}, " + ", ".join(_binary(x) for x in range(1, 6)) + f", raw as ({PRED}), q as (select rank() over (order by truth) + (count(*) over (partition by truth) - 1) / 2.0 as a, rank() over (order by pred) + (count(*) over (partition by pred) - 1) / 2.0 as b from raw), "
    + "long as (" + _averages("'classification/'").replace("{m}", "m") + "".join(" union all " + _averages(f"'binary/t{x}/'").replace("{m}", f"m{x}") for x in range(1, 6))
    + " union all select 'a', 'class_f1/f1_class_' || class::int, f1 from m where class in (select truth from p) union all select 'a', 'regression/mse', avg((truth - pred) * (truth - pred)) from raw union all select 'a', 'regression/mae', avg(abs(truth - pred)) from raw "
    + f"union all select 'a', 'spearman_corr', corr(a, b) from q) select task, metric, {R('value', 'value')} from long"
)
def classifier_all_metrics(s, d):
    return classifier.metrics(predictions(s, d), {"a": 6})


@query("with p as (select case when doc_id % 7 = 0 then -100.0 else (n_chars % 6)::double end as truth, (n_chars % 5)::double as pred from documents) " f"select {R('avg((truth - pred) * (truth - pred))', 'loss')} from p where truth <> -100")
def mse_masked(s, d):
    x = t(s, d, "documents").select(F.when(F.col("doc_id") % 7 == 0, -100.0).otherwise((F.col("n_chars") % 6).cast("double")).alias("truth"), (F.col("n_chars") % 5).cast("double").alias("pred"))
    return classifier.squared_error(x)


@query()
def head_train(s, d):
    e = t(s, d, "embeddings").withColumn("y", F.array(F.col("label").cast("double")))
    val = F.pmod(F.xxhash64("vec_id"), F.lit(5)) == 0
    h, _ = head.train(e.filter(~val), "embedding", "y", head.Head.fresh(64, 16, 1), epochs=3, steps=2, evaluation={"val": e.filter(val)})
    return head.predict(e, "vec_id", "embedding", h).select("vec_id", F.col("prediction")[0].alias("prediction"))


def _fixed_head() -> head.Head:
    import numpy as np

    i = np.arange(64)[:, None]
    return head.Head(((i * 7 + np.arange(2)[None, :] * 3) % 11 - 5) / 10, np.array([0.25, -0.25]), np.array([[1.5], [-2.0]]), np.array([2.5]))


def _unit(j: int, bias: float) -> str:
    return f"greatest(0, list_sum([embedding[i + 1]::double * (((i * 7 + {j * 3}) % 11) - 5) / 10.0::double for i in range(64)]) + {bias}::double)"


@query(f"select vec_id, {R(f'1.5::double * {_unit(0, 0.25)} - 2.0::double * {_unit(1, -0.25)} + 2.5::double', 'prediction')} from embeddings")
def head_predict(s, d):
    return head.predict(t(s, d, "embeddings"), "vec_id", "embedding", _fixed_head()).select("vec_id", F.col("prediction")[0].alias("prediction"))


@query()
def embedding_axes(s, d):
    return project.principal_components(t(s, d, "embeddings"), "vec_id", "embedding", 2)[0]


def _echo(prompts: list[str]) -> list:
    """A deterministic stand-in for a model service: three answers by the length of the prompt."""
    return [[f"Fits a lesson. Educational score: {(len(p) + k) % 6}" for k in range(3)] for p in prompts]


@query(
    "select doc_id::varchar as document_id, [((length('Rate: ' || c) + k) % 6)::double for k in [0, 1, 2]] as scores from (select doc_id, " f"regexp_replace(translate(text, chr(10) || chr(13), '  '), '{PYWS}', ' ', 'g') as c from documents where length(text) > 0 and length(lang) > 0)"
)
def llm_annotate(s, d):
    ok, _ = annotate.valid_documents(t(s, d, "documents"), "doc_id", "text", "lang")
    p = annotate.prompts(ok, "text", "Rate: {text}", "text")
    return annotate.annotate(p, _echo, "doc_id", "educational_score", "rate", "en", "echo/one").select("document_id", "scores")


def _upper(texts: list[str], source: str, target: str) -> list[str]:
    return [f"{target}:{x}" for x in texts]


@query("select doc_id, c as target_code, c || ':' || text as translated from (select doc_id, text, unnest(['de', 'fr']) as c from documents)")
def translate_fake(s, d):
    x = annotate.translate(t(s, d, "documents").select("doc_id", "text"), "text", "en", ["de", "fr"], _upper, list(schemas.LANGUAGES))
    return x.select("doc_id", "target_code", "translated")


@query(f"with w as (select doc_id, regexp_replace(translate(text, chr(10) || chr(13), '  '), '{PYWS}', ' ', 'g') as c from documents), l as (select *, list_filter(string_split(c, ' '), lambda x: x <> '') as w from w) select doc_id, 'Rate: ' || case when len(w) <= 49 then c else array_to_string(w[1:49], ' ') end as prompt, len(w) > 49 as truncated from l")
def prompt_truncate(s, d):
    p = annotate.prompts(t(s, d, "documents").select("doc_id", "text"), "text", "Rate: {text}", "text", max_words=50)
    return p.select("doc_id", "prompt", F.when(F.col("text").isNotNull(), F.array_contains("tags", "truncated")).alias("truncated"))


@query("select doc_id, c as target_code, c || ':' || 'a ' || text || c || ':' || ' b' as translated from (select doc_id, lang as text, unnest(['de', 'fr']) as c from documents where lang is not null)")
def translate_ignored(s, d):
    x = t(s, d, "documents").filter("lang is not null").select("doc_id", F.concat(F.lit("a <keep>"), "lang", F.lit("</keep> b")).alias("text"))
    return annotate.translate(x, "text", "en", ["de", "fr"], _upper, list(schemas.LANGUAGES), ignore="keep").select("doc_id", "target_code", "translated")


class LowerTokenizer(tokens.CharacterTokenizer):
    """Code points that decode to lower case: what is cut does not always come back as it was."""

    def decode(self, ids):
        return super().decode(ids).lower()


@query(
    f"with c as (select doc_id, regexp_replace(translate(text, chr(10) || chr(13), '  '), '{PYWS}', ' ', 'g') as c from documents where regexp_full_match(coalesce(text, ''), '[\\x00-\\x7f]*')) "
    "select doc_id, 'Rate: ' || case when length(c) > 94 then lower(left(c, 94)) else c end as prompt, length(c) > 94 as truncated, length(c) > 94 and lower(left(c, 94)) <> left(c, 94) as mismatch from c"
)
def prompt_truncate_tokens(s, d):
    x = t(s, d, "documents").select("doc_id", "text").filter(F.coalesce("text", F.lit("")).rlike(r"^[\x00-\x7f]*$"))  # lower case differs between engines beyond
    p = tokens.truncated_prompts(x, "text", "Rate: {text}", "text", LowerTokenizer(), 100)
    has = lambda tag: F.when(F.col("text").isNotNull(), F.array_contains("tags", tag))
    return p.select("doc_id", "prompt", has("truncated").alias("truncated"), has("detokenization_mismatch").alias("mismatch"))


@query("select id, list_resize([ord(c) for c in string_split(left(coalesce(text, ''), 16), '') if c <> '']::int[], 16, 0) as input_ids, least(length(coalesce(text, '')), 16)::int as n_tokens, scores.score::double as label from labelled_texts")
def batch_tokenise(s, d):
    x = t(s, d, "labelled_texts")
    got = tokens.tokenised(x, ["id"], "text", tokens.CharacterTokenizer(), 16, tx.normalise_scores(F.col("scores"), x.schema["scores"].dataType.simpleString()))
    return got.select("id", "input_ids", F.aggregate("attention_mask", F.lit(0), lambda a, b: a + b.cast("int")).alias("n_tokens"), F.col("labels")[0].alias("label"))


@query(f"with {S()} select doc_id, annotator, {R('score', 'score')} from s where score in (1, 2, 3) and annotator not in ('human-panel__round-2', 'sandor-lab__sl-3b')")
def kept_records(s, d):
    return corpus.kept_records(scores(s, d), "annotator", ["human-panel__round-2", "sandor-lab__sl-3b"], "score", (1, 2, 3)).select("doc_id", "annotator", "score")


#: Two ways to write a score, the stricter one first.
FALLBACKS = [r"Score:\s*(\d+(?:\.\d+)?)\s*$", r"(\d+(?:\.\d+)?)"]


@query("with e as (select document_id, unnest(explanations) as x, unnest(generate_series(1, len(explanations))) - 1 as k from annotations) select document_id, k::int as k, try_cast(coalesce(nullif(list_last(regexp_extract_all(x, 'Score:\\s*(\\d+(?:\\.\\d+)?)\\s*$', 1)), ''), nullif(list_last(regexp_extract_all(x, '(\\d+(?:\\.\\d+)?)', 1)), '')) as double) as score from e")
def extract_score_fallback(s, d):
    e = t(s, d, "annotations").select("document_id", F.posexplode("explanations").alias("k", "x"))
    return e.select("document_id", "k", tx.extract_score_fallback(F.col("x"), FALLBACKS).alias("score"))


@query("select doc_id, n_chars::double as truth, length(text)::double as pred from documents")
def equal_id_join(s, d):
    x = t(s, d, "documents")
    return corpus.equal_ids(x.select("doc_id", F.col("n_chars").cast("double").alias("truth")), x.select("doc_id", F.length("text").cast("double").alias("pred")), "doc_id").select("doc_id", "truth", "pred")


# ---------------------------------------------------------------------------------------------- files, written and read again


def _numbered(x, by: str, order: list[str]):
    return x.withColumn("line_no", F.row_number().over(Window.partitionBy(by).orderBy(*order)) - 1)


def _stem(path: str) -> str:
    return f"regexp_extract({path}, '([^/]+?)(\\.[^./]*)?$', 1)"


@query("select doc_id, text, lang, (row_number() over (partition by source order by doc_id) - 1)::bigint as line_no, source || '.jsonl' as file from documents")
def json_lines_files(s, d):
    at = scratch(s)
    x = _numbered(t(s, d, "documents"), "source", ["doc_id"]).select(F.concat("source", F.lit(".jsonl")).alias("name"), "line_no", F.to_json(F.struct("doc_id", "text", "lang")).alias("value"))
    sinks.named_lines(x, at, "name", ["line_no"])
    r = files.json_lines(s, at, "doc_id bigint, text string, lang string", pattern="*.jsonl", recursive=True)
    return r.select("doc_id", "text", "lang", "line_no", F.regexp_extract("file", r"([^/]+)$", 1).alias("file"))


@query(
    "with a as (select *, row_number() over () as k from annotations), x as (select document_id, scores, meta_information.model as model, "
    + _stem("meta_information.raw_data_file_path") + " || '__annotations_' || replace(coalesce(meta_information.model, ''), '/', '--') || '_' || coalesce(meta_information.prompt_name, '') || '_' || coalesce(meta_information.prompt_lang, '') || '.jsonl' as file from a) "
    "select file, document_id, count(*) as n, min(len(scores))::int as votes from x where scores is not null and document_id is not null group by 1, 2"
)
def annotation_files(s, d):
    at = scratch(s)
    m = F.col("meta_information")
    x = t(s, d, "annotations").filter("document_id is not null and scores is not null")
    names = [c.split()[0] for c in schemas.ANNOTATION.split(", ")]
    x = x.select(sinks.annotation_file(m["raw_data_file_path"], m["model"], m["prompt_name"], m["prompt_lang"]).alias("name"), "document_id", F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("value"))
    sinks.named_lines(x, at, "name", ["document_id", "value"])
    r = files.annotations(s, at, pattern="*__annotations_*.jsonl", recursive=True)
    ordered = F.lag("document_id").over(Window.partitionBy("file").orderBy("line_no"))
    bad = F.when(F.col("document_id") < F.col("_before"), F.raise_error(F.lit("file order lost"))).otherwise(True)
    r = r.withColumn("_before", ordered).filter(bad)
    return r.groupBy(F.url_decode(F.replace(F.regexp_extract("file", r"([^/]+)$", 1), F.lit("+"), F.lit("%2B"))).alias("file"), "document_id").agg(F.count("*").alias("n"), F.min(F.size("scores")).alias("votes"))


@query(
    f"with {S()}, l as (select doc_id, path, max(score) as score from s where annotator = 'talisk__talisk-8b' group by 1, 2), "
    "r as (select distinct document_id as doc_id, metadata.file_path as path from random_documents where document_id in (select doc_id from l)), j as (select r.*, l.score, l.doc_id is not null as hit from r left join l using (doc_id, path)), "
    "g as (select *, count(*) filter (not hit) over (partition by path) as misses from j) "
    + "select regexp_extract(path, '^/*(.*/)?[^/]+$', 1) || " + _stem("path") + " || '_talisk__talisk-8b_aggregated_scores_majority.jsonl' as file, (row_number() over (partition by path order by doc_id) - 1)::bigint as line_no, doc_id as id, case when score is null then 'invalid' else (round(score, 6) + 0.0::double)::varchar end as score from g where misses = 0"
)
def score_files(s, d):
    """Files of one annotator, whose documents all have a score: a file of the reference's tables is never complete otherwise."""
    at = scratch(s)
    last = votes.last_scores(scores(s, d).filter(F.col("annotator") == "talisk__talisk-8b").withColumn("o", F.coalesce("score", F.lit(-1.0))), "o")
    raw = t(s, d, "random_documents").select(F.col("document_id").alias("doc_id"), F.col("metadata.file_path").alias("file_path")).distinct().join(last.select("doc_id").distinct(), "doc_id", "left_semi")
    sinks.aggregated_scores(_numbered(raw, "file_path", ["doc_id"]), last, at, "majority", annotator="talisk__talisk-8b")
    r = files.json_lines(s, at, "id string, score string", pattern="*_aggregated_scores_*.jsonl", recursive=True)
    return r.select(F.substring_index("file", f"{at}/", -1).alias("file"), "line_no", "id", "score")


@query(
    "with r as (select doc_id, source, row_number() over (partition by source order by doc_id) - 1 as k from documents where length(text) > 0) "
    "select source || '/offset_' || (k // 50 * 50) || '.jsonl' as file, (k % 50)::bigint as line_no, doc_id::varchar as custom_id from r where k < 120"
)
def batch_requests(s, d):
    at = scratch(s)
    x = _numbered(t(s, d, "documents"), "source", ["doc_id"]).filter("length(text) > 0")
    x = annotate.prompts(x.withColumn("file", F.concat("source", F.lit(".jsonl"))), "text", "Rate: {text}", "text")
    r = annotate.requests(x, "doc_id", "gpt-5-mini", {"max_tokens": 5, "seed": 1}).withColumn("value", annotate.request_line())
    sinks.batch_requests(r, at, 50, 120)
    back = files.json_lines(s, at, "custom_id string, body struct<model:string,max_tokens:int,seed:int>", pattern="offset_*.jsonl", recursive=True)
    kept = F.when((F.col("body.model") != "gpt-5-mini") | F.col("body.max_tokens").isNotNull() | F.col("body.seed").isNull(), F.raise_error(F.lit("wrong options"))).otherwise(True)
    return back.filter(kept).select(F.regexp_extract("file", r"([^/]+/[^/]+)$", 1).alias("file"), "line_no", "custom_id")


@query("with o as (select doc_id, row_number() over (order by doc_id) - 1 as r from documents) select 'chunk=' || (r // 64) as folder, (r % 64)::bigint as line_no, doc_id from o")
def chunk_files(s, d):
    at = scratch(s)
    sinks.chunks(corpus.chunked(t(s, d, "documents").select("doc_id"), ["doc_id"], 64).select("chunk", "line", "doc_id"), at, drop_order=True)
    r = files.json_lines(s, at, "doc_id bigint", pattern="*.json", recursive=True)
    return r.select(F.regexp_extract("file", r"(chunk=[^/]+)/[^/]+$", 1).alias("folder"), "line_no", "doc_id")


@query("select file_path, md5(content) as md5 from (select source || '.txt' as file_path, string_agg(doc_id::varchar || chr(10), '' order by doc_id) as content from documents group by 1)")
def file_digests(s, d):
    at = scratch(s)
    sinks.named_lines(t(s, d, "documents").select(F.concat("source", F.lit(".txt")).alias("name"), "doc_id", F.col("doc_id").cast("string").alias("value")), at, "name", ["doc_id"])
    sinks.append_hashes(files.file_digests(s, files.find(at, "*.txt")), f"{at}/hashes.csv")
    return files.hash_list(s, f"{at}/hashes.csv").select(F.regexp_extract("file_path", r"([^/]+)$", 1).alias("file_path"), "md5")


@query("select doc_id, case when lang is null then 1 else 2 end as fields from documents")
def field_removed(s, d):
    at = scratch(s)
    x = t(s, d, "documents").select(F.lit("d.jsonl").alias("name"), "doc_id", F.to_json(F.struct("doc_id", "lang", "source")).alias("value"))
    sinks.without_field(x.withColumn("line_no", F.col("doc_id")), "source", at)
    return files.json_lines(s, at, "doc_id bigint, lang string, source string", pattern="*.jsonl").select("doc_id", (F.lit(1) + F.col("lang").isNotNull().cast("int") + F.col("source").isNotNull().cast("int")).alias("fields"))


@query("select regexp_extract(meta_information.raw_data_file_path, '([^/]+)/[^/]+$', 1) as folder, count(*) as n, sum(len(scores))::bigint as prompt_tokens from annotations where scores is not null and meta_information.model is not null group by 1")
def batch_usage(s, d):
    at = scratch(s)
    m = F.col("meta_information")
    usage = F.struct(F.size("scores").cast("bigint").alias("prompt_tokens"), F.lit(1).cast("bigint").alias("completion_tokens"), F.size("scores").cast("bigint").alias("total_tokens"))
    x = t(s, d, "annotations").filter("scores is not null").select(F.concat(F.regexp_extract(m["raw_data_file_path"], r"([^/]+)/[^/]+$", 1), F.lit("/batch_results.jsonl")).alias("name"), "document_id", F.to_json(F.struct(F.struct(F.struct(m["model"].alias("model"), usage.alias("usage")).alias("body")).alias("response"))).alias("value"))
    sinks.named_lines(x, at, "name", ["document_id"])
    return files.batch_results(s, at).groupBy("folder").agg(F.count("*").alias("n"), F.sum("prompt_tokens").alias("prompt_tokens"))


@query(f"with {G} select lang, annotator, {R('avg(abs(truth - pred))', 'mae')} from g where lang is not null and truth is not null and pred is not null group by 1, 2")
def metric_files(s, d):
    at = scratch(s)
    per = agreement.truth_metrics(truth_rows(s, d).filter("lang is not null"), ("lang", "annotator"))
    line = F.to_json(F.struct(F.create_map(F.lit("mae"), F.col("mae")).alias("metrics"), F.create_map().cast("map<string,map<string,bigint>>").alias("CM")))
    sinks.named_lines(per.select(F.concat("lang", F.lit("/ir_gt_"), "annotator", F.lit(".json")).alias("name"), "annotator", line.alias("value")), at, "name", ["annotator"])
    return files.metric_results(s, at).select("lang", "annotator", F.col("metrics")["mae"].alias("mae"))
