"""Queries over the project's tables, one or more for each operator of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm import budget, consensus, cutoff, encode, langid, lines, overlap, pack, pii, quota
from corpusmill.llm.common import table as t

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(s: SparkSession, d: str) -> DataFrame:
    return consensus.consensus(s.read.parquet(f"{d}/annotations.parquet"))[0].filter("n_annotators >= 4").select("document_id", "label")


def p1_consensus(s: SparkSession, d: str) -> DataFrame:
    return consensus.consensus(t(s, d, "annotations"))[0]


def p1_annotators(s: SparkSession, d: str) -> DataFrame:
    return consensus.consensus(t(s, d, "annotations"))[1]


def p2_found(s: SparkSession, d: str) -> DataFrame:
    return quota.unmet(s.read.parquet(f"{d}/random_documents.parquet"), t(s, d, "sample_targets"))


def p2_sample(s: SparkSession, d: str) -> DataFrame:
    return quota.sample(t(s, d, "random_documents"), t(s, d, "sample_targets"))


def p2_report(s: SparkSession, d: str) -> DataFrame:
    return quota.report(t(s, d, "random_documents"), t(s, d, "sample_targets"))


def p3_found(s: SparkSession, d: str) -> DataFrame:
    return cutoff.kept(s.read.parquet(f"{d}/random_documents.parquet"), t(s, d, "cutoff_targets"))


def p3_cutoffs(s: SparkSession, d: str) -> DataFrame:
    return cutoff.cutoffs(t(s, d, "random_documents"), t(s, d, "cutoff_targets"))


def p3_closest(s: SparkSession, d: str) -> DataFrame:
    return cutoff.cutoffs(t(s, d, "random_documents"), t(s, d, "cutoff_targets"), rule="closest")


def p4_found(s: SparkSession, d: str) -> DataFrame:
    return langid.found(s.read.parquet(f"{d}/random_documents.parquet"))


def p4_segments(s: SparkSession, d: str) -> DataFrame:
    docs = t(s, d, "random_documents")
    model = langid.fit(langid.training_sample(docs))
    return langid.segments(docs, ["document_id"], model=model).select("document_id", "line_no", "lang_code", "confidence", "n_words").distinct()


def p5_found(s: SparkSession, d: str) -> DataFrame:
    return overlap.found(s.read.parquet(f"{d}/labelled_texts.parquet"))


def p5_report(s: SparkSession, d: str) -> DataFrame:
    return overlap.report(t(s, d, "labelled_texts"))


def p6_found(s: SparkSession, d: str) -> DataFrame:
    return budget.untrusted(s.read.parquet(f"{d}/random_documents.parquet"))


def p6_budget(s: SparkSession, d: str) -> DataFrame:
    return budget.budget(t(s, d, "random_documents"))


def p6_multi_budget(s: SparkSession, d: str) -> DataFrame:
    return budget.budget(t(s, d, "random_documents"), vocabulary="byte_bpe_multi_50k")


def p7_found(s: SparkSession, d: str) -> DataFrame:
    return lines.repeated_lines(s.read.parquet(f"{d}/random_documents.parquet"))


def p7_templates(s: SparkSession, d: str) -> DataFrame:
    return lines.templates(t(s, d, "random_documents"))


def p7_cleaned(s: SparkSession, d: str) -> DataFrame:
    return lines.without_repeated(t(s, d, "random_documents"))


def p7_cleaned_templates(s: SparkSession, d: str) -> DataFrame:
    return lines.without_repeated(t(s, d, "random_documents"), whole_templates=True)


def p8_ids(s: SparkSession, d: str) -> DataFrame:
    return encode.encode(s.read.parquet(f"{d}/documents.parquet"))


def p8_decoded(s: SparkSession, d: str) -> DataFrame:
    return encode.decode(encode.encode(t(s, d, "documents")))


def p9_pack(s: SparkSession, d: str) -> DataFrame:
    return pack.pack(s.read.parquet(f"{d}/documents.parquet"), t(s, d, "pack_capacities"))


def p9_fill(s: SparkSession, d: str) -> DataFrame:
    caps = t(s, d, "pack_capacities")
    return pack.fill_report(pack.pack(t(s, d, "documents"), caps), caps)


def p10_found(s: SparkSession, d: str) -> DataFrame:
    return pii.found(s.read.parquet(f"{d}/documents.parquet"), t(s, d, "given_names"))


def p10_redacted(s: SparkSession, d: str) -> DataFrame:
    return pii.redact(t(s, d, "documents"), t(s, d, "given_names"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        p1_found, p1_consensus, p1_annotators, p2_found, p2_sample, p2_report, p3_found, p3_cutoffs, p3_closest, p4_found, p4_segments, p5_found, p5_report,
        p6_found, p6_budget, p6_multi_budget, p7_found, p7_templates, p7_cleaned, p7_cleaned_templates, p8_ids, p8_decoded, p9_pack, p9_fill, p10_found, p10_redacted,
    )
}

# ---------------------------------------------------------------- the same queries in SQL, where SQL can express them

_REC = "nullif(regexp_extract(lower(trim(metadata.language)), '^([^-_]*)', 1), '')"
_VALID = "scores.score is not null and isfinite(scores.score) and scores.score between 0 and 5"
_ELIGIBLE = f"select document_id, {_REC} as lang, scores.score as score from (select distinct * from random_documents) where {_VALID} and {_REC} is not null"
_SITE = (
    "nullif(regexp_replace(case when regexp_extract(lower(trim(metadata.url)), '^(?:[a-z][a-z0-9+.\\-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)', 1) = ''"
    " then regexp_extract(lower(trim(metadata.url)), '^([^/?#:@\\s]+\\.[^/?#:@\\s]+)', 1)"
    " else regexp_extract(lower(trim(metadata.url)), '^(?:[a-z][a-z0-9+.\\-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)', 1) end, '^www\\.', ''), '')"
)
_WS = "[\\s\\x0b\\x1c-\\x1f\\x85\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+"

_CELLS = f"""
with e as ({_ELIGIBLE}), n as (select count(*) as total from e), c as (
  select t.plan_name, t.cell_no, any_value(t.target_pct) target_pct, any_value(t.min_docs) min_docs, any_value(t.sample_pct) sample_pct, count(e.document_id) as have
  from (select distinct * from sample_targets) t left join e on (t.lang_code is null or e.lang = t.lang_code)
    and (t.score_min is null or e.score >= t.score_min) and (t.score_max is null or e.score < t.score_max)
  group by t.plan_name, t.cell_no)
"""
_DRAW = f"""
with e as ({_ELIGIBLE}), n as (select count(*) as total from e),
t as (select *, row_number() over (partition by plan_name order by cell_no) as place, max(sample_pct) over (partition by plan_name) as pct from (select distinct * from sample_targets)),
r as (select t.plan_name, t.cell_no, t.place, t.target_pct, t.min_docs, t.pct, e.document_id, row_number() over (partition by t.plan_name, t.cell_no order by md5('42:' || e.document_id), e.document_id) as cell_rank
  from t join e on (t.lang_code is null or e.lang = t.lang_code) and (t.score_min is null or e.score >= t.score_min) and (t.score_max is null or e.score < t.score_max)),
q as (select *, cell_rank <= min_docs as floor, row_number() over (partition by plan_name order by cell_rank > min_docs, case when cell_rank > min_docs then (cell_rank - 0.5::double) / target_pct end, place, cell_rank) as seat
  from r where target_pct > 0 or cell_rank <= min_docs),
d as (select plan_name, cell_no, document_id, cell_rank::bigint as cell_rank from q, n where floor or seat <= pct * total // 100)
"""
_CUT = f"""
with e as (select document_id, lang as lang_code, score from ({_ELIGIBLE})),
c as (select lang_code, score, count(*) n from e group by 1, 2),
u as (select lang_code, score, sum(n) over (partition by lang_code order by score desc) as up, sum(n) over (partition by lang_code) as n_docs from c),
k as (select t.lang_code, t.keep_pct, any_value(u.n_docs) n_docs, max(u.score) as cutoff, min(u.up) as n_kept
      from (select distinct * from cutoff_targets) t join u using (lang_code) where u.up * 100 >= t.keep_pct * u.n_docs group by 1, 2)
"""
_LINES = f"""
with d as (select document_id, text, {_SITE} as site, row_number() over () as k from (select distinct * from random_documents)),
s as (select site, count(*) as site_docs from d where site is not null group by 1),
l as (select document_id, k, site, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as line_no from d where site is not null and text is not null),
m as (select document_id, k, site, line_no, regexp_replace(trim(regexp_replace(lower(line), '{_WS}', ' ', 'g')), '[0-9]+', '0', 'g') as norm from l where regexp_matches(line, '\\p{{L}}')),
c as (select site, norm, count(distinct k) as n from m group by 1, 2),
r as (select c.site, c.norm from c join s using (site) where c.n >= 5 and c.n * 10 >= s.site_docs)
"""

ORACLE: dict[str, str] = {
    "p2_found": _CELLS + "select plan_name, cell_no from c, n where have * 10000 < target_pct * sample_pct * total or have < min_docs",
    "p2_sample": _DRAW + "select * from d",
    "p2_report": _CELLS.rstrip() + ", " + _DRAW.replace(f"with e as ({_ELIGIBLE}), n as (select count(*) as total from e),", "", 1).strip()
    + ", g as (select plan_name, cell_no, count(*) as drawn from d group by 1, 2) select c.plan_name, c.cell_no, have as available, (target_pct * sample_pct * total)::double / 10000 as wanted, coalesce(drawn, 0)::bigint as drawn, "
    "have * 10000 >= target_pct * sample_pct * total as target_met, have >= min_docs as minimum_met from n, c left join g using (plan_name, cell_no)",
    "p3_found": _CUT + "select distinct e.lang_code, e.document_id from e join k using (lang_code) where e.score >= k.cutoff",
    "p3_cutoffs": _CUT + "select lang_code, keep_pct::double as keep_pct, n_docs::bigint as n_docs, cutoff, n_kept::bigint as n_kept from k",
    "p3_closest": _CUT + ", nx as (select k.lang_code, min(u.score) as s, max(u.up) filter (u.score > k.cutoff) as up from k left join u on u.lang_code = k.lang_code and u.score > k.cutoff group by 1), "
    "w as (select k.*, nx.s, nx.up, coalesce(abs(nx.up - k.keep_pct * k.n_docs / 100.0::double) < abs(k.n_kept - k.keep_pct * k.n_docs / 100.0::double), false) as other from k join nx using (lang_code)) "
    "select lang_code, keep_pct::double as keep_pct, n_docs::bigint as n_docs, case when other then s else cutoff end as cutoff, (case when other then up else n_kept end)::bigint as n_kept from w",
    "p7_found": _LINES + "select distinct m.document_id, m.line_no::bigint as line_no from m join r using (site, norm)",
    "p7_cleaned": _LINES + "select b.document_id, case when g.gone is null then b.text else array_to_string(list_filter(string_split(b.text, chr(10)), lambda x, i: not list_contains(g.gone, i)), chr(10)) end as text, "
    "coalesce(len(g.gone), 0)::bigint as n_removed from (select distinct * from random_documents) b left join (select d.document_id, d.text, d.site, any_value(o.gone) as gone from d join "
    "(select m.k, list(m.line_no) as gone from m join r using (site, norm) group by 1) o using (k) group by all) g on g.document_id = b.document_id and g.text = b.text and g.site = " + _SITE.replace("metadata.", "b.metadata.") ,
    "p8_decoded": "select doc_id, coalesce(text, '') as text from documents",
}

__all__ = ["ORACLE", "QUERIES"]
