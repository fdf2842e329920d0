"""Scoring documents through an injected model client, and translating them through an injected translator.

A client is any picklable callable ``prompts -> answers`` (a list of n answers, or an exception, for each prompt). Clients run inside
``mapInPandas``; a document and all its votes stay in one row, so nothing is shuffled.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.schemas import ANNOTATION, TARGET_LANGUAGE

Client = Callable[[list[str]], list]


class ServerError(RuntimeError):
    """The service answered with status 500: the run ends, without retries."""


def with_retries(client: Client, retries: int = 2, backoff: float = 0.4, sleep: Callable[[float], None] = time.sleep) -> Client:
    """Repeat a call on connection errors, waiting ``backoff * 2^i``; then every prompt of it fails."""

    def call(prompts: list[str]) -> list:
        for i in range(retries + 1):
            try:
                return client(prompts)
            except ConnectionError as e:
                last = e
                if i < retries:
                    sleep(backoff * 2**i)
        return [last] * len(prompts)

    return call


def valid_documents(docs: DataFrame, id: str, text: str, language: str) -> tuple[DataFrame, DataFrame]:
    """Documents with non-empty id, text and language, and the others."""
    ok = F.coalesce((F.length(F.col(id).cast("string")) > 0) & (F.length(text) > 0) & (F.length(language) > 0), F.lit(False))
    return docs.filter(ok), docs.filter(~ok)


def truncate_words(text: Column, budget: int) -> Column:
    """First ``budget`` words by white space: the built-in tokenizer stand-in."""
    w = tx.words(text)
    return F.when(F.size(w) <= budget, text).otherwise(F.array_join(F.slice(w, 1, max(budget, 0)), " ") if budget > 0 else F.lit(""))


def prompts(docs: DataFrame, text: str, template: str, slot: str, max_words: int | None = None, remove: Sequence[str] = ()) -> DataFrame:
    """Adds ``prompt`` and ``tags``; texts are cleaned, and cut so that template and text fit ``max_words``."""
    clean = tx.clean_text(F.col(text), remove)
    if max_words is None:
        return docs.withColumn("prompt", tx.fill_prompt(template, slot, clean)).withColumn("tags", F.array().cast("array<string>"))
    room = max_words - len(template.replace("{" + slot + "}", " ").split())
    cut = truncate_words(clean, room)
    tags = F.when(tx.word_count(clean) > max(room, 0), F.array(F.lit("truncated"))).otherwise(F.array().cast("array<string>"))
    return docs.withColumn("prompt", tx.fill_prompt(template, slot, cut)).withColumn("tags", tags)


def annotate(prompted: DataFrame, client: Client, id: str, metric: str, prompt_name: str, prompt_lang: str, model: str, source: str | None = None, keep: Sequence[str] = (), tokens: Callable[[str], int] | None = None) -> DataFrame:
    """Annotation rows from prompts. A failed call has status error_server, an empty answer error_no_generated_text, an answer
    without score error_faulty_score; the first error stays. ServerError ends the job. ``keep`` columns go along (places in the input);
    ``errors`` of the prompts stand before those of the calls; ``tokens`` counts those of an answer (white-space words by default)."""
    old = F.col("errors") if "errors" in prompted.columns else F.array().cast("array<string>")
    d = prompted.select(F.col(id).cast("string").alias("document_id"), "prompt", (F.col(source) if source else F.lit(None)).cast("string").alias("src"), old.alias("old"), *keep)
    count = tokens or (lambda t: len(t.split()))
    kept = "".join(f", `{k}` {prompted.schema[k].dataType.simpleString()}" for k in keep)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in it:
            t0 = time.time()
            answers = client(p["prompt"].tolist()) if len(p) else []
            took = max(time.time() - t0, 1e-9)
            rows = []
            for doc, src, first, a in zip(p["document_id"], p["src"], p["old"], answers):
                if isinstance(a, ServerError):
                    raise a
                votes = [None] if isinstance(a, Exception) else list(a)
                err = list(first) + ([str(a)] if isinstance(a, Exception) else [])
                n = sum(count(v) for v in votes if v)
                rows.append((doc, votes, [err for _ in votes], [int(t0)] * len(votes), ["error_server" if isinstance(a, Exception) else None] * len(votes), src, n / took))
            out = pd.DataFrame(rows, columns=["document_id", "explanations", "errors", "time_stamps", "st", "src", "tps"])
            yield out.assign(**{k: p[k].to_numpy() for k in keep})

    out = d.mapInPandas(run, "document_id string, explanations array<string>, errors array<array<string>>, time_stamps array<bigint>, st array<string>, src string, tps double" + kept)
    scores = F.transform("explanations", lambda x: tx.extract_score(x, metric))
    status = F.zip_with(
        F.arrays_zip(F.col("st").alias("st"), F.col("explanations").alias("x")), scores,
        lambda a, s: F.when(a["st"].isNotNull(), a["st"]).when(a["x"].isNull() | (F.length(F.trim(a["x"])) == 0), "error_no_generated_text").when(s.isNull(), "error_faulty_score").otherwise("success"),
    )
    meta = F.struct(F.lit(prompt_name).alias("prompt_name"), F.lit(prompt_lang).alias("prompt_lang"), F.lit(model).alias("model"), F.col("src").alias("raw_data_file_path"), F.col("tps").alias("out_tokens_per_second"))
    cols = {"scores": scores, "document_processing_status": status, "meta_information": meta}
    names = [c.split()[0] for c in ANNOTATION.split(", ")]
    return out.select(*[cols[c].alias(c) if c in cols else F.col(c) for c in names], *keep)


#: Fixed value: model names of the service that take no generation parameters, and those parameters.
WITHOUT_PARAMETERS = {"gpt-5": ("max_tokens", "temperature", "top_p")}


def dropped_options(model: str) -> tuple[str, ...]:
    return tuple(o for part, names in WITHOUT_PARAMETERS.items() if part in model for o in names)


def requests(prompted: DataFrame, id: str, model: str, options: dict | None = None, drop: Sequence[str] | None = None) -> DataFrame:
    """``custom_id, method, url, body`` and the other columns: batch requests instead of calls, without the generation options the model doesn't take."""
    drop = dropped_options(model) if drop is None else drop
    opts = {k: v for k, v in (options or {}).items() if k not in drop}
    msg = tx.messages([], F.col("prompt"))
    body = F.struct(F.lit(model).alias("model"), msg.alias("messages"), *[F.lit(v).alias(k) for k, v in opts.items()])
    rest = [c for c in prompted.columns if c not in (id, "custom_id", "method", "url", "body")]
    return prompted.select(F.col(id).cast("string").alias("custom_id"), F.lit("POST").alias("method"), F.lit("/v1/chat/completions").alias("url"), body.alias("body"), *rest)


def request_line() -> Column:
    return F.to_json(F.struct("custom_id", "method", "url", "body"))


def readdressed(lines: DataFrame, model: str) -> DataFrame:
    """Collected annotations (``file, line_no, value`` as JSON) to their requests for ``model``; an annotation without request raises."""
    if not model:
        raise ValueError("no model")
    drop = dropped_options(model)

    def one(value: str) -> str:
        r = json.loads(value).get("request")
        if r is None:
            raise ValueError("an annotation has no request: collect requests first")
        r["body"] = {k: v for k, v in r["body"].items() if k not in drop} | {"model": model}
        return json.dumps(r, ensure_ascii=False)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in it:
            yield p.assign(value=[one(v) for v in p["value"]])

    return lines.filter(F.trim("value") != "").select("file", "line_no", "value").mapInPandas(run, "file string, line_no bigint, value string")


def fan_out(docs: DataFrame, languages: dict[str, str]) -> DataFrame:
    """Every document once per target language."""
    langs = F.array(*[F.struct(F.lit(c).alias("target_code"), F.lit(n).alias("target_language")) for c, n in languages.items()])
    return docs.select("*", F.inline(langs))


def prompts_by_language(template: str, languages: dict[str, str]) -> dict[str, str]:
    return {c: template.replace(TARGET_LANGUAGE, n) for c, n in languages.items()}


def _translated(texts: list[str], call: Callable[[list[str]], list[str]], ignore: str | None) -> list[str]:
    if not ignore:
        return call(texts)
    parts = [re.split(f"<{re.escape(ignore)}>(.*?)</{re.escape(ignore)}>", t, flags=re.S) for t in texts]  # odd ones stay
    new = iter(call([x for p in parts for x in p[::2] if x.strip()]))
    return ["".join(x if i % 2 or not x.strip() else next(new) for i, x in enumerate(p)) for p in parts]


def translate(docs: DataFrame, text: str, source_lang: str, targets: Sequence[str], translator: Callable[[list[str], str, str], list[str]], supported: Sequence[str], ignore: str | None = None) -> DataFrame:
    """Documents by target language with ``translated`` and ``unchanged``; unknown languages and non-string texts raise.

    Texts between ``<ignore>`` and ``</ignore>`` are not given to the translator and come back as they are, without the tags.
    """
    for c in (source_lang, *targets):
        if c not in supported:
            raise ValueError(f"language {c!r} is not supported")
    if docs.schema[text].dataType.typeName() != "string":
        raise ValueError(f"{text} has to be a string")
    d = fan_out(docs, {c: c for c in targets}).drop("target_language")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema.fields) + ", translated string"

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in it:
            out = pd.Series([None] * len(p), index=p.index, dtype=object)
            for code, g in p.groupby("target_code"):
                ok = g[text].notna()
                out[g.index[ok]] = _translated(g[text][ok].tolist(), lambda xs, c=code: translator(xs, source_lang, c), ignore)
            yield p.assign(translated=out)

    return d.mapInPandas(run, schema).withColumn("unchanged", F.col("translated") == F.col(text))
