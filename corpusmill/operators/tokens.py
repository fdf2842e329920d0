"""Tokenizers by interface: any picklable object with ``encode(text) -> ids`` and ``decode(ids) -> text``, and optionally ``template(messages) -> text``.

They run in Arrow batches; the tokenizers here need no vocabulary and serve as defaults and in tests.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as tx


class Tokenizer(Protocol):
    def encode(self, text: str) -> list[int]: ...

    def decode(self, ids: Sequence[int]) -> str: ...


class CharacterTokenizer:
    """Code points."""

    def encode(self, text: str) -> list[int]:
        return [ord(c) for c in text]

    def decode(self, ids: Sequence[int]) -> str:
        return "".join(map(chr, ids))


class WordTokenizer:
    """Words with the white space before them; ids count the words this worker has met, so it decodes what it encoded."""

    def __init__(self) -> None:
        self.ids: dict[str, int] = {}
        self.words: list[str] = []

    def encode(self, text: str) -> list[int]:
        out = []
        for w in re.findall(r"\s*\S+|\s+$", text):
            if w not in self.ids:
                self.ids[w] = len(self.words)
                self.words.append(w)
            out.append(self.ids[w])
        return out

    def decode(self, ids: Sequence[int]) -> str:
        return "".join(self.words[i] for i in ids)


def template(tokenizer: Tokenizer, messages: Sequence[dict]) -> str:
    """The tokenizer's chat template, or the contents one below the other."""
    own = getattr(tokenizer, "template", None)
    return own(messages) if own else "\n".join(m["content"] for m in messages)


def differing_characters(a: str, b: str) -> int:
    """Number of added and removed characters."""
    return sum(1 for x in difflib.ndiff(a, b) if x[0] in "+-")


def truncated_prompts(docs: DataFrame, text: str, prompt: str, slot: str, tokenizer: Tokenizer, max_tokens: int, history: Sequence[dict] = (), remove: Sequence[str] = ()) -> DataFrame:
    """Adds ``prompt``, ``tags`` and ``errors``: texts are cleaned and cut to the tokens that the empty prompt in its chat template leaves.

    A cut text is tagged ``truncated``; where its tokens do not decode to its beginning, ``detokenization_mismatch`` and an error with the
    number of differing characters. NULL texts have NULL prompts; nothing fits where the empty prompt is too long.
    """
    fill = _filler(prompt, slot)
    past = [dict(m) for m in history]
    room = max(0, max_tokens - len(tokenizer.encode(template(tokenizer, [*past, {"role": "user", "content": fill("")}]))))
    d = docs.withColumn("_clean", tx.clean_text(F.col(text), remove))
    add = {"prompt": "string", "tags": "array<string>", "errors": "array<string>"}
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + "".join(f", {k} {v}" for k, v in add.items())

    def one(t: str | None) -> tuple[str | None, list[str], list[str]]:
        if t is None:
            return None, [], []
        tags, errors, ids = [], [], tokenizer.encode(t)
        if len(ids) > room:
            tags.append("truncated")
            cut = tokenizer.decode(ids[:room])
            begin = t[: len(cut)]
            if cut != begin:
                tags.append("detokenization_mismatch")
                errors.append(f"Detokenization mismatch: {differing_characters(begin, cut)} differing characters")
            t = cut
        return template(tokenizer, [*past, {"role": "user", "content": fill(t)}]), tags, errors

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in it:
            got = [one(t) for t in p.pop("_clean")]
            yield p.assign(prompt=[g[0] for g in got], tags=[g[1] for g in got], errors=[g[2] for g in got])

    return d.mapInPandas(run, schema)


def _filler(prompt: str, slot: str):
    head, found, tail = prompt.replace("{" + slot + "}", "\x00", 1).partition("\x00")
    if not found:
        raise KeyError(slot)
    head, tail = (x.replace("{{", "{").replace("}}", "}") for x in (head, tail))
    return lambda t: head + t + tail


def tokenised(docs: DataFrame, keys: Sequence[str], text: str, tokenizer: Tokenizer, max_length: int, labels: Column | None = None, padding: bool = True, truncation: bool = True, pad: int = 0) -> DataFrame:
    """``<keys>, input_ids, attention_mask[, labels]``: texts as ids, cut and padded to ``max_length``; NULL texts count as empty. A longer text raises without truncation."""
    cols = [*[F.col(k) for k in keys], F.coalesce(F.col(text), F.lit("")).alias("_t"), *([labels.alias("labels")] if labels is not None else [])]
    d = docs.select(*cols)
    out = [f for f in d.schema.fields if f.name != "_t"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out) + ", input_ids array<int>, attention_mask array<tinyint>"

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in it:
            ids = [tokenizer.encode(t) for t in p.pop("_t")]
            if not truncation and any(len(x) > max_length for x in ids):
                raise ValueError(f"a text has more than {max_length} tokens")
            ids = [list(x[:max_length]) for x in ids]
            fill = [max_length - len(x) if padding else 0 for x in ids]
            yield p.assign(input_ids=[x + [pad] * n for x, n in zip(ids, fill)], attention_mask=[[1] * len(x) + [0] * n for x, n in zip(ids, fill)])

    return d.mapInPandas(run, schema)
