"""Text expressions: all of them run in the JVM."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's ``str.split`` knows it.
WS = r"(?U)[\s\x1c-\x1f]+"

# Score patterns by metric name.
SCORE_PATTERNS = {
    "educational_score": r"Educational score:\s*(\d+(?:\.\d+)?)",
    "adult_score": r"Adult score:\s*(\d+(?:\.\d+)?)",
    "pii_score": r"PII score:\s*(\d+(?:\.\d+)?)",
}


def register_pattern(metric: str, pattern: str) -> None:
    """Add a metric whose score is group 1 of ``pattern``."""
    SCORE_PATTERNS[metric] = pattern


def clean_text(text: Column, remove: Sequence[str] = ()) -> Column:
    """Line breaks and the given strings become blanks, then white space runs become one blank; nothing is trimmed."""
    c = F.translate(text, "\n\r", "  ")
    for s in remove:
        c = F.replace(c, F.lit(s), F.lit(" "))
    return F.regexp_replace(c, WS, " ")


def last_match(text: Column, pattern: str) -> Column:
    """Group 1 of the last match, or NULL."""
    return F.try_element_at(F.regexp_extract_all(text, F.lit("(?U)" + pattern), F.lit(1)), F.lit(-1))


#: Decimal digits of other scripts and their ASCII forms.
_DIGITS = [chr(i) for i in range(128, sys.maxunicode + 1) if unicodedata.category(chr(i)) == "Nd"]
_ASCII = "".join(str(unicodedata.decimal(c)) for c in _DIGITS)


def _number(text: Column) -> Column:
    return F.translate(text, "".join(_DIGITS), _ASCII).try_cast("double")


def extract_score(text: Column, metric: str) -> Column:
    """Score of a generated answer as double, NULL when there is none; unknown metrics raise ValueError."""
    if metric not in SCORE_PATTERNS:
        raise ValueError(f"unknown metric {metric!r}")
    return _number(last_match(text, SCORE_PATTERNS[metric]))


def extract_score_fallback(text: Column, patterns: Sequence[str]) -> Column:
    """First of several patterns that matches."""
    return _number(F.coalesce(*[last_match(text, p) for p in patterns]))


def words(text: Column) -> Column:
    return F.filter(F.split(text, WS), lambda x: x != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def fill_prompt(template: str, slot: str, text: Column) -> Column:
    """Put ``text`` into ``{slot}``; doubled braces stand for single ones."""
    mark = "\x00"
    head, found, tail = template.replace("{" + slot + "}", mark, 1).partition(mark)
    if not found:
        raise KeyError(slot)
    plain = lambda s: F.lit(s.replace("{{", "{").replace("}}", "}"))
    return F.concat(plain(head), text, plain(tail))


def messages(history: Sequence[dict], prompt: Column) -> Column:
    """Chat history with the prompt as last user message."""
    past = [F.struct(F.lit(m["role"]).alias("role"), F.lit(m["content"]).alias("content")) for m in history]
    return F.array(*past, F.struct(F.lit("user").alias("role"), prompt.alias("content")))


def annotator_name(model: Column) -> Column:
    """Model name with its slash (also written ``--``) as ``__``."""
    return F.regexp_replace(model, "/|--", "__")


def annotator_of_stem(stem: Column) -> Column:
    return F.try_element_at(F.split(stem, "_"), F.lit(-1))


def round_half_up(x: Column) -> Column:
    """``floor(x + 0.5)`` as bigint; negative input raises, NULL passes."""
    return F.when(x < 0, F.raise_error(F.lit("value must not be negative"))).otherwise(F.floor(x + F.lit(0.5)))


def round_half_even(x: Column) -> Column:
    return F.rint(x)


def normalise_scores(scores: Column, kind: str) -> Column:
    """Score list from a list, a ``{score: x}`` struct or a scalar; kind is the column's Spark type."""
    if kind.startswith("array"):
        return scores.cast("array<double>")
    if kind.startswith("struct"):
        return F.array(scores["score"].cast("double"))
    return F.array(scores.cast("double"))


def seeded_uniform(seed: int, key: Column) -> Column:
    """A number in [0, 1) fixed by seed and key, the same in every engine with md5."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


#: Score transforms by name: (score, key, seed) -> Column.
TRANSFORMS: dict[str, Callable[[Column, Column, int], Column]] = {
    "score": lambda x, k, s: round_half_up(x).cast("double"),
    "shift_up_capped": lambda x, k, s: F.least(x + 1, F.lit(5.0)),
    "add_noise_clamped": lambda x, k, s: F.greatest(F.lit(0.0), F.least(F.lit(5.0), x + seeded_uniform(s, k) - F.lit(0.5))),
    "binary_threshold": lambda x, k, s: (x >= 3).cast("double"),
}


def path_part(path: Column, which: str) -> Column:
    """``dump`` or ``lang`` of a corpus path ``.../dump/lang/file.jsonl``."""
    return F.regexp_extract(path, r"([^/]+)/([^/]+)/[^/]+$", {"dump": 1, "lang": 2}[which])


def safe_ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))
