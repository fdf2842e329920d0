"""Lines that one site repeats over many of its documents.

Lines are parsed into templates by a token tree of fixed depth: site, number of tokens, and the leading tokens, of which those with digits are
wildcard slots. Below a leaf the slots are learnt: a token that enough of the site's documents have at its place is part of the
template, every other one is a slot ``<*>``; a line belongs to a template when at least half of its tokens are no slots. Leaves, and the tokens at
their places, are counts, so the trees of partitions merge by adding up. Templates that cover enough documents of their site are the repeated
ones. A case of the query is a line and not a template: an exact count of the lines in wide templates follows. No case is lost on the way, as the tokens
of a line that enough documents have are themselves in enough documents.

Texts are split once; the normalised lines of a document stay in one row until leaves that are wide enough are known.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.bitmap import key_filter, of_column, passes
from corpusmill.llm.common import lines_of, row_key, site_of
from corpusmill.llm.wordtable import cut

#: Leading tokens that are levels of the tree.
DEPTH = 3
SLOT = "<*>"
_DIGITS = re.compile("[0-9]+")


def same_line(line: str) -> str:
    """Lower case, trimmed, white space runs as one blank, digit runs as one digit; empty without any letter."""
    norm = " ".join(line.lower().split())
    return _DIGITS.sub("0", norm) if any(map(str.isalpha, norm)) else ""


def leaf_of(site: str, norm: str) -> int:
    """64-bit id of a normalised line's leaf: site, token count and leading tokens."""
    import xxhash

    head = [SLOT if "0" in t else t for t in norm.split(" ", DEPTH)[:DEPTH]]
    return xxhash.xxh3_64_intdigest(f"{site}\x1f{norm.count(' ')}\x1f" + "\x1f".join(head)) - (1 << 63)


def parsed(docs: DataFrame, doc: str = "document_id", text: str = "text", url: str = "metadata.url") -> DataFrame:
    """``document_id, k, site, lines``: one row per distinct document row of a site, with number, leaf and normalised form of its lines with letters.

    Only rows whose key occurs again are shuffled to drop the repeated ones.
    """
    keyed = docs.withColumn("_k", row_key(docs))
    again = keyed.groupBy("_k").agg(F.count("*").alias("n")).filter("n > 1").select("_k")
    twice = docs.sparkSession.sparkContext.broadcast(key_filter(again, of_column("_k"), again.count()))  # of bounded size
    d = keyed.select(F.col(doc).cast("string").alias("document_id"), F.col("_k").alias("k"), site_of(F.col(url)).alias("site"), F.col(text).alias("text")).filter("site is not null")
    kind = pa.list_(pa.struct([("line_no", pa.int64()), ("leaf", pa.int64()), ("norm", pa.string())]))

    def part(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in it:
            out = []
            for site, t in zip(rows.column("site").to_pylist(), rows.column("text").to_pylist()):
                lines = [(i, norm) for i, x in enumerate(t.split("\n"), 1) if (norm := same_line(x))] if t else []
                out.append([{"line_no": i, "leaf": leaf_of(site, norm), "norm": norm} for i, norm in lines])
            cols = {c: rows.column(c) for c in ("document_id", "k", "site")} | {"twice": pa.array(passes(twice.value, of_column("k")(rows))), "lines": pa.array(out, kind)}
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    p = cut(d.mapInArrow(part, "document_id string, k bigint, site string, twice boolean, lines array<struct<line_no:bigint,leaf:bigint,norm:string>>"))
    return p.filter("not twice").unionByName(p.filter("twice").dropDuplicates(["document_id", "k"])).drop("twice")


def _lines_of_leaves(p: DataFrame, wide: DataFrame) -> DataFrame:
    """``document_id, k, site, line_no, norm, leaf, need``: the lines of wide leaves; the others leave their documents' rows before any shuffle."""
    wanted = p.sparkSession.sparkContext.broadcast(key_filter(wide.select("leaf"), of_column("leaf"), wide.count()))  # of bounded size

    def part(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in it:
            lines = rows.column("lines")
            v = lines.flatten()
            ok = np.flatnonzero(passes(wanted.value, v.field("leaf").to_numpy(zero_copy_only=False)))
            owner = np.repeat(np.arange(rows.num_rows), np.diff(lines.offsets.to_numpy()))[ok]
            cols = {c: rows.column(c).take(pa.array(owner)) for c in ("document_id", "k", "site")} | {c: v.field(c).take(pa.array(ok)) for c in ("line_no", "norm", "leaf")}
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    e = p.mapInArrow(part, "document_id string, k bigint, site string, line_no bigint, norm string, leaf bigint")
    return e.join(wide.select("leaf", "need"), "leaf")


def _candidates(docs: DataFrame, doc: str, text: str, url: str, min_docs: int, min_share: float) -> DataFrame:
    """``document_id, k, site, line_no, norm, need, template``: the lines that belong to a template which enough documents have."""
    p = parsed(docs, doc, text, url)
    need = p.groupBy("site").agg(F.greatest(F.lit(float(min_docs)), F.count("*") * F.lit(min_share)).alias("need"))
    leaves = p.select(F.xxhash64("site").alias("s"), F.explode(F.array_distinct(F.transform("lines", lambda x: x["leaf"]))).alias("leaf")).groupBy("leaf").agg(F.count("*").alias("n"), F.min("s").alias("s")).filter(F.col("n") >= min_docs)
    wide = cut(leaves.join(need.groupBy(F.xxhash64("site").alias("s")).agg(F.min("need").alias("need")), "s").filter(F.col("n") >= F.col("need") - 1e-9).select("leaf", "need"))
    e = cut(_lines_of_leaves(p, wide))
    # distinct lines of a document count once for each of their tokens
    places = e.dropDuplicates(["document_id", "k", "leaf", "norm"]).select("leaf", "need", F.posexplode(F.split("norm", " ")).alias("i", "t"))
    firm = places.groupBy("leaf", "need", "i", "t").agg(F.count("*").alias("n")).filter(F.col("n") >= F.col("need") - 1e-9)
    firm = firm.groupBy("leaf").agg(F.collect_set(F.struct("i", "t")).alias("firm"))  # a place has at most lines / need of them
    tok = F.transform(F.split("norm", " "), lambda x, i: F.when(F.array_contains(F.col("firm"), F.struct(i.alias("i"), x.alias("t"))), x).otherwise(SLOT))
    m = e.join(firm, "leaf").withColumn("tok", tok)
    m = m.filter(F.size(F.filter("tok", lambda x: x != SLOT)) * 2 >= F.size("tok")).select("document_id", "k", "site", "line_no", "norm", "need", F.array_join("tok", " ").alias("template"))
    return m.join(_enough(m, "template"), ["site", "template"])


def _enough(m: DataFrame, what: str) -> DataFrame:
    """``site, <what>, n_docs`` of what enough documents have."""
    n = m.select("site", what, "need", "document_id", "k").distinct().groupBy("site", what, "need").agg(F.count("*").alias("n_docs"))
    return n.filter(F.col("n_docs") >= F.col("need") - 1e-9).drop("need")


def _repeated(docs: DataFrame, doc: str, text: str, url: str, min_docs: int, min_share: float) -> DataFrame:
    c = cut(_candidates(docs, doc, text, url, min_docs, min_share).drop("n_docs"))
    return c.join(_enough(c, "norm").drop("n_docs"), ["site", "norm"])


def repeated_lines(
    docs: DataFrame, doc: str = "document_id", text: str = "text", url: str = "metadata.url", min_docs: int = 5, min_share: float = 0.1
) -> DataFrame:
    """``document_id, line_no``: every occurrence of a line that stands in at least ``min_docs`` documents and at least
    ``min_share`` of all documents of its site.

    Rows repeated in full count once. Documents without url belong to no site and give no rows; null and empty texts
    count as documents of their site. Lines without a letter never count. An empty table gives no rows.
    """
    return _repeated(docs, doc, text, url, min_docs, min_share).select("document_id", "line_no").distinct()


def templates(docs: DataFrame, doc: str = "document_id", text: str = "text", url: str = "metadata.url", min_docs: int = 5, min_share: float = 0.1) -> DataFrame:
    """``site, template, n_docs``: the templates that enough documents of their site have, with ``<*>`` for their slots."""
    return _candidates(docs, doc, text, url, min_docs, min_share).select("site", "template", "n_docs").distinct()


def without_repeated(
    docs: DataFrame, doc: str = "document_id", text: str = "text", url: str = "metadata.url", min_docs: int = 5, min_share: float = 0.1, whole_templates: bool = False
) -> DataFrame:
    """``document_id, text, n_removed``: each distinct document row with its repeated lines taken out.

    With ``whole_templates`` every line of a repeated template goes, so bylines and notices whose names or numbers change; without it the lines of
    ``repeated_lines``. Texts without such lines, null texts and documents without url come back unchanged with n_removed 0.
    """
    gone = _candidates(docs, doc, text, url, min_docs, min_share) if whole_templates else _repeated(docs, doc, text, url, min_docs, min_share)
    gone = gone.groupBy("document_id", "k").agg(F.collect_set("line_no").alias("gone"))  # a document's own lines
    d = docs.select(F.col(doc).cast("string").alias("document_id"), F.col(text).alias("text"), row_key(docs).alias("k")).distinct()
    j = d.join(gone, ["document_id", "k"], "left")
    left = F.filter(lines_of("text"), lambda x, i: ~F.array_contains(F.col("gone"), (i + 1).cast("bigint")))
    return j.select("document_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n")).alias("text"), F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"))
