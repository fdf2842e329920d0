"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WS = r"(?U)[\s\x1c-\x1f]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(df: DataFrame) -> Column:
    """64-bit hash of the whole row, so that fully repeated rows can be told from rows that share an id."""
    cols: list[Column] = []
    for f in df.schema.fields:
        c = df[f.name.join("``")] if "." in f.name else df[f.name]
        hashable = isinstance(f.dataType, (T.AtomicType, T.ArrayType, T.StructType)) and "map<" not in f.dataType.simpleString()
        cols.append(c if hashable and "variant" not in f.dataType.simpleString() else F.to_json(F.struct(c)))
    return F.xxhash64(*cols)


def recorded_language(col: Column | str) -> Column:
    """Lower case, no outer blanks, cut before the first ``-`` or ``_``; NULL when nothing is left."""
    c = F.lower(F.trim(F.col(col) if isinstance(col, str) else col))
    c = F.regexp_extract(c, r"^([^-_]*)", 1)
    return F.when(F.length(c) > 0, c)


def valid_score(col: Column | str) -> Column:
    """True for a finite score from 0 to 5; False for NULL, NaN, infinities and anything outside."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.isNotNull() & ~F.isnan(c) & (c >= 0) & (c <= 5), F.lit(False))


def site_of(url: Column | str) -> Column:
    """Host of a url in lower case without user, port and leading ``www.``; NULL without one."""
    c = F.lower(F.trim(F.col(url) if isinstance(url, str) else url))
    host = F.regexp_extract(c, r"^(?:[a-z][a-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)
    host = F.when(host == "", F.regexp_extract(c, r"^([^/?#:@\s]+\.[^/?#:@\s]+)", 1)).otherwise(host)
    host = F.regexp_replace(host, r"^www\.", "")
    return F.when(F.length(host) > 0, host)


def words_of(text: Column | str) -> Column:
    """Words separated by (Unicode) white space; empty array for NULL or blank texts."""
    c = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(c, F.lit("")), WS), lambda x: x != "")


def lines_of(text: Column | str) -> Column:
    """The pieces between line feeds, empty ones kept."""
    c = F.col(text) if isinstance(text, str) else text
    return F.split(c, "\n", -1)


def hash_order(seed: int, col: Column | str) -> Column:
    """A seeded pseudo-random order of ids that any SQL engine can repeat."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).cast("string")))
