"""Helpers shared by the registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from docloom import lexicon
from docloom.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def load(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def dealt(df: DataFrame) -> DataFrame:
    """A row group is one task at least, so a table with fewer pieces than there are cores is dealt to all of them."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def docs(spark: SparkSession, sf: str) -> DataFrame:
    """The documents, dealt to all cores."""
    return dealt(load(spark, sf, "documents"))


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with their quality and toxicity labels, NULL where there are none."""
    return docs(spark, sf).select("doc_id", "text", "lang").join(load(spark, sf, "labels"), "doc_id", "left")


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles and widen integers, so that both engines print the same values."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), digits) + F.lit(0.0)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("long")
        out.append(c.alias(f.name))
    return df.select(*out)


def workspace(spark: SparkSession, name: str) -> str:
    """Folder of a query that writes, in the shared folder of the session."""
    return f"{shared_folder(spark).rstrip('/')}/docloom/{spark.sparkContext.applicationId}/{name}"


# ---- SQL fragments -------------------------------------------------------------------------

def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(items) -> str:
    return ", ".join(lit(i) for i in items)


def r(expr: str, digits: int = 6) -> str:
    return f"round(CAST({expr} AS DOUBLE), {digits}) + 0.0"


STOP = in_list(lexicon.STOPWORDS)
WORDS = r"list_filter(string_split_regex({0}, '\s+'), lambda w: w <> '')"
VOCAB_TOKENS = (r"list_filter(string_split_regex(regexp_replace(lower(text), '[^a-zA-Z\s]', '', 'g'), '\s+'), "
                f"lambda w: length(w) > 1 AND w NOT IN ({STOP}))")
WORD_TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
PLAIN_TOKENS = (r"list_filter(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'), "
                f"lambda w: regexp_matches(w, '^[a-z]+$') AND w NOT IN ({STOP}))")
NGRAM_TEXT = r"trim(regexp_replace(regexp_replace(lower(text), '[^a-zA-Z\s]', ' ', 'g'), '\s+', ' ', 'g'))"
SQUEEZED = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"
SENTENCES = r"list_filter(string_split_regex(text, '[.!?]+(\s+|$)'), lambda s: regexp_matches(s, '\S'))"


def words_of(expr: str) -> str:
    return WORDS.format(expr)


def flags_sql(rules: dict[str, str], text: str) -> str:
    return ", ".join(f"CAST(regexp_matches({text}, {lit(p)}) AS BIGINT) AS {n}" for n, p in rules.items())


def count_sql(expr: str, pattern: str) -> str:
    return f"len(regexp_extract_all({expr}, {lit(pattern)}))"
