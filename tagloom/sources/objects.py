"""Question records: written back to back as Python literals, as a JSON
items document, and the chart feed array."""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.sources.scan import JSON_QUOTES, LITERAL_QUOTES, scan_objects

QUESTION_SCHEMA = T.StructType([
    T.StructField("links", T.StringType()),
    T.StructField("views", T.StringType()),
    T.StructField("votes", T.ArrayType(T.StringType())),
    T.StructField("answers", T.ArrayType(T.StringType())),
    T.StructField("questions", T.ArrayType(T.StringType())),
    T.StructField("tags", T.ArrayType(T.StringType())),
])

_STR_FIELDS = ("links", "views")
_LIST_FIELDS = ("votes", "answers", "questions", "tags")

def _as_list(v):
    if v is None:
        return None
    if isinstance(v, (list, tuple)):
        return [None if x is None else str(x) for x in v]
    return [str(v)]


_PARSED_SCHEMA = T.StructType(QUESTION_SCHEMA.fields + [T.StructField("_ok", T.BooleanType())])


@F.pandas_udf(_PARSED_SCHEMA)
def _literal_records(chunks: pd.Series) -> pd.DataFrame:
    """Evaluate each record text as a Python literal (a small per-row helper)."""
    out = {k: [] for k in _STR_FIELDS + _LIST_FIELDS + ("_ok",)}
    for s in chunks:
        try:
            d = ast.literal_eval(s)
            if not isinstance(d, dict):
                raise ValueError
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            d = None
        out["_ok"].append(d is not None)
        for k in _STR_FIELDS:
            v = None if d is None else d.get(k)
            out[k].append(None if v is None else str(v))
        for k in _LIST_FIELDS:
            out[k].append(None if d is None else _as_list(d.get(k)))
    return pd.DataFrame(out)


def parse_literals(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``record``: the struct that a Python literal holds (null if it
    cannot be read)."""
    parsed = texts.withColumn("_p", _literal_records(text_col))
    rec = F.struct(*[F.col(f"_p.{f.name}").alias(f.name) for f in QUESTION_SCHEMA.fields])
    return parsed.withColumn("record", F.when(F.col("_p._ok"), rec)).drop("_p")


def read_concat_objects(spark: SparkSession, path: str) -> DataFrame:
    """Records written back to back as Python-literal dicts.

    Borders are found by the quote-aware scan, in parallel over the splits
    of each file: strings may hold ``}{`` and records may be wrapped or
    apart by blanks. Rows: ``text`` (record text), ``record`` (struct, null
    if it cannot be read; a file's unfinished end too), ``file``, and
    ``block, id``, their order in the file.
    """
    found = scan_objects(spark, path, LITERAL_QUOTES)
    texts = found.withColumn("text", F.regexp_replace("text", r"^\s+|\s+$", "")).filter("text != ''")
    return parse_literals(texts).select("text", "record", "file", "block", "id")


# An element's text begins after the wrapper's ``{"items": [`` or a comma;
# what follows the last one closes list and wrapper.
_WRAPPER = r'(?s)^\s*\{\s*"(?:[^"\\]|\\.)*"\s*:\s*\[\s*'
_COMMA = r"^\s*,\s*"
_CLOSING = r"(^|\[)\s*\]\s*\}?\s*$"


def read_items_json(spark: SparkSession, path: str) -> DataFrame:
    """``{"items": [question, ...]}`` document(s) -> one row per question.

    A document of any size is read by as many tasks as it has splits: the
    elements' borders come from the quote-aware scan, one level deep."""
    found = scan_objects(spark, path, JSON_QUOTES, level=1)
    texts = found.filter(F.col("whole") | ~F.col("text").rlike(_CLOSING))
    text = F.when(F.col("text").rlike(_COMMA), F.regexp_replace("text", _COMMA, "")).otherwise(
        F.regexp_replace("text", _WRAPPER, ""))
    return texts.select(F.from_json(text, QUESTION_SCHEMA).alias("q")).select("q.*")


def read_chart_json(spark: SparkSession, path: str) -> DataFrame:
    """``[{"name":..,"count":..}, ...]`` -> ``(name, count)`` rows."""
    schema = T.StructType([T.StructField("name", T.StringType()),
                           T.StructField("count", T.LongType())])
    return spark.read.schema(schema).option("multiLine", "true").json(path).select("name", "count")


def question_tags(questions: DataFrame, keep: list | None = None) -> DataFrame:
    """Only the ``tags`` of each question, one row per tag with its position."""
    keep = keep or []
    return questions.select(*keep, F.posexplode("tags").alias("pos", "tag"))


def typed_questions(questions: DataFrame) -> DataFrame:
    """``views`` as BIGINT (thousands commas dropped), ``links`` kept as text."""
    return questions.withColumn(
        "views", F.expr("try_cast(replace(views, ',', '') as bigint)"))
