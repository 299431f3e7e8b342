"""JSON and word-match expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
_GAP = r"[^\p{L}\p{M}\p{N}_]"


def record_json(df: DataFrame) -> Column:
    """All columns of ``df`` as one JSON text."""
    return F.to_json(F.struct(*df.columns), {"timestampFormat": TIME_FORMAT})


def open_json(df: DataFrame, value: str, layout: str | T.StructType, **options: str) -> DataFrame:
    """Add the fields of the JSON text in ``value`` as columns.

    The parse sits in a generator, which filters on its fields cannot be pushed through: without it the
    optimizer repeats the parse in every such filter.
    """
    parsed = F.from_json(value, layout, {"mode": "PERMISSIVE", **options})
    return df.select("*", F.inline(F.array(parsed)))


def typed_rows(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Typed columns of the JSON records in ``value``, beside the columns of ``df`` they do not hide.

    Absent or unreadable fields are null; numbers may be quoted.
    """
    carried = [c for c in df.columns if c != value and c not in schema.fieldNames()]
    layout = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    opened = open_json(df.select(value, *carried), value, layout)
    return opened.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema], *carried)


def has_word(text: Column, word: str) -> Column:
    """Whether ``word`` occurs in ``text`` as a whole word, ignoring case."""
    return F.lower(text).rlike(f"(^|{_GAP}){re.escape(word.lower())}($|{_GAP})")
