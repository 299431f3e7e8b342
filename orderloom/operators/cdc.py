"""Change events: unwrap the two envelope kinds, drop snapshot markers, route by table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.text import open_json, typed_rows
from orderloom.schemas import SOURCE_TABLES

# Event types that only mark the start and the end of a snapshot.
SNAPSHOT_MARKERS = ("bootstrap-start", "bootstrap-complete")
TOPIC_PREFIX = "ODS_"

_CORRUPT = "_corrupt_record"
_ENVELOPE = f"`table` string, type string, data string, {_CORRUPT} string"


def _opened(messages: DataFrame) -> DataFrame:
    """Add the envelope fields; one parse per message, the payload stays text."""
    return open_json(messages, "value", _ENVELOPE, columnNameOfCorruptRecord=_CORRUPT)


def _readable() -> Column:
    return F.col(_CORRUPT).isNull() & F.col("table").isNotNull() & F.col("data").isNotNull()


def _wanted() -> Column:
    return F.col("type").isNull() | ~F.col("type").isin(*SNAPSHOT_MARKERS)


def _carried(messages: DataFrame) -> list[str]:
    return [c for c in messages.columns if c not in ("key", "value", "topic")]


def unwrap_object(messages: DataFrame) -> DataFrame:
    """Envelope with an object payload: one row per message, ``value`` becomes the payload."""
    rows = _opened(messages).where(_readable() & _wanted() & _single())
    return rows.select("table", "type", F.col("data").alias("value"), *_carried(messages))


def _elements() -> Column:
    return F.from_json("data", "array<string>")


def _bracketed() -> Column:
    return F.startswith(F.ltrim("data"), F.lit("["))


def _objects(elements: Column) -> Column:
    """Whether all elements of a payload are objects; so are those of an empty array."""
    return F.coalesce(F.forall(elements, lambda e: e.isNotNull() & F.startswith(F.ltrim(e), F.lit("{"))), F.lit(False))


def _single() -> Column:
    """Whether the payload is an object."""
    return F.startswith(F.ltrim("data"), F.lit("{"))


def unwrap_array(messages: DataFrame) -> DataFrame:
    """Envelope with an array payload: one row per element, none for an empty array. The payload is parsed once, in a generator like
    the envelope: the filter and the explode read the parsed column."""
    rows = _opened(messages).where(_readable() & _wanted() & _bracketed())
    parsed = rows.select("*", F.inline(F.array(F.struct(_elements().alias("_elements")))))
    parsed = parsed.where(_objects(F.col("_elements")))
    return parsed.select("table", "type", F.explode("_elements").alias("value"), *_carried(messages))


def rejects(messages: DataFrame, envelope: str = "object") -> DataFrame:
    """Messages the reader of this envelope kind cannot use, kept as they came. Snapshot markers carry no row
    and are dropped, not rejected."""
    usable = _readable() & (_bracketed() & _objects(_elements()) if envelope == "array" else _single())
    return _opened(messages).where(~F.coalesce(usable, F.lit(False)) & _wanted()).select(*messages.columns)


def route(rows: DataFrame, prefix: str = TOPIC_PREFIX) -> DataFrame:
    """Name the topic of each row after its table."""
    return rows.withColumn("topic", F.concat(F.lit(prefix), F.upper("table")))


def table_rows(rows: DataFrame, table: str) -> DataFrame:
    """The typed rows of one table. ``type`` and any message position stay beside them."""
    wanted = rows.where(F.upper("table") == table.upper())
    return typed_rows(wanted.drop("table", "topic", "key"), SOURCE_TABLES[table])
