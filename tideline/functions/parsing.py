"""Lenient conversions for ingested text: a bad value becomes NULL instead of an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text format of sequence columns in the customer change feed.
CHANGE_TIME_FORMAT = "MM-dd-yyyy HH:mm:ss"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def epoch_timestamp(value: Column | str) -> Column:
    """Epoch seconds, as number or text, to TIMESTAMP."""
    return F.timestamp_seconds(as_column(value).try_cast("bigint"))


def change_time(value: Column | str) -> Column:
    """Sequence text to TIMESTAMP, so that order holds across years."""
    return F.try_to_timestamp(as_column(value), F.lit(CHANGE_TIME_FORMAT))


def merge_levels(value: Column | str, level: str, into: str) -> Column:
    """Map one category level onto another and trim the result."""
    return F.trim(F.regexp_replace(as_column(value), level, into))


def json_path(document: Column | str, path: str) -> Column:
    """Value at a dotted ``path`` of a JSON string, as text."""
    return F.get_json_object(as_column(document), f"$.{path}")


def json_number(document: Column | str, path: str) -> Column:
    """Number at a dotted ``path`` of a JSON string, NULL when absent or not numeric."""
    return json_path(document, path).try_cast("double")


def version_key(version: Column | str) -> Column:
    """Sortable form of a dotted version: its leading numbers, left to right."""
    numbers = F.regexp_extract_all(as_column(version), F.lit(r"(\d+)"), F.lit(1))
    return F.transform(numbers, lambda part: part.try_cast("bigint"))
