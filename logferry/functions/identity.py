"""What makes two records the same record.

Key and value are opaque bytes and null differs from empty. Headers are an ordered list in which
keys may repeat and values may be null. A missing timestamp stays missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logferry.schemas import RECORD_COLUMNS

_HEADERS_TYPE = "array<struct<key:string,value:binary>>"


def normalize(df: DataFrame, position: str = "offset") -> DataFrame:
    """Canonical column order, with absent headers as an empty list."""
    headers = F.coalesce(F.col("headers"), F.array().cast(_HEADERS_TYPE)).alias("headers")
    return df.select("partition", position, *RECORD_COLUMNS[:-1], headers)


def bytes_text(value: Column) -> Column:
    """``length:HEX`` of a binary column, ``-`` for null."""
    return F.coalesce(
        F.concat(F.octet_length(value).cast("string"), F.lit(":"), F.hex(value)), F.lit("-")
    )


def headers_text(headers: Column) -> Column:
    """``n[key=value,...]`` with every key and value as ``length:HEX``."""
    pairs = F.transform(
        headers,
        lambda h: F.concat(bytes_text(h["key"].cast("binary")), F.lit("="), bytes_text(h["value"])),
    )
    return F.concat(
        F.size(headers).cast("string"), F.lit("["), F.array_join(pairs, ","), F.lit("]")
    )


def record_digest() -> Column:
    """SHA-256 over an encoding that no two different records share.

    A text prefix states the timestamp, the two byte lengths (``-`` for null) and the headers; it
    ends at its only ``]``. The raw key and value bytes follow, so payloads are never inflated to
    hex.
    """
    prefix = F.concat_ws(
        "|",
        F.coalesce(F.col("timestamp_ms").cast("string"), F.lit("-")),
        F.coalesce(F.octet_length("key").cast("string"), F.lit("-")),
        F.coalesce(F.octet_length("value").cast("string"), F.lit("-")),
        headers_text(F.col("headers")),
    )
    empty = F.lit(b"")
    encoded = F.concat(
        prefix.cast("binary"), F.coalesce("key", empty), F.coalesce("value", empty)
    )
    return F.sha2(encoded, 256)


def with_digest(df: DataFrame) -> DataFrame:
    return df.withColumn("record_digest", record_digest())
