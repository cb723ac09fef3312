"""One text form per value, shared by payloads, bronze columns and hashes.

Batch loads read typed lake columns, stream loads read text out of a payload.
Both must hash alike, so every value is first brought to the text it has inside
a change payload:

* integers, strings, booleans: plain text;
* doubles and floats: shortest digits that round-trip, positional from 1e-4 up
  to 1e16, otherwise ``d.ddde+XX``; NaN counts as missing (above 1e17 an old
  JVM's last digit may differ from other engines', alike on every load);
* timestamps: ``YYYY-MM-DD HH:MM:SS`` in UTC plus six fraction digits if there are any;
* nested values: JSON.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH_SEPARATOR = "||"


def _wide_double_text(c: Column) -> Column:
    """Text of the values the JVM prints with an exponent."""
    size = F.abs(c)
    # Some JVMs print a digit too many, so take the fewest that read back equal.
    short, medium, full = [F.format_string(f"%.{n}e", c) for n in (14, 15, 16)]
    digits = (
        F.when(short.cast("double") == c, short)
        .when(medium.cast("double") == c, medium)
        .otherwise(full)
    )
    # As a decimal the same digits are spelled out.
    positional = F.regexp_replace(
        digits.cast("decimal(38,21)").cast("string"), r"(\.\d+?)0*$", "$1"
    )
    scientific = F.regexp_replace(digits, r"\.?0*e", "e")
    return (
        F.when((size >= 1e-4) & (size < 1e16), positional)
        .when(size == float("inf"), c.cast("string"))
        .otherwise(scientific)
    )


def _double_text(c: Column) -> Column:
    # The range check is numeric, so the costly number-to-text step runs once per
    # value. The wide form sits behind a one-element transform: ordinary data
    # never enters it, and its code stays out of the per-row method, which
    # otherwise outgrows the JIT's size limit on tables with many doubles.
    size = F.abs(c)
    ordinary = ((size >= 1e-3) & (size < 1e7)) | (c == 0)
    wide = F.transform(F.array(c), _wide_double_text)[0]
    missing = c.isNull() | F.isnan(c)
    return F.when(ordinary, c.cast("string")).when(~missing, wide)


def utc_literal(value: dt.datetime) -> Column:
    """A timestamp literal; a time without zone is UTC, wherever the driver runs."""
    aware = value if value.tzinfo else value.replace(tzinfo=dt.timezone.utc)
    return F.lit(aware).cast("timestamp")


def utc_wall_time(c: Column, data_type: T.DataType) -> Column:
    """A timestamp's date and time in UTC, as TIMESTAMP_NTZ, whatever the session's zone."""
    if isinstance(data_type, T.TimestampNTZType):
        return c
    # Added to the epoch: a way through local time would be ambiguous when clocks go back.
    seconds = (F.unix_micros(c).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds)


def _timestamp_text(c: Column, data_type: T.DataType) -> Column:
    text = utc_wall_time(c, data_type).cast("string")
    return F.when(~text.contains("."), text).otherwise(
        F.concat(
            F.substring_index(text, ".", 1),
            F.lit("."),
            F.rpad(F.substring_index(text, ".", -1), 6, "0"),
        )
    )


def canonical_text(c: Column, data_type: T.DataType) -> Column:
    """The text of a value of ``data_type`` as a change payload carries it."""
    if isinstance(data_type, T.StringType):
        return c
    if isinstance(data_type, T.DoubleType):
        return _double_text(c)
    if isinstance(data_type, T.FloatType):
        # Widening through text keeps the float's own shortest digits.
        return _double_text(c.cast("string").cast("double"))
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return _timestamp_text(c, data_type)
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(c)
    if isinstance(data_type, T.BinaryType):
        return F.base64(c)
    return c.cast("string")


def iso_utc(c: Column, data_type: T.DataType) -> Column:
    """ISO-8601 with offset for the change column; other types as canonical text."""
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.concat(F.replace(_timestamp_text(c, data_type), F.lit(" "), F.lit("T")), F.lit("+00:00"))
    return canonical_text(c, data_type)


def canonical_columns(df: DataFrame, names: list[str]) -> list[Column]:
    """Canonical text of the named columns, keeping their names."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return [canonical_text(F.col(f"`{n}`"), types[n]).alias(n) for n in names]


def to_text_frame(df: DataFrame) -> DataFrame:
    """Every column as canonical text: what bronze stores for a lake table."""
    return df.select(*canonical_columns(df, df.columns))


def hashdiff(df: DataFrame, attributes: list[str]) -> Column:
    """SHA-256 over the attributes' canonical text, missing values as ''.

    NULL and '' hash alike, and a value holding the separator may collide with
    its neighbour; both are part of the hash's definition. No attributes give
    the constant hash of the empty string.
    """
    if not attributes:
        return F.sha2(F.lit("").cast("binary"), 256)
    parts = [F.coalesce(c, F.lit("")) for c in canonical_columns(df, attributes)]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *parts).cast("binary"), 256)


def timestamps_as_text(df: DataFrame) -> DataFrame:
    """Show timestamp columns in canonical text, leave the rest as is."""
    return df.select(
        *[
            canonical_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name)
            if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
