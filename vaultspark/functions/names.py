"""Naming rules: identities, key tokens, singular forms, bronze types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: they decide names and keys, so they must not drift. -------
KEY_TOKENS = ["id", "nr", "key", "number", "code"]
TECHNICAL_COLUMNS = ["modified_at", "__ingested_at", "__record_source"]
BRONZE_AUDIT_COLUMNS = ["__ingested_at", "__record_source"]
MODEL_AUDIT_COLUMNS = [
    "load_datetime", "created_at", "modified_at", "record_source",
    "__ingested_at", "__record_source",
]
NEUTRAL_TABLE_TOKENS = ["dg", "e2e"]
COMMON_KEY_NAMES = [
    "id", "customerid", "customer_id", "accountid", "account_id", "orderid", "order_id",
]
RDBMS_NAME_LIMIT = 63
BRONZE_TYPES = {
    "string": "STRING",
    "int": "INT",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "date": "DATE",
}
# ----------------------------------------------------------------------------


def normalize_name(c: Column) -> Column:
    """Lower-case letters and digits only."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def singularize(c: Column) -> Column:
    """``ies`` becomes ``y``; one trailing ``s`` goes, ``ss`` stays."""
    low = F.lower(c)
    return (
        F.when(low.endswith("ies"), F.regexp_replace(low, "ies$", "y"))
        .when(low.endswith("s") & ~low.endswith("ss"), F.regexp_replace(low, "s$", ""))
        .otherwise(low)
    )


def strip_key_suffix(c: Column) -> Column:
    """Drop the first key token that ends the name, with its underscore if any."""
    low = F.lower(c)
    result = None
    for token in KEY_TOKENS:
        ends = low.endswith(token)
        stripped = F.regexp_replace(low, f"_?{token}$", "")
        result = F.when(ends, stripped) if result is None else result.when(ends, stripped)
    return result.otherwise(low)


def is_key_candidate(c: Column) -> Column:
    """A key token occurs anywhere in the name (so ``width`` counts, by ``id``)."""
    return F.lower(c).rlike("|".join(KEY_TOKENS))


def sanitize_name(c: Column) -> Column:
    """Drop the qualifier before the first dot and outer quotes; ``.``/``-`` to ``_``."""
    raw = F.trim(c)
    # Without a dot its position is 0, and the text is kept from the start.
    unqualified = F.substr(raw, F.instr(raw, ".") + 1)
    return F.coalesce(F.translate(F.trim(unqualified, F.lit('"')), ".-", "__"), F.lit(""))


def physical_name(c: Column, lake_type: str = "parquet") -> Column:
    """Storage name of a logical table: cut for a database, lower-cased for files."""
    clean = sanitize_name(c)
    if lake_type == "rdbms":
        return F.substring(clean, 1, RDBMS_NAME_LIMIT)
    return F.lower(clean)


def bronze_type(c: Column) -> Column:
    """SQL type a bronze column takes for a Spark type name; unknown ones are STRING."""
    mapping = F.create_map(*[F.lit(x) for pair in BRONZE_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(mapping, F.lower(c)), F.lit("STRING"))


def model_version(c: Column) -> Column:
    """The N of a ``_vN`` ending, else 0."""
    digits = F.regexp_extract(c, r"_v(\d+)$", 1)
    return F.coalesce(digits.try_cast("int"), F.lit(0))


def versioned(base: Column, number: Column) -> Column:
    """``base_vN``."""
    return F.concat(base, F.lit("_v"), number.cast("string"))
