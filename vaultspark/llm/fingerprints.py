"""Operator 8, document fingerprints: threshold-scaled sketches.

A sketch keeps every shingle hash in the lowest ``SHARE`` of the hash range, whatever
the text: no minimum, no maximum. So sketches of texts of any lengths are samples by
the same rule; they are compared as they are, and the sketch of a union is the union
of sketches. A shingle is five words (lower case); a text of fewer words is one
shingle, a text without words has none.

With ``n`` distinct shingles in both texts, the likeness ``J`` has a standard error of
about ``sqrt(J (1 - J) / n * (1 - SHARE) / SHARE)``: at seven eighths at most 0.19 over
``sqrt(n)``, so 0.04 for 25 shingles and 0.01 for 400. Containment is the same with the
shingles of the contained text as ``n``. A single-shingle text has an empty sketch with
probability ``1 - SHARE``. A smaller share gives smaller sketches and a larger error.

A text's words and hashes are arrays of its row while it is sketched, some 100 bytes a
word: what a task holds grows with the longest text, not with the table.

Built-in functions only. The next document of each is found without a global
sort: ids are binned over their range, adjacent bins are merged into buckets of
about ``BUCKET_ROWS`` rows, every bucket also gets the first document of the next
one, and a window looks ahead within each bucket. The only driver data are the
counts of at most ``MAX_BINS`` bins.

Defined cases: a null text counts as empty; a null id sorts before all ids;
repeated ids follow each other in the order of their texts; the document after
the last is the first, so a single one follows itself. Likeness of two empty
sketches is 1, of an empty and another one 0; an empty sketch is contained in all.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, query

SHINGLE = 5
SHARE = 7 / 8
BUCKET_ROWS = 1000
MAX_BINS = 65_536


def sketch(text: Column, share: float = SHARE) -> Column:
    """Sorted ``array<long>`` of the shingle hashes that stay."""
    words = F.split(F.btrim(F.lower(text), F.lit(" \t\n\u000b\f\r")), r"[\x20\x09-\x0D]+")
    last = int(share * (1 << 64)) - (1 << 63) - 1

    def hashes(w: Column) -> Column:
        several = F.transform(
            F.sequence(F.lit(0), F.size(w) - SHINGLE),
            lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(SHINGLE))))
        one = F.array(F.xxhash64(F.array_join(w, " ")))
        none = F.array().cast("array<long>")
        return F.when(F.size(w) >= SHINGLE, several).when(F.get(w, F.lit(0)) == "", none).otherwise(one)

    # A one-element array binds the words to a name: they are split once.
    bound = F.get(F.transform(F.array(words), hashes), F.lit(0))
    return F.sort_array(F.array_distinct(F.filter(bound, lambda h: h <= last)))


def _of_common(a: Column, b: Column, by: Callable[[Column], Column]) -> Column:
    """``by`` of the number of hashes that both sketches have, counted once."""
    return F.get(F.transform(F.array(F.size(F.array_intersect(a, b))), by), F.lit(0))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the shingle sets behind two sketches of one share."""
    either = F.size(a) + F.size(b)
    return F.when(either == 0, 1.0).otherwise(_of_common(a, b, lambda both: both / (either - both)))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has."""
    return F.when(F.size(a) == 0, 1.0).otherwise(_of_common(a, b, lambda both: both / F.size(a)))


def merge_sketches(df: DataFrame, group_col: str, sketch_col: str = "sketch") -> DataFrame:
    """Merged sketches as rows ``group_col, hash``; a group of any size stays spread out."""
    return df.select(F.col(group_col), F.explode(sketch_col).alias("hash")).distinct()


def printed(a: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits a hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Window]:
    """Rows with ``next_text``, and the window in which rows of ascending id follow each other.

    Rows carry ``guest``: true for the copies that only close a bucket; drop them last.
    """
    ids = df.select(F.col(id_col).alias("id"))
    n, lo, hi = ids.agg(F.count("*"), F.min("id"), F.max("id")).first()
    lo, hi = (0, 0) if lo is None else (lo, hi)
    n_bins = min(MAX_BINS, 8 * max(1, -(-n // BUCKET_ROWS)))
    step = (hi - lo) // n_bins + 1
    # Ids may span more than a long holds: differences are taken as decimals.
    wide = F.col("id").cast("decimal(38,0)") - F.lit(lo).cast("decimal(38,0)")
    bin_of = F.coalesce(F.call_function("div", wide, F.lit(step).cast("decimal(38,0)")).cast("int"), F.lit(0))
    bins = ids.groupBy(bin_of.alias("bin")).agg(
        F.count("*").alias("n"), F.min("id").alias("first"), F.bool_or(F.col("id").isNull()).alias("nulls"))
    bucket_of, firsts, filled = [0] * n_bins, [], BUCKET_ROWS
    for r in sorted(bins.collect(), key=lambda r: r["bin"]):
        if filled >= BUCKET_ROWS:
            firsts.append(None if r["nulls"] else r["first"])
            filled = 0
        filled += r["n"]
        bucket_of[r["bin"]] = len(firsts) - 1

    slim = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    placed = slim.select("*", F.get(F.lit(bucket_of), bin_of).alias("bucket"), F.lit(False).alias("guest"))
    # The first document of bucket b closes bucket b - 1, that of the first the last.
    first_ids = df.sparkSession.createDataFrame(
        [(x, (b - 1) % len(firsts)) for b, x in enumerate(firsts)], "first long, bucket int")
    guests = (
        slim.join(F.broadcast(first_ids), F.col("id").eqNullSafe(F.col("first")))
        .groupBy("id", "bucket").agg(F.min("text").alias("text"))
        .select("id", "text", "bucket", F.lit(True).alias("guest"))
    )
    order = Window.partitionBy("bucket").orderBy("guest", F.asc_nulls_first("id"), "text")
    return placed.unionByName(guests).select("*", F.lead("text").over(order).alias("next_text")), order


@query("op8_fingerprints")
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs, order = with_next(documents(spark, sf_dir))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.length("text") - half),
        F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    sketched = pairs.select(
        "bucket", "guest", "id", "text", F.length("text").cast("long").alias("n_chars"), edited.alias("edited"),
    ).select(
        "bucket", "guest", "id", "text", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        sketch(F.col("text")).alias("a"),
        F.when(~F.col("guest"), sketch(F.col("edited"))).alias("b"),
    ).select("*", F.lead("a").over(order).alias("c"))
    return sketched.where("not guest").select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256",
        printed(F.col("a")).alias("fingerprint"), printed(F.col("b")).alias("edited_fingerprint"),
        likeness(F.col("a"), F.col("b")).alias("near_edited"), likeness(F.col("a"), F.col("c")).alias("near_next"),
        containment(F.col("a"), F.col("b")).alias("contained_edited"),
        containment(F.col("a"), F.col("c")).alias("contained_next"),
    )
