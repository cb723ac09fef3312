"""A training corpus in five stages, each by one operator of ``vaultspark.llm``.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and
returns a DataFrame, which is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of ``docs``, whatever they are; only
``text`` and ``n_chars`` change, by masking.

Defined cases: documents with a null or empty text pass every stage (their text
stays as it is) but count zero tokens; rows equal in id and text are one document;
rows of one id and different texts are judged one by one; a null id is an id like
others; empty tables give an empty result. Columns that are named like those the
last stage adds are replaced by them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultspark.llm import decontamination, ngram_join, pii, sentencepieces, toxicity
from vaultspark.llm.common import kept, prepare, read_columns


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores below its threshold."""
    prepare(spark)
    model = toxicity.learn(docs.select("doc_id", "text"), toxicity.labels_of(spark, sf_dir))
    scored = toxicity.score_texts(docs, model, score_col="__toxicity")
    return scored.where(F.col("__toxicity") < toxicity.THRESHOLD).drop("__toxicity")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: that of the smallest id."""
    prepare(spark)
    text = F.coalesce("text", F.lit(""))
    key = F.concat_ws(":", F.coalesce(F.lpad(F.col("doc_id").cast("string"), 20, "0"), F.lit("~")), F.hex(F.xxhash64(text)))
    keyed = docs.withColumn("__key", key)
    groups = ngram_join.near_duplicates(keyed.select("__key", "text"), id_col="__key")
    stays = groups.where("__key = component_id").select("__key").distinct()
    return keyed.join(stays, "__key", "left_semi").dropDuplicates(["__key"]).select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no passage of the benchmark is found."""
    prepare(spark)
    items = read_columns(spark, sf_dir, "benchmark", item_id="long", text="string")
    return decontamination.drop_contaminated(docs, items)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; personal data replaced by its kind in brackets."""
    prepare(spark)
    packed = docs.select(F.struct(*docs.columns).alias("row"), "text")
    found = pii.find_pii(packed, id_col="row")
    masked = found.select("row", pii.redacted(F.col("text"), F.col("spans")).alias("masked"))
    new = {"text": F.when(F.col("row.text").isNotNull(), F.col("masked"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("row.n_chars").isNotNull(), F.length("masked").cast(docs.schema["n_chars"].dataType))
    return masked.select(*(new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the ids of their pieces, and whether decoding gives the text back."""
    prepare(spark)
    return sentencepieces.encode_texts(docs, sentencepieces.model_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("personal_data", mask_personal_data),
    ("sentencepieces", encode),
]

# Learned scores and the transducer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other, over the whole table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
