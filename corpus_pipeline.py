"""A corpus through five operators, stage by stage: each reads what the one before it wrote."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

import public_tokenizers as tokenizers
from tessera.llm import bpe, decontaminate, langid, repeats, simhash
from tessera.llm.runtime import checkpoint_dir, prepare, text_key

#: A document whose nearest language profile is further than this goes: not prose in any known language.
MIN_SCORE = 0.25
_runs = itertools.count()


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language. Null texts, texts without a letter and scores below MIN_SCORE are rejected; ``lang`` stays as it was."""
    prepare(spark)
    profiles = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))))
    if not profiles:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    kept = docs.withColumn("__prediction", langid.predict(F.col("text"), profiles)).filter((F.col("__prediction.lang") != langid.UNKNOWN) & (F.col("__prediction.score") >= MIN_SCORE))
    return kept.drop("__prediction")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class: the one with the least doc_id (null last, equal ids by text hash; of equal rows one)."""
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), *text_key(F.col("text")))
    key = lambda s: F.concat_ws(":", f"{s}.id", f"{s}._ka", f"{s}._kb")
    found = simhash.near_duplicates(docs.select(place.alias("__place"), "text"), doc_id="__place")
    stay = found.filter("doc_id = component_id").select(key("doc_id").alias("__key")).distinct()
    keyed = docs.withColumn("__place", place).withColumn("__key", key("__place")).drop("__place").join(stay, "__key", "left_semi")
    # the semi-join has dealt the rows by this key already
    return keyed.withColumn("__n", F.row_number().over(W.partitionBy("__key").orderBy("__key"))).filter("__n = 1").select(*docs.columns)


def repeat_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated strings of ``repeats.PASSAGE`` bytes; ``n_chars`` follows, null texts stay null. All rows stay."""
    prepare(spark)
    others = F.struct(F.col("text").isNull().alias("__null"), *[c for c in docs.columns if c != "text"])
    found = repeats.with_runs(docs.select(others.alias("_o"), "text"), repeats.PASSAGE, doc_id="_o").withColumnRenamed("doc_id", "_o")
    # the length tells whether anything went: a cut text is never as long
    new = found.withColumn("_new", repeats.remainder()("text", "runs"))
    columns = {
        "text": F.when(~F.col("_o.__null"), F.col("_new")),
        "n_chars": F.when(F.char_length("_new") == F.char_length("text"), F.col("_o.n_chars")).otherwise(F.char_length("_new").cast("long")),
    }
    return new.select(*[columns.get(c, F.col(f"_o.`{c}`")).alias(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.with_leaks(docs, benchmark, out="__leaks").filter(F.size("__leaks") == 0).drop("__leaks")


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document that is left."""
    return bpe.encoded_digests(docs, tokenizers.path("byte_bpe_multi_50k.tiktoken"), tokenizers.PATTERN)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("suffix_array_dedup", repeat_dedup),
    ("benchmark_decontamination", decontamination),
    ("byte_level_bpe", encoding),
]

#: SQL can express neither the fingerprints nor the merges; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written as Parquet to the shared folder and read again, and goes when the next is written."""
    checkpoint_dir(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/pipeline-{next(_runs)}"
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            old = spark._jvm.org.apache.hadoop.fs.Path(before)
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
        before = f"{folder}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
