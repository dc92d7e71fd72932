"""A corpus pipeline: documents in, packed training sequences out.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and
returns the documents it keeps, with their columns, and the last one the packed
pieces.  ``run`` applies them to the ``documents`` table and writes each stage's result
as Parquet into the shared folder before the next one reads it.

Edge cases: null texts are rejected by the first stage; rows of one doc_id with
different texts are documents of their own; an empty table gives no pieces; further
columns travel along unchanged.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playlab.llm import jaccard, language, packing, secrets, substring
from playlab.llm.common import bound_batches, table
from playlab.llm.queries import piece_digests, tokenizer_file
from playlab.session import write_stage

MIN_LANGUAGE_SCORE = 0.4  # below it no learned language is likely


OWN = ("doc_id", "text", "lang", "source", "n_chars")


def _apart(stage):
    """Runs a stage with the further columns under names that no operator uses, and names them back."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = docs.columns
        inner = [c if c in OWN else f"__further{i}" for i, c in enumerate(names)]
        return stage(spark, docs.toDF(*inner), sf_dir).toDF(*names)

    return run_stage


def _with_text(docs: DataFrame, columns: list[str], text: Column) -> DataFrame:
    """The documents with a new text, and their character count where they have one."""
    docs = docs.withColumn("text", text)
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return docs.select(*[F.col(f"`{c}`") for c in columns])


@_apart
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; ``lang`` becomes the language found."""
    bound_batches(spark)
    model = language.train(docs.where(~language.held_out()))
    found = language.identify(docs, model).where((F.col("lang_pred") != language.UNKNOWN)
                                                 & (F.col("lang_score") >= MIN_LANGUAGE_SCORE))
    return found.withColumn("lang", F.col("lang_pred")).select(*[F.col(f"`{c}`") for c in docs.columns])


@_apart
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (Jaccard 0.8 on five-word shingles)."""
    found = jaccard.jaccard_groups(docs, threshold=jaccard.Fraction(8, 10), shingle=5, one_per_group=True)
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])


@_apart
def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 20 or more words that occur earlier; other texts as they were."""
    found = substring.deduplicate(docs)
    return _with_text(found, docs.columns, F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text")))


@_apart
def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with their secrets masked."""
    found = secrets.scan(docs, secrets.train(docs))
    return _with_text(found, docs.columns, F.col("clean"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences, every source in its share of the tokens."""
    return piece_digests(packing.pack(docs, tokenizer_file("word_bpe_49k.json")))


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", drop_repeated_passages),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # a learned model decides in two stages: tests compare with brute force instead


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
