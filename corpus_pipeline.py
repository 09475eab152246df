"""Clean and pack the corpus: stages that each call one operator of ``lossmill.llm``.

A stage's scratch tables are not needed once its result is written, and the next stage, which is
given the written table, drops them.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import wraps

import public_tokenizers
from lossmill.llm import decontaminate, packing, simhash, suffix_dedup, toxicity
from lossmill.llm.common import Scratch, free_name, stored, table
from lossmill.llm.queries import PASSAGE_WORDS, TOXIC_SCORE, toxic_lexicon
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

_earlier = threading.local()  # scratch tables of the stage before, by this thread


def _after(name: str | None) -> Callable[[Stage], Stage]:
    """Mark a stage as the one after ``name``: it drops what that one left, unless ``docs`` is read
    from there still."""

    def mark(stage: Stage) -> Stage:
        @wraps(stage)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            left = _earlier.__dict__
            if name in left:
                left.pop(name).drop(spark, docs.inputFiles())
            with Scratch() as own:
                result = stage(spark, docs, sf_dir)
            left[stage.__name__] = own
            return result

        return run_stage

    return mark


@_after(None)
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the lexicon is learned from labelled ones."""
    lexicon = toxic_lexicon(docs, table(spark, sf_dir, "labels"))
    found = free_name(docs, "toxicity")
    scored = toxicity.with_toxicity(docs, lexicon, into=found)
    return scored.where(F.col(f"{found}.score") < TOXIC_SCORE).select(docs.columns)


@_after("drop_toxic")
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: fingerprints of three-word shingles that differ
    in two bits at most, and what they lead to."""
    return simhash.one_of_each(docs, "doc_id", "text", simhash.SimHash(shingle=3, distance=2))


@_after("drop_near_duplicates")
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without passages that stand elsewhere too; ``n_chars`` follows the text.

    A passage has ``PASSAGE_WORDS`` words or more, whatever their bytes and the space between them.
    """
    into = free_name(docs, "repeats")
    found = suffix_dedup.with_repeats(
        docs,
        length=PASSAGE_WORDS * suffix_dedup.WORD_BYTES,
        into=into,
        coded=suffix_dedup.word_codes,
    )
    found = found.withColumn(into, suffix_dedup.word_spans(F.col(into), PASSAGE_WORDS))
    whole = F.size(into) == 0
    text = F.when(whole, F.col("text")).otherwise(
        suffix_dedup.kept_words(F.col("text"), F.col(into))
    )
    found = found.withColumn("text", text)
    n_chars = F.when(whole, F.col("n_chars")).otherwise(F.length("text"))
    kind = docs.schema["n_chars"].dataType
    return found.withColumn("n_chars", n_chars.cast(kind)).select(docs.columns)


@_after("cut_repeats")
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    benchmark = table(spark, sf_dir, "benchmark")
    into = free_name(docs, "hits")
    found = decontaminate.with_benchmark_hits(docs, benchmark, into=into)
    return found.where(F.size(f"{into}.starts") == 0).select(docs.columns)


@_after("drop_contaminated")
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the token sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("packing", pack),
]

#: SQL cannot express trained scores, fingerprints and packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents that stay. Each stage's result is written and read again; of
    the results only the last one, which the pieces are read from, is left in the end."""
    docs = table(spark, sf_dir, "documents")
    before = Scratch()
    for name, stage in STAGES[:-1]:
        result = stage(spark, docs, sf_dir)
        with Scratch() as own:
            docs = stored(result, f"pipeline-{name}")
        before.drop(spark)
        before = own
    return STAGES[-1][1](spark, docs, sf_dir)
