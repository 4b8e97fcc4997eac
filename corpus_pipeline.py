"""A corpus pipeline of five training-data operators.

``run(spark, sf_dir)`` applies the stages to ``documents``. A stage takes what
its predecessor kept, as written Parquet, and all but the last one return the
columns of ``documents``:

1. quality classifier: documents judged to be of low quality or toxic go,
2. SimHash near-dedup: one document of each class stays, the one with the
   smallest id (rows that repeat it count as one),
3. substring dedup: runs of 50 words or more that a smaller document has are cut
   out, with the white space after them; a document without a word left goes,
4. benchmark decontamination: documents with a verified test item go,
5. SentencePiece: the ids of the remaining texts, and whether they decode to
   the text again.

SQL cannot express the stages (a fitted classifier, XXH64 fingerprints, subword
pieces), so ``ORACLE_SQL`` is None; tests/llm checks each stage by brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import cotraining, decontaminate, sentencepiece_stream, simhash, suffix_trees
from starloom.llm.common import materialize, read_table

PIECES = "piece_bpe_32k.model"
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judges = cotraining.fit(docs, read_table(spark, sf_dir, "labels"))
    return cotraining.judge(docs, judges, keep=COLUMNS[1:]).filter("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.representatives(docs).select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rest = suffix_trees.remove_repeats(docs, keep=("lang", "source", "n_chars"), with_text=True).filter("n_removed = 0 or n_removed < n_words")
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("n_chars"))
    return rest.select("doc_id", F.col("kept").alias("text"), "lang", "source", n_chars.alias("n_chars"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(docs, read_table(spark, sf_dir, "benchmark"), keep=("lang", "source", "n_chars"))
    return found.filter("not contaminated").select(*COLUMNS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    both = sentencepiece_stream.round_trip(docs, public_tokenizers.path(PIECES), with_ids=True)
    return both.select("doc_id", "n_bytes", "n_tokens", "ids", "ids_crc32", "same")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("SentencePiece", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage's result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-').lower()}")
    return docs
