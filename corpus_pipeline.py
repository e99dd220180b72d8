"""Corpus pipeline: score, deduplicate, clean and tokenise `documents`.

STAGES are (name, function) pairs; each function takes (spark, docs, sf_dir), works on all rows that
its predecessor kept, and returns a DataFrame. All but the last return the columns of documents.

1. toxicity: documents that the toxicity model scores at TOXIC_FROM or more go.
2. near copies: of each group that the Jaccard join links, the document of least id stays.
3. repeated strings: bytes of strings that occur again elsewhere are taken out of the texts.
4. benchmark: documents that hold a benchmark window go.
5. tokens: every text is encoded, and decoded again; doc_id, n_tokens, ids_sha256, decoded_sha256.

Rows with null ids are kept by stage 2 only if no row with an id has their text's group. Empty
tables pass through; labels and benchmark may be empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellstrand.llm import byte_bpe, decontaminate, jaccard_join, suffix_dedup, toxicity
from cellstrand.llm.common import stored, table

TOXIC_FROM = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below TOXIC_FROM; the model learns from the labels of the whole table."""
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~toxicity.held_out(3, 1))
    return toxicity.below(docs, model, TOXIC_FROM)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each linked group."""
    return jaccard_join.representatives(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated strings; n_chars follows the text where the table has it."""
    cut = suffix_dedup.without_repeats(docs)
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of any benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every text's ids and of their decoding."""
    return byte_bpe.encoding_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("byte_level_bpe", encode),
]

#: A trained model and cut texts have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written to shared storage and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
