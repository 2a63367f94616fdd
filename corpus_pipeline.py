"""From raw documents to packed training sequences: each stage takes the documents its predecessor kept.

Quality rules drop documents; of near duplicates one stays; byte strings that an earlier document has are cut out; a
sample meets the target weights; what is left is tokenised and packed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablespan.llm import jaccard, mixing, packing, repeats, rules
from tablespan.llm.queries import MIX
from tablespan.scratch import new_path
from tablespan.sources.tables import read_table

ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the list learned from the labels."""
    return rules.judged(docs, read_table(spark, sf_dir, "labels"), docs.columns).filter("kept").select("row.*")


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    return jaccard.one_of_each(docs, width=5, percent=80)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings of an earlier document, and their lengths. A document with nothing left goes; one
    that had nothing to lose stays as it is, null or empty too."""
    cut = repeats.without_repeats(docs, docs.columns).filter("n_removed < n_bytes or n_bytes = 0")
    text = F.when(F.col("n_removed") == 0, F.col("row.text")).otherwise(F.col("text"))
    fresh = {"text": text, "n_chars": F.when(F.col("n_removed") == 0, F.col("row.n_chars")).otherwise(F.length("text").cast("long"))}
    return cut.select([fresh.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with the target shares of sources, languages and text forms."""
    return mixing.mixed(docs, MIX)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and where they lie in the sequences."""
    return packing.packed(packing.tokenised_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("quality_rules", quality_rules), ("ngram_jaccard_join", ngram_jaccard_join), ("suffix_array_dedup", suffix_array_dedup),
          ("source_mixing", source_mixing), ("best_fit_packing", best_fit_packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Every stage but the last is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = new_path(spark, name)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
