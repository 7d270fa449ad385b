"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
and read again as the next one's `docs`. All but the last return the columns of
`docs`, whatever their names and types beside doc_id, text and lang; an empty
table gives an empty table. Texts are read whole, of any length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terroir.llm import contamination, language, near_dups, packing, repeats
from terroir.llm.common import table, written
from terroir.llm.tokens import default_tokenizer

MIN_LANGUAGE_SCORE = 0.2  # share of a text's n-grams that its language must know


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without letters (null and empty ones too) and texts that no
    learned language knows. Rows are judged one by one: repeated ones alike, those
    without an id or label like all others. Without labelled rows nothing is known
    and all go. Of languages with equal scores the first in the alphabet counts."""
    return language.accepted(docs, language.fit(language.labelled_rows(docs)), MIN_LANGUAGE_SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates, that with the smallest
    id. Null and empty texts are in no group and stay. Of rows that repeat an id one
    stays, the least as JSON. Rows without an id cannot be told apart and all stay."""
    return near_dups.one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts 100-byte strings that occur earlier out of the texts; no row goes.
    Null texts stay null. Rows that repeat an id and a text are one document and
    are cut alike; other texts of one id follow each other by a hash. Rows without
    an id come first. `n_chars` is set to the length of what is left."""
    out = repeats.without_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold benchmark items. Null and empty texts stay, and
    all rows where the benchmark is empty. Repeated rows go or stay together; rows
    without an id, and rows that share one, are judged each by their own text."""
    return contamination.clean(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and their places in sequences. Null and empty
    texts are a piece of the end id alone; repeated rows and rows without an id are
    packed each on its own. Other columns are not carried."""
    return packing.pack_documents(docs, default_tokenizer(), 2048, 0)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup),
          ("decontamination", decontamination), ("best_fit_packing", best_fit_packing)]

# Models, token ids and byte-wise repeats have no SQL form; tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
