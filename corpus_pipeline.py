"""Documents through five corpus stages, each stored before the next one reads it.

Every stage but the last returns the columns of documents; further columns of its input are
left out, whatever their names.  Rows with
a null id are judged on their text like any other, but are no one's earlier document; rows
that share an id are judged as one.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.llm import bpe_automaton, decontamination, jaccard, suffix_dedup, toxicity
from fieldbook.llm.store import kept, table
from fieldbook.llm.workload import BYTE_VOCABULARY

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A text goes as a whole if at least this share of its words stands in benchmark windows.
WHOLE_SHARE = 0.5


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select(*COLUMNS), model)
    return scored.filter(F.col("score") < 0.5).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least document of each component of near duplicates."""
    found = jaccard.linked(docs)
    least = found.filter(F.col("component_id") == F.col("doc_id")).select("doc_id")
    firsts = docs.filter(F.col("doc_id").isNotNull()).join(least, "doc_id", "left_semi")
    return firsts.unionByName(docs.filter(F.col("doc_id").isNull())).select(*COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings that start in an earlier one too.

    Characters are cut whole; a document of which nothing is left goes, unless it was empty
    before.
    """
    cut = suffix_dedup.deduplicated(docs.select(*COLUMNS), keep_text=True)
    left = cut.filter((F.col("n_bytes") == 0) | (F.length("kept_text") > 0))
    return left.select(
        "doc_id", F.col("kept_text").alias("text"), "lang", "source",
        F.length("kept_text").cast("long").alias("n_chars"),
    )


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words that stand in benchmark windows.

    Where these are half of a document or more, the document goes; else their spans do.
    """
    found = decontamination.scan(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"), keep_text=True)
    mostly = F.col("n_hit") >= WHOLE_SHARE * F.col("n_words")
    rest = found.filter((F.col("n_hit") == 0) | ~mostly)
    cleaned = decontamination.without_spans(rest)
    return cleaned.select(
        "doc_id", "text", "lang", "source", F.coalesce(F.length("text").cast("long"), "n_chars").alias("n_chars")
    )


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, and digests of them and of what they decode to."""
    return bpe_automaton.encode(docs.select(*COLUMNS), Path(BYTE_VOCABULARY).read_text())


STAGES = [
    ("toxicity", without_toxic),
    ("shingle join", one_of_each_group),
    ("suffix dedup", without_repeats),
    ("benchmark decontamination", without_benchmarks),
    ("byte-pair codec", as_tokens),
]

#: Hashed merges, suffix order and a fitted classifier have no SQL form; tests compare the
#: stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
