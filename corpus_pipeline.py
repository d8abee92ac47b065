"""A corpus from documents to packed sequences, by five of the operators in caseflow/llm.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and gives a DataFrame.  ``run`` applies them to the table documents, each
result written as Parquet into the shared folder and reread as the next
stage's documents, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.llm import langid, line_spread, mixing, near_join, packing
from caseflow.llm.common import crc_mod, write_once

#: Documents nearer to a language's profile than this are taken as written in it.
MIN_LANGUAGE_SCORE = 0.25


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that have letters and are near to some learned language; ``lang`` becomes that language.

    Profiles are learned from the documents whose crc32(doc_id as text) mod 5
    isn't 0 (a null id teaches nothing).  A null, empty or letterless text
    goes; repeated rows are judged alike.  Other columns stay as they are,
    whatever their names; an empty table gives no rows.
    """
    model = langid.learn_profiles(docs.where(crc_mod("doc_id", 5) != 0))
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), "text")
    judged = langid.identify(rows, model, out="spoken", score="nearness") \
        .where((F.col("spoken") != langid.UNDETERMINED) & (F.col("nearness") >= MIN_LANGUAGE_SCORE))
    return judged.select(*[F.col("spoken").alias(c) if c == "lang" else F.col("row")[c].alias(c) for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without cross-site boilerplate lines; a document that had lines and lost them all goes.

    ``text`` and ``n_chars`` are new, other columns stay as they are, whatever
    their names; nulls and repeats as ``line_spread.drop_spread_lines`` has them.
    """
    left = line_spread.clean_lines(docs).where("n_removed = 0 or n_removed < n_lines")
    return left.select(*[F.col("text").alias(c) if c == "text" else F.length("text").cast("long").alias(c)
                         if c == "n_chars" else F.col("row")[c].alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of least id, of each class of near copies; repeated rows count once."""
    return near_join.keep_one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix takes a document, in the order of the schedule."""
    return mixing.mix_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the mixed documents and their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("source mix", source_mix),
    ("best-fit packing", packed_sequences),
]

#: SQL can't express the tokenizer, the profiles or the schedule.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage, all stages applied to documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_once(stage(spark, docs, sf_dir), f"stage-{name.split()[0]}")
    return STAGES[-1][1](spark, docs, sf_dir)
