"""A training corpus from raw documents: five stages, each on all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``, and any
further ones that came in, whatever their names. An empty table stays empty in every stage; very long texts are taken whole; no stage asks doc_id to be unique
or there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm import bagminhash, curriculum, language_crf, line_dedup, packing
from tallybook.llm.common import forget, keep, kept_tables, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and those of whose words less than half (by mean probability) are of a learned language.

    Without any row to learn from, every document that has a letter stays. Null and empty texts go; repeated rows are judged alike.
    """
    model = language_crf.train(docs)
    made = {c: f"__{c}" for c in ("lang_pred", "score", "support")}
    tagged = language_crf.tag(docs.withColumnsRenamed(made), model)
    stays = (F.col("lang_pred") != "und") & (F.col("support") >= 0.5) if model else F.col("text").rlike(r"\p{L}")
    return tagged.where(stays).drop(*made).withColumnsRenamed({v: k for k, v in made.items()}).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays: the first by doc_id (null first), of rows that tie in id and text one.

    Null and blank texts are classes of their own and stay.
    """
    return bagminhash.dedup(docs)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines and sentences are cut out; a document of which nothing is left goes.

    The first row by (doc_id, place) keeps a line, so of repeated rows the others go. A document that loses nothing stays as it is, null and
    blank texts too.
    """
    made = {c: f"__own_{c}" for c in ("n_units", "n_removed", "removed") if c in docs.columns}
    out = line_dedup.dedup_lines(docs.withColumnsRenamed(made), line_dedup.LINE_WORDS, line_dedup.SENTENCE_WORDS).where((F.col("n_removed") == 0) | F.col("text").rlike(r"\S"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*[F.col(made.get(c, c)).alias(c) for c in docs.columns])


def curriculum_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The stream of the mix: a document once for each time that it is taken, in training order.

    A null source is a source of its own; a document of size 0 (null or blank text) is taken whenever its place is, and weighs nothing.
    Repeated rows are taken each by its own place.
    """
    return curriculum.stream(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents of the stream, packed into sequences. Null text is the end token alone; repeated rows are packed each."""
    return packing.pack_documents(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("repeated_lines", repeated_lines), ("curriculum_mix", curriculum_mix), ("packed", packed)]
#: SQL can express neither the random field nor the signatures nor the search for a packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    begun = kept_tables()
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
        forget(spark, begun, but=1)  # the stage is written: all that led to it can go
    return STAGES[-1][1](spark, docs, sf_dir)
