"""The corpus pipeline: documents in, encoded training documents out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import toxicity
from barloom.llm.common import ascii_lower, materialize, table
from barloom.llm.exact_dedup import exact_dedup
from barloom.llm.mixing import mix
from barloom.llm.queries import encoded
from barloom.llm.shingle_join import joined_classes
from barloom.llm.simhash import COPY_RADIUS, COPY_WORDS, simhash_components


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose score is below 0.5, by a model fitted on the labelled rows. No shuffle of texts.

    A null or empty text is scored as any other; whole texts of any length are; repeated rows share a score; other columns pass.
    """
    score = toxicity.score_column(spark, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return docs.where(score(F.col("text")) < 0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id; rows that repeat its id and text are the same document."""
    kept = exact_dedup(docs).where("kept").select("id", "text_sha256").distinct().alias("k")
    sha = F.sha2(ascii_lower(F.col("d.text")).cast("binary"), 256)
    return docs.alias("d").join(kept, F.col("d.doc_id").eqNullSafe(F.col("k.id")) & (sha == F.col("k.text_sha256")), "left_semi")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, the one with the smallest doc_id.

    Near copies are alike by 0.8 or more in their shingles of five words. Long fingerprints
    find most of them; an exact join of the shingle sets links every other pair, so none is left out.
    """
    found = materialize(simhash_components(docs, radius=COPY_RADIUS, width=5, words=COPY_WORDS))
    found = joined_classes(docs, found, 5)
    kept = found.where(F.col("id").eqNullSafe(F.col("component_id"))).select("id").distinct().alias("k")
    return docs.alias("d").join(kept, F.col("d.doc_id").eqNullSafe(F.col("k.id")), "left_semi")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as rows: each document as often as the mix takes it. Nulls, empty tables and repeats as :func:`mix` has them."""
    size, copies, one = ("_".join([name, *docs.columns]) for name in ("size", "copies", "one"))  # no column has such a name
    rows, _ = mix(docs, F.array("source"), added=(size, copies))
    often = F.explode(F.array_repeat(F.lit(0), F.col(copies))).alias(one)
    return rows.where(F.col(copies) > 0).select(*docs.columns, often).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every row of the mix; null texts count as empty, repeated rows stay, other columns go."""
    return encoded(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: SQL cannot express the classifier; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in turn to ``documents``, each result written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
