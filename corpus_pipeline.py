"""Cleaning and encoding a corpus: the stages, in order, over the table ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusmap.llm import decontaminate, overlap, pieces, pii, simhash, toxicity
from corpusmap.llm.common import fresh
from corpusmap.llm.queries import MODEL_FILE
from corpusmap.session import cut_lineage
from corpusmap.sources.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5; null and empty texts stay."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), F.lit(True))
    score = fresh("toxicity_score", docs)
    return docs.withColumn(score, toxicity.toxicity(spark, model, F.col("text"))).filter(F.col(score) < 0.5).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class: the one with the smallest id, then MD5 of its text; null ids come last.

    First classes of fingerprints within 3 bits, the contract of op8, null and empty texts included. These miss most pairs of
    texts near a similarity of 0.8, so among the rows left, classes of texts whose sets of five words are alike to 0.8 or more.
    """
    mark = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))
    found = simhash.near_duplicates(docs, mark=mark).select(F.col("doc_id").alias("id"), "mark", "label")
    return overlap.one_of_each(cut_lineage(overlap.one_row_each(docs, found, mark)))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in 20 lies in a benchmark window."""
    shared = fresh("benchmark_found", docs)
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), out_col=shared)
    return found.filter(~decontaminate.is_contaminated(shared)).select(docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind in brackets."""
    masked = docs.withColumn("text", pii.mask_pii(F.col("text")))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the ids of their text."""
    model = pieces.load(spark, MODEL_FILE)
    encoded = pieces.encode(docs, model, reader=pieces.reader_of(model))
    return encoded.withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("sentencepiece", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Trained models, fingerprints and segmentations can't be said in SQL; tests compare with a brute-force version.
ORACLE_SQL = None
