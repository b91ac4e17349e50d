"""The corpus pipeline: five stages over ``documents``, each one operator of perron.llm at work on the whole table.

1. quality classifier: documents that score under 0.5 go.
2. line dedup: later repeats of passages of 50 words or more are deleted; a document that they filled goes.
3. near duplicates: of each group linked by similar five-word shingles the document with the least doc_id stays.
4. secret scan: reported spans are replaced by a mark.
5. best-fit packing: the pieces of the remaining documents, each with its sequence and offset.

All but the last return the columns of ``documents``; n_chars follows the text where a stage changes it. Null text
counts as empty in every stage and is kept unless the classifier rejects it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perron.llm import classifier, jaccard, line_dedup, pack, secrets
from perron.llm.base import fresh, stored, table
from perron.llm.queries import tokenizer_path

#: Near duplicates: five words, a similarity of 0.8 or more.
SHINGLE, NUM, DEN = 5, 80, 100


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what nearest-neighbour voting predicts to be of quality 1."""
    model = classifier.fit(docs, table(spark, sf_dir, "labels"))
    score = fresh(docs, "score__")
    return docs.withColumn(score, classifier.score_column(model, F.col("text"))).where(F.col(score) >= 0.5).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes later repeated runs of lines; drops documents of which nothing but white space is left by that."""
    n = fresh(docs, "n_deleted")
    out = line_dedup.dedup_lines(docs)
    return out.where((F.col(n) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of similar ones; rows that repeat a kept doc_id stay.

    Null and empty texts are similar to nothing and stay, as do rows with a null doc_id.
    """
    found = jaccard.similar_components(docs, SHINGLE, NUM, DEN)
    drop = found.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(drop, "doc_id", "left_anti").select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces reported secrets in the texts. Null and empty texts and rows without a doc_id are handled as any; rows that
    repeat a doc_id and a text are masked alike."""
    return secrets.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece.

    Null and empty texts are one piece of one id; rows that repeat a doc_id have pieces each; a null doc_id stays null.
    """
    return pack.pack_documents(docs, tokenizer_path())


STAGES = [("quality_classifier", quality_classifier), ("line_dedup", dedup_lines), ("near_duplicates", near_duplicates),
          ("secret_scan", mask_secrets), ("best_fit_packing", pack_sequences)]

#: The classifier, the tokenizer and the packing are beyond SQL; tests hold run() against a plain version, scores given.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared checkpoint folder and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
