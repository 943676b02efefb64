"""Labelled texts to fit a classifier on: all of them, or a bounded sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cairn.llm.folds import crc_fold

FOLDS, HELD_OUT = 3, 1


def known_labels(labels: DataFrame, target: str, id_col: str = "doc_id") -> DataFrame:
    """(id, label) of every id that a model may learn from; an id with several labels has the largest."""
    return (labels.select(F.col(id_col).cast("long").alias("id"), F.col(target).cast("int").alias("label"))
            .where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & (crc_fold("id", FOLDS) != HELD_OUT))
            .groupBy("id").agg(F.max("label").alias("label")))


def labelled_texts(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, label) of every text of the ids in ``known``; null ids and texts are left out."""
    texts = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
             .where(F.col("text").isNotNull() & F.col("id").isNotNull() & (crc_fold("id", FOLDS) != HELD_OUT)))
    return texts.join(known, "id").select("text", "label")


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, per_class: int, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(text, label): at most ``per_class`` texts of each label 0 and 1, those with the smallest hash of the id.

    Only rows whose crc32 of the id as text, modulo FOLDS, is not HELD_OUT;
    equal texts count once.  An id with several labels has the largest.
    Null ids, labels and texts are left out.  The sample is at most 2 *
    ``per_class`` ids, so it is broadcast to the scan of ``docs``.
    """
    known = known_labels(labels, target, id_col)
    some = [known.where(F.col("label") == y).orderBy(F.xxhash64("id"), "id").limit(per_class) for y in (0, 1)]
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text is not null")
    return (texts.join(F.broadcast(some[0].unionByName(some[1])), "id")
            .dropDuplicates(["text", "label"]).orderBy(F.xxhash64("id"), "id").select("text", "label"))
