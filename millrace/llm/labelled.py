"""Bounded samples of labelled documents, and the split that every classifier here keeps."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(id_col: str | Column) -> Column:
    """Rows that no model may learn from: crc32 of the id as text, mod 3, is 1. Rows without an id count as held out."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def eligible(labels: DataFrame, label: str, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, y), one row per labelled id outside the held-out third; of several labels the largest counts."""
    return (labels.select(F.col(id_col).alias("doc_id"), F.col(label).cast("int").alias("y"))
            .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out("doc_id"))
            .groupBy("doc_id").agg(F.max("y").alias("y")))


def sample(docs: DataFrame, labels: DataFrame, label: str, most: int, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(doc_id, text, y) of at most `most` labelled rows outside the held-out third, the same ones in every run.

    Rows of each class are taken in the order of a hash of their id, half of `most` from each, so a rare class is not
    lost. Only these ids, at most `most`, are broadcast; the texts are found by one scan without a shuffle. Where an id
    has several labels the largest counts; rows without a label are not used.
    """
    known = eligible(labels, label, id_col)
    order = [F.xxhash64(F.lit(17), "doc_id"), F.col("doc_id")]
    taken = [known.where(F.col("y") == y).orderBy(*order).limit(most // 2) for y in (0, 1)]
    return (docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .join(F.broadcast(taken[0].unionAll(taken[1])), "doc_id"))
