"""Exact deduplication: group by a 128-bit content hash, compare bytes inside the groups, keep the
smallest stable id. Native DataFrame functions only.

The grouping key is (hash, normalised text): rows meet by hash, and the text in the key makes the
aggregate compare bytes, so texts that merely collide form classes of their own. The aggregate is
combined map-side: a group of copies that holds a third of all rows reaches the shuffle once per
map task. Documents find their class by (hash, SHA-256), a join of narrow rows in which adaptive
execution splits a hot key.

Defined cases: null text counts as empty; equal empty texts form one class; rows repeating one
(doc_id, text) count in ``group_size`` and get the same verdict; a null doc_id is never the kept
one unless its class has no other (then keep_id is null and kept is false); extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, text_or_empty


def normalised(name: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(name), SPACE_CLASS, " ")


def content_hash(text: Column) -> Column:
    """128 bits."""
    return F.unhex(F.md5(text))


def exact_classes(docs: DataFrame, hash_of: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per distinct normalised text: (class_hash, class_sha, keep_id, group_size)."""
    rows = docs.select("doc_id", normalised().alias("norm"))
    groups = (rows.withColumn("class_hash", hash_of(F.col("norm")))
                  .groupBy("class_hash", "norm")
                  .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    return groups.select("class_hash", F.sha2("norm", 256).alias("class_sha"), "keep_id", "group_size")


def exact_dedup(docs: DataFrame, hash_of: Callable[[Column], Column] = content_hash) -> DataFrame:
    """Per document: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    rows = docs.select("doc_id", normalised().alias("norm")).select(
        "doc_id", hash_of(F.col("norm")).alias("h"), F.sha2("norm", 256).alias("text_sha256"))
    cls = exact_classes(docs, hash_of)
    joined = rows.join(cls, (rows.h == cls.class_hash) & (rows.text_sha256 == cls.class_sha))
    return joined.select("doc_id", "keep_id", "group_size",
                         F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"),
                         "text_sha256")


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: in each class those with its smallest id (rows that repeat id and
    text share the verdict), without an id where the class has none."""
    rows = docs.withColumns({"__hash": content_hash(normalised()), "__sha": F.sha2(normalised(), 256)})
    cls = exact_classes(docs).select(F.col("class_hash").alias("__h"), F.col("class_sha").alias("__s"), F.col("keep_id").alias("__k"))
    same = (F.col("__hash") == F.col("__h")) & (F.col("__sha") == F.col("__s")) & F.col("doc_id").eqNullSafe(F.col("__k"))
    return rows.join(cls, same, "left_semi").drop("__hash", "__sha")
