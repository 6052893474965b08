"""Mixing sources to target weights by weighted fair queueing.

Documents are shuffled by a hash of their id. Within its source, a document's virtual finish time
is the running token count up to and including it, divided by the source's weight; a second and
third copy queue behind the whole source. All copies are ordered by virtual time and cut where the
running total reaches the budget (the corpus's own size). A source that has given all its copies
drops out, so the rest is shared by weight: the cut is at the level where
sum(min(copies * size, level * weight)) is the budget, which also gives each source's target.

Running totals are two-level (per hash range, then inside the range), so a source with a third of
all rows is spread over many groups; the global cut orders ranges of virtual time first and sorts
only the range that holds the cut. Results do not depend on the ranges.

Defined cases: null text has size 0 (and takes nothing); a null source is the last source; a corpus
without words takes nothing and has targets 0; rows repeating a doc_id queue as documents of their
own; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD_CLASS, small_enough, text_or_empty, written

WEIGHTS = (5, 2, 1)
COPIES = 3
ROWS_PER_RANGE = 20_000


def word_count(name: str = "text") -> Column:
    return F.regexp_count(text_or_empty(name), F.lit(WORD_CLASS)).cast("long")


def _shuffle_key(seed: str, doc_id: str) -> Column:
    return F.md5(F.concat(F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, copies: int = COPIES) -> DataFrame:
    """Per source: source_size, weight, target, level. One row per source; sources are a list of
    feeds, orders of magnitude fewer than documents."""
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    src = src.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((rank - 1) % len(weights) + 1)))
    # sources by the level at which they run dry; those before a source are dry once it is
    dry = F.col("source_size") * copies / F.col("weight")
    order = W.orderBy(dry.asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    total = F.sum("source_size").over(everything)
    left = total - F.coalesce(F.sum(F.col("source_size") * copies).over(before), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    src = src.withColumn("dry", dry).withColumn("candidate", left / weight_left)
    # the first source that doesn't run dry gives the level
    level = F.min(F.when(F.col("candidate") <= F.col("dry"), F.struct("dry", "candidate"))).over(everything)
    src = src.withColumn("level", level["candidate"])
    return src.select("source", "source_size", "weight", "level",
                      F.least(F.col("source_size") * copies, F.col("level") * F.col("weight"))
                       .cast("double").alias("target"))


@dataclass(frozen=True)
class Cut:
    """The last copy that is taken, in the order (vft, shuffle key, doc_id, size, copy)."""
    vft: float
    key: str
    doc_id: int | None
    size: int
    copy: int


def _vft(copy: int) -> Column:
    return (F.lit(copy - 1) * F.col("source_size") + F.col("run")) / F.col("weight")


def _queued(spark: SparkSession, docs: DataFrame, weights, copies: int, seed: str) -> DataFrame:
    """Per document: size, shuffle key, source_size, weight, target, level, run (running total in the source)."""
    sizes = docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count().alias("size"),
                        _shuffle_key(seed, "doc_id").alias("key"))
    sizes = written(spark, sizes, "mix-sizes")
    n = sizes.count()
    digits = 1
    while 16 ** digits * ROWS_PER_RANGE < n:
        digits += 1
    sizes = sizes.withColumn("range", F.substring("key", 1, digits))
    per = sizes.groupBy("source", "range").agg(F.sum("size").alias("in_range"))
    before = W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    per = per.withColumn("offset", F.coalesce(F.sum("in_range").over(before), F.lit(0)))
    src = source_targets(sizes, weights, copies)
    per = per.join(F.broadcast(src) if src.count() < 100_000 else src,
                   per.source.eqNullSafe(src.source)).drop(src.source)
    per = per.select(F.col("source").alias("p_source"), F.col("range").alias("p_range"), "offset",
                     "source_size", "weight", "target", "level")
    rows = sizes.join(per, sizes.source.eqNullSafe(per.p_source) & (sizes.range == per.p_range))
    inside = (W.partitionBy("p_source", "range").orderBy("key", "doc_id", "size")
               .rowsBetween(W.unboundedPreceding, W.currentRow))
    rows = rows.withColumn("run", F.col("offset") + F.sum("size").over(inside))
    return written(spark, rows.select("doc_id", "source", "size", "key", "source_size", "weight", "target",
                                      "level", "run"), "mix-queue")


def _cut(queued: DataFrame, copies: int) -> Cut | None:
    """Order all copies by virtual time, sum up, cut at the budget. One row comes to the driver."""
    head = queued.agg(F.sum("size").alias("budget"), F.max("level").alias("level"), F.count(F.lit(1)).alias("n")).first()
    if not head.budget:
        return None
    slots = F.explode(F.array(*[F.struct(_vft(e).alias("vft"), F.lit(e).alias("copy")) for e in range(1, copies + 1)]))
    each = queued.where(F.col("size") > 0).withColumn("c", slots).select("c.vft", "c.copy", "key", "doc_id", "size")
    width = head.level / max(64, head.n // ROWS_PER_RANGE)
    each = each.withColumn("bin", F.floor(F.col("vft") / width))
    bins = each.groupBy("bin").agg(F.sum("size").alias("in_bin"))
    upto = F.sum("in_bin").over(W.orderBy("bin").rowsBetween(W.unboundedPreceding, W.currentRow))
    crossing = (bins.withColumn("upto", upto).where(F.col("upto") >= head.budget).orderBy("bin")
                    .select("bin", "upto", "in_bin").first())
    base = crossing.upto - crossing.in_bin
    inside = W.partitionBy("bin").orderBy("vft", "key", "doc_id", "size", "copy")
    run = F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, W.currentRow)) + F.lit(base)
    order = [F.col(c).desc() for c in ("vft", "key", "doc_id", "size", "copy")]
    last = (each.where(F.col("bin") == crossing.bin).withColumn("upto", run)
                .where(F.col("upto") <= head.budget).orderBy(*order).first())
    if last is None:  # the first copy of the range is past the budget: the ranges before it are taken
        last = each.where(F.col("bin") < crossing.bin).orderBy(*order).first()
    return Cut(last.vft, last.key, last.doc_id, last.size, last.copy) if last else None


def mix(spark: SparkSession, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, copies: int = COPIES,
        seed: str = "mix") -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, n_copies, first_vft, source."""
    queued = _queued(spark, docs, weights, copies, seed)
    cut = _cut(queued, copies)
    n = F.lit(0)
    if cut:
        at = F.struct("key", F.col("doc_id"), "size")
        end = F.struct(F.lit(cut.key).alias("key"), F.lit(cut.doc_id).cast("long").alias("doc_id"),
                       F.lit(cut.size).cast("long").alias("size"))
        for e in range(1, copies + 1):
            tied = (at < end) | ((at == end) & F.lit(e <= cut.copy))
            n = n + F.when((_vft(e) < F.lit(cut.vft)) | ((_vft(e) == F.lit(cut.vft)) & tied), 1).otherwise(0)
    n = F.when(F.col("size") > 0, n).otherwise(0)
    return queued.select("doc_id", "size", "source_size", F.coalesce(F.col("target"), F.lit(0.0)).alias("target"),
                         (n * F.col("size")).cast("long").alias("taken"), n.cast("int").alias("n_copies"),
                         _vft(1).alias("first_vft"), "source")


def mixed_documents(spark: SparkSession, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, copies: int = COPIES,
                    seed: str = "mix") -> DataFrame:
    """The documents the mix takes, each as often as it is taken, with all their columns.

    In the order of the queue, the documents of a source that are taken e times or more come before the others. So the last
    of them, for each e, tells how often any document is taken, and the texts need not be dealt by id to learn it."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    # rows that share id, source and size are alike to the mix; where their copies differ, they are dealt by number
    picked = mix(spark, docs, weights, copies, seed).groupBy(F.col("doc_id").alias("m_id"), F.col("source").alias("m_source"), F.col("size").alias("m_size"))
    picked = picked.agg(F.max("n_copies").alias("m_most"), F.min("n_copies").alias("m_least"),
                        F.sort_array(F.collect_list("n_copies"), asc=False).alias("m_each")).where("m_most > 0")
    picked = written(spark, picked.withColumn("m_each", F.when(F.col("m_most") > F.col("m_least"), F.col("m_each"))), "mix-picked")
    rows = docs.withColumn("m_words", word_count())

    def place(doc_id: str, size: str) -> Column:
        return F.struct(_shuffle_key(seed, doc_id).alias("key"), F.col(doc_id).alias("doc_id"), F.col(size).alias("size"))

    def joined(side: DataFrame, how: str = "inner") -> DataFrame:
        return rows.join(side, rows.doc_id.eqNullSafe(side.m_id) & rows.source.cast("string").eqNullSafe(side.m_source)
                         & (rows.m_words == side.m_size), how)

    def copied(df: DataFrame, n: Column) -> DataFrame:
        return df.select(*columns, F.explode(F.array_repeat(F.lit(1), n)).alias("m_copy")).drop("m_copy")

    last = [F.max(F.when(F.col("m_most") >= e, place("m_id", "m_size"))).alias(f"m_last{e}") for e in range(1, copies + 1)]
    last = written(spark, picked.where("m_each is null").groupBy("m_source").agg(*last), "mix-last")
    last = F.broadcast(last) if last.count() < 100_000 else last
    mixed = picked.where("m_each is not null")
    n_mixed = mixed.count()
    if n_mixed:
        mixed = F.broadcast(mixed) if small_enough(spark, n_mixed, 200) else mixed
        alike = joined(mixed, "left_anti")
    else:
        alike = rows
    alike = alike.join(last, alike.source.cast("string").eqNullSafe(last.m_source))
    taken = sum((F.when((F.col("m_words") > 0) & (place("doc_id", "m_words") <= F.col(f"m_last{e}")), 1).otherwise(0) for e in range(1, copies + 1)), F.lit(0))
    out = copied(alike, taken)
    if not n_mixed:
        return out
    number = F.row_number().over(W.partitionBy("m_id", "m_source", "m_size").orderBy("text"))
    mixed = joined(mixed).withColumn("m_number", number)
    return out.unionByName(copied(mixed, F.element_at("m_each", F.col("m_number"))))
