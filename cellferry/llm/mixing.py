"""Mixing sources to target weights by hash thresholds.

Every document has a hash that depends on itself alone. The words of a source are summed by the
leading bits of that hash; the running sum over these buckets tells in which one the source's
budget ends, and only the documents of that bucket are summed by the next bits, until one hash is
left. A document is taken as often as its source is taken whole, and once more if its hash lies
below the threshold. No document is sorted or compared with another one, a source may hold any
share of all rows, and a larger budget takes all that a smaller one takes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, numbered, small_enough, word_count

# a hash has 60 bits, 15 hexadecimal digits of an MD5, and is told apart by 12 bits at a time
HASH_BITS, LEVEL_BITS = 60, 12


def document_hash(doc_id: Column, text: Column) -> Column:
    digits = F.substring(F.md5(F.concat_ws("\n", doc_id.cast("string"), text)), 1, HASH_BITS // 4)
    return F.conv(digits, 16, 10).cast("long")


def targets(sources: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """``sources`` (source, source_size) with ``weight`` and ``target``.

    All sizes are shared by weight. A target stops at ``most`` times its source's size and the excess
    goes to the others by weight, until none is above: each round sums up the sources that have
    reached their end, which is one row for the driver.
    """
    listed = numbered(sources, [F.col("source").asc_nulls_last()], ["source", "source_size"])
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("at") % len(weights) + 1).cast("int"))
    weighed = checkpointed(listed.select("source", "source_size", weight.cast("long").alias("weight")))
    end = F.col("source_size") * most
    total, all_weights = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    per_weight, ended = (total / all_weights if all_weights else 0.0), -1
    while True:
        full = end <= F.lit(per_weight) * F.col("weight")
        now, gone, free = weighed.agg(
            F.count_if(full),
            F.coalesce(F.sum(F.when(full, end)), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
        ).first()
        if now == ended or not free:
            break
        ended, per_weight = now, (total - gone) / free
    full = end <= F.lit(per_weight) * F.col("weight")
    return weighed.withColumn("target", F.when(full, end.cast("double")).otherwise(F.lit(per_weight) * F.col("weight")))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    most: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Per document: ``id_col``, ``size`` (words), ``source_size``, ``target`` (its source's words in the mix), ``taken``, ``repeats``.

    Sources in code point order, a null source last, have the weights in turn. ``repeats`` says how
    often a document is taken, at most ``most`` times, and ``taken`` is its size times that. A
    source's taken words differ from its target by no more than half the size of the document
    where its budget ends. Null and empty texts have size 0. Rows with the same id and text are
    taken together. An empty table gives an empty result; other columns are not read. Runs agree.
    """
    hashed = document_hash(docs[id_col], docs[text_col]).alias("h")
    sized = checkpointed(
        docs.select(docs[id_col].alias("id"), docs[source_col].alias("source"), word_count(docs[text_col]).alias("size"), hashed)
    )
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    shared = checkpointed(sources.withColumn("whole", whole))
    shared = shared.withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
    ends = _thresholds(sized, shared.where("need > 0").select("source", "need"))
    looked_up = checkpointed(
        shared.alias("s").join(ends.alias("e"), F.col("s.source").eqNullSafe(F.col("e.source")), "left")
        .select("s.source", "source_size", "target", "whole", F.coalesce("threshold", F.lit(0)).alias("threshold"))
    )
    small = small_enough(looked_up, 64, "coalesce(octet_length(source), 0)")
    joined = sized.alias("d").join(small.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
    repeats = F.col("whole") + (F.col("h") < F.col("threshold")).cast("long")
    return joined.select(
        F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * repeats).alias("taken"), repeats.alias("repeats")
    )


def _thresholds(sized: DataFrame, needs: DataFrame) -> DataFrame:
    """``source`` and ``threshold``: hashes below it hold about ``need`` words of the source."""
    still = checkpointed(needs.select("source", "need", F.lit(0).cast("long").alias("below"), F.lit(0).cast("long").alias("prefix")))
    found: DataFrame | None = None
    for left in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        at = small_enough(still, 64, "coalesce(octet_length(source), 0)")
        inside = F.col("d.source").eqNullSafe(F.col("o.source")) & (F.shiftright("h", left + LEVEL_BITS) == F.col("prefix"))
        sums = (
            sized.alias("d").join(at.alias("o"), inside)
            .groupBy("o.source", "need", "below", F.shiftright("h", left).alias("bucket"))
            .agg(F.sum("size").alias("words"), F.min("h").alias("least"), F.max("h").alias("greatest"))
        )
        # at most 2^12 buckets of a source
        running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        start = F.col("below") + F.coalesce(F.sum("words").over(running), F.lit(0))
        ends_here = (F.col("start") < F.col("need")) & (F.col("start") + F.col("words") >= F.col("need"))
        ends = checkpointed(sums.withColumn("start", start).where(ends_here))
        # the nearer side of the one hash that is left
        over = (2 * (F.col("need") - F.col("start")) >= F.col("words")).cast("long")
        done = ends.where("least = greatest").select("source", (F.col("least") + over).alias("threshold"))
        found = done if found is None else found.unionByName(done)
        still = ends.where("least < greatest").select("source", "need", F.col("start").alias("below"), F.col("bucket").alias("prefix"))
        if still.isEmpty():
            break
    return found


def repeated(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The mix itself: rows of ``docs`` as often as ``mixed`` takes them. Ids must be unique."""
    often = mixed.where("repeats > 0").select(id_col, "repeats")
    rows = docs.join(often, id_col).withColumn("repeats", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int"))))
    return rows.drop("repeats")
