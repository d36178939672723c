"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from oreflow.llm.common import Workspace, buckets_for, hash_bucket, running_offsets

WORD = r"[^\x20\x09-\x0D]+"
#: Weights in turn over the sources in code point order; share of all words; most passes over a source.
TURN, SHARE, PASSES = (3, 1, 2), 1.5, 2
BLOCK_WORDS = 4096
#: The golden ratio's fractional part, and its multiple by 2 ** 16, for points of 1e-10 accuracy.
GOLDEN = 0.6180339887498949
GOLDEN_16 = (2**16 * GOLDEN) % 1.0


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, turn: tuple[int, ...] = TURN, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """``source, source_size, weight, target`` from ``source, source_size``, one row for each source.

    Targets are proportional to the weights but stop at ``passes`` times the source; what is above
    goes to the others by weight until none is above.  With sources in the order of
    ``passes * size / weight``, a source is full exactly if the words left, shared by the weights
    left, reach its limit, so one pass over the sources is enough.  The table has a row a source.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ranked = sizes.withColumn("_p", place % len(turn))
    weight = F.lit(float(turn[-1]))
    for i, w in enumerate(turn[:-1]):
        weight = F.when(F.col("_p") == i, float(w)).otherwise(weight)
    ranked = ranked.select("source", "source_size", weight.alias("weight"))
    limit = F.col("source_size") * float(passes)
    order = [(limit / F.col("weight")), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum(limit).over(before), F.lit(0.0))
    fair = ranked.withColumn("_level", left / F.sum("weight").over(rest))
    # The level grows with every full source; the first one that is not full sets it for the rest.
    level = F.max(F.when(F.col("_level") * F.col("weight") < limit, F.col("_level")))
    fair = fair.withColumn("_set", level.over(everything))
    got = F.when(F.col("_set").isNull(), limit).otherwise(F.least(limit, F.col("_set") * F.col("weight")))
    return fair.select("source", "source_size", "weight", got.alias("target"))


def schedule(aims: DataFrame, block: int, n_slots: int, work: Workspace) -> DataFrame:
    """``source, rank, slot``: the place in the mix of each block that a source gives.

    Slot t has the point ``t * golden ratio mod 1``, looked up in the cumulative targets; a source's
    slots are counted by chunks of slots, so the hottest source is counted in many tasks.  A source gives
    ``ceil(target / block)`` blocks.  The points miss that by a few; slots above it are left out, and
    blocks that got none come at the end.
    """
    bins = 1024
    whole = Window.orderBy(F.col("source").asc_nulls_last())
    upto = F.sum("target").over(whole.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    allof = F.sum("target").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    spans = aims.withColumn("hi", upto / allof).withColumn("lo", F.col("hi") - F.col("target") / allof)
    spans = spans.where("target > 0").select(
        "source", "lo", "hi", F.ceil(F.col("target") / block).cast("long").alias("quota")
    )
    spans = spans.withColumn(
        "bin", F.explode(F.sequence(F.floor(F.col("lo") * bins), F.least(F.floor(F.col("hi") * bins), F.lit(bins - 1))))
    )
    t = F.col("slot")
    point = (F.floor(t / 65536) * GOLDEN_16 + (t % 65536) * GOLDEN) % 1.0
    slots = work.spark.range(n_slots).withColumnRenamed("id", "slot").withColumn("point", point)
    slots = slots.withColumn("bin", F.floor(F.col("point") * bins))
    given = slots.join(spans, "bin").where("point >= lo and point < hi").select("source", "quota", "slot")
    per_chunk = buckets_for(n_slots)
    ranked = running_offsets(
        given.withColumn("bucket", F.floor(F.col("slot") / per_chunk).cast("long")).withColumn("one", F.lit(1)),
        "one",
        ["source"],
        [F.col("slot")],
        "rank",
    )
    ranked = work.keep(ranked.select("source", "quota", "rank", "slot"), "slots")
    had = ranked.groupBy("source").agg(F.count(F.lit(1)).alias("had")).withColumnRenamed("source", "_s")
    quotas = spans.select("source", "quota").distinct()
    short = quotas.join(had, F.col("source").eqNullSafe(F.col("_s")), "left").withColumn(
        "had", F.coalesce("had", F.lit(0))
    )
    late = short.where("had < quota").select(
        "source", F.explode(F.sequence(F.col("had"), F.col("quota") - 1)).alias("rank")
    )
    late = late.withColumn("slot", F.lit(n_slots) + F.col("rank"))
    return ranked.where("rank < quota").select("source", "rank", "slot").union(late)


def mixed(docs: DataFrame, work: Workspace, block: int = BLOCK_WORDS, key: str = "row") -> tuple[DataFrame, DataFrame]:
    """The mix of ``docs`` (``key``, ``doc_id``, ``source``, ``size`` in words): rows and pieces.

    Every source is shuffled by a hash of ``doc_id`` and ``key`` and read over and over (``PASSES`` at most), cut
    into blocks of ``block`` words; the schedule says which block comes at which slot.  Returns

    * one row for each row of ``docs``, with ``begin`` (its place in its source), ``source_size`` and
      ``target``;
    * one row for each piece that the mix takes: the row's columns, ``pass`` (from 0), ``slot``,
      ``first`` and ``words`` (which words of the document).

    The last block of a source is cut at its target, so a source gives exactly ``floor(target)``
    words.  Rows without words give no pieces.  Repeated rows are rows of their own.
    """
    sizes = work.keep(
        docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")), "sizes"
    )
    totals = sizes.agg(F.sum("source_size").alias("w"), F.sum("rows").alias("r")).first()
    n_words, n_rows = totals.w or 0, totals.r or 0
    aims = work.keep(targets(sizes.select("source", "source_size")), "targets")
    n_slots = -(-int(n_words * SHARE) // block)
    placed = running_offsets(
        # With the row's number, so that rows of one id, or without one, are not all in one bucket.
        docs.withColumn("bucket", hash_bucket(buckets_for(n_rows), F.col("doc_id"), F.col(key))),
        "size",
        ["source"],
        [F.xxhash64("doc_id", key), F.col("doc_id"), F.col(key)],
        "begin",
    )
    named = aims.select(F.col("source").alias("_s"), "source_size", "target")
    placed = placed.join(named, F.col("source").eqNullSafe(F.col("_s"))).drop("_s", "bucket")
    placed = work.keep(placed, "placed")
    parts = placed.where("size > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(PASSES - 1))))
    start = F.col("pass") * F.col("source_size") + F.col("begin")
    stop = F.least(start + F.col("size"), F.floor("target").cast("long"))
    parts = parts.withColumns({"_from": start, "_to": stop}).where("_from < _to")
    parts = parts.withColumn(
        "rank", F.explode(F.sequence(F.floor(F.col("_from") / block), F.floor((F.col("_to") - 1) / block)))
    )
    begin = F.greatest(F.col("_from"), F.col("rank") * block)
    end = F.least(F.col("_to"), (F.col("rank") + 1) * block)
    parts = parts.withColumns({"first": begin - F.col("_from"), "words": end - begin})
    plan = schedule(aims, block, n_slots, work)
    plan = plan.select(F.col("source").alias("_s"), F.col("rank").alias("_r"), "slot")
    pieces = parts.join(plan, F.col("source").eqNullSafe(F.col("_s")) & (F.col("rank") == F.col("_r")))
    return placed, pieces.select(*docs.columns, "begin", "pass", "slot", "first", "words")
