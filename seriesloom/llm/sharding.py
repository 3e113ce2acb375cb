"""Longest-processing-time scheduling of groups of rows onto shards.

Groups that must stay together are sorted by size and go to the least loaded shard through
a heap. A list of all groups would not fit a driver, so only groups larger than
total / (shards * grain) are listed one by one (at most shards * grain of them); smaller
ones first travel in bundles of about that size, of which there are as many. The schedule
is therefore a bounded list at every scale, and a shard is off by about 1 / grain at most.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from seriesloom.llm.base import cut_lineage, register, table

#: Rows numbered by one task at most, about.
SLICE_ROWS = 50_000


def longest_first(sizes: list[tuple[int, object]], shards: int) -> dict:
    """{item: shard}: larger items first, each to the shard with the least so far."""
    heap = [(0, s) for s in range(shards)]
    placed = {}
    for size, item in sorted(sizes, key=lambda x: (-x[0], x[1])):
        load, shard = heapq.heappop(heap)
        placed[item] = shard
        heapq.heappush(heap, (load + size, shard))
    return placed


def assign_shards(
    rows: DataFrame,
    group: str,
    size: str,
    order: str,
    shards: int,
    grain: int = 2048,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """`rows` with shard int and slot long (gapless from 0 within a shard).

    Rows of one `group` (nulls are one group) share a shard; `size` is a long that is not
    null; `order` orders the rows within a unit of the schedule. An empty table gives an
    empty result; repeated rows are separate rows; other columns are carried along, and
    names that begin with "__" are reserved.
    """
    spark = rows.sparkSession
    key = F.sha2(F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit("-")), 256)
    rows = cut_lineage(rows.withColumn("__key", F.unhex(key)))
    groups = cut_lineage(
        rows.groupBy("__key").agg(F.sum(size).alias("__bytes"), F.count(F.lit(1)).alias("__rows"))
    )
    total, count = groups.agg(F.sum("__bytes"), F.count(F.lit(1))).first()
    if not count:
        return rows.drop("__key").withColumns(
            {"shard": F.lit(0), "slot": F.lit(0).cast("long")}
        )
    most = shards * grain
    limit = max(1, total // most)

    heavy = groups.where(F.col("__bytes") > limit)
    buckets = max(1, min(count // 20_000, most // 8))
    spread = Window.partitionBy("__bucket").orderBy(F.desc("__bytes"), "__key")
    light = (
        groups.where(F.col("__bytes") <= limit)
        .withColumn("__bucket", F.pmod(F.xxhash64("__key"), F.lit(buckets)))
        .withColumn(
            "__before",
            F.sum("__bytes").over(spread.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__bytes"),
        )
        .withColumn("__bundle", F.floor(F.col("__before") / F.lit(limit)))
        .select(
            "__key", "__bytes", "__rows",
            F.concat_ws(":", F.col("__bucket"), F.col("__bundle")).alias("__unit"),
        )
    )
    light = cut_lineage(light)
    heavy = heavy.withColumn("__unit", F.lower(F.hex("__key")))
    units = (
        heavy.select("__unit", "__bytes", "__rows")
        .unionByName(light.select("__unit", "__bytes", "__rows"))
        .groupBy("__unit")
        .agg(F.sum("__bytes").alias("b"), F.sum("__rows").alias("r"))
    )
    # At most about 2 * shards * grain + buckets units, whatever the table holds.
    listed = units.collect()
    placed = longest_first([(u["b"], u["__unit"]) for u in listed], shards)
    plan = spark.createDataFrame(
        [(u["__unit"], n, placed[u["__unit"]], max(1, -(-u["r"] // slice_rows))) for n, u in enumerate(sorted(listed, key=lambda u: u["__unit"]))],
        T.StructType(
            [
                T.StructField("__unit", T.StringType()),
                T.StructField("__number", T.IntegerType()),
                T.StructField("shard", T.IntegerType()),
                T.StructField("__slices", T.LongType()),
            ]
        ),
    )
    plan = F.broadcast(plan)  # bounded as above
    whole = heavy.select("__key", "__unit").join(plan, "__unit").drop("__unit")
    mixed = light.select("__key", "__unit").join(plan, "__unit").drop("__unit")
    # A hot group is heavy, and heavy groups are few: their rows need no shuffle by key.
    near = rows.join(F.broadcast(whole), "__key")
    rest = rows.join(F.broadcast(whole.select("__key")), "__key", "left_anti").join(mixed, "__key")
    dealt = near.unionByName(rest).withColumn(
        "__slice", F.pmod(F.xxhash64(F.col(order), F.lit(7)), F.col("__slices"))
    )
    return number_rows(dealt, ["__number", "__slice"], order).drop(
        "__key", "__slice", "__slices", "__number"
    )


def number_rows(rows: DataFrame, unit: list[str], order: str | Column) -> DataFrame:
    """slot: gapless from 0 within `shard`; only rows of one unit meet in a task."""
    counts = rows.groupBy("shard", *unit).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("shard").orderBy(*unit).rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        "shard", *unit, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base")
    )
    within = Window.partitionBy("shard", *unit).orderBy(order)
    return (
        rows.withColumn("__rank", F.row_number().over(within))
        .join(bases, ["shard", *unit])
        .withColumn("slot", F.col("__base") + F.col("__rank") - 1)
        .drop("__rank", "__base", "__n")
    )


@register("op4_sharding")
def op4_sharding(spark, sf_dir):
    """All documents into 24 shards of near equal bytes; equal texts share a shard.

    A null text has no bytes, the CRC of the empty text, and is a group apart from it.
    """
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.when(F.col("text").isNotNull(), F.sha2(F.col("text"), 256)).alias("text_sha"),
    )
    out = assign_shards(rows, "text_sha", "size", "doc_id", shards=24)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
