"""Sharding by longest processing time: whole groups go to the least-loaded shard."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import landed, ranked

SHARDS = 40
#: Items of one shard's share: a group of at least a 1000th of a shard is an item of its own,
#: smaller groups are dealt by hash into as many bundles.
ITEMS_PER_SHARD = 1000
ROW_BYTES = 16


def assign(sizes: list[tuple[str, int]], shards: int) -> list[tuple[str, int]]:
    """Longest processing time first: items by falling size (ties by name) onto a heap of loads."""
    loads = [(0, s) for s in range(shards)]
    out = []
    for name, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(loads)
        out.append((name, shard))
        heapq.heappush(loads, (load + size, shard))
    return out


def shard(docs: DataFrame, shards: int = SHARDS, items_per_shard: int = ITEMS_PER_SHARD,
          row_bytes: int = ROW_BYTES, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Give every row a shard, equal texts the same one, with nearly equal bytes per shard.

    Returns doc_id, size (UTF-8 bytes and ``row_bytes``), text_crc32, shard and slot (gapless
    from 0 in its shard).  A schedule of every group would be a list as long as the corpus, so
    the heap gets a bounded number of items, at most ``2 * shards * items_per_shard`` whatever the input:
    groups of a 1000th of a shard or more one by one, the rest in hash bundles of about that size.  The
    result differs from equal bytes by about one item, or by what an indivisible group exceeds a shard.

    Null texts have 0 bytes and form one group, as do empty texts; repeated rows and null ids are kept
    as rows; other columns are ignored; an empty table gives no rows.
    """
    rows = landed(docs.select(F.col(doc_id).alias("doc_id"), *sized(text, row_bytes)), "shard-rows")
    placed = with_shards(rows, shards, items_per_shard)
    return ranked(placed, ["shard"], ["doc_id", "text_crc32", "size"], "slot").select(
        "doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"))


def sized(text: str, row_bytes: int) -> list[Column]:
    return [(F.coalesce(F.octet_length(text), F.lit(0)) + row_bytes).cast("long").alias("size"),
            F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
            F.coalesce(F.sha2(F.col(text).cast("binary"), 256), F.lit("null")).alias("group")]


def with_shards(rows: DataFrame, shards: int, items_per_shard: int) -> DataFrame:
    """``rows`` (with size and group) with their shard in place of the group."""
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    n = shards * items_per_shard
    least = max(1, -(-total // n))
    bundle = F.concat(F.lit("bundle "), F.pmod(F.xxhash64("group"), F.lit(n)).cast("string"))
    name = F.when(F.col("bytes") >= least, F.col("group")).otherwise(bundle)
    items = groups.groupBy(name.alias("item")).agg(F.sum("bytes").alias("bytes"))
    plan = assign([(r.item, r.bytes) for r in items.collect()], shards)
    plan = rows.sparkSession.createDataFrame(plan, "item string, shard int")
    # Two joins with the bounded plan (at most 2 n short rows): a doc's group if it is an item, else its bundle.
    own, packed = (F.broadcast(plan.select(F.col("item").alias(i), F.col("shard").alias(s)))
                   for i, s in (("_own", "_own_shard"), ("_packed", "_packed_shard")))
    kept = [c for c in rows.columns if c != "group"]
    return (rows.join(own, F.col("group") == F.col("_own"), "left").join(packed, bundle == F.col("_packed"), "left")
            .select(*kept, F.coalesce("_own_shard", "_packed_shard").alias("shard")))


def shard_in_order(docs: DataFrame, order: tuple[str, str], shards: int = SHARDS, items_per_shard: int = ITEMS_PER_SHARD,
                   row_bytes: int = ROW_BYTES, text: str = "text") -> DataFrame:
    """Whole rows with size, text_crc32, shard and slot, where the slots of a shard follow an order of the input.

    ``order`` names a stretch of the input (of bounded length, like a file) and a place within it, each row's own.  A row's slot is the
    number of its shard's rows in earlier stretches, and its rank in its own: rows meet by shard and stretch, never by shard alone.
    Columns of ``docs`` named like the new ones give way; nulls, empty and repeated rows as in ``shard``; an empty table gives no rows.
    """
    stretch, place = order
    names = [c for c in docs.columns if c not in (*order, "size", "text_crc32", "shard", "slot")]
    kept = F.struct(*[F.col(f"`{c}`") for c in names]) if names else F.struct(F.lit(0).alias("_"))
    # Texts are read again for the result: what is landed are a few numbers and a digest a row.
    short = landed(docs.select(F.col(stretch).alias("stretch"), F.col(place).alias("place"), *sized(text, row_bytes)), "shard-rows")
    placed = landed(with_shards(short, shards, items_per_shard), "shard-places")
    before = Window.partitionBy("shard").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    first = placed.groupBy("shard", "stretch").agg(F.count("*").alias("n")).withColumn(
        "first", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy("shard", "stretch").orderBy("place")
    slots = placed.withColumn("in", F.row_number().over(inside) - 1).join(first, ["shard", "stretch"]).select(
        "stretch", "place", "size", "text_crc32", "shard", (F.col("first") + F.col("in")).cast("long").alias("slot"))
    rows = docs.select(F.col(stretch).alias("stretch"), F.col(place).alias("place"), kept.alias("row"))
    return rows.join(slots, ["stretch", "place"]).select("row.*", "size", "text_crc32", "shard", "slot")
