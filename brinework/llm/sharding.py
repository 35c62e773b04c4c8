"""Sharding by fixed virtual slots and a versioned slot-to-shard map. Built-in functions only.

A record's virtual slot is a hash of its key and never changes. The bytes of each slot are summed,
and a stored map places every slot on a shard. Its first version deals the slots out in turn;
``rebalance`` makes the next version by editing the last one, from the bytes that the slots hold:
slots stay where they are up to a fair share, and the others go, largest first, to the shard that
holds least. A change of the number of shards is the same edit.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brinework.llm.common import checkpoint, shared_folder

SLOTS = 4096
SHARDS = 16
#: Rows of a virtual slot that one task puts in order; a slot with more is cut into parts.
PART_ROWS = 1_000_000
#: A table of this many places at most is broadcast.
MAX_BROADCAST_ROWS = 200_000


def slot_of(slots: int, *key: Column) -> Column:
    """Virtual slot of a key; a null counts as the empty string."""
    digest = F.md5(F.concat_ws(" ", *[F.coalesce(k.cast("string"), F.lit("")) for k in key]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % slots


def first_map(spark: SparkSession, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Version 1 of a map: (version, slot, shard), the slots dealt out in turn."""
    return spark.range(slots).select(F.lit(1).alias("version"), F.col("id").alias("slot"), (F.col("id") % shards).cast("int").alias("shard"))


def slot_bytes(records: DataFrame, slot: str = "virtual_slot", size: str = "size") -> DataFrame:
    """(slot, bytes, rows) of each slot that holds a record."""
    return records.groupBy(F.col(slot).alias("slot")).agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("rows"))


def _to_least(loads: Column, movers: Column) -> Column:
    """The shard of each of the movers (bytes, slot): in order, the shard that holds least, of equals the first."""

    def place(state: Column, mover: Column) -> Column:
        least = F.array_position(state["loads"], F.array_min(state["loads"])).cast("int") - 1
        grown = F.transform(state["loads"], lambda load, shard: load + F.when(shard == least, mover["bytes"]).otherwise(F.lit(0)))
        return F.struct(grown.alias("loads"), F.concat(state["to"], F.array(least)).alias("to"))

    start = F.struct(loads.alias("loads"), F.array().cast("array<int>").alias("to"))
    return F.aggregate(movers, start, place, lambda state: state["to"])


def rebalance(slots: DataFrame, held: DataFrame, shards: int) -> DataFrame:
    """Edits a map (version, slot, shard) by the bytes held (slot, bytes): (version + 1, slot, shard).

    Each shard keeps slots, largest first, while they sum to its fair share at most; a shard that is
    no longer there keeps none. The others move, largest first, each to the shard that then holds
    least. Slots without records stay if their shard does. Only the few thousand slots are windowed
    and listed, never records.
    """
    w = Window.partitionBy("shard").orderBy(F.desc("bytes"), "slot")
    known = slots.join(held.select("slot", "bytes"), "slot", "left").withColumn("bytes", F.coalesce("bytes", F.lit(0)))
    total = known.agg(F.sum("bytes").alias("all_bytes"))
    placed = known.crossJoin(F.broadcast(total)).withColumn(
        "stays", (F.col("shard") < shards) & ((F.col("bytes") == 0) | (F.sum("bytes").over(w) * shards <= F.col("all_bytes")))
    )
    load = [F.sum(F.when(F.col("stays") & (F.col("shard") == s), F.col("bytes")).otherwise(0)) for s in range(shards)]
    movers = F.collect_list(F.when(~F.col("stays"), F.struct((-F.col("bytes")).alias("minus"), "slot", "bytes")))
    moved = (
        placed.groupBy("version")
        .agg(F.array(*load).alias("loads"), F.sort_array(movers).alias("movers"))
        .withColumn("to", _to_least(F.col("loads"), F.col("movers")))
        .select("version", F.explode(F.arrays_zip("movers", "to")).alias("m"))
        .select("version", "m.movers.slot", F.col("m.to").alias("shard"))
    )
    return placed.where("stays").select("version", "slot", "shard").unionByName(moved).select((F.col("version") + 1).alias("version"), "slot", "shard")


def edited_map(held: DataFrame, shards: int, slots: int, folder: str) -> DataFrame:
    """The newest version of the map in a folder, (version, slot, shard), after an edit by the bytes held.

    A folder without a map gets version 1 and its edit; else the last version is edited. Every
    version stays, in a partition of its own, so that an earlier placement can be read again.
    """
    spark = held.sparkSession
    try:
        last = spark.read.schema("slot bigint, shard int, version int").parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        last = first_map(spark, shards, slots)
        new = last.unionByName(rebalance(last, held, shards))
    else:
        newest = last.agg(F.max("version").alias("v")).first().v  # one number
        new = rebalance(last.where(F.col("version") == newest), held, shards)
    new.coalesce(1).write.partitionBy("version").mode("append").parquet(folder)  # a row for each slot
    kept = spark.read.schema("slot bigint, shard int, version int").parquet(folder)
    return kept.where(F.col("version") == kept.agg(F.max("version").alias("v")).first().v)


def assign(records: DataFrame, shards: int = SHARDS, slots: int = SLOTS, id_col: str = "doc_id", text: str = "text", maps: str | None = None) -> DataFrame:
    """One row per record: (id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, version).

    The law is ``bytes``: the sizes of the shards are as near to equal as whole virtual slots allow,
    by the newest version of the map that is stored in the folder ``maps`` (a new one in the shared
    folder, if none is given); a map that is there already is edited, whether bytes or the number of
    shards changed, and only the slots that must move do. size is the UTF-8 bytes of the text plus one (null: one), text_crc32 the checksum
    of the text (null: of nothing), slot the record's place in its shard, without gaps from 0, in
    order of virtual slot, id, checksum and size (part by part within virtual slots of more than
    PART_ROWS rows); grown_shard is null under this law. Repeated rows get a
    place each, an empty table gives an empty one, other columns are not read. The virtual slot is a
    hash of id, checksum and size, so rows that share an id or a null one spread too. Places come
    from counts per part of a virtual slot and a row number inside it.
    """
    raw = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    rows = records.select(F.col(id_col).alias("id"), (F.length(raw) + 1).cast("bigint").alias("size"), F.crc32(raw).alias("text_crc32"))
    rows = rows.withColumn("virtual_slot", slot_of(slots, F.col("id"), F.col("text_crc32"), F.col("size")))
    held = checkpoint(slot_bytes(rows))
    folder = maps or f"{shared_folder(records.sparkSession)}/slot-map-{uuid.uuid4().hex}"
    stored = edited_map(held, shards, slots, folder).withColumnRenamed("slot", "virtual_slot")
    parts = -(-(held.agg(F.max("rows")).first()[0] or 1) // PART_ROWS)
    # parts of a slot follow the order of ids only where there is one part
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id", "text_crc32", "size"), F.lit(parts)))
    counts = held.select(F.col("slot").alias("virtual_slot"), F.lit(0).cast("bigint").alias("part"), "rows") if parts == 1 else rows.groupBy("virtual_slot", "part").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("shard").orderBy("virtual_slot", "part")
    places = stored.join(counts, "virtual_slot").withColumn("first", F.sum("rows").over(before) - F.col("rows")).drop("rows")
    inside = Window.partitionBy("virtual_slot", "part").orderBy("id", "text_crc32", "size")
    return (
        rows.withColumn("place", F.row_number().over(inside).cast("bigint") - 1)
        .join(F.broadcast(places) if slots * parts <= MAX_BROADCAST_ROWS else places, ["virtual_slot", "part"])
        .select(
            F.col("id").alias(id_col),
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            F.col("shard").cast("int").alias("shard"),
            (F.col("first") + F.col("place")).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "virtual_slot",
            F.col("version").cast("int").alias("version"),
        )
    )
