"""Shards by fixed virtual slots and a stored map from slot to shard.

A record is hashed, by its key and text, into one of SLOTS slots; that never changes. Which shard a slot belongs to is
a small table, the map, of SLOTS rows per version. It is made from the bytes that each slot holds: slots are given out
by size, the largest first, each to the shard that has the least so far. So shards are near equal in bytes.

As data comes or shards are added or taken away, the map is edited and stored as its next version: every shard keeps its
slots, largest first, up to its fair share, and only the slots beyond it, and those of shards that are gone, are given
out anew. New shards take slots from others; no slot moves between old ones for their sake. Earlier versions stay, so
that what was written under one can be read.

A slot with more than HEAVY of all rows or bytes is spread: its records take their slot from their place in the staged
table instead, as a third of all rows may be one record repeated. The map says which slots are spread.

Everything runs as DataFrame operations. Only tables of SLOTS rows are gathered or broadcast.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adsettle.llm.base import free_name, query, table
from adsettle.session import stage

SLOTS = 4_096
SHARDS = 16
#: Share of all rows or bytes above which a slot of several rows is spread. Fewer than 2 / HEAVY slots can be.
HEAVY = 1 / 256
#: A shard keeps slots up to so many times its fair share when the map is edited.
TOLERANCE = 1.01

MAP = "version int, virtual_slot int, shard int, n_rows long, n_bytes long, spread boolean"


def utf8_size(text: Column) -> Column:
    """Bytes of a text, and one for its end; a null text has none but the end."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def records(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (default: ``key``) and, of each row: size, text_crc32, code (its hash) and place (its
    number in the staged table, with gaps). Staged, so that a row's place is data and a repeated task sees the same."""
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(
        *(keep or [key]),
        utf8_size(F.col(text).cast("string")).alias("size"),
        F.crc32(F.encode(content, "UTF-8")).alias("text_crc32"),
        F.xxhash64(F.col(key), F.col(text)).alias("code"),
        F.monotonically_increasing_id().alias("place"),
    )
    return stage(rows, "records")


def home(code: Column) -> Column:
    return F.pmod(code, F.lit(SLOTS)).cast("int")


def loads(rows: DataFrame, slot: Column) -> DataFrame:
    """(virtual_slot, n_rows, n_bytes) of every slot, empty ones included."""
    own = rows.groupBy(slot.alias("virtual_slot")).agg(F.count("*").alias("n_rows"), F.sum("size").alias("n_bytes"))
    every = rows.sparkSession.range(SLOTS, numPartitions=1).select(F.col("id").cast("int").alias("virtual_slot"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return every.join(own, "virtual_slot", "left").select("virtual_slot", zero("n_rows"), zero("n_bytes"))


def heavy(counted: DataFrame) -> DataFrame:
    """virtual_slot of the slots to be spread."""
    whole = counted.agg(F.sum("n_rows").alias("n_rows"), F.sum("n_bytes").alias("n_bytes")).first()
    over = (F.col("n_rows") > whole.n_rows * HEAVY) | (F.col("n_bytes") > whole.n_bytes * HEAVY)
    return counted.filter(over & (F.col("n_rows") > 1)).select("virtual_slot")


def with_slots(rows: DataFrame, spread: DataFrame) -> DataFrame:
    """``rows`` and the virtual_slot of each. ``spread``: the slots that are spread, fewer than 2 / HEAVY rows."""
    marked = rows.withColumn("virtual_slot", home(F.col("code"))).join(
        F.broadcast(spread.select("virtual_slot", F.lit(True).alias("is_spread"))), "virtual_slot", "left"
    )
    dealt = home(F.xxhash64("code", "place"))
    return marked.withColumn("virtual_slot", F.when(F.col("is_spread"), dealt).otherwise(F.col("virtual_slot"))).drop("is_spread")


def given_out(slots: Column, start: Column, targets) -> Column:
    """Shards of ``slots``, an array of (n_bytes, virtual_slot, shard) by falling size, given out one after the other
    to the shard with the least bytes of those that ``targets(slot, loads)`` leaves, ``loads`` being an array of (n_bytes,
    shard) that begins as ``start``."""
    first = F.struct(start.alias("loads"), F.array().cast("array<int>").alias("shards"))

    def give(state: Column, slot: Column) -> Column:
        least = F.array_min(targets(slot, state["loads"]))
        loaded = F.transform(
            state["loads"],
            lambda x: F.struct(
                (x["n_bytes"] + F.when(x["shard"] == least["shard"], slot["n_bytes"]).otherwise(0)).alias("n_bytes"),
                x["shard"].alias("shard"),
            ),
        )
        return F.struct(loaded.alias("loads"), F.concat(state["shards"], F.array(least["shard"])).alias("shards"))

    return F.aggregate(slots, first, give)["shards"]


def by_size(shard: Column) -> Column:
    """All rows' slots in one array of SLOTS entries at most, by falling size, then number."""
    entry = F.struct((-F.col("n_bytes")).alias("less"), "virtual_slot", "n_bytes", shard.alias("shard"), "n_rows")
    return F.sort_array(F.collect_list(entry))


def spelled_out(given: DataFrame, version: Column) -> DataFrame:
    """(version, virtual_slot, shard, n_rows, n_bytes) from arrays ``slots`` and ``shards`` side by side."""
    one = given.select(version.alias("version"), F.explode(F.arrays_zip("slots", "shards")).alias("x"))
    return one.select(
        "version", "x.slots.virtual_slot", F.col("x.shards").alias("shard"), "x.slots.n_rows", "x.slots.n_bytes"
    )


def empty_shards(shards: int) -> Column:
    return F.array(*[F.struct(F.lit(0).cast("long").alias("n_bytes"), F.lit(s).alias("shard")) for s in range(shards)])


def first_map(counted: DataFrame, spread: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Version 1 of a map for the loads ``counted``."""
    given = counted.agg(by_size(F.lit(0)).alias("slots")).select(
        "slots", given_out(F.col("slots"), empty_shards(shards), lambda slot, loads: loads).alias("shards")
    )
    return marked(spelled_out(given, F.lit(1)), spread)


def marked(made: DataFrame, spread: DataFrame) -> DataFrame:
    """A map with the column that says which slots are spread."""
    told = F.broadcast(spread.select("virtual_slot", F.lit(True).alias("told")))
    return made.join(told, "virtual_slot", "left").select(
        "version", "virtual_slot", "shard", "n_rows", "n_bytes", F.coalesce("told", F.lit(False)).alias("spread")
    )


def edited_map(old: DataFrame, counted: DataFrame, shards: int) -> DataFrame:
    """The next version of the map ``old`` (one version) for new loads or another number of shards.

    Each shard that stays keeps its slots, largest first, as long as they fit its fair share. The others are given to
    the least loaded shard; if shards are added, to the least loaded of the new ones and the slot's own. Spread slots
    stay spread.
    """
    whole = Window.partitionBy("shard").orderBy(F.desc("n_bytes"), "virtual_slot")
    fair = counted.agg(F.sum("n_bytes")).first()[0] / shards * TOLERANCE
    before = old.select("version", "virtual_slot", "shard", "spread")
    state = counted.join(before, "virtual_slot")
    state = state.withColumn("upto", F.sum("n_bytes").over(whole.rowsBetween(Window.unboundedPreceding, 0)))
    state = state.withColumn("stays", (F.col("shard") < shards) & (F.col("upto") <= fair))
    entry = F.struct((-F.col("n_bytes")).alias("less"), "virtual_slot", "n_bytes", "shard", "n_rows")
    lists = state.agg(
        (F.max("version") + 1).alias("version"),
        (F.max("shard") + 1).alias("old_shards"),
        F.sort_array(F.collect_list(F.when(F.col("stays"), entry))).alias("kept"),
        F.sort_array(F.collect_list(F.when(~F.col("stays"), entry))).alias("slots"),
    )
    kept_bytes = lambda s: F.aggregate(
        F.filter("kept", lambda x: x["shard"] == s), F.lit(0).cast("long"), lambda total, x: total + x["n_bytes"]
    )
    start = F.array(*[F.struct(kept_bytes(s).alias("n_bytes"), F.lit(s).alias("shard")) for s in range(shards)])
    added = F.lit(shards) > F.col("old_shards")
    fitting = lambda slot, loads: F.filter(
        loads, lambda x: ~F.col("added") | (x["shard"] >= F.col("old_shards")) | (x["shard"] == slot["shard"])
    )
    given = lists.withColumns({"start": start, "added": added})
    given = given.withColumn("shards", given_out(F.col("slots"), F.col("start"), fitting))
    moved = spelled_out(given.select("version", "slots", "shards"), F.col("version"))
    stayed = given.select("version", F.explode("kept").alias("x")).select(
        "version", "x.virtual_slot", "x.shard", "x.n_rows", "x.n_bytes"
    )
    return marked(moved.unionByName(stayed), before.filter("spread"))


def save_map(version: DataFrame, folder: str, number: int) -> None:
    """Store one version of a map below ``folder``. A version that is there already is never written over."""
    version.coalesce(1).write.mode("error").parquet(f"{folder.rstrip('/')}/version={number}")


def load_map(spark: SparkSession, folder: str, number: int) -> DataFrame:
    return spark.read.schema(MAP).parquet(f"{folder.rstrip('/')}/version={number}")


def sharded(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """``rows`` (of ``records``) with shard, virtual_slot and slot: the row's number within its shard, from 0 without
    gaps.

    Rows are numbered within their virtual slot, which holds a small share of all rows, and every virtual slot begins
    where those before it in its shard end.
    """
    placed = with_slots(rows, slot_map.filter("spread"))
    counted = loads(placed, F.col("virtual_slot")).drop("n_bytes").withColumnRenamed("n_rows", "held")
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_map.join(counted, "virtual_slot").select(
        "virtual_slot", "shard", F.coalesce(F.sum("held").over(before), F.lit(0).cast("long")).alias("first")
    )
    within = Window.partitionBy("virtual_slot").orderBy("code", "place")
    numbered = placed.withColumn("nth", F.row_number().over(within))
    return (
        numbered.join(F.broadcast(starts), "virtual_slot")
        .withColumn("slot", F.col("first") + F.col("nth") - 1)
        .drop("first", "nth")
    )


def shard(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text", folder: str | None = None) -> DataFrame:
    """(key, size, text_crc32, shard, slot, virtual_slot, version) of every row under version 1 of a new map, which is
    stored below ``folder`` if one is named, else staged.

    A null text counts 1 byte and its checksum is that of no bytes. Null keys are keys like any other. Repeated rows
    are all kept, each with a slot of its own. An empty table gives no rows, and a map of empty slots. Other
    columns are not read.
    """
    taken = records(docs, key, text)
    by_home = stage(loads(taken, home(F.col("code"))), "loads")
    spread = stage(heavy(by_home), "spread")
    counted = loads(with_slots(taken, spread), F.col("virtual_slot"))
    made = first_map(counted, spread, shards)
    if folder is None:
        slot_map = stage(made, "slot-map")
    else:
        save_map(made, folder, 1)
        slot_map = load_map(docs.sparkSession, folder, 1)
    return sharded(taken, slot_map).select(
        key, "size", "text_crc32", "shard", "slot", "virtual_slot", F.lit(1).alias("version")
    )


def write_shards(docs: DataFrame, slot_map: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> None:
    """All columns of ``docs`` in a folder per shard, ``shard=0`` and on, a file for each part of a shard's slots. A row
    of a spread slot is dealt by its place in ``docs``, which has to be a stored table."""
    code, place, slot, is_spread, shard_ = (free_name(docs, c) for c in ("code", "place", "virtual_slot", "is_spread", "shard"))
    taken = docs.withColumns({code: F.xxhash64(F.col(key), F.col(text)), place: F.monotonically_increasing_id()})
    spread = slot_map.filter("spread").select(F.col("virtual_slot").alias(slot), F.lit(True).alias(is_spread))
    homes = taken.withColumn(slot, home(F.col(code))).join(F.broadcast(spread), slot, "left")
    dealt = homes.withColumn(slot, F.when(F.col(is_spread), home(F.xxhash64(code, place))).otherwise(F.col(slot)))
    to = slot_map.select(F.col("virtual_slot").alias(slot), F.col("shard").alias(shard_))
    rows = dealt.join(F.broadcast(to), slot).drop(code, place, is_spread)
    rows.repartition(F.col(slot)).drop(slot).write.partitionBy(shard_).parquet(path)


def moved_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """(shard, new_shard, n_slots, n_bytes) of the slots that differ between two versions, sizes as in the new one."""
    other = new.select("virtual_slot", F.col("shard").alias("new_shard"), "n_bytes")
    both = old.select("virtual_slot", "shard").join(other, "virtual_slot").filter("shard != new_shard")
    return both.groupBy("shard", "new_shard").agg(F.count("*").alias("n_slots"), F.sum("n_bytes").alias("n_bytes"))


@query()
def op13_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document, and its place there, so that shards are near equal in bytes."""
    found = shard(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "version",
    )
