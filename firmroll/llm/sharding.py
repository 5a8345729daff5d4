"""Sharding by fixed virtual slots.

Method: every record is hashed into one of a few thousand slots, whatever the number of shards. Bytes are summed per
slot, and a stored, versioned map says which shard holds a slot. The first version deals the slots, largest first, each
to the shard with the fewest bytes. Later versions only edit it: a slot stays where it is unless its shard holds more
than its fair part; what such shards give up goes to the emptiest ones.

Equal texts share a slot and therefore a shard, unless they alone are so many bytes that no even division could hold
them together: those few groups are spread over all slots by record.

All of it is DataFrame and SQL functions. The map has one row per slot; only its own fold over the slots is a single
row, of a size that does not depend on the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from firmroll.llm.common import stored, text_or_empty
from firmroll.sources.storage import scratch_path

SLOTS = 4096
SHARDS = 8
# A group of equal texts is spread if it holds more than this part of a shard's fair bytes.
SPREAD_PART = 0.5
# An edited map leaves a shard alone until it holds this much more than its fair bytes.
TOLERANCE = 0.02
MAP_TYPE = "slot long, bytes long, shard int"


def records(docs: DataFrame) -> DataFrame:
    """The narrow columns that everything else needs; texts are read once and never move."""
    text = text_or_empty().cast("binary")
    return docs.select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text_or_empty()).alias("text_hash"),
    )


def with_slots(rows: DataFrame, slots: int = SLOTS, shards: int = SHARDS, part: float = SPREAD_PART) -> DataFrame:
    """Add ``vslot``. Fewer than ``shards / part`` groups can be large enough to be spread, so their list is small."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    groups = rows.groupBy("text_hash").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    large = groups.where((F.col("n") > 1) & (F.col("bytes") > total * part / shards)).select(
        "text_hash", F.lit(True).alias("spread")
    )
    together = F.pmod(F.xxhash64("text_hash"), F.lit(slots))
    apart = F.pmod(F.xxhash64("doc_id", "text_hash", "row"), F.lit(slots))
    return (
        rows.withColumn("row", F.monotonically_increasing_id())
        .join(F.broadcast(large), "text_hash", "left")
        .withColumn("vslot", F.when(F.col("spread"), apart).otherwise(together))
        .drop("row", "spread")
    )


def slot_bytes(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Bytes of every slot, 0 for empty ones."""
    used = rows.groupBy(F.col("vslot").alias("slot")).agg(F.sum("size").alias("bytes"))
    every = rows.sparkSession.range(slots).withColumnRenamed("id", "slot")
    return every.join(used, "slot", "left").select("slot", F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"))


def _deal(sized: Column, loads: Column) -> Column:
    """Fold (bytes, slot) structs, given in order, over the shards: each goes to the one with the least load."""

    def step(state: Column, item: Column) -> Column:
        shard = F.array_position(state["loads"], F.array_min(state["loads"])).cast("int") - 1
        added = F.transform(state["loads"], lambda load, i: F.when(i == shard, load + item["bytes"]).otherwise(load))
        placed = F.struct(item["slot"].alias("slot"), item["bytes"].alias("bytes"), shard.alias("shard"))
        return F.struct(added.alias("loads"), F.concat(state["map"], F.array(placed)).alias("map"))

    empty = F.array().cast("array<struct<slot:bigint,bytes:bigint,shard:int>>")
    start = F.struct(loads.alias("loads"), empty.alias("map"))
    return F.aggregate(sized, start, step)["map"]


def _no_load(shards: int) -> Column:
    return F.array_repeat(F.lit(0).cast("long"), shards)


def _largest_first() -> Column:
    """All slots as one array, by bytes descending, then slot."""
    listed = F.collect_list(F.struct((-F.col("bytes")).alias("less"), F.col("slot")))
    return F.transform(F.sort_array(listed), lambda x: F.struct((-x["less"]).alias("bytes"), x["slot"].alias("slot")))


def first_map(sizes: DataFrame, shards: int = SHARDS) -> DataFrame:
    """slot, bytes, shard: largest slots first, each to the shard with the fewest bytes, the lowest among equals."""
    return sizes.agg(_largest_first().alias("s")).select(F.inline(_deal(F.col("s"), _no_load(shards)))).select(
        "slot", "bytes", "shard"
    )


def rebalanced(old: DataFrame, sizes: DataFrame, shards: int, tolerance: float = TOLERANCE) -> DataFrame:
    """Edit a map: slots, largest first, stay while their shard has room; the others go to the emptiest shards."""
    joined = sizes.join(old.select("slot", F.col("shard").alias("old")), "slot", "left")
    fair = F.sum("bytes").over(Window.partitionBy()) * (1 + tolerance) / shards
    upto = F.sum("bytes").over(Window.partitionBy("old").orderBy(F.desc("bytes"), "slot"))
    first = F.row_number().over(Window.partitionBy("old").orderBy(F.desc("bytes"), "slot")) == 1
    marked = joined.withColumn(
        "stays", F.coalesce((F.col("old") < shards) & ((upto <= fair) | first), F.lit(False))
    )
    staying = marked.where("stays").select("slot", "bytes", F.col("old").cast("int").alias("shard"))
    known = {r["shard"]: r["b"] for r in staying.groupBy("shard").agg(F.sum("bytes").alias("b")).collect()}
    loads = F.array(*[F.lit(known.get(i, 0)).cast("long") for i in range(shards)])
    moved = marked.where("not stays").agg(_largest_first().alias("s")).select(F.inline(_deal(F.col("s"), loads)))
    return staying.unionByName(moved.select("slot", "bytes", "shard"))


def write_map(slot_map: DataFrame, folder: str, version: int) -> None:
    """Store one version; an existing version is never replaced."""
    slot_map.coalesce(1).write.mode("errorifexists").parquet(f"{folder}/version={version}")


def read_map(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """A stored version, by default the newest."""
    versions = spark.read.schema(f"{MAP_TYPE}, version int").parquet(folder)
    if version is None:
        version = versions.agg(F.max("version")).first()[0]
    return versions.where(F.col("version") == version).select("slot", "bytes", "shard")


def placed(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Add ``shard`` and the gapless place within it, ``slot``.

    Rows are numbered by (virtual slot, task that read them): a window over each such part, whose rows one scan task
    has held already, and the summed counts of the parts before it in the shard.
    """
    numbered = rows.join(F.broadcast(slot_map.select(F.col("slot").alias("vslot"), "shard")), "vslot")
    numbered = stored(
        numbered.withColumn("part", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id()), "placed"
    )
    counts = numbered.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("shard", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("part", "shard").orderBy("row"))
    ranked = numbered.withColumn("within", within).join(before, ["part", "shard"])
    return ranked.withColumn("slot", (F.col("before") + F.col("within") - 1).cast("long"))


def shard(docs: DataFrame, shards: int = SHARDS, folder: str | None = None, slots: int = SLOTS) -> DataFrame:
    """Every row with its place: doc_id, size, text_crc32, law, shard, slot, grown_shard, vslot, map_version.

    The law is ``bytes``: sizes per shard are near equal. The map is version 1 of ``folder``, or the next version,
    edited from the newest, if ``folder`` has maps already (give the folder of earlier runs). A null text has size 1;
    a null doc_id and repeated rows are records like any other; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "slot-map")
    rows = stored(with_slots(stored(records(docs), "records"), slots, shards), "slots")
    sizes = slot_bytes(rows, slots)
    version = newest_version(spark, folder) + 1
    slot_map = first_map(sizes, shards) if version == 1 else rebalanced(read_map(spark, folder), sizes, shards)
    write_map(slot_map, folder, version)
    return placed(rows, read_map(spark, folder, version)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "vslot", F.lit(version).alias("map_version"),
    )


def newest_version(spark: SparkSession, folder: str) -> int:
    """0 if the folder holds no map yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return 0
    found = [s.getPath().getName() for s in system.listStatus(path)]
    return max((int(name.partition("=")[2]) for name in found if name.startswith("version=")), default=0)
