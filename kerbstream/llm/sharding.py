"""Sharding by fixed virtual slots.

A row's virtual slot is a hash of its id and does not change. Which shard holds a slot is read
from a small table (version, slot, shard, bytes, rows), which rebalancing edits: a new version
moves only the slots it must. Bytes and rows are aggregated per slot before anything else, so the
table has as many rows as there are slots, whatever the data; only this table is handled outside
Spark. Copies of one text have different ids and so spread over all slots.

A slot cannot be divided between shards, so no id may outweigh one. Where a slot holds twice the
average, ids of several rows that hold an average slot's bytes or more are looked for; there can be no more
of them than slots. Their rows are dealt by id, checksum, size and, among equal ones, a number, so
they too fall evenly into all slots. The same holds for the texts of rows without an id.

Defined cases: a null text has size 1 and checksum 0; rows without an id take the slot of their
text; repeated rows are rows of their own, however many; a very long text is one row and stays
whole; rows that tie in all values are interchangeable; an empty table gives an empty result and a
map whose slots are dealt in turn. Other columns of the table are not read, so they may have any
name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbstream.session import materialise, shared_dir

# "Thousands of slots": one slot is a small part of a shard, and their table fits anywhere.
SLOTS = 4096
MAX_SLOTS = 1 << 16
COPIES = 100_000  # equal rows that are made from their count at once

MAP_SCHEMA = "version int, slot int, shard int, bytes long, rows long"


@dataclass(frozen=True)
class Slot:
    slot: int
    shard: int
    bytes: int
    rows: int


def virtual_slot(hashed: Column, slots: int = SLOTS) -> Column:
    if not 0 < slots <= MAX_SLOTS:
        raise ValueError(f"slots must be from 1 to {MAX_SLOTS}")
    return F.pmod(hashed, F.lit(slots)).cast("int").alias("virtual_slot")


def measured(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 1), text_crc32, key (the hash of the id, or of the text where
    there is no id) and virtual_slot of each row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.when(F.col("doc_id").isNull(), F.xxhash64(text)).otherwise(F.xxhash64("doc_id"))
    return docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        key.alias("key"), virtual_slot(key, slots))


def spread(rows: DataFrame, loads: dict[int, tuple[int, int]], slots: int = SLOTS
           ) -> DataFrame | None:
    """``rows`` with the rows of crowded keys dealt over all slots; None if there are no such keys.

    Only rows of overfull slots are grouped by key. Equal rows are counted, not listed, so a
    crowd of any size is a few numbers until its rows are made again from their counts, some at
    a time in each task.
    """
    average = sum(size for size, _ in loads.values()) / slots
    overfull = [slot for slot, (size, n) in loads.items() if n > 1 and size > 2 * average]
    if not overfull:
        return None
    held = rows.filter(F.col("virtual_slot").isin(overfull)).groupBy("key").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("n"))
    # Each holds a slot's share of all bytes or more, so there are no more of them than slots.
    crowded = F.broadcast(materialise(
        held.filter((F.col("n") > 1) & (F.col("bytes") >= average)).select("key"), "crowded"))
    equal = rows.join(crowded, "key", "left_semi").groupBy(
        "doc_id", "size", "text_crc32", "key").agg(F.count("*").alias("n"))
    parts = equal.select("*", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES))).alias("part"))
    parts = parts.repartition("key", "text_crc32", "size", "part")
    copies = parts.select("*", F.explode(F.sequence(
        F.lit(0).cast("long"),
        F.least(F.lit(COPIES), F.col("n") - F.col("part") * COPIES) - 1)).alias("copy"))
    number = F.col("part") * COPIES + F.col("copy")
    dealt = copies.select("doc_id", "size", "text_crc32", "key", virtual_slot(
        F.xxhash64("key", "text_crc32", "size", number), slots))
    return rows.join(crowded, "key", "left_anti").select(dealt.columns).unionByName(dealt)


def slot_loads(rows: DataFrame) -> DataFrame:
    """Bytes and rows of each slot; each task sends one row per slot at most."""
    return rows.groupBy(F.col("virtual_slot").alias("slot")).agg(
        F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def _loads(rows: DataFrame) -> dict[int, tuple[int, int]]:
    """One entry per slot: at most MAX_SLOTS."""
    return {r.slot: (r.bytes, r.rows) for r in slot_loads(rows).collect()}


def first_map(loads: dict[int, tuple[int, int]], shards: int, slots: int = SLOTS) -> list[Slot]:
    """Slots dealt to shards in turn, before their loads are known to matter."""
    return [Slot(i, i % shards, *loads.get(i, (0, 0))) for i in range(slots)]


def with_loads(slot_map: list[Slot], loads: dict[int, tuple[int, int]]) -> list[Slot]:
    """The same map with newly counted loads."""
    return [Slot(s.slot, s.shard, *loads.get(s.slot, (0, 0))) for s in slot_map]


def rebalanced(slot_map: list[Slot], shards: int) -> list[Slot]:
    """An edited map whose shards hold nearly equal bytes.

    While some move makes the fullest and the emptiest shard more alike, the largest slot that
    fits into half their difference goes from the one to the other; when none fits, a pair of
    slots is exchanged that narrows the difference most. Slots of shards that are not
    overfull stay where they are. ``shards`` may be larger than before: new shards start
    empty, so slots only move into them until they are as full as the others.
    """
    if shards < 1 + max((s.shard for s in slot_map), default=0):
        raise ValueError("a map can't lose shards; move their slots first")
    held: dict[int, list[Slot]] = {i: [] for i in range(shards)}
    for s in slot_map:
        held[s.shard].append(s)
    load = {i: sum(s.bytes for s in held[i]) for i in held}
    shard_of = {s.slot: s.shard for s in slot_map}
    for i in held:
        held[i].sort(key=lambda s: (s.bytes, s.slot))

    for _ in range(len(slot_map) * 4):
        full = max(load, key=lambda i: (load[i], -i))
        empty = min(load, key=lambda i: (load[i], i))
        gap = load[full] - load[empty]
        move = _best_move(held[full], held[empty], gap)
        if move is None:
            break
        out, back = move
        for s, a, b in ((out, full, empty), (back, empty, full)):
            if s is not None:
                held[a].remove(s)
                held[b].append(s)
                held[b].sort(key=lambda s: (s.bytes, s.slot))
                load[a] -= s.bytes
                load[b] += s.bytes
                shard_of[s.slot] = b
    return [Slot(s.slot, shard_of[s.slot], s.bytes, s.rows) for s in slot_map]


def _best_move(full: list[Slot], empty: list[Slot], gap: int) -> tuple[Slot, Slot | None] | None:
    """The slot to move, and one to get back or None, that bring the difference closest to 0."""
    best, left = None, gap
    sizes = [s for s in full if 0 < s.bytes < gap]
    for s in sizes:
        if abs(gap - 2 * s.bytes) < left:
            best, left = (s, None), abs(gap - 2 * s.bytes)
    if best is not None:
        return best
    for a in full:  # no single slot helps: exchange two
        for b in empty:
            after = abs(gap - 2 * (a.bytes - b.bytes))
            if a.bytes > b.bytes and after < left:
                best, left = (a, b), after
        if left <= 1:
            break
    return best


def write_map(spark: SparkSession, slot_map: list[Slot], version: int, path: str) -> None:
    """Add a version; earlier ones stay readable."""
    rows = [(version, s.slot, s.shard, s.bytes, s.rows) for s in slot_map]
    (spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1)
     .write.mode("overwrite").parquet(f"{path}/v={version}"))


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(MAP_SCHEMA).parquet(f"{path}/v={version}")


def latest_map(spark: SparkSession, path: str) -> tuple[int, list[Slot]] | None:
    """The newest version at ``path`` and its slots, or None. A version without rows, of a write
    that broke off, does not count."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in files.listStatus(folder)] if files.exists(folder) else []
    for version in sorted((int(n[2:]) for n in names if n[:2] == "v=" and n[2:].isdigit()),
                          reverse=True):
        rows = read_map(spark, path, version).orderBy("slot").collect()  # at most MAX_SLOTS
        if rows:
            return version, [Slot(r.slot, r.shard, r.bytes, r.rows) for r in rows]
    return None


def sharded(docs: DataFrame, shards: int, slots: int = SLOTS,
            map_path: str | None = None) -> DataFrame:
    """Each row's shard by bytes, and its place in the shard.

    Version 1 of the map deals slots in turn, version 2 is rebalanced by the counted bytes. If
    ``map_path`` holds a map, its latest version gets the new bytes and is rebalanced, also to more
    shards, as the next version; slots that need not move stay. Without a path the map is new.
    Within a slot rows are numbered by (doc_id, text_crc32, size); a slot's first number is the
    rows of the shard's earlier slots, which the map knows. So no task numbers a whole shard.
    """
    spark = docs.sparkSession
    path = map_path or shared_dir(spark, "slot-map")
    rows = materialise(measured(docs, slots), "measured")  # read twice; texts only once
    loads = _loads(rows)
    dealt = spread(rows, loads, slots)
    if dealt is not None:
        rows = materialise(dealt, "spread")
        loads = _loads(rows)
    version, stored = latest_map(spark, path) or (1, None)
    if stored is None:
        start = first_map(loads, shards, slots)
        write_map(spark, start, 1, path)
    elif len(stored) != slots:
        raise ValueError(f"the map at {path} has {len(stored)} slots, not {slots}")
    else:
        start = with_loads(stored, loads)
    write_map(spark, rebalanced(start, shards), version + 1, path)

    in_shard = Window.partitionBy("shard").orderBy("slot").rowsBetween(
        Window.unboundedPreceding, -1)
    placed = read_map(spark, path, version + 1).select(
        F.col("slot").alias("virtual_slot"), "shard",
        F.coalesce(F.sum("rows").over(in_shard), F.lit(0)).alias("_before"))
    in_slot = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("_row", F.row_number().over(in_slot))
            .join(F.broadcast(placed), "virtual_slot")  # at most MAX_SLOTS rows
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("_before") + F.col("_row") - 1).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), "virtual_slot"))
