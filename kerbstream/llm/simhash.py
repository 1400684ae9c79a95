"""SimHash near-duplicates by vantage-point trees.

Fingerprints are points of a metric space, the Hamming distance between 64-bit numbers. A
vantage-point tree splits them by their distance d to a chosen one: inside if d <= t, else
outside. If two points differ in at most k bits, their distances to the vantage point differ by
at most k, so of two points that a split separates the inner one has d > t - k and the outer one
d <= t + k. That is the triangle bound which prunes branches, and it is all that is needed:

1. A small tree over a bounded sample fixes the shards. Each fingerprint has one home shard.
   Where a split may separate it from partners, the inner point of the pair visits the outer
   branch as a copy, and copies visit every shard their ball overlaps. So each linked pair
   meets in exactly one shard, the home of one of them.
2. In a shard, home points and visitors go down a tree of their own in the same way, all at once,
   until few enough are left to compare each with each.
3. A shard with too many points for one task (a tight ball, which no vantage point splits) is
   cut into blocks by hash, and each pair of blocks is a task of its own.
4. A task returns its links as a forest, not as pairs: no more links than points.
5. The forests' connected components are the groups.

The sample only decides how even the shards are; the result is exact with any tree.

Texts are compared through their distinct fingerprints, so exact copies, however many, cost one
point. Nothing but the sample and the counts reaches the driver.

Defined cases: null and empty texts have fingerprint zero and link like any other; repeated rows
are documents of their own; rows without an id take part but name no group, so a group in
which no row has an id has a null component_id; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbstream.llm.common import map_texts, whole_row
from kerbstream.llm.components import components
from kerbstream.session import materialise

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42

SAMPLE_PER_SHARD = 64  # fingerprints that shape the tree of shards
MAX_SAMPLE = 1 << 18  # and all of them, 8 bytes each; larger shards are cut into blocks instead
SHARD_ROWS = 4096  # home fingerprints of a shard, until there are SHARDS of them
SHARDS = 16  # more only when shards would pass LARGE_SHARD: each level of splits adds copies
LARGE_SHARD = 1 << 18
LARGE_VISITS = 1 << 21  # visitors of a shard that one task compares with its home points
LEAF_ROWS = 256  # compared each with each
BLOCK = 1 << 16  # shingles whose bits are counted at once
PAIR_BLOCK = 1 << 20  # links held before they are reduced to a forest


# ---- fingerprints ---------------------------------------------------------------------------

def fingerprint(data: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The SimHash of a UTF-8 text, as a signed 64-bit number.

    ``bytes.lower`` changes A-Z only and ``bytes.split`` cuts at ASCII white space only, which
    is what the definition asks for.
    """
    words = (data or b"").lower().split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = ends - np.fromiter(map(len, words), np.int64, len(words)) - 1
    last = min(shingle_words, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED)
              for a, b in zip(starts[:len(words) - last].tolist(), (ends[last:] - 1).tolist())]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        block = np.array(hashes[at:at + BLOCK], "<u8")
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Columns ``keep`` and the fingerprint (long) of each whole text."""
    return map_texts(docs, list(keep), text, "fingerprint long",
                     lambda texts: [[fingerprint(t, shingle_words) for t in texts]], binary=True)


def as_hex(fingerprint_column: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint_column)), 16, "0")


# ---- the tree of shards ---------------------------------------------------------------------

@dataclass
class Split:
    vantage: np.uint64
    bound: int
    inside: "Split | int"  # a number is a shard
    outside: "Split | int"


def _distances(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage)


def _choose(points: np.ndarray, max_bits: int, tries: int = 8) -> tuple[np.uint64, int] | None:
    """A vantage point and bound that separate ``points`` with few near the bound.

    Candidates are taken at even steps. A bound's cost is the share of points that would have to
    go both ways, and how uneven it is. None if no candidate separates a tenth of the points.
    """
    best, cost = None, np.inf
    at_most = points if len(points) <= 2048 else points[:: len(points) // 2048]
    for vantage in at_most[:: max(1, len(at_most) // tries)]:
        below = np.cumsum(np.bincount(_distances(at_most, vantage), minlength=72)) / len(at_most)
        for bound in range(64):
            inner = below[bound]
            if 0.1 <= inner <= 0.9:
                near = inner - (below[bound - max_bits] if bound >= max_bits else 0)
                score = near + abs(inner - 0.5)
                if score < cost:
                    best, cost = (vantage, bound), score
    return best


def shard_tree(sample: np.ndarray, shards: int, max_bits: int = MAX_BITS) -> Split | int:
    """Split until there are ``shards``, dealt to both sides by their points, or nothing can be
    separated."""
    number = iter(range(shards))

    def grow(points: np.ndarray, leaves: int):
        chosen = _choose(points, max_bits) if leaves > 1 and len(points) > 1 else None
        if chosen is None:
            return next(number)
        vantage, bound = chosen
        inner = _distances(points, vantage) <= bound
        share = min(max(1, round(leaves * float(inner.mean()))), leaves - 1)
        return Split(vantage, bound, grow(points[inner], share), grow(points[~inner], leaves - share))

    return grow(sample, shards)


def route(tree: Split | int, points: np.ndarray, max_bits: int = MAX_BITS
          ) -> Iterator[tuple[int, np.ndarray, bool]]:
    """(shard, points, whether it is their home) for a batch of points."""
    todo = [(tree, points, True)]
    while todo:
        node, group, home = todo.pop()
        if not len(group):
            continue
        if not isinstance(node, Split):
            yield node, group, home
            continue
        d = _distances(group, node.vantage).astype(np.int16)
        if home:
            todo += [(node.inside, group[d <= node.bound], True),
                     (node.outside, group[d > node.bound], True),
                     (node.outside, group[(d <= node.bound) & (d > node.bound - max_bits)], False)]
        else:
            todo += [(node.inside, group[d <= node.bound + max_bits], False),
                     (node.outside, group[d > node.bound - max_bits], False)]


# ---- inside a shard -------------------------------------------------------------------------

def linked(home: np.ndarray, visitors: np.ndarray, max_bits: int = MAX_BITS, within: bool = True
           ) -> tuple[np.ndarray, np.ndarray]:
    """A forest over points (home first, then visitors) whose trees hold all links that
    have a home point at one end: (node, root) for each node that is not a root. Without
    ``within`` only those that have a visitor at the other."""
    points = np.concatenate([home, visitors])
    labels = np.arange(len(points))
    held: list[tuple[np.ndarray, np.ndarray]] = []
    count = 0

    def reduce() -> None:
        nonlocal count
        if held:
            _merge_labels(labels, np.concatenate([a for a, _ in held]),
                          np.concatenate([b for _, b in held]))
            held.clear()
            count = 0

    def compare(a: np.ndarray, b: np.ndarray) -> None:
        nonlocal count
        step = max(1, PAIR_BLOCK // max(1, len(b)))
        for at in range(0, len(a), step):
            block = a[at:at + step]
            i, j = np.nonzero(
                np.bitwise_count(points[block][:, None] ^ points[b][None, :]) <= max_bits)
            held.append((block[i], b[j]))
            count += len(i)
            if count > PAIR_BLOCK:
                reduce()

    todo = [(np.arange(len(home)), np.arange(len(home), len(points)))]
    while todo:
        own, others = todo.pop()
        if not len(own) or not (within or len(others)):
            continue
        chosen = _choose(points[own], max_bits) if len(own) > LEAF_ROWS else None
        if chosen is None:
            if within:
                compare(own, own)
            compare(others, own)
            continue
        vantage, bound = chosen
        d = _distances(points[own], vantage).astype(np.int16)
        e = _distances(points[others], vantage).astype(np.int16)
        near = own[(d <= bound) & (d > bound - max_bits)] if within else own[:0]
        todo.append((own[d <= bound], others[e <= bound + max_bits]))
        todo.append((own[d > bound], np.concatenate([others[e > bound - max_bits], near])))
    reduce()
    nodes = np.nonzero(labels != np.arange(len(points)))[0]
    return points[nodes], points[labels[nodes]]


def _merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of linked nodes: each takes the smaller root, until all agree."""
    while True:
        x, y = labels[a], labels[b]
        differ = x != y
        if not differ.any():
            return
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels[:] = up


# ---- the operator ---------------------------------------------------------------------------

def near_links(distinct: DataFrame, max_bits: int = MAX_BITS, shard_rows: int = SHARD_ROWS
               ) -> DataFrame:
    """(a, b): links between distinct fingerprints whose components are the near-duplicates."""
    rows = distinct.count()
    shards = max(min(-(-rows // shard_rows), SHARDS), -(-rows // LARGE_SHARD))
    wanted = min(shards * SAMPLE_PER_SHARD, MAX_SAMPLE)
    sample = _sample(distinct, rows, wanted) if shards > 1 else np.empty(0, np.uint64)
    tree = distinct.sparkSession.sparkContext.broadcast(
        shard_tree(sample, max(shards, 1), max_bits))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points = batch["fingerprint"].to_numpy(np.int64).view(np.uint64)
            for shard, group, home in route(tree.value, points, max_bits):
                yield pd.DataFrame({"shard": np.int32(shard), "home": home,
                                    "fingerprint": group.view(np.int64)})

    def join(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        values = group["fingerprint"].to_numpy(np.int64).view(np.uint64)
        home = group["home"].to_numpy(bool)
        a, b = linked(values[home], values[~home], max_bits, key[1] == key[2])
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = materialise(distinct.select("fingerprint").mapInPandas(
        deal, "shard int, home boolean, fingerprint long"), "dealt")
    return tiles(dealt, LARGE_SHARD, LARGE_VISITS).groupBy(
        "shard", "first", "second").applyInPandas(join, "a long, b long")


def tiles(dealt: DataFrame, home_rows: int, visits: int) -> DataFrame:
    """``dealt`` (shard, home, fingerprint) with first and second, the blocks whose points a task
    compares; first alone if both are equal.

    A shard of more than ``home_rows`` home points or ``visits`` visitors is cut into blocks of
    about so many, home points first. A point goes to the tasks of all home blocks, a home point
    to those of all visitors as well; ``home`` tells whether it is on the first side.
    """
    part = lambda n, most: F.greatest(F.lit(1), F.ceil(n / F.lit(float(most))).cast("int"))
    cut = materialise(dealt.groupBy("shard").agg(
        part(F.count_if("home"), home_rows).alias("_homes"),
        part(F.count_if(~F.col("home")), visits).alias("_visits")).filter(
        "_homes > 1 OR _visits > 1"), "cut-shards")
    if not cut.limit(1).count():
        return dealt.withColumns({"first": F.lit(0), "second": F.lit(0)})
    cut_rows = dealt.join(F.broadcast(cut), "shard").withColumn("_block", F.pmod(  # a row per shard
        F.xxhash64("fingerprint"), F.when(F.col("home"), F.col("_homes")).otherwise(
            F.col("_visits"))).cast("int"))
    pair = lambda a, b: F.struct(a.alias("first"), b.alias("second"))
    block, homes = F.col("_block"), F.col("_homes")
    each = lambda n, make: F.transform(F.sequence(F.lit(0), n - 1), make)
    tasks = F.when(F.col("home"), F.concat(
        each(homes, lambda k: pair(F.least(block, k), F.greatest(block, k))),
        each(F.col("_visits"), lambda v: pair(block, homes + v)))).otherwise(
        each(homes, lambda k: pair(k, homes + block)))
    tiled = cut_rows.withColumn("_task", F.explode(tasks)).select(
        "shard", (F.col("home") & (block == F.col("_task.first"))).alias("home"), "fingerprint",
        "_task.first", "_task.second")
    whole = dealt.join(F.broadcast(cut), "shard", "left_anti").withColumns(
        {"first": F.lit(0), "second": F.lit(0)})
    return whole.unionByName(tiled)


def _sample(distinct: DataFrame, rows: int, size: int) -> np.ndarray:
    """About ``size`` of the fingerprints, by hash. They shape the tree and decide nothing
    else."""
    chosen = distinct.filter(F.pmod(
        F.xxhash64("fingerprint"), F.lit(max(1, rows // size))) == 0)
    found = chosen.select("fingerprint").limit(2 * size).toArrow()
    return found["fingerprint"].to_numpy().astype(np.int64).view(np.uint64)


def near_groups(prints: DataFrame, max_bits: int = MAX_BITS, shard_rows: int = SHARD_ROWS
                ) -> DataFrame:
    """One row per distinct fingerprint of ``prints`` (doc_id, fingerprint): doc_id, the
    smallest that has it; its group's smallest fingerprint and smallest doc_id."""
    distinct = materialise(
        prints.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id")), "distinct")
    found = components(near_links(distinct, max_bits, shard_rows))
    labelled = materialise(distinct.join(
        found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "doc_id", F.coalesce("component", "fingerprint").alias("group_print")),
        "labelled")
    # Written, so that the join sees a plain shuffle on both sides and can split a large group.
    named = materialise(labelled.groupBy("group_print").agg(
        F.min("doc_id").alias("component_id")), "named")
    return materialise(labelled.join(named, "group_print"), "groups")


def near_duplicates(docs: DataFrame, text: str = "text", shingle_words: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of each document."""
    prints = materialise(fingerprints(docs, text, ("doc_id",), shingle_words), "prints")
    groups = near_groups(prints, max_bits).select("fingerprint", "component_id")
    return prints.join(groups, "fingerprint").select(
        "doc_id", as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, text: str = "text", shingle_words: int = SHINGLE_WORDS,
                max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id.

    Documents are written once with their fingerprint, which is dearer to compute again than
    to read, and with a number. The number of the row that stays is found on numbers, ids and
    fingerprints alone, so texts are shuffled once, by a key that no two rows share. Rows
    without an id come last in their group.
    """
    whole = docs.select(whole_row(docs).alias("row"), "doc_id", F.col(text).alias("text"))
    marked = materialise(whole.select(
        "row", "doc_id", F.monotonically_increasing_id().alias("number"),
        _fingerprint_of(shingle_words)(F.col("text").cast("binary")).alias("fingerprint")),
        "marked")
    groups = near_groups(marked.select("doc_id", "fingerprint"), max_bits)
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "number")
    # One row per fingerprint first, so that copies are reduced before they meet.
    first = materialise(marked.groupBy("fingerprint").agg(F.min(place).alias("place")), "places")
    stays = first.join(groups.select("fingerprint", "group_print"), "fingerprint").groupBy(
        "group_print").agg(F.min("place")["number"].alias("number"))
    return marked.join(stays.select("number"), "number", "left_semi").select("row.*")


def _fingerprint_of(shingle_words: int):
    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t, shingle_words) for t in texts.to_pylist()], pa.int64())

    return of
