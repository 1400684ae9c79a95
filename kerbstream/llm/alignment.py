"""Which tokens of two tokenizers cover the same bytes of a text.

*Merging in lockstep.* Every token ends at a byte offset of its text. A pointer into A's ends and
one into B's walk along a text; the one behind moves on, and where both ends are equal the text is
cut: the A tokens and B tokens since the last cut form a group, and each of its A tokens is linked
with each of its B tokens. Here one NumPy state vector holds the pointers of all texts of a batch,
and each step moves all of them at once, emits the cuts of that step with the ranges of tokens
they link, and drops the texts that are finished. Texts of more than ``LANE`` tokens enter as
several lanes, each from an offset where both tokenizers were found to end a token, so the steps
of a batch are bounded by the lane and not by its longest text.

*Counts.* A pair of ids counts the documents that hold it linked. The counts are an aggregate
over the pairs of all documents. Links get their counts back by a join: the most frequent pairs,
``BROADCAST_PAIRS`` at most and all of those above some count, are broadcast, since they make up
most links and would be hot keys; all other links are shuffled, and none of those has a pair of
many documents. Nothing is dropped on either way.

Tokens of A are made with the ranks of its vocabulary file, whose merges have the order of the
vocabulary; tests compare them with the file's own library. Long texts are cut where neither
tokenizer can join what is on both sides, and put together again.

Defined cases: null and empty texts have no tokens, nor have texts that either tokenizer does not
give back byte by byte (one that holds U+2581 itself); all their numbers are 0. Repeated rows and
ids each count as a document and give a row each. A text, with its distinct linked pairs, is held
by one task. An empty table gives an empty result. Of the table's columns only ``keep`` is
returned, so others may have any name.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbstream.llm.bpe import TreeCodec
from kerbstream.llm.common import file_bytes, sliced
from kerbstream.llm.token_counts import PieceCounter
from kerbstream.session import materialise

LANE = 512  # A tokens of a lane, about
TRIES = 32  # ends looked at for a lane to begin
PART_CHARS = 16_384
BATCH_BYTES = 2 << 20
BATCH_LINKS = 4 << 20  # links expanded at once, but for a longer document
LARGE_GROUP = 1 << 12  # links of a group beyond which its equal tokens are counted first
BROADCAST_PAIRS = 1 << 19  # 24 bytes each
SHIFT = 32  # a pair of ids as one number: A's above B's

NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]
RESULT = ("n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "pairs array<long>, links array<long>")


# ---- tokens ---------------------------------------------------------------------------------

def byte_characters() -> dict[str, int]:
    """What a byte-level vocabulary writes for each byte: printable ones stand for themselves,
    the others for the code points from 256 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_level_ranks(data: bytes) -> dict[bytes, int]:
    """A vocabulary file's tokens as bytes, without its special ones."""
    described = json.loads(data)
    special = {token["content"] for token in described["added_tokens"]}
    bytes_of = byte_characters()
    return {bytes(bytes_of[c] for c in token): i
            for token, i in described["model"]["vocab"].items() if token not in special}


class ByteEncoder:
    """A: ids of a text with a space before it."""

    # No match of the pattern goes on from one of these characters into a space.
    safe = re.compile(r"(?<=[0-9A-Za-z.,;:!?]) ")

    def __init__(self, data: bytes, pattern: str, part_chars: int = PART_CHARS):
        ranks = byte_level_ranks(data)
        self.plain = tiktoken.Encoding(
            "bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.tree = TreeCodec(ranks, pattern)
        self.part_chars = part_chars
        self.tokens = [b""] * (1 + max(ranks.values()))
        for token, i in ranks.items():
            self.tokens[i] = token

    def encode(self, text: str) -> np.ndarray:
        parts, start, text = [], 0, f" {text}"
        while len(text) - start > self.part_chars:
            cut = self.safe.search(text, start + self.part_chars // 2, start + self.part_chars)
            if cut is None:
                return self.tree.encode(text)
            parts.append(text[start:cut.start()])
            start = cut.start()
        ids = [self.plain.encode_to_numpy(part, disallowed_special=())
               for part in (*parts, text[start:])]
        return ids[0] if len(ids) == 1 else np.concatenate(ids)


class PieceEncoder:
    """B: ids of texts, cut where ``PieceCounter`` proves it safe."""

    def __init__(self, model: bytes, part_chars: int = PART_CHARS):
        self.counter = PieceCounter(model, part_chars)
        encoder = self.counter.encoder
        self.tokens = []
        for i in range(encoder.get_piece_size()):
            piece = encoder.id_to_piece(i)
            self.tokens.append(bytes([int(piece[3:5], 16)]) if encoder.is_byte(i)
                               else piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        out, parts, owners = [[] for _ in texts], [], []
        for i, text in enumerate(texts):
            for part, off in self.counter.parts(text):
                parts.append(part)
                owners.append((i, off))
        ids = self.counter.encoder.encode(parts, num_threads=1) if parts else []
        for (i, off), found in zip(owners, ids):
            out[i] = out[i] + found[off:] if out[i] else found[off:]
        return out


# ---- merging --------------------------------------------------------------------------------

def lanes(ends_a: np.ndarray, ends_b: np.ndarray, starts_a: np.ndarray, starts_b: np.ndarray,
          lane: int = LANE, tries: int = TRIES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where pointers begin in A and in B, and where in A they stop. ``starts_*`` are the first
    tokens of each text and, at the end, the number of tokens; texts without tokens get no
    lane. Inside a text, a lane begins behind an A token whose end is a B token's end too."""
    has = np.diff(starts_a) > 0
    firsts, lasts = starts_a[:-1][has], starts_a[1:][has]
    many = (lasts - firsts - 1) // lane
    first = np.repeat(firsts, many)
    nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + 1
    wanted, limit = first + nth * lane - 1, np.repeat(lasts, many) - 1
    found_a, found_b = [], []
    for _ in range(min(tries, lane)):
        inside = wanted < limit
        wanted, limit = wanted[inside], limit[inside]
        if not len(wanted):
            break
        at = np.searchsorted(ends_b, ends_a[wanted])
        common = ends_b[at] == ends_a[wanted]
        found_a.append(wanted[common] + 1)
        found_b.append(at[common] + 1)
        wanted, limit = wanted[~common] + 1, limit[~common]
    begin_a = np.concatenate([firsts, *found_a])
    order = np.argsort(begin_a)
    begin_a = begin_a[order]
    begin_b = np.concatenate([starts_b[:-1][has], *found_b])[order]
    return begin_a, begin_b, np.append(begin_a[1:], starts_a[-1:])


def cuts(ends_a: np.ndarray, ends_b: np.ndarray, begin_a: np.ndarray, begin_b: np.ndarray,
         stop_a: np.ndarray) -> np.ndarray:
    """The groups in order, as rows (first A token, end of A tokens, first B token, end of B
    tokens). All lanes take each step together."""
    at_a, at_b, stop = begin_a.copy(), begin_b.copy(), stop_a
    from_a, from_b = begin_a.copy(), begin_b.copy()
    emitted = [np.empty((0, 4), np.int64)]
    while len(at_a):
        end_a, end_b = ends_a[at_a], ends_b[at_b]
        at_a += end_a <= end_b
        at_b += end_b <= end_a
        cut = np.flatnonzero(end_a == end_b)
        if len(cut):
            a, b = at_a[cut], at_b[cut]
            emitted.append(np.stack([from_a[cut], a, from_b[cut], b], 1))
            from_a[cut], from_b[cut] = a, b
            left = at_a < stop
            if not left.all():
                at_a, at_b, stop = at_a[left], at_b[left], stop[left]
                from_a, from_b = from_a[left], from_b[left]
    groups = np.concatenate(emitted)
    return groups[np.argsort(groups[:, 0])]


# ---- links ----------------------------------------------------------------------------------

def _expanded(groups: np.ndarray, a_ids: np.ndarray, b_ids: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray]:
    """(group, pair) of each link, for groups of moderate size."""
    p, q = groups[:, 1] - groups[:, 0], groups[:, 3] - groups[:, 2]
    n = p * q
    group = np.repeat(np.arange(len(groups)), n)
    k = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
    a = a_ids[groups[group, 0] + k // q[group]]
    b = b_ids[groups[group, 2] + k % q[group]]
    return group, (a.astype(np.int64) << SHIFT) | b


def _counted(group: np.ndarray, a_ids: np.ndarray, b_ids: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of one large group, and their links."""
    a, times_a = np.unique(a_ids[group[0]:group[1]], return_counts=True)
    b, times_b = np.unique(b_ids[group[2]:group[3]], return_counts=True)
    pairs = (a.astype(np.int64)[:, None] << SHIFT) | b
    return pairs.ravel(), np.outer(times_a, times_b).ravel()


def linked_pairs(groups: np.ndarray, docs: np.ndarray, a_ids: np.ndarray, b_ids: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, pair, links), ordered, one row per document and distinct pair; ``docs`` names
    each group's document."""
    n = (groups[:, 1] - groups[:, 0]) * (groups[:, 3] - groups[:, 2])
    large = np.flatnonzero(n > LARGE_GROUP)
    usual = np.flatnonzero(n <= LARGE_GROUP)
    group, pairs = _expanded(groups[usual], a_ids, b_ids)
    owner, links = docs[usual][group], np.ones(len(pairs), np.int64)
    if len(large):
        more = [_counted(groups[g], a_ids, b_ids) for g in large]
        owner = np.concatenate([owner, *[np.full(len(x), docs[g]) for g, (x, _) in zip(large, more)]])
        pairs = np.concatenate([pairs, *[x for x, _ in more]])
        links = np.concatenate([links, *[y for _, y in more]])
    order = np.lexsort((pairs, owner))
    owner, pairs, links = owner[order], pairs[order], links[order]
    new = np.flatnonzero(np.append(True, (np.diff(owner) != 0) | (np.diff(pairs) != 0))[:len(pairs)])
    return owner[new], pairs[new], np.add.reduceat(links, new) if len(new) else links


class Aligner:
    def __init__(self, a_file: bytes, pattern: str, b_file: bytes, lane: int = LANE,
                 part_chars: int = PART_CHARS):
        self.a, self.b = ByteEncoder(a_file, pattern, part_chars), PieceEncoder(b_file, part_chars)
        self.lane = lane
        self.table_a, self.table_b = pa.array(self.a.tokens), pa.array(self.b.tokens)
        self.size_a = np.array([len(t) for t in self.a.tokens])
        self.size_b = np.array([len(t) for t in self.b.tokens])
        # Ids as they stand in a written group: 2 * id, or one more for the last of its side;
        # B's follow A's.
        self.written = pa.array(
            [f"{i}{end}" for i in range(len(self.a.tokens)) for end in ",|"]
            + [f"{i}{end}" for i in range(len(self.b.tokens)) for end in ",;"])

    @staticmethod
    def _laid_end_to_end(table: pa.Array, ids: np.ndarray) -> bytes:
        found = table.take(pa.array(ids))
        return found.buffers()[2].to_pybytes() if len(found) else b""

    def _tokens(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        none = np.empty(0, np.int64)
        a = [self.a.encode(t).astype(np.int64) if t else none for t in texts]
        b = [np.array(ids, np.int64) for ids in self.b.encode([t or "" for t in texts])]
        for i, text in enumerate(texts):
            data = f" {text}".encode() if text else b""
            if (self._laid_end_to_end(self.table_a, a[i]) != data
                    or self._laid_end_to_end(self.table_b, b[i]) != data):
                a[i] = b[i] = none
        return a, b

    def __call__(self, texts: list[str | None]) -> list[pa.Array]:
        """The columns of ``RESULT`` for a batch of texts."""
        a, b = self._tokens(texts)
        starts_a = np.cumsum([0, *map(len, a)])
        starts_b = np.cumsum([0, *map(len, b)])
        a_ids, b_ids = (np.concatenate([np.empty(0, np.int64), *x]) for x in (a, b))
        ends_a, ends_b = np.cumsum(self.size_a[a_ids]), np.cumsum(self.size_b[b_ids])
        groups = cuts(ends_a, ends_b, *lanes(ends_a, ends_b, starts_a, starts_b, self.lane))
        docs = np.searchsorted(starts_a, groups[:, 0], "right") - 1
        p, q = groups[:, 1] - groups[:, 0], groups[:, 3] - groups[:, 2]
        first = np.searchsorted(docs, np.arange(len(texts) + 1))
        links = np.append(0, np.cumsum(p * q))
        pairs, times, sizes = self._pairs(groups, docs, first, links, a_ids, b_ids)
        offsets = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
        return [pa.array(np.diff(starts_a)), pa.array(np.diff(starts_b)), pa.array(np.diff(first)),
                pa.array(links[first[1:]] - links[first[:-1]]),
                pa.array(self._digests(groups, a_ids, b_ids, starts_a, starts_b), pa.string()),
                pa.ListArray.from_arrays(offsets, pa.array(pairs)),
                pa.ListArray.from_arrays(offsets, pa.array(times))]

    def _pairs(self, groups, docs, first, links, a_ids, b_ids):
        """Pairs and links of all documents, and how many pairs each has, from some documents
        at a time."""
        pairs, times = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        sizes, at, end = np.zeros(len(first) - 1, np.int64), 0, len(first) - 1
        while at < end:
            until = int(np.searchsorted(links[first], links[first[at]] + BATCH_LINKS, "right")) - 1
            until = min(max(until, at + 1), end)
            some = slice(first[at], first[until])
            owner, found, count = linked_pairs(groups[some], docs[some], a_ids, b_ids)
            pairs.append(found)
            times.append(count)
            sizes += np.bincount(owner, minlength=len(sizes))
            at = until
        return np.concatenate(pairs), np.concatenate(times), sizes

    def _digests(self, groups, a_ids, b_ids, starts_a, starts_b) -> list[str]:
        """Each text's groups as ``a1,a2|b1;a3|b2,b3``, hashed; '' for no tokens."""
        codes = np.empty(len(a_ids) + len(b_ids), np.int64)
        p, q = groups[:, 1] - groups[:, 0], groups[:, 3] - groups[:, 2]
        last_a, last_b = np.zeros(len(a_ids), np.int64), np.zeros(len(b_ids), np.int64)
        last_a[groups[:, 1] - 1] = 1
        last_b[groups[:, 3] - 1] = 1
        codes[np.arange(len(a_ids)) + np.repeat(groups[:, 2], p)] = 2 * a_ids + last_a
        codes[np.arange(len(b_ids)) + np.repeat(groups[:, 1], q)] = (
            2 * (len(self.a.tokens) + b_ids) + last_b)
        out = []
        for begin, end in zip(starts_a[:-1] + starts_b[:-1], starts_a[1:] + starts_b[1:]):
            text = self._laid_end_to_end(self.written, codes[begin:end])[:-1]
            out.append(hashlib.sha256(text).hexdigest() if text else "")
        return out


@functools.lru_cache(maxsize=2)
def _aligner(a_file: bytes, pattern: str, b_file: bytes) -> Aligner:
    return Aligner(a_file, pattern, b_file)


# ---- Spark ----------------------------------------------------------------------------------

def aligned(docs: DataFrame, a_path: str, pattern: str, b_path: str, text: str = "text",
            keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``; n_a and n_b tokens, n_groups, n_links; groups_sha256; and the linked id
    pairs (A's id times 2^32 plus B's) with the links of each."""
    hand_out = docs.sparkSession.sparkContext.broadcast
    a_file, b_file = hand_out(file_bytes(a_path)), hand_out(file_bytes(b_path))
    chosen = docs.select(*keep, F.col(text).alias("_text"))
    result = T.StructType(
        [*chosen.schema.fields[:-1], *T.StructType.fromDDL(RESULT).fields])

    def run(batches):
        align = _aligner(a_file.value, pattern, b_file.value)
        for batch in (part for whole in batches for part in sliced(whole, BATCH_BYTES)):
            *kept, texts = batch.columns
            yield pa.RecordBatch.from_arrays([*kept, *align(texts.to_pylist())],
                                             names=result.names)

    return chosen.mapInArrow(run, result)


def pair_counts(alignments: DataFrame) -> DataFrame:
    """(pair, documents, best) for each linked id pair: how many documents hold it, and whether
    no pair of the same A id is in more."""
    counted = (alignments.select(F.explode("pairs").alias("pair")).groupBy("pair")
               .agg(F.count("*").alias("documents"))
               .withColumn("a", F.shiftright("pair", SHIFT)))
    most = counted.groupBy("a").agg(F.max("documents").alias("most"))
    return counted.join(most, "a").select(
        "pair", "documents", (F.col("documents") == F.col("most")).alias("best"))


def frequent_from(counts: DataFrame, limit: int) -> int | None:
    """The lowest number of documents such that at most ``limit`` pairs have as many or more;
    None if there is none. Eight steps per power of two reach the driver."""
    step = F.floor(F.log2("documents") * 8).alias("step")
    rows = (counts.groupBy(step).agg(F.count("*").alias("pairs"), F.min("documents").alias("least"))
            .orderBy(F.desc("step")).collect())
    held, least = 0, None
    for row in rows:
        held += row.pairs
        if held > limit:
            break
        least = row.least
    return least


def link_counts(alignments: DataFrame, counts: DataFrame, row: str,
                broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """(row, n_best, count_sum) of each row that has links. Both inputs must be stored."""
    links = alignments.select(row, F.posexplode("pairs").alias("_at", "pair"), "links").select(
        row, "pair", F.get("links", F.col("_at")).alias("links"))

    def summed(found: DataFrame) -> DataFrame:
        return found.groupBy(row).agg(
            F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
            F.sum(F.col("links") * F.col("documents")).alias("count_sum"))

    least = frequent_from(counts, broadcast_pairs)
    if least is None:
        return summed(links.join(counts.hint("merge"), "pair"))
    frequent = F.broadcast(counts.filter(F.col("documents") >= least))
    both = summed(links.join(frequent, "pair"))
    if least > 1:
        rest = links.join(frequent.select("pair"), "pair", "left_anti")
        rare = counts.filter(F.col("documents") < least)
        both = both.unionByName(summed(rest.join(rare.hint("merge"), "pair")))
    return both.groupBy(row).agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def alignments_with_counts(docs: DataFrame, a_path: str, pattern: str, b_path: str,
                           text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                           broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Columns ``keep``, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    numbered = docs.select(
        *keep, F.col(text).alias("_text"), F.monotonically_increasing_id().alias("_row"))
    stored = materialise(
        aligned(numbered, a_path, pattern, b_path, "_text", (*keep, "_row")), "alignments")
    counts = materialise(pair_counts(stored), "pair-counts")
    sums = link_counts(stored, counts, "_row", broadcast_pairs)
    zero = F.lit(0).cast("long")
    return stored.select(*keep, "_row", *NUMBERS, "groups_sha256").join(
        sums, "_row", "left").select(
        *keep, *NUMBERS, F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
