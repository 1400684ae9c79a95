"""Byte-level BPE as a tree reduction.

Encoding is a monoid: a text is halved until a leaf has at most ``LEAF_CHARS`` characters, leaves
are encoded alone, and two neighbours are joined by encoding a window around their boundary
again. The window grows until what lies outside provably stays as it is.

*Pieces.* The pattern cuts a text from left to right, and where it cuts next depends only on the
text from there on, at most ``LOOK`` characters beyond the start of a piece or one beyond its
end. So the left neighbour keeps the pieces that end ``LOOK`` characters before its end; from
there the window is cut again, and as soon as a cut falls on the start of one of the right
neighbour's pieces, with ``LOOK`` characters to spare, all later cuts are the right neighbour's.

*Tokens of a piece.* A long piece is halved as well. Tokens t1..tn are the encoding of a piece if
every pair (ti, ti+1), encoded on its own, gives the pair back: merges go by rank, the leftmost
first, so the first merge across any boundary would also be the first one in the encoding of that
pair alone, which has none. When two halves are joined, the tokens around the boundary are
encoded again, and more of them until both pairs at the window's edges are stable.

Decoding joins the bytes of halves.

Defined cases: null and empty texts have no tokens and decode to no bytes; ids outside the
vocabulary are an error.
"""

from __future__ import annotations

import base64
import functools
import heapq
from array import array

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbstream.llm.common import file_bytes, map_texts, sliced

LEAF_CHARS = 2048
LEAF_PIECE = 256  # characters of a piece that are encoded at once
LEAF_IDS = 4096
SLICE_IDS = 1 << 21  # ids decoded at once, but for a longer document
# The longest thing the pattern looks for beside runs is a three-character ending ("'re").
LOOK = 3
# Encoded pieces remembered by each Python worker, some 100 bytes each.
CACHED_PIECES = 200_000
CACHED_CHARS = 40  # longer pieces are rarely met again


class TreeCodec:
    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf_chars: int = LEAF_CHARS,
                 leaf_piece: int = LEAF_PIECE):
        self.ranks = ranks
        self.cut = regex.compile(pattern).findall
        self.leaf_chars, self.leaf_piece = max(leaf_chars, 1), max(leaf_piece, 1)
        self.leaf = tiktoken.Encoding(
            "leaf", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = [b""] * (1 + max(ranks.values()))
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.token_table = pa.array(self.bytes_of, pa.binary())
        self.cached = _Cache(self)
        self.stable = functools.lru_cache(maxsize=100_000)(self._stable)

    # ---- a text ---------------------------------------------------------------------

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, as 32-bit integers."""
        return np.frombuffer(b"".join(map(self.cached.__getitem__, self.pieces(text))), np.int32)

    def pieces(self, text: str) -> list[str]:
        """The pattern's cuts, by halves."""
        if len(text) <= self.leaf_chars:
            return self.cut(text)
        middle = len(text) // 2
        return self._join(self.pieces(text[:middle]), self.pieces(text[middle:]))

    def _join(self, left: list[str], right: list[str]) -> list[str]:
        window, taken = "", 0
        while left and len(window) < LOOK:
            window = left.pop() + window
        grow = 2
        while True:
            more = right[taken:taken + grow]
            starts = len(window)  # where the next of the right neighbour's pieces begins
            window += "".join(more)
            taken, grow = taken + len(more), grow * 2
            cuts = self.cut(window)
            if taken == len(right):
                return left + cuts + right[taken:]
            wanted, at = {}, starts
            for i, piece in enumerate(more):
                wanted[at] = taken - len(more) + i
                at += len(piece)
            at = 0
            for i, piece in enumerate(cuts):
                if at in wanted and at + LOOK <= len(window):
                    left += cuts[:i]
                    left += right[wanted[at]:]
                    return left
                at += len(piece)

    # ---- a piece --------------------------------------------------------------------

    def tokens(self, piece: str) -> list[int]:
        if len(piece) <= self.leaf_piece:
            return self.leaf.encode_ordinary(piece)
        middle = len(piece) // 2
        return self._join_tokens(self.tokens(piece[:middle]), self.tokens(piece[middle:]))

    def _join_tokens(self, left: list[int], right: list[int]) -> list[int]:
        size = 1
        while True:
            kept, rest = left[:-size], right[size:]
            if len(left) <= size:
                kept = []
            inside = left[len(kept):] + right[:len(right) - len(rest)]
            window = self.merge(b"".join([self.bytes_of[i] for i in inside]))
            if ((not kept or self.stable(kept[-1], window[0]))
                    and (not rest or self.stable(window[-1], rest[0]))):
                return kept + window + rest
            size *= 2

    def _stable(self, a: int, b: int) -> bool:
        return self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]

    def merge(self, data: bytes) -> list[int]:
        """Merge adjacent parts, lowest rank first and leftmost among equals, until none is in
        the vocabulary. Parts are linked by position; the heap drops entries of parts that
        have changed since."""
        n, ranks = len(data), self.ranks
        after = list(range(1, n + 1))  # where the part that starts here ends
        before = list(range(-1, n - 1))  # where the previous part starts
        heap = []

        def offer(at: int) -> None:
            end = after[at]
            if end < n:
                rank = ranks.get(data[at:after[end]])
                if rank is not None:
                    heapq.heappush(heap, (rank, at, after[end]))

        for at in range(n - 1):
            offer(at)
        while heap:
            _, at, end = heapq.heappop(heap)
            middle = after[at]
            if middle < 0 or middle >= n or after[middle] != end:
                continue
            after[at] = end
            after[middle] = -1
            if end < n:
                before[end] = at
                offer(at)
            if before[at] >= 0:
                offer(before[at])
        out, at = [], 0
        while at < n:
            out.append(ranks[data[at:after[at]]])
            at = after[at]
        return out

    # ---- back -----------------------------------------------------------------------

    def decode(self, ids: np.ndarray) -> bytes:
        """A leaf's tokens are looked up in one step, which lays them end to end."""
        if len(ids) <= LEAF_IDS:
            if len(ids) and (ids.min() < 0 or ids.max() >= len(self.bytes_of)):
                raise ValueError("an id outside the vocabulary")
            found = self.token_table.take(pa.array(ids))
            return found.buffers()[2].to_pybytes() if len(found) else b""
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


class _Cache(dict):
    """Pieces and their ids as bytes. Starts again when full, so its size is bounded."""

    def __init__(self, codec: TreeCodec):
        super().__init__()
        self.codec = codec

    def __missing__(self, piece: str) -> bytes:
        ids = array("i", self.codec.tokens(piece)).tobytes()
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = ids
        return ids


def read_ranks(data: bytes) -> dict[bytes, int]:
    """A rank file: a token in base64 and its rank on each line."""
    return {base64.b64decode(token): int(rank)
            for token, rank in (line.split() for line in data.splitlines() if line)}


@functools.lru_cache(maxsize=2)
def _codec(data: bytes, pattern: str) -> TreeCodec:
    return TreeCodec(read_ranks(data), pattern)


def _encode_batch(codec: TreeCodec, texts: list[str | None]) -> list[pa.Array]:
    ids = [codec.encode(text or "") for text in texts]
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
    values = np.concatenate(ids) if ids else np.empty(0, np.int32)
    return [pa.ListArray.from_arrays(pa.array(ends), pa.array(values))]


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text",
                 keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and ids, the tokens of each whole text."""
    data = docs.sparkSession.sparkContext.broadcast(file_bytes(ranks_path))
    return map_texts(docs, list(keep), text, "ids array<int>", _encode_batch,
                     load=lambda: _codec(data.value, pattern))


def decode_ids(encoded: DataFrame, ranks_path: str, pattern: str,
               keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and ids, and the bytes they stand for. Bytes, because the ids of part
    of a text need not end where a character does."""
    data = encoded.sparkSession.sparkContext.broadcast(file_bytes(ranks_path))
    chosen = encoded.select(*keep, "ids")

    def run(batches):
        codec = _codec(data.value, pattern)
        for batch in (part for whole in batches for part in sliced(whole, SLICE_IDS)):
            lists = batch.column(batch.num_columns - 1).fill_null([])
            values, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
            decoded = [codec.decode(values[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(decoded, pa.binary())],
                names=[*batch.schema.names, "decoded"])

    decoded = T.StructField("decoded", T.BinaryType())
    return chosen.mapInArrow(run, T.StructType([*chosen.schema.fields, decoded]))


def encoding_digests(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text",
                     keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, n_tokens, ids_sha256 (decimal ids joined by a space) and
    decoded_sha256, from encoding each text and decoding its ids."""
    decoded = decode_ids(encode_texts(docs, ranks_path, pattern, text, keep),
                         ranks_path, pattern, keep)
    written = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return decoded.select(
        *keep, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(written, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
