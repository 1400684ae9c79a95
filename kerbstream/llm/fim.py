"""Fill-in-the-middle: cut a text at two line boundaries and move its middle to the end.

*Boundaries.* A text's line boundaries (its start, and the end of each line) are kept as a
``BoundarySet``, built like a Roaring bitmap: offsets that share their high bits lie in one
container, which holds the low 16 bits as a sorted array, as a bitmap or as runs, whichever is
smallest. Cumulative cardinalities lead to the container of the k-th boundary, and a select
inside it to the offset. Both cuts are such selects, so a text of many lines costs two searches
after one pass, and at most two bytes per boundary or 8 kB per 65,536 characters.

*Draws.* Where and how a text is cut depends on its id and the seed alone, so reruns agree.

Defined cases: null and empty texts are ``plain`` and have no lines; so are texts that hold a
marker, which could not be rebuilt. A null id draws from the seed alone. Rows that repeat an id
draw the same numbers; with equal texts they give equal rows. Texts are read in blocks of
65,536 characters, and a long one is handled by one task. An empty table gives an empty result.
Of the table's columns only ``keep`` is returned, so others may have any name.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbstream.llm.common import sliced

SEED = 7
FIM_PERCENT = 100
SPM_PERCENT = 50
MARKERS = ("<P>", "<S>", "<M>")  # prefix, suffix, middle

BLOCK = 1 << 16  # offsets of a container
ARRAY_LIMIT = 4096  # beyond it a bitmap is smaller than an array
RESULT = "n long, form string, prefix_chars long, middle_chars long, output string"


class ArrayContainer:
    """Low halves in order."""

    def __init__(self, lows: np.ndarray):
        self.lows = lows.astype(np.uint16)
        self.cardinality, self.bytes = len(lows), 2 * len(lows)

    def select(self, k: int) -> int:
        return int(self.lows[k])


class BitmapContainer:
    """A bit per low half. The word is found by running totals, then the bit inside it."""

    def __init__(self, lows: np.ndarray):
        bits = np.zeros(BLOCK, np.uint8)
        bits[lows] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.totals = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)
        self.cardinality, self.bytes = len(lows), self.words.nbytes

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.totals, k, "right"))
        before = int(self.totals[word - 1]) if word else 0
        bits = np.unpackbits(self.words[word:word + 1].view(np.uint8), bitorder="little")
        return 64 * word + int(np.flatnonzero(bits)[k - before])


class RunContainer:
    """First members of runs of neighbours, and how many members come before each run."""

    def __init__(self, lows: np.ndarray):
        first = np.flatnonzero(np.diff(lows, prepend=-2) != 1)
        self.starts, self.before = lows[first].astype(np.uint16), first.astype(np.uint16)
        self.cardinality, self.bytes = len(lows), 4 * len(first)

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.starts[run]) + k - int(self.before[run])


def container(lows: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest form of sorted, distinct offsets below ``BLOCK``."""
    runs = 1 + int(np.count_nonzero(np.diff(lows) != 1))
    if 4 * runs < min(2 * len(lows), BLOCK // 8):
        return RunContainer(lows)
    return ArrayContainer(lows) if len(lows) <= ARRAY_LIMIT else BitmapContainer(lows)


class BoundarySet:
    """Offsets of a text's line boundaries, its start among them."""

    def __init__(self, text: str):
        self.keys, self.containers, self.ends = [], [], []  # ends: cumulative cardinalities
        size, total = len(text), 0
        for base in range(0, size + 1, BLOCK):
            # A line feed at p makes p + 1 a boundary, so the block's characters begin one earlier.
            lead = 1 if base else 0
            part = text[base - lead:base + BLOCK - 1]
            lows = np.flatnonzero(np.frombuffer(part.encode("utf-32-le"), "<u4") == 10) + 1 - lead
            edge = [0] if base == 0 else []
            tail = [size - base] if size - base < BLOCK and size and text[-1] != "\n" else []
            if edge or tail:
                lows = np.concatenate([edge, lows, tail]).astype(np.int64)
            if len(lows):
                total += len(lows)
                self.keys.append(base)
                self.containers.append(container(lows))
                self.ends.append(total)
        self.cardinality = total

    def __len__(self) -> int:
        return self.cardinality

    def select(self, k: int) -> int:
        """The offset of boundary ``k``, where ``k`` lines end."""
        at = bisect_right(self.ends, k)
        before = self.ends[at - 1] if at else 0
        return self.keys[at] + self.containers[at].select(k - before)


def transform(text: str, draws: tuple[int, int, int, int], fim_percent: int = FIM_PERCENT,
              spm_percent: int = SPM_PERCENT, markers: tuple[str, str, str] = MARKERS
              ) -> tuple[int, str, int | None, int | None, str]:
    """(lines, form, characters of the prefix, of the middle, what the text becomes)."""
    boundaries = BoundarySet(text)
    n = len(boundaries) - 1
    h1, h2, h3, h4 = draws
    if not text or h3 % 100 >= fim_percent or any(m in text for m in markers):
        return n, "plain", None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = boundaries.select(first), boundaries.select(second)
    p, s, m = markers
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_percent:
        return n, "spm", a, b - a, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return n, "psm", a, b - a, f"{p}{prefix}{s}{suffix}{m}{middle}"


def check_markers(markers: tuple[str, str, str]) -> None:
    """Markers must be told apart wherever they stand: no end of one may begin another, else a
    text beside a marker could make one at another place."""
    for i, x in enumerate(markers):
        for j, y in enumerate(markers):
            overlaps = any(x.endswith(y[:k]) for k in range(1, min(len(x), len(y))))
            if not x or overlaps or (i != j and x in y):
                raise ValueError(f"markers {x!r} and {y!r} cannot be told apart")


def transformed(docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT,
                spm_percent: int = SPM_PERCENT, markers: tuple[str, str, str] = MARKERS,
                text: str = "text", key: str = "doc_id",
                keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, then n (lines), form (plain, psm or spm), prefix_chars and middle_chars
    (code points), and output, the text in its form. Nothing is shuffled."""
    check_markers(markers)
    number = F.coalesce(F.col(key).cast("string"), F.lit(""))
    chosen = docs.select(
        *keep, F.sha2(F.concat(F.lit(f"{seed}:"), number), 256).alias("_digest"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"))
    result = T.StructType(
        [*chosen.schema.fields[:-2], *T.StructType.fromDDL(RESULT).fields])

    def one(digest: str, whole: str) -> tuple:
        draws = tuple(int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
        return transform(whole, draws, fim_percent, spm_percent, markers)

    def run(batches):
        for batch in (part for whole in batches for part in sliced(whole)):
            *kept, digests, texts = batch.columns
            made = [one(*pair) for pair in zip(digests.to_pylist(), texts.to_pylist())]
            n, form, prefix, middle, output = zip(*made) if made else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(n, pa.int64()), pa.array(form, pa.string()),
                 pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
                 pa.array(output, pa.string())], names=result.names)

    return chosen.mapInArrow(run, result)


def restored(form: str = "form", output: str = "output",
             markers: tuple[str, str, str] = MARKERS) -> Column:
    """The exact text, from output and form alone. No part holds a marker, so each marker
    occurs once."""
    p, s, m = markers
    whole = F.col(output)

    def between(start: str, end: str) -> Column:
        return F.substring_index(F.substring_index(whole, start, -1), end, 1)

    def leading(marker: str, end: str) -> Column:
        return F.substr(F.substring_index(whole, end, 1), F.lit(len(marker) + 1))

    middle = F.substring_index(whole, m, -1)
    return (F.when(F.col(form) == "psm", F.concat(leading(p, s), middle, between(s, m)))
            .when(F.col(form) == "spm", F.concat(between(p, m), middle, leading(s, p)))
            .otherwise(whole))


def digests(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, and digests of the output and of the text
    rebuilt from it."""
    return transformed(docs, **options).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(), 256).alias("restored_sha256"))
