"""Token counts of whole texts, without the tokens.

Texts are cut at safe boundaries into parts of at most ``PART_CHARS`` characters where that is
possible, and parts are encoded in batches of about ``BATCH_BYTES``, so neither a long text nor
a batch of them makes the library hold much at once. Only lengths leave the task.

A boundary is safe if the tokens on both sides cannot depend on each other. The model has no
rewriting of text (checked when it is loaded) but puts one mark for a space before the text, and
turns spaces into marks. All its pieces are known: none holds a mark after another character
(checked too), so no merge ever joins a character with a space that follows it. A part that
starts at such a space is encoded without the space, since the library's own first mark stands
for it. A part without spaces is cut after a character that ends no piece with the next one
inside; a line feed, which occurs in no piece, then leads the part and its tokens are taken off.

Defined cases: null and empty texts have 0 bytes and 0 tokens.
"""

from __future__ import annotations

import functools

import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbstream.llm.common import file_bytes, map_texts

PART_CHARS = 16_384
BATCH_BYTES = 1 << 20
MARK = "▁"  # what the model writes for a space
ANCHOR = "\n"


class PieceCounter:
    def __init__(self, model: bytes, part_chars: int = PART_CHARS, batch_bytes: int = BATCH_BYTES):
        self.encoder = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.part_chars, self.batch_bytes = part_chars, batch_bytes
        pieces = [self.encoder.id_to_piece(i) for i in range(self.encoder.get_piece_size())
                  if not (self.encoder.is_control(i) or self.encoder.is_byte(i)
                          or self.encoder.is_unknown(i))]
        self.neighbours = {p[i:i + 2] for p in pieces for i in range(len(p) - 1)}
        self.spaces_safe = not any(b == MARK and a != MARK for a, b in self.neighbours)
        self.anchored = not any(ANCHOR in p for p in pieces) and self._keeps_text()
        self.anchor_tokens = len(self.encoder.encode(ANCHOR))

    def _keeps_text(self) -> bool:
        """No normalisation: odd forms, runs of spaces and a first mark all come back."""
        probe = " ﬁ  Ⅳ　é \t"
        return (self.encoder.normalize(probe) if hasattr(self.encoder, "normalize") else
                "") == MARK + probe.replace(" ", MARK)

    def parts(self, text: str) -> list[tuple[str, int]]:
        """(what to encode, tokens to take off) for each part of a text."""
        if len(text) <= self.part_chars or not (self.spaces_safe and self.anchored):
            return [(text, 0)] if text else []
        out, start, lead = [], 0, ""
        while start < len(text):
            end = self._cut(text, start)
            part = text[start:end]
            if start == 0:
                out.append((part, 0))
            elif part[0] == " " and len(part) > 1:
                out.append((part[1:], 0))
            else:
                out.append((ANCHOR + part, self.anchor_tokens))
            start = end
        return out

    def _cut(self, text: str, start: int) -> int:
        """The last safe place up to ``part_chars`` ahead, or else the next one."""
        limit = start + self.part_chars
        if limit >= len(text):
            return len(text)
        at = limit
        while at > start + 1 and not self._safe(text, at):
            at -= 1
        if at > start + 1:
            return at
        at = limit + 1
        while at < len(text) and not self._safe(text, at):
            at += 1
        return at

    def _safe(self, text: str, at: int) -> bool:
        a, b = text[at - 1], text[at]
        if a == MARK or b == MARK:
            return False
        return a != " " and (b == " " or a + b not in self.neighbours)

    def counts(self, texts: list[str | None]) -> list[int]:
        totals = [0] * len(texts)
        batch, owners, held = [], [], 0
        for i, text in enumerate(texts):
            for part, off in self.parts(text or ""):
                batch.append(part)
                owners.append((i, off))
                held += len(part.encode())
                if held >= self.batch_bytes:
                    self._add(totals, batch, owners)
                    batch, owners, held = [], [], 0
        self._add(totals, batch, owners)
        return totals

    def _add(self, totals, batch, owners) -> None:
        for (i, off), ids in zip(owners, self.encoder.encode(batch, num_threads=1) if batch else []):
            totals[i] += len(ids) - off


@functools.lru_cache(maxsize=2)
def _counter(model: bytes) -> PieceCounter:
    return PieceCounter(model)


def token_counts(docs: DataFrame, model_path: str, limit: int, text: str = "text",
                 keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, n_bytes, n_tokens, and whether the tokens are over ``limit``."""
    model = docs.sparkSession.sparkContext.broadcast(file_bytes(model_path))
    sized = docs.select(
        *keep, F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text).alias("text"))
    counted = map_texts(sized, [*keep, "n_bytes"], "text", "n_tokens long",
                        lambda counter, texts: [counter.counts(texts)],
                        load=lambda: _counter(model.value))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
