"""Token counts by byte-pair merging on a heap and a linked list; no identifiers are made.

The symbols of a chunk start as its characters, in a doubly linked list. A heap holds the adjacent
pairs that the vocabulary joins, lowest rank first, then leftmost. Popping the lowest pair that is
still whole joins it and offers the two new neighbours. The count is the number of first symbols
minus the merges; a character outside the vocabulary counts as its UTF-8 bytes.

A text gets one word mark in front and word marks for its spaces. No piece of the vocabulary holds a
word mark after another character (checked when the vocabulary is loaded), so merges never reach
over the start of a word, nor between two characters that stand together in no piece: the chunks
between such places are counted one by one, common ones from a bounded memory.

Defined results: null and empty texts have 0 tokens; white space counts as what it is; strings that
look like control pieces are plain text. Repeated rows are counted one by one.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.llm.common import column, in_batches, ship, texts_of, worker

MARK = "▁"
_WORDS = re.compile(f"{MARK}+[^{MARK}]*")


@dataclass
class Vocabulary:
    """Ranks of the pieces that merging may form; ``bytes_for_unknown``: else an unknown is one.

    ``capacity`` bounds the memory of counted words, and that of their parts.
    """

    ranks: dict[str, int]
    bytes_for_unknown: bool
    capacity: int = 300_000
    known: dict[str, int] = field(default_factory=dict)
    parts: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        self.alphabet = {p for p in self.ranks if len(p) == 1}
        self.joined = {p[i : i + 2] for p in self.ranks for i in range(len(p) - 1)}

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        if any(model.is_unused(i) for i in ids):
            raise ValueError("vocabularies with unused pieces are not supported")
        plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        order = {score: k for k, score in enumerate(sorted({-model.get_score(i) for i in plain}))}
        ranks = {model.id_to_piece(i): order[-model.get_score(i)] for i in plain}
        if any(MARK in piece.lstrip(MARK) for piece in ranks):
            raise ValueError("a piece reaches over the start of a word")
        return cls(ranks, any(model.is_byte(i) for i in ids))

    def count(self, chunk: str) -> int:
        """Tokens of one chunk."""
        rank_of = self.ranks.get
        n = len(chunk)
        symbols = list(chunk)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        # A pair is rank * n + place; valid[i] is the pair that now begins at place i, or -1.
        valid = [-1] * n
        for i in range(n - 1):
            rank = rank_of(chunk[i : i + 2])
            if rank is not None:
                valid[i] = rank * n + i
        heap = [pair for pair in valid if pair >= 0]
        heapify(heap)
        merges = 0
        while heap:
            pair = heappop(heap)
            i = pair % n
            if valid[i] != pair:
                continue
            j = after[i]
            symbols[i] = whole = symbols[i] + symbols[j]
            merges += 1
            valid[i] = valid[j] = -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                rank = rank_of(whole + symbols[k])
                if rank is not None:
                    valid[i] = pair = rank * n + i
                    heappush(heap, pair)
            h = before[i]
            if h >= 0:
                rank = rank_of(symbols[h] + whole)
                if rank is None:
                    valid[h] = -1
                else:
                    valid[h] = pair = rank * n + h
                    heappush(heap, pair)
        extra = 0
        if self.bytes_for_unknown and not self.alphabet.issuperset(chunk):
            extra = sum(len(c.encode()) - 1 for c in chunk if c not in self.alphabet)
        return n - merges + extra

    def total(self, chunk: str) -> int:
        """Tokens of a chunk, cut first where two neighbours stand together in no piece."""
        joined, start, out = self.joined, 0, 0
        for i in range(1, len(chunk)):
            if chunk[i - 1 : i + 1] not in joined:
                out += self._part(chunk[start:i])
                start = i
        return out + self._part(chunk[start:])

    def _part(self, part: str) -> int:
        n = self.parts.get(part)
        if n is None:
            n = self.parts[part] = self.count(part)
        return n

    def _learn(self, words: set[str]) -> None:
        known = self.known
        new = [w for w in words if w not in known]
        if len(known) + len(new) > self.capacity:
            known.clear()
            new = list(words)
        if len(self.parts) > self.capacity:
            self.parts.clear()
        known.update((w, self.total(MARK + w)) for w in new)

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        out = []
        for lo in range(0, len(texts), 64):
            split = []
            for text in texts[lo : lo + 64]:
                if MARK in text or "  " in text or text[:1] == " " or text[-1:] == " ":
                    split.append([w[1:] for w in _WORDS.findall(MARK + text.replace(" ", MARK))])
                else:
                    split.append(text.split(" ") if text else [])
            self._learn(set().union(*split))
            known = self.known
            out += [sum([known[w] for w in words]) for words in split]
        return out


def token_counts(
    docs: DataFrame, path: str, limit: int = 4_096, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) of every whole text."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        vocabulary = worker(f"vocabulary {path}", lambda: Vocabulary.load(path))
        counts = pa.array(vocabulary.counts(texts_of(batch)), pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_bytes"), counts], names=["doc_id", "n_bytes", "n_tokens"]
        )

    rows = docs.select(
        column(docs, doc_id).alias("doc_id"),
        F.coalesce(F.octet_length(column(docs, text)), F.lit(0)).cast("long").alias("n_bytes"),
        column(docs, text).alias("text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = in_batches(rows, count, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


ship(__name__)
