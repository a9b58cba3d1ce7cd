"""Token ids of whole texts by the ``tokenizers`` library, with a bounded cache of chunks.

A text is cut at single spaces that stand between two characters which are no white space. Neither
of the tokenizers used here lets a token reach over such a place, nor looks across it, so the ids of
a text are the ids of its chunks in a row. A tokenizer that drops white space altogether is cut at
every space, tab and line end; its texts are split and their words told apart by Arrow, so that Python
sees each different word of a batch once. Common chunks are encoded once per Python worker.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import compress
from operator import not_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tapewright.llm.common import ship, worker

_CUT = re.compile(r"(?<=\S) (?=\S)")
_MARKS = ".,;:!?*$%&#\")]}|"
#: Characters of text that are split into words in one go.
_SPLIT = 1 << 22


class ChunkEncoder:
    """Little-endian 32-bit ids of texts, as bytes.

    ``capacity`` bounds the number of remembered chunks. When half of it is full, chunks that were not
    seen since the last time are forgotten.
    """

    def __init__(self, path: str, capacity: int = 1_200_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.capacity = capacity
        self.known: dict[str, bytes | None] = {}
        self.former: dict[str, bytes | None] = {}
        self.parts: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.folds = self._ids(["A"]) == self._ids(["a"])
        self.added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # A word of letters is one pre-token: its last id is marked as an end, or its first as a start.
        self.ends = any(t.endswith("</w>") for t in vocabulary)
        marked = [i for t, i in vocabulary.items() if (t.endswith("</w>") if self.ends else t.startswith("\u0120"))]
        self.marked = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.marked[marked] = True
        a, b, *spaced = self._ids(["a", "b", "a b", "\ta\r\n b ", " \n\n"])
        self.drops_space = spaced == [a + b, a + b, b""]

    def _ids(self, chunks: Sequence[str]) -> list[bytes]:
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        done = encode(list(chunks), add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in done]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Ids of ``' ' + word`` for words of letters, encoded together and cut at word marks."""
        out: list[bytes] = []
        for i in range(0, len(words), 1024):
            part = words[i : i + 1024]
            raw = self._ids([" " + " ".join(part)])[0]
            ids = np.frombuffer(raw, "<u4")
            cuts = np.flatnonzero(self.marked[ids]) + self.ends
            if len(cuts) == len(part) and (cuts[-1] == len(ids) if self.ends else cuts[0] == 0):
                at = (4 * cuts).tolist()
                at = [0, *at] if self.ends else [*at, len(raw)]
                out += [raw[lo:hi] for lo, hi in zip(at, at[1:])]
            else:
                out += self._ids([" " + w for w in part])
        return out

    def _learn(self, words: list[str]) -> None:
        """Remember ``' ' + word`` for plain words; others are marked, as they may touch space.

        Letters and the ASCII marks after them are pre-tokens of their own, so they are learnt apart.
        """
        parts = self.parts
        if len(parts) > self.capacity:
            parts.clear()
        parts[""] = b""
        cores = [w.rstrip(_MARKS) for w in words]
        letters = list(map(str.isalpha, cores))
        odd = []
        for w in compress(words, map(not_, letters)):
            if self.drops_space or w and w == w.strip():
                odd.append(w)
            else:
                self.known[w] = None
        split = [(w, c, w[len(c) :]) for w, c in compress(zip(words, cores, strict=True), letters)]
        new = list({c for _, c, _ in split}.difference(parts))
        parts.update(zip(new, self._letters(new), strict=True))
        new = list({t for _, _, t in split}.difference(parts))
        parts.update(zip(new, self._ids(new), strict=True))
        self.known.update([(w, parts[core] + parts[tail]) for w, core, tail in split])
        for i in range(0, len(odd), 4096):
            part = odd[i : i + 4096]
            self.known.update(zip(part, self._ids([" " + w for w in part]), strict=True))

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        out, at, size = [], 0, 0
        step, most = (self._encode_words, _SPLIT) if self.drops_space else (self._encode, 1 << 18)
        for i, text in enumerate(texts, 1):
            size += len(text)
            if size >= most or i == len(texts):
                out += step(texts[at:i])
                at, size = i, 0
        return out

    def _know(self, wanted: set[str]) -> None:
        """See to it that ``known`` has all of these words."""
        new = wanted.difference(self.known)
        if len(self.known) + len(new) > self.capacity // 2:
            self.known, self.former = {}, self.known
            new = wanted
        former = list(filter(self.former.__contains__, new))
        self.known.update(zip(former, map(self.former.__getitem__, former), strict=True))
        self._learn(list(new.difference(former)))

    def _fold(self, text: str) -> str:
        """Small letters, where the tokenizer sees no capitals: in Latin texts that name no added token."""
        if not self.folds:
            return text
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
        small = text.lower()
        return text if any(t in small for t in self.added) else small

    def _encode_words(self, texts: Sequence[str]) -> list[bytes]:
        """For a tokenizer that drops white space: ids of all words, and where each text's ids end."""
        plain = [t.replace("\n", " ").replace("\r", " ").replace("\t", " ") for t in map(self._fold, texts)]
        split = pc.split_pattern(pa.array(plain, pa.large_string()), " ")
        coded = split.values.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self._know(set(words))
        ids = list(map(self.known.__getitem__, words))
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        own = pa.LargeListArray.from_arrays(
            np.concatenate([[0], np.cumsum(lengths)]), pa.array(np.frombuffer(b"".join(ids), "<i4"))
        )
        at = coded.indices
        every = own.take(at).flatten().to_numpy().astype("<i4", copy=False).tobytes()
        before = np.concatenate([[0], np.cumsum(lengths[at.to_numpy()])])
        cuts = (4 * before[split.offsets.to_numpy()]).tolist()
        return [every[lo:hi] for lo, hi in zip(cuts, cuts[1:])]

    def _encode(self, texts: Sequence[str]) -> list[bytes]:
        cut = [t.partition(" ") for t in texts]
        split = [rest.split(" ") if space else [] for _, space, rest in cut]
        self._know(set().union(*split))
        heads = self._ids([head for head, _, _ in cut])
        known, out = self.known.__getitem__, []
        for text, words, (head, _, _), ids in zip(texts, split, cut, heads, strict=True):
            try:
                if not head or head != head.strip():
                    raise TypeError
                out.append(ids + b"".join(map(known, words)))
            except TypeError:  # a word that touches other white space has no ids of its own
                chunks = _CUT.split(text)
                out.append(b"".join(self._ids([chunks[0], *(" " + c for c in chunks[1:])])))
        return out


def encoder(path: str) -> ChunkEncoder:
    """One encoder per Python worker and file."""
    return worker(f"encoder {path}", lambda: ChunkEncoder(path))


ship(__name__)
