"""Language of a text by prediction by partial matching (method C) over bytes.

Each language has a tree of byte contexts of up to four bytes with counts that are frozen after
training. A byte costs ``-log2(c / (t + d))`` in the longest context that has seen it (c: its count
there, t: count of the context, d: distinct bytes after it); every longer context that has been
seen, but never with this byte, adds the escape ``-log2(d / (t + d))``; below the empty context all
256 bytes are equally likely. The text gets the language with the shortest exact code.

Bytes are folded first: ASCII capitals to small letters, other ASCII bytes that are no letters to
spaces. A text begins in a context of four spaces. Counts of all orders follow from those of
five-byte windows, which Spark sums per language; the trees are resolved into hash tables
(window -> cost in every language), so a text is scored by array operations alone.

Defined results: null, empty and letterless texts are ``und`` with score 0.0, and so is every text
if there is nothing to learn from. Ties go to the first language in sorted order. Rows without an id
are scored, never learnt from. Repeated rows are scored one by one.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewright.llm.common import column, forget, in_batches, letters, ship, sub_batches, utf8

ORDER = 4
UNKNOWN = "und"
_CHUNK = 1 << 19

_FOLD = np.full(256, 32, np.uint8)
_FOLD[128:] = np.arange(128, 256)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: CRC32 of the id's text is a multiple of five."""
    check = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(check % 5 == 0, F.lit(False))


def _padded(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes with ORDER spaces before each text, and where each text's bytes now begin."""
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    out = np.full(len(raw) + ORDER * n, 32, np.uint8)
    shift = np.repeat(np.arange(1, n + 1, dtype=np.int64) * ORDER, lengths)
    out[np.arange(len(raw), dtype=np.int64) + shift] = _FOLD[raw]
    return out, offsets[:-1] + ORDER * np.arange(1, n + 1)


def _windows(data: np.ndarray) -> np.ndarray:
    """The (ORDER + 1)-byte window ending at each byte from ORDER on, as one number."""
    m = len(data) - ORDER
    out = np.zeros(m, np.uint64)
    for k in range(ORDER + 1):
        out <<= np.uint64(8)
        out |= data[k : k + m]
    return out


def _count_windows(batch: pa.RecordBatch) -> pa.RecordBatch:
    forget()
    return pa.concat_batches([_counted(part) for part in sub_batches(batch)])


def _counted(batch: pa.RecordBatch) -> pa.RecordBatch:
    langs = np.array(batch.column("lang").to_pylist(), dtype=object)
    raw, offsets = utf8(batch)
    out: list[tuple[str, np.ndarray, np.ndarray]] = []
    for lang in sorted(set(langs)):
        rows = np.flatnonzero(langs == lang)
        parts = [raw[offsets[r] : offsets[r + 1]] for r in rows]
        ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        data, starts = _padded(np.concatenate(parts), ends)
        inside = np.ones(len(data), bool)
        for k in range(1, ORDER + 1):
            inside[starts - k] = False
        keys, counts = np.unique(_windows(data)[inside[ORDER:]], return_counts=True)
        out.append((lang, keys, counts))
    return pa.record_batch(
        {
            "lang": pa.array(np.repeat([o[0] for o in out], [len(o[1]) for o in out])),
            "gram": pa.array(np.concatenate([o[1] for o in out]).astype(np.int64)),
            "n": pa.array(np.concatenate([o[2] for o in out]).astype(np.int64)),
        }
    )


class _Hash:
    """Open-addressing table from 64-bit keys to row numbers, looked up for whole arrays."""

    MULT = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, keys: np.ndarray):
        self.keys = np.append(keys, np.uint64(2**63))
        self.bits = max(4, int(np.ceil(np.log2(len(keys) + 1))) + 2)
        self.slots = np.full(1 << self.bits, len(keys), np.int32)
        left, at = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.slots[at] == len(keys)
            first = np.unique(at[free], return_index=True)[1]
            placed = np.flatnonzero(free)[first]
            self.slots[at[placed]] = left[placed]
            rest = np.ones(len(left), bool)
            rest[placed] = False
            left, at = left[rest], (at[rest] + 1) & (len(self.slots) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * self.MULT) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key; the number of rows where a key is absent."""
        none = len(self.keys) - 1
        at = self._slot(keys)
        found = self.slots[at]
        open_ = np.flatnonzero((self.keys[found] != keys) & (found != none))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.slots) - 1)
            got = self.slots[at[open_]]
            found[open_] = got
            open_ = open_[(self.keys[got] != keys[open_]) & (got != none)]
        return found


@dataclass
class Trees:
    """Frozen context trees of all languages, resolved per order.

    ``costs[k]``: windows of k + 1 bytes and what their last byte costs in each language;
    ``escapes[k]``: contexts of k bytes and their escape costs.
    """

    langs: list[str]
    costs: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    escapes: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)

    def hashed(self) -> Trees:
        if self.langs and not hasattr(self, "tables"):
            self.tables = [(_Hash(k), v) for k, v in self.costs]
            self.contexts = [(_Hash(k), v) for k, v in self.escapes]
        return self

    def cost(self, windows: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Bits that the last byte of each window takes, one column per language."""
        if order < 0:
            return np.full((len(windows), len(self.langs)), 8.0, np.float32)
        table, values = self.tables[order]
        rows = table.find(windows)
        out = values[rows]
        missing = np.flatnonzero(rows == len(values) - 1)
        if len(missing):
            keys = windows[missing]
            contexts, escape = self.contexts[order]
            shorter = keys & np.uint64((1 << (8 * order)) - 1)
            out[missing] = escape[contexts.find(keys >> np.uint64(8))] + self.cost(shorter, order - 1)
        return out


def build_trees(langs: list[str], grams: list[tuple[np.ndarray, np.ndarray]]) -> Trees:
    """Resolve window counts (keys and counts per language) into cost and escape tables."""
    trees = Trees(langs)
    n_langs = len(langs)
    lower_keys = np.zeros(0, np.uint64)
    lower = np.full((1, n_langs), 8.0)
    for order in range(ORDER + 1):
        mask = np.uint64((1 << (8 * (order + 1))) - 1)
        per = []
        for keys, counts in grams:
            own, where = np.unique(keys & mask, return_inverse=True)
            per.append((own, np.bincount(where, counts, len(own))))
        every = np.unique(np.concatenate([p[0] for p in per]))
        contexts = np.unique(every >> np.uint64(8))
        # Rows beyond the last stand for absent keys: no escape, and a cost that is never read.
        escape = np.zeros((len(contexts) + 1, n_langs))
        cost = np.full((len(every) + 1, n_langs), np.nan)
        for lang, (own, counts) in enumerate(per):
            where = np.searchsorted(contexts, own >> np.uint64(8))
            total = np.bincount(where, counts, len(contexts))
            distinct = np.bincount(where, minlength=len(contexts))
            seen = distinct > 0
            escape[:-1][seen, lang] = -np.log2(distinct[seen] / (total + distinct)[seen])
            at = np.searchsorted(every, own)
            cost[at, lang] = -np.log2(counts / (total + distinct)[where])
        short = every & np.uint64((1 << (8 * order)) - 1)
        fallback = lower[np.searchsorted(lower_keys, short) if order else np.zeros(len(every), int)]
        fallback = fallback + escape[np.searchsorted(contexts, every >> np.uint64(8))]
        cost[:-1] = np.where(np.isnan(cost[:-1]), fallback, cost[:-1])
        lower_keys, lower = every, cost[:-1]
        trees.costs.append((every, cost.astype(np.float32)))
        trees.escapes.append((contexts, escape.astype(np.float32)))
    return trees


def code_lengths(trees: Trees, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of each text in each language; memory is bounded whatever a text's length."""
    data, starts = _padded(raw, offsets)
    ends = starts + np.diff(offsets)
    out = np.zeros((len(starts), len(trees.langs)))
    for lo in range(ORDER, len(data), _CHUNK):
        hi = min(lo + _CHUNK, len(data))
        bits = trees.cost(_windows(data[lo - ORDER : hi])).astype(np.float64)
        sums = np.vstack([np.zeros((1, bits.shape[1])), np.cumsum(bits, axis=0)])
        a, b = np.clip(starts, lo, hi) - lo, np.clip(ends, lo, hi) - lo
        out += sums[b] - sums[a]
    return out


def fit(
    docs: DataFrame, docs_per_lang: int = 1_500, text: str = "text", lang: str = "lang", doc_id: str = "doc_id"
) -> Trees:
    """Learn the trees from rows with a language and text that are not held out.

    About ``docs_per_lang`` whole documents of each language are learnt from, drawn by a hash of the
    id (all of them, where a language has fewer). This bounds what reaches the driver: at most one
    count per distinct five-byte window of these documents.
    """
    rows = docs.select(
        column(docs, doc_id).alias("doc_id"), column(docs, text).alias("text"), column(docs, lang).alias("lang")
    ).where(
        F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN) & F.col("text").isNotNull()
        & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    )
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return Trees([])
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("language")), F.lit(1 << 30))
    share = F.create_map(
        *[F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1 << 30, docs_per_lang * (1 << 30) // n))]
    )
    grams = (
        in_batches(rows.where(draw < share[F.col("lang")]), _count_windows, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    )
    of, keys, n = (grams.column(c).to_numpy(zero_copy_only=False) for c in ("lang", "gram", "n"))
    langs = sorted(set(of))
    if not langs:
        return Trees([])
    return build_trees(langs, [(keys[of == k].astype(np.uint64), n[of == k]) for k in langs])


def predict(docs: DataFrame, trees: Trees, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns with ``lang_pred``, ``score`` (posterior of the language under equal
    priors, 0 to 1) and ``bits`` (code length per byte) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*[f"`{c}`" for c in carry]).schema)

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        forget()
        model = shared.value.hashed()
        known = np.array(batch.column("__letters").to_pylist(), bool) & bool(model.langs)
        langs, scores, bits = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows), np.zeros(batch.num_rows)
        if known.any():
            parts = [code_lengths(model, *utf8(p, "__text")) for p in sub_batches(batch, name="__text")]
            lengths = np.concatenate(parts)
            size = np.array(batch.column("__size").to_pylist())
            best = lengths.argmin(axis=1)
            least = lengths[np.arange(len(best)), best]
            share = 1.0 / np.exp2(-np.minimum(lengths - least[:, None], 1000.0)).sum(axis=1)
            scores = np.where(known, share, 0.0)
            bits = np.where(known, least / np.maximum(size, 1), 0.0)
            langs = [model.langs[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
        given = [batch.column(f"__c{i}") for i in range(len(carry))]
        return pa.RecordBatch.from_arrays(
            [*given, pa.array(langs, pa.string()), pa.array(scores), pa.array(bits)],
            names=[*carry, "lang_pred", "score", "bits"],
        )

    rows = docs.select(
        column(docs, text).alias("__text"), letters(column(docs, text)).alias("__letters"),
        F.coalesce(F.octet_length(column(docs, text)), F.lit(0)).alias("__size"),
        *[column(docs, c).alias(f"__c{i}") for i, c in enumerate(carry)],
    )
    return in_batches(rows, score, f"{schema}, lang_pred string, score double, bits double")


def language_id(docs: DataFrame, docs_per_lang: int = 1_500) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits for every row of ``docs`` (doc_id, text, lang)."""
    found = predict(docs, fit(docs, docs_per_lang))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits")


ship(__name__)
