"""Personal data by rules and a skip-chain conditional random field.

Rules find the base spans (email, ip, card, phone). The field then labels further tokens of the same
document: tokens with a digit or an at sign, words equal to the name in front of a found address,
and one neighbour on each side. Neighbours in the text share a chain potential. Tokens of equal or
similar form (without case and punctuation; an address also by its name) share a skip potential,
however far apart; each occurrence is linked with the next one, so links grow with the text, not
with its square. Loopy message passing runs over all documents of a batch at once, each until its
messages stand still, with the tokens of base spans held to their kind. A token that comes out as a kind with a probability of at least
``least`` becomes a further span. Base spans always stay.

Training: the labels are the base spans of a sample of whole documents (``train_docs`` of them,
drawn by a hash of the id), the features shape and context only, the weights maximise the
pseudo-likelihood with an L2 penalty; linked tokens count once more with their evidence masked, so
links learn to speak for themselves (see ``train``). So what the rules and the tokens around them
show is carried over to tokens that the rules miss. Without any base span in the sample nothing is added.

Defined results: null and empty texts have no spans; positions count code points; repeated rows are
handled one by one; a token that overlaps a base span adds nothing.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.llm.common import column, in_batches, ship, texts_of

# Kinds in their order, and patterns of the base spans.
KINDS = ("email", "ip", "card", "phone")
_NAME = "[A-Za-z0-9._%+-]"
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_NAME_BACK = re.compile(_NAME + "*$")
_DIGIT = re.compile("[0-9]")
_ACTIVE = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"\S+")
_WORD = re.compile(r"\w")
_PLAIN = re.compile(r"[\W_]+")
_EDGE = "\"'`.,;:!?()[]{}<>*#$%&|"
LABELS = len(KINDS) + 1
FEATURES = 24
#: Features that restate a rule: at sign, dots, plus, brackets, dashes, checksum, parts of an address.
EVIDENCE = list(range(11, 19))

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    """Whether the last digit is the checksum of the others."""
    values = [int(d) for d in reversed(digits)]
    return sum(values[0::2] + [sum(divmod(2 * v, 10)) for v in values[1::2]]) % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and re.match(_NAME, text[start - 1]):
            start -= 1
        found = _AT.match(text, at) if start < at else None
        if found:
            end = found.end()
            yield 0, start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """The rules' spans, by kind and start."""
    spans = list(_emails(text)) if "@" in text else []
    if not _DIGIT.search(text):
        return spans
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m.group().split(".")]  # zeros in front do not count
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            spans.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                spans.append((3, m.start(), m.end()))
    return spans


def joined(spans: Sequence[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


@dataclass
class Graph:
    """Tokens of many documents as nodes; chain and skip links as node pairs."""

    doc: list[int] = field(default_factory=list)
    span: list[tuple[int, int]] = field(default_factory=list)
    label: list[int] = field(default_factory=list)  # kind + 1 under a base span, else 0
    features: list[list[int]] = field(default_factory=list)
    chain: list[tuple[int, int]] = field(default_factory=list)
    skip: list[tuple[int, int]] = field(default_factory=list)

    def add(self, doc: int, text: str, spans: list[Span]) -> None:
        nodes = _tokens(text, spans)
        first = len(self.doc)
        last: dict[str, int] = {}
        for i, (a, b, label, active) in enumerate(nodes):
            me = first + i
            token = text[a:b]
            self.doc.append(doc)
            self.span.append((a, b))
            self.label.append(label)
            before = text[nodes[i - 1][0] : nodes[i - 1][1]] if i and nodes[i - 1][1] + 3 >= a else ""
            self.features.append(_features(token, before))
            if i and a - nodes[i - 1][1] <= 3:
                self.chain.append((me - 1, me))
            if active:
                for key in _keys(token):
                    if key in last and last[key] != me:
                        self.skip.append((last[key], me))
                    last[key] = me


def _keys(token: str) -> set[str]:
    """Forms by which a token is like another one."""
    keys = {_PLAIN.sub("", token).lower()}
    if "@" in token:
        keys.add(_PLAIN.sub("", token.split("@")[0]).lower())
    return {k for k in keys if len(k) >= 4}


def _trim(text: str, a: int, b: int) -> tuple[int, int]:
    while a < b and text[a] in _EDGE:
        a += 1
    while a < b and text[b - 1] in _EDGE:
        b -= 1
    return a, b


def _tokens(text: str, spans: list[Span]) -> list[tuple[int, int, int, bool]]:
    """start, end, label, active of the nodes of a document; one node per base span."""
    taken = sorted((a, b, k + 1) for k, a, b in spans)
    found = {(a, b): (label, True) for a, b, label in taken}
    starts = np.array([t[0] for t in taken], np.int64)
    ends = np.maximum.accumulate([t[1] for t in taken]) if taken else starts

    def add(a: int, b: int, active: bool) -> None:
        a, b = _trim(text, a, b)
        at = int(np.searchsorted(starts, b))
        if a < b and not (at and ends[at - 1] > a):
            found.setdefault((a, b), (0, active))

    words = [m.span() for m in _TOKEN.finditer(text)]
    names = {n for n in (text[a:b].split("@")[0] for k, a, b in spans if k == 0) if len(n) >= 4}
    lengths = sorted({len(n) for n in names})
    for a, b in words:
        if _ACTIVE.search(text, a, b):
            add(a, b, True)
        for n in lengths:  # a name of the document stands at the token's front
            if n > b - a:
                break
            if text[a : a + n] in names and not _WORD.match(text, a + n):
                add(a, a + n, True)
                break
    # One neighbour on each side, of any length.
    first = [a for a, _ in words]
    for a, b in list(found):
        c = b + 1 if b < len(text) and text[b].isspace() else b
        at = bisect_right(first, c) - 1
        if at >= 0 and c < words[at][1] and c < len(text):
            add(c, words[at][1], False)
        d = a
        while a - d <= 3 and d and text[d - 1].isspace():
            d -= 1
        at = bisect_right(first, d - 1) - 1
        if at >= 0 and d > words[at][0]:
            c, d = _trim(text, words[at][0], min(d, words[at][1]))
            if a - d <= 3:
                add(c, d, False)
    nodes = [(a, b, label, active) for (a, b), (label, active) in sorted(found.items())]
    return [n for i, n in enumerate(nodes) if not i or n[0] >= nodes[i - 1][1] or n[2]]


def _features(token: str, before: str) -> list[int]:
    """Numbers of the features that hold; shape and context only."""
    digits = sum("0" <= c <= "9" for c in token)
    alpha = sum(c.isalpha() for c in token)
    out = [0, 1 + min(digits, 20) // 4 if digits else 7]
    out.append(8 if not alpha else 9 if alpha < digits else 10)
    out += [11] * ("@" in token) + [12] * (token.count(".") == 3) + [13] * (0 < token.count(".") < 3)
    out += [14] * token.startswith("+") + [15] * ("(" in token) + [16] * ("-" in token)
    only = _PLAIN.sub("", token)
    out += [17] * (only.isdigit() and only.isascii() and 13 <= len(only) <= 19 and luhn(only))
    parts = token.split(".")
    out += [18] * (len(parts) == 4 and all(p.isdigit() and len(p) < 4 and int(p) < 256 for p in parts))
    out += [19] * ("=" in token or '"' in token) + [20] * (before[-1:] in (":", "="))
    out += [21] * (before[-1:] == ")") + [22] * bool(re.match(r"\+?[0-9]", before)) + [23] * (alpha > 15)
    return out


@dataclass
class Weights:
    unary: np.ndarray  # features x labels
    chain: np.ndarray  # labels x labels
    skip: np.ndarray


def _matrix(features: list[list[int]]) -> np.ndarray:
    out = np.zeros((len(features), FEATURES))
    for i, f in enumerate(features):
        out[i, f] = 1.0
    return out


def _pairs(links: list[tuple[int, int]]) -> np.ndarray:
    return np.array(links, np.int64).reshape(-1, 2)


def train(graph: Graph, steps: int = 6_000, rate: float = 0.5, penalty: float = 1e-5, repeats: float = 200.0) -> Weights | None:
    """Pseudo-likelihood: each label given its features and its neighbours' labels.

    Labels come from the rules, so features alone would tell all, and links would learn nothing.
    Therefore linked nodes count once more, all together ``repeats`` times as much, with their
    evidence masked: without chain and without the features that restate a rule (EVIDENCE), once with
    and once without those of plain shape; only their links tell. And tokens that the rules pass over although an equal or
    similar one is a base span do not count: whether they are data is what is to be found out.
    """
    label = np.array(graph.label, np.int64)
    if not label.any():
        return None
    n = len(label)
    own = np.eye(LABELS)[label]
    chain, skip = _pairs(graph.chain), _pairs(graph.skip)
    near = []
    for links in (chain, skip):
        sums = np.zeros((n, LABELS))
        np.add.at(sums, links[:, 0], own[links[:, 1]])
        np.add.at(sums, links[:, 1], own[links[:, 0]])
        near.append(sums)
    doubtful = (label == 0) & (near[1][:, 1:].sum(axis=1) > 0)
    linked = np.flatnonzero((near[1].sum(axis=1) > 0) & ~doubtful)
    linked = np.repeat(linked, 2)
    given = _matrix(graph.features)
    masked = given[linked]
    masked[:, EVIDENCE] = 0.0
    masked[1::2, 1:] = 0.0
    plain = np.hstack([given, *near])
    x = np.vstack([plain[~doubtful], np.hstack([masked, np.zeros((len(linked), LABELS)), near[1][linked]])])
    y = np.vstack([own[~doubtful], own[linked]])
    counts = np.bincount(label[linked], minlength=LABELS)  # each label as much as any other
    even = len(linked) / np.maximum(counts, 1) / max(1, np.count_nonzero(counts))
    share = np.concatenate([np.ones(len(x) - len(linked)), repeats * even[label[linked]]])[:, None]
    share /= share.sum()
    w, speed = np.zeros((x.shape[1], LABELS)), np.zeros((x.shape[1], LABELS))
    for _ in range(steps):
        z = x @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        speed = 0.9 * speed - rate * (x.T @ (share * (p - y)) + penalty * w)
        w = w + speed
    both = lambda m: (m + m.T) / 2
    a, b = FEATURES, FEATURES + LABELS
    return Weights(w[:a], both(w[a:b]), both(w[b:]))


def infer(
    graph: Graph, weights: Weights, rounds: int = 256, clamp: float = 20.0, tolerance: float = 1e-6, least_step: float = 1e-3
) -> np.ndarray:
    """Label probabilities of all nodes by loopy sum-product, damped; base spans are held.

    Each document runs until none of its messages is off by ``tolerance``, whatever else is in the batch. If
    that takes more than ``rounds`` and four per node, which no evidence needs to travel, its messages
    swing: the step is halved each time, and below ``least_step`` they are taken as they stand.
    """
    n = len(graph.doc)
    label = np.array(graph.label, np.int64)
    unary = _matrix(graph.features) @ weights.unary
    held = label > 0
    unary[held] = 0.0
    unary[held, label[held]] = clamp
    chain, skip = _pairs(graph.chain), _pairs(graph.skip)
    one = np.concatenate([chain, skip])
    source = np.concatenate([one[:, 0], one[:, 1]])
    target = np.concatenate([one[:, 1], one[:, 0]])
    kinds = np.tile(np.concatenate([np.zeros(len(chain), int), np.ones(len(skip), int)]), 2)
    potential = np.exp(np.clip(np.stack([weights.chain, weights.skip]), -8, 8))
    back = np.concatenate([np.arange(len(one)) + len(one), np.arange(len(one))])
    doc = np.array(graph.doc, np.int64)
    stage = rounds + 4 * np.bincount(doc)
    messages = np.full((len(source), LABELS), -np.log(LABELS))
    left, turn = np.arange(len(source)), 0
    while len(left):
        # The messages of the documents that still run, by target.
        left = left[np.argsort(target[left], kind="stable")]
        nodes, first = np.unique(target[left], return_index=True)
        at = np.empty(len(source), np.int64)
        at[left] = np.arange(len(left))
        sender, reverse, of = np.searchsorted(nodes, source[left]), at[back[left]], doc[source[left]]
        fixed, now, table = unary[nodes], messages[left], potential[kinds[left]]
        done = np.zeros(len(stage), bool)
        while not done.any():
            total = fixed + np.add.reduceat(now, first, axis=0)
            out = total[sender] - now[reverse]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            new = np.log(np.maximum(np.einsum("el,elm->em", out, table), 1e-30))
            new -= np.log(np.exp(new).sum(axis=1, keepdims=True))
            step = 0.5 ** (1 + turn // stage)
            worst = np.zeros(len(stage))
            np.maximum.at(worst, of, np.abs(new - now).max(axis=1))
            now = now + step[of, None] * (new - now)
            turn += 1
            done[of] = (worst[of] < tolerance) | (step[of] < least_step)
        messages[left] = now
        left = left[~done[of]]
    belief = unary.copy()
    np.add.at(belief, target, messages)
    p = np.exp(belief - belief.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True) if n else np.zeros((0, LABELS))


def added_spans(texts: Sequence[str], base: list[list[Span]], weights: Weights | None, least: float) -> list[list[Span]]:
    """What the field adds to the base spans of each text."""
    out: list[list[Span]] = [[] for _ in texts]
    if weights is None:
        return out
    graph = Graph()
    for i, (text, spans) in enumerate(zip(texts, base, strict=True)):
        if spans or _ACTIVE.search(text):
            graph.add(i, text, spans)
    p = infer(graph, weights)
    best = p[:, 1:].argmax(axis=1) if len(p) else np.zeros(0, int)
    for node in np.flatnonzero((np.array(graph.label) == 0) & (p[np.arange(len(p)), best + 1] >= least)) if len(p) else ():
        out[graph.doc[node]].append((int(best[node]), *graph.span[node]))
    return out


def fit(docs: DataFrame, train_docs: int = 4_000, text: str = "text", doc_id: str = "doc_id") -> Weights | None:
    """Weights from the base spans of about ``train_docs`` documents drawn by a hash of the id.

    The graphs are made by tasks; what reaches the driver are the nodes of these documents.
    """
    rows = docs.select(column(docs, doc_id).alias("doc_id"), column(docs, text).alias("text"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    n = rows.count()
    if not n:
        return None
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("personal")), F.lit(1 << 30))
    rows = rows.where(draw < min(1 << 30, train_docs * (1 << 30) // n))

    def graphs(batch: pa.RecordBatch) -> pa.RecordBatch:
        import pickle

        graph = Graph()
        for i, t in enumerate(texts_of(batch)):
            graph.add(i, t, base_spans(t))
        parts = (graph.label, graph.features, graph.chain, graph.skip)
        key = batch.column("doc_id")[0].as_py()
        return pa.record_batch({"key": pa.array([str(key)]), "graph": pa.array([pickle.dumps(parts)], pa.binary())})

    import pickle

    every = Graph()
    for row in in_batches(rows, graphs, "key string, graph binary").orderBy("key").toLocalIterator():
        label, features, chain, skip = pickle.loads(row["graph"])
        first = len(every.label)
        every.label += label
        every.features += features
        every.chain += [(a + first, b + first) for a, b in chain]
        every.skip += [(a + first, b + first) for a, b in skip]
    return train(every)


def find(
    docs: DataFrame, weights: Weights | None, least: float = 0.9, carry: Sequence[str] = ("doc_id",), text: str = "text",
    mask: bool = False,
) -> DataFrame:
    """``carry`` columns with n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans and
    (``mask``) masked: the text with each span replaced by its kind in angle brackets, null kept."""
    rows = docs.select(
        column(docs, text).alias("text"), *[column(docs, c).alias(f"__c{i}") for i, c in enumerate(carry)]
    )

    def label(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, digests, spans, masked = [], [], [], []
        for lo in range(0, batch.num_rows, 512):
            part = batch.slice(lo, 512)
            texts = texts_of(part)
            base = [base_spans(t) for t in texts]
            for t, b, more in zip(texts, base, added_spans(texts, base, weights, least), strict=True):
                counts.append([sum(s[0] == k for s in b) for k in range(len(KINDS))])
                digests.append(hashlib.sha256(joined(b).encode()).hexdigest())
                spans.append(joined(b + more))
                if mask:
                    masked.append(hidden(t, b + more))
        arrays = [batch.column(f"__c{i}") for i in range(len(carry))]
        arrays += [pa.array([c[k] for c in counts], pa.int64()) for k in range(len(KINDS))]
        arrays += [pa.array(digests), pa.array(spans)]
        names = [*carry, *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
        if mask:
            given = batch.column("text").is_valid().to_pylist()
            arrays.append(pa.array([m if g else None for m, g in zip(masked, given, strict=True)], pa.string()))
            names.append("masked")
        return pa.RecordBatch.from_arrays(arrays, names=names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*[f"`{c}`" for c in carry]).schema)
    schema += "".join(f", n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"
    return in_batches(rows, label, schema + (", masked string" if mask else ""))


def hidden(text: str, spans: Sequence[Span]) -> str:
    """The text with its spans replaced; overlapping spans are replaced as one."""
    out, end = [], 0
    for k, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[end:a], f"<{KINDS[k]}>"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def personal_data(docs: DataFrame, train_docs: int = 4_000, least: float = 0.9) -> DataFrame:
    """The spans of every row of ``docs`` (doc_id, text), with a field trained on a sample of them."""
    return find(docs, fit(docs, train_docs), least)


ship(__name__)
