"""Exact Jaccard similarity join by PartEnum signatures, and the components of its links.

A text's set holds its distinct shingles of ``words`` words. Sets of sizes a <= b that are similar
enough differ in at most (a + b) (1 - t) / (1 + t) shingles. Sizes are cut into bands that only
neighbours can be similar across; for each band with largest size r the domain of shingles is
partitioned by hash, twice: into n1 parts, and each part into three. If two sets differ in at most k
places and n1 > k / 2, then some part holds at most one difference, and one of its three choices of
two thirds is equal in both sets. Each such choice, hashed, is a signature (Arasu et al., 2006); a
set gives signatures for its own band and the next. No similar pair is without a common signature.

Empty choices would be shared by all sets. There are SPARE more parts than needed, so at least
SPARE + 1 parts of a similar pair agree; empty choices count only in sets with more than SPARE parts
that have one, or with a part that is empty altogether.

What shares a signature is not paired off: equal sets are one class beforehand, and in a signature's
group members are compared with one leader per round. Verified links make components; only groups
that are still in several components are looked at again, at last across components: pair by pair where
that is DIRECT pairs a member at most (``_near_pairs``), else by what is unusual in a member (``_near_families``).

Before any text is moved, pairs pass a map: each set has the parity of its shingles' counts in MAP * 64
buckets, or twice as many for each doubling of its size beyond MAP_ITEMS. The parities of two buckets
added up are that of both, so the larger map of a pair is folded to the size of the other one.
Buckets of different parity hold at least one shingle that only one of two sets has, so as
many as these are more than the differences that similar sets may have, the pair is none. The test
loses no link; it lets little pass that the exact one does not, whatever the sets' sizes.

Defined results: a text with fewer words is one shingle; without words or text the set is empty and
linked with nothing, and the row is its own component. Rows without an id keep null as component.
Rows that share one id are nodes of one name. Shingles are held as 64-bit fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewright.llm.common import ID_ROWS, anti_join, column, forget, in_batches, materialize, ship, sub_batches, utf8
from tapewright.llm.components import components
from tapewright.operators.joins import join_lookup

SPARE = 1
CHOICES = 3
#: 64-bit words of the parity map of a set up to MAP_ITEMS.
MAP = 32
MAP_ITEMS = 1_500
#: Members of a signature's group that one task compares with its smallest at most.
FOLLOWERS = 4_096
#: Rounds with one leader per group, as ``_links`` tells.
ROUNDS = 3
#: Pairs across components per member of a group, up to which they are met one by one: their maps are
#: compared at eight to a hundred million pairs a second, while a family's member takes some thousand rows of a join.
DIRECT = 32_768
#: Buckets in common that differ within a step of members, as ``_near_families`` tells.
STEP = 4
_BLOCK = 1 << 20
#: Pairs that are compared at a time within groups, and words of the maps that are compared first.
_PAIRS = 1 << 15
FOLD = 8
#: Members of a group from which all are laid beside each other.
BESIDE = 32
#: Bytes of text that a task takes at a time; word hashes need some 60 bytes for each.
TEXT = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BYTES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: spreads every bit over all others."""
    x = x + np.uint64((seed * _BASE + _BASE) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base, inverse = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
    out = []
    for b in (base, inverse):
        p = np.full(n, b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all words in order, and how many words end before each text's end."""
    space = _SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    begin = ~space
    begin[1:] &= space[:-1] | edge[1:-1]
    finish = ~space
    finish[:-1] &= space[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        lo = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, lo + _BLOCK, side="right")))
        hi = ends[to - 1]
        power, inverse = _powers(hi - lo)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_BYTES[_LOWER[raw[lo:hi]]] * power, out=sums[1:])
        a, b = starts[at:to] - lo, ends[at:to] - lo
        out[at:to] = mix((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64))
        at = to
    return out, np.searchsorted(starts, offsets)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle fingerprints of each text."""
    hashes, bounds = word_hashes(raw, offsets)
    whole = mix(hashes[: max(0, len(hashes) - words + 1)], 77)
    for k in range(1, words):
        whole = mix(whole ^ hashes[k : k + len(whole)], k)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= words:
            yield np.unique(whole[a : b - words + 1])
        elif b > a:
            short = mix(hashes[a : a + 1], 77)
            for k in range(1, b - a):
                short = mix(short ^ hashes[a + k : a + k + 1], k)
            yield mix(short, 1000 + int(b - a))
        else:
            yield np.zeros(0, np.uint64)


def bands(size: int, percent: int) -> list[tuple[int, int]]:
    """(number, largest size) of the bands from 1 up to the one that holds ``size``, and one more."""
    out, low = [], 1
    while not out or out[-1][1] < size:
        out.append((len(out), low * 100 // percent))
        low = out[-1][1] + 1
    return [*out, (len(out), low * 100 // percent)]


class Signer:
    """Signatures of sets for one threshold and seed.

    The lowest bit of a signature tells that it is for the band above the set's own. Two sets of one
    band meet under their own band's signatures, so groups need a member whose own band it is. The
    next bit is part of the name and tells that the band's number of differences k is odd: similar
    sets share at least three signatures, but only two where k is odd.
    """

    def __init__(self, percent: int, seed: int = 0):
        self.percent, self.seed = percent, seed
        self.ends = np.zeros(0, np.int64)

    def band(self, size: int) -> int:
        if not len(self.ends) or self.ends[-2] < size:
            self.ends = np.array([r for _, r in bands(2 * size, self.percent)])
        return int(np.searchsorted(self.ends, size))

    def signatures(self, items: np.ndarray) -> np.ndarray:
        if not len(items):
            return np.zeros(0, np.uint64)
        own = self.band(len(items))
        return np.concatenate(
            [
                (self._instance(items, band) << np.uint64(2)) | np.uint64(2 * (self.differences(band) % 2) + (band > own))
                for band in (own, own + 1)
            ]
        )

    def differences(self, band: int) -> int:
        """The most differences of two similar sets that meet in a band."""
        return 2 * int(self.ends[band]) * (100 - self.percent) // (100 + self.percent)

    def _instance(self, items: np.ndarray, band: int) -> np.ndarray:
        k = self.differences(band)
        if not k:  # such sets are similar only if they are equal
            return np.zeros(0, np.uint64)
        parts = k // 2 + 1 + SPARE
        spread = mix(items, 17 * self.seed + 1)
        part = ((spread >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        third = ((spread & np.uint64(0xFFFFFFFF)) * np.uint64(CHOICES) >> np.uint64(32)).astype(np.int64)
        cell = part * CHOICES + third
        order = np.argsort(cell, kind="stable")
        counts = np.bincount(cell, minlength=parts * CHOICES)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(items, 99)[order])])
        ends = np.cumsum(counts)
        own = (sums[ends] - sums[ends - counts]).reshape(parts, CHOICES)
        many = counts.reshape(parts, CHOICES)
        chosen = own.sum(axis=1, keepdims=True) - own  # without one third each
        filled = many.sum(axis=1, keepdims=True) - many
        name = mix(np.arange(parts * CHOICES, dtype=np.uint64), 1000 * band + self.seed + 5)
        found = mix(chosen.ravel() ^ name, 3)
        empty = filled == 0
        if np.count_nonzero(empty.any(axis=1)) > SPARE or empty.all(axis=1).any():
            return found
        return found[~empty.ravel()]


def map_words(size: int) -> int:
    """Words of the parity map of a set: MAP times a power of two."""
    return MAP << max(0, (size - 1) // MAP_ITEMS).bit_length()


def parity_map(items: np.ndarray) -> np.ndarray:
    """Whether an odd number of items falls into each of the buckets, as words."""
    buckets = 64 * map_words(len(items))
    odd = np.bincount((items >> np.uint64(20)).astype(np.int64) & (buckets - 1), minlength=buckets) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def folded(words: Column, size: Column) -> Column:
    """A parity map brought down to ``size`` words, a power of two."""
    pieces = F.sequence(F.lit(0), F.size(words).cast("int") - size, size)
    whole = F.aggregate(
        pieces, F.array_repeat(F.lit(0).cast("long"), size),
        lambda sums, at: F.zip_with(sums, F.slice(words, at + 1, size), lambda x, y: x.bitwiseXOR(y)),
    )
    return F.when(F.size(words) > size, whole).otherwise(words)


def shingle_summary(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, two fingerprints and the parity map of the set, for all rows of (doc_id, text)."""

    def summary(batch: pa.RecordBatch) -> pa.RecordBatch:
        forget()
        sizes, one, two, maps = [], [], [], []
        for part in sub_batches(batch, TEXT):
            for items in shingle_sets(*utf8(part), words):
                sizes.append(len(items))
                one.append(mix(items, 11).sum(dtype=np.uint64))
                two.append(mix(items, 12).sum(dtype=np.uint64))
                maps.append(parity_map(items))
        flat = pa.array(np.concatenate(maps) if maps else np.zeros(0, np.int64))
        ends = np.cumsum([0, *map(len, maps)], dtype=np.int32)
        return pa.record_batch(
            {
                "doc_id": batch.column("doc_id"), "n_shingles": pa.array(sizes, pa.int64()),
                "f1": pa.array(np.array(one, np.uint64).astype(np.int64)),
                "f2": pa.array(np.array(two, np.uint64).astype(np.int64)),
                "map": pa.ListArray.from_arrays(ends, flat),
            }
        )

    return in_batches(docs, summary, "doc_id long, n_shingles long, f1 long, f2 long, map array<long>")


def may_link(percent: int) -> Column:
    """Whether the maps of two sets (a_map, a_n, b_map, b_n) leave it open that they are similar."""
    size = F.least(F.size("a_map"), F.size("b_map"))
    both = (folded(F.col(c), size) for c in ("a_map", "b_map"))
    unlike = F.aggregate(F.zip_with(*both, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, n: s + n)
    larger, smaller = F.greatest("a_n", "b_n"), F.least("a_n", "b_n")
    every = F.col("a_n") + F.col("b_n")
    return (100 * smaller >= percent * larger) & ((100 + percent) * unlike <= (100 - percent) * every)


def signature_rows(docs: DataFrame, words: int, percent: int, seed: int = 0) -> DataFrame:
    """sig, doc_id: all signatures of (doc_id, text); the last bit is no part of the name."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        signer = Signer(percent, seed)
        for batch in batches:
            for part in sub_batches(batch, TEXT):
                found = [signer.signatures(s) for s in shingle_sets(*utf8(part), words)]
                ids = np.array(part.column("doc_id").to_pylist(), np.int64)
                yield pa.record_batch(
                    {
                        "sig": pa.array(np.concatenate(found).astype(np.int64)),
                        "doc_id": pa.array(np.repeat(ids, [len(f) for f in found])),
                    }
                )

    return docs.mapInArrow(sign, "sig long, doc_id long")


def _shared_groups(signatures: DataFrame) -> DataFrame:
    """grp, doc_id, own: the members of all signatures that several documents share.

    The lowest bit of grp tells that the band's number of differences is odd. Groups without a member of the signature's own band are left out.
    """

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        forget()
        number = TaskContext.get().partitionId() << 40  # short names, for smaller files
        name_now, doc_now, own_now, alone, fine = None, None, True, False, False
        for batch in batches:
            sig, doc = batch.column("sig").to_numpy(), batch.column("doc_id").to_numpy()
            name, own = sig >> 1, (sig & 1) == 0
            new = np.ones(len(sig), bool)
            new[1:] = name[1:] != name[:-1]
            new[0] = name_now is None or name[0] != name_now
            count = np.cumsum(new)
            group = number + count
            # Own members come first, so a group's first member tells whether it has any.
            has_own = np.concatenate([[fine], own[new]])[count]
            second = ~new
            second[1:] &= new[:-1]
            if not new[0]:
                second[0] = alone
            first_doc = np.concatenate([[doc[0] if doc_now is None else doc_now], doc[:-1]])
            first_own = np.concatenate([[own_now], own[:-1]])
            second, later = second & has_own, ~new & has_own
            grp = (group << 1) | (name & 1)
            yield pa.record_batch(
                {
                    "grp": pa.array(np.concatenate([grp[second], grp[later]])),
                    "doc_id": pa.array(np.concatenate([first_doc[second], doc[later]])),
                    "own": pa.array(np.concatenate([first_own[second], own[later]])),
                }
            )
            alone, fine = bool(new[-1]), bool(has_own[-1])
            name_now, doc_now, own_now, number = name[-1], doc[-1], bool(own[-1]), int(group[-1])

    sorted_ = signatures.repartition(F.shiftright("sig", 1)).sortWithinPartitions("sig")
    return sorted_.mapInArrow(shared, "grp long, doc_id long, own boolean")


def _possible(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) that their maps do not rule out."""
    of = lambda e: maps.select(F.col("doc_id").alias(e), F.col("n_shingles").alias(f"{e}_n"), F.col("map").alias(f"{e}_map"))
    return pairs.join(of("a"), "a").join(of("b"), "b").where(may_link(percent)).select("a", "b").distinct()


def _compared(docs: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """a, b of the written ``pairs`` that link. a leads, b follows.

    A leader's texts meet its followers' texts in groups of about FOLLOWERS; a group is streamed,
    and only the leader's sets (one, but for ids that repeat) and one follower's are held.
    """
    sizes = pairs.groupBy("a").agg(F.count("*").alias("n"))
    salts = sizes.select("a", F.ceil(F.col("n") / FOLLOWERS).cast("int").alias("salts"))
    salted = join_salts(pairs, salts)
    lead = salts.select(
        F.col("a").alias("doc_id"), F.col("a"), F.lit(None).cast("long").alias("b"),
        F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
    )
    follow = salted.select(F.col("b").alias("doc_id"), "a", "b", "salt")
    wanted = materialize(lead.unionByName(follow), "wanted")
    many = wanted.count()
    met = docs.join(F.broadcast(wanted) if many <= ID_ROWS else wanted, "doc_id").select("a", "salt", "b", "text")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        lead_now, leads, following = None, [], False
        for batch in batches:
            for part in sub_batches(batch, TEXT):
                a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
                keep = []
                for i, own in enumerate(shingle_sets(*utf8(part), words)):
                    if b[i] is None:
                        if lead_now != a[i] or following:
                            leads = []
                        if not any(np.array_equal(own, x) for x in leads):
                            leads.append(own)
                        lead_now, following = a[i], False
                        continue
                    following = True
                    for items in leads if lead_now == a[i] and len(own) else ():
                        both = len(np.intersect1d(items, own, assume_unique=True))
                        if both and 100 * both >= percent * (len(items) + len(own) - both):
                            keep.append(i)
                            break
                yield part.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    order = met.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return order.mapInArrow(verify, "a long, b long")


def join_salts(pairs: DataFrame, salts: DataFrame) -> DataFrame:
    """``pairs`` with a salt below the number that ``salts`` gives their leader."""
    hot = salts.where("salts > 1")
    # Leaders with over FOLLOWERS followers: at most one in FOLLOWERS pairs.
    out = pairs.join(hot, "a", "left")
    many = F.coalesce(F.col("salts"), F.lit(1))
    return out.select("a", "b", F.pmod(F.xxhash64("b"), many).cast("int").alias("salt"))


def similar_components(
    docs: DataFrame, words: int = 4, percent: int = 85, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """doc_id, n_shingles, component_id of every row: the smallest id reachable over links.

    Two texts link when 100 |A and B| >= ``percent`` |A or B|.
    """
    rows = docs.select(column(docs, doc_id).cast("long").alias("doc_id"), column(docs, text).alias("text"))
    sets = materialize(shingle_summary(rows, words), "sets")
    named = sets.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    mark = ["n_shingles", "f1", "f2"]
    classes = named.groupBy(*mark).agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"))
    classes = classes.where("rep < last").drop("last")
    copies = materialize(
        join_lookup(named.drop("map"), classes, mark).where("doc_id <> rep").select("doc_id", "rep").distinct(), "copies"
    )
    # An id with several texts, of which one is a copy, stays for the others.
    own = join_lookup(named.select("doc_id", *mark), copies.select("doc_id").distinct(), ["doc_id"], how="left_semi")
    spent = own.groupBy("doc_id").agg(F.countDistinct(*mark).alias("n")).where("n = 1").select("doc_id")
    usable = rows.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    members = materialize(_shared_groups(signature_rows(anti_join(usable, spent), words, percent)), "groups")
    links = _links(usable, members, named.select("doc_id", "n_shingles", "map"), words, percent)
    same = copies.select(F.col("doc_id").alias("b"), F.col("rep").alias("a"))
    ends = materialize(components(links.unionByName(same)), "components")
    out = sets.select("doc_id", "n_shingles").join(ends.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def _links(docs: DataFrame, members: DataFrame, maps: DataFrame, words: int, percent: int) -> DataFrame:
    """a, b: verified links that connect all similar documents.

    In each round every open group has a leader, and its members are compared with it: as many pairs
    as members. Leaders are drawn by a hash, then are those with the most links so far, then those
    without any. Groups within one component are done. What is left is compared across components, where
    the maps and, pair by pair, the number of shared signatures do not rule it out.

    A pair is not tested that shares too few signatures. A part without a difference gives three, with
    one difference one, and empty choices are left out of one part at most. For even k the fewest are
    three (no part without a difference: four with one, one of them left out; else more). For odd k
    three parts with one difference each can be all that agree, which leaves two. A pair meets in one
    band only, so all its groups tell the same of k. So every similar pair is tested or connected.
    """
    nodes = degrees = None
    found = []
    for turn in range(ROUNDS):
        named = _labelled(members, nodes, degrees)
        draw = F.xxhash64("doc_id", F.lit(turn)).alias("h")
        first = (F.lit(0), F.col("degree"), -F.col("degree"))[turn]
        leader = F.max(F.struct("own", first.alias("f"), draw, "doc_id"))
        heads = named.groupBy("grp").agg(leader.alias("l"), F.min("component").alias("lo"), F.max("component").alias("hi"))
        heads = heads.where("lo < hi").select("grp", F.col("l.doc_id").alias("a"))
        met = named.join(heads, "grp").select(*members.columns, "a")
        met = materialize(met, "open") if turn else met
        pairs = met.where("a <> doc_id").select("a", F.col("doc_id").alias("b")).distinct()
        pairs = materialize(_possible(pairs, maps, percent), "pairs")
        found.append(materialize(_compared(docs, pairs, words, percent), "links"))
        nodes = materialize(components(_union(found)), "nodes")
        degrees = materialize(_degrees(_union(found)), "degrees")
        members = met.drop("a")
    left = materialize(_open_groups(_labelled(members, nodes, degrees)), "left")
    near = materialize(_near_families(left.where("family IS NOT NULL"), maps, percent), "near")
    across = _near_pairs(left.where("family IS NULL"), maps, percent).groupBy("a", "b")
    odd = F.max(F.col("grp").bitwiseAND(F.lit(1)))
    # ``near`` has all pairs that share a group with a family; of others all shared groups are counted here.
    rest = across.agg((F.count("*") + odd).alias("n")).where("n >= 3").select("a", "b").unionByName(near)
    rest = materialize(_possible(materialize(rest, "rest"), maps, percent), "pairs")
    found.append(materialize(_compared(docs, rest, words, percent), "links"))
    return _union(found)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _degrees(links: DataFrame) -> DataFrame:
    both = links.select(F.col("a").alias("doc_id")).unionAll(links.select("b"))
    return both.groupBy("doc_id").agg(F.count("*").alias("degree"))


def _open_groups(named: DataFrame) -> DataFrame:
    """The members of groups with several components.

    ``family``: the component with the most linked member, where more than DIRECT pairs a member lie across components.
    """
    parts = named.groupBy("grp", "component").agg(F.count("*").alias("n"), F.max("degree").alias("degree"))
    every, within = F.sum("n"), F.sum(F.col("n") * F.col("n"))
    most = F.max(F.struct("degree", "component")).alias("most")
    split = parts.groupBy("grp").agg(every.alias("n"), (every * every - within).alias("across"), most)
    family = F.when(F.col("across") > 2 * DIRECT * F.col("n"), F.col("most.component")).alias("family")
    return named.join(split.where("across > 0").select("grp", family), "grp")


def _pairs_within(ends: np.ndarray, component: np.ndarray, n: np.ndarray, own: np.ndarray, maps: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the pairs across components that their maps leave open, in the groups of rows before each of ``ends``."""
    few = np.bitwise_xor.reduce(maps.reshape(len(maps), -1, FOLD), axis=1)

    def left_open(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        open_ = (component[a] != component[b]) & (own[a] | own[b])
        open_ &= 100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b])
        a, b = a[open_], b[open_]
        for words in (few, maps):
            unlike = np.bitwise_count(words[a] ^ words[b]).sum(axis=1, dtype=np.int64)
            open_ = (100 + percent) * unlike <= (100 - percent) * (n[a] + n[b])
            a, b = a[open_], b[open_]
        return a, b

    begins = np.concatenate([[0], ends[:-1]])
    large = ends - begins > BESIDE
    for begin, end in zip(begins[large].tolist(), ends[large].tolist(), strict=True):
        most = (100 - percent) * (n[begin:end] + n[begin:end].max()) // (100 + percent)
        columns = np.ascontiguousarray(few[begin:end].T)
        at, size = 0, end - begin
        while at < size:
            to = min(size, at + max(1, _PAIRS // (size - at)))
            unlike = np.zeros((to - at, size - at), np.uint16)
            for words in columns:
                unlike += np.bitwise_count(words[at:to, None] ^ words[None, at:])
            a, b = np.nonzero(unlike <= np.minimum(most[at:to], 64 * FOLD).astype(np.uint16)[:, None])
            yield left_open(begin + at + a[a < b], begin + at + b[a < b])
            at = to
    # A row of a small group meets the rows behind it.
    rows = np.arange(len(n))
    behind = np.repeat(np.where(large, 0, ends), ends - begins) - rows - 1
    rows, behind = rows[behind > 0], behind[behind > 0]
    sums = np.cumsum(behind)
    at = 0
    while at < len(rows):
        met = sums[at] - behind[at]
        to = max(at + 1, int(np.searchsorted(sums, met + _PAIRS, side="right")))
        a = np.repeat(rows[at:to], behind[at:to])
        b = a + 1 + np.arange(len(a)) - np.repeat(sums[at:to] - behind[at:to] - met, behind[at:to])
        yield left_open(a, b)
        at = to


def _near_pairs(left: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """grp, a, b: the pairs of each group across components that their maps do not rule out. a is the smaller id."""

    def pairs(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        grp, doc, component, n, own = (rows.column(c).to_numpy() for c in ("grp", "doc_id", "component", "n", "own"))
        words = pa.concat_arrays(rows.column("map").chunks).flatten().to_numpy().view(np.uint64).reshape(len(doc), MAP)
        ends = np.append(np.flatnonzero(grp[1:] != grp[:-1]) + 1, len(grp))
        for a, b in _pairs_within(ends, component, n, own, words, percent):
            if len(a):
                yield pa.record_batch({"grp": pa.array(grp[a]), "a": pa.array(doc[a]), "b": pa.array(doc[b])})

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        held: list[pa.RecordBatch] = []
        for batch in batches:
            grp = batch.column("grp").to_numpy()
            last = int(np.searchsorted(grp, grp[-1])) if len(grp) else 0
            if last or held and len(grp) and held[-1].column("grp")[-1].as_py() != grp[0]:
                yield from pairs([*held, batch.slice(0, last)])
                held = []
            if len(grp):
                held.append(batch.slice(last))
        if held:
            yield from pairs(held)

    # Members repeat their map in every group, so the smallest form of it; pairs get the whole one later.
    small = maps.select("doc_id", F.col("n_shingles").alias("n"), folded(F.col("map"), F.lit(MAP)).alias("map"))
    named = left.join(small, "doc_id").select("grp", "doc_id", "own", "component", "n", "map")
    # In the order of ids: those that are one id are one component.
    sorted_ = named.repartition("grp").sortWithinPartitions("grp", "doc_id")
    return sorted_.mapInArrow(met, "grp long, a long, b long")


def _bits(words: pa.Scalar, size: int) -> np.ndarray:
    """The bits of a parity map folded to ``size`` words."""
    folded_ = np.bitwise_xor.reduce(words.values.to_numpy().reshape(-1, size))
    return np.unpackbits(folded_.view(np.uint8), bitorder="little")


def _usual(rows: DataFrame) -> DataFrame:
    """family, ref, often: the buckets that are odd in most members' maps, and those in which several members differ from that."""

    def tally(batch: pa.RecordBatch) -> pa.RecordBatch:
        sums: dict[int, np.ndarray] = {}
        for family, words, size in zip(batch.column("family").to_pylist(), batch.column("map"), batch.column("words").to_pylist(), strict=True):
            bits = _bits(words, size)
            sums[family] = sums[family] + bits if family in sums else bits.astype(np.int64)
        filled = [np.flatnonzero(x) for x in sums.values()]
        return pa.record_batch(
            {
                "family": pa.array(np.repeat(np.array(list(sums), np.int64), list(map(len, filled)))),
                "bit": pa.array(np.concatenate(filled)),
                "many": pa.array(np.concatenate([x[at] for x, at in zip(sums.values(), filled, strict=True)])),
            }
        )

    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: dict[str, list] = {"ref": [], "often": []}
        for at, many, size, n in zip(*(batch.column(c) for c in ("at", "many", "words", "members")), strict=True):
            counts, n = np.zeros(64 * size.as_py(), np.int64), n.as_py()
            counts[at.values.to_numpy()] = many.values.to_numpy()
            for name, bits in (("ref", 2 * counts > n), ("often", np.minimum(counts, n - counts) > max(2, n // 64))):
                out[name].append(np.packbits(bits, bitorder="little").view(np.int64))
        kind = pa.list_(pa.int64())
        return pa.record_batch({"family": batch.column("family"), **{k: pa.array(v, kind) for k, v in out.items()}})

    sizes = rows.groupBy("family").agg(F.first("words").alias("words"), F.count("*").alias("members"))
    counts = in_batches(rows, tally, "family long, bit long, many long").groupBy("family", "bit").agg(F.sum("many").alias("many"))
    # At most as many buckets as the family's smallest map has.
    lists = counts.groupBy("family").agg(F.collect_list(F.struct("bit", "many")).alias("x"))
    lists = lists.select("family", F.col("x.bit").alias("at"), F.col("x.many").alias("many")).join(sizes, "family")
    return in_batches(lists, pack, "family long, ref array<long>, often array<long>")


def _unlike(rows: DataFrame) -> DataFrame:
    """``bits``: where a member's map differs from the usual one of its family, rare ones first."""

    def differ(batch: pa.RecordBatch) -> pa.RecordBatch:
        bits = []
        size = batch.column("words").to_pylist()
        for own, ref, often, n in zip(*(batch.column(c) for c in ("map", "ref", "often")), size, strict=True):
            at = np.flatnonzero(_bits(own, n) ^ _bits(ref, n))
            bits.append(at[np.argsort(_bits(often, n)[at], kind="stable")].astype(np.int32))
        names = ["family", "doc_id", "component", "n"]
        ends = np.cumsum([0, *map(len, bits)], dtype=np.int32)
        flat = pa.array(np.concatenate(bits) if bits else np.zeros(0, np.int32))
        return pa.record_batch([*map(batch.column, names), pa.ListArray.from_arrays(ends, flat)], names=[*names, "bits"])

    return in_batches(rows, differ, "family long, doc_id long, component long, n long, bits array<int>")


def _near_families(left: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """a, b: all pairs of a family's members across components that their maps do not rule out, and few others.

    Let D be the buckets in which a member's map differs from the family's usual one, and
    e = (100 + percent) |D| - (100 - percent) n. The maps of two members differ in |Da| + |Db| - 2 |Da and Db|
    buckets, so they leave a link open only if ea + eb <= 2 (100 + percent) |Da and Db|. Members that a large
    component does not link have large D, so pairs need many buckets in common. Members are cut into steps of e.
    With s as the fewest buckets that a partner of some step leaves, a member and a partner have one in
    common among the first |D| - s + 1 of each, in any order that holds for both; rare ones come first. So
    members meet under few buckets that few others have, not each with each, and what a member has left
    after the bucket they meet in rules out more.
    """
    own = left.select("family", "doc_id", "component").distinct().join(maps.withColumnRenamed("n_shingles", "n"), "doc_id")
    own = materialize(own, "own")
    own = join_lookup(own, own.groupBy("family").agg(F.min(F.size("map")).alias("words")), ["family"])
    each, twice = 100 - percent, 2 * (100 + percent)
    width = twice * STEP
    e = (100 + percent) * F.col("many") - each * F.col("n")
    rows = _unlike(join_lookup(own, _usual(own), ["family"])).withColumn("many", F.size("bits")).withColumn("e", e)
    rows = rows.withColumn("step", F.floor(F.col("e") / width)).withColumn("inside", F.col("component") == F.col("family"))
    rows = materialize(rows, "unlike")
    steps = rows.groupBy("family").agg(
        F.collect_set(F.when(F.col("inside"), F.col("step"))).alias("within"),
        F.collect_set(F.when(~F.col("inside"), F.col("step"))).alias("beyond"),
    )
    rows = join_lookup(rows, steps, ["family"])
    outside = rows.where(~F.col("inside"))

    def buckets(members: DataFrame, kind: Column, partners: str, end: str) -> DataFrame:
        """A row for each bucket that a member may meet a partner in; -1 where they need none in common."""
        met = members.withColumn("partner", F.explode(partners))
        # As many buckets as they need, the partner has to have at all.
        met = met.where(percent * (F.col("e") - (F.col("partner") + 1) * width) <= 200 * each * F.col("n"))
        fewest = F.ceil((F.col("e") + F.col("partner") * width) / twice).cast("int")
        begin = F.slice("bits", 1, F.greatest(F.col("many") - fewest + 1, F.lit(0)))
        some = F.when(fewest > 0, begin).otherwise(F.concat("bits", F.array(F.lit(-1))))
        met = met.select("*", kind.alias("kind"), F.posexplode(some).alias("at", "bit"))
        rest = F.when(F.col("bit") < 0, F.lit(0)).otherwise(F.col("many") - F.col("at"))
        names = {"doc_id": end, "component": f"{end}_component", "n": f"{end}_n", "e": f"{end}_e"}
        names |= {"step": f"{end}_step", "partner": f"{'ab'[end == 'a']}_step"}
        return met.select("family", "kind", "bit", *(F.col(k).alias(v) for k, v in names.items()), rest.alias(f"{end}_rest"))

    # Kind 0: inside with outside; kind 1: outside with outside.
    one = buckets(rows, (~F.col("inside")).cast("int"), "beyond", "a")
    two = buckets(outside, F.lit(0), "within", "b").unionByName(buckets(outside, F.lit(1), "beyond", "b"))
    rule = (F.col("kind") == 0) | ((F.col("a") < F.col("b")) & (F.col("a_component") != F.col("b_component")))
    sizes = 100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")
    enough = F.col("a_e") + F.col("b_e") <= twice * F.least("a_rest", "b_rest")
    met = one.join(two, ["family", "kind", "a_step", "b_step", "bit"]).where(rule & sizes & enough)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _labelled(members: DataFrame, nodes: DataFrame | None, degrees: DataFrame | None = None) -> DataFrame:
    """Members with their component and degree; unlinked documents are their own component."""
    if nodes is None:
        return members.withColumns({"component": F.col("doc_id"), "degree": F.lit(0)})
    label = nodes.select(F.col("node").alias("doc_id"), "component")
    if degrees is not None:
        label = label.join(degrees, "doc_id", "left")
    label = F.broadcast(label) if nodes.count() <= ID_ROWS else label
    out = members.join(label, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    return out if degrees is None else out.withColumn("degree", F.coalesce("degree", F.lit(0)))


ship(__name__)
