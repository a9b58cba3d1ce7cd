"""Benchmark items inside documents: size-partitioned MinHash containment search, then exact proof.

Words are runs of letters and digits in small letters; a set holds the distinct five-word shingles.
An item is found in a document that holds at least ``share`` of the item's shingles.

The search works on bottom-m MinHash sketches of the items: the m shingles with the smallest hash
values. Items are partitioned by size (powers of two), and m follows from the largest size of the
partition: with m = floor((1 - share) * size) + 1 a document that holds enough of the item cannot
miss all m, so no pair is lost however long the document is. (Banding MinHashes of whole documents
cannot do this: an item of 30 shingles in a document of 3,000 has a Jaccard similarity of 0.01.) A
document is looked up by its shingles' hashes against the sketches; pairs that meet are candidates,
and their shingles are then compared as text.

Sketches are broadcast in blocks of at most SKETCH_ROWS hashes, each a pass over the documents, so a
block's size is proven, however many items there are. Candidate pairs are one row per document and
item that meet.

Defined results: null, empty and short texts (under five words) hold no shingles and are in no pair;
rows of one id are one document, and rows of one item id one item; rows without an id take no part;
further columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewright.llm.common import column, materialize
from tapewright.operators.joins import join_lookup

WORDS = 5
#: Hashes in one broadcast of sketches, and ids in one broadcast of candidate documents.
SKETCH_ROWS = 500_000
ID_ROWS = 500_000


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def _windows(make) -> Column:
    """``make(first .. fifth word)`` for every place of the column ``words`` where five words stand."""
    last = F.size("words") - WORDS
    each = F.transform(
        F.sequence(F.lit(0), last), lambda i: make(*[F.get(F.col("words"), i + k) for k in range(WORDS)])
    )
    return F.when(last >= 0, each)


def _hashes(rows: DataFrame, *keep: str) -> DataFrame:
    return rows.select(*keep, F.explode(_windows(F.xxhash64)).alias("hash"))


def _shingles(rows: DataFrame, *keep: str) -> DataFrame:
    return rows.select(*keep, F.explode(_windows(lambda *w: F.concat_ws(" ", *w))).alias("shingle"))


def _worded(df: DataFrame, id_name: str, text: str, alias: str) -> DataFrame:
    rows = df.select(column(df, id_name).alias(alias), column(df, text).alias("text"))
    rows = rows.where(F.col(alias).isNotNull() & F.col("text").isNotNull())
    return rows.select(alias, words_of(F.col("text")).alias("words"))


def item_sketches(items: DataFrame, share: float) -> DataFrame:
    """item_id, hash: the bottom-m sketch of each item. ``items``: item_id, words."""
    hashes = _hashes(items, "item_id").distinct()
    sized = hashes.withColumn("size", F.count("*").over(Window.partitionBy("item_id")))
    top = F.pow(F.lit(2), F.ceil(F.log2("size")))  # the largest size of the item's partition
    m = F.floor(F.lit(1 - share) * top + 1e-9) + 1
    order = F.row_number().over(Window.partitionBy("item_id").orderBy("hash"))
    return sized.withColumn("m", m).withColumn("nth", order).where("nth <= m").select("item_id", "hash")


def candidates(docs: DataFrame, sketches: DataFrame) -> DataFrame:
    """doc_id, item_id of pairs that share a hash of the item's sketch. ``sketches`` is written."""
    blocks = max(1, -(-sketches.count() // SKETCH_ROWS))
    found = None
    hashes = _hashes(docs, "doc_id")
    for block in range(blocks):
        part = sketches.where(F.pmod(F.col("hash"), F.lit(blocks)) == block) if blocks > 1 else sketches
        # Blocks hold about SKETCH_ROWS rows, as hashes are spread evenly.
        met = hashes.join(F.broadcast(part), "hash").select("doc_id", "item_id")
        found = met if found is None else found.unionByName(met)
    return found.distinct()


def contained(
    docs: DataFrame, items: DataFrame, share: float = 0.8,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """doc_id, item_id, item_shingles, shared, containment of all pairs with enough in common."""
    tested = _worded(items, item_id, item_text, "item_id")
    rows = _worded(docs, doc_id, text, "doc_id")
    pairs = materialize(candidates(rows, materialize(item_sketches(tested, share), "sketches")), "candidates")
    ids = pairs.select("doc_id").distinct()
    if pairs.count() <= ID_ROWS:
        ids = F.broadcast(ids)  # no more than that
    sized = _shingles(tested, "item_id").distinct()
    sized = sized.withColumn("item_shingles", F.count("*").over(Window.partitionBy("item_id")))
    held = _shingles(rows.join(ids, "doc_id", "left_semi"), "doc_id").distinct()
    # Each candidate's item shingles, met by the document's own.
    wanted = join_lookup(pairs, sized, ["item_id"])
    return (
        wanted.join(held, ["doc_id", "shingle"])
        .groupBy("doc_id", "item_id", "item_shingles")
        .agg(F.count("*").alias("shared"))
        .where(F.col("shared") >= F.lit(share) * F.col("item_shingles") - 1e-9)
        .withColumn("containment", F.col("shared") / F.col("item_shingles"))
    )
