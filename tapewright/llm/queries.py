"""The queries of this subpackage with their production parameters, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.llm import ann, bpecount, decontam, idcodec, kmeans, merkle, mincut, packing, partenum, ppm, ring, skipcrf, warc
from tapewright.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by prediction by partial matching."""
    return ppm.language_id(table(spark, sf_dir, "documents"))


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by heap-and-list merging."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return bpecount.token_counts(table(spark, sf_dir, "documents"), path)


@query
def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents on 16 shards of a ring with bounded loads."""
    return ring.ring_shards(table(spark, sf_dir, "documents"))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    packed = packing.best_fit(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), keep_ids=False
    )
    return packed.select(
        "doc_id", "piece", "start", "length", F.col("ids_crc32"), "sequence_id", "offset"
    )


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold four fifths of a benchmark item's five-word shingles."""
    return decontam.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op4_decontamination"] = r"""
WITH words AS (
  SELECT 0 AS kind, doc_id AS id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents
  UNION ALL
  SELECT 1, item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') FROM benchmark
), places AS (
  SELECT kind, id, w, unnest(range(1, len(w) - 3)) AS i FROM words WHERE id IS NOT NULL AND len(w) >= 5
), shingles AS (
  SELECT DISTINCT kind, id, array_to_string(w[i : i + 4], ' ') AS shingle FROM places
), items AS (
  SELECT id AS item_id, shingle, count(*) OVER (PARTITION BY id) AS item_shingles FROM shingles WHERE kind = 1
)
SELECT d.id AS doc_id, item_id, item_shingles, count(*) AS shared,
       count(*) / item_shingles AS containment
FROM shingles d JOIN items USING (shingle)
WHERE d.kind = 0
GROUP BY d.id, item_id, item_shingles
HAVING 5 * count(*) >= 4 * item_shingles
"""


@query
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under four-word Jaccard similarity of 0.85."""
    return partenum.similar_components(table(spark, sf_dir, "documents"))


@query
def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data of every document by rules and a skip-chain field."""
    return skipcrf.personal_data(table(spark, sf_dir, "documents"))


@query
def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth embedding, by learned partitions."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


@query
def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page by a minimum cut."""
    return mincut.extract(table(spark, sf_dir, "pages"))


@query
def op2_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents through range-coded files."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return idcodec.round_trip(table(spark, sf_dir, "documents"), path, keep_ids=False)


@query
def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle proofs of all documents; every seventh by checksum is verified with one more character."""
    digits = F.col("doc_id").cast("string").cast("binary")
    tampered = F.coalesce(F.crc32(digits) % 7 == 0, F.lit(False))
    more = F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    changed = [F.col("doc_id"), F.col("source"), F.col("lang"), more, F.col("text")]
    return merkle.manifest(table(spark, sf_dir, "documents"), changed=changed, keep_proof=False)


#: One bit of a CRC-32 (reflected, polynomial 0xEDB88320), and the CRC-32 of a decimal number.
_BIT = "list_reduce([{0}] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0], lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))"
_CRC = f"""xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT),
  lambda s, b: {_BIT.format("xor(s, b)")}), 4294967295)"""


def _sized(*fields: str) -> str:
    return " || ".join(f"coalesce(strlen({f}::VARCHAR) || ':' || {f}::VARCHAR, '-')" for f in fields)


ORACLE["op13_manifest"] = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('1' || lang, '0') AS tree,
         sha256({_sized("doc_id", "source", "lang", "n_chars", "text")}) AS leaf,
         sha256({_sized("doc_id", "source", "lang", f"(n_chars + CASE WHEN ({_CRC}) % 7 = 0 THEN 1 ELSE 0 END)", "text")}) AS seen
  FROM documents
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves
), nodes AS (
  SELECT 0 AS level, tree, i, leaf AS hash, count(*) OVER (PARTITION BY tree) AS n FROM ranked
  UNION ALL
  SELECT * FROM (
    SELECT level + 1, tree, i // 2, sha256(string_agg(hash, '' ORDER BY i)), (any_value(n) + 1) // 2
    FROM nodes WHERE n > 1 GROUP BY level, tree, i // 2
  )
), subroots AS (
  SELECT tree, hash AS subroot, row_number() OVER (ORDER BY tree) - 1 AS i FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS level, i, subroot AS hash, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT * FROM (
    SELECT level + 1, i // 2, sha256(string_agg(hash, '' ORDER BY i)), (any_value(n) + 1) // 2
    FROM tops WHERE n > 1 GROUP BY level, i // 2
  )
), every AS (
  SELECT level, tree, i, hash, n FROM nodes
  UNION ALL
  SELECT level, '', i, hash, n FROM tops
), way AS (
  SELECT r.doc_id, r.tree AS doc_tree, r.i AS doc_i, 0 AS step, r.tree, 0 AS level, r.i, r.seen AS now, s.i AS top_i
  FROM ranked r JOIN subroots s USING (tree)
  UNION ALL
  SELECT doc_id, doc_tree, doc_i, step + 1, CASE WHEN up THEN w.tree ELSE '' END, CASE WHEN up THEN w.level + 1 ELSE 0 END,
         CASE WHEN up THEN w.i // 2 ELSE top_i END,
         CASE WHEN NOT up THEN now WHEN o.hash IS NULL THEN sha256(now) WHEN w.i % 2 = 1 THEN sha256(o.hash || now)
              ELSE sha256(now || o.hash) END, top_i
  FROM (SELECT w.*, e.n > 1 AS up FROM way w JOIN every e ON w.tree = e.tree AND w.level = e.level AND w.i = e.i) w
  LEFT JOIN every o ON w.tree = o.tree AND w.level = o.level AND xor(w.i, 1) = o.i
  WHERE up OR w.tree <> ''
), proofs AS (
  SELECT doc_tree, doc_i, sha256(coalesce(string_agg(o.hash, '' ORDER BY step), '')) AS proof_sha256,
         arg_max(now, step) AS folded_root
  FROM way w LEFT JOIN every o ON w.tree = o.tree AND w.level = o.level AND xor(w.i, 1) = o.i
  GROUP BY doc_tree, doc_i
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM ranked JOIN subroots USING (tree) JOIN proofs ON doc_tree = ranked.tree AND doc_i = ranked.i
CROSS JOIN (SELECT hash AS root FROM tops WHERE n = 1)
"""


@query
def op11_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through WARC archives: one stream per file, then one member per record."""
    found = warc.archived(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op11_archives"] = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS bytes FROM pages
), kept AS (
  SELECT *, CASE WHEN bytes >= 1000 THEN max(page_id) OVER (PARTITION BY body) END AS response FROM payloads
)
SELECT page_id, bytes AS payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN response <> page_id OR (page_id IS NULL AND response IS NOT NULL) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN response <> page_id OR (page_id IS NULL AND response IS NOT NULL) THEN response END AS refers_to
FROM kept
"""


@query
def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings in 40 clusters after five rounds, in whole numbers."""
    return kmeans.clustered(table(spark, sf_dir, "embeddings"))


def _kmeans_sql(k: int = 40, rounds: int = 5) -> str:
    """The rounds one after the other, each a full scan."""
    steps = [f"""WITH kept AS (
  SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS cluster, v AS c FROM kept
  ORDER BY sha256('2:' || vec_id), v LIMIT {k}
)"""]
    for i in range(rounds + 1):
        steps.append(f"""d{i} AS (
  SELECT vec_id, v, cluster, list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance
  FROM kept CROSS JOIN c{i}
), a{i} AS (
  SELECT vec_id, v, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance FROM d{i} GROUP BY vec_id, v
)""")
        if i < rounds:
            steps.append(f"""s{i} AS (
  SELECT cluster, dim, sum(x)::BIGINT AS s, count(*) AS n
  FROM (SELECT cluster, unnest(v) AS x, unnest(range(64)) AS dim FROM a{i}) GROUP BY cluster, dim
), m{i} AS (
  SELECT cluster, list((s - ((s % n + n) % n)) // n ORDER BY dim) AS c FROM s{i} GROUP BY cluster
), c{i + 1} AS (SELECT cluster, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (cluster))""")
    return ", ".join(steps) + f"""
SELECT vec_id, cluster::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (cluster)"""


ORACLE["op12_clusters"] = _kmeans_sql()
