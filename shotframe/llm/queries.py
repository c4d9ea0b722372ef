"""Registered queries of this folder, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir, table
from .decontam import contaminated
from .jaccard_join import jaccard_join
from .langid import fit, held_out, language_id
from .merkle import merkle_manifest, row_digest, with_folded
from .minhash import minhash_near_dedup
from .packing import pack_documents
from .prefix_trie import grafted, numbered_turns, prefix_trie
from .secret_scan import joined_spans, secret_scan
from .seekable import read_token_ids, write_token_ids
from .substring_dedup import substring_dedup
from .tiff import page_digests, text_media, tiff_pages
from .token_count import token_counts
from .tokens import vocabulary
from .warc import audit, copy_warc, write_warc


def op1_hierarchical_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tree = fit(docs.where(~held_out()))
    return language_id(docs, tree).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


def op2_tiff_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    media = text_media(table(spark, sf_dir, "documents"), width=64)
    stored = media.select("doc_id", "n_bytes", F.length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), "media")
    kept = ("doc_id", "n_bytes", "media_bytes", "media_sha256")
    read = page_digests(tiff_pages(stored, "media", kept), kept)
    return read.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")


def op3_whole_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), limit=512)


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"), links=True)


def op5_seekable_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/ids"
    files = write_token_ids(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), folder, end_id=2)
    return read_token_ids(files, folder).drop("ids")


def op6_shortest_pack_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), capacity=4096, end_id=2)


def op7_trigram_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan(table(spark, sf_dir, "documents"))
    number = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda x: x["kind"].isin("assign", "access", "hex"))
    return found.select("doc_id", number("assign"), number("access"), number("hex"), F.sha2(joined_spans(base).cast("binary"), 256).alias("base_sha256"), joined_spans(F.col("spans")).alias("spans"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(table(spark, sf_dir, "documents"), window=13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op9_bm25_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _one_bit(page_id: int | None, data: bytes) -> bytes:
    """Flips a bit in the middle of the record of every 97th page: known damage for the audit to locate."""
    if page_id is None or page_id % 97 != 13:
        return data
    at = len(data) // 2
    return data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :]


def op10_merkle_fixity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark)
    manifest = write_warc(table(spark, sf_dir, "pages"), f"{folder}/a")
    copy_warc(manifest, f"{folder}/a", f"{folder}/b", _one_bit)
    return audit(manifest, f"{folder}/a", f"{folder}/b").select(F.col("id").alias("page_id"), "file", "offset", "length", "hash", "replica_hash", "damaged")


def op11_minhash_hamming_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_near_dedup(table(spark, sf_dir, "documents"), words=2, percent=80)


def op12_merkle_traversal_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(chosen & F.contains("text", F.lit("\n")), row_digest(*(F.col(c) for c in ("doc_id", "source", "lang", "n_chars")), F.replace("text", F.lit("\n"), F.lit(""))))
    rows = merkle_manifest(docs, also=tampered).withColumn("start", F.coalesce("also", "leaf"))
    rows = with_folded(rows, "start")
    proof = F.sha2(F.translate("path", ":/", "").cast("binary"), 256)
    return rows.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_patricia_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = numbered_turns(table(spark, sf_dir, "conversations"))
    conv = F.col("conv")
    return prefix_trie(*grafted(turns, conv - conv % 100, F.crc32(conv.cast("string").cast("binary")) % 6))


QUERIES = {
    "op1_hierarchical_language_id": op1_hierarchical_language_id,
    "op2_tiff_media": op2_tiff_media,
    "op3_whole_token_counts": op3_whole_token_counts,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_seekable_token_ids": op5_seekable_token_ids,
    "op6_shortest_pack_first": op6_shortest_pack_first,
    "op7_trigram_secret_scan": op7_trigram_secret_scan,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_bm25_decontamination": op9_bm25_decontamination,
    "op10_merkle_fixity_audit": op10_merkle_fixity_audit,
    "op11_minhash_hamming_join": op11_minhash_hamming_join,
    "op12_merkle_traversal_manifest": op12_merkle_traversal_manifest,
    "op13_patricia_prefix_trie": op13_patricia_prefix_trie,
}

#: crc32 of the decimal text of a number in SQL: eight steps a character.
_CRC32 = "xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split({}::VARCHAR, ''), lambda x: [ord(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), lambda c, v: xor(xor(c, v) >> 1, 3988292384 * (xor(c, v) & 1))), 4294967295::BIGINT)"
_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_ROW = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || {})"

ORACLE_SQL = {
    "op4_ngram_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, hash(array_to_string(ws[i : i + 4], ' ')) AS g
  FROM w, unnest(generate_series(1, greatest(len(ws) - 4, CASE WHEN len(ws) > 0 THEN 1 ELSE 0 END))) AS t(i)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM o JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, k.copies_of, coalesce(l.n_links, 0) AS n_links
FROM documents AS d LEFT JOIN n USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, count(*) AS n_links FROM e GROUP BY a) AS l USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) AS c USING (doc_id)
JOIN (SELECT d.doc_id, least(d.doc_id, min(x.b)) AS copies_of FROM documents AS d
      LEFT JOIN (SELECT o.a, o.b FROM o JOIN n AS p ON p.doc_id = o.a JOIN n AS q ON q.doc_id = o.b WHERE o.o = p.n AND p.n = q.n) AS x ON x.a = d.doc_id
      GROUP BY d.doc_id) AS k USING (doc_id)
""",
    "op11_minhash_hamming_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, hash(array_to_string(ws[i : i + 1], ' ')) AS g
  FROM w, unnest(generate_series(1, greatest(len(ws) - 1, CASE WHEN len(ws) > 0 THEN 1 ELSE 0 END))) AS t(i)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM o JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, c.component_id = d.doc_id AS kept
FROM documents AS d LEFT JOIN n USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) AS c USING (doc_id)
""",
    "op8_substring_dedup": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, i, array_to_string(ws[i : i + 12], ' ') AS win FROM w, unnest(generate_series(1, len(ws) - 12)) AS t(i)),
m AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY win) AS least_id FROM p),
c AS (SELECT DISTINCT doc_id, i + k AS j FROM m, range(13) AS t(k) WHERE least_id < doc_id),
x AS (SELECT doc_id, j, ws[j] AS word FROM w, unnest(generate_series(1, len(ws))) AS t(j)),
k AS (SELECT x.doc_id, x.word, x.j, c.j IS NOT NULL AS gone FROM x LEFT JOIN c USING (doc_id, j)),
a AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY j) FILTER (NOT gone), '') AS kept FROM k GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents AS d LEFT JOIN a USING (doc_id)
""",
    "op12_merkle_traversal_manifest": f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('+' || source, '') AS tree, {_ROW.format(_FIELD.format("text"))} AS leaf,
         CASE WHEN {_CRC32.format("doc_id")} % 2 = 0 THEN {_ROW.format(_FIELD.format("replace(text, chr(10), '')"))} END AS other
  FROM documents),
t AS (
  SELECT 0 AS lvl, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM d
  UNION ALL
  SELECT lvl + 1, tree, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 2) // 3 FROM t WHERE n > 1 GROUP BY lvl, tree, pos // 3),
u AS (
  SELECT 0 AS lvl, tree, row_number() OVER (ORDER BY tree) - 1 AS pos, h, count(*) OVER () AS n FROM t WHERE n = 1
  UNION ALL
  SELECT lvl + 1, NULL, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 2) // 3 FROM u WHERE n > 1 GROUP BY lvl, pos // 3),
f AS (
  SELECT doc_id, tree, leaf, 0 AS lvl, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n, coalesce(other, leaf) AS x, '' AS proof FROM d
  UNION ALL
  SELECT f.doc_id, f.tree, f.leaf, f.lvl + 1, f.pos // 3, (f.n + 2) // 3, sha256(string_agg(CASE WHEN t.pos = f.pos THEN f.x ELSE t.h END, '' ORDER BY t.pos)),
         f.proof || coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos <> f.pos), '')
  FROM f JOIN t ON t.tree = f.tree AND t.lvl = f.lvl AND t.pos // 3 = f.pos // 3
  WHERE f.n > 1 GROUP BY f.doc_id, f.tree, f.leaf, f.lvl, f.pos, f.n, f.x, f.proof),
g AS (
  SELECT f.doc_id, f.leaf, u.h AS subroot, 0 AS lvl, u.pos, u.n, f.x, f.proof FROM f JOIN u ON u.lvl = 0 AND u.tree = f.tree WHERE f.n = 1
  UNION ALL
  SELECT g.doc_id, g.leaf, g.subroot, g.lvl + 1, g.pos // 3, (g.n + 2) // 3, sha256(string_agg(CASE WHEN u.pos = g.pos THEN g.x ELSE u.h END, '' ORDER BY u.pos)),
         g.proof || coalesce(string_agg(u.h, '' ORDER BY u.pos) FILTER (u.pos <> g.pos), '')
  FROM g JOIN u ON u.lvl = g.lvl AND u.pos // 3 = g.pos // 3
  WHERE g.n > 1 GROUP BY g.doc_id, g.leaf, g.subroot, g.lvl, g.pos, g.n, g.x, g.proof)
SELECT g.doc_id, g.leaf, g.subroot, u.h AS root, sha256(g.proof) AS proof_sha256, g.x AS folded_root, g.x = u.h AS verified
FROM g, u WHERE g.n = 1 AND u.n = 1
""",
    "op13_patricia_prefix_trie": f"""
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS nr, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_CRC32.format("conv_id")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM own)),
r AS (SELECT c.conv_id, own.nr, own.role, own.text FROM c JOIN own ON own.conv_id = c.base AND own.nr <= c.h),
k AS (SELECT conv_id, count(*) AS had FROM r GROUP BY conv_id),
a AS (SELECT * FROM r UNION ALL
      SELECT c.conv_id, own.nr - c.h + coalesce(k.had, 0), own.role, own.text FROM own JOIN c USING (conv_id) LEFT JOIN k USING (conv_id) WHERE own.nr > c.h),
l AS (SELECT conv_id, list(sha256(strlen(role) || ':' || role || text) ORDER BY nr) AS ws, list(length(text) ORDER BY nr) AS sizes FROM a GROUP BY conv_id),
p AS (SELECT conv_id, 0 AS depth, '' AS node, NULL AS up, 0 AS size, coalesce(len(ws), 0) AS total FROM c LEFT JOIN l USING (conv_id) UNION ALL
      SELECT conv_id, i, array_to_string(ws[1 : i], ','), array_to_string(ws[1 : i - 1], ','), sizes[i], len(ws) FROM l, unnest(generate_series(1, len(ws))) AS s(i)),
n AS (SELECT node, any_value(up) AS up, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = total), '')) AS ends_sha256 FROM p GROUP BY node),
ch AS (SELECT up AS node, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY up),
sub AS (SELECT p.node, sum(n.saved)::BIGINT AS saved_tokens, count(*) FILTER (ch.node IS NULL) AS n_leaves
        FROM n LEFT JOIN ch USING (node) JOIN p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY p.node)
SELECT n.conv_id, n.depth::BIGINT AS depth, m.conv_id AS parent_conv_id, n.n_convs, coalesce(ch.n_children, 0) AS n_children, sub.n_leaves, sub.saved_tokens, n.ends_sha256
FROM n LEFT JOIN ch USING (node) JOIN sub USING (node) LEFT JOIN n AS m ON m.node = n.up
""",
}
