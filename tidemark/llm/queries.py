"""The registered queries of this subpackage, and the SQL that checks them where SQL can."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bpe, decontam, dialogue, embeddings, jaccard, line_dedup, manifest, mixing, quality, sharding, substrings, urls, warc

URL_RULES = [
    urls.Rule("net/", "block"),
    urls.Rule("example.net/en/", "allow"),
    urls.Rule("example.com/de/", "block"),
    urls.Rule("org/fr/", "allow"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read_archives(spark, warc.write_archives(table(spark, sf_dir, "pages")))
    failed = F.raise_error(F.concat(F.lit("unsound record: "), "error")).cast("string")
    kind = F.when(F.col("error").isNull(), F.col("record_type")).otherwise(failed)
    return records.select("page_id", "payload_bytes", "payload_digest", kind.alias("record_type"), "refers_to")


def bpe_path() -> str:
    """The tokenizer's file; ``TIDEMARK_BPE`` names another one."""
    if "TIDEMARK_BPE" in os.environ:
        return os.environ["TIDEMARK_BPE"]
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_texts(table(spark, sf_dir, "documents"), bpe_path())
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return coded.select("doc_id", "n_tokens", sha("ids").alias("ids_sha256"), sha("decoded").alias("decoded_sha256"))


def op5_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.dedup_substrings(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_texts(docs, model)
    return scored.select(
        "doc_id", quality.held_out().alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= quality.THRESHOLD).cast("int").alias("predicted")
    )


def contamination_columns(found: DataFrame) -> DataFrame:
    items = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(items.cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_columns(decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), shards=8)
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    claim = F.when(tampered, manifest.leaf_digest([F.col(c) for c in manifest.FIELDS[:-1]] + [lowered]))
    built = manifest.merkle_manifest(docs, claim=claim)
    folded = built.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        manifest.proof_digest(F.col("path")).alias("proof_sha256"),
        manifest.fold(F.coalesce("claim", "leaf"), F.col("path")).alias("folded_root"),
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns with the faults that the query's contract plants, by a checksum of conversation and turn; nulls as one space."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(told("text"), ".!?", "")).otherwise(told("text"))
    rows = conversations.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(told("role")).alias("role"), text.alias("text"), F.when(kind == 3, 2).otherwise(1).alias("copies")
    )
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copy", "copies")


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    original = table(spark, sf_dir, "conversations")
    fixed = dialogue.repair_conversations(damaged(original))
    key = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")).alias("key")
    every = original.select("conv_id").distinct().select("conv_id", key("conv_id"))
    summary = fixed.summary.select("*", key("conv")).drop("conv", "turns")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    joined = every.join(summary, "key", "left").join(dialogue.repaired_digests(fixed.lines), "key", "left")
    return joined.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_line_dedup": op2_line_dedup,
    "op3_warc": op3_warc,
    "op4_bpe": op4_bpe,
    "op5_suffix_array": op5_suffix_array,
    "op6_embeddings": op6_embeddings,
    "op7_url_filter": op7_url_filter,
    "op8_quality": op8_quality,
    "op9_decontamination": op9_decontamination,
    "op10_sharding": op10_sharding,
    "op11_merkle": op11_merkle,
    "op12_mixing": op12_mixing,
    "op13_conversations": op13_conversations,
}

#: CRC-32 of a list of bytes, as two parts around the list: the table is made from the polynomial.
_CRC_TABLE = """t AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS crc)"""
_CRC = """xor(list_reduce(list_transform(string_split({text}, ''), lambda ch: CAST(ascii(ch) AS BIGINT)),
  lambda c, b: xor(c >> 8, t.crc[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"""
_LOWER = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _told(*values: str) -> str:
    parts = [f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen(CAST({v} AS VARCHAR)) || ':' || {v} END" for v in values]
    return "sha256(" + " || ".join(parts) + ")"

ORACLES: dict[str, str] = {
    "op1_ngram_jaccard": r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x20\x09-\x0D]+') AS words FROM documents),
grams AS (SELECT DISTINCT doc_id, array_to_string(CASE WHEN len(words) < 5 THEN words ELSE list_slice(words, i, i + 4) END, ' ') AS gram
  FROM (SELECT *, unnest(range(1, greatest(2, len(words) - 3))) AS i FROM d WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT u, v FROM shared JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v WHERE 100 * k >= 80 * (x.n + y.n - k)),
reach AS (SELECT doc_id AS u, doc_id AS w FROM d UNION SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.w),
least AS (SELECT u, min(w) AS component_id FROM reach GROUP BY u)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id FROM d JOIN least ON least.u = d.doc_id LEFT JOIN sizes ON sizes.doc_id = d.doc_id
""",
    "op2_line_dedup": r"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM docs),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.holder AS gone FROM keyed k LEFT JOIN common c ON c.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""",
    "op3_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
h AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS holder FROM p),
r AS (SELECT *, n >= 1000 AND holder IS NOT NULL AND page_id IS DISTINCT FROM holder AS again FROM h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN holder END AS refers_to
FROM r
""",
    "op5_suffix_array": """
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
places AS (SELECT doc_id, i, substr(h, 2 * i - 1, 100) AS window_hex FROM (SELECT *, unnest(range(1, n - 48)) AS i FROM h)),
first AS (SELECT window_hex, min(doc_id) AS holder FROM places GROUP BY window_hex HAVING min(doc_id) < max(doc_id)),
hits AS (SELECT doc_id, i FROM places JOIN first USING (window_hex) WHERE doc_id > holder),
marked AS (SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS new FROM hits),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM marked),
runs AS (SELECT doc_id, k, min(i) AS low, max(i) + 49 AS high FROM numbered GROUP BY doc_id, k),
gaps AS (SELECT doc_id, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS after, low FROM runs
  UNION ALL SELECT h.doc_id, coalesce(max(r.high), 0), h.n + 1 FROM h LEFT JOIN runs r ON r.doc_id = h.doc_id GROUP BY h.doc_id, h.n),
kept AS (SELECT g.doc_id, string_agg(substr(h, 2 * after + 1, 2 * (low - after - 1)), '' ORDER BY after) AS kept
  FROM gaps g JOIN h ON h.doc_id = g.doc_id GROUP BY g.doc_id),
counts AS (SELECT doc_id, sum(high - low + 1) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id)
SELECT h.doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM h JOIN kept ON kept.doc_id = h.doc_id LEFT JOIN counts ON counts.doc_id = h.doc_id
""",
    "op6_embeddings": """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (SELECT * FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS u, b.vec_id AS w FROM good a JOIN good b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id AS u, vec_id AS w FROM v UNION SELECT r.u, l.w FROM reach r JOIN links l ON l.u = r.w),
least AS (SELECT u, min(w) AS component_id FROM reach GROUP BY u),
counts AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT v.vec_id, coalesce(c.n, 0) AS n_links, l.component_id, v.vec_id = l.component_id AS kept
FROM v JOIN least l ON l.u = v.vec_id LEFT JOIN counts c ON c.u = v.vec_id
""",
    "op9_decontamination": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS words FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS words FROM benchmark WHERE item_id IS NOT NULL),
items AS (SELECT *, least(len(words), 13) AS n FROM b WHERE len(words) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(words, i, i + n - 1), ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS i FROM items)),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (SELECT doc_id, l.n, i, array_to_string(list_slice(words, i, i + l.n - 1), ' ') AS gram
  FROM (SELECT w.*, l.n, unnest(range(1, len(words) - l.n + 2)) AS i FROM w, lengths l) l),
hits AS (SELECT p.doc_id, p.i, p.n, x.item_id FROM places p JOIN windows x ON x.gram = p.gram AND x.n = p.n),
covered AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
  string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hits GROUP BY doc_id)
SELECT w.doc_id, len(w.words) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(f.n_items, 0) AS n_items,
  sha256(coalesce(f.ids, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(w.words) AS contaminated
FROM w LEFT JOIN covered c ON c.doc_id = w.doc_id LEFT JOIN found f ON f.doc_id = w.doc_id
""",
    "op11_merkle": f"""
WITH RECURSIVE {_CRC_TABLE},
leaves AS (SELECT row_number() OVER () AS r, doc_id, lang, {_told("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
  CASE WHEN {_CRC.format(text="CAST(doc_id AS VARCHAR)")} % 3 = 0
    THEN {_told("doc_id", "source", "lang", "n_chars", _LOWER.format(text="text"))} END AS claim FROM documents, t),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
  count(*) OVER (PARTITION BY lang) AS n FROM leaves),
up AS (SELECT 0 AS level, lang, pos, n, leaf AS h FROM placed
  UNION ALL SELECT level + 1, lang, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM up WHERE n > 1
  GROUP BY level, lang, pos // 8, n),
subroots AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, count(*) OVER () AS n FROM up WHERE n = 1),
tops AS (SELECT 0 AS level, g AS pos, n, h FROM subroots
  UNION ALL SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM tops WHERE n > 1
  GROUP BY level, pos // 8, n),
steps AS (
  SELECT p.r, u.level, coalesce(string_agg(u.h, '' ORDER BY u.pos) FILTER (u.pos < p.pos // CAST(8 ** u.level AS BIGINT)), '') AS a,
    coalesce(string_agg(u.h, '' ORDER BY u.pos) FILTER (u.pos > p.pos // CAST(8 ** u.level AS BIGINT)), '') AS b
  FROM placed p JOIN up u ON u.lang IS NOT DISTINCT FROM p.lang AND u.n > 1 AND u.pos // 8 = p.pos // CAST(8 ** (u.level + 1) AS BIGINT)
  GROUP BY p.r, u.level
  UNION ALL
  SELECT p.r, 1000 + u.level, coalesce(string_agg(u.h, '' ORDER BY u.pos) FILTER (u.pos < s.g // CAST(8 ** u.level AS BIGINT)), ''),
    coalesce(string_agg(u.h, '' ORDER BY u.pos) FILTER (u.pos > s.g // CAST(8 ** u.level AS BIGINT)), '')
  FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang
  JOIN tops u ON u.n > 1 AND u.pos // 8 = s.g // CAST(8 ** (u.level + 1) AS BIGINT) GROUP BY p.r, u.level),
ordered AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY level) AS k FROM steps),
proofs AS (SELECT r, sha256(string_agg(a || b, '' ORDER BY level)) AS proof, count(*) AS k FROM steps GROUP BY r),
folded AS (SELECT r, CAST(0 AS BIGINT) AS k, coalesce(claim, leaf) AS h FROM leaves
  UNION ALL SELECT f.r, o.k, sha256(o.a || f.h || o.b) FROM folded f JOIN ordered o ON o.r = f.r AND o.k = f.k + 1),
final AS (SELECT r, arg_max(h, k) AS h FROM folded GROUP BY r)
SELECT p.doc_id, p.leaf, s.h AS subroot, root.h AS root, coalesce(q.proof, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = root.h AS verified
FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang JOIN final f ON f.r = p.r LEFT JOIN proofs q ON q.r = p.r,
  (SELECT h FROM tops WHERE n = 1) root
""",
    "op12_mixing": r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
sized AS (SELECT doc_id, source, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS size, md5(text) AS digest,
  1 - CAST(len(regexp_extract_all(text, '[!-@\[-`{-~]')) AS DOUBLE) / greatest(length(text), 1) AS plain,
  (CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || md5(text)), 1, 13) AS BIGINT)
    + CAST(0.5 AS DOUBLE)) / CAST(4503599627370496 AS DOUBLE) AS u FROM d),
keyed AS (SELECT *, -ln(u) / greatest(CAST(0.1 AS DOUBLE), plain * plain) AS key FROM sized),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM keyed GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM sources),
weighed AS (SELECT *, CAST(CASE k % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS w, CAST(2 * source_size AS DOUBLE) AS most FROM ranked),
rising AS (SELECT *, row_number() OVER (ORDER BY most / w, k) AS i FROM weighed),
whole AS (SELECT 1.5 * CAST(sum(source_size) AS DOUBLE) AS goal, sum(w) AS w FROM weighed),
tries AS (SELECT 0 AS filled, CAST(0 AS DOUBLE) AS took, CAST(0 AS DOUBLE) AS heavy
  UNION ALL SELECT i, sum(most) OVER (ORDER BY i), sum(w) OVER (ORDER BY i) FROM rising),
shares AS (SELECT t.filled, goal - took AS rest, whole.w - heavy AS weight FROM tries t, whole WHERE whole.w - heavy > 0),
fit AS (SELECT arg_min(rest, filled) AS rest, arg_min(weight, filled) AS weight FROM shares s
  WHERE NOT EXISTS (SELECT 1 FROM rising r WHERE r.i > s.filled AND r.w * s.rest / s.weight >= r.most)),
targets AS (SELECT r.source, source_size, CASE WHEN fit.rest IS NULL THEN most ELSE least(r.w * fit.rest / fit.weight, most) END AS target FROM rising r, fit),
plan AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM targets),
sampled AS (SELECT k.*, p.source_size, p.target, p.epochs, CAST(round(p.target) AS BIGINT) - p.epochs * p.source_size AS budget,
  sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id NULLS FIRST, digest ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before
  FROM keyed k JOIN plan p ON p.source IS NOT DISTINCT FROM k.source)
SELECT doc_id, size, source_size, target, CAST(epochs * size + greatest(0, least(size, budget - before)) AS BIGINT) AS taken FROM sampled
""",
    "op13_conversations": rf"""
WITH RECURSIVE {_CRC_TABLE},
told AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
marked AS (SELECT *, {_CRC.format(text="name")} % 20 AS kind FROM told, t),
turns AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
  CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM marked WHERE kind <> 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text)) AS i,
  trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare, left(role, 1) AS initial FROM turns),
judged AS (SELECT *, CASE WHEN bare = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
  WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '-' END AS fault,
  lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS previous FROM numbered),
facts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
  count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
  count(*) FILTER (previous IS NOT NULL AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id),
step(state, initial, after) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
given(state, role, after) AS (VALUES (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
more(state, after, cost, audit, lines) AS (
  SELECT state, state, 0, '', '' FROM given
  UNION ALL SELECT state, after, 5, 'I', role || ':' || chr(10) FROM given
  UNION ALL SELECT a.state, b.after, 10, 'II', a.role || ':' || chr(10) || b.role || ':' || chr(10) FROM given a JOIN given b ON b.state = a.after),
edits(state, own, after, letter, cost, given) AS (
  SELECT state, CAST(NULL AS VARCHAR), state, 'D', 2, CAST(NULL AS VARCHAR) FROM given
  UNION ALL SELECT state, initial, after, 'K', 0, NULL FROM step
  UNION ALL SELECT state, NULL, after, 'R', 1, role FROM given),
ways AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS state, {{'cost': 0, 'audit': '', 'lines': ''}} AS w FROM facts
  UNION ALL
  SELECT a.conv_id, j.i, e.after, min({{'cost': a.w.cost + m.cost + e.cost + CASE WHEN j.fault = 't' AND e.letter <> 'D' THEN 5 ELSE 0 END,
    'audit': a.w.audit || m.audit || e.letter,
    'lines': a.w.lines || m.lines || CASE WHEN e.letter = 'D' THEN '' ELSE coalesce(e.given, j.role) || ':' || j.text || chr(10) END}})
  FROM ways a JOIN judged j ON j.conv_id IS NOT DISTINCT FROM a.conv_id AND j.i = a.i + 1
  JOIN more m ON m.state = a.state JOIN edits e ON e.state = m.after
  WHERE (e.letter = 'D' OR j.fault NOT IN ('b', 'd')) AND (e.letter <> 'K' OR e.own = j.initial)
  GROUP BY a.conv_id, j.i, e.after),
ended AS (SELECT a.conv_id, min({{'cost': a.w.cost + m.cost, 'audit': a.w.audit || m.audit, 'lines': a.w.lines || m.lines}}) AS w
  FROM ways a JOIN facts f ON f.conv_id IS NOT DISTINCT FROM a.conv_id AND f.n = a.i JOIN more m ON m.state = a.state
  WHERE m.after IN (0, 3) GROUP BY a.conv_id)
SELECT c.conv_id, coalesce(f.gaps, 0) AS gaps, coalesce(f.blank, 0) AS blank, coalesce(f.duplicate, 0) AS duplicate,
  coalesce(f.truncated, 0) AS truncated, coalesce(f.illegal, 0) AS illegal, CAST(coalesce(e.w.cost, 0) AS BIGINT) AS cost,
  coalesce(e.w.audit, '') AS audit, sha256(coalesce(CASE WHEN e.w.lines = '' THEN '' ELSE left(e.w.lines, length(e.w.lines) - 1) END, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
""",
}
