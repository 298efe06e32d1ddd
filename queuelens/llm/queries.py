"""The operators over whole tables: thin queries and, where it can be stated, their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from queuelens.llm import (
    archive, bands, extract, leaks, line_dedup, line_field, mixing, sharding, simhash, spelling, tokens, whitening, windows,
)
from queuelens.llm.common import table

QUERIES, SQL = {}, {}

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
BLANKS = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


@query(
    "op1_warc",
    """
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
    h AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex FROM p),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM h)
    SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
      list_aggregate(list_transform(range(0, 32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
          CAST((CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS INT), 5) AS BIGINT) >> CAST(15 - i % 4 * 5 AS INT)) & 31 AS INT) + 1, 1)),
        'string_agg', '') AS payload_digest,
      CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN page_id <> first THEN first END AS refers_to
    FROM f
    """,
)
def op1_warc(spark, sf_dir):
    manifest = archive.write_archives(table(spark, sf_dir, "pages"))
    return archive.read_archives(spark, manifest, keep_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("op2_quality_field")
def op2_quality_field(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    field = line_field.learn(docs, table(spark, sf_dir, "labels"))
    return line_field.score(docs, field).select(
        "doc_id", line_field.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= line_field.THRESHOLD).cast("int").alias("predicted"),
    )


@query("op3_compression_bands")
def op3_compression_bands(spark, sf_dir):
    return bands.rate(table(spark, sf_dir, "documents")).withColumnRenamed("_id", "doc_id")


@query("op4_decontamination")
def op4_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = leaks.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", (F.size("_items") > 0).alias("contaminated"), F.size("_items").cast("bigint").alias("n_items"),
        F.col("_items").alias("item_ids"), F.col("_distances").alias("distances"),
    )


@query(
    "op5_substring_dedup",
    f"""
    WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
    n AS (SELECT doc_id, w, len(w) AS n_words FROM d),
    s AS (SELECT doc_id, unnest(range(1, n_words - 48)) AS i FROM n WHERE n_words >= 50),
    h AS (SELECT s.doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM s JOIN n ON s.doc_id = n.doc_id),
    m AS (SELECT h, min(doc_id) AS least FROM h GROUP BY h HAVING min(doc_id) < max(doc_id)),
    g AS (SELECT DISTINCT h.doc_id, unnest(range(i, i + 50)) AS i FROM h JOIN m ON h.h = m.h WHERE h.doc_id > least),
    gone AS (SELECT doc_id, list(i) AS gone FROM g GROUP BY doc_id),
    k AS (SELECT n.doc_id, n_words, coalesce(len(gone), 0) AS n_removed, CASE WHEN gone IS NULL THEN w ELSE
      list_transform(list_filter(list_zip(w, range(1, n_words + 1)), lambda x: NOT list_contains(gone, x[2])), lambda x: x[1]) END AS kept
      FROM n LEFT JOIN gone ON n.doc_id = gone.doc_id)
    SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
      sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256
    FROM k
    """,
)
def op5_substring_dedup(spark, sf_dir):
    return windows.remove_repeats(table(spark, sf_dir, "documents"), length=50).drop("text")


@query("op6_html_extraction")
def op6_html_extraction(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return extract.extract(pages, extract.learn(pages))


@query(
    "op7_line_dedup",
    f"""
    WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
    k AS (SELECT doc_id, i, line, translate(trim(line, {BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
    c AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
    m AS (SELECT doc_id, i, line, last IS NOT NULL AND doc_id <> last AS gone FROM k LEFT JOIN c ON k.key = c.key)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
    FROM m GROUP BY doc_id
    """,
)
def op7_line_dedup(spark, sf_dir):
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), min_chars=40, min_docs=5)
    return out.select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


BLOCK_WORDS = 64


@query("op8_mixing")
def op8_mixing(spark, sf_dir):
    mix = mixing.plan_mix(table(spark, sf_dir, "documents"), block_words=BLOCK_WORDS)
    return mixing.taken(mix, BLOCK_WORDS).select(
        F.col("_id").alias("doc_id"), F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"), F.col("_taken").alias("taken"),
    )


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


END_ID = 1


@query("op9_token_ids")
def op9_token_ids(spark, sf_dir):
    return tokens.read_ids(spark, tokens.write_ids(table(spark, sf_dir, "documents"), tokenizer_path(), END_ID))


@query("op10_simhash")
def op10_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        F.col("_id").alias("doc_id"), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        F.col("_component").alias("component_id"),
    )


# CRC-32 in SQL: the table of its 256 steps by rule, then a step per byte; results are bitwise inverted.
CRC_TABLE = """crc_table AS MATERIALIZED (SELECT list(step ORDER BY b) AS steps FROM (SELECT b,
      list_reduce(list_prepend(b, range(1, 9)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS step
      FROM (SELECT unnest(range(0, 256)) AS b)))"""


def crc_sql(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8, given ``steps`` of ``CRC_TABLE``."""
    octets = f"list_transform(range(0, octet_length(encode({text}))), lambda k: CAST('0x' || substr(hex(encode({text})), CAST(2 * k + 1 AS INT), 2) AS BIGINT))"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {octets}), lambda c, b: xor(c // 256, steps[CAST(xor(c % 256, b) + 1 AS INT)])))"


@query(
    "op11_spelling",
    f"""
    WITH RECURSIVE {CRC_TABLE},
    r AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents),
    c AS (SELECT doc_id, run, CAST(doc_id AS VARCHAR) || ':' || run AS mark, count(*) AS n FROM r GROUP BY doc_id, run),
    h AS (SELECT run, n, {crc_sql("mark")} AS h FROM c, crc_table),
    w AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) + 2 AS INT)) ELSE run END AS word, n FROM h),
    v AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n, length(word) AS size FROM w WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
    cut AS MATERIALIZED (SELECT word, n, size, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail
      FROM (SELECT word, n, size, unnest(range(1, size + 1)) AS i FROM v)),
    p AS (SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
      UNION SELECT a.word, b.word, b.n FROM cut a JOIN v b ON b.word = a.head || a.tail
      UNION SELECT b.word, a.word, a.n FROM cut a JOIN v b ON b.word = a.head || a.tail),
    k AS (SELECT word, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
      row_number() OVER (PARTITION BY word ORDER BY other_n DESC, encode(other)) AS place FROM p),
    f AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * v.n THEN other END AS form,
      CASE WHEN other_n >= 2 * v.n THEN other_n END AS form_n FROM v LEFT JOIN k ON v.word = k.word AND place = 1),
    paths AS (SELECT word, coalesce(form, word) AS root, form IS NOT NULL AS live FROM f
      UNION ALL SELECT paths.word, f.form, true FROM paths JOIN f ON paths.root = f.word AND f.form IS NOT NULL WHERE paths.live),
    ends AS (SELECT paths.word, paths.root FROM paths JOIN f ON paths.root = f.word WHERE f.form IS NULL)
    SELECT f.word, form, ends.root, n, n_near, form_n FROM f JOIN ends ON f.word = ends.word
    """,
)
def op11_spelling(spark, sf_dir):
    words = spelling.word_counts(table(spark, sf_dir, "documents"))
    return spelling.variants(words).select("word", "form", "root", "n", "n_near", "form_n")


@query("op12_whitening")
def op12_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


SHARDS = 24


@query(
    "op13_sharding",
    f"""
    WITH RECURSIVE {CRC_TABLE},
    hops AS (SELECT doc_id, CASE WHEN doc_id < 0 THEN CAST(doc_id AS HUGEINT) + 18446744073709551616 ELSE CAST(doc_id AS HUGEINT) END AS state,
        CAST(0 AS BIGINT) AS hop FROM documents
      UNION ALL SELECT doc_id, state, CAST(floor((hop + 1) * (CAST(2147483648 AS DOUBLE) / CAST(state // 8589934592 + 1 AS DOUBLE))) AS BIGINT) AS hop
      FROM (SELECT doc_id, hop, (state * CAST(2862933555777941757 AS HUGEINT) + 1) % CAST(18446744073709551616 AS HUGEINT) AS state FROM hops WHERE hop <= {SHARDS}) t),
    shards AS (SELECT doc_id, CAST(max(hop) FILTER (WHERE hop < {SHARDS}) AS INT) AS shard, CAST(max(hop) FILTER (WHERE hop <= {SHARDS}) AS INT) AS grown_shard
      FROM hops GROUP BY doc_id)
    SELECT d.doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 8 AS BIGINT) AS size, CAST({crc_sql("coalesce(text, '')")} AS BIGINT) AS text_crc32,
      'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY d.doc_id) - 1 AS slot, grown_shard
    FROM documents d JOIN shards s ON d.doc_id = s.doc_id, crc_table
    """,
)
def op13_sharding(spark, sf_dir):
    return sharding.shard_texts(table(spark, sf_dir, "documents"), SHARDS)
