"""Queries that apply each operator to its whole table, and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm import fixity, licenses, packing, pii, quality, sharding, simhash, spotsigs, tokens, topk
from kinweave.llm.common import table

SHARDS = 40


def op1_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


def op2_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compare_documents(table(spark, sf_dir, "documents"))


def op3_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), SHARDS)


def op4_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.round_trip(table(spark, sf_dir, "documents"))


def op9_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit a replica of the archive of all pages.

    The replica is made from the same table with damage by rule: ids with remainder 3 modulo 37 have
    a byte more at their body's end, ids with remainder 5 modulo 91 are lost, and ids with remainder 7
    modulo 83 are also filed under their negative.
    """
    pages = table(spark, sf_dir, "pages")
    key, body = F.col("page_id"), F.coalesce("html", F.lit(""))
    rotten = F.when(key % 37 == 3, F.concat(body, F.lit("\x7f"))).otherwise(body)
    primary = pages.select(key.alias("key"), fixity.warc_record(key, F.col("url"), body).alias("record"))
    replica = pages.where(F.coalesce(key % 91 != 5, F.lit(True))).select(key.alias("key"), fixity.warc_record(key, F.col("url"), rotten).alias("record"))
    stray = pages.where(key % 83 == 7).select((-key).alias("key"), fixity.warc_record(-key, F.col("url"), body).alias("record"))
    return fixity.audit(primary, replica.unionByName(stray))


def pii_base_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base columns of op1 alone."""
    return pii.base_digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pii_spans,
        op2_spotsigs,
        op3_rendezvous_shards,
        op4_compression_quality,
        op5_license_rules,
        op6_best_fit_packing,
        op7_exact_top_k,
        op8_bpe_round_trip,
        op9_simhash_components,
        op10_merkle_audit,
        pii_base_spans,
    )
}

_CRC32 = """
    WITH RECURSIVE entry(i, k, v) AS (
        SELECT i, 0, i FROM range(256) r(i)
        UNION ALL
        SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM entry WHERE k < 8
    ),
    crc_table AS (SELECT list(v ORDER BY i) AS t FROM entry WHERE k = 8),
"""

_ANCHORS = ", ".join(f"'{w}'" for w in spotsigs.ANCHORS)
_CONTRACT = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_FOUND = " UNION ALL ".join(
    f"SELECT r, '{kind}' AS kind, {k} AS place, regexp_extract_all(t, '{x}') AS m, string_split_regex(t, '{x}') AS g FROM docs" for k, (kind, x) in enumerate(_CONTRACT.items())
)

ORACLE_SQL: dict[str, str] = {
    "op3_rendezvous_shards": _CRC32
    + f"""
    shares AS (
        SELECT doc_id, s AS shard,
               -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || s), 1, 13))::BIGINT + 0.5) / 4503599627370496.0) AS cost
        FROM (SELECT DISTINCT doc_id FROM documents), range({SHARDS + 1}) r(s)
    ),
    chosen AS (
        SELECT doc_id, arg_min(shard, cost) FILTER (WHERE shard < {SHARDS}) AS shard, arg_min(shard, cost) AS grown_shard
        FROM shares GROUP BY doc_id
    ),
    sized AS (
        SELECT doc_id, coalesce(strlen(text), 0) + 16 AS size, text,
               xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                   lambda b: ('0x' || b)::BIGINT)),
                   lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) AS text_crc32
        FROM documents, crc_table
    )
    SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
           (row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1)::BIGINT AS slot,
           grown_shard::INTEGER AS grown_shard
    FROM sized JOIN chosen USING (doc_id)
    """,
    "op7_exact_top_k": """
    WITH scaled AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
        FROM scaled q JOIN scaled c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
    )
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
    FROM scored
    QUALIFY rank <= 5
    """,
    "op10_merkle_audit": rf"""
    WITH p AS (
        SELECT page_id AS key, coalesce(html, '') AS body,
               'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:record:' AS a,
               '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
                   || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' AS b,
               chr(13) || chr(10) || chr(13) || chr(10) AS e
        FROM pages
    ),
    records AS (
        SELECT 1 AS side, key, a || key || b || strlen(body) || e || body || e AS record FROM p
        UNION ALL
        SELECT 2, key, CASE WHEN key % 37 = 3 THEN a || key || b || (strlen(body) + 1) || e || body || chr(127) || e
                            ELSE a || key || b || strlen(body) || e || body || e END
        FROM p WHERE key % 91 <> 5
        UNION ALL
        SELECT 2, -key, a || -key || b || strlen(body) || e || body || e FROM p WHERE key % 83 = 7
    ),
    leaves AS (
        SELECT side, key, floor(key / {fixity.FILE_KEYS}.0)::BIGINT AS file, strlen(record)::BIGINT AS length, sha256(record) AS digest FROM records
    ),
    placed AS (
        SELECT *, (row_number() OVER w - 1) // {1 << fixity.FAN_BITS} AS run,
               coalesce(sum(length) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset"
        FROM leaves WINDOW w AS (PARTITION BY side, file ORDER BY key, digest)
    ),
    runs AS (SELECT side, file, run, string_agg("offset" || ':' || length || ':' || digest, ',' ORDER BY "offset") AS own FROM placed GROUP BY ALL),
    bad AS (
        SELECT coalesce(l.file, r.file) AS file, coalesce(l.run, r.run) AS run
        FROM (FROM runs WHERE side = 1) l FULL JOIN (FROM runs WHERE side = 2) r ON l.file = r.file AND l.run = r.run
        WHERE l.own IS DISTINCT FROM r.own
    )
    SELECT x.key, x.file, x."offset", x.length, CASE WHEN side = 1 THEN digest END AS digest, bad.run::BIGINT AS run,
           CASE WHEN side = 2 THEN 'extra' WHEN key % 91 = 5 THEN 'missing' WHEN key % 37 = 3 THEN 'corrupt' ELSE 'intact' END AS status
    FROM placed x LEFT JOIN bad ON x.file = bad.file AND x.run = bad.run
    WHERE side = 1 OR key < 0
    """,
    "op2_spotsigs": f"""
    WITH RECURSIVE numbered AS (
        SELECT doc_id, coalesce(text, '') AS text,
               row_number() OVER (ORDER BY doc_id DESC NULLS LAST, coalesce(text, '')) AS k, count(*) OVER () AS n
        FROM documents
    ),
    edited AS (
        SELECT a.k, b.k AS next, a.doc_id, a.text, a.text[1:length(a.text) - length(a.text) // 2] || b.text[1:length(a.text) // 2] AS edited
        FROM numbered a JOIN numbered b ON b.k = a.k % a.n + 1
    ),
    texts AS (SELECT k, 0 AS which, text FROM edited UNION ALL SELECT k, 1, edited FROM edited),
    cut AS (SELECT k, which, text, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS w FROM texts),
    marked AS (
        SELECT *, list_filter(w, lambda x: x NOT IN ({_ANCHORS})) AS c,
               list_filter(list_transform(w, lambda x, i: CASE WHEN x IN ({_ANCHORS}) THEN i END), lambda i: i IS NOT NULL) AS p
        FROM cut
    ),
    chains AS (
        SELECT k, which, list_append(
            list_transform(p, lambda q, i: CASE WHEN c[q - i + 1] IS NOT NULL
                THEN concat_ws(' ', w[q], c[q - i + 1], c[q - i + 2], c[q - i + 3]) END),
            CASE WHEN len(c) > 0 THEN concat_ws(' ', '^', c[1], c[2], c[3])
                 WHEN len(w) > 0 THEN '^ ' || array_to_string(w, ' ')
                 WHEN length(text) > 0 THEN '^ ' || text END) AS own
        FROM marked
    ),
    signed AS (
        SELECT k, which, list_sort(list_distinct(list_transform(list_filter(own, lambda s: s IS NOT NULL), lambda s: substr(md5(s), 1, 8)))) AS sig FROM chains
    ),
    nodes AS (SELECT sig, min(doc_id) AS node FROM signed JOIN edited USING (k) WHERE which = 0 GROUP BY sig),
    members AS (SELECT node, sig, unnest(sig) AS s FROM nodes),
    common AS (
        SELECT a.node AS u, b.node AS v, len(any_value(a.sig)) AS n, len(any_value(b.sig)) AS m, count(*) AS common
        FROM members a JOIN members b ON a.s = b.s AND a.node <> b.node GROUP BY a.node, b.node
    ),
    links AS (SELECT u, v FROM common WHERE common >= 0.8 * (n + m - common) - 1e-9),
    reached(u, v) AS (SELECT node, node FROM nodes UNION SELECT r.u, l.v FROM reached r JOIN links l ON r.v = l.u),
    classes AS (SELECT sig, class_id FROM nodes JOIN (SELECT u AS node, min(v) AS class_id FROM reached GROUP BY u) USING (node)),
    near AS (
        SELECT e.*, a.sig AS sa, b.sig AS sb, c.sig AS sc, class_id
        FROM edited e JOIN signed a ON a.k = e.k AND a.which = 0 JOIN signed b ON b.k = e.k AND b.which = 1
        JOIN signed c ON c.k = e.next AND c.which = 0 JOIN classes ON classes.sig = a.sig
    )
    SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(edited) AS edited_sha256,
           array_to_string(sa, ',') AS fingerprint, array_to_string(sb, ',') AS edited_fingerprint,
           CASE WHEN len(sa) + len(sb) = 0 THEN 1.0 ELSE len(list_intersect(sa, sb))::DOUBLE / len(list_distinct(list_concat(sa, sb))) END::DOUBLE AS near_edited,
           CASE WHEN len(sa) + len(sc) = 0 THEN 1.0 ELSE len(list_intersect(sa, sc))::DOUBLE / len(list_distinct(list_concat(sa, sc))) END::DOUBLE AS near_next,
           class_id
    FROM near
    """,
    "pii_base_spans": f"""
    WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
    found AS ({_FOUND}),
    steps AS (SELECT r, kind, place, unnest(range(1, len(m) + 1)) AS i, m, g FROM found),
    placed AS (
        SELECT r, kind, place, m[i] AS v, sum(length(g[i]) + length(m[i])) OVER (PARTITION BY r, kind ORDER BY i) AS stop,
               reverse(regexp_replace(m[i], '[^0-9]', '', 'g')) AS d
        FROM steps
    ),
    spans AS (
        SELECT r, kind, place, stop - length(v) AS start, kind || ':' || (stop - length(v))::BIGINT || ':' || stop::BIGINT AS span
        FROM placed
        WHERE CASE kind
            WHEN 'ip' THEN list_bool_and(list_transform(string_split(v, '.'), lambda p: coalesce(try_cast(ltrim(p, '0') AS BIGINT), CASE WHEN ltrim(p, '0') = '' THEN 0 END, 256) <= 255))
            WHEN 'card' THEN length(d) BETWEEN 13 AND 19 AND list_sum(list_transform(string_split(d, ''), lambda x, i:
                CASE WHEN i % 2 = 1 THEN x::INT WHEN x::INT > 4 THEN 2 * x::INT - 9 ELSE 2 * x::INT END)) % 10 = 0
            WHEN 'phone' THEN length(d) BETWEEN 9 AND 15
            ELSE true END
    ),
    listed AS (
        SELECT docs.r, any_value(doc_id) AS doc_id, coalesce(string_agg(span, ',' ORDER BY place, start), '') AS spans,
               count(*) FILTER (WHERE kind = 'email') AS n_email, count(*) FILTER (WHERE kind = 'ip') AS n_ip,
               count(*) FILTER (WHERE kind = 'card') AS n_card, count(*) FILTER (WHERE kind = 'phone') AS n_phone
        FROM docs LEFT JOIN spans ON docs.r = spans.r GROUP BY docs.r
    )
    SELECT doc_id, n_email, n_ip, n_card, n_phone, sha256(spans) AS base_sha256, spans FROM listed
    """,
}
