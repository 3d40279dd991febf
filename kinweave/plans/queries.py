"""Queries over the entity view of the test tables, with their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.functions import textnorm as tn
from kinweave.functions.scores import round_scaled
from kinweave.operators import blocking, evaluate, features, labels, model, quality, similarity
from kinweave.plans.linkage import Config, Linkage
from kinweave.sources import entities as src

#: The operators' own caps, and the shipped cutoff and proxy.
CONFIG = Config(topk=50, proxy="mean")
CUTOFFS = [5, 10, 20, 50]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

_SFX = "|".join(tn.SUFFIXES)
_CAP = "CASE family " + " ".join(f"WHEN '{f}' THEN {getattr(CONFIG.caps, f)}" for f in blocking.WEIGHTS) + " END"
_WEIGHT = "CASE family " + " ".join(f"WHEN '{f}' THEN {w}" for f, w in blocking.WEIGHTS.items()) + " END"
_VECTOR = ", ".join(c if c in ("token_overlap_count", "missing_address_flag") else f"round({c}, 6) AS {c}" for c in features.FEATURES)


def _norm(c: str) -> str:
    return f"trim(regexp_replace(lower(strip_accents({c})), '[^a-z0-9]+', ' ', 'g'))"


def _bag(c: str) -> str:
    return f"array_to_string(list_sort(list_distinct(string_split({c}, ' '))), ' ')"


def _set(c: str) -> str:
    return f"list_filter(string_split({c}, ' '), lambda t: t <> '')"


def _jaccard(a: str, b: str) -> str:
    common = f"len(list_intersect({a}, {b}))"
    return f"CASE WHEN len({a}) + len({b}) = 0 THEN 1.0 ELSE {common}::DOUBLE / (len({a}) + len({b}) - {common}) END"


def _uniform(key: str, seed: int) -> str:
    return f"('0x' || substr(md5({key} || ':{seed}'), 1, 8))::BIGINT / 4294967296.0"


def _f_half(p: str, t: str, h: str) -> str:
    pr, rc = (f"(CASE WHEN {n} > 0 THEN {h}::DOUBLE / {n} ELSE 1.0 END)" for n in (p, t))
    below = f"(0.25 * {pr} + {rc})"
    return f"CASE WHEN {p} = 0 AND {t} = 0 THEN 1.0 WHEN {below} > 0 THEN 1.25 * {pr} * {rc} / {below} ELSE 0.0 END"


#: Accented letters of the test data, and signs of one byte that stand for them where DuckDB counts bytes.
_ACCENTED = "ÄÇÈÉÊÍÑÓÖÜßäçèéêíñóöüÁÚáúÀà"
_ONE_BYTE = "".join(map(chr, [*range(1, 9), *range(14, 32), 127]))


def _plain(c: str) -> str:
    signs = " || ".join(f"chr({ord(c)})" for c in _ONE_BYTE)
    return f"translate({c}, '{_ACCENTED}', {signs})"


def _lev(a: str, b: str) -> str:
    return f"CASE WHEN greatest(length({a}), length({b})) = 0 THEN 1.0 ELSE 1 - levenshtein({a}, {b})::DOUBLE / greatest(length({a}), length({b})) END"


#: Shared steps of all oracles; those that a query doesn't name are not run.
_STEPS = f"""
WITH w AS (
    SELECT doc_id, lang, n_chars, md5(coalesce(text, '')) AS h,
           string_split(trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')), ' ') AS t,
           CASE doc_id % 5 WHEN 0 THEN 'S1' WHEN 1 THEN 'S2' WHEN 2 THEN 'S2' ELSE 'S3' END AS src
    FROM documents
),
ent AS (
    SELECT src, src || '-' || doc_id AS entity_id, lang AS country, h,
           array_to_string(t[1:5], ' ') || CASE doc_id % 4 WHEN 0 THEN ' Inc.' WHEN 1 THEN ' LLC' WHEN 2 THEN '' ELSE ' Pvt Ltd' END AS business_name,
           CASE WHEN doc_id % 5 <> 0 AND doc_id % 17 = 0 THEN '' ELSE n_chars || ' ' || array_to_string(t[6:13], ' ') END AS business_address
    FROM w
),
n1 AS (SELECT *, {_norm('business_name')} AS name_n, {_norm('business_address')} AS addr_n FROM ent),
n2 AS (
    SELECT *, regexp_replace(regexp_replace(name_n, '^(({_SFX})( |$))+', ''), '((^| )({_SFX}))+$', '') AS name_s,
           regexp_extract(addr_n, '^([0-9][a-z0-9]*)', 1) AS stno
    FROM n1
),
norm AS (SELECT *, {_bag('name_s')} AS name_t, {_bag('name_n')} AS name_nt, {_bag('addr_n')} AS addr_t FROM n2),
s1 AS (SELECT * FROM norm WHERE src = 'S1'),
pool AS (SELECT * FROM norm WHERE src <> 'S1'),
keys AS (
    SELECT * FROM (
        SELECT src, entity_id, country, 'c3' AS family, name_s[1:3] AS value FROM norm WHERE length(name_s) >= 3
        UNION ALL SELECT src, entity_id, country, 't', unnest(string_split(name_t, ' ')) FROM norm
        UNION ALL SELECT src, entity_id, country, 'sn', stno FROM norm
        UNION ALL SELECT src, entity_id, country, 'fn', name_s FROM norm
    ) WHERE value <> ''
    UNION ALL SELECT * FROM (SELECT src, entity_id, country, 'a' AS family, unnest(string_split(addr_t, ' ')) AS value FROM norm) WHERE length(value) >= 3
),
df AS (SELECT family, country, value, count(*) AS df FROM keys WHERE src <> 'S1' GROUP BY ALL),
kept AS (SELECT * FROM df WHERE df <= {_CAP}),
ev AS (
    SELECT a.entity_id AS s1_id, b.entity_id AS cand_id, round(sum({_WEIGHT} / log2(2 + df)), 9) AS score
    FROM keys a JOIN kept USING (family, country, value) JOIN keys b USING (family, country, value)
    WHERE a.src = 'S1' AND b.src <> 'S1' GROUP BY ALL
),
cand AS (
    SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, cand_id) - 1 AS evidence_rank FROM ev
    QUALIFY evidence_rank < {CONFIG.max_candidates}
),
terms AS (
    SELECT src, entity_id, field, token, 1 + ln(count(*)) AS tf FROM (
        SELECT src, entity_id, 'name' AS field, unnest(string_split(name_t, ' ')) AS token FROM norm
        UNION ALL SELECT src, entity_id, 'addr', unnest(string_split(addr_n, ' ')) FROM norm
    ) WHERE token <> '' GROUP BY ALL
),
tdf AS (SELECT field, token, count(*) AS df FROM terms WHERE src <> 'S1' GROUP BY ALL),
idf AS (
    SELECT field, token, df, ln((1.0 + (SELECT count(*) FROM pool)) / (1 + df)) + 1 AS idf
    FROM tdf JOIN (SELECT field, max(df) AS most FROM tdf GROUP BY field) USING (field) WHERE df >= 2 OR most < 2
),
wt AS (
    SELECT entity_id, field, token, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY entity_id, field)) AS weight
    FROM terms JOIN idf USING (field, token)
),
dots AS (
    SELECT s1_id, cand_id, sum(a.weight * b.weight) FILTER (WHERE a.field = 'name') AS nc, sum(a.weight * b.weight) FILTER (WHERE a.field = 'addr') AS ac
    FROM cand JOIN wt a ON a.entity_id = s1_id JOIN wt b ON b.entity_id = cand_id AND b.field = a.field AND b.token = a.token
    GROUP BY ALL
),
pairs AS (
    SELECT cand.s1_id, cand.cand_id, round(coalesce(nc, 0), 9) AS name_cos, round(coalesce(ac, 0), 9) AS acos,
           x.addr_n <> '' AND y.addr_n <> '' AS both_addr, x AS x, y AS y
    FROM cand LEFT JOIN dots USING (s1_id, cand_id) JOIN s1 x ON x.entity_id = cand.s1_id JOIN pool y ON y.entity_id = cand.cand_id
),
ranked AS (
    SELECT *, round((name_cos + CASE WHEN both_addr THEN acos ELSE name_cos END) / 2, 9) AS proxy,
           row_number() OVER (PARTITION BY s1_id ORDER BY proxy DESC, cand_id) - 1 AS cand_rank
    FROM pairs QUALIFY cand_rank < {CONFIG.topk}
),
sets AS (
    SELECT *, list_distinct(list_filter(regexp_split_to_array(lower(x.business_name), '[\\s\\x{{a0}}]+'), lambda t: t <> '')) AS r1,
           list_distinct(list_filter(regexp_split_to_array(lower(y.business_name), '[\\s\\x{{a0}}]+'), lambda t: t <> '')) AS r2,
           {_set('x.name_nt')} AS n1, {_set('y.name_nt')} AS n2, {_set('x.name_t')} AS t1, {_set('y.name_t')} AS t2,
           {_set('x.addr_t')} AS a1, {_set('y.addr_t')} AS a2
    FROM ranked
),
feat AS (
    SELECT s1_id, cand_id, {_jaccard('r1', 'r2')} AS name_jaccard_raw, {_jaccard('n1', 'n2')} AS name_jaccard_normalized,
           {_jaccard('t1', 't2')} AS name_jaccard_suffix_stripped, name_cos, CASE WHEN both_addr THEN {_jaccard('a1', 'a2')} END AS addr_jaccard,
           CASE WHEN both_addr THEN acos END AS addr_cos, len(list_intersect(t1, t2))::INTEGER AS token_overlap_count,
           CASE WHEN x.stno <> '' AND y.stno <> '' THEN (x.stno = y.stno)::INTEGER::DOUBLE END AS street_number_match,
           (y.addr_n = '')::INTEGER AS missing_address_flag, abs(length(x.name_s) - length(y.name_s))::DOUBLE AS len_delta_name,
           abs(length(x.addr_n) - length(y.addr_n))::DOUBLE AS len_delta_addr, cand_rank::INTEGER AS cand_rank
    FROM sets
),
truth AS (SELECT a.entity_id AS s1_id, b.entity_id AS cand_id FROM s1 a JOIN pool b USING (h)),
lab AS (SELECT feat.*, (t.s1_id IS NOT NULL)::INTEGER AS is_match FROM feat LEFT JOIN truth t USING (s1_id, cand_id)),
scored AS (SELECT *, round(0.5 * name_cos + 0.5 * coalesce(addr_cos, 0), 9) AS proba FROM lab),
matched AS (SELECT * FROM scored WHERE cand_rank < {CONFIG.topk} AND proba >= {CONFIG.threshold}),
val AS (SELECT entity_id FROM s1 WHERE {_uniform('entity_id', 42)} < 0.18),
degree AS (SELECT s.entity_id, count(t.s1_id) AS n_true FROM s1 s LEFT JOIN truth t ON t.s1_id = s.entity_id GROUP BY ALL),
counts AS (
    SELECT d.entity_id, count(m.cand_id) AS n_pred, d.n_true, coalesce(sum(m.is_match), 0)::BIGINT AS tp
    FROM degree d LEFT JOIN matched m ON m.s1_id = d.entity_id GROUP BY d.entity_id, d.n_true
),
f AS (SELECT *, {_f_half('n_pred', 'n_true', 'tp')} AS f05, CASE WHEN n_true = 0 THEN '0' WHEN n_true = 1 THEN '1' WHEN n_true <= 3 THEN '2-3' ELSE '4+' END AS bucket FROM counts),
points AS (SELECT k AS topk, i AS level, (10 + 2 * i) / 100.0 AS threshold FROM unnest({CUTOFFS}) a(k), range({len(evaluate.GRID)}) b(i)),
at_point AS (
    SELECT topk, level, threshold, d.entity_id, d.n_true, count(s.cand_id) AS n_pred, coalesce(sum(s.is_match), 0) AS tp
    FROM points CROSS JOIN degree d LEFT JOIN scored s ON s.s1_id = d.entity_id AND s.cand_rank < topk AND s.proba >= (10 + 2 * level)::DOUBLE / 100
    GROUP BY ALL
),
swept AS (
    SELECT topk, threshold, avg({_f_half('n_pred', 'n_true', 'tp')}) AS macro_f05,
           any_value(p)::DOUBLE / (SELECT count(*) FROM s1) AS avg_candidates_per_s1, any_value(hits)::DOUBLE / (SELECT count(*) FROM truth) AS candidate_recall
    FROM at_point JOIN (SELECT k AS topk, count(*) FILTER (WHERE cand_rank < k) AS p, coalesce(sum(is_match) FILTER (WHERE cand_rank < k), 0) AS hits
                        FROM scored, unnest({CUTOFFS}) a(k) GROUP BY k) USING (topk)
    GROUP BY topk, threshold
),
results AS (
    SELECT s.entity_id AS source1_entity_id, coalesce((SELECT string_agg(cand_id, ',' ORDER BY cand_rank) FROM matched m WHERE m.s1_id = s.entity_id), '') AS matched_entity_ids,
           coalesce((SELECT string_agg(cand_id, ',' ORDER BY cand_rank) FROM feat c WHERE c.s1_id = s.entity_id), '') AS candidate_entity_ids
    FROM s1 s
)
"""


def query(sql: str | None = None) -> Callable:
    """Register a function of (linkage, spark, sf_dir) under its name, with the last step of its oracle."""

    def register(f: Callable) -> Callable:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Linkage.from_documents(spark, sf_dir, CONFIG), spark, sf_dir)
        if sql is not None:
            ORACLE_SQL[f.__name__] = _STEPS + sql
        return f

    return register


def _six(*names: str) -> list[Column]:
    return [round_scaled(F.col(n), 6).alias(n) for n in names]


def _vector() -> list[Column]:
    return [F.col(c) if c in ("token_overlap_count", "missing_address_flag") else round_scaled(F.col(c), 6).alias(c) for c in features.FEATURES]


@query(f"SELECT doc_id, coalesce({_norm('text')}, '') AS norm, NOT regexp_matches(coalesce(text, ''), '[^\\x00-\\x7F]') AS is_ascii FROM documents")
def norm_text_documents(run, spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", tn.norm_text(F.col("text")).alias("norm"), (~F.coalesce("text", F.lit("")).rlike("[^\\x00-\\x7F]")).alias("is_ascii"))


#: Words of the nine scripts with their readings, letter by letter, as the test tables have none.
INDIC_NAMES = {
    "नीला कमल १२": "niilaa kml 12",
    "પાની ૪૨": "paanii 42",
    "மரம் வீடு": "mrm viitu",
    "నీరు చెరువు": "niiru cheruvu",
    "ಮನೆ ಕಾಡು": "mne kaadu",
    "മഴ പൂവ്": "ml puuv",
    "ଜଳ ଫୁଲ": "jl phul",
    "ਘਰ ਸੜਕ": "ghr srk",
    "আলো মেঘ": "aalo megh",
}


@query("SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in INDIC_NAMES.items()) + ") names(name, norm)")
def indic_names(run, spark, sf_dir):
    return spark.createDataFrame([(k,) for k in INDIC_NAMES], "name string").select("name", tn.norm_text(F.col("name")).alias("norm"))


@query("SELECT entity_id, name_n, name_s FROM norm")
def norm_name_entities(run, spark, sf_dir):
    return run.s1.unionByName(run.pool).select("entity_id", "name_n", "name_s")


@query("SELECT entity_id, token, count(*) AS n FROM (SELECT entity_id, unnest(string_split(addr_n, ' ')) AS token FROM norm) WHERE token <> '' GROUP BY ALL")
def address_tokens(run, spark, sf_dir):
    rows = run.s1.unionByName(run.pool).select("entity_id", F.explode(tn.tokens(F.col("addr_n"))).alias("token"))
    return rows.groupBy("entity_id", "token").agg(F.count("*").alias("n"))


@query("SELECT entity_id, stno FROM norm WHERE stno <> ''")
def street_numbers(run, spark, sf_dir):
    return run.s1.unionByName(run.pool).where("stno <> ''").select("entity_id", "stno")


@query("SELECT src, entity_id, business_name, business_address, country, name_n, name_s, name_t, name_nt, addr_n, addr_t, stno FROM norm")
def prep_entities(run, spark, sf_dir):
    return run.s1.unionByName(run.pool).drop("h")


@query("SELECT entity_id, business_name FROM s1 ORDER BY entity_id LIMIT 500")
def first_entities(run, spark, sf_dir):
    """The limit on S1 rows, which is the feature."""
    return src.head(run.s1, "entity_id", 500).select("entity_id", "business_name")


@query("SELECT src, count(*) AS n, count(DISTINCT entity_id) AS ids FROM pool GROUP BY src")
def pool_union(run, spark, sf_dir):
    return run.pool.select("src", "entity_id").groupBy("src").agg(F.count("*").alias("n"), F.count_distinct("entity_id").alias("ids"))


@query("SELECT entity_id, country, family, value FROM keys")
def block_keys(run, spark, sf_dir):
    return run.s1_keys.unionByName(run.pool_keys)


@query("SELECT family, country, value, df FROM df")
def key_df(run, spark, sf_dir):
    return run.key_df


@query("SELECT family, country, value, df FROM kept")
def allowed_keys(run, spark, sf_dir):
    return blocking.allowed(run.key_df, run.config.caps)


@query(
    f"SELECT DISTINCT a.entity_id AS s1_id, b.entity_id AS cand_id FROM keys a JOIN df USING (family, country, value) JOIN keys b USING (family, country, value) "
    f"WHERE a.src = 'S1' AND b.src <> 'S1' AND (family = 'c3' OR df <= {_CAP})"
)
def candidate_union_plain(run, spark, sf_dir):
    c = run.config.caps
    return blocking.plain_union(run.s1, run.pool, blocking.Caps(c.t, c.a, c.sn, c.fn, 1 << 60))


@query("SELECT s1_id, cand_id, round(score, 6) AS score FROM ev")
def candidate_evidence(run, spark, sf_dir):
    return run.evidence.select("s1_id", "cand_id", *_six("score"))


@query("SELECT s1_id, cand_id, evidence_rank::INTEGER AS evidence_rank FROM ev JOIN (SELECT s1_id, cand_id, row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, cand_id) - 1 AS evidence_rank FROM ev) USING (s1_id, cand_id) WHERE evidence_rank < 20")
def candidate_prefilter(run, spark, sf_dir):
    return blocking.prefilter(run.evidence, 20).select("s1_id", "cand_id", "evidence_rank")


@query("SELECT field, token, df, round(idf, 6) AS idf FROM idf")
def tfidf_idf(run, spark, sf_dir):
    return run.idf.select("field", "token", "df", *_six("idf"))


@query("SELECT entity_id, field, token, round(weight, 6) AS weight FROM wt")
def tfidf_weights(run, spark, sf_dir):
    return similarity.weights(run.s1.unionByName(run.pool), run.idf).select("entity_id", "field", "token", *_six("weight"))


@query("SELECT s1_id, cand_id, round(name_cos, 6) AS name_cos, round(acos, 6) AS addr_cos FROM pairs")
def pair_cosine(run, spark, sf_dir):
    return run.pairs.select("s1_id", "cand_id", *_six("name_cos", "addr_cos"))


@query("SELECT s1_id, cand_id, round(proxy, 6) AS proxy, cand_rank::INTEGER AS cand_rank FROM ranked")
def proxy_topk_mean(run, spark, sf_dir):
    return run.ranked.select("s1_id", "cand_id", *_six("proxy"), "cand_rank")


@query(
    "SELECT s1_id, cand_id, round(p, 6) AS proxy, (row_number() OVER (PARTITION BY s1_id ORDER BY p DESC, cand_id) - 1)::INTEGER AS cand_rank "
    "FROM (SELECT *, round(greatest(name_cos, CASE WHEN both_addr THEN acos ELSE name_cos END), 9) AS p FROM pairs) QUALIFY cand_rank < 10"
)
def proxy_topk_max(run, spark, sf_dir):
    return run.rank("max", 10).select("s1_id", "cand_id", *_six("proxy"), "cand_rank")


@query(f"SELECT s1_id, cand_id, {_VECTOR}, cand_rank FROM feat")
def features_full(run, spark, sf_dir):
    return run.features.select("s1_id", "cand_id", *_vector(), "cand_rank")


@query("SELECT s1_id, cand_id, round(name_jaccard_raw, 6) AS name_jaccard_raw, round(name_jaccard_normalized, 6) AS name_jaccard_normalized, round(name_jaccard_suffix_stripped, 6) AS name_jaccard_suffix_stripped, round(name_cos, 6) AS name_cos, token_overlap_count, len_delta_name FROM feat")
def features_name(run, spark, sf_dir):
    return run.features.select("s1_id", "cand_id", *_six(*features.FEATURES[:4]), "token_overlap_count", "len_delta_name")


@query("SELECT s1_id, cand_id, round(addr_jaccard, 6) AS addr_jaccard, round(addr_cos, 6) AS addr_cos, street_number_match, missing_address_flag, len_delta_addr FROM feat")
def features_address(run, spark, sf_dir):
    return run.features.select("s1_id", "cand_id", *_six("addr_jaccard", "addr_cos"), "street_number_match", "missing_address_flag", "len_delta_addr")


@query(
    f"SELECT s1_id, cand_id, round({_lev('x_name', 'y_name')}, 6) AS lev_name_raw, round({_lev('x.name_n', 'y.name_n')}, 6) AS lev_name_norm, "
    f"round({_lev('x.name_s', 'y.name_s')}, 6) AS lev_name_strip, CASE WHEN both_addr THEN round({_lev('x.addr_n', 'y.addr_n')}, 6) END AS lev_addr, "
    f"round(CASE WHEN both_addr THEN ({_lev('x.name_s', 'y.name_s')} + {_lev('x.addr_n', 'y.addr_n')}) / 2 ELSE {_lev('x.name_s', 'y.name_s')} END, 6) AS lev_proxy "
    f"FROM (SELECT *, {_plain('x.business_name')} AS x_name, {_plain('y.business_name')} AS y_name FROM ranked)"
)
def levenshtein_features(run, spark, sf_dir):
    return run.edits.select("s1_id", "cand_id", *_six("lev_name_raw", "lev_name_norm", "lev_name_strip", "lev_addr", "lev_proxy"))


@query("SELECT s1_id, cand_id FROM truth")
def truth_pairs(run, spark, sf_dir):
    lists = src.result_lists(run.s1, run.truth.withColumn("cand_rank", F.lit(0)), "matched_entity_ids")
    return labels.known_truth(src.explode_truth(lists), run.s1, run.pool)


@query("SELECT least(n_true, 4)::BIGINT AS degree, count(*) AS n FROM degree GROUP BY 1")
def degree_histogram(run, spark, sf_dir):
    return run.degrees.groupBy(F.least("degree", F.lit(4)).cast("long").alias("degree")).agg(F.count("*").alias("n"))


@query("SELECT s1_id, cand_id, cand_rank, is_match FROM lab")
def labelled_pairs(run, spark, sf_dir):
    return run.labelled.select("s1_id", "cand_id", "cand_rank", "is_match")


@query(
    f"SELECT s1_id, cand_id, is_match, (s1_id IN (SELECT entity_id FROM val))::INTEGER AS is_val FROM lab "
    f"WHERE is_val = 1 OR is_match = 1 OR {_uniform('s1_id || chr(124) || cand_id', 42)} < 0.05"
)
def negative_sample(run, spark, sf_dir):
    return labels.sample_negatives(run.labelled, labels.sample_ids(run.s1, 0.18), 0.05).select("s1_id", "cand_id", "is_match", "is_val")


@query(
    f"SELECT entity_id, 'validation' AS part FROM val UNION ALL "
    f"SELECT entity_id, CASE WHEN {_uniform('entity_id', 1)} < 0.1 THEN 'stopping' ELSE 'training' END FROM s1 WHERE entity_id NOT IN (SELECT entity_id FROM val)"
)
def validation_split(run, spark, sf_dir):
    held = labels.sample_ids(run.s1, 0.18)
    rest = run.s1.select("entity_id").join(held, "entity_id", "left_anti")
    part = F.when(model.stopping(F.col("entity_id")), "stopping").otherwise("training")
    return held.withColumn("part", F.lit("validation")).unionByName(rest.withColumn("part", part))


@query(f"SELECT entity_id FROM s1 ORDER BY {_uniform('entity_id', 7)}, entity_id LIMIT 50")
def hash_sample(run, spark, sf_dir):
    return labels.sample_n(run.s1, 50, 7)


@query(
    f"""SELECT entity_id, stratum::INTEGER AS stratum, CASE WHEN k % 2 = 1 THEN 'calibration' ELSE 'tuning' END AS half FROM (
        SELECT entity_id, least(n_true, 4) AS stratum, row_number() OVER (PARTITION BY least(n_true, 4) ORDER BY {_uniform('entity_id', 42)}, entity_id) AS k,
               ceil(count(*) OVER (PARTITION BY least(n_true, 4)) * 100.0 / count(*) OVER ()) AS quota FROM degree) WHERE k <= quota"""
)
def stratified_split(run, spark, sf_dir):
    rows = labels.stratified_halves(run.degrees, 100)
    return rows.withColumn("stratum", F.col("stratum").cast("int"))


@query("SELECT sum(is_match)::BIGINT AS positives, sum(1 - is_match)::BIGINT AS negatives, round(sum(1 - is_match)::DOUBLE / nullif(sum(is_match), 0), 6) AS weight FROM lab")
def class_weight(run, spark, sf_dir):
    return labels.class_weight(run.labelled).select("positives", "negatives", *_six("weight"))


@query("SELECT s1_id, cand_id, round(proba, 6) AS proba, is_match FROM matched")
def rule_scored_matches(run, spark, sf_dir):
    return run.matches.select("s1_id", "cand_id", *_six("proba"), "is_match")


@query("SELECT entity_id, n_pred, n_true, tp, round(f05, 6) AS f05 FROM f")
def entity_f05(run, spark, sf_dir):
    counts = evaluate.entity_counts(run.degrees, run.matches)
    return evaluate.entity_f(counts).select("entity_id", "n_pred", "n_true", "tp", *_six("f05"))


@query("SELECT round(avg(f05), 6) AS macro_f05, count(*) AS entities FROM f")
def macro_f05(run, spark, sf_dir):
    counts = evaluate.entity_counts(run.degrees, run.matches)
    return evaluate.macro_f(counts).select(*_six("macro_f05"), "entities")


@query("SELECT bucket, round(avg(f05), 6) AS macro_f05, count(*) AS entities FROM f GROUP BY bucket")
def bucket_f05(run, spark, sf_dir):
    counts = evaluate.entity_counts(run.degrees, run.matches)
    return evaluate.bucket_f(counts).select("bucket", *_six("macro_f05"), "entities")


@query("SELECT threshold::DOUBLE AS threshold, round(macro_f05, 6) AS macro_f05 FROM swept WHERE topk = 50")
def threshold_sweep(run, spark, sf_dir):
    return evaluate.sweep(run.degrees, run.scored, [50]).select("threshold", *_six("macro_f05"))


@query("SELECT topk::INTEGER AS topk, threshold::DOUBLE AS threshold, round(macro_f05, 6) AS macro_f05, round(avg_candidates_per_s1, 6) AS avg_candidates_per_s1, round(candidate_recall, 6) AS candidate_recall FROM swept")
def cutoff_threshold_sweep(run, spark, sf_dir):
    return evaluate.sweep(run.degrees, run.scored, CUTOFFS).select("topk", "threshold", *_six("macro_f05", "avg_candidates_per_s1", "candidate_recall"))


@query(
    f"SELECT topk::INTEGER AS topk, threshold::DOUBLE AS threshold, round(macro_f05, 6) AS macro_f05 FROM swept WHERE macro_f05 >= (SELECT max(macro_f05) FROM swept) - {evaluate.TOLERANCE} "
    "ORDER BY avg_candidates_per_s1, candidate_recall DESC, round(macro_f05, 9) DESC, topk, threshold LIMIT 1"
)
def operating_point(run, spark, sf_dir):
    table = evaluate.sweep(run.degrees, run.scored, CUTOFFS).withColumn("macro_f05", F.round("macro_f05", 9))
    return evaluate.choose(table).select("topk", "threshold", *_six("macro_f05"))


@query(
    "SELECT pairs, hits, true_pairs, round(hits::DOUBLE / true_pairs, 6) AS recall, round(pairs::DOUBLE / n1, 6) AS pairs_per_s1, round(pairs::DOUBLE / (n1 * n2), 6) AS share_of_naive "
    "FROM (SELECT count(*) AS pairs FROM cand), (SELECT count(*) AS hits FROM cand JOIN truth USING (s1_id, cand_id)), "
    "(SELECT count(*) AS true_pairs FROM truth), (SELECT count(*) AS n1 FROM s1), (SELECT count(*) AS n2 FROM pool)"
)
def blocking_recall(run, spark, sf_dir):
    return evaluate.blocking_recall(run.pool, run.labelled_candidates, run.degrees).select("pairs", "hits", "true_pairs", *_six("recall", "pairs_per_s1", "share_of_naive"))


@query(
    f"SELECT k::INTEGER AS topk, count(*) FILTER (WHERE cand_rank < k) AS kept, coalesce(sum(is_match) FILTER (WHERE cand_rank < k), 0)::BIGINT AS hits, "
    f"round(hits::DOUBLE / (SELECT count(*) FROM truth), 6) AS recall FROM lab, unnest({CUTOFFS}) a(k) GROUP BY k"
)
def recall_at_k(run, spark, sf_dir):
    return evaluate.recall_at(run.labelled, run.degrees, CUTOFFS).select("topk", "kept", "hits", *_six("recall"))


@query(
    "SELECT feature, is_match, round(median(v), 6) AS median FROM ("
    + " UNION ALL ".join(f"SELECT '{f}' AS feature, is_match, {f}::DOUBLE AS v FROM lab" for f in quality.GATE_FEATURES)
    + ") GROUP BY ALL"
)
def feature_medians(run, spark, sf_dir):
    return quality.feature_medians(run.labelled).select("feature", "is_match", *_six("median"))


@query(
    "SELECT positives, negatives, round(p, 6) AS positive_median, round(n, 6) AS negative_median, "
    "CASE WHEN positives = 0 OR negatives = 0 THEN 'SKIP' WHEN p - n > 0.1 THEN 'PASS' ELSE 'FLAG' END AS verdict FROM ("
    "SELECT count(*) FILTER (WHERE is_match = 1) AS positives, count(*) FILTER (WHERE is_match = 0) AS negatives, "
    "median(addr_jaccard) FILTER (WHERE is_match = 1) AS p, median(addr_jaccard) FILTER (WHERE is_match = 0) AS n FROM lab WHERE name_cos >= 0.99)"
)
def adversarial_gate(run, spark, sf_dir):
    return quality.adversarial_gate(run.labelled).select("positives", "negatives", *_six("positive_median", "negative_median"), "verdict")


@query(
    f"SELECT count(*) AS pairs, round(coalesce(sum(r), 0), 6) AS raw_sum, round(coalesce(sum(n), 0), 6) AS norm_sum, count(*) FILTER (WHERE n >= r) AS improved_or_equal FROM ("
    f"SELECT {_jaccard('r1', 'r2')} AS r, {_jaccard('t1', 't2')} AS n FROM sets JOIN truth USING (s1_id, cand_id))"
)
def normalization_gain(run, spark, sf_dir):
    sides = run.labelled_sides.where("is_match = 1").select(*[F.col(f"business_name_{n}") for n in (1, 2)], *[F.array_join(f"t_bag_{n}", " ").alias(f"name_t_{n}") for n in (1, 2)])
    return quality.normalization_gain(sides).select("pairs", *_six("raw_sum", "norm_sum"), "improved_or_equal")


@query("SELECT source1_entity_id, matched_entity_ids FROM results")
def matching_results(run, spark, sf_dir):
    return run.results()[0]


@query("SELECT source1_entity_id, candidate_entity_ids FROM results")
def candidate_pairs(run, spark, sf_dir):
    return run.results()[1]


@query(
    """SELECT 'candidate_missing_entity' AS rule, 'error' AS severity, count(*) AS n, array_to_string(list_sort(list(entity_id))[1:5], ',') AS examples
       FROM s1 WHERE entity_id LIKE '%70' HAVING count(*) > 0
       UNION ALL SELECT 'subset', 'warning', count(*), array_to_string(list_sort(list(item))[1:5], ',')
       FROM (SELECT s1_id || '>' || cand_id AS item FROM matched WHERE s1_id LIKE '%70' UNION ALL SELECT entity_id || '>' || entity_id FROM s1 WHERE entity_id LIKE '%15') HAVING count(*) > 0
       UNION ALL SELECT 'matching_duplicate_row', 'error', count(*), array_to_string(list_sort(list(entity_id))[1:5], ',') FROM s1 WHERE entity_id LIKE '%15' HAVING count(*) > 0
       UNION ALL SELECT unnest(['matching_self_match', 'matching_unknown_id']), 'error', n, examples
       FROM (SELECT count(*) AS n, array_to_string(list_sort(list(entity_id || '>' || entity_id))[1:5], ',') AS examples FROM s1 WHERE entity_id LIKE '%15') WHERE n > 0"""
)
def validate_results(run, spark, sf_dir):
    """Damaged lists: candidates of ids ending in 70 are lost, ids ending in 15 are listed once more, with themselves as match."""
    matching, candidate = run.results()
    again = run.s1.where("entity_id like '%15'").select(F.col("entity_id").alias("source1_entity_id"), F.col("entity_id").alias("matched_entity_ids"))
    return quality.validate(matching.unionByName(again), candidate.where("source1_entity_id not like '%70'"), run.s1, run.pool)


@query("SELECT m.s1_id AS source1_entity_id, m.cand_id AS id FROM matched m JOIN (SELECT entity_id FROM s1 WHERE entity_id LIKE '%5') x ON x.entity_id = m.s1_id")
def subset_violations(run, spark, sf_dir):
    """Matches that are no candidates, after the candidates of ids ending in 5 are taken away."""
    left = run.matches.select(F.col("s1_id").alias("source1_entity_id"), F.col("cand_id").alias("id"))
    kept = run.features.where("s1_id not like '%5'").select(F.col("s1_id").alias("source1_entity_id"), F.col("cand_id").alias("id"))
    return left.join(kept, ["source1_entity_id", "id"], "left_anti")


@query(
    """SELECT country, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM norm), 6) AS share,
              round(avg(CASE WHEN regexp_matches(business_name, '[^\\x00-\\x7F]') THEN 1.0 ELSE 0.0 END), 6) AS non_ascii_name,
              round(avg(CASE WHEN regexp_matches(business_address, '[^\\x00-\\x7F]') THEN 1.0 ELSE 0.0 END), 6) AS non_ascii_address
       FROM norm GROUP BY country"""
)
def country_profile(run, spark, sf_dir):
    return quality.country_profile(run.s1.unionByName(run.pool)).select("country", "n", *_six("share", "non_ascii_name", "non_ascii_address"))


@query(
    """SELECT token, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(business_name), '\\s+') || regexp_split_to_array(lower(business_address), '\\s+')) AS token FROM norm)
       WHERE token IN ('the', 'of', 'and', 'inc.', 'llc', 'ltd') GROUP BY token ORDER BY n DESC, token LIMIT 20"""
)
def signal_tokens(run, spark, sf_dir):
    return quality.signal_tokens(run.s1.unionByName(run.pool), ["the", "of", "and", "inc.", "llc", "ltd"])


@query(
    "SELECT src, round(quantile_cont(length(name_n), 0.5), 6) AS p50, round(quantile_cont(length(name_n), 0.95), 6) AS p95, "
    "round(quantile_cont(length(name_n), 0.99), 6) AS p99, max(length(name_n))::INTEGER AS longest FROM norm GROUP BY src"
)
def name_length_percentiles(run, spark, sf_dir):
    return quality.length_percentiles(run.s1.unionByName(run.pool), "name_n").select("src", *_six("p50", "p95", "p99"), "longest")


@query("SELECT src, count(*) AS groups, sum(m)::BIGINT AS members FROM (SELECT src, country, name_s, count(*) AS m FROM norm GROUP BY ALL HAVING m > 1) GROUP BY src")
def duplicate_name_groups(run, spark, sf_dir):
    return quality.duplicate_names(run.s1.unionByName(run.pool))


@query(
    "SELECT pairs, true_pairs, pairs - true_pairs AS non_matches FROM (SELECT count(*) AS pairs FROM s1 a JOIN pool b USING (country, name_s)), "
    "(SELECT count(*) AS true_pairs FROM s1 a JOIN pool b USING (country, name_s, h))"
)
def identical_name_nonmatch(run, spark, sf_dir):
    return quality.identical_name_nonmatches(run.s1, run.pool, run.truth)


@query(
    """SELECT rule, covered, true_pairs, round(covered::DOUBLE / true_pairs, 6) AS coverage FROM (
        SELECT unnest(['first_2', 'first_3', 'first_4', 'first_token', 'first_2_tokens']) AS rule,
               unnest([count(*) FILTER (WHERE c AND a[1:2] = b[1:2]), count(*) FILTER (WHERE c AND a[1:3] = b[1:3]), count(*) FILTER (WHERE c AND a[1:4] = b[1:4]),
                       count(*) FILTER (WHERE c AND string_split(a, ' ')[1] = string_split(b, ' ')[1]),
                       count(*) FILTER (WHERE c AND string_split(a, ' ')[1:2] = string_split(b, ' ')[1:2])]) AS covered, count(*) AS true_pairs
        FROM (SELECT x.name_s AS a, y.name_s AS b, x.country = y.country AS c FROM truth JOIN s1 x ON x.entity_id = s1_id JOIN pool y ON y.entity_id = cand_id))"""
)
def prefix_key_coverage(run, spark, sf_dir):
    return quality.prefix_coverage(run.s1, run.pool, run.truth).select("rule", "covered", "true_pairs", *_six("coverage"))


@query(
    "SELECT s1_id, count(*) AS n, sum(h)::BIGINT AS hash_sum, bit_xor(h) AS hash_xor FROM (SELECT s1_id, ('0x' || substr(md5(cand_id), 1, 12))::BIGINT AS h FROM feat) GROUP BY s1_id"
)
def set_fingerprint(run, spark, sf_dir):
    return quality.fingerprint(run.features, "s1_id", "cand_id")


@query()
def gbt_scored_pairs(run, spark, sf_dir):
    """Boosted trees fitted on the training entities, scoring the validation entities' pairs."""
    sampled = labels.sample_negatives(run.labelled, labels.sample_ids(run.s1, 0.18), 1.0).persist()
    fitted = model.fit(sampled.where("is_val = 0").drop("is_val"))
    return model.predict(fitted, model.behind(sampled.where("is_val = 1").drop("is_val"))).select("s1_id", "cand_id", "is_match", "proba")
