"""The registered queries of the curation engine, each with its oracle in DuckDB's SQL.

Roles that the driver's tables lack (decisions with revisions, licence admissions, candidate queues) are
derived from them by plain expressions, which the oracles repeat.
"""

from __future__ import annotations

from tempfile import gettempdir

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gristmill.functions import text as T
from gristmill.functions import web
from gristmill.operators import near_dup, sanitise, serving
from gristmill.plans import curation
from gristmill.sources.tables import spread, table

BASE = 1_780_000_000
NOW = BASE + 40 * 3600

LICENCES = ["MIT", "apache 2.0", "cc by-nc-sa 4.0", "https://creativecommons.org/licenses/by-sa/3.0/", "None", "Proprietary", "CC BY 3.0", "http://arxiv.org/licenses/nonexclusive-distrib/1.0/", "odc-by-1.0", "cc-by-nd-3.0", "https://creativecommons.org/publicdomain/zero/1.0"]


def _shared(spark: SparkSession) -> None:
    """Sets the checkpoint folder that the session names; a temporary one only where the master is local."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or f"{gettempdir()}/gristmill")


def cohort(spark, d):
    _shared(spark)
    return serving.daily_cohort(queue(spark, d), BASE + 100_000).select("doc_id", "position")


def decisions(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("x"))
    docs = table(spark, d, "documents").join(labels, "doc_id", "left")
    q, x = F.coalesce("q", F.lit(1)), F.coalesce("x", F.lit(0))
    i = F.col("doc_id")
    rejects = F.when(i % 7 == 0, F.array(F.lit("near_duplicate"))).when(i % 11 == 0, F.array(F.lit("c4_nopunc_filter"))).when(q == 0, F.array(F.lit("low_quality_score"), F.lit("gopher_check"))).otherwise(F.array().cast("array<string>"))
    docs = docs.select("doc_id", "text", "lang", F.col("source").alias("source_feed"), (F.floor(F.col("n_chars") / 4)).alias("tokens"), (q * 3.0 + (i % 20) / 10.0).alias("quality_score"), rejects.alias("reject_reasons"), F.when(F.col("text").contains("@"), F.array(F.lit("email"))).otherwise(F.array().cast("array<string>")).alias("pii_flags"), x.alias("x"), F.explode(F.when(i % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("v"))
    v = F.col("v")
    return docs.select(
        "doc_id", "text", "lang", "source_feed", "tokens", "quality_score", "reject_reasons", "pii_flags",
        F.when(F.col("x") == 1, 3).when(F.size("reject_reasons") > 0, 2).otherwise(1).alias("risk_tier"),
        F.when(F.size("reject_reasons") > 0, "quarantine").when((i % 5 == 0) & (v == 1), "broad_pretraining").when(i % 5 == 0, "posttrain_candidate").otherwise("pretrain").alias("route"),
        (F.lit(BASE) + i % 200 * 3600 + (v - 1) * 36_000).alias("valid_from"), F.when(i % 13 == 0, F.lit(BASE) + 50 * 3600).cast("bigint").alias("valid_to"),
        F.concat(F.lit("s"), v).alias("scoring_version"), F.concat(F.lit("c"), v).alias("classifier_revision"), F.concat(F.lit("p"), v).alias("policy_revision"), F.md5(F.concat_ws("-", i, v)).alias("trace_id"),
        F.when(i % 4 == 0, "CC-BY-4.0").when(i % 4 == 1, "MIT").when(i % 4 == 2, "CC-BY-ND-4.0").otherwise("unknown").alias("license"), F.when(i % 9 == 0, "Apache-2.0").alias("spdx_license"),
    )


DECISIONS = f"""decisions AS (
  SELECT doc_id, text, lang, source AS source_feed, CAST(floor(n_chars / 4) AS BIGINT) AS tokens, q * 3.0 + (doc_id % 20) / 10.0 AS quality_score, rj AS reject_reasons,
    CASE WHEN contains(text, '@') THEN ['email'] ELSE CAST([] AS VARCHAR[]) END AS pii_flags,
    CASE WHEN x = 1 THEN 3 WHEN len(rj) > 0 THEN 2 ELSE 1 END AS risk_tier,
    CASE WHEN len(rj) > 0 THEN 'quarantine' WHEN doc_id % 5 = 0 AND v = 1 THEN 'broad_pretraining' WHEN doc_id % 5 = 0 THEN 'posttrain_candidate' ELSE 'pretrain' END AS route,
    {BASE} + doc_id % 200 * 3600 + (v - 1) * 36000 AS valid_from, CASE WHEN doc_id % 13 = 0 THEN {BASE} + 50 * 3600 END AS valid_to,
    's' || v AS scoring_version, 'c' || v AS classifier_revision, 'p' || v AS policy_revision, md5(doc_id || '-' || v) AS trace_id,
    CASE doc_id % 4 WHEN 0 THEN 'CC-BY-4.0' WHEN 1 THEN 'MIT' WHEN 2 THEN 'CC-BY-ND-4.0' ELSE 'unknown' END AS license, CASE WHEN doc_id % 9 = 0 THEN 'Apache-2.0' END AS spdx_license
  FROM (SELECT d.*, coalesce(l.q, 1) AS q, coalesce(l.x, 0) AS x,
      CASE WHEN d.doc_id % 7 = 0 THEN ['near_duplicate'] WHEN d.doc_id % 11 = 0 THEN ['c4_nopunc_filter'] WHEN coalesce(l.q, 1) = 0 THEN ['low_quality_score', 'gopher_check'] ELSE CAST([] AS VARCHAR[]) END AS rj
    FROM documents d LEFT JOIN (SELECT doc_id, min(quality) AS q, max(toxic) AS x FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id) b
  JOIN (SELECT 1 AS v UNION ALL SELECT 2) r ON r.v = 1 OR b.doc_id % 3 = 0)"""
LATEST = DECISIONS + """, latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY valid_from DESC, scoring_version DESC, policy_revision DESC, trace_id) AS rn FROM decisions) WHERE rn = 1)"""
VISIBLE = "source_feed NOT LIKE 'local-%' AND source_feed <> 'cluster-smoke'"
SHOWN = "NOT (list_contains(reject_reasons, 'metadata_only') OR list_contains(reject_reasons, 'c4_nopunc_filter') OR list_contains(reject_reasons, 'gopher_filter'))"
TRAINABLE = "risk_tier = 1 AND route IN ('pretrain', 'broad_pretraining', 'posttrain_candidate', 'reasoning_candidate') AND len(reject_reasons) = 0 AND len(pii_flags) = 0"


def admissions(spark: SparkSession, d: str) -> DataFrame:
    raw = F.element_at(F.array(*map(F.lit, LICENCES)), (F.col("page_id") % len(LICENCES) + 1).cast("int"))
    return table(spark, d, "pages").select((F.col("page_id") + 1_000_000).alias("doc_id"), raw.alias("raw_license")).withColumn("license_id", T.normalized_licence(F.col("raw_license"))).withColumn("status", T.admission_status(F.col("license_id")))


ADMISSIONS = """admissions AS (SELECT *, CASE WHEN license_id IN ('CC-BY-4.0','CC-BY-SA-4.0','CC-BY-3.0','CC-BY-SA-3.0','CC0-1.0','Apache-2.0','MIT','BSD-2-Clause','BSD-3-Clause','MPL-2.0','ISC','Unlicense') THEN 'admitted'
    WHEN license_id IN ('arxiv-non-exclusive-distribution','CC-BY-NC-4.0','CC-BY-NC-SA-4.0','CC-BY-NC-3.0','CC-BY-NC-SA-3.0','unknown','ODC-By-1.0') THEN 'posttrain_transform_only' ELSE 'quarantined' END AS status
  FROM (SELECT page_id + 1000000 AS doc_id, CASE page_id % 11 WHEN 0 THEN 'MIT' WHEN 1 THEN 'Apache-2.0' WHEN 2 THEN 'CC-BY-NC-SA-4.0' WHEN 3 THEN 'CC-BY-SA-3.0' WHEN 4 THEN 'unknown' WHEN 5 THEN 'Proprietary' WHEN 6 THEN 'CC-BY-3.0'
    WHEN 7 THEN 'arxiv-non-exclusive-distribution' WHEN 8 THEN 'ODC-By-1.0' WHEN 9 THEN 'cc-by-nd-3.0' ELSE 'CC0-1.0' END AS license_id FROM pages))"""

WORDS = r"list_filter(string_split_regex(text, '\s+'), lambda w: w <> '')"
LINES = "list_filter(list_transform(string_split(text, chr(10)), lambda l: trim(l)), lambda l: l <> '')"


def _docs(spark, d):
    return spread(table(spark, d, "documents").select("doc_id", "text")).withColumn("ln", T.lines(F.col("text")))


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


RATIOS = ["mean_word_len", "stopword_ratio", "symbol_word_ratio", "alpha_word_ratio", "bullet_line_ratio", "ellipsis_line_ratio"]


def gopher(spark, d):
    own = _docs(spark, d)
    own = own.select("doc_id", *(c.alias(n) for n, c in T.gopher(F.col("text"), F.col("ln")).items()))
    return _rounded(own.withColumn("passes", T.gopher_passes()), *RATIOS)


GOPHER = f"""SELECT doc_id, word_count, round(mean_word_len, 6) AS mean_word_len, round(stopword_ratio, 6) AS stopword_ratio, round(symbol_word_ratio, 6) AS symbol_word_ratio, round(alpha_word_ratio, 6) AS alpha_word_ratio,
  round(bullet_line_ratio, 6) AS bullet_line_ratio, round(ellipsis_line_ratio, 6) AS ellipsis_line_ratio,
  word_count BETWEEN 50 AND 100000 AND mean_word_len BETWEEN 3 AND 10 AND symbol_word_ratio <= 0.1 AND alpha_word_ratio >= 0.8 AND stopword_ratio * word_count >= 2 AND bullet_line_ratio <= 0.9 AND ellipsis_line_ratio <= 0.3 AS passes
FROM (SELECT doc_id, CAST(len(w) AS BIGINT) AS word_count, CASE WHEN len(w) = 0 THEN 0 ELSE list_sum(list_transform(w, lambda x: length(x))) / len(w) END AS mean_word_len,
  CASE WHEN len(w) = 0 THEN 0 ELSE len(list_filter(w, lambda x: list_contains([{", ".join(f"'{x}'" for x in T.STOP_WORDS)}], lower(x)))) / len(w) END AS stopword_ratio,
  CASE WHEN len(w) = 0 THEN 0 ELSE len(list_filter(w, lambda x: regexp_matches(x, '[#@&*<>{{}}\\[\\]\\\\]'))) / len(w) END AS symbol_word_ratio,
  CASE WHEN len(w) = 0 THEN 0 ELSE len(list_filter(w, lambda x: regexp_matches(x, '\\pL'))) / len(w) END AS alpha_word_ratio,
  CASE WHEN len(ln) = 0 THEN 0 ELSE len(list_filter(ln, lambda x: regexp_matches(x, '^[•*\\-●▪‣⁃]'))) / len(ln) END AS bullet_line_ratio,
  CASE WHEN len(ln) = 0 THEN 0 ELSE len(list_filter(ln, lambda x: regexp_matches(x, '(\\.\\.\\.|…)$'))) / len(ln) END AS ellipsis_line_ratio
FROM (SELECT doc_id, {WORDS} AS w, {LINES} AS ln FROM documents))"""


def c4(spark, d):
    own = _docs(spark, d).withColumn("punct", T.ends_sentence(F.col("ln"))).withColumn("curly", F.col("text").rlike("[{}]")).withColumn("filler", T.is_filler(F.col("text"), T.word_count(F.col("text"))))
    return own.select("doc_id", F.round("punct", 6).alias("punct"), "curly", "filler", ((F.col("punct") >= 0.12) & ~F.col("curly") & ~F.col("filler")).alias("passes"))


C4 = f"""SELECT doc_id, round(punct, 6) AS punct, curly, filler, punct >= 0.12 AND NOT curly AND NOT filler AS passes FROM (SELECT doc_id,
  CASE WHEN len(ln) = 0 THEN 0 ELSE len(list_filter(ln, lambda x: regexp_matches(x, '[.!?"”’)]$'))) / len(ln) END AS punct, regexp_matches(text, '[{{}}]') AS curly, contains(lower(text), 'lorem ipsum') AS filler
  FROM (SELECT doc_id, text, {LINES} AS ln FROM documents))"""


def language(spark, d):
    own = _docs(spark, d).withColumn("w", T.words(F.col("text"))).withColumn("r", T.heuristic_language(F.col("w")))
    return own.select("doc_id", "r.lang", F.round("r.score", 6).alias("score"))


_OVER = ", ".join(f"len(list_intersect(own, [{', '.join(repr(x) for x in v)}])) AS n{k}" for k, v in T.LANGUAGE_WORDS.items())
LANGUAGE = f"""SELECT doc_id, CASE WHEN n = 0 OR best = 0 THEN 'und' WHEN nen = best THEN 'en' WHEN nde = best THEN 'de' WHEN nfr = best THEN 'fr' ELSE 'es' END AS lang, round(CASE WHEN n = 0 OR best = 0 THEN 0 ELSE least(5.0 * best / n, 0.9) END, 6) AS score
FROM (SELECT *, greatest(nen, nde, nfr, nes) AS best FROM (SELECT doc_id, len(own) AS n, {_OVER} FROM (SELECT doc_id, list_distinct(list_transform(list_filter({WORDS}, lambda x: regexp_matches(x, '^\\pL+$')), lambda x: lower(x))) AS own FROM documents)))"""


def perplexity(spark, d):
    own = spread(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", T.entropy_proxy(F.col("text")).alias("p"))
    return own.select("doc_id", F.round("p", 4).alias("perplexity"), T.perplexity_bucket(F.col("p")).alias("bucket"))


PERPLEXITY = """WITH c AS (SELECT doc_id, c, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, '')) AS c FROM documents) GROUP BY doc_id, c), t AS (SELECT doc_id, sum(n) AS n, sum(n * log2(n)) AS s FROM c GROUP BY doc_id),
p AS (SELECT d.doc_id, CASE WHEN trim(replace(d.text, chr(10), ' ')) = '' THEN 0 ELSE pow(2, log2(t.n) - t.s / t.n) * 8 END AS p FROM documents d LEFT JOIN t ON d.doc_id = t.doc_id)
SELECT doc_id, round(p, 4) AS perplexity, CASE WHEN p <= 200 THEN 'head' WHEN p <= 1000 THEN 'middle' ELSE 'tail' END AS bucket FROM p"""


def development_quality(spark, d):
    g = T.gopher(F.col("text"), F.col("ln"))
    return _docs(spark, d).select("doc_id", g["word_count"].alias("tokens"), F.round(T.development_quality(g["mean_word_len"], g["word_count"]), 6).alias("quality"))


DEVELOPMENT = f"""SELECT doc_id, CAST(len(w) AS BIGINT) AS tokens, round(5 / (1 + exp(-(m - 4))) * CASE WHEN len(w) < 50 THEN 0.5 ELSE 1 END, 6) AS quality
FROM (SELECT doc_id, w, CASE WHEN len(w) = 0 THEN 0 ELSE list_sum(list_transform(w, lambda x: length(x))) / len(w) END AS m FROM (SELECT doc_id, {WORDS} AS w FROM documents))"""


def urls(spark, d):
    own = table(spark, d, "pages").withColumn("canonical", web.canonical_url(F.col("url")))
    return own.select("page_id", "canonical", web.content_id(F.col("canonical")).alias("content_id"))


TRACKED = "^(utm_.*|gclid|fbclid|mc_eid|mc_cid|igshid|ref|ref_src|ref_url)$"
URLS = rf"""WITH c AS (SELECT page_id, trim(url) AS u FROM pages), p AS (SELECT page_id, lower(regexp_extract(u, '^([A-Za-z]+)://', 1)) AS scheme, lower(regexp_replace(regexp_extract(u, '^[A-Za-z]+://([^/?#]*)', 1), '^.*@', '')) AS place,
  regexp_extract(u, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(u, '^[^?#]*[?]([^#]*)', 1) AS query FROM c),
q AS (SELECT page_id, unnest(list_filter(string_split(query, '&'), lambda x: regexp_matches(x, '^[^=]*=.'))) AS x FROM p),
k AS (SELECT page_id, url_decode(replace(regexp_extract(x, '^([^=]*)=', 1), '+', ' ')) AS k, url_decode(replace(regexp_extract(x, '=(.*)$', 1), '+', ' ')) AS v FROM q),
j AS (SELECT page_id, string_agg(replace(url_encode(k), '%20', '+') || '=' || replace(url_encode(v), '%20', '+'), '&' ORDER BY k, v) AS query FROM k WHERE NOT regexp_matches(lower(k), '{TRACKED}') GROUP BY 1),
o AS (SELECT p.page_id, scheme || '://' || CASE scheme WHEN 'http' THEN regexp_replace(place, ':80$', '') ELSE regexp_replace(place, ':443$', '') END || CASE path WHEN '' THEN '/' ELSE path END || coalesce('?' || j.query, '') AS canonical FROM p LEFT JOIN j ON p.page_id = j.page_id WHERE scheme IN ('http', 'https'))
SELECT c.page_id, canonical, 'sha256:' || sha256(canonical) AS content_id FROM c LEFT JOIN o ON c.page_id = o.page_id"""


def html(spark, d):
    return table(spark, d, "pages").select("page_id", web.html_title(F.col("html")).alias("title"), F.md5(web.html_text(F.col("html"))).alias("text_md5"))


HTML = r"""SELECT page_id, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS title, md5(trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))) AS text_md5 FROM pages"""


def pii_flags(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", F.size(web.valid_ipv4(t)).alias("ipv4"), F.size(web.cards(t)).alias("cards"), F.size(web.emails(t)).alias("emails"))


PII = r"""WITH d AS (SELECT doc_id, list_distinct(regexp_extract_all(text, '\b[\pL\pN_.+-]+@[\pL\pN_-]+\.[\pL\pN_.-]+\b')) AS emails, list_distinct(regexp_extract_all(text, '\b(?:\d{1,3}\.){3}\d{1,3}\b')) AS ips,
  list_distinct(list_transform(regexp_extract_all(text, '\b(?:\d[ -]?){13,19}\b'), lambda x: regexp_replace(x, '[^0-9]', '', 'g'))) AS cards FROM documents)
SELECT doc_id, len(list_filter(ips, lambda x: len(list_filter(string_split(x, '.'), lambda p: CAST(p AS INT) > 255)) = 0))::INT AS ipv4,
  len(list_filter(cards, lambda x: length(x) BETWEEN 13 AND 19 AND list_sum(list_transform(range(length(x)), lambda i: CASE WHEN i % 2 = 0 THEN CAST(substring(x, length(x) - i, 1) AS INT) WHEN CAST(substring(x, length(x) - i, 1) AS INT) > 4 THEN 2 * CAST(substring(x, length(x) - i, 1) AS INT) - 9 ELSE 2 * CAST(substring(x, length(x) - i, 1) AS INT) END)) % 10 = 0))::INT AS cards, len(emails)::INT AS emails FROM d"""


def sanitised(spark, d):
    return table(spark, d, "documents").withColumn("r", sanitise.sanitised("text")).select("doc_id", F.md5("r.text").alias("text_md5"), "r.flags", "r.blocking", "r.n")


def shingle_counts(spark, d):
    w = F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)(\w+)"))
    # The words get a column of their own: an expression inside a lambda would be worked out for each element.
    own = spread(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", w.alias("w")).select("doc_id", T.shingles(F.col("w")).alias("s"))
    return own.select("doc_id", F.size("s").cast("bigint").alias("shingles"), F.size(F.array_distinct("s")).cast("bigint").alias("different"))


SHINGLES = r"""SELECT doc_id, CAST(len(s) AS BIGINT) AS shingles, CAST(len(list_distinct(s)) AS BIGINT) AS different FROM (SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) END AS s FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\pL\pN_]+') AS w FROM documents))"""


def near_duplicates(spark, d):
    _shared(spark)
    return near_dup.clusters(table(spark, d, "documents"))


def activity(spark, d):
    ev = table(spark, d, "events").withColumn("at", F.unix_timestamp(F.col("ts").cast("timestamp")))
    lo, hi = ev.agg(F.min("at"), F.max("at")).first()
    lo, hi = (0, 1) if lo is None else (lo, max(hi, lo + 1))
    return serving.bucketed_activity(ev, "at", lo, hi, 24)


ACTIVITY = """WITH e AS (SELECT CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM events), m AS (SELECT min(sec) AS lo, greatest(max(sec), min(sec) + 1) AS hi FROM e),
b AS (SELECT least(CAST(floor((sec - lo) / ((hi - lo) / 24)) AS BIGINT), 23) AS bucket, count(*) AS n FROM e, m GROUP BY 1) SELECT r.bucket, coalesce(b.n, 0) AS n FROM (SELECT unnest(range(24)) AS bucket) r LEFT JOIN b ON r.bucket = b.bucket"""


def median(spark, d):
    own = table(spark, d, "documents").select("source", F.least(F.greatest(F.size(T.words(F.col("text"))), F.lit(1)), F.lit(512)).alias("weight"), F.col("n_chars").alias("value"))
    return serving.weighted_median(own.groupBy("source", "value").agg(F.sum("weight").alias("weight")), "source", "value", "weight")


MEDIAN = f"""WITH o AS (SELECT source, n_chars AS value, sum(least(greatest(len({WORDS}), 1), 512)) AS weight FROM documents GROUP BY 1, 2),
r AS (SELECT *, sum(weight) OVER (PARTITION BY source ORDER BY value) AS run, sum(weight) OVER (PARTITION BY source) AS total FROM o) SELECT source, min(value) AS weighted_median FROM r WHERE run * 2 >= total GROUP BY source"""


def queue(spark, d):
    return table(spark, d, "documents").select("doc_id", (F.col("n_chars") % 100 / 100.0).alias("ranking_score"), (F.col("n_chars") % 7).alias("quality_score"), (F.lit(BASE) + F.col("doc_id") * 317 % 200_000).alias("enqueued_at"), "source")


QUEUE = f"q AS (SELECT doc_id, n_chars % 100 / 100.0 AS ranking_score, n_chars % 7 AS quality_score, {BASE} + doc_id * 317 % 200000 AS enqueued_at, source FROM documents)"


def _query_cursor(spark, d):
    page = serving.listing(decisions(spark, d), size=5).collect()
    if len(page) < 5:
        return serving.listing(decisions(spark, d), size=5).limit(0)
    cursor = serving.encode_cursor("newest", {"valid_from": page[4].valid_from, "doc_id": page[4].doc_id})
    return serving.listing(decisions(spark, d), cursor=cursor, size=5)


LISTED = LATEST + f", listed AS (SELECT doc_id, source_feed, valid_from, ltrim(string_split(text, chr(10))[1], '# ') AS title, substring(text, 1, 320) AS preview, row_number() OVER (ORDER BY valid_from DESC, doc_id) AS place FROM latest WHERE {VISIBLE})"

QUERIES = {
    "gopher_stats": gopher,
    "c4_stats": c4,
    "lang_heuristic": language,
    "entropy_perplexity": perplexity,
    "dev_quality_score": development_quality,
    "canonical_url": urls,
    "html_fallback_text": html,
    "pii_flags": pii_flags,
    "pii_sanitized": sanitised,
    "shingle_counts": shingle_counts,
    "near_dup_clusters": near_duplicates,
    "exact_duplicates": lambda s, d: near_dup.exact_copies(table(s, d, "documents")),
    "latest_decision": lambda s, d: serving.latest(decisions(s, d)).select("doc_id", "scoring_version", "valid_from", "trace_id", "route"),
    "as_of": lambda s, d: serving.as_of(decisions(s, d), NOW),
    "quality_histogram": lambda s, d: serving.histogram(serving.latest(decisions(s, d)), "quality_score"),
    "curation_summary": lambda s, d: serving.curation_summary(decisions(s, d), admissions(s, d)),
    "corpus_overview": lambda s, d: serving.corpus_overview(decisions(s, d), admissions(s, d)),
    "documents_page": lambda s, d: serving.listing(decisions(s, d), size=5),
    "documents_keyset_page2": _query_cursor,
    "document_facets": lambda s, d: serving.facets(decisions(s, d)),
    "dataset_rows": lambda s, d: serving.dataset_rows(decisions(s, d), T.PERMITTED).select("doc_id", "tokens", "valid_from"),
    "dataset_summary": lambda s, d: serving.dataset_summary(serving.dataset_rows(decisions(s, d), T.PERMITTED)),
    "source_activity": lambda s, d: serving.source_activity(decisions(s, d), NOW, 24),
    "license_admissions": lambda s, d: admissions(s, d).groupBy("status", "license_id").agg(F.count("*").alias("n")),
    "weighted_median": median,
    "activity_buckets": activity,
    "daily_cohort": cohort,
    "pool_split": lambda s, d: serving.pool_split(table(s, d, "conversations").groupBy("conv_id").agg(F.max("turn").alias("turns")).withColumn("pool", F.when(F.col("conv_id") % 3 == 0, "rl").otherwise("sft")), "pool", "turns", "conv_id").select("conv_id", "pool", "ordinal", "split"),
    "stratified_split": lambda s, d: serving.stratified_split(table(s, d, "documents").select("doc_id", "source"), "source", "doc_id"),
    "diverse_selection": lambda s, d: serving.capped_selection(queue(s, d), "source", 2, 25, F.desc("ranking_score"), F.asc("doc_id")).select("doc_id", "source", "ranking_score"),
    "counter_deltas": lambda s, d: serving.counter_deltas(table(s, d, "events").select("event_id", "event_type", F.floor("value").alias("v")), "event_type", "event_id", "v").groupBy("event_type").agg(F.sum("delta").alias("delta")),
    "decision_upsert": lambda s, d: serving.upsert_smallest_trace(decisions(s, d), decisions(s, d).withColumn("trace_id", F.md5("trace_id"))).select("doc_id", "scoring_version", "trace_id"),
    "work_cutoff": lambda s, d: serving.not_expired(queue(s, d), "enqueued_at", BASE + 100_000).select("doc_id", "enqueued_at"),
    "latest_order_per_customer": lambda s, d: serving.first_by(table(s, d, "orders"), ["o_custkey"], F.desc("o_orderdate"), F.asc("o_orderkey")).select("o_custkey", "o_orderkey"),
    "running_event_rank": lambda s, d: table(s, d, "events").withColumn("rn", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))).filter("rn <= 3").select("event_id", "user_id", "rn"),
}
FLAGSHIP = "corpus_overview"

ORACLE_SQL = {
    "pii_flags": PII,
    "gopher_stats": GOPHER,
    "c4_stats": C4,
    "lang_heuristic": LANGUAGE,
    "entropy_perplexity": PERPLEXITY,
    "dev_quality_score": DEVELOPMENT,
    "canonical_url": URLS,
    "html_fallback_text": HTML,
    "shingle_counts": SHINGLES,
    "exact_duplicates": "SELECT sha256(text) AS sha, count(*) AS copies, min(doc_id) AS first_doc FROM documents GROUP BY 1 HAVING count(*) > 1",
    "latest_decision": f"WITH {LATEST} SELECT doc_id, scoring_version, valid_from, trace_id, route FROM latest",
    "as_of": f"WITH {DECISIONS}, o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY valid_from DESC, scoring_version DESC, policy_revision DESC, trace_id) AS rn FROM decisions WHERE valid_from <= {NOW} AND (valid_to IS NULL OR valid_to > {NOW})) SELECT source_feed, CAST(sum(coalesce(tokens, 0)) AS BIGINT) AS tokens, count(*) AS documents FROM o WHERE rn = 1 AND {TRAINABLE} AND {VISIBLE} AND {SHOWN} GROUP BY 1",
    "quality_histogram": f"WITH {LATEST} SELECT floor(quality_score * 2) / 2 AS bucket, count(*) AS n FROM latest GROUP BY 1",
    "curation_summary": f"WITH {LATEST}, {ADMISSIONS}, e AS (SELECT count(*) AS n FROM admissions WHERE status = 'quarantined' AND doc_id NOT IN (SELECT doc_id FROM decisions)), r AS (SELECT CASE route WHEN 'broad_pretraining' THEN 'pretrain' ELSE route END AS route, count(*) AS n, sum(tokens) AS tokens, sum(quality_score) AS q FROM latest GROUP BY 1 UNION ALL SELECT 'quarantine', n, 0, 0 FROM e) SELECT route, CAST(sum(n) AS BIGINT) AS documents, CAST(sum(tokens) AS BIGINT) AS tokens, round(sum(q) / sum(n), 6) AS mean_quality FROM r GROUP BY route HAVING sum(n) > 0",
    "corpus_overview": f"WITH {LATEST}, {ADMISSIONS}, l AS (SELECT * FROM latest WHERE {VISIBLE} AND {SHOWN}) SELECT 'total' AS kind, 'decisions' AS key, count(*) AS n FROM l HAVING count(*) > 0 UNION ALL SELECT 'source', source_feed, count(*) FROM l GROUP BY 2 UNION ALL SELECT 'accepted', source_feed, count(*) FROM l WHERE len(reject_reasons) = 0 GROUP BY 2 UNION ALL SELECT 'reason', r, count(*) FROM (SELECT unnest(reject_reasons) AS r FROM l UNION ALL SELECT CASE license_id WHEN 'unknown' THEN 'license_missing' ELSE 'license_not_permitted' END FROM admissions WHERE status = 'quarantined' AND doc_id NOT IN (SELECT doc_id FROM decisions)) GROUP BY 2",
    "documents_page": f"WITH {LISTED} SELECT doc_id, source_feed, valid_from, title, preview FROM listed WHERE place <= 6",
    "documents_keyset_page2": f"WITH {LISTED} SELECT doc_id, source_feed, valid_from, title, preview FROM listed WHERE place BETWEEN 6 AND 11",
    "document_facets": f"WITH {LATEST}, l AS (SELECT * FROM latest WHERE {VISIBLE}) SELECT DISTINCT 'source' AS facet, source_feed AS value FROM l UNION SELECT 'lang', lang FROM l UNION SELECT 'reason', r FROM (SELECT unnest(reject_reasons) AS r FROM l)",
    "dataset_rows": f"WITH {LATEST} SELECT doc_id, tokens, valid_from FROM latest WHERE {TRAINABLE} AND coalesce(spdx_license, license) IN ('CC-BY-4.0', 'MIT', 'Apache-2.0')",
    "dataset_summary": f"WITH {LATEST}, l AS (SELECT * FROM latest WHERE {TRAINABLE} AND coalesce(spdx_license, license) IN ('CC-BY-4.0', 'MIT', 'Apache-2.0')) SELECT count(*) AS documents, count(DISTINCT doc_id) AS distinct_documents, CAST(sum(tokens) AS BIGINT) AS tokens, (SELECT string_agg(x, ',' ORDER BY x) FROM (SELECT DISTINCT scoring_version AS x FROM l)) AS scoring_versions, (SELECT string_agg(x, ',' ORDER BY x) FROM (SELECT DISTINCT policy_revision AS x FROM l)) AS policy_revisions, (SELECT string_agg(x, ',' ORDER BY x) FROM (SELECT DISTINCT lang AS x FROM l)) AS langs FROM l",
    "source_activity": f"WITH {DECISIONS} SELECT source_feed AS feed, count(*) AS n, count(*) FILTER (WHERE len(reject_reasons) = 0) AS accepted, count(*) FILTER (WHERE risk_tier = 3) AS risky, max(valid_from) AS newest FROM decisions WHERE valid_from > {NOW - 86400} AND valid_from <= {NOW} GROUP BY 1",
    "license_admissions": f"WITH {ADMISSIONS} SELECT status, license_id, count(*) AS n FROM admissions GROUP BY 1, 2",
    "weighted_median": MEDIAN,
    "activity_buckets": ACTIVITY,
    "daily_cohort": f"WITH {QUEUE} SELECT doc_id, CAST(row_number() OVER (ORDER BY ranking_score DESC, quality_score DESC, enqueued_at, doc_id) AS INTEGER) AS position FROM q WHERE enqueued_at > {BASE + 100_000 - 86_400} AND enqueued_at <= {BASE + 100_000}",
    "pool_split": "SELECT conv_id, pool, CAST(o AS INTEGER) AS ordinal, CASE WHEN o % 5 = 0 THEN 'benchmark' ELSE 'train' END AS split FROM (SELECT conv_id, pool, row_number() OVER (PARTITION BY pool ORDER BY turns, conv_id) AS o FROM (SELECT conv_id, CASE WHEN conv_id % 3 = 0 THEN 'rl' ELSE 'sft' END AS pool, max(turn) AS turns FROM conversations GROUP BY 1, 2))",
    "stratified_split": "SELECT doc_id, source, CASE WHEN r <= CASE WHEN n >= 2 THEN greatest(1, round_even(n * 0.1, 0)) ELSE 0 END THEN 'test' ELSE 'train' END AS split FROM (SELECT doc_id, source, count(*) OVER (PARTITION BY source) AS n, row_number() OVER (PARTITION BY source ORDER BY sha256(CAST(doc_id AS VARCHAR))) AS r FROM documents)",
    "diverse_selection": f"WITH {QUEUE}, r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY ranking_score DESC, doc_id) AS rn FROM q) SELECT doc_id, source, CAST(ranking_score AS DOUBLE) AS ranking_score FROM r WHERE rn <= 2 ORDER BY ranking_score DESC, doc_id LIMIT 25",
    "counter_deltas": "SELECT event_type, CAST(sum(CASE WHEN p IS NULL THEN 0 WHEN v >= p THEN v - p ELSE v END) AS BIGINT) AS delta FROM (SELECT event_type, v, lag(v) OVER (PARTITION BY event_type ORDER BY event_id) AS p FROM (SELECT event_id, event_type, CAST(floor(value) AS BIGINT) AS v FROM events)) GROUP BY 1",
    "decision_upsert": f"WITH {DECISIONS} SELECT doc_id, scoring_version, least(trace_id, md5(trace_id)) AS trace_id FROM decisions",
    "work_cutoff": f"WITH {QUEUE} SELECT doc_id, enqueued_at FROM q WHERE {BASE + 100_000} - enqueued_at < 86400",
    "latest_order_per_customer": "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1",
    "running_event_rank": "SELECT event_id, user_id, CAST(rn AS INTEGER) AS rn FROM (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn <= 3",
}
QUERIES |= curation.QUERIES
ORACLE_SQL |= curation.ORACLE_SQL | {"curate_documents": curation.curate_oracle(GOPHER, C4, LANGUAGE)}
