"""Registered queries of scoring, routing, cards, sections, evidence and maintenance, with their oracles.

Roles that the driver's tables lack are derived from them by plain expressions, which the oracles repeat.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.functions import cards, licence, markup, routing, scoring, validity
from gristmill.functions import text as T
from gristmill.operators import evidence, serving
from gristmill.sources.tables import spread, table

TITLES = ["Usage", "Limitations", "Dataset structure", "Overview", "Notes"]
WORDS = r"list_filter(string_split_regex(text, '\s+'), lambda w: w <> '')"


def _pick(items, col, by):
    return F.element_at(F.array(*map(F.lit, items)), (F.col(col) % by + 1).cast("int"))


def _list(items):
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in items) + "]"


def _docs(spark, d):
    return table(spark, d, "documents")


def _turns(spark, d):
    return table(spark, d, "conversations").filter(F.col("conv_id").isNotNull())


# Cards.


def card_gate(spark, d):
    own = _docs(spark, d).select("doc_id", "text", F.when(F.col("doc_id") % 2 == 0, "model").otherwise("dataset").alias("kind"), F.when(F.col("doc_id") % 3 == 0, "x").alias("title"), F.array(_pick(TITLES, "doc_id", 5)).alias("titles"))
    got = cards.assess(own, "kind", "title", "text", "titles")
    return got.select("doc_id", "accepted", F.array_join("categories", ",").alias("categories"), F.array_join("evidence", ",").alias("evidence"))


def _has(items):
    return "(" + " OR ".join(f"contains(n, '{x}')" for x in items) + ")"


def _sum(items):
    return "(" + " + ".join(f"CAST(contains(n, '{x}') AS INT)" for x in items) + ")"


CARD = rf"""WITH a AS (SELECT doc_id, kind, title, list_extract({_list(TITLES)}, CAST(doc_id % 5 + 1 AS INT)) AS h0, n, words FROM
  (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'model' ELSE 'dataset' END AS kind, doc_id % 3 = 0 AS title, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) AS n, len(regexp_extract_all(text, '[\pL\pN\pM_]+')) AS words FROM documents)),
b AS (SELECT *, lower(h0) AS h,
  list_filter([{", ".join(f"CASE WHEN {_has(v)} THEN '{k}' END" for k, v in sorted(cards.DIMENSIONS.items()))}], lambda x: x IS NOT NULL) AS dims,
  list_filter([{", ".join(f"CASE WHEN regexp_matches(n, '{v}') THEN '{k}' END" for k, v in sorted(cards.EVIDENCE.items()))}], lambda x: x IS NOT NULL) AS g FROM a),
c AS (SELECT *, CASE WHEN kind = 'model' THEN list_contains({_list(cards.MODEL_DETAILS)}, h) ELSE list_contains({_list(cards.DATASET_DETAILS)}, h) END AS det,
  CASE WHEN kind = 'model' THEN list_contains({_list(cards.DATASET_DETAILS)}, h) AND NOT list_contains({_list(cards.MODEL_DETAILS)}, h) ELSE list_contains({_list(cards.MODEL_DETAILS)}, h) AND NOT list_contains({_list(cards.DATASET_DETAILS)}, h) END AS wrong,
  list_contains({_list(cards.OVERVIEW)}, h) OR contains(n, 'this ' || kind) AS ov, {_has(cards.PLACEHOLDERS)} AS ph, {_has(cards.UPLOAD_STUBS)} AS stub, {_has(cards.MARKETING)} AS mk, {_sum(cards.GENERIC_BENCHMARKS)} >= 2 AS gen,
  {_sum(cards.TRAINER_TEMPLATE)} >= 2 AND NOT list_has_any(dims, ['architecture', 'evaluation', 'usage', 'limitations']) AS tr, {_sum(cards.SCRIPT_MARKERS)} = 4 AS sc,
  words < 120 AND {_has(cards.ARTIFACT_MARKERS)} AND NOT list_has_any(g, ['measured', 'immutable', 'metric', 'named_source']) AS art, len(dims) >= 2 AND len(g) > 0 AS tech FROM b),
e AS (SELECT *, NOT (ph OR stub OR gen OR tr OR sc OR art OR wrong OR (mk AND NOT tech)) AND ((ov AND det AND len(g) > 0) OR tech OR (words >= 25 AND len(dims) >= 1 AND len(g) >= 3 AND list_contains(g, 'measured')) OR (words >= 180 AND len(dims) >= 1 AND len(g) >= 2)) AS accepted FROM c),
f AS (SELECT *, list_filter([CASE WHEN ph THEN 'template_boilerplate' END, CASE WHEN tr THEN 'template_boilerplate' END, CASE WHEN stub OR n = '' THEN 'stub_checkpoint_upload' END, CASE WHEN gen THEN 'generic_marketing_benchmark' END, CASE WHEN sc THEN 'synthetic_script_card' END,
  CASE WHEN art THEN 'minimal_artifact_listing' END, CASE WHEN mk THEN 'marketing' END, CASE WHEN wrong THEN 'wrong_repository_type' END], lambda x: x IS NOT NULL) AS cats FROM e)
SELECT doc_id, accepted, array_to_string(list_concat(cats, CASE WHEN accepted THEN [CASE WHEN list_has_all(dims, ['architecture', 'training', 'evaluation']) THEN 'dense_scientific_card' ELSE 'substantive_technical_card' END] WHEN len(cats) = 0 THEN ['insufficient_card_documentation'] ELSE CAST([] AS VARCHAR[]) END), ',') AS categories,
  array_to_string(list_concat(list_concat(CASE WHEN det THEN ['section:' || h] ELSE CAST([] AS VARCHAR[]) END, list_transform(dims, lambda x: 'dimension:' || x)), list_concat(list_transform(g, lambda x: 'grounding:' || x), CASE WHEN title THEN ['title_present'] ELSE CAST([] AS VARCHAR[]) END)), ',') AS evidence FROM f"""


# Sections. The turns of a conversation are the sections of a document; a turn's whole text is its title.


def section_types(spark, d):
    feed = F.when(F.col("conv_id") % 2 == 0, scoring.PAPER_FEED).otherwise("hf-models")
    own = _turns(spark, d).withColumn("feed", feed).withColumn("kind", scoring.section_type(F.col("text"), F.col("feed")))
    return own.select("conv_id", "turn", "kind", F.md5(scoring.model_input(F.col("role"), F.col("kind"), F.col("text"), F.col("feed"))).alias("input_md5"))


def _types(table_):
    return " ".join("WHEN " + " OR ".join(f"contains(lower(text), '{t}')" for t in terms) + f" THEN '{k}'" for k, terms in table_.items())


SECTION_TYPES = f"""SELECT conv_id, turn, kind, md5('[SOURCE=' || CASE WHEN conv_id % 2 = 0 THEN 'arxiv' ELSE 'hf' END || '] [SECTION_TYPE=' || kind || '] [SECTION_TITLE=' || role || ']' || chr(10) || text) AS input_md5
FROM (SELECT *, CASE WHEN conv_id % 2 = 0 THEN CASE {_types(scoring.PAPER_TYPES)} ELSE 'other' END ELSE CASE {_types(scoring.CARD_TYPES)} ELSE 'other' END END AS kind FROM conversations)"""

HEADS = ["1. Introduction", "A.2 Related Work", "Abstract:", "3 Methods and materials", "Results", "References", "Acknowledgements", "Ethics statement", "Future work", "Notes"]


def _roles(spark, d):
    own = _turns(spark, d).withColumn("title", F.element_at(F.array(*map(F.lit, HEADS)), ((F.col("conv_id") * 3 + F.col("turn")) % len(HEADS) + 1).cast("int")))
    return own.withColumn("section_role", scoring.section_role(F.col("title")))


def section_roles(spark, d):
    return _roles(spark, d).select("conv_id", "turn", "section_role", scoring.is_excluded(F.col("section_role"), F.col("title")).alias("excluded"))


ROLED = f"""r AS (SELECT *, list_extract(['introduction', 'background', 'abstract', 'methods', 'results', 'references', 'acknowledgements', 'other', 'conclusion', 'other'], CAST((conv_id * 3 + turn) % 10 + 1 AS INT)) AS section_role, list_extract({_list(HEADS)}, CAST((conv_id * 3 + turn) % 10 + 1 AS INT)) AS title FROM conversations)"""


def body_projection(spark, d):
    """Sections from the body's start on, as one text."""
    own = _roles(spark, d).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "title", "text", "section_role"))).alias("s"))
    own = own.withColumn("segments", F.transform("s", lambda x: F.struct(x["title"].alias("title"), x["text"].alias("text"))))
    start = scoring.body_start(F.col("s.section_role"))
    kept = scoring.source_segments(F.col("segments"), F.col("s.section_role"), F.lit(True), F.lit(None).cast("string"), F.lit(""))
    title = F.concat(F.lit("Conversation "), F.col("conv_id"))
    return own.select("conv_id", start.alias("start"), kept.alias("kept")).select("conv_id", "start", F.md5(scoring.training_projection(title, F.col("kept"), F.lit(" tables "))).alias("text_md5"))


BODY = f"""WITH {ROLED}, o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, title, text) - 1 AS i FROM r),
s AS (SELECT conv_id, CAST(coalesce(min(i) FILTER (WHERE section_role = 'abstract'), min(i) FILTER (WHERE section_role = 'introduction'), 0) AS INT) AS start FROM o GROUP BY conv_id)
SELECT o.conv_id, any_value(s.start) AS start, md5('# Conversation ' || o.conv_id || chr(10) || chr(10) || string_agg('## ' || title || chr(10) || trim(text, ' ' || chr(10)), chr(10) || chr(10) ORDER BY i) || chr(10) || chr(10) || 'tables') AS text_md5 FROM o JOIN s ON o.conv_id = s.conv_id WHERE i >= s.start GROUP BY o.conv_id"""


def _scored(spark, d):
    words = F.size(T.words(F.col("text")))
    return _turns(spark, d).select("conv_id", "turn", "role", words.alias("tokens"), (F.length("text") % 51 / 10.0).alias("score"), (F.length("text") % 6).alias("klass"))


def section_quality(spark, d):
    return _rounded(evidence.section_quality(_scored(spark, d), "conv_id", "turn", "score", "tokens", "klass", F.when(F.col("conv_id") % 2 == 0, 3.5).otherwise(3.0)), "quality", "mean")


def _rounded(df, *cols):
    """Nine digits: exact sums often end in a five at the seventh."""
    return df.withColumns({c: F.round(c, 9) for c in cols})


SCORED = f"s AS (SELECT conv_id, turn, role, greatest(len({WORDS}), 1) AS t, CAST(length(text) % 51 / 10.0 AS DOUBLE) AS score, length(text) % 6 AS klass FROM conversations)"
SECTION_QUALITY = f"""WITH {SCORED}, q AS (SELECT conv_id, sum(score * t) / sum(t) AS quality, max(score) AS best, avg(score) AS mean, count(*) AS sections, count(*) FILTER (WHERE klass = 5) AS class_5_sections FROM s GROUP BY 1),
b AS (SELECT conv_id, turn FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY score DESC, turn) AS rn FROM s) WHERE rn = 1)
SELECT q.conv_id, round(quality, 9) AS quality, best, b.turn AS best_section, round(mean, 9) AS mean, sections, class_5_sections, quality >= CASE WHEN q.conv_id % 2 = 0 THEN 3.5 ELSE 3.0 END AS passed FROM q JOIN b ON q.conv_id = b.conv_id"""


# Scores, reasons and routes.


def _signals(spark, d):
    i = F.col("doc_id")
    roles = F.array_compact(F.array(F.when(i % 2 == 0, "abstract"), F.when(i % 3 == 0, "methods"), F.when(i % 5 == 0, "results"), F.when(i % 7 == 0, "other")))
    return _docs(spark, d).select("doc_id", "text", F.when(i % 4 > 0, "t").alias("title"), roles.alias("roles"), F.size(T.words(F.col("text"))).alias("words"), (i % 3).alias("eq"), (i % 2).alias("tb"), (i % 5 % 2).alias("fg"), (i % 11).alias("ct"), (i % 6 % 2).alias("warn"), (i % 51 / 10.0).alias("q"))


def paper_scores(spark, d):
    c = F.col
    own = _signals(spark, d).withColumn("s", scoring.paper_scores(c("title"), c("roles"), F.size("roles"), c("words"), c("eq"), c("tb"), c("fg"), c("ct"), c("warn"), c("q")))
    signals = [c("q") / 5, c("s.structure") / 5, c("s.completeness"), c("s.reasoning")]
    rank = scoring.ranking_score(c("doc_id") % 3 == 0, c("q"), signals, c("q"), c("doc_id") % 3 == 1)
    return _rounded(own.select("doc_id", "s.*", rank.alias("ranking")), "completeness", "structure", "reasoning", "ranking")


PAPER = f"""WITH a AS (SELECT doc_id, doc_id % 4 > 0 AS ti, CAST(doc_id % 2 = 0 AS INT) AS ab, CAST(doc_id % 3 = 0 AS INT) AS me, CAST(doc_id % 5 = 0 AS INT) AS re, CAST(doc_id % 7 = 0 AS INT) AS ot, len({WORDS}) AS w,
  CAST(doc_id % 3 > 0 AS INT) AS eq, CAST(doc_id % 2 > 0 AS INT) AS tb, CAST(doc_id % 5 % 2 > 0 AS INT) AS fg, doc_id % 11 > 0 AS ct, doc_id % 6 % 2 = 0 AS ok, CAST(doc_id % 51 / 10.0 AS DOUBLE) AS q FROM documents),
b AS (SELECT *, CAST(CASE WHEN ti THEN 0.12 ELSE 0 END + 0.18 * ab + CASE WHEN ab + me + re + ot >= 3 THEN 0.2 WHEN ab + me + re + ot > 0 THEN 0.1 ELSE 0 END + CASE WHEN w >= 500 THEN 0.2 WHEN w >= 100 THEN 0.1 ELSE 0 END + CASE WHEN eq + tb + fg > 0 THEN 0.12 ELSE 0 END + CASE WHEN ct THEN 0.08 ELSE 0 END + CASE WHEN ok THEN 0.1 ELSE 0.03 END AS DOUBLE) AS c FROM a),
e AS (SELECT *, 5 * (0.55 * c + 0.25 * (ab + me + re) / 3.0 + 0.2 * (eq + tb + fg) / 3.0) AS s FROM b),
f AS (SELECT *, 0.22 * me + 0.24 * re + 0.14 * eq + 0.12 * tb + 0.08 * fg + 0.02 * s + 0.02 * q AS r FROM e)
SELECT doc_id, round(c, 9) AS completeness, round(s, 9) AS structure, round(CAST(r AS DOUBLE), 9) AS reasoning, round(CAST(CASE doc_id % 3 WHEN 0 THEN q / 5 WHEN 1 THEN (q / 5 + s / 5 + c + r) / 4 ELSE (q / 5 + s / 5 + c + r + q / 5) / 5 END AS DOUBLE), 9) AS ranking FROM f"""


def prose_scores(spark, d):
    c = F.col
    own = _signals(spark, d).select("doc_id", scoring.prose_scores(c("title"), c("text"), c("words"), c("warn"), c("doc_id") % 10 > 0, c("q")).alias("s"))
    return _rounded(own.select("doc_id", "s.*"), "completeness", "structure", "reasoning")


PROSE = f"""WITH a AS (SELECT doc_id, CAST(CASE WHEN doc_id % 4 > 0 THEN 0.15 ELSE 0 END + 0.55 * least(1.0, len({WORDS}) / 500) + CASE WHEN doc_id % 6 % 2 = 0 THEN 0.2 ELSE 0 END + CASE WHEN len({WORDS}) > 0 THEN 0.1 ELSE 0 END AS DOUBLE) AS c, CAST(doc_id % 51 / 10.0 AS DOUBLE) AS q FROM documents)
SELECT doc_id, round(c, 9) AS completeness, round(5 * c, 9) AS structure, round(CASE WHEN doc_id % 10 > 0 THEN least(0.45, 0.1 + 0.03 * q + 0.2 * c) ELSE 0 END, 9) AS reasoning FROM a"""


def source_policies(spark, d):
    own = table(spark, d, "pages").select("page_id", _pick(["arxiv-html", "hf-models", "hf-datasets", "cluster-smoke", "blog"], "page_id", 5).alias("feed"), _pick(["html", "metadata", "pdf", "web"], "page_id", 4).alias("format"))
    own = own.withColumn("p", routing.source_policy(F.col("feed"), F.col("format"), F.lit("v1")))
    return own.select("page_id", "p.*")


POLICIES = """SELECT page_id, id AS policy_id, CASE id WHEN 'metadata-discovery-only' THEN 'discovery_metadata' WHEN 'hf-model-card-source-modernbert' THEN 'hf_model_card' WHEN 'hf-dataset-card-source-modernbert' THEN 'hf_dataset_card' WHEN 'scientific-source-modernbert' THEN 'scientific_paper' ELSE 'web_prose' END AS family,
  id <> 'metadata-discovery-only' AS training_text, id <> 'metadata-discovery-only' AS language_gate, id = 'web-source-modernbert' AS web_heuristic_gate, CASE WHEN id = 'web-source-modernbert' THEN 'gate' ELSE 'off' END AS kenlm_mode
FROM (SELECT page_id, CASE WHEN page_id % 4 = 1 THEN 'metadata-discovery-only' WHEN page_id % 5 = 1 THEN 'hf-model-card-source-modernbert' WHEN page_id % 5 = 2 THEN 'hf-dataset-card-source-modernbert' WHEN page_id % 5 = 3 THEN 'technical-docs-source-modernbert'
  WHEN page_id % 4 = 2 OR (page_id % 4 = 0 AND page_id % 5 = 0) THEN 'scientific-source-modernbert' ELSE 'web-source-modernbert' END AS id FROM pages)"""


def curate_documents(spark, d):
    """Word, sentence, language and quality rules together: reasons in order, composite quality, route and risk."""
    c, labels = F.col, table(spark, d, "labels").groupBy("doc_id").agg(F.min("quality").alias("label"))
    own = spread(_docs(spark, d).select("doc_id", "text")).select("doc_id", "text", T.words(c("text")).alias("w"), T.lines(c("text")).alias("ln"))
    own = own.withColumns({k: v for k, v in T.gopher(c("text"), c("ln")).items()})
    own = own.withColumns({"gopher": T.gopher_passes(), "c4": (T.ends_sentence(c("ln")) >= 0.12) & ~c("text").rlike("[{}]") & ~T.is_filler(c("text"), F.size("w")), "l": T.heuristic_language(c("w"))})
    # The oracle reads the registered language scores, which are rounded.
    own = own.withColumn("l", c("l").withField("score", F.round("l.score", 6)))
    own = own.join(labels, "doc_id", "left").withColumns({"quality": F.coalesce(c("label") * 2.0 + 2.0, F.lit(3.0)), "pii": F.when(c("text").contains("@"), F.array(F.lit("email"))).otherwise(F.array().cast("array<string>"))})
    reasons = scoring.reject_reasons({"low_quality": c("quality") < 3, "short": c("word_count") < 50, "web": c("doc_id") % 2 == 0, "scientific": c("doc_id") % 2 == 1, "fails_gopher": ~c("gopher"), "fails_c4": ~c("c4"), "foreign": (c("l.lang") != "en") | (c("l.score") < 0.5), "licence": licence.gate(F.lit("pretrain_and_posttrain"), F.when(c("doc_id") % 17 == 0, "proprietary").otherwise("MIT")).isNotNull()})
    own = own.withColumn("reasons", reasons).withColumn("s", scoring.prose_scores(F.lit(None).cast("string"), c("text"), c("word_count"), F.lit(0), F.lit(True), c("quality")))
    own = own.withColumn("composite", T.composite_quality(c("s.structure"), c("quality"), c("l.score") * 5.0)).withColumn("route", routing.base_route(c("reasons"), c("s.reasoning") + F.when(c("doc_id") % 5 == 0, 0.2).otherwise(0.0), F.lit(True)))
    return own.select("doc_id", F.array_join("reasons", ",").alias("reasons"), F.round("composite", 9).alias("composite"), "route", T.risk_tier(c("pii"), c("reasons")).alias("risk_tier"), T.is_trainable(T.risk_tier(c("pii"), c("reasons")), c("route"), c("reasons"), c("pii")).alias("trainable"))


def curate_oracle(gopher: str, c4: str, language: str) -> str:
    return f"""WITH g AS ({gopher}), c AS ({c4}), l AS ({language}), q AS (SELECT doc_id, min(quality) * 2.0 + 2.0 AS v FROM labels GROUP BY 1),
a AS (SELECT d.doc_id, contains(d.text, '@') AS pii, g.word_count AS w, g.passes AS gp, c.passes AS cp, l.lang, l.score AS ls, CAST(coalesce(q.v, 3.0) AS DOUBLE) AS q, CAST(0.55 * least(1.0, g.word_count / 500) + 0.2 + CASE WHEN g.word_count > 0 THEN 0.1 ELSE 0 END AS DOUBLE) AS cm
  FROM documents d JOIN g ON g.doc_id = d.doc_id JOIN c ON c.doc_id = d.doc_id JOIN l ON l.doc_id = d.doc_id LEFT JOIN q ON q.doc_id = d.doc_id),
b AS (SELECT *, list_filter([CASE WHEN q < 3 THEN 'low_quality_score' END, CASE WHEN w < 50 THEN CASE WHEN doc_id % 2 = 1 THEN 'insufficient_scientific_body' ELSE 'insufficient_body' END END,
  CASE WHEN doc_id % 2 = 0 AND w >= 50 AND NOT gp THEN 'gopher_filter' END, CASE WHEN doc_id % 2 = 0 AND w >= 50 AND NOT cp THEN 'c4_nopunc_filter' END, CASE WHEN lang <> 'en' OR ls < 0.5 THEN 'language_filter' END, CASE WHEN doc_id % 17 = 0 THEN 'license_excluded' END], lambda x: x IS NOT NULL) AS rj,
  least(0.45, 0.1 + 0.03 * q + 0.2 * cm) + CASE WHEN doc_id % 5 = 0 THEN 0.2 ELSE 0 END AS rs FROM a),
e AS (SELECT *, CASE WHEN len(list_filter(rj, lambda x: x <> 'insufficient_scientific_body')) > 0 THEN 'quarantine' WHEN len(rj) > 0 THEN 'retry' WHEN rs >= 0.55 THEN 'posttrain_candidate' ELSE 'pretrain' END AS route FROM b)
SELECT doc_id, array_to_string(rj, ',') AS reasons, round(0.2 * 5 * cm + 0.7 * q + 0.1 * ls * 5, 9) AS composite, route, CASE WHEN pii THEN 3 WHEN len(rj) > 0 THEN 2 ELSE 1 END AS risk_tier, len(rj) = 0 AND NOT pii AS trainable FROM e"""


def validity_intervals(spark, d):
    i = F.col("page_id")
    raw = F.when(i % 4 == 0, F.concat(F.lit("2026-06-"), F.lpad((i % 28 + 1).cast("string"), 2, "0"), F.lit("T08:00:00+02:00"))).when(i % 4 == 1, "Wed, 10 Jun 2026 08:00:00 GMT").when(i % 4 == 2, "soon")
    xml = F.when(i % 3 == 0, "<lastmod>x</lastmod><lastmod>2026-03-01</lastmod>").otherwise("")
    times = {"http_last_modified": validity.parse_time(raw), "schema_org_date_published": validity.published(F.col("html")), "sitemap_lastmod": validity.sitemap_lastmod(xml), "fetched_at": validity.parse_time(F.lit("2026-07-01"))}
    own = table(spark, d, "pages").select("page_id", validity.validity(times, [validity.parse_time(F.lit("2026-06-10"))]).alias("v"))
    return own.select("page_id", F.unix_timestamp("v.valid_from").alias("valid_from"), F.unix_timestamp("v.valid_to").alias("valid_to"), "v.valid_from_source")


VALIDITY = """SELECT page_id, CAST(f AS BIGINT) AS valid_from, CASE WHEN 1781049600 > f THEN CAST(1781049600 AS BIGINT) END AS valid_to, src AS valid_from_source FROM (SELECT page_id,
  CASE WHEN page_id % 4 = 0 THEN 1780293600 + page_id % 28 * 86400 WHEN page_id % 4 = 1 THEN 1781078400 WHEN page_id % 3 = 0 THEN 1772323200 ELSE 1782864000 END AS f,
  CASE WHEN page_id % 4 < 2 THEN 'http_last_modified' WHEN page_id % 3 = 0 THEN 'sitemap_lastmod' ELSE 'fetched_at' END AS src FROM pages WHERE NOT contains(html, 'datePublished'))"""


def perplexity_text(spark, d):
    return _docs(spark, d).select("doc_id", F.md5(scoring.normalized_for_perplexity(F.col("text"))).alias("text_md5"))


def _normal_sql():
    x = "regexp_replace(trim(text, ' ' || chr(10)), '[0-9]', '0', 'g')"
    for k, v in scoring.MARKS.items():
        x = f"replace({x}, '{k}', '{v.replace(chr(39), chr(39) * 2)}')"
    return rf"SELECT doc_id, md5(regexp_replace({x}, '[\x00-\x1f\x7f-\x{{9f}}]', '', 'g')) AS text_md5 FROM documents"


def ordinal_heads(spark, d):
    i = F.col("doc_id")
    own = _docs(spark, d).select("doc_id", T.ordinal(F.array(*[(i * (k + 1) % 7 / 2.0) for k in range(6)])).alias("o"))
    return own.select("doc_id", F.round("o.score", 6).alias("score"), "o.klass", F.round("o.confidence", 6).alias("confidence"))


_E = [f"exp(doc_id * {k + 1} % 7 / 2.0)" for k in range(6)]
ORDINAL = f"""SELECT doc_id, round(s, 6) AS score, CAST(round_even(s, 0) AS INT) AS klass, round(1 + ({" + ".join(f"p{k} * ln(p{k})" for k in range(6))}) / ln(6), 6) AS confidence
FROM (SELECT *, {" + ".join(f"{k} * p{k}" for k in range(6))} AS s FROM (SELECT doc_id, {", ".join(f"{e} / ({' + '.join(_E)}) AS p{k}" for k, e in enumerate(_E))} FROM documents))"""


# Spans, search and graphs.


def stable_spans(spark, d):
    return evidence.stable_spans(_docs(spark, d).filter(F.col("doc_id").isNotNull()), "doc_id", "text").select("doc_id", "ordinal", "span_id", "span_sha")


SPANS = r"""WITH b AS (SELECT doc_id, list_filter(list_transform(string_split_regex(text, '\n\s*\n'), lambda x: trim(x, ' ' || chr(10))), lambda x: x <> '') AS p, list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\s+([A-Z])', '\1' || chr(1) || '\2', 'g'), chr(1)), lambda x: trim(x, ' ' || chr(10))), lambda x: x <> '') AS s FROM documents),
u AS (SELECT doc_id, unnest(CASE WHEN len(p) > 1 THEN p ELSE s END) AS x, generate_subscripts(CASE WHEN len(p) > 1 THEN p ELSE s END, 1) AS i FROM b)
SELECT doc_id, CAST(i - 1 AS INT) AS ordinal, doc_id || '.span' || i AS span_id, sha256(regexp_replace(x, '\s+', ' ', 'g')) AS span_sha FROM u"""


def nearest_spans(spark, d):
    own = _turns(spark, d)
    first = own.filter("turn = 0").select("conv_id", F.lit("q").alias("object_id"), F.col("text").alias("hint"))
    rest = own.filter("turn > 0").select("conv_id", F.col("turn").alias("span_id"), F.col("text").alias("span"))
    return _rounded(evidence.nearest_spans(first, rest, "conv_id"), "score").select("conv_id", "rank", "span_id", "score")


NEAREST = """WITH q AS (SELECT conv_id, list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+')) AS t FROM conversations WHERE turn = 0), s AS (SELECT conv_id, turn, list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+')) AS w FROM conversations WHERE turn > 0),
j AS (SELECT q.conv_id, turn, len(list_intersect(t, w)) / len(t) AS score FROM q JOIN s ON q.conv_id = s.conv_id WHERE len(list_intersect(t, w)) > 0), r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY score DESC, turn) AS rank FROM j)
SELECT conv_id, CAST(rank AS INT) AS rank, turn AS span_id, round(score, 9) AS score FROM r WHERE rank <= 3"""


def _nodes(spark, d):
    own = table(spark, d, "customer")
    return own.select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 4 == 0, "claim").otherwise("dataset").alias("type"), F.when(F.col("c_custkey") % 3 == 0, F.array(F.col("c_nationkey"))).otherwise(F.array().cast("array<int>")).alias("spans"))


def graph_violations(spark, d):
    edges = table(spark, d, "orders").select(F.col("o_orderkey").alias("edge_id"), F.col("o_custkey").alias("source"), (F.col("o_custkey") + F.col("o_orderkey") % 97).alias("target"))
    known = table(spark, d, "nation").filter("n_nationkey < 20").select(F.col("n_nationkey").alias("span_id"))
    return evidence.graph_violations(_nodes(spark, d), edges, known)


VIOLATIONS = """SELECT 'ungrounded' AS kind, CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE c_custkey % 4 = 0 AND c_custkey % 3 <> 0
UNION ALL SELECT 'unknown_span', CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey % 3 = 0 AND c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_nationkey < 20)
UNION ALL SELECT 'duplicate_node', CAST(c_custkey AS VARCHAR) FROM customer GROUP BY c_custkey HAVING count(*) > 1
UNION ALL SELECT 'dangling_edge', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) OR o_custkey + o_orderkey % 97 NOT IN (SELECT c_custkey FROM customer)"""


def graph_merge(spark, d):
    nodes = _nodes(spark, d).select("id", "type")
    patch = nodes.filter("id % 7 = 0").select("id", F.lit("patched").alias("type"))
    merged = evidence.merged_nodes(nodes, nodes.filter("id % 5 = 0").select("id"), patch)
    edges = table(spark, d, "orders").select(F.col("o_custkey").alias("source"), F.col("o_orderstatus").alias("relation"), (F.col("o_custkey") + F.col("o_orderkey") % 13).alias("target"))
    out = evidence.merged_edges(edges.filter("relation <> 'P'"), edges.filter("relation = 'P'"), edges.filter("source % 11 = 0"), merged)
    sides = merged.select(F.lit("node").alias("kind"), F.col("id").alias("source"), F.col("type").alias("relation"), F.col("id").alias("target"))
    return sides.unionByName(out.select(F.lit("edge").alias("kind"), "source", "relation", "target"))


MERGE = """WITH n AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 7 = 0 THEN 'patched' WHEN c_custkey % 4 = 0 THEN 'claim' ELSE 'dataset' END AS type FROM customer WHERE c_custkey % 5 <> 0 OR c_custkey % 7 = 0)
SELECT 'node' AS kind, id AS source, type AS relation, id AS target FROM n UNION ALL
SELECT DISTINCT 'edge', o_custkey, o_orderstatus, o_custkey + o_orderkey % 13 FROM orders WHERE o_custkey % 11 <> 0 AND o_custkey IN (SELECT id FROM n) AND o_custkey + o_orderkey % 13 IN (SELECT id FROM n)"""


def active_calls(spark, d):
    own = table(spark, d, "events").withColumn("call", F.col("event_id") % 3)
    return evidence.active_calls(own, "user_id", "event_id", "event_type", ["call"], "click", ["view", "purchase"]).select("event_id", "user_id")


ACTIVE = """WITH e AS (SELECT *, event_id % 3 AS call FROM events) SELECT event_id, user_id FROM e s WHERE event_type = 'click'
  AND NOT EXISTS (SELECT 1 FROM e x WHERE x.user_id = s.user_id AND x.event_id > s.event_id AND x.event_type = 'click') AND NOT EXISTS (SELECT 1 FROM e x WHERE x.user_id = s.user_id AND x.event_id > s.event_id AND x.event_type IN ('view', 'purchase') AND x.call = s.call)"""


def quota(spark, d):
    own = table(spark, d, "events").withColumn("at", F.unix_timestamp(F.col("ts").cast("timestamp")))
    return evidence.over_quota(own.withColumn("units", F.col("event_id") % 5 + 1), "event_type", "at", "event_id", "units", 20, 86_400).select("event_id", "used")


QUOTA = """SELECT event_id, CAST(used AS BIGINT) AS used FROM (SELECT event_id, sum(event_id % 5 + 1) OVER (PARTITION BY event_type, floor(epoch(ts) / 86400) ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS used FROM events) WHERE used > 20"""


# Maintenance and caches.


def snapshots(spark, d):
    own = table(spark, d, "orders").select(F.col("o_orderkey").alias("snapshot_id"), F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("at"))
    return evidence.snapshots_to_expire(own, 2_000_000_000, 100, own.filter("snapshot_id % 1000 = 0").select("snapshot_id")).select("snapshot_id")


SNAPSHOTS = "SELECT snapshot_id FROM (SELECT o_orderkey AS snapshot_id, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn, epoch(o_orderdate) AS sec FROM orders) WHERE rn > 100 AND snapshot_id % 1000 <> 0 AND sec < 2000000000"


def orphans(spark, d):
    own = table(spark, d, "pages").select(F.concat("page_id", _pick([".parquet", ".avro", ".metadata.json", ".txt", ".puffin"], "page_id", 5)).alias("key"), (F.col("page_id") * 10).alias("modified"), "page_id")
    return evidence.orphan_files(own, own.filter("page_id % 3 = 0").select("key"), 1_500).select("key")


ORPHANS = "SELECT page_id || list_extract(['.parquet', '.avro', '.metadata.json', '.txt', '.puffin'], CAST(page_id % 5 + 1 AS INT)) AS key FROM pages WHERE page_id % 5 <> 3 AND page_id % 3 <> 0 AND page_id * 10 < 1500"


def quality_cache(spark, d):
    own = _docs(spark, d).select("doc_id", evidence.cache_key(F.lit("r1"), F.col("text")).alias("key"))
    cache = own.filter("doc_id % 2 = 0").groupBy("key").agg((F.min("doc_id") % 6).alias("score"), F.max("doc_id").alias("created_at"))
    return evidence.cached(own, evidence.trimmed_cache(cache)).select("doc_id", "key", "score")


CACHE = "WITH o AS (SELECT doc_id, sha256('r1' || chr(0) || text) AS key FROM documents), c AS (SELECT key, min(doc_id) % 6 AS score, max(doc_id) AS made FROM o WHERE doc_id % 2 = 0 GROUP BY key ORDER BY made DESC, key LIMIT 100000) SELECT o.doc_id, o.key, c.score FROM o LEFT JOIN c ON o.key = c.key"

def expired_pointers(spark, d):
    own = table(spark, d, "pages").select("page_id", F.col("url").alias("uri"))
    return evidence.without_expired(own, own.filter("page_id % 4 = 0")).select("page_id")


def first_seen(spark, d):
    own = table(spark, d, "pages").select("page_id", "url")
    archive = own.filter("page_id % 3 > 0").select("url", (F.col("page_id") * 7 % 1000).alias("seen_at"))
    return evidence.first_seen(own, archive).select("page_id", "first_seen_at")


def paper_texts(spark, d):
    """Conversations as papers: turns as sections and rows of a table, projected with their surrogate."""
    own = _turns(spark, d).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    sections = F.transform("t", lambda x: F.struct((x["turn"].cast("int") + 1).alias("level"), x["role"].alias("title"), x["text"].alias("text"), (x["turn"] % 3 != 2).alias("included")))
    tables = F.array(F.struct(F.lit("t1").alias("table_id"), F.lit("Turns").alias("caption"), F.transform("t", lambda x: F.array(x["role"], x["text"])).alias("rows")))
    figures = F.array().cast("array<struct<figure_id:string,figure_type:string,caption:string,alt_text:string,ocr_text:string,ocr_ok:boolean>>")
    extra = markup.surrogate(tables, F.array(F.lit("x^2")), figures)
    own = own.select("conv_id", sections.alias("s"), extra.alias("x"))
    return own.select("conv_id", F.md5(markup.paper_projection(F.lit("P"), F.col("s"), F.col("x"))).alias("text_md5"))


PAPERS = """WITH n AS (SELECT *, chr(10) AS nl, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i FROM conversations)
SELECT conv_id, md5('# P' || coalesce(string_agg(nl || nl || repeat('#', least(6, greatest(2, turn + 1))) || ' ' || role || nl || rtrim(text, ' ' || nl), '' ORDER BY i) FILTER (WHERE turn % 3 <> 2 AND trim(text, ' ' || nl) <> ''), '')
  || chr(10) || chr(10) || '[TABLE]' || chr(10) || 'ID: t1' || chr(10) || 'Caption: Turns' || chr(10) || string_agg(role || ' | ' || substring(text, 1, 400), chr(10) ORDER BY i) FILTER (WHERE i <= 40) || chr(10) || '[/TABLE]' || chr(10) || chr(10) || '[EQUATION] x^2 [/EQUATION]') AS text_md5 FROM n GROUP BY conv_id"""

QUERIES = {
    "expired_pointers": expired_pointers,
    "first_seen": first_seen,
    "paper_texts": paper_texts,
    "card_gate": card_gate,
    "section_types": section_types,
    "section_roles": section_roles,
    "body_projection": body_projection,
    "section_quality": section_quality,
    "section_hints": lambda s, d: evidence.section_hints(_scored(s, d), "conv_id", "turn", "role", "score"),
    "paper_scores": paper_scores,
    "prose_scores": prose_scores,
    "source_policies": source_policies,
    "curate_documents": curate_documents,
    "validity_intervals": validity_intervals,
    "perplexity_normalized": perplexity_text,
    "ordinal_heads": ordinal_heads,
    "stable_spans": stable_spans,
    "nearest_spans": nearest_spans,
    "find_text": lambda s, d: evidence.find(_turns(s, d), ["conv_id", "turn"], "text", "the"),
    "lexical_search": lambda s, d: serving.lexical_search(_docs(s, d), "doc_id", "text", "the water of time").select("doc_id", "score"),
    "graph_violations": graph_violations,
    "graph_merge": graph_merge,
    "active_calls": active_calls,
    "over_quota": quota,
    "snapshots_to_expire": snapshots,
    "orphan_files": orphans,
    "quality_cache": quality_cache,
    "hash_sample": lambda s, d: evidence.hash_sample(_docs(s, d), _docs(s, d), ["doc_id"], 50).select("doc_id", "source"),
    "catalogue_since": lambda s, d: serving.new_since(table(s, d, "orders").withColumn("at", F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))), "at", "o_orderkey", 800_000_000, [1, 2]).select("o_orderkey"),
}

ORACLE_SQL = {
    "expired_pointers": "SELECT page_id FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 4 = 0)",
    "first_seen": "SELECT p.page_id, a.seen AS first_seen_at FROM pages p LEFT JOIN (SELECT url, min(page_id * 7 % 1000) AS seen FROM pages WHERE page_id % 3 > 0 GROUP BY 1) a ON p.url = a.url",
    "paper_texts": PAPERS,
    "card_gate": CARD,
    "section_types": SECTION_TYPES,
    "section_roles": f"WITH {ROLED} SELECT conv_id, turn, section_role, section_role IN ('references', 'acknowledgements') OR title = 'Ethics statement' AS excluded FROM r",
    "body_projection": BODY,
    "section_quality": SECTION_QUALITY,
    "section_hints": f"WITH {SCORED}, b AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id, role ORDER BY score DESC, turn) AS k, score, turn FROM s WHERE score >= 4), r AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY score DESC, turn) AS rank FROM b WHERE k = 1) SELECT conv_id, CAST(rank AS INT) AS rank, role FROM r WHERE rank <= 3",
    "paper_scores": PAPER,
    "prose_scores": PROSE,
    "source_policies": POLICIES,
    "validity_intervals": VALIDITY,
    "perplexity_normalized": _normal_sql(),
    "ordinal_heads": ORDINAL,
    "stable_spans": SPANS,
    "nearest_spans": NEAREST,
    "lexical_search": "WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM documents), h AS (SELECT doc_id, len(w) AS n, len(list_intersect(list_distinct(w), ['of', 'the', 'time', 'water'])) AS k FROM w) SELECT doc_id, round(k / 4 + 1 / (1 + ln(1 + n)), 8) AS score FROM h WHERE k > 0 ORDER BY score DESC, doc_id LIMIT 10",
    "graph_violations": VIOLATIONS,
    "graph_merge": MERGE,
    "active_calls": ACTIVE,
    "over_quota": QUOTA,
    "snapshots_to_expire": SNAPSHOTS,
    "orphan_files": ORPHANS,
    "quality_cache": CACHE,
    "hash_sample": "WITH c AS (SELECT doc_id FROM documents ORDER BY sha256(CAST(doc_id AS VARCHAR)), doc_id LIMIT 50) SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM c) AND trim(text) <> ''",
    "catalogue_since": "SELECT o_orderkey FROM orders WHERE epoch(o_orderdate) > 800000000 OR (epoch(o_orderdate) = 800000000 AND o_orderkey NOT IN (1, 2))",
}
