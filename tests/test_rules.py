"""Validity, source policies, templates and routes on literal rows."""

from pyspark.sql import functions as F

from gristmill.functions import routing as R
from gristmill.functions import validity as V


def text_of(t):
    return F.date_format(F.to_utc_timestamp(t, F.current_timezone()), "yyyy-MM-dd HH:mm:ss")


def test_times(spark):
    rows = [("2026-06-12T08:00:00Z", "2026-06-12 08:00:00"), ("2026-06-12T08:00:00+02:00", "2026-06-12 06:00:00"), ("2026-06-12T08:00", "2026-06-12 08:00:00"), (" 2026-06-12 ", "2026-06-12 00:00:00"), ("Wed, 12 Jun 2026 08:00:00 GMT", "2026-06-12 08:00:00"), ("12 Jun 2026 08:00:00 +0100", "2026-06-12 07:00:00"), ("2026", None), ("soon", None), ("2026-13-40", None), ("", None), (None, None)]
    df = spark.createDataFrame(rows, "raw string, want string").withColumn("got", text_of(V.parse_time(F.col("raw"))))
    assert [(r.raw, r.got) for r in df.collect()] == rows


def test_validity(spark):
    rows = [(None, '{"datePublished": "bad"} {"datepublished" : "2026-02-01"}', "<lastmod>2026-03-01</lastmod>", None), ("2026-05-01", "", "", "2026-04-01"), (None, "", "<LASTMOD>x</LASTMOD><lastmod>2026-03-01</lastmod>", "2026-03-02"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "modified string, html string, xml string, gone string")
    times = {"http_last_modified": V.parse_time(F.col("modified")), "schema_org_date_published": V.published(F.col("html")), "sitemap_lastmod": V.sitemap_lastmod(F.col("xml")), "fetched_at": V.parse_time(F.lit("2026-07-01"))}
    got = df.select(V.validity(times, [V.parse_time(F.col("gone")), F.lit(None).cast("timestamp")]).alias("v")).select(text_of("v.valid_from"), text_of("v.valid_to"), "v.valid_from_source").collect()
    day = lambda x: f"{x} 00:00:00"
    assert [tuple(r) for r in got] == [(day("2026-02-01"), None, "schema_org_date_published"), (day("2026-05-01"), None, "http_last_modified"), (day("2026-03-01"), day("2026-03-02"), "sitemap_lastmod"), (day("2026-07-01"), None, "fetched_at")]


def test_source_policy(spark):
    rows = [("arxiv", "metadata", "x", "discovery_metadata"), ("HF-models", "html", "x", "hf_model_card"), ("f", "web", "hf-dataset-card-v1", "hf_dataset_card"), ("cluster-smoke", "pdf", "x", "web_prose"), ("f", "latex", "x", "scientific_paper"), ("oai-ArXiv-cs", "html", "x", "scientific_paper"), ("blog", "html", "x", "web_prose")]
    df = spark.createDataFrame(rows, "feed string, format string, pipeline string, want string").withColumn("p", R.source_policy(F.col("feed"), F.col("format"), F.col("pipeline")))
    got = df.select("want", "p.family", "p.kenlm_mode").collect()
    assert all(r.want == r.family for r in got)
    assert [r.kenlm_mode for r in got] == ["off"] * 6 + ["gate"]


def test_templates(spark):
    blank = ("A", "The conclusion\n goes here")
    rows = [("Bare Demo of X", "Replace  this\ntext", [], True), ("X", "replace this text", [], False), ("X", "Starter file; IEEEtran.cls", [], True), (None, None, [blank, blank], True), ("Sample paper", "", [blank], False), (None, None, None, False)]
    df = spark.createDataFrame(rows, "title string, text string, segments array<struct<title:string,text:string>>, want boolean")
    assert all(r[0] == r.want for r in df.select(R.is_publication_template(F.col("title"), F.col("text"), F.col("segments")), "want").collect())


def test_routes(spark):
    rows = [
        ([], 0.6, True, None, "x", "pretrain_and_posttrain", True, "posttrain_candidate", "none"),
        ([], 0.5, True, None, "x", "posttrain_transform_only", True, "posttrain_candidate", "none"),
        ([], 0.6, False, None, "x", None, True, "pretrain", "none"),
        (["insufficient_scientific_body"], 0.6, True, "s3://b/k", "x|curation-retry=1", None, True, "retry", "none"),
        (["insufficient_scientific_body"], 0.6, True, "s3://b/k", "x|curation-retry=2", None, True, "quarantine", "none"),
        (["insufficient_scientific_body"], 0.6, True, None, "x", None, True, "quarantine", "none"),
        (["incomplete_scientific_extraction"], 0.6, True, "s3://b/k", "x", None, False, "quarantine", "none"),
        (["incomplete_scientific_extraction", "pii_detected"], 0.6, True, "s3://b/k", "x", "posttrain_transform_only", True, "quarantine", "body_quarantine"),
    ]
    df = spark.createDataFrame(rows, "rejects array<string>, reasoning double, eligible boolean, uri string, pipeline string, usage string, url_ok boolean, want string, action string")
    c = F.col
    route = R.purpose_route(R.bounded_route(R.base_route(c("rejects"), c("reasoning"), c("eligible")), c("uri"), c("pipeline"), c("url_ok")), c("usage"))
    got = df.select(route.alias("route"), "want", R.pii_action(c("rejects"), F.lit(False), F.lit(False)).alias("did"), "action").collect()
    assert [(r.route, r.did) for r in got] == [(r.want, r.action) for r in got]


def test_tags_and_perplexity(spark):
    rows = [("A Survey of Systems", ["methods"], 3, 0, 0, ["mathematical_reasoning", "methods_and_procedures", "survey_synthesis", "systems_implementation"]), ("Corpus", ["results"], 0, 0, 2, ["empirical_evidence", "benchmark_or_dataset", "visual_evidence"]), ("x", [], 0, 0, 0, ["general_scientific"])]
    df = spark.createDataFrame(rows, "titles string, roles array<string>, e int, t int, f int, want array<string>")
    assert all(r[0] == r.want for r in df.select(R.content_tags(*[F.col(x) for x in ("titles", "roles", "e", "t", "f")]), "want").collect())
    gate = spark.createDataFrame([("gate", ["tail", "tail", "tail", "head", None], 2001.0, True), ("gate", [], 2001.0, True), ("gate", ["head"], 9e9, False), ("gate", ["tail"], 2000.0, False), ("off", ["tail"], 9e9, False)], "m string, b array<string>, p double, want boolean")
    assert all(r[0] == r.want for r in gate.select(R.fails_perplexity(F.col("m"), F.col("b"), F.col("p")), "want").collect())
