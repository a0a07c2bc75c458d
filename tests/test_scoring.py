"""Cards, sections, projections, predicates and evidence on literal rows."""

from pyspark.sql import functions as F

from gristmill.functions import cards, markup, scoring
from gristmill.operators import evidence


def test_card_gate(spark):
    long = "The architecture has 24 layers. " + "It was built with care and patience. " * 40
    rows = [
        ("model", "x", "This model has 7 billion parameters; training used 3 epochs.", ["Usage"], True, ["substantive_technical_card"]),
        ("model", None, "More information needed", ["Usage"], False, ["template_boilerplate"]),
        ("model", None, "", [], False, ["stub_checkpoint_upload"]),
        ("model", "train.py", "fusion strategy, task head, initialization", [], False, ["synthetic_script_card"]),
        ("dataset", None, "Available model files", ["Training data"], False, ["minimal_artifact_listing", "wrong_repository_type"]),
        ("dataset", None, "join our discord", [], False, ["marketing"]),
        ("model", None, "hello", [], False, ["insufficient_card_documentation"]),
        ("model", None, "Architecture of 12 layers, training of 3 epochs, evaluation accuracy 91.2", [], True, ["dense_scientific_card"]),
        ("model", None, long + " See org/name.", [], True, ["substantive_technical_card"]),
        ("model", None, None, None, False, ["stub_checkpoint_upload"]),
    ]
    df = spark.createDataFrame(rows, "kind string, title string, text string, titles array<string>, want boolean, cats array<string>")
    df = df.withColumn("titles", F.coalesce("titles", F.array().cast("array<string>")))
    for r in cards.assess(df, "kind", "title", "text", "titles").collect():
        assert (r.accepted, r.categories) == (r.want, r.cats), r
    flags = spark.createDataFrame([("  TODO: write", True), ("", False), (None, False), ("done", False)], "t string, want boolean")
    assert all(r[0] == r.want for r in flags.select(cards.is_placeholder(F.col("t")), "want").collect())


def test_roles_and_body(spark):
    rows = [("Abstract:", "abstract"), ("2.1 Related Work", "background"), ("Appendix B", "appendix"), ("Appendix A1 Proofs", "other"), ("IV", "other"), ("Author Contributions", "acknowledgements"), ("Threats to validity", "limitations"), ("", "other")]
    df = spark.createDataFrame(rows, "t string, want string")
    assert [r[0] for r in df.select(scoring.section_role(F.col("t"))).collect()] == [w for _, w in rows]
    df = spark.createDataFrame([(["other", "introduction", "abstract"], 2), (["other", "introduction"], 1), (["other"], 0), ([], 0)], "r array<string>, want int")
    assert all(r[0] == r.want for r in df.select(scoring.body_start(F.col("r")), "want").collect())


def test_projection(spark):
    rows = [("T", [("t ", " a "), ("B", "b")], "", "# T\n\na\n\n## B\nb"), (None, [("T", "a")], " s ", "## T\na\n\ns"), ("", [], None, "")]
    df = spark.createDataFrame(rows, "title string, seg array<struct<title:string,text:string>>, st string, want string")
    assert all(r[0] == r.want for r in df.select(scoring.training_projection(F.col("title"), F.col("seg"), F.col("st")), "want").collect())


def test_reasons(spark):
    t = F.lit(True)
    one = spark.range(1)
    got = one.select(scoring.reject_reasons({"short": t, "web": t, "fails_gopher": t, "fails_c4": t, "metadata": t}).alias("a"), scoring.reject_reasons({"web": t, "fails_c4": t, "all_sections_removed": t, "near_duplicate": t}).alias("b"), scoring.reject_reasons({}).alias("c")).first()
    assert (got.a, got.b, got.c) == (["metadata_only", "insufficient_body"], ["c4_nopunc_filter", "near_duplicate"], [])


def test_normalisation_and_spans(spark):
    r = spark.createDataFrame([(" «1９»—…\x07 ", "One. Two! three\nB", "a\n \nb  c")], "n string, s string, p string")
    r = r.select(scoring.normalized_for_perplexity(F.col("n")).alias("n"), scoring.spans(F.col("s")).alias("s"), scoring.spans(F.col("p")).alias("p"), scoring.family_id(F.lit("2401.1v12")).alias("f")).first()
    assert (r.n, r.s, r.p, r.f) == ('"00" - ...', ["One.", "Two! three B"], ["a", "b c"], "2401.1")


def test_find(spark):
    df = spark.createDataFrame([(1, "aXx.axx"), (2, "none"), (3, "xxx")], "k long, t string")
    assert [(r.k, r.start, r.end, r.context) for r in evidence.find(df, "k", "t", "xx", around=1).collect()] == [(1, 1, 3, "aXx."), (1, 5, 7, "axx"), (3, 0, 2, "xxx")]
    assert evidence.find(df, "k", "t", "xx", hits=1).count() == 1


def test_predicates(spark):
    a = lambda *x: F.array(*map(F.lit, x)).cast("array<string>")
    one = spark.range(1)
    value = lambda p: tuple(one.select(p[0], p[1].cast("double")).first())
    assert value(evidence.covers(a("a", "b"), a("a"))) == (False, 0.5) and value(evidence.covers(a(), a("a"))) == (True, 1.0) and value(evidence.covers(a(), a("a"), 0.0)) == (False, 0.0)
    assert value(evidence.avoids(a("x"), a("a"))) == (True, 1.0) and value(evidence.allowed(a(), a("a"))) == (False, 0.0) and value(evidence.allowed(a("a", "b"), a("a"))) == (False, 0.5)
    assert value(evidence.identifies(a("a"), a(), a("a", "b"))) == (False, 0.5)
    n = lambda *x: F.array(*map(F.lit, x)).cast("array<double>")
    assert value(evidence.within(n(9.0, 11.5), F.lit(10.0), F.lit(1.0))) == (True, 1.0) and value(evidence.within(n(15.0), F.lit(10.0), F.lit(1.0))) == (False, 0.5) and value(evidence.within(n(), F.lit(10.0), F.lit(1.0))) == (False, 0.0)
    assert value(evidence.ordered(a("a", "b", "c"), [("a", "c"), ("c", "b")])) == (False, 0.5) and value(evidence.ordered(a("a"), [])) == (False, 0.0)
    soft, hard = (F.lit(False), F.lit(0.5), 1.0, False), (F.lit(False), F.lit(1.0), 1.0, True)
    assert evidence.verified(one, {"s": soft, "t": (F.lit(True), F.lit(1.0), 1.0, True)}).first()[1:] == (0.75, False)
    assert evidence.verified(one, {"h": hard}).first()[1:] == (0.0, False)


def test_markup(spark):
    tex = "\\documentclass[a]{article}% note\n\\title{T}\\begin{abstract}A 5\\% rise\\end{abstract}\\section*{One}x\\subsection{Two}$$ a $$ \\[b\\] $$a$$\\begin{equation}c\nd\\end{equation}\\bibliography{r}\n"
    r = spark.createDataFrame([(tex, "ABSTRACT: short\n2. Methods\nIV. Results:\nmethods we use")], "x string, p string").select(markup.latex_headings(F.col("x")).alias("h"), markup.equations(F.col("x")).alias("e"), markup.page_headings(F.col("p")).alias("p")).first()
    assert "## Abstract\nA 5\\% rise" in r.h and "\n## One\nx\n### Two\n" in r.h and "## References" in r.h and "note" not in r.h and "article" not in r.h
    assert r.e == ["a", "b", "c\nd"]
    assert r.p == "\n## Abstract\n\nshort\n\n## 2. Methods\n\n\n## IV. Results:\n\nmethods we use"
    figures = [("f", "chart", "C", None, "secret", False), ("g", "plot", None, "A", "seen", True)]
    df = spark.createDataFrame([([("t", None, [["a" * 500, "b"]])], ["q", ""], figures)], "t array<struct<table_id:string,caption:string,rows:array<array<string>>>>, e array<string>, f array<struct<figure_id:string,figure_type:string,caption:string,alt_text:string,ocr_text:string,ocr_ok:boolean>>")
    got = df.select(markup.surrogate(F.col("t"), F.col("e"), F.col("f"))).first()[0]
    assert got == f"[TABLE]\nID: t\n{'a' * 400} | b\n[/TABLE]\n\n[EQUATION] q [/EQUATION]\n\n[FIGURE] ID: f Type: chart Caption: C [/FIGURE].\n\n[FIGURE] ID: g Type: plot Alt text: A Visible text: seen [/FIGURE]."


def test_migration_and_pointers(spark):
    old = spark.createDataFrame([(None, 2.0, 3.0, 7), (1.0, 2.0, 3.0, 8), (None, None, 3.0, 9)], "edu_score double, finepdfs_edu_score double, quality_score double, row_id long")
    got = markup.migrated(old)
    assert sorted(got.columns) == ["_row_id", "quality_score", "source_quality_score"] and [r.source_quality_score for r in got.orderBy("_row_id").collect()] == [2.0, 1.0, 3.0]
    dead = spark.createDataFrame([("a",)], "uri string")
    batch = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "uri string")
    assert evidence.without_expired(batch, dead).count() == 3 and evidence.record_expired(dead, batch.filter("uri is not null")).count() == 1
