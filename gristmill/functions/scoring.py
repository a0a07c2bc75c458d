"""Section roles, model inputs, structure and reasoning scores, rejection reasons and projections as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions.text import SPACE

#: Section types of papers and of cards with the terms that earn them, first match first.
PAPER_TYPES = {
    "abstract": ["abstract"],
    "introduction": ["introduction", "motivation"],
    "background": ["background", "related work", "preliminar"],
    "methods": ["method", "approach", "architecture", "algorithm", "model"],
    "results": ["result", "experiment", "evaluation", "ablation", "analysis"],
    "discussion": ["discussion"],
    "limitations": ["limitation", "ethic", "broader impact"],
    "conclusion": ["conclusion"],
    "appendix": ["appendix", "supplement"],
}
CARD_TYPES = {
    "summary": ["summary", "description", "overview", "model card", "dataset card"],
    "architecture": ["architecture", "model details"],
    "training": ["training", "fine-tun"],
    "evaluation": ["evaluation", "results", "benchmark", "performance"],
    "usage": ["usage", "use", "inference", "how to"],
    "data": ["dataset structure", "data fields", "data instances", "collection"],
    "limitations": ["limitation", "bias", "risk", "out-of-scope"],
}
#: Roles of a paper's sections by pattern, first match first.
ROLES = {
    "abstract": "^abstract$",
    "references": r"\b(references|bibliography)\b",
    "appendix": "^appendix",
    "acknowledgements": "acknowledg|author contribution|funding|conflict of interest|declaration",
    "introduction": "introduction",
    "background": "background|related work|preliminar",
    "methods": "method|approach|experimental setup|materials|implementation",
    "results": "result|evaluation|experiment|analysis|finding",
    "discussion": "discussion",
    "conclusion": "conclusion|summary|future work",
    "limitations": "limitation|threats to validity",
}
ADMINISTRATIVE = "ethics statement|author contribution|conflict of interest|declaration"
EXCLUDED_ROLES = ("metadata", "references", "acknowledgements")
PAPER_FEED = "arxiv-html-fetcher"
#: Marks that the perplexity model's normalisation replaces (the full-width one is meant to become a quote).
MARKS = {"，": ",", "。": ".", "、": ",", "„": '"', "”": '"', "“": '"', "«": '"', "»": '"', "１": '"', "」": '"', "「": '"', "《": '"', "》": '"', "´": "'", "∶": ":", "：": ":", "？": "?", "！": "!", "（": "(", "）": ")", "；": ";", "–": "-", "—": " - ", "．": ". ", "～": "~", "’": "'", "…": "...", "━": "-", "〈": "<", "〉": ">", "【": "[", "】": "]", "％": "%", "►": "-"}


def _first_type(low: Column, table: dict[str, list[str]]) -> Column:
    out = None
    for name, terms in table.items():
        found = F.lit(False)
        for t in terms:
            found = found | low.contains(t)
        out = F.when(found, name) if out is None else out.when(found, name)
    return out.otherwise("other")


def section_type(title: Column, feed: Column) -> Column:
    low = F.lower(title)
    return F.when(feed == PAPER_FEED, _first_type(low, PAPER_TYPES)).otherwise(_first_type(low, CARD_TYPES))


def model_input(title: Column, kind: Column, text: Column, feed: Column) -> Column:
    family = F.when(feed == PAPER_FEED, "arxiv").otherwise("hf")
    return F.concat(F.lit("[SOURCE="), family, F.lit("] [SECTION_TYPE="), kind, F.lit("] [SECTION_TITLE="), title, F.lit("]\n"), text)


def section_role(title: Column) -> Column:
    """The role of a paper's section by its title, without its number."""
    bare = F.regexp_replace(title, r"(?iU)^(?:appendix\s+)?[A-Z]?\d+(?:\.\d+)*\.?\s+", "")
    low = F.regexp_replace(F.lower(bare), "^[ .:-]+|[ .:-]+$", "")
    out = None
    for role, pattern in ROLES.items():
        out = F.when(low.rlike(pattern), role) if out is None else out.when(low.rlike(pattern), role)
    return out.otherwise("other")


def is_excluded(role: Column, title: Column) -> Column:
    """Whether a section stays out of training texts."""
    return role.isin(*EXCLUDED_ROLES) | F.lower(title).rlike(ADMINISTRATIVE)


def body_start(roles: Column) -> Column:
    """Index of the first abstract, else of the first introduction, else 0."""
    at = lambda role: F.array_position(roles, role)
    return (F.when(at("abstract") > 0, at("abstract")).when(at("introduction") > 0, at("introduction")).otherwise(1) - 1).cast("int")


def source_segments(segments: Column, roles: Column, scientific: Column, title: Column, text: Column) -> Column:
    """The segments from the body's start on (papers); one that holds the whole text if there is none. Segments: (title, text)."""
    kept = F.when(scientific & (F.size(segments) > 0), F.slice(segments, body_start(roles) + 1, F.greatest(F.size(segments), F.lit(1)))).otherwise(segments)
    whole = F.array(F.struct(F.coalesce(F.nullif(title, F.lit("")), F.lit("Document")).alias("title"), text.alias("text")))
    return F.when(F.size(kept) > 0, kept).otherwise(whole)


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{SPACE}|{SPACE}$", "")


def training_projection(title: Column, segments: Column, structured: Column) -> Column:
    """Title, headed sections and structured text as one text; the first section has no heading if it repeats the title."""
    named = F.coalesce(title, F.lit("")) != ""
    same = lambda s: F.coalesce(F.lower(strip(s["title"])) == F.lower(strip(title)), F.lit(False))
    block = lambda s, i: F.when((i == 0) & same(s), strip(s["text"])).otherwise(F.concat(F.lit("## "), s["title"], F.lit("\n"), strip(s["text"])))
    blocks = F.concat(F.array(F.when(named, F.concat(F.lit("# "), title))), F.transform(segments, block), F.array(strip(F.coalesce(structured, F.lit("")))))
    return strip(F.array_join(F.filter(blocks, lambda b: strip(b) != ""), "\n\n"))


def normalized_for_perplexity(text: Column) -> Column:
    """Digits become 0, marks their plain forms; control characters go."""
    out = F.regexp_replace(strip(text), r"(?U)\d", "0")
    single = {k: v for k, v in MARKS.items() if len(v) == 1}
    # Before the digits' rule the full-width one is a digit as well, so it is a 0 by now.
    out = F.translate(out, "".join(single), "".join(single.values()))
    for k, v in MARKS.items():
        if len(v) > 1:
            out = F.replace(out, F.lit(k), F.lit(v))
    return F.regexp_replace(out, r"[\x00-\x1f\x7f-\x9f]", "")


def _clamped(x: Column, top: float) -> Column:
    return F.least(F.greatest(x, F.lit(0.0)), F.lit(top))


def _points(test: Column, yes: float, no: float = 0.0) -> Column:
    return F.when(test, F.lit(yes)).otherwise(F.lit(no))


def paper_scores(title: Column, roles: Column, included: Column, words: Column, equations: Column, tables: Column, figures: Column, citations: Column, warnings: Column, quality: Column) -> Column:
    """struct(completeness, structure, reasoning) of a paper; null ``quality`` means that no quality score applies."""
    has = lambda *own: F.arrays_overlap(roles, F.array(*map(F.lit, own)))
    methods, results = has("methods"), has("results", "discussion", "conclusion")
    kinds = sum(((n > 0).cast("int") for n in (equations, tables, figures)), F.lit(0))
    parts = [
        _points(F.coalesce(title, F.lit("")) != "", 0.12),
        _points(has("abstract"), 0.18),
        F.when(included >= 3, 0.20).otherwise(_points(F.size(roles) > 0, 0.10)),
        F.when(words >= 500, 0.20).otherwise(_points(words >= 100, 0.10)),
        _points(kinds > 0, 0.12),
        _points(citations > 0, 0.08),
        _points(warnings == 0, 0.10, 0.03),
    ]
    completeness = F.least(sum(parts, F.lit(0.0)), F.lit(1.0))
    cover = sum((x.cast("int") for x in (has("abstract"), methods, results)), F.lit(0)) / 3
    structure = _clamped(5.0 * (0.55 * completeness + 0.25 * cover + 0.20 * kinds / 3), 5.0)
    evidence = _points(methods, 0.22) + _points(results, 0.24) + _points(equations > 0, 0.14) + _points(tables > 0, 0.12) + _points(figures > 0, 0.08)
    reasoning = _clamped(evidence + 0.10 * structure / 5 + F.coalesce(0.10 * quality / 5, F.lit(0.0)), 1.0)
    return F.struct(completeness.alias("completeness"), structure.alias("structure"), reasoning.alias("reasoning"))


def prose_scores(title: Column, text: Column, words: Column, warnings: Column, trains: Column, quality: Column) -> Column:
    """struct(completeness, structure, reasoning) of any other text; reasoning is 0 for discovery metadata."""
    filled = _points(F.coalesce(title, F.lit("")) != "", 0.15) + 0.55 * F.least(words / 500, F.lit(1.0)) + _points(warnings == 0, 0.20) + _points(strip(text) != "", 0.10)
    completeness = F.least(filled, F.lit(1.0))
    reasoning = F.when(trains, F.least(0.10 + F.coalesce(0.15 * quality / 5, F.lit(0.0)) + 0.20 * completeness, F.lit(0.45))).otherwise(0.0)
    return F.struct(completeness.alias("completeness"), _clamped(5.0 * completeness, 5.0).alias("structure"), reasoning.alias("reasoning"))


def reject_reasons(f: dict[str, Column]) -> Column:
    """Reasons of rejection in order, each once, from Boolean columns.

    ``short`` hides the word and sentence filters; ``web`` says whether they and the brace filter apply.
    """
    no = F.lit(False)
    is_ = lambda k: F.coalesce(f.get(k, no), no)
    long_web = is_("web") & ~is_("short")
    named = F.when(is_("scientific"), "insufficient_scientific_body").otherwise("insufficient_body")
    return F.array_distinct(F.array_compact(F.array(
        F.when(is_("low_quality"), "low_quality_score"), F.when(is_("metadata"), "metadata_only"), F.when(is_("short"), named), F.when(is_("pii"), "pii_detected"),
        F.when(is_("all_sections_removed"), "c4_nopunc_filter"), F.when(long_web & is_("fails_gopher"), "gopher_filter"), F.when(long_web & is_("fails_c4"), "c4_nopunc_filter"),
        F.when(is_("perplexed"), "high_perplexity"), F.when(is_("bad_card"), "hf_card_quality_filter"), F.when(is_("foreign"), "language_filter"), F.when(is_("licence"), "license_excluded"),
        F.when(is_("scientific") & is_("incomplete"), "incomplete_scientific_extraction"), F.when(is_("scientific") & is_("template"), "document_template"), F.when(is_("near_duplicate"), "near_duplicate"),
    )))


def ranking_score(active: Column, suitability: Column, signals: list[Column], source_quality: Column, diagnostic: Column) -> Column:
    """A candidate's rank: the learned suitability of five, else the mean of its signals (with source quality unless only diagnostic)."""
    total, n = sum(signals, F.lit(0.0)), len(signals)
    mean = F.when(diagnostic, total / n).otherwise((total + source_quality / 5) / (n + 1))
    return F.when(active & suitability.isNotNull(), suitability / 5).otherwise(mean)


def family_id(paper: Column) -> Column:
    return F.regexp_replace(paper, r"v\d+$", "")


def spans(text: Column) -> Column:
    """Paragraphs of a text, or its sentences if it has only one; white space collapsed, blanks dropped."""
    blocks = F.filter(F.transform(F.split(text, r"\n\s*\n"), strip), lambda b: b != "")
    sentences = F.filter(F.transform(F.split(text, r"(?U)(?<=[.!?])\s+(?=[A-Z])"), strip), lambda b: b != "")
    return F.transform(F.when(F.size(blocks) > 1, blocks).otherwise(sentences), lambda s: F.regexp_replace(s, SPACE, " "))
