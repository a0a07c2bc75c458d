"""Source policies, rejection rules and routes as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions.text import is_filler, word_count

#: Family, training_text, language_gate, web_heuristic_gate and kenlm_mode of each source policy.
POLICIES = {
    "metadata-discovery-only": ("discovery_metadata", False, False, False, "off"),
    "hf-model-card-source-modernbert": ("hf_model_card", True, True, False, "off"),
    "hf-dataset-card-source-modernbert": ("hf_dataset_card", True, True, False, "off"),
    "technical-docs-source-modernbert": ("web_prose", True, True, False, "off"),
    "scientific-source-modernbert": ("scientific_paper", True, True, False, "off"),
    "web-source-modernbert": ("web_prose", True, True, True, "gate"),
}
#: Phrases that templates leave behind, and those that mark a section as a placeholder.
TEMPLATE_TITLE = r"(?i)\b(?:bare demo of|conference paper template|journal paper template|sample paper)\b"
PLACEHOLDERS = ("subsection text here", "subsubsection text here", "the conclusion goes here")
TEMPLATE_PHRASES = ("starter file", *PLACEHOLDERS, "replace this text", "ieeetran.cls", "template instructions")
#: Tag and the terms in titles that earn it.
TITLE_TAGS = {
    "benchmark_or_dataset": "benchmark|dataset|corpus|evaluation",
    "survey_synthesis": "survey|review|overview",
    "systems_implementation": "system|pipeline|architecture|infrastructure",
}
RETRYABLE = ("insufficient_scientific_body", "incomplete_scientific_extraction")
POSTTRAIN_REASONING = 0.55
MAX_RETRIES = 2


def source_policy(feed: Column, fmt: Column, pipeline: Column) -> Column:
    """The policy of a record as a struct; a declared format goes before names."""
    feed, pipeline = F.lower(feed), F.lower(pipeline)

    def policy(name: str) -> Column:
        fields = ("family", "training_text", "language_gate", "web_heuristic_gate", "kenlm_mode")
        return F.struct(F.lit(name).alias("policy_id"), *[F.lit(v).alias(f) for f, v in zip(fields, POLICIES[name], strict=True)])

    paper = fmt.isin("pdf", "latex", "markdown") | ((fmt == "html") & (feed.contains("arxiv") | pipeline.contains("arxiv")))
    return (
        F.when(fmt == "metadata", policy("metadata-discovery-only"))
        .when(pipeline.contains("hf-model-card") | (feed == "hf-models"), policy("hf-model-card-source-modernbert"))
        .when(pipeline.contains("hf-dataset-card") | (feed == "hf-datasets"), policy("hf-dataset-card-source-modernbert"))
        .when(feed == "cluster-smoke", policy("technical-docs-source-modernbert"))
        .when(paper, policy("scientific-source-modernbert"))
        .otherwise(policy("web-source-modernbert"))
    )


def _plain(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"(?U)\s+", " "))


def _hits(text: Column, phrases: tuple[str, ...]) -> Column:
    return sum((text.contains(p).cast("int") for p in phrases), F.lit(0))


def is_publication_template(title: Column, text: Column, segments: Column) -> Column:
    """Whether a paper is an authors' template: by title and phrase, by two phrases, or by two placeholder sections (title, text)."""
    found = _hits(_plain(text), TEMPLATE_PHRASES)
    blanks = F.size(F.filter(segments, lambda s: _hits(_plain(F.concat_ws(" ", s["title"], s["text"])), PLACEHOLDERS) > 0))
    named = F.coalesce(title, F.lit("")).rlike(TEMPLATE_TITLE)
    return (named & (found >= 1)) | (found >= 2) | (F.coalesce(blanks, F.lit(0)) >= 2)


def fails_perplexity(mode: Column, buckets: Column, perplexity: Column) -> Column:
    """Whether the perplexity gate rejects: three quarters of the measured buckets are tails and the median is over 2000."""
    measured = F.filter(buckets, lambda b: b.isNotNull())
    tails = F.when(F.size(measured) > 0, F.size(F.filter(measured, lambda b: b == "tail")) / F.size(measured)).otherwise(1.0)
    return (mode == "gate") & (tails >= 0.75) & (perplexity > 2000)


def content_tags(titles: Column, roles: Column, equations: Column, tables: Column, figures: Column) -> Column:
    """Tags by rule, in their order; `general_scientific` if none applies. ``titles`` holds all titles in one string."""
    low = F.lower(titles)
    shown = [F.when(low.rlike(terms), tag) for tag, terms in TITLE_TAGS.items()]
    tags = F.array_compact(F.array(
        F.when(equations >= 3, "mathematical_reasoning"),
        F.when(F.arrays_overlap(roles, F.array(F.lit("results"), F.lit("discussion"))) | (tables > 0) | (figures > 0), "empirical_evidence"),
        F.when(F.array_contains(roles, "methods"), "methods_and_procedures"),
        *shown,
        F.when(figures > 0, "visual_evidence"),
    ))
    return F.when(F.size(tags) > 0, tags).otherwise(F.array(F.lit("general_scientific")))


def base_route(rejects: Column, reasoning: Column, posttrain_eligible: Column) -> Column:
    """quarantine, retry, posttrain_candidate or pretrain by the reasons of rejection and the reasoning score."""
    blocked = F.exists(rejects, lambda r: ~r.isin(*RETRYABLE))
    ready = (reasoning >= POSTTRAIN_REASONING) & posttrain_eligible
    return F.when(blocked, "quarantine").when(F.size(rejects) > 0, "retry").when(ready, "posttrain_candidate").otherwise("pretrain")


def retry_attempt(pipeline: Column) -> Column:
    """The number of retries that a pipeline's name records."""
    return F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(pipeline, r"\|curation-retry=(\d{1,9})$", 1), F.lit("")), F.lit("999999999")).cast("int"), F.lit(0))


def bounded_route(route: Column, raw_uri: Column, pipeline: Column, retryable_url: Column) -> Column:
    """The route, with retries that cannot or must not go on sent to quarantine."""
    ended = raw_uri.isNull() | (retry_attempt(pipeline) >= MAX_RETRIES) | ~retryable_url
    return F.when((route == "retry") & ended, "quarantine").otherwise(route)


def purpose_route(route: Column, usage: Column) -> Column:
    """Texts that may only be transformed go to post-training, unless they are held back."""
    return F.when((usage == "posttrain_transform_only") & ~route.isin("quarantine", "retry"), "posttrain_candidate").otherwise(route)


def pii_action(rejects: Column, body_removed: Column, metadata_removed: Column) -> Column:
    return F.when(F.array_contains(rejects, "pii_detected"), "body_quarantine").when(body_removed, "body_redacted").when(metadata_removed, "metadata_removed").otherwise("none")


def preflight(causes: dict[str, Column]) -> dict[str, Column]:
    """Whether any cause makes the costly scores needless, and the names of those that hold, in order."""
    held = F.array_compact(F.array(*[F.when(F.coalesce(x, F.lit(False)), k) for k, x in causes.items()]))
    return {"rejected": F.size(held) > 0, "causes": F.array_join(held, ",")}


def excluded_from_web(text: Column) -> Column:
    """Whether a web page's section is left out: braces, or filler text."""
    return text.rlike("[{}]") | is_filler(text, word_count(text))
