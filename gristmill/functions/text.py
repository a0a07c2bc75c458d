"""Text-quality, language, perplexity and licence rules as native column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the rules: stop words ("I" never matches a lower-cased word), marks and phrases.
STOP_WORDS = ("the be to of and a in that have I it for not on with he as you do at this but his by from they we say her she or an will my one all would there their what so up out if about who get which go me").split()
LANGUAGE_WORDS = {
    "en": "the and that have for not with you this but his they are from which one".split(),
    "de": "der die und das mit nicht ein eine ist auch sich auf zu von im sind".split(),
    "fr": "le la les des une est pas que pour dans avec sur ne par plus mais ou".split(),
    "es": "que de no la el en los se las por con para una su al lo como mas".split(),
}
FILLER = ("lorem ipsum", "dolor sit amet", "consectetur adipiscing elit")
SPACE = r"(?U)[\s\x1c-\x1f]+"
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"
PERMITTED = ["CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-3.0", "CC-BY-SA-3.0", "CC0-1.0", "Apache-2.0", "MIT", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "ISC", "Unlicense", "HF-Public-Repository-Terms-2022-09-15"]
TRANSFORM_ONLY = ["arxiv-non-exclusive-distribution", "CC-BY-NC-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-3.0", "CC-BY-NC-SA-3.0", "unknown", "ODC-By-1.0"]
UNKNOWN = ["", "unknown", "none", "n/a", "null", "per-record", "noassertion", "other"]
PLAIN_IDS = ["Apache-2.0", "MIT", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "CC0-1.0", "ISC", "Unlicense", "ODC-By-1.0"]


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def lines(text: Column) -> Column:
    """Non-blank lines without outer white space."""
    strip = lambda x: F.regexp_replace(x, rf"^{SPACE}|{SPACE}$", "")
    return F.filter(F.transform(F.split(text, LINE_END), strip), lambda x: x != "")


def share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _count(items: Column, test) -> Column:
    return F.size(F.filter(items, test))


_BLANK = r"\s\x1c-\x1f"


def _with(chars: str) -> str:
    """A word that holds one of the characters; tried at the beginnings of words only."""
    return rf"(?U)(?<![^{_BLANK}])[^{_BLANK}{chars}]*+[{chars}][^{_BLANK}]*+"


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(rf"(?U)[^{_BLANK}]++"))


def gopher(text: Column, ln: Column) -> dict[str, Column]:
    """The word and line statistics, from a text and the array of its lines; words are counted by one pass for each statistic."""
    n, m = word_count(text), F.size(ln)
    stop = rf"(?U)(?<![^{_BLANK}])(?:{'|'.join(w for w in STOP_WORDS if w.islower())})(?![^{_BLANK}])"
    return {
        "word_count": n.cast("bigint"),
        "mean_word_len": share(F.length(F.regexp_replace(text, SPACE, "")), n),
        "stopword_ratio": share(F.regexp_count(F.lower(text), F.lit(stop)), n),
        "symbol_word_ratio": share(F.regexp_count(text, F.lit(_with(r"#@&*<>{}\[\]\\"))), n),
        "alpha_word_ratio": share(F.regexp_count(text, F.lit(_with(r"\p{L}"))), n),
        "bullet_line_ratio": share(_count(ln, lambda x: x.rlike("^[•*\\-●▪‣⁃]")), m),
        "ellipsis_line_ratio": share(_count(ln, lambda x: x.rlike(r"(\.\.\.|…)$")), m),
    }


def gopher_passes(c=F.col) -> Column:
    return (
        c("word_count").between(50, 100_000)
        & c("mean_word_len").between(3.0, 10.0)
        & (c("symbol_word_ratio") <= 0.10)
        & (c("alpha_word_ratio") >= 0.80)
        & (c("stopword_ratio") * c("word_count") >= 2)
        & (c("bullet_line_ratio") <= 0.90)
        & (c("ellipsis_line_ratio") <= 0.30)
    )


def ends_sentence(ln: Column) -> Column:
    return share(_count(ln, lambda x: x.rlike('[.!?"”’)]$')), F.size(ln))


def is_filler(text: Column, words: Column) -> Column:
    low = F.lower(text)
    hits = sum(((F.length(low) - F.length(F.replace(low, F.lit(p)))) / len(p) for p in FILLER), F.lit(0))
    return (hits > 0) & ((words <= 40) | (hits >= 3))


def heuristic_language(w: Column) -> Column:
    """struct(score, lang): overlap of the distinct alphabetic words with each language's; ties in order en, de, fr, es."""
    own = F.array_distinct(F.transform(F.filter(w, lambda x: x.rlike(r"^\p{L}+$")), lambda x: F.lower(x)))
    hits = [F.struct(F.size(F.array_intersect(own, F.array(*map(F.lit, v)))).alias("n"), F.lit(-i).alias("i"), F.lit(k).alias("lang")) for i, (k, v) in enumerate(LANGUAGE_WORDS.items())]
    best, n = F.array_max(F.array(*hits)), F.size(own)
    known = (n > 0) & (best["n"] > 0)
    return F.struct(F.when(known, F.least(F.lit(5.0) * best["n"] / n, F.lit(0.9))).otherwise(0.0).alias("score"), F.when(known, best["lang"]).otherwise("und").alias("lang"))


def entropy_proxy(text: Column) -> Column:
    """Eight times two to the character entropy; zero for blank text. Counts come from one pass over sorted characters."""
    chars = F.array_sort(F.filter(F.split(text, ""), lambda c: c != ""))
    zero = F.struct(F.lit("").alias("c"), F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("s"))
    xlogx = lambda n: F.when(n > 0, n * F.log2(n)).otherwise(F.lit(0.0))
    step = lambda a, c: F.when(a["c"] == c, F.struct(c.alias("c"), (a["n"] + 1).alias("n"), a["s"].alias("s"))).otherwise(F.struct(c.alias("c"), F.lit(1).cast("bigint").alias("n"), (a["s"] + xlogx(a["n"])).alias("s")))
    total = F.aggregate(chars, zero, step, lambda a: a["s"] + xlogx(a["n"]))
    n = F.length(text)
    return F.when(F.regexp_replace(text, SPACE, "") == "", F.lit(0.0)).otherwise(F.pow(F.lit(2.0), F.log2(n) - total / n) * 8.0)


def perplexity_bucket(p: Column) -> Column:
    return F.when(p <= 200, "head").when(p <= 1000, "middle").otherwise("tail")


def development_quality(mean_len: Column, n: Column) -> Column:
    score = 5.0 / (1 + F.exp(-(mean_len - 4.0))) * F.when(n < 50, 0.5).otherwise(1.0)
    return F.least(F.greatest(score, F.lit(0.0)), F.lit(5.0))


def normalized_licence(raw: Column) -> Column:
    """A stable identifier: sentinels, the two URL families, then known names in any case; else the cleaned original."""
    clean = F.rtrim(F.regexp_replace(F.coalesce(raw, F.lit("")), rf"^{SPACE}|{SPACE}$", ""), F.lit("/"))
    low = F.lower(clean)
    url = r"creativecommons\.org/(?:licenses|publicdomain)/(by(?:-sa|-nc|-nc-sa|-nc-nd|-nd)?|zero)/(\d\.\d)"
    family, version = F.regexp_extract(low, url, 1), F.regexp_extract(low, url, 2)
    name = r"^cc[ -]by((?:[- ](?:nc|sa|nd)){0,2})[ -]([34]\.0)$"
    parts = F.upper(F.translate(F.regexp_extract(low, name, 1), " ", "-"))
    named = F.concat(F.lit("CC-BY"), parts, F.lit("-"), F.regexp_extract(low, name, 2))
    # Version 3.0 has fewer known names than 4.0.
    known = low.rlike(name) & ((parts.isin("", "-SA", "-NC", "-NC-SA", "-ND", "-NC-ND") & low.endswith("4.0")) | (parts.isin("", "-SA", "-NC", "-NC-SA") & low.endswith("3.0")))
    out = F.when(low.isin(UNKNOWN), "unknown").when(low.contains("arxiv.org/licenses/nonexclusive-distrib"), "arxiv-non-exclusive-distribution")
    out = out.when(family == "zero", F.concat(F.lit("CC0-"), version)).when(family != "", F.concat(F.lit("CC-"), F.upper(family), F.lit("-"), version)).when(known, named)
    for i in PLAIN_IDS:
        out = out.when(low == i.lower(), i)
    return out.when(low == "apache 2.0", "Apache-2.0").otherwise(clean)


def admission_status(licence: Column) -> Column:
    return F.when(licence.isin(PERMITTED), "admitted").when(licence.isin(TRANSFORM_ONLY), "posttrain_transform_only").otherwise("quarantined")


def composite_quality(structure: Column, quality: Column, language: Column) -> Column:
    """Weighted mean of the applicable (non-null) scores, weights renormalised, within 0 to 5."""
    pairs = [(structure, 0.20), (quality, 0.70), (language, 0.10)]
    total = sum((F.when(c.isNotNull(), w).otherwise(0.0) for c, w in pairs), F.lit(0.0))
    value = sum((F.coalesce(c, F.lit(0.0)) * w for c, w in pairs), F.lit(0.0))
    return F.when(total > 0, F.least(F.greatest(value / total, F.lit(0.0)), F.lit(5.0))).otherwise(F.lit(0.0))


def risk_tier(pii: Column, rejects: Column) -> Column:
    return F.when(F.size(pii) > 0, 3).when(F.size(rejects) > 0, 2).otherwise(1)


def is_trainable(risk: Column, route: Column, rejects: Column, pii: Column) -> Column:
    return (risk == 1) & route.isin("pretrain", "broad_pretraining", "posttrain_candidate", "reasoning_candidate") & (F.size(rejects) == 0) & (F.size(pii) == 0)


def shingles(w: Column, n: int = 5) -> Column:
    """Word n-grams; fewer words give one joined shingle, none give none."""
    many = F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(w, i, n), " "))
    return F.when(F.size(w) == 0, F.array().cast("array<string>")).otherwise(many)


LN6 = math.log(6)


def ordinal(logits: Column) -> Column:
    """struct(score, klass, confidence) of six logits: expectation, its half-even rounding, one minus normalised entropy."""
    top = F.array_max(logits)
    e = F.transform(logits, lambda x: F.exp(x - top))
    z = F.aggregate(e, F.lit(0.0), lambda a, x: a + x)
    p = F.transform(e, lambda x: x / z)
    score = F.aggregate(F.transform(p, lambda x, i: x * i), F.lit(0.0), lambda a, x: a + x)
    entropy = F.aggregate(p, F.lit(0.0), lambda a, x: a - F.when(x > 0, x * F.log(x)).otherwise(0.0))
    return F.struct(score.alias("score"), F.bround(score, 0).cast("int").alias("klass"), (1 - entropy / LN6).alias("confidence"))
