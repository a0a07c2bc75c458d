"""Relational operators over evidence graphs, spans, sections, calls, snapshots and quotas."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.functions.scoring import spans

#: Types of nodes that must cite a span; suffixes of table files.
GROUNDABLE = ("claim", "finding", "limitation", "method_step")
TABLE_FILES = r"\.(metadata\.json|avro|parquet|puffin)$"
CACHE_ROWS = 100_000


def stable_spans(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per span: key, ordinal, span_id, text and its hash."""
    own = df.select(key, F.posexplode(spans(F.col(text))).alias("ordinal", "span"))
    return own.select(key, "ordinal", F.concat(F.col(key).cast("string"), F.lit(".span"), F.col("ordinal") + 1).alias("span_id"), "span", F.sha2("span", 256).alias("span_sha"))


def terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)")))


def nearest_spans(objects: DataFrame, own: DataFrame, group: str, k: int = 3) -> DataFrame:
    """Each object's ``k`` spans of its group by the share of its hint's terms that they hold; ties to the smaller id.

    Objects: group, object_id, hint. Spans: group, span_id, span. Terms meet by key, so no pair of an object
    and a span without a common term is ever built.
    """
    wanted = objects.select(group, "object_id", terms(F.col("hint")).alias("t")).withColumn("n", F.size("t")).select(group, "object_id", "n", F.explode("t").alias("term"))
    held = own.select(group, "span_id", F.explode(terms(F.col("span"))).alias("term"))
    score = wanted.join(held, [group, "term"]).groupBy(group, "object_id", "span_id").agg((F.count("*") / F.first("n")).alias("score"))
    rank = F.row_number().over(Window.partitionBy(group, "object_id").orderBy(F.desc("score"), "span_id"))
    return score.withColumn("rank", rank).filter(F.col("rank") <= k)


def find(df: DataFrame, key: str | list[str], text: str, needle: str, hits: int = 100, around: int = 100) -> DataFrame:
    """The first ``hits`` occurrences of a string by key and place, in any case, with what surrounds them."""
    low, n = F.lower(F.col(text)), len(needle)
    keys = [key] if isinstance(key, str) else key
    parts = df.select(*keys, text, F.slice(F.split(low, re.escape(needle.lower())), 1, hits + 1).alias("p"), low.contains(needle.lower()).alias("in")).filter("in")
    lengths = F.transform(F.slice("p", 1, F.greatest(F.size("p") - 1, F.lit(0))), lambda x: F.length(x))
    starts = F.transform(F.sequence(F.lit(1), F.size("l")), lambda i: F.aggregate(F.slice("l", F.lit(1), i), F.lit(0), lambda a, x: a + x) + (i - 1) * n)
    got = parts.withColumn("l", lengths).filter(F.size("l") > 0).select(*keys, text, F.explode(starts).alias("start"))
    lo = F.greatest(F.col("start") - around, F.lit(0))
    context = F.substring(F.col(text), lo + 1, F.col("start") + n + around - lo)
    return got.select(*keys, "start", (F.col("start") + n).alias("end"), context.alias("context")).orderBy(*keys, "start").limit(hits)


def graph_violations(nodes: DataFrame, edges: DataFrame, known: DataFrame) -> DataFrame:
    """kind and id of what breaks a graph's rules. Nodes: id, type, spans; edges: edge_id, source, target; known: span_id."""
    nodes = nodes.withColumn("id", F.col("id").cast("string"))
    twice = nodes.groupBy("id").count().filter("count > 1").select(F.lit("duplicate_node").alias("kind"), "id")
    bare = nodes.filter(F.col("type").isin(*GROUNDABLE) & (F.size("spans") == 0)).select(F.lit("ungrounded").alias("kind"), "id")
    cited = nodes.select("id", F.explode("spans").alias("span_id"))
    unknown = cited.join(known, "span_id", "left_anti").select(F.lit("unknown_span").alias("kind"), "id").distinct()
    ends = edges.select(F.col("edge_id").cast("string").alias("edge"), F.explode(F.array(F.col("source").cast("string"), F.col("target").cast("string"))).alias("id"))
    loose = ends.join(nodes.select("id").distinct(), "id", "left_anti").select(F.lit("dangling_edge").alias("kind"), F.col("edge").alias("id")).distinct()
    return twice.unionByName(bare).unionByName(unknown).unionByName(loose)


def merged_nodes(nodes: DataFrame, removed: DataFrame, patch: DataFrame) -> DataFrame:
    """Nodes without the removed ones, replaced or joined by the patch's (which may bring a removed one back). Key: id."""
    return nodes.join(removed, "id", "left_anti").join(patch.select("id"), "id", "left_anti").unionByName(patch)


def merged_edges(edges: DataFrame, patch: DataFrame, removed: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges of both, once per (source, relation, target), without the removed and the dangling ones."""
    key = ["source", "relation", "target"]
    ids = nodes.select("id").distinct()
    out = edges.select(key).unionByName(patch.select(key)).distinct().join(removed.select(key), key, "left_anti")
    return out.join(ids.withColumnRenamed("id", "source"), "source", "left_semi").join(ids.withColumnRenamed("id", "target"), "target", "left_semi").select(key)


def active_calls(events: DataFrame, job: str, at: str, state: str, call: list[str], started: str, ended: list[str]) -> DataFrame:
    """Starts without a later start of their job and without a later end of the same call, by two running maxima."""
    last = F.max(F.when(F.col(state) == started, F.col(at))).over(Window.partitionBy(job))
    over = F.max(F.when(F.col(state).isin(*ended), F.col(at))).over(Window.partitionBy(job, *call))
    own = events.withColumns({"last_": last, "over_": over})
    return own.filter((F.col(state) == started) & (F.col(at) == F.col("last_")) & (F.col("over_").isNull() | (F.col("over_") <= F.col(at)))).drop("last_", "over_")


def section_quality(sections: DataFrame, doc: str, order: str, score: str, tokens: str, klass: str, cutoff: Column) -> DataFrame:
    """A document's token-weighted quality, whether it passes, and its diagnostic head: best section (first of equals), means, fives."""
    weight = F.greatest(F.col(tokens), F.lit(1))
    out = sections.groupBy(doc).agg(
        (F.sum(F.col(score) * weight) / F.sum(weight)).alias("quality"),
        F.max(score).alias("best"),
        F.max_by(order, F.struct(F.col(score), -F.col(order))).alias("best_section"),
        F.avg(score).alias("mean"),
        F.count("*").alias("sections"),
        F.count_if(F.col(klass) == 5).alias("class_5_sections"),
    )
    return out.withColumn("passed", F.col("quality") >= cutoff)


def section_hints(sections: DataFrame, doc: str, order: str, title: str, score: str, least: float = 4.0, k: int = 3) -> DataFrame:
    """Titles of each document's ``k`` best sections of at least ``least``; a repeated title counts at its best place."""
    good = sections.filter((F.col(score) >= least) & (F.col(title) != ""))
    best = good.groupBy(doc, title).agg(F.min(F.struct((-F.col(score)).alias("s"), F.col(order).alias("o"))).alias("at"))
    rank = F.row_number().over(Window.partitionBy(doc).orderBy("at.s", "at.o"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select(doc, "rank", title)


def cache_key(revision: Column, text: Column) -> Column:
    return F.sha2(F.concat(revision, F.lit("\0"), text), 256)


def cached(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """Requests (key) with the score that the cache (key, score) holds, else null."""
    return requests.join(cache.select("key", "score"), "key", "left")


def trimmed_cache(cache: DataFrame, rows: int = CACHE_ROWS) -> DataFrame:
    """The newest rows, ties by key."""
    return cache.orderBy(F.desc("created_at"), "key").limit(rows)


def snapshots_to_expire(snapshots: DataFrame, older_than, keep: int, refs: DataFrame) -> DataFrame:
    """Snapshots older than the cutoff, but for the newest ``keep`` and those that a reference names. Columns: snapshot_id, at."""
    newest = snapshots.orderBy(F.desc("at"), F.desc("snapshot_id")).limit(keep).select("snapshot_id")
    return snapshots.filter(F.col("at") < F.lit(older_than)).join(newest, "snapshot_id", "left_anti").join(refs, "snapshot_id", "left_anti")


def orphan_files(objects: DataFrame, protected: DataFrame, older_than) -> DataFrame:
    """Table files that nothing protects and that are older than the cutoff. Columns: key, modified."""
    return objects.filter(F.col("key").rlike(TABLE_FILES) & (F.col("modified") < F.lit(older_than))).join(protected, "key", "left_anti")


def over_quota(requests: DataFrame, provider: str, at: str, order: str, amount: str, limit: int, window: int) -> DataFrame:
    """Requests (``at`` in seconds) that would take a provider's window over its limit, counting all earlier ones in it."""
    slot = F.floor(F.col(at) / window)
    run = F.sum(amount).over(Window.partitionBy(provider, "slot").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return requests.withColumn("slot", slot).withColumn("used", run).filter(F.col("used") > limit)


def hash_sample(narrow: DataFrame, bodies: DataFrame, keys: list[str], n: int) -> DataFrame:
    """``n`` rows by the hash of their first key, chosen on narrow columns and joined to non-blank bodies (the sample is bounded)."""
    chosen = narrow.select(keys).orderBy(F.sha2(F.col(keys[0]).cast("string"), 256), *keys).limit(n)
    return bodies.join(F.broadcast(chosen) if n <= 100_000 else chosen, keys).filter(F.trim("text") != "")


def verified(answers: DataFrame, predicates: dict[str, tuple[Column, Column, float, bool]]) -> DataFrame:
    """Answers with reward and passed, from predicates' (passed, score, weight, required); a failed required one leaves no reward."""
    total = sum(w for _, _, w, _ in predicates.values() if w > 0)
    score = sum((F.least(F.greatest(s, F.lit(0.0)), F.lit(1.0)) * w for _, s, w, _ in predicates.values()), F.lit(0.0)) / (total or 1.0)
    hard = F.lit(True)
    for ok, _, _, required in predicates.values():
        hard = hard & ok if required else hard
    reward = F.when(hard, F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0))).otherwise(0.0)
    return answers.withColumn("reward", reward if total else F.lit(0.0)).withColumn("passed", hard & (F.col("reward") >= 0.999))


def _ratio(part: Column, whole: Column, empty: float) -> Column:
    return F.when(F.size(whole) > 0, F.size(part) / F.size(whole)).otherwise(empty)


def covers(targets: Column, given: Column, empty: float = 1.0) -> tuple[Column, Column]:
    """(passed, score): share of the targets that are given; ``empty`` without targets, which passes only if it is 1."""
    t = F.array_distinct(targets)
    passes = F.size(F.array_except(t, given)) == 0
    return (passes if empty else passes & (F.size(t) > 0)), _ratio(F.array_intersect(t, given), t, empty)


def avoids(forbidden: Column, given: Column) -> tuple[Column, Column]:
    passed = F.size(F.array_intersect(forbidden, given)) == 0
    return passed, passed.cast("double")


def allowed(given: Column, permitted: Column) -> tuple[Column, Column]:
    own = F.array_distinct(given)
    return (F.size(own) > 0) & (F.size(F.array_except(own, permitted)) == 0), _ratio(F.array_intersect(own, permitted), own, 0.0)


def identifies(targets: Column, forbidden: Column, given: Column) -> tuple[Column, Column]:
    """Exactly the targets and nothing forbidden; scored by Jaccard."""
    exact = (F.size(F.array_except(targets, given)) == 0) & (F.size(F.array_except(given, targets)) == 0)
    return exact & (F.size(F.array_intersect(forbidden, given)) == 0), _ratio(F.array_intersect(targets, given), F.array_union(targets, given), 0.0)


def within(values: Column, expected: Column, tolerance: Column) -> tuple[Column, Column]:
    """The nearest of the values against the expected one."""
    best = F.array_min(F.transform(values, lambda v: F.abs(v - expected)))
    near = F.coalesce(best <= tolerance, F.lit(False))
    scale = F.greatest(F.abs(expected), tolerance, F.lit(1e-12))
    passed = near & expected.isNotNull()
    return passed, F.when(passed, 1.0).otherwise(F.coalesce(F.greatest(F.lit(0.0), 1.0 - best / scale), F.lit(0.0)))


def ordered(given: Column, pairs: list[tuple[str, str]]) -> tuple[Column, Column]:
    """Whether each pair's first comes before its second."""
    at = lambda x: F.array_position(given, x)
    held = sum(((at(a).cast("int") > 0) & (at(b) > 0) & (at(a) < at(b))).cast("int") for a, b in pairs) if pairs else F.lit(0)
    return (held == len(pairs)) & F.lit(bool(pairs)), held / max(len(pairs), 1)


def without_expired(records: DataFrame, expired: DataFrame, uri: str = "uri") -> DataFrame:
    """Records whose pointer is not known to be dead; a null pointer is kept."""
    return records.join(expired.select(uri).distinct(), uri, "left_anti")


def record_expired(expired: DataFrame, batch: DataFrame, uri: str = "uri") -> DataFrame:
    """The new dead pointers of a batch, each once, for appending."""
    return batch.select(uri).distinct().join(expired.select(uri), uri, "left_anti")


def first_seen(pages: DataFrame, archive: DataFrame, url: str = "url") -> DataFrame:
    """Pages with the time at which an archive table first saw their address (null if never), in place of live look-ups."""
    return pages.join(archive.groupBy(url).agg(F.min("seen_at").alias("first_seen_at")), url, "left")
