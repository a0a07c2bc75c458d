"""Relational operators of the serving side: revisions, as-of, listings, summaries, cohorts and time series."""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.functions.text import is_trainable

#: Sources and legacy rejections that listings hide.
REMOVED = ["github-events", "github-releases", "github-release-tarballs", "hf-daily-papers", "oai-arxiv-cs", "rss-openai-news", "rss-deepmind-blog", "rss-hf-blog", "rss-bair-blog", "rss-eleuther-blog"]
LEGACY = ["metadata_only", "c4_nopunc_filter", "gopher_filter"]
RECIPE = ["doc_id", "scoring_version", "classifier_revision", "policy_revision"]


def first_by(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key; Catalyst turns the filter into a limit below the shuffle."""
    return df.withColumn("rn_", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("rn_ = 1").drop("rn_")


def latest(decisions: DataFrame) -> DataFrame:
    return first_by(decisions, ["doc_id"], F.desc("valid_from"), F.desc("scoring_version"), F.desc("policy_revision"), F.asc("trace_id"))


def visible(source: Column, rejects: Column | None = None) -> Column:
    ok = ~source.like("local-%") & (source != "cluster-smoke") & ~source.like("rss-arxiv-%") & ~source.like("seed:%") & ~source.isin(REMOVED)
    for reason in LEGACY if rejects is not None else ():
        ok = ok & ~F.array_contains(rejects, reason)
    return ok


def trainable(df: DataFrame) -> DataFrame:
    return df.filter(is_trainable(F.col("risk_tier"), F.col("route"), F.col("reject_reasons"), F.col("pii_flags")))


def as_of(decisions: DataFrame, instant) -> DataFrame:
    """Per source the tokens and documents that were valid at an instant; revisions rank after the interval filter."""
    own = decisions.filter((F.col("valid_from") <= F.lit(instant)) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.lit(instant))))
    own = trainable(latest(own)).filter(visible(F.col("source_feed"), F.col("reject_reasons")))
    return own.groupBy("source_feed").agg(F.sum(F.coalesce("tokens", F.lit(0))).alias("tokens"), F.count("*").alias("documents"))


def histogram(df: DataFrame, value: str) -> DataFrame:
    return df.groupBy((F.floor(F.col(value) * 2) / 2).alias("bucket")).agg(F.count("*").alias("n"))


def curation_summary(decisions: DataFrame, admissions: DataFrame) -> DataFrame:
    """Counts, tokens and mean quality by route; licence quarantines without any decision join the quarantine."""
    early = admissions.filter("status = 'quarantined'").join(decisions, "doc_id", "left_anti").agg(F.count("*").alias("n"))
    own = latest(decisions).withColumn("route", F.when(F.col("route") == "broad_pretraining", "pretrain").otherwise(F.col("route")))
    own = own.groupBy("route").agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens"), F.sum("quality_score").alias("q"))
    extra = early.select(F.lit("quarantine").alias("route"), "n", F.lit(0).cast("bigint").alias("tokens"), F.lit(0.0).alias("q"))
    both = own.unionByName(extra).groupBy("route").agg(F.sum("n").alias("documents"), F.sum("tokens").alias("tokens"), F.sum("q").alias("q"))
    return both.filter("documents > 0").select("route", "documents", "tokens", F.round(F.col("q") / F.col("documents"), 6).alias("mean_quality"))


def corpus_overview(decisions: DataFrame, admissions: DataFrame) -> DataFrame:
    """(kind, key, n): totals, accepted, rejections by reason and documents by source, in one grouping of exploded facts."""
    own = latest(decisions).filter(visible(F.col("source_feed"), F.col("reject_reasons")))
    accepted = F.size("reject_reasons") == 0
    fact = lambda kind, key: F.struct(F.lit(kind).alias("kind"), key.alias("key"))
    reasons = F.transform("reject_reasons", lambda r: fact("reason", r))
    facts = F.concat(F.array(fact("total", F.lit("decisions")), fact("source", F.col("source_feed")), F.when(accepted, fact("accepted", F.col("source_feed")))), reasons)
    early = admissions.filter("status = 'quarantined'").join(decisions, "doc_id", "left_anti")
    early = early.select(fact("reason", F.when(F.col("license_id") == "unknown", "license_missing").otherwise("license_not_permitted")).alias("f"))
    rows = own.select(F.explode(facts).alias("f")).unionByName(early).filter("f is not null")
    return rows.groupBy("f.kind", "f.key").agg(F.count("*").alias("n"))


def encode_cursor(sort: str, row: dict) -> str:
    return base64.urlsafe_b64encode(json.dumps({"sort": sort, **row}, sort_keys=True).encode()).decode()


def decode_cursor(cursor: str, sort: str) -> dict:
    got = json.loads(base64.urlsafe_b64decode(cursor))
    if got.pop("sort") != sort:
        raise ValueError("the cursor belongs to another order")
    return got


def listing(decisions: DataFrame, sort: str = "newest", cursor: str | None = None, size: int = 20, sources: Sequence[str] = (), reason: str | None = None, needle: str | None = None, min_quality: float | None = None) -> DataFrame:
    """One page of the latest decisions: filters, a keyset cursor, size + 1 rows to tell whether more follow."""
    own = latest(decisions).filter(visible(F.col("source_feed")))
    own = own.filter(F.col("source_feed").isin(*sources)) if sources else own
    own = own.filter(F.array_contains("reject_reasons", reason)) if reason else own
    own = own.filter(F.lower("text").contains(needle.lower())) if needle else own
    own = own.filter(F.col("quality_score") >= min_quality) if min_quality is not None else own
    key = "valid_from" if sort == "newest" else "quality_score"
    if cursor:
        at = decode_cursor(cursor, sort)
        own = own.filter((F.col(key) < at[key]) | ((F.col(key) == at[key]) & (F.col("doc_id") > at["doc_id"])))
    title = F.ltrim(F.split("text", "\n")[0], F.lit("# "))
    return own.select("doc_id", "source_feed", key, title.alias("title"), F.substring("text", 1, 320).alias("preview")).orderBy(F.desc(key), "doc_id").limit(size + 1)


def facets(decisions: DataFrame) -> DataFrame:
    own = latest(decisions).filter(visible(F.col("source_feed")))
    each = F.concat(F.array(F.struct(F.lit("source").alias("facet"), F.col("source_feed").alias("value")), F.struct(F.lit("lang").alias("facet"), F.col("lang").alias("value"))), F.transform("reject_reasons", lambda r: F.struct(F.lit("reason").alias("facet"), r.alias("value"))))
    return own.select(F.explode(each).alias("f")).select("f.*").distinct()


def dataset_rows(decisions: DataFrame, permitted: Sequence[str]) -> DataFrame:
    return trainable(latest(decisions)).filter(F.coalesce("spdx_license", "license").isin(*permitted))


def dataset_summary(rows: DataFrame) -> DataFrame:
    versions = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",").alias(f"{c}s")
    return rows.agg(F.count("*").alias("documents"), F.countDistinct("doc_id").alias("distinct_documents"), F.sum("tokens").alias("tokens"), versions("scoring_version"), versions("policy_revision"), versions("lang"))


def recent_admissions(admissions: DataFrame, limit: int = 20) -> DataFrame:
    """The last admissions seen, at most a hundred."""
    return admissions.orderBy(F.desc("observed_at"), "decision_id").limit(max(1, min(limit, 100)))


def batch_watermark(batch: DataFrame) -> DataFrame:
    """The newest validity of a batch, for the record only: late rows are kept."""
    return batch.agg(F.max("valid_from").alias("watermark"), F.count(F.lit(1)).alias("n"))


def retry_envelopes(decisions: DataFrame, most: int = 3) -> DataFrame:
    """A control record for each document that is to be extracted again and has tries left."""
    own = decisions.filter((F.col("route") == "retry") & (F.coalesce("attempt", F.lit(0)) < most))
    return own.select("doc_id", "source_feed", (F.coalesce("attempt", F.lit(0)) + 1).alias("attempt"), F.lit("extract").alias("action"), F.col("valid_from").alias("requested_at"))


def enqueue(queue: DataFrame, batch: DataFrame, key: str = "doc_id", payload: str = "payload") -> DataFrame:
    """The queue after a batch: new keys enter, rows still queued take a changed payload and a new ordinal, all others stay as they are.

    ``queue`` has key, payload, state and ordinal; the batch has key and payload, and of several payloads the last one by value counts.
    """
    new = batch.groupBy(key).agg(F.max(payload).alias("new_"))
    both = queue.join(new, key, "full_outer")
    fresh = F.col("state").isNull() & F.col("new_").isNotNull()
    changed = fresh | (F.col("new_").isNotNull() & (F.col("state") == "queued") & ~F.col("new_").eqNullSafe(F.col(payload)))
    top = F.lit(queue.agg(F.max("ordinal")).first()[0] or 0)
    both = both.withColumn("changed_", changed)
    taken = ranked(both.filter("changed_"), F.asc(key), name="rank_").select(key, F.col("new_").alias(payload), F.lit("queued").alias("state"), (top + F.col("rank_")).cast("bigint").alias("ordinal"))
    return both.filter("not changed_").select(key, payload, "state", F.col("ordinal").cast("bigint").alias("ordinal")).unionByName(taken)


def dashboard(artifacts: DataFrame, audits: DataFrame, runs: DataFrame) -> DataFrame:
    """(section, key, n): artifacts by state and kind, their latest audit's verdict, runs by provider's latest status, tokens by provider.

    ``artifacts`` has artifact_id, kind and state; ``audits`` artifact_id, at, audit_id and verdict; ``runs`` run_id, provider, at, status and usage (JSON).
    """
    last_audit = first_by(audits, ["artifact_id"], F.desc("at"), F.desc("audit_id"))
    last_run = first_by(runs, ["provider"], F.desc("at"), F.desc("run_id"))
    tokens = F.coalesce(F.get_json_object("usage", "$.total_tokens").cast("bigint"), F.lit(0))
    part = lambda df, section, key, n: df.groupBy(F.col(key).alias("key")).agg(n.cast("bigint").alias("n")).select(F.lit(section).alias("section"), "key", "n")
    one = F.count(F.lit(1))
    parts = [part(artifacts, "state", "state", one), part(artifacts, "kind", "kind", one), part(last_audit, "verdict", "verdict", one), part(last_run, "status", "status", one), part(runs, "tokens", "provider", F.sum(tokens))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def source_activity(decisions: DataFrame, now: int, hours: int) -> DataFrame:
    since = now - max(1, min(hours, 168)) * 3600
    feed = F.when(F.col("source_feed").startswith("rss-arxiv-"), "rss-arxiv").otherwise(F.col("source_feed"))
    own = decisions.filter((F.col("valid_from") > since) & (F.col("valid_from") <= now)).withColumn("feed", feed)
    return own.groupBy("feed").agg(F.count("*").alias("n"), F.count_if(F.size("reject_reasons") == 0).alias("accepted"), F.count_if(F.col("risk_tier") == 3).alias("risky"), F.max("valid_from").alias("newest"))


def upsert_smallest_trace(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Commutative and idempotent: of all rows of a recipe the one with the smallest trace stays."""
    return first_by(target.unionByName(batch), RECIPE, F.asc("trace_id"))


def upsert_last(target: DataFrame, batch: DataFrame, key: str, arrival: str) -> DataFrame:
    """The last row of a key within the batch replaces any before."""
    newest = first_by(batch, [key], F.desc(arrival))
    return target.join(newest, key, "left_anti").unionByName(newest)


def weighted_median(df: DataFrame, key: str, value: str, weight: str) -> DataFrame:
    """Per key the first value, in order, at which the running weight reaches half of the total."""
    w = Window.partitionBy(key).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    own = df.withColumn("run_", F.sum(weight).over(w)).withColumn("all_", F.sum(weight).over(Window.partitionBy(key)))
    return own.filter(F.col("run_") * 2 >= F.col("all_")).groupBy(key).agg(F.min(value).alias("weighted_median"))


def ranked(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """The rows numbered from 1 in an order, without bringing them into one task: ranges of the order are numbered side by side.

    The sorted rows are written first, as their ranges are drawn anew whenever they are worked out.
    """
    rows = df.orderBy(*order).withColumn("range_", F.spark_partition_id()).withColumn("place_", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)).checkpoint()
    before, starts = 0, []
    for r in sorted(rows.groupBy("range_").count().collect()):  # as many rows as there are tasks
        starts.append((r[0], before))
        before += r[1]
    spark = df.sparkSession
    return rows.join(F.broadcast(spark.createDataFrame(starts, "range_ int, start_ bigint")), "range_").withColumn(name, (F.col("start_") + F.col("place_") + 1).cast("int")).drop("range_", "place_", "start_")


def daily_cohort(queue: DataFrame, cutoff: int, limit: int | None = None) -> DataFrame:
    """Rows enqueued in (cutoff - 24 h, cutoff], ranked; the same cutoff gives the same cohort."""
    own = queue.filter((F.col("enqueued_at") > cutoff - 86_400) & (F.col("enqueued_at") <= cutoff))
    order = [F.desc("ranking_score"), F.desc("quality_score"), F.asc("enqueued_at"), F.asc("doc_id")]
    top = own.orderBy(*order).limit(limit) if limit else own
    return ranked(top, *order)


def pool_split(df: DataFrame, pool: str, first_seen: str, key: str) -> DataFrame:
    """Ordinals within each pool; every fifth is benchmark, the rest train."""
    n = F.row_number().over(Window.partitionBy(pool).orderBy(first_seen, key))
    return df.withColumn("ordinal", n).withColumn("split", F.when(F.col("ordinal") % 5 == 0, "benchmark").otherwise("train"))


def bucketed_activity(df: DataFrame, at: str, start: int, end: int, buckets: int) -> DataFrame:
    """Counts in equal buckets from start to end, zero-filled; the right edge belongs to the last bucket."""
    width = (end - start) / buckets
    index = F.least(F.floor((F.col(at) - start) / width), F.lit(buckets - 1))
    own = df.filter(F.col(at).between(start, end)).groupBy(index.alias("bucket")).agg(F.count("*").alias("n"))
    return df.sparkSession.range(buckets).withColumnRenamed("id", "bucket").join(own, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n"))


def counter_deltas(df: DataFrame, series: str, at: str, value: str) -> DataFrame:
    """Increases of a counter; a fall is a reset, the first sample is the baseline."""
    before = F.lag(value).over(Window.partitionBy(series).orderBy(at))
    return df.withColumn("delta", F.when(before.isNull(), 0).when(F.col(value) >= before, F.col(value) - before).otherwise(F.col(value)))


def capped_selection(df: DataFrame, family: str, cap: int, limit: int, *order: Column) -> DataFrame:
    own = df.withColumn("rn_", F.row_number().over(Window.partitionBy(family).orderBy(*order))).filter(F.col("rn_") <= cap).drop("rn_")
    return own.orderBy(*order).limit(limit)


def stratified_split(df: DataFrame, stratum: str, key: str) -> DataFrame:
    """A tenth of each stratum (half-even, one at least from two rows on) by hash order is test, the rest train."""
    n = F.count("*").over(Window.partitionBy(stratum))
    test = F.when(n >= 2, F.greatest(F.lit(1), F.bround(n * 0.1, 0))).otherwise(0)
    rank = F.row_number().over(Window.partitionBy(stratum).orderBy(F.sha2(F.col(key).cast("string"), 256)))
    return df.withColumn("split", F.when(rank <= test, "test").otherwise("train"))


def new_since(df: DataFrame, at: str, key: str, mark, seen: Sequence) -> DataFrame:
    """Rows beyond a high-water mark: newer, or at the mark and not seen there."""
    return df.filter((F.col(at) > F.lit(mark)) | ((F.col(at) == F.lit(mark)) & ~F.col(key).isin(*seen))) if seen else df.filter(F.col(at) >= F.lit(mark))


def not_expired(df: DataFrame, at: str, now: int, age: int = 86_400) -> DataFrame:
    """Rows whose age is below the limit; a missing time counts as expired."""
    return df.filter(F.coalesce(F.lit(now) - F.col(at) < age, F.lit(False)))


def lexical_search(df: DataFrame, key: str, text: str, query: str, limit: int = 10) -> DataFrame:
    """The rows with most of the query's terms, short ones first; a limit of at most 20 is the feature."""
    terms = sorted(set(re.findall(r"[a-z0-9]+", query.lower())))
    own = df.withColumn("w", F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)")))
    hit = F.size(F.array_intersect(F.array_distinct("w"), F.array(*map(F.lit, terms)).cast("array<string>")))
    score = hit / max(1, len(terms)) + 1 / (1 + F.log1p(F.size("w")))
    return own.withColumn("hits", hit).filter("hits > 0").select(key, F.round(score, 8).alias("score"), F.substring(text, 1, 500).alias("snippet")).orderBy(F.desc("score"), key).limit(max(1, min(limit, 20)))
