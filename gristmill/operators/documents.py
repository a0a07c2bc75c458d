"""The document listing: filters, orders, keyset pages and counts over decisions and admissions, look-up and guarded SQL."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.operators.serving import decode_cursor, encode_cursor, first_by, latest, visible

#: For each order its columns and whether they rise; the document id, rising, breaks ties.
SORTS = {
    "newest": [("valid_from", False)],
    "oldest": [("valid_from", True)],
    "quality_desc": [("quality_score", False), ("valid_from", False)],
    "source_quality_desc": [("source_quality_score", False), ("valid_from", False)],
    "perplexity_asc": [("perplexity", True), ("valid_from", False)],
}
MOST = 100  #: rows of a page


@dataclass(frozen=True)
class Filters:
    """What a listing shows; an option that is not given filters nothing."""

    search: str | None = None
    routes: Sequence[str] = ()
    sources: Sequence[str] = ()
    formats: Sequence[str] = ()
    since: object = None
    until: object = None
    tags: Sequence[str] = ()
    reasons: Sequence[str] = ()
    figures: bool | None = None
    tables: bool | None = None
    equations: bool | None = None
    fixtures: bool = False
    source_quality: tuple[float | None, float | None] = (None, None)
    quality: tuple[float | None, float | None] = (None, None)

    def predicate(self) -> Column:
        c = F.col
        wanted = [] if self.fixtures else [visible(c("source_feed"))]
        if self.search and (needle := self.search.strip().lower()):
            # The needle is a pattern, as its readers expect: % and _ stand for any characters.
            wanted.append(reduce(lambda x, y: x | y, [F.lower(c(k).cast("string")).like(f"%{needle}%") for k in ("text", "doc_id", "source_feed")]))
        wanted += [c(k).isin(*v) for k, v in (("route", self.routes), ("source_feed", self.sources), ("source_format", self.formats)) if v]
        wanted += [F.array_contains(k, v) for k, own in (("content_tags", self.tags), ("reject_reasons", self.reasons)) for v in own]
        wanted += [F.col("valid_from") >= F.lit(self.since)] if self.since is not None else []
        wanted += [F.col("valid_from") <= F.lit(self.until)] if self.until is not None else []
        wanted += [(c(k) > 0) if on else (c(k) == 0) for k, on in (("figure_count", self.figures), ("table_count", self.tables), ("equation_count", self.equations)) if on is not None]
        for k, (low, high) in (("source_quality_score", self.source_quality), ("quality_score", self.quality)):
            wanted += [c(k) >= low] if low is not None else []
            wanted += [c(k) <= high] if high is not None else []
        return reduce(lambda x, y: x & y, wanted, F.lit(True))


def everything(decisions: DataFrame, admissions: DataFrame) -> DataFrame:
    """The latest decision of each document, and a quarantined row for each refused admission that has none yet.

    ``admissions`` has doc_id, source_feed, observed_at, decision_id, license_id and status.
    """
    refused = latest_admission(admissions).filter("status = 'quarantined'").join(decisions.select("doc_id").distinct(), "doc_id", "left_anti")
    why = F.when(F.col("license_id") == "unknown", "license_missing").otherwise("license_not_permitted")
    refused = refused.select("doc_id", "source_feed", F.col("observed_at").alias("valid_from"), F.lit("quarantine").alias("route"), F.array(why).alias("reject_reasons"), F.lit(2).alias("risk_tier"), F.col("license_id").alias("license"), F.lit(0.0).alias("quality_score"))
    return latest(decisions).unionByName(refused, allowMissingColumns=True)


def latest_admission(admissions: DataFrame) -> DataFrame:
    return first_by(admissions, ["doc_id"], F.desc("observed_at"), F.desc("decision_id"))


def admissions_view(admissions: DataFrame) -> DataFrame:
    """One row of each decision: the one observed first."""
    return first_by(admissions, ["decision_id"], F.asc("observed_at"))


def new_admissions(batch: DataFrame, durable: DataFrame) -> DataFrame:
    """What a writer appends: each decision of the batch once, and none that is there already."""
    return admissions_view(batch).join(durable.select("decision_id"), "decision_id", "left_anti")


def _beyond(sort: str, at: dict) -> Column:
    """Rows that come after a place in an order, by its columns in turn."""
    after = F.col("doc_id") > at["doc_id"]
    for column, rising in reversed(SORTS[sort]):
        c, v = F.col(column), at[column]
        after = ((c > v) if rising else (c < v)) | ((c == v) & after)
    return after


def page(rows: DataFrame, filters: Filters = Filters(), sort: str = "newest", cursor: str | None = None, size: int = 25) -> DataFrame:
    """One page and a row more if others follow. The order falls back to the newest first; pages hold 1 to 100 rows."""
    sort = sort if sort in SORTS else "newest"
    own = rows.filter(filters.predicate())
    own = own.filter(_beyond(sort, decode_cursor(cursor, sort))) if cursor else own
    order = [F.asc_nulls_last(c) if rising else F.desc(c) for c, rising in SORTS[sort]]
    keys = [c for c, _ in SORTS[sort]]
    title = F.ltrim(F.split("text", "\n")[0], F.lit("# "))
    return own.select("doc_id", "source_feed", "route", *keys, title.alias("title"), F.substring("text", 1, 320).alias("preview")).orderBy(*order, "doc_id").limit(max(1, min(size, MOST)) + 1)


def cursor_of(row, sort: str) -> str:
    """The cursor of a page whose last shown row this is."""
    return encode_cursor(sort, {c: row[c] for c in ("doc_id", *(c for c, _ in SORTS[sort]))})


def count(rows: DataFrame, filters: Filters = Filters()) -> DataFrame:
    return rows.filter(filters.predicate()).agg(F.count(F.lit(1)).alias("n"))


def document(decisions: DataFrame, admissions: DataFrame, doc_id) -> DataFrame:
    """The latest decision of a document with its latest admission; the refused admission alone if there is no decision, else no row."""
    own = decisions.filter(F.col("doc_id") == F.lit(doc_id))
    given = admissions.filter(F.col("doc_id") == F.lit(doc_id))
    seen = latest_admission(given).select("doc_id", F.struct("decision_id", "status", "license_id", "observed_at").alias("admission"))
    return everything(own, given).join(seen, "doc_id", "left")


def segment_scores(segments: DataFrame, key: str, order: str) -> DataFrame:
    """Per document the mean quality and the median perplexity, with its bucket, of its included segments, weighted by words (1 to 512).

    ``segments`` has included, words, quality, perplexity and bucket; what has no score does not count. Without any
    score the quality is 0, the perplexity 0 and the bucket `middle`; equal perplexities keep the segments' order.
    """
    weight = F.least(F.greatest(F.col("words"), F.lit(1)), F.lit(512))
    on = F.col("included")
    quality = F.when(on & F.col("quality").isNotNull(), weight)
    own = F.when(on & F.col("perplexity").isNotNull() & F.col("bucket").isNotNull(), F.struct(F.col("perplexity").alias("p"), F.col(order).alias("o"), weight.alias("w"), F.col("bucket").alias("b")))
    got = segments.groupBy(key).agg((F.sum(F.col("quality") * quality) / F.sum(quality)).alias("q"), F.array_sort(F.collect_list(own)).alias("s"))
    half = F.aggregate("s", F.lit(0).cast("bigint"), lambda a, x: a + x["w"]) / 2
    zero = F.struct(F.lit(0).cast("bigint").alias("run"), F.lit(0.0).alias("p"), F.lit("middle").alias("b"))
    # The running weight stops at the first segment that reaches half of the total.
    step = lambda a, x: F.when((a["run"] >= F.col("half")) & (a["run"] > 0), a).otherwise(F.struct((a["run"] + x["w"]).alias("run"), x["p"].cast("double").alias("p"), x["b"].alias("b")))
    got = got.withColumn("half", half).withColumn("m", F.aggregate("s", zero, step))
    return got.select(key, F.coalesce("q", F.lit(0.0)).alias("quality"), F.col("m.p").alias("perplexity"), F.col("m.b").alias("bucket"))


def safe_query(spark: SparkSession, sql: str, params: Sequence = ()) -> DataFrame:
    """Runs one SELECT with positional parameters; anything else is refused before it reaches the session."""
    own = sql.strip().rstrip(";")
    if own[:6].lower() != "select":
        raise ValueError("only SELECT statements are allowed")
    if ";" in own:
        raise ValueError("multiple SQL statements are not allowed")
    return spark.sql(own, args=list(params))


def as_of_batch(table: DataFrame, version: int, batch: str = "batch_id") -> DataFrame:
    """The table as it stood after a batch: what later batches wrote is left out."""
    return table.filter(F.col(batch) <= version)
