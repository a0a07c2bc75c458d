"""Licence decisions: status, reason, scope and identity, and the gate that curation applies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions.text import PERMITTED, TRANSFORM_ONLY, admission_status, normalized_licence

#: Fixed value: the order of the fields that a decision's identity covers.
IDENTITY = ("doc_id", "source_feed", "source_format", "license_id", "license_source", "status", "resolver", "evidence_url", "evidence_revision", "evidence_scope", "policy_revision")
#: Wordings of reasons.
GRANTED, REFUSED = " is on the training allowlist", " is not on the training allowlist"
UNRESOLVED = "item-level licence is unresolved; excluded from verbatim pretraining and allowed only for derived post-training generation"
WRAPPER = "dataset wrapper licence does not establish item rights; excluded from verbatim pretraining and allowed only for derived post-training generation"
DERIVED = " is excluded from verbatim pretraining and allowed only for derived post-training generation"


def reason(licence: Column, status: Column) -> Column:
    out = F.when(status == "admitted", F.concat(licence, F.lit(GRANTED))).when(licence == "unknown", UNRESOLVED).when(licence == "ODC-By-1.0", WRAPPER)
    return out.when(status == "posttrain_transform_only", F.concat(licence, F.lit(DERIVED))).otherwise(F.concat(licence, F.lit(REFUSED)))


def scope(licence: Column, given: Column) -> Column:
    named = F.when(given != "", given)
    return F.coalesce(named, F.when(licence == "unknown", "unknown").when(licence == "ODC-By-1.0", "dataset_wrapper").otherwise("item"))


def decided(df, raw: str = "raw_license"):
    """The rows with license_id, status, reason, evidence_scope and decision_id; evidence columns that are null count as empty,
    a missing resolver as the licence's source. Equal evidence gives an equal decision_id, whenever it was seen."""
    # Bound inside a lambda, the normalised licence is worked out once, not anew in each column that uses it.
    given = F.col("evidence_scope")
    bound = F.transform(F.array(normalized_licence(F.col(raw))), lambda x: F.struct(x.alias("id"), admission_status(x).alias("status"), scope(x, given).alias("scope")))
    df = df.withColumn("own_", F.transform(bound, lambda x: F.struct(x["id"].alias("id"), x["status"].alias("status"), x["scope"].alias("scope"), reason(x["id"], x["status"]).alias("reason")))[0])
    resolver = F.coalesce(F.when(F.col("resolver") != "", F.col("resolver")), F.col("license_source"))
    df = df.withColumns({"license_id": F.col("own_.id"), "status": F.col("own_.status"), "reason": F.col("own_.reason"), "evidence_scope": F.col("own_.scope"), "resolver": resolver}).drop("own_")
    fields = F.concat_ws("\0", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in IDENTITY])
    return df.withColumn("decision_id", F.concat(F.lit("sha256:"), F.sha2(fields, 256)))


def gate(usage: Column, licence: Column) -> Column:
    """The reject reason of the licence, null if it may be used for what the record is meant for."""
    derived = (usage == "posttrain_transform_only") & licence.isin(TRANSFORM_ONLY)
    return F.when(F.coalesce(derived | licence.isin(PERMITTED), F.lit(False)), F.lit(None).cast("string")).otherwise("license_excluded")
