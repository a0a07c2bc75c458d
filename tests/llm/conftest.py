import pandas as pd
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_pdf():
    """Documents of the smallest table and odd rows: null, empty, blank, repeated, very long, letterless."""
    d = pd.read_parquet(f"{SF}/documents.parquet")
    odd = [
        (900001, None, "en"), (900002, "", "en"), (900003, " \n\t ", None), (900004, "12 34 !!", "en"),
        (900005, d.text[3], "en"), (900005, d.text[3], "en"), (900006, "the and of that " * 20_000, "en"),
        (None, "the and of with no id", "en"), (900007, "one two", "de"), (900008, "Ünïcode Ωmega \U0001f600 text İx", "de"),
    ]
    extra = pd.DataFrame([{"doc_id": i, "text": t, "lang": x, "source": None, "n_chars": None} for i, t, x in odd])
    out = pd.concat([d, extra], ignore_index=True)
    out["doc_id"] = out.doc_id.astype("Int64")
    out["n_chars"] = out.n_chars.astype("Int64")
    return out


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def rows_of(pdf):
    return [tuple(None if pd.isna(v) else (int(v) if c in ("doc_id", "n_chars") else v) for c, v in zip(pdf.columns, r, strict=True)) for r in pdf.itertuples(index=False)]


@pytest.fixture(scope="session")
def docs(spark, docs_pdf):
    """The rows, with extra columns whose names clash with those of results and intermediate steps."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows_of(docs_pdf[["doc_id", "text", "lang", "source", "n_chars"]]), SCHEMA)
    for name in ("score", "spans", "held_out", "predicted", "fp", "component_id", "rank", "block", "group", "bin", "length", "rest", "slot", "word"):
        df = df.withColumn(name, F.lit("clash"))
    return df.repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="session")
def no_labels(labels):
    return labels.limit(0)
