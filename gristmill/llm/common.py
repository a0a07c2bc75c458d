"""Helpers that the training-data operators share."""

from __future__ import annotations

import contextlib
import ctypes
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.sources.tables import dropped, shared_dir, shuffles_dropped, stored

__all__ = ["dropped", "shared_dir", "shuffles_dropped", "stored"]

#: Longest text, in characters, that a training sample takes; scoring has no such bound.
SAMPLE_TEXT_CHARS = 262_144
#: Most classes of a sample, the most frequent ones.
CLASSES = 1024
#: Fewer sequences than this are gone through one after another.
FEW = 4
#: Most characters, in all, of a class in a labelled sample.
SAMPLE_CHARS = 24_000_000


def remainder(col: str, mod: int) -> Column:
    """crc32 of a column's text form, modulo ``mod``; null for null."""
    return F.pmod(F.crc32(F.col(col).cast("string")), F.lit(mod))


def is_held_out(col: str, mod: int, rest: int) -> Column:
    """Whether the remainder is ``rest``; false for a null id."""
    return F.coalesce(remainder(col, mod) == rest, F.lit(False))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The frame with its lineage cut by a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def give_back() -> None:
    """Returns freed memory to the system at the end of a task; else a worker that is used again holds what its largest task took."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library than glibc
        ctypes.CDLL(None).malloc_trim(0)


def text_chunks(batches: Iterator[pa.RecordBatch], max_chars: int, text: str = "text") -> Iterator[tuple[dict[str, list], list[str]]]:
    """Column lists and texts (null as "") in chunks of about ``max_chars`` characters; one longer text makes a chunk of its own."""
    for batch in batches:
        cols = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names) if n != text}
        texts = [t or "" for t in batch.column(batch.schema.names.index(text)).to_pylist()]
        at, size = 0, 0
        for i, t in enumerate(texts):
            if size and size + len(t) > max_chars:
                yield {n: v[at:i] for n, v in cols.items()}, texts[at:i]
                at, size = i, 0
            size += len(t) + 1
        if at < len(texts):
            yield {n: v[at:] for n, v in cols.items()}, texts[at:]


def map_texts(df: DataFrame, schema: str, make: Callable[[], Callable[[dict, list[str]], dict[str, list]]], max_chars: int = 4_000_000) -> DataFrame:
    """Applies a function to chunks of texts. ``make()`` runs once in each task and returns the function, which gets columns and texts and returns columns."""
    out = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for cols, texts in text_chunks(batches, max_chars):
            yield pa.RecordBatch.from_pydict(f(cols, texts), schema=out)
        del f
        give_back()

    return df.mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def class_sample(df: DataFrame, label: str, per_class: int | dict, key: str = "doc_id") -> DataFrame:
    """About ``per_class`` rows of each class, chosen by a hash of the key, without a shuffle of texts.

    The bound is a threshold on the hash, from an exact count of each class, so the sample is the same
    whatever the partitioning. Rows with a null key or label, or over SAMPLE_TEXT_CHARS, take no part.
    """
    df = df.filter(F.col(label).isNotNull() & F.col(key).isNotNull())
    counts = {r[0]: r[1] for r in df.groupBy(label).count().orderBy(F.desc("count"), label).limit(CLASSES).collect()}
    if not counts:
        return df.limit(0)
    draw = F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1_000_000))
    wanted = F.lit(False)
    for value, n in counts.items():
        wanted = wanted | ((F.col(label) == F.lit(value)) & (draw < int(min(1.0, (per_class if isinstance(per_class, int) else per_class[value]) / n) * 1_000_000 + 0.5)))
    return df.filter(wanted & (F.length("text") <= SAMPLE_TEXT_CHARS) if "text" in df.columns else wanted)


def within_chars(rows: DataFrame, order: Column, chars: int, label: str | None = None) -> list:
    """Rows until their texts have ``chars`` characters (of each label), in an order by a hash; what the driver holds stays bounded."""
    left: dict = {}
    out = []
    for r in rows.withColumn("order_", order).repartition(8, "order_").sortWithinPartitions("order_", "text").toLocalIterator():
        key = r[label] if label else None
        left[key] = left.get(key, chars) - len(r.text)
        if left[key] >= 0 or left[key] + len(r.text) == chars:
            out.append(r)
    return out


def sampled_texts(rows: DataFrame, name: str, total: int, sample: int, chars: int, key: str = "doc_id") -> list[str]:
    """Texts, sorted, of about ``sample`` of ``total`` rows by a hash of the key, and of about ``chars`` characters at most."""
    order = F.xxhash64(F.lit(name), F.col(key))
    drawn = F.pmod(order, F.lit(1_000_000)) < int(min(1.0, sample / max(1, total)) * 1_000_000 + 0.5)
    return sorted(r.text for r in within_chars(rows.filter(drawn & (F.length("text") <= SAMPLE_TEXT_CHARS)).select(key, "text"), order, chars))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int | dict) -> list[tuple[str, int]]:
    """(text, 0 or 1) of about ``per_class`` documents of each class among those whose id satisfies ``learn``.

    The ids are chosen from the labels alone; they are few by the bound, so they are broadcast to the one scan of texts.
    The texts of a class have `SAMPLE_CHARS` characters at most. Of several labels of one document the least holds.
    """
    own = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("y")).filter(F.col("y").isin(0, 1) & learn)
    ids = class_sample(own.groupBy("doc_id").agg(F.min("y").alias("y")), "y", per_class)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter(F.length("text") <= SAMPLE_TEXT_CHARS)
    rows = within_chars(texts.join(F.broadcast(ids), "doc_id"), F.xxhash64(F.lit("sample"), F.col("doc_id")), SAMPLE_CHARS, "y")
    rows.sort(key=lambda r: (r.doc_id, r.text))
    return [(r.text, r.y) for r in rows]


def lockstep(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sequences processed side by side: their order, longest first, and the number still running at each position."""
    order = np.argsort(-lengths, kind="stable")
    longest = int(lengths.max(initial=0))
    active = np.searchsorted(-lengths[order], -np.arange(longest), side="left")
    return order, active


def side_by_side(active: np.ndarray) -> int:
    """Positions up to which sequences are gone through side by side; beyond, so few run on that each goes on its own."""
    return max(1, int(np.searchsorted(-active, -FEW, side="right"))) if len(active) > 256 else len(active)


class _Numbers(dict):
    def __missing__(self, key):
        n = self[key] = len(self)
        return n


class WordTable:
    """Rows of figures for words, worked out once for each distinct word while the table stays below its bounds."""

    def __init__(self, score: Callable[[list[str]], np.ndarray], words: int = 400_000, chars: int = 12_000_000):
        self.score, self.words, self.chars = score, words, chars
        self.clear()

    def clear(self) -> None:
        self.index, self.held, self.size = _Numbers(), 0, 0
        self.rows: np.ndarray | None = None

    def look_up(self, tokens: list[str]) -> np.ndarray:
        """The row of each token, by position."""
        if self.held > self.words or self.size > self.chars:
            self.clear()
        at = np.fromiter(map(self.index.__getitem__, tokens), np.int64, len(tokens))
        if len(self.index) > self.held:
            new = list(itertools.islice(self.index, self.held, None))
            got = self.score(new)
            if self.rows is None:
                self.rows = got[:0]
            if len(self.index) > len(self.rows):
                grown = np.zeros((max(2 * len(self.rows), len(self.index)), *got.shape[1:]), got.dtype)
                grown[: self.held] = self.rows[: self.held]
                self.rows = grown
            self.rows[self.held : len(self.index)] = got
            self.held = len(self.index)
            self.size += sum(map(len, new))
        return at
