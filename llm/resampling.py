"""Importance resampling towards a target: documents drawn by how much likelier their n-grams are in the target.

Words come from the bytes: a table of 256 entries lower-cases A-Z and blanks separators, ``bytes.split`` cuts. The
crc32 of an n-gram is the crc32 of its next word, seeded with the n-gram before it, so longer n-grams cost one call
each and no joined string. Each task counts its buckets in one ``Counter``; Spark adds the Counters up.

    1. Bucket counts of source and target: one row per task and bucket leaves a task, so the shuffle is bounded by
       tasks x buckets, whatever the texts hold.
    2. The gains, one number per bucket, go to the driver and back as a broadcast. Their number is the parameter.
    3. A second scan gives each document its mean gain and its seeded Gumbel noise. The draw is a global numbering
       by score: a range sort of narrow rows.

Texts are read in slices of a set number of bytes that carry the last words over, so a very long text takes no more
memory than its own bytes.

Defined cases: a null or empty text has no words, weight 0, and is never drawn; a null key hashes as the empty string
and comes after all others among ties; repeated rows are separate documents; an empty target or source counts
as zeros; columns other than the key and the text are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import arrow_map, store, table, texts
from llm.registry import query
from millrace.operators.ordering import number_rows

ORDER = 2
BUCKETS = 10_000
SLICE = 1 << 20  # bytes of a text whose words are held at once

_WORD_BYTES = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(0x80, 0x100))
FOLD = bytes(b if b in _WORD_BYTES else 0x20 for b in bytes(range(256)).lower())


def word_slices(text: str, size: int = SLICE) -> Iterator[list[bytes]]:
    """The words of a text, in lists from about ``size`` bytes each."""
    data = text.encode(errors="replace").translate(FOLD)
    start = 0
    while start < len(data):
        stop = data.find(b" ", start + size)
        stop = len(data) if stop < 0 else stop
        yield data[start:stop].split()
        start = stop


def feature_slices(text: str, order: int = ORDER, size: int = SLICE) -> Iterator[tuple[int, list[int]]]:
    """(new words, crc32 of the runs of 1 to ``order`` words that end in them) per slice of a text."""
    carried: list[bytes] = []
    for fresh in word_slices(text, size):
        words = carried + fresh
        runs = list(map(crc32, words))
        found = runs[len(carried):]
        spaced = [b" " + w for w in words]
        for n in range(2, order + 1):
            runs = list(map(crc32, spaced[n - 1 :], runs))
            found += runs[max(len(carried) - n + 1, 0) :]
        yield len(fresh), found
        carried = words[max(len(words) - order + 1, 0) :] if order > 1 else []


def bucket_counts(df: DataFrame, text: str = "text", order: int = ORDER, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[int] = Counter()
        for batch in batches:
            for value in texts(batch.column(0)):
                for _, found in feature_slices(value, order):
                    counts.update((np.array(found, np.uint32) % buckets).tolist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], names=["bucket", "n"]
        )

    parts = df.select(F.col(text).alias("text")).mapInArrow(run, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Per bucket floor(1000 ln(target share / source share)), one added to every count."""
    counted = source.select("bucket", "n", F.lit(0).alias("side")).unionByName(target.select("bucket", "n", F.lit(1).alias("side")))
    counts = np.zeros((2, buckets))
    for row in counted.collect():  # two rows a bucket at most
        counts[row["side"], row["bucket"]] = row["n"]
    total = counts.sum(axis=1)
    ratios = (counts[1] + 1) * (total[0] + buckets) / ((counts[0] + 1) * (total[1] + buckets))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios.tolist()], np.int64)


def gumbel(key: int | None, seed: int) -> int:
    """Seeded noise of a document, in thousandths."""
    h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score_documents(docs: DataFrame, gain: np.ndarray, seed: int = 7, order: int = ORDER, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_features, weight, score) of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        gain = sent.value
        rows = []
        for value in texts(batch.column(1)):
            n_words = n_features = total = 0
            for fresh, found in feature_slices(value, order):
                n_words += fresh
                n_features += len(found)
                total += int(gain[np.array(found, np.uint32) % len(gain)].sum())
            rows.append((n_words, n_features, total // n_features if n_features else 0))
        noise = [gumbel(k, seed) for k in batch.column(0).to_pylist()]
        columns = [[r[i] for r in rows] for i in range(3)]
        columns.append([w + g for w, g in zip(columns[2], noise, strict=True)])
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, pa.int64()) for c in columns]], names=[key, "n_words", "n_features", "weight", "score"]
        )

    narrow = docs.select(F.col(key).cast("long").alias(key), F.col(text).alias("text"))
    return arrow_map(narrow, score, f"`{key}` long, n_words long, n_features long, weight long, score long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, seed: int = 7, order: int = ORDER, buckets: int = BUCKETS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_features, weight, score, rank): the drawn documents have a rank, from 1."""
    gain = gains(bucket_counts(docs, text, order, buckets), bucket_counts(target, text, order, buckets), buckets)
    scored = store(score_documents(docs, gain, seed, order, key, text), "resampling-scores")
    drawn = scored.where(F.col("n_words") >= min_words).count() * percent // 100
    enough = F.col("n_words") >= min_words
    placed = number_rows(scored, [enough.desc(), F.desc("score"), F.asc_nulls_last(key)], "place", start=1)
    return placed.withColumn("rank", F.when(enough & (F.col("place") <= drawn), F.col("place").cast("long"))).drop("place")


@query("op12_resampling")
def op12_resampling(spark: SparkSession, folder: str) -> DataFrame:
    found = resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")
