"""Token ids as Parquet files with list columns, and reading them back selectively.

Documents are range-sorted by id over all tasks, encoded in place, and written as one file per task: the names
ascend with the ids. Token ids are dictionary-encoded (a vocabulary's ids pack into 16 bits), the sorted ids of
documents and the counts are delta-encoded, row groups and pages have a set size, and Parquet's column and offset
indexes let a reader fetch the counts alone, or the tokens of a few documents.

Defined cases: a null or empty text gives the end id alone; null ids of documents come first; rows that share
an id stand side by side, ordered by a hash of their texts; other columns are not written.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.bpe import default_tokenizer
from llm.common import arrow_map, table
from llm.registry import query
from llm.words_bpe import split_column, worker_encoder
from millrace.session import new_folder

END_ID = 1
BATCH_BYTES = 3 << 20  # of texts whose words are encoded together, if not one document has more


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in runs of whole documents, whose texts (column 1) come to ``BATCH_BYTES`` or to one document."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start, before = 0, 0
    while start < batch.num_rows:
        stop = max(int(np.searchsorted(ends, before + BATCH_BYTES, "right")), start + 1)
        yield batch.slice(start, stop - start)
        start, before = stop, int(ends[stop - 1])


def encode_sorted(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, key: str = "doc_id", text: str = "text", files: int | None = None) -> DataFrame:
    """(key, n_tokens, ids) in ascending order of the key over all partitions."""
    spark = docs.sparkSession
    tokenizer = spark.sparkContext.broadcast(Path(tokenizer_path).read_text(encoding="utf-8"))
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    narrow = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).withColumn("h", F.xxhash64("text"))
    placed = narrow.repartitionByRange(files, "id", "h").sortWithinPartitions("id", "h").select("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer, 500_000)
        for big in batches:
            for batch in _slices(big):
                flat, sizes = encoder.encode_lists(split_column(batch.column(1)))
                counts = sizes + 1
                ends = np.cumsum(counts)
                ids = np.full(len(flat) + len(counts), end_id, "<i4")
                own = np.ones(len(ids), bool)
                own[ends - 1] = False
                ids[own] = flat
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(counts), pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), pa.array(ids))],
                    names=[key, "n_tokens", "ids"],
                )

    return placed.mapInArrow(run, f"`{key}` long, n_tokens long, ids array<int>")


def write_tokens(encoded: DataFrame, path: str, row_group_bytes: int = 64 << 20, page_bytes: int = 1 << 20, page_rows: int = 5000, key: str = "doc_id") -> None:
    """One Parquet file per partition, in partition order."""
    (
        encoded.write
        .option("compression", "zstd")
        .option("parquet.writer.version", "v2")
        .option("parquet.enable.dictionary", "true")
        .option(f"parquet.enable.dictionary#{key}", "false")
        .option("parquet.enable.dictionary#n_tokens", "false")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", page_bytes)
        .option("parquet.page.row.count.limit", page_rows)
        .parquet(path)
    )


def read_index(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, file, row) from the counts alone; the tokens are not read."""
    return with_starts(read_counts(spark, path, key))


def read_counts(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, file, row); no tokens are read."""
    return spark.read.parquet(path).select(key, "n_tokens", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))


def with_starts(rows: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """``start`` from (n_tokens, file, row): all tokens before a document. One row per file is summed in one
    place; inside a file the sum runs in row order. ``counts``, if given, is another (n_tokens, file) of the same
    files that is cheaper to read, for the files' totals."""
    totals = (rows if counts is None else counts).groupBy("file").agg(F.sum("n_tokens").alias("total"))
    before = totals.select("file", F.coalesce(F.sum("total").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumn("inside", inside).join(before, "file").withColumn("start", F.col("before") + F.col("inside") - F.col("n_tokens")).drop("inside", "before")


def read_tokens(spark: SparkSession, path: str, first: int, last: int, key: str = "doc_id") -> DataFrame:
    """(key, ids) of the documents with ids from ``first`` to ``last``: row groups and pages outside are skipped."""
    return spark.read.parquet(path).where(F.col(key).between(first, last)).select(key, "ids")


def checksums(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids_crc32, file, row) from the token lists themselves."""
    files = spark.read.parquet(path).select(key, "ids", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column(1)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        flat = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<u4")).cast("B")
        crc = [zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(offsets)), pa.array(crc, pa.int64()), batch.column(2), batch.column(3)],
            names=[key, "n_tokens", "ids_crc32", "file", "row"],
        )

    return arrow_map(files, run, f"`{key}` long, n_tokens long, ids_crc32 long, file string, row long")


@query("op7_token_files")
def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "tokens")
    write_tokens(encode_sorted(table(spark, folder, "documents"), default_tokenizer()), path)
    return with_starts(checksums(spark, path), read_counts(spark, path)).select("doc_id", "start", "n_tokens", "ids_crc32")
