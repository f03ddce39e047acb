"""Byte-pair encoding and decoding through a table of distinct words.

Encoding
    1. Each task cuts its documents into words, numbers the distinct words of a *block* of documents
       and stores word numbers per document beside the block's word list (shared folder).
    2. Word lists are dealt out by a hash of the word, so all blocks' copies of a word meet in one
       task, which encodes it once. The ids go back to the blocks.
    3. Each block meets its ids, and its documents take them by position.

A block has a bounded number of characters (one document at least), a word list is cut by hash into as
many parts as Spark shuffles to, so no group grows with the data, and a word that every document holds
travels once per block. Nothing is broadcast but the tokenizer and its id-to-piece table.

Decoding joins ids to pieces on the map side: the table is the vocabulary, whose size is fixed.

Defined cases: a null or empty text has no ids and decodes to the empty text; null ids of documents and
repeated rows are kept, one result per row; columns other than the key and the text are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import store, table
from llm.registry import query
from llm.words_bpe import load_tokenizer, split_words, worker_encoder

BLOCK_CHARS = 32_000_000
ROW_WORDS = 200_000  # word numbers in a stored row, if not one document has more
_CODED = "block long, part int, row_ids array<long>, data binary, size long"
_IDS = "block long, data binary, size long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _planes(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit integers, compressed byte plane by byte plane."""
    return zstandard.compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 9)


def _unplanes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4")


def _pack(*parts: bytes) -> bytes:
    """Byte strings in one, each after its length."""
    return b"".join(len(x).to_bytes(4, "little") + x for x in parts)


def _unpack(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        size = int.from_bytes(data[at : at + 4], "little")
        out.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    return out


def _block_rows(block: int, docs: list[tuple], known: dict[bytes, int], parts: int) -> Iterator[tuple]:
    """Rows of a block: word numbers of some documents (part -1), or one part of the word list.

    Frequent words get small numbers, which compress well; words of equal use are numbered by part and
    alphabet, so a part's numbers and spellings run on.
    """
    uses = np.bincount(np.concatenate([numbers for _, numbers in docs]), minlength=len(known))
    words = list(known)
    part_of = [zlib.crc32(w) % parts for w in words]
    order = sorted(range(len(words)), key=lambda i: (-uses[i], part_of[i], words[i]))
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    start = 0
    while start < len(docs):
        stop, size = start, 0
        while stop < len(docs) and (stop == start or size + len(docs[stop][1]) <= ROW_WORDS):
            size += len(docs[stop][1])
            stop += 1
        ids = [row_id for row_id, _ in docs[start:stop]]
        counts = np.array([len(numbers) for _, numbers in docs[start:stop]], np.uint32)
        yield block, -1, ids, _pack(_planes(counts), _planes(rank[np.concatenate([n for _, n in docs[start:stop]])])), size
        start = stop
    by_part: dict[int, list[int]] = {}
    for number in order:
        by_part.setdefault(part_of[number], []).append(number)
    for part, numbers in by_part.items():
        listed = zstandard.compress(b"\n".join([words[i] for i in numbers]), 9)
        yield block, part, None, _pack(_planes(np.diff(rank[numbers], prepend=np.uint32(0))), listed), len(numbers)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
    )


def code_words(docs: DataFrame, key: str, text: str, parts: int, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Step 1: word numbers per document and word lists per block."""
    schema = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("row_ids", pa.list_(pa.int64())), ("data", pa.binary()), ("size", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        rows, known, chars = [], {}, 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal rows, known, chars, block
            out, size = [], 0
            for row in _block_rows(block, rows, known, parts):
                out.append(row)
                size += len(row[3])
                if size > 8_000_000 or len(out) >= 5000:
                    yield _batch(out, schema)
                    out, size = [], 0
            if out:
                yield _batch(out, schema)
            rows, known, chars, block = [], {}, 0, block + 1

        for batch in batches:
            for row_id, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = split_words(value or "")
                if rows and chars + len(value or "") > block_chars:
                    yield from flush()
                rows.append((row_id, np.array([known.setdefault(w, len(known)) for w in words], np.uint32)))
                chars += len(value or "")
        if rows:
            yield from flush()

    narrow = docs.select(F.col(key).cast("long").alias("row_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(run, _CODED)


def encode_lists(lists: DataFrame, parts: int, tokenizer) -> DataFrame:
    """Step 2: ids of each word list's words; equal words of all blocks meet in one task."""
    schema = pa.schema([("block", pa.int64()), ("data", pa.binary()), ("size", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer)
        for batch in batches:
            rows = []
            for block, data, size in zip(*(batch.column(c).to_pylist() for c in ("block", "data", "size")), strict=True):
                numbers, listed = _unpack(data)
                ids, lengths = encoder.encode_flat(zstandard.decompress(listed).split(b"\n"))
                rows.append((block, _pack(numbers, _planes(lengths), _planes(ids)), size))
            yield _batch(rows, schema)

    return lists.select("part", "block", "data", "size").repartition(parts, "part").mapInArrow(run, _IDS)


def _block_ids(lists: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word number of a block: where its ids start and how many they are; and all ids."""
    numbers, lengths, ids = [], [], []
    for data in lists.column("data").to_pylist():
        number, length, flat = map(_unplanes, _unpack(data))
        numbers.append(np.cumsum(number, dtype=np.int64))
        lengths.append(length.astype(np.int64))
        ids.append(flat)
    if not numbers:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
    number, length, flat = map(np.concatenate, (numbers, lengths, ids))
    begin = np.cumsum(length) - length
    starts, counts = np.empty_like(begin), np.empty_like(length)
    starts[number], counts[number] = begin, length
    return starts, counts, flat


def _spread(words: np.ndarray, starts: np.ndarray, counts: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """Ids of a document from its word numbers."""
    n = counts[words]
    ends = np.cumsum(n)
    return flat[np.repeat(starts[words] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]


def encode_with(docs: DataFrame, key: str, text: str, tokenizer_path: str, finish, schema: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Steps 1 to 3. ``finish(row_ids, ids)`` makes an Arrow table of some documents' ids."""
    spark = docs.sparkSession
    tokenizer = spark.sparkContext.broadcast(Path(tokenizer_path).read_text(encoding="utf-8"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    coded = store(code_words(docs, key, text, parts, block_chars), "bpe-words")
    ids = encode_lists(coded.where("part >= 0"), parts, tokenizer)

    def meet(documents: pa.Table, lists: pa.Table) -> pa.Table:
        starts, counts, flat = _block_ids(lists)
        out = []
        for row_ids, data in zip(documents.column("row_ids").to_pylist(), documents.column("data").to_pylist(), strict=True):
            sizes, numbers = map(_unplanes, _unpack(data))
            words = np.split(numbers, np.cumsum(sizes)[:-1])
            out.append(finish(row_ids, [_spread(w, starts, counts, flat) for w in words]))
        return pa.concat_tables(out) if out else finish([], [])

    return (
        coded.where("part = -1").select("block", "row_ids", "data")
        .groupBy("block").cogroup(ids.groupBy("block"))
        .applyInArrow(meet, schema)
    )


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer_path: str | None = None) -> DataFrame:
    """(key, ids): the ids of every whole text."""

    def finish(row_ids, ids):
        # lists of one Arrow table stay far below 2^31 ids: a row holds ROW_WORDS words, or one document
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
        flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
        return pa.table({key: pa.array(row_ids, pa.int64()), "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))})

    return encode_with(docs, key, text, tokenizer_path or default_tokenizer(), finish, f"`{key}` long, ids array<int>")


def piece_table(spark: SparkSession, tokenizer_path: str | None = None) -> DataFrame:
    """(id, piece) of a tokenizer, added tokens included."""
    vocabulary = load_tokenizer(Path(tokenizer_path or default_tokenizer()).read_text(encoding="utf-8")).get_vocab(with_added_tokens=True)
    return spark.createDataFrame([(i, piece) for piece, i in vocabulary.items()], "id int, piece string")


def decode(encoded: DataFrame, pieces: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, decoded): pieces joined by blanks, for tokenizers that name no decoder of their own.

    A join of ids to pieces by position. The pieces are a vocabulary, so they are broadcast. Ids
    without a piece are left out.
    """
    # numbered before the explode, which would number each id on its own
    numbered = encoded.select(F.monotonically_increasing_id().alias("_row"), F.col(key).alias("_key"), "ids")
    rows = numbered.select("_row", "_key", F.posexplode_outer("ids").alias("_at", "id"))
    joined = rows.join(F.broadcast(pieces), "id", "left")
    return joined.groupBy("_row").agg(
        F.first("_key").alias(key),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("piece").isNotNull(), F.struct("_at", "piece")))), lambda x: x["piece"]), " ").alias("decoded"),
    ).drop("_row")


def _piece_lookup(spark: SparkSession, tokenizer_path: str):
    vocabulary = load_tokenizer(Path(tokenizer_path).read_text(encoding="utf-8")).get_vocab(with_added_tokens=True)
    pieces = [b""] * (max(vocabulary.values()) + 1)
    for piece, i in vocabulary.items():
        pieces[i] = piece.encode()
    return spark.sparkContext.broadcast(pieces)


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer_path: str | None = None) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): encoding, then decoding of those ids."""
    path = tokenizer_path or default_tokenizer()
    lookup = _piece_lookup(docs.sparkSession, path)

    def finish(row_ids, ids):
        pieces = np.array(lookup.value, object)
        return pa.table({
            key: pa.array(row_ids, pa.int64()),
            "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], pa.string()),
            "decoded_sha256": pa.array([hashlib.sha256(b" ".join(pieces[x].tolist())).hexdigest() for x in ids], pa.string()),
        })

    return encode_with(docs, key, text, path, finish, f"`{key}` long, n_tokens long, ids_sha256 string, decoded_sha256 string")


@query("op9_bpe")
def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return digests(table(spark, folder, "documents"))
