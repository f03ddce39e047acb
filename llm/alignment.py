"""Alignment of two tokenizers' tokens over the same bytes, and corpus-wide counts of linked ids.

Both tokenizations of a text are byte lengths that add up to the same total. Offsets where both have a token's end
cut them into groups. Most groups are one token to one token, in long runs: the *diagonal*, where the two arrays of
ends agree at a constant shift of their indexes. Such runs are jumped by exponential probing (16, 32, 64, .. ends are
compared at once, and the first difference is found in the slice that differs); an irregular group is resolved by
stepping the side that is behind, after which the shift is taken anew. From a common end on, ends agree just as long
as the lengths between them do, so the arrays are kept as their steps, in bytes.

Corpus-wide counts use a table of distinct pairs per *block* of documents, so a pair that every document holds
travels once a block and not once a document:

    1. Each task aligns its documents and stores, per document, its pairs by number, and per block the distinct
       pairs with their document counts.
    2. The blocks' pairs are added up; the highest count of an A id is a table of one row per vocabulary entry,
       so that one is broadcast, and nothing else.
    3. Counts go back to the blocks, where each document adds up its own.

A block has a bounded number of characters, one document at least.

Defined cases: texts that are null, empty, or not spelt by either tokenizer's bytes have no tokens (zeros, an empty
digest) and count for no pair; null keys and repeated rows are kept, each a document of its own; other columns are
not read. Links inside one group are all its pairs; a very long group is counted by its distinct ids.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import store, table
from llm.registry import query

BLOCK_CHARS = 32_000_000
BATCH_CHARS = 1_000_000  # characters that are tokenized together, one document at least
LIST_PAIRS = 50_000  # pairs in a stored row of a block's list
PLAIN_LINKS = 1_000_000  # links of a group that are listed one by one
FIRST_PROBE = 16  # bytes of the first slices that are compared
ROW_SHIFT = 40  # bits of an id pair


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_of_letter() -> dict[str, int]:
    """The byte each letter of a byte-level piece stands for: printable bytes stand for themselves, the rest,
    in order, for the code points from 256."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


# Fixed value: how byte-level tokenizers cut a text into pieces before they merge bytes.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_level_encoder(json_text: str):
    """A function of texts to arrays of ids, special tokens' strings as plain text, and whether these always spell the text.

    Where the file has plain byte-level merges whose ids ascend, they are ranks, and tiktoken gives the same ids
    in a fifth of the time; any other file is left to the tokenizers library.
    """
    told = json.loads(json_text)
    vocabulary, letters = told["model"]["vocab"], byte_of_letter()
    merged = [vocabulary["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in told["model"].get("merges", [])]
    cut = told.get("pre_tokenizer") or {}
    plain = (
        told.get("normalizer") is None and cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space")
        and merged == sorted(merged) and not told["model"].get("ignore_merges")
    )
    if plain:
        import tiktoken

        special = {t["content"] for t in told.get("added_tokens", [])}
        ranks = {bytes(map(letters.get, piece)): i for piece, i in vocabulary.items() if piece not in special}
        encoding = tiktoken.Encoding("byte-level", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        return (lambda values: [encoding.encode_to_numpy(x, disallowed_special=()) for x in values]), True
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(json_text)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.encode_special_tokens = True
    return (lambda values: [np.array(x.ids, np.uint32) for x in tokenizer.encode_batch_fast(values, add_special_tokens=False)]), False


class Pair:
    """Both tokenizers and the bytes of each of their ids."""

    def __init__(self, json_text: str, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece

        told, letters = json.loads(json_text), byte_of_letter()
        vocabulary = told["model"]["vocab"] | {t["content"]: t["id"] for t in told.get("added_tokens", [])}
        self.a, self.lossless = byte_level_encoder(json_text)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            self.a_bytes[i] = bytes(map(letters.get, piece)) if all(c in letters for c in piece) else piece.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.b_bytes = [piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.step = "u1" if max(map(len, self.a_bytes + self.b_bytes)) < 256 else "<u4"
        self.a_steps, self.b_steps = (np.array(list(map(len, x)), self.step) for x in (self.a_bytes, self.b_bytes))
        # ids as text, inside a group and at its end
        self.a_names, self.b_names = (
            [np.array([b"%d%s" % (i, end) for i in range(n)], object) for end in (b",", last)]
            for n, last in ((len(self.a_bytes), b"|"), (len(self.b_bytes), b";"))
        )

    def encode(self, values: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids by A and by B of each text, empty where either does not spell it."""
        for value, a, b in zip(values, self.a([" " + x for x in values]), self.b.encode(values, num_threads=1), strict=True):
            want = (" " + value).encode()
            if (
                value and b"".join(map(self.b_bytes.__getitem__, b)) == want
                and (self.lossless or b"".join(map(self.a_bytes.__getitem__, a.tolist())) == want)
            ):
                yield a.astype(np.int64), np.array(b, np.int64)
            else:
                yield np.zeros(0, np.int64), np.zeros(0, np.int64)


def piece_bytes(piece: str) -> bytes:
    """UTF-8 of a piece with U+2581 as space; ``<0xHH>`` is the byte HH."""
    single = re.fullmatch(r"<0x([0-9A-F]{2})>", piece)
    return bytes([int(single[1], 16)]) if single else piece.replace("▁", " ").encode()


_PAIRS: dict[int, Pair] = {}


def _worker_pair(broadcast) -> Pair:
    """One pair of tokenizers per Python worker, kept between tasks."""
    key = hash(broadcast.value)
    if key not in _PAIRS:
        _PAIRS.clear()
        _PAIRS[key] = Pair(*broadcast.value)
    return _PAIRS[key]


def segments(a: bytes, b: bytes, unit: str = "u1") -> list[int]:
    """Stretches (i, j, n, 0) of n one-to-one groups and single groups (i, j, p, q) of p to q tokens, in order and one
    after the other in one list, from both sides' steps. No step is 0, and both sides add up to the same."""
    size = np.dtype(unit).itemsize
    steps_a, steps_b = (a, b) if size == 1 else (np.frombuffer(x, unit).tolist() for x in (a, b))
    i = j = 0
    n = len(steps_a)
    out: list[int] = []
    number = int.from_bytes
    while i < n:
        # how long the ends agree one to one: probe a slice, and twice as much while it agrees
        x, y, probe = i * size, j * size, FIRST_PROBE
        left, right = a[x : x + probe], b[y : y + probe]
        while left == right and len(left) == probe:
            x, y, probe = x + probe, y + probe, 2 * probe
            left, right = a[x : x + probe], b[y : y + probe]
        if left == right:
            x += len(left)
        elif differ := number(left, "little") ^ number(right, "little"):
            x += min((differ & -differ).bit_length() - 1 >> 3, len(left), len(right))
        else:  # one side has ended, and the other goes on with zero bytes
            x += min(len(left), len(right))
        if run := x // size - i:
            out += (i, j, run, 0)
            i, j = i + run, j + run
            if i == n:
                break
        x, y = i + 1, j + 1
        ahead = steps_a[i] - steps_b[j]
        while ahead:
            if ahead < 0:
                ahead += steps_a[x]
                x += 1
            else:
                ahead -= steps_b[y]
                y += 1
        out += (i, j, x - i, y - j)
        i, j = x, y
    return out


def groups_text(pair: Pair, a: np.ndarray, b: np.ndarray, found: np.ndarray) -> np.ndarray:
    """``a1,a2|b1;a3|b2,b3;`` over several documents' joined ids, a part per token."""
    _, _, p, q = found.T
    stretch = q == 0
    n = np.where(stretch, p, 1)
    size_a, size_b = np.repeat(np.where(stretch, 1, p), n), np.repeat(np.where(stretch, 1, q), n)
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
    out = np.empty(len(a) + len(b), object)
    # A's tokens of a group stand behind B's tokens of all groups before, B's behind A's up to this one
    for ids, names, ends, sizes, before in ((a, pair.a_names, end_a, size_a, end_b - size_b), (b, pair.b_names, end_b, size_b, end_a)):
        text = names[0][ids]
        text[ends - 1] = names[1][ids[ends - 1]]
        out[np.arange(len(ids)) + np.repeat(before, sizes)] = text
    return out


def links(a: np.ndarray, b: np.ndarray, found: np.ndarray, row: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, pair, n) of the linked id pairs ``a * width + b`` of several documents, each pair once a row,
    ascending. ``found`` holds segments over the documents' joined ids, ``row`` the document of each."""
    i, j, p, q = found.T
    n = np.where(q > 0, p * q, p)
    long = (q > 0) & (n > PLAIN_LINKS)
    i, j, q, n, rows = (x[~long] for x in (i, j, q, n, row))
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    wide = np.repeat(q, n)
    across = np.maximum(wide, 1)
    pairs = a[np.repeat(i, n) + within // across] * width + b[np.repeat(j, n) + np.where(wide > 0, within % across, within)]
    keys, counts = np.unique(pairs + (np.repeat(rows, n) << ROW_SHIFT), return_counts=True)
    for g in np.flatnonzero(long):
        i, j, p, q = found[g]
        ids_a, n_a = np.unique(a[i : i + p], return_counts=True)
        ids_b, n_b = np.unique(b[j : j + q], return_counts=True)
        more = (ids_a[:, None] * width + ids_b).ravel() + (row[g] << ROW_SHIFT)
        both, place = np.unique(np.concatenate([keys, more]), return_inverse=True)
        total = np.zeros(len(both), np.int64)
        np.add.at(total, place, np.concatenate([counts, np.outer(n_a, n_b).ravel()]))
        keys, counts = both, total
    return keys >> ROW_SHIFT, keys & ((1 << ROW_SHIFT) - 1), counts


_CODED = "block long, row_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, data binary, first long, pairs array<long>, held array<int>"
_SCHEMA = pa.schema([
    ("block", pa.int64()), ("row_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("groups_sha256", pa.string()), ("data", pa.binary()), ("first", pa.int64()), ("pairs", pa.list_(pa.int64())), ("held", pa.list_(pa.int32())),
])


def _packed(steps: np.ndarray, counts: np.ndarray) -> bytes:
    """A document's pair numbers, as steps, and their links, byte plane by byte plane."""
    both = np.concatenate([steps, counts]).astype("<u4")
    return zstandard.compress(both.view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    both = np.ascontiguousarray(planes.T).reshape(-1).view("<u4").astype(np.int64)
    steps, counts = np.split(both, 2)
    return np.cumsum(steps), counts


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)


def _block_rows(block: int, docs: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows of a block: its documents, then its distinct pairs with the documents that hold them. Pairs are
    numbered by how many documents hold them, the most common first, so a document's steps are small."""
    ends = np.cumsum([len(d[-2]) for d in docs])
    pairs, place, held = np.unique(np.concatenate([d[-2] for d in docs]), return_inverse=True, return_counts=True)
    order = np.argsort(-held, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    out, size = [], 0
    for (row_id, *digest, _, counts), numbers in zip(docs, np.split(rank[place], ends[:-1]), strict=True):
        by_number = np.argsort(numbers)
        data = _packed(np.diff(numbers[by_number], prepend=0), counts[by_number])
        out.append((block, row_id, *digest, data, None, None, None))
        size += len(data)
        if size > 4_000_000 or len(out) >= 5000:
            yield _rows(out)
            out, size = [], 0
    if out:
        yield _rows(out)
    pairs, held = pairs[order], held[order]
    for first in range(0, len(pairs), LIST_PAIRS):
        part = slice(first, first + LIST_PAIRS)
        yield _rows([(block, None, None, None, None, None, None, None, first, pairs[part].tolist(), held[part].tolist())])


def code_pairs(docs: DataFrame, tokenizers, key: str, text: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Step 1: a row per document (``data`` set) and rows of each block's pairs (``pairs`` set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pair = _worker_pair(tokenizers)
        width = len(pair.b_bytes)
        block, rows, chars = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            ids, values = batch.column(0).to_pylist(), [x or "" for x in batch.column(1).to_pylist()]
            start = 0
            while start < len(values):
                stop, size = start, 0
                while stop < len(values) and (stop == start or size + len(values[stop]) <= BATCH_CHARS):
                    size += len(values[stop])
                    stop += 1
                if rows and chars + size > block_chars:
                    yield from _block_rows(block, rows)
                    block, rows, chars = block + 1, [], 0
                rows.extend(zip(ids[start:stop], *zip(*_aligned(pair, values[start:stop], width), strict=True), strict=True))
                start, chars = stop, chars + size
        if rows:
            yield from _block_rows(block, rows)

    return docs.select(F.col(key).cast("long").alias("row_id"), F.col(text).alias("text")).mapInArrow(run, _CODED)


def _aligned(pair: Pair, values: list[str], width: int) -> list[tuple]:
    """(n_a, n_b, n_groups, n_links, groups_sha256, pairs, links of each) per text."""
    docs = list(pair.encode(values))
    n_a, n_b = (np.array([len(d[k]) for d in docs]) for k in (0, 1))
    a, b = (np.concatenate([d[k] for d in docs]) for k in (0, 1))
    own = [np.array(segments(pair.a_steps[x].tobytes(), pair.b_steps[y].tobytes(), pair.step), np.int64).reshape(-1, 4) for x, y in docs]
    row = np.repeat(np.arange(len(docs)), list(map(len, own)))
    found = np.concatenate(own)
    found[:, 0] += (np.cumsum(n_a) - n_a)[row]
    found[:, 1] += (np.cumsum(n_b) - n_b)[row]
    told = groups_text(pair, a, b, found)
    n_groups = np.bincount(row, np.where(found[:, 3] == 0, found[:, 2], 1), len(docs)).astype(np.int64)
    rows, pairs, counts = links(a, b, found, row, width)
    cuts = np.searchsorted(rows, np.arange(1, len(docs)))
    return [
        (x, y, g, int(c.sum()), hashlib.sha256(b"".join(t.tolist())[:-1]).hexdigest() if x else "", f, c)
        for x, y, g, t, f, c in zip(
            n_a.tolist(), n_b.tolist(), n_groups.tolist(), np.split(told, np.cumsum(n_a + n_b)[:-1]), np.split(pairs, cuts), np.split(counts, cuts), strict=True)
    ]


def pair_counts(coded: DataFrame, width: int) -> DataFrame:
    """(pair, n, is_best) of every linked id pair: documents that hold it, and whether no pair of its A id has more."""
    listed = coded.where("pairs is not null").select(F.explode(F.arrays_zip("pairs", "held")).alias("x"))
    counted = store(listed.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.held").alias("n")), "pair-counts")
    a = F.expr(f"pair div {width}")
    highest = counted.groupBy(a.alias("a")).agg(F.max("n").alias("highest"))
    return (
        counted.withColumn("a", a).join(F.broadcast(highest), "a")  # one row per vocabulary entry of A
        .select("pair", "n", (F.col("n") == F.col("highest")).alias("is_best"))
    )


def align(docs: DataFrame, key: str = "doc_id", text: str = "text", paths: tuple[str, str] | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document."""
    a_path, b_path = paths or default_paths()
    json_text, model = Path(a_path).read_text(encoding="utf-8"), Path(b_path).read_bytes()
    tokenizers = docs.sparkSession.sparkContext.broadcast((json_text, model))
    width = len(Pair(json_text, model).b_bytes)
    coded = store(code_pairs(docs, tokenizers, key, text, block_chars), "aligned")
    places = coded.where("pairs is not null").select(F.col("block").alias("home"), "first", F.posexplode("pairs").alias("at", "pair"))
    known = places.join(pair_counts(coded, width), "pair").select("home", (F.col("first") + F.col("at")).cast("int").alias("place"), "n", "is_best")
    fields = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def meet(documents: pa.Table, counted: pa.Table) -> pa.Table:
        place = counted.column("place").to_numpy()
        n, best = np.zeros(len(place), np.int64), np.zeros(len(place), bool)
        n[place], best[place] = counted.column("n").to_numpy(), counted.column("is_best").to_numpy()
        n_best, count_sum = [], []
        for data in documents.column("data").to_pylist():
            numbers, counts = _unpacked(data)
            n_best.append(int(counts[best[numbers]].sum()))
            count_sum.append(int((counts * n[numbers]).sum()))
        columns = {key: documents.column("row_id")} | {c: documents.column(c) for c in fields}
        return pa.table(columns | {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())})

    schema = f"`{key}` long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    documents = coded.where("data is not null").select("block", "row_id", *fields, "data")
    return documents.groupBy("block").cogroup(known.groupBy("home")).applyInArrow(meet, schema)


@query("op13_alignment")
def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align(table(spark, folder, "documents"))
