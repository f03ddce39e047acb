"""Benchmark decontamination: an Aho-Corasick automaton over normalised benchmark windows.

Texts are normalised to words of digits, lower-case letters and non-ASCII characters with one blank
between them. A window is ``window`` consecutive words of a benchmark item; an item with fewer words is
one window. One automaton of all windows reads each text once; a match is mapped back through word
positions to character offsets of the original text.

The benchmark is a stated query set. It is read in blocks of at most ``block_windows`` windows, and each
block makes one automaton that is broadcast as its word list, so what is broadcast has a fixed bound; the
usual benchmark is one block. Hits of several blocks are united per document as word ranges. Documents are
never shuffled.

Defined cases: a null or empty text has no words and no hits; a null or empty item has no window; equal
windows of several items count for each of them; repeated item ids count once per document; repeated
documents give one row each. Other columns are kept by :func:`clean_documents` and not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import arrow_map, store, table, texts
from llm.registry import query

# ASCII letters to lower case, all other ASCII but digits to blanks; bytes of other characters stay.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32 for b in range(256)
)
# The same words in a text as it is.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
BLOCK_WINDOWS = 200_000


def fold(text: str) -> list[bytes]:
    """Normalised words of a text."""
    return text.encode().translate(_FOLD).split()


def windows(items: DataFrame, window: int, item_id: str = "item_id", text: str = "text") -> Iterator[tuple[str, int, str]]:
    """(window, its number of words, item id), streamed to the driver partition by partition."""
    for row in items.select(F.col(item_id).cast("string"), F.col(text)).toLocalIterator():
        words = fold(row[1] or "")
        seen = {b" ".join(words[i : i + window]) for i in range(max(len(words) - window, 0) + 1)} if words else ()
        for one in seen:
            yield one.decode("latin-1"), one.count(b" ") + 1, row[0]


def blocks(items: DataFrame, window: int, block_windows: int, **names: str) -> Iterator[dict[str, tuple[int, list[str]]]]:
    """Windows with their item ids, in blocks of bounded size."""
    block: dict[str, tuple[int, list[str]]] = {}
    size = 0
    for text, words, item in windows(items, window, **names):
        block.setdefault(text, (words, []))[1].append(item)
        size += 1
        if size >= block_windows:
            yield block
            block, size = {}, 0
    if block:
        yield block


_AUTOMATA: dict[int, object] = {}


def _automaton(broadcast):
    """One automaton per Python worker and block, kept between tasks; none for a benchmark without words."""
    if not broadcast.value:
        return None
    if broadcast.id not in _AUTOMATA:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for text, found in broadcast.value.items():
            # blanks at both ends keep matches to whole words
            automaton.add_word(f" {text} ", found)
        automaton.make_automaton()
        _AUTOMATA.clear()
        _AUTOMATA[broadcast.id] = automaton
    return _AUTOMATA[broadcast.id]


class _Block:
    """A block's broadcast with a key that tells it from others in a worker."""

    def __init__(self, spark: SparkSession, block: dict):
        self.data = spark.sparkContext.broadcast(block)
        self.id = self.data._jbroadcast.id()

    def __getstate__(self):
        return self.data, self.id

    def __setstate__(self, state):
        self.data, self.id = state

    @property
    def value(self):
        return self.data.value


def scan_text(text: str, automaton) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, ranges of hit words, and the items that occur."""
    words = fold(text)
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    found = list(automaton.iter(line)) if words and automaton is not None else []
    if not found:
        return len(words), [], set()
    # number of words that end before each character: blanks so far
    blanks = np.cumsum(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
    ranges, items = [], set()
    for end, (n, ids) in found:
        last = int(blanks[end]) - 1
        ranges.append((last - n, last))
        items.update(ids)
    return len(words), merge(ranges), items


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching half-open ranges united."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(ranges):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def spans_in_text(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets of word ranges in the original text, end exclusive."""
    places = [m.span() for m in _WORD.finditer(text)] if ranges else []
    return [(places[a][0], places[b - 1][1]) for a, b in ranges]


_SCAN = "{key} long, n_words long, ranges array<struct<begin:int,end:int>>, items array<string>, spans array<struct<begin:int,end:int>>"
_RANGE = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))


def _scan_block(docs: DataFrame, block: _Block, key: str, text: str) -> DataFrame:
    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        automaton = _automaton(block)
        raw = texts(batch.column(1))
        rows = [scan_text(x, automaton) for x in raw]
        pairs = lambda found: [{"begin": a, "end": b} for a, b in found]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([n for n, _, _ in rows], pa.int64()),
                pa.array([pairs(r) for _, r, _ in rows], _RANGE),
                pa.array([sorted(i) for _, _, i in rows], pa.list_(pa.string())),
                pa.array([pairs(spans_in_text(x, r)) for x, (_, r, _) in zip(raw, rows, strict=True)], _RANGE),
            ],
            names=[key, "n_words", "ranges", "items", "spans"],
        )

    return arrow_map(docs.select(F.col(key).cast("long").alias(key), F.col(text).alias(text)), scan, _SCAN.format(key=f"`{key}`"))


def scan(docs: DataFrame, items: DataFrame, window: int = 10, key: str = "doc_id", text: str = "text", block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """(key, n_words, ranges, items, spans) per document: hit words as ranges, the items with occurring
    windows, and the hits as character offsets of the original text."""
    spark = docs.sparkSession
    found = [_Block(spark, block) for block in blocks(items, window, block_windows)] or [_Block(spark, {})]
    if len(found) == 1:
        return _scan_block(docs, found[0], key, text)
    # several blocks: each document meets each block, and what it hits is united
    stored = store(docs.select(F.col(key).alias(key), F.col(text).alias(text), F.expr("uuid()").alias("_row")), "decontamination")
    parts = None
    for block in found:
        hit = _scan_block(stored.select(F.xxhash64("_row").alias("_row"), text), block, "_row", text)
        parts = hit if parts is None else parts.unionByName(hit)
    united = parts.groupBy("_row").agg(
        F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("ranges")).alias("ranges"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.flatten(F.collect_list("spans")).alias("spans"),
    )
    united = united.withColumns({c: _merged(F.col(c)) for c in ("ranges", "spans")})
    return stored.select(key, F.xxhash64("_row").alias("_row")).join(united, "_row").drop("_row")


def _merged(column):
    """Overlapping and touching ranges of an array united, as :func:`merge` does."""
    def step(done, one):
        last = F.try_element_at(done, F.lit(-1))
        joined = F.struct(last["begin"].alias("begin"), F.greatest(last["end"], one["end"]).alias("end"))
        return F.when(last.isNotNull() & (one["begin"] <= last["end"]),
                      F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(done, F.array(one)))

    return F.aggregate(F.array_sort(column), F.slice(column, 1, 0), step)


def report(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """The digest of a scan: hit words, items and whether a document is contaminated."""
    n_hit = F.aggregate("ranges", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["begin"])
    return found.select(
        key, "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("ranges") > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, window: int = 10, text: str = "text") -> DataFrame:
    """The documents that hold no benchmark window, as they are; works on whole rows, so null and
    repeated keys do no harm. Blocks of a large benchmark are applied one after the other."""
    spark = docs.sparkSession
    clean = docs
    for block in blocks(items, window, BLOCK_WINDOWS):
        sent = _Block(spark, block)

        @F.pandas_udf("boolean")
        def hit(column, sent=sent):
            automaton = _automaton(sent)
            return column.map(lambda x: any(True for _ in automaton.iter(
                (b" " + b" ".join(fold(x or "")) + b" ").decode("latin-1"))))

        clean = clean.where(~hit(F.col(text)))
    return clean


_SQL = r"""
with low as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t,
         row_number() over () as r from documents),
doc as (select r, doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from low),
item as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
win as (
  select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as g
  from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as i
        from (select item_id, w, least(len(w), 10) as n from item where len(w) > 0))),
place as (
  select r, n, i, array_to_string(w[i:i + n - 1], ' ') as g
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i
        from doc, (select distinct n from win) where len(w) >= n)),
hit as (select r, i, place.n, item_id from place join win on place.g = win.g and place.n = win.n),
word as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from hit) group by r),
its as (select r, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as ids
        from hit group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc left join word using (r) left join its using (r)
"""


@query("op1_decontamination", _SQL)
def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return report(scan(table(spark, folder, "documents"), table(spark, folder, "benchmark")))
