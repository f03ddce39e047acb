"""Document fingerprints from closed syncmers, with DataFrame functions alone.

A k-mer is K bytes of the UTF-8 text in a row. It is an *anchor* if, of the S-byte strings inside it, the one with
the least hash is the first or the last (at a tie with one further in, the edge wins). Whether it is one depends on
its own bytes only, so an edit elsewhere moves no anchor, and two consecutive anchors are at most K - S bytes apart.
A fingerprint lists, for each anchor in order, 24 bits of its hash and its distance to the anchor before (0 for the
first): seven hex digits each. Two fingerprints match where both agree, which is a match of content and local place
whatever was inserted before. Likeness is the share of matching entries, 2 |A and B| / (|A| + |B|) of distinct ones.

Plan
    1. Documents are laid out by *cells* of 1024 ids; the first document of the cell below is copied to each cell, so
       every document finds its successor inside its cell: one shuffle of the texts, no window over the whole table.
    2. Each text becomes pieces of 32 start positions. Per piece the hashes of its S-byte strings are one array, built
       once by generated code; each start position then compares 16 entries of it. A piece and its overlap are 55
       bytes, so no array grows with a text.
    3. Anchors are few (one in eight bytes). They gather per document inside the same cell, without a shuffle.

Defined cases: null is the empty text, whose fingerprint is empty; a text of 1 to K - 1 bytes is its own only anchor;
two empty fingerprints are alike (1), an empty one and another are not (0). Documents follow each other by descending
id, null ids last; rows that share an id follow by the hash of their texts, equal rows in any order. The successor of
the last document is the first, for a single document itself. Ids that are spread out thinly have cells of few
documents and copy more; a cell grows only with rows that share an id. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.common import store, table
from llm.registry import query
from millrace.operators.ordering import number_rows

K = 24  # bytes of an anchor
S = 9  # bytes of the strings inside it
WIDTH = K - S + 1  # strings inside a k-mer
STARTS = 32  # start positions of a piece
CELL_BITS = 10  # ids of a cell, as a power of two
_NULL_CELLS = -(1 << 60)  # cells of null ids, below all others, by the hash of the text


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(cell, rn, copied, id, text, next): the text of the next document by descending key beside each text.

    Rows with ``copied`` = 1 come after the others of their cell and stand for the cell below.
    """
    narrow = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    hashed = narrow.withColumn("h", F.xxhash64("text"))
    placed = hashed.withColumn("cell", F.coalesce(F.shiftright("id", CELL_BITS), F.lit(_NULL_CELLS) + F.shiftright("h", 40)))
    cells = placed.groupBy("cell").agg(F.max(F.struct("id", "h")).alias("first"))
    numbered = store(number_rows(cells, [F.asc("cell")], "no"), "syncmer-cells")
    n_cells = numbered.agg(F.count("*")).scalar()
    below = numbered.select(((F.col("no") + 1) % n_cells).alias("no"), "first")
    # stored, so its size decides how the texts meet it
    firsts = store(numbered.select("cell", "no").join(below, "no").select(F.col("cell").alias("into"), "first.id", "first.h"), "syncmer-firsts")
    # renamed, as both sides of the union come from one table
    source = placed.select(F.col("id").alias("i"), F.col("h").alias("g"), F.col("text").alias("text"))
    copies = source.join(firsts, F.col("i").eqNullSafe(F.col("id")) & (F.col("g") == F.col("h"))).select(
        F.col("into").alias("cell"), "id", "h", "text", F.lit(1).alias("copied")
    )
    both = placed.select("cell", "id", "h", "text", F.lit(0).alias("copied")).unionByName(copies)
    order = Window.partitionBy("cell").orderBy("copied", F.desc_nulls_last("id"), F.desc("h"))
    return both.select("cell", F.row_number().over(order).alias("rn"), "copied", "id", "text", F.lead("text").over(order).alias("next"))


def edit(text: Column, following: Column) -> Column:
    """The last half of the text, in code points, replaced by as many of the next one's first."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.left(text, n - half), F.left(F.coalesce(following, F.lit("")), half))


def _least(items: list[Column]) -> Column:
    return F.least(*items) if len(items) > 1 else items[0]


def anchors(rows: DataFrame, keys: list[str], head: Column, texts: list[str]) -> DataFrame:
    """(keys, head, at_0, at_1, ..): per row the anchors of each binary column as position * 2^24 + hash, ascending.

    ``keys`` tell the rows apart and start with what the rows are spread by, so nothing is shuffled.
    """
    sizes = [F.greatest(F.ceil((F.length(c) - K + 1) / STARTS), F.lit(1)).cast("int") for c in texts]
    ends = [reduce(Column.__add__, sizes[: i + 1]) for i in range(len(texts))]
    # the list names all binary columns, so generated code takes them from the row once, not once a piece
    cut = rows.select(*keys, head.alias("head"), *texts, *[e.alias(f"end_{i}") for i, e in enumerate(ends)], F.explode_outer(F.sequence(F.lit(0), ends[-1] - 1)).alias("nth"))
    own, begin, which = F.col(texts[0]), F.lit(0), F.lit(0)
    for i in range(1, len(texts)):
        later = F.col("nth") >= F.col(f"end_{i - 1}")
        own, begin, which = F.when(later, F.col(texts[i])).otherwise(own), F.when(later, F.col(f"end_{i - 1}")).otherwise(begin), F.when(later, i).otherwise(which)
    start = (F.col("nth") - begin) * STARTS
    shaped = cut.select(
        *keys, F.when(F.col("nth") == 0, F.col("head")).alias("head"), which.alias("which"), start.alias("start"),
        (F.length(own) - K - start).alias("last"), F.substring(own, start + 1, F.lit(STARTS + K - 1)).alias("piece"),
    )
    strings = [F.xxhash64(F.substring("piece", i + 1, S)) for i in range(STARTS + WIDTH - 1)]
    hashed = shaped.withColumn("strings", F.array(*strings))
    placed = hashed.select("*", F.posexplode_outer("strings").alias("i", "own"))
    inside = [F.get("strings", F.col("i") + j) for j in range(1, WIDTH)]
    is_anchor = (F.col("i") < STARTS) & (F.col("i") <= F.col("last")) & (F.least("own", inside[-1]) <= _least(inside[:-1]))
    is_head = (F.col("i") == STARTS + WIDTH - 2) & F.col("head").isNotNull()
    coded = (F.col("start") + F.col("i")).cast("long") * (1 << 24) + F.xxhash64(F.substring("piece", F.col("i") + 1, F.lit(K))).bitwiseAND(0xFFFFFF)
    found = placed.where(is_anchor | is_head).select(
        *keys, F.when(is_head, F.col("head")).alias("head"), *[F.when(~is_head & (F.col("which") == i), coded).alias(f"at_{i}") for i in range(len(texts))]
    )
    return found.groupBy(*keys).agg(
        F.first("head", ignorenulls=True).alias("head"), *[F.sort_array(F.collect_list(f"at_{i}")).alias(f"at_{i}") for i in range(len(texts))]
    )


def entries(at: Column, whole: Column) -> Column:
    """Entries of a fingerprint, hash * 16 + distance; ``whole`` is the hash of a short text, else null."""
    spaced = F.transform(at, lambda x, i: x.bitwiseAND(0xFFFFFF) * 16 + F.when(
        i > 0, F.shiftright(x, 24) - F.shiftright(F.get(at, i - 1), 24)).otherwise(F.lit(0)))
    return F.when(whole.isNotNull(), F.array(whole * 16)).otherwise(spaced)


def written(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda x: F.lower(F.lpad(F.hex(x), 7, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of entries in common, 0 to 1."""
    total = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b))
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / total)


def _short(text: Column) -> Column:
    """The hash of a text of 1 to K - 1 bytes."""
    n = F.octet_length(text)
    return F.when((n > 0) & (n < K), F.xxhash64(text).bitwiseAND(0xFFFFFF))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every document."""
    pairs = with_next(docs, key, text).withColumn("edited", edit(F.col("text"), F.col("next")))
    head = F.struct(
        "id", "copied", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("sha"),
        _short(F.col("text")).alias("short_0"), _short(F.col("edited")).alias("short_1"),
    )
    texts = pairs.select("cell", "rn", head.alias("head"), F.col("text").cast("binary").alias("b0"), F.col("edited").cast("binary").alias("b1"))
    found = anchors(texts, ["cell", "rn"], F.col("head"), ["b0", "b1"])
    printed = found.select("cell", "rn", "head.*", entries(F.col("at_0"), F.col("head.short_0")).alias("f0"), entries(F.col("at_1"), F.col("head.short_1")).alias("f1"))
    beside = printed.withColumn("f2", F.lead("f0").over(Window.partitionBy("cell").orderBy("rn"))).where("copied = 0")
    return beside.select(
        F.col("id").alias(key), "n_chars", F.col("sha").alias("edited_sha256"), written(F.col("f0")).alias("fingerprint"),
        written(F.col("f1")).alias("edited_fingerprint"), likeness(F.col("f0"), F.col("f1")).alias("near_edited"),
        likeness(F.col("f0"), F.col("f2")).alias("near_next"),
    )


@query("op11_syncmers")
def op11_syncmers(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints(table(spark, folder, "documents"))
