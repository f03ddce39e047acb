"""Text similarity and entity resolution over an inverted index.

Records with the same multiset of tokens (copies, mostly) have the same vector, so they are
folded into one *bag* that carries how many records it stands for on either side. A group of
copies then costs one row, and a pair of bags stands for ``n_left * n_right`` record pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.numbers import score_bin
from millrace.operators.ordering import store

INDEXED = 0.25  # similar pairs are found by what they share but for this part of the asked cosine
_SLACK = 1e-6  # room for float error in the pruning bounds; the final score decides

_EDGE = 1e-7  # room for float error between a score and the bounds of its bin
_LEVELLED = 100  # a token that fewer records hold takes no levels: its postings are few

_BAGS = 2048  # bags of a partition whose tokens are counted and sorted
_GAP = "\n"  # between the tokens of a text; no token holds it

_HOT = 50_000  # tokens whose masses, frequencies and reaches are broadcast

_SIDE_BAGS = 1024  # bags of a block, whose pairs with another block one step forms
_POSTINGS = 400_000  # and its tokens, if more than one bag
_MEETINGS = 2_000_000  # shared tokens that a step holds at once


def _shared() -> Column:
    """Tokens of a bag that others hold too."""
    return F.col("df") > F.col("n_left") + F.col("n_right")


def _commonest(per_df: DataFrame) -> Column:
    """The least frequency at which tokens are broadcast, so that ``_HOT`` are at most; null if none are.

    ``per_df`` (df, n_tokens) has a row per distinct frequency, which are few: their sum is no more than all postings.
    """
    common_first = Window.orderBy(F.desc("df")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = per_df.select("df", F.sum("n_tokens").over(common_first).alias("so_far"))
    return counted.where(F.col("so_far") <= _HOT).agg(F.min("df")).scalar()


# ---- weights per record -------------------------------------------------------------------


def token_counts(records: DataFrame, key: str) -> DataFrame:
    """(key, token, n, total). The records are spread by key once; later steps per record and per
    (record, token) find their rows in place."""
    return (
        records.select(key, "tokens")
        .repartition(key)
        .select(key, F.size("tokens").alias("total"), F.explode("tokens").alias("token"))
        .groupBy(key, "total", "token")
        .agg(F.count("*").alias("n"))
    )


def tf(records: DataFrame, key: str) -> DataFrame:
    """Token count over the record's number of tokens."""
    return token_counts(records, key).select(
        key, "token", (F.col("n") / F.col("total")).alias("tf")
    )


def idf(records: DataFrame) -> DataFrame:
    """All records over the records that hold the token; there is no logarithm in it."""
    n_records = records.agg(F.count("*")).scalar()
    holding = (
        records.select(F.explode(F.array_distinct("tokens")).alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("df"))
    )
    return holding.select("token", (n_records / F.col("df")).alias("idf"))


def stored_idf(records: DataFrame) -> DataFrame:
    """``idf`` as a table of known size: joins with it are broadcast only where it is small."""
    return store(idf(records), "idf")


def tfidf(records: DataFrame, key: str, idfs: DataFrame) -> DataFrame:
    """(key, token, weight); a token outside the idf table is dropped."""
    return weigh(tf(records, key), key, idfs)


def weigh(frequencies: DataFrame, key: str, idfs: DataFrame) -> DataFrame:
    """(key, token, weight) of (key, token, tf), which may be sums over many records."""
    return frequencies.join(idfs, "token").select(
        key, "token", (F.col("tf") * F.col("idf")).alias("weight")
    )


def vector_norm(weights: DataFrame, key: str) -> DataFrame:
    return weights.groupBy(key).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))


def dot_product(left: DataFrame, right: DataFrame) -> DataFrame:
    """Sum of products over the tokens both sparse vectors (token, weight) hold."""
    other = right.select("token", F.col("weight").alias("other"))
    return left.join(other, "token").agg(
        F.coalesce(F.sum(F.col("weight") * F.col("other")), F.lit(0.0)).alias("dot")
    )


def inverted_index(weights: DataFrame, key: str) -> DataFrame:
    return weights.select("token", key)


# ---- two sides ----------------------------------------------------------------------------


def with_bags(records: DataFrame) -> DataFrame:
    """Adds ``bag``, the fingerprint of the record's multiset of tokens."""
    return records.withColumn("bag", F.unhex(F.md5(F.array_join(F.sort_array("tokens"), " "))))


def fold_copies(bagged: DataFrame, key: str, side: str = "side") -> DataFrame:
    """(bag, n_left, n_right, left_id, right_id): one row per multiset of tokens.

    ``side`` is 'a' or 'b'. The ids are the least on each side, to name the bag by. Token lists take no part: they
    are fetched by id where they are needed.
    """
    left, right = F.col(side) == "a", F.col(side) == "b"
    return (
        bagged.groupBy("bag")
        .agg(
            F.count_if(left).alias("n_left"),
            F.count_if(right).alias("n_right"),
            F.min(F.when(left, F.col(key))).alias("left_id"),
            F.min(F.when(right, F.col(key))).alias("right_id"),
        )
    )


def bag_vectors(bagged: DataFrame, bags: DataFrame, key: str, wanted: DataFrame | None = None) -> DataFrame:
    """Unit-length tf-idf vectors as rows (bag, name, token, weight, df, common_sq, n_left, n_right).

    The corpus is both sides with repeats, as the counts on the bags say. ``common_sq`` is the
    squared length of the bag's tokens from the most common one to this one; both windows need
    the same spread and order of rows. ``name`` is a number for the bag, unique among them, that
    takes less room where rows move. Stored, because every later step reads it more than once.

    What moves is small: tokens once, under the record's key, and rows of rare tokens to their frequency and back. What
    is the same for a whole bag is joined on behind the last move, and stored columns repeat or are short; the
    weight is worked out from them where it is read.

    ``wanted`` (bag) names the bags whose vectors are asked for, all if not given. Every record counts in the frequencies
    all the same; those are summed per task, and no token list of another bag moves.
    """
    size = F.col("n_left") + F.col("n_right")
    n_records = bags.agg(F.sum(size)).scalar()
    # one record speaks for its copies: the key, unique in the records, brings its tokens
    named = bags.select("bag", "n_left", "n_right", F.least("left_id", "right_id").alias(key))
    if wanted is not None:
        named = named.join(wanted.select("bag").distinct(), "bag", "left_semi")
    # the number is a short name for the bag; stored, so it stays the same
    named = store(named.withColumn("name", F.monotonically_increasing_id()), "named-bags")
    # every record counts; stored, because the rows of common and of other tokens are told apart by it
    holding = store(
        bagged.select(F.explode(F.array_distinct("tokens")).alias("token")).groupBy("token").agg(F.count("*").alias("df")),
        "document-frequency",
    )
    hot = F.coalesce(F.col("df") >= _commonest(holding.groupBy("df").agg(F.count("*").alias("n_tokens"))), F.lit(False))
    common = F.broadcast(holding.where(hot))
    texts = bagged.where(F.size("tokens") > 0).select(key, F.array_join(F.sort_array("tokens"), _GAP).alias("text"))
    if wanted is not None:
        texts = texts.join(named.select(key), key, "left_semi")
    # a task counts and sorts all tokens of its own, so partitions grow in number and not in size
    n_parts = max(math.ceil(named.count() / _BAGS), bags.sparkSession.sparkContext.defaultParallelism)
    # most rows are of common tokens, whose frequencies go to every task; only rows of the others meet theirs by token,
    # and a token that is not met has one record
    rare = (
        texts.select(key, F.explode(F.array_distinct(F.split("text", _GAP))).alias("token"))
        .join(common.select("token"), "token", "left_anti")
        .join(holding.where(~hot & (F.col("df") > 1)), "token")
        .repartition(n_parts, key)
        .groupBy(key).agg(F.collect_list(F.struct("token", "df")).alias("rare"))
    )
    # tokens are spread by key once, as one sorted text, a third of a list's size, and the frequencies of rare ones beside
    # them; the counts, fractions and windows are made in place
    told = (
        texts.repartition(n_parts, key)
        .join(named.select(key).repartition(n_parts, key).distinct().hint("shuffle_hash"), key)
        .join(rare, key, "left")
        .withColumn("tokens", F.split("text", _GAP))
    )
    once = F.transform("tokens", lambda x: F.struct(x.alias("token"), F.lit(None).cast("bigint").alias("df")))
    counts = (
        told.select(key, F.size("tokens").alias("total"), F.explode(F.concat(once, F.coalesce("rare", F.array()))).alias("t"))
        .groupBy(key, "total", F.col("t.token").alias("token"))
        .agg((F.count("*") - F.count("t.df")).cast("int").alias("n"), F.max("t.df").alias("rare_df"))
        .where("n > 0")
    )
    spread = counts.join(common, "token", "left").withColumn("df", F.coalesce("df", "rare_df", F.lit(1).cast("bigint"))).drop("rare_df")
    weighted = spread.withColumn("raw", F.col("n") / F.col("total") * (n_records / F.col("df")))
    common_first = Window.partitionBy(key).orderBy(F.desc("df"), F.asc("token"))
    whole = common_first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = common_first.rowsBetween(Window.unboundedPreceding, -1)
    square = F.sum(F.col("raw") * F.col("raw"))
    stored = store(
        weighted.withColumns({"_all": square.over(whole), "_some": F.coalesce(square.over(before), F.lit(0.0))})
        .join(named, key)
        .select(
            "bag", "name", "token", "n", "df", (n_records / F.col("total") / F.sqrt("_all")).alias("scale"),
            (F.col("_some") / F.col("_all")).cast("float").alias("before"), "n_left", "n_right",
        ),
        "bag-vectors",
        codec="zstd",
    )
    weight = F.col("scale") * F.col("n") / F.col("df")
    return stored.select(
        "bag", "name", "token", weight.alias("weight"), "df", (F.col("before") + weight * weight).alias("common_sq"), "n_left", "n_right",
    )


def postings_join(records: DataFrame, side: str = "side") -> DataFrame:
    """Join of the two sides' inverted indexes, as (token, n_left, n_right, n_pairs).

    The rows of one token would be every pair of its records; their number is all that the
    join of the two per-token counts needs, and that takes no weights.
    """
    sides = (
        records.select(side, F.explode(F.array_distinct("tokens")).alias("token"))
        .groupBy("token")
        .agg(F.count_if(F.col(side) == "a").alias("n_left"), F.count_if(F.col(side) == "b").alias("n_right"))
    )
    return sides.where("n_left > 0 and n_right > 0").withColumn(
        "n_pairs", F.col("n_left") * F.col("n_right")
    )


def _meetings(pairs: DataFrame, vectors: DataFrame, kept: Column | None = None) -> DataFrame:
    """A row per pair and token both of its bags hold, with both weights; of the ``kept`` tokens, if not all."""
    vectors = vectors if kept is None else vectors.where(kept)
    left = vectors.where("n_left > 0").select(F.col("bag").alias("left_bag"), "token", F.col("weight").alias("lw"))
    right = vectors.where("n_right > 0").select(F.col("bag").alias("right_bag"), "token", F.col("weight").alias("rw"))
    return pairs.join(left, "left_bag").join(right, ["right_bag", "token"])


def _shared_scores(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """``pairs`` that share a token, with their exact cosine.

    A bag beside itself takes one sum over its own vector, so known copies move no vectors. ``pairs`` is read
    twice and should be stored.
    """
    own = vectors.groupBy("bag").agg(F.sum(F.col("weight") * F.col("weight")).alias("similarity"))
    same = pairs.where(F.col("left_bag") == F.col("right_bag"))
    alone = same.join(own.withColumnRenamed("bag", "left_bag"), "left_bag").select(*pairs.columns, "similarity")
    apart = pairs.where(F.col("left_bag") != F.col("right_bag"))
    if apart.isEmpty():
        return alone
    return alone.unionByName(
        _meetings(apart, vectors, _shared()).groupBy(*pairs.columns).agg(F.sum(F.col("lw") * F.col("rw")).alias("similarity"))
    )


def common_tokens(pairs: DataFrame | None, vectors: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """The tokens each pair shares, in order; a list is never longer than the record. Without ``pairs``, of all pairs
    that share one, by ``names`` if given (see ``sharing_bags``).

    What moves is a list per bag and per pair, not a row per pair and token. A bag beside itself shares all it holds,
    and other pairs only tokens that more than one bag holds.
    """
    if pairs is None:
        return _by_blocks(vectors, names, "shared array<string>", _shared_tokens)

    def listed(kept: DataFrame) -> DataFrame:
        return kept.groupBy("bag").agg(F.sort_array(F.collect_list("token")).alias("tokens"))

    same, apart = F.col("left_bag") == F.col("right_bag"), F.col("left_bag") != F.col("right_bag")
    alone = pairs.where(same).join(
        listed(vectors.where("n_left > 0 and n_right > 0")).select(F.col("bag").alias("left_bag"), F.col("tokens").alias("shared")), "left_bag"
    )
    named = pairs.where(apart).select(F.explode(F.array("left_bag", "right_bag")).alias("bag")).distinct()
    lists = listed(vectors.where(_shared()).join(named, "bag", "left_semi"))
    met = (
        pairs.where(apart)
        .join(lists.select(F.col("bag").alias("left_bag"), "tokens"), "left_bag")
        .join(lists.select(F.col("bag").alias("right_bag"), F.col("tokens").alias("others")), "right_bag")
    )
    shared = met.select(*pairs.columns, F.array_intersect("tokens", "others").alias("shared")).where(F.size("shared") > 0)
    return alone.select(*pairs.columns, "shared").unionByName(shared)


def score_pairs(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """Exact cosine of given bag pairs (left_bag, right_bag, ..), 0 where they share nothing."""
    hits = _shared_scores(pairs.select("left_bag", "right_bag"), vectors)
    return pairs.join(hits, ["left_bag", "right_bag"], "left").withColumn(
        "similarity", F.coalesce("similarity", F.lit(0.0))
    )


def _packed(lists: DataFrame) -> DataFrame:
    """(side, bags, tokens, codes, weights, starts): blocks of consecutive bags of a side, from (left, right, n_left, n_right,
    tokens), where ``left`` and ``right`` name the bag on either side.

    ``tokens`` are a block's distinct ones in order and ``codes`` their places. Left blocks have their tokens by bag, right
    ones the bags by token; ``starts`` is where each begins.
    """

    def block(side: int, names: pa.Array, n: pa.Array, lists: pa.ListArray) -> pa.RecordBatch:
        ends = lists.offsets.to_numpy().astype(np.int64)
        items = lists.values.slice(ends[0], ends[-1] - ends[0])
        row = np.repeat(np.arange(len(n)), np.diff(ends))
        found, weight = items.field("token").dictionary_encode(), items.field("weight").to_numpy()
        order = pc.sort_indices(found.dictionary).to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        code = place[found.indices.to_numpy()]
        by = np.lexsort((row, code) if side else (code, row))
        inner, outer, size = (row, code, len(order)) if side else (code, row, len(n))
        starts = np.append(0, np.cumsum(np.bincount(outer, minlength=size)))
        bags = pa.StructArray.from_arrays([names, n], ["name", "n"])
        return pa.RecordBatch.from_pydict({
            "side": pa.array([side], pa.int32()),
            "bags": pa.ListArray.from_arrays(pa.array([0, len(bags)], pa.int32()), bags),
            "tokens": pa.ListArray.from_arrays(pa.array([0, len(order)], pa.int32()), found.dictionary.take(pa.array(order))),
            "codes": pa.array([inner[by].astype("<i4").tobytes()], pa.binary()),
            "weights": pa.array([weight[by].astype("<f8").tobytes()], pa.binary()),
            "starts": pa.array([starts.astype("<i8").tobytes()], pa.binary()),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for side, (name, n) in enumerate((("left", "n_left"), ("right", "n_right"))):
                part = batch.filter(pc.greater(batch.column(n), 0))
                sizes = np.cumsum(pc.list_value_length(part.column("tokens")).to_numpy())
                start = 0
                while start < part.num_rows:
                    before = sizes[start - 1] if start else 0
                    full = int(np.searchsorted(sizes, before + _POSTINGS, "right"))
                    end = min(max(full, start + 1), start + _SIDE_BAGS)
                    cut = part.slice(start, end - start)
                    yield block(side, cut.column(name), cut.column(n), cut.column("tokens"))
                    start = min(end, part.num_rows)

    name = lists.schema["left"].dataType.simpleString()
    return lists.mapInArrow(
        run, f"side int, bags array<struct<name: {name}, n: bigint>>, tokens array<string>, codes binary, weights binary, starts binary"
    )


def _by_blocks(vectors: DataFrame, names: DataFrame | None, column: str, found: Callable) -> DataFrame:
    """(left_bag, right_bag, n_pairs, column) of all pairs that share a token; ``names`` (bag, left_id, right_id) gives (left_id,
    right_id, ..) instead.

    Every left block meets every right one, and a task forms the pairs of two blocks at a time, in steps of ``_MEETINGS``
    shared tokens and no fewer than one bag's. Blocks are read from where they are stored: nothing moves that grows with the
    pairs, which go out as they are formed. ``found`` (cell, weight, code, tokens, n_cells) gives the cells of a step that share
    a token and the column's values.
    """
    held = vectors.where(_shared() | ((F.col("n_left") > 0) & (F.col("n_right") > 0)))
    # a task packs all tokens of its own bags, so partitions grow in number and not in size
    n_bags = held.agg(F.count_distinct("name")).first()[0]
    n_parts = max(math.ceil(n_bags / _BAGS), vectors.sparkSession.sparkContext.defaultParallelism)
    lists = (
        held.repartition(n_parts, "bag")
        .groupBy("bag", "n_left", "n_right")
        .agg(F.collect_list(F.struct("token", "weight")).alias("tokens"))
    )
    called = ["left_bag", "right_bag"]
    if names is None:
        lists = lists.select(F.col("bag").alias("left"), F.col("bag").alias("right"), "n_left", "n_right", "tokens")
    else:
        called = ["left_id", "right_id"]
        lists = lists.join(names.select("bag", F.col("left_id").alias("left"), F.col("right_id").alias("right")), "bag").drop("bag")
    blocks = store(_packed(lists), "blocks", codec="zstd")
    parts = ["bags", "tokens", "codes", "weights", "starts"]
    left, right = (blocks.where(F.col("side") == k).select(*[F.col(c).alias(f"{'lr'[k]}_{c}") for c in parts]) for k in (0, 1))
    met = left.hint("shuffle_replicate_nl").crossJoin(right)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                code, weight, starts = (np.frombuffer(row[f"l_{c}"].as_buffer(), d) for c, d in (("codes", "<i4"), ("weights", "<f8"), ("starts", "<i8")))
                place, others, begins = (np.frombuffer(row[f"r_{c}"].as_buffer(), d) for c, d in (("codes", "<i4"), ("weights", "<f8"), ("starts", "<i8")))
                lefts, rights, tokens = row["l_bags"].values, row["r_bags"].values, row["l_tokens"].values
                at = pc.fill_null(pc.index_in(tokens, row["r_tokens"].values), -1).to_numpy()[code]
                bag = np.repeat(np.arange(len(lefts)), np.diff(starts))
                kept = np.flatnonzero(at >= 0)
                bag, code, weight, at = bag[kept], code[kept], weight[kept], at[kept]
                n = begins[at + 1] - begins[at]
                until = np.append(0, np.cumsum(n))  # meetings before each token of the left bags
                first = np.searchsorted(bag, np.arange(len(lefts) + 1))
                start = 0
                while start < len(lefts):
                    # so many bags as fill a step; one bag has no more meetings than the right block has tokens
                    end = max(int(np.searchsorted(until[first], until[first[start]] + _MEETINGS, "right")) - 1, start + 1)
                    own = slice(first[start], first[end])
                    size = n[own]
                    meets = np.repeat(begins[at[own]] - (until[own.start : own.stop] - until[own.start]), size) + np.arange(size.sum())
                    cell = np.repeat((bag[own] - start) * len(rights), size) + place[meets]
                    cells, values = found(cell, np.repeat(weight[own], size) * others[meets], np.repeat(code[own], size), tokens, (end - start) * len(rights))
                    i, j = np.divmod(cells, len(rights))
                    a, b = lefts.take(pa.array(i + start)), rights.take(pa.array(j))
                    if len(cells):
                        yield pa.RecordBatch.from_arrays(
                            [a.field("name"), b.field("name"), pc.multiply(a.field("n"), b.field("n")), values], names=[*called, "n_pairs", column.split()[0]]
                        )
                    start = end

    name = lists.schema["left"].dataType.simpleString()
    return met.mapInArrow(run, f"{called[0]} {name}, {called[1]} {name}, n_pairs bigint, {column}")


def _cosines(cell: np.ndarray, weight: np.ndarray, code: np.ndarray, tokens: pa.Array, n_cells: int) -> tuple[np.ndarray, pa.Array]:
    total = np.bincount(cell, weight, n_cells)
    cells = np.flatnonzero(total)
    return cells, pa.array(total[cells])


def _shared_tokens(cell: np.ndarray, weight: np.ndarray, code: np.ndarray, tokens: pa.Array, n_cells: int) -> tuple[np.ndarray, pa.Array]:
    # a bag's tokens are in order, and stay so within a cell
    by = np.argsort(cell, kind="stable")
    size = np.bincount(cell, minlength=n_cells)
    cells = np.flatnonzero(size)
    ends = np.append(0, np.cumsum(size[cells])).astype(np.int32)
    return cells, pa.ListArray.from_arrays(pa.array(ends), tokens.take(pa.array(code[by])))


def sharing_bags(vectors: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Every bag pair across the sides that shares a token, however low its cosine: (left_bag, right_bag, n_pairs, similarity), or
    (left_id, right_id, ..) by ``names`` (bag, left_id, right_id). As many as the product of the sides where a word is common."""
    return _by_blocks(vectors, names, "similarity double", _cosines)


def _index_prefix(vectors: DataFrame, floor: float) -> DataFrame:
    """The postings a pair of cosine >= ``floor`` must meet on.

    Tokens of a bag in order from common to rare; the common ones whose joint length stays under
    ``floor`` are left out of the index. If two bags meet on no indexed token, all they share
    lies in the left-out part of one of them, so their cosine is below the length of that part
    (L2 prefix filter: Bayardo et al. 2007, Anastasiu and Karypis 2014). Hot tokens weigh
    next to nothing under this idf, so they are the ones that drop out. ``commoner`` is the
    length of the bag's tokens that are more common than the posting's.
    """
    square = F.col("weight") * F.col("weight")
    return vectors.where(F.col("common_sq") >= floor * floor * (1 - _SLACK)).withColumn(
        "commoner", F.sqrt(F.greatest(F.col("common_sq") - square, F.lit(0.0)))
    )


def _level(reach: Column, top: int) -> Column:
    return F.least(F.greatest(F.floor(-F.log2(reach) / 2), F.lit(0)), F.lit(top)).cast("int")


def _within_reach(index: DataFrame, vectors: DataFrame, least: float) -> DataFrame:
    """``index`` without the postings that meet nothing long enough; adds ``left_reach`` and ``right_reach``, the longest
    reaches of the token's postings on either side.

    Those of the commonest tokens, a bounded number, go to every task; those of others are taken for 1.
    """
    # every token of that frequency is held by so many records
    per_df = vectors.groupBy("df").agg((F.sum(F.col("n_left") + F.col("n_right")) / F.col("df")).alias("n_tokens"))
    hot = F.coalesce(F.col("df") >= _commonest(per_df), F.lit(False))
    left, right = F.col("n_left") > 0, F.col("n_right") > 0
    farthest = store(
        index.where(hot).groupBy("token").agg(
            F.max(F.when(left, F.col("reach"))).alias("left_reach"), F.max(F.when(right, F.col("reach"))).alias("right_reach")
        ),
        "reaches",
    )
    told = index.join(F.broadcast(farthest), "token", "left")
    bound = least * (1 - _SLACK)
    return told.withColumns({c: F.when(hot, F.col(c)).otherwise(1.0) for c in ("left_reach", "right_reach")}).where(
        (left & (F.col("reach") * F.col("right_reach") >= bound)) | (right & (F.col("reach") * F.col("left_reach") >= bound))
    )


def similar_bags(
    vectors: DataFrame, floor: float, alike: Callable[[Column], Column] | None = None, names: DataFrame | None = None
) -> DataFrame:
    """Every bag pair across the sides with cosine >= ``floor``: (left_bag, right_bag, n_pairs,
    similarity). Exact; nothing is capped.

    Two bags are compared from their rarest shared token on. With ``reach`` the length of a bag's tokens from the
    most common one to this one, what a pair shares from a token on to the common end is at most the product of both
    reaches, and reaches only fall on the way. So meetings whose product is under ``least`` are left out: what a pair
    shares there is below ``least``, and below the product of what lies behind its last meeting. Only pairs that can reach
    ``floor`` with that are scored in full.

    Postings whose product with the longest reach on the other side is under ``least`` do not move. Reaches are dealt
    into levels by powers of four, and a posting meets only the levels of its token that the product allows, so meetings
    that would be left out are hardly formed.

    ``alike`` (say, the bin of a score) tells scores apart as far as the caller does: pairs for which it gives the same
    on both bounds are not scored further, and ``similarity`` is then the lower bound.

    ``floor`` = 0 gives all pairs that share a token, as the plain inverted-index join does, and ``names`` names them
    (``sharing_bags``). Their number is quadratic; what moves is not.
    """
    if not floor:
        return sharing_bags(vectors, names)
    least = floor * INDEXED
    # a token of one bag alone can only meet the bag itself
    held = _shared() | ((F.col("n_left") > 0) & (F.col("n_right") > 0))
    index = _index_prefix(vectors.where(held), least).withColumn("reach", F.sqrt("common_sq"))
    index = _within_reach(index, vectors, least)
    # 4 ** -(top + 1) is under ``least``
    top = math.floor(-math.log2(least * (1 - _SLACK)) / 2)
    few = F.col("df") < _LEVELLED
    level = F.when(few, 0).otherwise(_level(F.col("reach"), top))
    met_levels = F.when(few, F.array(F.lit(0))).otherwise(
        F.sequence(_level(F.col("right_reach"), top), F.lit(top) - level)
    )
    bound = least * (1 - _SLACK)
    met_right, met_left = F.col("reach") * F.col("right_reach") >= bound, F.col("reach") * F.col("left_reach") >= bound

    def side(name: str, weight: str, rest: str, kept: Column, levels: Column) -> DataFrame:
        return index.where(kept).select(
            "token", F.col("name").alias(name), F.col("weight").alias(weight), F.col("commoner").cast("float").alias(rest),
            levels.alias("level"),
        )

    def length(weight: str, rest: str) -> Column:
        return F.col(weight) * F.col(weight) + F.col(rest) * F.col(rest).cast("double")

    met = (
        side("left_name", "lw", "lrest", (F.col("n_left") > 0) & met_right, F.explode(met_levels))
        .join(side("right_name", "rw", "rrest", (F.col("n_right") > 0) & met_left, level), ["token", "level"])
        .where(F.sqrt(length("lw", "lrest") * length("rw", "rrest")) >= least * (1 - _SLACK))
        .groupBy("left_name", "right_name")
        .agg(
            F.sum(F.col("lw") * F.col("rw")).alias("part"),
            F.min((F.col("lrest").cast("double") * F.col("rrest")).cast("float")).alias("rest"),
        )
        .withColumn("most", F.col("part") + F.least(F.col("rest") * (1 + _SLACK), F.lit(float(least))))
        .where(F.col("most") >= floor * (1 - _SLACK))
    )
    names = store(vectors.select("name", "bag", "n_left", "n_right").distinct(), "names")
    left = names.where("n_left > 0").select(F.col("name").alias("left_name"), F.col("bag").alias("left_bag"), "n_left")
    right = names.where("n_right > 0").select(F.col("name").alias("right_name"), F.col("bag").alias("right_bag"), "n_right")
    # stored, so the size of the candidate table is known when its joins are planned
    candidates = store(
        met.join(left, "left_name").join(right, "right_name").withColumn("n_pairs", F.col("n_left") * F.col("n_right")),
        "candidates",
    )
    settled = F.lit(False)
    if alike is not None:
        settled = (F.col("part") >= floor) & (alike(F.col("part") - _EDGE) == alike(F.col("most") + _EDGE))
    # scored by name, which is short
    asked = store(candidates.where(~settled).select(F.col("left_name").alias("left_bag"), F.col("right_name").alias("right_bag")), "asked")
    scores = _shared_scores(asked, vectors.withColumn("bag", F.col("name"))).where(F.round("similarity", 9) >= floor)
    scored = candidates.join(scores.toDF("left_name", "right_name", "similarity"), ["left_name", "right_name"])
    columns = ["left_bag", "right_bag", "n_pairs", "similarity"]
    if alike is None:
        return scored.select(columns)
    return candidates.where(settled).withColumn("similarity", F.col("part")).select(columns).unionByName(scored.select(columns))


def side_masses(vectors: DataFrame) -> DataFrame:
    """(token, left_mass, right_mass): the sums of the sides' unit vectors, copies counted."""
    return vectors.groupBy("token").agg(
        F.sum(F.col("weight") * F.col("n_left")).alias("left_mass"),
        F.sum(F.col("weight") * F.col("n_right")).alias("right_mass"),
    )


def mean_cosine_per_record(vectors: DataFrame, bags: DataFrame) -> DataFrame:
    """For each left bag the mean cosine to *all* right records, pairs that share nothing as 0.

    The sum of cosines to a set is the dot product with the set's summed unit vectors, so all
    pairs are accounted for in linear work and no pair is formed.
    """
    n_right = bags.agg(F.sum("n_right")).scalar()
    # of all (record, token) rows, a token with that share of them is one of _HOT at most: their masses go to every task
    # and the sums shrink to a row per bag before they move; only the rows of rarer tokens are spread by token
    hot = F.col("df") >= vectors.agg(F.sum(F.col("n_left") + F.col("n_right")) / _HOT).scalar()
    masses = store(
        vectors.where("n_right > 0").groupBy("token", "df").agg(F.sum(F.col("weight") * F.col("n_right")).alias("mass")),
        "masses",
    )
    left = vectors.where("n_left > 0")
    rare = left.where(~hot & (_shared() | (F.col("n_right") > 0))).join(masses.where(~hot).drop("df"), "token")
    often = left.where(hot).join(F.broadcast(masses.where(hot).drop("df")), "token")
    sums = (
        often.select("bag", "weight", "mass")
        .unionByName(rare.select("bag", "weight", "mass"))
        .groupBy("bag")
        .agg(F.sum(F.col("weight") * F.col("mass")).alias("total"))
    )
    return (
        bags.where("n_left > 0")
        .join(sums, "bag", "left")
        .select(
            "left_id",
            "n_left",
            (F.col("n_left") * n_right).alias("n_pairs"),
            (F.coalesce("total", F.lit(0.0)) / n_right).alias("mean_similarity"),
        )
    )


def cross_pair_totals(left: DataFrame, right: DataFrame, group: str) -> DataFrame:
    """All pairs of two tables, counted per group of the left: the product is never formed."""
    n_right = right.agg(F.count("*")).scalar()
    return left.groupBy(group).agg(F.count("*").alias("n_left")).select(
        group, "n_left", n_right.alias("n_right"), (F.col("n_left") * n_right).alias("n_pairs")
    )


# ---- gold pairs ---------------------------------------------------------------------------


def gold_pairs(bagged: DataFrame, gold_key: Column, side: str = "side") -> DataFrame:
    """Known duplicates as bag pairs (left_bag, right_bag, n_gold): records of the two sides with
    the same ``gold_key``.

    Counted per (key, bag) first, so a group of copies meets as one row and not as all its pairs.
    """
    counted = (
        bagged.groupBy(gold_key.alias("gold_key"), "bag")
        .agg(
            F.count_if(F.col(side) == "a").alias("n_left"),
            F.count_if(F.col(side) == "b").alias("n_right"),
        )
    )
    left = counted.where("n_left > 0").select("gold_key", F.col("bag").alias("left_bag"), "n_left")
    right = counted.where("n_right > 0").select("gold_key", F.col("bag").alias("right_bag"), "n_right")
    return left.join(right, "gold_key").groupBy("left_bag", "right_bag").agg(
        F.sum(F.col("n_left") * F.col("n_right")).alias("n_gold")
    )


def join_gold(gold: DataFrame, vectors: DataFrame) -> DataFrame:
    """Scores of the known duplicates that share a token, however low: the pairs are given, so none is searched."""
    return _shared_scores(gold, vectors)


def anti_gold(similar: DataFrame, gold: DataFrame) -> DataFrame:
    """Similar pairs that are not known duplicates; a bag pair may hold both kinds."""
    return (
        similar.join(gold, ["left_bag", "right_bag"], "left")
        .withColumn("n_pairs", F.col("n_pairs") - F.coalesce("n_gold", F.lit(0)))
        .where("n_pairs > 0")
        .drop("n_gold")
    )


def average_similarity(vectors: DataFrame, bags: DataFrame, gold_scores: DataFrame) -> DataFrame:
    """Mean cosine of the known duplicates and of all other pairs, zeros included."""
    sides = bags.agg(F.struct(F.sum("n_left").alias("l"), F.sum("n_right").alias("r"))).scalar()
    n_all = (sides.getField("l") * sides.getField("r")).cast("double")
    everything = side_masses(vectors).agg(F.sum(F.col("left_mass") * F.col("right_mass"))).scalar()
    return gold_scores.agg(
        F.sum("n_gold").alias("n_gold"), F.sum(F.col("n_gold") * F.col("similarity")).alias("gold_sum")
    ).select(
        F.try_divide("gold_sum", "n_gold").alias("avg_duplicates"),
        F.try_divide(everything - F.coalesce("gold_sum", F.lit(0.0)), n_all - F.coalesce("n_gold", F.lit(0))).alias(
            "avg_others"
        ),
    )


# ---- threshold sweep ----------------------------------------------------------------------


def pair_total(bags: DataFrame) -> Column:
    """All record pairs across the sides: a product of two sums."""
    return bags.agg((F.sum("n_left") * F.sum("n_right")).alias("n")).scalar()


def pairs_per_bin(similar: DataFrame, n_all: Column) -> DataFrame:
    """(bin, n) of ``int(similarity * 100)``, 0 to 100, over *all* pairs of the sides.

    ``similar`` holds every pair of bin 1 and above. Whatever else the product of the sides holds, pairs that
    share nothing too, is in the bottom bin: it is counted as the rest, and none of its pairs is formed.
    """
    found = (
        similar.groupBy(score_bin(F.col("similarity")).alias("bin")).agg(F.sum("n_pairs").alias("n")).where("bin >= 1")
    )
    rest = found.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("above")).select(
        F.lit(0).alias("bin"), (F.coalesce(n_all, F.lit(0)) - F.col("above")).alias("n")
    )
    every = similar.sparkSession.range(101).select(F.col("id").cast("int").alias("bin"))
    return every.join(found.unionByName(rest), "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def threshold_bins(similar: DataFrame, gold_scores: DataFrame, n_all: Column) -> DataFrame:
    """Pairs per ``int(similarity * 100)`` from 0 on: all, gold, and all minus gold."""
    golden = gold_scores.groupBy(score_bin(F.col("similarity")).alias("bin")).agg(
        F.sum("n_gold").alias("gold")
    )
    return (
        pairs_per_bin(similar, n_all).withColumnRenamed("n", "candidates")
        .join(golden, "bin", "left")
        .select("bin", "candidates", F.coalesce("gold", F.lit(0)).alias("gold"))
        .withColumn("net", F.col("candidates") - F.col("gold"))
    )


def confusion_by_threshold(bins: DataFrame, gold_scores: DataFrame) -> DataFrame:
    """True positives, false positives and false negatives for each threshold bin/100 below 1.

    False positives come from the bins, false negatives from the exact scores. A gold score below
    threshold t is one whose number of thresholds at or below it is less than t's, so one count
    per number of passed thresholds serves all of them. The windows run over at most 101 rows.
    """
    passed = F.least(F.floor(F.round("similarity", 9) * 100 + 1e-7), F.lit(100)).cast("int")
    gold_bins = gold_scores.groupBy(passed.alias("bin")).agg(F.sum("n_gold").alias("g"))
    n_gold = gold_scores.agg(F.coalesce(F.sum("n_gold"), F.lit(0))).scalar()
    upward = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        bins.join(gold_bins, "bin", "left")
        .select(
            (F.col("bin") / 100).alias("threshold"),
            F.sum(F.coalesce("g", F.lit(0))).over(upward).alias("tp"),
            F.sum("net").over(upward).alias("fp"),
        )
        .withColumn("fn", n_gold - F.col("tp"))
        .where("threshold < 1")
    )


def precision_recall(confusion: DataFrame) -> DataFrame:
    """Precision, recall and F-measure; null where a divisor is zero."""
    with_rates = confusion.select(
        "threshold",
        F.try_divide("tp", F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide("tp", F.col("tp") + F.col("fn")).alias("recall"),
    )
    return with_rates.withColumn(
        "f_measure",
        F.try_divide(2 * F.col("recall") * F.col("precision"), F.col("recall") + F.col("precision")),
    )
