"""MinHash near-dedup with sequential Bayesian verification.

1. Each text becomes the set of its distinct word shingles, 160 MinHash values, 32 bands of 5 of them, and one
   byte of each value as its signature. Equal sets are one *node* from here on.
2. Nodes that share a band are candidates. A pair at similarity 0.8 shares none with probability 3e-6.
3. Candidates compare their signatures in batches of 16 values. With m of t values equal and a uniform prior,
   P(similarity >= s) is P(Binomial(t + 1, s) <= m); below ``MISS`` the pair is pruned.
4. Survivors are verified exactly on the full sets of both texts.
5. Components of the verified links; one document of each stays, the one with the smallest id.

Pairs inside a band's bucket are never formed row by row: a bucket first meets one leader, its smallest node, then its
best-linked node, which is linear, and the links found fold its nodes into components. What then remains are *strays*,
nodes outside the largest component of their bucket. Strays and nodes of other components meet in blocks of a bounded
size, twice. First with signatures and bands alone: step 3 names the nodes with any partner left, where a pair counts in the
first bucket it shares and no other. Only these come again with their full sets, and steps 3 and 4 run as array
operations. A block gives only the links that join components, fewer than
it has nodes, and these are verified on the texts. So no link between components is lost to a bound, a large group of
near copies costs a few rows per copy, and sets travel only where signatures leave a doubt.

Defined cases: a null or empty text, or one of white space, has an empty set and is linked with nothing; a
text of fewer words than a shingle is one shingle; rows with a null id are linked with nothing; rows that share
an id are one document; other columns are not read.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import arrow_map, store, table, texts
from llm.components import components
from llm.registry import query

BANDS, ROWS, BATCH, MISS = 32, 5, 16, 1e-6
BLOCK, SHINGLES = 512, 1 << 19  # nodes and shingles of a block
HASHES = BANDS * ROWS
_RNG = np.random.default_rng(20240607)
_A = _RNG.integers(1, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, HASHES, np.uint64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingle_words(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode().lower().split()


def shingle_hashes(text: str, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles."""
    from xxhash import xxh64_intdigest

    words = shingle_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter((xxh64_intdigest(w) for w in words), np.uint64, len(words))
    span = min(k, len(h))
    out = np.full(len(h) - span + 1, span, np.uint64)
    for i in range(span):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + len(out)])
    return np.unique(out)


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 512):
        low = np.minimum(low, (shingles[start : start + 512, None] * _A + _B).min(axis=0))
    return _mix(low)


def least_matches(threshold: float, miss: float = MISS) -> list[tuple[int, int]]:
    """(values compared, least matches to go on) after each batch."""
    out = []
    for t in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(t + 1, m) * threshold**m * (1 - threshold) ** (t + 1 - m)
        out.append((t, m))
    return out


def sketch(docs: DataFrame, k: int, key: str, text: str) -> DataFrame:
    """(id, n, set, bands, signature) per row; no bands where the set is empty."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        from xxhash import xxh3_128_digest

        counts, sets, bands, signatures = [], [], [], []
        for value in texts(batch.column(1)):
            shingles = shingle_hashes(value, k)
            counts.append(len(shingles))
            if not len(shingles):
                sets.append(None), bands.append(None), signatures.append(None)
                continue
            sets.append(xxh3_128_digest(shingles.tobytes()))
            low = min_hashes(shingles)
            band = np.zeros(BANDS, np.uint64) + np.arange(BANDS, dtype=np.uint64)
            for row in low.reshape(ROWS, BANDS):
                band = _mix(band * np.uint64(0x9E3779B97F4A7C15) + row)
            bands.append(band.view(np.int64))
            signatures.append((low >> np.uint64(56)).astype(np.uint8).tobytes())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(sets, pa.binary()),
             pa.array(bands, pa.list_(pa.int64())), pa.array(signatures, pa.binary())],
            names=["id", "n", "set", "bands", "signature"],
        )

    narrow = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return arrow_map(narrow, run, "id long, n long, set binary, bands array<long>, signature binary")


def _prune(pairs: DataFrame, threshold: float) -> DataFrame:
    """Step 3 on (a, b, sa, sb)."""
    stops = least_matches(threshold)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, HASHES) for c in ("sa", "sb"))
        alive, matches, begin = np.arange(len(left)), np.zeros(len(left), np.int64), 0
        for t, least in stops:
            matches = matches + (left[alive, begin:t] == right[alive, begin:t]).sum(axis=1)
            stay = matches >= least
            alive, matches, begin = alive[stay], matches[stay], t
        return batch.select(["a", "b"]).take(pa.array(alive))

    return arrow_map(pairs, run, "a long, b long")


def _confirm(pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """Step 4 on (a, b, ta, tb): exact comparison of the sets of word shingles."""

    def shingles(text: str) -> set:
        words = shingle_words(text)
        span = min(k, len(words))
        return set(zip(*(words[i : len(words) - span + 1 + i] for i in range(span)), strict=True)) if words else set()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        last, own = None, set()
        stay = []
        for ta, tb in zip(texts(batch.column(2)), texts(batch.column(3)), strict=True):
            if ta is not last:
                if ta != last:
                    own = shingles(ta)
                last = ta
            other = shingles(tb)
            both = len(own & other)
            stay.append(bool(both) and 100 * both >= percent * (len(own) + len(other) - both))
        return batch.select(["a", "b"]).filter(pa.array(stay, pa.bool_()))

    return arrow_map(pairs.select("a", "b", "ta", "tb"), run, "a long, b long")


class _Verifier:
    def __init__(self, docs: DataFrame, nodes: DataFrame, k: int, percent: int, key: str, text: str):
        self.docs = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
        self.signatures = nodes.select("node", "signature")
        self.k, self.percent = k, percent

    def sets(self, wanted: DataFrame) -> DataFrame:
        """(node, signature, shingles) of the nodes ``wanted``."""
        k = self.k

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingle_hashes(x, k).tobytes() for x in texts(batch.column(1))]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["node", "shingles"])

        shown = self.docs.join(wanted.select(F.col("node").alias("id")), "id", "left_semi").select("id", "text").distinct()
        found = arrow_map(shown, run, "node long, shingles binary", rows=256)
        return store(found.join(self.signatures, "node"), "near-sets")

    def __call__(self, pairs: DataFrame) -> DataFrame:
        """Verified links among distinct candidate pairs (a, b)."""
        at = lambda side, name: self.signatures.select(F.col("node").alias(side), F.col("signature").alias(name))
        alive = store(_prune(pairs.join(at("a", "sa"), "a").join(at("b", "sb"), "b").select("a", "b", "sa", "sb"), self.percent / 100).distinct(), "near-alive")
        wanted = store(alive.select(F.col("a").alias("id")).union(alive.select("b")).distinct(), "near-wanted")
        shown = store(self.docs.join(wanted, "id", "left_semi").distinct(), "near-texts")
        of = lambda side, name: shown.select(F.col("id").alias(side), F.col("text").alias(name))
        return store(_confirm(alive.join(of("b", "tb"), "b").join(of("a", "ta"), "a"), self.k, self.percent).distinct(), "near-links")


def _blocks(rows: DataFrame, shown: DataFrame, side: str, with_sets: bool) -> DataFrame:
    """Per bucket of ``rows`` (bucket, node, c, n): lists of at most about BLOCK nodes, and SHINGLES shingles if sets come along,
    with what ``shown`` has of each node."""
    sizes = [F.count("*") / BLOCK, *([F.sum("n") / SHINGLES] if with_sets else [F.lit(0.0)])]
    parts = rows.groupBy("bucket").agg(F.ceil(F.greatest(*sizes)).alias("parts"))
    placed = rows.join(parts, "bucket").select("bucket", "node", "c", F.pmod(F.xxhash64("node"), "parts").alias("part"))
    columns = ["node", "c", "signature", "shingles" if with_sets else "bands"]
    return (
        placed.join(shown, "node").groupBy("bucket", "part")
        .agg(F.collect_list(F.struct(*columns)).alias(side)).drop("part")
    )


def _in_doubt(pairs: DataFrame, percent: int) -> DataFrame:
    """(bucket, node): the nodes of two blocks that step 3 leaves a partner in another component, from signatures and bands.

    A pair in several buckets counts in that of its first common band alone. Every bucket that holds a pair of two
    components is open, so the first one is, and at least one of the pair is a stray in it.
    """
    stops = least_matches(percent / 100)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = []
        for name in ("strays", "nodes"):
            node, c, signature, bands = batch.column(name)[0].values.flatten()
            signs = np.frombuffer(b"".join(signature.to_pylist()), np.uint8).reshape(-1, HASHES)
            parts.append((node.to_numpy(), c.to_numpy(), signs, bands.flatten().to_numpy().reshape(-1, BANDS)))
        (strays, own, signs, bands), (nodes, theirs, others, their_bands) = parts
        bucket = batch.column("bucket")[0].as_py()
        met, doubt = np.zeros(len(nodes), bool), []
        for i in range(len(strays)):
            alive = _prune_one(signs[i], others, np.flatnonzero(theirs != own[i]), stops)
            alive = alive[bands[i][(their_bands[alive] == bands[i]).argmax(axis=1)] == bucket]
            if len(alive):
                doubt.append(strays[i])
                met[alive] = True
        found = np.unique(np.concatenate([np.array(doubt, np.int64), nodes[met]]))
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(found), bucket)), pa.array(found)], names=["bucket", "node"])

    return arrow_map(pairs.select("bucket", "strays", "nodes"), run, "bucket long, node long", rows=1)


class _Block:
    """Nodes of one bucket: ids, components, signatures, and their sets laid end to end."""

    def __init__(self, rows: pa.StructArray):
        node, c, signature, shingles = rows.flatten()
        self.node, self.c = node.to_numpy(), c.to_numpy()
        self.signature = np.frombuffer(b"".join(signature.to_pylist()), np.uint8).reshape(-1, HASHES)
        self.sets = [np.frombuffer(x, np.uint64) for x in shingles.to_pylist()]
        self.sizes = np.array([len(x) for x in self.sets], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])

    def numbered(self) -> tuple[np.ndarray, np.ndarray]:
        """All distinct shingles, and the place among them of each shingle of each set."""
        return np.unique(np.concatenate(self.sets), return_inverse=True)


def _prune_one(own: np.ndarray, others: np.ndarray, alive: np.ndarray, stops: list[tuple[int, int]]) -> np.ndarray:
    """Step 3 of one signature against the rows ``alive`` of ``others``."""
    matches, begin = np.zeros(len(alive), np.int64), 0
    for t, least in stops:
        matches = matches + (others[alive, begin:t] == own[begin:t]).sum(axis=1)
        stay = matches >= least
        alive, matches, begin = alive[stay], matches[stay], t
    return alive


def links_between(strays: _Block, nodes: _Block, percent: int) -> list[tuple[int, int]]:
    """Links that join all components of the two blocks that any link joins: at most one less than there are components."""
    stops = least_matches(percent / 100)
    names, own = np.unique(np.concatenate([strays.c, nodes.c]), return_inverse=True)
    every, place = nodes.numbered()
    shown, found = np.zeros(len(every), bool), []
    for i in range(len(strays.node)):
        theirs = own[len(strays.node):]
        alive = _prune_one(strays.signature[i], nodes.signature, np.flatnonzero(theirs != own[i]), stops)
        if not len(alive):
            continue
        at = np.minimum(np.searchsorted(every, strays.sets[i]), len(every) - 1)
        at = at[every[at] == strays.sets[i]]
        shown[at] = True
        if 8 * len(alive) > len(nodes.node):
            both = np.add.reduceat(shown[place].astype(np.int64), nodes.starts)[alive]
        else:
            both = np.array([shown[place[b : b + n]].sum() for b, n in zip(nodes.starts[alive], nodes.sizes[alive], strict=True)])
        shown[at] = False
        linked = (both > 0) & (100 * both >= percent * (strays.sizes[i] + nodes.sizes[alive] - both))
        for y in alive[linked]:
            gone = own[len(strays.node) + y]
            if gone != own[i]:
                found.append((int(strays.node[i]), int(nodes.node[y])))
                own[own == gone] = own[i]
    return found


def _compare_blocks(pairs: DataFrame, percent: int) -> DataFrame:
    """(a, b): steps 3 and 4 for strays and nodes of other components, as far as they join components."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = links_between(*(_Block(batch.column(name)[0].values) for name in ("strays", "nodes")), percent)
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return arrow_map(pairs.select("strays", "nodes"), run, "a long, b long", rows=1)


def _ordered(pairs: DataFrame) -> DataFrame:
    """Pairs with the smaller node first, each once."""
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _labels(links: DataFrame, nodes: DataFrame, members: DataFrame, verify: _Verifier) -> DataFrame:
    """(node, component) after all rounds of verification."""
    labels = components(links)

    def mixed() -> DataFrame:
        """Rows of the buckets that still hold several components."""
        at = members.where("size > 2").join(labels, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("c"))
        open_buckets = at.groupBy("bucket").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low != high").select("bucket")
        return store(at.join(open_buckets, "bucket"), "near-left")

    left = mixed()
    if left.isEmpty():
        return labels
    ends = links.select(F.col("a").alias("node")).union(links.select("b"))
    degree = ends.groupBy("node").agg(F.count("*").alias("d"))
    best = left.join(degree, "node").groupBy("bucket").agg(F.max(F.struct("d", "node", "c")).alias("m")).select("bucket", F.col("m.node").alias("x"), F.col("m.c").alias("cx"))
    links = links.union(verify(_ordered(left.join(best, "bucket").where("c != cx").select(F.col("x").alias("a"), F.col("node").alias("b")))))
    labels = components(links)

    left = mixed()
    if left.isEmpty():
        return labels
    largest = left.groupBy("bucket", "c").agg(F.count("*").alias("n")).groupBy("bucket").agg(F.max(F.struct("n", "c")).alias("m"))
    main = largest.select("bucket", F.col("m.c").alias("main"))
    counted = left.join(nodes.select("node", "n").dropDuplicates(["node"]), "node")
    strays = counted.join(main, "bucket").where("c != main").drop("main")
    signs = nodes.select("node", "signature", "bands")
    light = _blocks(strays, signs, "strays", False).join(_blocks(counted, signs, "nodes", False), "bucket")
    doubt = store(_in_doubt(light, verify.percent).distinct(), "near-doubt")
    if doubt.isEmpty():
        return labels
    sets = verify.sets(doubt.select("node").distinct())
    blocks = _blocks(strays.join(doubt, ["bucket", "node"]), sets, "strays", True).join(_blocks(counted.join(doubt, ["bucket", "node"]), sets, "nodes", True), "bucket")
    return components(links.union(verify(_ordered(_compare_blocks(blocks, verify.percent)))))


def find_components(docs: DataFrame, k: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component) per row: the smallest id it is linked with, itself included."""
    rows = store(sketch(docs, k, key, text), "near-sketches")
    nodes = store(
        rows.where("set is not null and id is not null").groupBy("set")
        .agg(F.min("id").alias("node"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("signature").alias("signature")),
        "near-nodes",
    )
    every = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = every.groupBy("bucket").agg(F.count("*").alias("size"), F.min("node").alias("leader")).where("size > 1")
    members = store(every.join(shared, "bucket"), "near-buckets")
    verify = _Verifier(docs, nodes, k, percent, key, text)
    links = verify(members.where("node != leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct())
    found = _labels(links, nodes, members, verify)
    of_set = nodes.select("set", "node").join(found, "node", "left").select("set", F.coalesce("component", "node").alias("component"))
    return rows.select("id", "n", "set").join(of_set, "set", "left").select(
        "id", F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component")
    )


def drop_near_copies(docs: DataFrame, k: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents but for those linked with a smaller id; repeated rows with one id stay together."""
    found = find_components(docs, k, percent, key, text)
    gone = store(found.where("component < id").select(F.col("id").alias(key)).distinct(), "near-gone")
    return docs.join(gone, key, "left_anti")


_SQL = r"""
with recursive word as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') as w from documents),
shingle as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) = 1 then [w[1]]
         else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end) as s from word),
size as (select doc_id, count(*) as n from shingle group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from shingle a join shingle b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
link as (
  select a, b from common join size x on x.doc_id = a join size y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)),
edge as (select a, b from link union all select b, a from link),
reach as (select a as doc_id, a as node from edge union select reach.doc_id, edge.b from reach join edge on reach.node = edge.a),
comp as (select doc_id, min(node) as c from reach group by doc_id)
select doc_id, coalesce(n, 0)::bigint as n_shingles, coalesce(c, doc_id) as component_id, coalesce(c, doc_id) = doc_id as kept
from documents left join size using (doc_id) left join comp using (doc_id)
"""


@query("op6_near_dedup", _SQL)
def op6_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = find_components(table(spark, folder, "documents"), k=2, percent=80)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"),
                        (F.col("id") == F.col("component")).alias("kept"))
