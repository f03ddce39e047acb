"""Entity resolution between two sides of the documents."""

from functools import cached_property

from pyspark.sql import functions as F

from millrace.functions.numbers import score_bin
from millrace.operators import aggregates as agg
from millrace.operators import entity as er
from millrace.plans.inputs import SIDE, records
from millrace.plans.registry import query
from millrace.plans.words import KEPT

FLOOR = 0.05  # least cosine in the listing of other pairs than known duplicates, whose length would else grow with the square of the table
LOWEST = 0.0099999  # reaches every pair of bin 1, whose scores are rounded before they are binned

SQL_RECORDS = f"""
rec AS (SELECT doc_id, {SIDE} AS side, text, {KEPT} AS tokens FROM documents),
tok AS (SELECT doc_id, side, unnest(tokens) AS token, len(tokens) AS total FROM rec),
tf AS (SELECT doc_id, side, token, count(*) / any_value(total) AS tf FROM tok GROUP BY 1, 2, 3),
idf AS (SELECT token, (SELECT count(*) FROM rec) / count(*) AS idf FROM tf GROUP BY 1),
wt AS (SELECT doc_id, side, token, tf * idf AS w FROM tf JOIN idf USING (token)),
nrm AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM wt GROUP BY 1)
"""
SQL_PAIRS = SQL_RECORDS + f""",
sims AS (
  SELECT a.doc_id AS a_id, b.doc_id AS b_id, s / (na.norm * nb.norm) AS raw, round(s / (na.norm * nb.norm), 9) AS sim, n_shared
  FROM (SELECT a.doc_id AS ai, b.doc_id AS bi, sum(a.w * b.w) AS s, count(*) AS n_shared
        FROM wt a JOIN wt b USING (token) WHERE a.side = 'a' AND b.side = 'b' GROUP BY 1, 2) p
  JOIN rec a ON a.doc_id = ai JOIN rec b ON b.doc_id = bi
  JOIN nrm na ON na.doc_id = ai JOIN nrm nb ON nb.doc_id = bi),
gold AS (SELECT a.doc_id AS a_id, b.doc_id AS b_id FROM rec a JOIN rec b
         ON lower(trim(a.text)) = lower(trim(b.text)) WHERE a.side = 'a' AND b.side = 'b'),
gs AS (SELECT a_id, b_id, coalesce(sim, 0) AS sim, coalesce(raw, 0) AS raw FROM gold LEFT JOIN sims USING (a_id, b_id)),
bag AS (SELECT doc_id, side, md5(array_to_string(list_sort(tokens), ' ')) AS bag FROM rec),
rep AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY bag, side) AS rep FROM bag),
near AS (SELECT * FROM sims WHERE sim >= {FLOOR})
"""
SQL_BINS = SQL_PAIRS + """,
spread AS (SELECT floor(round(sim * 100, 6)) AS bin, count(*) AS c FROM sims GROUP BY 1
           UNION ALL SELECT 0, (SELECT count(*) FROM rec a, rec b WHERE a.side = 'a' AND b.side = 'b') - (SELECT count(*) FROM sims)),
bins AS (
  SELECT CAST(bin AS INTEGER) AS bin, CAST(coalesce(c, 0) AS BIGINT) AS candidates, coalesce(g, 0) AS gold,
         CAST(coalesce(c, 0) - coalesce(g, 0) AS BIGINT) AS net
  FROM range(0, 101) AS x(bin)
  LEFT JOIN (SELECT bin, sum(c) AS c FROM spread GROUP BY 1) USING (bin)
  LEFT JOIN (SELECT floor(round(sim * 100, 6)) AS bin, count(*) AS g FROM gs GROUP BY 1) USING (bin))
"""
SQL_SWEEP = SQL_BINS + """,
sweep AS (
  SELECT k / 100 AS threshold,
         (SELECT count(*) FROM gs WHERE sim >= k / 100) AS tp,
         CAST((SELECT sum(net) FROM bins WHERE bin >= k) AS BIGINT) AS fp,
         (SELECT count(*) FROM gs WHERE sim < k / 100) AS fn
  FROM range(0, 100) AS x(k))
"""


# ---- weights per record -------------------------------------------------------------------


def _docs(t):
    return records(t).drop("side", "gold_key")


def _docs_with_side(t):
    return records(t).drop("gold_key")


@query("tf", f"WITH {SQL_RECORDS} SELECT doc_id, token, round(tf, 9) AS tf FROM tf")
def tf(t):
    return er.tf(_docs(t), "doc_id").withColumn("tf", F.round("tf", 9))


@query("idf", f"WITH {SQL_RECORDS} SELECT token, round(idf, 6) AS idf FROM idf")
def idf(t):
    return er.idf(_docs(t)).withColumn("idf", F.round("idf", 6))


@query("tfidf", f"WITH {SQL_RECORDS} SELECT doc_id, token, round(w, 6) AS weight FROM wt")
def tfidf(t):
    return er.tfidf(_docs(t), "doc_id", er.stored_idf(_docs(t))).withColumn("weight", F.round("weight", 6))


@query("broadcast_lookup", f"""
WITH {SQL_RECORDS} SELECT doc_id, token, round(idf, 6) AS idf FROM tf JOIN idf USING (token)
""")
def broadcast_lookup(t):
    # the stored table's size decides: broadcast while small, else a shuffle whose hot tokens
    # adaptive execution splits
    idfs = er.stored_idf(_docs(t)).withColumn("idf", F.round("idf", 6))
    return er.tf(_docs(t), "doc_id").join(idfs, "token").select("doc_id", "token", "idf")


@query("vector_norm", f"WITH {SQL_RECORDS} SELECT doc_id, round(norm, 6) AS norm FROM nrm")
def vector_norm(t):
    weights = er.tfidf(_docs(t), "doc_id", er.stored_idf(_docs(t)))
    return er.vector_norm(weights, "doc_id").withColumn("norm", F.round("norm", 6))


@query("dot_product", f"""
WITH {SQL_RECORDS}, ma AS (SELECT token, sum(w) AS w FROM wt WHERE side = 'a' GROUP BY 1),
mb AS (SELECT token, sum(w) AS w FROM wt WHERE side = 'b' GROUP BY 1)
SELECT round(sum(ma.w * mb.w), 3) AS dot FROM ma JOIN mb USING (token)
""")
def dot_product(t):
    """Of the two sides' summed vectors."""
    docs = records(t)
    # summed first, as a token's idf is the same for all: rows per record meet no other table but that of the sides
    frequencies = er.tf(docs, "doc_id").join(docs.select("doc_id", "side"), "doc_id")
    summed = er.weigh(frequencies.groupBy("side", "token").agg(F.sum("tf").alias("tf")), "side", er.stored_idf(docs))
    left, right = (summed.where(F.col("side") == s).select("token", "weight") for s in "ab")
    return er.dot_product(left, right).withColumn("dot", F.round("dot", 3))


@query("inverted_index", f"WITH {SQL_RECORDS} SELECT token, doc_id FROM wt")
def inverted_index(t):
    return er.inverted_index(er.tf(_docs(t), "doc_id"), "doc_id")


@query("smallest_idf", f"WITH {SQL_RECORDS} SELECT token, round(idf, 6) AS idf FROM idf ORDER BY idf.idf, token LIMIT 11")
def smallest_idf(t):
    return agg.bottom_k(er.idf(_docs(t)), 11, "idf", "token").withColumn("idf", F.round("idf", 6))


@query("histogram_50", f"""
WITH {SQL_RECORDS}, m AS (SELECT min(idf) AS lo, max(idf) AS hi FROM idf),
h AS (SELECT least(floor((idf - lo) / (hi - lo) * 50), 49) AS bin, count(*) AS n FROM idf, m GROUP BY 1)
SELECT CAST(bin AS INTEGER) AS bin, coalesce(n, 0) AS n FROM range(50) AS x(bin) LEFT JOIN h USING (bin)
""")
def histogram_50(t):
    return agg.histogram(er.idf(_docs(t)), "idf", 50)


# ---- pairs of the two sides ---------------------------------------------------------------


class Catalogue:
    """The stored tables that the pair jobs share."""

    def __init__(self, t):
        bagged = er.store(er.with_bags(records(t)), "bagged", codec="zstd")
        self.bags = er.store(er.fold_copies(bagged, "doc_id"), "bags")
        self._bagged = bagged

    @cached_property
    def vectors(self):
        return er.bag_vectors(self._bagged, self.bags, "doc_id")

    @cached_property
    def gold_vectors(self):
        """Of the bags of known duplicates alone."""
        named = self.gold.select(F.explode(F.array("left_bag", "right_bag")).alias("bag"))
        return er.bag_vectors(self._bagged, self.bags, "doc_id", wanted=named)

    @cached_property
    def gold(self):
        return er.store(er.gold_pairs(self._bagged, F.col("gold_key")), "gold")

    def similar(self, floor=FLOOR):
        return er.similar_bags(self.vectors, floor)

    def sharing(self):
        """Pairs that share a token, however low their cosine, by the least document on either side."""
        pairs = er.similar_bags(self.vectors, 0, names=self.bags)
        return pairs.withColumnsRenamed({"left_id": "a_id", "right_id": "b_id"})

    def binned(self):
        """Pairs of bin 1 and above, with a score of the right bin."""
        return er.similar_bags(self.vectors, LOWEST, alike=score_bin)

    def gold_scores(self, vectors=None):
        return er.score_pairs(self.gold, vectors or self.vectors)

    def named(self, pairs):
        """Bag pairs by the least document on either side."""
        left = self.bags.select(F.col("bag").alias("left_bag"), F.col("left_id").alias("a_id"))
        right = self.bags.select(F.col("bag").alias("right_bag"), F.col("right_id").alias("b_id"))
        return pairs.join(left, "left_bag").join(right, "right_bag")


@query("cross_pairs", f"""
WITH rec AS (SELECT source, {SIDE} AS side FROM documents)
SELECT a.source, count(*) AS n_pairs, count(*) // (SELECT count(*) FROM rec WHERE side = 'b') AS n_left,
       (SELECT count(*) FROM rec WHERE side = 'b') AS n_right
FROM rec a, rec b WHERE a.side = 'a' AND b.side = 'b' GROUP BY 1
""")
def cross_pairs(t):
    sides = t.documents.select("source", F.expr(SIDE).alias("side"))
    return er.cross_pair_totals(sides.where("side = 'a'"), sides.where("side = 'b'"), "source")


@query("cosine_all_pairs", f"""
WITH {SQL_PAIRS}, nb AS (SELECT count(*) AS n FROM rec WHERE side = 'b')
SELECT rep AS left_id, count(*) AS n_left, count(*) * any_value(n) AS n_pairs,
       round(coalesce(any_value(s), 0) / any_value(n), 6) AS mean_similarity
FROM rec JOIN rep USING (doc_id) LEFT JOIN (SELECT a_id, sum(sim) AS s FROM sims GROUP BY 1) ON a_id = doc_id, nb
WHERE side = 'a' GROUP BY 1
""")
def cosine_all_pairs(t):
    c = Catalogue(t)
    return er.mean_cosine_per_record(c.vectors, c.bags).withColumn(
        "mean_similarity", F.round("mean_similarity", 6)
    )


@query("postings_join", f"""
WITH {SQL_RECORDS}
SELECT token, count(DISTINCT a.doc_id) AS n_left, count(DISTINCT b.doc_id) AS n_right, count(*) AS n_pairs
FROM wt a JOIN wt b USING (token) WHERE a.side = 'a' AND b.side = 'b' GROUP BY 1
""")
def postings_join(t):
    return er.postings_join(_docs_with_side(t))


@query("cosine_inverted", f"""
WITH {SQL_PAIRS}
SELECT ra.rep AS a_id, rb.rep AS b_id, count(*) AS n_pairs, round(avg(raw), 6) AS similarity
FROM sims JOIN rep ra ON ra.doc_id = a_id JOIN rep rb ON rb.doc_id = b_id GROUP BY 1, 2
""")
def cosine_inverted(t):
    """Of all pairs that share a token."""
    pairs = Catalogue(t).sharing()
    return pairs.select("a_id", "b_id", "n_pairs", F.round("similarity", 6).alias("similarity"))


@query("common_tokens", f"""
WITH {SQL_PAIRS}, d AS (SELECT DISTINCT ra.rep AS a_id, rb.rep AS b_id
  FROM sims JOIN rep ra ON ra.doc_id = a_id JOIN rep rb ON rb.doc_id = b_id)
SELECT a_id, b_id, string_agg(a.token, ' ' ORDER BY encode(a.token)) AS shared
FROM d JOIN wt a ON a.doc_id = a_id JOIN wt b ON b.doc_id = b_id AND a.token = b.token GROUP BY 1, 2
""")
def common_tokens(t):
    """Of all pairs that share a token."""
    c = Catalogue(t)
    pairs = er.common_tokens(None, c.vectors, c.bags).withColumnsRenamed({"left_id": "a_id", "right_id": "b_id"})
    return pairs.select("a_id", "b_id", F.array_join("shared", " ").alias("shared"))


@query("join_gold", f"""
WITH {SQL_PAIRS}
SELECT ra.rep AS a_id, rb.rep AS b_id, count(*) AS n_gold, round(avg(raw), 6) AS similarity
FROM sims JOIN gold USING (a_id, b_id) JOIN rep ra ON ra.doc_id = a_id JOIN rep rb ON rb.doc_id = b_id GROUP BY 1, 2
""")
def join_gold(t):
    c = Catalogue(t)
    pairs = c.named(er.join_gold(c.gold, c.gold_vectors))
    return pairs.select("a_id", "b_id", "n_gold", F.round("similarity", 6).alias("similarity"))


@query("anti_gold", f"""
WITH {SQL_PAIRS}
SELECT ra.rep AS a_id, rb.rep AS b_id, count(*) AS n_pairs, round(avg(raw), 6) AS similarity
FROM near ANTI JOIN gold USING (a_id, b_id)
JOIN rep ra ON ra.doc_id = a_id JOIN rep rb ON rb.doc_id = b_id GROUP BY 1, 2
""")
def anti_gold(t):
    c = Catalogue(t)
    pairs = c.named(er.anti_gold(c.similar(), c.gold))
    return pairs.select("a_id", "b_id", "n_pairs", F.round("similarity", 6).alias("similarity"))


@query("gold_default_zero", f"""
WITH {SQL_PAIRS}
SELECT ra.rep AS a_id, rb.rep AS b_id, count(*) AS n_gold, round(avg(raw), 6) AS similarity
FROM gs JOIN rep ra ON ra.doc_id = a_id JOIN rep rb ON rb.doc_id = b_id GROUP BY 1, 2
""")
def gold_default_zero(t):
    c = Catalogue(t)
    pairs = c.named(c.gold_scores(c.gold_vectors))
    return pairs.select("a_id", "b_id", "n_gold", F.round("similarity", 6).alias("similarity"))


@query("avg_similarity", f"""
WITH {SQL_PAIRS},
n AS (SELECT count(*) FILTER (side = 'a') * count(*) FILTER (side = 'b') AS pairs FROM rec)
SELECT round((SELECT avg(sim) FROM gs), 6) AS avg_duplicates,
       round(((SELECT sum(sim) FROM sims) - (SELECT sum(sim) FROM gs)) / (pairs - (SELECT count(*) FROM gs)), 6) AS avg_others
FROM n
""")
def avg_similarity(t):
    c = Catalogue(t)
    means = er.average_similarity(c.vectors, c.bags, c.gold_scores())
    return means.select(*[F.round(c, 6).alias(c) for c in means.columns])


@query("score_bin", f"WITH {SQL_BINS} SELECT bin, candidates AS n FROM bins")
def score_bin_query(t):
    c = Catalogue(t)
    return er.pairs_per_bin(c.binned(), er.pair_total(c.bags))


def _bins(t):
    c = Catalogue(t)
    golden = er.store(c.gold_scores(), "gold-scores")
    return er.threshold_bins(c.binned(), golden, er.pair_total(c.bags)), golden


@query("threshold_bins", f"WITH {SQL_BINS} SELECT bin, candidates, gold, net FROM bins")
def threshold_bins(t):
    return _bins(t)[0]


@query("er_confusion_by_threshold", f"WITH {SQL_SWEEP} SELECT threshold, tp, fp, fn FROM sweep")
def er_confusion_by_threshold(t):
    return er.confusion_by_threshold(*_bins(t))


@query("er_precision_recall", f"""
WITH {SQL_SWEEP}, pr AS (
  SELECT threshold, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END AS precision,
         CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END AS recall FROM sweep)
SELECT threshold, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(CASE WHEN recall + precision > 0 THEN 2 * recall * precision / (recall + precision) END, 6) AS f_measure FROM pr
""")
def er_precision_recall(t):
    rates = er.precision_recall(er.confusion_by_threshold(*_bins(t)))
    return rates.select("threshold", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f_measure")])
