"""Sentiment of sentences and extractive summaries."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import sentences, tokenize_simple, tokenize_stop


_HOT = 50_000  # tokens whose weights are broadcast
_DOCS = 4096  # documents of a partition whose words are sorted


def sentence_table(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    return docs.select(key, F.posexplode(sentences(F.col(text))).alias("pos", "sentence"))


def extractive_summary(docs: DataFrame, key: str, text: str = "text", n: int = 5) -> DataFrame:
    """The n sentences of each document whose content words are most frequent in it (Luhn 1958):
    (key, pos, score, sentence).

    The texts are spread by key once; word frequencies, scores and ranks are all per document
    and reuse that spread. Its partitions grow in number and not in size, as a task sorts all words of its own.
    """
    n_parts = max(math.ceil(docs.count() / _DOCS), docs.sparkSession.sparkContext.defaultParallelism)
    parts = sentence_table(docs.select(key, text).repartition(n_parts, key), key, text)
    words = parts.select(key, "pos", F.explode(tokenize_stop(F.col("sentence"))).alias("token"))
    per_word = words.withColumn("freq", F.count("*").over(Window.partitionBy(key, "token")))
    scores = per_word.groupBy(key, "pos").agg(F.sum("freq").alias("score"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("score"), F.asc("pos")))
    best = scores.withColumn("rank", rank).where(F.col("rank") <= n).drop("rank")
    return parts.join(best, [key, "pos"]).select(key, "pos", "score", "sentence")


class SentimentModel:
    """Two-class naive Bayes as a table of token weights and two numbers.

    A token's weight is the log of its smoothed rate in positive texts over that in negative
    ones, so a text's margin is one sum. ``weights`` is (token, n, weight), n its count; ``base`` is one row
    (prior, unknown): the classes' log odds and the weight of a token seen in neither. Texts are
    told apart by their keys.
    """

    def __init__(self, weights: DataFrame, base: DataFrame):
        self.weights = weights
        self.base = base

    @classmethod
    def train(cls, texts: DataFrame, label: str, text: str = "text") -> SentimentModel:
        positive = F.col(label) == 1
        tokens = texts.select(label, F.explode(tokenize_simple(F.col(text))).alias("token"))
        counts = tokens.groupBy("token").agg(
            F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
        )
        totals = counts.agg(
            F.struct(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.count("*").alias("size"))
        ).scalar()
        pos_total = totals.getField("pos") + totals.getField("size")
        neg_total = totals.getField("neg") + totals.getField("size")
        unknown = F.log(neg_total / pos_total)
        weights = counts.select(
            "token", (F.col("pos") + F.col("neg")).alias("n"), (F.log((F.col("pos") + 1) / (F.col("neg") + 1)) + unknown).alias("weight")
        )
        classes = texts.agg(F.count_if(positive).alias("p"), F.count_if(~positive).alias("n"))
        base = classes.select(F.log((F.col("p") + 1) / (F.col("n") + 1)).alias("prior"), unknown.alias("unknown"))
        return cls(weights, base)

    def score(self, texts: DataFrame, keys: list[str], text: str) -> DataFrame:
        """(keys.., margin, label) for every text; POS where the margin is not below 0."""
        prior = self.base.select("prior").scalar()
        unknown = self.base.select("unknown").scalar()
        # the outer explode keeps texts without tokens; a text's tokens lie together, so beside the broadcast weights of
        # the frequent ones, a bounded number, the sums shrink to a row per text before the shuffle. Only the rows of
        # rarer tokens are spread by token, and none of those fills a task
        tokens = texts.select(*keys, F.explode_outer(tokenize_simple(F.col(text))).alias("token"))
        is_hot = F.col("n") >= self.weights.agg(F.sum("n") / _HOT).scalar()
        hot = F.broadcast(self.weights.where(is_hot).select("token", "weight"))
        often = tokens.join(hot, "token", "left").select(*keys, "weight", F.lit(0).alias("unseen"))
        rare = (
            tokens.where("token is not null")
            .join(hot, "token", "left_anti")
            .join(self.weights.where(~is_hot).select("token", "weight"), "token", "left")
            .select(*keys, "weight", F.col("weight").isNull().cast("int").alias("unseen"))
        )
        sums = often.unionByName(rare).groupBy(*keys).agg(F.sum("weight").alias("seen"), F.sum("unseen").alias("unseen"))
        margin = F.coalesce("seen", F.lit(0.0)) + F.col("unseen") * unknown + prior
        return sums.select(*keys, F.round(margin, 6).alias("margin")).withColumn(
            "label", F.when(F.col("margin") >= 0, "POS").otherwise("NEG")
        )
