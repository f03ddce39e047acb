"""Word counting and record tokens."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import clean_text, split_words, tokenize_stop
from millrace.operators.aggregates import count_by_key


def words_of(df: DataFrame, pieces: Column, name: str = "word") -> DataFrame:
    return df.select(F.explode(pieces).alias(name))


def cleaned_words(df: DataFrame, text: str = "text") -> DataFrame:
    """Words of the cleaned text, empties dropped."""
    return words_of(df, split_words(clean_text(F.col(text)))).where("word != ''")


def word_count(df: DataFrame, text: str = "text") -> DataFrame:
    return count_by_key(cleaned_words(df, text), "word")


def mean_per_unique(counts: DataFrame, count: str = "n") -> DataFrame:
    return counts.agg(F.round(F.sum(count) / F.count("*"), 2).alias("mean_count"))


def record_tokens(
    df: DataFrame,
    text: str = "text",
    tokenize: Callable[[Column], Column] = tokenize_stop,
) -> DataFrame:
    """The table with a ``tokens`` array in place of its text."""
    return df.withColumn("tokens", tokenize(F.col(text))).drop(text)


def token_total(records: DataFrame) -> DataFrame:
    return records.agg(F.sum(F.size("tokens")).alias("n_tokens"))


def biggest_record(records: DataFrame, key: str) -> DataFrame:
    return (
        records.select(key, F.size("tokens").alias("n_tokens"))
        .orderBy(F.desc("n_tokens"), F.asc(key))
        .limit(1)
    )


def word_frequency_prior(words: DataFrame) -> DataFrame:
    """Frequency that starts at 1 for every word: count + 1."""
    return words.groupBy("word").agg((F.count("*") + 1).alias("freq"))
