"""Language identification as mixture inference.

Training counts character trigrams of words per language and gives each language a smoothed distribution over
hashed trigrams. A document is a mixture of languages: expectation-maximisation over its distinct words finds
the proportions. Languages are added in the order of their proportions under all languages, and the set is the
one of the largest likelihood penalised by half the log of the number of words per language (BIC). The
prediction is the language of the largest proportion in that set, and the proportion is its score.

Training takes a bounded sample: about ``SAMPLE`` documents per language, drawn by a hash of the key. The
model, languages times ``BUCKETS`` numbers, is gathered on the driver and broadcast; its size depends on the number of
languages only. Prediction reads each whole text once in its task, without a shuffle.

Defined cases: a null text or one without a letter is ``und`` with score 0; without training rows every text is
``und``; equal proportions go to the language that sorts first; null keys never train and are not held out;
columns other than key, text and language are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import arrow_map, table, texts
from llm.registry import query

BUCKETS, SMOOTH, ROUNDS, SAMPLE = 1 << 14, 0.1, 12, 3000
_WORD = re.compile(r"[^\W\d_]+")
_DOCS = 256  # documents whose mixtures are inferred together


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram buckets of words with a blank at both ends, and where each word's begin."""
    line = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le"), np.uint32).astype(np.uint64)
    h = (line[:-2] * np.uint64(0x9E3779B1) + line[1:-1]) * np.uint64(0x85EBCA77) + line[2:]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    inside = line[1:-1] != 32
    buckets = (h >> np.uint64(50)).astype(np.int64)[inside]
    lengths = np.array([len(w) for w in words], np.int64)
    return buckets, np.cumsum(lengths) - lengths


def count_trigrams(labelled: DataFrame) -> DataFrame:
    """(lang, bucket, n) over (lang, text)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        by_lang: dict[str, list[str]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
            by_lang.setdefault(lang, []).extend(_WORD.findall(text.lower()))
        langs, buckets, counts = [], [], []
        for lang, words in by_lang.items():
            if words:
                n = np.bincount(trigrams(words)[0], minlength=BUCKETS)
                used = np.flatnonzero(n)
                langs += [lang] * len(used)
                buckets.append(used), counts.append(n[used])
        flat = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(flat(buckets)), pa.array(flat(counts))], names=["lang", "bucket", "n"])

    return arrow_map(labelled.select("lang", "text"), run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(labelled: DataFrame, sample: int = SAMPLE, key: str = "doc_id") -> tuple[list[str], np.ndarray]:
    """Languages in order, and their log-probabilities per trigram bucket."""
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return [], np.zeros((BUCKETS, 0), np.float32)
    share = F.create_map(*[F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, min(1.0, sample / n))])
    drawn = labelled.where(F.pmod(F.xxhash64(key), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))
    langs = sorted(sizes)
    counts = np.zeros((BUCKETS, len(langs)))
    at = {lang: i for i, lang in enumerate(langs)}
    for row in count_trigrams(drawn).collect():
        counts[row["bucket"], at[row["lang"]]] = row["n"]
    return langs, np.log((counts + SMOOTH) / (counts.sum(axis=0) + SMOOTH * BUCKETS)).astype(np.float32)


def _proportions(p: np.ndarray, uses: np.ndarray, doc: np.ndarray, starts: np.ndarray, allowed: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Mixing proportions per document among its allowed languages, and the log-likelihood."""
    total = np.add.reduceat(uses, starts)
    pi = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(rounds):
        joint = p * pi[doc]
        joint *= (uses / joint.sum(axis=1))[:, None]
        pi = np.add.reduceat(joint, starts, axis=0) / total[:, None]
        pi = np.maximum(pi, 1e-9) * allowed
        pi /= pi.sum(axis=1, keepdims=True)
    return pi, np.add.reduceat(uses * np.log((p * pi[doc]).sum(axis=1)), starts)


def infer(documents: list[str], model: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the chosen languages per document (zero rows for texts without a letter), and which
    documents have letters."""
    numbers: dict[str, int] = {}
    codes = [np.array([numbers.setdefault(w, len(numbers)) for w in _WORD.findall(t.lower())], np.int64) for t in documents]
    pi = np.zeros((len(documents), model.shape[1]))
    full = np.array([len(c) > 0 for c in codes])
    if not full.any() or not model.shape[1]:
        return pi, full
    buckets, begin = trigrams(list(numbers))
    logp = np.add.reduceat(model[buckets], begin, axis=0).astype(np.float64)
    pairs = np.concatenate([i * len(numbers) + c for i, c in enumerate(codes)])
    pairs, uses = np.unique(pairs, return_counts=True)
    uses = uses.astype(np.float64)
    owner, word = np.divmod(pairs, len(numbers))
    _, starts, doc = np.unique(owner, return_index=True, return_inverse=True)
    own = logp[word]
    top = own.max(axis=1)
    p = np.maximum(np.exp(own - top[:, None]), 1e-30)
    shift = np.add.reduceat(uses * top, starts)
    n = np.add.reduceat(uses, starts)
    every, _ = _proportions(p, uses, doc, starts, np.ones((len(starts), p.shape[1])), ROUNDS)
    # ties go to the first language
    place = np.argsort(np.argsort(-every, axis=1, kind="stable"), axis=1)
    best, best_score = np.zeros_like(every), np.full(len(starts), -np.inf)
    for size in range(1, p.shape[1] + 1):
        chosen, likely = _proportions(p, uses, doc, starts, (place < size).astype(float), 1 if size == 1 else ROUNDS)
        score = likely + shift - 0.5 * size * np.log(n + 1)
        better = score > best_score
        best[better], best_score[better] = chosen[better], score[better]
        if not better.any():
            break
    pi[full] = best
    return pi, full


def predict(docs: DataFrame, langs: list[str], model: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score, languages): the main language, its share, and all chosen ones with shares."""
    sent = docs.sparkSession.sparkContext.broadcast((langs, model))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, model = sent.value
        preds, scores, chosen = [], [], []
        values = texts(batch.column(1))
        for start in range(0, len(values), _DOCS):
            pi, full = infer(values[start : start + _DOCS], model)
            for row, has in zip(pi, full, strict=True):
                if not has or not langs:
                    preds.append("und"), scores.append(0.0), chosen.append([])
                    continue
                first = int(np.argmax(row))
                preds.append(langs[first]), scores.append(min(float(row[first]), 1.0))
                chosen.append([{"lang": langs[i], "share": float(row[i])} for i in np.flatnonzero(row)])
        kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(preds, pa.string()), pa.array(scores, pa.float64()), pa.array(chosen, kind)],
            names=[key, "lang_pred", "score", "languages"],
        )

    narrow = docs.select(F.col(key).cast("long").alias(key), F.col(text).alias(text))
    return arrow_map(narrow, run, f"`{key}` long, lang_pred string, score double, languages array<struct<lang:string,share:double>>")


def fold(key: str | Column, folds: int) -> Column:
    """crc32 of the key as text, modulo the number of folds."""
    column = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(folds))


@query("op4_language_id")
def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(fold("doc_id", 3) == 1, F.lit(False))
    langs, model = train(docs.where(F.col("lang").isNotNull() & (fold("doc_id", 3) != 1)).select("doc_id", "lang", "text"))
    found = predict(docs, langs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "languages")
