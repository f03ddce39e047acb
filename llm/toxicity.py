"""Toxicity by a support vector machine on a subsequence string kernel with Nyström landmarks.

The kernel compares two words by the subsequences of three characters they share, gaps and inserted characters
included: a subsequence over a stretch of length l weighs ``DECAY`` ** l, and the sum is raised to ``POWER``, which is a
kernel again and sets whole matches apart. The beginning of a word is a character of
its own; characters that are no letters only widen gaps, and letters spelled out with blanks between are joined, so
``i.d i o-t`` still meets ``idiot``. Landmarks are words and beginnings of words of labelled texts: those most bound
to toxic ones, no two alike, and frequent ones of the others. A sentence's vector is, per landmark, the largest
kernel value of its words; multiplied by the inverse root of the landmarks' own kernel matrix (Nyström) it is the
input of a linear SVM with squared hinge loss.

Labels are on documents, so a toxic document is a bag with at least one toxic sentence: training picks its
witness sentence anew in each round. A document's score is a logistic fit on the margins of all its sentences:
the largest, and the sum and the mean of how far they are on the toxic side. So one clear insult counts, and so do
many faint ones close together.

Training takes about ``SAMPLE`` labelled documents, drawn by a hash of the key, ``INSTANCES`` sentences of each; that
bounds what reaches the driver. Scoring reads each whole text once in its task, without a shuffle; the model
that is broadcast has a fixed size.

Defined cases: a null or empty text has one empty sentence and gets that sentence's score; without labelled
rows, or with one class only, every score is the share of toxic labels, 0 without any; of several labels of one document
the largest counts; null labels and keys are not used; other columns are not read.
"""

from __future__ import annotations

import re
from itertools import combinations, islice, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import arrow_map, store, table, texts
from llm.language_id import fold
from llm.registry import query

DECAY, POWER, LANDMARKS, SAMPLE, INSTANCES = 0.7, 3, 64, 8000, 3
LONGEST, STRIDE = 16, 8  # longer words are read in overlapping windows
ALIKE = 0.5  # largest kernel of two toxic landmarks
KEPT_WORDS = 200_000  # words whose kernels a Python worker keeps: some 50 MB
_DOCS = 512  # documents whose words are looked up together
_WORDS = 16384  # words whose kernels are laid side by side
_SPELLED = re.compile(rb"(?<!\S)(?:[a-z][^a-z\s]?\s+){2,}[a-z][^a-z\s]?(?!\S)")
_INSIDE = re.compile(r"(?<=[^\W\d_])[^\w\s]+(?=[^\W\d_])")
_ENDS = frozenset(b".!?")
_MARKS = b"0123456789!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# Codes of characters: 0 to 25 a to z, 26 to 29 other letters, 30 the beginning of a word, 31 anything else.
_BEGIN, _OTHER, _SIZE = 30, 31, 32
_CUBE = _SIZE**3
_BMP = np.full(1 << 16, _OTHER, np.int64)
_BMP[[i for i in range(0x80, 1 << 16) if chr(i).isalpha()]] = [26 + i % 4 for i in range(0x80, 1 << 16) if chr(i).isalpha()]
_BMP[97:123] = np.arange(26)
_BMP[1] = _BEGIN
# Subsequences with a character that is no letter carry no weight.
_LETTERS = ~np.any(np.indices((_SIZE,) * 3).reshape(3, -1) == _OTHER, axis=0)


def _codes(text: str) -> np.ndarray:
    return _BMP[np.minimum(np.frombuffer(text.encode("utf-32-le"), np.uint32), 0xFFFF)]


def _windows(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of the words as rows of codes, their lengths, and each window's word."""
    pieces, owner = [], []
    for i, word in enumerate(words):
        # marks inside a word are read as gaps, and once more as if they were not there
        bare = _INSIDE.sub("", word) if _INSIDE.search(word) else None
        for text in ("\x01" + word,) if bare is None else ("\x01" + word, "\x01" + bare):
            for start in range(0, max(len(text) - STRIDE, 1), STRIDE) if len(text) > LONGEST else (0,):
                pieces.append(text[start : start + LONGEST])
                owner.append(i)
    lengths = np.array([len(p) for p in pieces])
    flat = np.full((len(pieces), LONGEST), _OTHER, np.int64)
    flat[np.arange(LONGEST) < lengths[:, None]] = _codes("".join(pieces))
    return flat, lengths, np.array(owner)


def feature_table(landmarks: list[str]) -> np.ndarray:
    """Weights of all subsequences of three characters in each landmark, scaled so that a landmark's kernel with
    itself is 1: (number of subsequences, landmarks)."""
    weights = np.zeros((_CUBE, len(landmarks)))
    if landmarks:
        for m, word in enumerate(landmarks):
            codes = _codes("\x01" + word[: LONGEST - 1])
            size = len(codes)
            for i, j, k in combinations(range(size), 3):
                weights[(codes[i] * _SIZE + codes[j]) * _SIZE + codes[k], m] += DECAY ** (k - i + 1)
        weights[~_LETTERS] = 0
    norm = (weights**2).sum(axis=0)
    return (weights / np.where(norm > 0, norm, 1)).astype(np.float32)


class WordKernels:
    """Kernels of words, computed once per word: up to ``most`` words are kept, then all are forgotten.

    Subsequences that no landmark holds add nothing, so they share one row of zeros; the table that is left fits a
    processor's cache.
    """

    def __init__(self, weights: np.ndarray, most: int = KEPT_WORDS):
        self.weights, self.most = weights, most
        held = np.flatnonzero(weights.any(axis=1))
        self.place = np.zeros(len(weights), np.int32)
        self.place[held] = np.arange(1, len(held) + 1)
        self.table = np.concatenate([np.zeros((1, weights.shape[1]), np.float32), weights[held].astype(np.float32)])
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.rows = np.zeros((0, self.table.shape[1]), np.float32)
        self.filled = 0

    def word_numbers(self) -> dict[bytes, int]:
        """Words to the rows of their kernels; new words get the next number, and their rows by :meth:`kernels`."""
        if self.filled > self.most:
            self._forget()
        return self.numbers

    def kernels(self) -> np.ndarray:
        if len(self.numbers) > len(self.rows):
            grown = np.zeros((max(len(self.numbers), 2 * len(self.rows)), self.rows.shape[1]), np.float32)
            grown[: self.filled] = self.rows[: self.filled]
            self.rows = grown
        # marks at the end add nothing to a word of one window
        cores = [w.rstrip(_MARKS) if len(w) < LONGEST else w for w in islice(self.numbers, self.filled, None)]
        distinct = {w: i for i, w in enumerate(dict.fromkeys(cores))}
        found = self.compute([w.decode() for w in distinct])
        self.rows[self.filled : len(self.numbers)] = found[np.array([distinct[w] for w in cores], np.intp)]
        self.filled = len(self.numbers)
        return self.rows

    def compute(self, words: list[str]) -> np.ndarray:
        """Kernel of each word with each landmark, 1 and more counting as 1; the best window of long words."""
        if not words:
            return np.zeros((0, self.table.shape[1]), np.float32)
        codes, lengths, owner = _windows(words)
        best = np.zeros((len(codes), self.table.shape[1]), np.float32)
        for size in range(3, LONGEST + 1):
            rows = np.flatnonzero(lengths == size)
            for start in range(0, len(rows), 1024):
                part = rows[start : start + 1024]
                own = np.ascontiguousarray(codes[part, :size].T)
                found = np.zeros((len(part), self.table.shape[1]), np.float32)
                more = np.empty_like(found)
                for i, j in combinations(range(size - 1), 2):
                    pair = (own[i] * _SIZE + own[j]) * _SIZE
                    for k in range(j + 1, size):
                        # "clip" takes into the given array without a copy; all places are in the table
                        self.table.take(self.place.take(pair + own[k]), axis=0, out=more, mode="clip")
                        more *= np.float32(DECAY ** (k - i + 1))
                        found += more
                best[part] = found
        # a word's windows stand side by side, and each word has one
        best = np.maximum.reduceat(best, np.searchsorted(owner, np.arange(len(words))), axis=0)
        return np.minimum(best, 1) ** POWER


def word_kernels(words: list[str], weights: np.ndarray) -> np.ndarray:
    """Kernel of each word with each landmark, 1 and more counting as 1; the best window of long words."""
    return WordKernels(weights).compute(words)


_KERNELS: list[WordKernels] = []


def _kernels_of(weights: np.ndarray) -> WordKernels:
    """The kernels of this table, kept between the batches of a Python worker."""
    if not (_KERNELS and _KERNELS[0].weights is weights):
        _KERNELS[:] = [WordKernels(weights)]
    return _KERNELS[0]


def words_and_ends(text: str) -> tuple[list[bytes], list[int]]:
    """Words in lower case, and where sentences begin: at lines, after ``.!?`` and at joined letters."""
    raw = text.lower().encode()
    words: list[bytes] = []
    starts = [0]
    for line in raw.split(b"\n"):
        for word in line.split():
            words.append(word)
            if word[-1] in _ENDS:
                starts.append(len(words))
        starts.append(len(words))
    for run in _SPELLED.findall(raw):
        words.append(re.sub(rb"[^a-z]+", b"", run))
        starts.append(len(words))
    starts = sorted(set(starts))
    return (words, starts[:-1]) if words else ([b""], [0])


def sentence_vectors(documents: list[str], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of all sentences, and where each document's sentences begin."""
    known = _kernels_of(weights)
    numbers = known.word_numbers()
    codes, starts, firsts, at, sentences = [], [], [], 0, 0
    for text in documents:
        words, begins = words_and_ends(text)
        for word in set(words).difference(numbers):
            numbers[word] = len(numbers)
        codes.extend(map(numbers.__getitem__, words))
        starts.extend([at + b for b in begins])
        firsts.append(sentences)
        at += len(words)
        sentences += len(begins)
    kernels, codes, starts = known.kernels(), np.array(codes), np.array(starts)
    found = np.empty((len(starts), kernels.shape[1]), np.float32)
    # so many words at a time, in whole sentences
    cuts = np.unique(np.append(np.searchsorted(starts, np.arange(0, at, _WORDS)), len(starts)))
    for a, b in pairwise(cuts.tolist()):
        first, end = starts[a], starts[b] if b < len(starts) else at
        found[a:b] = np.maximum.reduceat(kernels[codes[first:end]], starts[a:b] - first, axis=0)
    return found, np.array(firsts)


def stems(word: str) -> list[str]:
    """A word without marks, and its beginnings of 4 letters and more."""
    word = "".join(c for c in word if c.isalpha())[: LONGEST - 1]
    return [word[:n] for n in range(4, len(word))] + [word] if len(word) >= 3 else []


def choose_landmarks(labelled: DataFrame, landmarks: int = LANDMARKS) -> tuple[list[str], int]:
    """Landmarks over (toxic, text), the first ones bound to toxic texts, and how many those are."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        tally: dict[str, list[int]] = {}
        for toxic, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
            for word in {s for w in set(words_and_ends(text)[0]) for s in stems(w.decode())}:
                tally.setdefault(word, [0, 0])[toxic] += 1
        return pa.RecordBatch.from_arrays(
            [pa.array(tally, pa.string()), pa.array([x[1] for x in tally.values()], pa.int64()), pa.array([x[0] for x in tally.values()], pa.int64())],
            names=["word", "toxic", "clean"],
        )

    sizes = labelled.agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).first()
    t, c = sizes["t"], sizes["n"] - sizes["t"]
    counts = store(arrow_map(labelled.select("toxic", "text"), run, "word string, toxic long, clean long")
                   .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "toxicity-words")
    share = (F.col("toxic") + F.col("clean")) / (t + c)
    bound = (F.col("toxic") / t - F.col("clean") / c) / F.sqrt(share * (1 - share) * (1 / t + 1 / c) + 1e-12)
    most = 3 * landmarks // 4
    ranked = counts.where("toxic > 2").withColumn("z", bound).where("z > 4").orderBy(F.desc("z"), F.desc(F.length("word")), "word")
    insults: list[str] = []
    for row in ranked.limit(20 * most).collect():
        alike = word_kernels([row["word"]], feature_table(insults))[0] if insults else np.zeros(0)
        back = word_kernels(insults, feature_table([row["word"]]))[:, 0] if insults else alike
        if len(insults) < most and not (np.minimum(alike, back) > ALIKE).any():
            insults.append(row["word"])
    others = counts.where(~F.col("word").isin(insults) & (F.col("toxic") * c <= F.col("clean") * t)).orderBy(F.desc("clean"), "word").limit(landmarks - len(insults))
    return [*insults, *(r["word"] for r in others.collect())], len(insults)


def _instances(labelled: DataFrame, weights: np.ndarray, insults: int) -> DataFrame:
    """The sentences of each document that come closest to the toxic landmarks."""
    sent = labelled.sparkSession.sparkContext.broadcast(weights)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, toxic, ranks, vectors = [], [], [], []
        values = texts(batch.column(2))
        for start in range(0, len(values), _DOCS):
            found, firsts = sentence_vectors(values[start : start + _DOCS], sent.value)
            for i, own in enumerate(np.split(found, firsts[1:])):
                order = np.argsort(-own[:, :insults].max(axis=1), kind="stable")[:INSTANCES]
                for rank, row in enumerate(order):
                    ids.append(batch.column(0)[start + i].as_py()), toxic.append(batch.column(1)[start + i].as_py())
                    ranks.append(rank), vectors.append(own[row])
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(toxic, pa.int32()), pa.array(ranks, pa.int32()), pa.array(vectors, pa.list_(pa.float32()))],
            names=["id", "toxic", "rank", "vector"],
        )

    return arrow_map(labelled.select("id", F.col("toxic").cast("int"), "text"), run, "id long, toxic int, rank int, vector array<float>")


def fit_svm(x: np.ndarray, y: np.ndarray, penalty: float = 10.0) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss, classes weighted equally, by Newton steps."""
    sign = np.where(y > 0, 1.0, -1.0)
    cost = penalty * np.where(y > 0, 0.5 / max((y > 0).mean(), 1e-9), 0.5 / max((y <= 0).mean(), 1e-9))
    full = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.eye(full.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(full.shape[1])
    for _ in range(50):
        active = sign * (full @ w) < 1
        rows = full[active] * cost[active, None]
        new = np.linalg.solve(ridge + rows.T @ full[active], rows.T @ sign[active])
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w[:-1], float(w[-1])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights, the last one the intercept, that turn features into a probability (Platt's targets)."""
    positives, negatives = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (positives + 1) / (positives + 2), 1 / (negatives + 2))
    full = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(full.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -30, 30)))
        step = np.linalg.solve((full * (p * (1 - p))[:, None]).T @ full + ridge * np.eye(len(w)), full.T @ (p - target) + ridge * w)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def document_features(documents: list[str], model: dict) -> np.ndarray:
    """Largest margin, and logs of the sum and the mean of the sentences' toxic sides."""
    found, firsts = sentence_vectors(documents, model["weights"])
    margin = found @ model["linear"] + model["bias"]
    side = 1 / (1 + np.exp(-np.clip(4 * margin, -30, 30)))
    total = np.add.reduceat(side, firsts)
    n = np.diff(np.append(firsts, len(margin)))
    return np.column_stack([np.maximum.reduceat(margin, firsts), np.log(total + 1e-2), np.log(total / n + 1e-3)])


def _features(labelled: DataFrame, model: dict) -> DataFrame:
    """(toxic, features) of each labelled document."""
    sent = labelled.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = texts(batch.column(2))
        rows = [row for start in range(0, len(values), _DOCS) for row in document_features(values[start : start + _DOCS], sent.value)]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.float64()))], names=["id", "toxic", "features"])

    return arrow_map(labelled.select("id", F.col("toxic").cast("int"), "text"), run, "id long, toxic int, features array<double>")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, key: str = "doc_id", text: str = "text") -> dict:
    """A model from (key, text) and (key, toxic)."""
    marks = labels.where(F.col(key).isNotNull() & F.col("toxic").isNotNull()).groupBy(F.col(key).alias("id")).agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    if len(sizes) < 2:
        return {"weights": np.zeros((_CUBE, 0), np.float32), "share": sizes.get(1, 0) / total if total else 0.0}
    drawn = marks.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < min(1.0, sample / total) * (1 << 20))
    drawn = store(drawn, "toxicity-drawn")
    labelled = store(docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(drawn, "id"), "toxicity-sample")
    if labelled.select("toxic").distinct().count() < 2:
        return {"weights": np.zeros((_CUBE, 0), np.float32), "share": sizes.get(1, 0) / total}
    landmarks, insults = choose_landmarks(labelled)
    weights = feature_table(landmarks)
    rows = sorted(_instances(labelled, weights, max(insults, 1)).collect(), key=lambda r: (r["id"], r["rank"], list(r["vector"])))
    x = np.array([r["vector"] for r in rows], np.float64)
    y = np.array([r["toxic"] for r in rows])
    _, bag = np.unique([r["id"] for r in rows], return_inverse=True)
    own = word_kernels(landmarks, weights).astype(np.float64)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    keep = values > 1e-2 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    z = x @ root
    picked = (y <= 0) | (np.array([r["rank"] for r in rows]) == 0)
    for _ in range(4):
        w, b = fit_svm(z[picked], y[picked])
        margin = z @ w + b
        best = np.full(bag.max() + 1, -np.inf)
        np.maximum.at(best, bag, margin)
        again = (y <= 0) | (margin >= best[bag])
        if (again == picked).all():
            break
        picked = again
    model = {"landmarks": landmarks[:insults], "weights": weights, "linear": root @ w, "bias": b}
    rows = sorted(_features(labelled, model).collect(), key=lambda r: (r["id"], r["features"]))
    return model | {"logistic": fit_logistic(np.array([r["features"] for r in rows]), np.array([r["toxic"] for r in rows]))}


def score_texts(documents: list[str], model: dict) -> list[float]:
    if not model["weights"].shape[1]:
        return [model["share"]] * len(documents)
    x = document_features(documents, model)
    return (1 / (1 + np.exp(-np.clip(x @ model["logistic"][:-1] + model["logistic"][-1], -30, 30)))).tolist()


def score(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, predicted) per row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = texts(batch.column(1))
        found = [s for start in range(0, len(values), _DOCS) for s in score_texts(values[start : start + _DOCS], sent.value)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(found, pa.float64()), pa.array([int(s >= 0.5) for s in found], pa.int32())],
            names=[key, "score", "predicted"],
        )

    narrow = docs.select(F.col(key).cast("long").alias(key), F.col(text).alias(text))
    return arrow_map(narrow, run, f"`{key}` long, score double, predicted int")


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = train(docs, table(spark, folder, "labels").where(fold("doc_id", 5) != 0))
    found = score(docs, model)
    return found.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")
