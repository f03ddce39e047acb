"""Importance resampling against a plain version that joins strings."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter

import pandas as pd
import pytest

from llm import resampling
from llm.queries import all_queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id long, text string, score string, rank string, place string, n string"


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def features_of(text):
    words = words_of(text)
    return words + [" ".join(p) for p in zip(words, words[1:])]


def plain(docs, bench, percent=25):
    buckets = [[zlib.crc32(f.encode()) % 10000 for f in features_of(t)] for _, t in docs]
    s, t = Counter(b for own in buckets for b in own), Counter(zlib.crc32(f.encode()) % 10000 for x in bench for f in features_of(x))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total_s + 10000) / ((s[b] + 1) * (total_t + 10000)))) for b in range(10000)]
    rows = []
    for (i, text), own in zip(docs, buckets, strict=True):
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words_of(text))])
    able = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = place
    return sorted((tuple(r[:5]) for r in rows), key=str)


def found(df):
    return sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in df.collect()), key=str)


def test_query_equals_plain_version(spark):
    docs = pd.read_parquet(f"{FOLDER}/documents.parquet")
    bench = pd.read_parquet(f"{FOLDER}/benchmark.parquet")
    df = all_queries()["op12_resampling"](spark, FOLDER)
    assert df.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert found(df) == plain(list(zip(docs.doc_id, docs.text, strict=True)), bench.text)


LONG = "Ab9 çé " * 50_000 + "x" * 100_000
ODD = [None, "", " \n-!", "one", "Été,ÉTÉ x\x00y_z 日本 ok", LONG, *["Same words again " * 10] * 3, "a b " * 30]


def test_odd_rows(spark):
    ids = [5, 4, 3, 2, 1, 0, 9, 9, None, 8]
    docs = spark.createDataFrame([(i, t, "own", "own", "own", "own") for i, t in zip(ids, ODD, strict=True)], DOCS)
    bench = spark.createDataFrame([("a", None), ("b", ""), ("c", "same words x y"), ("c", "same words x y")], "item_id string, text string")
    want = plain(list(zip(ids, ODD, strict=True)), [None, "", "same words x y", "same words x y"], percent=60)
    assert found(resampling.resample(docs, bench, percent=60)) == want


def test_empty_tables(spark):
    docs = spark.createDataFrame([(i, t, "", "", "", "") for i, t in enumerate(ODD)], DOCS)
    bench = spark.createDataFrame([], "item_id string, text string")
    assert found(resampling.resample(docs, bench)) == plain(list(enumerate(ODD)), [])
    assert found(resampling.resample(docs.limit(0), bench)) == []


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("size", [1, 7, 1000])
def test_slices_give_the_runs_of_the_whole(order, size):
    text = "The quick  brown-fox ÉT 99 x " * 9
    words = [w.encode() for w in words_of(text)]
    want = Counter(zlib.crc32(b" ".join(words[i : i + n])) for n in range(1, order + 1) for i in range(len(words) - n + 1))
    slices = list(resampling.feature_slices(text, order, size))
    assert sum(n for n, _ in slices) == len(words)
    assert Counter(x for _, own in slices for x in own) == want
