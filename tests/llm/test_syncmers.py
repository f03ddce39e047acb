"""Closed syncmers against a plain version, byte by byte."""

import hashlib
import os
import random

import pandas as pd
import pytest
import xxhash

from llm import syncmers
from llm.queries import all_queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
FIELDS = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def h64(data):
    value = xxhash.xxh64_intdigest(data, seed=42)
    return value - (1 << 64) if value >> 63 else value


def plain_anchors(data):
    """(position, hash) of each closed syncmer."""
    k, s = syncmers.K, syncmers.S
    inner = [h64(data[i : i + s]) for i in range(len(data) - s + 1)]
    out = []
    for i in range(len(data) - k + 1):
        window = inner[i : i + k - s + 1]
        if min(window[0], window[-1]) <= min(window[1:-1]):
            out.append((i, h64(data[i : i + k]) & 0xFFFFFF))
    return out


def plain_print(text):
    data = text.encode()
    if 0 < len(data) < syncmers.K:
        return f"{h64(data) & 0xFFFFFF:06x}0"
    found = plain_anchors(data)
    return "".join(f"{h:06x}{i - found[n - 1][0] if n else 0:x}" for n, (i, h) in enumerate(found))


def plain_likeness(a, b):
    x, y = ({f[i : i + 7] for i in range(0, len(f), 7)} for f in (a, b))
    return 2 * len(x & y) / (len(x) + len(y)) if x or y else 1.0


def plain(docs):
    """docs in the order of the operator."""
    rows = []
    for n, (i, text) in enumerate(docs):
        text, following = text or "", docs[(n + 1) % len(docs)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b, c = map(plain_print, (text, edited, following))
        rows.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, round(plain_likeness(a, b), 9), round(plain_likeness(a, c), 9)))
    return sorted(rows, key=str)


def ordered(docs):
    return sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0), -h64((d[1] or "").encode())))


def found(df):
    assert df.columns == ["doc_id", *FIELDS]
    return sorted(((r["doc_id"], *[round(r[c], 9) if c.startswith("near") else r[c] for c in FIELDS]) for r in df.collect()), key=str)


def test_query_equals_plain_version(spark):
    docs = pd.read_parquet(f"{FOLDER}/documents.parquet")
    assert found(all_queries()["op11_syncmers"](spark, FOLDER)) == plain(ordered(list(zip(docs.doc_id, docs.text, strict=True))))


ODD = [
    None, "", "a", "x" * 23, "y" * 24, "é" * 300, "same text " * 20, "same text " * 20, " \n\t" * 30, "日本語🎉" * 40, "a\x00b" * 30,
    "word " * 500 + "z" * 3000, "The quick brown fox jumps over the lazy dog", "b" * 55, "c" * 56,
]


@pytest.mark.parametrize("ids", [range(15), [5000 * i for i in range(15)], [-3, *range(1020, 1030), 2**62, None, 7, None], [1] * 15, [None] * 15])
def test_odd_rows(spark, ids):
    rows = list(zip(ids, ODD, strict=True))
    docs = spark.createDataFrame([(i, t, "own", "own", 1, 1, 1) for i, t in rows], "doc_id long, text string, head string, next string, rn int, h int, cell int")
    assert found(syncmers.fingerprints(docs)) == plain(ordered(rows))


def test_one_and_no_document(spark):
    docs = spark.createDataFrame([(3, "alone in the world, with no one to follow")], "doc_id long, text string")
    assert found(syncmers.fingerprints(docs)) == plain([(3, "alone in the world, with no one to follow")])
    assert found(syncmers.fingerprints(docs.limit(0))) == []


def test_anchors_are_close_and_context_free():
    draw = random.Random(5)
    for _ in range(20):
        data = bytes(draw.choice(b"abcdefgh ") for _ in range(400))
        places = [i for i, _ in plain_anchors(data)]
        assert all(b - a <= syncmers.K - syncmers.S for a, b in zip(places, places[1:]))
        inside = plain_anchors(data[100:300])
        assert [(i + 100, h) for i, h in inside] == [(i, h) for i, h in plain_anchors(data) if 100 <= i <= 300 - syncmers.K]


def test_an_insertion_keeps_the_rest(spark):
    draw = random.Random(7)
    text = " ".join("".join(draw.choice("abcdefghij") for _ in range(6)) for _ in range(300))
    changed = text[:900] + "INSERTED WORDS " + text[900:]
    docs = spark.createDataFrame([(2, text), (1, changed)], "doc_id long, text string")
    near = {r["doc_id"]: r["near_next"] for r in syncmers.fingerprints(docs).collect()}
    assert near[2] > 0.95


def test_long_text(spark):
    text = "".join(f"{i * 7919 % 10007} lorem {i} " for i in range(60_000))
    docs = spark.createDataFrame([(1, text), (2, text[:500_000]), (3, "short")], "doc_id long, text string")
    assert found(syncmers.fingerprints(docs)) == plain([(3, "short"), (2, text[:500_000]), (1, text)])
