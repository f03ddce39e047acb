"""The pipeline against a plain version of its stages."""

import hashlib
import itertools
import os
import re

import duckdb
import numpy as np
import pandas as pd
from tokenizers import Tokenizer

import corpus_pipeline
from llm import bpe, line_dedup, quality

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain_quality(docs):
    judged = [quality.judge(t or "") for t in docs.text]
    kept = docs[[r["kept"] for r in judged]].copy()
    kept["text"] = [r["clean_text"] for r in judged if r["kept"]]
    return kept


def plain_lines(docs):
    con = duckdb.connect()
    con.register("documents", docs)
    found = con.execute(line_dedup._SQL).fetchdf().set_index("doc_id").text
    return docs.assign(text=[found[i] for i in docs.doc_id])


def plain_near(docs):
    def shingles(text):
        words = text.encode().lower().split()
        span = min(5, len(words))
        return {tuple(words[i : i + span]) for i in range(len(words) - span + 1)} if words else set()

    sets = dict(zip(docs.doc_id, map(shingles, docs.text), strict=True))
    root = {i: i for i in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 80 * len(x | y):
            low, high = sorted((root[a], root[b]))
            root = {i: low if r == high else r for i, r in root.items()}
    return docs[[root[i] == i for i in docs.doc_id]]


def plain_benchmark(docs):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    windows = set()
    for item in pd.read_parquet(f"{FOLDER}/benchmark.parquet").text:
        own = words(item)
        windows |= {tuple(own[i : i + 10]) for i in range(max(len(own) - 10, 0) + 1)} if own else set()
    sizes = {len(w) for w in windows}

    def clean(text):
        own = words(text)
        return not any(tuple(own[i : i + n]) in windows for n in sizes for i in range(len(own) - n + 1))

    return docs[[clean(t) for t in docs.text]]


def test_pipeline_equals_plain_stages(spark):
    docs = pd.read_parquet(f"{FOLDER}/documents.parquet")
    for stage in (plain_quality, plain_lines, plain_near, plain_benchmark):
        docs = stage(docs)
    tokenizer = Tokenizer.from_file(bpe.default_tokenizer())
    want = set()
    for i, text in zip(docs.doc_id, docs.text, strict=True):
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        want.add((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    got = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert got == want


def test_stages_keep_the_columns_and_take_odd_rows(spark):
    docs = spark.createDataFrame(
        [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "word " * 200, None, "s", 1000)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for table in (docs, docs.limit(0)):
            out = stage(spark, table, FOLDER)
            assert out.columns == docs.columns and out.count() <= 4
