"""Cross-tokenizer alignment against a plain version from the libraries' own tokens."""

import hashlib
import json
import os
import random
import re
from collections import Counter, defaultdict
from itertools import accumulate

import numpy as np
import pandas as pd
import pytest

from llm import alignment
from llm.queries import all_queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
FIELDS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    from tokenizers import Tokenizer

    a_path, b_path = alignment.default_paths()
    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=b_path)


def plain(library, texts):
    """Rows of (FIELDS), by set intersection of the offsets."""
    a_tok, b_tok = library
    letters = alignment.byte_of_letter()
    docs = []
    for text in texts:
        groups = []
        if text:
            one = a_tok.encode(" " + text, add_special_tokens=False)
            b = b_tok.encode(text)
            a_bytes = [bytes(letters[c] for c in t) for t in one.tokens]
            b_bytes = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in map(b_tok.id_to_piece, b)]
            if b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                a_ends, b_ends = list(accumulate(map(len, a_bytes))), list(accumulate(map(len, b_bytes)))
                common = sorted(set(a_ends) & set(b_ends))
                at = [0, 0]
                for end in common:
                    to = [a_ends.index(end, at[0]) + 1, b_ends.index(end, at[1]) + 1]
                    groups.append((one.ids[at[0] : to[0]], b[at[1] : to[1]]))
                    at = to
        docs.append(groups)
    held = Counter()
    for groups in docs:
        held.update({(x, y) for a, b in groups for x in a for y in b})
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for groups in docs:
        links = [(x, y) for a, b in groups for x in a for y in b]
        told = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((
            sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links), sum(held[p] == best[p[0]] for p in links),
            sum(held[p] for p in links), hashlib.sha256(told.encode()).hexdigest() if groups else "",
        ))
    return out


def found(df):
    return sorted(((r["doc_id"], *[r[c] for c in FIELDS]) for r in df.collect()), key=str)


def test_query_equals_plain_version(spark, library):
    docs = pd.read_parquet(f"{FOLDER}/documents.parquet")
    want = sorted(((i, *row) for i, row in zip(docs.doc_id, plain(library, docs.text), strict=True)), key=str)
    assert found(all_queries()["op13_alignment"](spark, FOLDER)) == want


ODD = [
    None, "", " ", "\n\t x  y", "<|endoftext|> a<|endoftext|>", "▁a ▁", "<0x41> </s><s><unk>", "日本語のテキスト🎉é́", "a\x00b", "same text", "same text",
    "word " * 3000 + "x" * 3000, "¿Qué? İ ﬁ ² ½", "aaaa bbbb    cccc",
]


def test_odd_rows_and_small_blocks(spark, library):
    ids = [*range(len(ODD) - 1), None]
    rows = [(i, t, 1, "x", "x", 1) for i, t in zip(ids, ODD, strict=True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a int, data string, block string, pair int")
    want = sorted(((i, *row) for i, row in zip(ids, plain(library, ODD), strict=True)), key=str)
    assert found(alignment.align(docs)) == want
    assert found(alignment.align(docs, block_chars=10)) == want
    assert found(alignment.align(docs.limit(0))) == []


def test_segments_by_brute_force():
    draw = random.Random(3)
    for _ in range(500):
        total = draw.randint(1, 200)
        share = draw.choice([0.1, 0.5, 0.95])
        a = sorted({e for e in range(1, total) if draw.random() < 0.6} | {total})
        b = sorted({e for e in a if draw.random() < share} | {e for e in range(1, total) if draw.random() > share} | {total})
        at, cuts = [0, 0], []
        steps = [np.diff([0, *x]) for x in (a, b)]
        found = alignment.segments(*[x.astype("u1").tobytes() for x in steps])
        assert found == alignment.segments(*[x.astype("<u4").tobytes() for x in steps], "<u4")
        for i, j, p, q in zip(*[iter(found)] * 4, strict=True):
            assert [i, j] == at
            for x, y in [(p, q)] if q else [(1, 1)] * p:
                at = [at[0] + x, at[1] + y]
                assert a[at[0] - 1] == b[at[1] - 1]
                cuts.append(a[at[0] - 1])
        assert cuts == sorted(set(a) & set(b))


def test_long_groups_are_counted_by_ids(monkeypatch):
    draw = np.random.default_rng(1)
    a, b = draw.integers(0, 9, 60), draw.integers(0, 7, 50)
    found = np.array([(0, 0, 10, 0), (10, 10, 30, 20), (40, 30, 20, 20)])
    row = np.array([0, 0, 1])
    usual = alignment.links(a, b, found, row, 7)
    monkeypatch.setattr(alignment, "PLAIN_LINKS", 1)
    for x, y in zip(usual, alignment.links(a, b, found, row, 7), strict=True):
        assert x.tolist() == y.tolist()


def test_both_encoders_of_a_give_the_same_ids(library):
    a_path, _ = alignment.default_paths()
    text = open(a_path).read()
    told = json.loads(text)
    told["pre_tokenizer"]["add_prefix_space"] = False
    fast, lossless = alignment.byte_level_encoder(text)
    assert lossless
    strings = [f" ab{chr(c)}{chr(c)}1 {chr(c)}x  {chr(c)}'s{chr(c)}" for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(strings), 20000):
        part = strings[start : start + 20000]
        assert [x.tolist() for x in fast(part)] == [x.ids for x in library[0].encode_batch_fast(part, add_special_tokens=False)]
    told["model"]["merges"] = told["model"]["merges"][::-1]  # ids do not ascend: left to the library
    slow, lossless = alignment.byte_level_encoder(json.dumps(told))
    assert len(slow(["a b"])[0]) and not lossless
