"""Quality rules, lines first: failing lines go, then documents that lost too much go.

Lines are judged one by one, words being runs between ASCII white space:

* ``symbols``: more than a tenth of the line's word characters are of ``#*$%&|<>``;
* ``navigation``: at least 2 separator words (``| » › • ·``), at least one to four words;
* ``punctuation``: at least 4 marks of ``!?`` and more than one to three words, or 100 words and more without
  any of ``.!?``;
* ``capitals``: at least 10 of A-Z and more than five times as many as a-z;
* ``boilerplate``: at least one of ``PHRASES``, case ignored for A-Z;
* ``repeated``: equal to an earlier line of the document.

A line without a word cannot fail. A document is rejected when its failing lines hold more than
``MAX_LOST`` per cent of its word characters, or on the whole-document rules (``base_failed``): fewer than
``MIN_WORDS`` words, or more than ``MAX_REPEAT`` per cent of them in 3-word windows found twice or more.

Every row is judged on its own in its task: no shuffle, and memory for one batch of texts. Defined cases:
null text counts as empty, so it fails for lack of words; repeated rows are judged alike; other columns are
kept by :func:`clean_documents`.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import arrow_map, table, texts
from llm.registry import query

MIN_WORDS, MAX_REPEAT, MAX_LOST = 50, 50, 30
SLICE = 256  # texts judged at a time

# Phrases of licence, consent and navigation lines, in lower case.
PHRASES = (
    "all rights reserved", "licensed under", "this work is licensed", "released under the", "terms of use",
    "terms of service", "privacy policy", "cookie policy", "uses cookies", "accept all cookies", "enable javascript",
    "subscribe to our newsletter", "sign up for our", "click here", "read more", "share this", "follow us on",
    "skip to content", "lorem ipsum",
)

_SYMBOLS = "#*$%&|<>"
_SEPARATORS = ("|", "»", "›", "•", "·")
_SPACES = " \t\n\v\f\r"
_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_NOT_UPPER = bytes(b for b in range(256) if b not in _UPPER)
_NOT_LOWER = bytes(b for b in range(256) if b not in _LOWER)
_PHRASE = re.compile("|".join(map(re.escape, PHRASES)), re.ASCII | re.IGNORECASE)


def words_of(text: str) -> list[str]:
    return [w for w in _SPACE.split(text) if w]


def count_of(text: str, marks: str) -> int:
    return sum(text.count(m) for m in marks)


def line_fault(line: str) -> str | None:
    """The first rule that a line fails, repeats aside."""
    words = words_of(line)
    n = len(words)
    if not n:
        return None
    if 10 * count_of(line, _SYMBOLS) > sum(map(len, words)):
        return "symbols"
    separators = sum(words.count(s) for s in _SEPARATORS)
    if separators >= 2 and 4 * separators >= n:
        return "navigation"
    marks = count_of(line, "!?")
    if (marks >= 4 and 3 * marks > n) or (n >= 100 and not marks and "." not in line):
        return "punctuation"
    raw = line.encode()
    upper = len(raw.translate(None, _NOT_UPPER))
    if upper >= 10 and upper > 5 * len(raw.translate(None, _NOT_LOWER)):
        return "capitals"
    if _PHRASE.search(line):
        return "boilerplate"
    return None


def judge_lines(text: str) -> tuple[list[str], int, int]:
    """Lines that stay, word characters lost, and the number of repeated lines."""
    seen, stay, lost, repeated = set(), [], 0, 0
    for line in text.split("\n"):
        size = len(line) - count_of(line, _SPACES)
        again = bool(size) and line in seen
        repeated += again
        seen.add(line)
        if again or line_fault(line):
            lost += size
        else:
            stay.append(line)
    return stay, lost, repeated


def repeat_words(words: list) -> int:
    """Words in 3-word windows that are found twice or more."""
    if len(words) < 4:
        return 0
    numbers: dict = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    if len(numbers) == len(words):
        return 0
    _, pair = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)
    _, which, uses = np.unique(pair[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
    twice = uses[which] > 1
    marked = np.zeros(len(words), bool)
    for shift in range(3):
        marked[shift : shift + len(twice)] |= twice
    return int(marked.sum())


def judge(text: str) -> dict:
    """All figures of a document, the verdict, and the text without failing lines."""
    words = text.encode().split()
    chars = len(text) - count_of(text, _SPACES)
    stay, lost, repeated = judge_lines(text)
    repeats = repeat_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeats > MAX_REPEAT * len(words)
    return {
        "n_words": len(words), "word_chars": chars, "n_symbols": count_of(text, _SYMBOLS), "n_dup_lines": repeated,
        "n_repeat_words": repeats, "base_failed": failed, "lost_chars": lost,
        "kept": not failed and 100 * lost <= MAX_LOST * chars, "clean_text": "\n".join(stay),
    }


_FIELDS = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
    "base_failed": "boolean", "lost_chars": "long", "kept": "boolean",
}
_ARROW = {"long": pa.int64(), "boolean": pa.bool_()}


def score(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Figures and verdict per document."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [judge(x) for x in texts(batch.column(1))]
        columns = [pa.array([r[name] for r in rows], _ARROW[kind]) for name, kind in _FIELDS.items()]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[key, *_FIELDS])

    schema = f"`{key}` long, " + ", ".join(f"{n} {k}" for n, k in _FIELDS.items())
    return arrow_map(docs.select(F.col(key).cast("long").alias(key), F.col(text).alias(text)), run, schema, SLICE)


def clean_documents(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The documents that pass, without their failing lines; ``n_chars`` follows the text."""

    at = docs.columns.index(text)
    schema = docs.schema

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [judge(x) for x in texts(batch.column(at))]
        clean = pa.array([r["clean_text"] if r["kept"] else "" for r in rows], batch.schema.field(at).type)
        return batch.set_column(at, batch.schema.field(at), clean).filter(pa.array([r["kept"] for r in rows], pa.bool_()))

    kept = arrow_map(docs, run, schema, SLICE)
    return kept.withColumn(n_chars, F.length(text).cast("long")).select(*docs.columns)


_SQL = r"""
with doc as (
  select row_number() over () as r, doc_id, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
line as (
  select r, i, lines[i] as l, regexp_extract_all(lines[i], '[^\x20\x09-\x0D]+') as w
  from (select r, lines, unnest(range(1, len(lines) + 1)) as i from (select r, string_split(t, chr(10)) as lines from doc))),
counted as (
  select r, i, l, len(w) as n, length(array_to_string(w, '')) as chars,
         len(regexp_extract_all(l, '[#*$%&|<>]')) as symbols,
         len(list_filter(w, lambda x: x in ('|', '»', '›', '•', '·'))) as separators,
         len(regexp_extract_all(l, '[!?]')) as marks, contains(l, '.') as stops,
         len(regexp_extract_all(l, '[A-Z]')) as upper, len(regexp_extract_all(l, '[a-z]')) as lower,
         translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as small,
         row_number() over (partition by r, l order by i) > 1 and len(w) > 0 as again
  from line),
judged as (
  select r, chars, again, n > 0 and (
      again or 10 * symbols > chars or (separators >= 2 and 4 * separators >= n)
      or (marks >= 4 and 3 * marks > n) or (n >= 100 and marks = 0 and not stops)
      or (upper >= 10 and upper > 5 * lower) or regexp_matches(small, 'PHRASES')) as fails
  from counted),
lines as (select r, sum(case when fails then chars else 0 end) as lost, count(*) filter (again) as dup from judged group by r),
tri as (select r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g from (select r, w, unnest(range(1, len(w) - 1)) as i from doc where len(w) > 2)),
twice as (select r, i from (select r, i, count(*) over (partition by r, g) as n from tri) where n > 1),
rep as (select r, count(distinct p) as n from (select r, unnest(range(i, i + 3)) as p from twice) group by r),
base as (
  select doc_id, r, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols, dup::bigint as n_dup_lines,
         coalesce(rep.n, 0)::bigint as n_repeat_words, lost::bigint as lost_chars
  from doc join lines using (r) left join rep using (r))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lost_chars,
       n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and 100 * lost_chars <= 30 * word_chars as kept
from base
""".replace("PHRASES", "|".join(PHRASES))


@query("op8_quality", _SQL)
def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return score(table(spark, folder, "documents"))
