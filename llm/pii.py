"""Personal data: patterns, and terms that reveal them by co-occurrence.

Base spans are e-mail addresses, IP addresses, card numbers that pass Luhn, and phone numbers. Each of their
values is a protected *entity*. Words near an entity (``WINDOW`` on either side) are its context. Over the whole
corpus, with N documents, n_e that hold the entity, n_t that hold the word and c that hold the word in the
entity's context, the word discloses

    PMI(t; e) / IC(e) = log(c N / (n_e n_t)) / log(N / n_e)

of the entity's information. In context, words from ``GENERALISE`` on are generalised, those from ``REMOVE`` on are
removed, provided that at least ``SUPPORT`` different texts show the pair: one text alone says nothing about what
usually goes together.

Patterns are read in each task; words are counted per batch before they are shuffled; entities, contexts and
decisions are joined on (entity, word) with one decision per pair, so a very common entity spreads over tasks.

Defined cases: a null text counts as empty; rows equal in key and text share their spans; null keys are kept;
an entity in all documents discloses nothing; other columns are not read by :func:`find` and kept by
:func:`sanitise`.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import arrow_map, store, table, texts
from llm.registry import query

WINDOW, REACH, SUPPORT, GENERALISE, REMOVE = 8, 240, 2, 0.8, 0.95
KINDS = ("email", "ip", "card", "phone", "general", "removed")

# The optional tail lets a run of local characters or digits be read once when no match follows.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+(@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)?")
_IP = re.compile(r"[0-9]+((?:\.[0-9]+){3})?")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W\d_]{3,}")
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind and start; matches that fail their check are dropped, without a retry."""
    out = []
    if "@" in text:
        out += [("email", *m.span()) for m in _EMAIL.finditer(text) if m[1]]
    if _DIGITS.search(text):
        if "." in text:
            out += [("ip", *m.span()) for m in _IP.finditer(text) if m[1] and all(map(_small, m[0].split(".")))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_DIGITS.findall(m[0])) <= 15]
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def entity_of(kind: str, value: str) -> str:
    """One spelling per entity."""
    return f"{kind}:{value.lower() if kind == 'email' else value if kind == 'ip' else ''.join(_DIGITS.findall(value))}"


def contexts(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, str, int, int]]:
    """(entity, word, start, end) of the words around each span that lie in no span."""
    taken = [(a, b) for _, a, b in spans]
    out = []
    for kind, a, b in spans:
        entity = entity_of(kind, text[a:b])
        left, right = max(a - REACH, 0), min(b + REACH, len(text))
        before = [m for m in _TERM.finditer(text, left, a) if m.start() > left or left == 0]
        after = [m for m in _TERM.finditer(text, b, right) if m.end() < right or right == len(text)]
        for m in before[-WINDOW:] + after[:WINDOW]:
            if not any(m.start() < y and x < m.end() for x, y in taken):
                out.append((entity, m[0].lower(), *m.span()))
    return out


_SPAN = "array<struct<kind:string,begin:int,end:int>>"
_CONTEXT = "array<struct<entity:string,term:string,begin:int,end:int>>"
_ARROW_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32())]))
_ARROW_CONTEXT = pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string()), ("begin", pa.int32()), ("end", pa.int32())]))


def scan(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(k, h, base, context) per row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = texts(batch.column(2))
        found = [base_spans(x) for x in values]
        around = [contexts(x, s) if s else [] for x, s in zip(values, found, strict=True)]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1),
                pa.array([[{"kind": k, "begin": a, "end": b} for k, a, b in s] for s in found], _ARROW_SPAN),
                pa.array([[{"entity": e, "term": t, "begin": a, "end": b} for e, t, a, b in c] for c in around], _ARROW_CONTEXT),
            ],
            names=["k", "h", "base", "context"],
        )

    narrow = docs.select(F.col(key).cast("long").alias("k"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    return arrow_map(narrow, run, f"k long, h long, base {_SPAN}, context {_CONTEXT}")


def term_documents(docs: DataFrame, text: str) -> DataFrame:
    """(term, df): in how many documents each word is, over the whole corpus."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: Counter = Counter()
        for value in texts(batch.column(0)):
            counts.update(set(_TERM.findall(value.lower())))
        return pa.RecordBatch.from_arrays([pa.array(counts, pa.string()), pa.array(counts.values(), pa.int64())], names=["term", "df"])

    narrow = docs.select(F.col(text).alias("text"))
    return arrow_map(narrow, run, "term string, df long").groupBy("term").agg(F.sum("df").alias("df"))


def disclosures(around: DataFrame, docs: DataFrame, text: str, generalise: float = GENERALISE, support: int = SUPPORT) -> DataFrame:
    """(entity, term, share): how much of the entity the word gives away, from ``generalise`` on."""
    total = docs.count()
    each = around.select("entity", "term", "k", "h").distinct()
    pairs = (
        each.groupBy("entity", "term", "h").agg(F.count("*").alias("c"))
        .groupBy("entity", "term").agg(F.sum("c").alias("c"), F.count("*").alias("texts")).where(F.col("texts") >= support)
    )
    entities = around.select("entity", "k", "h").distinct().groupBy("entity").agg(F.count("*").alias("n_e")).where(F.col("n_e") < total)
    known = store(pairs.join(entities, "entity"), "pii-pairs")
    wanted = term_documents(docs, text).join(known.select("term").distinct(), "term", "left_semi")
    share = F.log(F.col("c") * total / (F.col("n_e") * F.col("df"))) / F.log(F.lit(float(total)) / F.col("n_e"))
    return known.join(wanted, "term").withColumn("share", share).where(F.col("share") >= generalise).select("entity", "term", "share")


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", generalise: float = GENERALISE, remove: float = REMOVE, support: int = SUPPORT) -> DataFrame:
    """(k, h, base, terms): base spans, and spans of disclosing words as ``general`` or ``removed``, per row."""
    rows = store(scan(docs, key, text), "pii-base")
    around = rows.select("k", "h", F.explode("context").alias("x")).select("k", "h", "x.*")
    told = disclosures(around, docs, text, generalise, support)
    marked = (
        around.join(told, ["entity", "term"]).groupBy("k", "h", "begin", "end").agg(F.max("share").alias("share"))
        .withColumn("kind", F.when(F.col("share") >= remove, "removed").otherwise("general"))
        .groupBy("k", "h").agg(F.array_sort(F.collect_list(F.struct("kind", "begin", "end"))).alias("terms"))
    )
    same = F.col("a.h").eqNullSafe(F.col("b.h")) & F.col("a.k").eqNullSafe(F.col("b.k"))
    return rows.drop("context").alias("a").join(store(marked, "pii-terms").alias("b"), same, "left").select(
        "a.k", "a.h", "a.base", F.coalesce("b.terms", F.array().cast(_SPAN)).alias("terms")
    )


def sanitise(docs: DataFrame, key: str = "doc_id", text: str = "text", **thresholds: float) -> DataFrame:
    """The documents with base spans and generalised words replaced by ``[kind]`` and removed words taken out."""
    found = find(docs, key, text, **thresholds).dropDuplicates(["k", "h"]).alias("f")

    @F.pandas_udf("string")
    def rewrite(values, base, terms):
        import pandas as pd

        out = []
        for value, spans, extra in zip(values, base, terms, strict=True):
            if value is None:
                out.append(None)
                continue
            at, parts = 0, []
            for s in sorted([*spans, *extra], key=lambda s: (s["begin"], -s["end"])):
                if s["begin"] >= at:
                    parts += [value[at : s["begin"]], "" if s["kind"] == "removed" else f"[{s['kind']}]"]
                    at = s["end"]
            out.append("".join([*parts, value[at:]]))
        return pd.Series(out, dtype=object)

    same = F.xxhash64(F.col(f"d.`{text}`")).eqNullSafe(F.col("f.h")) & F.col(f"d.`{key}`").cast("long").eqNullSafe(F.col("f.k"))
    joined_rows = docs.alias("d").join(found, same)
    return joined_rows.select(*[
        rewrite(F.col(f"d.`{c}`"), F.col("f.base"), F.col("f.terms")).alias(c) if c == text else F.col(f"d.`{c}`") for c in docs.columns
    ])


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of base spans, their hash, and all spans as text."""

    def of(column, kind):
        return F.array_sort(F.filter(column, lambda x: x["kind"] == kind))

    def spelled(column, kinds):
        every = F.concat(*[of(column, kind) for kind in kinds])
        return F.array_join(F.transform(every, lambda x: F.concat_ws(":", x["kind"], x["begin"].cast("string"), x["end"].cast("string"))), ",")

    def count(kind):
        return F.size(of(F.col("base"), kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("k").alias(key), *[count(k) for k in KINDS[:4]], F.sha2(spelled(F.col("base"), KINDS[:4]), 256).alias("base_sha256"),
        spelled(F.concat("base", "terms"), KINDS).alias("spans"),
    )


@query("op5_pii")
def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    return digest(find(table(spark, folder, "documents")))
