"""Line dedup with a log-template tree.

The tree has a fixed depth: a line's number of tokens, then its first ``DEPTH`` tokens, where a token with
a digit counts as the variable ``<*>``. A path is a *leaf*. Inside a leaf, a token is constant at its
position if lines of at least ``min_texts`` different texts have it there; all others are variable. A line
is an instance of a recurring template

* if its own form (digit tokens masked) is in at least ``min_texts`` different texts, or
* if it has at least ``LEAST_GENERAL`` tokens and constants make up ``SIMILARITY`` of them.

All instances are dropped but the first by (key, text hash, position): the first of a form, or, where a form
is in one text only, the first of its leaf. So exact copies of a document count as one text and do not make
their lines recurring. Lines of fewer than ``LEAST_TOKENS`` tokens are left alone.

Everything is grouping and joining by hashes of leaf and form: what repeats is aggregated before it is
shuffled, joins with hot forms have one row per form on the other side so adaptive execution can split them,
and nothing is broadcast but tables whose stored size Spark finds small.

Defined cases: a null text stays null and has no lines; an empty text has one empty line and keeps it; rows
equal in key and text count as one place and share their verdict; other columns are kept as they are, but columns
named ``n_lines`` or ``n_dropped`` give way to the operator's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import store, table
from llm.registry import query

DEPTH, LEAST_TOKENS, LEAST_GENERAL, SIMILARITY = 3, 3, 8, 0.8
VARIABLE = "<*>"

# A whole token with a digit; begins at a token's start only, so long tokens are read once.
_DIGITS = r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+"


def tokens_of(line: Column) -> Column:
    """Runs between ASCII white space."""
    return F.array_remove(F.split(line, r"[\x20\x09-\x0D]+"), "")


def masked_form(tokens: Column) -> Column:
    """Tokens joined by a blank, those with a digit as the variable."""
    return F.regexp_replace(F.array_join(tokens, " "), _DIGITS, VARIABLE)


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, hash, pos, n, leaf, form): a row per line of LEAST_TOKENS tokens and more."""
    raw = docs.select(F.col(key).alias("k"), F.xxhash64(text).alias("h"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    # one-row explode keeps the tokens from being computed once per use
    cut = raw.select("k", "h", "pos", F.explode(F.array(tokens_of(F.col("line")))).alias("tokens")).where(F.size("tokens") >= LEAST_TOKENS)
    masked = cut.select("k", "h", "pos", F.size("tokens").alias("n"), F.explode(F.array(masked_form(F.col("tokens")))).alias("masked"))
    head = F.substring_index("masked", " ", DEPTH)
    return masked.select("k", "h", "pos", "n", F.xxhash64("n", head).alias("leaf"), F.xxhash64("masked").alias("form"))


def _shown(docs: DataFrame, key: str, text: str, sought: DataFrame) -> DataFrame:
    """(leaf, form, texts, masked) of the forms in ``sought``, read from the lines it names: a text is split once,
    and of its lines only the named ones are taken apart."""
    wanted = sought.groupBy("k", "h").agg(F.collect_list(F.struct("pos", "leaf", "form", "texts")).alias("wanted"))
    own = docs.select(F.col(key).alias("k"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    met = own.alias("a").join(wanted.alias("b"), (F.col("a.h") == F.col("b.h")) & F.col("a.k").eqNullSafe(F.col("b.k")))
    split = met.select("b.wanted", F.explode(F.array(F.split("a.text", "\n", -1))).alias("lines"))
    named = split.select(F.explode(F.transform("wanted", lambda w: F.struct(
        w["leaf"].alias("leaf"), w["form"].alias("form"), w["texts"].alias("texts"), F.get("lines", w["pos"]).alias("line")))).alias("x"))
    return named.select("x.leaf", "x.form", "x.texts", masked_form(tokens_of(F.col("x.line"))).alias("masked"))


def instances(docs: DataFrame, key: str, text: str, min_texts: int) -> DataFrame:
    """(k, h, pos) of all lines to drop."""
    lines = _lines(docs, key, text)
    places = store(lines, "line-places")
    texts = places.select("leaf", "form", "n", "h").distinct()
    firsts = places.groupBy("leaf", "form").agg(F.min(F.struct("k", "h", "pos")).alias("first"))
    forms = store(
        texts.groupBy("leaf", "form").agg(F.count("*").alias("texts"), F.first("n").alias("n")).join(firsts, ["leaf", "form"]),
        "line-forms",
    )
    # leaves whose lines can lean on each other: several forms of enough tokens
    leaves = forms.where(F.col("n") >= LEAST_GENERAL).groupBy("leaf").agg(F.count("*").alias("forms"))
    open_forms = forms.where(F.col("n") >= LEAST_GENERAL).join(leaves.where("forms > 1").select("leaf"), "leaf", "left_semi")
    sought = store(open_forms.select("leaf", "form", F.col("first.k").alias("k"), F.col("first.h").alias("h"), F.col("first.pos").alias("pos"), "texts"), "line-open")
    shown = store(_shown(docs, key, text, sought).distinct(), "line-shown")
    words = shown.select("leaf", "form", "texts", F.posexplode(F.split("masked", " ")).alias("at", "token")).where(F.col("token") != VARIABLE)
    constant = words.groupBy("leaf", "at", "token").agg(F.sum("texts").alias("s")).where(F.col("s") >= min_texts).drop("s")
    shares = words.join(constant, ["leaf", "at", "token"]).groupBy("leaf", "form").agg(F.count("*").alias("constants"))
    general = forms.join(shares, ["leaf", "form"]).where(F.col("constants") >= SIMILARITY * F.col("n"))
    leaf_first = general.groupBy("leaf").agg(F.min("first").alias("leaf_first"))
    single = general.where(F.col("texts") < min_texts).join(leaf_first, "leaf").select("leaf", "form", F.col("leaf_first").alias("stays"))
    exact = forms.where(F.col("texts") >= min_texts).select("leaf", "form", F.col("first").alias("stays"))
    return (
        places.join(exact.unionByName(single), ["leaf", "form"])
        .where(~F.struct("k", "h", "pos").eqNullSafe(F.col("stays")))
        .select("k", "h", "pos")
    )


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_texts: int = 2) -> DataFrame:
    """The documents without repeated lines, all columns kept, with ``n_lines`` and ``n_dropped`` added."""
    dropped = store(
        instances(docs, key, text, min_texts).groupBy("k", "h").agg(F.collect_set("pos").alias("gone")), "line-gone"
    ).alias("d")
    joined = docs.alias("a").join(
        dropped, F.xxhash64(F.col(f"a.`{text}`")).eqNullSafe(F.col("d.h")) & F.col(f"a.`{key}`").eqNullSafe(F.col("d.k")), "left"
    )
    lines = F.split(F.col(f"a.`{text}`"), "\n", -1)
    gone = F.col("d.gone")
    # a map looks a position up in the size of the list once built; arrays are short
    stay = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(gone, i)), "\n")
    kept = F.when(gone.isNull(), F.col(f"a.`{text}`")).otherwise(stay)
    columns = [kept.alias(text) if c == text else F.col(f"a.`{c}`") for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return joined.select(
        *columns,
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_dropped"),
    )


_SQL = r"""
with line as (
  select doc_id, text, unnest(range(0, len(ls))) as pos, unnest(ls) as l
  from (select doc_id, text, string_split(text, chr(10)) as ls from documents)),
tok as (
  select doc_id, text, pos, list_transform(regexp_extract_all(l, '[^\x20\x09-\x0D]+'),
         lambda x: case when regexp_matches(x, '[0-9]') then '<*>' else x end) as w from line),
place as (
  select doc_id, text, pos, len(w) as n, array_to_string(w[1:3], ' ') as head, array_to_string(w, ' ') as form, w
  from tok where len(w) >= 3),
form as (
  select n, head, form, any_value(w) as w, count(distinct text) as texts, min({'k': doc_id, 'pos': pos}) as first
  from place group by n, head, form),
word as (select n, head, form, texts, unnest(range(1, n + 1)) as i, unnest(w) as token from form where n >= 8),
const as (select n, head, i, token from word where token <> '<*>' group by n, head, i, token having sum(texts) >= 2),
share as (select n, head, form, count(*) as c from word join const using (n, head, i, token) group by n, head, form),
general as (
  select form.* from form join share using (n, head, form)
  where c >= 0.8 * n and (n, head) in (select (n, head) from form group by n, head having count(*) > 1)),
rule as (
  select n, head, form, first as stays from form where texts >= 2
  union all
  select g.n, g.head, g.form, f.stays from general g
  join (select n, head, min(first) as stays from general group by n, head) f using (n, head) where g.texts < 2),
gone as (
  select doc_id, pos from place join rule using (n, head, form) where {'k': doc_id, 'pos': pos} <> stays)
select doc_id, count(line.pos)::bigint as n_lines, count(gone.pos)::bigint as n_dropped,
       case when count(line.pos) = 0 then any_value(d.text)
       else coalesce(string_agg(l, chr(10) order by line.pos) filter (gone.pos is null), '') end as text
from documents d left join line using (doc_id) left join gone using (doc_id, pos) group by doc_id
"""


@query("op2_line_dedup", _SQL)
def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_lines(table(spark, folder, "documents")).select("doc_id", "n_lines", "n_dropped", "text")
