"""Word counts, tokens and text functions over the document texts."""

from pyspark.sql import functions as F

from millrace.functions import text as tx
from millrace.functions.arrays import chunk_text
from millrace.operators import aggregates as agg
from millrace.operators import words
from millrace.operators.ordering import number_rows
from millrace.operators.relational import drop_listed, known_words, union_all
from millrace.plans.inputs import SQL_TOKENS
from millrace.plans.registry import query

_STOP = ", ".join(f"'{w}'" for w in tx.STOPWORDS)
SIMPLE = SQL_TOKENS.format(c="text")
KEPT = f"list_filter({SIMPLE}, lambda x: x NOT IN ({_STOP}))"
_CLEAN = "regexp_replace(lower(regexp_replace(text, '[^\\w\\s]', '', 'g')), '^\\s+|\\s+$', '', 'g')"
SQL_WORDS = f"w AS (SELECT word FROM (SELECT unnest(string_split({_CLEAN}, ' ')) AS word FROM documents) WHERE word <> '')"


@query("clean_text", f"SELECT doc_id, {_CLEAN} AS cleaned FROM documents")
def clean_text(t):
    return t.documents.select("doc_id", tx.clean_text(F.col("text")).alias("cleaned"))


@query("strip_ascii_punct", """
SELECT doc_id, regexp_replace(text, '[[:punct:]]', '', 'g') AS stripped FROM documents
""")
def strip_ascii_punct(t):
    return t.documents.select("doc_id", tx.strip_ascii_punct(F.col("text")).alias("stripped"))


@query("split_words", """
SELECT doc_id, count(*) AS n_pieces, count(*) FILTER (piece = '') AS n_empty
FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS piece FROM documents) GROUP BY 1
""")
def split_words(t):
    pieces = tx.split_words(F.col("text"))
    return t.documents.select(
        "doc_id",
        F.size(pieces).cast("bigint").alias("n_pieces"),
        F.size(F.filter(pieces, lambda x: x == "")).cast("bigint").alias("n_empty"),
    )


def _joined(tokens):
    return F.array_join(tokens, " ")


@query("tokenize_simple", f"SELECT doc_id, array_to_string({SIMPLE}, ' ') AS tokens FROM documents")
def tokenize_simple(t):
    return t.documents.select("doc_id", _joined(tx.tokenize_simple(F.col("text"))).alias("tokens"))


@query("tokenize_stop", f"SELECT doc_id, array_to_string({KEPT}, ' ') AS tokens FROM documents")
def tokenize_stop(t):
    return t.documents.select("doc_id", _joined(tx.tokenize_stop(F.col("text"))).alias("tokens"))


@query("alpha_words", """
SELECT doc_id, array_to_string(regexp_extract_all(lower(text), '[a-z]+'), ' ') AS tokens FROM documents
""")
def alpha_words(t):
    return t.documents.select("doc_id", _joined(tx.alpha_words(F.col("text"))).alias("tokens"))


SQL_BLANKS = "list_filter(regexp_split_to_array(replace(lower(text), chr(10), ''), '\\s+'), lambda x: x <> '')"


@query("whitespace_tokens", f"SELECT doc_id, array_to_string({SQL_BLANKS}, ' ') AS tokens FROM documents")
def whitespace_tokens(t):
    return t.documents.select("doc_id", _joined(tx.whitespace_tokens(F.col("text"))).alias("tokens"))


@query("drop_empty", f"WITH {SQL_WORDS} SELECT count(*) AS n_words FROM w")
def drop_empty(t):
    return words.cleaned_words(t.documents).agg(F.count("*").alias("n_words"))


@query("map_suffix", f"WITH {SQL_WORDS} SELECT word || 's' AS plural, count(*) AS n FROM w GROUP BY 1")
def map_suffix(t):
    plural = F.concat("word", F.lit("s")).alias("plural")
    return agg.count_by_key(words.cleaned_words(t.documents).select(plural), "plural")


@query("map_length", f"""
WITH {SQL_WORDS} SELECT CAST(length(word) AS INTEGER) AS length, count(*) AS n FROM w WHERE word <> 'the' GROUP BY 1
""")
def map_length(t):
    kept = words.cleaned_words(t.documents).where("word != 'the'")
    return agg.count_by_key(kept.select(F.length("word").alias("length")), "length")


@query("number_lines", """
SELECT (row_number() OVER (ORDER BY doc_id, pos) - 1) || ': ' || line AS numbered
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)
""")
def number_lines(t):
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    numbered = number_rows(lines, [F.col("doc_id"), F.col("pos")], "n")
    return numbered.select(F.format_string("%d: %s", "n", "line").alias("numbered"))


@query("union_corpus", """
SELECT origin, count(*) AS n, count(DISTINCT text) AS n_distinct
FROM (SELECT 'documents' AS origin, text FROM documents
      UNION ALL SELECT 'conversations', text FROM conversations) GROUP BY 1
""")
def union_corpus(t):
    both = union_all(
        t.documents.select(F.lit("documents").alias("origin"), "text"),
        t.conversations.select(F.lit("conversations").alias("origin"), "text"),
    )
    return both.groupBy("origin").agg(
        F.count("*").alias("n"), F.countDistinct(F.md5("text")).alias("n_distinct")
    )


@query("stopword_anti", f"WITH {SQL_WORDS} SELECT word, count(*) AS n FROM w WHERE word NOT IN ({_STOP}) GROUP BY 1")
def stopword_anti(t):
    # counted first: the list then meets each word once
    return drop_listed(words.word_count(t.documents), tx.STOPWORDS)


@query("vocab_semi", f"""
WITH {SQL_WORDS}, v AS (SELECT DISTINCT unnest({SIMPLE}) AS word FROM benchmark)
SELECT word, count(*) AS n FROM w WHERE word IN (SELECT word FROM v) GROUP BY 1
""")
def vocab_semi(t):
    vocabulary = words.words_of(t.benchmark, tx.tokenize_simple(F.col("text"))).distinct()
    return known_words(words.word_count(t.documents), vocabulary)


@query("word_count", f"WITH {SQL_WORDS} SELECT word, count(*) AS n FROM w GROUP BY 1")
def word_count(t):
    return words.word_count(t.documents)


@query("top_words", f"WITH {SQL_WORDS} SELECT word, count(*) AS n FROM w GROUP BY 1 ORDER BY n DESC, word LIMIT 15")
def top_words(t):
    return agg.top_k(words.word_count(t.documents), 15, "n", "word")


@query("number_format", f"""
WITH {SQL_WORDS}, c AS (SELECT word, count(*) AS n FROM w GROUP BY 1 ORDER BY n DESC, word LIMIT 15)
SELECT word || ': ' || n AS label, format('{{:.3f}}', n / 7.0::DOUBLE) AS third FROM c
""")
def number_format(t):
    top = agg.top_k(words.word_count(t.documents), 15, "n", "word")
    return top.select(
        F.format_string("%s: %d", "word", "n").alias("label"),
        F.format_string("%.3f", F.col("n") / 7).alias("third"),
    )


@query("mean_per_unique", f"""
WITH {SQL_WORDS}, c AS (SELECT word, count(*) AS n FROM w GROUP BY 1)
SELECT round(sum(n) / count(*), 2) AS mean_count FROM c
""")
def mean_per_unique(t):
    return words.mean_per_unique(words.word_count(t.documents))


@query("top_desc_values", f"""
WITH {SQL_WORDS} SELECT word FROM w ORDER BY encode(word) DESC LIMIT 5
""")
def top_desc_values(t):
    return words.cleaned_words(t.documents).orderBy(F.desc("word")).limit(5)


@query("lookup_map", """
SELECT source || '=' || count(*) AS entry FROM documents GROUP BY source
""")
def lookup_map(t):
    # the number of sources is small but nothing bounds it, so the map stays a table of entries
    counts = agg.count_by_key(t.documents, "source")
    return counts.select(F.concat_ws("=", "source", F.col("n").cast("string")).alias("entry"))


@query("record_tokens", f"""
SELECT doc_id, CAST(len({KEPT}) AS INTEGER) AS n_tokens, md5(array_to_string({KEPT}, ' ')) AS digest FROM documents
""")
def record_tokens(t):
    return words.record_tokens(t.documents.select("doc_id", "text")).select(
        "doc_id", F.size("tokens").alias("n_tokens"), F.md5(_joined("tokens")).alias("digest")
    )


@query("token_total", f"SELECT CAST(sum(len({KEPT})) AS BIGINT) AS n_tokens FROM documents")
def token_total(t):
    return words.token_total(words.record_tokens(t.documents.select("doc_id", "text")))


@query("biggest_record", f"""
SELECT doc_id, CAST(len({KEPT}) AS INTEGER) AS n_tokens FROM documents ORDER BY n_tokens DESC, doc_id LIMIT 1
""")
def biggest_record(t):
    return words.biggest_record(words.record_tokens(t.documents.select("doc_id", "text")), "doc_id")


@query("word_frequency_prior", """
SELECT word, count(*) + 1 AS freq
FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents) GROUP BY 1
""")
def word_frequency_prior(t):
    return words.word_frequency_prior(words.words_of(t.documents, tx.alpha_words(F.col("text"))))


_PARTS = ("list_filter(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)),"
          " lambda x: x <> '')")


@query("sentence_split", f"""
SELECT doc_id, CAST(generate_subscripts({_PARTS}, 1) - 1 AS INTEGER) AS pos, unnest({_PARTS}) AS sentence FROM documents
""")
def sentence_split(t):
    return t.documents.select(
        "doc_id", F.posexplode(tx.sentences(F.col("text"))).alias("pos", "sentence")
    )


@query("char_index", """
SELECT c AS symbol, row_number() OVER (ORDER BY encode(c)) - 1 AS ix
FROM (SELECT DISTINCT unnest(string_split(text, '')) AS c FROM documents) WHERE c <> ''
""")
def char_index(t):
    symbols = t.documents.select(F.explode(tx.characters(F.col("text"))).alias("symbol")).distinct()
    return number_rows(symbols, [F.col("symbol")], "ix")


@query("chunk_text", """
SELECT doc_id, CAST(i AS INTEGER) AS pos, substring(text, CAST(i * 200 + 1 AS INTEGER), 200) AS chunk
FROM (SELECT doc_id, text, unnest(range(length(text) // 200)) AS i FROM documents)
""")
def chunked(t):
    return t.documents.select("doc_id", F.posexplode(chunk_text(F.col("text"), 200)).alias("pos", "chunk"))
