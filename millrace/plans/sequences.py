"""Vocabularies, encoded and padded sequences, word vectors, questions."""

from pyspark.sql import functions as F

from millrace.functions import arrays
from millrace.functions import text as tx

from millrace.operators import sequences as sq
from millrace.operators.embedding import train_vectors
from millrace.operators.ordering import store
from millrace.operators.words import record_tokens, words_of
from millrace.plans.inputs import sql_hash
from millrace.plans.registry import query
from millrace.plans.words import SQL_BLANKS
from millrace.session import new_folder
from millrace.sources import files

MIN_COUNT = 30
ENTITIES = 550
INPUTS = ENTITIES + 200  # ids the network of the checks takes


def _records(t):
    return record_tokens(t.documents.select("doc_id", "text"), tokenize=tx.whitespace_tokens)


def _words(t):
    return words_of(t.documents, tx.whitespace_tokens(F.col("text")))


SQL_VOCAB = f"""
tok AS (SELECT doc_id, generate_subscripts({SQL_BLANKS}, 1) AS pos, unnest({SQL_BLANKS}) AS word FROM documents),
vocab AS (SELECT word, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, encode(word)) AS ix
          FROM tok GROUP BY 1 HAVING count(*) >= {MIN_COUNT})
"""
SQL_SEQ = SQL_VOCAB + """,
seq AS (SELECT doc_id, coalesce(list(coalesce(ix, 0) ORDER BY pos) FILTER (pos IS NOT NULL), []) AS seq
        FROM documents LEFT JOIN tok USING (doc_id) LEFT JOIN vocab USING (word) GROUP BY 1)
"""


@query("build_vocabulary", f"WITH {SQL_VOCAB} SELECT word, n, ix FROM vocab")
def build_vocabulary(t):
    return sq.build_vocabulary(_words(t), MIN_COUNT)


@query("limit_vocabulary", f"""
WITH {SQL_VOCAB} SELECT word, count(*) AS n FROM tok GROUP BY 1 ORDER BY n DESC, encode(word) LIMIT 20000
""")
def limit_vocabulary(t):
    return sq.limit_vocabulary(_words(t), 20000)


def _encoded(t):
    return sq.encode_sequences(_records(t), sq.build_vocabulary(_words(t), MIN_COUNT), "doc_id")


def _shown(c):
    return F.array_join(c.cast("array<string>"), " ")


@query("encode_sequences", f"WITH {SQL_SEQ} SELECT doc_id, array_to_string(seq, ' ') AS seq FROM seq")
def encode_sequences(t):
    return _encoded(t).select("doc_id", _shown(F.col("seq")).alias("seq"))


@query("pad_pre", f"""
WITH {SQL_SEQ}
SELECT doc_id, array_to_string(list_slice(list_concat(list_transform(range(100), lambda i: 0), seq), -100, -1), ' ') AS seq FROM seq
""")
def pad_pre(t):
    return _encoded(t).select("doc_id", _shown(arrays.pad_pre(F.col("seq"), 100)).alias("seq"))


@query("pad_post", f"""
WITH {SQL_SEQ}
SELECT doc_id, array_to_string(list_slice(list_concat(seq, list_transform(range(350), lambda i: 0)), 1, 350), ' ') AS seq FROM seq
""")
def pad_post(t):
    return _encoded(t).select("doc_id", _shown(arrays.pad_post(F.col("seq"), 350)).alias("seq"))


def _word_vectors(t):
    vocabulary = sq.build_vocabulary(_words(t), MIN_COUNT)
    return vocabulary, train_vectors(_records(t), vocabulary, "doc_id", size=300, window=7, passes=10)


@query("train_word2vec")
def train_word2vec(t):
    """(word, vec): 300 numbers for each word of the vocabulary, after ten passes."""
    return _word_vectors(t)[1]


@query("embedding_table")
def embedding_table(t):
    """(ix, vec): row 0 and every word of the vocabulary."""
    vocabulary, vectors = _word_vectors(t)
    return sq.embedding_table(vocabulary, vectors, 300)


@query("pretrained_vectors", f"""
WITH words AS (SELECT 'v' || doc_id AS word, doc_id + 1 AS ix FROM documents),
v AS (SELECT 'v' || vec_id AS word, list_sum(list_transform(embedding, lambda x: x::DOUBLE)) AS s FROM embeddings)
SELECT ix, round(coalesce(s, 0), 6) AS total FROM words LEFT JOIN v USING (word) UNION ALL SELECT 0, 0
""")
def pretrained_vectors(t):
    """One word per document, of which only some have a vector in the file."""
    path = new_folder(t.spark, "vectors")
    t.embeddings.select(
        F.concat_ws(
            " ", F.concat(F.lit("v"), "vec_id"),
            F.transform("embedding", lambda x: x.cast("double").cast("string")),
        ).alias("value")
    ).write.text(path)
    vectors = files.word_vector_file(files.text_lines(t.spark, path))
    vocabulary = t.documents.select(
        F.concat(F.lit("v"), "doc_id").alias("word"), (F.col("doc_id") + 1).alias("ix")
    )
    table = sq.embedding_table(vocabulary, vectors, 64)
    return table.select(
        "ix", F.round(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x), 6).alias("total")
    )


@query("next_step_pairs", """
WITH c AS (SELECT doc_id, i AS chunk, substring(text, CAST(i * 200 + 1 AS INTEGER), 200) AS piece
           FROM (SELECT doc_id, text, unnest(range(length(text) // 200)) AS i FROM documents)),
p AS (SELECT piece, unnest(range(1, 200)) AS i FROM c)
SELECT substring(piece, CAST(i AS INTEGER), 1) AS symbol, substring(piece, CAST(i + 1 AS INTEGER), 1) AS next, count(*) AS n FROM p GROUP BY 1, 2
""")
def next_step_pairs(t):
    """How often each symbol follows each other one inside chunks of 200."""
    chunks = t.documents.select("doc_id", F.posexplode(arrays.chunk_text(F.col("text"), 200)).alias("chunk", "piece"))
    symbols = chunks.select("doc_id", "chunk", tx.characters(F.col("piece")).alias("symbols"))
    pairs = sq.next_step_pairs(symbols, ["doc_id", "chunk"], "symbols")
    return pairs.groupBy("symbol", "next").agg(F.count("*").alias("n"))


@query("epoch_batches", """
WITH e AS (SELECT epoch, doc_id, row_number() OVER (PARTITION BY epoch ORDER BY md5('0:' || epoch || ':' || doc_id), doc_id) - 1 AS n
           FROM documents, range(3) AS x(epoch))
SELECT CAST(epoch AS INTEGER) AS epoch, n // 32 AS batch, n % 32 AS place, doc_id FROM e
""")
def epoch_batches(t):
    return sq.epoch_batches(t.documents, "doc_id", 32, 3)


# ---- questions ----------------------------------------------------------------------------

_LONG = 9  # letters a word needs to become an entity of its document


def question_records(t):
    """A nine-line record per document. Its longest words become entities in order of first use; the question is
    the context with the first entity blanked out. A document without such words has no candidates.

    Some records are faulty, by the last digit of their id: 3 names an entity that is no candidate, 5 has such an
    answer, 7 breaks off after the question, 9 lists 600 candidates more.
    """
    words = F.filter(F.split(F.regexp_replace("text", r"\s+", " "), " "), lambda x: x != "")
    base = t.documents.select("doc_id", words.alias("words"), (F.col("doc_id") % 10).alias("kind"))
    base = base.withColumn("names", F.filter(F.array_distinct("words"), lambda x: F.length(x) >= _LONG))
    ids = F.transform(
        "words",
        # every word of that length is among the names
        lambda x: F.when(
            F.length(x) >= _LONG,
            F.concat(F.lit("@entity"), (F.array_position("names", x) - 1).cast("string")),
        ).otherwise(x),
    )
    strange = F.when(F.col("kind") == 3, F.array(F.lit("@entity9999"))).otherwise(F.array().cast("array<string>"))
    base = base.withColumn("context", F.array_join(F.concat(ids, strange), " "))
    question = F.array_join(
        F.transform(F.split("context", " "), lambda x: F.when(x == "@entity0", "@placeholder").otherwise(x)), " "
    )
    named = F.transform("names", lambda x, i: F.concat(F.lit("@entity"), i.cast("string"), F.lit(":"), x))
    more = F.when(F.col("kind") == 9, F.transform(
        F.sequence(F.lit(10000), F.lit(10599)), lambda i: F.concat(F.lit("@entity"), i.cast("string"), F.lit(":more")))
    ).otherwise(F.array().cast("array<string>"))
    answer = F.when(F.col("kind") == 5, "@entity9998").otherwise("@entity0")
    head = F.concat_ws("\n", F.concat(F.lit("doc/"), "doc_id"), F.lit(""), F.col("context"), F.lit(""), question)
    whole = F.concat_ws("\n", head, F.lit(""), answer, F.lit(""), F.array_join(F.concat(named, more), "\n"))
    return base.select(F.when(F.col("kind") == 7, head).otherwise(whole).alias("value"))


_END = "\x1e"


def read_questions(t):
    """Written as packed text files, many records each, and read back. A file is a task's, so it may be compressed as a whole."""
    path = new_folder(t.spark, "questions")
    question_records(t).write.option("lineSep", _END).option("compression", "gzip").text(path)
    read = files.question_files(t.spark, path, _END)
    return read.withColumn("doc_id", F.substring_index("url", "/", -1).cast("bigint")).drop("url")


SQL_QUESTIONS = f"""
wrd AS (SELECT doc_id, list_filter(string_split(regexp_replace(text, '\\s+', ' ', 'g'), ' '), lambda x: x <> '') AS words FROM documents),
uw AS (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS pos FROM wrd),
nm AS (SELECT doc_id, w, row_number() OVER (PARTITION BY doc_id ORDER BY min(pos)) - 1 AS id FROM uw
       WHERE length(w) >= {_LONG} GROUP BY 1, 2),
-- a text without words is a context of one empty word
ctx AS (SELECT doc_id, pos, CASE WHEN id IS NOT NULL THEN '@entity' || id ELSE w END AS word FROM uw LEFT JOIN nm USING (doc_id, w)
        UNION ALL SELECT doc_id, 1000000000, '@entity9999' FROM documents WHERE doc_id % 10 = 3
        UNION ALL SELECT doc_id, 1, '' FROM wrd WHERE len(words) = 0 AND doc_id % 10 <> 3),
cand AS (SELECT doc_id, '@entity' || id AS word, id AS place FROM nm
         UNION ALL SELECT doc_id, '@entity' || i, i FROM documents, range(10000, 10600) AS x(i) WHERE doc_id % 10 = 9),
ask AS (SELECT doc_id, doc_id % 10 <> 7 AS ok, CASE WHEN doc_id % 10 = 5 THEN '@entity9998' ELSE '@entity0' END AS answer FROM documents)
"""


@query("question_files", f"""
WITH {SQL_QUESTIONS},
seen AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (word LIKE '@entity%') AS n_entities, count(*) FILTER (word = '@entity0') AS n_blanks
         FROM ctx GROUP BY 1),
listed AS (SELECT doc_id, count(*) AS n FROM cand GROUP BY 1)
SELECT doc_id, CASE WHEN ok THEN 'ok' ELSE 'short' END AS status, CASE WHEN ok THEN n_words ELSE 0 END AS n_words,
       CASE WHEN ok THEN n_entities ELSE 0 END AS n_entities, CASE WHEN ok THEN n_blanks ELSE 0 END AS n_blanks,
       CASE WHEN ok THEN answer END AS answer, CAST(CASE WHEN ok THEN coalesce(n, 0) ELSE 0 END AS INTEGER) AS n_candidates
FROM ask JOIN seen USING (doc_id) LEFT JOIN listed USING (doc_id)
""")
def question_files(t):
    def count(text, test):
        return F.when(F.col(text).isNotNull(), F.size(F.filter(F.split(text, " "), test))).otherwise(0).cast("bigint")

    return read_questions(t).select(
        "doc_id", "status",
        count("context", lambda x: F.lit(True)).alias("n_words"),
        count("context", lambda x: x.startswith("@entity")).alias("n_entities"),
        count("question", lambda x: x == "@placeholder").alias("n_blanks"),
        "answer",
        F.when(F.col("candidates").isNotNull(), F.size("candidates")).otherwise(0).alias("n_candidates"),
    )


def _question_vocabulary(t):
    frequent = sq.build_vocabulary(_words(t), MIN_COUNT).select("word", F.col("ix").alias("rank"))
    return store(sq.entity_vocabulary(frequent, ENTITIES), "question-vocabulary")


SQL_QVOCAB = SQL_VOCAB + f""",
qv AS (SELECT word, row_number() OVER (ORDER BY block, rank) AS ix FROM (
  SELECT 0 AS block, i AS rank, '@entity' || i AS word FROM range({ENTITIES}) AS x(i)
  UNION ALL SELECT 1, ix, word FROM vocab
  UNION ALL SELECT 2, 0, '<UNK>' UNION ALL SELECT 2, 1, '@placeholder'))
"""


@query("entity_vocabulary", f"WITH {SQL_QVOCAB} SELECT word, ix FROM qv")
def entity_vocabulary(t):
    return _question_vocabulary(t)


SQL_ENCODED = f"""{SQL_QVOCAB}, {SQL_QUESTIONS},
map AS (SELECT doc_id, word, place, (row_number() OVER (PARTITION BY doc_id ORDER BY md5('0:' || doc_id || ':' || word), word) - 1
               + {sql_hash(0, 'doc_id')} % {ENTITIES}) % {ENTITIES} AS code FROM cand),
unk AS (SELECT ix FROM qv WHERE word = '<UNK>'),
tokens AS (SELECT doc_id, 0 AS part, pos, word FROM ctx
           UNION ALL SELECT doc_id, 1, pos, CASE WHEN word = '@entity0' THEN '@placeholder' ELSE word END FROM ctx
           UNION ALL SELECT doc_id, 2, 0, answer FROM ask
           UNION ALL SELECT doc_id, 3, place, word FROM cand),
enc AS (SELECT doc_id, part, pos, CASE WHEN code IS NOT NULL THEN code WHEN word LIKE '@entity%' THEN -1 ELSE coalesce(ix, (SELECT ix FROM unk)) END AS code
        FROM tokens LEFT JOIN map USING (doc_id, word) LEFT JOIN qv USING (word) WHERE doc_id % 10 <> 7)
"""


@query("encode_questions", f"""
WITH {SQL_ENCODED}
SELECT doc_id, CASE WHEN ok THEN 'ok' ELSE 'short' END AS status,
       string_agg(code, ' ' ORDER BY pos) FILTER (part = 0) AS context, string_agg(code, ' ' ORDER BY pos) FILTER (part = 1) AS question,
       coalesce(max(code) FILTER (part = 2), -2) AS answer,
       CASE WHEN ok THEN coalesce(string_agg(code, ' ' ORDER BY pos) FILTER (part = 3), '') END AS candidates
FROM ask LEFT JOIN enc USING (doc_id) GROUP BY doc_id, ok
""")
def encode_questions(t):
    encoded = sq.encode_questions(read_questions(t), _question_vocabulary(t), "doc_id", ENTITIES)
    return encoded.select("doc_id", "status", *[_shown(F.col(c)).alias(c) for c in ("context", "question")], F.coalesce("answer", F.lit(-2)).alias("answer"), _shown(F.col("candidates")).alias("candidates"))


@query("encoding_checks", f"""
WITH {SQL_ENCODED},
per AS (SELECT doc_id, bool_or(part < 2 AND code < 0) AS neg, bool_or(part < 2 AND code >= {INPUTS}) AS big, bool_or(part = 3 AND (code < 0 OR code >= {ENTITIES})) AS cand,
               bool_or(part = 2 AND (code < 0 OR code >= {ENTITIES})) AS ans,
               count(*) FILTER (part = 3) > count(DISTINCT code) FILTER (part = 3) AS dup FROM enc GROUP BY 1)
SELECT count(*) AS n_questions, count(*) FILTER (NOT ok) AS short_record, count(*) FILTER (neg) AS unmapped_entity,
       count(*) FILTER (big) AS id_out_of_range, count(*) FILTER (cand) AS invalid_candidate,
       count(*) FILTER (ans) AS invalid_answer, count(*) FILTER (dup) AS duplicate_ids FROM ask LEFT JOIN per USING (doc_id)
""")
def encoding_checks(t):
    """Against a network of ``INPUTS`` ids."""
    encoded = sq.encode_questions(read_questions(t), _question_vocabulary(t), "doc_id", ENTITIES)
    return sq.encoding_checks(encoded, ENTITIES, INPUTS)
