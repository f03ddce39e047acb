"""Spelling, sentiment, summaries and the stream."""

from pyspark.sql import functions as F

from millrace.functions import text as tx
from millrace.functions.numbers import hash_bucket, hash_number
from millrace.operators import spelling as sp
from millrace.operators.language import SentimentModel, extractive_summary, sentence_table
from millrace.operators.ordering import store
from millrace.operators.words import word_frequency_prior, words_of
from millrace.plans.inputs import SQL_TOKENS, sql_hash
from millrace.plans.registry import query
from millrace.plans.words import _PARTS, _STOP
from millrace.session import new_folder
from millrace.streaming import streams


def vocabulary(t):
    return store(word_frequency_prior(words_of(t.documents, tx.alpha_words(F.col("text")))), "vocabulary")


def _distinct_words(table):
    return words_of(table, tx.alpha_words(F.col("text"))).distinct()


_ALPHA = "SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM"
_VOCAB = """voc AS (SELECT word, count(*) + 1 AS freq
  FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents) GROUP BY 1)"""
_LETTERS = "(SELECT unnest(string_split('" + tx.ALPHABET + "', '')) AS c)"
_EDITS = """
  SELECT word, substr(word, 1, i - 1) || substr(word, i + 1) AS edit FROM {pos} WHERE i <= length(word)
  UNION SELECT word, substr(word, 1, i - 1) || substr(word, i + 1, 1) || substr(word, i, 1) || substr(word, i + 2)
        FROM {pos} WHERE i < length(word)
  UNION SELECT word, substr(word, 1, i - 1) || c || substr(word, i + 1) FROM {pos}, {letters} WHERE i <= length(word)
  UNION SELECT word, substr(word, 1, i - 1) || c || substr(word, i) FROM {pos}, {letters}"""
SQL_EDITS = _EDITS.format(pos="pos", letters=_LETTERS)


def _pos(name, words):
    return f"{name} AS (SELECT word, CAST(unnest(range(1, length(word) + 2)) AS INTEGER) AS i FROM {words})"


@query("spell_edits1", f"""
WITH w AS ({_ALPHA} benchmark),
pos AS (SELECT word, CAST(unnest(range(1, length(word) + 2)) AS INTEGER) AS i FROM w)
SELECT word, edit FROM ({SQL_EDITS})
""")
def spell_edits1(t):
    return sp.spell_edits1(_distinct_words(t.benchmark))


def _correct_sql(words: str, voc: str = "voc") -> str:
    """CTEs up to ``corrected`` (word, correction, edits) of ``w``, by spelling out the edits and meeting half way."""
    return f"""{words},
rest AS (SELECT word FROM w WHERE word NOT IN (SELECT word FROM {voc})),
pos AS (SELECT word, CAST(unnest(range(1, length(word) + 2)) AS INTEGER) AS i FROM rest),
ones AS (SELECT e.word, edit, freq FROM ({SQL_EDITS}) e JOIN {voc} ON {voc}.word = edit),
one AS (SELECT word, edit, freq FROM ones QUALIFY row_number() OVER (PARTITION BY word ORDER BY freq DESC, edit) = 1),
far AS (SELECT word FROM rest WHERE word NOT IN (SELECT word FROM one)),
{_pos('far_pos', 'far')}, {_pos('voc_pos', voc)},
meet AS (SELECT DISTINCT a.word, b.word AS edit FROM ({_EDITS.format(pos='far_pos', letters=_LETTERS)}) a
         JOIN ({_EDITS.format(pos='voc_pos', letters=_LETTERS)}) b ON a.edit = b.edit),
two AS (SELECT meet.word, edit FROM meet JOIN {voc} ON {voc}.word = edit
        QUALIFY row_number() OVER (PARTITION BY meet.word ORDER BY freq DESC, edit) = 1),
corrected AS (
  SELECT word, coalesce(one.edit, two.edit, word) AS correction,
         CASE WHEN word IN (SELECT word FROM {voc}) THEN 0 WHEN one.edit IS NOT NULL THEN 1
              WHEN two.edit IS NOT NULL THEN 2 ELSE -1 END AS edits
  FROM w LEFT JOIN one USING (word) LEFT JOIN two USING (word))"""


@query("spell_correct", f"""
WITH {_VOCAB}, {_correct_sql(f"w AS ({_ALPHA} conversations)")} SELECT word, correction, edits FROM corrected
""")
def spell_correct(t):
    """All distinct words of the conversations against the documents' vocabulary."""
    return sp.spell_correct(store(_distinct_words(t.conversations), "words"), vocabulary(t))


def _compounds(t):
    """(word, freq): every four neighbouring words of the benchmark's texts written as one, over 20 letters long."""
    words = t.benchmark.select(tx.alpha_words(F.col("text")).alias("w"))
    glued = F.transform(F.sequence(F.lit(1), F.size("w") - 3), lambda i: F.array_join(F.slice("w", i, 4), ""))
    every = words.where(F.size("w") > 3).select(F.explode(glued).alias("word")).where(F.length("word") > sp.SHORT)
    return word_frequency_prior(every)


def _blurred(words):
    """Each word with a letter left out, and, by its hash, two neighbours swapped or a letter doubled as well."""
    w, h = F.col("word"), hash_number(4, "word")
    less = F.element_at(tx.word_deletes(w), (h % F.length(w)).cast("int") + 1)
    at = ((h % 89) % (F.length(less) - 1)).cast("int") + 1
    swapped = F.concat(F.substring(less, F.lit(1), at - 1), F.substring(less, at + 1, F.lit(1)), F.substring(less, at, F.lit(1)), F.substring(less, at + 2, F.length(less)))
    doubled = F.concat(F.substring(less, F.lit(1), at), F.substring(less, at, F.length(less)))
    return words.select(w.alias("target"), F.when(h % 3 == 0, less).when(h % 3 == 1, swapped).otherwise(doubled).alias("wrong"))


_COMPOUNDS = f"""
toks AS (SELECT regexp_extract_all(lower(text), '[a-z]+') AS w FROM benchmark),
comp AS (SELECT word, count(*) + 1 AS freq FROM (
  SELECT array_to_string(w[i:i + 3], '') AS word FROM (SELECT w, unnest(range(1, len(w) - 2)) AS i FROM toks WHERE len(w) > 3))
  WHERE length(word) > 20 GROUP BY 1),
less AS (SELECT word, h, substr(word, 1, CAST(h % length(word) AS INTEGER)) || substr(word, CAST(h % length(word) AS INTEGER) + 2) AS l
         FROM (SELECT word, {sql_hash(4, 'word')} AS h FROM comp)),
blur AS (SELECT word AS target, CASE WHEN h % 3 = 0 THEN l
    WHEN h % 3 = 1 THEN substr(l, 1, p - 1) || substr(l, p + 1, 1) || substr(l, p, 1) || substr(l, p + 2)
    ELSE substr(l, 1, p) || substr(l, p) END AS wrong
  FROM (SELECT word, h, l, CAST((h % 89) % (length(l) - 1) + 1 AS INTEGER) AS p FROM less))"""


@query("spell_compounds", f"""
WITH {_COMPOUNDS}, {_correct_sql("w AS (SELECT DISTINCT wrong AS word FROM blur)", "comp")} SELECT word, correction, edits FROM corrected
""")
def spell_compounds(t):
    """Words of over 20 letters with one or two edits, against a vocabulary of such words."""
    known = store(_compounds(t), "compounds")
    return sp.spell_correct(store(_blurred(known).select(F.col("wrong").alias("word")).distinct(), "words"), known)


def _misspelt(words):
    """Each word with one letter left out or two swapped; a word of one letter doubled."""
    w = F.col("word")
    h = hash_number(9, "word")
    at = (h % F.length(w)).cast("int")
    swap_at = (h % F.greatest(F.length(w) - 1, F.lit(1))).cast("int")
    wrong = (
        F.when(F.length(w) == 1, F.concat(w, w))
        .when(h % 2 == 0, F.element_at(tx.word_deletes(w), at + 1))
        .otherwise(F.element_at(tx.word_transposes(w), swap_at + 1))
    )
    return words.select(w.alias("target"), wrong.alias("wrong"))


def _wrong_sql(source: str) -> str:
    return f"""tests AS (
  SELECT word AS target, CASE WHEN length(word) = 1 THEN word || word WHEN h % 2 = 0
    THEN substr(word, 1, CAST(h % length(word) AS INTEGER)) || substr(word, CAST(h % length(word) AS INTEGER) + 2)
    ELSE substr(word, 1, CAST(s AS INTEGER)) || substr(word, CAST(s AS INTEGER) + 2, 1)
         || substr(word, CAST(s AS INTEGER) + 1, 1) || substr(word, CAST(s AS INTEGER) + 3) END AS wrong
  FROM (SELECT word, h, h % greatest(length(word) - 1, 1) AS s FROM (SELECT word, {sql_hash(9, 'word')} AS h FROM ({source}))))"""


_REPORT = """
SELECT count(*) AS n_tested, count(*) FILTER (correction <> target) AS n_wrong,
       count(*) FILTER (correction <> target AND target NOT IN (SELECT word FROM {voc})) AS n_unknown,
       count(*) FILTER (correction <> wrong) AS n_corrected, count(*) FILTER (correction = wrong) AS n_untouched,
       round(100 - 100 * count(*) FILTER (correction <> target) / count(*), 6) AS percent_right
FROM tests JOIN corrected ON word = wrong
"""


def _report(tests, voc):
    fixed = sp.spell_correct(store(tests.select(F.col("wrong").alias("word")).distinct(), "words"), voc)
    return sp.spell_report(tests, fixed, voc).withColumn("percent_right", F.round("percent_right", 6))


@query("spell_report", f"""
WITH {_VOCAB}, {_wrong_sql(f"SELECT word FROM voc UNION {_ALPHA} conversations")}, {_correct_sql("w AS (SELECT DISTINCT wrong AS word FROM tests)")}
{_REPORT.format(voc="voc")}
""")
def spell_report(t):
    """Every word of the documents and the conversations, some of which the vocabulary, that of the documents, lacks."""
    voc = vocabulary(t)
    words = voc.select("word").union(_distinct_words(t.conversations)).distinct()
    return _report(store(_misspelt(words), "misspelt"), voc)


@query("spell_report_bias", f"""
WITH {_VOCAB}, {_wrong_sql(f"{_ALPHA} conversations")},
named AS (SELECT coalesce(word, target) AS word, coalesce(freq, 1) + CASE WHEN target IS NOT NULL THEN 1000 ELSE 0 END AS freq
          FROM voc FULL JOIN (SELECT DISTINCT target FROM tests) ON word = target),
{_correct_sql("w AS (SELECT DISTINCT wrong AS word FROM tests)", "named")}
{_REPORT.format(voc="named")}
""")
def spell_report_bias(t):
    """The conversations' words, after their counts in the vocabulary have been raised by 1000."""
    tests = store(_misspelt(_distinct_words(t.conversations)), "misspelt")
    return _report(tests, store(sp.with_bias(vocabulary(t), tests, 1000), "biased"))


_FREQ = SQL_TOKENS.format(c="sentence")


@query("extractive_summary", f"""
WITH s AS (SELECT doc_id, CAST(generate_subscripts({_PARTS}, 1) - 1 AS INTEGER) AS pos, unnest({_PARTS}) AS sentence FROM documents),
w AS (SELECT * FROM (SELECT doc_id, pos, unnest({_FREQ}) AS token FROM s) WHERE token NOT IN ({_STOP})),
f AS (SELECT doc_id, token, count(*) AS freq FROM w GROUP BY 1, 2),
sc AS (SELECT doc_id, pos, CAST(sum(freq) AS BIGINT) AS score FROM w JOIN f USING (doc_id, token) GROUP BY 1, 2)
SELECT doc_id, pos, score, sentence FROM s JOIN sc USING (doc_id, pos)
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) <= 5
""")
def summary(t):
    return extractive_summary(t.documents, "doc_id")


def sentiment_model(t):
    """Trained on the labelled documents, its two tables stored."""
    labelled = t.documents.select("doc_id", "text").join(t.labels, "doc_id")
    model = SentimentModel.train(labelled, "quality")
    return SentimentModel(store(model.weights, "weights"), store(model.base, "base"))


_SIMPLE = SQL_TOKENS.format(c="text")
SQL_MODEL = f"""
lab AS (SELECT quality, text FROM documents JOIN labels USING (doc_id)),
cnt AS (SELECT token, count(*) FILTER (quality = 1) AS p, count(*) FILTER (quality <> 1) AS n
        FROM (SELECT quality, unnest({_SIMPLE}) AS token FROM lab) GROUP BY 1),
tot AS (SELECT CAST(sum(n) + count(*) AS DOUBLE) / CAST(sum(p) + count(*) AS DOUBLE) AS ratio FROM cnt),
pri AS (SELECT ln((count(*) FILTER (quality = 1) + 1) / (count(*) FILTER (quality <> 1) + 1)) AS prior FROM lab)
"""


@query("naive_bayes_sentiment", f"""
WITH {SQL_MODEL},
s AS (SELECT doc_id, CAST(generate_subscripts({_PARTS}, 1) - 1 AS INTEGER) AS pos, unnest({_PARTS}) AS sentence FROM documents),
m AS (SELECT doc_id, pos, sum(ln((coalesce(p, 0) + 1) / (coalesce(n, 0) + 1)) + ln((SELECT ratio FROM tot))) AS v
      FROM (SELECT doc_id, pos, unnest({_FREQ}) AS token FROM s) LEFT JOIN cnt USING (token) GROUP BY 1, 2)
SELECT doc_id, pos, round(coalesce(v, 0) + prior, 6) AS margin,
       CASE WHEN round(coalesce(v, 0) + prior, 6) >= 0 THEN 'POS' ELSE 'NEG' END AS label
FROM s LEFT JOIN m USING (doc_id, pos), pri
""")
def naive_bayes_sentiment(t):
    return sentiment_model(t).score(sentence_table(t.documents, "doc_id"), ["doc_id", "pos"], "sentence")


def _arriving(t):
    """The conversations as six files that come in two halves, two files a micro-batch: (folder, arrive)."""
    folder = new_folder(t.spark, "stream-in")
    # the file of a row is fixed by its conversation
    dealt = t.conversations.withColumn("_file", hash_bucket(2, 6, "conv_id"))

    def arrive(half: int) -> None:
        part = dealt.where((F.col("_file") >= 3 * half) & (F.col("_file") < 3 * half + 3))
        part.repartition(3, "_file").drop("_file").write.mode("append").parquet(folder)

    # the folder is there before the stream looks into it
    dealt.limit(0).drop("_file").write.parquet(folder)
    return folder, arrive


def _in_two_runs(t, start):
    """Runs ``start(stream)`` on the first half of the files, and again, on the same checkpoint, on all."""
    folder, arrive = _arriving(t)
    for half in (0, 1):
        arrive(half)
        stream = streams.text_stream(t.spark, folder, t.conversations.schema, files_per_batch=2)
        streams.drained(start(streams.keyword_stream(stream, "the")))


@query("keyword_stream", "SELECT conv_id, turn, role, text FROM conversations WHERE contains(lower(text), 'the')")
def keyword_stream(t):
    """Started twice on one checkpoint, several micro-batches each."""
    out, checkpoint = streams.stream_folders(t.spark)
    _in_two_runs(t, lambda kept: streams.write_stream(kept, out, checkpoint))
    return t.spark.read.schema(t.conversations.schema).parquet(out).select("conv_id", "turn", "role", "text")


@query("stream_sentiment", f"""
WITH {SQL_MODEL},
s AS (SELECT conv_id, turn, text FROM conversations WHERE contains(lower(text), 'the')),
m AS (SELECT conv_id, turn, sum(ln((coalesce(p, 0) + 1) / (coalesce(n, 0) + 1)) + ln((SELECT ratio FROM tot))) AS v
      FROM (SELECT conv_id, turn, unnest({_SIMPLE}) AS token FROM s) LEFT JOIN cnt USING (token) GROUP BY 1, 2)
SELECT conv_id, turn, round(coalesce(v, 0) + prior, 6) AS margin,
       CASE WHEN round(coalesce(v, 0) + prior, 6) >= 0 THEN 'POS' ELSE 'NEG' END AS label
FROM s LEFT JOIN m USING (conv_id, turn), pri
""")
def stream_sentiment(t):
    """Started twice on one checkpoint, several micro-batches each."""
    out, checkpoint = streams.stream_folders(t.spark)
    model = sentiment_model(t)
    _in_two_runs(t, lambda kept: streams.stream_sentiment(kept, model, ["conv_id", "turn"], out, checkpoint))
    return t.spark.read.parquet(out).select("conv_id", "turn", "margin", "label")
