"""Vocabulary-driven spelling correction for a table of words.

A word one edit (delete, neighbour swap, replace, insert) from another shares with it a string
that is at most one delete away from each; two edits, at most two deletes from each. So both sides
are indexed by their deletes, some n or n^2/2 strings per word, where spelling out the edits
themselves takes 54n or (54n)^2. Long vocabulary words are met by pairs of pieces instead, a fixed
number per word whatever its length. All keys travel as 8-byte hashes; what they bring together
is checked exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import word_deletes, word_edits1, word_transposes
from millrace.operators.ordering import store


SHORT = 20  # letters up to which a vocabulary word is indexed by its deletes


def spell_edits1(words: DataFrame) -> DataFrame:
    """(word, edit): every distinct string one edit away."""
    return words.select("word", F.explode(word_edits1(F.col("word"))).alias("edit"))


def _delete_keys(w: Column, depth: int) -> Column:
    keys = F.array(w)
    level = F.array(w)
    for _ in range(depth):
        level = F.array_distinct(F.flatten(F.transform(level, word_deletes)))
        keys = F.concat(keys, level)
    return F.transform(F.array_distinct(keys), lambda x: F.xxhash64(x))


def _piece(w: Column, length: Column, i: Column, n: int, shift: Column) -> Column:
    """The letters of ``w`` at the place of piece i of n in a word of ``length``, moved by ``shift``; null outside."""
    start = F.floor(length * i / n).cast("int")
    size = F.floor(length * (i + 1) / n).cast("int") - start
    inside = (start + shift >= 0) & (start + shift + size <= F.length(w))
    return F.when(inside, w.substr(start + shift + 1, size))


def _pair_keys(w: Column, depth: int, reach: int) -> Column:
    """Hashes of (length, i, j, piece i, piece j) for each two of 2 * depth + 2 pieces, of words of each length within
    ``reach`` of that of ``w``, looked for in ``w`` where up to ``reach`` inserts and deletes may have moved them.

    Every letter that moves piece i, then piece j against i, then the end against j (by -d in all), takes an edit, so only
    25 of the moves are possible at two edits, 7 at one.
    """
    n = 2 * depth + 2
    steps = range(-reach, reach + 1)
    moves = [(d, s, t) for d in steps for s in steps for t in steps if abs(s) + abs(t - s) + abs(d + t) <= reach]
    # pieces by length, number and shift, each cut out once
    places = sorted({(d, i, s) for d, s, t in moves for i in range(n) for s in (s, t)})
    at = {place: k for k, place in enumerate(places)}
    cut = F.array(*[F.struct(*[F.lit(x).alias(c) for x, c in zip(p, "dis", strict=True)]) for p in places])
    pieces = F.transform(cut, lambda c: _piece(w, F.length(w) + c["d"], c["i"], n, c["s"]))
    pairs = F.array(*[
        F.struct(*[F.lit(x).alias(c) for x, c in zip((d, i, j, at[d, i, s], at[d, j, t]), "dijab", strict=True)])
        for d, s, t in moves for i in range(n) for j in range(i + 1, n)
    ])

    def key(found: Column) -> Column:
        return F.transform(pairs, lambda p: F.when(
            F.get(found, p["a"]).isNotNull() & F.get(found, p["b"]).isNotNull(),
            F.xxhash64(F.length(w) + p["d"], p["i"], p["j"], F.get(found, p["a"]), F.get(found, p["b"])),
        ))

    # the list of pieces is made once and named inside
    return F.array_distinct(F.array_compact(F.flatten(F.transform(F.array(pieces), key))))


def _near(words: DataFrame, vocabulary: DataFrame, depth: int) -> DataFrame:
    """(word, candidate, freq) that ``depth`` edits may join; none that they do join is missing.

    Vocabulary words up to ``SHORT`` letters: both share a string at most ``depth`` deletes from
    each. Words under one key differ from it by at most ``depth`` inserts, which bounds the group
    by the alphabet, whatever the corpus.

    Longer ones: an edit touches at most two of a word's pieces, so of 2 * depth + 2 pieces two are
    whole in the other word, at most ``depth`` places off. Words under one key share a third of their
    letters or more, in two places.
    """
    def keyed(table: DataFrame, keys: Column, *columns: Column | str) -> DataFrame:
        return table.select(*columns, F.explode(keys).alias("key"))

    w, candidate = F.col("word"), F.col("word").alias("candidate")
    short_left = keyed(words.where(F.length(w) <= SHORT + depth), _delete_keys(w, depth), "word")
    short_right = keyed(vocabulary.where(F.length(w) <= SHORT), _delete_keys(w, depth), candidate, "freq")

    long_left = keyed(words.where(F.length(w) > SHORT - depth), _pair_keys(w, depth, depth), "word")
    long_right = keyed(vocabulary.where(F.length(w) > SHORT), _pair_keys(w, depth, 0), candidate, "freq")

    # a list of keys is many times the size of its table, by which Spark would judge it and broadcast it: merged instead
    met = short_left.join(short_right.hint("merge"), "key").unionByName(long_left.join(long_right.hint("merge"), "key"))
    return met.select("word", "candidate", "freq").distinct()


def _letters(c: str) -> Column:
    return F.array_join(F.sort_array(F.split(c, "")), "")


def _one_edit() -> Column:
    lev = F.levenshtein("word", "candidate", 2)
    swap = (
        (lev == 2)
        & (F.length("word") == F.length("candidate"))
        & F.array_contains(word_transposes(F.col("word")), F.col("candidate"))
    )
    return (lev == 1) | swap


def _two_edits() -> Column:
    """Levenshtein distance 2, or a swap of neighbours (two steps there) before or behind one
    more edit."""
    word, candidate = F.col("word"), F.col("candidate")
    lev = F.levenshtein(word, candidate, 4)
    swapped, unswapped = word_transposes(word), word_transposes(candidate)
    with_swap = (
        lev.isin(3, 4)
        & (F.levenshtein(_letters("word"), _letters("candidate"), 2) >= 0)
        & (
            F.exists(swapped, lambda m: F.levenshtein(m, candidate, 1) >= 0)
            | F.exists(unswapped, lambda m: F.levenshtein(word, m, 1) >= 0)
            | F.arrays_overlap(swapped, unswapped)
        )
    )
    return (lev == 2) | with_swap


def _best(candidates: DataFrame) -> DataFrame:
    """Highest frequency, ties to the first word in order."""
    return candidates.groupBy("word").agg(
        F.min(F.struct((-F.col("freq")).alias("minus"), F.col("candidate"))).alias("b")
    ).select("word", F.col("b.candidate").alias("correction"))


def spell_correct(words: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(word, correction, edits): the word itself if known, else the most frequent word one edit
    away, else two edits away, else the word unchanged (edits -1).

    ``words`` is (word), distinct; ``vocabulary`` is (word, freq). Two edits are only looked up
    for words with nothing nearer.
    """
    # word tables grow with the corpus and are small as files: they are merged, as a broadcast holds them in the driver
    listed = vocabulary.select("word").hint("merge")
    known = words.join(listed, "word", "left_semi").select(
        "word", F.col("word").alias("correction"), F.lit(0).alias("edits")
    )
    rest = words.join(listed, "word", "left_anti")
    one = _best(_near(rest, vocabulary, 1).where(_one_edit())).withColumn("edits", F.lit(1))
    # each tier is read by the next one and by the result, so it is stored once
    one = store(one, "one-edit")
    far = store(rest.join(one.select("word").hint("merge"), "word", "left_anti"), "no-one-edit")
    found = known.unionByName(one)
    if far.isEmpty():
        return found
    two = store(_best(_near(far, vocabulary, 2).where(_two_edits())).withColumn("edits", F.lit(2)), "two-edits")
    unchanged = far.join(two.select("word").hint("merge"), "word", "left_anti").select(
        "word", F.col("word").alias("correction"), F.lit(-1).alias("edits")
    )
    return found.unionByName(two).unionByName(unchanged)


def with_bias(vocabulary: DataFrame, tests: DataFrame, bias: int) -> DataFrame:
    """The vocabulary with ``bias`` added to each target's count; a target it lacks starts at 1."""
    targets = tests.select(F.col("target").alias("word")).distinct().withColumn("more", F.lit(bias))
    return vocabulary.join(targets, "word", "full").select(
        "word", (F.coalesce("freq", F.lit(1)) + F.coalesce("more", F.lit(0))).alias("freq")
    )


def spell_report(tests: DataFrame, corrected: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Tested, wrong, unknown and percent right over (target, wrong) pairs; unknown are the wrong ones whose target
    the vocabulary lacks, so that no correction could be right."""
    flagged = vocabulary.select(F.col("word").alias("target"), F.lit(True).alias("is_known")).hint("merge")
    joined = tests.join(corrected.hint("merge"), tests["wrong"] == corrected["word"]).join(flagged, "target", "left")
    missed = F.col("correction") != F.col("target")
    return joined.agg(
        F.count("*").alias("n_tested"),
        F.count_if(missed).alias("n_wrong"),
        F.count_if(missed & F.col("is_known").isNull()).alias("n_unknown"),
        F.count_if(F.col("correction") != F.col("wrong")).alias("n_corrected"),
        F.count_if(F.col("correction") == F.col("wrong")).alias("n_untouched"),
        (100 - 100 * F.try_divide(F.count_if(missed), F.count("*"))).alias("percent_right"),
    )
