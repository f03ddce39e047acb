"""Operators on small fixtures: literals, brute force, planted skew."""

import csv
import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from millrace.functions import arrays, logs, numbers, text
from millrace.operators import aggregates as agg
from millrace.operators import embedding
from millrace.operators import entity as er
from millrace.operators import features as ft
from millrace.operators import language
from millrace.operators import metrics as mx
from millrace.operators import models as ml
from millrace.operators import neighbours
from millrace.operators import relational as rel
from millrace.operators import sequences as sq
from millrace.operators import spelling as sp
from millrace.operators import weblog
from millrace.operators.language import SentimentModel, extractive_summary
from millrace.operators.neighbours import knn_classify, knn_fitted
from millrace.operators.ordering import number_rows, running_totals, store
from millrace.operators.words import biggest_record, record_tokens, word_count
from millrace.plans import all_queries
from millrace.session import new_folder, scratch_dir
from millrace.sources import files
from millrace.sources.inventory import file_inventory, list_files
from millrace.streaming import streams


def one(spark, value, build, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(build(F.col("c"))).first()[0]


# ---- text -----------------------------------------------------------------------------------


def test_clean_text(spark):
    assert one(spark, " The Elephant's 4 cats. ", text.clean_text) == "the elephants 4 cats"
    assert one(spark, "No under_score!\f", text.clean_text) == "no under_score"


def test_tokens(spark):
    got = one(spark, "!!!!123A/456_B/789C.123A", text.tokenize_simple)
    assert got == ["123a", "456_b", "789c", "123a"]
    assert one(spark, " ", text.tokenize_simple) == []
    assert one(spark, "The quick the fox", text.tokenize_stop) == ["quick", "fox"]
    assert one(spark, "a  b", text.split_words) == ["a", "", "b"]
    assert one(spark, "It is 5 o'clock", text.alpha_words) == ["it", "is", "o", "clock"]
    assert one(spark, " A\nb  c ", text.whitespace_tokens) == ["ab", "c"]
    assert one(spark, "a_b-c!d~", text.strip_ascii_punct) == "abcd"
    assert one(spark, "Hi. You! Ok? end", text.sentences) == ["Hi.", "You!", "Ok?", "end"]


def distance(a, b):
    """Fewest inserts, deletes, replacements and swaps of neighbours that make ``b`` of ``a``."""
    best = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            ways = [best[i - 1, j] + 1, best[i, j - 1] + 1, best[i - 1, j - 1] + (x != y)]
            k, m = a.rfind(y, 0, i - 1), b.rfind(x, 0, j - 1)
            if k >= 0 and m >= 0:
                ways.append(best[k, m] + (i - k - 2) + 1 + (j - m - 2))
            best[i, j] = min(ways)
    return best[len(a), len(b)]


@pytest.mark.parametrize("word", ["a", "ab", "aab", "words", ""])
def test_edits(spark, word):
    got = one(spark, word, text.word_edits1)
    assert len(got) == len(set(got))
    own = sorted(set(word)) + ["q"]
    sizes = range(max(len(word) - 1, 0), len(word) + 2)
    near = {w for n in sizes for w in map("".join, itertools.product(own, repeat=n)) if distance(word, w) <= 1}
    assert {w for w in got if set(w) <= set(own)} == near - {""} | ({""} if len(word) == 1 else set())
    # a letter that the word lacks is as good as any other
    strange = [c for c in text.ALPHABET if c not in word]
    assert len({sum(c in w for w in got) for c in strange}) == 1
    assert set(got) == {w for w in got if set(w) <= set(own)} | {w.replace("q", c) for w in near if "q" in w for c in strange}


def test_word_count(spark):
    words = spark.createDataFrame([("cat",), ("elephant",), ("rat",), ("rat",), ("cat",)], "text string")
    assert dict(word_count(words).collect()) == {"cat": 2, "elephant": 1, "rat": 2}


def test_biggest_record(spark):
    docs = spark.createDataFrame([(1, "x y"), (2, "x y z"), (3, "p q r")], "id int, text string")
    assert biggest_record(record_tokens(docs), "id").first() == (2, 3)


# ---- arrays and numbers ---------------------------------------------------------------------


def test_padding(spark):
    ints = "array<int>"
    assert one(spark, [1, 2], lambda c: arrays.pad_pre(c, 4), ints) == [0, 0, 1, 2]
    assert one(spark, [1, 2, 3], lambda c: arrays.pad_pre(c, 2), ints) == [2, 3]
    assert one(spark, [1, 2], lambda c: arrays.pad_post(c, 4), ints) == [1, 2, 0, 0]
    assert one(spark, [1, 2, 3], lambda c: arrays.pad_post(c, 2), ints) == [1, 2]
    assert one(spark, 2, lambda c: arrays.one_hot(c, 4), "int") == [0, 0, 1, 0]
    assert one(spark, [3, 9, 9], arrays.argmax, ints) == 1
    assert one(spark, "abcdefg", lambda c: arrays.chunk_text(c, 3)) == ["abc", "def"]
    assert one(spark, "ab", lambda c: arrays.chunk_text(c, 3)) == []


def test_bins(spark):
    for value, bin_100, bin_edge in [(0.0, 0, 1), (0.29, 29, 3), (0.3, 30, 4), (0.999, 99, 10), (1.0, 100, 11)]:
        assert one(spark, value, numbers.score_bin, "double") == bin_100
        assert one(spark, value, numbers.edge_bin, "double") == bin_edge == np.digitize(value, np.arange(11) / 10)
    assert one(spark, 6.9, numbers.share_label, "double") == ""
    assert one(spark, 42.4, numbers.share_label, "double") == "42%"


def test_histogram(spark):
    values = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 10)], "v double")
    assert [r["n"] for r in agg.histogram(values, "v", 5).orderBy("bin").collect()] == [2, 1, 0, 0, 1]


# ---- order ----------------------------------------------------------------------------------


def test_number_rows_and_running_totals(spark):
    values = random.Random(1).sample(range(10_000), 2000)
    df = spark.createDataFrame([(v,) for v in values], "v bigint").repartition(7)
    numbered = number_rows(df, [F.col("v")], "n", start=1).collect()
    assert {r["v"]: r["n"] for r in numbered} == {v: i for i, v in enumerate(sorted(values), 1)}
    sums = running_totals(df, [F.desc("v")], {"total": "v"}).collect()
    expected = dict(zip(sorted(values, reverse=True), itertools.accumulate(sorted(values, reverse=True))))
    assert {r["v"]: r["total"] for r in sums} == expected


def test_epoch_batches(spark):
    got = sq.epoch_batches(spark.range(10), "id", 4, 2).toPandas()
    for _, epoch in got.groupby("epoch"):
        assert sorted(epoch["id"]) == list(range(10))
        assert epoch.groupby("batch").size().tolist() == [4, 4, 2]


# ---- logs -----------------------------------------------------------------------------------


def test_log_lines(spark):
    good = '127.0.0.1 - - [01/Aug/1995:00:00:01 -0400] "GET /images/launch-logo.gif HTTP/1.0" 200 1839'
    rows = [
        good,
        good.replace("HTTP/1.0", "to HTTP/1.0 x").replace("1839", "-"),
        good.replace('"', ""),
        good.replace("1839", "18k"),
        good.replace("01/Aug", "41/Aug"),
        "",
    ]
    parsed = weblog.parse_access_log(spark.createDataFrame([(r,) for r in rows], "value string"))
    valid = weblog.valid_logs(parsed).collect()
    assert len(valid) == 2
    assert tuple(valid[0][:3]) == ("127.0.0.1", "-", "-") and str(valid[0]["date_time"]) == "1995-08-01 00:00:01"
    assert tuple(valid[0][4:]) == ("GET", "/images/launch-logo.gif", "HTTP/1.0", 200, 1839)
    assert (valid[1]["protocol"], valid[1]["content_size"]) == ("to HTTP/1.0 x", 0)
    assert {r["line"] for r in weblog.rejected_lines(parsed).collect()} == set(rows[2:])
    assert tuple(weblog.parse_report(parsed).first()) == (6, 2, 4)
    assert one(spark, "-", logs.log_size) == 0 and one(spark, "x", logs.log_size) is None


# ---- entity resolution ----------------------------------------------------------------------


def brute_pairs(docs):
    """All record pairs across the sides with their cosine, shared tokens or not."""
    tokens = {k: d[1] for k, d in docs.items()}
    df = Counter(x for words in tokens.values() for x in set(words))
    vectors = {
        k: {w: c / len(words) * len(docs) / df[w] for w, c in Counter(words).items()} for k, words in tokens.items()
    }
    norms = {k: math.sqrt(sum(x * x for x in v.values())) for k, v in vectors.items()}
    out = {}
    for a, b in itertools.product(docs, docs):
        if docs[a][0] == "a" and docs[b][0] == "b":
            dot = sum(vectors[a][w] * vectors[b].get(w, 0) for w in vectors[a])
            out[a, b] = dot / (norms[a] * norms[b]) if norms[a] and norms[b] else 0.0
    return out


@pytest.fixture(scope="module")
def catalogue(spark):
    """Zipf-like words, a third of all records copies of one text, one record without tokens."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    docs = {}
    for i in range(60):
        picked = rng.choices(words, weights, k=rng.randint(2, 12))
        docs[i] = ("a" if rng.random() < 0.5 else "b", ["hot", "copy", "text"] if i % 3 == 0 else picked)
    docs[60] = ("a", [])
    docs[61] = ("b", [])
    rows = [(k, side, tokens, " ".join(tokens)) for k, (side, tokens) in docs.items()]
    records = spark.createDataFrame(rows, "doc_id bigint, side string, tokens array<string>, gold_key string")
    bagged = er.store(er.with_bags(records), "bagged")
    bags = er.store(er.fold_copies(bagged, "doc_id"), "bags")
    return docs, bagged, bags, er.bag_vectors(bagged, bags, "doc_id")


@pytest.mark.parametrize("floor", [0.0, 0.05, 0.3, 0.8])
def test_similar_bags_equal_brute_force(catalogue, floor):
    docs, bagged, _, vectors = catalogue
    bag_of = dict(bagged.select("doc_id", "bag").collect())
    expected = Counter()
    for (a, b), sim in brute_pairs(docs).items():
        shares = set(docs[a][1]) & set(docs[b][1])
        if shares and round(sim, 9) >= floor:
            expected[bytes(bag_of[a]), bytes(bag_of[b])] += 1
    got = er.similar_bags(vectors, floor).collect()
    assert {(bytes(r["left_bag"]), bytes(r["right_bag"])): r["n_pairs"] for r in got} == expected


def test_all_pairs_without_forming_them(catalogue):
    docs, _, bags, vectors = catalogue
    pairs = brute_pairs(docs)
    n_right = sum(side == "b" for side, _ in docs.values())
    for r in er.mean_cosine_per_record(vectors, bags).collect():
        mean = sum(s for (a, _), s in pairs.items() if a == r["left_id"]) / n_right
        assert r["mean_similarity"] == pytest.approx(mean) and r["n_pairs"] == r["n_left"] * n_right


def test_gold_and_sweep(catalogue):
    docs, bagged, bags, vectors = catalogue
    pairs = brute_pairs(docs)
    gold = {(a, b) for a, b in pairs if docs[a][1] == docs[b][1]}
    scores = er.store(er.score_pairs(er.gold_pairs(bagged, F.col("gold_key")), vectors), "gold")
    by_score = Counter()
    for r in scores.collect():
        by_score[round(r["similarity"], 6)] += r["n_gold"]
    assert by_score == Counter(round(pairs[g], 6) for g in gold) and by_score[0.0] > 0
    means = er.average_similarity(vectors, bags, scores).first()
    others = [s for p, s in pairs.items() if p not in gold]
    assert means["avg_duplicates"] == pytest.approx(sum(pairs[g] for g in gold) / len(gold))
    assert means["avg_others"] == pytest.approx(sum(others) / len(others))

    bins = er.store(er.threshold_bins(er.similar_bags(vectors, 0.0099999), scores, er.pair_total(bags)), "bins")
    counted = Counter(int(round(round(s, 9) * 100, 6)) for s in pairs.values())
    assert {r["bin"]: r["candidates"] for r in bins.collect()} == {k: counted[k] for k in range(101)}
    sweep = er.confusion_by_threshold(bins, scores)
    rows = sweep.orderBy("threshold").collect()
    assert len(rows) == 100
    for k, r in enumerate(rows):
        found = sum(int(round(s, 9) * 100 + 1e-7) >= k for s in pairs.values())
        golden = sum(int(round(pairs[g], 9) * 100 + 1e-7) >= k for g in gold)
        assert (r["tp"], r["fp"], r["fn"]) == (golden, found - golden, len(gold) - golden)
    # at threshold 0 every pair counts, whether its records share a token or not
    assert (rows[0]["tp"] + rows[0]["fp"], rows[0]["fn"]) == (len(pairs), 0)
    low = er.join_gold(er.gold_pairs(bagged, F.col("gold_key")), vectors).agg(F.sum("n_gold"), F.min("similarity")).first()
    sharing = [pairs[a, b] for a, b in gold if set(docs[a][1]) & set(docs[b][1])]
    assert (low[0], round(low[1], 9)) == (len(sharing), round(min(sharing), 9))
    rates = er.precision_recall(sweep).where("threshold = 0.5").first()
    assert rates["recall"] == pytest.approx(rows[50]["tp"] / len(gold))


def test_known_copies_move_no_vectors(catalogue, monkeypatch):
    _, bagged, _, vectors = catalogue
    gold = er.store(er.gold_pairs(bagged, F.col("gold_key")), "gold")
    monkeypatch.setattr(er, "_meetings", None)
    scores = er.score_pairs(gold, vectors).collect()
    assert {round(r["similarity"], 9) for r in scores} == {0.0, 1.0} and len(scores) == gold.count()


def test_few_candidates_beside_the_similar_pairs(spark, monkeypatch):
    """Groups of six share a word that weighs little beside commoner ones, which no two sides share; some pairs are similar."""
    rng = random.Random(1)
    rows = []
    for i in range(120):
        side = "ab"[i % 2]
        common = [f"{side}{k}" for k in rng.sample(range(40), 8)] * 5
        rows.append((i, side, [*common, f"group{i // 6}", *[f"pair{i // 2}"] * (3 if i % 6 < 2 else 0)]))
    records = spark.createDataFrame(rows, "doc_id bigint, side string, tokens array<string>")
    bagged = er.store(er.with_bags(records), "bagged")
    bags = er.store(er.fold_copies(bagged, "doc_id"), "bags")
    vectors = er.bag_vectors(bagged, bags, "doc_id")
    stored = {}

    def kept(df, label, store=er.store):
        stored[label] = store(df, label)
        return stored[label]

    monkeypatch.setattr(er, "store", kept)
    found = er.similar_bags(vectors, 0.05).count()
    expected = sum(round(x, 9) >= 0.05 for x in brute_pairs({i: (side, words) for i, side, words in rows}).values())
    assert found == expected > 0
    assert stored["candidates"].count() <= 1.5 * found


def _zipf_bags(spark):
    """Records of many rare words and some that nearly all hold; the sides share a few of them, and some texts come twice."""
    rng = random.Random(7)
    common, rare = [f"c{i}" for i in range(30)], [f"r{i}" for i in range(400)]
    rows = []
    for i in range(150):
        words = rng.choices(common, [1 / (k + 1) for k in range(30)], k=12) + rng.sample(rare, 4) + [f"only{i}"] * (i % 3)
        rows.append((i, "ab"[i % 2], words if i % 10 else ["copy", "of", "c0"]))
    records = spark.createDataFrame(rows + rows[:4], "doc_id bigint, side string, tokens array<string>")
    bagged = er.store(er.with_bags(records), "bagged")
    return rows, bagged, er.store(er.fold_copies(bagged, "doc_id"), "bags")


def _stored(monkeypatch):
    stored = {}

    def kept(df, label, store=er.store, **how):
        stored[label] = store(df, label, **how)
        return stored[label]

    monkeypatch.setattr(er, "store", kept)
    return stored


@pytest.mark.parametrize("hot", [0, 8, 50_000])
def test_vectors_with_rare_and_common_tokens(spark, monkeypatch, hot):
    rows, bagged, bags = _zipf_bags(spark)
    monkeypatch.setattr(er, "_HOT", hot)
    stored = _stored(monkeypatch)
    got = er.bag_vectors(bagged, bags, "doc_id").collect()
    # no table of counts by bag and token is written to be spread anew
    assert "bag-tokens" not in stored
    tokens = [words for _, _, words in rows + rows[:4]]
    df = Counter(x for words in tokens for x in set(words))
    want = {}
    for words in {tuple(sorted(words)): words for words in tokens}.values():
        raw = {x: c / len(words) * len(tokens) / df[x] for x, c in Counter(words).items()}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        so_far = 0.0
        for x in sorted(raw, key=lambda x: (-df[x], x)):
            so_far += (raw[x] / norm) ** 2
            want[" ".join(sorted(words)), x] = (raw[x] / norm, df[x], so_far)
    text_of = {bytes(r["bag"]): " ".join(sorted(r["tokens"])) for r in bagged.collect()}
    found = {(text_of[bytes(r["bag"])], r["token"]): (r["weight"], r["df"], r["common_sq"]) for r in got}
    assert len(got) == len(found) and found.keys() == want.keys()
    for k, (weight, n, common_sq) in found.items():
        assert (weight, n) == (pytest.approx(want[k][0]), want[k][1]) and common_sq == pytest.approx(want[k][2], abs=1e-6)
    assert len({r["name"] for r in got}) == len({r["bag"] for r in got}) == len({(r["name"], r["bag"]) for r in got})


@pytest.mark.parametrize("hot,levelled", [(0, 0), (8, 0), (50_000, 0), (50_000, 100)])
def test_bins_without_the_score_of_every_pair(spark, monkeypatch, hot, levelled):
    """Pairs whose bounds lie in one bin are not scored, and the bins are those of brute force."""
    rows, bagged, bags = _zipf_bags(spark)
    monkeypatch.setattr(er, "_HOT", hot)
    monkeypatch.setattr(er, "_LEVELLED", levelled)
    vectors = er.bag_vectors(bagged, bags, "doc_id")
    stored = _stored(monkeypatch)
    bins = er.pairs_per_bin(er.similar_bags(vectors, 0.0099999, alike=numbers.score_bin), er.pair_total(bags)).collect()
    docs = {k: (side, words) for k, (_, side, words) in enumerate(rows + rows[:4])}
    counted = Counter(int(round(round(x, 9) * 100, 6)) for x in brute_pairs(docs).values())
    assert {r["bin"]: r["n"] for r in bins} == {k: counted[k] for k in range(101)}
    assert 0 < stored["asked"].count() < 0.7 * stored["candidates"].count()


def test_postings_that_meet_nothing_long_enough_do_not_move(spark, monkeypatch):
    rows, bagged, bags = _zipf_bags(spark)
    vectors = er.bag_vectors(bagged, bags, "doc_id")
    index = er._index_prefix(vectors, 0.05).withColumn("reach", F.sqrt("common_sq"))
    kept = er._within_reach(index, vectors, 0.05).collect()
    everything = index.collect()
    far = {}
    for r in everything:
        for side in ("n_left", "n_right"):
            if r[side]:
                far[side, r["token"]] = max(far.get((side, r["token"]), 0), r["reach"])
    want = {
        (r["name"], r["token"]) for r in everything for side, other in (("n_left", "n_right"), ("n_right", "n_left"))
        if r[side] and r["reach"] * far.get((other, r["token"]), 0) >= 0.05 * (1 - 1e-6)
    }
    assert {(r["name"], r["token"]) for r in kept} == want and len(want) < len(everything)


def test_tf_idf_norm_and_dot(spark):
    docs = spark.createDataFrame([(1, "one_ one_ two!"), (2, "two")], "id int, text string")
    records = record_tokens(docs)
    assert {(r["id"], r["token"]): r["tf"] for r in er.tf(records, "id").collect()} == {
        (1, "one_"): pytest.approx(2 / 3), (1, "two"): pytest.approx(1 / 3), (2, "two"): 1.0,
    }
    assert dict(er.idf(records).collect()) == {"one_": 2.0, "two": 1.0}
    schema = "id int, token string, weight double"
    a = spark.createDataFrame([(1, "foo", 3.0), (1, "bar", 5.0)], schema)
    b = spark.createDataFrame([(1, "foo", 4.0), (1, "bar", 18.0), (1, "no", 1.0)], schema)
    assert er.dot_product(a, b).first()["dot"] == 102.0
    assert er.vector_norm(a, "id").first()["norm"] == pytest.approx(math.sqrt(34))


# ---- spelling and language ------------------------------------------------------------------


def test_spell_correct_equals_brute_force(spark):
    rng = random.Random(2)
    known = {"".join(rng.choices("abcd", k=rng.randint(1, 5))): rng.randint(2, 9) for _ in range(40)}
    asked = {"".join(rng.choices("abcde", k=rng.randint(1, 7))) for _ in range(60)} | {"zzzzzzzz", "ba", next(iter(known))}

    def correct(word):
        for tier in range(3):
            if found := [w for w in known if distance(word, w) <= tier]:
                return min(found, key=lambda w: (-known[w], w)), tier
        return word, -1

    vocabulary = spark.createDataFrame(list(known.items()), "word string, freq bigint")
    got = sp.spell_correct(spark.createDataFrame([(w,) for w in asked], "word string"), vocabulary).collect()
    assert {r["word"]: (r["correction"], r["edits"]) for r in got} == {w: correct(w) for w in asked}
    assert {r["edits"] for r in got} == {0, 1, 2, -1}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text("abc", min_size=2, max_size=6), min_size=1, max_size=12))
def test_two_edit_candidates_miss_none(spark, words):
    vocabulary = spark.createDataFrame([(w, 1) for w in {"abcab", *words}], "word string, freq bigint")
    asked = spark.createDataFrame([("acbba",)], "word string")
    reach = {w for w in {"abcab", *words} if distance("acbba", w) <= 2}
    near = sp._near(asked, vocabulary, 2).where(sp._two_edits() | sp._one_edit()).select("candidate").collect()
    assert {r[0] for r in near} - {"acbba"} == reach - {"acbba"}


def test_long_words_are_met_by_pieces(spark):
    rng = random.Random(8)
    pairs = []
    for n in (18, 19, 20, 21, 22, 23, 40, 400):
        for _ in range(12):
            known = "".join(rng.choices("ab", k=n))
            wrong = known
            for _ in range(2):
                i, kind = rng.randrange(len(wrong) - 1), rng.randrange(4)
                wrong = (
                    wrong[:i] + wrong[i + 1 :] if kind == 0
                    else wrong[:i] + wrong[i + 1] + wrong[i] + wrong[i + 2 :] if kind == 1
                    else wrong[:i] + "c" + wrong[i + 1 :] if kind == 2
                    else wrong[:i] + "c" + wrong[i:]
                )
            pairs.append((known, wrong))
    vocabulary = spark.createDataFrame([(k, 2) for k in {k for k, _ in pairs}], "word string, freq bigint")
    asked = spark.createDataFrame([(w,) for w in {w for _, w in pairs}], "word string")
    near = sp._near(asked, vocabulary, 2)
    found = {
        (r["candidate"], r["word"])
        for r in near.where((F.col("word") == F.col("candidate")) | sp._one_edit() | sp._two_edits()).collect()
    }
    assert set(pairs) <= found


def test_spelling_keys_are_not_broadcast(spark):
    """Stored words look small to the planner; their keys, some hundreds a word, are not."""
    words = er.store(spark.createDataFrame([("speling",), ("wrds",)], "word string"), "words")
    vocabulary = er.store(spark.createDataFrame([("spelling", 3), ("words", 2)], "word string, freq bigint"), "vocabulary")
    for depth in (1, 2):
        plan = sp._near(words, vocabulary, depth)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_spell_report(spark):
    vocabulary = spark.createDataFrame([("access", 5), ("forbidden", 3)], "word string, freq bigint")
    tests = spark.createDataFrame(
        [("access", "acess"), ("forbidden", "forbiden"), ("missing", "mising")], "target string, wrong string"
    )
    fixed = sp.spell_correct(tests.select(F.col("wrong").alias("word")), vocabulary)
    got = sp.spell_report(tests, fixed, vocabulary).first()
    assert tuple(got)[:5] == (3, 1, 1, 2, 1) and got["percent_right"] == pytest.approx(200 / 3)


def test_sentiment(spark):
    train = spark.createDataFrame([("good fine good", 1), ("bad poor", 0)], "text string, y int")
    model = SentimentModel.train(train, "y")
    asked = spark.createDataFrame([(1, "good"), (2, "bad bad"), (3, "")], "id int, s string")
    got = {r["id"]: (r["margin"], r["label"]) for r in model.score(asked, ["id"], "s").collect()}
    share = math.log(6 / 7)  # negative over positive tokens, each plus the vocabulary's four words
    assert got[1] == (pytest.approx(math.log(3) + share, abs=1e-6), "POS")
    assert got[2] == (pytest.approx(2 * (math.log(1 / 2) + share), abs=1e-6), "NEG")
    assert got[3] == (0.0, "POS")


def test_summary(spark):
    docs = spark.createDataFrame([(1, "Cats sleep. Dogs run. Cats and dogs play. Fish.")], "id int, text string")
    got = extractive_summary(docs, "id", n=2).orderBy(F.desc("score")).collect()
    assert [(r["pos"], r["score"]) for r in got] == [(2, 5), (0, 3)]


# ---- metrics and models ---------------------------------------------------------------------


def test_metrics_against_numpy(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 300)
    score = np.round(np.clip(0.3 * y + 0.7 * rng.random(300), 0, 1), 2)
    name = np.where(np.arange(300) % 3 == 0, "s", "t")
    rows = [(str(n), int(a), float(s), int(s >= 0.5)) for n, a, s in zip(name, y, score)]
    df = spark.createDataFrame(rows, "dataset string, y int, score double, p int").repartition(5)

    def rank_auc(yy, ss):
        pos, neg = ss[yy == 1], ss[yy == 0]
        return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))

    assert mx.roc_auc(df).first()["auc"] == pytest.approx(rank_auc(y, score))
    report = {r["dataset"]: r for r in mx.metrics_report(df).collect()}
    for n in "st":
        assert report[n]["auc"] == pytest.approx(rank_auc(y[name == n], score[name == n]))
        assert report[n]["accuracy"] == pytest.approx(100 * np.mean(y[name == n] == (score[name == n] >= 0.5)))
    bins = np.digitize(score, np.arange(11) / 10)
    cal = sum((bins == b).sum() * (score[bins == b].mean() - y[bins == b].mean()) ** 2 for b in set(bins)) / 300
    dis = sum((bins == b).sum() * (y[bins == b].mean() - y.mean()) ** 2 for b in set(bins)) / 300
    assert mx.calibration(df).first()[0] == pytest.approx(cal)
    assert mx.discrimination(df).first()[0] == pytest.approx(dis)
    curve = mx.roc_curve(df).orderBy(F.desc("score")).collect()
    assert (curve[-1]["tpr"], curve[-1]["fpr"]) == (1.0, 1.0)


@pytest.mark.parametrize("block", [4, 1024])
def test_knn_equals_brute_force_with_a_hot_group(spark, block):
    rng = np.random.default_rng(5)
    vec = rng.normal(size=(90, 3)).round(2)
    vec[::3] = [0.5, 0.5, 0.5]  # a third of all rows are one vector
    label, fold = rng.integers(0, 3, 90), rng.integers(0, 5, 90)
    rows = [(i, [float(x) for x in vec[i]], int(label[i]), int(fold[i])) for i in range(90)]
    points = spark.createDataFrame(rows, "id bigint, vec array<double>, label int, fold int")
    got = {r["id"]: r["predicted"] for r in knn_classify(points, k=5, n_pivots=6, block=block).collect()}
    for i in range(90):
        near = sorted((round(float(np.linalg.norm(vec[i] - vec[j])), 9), j) for j in range(90) if fold[j] != fold[i])[:5]
        votes = Counter(int(label[j]) for _, j in near)
        assert got[i] == min(votes, key=lambda c: (-votes[c], c))


@pytest.mark.parametrize("sample", [1, 7, 40, 500])
def test_fitted_knn_equals_brute_force_on_the_same_draw(spark, sample):
    rng = np.random.default_rng(5)
    vec = rng.normal(size=(90, 3)).round(2)
    vec[::3] = [0.5, 0.5, 0.5]  # a third of all rows are one vector
    label, fold = rng.integers(0, 3, 90), rng.integers(0, 5, 90)
    rows = [(i, [float(x) for x in vec[i]], int(label[i]), int(fold[i])) for i in range(90)]
    points = spark.createDataFrame(rows, "id bigint, vec array<double>, label int, fold int").repartition(3)
    drawn = sorted(range(90), key=lambda i: (hashlib.md5(f"0:{i}".encode()).hexdigest()[:8], i))[:sample]
    got = {r["id"]: r["predicted"] for r in knn_fitted(points, k=5, sample=sample).collect()}
    for i in range(90):
        near = sorted((round(float(np.linalg.norm(vec[i] - vec[j])), 9), j) for j in drawn if fold[j] != fold[i])[:5]
        votes = Counter(int(label[j]) for _, j in near)
        assert got[i] == min(votes, key=lambda c: (-votes[c], c), default=None)
    assert knn_fitted(points.limit(0), sample=sample).collect() == []


def test_standardise(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "a double, b double")
    assert sorted(tuple(r) for r in ft.standardise(df, ["a", "b"]).collect()) == [(-1.0, 0.0), (1.0, 0.0)]


def test_folds_ignore_partitioning(spark):
    folds = [dict(ft.kfold_assign(spark.range(50).repartition(n), "id").collect()) for n in (1, 7)]
    assert folds[0] == folds[1] and set(folds[0].values()) == set(range(5))


def test_network_learns(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(a), float(b), int(a > b)) for i, (a, b) in enumerate(rng.random((200, 2)))]
    table = ml.assemble(spark.createDataFrame(rows, "id int, a double, b double, label int"), ["a", "b"])
    got = ml.cv_predict(ft.kfold_assign(table, "id"), ml.mlp([2, 5, 2]), ["id"])
    assert mx.accuracy(got, "label", "prediction").first()[0] > 90


# ---- sequences ------------------------------------------------------------------------------


def test_encode_sequences(spark):
    records = spark.createDataFrame([(1, ["b", "a", "x", "a"]), (2, [])], "id int, tokens array<string>")
    vocabulary = sq.build_vocabulary(records.select(F.explode("tokens").alias("word")), 1)
    ids = dict(vocabulary.select("word", "ix").collect())
    assert ids == {"a": 1, "b": 2, "x": 3}
    kept = vocabulary.where("word != 'x'")
    assert dict(sq.encode_sequences(records, kept, "id").collect()) == {1: [2, 1, 0, 1], 2: []}


def test_next_step_pairs(spark):
    chunks = spark.createDataFrame([(1, list("aba")), (2, ["z"])], "chunk int, symbols array<string>")
    got = sq.next_step_pairs(chunks, ["chunk"], "symbols").orderBy("pos").collect()
    assert [(r["symbol"], r["next"]) for r in got] == [("a", "b"), ("b", "a")]


@pytest.fixture(scope="module")
def topics(spark):
    """Texts of one of four topics, each with ten words of its own beside common ones; one word is in half of it all."""
    rng = random.Random(6)
    rows = []
    for i in range(1500):
        own = [f"t{i % 4}w{k}" for k in range(10)]
        rows.append((i, [rng.choice(own) if rng.random() < 0.4 else rng.choice(["the"] * 5 + ["of", "and", "is"]) for _ in range(30)]))
    rows += [(2000, []), (2001, ["unheard"])]
    records = spark.createDataFrame(rows, "id int, tokens array<string>").repartition(4, "id")
    return records, sq.build_vocabulary(records.select(F.explode("tokens").alias("word")), 5)


@pytest.mark.parametrize("block_words", [4096, 22])
def test_vectors_tell_topics_apart(topics, block_words):
    records, vocabulary = topics
    rows = embedding.train_vectors(records, vocabulary, "id", size=24, window=5, passes=6, block_words=block_words).collect()
    vectors = {r["word"]: np.array(r["vec"]) / np.linalg.norm(r["vec"]) for r in rows}
    assert len(vectors) == 44 and all(len(v) == 24 for v in vectors.values())
    named = sorted(w for w in vectors if w[0] == "t" and w != "the")
    like = {(a, b): vectors[a] @ vectors[b] for a, b in itertools.combinations(named, 2)}
    same, other = ([s for (a, b), s in like.items() if (a[:2] == b[:2]) is x] for x in (True, False))
    # a pair of one topic is nearer than a pair of two, nearly always
    assert np.mean([s > o for s in same for o in other]) > 0.95


@pytest.mark.parametrize("n_rows", [1, 3, 40, 2000])
def test_changes_are_summed_to_the_last_bit(n_rows):
    rng = np.random.default_rng(n_rows)
    rows = rng.integers(0, n_rows, 576).astype(np.int32)
    change = rng.normal(size=(576, 30)).astype(np.float32)
    order = np.argsort(rows, kind="stable")
    distinct, starts = np.unique(rows[order], return_index=True)
    expected = np.add.reduceat(change[order], starts, axis=0)
    got, summed = embedding._summed(rows, change)
    back = np.argsort(got)
    assert np.array_equal(got[back], distinct) and np.array_equal(summed[back], expected)


def test_blocks_stay_few_until_memory_asks_for_more():
    assert embedding.blocks_of(12_855, 18_374_616, 16_384, 120_000) == 13
    assert embedding.blocks_of(74_941, 158_526_232, 16_384, 120_000) == 24
    assert embedding.blocks_of(1_000_000, 158_526_232, 16_384, 120_000) == 62
    assert embedding.blocks_of(74_941, 10**10, 16_384, 120_000) == 52
    assert embedding.blocks_of(5, 10**10, 16_384, 120_000) == 5 and embedding.blocks_of(0, 0, 16_384, 120_000) == 1


def test_a_round_reads_its_own_pairs_alone(topics, monkeypatch):
    records, vocabulary = topics
    made = {}
    monkeypatch.setattr(embedding, "new_folder", lambda spark, label, new=embedding.new_folder: made.setdefault(label, new(spark, label)))
    embedding.train_vectors(records, vocabulary, "id", size=4, passes=1, block_words=22)
    spark = records.sparkSession
    stored = spark.read.parquet(made["word-pairs"])
    turns = stored.select("turn", ((F.col("o") - F.col("i") + 2) % 2).alias("own")).distinct().collect()
    assert sorted((r["turn"], r["own"]) for r in turns) == [(0, 0), (1, 1)]
    assert all("/turn=" in path for path in stored.inputFiles())


def test_vectors_without_pairs_and_words(spark):
    records = spark.createDataFrame([(1, ["a"]), (2, ["a"]), (3, [])], "id int, tokens array<string>")
    vocabulary = sq.build_vocabulary(records.select(F.explode("tokens").alias("word")), 1)
    got = embedding.train_vectors(records, vocabulary, "id", size=3, passes=2).collect()
    assert [(r["word"], len(r["vec"])) for r in got] == [("a", 3)]
    assert embedding.train_vectors(records, vocabulary.limit(0), "id", size=3, passes=1).collect() == []


def test_window_pairs_equal_brute_force():
    rng = np.random.default_rng(2)
    ids, record, reach = rng.integers(0, 9, 60), np.sort(rng.integers(0, 5, 60)), rng.integers(1, 4, 60)
    want = Counter(
        (ids[i], ids[j]) for i in range(60) for j in range(60)
        if i != j and record[i] == record[j] and abs(i - j) <= reach[i]
    )
    left, right = embedding.window_pairs(ids, record, reach)
    assert Counter(zip(left.tolist(), right.tolist(), strict=True)) == want
    parts = [embedding.window_pairs(ids[k : k + 23], record[k : k + 23], reach[k : k + 23], 20) for k in range(0, 60, 20)]
    assert sum((Counter(zip(a.tolist(), b.tolist(), strict=True)) for a, b in parts), Counter()) == want


def question_text(context, answer="@entity1"):
    lines = ["url", "", context, "", "who @placeholder said", "", answer, "", "@entity1:Ann", "@entity2:Bob Ray", ""]
    return "\n".join(lines)


def test_questions_one_per_file(spark, tmp_path):
    (tmp_path / "q1").write_text(question_text("@entity1 met @entity2 today"))
    (tmp_path / "q2").write_text(question_text("@entity9 met @entity1"))
    read = files.question_files(spark, str(tmp_path)).withColumn("id", F.substring("context", 8, 1).cast("int"))
    assert [r["candidates"] for r in read.collect()] == [["@entity1", "@entity2"]] * 2
    words = spark.createDataFrame([("met", 1), ("who", 2)], "word string, rank int")
    vocabulary = sq.entity_vocabulary(words, 5, separator=True)
    ids = dict(vocabulary.collect())
    assert ids == {**{f"@entity{i}": i + 1 for i in range(5)}, "met": 6, "who": 7, "<UNK>": 8, "@placeholder": 9, "<SEP>": 10}
    encoded = {r["id"]: r for r in sq.encode_questions(read, vocabulary, "id", 5).collect()}
    first = encoded[1]
    assert first["context"] == [first["candidates"][0], 6, first["candidates"][1], 8]
    assert first["question"] == [7, 9, 8] and first["answer"] == first["candidates"][0] < 5
    assert encoded[9]["context"][0] == -1
    checks = sq.encoding_checks(sq.encode_questions(read, vocabulary, "id", 5), 5, 11).first()
    assert tuple(checks) == (2, 0, 1, 0, 0, 0, 0)
    with pytest.raises(Exception, match="invalid entity"):
        sq.strict(sq.encode_questions(read, vocabulary, "id", 5), 5).collect()


def test_faulty_questions_are_counted_and_none_is_lost(spark):
    listed = ["@entity1", "@entity2", "other"]
    rows = [
        (1, "ok", "@entity1 met @entity2", "who", "@entity2", listed), (2, "ok", "@entity7 met", "who", "@entity2", listed),
        (3, "ok", "met", "@entity7", "@entity1", listed), (4, "ok", "met", "who", "@entity7", listed), (5, "ok", "", "", "who", []),
        (6, "short", None, None, None, None), (7, "ok", "other met", "who", "other", [f"@entity{i}" for i in range(9)] + ["other"]),
        (8, "ok", "met", "who", "@entity1", ["@entity1", "@entity1"]),
    ]
    questions = spark.createDataFrame(rows, "id int, status string, context string, question string, answer string, candidates array<string>")
    words = spark.createDataFrame([("met", 1), ("who", 2)], "word string, rank int")
    vocabulary = store(sq.entity_vocabulary(words, 5), "vocabulary")
    coded = store(sq.encode_questions(questions, vocabulary, "id", 5), "coded")
    found = {r["id"]: r for r in coded.collect()}
    assert found.keys() == set(range(1, 9)) and found[6]["context"] is None and found[6]["status"] == "short"
    assert found[5]["context"] == [8] and found[5]["candidates"] == []
    assert len(set(found[1]["candidates"])) == 3 and found[1]["context"] == [found[1]["candidates"][0], 6, found[1]["candidates"][1]]
    # more candidates than entities: every id is used, twice
    assert sorted(found[7]["candidates"]) == sorted([0, 1, 2, 3, 4] * 2) and found[7]["context"] == [found[7]["candidates"][-1], 6]
    # 5 has a word for an answer, whose id is no entity; 8 lists a candidate twice
    assert tuple(sq.encoding_checks(coded, 5, 100).first()) == (8, 1, 2, 0, 0, 2, 2)
    assert sq.encoding_checks(coded, 5, 8).first()["id_out_of_range"] == 1
    plan = sq.encode_questions(questions, vocabulary, "id", 5)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1


def test_no_word_of_a_question_goes_through_all_its_candidates(spark):
    rows = [(1, "ok", "a b", "a", "b", ["a", "b"]), (1, "ok", "a b", "a", "b", ["b"])]
    questions = spark.createDataFrame(rows, "id int, status string, context string, question string, answer string, candidates array<string>")
    vocabulary = store(sq.entity_vocabulary(spark.createDataFrame([("a", 1)], "word string, rank int"), 5), "vocabulary")
    encoded = sq.encode_questions(questions, vocabulary, "id", 5)
    assert "element_at" not in encoded._jdf.queryExecution().optimizedPlan().toString()
    # a candidate of one record is none of another with the same key
    words = dict(vocabulary.collect())
    codes = Counter(x for r in encoded.collect() for x in r["context"])
    assert sum(codes.values()) == 4 and codes[words["a"]] == 1


# ---- streams --------------------------------------------------------------------------------


def stream_files(spark, tmp_path, n):
    for i in range(n):
        spark.createDataFrame([(10 * i + k, f"The row {k}" if k % 3 else "no match") for k in range(10)], "id int, text string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))


@pytest.mark.parametrize("scored", [False, True])
def test_a_stream_stopped_between_batches_loses_and_repeats_nothing(spark, tmp_path, scored):
    model = SentimentModel.train(spark.createDataFrame([("row good", 1), ("bad", 0)], "text string, y int"), "y")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def start(seconds):
        stream = streams.text_stream(spark, str(tmp_path / "in"), "id int, text string", files_per_batch=1)
        kept = streams.keyword_stream(stream, "the")
        if scored:
            return streams.stream_sentiment(kept, model, ["id"], out, checkpoint, seconds=seconds)
        return streams.write_stream(kept, out, checkpoint, seconds)

    stream_files(spark, tmp_path, 6)
    last = streams.stopped_after(start(0), 2)
    done = spark.read.parquet(out).count()
    assert 1 <= last < 5 and 12 <= done < 36
    stream_files(spark, tmp_path, 0)
    assert streams.stopped_after(start(0), 1) > last
    streams.drained(start(None))
    spark.createDataFrame([(99, "the last")], "id int, text string").write.mode("append").parquet(str(tmp_path / "in"))
    streams.drained(start(None))
    got = [r["id"] for r in spark.read.parquet(out).collect()]
    assert sorted(got) == sorted([10 * i + k for i in range(6) for k in range(10) if k % 3] + [99])


# ---- relations and sources ------------------------------------------------------------------


def test_people_joins(spark):
    ages = files.inferred_rows(spark, [{"name": n, "age": a} for n, a in (("John", 19), ("Smith", 23), ("Sarah", 18))])
    spends = files.inline_rows(
        spark, [("John", "England", 120), ("Jenny", "Spain", 45), ("Sarah", "Japan", 55)],
        "who string, country string, spend int", 2,
    )
    got = {how: {tuple(r) for r in rel.joined(ages, spends, "name", "who", how).select("name", "spend").collect()}
           for how in ("inner", "left", "right", "full")}
    inner = {("John", 120), ("Sarah", 55)}
    assert got["inner"] == inner and got["left"] == inner | {("Smith", None)}
    assert got["right"] == inner | {(None, 45)} and got["full"] == inner | {("Smith", None), (None, 45)}
    assert {r["name"] for r in ages.where("age <= 20").collect()} == {"John", "Sarah"}
    assert rel.key_lookup(spends, who="Jenny", country="Spain").first()["spend"] == 45


def test_apply_schema_stops_at_a_null(spark):
    schema = StructType([StructField("k", LongType(), False), StructField("s", StringType(), True)])
    assert files.apply_schema(spark.sql("select '1' as k, null as s"), schema).first() == (1, None)
    with pytest.raises(Exception, match="null in non-null column k"):
        files.apply_schema(spark.sql("select cast(null as bigint) as k, 'x' as s"), schema).collect()


def test_materialise_or_load_computes_once(spark):
    path, calls = new_folder(spark, "once"), []

    def compute():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        assert files.materialise_or_load(spark, path, compute).count() == 3
    assert len(calls) == 1


FIELD_LINES = {
    '"a","b"': ["a", "b"], 'a,b': ["a", "b"], '"a, b","c""d"': ["a, b", 'c"d'], '""': [""], '': [""], ',,': ["", "", ""], '"",x,""': ["", "x", ""],
    '"a","b': None, 'a"b,c': None, '"a"b,c': None, '"a" ,b': None, '"""",1': ['"', "1"], '"' + "x" * 100_000 + '","' + '""' * 50_000 + '"': ["x" * 100_000, '"' * 50_000],
    '"' + "," * 100_000: None,
}


def test_quoted_fields_equal_the_csv_module(spark):
    lines = spark.createDataFrame([(x,) for x in FIELD_LINES], "value string")
    got = dict(lines.select("value", files.quoted_fields(F.col("value"))).collect())
    assert got == FIELD_LINES
    for line, fields in FIELD_LINES.items():
        if fields is not None and line and max(map(len, fields)) < 100:
            assert next(csv.reader([line])) == fields


def test_gold_lines(spark):
    lines = ['"idLeft","idRight"', '"b1","http://x/1"', "b2,http://x/2", '"b,3","say ""x"""', '"b4"', '"b5","c","d"', "", '"b6","c', '"","c"', None]
    parsed = files.gold_status(spark.createDataFrame([(x,) for x in lines], "value string"))
    got = [(r["status"], r["left_id"], r["right_id"]) for r in parsed.collect()]
    assert got == [(0, None, None), (1, "b1", "http://x/1"), (1, "b2", "http://x/2"), (1, "b,3", "say x"), *[(-1, None, None)] * 6]
    assert [r["value"] for r in files.rejects(parsed, 3).collect()] == [None, "", '"","c"']


def test_failure_report(spark):
    lines = [f"bad {i:03}" for i in range(50)] * 2 + ['h - - [01/Aug/1995:00:00:01 -0400] "GET /x HTTP/1.0" 200 5'] * 7 + [None, "Ä", "z"]
    parsed = weblog.parse_access_log(spark.createDataFrame([(x,) for x in lines], "value string").repartition(5))
    for n in (1, 20, 500):
        got = weblog.failure_report(parsed, n).orderBy("status", "place").collect()
        bad = sorted((x or "" for x in lines if x is None or not x.startswith("h -")), key=str.encode)[:n]
        assert [tuple(r) for r in got] == [("failed", 103, i, x) for i, x in enumerate(bad, 1)] + [("parsed", 7, None, None)]
    assert {tuple(r)[:2] for r in weblog.failure_report(parsed.limit(0)).collect()} <= {("failed", 0), ("parsed", 0)}


def test_limit_vocabulary(spark):
    counts = {f"w{i}": 1 + i % 7 for i in range(60)}
    words = spark.createDataFrame([(w,) for w, n in counts.items() for _ in range(n)], "word string")
    ranked = sorted(counts.items(), key=lambda x: (-x[1], x[0]))
    for size in (0, 1, 8, 9, 30, 60, 99):
        assert sorted(map(tuple, sq.limit_vocabulary(words, size).collect())) == sorted(ranked[:size])


def test_confusion_matrix_counts_other_labels(spark):
    rows = [(0, 0), (0, 1), (1, 1), (7, 1), (1, None), (None, None), (9, 3)]
    got = mx.confusion_matrix(spark.createDataFrame(rows, "y int, p int"), [0, 1])
    cells = {(r["y"], r["p"]): r["n"] for r in got.collect()}
    assert cells == {(0, 0): 1, (0, 1): 1, (0, -1): 0, (1, 0): 0, (1, 1): 1, (1, -1): 1, (-1, 0): 0, (-1, 1): 1, (-1, -1): 2}


def test_column_sketches_are_close_and_merge(spark):
    df = spark.range(60_000).select(F.col("id"), (F.col("id") % 3000).alias("few"), F.lit(None).cast("string").alias("none"), F.array("id").alias("list"))
    exact = {r["ordinal"]: r["n_distinct"] for r in agg.distinct_values(df, "t").collect()}
    assert exact == {1: 60_000, 2: 3000, 3: 0, 4: 60_000}
    halves = [agg.column_sketches(df.where(f"id % 2 = {i}"), "t") for i in (0, 1)]
    merged = halves[0].unionByName(halves[1]).groupBy("ordinal").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n"), F.sum("n_filled").alias("f"))
    for r in merged.collect():
        assert abs(r["n"] - exact[r["ordinal"]]) <= 4 * 0.016 * exact[r["ordinal"]] and r["f"] == (0 if r["ordinal"] == 3 else 60_000)


def test_product_lines(spark):
    lines = ['"id","name","description","manufacturer","price"', '"b1","nice ""pen""","red","acme",5', "broken line"]
    got = files.product_status(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [r["status"] for r in got] == [0, 1, -1]
    assert got[1]["id"] == "b1" and got[1]["text"] == "nice pen red acme"


def test_tagged_files(spark, tmp_path):
    for name, lines in (("train-pos.txt", "good\nfine"), ("test-neg.txt", "bad")):
        (tmp_path / name).write_text(lines)
    got = files.tagged_multi_file(spark, [str(tmp_path / "train-pos.txt"), str(tmp_path / "test-neg.txt")])
    assert {tuple(r) for r in got.collect()} == {("good", "train", 1), ("fine", "train", 1), ("bad", "test", 0)}


def test_file_inventory_counts_folders(spark, tmp_path):
    (tmp_path / "x" / "y").mkdir(parents=True)
    (tmp_path / "x" / "one").write_text("123")
    (tmp_path / "x" / "y" / "two").write_text("45")
    assert tuple(file_inventory(list_files(spark, str(tmp_path))).first()) == (5, 2, 2)


class FakeSession:
    """What ``scratch_dir`` reads of a session; the real setting is fixed when a context starts."""

    def __init__(self, settings, master):
        self.conf = settings
        self.sparkContext = self
        self.master = master

    def getCheckpointDir(self):
        return None


def test_scratch_folder_follows_the_session():
    named = {"spark.checkpoint.dir": "hdfs://shared/scratch/"}
    assert scratch_dir(FakeSession(named, "yarn")) == "hdfs://shared/scratch"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(FakeSession({}, "yarn"))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _bagged(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(12)], k=rng.randint(1, 9))) for _ in range(60)]
    rows = [(i, "ab"[i % 2], f"g{hash(t) if i % 5 else i}", t.split()) for i, t in enumerate(texts + texts[:10] + ["", ""])]
    return er.store(er.with_bags(spark.createDataFrame(rows, "doc_id bigint, side string, gold_key string, tokens array<string>")), "bagged"), rows


def test_common_tokens_forms_no_row_per_pair_and_token(spark, monkeypatch):
    bagged, _ = _bagged(spark)
    bags = er.store(er.fold_copies(bagged, "doc_id"), "bags")
    vectors = er.bag_vectors(bagged, bags, "doc_id")
    held = {r["bag"]: set(r["tokens"]) for r in bagged.collect()}
    left, right = ([r["bag"] for r in bags.where(f"{n} > 0").collect()] for n in ("n_left", "n_right"))
    pairs = spark.createDataFrame([(a, b) for a in left for b in right], "left_bag binary, right_bag binary")
    monkeypatch.setattr(er, "_meetings", None)
    got = [(bytes(r[0]), bytes(r[1]), r[2]) for r in er.common_tokens(store(pairs, "pairs"), vectors).select("left_bag", "right_bag", "shared").collect()]
    want = [(bytes(a), bytes(b), sorted(held[a] & held[b])) for a in left for b in right if held[a] & held[b]]
    assert sorted(got) == sorted(want)


def test_vectors_of_wanted_bags_are_those_of_all(spark):
    bagged, _ = _bagged(spark)
    bags = er.store(er.fold_copies(bagged, "doc_id"), "bags")
    wanted = bags.where("n_left > 0 and n_right > 0").select("bag")
    every = {(bytes(r["bag"]), r["token"]): r for r in er.bag_vectors(bagged, bags, "doc_id").collect()}
    few = er.bag_vectors(bagged, bags, "doc_id", wanted=wanted.union(wanted)).collect()
    names = {bytes(r["bag"]) for r in wanted.collect()}
    assert {(bytes(r["bag"]), r["token"]) for r in few} == {k for k in every if k[0] in names}
    for r in few:
        other = every[bytes(r["bag"]), r["token"]]
        assert (r["df"], r["n_left"], r["n_right"]) == (other["df"], other["n_left"], other["n_right"])
        assert r["weight"] == pytest.approx(other["weight"]) and r["common_sq"] == pytest.approx(other["common_sq"], abs=1e-6)


def test_nearest_rows_by_one_product():
    rng = np.random.default_rng(8)
    x, q = rng.normal(size=(300, 4)).round(1), rng.normal(size=(40, 4)).round(1)
    x[::4], q[0], ids = x[0], x[0], rng.permutation(300)
    for x_now, k in ((x, 5), (x[:3], 5), (np.where(np.arange(300)[:, None] % 2, np.nan, x), 5), (np.full((9, 4), np.nan), 4)):
        own = ids[: len(x_now)]
        which, rows, d = neighbours._nearest(q, x_now, own, k)
        for i, row in enumerate(q):
            far = np.round(np.sqrt(((x_now - row) ** 2).sum(axis=1)), 9)
            best = np.lexsort((own, far))[:k]
            assert rows[which == i].tolist() == best.tolist() and np.array_equal(d[which == i], far[best], equal_nan=True)


def test_sentiment_is_the_same_with_rare_and_frequent_weights(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choices("abcdefgh", range(1, 9), k=rng.randint(0, 12))), i % 2) for i in range(60)]
    model = SentimentModel.train(spark.createDataFrame(rows, "id int, s string, y int"), "y", "s")
    asked = spark.createDataFrame([*[(i, s) for i, s, _ in rows], (None, "a zz"), (60, "zz zz h"), (61, None)], "id int, s string")
    whole = sorted(map(str, model.score(asked, ["id"], "s").collect()))
    assert len(whole) == 63
    for most in (1, 5, 1e-9):
        monkeypatch.setattr(language, "_HOT", most)
        found = model.score(asked, ["id"], "s")
        assert sorted(map(str, found.collect())) == whole
    assert "LeftAnti" in _plan(found)


def test_summary_partitions_grow_in_number(spark, monkeypatch):
    monkeypatch.setattr(language, "_DOCS", 3)
    docs = spark.createDataFrame([(i % 50, f"Cats sleep {i}. Dogs run.") for i in range(60)], "id int, text string")
    found = extractive_summary(docs, "id", n=1)
    assert re.search(r"hashpartitioning\(id#\d+, 20\), REPARTITION_BY_NUM", _plan(found))
    assert found.count() == 60


def test_column_sketches_read_the_table_once(spark):
    df = spark.range(500).select("id", (F.col("id") % 7).cast("string").alias("few"))
    assert _plan(agg.column_sketches(df, "t")).count("Range (0, 500") == 1


def test_word_tables_are_not_broadcast(spark):
    vocabulary = store(spark.createDataFrame([("access", 5), ("forbidden", 3)], "word string, freq bigint"), "v")
    tests = store(spark.createDataFrame([("access", "acess"), ("missing", "mising")], "target string, wrong string"), "t")
    fixed = sp.spell_correct(tests.select(F.col("wrong").alias("word")), vocabulary)
    assert "Broadcast" not in _plan(fixed) and "Broadcast" not in _plan(sp.spell_report(tests, store(fixed, "fixed"), vocabulary))
    assert tuple(sp.spell_report(tests, fixed, vocabulary).first())[:3] == (2, 1, 1)


# ---- every pair that shares a token -----------------------------------------------------------


@pytest.mark.parametrize("bags_of_block, postings, meetings", [(1024, 400_000, 2_000_000), (7, 60, 40), (50, 1, 1)])
def test_sharing_pairs_by_blocks(spark, monkeypatch, bags_of_block, postings, meetings):
    rows, bagged, bags = _zipf_bags(spark)
    vectors = er.bag_vectors(bagged, bags, "doc_id")
    for name, size in (("_SIDE_BAGS", bags_of_block), ("_POSTINGS", postings), ("_MEETINGS", meetings)):
        monkeypatch.setattr(er, name, size)
    held = {i: words for i, _, words in rows}
    scores = brute_pairs({i: (side, words) for i, side, words in rows + [(200 + i, *x) for i, (_, *x) in enumerate(rows[:4])]})
    sizes = {r["left_id"]: r["n_left"] for r in bags.collect()}, {r["right_id"]: r["n_right"] for r in bags.collect()}
    first = set(sizes[0]), set(sizes[1])
    want = {p: s for p, s in scores.items() if p[0] in first[0] and p[1] in first[1] and set(held[p[0]]) & set(held[p[1]])}
    assert min(want.values()) < 0.05
    found = er.similar_bags(vectors, 0, names=bags)
    # blocks are read where they are stored; no pair moves
    assert "Exchange" not in _plan(found)
    got = {(r["left_id"], r["right_id"]): r for r in found.collect()}
    assert got.keys() == want.keys()
    for p, r in got.items():
        assert (round(r["similarity"], 9), r["n_pairs"]) == (round(want[p], 9), sizes[0][p[0]] * sizes[1][p[1]])
    tokens = er.common_tokens(None, vectors, bags).collect()
    assert {(r["left_id"], r["right_id"]): r["shared"] for r in tokens} == {p: sorted(set(held[p[0]]) & set(held[p[1]])) for p in want}
    assert len(tokens) == len(want)


@pytest.mark.parametrize("name", ["cosine_inverted", "common_tokens"])
def test_pairs_of_low_cosine_are_listed(spark, tmp_path, name):
    """Two texts whose only shared word is nothing beside their own ones."""
    texts = [("src0", "zebra " + "alpha " * 60), ("src5", "zebra " + "beta " * 60), ("src5", "gamma"), ("src1", "zebra delta"), ("src6", None)]
    rows = [(i, source, text) for i, (source, text) in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, source string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = all_queries()[name](spark, str(tmp_path)).collect()
    assert {(r["a_id"], r["b_id"]) for r in found} == {(0, 1), (3, 1)}
    if name == "cosine_inverted":
        assert all(0 < r["similarity"] < 0.05 for r in found if r["a_id"] == 0)
    else:
        assert {r["shared"] for r in found} == {"zebra"}


# ---- questions in batches ---------------------------------------------------------------------


@pytest.mark.parametrize("batch", [1, 3, 2000])
def test_questions_move_a_number_per_word(spark, monkeypatch, batch):
    monkeypatch.setattr(sq, "_QUESTIONS", batch)
    rng = random.Random(3)
    names = [f"@entity{i}" for i in range(6)] + ["out", "in"]
    rows = []
    for i in range(40):
        listed = rng.sample(names, rng.randint(0, 6))
        rows.append((i, "ok", " ".join(rng.choices(names, k=8)), " ".join(rng.choices(["who", "zz", *names], k=4)), rng.choice(names), listed))
    rows += [(None, "ok", "who", "", None, ["out"]), (50, "short", "a", None, None, None), (51, "ok", "who", "in", "in", None), (52, None, "a", "a", "a", [])]
    again = [(0, "ok", "who in", "in", "zz", ["in"]), (50, "ok", "in", "in", "in", ["in"])]
    schema = "id int, status string, context string, question string, answer string, candidates array<string>"
    vocabulary = store(sq.entity_vocabulary(spark.createDataFrame([("in", 1), ("who", 2)], "word string, rank int"), 5), "vocabulary")
    encoded = sq.encode_questions(spark.createDataFrame(rows + again, schema), vocabulary, "id", 5)
    plan = _plan(encoded)
    assert "Window" not in plan and "Generate explode" not in plan
    ids, got = dict(vocabulary.collect()), {(r["id"], r["status"]): r for r in encoded.collect()}
    assert got.keys() == {(r[0], r[1]) for r in rows + again}
    own = {}
    for r in spark.createDataFrame([r for r in rows + again if r[5]], schema).select("id", "status", sq.candidate_map(F.col("id"), F.col("candidates"), 5).alias("m")).collect():
        own.setdefault((r["id"], r["status"]), []).append(r["m"])
    for r in rows:
        if r[0] == 0:
            continue
        mine = (own.get(r[:2]) or [{}])[0]

        def code(w):
            return mine[w] if w in mine else -1 if w and w.startswith("@entity") else ids.get(w, ids["<UNK>"])

        found = got[r[:2]]
        if r[1] != "ok":
            assert found["context"] is None and found["candidates"] is None and found["answer"] is None
        elif r[5] is None:
            assert (found["context"], found["question"], found["answer"], found["candidates"]) == ([], [], None, [])
        else:
            assert found["context"] == [code(w) for w in r[2].split(" ")] and found["question"] == [code(w) for w in r[3].split(" ")]
            assert found["answer"] == code(r[4]) and found["candidates"] == [code(w) for w in r[5]]
    # rows of one key and status are one question, by place
    assert len(got[0, "ok"]["context"]) == 10 and len(got[0, "ok"]["question"]) == 5
