from pyspark.sql import functions as F

from conftest import rows
from lectern.functions.text import compose_text, is_missing, tokens, words
from lectern.operators.lemmas import first_pieces, lemma_map


def _tok(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    return [r[0] for r in df.orderBy("id").select(tokens("text")).collect()]


def test_edge_token_rows(spark):
    got = _tok(spark, ["", "the and of it", "abc123", "it's", "Crème brûlée", "###",
                       "churches boxes women stories", "Book book BOOK", None])
    assert got == [[], [], ["abc"], [], ["crème", "brûlée"], [], ["churches", "boxes", "women", "stories"],
                   ["book", "book", "book"], []]


def test_words_keep_order_and_repeats(spark):
    df = spark.createDataFrame([("A b, a; 3c",)], "t string")
    assert df.select(words("t")).first()[0] == ["a", "b", "a", "c"]


def test_compose_text_blanks_missing_values(spark):
    df = spark.createDataFrame([(None, "Ann", "nan"), ("Nan", None, "d")], "title string, author string, description string")
    got = [r[0] for r in df.select(compose_text()).collect()]
    assert got == ["Title: , Author: Ann, Description: ", "Title: Nan, Author: , Description: d"]


def test_is_missing(spark):
    df = spark.createDataFrame([("nan",), ("NaN",), (None,), ("banana",), ("",)], "x string")
    assert [r[0] for r in df.select(is_missing("x")).collect()] == [True, False, True, False, False]
    assert [r[0] for r in df.select(is_missing("x", any_case=True)).collect()] == [True, True, True, False, False]


def test_lemma_rules_with_lexicon(spark):
    vocab = spark.createDataFrame([(t,) for t in ["churches", "boxes", "women", "stories", "cats", "glasses"]], "token string")
    lex = spark.createDataFrame([(t,) for t in ["church", "box", "story", "cat", "glass", "woman"]], "token string")
    got = dict(rows(lemma_map(vocab, lex)))
    assert got == {"churches": "church", "boxes": "box", "women": "woman", "stories": "story", "cats": "cat",
                   "glasses": "glass"}


def test_lemma_prefers_shortest_then_rule_order(spark):
    vocab = spark.createDataFrame([("buses",), ("bus",), ("buse",)], "token string")
    got = dict(rows(lemma_map(vocab, vocab)))
    assert got["buses"] == "bus" and got["bus"] == "bus"


def test_first_piece_is_longest_known_prefix(spark):
    w = spark.createDataFrame([("playing",), ("zzz",), ("play",)], "word string")
    pieces = spark.createDataFrame([("p",), ("play",), ("pla",)], "piece string")
    assert dict(rows(first_pieces(w, pieces))) == {"playing": "play", "play": "play"}
