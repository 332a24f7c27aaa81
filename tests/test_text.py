import re

import pytest
from pyspark.sql import functions as F

from tessera.functions.text import clean_text, ngrams, ngrams_starting_with, split_words, tokenize
from tessera.operators.text import Context, context_ngram, ngram_counts, ngram_frequency, ngram_regex_filter

EDGE = ["", "   ", " a b ", "A  B", "a\tb\nc", "ends with space ", "x", "Hello World", "é à b"]


def java_tokenizer(s):
    """The classic ML Tokenizer: lower-case, String.split("\\s") (trailing
    empty strings removed)."""
    import re
    parts = re.split(r"[ \t\n\x0b\f\r]", s.lower())
    if s.lower() == "":
        return [""]
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_tokenize_matches_classic_tokenizer(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(EDGE)], "i int, s string")
    got = {r.i: r.w for r in df.select("i", tokenize("s").alias("w")).collect()}
    for i, s in enumerate(EDGE):
        assert got[i] == java_tokenizer(s), s


def test_tokenize_null_is_null(spark):
    df = spark.createDataFrame([(None,)], "s string")
    assert df.select(tokenize("s").alias("w")).first().w is None


def test_ngrams_short_null_and_values(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],), (None,), (["a", "", "b"],)], "w array<string>")
    got = [r.g for r in df.select(ngrams("w", 2).alias("g")).collect()]
    assert got == [["a b", "b c"], [], [], None, ["a ", " b"]]
    got3 = [r.g for r in df.select(ngrams("w", 3).alias("g")).collect()]
    assert got3 == [["a b c"], [], [], None, ["a  b"]]


def test_ngram_row_count_invariant(spark):
    texts = ["a b c d", "x", "", "p q r", "one two three four five"]
    df = spark.createDataFrame([(t,) for t in texts], "m string").withColumn("words", tokenize("m"))
    n = 2
    total = ngram_counts(df, n).agg(F.sum("estfrequency")).first()[0]
    assert total == sum(max(0, len(java_tokenizer(t)) - n + 1) for t in texts)


def test_ngrams_starting_with_equals_filtered(spark):
    df = spark.createDataFrame([("the cat the dog the",), ("the",), ("a the b the c",)], "m string")
    w = df.select(tokenize("m").alias("w"))
    a = [sorted(r.g) for r in w.select(ngrams_starting_with("w", 2, "the").alias("g")).collect()]
    b = [sorted(x for x in r.g if x.startswith("the ")) for r in w.select(ngrams("w", 2).alias("g")).collect()]
    assert a == b


def test_context_reading():
    assert Context.of("quality null null").tokens == ("quality", None, None)
    assert Context.of(["a.b", None]).first == "a.b" and Context.of("null good").first is None
    assert Context.of("good").first is None  # it need only begin the n-gram
    for bad in ("", "   ", None, []):
        with pytest.raises(ValueError):
            Context.of(bad)


def test_context_tokens_are_literal(spark):
    df = spark.createDataFrame([(["a.b", "c"],), (["axb", "c"],), (["\\e", "c"],), (["a\\eb", "c"],)], "words array<string>")
    assert [r.ngram for r in context_ngram(df, ["a.b", None]).collect()] == ["a.b c"]
    odd = spark.createDataFrame([(["a\\Eb", "c"],), (["ab", "c"],)], "words array<string>")
    assert [r.ngram for r in context_ngram(odd, [None, "c"]).collect()] == ["a\\Eb c", "ab c"]
    assert [r.ngram for r in context_ngram(odd, ["a\\Eb", "c"]).collect()] == ["a\\Eb c"]


def test_regex_shortcut_is_only_for_plain_words(spark):
    df = spark.createDataFrame([(["red", "one"],), (["good", "cat"],), (["redone", "a"],)], "words array<string>")
    grams = ["good cat", "red one", "redone a"]
    for pattern in ("^red |^good ", "^red ?one", "^red *one", "^red {0,1}one", "^red one", "^red ", "^(red) one", "^red o.e"):
        got = sorted(r.ngram for r in ngram_regex_filter(df, 2, pattern).collect())
        assert got == [g for g in grams if re.search(pattern, g)], pattern


def test_tokenize_line_ends_as_ml_tokenizer(spark):
    from pyspark.ml.feature import Tokenizer
    texts = ["foo \u2028", "foo \u0085", "a \u2029b \u2029", "x\u2028", "  y \n", "a  b", "z\u00a0 ", "q" + " " * 50 + "r" + " " * 50]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    own = [r.w for r in df.select(tokenize("s").alias("w")).collect()]
    ml = [r.w for r in Tokenizer(inputCol="s", outputCol="w").transform(df).collect()]
    assert own == ml


def test_context_ngram_prefix_semantics(spark):
    df = spark.createDataFrame([("red ones are red one",), ("Red One shines",), ("a goodness here",)], "m string")
    w = df.select(tokenize("m").alias("words"))
    got = {r.ngram: r.estfrequency for r in context_ngram(w, "red one").collect()}
    # last literal word is a prefix match; case folded by the tokenizer
    assert got == {"red ones": 1, "red one": 2}
    got2 = {r.ngram for r in context_ngram(w, "null good").collect()}
    assert got2 == {"a goodness"}
    exact = {r.ngram: r.estfrequency for r in context_ngram(w, "red one", exact=True).collect()}
    assert exact == {"red one": 2}
    assert {r.ngram for r in context_ngram(w, ["null", "good"], exact=True).collect()} == set()
    assert {r.ngram for r in context_ngram(w, [None, "ones"], exact=True).collect()} == {"red ones"}


def test_ngram_frequency_ties_are_deterministic(spark):
    df = spark.createDataFrame([("b a",), ("a b",), ("c d",), ("d c",)], "m string")
    w = df.select(tokenize("m").alias("words"))
    got = [r.ngram for r in ngram_frequency(w, 2, k=2).collect()]
    assert got == ["a b", "b a"]
    for parts in (1, 4):
        again = [r.ngram for r in ngram_frequency(w.repartition(parts), 2, k=2).collect()]
        assert again == got


def test_clean_text_and_split(spark):
    df = spark.createDataFrame([("  ab, cd!",), ("é_x",), ("",), (None,)], "m string")
    got = [r.c for r in df.select(clean_text("m").alias("c")).collect()]
    assert got == [" ab cd ", " x", "", None]
    sp = [r.s for r in df.select(split_words("m").alias("s")).collect()]
    assert sp[0] == ["", "ab,", "cd!"] and sp[2] == [""] and sp[3] is None


def test_regex_filter_with_anchored_word(spark):
    df = spark.createDataFrame([("red one two three red ones x y",), ("a red one b c",)], "m string")
    w = df.select(tokenize("m").alias("words"))
    got = sorted(r.g for r in ngram_regex_filter(w, 4, r"^red one", out_col="g").collect())
    brute = sorted(r.g for r in ngram_regex_filter(w, 4, r"(?:^red one)", out_col="g").collect())
    assert got == brute == ["red one b c", "red one two three", "red ones x y"]


def test_context_ngram_partition_independent(spark):
    texts = [f"the {w} of the {v} and the {w}" for w in ("cat", "dog", "cow") for v in ("a", "b")] * 5
    df = spark.createDataFrame([(t,) for t in texts], "m string").select(tokenize("m").alias("words"))
    want = [tuple(r) for r in context_ngram(df.repartition(1), "the null").collect()]
    assert want[0] == ("the cat", 20) and len(want) == 5
    for parts in (3, 11):
        assert [tuple(r) for r in context_ngram(df.repartition(parts), "the null").collect()] == want
