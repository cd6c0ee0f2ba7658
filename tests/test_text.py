import html

import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from gistmill.functions import fixed_values as fv
from gistmill.functions import text as tx
from gistmill.functions import tokens as tk


def test_title_and_body(one):
    assert one("HEAD\nline\nmore", tx.first_line) == "HEAD"
    assert one("HEAD\nline\nmore", tx.after_first_line) == "line\nmore"
    assert one("HEAD only", tx.first_line) == "HEAD only"
    assert one("HEAD only", tx.after_first_line) == ""


@pytest.mark.parametrize("text", ["U.S.-JAPAN RIFT O'NEIL 3RD", "élan ÉCOLE ßbe x2y", "", "  a  b"])
def test_title_case_is_that_of_python(one, text):
    assert one(text, tx.title_case) == text.title()


@pytest.mark.parametrize("text", [
    "&lt;ACME.N&gt; &amp;amp; &copy;2 &#65; &#x42; &nosuch; &ampx &notit; A&B && & &;", "none", "&lt", "",
])
def test_entities_are_those_of_the_standard(one, text):
    assert one(text, tx.decode_entities) == html.unescape(text)


def test_space_is_that_of_python(one):
    text = "  a\tb\x0b\x1cc d\x85 \n"
    assert one(text, tx.collapse_space) == " ".join(text.split())
    assert one(text, tx.strip_space) == text.strip()


@pytest.mark.parametrize("text, cleaned", [
    ("Profit rose. Reuter\x03", "Profit rose."),
    ("Reuter said so", "Reuter said so"),
    ("Acme Corp <ACM.N> rose", "Acme Corp rose"),
    ("<Acme Holdings Ltd> rose", "Acme Holdings Ltd rose"),
    ("a \n\t b ", "a b"),
    (" \n", ""),
])
def test_clean(one, text, cleaned):
    assert one(text, tx.clean_text) == cleaned


def test_redaction(one):
    text = "Contact press@example.com or +91 98300 12345."
    assert one(text, tx.sanitise) == "Contact [EMAIL] or [PHONE]."
    assert one("a\x02b\tc\nd\x1fe", tx.strip_control) == "a b\tc\nd e"
    assert one("id 12345 stays", tx.sanitise) == "id 12345 stays"
    assert one("x" * 13_000, lambda c: F.length(tx.sanitise(c))) == 13_000
    assert one("x" * 13_000, lambda c: F.length(tx.sanitise(c, 12_000))) == 12_000


@pytest.mark.parametrize("number", [
    "555\u00a0123\u00a04567", "\u0665\u0665\u0665 \u0661\u0662\u0663 \u0664\u0665\u0666\u0667", "555\u2003123-4567", "+91 (983) 001-2345",
])
def test_phone_numbers_of_any_script(one, number):
    assert one(f"x {number} y", tx.sanitise) == "x [PHONE] y"


def test_redaction_after_the_prompt_limit(one):
    assert one("x " * 6_500 + "a@b.org", tx.sanitise).endswith("[EMAIL]")


def test_fingerprint(one):
    assert one("abc", tx.fingerprint) == "ba7816bf8f01"
    assert one("", tx.fingerprint) == "-"
    assert one(None, tx.fingerprint) == "-"


def test_sentences(one):
    text = 'He left. "Yes." (Then) it ended! Why? no'
    assert one(text, tk.split_sentences) == ["He left.", '"Yes." (Then) it ended!', "Why? no"]
    assert one("One two three four. Too short. Five six seven eight", tk.split_long_sentences) == [
        "One two three four.", "Five six seven eight"
    ]


def test_terms(one):
    assert one("The U.S. said: the cat's 3 Cats, a cat", tk.content_terms) == ["said", "cat", "cats", "cat"]
    assert one(None, tk.content_terms) == []
    assert one("x_1 the é9 a b2", tk.word_runs) == ["x_1", "é9", "b2"]


def test_terms_match_the_ml_tokenizer(spark):
    from pyspark.ml.feature import RegexTokenizer

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    split = RegexTokenizer(inputCol="text", outputCol="w", pattern="[^a-zA-Z]+", minTokenLength=2)
    kept = StopWordsRemover(inputCol="w", outputCol="t")
    both = kept.transform(split.transform(docs)).select("t", tk.content_terms(F.col("text")).alias("mine"))
    assert both.filter("t <> mine").count() == 0


def test_stop_words_are_those_of_spark(spark):
    assert fv.ENGLISH_STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


def test_no_text_has_no_word_count(spark, one):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert one(None, tx.word_count) is None
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert one(None, tx.word_count) is None


def test_counts(one):
    assert one("In 1987 Acme lost 5", tx.digit_count) == 5
    assert one("In 1987 Acme lost", tx.capital_ratio) == 0.5
    assert one("a  b", tx.word_count) == 3


def test_sentence_breaks_are_those_of_the_pattern(spark):
    texts = ["One. Two.  \n\t Three", 'He said "go." "Why?" (Yes.) No', " A. B", "a. b. C", "x. Y. \x0bZ", "", ". A", "end. "]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    found = [r[0] for r in df.select(tk.split_sentences(F.col("x"))).collect()]
    assert found == [r[0] for r in df.select(F.filter(F.split("x", fv.SENTENCE_BREAK), lambda s: F.length(s) > 0)).collect()]
