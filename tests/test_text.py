"""Golden edge cases for the text functions (FIXTURES.md section 2)."""

import pytest
from pyspark.sql import functions as F

from revgraph.functions import (
    ENGLISH_STOP_WORDS,
    clean_words,
    extract_categories,
    extract_links,
    graph_safe_name,
    strip_chars,
    strip_markup,
    title_key,
)
from revgraph.functions.arrays import value_counts
from revgraph.operators import main_titles

LINK_CASES = [
    ("[[Foo|bar]] [[foo]]", ["foo"], []),
    ("[[Foo Bar#sec|x]]", ["foo bar"], []),
    ("[[#sec]]", [], []),
    ("[[Category:X Y|k|m]] [[category:low]]", ["category"], ["X Y|k"]),
    ("[[File:a.jpg|cap [[Inner]] x]]", ["file"], []),
    ("[[]]", [], []),
    ("[[|]]", [], []),
    ("[[#]]", [], []),
    ("[[:Category:z]]", [], []),
    ("[[multi\nline]] [[ok]]", ["ok"], []),
    ("[[2001: A Space]]", ["2001"], []),
    ("", [], []),
    ("[[Category:A]] [[Category:A]] [[Category:B|x]]", ["category"], ["A", "B"]),
]


@pytest.mark.parametrize("text,links,cats", LINK_CASES)
def test_links_and_categories(spark, text, links, cats):
    row = spark.createDataFrame([(text,)], "text string").select(
        extract_links("text").alias("l"), extract_categories("text").alias("c")
    ).first()
    # "" targets are dropped (they are empty links in the original).
    assert row.l == sorted(links)
    assert row.c == sorted(cats)


MARKUP_CASES = [
    ("== h == body", " body"),
    ("x ==== y ==== z", "x  y  z"),
    ("'''bold''' plain", " plain"),
    ("<ref>r [[q]]</ref> k", " k"),
    ("{{multi\nline}} z", "{{multi\nline}} z"),
    ("[ext http] [[w]]", " "),
    ("a [[b] c]] d", "a  d"),
    ("a [[x]] b {{t [[x]] u}} c", "a  b  c"),
    ("<math>x^2</math>y", "y"),
]


@pytest.mark.parametrize("text,expected", MARKUP_CASES)
def test_strip_markup(spark, text, expected):
    assert spark.createDataFrame([(text,)], "text string").select(strip_markup("text")).first()[0] == expected


def test_strip_chars(spark):
    s = ".,()[]\n{};!?\"#:+*=/'\\~|<>_"
    out = spark.createDataFrame([("a" + s + "b-&$%@",)], "t string").select(strip_chars("t")).first()[0]
    assert out == "a" + " " * 26 + "b-&$%@"


def test_stop_words_match_spark_default():
    from pyspark.ml.feature import StopWordsRemover

    assert list(ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_clean_words_order(spark):
    # Stop words go before punctuation is stripped, so "the," survives as "the";
    # a leading newline keeps "\nthe" from being a stop word.
    df = spark.createDataFrame([("The cat, the, [[Link]] {{tpl}} a dog.\nthe end",)], "text string")
    words = clean_words(df).first().words
    assert words == ["cat", "the", "dog", "the", "end"]


def test_value_counts(spark):
    df = spark.createDataFrame([(["b", "a", "b", "c", "b"],), ([],), (["x", None, None],)], "w array<string>")
    rows = value_counts(df, "w", "m").orderBy(F.size("w")).collect()
    assert [dict(r.m) for r in rows] == [{}, {"x": 1}, {"a": 1, "b": 3, "c": 1}]


def test_main_titles(spark):
    df = spark.createDataFrame([(t,) for t in ["foo", "foo:", "::", "a:b", ":b"]], "title string")
    assert sorted(r.title for r in main_titles(df).collect()) == ["::", "foo", "foo:"]


def test_title_key(spark):
    assert spark.createDataFrame([("Foo Bar baz",)], "t string").select(title_key("t")).first()[0] == "foo_bar_baz"


def test_graph_safe_name_profiles(spark):
    df = spark.createDataFrame([("a b+c-d@e=f~g",)], "t string")
    r = df.select(
        graph_safe_name("t", "link").alias("link"),
        graph_safe_name("t", "word").alias("word"),
        graph_safe_name("t", "word_edge").alias("word_edge"),
        graph_safe_name("t", "category").alias("category"),
        graph_safe_name("t", "category_page").alias("page"),
    ).first()
    assert r.link == "a_bplus_c_d@e=f~g"
    assert r.word == "a_bplus_c__dateequal_f~g"
    assert r.word_edge == "a_bplus_c__dateequal_f_g"
    assert r.category == "a_bplusc__dateequal_f~g"
    assert r.page == "a_bplus_c__date=f~g"
