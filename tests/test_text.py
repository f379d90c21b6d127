"""Text functions on edge cases."""

import pytest
from pyspark.sql import functions as F

from reviewlens.functions import text as tx

TEXTS = [
    "",
    "   ",
    "\nleading",
    "a\tb\nC's café 9x",
    "Привет мир 漢字",
    "see http://x.y/z?q=1 and www.y now",
    "end http://x after wwwonly\r\nnext_word 12",
    "under_score x1 ab c",
    "tail \x1cgap\x85gap wide",
    None,
]


# Words, keywords, words in general (\W+), pairs, and number of raw words that each text must give.
EXPECTED = [
    ([], [], [], [], 0),
    ([], [], [], [], 0),
    (["leading"], ["leading"], ["leading"], [], 1),
    (["a", "b", "c", "s", "caf", "x"], ["caf"], ["a", "b", "c", "s", "caf", "9x"], ["café 9x"], 5),
    ([], [], [], ["привет мир", "мир 漢字"], 3),
    (["see", "and", "now"], ["see", "http", "and", "www", "now"], ["see", "http", "x", "y", "z", "q", "1", "and", "www", "y", "now"],
     ["see http", "http and", "and www", "www now"], 5),
    (["end", "after", "next", "word"], ["end", "http", "after", "wwwonly", "next", "word"], ["end", "http", "x", "after", "wwwonly", "next_word", "12"],
     ["end http", "http after", "after wwwonly", "wwwonly next_word", "next_word 12"], 6),
    (["under", "score", "x", "ab", "c"], ["under", "score"], ["under_score", "x1", "ab", "c"], ["under_score x1", "x1 ab"], 4),
    (["tail", "gap", "gap", "wide"], ["tail", "gap", "gap", "wide"], ["tail", "gap", "gap", "wide"], ["tail gap", "gap gap", "gap wide"], 4),
]


@pytest.fixture(scope="module")
def results(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    c = F.col("t")
    columns = {
        "letters": tx.clean_text_letters(c),
        "sql": tx.clean_text_sql(c),
        "words": tx.embed_clean_tokens(c),
        "string": tx.embed_clean_string(c),
        "keywords": tx.keyword_tokens(c),
        "raw": tx.word_count_raw(c),
        "clean": tx.word_count_clean(c),
        "grams": tx.ngrams_1_2(c),
        "nonword": tx.tokenize_nonword(c),
        "stopped": tx.remove_stopwords(tx.tokenize_whitespace(c), ["SEE", "and"]),
    }
    return df.select("i", *[v.alias(k) for k, v in columns.items()]).orderBy("i").collect()


def test_expected_words(results):
    for (words, keywords, nonword, pairs, raw), row in zip(EXPECTED, results):
        assert row["words"] == words and row["string"] == " ".join(words)
        assert row["keywords"] == keywords and row["nonword"] == nonword and row["raw"] == raw
        assert [g for g in row["grams"] if " " in g] == pairs


def test_known_values(results):
    assert results[3]["letters"] == "a\tb\nc s caf   x"
    assert results[3]["sql"] == "a b c s caf   x"
    assert [results[0]["clean"], results[2]["clean"], results[9]["clean"]] == [1, 2, None]
    assert results[5]["stopped"] == ["http://x.y/z?q=1", "www.y", "now"]
    assert results[9]["words"] == [] and results[9]["string"] == ""


def test_stopword_list(spark):
    from workload.oracle import ENGLISH

    assert tx.english_stopwords() == ENGLISH
