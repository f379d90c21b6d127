"""TF-IDF, embeddings and vector conversions."""

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, CountVectorizer, RegexTokenizer, SQLTransformer, StopWordsRemover
from pyspark.ml.linalg import DenseVector, SparseVector, Vectors
from pyspark.sql import functions as F

from reviewlens.functions.vectors import sparse_entries, sparse_vectors, to_array, to_vector
from reviewlens.operators import dictionary, embeddings, features
from reviewlens.session import stage
from workload import fixtures as fx


@pytest.fixture(scope="module")
def reviews(spark, sf):
    return fx.reviews(spark, sf).select("doc_id", "Review").persist()


def test_equals_count_vectorizer_and_idf(spark, reviews):
    cleaning = "SELECT *, lower(regexp_replace(Review, '[^a-zA-Z]', ' ')) AS c FROM __THIS__"
    stock = Pipeline(
        stages=[
            SQLTransformer(statement=cleaning),
            RegexTokenizer(inputCol="c", outputCol="t", pattern=r"\s+"),
            StopWordsRemover(inputCol="t", outputCol="f"),
            CountVectorizer(inputCol="f", outputCol="raw", vocabSize=10000, minDF=2.0),
            IDF(inputCol="raw", outputCol="stock"),
        ]
    ).fit(reviews)
    ours = features.fit_text_features(reviews)
    terms, stock_terms = features.vocabulary(ours), stock.stages[3].vocabulary
    assert set(terms) == set(stock_terms)
    place = {term: i for i, term in enumerate(terms)}
    both = ours.transform(stock.transform(reviews).select("Review", "stock")).select("stock", "features").collect()
    for row in both:
        theirs = {place[stock_terms[i]]: v for i, v in zip(row["stock"].indices, row["stock"].values)}
        mine = dict(zip(row["features"].indices, row["features"].values))
        assert mine.keys() == theirs.keys()
        assert all(mine[i] == pytest.approx(theirs[i]) for i in mine)


def test_idf_value(spark):
    df = spark.createDataFrame([("w one",), ("w two",), ("one",), ("two",)], "Review string")
    model = features.fit_text_features(df)
    weights = dict(zip(features.vocabulary(model), model.stages[-1].getScalingVec()))
    assert weights["w"] == pytest.approx(math.log(5 / 3)) == pytest.approx(0.5108, abs=1e-4)


def test_features_do_not_depend_on_partitions(reviews):
    a = features.fit_text_features(reviews, vocab_size=50)
    b = features.fit_text_features(reviews.repartition(7).orderBy(F.rand(3)), vocab_size=50)
    assert features.vocabulary(a) == features.vocabulary(b) and len(features.vocabulary(a)) == 50


def test_bigram_vectors_have_length_one(reviews):
    model = features.fit_text_features(reviews, tokenizer="ngrams")
    lengths = [row["features"].norm(2) for row in model.transform(reviews).select("features").collect()]
    assert all(n == pytest.approx(1.0) or n == 0.0 for n in lengths)


def test_no_vocabulary(spark):
    with pytest.raises(ValueError):
        features.fit_text_features(spark.createDataFrame([("alone",), ("other",)], "Review string"))


def test_vector_conversions(spark):
    rows = [(1, Vectors.sparse(5, [1, 3], [2.0, 4.0])), (2, Vectors.dense([1.0, 0.0, 3.0, 0.0, 5.0])), (3, Vectors.sparse(5, [], []))]
    df = spark.createDataFrame(rows, ["id", "v"])
    entries = sparse_entries(df, "v", ["id"])
    got = {r["id"]: (r["indices"], r["values"]) for r in entries.collect()}
    assert got == {1: ([1, 3], [2.0, 4.0]), 2: ([0, 1, 2, 3, 4], [1.0, 0.0, 3.0, 0.0, 5.0]), 3: ([], [])}
    back = {r["id"]: r["w"] for r in sparse_vectors(entries, 5, ["id"], "w").collect()}
    assert isinstance(back[1], SparseVector)
    assert all(np.array_equal(back[i].toArray(), v.toArray()) for i, v in rows)
    again = df.select(to_vector(to_array(F.col("v"))).alias("v")).first()["v"]
    assert isinstance(again, DenseVector)


@pytest.mark.parametrize("limit", [0, embeddings.BROADCAST_LIMIT_BYTES])
def test_mean_word_vectors(spark, limit):
    words = [(1, ["a", "b", "a", "zz"]), (2, ["zz"]), (3, []), (4, None), (5, ["b"] * 500)]
    docs = spark.createDataFrame(words, "doc_id long, words array<string>")
    lexicon = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [4.0, -1.0])], "word string, vector array<float>")
    got = embeddings.pretrained_doc_vectors(docs, lexicon, 2, broadcast_limit=limit)
    means = {r["doc_id"]: r["features"].toArray().tolist() for r in got.collect()}
    assert means == {1: [2.0, 1.0], 2: [0.0, 0.0], 3: [0.0, 0.0], 4: [0.0, 0.0], 5: [4.0, -1.0]}


def test_word2vec(spark):
    text = [(i, ("sun moon star " * 4 + ("rare" if i == 0 else "sky")).split()) for i in range(20)]
    docs = spark.createDataFrame(text, "id int, words array<string>").coalesce(1)
    model = embeddings.fit_word2vec(docs, vector_size=8, iterations=2, partitions=1)
    table = {r["word"]: r["vector"].toArray() for r in embeddings.word_vector_table(model).collect()}
    assert set(table) == {"sun", "moon", "star", "sky"}
    mean = np.mean([table[w] for w in text[1][1]], axis=0)
    row = model.transform(docs).filter("id = 1").first()
    assert np.allclose(row["features"].toArray(), mean, atol=1e-6)
    same = embeddings.fit_word2vec(docs, vector_size=8, iterations=2, partitions=1)
    again = {r["word"]: r["vector"].toArray() for r in same.getVectors().collect()}
    assert all(np.array_equal(table[w], again[w]) for w in table)


def test_encoder_reads_whole_texts(spark):
    docs = spark.createDataFrame([(1, "word " * 3000 + "last"), (2, None)], "id int, Review string")
    encoded = embeddings.batch_encode_text(docs, embeddings.hashing_encoder(8))
    sums = {r["id"]: r["features"].toArray().sum() for r in encoded.collect()}
    assert sums == {1: 3001.0, 2: 0.0}


def token_rows(spark, sf):
    from reviewlens.operators.features import _through, tokenizer_stages

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    return stage(_through(docs, tokenizer_stages("text", "nonword")).select("doc_id", "tokens"), "tokens")


def test_dictionary_vectors_are_those_of_the_driver_form(spark, sf):
    from reviewlens.operators.features import count_vectorizer

    tokens = token_rows(spark, sf)
    model, frequencies, rows = count_vectorizer(tokens, "tokens")
    terms = dictionary.term_dictionary(tokens, "doc_id", "tokens", vocab_size=10_000)
    listed = terms.orderBy("id").collect()
    assert [r["term"] for r in listed] == model.vocabulary and [r["df"] for r in listed] == frequencies
    assert [r["id"] for r in listed] == list(range(len(listed)))
    both = dictionary.dictionary_vectors(tokens, "doc_id", "tokens", terms, len(listed)).join(
        model.transform(tokens).select("doc_id", "raw_features"), "doc_id"
    )
    assert both.count() == rows and all(r["features"] == r["raw_features"] for r in both.collect())


def test_dictionary_edges(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "a"]), (2, []), (3, None), (4, ["zz"]), (5, ["b"]), (5, ["b"])], "doc_id long, tokens array<string>")
    terms = dictionary.term_dictionary(docs, "doc_id", "tokens")
    assert [tuple(r) for r in terms.select("term", "id", "n", "df").collect()] == [("b", 0, 3, 2)]
    got = {r["doc_id"]: r["features"].toArray().tolist() for r in dictionary.dictionary_vectors(docs, "doc_id", "tokens", terms, 1).collect()}
    assert got == {1: [1.0], 2: [0.0], 3: [0.0], 4: [0.0], 5: [2.0]}
    empty = dictionary.term_dictionary(docs.limit(0), "doc_id", "tokens")
    assert empty.count() == 0 and dictionary.dictionary_vectors(docs.limit(0), "doc_id", "tokens", empty, 0).count() == 0


def test_many_terms_never_reach_the_driver(spark, monkeypatch):
    """300,000 terms: numbered without gaps by several tasks, and no action returns rows."""
    from pyspark.sql.classic.dataframe import DataFrame as Classic

    docs = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.transform(F.sequence(F.lit(0), F.lit(19)), lambda i: F.concat(F.lit("t"), ((F.col("id") * 20 + i) % 300_000).cast("string"))).alias("tokens")
    )
    for action in ("collect", "toPandas", "toArrow", "take", "first", "head"):
        monkeypatch.setattr(Classic, action, lambda *_, **__: pytest.fail("rows on the driver"))
    terms = dictionary.term_dictionary(docs, "doc_id", "tokens")
    vectors = dictionary.dictionary_vectors(docs, "doc_id", "tokens", terms, 300_000)
    assert terms.filter("id between 0 and 299999").select("id").distinct().count() == 300_000
    assert vectors.count() == 30_000
    text = vectors._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in text and "GlobalLimit" not in text


def test_label_dictionary(spark):
    from reviewlens.operators.labels import index_label

    df = spark.createDataFrame([(i, v) for i, v in enumerate("bbbaaccd")] + [(9, None)], "id long, v string")
    numbers = dictionary.label_dictionary(df, "v")
    want = {r["id"]: r["label"] for r in index_label(df, "v").collect()}
    assert {r["id"]: r["label"] for r in dictionary.index_by(df, "v", numbers).collect()} == want
    unseen = spark.createDataFrame([(1, "new"), (2, "a"), (3, None)], "id long, v string")
    got = {how: {r["id"]: r["label"] for r in dictionary.index_by(unseen, "v", numbers, on_unseen=how).collect()} for how in ("skip", "keep", "null")}
    assert got == {"skip": {2: 1.0}, "keep": {1: 4.0, 2: 1.0, 3: 4.0}, "null": {1: None, 2: 1.0, 3: None}}


def test_token_batches():
    lengths = [5, 20_000, 1, 7, 7, 3, 400, 0]
    batches = embeddings.token_batches(lengths, 3, 100)
    assert sorted(i for b in batches for i in b) == list(range(8))
    for b in batches:
        assert len(b) <= 3 and (len(b) == 1 or len(b) * max(lengths[i] for i in b) <= 100)
    assert embeddings.token_batches([], 3, 100) == []


def test_encoding_does_not_depend_on_the_batches(spark):
    """Short and very long texts: the same vectors in any batching, in the order of the rows, bounded batches."""
    rows = [(i, " ".join(["word", "other", chr(97 + i % 26) * 3] * (7000 if i == 5 else i % 40))) for i in range(200)] + [(900, None)]
    df = spark.createDataFrame(rows, "id long, text string").coalesce(2)

    def checked():
        inner = embeddings.hashing_encoder(8)()

        def encode(texts):
            padded = len(texts) * max(t.count(" ") + 1 for t in texts)
            assert len(texts) == 1 or padded <= 300, padded
            return inner(texts)

        return encode

    one = embeddings.batch_encode_text(df, embeddings.hashing_encoder(8), "text", batch_size=1).collect()
    many = embeddings.batch_encode_text(df, checked, "text", token_budget=300).collect()
    assert [r["id"] for r in many] == [r["id"] for r in rows_of(df)] and one == many
    assert one[5]["features"].toArray().sum() == 21_000
    cut = embeddings.batch_encode_text(df, embeddings.hashing_encoder(8), "text", max_tokens=128).collect()
    assert cut[5]["features"].toArray().sum() == 128 and cut[3] == one[3]


def rows_of(df):
    return df.select("id").collect()


@pytest.mark.parametrize("limit", [0, 2**28])
def test_lexicon_of_any_size_gives_the_same_means(spark, limit):
    docs = spark.createDataFrame(
        [(i, ["hot"] * (i % 4) + [f"w{i % 7}", "unknown"] * (i % 3)) for i in range(300)] + [(301, []), (302, None), (303, ["unknown"])], "doc_id long, words array<string>"
    )
    lexicon = spark.createDataFrame([("hot", [1.0, 2.0])] + [(f"w{j}", [float(j), -1.0]) for j in range(7)], "word string, vector array<double>")
    known = {r["word"]: np.array(r["vector"]) for r in lexicon.collect()}
    got = embeddings.pretrained_doc_vectors(docs, lexicon, 2, broadcast_limit=limit, heavy_words=2)
    found = {r["doc_id"]: r["features"].toArray() for r in got.collect()}
    for row in docs.collect():
        hits = [known[w] for w in row["words"] or [] if w in known]
        assert np.allclose(found[row["doc_id"]], np.mean(hits, axis=0) if hits else np.zeros(2))
    assert len(found) == docs.count()
    if limit == 0:
        assert {r["word"] for r in embeddings.heavy_hitters(docs.select(F.explode("words").alias("word")), "word", 1).collect()} <= {"hot", "unknown"}


def test_blocks_of_documents_get_each_vector_once(spark):
    docs = spark.createDataFrame(
        [(i % 40, [f"w{(i * j) % 90}" for j in range(i % 30)]) for i in range(120)] + [(None, ["w1", None, "w2"]), (None, ["w3"]), (77, None)],
        "doc_id long, words array<string>",
    )
    lexicon = spark.createDataFrame([(f"w{j}", [float(j), -1.0]) for j in range(80)], "word string, vector array<float>")
    far = embeddings.pretrained_doc_vectors(docs, lexicon, 2, broadcast_limit=0, block_words=100)
    near = embeddings.pretrained_doc_vectors(docs, lexicon, 2)
    both = [{r["doc_id"]: r["features"].toArray() for r in df.collect()} for df in (far, near)]
    assert both[0].keys() == both[1].keys() and far.count() == 42
    assert all(np.allclose(both[0][k], both[1][k], rtol=1e-12) for k in both[1])
    # The vectors are joined with the words of a block, not with those of each document.
    assert "Summarizer" not in far._jdf.queryExecution().toString() and "FlatMapCoGroupsInArrow" in far._jdf.queryExecution().toString()


def test_encoder_remembers_a_bounded_number_of_words(monkeypatch):
    monkeypatch.setattr(embeddings, "CACHED_WORDS", 3)
    encode = embeddings.hashing_encoder(4)()
    texts = ["a b c d e f g a b"] * 2
    before = encode(np.array(texts))
    assert np.array_equal(before, embeddings.hashing_encoder(4)()(np.array(texts))) and before.sum() == 18
    place = next(c.cell_contents for c in encode.__closure__ if hasattr(c.cell_contents, "cache_info"))
    assert place.cache_info().currsize == 3


def test_terms_of_a_document_are_counted_where_it_is(spark):
    from collections import Counter

    rows = [(1, ["b", "a", "b"]), (2, []), (3, None), (4, ["a", None, "a"]), (None, ["c"] * 5)]
    for more in ([], [(1, ["b", "z"]), (None, ["c"])]):
        df = spark.createDataFrame(rows + more, "doc_id long, tokens array<string>")
        want = Counter((key, t) for key, tokens in rows + more for t in tokens or [] if t is not None)
        counted = dictionary.document_terms(df, "doc_id", "tokens")
        assert {(r["doc_id"], r["term"]): r["tf"] for r in counted.collect()} == want
        assert ("Exchange" in counted._jdf.queryExecution().executedPlan().toString()) == bool(more)


def test_bigram_values_move_by_document_only(spark):
    rows = [(1, ["a", "b", "a"]), (1, ["b", "c"]), (2, ["a", "c"]), (3, []), (None, ["a", "b"])]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    got = features.tfidf_long(df, "doc_id", "tokens", min_df=1, smooth=True, normalize=True)
    lengths = got.groupBy("doc_id").agg(F.sum(F.col("tfidf") * F.col("tfidf")).alias("s")).collect()
    assert {r["doc_id"]: round(r["s"], 9) for r in lengths} == {1: 1.0, 2: 1.0}
    assert {(r["doc_id"], r["term"]): r["tf"] for r in got.collect()} == {(1, "a"): 2, (1, "b"): 2, (1, "c"): 1, (2, "a"): 1, (2, "c"): 1}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "hashpartitioning(doc_id" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("tokenizer", ["letters", "nonword", "ngrams"])
def test_written_tokens_give_the_same_vectors(spark, sf, tokenizer):
    train = fx.reviews(spark, sf).select("doc_id", "Review", "quality")
    model, vectors = features.fit_text_vectors(train, "Review", tokenizer, ["doc_id", "doc_id", "quality"])
    plain = features.fit_text_features(train, "Review", tokenizer)
    assert features.vocabulary(model) == features.vocabulary(plain) and vectors.columns == ["doc_id", "quality", "features"]
    want = {r["doc_id"]: r["features"] for r in plain.transform(train).collect()}
    assert {r["doc_id"]: r["features"] for r in vectors.collect()} == want
    # The texts are not cut again for the vectors.
    plan = vectors._jdf.queryExecution().optimizedPlan().toString()
    assert "train-tokens" in plan or "Review" not in plan
