"""One query per operator. Each reads the given tables and returns scalars, so that rows compare."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.functions import text as tx
from reviewlens.functions import vectors as vec
from reviewlens.functions.vectors import sparse_entries, to_array, to_vector
from reviewlens.operators import cleaning, compare, dictionary, embeddings, features, imbalance, keywords, labels
from reviewlens.operators import metrics, models, payload, ranking, sampling, splits, stats, thresholds, tuning
from reviewlens.session import scratch_path, stage
from reviewlens.sources import readers, writers
from workload import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def checksum(array: Column) -> Column:
    """A number that changes with any element and its place."""
    weighted = F.transform(array, lambda x, i: x.cast("double") * (i + 1))
    return F.round(F.aggregate(weighted, F.lit(0.0), lambda a, b: a + b), 6)


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


# --- sources and sinks -------------------------------------------------------------------------


@query
def scan_csv_reviews(spark, sf):
    """Two folders whose headers differ in order; together they hold every row."""
    reviews = fx.raw_reviews(spark, sf)
    paths = [scratch_path(spark, "reviews-csv") for _ in range(2)]
    for rest, (path, columns) in enumerate(zip(paths, (["Review", "Rating"], ["Rating", "doc_id", "Review"]))):
        writers.write_csv(reviews.filter(F.col("doc_id") % 2 == rest).select(*columns), path)
    return readers.read_reviews_csv(spark, paths)


@query
def scan_parquet_vectors(spark, sf):
    vectors = readers.read_vectors(spark, f"{sf}/embeddings.parquet", ["vec_id", "label", "embedding"])
    return vectors.select("vec_id", "label", F.size("embedding").alias("dims"), checksum(F.col("embedding")).alias("total"))


@query
def scan_word_vectors_text(spark, sf):
    path = scratch_path(spark, "word-vectors")
    line = F.concat_ws(" ", "word", F.array_join(F.col("vector").cast("array<string>"), " "))
    fx.lexicon(spark, sf).select(line.alias("value")).write.text(path)
    words = readers.read_word_vectors(spark, path, fx.LEXICON_DIM)
    return words.select("word", F.size("vector").alias("dims"), checksum(F.col("vector")).alias("total"))


@query
def scan_notebook_metrics(spark, sf):
    path = scratch_path(spark, "notebooks")
    fx.notebook_records(spark, sf).write.json(path)
    return readers.extract_metrics(readers.read_notebooks(spark, path, multi_line=False))


@query
def rows_to_frame(spark, sf):
    schema = T.StructType(
        [
            T.StructField("text", T.StringType()),
            T.StructField("Sentiment", T.IntegerType()),
            T.StructField("features", VectorUDT()),
        ]
    )
    rows = fx.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("text"), F.col("label").alias("Sentiment"), F.col("embedding").alias("features")
    )
    typed = readers.rows_to_frame(rows, schema)
    return typed.select("text", "Sentiment", checksum(to_array(F.col("features"))).alias("total"))


@query
def sink_csv_splits(spark, sf):
    path = scratch_path(spark, "splits-csv")
    writers.write_splits_csv(fx.split_reviews(spark, sf), path)
    schema = "Review string, Rating double, Sentiment string"
    sides = [
        readers.read_reviews_csv(spark, f"{path}/split={name}", T.StructType.fromDDL(schema)).withColumn("split", F.lit(name))
        for name in ("train", "test")
    ]
    return sides[0].unionByName(sides[1])


@query
def sink_parquet_vectors(spark, sf):
    path = scratch_path(spark, "vectors")
    vectors = fx.table(spark, sf, "embeddings")
    writers.write_vectors(vectors.select("vec_id", "label", to_vector(F.col("embedding")).alias("features")), path)
    back = readers.read_vectors(spark, path)
    return back.select("vec_id", "label", checksum(to_array(F.col("features"))).alias("total"))


@query
def sink_results_csv(spark, sf):
    path = scratch_path(spark, "results-csv")
    writers.write_csv(metrics.metrics_rows(fx.method_predictions(spark, sf)), path, single_file=True)
    schema = "Method string, Accuracy double, Precision double, Recall double, F1 double, TN long, FP long, FN long, TP long"
    return readers.read_reviews_csv(spark, path, T.StructType.fromDDL(schema))


def _payload(spark, sf):
    results = metrics.metrics_rows(fx.method_predictions(spark, sf))
    return payload.dataset_payload(fx.payload_reviews(spark, sf), results, results, notes={"source": "labels"})


def _flat_payload(record: DataFrame) -> DataFrame:
    """``(path, value)`` rows of the numbers in a payload."""

    def row(path, value):
        path = path if isinstance(path, Column) else F.lit(path)
        return F.struct(path.alias("path"), value.cast("double").alias("value"))

    def named(prefix: str, value: str):
        return lambda entry: row(F.concat(F.lit(f"{prefix}."), entry["model"]), entry[value])

    def cell(name: str, i: int, j: int):
        return lambda entry: row(F.concat(F.lit(f"matrix.{name}."), entry["key"]), entry["value"][i][j])

    def word(field: str):
        def numbered(entry, i):
            place = (i + 1).cast("string")
            return row(F.concat(F.lit(f"{field}."), place, F.lit("."), entry["word"]), entry["value"])

        return numbered

    parts = [F.array(*[row(f"stats.{f}", F.col(f"datasetStats.{f}")) for f in payload.STATS_FIELDS.values()])]
    parts.append(F.transform("classDistribution", lambda c: row(F.concat(F.lit("class."), c["label"]), c["count"])))
    for field in ("classicModels", "embeddingModels"):
        parts += [F.transform(field, named(f"{field}.{name}", name)) for name in ("accuracy", "precision", "recall", "f1")]
    matrices = F.map_entries("classicConfusionMatrices")
    parts += [
        F.transform(matrices, cell(name, i, j))
        for name, i, j in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))
    ]
    parts += [F.transform(field, word(field)) for field in ("positiveKeywords", "negativeKeywords")]
    return record.select(F.inline(F.concat(*parts)))


@query
def sink_payload_json(spark, sf):
    path, record = scratch_path(spark, "payload"), _payload(spark, sf)
    writers.write_payload_json(record, path)
    return _flat_payload(spark.read.schema(record.schema).json(path))


@query
def dataset_payload(spark, sf):
    return _flat_payload(_payload(spark, sf))


@query
def load_or_skip_inputs(spark, sf):
    paths = {name: f"{sf}/{name}.parquet" for name in ("documents", "labels", "not_there", "embeddings")}
    found = readers.read_if_present(spark, paths)
    sizes = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("input"), "n") for name, df in found.items()]
    result = sizes[0]
    for other in sizes[1:]:
        result = result.unionByName(other)
    return result


# --- projections and filters ---------------------------------------------------------------------


@query
def project_review_cols(spark, sf):
    return cleaning.project_review_cols(fx.raw_reviews(spark, sf))


@query
def drop_missing(spark, sf):
    return cleaning.drop_missing(fx.raw_reviews(spark, sf), ["Review", "Rating"])


@query
def dedup_reviews(spark, sf):
    return cleaning.dedup_reviews(cleaning.project_review_cols(fx.raw_reviews(spark, sf)))


@query
def trim_nonempty(spark, sf):
    return cleaning.trim_nonempty(fx.raw_reviews(spark, sf))


@query
def cast_rating(spark, sf):
    return cleaning.cast_rating(fx.raw_reviews(spark, sf))


@query
def clean_reviews(spark, sf):
    return cleaning.clean_reviews(fx.raw_reviews(spark, sf))


@query
def label_from_rating(spark, sf):
    stars = (2 + F.col("quality") + (1 - F.col("toxic"))).cast("double")
    rated = fx.reviews(spark, sf).select("doc_id", stars.alias("Rating"))
    inclusive = labels.label_from_rating(rated, out="three_positive")
    return labels.label_from_rating(inclusive, out="three_negative", three_as_positive=False)


def _sentiment_texts(spark, sf):
    lang = F.col("lang")
    name = (
        F.when(lang == "fr", F.concat(F.lit(" "), F.initcap("Sentiment"), F.lit(" ")))
        .when(lang == "de", F.upper("Sentiment"))
        .when(lang == "es", F.lit("mixed"))
        .otherwise(F.col("Sentiment"))
    )
    return fx.labelled(spark, sf).withColumn("Sentiment", name)


@query
def align_labels(spark, sf):
    return labels.align_labels(_sentiment_texts(spark, sf), keep=("doc_id",))


@query
def binary_label(spark, sf):
    return _sentiment_texts(spark, sf).select("doc_id", labels.binary_label(F.col("Sentiment")).alias("label"))


@query
def stable_split(spark, sf):
    return splits.stable_split(fx.labelled(spark, sf)).select("doc_id", "split_key", "split")


@query
def stable_split_md5(spark, sf):
    return fx.split_reviews(spark, sf).select("doc_id", "split_key", "split")


@query
def random_split(spark, sf):
    return splits.random_split(fx.documents(spark, sf), (0.8, 0.2), 42, key=["doc_id"]).select("doc_id", "part")


@query
def filter_by_label(spark, sf):
    return labels.filter_by_label(fx.labelled(spark, sf), "Sentiment", "negative").select("doc_id", "Review", "Rating")


@query
def filter_empty_tokens(spark, sf):
    tokens = fx.raw_reviews(spark, sf).select("doc_id", tx.embed_clean_tokens(F.col("Review")).alias("words"))
    return labels.filter_empty_tokens(tokens).select("doc_id", F.size("words").alias("n_words"))


def _event_probabilities(spark, sf):
    return fx.event_scores(spark, sf).select("event_id", "label", (F.col("score") / (F.col("score") + 5.0)).alias("pos_prob"))


@query
def confidence_filter(spark, sf):
    return thresholds.confidence_filter(_event_probabilities(spark, sf)).select("event_id", "final_label")


@query
def rename_const_cols(spark, sf):
    events = fx.table(spark, sf, "events").select("event_id", "value")
    return thresholds.rename_const_cols(events, {"value": "rawPrediction"}, {"final_label": 1.0, "method": "events"})


@query
def preview_rows(spark, sf):
    return ranking.preview_rows(fx.reviews(spark, sf).select("doc_id", "Review", "Rating"), ["doc_id"], 5)


# --- text functions ------------------------------------------------------------------------------


def _text_query(name: str, function: Callable[[Column], Column], kind: str) -> None:
    def run(spark, sf):
        result = function(F.col("text"))
        if kind == "tokens":
            columns = [F.size(result).alias("n"), F.array_join(result, " ").alias("tokens")]
        else:
            columns = [result.alias(kind)]
        return fx.documents(spark, sf).select("doc_id", *columns)

    run.__name__ = name
    query(run)


_text_query("clean_text_letters", tx.clean_text_letters, "clean_text")
_text_query("clean_text_sql", tx.clean_text_sql, "clean_text")
_text_query("tokenize_whitespace", tx.tokenize_whitespace, "tokens")
_text_query("tokenize_nonword", tx.tokenize_nonword, "tokens")
_text_query(
    "remove_stopwords",
    lambda c: tx.remove_stopwords(tx.tokenize_whitespace(tx.clean_text_letters(c)), tx.english_stopwords()),
    "tokens",
)
_text_query("embed_clean_tokens", tx.embed_clean_tokens, "tokens")
_text_query("embed_clean_string", tx.embed_clean_string, "clean_text")
_text_query("keyword_tokens", tx.keyword_tokens, "tokens")
_text_query("word_count_clean", tx.word_count_clean, "n_words")
_text_query("word_count_raw", tx.word_count_raw, "n_words")
_text_query("ngrams_1_2", tx.ngrams_1_2, "tokens")


# --- aggregations --------------------------------------------------------------------------------


@query
def row_counts(spark, sf):
    return stats.row_counts(fx.raw_reviews(spark, sf), method="md5")


@query
def class_counts(spark, sf):
    return stats.class_counts(fx.labelled(spark, sf), "Sentiment", ["negative", "neutral", "positive"])


@query
def class_share(spark, sf):
    return rounded(stats.class_share(fx.labelled(spark, sf)), "share_percent")


def _clean_counts(spark, sf):
    return fx.documents(spark, sf).select(tx.word_count_clean(F.col("text")).alias("words"))


@query
def word_count_stats(spark, sf):
    """The approximate median must lie between the exact 49th and 51st percentile."""
    words = _clean_counts(spark, sf)
    exact = words.select(F.percentile("words", F.array(F.lit(0.49), F.lit(0.51)))).scalar()
    near = F.col("median").between(exact[0], exact[1])
    return stats.word_count_stats(words).select("mean", "variance", "std", near.alias("median_near"))


@query
def word_count_stats_exact(spark, sf):
    words = fx.documents(spark, sf).select(tx.word_count_raw(F.col("text")).alias("words"))
    return stats.word_count_stats_exact(words)


@query
def class_weights(spark, sf):
    return rounded(stats.class_weights(fx.labelled(spark, sf), "Sentiment"), "weight")


@query
def class_weight_rows(spark, sf):
    weighted = stats.add_class_weights(fx.labelled(spark, sf), "Sentiment").select("doc_id", "classWeight")
    return rounded(weighted, "classWeight")


@query
def top_keywords(spark, sf):
    return keywords.top_keywords(fx.labelled(spark, sf), k=120)


@query
def top_keywords_24(spark, sf):
    stop = [*tx.english_stopwords(), *tx.DOMAIN_STOPWORDS_SHORT]
    return keywords.top_keywords(fx.labelled(spark, sf), k=24, stopwords=stop)


@query
def keyword_counts(spark, sf):
    stop = [*tx.english_stopwords(), *[word for word in tx.DOMAIN_STOPWORDS_SHORT if word != "dont"]]
    return keywords.keyword_counts(fx.labelled(spark, sf), stopwords=stop, drop_class_name=False)


@query
def crosstab_predictions(spark, sf):
    return metrics.crosstab_predictions(fx.predictions(spark, sf))


@query
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(fx.event_scores(spark, sf))


@query
def classification_report(spark, sf):
    return rounded(metrics.classification_report(fx.predictions(spark, sf)), "precision", "recall", "f1")


@query
def weighted_metrics(spark, sf):
    return metrics.weighted_metrics(fx.method_predictions(spark, sf), by=["Method"], digits=6)


@query
def by_label_metrics(spark, sf):
    figures = metrics.by_label_metrics(fx.method_predictions(spark, sf), 1, by=["Method"])
    return rounded(figures.select("Method", "recall", "f1"), "recall", "f1")


@query
def binary_metrics(spark, sf):
    return metrics.binary_metrics(fx.event_scores(spark, sf), digits=6)


@query
def auc_roc(spark, sf):
    return rounded(metrics.auc_roc(fx.event_scores(spark, sf)), "auc")


@query
def auc_pr(spark, sf):
    return rounded(metrics.auc_pr(fx.event_scores(spark, sf)), "auc_pr")


def _filtered_tokens(spark, sf):
    tokens = tx.tokenize_whitespace(tx.clean_text_sql(F.col("text")))
    kept = tx.remove_stopwords(tokens, tx.english_stopwords())
    return fx.documents(spark, sf).select("doc_id", kept.alias("tokens"))


@query
def vocab_document_freq(spark, sf):
    return keywords.vocab_document_freq(_filtered_tokens(spark, sf), "tokens")


def _comparison(spark, sf):
    predictions = fx.method_predictions(spark, sf)
    short = predictions.filter(F.col("Method") != "cut_5000")
    return compare.compare_models(metrics.metrics_rows(short), metrics.metrics_rows(predictions))


@query
def compare_models(spark, sf):
    return _comparison(spark, sf)


@query
def best_model(spark, sf):
    return compare.best_model(_comparison(spark, sf))


@query
def unpivot_metrics(spark, sf):
    missing = F.when(F.col("Method") != "cut_500", F.col("Precision"))
    return compare.unpivot_metrics(_comparison(spark, sf).withColumn("Precision", missing))


@query
def union_pseudo_labels(spark, sf):
    events = _event_probabilities(spark, sf)
    known = events.select("event_id", F.col("label").cast("double").alias("final_label"))
    chosen = thresholds.confidence_filter(events).select("final_label", "event_id")
    return thresholds.union_pseudo_labels(known, chosen)


@query
def concat_splits(spark, sf):
    divided = fx.split_reviews(spark, sf)
    joined = splits.concat_splits(splits.part(divided, "train"), splits.part(divided, "test"))
    return joined.select("doc_id", "Review", "Rating", "Sentiment")


# --- features ------------------------------------------------------------------------------------


@query
def index_label(spark, sf):
    indexed = labels.index_label(fx.documents(spark, sf).select("doc_id", "source"), "source")
    return indexed.select("doc_id", "source", "label")


@query
def dictionary_labels(spark, sf):
    sources = fx.documents(spark, sf).select("doc_id", "source")
    return dictionary.index_by(sources, "source", dictionary.label_dictionary(sources, "source"))


def _kept_tokens(spark, sf) -> DataFrame:
    stages = features.tokenizer_stages("text", "letters")
    tokens = features._through(fx.documents(spark, sf).select("doc_id", "text"), stages)
    return tokens.select("doc_id", tx.remove_stopwords(F.col("tokens"), tx.english_stopwords()).alias("tokens"))


@query
def dictionary_terms(spark, sf):
    return dictionary.term_dictionary(_kept_tokens(spark, sf), "doc_id", "tokens")


@query
def dictionary_tfidf(spark, sf):
    """Vectors over all terms that occur twice, none of which the driver sees."""
    tokens = stage(_kept_tokens(spark, sf), "tokens")
    terms = dictionary.term_dictionary(tokens, "doc_id", "tokens")
    size, rows = (df.agg(F.count(F.lit(1)).alias("n")).first()["n"] for df in (terms, tokens))
    vectors = dictionary.dictionary_vectors(tokens, "doc_id", "tokens", terms, size, rows)
    entries = sparse_entries(vectors, "features", ["doc_id"]).select("doc_id", F.inline_outer(F.arrays_zip("indices", "values")))
    return rounded(entries.select("doc_id", F.col("indices").alias("id"), F.col("values").alias("value")), "value")


def _vector_terms(df: DataFrame, vector: str, vocabulary: list[str], key: str) -> DataFrame:
    """``(key, term, value)`` of the entries of a vector column."""
    entries = sparse_entries(df, vector, [key]).select(key, F.inline(F.arrays_zip("indices", "values")))
    terms = df.sparkSession.createDataFrame(list(enumerate(vocabulary)), "indices int, term string")
    return entries.join(F.broadcast(terms), "indices").select(key, "term", F.col("values").alias("value"))


@query
def count_vectorize(spark, sf):
    tokens = _filtered_tokens(spark, sf)
    model, _, _ = features.count_vectorizer(tokens, "tokens")
    counted = _vector_terms(model.transform(tokens), "raw_features", model.vocabulary, "doc_id")
    return counted.select("doc_id", "term", F.col("value").cast("long").alias("tf"))


@query
def tfidf(spark, sf):
    return rounded(features.tfidf_long(_filtered_tokens(spark, sf), "doc_id", "tokens"), "tfidf")


@query
def text_features(spark, sf):
    """Fitted on the train side, applied to the test side."""
    divided = fx.split_reviews(spark, sf)
    model = features.fit_text_features(splits.part(divided, "train"))
    test = model.transform(splits.part(divided, "test"))
    return rounded(_vector_terms(test, "features", features.vocabulary(model), "doc_id"), "value")


@query
def text_features_nonword(spark, sf):
    divided = fx.split_reviews(spark, sf)
    model = features.fit_text_features(splits.part(divided, "train"), tokenizer="nonword")
    test = model.transform(splits.part(divided, "test"))
    return rounded(_vector_terms(test, "features", features.vocabulary(model), "doc_id"), "value")


@query
def tfidf_bigram_l2(spark, sf):
    reviews = fx.reviews(spark, sf)
    model = features.fit_text_features(reviews, tokenizer="ngrams")
    return rounded(_vector_terms(model.transform(reviews), "features", features.vocabulary(model), "doc_id"), "value")


@query
def tfidf_bigram_l2_long(spark, sf):
    grams = fx.reviews(spark, sf).select("doc_id", tx.ngrams_1_2(F.col("Review")).alias("tokens"))
    weighted = features.tfidf_long(grams, "doc_id", "tokens", smooth=True, normalize=True)
    return rounded(weighted.select("doc_id", "term", F.col("tfidf").alias("value")), "value")


@query
def word2vec_fit_transform(spark, sf):
    """Learned on the train side, applied to the test side. A document's vector is the mean of its words'."""
    divided = stage(
        embeddings.embedding_tokens(fx.split_reviews(spark, sf)).select("doc_id", "Sentiment", "words", "split"), "words"
    )
    model = embeddings.fit_word2vec(splits.part(divided, "train"))
    vectors = model.transform(splits.part(divided, "test"))
    known = model.getVectors().select("word", to_array(F.col("vector")).alias("v"))
    spread = vectors.select("doc_id", F.explode_outer("words").alias("word")).join(known, "word", "left")
    total = F.sum(F.coalesce(F.aggregate("v", F.lit(0.0), lambda a, x: a + x), F.lit(0.0)))
    sums = spread.groupBy("doc_id").agg(F.count("word").alias("n"), F.count("v").alias("known"), total.alias("total"))
    own = F.aggregate(to_array(F.col("features")), F.lit(0.0), lambda a, x: a + x)
    is_mean = (F.abs(own - F.col("total") / F.col("n")) < 0.001).alias("is_mean")
    label = labels.binary_label(F.col("Sentiment")).alias("Sentiment")
    return vectors.join(sums, "doc_id").select(
        "doc_id", label, F.size(to_array(F.col("features"))).alias("dims"), "n", "known", is_mean
    )


@query
def word_vector_table(spark, sf):
    words = stage(embeddings.embedding_tokens(fx.documents(spark, sf), "text").select("words"), "words")
    vectors = embeddings.word_vector_table(embeddings.fit_word2vec(words))
    length = F.aggregate(to_array(F.col("vector")), F.lit(0.0), lambda a, x: a + x * x)
    return vectors.select("word", F.size(to_array(F.col("vector"))).alias("dims"), (length > 0).alias("learned"))


@query
def pretrained_doc_vectors(spark, sf):
    words = stage(fx.doc_words(spark, sf), "words")
    lexicon = stage(fx.lexicon(spark, sf, words), "lexicon")
    vectors = embeddings.pretrained_doc_vectors(words, lexicon, fx.LEXICON_DIM)
    return vectors.select("doc_id", checksum(to_array(F.col("features"))).alias("total"))


@query
def batch_encode_text(spark, sf):
    encoded = embeddings.batch_encode_text(fx.documents(spark, sf), embeddings.hashing_encoder(16), "text")
    values = F.posexplode(to_array(F.col("features"))).alias("place", "value")
    return encoded.select("doc_id", values)


@query
def batch_encode_truncated(spark, sf):
    """The encoder reads 128 words of a text, in batches of 512 padded words."""
    encoded = embeddings.batch_encode_text(
        fx.documents(spark, sf), embeddings.hashing_encoder(16), "text", token_budget=512, max_tokens=128
    )
    return encoded.select("doc_id", F.posexplode(to_array(F.col("features"))).alias("place", "value"))


@query
def array_vector_convert(spark, sf):
    vectors = fx.table(spark, sf, "embeddings").select("vec_id", to_vector(F.col("embedding")).alias("v"))
    values = F.posexplode(to_array(F.col("v"))).alias("place", "value")
    return rounded(vectors.select("vec_id", values), "value")


# --- models --------------------------------------------------------------------------------------


def _support(rows: DataFrame, *more: str) -> DataFrame:
    """Of comparison rows, what the tables fix whatever was learned: rows of both classes, and whether the
    accuracy is the one of the matrix."""
    right, total = F.col("TN") + F.col("TP"), F.col("TN") + F.col("FP") + F.col("FN") + F.col("TP")
    return rows.select(
        "Method",
        (F.col("TN") + F.col("FP")).alias("negatives"),
        (F.col("FN") + F.col("TP")).alias("positives"),
        (F.abs(F.col("Accuracy") - right / total) < 0.000051).alias("accuracy_fits"),
        *more,
    )


def _sound_rows(model, test: DataFrame) -> int:
    """Rows whose probabilities add up to 1, and whose prediction is the likelier class."""
    p = to_array(F.col("probability"))
    likelier = F.col("prediction") == F.when(p[1] > p[0], 1.0).otherwise(0.0)
    return model.transform(test).agg(F.count_if((F.abs(p[0] + p[1] - 1) < 1e-9) & likelier)).first()[0]


def _one_model(name: str, make: Callable, method: str, learned: Callable) -> None:
    """Test rows by class of a model on text features, and what the same method learns from small counts."""

    def run(spark, sf):
        train, test, _ = models.prepare_features(*fx.train_test(spark, sf))
        fitted = models.fit_all({method: make()}, train)
        rows = metrics.metrics_rows(models.score_models(fitted, test))
        rows = _support(rows).withColumn("sound_rows", F.lit(_sound_rows(fitted[method], test)).cast("long"))
        return rows.withColumns({n: F.lit(v) for n, v in learned(fx.counted_reviews(spark, sf)).items()})

    run.__name__ = name
    query(run)


def _coefficients(estimator):
    """Intercept and coefficients on two counts, fitted to a tolerance at which four digits are settled."""

    def learned(table):
        model = estimator().setTol(1e-13).setFeaturesCol("two").fit(table)
        named = {"intercept": model.intercept} | {f"coefficient_{i}": c for i, c in enumerate(model.coefficients)}
        return {n: round(float(v), 4) for n, v in named.items()}

    return learned


def _first_split(estimator, value: Callable[[], Column], tree: Callable = lambda model: model):
    """The root split of a one-level tree on three counts, and the value of both leaves."""

    def learned(table):
        model = estimator().fit(table)
        feature, threshold = models.root_split(tree(model))
        left = F.col("x")[feature] <= threshold
        leaves = model.transform(table).agg(F.max(F.when(left, value())), F.max(F.when(~left, value()))).first()
        return {"feature": feature, "threshold": threshold, "left": round(leaves[0], 6), "right": round(leaves[1], 6)}

    return learned


def _share() -> Column:
    return to_array(F.col("probability"))[1]


def _margin() -> Column:
    return to_array(F.col("rawPrediction"))[1]


_one_model("lr_unweighted", models.lr_unweighted, "Logistic Regression", _coefficients(models.lr_unweighted))
_one_model("lr_weighted", models.lr_weighted, "Logistic Regression (Baseline)", _coefficients(models.lr_weighted))
_one_model("dt_weighted", models.dt_weighted, "Decision Tree (Weighted)", _first_split(lambda: models.dt_weighted(max_depth=1), _share))
_one_model(
    "rf_weighted", models.rf_weighted, "Random Forest (Weighted)", _first_split(lambda: models.rf_weighted(num_trees=1, max_depth=1).setBootstrap(False), _share)
)
_one_model(
    "gbt_plain",
    models.gbt_plain,
    "Gradient Boosting",
    _first_split(lambda: models.gbt_plain(max_iter=1, max_depth=1), _margin, lambda model: model.trees[0]),
)


@query
def compare_classic_models(spark, sf):
    return _support(models.compare_classic_models(*fx.train_test(spark, sf)))


@query
def bigram_model_suite(spark, sf):
    divided = fx.payload_reviews(spark, sf)
    return _support(models.bigram_model_suite(splits.part(divided, "train"), splits.part(divided, "test")))


@query
def lr_on_embeddings(spark, sf):
    """Three kinds of document vectors: learned on the train side, averaged from a lexicon, and encoded."""
    sentiment = labels.binary_label(F.col("Sentiment")).alias("Sentiment")
    divided = stage(
        fx.split_reviews(spark, sf).select("doc_id", "Review", sentiment, "split", tx.embed_clean_tokens(F.col("Review")).alias("words")),
        "divided",
    )
    model = embeddings.fit_word2vec(splits.part(divided, "train").select("words"))
    lexicon = stage(fx.lexicon(spark, sf), "lexicon")
    averaged = embeddings.pretrained_doc_vectors(divided.select("doc_id", "words"), lexicon, fx.LEXICON_DIM)
    vectors = {
        "Word2Vec": model.transform(divided),
        "GloVe": divided.join(averaged, "doc_id"),
        "BERT": embeddings.batch_encode_text(divided, embeddings.hashing_encoder(16)),
    }
    rows = []
    for method, table in vectors.items():
        written = stage(table.select("doc_id", "Sentiment", "split", "features"), "doc-vectors")
        rows.append(models.lr_on_embeddings(splits.part(written, "train"), splits.part(written, "test"), method))
    together = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return _support(together, F.col("AUC").between(0, 1).alias("auc_in_range"))


#: Candidates of one level, whose mean scores SQL can compute: what each method's grid varies, over folds of counts.
CV_GRIDS = {
    "cv_decision_tree": {"maxDepth": [1], "impurity": ["gini"], "maxBins": [128], "minInstancesPerNode": [1, 7, 60], "minInfoGain": [0.0]},
    "cv_random_forest": {"maxDepth": [1], "numTrees": [1], "bootstrap": [False], "featureSubsetStrategy": ["all"], "minInfoGain": [0.0, 0.02], "minInstancesPerNode": [2, 40]},
    "cv_gbt": {"maxDepth": [1], "maxIter": [1], "weightCol": ["classWeight"], "minInstancesPerNode": [1, 30]},
}


def _tuned(name: str, tune: Callable) -> None:
    def run(spark, sf):
        tuned = tune(fx.counted_reviews(spark, sf), CV_GRIDS[name])
        return rounded(tuned.scores.select("candidate", "score", "best"), "score")

    run.__name__ = name
    query(run)


_tuned("cv_decision_tree", tuning.cv_decision_tree)
_tuned("cv_random_forest", tuning.cv_random_forest)
_tuned("cv_gbt", tuning.cv_gbt)


@query
def best_params(spark, sf):
    """The tuned parameters of the winning decision tree."""
    tuned = tuning.cv_decision_tree(fx.counted_reviews(spark, sf), CV_GRIDS["cv_decision_tree"])
    return tuning.best_params(tuned).filter("tuned").select("param", "value")


@query
def stratified_folds(spark, sf):
    return fx.counted_reviews(spark, sf).select("doc_id", F.col("label").cast("int").alias("label"), "fold")


def _as_vector(*elements: Column) -> Column:
    return to_vector(F.array(*elements))


@query
def positive_probability(spark, sf):
    p = F.col("pos_prob")
    vectors = _event_probabilities(spark, sf).select("event_id", _as_vector(1 - p, p).alias("probability"))
    return rounded(vectors.select("event_id", vec.positive_probability(F.col("probability")).alias("pos_prob")), "pos_prob")


@query
def margin_to_probability(spark, sf):
    margin = (F.col("score") - 40) / 10
    raw = fx.event_scores(spark, sf).select("event_id", _as_vector(-margin, margin).alias("rawPrediction"))
    once = vec.margin_to_probability(F.col("rawPrediction")).alias("prob")
    twice = vec.margin_to_probability(F.col("rawPrediction"), mllib_scale=True).alias("prob_mllib")
    return rounded(raw.select("event_id", once, twice), "prob", "prob_mllib")


@query
def soft_vote(spark, sf):
    score = F.col("score")
    given = fx.event_scores(spark, sf).select(
        "event_id",
        (score / (score + 5.0)).alias("rf"),
        (score / (score + 20.0)).alias("gbt"),
        (score / (score + 80.0)).alias("lr"),
    )
    voted = imbalance.soft_vote(given, {"rf": "rf", "gbt": "gbt", "lr": "lr"})
    return rounded(voted.select("event_id", "ensemble_prob", "prediction"), "ensemble_prob")


@query
def weighted_ensemble(spark, sf):
    train, test = _nonword_features(spark, sf)
    return _support(imbalance.weighted_ensemble(train, test))


def _nonword_features(spark, sf):
    return _features_of(*fx.aligned_train_test(spark, sf))


def _features_of(train, test):
    model = features.fit_text_features(train, "text", "nonword")
    columns = ["doc_id", "label", "features"]
    return (
        stage(model.transform(train).select(*columns), "train-features"),
        stage(model.transform(test).select(*columns), "test-features"),
    )


@query
def threshold_sweep(spark, sf):
    events = fx.event_scores(spark, sf).select("label", (F.col("score") / (F.col("score") + 30.0)).alias("score"))
    return rounded(thresholds.threshold_sweep(events), "threshold", "f1")


@query
def best_threshold(spark, sf):
    events = fx.event_scores(spark, sf).select("label", (F.col("score") / (F.col("score") + 30.0)).alias("score"))
    return rounded(thresholds.best_threshold(thresholds.threshold_sweep(events)), "threshold", "f1")


@query
def threshold_moving(spark, sf):
    rows = imbalance.threshold_moving(*_nonword_features(spark, sf))
    return _support(rows, F.col("Threshold").isin(*thresholds.threshold_grid()).alias("threshold_in_grid"))


@query
def smote_oversample(spark, sf):
    made = sampling.smote_oversample(fx.embedding_classes(spark, sf), "vec_id", minority=1, details=True)
    return made.select("draw", "base", "neighbor", F.round("gap", 6).alias("gap"), checksum(F.col("features")).alias("total"))


@query
def smote_balance(spark, sf):
    balanced = sampling.smote_oversample(fx.embedding_classes(spark, sf), "vec_id")
    return balanced.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count("vec_id").alias("original"))


@query
def smote_lr(spark, sf):
    return _support(imbalance.smote_lr(*_nonword_features(spark, sf)))


@query
def pseudo_label(spark, sf):
    rows = imbalance.pseudo_label(*fx.aligned_train_test(spark, sf))
    added = F.col("pseudo_positive") + F.col("pseudo_negative")
    adds_up = (F.col("augmented_rows") == F.col("labeled_rows") + added).alias("adds_up")
    return _support(rows, F.col("labeled_rows").cast("long").alias("labeled_rows"), adds_up)


# --- whole flows ---------------------------------------------------------------------------------


@query
def final_comparison(spark, sf):
    """The plain model and the four ways to deal with imbalance, side by side."""
    sides = fx.aligned_train_test(spark, sf)
    train, test = _features_of(*sides)
    plain = models.lr_unweighted().fit(train).transform(test).withColumn("Method", F.lit("Plain model"))
    rows = [
        metrics.metrics_rows(plain),
        imbalance.smote_lr(train, test),
        imbalance.weighted_ensemble(train, test),
        imbalance.threshold_moving(train, test),
        imbalance.pseudo_label(*sides),
    ]
    columns = ["Method", "Accuracy", "Precision", "Recall", "F1", "TN", "FP", "FN", "TP"]
    together = rows[0].select(columns)
    for more in rows[1:]:
        together = together.unionByName(more.select(columns))
    return _support(together)


@query
def baseline_flow(spark, sf):
    """From a CSV file of raw reviews to a CSV file of results, which is read back."""
    source, target = scratch_path(spark, "raw-csv"), scratch_path(spark, "results-csv")
    writers.write_csv(fx.raw_reviews(spark, sf).select("Review", "Rating"), source)
    reviews = labels.label_from_rating(cleaning.clean_reviews(readers.read_reviews_csv(spark, source)))
    divided = stage(splits.stable_split(reviews, method="md5"), "split", partition_by="split")
    train, test, _ = models.prepare_features(splits.part(divided, "train"), splits.part(divided, "test"))
    fitted = models.fit_all({"Baseline": models.lr_weighted()}, train)
    writers.write_csv(metrics.metrics_rows(models.score_models(fitted, test)), target, single_file=True)
    schema = "Method string, Accuracy double, TN long, FP long, FN long, TP long"
    return _support(readers.read_reviews_csv(spark, target, T.StructType.fromDDL(schema)))


@query
def load_or_build(spark, sf):
    """A table that is built once, read from its file the second time, and built again for another version."""
    path, built = scratch_path(spark, "class-counts"), []
    inputs = [f"{sf}/{name}.parquet" for name in ("documents", "labels")]

    def build():
        built.append(1)
        return stats.class_counts(fx.labelled(spark, sf))

    for version in ("1", "1", "2"):
        table = readers.load_or_build(spark, path, build, inputs=inputs, version=version)
    return table.withColumn("built", F.lit(len(built)))
