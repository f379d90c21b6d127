"""The given tables in the shapes the operators expect. ``workload.oracle`` holds the same as SQL."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.functions.hashing import md5_number
from reviewlens.functions.text import embed_clean_tokens
from reviewlens.operators.embeddings import word_vocabulary
from reviewlens.operators.labels import align_labels, binary_label, label_from_rating
from reviewlens.operators.splits import part, stable_split
from reviewlens.operators.stats import add_class_weights
from reviewlens.operators.tuning import stratified_fold
from reviewlens.session import stage

CUTS = (500, 1500, 5000)
LEXICON_DIM = 64


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    """Rated reviews: every labelled document."""
    rating = (1 + 3 * F.col("quality") + (1 - F.col("toxic"))).cast("double")
    return (
        documents(spark, sf)
        .join(table(spark, sf, "labels"), "doc_id")
        .select("doc_id", F.col("text").alias("Review"), rating.alias("Rating"), "lang", "n_chars", "quality", "toxic")
    )


def raw_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """Dirty reviews: all documents, unlabelled ones without rating, some blank, padded or unrated,
    and all labelled ones a second time."""
    rating = (1 + 3 * F.col("quality") + (1 - F.col("toxic"))).cast("double").cast("string")
    source = F.col("source")
    review = (
        F.when(source == "src7", F.lit("   "))
        .when(source == "src3", F.concat(F.lit("  "), F.col("text"), F.lit(" ")))
        .when(source != "src11", F.col("text"))
    )
    dirty = (
        documents(spark, sf)
        .join(table(spark, sf, "labels"), "doc_id", "left")
        .select(
            "doc_id",
            review.alias("Review"),
            F.when(source == "src5", F.lit("n/a")).otherwise(rating).alias("Rating"),
        )
    )
    again = reviews(spark, sf).select("doc_id", "Review", F.col("Rating").cast("string").alias("Rating"))
    return dirty.unionByName(again)


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    return label_from_rating(reviews(spark, sf))


def split_reviews(spark: SparkSession, sf: str, method: str = "md5") -> DataFrame:
    return stable_split(labelled(spark, sf), method=method)


def train_test(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Labelled reviews by the MD5 split, which SQL knows too, saved once as users of fixed splits do."""
    columns = ["doc_id", "Review", "Rating", "Sentiment", "split"]
    divided = stage(split_reviews(spark, sf).select(*columns), "split", partition_by="split")
    return part(divided, "train"), part(divided, "test")


def aligned_train_test(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, text, Rating, label)`` with 1 for the negative class, the rarer one."""
    return tuple(align_labels(df, positive_label=0.0, keep=("doc_id",)) for df in train_test(spark, sf))


def payload_reviews(spark: SparkSession, sf: str) -> DataFrame:
    divided = split_reviews(spark, sf)
    return divided.select("doc_id", F.col("Review").alias("text"), binary_label(F.col("Sentiment")).alias("label"), "split")


def counted_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """Rated reviews with three small counts as features, class weights and stratified folds.

    Each count has at most 31 values, so trees consider every split point and SQL can do the same.
    """
    text = F.col("Review")
    stops, lines = (F.length(text) - F.length(F.replace(text, F.lit(c), F.lit(""))) for c in (".", "\n"))
    counts = [F.floor(F.col("n_chars") / 100), stops, lines]
    x = F.array(*(F.least(c, F.lit(30)).cast("double") for c in counts))
    rows = reviews(spark, sf).select("doc_id", F.col("quality").cast("double").alias("label"), x.alias("x"))
    weighted = add_class_weights(stage(rows, "counted"))
    vectors = array_to_vector("x").alias("features"), array_to_vector(F.slice("x", 1, 2)).alias("two")
    return stage(stratified_fold(weighted.select("*", *vectors), ["doc_id"]), "counted-folds")


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Quality predicted from the length, with a score in (0, 1)."""
    return reviews(spark, sf).select(
        "doc_id",
        F.col("quality").alias("label"),
        (F.col("n_chars") > 1500).cast("int").alias("prediction"),
        (F.col("n_chars") / (F.col("n_chars") + 1500.0)).alias("score"),
    )


def method_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """The same by several methods, each with its own length limit."""
    cut = F.explode(F.array(*[F.lit(c) for c in CUTS])).alias("cut")
    return (
        reviews(spark, sf)
        .select(F.col("quality").alias("label"), "n_chars", cut)
        .select(
            F.concat(F.lit("cut_"), F.col("cut").cast("string")).alias("Method"),
            "label",
            (F.col("n_chars") > F.col("cut")).cast("int").alias("prediction"),
        )
    )


def event_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks scored by the event value, with many ties."""
    return table(spark, sf, "events").select(
        "event_id",
        (F.col("event_type") == "click").cast("int").alias("label"),
        F.col("value").alias("score"),
        (F.col("value") > 20).cast("int").alias("prediction"),
    )


def embedding_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors of class 1 (label 0 in the table) against all others."""
    return table(spark, sf, "embeddings").select(
        "vec_id", (F.col("label") == 0).cast("int").alias("label"), F.col("embedding").alias("features")
    )


def doc_words(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select("doc_id", embed_clean_tokens(F.col("text")).alias("words"))


def lexicon(spark: SparkSession, sf: str, words: DataFrame | None = None) -> DataFrame:
    """A vector for every word that occurs twice, picked from the given ones by the word's hash.

    ``words`` is ``doc_words`` if that has been written already.
    """
    vectors = table(spark, sf, "embeddings")
    size = vectors.select(F.count(F.lit(1))).scalar()
    return (
        word_vocabulary(doc_words(spark, sf) if words is None else words)
        .select("word", (md5_number(F.col("word")) % size).alias("vec_id"))
        .join(vectors, "vec_id")
        .select("word", F.col("embedding").alias("vector"))
    )


def notebook_records(spark: SparkSession, sf: str) -> DataFrame:
    """One saved notebook per document, whose outputs print results made from the text length.

    Word2Vec is printed twice; outputs hold a list of lines, one string, or a display value.
    """

    def line(model: str, add: int):
        def figure(times: int):
            return F.format_string("0.%04d", (F.col("n_chars") * times + add) % 10000)

        return F.concat(
            F.lit(f"{model} - Acc: "), figure(1), F.lit(", Pre: "), figure(3), F.lit(", Rec: "), figure(7), F.lit(", F1: "), figure(11)
        )

    def output(text=None, plain=None):
        text = F.lit(None).cast("string") if text is None else text
        plain = F.lit(None).cast("string") if plain is None else plain
        return F.struct(text.alias("text"), F.struct(plain.alias("text/plain")).alias("data"))

    listed = F.to_json(F.array(F.lit("Loading"), line("Word2Vec", 1), line("GloVe", 2)))
    cells = F.array(
        F.struct(F.array(output(line("Word2Vec", 9)), output(text=listed)).alias("outputs")),
        F.struct(F.array(output(plain=line("BERT", 3))).alias("outputs")),
    )
    return documents(spark, sf).select(F.col("doc_id").cast("string").alias("notebook"), cells.alias("cells"))
