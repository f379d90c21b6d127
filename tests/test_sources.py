"""Readers and sinks."""

import json
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from reviewlens.session import clear_staged, scratch_path, shared_folder, stage
from reviewlens.sources import readers, writers
from reviewlens.sources.csv_records import csv_records


def test_csv_round_trip(spark):
    rows = [('say "hi", twice', "4"), ("two\nlines", None), ("  padded ", "n/a"), ("", "1"), (None, "2"), ("a\\b", "3")]
    df = spark.createDataFrame(rows, "Review string, Rating string")
    path = scratch_path(spark, "csv")
    writers.write_csv(df, path)
    assert sorted(map(str, readers.read_reviews_csv(spark, path).collect())) == sorted(map(str, df.collect()))
    inferred = readers.read_reviews_csv(spark, path, schema=None)
    assert inferred.columns == ["Review", "Rating"]


def test_csv_from_elsewhere(spark, tmp_path):
    file = tmp_path / "reviews.csv"
    file.write_text('id,Rating,Review\n1,3.0,"He said ""no""\nand left"\n2,abc,plain\n')
    got = readers.read_reviews_csv(spark, str(file)).collect()
    assert sorted(tuple(r) for r in got) == [('He said "no"\nand left', "3.0"), ("plain", "abc")]


def test_csv_headers_of_each_path(spark, tmp_path):
    texts = {"a": "Review,Rating\nt1,5\n", "b": "Rating,Review\n4,t2\n", "c": "id,Review\n7,t3\n", "d": "Rating,extra,Review\n1,x,t4\n"}
    paths = []
    for name, text in texts.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "part.csv").write_text(text)
        paths.append(str(tmp_path / name))
    got = sorted(tuple(r) for r in readers.read_reviews_csv(spark, paths).collect())
    assert got == [("t1", "5"), ("t2", "4"), ("t3", None), ("t4", "1")]
    for multi_line in (True, False):
        with pytest.raises(Exception, match="FAILED_READ_FILE|another header"):
            readers.read_reviews_csv(spark, str(tmp_path / "[ab]"), multi_line=multi_line).collect()


def plain_csv(spark, path):
    """Spark's own reader, one task for a file."""
    options = dict(header=True, multiLine=True, escape='"', nullValue="\0", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return spark.read.options(**options).csv(path)


@pytest.mark.parametrize("size", ["64", "333", "4096", "128m"])
def test_one_file_is_read_by_many_tasks(spark, tmp_path, size):
    """Newlines, quotes and long fields at every place of a range boundary: the rows of Spark's own reader."""
    pick = random.Random(3)
    fields = ["plain", "", '""', '"a\nb"', '"say ""hi""\n\n\nand ""go"""', '"' + "long line\n" * 30 + '"', "é ß", '"x,y"', '"\r\n in crlf"', '"""\n"""']
    text = "id,Review,Rating\n" + "".join(f"{i},{pick.choice(fields)},{pick.choice(fields)}\n" for i in range(400))
    (tmp_path / "one.csv").write_bytes(text.encode())
    (tmp_path / "two.csv").write_bytes(b'id,Review,Rating\r\n7,"a\nb",\r\n\r\n8,"c",d')
    path = str(tmp_path / "*.csv")
    want = sorted(map(str, plain_csv(spark, path).select("Review", "Rating").collect()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        read = readers.read_reviews_csv(spark, path)
        ranges = csv_records(spark, path).rdd.getNumPartitions()
        assert sorted(map(str, read.collect())) == want and len(want) == 402
        assert ranges > 10 or size in ("4096", "128m")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_unclosed_and_empty_files(spark, tmp_path):
    (tmp_path / "open.csv").write_text('Review,Rating\na,1\nb,"never\nclosed\n')
    (tmp_path / "bare.csv").write_text("Review,Rating\n")
    (tmp_path / "empty.csv").write_text("")
    assert readers.read_reviews_csv(spark, str(tmp_path / "open.csv")).count() == 2
    assert readers.read_reviews_csv(spark, str(tmp_path / "bare.csv")).count() == 0
    assert readers.read_reviews_csv(spark, str(tmp_path / "empty.csv")).count() == 0


def test_last_word_vector_counts(spark, tmp_path):
    file = tmp_path / "vectors.txt"
    file.write_text("a 1 1\na 3 3\nb 10 10\n")
    assert {r["word"]: r["vector"] for r in readers.read_word_vectors(spark, str(file), 2).collect()} == {"a": [3.0, 3.0], "b": [10.0, 10.0]}


def test_word_vectors(spark, tmp_path):
    good, bad = tmp_path / "good.txt", tmp_path / "bad.txt"
    good.write_text("the 0.5 -1 2e-3\n\ncafé 1 2 3\n")
    bad.write_text("the 0.5 -1\n")
    got = {r["word"]: r["vector"] for r in readers.read_word_vectors(spark, str(good), 3).collect()}
    assert got["café"] == [1.0, 2.0, 3.0] and got["the"][1] == -1.0
    with pytest.raises(PySparkException):
        readers.read_word_vectors(spark, str(bad), 3).collect()


def notebook(*lines):
    line = "{} - Acc: {}, Pre: 0.1, Rec: 0.2, F1: 0.3"
    outputs = [{"text": [line.format(m, a) + "\n", "x"]} if i % 2 else {"data": {"text/plain": line.format(m, a)}} for i, (m, a) in enumerate(lines)]
    return {"cells": [{"cell_type": "markdown"}, {"outputs": outputs}], "nbformat": 4}


def test_notebooks(spark, tmp_path):
    file = tmp_path / "run.ipynb"
    record = notebook(("Word2Vec", 0.5), ("GloVe", 0.6), ("BERT", 0.7), ("Word2Vec", 0.91239))
    file.write_text(json.dumps(record, indent=1))
    got = readers.extract_metrics(readers.read_notebooks(spark, str(file))).collect()
    assert {r["model"]: r["accuracy"] for r in got} == {"Word2Vec": 0.9124, "GloVe": 0.6, "BERT": 0.7}
    file.write_text(json.dumps(notebook(("Word2Vec", 0.5)), indent=1))
    with pytest.raises(PySparkException, match="no result line for GloVe, BERT"):
        readers.extract_metrics(readers.read_notebooks(spark, str(file))).collect()


def test_present_and_absent(spark):
    path = scratch_path(spark, "there")
    spark.range(3).write.parquet(path)
    assert set(readers.read_if_present(spark, {"a": path, "b": path + "-not"})) == {"a"}
    built = []

    def build():
        built.append(1)
        return spark.range(4)

    target = scratch_path(spark, "payload")
    for _ in range(2):
        assert readers.load_or_build(spark, target, build).count() == 4
    assert len(built) == 1


def test_result_is_built_again_when_an_input_changes(spark, tmp_path):
    source, target, built = tmp_path / "in.txt", str(tmp_path / "out"), []
    source.write_text("a")

    def build():
        built.append(1)
        return spark.read.text(str(source))

    def value():
        return [r["value"] for r in readers.load_or_build(spark, target, build, inputs=[str(source)]).collect()]

    assert value() == value() == ["a"] and len(built) == 1
    source.write_text("changed")
    assert value() == value() == ["changed"] and len(built) == 2
    assert readers.load_or_build(spark, target, build, inputs=[str(source)], version="2").count() == 1 and len(built) == 3
    missing = [str(tmp_path / "not-there")]
    assert readers.input_fingerprint(spark, missing) == readers.input_fingerprint(spark, missing)


def test_crashed_writer_leaves_no_result(spark, tmp_path):
    """A writer that dies leaves the old table; a folder without a mark, or with another's, is built again."""
    target = str(tmp_path / "out")

    def dies():
        return spark.range(100).select(F.raise_error(F.lit("dead")).cast("long").alias("v"))

    with pytest.raises(Exception, match="dead"):
        readers.load_or_build(spark, target, dies)
    assert not (tmp_path / "out").exists()
    assert readers.load_or_build(spark, target, lambda: spark.range(3)).count() == 3
    with pytest.raises(Exception, match="dead"):
        readers.load_or_build(spark, target, dies, version="2")
    assert readers.load_or_build(spark, target, dies).count() == 3  # the old result is still whole
    half = str(tmp_path / "half")
    spark.range(5).write.json(half)  # as a writer without publishing would leave it
    assert readers.load_or_build(spark, half, lambda: spark.range(2)).count() == 2


def test_shared_folder(spark):
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    staged = stage(spark.range(5).withColumn("v", F.lit(1.5)), "t")
    assert staged.schema.simpleString() == "struct<id:bigint,v:double>"
    assert folder in staged.inputFiles()[0] and staged.count() == 5


def test_clear_staged(spark):
    table = stage(spark.range(3), "t")
    clear_staged(spark)
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
        table.collect()
