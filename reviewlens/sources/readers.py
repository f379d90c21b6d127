"""Readers."""

from __future__ import annotations

import contextlib
import hashlib
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.sources.csv_records import csv_records

RAW_REVIEWS = T.StructType([T.StructField("Review", T.StringType()), T.StructField("Rating", T.StringType())])

# Fixed value: the line an embedding evaluation prints.
METRICS_LINE = (
    r"(?i)(Word2Vec|GloVe|BERT)\s*-\s*Acc:\s*([0-9.]+),\s*Pre:\s*([0-9.]+),"
    r"\s*Rec:\s*([0-9.]+),\s*F1:\s*([0-9.]+)"
)
EMBEDDING_METHODS = ("Word2Vec", "GloVe", "BERT")


_CSV = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "nullValue": "\u0000",  # by default it equals the empty string, and both are read as null
    "enforceSchema": False,  # headers are compared with the first one
}


def read_reviews_csv(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = RAW_REVIEWS, multi_line: bool = True
) -> DataFrame:
    """CSV with a header. Quoted fields may hold newlines and doubled quotes.

    ``schema`` names the wanted columns; ``None`` infers all, and then a file is one task. Each path of a list is
    read by its own header, in which columns stand in any order and among others, and a wanted column that a
    path has not is null. The files of one path must have the same header: another one is an error, not a mix-up.
    An empty field is null, a quoted empty field an empty string.

    A file is cut into records by many tasks, whether fields hold newlines or not, see ``csv_records``.
    ``multi_line=False`` saves the pass that looks for them, where there are none.
    """
    if schema is None:
        return spark.read.options(**_CSV, multiLine=multi_line, inferSchema=True).csv(path)
    parts = []
    for one in [path] if isinstance(path, str) else path:
        as_text = spark.read.options(**_CSV, multiLine=multi_line, inferSchema=False).csv(one)
        fields = _parsed_records(spark, one, as_text.columns) if multi_line else as_text
        there = {f.name: F.col(f"`{f.name}`") if f.name in as_text.columns else F.lit(None) for f in schema.fields}
        parts.append(fields.select(*[there[f.name].try_cast(f.dataType).alias(f.name) for f in schema.fields]))
    return reduce(DataFrame.unionByName, parts)


def _parsed_records(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Records of the files of one path as strings under ``columns``, the header of its first file."""
    if not columns:
        return spark.createDataFrame([], T.StructType([]))
    names = [f"c{i}" for i in range(len(columns))]
    options = {name: str(value) for name, value in _CSV.items() if name not in ("header", "enforceSchema")} | {"multiLine": "true"}
    parsed = F.from_csv("record", F.lit(", ".join(f"{name} string" for name in names)), options)
    rows = csv_records(spark, path).select("file", "header", parsed.alias("r"))
    found = F.array(*[F.coalesce(f"r.{name}", F.lit("")) for name in names])
    message = F.concat(F.lit("another header in "), F.col("file"), F.lit(": "), F.array_join(found, ","))
    # Spark names columns without a name _c0, _c1, ..., and appends the number to a repeated name.
    other = [
        (found[i] != c) & (F.concat(found[i], F.lit(str(i))) != c) & ((found[i] != "") | F.lit(c != f"_c{i}"))
        for i, c in enumerate(columns)
    ]
    checked = F.when(F.col("header") & reduce(or_, other), F.raise_error(message)).otherwise(F.col("header"))
    return rows.filter(~checked.cast("boolean")).select(*[F.col(f"r.{name}").alias(c) for name, c in zip(names, columns)])


def read_vectors(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.parquet(*paths)
    return df.select(*columns) if columns else df


def read_word_vectors(spark: SparkSession, path: str | Sequence[str], dim: int) -> DataFrame:
    """``word v1 ... vn`` lines as ``(word, vector)``; another number of fields is an error.

    Of lines with the same word the last one counts, as when a dictionary is filled from them.
    """
    parts = F.split(F.trim("value"), r"\s+")
    lines = spark.read.text(path).filter(F.trim("value") != "").select(parts.alias("parts"))
    size = F.size("parts")
    checked = F.when(size == dim + 1, F.col("parts")).otherwise(
        F.raise_error(F.concat(F.lit(f"expected a word and {dim} numbers, found fields: "), size.cast("string")))
    )
    numbered = lines.select(checked.alias("parts"), F.monotonically_increasing_id().alias("line"))
    return numbered.groupBy(F.col("parts")[0].alias("word")).agg(
        F.max_by(F.slice("parts", 2, dim).cast("array<float>"), "line").alias("vector")
    )


# Fixed value: the parts of a notebook file that hold printed results.
_NOTEBOOK = (
    "notebook string, cells array<struct<outputs: array<struct<text: string, data: struct<`text/plain`: string>>>>>"
)


def read_notebooks(spark: SparkSession, path: str | Sequence[str], multi_line: bool = True) -> DataFrame:
    """Saved notebooks as ``(notebook, cells)``; the file path names a notebook without a name.

    ``text`` is read as a string either way: a JSON list arrives as its JSON text.
    ``multi_line=False`` reads one notebook per line.
    """
    df = spark.read.schema(_NOTEBOOK).json(path, multiLine=multi_line)
    return df.withColumn("notebook", F.coalesce("notebook", F.input_file_name()))


def _joined_chunks(chunk):
    """A string, or a JSON list of strings joined by newlines."""
    listed = F.from_json(F.when(chunk.startswith("["), chunk), "array<string>")
    return F.coalesce(F.array_join(listed, "\n"), chunk)


def extract_metrics(
    notebooks: DataFrame, pattern: str = METRICS_LINE, required: Sequence[str] = EMBEDDING_METHODS
) -> DataFrame:
    """``(notebook, model, accuracy, precision, recall, f1)`` from printed result lines.

    The last line of a model counts. A notebook without a line for each ``required`` model is an
    error. ``pattern`` has five groups: the model and its four figures.
    """
    outputs = notebooks.select("notebook", F.posexplode("cells").alias("cell", "content")).select(
        "notebook", "cell", F.posexplode("content.outputs").alias("output", "out")
    )
    text = F.concat_ws("\n", _joined_chunks(F.col("out.text")), _joined_chunks(F.col("out.data.`text/plain`")))
    lines = outputs.select(
        "notebook",
        "cell",
        "output",
        F.posexplode_outer(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("match", "line"),
    ).filter(F.col("line").isNotNull())
    figures = ("accuracy", "precision", "recall", "f1")
    parsed = lines.select(
        "notebook",
        F.regexp_extract("line", pattern, 1).alias("model"),
        F.struct("cell", "output", "match").alias("position"),
        F.struct(
            *[
                F.round(F.regexp_extract("line", pattern, group).cast("double"), 4).alias(name)
                for group, name in enumerate(figures, start=2)
            ]
        ).alias("figures"),
    )
    last = parsed.groupBy("notebook", "model").agg(F.max_by("figures", "position").alias("figures"))
    if required:
        found = F.collect_set("model").over(W.partitionBy("notebook"))
        missing = F.array_except(F.array(*[F.lit(name) for name in required]), found)
        message = F.concat(F.lit("no result line for "), F.array_join(missing, ", "), F.lit(" in "), F.col("notebook"))
        last = last.withColumn(
            "figures", F.when(F.size(missing) == 0, F.col("figures")).otherwise(F.raise_error(message))
        ).filter(F.col("model").isin(list(required)))
    return last.select("notebook", "model", "figures.*")


def read_if_present(spark: SparkSession, paths: Mapping[str, str], format: str = "parquet") -> dict[str, DataFrame]:
    """The named tables that exist; a missing path is left out, any other error is raised."""
    found = {}
    for name, path in paths.items():
        try:
            found[name] = spark.read.format(format).load(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return found


_FINGERPRINT = "_fingerprint"  # a file beside the data; readers skip names with an underscore


def input_fingerprint(spark: SparkSession, paths: Sequence[str], version: str = "") -> str:
    """A digest of the names, sizes and times of all files below ``paths``, and of the builder's ``version``.

    Only the listing is read. A path that does not exist counts as one without files.
    """
    digest = hashlib.sha256(version.encode())
    hadoop = spark._jvm.org.apache.hadoop.fs
    for path in sorted(paths):
        root = hadoop.Path(path)
        files = root.getFileSystem(spark._jsc.hadoopConfiguration())
        digest.update(f"|{path}".encode())
        if not files.exists(root):
            continue
        found, listing = [], files.listFiles(root, True)
        while listing.hasNext():
            status = listing.next()
            found.append(f"{status.getPath().toString()}:{status.getLen()}:{status.getModificationTime()}")
        digest.update("|".join(sorted(found)).encode())
    return digest.hexdigest()


def _published(files, folder, fingerprint: str) -> bool:
    """Whether a complete result with this fingerprint lies in the folder."""
    mark = folder.suffix(f"/{_FINGERPRINT}")
    if not files.exists(mark):
        return False
    with contextlib.closing(files.open(mark)) as stream:
        return bytes(stream.readAllBytes()).decode() == fingerprint


def load_or_build(
    spark: SparkSession, path: str, build, format: str = "json", inputs: Sequence[str] = (), version: str = ""
) -> DataFrame:
    """The table at ``path`` if it is complete and its ``inputs`` are unchanged, else the result of ``build()``.

    A result is written beside ``path`` with the fingerprint of its inputs, and renamed only when it is
    whole: a writer that dies leaves the old result, or none, and a half-written, foreign or stale folder is
    built again. ``version`` names the builder; another one makes a result stale. The fingerprint is taken before
    building, so that an input that changes meanwhile is noticed the next time. What replaces a table that is
    being read makes that reader fail rather than mix both. On object stores, whose renames copy, use a table format.
    """
    fingerprint = input_fingerprint(spark, inputs, version)
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not _published(files, target, fingerprint):
        aside = target.suffix(f".{uuid.uuid4().hex}")
        build().write.format(format).save(aside.toString())
        with contextlib.closing(files.create(aside.suffix(f"/{_FINGERPRINT}"))) as stream:
            stream.write(bytearray(fingerprint.encode()))
        files.delete(target, True)
        if not files.rename(aside, target) and not _published(files, target, fingerprint):
            raise OSError(f"could not move {aside.toString()} to {path}")
        files.delete(aside, True)  # left where another writer was first
    return spark.read.format(format).load(path)


def rows_to_frame(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` with its types and order; arrays become vectors where it says so.

    Typed rows are made by converting columns in place, never by sending rows through the driver.
    """
    from pyspark.ml.linalg import VectorUDT

    from reviewlens.functions.vectors import to_vector

    def typed(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, VectorUDT):
            already = isinstance(df.schema[field.name].dataType, VectorUDT)
            return (column if already else to_vector(column)).alias(field.name)
        return column.cast(field.dataType).alias(field.name)

    return df.select(*[typed(field) for field in schema.fields])
