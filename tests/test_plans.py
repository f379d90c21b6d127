"""Plans stay distributed: no row-at-a-time Python, no cross joins, no row-level collects."""

import contextlib
import io
import pathlib
import re

import pytest

import __spark_entry__ as entry
from reviewlens.operators.embeddings import embedding_tokens
from workload import oracle
from workload.fixtures import documents

ROOT = pathlib.Path(__file__).resolve().parent.parent
# Each of these actions brings a bounded number of rows to the driver.
BOUNDED_ACTIONS = {
    "csv_records.py": 1,  # a number for a range of a file at most
    "features.py": 1,  # vocabulary, at most vocab_size terms
    "imbalance.py": 2,  # one threshold; one row of counts before and one after
    "neighbors.py": 5,  # a sample, the probes and a block of points, all of bounded size; one number; a pandas head
    "tuning.py": 2,  # the fold numbers; a mean per candidate
    "sampling.py": 3,  # sizes of at most three classes; one vector; one number
}
LAZY = [
    name
    for name in oracle.statements()
    if not name.startswith(("scan_", "sink_"))
    and name not in ("dataset_payload", "word2vec_fit_transform", "word_vector_table", *oracle.model_rows())
]


def own_files():
    return [file for file in (ROOT / "reviewlens").rglob("*.py") if "llm" not in file.parts]


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_rows_and_no_cross_join(spark, sf, name):
    text = plan(entry.queries()[name](spark, sf))
    for operator in ("BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


def test_actions_are_bounded():
    found = {}
    for file in own_files():
        lines = [line for line in file.read_text().splitlines() if re.search(r"(?<!F)\.(collect|first|head|take|toPandas)\(", line)]
        if lines:
            found[file.name] = len(lines)
    assert found == BOUNDED_ACTIONS


def test_no_local_checkpoint_and_no_rdd_code():
    for file in own_files():
        text = file.read_text()
        assert not re.search(r"localCheckpoint|crossJoin|\.rdd\.(map|flatMap|mapPartitions)", text), file


def test_keywords_are_cut_before_the_shuffle(spark, sf):
    assert "WindowGroupLimit" in plan(entry.queries()["top_keywords"](spark, sf))


def test_only_needed_columns_are_read(spark, sf):
    text = plan(entry.queries()["binary_label"](spark, sf))
    assert re.search(r"ReadSchema: struct<doc_id:bigint,lang:string>", text)
    text = plan(entry.queries()["filter_by_label"](spark, sf))
    assert "PushedFilters: [IsNotNull(doc_id)]" in text


def test_tokens_are_computed_once(spark, sf):
    """A plain explode would make Catalyst compute the tokens in an extra filter as well."""
    for name, function in (("vocab_document_freq", "regexp_replace"), ("top_keywords", "regexp_extract_all")):
        executed = entry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(function, executed)) == 1
    words = embedding_tokens(documents(spark, sf), "text")
    assert len(re.findall("regexp_extract_all", words._jdf.queryExecution().executedPlan().toString())) == 1
