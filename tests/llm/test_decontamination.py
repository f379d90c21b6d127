import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlens.llm.decontamination import _Hashes, contamination, window_prints, words_of
from tests.llm.fixtures import TEXTS, clashing_documents, edge_documents, empty_documents, prose
from tests.llm.test_dedup import ascii_lower

ITEMS = "item_id long, text string"


def plain(docs, items, window=10):
    """Brute force: every window of every item looked for at every place of every text."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    found = []
    windows = []
    for item, text in items:
        words = word.findall(ascii_lower(text))
        size = min(window, len(words))
        windows += [(item, words[s : s + size]) for s in range(len(words) - size + 1) if size]
    for doc, text in docs:
        words = word.findall(ascii_lower(text))
        hit, ids = set(), set()
        for item, part in windows:
            for s in range(len(words) - len(part) + 1):
                if words[s : s + len(part)] == part:
                    hit.update(range(s, s + len(part)))
                    ids |= {str(item)} if item is not None else set()
        found.append((doc, len(words), len(hit), tuple(sorted(ids))))
    return sorted(found, key=repr)


def found(frame):
    rows = frame.collect()
    for r in rows:
        assert r["n_hit"] == sum(s["end"] - s["start"] for s in r["spans"])
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))
    return sorted(((r[0], r["n_words"], r["n_hit"], tuple(r["item_ids"])) for r in rows), key=repr)


def planted():
    pick = random.Random(7)
    items = [(i, prose(1000 + i, 12 + i % 40)) for i in range(30)]
    items += [(30, "three short words"), (31, "one"), (32, prose(1005, 10)), (33, ""), (34, None), (35, "!!! ..."), (None, prose(900, 15)),
              (36, "first text of a repeated id with some more words in it"), (36, prose(901, 20)), (37, prose(901, 20)), (38, "a a a a a a a a a a a a")]
    docs = list(TEXTS)
    for n in range(120):
        words = prose(n, pick.randrange(5, 200)).split()
        for _ in range(pick.randrange(3)):
            item = pick.choice([t for _, t in items if t]).split()
            start = pick.randrange(len(item))
            part = item[start : start + pick.randrange(1, 30)]
            at = pick.randrange(len(words))
            words[at:at] = [w.upper() if pick.random() < 0.3 else w for w in part]
        docs.append((100 + n, pick.choice([" ", ", ", "\n"]).join(words)))
    docs += [(500, prose(901, 20)), (501, "A a. A a a a a a a a a a a a a a"), (502, "ONE"), (503, prose(1000, 12)[:-1])]
    return docs, items


@pytest.mark.parametrize("bits", [2**10, 2**27])
def test_same_as_brute_force(spark, bits):
    docs, items = planted()
    got = contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS), max_filter_bits=bits
    )
    want = plain(docs, items)
    assert sum(r[2] > 0 for r in want) > 30 and sum(r[2] == 0 for r in want) > 20
    assert found(got) == want


def test_edges_and_clashing_names(spark):
    items = spark.createDataFrame([(1, prose(2, 30)), (1, prose(2, 30)), (2, prose(1, 12))], ITEMS).withColumn("windows", F.lit(1))
    docs = clashing_documents(spark).withColumns({c: F.lit("x") for c in ("text_key", "windows", "n_hit", "spans", "item")})
    assert found(contamination(docs, items)) == plain(TEXTS, [(1, prose(2, 30)), (2, prose(1, 12))])
    assert contamination(empty_documents(spark), items).count() == 0
    assert {r["n_hit"] for r in contamination(edge_documents(spark), spark.createDataFrame([], ITEMS)).collect()} == {0}


def test_shared_window_shares_a_fingerprint():
    """Whatever surrounds ten equal words, both sides keep the same fingerprint; few are kept."""
    hashes = _Hashes()
    shared = prose(5, 10)
    left, right = f"{prose(6, 40)} {shared} {prose(7, 33)}", f"{prose(8, 9)} {shared}"
    a, b = (window_prints(hashes.of(words_of(t.encode())), 10) for t in (left, right))
    assert a[40] == b[9]
    many = window_prints(np.random.default_rng(1).integers(0, 2**63, 100_000).astype(np.uint64), 10)
    assert 0.26 < len(set(many.tolist())) / len(many) < 0.31  # two of seven grams


def test_work_stays_linear_when_a_passage_is_everywhere(spark):
    """A passage of every item in every document: joined rows grow with documents plus items, not with pairs."""
    passage = prose(3, 12)
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit(passage), F.col("id").cast("string")).alias("text"))
    items = spark.range(50).select(F.col("id").alias("item_id"), F.concat_ws(" ", F.lit(passage), (F.col("id") + 1000).cast("string")).alias("text"))
    rows = contamination(docs, items).select("n_hit", F.size("item_ids").alias("n")).distinct().collect()
    assert [tuple(r) for r in rows] == [(12, 50)]
