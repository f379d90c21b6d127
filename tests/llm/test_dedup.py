import hashlib
import random

import numpy as np
import pytest

from reviewlens.llm import near_dedup as near
from reviewlens.llm.components import connected_components
from reviewlens.llm.exact_dedup import exact_dedup
from reviewlens.llm.line_dedup import line_classes, line_dedup, within
from tests.llm.fixtures import TEXTS, clashing_documents, edge_documents, empty_documents, prose, rows


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("bits", [2**10, 2**27])
def test_exact_dedup_is_grouping_by_text(spark, bits):
    groups = {}
    for doc, text in set(TEXTS):
        groups.setdefault(ascii_lower(text), []).append(doc)
    expected = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        expected += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    got = rows(exact_dedup(edge_documents(spark), max_filter_bits=bits), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def test_exact_dedup_keeps_other_columns(spark):
    docs = clashing_documents(spark)
    out = exact_dedup(docs)
    assert set(docs.columns) <= set(out.columns)
    assert dict(out.dtypes)["kept"] == "boolean"
    assert exact_dedup(empty_documents(spark)).count() == 0


def test_full_filter_only_sends_more_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    columns = ["doc_id", "keep_id", "group_size", "kept"]
    assert rows(exact_dedup(docs, max_filter_bits=2**10), *columns) == rows(exact_dedup(docs), *columns)


def plain_sets(texts, size):
    out = []
    for text in texts:
        words = ascii_lower(text).replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ")
        words = [w for w in words if w]
        out.append({tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set())
    return out


def plain_components(ids, sets, percent):
    label = {i: i for i in ids}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for x in range(len(ids)):
        for y in range(x):
            common = len(sets[x] & sets[y])
            if common and 100 * common >= percent * len(sets[x] | sets[y]):
                a, b = sorted((root(ids[x]), root(ids[y])))
                label[b] = a
    return [root(i) for i in ids]


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_near_classes_are_those_of_all_pairs(spark, size, percent):
    pick = random.Random(7)
    texts = []
    for family in range(6):
        base = prose(100 + family, 120).split()
        for _ in range(25):
            words = list(base)
            for _ in range(pick.randint(0, 12)):
                words[pick.randrange(len(words))] = f"new{pick.randrange(10**6)}"
            texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    sets = plain_sets(texts, size)
    expected = sorted(zip(range(len(texts)), map(len, sets), plain_components(range(len(texts)), sets, percent)))
    got = near.near_classes(docs, shingle=size, percent=percent)
    assert rows(got, "doc_id", "n_shingles", "component_id") == expected
    assert got.filter("kept != (doc_id = component_id)").count() == 0


def test_large_bucket_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 8)
    pick = random.Random(3)
    base = prose(5, 100).split()
    texts = []
    for _ in range(60):
        words = list(base)
        for _ in range(pick.randint(0, 6)):
            words[pick.randrange(len(words))] = f"x{pick.randrange(10**6)}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = plain_components(range(60), plain_sets(texts, 3), 85)
    assert [r[1] for r in rows(near.near_classes(docs, shingle=3, percent=85), "doc_id", "component_id")] == expected


def test_near_dedup_edges(spark):
    out = near.near_dedup(clashing_documents(spark), shingle=3, percent=85)
    assert out.count() == len(TEXTS)
    got = {(r["doc_id"], r["text"]): r for r in out.collect()}
    assert {got[k]["component_id"] for k in TEXTS[:4]} == {1}
    assert got[(5, None)]["n_shingles"] == got[(6, "")]["n_shingles"] == got[TEXTS[6]]["n_shingles"] == 0
    assert got[(5, None)]["kept"] and got[(6, "")]["kept"]
    assert got[TEXTS[8]]["component_id"] == 8 and not got[TEXTS[8]]["kept"]
    assert got[(10, "one")]["n_shingles"] == 1
    assert got[(None, None)]["component_id"] is None and got[(None, None)]["kept"]
    assert near.near_dedup(empty_documents(spark)).count() == 0


def test_sketch_estimates_similarity():
    random_ = np.random.default_rng(1)
    for share in (0.3, 0.6, 0.9):
        estimates = []
        for _ in range(40):
            common = random_.integers(0, 2**63, int(400 * share), dtype=np.uint64)
            left, right = (np.concatenate([common, random_.integers(0, 2**63, n, dtype=np.uint64)]) for n in (int(400 * (1 - share)), int(500 * (1 - share))))
            sketch = near.registers([left, right])
            estimates.append(near.estimate(sketch[:1], sketch[1:], np.array([len(left)]), np.array([len(right)]))[0])
            true = len(common) / (len(left) + len(right) - len(common))
        assert abs(np.mean(estimates) - true) < 0.03


def test_registers_merge():
    random_ = np.random.default_rng(2)
    left, right = random_.integers(0, 2**63, 50, dtype=np.uint64), random_.integers(0, 2**63, 80, dtype=np.uint64)
    one, two, both = near.registers([left, right, np.concatenate([left, right])])
    assert (np.maximum(one, two) == both).all()


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(5, 5), (1, 2), (2, 1)]
    got = dict(rows(connected_components(spark.createDataFrame(links, "a long, b long")), "node", "component"))
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 7 for i in [7, *range(200, 260)]}, 1: 1, 2: 1}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def edits(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def changed(pick, text, n):
    chars = list(text)
    for _ in range(n):
        at = pick.randrange(len(chars) + 1)
        kind = pick.randrange(3)
        if kind == 0:
            chars.insert(at, pick.choice("abc"))
        elif chars and kind == 1:
            chars.pop(min(at, len(chars) - 1))
        elif chars:
            chars[min(at, len(chars) - 1)] = pick.choice("abc")
    return "".join(chars)


def test_band_is_edit_distance():
    pick = random.Random(4)
    for _ in range(3000):
        a = "".join(pick.choice("ab") for _ in range(pick.randrange(9)))
        b = changed(pick, a, pick.randrange(5))
        for distance in range(4):
            assert within(a, b, distance) == (edits(a, b) <= distance)


def test_line_classes_are_those_of_all_pairs(spark):
    pick = random.Random(9)
    bases = ["".join(pick.choice("abcde ") for _ in range(pick.randint(30, 60))) for _ in range(30)]
    bases += ["".join(pick.choice("abcdefghijk ") for _ in range(n)) for n in (1, 2, 3, 4, 7, 12, 20, 30, 31, 32, 33)]
    lines = sorted({changed(pick, b, pick.randrange(4)).strip() for b in bases for _ in range(12)} - {""})
    docs = spark.createDataFrame([(i, "\n".join(lines[i::10])) for i in range(10)], "doc_id long, text string")
    parent = list(range(len(lines)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(lines):
        for j in range(i):
            shorter = min(len(a), len(lines[j]))
            if shorter >= 3 and edits(a, lines[j]) <= (2 if shorter >= 32 else 1):
                parent[root(i)] = root(j)
    expected = {}
    for i, line in enumerate(lines):
        expected.setdefault(root(i), set()).add(line)
    got = {}
    for line, group in rows(line_classes(docs), "line", "line_class"):
        got.setdefault(group, set()).add(line)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))
    assert line_classes(docs).filter("kept").count() == len(expected)


def test_lines_of_edge_documents(spark):
    docs = clashing_documents(spark)
    classes = line_classes(docs)
    assert classes.agg({"copies": "sum"}).first()[0] == sum(1 for _, t in TEXTS for line in (t or "").split("\n") if line.strip(" \t\r\x0b\x0c"))
    cleaned = line_dedup(docs, classes)
    assert cleaned.columns == docs.columns and cleaned.count() >= len(TEXTS)
    assert line_classes(empty_documents(spark)).count() == 0
