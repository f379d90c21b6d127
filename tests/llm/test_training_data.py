import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reviewlens.llm import best_fit_packing as packing
from reviewlens.llm import chat_format as chat
from reviewlens.llm import source_mixing as mixing
from reviewlens.llm.tokens import WordEncoder
from tests.llm.fixtures import TEXTS, clashing_documents, edge_documents, empty_documents, rows

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)


# Packing


def plain_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def coded(texts):
    ids, counts = WordEncoder(PATH).encode(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=60), st.text("aA zZ'sé́ \x85\x1c!<|endoftext|>09ß", max_size=60)), min_size=1, max_size=8))
def test_word_encoder_is_the_tokenizer(texts):
    assert coded(texts) == [plain_ids(t) for t in texts]


def test_word_encoder_on_documents(spark):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    texts += ["<|endoftext|> a<|startoftext|>b", "It's we'll I'M don’t", "x" * 5000, "#" * 300, "日本語 テスト", "Á é"]
    assert coded(texts) == [plain_ids(t) for t in texts]


def check_packing(pieces, ids_of, length):
    """Every token of every document once, in order, and sequences without gaps."""
    by_sequence, by_document = {}, {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        by_document.setdefault(p["doc_id"], []).append(p)
    for parts in by_sequence.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    for doc, parts in by_document.items():
        expected = sorted((start, zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes()), len(ids[start : start + length]))
                          for ids in ids_of[doc] for start in range(0, len(ids), length))
        assert sorted((p["start"], p["ids_crc32"], p["length"]) for p in parts) == expected
        assert all(p["piece"] == p["start"] // length for p in parts)
    return len(by_sequence)


@pytest.mark.parametrize("make", [edge_documents, clashing_documents])
def test_packing_of_edge_documents(spark, make):
    ids_of = {}
    for doc, text in TEXTS:
        ids_of.setdefault(doc, []).append([*plain_ids(text), 1])
    packed = packing.pack(packing.pieces(make(spark), PATH, with_ids=False)).collect()
    sequences = check_packing(packed, ids_of, 4096)
    assert sequences == -(-sum(p["length"] for p in packed) // 4096)


def test_packing_is_tight(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    ids_of = {r["doc_id"]: [[*plain_ids(r["text"]), 1]] for r in docs.collect()}
    packed = packing.pack(packing.pieces(docs, PATH, with_ids=False)).collect()
    assert check_packing(packed, ids_of, 4096) == -(-sum(len(x[0]) for x in ids_of.values()) // 4096)
    shards = packing.pack(packing.pieces(docs, PATH, with_ids=False), shard_tokens=2**16).collect()
    assert check_packing(shards, ids_of, 4096) <= 1.08 * sum(len(x[0]) for x in ids_of.values()) / 4096 + 1


def test_sequences_hold_the_ids(spark):
    docs = edge_documents(spark)
    whole = packing.sequences(packing.pack(packing.pieces(docs, PATH))).collect()
    documents = [tuple(row["input_ids"][a:b]) for row in whole for a, b in zip(row["starts"], [*row["starts"][1:], len(row["input_ids"])])]
    expected = [tuple([*plain_ids(t), 1][i : i + 4096]) for _, t in TEXTS for i in range(0, len(plain_ids(t)) + 1, 4096)]
    assert sorted(documents) == sorted(expected)
    assert packing.pack(packing.pieces(empty_documents(spark), PATH)).count() == 0


def test_local_search_empties_bins():
    pick = random.Random(2)
    spared = 0
    for _ in range(100):
        lengths = []  # the parts of full bins, so that the least number of bins is known
        for _ in range(pick.randint(3, 30)):
            cuts = sorted(pick.sample(range(1, 100), pick.randint(1, 3)))
            lengths += [b - a for a, b in zip([0, *cuts], [*cuts, 100])]
        bins = packing.Bins(lengths, 100)
        bins.fill_best_fit()
        before = sum(bool(m) for m in bins.members)
        squares = sum((100 - r) ** 2 for r in bins.room if r is not None)
        bins.improve(packing.MOVES)
        after = [m for m in bins.members if m]
        assert sorted(d for m in after for _, d in m) == list(range(len(lengths)))
        assert all(sum(n for n, _ in m) <= 100 for m in after)
        assert sum((100 - r) ** 2 for r in bins.room if r is not None) >= squares
        spared += before - len(after)
    assert spared > 0


def plain_step(bins, room):
    """Whether a step that increases the sum of squared fills is left between two bins of lengths."""
    for a in bins:
        for b in bins:
            free = room - sum(b)
            if a is b or not free or sum(a) > sum(b):
                continue
            pairs = [b[i] + b[j] for i in range(len(b)) for j in range(i)]
            singles = [(x, y) for x in a for y in [0, *b, *pairs]]
            twos = [(a[i] + a[j], y) for i in range(len(a)) for j in range(i) for y in b]
            if any(0 < x - y <= free for x, y in singles + twos):
                return True
    return False


def test_local_search_runs_to_its_end():
    pick = random.Random(5)
    for n, low, high in ((600, 900, 1600), (60, 300, 2500), (40, 1200, 1500)):
        lengths = [pick.randint(low, high) for _ in range(n)]
        found = packing.pack_lengths(lengths)
        assert sorted(d for b in found for d in b) == list(range(n))
        bins = [[lengths[d] for d in b] for b in found]
        assert all(sum(b) <= 4096 for b in bins)
        assert len(bins) == -(-sum(lengths) // 4096) or not plain_step(bins, 4096)


# Mixing


def plain_targets(sizes, weights, share, most):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_ = {}, set(order)
    rest = share * sum(sizes.values())
    while open_:
        level = rest / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > most * sizes[s] + 1e-9}
        if not over:
            return {**target, **{s: weight[s] * level for s in open_}}
        for s in over:
            target[s] = most * sizes[s]
            rest -= target[s]
        open_ -= over
    return target


def test_targets_reshare_the_excess(spark):
    pick = random.Random(1)
    for n in (1, 2, 5, 12):
        sizes = {(None if i == n - 1 else f"s{i}"): pick.choice([0, 5, 100, 1000, 7000]) for i in range(n)}
        frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.targets(frame, (3, 1, 2), 1.5, 2.0).collect()}
        assert got == pytest.approx(plain_targets(sizes, (3, 1, 2), 1.5, 2.0), rel=1e-9, abs=1e-6)


def test_seats_go_to_the_highest_quotients(spark):
    pick = random.Random(6)
    for n, seats in ((3, 10), (8, 100), (25, 40)):
        target = {f"s{i:02d}": round(pick.random() ** 4 * 1000, 3) for i in range(n)}
        block = sum(target.values()) / seats
        got = {r["source"]: r["seats"] for r in mixing.apportion(spark.createDataFrame(list(target.items()), "source string, target double"), block, seats).collect()}
        quotients = sorted(((t / (2 * j + 1), s) for s, t in target.items() for j in range(seats)), key=lambda q: (-q[0], q[1]))[:seats]
        assert got == {s: sum(q[1] == s for q in quotients) for s in target}


def test_mixture_meets_its_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    mixed = mixing.mix_sources(docs).cache()
    for r in mixed.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.sum("size").alias("size"), F.first("source_size").alias("whole")).collect():
        assert abs(r["taken"] - r["target"]) <= 0.003 * r["target"] + 1 and r["size"] == r["whole"]
    assert mixed.filter("taken > 2 * size or taken < 0").count() == 0
    assert mixed.agg(F.sum("taken")).first()[0] == pytest.approx(1.5 * mixed.agg(F.sum("size")).first()[0], rel=0.003)
    again = mixing.mix_sources(docs.repartition(7, "n_chars"))
    assert rows(again, "doc_id", "taken") == rows(mixed, "doc_id", "taken")
    taken = mixing.mixed_rows(mixed)
    words = taken.select(F.sum(F.size(mixing.word_array(F.col("text"))))).first()[0]
    assert words == mixed.agg(F.sum("taken")).first()[0]
    assert taken.columns == docs.columns


def test_mixture_takes_whole_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for weights, share in (((3, 1, 2), 1.5), ((1, 5), 0.4)):
        mixed = mixing.mix_sources(docs, weights, share).cache()
        assert mixed.filter("size > 0 and taken % size != 0").count() == 0
        largest = mixed.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("size"))
        assert largest.filter("abs(taken - target) > size").count() == 0
        texts = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert all(texts[i] == t for i, t in rows(mixing.mixed_rows(mixed), "doc_id", "text"))


def test_mixing_edges(spark):
    docs = clashing_documents(spark)
    mixed = mixing.mix_sources(docs)
    assert mixed.count() == len(TEXTS) and mixed.filter("taken is null or target is null or taken > 2 * size").count() == 0
    assert set(mixing.mixed_rows(mixed).columns) == set(docs.columns) - {"size"}
    assert mixing.mix_sources(empty_documents(spark)).count() == 0
    nothing = docs.withColumn("text", F.lit(None).cast("string"))
    assert mixing.mix_sources(nothing).filter("taken != 0 or target != 0").count() == 0


def test_tied_quotients_go_by_name(spark):
    frame = spark.createDataFrame([(f"s{i}", 5.0) for i in range(7)] + [("z", 0.0)], "source string, target double")
    got = {r["source"]: r["seats"] for r in mixing.apportion(frame, 1.0, 17).collect()}
    assert got == {"s0": 3, "s1": 3, "s2": 3, "s3": 2, "s4": 2, "s5": 2, "s6": 2, "z": 0}


def test_many_sources_cost_no_pairs(spark):
    """5,000 sources: the divisor is found by aggregates, and every seat is there."""
    frame = spark.range(5000).select(F.col("id").cast("string").alias("source"), (F.pow(F.col("id") + 1.0, 1.5)).alias("target"))
    whole = frame.agg(F.sum("target")).first()[0]
    seats = mixing.apportion(frame, whole / 123_457, 123_457)
    assert seats.agg(F.sum("seats")).first()[0] == 123_457
    assert seats.filter(F.abs(F.col("seats") - F.col("target") * 123_457 / whole) > 1).count() == 0


@pytest.mark.parametrize("exact", [True, False])
def test_quota_is_filled(monkeypatch, exact):
    monkeypatch.setattr(mixing, "SUMS_BYTES", 2**24 if exact else 0)
    pick = random.Random(4)
    for n in (0, 1, 2, 5, 12, 300):
        sizes = np.array([pick.choice([0, 1, pick.randrange(1, 400), 5000]) for _ in range(n)], np.int64)
        for quota in (0, min(1, int(sizes.sum())), int(sizes.sum()) // 3, int(sizes.sum())):
            taken = mixing.fill_quota(sizes, quota)
            gap = abs(quota - int(sizes[taken].sum()))
            assert not sizes[taken & (sizes == 0)].size
            if exact and n <= 12:
                sums = {0}
                for size in sizes.tolist():
                    sums |= {x + size for x in sums}
                assert gap == min(abs(quota - x) for x in sums)
            left = sizes[~taken & (sizes > 0)]
            assert gap <= (left.min() if left.size else 0) or sizes[taken].sum() > quota


def test_plain_selection(spark):
    """Every shard's documents against a plain version of the selection, over several shards of a source."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "source")
    keyed = docs.withColumns({"order": F.xxhash64(F.lit(0), "doc_id"), "tie": F.xxhash64("text"), "size": F.size(mixing.word_array(F.col("text"))).cast("long")})
    mixed = mixing.mix_sources(docs)
    shards = {}
    for r in keyed.join(mixed.select("doc_id", "taken", "source_size", "target"), "doc_id").collect():
        shards.setdefault(r["source"], []).append((r["order"], r["tie"], r["size"], r["taken"], r["source_size"], r["target"]))
    block = max(1.0, min(found[0][5] for found in shards.values()) / mixing.FINENESS)
    for found in shards.values():
        found.sort()
        sizes, words = [f[2] for f in found], found[0][4]
        times = sum(f[3] for f in found) // words
        once = sum(f[3] for f in found) - times * words
        assert abs(sum(f[3] for f in found) - found[0][5]) <= block + 1
        plain = mixing._nearest_sum(sizes, once)
        assert [f[3] for f in found] == [(times + int(p)) * size for p, size in zip(plain, sizes)]


def test_shards_of_a_large_source(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_DOCS", 16)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    mixed = mixing.mix_sources(docs).cache()
    for r in mixed.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
        assert abs(r["taken"] - r["target"]) <= 0.01 * r["target"]
    assert rows(mixing.mix_sources(docs.repartition(5)), "doc_id", "taken") == rows(mixed, "doc_id", "taken")


# Chat


HARD = ["<|im_end|>", "<\\|im_start|>", "<\\\\|", "<|", "<", "a<|im_end|>\n<|im_start|>assistant\nb", "", None, "\n\n", "x\\", "<<|", "é ß"]


def test_escapes_are_reversible(spark):
    frame = spark.createDataFrame([(t or "",) for t in HARD], "t string")
    for there, back in ((chat.escape, chat.unescape), (chat.escape_role, chat.unescape_role)):
        out = frame.withColumn("e", there(F.col("t"))).withColumn("b", back(F.col("e")))
        assert out.filter("t != b or e like '%<|%'").count() == 0
    assert frame.withColumn("e", chat.escape_role(F.col("t"))).filter("e like '%\n%'").count() == 0


def conversations():
    pick = random.Random(8)
    out = []
    for conv in [None, *range(8)]:
        for turn in range(pick.randint(1, 9)):
            out.append((conv, None if turn == 0 and conv == 2 else turn, pick.choice(["user", "assistant", "system", "odd\nrole<|", None]), pick.choice(HARD)))
    out.append((3, 1, "assistant", "tie"))
    out += [(50, 0, "user", "same"), (50, 0, "user", "same"), (51, 0, "user", "no reply"), (52, 0, "assistant", "alone")]
    return out


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_examples_read_back(spark):
    table = conversations()
    turns = spark.createDataFrame([(*r, "x", 1) for r in table], "conv_id long, turn long, role string, text string, example string, spans int")
    examples = chat.prefix_examples(turns)
    expected = {}
    groups = {}
    for conv, turn, role, text in table:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    for conv, group in groups.items():
        group.sort()
        replies = "".join(t for *_, r, t in group if r == "assistant")
        expected[conv] = (len(group), digest("".join(f"{r}\n{t}\n" for *_, r, t in group)), len(replies), digest(replies))
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.read_back(examples).collect()}
    assert got == expected
    for r in examples.collect():
        group = groups[r["conv_id"]]
        replies = [i for i, g in enumerate(group) if g[2] == "assistant"]
        last = replies[r["example"]] if r["example"] < len(replies) else len(group) - 1
        assert r["text"].count(chat.START) == r["text"].count(chat.END) == last + 1
        if r["example"] < len(replies):
            assert r["text"].endswith(chat.END + "\n") and r["loss_start"] + r["loss_length"] + len(chat.END) + 1 == len(r["text"])
        else:
            assert r["loss_start"] is None and r["loss_length"] is None
    assert chat.read_back(chat.prefix_examples(turns.limit(0))).count() == 0


def test_long_conversation(spark):
    turns = spark.range(1200).selectExpr("cast(1 as long) as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "concat('turn ', id) as text")
    found = chat.read_back(chat.prefix_examples(turns)).first()
    assert found["n_turns"] == 1200 and found["loss_sha256"] == digest("".join(f"turn {i}" for i in range(1, 1200, 2)))
