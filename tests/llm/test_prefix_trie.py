import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from reviewlens.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def plain_rebuilt(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns[conv].append((turn is not None, turn or 0, digest(role, text), (role, text)))
    own = {c: [t[-1] for t in sorted(found)] for c, found in turns.items()}
    out = {}
    for c, found in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        leader = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = own.get(leader, [])[:h] + found[h:]
    return out


def plain_trie(rebuilt):
    members = defaultdict(list)
    for c, found in rebuilt.items():
        for d in range(len(found) + 1):
            members[tuple(found[:d])].append(c)
    below = {node: [n for n in members if n[: len(node)] == node] for node in members}
    children = {node: sum(len(n) == len(node) + 1 for n in below[node]) for node in members}
    value = {node: (len(m) - 1) * (len(node[-1][1].encode()) if node else 0) for node, m in members.items()}
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(rebuilt[c]) == len(node)))
        out.append((
            min(m), len(node), min(members[node[:-1]]) if node else None, len(m), children[node],
            sum(not children[n] for n in below[node]), sum(value[n] for n in below[node]), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def found(nodes, ends):
    joined = nodes.join(trie.end_digests(ends), list(trie.KEY), "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256))
    )
    return sorted((tuple(r) for r in joined.collect()), key=repr)


def run(spark, rows):
    turns, ids = trie.rebuilt_conversations(trie.ordered_turns(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    return found(*trie.prefix_trie(turns, ids))


def random_rows(seed, convs, words=3):
    pick, rows = random.Random(seed), []
    for c in range(convs):
        for t in range(pick.randrange(1, 14)):
            rows.append((c - 6, t, pick.choice(["user", "assistant"]), pick.choice(["", "é", "hello there"][:words])))
    return rows


CASES = {
    "random": random_rows(1, 60),
    "nulls and ties": [
        (1, None, "user", "a"), (1, 0, None, None), (1, 0, "", ""), (1, 0, "user", "b"), (2, 0, "user", "a"), (2, 0, "user", "a"),
        (None, 0, "user", "lost"), (3, None, None, None), (7, -5, "user", "x"), (7, None, "user", "y"),
    ],
    "no leaders": [(c, t, "user", "same") for c in (1, 6, 11, 12) for t in range(12)],
    "all equal": [(c, t, "user", "same") for c in range(40) for t in range(5)],
    "short ones": [(c, 0, "user", f"t{c % 3}") for c in range(30)],
    "role and text apart": [(0, 0, "ab", "c"), (5, 0, "a", "bc"), (10, 0, "", "abc"), (10, 1, "abc", "")],
}


@pytest.mark.parametrize("case", CASES)
def test_same_as_brute_force(spark, case):
    assert run(spark, CASES[case]) == plain_trie(plain_rebuilt(CASES[case]))


def test_one_very_long_conversation(spark, monkeypatch):
    """Blocks of a conversation are combined apart; a third of all rows in one conversation changes nothing."""
    monkeypatch.setattr(trie, "BLOCK", 4)
    rows = random_rows(2, 20) + [(100, t, "user", f"t{t % 5}") for t in range(60)] + [(105, t, "user", f"t{t % 5}") for t in range(45)]
    assert run(spark, rows) == plain_trie(plain_rebuilt(rows))


def test_empty_and_turnless(spark):
    none = spark.createDataFrame([], SCHEMA)
    turns, ids = trie.rebuilt_conversations(trie.ordered_turns(none))
    nodes, ends = trie.prefix_trie(turns, ids)
    assert nodes.count() == ends.count() == trie.end_digests(ends).count() == 0
    nodes, ends = trie.prefix_trie(turns, spark.createDataFrame([(4,), (2,), (4,)], "conv_id long"))
    root = (2, 0, None, 2, 0, 1, 0, hashlib.sha256(b"2,4").hexdigest())
    assert found(nodes, ends) == [root]


def test_clashing_names_and_last_turns(spark):
    rows = CASES["random"]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("position", "digest", "size", "slice", "depth", "k1", "n", "h")})
    turns = trie.ordered_turns(frame)
    nodes, _ = trie.prefix_trie(turns)
    first = {c: found[0] for c, found in _own(rows).items()}
    top = trie.last_turns(nodes, turns).filter("depth = 1").select("conv_id", "digest").collect()
    assert {(r["conv_id"], bytes(r["digest"])) for r in top} == {(min(c for c in first if first[c] == t), digest(*t)) for t in set(first.values())}


def _own(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv].append((turn, role, text))
    return {c: [t[1:] for t in sorted(found)] for c, found in out.items()}


def test_rows_grow_with_distinct_sequences(spark):
    """Copies are expanded once: 200 equal conversations give the prefixes of one."""
    rows = [(c * 5, t, "user", f"t{t}") for c in range(200) for t in range(6)]
    nodes, ends = trie.prefix_trie(trie.ordered_turns(spark.createDataFrame(rows, SCHEMA)))
    assert nodes.count() == 7 and ends.count() == 200
