"""Prefix trie against a trie built by hand; the queue and the pass over nodes by themselves."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest

from brassledger.llm import prefix_trie, queries
from brassledger.session import ship_package

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def trie_by_hand(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            digest = hashlib.sha256(f"{len(role or '')} {role or ''}{text or ''}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0), role or "", digest, text or ""))
    own = {c: [(r, t) for _, r, _, t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        first = own.get(c - int(math.fmod(c, 5)), [])[:h]  # a remainder has the sign of the id, as in SQL
        rebuilt[c] = tuple(first + turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, of in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(of) - 1) * len(node[-1][1].encode()) if node else 0
    out = []
    for node, of in members.items():
        ids = ",".join(map(str, sorted(ends[node])))
        out.append((min(of), len(node), min(members[node[:-1]]) if node else None, len(of), children[node], leaves[node], saved[node],
                    hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out, key=str)


def trie_of(df, **how):
    return sorted((tuple(r[c] for c in COLUMNS) for r in prefix_trie.trie(df, **how).collect()), key=str)


def test_queue_spills_and_keeps_its_order():
    rng = random.Random(1)
    for room in (1, 3, 1000):
        queue, expected = prefix_trie.Messages(room), defaultdict(lambda: [0, 0])
        places = [(-rng.randint(0, 5), rng.randint(0, 30)) for _ in range(600)]
        for p in places:
            queue.push(p, 1, abs(p[1]))
            expected[p][0] += 1
            expected[p][1] += abs(p[1])
        for p in sorted({*places, (-3, 99)}):
            assert list(queue.take(p)) == expected[p]
        assert queue.empty()


def test_many_runs_are_merged(monkeypatch):
    monkeypatch.setattr(prefix_trie, "FAN", 2)
    queue = prefix_trie.Messages(2)
    for i in reversed(range(100)):
        queue.push((i,), i, 1)
    assert len(queue._runs) <= 3 and [queue.take((i,)) for i in range(100)] == [(i, 1) for i in range(100)]


def test_a_lost_message_is_an_error():
    with pytest.raises(RuntimeError):
        list(prefix_trie.time_forward([(0, 1, 5, 5, 7, 7, True, 1, 0), (0, 0, 0, 0, None, None, False, 0, 0)]))


def test_query_by_hand(spark, small_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{small_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.queries()["op11_prefix_trie"](spark, small_dir).collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=str) == trie_by_hand(rows)


@pytest.mark.parametrize("fan", [2, 64])
def test_copies_common_turns_and_levels(spark, monkeypatch, fan):
    """A third of the conversations alike, a common first turn, many shards and levels, hot parents."""
    monkeypatch.setattr(prefix_trie, "FAN", fan)
    monkeypatch.setattr(prefix_trie, "HOT_CHILDREN", 3)
    monkeypatch.setattr(prefix_trie, "BLOCK_ROWS", 40)
    rng, rows = random.Random(fan), []
    for c in range(240):
        turns = [("user", "hello"), ("assistant", "yes"), ("user", "x" * 9)] * 4 if c % 3 == 0 else [("user", "hello")] + [
            (rng.choice(["user", "assistant"]), rng.choice(["a", "é", ""])) for _ in range(rng.randint(0, 12))
        ]
        rows += [(c, t, r, x) for t, (r, x) in enumerate(turns)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    assert trie_of(df, shard_conversations=10) == trie_by_hand(rows)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "no id"), (3, None, "user", "null turn"), (3, 0, None, None), (3, 0, None, None), (3, 0, "a", "tie"), (3, 0, "a", "tie 2"),
        (4, 1, "user", ""), (9, 0, "user", "y" * 200_000), (-7, 2, "user", "minus"), (-5, 0, "user", "base"), (5, 0, "user", "base"),
    ]
    rows += [(1000, t, "user", str(t % 3)) for t in range(150)] + [(1003, t, "user", str(t % 3)) for t in range(140)]
    wide = [(*r, 1, "x") for r in rows]
    df = spark.createDataFrame(wide, "conv_id long, turn long, role string, text string, depth int, n_convs string").repartition(4)
    assert trie_of(df) == trie_by_hand(rows)
    assert trie_of(df.limit(0)) == []
    assert trie_of(df.filter("conv_id is null")) == []
