"""Prefix tries against a plain version: ties, repeats, nulls, long conversations, lost heads."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from docsieve.llm import tries


def plain(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs[c].append((turn is not None, turn or 0, hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - c % 5, [])[:h] + v[h:])
    members = defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    children = defaultdict(list)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    saved, leaves = {}, {}
    for k in sorted(members, key=len, reverse=True):
        saved[k] = (len(members[k]) - 1) * len(k[-1][1].encode() if k else b"") + sum(saved[x] for x in children[k])
        leaves[k] = sum(leaves[x] for x in children[k]) or 1
    ends = {k: ",".join(map(str, sorted(c for c in m if len(built[c]) == len(k)))) for k, m in members.items()}
    return [(min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children[k]), leaves[k], saved[k], hashlib.sha256(ends[k].encode()).hexdigest()) for k, m in members.items()]


def talks(seed=0):
    rng = random.Random(seed)
    texts = ["hello", "", "how are you", "é" * 9, "日本", None]
    rows = []
    for c in range(60):
        if c in (10, 25):  # heads that are absent
            continue
        for t in range(rng.randrange(12)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(texts)))
    for c in (100, 101, 102, 103, 104, 230, 231, 232):  # equal conversations
        rows += [(c, t, "user" if t % 2 else "assistant", f"turn {t}") for t in range(14)]
    rows += [(300, t, "user", f"long {t}") for t in range(150)] + [(301, t, "user", f"long {t}") for t in range(160)]
    rows += [(400, None, "user", "null turn"), (400, None, "user", "another"), (400, 1, None, None), (400, 1, "user", "tie"), (400, 1, "user", "tie"), (400, 1, "a", "tie")]
    rows += [(None, 1, "user", "nobody's"), (400, 0, "user", "x"), (401, 5, "user", "y" * 100_000)]
    rng.shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("block", [4, 1024])
def test_against_plain(spark, block):
    rows = talks()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", depth int, pos string").repartition(5)
    got = [tuple(r) for r in tries.trie(df, block=block).collect()]
    assert sorted(got, key=str) == sorted(plain(rows), key=str)


def test_one_conversation_holds_most_rows(spark):
    """The long one spreads over the sorted ranges; its places and keys are still those of one path."""
    rows = [(5, t, "user", "same") for t in range(3000)] + [(6, t, "user", "same") for t in range(2500)] + [(c, t, "user", "same") for c in range(7, 60) for t in range(3)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = [tuple(r) for r in tries.trie(df, block=64).collect()]
    want = plain(rows)
    assert sorted(got, key=str) == sorted(want, key=str) and len(got) == len(want) > 3000


@pytest.mark.parametrize("pack", [10, 1 << 16])
def test_many_end_at_one_node(spark, pack, monkeypatch):
    monkeypatch.setattr(tries, "PACK", pack)
    rows = [(c, t, "user", f"{t}") for c in range(1000, 1400) for t in range(9)]
    got = [tuple(r) for r in tries.trie(spark.createDataFrame(rows, SCHEMA).repartition(6)).collect()]
    assert sorted(got, key=str) == sorted(plain(rows), key=str)


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert tries.trie(empty).collect() == []
    assert tries.trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).collect() == []
    # 0 has a turn or none left after its own head's; a lost head leaves 3 turnless or with its later turns
    one = [(3, 0, "user", "x")]
    assert [tuple(r) for r in tries.trie(spark.createDataFrame(one, SCHEMA)).collect()] == plain(one)
