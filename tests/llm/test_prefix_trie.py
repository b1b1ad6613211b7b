"""The conversation trie against a plain dictionary of all prefixes."""

import hashlib
import random
import zlib

import pytest

from salesmart.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, path string, hash string"


def lists_of(rows):
    found = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            found.setdefault(conv, []).append((turn is not None, turn or 0, digest, role, text))
    return {c: [(r, t) for *_, r, t in sorted(turns)] for c, turns in found.items()}


def rebuild(lists, every, most):
    result = {}
    for c, turns in lists.items():
        h = zlib.crc32(str(c).encode()) % most
        result[c] = lists.get(c - c % every, [])[:h] + turns[h:]
    return result


def brute(lists):
    members = {}
    for c, turns in lists.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    below = {}
    for path in members:
        for d in range(len(path) + 1):
            below.setdefault(path[:d], []).append(path)
    own = lambda path: (len(members[path]) - 1) * len(path[-1][1]) if path else 0
    rows = set()
    for path, found in members.items():
        ends = ",".join(str(c) for c in sorted(found) if len(lists[c]) == len(path))
        rows.add((
            min(found), len(path), min(members[path[:-1]]) if path else None, len(found),
            sum(len(p) == len(path) + 1 for p in below[path]),
            sum(len(below[p]) == 1 for p in below[path]), sum(map(own, below[path])),
            hashlib.sha256(ends.encode()).hexdigest()))
    return rows


def odd_rows(rng, n=300):
    """Shared beginnings, whole copies, truncations, a long conversation, nulls, ties, repeated rows, negative ids."""
    rows, known = [], [[]]
    for c in range(n):
        turns = list(rng.choice(known))[:rng.randrange(1, 7)] if rng.random() < 0.7 else list(rng.choice(known))
        turns += [(rng.choice(["user", "bot", None]), rng.choice(["hi", "yo", "", None, "é" * 9])) for _ in range(rng.randrange(0, 4))]
        known.append(turns)
        rows += [(c - 20, i, r, t) for i, (r, t) in enumerate(turns)]
    rows += [(n + 1, i, "user", f"t{i % 7}") for i in range(300)] + [(n + 2, i, "user", f"t{i % 7}") for i in range(250)]
    rows += [(c, i, "user", "same") for c in range(n + 10_000, n + 10_200) for i in range(3)]
    rows += [(None, 0, "user", "x"), (n + 3, None, "user", "first"), (n + 3, 0, "user", "b"), (n + 3, 0, "user", "a"), rows[0], rows[0]]
    rows += [(n + 4, 0, "u", "ser"), (n + 5, 0, "us", "er")]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "p", "h") for r in rows], SCHEMA)


def result(nodes):
    rows = nodes.drop("hash").collect()
    found = {tuple(r) for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("turns, ids", [(trie.TURNS, trie.RANGE), (10, 16)])
def test_equals_brute_force(spark, monkeypatch, turns, ids):
    monkeypatch.setattr(trie, "TURNS", turns)
    monkeypatch.setattr(trie, "RANGE", ids)
    rows = odd_rows(random.Random(turns))
    assert result(trie.prefix_trie(frame(spark, rows))) == brute(lists_of(rows))


def test_rebuilt_conversations(spark):
    rows = odd_rows(random.Random(3), 150)
    expected = brute(rebuild({c: t for c, t in lists_of(rows).items() if c >= 0}, 10, 6))
    # Remainders of negative ids point the other way in SQL than in Python: only the others are compared here.
    some = [r for r in rows if r[0] is None or r[0] >= 0]
    nodes = trie.trie_nodes(trie.rebuilt(trie.turn_lists(frame(spark, some)), 10, 6))
    assert result(nodes) == expected


@pytest.mark.parametrize("rows", [[], [(None, 1, "a", "b")]])
def test_no_conversations(spark, rows):
    assert trie.prefix_trie(frame(spark, rows)).count() == 0


def test_turnless_conversations_end_at_the_root(spark):
    lists = spark.createDataFrame([(5, []), (3, [])], "conv_id long, turns array<struct<digest: binary, len: long>>")
    ends = hashlib.sha256(b"3,5").hexdigest()
    assert result(trie.trie_nodes(lists)) == {(3, 0, None, 2, 0, 1, 0, ends)}


def test_a_depth_with_a_large_subtree_is_peeled_alone(spark, monkeypatch):
    monkeypatch.setattr(trie, "TURNS", 4)
    levels = []
    monkeypatch.setattr(trie, "_peel_level", lambda parts, depth, own=trie._peel_level: levels.append(depth) or own(parts, depth))
    rows = [(c, i, "user", "same" if i < 2 else f"{c}-{i}") for c in range(50) for i in range(4)]
    assert result(trie.prefix_trie(frame(spark, rows))) == brute(lists_of(rows))
    assert levels == [3, 2]
