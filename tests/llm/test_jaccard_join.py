"""The n-gram Jaccard join against all pairs, and its filters against the sets they are about."""

import random

import numpy as np
import pytest
from test_documents import brute_components, odd_documents, shingle_sets

from salesmart.llm import jaccard_join as join


def groups(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


@pytest.mark.parametrize("words_each, percent_seed", [(1, 1), (2, 2), (5, 3)])
def test_equals_all_pairs(spark, words_each, percent_seed):
    rows, docs = odd_documents(spark, random.Random(percent_seed))
    found = join.similar_groups(docs, words_each)
    assert found.count() == len(rows)
    found = groups(found)
    parts, sets = brute_components(rows, words_each), shingle_sets(rows, words_each)
    assert {d: c for d, (_, c) in found.items() if d is not None} == parts
    assert all(found[d][0] in {len(x) for x in s} for d, s in sets.items())
    assert found[None][1] is None


def family(rng, n, own, shared):
    """Texts of ``shared`` common words and ``own`` words of their own each, in blocks so that shingles stay common."""
    common = [f"c{i}" for i in range(shared)]
    return [(i, " ".join(common + [f"d{i}x{k}" for k in range(own)])) for i in range(n)]


@pytest.mark.parametrize("cell", [join.CELL, 4])
def test_large_groups_and_cells(spark, monkeypatch, cell):
    monkeypatch.setattr(join, "CELL", cell)
    rng = random.Random(cell)
    rows = family(rng, 60, 4, 60)  # all linked
    rows += [(100 + i, t.replace("c", "e")) for i, t in family(rng, 60, 14, 50)]  # share much, none linked
    chain = [f"k{i}" for i in range(80)]
    for i in range(25):  # each links with its neighbours only
        rows.append((200 + i, " ".join(chain[2 * i:2 * i + 30])))
    rows += [(300 + i, "the same words in every text of a large group of copies") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = groups(join.similar_groups(docs))
    parts = brute_components(rows, 5)
    assert {d: c for d, (_, c) in found.items()} == parts
    assert len(set(parts[i] for i in range(60))) == 1 and len(set(parts[100 + i] for i in range(60))) == 60


def test_empty_table(spark):
    assert join.similar_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_similar_sets_pass_every_filter():
    rng = np.random.default_rng(5)
    counts = rng.integers(0, 50, (join.ORDERS, join.COUNTERS), dtype=np.uint32)
    heads = lambda s: [(p >> np.uint64(32)).astype(np.uint32).tobytes() for p in join.prefixes(s, counts, 80)]
    seen = set()
    for _ in range(400):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 60), dtype=np.uint64))
        drop, add = rng.integers(0, max(1, len(a) // 5) + 1), rng.integers(0, len(a) // 5 + 1)
        b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**63, add, dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        similar = both and 100 * both >= 80 * (len(a) + len(b) - both)
        passed = len(b) > 0 and join.in_reach(heads(a), heads(b), len(a), len(b), 80)
        seen.add((bool(similar), passed))
        assert passed or not similar
    assert (True, True) in seen and (False, False) in seen


def test_tokens_are_the_shingles():
    for text in (None, "", " \n", "one", "ONE two", "a b c d e f g a b c d e", "é ß " * 9):
        assert len(join.tokens(text, 5)) == len(join.shingles(text, 5))
    assert (join.tokens("A b\tc d e", 5) == join.tokens("a b c D E", 5)).all()
    assert set(join.tokens("a b", 5).tolist()).isdisjoint(join.tokens("b a", 5).tolist())
