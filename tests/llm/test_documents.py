"""Dedup, decontamination and language on odd rows, against brute force."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from salesmart.llm import decontaminate, exact_dedup, language, line_dedup, near_dedup
from salesmart.llm.common import components

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def odd_documents(spark, rng, n=120):
    """Copies, near copies, repeated rows, nulls, ties, a long text, and columns whose names clash."""
    base = [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(0, 60))) for _ in range(n // 3)]
    rows = []
    for i in range(n):
        words = rng.choice(base).split(" ")
        for _ in range(rng.randrange(0, 4)):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        glue = rng.choice([" ", "  ", "\n", "\t"])
        rows.append((i, rng.choice([str.upper, str])(glue.join(words))))
    rows += [(n, None), (n + 1, ""), (n + 2, " \n\t"), (n + 3, "one"), (n + 4, "ONE"), (n + 5, "é" * 50), (None, base[0]), (None, None)]
    rows += [(n + 6, " ".join(f"w{i}" for i in range(30_000))), (n + 7, " ".join(f"w{i}" for i in range(30_050)))]
    rows += [rows[3], rows[3]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return rows, docs.select("*", *(F.lit(1).alias(c) for c in ("rep", "key", "n", "part", "first", "kept", "norm", "state")))


def shingle_sets(rows, k):
    found = {}
    for doc, text in rows:
        if doc is not None:
            words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
            found.setdefault(doc, []).append({tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set())
    return found


def brute_components(rows, k):
    sets = shingle_sets(rows, k)
    part = {d: d for d in sets}

    def find(d):
        while part[d] != d:
            d = part[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = find(a), find(b)
                part[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def test_near_groups(spark):
    rows, docs = odd_documents(spark, random.Random(1))
    for k in (2, 5):
        want = brute_components(rows, k)
        got = near_dedup.near_groups(docs, k).collect()
        assert len(got) == len(rows)
        for r in got:
            assert r.component_id == want.get(r.doc_id) and r.kept == (r.component_id == r.doc_id)
    sets = shingle_sets(rows, 5)
    assert all(r.n_shingles in {len(s) for s in sets[r.doc_id]} for r in got if r.doc_id is not None)
    left = near_dedup.drop_near_copies(docs, 5)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {d for d, c in want.items() if d == c} | {None}
    assert near_dedup.near_groups(docs.where("false")).count() == 0


def test_cells_of_a_large_bucket(spark, monkeypatch):
    """A bucket over several cells, in which only some members are linked to the first ones."""
    monkeypatch.setattr(near_dedup, "CELL", 8)
    rng = random.Random(2)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(rng.randrange(0, 12)):
            words[rng.randrange(100)] = f"x{rng.randrange(5)}"
        rows.append((i, " ".join(words)))
    got = near_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components(rows, 2)


def test_sequential_test_rarely_prunes():
    fewest = near_dedup._least(80)
    rng = np.random.default_rng(0)
    one = rng.integers(0, 2**16, near_dedup.HASHES, dtype=np.uint16)
    others = np.where(rng.random((4000, near_dedup.HASHES)) < 0.8, one, rng.integers(0, 2**16, (4000, near_dedup.HASHES))).astype(np.uint16)
    assert len(near_dedup._survivors(one, others, fewest)) >= 3995
    far = np.where(rng.random((1000, near_dedup.HASHES)) < 0.4, one, 0).astype(np.uint16)
    assert len(near_dedup._survivors(one, far, fewest)) == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)] + [(7, 7), (None, 3)]
    part = {x: x for e in edges if None not in e for x in e}
    for _ in part:
        for a, b in edges:
            if a is not None:
                part[a] = part[b] = min(part[a], part[b])
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == part
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_exact_groups(spark):
    rows, docs = odd_documents(spark, random.Random(4))
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    got = exact_dedup.exact_groups(docs).collect()
    order = lambda i: (-len(rows[i][1] or ""), rows[i][0] is None, rows[i][0] or 0)
    want = []
    for i, (doc, _) in enumerate(rows):
        same = [j for j in range(len(rows)) if norm[j] == norm[i]]
        keep = rows[min(same, key=order)][0]
        want.append((doc, keep, len(same), doc == keep, hashlib.sha256(norm[i].encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    left = exact_dedup.drop_exact_copies(docs)
    assert left.columns == docs.columns
    assert len(left.collect()) == len(set(norm))
    assert exact_dedup.exact_groups(docs.where("false")).count() == 0


def test_a_hash_with_two_contents_is_told_apart(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "c")], "doc_id long, text string")
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_groups(docs).collect()}
    assert got == {1: (1, 2), 2: (2, 1), 3: (1, 2), 4: (4, 1)}


def brute_lines(rows):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    ids = [2**63 - 1 if d is None else d for d, _ in rows]
    holders = {}
    for d, (_, text) in zip(ids, rows):
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(d)
    out = []
    for d, (doc, text) in zip(ids, rows):
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or min(holders[key(x)]) == d]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def test_line_dedup(spark, monkeypatch):
    rng = random.Random(5)
    lines = [f"{w} and a longer line {i}" for i, w in enumerate(WORDS)] + ["short", "", " PADDED line of text \r", "padded LINE of text", "ÄÖÜ äöü ßßßß"]
    rows = [(i, "\n".join(rng.choice(lines + [f"own line number {i}"]) for _ in range(rng.randrange(0, 12)))) for i in range(150)]
    rows += [(200, None), (201, ""), (None, lines[0]), (None, lines[1] + "\nno other document has this"), (202, "\n".join(f"line {i} of a long text" for i in range(20_000)))]
    rows += [(7, rows[7][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("first", F.lit(1)).withColumn("blob", F.lit("x"))
    for hot in (line_dedup.HOT_LINES, 3):  # with few broadcast lines all others go to the shards
        monkeypatch.setattr(line_dedup, "HOT_LINES", hot)
        monkeypatch.setattr(line_dedup, "SHARD_LINES", 50)
        out = line_dedup.dedup_lines(docs)
        assert out.columns == [*docs.columns, "_lines"]
        got = [(r.doc_id, r._lines.n_lines, r._lines.n_dropped, hashlib.sha256(r.text.encode()).hexdigest()) for r in out.collect()]
        assert sorted(got, key=str) == sorted(brute_lines(rows), key=str)
    assert line_dedup.dedup_lines(docs.where("false")).count() == 0


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 20_000):
        a, b = rng.integers(-2**63, 2**63 - 1, (2, n))
        index = line_dedup.LineIndex.unpacked(line_dedup.LineIndex(a, b, np.arange(n) + 1, -np.arange(n)).packed())
        assert sorted(index.slots(a.view(np.uint64), b.view(np.uint64))) == list(range(n))
        counts, holders = index.probe(a, b)
        assert (counts == np.arange(n) + 1).all() and (holders == -np.arange(n)).all()
        assert (index.probe(b.copy(), a.copy())[0] == 0).all()
        assert sum(words.nbytes for words in index.levels) < 0.75 * n + 400


def brute_hits(rows, items, window=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    out = []
    for doc, text in rows:
        ws, hit, who = words(text), set(), set()
        for item, it in items:
            iw = words(it)
            size = min(window, len(iw))
            grams = {tuple(iw[i:i + size]) for i in range(len(iw) - size + 1)} if size else set()
            for i in range(len(ws) - size + 1):
                if tuple(ws[i:i + size]) in grams:
                    hit.update(range(i, i + size))
                    who.add(str(item))
        out.append((doc, len(ws), len(hit), len(who), hashlib.sha256(",".join(sorted(who)).encode()).hexdigest(), bool(hit)))
    return out


def test_decontamination(spark):
    rng = random.Random(6)
    say = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    items = [(i, say(rng.randrange(0, 30))) for i in range(20)] + [(30, None), (31, "..."), (32, "ünique É"), (None, "only here"), (5, "same id again 1 2 3")]
    rows = []
    for i in range(80):
        it = (rng.choice(items)[1] or "").split()
        rows.append((i, rng.choice(["", "x, "]) + say(15) + ", " + "-".join(it).upper() + " " + say(3)))
    rows += [(100, None), (101, ""), (102, "...!?"), (103, "the ünique É word"), (None, "only HERE"), rows[0], (104, say(40_000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit(1)).withColumn("words", F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(brute_hits(rows, items), key=str)
    for block in (decontaminate.BLOCK_CHARS, 60):  # in one block, and in many
        got = decontaminate.contamination(docs, bench, block_chars=block).collect()
        assert sorted(map(tuple, got), key=str) == want
    left = decontaminate.decontaminate(docs, bench)
    assert left.columns == docs.columns and left.count() == sum(not w[5] for w in want)
    spans = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, bench, "spans").collect()}
    assert len(spans) == len({r[0] for r in rows}) and spans[103].replace(" ", "") == "theword" and spans[100] is None
    assert decontaminate.contamination(docs, bench.where("false")).where("contaminated").count() == 0
    assert decontaminate.contamination(docs.where("false"), bench).count() == 0


def test_forward_sums_all_segmentations():
    vocabulary = ["▁", "a", "b", "ab", "ba", "▁a", "aba"]
    rng = np.random.default_rng(2)
    chances = np.vstack([rng.random((len(vocabulary), 2)), np.full((1, 2), 1e-7)])
    model = language.LanguageModel(["x", "y"], vocabulary, chances, np.zeros(2))

    def brute(text):
        if not text:
            return np.ones(2)
        own = [(p, chances[i]) for i, p in enumerate(vocabulary) if text.startswith(p)]
        if all(len(p) > 1 for p, _ in own):
            own.append((text[0], chances[-1]))
        return sum((c * brute(text[len(p):]) for p, c in own), np.zeros(2))

    words = ["a", "ab", "ababab", "bbba", "cab", "c", "acbacaba"]
    got = np.exp(model.word_scores(model.automaton(), words))
    assert np.allclose(got, [brute("▁" + w) for w in words])
    lattice = language.Lattice(model.automaton(), words, len(vocabulary))
    uses = lattice.expected(chances[lattice.piece, 0], np.ones(len(words)))
    letters = np.bincount(lattice.word, uses * lattice.size)
    assert np.allclose(letters, [len(w) + 1 for w in words])  # each letter is in one piece


def test_language_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = language.op7_language(spark, sf).join(docs.select("doc_id", "lang"), "doc_id")
    held = out.where("held_out").select("lang", "lang_pred").collect()
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    rows = [(1, None, "en"), (2, "", None), (3, "123 !?", "en"), (4, "the and of", "en"), (4, "the and of", "en"), (None, "der die das und", "de"), (5, "x" * 100_000, None)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("word", F.lit(1))
    found = language.predict(odd, language.train(odd)).collect()
    assert [r.lang_pred for r in found][:6] == ["und", "und", "und", "en", "en", "de"]
    assert all(0 <= r.score <= 1 for r in found)
    none = language.train(odd.where("false"))
    assert {r.lang_pred for r in language.predict(odd, none).collect()} == {"und"}
    assert language.predict(odd.where("false"), none).count() == 0
