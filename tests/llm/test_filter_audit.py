"""The filter audit against every order walked document by document, and the potential against the definition."""

from collections import Counter
from itertools import permutations
from math import factorial

import pytest
from pyspark.sql import functions as F

from salesmart.llm.filter_audit import FILTERS, audit, potentials, text_failures

SCHEMA = "doc_id long, text string, lang string, part string, fails int, n long"  # the last three clash with own names


def walk(docs, labels):
    """Rows of the audit by its definition: one pass over all documents for each order."""
    texts = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            texts.setdefault(text or "", []).append(doc_id)
    label = lambda doc_id, at: doc_id is not None and any(x[at] == 1 for x in labels if x[0] == doc_id)

    def fails(letter, doc_id, text):
        text = text or ""
        words = [w for w in text.translate(str.maketrans(dict.fromkeys("\t\n\v\f\r", " "))).split(" ") if w]
        return {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), "D": any(c in "#$%&*|" for c in text),
                "E": doc_id is not None and doc_id > min(texts[text])}[letter]

    found = Counter()
    shapley = Counter()
    parts = {lang or "" for _, _, lang in docs}
    for order in map("".join, permutations(FILTERS)):
        for doc_id, text, lang in docs:
            part, gone = lang or "", False
            failed = [f for f in order if fails(f, doc_id, text)]
            for step, f in enumerate(order, 1):
                hit = f in failed
                at = (part, order, step)
                found[*at, "redundant"] += hit and gone
                found[*at, "removed"] += hit and not gone
                found[*at, "good_lost"] += hit and not gone and label(doc_id, 1)
                found[*at, "toxic_lost"] += hit and not gone and label(doc_id, 2)
                found[*at, "unique_fails"] += failed == [f]
                shapley[part, f] += hit and not gone
                gone |= hit
                found[*at, "kept"] += not gone
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
    return {(part, order, step, *(found[part, order, step, n] for n in names), shapley[part, order[step - 1]])
            for part in parts for order in map("".join, permutations(FILTERS)) for step in range(1, 6)}


LONG = " ".join(f"word{i}" for i in range(250))
DOCS = [
    (1, LONG, "en"), (2, LONG, "de"), (3, LONG, "en"), (3, LONG, "en"), (4, LONG + " #", "en"),
    (5, "a b\x0ba b a", "en"), (6, "THE CAPITALS", None), (7, "THE CAPITALS", ""), (8, None, "en"), (9, "", "en"),
    (None, LONG, "en"), (None, "", "fr"), (10, "same " * 300, "en"), (11, "same " * 300, "fr"), (12, "é" * 50_000 + "|", "en"),
    (1, LONG, "en"), (13, "\x1c x " * 400, "fr"),
]
LABELS = [(1, 1, 0), (2, 0, 1), (3, 1, 1), (3, 0, 0), (6, None, 1), (9, 1, None), (10, 0, 1), (None, 1, 1), (99, 1, 1)]


def frames(spark, docs, labels):
    return (spark.createDataFrame([(*d, "x", 7, 9) for d in docs], SCHEMA),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_equals_a_walk_over_all_orders(spark):
    found = [tuple(r) for r in audit(*frames(spark, DOCS, LABELS)).collect()]
    assert len(found) == len(set(found)) == 4 * 600
    assert set(found) == walk(DOCS, LABELS)


def test_one_text_in_a_third_of_all_rows(spark):
    docs = [(i, LONG if i % 3 == 0 else f"{LONG} {i}", "en") for i in range(600)]
    rows = audit(*frames(spark, docs, [(0, 1, 0), (3, 1, 0)])).where("filter_order = 'ABCDE' and step = 5").collect()
    assert [(r.kept, r.removed, r.good_lost) for r in rows] == [(401, 199, 1)]


@pytest.mark.parametrize("docs, labels, rows", [([], LABELS, 0), (DOCS[:1], [], 600)])
def test_empty_tables(spark, docs, labels, rows):
    found = audit(*frames(spark, docs, labels))
    assert found.count() == rows
    assert not found.where("good_lost + toxic_lost > 0").count()


def test_potential_gives_shapley_values_of_any_game(spark):
    game = [0, 5, 3, 11, -2, 7, 7, 20]
    q = spark.range(1).select(potentials(F.array(*(F.lit(v).cast("long") for v in game)), 3).alias("q")).first().q
    for i in range(3):
        gains = 0
        for order in permutations(range(3)):
            before = sum(1 << j for j in order[:order.index(i)])
            gains += game[before | 1 << i] - game[before]
        assert q[7] - 3 * q[7 ^ 1 << i] == gains
    assert q[7] == sum(factorial(bin(s).count("1") - 1) * factorial(3 - bin(s).count("1")) * v for s, v in enumerate(game) if s)


def test_failures_of_a_text():
    assert text_failures(None) == text_failures("")
    assert text_failures(LONG)[0] == 0
    assert text_failures("x " * 200)[0] == 2
    assert text_failures(LONG + " A")[0] == 0 and text_failures("ABC " + "d" * 96)[0] == 1 and text_failures("ABCD" + "d" * 96)[0] == 5
