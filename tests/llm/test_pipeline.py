"""Toxicity by held-out accuracy, and the pipeline's stages against what each must do to its own input."""

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from salesmart.llm import toxicity
from test_documents import WORDS, brute_components, brute_hits

BAD = ["idiot", "scum", "stümperax", "stümperei", "stümperung"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Documents with toxic ones, copies, near copies and benchmark passages; labels; a benchmark."""
    rng = random.Random(9)
    say = lambda n: " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed", "ing"]) for _ in range(n))
    items = [(i, say(20)) for i in range(5)]
    docs, toxic = [], {}
    for i in range(900):
        text = say(rng.randrange(30, 80))
        if i % 9 == 0:
            words = text.split()
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(BAD)
            text = " ".join(words)
        toxic[i] = int(i % 9 == 0)
        docs.append((i, text))
    clean = [d for d in docs if not toxic[d[0]]]
    extra = [(1000 + i, clean[i][1].replace(" ", "\n")) for i in range(20)]
    extra += [(1100 + i, clean[30 + i][1] + " end") for i in range(20)]
    extra += [(1200 + i, say(20) + " " + items[i % 5][1].upper() + " " + say(5)) for i in range(10)]
    extra += [(1300, None), (1301, ""), (None, say(40)), docs[5], (1302, "x" * 50_000)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    frame = spark.createDataFrame(docs + extra, "doc_id long, text string").select(
        "*", F.lit("en").alias("lang"), F.lit("src").alias("source"), F.length("text").cast("long").alias("n_chars"))
    frame.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(d, 1, t) for d, t in toxic.items()] + [(3, None, None), (4, 1, 0), (None, 1, 1)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, docs + extra, toxic, items


def test_toxicity_on_held_out_rows(spark, corpus):
    folder, rows, toxic, _ = corpus
    out = toxicity.op6_toxicity(spark, folder).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    held = [r for r in out if r.held_out and r.doc_id in toxic]
    assert sum(r.predicted == toxic[r.doc_id] for r in held) >= 0.97 * len(held)
    assert {r.held_out for r in out if r.doc_id is None} == {True}


def test_without_labels_a_fixed_list_decides(spark, corpus):
    folder = corpus[0]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.train(docs, labels.where("false"))
    rows = [(1, "you idiot, you scum"), (2, "a fine day"), (3, None), (3, None)]
    odd = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    assert [r.predicted for r in toxicity.toxicity(odd, model).collect()] == [1, 0, 0, 0]
    left = toxicity.drop_toxic(odd, model)
    assert left.columns == odd.columns and left.count() == 3
    assert toxicity.toxicity(odd.where("false"), model).count() == 0


def test_features_see_through_disguises():
    f = dict(zip(toxicity.FEATURES, toxicity.Featurizer({"stümp*": 3.0})("You 1d10t!! i d i o t STUPID stuuupid stümperei")))
    assert f["insult_any"] == 1 and f["hidden_any"] == 3 and f["learned_any"] == 1
    assert f["near_you_rate"] > 0 and f["shouted_rate"] > 0 and f["run_rate"] > 0 and f["stretched_rate"] > 0
    assert toxicity.Featurizer({})("") == toxicity.Featurizer({})(None) == [0.0] * len(toxicity.FEATURES)


def test_pipeline(spark, corpus):
    folder, rows, toxic, items = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    by_name = dict(corpus_pipeline.STAGES)
    assert list(by_name) == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "sentencepiece"]
    key = lambda r: (r.doc_id, r.text)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, after = docs.collect(), stage(spark, docs, folder)
        assert after.schema.names == docs.schema.names
        left = after.collect()
        if name == "toxicity":
            gone = {r.doc_id for r in before} - {r.doc_id for r in left}
            assert sum(toxic.get(d, 0) for d in gone) >= 0.95 * sum(toxic.values()) and all(toxic.get(d) for d in gone)
        elif name == "exact_dedup":
            norm = lambda r: re.sub(r"[\x20\x09-\x0D]", "", r.text or "")
            assert len(left) == len({norm(r) for r in before}) == len({norm(r) for r in left})
        elif name == "near_dedup":
            parts = brute_components([key(r) for r in before], 5)
            assert {r.doc_id for r in left} == {d for d, c in parts.items() if c == d} | {None}
        else:
            hit = {h[0] for h in brute_hits([key(r) for r in before], items) if h[5]}
            assert len(hit) >= 10 and {r.doc_id for r in left} == {r.doc_id for r in before} - hit
        docs = spark.createDataFrame(left, docs.schema)
    out = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()}
    assert out.where("not round_trip or size(ids) <> n_ids").count() == 0


def test_lexicon_is_learned_from_all_labelled_rows(spark):
    words = ["plain", "river", "window", "morning", "paper", "garden", "music", "table"]
    rows = [(i, " ".join(words[(i * k) % 8] for k in range(1, 9)) + (" you idiot" if i % 4 == 0 else "")
             + (f" grumplig {i}" if i % 100 == 0 else f" {i}"), int(i % 4 == 0)) for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"), sample=300)
    assert model.trees is not None
    assert "grumplig" in model.lexicon


def test_copies_of_a_text_count_once_in_the_lexicon(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(WORDS) for _ in range(12)) + (" idiot" if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(1200)]
    rows += [(i, "one clean text that is copied very often", 0) for i in range(5000, 9000)] + [rows[1]] * 500
    rows.append((rows[0][0], rows[0][1], 0))  # a second label, which the larger one overrules
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    texts = toxicity.labelled_texts(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"))
    assert texts.where("text like '%copied%' and first").count() == 1
    assert texts.groupBy("doc_id").count().where("count > 1").count() == 0
    assert texts.where("doc_id = 0 and label = 1").count() in (0, 1) and texts.where("doc_id = 0 and label = 0").count() == 0
    lexicon = toxicity.learn_lexicon(texts.where("first"))
    assert "idiot" in lexicon and not set(lexicon) & set(WORDS)


def test_scores_are_no_surer_than_the_labels(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(f"w{rng.randrange(400)}" for _ in range(25)), int(rng.random() < 0.3)) for i in range(4000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"))
    held = toxicity.toxicity(frame.select("doc_id", "text"), model).where("held_out").join(frame.select("doc_id", "toxic"), "doc_id")
    mean, base = held.agg(F.avg("score"), F.avg("toxic")).first()
    assert abs(mean - base) < 0.05
