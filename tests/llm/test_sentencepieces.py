import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from salesmart.llm import sentencepieces as sp
from salesmart.llm.vocabulary import PIECES, pieces


def _field(data: bytes, at: int):
    """(number, kind, start, end, next) of the protobuf field at a place."""
    def varint(at):
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            at, shift = at + 1, shift + 7
            if data[at - 1] < 128:
                return value, at

    tag, at = varint(at)
    if tag & 7 == 0:
        _, end = varint(at)
        return tag >> 3, 0, at, end
    if tag & 7 == 2:
        size, at = varint(at)
        return tag >> 3, 2, at, at + size
    return tag >> 3, tag & 7, at, at + (4 if tag & 7 == 5 else 8)


@pytest.fixture(scope="module")
def library():
    """The same file, its trainer's model type set to unigram: the library's own Viterbi search over its scores."""
    data = bytearray(open(PIECES, "rb").read())
    at = 0
    while at < len(data):
        number, kind, start, end = _field(data, at)
        if number == 2:
            inner = start
            while inner < end:
                n, _, a, b = _field(data, inner)
                if n == 3:
                    data[a] = 1
                inner = b
        at = end
    return sentencepiece.SentencePieceProcessor(model_proto=bytes(data))


TEXTS = [
    "", " ", "  two  spaces ", "\n\nline\n end", "Straße café ñandú", "日本語のテキスト", "emoji 🙂🙃 and \u0000 zero", "a" * 3000,
    "tabs\tand\r\nreturns", "The quick brown fox jumps over the lazy dog.", "١٢٣ арбуз", "http://x.y/z?q=1&r=2",
]


def test_equals_the_library(library):
    encoder = sp.Encoder(pieces(PIECES))
    rng = random.Random(5)
    texts = TEXTS + ["".join(rng.choice("abcdeéñ  \n.ßtheing日") for _ in range(rng.randrange(1, 200))) for _ in range(300)]
    for text in texts:
        assert encoder.encode(text).tolist() == library.encode(text), text


def test_round_trip_and_word_mark():
    encoder = sp.Encoder(pieces(PIECES))
    for text in [*TEXTS, "▁", "a▁b ▁ c", "▁▁ x"]:
        assert encoder.decode(encoder.encode(text)) == text


def test_stretches_equal_whole_search():
    encoder = sp.Encoder(pieces(PIECES))
    rng = random.Random(6)
    texts = ["Es ist  ein Wort.\nUnd noch   eins, the end of words: e.g. (\"it's\") x.y/z-a_b 12.5% don't!!"]
    texts += ["".join(rng.choice("abethx .,'()-_/12\n\"é") for _ in range(150)) for _ in range(300)]
    for text in texts:
        whole = np.frombuffer(encoder.best("▁" + text.replace(" ", "▁")), np.int32)
        assert encoder.encode(text).tolist() == whole.tolist()


def test_rows(spark):
    rows = [(1, "the words", "x"), (1, "the words", "y"), (2, None, None), (None, "", None)]
    out = sp.decode(sp.encode(spark.createDataFrame(rows, "doc_id long, text string, n_ids string"))).collect()
    assert [(r.doc_id, r.text, r.n_ids, r.decoded) for r in out] == [(a, b, c, b or "") for a, b, c in rows]
    assert sp.encode(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark, sf):
    out = sp.op3_sentencepiece(spark, sf)
    assert out.where("not round_trip").count() == 0
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert out.where(F.size("ids") != F.col("n_ids")).count() == 0
