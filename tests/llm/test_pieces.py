"""Piece encoding: long segments by windows, clashing columns, and the query against the library."""

import random
import zlib

import numpy as np
import pytest

from docsieve.llm import pieces

sentencepiece = pytest.importorskip("sentencepiece")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel.load(pieces.default_model())


def test_windows_give_the_whole(model):
    rng = random.Random(0)
    for _ in range(150):
        kind = rng.choice(["ab", "aaab", "abcdefghijklmnopqrstuvwxyz", "etaoin", "éaü日本x", "0123456789", "-=_", "the"])
        n = rng.randrange(1, 900)
        text = (kind * 900)[:n] if rng.random() < 0.3 else "".join(rng.choice(kind) for _ in range(n))
        whole = model._block([text])[0]
        for window, seam in ((64, 20), (100, 16), (128, 64)):
            assert model._windows(text, window, seam) == whole


def test_a_long_text_without_spaces_is_bounded(spark, model):
    import tracemalloc

    import pyarrow as pa

    rng = random.Random(1)
    text = "".join(rng.choice("abcdefghij") for _ in range(600_000))
    tracemalloc.start()
    flat, _ = model.rows(pa.array([text]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150 << 20
    want = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model()).encode(text)
    assert flat.tolist() == want


def test_columns_of_the_same_name_stay(spark):
    df = spark.createDataFrame([(9, "some words", "old", 1)], "ids int, text string, Decoded string, ids_given int")
    out = pieces.decode(pieces.encode(df, pieces.default_model()), pieces.default_model())
    assert out.columns == ["ids_given_given", "text", "Decoded_given", "ids_given", "ids", "decoded"]
    r = out.first()
    assert (r.ids_given_given, r.Decoded_given, r.ids_given, r.decoded) == (9, "old", 1, "some words") and len(r.ids) >= 2


def test_query_against_the_library(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for d, t in docs:
        ids = sp.encode(t or "")
        want.append((d, len(ids), zlib.crc32(np.array(ids, "<i4").tobytes()), True))
    assert sorted(map(tuple, pieces.op9(spark, SF).collect())) == sorted(want)
