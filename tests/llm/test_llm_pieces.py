from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.support import AWKWARD, documents, prose

from plumbline.llm import pieces
from plumbline.llm.queries import tokenizer_file

MODEL = tokenizer_file("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
SEGMENTER = pieces.Segmenter(MODEL)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def brute(text):
    ids = LIBRARY.encode(text or "")
    return len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids))


def by_table(segmenter, texts):
    import numpy as np

    return [np.frombuffer(b, "<i4").tolist() for b in segmenter.encode([t.encode() for t in texts])]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(" ▁\n\t　 ab.,19é中🙂"), st.characters(exclude_categories=["Cs"])), max_size=60), max_size=4))
def test_ids_equal_the_library(texts):
    assert by_table(SEGMENTER, texts) == LIBRARY.encode(texts)


def test_each_distinct_chunk_is_segmented_once():
    segmenter = pieces.Segmenter(MODEL)
    text = " ".join(random.Random(3).choices(prose(1, 200).split(), k=20_000))
    assert by_table(segmenter, [text, text[::-1], text]) == LIBRARY.encode([text, text[::-1], text])
    assert segmenter.segmented == len(set(text.split()) | set(text[::-1].split()))


def test_a_full_table_is_put_aside():
    segmenter = pieces.Segmenter(MODEL, most=50)
    often = "often " * 3
    for seed in range(30):
        text = often + prose(seed, 40)
        assert by_table(segmenter, [text, "  " + text]) == LIBRARY.encode([text, "  " + text])
        assert len(segmenter.table) <= 50 + 2 * 42
    assert segmenter.segmented <= 30 * 41 + 2  # the frequent word is never segmented again


def test_models_that_cannot_be_cut_take_whole_texts():
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(LIBRARY.serialized_model_proto())
    assert pieces.separable(model)
    model.pieces[500].piece = "a▁b"
    assert not pieces.separable(model)
    model.ParseFromString(LIBRARY.serialized_model_proto())
    model.normalizer_spec.add_dummy_prefix = False
    assert not pieces.separable(model)
    whole = pieces.Segmenter(MODEL)
    whole.separable = False
    texts = ["", " a  b", prose(2, 50)]
    assert by_table(whole, texts) == LIBRARY.encode(texts)


@pytest.mark.parametrize("slice_bytes", [100, pieces.SLICE_BYTES])
def test_documents_against_the_library(spark, awkward, no_documents, monkeypatch, slice_bytes):
    monkeypatch.setattr(pieces, "SLICE_BYTES", slice_bytes)
    got = Counter(map(tuple, pieces.digest(awkward, MODEL).collect()))
    assert got == Counter((i, *brute(t)) for i, t, _ in AWKWARD)
    assert pieces.digest(no_documents, MODEL).count() == 0


def test_round_trip_gives_texts_back(spark):
    rows = [(1, "Größe  und\tWeite\n", None), (2, " führend", None), (3, None, None), (4, "🙂" * 300, None), (5, "a\x00b", None)]
    got = {r.doc_id: r.text for r in pieces.round_trip(documents(spark, rows), MODEL).collect()}
    assert got == {i: t or "" for i, t, _ in rows}


def test_whole_tables(spark):
    from plumbline.llm.queries import op13_sentencepiece

    folder = "/root/testdata/sf0.01"
    want = Counter((r.doc_id, *brute(r.text)) for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    assert Counter(map(tuple, op13_sentencepiece(spark, folder).collect())) == want
