from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.support import AWKWARD, documents

from plumbline.llm import token_files
from plumbline.llm.common import shared_folder
from plumbline.llm.queries import tokenizer_file


@given(st.lists(st.integers(0, 10**7), max_size=600), st.integers(0, 10**6))
@settings(max_examples=60, deadline=None)
def test_elias_fano_round_trip(values, spare):
    values = np.sort(np.array(values, dtype=np.uint64))
    top = int(values[-1]) + spare if len(values) else spare
    coded = token_files.EliasFano(token_files.ef_encode(values, top))
    assert len(coded) == len(values)
    assert coded.decode(0, len(values)).tolist() == values.tolist()
    for i in range(0, len(values), 37):
        assert coded.select(i) == values[i]
        assert coded.decode(i, min(i + 5, len(values))).tolist() == values[i : i + 5].tolist()


def test_elias_fano_is_near_minimal_and_wide():
    values = np.cumsum(np.random.default_rng(1).integers(1, 1000, 50_000)).astype(np.uint64)
    size = len(token_files.ef_encode(values, int(values[-1])))
    assert 8 * size / len(values) < 2 + np.log2(values[-1] / len(values)) + 0.5
    wide = np.array([0, 1, 2**62, 2**63, 2**64 - 1], dtype=np.uint64)
    assert token_files.EliasFano(token_files.ef_encode(wide, 2**64 - 1)).decode(0, 5).tolist() == wide.tolist()
    with pytest.raises(IndexError):
        token_files.EliasFano(token_files.ef_encode(wide, 2**64 - 1)).select(5)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file())


@pytest.fixture(scope="module")
def encode():
    return token_files.Encoder(tokenizer_file(), True)


TRICKY = "aB'éÉßÿçÇ.,!<|>&*#09 \n\t ’ıİΣςﬁ½Ⅷ́eẞ日本's'llre\x85\x1c\x00~^`_-=+[]{}"


@given(st.one_of(st.text(alphabet=TRICKY, max_size=30), st.text(max_size=30)), st.booleans())
@settings(max_examples=400, deadline=None)
def test_words_give_the_ids_of_the_whole_text(tokenizer, encode, text, special):
    text += " x<|endoftext|>y<|startoftext|>" * special
    whole = np.array(tokenizer.encode(text, add_special_tokens=False).ids, encode.dtype)
    assert next(encode([text.encode("utf-8", "ignore")])) == whole.tobytes() or "\ud800" <= max(text, default="") <= "\udfff"


def test_other_tokenizers_take_whole_texts():
    encode = token_files.Encoder(tokenizer_file("byte_bpe_50k.json"), False)
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    texts = ["one  two", "", "three\nfour"]
    assert [np.frombuffer(x, encode.dtype).tolist() for x in encode([t.encode() for t in texts])] == [plain.encode(t).ids for t in texts]


def brute(tokenizer, rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, out = 0, []
    for i, t, _ in order:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_documents(spark, tokenizer, awkward, no_documents):
    got = [tuple(r) for r in token_files.tokenize(awkward, tokenizer_file()).collect()]
    assert sorted(got, key=lambda r: r[1]) == brute(tokenizer, AWKWARD)
    assert token_files.tokenize(no_documents, tokenizer_file()).count() == 0


def test_many_files_and_random_access(spark, tokenizer):
    rows = [(k * 3 - 100, f"document number {k} " * (k % 9), None) for k in range(400)]
    docs = documents(spark, rows).repartition(7)
    manifest = token_files.write(docs, shared_folder(spark, "test"), tokenizer_file())
    want = brute(tokenizer, rows)
    assert sorted((tuple(r) for r in token_files.read(manifest).collect()), key=lambda r: r[1]) == want
    for part in manifest.orderBy("part").collect():
        file = token_files.TokenFile(part.file)
        for i in (0, part.docs // 2, part.docs - 1):
            low, high = file.bounds(i)
            at = next(w for w in want if w[1] == part.first + low)
            assert (file.doc_ids(i, i + 1)[0], high - low) == (at[0], at[2])
            assert zlib.crc32(file.tokens(low, high).astype("<u4").tobytes()) == at[3]
        file.close()


def test_incomplete_files_are_refused(tmp_path):
    path = tmp_path / "x.tokens"
    path.write_bytes(b"\0" * 200)
    with pytest.raises(ValueError, match="not a complete token file"):
        token_files.TokenFile(f"file://{path}")
