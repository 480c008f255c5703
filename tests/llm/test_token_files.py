from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from partnerwatch.llm import token_files as T
from partnerwatch.llm.common import table
from tests.llm.data import SF, docs, rows

queries = pytest.importorskip("partnerwatch.llm.queries")
PATH = queries.tokenizer_path()
PIECES = ["The", "don't", "it's", "é", "e\u0301", "\u0301", " ", "\n", "\t", "\x1c", "\x85", "\xa0", "\u2003", "\u3000", "123", "!!", "ß", "İ", "ΣΑΣ", "Σ", "<|endoftext|>", "<|start", "oftext|>", "日本", "🙂", "\u200d", "'", "s"]
TEXT = st.one_of(st.text(max_size=40), st.lists(st.sampled_from(PIECES), max_size=15).map("".join))


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_ids_by_word_are_those_of_the_whole_text(text):
    assert T.encoder(PATH, True).encode(text) == T.encoder(PATH, False).encode(text)


@settings(max_examples=300, deadline=None)
@given(st.text("aAzZéÉßẞÿÞıİK\u212a\u212bøÑñ.,!|*'s<>", max_size=12))
def test_words_of_letters_and_marks(word):
    enc = T.encoder(PATH, True)
    assert enc.direct and enc.encode(word) == enc._raw(word)


def test_id_bytes_are_little_endian():
    for ids in ([], [0, 2, 49151, 2**32 - 1], list(range(200))):
        assert T.id_bytes(ids) == np.array(ids, "<u4").tobytes()


def test_kept_words_stay_bounded():
    enc = T.TextEncoder(PATH, True)
    enc.kept.most = enc.stems.most = 50
    texts = [" ".join(f"word{chr(97 + i * 7 % 26)}{chr(97 + j)}." for j in range(20)) for i in range(30)] + ["a" * 1000 + " b"]
    assert [enc.encode(t) for t in texts] == [enc._raw(t) for t in texts]
    assert max(len(enc.kept), len(enc.stems)) <= 50 and max(map(len, enc.kept)) <= 64


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT, st.text("aAzZéÉßẞÿÞıİK\u212a\u212bøÑñ.,!|*'s<> \x0b\x1c", max_size=30)), max_size=6))
def test_columns_of_texts_have_the_ids_of_each(texts):
    want = [T.encoder(PATH, False).encode(t or "") for t in texts]
    for kind in (pa.string(), pa.large_string()):
        column = pa.array([None, "x", *texts], kind).slice(2)
        assert list(T.encoder(PATH, True).encode_all(column)) == list(T.encoder(PATH, False).encode_all(column)) == want


class Counted:
    def __init__(self, tokenizer):
        self.tokenizer, self.calls = tokenizer, 0

    def encode_batch_fast(self, *args, **options):
        self.calls += 1
        return self.tokenizer.encode_batch_fast(*args, **options)


def spelled(i):
    return "".join(chr(97 + i // 26**k % 26) for k in range(5))


def test_unknown_words_of_a_column_share_calls():
    enc = T.TextEncoder(PATH, True)
    enc.letters = Counted(enc.letters)
    texts = [" ".join(spelled(37 * i + j) + "," for j in range(60)) for i in range(100)]
    want = [enc._raw(t) for t in texts]
    assert list(enc.encode_all(pa.array(texts))) == want
    distinct = len({w for t in texts for w in t.split()})
    assert enc.letters.calls == -(-distinct // enc.AT_ONCE)
    enc.letters.calls = 0
    assert list(enc.encode_all(pa.array(texts))) == want and enc.letters.calls == 0


def test_known_words_stay_bounded_and_the_latest_stay():
    enc = T.TextEncoder(PATH, True)
    enc.known_stems.most, enc.known_words.most, enc.AT_ONCE = 50, 9, 7
    for i in range(12):
        texts = [" ".join([spelled(30 * i + j) + ".", f"{i}-{j}", "the"]) for j in range(20 if i % 4 else 80)] + ["z" * 1000 + " b", None, ""]
        assert list(enc.encode_all(pa.array(texts))) == [enc._raw(t or "") for t in texts]
        assert len(enc.known_stems) <= 50 and len(enc.known_words) <= 9
        assert max(map(len, enc.known_stems.words.to_pylist())) <= 64
        assert "the" in enc.known_stems.words.to_pylist()


def test_models_without_word_ends_encode_each_stem():
    enc = T.TextEncoder(PATH, True)
    enc.ends_word[:] = False
    assert list(enc.encode_all(pa.array(["Some words, été", "words"]))) == [enc._raw("Some words, été"), enc._raw("words")]


def brute(table_rows):
    at, out = 0, []
    for doc_id, text in sorted(table_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = np.append(np.frombuffer(T.encoder(PATH, False).encode(text or ""), "<u4"), 2).astype("<u4")
        out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_documents_round_trip(spark):
    df = table(spark, SF, "documents")
    got = T.token_output(df, PATH, by_word=True, sequence=16, sequences_a_batch=4)
    assert rows(got, "start") == brute([(r["doc_id"], r["text"]) for r in df.collect()])


def test_edges_and_files(spark, tmp_path):
    data = [(3, "c c"), (3, "c c"), (1, None), (None, "no id"), (2, ""), (9, "long " * 30_000), (3, "b")]
    df = docs(spark, [(d, t, "s", 5) for d, t in data], ", start long")
    index = T.write_token_files(df, str(tmp_path / "out"), PATH, by_word=True, sequence=64, sequences_a_batch=2)
    assert rows(T.read_token_files(index), "start") == brute(data)
    total = 0
    for uri in {r["file"] for r in index.collect()}:
        reader = T.SequenceReader(uri)
        assert all(pa.types.is_fixed_size_list(f.type) and f.type.list_size == 64 for f in reader.batches[0].schema)
        total += reader.masked()
    assert total == sum(r[2] for r in brute(data))
    assert rows(T.token_output(df.limit(0), PATH)) == []
