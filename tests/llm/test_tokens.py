import hashlib

import numpy as np
import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

from martlet.llm import bpe, token_counts
from tests.llm.conftest import rows

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "  a  b\n\n c\t\x1c\x85 x", "'s 'LL don't", "x" * 3000, "ab " * 500, "\x00\x01", "ΣΑΣ İstanbul ﬁ ² Ⅷ é",
       "a<|endoftext|> <|startoftext|>b", "😀👨‍👩‍👧 漢字 한국어", *("a" + chr(c) + "1 " + chr(c) for c in range(1, 0x2000, 7))]


@pytest.fixture(scope="module")
def codec():
    with open(BYTES, "rb") as f:
        return bpe.BytePairCodec(f.read())


def test_encoder_and_decoder_equal_the_library(codec):
    library = Tokenizer.from_file(BYTES)
    for text, found in zip(ODD, library.encode_batch(ODD, add_special_tokens=False)):
        ids = codec.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == found.ids
        assert codec.decode(ids) == codec.decode(found.ids) == library.decode(found.ids, skip_special_tokens=False)


def test_merges_skip_stale_entries():
    ranks = {("a", "b"): 0, ("b", "c"): 1, ("ab", "c"): 2, ("a", "a"): 3}
    assert bpe.merge_symbols(list("abc"), ranks) == ["abc"]
    assert bpe.merge_symbols(list("aaabcb"), ranks) == ["aa", "abc", "b"]
    assert bpe.merge_symbols([], ranks) == [] and bpe.merge_symbols(["a"], ranks) == ["a"]


def test_encode_decode_on_edge_rows(spark, edge_docs, edge_rows, no_docs, codec):
    got = rows(bpe.encode_decode(edge_docs, BYTES), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    want = []
    for i, text, _ in edge_rows:
        ids = codec.encode(text or "")
        want.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert bpe.encode_decode(no_docs, BYTES).count() == 0


def test_counts_equal_the_library_and_whole_tokens_are_proven():
    with open(WORDS, "rb") as f:
        counter = token_counts.WordCounter(f.read())
    library = Tokenizer.from_file(WORDS)
    assert [counter.count(t) for t in ODD] == [len(e.ids) for e in library.encode_batch(ODD, add_special_tokens=False)]
    assert len(counter.whole) > 30_000
    some = sorted(counter.whole)[::500]
    assert all(len(e.ids) == 1 for e in library.encode_batch(some, add_special_tokens=False))


def test_counts_equal_the_library_on_all_combining_marks():
    with open(WORDS, "rb") as f:
        counter = token_counts.WordCounter(f.read())
    library = Tokenizer.from_file(WORDS)
    marks = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and regex.match(r"\p{M}", chr(c))]
    some = [*"\u0301\u0327\u0e48\u08cd\u05b0\u0651\u094d\u3099\u0345\u1dfa\u0334\u0f71", "\U0001e08f"]
    texts = [f"{base}{pair} b" for m in marks for o in some for pair in (m + o, o + m) for base in "e"] + [f"k{m}é" for m in marks]
    wrong = [t for t, e in zip(texts, library.encode_batch(texts, add_special_tokens=False)) if len(e.ids) != counter.count(t)]
    assert len(marks) > 2000 and not wrong


def test_long_keys_are_not_remembered():
    from martlet.llm.common import Remembered
    made = Remembered(len, room=3, longest=4)
    assert [made[k] for k in ("a", "bb", "ccccc", "ccccc", "dd")] == [1, 2, 5, 5, 2] and set(made) == {"a", "bb", "dd"}
    assert made["x"] == 1 and set(made) == {"x"}


def test_token_counts_on_edge_rows(edge_docs, edge_rows, no_docs):
    library = Tokenizer.from_file(WORDS)
    want = []
    for i, text, _ in edge_rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want.append((i, len((text or "").encode()), n, n > 2048))
    assert rows(token_counts.token_counts(edge_docs, WORDS), "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=repr)
    assert token_counts.token_counts(no_docs, WORDS).count() == 0
