import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from llm.conftest_llm import ODD_TEXTS
from hypothesis import given, settings
from hypothesis import strategies as st

from fiscalake.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
OURS = bpe.Encoder(bpe.read_bytes(PATH), public_tokenizers.PATTERN)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=120), min_size=1, max_size=5))
def test_ids_are_those_of_the_library(texts):
    for text, ids in zip(texts, OURS.encode(texts)):
        assert ids.tolist() == LIBRARY.encode_ordinary(text)
        assert OURS.decode(ids).decode("utf-8") == text


@pytest.mark.parametrize("piece", [b"ab", b"aaaa", "été".encode(), b"x" * 500, bytes(range(32, 127)) * 5])
def test_lanes_and_long_pieces_agree(piece):
    assert bpe.merge_lanes([piece], OURS.pairs)[0] == bpe.merge_long(piece, OURS.pairs)


def test_documents_round_trip(frame, prose):
    texts = ODD_TEXTS + [prose(k, 200) for k in range(5)] + ["<|endoftext|> Ünïcode 漢字"]
    docs = frame([*enumerate(texts), (0, None), (None, "x")], "doc_id bigint, text string")
    found = bpe.encode_documents(docs, PATH, public_tokenizers.PATTERN, with_ids=True)
    rows = found.collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        text = "x" if r.doc_id is None else texts[r.doc_id] or ""
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(r.ids).hexdigest() and len(r.ids) == 4 * r.n_tokens
        if len(text) < 2000:
            assert r.n_tokens == len(LIBRARY.encode_ordinary(text))
    back = {(r.doc_id, r.text) for r in bpe.decode_ids(found, PATH).collect()}
    assert back == {(k, t or "") for k, t in [*enumerate(texts), (None, "x")]}


def test_no_rows(frame):
    docs = frame([], "doc_id bigint, text string")
    assert bpe.encode_documents(docs, PATH, public_tokenizers.PATTERN).count() == 0
