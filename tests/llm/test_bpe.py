import base64
import struct

import public_tokenizers
import pytest
import tiktoken

from tillmark.llm import bpe

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
HARD = [(1, "a" * 5000 + " b"), (2, " " * 3000 + "x"), (3, "ab\n\n" * 400), (4, None), (5, ""), (6, "é" * 2000),
        (7, "it's " * 900), (7, "it's " * 900), (8, "x 　\x1c y" * 300), (None, "plain text"),
        (9, "<|endoftext|> \x00 \U0001f600")]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("chunk, overlap", [(200, 20), (1000, 100), (32_768, 1024)])
def test_equals_the_library_and_decodes_to_the_text(docs_of, library, chunk, overlap):
    encoded = bpe.encode(docs_of(*HARD), RANKS, public_tokenizers.PATTERN, chunk, overlap, decoded=True)
    got = sorted(((r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in encoded.collect()), key=repr)
    want = []
    for i, t in HARD:
        ids = library.encode_ordinary(t or "")
        want.append((i, struct.pack(f"<{len(ids)}I", *ids), (t or "").encode()))
    assert got == sorted(want, key=repr)


def test_decode_by_itself(docs_of):
    encoded = bpe.encode(docs_of((1, "round trip"), (2, None)), RANKS, public_tokenizers.PATTERN)
    assert encoded.columns == ["doc_id", "ids"]
    got = {r["doc_id"]: bytes(r["decoded"]) for r in bpe.decode(encoded, RANKS).collect()}
    assert got == {1: b"round trip", 2: b""}


def test_empty_table(docs_of):
    assert bpe.encode(docs_of(), RANKS, public_tokenizers.PATTERN).count() == 0
