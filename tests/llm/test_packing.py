import random
import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tillmark.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
HARD = [(1, None), (2, ""), (3, "Word, word. WORD!"), (3, "Word, word. WORD!"), (None, "x y\x1cz"),
        (4, "á b ́c ábc, Á."), (5, "İstanbul, ΣΑΣ. Σ İ. ſet, K."), (6, "x<|endoftext|>y"), (7, "it's, 's. a.b ... a!!"),
        (8, "many words here " * 6000)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("smallest", [1, 16])
def test_pieces_make_up_documents_and_sequences(docs_of, library, smallest):
    rng = random.Random(2)
    docs = HARD + [(i, " ".join(rng.choice("red green blue sky".split()) for _ in range(rng.randrange(3000))))
                   for i in range(10, 60)]
    rows = packing.pack(docs_of(*docs), PATH, smallest=smallest, with_ids=True).collect()
    want = defaultdict(list)
    for i, t in docs:
        want[i].append([*library.encode(t or "", add_special_tokens=False).ids, 2])
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    for i, texts in want.items():
        for ids in {tuple(x) for x in texts}:
            flat = struct.pack(f"<{len(ids)}I", *ids)
            own = sorted((r for r in pieces[i] if r["doc_tokens"] == len(ids)), key=lambda r: r["start"])
            assert sum(r["length"] for r in own) == len(ids) * sum(x == list(ids) for x in texts)
            assert all(r["ids"] == flat[4 * r["start"]: 4 * (r["start"] + r["length"])] for r in own)
    tokens = padded = 0
    for own in sequences.values():
        own.sort(key=lambda r: r["offset"])
        at = 0
        for r in own:
            assert r["offset"] == at
            at += r["length"]
        assert 0 < at <= 4096 and own[0]["padded_to"] in (at, 4096)
        tokens, padded = tokens + at, padded + own[0]["padded_to"]
    assert padded == tokens if smallest == 1 else padded < 2 * tokens


def test_cuts():
    assert packing.cut_lengths(4096, 4096) == [4096]
    assert packing.cut_lengths(9001, 4096) == [4096, 4096, 512, 256, 32, 8, 1]
    assert packing.cut_lengths(9001, 4096, 64) == [4096, 4096, 512, 256, 41]


def packed(lengths, smallest=packing.SMALLEST, capacity=4096):
    bins = packing.Bins(0, capacity, smallest)
    for doc, n in enumerate(lengths):
        bins.add_document(doc, struct.pack(f"<{n}I", *range(n)))
    before_end = len(bins.closed)
    bins.finish()
    return bins, before_end


LENGTHS = random.Random(5)


@pytest.mark.parametrize("lengths", [
    [LENGTHS.randrange(20, 3000) for _ in range(4000)],
    [min(60_000, int(LENGTHS.lognormvariate(5.5, 1.2)) + 1) for _ in range(6000)],
    [3000] * 900, [2049] * 900, [4096 + 7] * 500, [50] * 30_000, [1] * 9000, [4095] * 500, [1366] * 1500])
def test_documents_stay_whole_and_sequences_full(lengths):
    bins, before_end = packed(lengths)
    documents, tokens, padded = defaultdict(list), 0, {}
    for doc, start, length, crc, total, sequence, _, padded_to, _ in bins.closed:
        documents[doc].append((start, length))
        assert total == lengths[doc] and crc == zlib.crc32(
            struct.pack(f"<{length}I", *range(start, start + length)))
        tokens, padded[sequence] = tokens + length, padded_to
    for doc, own in documents.items():
        own.sort()
        assert [s for s, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
        assert sum(n for _, n in own) == lengths[doc]
    assert len(documents) == len(lengths) and tokens == sum(lengths)
    assert sum(padded.values()) <= 1.02 * tokens
    for doc, _, length, _, total, *_ in bins.closed[:before_end]:
        assert length >= packing.SMALLEST or length == total
    # The last sequence of a task is cut at up to 11 places, each with a piece on either side.
    assert sum(length < packing.SMALLEST and length != total
               for _, _, length, _, total, *_ in bins.closed) <= 22
    # One cut a bin at most, beside full sequences and the last one's.
    full = sum(length == 4096 != total for _, _, length, _, total, *_ in bins.closed)
    assert len(bins.closed) <= len(lengths) + len(padded) + full + 24


def test_few_pieces_a_document():
    lengths = [min(60_000, int(LENGTHS.lognormvariate(5.5, 1.2)) + 1) for _ in range(6000)]
    bins, _ = packed(lengths)
    assert len(bins.closed) <= 1.3 * len(lengths) + sum(n // 4096 for n in lengths)


def test_what_waits_is_bounded():
    bins = packing.Bins(0, 4096, 32)
    for n in list(range(1, 4097)) * 3:
        bins.add_document(n, bytes(4 * n))
        assert len(bins.open) <= 128 and len(bins.waiting) <= 128


def test_parts_of_a_piece():
    assert packing.divide(40, 40, 32) == 40 and packing.divide(41, 40, 32) is None
    assert packing.divide(100, 40, 32) == 40 and packing.divide(70, 50, 32) == 38
    assert packing.divide(41, 40, 1) == 40


def test_remembered_words_are_bounded():
    kept = packing.Remembered(3)
    for k in "abcdefghijklmnopqr":
        kept.add({x: b"1" for x in kept.lacking({k, "a"})})
    assert 0 < len(kept.known) <= 4
    assert packing.Remembered(3).lacking({"a"}) == ["a"]


def test_ids_stay_right_when_words_are_forgotten(library):
    tokenizer = packing.WordTokenizer(open(PATH, encoding="utf-8").read())
    tokenizer.words, tokenizer.bare = packing.Remembered(5), packing.Remembered(4)
    for i in range(60):
        text = f"The word{i} and, again Word{i % 7}. the END{i}!"
        ids = library.encode(text, add_special_tokens=False).ids
        assert tokenizer.encode(text) == struct.pack(f"<{len(ids)}I", *ids)


def test_empty_table(docs_of):
    assert packing.pack(docs_of(), PATH).count() == 0


def test_new_words_are_given_to_the_tokenizer_at_once(library):
    class Counted:
        given = 0

        def encode_batch_fast(self, texts, **how):
            self.given += len(texts)
            return library.encode_batch_fast(texts, **how)

    tokenizer = packing.WordTokenizer(open(PATH, encoding="utf-8").read())
    tokenizer.tokenizer = counted = Counted()
    letters = "abcdefghij"
    text = " ".join(f"Qu{a}r{b}t{'.***' if a < b else ''}" for a in letters for b in letters)
    assert tokenizer.encode(text) == struct.pack("<%dI" % len(i := library.encode(text).ids), *i)
    assert counted.given <= 3


@pytest.mark.parametrize("text", [
    "İstanbul foo bar", "ΣΑΣ σς test", "Ω K kelvin", "café café ǅ",
    "a b\tc don't we'll x,'s y'", "中文 가 jamo 가", "</w> a</w>b <s> s>", "Ⱟ Ᲊ new letters",
    "\U00010d4a \U00016d40 odd", "word_a word_ word-- --word 12 x1.", "", "  x  "])
def test_odd_words_have_the_ids_of_the_whole_text(library, text):
    tokenizer = packing.WordTokenizer(open(PATH, encoding="utf-8").read())
    for _ in range(2):
        ids = library.encode(text, add_special_tokens=False).ids
        assert tokenizer.encode(text) == struct.pack(f"<{len(ids)}I", *ids)
