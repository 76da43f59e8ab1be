"""Aligned tokens against a brute force over whole texts, by the plain libraries."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tillmark.llm import alignment

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def _letters():
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in keep]
    return {**{chr(b): b for b in keep}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def _ranges(tokens):
    out, at = [], 0
    for i, size in tokens:
        out.append((at, at + size, i))
        at += size
    return out


def brute(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of each text."""
    one = Tokenizer.from_file(A)
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=B)
    letters, made, counts = _letters(), [], Counter()
    for text in texts:
        want = (" " + (text or "")).encode()
        found = one.encode(" " + (text or ""), add_special_tokens=False)
        a = [(i, bytes(letters[c] for c in t)) for i, t in zip(found.ids, found.tokens)]
        b = []
        for i in two.encode(text or ""):
            piece = two.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if two.is_byte(i) else piece.replace("▁", " ").encode()))
        if not text or any(b"".join(x for _, x in side) != want for side in (a, b)):
            made.append(None)
            continue
        ra, rb = (_ranges([(i, len(x)) for i, x in side]) for side in (a, b))
        links, j = [], 0
        for s, e, i in ra:
            while rb[j][1] <= s:
                j += 1
            k = j
            while k < len(rb) and rb[k][0] < e:
                links.append((i, rb[k][2]))
                k += 1
        cuts = sorted({e for _, e, _ in ra} & {e for _, e, _ in rb})
        groups, x, y = [], 0, 0
        for cut in cuts:
            ga, gb = [], []
            while x < len(ra) and ra[x][1] <= cut:
                ga.append(str(ra[x][2]))
                x += 1
            while y < len(rb) and rb[y][1] <= cut:
                gb.append(str(rb[y][2]))
                y += 1
            groups.append(",".join(ga) + "|" + ",".join(gb))
        made.append((len(ra), len(rb), len(groups), links, ";".join(groups)))
        counts.update(set(links))
    highest = defaultdict(int)
    for (i, _), n in counts.items():
        highest[i] = max(highest[i], n)
    return [(0, 0, 0, 0, 0, 0, "") if m is None else (
        *m[:3], len(m[3]), sum(counts[p] == highest[p[0]] for p in m[3]), sum(counts[p] for p in m[3]), m[4])
        for m in made]


HARD = [None, "", " ", "\n", "a", "  two  spaces ", "tab\tand\r\nlines\n\n\n  x", "\x1c\x85\xa0odd space   y",
        "<|endoftext|> <s></s><0x41><unk> x", "literal ▁ piece", "日本語 テキスト, mixed 한국어 😀👍🏽", "é ﬁ ½ \x00 nul",
        "same text here", "same text here", "don't we'll 123,456.78 !!!???", "word\n\n word \n word\t word", "a" * 3000,
        "x " * 2000, "long " + "ungheiten zueinander " * 3000, "İstanbul ß ẞ", "﻿bom", "1\n2 3\n 4"]


@pytest.mark.parametrize("unit_bytes", [alignment.UNIT_BYTES, 1])
def test_equals_brute_force(spark, docs_of, unit_bytes):
    docs = docs_of(*[(i // 2, t) for i, t in enumerate(HARD)], extra=False)
    got = alignment.align(docs.repartition(3), A, B, unit_bytes=unit_bytes)
    rows = sorted((tuple(r) for r in got.select(
        "row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups").collect()))
    want = sorted((i // 2, *w) for i, w in enumerate(brute(HARD)))
    assert rows == want
    assert any(w[1] and w[3] for w in want)


def test_supplied_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = alignment.align(docs, A, B, groups="sha256")
    have = {r["doc_id"]: tuple(r)[1:] for r in got.select(
        "row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups").collect()}
    want = dict(zip(texts, brute(list(texts.values())), strict=True))
    assert have == {k: (*w[:6], hashlib.sha256(w[6].encode()).hexdigest() if w[6] else "") for k, w in want.items()}


def test_no_rows_and_clashing_columns(spark, docs_of):
    assert alignment.align(docs_of(), A, B).count() == 0
    clashing = docs_of((1, "some words"), (2, None)).selectExpr("*", "'y' AS unit", "3 AS n_a", "'z' AS `groups`")
    got = alignment.align(clashing, A, B).select("row.unit", "row.n_a", "row.groups", "n_links").collect()
    assert sorted(map(tuple, got)) == [("y", 3, "z", 0), ("y", 3, "z", got[0]["n_links"] or got[1]["n_links"])]


def test_stretches_are_used_for_the_supplied_vocabularies():
    sides = alignment.Sides(open(A, encoding="utf-8").read(), open(B, "rb").read(), remembered=10)
    assert sides.in_stretches
    texts = [" ".join(f"word{i}" for i in range(50))]
    first = [t.id.tolist() for t in sides.tokens(texts)]
    for n in range(40):  # others come, are not remembered, and then it starts anew
        sides.tokens([f"other{n} things{n}"])
    assert len(sides.known) < 50
    assert [t.id.tolist() for t in sides.tokens(texts)] == first and first[0]
