import re
from collections import Counter

import numpy as np

from tillmark.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    triples = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) for j in range(i, i + 3) if triples[tuple(words[i: i + 3])] > 1}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_counts_match_brute_force(docs_of):
    texts = [(1, None), (2, ""), (3, " \t\n"), (4, "a b a b a b a"), (5, "x y z x y"), (6, "l\nl\n l\nl"),
             (7, "é# ü*$ ß%&|<> x\x1cy"), (8, "\n\na\n\n\na\n"), (9, "one two three " * 4000), (9, "dup\ndup"),
             (None, "z z z z"), (10, "end\rof\x0bline\x0cfeed")]
    got = sorted((tuple(r) for r in quality.judged(docs_of(*texts)).select(
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()))
    assert got == sorted(brute(t) for _, t in texts)


def test_base_rule_and_verdict(docs_of):
    import random

    rng = random.Random(1)
    syllables = "ba co du fe gi ho ju ka le mi".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    good = [(i, "\n".join(" ".join(word() for _ in range(9)) + " end." for _ in range(12))) for i in range(60)]
    symbols = [(100 + i, " ".join(word() + "%%%" for _ in range(90))) for i in range(8)]
    shouted = [(200 + i, " ".join(word().upper() + "!!" for _ in range(90))) for i in range(8)]
    short = [(300, "too short")]
    kept = {r["row"]["doc_id"]: (r["base_failed"], r["kept"])
            for r in quality.judged(docs_of(*good, *symbols, *shouted, *short)).collect()}
    assert all(kept[i] == (False, True) for i, _ in good)
    assert all(kept[i] == (False, False) for i, _ in symbols + shouted)
    assert kept[300] == (True, False)


def test_estimates_find_accuracies():
    rng = np.random.default_rng(0)
    good = rng.random(20_000) < 0.8
    votes = np.full((len(good), 4), quality.ABSTAIN)
    for r, (found, wrong) in enumerate([(0.9, 0.02), (0.6, 0.05), (0.7, 0.01), (0.5, 0.03)]):
        votes[:, r] = np.where(rng.random(len(good)) < np.where(good, wrong, found), quality.BAD, quality.ABSTAIN)
    seen, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.estimate(seen, counts.astype(float), prior=1.0)
    assert abs(model.good_share - 0.8) < 0.02
    assert abs(model.chances[0, 0, quality.BAD + 1] - 0.9) < 0.03
    assert ((model.posterior(votes) >= 0.5) == good).mean() > 0.95


def test_empty_table(docs_of):
    assert quality.judged(docs_of()).count() == 0
