"""Spelling variants against all pairs, and the bound of the gram index."""

import random
import zlib
from collections import Counter

import pytest

from tidewell.llm import spelling


def plain(rows):
    n = Counter()
    for doc, text in rows:
        text = "".join(c if c.isascii() and c.isalpha() or "À" <= c <= "ÿ" else " " for c in text or "")
        for run in text.split():
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    words = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    near = {w: [x for x in words if edits(w, x) == 1] for w in words}
    form = {w: min(x, key=lambda y: (-words[y], y)) for w, x in near.items() if x}
    form = {w: f for w, f in form.items() if words[f] >= 10 * words[w]}
    out = []
    for w, k in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, k, len(near[w]), words.get(form.get(w))))
    return sorted(out, key=repr)


def edits(a, b):
    if abs(len(a) - len(b)) > 1:
        return 2
    row = list(range(len(b) + 1))
    for k, x in enumerate(a, 1):
        before, row = row, [k]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("most", [2_000, 5])
def test_near_words_are_all_found(spark, monkeypatch, most):
    monkeypatch.setattr(spelling, "LIST", most)  # a short list: most grams are split by words less a letter
    monkeypatch.setattr(spelling, "EXTENDED", 50)
    rng = random.Random(5)
    letters = "abcÀé"
    words = ["".join(rng.choices(letters, k=rng.randint(6, 12))) for _ in range(60)] + ["aaaaaaaa", "x" * 80]
    for w in list(words):
        for _ in range(4):
            k = rng.randrange(len(w))
            words.append(rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1 :]]))
    rows = [(1, None), (2, ""), (None, "Straße straße STRASSE ×÷×÷×÷×÷"), (3, "İstanbul " * 3), (4, "chainword " * 300 + "chainwords " * 25 + "chainwordss " * 2)]
    rows += [(k, " ".join(rng.choices(words, weights=[40 if j < 20 else 1 for j in range(len(words))], k=150))) for k in range(40)]
    rows += [(7, " ".join(words).upper())] * 2
    docs = spark.createDataFrame([(d, t, "w", 1) for d, t in rows], "doc_id long, text string, word string, n int")
    got = sorted(map(tuple, spelling.spelling_variants(docs).collect()), key=repr)
    assert got == plain(rows)
    assert any(r[1] for r in got) and any(r[2] != r[1] and r[1] for r in got)


def test_a_gram_stays_through_any_edit():
    rng = random.Random(6)
    grams = {"".join(rng.choices("ab", k=q)): 1 for q in (2, 3, 3, 4, 4, 5, 5, 5) for _ in range(9)}
    grams = {g: 1 for g in grams if all(g[:q] in grams or q == 2 for q in range(2, len(g)))}
    for _ in range(2_000):
        w = "".join(rng.choices("ab", k=rng.randint(7, 12)))
        k = rng.randrange(len(w))
        other = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("ab") + w[k:], w[:k] + rng.choice("ab") + w[k + 1 :]])
        parts, most = spelling.decompose(w, grams)
        theirs = Counter(other[k : k + q] for k, q in spelling.decompose(other, grams)[0])
        kept = Counter(w[k : k + q] for k, q in parts) & theirs
        assert sum(kept.values()) >= len(parts) - most >= 1


def test_empty_table(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
