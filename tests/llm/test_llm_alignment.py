"""Alignment of two tokenizers against a plain walk over both token lists."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidewell.llm import alignment
from tidewell.llm.bpe import byte_symbols
from tidewell.llm.queries import QUERIES

A, B = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
BITS = ["a", " ", "  ", "\n", "\r\n", "\t", "word", " the", "é", "日本語", "　", "\xa0", "▁", "<s>", "<|endoftext|>", "<0x41>", ";\r", "\x00", "😀", "'s", " 123", "...", "\x85", "\x1c"]


def plain(rows):
    library = Tokenizer.from_file(A)
    library.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=B)
    raw = {c: b for b, c in enumerate(byte_symbols())}
    a_bytes = {k: bytes(raw[c] for c in s) for s, k in library.get_vocab().items() if set(s) <= set(raw)}

    def b_bytes(k):
        return bytes([int(pieces.id_to_piece(k)[3:5], 16)]) if pieces.is_byte(k) else pieces.id_to_piece(k).replace("▁", " ").encode()

    count, found = Counter(), []
    for doc, text in rows:
        want = (" " + (text or "")).encode()
        a = library.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        if b"".join(map(a_bytes.get, a)) != want or b"".join(map(b_bytes, b)) != want:
            a, b = [], []
        a_at = [k for k, x in enumerate(a) for _ in a_bytes[x]]
        b_at = [k for k, x in enumerate(b) for _ in b_bytes(x)]
        links = [(a[x], b[y]) for x, y in dict.fromkeys(zip(a_at, b_at, strict=True))]
        groups, mine, theirs = [], [], []
        for k, (x, y) in enumerate(zip(a_at, b_at, strict=True)):
            mine += [a[x]] if k == 0 or a_at[k - 1] != x else []
            theirs += [b[y]] if k == 0 or b_at[k - 1] != y else []
            if k + 1 == len(a_at) or (a_at[k + 1] != x and b_at[k + 1] != y):
                groups.append(f"{','.join(map(str, mine))}|{','.join(map(str, theirs))}")
                mine, theirs = [], []
        count.update(links)
        found.append((doc, len(a), len(b), groups, links))
    most = {}
    for (_, y), n in count.items():
        most[y] = max(most.get(y, 0), n)
    return sorted(
        (
            (
                doc, n_a, n_b, len(groups), len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links),
                hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
            )
            for doc, n_a, n_b, groups, links in found
        ),
        key=repr,
    )


@pytest.mark.parametrize("few", [False, True])
def test_odd_texts(spark, monkeypatch, few):
    if few:  # most groups and pairs are joined, memories are dropped at once
        for name, value in (("FREQUENT", 20), ("TOGETHER", 40), ("REMEMBERED", 50)):
            monkeypatch.setattr(alignment, name, value)
    rng = random.Random(3)
    rows = [(1, None), (2, ""), (3, " "), (4, "  "), (5, "\n"), (6, "x" * 3000), (None, "a word"), (None, "a word"), (6, "again")]
    rows += [(k + 10, "".join(rng.choices(BITS, k=rng.randint(1, 30)))) for k in range(600)]
    clashing = [(d, t, 1, 2, 3) for d, t in rows]
    docs = spark.createDataFrame(clashing, "doc_id long, text string, row int, keys int, pairs int")
    got = sorted(map(tuple, alignment.align(docs, A, B).collect()), key=repr)
    assert got == plain(rows)


def test_query_on_all_documents(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op12_token_alignment"](spark, sf).collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows)


def test_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0
