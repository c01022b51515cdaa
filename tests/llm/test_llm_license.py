"""Licence scan against a plain count of shared tokens in every block."""

import random
import re

from tidewell.llm import license_scan as scan


def plain(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places, base, labels, most = [], set(), set(), 0.0
    for label, phrase in scan.PHRASES.items():
        own = phrase.split()
        found = [k for k in range(len(words)) if words[k : k + len(own)] == own]
        places += found
        base |= {label} if found else set()
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
    for begin in range(0, max(len(pairs), 1), scan.STEP):
        held = set(pairs[begin : begin + 2 * scan.STEP])
        for label, template in scan.TEMPLATES:
            own = set(scan.tokens(template))
            if len(held & own) >= scan.THRESHOLD * len(own) - 1e-9:
                labels.add(label)
                most = max(most, len(held & own) / len(own))
    return (
        len(words), len(places), min(places, default=None), max(places, default=None),
        ",".join(sorted(base)), ",".join(sorted(base | labels)), 1.0 if places else most,
    )


def test_planted_notices(spark):
    rng = random.Random(8)
    filler = ["the", "of", "this", "software", "license", "is", "wörter", "日本", "under", "mit", "cc", "by", "version", "2"]
    texts = [None, "", "...", "UNDER the MIT-License", "under the mit licenses", "xcc by nc", "cc by nc cc/BY\nNC", "Kelvin cc by ncı", "Apache License, Version 2.0"]
    texts += [" ".join(rng.choices(filler, k=rng.randint(1, 900))) for _ in range(60)]
    for _, template in scan.TEMPLATES * 4:
        own = template.split()
        for k in range(rng.randint(0, 4)):
            own[rng.randrange(len(own))] = rng.choice(filler)
        before, after = (" ".join(rng.choices(filler, k=rng.choice([0, 3, 40, 200]))) for _ in range(2))
        texts.append(f"{before} {' '.join(own).title()} {after}")
    texts.append("word " * 150_000 + scan.TEMPLATES[1][1])
    rows = [(k if k % 5 else None, t, 1, "x") for k, t in enumerate(texts + texts[:20])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int, words string")
    got = sorted(map(tuple, scan.scan(docs).collect()), key=repr)
    assert got == sorted(((d, *plain(t)) for d, t, _, _ in rows), key=repr)
    assert sum(r[6] != r[5] for r in got) > 20


def test_no_python_on_the_path(spark, sf):
    plan = scan._read(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Exchange" not in plan


def test_empty_table(spark):
    assert scan.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0
