"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import hashlib
import itertools
import random
import re
import tracemalloc

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidewell.llm import (
    bpe,
    components,
    jaccard_join,
    line_quality,
    packing,
    pii_bootstrap,
    preference,
    sentence_spans,
    toxic_crf,
    vector_forest,
    warc,
)
from tidewell.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, source string, row int, doc int, key string, run string, n int, score double, spans string"
LONG = " ".join(f"word{k % 977}" for k in range(20_000))


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, 2, "k", "r", 3, 0.5, "s") for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(400)]
    base = " ".join(rng.choices(words, k=120))
    near = base.replace(base.split()[60], "changed")
    return docs(
        spark,
        [
            (1, None, "a"), (2, "", None), (3, "one two", "a"), (4, base, "a"), (5, base, "b"), (6, near, "a"),
            (7, LONG, "a"), (None, base, "a"), (None, None, None), (8, " \n\t ", "a"), (3, "one two", "a"),
            (9, "word", "a"), (9, "other text here", "c"),
        ],
    )


OPERATORS = {
    "packing": lambda d: packing.pack(d, public_tokenizers.path("byte_bpe_50k.json")),
    "bpe": lambda d: bpe.encode_digests(d, public_tokenizers.path("word_bpe_49k.json")),
    "jaccard": jaccard_join.jaccard_classes,
    "one_per_class": jaccard_join.one_per_class,
    "quality": line_quality.line_rules,
    "pii": pii_bootstrap.find_spans,
    "masked": pii_bootstrap.masked,
    "spans": sentence_spans.remove_repeated_spans,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables_give_no_rows(spark, name):
    assert OPERATORS[name](docs(spark, [])).count() == 0


@pytest.mark.parametrize("name", ["bpe", "jaccard", "quality", "pii", "masked", "spans"])
def test_every_row_gives_a_row(odd, name):
    assert OPERATORS[name](odd).count() == odd.count()


def test_components_are_the_least_reachable_nodes(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1040)] + [(5, 5), (None, 3)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = components.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert {(r.node, r.root) for r in got} == {(x, root(x)) for x in parent}
    assert len(got) == len(parent)


def test_pieces_of_odd_rows(odd):
    got = OPERATORS["packing"](odd).toPandas()
    assert (got.groupby("sequence_id")["length"].sum() <= 1024).all()
    assert (got["piece"] == 0).sum() == odd.count()
    assert set(got[got["doc_id"] == 1]["length"]) == {1}  # a null text is its end alone


def test_search_exchanges_until_bins_empty():
    rng = np.random.default_rng(2)
    sizes = rng.integers(200, 480, 900)
    bins = packing.Bins(sizes, 1024)
    before = len(bins.members)
    squares = sum((1024 - f) ** 2 for f in bins.free)
    bins.search()
    kept = [m for m in bins.members if m]
    assert len(kept) < before
    assert sum((1024 - f) ** 2 for f in bins.free) > squares
    assert sorted(k for m in kept for k in m) == list(range(900))
    assert all(sum(sizes[k] for k in m) <= 1024 for m in kept)


def test_best_fit_takes_the_tightest_bin():
    rng = np.random.default_rng(4)
    for low, high in ((1, 1024), (300, 600), (1, 40)):
        sizes = rng.integers(low, high, 400)
        free: list[int] = []
        for size in sorted(sizes, reverse=True):
            room = min((f for f in free if f >= size), default=None)
            if room is None:
                free.append(1024 - size)
            else:
                free[free.index(room)] -= size
        assert sorted(packing.Bins(sizes, 1024).free) == sorted(free)


def test_search_leaves_no_exchange():
    """All moves, exchanges and two-for-one exchanges of all bins, tried one by one."""
    rng = np.random.default_rng(5)
    for low, high in ((200, 480), (100, 900), (10, 300)):
        bins = packing.Bins(rng.integers(low, high, 120), 1024)
        bins.search()
        kept = [(f, [bins.sizes[i] for i in m]) for m, f in zip(bins.members, bins.free, strict=True) if m and f]
        for g, (free, own) in enumerate(kept):
            for b, (room, held) in enumerate(kept):
                given = [0, *held, *(x + y for x, y in itertools.combinations(held, 2))]
                for size, x in itertools.product(own, given):
                    less = size - x
                    better = less * (free - (room - less)) > 0
                    assert b == g or not (0 < less <= room and better)


def test_copies_and_near_copies_are_one_class(odd):
    got = jaccard_join.jaccard_classes(odd).toPandas()
    own = got[got["class_id"] == 4]
    assert len(own) == 4 and (own["n_links"] == 3).all()
    assert sorted(own["n_copies"]) == [1, 3, 3, 3]
    assert got[got["doc_id"] == 3]["n_links"].tolist() == [1, 1]
    assert got[got["doc_id"].isin([1, 2, 8])]["n_links"].sum() == 0
    kept = jaccard_join.one_per_class(odd).toPandas()
    assert set(kept["doc_id"].dropna()) == {1, 2, 3, 4, 7, 8, 9} and len(kept) == 9
    assert list(kept.columns) == odd.columns


def test_leaders_stand_for_what_is_near_to_them():
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 10**6, (3, jaccard_join.TOKENS))
    tokens = np.repeat(centre, 40, axis=0)
    for row in tokens:  # up to three of 64 tokens differ
        row[rng.integers(0, jaccard_join.TOKENS, rng.integers(0, 4))] = -1 - rng.integers(0, 10**6)
    rows = jaccard_join.pd.DataFrame({"key": 1, "path": 1, "more": True, "set_id": np.arange(120), "tokens": [*tokens]})
    got = jaccard_join._near(rows, 0.55)
    assert dict(zip(got["set_id"], got["root"], strict=True)) == {k: k // 40 * 40 for k in range(120)}
    assert got["leads"].sum() < 30


def test_large_buckets_split_and_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BUCKET", 10)
    monkeypatch.setattr(jaccard_join, "CHUNK", 20)
    monkeypatch.setattr(jaccard_join, "BLOCK", 2_000)
    rng = random.Random(9)
    words = [f"w{k}" for k in range(5_000)]
    common = rng.choices(words, k=60)
    rows = []
    for k in range(120):  # near copies of one text, and others that share half of it
        text = rng.choices(words, k=3) + common[:] + rng.choices(words, k=2) if k < 60 else common[:30] + rng.choices(words, k=40)
        rows.append((k, " ".join(text), "s"))
    got = jaccard_join.jaccard_classes(docs(spark, rows)).toPandas().set_index("doc_id")
    sets = {k: set(jaccard_join.shingles(t, 5).tolist()) for k, t, _ in rows}
    for a in sets:
        links = sum(5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) for b in sets if b != a)
        assert got.loc[a, "n_links"] == links


def test_vectors_without_direction_stay_alone(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [float("nan"), 1.0]), (6, [None, 1.0]),
            (7, []), (8, [1.0, 0.0]), (None, [1.0, 0.01]), (9, [float("inf"), 1.0]), (10, [1.0]), (8, [1.0, 0.0])]
    got = vector_forest.near_vectors(spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, key int"))
    got = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in got.collect()}
    alone = {(k, 0, k, True) for k in (3, 4, 5, 6, 7, 9, 10)}
    assert got == alone | {(1, 4, 1, True), (2, 4, 1, False), (8, 4, 1, False), (None, 4, 1, False)}
    assert vector_forest.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_forest_counts_each_link_once(spark, monkeypatch):
    for name, value in (("LEAF", 40), ("BLOCK", 25), ("NODE", 8)):
        monkeypatch.setattr(vector_forest, name, value)
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((60, 16))
    x = (centres[rng.integers(0, 60, 600)] + 0.25 * rng.standard_normal((600, 16))).astype(np.float32)
    frame = spark.createDataFrame([(k, [float(v) for v in row]) for k, row in enumerate(x)], "vec_id long, embedding array<float>")
    got = vector_forest.near_vectors(frame).toPandas().set_index("vec_id").sort_index()
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    close = unit @ unit.T >= 0.9
    np.fill_diagonal(close, False)
    want = close.sum(axis=1)
    assert (got["n_links"].to_numpy() <= want).all()
    assert got["n_links"].sum() >= 0.97 * want.sum()


def test_archives_are_checked(spark, tmp_path):
    pages = spark.createDataFrame(
        [(1, "http://a/\r\nX: y", "<p>same"), (2, None, "<p>same"), (3, "u", None), (None, "u", "<p>same"), (4, "ü", "é" * 50_000), (2, None, "<p>same")],
        "page_id long, url string, html string",
    )
    folder = f"file://{tmp_path}/archives"
    got = warc.round_trip(pages, folder).toPandas()
    assert len(got) == 6
    assert sorted(got["record_type"]) == ["response"] * 4 + ["revisit"] * 2
    assert set(got[got["record_type"] == "revisit"]["refers_to"]) == {2}
    assert set(got[got["page_id"] == 3]["payload_bytes"]) == {0} and set(got[got["page_id"] == 4]["payload_bytes"]) == {100_000}
    data = next(tmp_path.glob("archives/*.zst")).read_bytes()
    assert sum(1 for _ in warc.records(data)) >= 1
    for broken in (data[:-3], data[:6], b"x" + data[1:], data + b"junk", data[: len(data) // 2]):
        with pytest.raises(warc.ArchiveError):
            list(warc.records(broken))
    bad = warc.Writer(b"x" * 64)
    bad.add([("WARC-Type", "response")], b"")
    with pytest.raises(warc.ArchiveError):
        list(warc.records(bad.bytes()))
    assert warc.round_trip(pages.limit(0)).count() == 0
    small = warc.round_trip(pages, least_bytes=100).toPandas()
    assert set(small["record_type"]) == {"response"}


def test_lines_of_many_texts_are_removed(spark):
    rows = [(k, f"the common line of this host\nown {k} words " + " ".join(f"x{k}y{j}" for j in range(60)), "h") for k in range(60)]
    rows += [(100 + k, "the common line of this host\n" * 20 + " ".join(f"z{k}z{j}" for j in range(20)), "h") for k in range(3)]
    rows += [(200 + k, " ".join(f"copy{j}" for j in range(80)), "h") for k in range(50)]
    got = line_quality.line_rules(docs(spark, rows)).toPandas().set_index("doc_id")
    assert (got.loc[:59, "n_lines_removed"] == 1).all() and got.loc[:59, "kept"].all()
    assert not got.loc[100:102, "kept"].any()
    assert got.loc[200:, "kept"].all()  # exact copies count as one text


def test_repeated_words_by_brute_force():
    rng = random.Random(5)
    for _ in range(200):
        words = [rng.choice("abc").encode() for _ in range(rng.randrange(30))]
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        hit = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
        assert line_quality.repeated_words(words) == len(hit)


_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _plain_spans(text):
    out = []
    for kind, pattern in _PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"\D", "", m.group())
            luhn = sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(map(int, reversed(digits))))
            valid = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and luhn % 10 == 0,
                "phone": 8 <= len(digits) <= 15,
            }
            if valid[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_base_spans_by_plain_patterns(spark):
    rng = random.Random(5)
    bits = ["a@b.co", "x.y+z@mail.example.org", "a@b.c_x@d.ef", "1.2.3.4", "256.1.1.1", "001.002.003.255", "1.2.3.4.5.6.7.8",
            "4111 1111 1111 1111", "4111-1111-1111-1111", "41111111111111111", "+1 (310) 555-4510", "+12345678", "+1 2", "é😀", " ",
            ", ", "\n", "9" * 40, "@@", "a@", "++", "a" * 200, "-"]
    texts = ["".join(rng.choices(bits, k=rng.randint(1, 12))) for _ in range(600)] + [None, "", "1" * 30_000, "a" * 100_000, "1.1." * 5_000]
    got = pii_bootstrap.find_spans(docs(spark, [(k, t, "s") for k, t in enumerate(texts)]))
    for row in got.select("doc_id", pii_bootstrap.as_text(F.col("base")).alias("base")).collect():
        assert row.base == _plain_spans(texts[row.doc_id] or "")


def test_addresses_may_have_parts_of_zero(spark):
    bits = ["10.0.0.1", "0.0.0.0", "000.1.2.3", "127.0.0.1", "8.8.8.0", "0.256.0.1", "0000.00.0.255", "0300.0.0.0"]
    texts = [f"{a} and {b}" for a in bits for b in bits] + ["0" * 4_000 + ".1.2.3", "1." + "0" * 4_000 + ".999.3"]
    got = pii_bootstrap.find_spans(docs(spark, [(k, t, "s") for k, t in enumerate(texts)]))
    for row in got.select("doc_id", pii_bootstrap.as_text(F.col("base")).alias("base")).collect():
        assert row.base == _plain_spans(texts[row.doc_id])
    masked = pii_bootstrap.masked(docs(spark, [(1, "at 10.0.0.1 and 300.0.0.1", "s")])).collect()
    assert masked[0].text == "at <IP> and 300.0.0.1"


def test_the_whole_query_by_plain_patterns(spark, sf, tmp_path):
    given = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    zero = spark.createDataFrame([(10**9, "from 192.168.0.1 to 256.0.0.1"), (10**9 + 1, None)], given.schema)
    given.union(zero).write.parquet(f"{tmp_path}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in given.union(zero).collect()}
    got = QUERIES["op7_contextual_pii"](spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for row in got:
        base = _plain_spans(texts[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        kinds = [x.split(":")[0] for x in base.split(",")]
        assert [row[f"n_{k}"] for k in pii_bootstrap.KINDS] == [kinds.count(k) for k in pii_bootstrap.KINDS]
        assert set(filter(None, base.split(","))) <= set(row.spans.split(","))


def test_contexts_discover_identifiers(spark):
    rows = [(k, f"x{k} please call number +1 (310) 555-{1000 + k} today thanks", "s") for k in range(30)]
    rows += [(100, "x please call number 310 555 9999 today thanks", "s"), (101, "some other figure 310 555 8888 stands here", "s"),
             (102, "and again 310 555 9999 elsewhere", "s")]
    got = {r.doc_id: r.spans for r in pii_bootstrap.find_spans(docs(spark, rows)).select("doc_id", pii_bootstrap.as_text(F.col("spans")).alias("spans")).collect()}
    assert got[100] == "phone:21:33" and got[102] == "phone:10:22" and got[101] == ""
    masked = {r.doc_id: r.text for r in pii_bootstrap.masked(docs(spark, rows)).collect()}
    assert masked[100] == "x please call number <PHONE> today thanks"
    assert masked[3] == "x3 please call number <PHONE> today thanks"


def test_no_python_runs_for_personal_data(odd):
    plan = pii_bootstrap.masked(odd)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_first_place_of_a_passage_stays(spark):
    passage = "This passage of the text has quite a few words in it. And it goes on here for some more words. It ends now."
    rows = [(2, f"Start of two. {passage} End of two.", "s"), (1, f"Start of one. {passage} {passage}", "s"), (3, "Nothing here is shared with others at all, not one word of it.", "s"),
            (None, f"No id. {passage}", "s")]
    got = {r.doc_id: r for r in sentence_spans.remove_repeated_spans(docs(spark, rows)).collect()}
    assert got[1].kept_text == f"Start of one. {passage} "
    assert got[2].kept_text == "Start of two. End of two."
    assert got[3].n_removed == 0 and got[None].kept_text == "No id. "
    span = got[2].removed_spans[0]
    assert got[2].text[span.start : span.end].strip() == passage


def test_texts_are_moved_once_and_cut_one_at_a_time(spark, odd):
    plan = sentence_spans.remove_repeated_spans(odd.select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    [given] = re.findall(r"MapInPandas .*?\(([^)]*)\)", plan)
    assert "text#" in given and given.count("text") == 1

    rng = random.Random(3)
    text = " ".join(f"w{rng.randrange(500)}" for _ in range(5_000))
    frame = pd.DataFrame({"doc": range(100), "text_key": range(100), "text": text})
    peaks = []
    for rows in (20, 100):
        list(sentence_spans._run_batches(iter([frame[:1]])))
        tracemalloc.start()
        [out] = sentence_spans._run_batches(iter([frame[:rows]]))
        peaks.append((tracemalloc.get_traced_memory()[1] - sum(r.nbytes for r in out["runs"])) / 1e6)
        tracemalloc.stop()
    assert peaks[1] < peaks[0] + 1


def test_an_id_with_a_null_text_and_one_that_loses_a_passage(spark):
    passage = "This passage of the text has quite a few words in it. And it goes on here for some more words. It ends now."
    rows = [(1, passage, "s"), (3, None, "s"), (3, f"Start. {passage}", "s")]
    got = sentence_spans.remove_repeated_spans(docs(spark, rows)).select("doc_id", "text", "kept_text").collect()
    assert sorted(got, key=repr) == [(1, passage, passage), (3, f"Start. {passage}", "Start. "), (3, None, "")]


def test_any_passage_of_51_words_is_found(spark):
    rng = random.Random(11)

    def words(n, tag, marks):
        return [f"{tag}{rng.randrange(10**6)}" + rng.choice(["", "", "", "", "", ".", "!", ","] if marks else [""]) for _ in range(n)]

    rows = []
    for k in range(400):
        passage = words(rng.choice([51, 60, 80]), "p", k % 2)
        for doc in (2 * k, 2 * k + 1):
            before, after = words(rng.randrange(60), "b", k % 2), words(rng.randrange(60), "a", k % 2)
            rows.append((doc, " ".join(before + passage + after), "s"))
    rows.append((9_000, " ".join(["same"] * 70), "s"))
    rows.append((9_001, " ".join(["other", *["same"] * 60]), "s"))
    texts = {doc: text for doc, text, _ in rows}
    got = {r.doc_id: r for r in sentence_spans.remove_repeated_spans(docs(spark, rows)).collect()}
    for doc in range(1, 800, 2):
        first, own = texts[doc - 1].split(), texts[doc].split()
        grams = {tuple(first[k : k + 12]) for k in range(len(first) - 11)}
        shared = set()
        for k in range(len(own) - 11):
            shared.update(own[k : k + 12] if tuple(own[k : k + 12]) in grams else ())
        gone = "".join(texts[doc][x.start : x.end] for x in got[doc].removed_spans).split()
        assert len(shared) >= 51 and 12 <= len(gone) and set(gone) <= shared
        assert len(shared) - len(gone) <= 4 * sentence_spans.GAP
        assert got[doc - 1].n_removed == 0
    assert got[9_001].n_removed > 0


def test_marginals_by_all_labellings():
    rng = np.random.default_rng(7)
    emission, moves = rng.standard_normal((4, 5)), rng.standard_normal((2, 2))
    length = np.array([5, 3, 1, 4])
    got, pairs = toxic_crf.marginals(emission, length, moves)
    moved = np.zeros((2, 2))
    for c, n in enumerate(length):
        weight, toxic, own = 0.0, np.zeros(5), np.zeros((2, 2))
        for code in range(2**n):
            label = [code >> k & 1 for k in range(n)]
            score = sum(emission[c, k] * y for k, y in enumerate(label)) + sum(moves[a, b] for a, b in zip(label, label[1:], strict=False))
            w = np.exp(score)
            weight += w
            for k, y in enumerate(label):
                toxic[k] += w * y
            for a, b in zip(label, label[1:], strict=False):
                own[a, b] += w
        assert np.allclose(got[c, :n], toxic[:n] / weight)
        moved += own / weight
    assert np.allclose(pairs, moved)


def test_without_labels_nothing_is_toxic(spark, odd):
    labels = spark.createDataFrame([(4, None), (None, 1), (5, 0)], "doc_id long, toxic int")
    model = toxic_crf.train(odd, labels)
    got = toxic_crf.score(odd, model)
    assert got.count() == odd.count() and got.where("score != 0 or size(spans) > 0").count() == 0
    assert toxic_crf.without_toxic(odd, model).count() == odd.count()
    assert toxic_crf.score(docs(spark, []), model).count() == 0


def test_copies_of_a_toxic_text_hide_no_words(spark):
    rng = random.Random(12)
    plain, bad = [f"ordinary{k}" for k in range(300)], ["scumbag", "vermin", "filthy", "moronic"]

    def text(toxic):
        words = rng.choices(plain, k=40)
        for word in rng.sample(bad, 2) if toxic else ():
            words.insert(rng.randrange(len(words)), word)
        return " ".join(words)

    copied = " ".join(w for k in range(4) for w in [*rng.choices(plain, k=8), bad[k]])
    rows = [(k, text(False), "s") for k in range(300)] + [(1_000 + k, text(True), "s") for k in range(90)]
    rows += [(2_000 + k, copied, "s") for k in range(90)]
    labels = spark.createDataFrame([(k, int(k >= 1_000)) for k, _, _ in rows], "doc_id long, toxic int")
    model = toxic_crf.train(docs(spark, rows), labels)
    got = toxic_crf.score(docs(spark, rows), model).where(toxic_crf.held_out(F.col("doc_id"))).collect()
    texts = {doc: t for doc, t, _ in rows}
    for row in got:
        assert (row.score >= toxic_crf.THRESHOLD) == (row.doc_id >= 1_000)
        if row.doc_id >= 1_000:
            found = " ".join(texts[row.doc_id][x.start : x.end] for x in row.spans).split()
            assert sorted(found) == sorted(w for w in texts[row.doc_id].split() if w in bad)


def test_preferences_share_the_longest_prefix(spark):
    pair = "array<struct<role:string,text:string>>"
    rows = [
        (1, [("user", "hi"), ("assistant", "a")], [("user", "hi"), ("assistant", "<|b")]),
        (2, None, [("assistant", None)]),
        (3, [("user", None)], [("user", None)]),
        (4, [("user", "x")], [("user", "x"), ("assistant", "y")]),
    ]
    frame = spark.createDataFrame(rows, f"id int, chosen {pair}, rejected {pair}").withColumn("prompt", F.lit("clash"))
    got = {r.id: r for r in preference.preference_pairs(frame).collect()}
    assert got[1].prompt == "<|im_start|>user\nhi<|im_end|>\n" and got[1].n_prompt_turns == 1
    assert got[1].rejected_completion == "<|im_start|>assistant\n< |b<|im_end|>\n"
    start, end = map(int, got[1].rejected_mask.split(":"))
    assert got[1].rejected_completion[start:end] == "< |b<|im_end|>"
    assert (got[2].prompt, got[2].chosen_completion, got[2].chosen_mask) == ("", "", "")
    assert got[3].n_prompt_turns == 1 and got[3].chosen_completion == ""
    assert got[4].chosen_completion == "" and got[4].rejected_mask
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert preference.preference_pairs(preference.with_swapped_reply(none)).count() == 0


def test_levels_below_the_sample_split_on():
    rng = np.random.default_rng(4)
    rows = rng.standard_normal((4_000, 16))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    near = rows[:300] + 0.04 * rng.standard_normal((300, 16))
    both = np.concatenate([rows, near / np.linalg.norm(near, axis=1, keepdims=True)])
    trees = [vector_forest.Tree(rows[:500], 6, rng) for _ in range(8)]
    met = np.zeros(300, bool)
    for tree in trees:
        assert 0 < tree.levels <= 6
        at, leaf = tree.route(both)
        assert set(at) == set(range(len(both)))
        assert np.unique(leaf, return_counts=True)[1].max() < len(both) / 8
        own = [set() for _ in both]
        for r, x in zip(at.tolist(), leaf.tolist(), strict=True):
            own[r].add(x)
        met |= [bool(own[k] & own[4_000 + k]) for k in range(300)]
    assert met.mean() > 0.99


def test_planted_pairs_are_linked_at_production_parameters(spark):
    rng = np.random.default_rng(5)
    rows = rng.standard_normal((6_000, 32))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    off = rng.standard_normal((400, 32))
    off -= (off * rows[:400]).sum(axis=1, keepdims=True) * rows[:400]
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    cos = rng.uniform(0.9, 0.92, (400, 1))
    both = np.concatenate([rows, cos * rows[:400] + np.sqrt(1 - cos**2) * off])
    want = np.argwhere(np.triu(both @ both.T >= 0.9, 1))
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(both)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in vector_forest.near_vectors(frame).where("n_links > 0").collect()}
    assert len(want) >= 400
    assert sum(got.values()) >= 0.98 * 2 * len(want)


def test_turns_without_an_id_are_conversations_of_their_own(spark):
    turns = [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (None, 1, "assistant", "b"), (4, 0, "user", "c")]
    turns += [(4, 1, "assistant", "d"), (5, 0, "assistant", "e")]
    frame = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")
    got = preference.with_swapped_reply(frame.withColumn("last", F.lit(1))).collect()
    alone = sorted((r.chosen[0].text, len(r.chosen), len(r.rejected)) for r in got if r.conv_id is None)
    assert alone == [("a", 1, 1), ("b", 1, 0), ("b", 1, 0)]
    lent = {r.conv_id: [t.text for t in r.rejected] for r in got if r.conv_id is not None}
    assert lent == {4: ["c", "e"], 5: ["d"]}


def test_rows_that_are_not_toxic_go_on_by_slices(monkeypatch):
    monkeypatch.setattr(toxic_crf, "TOGETHER", 50)
    model = toxic_crf.Crf(np.zeros(toxic_crf.WEIGHTS, np.float32), np.zeros((2, 2)))
    batch = pd.DataFrame({"doc_id": range(6), "text": ["word " * 5, None, "word " * 30, "", "word " * 9, "word"]})
    out = list(toxic_crf._not_toxic(model)(iter([batch])))
    assert [len(rows) for rows in out] == [2, 1, 3] and pd.concat(out).equals(batch)
