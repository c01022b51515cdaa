"""Text queries against their SQL, or whole results against brute force, on the smallest tables."""

import glob
import hashlib
import os
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from compare import canonical, column_types
from tidewell.llm import sentence_spans
from tidewell.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return con


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.sql("select doc_id, coalesce(text, '') from documents").fetchall())


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, sf, duck, name):
    got = QUERIES[name](spark, sf).toArrow()
    want = duck.sql(ORACLES[name]).to_arrow_table()
    assert column_types(got) == column_types(want)
    assert canonical(got.to_pandas()) == canonical(want.to_pandas())


def test_packing_holds_every_id_once(spark, sf, texts):
    got = QUERIES["op1_best_fit_packing"](spark, sf).toPandas()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for doc, own in got.groupby("doc_id"):
        ids = np.array([*library.encode(texts[doc], add_special_tokens=False).ids, 2], "<u4")
        own = own.sort_values("piece")
        assert own["piece"].tolist() == list(range(len(own)))
        assert own["start"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]]
        assert own["length"].sum() == len(ids)
        assert (own["length"].iloc[1:] == 1024).all()
        for start, length, crc in own[["start", "length", "ids_crc32"]].itertuples(index=False):
            assert zlib.crc32(ids[start : start + length].tobytes()) == crc
    assert set(got["doc_id"]) == set(texts)
    for _, own in got.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own["offset"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]]
        assert own["length"].sum() <= 1024
    assert got["sequence_id"].nunique() <= 1.02 * got["length"].sum() / 1024 + 1


def test_bpe_matches_the_library(spark, sf, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = QUERIES["op3_bpe_round_trip"](spark, sf).toPandas()
    assert len(got) == len(texts)
    for row in got.itertuples():
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_repeated_spans_match_brute_force(spark, sf, texts):
    got = QUERIES["op8_sentence_span_dedup"](spark, sf).toPandas().set_index("doc_id")
    seen = set()
    for doc in sorted(texts):
        parts = sentence_spans.sentences(texts[doc])
        assert "".join(parts) == texts[doc]
        gone = set()
        begin, end, _ = sentence_spans.runs(parts)
        for a, b in zip(begin, end, strict=True):
            key = tuple(k for k in (tuple(p.lower().split()) for p in parts[a:b]) if k)
            gone.update(range(a, b) if key in seen else ())
            seen.add(key)
        assert got.loc[doc, "kept_text"] == "".join(p for k, p in enumerate(parts) if k not in gone)
        assert got.loc[doc, "n_removed"] == len(gone)
    assert len(got) == len(texts)


def test_toxic_words_are_found_in_held_out_rows(spark, sf):
    big = sf.replace("sf0.001", "sf0.1")
    got = QUERIES["op9_toxic_spans"](spark, big).toPandas().set_index("doc_id")
    labels = spark.read.parquet(f"{big}/labels.parquet").toPandas().set_index("doc_id")
    assert got["score"].between(0, 1).all()
    assert (got["predicted"] == (got["score"] >= 0.7)).all()
    assert all(got["held_out"] == [zlib.crc32(str(d).encode()) % 3 == 1 for d in got.index])
    held = labels.join(got[got["held_out"]], how="inner")
    toxic, clean = held[held["toxic"] == 1], held[held["toxic"] == 0]
    assert toxic["predicted"].mean() > 0.85
    assert clean["predicted"].mean() < 0.01
