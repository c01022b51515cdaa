"""The pipeline's stages, each against a plain version on its own input."""

import re

import pytest

import corpus_pipeline
from tidewell.llm import jaccard_join, storage, toxic_crf


def _sets(texts):
    return {k: set(jaccard_join.shingles(t, 5).tolist()) for k, t in texts.items()}


def test_each_stage_on_its_own_input(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, states = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = f"{tmp_path}/{name}"
        stage(spark, states[-1], sf).write.parquet(out)
        states.append(spark.read.parquet(out))
    for state in states[:-1]:
        assert state.columns == columns
    first, clean, single, cut, private = ({r.doc_id: r for r in s.collect()} for s in states[:-1])

    model = toxic_crf.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    scores = {r.doc_id: r.score for r in toxic_crf.score(docs, model).collect()}
    assert set(clean) == {d for d, s in scores.items() if s < toxic_crf.THRESHOLD}

    sets = _sets({d: r.text for d, r in clean.items()})
    label = {d: d for d in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                low, high = sorted((label[a], label[b]))
                label = {d: low if x == high else x for d, x in label.items()}
    assert set(single) == set(label.values())

    assert set(cut) == set(single) == set(private)
    for d, row in cut.items():
        assert len(row.text) <= len(single[d].text) and row.n_chars == len(row.text)
    for row in private.values():
        assert not re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", row.text)
        assert row.n_chars == len(row.text)

    packed = states[-1].toPandas()
    assert set(packed["doc_id"]) == set(private)
    assert packed.groupby("sequence_id")["length"].sum().max() <= 1024


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_results_stay_however_the_folder_is_written(spark, sf, tmp_path, monkeypatch, scheme):
    def stage(spark, docs, sf_dir):
        return storage.stored(docs.select("doc_id"), "part")

    monkeypatch.setattr(storage, "shared_folder", lambda spark: f"{scheme}{tmp_path}")
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("first", stage), ("second", stage)])
    out = corpus_pipeline.run(spark, sf)
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert {p.name.split("-")[0] for p in tmp_path.iterdir()} == {"first", "second"}
