from __future__ import annotations

import corpus_pipeline
import pytest

from framewright import storage
from framewright.llm import decontaminate, quality_classifier, secret_scan, sentencepiece_codec
from framewright.storage import intermediates, materialize

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns
        assert 0 < docs.count() <= n
        n = docs.count()


def test_near_duplicates_leave_one_of_each_group(spark):
    words = [f"w{i}x" for i in range(120)]
    near = [*words[:60], "changed", *words[61:]]
    rows = [(1, " ".join(words)), (2, " ".join(words)), (3, " ".join(near)), (4, " ".join(reversed(words))), (4, "other text of the same id"), (None, "no id"), (None, "no id"), (None, " ".join(near))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()
    assert sorted((r.doc_id for r in kept), key=str) == sorted([1, 4, 4, None], key=str)


def test_rows_equal_the_stages_one_by_one(spark, tmp_path, monkeypatch):
    """The pipeline, in a shared folder without scheme and with a space, against a plain composition: every stage's
    decision taken per document in Python."""
    monkeypatch.setattr(storage, "shared_dir", lambda _: f"{tmp_path}/shared folder")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    model = quality_classifier.fit(quality_classifier.with_inputs(docs), labels)
    rows = {r.doc_id: r.text for r in docs.collect()}
    good = [i for i, t in sorted(rows.items()) if model.score(quality_classifier.inputs([(t or "").encode()]))[0] >= quality_classifier.THRESHOLD]
    shingles, group = {}, {i: i for i in good}
    for i in good:
        w = (rows[i] or "").lower().split()
        shingles[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
        for j in good:
            if j < i and 0.8 * max(len(shingles[i]), len(shingles[j])) <= min(len(shingles[i]), len(shingles[j])) and len(shingles[i] & shingles[j]) >= 0.8 * len(shingles[i] | shingles[j]):
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = {k: new if g == old else g for k, g in group.items()}
    one = {group[i] for i in good}
    leaks = {r.doc_id for r in decontaminate.find_leaks(docs, bench).collect()}
    sp = sentencepiece_codec.codec(sentencepiece_codec.model_file())
    want = {i: len(sp.encode([secret_scan.masked(rows[i] or "")])[0]) for i in one - leaks}
    got = corpus_pipeline.run(spark, SF)
    assert {r.doc_id: r.n_tokens for r in got.collect()} == want and got.count() == len(want)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_awkward_rows(spark, name):
    """Nulls in every column, empty and long texts, repeated rows, clashing columns, no rows at all."""
    stage = dict(corpus_pipeline.STAGES)[name]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, row long, node string, h string, kept string"
    texts = [None, "", " \n", "plain words of a text that anyone may keep as it is", "plain words of a text that anyone may keep as it is", "token = abcdef123456 and more", "z" * 100_000, "x y " * 20_000]
    rows = [(None if k % 3 == 1 else k // 2, t, None, "s", None, "mine", 7, None, "h", "k") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, schema)
    out = stage(spark, docs, SF)
    none = stage(spark, docs.limit(0), SF)
    assert none.columns == out.columns and none.count() == 0
    got = out.collect()
    if name == "sentencepiece":
        assert len(got) == len(rows)
        return
    assert out.columns == docs.columns and out.schema["score"] == docs.schema["score"] and all(r.score == "mine" and r.row == 7 for r in got)
    if name == "secret_scan":
        assert sorted((r.doc_id, r.text) for r in got if r.text and "SECRET" in r.text) == [(2, "[SECRET] and more")] and len(got) == len(rows)
        assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got)
    elif name == "simhash_near_dedup":
        assert len(got) == 5
    elif name == "benchmark_decontamination":
        assert len(got) == len(rows)


def test_intermediates_go(spark, tmp_path):
    import os

    def at(df):
        return os.path.dirname(df.inputFiles()[0].removeprefix("file://"))

    with intermediates(spark) as made:
        gone, kept = materialize(spark.range(3).toDF("x"), "gone"), materialize(spark.range(4).toDF("x"), "kept")
        made.keep(kept)
        paths = at(gone), at(kept)
    assert not os.path.exists(paths[0]) and kept.count() == 4
