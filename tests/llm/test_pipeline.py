"""The stages of the pipeline against plain Python, over repeated and null ids, equal rows, and odd tables."""

import random
from collections import Counter

import pytest

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(r, n=60):
    word = lambda: "".join(r.choices("aeiourstlnmd", k=r.choice([2, 3, 4, 6, 8])))
    return " ".join(word() for _ in range(n)) + "."


def staged(spark, rows, upto, schema=SCHEMA):
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:upto]:
        docs = stage(spark, docs, "")
        assert docs.columns == [c.split()[0] for c in schema.split(", ")]
    return [tuple(r) for r in docs.collect()]


def row(i, text):
    return (i, text, "en", "s", len(text or ""))


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(4)
    good = [prose(r) for _ in range(40)]
    junk = [" ".join(w + "###" for w in prose(r).split()) for _ in range(5)]
    rows = [row(i, t) for i, t in enumerate(good)]
    rows += [row(5, junk[0]), row(3, prose(r) + " tail"), row(900, junk[1]), row(901, None), row(902, ""), row(None, None), row(None, junk[2])]
    rows += [row(7, good[7]), row(7, good[7]), row(910, good[7]), row(None, good[7]), row(None, good[8] + " extra"), row(8, good[9] + " more")]
    lone = prose(r)
    rows += [row(None, lone), row(None, lone), row(None, lone + " x"), row(None, prose(r))]
    return good, junk, rows


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_quality_keeps_rows_of_rejected_ids(spark, corpus):
    good, junk, rows = corpus
    want = [x for x in rows if x[1] and x[1] not in junk]
    assert Counter(staged(spark, rows, 1)) == Counter(want)


def test_one_row_of_each_class_stays(spark, corpus):
    _, junk, rows = corpus
    left = [x for x in rows if x[1] and x[1] not in junk]
    order = sorted(range(len(left)), key=lambda i: (left[i][0] is None, left[i][0] or 0))
    classes: list[list[int]] = []
    for i in order:  # plain single linkage
        s = shingles(left[i][1])
        linked = [c for c in classes if any(len(s & shingles(left[j][1])) * 100 >= 80 * len(s | shingles(left[j][1])) for j in c)]
        classes = [c for c in classes if c not in linked] + [[i, *(j for c in linked for j in c)]]
    found = [tuple(x) for x in corpus_pipeline.near_dedup(spark, spark.createDataFrame(left, SCHEMA), "").collect()]
    assert len(found) == len(classes)
    for c in classes:
        first = min((left[j][0] is None, left[j][0] or 0) for j in c)
        assert sum((x[0] is None, x[0] or 0) == first and any(x[1] == left[j][1] for j in c) for x in found) == 1
    assert {x[1] for x in found if x[0] == 5} == {corpus[0][5]} and len([x for x in found if x[0] == 3]) == 2


def test_first_three_stages_keep_every_class(spark, corpus):
    good, _, rows = corpus
    found = staged(spark, rows, 3)
    assert len({x[1] for x in found}) == len(found)
    texts = [set(shingles(x[1])) for x in found]
    for t in {x[1] for x in rows if x[1] and "###" not in x[1] and len(x[1].split()) >= 20}:  # each text or one near it is still there, once
        s = shingles(t)
        assert sum(len(s & k) * 100 >= 80 * len(s | k) for k in texts) == 1


def test_whole_pipeline_over_odd_tables(spark, corpus, tmp_path):
    _, junk, rows = corpus
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "a/documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path / "a")).collect()
    kept = staged(spark, rows, 4)
    assert {x["doc_id"] for x in out} == {x[0] for x in kept} and sum(x["start"] == 0 for x in out) == len(kept)
    for name, schema in (("b", SCHEMA), ("c", "doc_id long, text string, source string, extra map<string,int>")):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{name}/documents.parquet"))
        assert corpus_pipeline.run(spark, str(tmp_path / name)).count() == 0


def test_stages_without_n_chars_and_with_clashing_columns(spark, corpus):
    good, _, _ = corpus
    schema = "doc_id long, text string, source string, digest int, first string, n int, kept string"
    rows = [(i, t, "s", 1, "f", 2, "k") for i, t in enumerate(good[:6])] + [(0, good[0], "s", 0, "f", 2, "k"), (0, good[0], "s", 1, "f", 2, "k")]
    found = staged(spark, rows, 4, schema)
    assert sorted(x[0] for x in found) == list(range(6)) and [x[3] for x in found if x[0] == 0] == [0]


def test_intermediate_tables_go(spark, corpus, tmp_path, monkeypatch):
    from panelwright.llm import scratch

    _, _, rows = corpus
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    root = tmp_path / "shared"
    monkeypatch.setattr(scratch, "scratch_root", lambda _: str(root))
    corpus_pipeline.run(spark, str(tmp_path)).count()
    left = {p.name for p in root.glob("panelwright-*/*")}
    assert not left & {"rejected", "measures", "quality_rules", "line_dedup", "marked", "sets", "ngram_jaccard_join"} and "pii" in left
