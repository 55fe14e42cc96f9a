import math
import random

import numpy as np
import pytest

from panelwright.llm.toxicity import best_threshold, toxicity
from panelwright.llm.topk import top_k
from panelwright.llm.urls import Rule, judge

RULES = [Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/")]


def test_toxicity_on_held_out_rows(spark):
    r = random.Random(6)
    word = lambda: "".join(r.choices("aeiourstlnmdéß", k=r.choice([2, 3, 5, 7])))
    rows, labels = [], []
    for i in range(1500):
        lang, toxic = r.choice(["en", "de"]), int(r.random() < 0.3)
        w = [word() for _ in range(r.randint(5, 80))]
        if toxic:
            for _ in range(2):
                w.insert(r.randrange(len(w)), r.choice(["Moron,", "scum", "loser."]) if lang == "en" else "lowei" + word())
        rows.append((i, " ".join(w), lang, 0.5))
        labels.append((i, toxic))
    rows += [(5000, None, None, 0.1), (5001, "", "xx", 0.1), (5002, "... !!", "en", 0.1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    out = toxicity(docs, spark.createDataFrame([*labels, (5000, None)], "doc_id long, toxic int")).collect()
    truth = dict(labels)
    held = [x for x in out if x["held_out"] and x["doc_id"] in truth]
    assert len(out) == len(rows) and all(0 <= x["score"] <= 1 and x["predicted"] == int(x["score"] >= 0.7) for x in out)
    assert np.mean([x["predicted"] == truth[x["doc_id"]] for x in held]) > 0.97
    none = toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int")).collect()
    assert len({x["score"] for x in none}) == 1 and len(none) == len(rows)
    assert toxicity(docs.limit(0), spark.createDataFrame(labels, "doc_id long, toxic int")).collect() == []


def test_more_labels_than_training_takes(spark):
    """Thresholds are those of the model that scores, also where the sample's shares aren't the labels' shares."""
    from panelwright.llm import toxicity as t

    r = random.Random(2)
    word = lambda: "".join(r.choices("aeiourstlnmd", k=r.choice([2, 3, 5, 7])))
    rows, labels = [], []
    for i in range(1200):
        toxic = int(r.random() < 0.2)
        rows.append((i, " ".join([word() for _ in range(20)] + ["scum moron"] * toxic), "en"))
        labels.append((i, toxic))
    docs, labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    out, truth = t.toxicity(docs, labelled, rows=100).collect(), dict(labels)
    assert np.mean([x["flagged"] == truth[x["doc_id"]] for x in out]) > 0.97
    assert len({x["threshold"] for x in out}) == 1 and 0.02 < out[0]["threshold"] < 0.98


def test_every_label_is_learned_from(spark):
    """Words that only few labelled texts hold are learned, however few texts a shard has."""
    from panelwright.llm import toxicity as t

    r = random.Random(9)
    word = lambda n: "".join(r.choices("aeiourstlnmd", k=n))
    bad = ["x" + word(7) for _ in range(40)]
    rows = [(i, " ".join([word(r.choice([2, 3, 5])) for _ in range(12)] + [bad[i // 3 % 40]] * (i % 3 == 0)), "en") for i in range(900)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(900)], "doc_id long, toxic int")
    out = [x for x in t.toxicity(docs, labels, rows=20).collect() if not x["held_out"]]
    assert np.mean([x["flagged"] for x in out if x["doc_id"] % 3 == 0]) > 0.8
    assert np.mean([x["flagged"] for x in out if x["doc_id"] % 3]) < 0.1


def test_rounds_do_not_depend_on_partitions(spark):
    from panelwright.llm import toxicity as t

    rows = spark.createDataFrame([(i % 2, i, f"w{i % 7} and w{i % 5}", "en") for i in range(60)], "y int, order long, text string, lang string")
    state = t.start(3)
    one, other = (t.one_round(t.dealt(x, 4), state, 2, 3) for x in (rows.repartition(5), rows.coalesce(1)))
    assert (one == other).all() and (one != state).any()


def test_scores_of_long_texts_do_not_depend_on_blocks(monkeypatch):
    import pyarrow as pa

    from panelwright.llm import textbytes
    from panelwright.llm import toxicity as t

    r = random.Random(4)
    texts = [" ".join("".join(r.choices("abcdef", k=r.randint(1, 9))) for _ in range(n)) for n in (3000, 0, 1, 500, 7)] + [None, "!!"]
    net = t.fresh(1)
    whole = np.concatenate([net.scores(f, h) for f, h in t.word_features(pa.array(texts))])
    monkeypatch.setattr(t, "BLOCK_WORDS", 64)
    monkeypatch.setattr(textbytes, "PIECE_BYTES", 1000)
    parts = np.concatenate([net.scores(f, h) for f, h in t.word_features(pa.array(texts))])
    assert np.allclose(whole, parts, atol=1e-6)


def test_threshold():
    assert best_threshold(np.array([0.9, 0.8, 0.2, 0.1]), np.array([1, 1, 0, 0])) == pytest.approx(0.5)


def test_urls(spark):
    urls = [None, "", "nohost", "http://A.example.NET/en/x?y", "http://example.net/de/", "http://b.net", "https://x.org/fr/1#t", "https://forg/fr/1", "http://m.example.com/de/a", "http://m.example.com/De/a", "x://h?q#f", "https://cheap-pills.example.com/en/1", "http://ththen.example.com/es/2", "a://b://c/d"]
    rows = {x["page_id"]: x for x in judge(spark.createDataFrame([(i, u, "s", 1) for i, u in enumerate(urls)], "page_id long, url string, score string, host int"), RULES).collect()}
    got = [(rows[i]["host"], rows[i]["path"], rows[i]["rule"]) for i in range(len(urls))]
    assert got == [
        ("", "", None), ("", "", None), ("", "", None), ("a.example.net", "/en/x", "example.net/en/"), ("example.net", "/de/", "net/"), ("b.net", "", None), ("x.org", "/fr/1", "org/fr/"), ("forg", "/fr/1", None),
        ("m.example.com", "/de/a", "example.com/de/"), ("m.example.com", "/De/a", None), ("h", "", None), ("cheap-pills.example.com", "/en/1", None), ("ththen.example.com", "/es/2", None), ("b:", "//c/d", None),
    ]
    assert [rows[i]["verdict"] for i in (3, 4, 6, 8, 11, 12)] == ["allow", "block", "allow", "block", "block", "allow"]
    assert judge(spark.createDataFrame([], "page_id long, url string"), RULES).collect() == []


def test_rules_of_equal_length(spark):
    """The first listed of two rules of the same length wins, whatever it says; repeated rows get repeated results."""
    pages = spark.createDataFrame([(1, "http://a.b/cd"), (1, "http://a.b/cd"), (None, "http://a.b/c"), (2, None)], "page_id long, url string")
    one, two = Rule("allow", "a.b", "/c"), Rule("block", "b", "/cd")
    other = Rule("block", "a.b", "/")
    for rules, want in (([one, two], "allow"), ([two, other, one], "allow"), ([Rule("block", "a.b", "/c"), one], "block"), ([one, Rule("block", "a.b", "/c")], "allow")):
        assert [x["verdict"] for x in judge(pages, rules).where("page_id = 1").collect()] == [want] * 2


def test_urls_on_held_out_rows(spark):
    from pyspark.sql import functions as F

    from panelwright.llm.urls import labelled_urls, train

    table = labelled_urls(spark)
    held = F.abs(F.xxhash64("url")) % 4 == 0
    out = judge(table.where(held).withColumn("page_id", F.xxhash64("url")), [], model=train(table.where(~held)))
    truth = {x["id"]: x["label"] for x in table.where(held).select(F.xxhash64("url").alias("id"), "label").collect()}
    rows = [(x["verdict"] == "block", truth[x["page_id"]]) for x in out.collect()]
    right = sum(b and y for b, y in rows)
    assert len(rows) > 3000 and right / sum(b for b, _ in rows) > 0.98 and right / sum(y for _, y in rows) > 0.9


@pytest.mark.parametrize("shard_rows", [64, 100_000])
def test_top_k_matches_brute_force(spark, monkeypatch, shard_rows):
    monkeypatch.setattr("panelwright.llm.topk.SHARD_ROWS", shard_rows)
    r = np.random.default_rng(2)
    vectors = [r.normal(0, 0.3, 6).astype("f4").tolist() for _ in range(300)] + [[0.5] * 6] * 40
    rows = [(i, v, 1) for i, v in enumerate(vectors)] + [(900, None, 1), (901, [None] * 6, 1), (902, [float("nan")] * 6, 1), (903, [float("inf")] * 6, 1), (910, [0.25, 0.5], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    whole = {i: np.floor(256 * np.array(v, "f8")).astype(int) for i, v in enumerate(vectors)} | {910: np.array([64, 128, 0, 0, 0, 0])}
    want = set()
    for q in [i for i in whole if i % 50 == 0]:
        ranked = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:5]
        want |= {(q, n, i, -s) for n, (s, i) in enumerate(ranked, 1)}
    found = top_k(df, df.where("vec_id % 50 = 0"), 5).collect()
    assert {(x["query_id"], x["rank"], x["vec_id"], x["score"]) for x in found} == want
    two = df.where("vec_id < 2")
    assert len(top_k(two, two, 5).collect()) == 2
    assert top_k(df.limit(0), df.limit(0), 5).collect() == []


@pytest.mark.parametrize("shard_rows", [16, 100_000])
def test_top_k_with_large_components_and_repeated_ids(spark, monkeypatch, shard_rows):
    """Sums of up to 2**62 are exact; rows of one id are candidates, and queries, of their own."""
    monkeypatch.setattr("panelwright.llm.topk.SHARD_ROWS", shard_rows)
    r = random.Random(3)
    rows = [(i, [float(r.randint(-(2**30), 2**30)) for _ in range(4)]) for i in range(60)]
    rows += [(60 + i, [1048576.00390625 if i == 1 else 1048576.0, 1048575.5, 0.25, -1048576.0]) for i in range(3)]
    rows += [(0, [5.5, -7.25, 1.0, 2.0]), (7, rows[7][1]), (7, rows[7][1]), (50, rows[50][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {}
    for x in top_k(df, df.where("vec_id % 50 = 0"), 5, scale=1).collect():
        found.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], x["score"]))
    want = {}
    for q, v in {(i, tuple(v)) for i, v in rows if i % 50 == 0}:
        ranked = sorted((-sum(int(np.floor(a)) * int(np.floor(b)) for a, b in zip(v, w, strict=True)), i) for i, w in rows if i != q)[:5]
        want.setdefault(q, []).extend((n, i, -s) for n, (s, i) in enumerate(ranked, 1))
    assert {q: sorted(x) for q, x in found.items()} == {q: sorted(x) for q, x in want.items()}
    huge = spark.createDataFrame([(0, [1e300]), (1, [1.0])], "vec_id long, embedding array<double>")
    assert {(x["query_id"], x["vec_id"], x["score"]) for x in top_k(huge, huge, 1).collect()} == {(0, 1, 2**63 - 1), (1, 0, 2**63 - 1)}


@pytest.mark.parametrize("shard_rows", [8, 100_000])
def test_top_k_with_components_beyond_64_bits(spark, monkeypatch, shard_rows):
    """Every finite vector takes part, whatever rows share its shard; scores beyond 64 bits are the largest or smallest number."""
    monkeypatch.setattr("panelwright.llm.topk.SHARD_ROWS", shard_rows)
    monkeypatch.setattr("panelwright.llm.topk.LEAST_ROWS", 16)
    r = random.Random(5)
    rows = [(i, [r.gauss(0, 1) for _ in range(64)]) for i in range(150)]
    rows += [(200, [1e30] + [0.0] * 63), (201, [-1e30] * 64), (202, [0.0] * 63 + [2.0**30]), (203, [2.0**30] + [0.0] * 63), (204, [2.0**22] * 64), (205, [2.0**30, -(2.0**30)] + [1.0] * 62)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {(x["query_id"], x["rank"], x["vec_id"], x["score"]) for x in top_k(df, df.where("vec_id % 10 = 0 or vec_id >= 200"), 4).collect()}
    whole, want = {i: [math.floor(256 * x) for x in v] for i, v in rows}, set()
    for q in [i for i in whole if i % 10 == 0 or i >= 200]:
        ranked = sorted((-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(whole[q], v, strict=True)))), i) for i, v in whole.items() if i != q)[:4]
        want |= {(q, n, i, -s) for n, (s, i) in enumerate(ranked, 1)}
    assert found == want


def test_queries_go_to_cells_that_reach_their_bar():
    from panelwright.llm import topk

    r = np.random.default_rng(8)
    vectors = np.floor(256 * np.concatenate([r.normal(c, 0.05, (400, 8)) for c in r.normal(0, 1, (16, 8))])).astype(np.int64)
    cells = topk.Cells(vectors[::4], 16)
    own = cells.place(list(vectors))
    assert cells.n == 16 and np.bincount(own, minlength=16).max() < 1000
    t = topk.Table.__new__(topk.Table)
    t.cells, t.boxed, t.width, t.parts, t.first = cells, np.arange(16), 8, dict.fromkeys(range(16), 1), {c: c for c in range(16)}
    t.low, t.high = (np.array([f(vectors[own == c], axis=0) for c in range(16)], float) for f in (np.min, np.max))
    sent = []
    for q in vectors[::100]:
        scores = vectors @ q
        bar = int(np.sort(scores)[-5])
        assert {int(c) for c in own[scores >= bar]} <= set(t.open(q, bar))
        sent.append(len(t.open(q, bar)))
    assert np.mean(sent) < 8 and t.open(None, 5) == list(range(16)) == t.open(vectors[0], None)


def test_pipeline_runs_and_keeps_clean_documents(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(1)
    word = lambda: "".join(r.choices("aeiourstlnmd", k=r.choice([2, 3, 4, 6, 8])))
    clean = [" ".join(word() for _ in range(60)) + "." for _ in range(120)]
    texts = [*clean, clean[0], clean[1] + " more", " ".join(word() + "###" for _ in range(60)), None, "short"]
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {x["doc_id"] for x in out} == set(range(120))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "ngram_jaccard_join", "pii", "packing"]
