"""Ranked search and hard negatives against brute force, at small run and block sizes and on odd rows."""

import math
import random
import re
from collections import Counter

import pytest

from panelwright.llm import hard_negatives as hn
from panelwright.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def search_by_force(docs, items, k):
    counted = [(i, Counter(terms_of(t))) for i, t in docs]
    lengths = [sum(c.values()) for _, c in counted]
    n_docs, n_terms, df = sum(n > 0 for n in lengths), sum(lengths), Counter(t for _, c in counted for t in c)
    out = []
    for item, text in sorted({x for x in items if x[0] is not None and x[1] is not None}):
        asked, scores = terms_of(text), []
        for (doc, c), n in zip(counted, lengths, strict=True):
            m = 75 + 25 * n * n_docs // n_terms if n_terms else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in asked if t in c)
            if s > 0 and doc is not None:
                scores.append((-s, doc))
        out += [(item, r + 1, doc, -s) for r, (s, doc) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(lexical, "RUN_DOCUMENTS", 7)
    monkeypatch.setattr(lexical, "FIRST_ROUND", 1)
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 20)
    monkeypatch.setattr(hn, "RUN_ROWS", 16)
    monkeypatch.setattr(hn, "BLOCK_ANCHORS", 4)


def test_lexical_search_is_exact(spark, small):
    r = random.Random(3)
    words = [f"w{i}" for i in range(40)] + ["Ünïcode", "A", "the", "THE", "x" * 300]
    docs = [(i, " ".join(r.choices(words, weights=[1 / (1 + j) for j in range(len(words))], k=r.choice((0, 1, 5, 60))))) for i in range(150)]
    docs += [(None, "w1 w2"), (200, None), (201, ""), (202, "!!! ..."), (7, "w1 w2 w3"), (7, "w1 w2 w3"), (-5, "w1, w2; w3"), (300, "w9 " * 5000)]
    items = [(i, " ".join(r.choices(words, k=r.randint(1, 9)))) for i in range(12)] + [(50, None), (51, ""), (52, "nowhere"), (None, "w1"), (3, "w1 w1 w2"), (3, "w1 w1 w2")]
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, score string, rank int").repartition(5)
    q = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    got = lexical.lexical_search(d, q, k=4)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(tuple(x) for x in got.collect()) == search_by_force(docs, items, 4)


def test_lexical_search_stops_early_and_takes_empty_tables(spark):
    lists = lexical.ImpactLists(*_lists_of([[(0, 100 - i)] for i in range(99)]), 1)
    asked = []
    plain = lists.scores
    lists.scores = lambda docs: asked.append(len(docs)) or plain(docs)
    none = (lexical.np.zeros(0, lexical.np.int64),) * 2
    ids, scores = lists.search(lexical.np.array([0]), lexical.np.array([2]), 3, none)
    assert ids.tolist() == [0, 1, 2] and scores.tolist() == [200, 198, 196] and sum(asked) == lexical.FIRST_ROUND
    d, q = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.lexical_search(d, q).count() == 0
    assert lexical.lexical_search(q.selectExpr("item_id doc_id", "text"), q.limit(0)).count() == 0


def _lists_of(docs):
    np = lexical.np
    sizes = [len(x) for x in docs]
    return np.arange(len(docs)), np.array([w for x in docs for _, w in x]), np.array([t for x in docs for t, _ in x]), np.append(0, np.cumsum(sizes))


def test_pieces_of_a_long_text_count_together(spark, monkeypatch):
    monkeypatch.setattr(lexical, "PIECE_BYTES", 64)
    monkeypatch.setattr("panelwright.llm.textbytes.PIECE_BYTES", 64)
    text = "alpha beta alpha gamma " * 30
    n, found, counts = lexical._counted(lexical.pa.array([text, "alpha", None]), None)
    assert n.to_pylist() == [120, 1, 0] and sorted(counts.to_pylist()[0]) == [30, 30, 60] and len(found[0]) == 3 and counts.to_pylist()[1:] == [[1], []]


def mine_by_force(rows, anchors, n_positives, n_negatives, low, high):
    def fine(r):
        return r[0] is not None and r[2] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])

    def clip(x):
        return max(-(2**63), min(2**63 - 1, x))

    rows = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in filter(fine, rows)]
    out = []
    for a, q, label in sorted({(i, tuple(math.floor(256 * x) for x in v), label) for i, v, label in filter(fine, anchors)}):
        scored = sorted((-clip(sum(x * y for x, y in zip(v, q, strict=False))), i, k) for i, v, k in rows if i != a)
        for s, i, _ in [x for x in scored if x[2] == label][:n_positives]:
            p = -s
            band = [(-t, j) for t, j, k in scored if k != label and low * p <= -100 * t <= high * p][:n_negatives]
            out += [(a, i, r + 1, j, p, t) for r, (t, j) in enumerate(band)]
    return sorted(out)


@pytest.mark.parametrize("wild", [False, True])
def test_hard_negatives_are_exact(spark, small, wild):
    r = random.Random(11)
    rows = [(i, [r.gauss(0, 1) + (j == i % 5) * 2 for j in range(8)], i % 5) for i in range(120)]
    rows += [(200, None, 1), (201, [1.0, None], 1), (202, [float("nan")] * 8, 1), (203, [float("inf")] * 8, 2), (204, [1.0] * 8, None), (None, [1.0] * 8, 1)]
    rows += [(205, [1.0, 2.0], 1), (206, [], 2), (10, rows[10][1], 0), (10, rows[10][1], 0), (207, rows[3][1], 4), (208, rows[3][1], 4), (209, rows[3][1], 1)]
    if wild:
        rows += [(300, [1e30] * 8, 0), (301, [-1e30] + [0.0] * 7, 1), (302, [2.0**30] + [0.0] * 7, 2), (303, [2.0**30, 1.0] + [0.0] * 6, 3), (304, [0.0, 1e25], 2)]
    anchors = [x for x in rows if x[0] is None or x[0] % 10 == 0 or x[0] >= 200]
    schema = "vec_id long, embedding array<double>, label int"
    table = spark.createDataFrame([(*x, 0.5, "a") for x in rows], f"{schema}, score double, positive_id string").repartition(4)
    got = hn.hard_negatives(table, spark.createDataFrame(anchors, schema), n_positives=3, n_negatives=4)
    assert sorted(tuple(x) for x in got.collect()) == mine_by_force(rows, anchors, 3, 4, 30, 90)


def test_brackets_leave_rows_out(spark):
    np = hn.np
    draw = np.random.default_rng(1)
    vectors = np.floor(256 * np.concatenate([draw.normal(c, 0.02, (300, 6)) for c in (-1, 0, 1)]))
    top2 = float((vectors**2).sum(axis=1).max())
    pivots = hn.farthest_pivots(vectors[::9], top2)
    d = hn.pivot_distances(vectors, np.sqrt(top2 - (vectors**2).sum(axis=1)), pivots).astype(np.float32)
    run = hn.Run(np.arange(900), np.zeros(900, int), vectors, d, np.zeros(900, bool), top2)
    a = hn.Anchor(0, -1, 0, vectors[700], pivots)
    exact = vectors @ a.vector
    for low, high in ((np.sort(exact)[-5], np.inf), (0.3 * exact.max(), 0.9 * exact.max()), (-np.inf, np.inf)):
        rows = run.between(a, low, high) if np.isfinite(low) else np.arange(900)
        assert set(np.flatnonzero((exact >= low) & (exact <= high))) <= set(rows)
    assert len(run.between(a, float(np.sort(exact)[-5]), np.inf)) < 400


def test_hard_negatives_of_empty_tables(spark):
    schema = "vec_id long, embedding array<float>, label int"
    none, one = spark.createDataFrame([], schema), spark.createDataFrame([(1, [1.0], 1)], schema)
    assert hn.hard_negatives(none, none).count() == 0 and hn.hard_negatives(none, one).count() == 0
    assert hn.hard_negatives(one, none).count() == 0 and hn.hard_negatives(one, one).count() == 0
