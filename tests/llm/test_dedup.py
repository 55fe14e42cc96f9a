import random

import pytest
from pyspark.sql import functions as F

from panelwright.llm.graph import components
from panelwright.llm.line_dedup import dedup_lines
from panelwright.llm.near_dup import Bound, near_duplicates, shingles, signatures

DOCS = "doc_id long, text string, n_lines string, covered string"


def words_set(text, n):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or "")).encode().split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute_classes(texts, bound):
    sets = {i: words_set(t, bound.n) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(texts)
    for x in range(len(ids)):
        for y in range(x):
            a, b = sets[ids[x]], sets[ids[y]]
            if a and b and 100 * len(a & b) >= bound.percent * len(a | b):
                p, q = find(ids[x]), find(ids[y])
                parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in texts}


def brute_lines(texts, k=3):
    seen, out = {}, {}
    windows = []
    for i in sorted(texts):
        lines = texts[i].split("\n") if texts[i] is not None else []
        inked = [j for j, x in enumerate(lines) if x.strip(" \t\n\x0b\x0c\r")]
        for s in range(max(1, len(inked) - k + 1) if inked else 0):
            part = inked[s : s + k]
            windows.append((i, part[0], part[-1], tuple(lines[j] for j in part)))
    gone = {i: set() for i in texts}
    for i, a, b, w in windows:
        if w in seen:
            gone[i].update(range(a, b + 1))
        else:
            seen[w] = (i, a)
    for i, t in texts.items():
        if t is None:
            out[i] = (None, 0)
            continue
        kept = [x for j, x in enumerate(t.split("\n")) if j not in gone[i]]
        out[i] = ("\n".join(kept) if not gone[i] or any(x.strip(" \t\n\x0b\x0c\r") for x in kept) else "", len(gone[i]))
    return out


def family(r, base, edits):
    w = base.split()
    for _ in range(edits):
        w[r.randrange(len(w))] = "".join(r.choices("abcdefgh", k=7))
    return " ".join(w)


@pytest.mark.parametrize("bound", [Bound(80, 5), Bound(85, 4)])
def test_near_duplicates_match_brute_force(spark, bound):
    r = random.Random(bound.n)
    texts = {0: None, 1: "", 2: " \t\n", 3: "one two", 4: "One TWO", 5: "one two three"}
    for f in range(6):
        base = " ".join("".join(r.choices("abcdefgh", k=4)) for _ in range(r.choice([9, 30, 80, 200])))
        for _ in range(25):
            texts[len(texts)] = family(r, base, r.choice([0, 0, 1, 1, 2, 3, 5, 8, 13]))
    rows = [(i, t, "x", "y") for i, t in texts.items()]
    r.shuffle(rows)
    found = near_duplicates(spark.createDataFrame(rows, DOCS).repartition(5), bound=bound).collect()
    assert {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in found} == brute_classes(texts, bound)


def test_shared_signatures_do_not_depend_on_pieces(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from panelwright.llm import near_dup

    r = random.Random(6)
    rows = [(s, -5 + (s * 7 + m) % 5) for s in range(6) for m in range(s + 1)] + [(9, 3)] * 4
    want = {(s, n) for s, n in rows if len({m for t, m in rows if t == s}) > 1}
    for piece in (2, 3, 1000):
        for _ in range(10):
            r.shuffle(rows)
            packed = [np.array(rows[i : i + 3], np.int64).tobytes() for i in range(0, len(rows), 3)]
            found = [x for b in near_dup._shared(iter([pa.record_batch([pa.array(packed, pa.binary())], ["packed"])]), piece) for x in zip(*b.to_pydict().values(), strict=True)]
            assert set(found) == want


@pytest.mark.parametrize("direct", [-1, 4])
def test_near_duplicates_by_rounds_match_brute_force(spark, monkeypatch, direct):
    """Families around the bound, passages that many texts share, sets of 2 to 2000 shingles, hubs in many parts."""
    monkeypatch.setattr("panelwright.llm.near_dup.DIRECT_PAIRS", direct)
    monkeypatch.setattr("panelwright.llm.near_dup.HUB_MEMBERS", 3)
    r = random.Random(17)
    bound, texts = Bound(80, 3), {}
    passage = " ".join("".join(r.choices("abcdefgh", k=4)) for _ in range(40))
    for size, copies, most in ((4, 10, 2), (12, 40, 3), (60, 80, 12), (60, 40, 4), (400, 20, 60), (2000, 8, 250)):
        base = " ".join("".join(r.choices("abcdefgh", k=4)) for _ in range(size))
        for _ in range(copies):
            texts[len(texts)] = family(r, base, r.randint(0, most))
    for _ in range(60):
        texts[len(texts)] = passage + " " + " ".join("".join(r.choices("abcdefgh", k=5)) for _ in range(r.randint(0, 30)))
    rows = [(i, t, "x", "y") for i, t in texts.items()]
    r.shuffle(rows)
    found = near_duplicates(spark.createDataFrame(rows, DOCS).repartition(5), bound=bound).collect()
    assert {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in found} == brute_classes(texts, bound)


def test_texts_that_share_only_a_passage_meet_no_hub(spark, monkeypatch):
    """The differences from hubs are taken of the texts of families alone, not of all that quote the same passage."""
    from panelwright.llm import near_dup

    met, compared = [], near_dup.compared

    def counted(pairs, texts, bound, differences=True):
        met.append(pairs.count() if differences else 0)
        return compared(pairs, texts, bound, differences)

    monkeypatch.setattr(near_dup, "compared", counted)
    r = random.Random(23)
    word = lambda: "".join(r.choices("abcdefgh", k=5))
    passage, texts = " ".join(word() for _ in range(50)), {}
    for i in range(150):
        texts[i] = passage + " " + " ".join(word() for _ in range(60))
    for i in range(0, 40, 4):
        for _ in range(3):
            texts[len(texts)] = family(r, texts[i], r.choice([1, 2, 3]))
    found = near_duplicates(spark.createDataFrame([(i, t, "x", "y") for i, t in texts.items()], DOCS).repartition(5)).collect()
    assert {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in found} == brute_classes(texts, Bound())
    assert sum(met) <= 40


def test_near_duplicates_with_repeated_and_missing_ids(spark):
    a, b = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    rows = [(5, a), (5, b), (5, a), (7, a + " more"), (3, b + " more"), (None, b), (None, "only here at all times"), (9, None), (None, None)]
    docs = spark.createDataFrame([(i, t, None, None) for i, t in rows], DOCS)
    found = near_duplicates(docs).select("doc_id", "n_shingles", "component_id").collect()
    key = lambda x: tuple(-1 if v is None else v for v in x)
    want = [(5, 56, 5), (5, 56, 5), (5, 56, 3), (7, 57, 5), (3, 57, 3), (None, 56, 3), (None, 1, None), (9, 0, 9), (None, 0, None)]
    assert sorted(map(key, found)) == sorted(map(key, want))


def test_a_large_group_of_near_copies(spark):
    """Compared pairs stay a few times the copies, and the classes are those of brute force on numbers."""
    r = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    rows, spots = [], {}
    for i in range(500):
        spots[i] = frozenset(r.sample(range(4, 116), r.choice([0, 1, 1, 2, 3, 6, 12])))
        rows.append((i, " ".join(f"x{i}_{j}" if j in spots[i] else w for j, w in enumerate(base)), None, None))
    found = {x["doc_id"]: x["component_id"] for x in near_duplicates(spark.createDataFrame(rows, DOCS), bound=Bound(85, 4)).collect()}
    assert found == {i: c for i, (_, c) in brute_classes({i: t for i, t, _, _ in rows}, Bound(85, 4)).items()}


@pytest.mark.parametrize("piece", [3, 40])
def test_near_duplicates_in_small_pieces_match_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr("panelwright.llm.near_dup.SORT_ROWS", piece)
    r = random.Random(piece)
    bound, texts = Bound(80, 5), {}
    for f in range(4):
        base = " ".join("".join(r.choices("abcdefgh", k=4)) for _ in range(r.choice([30, 80, 200])))
        for _ in range(20):
            texts[len(texts)] = family(r, base, r.choice([0, 1, 2, 3, 5, 8]))
    rows = [(i, t, "x", "y") for i, t in texts.items()]
    r.shuffle(rows)
    found = near_duplicates(spark.createDataFrame(rows, DOCS).repartition(5), bound=bound).collect()
    assert {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in found} == brute_classes(texts, bound)


def test_near_duplicates_of_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    assert near_duplicates(empty).collect() == []
    alone = near_duplicates(spark.createDataFrame([(7, "a b c d e f", None, None), (8, None, None, None)], DOCS)).collect()
    assert sorted((x["doc_id"], x["component_id"], x["n_links"]) for x in alone) == [(7, 7, 0), (8, 8, 0)]


def test_signatures_of_similar_sets_meet():
    import numpy as np

    r = np.random.default_rng(1)
    for size in (3, 7, 20, 45, 130, 700):
        for _ in range(60):
            a = np.unique(r.integers(0, 1 << 63, size, dtype=np.uint64))
            drop = r.integers(0, max(1, int(len(a) * 0.16)) + 1)
            b = np.unique(np.concatenate([a[drop:], r.integers(0, 1 << 63, int(r.integers(0, max(1, size // 12) + 1)), dtype=np.uint64)]))
            common = len(np.intersect1d(a, b))
            if 100 * common >= 85 * (len(a) + len(b) - common):
                assert len(np.intersect1d(signatures(a, 85), signatures(b, 85))), (size, drop)


def test_shingles_of_long_and_odd_texts():
    import pyarrow as pa

    texts = ["a b c d e f", None, "", "  ", "é É x", "A b\x0bC\rd", "z" * 3_000_000, "w " * 20_000, " ".join(map(str, range(400_000))), "a " + "z" * 5_000_000 + " b c d e f"]
    found = [len(s) for s in shingles(pa.array(texts), 5)]
    assert found == [len(words_set(t, 5)) for t in texts]


@pytest.mark.parametrize("task_edges", [0, 1000])
def test_components(spark, monkeypatch, task_edges):
    monkeypatch.setattr("panelwright.llm.graph.TASK_EDGES", task_edges)
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (200, 200)]
    found = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {100: 100, 101: 100, 200: 200}


def test_line_dedup_matches_brute_force(spark):
    r = random.Random(4)
    pool = ["alpha", "beta", "gamma", "delta", "", "  ", "epsilon", "zeta\r"]
    texts = {0: None, 1: "", 2: "\n\n", 3: "alpha", 4: "alpha", 5: "alpha\nbeta", 6: "a\na\na\na\na"}
    for _ in range(60):
        texts[len(texts)] = "\n".join(r.choices(pool, k=r.randint(1, 9)))
    docs = spark.createDataFrame([(i, t, "mine", "own") for i, t in texts.items()], DOCS).repartition(4)
    out = dedup_lines(docs)
    assert out.columns == ["doc_id", "text", "covered", "n_lines", "n_removed"]
    assert {x["doc_id"]: (x["text"], x["n_removed"]) for x in out.collect()} == brute_lines(texts)
    assert out.where("covered <> 'own'").count() == 0


def test_line_dedup_of_nothing_and_of_a_long_text(spark):
    assert dedup_lines(spark.createDataFrame([], DOCS)).collect() == []
    long = "\n".join(f"line {i % 5000}" for i in range(20_000))
    out = dedup_lines(spark.createDataFrame([(1, long, None, None)], DOCS)).select("n_lines", "n_removed", F.length("text").alias("n")).first()
    assert (out["n_lines"], out["n_removed"]) == (20_000, 15_000)


def test_line_dedup_tells_rows_of_one_id_apart(spark):
    rows = [(1, "a\nb\nc\nd"), (2, "a\nb\nc\nd\ne"), (2, "x\ny\nz\nw"), (None, "p\nq\nr"), (None, "p\nq\nr\ns"), (None, None), (5, "p\nq\nr"), (6, "m\nn\no"), (6, "m\nn\no")]
    out = dedup_lines(spark.createDataFrame([(i, t, None, None) for i, t in rows], DOCS)).select("doc_id", "text", "n_removed").collect()
    key = lambda x: tuple(str(v) for v in x)
    got = sorted(map(key, out))
    first_null = min(["p\nq\nr", "p\nq\nr\ns"], key=lambda t: spark.range(1).select(F.xxhash64(F.lit(t))).first()[0])
    second = ("", 3) if first_null != "p\nq\nr" else ("s", 3)
    want = [(1, "a\nb\nc\nd", 0), (2, "e", 4), (2, "x\ny\nz\nw", 0), (None, first_null, 0), (None, *second), (None, None, 0), (5, "", 3), (6, "m\nn\no", 0), (6, "m\nn\no", 0)]
    assert got == sorted(map(key, want))
