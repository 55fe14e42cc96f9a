import random
import zlib
from collections import defaultdict
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from panelwright.llm import segmentation
from panelwright.llm.packing import Allotment, encoder, pack, plan_phases
from panelwright.llm.textbytes import mix
from panelwright.llm.token_counts import section_tokens

DOCS = "doc_id long, text string, source string, start string, ids string"


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def corpus():
    r = random.Random(8)
    texts = [None, "", "a", "<|endoftext|>", "naïve\n\n  x  ", "日本 😀\x85\u2003y", "word " * 4000]
    texts += [" ".join("".join(r.choices("abcdeé", k=r.randint(1, 9))) for _ in range(r.randint(1, 900))) for _ in range(40)]
    return [(i, t, None if i == 3 else f"s{0 if i % 3 else i % 4}", "x", "y") for i, t in enumerate(texts)]


LATIN = st.text(alphabet=st.sampled_from(" \n\t.,;:'-\"()!?0123456789aAbeEioOstTrRnßéÉèñçüžØſ\xa0\u0178"), max_size=200)


@settings(max_examples=600, deadline=None)
@given(st.one_of(st.text(max_size=80), LATIN, st.builds("{}<|endoftext|>{}".format, LATIN, LATIN)))
def test_ids_are_those_of_the_tokenizer(text):
    own = test_ids_are_those_of_the_tokenizer
    if not hasattr(own, "t"):
        own.t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert encoder().ids(text).tolist() == own.t.encode(text, add_special_tokens=False).ids


def test_ids_of_whole_documents(spark, reference):
    texts = [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    for text, e in zip(texts, reference.encode_batch(texts, add_special_tokens=False), strict=True):
        assert encoder().ids(text).tolist() == e.ids


@pytest.mark.parametrize("targets", [None, {"s0": 0.7}])
def test_more_sources_than_queues(spark, monkeypatch, targets):
    monkeypatch.setattr("panelwright.llm.packing.MAX_SOURCES", 3)
    rows = [(i, "word " * (i % 7), f"s{i % 11}") for i in range(120)]
    pieces = pack(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4), targets=targets, length=64, window=2).collect()
    by_doc, by_sequence = defaultdict(int), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]] += p["length"]
        by_sequence[p["sequence_id"]].append(p)
        assert p["source"] == f"s{p['doc_id'] % 11}"
    assert by_doc == {p["doc_id"]: p["doc_tokens"] for p in pieces} and len(by_doc) == 120
    for at, own in by_sequence.items():
        own.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in own] == np.cumsum([0, *[p["length"] for p in own]])[:-1].tolist()
    lengths = [sum(p["length"] for p in by_sequence[s]) for s in sorted(by_sequence)]
    assert all(n == 64 for n in lengths[:-1])


def test_windows_hold_the_shares_of_very_many_sources(spark, monkeypatch):
    """Half the tokens are one source's, the rest several hundred's, far beyond the bound; every place is as plain Python puts it."""
    monkeypatch.setattr("panelwright.llm.packing.MAX_SOURCES", 3)
    monkeypatch.setattr("panelwright.llm.packing.BLOCK", 4)
    rows = [(i, "word " * (i % 5 + 1) * (200 if i % 60 == 0 else 1), "hot" if i % 60 == 0 else f"s{i % 400}") for i in range(1500)]
    pieces = pack(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5), length=64, window=8).collect()
    total, of = 0, defaultdict(int)
    for p in pieces:
        total, of[p["source"]] = total + p["length"], of[p["source"]] + p["length"]
    windows, begins = defaultdict(lambda: defaultdict(int)), defaultdict(list)
    for p in pieces:
        windows[p["sequence_id"] // 8][p["source"]] += p["length"]
        begins[p["source"]].append((p["sequence_id"] * 64 + p["offset"], p["length"]))
    for w in range(total // 512):
        for s in of:
            assert abs(windows[w][s] - 512 * of[s] / total) <= 2 + 2 * 64 * of[s] / total + len(of) * of[s] / total
    # the stream is that of all tokens by slot, source and place in their source
    stream = sorted(((2 * t + 1) * total // (2 * of[s] * 64), s, t) for s in of for t in range(of[s]))
    place = {(s, t): i for i, (_, s, t) in enumerate(stream)}
    for s, own in begins.items():
        at = 0
        for position, n in sorted(own):
            assert [place[s, at + i] for i in range(n)] == list(range(position, position + n))
            at += n


def test_windows_hold_their_shares(spark):
    """Each window of registered production form holds each source's target to within a token a source."""
    r = random.Random(5)
    rows = [(i, "word " * r.randint(1, 300), f"s{min(r.randrange(9), 5)}") for i in range(900)]
    pieces = pack(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5), window=4).collect()
    total, windows = defaultdict(int), defaultdict(lambda: defaultdict(int))
    for p in pieces:
        total[p["source"]] += p["length"]
        windows[p["sequence_id"] // 4][p["source"]] += p["length"]
    n = sum(total.values())
    for w in range(n // 4096):
        assert all(abs(windows[w][s] - 4096 * total[s] / n) <= len(total) for s in total)


@pytest.mark.parametrize("targets", [None, {"s0": 0.5, "s1": 0.3, "s2": 0.2}])
def test_pieces_tile_documents_and_sequences(spark, reference, targets):
    rows = corpus()
    pieces = pack(spark.createDataFrame(rows, DOCS).repartition(3), targets=targets, window=4).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
        assert p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes()) and len(p["ids"]) == p["length"] > 0
    for i, text, *_ in rows:
        own = sorted(by_doc[i], key=lambda p: p["start"])
        ids = reference.encode(text or "", add_special_tokens=False).ids + [0]
        assert [x for p in own for x in p["ids"]] == ids and all(p["doc_tokens"] == len(ids) for p in own)
        assert [p["start"] for p in own] == np.cumsum([0, *[p["length"] for p in own]])[:-1].tolist()
    for own in by_sequence.values():
        own.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in own] == np.cumsum([0, *[p["length"] for p in own]])[:-1].tolist()
    lengths = [sum(p["length"] for p in by_sequence[s]) for s in sorted(by_sequence)]
    assert sorted(by_sequence) == list(range(len(lengths))) and all(n == 1024 for n in lengths[:-1])
    assert pack(spark.createDataFrame([], DOCS)).collect() == []


def test_allotments_are_fair_and_grow():
    for takes in ((1, 1, 1), (7, 0, 1000, 3), (5, 5_000_000, 12)):
        a, last = Allotment(takes), tuple(0 for _ in takes)
        for m in sorted({0, 1, 2, a.total // 3, a.total // 2, a.total - 1, a.total}):
            now = a.given(m)
            assert sum(now) == m and all(x <= y <= n for x, y, n in zip(last, now, takes, strict=True))
            assert all(abs(y - n * m / a.total) < len(takes) for y, n in zip(now, takes, strict=True))
            last = now
    phases = plan_phases([100, 50, 10], [1.0, 1.0, 0.0])
    assert [p.takes for p in phases] == [(50, 50, 0), (50, 0, 0), (0, 0, 10)]


def test_section_counts_match_the_offsets(spark, reference):
    rows = corpus() + [(100, "a\n\n\nb \n c", "s", "", ""), (101, "\n", "s", "", ""), (102, "x\n", "s", "", "")]
    found = defaultdict(list)
    for x in section_tokens(spark.createDataFrame(rows, DOCS)).collect():
        found[x["doc_id"]].append(x)
    for i, text, *_ in rows:
        own, text = sorted(found[i], key=lambda x: x["section"]), text or ""
        assert "".join(text[x["start"] : x["end"]] for x in own) == text
        e, want = reference.encode(text, add_special_tokens=False), [0] * len(own)
        for a, b in e.offsets:
            overlap = [min(b, x["end"]) - max(a, x["start"]) for x in own]
            want[overlap.index(max(overlap))] += 1
        if all(ord(c) < 0x250 for c in text):
            assert [x["n_tokens"] for x in own] == want
            crossing = [0] * len(own)
            for a, b in e.offsets:
                overlap = [min(b, x["end"]) - max(a, x["start"]) for x in own]
                crossing[overlap.index(max(overlap))] += sum(o > 0 for o in overlap) > 1
            assert [x["n_crossing"] for x in own] == crossing
        assert sum(x["n_tokens"] for x in own) == len(e.ids)
    assert section_tokens(spark.createDataFrame([], DOCS)).collect() == []


def all_segmentations(m, text):
    """Every way to cut a marked text into pieces, with its probability."""
    sp = m.processor
    pieces = {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}
    out = {}
    for cuts in product([0, 1], repeat=len(text) - 1):
        parts, last = [], 0
        for i, c in enumerate(cuts, 1):
            if c:
                parts.append(text[last:i])
                last = i
        parts.append(text[last:])
        if all(p in pieces for p in parts):
            ids = tuple(pieces[p] for p in parts)
            out[ids] = np.exp(sum(m.weight[i] for i in ids))
    total = sum(out.values())
    return {k: v / total for k, v in out.items()}


def draws(text, k, seeds):
    m = segmentation.model()
    for s in seeds:
        rows = []
        for b in segmentation._rows([s], [text], mix(np.array([s], np.uint64), 7), k, True, m):
            rows += b.to_pylist()
        yield rows


def test_samples_follow_the_lattice():
    m = segmentation.model()
    chance = all_segmentations(m, "▁there▁is")
    counts, n = defaultdict(int), 4000
    second = defaultdict(int)
    for rows in draws("there is", 3, range(n)):
        ids = [tuple(r["ids"]) for r in rows]
        assert len(set(ids)) == 3 and all(abs(np.exp(r["log_prob"]) - chance[i]) < 1e-9 for r, i in zip(rows, ids, strict=True))
        assert rows[0]["perturbed"] >= rows[1]["perturbed"] >= rows[2]["perturbed"] and all(0 < r["inclusion"] <= 1 for r in rows)
        counts[ids[0]] += 1
        second[ids[1]] += 1
    for ids, p in chance.items():
        assert abs(counts[ids] / n - p) < 4 * np.sqrt(p * (1 - p) / n) + 1e-3
        without = sum(q * p / (1 - q) for other, q in chance.items() if other != ids)
        assert abs(second[ids] / n - without) < 4 * np.sqrt(without * (1 - without) / n) + 2e-3


def test_few_segmentations_are_all_given():
    rows = next(draws("a", 50, [1]))
    want = all_segmentations(segmentation.model(), "▁a")
    assert {tuple(r["ids"]) for r in rows} == set(want) and all(r["inclusion"] == 1 for r in rows)


def test_decoding_gives_the_text_back(spark):
    rows = [x for x in corpus() if x[0] != 6]
    out = segmentation.sample(spark.createDataFrame(rows, DOCS).repartition(3), k=3)
    texts = dict((i, t) for i, t, *_ in rows)
    got = out.withColumn("back", segmentation.decoded(out["ids"])).collect()
    assert all(x["back"] == (texts[x["doc_id"]] or "") for x in got)
    again = segmentation.sample(spark.createDataFrame(rows[::-1], DOCS).repartition(1), k=3).collect()
    assert {(x["doc_id"], x["rank"]): x["ids_crc32"] for x in got} == {(x["doc_id"], x["rank"]): x["ids_crc32"] for x in again}
    assert segmentation.sample(spark.createDataFrame([], DOCS), k=2).collect() == []
    plain = segmentation.sample(spark.createDataFrame(rows, DOCS), k=3)
    assert plain.groupBy("doc_id", "ids_crc32").count().where("count > 1").count() == 0
