"""Every registered query of the subpackage over the smallest tables: against its SQL, or against brute force."""

import hashlib
import math
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.dataset as ds
import pytest
from tokenizers import Tokenizer

from panelwright.llm import oracles, pii, queries
from tests.llm.test_quality_pii import reference_counts, reference_spans

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents():
    return {r["doc_id"]: r for r in ds.dataset(f"{SF_DIR}/documents.parquet").to_table().to_pylist()}


def run(spark, name):
    return queries.queries()[name](spark, SF_DIR)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_gives_what_its_sql_gives(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        con.register(table, ds.dataset(f"{SF_DIR}/{table}.parquet").to_table())
    got, want = run(spark, name), con.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_every_query_has_sql_or_a_test_here():
    own = {"op2_toxicity", "op3_packing", "op4_url_filters", "op5_token_counts", "op6_sampled_segmentation", "op7_quality_rules", "op8_pii", "op11_main_text"}
    assert set(queries.queries()) == own | set(queries.oracle_sql()) and len(vars(oracles)) > 3


def test_toxicity_scores_each_text_by_itself(spark, documents):
    from panelwright.llm import toxicity as t

    found = {r["doc_id"]: r for r in run(spark, "op2_toxicity").collect()}
    assert set(found) == set(documents)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    # the same model, from the labels that the contract allows, on one text at a time
    usable = labels.where("crc32(cast(cast(doc_id AS string) AS binary)) % 3 <> 1").selectExpr("doc_id", "toxic")
    again = {r["doc_id"]: r["score"] for r in t.toxicity(docs.repartition(7).select("doc_id", "text", "lang"), usable).collect()}
    for i, r in found.items():
        held = zlib.crc32(str(i).encode()) % 3 == 1
        assert r["held_out"] == held and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        assert abs(again[i] - r["score"]) < 1e-5


def test_packing_tiles_every_document(spark, documents):
    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in run(spark, "op3_packing").collect():
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    assert set(by_doc) == set(documents)
    for i, own in by_doc.items():
        ids, at = np.array(full.encode(documents[i]["text"] or "", add_special_tokens=False).ids + [0], "<u4"), 0
        for p in sorted(own, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            at += p["length"]
            assert p["ids_crc32"] == zlib.crc32(ids[p["start"] : at].tobytes())
        assert at == len(ids)
    fills = []
    for s in sorted(by_sequence):
        at = 0
        for p in sorted(by_sequence[s], key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        fills.append(at)
    assert all(n == 1024 for n in fills[:-1]) and fills[-1] <= 1024


def test_url_verdicts(spark):
    from panelwright.llm.urls import grams, labelled_urls, train

    model = train(labelled_urls(spark))
    rules = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
    pages = {r["page_id"]: r["url"] for r in ds.dataset(f"{SF_DIR}/pages.parquet").to_table(columns=["page_id", "url"]).to_pylist()}
    found = run(spark, "op4_url_filters").collect()
    assert sorted(r["page_id"] for r in found) == sorted(pages)
    for r in found:
        url, host, path = pages[r["page_id"]], "", ""
        if url and "://" in url:
            host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
            host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        fits = [(h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda x: len(x[0])) if fits else (None, None)
        g = sorted(set(grams(host, path)))
        score = 1 / (1 + math.exp(-(sum(model.weights[x] for x in g) / math.sqrt(len(g)) if g else 0.0) - model.bias))
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and abs(r["score"] - score) < 1e-9
        assert r["verdict"] == (verdict or ("block" if r["score"] >= 0.5 else "allow"))


def test_token_counts_add_up(spark, documents):
    full, totals = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), defaultdict(int)
    for r in run(spark, "op5_token_counts").collect():
        totals[r["doc_id"]] += r["n_tokens"]
    assert totals == {i: len(full.encode(r["text"] or "", add_special_tokens=False).ids) for i, r in documents.items()}


def test_segmentations_spell_the_texts(spark, documents):
    from panelwright.llm.segmentation import model, sample

    rows = run(spark, "op6_sampled_segmentation").collect()
    assert len({(r["doc_id"], r["ids_crc32"]) for r in rows}) == len(rows)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(5)
    with_ids = {(r["doc_id"], r["rank"]): r["ids"] for r in sample(docs, k=2).collect()}
    for r in rows:
        ids = with_ids[r["doc_id"], r["rank"]]
        assert r["n_pieces"] == len(ids) and r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        assert model().processor.decode(ids) == (documents[r["doc_id"]]["text"] or "")


def test_quality_verdicts(spark, documents):
    from panelwright.llm.quality import default_rules, fit_votes, measures

    rules = default_rules()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    votes = {r["doc_id"]: tuple(r[f"v{k}"] for k in range(len(rules))) for r in measures(docs).select("doc_id", *[x.vote().alias(f"v{k}") for k, x in enumerate(rules)]).collect()}
    histogram = defaultdict(int)
    for v in votes.values():
        histogram[v] += 1
    model = fit_votes(histogram, len(rules))
    found = run(spark, "op7_quality_rules").collect()
    assert sorted(r["doc_id"] for r in found) == sorted(documents)
    for r in found:
        n, *counts = reference_counts(documents[r["doc_id"]]["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, *counts)
        assert r["base_failed"] == (n < 20 or 100 * r["n_repeat_words"] > 30 * n)
        odds = math.log(model.prior / (1 - model.prior)) + sum(math.log(model.rates[k][1][v] / model.rates[k][0][v]) for k, v in enumerate(votes[r["doc_id"]]) if v < 2)
        assert abs(r["p_good"] - 1 / (1 + math.exp(-odds))) < 1e-9
        assert r["kept"] == (not r["base_failed"] and r["p_good"] >= 0.5)


def test_personal_data(spark, documents):
    detector = pii.train()
    found = run(spark, "op8_pii").collect()
    assert sorted(r["doc_id"] for r in found) == sorted(documents)
    for r in found:
        text = documents[r["doc_id"]]["text"] or ""
        base = reference_spans(text)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(x[0] == k for x in base) for k in pii.BASE_KINDS]
        every = [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in r["spans"].split(",") if x)]
        assert set(base) <= set(every) and every == sorted(every, key=lambda s: (pii.KINDS.index(s[0]), s[1], s[2]))
        # the method's spans: best first over all candidates, none over a base span or a better one
        proposed = pii.candidates(text)
        scores = detector.model.probability(np.array([pii.features(text, s) for s in proposed], float)) if proposed else []
        taken = [(a, b) for _, a, b in base]
        for p, (kind, a, b) in sorted(zip(scores, proposed, strict=True), key=lambda x: (-x[0], x[1][1], x[1][2], pii.KINDS.index(x[1][0]))):
            if p >= detector.thresholds[kind] and not any(x < b and a < y for x, y in taken):
                taken.append((a, b))
        assert sorted((a, b) for _, a, b in every) == sorted(taken)


def test_word_features_do_not_depend_on_batches():
    from panelwright.llm import toxicity as t

    texts = ["a b c", "", None, "longer words here, and more"]
    net = t.fresh(2)
    whole = np.concatenate([net.scores(f, h) for f, h in t.word_features(pa.array(texts))])
    alone = np.concatenate([net.scores(f, h) for x in texts for f, h in t.word_features(pa.array([x], pa.string()))])
    assert np.allclose(whole, alone, atol=1e-6)
