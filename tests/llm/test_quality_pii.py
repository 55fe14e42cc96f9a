import collections
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelwright.llm import pii
from panelwright.llm.quality import default_rules, fit_votes, measures, quality

DOCS = "doc_id long, text string, w string, kept string"


def reference_counts(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0d]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    n = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if n[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def reference_spans(t):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in re.sub("[^0-9]", "", m.group())][::-1]
        if 13 <= len(d) <= 19 and sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    return out + [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def test_counts_match_brute_force(spark):
    r = random.Random(2)
    texts = [None, "", " \n\t", "a", "é日 😀\n\x0b#x", "w " * 9, "a b c d e f g h " * 3, "x\nx\n\nx \n", "k " * 5000 + "m"]
    texts += [" ".join(r.choices("abc", k=r.randint(5, 60))).replace("b", r.choice(["b", "b\n", "#"])) for _ in range(80)]
    rows = {x["doc_id"]: x for x in measures(spark.createDataFrame([(i, t, "1", "2") for i, t in enumerate(texts)], DOCS)).collect()}
    for i, t in enumerate(texts):
        x = rows[i]
        assert (x["n_words"], x["word_chars"], x["n_symbols"], x["n_dup_lines"], x["n_repeat_words"]) == reference_counts(t), t


def test_votes_find_the_bad_class():
    r = random.Random(3)
    histogram = collections.Counter()
    for _ in range(20_000):
        good = r.random() < 0.8
        histogram[tuple(2 if r.random() < 0.2 else int(r.random() < (0.97 if good else 0.3)) for _ in range(5))] += 1
    model = fit_votes(histogram, 5)
    assert abs(model.prior - 0.8) < 0.05
    assert all(abs(rates[1][1] - 0.97) < 0.03 and abs(rates[0][1] - 0.3) < 0.07 for rates in model.rates)
    assert fit_votes({}, 3).prior == 0.8


def test_quality_keeps_prose_and_drops_noise(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choices("aeiourstlnmd", k=r.choice([2, 3, 4, 5, 6, 8])))
    prose = [" ".join(word() for _ in range(80)).capitalize() + "." for _ in range(300)]
    noise = [" ".join(word() + "###" for _ in range(80)) for _ in range(25)] + [" ".join(word().upper() + "!!" for _ in range(80)) for _ in range(25)]
    docs = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(prose + noise + ["too short", None])], DOCS)
    kept = {x["doc_id"] for x in quality(docs).where("kept").collect()}
    assert kept == set(range(300))
    assert quality(docs.limit(0)).collect() == []
    assert len({rule.name for rule in default_rules()}) == len(default_rules())


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1. +-()@4509\n", max_size=60))
def test_base_spans(text):
    assert pii.base_spans(text) == reference_spans(text)


def test_base_spans_in_linear_time():
    for text in ("a1" * 100_000 + "@", "1" * 200_000, "+1 " * 60_000, "1.1" * 60_000, "a@" * 60_000):
        pii.base_spans(text)


def test_detection(spark):
    texts = {
        1: "mail me: jo.do@mail.example.com or +1 (724) 555-7214 now", 2: "host 10.0.0.255 not 10.0.0.256", 3: "card 4111 1111 1111 1111 ok", 4: None, 5: "", 6: "clean text of 12 words, version 1.2",
        7: 'token = "3f76bb46f51625a07193ae74d1cc485f188b9b5d" here',
    }
    docs = spark.createDataFrame([(i, t, "a", "b") for i, t in texts.items()], DOCS)
    rows = {x["doc_id"]: x for x in pii.detect(docs).select("doc_id", pii.digest(F.col("base")).alias("base"), pii.digest(F.col("spans")).alias("spans"), "base").collect()}
    for i, t in texts.items():
        assert rows[i][1] == pii.listed(reference_spans(t or ""))
        assert set(filter(None, rows[i][1].split(","))) <= set(rows[i]["spans"].split(","))
    assert rows[6]["spans"] == rows[4]["spans"] == ""
    assert rows[7]["spans"].startswith("secret:9:")
    clean = {x["doc_id"]: x["text"] for x in pii.redact(docs).collect()}
    assert clean[1] == "mail me: <EMAIL> or <PHONE> now" and clean[4] is None and clean[6] == texts[6]
    assert pii.detect(docs.limit(0)).collect() == []


def test_held_out_accuracy_of_the_trees():
    found = pii.train()
    writer, right, wrong, missed = pii._Writer(99), 0, 0, 0
    for _ in range(300):
        text, truth = writer.text()
        _, spans = found.spans(text)
        places = {(a, b) for _, a, b in truth}
        right += sum(any(x < b and a < y for x, y in places) for _, a, b in spans)
        wrong += sum(not any(x < b and a < y for x, y in places) for _, a, b in spans)
        missed += sum(not any(x < b and a < y for _, a, b in spans) for x, y in places)
    assert right / (right + wrong) > 0.93 and right / (right + missed) > 0.9


def test_adjacent_numbers_are_proposed_and_found():
    found = pii.train()
    for text, want in [
        ("555-123-4567 555-987-6543", ["555-123-4567", "555-987-6543"]),
        ("2024-01-05 555-123-4567", ["555-123-4567"]),
        ("call 24/7 555-123-4567", ["555-123-4567"]),
        ("pay by card 4111 1111 1111 1111 5500 0000 0000 0004 now", ["4111 1111 1111 1111", "5500 0000 0000 0004"]),
        ("mail jo (at) ex.co. ann (at) site.com", ["jo (at) ex.co", "ann (at) site.com"]),
    ]:
        proposed = {text[a:b] for _, a, b in pii.candidates(text)}
        assert set(want) <= proposed
        assert [text[a:b] for _, a, b in found.spans(text)[1]] == want
    assert len(pii.candidates("1 " * 2000)) < 20 * 2000


def test_held_out_numbers_in_lists():
    found, r, whole, total = pii.train(), random.Random(5), 0, 0
    writer = pii._Writer(123)
    for _ in range(200):
        bodies = [writer.private("phone")[1] for _ in range(r.randint(2, 5))]
        text = " ".join(writer.word() for _ in range(5)) + " " + " ".join(bodies) + " " + writer.word()
        spans, at = {(a, b) for _, a, b in found.spans(text)[1]}, 0
        for body in bodies:
            at = text.index(body, at)
            whole, total, at = whole + ((at, at + len(body)) in spans), total + 1, at + len(body)
    assert whole / total > 0.9


def test_long_keys_are_taken_whole():
    found, r = pii.train(), random.Random(8)
    for alphabet, k in (("0123456789abcdef", 256), ("0123456789abcdef", 129), ("ABCDEFGHabcdefghijklmnop0123456789_-", 700), ("ABCDEFGHIJKLMNOPqrstuvwxyz0123456789+/", 2000)):
        key = "a1" + "".join(r.choices(alphabet, k=k - 2))
        text = f'some words before token = "{key}" and after'
        assert ("secret", 27, 27 + k) in pii.candidates(text)
        assert found.spans(text)[1] == [("secret", 27, 27 + k)]
    assert pii.candidates("a1" * 500_000) == [("secret", 0, 1_000_000)]
