"""Personal data: exact base patterns, and a boosted classifier over high-recall candidates.

Base spans are the leftmost non-overlapping matches of four fixed patterns that pass a check (parts of an address, the
Luhn sum, the number of digits). Beyond them, generators propose overlapping candidates of any number-like, address-like
or key-like form. Gradient-boosted trees score each candidate from its format and its surroundings, per-kind thresholds
are calibrated on held-out rows for a stated precision, and what passes is taken best first, never overlapping a base
span or a better one. The trees learn from a bounded table that a seeded generator writes, so no labelled personal data
is needed or kept.

Everything runs in one pass without a shuffle. Each pattern is matched in time linear in the text.

Defined results: a null or empty text has no spans. Positions are code points, ends are exclusive. Equal rows give equal
results; an empty table gives no rows. Other columns, whatever their names, aren't read.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.boosting import Boosted, calibrate, fit

BASE_KINDS = ("email", "ip", "card", "phone")
#: Kinds of the spans that the classifier adds, in the order in which spans are listed.
KINDS = (*BASE_KINDS, "secret")
#: Texts that the training table is written from, and the precision that thresholds are calibrated for.
TRAINING_TEXTS, PRECISION = 3000, 0.98

Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Texts without any of these have no candidates.
_ANY = r"[0-9@]|\(at\)|\[at\]"


def luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """An address begins where the run before its @ does, or where the last address ended."""
    after, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > after and text[first - 1] in _LOCAL:
            first -= 1
        after_at = at + 1
        if first < at and (m := _DOMAIN.match(text, at + 1)):
            yield first, m.end()
            after = after_at = m.end()
        at = text.find("@", after_at)


def base_spans(text: str) -> list[Span]:
    """The base matches, by kind and then by start."""
    out: list[Span] = [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(x := part.lstrip("0")) <= 3 and int(x or 0) <= 255 for part in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if 13 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


_LOOSE = {
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.])"),
    "secret": re.compile(r"(?<![A-Za-z0-9_/+=-])[A-Za-z0-9_/+=-]{16,}+"),
}
#: The beginning of an address up to its at sign, the first part of its domain, and each further part.
_HEAD = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?:@|\(at\)|\[at\])")
_LABEL, _MORE = re.compile(r"\x20?[A-Za-z0-9-]{1,63}"), re.compile(r"\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]{1,63}")
_GROUP = re.compile(r"[0-9]+")
#: What may lie between two groups of digits, and the least and most digits.
_GROUPED = {"card": (re.compile(r"[\x20.-]"), 12, 19), "phone": (re.compile(r"[\x20()./-]{1,2}"), 7, 15)}
#: Groups of digits next to a span.
_BEFORE, _AFTER = re.compile(r"([0-9]{1,6})[\x20()./,-]{1,2}\Z"), re.compile(r"[\x20()./,-]{1,2}([0-9]{1,6})")


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Of each at sign with a name before it, the domains of two to five parts."""
    for m in _HEAD.finditer(text):
        part = _LABEL.match(text, m.end())
        for _ in range(4):
            if not (part := part and _MORE.match(text, part.end())):
                break
            yield m.start(), part.end()


def _numbers(text: str, groups: list[tuple[int, int]], kind: str) -> Iterator[tuple[int, int]]:
    """From the start of every group of digits to the end of every group, where the digits between are as many as allowed."""
    between, least, most = _GROUPED[kind]
    for i, (a, b) in enumerate(groups):
        n, first = b - a, a - (kind == "phone" and text[a - 1 : a] in ("+", "("))
        j = i
        while n <= most:
            if n >= least:
                yield first, b
            j += 1
            if j == len(groups) or groups[j][0] - b > 2 or not between.fullmatch(text, b, groups[j][0]):
                break
            n, b = n + groups[j][1] - groups[j][0], groups[j][1]


def candidates(text: str) -> list[Span]:
    """Overlapping proposals of every kind, a bounded number at each place; keys need a digit."""
    groups = [m.span() for m in _GROUP.finditer(text)]
    found = [("email", a, b) for a, b in _addresses(text)]
    found += [("ip", m.start(), m.end()) for m in _LOOSE["ip"].finditer(text)]
    found += [(kind, a, b) for kind in _GROUPED for a, b in _numbers(text, groups, kind)]
    return found + [("secret", m.start(), m.end()) for m in _LOOSE["secret"].finditer(text) if any("0" <= c <= "9" for c in m.group())]


def _edges(text: str, a: int, b: int) -> tuple[int, int]:
    """Digits of the groups that a separator of up to two characters parts from the span, before and after it."""
    before, after = _BEFORE.search(text[max(0, a - 8) : a]), _AFTER.match(text, b, b + 8)
    return len(before[1]) if before else 0, len(after[1]) if after else 0


#: Words whose nearness speaks for or against a kind.
_CUES = {
    "email": ("mail", "email", "contact", "write", "correo", "courriel", "address"),
    "ip": ("ip", "host", "server", "address", "login", "from", "connect"),
    "card": ("card", "visa", "credit", "debit", "payment", "tarjeta", "carte", "karte"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "whatsapp", "sms"),
    "secret": ("token", "key", "secret", "password", "passwd", "api", "auth", "bearer"),
}
_AGAINST = ("version", "release", "section", "isbn", "order", "invoice", "page", "chapter", "figure", "sha", "commit", "build", "item", "id", "no", "number", "date", "serial")
_WORD = re.compile(r"[A-Za-z]+")


def features(text: str, span: Span) -> list[float]:
    """Format of the candidate, then its surroundings."""
    kind, a, b = span
    body = text[a:b]
    digits, letters = _digits(body), sum(c.isalpha() for c in body)
    counts = np.bincount(np.frombuffer(body.encode(), np.uint8))
    counts = counts[counts > 0] / len(body)
    near = [w.lower() for w in _WORD.findall(text[max(0, a - 40) : a])[-4:]]
    groups = re.findall(r"[0-9]+", body)
    parts = [len(g) for g in groups]
    octets = [int(g) if len(g) <= 3 else 999 for g in groups] or [999]
    before, after = text[a - 1 : a] or " ", text[b : b + 1] or " "
    between = re.findall(r"[^0-9]+", body)
    return [
        KINDS.index(kind), b - a, len(digits), letters, len(digits) / (b - a), sum(c.isupper() for c in body) / (b - a),
        float(-(counts * np.log2(counts)).sum()), len(parts), max(parts, default=0), min(parts, default=0), max(octets),
        13 <= len(digits) <= 19 and luhn(digits), body.count("."), body.count("-"), body.count(" "), body.count("("), body[0] == "+", "@" in body,
        sum(c in "0123456789abcdef" for c in body) / (b - a), float(digits[:1] or 0),
        sum(w in _CUES[kind] for w in near), sum(w in words for k, words in _CUES.items() if k != kind for w in near), sum(w in _AGAINST for w in near),
        bool(near) and near[-1] in _CUES[kind], bool(near) and near[-1] in _AGAINST, before in "\"'=:(", before.isalnum() or before in "./-_", after.isalnum() or after in "/-_%",
        "://" in text[max(0, a - 60) : a].split(" ")[-1],
        *_edges(text, a, b), before in between, after in between, len(set(between)), *([*parts, 0, 0, 0][:3]), parts[-1] if parts else 0,
        ". " in body, kind == "email" and bool(_MORE.match(text, b)), text[b : b + 1] == "." and text[b + 1 : b + 2].isalnum(),
    ]


class _Writer:
    """Writes training texts with known personal data and look-alikes."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def n(self, k: int, first: str = "0123456789") -> str:
        return self.r.choice(first) + "".join(self.r.choices("0123456789", k=k - 1))

    def word(self) -> str:
        return "".join(self.r.choices("aeioubcdfghlmnprstvw", k=self.r.randint(2, 9)))

    def dated(self) -> str:
        r = self.r
        day = r.choice(["-", "/", "."]).join((str(r.randint(1900, 2030)), f"{r.randint(1, 12):02}", f"{r.randint(1, 28):02}"))
        return r.choice([day, f"{day} {r.randint(0, 23):02}:{r.randint(0, 59):02}", "24/7", str(r.randint(1, 99)), f"{r.randint(1, 12)}/{r.randint(1, 28)}"])

    def private(self, kind: str | None = None) -> tuple[str, str]:
        r = self.r
        kind = kind or r.choice(KINDS)
        if kind == "email":
            at, dot = r.choice([("@", "."), (" (at) ", " (dot) "), ("[at]", "[dot]"), ("(at)", "."), (" @ ", ".")])
            return kind, f"{self.word()}{r.choice('._-')}{self.n(r.randint(1, 3))}{at}{self.word()}{dot}{r.choice(['com', 'org', 'net', 'example.com'])}"
        if kind == "ip":
            return kind, ".".join(str(r.randint(1, 254)) for _ in range(4))
        if kind == "card":
            d = self.n(15, "3456")
            d += next(c for c in "0123456789" if luhn(d + c)) if r.random() < 0.7 else self.n(1)
            return kind, r.choice(["", " ", "-"]).join((d[:4], d[4:8], d[8:12], d[12:]))
        if kind == "phone":
            a, b, c = self.n(3, "23456789"), self.n(3), self.n(4)
            return kind, r.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+1 ({a}) {b}-{c}", f"{a}.{b}.{c}", f"0{self.n(2)} {self.n(7)}", f"+{self.n(2, '34')} {self.n(9)}"])
        if r.random() < 0.2:  # long keys, tokens and encoded lines
            return kind, "".join(r.choices(r.choice(["0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-"]), k=r.choice([96, 128, 129, 256, 512, r.randint(130, 3000)])))
        if r.random() < 0.5:
            return kind, "".join(r.choices("0123456789abcdef", k=r.choice([32, 40, 64])))
        return kind, "AKIA" + "".join(r.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=16)) if r.random() < 0.5 else "".join(r.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=r.randint(24, 48)))

    def harmless(self) -> str:
        r = self.r
        return r.choice([
            lambda: f"version {r.randint(1, 20)}.{r.randint(0, 400)}.{r.randint(0, 300)}.{r.randint(256, 999)}", lambda: f"order {self.n(r.randint(7, 14))}", lambda: f"ISBN 978-{self.n(1)}-{self.n(4)}-{self.n(4)}-{self.n(1)}",
            lambda: f"{r.randint(1900, 2030)}-{r.randint(10, 12)}-{r.randint(10, 28)} {r.randint(10, 23)}:{r.randint(10, 59)}", lambda: f"{r.randint(1900, 2030)}/{r.randint(10, 12)}/{r.randint(10, 28)}", lambda: f"invoice no {self.n(r.randint(8, 16))}",
            lambda: f"{self.n(3)}.{self.n(3)}.{self.n(3)}", lambda: f"chapter_{self.word()}_{self.word()}_{r.randint(1, 30)}", lambda: f"https://www.{self.word()}.example.com/{self.word()}/{self.n(9)}", lambda: f"page {self.n(7)}",
            lambda: f"{self.word()}-{self.word()}-{self.word()}-{r.randint(2, 2030)}", lambda: f"id {self.n(r.randint(7, 18))}", lambda: r.choice("=-_") * r.choice([r.randint(16, 30), r.randint(31, 400)]) + self.n(1), lambda: r.choice("-_/").join(self.word() for _ in range(r.randint(5, 60))) + f"-{r.randint(2, 2030)}", lambda: f"{self.n(8)}", lambda: f"{self.n(2)} {self.n(3)} {self.n(3)}",
        ])()

    def text(self) -> tuple[str, list[Span]]:
        out, spans = "", []
        for _ in range(self.r.randint(2, 5)):
            out += " ".join(self.word() for _ in range(self.r.randint(3, 9))) + " "
            if self.r.random() < 0.5:
                kind, body = self.private()
                cue = self.r.random()
                if kind in ("phone", "card") and self.r.random() < 0.3:  # logs
                    out += self.dated() + self.r.choice([" ", " ", ", ", "\t"])
                if cue < 0.4:
                    out += self.r.choice(_CUES[kind]) + self.r.choice([" ", ": ", " = ", ' = "'])
                spans.append((kind, len(out), len(out) + len(body)))
                while kind in ("phone", "card") and not out.endswith('"') and self.r.random() < 0.65:  # lists and tables
                    out += body + self.r.choice([" ", " ", ", ", "; ", "\n"])
                    kind, body = self.private(self.r.choice(("phone", "phone", "card")))
                    spans.append((kind, len(out), len(out) + len(body)))
                out += body + ('" ' if out.endswith('"') else self.r.choice([" ", ". ", ", "]))
            else:
                out += self.harmless() + self.r.choice([" ", ". ", ", "])
        return out, spans


@dataclass(frozen=True)
class Detector:
    """Scores candidates; thresholds: by kind, above 1 if no threshold is precise enough."""

    model: Boosted
    thresholds: dict[str, float]

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """Base spans, and all spans by kind and start."""
        base = base_spans(text)
        taken = sorted((a, b) for _, a, b in base)
        proposed = candidates(text)
        added: list[Span] = []
        if proposed:
            scores = self.model.probability(np.array([features(text, s) for s in proposed], float))
            held = _Intervals(taken)
            for p, (kind, a, b) in sorted(zip(-scores, proposed, strict=True), key=lambda x: (x[0], x[1][1], x[1][2], KINDS.index(x[1][0]))):
                if -p >= self.thresholds[kind] and held.add(a, b):
                    added.append((kind, a, b))
        return base, sorted([*base, *added], key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


class _Intervals:
    """Ranges of a text; ``add`` refuses what overlaps one that is there."""

    def __init__(self, ranges: list[tuple[int, int]]):
        self.cells: dict[int, list[tuple[int, int]]] = {}
        for a, b in ranges:
            self._put(a, b)

    def _put(self, a: int, b: int) -> None:
        for cell in range(a >> 6, ((b - 1) >> 6) + 1):
            self.cells.setdefault(cell, []).append((a, b))

    def add(self, a: int, b: int) -> bool:
        if any(x < b and a < y for cell in range(a >> 6, ((b - 1) >> 6) + 1) for x, y in self.cells.get(cell, ())):
            return False
        self._put(a, b)
        return True


@lru_cache(maxsize=4)
def train(texts: int = TRAINING_TEXTS, precision: float = PRECISION, seed: int = 17) -> Detector:
    """Fit trees on two thirds of the written candidates, calibrate and set thresholds on the rest."""
    writer, rows, labels, kinds = _Writer(seed), [], [], []
    for _ in range(texts):
        text, truth = writer.text()
        for span in candidates(text):
            rows.append(features(text, span))
            slack = 0 if span[0] in _GROUPED else 2
            labels.append(any(k == span[0] and abs(a - span[1]) <= slack and abs(b - span[2]) <= slack for k, a, b in truth))
            kinds.append(span[0])
    x, y = np.array(rows, float), np.array(labels, float)
    held = np.arange(len(y)) % 3 == 2
    model = calibrate(fit(x[~held], y[~held]), x[held], y[held])
    p, thresholds = model.probability(x[held]), {}
    for kind in KINDS:
        own = np.array(kinds)[held] == kind
        order = np.argsort(-p[own], kind="stable")
        right = np.cumsum(y[held][own][order]) / np.arange(1, own.sum() + 1)
        good = np.flatnonzero(right >= precision)
        thresholds[kind] = max(0.5, float(p[own][order][good[-1]])) if len(good) else math.inf
    return Detector(model, thresholds)


def listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", detector: Detector | None = None) -> DataFrame:
    """doc_id, base and spans: arrays of (kind, start, end) by kind and start, for every row."""
    found = detector or train()
    schema = "doc_id long, base array<struct<kind:string,start:int,end:int>>, spans array<struct<kind:string,start:int,end:int>>"
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maybe = pc.fill_null(pc.match_substring_regex(batch.column(1), _ANY), False)
            none: list[Span] = []
            rows = [found.spans(t.as_py()) if m else (none, none) for t, m in zip(batch.column(1), maybe.to_pylist(), strict=True)]
            as_rows = lambda k: pa.array([[{"kind": s[0], "start": s[1], "end": s[2]} for s in r[k]] for r in rows], kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), as_rows(0), as_rows(1)], ["doc_id", "base", "spans"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def digest(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, text_col: str = "text", detector: Detector | None = None) -> DataFrame:
    """``docs`` with each span of its text replaced by its kind in angle brackets; no row or column goes."""
    found = detector or train()
    at = docs.columns.index(text_col)

    def clean(text: str) -> str:
        out, last = [], 0
        for kind, a, b in sorted(found.spans(text)[1], key=lambda s: (s[1], s[2])):
            if a >= last:
                out += [text[last:a], f"<{kind.upper()}>"]
            last = max(last, b)
        return "".join([*out, text[last:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at)
            maybe = pc.fill_null(pc.match_substring_regex(column, _ANY), False)
            if pc.any(maybe).as_py():
                column = pa.array([clean(t.as_py()) if m else t.as_py() for t, m in zip(column, maybe.to_pylist(), strict=True)], column.type)
                batch = batch.set_column(at, batch.schema.field(at).name, column)
            yield batch

    return docs.mapInArrow(run, docs.schema)


def sha256_of(spans: list[Span]) -> str:
    return hashlib.sha256(listed(spans).encode()).hexdigest()
