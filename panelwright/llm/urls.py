"""URL filtering: explicit host and path rules, then logistic regression on hashed character n-grams.

The classifier sees the n-grams of the host and of the path apart, hashed into one weight table, and is trained from a
small labelled table of URLs (columns url and label, 1 to block), bounded by a stated number of rows. Scoring is one
pass without a shuffle.

Defined results: the host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; the
path what follows it up to ``?``, ``#`` or the end. A null URL, or one without ``://``, has both empty and no n-grams,
so its score is the model's bias. Equal rows give equal results; an empty table gives no rows. Other columns, whatever
their names, aren't read.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lengths of the n-grams, size of the weight table, rows of the labelled table that are used at most.
GRAMS, BUCKETS, LABELLED_ROWS = (3, 4, 5), 1 << 16, 50_000
BLOCK_FROM = 0.5


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path begins with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: Words that are common in the hosts and paths of unwanted sites, and words of wanted ones.
_UNWANTED = (
    "casino", "jackpot", "slots", "roulette", "poker", "betting", "lottery", "payday", "quickloan", "debtrelief", "viagra", "cialis", "pills", "steroid", "weightloss", "miracle",
    "porn", "escort", "camgirl", "nude", "hookup", "warez", "torrent", "keygen", "cracked", "malware", "phishing", "clickbait", "getrich", "replica", "cheap", "discount", "giveaway",
    "freeprize", "bonus", "spam", "adserver", "tracker", "popunder", "linkfarm",
)
_WANTED = (
    "university", "hospital", "council", "archive", "journal", "gazette", "bakery", "bicycle", "orchard", "theatre", "festival", "orchestra", "railway", "harbour", "observatory", "physics",
    "botany", "history", "language", "kitchen", "carpentry", "software", "engineering", "compiler", "tutorial", "manual", "recipe", "travel", "mountain", "river", "weather", "football",
    "chess", "painting", "poetry", "library", "museum", "school", "science", "community",
)
_SYLLABLES = ("ba", "cor", "dal", "fen", "gri", "hol", "jun", "kel", "lum", "mar", "nov", "pel", "qui", "ros", "sil", "tam", "ul", "ver", "wes", "zan")


def labelled_urls(spark: SparkSession, seed: int = 11, rows: int = 16_000) -> DataFrame:
    """url, label: ``rows`` URLs written from the word lists; one in four is unwanted.

    An unwanted URL holds an unwanted word in its host or path; a wanted one doesn't. Both kinds share their other words,
    suffixes, paths and queries.
    """
    r = random.Random(seed)

    def made() -> str:
        return "".join(r.choices(_SYLLABLES, k=r.randint(2, 4)))

    def name(word: str) -> str:
        return r.choice((word, f"{word}-{made()}", f"{made()}-{word}", f"{word}{made()}", f"{made()}{word}", f"{word}{r.randint(1, 99)}", f"{word}-{r.choice(_WANTED)}"))

    def step() -> str:
        return r.choice((made(), r.choice(_WANTED), str(r.randint(1, 99999)), f"{made()}-{made()}", f"{r.randint(1995, 2030)}/{r.randint(1, 12):02}", r.choice(("en", "de", "fr", "es", "it"))))

    out = []
    for i in range(rows):
        unwanted = i % 4 == 0
        plain = r.choice((made(), made(), name(r.choice(_WANTED))))
        steps = [step() for _ in range(r.randint(0, 4))]
        host = plain
        if unwanted and (not steps or r.random() < 0.85):
            host = name(r.choice(_UNWANTED))
        elif unwanted:
            steps[r.randrange(len(steps))] = name(r.choice(_UNWANTED))
        front = r.choice(("", "", "www.", "m.", f"{made()}."))
        top = r.choice(("com", "org", "net", "info", "io", "co.uk", "de", "fr", "example.com", "example.org", "example.net"))
        tail = r.choice(("", "", "/", ".html", ".php", f"?id={r.randint(1, 999)}", f"?q={made()}", f"#{made()}"))
        out.append((f"{r.choice(('http', 'https'))}://{front}{host}.{top}/" + "/".join(steps) + tail, int(unwanted)))
    return spark.createDataFrame(out, "url string, label int")


def host_of(url: Column) -> Column:
    """A-Z are lower-cased one by one, so that other letters stay as they are."""
    after = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)).otherwise(F.lit(""))
    return F.coalesce(F.translate(after, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    after = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))
    return F.coalesce(after, F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """rule, verdict of the longest fitting rule, both null without one; of equal length the first listed."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    # built from the last choice to the first: the longest, and of these the first listed, is asked first
    for r in sorted(reversed(rules), key=lambda r: len(r.text)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        out = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def grams(host: str, path: str) -> list[int]:
    out = []
    for mark, part in (("h^", host), ("p^", path)):
        if part:
            text = mark + part + "$"
            out += [zlib.crc32((mark + text[i : i + n]).encode()) % BUCKETS for n in GRAMS for i in range(max(1, len(text) - n + 1))]
    return out


@dataclass(frozen=True)
class UrlModel:
    weights: np.ndarray
    bias: float

    def scores(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        """Probability of block: the weights of a URL's distinct n-grams, scaled by the root of their number."""
        found = [np.unique(grams(h, p)) for h, p in zip(hosts, paths, strict=True)]
        total = np.clip([self.weights[g].sum() / np.sqrt(len(g)) if len(g) else 0.0 for g in found], -30.0, 30.0)
        return 1 / (1 + np.exp(-(total + self.bias)))


def train(labelled: DataFrame, rows: int = LABELLED_ROWS, epochs: int = 8, rate: float = 4.0, decay: float = 3e-4, seed: int = 5) -> UrlModel:
    """Logistic regression by stochastic gradient descent on at most ``rows`` rows, those of the smallest URL hashes."""
    table = labelled.where(F.col("label").isNotNull()).select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("label").cast("int").alias("label"), F.xxhash64("url").alias("order"))
    table = table.orderBy("order", "host", "path", "label").limit(rows).collect()
    x, y = [np.unique(grams(r["host"], r["path"])) for r in table], [r["label"] for r in table]
    weights, bias, draw = np.zeros(BUCKETS), 0.0, np.random.default_rng(seed)
    for epoch in range(epochs):
        step = rate / (1 + 0.2 * epoch)
        for i in draw.permutation(len(y)):
            g = x[i]
            scale = 1 / np.sqrt(max(1, len(g)))
            error = y[i] - 1 / (1 + np.exp(-np.clip(weights[g].sum() * scale + bias, -30, 30)))
            weights[g] += step * (error * scale - decay * weights[g])
            bias += 0.02 * step * error
    return UrlModel(weights, bias)


@lru_cache(maxsize=1)
def _default_model(rows: int, seed: int) -> UrlModel:
    """The classifier of the written table, trained once in a driver."""
    return train(labelled_urls(SparkSession.active(), seed, rows))


def judge(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", model: UrlModel | None = None, block_from: float = BLOCK_FROM) -> DataFrame:
    """page_id, host, path, rule (null without one), verdict (allow or block), score (of the model, for every row)."""
    found = model or _default_model(16_000, 11)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = found.scores(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], ["page_id", "host", "path", "score"])

    url = F.col(url_col)
    parts = pages.select(F.col(id_col).cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    scored = parts.mapInArrow(run, "page_id long, host string, path string, score double").withColumn("fit", longest_rule(F.col("host"), F.col("path"), rules))
    by_model = F.when(F.col("score") >= block_from, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce(F.col("fit.verdict"), by_model).alias("verdict"), "score")
