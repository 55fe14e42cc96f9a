"""Document quality by weak supervision over rules that vote or abstain; DataFrame functions only.

Each rule looks at one measure of a text and votes good, bad, or abstains between its two bounds. What the rules are
worth is learned without labels: expectation-maximisation over the corpus-wide histogram of vote patterns estimates,
for each rule, how often it votes good and bad on good and on bad documents, and how common good documents are. A
document's posterior probability of being good then decides, in place of a filter that all rules must pass.

The histogram has at most 3 ** (number of rules) rows whatever the corpus holds; it is all that reaches the driver.

Defined results: a null text counts as an empty one, and a text without words has every count 0, abstains on every
rule, and fails the base check. Words are runs of characters other than ASCII white space; lines are split at line
feeds. An empty table gives no rows. Equal texts give equal results; rows of one id are judged
each by its own text, and digest, the hash of the text, tells them apart. Other columns, whatever their names, aren't read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.scratch import materialise

#: Words in a window whose repetition counts.
WINDOW_WORDS = 8
#: A document is kept from this posterior probability on.
KEEP_FROM = 0.5
#: Passes of expectation-maximisation, and the change of the log-likelihood per document under which it ends.
EM_STEPS, EM_TOLERANCE = 200, 1e-9

_WHITE = r"[\x20\x09-\x0D]"
_INK = r"[^\x20\x09-\x0D]"


def _bind(value: Column, body) -> Column:
    """body(value) with value computed once; lambda variables aren't recomputed."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text, in order."""
    return F.filter(F.split(text, _WHITE + "+", -1), lambda w: w != "")


def repeated_words(words: Column, window: int = WINDOW_WORDS) -> Column:
    """How many words lie in windows of ``window`` words that occur at two or more places of the text.

    Windows are compared by 64-bit hashes. Most texts have no repeated window, which one distinct count shows; for the
    others the windows are sorted by hash, and the places of equal neighbours are sorted and merged.
    """

    def merged(at: Column) -> Column:
        n = F.size(at)
        step = lambda x, i: F.when(i == n - 1, F.lit(window)).otherwise(F.least(F.lit(window), F.get(at, i + 1) - x))
        return F.aggregate(F.transform(at, step), F.lit(0), lambda a, x: a + x)

    def by_hash(s: Column) -> Column:
        n = F.size(s)
        same = lambda x, i: ((i > 0) & (F.get(s, F.greatest(i - 1, F.lit(0)))["h"] == x["h"])) | ((i < n - 1) & (F.get(s, F.least(i + 1, n - 1))["h"] == x["h"]))
        return _bind(F.sort_array(F.transform(F.filter(s, same), lambda x: x["at"])), merged)

    def hashed(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), _bind(pairs, by_hash)).otherwise(F.lit(0))

    def windows(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(w) - (window - 1))
        return F.when(F.size(w) > window, _bind(F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, window))), hashed)).otherwise(F.lit(0))

    return _bind(words, windows)


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest (of the text) and the counts (long) that the rules and the base check use; one scan, no shuffle."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    inked = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(_INK))
    words = _bind(words_of(text), lambda w: F.struct(F.size(w).alias("n_words"), repeated_words(w).alias("n_repeat_words"), F.size(F.filter(w, lambda x: F.length(x) <= 3)).alias("n_short_words")))
    lines = _bind(inked, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    counts = {
        "n_words": F.col("w.n_words"),
        "word_chars": F.length("text") - F.regexp_count("text", F.lit(_WHITE)),
        "n_symbols": F.regexp_count("text", F.lit(r"[#*$%&|<>]")),
        "n_dup_lines": F.col("l.n_dup_lines"),
        "n_repeat_words": F.col("w.n_repeat_words"),
        "n_lines": F.col("l.n_lines"),
        "n_short_words": F.col("w.n_short_words"),
        "n_upper": F.regexp_count("text", F.lit(r"\p{Lu}")),
        "n_marks": F.regexp_count("text", F.lit(r"[!?]")),
        "n_symbol_runs": F.regexp_count("text", F.lit(r"[#*$%&|<>]+")),
        "n_others": F.regexp_count("text", F.lit(r"[^\p{L}\p{M}\x20\x09-\x0D]")),
        "n_digits": F.regexp_count("text", F.lit(r"[0-9]")),
    }
    base = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("digest"), text.alias("text"), words.alias("w"), lines.alias("l"))
    return base.select("doc_id", "digest", *[v.cast("long").alias(k) for k, v in counts.items()])


@dataclass(frozen=True)
class Rule:
    """Votes bad from ``bad`` on, good up to ``good``, and abstains between; ``measure`` is null to abstain."""

    name: str
    measure: Column
    good: float
    bad: float

    def vote(self) -> Column:
        sign = 1 if self.bad >= self.good else -1
        bad, good = (self.measure >= self.bad, self.measure <= self.good) if sign > 0 else (self.measure <= self.bad, self.measure >= self.good)
        return F.when(bad, F.lit(0)).when(good, F.lit(1)).otherwise(F.lit(2))  # 2: abstains


def default_rules() -> list[Rule]:
    """Rules over the columns of ``measures``."""
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b))
    return [
        Rule("symbols", share("n_symbols", "n_words"), 0.05, 0.30),
        Rule("symbol_runs", share("n_symbol_runs", "n_words"), 0.05, 0.25),
        Rule("others", share("n_others", "n_words"), 0.30, 0.45),
        Rule("repeats", share("n_repeat_words", "n_words"), 0.10, 0.30),
        Rule("same_lines", share("n_dup_lines", "n_lines"), 0.15, 0.40),
        Rule("upper", share("n_upper", "word_chars"), 0.15, 0.40),
        Rule("marks", share("n_marks", "n_words"), 0.05, 0.25),
        Rule("word_length", share("word_chars", "n_words"), 9.0, 14.0),
        Rule("short_words", share("n_short_words", "n_words"), 0.20, 0.08),
        Rule("digits", share("n_digits", "word_chars"), 0.08, 0.25),
    ]


@dataclass(frozen=True)
class VoteModel:
    """prior: of good. rates[rule][class][vote]: how often a rule votes so on bad (0) and good (1) documents."""

    prior: float
    rates: list[list[list[float]]]

    def log_odds(self, votes: list[Column]) -> Column:
        out = F.lit(math.log(self.prior / (1 - self.prior)))
        for vote, (bad, good) in zip(votes, self.rates, strict=True):
            weight = [math.log(g / b) for g, b in zip(good, bad, strict=True)]
            out = out + F.when(vote == 0, F.lit(weight[0])).when(vote == 1, F.lit(weight[1])).otherwise(F.lit(0.0))
        return out


def fit_votes(histogram: dict[tuple[int, ...], int], n_rules: int) -> VoteModel:
    """Expectation-maximisation of a two-class mixture whose rules vote independently within a class.

    Abstaining carries no weight. The start says what the rules are for: a bad vote is rare on good documents, while
    each kind of junk trips only some of the rules. One pseudo-document a class and vote keeps every rate off 0 and 1.
    """
    prior = 0.8
    rates = [[[0.25, 0.75], [0.005, 0.995]] for _ in range(n_rules)]
    total, last = sum(histogram.values()), -math.inf
    for _ in range(EM_STEPS if total else 0):
        votes = [[[1.0, 1.0], [1.0, 1.0]] for _ in range(n_rules)]
        mass, loglik = [1.0, 1.0], 0.0
        for pattern, n in histogram.items():
            parts = [math.log(1 - prior), math.log(prior)]
            for k, vote in enumerate(pattern):
                if vote < 2:
                    parts = [p + math.log(rates[k][c][vote]) for c, p in enumerate(parts)]
            top = max(parts)
            weights = [math.exp(p - top) for p in parts]
            loglik += n * (top + math.log(sum(weights)))
            for c in (0, 1):
                share = n * weights[c] / sum(weights)
                mass[c] += share
                for k, vote in enumerate(pattern):
                    if vote < 2:
                        votes[k][c][vote] += share
        prior = mass[1] / sum(mass)
        rates = [[[v / sum(row) for v in row] for row in rule] for rule in votes]
        if abs(loglik - last) <= EM_TOLERANCE * total:
            break
        last = loglik
    return VoteModel(prior, rates)


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] | None = None, keep_from: float = KEEP_FROM) -> DataFrame:
    """doc_id, digest, the counts of ``measures``, p_good (double), base_failed and kept (boolean), one row per document."""
    rules = default_rules() if rules is None else rules
    counts = materialise(measures(docs, id_col, text_col), "measures")
    names = [f"vote_{r.name}" for r in rules]
    voted = counts.select("*", *[r.vote().alias(n) for r, n in zip(rules, names, strict=True)])
    patterns = voted.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).collect()  # 3 ** len(rules) rows at most
    model = fit_votes({tuple(int(r[n]) for n in names): r["n"] for r in patterns}, len(rules))
    p_good = 1 / (1 + F.exp(-model.log_odds([F.col(n) for n in names])))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    out = voted.select(*counts.columns, p_good.alias("p_good"), failed.alias("base_failed"))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= keep_from))
