"""Quality rules: a decision list learned by sequential covering, given out as a Spark expression.

Statistics of every whole text are computed once. On a bounded sample of labelled
rows the list is grown rule by rule: a conjunction of thresholds is grown on part
of the sample, pruned on the rest, kept if it is precise there, and the rows it
covers are set aside. The list becomes nested ``when`` conditions over the
statistics, which decide on all rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from areapulse.llm.common import SPACES, map_rows
from areapulse.session import stage

# Fixed values of the base statistics.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
REPEATED_PERCENT = 30

SAMPLE_ROWS = 20_000
STATISTICS = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_upper long, n_digits long, n_marks long, n_same_words long"
)
#: Rates that rules may test, each a count over another; none of them depends on the length of a clean text.
RATES = {
    "chars_per_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
    "same_word_share": ("n_same_words", "n_words"),
}


def repeated_words(words: list, width: int = WINDOW) -> int:
    """Words inside windows that occur at least twice. Windows are compared exactly: pairs of numbered pieces are numbered in turn."""
    if len(words) < width + 1:
        return 0
    number: dict = {}
    ranks = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    counts, size = None, 1
    while size < width:
        step = min(size, width - size)
        pairs = ranks[:-step] * (len(ranks) + 1) + ranks[step:]
        _, ranks, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        size += step
        if len(counts) == len(ranks):
            return 0
    starts = counts[ranks] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    edges[: len(starts)] += starts
    edges[width : width + len(starts)] -= starts
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def _count(data: bytes, characters: bytes) -> int:
    return len(data) - len(data.translate(None, characters))


def statistics_of(text: str | None) -> tuple[int, ...]:
    """The numbers of ``STATISTICS`` for a whole text; NULL is a text without words."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words), len(text) - _count(data, SPACES.encode()), _count(data, SYMBOLS.encode()), len(lines) - len(set(lines)),
        repeated_words(words), len(lines), _count(data, bytes(range(65, 91))), _count(data, b"0123456789"),
        _count(data, b"!?"), sum(map(eq, words, islice(words, 1, None))),
    )


def statistics(docs: DataFrame) -> DataFrame:
    """``STATISTICS`` of every row; repeated rows and NULL ids are kept, other columns not read."""

    def each(doc_id, text):
        yield doc_id, *statistics_of(text)

    return map_rows(docs, ["doc_id", "text"], STATISTICS, each)


def rate(name: str) -> Column:
    over, under = RATES[name]
    return F.coalesce(F.col(over) / F.nullif(F.col(under), F.lit(0)), F.lit(0.0))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Test:
    """One threshold: ``name`` at least, or at most, ``value``."""

    name: str
    at_least: bool
    value: float

    def holds(self, data: dict[str, np.ndarray]) -> np.ndarray:
        return data[self.name] >= self.value if self.at_least else data[self.name] <= self.value

    def condition(self) -> Column:
        return rate(self.name) >= self.value if self.at_least else rate(self.name) <= self.value


Rule = tuple[Test, ...]


def covers(rule: Rule, data: dict[str, np.ndarray]) -> np.ndarray:
    held = np.ones(len(next(iter(data.values()))), bool)
    for test in rule:
        held &= test.holds(data)
    return held


def _best_test(data: dict[str, np.ndarray], bad: np.ndarray) -> tuple[float, Test | None]:
    """The threshold with the largest information gain for the bad rows (FOIL's measure)."""
    total, positives = len(bad), int(bad.sum())
    best, found = 0.0, None
    before = np.log2(positives / total)
    for name, values in data.items():
        order = np.argsort(values, kind="stable")
        ordered, p = values[order], np.cumsum(bad[order])
        n = np.arange(1, total + 1)
        ends = np.append(ordered[1:] > ordered[:-1], False)
        for at_least in (False, True):
            kept = total - n if at_least else n
            good = positives - p if at_least else p
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(ends & (good > 0), good * (np.log2(good / kept) - before), -1.0)
            at = int(np.argmax(gain))
            if gain[at] > best:
                middle = float((ordered[at] + ordered[at + 1]) / 2)
                best, found = float(gain[at]), Test(name, at_least, middle)
    return best, found


def grow(data: dict[str, np.ndarray], bad: np.ndarray, most_tests: int) -> Rule:
    """Add thresholds while they help and bad and good rows are still mixed."""
    rule: list[Test] = []
    held = np.ones(len(bad), bool)
    while len(rule) < most_tests and 0 < bad[held].sum() < held.sum():
        gain, test = _best_test({k: v[held] for k, v in data.items()}, bad[held])
        if test is None:
            break
        rule.append(test)
        held &= test.holds(data)
    return tuple(rule)


def prune(rule: Rule, data: dict[str, np.ndarray], bad: np.ndarray) -> tuple[Rule, float, int]:
    """The leading part of a rule that separates best on rows it was not grown on, with its precision and support there."""
    best, worth, precision, support = rule, -1.0, 0.0, 0
    for size in range(1, len(rule) + 1):
        held = covers(rule[:size], data)
        p, n = int((held & bad).sum()), int((held & ~bad).sum())
        value = (p - n) / (p + n) if p + n else -1.0
        if value > worth:
            best, worth, precision, support = rule[:size], value, p / (p + n), p + n
    return best, precision, support


def learn_rules(
    data: dict[str, np.ndarray], bad: np.ndarray, least_precision: float = 0.95, least_support: int = 3,
    most_rules: int = 16, most_tests: int = 4, seed: int = 7,
) -> list[Rule]:
    """Sequential covering: an ordered list of rules for bad rows, each learned on what the earlier ones leave.

    Two thirds of the rows grow rules, the rest prune and judge them. Learning
    ends when no bad row is left, a rule is not precise enough, or at
    ``most_rules``. Without bad or without good rows there are no rules.
    """
    rules: list[Rule] = []
    growing = np.random.default_rng(seed).random(len(bad)) < 2 / 3
    left = np.ones(len(bad), bool)
    while len(rules) < most_rules:
        g, p = left & growing, left & ~growing
        if not bad[g].any() or bad[g].all():
            break
        rule = grow({k: v[g] for k, v in data.items()}, bad[g], most_tests)
        if not rule or not p.any():
            break
        rule, precision, support = prune(rule, {k: v[p] for k, v in data.items()}, bad[p])
        if precision < least_precision or support < least_support:
            break
        rules.append(rule)
        left &= ~covers(rule, data)
    return rules


def decision(rules: list[Rule]) -> Column:
    """True to keep: the first rule that holds says no, and a row that none covers is kept."""
    verdict = F.lit(True)
    for rule in reversed(rules):
        held = rule[0].condition()
        for test in rule[1:]:
            held = held & test.condition()
        verdict = F.when(held, F.lit(False)).otherwise(verdict)
    return verdict


def learn(stats: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, label: str = "quality") -> list[Rule]:
    """Rules from labelled statistics; at most ``sample_rows`` rows, in the order of a hash of their ids, reach the driver.

    Rows with a NULL id or label take no part; a document labelled twice counts
    once, as good if any label says so.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("_label"))
    rated = stats.join(known, "doc_id").select("_label", F.xxhash64("doc_id").alias("_key"), *[rate(n).alias(n) for n in RATES])
    rows = rated.orderBy("_key", *RATES).limit(sample_rows).select("_label", *RATES).toPandas()
    data = {n: rows[n].to_numpy(np.float64) for n in RATES}
    return learn_rules(data, rows["_label"].to_numpy() == 0)


def judged(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """All statistics of every row with ``base_failed`` and ``kept``. An empty table gives no rows; without labels only the base decides."""
    stats = stage(docs.sparkSession, statistics(docs), "text_statistics")
    rules = learn(stats, labels, sample_rows)
    return stats.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & decision(rules))
