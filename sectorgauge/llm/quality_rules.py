"""Quality rules as weak supervision.

Rules vote bad (-1), abstain (0) or vote good (1) on every document. A two-class model
with the accuracy of each rule's votes in each class is fitted by expectation-maximisation to
the counts of the vote patterns, and a document stays if its posterior probability of
being good is at least one half. Everything per document is a built-in function; the
model sees a table of at most ``3 ** len(RULES)`` pattern counts.

Null texts and texts without words have no words: they fail the base rule. Repeated
rows are judged one by one. Only the id and text columns are read, so other columns
may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sectorgauge.llm.common import SPACES, text_of, words_of

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SMOOTHING = 1.0
#: Rules are written so that at most this share of their votes on good documents is bad.
MAX_FALSE_ALARMS = 0.005
ROUNDS = 40


def _repeat_words(docs: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``: words inside a three-word window that occurs twice or more.

    Windows are hashed to 64 bits. Where a window repeats, (window, place) pairs are
    sorted, neighbours compared, and the covered words counted from sorted places.
    """
    docs = docs.withColumn(
        "grams",
        F.transform(
            F.slice(F.col("words"), F.lit(1), F.greatest(F.size("words") - 2, F.lit(0))),
            lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)),
        ),
    )
    docs = docs.withColumn(
        "placed",
        F.when(
            F.size(F.array_distinct("grams")) < F.size("grams"),
            F.sort_array(
                F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))
            ),
        ),
    )

    def repeated(x: Column, j: Column) -> Column:
        before, after = F.get("placed", j - 1)["g"], F.get("placed", j + 1)["g"]
        return F.coalesce(x["g"] == before, F.lit(False)) | F.coalesce(
            x["g"] == after, F.lit(False)
        )

    docs = docs.withColumn(
        "places", F.sort_array(F.transform(F.filter("placed", repeated), lambda x: x["i"]))
    )
    covered = F.transform(
        "places",
        lambda p, j: F.least(F.lit(3), F.coalesce(F.get("places", j + 1) - p, F.lit(3))),
    )
    total = F.aggregate(covered, F.lit(0), lambda a, x: a + x)
    return docs.withColumn("n_repeat_words", F.coalesce(total, F.lit(0)).cast("long"))


def text_statistics(docs: DataFrame, *carry: str) -> DataFrame:
    """Counts that the rules need, one struct ``stats`` per row; ``carry`` columns stay.

    Store the result before filtering by it: the optimiser moves a filter below these
    expressions and repeats them for each count that the filter names.
    """
    text = F.col("_text")
    docs = docs.select(*carry, text_of().alias("_text"))
    carried = F.struct(*carry, F.lit(1).alias("_")).alias("_row")
    docs = docs.select(carried, "_text", words_of(text).alias("words"))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    docs = docs.select(
        "_row",
        "words",
        lines.alias("lines"),
        F.length(F.translate(text, SPACES, "")).alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).alias("n_symbols"),
        (F.length(text) - F.length(F.translate(text, "!?", ""))).alias("n_shouts"),
        (F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))).alias("n_upper"),
        F.length(F.regexp_replace(text, r"\P{L}+", "")).alias("n_letters"),
    )
    docs = _repeat_words(docs)
    counts = {
        "n_words": F.size("words"),
        "n_lines": F.size("lines"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
    } | {
        name: F.col(name)
        for name in ("word_chars", "n_symbols", "n_shouts", "n_upper", "n_letters", "n_repeat_words")
    }
    stats = F.struct(*(c.cast("long").alias(name) for name, c in counts.items()))
    return docs.select(*(F.col("_row")[c].alias(c) for c in carry), stats.alias("stats"))


def _band(part: str, whole: str, good: int, bad: int) -> Column:
    """Bad above ``bad`` percent, good up to ``good`` percent, abstain between or without a whole."""
    share, whole_ = 100 * F.col(f"stats.{part}"), F.col(f"stats.{whole}")
    return (
        F.when(whole_ <= 0, 0).when(share > bad * whole_, -1).when(share <= good * whole_, 1).otherwise(0)
    )


def rule_votes() -> dict[str, Column]:
    """The rules; each votes -1, 0 or 1 on the counts in ``stats``."""
    letters = 100 * F.col("stats.n_letters")
    chars, words = F.col("stats.word_chars"), F.col("stats.n_words")
    return {
        "symbols": _band("n_symbols", "n_words", 5, 25),
        "repeats": _band("n_repeat_words", "n_words", 10, 30),
        "lines": F.when(F.col("stats.n_lines") < 2, 0).otherwise(
            _band("n_dup_lines", "n_lines", 5, 60)
        ),
        "capitals": _band("n_upper", "n_letters", 10, 40),
        "shouting": _band("n_shouts", "n_words", 10, 40),
        "letters": F.when(chars <= 0, 0)
        .when(letters < 75 * chars, -1)
        .when(letters >= 85 * chars, 1)
        .otherwise(0),
        "word_length": F.when(words <= 0, 0)
        .when((chars > 12 * words) | (chars < 2 * words), -1)
        .when((chars <= 10 * words) & (chars >= 3 * words), 1)
        .otherwise(0),
    }


RULES = ("symbols", "repeats", "lines", "capitals", "shouting", "letters", "word_length")


@dataclass(frozen=True)
class LabelModel:
    """Log odds of the classes before any vote, and of each rule's votes."""

    prior: float
    votes: dict[str, dict[int, float]]

    def posterior(self) -> Column:
        """Probability of being good, from the ``stats`` column."""
        odds = F.lit(self.prior)
        for name, vote in rule_votes().items():
            weights = self.votes[name]
            odds = odds + F.when(vote == -1, weights[-1]).when(vote == 1, weights[1]).otherwise(
                weights[0]
            )
        return 1 / (1 + F.exp(-odds))


def fit_patterns(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> LabelModel:
    """Expectation-maximisation over (votes, count) patterns.

    Starts from rules that are right more often than wrong and nine good documents in
    ten. Without patterns the start is the model. That a rule abstains says nothing of
    the class, else the classes would be those with and without many lines. False alarms
    are bounded, else the bad class would be one kind of junk, on which many rules agree,
    and the other kinds would count as good.
    """
    width = len(RULES)
    good = [{-1: MAX_FALSE_ALARMS, 0: 1.0, 1: 1 - MAX_FALSE_ALARMS} for _ in range(width)]
    bad = [{-1: 0.3, 0: 1.0, 1: 0.7} for _ in range(width)]
    share = 0.9
    total = sum(n for _, n in patterns)
    for _ in range(rounds if total else 0):
        seen = {y: [{-1: SMOOTHING, 1: SMOOTHING} for _ in range(width)] for y in (0, 1)}
        mass = {0: SMOOTHING, 1: SMOOTHING}
        for votes, n in patterns:
            odds = log(share / (1 - share)) + sum(
                log(good[r][v] / bad[r][v]) for r, v in enumerate(votes)
            )
            p = 1 / (1 + exp(-max(-500.0, min(500.0, odds))))
            for y, part in ((1, n * p), (0, n * (1 - p))):
                mass[y] += part
                for r, v in enumerate(votes):
                    if v:
                        seen[y][r][v] += part
        good, bad = (
            [{0: 1.0} | {v: c / sum(row.values()) for v, c in row.items()} for row in seen[y]] for y in (1, 0)
        )
        for row in good:
            row[-1] = min(row[-1], MAX_FALSE_ALARMS)
            row[1] = 1 - row[-1]
        share = mass[1] / (mass[0] + mass[1])
    return LabelModel(
        prior=log(share / (1 - share)),
        votes={
            name: {v: log(good[r][v] / bad[r][v]) for v in (-1, 0, 1)}
            for r, name in enumerate(RULES)
        },
    )


def fit_label_model(stats: DataFrame) -> LabelModel:
    """Fit over all rows of ``stats``; the driver gets one row per vote pattern.

    Texts below the base length say little and would train the model on abstentions.
    """
    votes = stats.where(F.col("stats.n_words") >= MIN_WORDS).select(
        *(vote.alias(name) for name, vote in rule_votes().items())
    )
    counted = votes.groupBy(*RULES).count().collect()
    return fit_patterns(sorted((tuple(row[r] for r in RULES), row["count"]) for row in counted))


def base_failed() -> Column:
    """Too few words, or over half of the words repeat."""
    words, repeats = F.col("stats.n_words"), F.col("stats.n_repeat_words")
    return (words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * words)


def kept(model: LabelModel) -> Column:
    """The decision on a row with ``stats``."""
    return ~base_failed() & (model.posterior() >= 0.5)
