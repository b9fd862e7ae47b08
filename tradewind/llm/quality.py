"""Document quality by weak supervision.

Each rule looks at one statistic of a text and votes good (1), bad (-1) or abstains (0). The
votes are taken to be independent given the unknown quality of a text; expectation
maximisation over the counts of vote patterns estimates how often each rule votes which way on
good and on bad texts, and from that each text's posterior probability of being good.

Everything that touches rows is a Spark expression. The pattern counts, at most 3 ** rules
rows at any number of texts, are the only thing the driver sees.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
# Marks that end a sentence, in Latin and other scripts.
STOPS = "[.!?\u0589\u061F\u06D4\u0964\u0965\u104B\u1362\u1367\u17D4\u1803\u203D\u3002\uFE52\uFF01\uFF0E\uFF1F\uFF61]"
WINDOW = 5


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words inside windows of five words that occur twice or more in the text."""

    def covered(prints: Column) -> Column:
        def counted(ordered: Column) -> Column:
            def repeated(entry: Column, i: Column) -> Column:
                before = F.get(ordered, i - 1)["print"] == entry["print"]
                after = F.get(ordered, i + 1)["print"] == entry["print"]
                return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

            at = F.array_sort(F.transform(F.filter(ordered, repeated), lambda entry: entry["i"]))
            start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

            def add(state: Column, i: Column) -> Column:
                return F.struct(
                    (state["n"] + F.least(F.lit(WINDOW), i + WINDOW - state["end"])).alias("n"),
                    (i + WINDOW).alias("end"),
                )

            return F.aggregate(at, start, add, lambda state: state["n"])

        entries = F.transform(prints, lambda x, i: F.struct(x.alias("print"), i.alias("i")))
        ordered = F.array_sort(entries)
        return F.when(F.size(F.array_distinct(prints)) == F.size(prints), 0).otherwise(_let(ordered, counted))

    prints = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]),
    )
    return F.when(F.size(words) < WINDOW, 0).otherwise(_let(prints, covered))


def statistics(text: Column) -> Column:
    """Counts of one text, as a struct; a null text counts as empty.

    A word is a run of characters other than space and \\t \\n \\v \\f \\r.
    """
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.regexp_replace(line, SPACE, "")) > 0)

    def of_words(words: Column) -> Column:
        doubled = F.aggregate(
            words,
            F.struct(F.lit(0).alias("n"), F.lit("").alias("last")),
            lambda s, w: F.struct((s["n"] + F.when(w == s["last"], 1).otherwise(0)).alias("n"), w.alias("last")),
            lambda s: s["n"],
        )
        return F.struct(
            F.size(words).alias("n_words"),
            _repeat_words(words).alias("n_repeat_words"),
            doubled.alias("n_doubled_words"),
        )

    words = _let(F.array_remove(F.split(text, SPACE + "+"), ""), of_words)

    def of_lines(found: Column) -> Column:
        return F.struct(F.size(found).alias("n"), (F.size(found) - F.size(F.array_distinct(found))).alias("dup"))

    def whole(w: Column) -> Column:
        return _let(
            _let(lines, of_lines),
            lambda l: F.struct(
                w["n_words"].cast("long").alias("n_words"),
                (F.length(text) - F.regexp_count(text, F.lit(SPACE))).cast("long").alias("word_chars"),
                F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                l["dup"].cast("long").alias("n_dup_lines"),
                w["n_repeat_words"].cast("long").alias("n_repeat_words"),
                l["n"].cast("long").alias("n_lines"),
                w["n_doubled_words"].cast("long").alias("n_doubled_words"),
                F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
                F.regexp_count(text, F.lit(STOPS)).cast("long").alias("n_stops"),
                F.regexp_count(text, F.lit("!")).cast("long").alias("n_shouts"),
                F.regexp_count(text, F.lit(r"[^\p{L}\p{M}]")).cast("long").alias("n_other"),
            ),
        )

    return _let(words, whole)


@dataclass(frozen=True)
class Rule:
    """Votes bad or good where the condition holds, and abstains where neither does."""

    name: str
    bad: str
    good: str


# Conditions are SQL over the statistics. All are ratios to the length of the text, and none
# looks at particular words, so that they hold in any language that parts words by spaces.
RULES = (
    Rule("symbols", "n_symbols > 0.1 * n_words", "n_symbols <= 0.02 * n_words"),
    Rule("capitals", "n_upper > 0.4 * word_chars", "n_upper <= 0.15 * word_chars"),
    Rule("repeats", "n_repeat_words > 0.2 * n_words", "n_words >= 10 and n_repeat_words = 0"),
    Rule("lines", "n_lines >= 4 and n_dup_lines >= 0.5 * n_lines", "n_lines >= 2 and n_dup_lines = 0"),
    Rule("word_length", "word_chars < 2.5 * n_words or word_chars > 14 * n_words", "word_chars between 3 * n_words and 10 * n_words"),
    Rule("sentences", "n_words >= 40 and n_stops * 80 < n_words", "n_words >= 10 and n_stops * 40 >= n_words and n_stops * 3 <= n_words"),
    Rule("shouts", "n_shouts > 0.1 * n_words", "n_shouts <= 0.02 * n_words"),
    Rule("letters", "n_other > 0.4 * (n_other + word_chars)", "n_other <= 0.3 * (n_other + word_chars)"),
    Rule("doubles", "n_doubled_words > 0.08 * n_words", "n_words >= 10 and n_doubled_words <= 0.03 * n_words"),
)


def with_votes(docs: DataFrame, inside: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` whose struct column ``inside`` of statistics gets a vote of each rule too."""
    names = docs.schema[inside].dataType.names
    votes = [f"CASE WHEN n_words = 0 THEN 0 WHEN {r.bad} THEN -1 WHEN {r.good} THEN 1 ELSE 0 END AS vote_{r.name}" for r in rules]
    known = re.compile(r"\b(" + "|".join(names) + r")\b")
    struct = ", ".join([f"s.{n} AS {n}" for n in names] + [known.sub(r"s.\1", v) for v in votes])
    return docs.withColumn(inside, F.expr(f"get(transform(array(`{inside}`), s -> struct({struct})), 0)"))


@dataclass(frozen=True)
class Model:
    """prior: share of good texts. good, bad: for each rule that votes, the chance that it votes bad."""

    rules: tuple[str, ...]
    prior: float
    good: tuple[float, ...]
    bad: tuple[float, ...]

    def accuracies(self) -> dict[str, tuple[float, float]]:
        """How often a rule that votes is right on good and on bad texts."""
        return {n: (1 - g, b) for n, g, b in zip(self.rules, self.good, self.bad, strict=True)}

    def log_odds(self, inside: str) -> Column:
        """Of a text being good, over its votes in ``inside``; a rule that abstains says nothing."""
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for name, g, b in zip(self.rules, self.good, self.bad, strict=True):
            vote = F.col(f"{inside}.vote_{name}")
            odds = odds + F.when(vote == -1, math.log(g / b)).when(vote == 1, math.log((1 - g) / (1 - b))).otherwise(0.0)
        return odds

    def posterior(self, inside: str) -> Column:
        return 1 / (1 + F.exp(-self.log_odds(inside)))


# Before any data, a rule that votes calls one of 2000 good texts and one of seven bad texts
# bad, and four of five texts are good. This is worth PSEUDO texts, so that no chance is 0. The
# first chance is also a ceiling: bad texts are of many kinds, each known to one or two rules,
# and without it a frequent kind would pass for a habit of good texts.
FALSE_ALARM = 0.0005
FOUND = 0.15
PRIOR = 0.8
PSEUDO = 10.0


def fit(patterns: Sequence[tuple[tuple[int, ...], int]], rules: Sequence[str], rounds: int = 200) -> Model:
    """Expectation maximisation over counted vote patterns; none gives the starting model."""
    model = Model(tuple(rules), PRIOR, (FALSE_ALARM,) * len(rules), (FOUND,) * len(rules))
    patterns = sorted(patterns)
    total = math.fsum(n for _, n in patterns)
    for _ in range(rounds if patterns else 0):
        good = []  # how many texts of each pattern are good
        for vote, n in patterns:
            odds = math.log(model.prior / (1 - model.prior))
            for v, g, b in zip(vote, model.good, model.bad, strict=True):
                odds += math.log(g / b) if v == -1 else math.log((1 - g) / (1 - b)) if v == 1 else 0.0
            good.append(n / (1 + math.exp(min(-odds, 700))))
        bad = [n - g for g, (_, n) in zip(good, patterns, strict=True)]

        def bad_votes(j: int, texts: list[float], start: float) -> float:
            against = math.fsum(x for x, (vote, _) in zip(texts, patterns, strict=True) if vote[j] == -1)
            either = math.fsum(x for x, (vote, _) in zip(texts, patterns, strict=True) if vote[j])
            return (against + PSEUDO * start) / (either + PSEUDO)

        before, n = model, range(len(rules))
        model = Model(
            model.rules,
            (math.fsum(good) + PSEUDO * PRIOR) / (total + PSEUDO),
            tuple(min(FALSE_ALARM, bad_votes(j, good, FALSE_ALARM)) for j in n),
            tuple(max(FALSE_ALARM, bad_votes(j, bad, FOUND)) for j in n),
        )
        if abs(model.prior - before.prior) < 1e-12:
            break
    return model


def fit_votes(docs: DataFrame, inside: str, rules: Sequence[Rule] = RULES) -> Model:
    """The model of the votes in the struct column ``inside``."""
    names = [r.name for r in rules]
    counts = docs.groupBy(*[F.col(f"{inside}.vote_{n}") for n in names]).count().collect()
    return fit([(tuple(r[:-1]), r[-1]) for r in counts], names)


def base_failed(inside: str) -> Column:
    n_words, repeats = F.col(f"{inside}.n_words"), F.col(f"{inside}.n_repeat_words")
    return (n_words < 10) | (100 * repeats > 20 * n_words)


def verdict(model: Model, inside: str) -> Column:
    """Whether a text stays: it passes the base rules and is more likely good than bad."""
    return ~base_failed(inside) & (model.posterior(inside) >= 0.5)


def scored(docs: DataFrame, ids: Sequence[str], store: Callable[[DataFrame, str], DataFrame]) -> tuple[DataFrame, Model]:
    """The columns ``ids``, statistics, votes, posterior, base_failed and kept of each text.

    ``docs`` has a column ``text``. Texts without words get no votes and fail the base rules.
    Rows stay as they are: repeated ids and null ids are scored like others. ``store`` writes
    a frame to the shared folder and reads it back.
    """
    found = store(with_votes(docs.select(*ids, statistics(F.col("text")).alias("quality")), "quality"), "votes")
    model = fit_votes(found, "quality")
    made = [model.posterior("quality").alias("posterior"), base_failed("quality").alias("base_failed")]
    return found.select(*ids, "quality.*", *made, verdict(model, "quality").alias("kept")), model
