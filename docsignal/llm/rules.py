"""Quality by weak supervision: rules vote or abstain, and a label model weighs their votes.

Every rule looks at one signal of a whole text and votes +1 (keep), -1 (drop) or 0 (abstain).  The
label model has two classes; given the class, rules vote independently, each with its own
probabilities of the three votes.  Expectation-maximisation estimates these and the share of good
texts from the vote patterns of all documents alone, without labels.  Rules that look for one defect
abstain where it is absent; rules that see signs of prose vote both ways and can outvote a defect.
A text is kept when its posterior probability of being good is at least the threshold.

Everything is DataFrame expressions.  Texts are read once; the signals and votes, a few numbers a
document, are written out, and each step of the estimation is one aggregate over the counts of
distinct vote patterns (at most 3 ** rules of them).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from docsignal.llm.common import materialize

# Frequent function words of the languages that the rules know.
FUNCTION_WORDS = (
    "the of and to in is that for with was der die das und in den von zu mit ist"
    " le la les de des et un une en que el los las por con del para"
).split()
WORD_BREAK = r"[ \t\n\x0B\f\r]+"
SYMBOLS = r"[#*$%&|<>]"
BASE_WORDS, BASE_REPEAT_PERCENT = 50, 50


@dataclass(frozen=True)
class Rule:
    """Votes drop where ``drop`` holds, keep where ``keep`` holds, else abstains (also on NULL)."""

    name: str
    keep: str
    drop: str

    def vote(self) -> Column:
        return F.expr(f"case when {self.drop} then -1 when {self.keep} then 1 else 0 end")


RULES = (
    Rule("symbols", "false", "n_symbols > 0.1 * n_words"),
    Rule("repeats", "n_words >= 50 and n_repeat_words <= 0.02 * n_words", "n_repeat_words > 0.3 * n_words"),
    Rule("lines", "false", "n_lines >= 4 and n_dup_lines > 0.3 * n_lines"),
    Rule(
        "word_length",
        "word_chars between 4 * n_words and 6.5 * n_words",
        "word_chars < 3 * n_words or word_chars > 10 * n_words",
    ),
    Rule("capitals", "false", "n_capitals > 0.3 * word_chars"),
    Rule(
        "function_words",
        "n_function >= 0.06 * n_words",
        "n_words >= 50 and n_function < 0.01 * n_words",
    ),
    Rule("shouting", "false", "n_shouts > 0.1 * n_words"),
    Rule("endings", "n_ended >= 0.9 * n_lines", "n_lines >= 2 and n_ended < 0.4 * n_lines"),
)
#: Before the first step a drop vote makes a text bad with this probability, each one anew.
DOUBT = 0.6


def signals(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key and the counts of every whole text that the rules look at (NULL counts as empty).

    Steps stand in columns of their own, so that no array is computed twice.
    """
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.coalesce(text, F.lit("")).alias("t"))
    rows = rows.withColumns(
        {
            "words": F.array_remove(F.split("t", WORD_BREAK), ""),
            "lines": F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]")),
        }
    )
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    rows = rows.withColumn(
        "windows",
        F.transform(
            F.slice("words", F.lit(1), F.greatest(F.lit(0), F.size("words") - 2)),
            lambda w, i: F.concat_ws(" ", w, F.get("words", i + 1), F.get("words", i + 2)),
        ),
    )
    # Positions matter only where some window comes twice; those texts are sorted by window.
    placed = F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    repeated = F.size(F.array_distinct("windows")) < F.size("windows")
    rows = rows.withColumn("sorted", F.when(repeated, F.sort_array(placed)))
    again = F.filter(
        "sorted",
        lambda x, i: F.coalesce(
            (x["w"] == F.get("sorted", i - 1)["w"]), F.lit(False)
        ) | F.coalesce((x["w"] == F.get("sorted", i + 1)["w"]), F.lit(False)),
    )
    rows = rows.withColumn("at", F.sort_array(F.transform(again, lambda x: x["i"])))
    covered = F.transform("at", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("at", i + 1) - p, F.lit(3))))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    known = F.array(*(F.lit(w) for w in dict.fromkeys(FUNCTION_WORDS)))
    return rows.select(
        "doc_id",
        "n_words",
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(total, F.lit(0).cast("long")).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.regexp_count("t", F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        F.regexp_count("t", F.lit("!")).cast("long").alias("n_shouts"),
        F.size(F.filter("lines", lambda x: x.rlike(r"[.!?…\"')\]]\s*$"))).cast("long").alias("n_ended"),
        F.size(F.filter("words", lambda w: F.array_contains(known, F.lower(w))))
        .cast("long")
        .alias("n_function"),
    )


@dataclass
class LabelModel:
    """Share of good texts, and for each class and rule the probabilities of votes -1, 0, +1."""

    rules: list[str]
    good: float = 0.5
    votes: dict[int, list[list[float]]] = field(default_factory=dict)
    steps: int = 0
    converged: bool = False

    def posterior(self) -> Column:
        """The probability of being good as an expression over the vote columns."""
        logit = F.lit(math.log(self.good / (1 - self.good)))
        for n, rule in enumerate(self.rules):
            weights = [
                math.log(a / b) for a, b in zip(self.votes[1][n], self.votes[0][n], strict=True)
            ]
            logit = logit + F.get(F.array(*map(F.lit, weights)), F.col(f"v_{rule}") + 1)
        return 1 / (1 + F.exp(-logit))

    def accuracy(self) -> dict[str, float]:
        """How often each rule votes rightly when it votes, by the model."""
        out = {}
        for n, rule in enumerate(self.rules):
            good, bad = self.votes[1][n], self.votes[0][n]
            right = self.good * good[2] + (1 - self.good) * bad[0]
            wrong = self.good * good[0] + (1 - self.good) * bad[2]
            out[rule] = right / (right + wrong) if right + wrong else math.nan
        return out


def fit(patterns: DataFrame, rules: list[str], max_steps: int = 50, tolerance: float = 1e-4) -> LabelModel:
    """Expectation-maximisation over ``(v_rule ..., n)``: vote patterns and how many texts show them.

    Estimation starts between majority and all-must-pass: each drop vote alone makes a text bad with
    probability ``DOUBT``.  Kinds of junk exclude each other, so from a majority start the bad class
    would settle on the most frequent kind.  Counts are smoothed by one vote of each kind, so no
    probability is 0.  An empty table leaves the model at an even share.
    """
    model = LabelModel(rules)
    drops = sum((F.when(F.col(f"v_{r}") < 0, 1).otherwise(0) for r in rules), F.lit(0))
    responsibility = F.pow(F.lit(1 - DOUBT), drops)
    while model.steps < max_steps:
        good = F.col("n") * F.col("p")
        sums = [F.sum("n").alias("n"), F.sum(good).alias("good")]
        for r in rules:
            for v in (-1, 0, 1):
                hit = F.col(f"v_{r}") == v
                sums.append(F.sum(F.when(hit, F.col("n"))).alias(f"n_{r}_{v}"))
                sums.append(F.sum(F.when(hit, good)).alias(f"good_{r}_{v}"))
        found = patterns.withColumn("p", responsibility).agg(*sums).first().asDict()
        count, share = found["n"] or 0, found["good"] or 0.0
        before = model.good, model.votes
        model.good = (share + 1) / (count + 2)
        model.votes = {1: [], 0: []}
        for r in rules:
            one = [(found[f"good_{r}_{v}"] or 0.0) for v in (-1, 0, 1)]
            both = [(found[f"n_{r}_{v}"] or 0) for v in (-1, 0, 1)]
            model.votes[1].append([(x + 1) / (share + 3) for x in one])
            model.votes[0].append([(b - x + 1) / (count - share + 3) for x, b in zip(one, both)])
        model.steps += 1
        if before[1] and _change(before, (model.good, model.votes)) < tolerance:
            model.converged = True
            break
        responsibility = model.posterior()
    return model


def _change(a: tuple, b: tuple) -> float:
    return max(
        abs(a[0] - b[0]),
        *(abs(x - y) for c in (0, 1) for r, s in zip(a[1][c], b[1][c]) for x, y in zip(r, s)),
    )


def judge(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    threshold: float = 0.5,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Signals, votes, posterior and verdict of every row.

    ``base_failed`` (fewer than 50 words, or more than half of them in repeated windows) drops a
    text whatever the votes; all texts take part in the estimation.

    NULL and empty texts have no words, fail the base and still vote.  NULL keys and repeated rows
    are kept as they come.  Other columns are ignored; an empty table gives no rows.
    """
    names = [r.name for r in rules]
    votes = {f"v_{r.name}": r.vote() for r in rules}
    base = (F.col("n_words") < BASE_WORDS) | (
        100 * F.col("n_repeat_words") > BASE_REPEAT_PERCENT * F.col("n_words")
    )
    voted = signals(docs, key, text).withColumns(votes).withColumn("base_failed", base)
    voted = materialize(voted, "rules-votes")
    patterns = voted.groupBy(*votes).agg(F.count("*").alias("n"))
    model = fit(materialize(patterns, "rules-patterns"), names)
    return voted.withColumn("posterior", model.posterior()).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= threshold)
    )
