"""Quality by weak supervision: rules vote or abstain, EM weighs them.

Whole-text counts are computed in each row with built-in functions. Rules turn
them into votes (1 good, 0 bad, null: abstains). Texts with the same votes are
one pattern; there are at most 3 ** rules patterns, and expectation
maximisation runs over their counts: the E-step and the sums of the M-step are
one Spark aggregate per round over that small table, and only the sums reach
the driver. A text is kept if its posterior probability of being good is high
enough, so one failed rule does not reject it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratewise.functions.once import with_once
from cratewise.llm.stores import written

# Fixed values of the counts: white space and symbols.
_WORD = r"[^\x20\x09-\x0D]"
_SYMBOLS = "[#*$%&|<>]"
# A word from its first ASCII digit or unusual sign on.
_ODD = r"[\x21-\x26\x28-\x2B\x2F-\x39\x3C-\x3E\x40\x5B-\x60\x7B-\x7E][^\x20\x09-\x0D]*+"
# Up to so many repeated windows are looked up one by one.
FEW = 32
_SPLIT = r"[\x20\x09-\x0D]+"


def text_counts(docs: DataFrame) -> DataFrame:
    """Counts of each whole text: ``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``, and what the rules need besides
    (``n_lines``, ``n_ended`` lines, ``n_upper`` letters, ``n_distinct`` and ``n_odd`` words)."""
    long = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # Each step keeps only what later ones need: a text's arrays are several times its size.
    df = with_once(df, lines=F.filter(F.split("text", "\n", -1), lambda x: x.rlike(_WORD)))
    ended = F.size(F.filter("lines", lambda x: F.rtrim(x).rlike(r"[.!?:;\"”»]$")))
    df = df.select(
        "doc_id", "text", F.inline(F.array(F.struct(
            long(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"), long(F.size("lines")).alias("n_lines"),
            long(ended).alias("n_ended"), long(F.regexp_count("text", F.lit(_SYMBOLS))).alias("n_symbols"),
            long(F.regexp_count("text", F.lit("[A-Z]"))).alias("n_upper"), long(F.regexp_count("text", F.lit(_ODD))).alias("n_odd"),
            F.array_remove(F.split("text", _SPLIT, -1), "").alias("words"),
        ))),
    ).drop("text")
    scalars = ["doc_id", "n_dup_lines", "n_lines", "n_ended", "n_symbols", "n_upper", "n_odd"]
    # Hash of every three-word window; those that occur twice, and the places where they do.
    grams = F.expr("transform(sequence(0, size(words) - 3), i -> xxhash64(get(words, i), get(words, i + 1), get(words, i + 2)))")
    df = df.select(*scalars, F.inline(F.array(F.struct(
        long(F.size("words")).alias("n_words"), long(F.length(F.array_join("words", ""))).alias("word_chars"),
        long(F.size(F.array_distinct("words"))).alias("n_distinct"),
        F.when(F.size("words") >= 3, grams).otherwise(F.expr("cast(array() as array<bigint>)")).alias("grams"),
    ))))
    df = with_once(df, sorted=F.when(F.size(F.array_distinct("grams")) < F.size("grams"), F.sort_array("grams")))
    df = with_once(df, double=F.expr("array_distinct(filter(sorted, (g, i) -> i > 0 and get(sorted, i - 1) = g))")).drop("sorted")
    # Few such windows: look each one up. Many: sort windows with their places, equal ones are neighbours.
    spots = F.expr("array_sort(transform(grams, (g, i) -> struct(g, i)))")
    df = with_once(df, spots=F.when(F.size("double") > FEW, spots))
    few = "filter(transform(grams, (g, i) -> if(array_contains(double, g), i, null)), p -> p is not null)"
    many = """filter(transform(spots, (s, i) -> if(coalesce(get(spots, i - 1).g = s.g, false) or coalesce(get(spots, i + 1).g = s.g, false), s.i, null)),
        p -> p is not null)"""
    df = with_once(df, twice=F.when(F.col("spots").isNotNull(), F.expr(many)).when(F.col("double").isNotNull(), F.expr(few)))
    covered = F.size(F.array_distinct(F.flatten(F.array("twice", F.transform("twice", lambda p: p + 1), F.transform("twice", lambda p: p + 2)))))
    return df.select(*scalars, "n_words", "word_chars", "n_distinct", long(F.when(F.col("twice").isNotNull(), covered)).alias("n_repeat_words"))


def rules() -> dict[str, Column]:
    """Votes of the rules on the counts of a text: 1 good, 0 bad, null abstains.
    Rules that look for one kind of junk do not praise a text that lacks it."""
    n, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    mean, symbols = F.col("word_chars") / n, F.col("n_symbols") / n
    repeated, double = F.col("n_repeat_words") / n, F.col("n_dup_lines") / lines
    ended, upper, distinct = F.col("n_ended") / lines, F.col("n_upper") / F.greatest("word_chars", F.lit(1)), F.col("n_distinct") / n
    plain = 1 - F.col("n_odd") / n

    def vote(bad: Column, good: Column | None = None) -> Column:
        return F.when(bad, 0) if good is None else F.when(bad, 0).when(good, 1)

    return {
        "length": vote(F.col("n_words") < 20, F.col("n_words") >= 60),
        "word_length": vote(~mean.between(2.5, 12), mean.between(3.5, 8)),
        "symbols": vote(symbols > 0.1),
        "repetition": vote(repeated > 0.3),
        "double_lines": vote(double > 0.3),
        "line_ends": vote(ended < 0.3, ended > 0.7),
        "upper_case": vote(upper > 0.3),
        "variety": vote(distinct < 0.15, distinct > 0.3),
        "plain_words": vote(plain < 0.7, plain > 0.9),
    }


@dataclass
class VoteModel:
    """Share of good texts and, per rule, the probability of voting bad, good or not
    at all (0, 1, 2) given a good and given a bad text."""

    good: float
    votes: dict[str, dict[int, tuple[float, float]]]

    def log_odds(self) -> Column:
        """Log odds of good for the vote columns of a row."""
        total = F.lit(math.log(self.good) - math.log(1 - self.good))
        for name, by in self.votes.items():
            odds = {vote: math.log(p) - math.log(q) for vote, (p, q) in by.items()}
            total = total + F.when(F.col(name) == 0, odds[0]).when(F.col(name) == 1, odds[1]).otherwise(odds[2])
        return total

    def posterior(self) -> Column:
        return 1 / (1 + F.exp(-self.log_odds()))


def fit_votes(patterns: DataFrame, names: list[str], rounds: int = 25, good: float = 0.85) -> VoteModel:
    """Estimate the rules' accuracies from counted vote patterns (columns ``names`` and ``n``).

    Starts from rules that seldom blame a good text (0.5 %) and catch a third of
    the bad ones. Each outcome is smoothed by one text. No patterns: the start.
    """
    start = {0: (0.005, 0.3), 1: (0.6, 0.5), 2: (0.395, 0.2)}
    model = VoteModel(good, {name: start for name in names})
    for _ in range(rounds):
        scored = patterns.select("n", *names, (F.col("n") * model.posterior()).alias("g"))
        sums = [F.sum("n").alias("all"), F.sum("g").alias("good")]
        for name in names:
            for vote in (0, 1):
                mine = F.col(name) == vote
                sums += [F.sum(F.when(mine, F.col("g"))).alias(f"g_{name}_{vote}"), F.sum(F.when(mine, F.col("n") - F.col("g"))).alias(f"b_{name}_{vote}")]
        row = scored.agg(*sums).first()
        if not row["all"]:
            break
        votes = {}
        for name in names:
            found = {}
            for side, total in (("g", row["good"]), ("b", row["all"] - row["good"])):
                counts = [row[f"{side}_{name}_{v}"] or 0.0 for v in (0, 1)]
                counts.append(max(total - sum(counts), 0.0))
                found[side] = [(1 + c) / (3 + sum(counts)) for c in counts]
            votes[name] = {v: (found["g"][v], found["b"][v]) for v in (0, 1, 2)}
        share = (row["good"] + 1) / (row["all"] + 2)
        change = abs(share - model.good)
        model = VoteModel(share, votes)
        if change < 1e-5:
            break
    return model


def quality(docs: DataFrame, keep: float = 0.5) -> DataFrame:
    """Counts, votes and verdict of each whole text.

    Returns one row per row of ``docs``: ``doc_id``, ``n_words``, ``word_chars``,
    ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed`` (fewer than
    50 words, or more than half of them in repeated three-word windows), ``kept``
    (not base_failed, and posterior at least ``keep``), ``good`` (the posterior)
    and one vote column per rule. A null or empty text has no words and fails.
    Repeated rows get equal results; an empty table gives no rows; columns other
    than ``doc_id`` and ``text`` are ignored.
    """
    counts = written(text_counts(docs), "counts")
    votes = {f"vote_{name}": vote.cast("int") for name, vote in rules().items()}
    voted = counts.select("*", *[vote.alias(name) for name, vote in votes.items()])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    patterns = written(voted.groupBy(*votes).agg(F.count("*").alias("n")), "patterns")
    model = fit_votes(patterns, list(votes))
    return voted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (model.posterior() >= keep)).alias("kept"), F.round(model.posterior(), 6).alias("good"), *votes,
    )
