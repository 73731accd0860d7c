"""Quality rules by weak supervision: rules vote or abstain, EM estimates their accuracies.

Each rule votes 1 (good), 0 (bad) or abstains on a document. Documents are pre-aggregated to counts
of vote patterns, at most 3 ** len(RULES) rows however large the corpus is, and only those that occur;
expectation-maximisation runs over those counts and gives, per rule and class, how often it votes each way. The
posterior of a pattern replaces all-must-pass filtering. What the EM starts from, BAD_VOTE and PRIOR_GOOD, says
which class is the good one and weighs as much as WEIGHT documents, so in a corpus the estimates decide.
Everything over documents is built-in Spark functions.

Nulls: a null text has no words and no lines, like an empty one, and fails the base rule. Repeated
rows are judged one by one, equal texts alike; a null doc_id is kept as it is. An empty table gives an empty
result. Columns other than doc_id and text aren't read. Ties of the posterior at the threshold are kept.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, cut, let

BLANKS = " \t\n\x0b\x0c\r"
KEEP_AT = 0.5
ROUNDS = 60
#: A good document gets a bad vote seldom, a bad one breaks some rules only.
BAD_VOTE = {1: 0.01, 0: 0.4}
PRIOR_GOOD, WEIGHT = 0.85, 20
#: No rate is put below this: a rule errs now and then, so one objection among many good votes doesn't decide.
LEAST = 0.01
SYMBOLS = "[#*$%&|<>]"
ENDS = r"[.!?\u2026\u3002\uFF01\uFF1F][\"')\]]*\s*$"


def _window_hashes(words: Column) -> Column:
    last = F.size(words) - 3
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))).otherwise(F.array().cast("array<bigint>"))


def _covered(hashes: Column) -> Column:
    """From the window hashes in order: how many words lie in windows that stand twice or more."""
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = lambda s: F.transform(F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])), lambda x: x["i"])
    start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("end"))
    step = lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i + 3 - a["end"])).alias("n"), (i + 3).alias("end"))
    return F.aggregate(F.sort_array(let(placed, twice)), start, step, lambda a: a["n"])


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that stand twice or more in the text, the first one included."""
    return let(_window_hashes(words), lambda h: F.when(F.size(h) > F.size(F.array_distinct(h)), _covered(h)).otherwise(F.lit(0)))


def features(docs: DataFrame) -> DataFrame:
    """The base counts and what further rules look at."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    count = lambda pattern: F.length("text") - F.length(F.regexp_replace("text", pattern, ""))
    of_words = lambda w: F.struct(F.size(w).alias("n"), F.length(F.array_join(w, "")).alias("chars"), repeated_words(w).alias("repeats"), F.size(F.array_distinct(w)).alias("distinct"))
    such = lambda x, pattern: F.size(F.filter(x, lambda y: F.rlike(y, F.lit(pattern))))
    of_lines = lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("distinct"), such(x, SYMBOLS).alias("marked"), such(x, ENDS).alias("ended"))
    rows = rows.select(
        "doc_id",
        let(F.filter(F.split("text", SPACES), lambda x: x != ""), of_words).alias("w"),
        let(F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != ""), of_lines).alias("l"),
        count(f"{SYMBOLS}+").alias("symbols"),
        count(r"\p{L}+").alias("letters"),
        F.regexp_count("text", F.lit(r"[.!?]+(?=\s|$)")).alias("stops"),
        count("[A-Z]+").alias("upper"),
        count("[!?]+").alias("loud"),
    )
    named = {"n_words": "w.n", "word_chars": "w.chars", "n_symbols": "symbols", "n_repeat_words": "w.repeats", "n_lines": "l.n", "n_distinct": "w.distinct", "n_upper": "upper", "n_loud": "loud", "n_letters": "letters", "n_stops": "stops", "n_marked": "l.marked", "n_ended": "l.ended"}
    out = rows.select("doc_id", (F.col("l.n") - F.col("l.distinct")).cast("long").alias("n_dup_lines"), *(F.col(c).cast("long").alias(k) for k, c in named.items()))
    return out.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _share(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, F.lit(0)).when(good, F.lit(1)).otherwise(F.lit(2))


def rules() -> dict[str, Column]:
    """1: good, 0: bad, 2: abstains. A rule abstains between its two bounds and where it can't tell."""
    n = F.col("n_words")
    return {
        "length": _vote((n >= 80) & (n <= 100_000), n < 30),
        "word_length": _vote(_share("word_chars", "n_words").between(3.0, 9.0), (n > 0) & ((_share("word_chars", "n_words") < 2.0) | (_share("word_chars", "n_words") > 12.0))),
        "symbols": _vote(_share("n_symbols", "n_words") < 0.02, _share("n_symbols", "n_words") > 0.2),
        "marked_lines": _vote((F.col("n_lines") > 0) & (_share("n_marked", "n_lines") < 0.05), _share("n_marked", "n_lines") > 0.2),
        "letters": _vote(_share("n_letters", "word_chars") > 0.92, (n > 0) & (_share("n_letters", "word_chars") < 0.9)),
        "line_ends": _vote((F.col("n_lines") > 0) & (_share("n_ended", "n_lines") > 0.97), (F.col("n_lines") > 0) & (_share("n_ended", "n_lines") < 0.9)),
        "sentences": _vote(_share("n_stops", "n_words") > 0.05, (n >= 50) & (_share("n_stops", "n_words") < 0.02)),
        "repeated_lines": _vote((F.col("n_lines") > 1) & (_share("n_dup_lines", "n_lines") < 0.1), _share("n_dup_lines", "n_lines") > 0.4),
        "repeated_words": _vote((n >= 50) & (_share("n_repeat_words", "n_words") < 0.15), _share("n_repeat_words", "n_words") > 0.5),
        "variety": _vote((n >= 50) & (_share("n_distinct", "n_words") > 0.2), (n >= 50) & (_share("n_distinct", "n_words") < 0.08)),
        "capitals": _vote(_share("n_upper", "word_chars") < 0.12, _share("n_upper", "word_chars") > 0.4),
        "shouting": _vote(_share("n_loud", "n_words") < 0.05, _share("n_loud", "n_words") > 0.3),
    }


def pattern_counts(voted: DataFrame, names: list[str]) -> list[tuple[tuple[int, ...], int]]:
    """How many documents share a vote pattern: at most 3 ** len(names) rows."""
    rows = voted.groupBy(*names).agg(F.count("*").alias("n")).collect()
    return sorted((tuple(r[k] for k in names), r["n"]) for r in rows)


def _class_odds(votes: tuple[int, ...], prior: float, p: list) -> float:
    """log P(votes, good) - log P(votes, bad), rules being independent given the class."""
    return math.log(prior / (1 - prior)) + sum(math.log(p[r][1][v] / p[r][0][v]) for r, v in enumerate(votes))


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, x))))


def estimate(counts: list[tuple[tuple[int, ...], int]], n_rules: int, rounds: int = ROUNDS) -> tuple[float, list]:
    """EM over pattern counts: the share of good documents, and per rule and class the rates of the votes bad, good and none.

    WEIGHT documents that vote by BAD_VOTE are added to those counted, the good ones and the bad ones alike.
    """
    total = sum(n for _, n in counts)
    shown = [sum(n for v, n in counts if v[r] < 2) / max(total, 1) for r in range(n_rules)]
    drawn = [{c: [BAD_VOTE[c] * s, (1 - BAD_VOTE[c]) * s, 1 - s] for c in (0, 1)} for s in (min(max(x, 0.01), 0.99) for x in shown)]
    p, prior = drawn, PRIOR_GOOD
    for _ in range(rounds if total else 0):
        good = WEIGHT * PRIOR_GOOD
        sums = [{c: [WEIGHT * x for x in d[c]] for c in (0, 1)} for d in drawn]
        for votes, n in counts:
            q = _sigmoid(_class_odds(votes, prior, p))
            good += n * q
            for r, v in enumerate(votes):
                sums[r][1][v] += n * q
                sums[r][0][v] += n * (1 - q)
        prior = min(max(good / (total + WEIGHT), 1e-6), 1 - 1e-6)
        p = [{c: _rates(s[c]) for c in (0, 1)} for s in sums]
    return prior, p


def _rates(sums: list[float]) -> list[float]:
    held = [max(x / sum(sums), LEAST) for x in sums]
    return [x / sum(held) for x in held]


def _posterior(names: list[str], prior: float, p: list) -> Column:
    odds = [F.when(F.col(k) == 0, math.log(p[r][1][0] / p[r][0][0])).when(F.col(k) == 1, math.log(p[r][1][1] / p[r][0][1])).otherwise(math.log(p[r][1][2] / p[r][0][2])) for r, k in enumerate(names)]
    return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, odds, F.lit(math.log(prior / (1 - prior))))))


def judge(docs: DataFrame, keep_at: float = KEEP_AT) -> DataFrame:
    """doc_id, the base counts, base_failed, posterior (of being good) and kept."""
    votes = {f"v_{k}": v for k, v in rules().items()}
    voted = cut(features(docs).withColumns(votes))
    names = list(votes)
    prior, p = estimate(pattern_counts(voted, names), len(names))
    out = voted.withColumn("posterior", F.round(_posterior(names, prior, p), 6))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & (F.col("posterior") >= keep_at)).alias("kept"), "posterior")
