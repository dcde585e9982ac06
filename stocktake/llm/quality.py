"""Quality by weak supervision: rules vote good or bad or abstain, expectation-maximisation weighs them.

Features are counted inside each row by built-in functions. Rules turn them into votes. The votes of all documents shrink to
counts of vote patterns, at most 2**rules of them, whatever the table's size; expectation-maximisation on these counts
estimates how each rule votes on good and on bad documents, and Bayes' rule gives a document's probability to be good.

Rules are of two kinds. Precise ones name a gross fault; weak ones name what bad documents often and good ones sometimes have. Their prior accuracies
weigh the votes of the first round only; from then on a rule weighs what its votes tell apart. A weak rule that votes alike on good and bad documents is
overruled, several that are common among the bad ones drop a document together.

Defined results: null and empty texts have no words and fail the base rule; rows are judged one by one, so repeated
ones get equal results; a table without rows gives none; without any fault in the table, all are good.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktake.llm.common import UPPER, let, staged, table, word_list

SYMBOLS = "#*$%&|<>"
WINDOW = 8
GOOD, ABSTAIN, BAD = 1, 0, -1
#: Iterations at most, and the change of a probability at which they end.
ROUNDS, SETTLED = 40, 1e-5
#: How often rules are taken to be right before anything is known of their votes.
PRECISE, WEAK = 0.98, 0.6


def _removed(text: Column, characters: str) -> Column:
    """How many of the characters the text holds."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def repeated_words(words: Column) -> Column:
    """Words inside windows of WINDOW words that occur twice or more: windows are hashed to 64 bits, equal ones become
    neighbours by sorting, and the union of their spans is measured."""

    def measured(hashes: Column) -> Column:
        def spans(found: Column) -> Column:
            size = F.size(found)
            gaps = F.zip_with(
                found, F.concat(F.slice(found, 2, size), F.array(F.element_at(found, -1) + WINDOW)),
                lambda a, b: F.least(b - a, F.lit(WINDOW)),
            )
            return F.when(size == 0, 0).otherwise(F.aggregate(gaps, F.lit(0), lambda x, y: x + y))

        def repeats(ordered: Column) -> Column:
            n = F.size(ordered)
            before = F.concat(F.array(F.lit(None).cast("bigint")), F.transform(F.slice(ordered, 1, n - 1), lambda x: x["h"]))
            after = F.concat(F.transform(F.slice(ordered, 2, n), lambda x: x["h"]), F.array(F.lit(None).cast("bigint")))
            marked = F.zip_with(
                ordered, F.arrays_zip(before.alias("b"), after.alias("a")),
                lambda x, y: F.when(x["h"].eqNullSafe(y["b"]) | x["h"].eqNullSafe(y["a"]), x["i"]),
            )
            return let(F.sort_array(F.filter(marked, lambda i: i.isNotNull())), spans)

        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        # Most texts repeat no window: a set of the hashes tells.
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(let(F.sort_array(placed), repeats))

    starts = F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    return F.when(F.size(words) <= WINDOW, 0).otherwise(let(hashes, measured)).cast("long")


def stutters(words: Column) -> Column:
    """Words equal to the word before them."""
    same = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: a.eqNullSafe(b))
    return F.size(F.filter(same, lambda x: x))


def features(docs: DataFrame) -> DataFrame:
    """doc_id and the counts that the rules use."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    of_lines = let(lines, lambda x: F.struct(
        F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"),
        F.size(F.filter(x, lambda y: y.rlike(r"[.?][\x20\x09-\x0D]*$"))).alias("ended"),
    ))
    of_words = let(word_list(F.col("text")), lambda x: F.struct(F.size(x).alias("n"), repeated_words(x).alias("repeat"), stutters(x).alias("stutters")))
    counted = docs.select(
        "doc_id", of_lines.alias("l"), of_words.alias("w"),
        F.length(text).alias("chars"), _removed(text, " \t\n\x0b\x0c\r").alias("spaces"), _removed(text, SYMBOLS).alias("symbols"), _removed(text, UPPER).alias("upper"), _removed(text, "!").alias("shouts"),
    )
    return counted.select(
        "doc_id", F.col("w.n").cast("long").alias("n_words"), (F.col("chars") - F.col("spaces")).cast("long").alias("word_chars"),
        F.col("symbols").cast("long").alias("n_symbols"), F.col("l.dup").cast("long").alias("n_dup_lines"), F.col("w.repeat").alias("n_repeat_words"),
        F.col("l.n_lines").alias("n_lines"), F.col("l.ended").alias("n_ended"), F.col("upper").alias("n_upper"), F.col("shouts").alias("n_shouts"), F.col("w.stutters").alias("n_stutters"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


def rules() -> dict[str, Column]:
    """Votes by name. Each rule speaks for one class only and otherwise abstains: the lack of a fault proves little. Those in GROSS are precise."""
    words, chars, lines = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1)), F.greatest(F.col("n_lines"), F.lit(1))
    length = chars / words

    def bad(case: Column) -> Column:
        return F.when(case, F.lit(BAD)).otherwise(F.lit(ABSTAIN))

    def good(case: Column) -> Column:
        return F.when(case, F.lit(GOOD)).otherwise(F.lit(ABSTAIN))

    return {
        "symbols": bad(F.col("n_symbols") / words > 0.2),
        "capitals": bad(F.col("n_upper") / chars > 0.3),
        "shouting": bad(F.col("n_shouts") / words > 0.2),
        "copied_lines": bad(F.col("n_dup_lines") / lines > 0.4),
        "copied_windows": bad(F.col("n_repeat_words") * 100 > F.col("n_words") * 30),
        "stutter": bad(F.col("n_stutters") / words > 0.3),
        "odd_words": bad((length < 2.5) | (length > 10)),
        "sentences": good(F.col("n_ended") / lines >= 0.66),
        "all_new": good((F.col("n_dup_lines") == 0) & (F.col("n_repeat_words") == 0)),
        "size": good(F.col("n_words") > 60),
        "some_symbols": bad(F.col("n_symbols") / words > 0.02),
        "some_capitals": bad(F.col("n_upper") / chars > 0.08),
        "few_lines": bad(lines < 2),
        "few_sentences": bad(F.col("n_ended") / lines < 0.5),
        "brief": bad(words < 60),
        "long_words": bad(length > 6.5),
    }


#: The precise rules.
GROSS = ("symbols", "capitals", "shouting", "copied_lines", "copied_windows", "stutter", "odd_words")
VOTES = (BAD, ABSTAIN, GOOD)


def posterior(names: list[str], prior: list[float], chances: list[dict[str, dict[int, float]]]) -> Column:
    """Probability of the first class, the good one, by Bayes' rule. chances[class][rule][vote] = P(vote | class)."""
    odds = F.lit(1.0)
    for share, chance in zip(prior[1:], chances[1:], strict=True):
        logit = F.lit(math.log(share / prior[0]))
        for x in names:
            logit = logit + F.element_at(F.array(*[F.lit(math.log(chance[x][v] / chances[0][x][v])) for v in VOTES]), F.col(x) + 2)
        odds = odds + F.exp(logit)
    return F.lit(1.0) / odds


def fit(
    patterns: list[tuple[tuple[int, ...], int]], names: list[str], accuracy: dict[str, float] | None = None
) -> tuple[list[float], list[dict[str, dict[int, float]]]]:
    """Expectation-maximisation on counted vote patterns, at most 2**rules of them.

    The first belief in a document weighs each vote by its rule's prior accuracy (WEAK unless given). Then, in turn, the chances of each
    rule's votes are estimated in both classes, and the beliefs from them. Returns the shares of good and bad documents and the
    chances of each vote in both; the good class alone if no rule found a fault.
    """
    if not any(BAD in votes for votes, _ in patterns):
        return [1.0], [{x: dict.fromkeys(VOTES, 1 / 3) for x in names}]
    accuracy = accuracy or {}
    weights = [math.log(a / (1 - a)) for a in (accuracy.get(x, WEAK) for x in names)]
    belief = [1 / (1 + math.exp(-sum(w * v for w, v in zip(weights, votes, strict=True)))) for votes, _ in patterns]
    total = sum(n for _, n in patterns)
    for _ in range(ROUNDS):
        good = sum(n * p for (_, n), p in zip(patterns, belief, strict=True))
        weight = [good, total - good]
        prior = [(w + 1) / (total + 2) for w in weight]
        chances = [{}, {}]
        for k, x in enumerate(names):
            for c in (0, 1):
                seen = dict.fromkeys(VOTES, 0.0)
                for (votes, n), p in zip(patterns, belief, strict=True):
                    seen[votes[k]] += n * (1 - p if c else p)
                chances[c][x] = {v: (seen[v] + 0.1) / (weight[c] + 0.3) for v in VOTES}
        moved, now = 0.0, []
        for (votes, _), old in zip(patterns, belief, strict=True):
            logit = math.log(prior[0] / prior[1]) + sum(math.log(chances[0][x][v] / chances[1][x][v]) for x, v in zip(names, votes, strict=True))
            now.append(1 / (1 + math.exp(-max(-700.0, min(700.0, logit)))))
            moved = max(moved, abs(now[-1] - old))
        belief = now
        if moved < SETTLED:
            break
    return prior, chances


def judge(docs: DataFrame) -> DataFrame:
    """Counts, base verdict, votes, quality (probability) and kept for each document."""
    names = list(rules())
    voted = staged(features(docs).withColumns(rules()), "quality")
    # At most 2**rules rows, however many documents.
    counted = voted.groupBy(*names).agg(F.count("*").alias("n")).orderBy(*names).collect()
    prior, chances = fit([(tuple(r[x] for x in names), r["n"]) for r in counted], names, dict.fromkeys(GROSS, PRECISE))
    scored = voted.withColumn("quality", posterior(names, prior, chances)).withColumn("base_failed", base_failed())
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge all documents."""
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )
