"""Quality rules as a short-circuit cascade, in SQL functions only.

Each rule is an expression that is true where a text fails. Rules are branches of one CASE, so a text stops at the first
rule that it fails, and what a rule reads of the text beyond the counts below is read inside its branch: only of texts
that are still open there. On a stored sample, the cost of a rule (its time a text, beside that of a rule that does
nothing) and its selectivity (the share that it rejects) are measured; rules run in falling order of rejections per cost.
The order changes the work, never the verdict.

The counts of words, their characters, symbols, lines, repeated lines and repeated words are results of their own and so
are taken of every text. Rules on counts alone cost next to nothing and come first by their measured cost.

Nulls: a null text has no words and fails the word rule. Empty texts likewise. Repeated rows are judged alone. Extra
columns pass through; an added column gets underscores where a column has its name. An empty table gives no rows (and
rules keep their given order).
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crmweave.llm.frames import free_name, stored

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 5
# Rules are measured on the documents whose hash falls below this share of the hash range, at most SAMPLE_ROWS of them.
SAMPLE_SHARE, SAMPLE_ROWS = 0.02, 2000
# Each text of the sample is judged so often for a time, and the least of so many times counts.
REPEATS, TIMES = 8, 2
LEAST_COST = 1e-7  # seconds a text, below what the clock can tell
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

Counts = Callable[[str], Column]


@dataclass(frozen=True)
class Rule:
    """``fails`` makes the expression from the counts, by their names, and the text."""

    name: str
    fails: Callable[[Counts, Column], Column]


def covered(at: Column, width: int) -> Column:
    """Words under windows of ``width`` that start at the ascending positions of an array."""
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to"))
    return F.aggregate(
        at, none,
        lambda a, p: F.struct(
            (a["n"] + p + width - F.greatest(a["to"], p.cast("long"))).alias("n"), (p + width).cast("long").alias("to")
        ),
        lambda a: a["n"],
    )


def repeated_positions(hashes: Column) -> Column:
    """Ascending positions of the values that occur twice or more in an array."""
    paired = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(s: Column) -> Column:
        return F.filter(
            s, lambda x, k: ((k > 0) & (F.get(s, k - 1)["h"] == x["h"])) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))
        )

    # A lambda variable holds the sorted array, which an expression would sort again for each element.
    return F.sort_array(F.transform(F.flatten(F.transform(F.array(paired), twice)), lambda x: x["i"].cast("long")))


def occurrences(body: Column, others: str) -> Column:
    """Characters of a text outside the runs of ``others``."""
    return F.length(F.regexp_replace(body, others, "")).cast("long")


def names_for(docs: DataFrame) -> dict[str, str]:
    """What the counts are called in the result."""
    return {c: free_name(docs, c) for c in COUNTS}


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """The frame with the counts that every text gets. The text is split once."""
    body = F.coalesce(F.col(text), F.lit(""))
    words, lines, windows = free_name(docs, "__words"), free_name(docs, "__lines"), free_name(docs, "__windows")
    split = docs.withColumn(words, F.filter(F.split(body, SPACE), lambda w: w != "")).withColumn(
        lines, F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    )
    n = F.size(words)
    hashed = split.withColumn(
        windows,
        F.when(
            n >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*(F.get(F.col(words), i + k) for k in range(WINDOW)))
            ),
        ),
    )
    once = F.size(F.array_distinct(windows)) == F.size(windows)
    counts = {
        "n_words": n.cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": occurrences(body, r"[^#*$%&|<>]+"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": F.when(F.coalesce(once, F.lit(True)), F.lit(0).cast("long"))
        .otherwise(covered(repeated_positions(F.col(windows)), WINDOW)),
    }
    names = names_for(docs)
    return hashed.withColumns({names[c]: column for c, column in counts.items()}).drop(words, lines, windows)


def few_words(c: Counts, _body: Column) -> Column:
    return c("n_words") < 10


def repeats(c: Counts, _body: Column) -> Column:
    return 100 * c("n_repeat_words") > 20 * c("n_words")


def rules() -> list[Rule]:
    return [
        Rule("few_words", few_words),
        Rule("repeats", repeats),
        Rule("symbols", lambda c, _: 10 * c("n_symbols") > c("n_words")),
        Rule("capitals", lambda c, body: 2 * occurrences(body, r"\P{Lu}+") > c("word_chars")),
        Rule("shouts", lambda c, body: 2 * occurrences(body, r"[^!]+") > c("n_words")),
        Rule("same_lines", lambda c, _: 2 * c("n_dup_lines") > c("n_lines")),
        Rule("word_length", lambda c, _: (c("word_chars") < 2 * c("n_words")) | (c("word_chars") > 40 * c("n_words"))),
    ]


def ordered(docs: DataFrame, chosen: Sequence[Rule], text: str = "text", share: float = SAMPLE_SHARE) -> list[Rule]:
    """The rules by falling rejections per second, both measured on a sample, which is stored with its counts once.

    One rejection more is counted than was seen, so rules that reject nothing of the sample stand by their cost.
    """
    spread = F.xxhash64(F.col(text)) <= min(int(-(1 << 63) + share * 2**64), (1 << 63) - 1)
    sample = stored(counted(docs.select(F.col(text).alias("text")).filter(spread).limit(SAMPLE_ROWS)), "rules")
    body = F.coalesce(F.col("text"), F.lit(""))
    totals = sample.agg(
        F.count(F.lit(1)).alias("n"), *(F.count_if(r.fails(F.col, body)).alias(f"r{i}") for i, r in enumerate(chosen))
    ).first()
    if not totals["n"]:
        return list(chosen)
    # The number behind a text keeps its repeats apart; every job reads and repeats the sample alike.
    often = sample.withColumn("__again", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))))
    again = F.concat(body, F.col("__again").cast("string"))

    def seconds(fails: Column) -> float:
        taken = []
        for _ in range(TIMES):
            start = time.perf_counter()
            often.agg(F.count_if(fails), F.sum(F.length(again))).collect()
            taken.append(time.perf_counter() - start)
        return min(taken)

    seconds(F.lit(False))  # the first job also compiles
    idle = seconds(F.lit(False))
    gain = []
    for i, rule in enumerate(chosen):
        cost = max((seconds(rule.fails(F.col, again)) - idle) / (REPEATS * totals["n"]), LEAST_COST)
        gain.append((totals[f"r{i}"] + 1) / (totals["n"] + 1) / cost)
    return [r for _, r in sorted(zip(gain, chosen, strict=True), key=lambda x: -x[0])]


def cascade(docs: DataFrame, chosen: Sequence[Rule], text: str = "text") -> DataFrame:
    """The frame with its counts, ``base_failed``, ``failed_rule`` (the first failed of the rules in their order) and
    ``kept`` (neither)."""
    names, body = names_for(docs), F.coalesce(F.col(text), F.lit(""))
    base, failed, kept = (free_name(docs, c) for c in ("base_failed", "failed_rule", "kept"))

    def count(name: str) -> Column:
        return F.col(names[name])

    branches = F.when(F.lit(False), F.lit(None).cast("string"))
    for rule in chosen:
        branches = branches.when(rule.fails(count, body), F.lit(rule.name))
    return (
        counted(docs, text).withColumn(base, few_words(count, body) | repeats(count, body)).withColumn(failed, branches)
        .withColumn(kept, ~F.col(base) & F.col(failed).isNull())
    )


def judged(docs: DataFrame, chosen: Sequence[Rule] | None = None, text: str = "text") -> DataFrame:
    """``cascade`` with the rules in the order that the sample gives."""
    return cascade(docs, ordered(docs, chosen or rules(), text), text)
