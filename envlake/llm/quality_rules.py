"""Quality rules: a threshold table compiled into one projection over built-in functions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envlake.llm.common import BLANK, free_name, let

# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the", "be", "to", "of", "and", "that", "have", "with", "in", "is", "it", "for",
    "der", "die", "das", "und", "nicht", "ein", "mit", "zu", "den", "ist", "des", "von",
    "le", "la", "les", "de", "et", "est", "une", "que", "du", "en", "un", "dans",
    "el", "los", "las", "y", "por", "su", "del", "se", "con", "para", "no", "una",
)
EDGE = ".,;:!?()'\""  # what may stand around a function word
WINDOW = 5  # words of a repeated passage


@dataclass(frozen=True)
class Rule:
    """``low <= measure <= high``; None leaves a side open."""

    measure: str
    low: float | None
    high: float | None


#: What the contract calls the base: a document outside fails whatever else holds.
BASE_RULES = (Rule("n_words", 10, None), Rule("repeat_word_ratio", None, 0.20))

#: The production table.
RULES = (
    Rule("mean_word_length", 2.0, 16.0),
    Rule("symbol_ratio", None, 0.25),
    Rule("stop_word_ratio", 0.02, None),
    Rule("duplicate_line_ratio", None, 0.40),
    Rule("symbol_word_ratio", None, 0.30),
)


COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
    "n_stop_words", "n_symbol_words",
)


def repeated_words(words: Column) -> Column:
    """Number of words inside five-word windows that occur twice or more, the first included.

    Hashes only tell whether any window may repeat; the windows themselves are compared, so
    a clash of hashes changes nothing. Windows are sorted with their place, which is
    n log n for a text of n words.
    """
    last = F.size(words) - WINDOW  # of the first words of windows, counted from 0

    def window(at: Column) -> Column:
        return F.slice(words, at + 1, WINDOW)

    starts = F.sequence(F.lit(0), last)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
    may_repeat = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    ordered = F.sort_array(
        F.transform(starts, lambda i: F.struct(F.array_join(window(i), " ").alias("w"), i.alias("i")))
    )

    def twice(s: Column) -> Column:
        def place(x: Column, k: Column) -> Column:
            same = [F.coalesce(F.get(s, k + d)["w"] == x["w"], F.lit(False)) for d in (-1, 1)]
            return F.when(same[0] | same[1], x["i"])

        return F.sort_array(F.filter(F.transform(s, place), lambda p: p.isNotNull()))

    def covered(places: Column) -> Column:
        step = F.transform(
            places,
            lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW))),
        )
        return F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x)

    exact = let(let(ordered, twice), covered)
    return F.when(last < 1, F.lit(0).cast("long")).when(may_repeat, exact).otherwise(F.lit(0).cast("long"))


def quality_rules(
    docs: DataFrame,
    text: str = "text",
    rules: Sequence[Rule] = RULES,
    base_rules: Sequence[Rule] = BASE_RULES,
    stop_words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """The columns of ``docs`` and a struct ``quality`` of measures, ``base_failed``, ``kept``.

    A null text has no words, so it fails the base; an empty one likewise. Repeated rows each
    get the same verdict, an empty table gives an empty table. Existing columns stay as they
    are; one named ``quality`` makes the new one ``_quality``. No row is dropped: keep those
    whose ``kept`` is true. Nothing is shuffled, and no function of the user runs.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(body, BLANK + "+"), lambda w: w != "")
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    symbols = "#*$%&|<>"

    def counted(w: Column, ln: Column) -> Column:
        counts = {
            "n_words": F.size(w),
            "word_chars": F.char_length(F.regexp_replace(body, BLANK + "+", "")),
            "n_symbols": F.char_length(body) - F.char_length(F.regexp_replace(body, f"[{symbols}]+", "")),
            "n_lines": F.size(ln),
            "n_dup_lines": F.size(ln) - F.size(F.array_distinct(ln)),
            "n_repeat_words": repeated_words(w),
            "n_stop_words": F.size(
                F.filter(w, lambda x: F.btrim(F.lower(x), F.lit(EDGE)).isin(*stop_words))
            ),
            "n_symbol_words": F.size(F.filter(w, lambda x: ~x.rlike("[\\p{L}\\p{N}]"))),
        }
        return F.struct(*[c.cast("long").alias(k) for k, c in counts.items()])

    def judged(q: Column) -> Column:
        def ratio(a: str, b: str) -> Column:
            return F.when(q[b] > 0, q[a] / q[b])

        # one function word is added, so that chance does not decide on texts of a few words
        measures = {
            "n_words": q["n_words"],
            "mean_word_length": ratio("word_chars", "n_words"),
            "symbol_ratio": ratio("n_symbols", "n_words"),
            "stop_word_ratio": F.when(q["n_words"] > 0, (q["n_stop_words"] + 1) / q["n_words"]),
            "symbol_word_ratio": ratio("n_symbol_words", "n_words"),
            "duplicate_line_ratio": ratio("n_dup_lines", "n_lines"),
            "repeat_word_ratio": ratio("n_repeat_words", "n_words"),
        }

        def holds(table: Sequence[Rule]) -> Column:
            ok = F.lit(True)
            for rule in table:
                value = measures[rule.measure]
                for bound in (() if rule.low is None else (value >= rule.low,)) + (
                    () if rule.high is None else (value <= rule.high,)
                ):
                    ok = ok & F.coalesce(bound, F.lit(True))
            return ok

        base_failed = ~holds(base_rules)
        return F.struct(
            *[q[k].alias(k) for k in COUNTS],
            base_failed.alias("base_failed"),
            (~base_failed & holds(rules)).alias("kept"),
        )

    # words and counts are bound inside the expression: a filter on the verdict may be pushed
    # down and then carries the whole expression with it
    quality = let(let(words, lambda w: let(lines, lambda ln: counted(w, ln))), judged)
    return docs.withColumn(free_name(docs.columns, "quality"), quality)
