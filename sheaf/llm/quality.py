"""Quality rules: a table of thresholds compiled into one projection of length, symbol, stop-word and line ratios.

All measures are DataFrame expressions over a single row; nothing is shuffled, and no Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.text import with_once
from sheaf.llm.common import BLANK, bind, words

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in a is that for it was on with as be at by he his this are or from but not "
    "le la les de des du et un une en que qui dans pour est pas sur au avec "
    "der die das und ein eine ist nicht mit von zu den dem des sich auf "
    "el los las del se y por con para su al lo como es"
).split()
SYMBOLS = "#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """A text passes if ``low <= measure <= high``; an open end is ``None``."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


# Ratios are per word or per line with a word; a rule is skipped where its ratio has no denominator.
DEFAULT_RULES = (
    Rule("too_few_words", "n_words", low=10),
    Rule("odd_word_length", "mean_word_chars", low=1.5, high=30),
    Rule("symbols", "symbol_ratio", high=0.3),
    Rule("no_stop_words", "stop_word_ratio", low=0.01),
    Rule("repeated_lines", "dup_line_ratio", high=0.5),
    Rule("bullet_lines", "bullet_line_ratio", high=0.9),
    Rule("cut_off_lines", "ellipsis_line_ratio", high=0.5),
    Rule("few_letters", "letter_word_ratio", low=0.5),
)


def repeated_words(found: Column, window: int = WINDOW) -> Column:
    """Number of words inside windows of ``window`` words that occur twice or more in the array ``found``.

    Windows are compared by a 64-bit hash over the hashes of their words: sorted, so that equal ones are neighbours;
    the starts of the repeated ones, in order, then cover ``window`` words each, less what the one before covered.
    """

    def starts(hashes: Column) -> Column:
        last = F.size(hashes) - window
        at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        key = lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(window)])
        return F.sort_array(F.transform(at, lambda i: F.struct(key(i).alias("h"), i.alias("i"))))

    def repeated(order: Column) -> Column:
        def twin(x: Column, k: Column) -> Column:
            same = lambda at: F.coalesce(F.get(order, at)["h"] == x["h"], F.lit(False))
            return same(k - 1) | same(k + 1)

        return F.sort_array(F.transform(F.filter(order, twin), lambda x: x["i"]))

    def covered(at: Column) -> Column:
        step = lambda acc, i: F.struct(
            (acc["n"] + window - F.greatest(acc["until"] - i, F.lit(0))).cast("bigint").alias("n"),
            (i + window).alias("until"),
        )
        zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("until"))
        return F.aggregate(at, zero, step, lambda acc: acc["n"])

    hashes = F.transform(found, lambda w: F.xxhash64(w))
    return bind(hashes, lambda h: bind(starts(h), lambda order: covered(repeated(order))))


def measures(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document with its counts and ratios; other columns of ``docs`` are left out.

    A NULL text counts as an empty one. Ratios without a denominator are NULL.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    base = docs.select(F.col(id_column), text.alias("_text"))
    base = with_once(base, "_words", words("_text"))
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    base = with_once(base, "_lines", lines)
    number = lambda column: column.cast("bigint")
    counted = base.select(
        id_column,
        number(F.size("_words")).alias("n_words"),
        number(F.length(F.regexp_replace("_text", BLANK + "+", ""))).alias("word_chars"),
        number(F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).alias("n_symbols"),
        number(F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
        number(F.size("_lines")).alias("n_lines"),
        number(F.size(F.filter("_words", lambda w: F.lower(w).isin(*STOP_WORDS, *[f"{w}." for w in STOP_WORDS])))).alias(
            "n_stop_words"
        ),
        number(F.size(F.filter("_words", lambda w: w.rlike(r"\p{L}")))).alias("n_letter_words"),
        number(F.size(F.filter("_lines", lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*•–]")))).alias("n_bullet_lines"),
        number(F.size(F.filter("_lines", lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$")))).alias("n_ellipsis_lines"),
    )
    per_word = lambda name: F.try_divide(F.col(name).cast("double"), F.col("n_words"))
    per_line = lambda name: F.try_divide(F.col(name).cast("double"), F.col("n_lines"))
    # each count is used several times below
    return with_once(counted, "_c", F.struct(*counted.columns)).select(
        "_c.*",
        per_word("_c.word_chars").alias("mean_word_chars"),
        per_word("_c.n_symbols").alias("symbol_ratio"),
        per_word("_c.n_stop_words").alias("stop_word_ratio"),
        per_word("_c.n_letter_words").alias("letter_word_ratio"),
        per_line("_c.n_dup_lines").alias("dup_line_ratio"),
        per_line("_c.n_bullet_lines").alias("bullet_line_ratio"),
        per_line("_c.n_ellipsis_lines").alias("ellipsis_line_ratio"),
    )


def failed_rules(rules: Sequence[Rule]) -> Column:
    """The threshold table as one expression: the names of the rules that a row of measures breaks, in their order."""

    def broken(rule: Rule) -> Column:
        value = F.col(rule.measure)
        outside = [value < rule.low] if rule.low is not None else []
        outside += [value > rule.high] if rule.high is not None else []
        either = F.lit(False)
        for test in outside:
            either = either | F.coalesce(test, F.lit(False))
        return F.when(either, F.lit(rule.name))

    return F.array_compact(F.array(*[broken(rule) for rule in rules])) if rules else F.array().cast("array<string>")


def quality_rules(
    docs: DataFrame,
    rules: Sequence[Rule] = DEFAULT_RULES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Measures of every document, ``base_failed``, the names of the rules it breaks and ``kept``.

    ``base_failed``: fewer than ten words, or over a fifth of the words in repeated five-word windows. NULL and empty
    texts have no words and fail. Repeated rows are judged one by one and come out as often as they came in. An empty
    table gives an empty result.
    """
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (
        measures(docs, id_column, text_column)
        .withColumn("base_failed", base_failed)
        .withColumn("failed_rules", failed_rules(rules))
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
    )
