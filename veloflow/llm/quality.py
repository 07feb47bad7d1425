"""Quality rules as a short-circuit cascade, all in Spark SQL expressions.

Every rule is a pair of expressions over the text: what it needs and whether it rejects. Cost and selectivity of each rule
are measured on a bounded sample; the rules are then tried in the order of rejections per cost, and a document that a rule
rejects is not looked at by later rules. The order changes the time only: the verdict is "no rule rejects".
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 5
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
#: Rows on which cost and selectivity are measured.
SAMPLE_ROWS = 400


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once for each row: a one-element array binds it to a lambda's variable."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def whole(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def without(text: Column, chars: str, instead: str = "") -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(instead))
    return text


def words_of(text: Column) -> Column:
    """Array of words; a null text has none."""
    return F.array_remove(F.split(without(whole(text), SPACES[1:], " "), " "), F.lit(""))


def word_chars(text: Column) -> Column:
    """Code points within words: the length without white space."""
    return F.length(without(whole(text), SPACES)).cast("long")


def n_symbols(text: Column) -> Column:
    return (F.length(whole(text)) - F.length(without(whole(text), SYMBOLS))).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that are equal to an earlier line."""
    with_word = lambda x: F.length(F.translate(x, SPACES, "")) > 0
    return once(F.filter(F.split(whole(text), "\n"), with_word), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows of ``window`` words that occur twice or more, the first one included.

    Windows are compared by a 64-bit hash. Where all hashes of a text differ, nothing repeats. Else sorting (hash, position)
    brings equal windows together; the positions of those with an equal neighbour are sorted again, and each covers what
    the next one leaves of its words. No window is compared with every other one, so a text of any length takes n log n steps.
    """
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def windows(hs: Column) -> Column:
        at = lambda i, k: F.get(hs, i + F.lit(k) if k else i)
        starts = F.when(F.size(hs) >= window, F.sequence(F.lit(0), F.size(hs) - window)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(*[at(i, k) for k in range(window)]))

    def repeated(s: Column) -> Column:
        h = lambda j: F.get(s, j)["h"]
        twins = F.filter(s, lambda x, i: F.coalesce(h(i + F.lit(1)) == x["h"], F.lit(False)) | F.coalesce(h(i - F.lit(1)) == x["h"], F.lit(False)))
        return F.sort_array(F.transform(twins, lambda x: x["p"]))

    def covered(q: Column) -> Column:
        gaps = F.transform(q, lambda x, i: F.least(F.lit(window), F.coalesce(F.get(q, i + F.lit(1)) - x, F.lit(window))))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    placed = lambda hw: F.sort_array(F.transform(hw, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    counted = lambda hw: F.when(F.size(F.array_distinct(hw)) == F.size(hw), F.lit(0)).otherwise(once(placed(hw), lambda s: once(repeated(s), covered)))
    return once(hashes, lambda hs: once(windows(hs), counted)).cast("long")


def n_stutter(words: Column) -> Column:
    """Words equal to the word before."""
    return F.size(F.filter(words, lambda x, i: F.coalesce(F.get(words, i - F.lit(1)) == x, F.lit(False)))).cast("long")


@dataclass(frozen=True)
class Rule:
    """A rule rejects where ``rejects`` is true. It gets a function that gives a measure's expression by name; never null."""

    name: str
    rejects: Callable[[Callable[[str], Column]], Column]


#: Measures of the whole text, and of its words.
OF_TEXT = {f.__name__: f for f in (word_chars, n_symbols, n_dup_lines)}
OF_WORDS = {"n_words": lambda words: F.size(words).cast("long"), "n_repeat_words": n_repeat_words, "n_stutter": n_stutter}

#: The base of the contract: too short, or mostly repeated.
BASE_RULES = (
    Rule("too_few_words", lambda m: m("n_words") < 10),
    Rule("repeated_windows", lambda m: m("n_repeat_words") * 100 > m("n_words") * 20),
)
#: Rules beyond the base; each leaves a wide margin to ordinary prose.
EXTRA_RULES = (
    Rule("symbol_heavy", lambda m: m("n_symbols") * 10 > m("n_words")),
    Rule("duplicate_words", lambda m: m("n_stutter") * 10 > m("n_words") * 3),
    Rule("duplicate_lines", lambda m: (m("n_dup_lines") > 2) & (m("n_dup_lines") * 5 > m("n_words"))),
    Rule("word_length", lambda m: (m("word_chars") > m("n_words") * 15) | (m("word_chars") < m("n_words") * 2)),
)
RULES = BASE_RULES + EXTRA_RULES


def rejected(rules: list[Rule], text: Column) -> Column:
    """True as soon as one rule rejects; later rules are not evaluated then. The words are split once."""

    def tried(words: Column) -> Column:
        measures = lambda name: OF_WORDS[name](words) if name in OF_WORDS else OF_TEXT[name](text)
        return chained(rules, measures)

    return once(words_of(text), tried)


def chained(rules: list[Rule], measures: Callable[[str], Column]) -> Column:
    verdict = F.lit(False)
    for rule in reversed(rules):
        verdict = F.when(rule.rejects(measures), F.lit(True)).otherwise(verdict)
    return verdict


def measure(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, int]]:
    """(rule, seconds, rejections) on at most ``rows`` rows; each rule is one aggregate over the sample.

    The sample's size is a fixed parameter: it sets the order of the rules and nothing else.
    """
    sample = docs.select(F.col(text).alias("text")).limit(rows).persist()
    try:
        sample.count()
        found = []
        for rule in rules:
            begun = time.perf_counter()
            n = sample.agg(F.count_if(rejected([rule], F.col("text"))).alias("n")).first()["n"]
            found.append((rule, time.perf_counter() - begun, int(n)))
        return found
    finally:
        sample.unpersist()


def cascade(measured: list[tuple[Rule, float, int]]) -> list[Rule]:
    """Rules by rejections per cost, most first; ties by the order given."""
    return [rule for rule, _, _ in sorted(measured, key=lambda m: -(m[2] + 0.5) / max(m[1], 1e-9))]


def quality_report(docs: DataFrame, order: list[Rule] | None = None) -> DataFrame:
    """Base counts and the verdict of each document.

    Columns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed, kept (boolean), one row
    per input row, repeated rows included. Null and empty texts have no words and fail the base. Other columns are ignored.
    ``order`` holds the rules beyond the base in the order to try them; by default they are ordered on a sample. They read
    the counts that are there anyway, and are not tried on what failed the base.
    """
    tried = cascade(measure(docs, EXTRA_RULES)) if order is None else order
    text = F.col("text")
    of_words = once(words_of(text), lambda ws: F.struct(*(f(ws).alias(name) for name, f in OF_WORDS.items())))
    counted = docs.select("doc_id", of_words.alias("w"), *(f(text).alias(name) for name, f in OF_TEXT.items()))
    at_hand = lambda name: F.col(f"w.{name}") if name in OF_WORDS else F.col(name)
    failed = chained(list(BASE_RULES), at_hand)
    kept = F.when(failed, F.lit(False)).otherwise(~chained(tried, at_hand))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return counted.select("doc_id", *(at_hand(name).alias(name) for name in base), failed.alias("base_failed"), kept.alias("kept"))


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, order: list[Rule] | None = None) -> DataFrame:
    """Rows that no rule rejects, with all their columns; the rules run as a cascade ordered on a sample.

    Null and empty texts go; repeated rows stay repeated; columns other than ``text`` may have any name.
    """
    tried = cascade(measure(docs, rules)) if order is None else order
    return docs.filter(~rejected(tried, F.col("text")))
