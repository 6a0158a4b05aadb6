"""Quality rules: a threshold table compiled into one native projection.

Every feature is a Catalyst expression over the whole text; there are no user
functions, no explode and no shuffle, so a document of any length stays inside
its own row and a hot source cannot skew anything.

Defined results
* null or empty text, or only white space: all counts 0, ``base_failed`` true,
  ``kept`` false;
* rows are independent: repeated rows and null ids give one result per row;
* other columns of the input are ignored, whatever their names.

Five-word windows are compared by a 64-bit hash of their words within one
document; two different windows of a document collide with a probability of
about 2**-64 per pair.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

#: Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "a an and are as at be by for from in is it not of on or that the this to was with "
    "das dem den der des die ein eine ist im mit nicht sich und von zu für auf "
    "au avec ce dans de du elle en est et il la le les par pas pour que qui se un une "
    "como con del el las lo los más no por su sus una y"
).split()


@dataclass(frozen=True)
class Rule:
    """``feature`` must lie within [low, high]; an open side is None.

    Texts of fewer than ``min_words`` words are not held against the rule: a
    short text may well hold no function word.
    """

    name: str
    feature: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0


#: The production thresholds.
RULES = (
    Rule("too_few_words", "n_words", low=10),
    Rule("too_many_words", "n_words", high=1_000_000),
    Rule("short_words", "mean_word_chars", low=2.0),
    Rule("long_words", "mean_word_chars", high=20.0),
    Rule("symbols", "symbol_ratio", high=0.3),
    Rule("few_stop_words", "stop_word_ratio", low=0.01, min_words=50),
    Rule("repeated_lines", "dup_line_ratio", high=0.5),
    Rule("upper_case", "upper_ratio", high=0.5),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it any number of times in ``body``.

    A lambda variable is bound to an evaluated value, so nested lambdas don't
    evaluate the expression again for each element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(words: Column) -> Column:
    """Words covered by 5-word windows that occur twice or more in the text."""
    def of_hashes(h: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(h) - 5),
            lambda i: F.struct(F.xxhash64(*[h[i + j] for j in range(5)]).alias("h"), i.alias("i")))
        return let(F.sort_array(windows), _covered)

    def _covered(s: Column) -> Column:
        near = F.transform(s, lambda x, k: F.when(
            ((k > 0) & (F.get(s, k - 1)["h"] == x["h"]))
            | ((k < F.size(s) - 1) & (F.get(s, k + 1)["h"] == x["h"])), x["i"]))
        starts = F.sort_array(F.filter(near, lambda i: i.isNotNull()))
        # a window adds the words past the end of the window before it
        total = F.aggregate(
            starts, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
            lambda acc, i: F.struct(
                (acc["n"] + (i + 5 - F.greatest(i, acc["end"]))).alias("n"), (i + 5).alias("end")))
        return total["n"]

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) >= 5, let(hashes, of_hashes)).otherwise(F.lit(0).cast("long"))


def features(text: Column, words: Column, lines: Column) -> dict[str, Column]:
    """Counts and ratios of a text, its words and its lines with a word in them."""
    n = F.size(words).cast("long")
    per_word = lambda c: c / F.greatest(n, F.lit(1))
    n_chars = F.length(F.translate(text, SPACE_CHARS, "")).cast("long")
    n_symbols = (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")
    n_dup = (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")
    n_stop = F.size(F.filter(words, lambda w: F.lower(F.rtrim(w, F.lit(".,;:!?"))).isin(STOP_WORDS)))
    n_upper = F.size(F.filter(words, lambda w: (F.upper(w) == w) & (F.lower(w) != w) & (F.length(w) > 1)))
    return {
        "n_words": n, "word_chars": n_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup,
        "n_repeat_words": _repeat_words(words),
        "mean_word_chars": per_word(n_chars), "symbol_ratio": per_word(n_symbols),
        "stop_word_ratio": per_word(n_stop), "upper_ratio": per_word(n_upper),
        "dup_line_ratio": n_dup / F.greatest(F.size(lines), F.lit(1)),
    }


def compile_rules(rules: tuple[Rule, ...], feature: Callable[[str], Column]) -> Column:
    """The threshold table as one expression: the names of the rules a row breaks."""
    checks = []
    for r in rules:
        broken = F.lit(False)
        if r.low is not None:
            broken = broken | (feature(r.feature) < F.lit(r.low))
        if r.high is not None:
            broken = broken | (feature(r.feature) > F.lit(r.high))
        if r.min_words:
            broken = broken & (feature("n_words") >= F.lit(r.min_words))
        checks.append(F.when(broken, F.lit(r.name)))
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, *,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, counts, ``base_failed``, ``kept``, ``failed_rules``."""
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))

    def of_text(text: Column) -> Column:
        words = F.filter(F.split(text, SPACE), lambda w: w != "")
        lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACE_CHARS, "") != "")
        return let(words, lambda w: let(lines, lambda ls: F.struct(
            *[c.alias(k) for k, c in features(text, w, ls).items()])))

    f = docs.select(F.col(id_col).alias("doc_id"), let(body, of_text).alias("f"))
    base = (F.col("f.n_words") < 10) | (100 * F.col("f.n_repeat_words") > 20 * F.col("f.n_words"))
    return (f.select("doc_id", "f", base.alias("base_failed"),
                     compile_rules(rules, lambda k: F.col(f"f.{k}")).alias("failed_rules"))
            .select("doc_id", "f.n_words", "f.word_chars", "f.n_symbols", "f.n_dup_lines", "f.n_repeat_words",
                    "base_failed", (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"),
                    F.concat_ws(",", "failed_rules").alias("failed_rules")))
