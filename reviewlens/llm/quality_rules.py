"""Quality rules: a table of thresholds, compiled into one projection of native expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.columns import SPACES, free_names, without, word_array


@dataclass(frozen=True)
class Rule:
    """A document passes when least <= 100 * part <= most * whole/100 ... see ``passes``."""

    name: str
    part: str
    whole: str
    least: int | None = None
    most: int | None = None

    def passes(self) -> Column:
        """Percentages are compared in whole numbers: least * whole <= 100 * part <= most * whole."""
        part, whole = 100 * F.col(self.part), F.col(self.whole)
        ok = F.lit(True)
        if self.least is not None:
            ok = ok & (part >= self.least * whole)
        if self.most is not None:
            ok = ok & (part <= self.most * whole)
        return ok


#: Stop words of four languages, as they stand within and at the start of sentences.
STOP_WORDS = (
    "the of and to in a is that for it was on are as with"
    " der die und das von zu den mit ist auf ein nicht im"
    " le la les des et en un une du est que pour dans"
    " el los las y de que se por con su una para"
).split()
SIGNS = "#*$%&|<>"
BULLETS = ("-", "*", "•")

#: Percentages of one count in another. Words of 2 to 16 characters on average, signs, stop words, words
#: without letters, lines that are bullets, that end with an ellipsis, or that repeat an earlier line.
RULES = (
    Rule("word_length", "word_chars", "n_words", 200, 1600),
    Rule("signs", "n_symbols", "n_words", None, 30),
    Rule("exclamations", "n_exclamations", "n_words", None, 30),
    Rule("stop_words", "n_stop_words", "n_words", 2, None),
    Rule("letters", "n_letter_words", "n_words", 60, None),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", None, 90),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", None, 50),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 60),
)
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RESULT = (*BASE, "n_exclamations", "n_stop_words", "n_letter_words", "n_lines", "n_bullet_lines", "n_ellipsis_lines", "base_failed", "failed_rules", "kept")
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


def _chars_in(text: Column, signs: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, signs, ""))).cast("long")


def _count(array: Column) -> Column:
    return F.size(array).cast("long")


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows that are found twice or more in the text.

    Windows are sorted with their positions, so that equal ones stand together; a position that follows the
    one before by d adds min(3, d) words.
    """
    windows = F.transform(
        F.arrays_zip(words.alias("a"), F.slice(words, 2, F.size(words)).alias("b"), F.slice(words, 3, F.size(words)).alias("c")),
        lambda w, i: F.struct(F.concat(w["a"], F.lit(" "), w["b"], F.lit(" "), w["c"]).alias("window"), i.alias("at")),
    )
    return F.sort_array(F.filter(windows, lambda w: w["window"].isNotNull()))


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts of ``RESULT``, ``base_failed``, the names of ``failed_rules`` and ``kept``.

    The base fails a text with fewer than 50 words, or with more than half of its words in repeated windows.
    A text is kept when the base and all rules pass. Null text has no words and fails the base, as an empty
    one does. Every row is judged alone, from its whole text. Columns of the same names are replaced. An empty
    table gives an empty result.
    """
    docs = without(docs, *RESULT)
    plain, words, lines, windows, repeated = free_names(docs, "plain", "words", "lines", "windows", "repeated")
    text = F.coalesce(F.col(text_col), F.lit(""))
    full_lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.translate(line, SPACES, "")) > 0)
    step = docs.withColumn(plain, text).withColumn(words, word_array(F.col(text_col))).withColumn(lines, full_lines)
    step = step.withColumn(windows, _repeat_words(F.col(words)))
    # Positions of windows that equal a neighbour in the sorted order, in order of position.
    step = step.withColumn(repeated, _repeated_positions(F.col(windows)))
    counts = {
        "n_words": _count(F.col(words)),
        "word_chars": F.length(F.translate(plain, SPACES, "")).cast("long"),
        "n_symbols": _chars_in(F.col(plain), SIGNS),
        "n_dup_lines": _count(F.col(lines)) - _count(F.array_distinct(lines)),
        "n_repeat_words": _covered(F.col(repeated)),
        "n_exclamations": _chars_in(F.col(plain), "!"),
        "n_stop_words": _count(F.filter(words, lambda w: w.isin(*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)))),
        "n_letter_words": _count(F.filter(words, lambda w: F.rlike(w, F.lit(r"\p{L}")))),
        "n_lines": _count(F.col(lines)),
        "n_bullet_lines": _count(F.filter(lines, lambda line: F.substring(F.ltrim(line), 1, 1).isin(*BULLETS))),
        "n_ellipsis_lines": _count(F.filter(lines, lambda line: F.rtrim(line).endswith("...") | F.rtrim(line).endswith("…"))),
    }
    counted = step.withColumns(counts).drop(plain, words, lines, windows, repeated)
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    failed = F.array_compact(F.array(*(F.when(~rule.passes(), F.lit(rule.name)) for rule in rules)))
    return counted.withColumn("base_failed", base).withColumn("failed_rules", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)
    )


def _repeated_positions(windows: Column) -> Column:
    keys = windows["window"]
    after = F.concat(F.slice(keys, 2, F.greatest(F.size(keys), F.lit(1))), F.array(F.lit(None).cast("string")))
    before = F.concat(F.array(F.lit(None).cast("string")), keys)
    rows = F.arrays_zip(keys.alias("own"), windows["at"].alias("at"), before.alias("before"), after.alias("after"))
    same = F.filter(rows, lambda r: r["own"].isNotNull() & ((r["own"].eqNullSafe(r["before"])) | (r["own"].eqNullSafe(r["after"]))))
    return F.sort_array(F.transform(same, lambda r: r["at"]))


def _covered(at: Column) -> Column:
    after = F.slice(at, 2, F.greatest(F.size(at), F.lit(1)))
    return F.aggregate(
        F.zip_with(at, after, lambda p, q: F.least(F.coalesce(q - p, F.lit(3)), F.lit(3)).cast("long")), F.lit(0).cast("long"), lambda a, b: a + b
    )
