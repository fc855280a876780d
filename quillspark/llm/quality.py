"""Quality rules: a table of thresholds compiled into one Spark projection.

Everything is a column expression on the document's own row: no user functions, no shuffle.
Repeated 5-word windows are found inside the row: window digests are compared by a hashed
distinct first, and only texts that do repeat a window sort (digest, position) pairs to find
which words the repeats cover.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 5
#: Common words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in a is that it for on was be with "
    "de la le et les des un une que en est "
    "der die und das den ist von zu mit ein "
    "el los las y del se por con es una"
).split()


@dataclass(frozen=True)
class Rule:
    """Keep a document only while ``low <= metric <= high`` (None: no bound)."""

    metric: str
    low: float | None = None
    high: float | None = None


#: Metrics are columns of ``quality_metrics``. Bounds follow published heuristics for web
#: text, kept on the lenient side so that ordinary prose of any length passes.
RULES = (
    Rule("n_words", 10, 1_000_000),
    Rule("mean_word_chars", 2.0, 14.0),
    Rule("symbol_ratio", None, 0.10),
    Rule("stop_word_ratio", 0.02, None),
    Rule("dup_line_ratio", None, 0.35),
)


def bind(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body`` (a let binding inside one expression)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _covered(digests: Column) -> Column:
    """Words lying in windows whose digest occurs twice or more in ``digests``."""
    def from_sorted(s: Column) -> Column:
        last = F.size(s) - 1
        digest = lambda i: F.get(s, i).getField("h")
        starts = F.array_sort(F.filter(
            F.transform(s, lambda e, i: F.when(
                ((i > 0) & (e["h"] == digest(i - 1))) | ((i < last) & (e["h"] == digest(i + 1))), e["p"])),
            lambda p: p.isNotNull()))
        return bind(starts, lambda t: F.aggregate(
            F.transform(t, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(t, i + 1) - p, F.lit(WINDOW)))),
            F.lit(0).cast("long"), lambda acc, x: acc + x))

    return bind(F.array_sort(F.transform(digests, lambda h, i: F.struct(h.alias("h"), i.alias("p")))),
                from_sorted)


def _repeat_words(words: Column) -> Column:
    windows = F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)),
                          lambda i: F.xxhash64(F.slice(words, i, F.lit(WINDOW))))
    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("long")).otherwise(bind(
        windows, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long"))
        .otherwise(_covered(g))))


def quality_metrics(docs: DataFrame) -> DataFrame:
    """Base counts and ratios per document, in one projection over (doc_id, text).

    doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), and the ratios
    the rules use. Null texts count as empty; ratios of a text without words are 0.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", text.alias("__t"))
    words = F.filter(F.split("__t", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split("__t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    row = base.select("doc_id", "__t", words.alias("__w"), lines.alias("__l"))
    white = "\t\n\x0b\x0c\r "
    row = row.select(
        "doc_id",
        F.size("__w").cast("long").alias("n_words"),
        F.char_length(F.translate("__t", white, "")).cast("long").alias("word_chars"),
        (F.char_length("__t") - F.char_length(F.translate("__t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.size("__l").cast("long").alias("n_lines"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("__w")).alias("n_repeat_words"),
        F.size(F.filter("__w", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
    )

    def ratio(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    return row.select(
        "*", ratio("word_chars", "n_words").alias("mean_word_chars"),
        ratio("n_symbols", "word_chars").alias("symbol_ratio"),
        # one added stop word: a short text without any is not yet odd
        F.when(F.col("n_words") > 0, (F.col("n_stop_words") + 1) / F.col("n_words"))
        .otherwise(F.lit(0.0)).alias("stop_word_ratio"),
        ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"))


def compile_rules(rules: tuple[Rule, ...]) -> Column:
    """One boolean expression that is true when every rule of the table holds."""
    out = F.lit(True)
    for r in rules:
        if r.low is not None:
            out = out & (F.col(r.metric) >= F.lit(r.low))
        if r.high is not None:
            out = out & (F.col(r.metric) <= F.lit(r.high))
    return out


def judge_quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Metrics plus ``base_failed`` and ``kept``, one row per input row.

    ``base_failed``: under 10 words, or over a fifth of the words in repeated 5-word windows.
    ``kept``: not base_failed and every rule of the table holds.

    Edge cases: null and empty texts have 0 words and fail; repeated rows are judged each for
    itself; other columns are not read, so their names cannot clash; an empty table gives an
    empty result.
    """
    m = quality_metrics(docs)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return m.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & compile_rules(rules))
