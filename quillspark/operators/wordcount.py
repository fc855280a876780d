"""Word counts and top-k by count.

Tokenizing whole texts (not lines) keeps one row per document through the scan; the
explode and the partial count run in the same stage, so only (word, partial count)
pairs are shuffled. A word holding a third of all tokens costs one row per task after
the map-side combine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions import text as T
from quillspark.functions.arrays import explode_rows


def word_counts(df: DataFrame, words: Column, name: str = "word") -> DataFrame:
    """(word, n): ``words`` is an array column of tokens per input row."""
    return (explode_rows(df, words, [], name)
            .groupBy(name).agg(F.count(F.lit(1)).alias("n")))


def topk_by_count(counts: DataFrame, k: int, key: str = "word", count_col: str = "n") -> DataFrame:
    """The k largest counts, largest first; ties by key so the k-th place is fixed.

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: a per-task top-k and a
    k-row merge, no global sort.
    """
    return counts.orderBy(F.col(count_col).desc(), F.col(key).asc()).limit(k)


def wordcount_top(documents: DataFrame, k: int = 20, fold: bool = False,
                  prefix: str | None = None, clean: bool = False, text_col: str = "text") -> DataFrame:
    """Top-k words of a text column.

    clean=True: per line delete all but letters, digits, space; lower-case; split on
    spaces (the newline is kept as a separator so lines never glue together).
    Empty tokens and the prefix test are row filters after the explode (code-generated),
    not lambdas over every token array.
    """
    txt = F.col(text_col)
    if clean:
        tokens = F.split(T.fold_case(T.strip_chars_keep_lines(txt)), "[ \\n]+", -1)
    else:
        tokens = F.split(T.fold_case(txt) if fold else txt, T.WHITESPACE, -1)
    words = explode_rows(documents, tokens, [], "word").where(F.col("word") != "")
    if prefix is not None:
        words = words.where(F.col("word").startswith(prefix))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return topk_by_count(counts, k)
