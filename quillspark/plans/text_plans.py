"""Text queries over the ``documents`` table (lines = F1 of FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions import text as T
from quillspark.functions.arrays import explode_rows
from quillspark.operators import wordcount as W
from quillspark.plans.registry import register
from quillspark.sources.tables import table
from quillspark.sources.text import document_lines

# DuckDB: the lines of every document, with their 0-based position.
_LINES = """
SELECT doc_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS BIGINT) AS line_no,
       unnest(string_split(text, chr(10))) AS line
FROM documents
"""


@register("scan_text_lines", f"SELECT doc_id, line_no, line FROM ({_LINES})")
def scan_text_lines(spark, sf):
    return document_lines(table(spark, sf, "documents"))


@register("strip_chars", f"""
SELECT doc_id, line_no, regexp_replace(line, '[^A-Za-z0-9 ]', '', 'g') AS line FROM ({_LINES})""")
def strip_chars(spark, sf):
    lines = document_lines(table(spark, sf, "documents"))
    return lines.select("doc_id", "line_no", T.strip_chars("line").alias("line"))


@register("fold_case", f"SELECT doc_id, line_no, lower(line) AS line FROM ({_LINES})")
def fold_case(spark, sf):
    lines = document_lines(table(spark, sf, "documents"))
    return lines.select("doc_id", "line_no", T.fold_case("line").alias("line"))


_TOKENS = f"""
SELECT doc_id, line_no, unnest(regexp_split_to_array(line, '[ \\t\\r\\n\\f]+')) AS word FROM ({_LINES})
"""


@register("tokenize_words", f"SELECT doc_id, line_no, word FROM ({_TOKENS}) WHERE word <> ''")
def tokenize_words(spark, sf):
    lines = document_lines(table(spark, sf, "documents"))
    return explode_rows(lines, T.split_words("line"), ["doc_id", "line_no"], "word")


@register("filter_prefix", f"""
SELECT doc_id, line_no, lower(word) AS word FROM ({_TOKENS}) WHERE lower(word) LIKE 'h%'""")
def filter_prefix(spark, sf):
    lines = document_lines(table(spark, sf, "documents"))
    words = explode_rows(lines, T.split_words(T.fold_case("line")), ["doc_id", "line_no"], "word")
    return words.where(T.starts_with("word", "h"))


@register("wordcount_top20", f"""
SELECT word, count(*) AS n FROM ({_TOKENS}) WHERE word <> ''
GROUP BY word ORDER BY n DESC, word LIMIT 20""")
def wordcount_top20(spark, sf):
    return W.wordcount_top(table(spark, sf, "documents"), k=20)


@register("wordcount_top20_nocase", f"""
SELECT lower(word) AS word, count(*) AS n FROM ({_TOKENS}) WHERE word <> ''
GROUP BY 1 ORDER BY n DESC, word LIMIT 20""")
def wordcount_top20_nocase(spark, sf):
    return W.wordcount_top(table(spark, sf, "documents"), k=20, fold=True)


@register("wordcount_top20_h", f"""
SELECT lower(word) AS word, count(*) AS n FROM ({_TOKENS}) WHERE lower(word) LIKE 'h%'
GROUP BY 1 ORDER BY n DESC, word LIMIT 20""")
def wordcount_top20_h(spark, sf):
    return W.wordcount_top(table(spark, sf, "documents"), k=20, fold=True, prefix="h")


@register("wordcount_top40_clean", f"""
WITH cleaned AS (
  SELECT lower(regexp_replace(line, '[^A-Za-z0-9 ]', '', 'g')) AS line FROM ({_LINES})
), words AS (SELECT unnest(string_split(line, ' ')) AS word FROM cleaned)
SELECT word, count(*) AS n FROM words WHERE word <> ''
GROUP BY word ORDER BY n DESC, word LIMIT 40""")
def wordcount_top40_clean(spark, sf):
    return W.wordcount_top(table(spark, sf, "documents"), k=40, clean=True)


@register("topk_by_count", f"""
SELECT line, count(*) AS n FROM ({_LINES}) WHERE line <> ''
GROUP BY line ORDER BY n DESC, line LIMIT 25""")
def topk_by_count(spark, sf):
    """The 25 most repeated non-empty lines: top-k over another key than words."""
    lines = document_lines(table(spark, sf, "documents")).where(F.col("line") != "")
    counts = lines.groupBy("line").agg(F.count(F.lit(1)).alias("n"))
    return W.topk_by_count(counts, 25, key="line")
