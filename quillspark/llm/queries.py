"""The registered queries of this subpackage and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.chunking import fingerprint_documents
from quillspark.llm.common import documents
from quillspark.llm.exact import exact_groups
from quillspark.llm.mixing import mix_sources
from quillspark.llm.packing import pack_documents
from quillspark.llm.periods import collapse_periodic_runs, plant_runs, runs_digest, strongest_run
from quillspark.llm.phrases import mine_phrases
from quillspark.llm.quality import judge_quality
from quillspark.llm.simhash import simhash_components
from quillspark.llm.substring import remove_repeated_words
from quillspark.llm.suffixes import remove_repeated_bytes
from quillspark.llm.tokenfile import token_files
from quillspark.llm.toxicity import score_toxicity
from quillspark.llm.urlfilter import judge_urls
from quillspark.sources.tables import table

#: Parameters of the SimHash contract: words in a shingle, differing bits of a link.
SHINGLE, MAX_BITS = 4, 4
#: Length of a repeat: words (substring dedup), bytes (suffix-array dedup).
REPEAT_WORDS, REPEAT_BYTES = 20, 100
#: Tokens in a packed sequence.
SEQUENCE = 2048
#: Production parameters of the mixing query: relative weights of the sources.
MIX_WEIGHTS = {"src0": 4.0, "src1": 2.0, "src2": 0.5}
#: A periodic run: words and periods at least.
RUN_WORDS, RUN_PERIODS = 24, 3
#: Phrases: occurrences at least, words at most, phrases listed per language, share of a longer one.
PHRASE_COUNT, PHRASE_WORDS, PHRASE_TOP, PHRASE_COVERED = 30, 4, 2000, 80
#: Fixed values of the url contract: verdict, host, path prefix.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(documents(spark, sf_dir), REPEAT_BYTES)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(documents(spark, sf_dir), SHINGLE, MAX_BITS)


def op2_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_words(documents(spark, sf_dir), REPEAT_WORDS)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from: crc32(doc_id as text) mod 5 is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").filter(~held_out()).select("doc_id", "toxic")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(documents(spark, sf_dir), training_labels(spark, sf_dir))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), SEQUENCE)


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(documents(spark, sf_dir))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir), MIX_WEIGHTS)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collapse_periodic_runs(plant_runs(documents(spark, sf_dir)), RUN_WORDS, RUN_PERIODS)
    found = found.withColumn("best", strongest_run("runs"))
    best = F.col("best")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"),
        best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        runs_digest("runs").alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(documents(spark, sf_dir), PHRASE_COUNT, PHRASE_WORDS, PHRASE_TOP, PHRASE_COVERED)


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir))


_QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_substring": op2_substring,
    "op3_toxicity": op3_toxicity,
    "op4_packing": op4_packing,
    "op5_fingerprint": op5_fingerprint,
    "op6_token_files": op6_token_files,
    "op7_quality": op7_quality,
    "op8_mixing": op8_mixing,
    "op9_url_filter": op9_url_filter,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_phrases": op12_phrases,
    "op13_exact_dedup": op13_exact_dedup,
}


def queries():
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from quillspark.llm import oracles
    return oracles.oracle_sql()
