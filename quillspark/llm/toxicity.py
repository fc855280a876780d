"""Toxicity by class-conditional Kneser-Ney models with shared backoff counts.

Two models, one of toxic and one of ordinary text, are learnt from a bounded sample of the
labelled rows (``max_docs`` a class, by digest order). Both levels use continuation counts:
a word counts once per different word before it, a word pair once per different word before
the pair, so copies of a text add nothing. A word that follows few different words, as in a
fixed phrase, is pruned itself but stays in the vocabulary of the pairs if ``min_count``
different texts of a class hold it. Counts are discounted absolutely, and the mass
taken off goes to a backoff distribution that both classes share: the word counts of the whole
corpus. Expressions seen fewer than ``min_count`` times, expressions whose class difference is
within chance (a G statistic under ``significance`` * ln(word types)) and expressions whose
log ratio stays below ``min_log_ratio`` are pruned to that shared backoff, so that a rare
expression is as likely in either model and says nothing. Expressions are words and their
stems (the first 5 and 4 letters of longer words); a word that is pruned itself backs off to
its longest kept stem.

A text's evidence is the difference of its toxic and ordinary log-likelihoods, taken relative
to the all-backoff text of the same length and divided by the number of words. A part of the
sample that is held back from counting sets the threshold; the score is a logistic curve
through it.

The counting, joining and pruning are Spark aggregations; only the vocabulary of the sample, the
kept expressions (each at most ``max_entries``; more are an error, none is cut) and the
calibration values (a number per sampled text) reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import map_batches, returning_memory, rows_of, stored, text_bytes
from quillspark.llm.repeats import batch, in_chunks
from quillspark.session import ship_package

_STRIP = ".,;:!?\"'()[]*_-"
#: Digests that no word is mapped to: before the first word, and any word outside the vocabulary.
START, RARE = 0, 1


@dataclass(frozen=True)
class Settings:
    max_docs: int = 4096
    max_entries: int = 2_000_000
    discount: float = 0.75
    min_count: int = 5
    min_log_ratio: float = 1.0
    significance: float = 3.0


STEMS = (5, 4)
#: Rows that a task gathers before it removes or sums repeats.
CHUNK = 500_000
#: Words that a task of the corpus counts numbers before it sends their sums.
MAX_WORDS = 250_000


def _digest(expression: str) -> int:
    """A positive digest that is neither START nor RARE."""
    return xxhash.xxh64_intdigest(expression, 7) >> 1 | 2


def _plain(word: bytes) -> str:
    """A word as it is counted: lower case, without punctuation around it."""
    text = word.decode("utf-8", "replace")
    return text.lower().strip(_STRIP) or text


def _word(plain: str) -> int:
    return _digest(plain)


def _stem(letters: int):
    """The digest of a word's first ``letters`` letters, or START for words without more."""
    return lambda plain: _digest(plain[:letters] + "*") if len(plain) > letters else START


class _Words(dict):
    """raw word (bytes) -> the number that ``of`` gives its plain form, remembered."""

    def __init__(self, of, limit: int = 300_000) -> None:
        super().__init__()
        self.of, self.limit = of, limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        v = self[word] = self.of(_plain(word))
        return v

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


_EXPRESSIONS = (_word, *map(_stem, STEMS))


def _levels() -> list[_Words]:
    return [_Words(of, 100_000) for of in _EXPRESSIONS]


class _Vocabulary(dict):
    """raw word (bytes) -> its number; ``digests`` lists each number's expressions by level."""

    def __init__(self) -> None:
        super().__init__()
        self.digests: list[list[int]] = [[] for _ in _EXPRESSIONS]

    def __missing__(self, word: bytes) -> int:
        plain = _plain(word)
        for found, of in zip(self.digests, _EXPRESSIONS):
            found.append(of(plain))
        n = self[word] = len(self)
        return n

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def _unique_rows(columns: list[np.ndarray]) -> list[np.ndarray]:
    key = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        key = (key ^ c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(31)
    _, first = np.unique(key, return_index=True)
    return [c[first] for c in columns]


def labelled_sample(labels: DataFrame, max_docs: int) -> DataFrame:
    """(id, toxic, held): at most ``max_docs`` rows a class; ``held`` rows only calibrate."""
    one = (labels.filter("doc_id is not null and toxic is not null")
           .groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    order = F.xxhash64("id")
    parts = [one.filter(F.col("toxic") == c).orderBy(order, "id").limit(max_docs) for c in (0, 1)]
    return parts[0].unionAll(parts[1]).withColumn("held", F.pmod(F.xxhash64("id", F.lit(11)), F.lit(4)) == 0)


def word_pairs(sample: DataFrame) -> DataFrame:
    """(toxic, v, w): the expressions w of the counted texts after each word v, distinct."""
    def rows(batches):
        levels = _levels()
        for b in batches:
            for toxic, text in rows_of(b, 0, 1):
                words = text.split()
                each = [level.array(words) for level in levels]
                before = np.concatenate(([START], each[0]))[:-1]
                for a in each:
                    there = a != START
                    yield np.full(int(there.sum()), toxic, np.int32), before[there], a[there]

    def run(batches):
        for part in in_chunks(rows(batches), CHUNK):
            yield batch(_unique_rows(part), ["toxic", "v", "w"])

    pairs = map_batches(sample.filter("not held").select("toxic", "text"), run, "toxic int, v long, w long")
    return pairs.repartition(F.col("w")).distinct()


def text_counts(sample: DataFrame) -> DataFrame:
    """(toxic, w, n): in how many different counted texts each word occurs, summed by chunk."""
    def rows(batches):
        words = _Words(_word, 100_000)
        for b in batches:
            for toxic, text in rows_of(b, 0, 1):
                found = np.unique(words.array(text.split()))
                yield np.full(len(found), toxic, np.int32), found

    def run(batches):
        for toxic, found in in_chunks(rows(batches), CHUNK):
            for c in (0, 1):
                w, n = np.unique(found[toxic == c], return_counts=True)
                yield batch((np.full(len(w), c, np.int32), w, n), ["toxic", "w", "n"])

    texts = sample.filter("not held").select("toxic", "text").distinct()
    return map_batches(texts, run, "toxic int, w long, n long")


def word_triples(sample: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(toxic, a, v, w) with v in the vocabulary and w in it or RARE; sorted ``vocabulary``."""
    def rows(batches):
        words = _Words(_word)
        for b in batches:
            for toxic, text in rows_of(b, 0, 1):
                x = np.concatenate(([START, START], words.array(text.split())))
                if len(x) < 4 or not len(vocabulary):
                    continue
                known = vocabulary[np.minimum(np.searchsorted(vocabulary, x), len(vocabulary) - 1)] == x
                i = np.flatnonzero(known[1:-1]) + 1
                yield np.full(len(i), toxic, np.int32), x[i - 1], x[i], np.where(known, x, RARE)[i + 1]

    def run(batches):
        for part in in_chunks(rows(batches), CHUNK):
            yield batch(_unique_rows(part), ["toxic", "a", "v", "w"])

    triples = map_batches(sample.filter("not held").select("toxic", "text"), run, "toxic int, a long, v long, w long")
    return triples.repartition(F.col("v"), F.col("w")).distinct()


def corpus_counts(docs: DataFrame) -> DataFrame:
    """(w, n): how often each expression occurs in all texts; tasks send sums, not occurrences."""
    def run(batches):
        words = _Vocabulary()
        sums = np.zeros(0, np.int64)

        def rows():
            for b in batches:
                for (text,) in rows_of(b, 0):
                    yield (words.array(text.split()),)

        def summed():
            each = np.concatenate([np.array(found, np.int64) for found in words.digests])
            w, group = np.unique(each, return_inverse=True)
            n = np.zeros(len(w), np.int64)
            np.add.at(n, group, np.tile(sums, len(words.digests)))
            return batch((w[w != START], n[w != START]), ["w", "n"])

        for (found,) in in_chunks(rows(), 2 * CHUNK):
            now = np.bincount(found, minlength=len(words))
            now[:len(sums)] += sums
            sums = now
            if len(words) > MAX_WORDS:
                yield summed()
                words, sums = _Vocabulary(), np.zeros(0, np.int64)
        if len(words):
            yield summed()

    return (map_batches(docs.select(text_bytes().alias("text")), run, "w long, n long")
            .groupBy("w").agg(F.sum("n").alias("n")))


class Model:
    """Kept expressions: log ratios of words and word pairs, by digest, and the calibration."""

    def __init__(self, words: list, pairs: list) -> None:
        vocabulary = sorted({w for w, _ in words} | {x for v, w, _ in pairs for x in (v, w)})
        self.index = {d: i for i, d in enumerate(vocabulary, 1)}  # 0: not in the model
        self.size = len(vocabulary) + 1
        self.word = np.zeros(self.size)
        for w, value in words:
            self.word[self.index[w]] = value
        keyed = sorted((self.index[v] * self.size + self.index[w], value) for v, w, value in pairs)
        self.pair_keys = np.array([k for k, _ in keyed], np.int64)
        self.pair_values = np.array([x for _, x in keyed])
        self.threshold, self.width = 0.0, 1.0

    def words(self) -> _Words:
        """raw word -> the index of its kept expression: itself, else its longest stem, else 0."""
        return _Words(lambda plain: next((i for i in (self.index.get(of(plain), 0) for of in _EXPRESSIONS) if i), 0))

    def evidence(self, ids: np.ndarray) -> float:
        """Length-normalised difference of the two log-likelihoods; 0 for a wordless text."""
        if not len(ids):
            return 0.0
        value = self.word[ids]
        if len(self.pair_keys) and len(ids) > 1:
            i = np.flatnonzero((ids[1:] > 0) & (ids[:-1] > 0))
            key = ids[i] * self.size + ids[i + 1]
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            hit = self.pair_keys[at] == key
            value[i[hit] + 1] = self.pair_values[at[hit]]
        return float(value.sum() / len(ids))

    def calibrate(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """Threshold with the least weighted error; ties go to the middle of the widest gap."""
        order = np.argsort(x, kind="stable")
        x, y, weight = x[order], y[order], weight[order]
        wrong = np.concatenate(([0], np.cumsum(weight * y))) + np.concatenate(
            (np.cumsum((weight * (1 - y))[::-1])[::-1], [0]))
        edge = np.concatenate(([x[0] - 1], x, [x[-1] + 1]))
        gap = np.diff(edge)
        wrong = np.where(gap > 0, wrong, np.inf)
        best = np.flatnonzero(wrong <= wrong.min() + 1e-9)
        i = best[np.argmax(gap[best])]
        self.threshold = float((edge[i] + edge[i + 1]) / 2)
        self.width = max(abs(self.threshold) / 4, 1e-6)

    def score(self, x):
        return 1 / (1 + np.exp(-np.clip((np.asarray(x) - self.threshold) / self.width, -60, 60)))


def within_bound(df: DataFrame, max_rows: int) -> list:
    """All rows of ``df`` at the driver; more than the bound are an error, never cut."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"the model has more than {max_rows} expressions: raise max_entries or lower max_docs")
    return rows


def _expressions(sample: DataFrame, docs: DataFrame, s: Settings) -> Model:
    d = float(s.discount)
    side = lambda c: F.sum(F.when(F.col("toxic") == c, F.col("n")).otherwise(0))
    kept = lambda c: F.greatest(F.col(c) - d, F.lit(0.0))

    uni = stored(word_pairs(sample).groupBy("toxic", "w").agg(F.count("*").alias("n"))
                 .groupBy("w").agg(side(1).alias("ct"), side(0).alias("co")), "tox-words")
    tt, to, kt, ko = (float(x or 0) for x in uni.agg(F.sum("ct"), F.sum("co"), F.sum(kept("ct")), F.sum(kept("co"))).first())
    if not tt or not to:
        return Model([], [])
    corpus = stored(corpus_counts(docs), "tox-corpus")
    total, types = (float(x or 0) for x in corpus.agg(F.sum("n"), F.count("*")).first())
    base = float(np.log((1 - kt / tt) / (1 - ko / to)))  # log ratio of a word that backs off wholly
    share, chance = tt / (tt + to), s.significance * float(np.log(types + 1))
    seen = lambda c, q: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / ((F.col("ct") + F.col("co")) * F.lit(q)))).otherwise(0.0)  # noqa: E731,E501
    differs = 2 * (seen("ct", share) + seen("co", 1 - share)) >= chance
    shared = (F.coalesce("n", F.lit(0)) + 1) / F.lit(total + types + 1)
    held_by = (text_counts(sample).groupBy("w").agg(side(1).alias("xt"), side(0).alias("xo"))
               .filter(F.greatest("xt", "xo") >= s.min_count).select("w", F.lit(True).alias("in_texts")))
    often = F.greatest("ct", "co") >= s.min_count
    frequent = (uni.join(held_by, "w", "left").filter(often | F.col("in_texts"))
                .join(corpus, "w", "left")
                .withColumn("pt", kept("ct") / F.lit(tt) + F.lit(1 - kt / tt) * shared)
                .withColumn("po", kept("co") / F.lit(to) + F.lit(1 - ko / to) * shared)
                .withColumn("log_ratio", F.log(F.col("pt") / F.col("po")) - F.lit(base)))
    frequent = stored(frequent.select("w", "pt", "po", "log_ratio", (differs & often).alias("differs")), "tox-frequent")
    vocabulary = np.sort(np.array([r.w for r in within_bound(frequent.select("w"), s.max_entries)], np.int64))

    bi = (word_triples(sample, vocabulary).groupBy("toxic", "v", "w").agg(F.count("*").alias("n"))
          .groupBy("v", "w").agg(side(1).alias("ct"), side(0).alias("co")))
    bi = stored(bi, "tox-pairs")
    heads = (bi.groupBy(F.col("v").alias("head"))
             .agg(F.sum("ct").alias("ht"), F.sum("co").alias("ho"), F.sum(kept("ct")).alias("hkt"), F.sum(kept("co")).alias("hko")))

    def conditional(c: str, h: str, hk: str, p: str) -> Column:
        return F.when(F.col(h) > 0, kept(c) / F.col(h) + (1 - F.col(hk) / F.col(h)) * F.col(p)).otherwise(F.col(p))

    pairs = (bi.filter((F.greatest("ct", "co") >= s.min_count) & (F.col("w") != RARE) & differs)
             .join(heads, F.col("v") == F.col("head")).join(frequent.drop("differs"), "w")
             .withColumn("pair_ratio", F.log(conditional("ct", "ht", "hkt", "pt") / conditional("co", "ho", "hko", "po")) - F.lit(base)))

    def telling(df: DataFrame, ratio: str, *key: str) -> list:
        return [tuple(r) for r in within_bound(df.filter(F.abs(ratio) >= s.min_log_ratio).select(*key, ratio), s.max_entries)]

    return Model(telling(frequent.filter("differs"), "log_ratio", "w"), telling(pairs, "pair_ratio", "v", "w"))


def _evidence(df: DataFrame, model: Model, carry: str, kind: str) -> DataFrame:
    """(carry, x): the evidence of each row's text, beside one long or int column."""
    def run(batches):
        words = model.words()
        for b in batches:
            x = [model.evidence(words.array(t.split())) for (t,) in rows_of(b, 1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.float64())], names=[carry, "x"])

    return map_batches(df.select(carry, text_bytes().alias("text")), run, f"{carry} {kind}, x double")


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model | float:
    """Learn from ``labels`` (doc_id, toxic) and the texts of ``docs``.

    Returns a model, or, if the labels hold only one class or none, the share of toxic labels.
    """
    sample = stored(labelled_sample(labels, settings.max_docs), "tox-labels")  # at most 2 x max_docs rows
    texts = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
                   .join(F.broadcast(sample), F.col("doc_id") == F.col("id"))
                   .select("toxic", "held", "text"), "tox-sample")
    n = {r.toxic: r["count"] for r in texts.filter("not held").groupBy("toxic").count().collect()}
    if not n.get(0) or not n.get(1):
        return n.get(1, 0) / max(sum(n.values()), 1)
    model = _expressions(texts, docs, settings)
    natural = {r.c: r["count"] for r in labels.groupBy(F.col("toxic").cast("int").alias("c")).count().collect()}
    held = texts.filter("held")
    if held.select("toxic").distinct().count() < 2:
        held = texts
    rows = _evidence(held, model, "toxic", "int").collect()  # at most 2 x max_docs numbers
    x, y = np.array([r.x for r in rows]), np.array([r.toxic for r in rows], float)
    weight = np.where(y == 1, natural[1] / y.sum(), natural[0] / (1 - y).sum())
    model.calibrate(x, y, weight)
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, score, predicted) per input row; ``predicted`` is 1 where score >= 0.5.

    Only texts enter a score. ``labels`` (doc_id, toxic) are the rows to learn from.

    Edge cases: null, empty and wordless texts have no evidence and get the model's score of
    0 evidence; without both classes among the labels every score is the share of toxic labels;
    a doc_id labelled twice counts as toxic if any of its labels is; repeated and null doc_ids
    are scored row by row; other columns are not read; an empty table gives an empty result.
    """
    model = fit(docs, labels, settings)
    if isinstance(model, float | int):
        out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(float(model)).alias("score"))
    else:
        x = _evidence(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model, "doc_id", "long")
        z = (F.col("x") - F.lit(model.threshold)) / F.lit(model.width)
        out = x.select("doc_id", (1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(60.0)), F.lit(-60.0))))).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` (all its columns, rows by text) without the rows whose text is predicted toxic."""
    model = fit(docs, labels, settings)
    if isinstance(model, float | int):
        return docs.filter(F.lit(model < 0.5))
    ship_package(docs.sparkSession)

    @F.pandas_udf("double")
    @returning_memory
    def evidence(texts: pd.Series) -> pd.Series:
        words = model.words()
        return pd.Series([model.evidence(words.array((t or "").encode().split())) for t in texts], dtype="float64")

    return docs.filter(evidence(F.col("text")) < model.threshold)
