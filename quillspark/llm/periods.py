"""Periodic runs of words by an online diagonal recurrence over sparse matches.

A run is a stretch of consecutive words with smallest period q that holds at least
``min_periods`` periods and ``min_words`` words and that no neighbouring word extends. On the
diagonal of lag q (word i against word i - q) a run is one unbroken line of matches, of at
least ``max(min_words - q, (min_periods - 1) * q)`` words. The recurrence walks over the words
of a text: an earlier occurrence at lag q lengthens that lag's match, and a diagonal that a
word does not go on with ends there and is emitted at once if it is long enough.

What keeps the diagonals few is how an occurrence is told. Word i counts as occurring earlier at
lag q only if the next ``reach`` words do too, where ``reach`` is a power of two above q and no
longer than a run's line must be. A reach above q also settles which earlier occurrence matters:
within a run of smallest period q nothing nearer than q repeats a stretch that long, so the
nearest earlier occurrence is the run's own lag. Every word thus has at most one earlier
occurrence a reach, and there are log(n) reaches, so a text of one word repeated a million
times costs no more than any other. Stretches of a reach are named by ranks of pairs of the
halves' ranks (exact, no digests); only stretches that occur twice go on to the next reach.

Texts are independent, so the work is one pass over the table without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import map_batches, rows_of, text_bytes

#: Words of several texts that are ranked together.
WORDS_AT_ONCE = 200_000
#: Bytes of a text that are Python objects at one time.
BLOCK = 4 << 20
_SPACE = frozenset(b" \t\n\x0b\x0c\r")


class Numbers(dict):
    """word -> a number of its own."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def word_blocks(text: bytes, block: int = 0) -> Iterator[list[bytes]]:
    """The words of a text, a block of it at a time; no word is cut."""
    at, block = 0, block or BLOCK
    while at < len(text):
        end = at + block
        while end < len(text) and text[end] not in _SPACE:
            end += 1
        yield text[at:end].split()
        at = end


def _repeated(position: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, rank of its key) of the keys that occur twice or more, by key and position."""
    if not len(key):
        return position, key
    order = np.argsort(key, kind="stable")
    k = key[order]
    rank = np.cumsum(np.concatenate(([False], k[1:] != k[:-1])))
    again = np.bincount(rank)[rank] > 1
    return position[order][again], rank[again]


def earlier_occurrences(words: np.ndarray, min_words: int, min_periods: int):
    """(word, lag, reach) in the order of the words: the nearest earlier occurrence of the
    ``reach`` words from there on, for every reach whose lags it may tell.

    ``words``: numbers of the words; those of different texts must differ.
    """
    lags = np.arange(1, min_words + 2)
    least = int(np.maximum(min_words - lags, (min_periods - 1) * lags).min())
    first = 1 << (max(least, 2).bit_length() - 1)  # the reach of all lags below itself
    position, rank = _repeated(np.arange(len(words)), words)
    dense = np.full(len(words), -1, np.int64)
    found, reach = [], 1
    while len(position):
        if reach >= first:
            lag = np.diff(position)
            low = 1 if reach == first else reach // 2
            here = np.flatnonzero((rank[1:] == rank[:-1]) & (lag >= low) & (lag < reach))
            found.append((position[here + 1], lag[here], np.full(len(here), reach)))
        dense[:] = -1
        dense[position] = rank
        start = np.sort(position)
        start = start[start + reach < len(words)]
        start = start[dense[start + reach] >= 0]
        position, rank = _repeated(start, dense[start] * (int(rank.max()) + 1) + dense[start + reach])
        reach *= 2
    if not found:
        return ()
    position, lag, reaches = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(position, kind="stable")
    return zip(position[order].tolist(), lag[order].tolist(), reaches[order].tolist())


def online_runs(occurrences: Iterable[tuple[int, int, int]], min_words: int, min_periods: int
                ) -> Iterator[tuple[int, int, int]]:
    """(start, length, period) of every run, as its diagonal ends."""
    active: dict[int, list[int]] = {}  # lag -> [words matched so far, last word with an occurrence, reach]
    at = -1

    def run(lag: int, matched: int, last: int, reach: int):
        if matched >= max(min_words - lag, (min_periods - 1) * lag):
            yield last + reach - matched - lag, matched + lag, lag

    for word, lag, reach in occurrences:
        if word != at:
            for old in [d for d, x in active.items() if x[1] < word - 1]:
                yield from run(old, *active.pop(old))
            at = word
        line = active.get(lag)
        if line is None:
            active[lag] = [reach, word, reach]
        else:
            line[0] += 1
            line[1] = word
    for lag, line in active.items():
        yield from run(lag, *line)


def runs_of_texts(texts: list[np.ndarray], min_words: int = 24, min_periods: int = 3) -> list[list[tuple[int, int, int]]]:
    """Per text (numbers of its words) its runs by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts], np.int64)
    if not sizes.sum():
        return out
    words = np.concatenate(texts).astype(np.int64)
    words += np.repeat(np.arange(len(texts)), sizes) * (int(words.max()) + 1)
    first = np.cumsum(sizes) - sizes
    stop = first + sizes
    found = sorted(online_runs(earlier_occurrences(words, min_words, min_periods), min_words, min_periods),
                   key=lambda r: (r[0], r[2]))
    for (start, length, period), no in zip(found, np.searchsorted(stop, [r[0] for r in found], "right").tolist()):
        out[no].append((start - int(first[no]), length, period))
    return out


def collapse(text: bytes, runs: list[tuple[int, int, int]], n: int) -> bytes:
    """The words joined by one space, without those that a run holds after its first period."""
    gone = np.zeros(n, bool)
    for start, length, period in runs:
        gone[start + period:start + length] = True
    parts, at = [], 0
    for words in word_blocks(text):
        if gone[at:at + len(words)].any():
            kept = [w for w, g in zip(words, gone[at:at + len(words)].tolist()) if not g]
        else:
            kept = words
        if kept:
            parts.append(b" ".join(kept))
        at += len(words)
    return b" ".join(parts)


_SCHEMA = ("doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
           "collapsed binary")
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def collapse_periodic_runs(docs: DataFrame, min_words: int = 24, min_periods: int = 3) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) per input row.

    ``runs``: array of (start, length, period) in words, by start, then period; ``collapsed``:
    the words joined by one space, without those that any run holds after its first period.

    Edge cases: null, empty and wordless texts have no run and an empty collapsed text; texts
    of any length are read whole (their words are Python objects a block at a time); rows are
    independent, so repeated rows, equal and null doc_ids give a row each; other columns are
    not read; text that is not UTF-8 is taken as the bytes it is; an empty table gives an empty
    result. ``min_periods`` is at least 3 (below that a run's own lag need not be the nearest).
    """
    if min_periods < 3 or min_words < 1:
        raise ValueError("runs need at least 3 periods and 1 word")

    def found(held):
        runs = runs_of_texts([w for _, _, w in held], min_words, min_periods)
        return pa.RecordBatch.from_arrays(
            [pa.array([d for d, _, _ in held], pa.int64()), pa.array([len(w) for _, _, w in held], pa.int64()),
             pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs], _RUNS),
             pa.array([collapse(t, r, len(w)) for (_, t, w), r in zip(held, runs)], pa.binary())],
            names=["doc_id", "n_words", "runs", "collapsed"])

    def run(batches):
        held, n, numbers = [], 0, Numbers()
        for b in batches:
            for doc, text in rows_of(b, 0, 1):
                parts = [np.fromiter(map(numbers.__getitem__, w), np.int32, len(w)) for w in word_blocks(text)]
                words = np.concatenate(parts) if parts else np.empty(0, np.int32)
                held.append((doc, text, words))
                n += len(words)
                if n >= WORDS_AT_ONCE:
                    yield found(held)
                    held, n, numbers = [], 0, Numbers()
        if held:
            yield found(held)

    out = map_batches(docs.select(F.col("doc_id").cast("long"), text_bytes()), run, _SCHEMA)
    return out.withColumn("collapsed", F.col("collapsed").cast("string"))


def plant_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the contract's rewriting of one text in ten into a periodic one, decided
    by crc32(doc_id as text); a null doc_id leaves the text as it is."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    base = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    base = base.withColumn("words", F.when(F.col("h") % 10 == 0, words))
    n = F.greatest(F.size("words"), F.lit(1)).cast("long")
    base = base.withColumn("n", n).withColumn("a", F.col("g") % F.col("n"))
    base = base.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    a, p = F.col("a"), F.col("p")
    place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
    planted = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1),
                                       lambda i: F.get("words", place(i))), " ")
    return base.select("doc_id", F.when(F.size("words") > 0, planted).otherwise(F.col("text")).alias("text"))


def strongest_run(runs: str):
    """The run with the greatest length / period (exact; then the earliest); null of no run."""
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    return F.aggregate(runs, none, lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


def runs_digest(runs: str):
    """sha256 of every run's ``start,length,period`` and a line feed."""
    line = lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                                          r["period"].cast("string")), F.lit("\n"))
    return F.sha2(F.array_join(F.transform(runs, line), "").cast("binary"), 256)
