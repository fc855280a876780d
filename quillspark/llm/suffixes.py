"""Suffix-array dedup on bytes: a distributed merge sort of front-coded suffix runs that never
compares known prefixes again.

A full suffix array of the corpus would move a hundred bytes for every byte. Suffixes are
therefore taken at winnowed anchors (``repeats.runs``): every ``length``-byte string holds one,
at an offset that depends on its content alone, so equal strings meet at equal anchors. Each
anchor's record is its suffix (from the anchor to the end of its run's last string) with the
reversed bytes before it.

1. Distinguishing prefixes (as in communication-efficient string sorting): anchors whose
   20-byte prefix occurs once in the corpus, told by digest counts, are not sorted at all.
2. Tasks sort their suffixes into runs, cut them by range splitters taken from a sample of the
   texts, and front-code them: the common prefix length with the suffix before, then the rest.
3. Every range merges its runs with a loser tree that carries common prefix lengths: a
   comparison starts where the prefixes known from the run and from earlier matches end.
4. Sorted neighbours with a common prefix of an anchor's length form a class. Inside a class,
   the common prefix to the right and the common suffix to the left give the strings of
   ``length`` bytes that two places share; the later place loses them.

Skew: in a task's run, records that agree in both contexts are settled at once and only the
earliest is sent. Prefixes with more than ``MAX_CLASS`` distinct contexts are known from the digest
counts before any suffix is sorted: their records never reach the merge, but leave as string
digests, which are ranked by Spark, with the same result. A task sends a digest once for every
``HOT_RECORDS`` records, so a string that is everywhere costs one row a chunk.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm import repeats as R
from quillspark.llm.common import map_batches, plain_text, returning_memory, rows_of, stored, text_bytes
from quillspark.session import ship_package

GRAM = 20
#: Suffixes of a sorted run and anchors of a chunk: a worker holds one of either in memory.
RUN_RECORDS = 50_000
ANCHOR_CHUNK = 300_000
RECORDS_PER_RANGE = 150_000
HOT_RECORDS = 10_000
PAIRWISE = 12
MAX_CLASS = 200_000
_OUT = "digest long, doc long, ref long, n int, settled boolean"
_NAMES = ["digest", "doc", "ref", "n", "settled"]
_SORTED = "part int, run binary, " + _OUT

#: A suffix: (right bytes from the anchor, reversed bytes before it, doc, ref of the anchor).
Suffix = tuple[bytes, bytes, int, int]


def elements(text: bytes) -> np.ndarray:
    return np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)


def anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(seed, doc, ref, known, m): the anchors of all texts by the start of their run.

    ``known``: the same digest was met twice in the task; all but one of those get keys of
    their own. The one stands for their ``m`` different segments.
    """
    def of_texts(batches):
        for b in batches:
            for doc, text in rows_of(b, 0, 1):
                key = R.text_digest(text) << 32
                for base, lo, _, _, digest, segment in R.runs(elements(text), length, gram):
                    yield digest.view(np.int64), np.full(len(lo), doc, np.int64), lo + (base | key), segment

    def run(batches):
        for seed, doc, ref, segment in R.in_chunks(of_texts(batches), ANCHOR_CHUNK):
            _, first, group, count = np.unique(seed, return_index=True, return_inverse=True, return_counts=True)
            known = count[group] > 1
            one = np.zeros(len(seed), bool)
            one[first] = True
            order = np.lexsort((segment[known], group[known]))
            g, t = group[known][order], segment[known][order]
            new = np.ones(len(g), bool)
            new[1:] = (g[1:] != g[:-1]) | (t[1:] != t[:-1])
            different = np.maximum(np.bincount(g[new], minlength=len(first)), 1)
            m = np.where(one, different[group], 0).astype(np.int32)
            yield R.batch((np.where(one, seed, R.salted(doc, ref)), doc, ref, known, m), ["seed", "doc", "ref", "known", "m"])

    return map_batches(docs.select(R.doc_order().alias("doc"), text_bytes()), run,
                       "seed long, doc long, ref long, known boolean, m int")


def repeated_anchors(docs: DataFrame, length: int, gram: int, max_class: int = MAX_CLASS) -> DataFrame:
    """(doc, ref, n, hot): anchors whose digest occurs twice or more; ``hot`` is the digest, in at
    least one of its rows, if the chunks hold more than ``max_class`` different segments of it."""
    total = F.sum("m").over(Window.partitionBy("seed"))
    return (anchors(docs, length, gram).repartition(F.col("seed")).withColumn("total", total)
            .filter("known or total > 1")
            .select("doc", "ref", F.lit(1).alias("n"), F.when(F.col("total") > max_class, F.col("seed")).alias("hot")))


def splitters(docs: DataFrame, ranges: int, length: int, gram: int, texts: int = 2000) -> list[bytes]:
    """Prefixes that cut the suffixes into ranges of similar size, from a sample of about
    ``texts`` texts with at most 32 anchors each. They only balance the work."""
    n = docs.count()
    if ranges < 2 or not n:
        return []

    def run(batches):
        for b in batches:
            out = []
            for (text,) in rows_of(b, 0):
                for base, _, _, anchor, _, _ in R.runs(elements(text), length, gram, segments=False):
                    for a in anchor[::max(1, len(anchor) // 32)][:32].tolist():
                        out.append(text[base + a:base + a + gram])
                    break
            yield R.batch((out or [b""],), ["p"])

    sample = docs.select(text_bytes().alias("text")).sample(min(1.0, texts / n), seed=11)
    found = sorted(r.p for r in map_batches(sample, run, "p binary").collect())
    cuts = [bytes(found[len(found) * i // ranges]) for i in range(1, ranges)] if found else []
    return sorted(set(cuts) - {b""})


def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes are known."""
    top = min(len(a), len(b))
    if a[known:top] == b[known:top]:
        return top
    low, high = known, top
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def front_code(records: list[Suffix], settled: list[tuple[int, int, int]]) -> bytes:
    """A sorted run: common prefix lengths, rests and places, compressed; and the spans that
    the task has settled already."""
    shared, sizes, rests = [], [], []
    before = (b"", b"")
    for right, left, _, _ in records:
        for now, then in ((right, before[0]), (left, before[1])):
            p = common(now, then, 0)
            shared.append(p)
            sizes.append(len(now) - p)
            rests.append(now[p:])
        before = (right, left)
    parts = [np.array([len(records), len(settled)], "<i8"), np.array([x for r in records for x in r[2:]], "<i8"),
             np.array([x for s in settled for x in s], "<i8"), np.array(shared, "u1"), np.array(sizes, "u1")]
    return zstandard.ZstdCompressor(level=3).compress(b"".join([*(p.tobytes() for p in parts), *rests]))


def read_run(blob: bytes) -> tuple[Iterator[tuple[int, Suffix]], np.ndarray]:
    """((common prefix with the suffix before, suffix) in order, settled spans)."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, n_settled = np.frombuffer(raw, "<i8", 2).tolist()
    at = 16
    places = np.frombuffer(raw, "<i8", 2 * n, at).reshape(-1, 2)
    at += 16 * n
    settled = np.frombuffer(raw, "<i8", 3 * n_settled, at).reshape(-1, 3)
    at += 24 * n_settled
    shared = np.frombuffer(raw, "u1", 2 * n, at)
    sizes = np.frombuffer(raw, "u1", 2 * n, at + 2 * n)

    def walk(at: int):
        right = left = b""
        for i in range(0, n, 1024):  # numbers become Python objects a few at a time
            part = slice(2 * i, 2 * (i + 1024))
            lens = zip(shared[part][::2].tolist(), sizes[part][::2].tolist(),
                       shared[part][1::2].tolist(), sizes[part][1::2].tolist())
            for (p, k, q, m), (doc, ref) in zip(lens, places[i:i + 1024].tolist()):
                right = right[:p] + raw[at:at + k]
                left = left[:q] + raw[at + k:at + k + m]
                at += k + m
                yield p, (right, left, doc, ref)

    return walk(at + 4 * n), settled


def merge_runs(runs: list[Iterator[tuple[int, Suffix]]]) -> Iterator[tuple[int, Suffix]]:
    """Merge sorted runs; yields each suffix with its common prefix length with the one before.

    A loser tree whose players carry the length of their common prefix with the last winner.
    Of two players the one that agrees longer with the last winner is smaller; only at equal
    lengths are bytes compared, from there on.
    """
    leaves = 1 << max(0, len(runs) - 1).bit_length()
    head: list[Suffix | None] = [None] * leaves
    known = [0] * leaves
    for i, r in enumerate(runs):
        _, head[i] = next(r, (0, None))

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser)"""
        if head[b] is None:
            return a, b
        if head[a] is None:
            return b, a
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        x, y = head[a][0], head[b][0]
        p = common(x, y, known[a])
        if p == len(x) or (p < len(y) and x[p] < y[p]):
            known[b] = p
            return a, b
        known[a] = p
        return b, a

    loser = [0] * leaves
    winners = [0] * leaves + list(range(leaves))
    for node in range(leaves - 1, 0, -1):
        winners[node], loser[node] = play(winners[2 * node], winners[2 * node + 1])
    best = winners[1] if leaves > 1 else 0
    while head[best] is not None:
        yield known[best], head[best]
        known[best], head[best] = next(runs[best], (0, None))
        node = (best + leaves) // 2
        while node:
            best, loser[node] = play(best, loser[node])
            node //= 2


class Spans:
    """Rows of the result, gathered in columns."""

    def __init__(self) -> None:
        self.rows: tuple[list, ...] = ([], [], [], [], [])

    def add(self, doc: int, ref: int, n: int, digest: int = 0, settled: bool = True) -> None:
        for column, v in zip(self.rows, (digest, doc, ref, n, settled)):
            column.append(v)

    def __len__(self) -> int:
        return len(self.rows[0])

    def batch(self):
        import pyarrow as pa
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_())
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(self.rows, kinds)], names=_NAMES)
        self.rows = ([], [], [], [], [])
        return out


def _place(s: Suffix) -> tuple[int, int]:
    """(doc, anchor position): the order of strings at equal offsets from their anchors."""
    return s[2], s[3] & 0x7FFFFFFF


def keep_first(records: Iterable[Suffix], length: int, add) -> list[Suffix]:
    """One record for each pair of contexts, the earliest; all strings of the others go. Other texts
    at the same place (rows that share a doc_id) stay beside it, as they go only with it."""
    first: dict[tuple[bytes, bytes], Suffix] = {}
    tied: dict[tuple[bytes, bytes], dict[int, Suffix]] = {}
    for s in records:
        old = first.setdefault(s[:2], s)
        if old is s:
            continue
        if _place(old) == _place(s):
            if old[3] != s[3]:
                tied.setdefault(s[:2], {})[s[3]] = s
            continue
        late = [s]
        if _place(s) < _place(old):
            first[s[:2]] = s
            late = [old, *tied.pop(s[:2], {}).values()]
        for x in late:
            add(x[2], x[3] - len(x[1]), len(x[0]) + len(x[1]) - length + 1)
    return [*first.values(), *(s for others in tied.values() for s in others.values())]


def string_digests(s: Suffix, length: int) -> list[int]:
    """Digests of the strings of ``length`` bytes around an anchor, from the first on."""
    text = s[1][::-1] + s[0]
    return [xxhash.xxh64_intdigest(text[i:i + length]) - (1 << 63) for i in range(len(text) - length + 1)]


def settle_class(found: list[Suffix], length: int, gram: int, out: Spans, max_class: int) -> None:
    """Spans of a class: suffixes that agree in their first ``gram`` bytes."""
    for _ in settle_steps(found, length, gram, out, max_class):
        pass


def settle_steps(found: list[Suffix], length: int, gram: int, out: Spans, max_class: int) -> Iterator[None]:
    """``settle_class`` with a stop after every few rows, where ``out`` may be emptied."""
    found = keep_first(found, length, out.add)
    yield
    if len(found) < 2:
        return
    if len(found) > max_class:
        for s in found:
            for i, digest in enumerate(string_digests(s, length)):
                out.add(s[2], s[3] - len(s[1]) + i, 1, digest, False)
            yield
        return
    if len(found) <= PAIRWISE:
        for i, a in enumerate(found):
            for b in found[:i]:
                right, left = common(a[0], b[0], gram), common(a[1], b[1], 0)
                if right + left >= length and _place(a) != _place(b):
                    late = max(a, b, key=_place)
                    out.add(late[2], late[3] - left, right + left - length + 1)
        return
    for o in range(length - gram + 1):  # the strings that start ``o`` bytes before the anchor
        here = [s for s in found if length - len(s[0]) <= o <= len(s[1])]
        best: dict[tuple[bytes, bytes], tuple[int, int]] = {}
        keys = [(s[1][:o], s[0][:length - o]) for s in here]
        for k, s in zip(keys, here):
            best[k] = min(best.get(k, _place(s)), _place(s))
        for k, s in zip(keys, here):
            if best[k] < _place(s):
                out.add(s[2], s[3] - o, 1)
        yield


def sorted_runs(texts: DataFrame, wanted: DataFrame, cuts: list[bytes], length: int, gram: int,
                hot: Iterable[int] = ()) -> DataFrame:
    """Rows of ``_SORTED``: (part, run), front-coded runs of the suffixes at the wanted anchors, cut
    by range; and, without a run, the strings around anchors whose digest is ``hot``. A hot string
    that is not the first of its chunk is settled, the others are to be ranked."""
    import pyarrow as pa
    hot_digests = np.array(sorted(hot), np.int64)
    kinds = [pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_()]
    names = ["part", "run", *_NAMES]

    def suffixes(batches) -> Iterator[tuple[bool, Suffix]]:
        for b in batches:
            for doc, key, z, at in rows_of(b, 0, 1, 2, 3):
                text = R.unpack(z)
                starts = np.unique(np.array(at, np.int64) >> 7)
                for base, lo, hi, anchor, digest, _ in R.runs(elements(text), length, gram, segments=False):
                    take = np.isin(lo + base, starts, assume_unique=True)
                    is_hot = np.isin(digest[take].view(np.int64), hot_digests)
                    for i, j, a, h in zip((lo[take] + base).tolist(), (hi[take] + base).tolist(),
                                          (anchor[take] + base).tolist(), is_hot.tolist()):
                        yield h, (text[a:j + length], text[i:a][::-1], doc, a | key << 32)

    def emit(held: list[Suffix]):
        settled: list[tuple[int, int, int]] = []
        held = sorted(keep_first(held, length, lambda *s: settled.append(s)))
        parts: dict[int, list[Suffix]] = {}
        for s in held:
            parts.setdefault(bisect_right(cuts, s[0]), []).append(s)
        del held
        blobs = []
        for i, p in enumerate(sorted(parts)):
            blobs.append((p, front_code(parts.pop(p), settled if i == 0 else [])))
        columns = [[p for p, _ in blobs], [r for _, r in blobs]]
        return pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(columns, kinds)),
                                           *(pa.nulls(len(blobs), k) for k in kinds[2:])], names=names)

    def strings(columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(pa.nulls(len(columns[0]), k) for k in kinds[:2]),
                                           *(pa.array(c, k) for c, k in zip(columns, kinds[2:]))], names=names)

    def emit_hot(held: list[Suffix]):
        settled: list[tuple[int, int, int]] = []
        held = keep_first(held, length, lambda *s: settled.append(s))
        if settled:
            doc, ref, n = np.array(settled, np.int64).T
            yield strings((np.zeros(len(n), np.int64), doc, ref, n, np.ones(len(n), bool)))
        found = [np.array(string_digests(s, length), np.int64) for s in held]
        sizes = [len(d) for d in found]
        digest = np.concatenate(found)
        doc = np.repeat(np.array([s[2] for s in held], np.int64), sizes)
        ref = np.concatenate([np.arange(k) + (s[3] - len(s[1])) for s, k in zip(held, sizes)])
        first = R.first_of_equal(digest, doc, ref & 0x7FFFFFFF)
        yield strings((digest[first], doc[first], ref[first], np.ones(int(first.sum()), np.int32), np.zeros(int(first.sum()), bool)))
        gone = np.flatnonzero(~first)
        owner = np.repeat(np.arange(len(sizes)), sizes)[gone]
        start = np.flatnonzero(np.concatenate(([True], (np.diff(gone) != 1) | (np.diff(owner) != 0)))[:len(gone)])
        n = np.diff(np.append(start, len(gone)))
        at = gone[start]
        yield strings((np.zeros(len(at), np.int64), doc[at], ref[at], n, np.ones(len(at), bool)))

    def run(batches):
        held: list[Suffix] = []
        held_hot: list[Suffix] = []
        for is_hot, s in suffixes(batches):
            if is_hot:
                held_hot.append(s)
                if len(held_hot) >= HOT_RECORDS:
                    yield from emit_hot(held_hot)
                    held_hot = []
                continue
            held.append(s)
            if len(held) >= RUN_RECORDS:
                yield emit(held)
                held = []
        if held:
            yield emit(held)
        if held_hot:
            yield from emit_hot(held_hot)

    joined = R.with_spans(texts, wanted, "inner").select("__doc", "__tkey", "__z", "__at")
    return map_batches(joined, run, _SORTED)


def merged_spans(runs: DataFrame, ranges: int, length: int, gram: int, max_class: int) -> DataFrame:
    """Merge every range's runs and settle its classes: rows of ``_OUT``."""
    def run(batches):
        readers, out = [], Spans()
        for b in batches:
            for (blob,) in rows_of(b, 1):
                reader, settled = read_run(blob)
                readers.append(reader)
                for doc, ref, n in settled.tolist():
                    out.add(doc, ref, n)
                if len(out) > 50_000:
                    yield out.batch()
        found: list[Suffix] = []
        bound = 2 * max_class
        for shared, s in merge_runs(readers) if readers else ():
            if shared < gram and found:
                for _ in settle_steps(found, length, gram, out, max_class):
                    if len(out) > 50_000:
                        yield out.batch()
                found = []
            found.append(s)
            if len(found) > bound:  # equal contexts from different runs: one of each stays
                found = keep_first(found, length, out.add)
                bound = 2 * max(max_class, len(found))
        for _ in settle_steps(found, length, gram, out, max_class):
            if len(out) > 50_000:
                yield out.batch()
        yield out.batch()

    return map_batches(runs.select("part", "run").repartitionById(ranges, F.col("part")), run, _OUT)


def repeated_spans(docs: DataFrame, texts: DataFrame, length: int, gram: int = GRAM,
                   max_class: int = MAX_CLASS) -> DataFrame:
    """(doc, ref, n): n strings of ``length`` bytes from a start, each of which starts earlier."""
    wanted = stored(repeated_anchors(docs, length, gram, max_class), "suffix-anchors")
    n, hot = wanted.agg(F.count("*"), F.collect_set("hot")).first()  # at most one digest for max_class anchors
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // RECORDS_PER_RANGE))
    cuts = splitters(docs, ranges, length, gram)
    runs = sorted_runs(texts, wanted, cuts, length, gram, hot)
    if hot:  # read twice: runs to be merged, strings to be ranked
        runs = stored(runs, "suffix-runs")
    merged = stored(merged_spans(runs.filter("run is not null"), len(cuts) + 1, length, gram, max_class), "suffix-spans")
    if hot:
        merged = merged.unionAll(runs.filter("run is null").select(*_NAMES))
    rank = F.rank().over(Window.partitionBy("digest").orderBy(*R.first_start()))
    large = merged.filter("not settled").withColumn("rank", rank).filter("rank > 1")
    return merged.filter("settled").select("doc", "ref", "n").unionAll(large.select("doc", "ref", "n"))


def remove_repeated_bytes(docs: DataFrame, length: int = 100, max_class: int = MAX_CLASS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per input row.

    A byte goes when it lies in a string of ``length`` bytes that also starts earlier: in a
    smaller doc_id, or earlier in the same document. Strings are judged on the input.

    Edge cases: null texts count as empty; texts under ``length`` bytes lose nothing; rows that
    share a doc_id count as one document at one place, so identical rows do not remove each
    other; null doc_ids come after all others; texts are read whole, long ones in blocks; other
    columns are not read; an empty table gives an empty result.
    """
    ship_package(docs.sparkSession)
    texts = R.carriers(docs, ["doc_id"])
    joined = R.with_spans(texts, repeated_spans(docs, texts, length, max_class=max_class), "left")

    @F.pandas_udf("n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    @returning_memory
    def remove(z: pd.Series, at: pd.Series) -> pd.DataFrame:
        out = []
        for packed, spans in zip(z, at):
            raw = np.frombuffer(R.unpack(packed), np.uint8)
            gone = R.covered(len(raw), spans, length)
            edges = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[:1].sum())
            out.append((len(raw), int(gone.sum()), edges, hashlib.sha256(raw[~gone].tobytes()).hexdigest()))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return joined.select(F.col("doc_id").cast("long").alias("doc_id"), remove("__z", "__at").alias("__r")).select("doc_id", "__r.*")


def drop_repeated_text(docs: DataFrame, length: int = 100) -> DataFrame:
    """``docs`` (all its columns) with repeated text cut out of ``text``; ``n_chars`` follows.

    A character goes when all its bytes lie in repeated strings, so the text stays valid. Null
    texts become empty; rows never go, even when all their text does; bytes that are not UTF-8
    become U+FFFD.
    """
    ship_package(docs.sparkSession)
    texts = R.carriers(docs, [*docs.columns])
    joined = R.with_spans(texts.drop("text"), repeated_spans(docs, texts, length), "left")

    @F.pandas_udf("string")
    @returning_memory
    def cut(z: pd.Series, at: pd.Series) -> pd.Series:
        out = []
        for packed, spans in zip(z, at):
            text = R.unpack(packed)
            raw = np.frombuffer(text, np.uint8)
            gone = R.covered(len(raw), spans, length)
            if gone.any():
                start = np.union1d(0, np.flatnonzero((raw & 0xC0) != 0x80))
                whole = np.minimum.reduceat(gone, start)
                text = raw[~np.repeat(whole, np.diff(np.append(start, len(raw))))].tobytes()
            out.append(plain_text(text))
        return pd.Series(out, dtype="object")

    kept = joined.withColumn("text", cut("__z", "__at"))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast("long"))
    return kept.select(*docs.columns)
