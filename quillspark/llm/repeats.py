"""Shared parts of the two exact repeat removers (words, bytes): anchors, carriers, removal.

Windows of ``length`` elements are covered by winnowed anchors: in every window the k-gram
with the least digest is selected (Schleimer et al., "Winnowing"). The choice depends on the
window's content alone, so equal windows have their anchor at the same offset, and a window can
repeat only where its anchor repeats. Consecutive windows with one anchor form a run; its
text, the run's segment, is at most ``2 * length`` elements long.

Positions travel as (doc, ref): ``doc`` is the doc_id (null: the largest long, so null ids come
last), ``ref`` holds 31 bits of a digest of the text and a 31-bit start. Rows that share a
doc_id count as one document: a window is removed when its content also starts at a smaller
(doc_id, start).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NO_ID = (1 << 63) - 1
_PRIME = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
BLOCK = 1 << 20
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): close inputs get unrelated outputs."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def roll(h: np.ndarray, n: int) -> np.ndarray:
    """Polynomial digest of every ``n`` consecutive elements, by doubling."""
    out, size, part, width = None, 0, h, 1
    while True:
        if n & width:
            if out is None:
                out, size = part, width
            else:  # the part goes in front of what is there
                m = len(h) - size - width + 1
                out = part[:m] * np.uint64(pow(_PRIME, size, 1 << 64)) + out[width:width + m]
                size += width
        if size == n:
            return out
        m = len(h) - 2 * width + 1
        part = part[:m] * np.uint64(pow(_PRIME, width, 1 << 64)) + part[width:width + m]
        width *= 2


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the digest's base and of its inverse modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(12, (n - 1).bit_length())
        for name, base in (("up", _PRIME), ("down", pow(_PRIME, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def runs(h: np.ndarray, length: int, gram: int, block: int = BLOCK, segments: bool = True):
    """(base, lo, hi, anchor, digest, segment) arrays, a block of windows at a time.

    Window starts lo..hi (counted from ``base``) share the anchor at ``anchor``, whose k-gram
    has ``digest``; ``segment`` digests all their text (None if not wanted). Blocks bound the
    memory of long texts.
    """
    width = length - gram + 1
    for base in range(0, len(h) - length + 1, block):
        part = h[base:base + block + length - 1]
        g = mix(roll(part, gram))
        low = (g & np.uint64(_MASK ^ 0x7FFFFFFF)) | np.arange(len(g), dtype=np.uint64)
        size = 1
        while 2 * size <= width:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        if size < width:
            low = np.minimum(low[:size - width], low[width - size:])
        at = (low & np.uint64(0x7FFFFFFF)).astype(np.int64)
        change = np.flatnonzero(at[1:] != at[:-1]) + 1
        lo = np.concatenate(([0], change))
        hi = np.concatenate((change - 1, [len(at) - 1]))
        if not segments:
            yield base, lo, hi, at[lo], g[at[lo]], None
            continue
        up, down = _powers(len(part) + 1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(part * up[:len(part)])))
        end = hi + length
        segment = mix((total[end] - total[lo]) * down[lo] ^ (end - lo).astype(np.uint64))
        yield base, lo, hi, at[lo], g[at[lo]], segment


def batch(columns, names) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def in_chunks(rows, size: int = 400_000):
    """Concatenate tuples of arrays until they hold ``size`` rows."""
    held, n = [], 0
    for r in rows:
        held.append(r)
        n += len(r[0])
        if n >= size:
            yield [np.concatenate(c) for c in zip(*held)]
            held, n = [], 0
    if n:
        yield [np.concatenate(c) for c in zip(*held)]


def text_digest(text: bytes) -> int:
    return xxhash.xxh32_intdigest(text) >> 1


def salted(doc: np.ndarray, ref: np.ndarray) -> np.ndarray:
    """A key of its own for rows that need no partner."""
    return mix(doc.astype(np.uint64) * np.uint64(_PRIME) ^ mix(ref.astype(np.uint64))).view(np.int64)


def first_of_equal(key: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each row, whether no row with its key has a smaller (doc, start)."""
    order = np.lexsort((start, doc, key))
    k, d, s = key[order], doc[order], start[order]
    new = np.concatenate(([True], k[1:] != k[:-1]))
    head = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
    out = np.empty(len(key), bool)
    out[order] = (d == d[head]) & (s == s[head])
    return out


def doc_order() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))


def first_start() -> list[Column]:
    """Rows of a key by (doc, start); ties are one position."""
    return [F.col("doc"), F.col("ref").bitwiseAND(F.lit(0x7FFFFFFF))]


def carriers(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` plus __doc, __tkey and the text as compressed bytes __z, ready to shuffle."""
    from quillspark.llm.common import returning_memory, text_bytes
    from quillspark.session import ship_package
    ship_package(docs.sparkSession)

    @F.pandas_udf("tkey long, z binary")
    @returning_memory
    def carry(texts: pd.Series) -> pd.DataFrame:
        pack = zstandard.ZstdCompressor(level=1).compress
        return pd.DataFrame({"tkey": [text_digest(t) for t in texts], "z": [pack(t) for t in texts]})

    out = docs.select(*columns, doc_order().alias("__doc"), carry(text_bytes()).alias("__c"))
    return out.select(*columns, "__doc", F.col("__c.tkey").alias("__tkey"), F.col("__c.z").alias("__z"))


def with_spans(texts: DataFrame, spans: DataFrame, how: str) -> DataFrame:
    """Join carriers with their spans (doc, ref, n) as the list __at of start * 128 + n."""
    per_doc = spans.select(
        F.col("doc").alias("__d"), F.shiftright("ref", 32).alias("__t"),
        (F.col("ref").bitwiseAND(F.lit(0x7FFFFFFF)) * 128 + F.col("n")).alias("at")
    ).groupBy("__d", "__t").agg(F.collect_list("at").alias("__at"))
    return texts.join(per_doc, (F.col("__doc") == F.col("__d")) & (F.col("__tkey") == F.col("__t")), how).drop("__d", "__t")


def unpack(z: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(z)


def covered(n: int, at, length: int) -> np.ndarray:
    """Which of ``n`` elements lie in the spans: n windows from each start, ``length`` each."""
    if at is None or not len(at) or not n:
        return np.zeros(n, bool)
    at = np.asarray(at, np.int64)
    start, stop = at >> 7, (at >> 7) + (at & 127) - 1 + length
    edge = np.bincount(start, minlength=n + 1)[:n + 1] - np.bincount(stop, minlength=n + 1)[:n + 1]
    return np.cumsum(edge)[:n] > 0
