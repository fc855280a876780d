"""Document fingerprints by content-defined chunking.

A gear hash runs over the text's bytes; a chunk ends where the hash of the last 32 bytes meets
a mask. Chunking is normalised: up to the wanted size a stricter mask must be met, beyond it an
easier one, so sizes stay close to the mean, and no chunk is longer than ``MOST``. Boundaries
depend on nearby bytes only: an edit changes the chunks it touches, and the others keep their
digests wherever they move to.

A fingerprint is the set of chunk digests with their lengths; the likeness of A to B is the
share of A's chunk bytes that B has too (containment).

Neighbours by doc_id need each document beside the next one: documents are dealt into ranges of
doc_id with explicit bounds, a range's first document is also sent to the range before it, and
every range is read in order. Texts are shuffled once, compressed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import map_batches, plain_text, rows_of, text_bytes
from quillspark.session import ship_package

LEAST, WANTED, MOST = 12, 32, 96
#: Bits that must be zero: 6 before the wanted size, 4 beyond it.
STRICT, EASY = np.uint32(0xFC000000), np.uint32(0xF0000000)
BLOCK = 1 << 22


def _gear() -> np.ndarray:
    """One number a byte value, from a fixed rule."""
    return np.array([xxhash.xxh32_intdigest(bytes([b]), 1) for b in range(256)], np.uint32)


GEAR = _gear()


def boundaries(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``, the last being its length."""
    n = len(data)
    strict: list[int] = []
    easy: list[int] = []
    for at in range(0, n, BLOCK):  # blocks overlap by the 31 bytes the hash looks back
        back = min(31, at)
        h = GEAR[np.frombuffer(data, np.uint8, min(BLOCK, n - at) + back, at - back)]
        for width in (1, 2, 4, 8, 16):
            h[width:] += h[:-width] << np.uint32(width)
        h = h[back:]
        hits = np.flatnonzero((h & EASY) == 0)
        easy += (hits + at + 1).tolist()
        strict += (hits[(h[hits] & STRICT) == 0] + at + 1).tolist()
    ends, start, i, j, n_strict, n_easy = [], 0, 0, 0, len(strict), len(easy)
    while start < n:
        limit, soft = start + MOST, start + WANTED
        while i < n_strict and strict[i] < start + LEAST:
            i += 1
        if i < n_strict and strict[i] <= soft:
            end = strict[i]
        else:
            while j < n_easy and easy[j] <= soft:
                j += 1
            end = easy[j] if j < n_easy and easy[j] <= limit else limit
        start = min(end, n)
        ends.append(start)
    return ends


def chunks(data: bytes) -> dict[int, int]:
    """digest (48 bits) -> length of the distinct chunks."""
    start, out = 0, {}
    h = xxhash.xxh64_intdigest
    for end in boundaries(data):
        out[h(data[start:end]) >> 16] = end - start
        start = end
    return out


def fingerprint(found: dict[int, int]) -> str:
    """Chunk digests and lengths in digest order: 12 and 2 hex digits each."""
    return "".join([f"{d:012x}{n:02x}" for d, n in sorted(found.items())])


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    """Share of a's chunk bytes whose chunks b has too; of nothing: 1 in nothing, else 0."""
    if not a:
        return 0.0 if b else 1.0
    return sum(n for d, n in a.items() if d in b) / sum(a.values())


def edit(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of the start of ``following``."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


def _ranges(docs: DataFrame, parts: int) -> list[int]:
    """Upper bounds (inclusive) of doc_id ranges of similar row counts; the last range is open."""
    cuts = docs.filter("doc_id is not null").select(F.col("doc_id").cast("double").alias("d")).approxQuantile(
        "d", [i / parts for i in range(1, parts)], 0.2 / parts) if parts > 1 else []
    return sorted({int(c) for c in cuts})


def fingerprint_documents(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """One row per input row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    The next document is the one with the next smaller doc_id (after the smallest: the
    largest); ``near_*`` are containments of the document's own chunks.

    Edge cases: null texts count as empty, and an empty text's fingerprint is empty; rows with
    equal doc_ids follow each other in text order, null doc_ids come last in the order; a table
    of one row is its own next document; texts are read whole; bytes that are not UTF-8 are
    fingerprinted as they are and edited as U+FFFD; other columns are not read; an empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    ship_package(spark)
    if parts is None:
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    index = np.array(_ranges(docs, parts), np.int64)

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:  # a null id is below every bound
        known = ids.notna()
        out = np.zeros(len(ids), np.int32)
        out[known] = np.searchsorted(index, ids[known].astype("int64"), "left")
        return pd.Series(out)

    # The first document (largest id) of every range, by id and text digest: a row a range.
    heads = [(r.part, r.head) for r in
             docs.select(range_of(F.col("doc_id").cast("long")).alias("part"), F.struct("doc_id", F.sha2(text_bytes(), 256).alias("h")).alias("k"))
             .groupBy("part").agg(F.max("k").alias("head")).orderBy("part").collect()]
    if not heads:
        return docs.sparkSession.createDataFrame([], _SCHEMA)
    target = {(h.doc_id, h.h): heads[(i + 1) % len(heads)][0] for i, (_, h) in enumerate(heads)}

    def deal(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        sent = set()
        for b in batches:
            part, doc, order, copy, z = [], [], [], [], []
            for d, t in rows_of(b, 0, 1):
                own = 0 if d is None else int(np.searchsorted(index, d, "left"))
                digest = hashlib.sha256(t).hexdigest()
                packed = pack(t)
                rows = [(own, False)]
                if (d, digest) in target and (d, digest) not in sent:
                    sent.add((d, digest))
                    rows.append((target[d, digest], True))
                for p, c in rows:
                    part.append(p)
                    doc.append(d)
                    order.append(digest)
                    copy.append(c)
                    z.append(packed)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(doc, pa.int64()), pa.array(order), pa.array(copy),
                 pa.array(z, pa.binary())], names=["part", "doc_id", "h", "copy", "z"])

    dealt = map_batches(docs.select(F.col("doc_id").cast("long"), text_bytes()), deal,
                        "part int, doc_id long, h string, copy boolean, z binary")
    # Largest id first; the borrowed head of the next range closes the range.
    ranged = (dealt.repartition(F.col("part"))
              .sortWithinPartitions("part", "copy", F.col("doc_id").desc_nulls_last(), F.col("h").desc()))
    return map_batches(ranged, _neighbours, _SCHEMA)


_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def _neighbours(batches):
    """Rows of ranges in order -> a result row for each document and the one after it."""
    unpack = zstandard.ZstdDecompressor().decompress
    names = [c.split()[0] for c in _SCHEMA.split(", ")]
    last = None  # (part, doc_id, text, chunks) still waiting for its next document
    for b in batches:
        out = []
        for part, doc, copy, z in rows_of(b, 0, 1, 3, 4):
            data = unpack(z)
            text, own = plain_text(data), chunks(data)
            if last is not None and last[0] == part:
                _, before, before_text, before_chunks = last
                edited = edit(before_text, text).encode()
                edited_chunks = chunks(edited)
                out.append((before, len(before_text), hashlib.sha256(edited).hexdigest(), fingerprint(before_chunks),
                            fingerprint(edited_chunks), containment(before_chunks, edited_chunks),
                            containment(before_chunks, own)))
            last = None if copy else (part, doc, text, own)
        if out:
            frame = pd.DataFrame(out, columns=names)
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield pa.RecordBatch.from_pandas(frame, preserve_index=False)
