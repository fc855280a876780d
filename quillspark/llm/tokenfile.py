"""Token-id files in Simple-8b words, with per-block offsets for vectorised decoding.

A 64-bit word holds a 4-bit selector and up to 60 bits of ids of one width. Ids are coded in
blocks of ``BLOCK`` ids; no word crosses a block, so any block can be read alone. An id that
needs more than 60 bits is an escape: a word with selector 0, then the id as a raw word.

Files are rows (file_no, segment_no, payload) that Spark's own writer commits to shared
storage, so any file system Spark can reach will do and lost executors are retried. ``file_no``
ascends with doc_id (range partitions), segments ascend within a file, and documents ascend
within a segment. A segment's payload, little-endian:

    8 bytes magic, then int64 n_docs, n_ids, n_blocks, n_words
    int64 doc_id x n_docs, uint8 doc_id-is-null x n_docs, uint32 ids per doc x n_docs
    uint32 first word of block x n_blocks
    uint64 words x n_words
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.llm.common import map_batches, plain_text, rows_of, text_bytes
from quillspark.llm.tokens import encoder
from quillspark.session import scratch_path

BLOCK = 4096
SEGMENT_IDS = 2_000_000
_MAGIC = b"S8BTOK01"
_HEADER = struct.Struct("<8s4q")
#: Fixed values of the format: ids per word and bits per id of selectors 2 to 15.
PER_WORD = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = 0


def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits that each id needs (0 for 0)."""
    high = np.frexp((ids >> np.uint64(32)).astype(np.float64))[1]
    low = np.frexp((ids & np.uint64(0xFFFFFFFF)).astype(np.float64))[1]
    return np.where(high > 0, high + 32, low).astype(np.uint8)


def _greedy_steps(width: np.ndarray) -> np.ndarray:
    """For every place of a (blocks x BLOCK) table: how many ids the widest-packing word takes."""
    pad = np.full((width.shape[0], 64), 255, np.uint8)
    table = np.concatenate([width, pad], axis=1)

    def reach(a: np.ndarray, by: int) -> np.ndarray:
        """Maximum of ``a`` and ``a`` shifted by ``by`` places (beyond the end: too wide)."""
        out = a.copy()
        np.maximum(out[:, :-by], a[:, by:], out=out[:, :-by])
        out[:, -by:] = 255
        return out

    spans = {1: table}
    for n, base, by in ((2, 1, 1), (3, 2, 1), (4, 2, 2), (5, 4, 1), (6, 4, 2), (7, 4, 3), (8, 4, 4), (10, 8, 2),
                        (12, 8, 4), (15, 8, 7), (20, 12, 8), (30, 20, 10), (60, 30, 30)):
        spans[n] = reach(spans[base], by)
    steps = np.ones_like(table)
    for n, bits in sorted(zip(PER_WORD, BITS)):
        steps[spans[n] <= bits] = n
    return steps[:, :BLOCK]


def simple8b_encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, first word of each block) for an array of unsigned 64-bit ids."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.uint32)
    width = np.full(blocks * BLOCK, 255, np.uint8)
    width[:n] = _widths(ids)
    steps = _greedy_steps(width.reshape(blocks, BLOCK))
    size = np.full(blocks, BLOCK, np.int64)
    size[-1] = n - (blocks - 1) * BLOCK
    base, cursor, live, found = np.arange(blocks) * BLOCK, np.zeros(blocks, np.int64), np.arange(blocks), []
    while len(live):  # one word of every block at a time
        found.append(base[live] + cursor[live])
        cursor[live] += steps[live, cursor[live]]
        live = live[cursor[live] < size[live]]
    at = np.sort(np.concatenate(found))
    per = steps.reshape(-1)[at]
    escape = width[at] > 60
    place = np.arange(len(at)) + np.cumsum(escape) - escape
    words = np.zeros(len(at) + int(escape.sum()), np.uint64)
    for selector, (count, bits) in enumerate(zip(PER_WORD, BITS), 2):
        here = np.flatnonzero((per == count) & ~escape)
        value = np.full(len(here), selector << 60, np.uint64)
        for j in range(count):
            value |= ids[at[here] + j] << np.uint64(bits * j)
        words[place[here]] = value
    words[place[escape] + 1] = ids[at[escape]]
    return words, place[np.searchsorted(at, base)].astype(np.uint32)


def simple8b_decode(words: np.ndarray) -> np.ndarray:
    """The ids of consecutive words (a block or any number of whole blocks)."""
    words = np.ascontiguousarray(words, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    for i in np.flatnonzero(selector == ESCAPE):
        if not raw[i]:
            raw[i + 1] = True
    per = np.array([1, 0, *PER_WORD], np.int64)[selector]
    per[raw] = 0
    first = np.cumsum(per) - per
    out = np.zeros(int(per.sum()), np.uint64)
    for s, (count, bits) in enumerate(zip(PER_WORD, BITS), 2):
        here = np.flatnonzero((selector == s) & ~raw)
        mask = np.uint64((1 << bits) - 1)
        for j in range(count):
            out[first[here] + j] = (words[here] >> np.uint64(bits * j)) & mask
    escaped = np.flatnonzero((selector == ESCAPE) & ~raw)
    out[first[escaped]] = words[escaped + 1]
    return out


def encode_segment(doc_ids: list[int | None], docs: list[np.ndarray]) -> bytes:
    ids = np.concatenate(docs).astype(np.uint64) if docs else np.empty(0, np.uint64)
    words, first = simple8b_encode(ids)
    null = np.array([d is None for d in doc_ids], np.uint8)
    return b"".join([
        _HEADER.pack(_MAGIC, len(docs), len(ids), len(first), len(words)),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), null.tobytes(),
        np.array([len(d) for d in docs], "<u4").tobytes(), first.astype("<u4").tobytes(), words.astype("<u8").tobytes()])


class Segment:
    """A segment read back: documents, and ids by block."""

    def __init__(self, payload: bytes) -> None:
        magic, n_docs, self.n_ids, n_blocks, n_words = _HEADER.unpack_from(payload)
        if magic != _MAGIC:
            raise ValueError("not a token segment")
        at = _HEADER.size

        def part(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, n, at)
            at += out.nbytes
            return out

        ids, null = part("<i8", n_docs), part("u1", n_docs)
        self.doc_ids = [None if z else d for d, z in zip(ids.tolist(), null.tolist())]
        self.lengths = part("<u4", n_docs).astype(np.int64)
        self.first_word = part("<u4", n_blocks)
        self.words = part("<u8", n_words)

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids from ``start`` up to ``stop``; only the blocks that hold them are decoded."""
        stop = self.n_ids if stop is None else stop
        if stop <= start:
            return np.empty(0, np.uint64)
        a, b = start // BLOCK, -(-stop // BLOCK)
        end = self.first_word[b] if b < len(self.first_word) else len(self.words)
        return simple8b_decode(self.words[self.first_word[a]:end])[start - a * BLOCK:stop - a * BLOCK]


#: Where null doc_ids stand: before all others.
_NULL = -(1 << 63)


def range_cuts(docs: DataFrame, parts: int) -> np.ndarray:
    """Cuts between ``parts`` ranges of doc_id that hold about equally many rows. An id that
    fills several ranges is a cut several times."""
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL)).cast("double").alias("d"))
    cuts = ids.approxQuantile("d", [i / parts for i in range(1, parts)], 0.2 / parts) if parts > 1 else []
    return np.array(sorted(min(int(c), (1 << 63) - 1) for c in cuts), np.int64)


def range_of(ids: np.ndarray, cuts: np.ndarray, first: int) -> np.ndarray:
    """The range of each doc_id, in their order; rows of an id that is a cut take turns over the
    ranges on both sides of it (and between), starting with the ``first`` one."""
    low, high = np.searchsorted(cuts, ids, "left"), np.searchsorted(cuts, ids, "right")
    return low + (first + np.arange(len(ids))) % (high - low + 1)


def encoded(docs: DataFrame, tokenizer: str, end_id: int, cuts: np.ndarray) -> DataFrame:
    """(part, doc_id, width, ids): the range of doc_ids, and every text's ids and the end id, as
    little-endian integers of ``width`` bytes (2 where they suffice)."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encode, n = encoder(tokenizer).encode, 0
        for b in batches:
            width, packed = [], []
            for (text,) in rows_of(b, 1):
                ids = np.frombuffer(encode(plain_text(text)) + end, "<u4")
                width.append(2 if ids.max() < 1 << 16 else 4)
                packed.append(ids.astype(f"<u{width[-1]}").tobytes())
            part = range_of(b.column(0).fill_null(_NULL).to_numpy(), cuts, n)
            n += len(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), b.column(0), pa.array(width, pa.int32()), pa.array(packed, pa.binary())],
                names=["part", "doc_id", "width", "ids"])

    return map_batches(docs.select(F.col("doc_id").cast("long"), text_bytes()), run,
                       "part int, doc_id long, width int, ids binary")


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int = 1,
                      segment_ids: int = SEGMENT_IDS) -> None:
    """Tokenise every text, append ``end_id`` and write the files to ``path`` in doc_id order.

    Texts are encoded where they are read, and their ids go to ranges of doc_id.
    Null texts count as empty. Rows with equal doc_ids follow each other, in no fixed order of
    their texts, over as many ranges as they need; null doc_ids come first.
    """
    def run(batches):
        file_no, segment_no, n = TaskContext.get().partitionId(), 0, 0
        names, held = [], []

        def segment():
            return pa.RecordBatch.from_arrays(
                [pa.array([file_no], pa.int32()), pa.array([segment_no], pa.int32()),
                 pa.array([n], pa.int64()), pa.array([encode_segment(names, held)], pa.binary())],
                names=["file_no", "segment_no", "n_ids", "payload"])

        for b in batches:
            for doc, width, ids in rows_of(b, 1, 2, 3):
                names.append(doc)
                held.append(np.frombuffer(ids, f"<u{width}"))
                n += len(held[-1])
                if n >= segment_ids:
                    yield segment()
                    segment_no, n, names, held = segment_no + 1, 0, [], []
        if names:
            yield segment()

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = range_cuts(docs, parts)
    rows = encoded(docs, tokenizer, end_id, cuts).repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions("doc_id")
    files = map_batches(rows, run, "file_no int, segment_no int, n_ids long, payload binary")
    files.write.option("compression", "none").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    files = spark.read.parquet(path)
    sizes = files.select("file_no", "segment_no", "n_ids")
    # one row a file: as many as the writer had partitions
    per_file = sizes.groupBy("file_no").agg(F.sum("n_ids").alias("n"))
    before = per_file.select(F.col("file_no").alias("f"), F.coalesce(F.sum("n").over(
        Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("file_start"))
    inside = sizes.select("file_no", "segment_no", F.coalesce(F.sum("n_ids").over(
        Window.partitionBy("file_no").orderBy("segment_no")
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("in_file"))
    starts = (inside.join(before, F.col("file_no") == F.col("f"))
              .select(F.col("file_no").alias("f"), F.col("segment_no").alias("s"),
                      (F.col("file_start") + F.col("in_file")).alias("segment_start")))

    def run(batches):
        for b in batches:
            for file_no, segment_no, payload in rows_of(b, 0, 1, 2):
                seg = Segment(payload)
                ids = seg.ids().astype("<u4").tobytes()
                stop = np.cumsum(seg.lengths)
                start = stop - seg.lengths
                crc = [zlib.crc32(ids[4 * i:4 * j]) for i, j in zip(start.tolist(), stop.tolist())]
                n = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file_no] * n, pa.int32()), pa.array([segment_no] * n, pa.int32()),
                     pa.array(seg.doc_ids, pa.int64()), pa.array(start), pa.array(seg.lengths),
                     pa.array(crc, pa.int64())],
                    names=["file_no", "segment_no", "doc_id", "at", "n_tokens", "ids_crc32"])

    read = map_batches(files.select("file_no", "segment_no", "payload"), run,
                       "file_no int, segment_no int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return (read.join(starts, (F.col("file_no") == F.col("f")) & (F.col("segment_no") == F.col("s")))
            .select("doc_id", (F.col("segment_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"))


def token_files(docs: DataFrame, tokenizer: str, path: str | None = None, end_id: int = 1) -> DataFrame:
    """Write ``docs`` as token files and return what reading them back gives, a row per document.

    ``path``: a new folder in shared storage; by default below the checkpoint folder.

    Edge cases: null and empty texts hold only the end id; bytes that are not UTF-8 count as
    U+FFFD; see ``write_token_files`` for equal and null doc_ids; other columns are not read; an
    empty table writes no segment and gives an empty result.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-files")
    write_token_files(docs, tokenizer, path, end_id)
    return read_token_files(spark, path)
