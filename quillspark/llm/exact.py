"""Exact duplicates by an extendible-hash index on shared files.

1. Entries. One pass over the texts writes, to shared files, a row for every document (its
   class and digest) and an entry for every class: the texts that a task found equal, byte for
   byte, within a bounded memory. An entry has the 64-bit key of its text, the number of rows,
   the row that would stay, and the packed text. A group of copies that fills a third of the
   table thus has about one entry a task.
2. Directory. The entries are counted by leading key bits. Extendible hashing starts from one
   bucket; a bucket whose entries are over the capacity splits on its next key bit, and the
   directory doubles when a bucket is deeper than it. Where the counted bits are not fine enough
   for an overfull bucket, its entries alone are counted again by more bits. A directory slot
   names a bucket; there are at most ``2 ** MAX_DEPTH`` slots, so the table of slots that is
   joined to the entries has a proven bound. The capacity follows the table, so the number of
   buckets does not outgrow that bound; a bucket that cannot split any more is only a longer one.
3. Owners. Buckets are key ranges; each goes to one owner task, which reads its entries in key
   order. Entries with equal keys form a chain: an entry joins the element whose bytes equal its
   own, else it starts a new element. The owner writes the finished buckets to shared files.
4. Every document looks up the element of its class (documents that are alone need no lookup).
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from quillspark.llm.common import map_batches, rows_of, stored, text_bytes

#: Fixed value of the contract: the characters that equality ignores.
IGNORED = b" \t\n\x0b\x0c\r"
#: Bytes of texts that a task remembers to find equal ones before they are sent.
REMEMBERED = 32 << 20
#: Packed bytes and entries of a bucket. With more than 2**WANTED_DEPTH such buckets, the
#: capacity grows instead.
BUCKET_BYTES, BUCKET_ENTRIES = 32 << 20, 250_000
WANTED_DEPTH, MAX_DEPTH = 17, 20
#: Entries written as one batch.
BATCH = 1000

_ENTRY = "row_no long, doc_id long, n_chars long, digest binary, class_no long, key long, n_rows long, packed binary"
_BUCKET = "bucket int, key long, place int, class_no long, keep_id long, keep_row long, group_size long"


def normalised(text: bytes) -> bytes:
    return text.translate(None, IGNORED)


def text_key(text: bytes) -> int:
    """The 64-bit key of a normalised text, as Spark's long."""
    h = xxhash.xxh64_intdigest(text)
    return h - (1 << 64) if h >> 63 else h


def stays_before(n_chars: int, doc_id: int | None, row_no: int) -> tuple:
    """Orders the rows of a group: most characters, smallest doc_id (null last), first row."""
    return -n_chars, doc_id is None, doc_id or 0, row_no


class _Class:
    __slots__ = ("text", "class_no", "n_rows", "best", "doc_id")

    def __init__(self, text: bytes, class_no: int) -> None:
        self.text, self.class_no, self.n_rows, self.best, self.doc_id = text, class_no, 0, None, None

    def add(self, n_chars: int, doc_id: int | None, row_no: int) -> None:
        order = stays_before(n_chars, doc_id, row_no)
        self.n_rows += 1
        if self.best is None or order < self.best:
            self.best, self.doc_id = order, doc_id


def _scan(key_of, limit: int, carried: bool):
    """Rows (doc_id, n_chars, text[, carried]) -> document rows, and entries of the classes."""
    def run(batches):
        base = TaskContext.get().partitionId() << 33
        pack = zstandard.ZstdCompressor(level=1).compress
        known: OrderedDict[int, list[_Class]] = OrderedDict()  # least recently met first
        held, row_no, class_no, ready = 0, base, base, []

        def entries(classes: list[tuple[int, _Class]]):
            nothing = [None] * len(classes)
            columns = [pa.array([-c.best[0] for _, c in classes], pa.int64()),
                       pa.array(nothing, pa.binary()),
                       pa.array([c.class_no for _, c in classes], pa.int64()),
                       pa.array([k for k, _ in classes], pa.int64()),
                       pa.array([c.n_rows for _, c in classes], pa.int64()),
                       pa.array([pack(c.text) for _, c in classes], pa.binary())]
            first = [pa.array([c.best[3] for _, c in classes], pa.int64()),
                     pa.array([c.doc_id for _, c in classes], pa.int64())]
            names = ["row_no", "doc_id", "n_chars", "digest", "class_no", "key", "n_rows", "packed"]
            if carried:
                columns.append(pa.nulls(len(classes), kind))
                names.append("row")
            return pa.RecordBatch.from_arrays(first + columns, names=names)

        kind = None
        for b in batches:
            out = []
            if carried:
                kind = b.column(3).type
            for doc, n_chars, text in rows_of(b, 0, 1, 2):
                text = normalised(text)
                key = key_of(text)
                chain = known.get(key)
                if chain is None:
                    chain = known[key] = []
                else:
                    known.move_to_end(key)
                mine = next((c for c in chain if c.text == text), None)
                if mine is None:
                    mine = _Class(text, class_no)
                    chain.append(mine)
                    class_no += 1
                    held += len(text) + 300
                mine.add(n_chars, doc, row_no)
                out.append((row_no, doc, n_chars, hashlib.sha256(text).digest(), mine.class_no))
                row_no += 1
                while held > limit and len(known) > 1:
                    old, gone = known.popitem(last=False)
                    held -= sum(len(c.text) + 300 for c in gone)
                    ready += [(old, c) for c in gone]
                if len(ready) >= BATCH:
                    yield entries(ready)
                    ready = []
            if not out:
                continue
            row, doc, n_chars, digest, number = zip(*out)
            nothing = [None] * len(out)
            columns = [pa.array(row, pa.int64()), pa.array(doc, pa.int64()), pa.array(n_chars, pa.int64()),
                       pa.array(digest, pa.binary()), pa.array(number, pa.int64()), pa.array(nothing, pa.int64()),
                       pa.array(nothing, pa.int64()), pa.array(nothing, pa.binary())]
            names = ["row_no", "doc_id", "n_chars", "digest", "class_no", "key", "n_rows", "packed"]
            if carried:
                columns.append(b.column(3))
                names.append("row")
            yield pa.RecordBatch.from_arrays(columns, names=names)
        while known or ready:
            while known and len(ready) < BATCH:
                old, gone = known.popitem(last=False)
                ready += [(old, c) for c in gone]
            yield entries(ready)
            ready = []

    return run


class Directory:
    """The buckets of an extendible hash table: (prefix, depth) leaves in key order."""

    def __init__(self, leaves: list[tuple[int, int]]) -> None:
        self.depth = max((d for _, d in leaves), default=0)
        self.leaves = sorted(leaves, key=lambda x: x[0] << (64 - x[1]))

    def slots(self) -> list[tuple[int, int]]:
        """(slot, bucket): the leading ``depth`` bits of a key, and the bucket they lead to."""
        return [(slot, no) for no, (prefix, d) in enumerate(self.leaves)
                for slot in range(prefix << (self.depth - d), (prefix + 1) << (self.depth - d))]


def _load(keys: DataFrame, bits: int):
    """{leading bits: (entries, packed bytes, the same of its heaviest key)}, at most 2 ** bits."""
    slot = F.shiftrightunsigned("key", 64 - bits).alias("slot")
    found = keys.groupBy(slot).agg(F.sum("n").alias("n"), F.sum("size").alias("size"),
                                   F.max("n").alias("most_n"), F.max("size").alias("most_size"))
    return {r.slot: (int(r.n), int(r.size), int(r.most_n), int(r.most_size)) for r in found.collect()}


def grow_directory(entries: DataFrame, bucket_bytes: int, bucket_entries: int, at_least: int = 1,
                   max_depth: int = MAX_DEPTH) -> Directory:
    """Split overfull buckets until every bucket of ``entries`` (key, size) fits or the directory
    is as deep as it may be. A bucket is overfull if it is over the capacity without its heaviest
    key, which no split can lessen. ``at_least``: buckets wanted for the sake of parallel owners."""
    keys = stored(entries.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")), "exact-keys")
    total = keys.agg(F.sum("n"), F.sum("size")).first()
    n, size = int(total[0] or 0), int(total[1] or 0)
    wanted = max(at_least, size / bucket_bytes, n / bucket_entries)
    most = [max(1.0, x / min(wanted, 1 << WANTED_DEPTH)) for x in (n, size)]

    def overfull(inside) -> bool:
        return any(sum(v[i] for v in inside.values()) - max((v[i + 2] for v in inside.values()), default=0) > most[i]
                   for i in (0, 1))

    bits = max(1, min(max_depth, int(np.ceil(np.log2(max(wanted, 1)))) + 3))
    leaves, todo = [], {0: 0}  # prefix -> depth of the buckets to look at
    counted = _load(keys, bits)
    while todo:
        deeper = {}
        for prefix, depth in todo.items():
            stack = [(prefix, depth, {k: v for k, v in counted.items() if k >> (bits - depth) == prefix})]
            while stack:
                p, d, inside = stack.pop()
                if d == max_depth or not overfull(inside):
                    leaves.append((p, d))
                elif d == bits:
                    deeper[p] = d
                else:
                    for half in (2 * p, 2 * p + 1):
                        stack.append((half, d + 1, {k: v for k, v in inside.items() if k >> (bits - d - 1) == half}))
        todo = deeper
        if todo:  # count the overfull buckets alone by finer bits
            finer = min(max_depth, bits + 6)
            some = keys.filter(F.shiftrightunsigned("key", 64 - bits).isin(sorted(todo)))
            counted, bits = _load(some, finer), finer
    return Directory(leaves)


def _own(batches):
    """Entries of key ranges in key order -> a row for every class: its chain element's result."""
    unpack = zstandard.ZstdDecompressor().decompress
    chain: list[dict] = []  # elements of the current key
    at, rows = None, []

    def finish():
        for place, e in enumerate(chain):
            for class_no in e["classes"]:
                rows.append((at[0], at[1], place, class_no, e["doc_id"], e["best"][3], e["n"]))

    def batch():
        kinds = [pa.int32(), pa.int64(), pa.int32()] + [pa.int64()] * 4
        names = [c.split()[0] for c in _BUCKET.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    for b in batches:
        for bucket, key, class_no, row_no, doc, n_chars, n_rows, packed in rows_of(b, *range(8)):
            if (bucket, key) != at:
                finish()
                chain, at = [], (bucket, key)
                if len(rows) >= 10_000:
                    yield batch()
                    rows = []
            order = stays_before(n_chars, doc, row_no)
            # Equal packed bytes are equal texts; else the texts themselves decide.
            same = next((e for e in chain if e["packed"] == packed or unpack(e["packed"]) == unpack(packed)), None)
            if same is None:
                chain.append({"packed": packed, "classes": [class_no], "n": n_rows, "best": order, "doc_id": doc})
                continue
            same["classes"].append(class_no)
            same["n"] += n_rows
            if order < same["best"]:
                same["best"], same["doc_id"] = order, doc
    finish()
    if rows:
        yield batch()


def exact_groups(docs: DataFrame, carry: bool = False, key_of=text_key, remembered: int = REMEMBERED,
                 bucket_bytes: int = BUCKET_BYTES, bucket_entries: int = BUCKET_ENTRIES) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) per input row; with ``carry`` also the
    whole input row as struct ``row``.

    Texts are equal when they are byte for byte without ASCII white space. The row with the most
    code points in its whole text stays; of those, the one with the smallest doc_id.

    Edge cases: null texts count as empty, and empty and white texts form one group; a null
    doc_id comes after all others, so ``keep_id`` is null only in a group of null ids; of rows
    that agree in length and doc_id exactly one stays; texts of any length are compared whole;
    text that is not UTF-8 is compared by its bytes; other columns are not read (but for
    ``carry``); an empty table gives an empty result. ``key_of`` may collide at will: the bytes
    decide.
    """
    spark = docs.sparkSession
    columns = [F.col("doc_id").cast("long"), F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
               text_bytes().alias("text")]
    schema = StructType.fromDDL(_ENTRY)
    if carry:
        columns.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
        schema = StructType([*schema, StructField("row", StructType(docs.schema.fields))])
    scanned = stored(map_batches(docs.select(*columns), _scan(key_of, remembered, carry), schema), "exact-entries")
    entries = scanned.filter("key is not null")
    load = entries.select("key", F.octet_length("packed").cast("long").alias("size"))
    directory = grow_directory(load, bucket_bytes, bucket_entries,
                               int(spark.conf.get("spark.sql.shuffle.partitions")))
    slots = spark.createDataFrame(directory.slots(), "slot long, bucket int")  # at most 2 ** MAX_DEPTH rows
    slot = F.shiftrightunsigned("key", 64 - directory.depth) if directory.depth else F.lit(0).cast("long")
    dealt = (entries.withColumn("slot", slot).join(F.broadcast(slots), "slot")
             .select("bucket", "key", "class_no", "row_no", "doc_id", "n_chars", "n_rows", "packed")
             .repartitionById(len(directory.leaves), F.col("bucket")).sortWithinPartitions("bucket", "key", "class_no"))
    index = stored(map_batches(dealt, _own, _BUCKET), "exact-buckets")
    found = index.filter("group_size > 1").select(F.col("class_no").alias("c"), "keep_id", "keep_row", "group_size")
    rows = scanned.filter("key is null")
    joined = rows.join(found, F.col("class_no") == F.col("c"), "left")
    alone = F.col("group_size").isNull()
    return joined.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("row_no") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), *(["row"] if carry else []))


def keep_one_copy(docs: DataFrame) -> DataFrame:
    """``docs`` (all its columns) with one row of every group of equal texts; see
    ``exact_groups`` for which one stays and for the edge cases."""
    return exact_groups(docs, carry=True).filter("kept").select("row.*")
