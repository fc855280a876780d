"""SimHash near-duplicates by a segment-popcount embedding.

1. Fingerprint: one pass over the texts; shingle digests are counted per bit.
2. Equal fingerprints form one class with its smallest doc_id (map-side minimum, so a group of
   copies costs one row per task).
3. Embedding: a fingerprint is cut into 32 segments of 2 bits and mapped to their bit counts.
   The Manhattan distance of two embeddings is at most the bit distance of the fingerprints,
   so a pair within ``max_bits`` is within ``max_bits`` there too.
4. Grid range-join: the 32 counts are dealt into B blocks. Within Manhattan distance d at
   most d blocks differ, so a pair agrees in all counts of at least B - d blocks: for every
   choice of B - d blocks a fingerprint goes to the grid cell named by those counts. The more
   blocks, the finer the cells and the more copies of each row; B is chosen from the number
   of fingerprints by the cheaper sum of both.
5. Verify: inside a cell, pairs are tested on the exact bit distance with vectorised
   operations. A cell yields the links of a spanning forest, never all its pairs: from a
   reached fingerprint only those not reached yet are compared, so a dense cell of near
   copies costs about one comparison per member.
6. Links meet in distributed connected components.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import map_batches, rows_of, stored, text_bytes
from quillspark.llm.components import connected_components

SEGMENTS = 32
#: Chance that two independent fair 2-bit segments have the same bit count: (1 + 4 + 1) / 16.
SAME_COUNT = 3 / 8
#: Measured weights of the two costs: a grid row moved, a pair compared (microseconds).
ROW_COST, PAIR_COST = 1.5, 0.02
#: Cells up to this size are compared by shifted vectors, larger ones by search from a seed.
SMALL_CELL = 12


def fingerprint(words: list[bytes], shingle: int) -> int:
    """The fingerprint of a word sequence: bits set in over half of the shingle digests."""
    if not words:
        return 0
    text = b" ".join(words)
    if len(words) <= shingle:
        digests = [xxhash.xxh64_intdigest(text, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        h = xxhash.xxh64_intdigest
        digests = [h(text[a:b], 42) for a, b in zip(starts[:len(words) - shingle + 1].tolist(),
                                                    ends[shingle - 1:].tolist())]
    raw = np.array(digests, np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(raw), 1 << 16):  # bounded memory for very long texts
        block = raw[at:at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(raw)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 4, row: str | None = None) -> DataFrame:
    """(doc_id, fp long[, ``row`` long]): ``fp`` holds the 64 bits; null and wordless texts give 0."""
    more = [row] if row else []

    def run(batches):
        for b in batches:
            fps = [fingerprint(t.lower().split(), shingle) for (t,) in rows_of(b, 1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.array(fps, np.uint64).view(np.int64)), *b.columns[2:]], names=["doc_id", "fp", *more])

    return map_batches(docs.select(F.col("doc_id").cast("long"), text_bytes(), *more), run,
                       ", ".join(["doc_id long", "fp long", *(f"{c} long" for c in more)]))


def grid_blocks(n: int, max_bits: int) -> int:
    """Number of blocks for ``n`` fingerprints: least total of rows moved and pairs compared, but
    at least two blocks must agree, so that the copies of a row stay as many over a wide range
    of sizes."""
    def cost(blocks: int) -> float:
        choices = comb(blocks, max_bits)
        same = SAME_COUNT ** (SEGMENTS * (blocks - max_bits) / blocks)
        return choices * n * (ROW_COST + PAIR_COST * n * same / 2)

    return min(range(max_bits + 2, min(SEGMENTS, max_bits + 9) + 1), key=cost)


def _cells(fps: np.ndarray, blocks: int, max_bits: int):
    """For every choice of blocks: the cell key of each fingerprint (64-bit, choice included)."""
    low = np.uint64(0x5555555555555555)
    counts = (fps & low) + ((fps >> np.uint64(1)) & low)  # 32 counts of 0..2 in 2 bits each
    edges = [SEGMENTS * i // blocks for i in range(blocks + 1)]
    masks = [sum(3 << (2 * s) for s in range(edges[i], edges[i + 1])) for i in range(blocks)]
    for no, choice in enumerate(combinations(range(blocks), blocks - max_bits)):
        key = counts & np.uint64(sum(masks[i] for i in choice))
        key ^= np.uint64((no + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)  # one bijection per choice
        key *= np.uint64(0xBF58476D1CE4E5B9)
        yield key ^ (key >> np.uint64(29))


def _links_of_cell(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the cell's links: index pairs."""
    a, b = [], []
    rest = np.arange(len(fps))
    while len(rest):
        frontier, rest = [int(rest[0])], rest[1:]
        while frontier and len(rest):
            x = frontier.pop()
            near = np.bitwise_count(fps[rest] ^ fps[x]) <= max_bits
            if near.any():
                reached = rest[near]
                rest = rest[~near]
                a += [x] * len(reached)
                b += reached.tolist()
                frontier += reached.tolist()
    return np.array(a, np.int64), np.array(b, np.int64)


def _verify(max_bits: int):
    """Sorted (cell, fp, rep) batches -> (a, b) links between class representatives."""
    def links(cell, fp, rep):
        out = []
        starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
        sizes = np.diff(np.append(starts, len(cell)))
        small = np.repeat(sizes <= SMALL_CELL, sizes)
        for shift in range(1, min(SMALL_CELL, int(sizes.max(initial=1)))):
            i = np.flatnonzero((cell[shift:] == cell[:-shift]) & small[shift:])
            i = i[np.bitwise_count(fp[i] ^ fp[i + shift]) <= max_bits]
            out.append((rep[i], rep[i + shift]))
        for s, n in zip(starts[sizes > SMALL_CELL], sizes[sizes > SMALL_CELL]):
            a, b = _links_of_cell(fp[s:s + n], max_bits)
            out.append((rep[s + a], rep[s + b]))
        a, b = (np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 2
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches):
        held = None  # rows of the last cell, which may go on in the next batch
        for batch in batches:
            part = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            part[1] = part[1].view(np.uint64)
            if held:
                part = [np.concatenate(x) for x in zip(held, part)]
            last = np.searchsorted(part[0], part[0][-1], "left")
            if last:
                yield links(*(x[:last] for x in part))
            held = [x[last:].copy() for x in part]
        if held:
            yield links(*held)

    return run


def near_links(classes: DataFrame, n: int, max_bits: int) -> DataFrame:
    """(a, b): links between classes (fp, rep) of distinct fingerprints within ``max_bits``."""
    blocks = grid_blocks(max(n, 2), max_bits)

    def expand(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            for cell in _cells(fp.view(np.uint64), blocks, max_bits):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.view(np.int64)), batch.column(0), batch.column(1)], names=["cell", "fp", "rep"])

    grid = map_batches(classes.select("fp", "rep"), expand, "cell long, fp long, rep long")
    grid = grid.repartition(F.col("cell")).sortWithinPartitions("cell")
    return map_batches(grid, _verify(max_bits), "a long, b long")


def fingerprint_components(fps: DataFrame, max_bits: int) -> DataFrame:
    """(fp, component, component_id) of the distinct fingerprints: ``component`` is the smallest
    fingerprint reachable, ``component_id`` the smallest doc_id of all rows it holds.

    Fingerprints, not doc_ids, are the nodes: rows of one doc_id with different texts may belong
    to several components and tie none of them together.
    """
    classes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    links = near_links(classes.select("fp", F.col("fp").alias("rep")), classes.count(), max_bits)
    found = connected_components(links)
    linked = classes.join(found, F.col("fp") == F.col("node"))
    ids = linked.groupBy(F.col("component").alias("c")).agg(F.min("first_id").alias("component_id"))
    ids = linked.select(F.col("fp").alias("linked_fp"), "component").join(ids, F.col("component") == F.col("c"))
    joined = classes.join(ids, F.col("fp") == F.col("linked_fp"), "left")
    alone = F.col("linked_fp").isNull()
    return joined.select("fp", F.coalesce("component", "fp").alias("component"),
                         F.when(alone, F.col("first_id")).otherwise(F.col("component_id")).alias("component_id"))


def simhash_components(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id) per input row.

    ``fingerprint`` is 16 lowercase hex digits; ``component_id`` is the smallest doc_id
    reachable over links of at most ``max_bits`` differing bits, itself included.

    Edge cases: null, empty and wordless texts have fingerprint zero and link like any other;
    rows with equal fingerprints are linked, whatever their texts; repeated rows get the same
    component, and rows that share a doc_id but not a text each their own; null doc_ids never
    name a component unless all its ids are null; texts of any length are read whole; other
    columns are not read; an empty table gives an empty result.
    """
    fps = stored(fingerprints(docs, shingle), "fingerprints")
    found = fingerprint_components(fps, max_bits).select(F.col("fp").alias("class_fp"), "component_id")
    joined = fps.join(found, F.col("fp") == F.col("class_fp"), "left")
    return joined.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_per_group(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` (all its columns) with one row of every group of near-duplicates.

    The row with the group's smallest doc_id stays (one of them if that id repeats in the
    group). Rows with a null doc_id stay. The table is stored once with row numbers, so what
    goes is decided by row, whatever doc_ids repeat.
    """
    rows = stored(docs.withColumn("__row", F.monotonically_increasing_id()), "simhash-rows")
    fps = stored(fingerprints(rows, shingle, "__row"), "fingerprints")
    found = fingerprint_components(fps, max_bits).select(F.col("fp").alias("class_fp"), "component", "component_id")
    named = fps.join(found, F.col("fp") == F.col("class_fp")).filter("doc_id = component_id")
    keep = named.groupBy("component").agg(F.min("__row").alias("__keep")).select("__keep")
    keep = keep.unionAll(fps.filter("doc_id is null").select("__row"))
    return rows.join(keep, F.col("__row") == F.col("__keep"), "left_semi").drop("__row")
