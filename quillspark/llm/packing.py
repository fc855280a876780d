"""Best-fit packing of token pieces into sequences by bin completion.

Texts are tokenised once, in one pass, into pieces of at most ``capacity`` tokens. Pieces are
dealt round-robin into groups of about ``GROUP_PIECES`` (so no key decides where a row goes),
and each group is packed in one task of bounded memory. A group's last sequences may stay
open, so the loss against one global packing is about one sequence a group.

Inside a group (``pack``): the incumbent is best-fit decreasing. Bin completion then takes the
largest piece left and enumerates fillings of the rest of its sequence from the sizes left,
largest first; a filling is skipped when another one dominates it (a smaller piece in the
place of a larger one, with nothing more gained). The waste allowed is what an incumbent with
one sequence less would have; a branch whose waste exceeds it is given up and the next filling
of the last sequence is tried, within a bounded number of steps.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import map_batches, plain_text, rows_of, stored, text_bytes
from quillspark.llm.tokens import encoder

GROUP_PIECES = 1 << 16
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


class Stock:
    """How many pieces of each size are left; a bit mask finds the largest that fits."""

    def __init__(self, sizes, capacity: int) -> None:
        self.count = np.bincount(sizes, minlength=capacity + 1).tolist()
        self.mask = sum(1 << s for s, n in enumerate(self.count) if n)

    def take(self, s: int, n: int = 1) -> None:
        self.count[s] -= n
        if not self.count[s]:
            self.mask &= ~(1 << s)

    def give(self, s: int, n: int = 1) -> None:
        self.count[s] += n
        self.mask |= 1 << s

    def largest(self, room: int) -> int:
        """The largest size left that is at most ``room``; 0 if none."""
        return max((self.mask & ((1 << (room + 1)) - 1)).bit_length() - 1, 0) if room > 0 else 0

    def smallest(self) -> int:
        return (self.mask & -self.mask).bit_length() - 1


def best_fit_decreasing(sizes, capacity: int) -> list[list[int]]:
    """Each size, largest first, into the fullest open sequence that still takes it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for s in sorted(sizes, reverse=True):
        fits = mask >> s
        if fits:
            room = s + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                mask &= ~(1 << room)
            bins[b].append(s)
        else:
            room, b = capacity, len(bins)
            bins.append([s])
        if room > s:
            by_room[room - s].append(b)
            mask |= 1 << (room - s)
    return bins


def fillings(stock: Stock, room: int, keep: int = 3, steps: int = 120) -> list[tuple[int, list[int]]]:
    """Up to ``keep`` undominated fillings of ``room``, least waste first: (waste, sizes)."""
    found: list[tuple[int, int, list[int]]] = []
    left = steps

    def record(waste: int, chosen: list[int]) -> None:
        found.append((waste, len(chosen), chosen))
        found.sort(key=lambda x: x[:2])
        del found[keep:]

    def greedy(room: int) -> list[int]:
        rest, out = stock.largest(room), []
        while rest:
            n = min(stock.count[rest], room // rest)
            out += [rest] * n
            room -= n * rest
            rest = stock.largest(min(room, rest - 1))
        return out

    def search(room: int, top: int, chosen: list[int]) -> None:
        nonlocal left
        s = stock.largest(min(room, top))
        if not s:
            record(room, list(chosen))
            return
        if len(chosen) >= 20:  # many tiny pieces: the largest-first filling stands for the rest
            tail = greedy(room)
            record(room - sum(tail), chosen + tail)
            return
        low = stock.smallest()
        first = True
        while s and left > 0:
            if not first and room - s < low:  # dominated: smaller, and nothing fits beside it
                s = stock.largest(min(s - 1, room - low))
                if not s:
                    break
            left -= 1
            stock.take(s)
            chosen.append(s)
            search(room - s, s, chosen)
            chosen.pop()
            stock.give(s)
            if len(found) >= keep and found[-1][0] == 0:
                return
            first = False
            s = stock.largest(s - 1)

    search(room, room, [])
    return [(w, c) for w, _, c in found]


def bin_completion(sizes, capacity: int, allowed_waste: int, max_steps: int) -> list[list[int]] | None:
    """A packing whose total waste is at most ``allowed_waste``, or None within ``max_steps``."""
    stock = Stock(sizes, capacity)
    path: list[tuple[int, list, int]] = []  # (largest, fillings, index tried)
    waste, steps = 0, 0

    def apply(head: int, options: list, i: int) -> None:
        nonlocal waste
        stock.take(head)
        for s in options[i][1]:
            stock.take(s)
        waste += options[i][0]
        path.append((head, options, i))

    def next_branch() -> bool:
        """Give up the last sequence's filling for its next one, or those of earlier ones."""
        nonlocal waste
        while path:
            head, options, i = path.pop()
            waste -= options[i][0]
            for s in (head, *options[i][1]):
                stock.give(s)
            if i + 1 < len(options):
                apply(head, options, i + 1)
                return True
        return False

    while stock.mask:
        steps += 1
        if steps > max_steps:
            return None
        head = stock.largest(capacity)
        stock.take(head)
        options = fillings(stock, capacity - head)
        stock.give(head)
        apply(head, options, 0)
        # The last sequence may stay open: its room is no waste against one sequence less.
        while waste > allowed_waste and stock.mask:
            steps += 1
            if steps > max_steps or not next_branch():
                return None
    return [[head, *options[i][1]] for head, options, i in path]


def lower_bound(sizes, capacity: int) -> int:
    """Sequences that any packing needs: by the total, by the pieces that cannot share, and by
    how many of the smallest pieces one sequence takes."""
    sizes = np.sort(np.asarray(sizes))
    most = int((np.cumsum(sizes) <= capacity).sum())
    return max(-(-int(sizes.sum()) // capacity), int((2 * sizes > capacity).sum()), -(-len(sizes) // most))


def pack(sizes, capacity: int) -> list[list[int]]:
    """Sequences (lists of sizes) for the pieces: the better of best fit and bin completion."""
    sizes = [int(s) for s in sizes]
    best = best_fit_decreasing(sizes, capacity)
    low = lower_bound(sizes, capacity) if len(sizes) else 0
    total = sum(sizes)
    tries = 3
    while len(best) > low and tries:
        goal = len(best) - 1 if tries < 3 else low
        found = bin_completion(sizes, capacity, goal * capacity - total, 4 * len(best) + 1000)
        if found and len(found) < len(best):
            best = found
        tries -= 1
    return best


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each text's ids and the end id, cut to size."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encode = encoder(tokenizer).encode
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for doc, text in rows_of(b, 0, 1):
                ids = encode(plain_text(text)) + end
                n = len(ids) // 4
                start, stop = 0, n % capacity or capacity
                for no in range(-(-n // capacity)):
                    for column, v in zip(out, (doc, no, start, stop - start, zlib.crc32(ids[4 * start:4 * stop]))):
                        column.append(v)
                    start, stop = stop, stop + capacity
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()),
                 *(pa.array(c, pa.int64()) for c in out[2:])],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return map_batches(docs.select(F.col("doc_id").cast("long"), text_bytes()), run, PIECES)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ``tokenizer`` is the path of a tokenizer file that every executor can read.

    Edge cases: null and empty texts have one piece, the end id; a text longer than
    ``capacity`` has its shorter piece first and every full piece in a sequence of its own;
    repeated rows and rows with equal or null doc_ids are packed each for itself; bytes that are
    not UTF-8 count as U+FFFD; other columns are not read; an empty table gives an empty result.
    """
    cut = stored(pieces(docs, tokenizer, capacity), "pieces")
    groups = max(1, -(-cut.count() // GROUP_PIECES))

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        sizes = table.column("length").to_numpy()
        sequence = np.zeros(len(sizes), np.int64)
        offset = np.zeros(len(sizes), np.int64)
        whole = np.flatnonzero(sizes == capacity)
        sequence[whole] = np.arange(len(whole))
        part = np.flatnonzero(sizes < capacity)
        rows: dict[int, list[int]] = {}
        for i, s in zip(part.tolist(), sizes[part].tolist()):
            rows.setdefault(s, []).append(i)
        for no, members in enumerate(pack(sizes[part], capacity), len(whole)):
            at = 0
            for s in members:
                i = rows[s].pop()
                sequence[i], offset[i] = no, at
                at += s
        sequence += TaskContext.get().partitionId() << 32
        table = table.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))
        yield from table.combine_chunks().to_batches()

    return map_batches(cut.repartition(groups), run, PACKED)
