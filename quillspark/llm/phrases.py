"""Phrases that are commoner than their parts suggest, by Toivonen's sampling algorithm.

1. Proposal. The phrases of a hashed sample of the documents are counted; those over a lowered
   threshold are the proposal. It decides only how much work follows, never the result. It is
   asked only about the parts of phrases, so phrases of the full length are not in it.
2. Full pass over all documents. A phrase of k words is counted exactly if both phrases of
   k - 1 words in it are proposed (single words always are). These are the proposed phrases and
   their negative border, as far as the border occurs at all.
3. Failures: frequent phrases of the border that were not proposed. They join the proposal, and
   an expansion pass counts the phrases that are within it now and were not before. This goes on
   until a pass finds no failure: then every frequent phrase has been counted exactly, since all
   its parts are frequent, were counted and are within the proposal.

Texts are read once: their words are numbered and written to shared files, many texts of one
language a row, and the passes read those. The proposal goes to the tasks as a bit table of
bounded size (``MAX_BITS``). A phrase that shares its bit with another is taken as proposed,
wherever it is asked for; it costs a count that was not needed and nothing else.

Nearly all phrases of a full pass occur a few times only, so their texts are never moved. The
pass first tallies hashes: a task sorts the hashes of its phrases, and sends each range of them
(a bucket) as packed 32-bit rests with their numbers; a bucket is added up in one place. A
phrase occurs at most as often as its hash, so the hashes that occur often enough, again as a
bit table, hold all frequent phrases of the pass. Then the pass counts the phrases in that table,
keyed by their text: for many rows of numbered words at a time, then by Spark on both sides of
the shuffle, so a phrase that fills a third of the corpus is a row a task. A pass after few
failures has few phrases to count and goes without the tally. The passes' results are written to
shared files; of each only the frequent phrases go on.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import map_batches, rows_of, stored, text_bytes

#: One document in this many is in the sample; phrases found this often there are proposed.
SAMPLE, PROPOSED = 8, 2
#: Bits of the table of proposals: 16 for every phrase, within these bounds (32 MB at most).
MIN_BITS, MAX_BITS = 18, 28
#: Bits of the table that travel as one row.
CHUNK_BITS = 1 << 18
#: Phrases a task holds before it adds them up, and words taken at a time.
HELD, STRETCH = 4 << 20, 1 << 15
#: Phrases in a bucket of the tally at most, on average, and the bounds of the buckets' number
#: (as a power of 2).
BUCKET, MIN_BUCKETS, MAX_BUCKETS = 4 << 20, 6, 16
#: A pass is tallied unless the phrases proposed are this many times the failures before it.
FEW_FAILURES = 16
#: Bytes of texts whose words are numbered and counted together, and of a text taken at a time.
TEXT_AT_ONCE, BLOCK = 8 << 20, 2 << 20
#: Fixed values of the contract: A-Z in lower case, piece ends as full stops, tabs as spaces.
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz......... ")
STOP = 0
_TOKENS = "sampled boolean, lang string, carried int, ids binary, words binary, hashes binary, size int"
_COUNTS = "lang string, k int, phrase string, n long"
_TALLY, _REACHED = "bucket int, rests binary, numbers binary", "bucket int, size int, rests binary"


def folded(text: bytes) -> bytes:
    """Words parted by spaces, pieces by full stops; bytes that are not UTF-8 become U+FFFD."""
    try:
        text.decode()
    except UnicodeDecodeError:
        text = text.decode("utf-8", "replace").encode()
    return text.translate(_FOLD)


def blocks(text: bytes, size: int = 0) -> Iterator[bytes]:
    """A folded text cut before spaces and full stops."""
    at, size = 0, size or BLOCK
    while at < len(text):
        end = at + size
        while end < len(text) and text[end] not in b" .":
            end += 1
        yield text[at:end]
        at = end


def numbered(text: bytes) -> tuple[np.ndarray, list[bytes]]:
    """(ids, words) of folded text: id i is words[i - 1], STOP is the end of a piece."""
    parts = pc.split_pattern(pa.array([text.replace(b".", b" . ")], pa.binary()), " ").values.dictionary_encode()
    known = parts.dictionary
    real = ~pc.is_in(known, value_set=pa.array([b"", b"."], pa.binary())).to_numpy(zero_copy_only=False).astype(bool)
    number = np.cumsum(real, dtype=np.int32)
    number[~real] = -1
    number[pc.equal(known, b".").to_numpy(zero_copy_only=False).astype(bool)] = STOP
    ids = number[parts.indices.to_numpy()] if len(known) else np.empty(0, np.int32)
    known = known.filter(pa.array(real))  # words hold no full stop
    words = pc.binary_join(pa.ListArray.from_arrays([0, len(known)], known), b".")[0].as_py()
    return ids[ids >= 0], words.split(b".") if len(known) else []


def _mix(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from the hash of its start and of its last word."""
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + word
    return (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang.encode())
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)


class Bits:
    """A table of bits for phrase hashes."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words
        self.shift = np.uint64(64 - (len(words) * 64).bit_length() + 1)

    def has(self, h: np.ndarray) -> np.ndarray:
        place = h >> self.shift
        return (self.words[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def _unique(ids: np.ndarray, at: np.ndarray, h: np.ndarray, k: int):
    """The distinct phrases of k words at ``at``, whose hashes are ``h``: (place of one
    occurrence, occurrences)."""
    if k == 1:
        n = np.bincount(ids[at])
        place = np.empty(len(n), np.int64)
        place[ids[at]] = at
        some = np.flatnonzero(n)
        return place[some], n[some]
    order = np.argsort(h)
    sorted_at, h = at[order], h[order]
    new = np.append(True, h[1:] != h[:-1])
    for j in range(k):
        word = ids[sorted_at + j]
        if ((word[1:] != word[:-1]) & ~new[1:]).any():
            return _unique_words(ids, at, k)  # one hash, two phrases
    first = np.flatnonzero(new)
    return sorted_at[first], np.diff(np.append(first, len(h)))


def _unique_words(ids: np.ndarray, at: np.ndarray, k: int):
    """``_unique`` by the words themselves."""
    key, v = ids[at].astype(np.int64), int(ids.max()) + 1
    for j in range(1, k):  # ranks stay below the number of words, so no product overflows
        if j > 1:
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
        key = key * v + ids[at + j]
    _, first, n = np.unique(key, return_index=True, return_counts=True)
    return at[first], n


def windows(ids: np.ndarray, hashes: np.ndarray, max_words: int, new: Bits | None, old: Bits | None, carried: int):
    """(k, places, hashes) of the phrases to count in a row of words, a stretch at a time.

    ``new``: the proposal (None: everything counts); ``old``: the proposal of the passes before,
    whose phrases are counted already. The first ``carried`` words were part of the row
    before; phrases wholly within them are counted already.
    """
    word = np.arange(len(hashes)) != STOP
    word_new = word & new.has(hashes) if new is not None else word
    word_old = word & old.has(hashes) if old is not None else None
    for start in range(0, len(ids), STRETCH):
        part = ids[start:start + STRETCH + max_words - 1].astype(np.int64)
        own = hashes[part]
        full = own.copy()  # by place, the hash of the phrase there
        inside, known = word[part], word[part] if old is not None else None
        for k in range(1, max_words + 1):
            if k > 1:
                inside = inside[:-1] & inside[1:]
                known = known[:-1] & known[1:] if old is not None else None
            at = np.flatnonzero(inside)
            if not len(at):
                break
            if k > 1:
                full[at] = _mix(full[at], own[at + k - 1])
            take = at[np.searchsorted(at, carried - k - start + 1):np.searchsorted(at, STRETCH)]
            if old is not None:
                take = take[~known[take]]
            if len(take):
                yield k, take + start, full[take]
            if k == max_words:
                break
            if k == 1:
                inside, known = word_new[part], word_old[part] if old is not None else None
                continue
            if new is not None:
                at = at[new.has(full[at])]
                inside = np.zeros(len(inside), bool)
                inside[at] = True
            if old is not None:
                at = at[known[at]]
                at = at[old.has(full[at])]
                known = np.zeros(len(known), bool)
                known[at] = True


def _tokenise(max_words: int):
    """Rows (lang, sampled, text) -> the numbered words of many texts of one language a row, so
    that the passes need not read texts again. A row that ends within a piece (a text of more
    than a block) hands its last words on to the next row, which says how many it ``carried``."""
    def run(batches):
        held: dict[tuple[bool, str], list] = {}  # (sampled, lang) -> [folded text, its bytes, words carried]
        total = 0

        def flush(key):
            text, _, carried = held.pop(key)
            ids, words = numbered(b"".join(text))
            if not len(ids):
                return
            sampled, lang = key
            yield pa.RecordBatch.from_arrays(
                [pa.array([sampled]), pa.array([lang]), pa.array([carried], pa.int32()), pa.array([ids.tobytes()], pa.binary()),
                 pa.array([b".".join(words)], pa.binary()), pa.array([word_hashes(lang, words).tobytes()], pa.binary()),
                 pa.array([len(ids)], pa.int32())],
                names=["sampled", "lang", "carried", "ids", "words", "hashes", "size"])
            tail = ids[max(0, len(ids) - max_words + 1):]
            tail = tail[len(tail) - int(np.argmax(np.append(tail[::-1] == STOP, True))):].tolist()
            if tail:  # a piece goes on
                rest = b" ".join([words[i - 1] for i in tail])
                held[key] = [[rest], len(rest), len(tail)]

        for b in batches:
            for lang, sampled, text in rows_of(b, 0, 1, 2):
                key = (sampled, lang)
                for block in blocks(folded(text)):
                    mine = held.setdefault(key, [[], 0, 0])
                    mine[0].append(block)
                    mine[1] += len(block)
                    total += len(block)
                    if total >= TEXT_AT_ONCE:
                        largest = max(held, key=lambda x: held[x][1])
                        total -= held[largest][1]
                        yield from flush(largest)
                        total += held[largest][1] if largest in held else 0
                if key in held:
                    held[key][0].append(b".")
        for key in list(held):
            yield from flush(key)

    return run


def _with_stop(hashes: bytes) -> np.ndarray:
    """The hashes by word number; STOP has none."""
    return np.concatenate((np.zeros(1, np.uint64), np.frombuffer(hashes, np.uint64)))


class _Phrases:
    """Phrases found in rows of numbered words of one language, whose words are numbered alike."""

    def __init__(self, max_words: int) -> None:
        self.number: dict[bytes, int] = {b".": STOP}
        self.ids: list[np.ndarray] = []
        self.words = self.size = 0
        self.found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(max_words + 1)]

    def add(self, ids: np.ndarray, words: bytes, found: list[tuple[int, np.ndarray, np.ndarray]]) -> None:
        """``found``: (k, places, hashes) in a row. Only the words of these phrases get numbers."""
        words = words.split(b".")
        used = np.zeros(len(words) + 1, bool)
        for k, at, h in found:
            for j in range(k):
                used[ids[at + j]] = True
            self.found[k].append((at + self.words, h))
            self.size += len(at)
        own, number = np.zeros(len(used), np.int32), self.number
        used = np.flatnonzero(used)
        own[used] = [number.setdefault(words[i - 1], len(number)) for i in used.tolist()]
        self.ids.append(own[ids])
        self.words += len(ids)
        self.size += len(ids)

    def counts(self, lang: str) -> Iterator[pa.RecordBatch]:
        ids, names = np.concatenate(self.ids), pa.array(list(self.number), pa.binary())
        for k, found in enumerate(self.found):
            if not found:
                continue
            at, n = _unique(ids, *(np.concatenate(x) for x in zip(*found)), k)
            found.clear()
            for s in range(0, len(at), 50_000):
                part = [names.take(pa.array(ids[at[s:s + 50_000] + j])) for j in range(k)]
                phrases = pc.binary_join_element_wise(*part, pa.scalar(b" ", pa.binary())) if k > 1 else part[0]
                yield _batch(lang, k, phrases.cast(pa.string()), n[s:s + 50_000])


def _count(max_words: int, new, old, often=None):
    """Numbered words -> (lang, k, phrase, n); k = 0 has the number of words (first pass).
    ``often``: of the phrases to count, those in this table are (None: all)."""
    def run(batches):
        bits_new, bits_old, bits_often = (Bits(x.value) if x is not None else None for x in (new, old, often))
        held: dict[str, _Phrases] = {}

        def add(lang, *row):
            if lang not in held:
                held[lang] = _Phrases(max_words)
            held[lang].add(*row)
            while sum(x.size for x in held.values()) >= HELD:
                largest = max(held, key=lambda x: held[x].size)
                yield from held.pop(largest).counts(largest)

        for b in batches:
            for lang, carried, ids, words, hashes in rows_of(b, 0, 1, 2, 3, 4, step=1):
                ids = np.frombuffer(ids, np.int32)
                if old is None:
                    yield _batch(lang, 0, pa.array([""]), np.array([(ids[carried:] != STOP).sum()]))
                found, size = [], 0
                for k, at, h in windows(ids, _with_stop(hashes), max_words, bits_new, bits_old, carried):
                    if often is not None:
                        some = bits_often.has(h)
                        at, h = at[some], h[some]
                    if len(at):
                        found.append((k, at, h))
                        size += len(at)
                    if size >= HELD:
                        yield from add(lang, ids, words, found)
                        found, size = [], 0
                if found:
                    yield from add(lang, ids, words, found)
        for lang in list(held):
            yield from held.pop(lang).counts(lang)

    return run


def _packed(parts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of stretches of an array, one after the other."""
    offsets = np.append(0, ends).astype(np.int32) * np.int32(parts.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(parts))])


def _tally(max_words: int, new, old, least: int, buckets: int):
    """Numbered words -> (bucket, rests, numbers): how often hashes occur, up to ``least``. The
    first ``buckets`` bits of a hash are its bucket, the 32 bits after them its rest."""
    kind, shift = np.min_scalar_type(least), np.uint64(32 - buckets)

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        key = np.concatenate(held)
        held.clear()
        key >>= shift
        key.sort()
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        n = np.minimum(np.diff(np.append(first, len(key))), least).astype(kind)
        key = key[first]
        bucket = (key >> np.uint64(32)).astype(np.int32)
        last = np.flatnonzero(np.append(bucket[1:] != bucket[:-1], True))
        return pa.RecordBatch.from_arrays([pa.array(bucket[last]), _packed(key.astype(np.uint32), last + 1), _packed(n, last + 1)],
                                          names=["bucket", "rests", "numbers"])

    def run(batches):
        bits_new, bits_old = (Bits(x.value) if x is not None else None for x in (new, old))
        held, size = [], 0
        for b in batches:
            for carried, ids, hashes in rows_of(b, 0, 1, 2, step=1):
                for _, at, h in windows(np.frombuffer(ids, np.int32), _with_stop(hashes), max_words, bits_new, bits_old, carried):
                    held.append(h)
                    size += len(at)
                    if size >= HELD:
                        yield flush(held)
                        size = 0
        if held:
            yield flush(held)

    return run


def _add_up(least: int):
    """(bucket, rests, numbers), sorted by bucket -> (bucket, size, rests): the hashes that occur
    at least ``least`` times."""
    kind = np.min_scalar_type(least)

    def total(bucket, rests, numbers):
        key = np.frombuffer(b"".join(rests), np.uint32).astype(np.uint64) << np.uint64(32)
        key |= np.frombuffer(b"".join(numbers), kind)
        key.sort()
        rest, n = (key >> np.uint64(32)).astype(np.uint32), (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.append(True, rest[1:] != rest[:-1]))
        some = rest[first[np.add.reduceat(n, first) >= least]]
        return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([len(some)], pa.int32()),
                                           pa.array([some.tobytes()], pa.binary())], names=["bucket", "size", "rests"])

    def run(batches):
        now, rests, numbers = None, [], []
        for b in batches:
            for bucket, rest, number in rows_of(b, 0, 1, 2):
                if bucket != now and rests:
                    yield total(now, rests, numbers)
                    rests, numbers = [], []
                now = bucket
                rests.append(rest)
                numbers.append(number)
        if rests:
            yield total(now, rests, numbers)

    return run


def _reaching(tokens: DataFrame, max_words: int, least: int, new=None, old=None) -> tuple[np.ndarray, int]:
    """(bit table, number) of the hashes that occur at least ``least`` times among the phrases
    that a pass counts."""
    least = min(max(least, 1), (1 << 32) - 1)
    words = tokens.agg(F.sum("size")).first()[0] or 0
    buckets = int(np.clip((words * max_words // BUCKET).bit_length(), MIN_BUCKETS, MAX_BUCKETS))
    tally = map_batches(tokens.select("carried", "ids", "hashes"), _tally(max_words, new, old, least, buckets), _TALLY)
    tally = tally.repartition("bucket").sortWithinPartitions("bucket")
    reached = stored(map_batches(tally, _add_up(least), _REACHED), "phrases-reached")
    n = reached.agg(F.sum("size")).first()[0] or 0
    bits = int(np.clip((16 * n).bit_length(), MIN_BITS, MAX_BITS))
    own = bits - buckets  # bits of a bucket

    def fill(batches):
        for b in batches:
            for bucket, rests in rows_of(b, 0, 1, step=1):
                place = np.unique(np.frombuffer(rests, np.uint32) >> np.uint32(32 - own))
                flags = np.zeros(1 << own, bool)
                flags[place] = True
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()),
                                                  pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())],
                                                 names=["bucket", "bits"])

    table = np.zeros((1 << bits) // 64, np.uint64)
    for r in map_batches(reached.select("bucket", "rests"), fill, "bucket int, bits binary").collect():
        at = r.bucket << own >> 6
        table[at:at + (1 << own >> 6)] |= np.frombuffer(r.bits, "<u8")
    return table, n


def _batch(lang: str, k: int, phrase: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(phrase), pa.string()), pa.array(np.full(len(phrase), k, np.int32)), phrase,
         pa.array(n.astype(np.int64))], names=["lang", "k", "phrase", "n"])


def _pass(tokens: DataFrame, max_words: int, new=None, old=None, often=None) -> DataFrame:
    counted = map_batches(tokens.select("lang", "carried", "ids", "words", "hashes"), _count(max_words, new, old, often), _COUNTS)
    return counted.groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))


def _phrase_hashes(batch: pa.RecordBatch) -> np.ndarray:
    """Hashes of the phrases in (lang, phrase), as ``windows`` makes them."""
    out = np.zeros(batch.num_rows, np.uint64)
    by: dict[tuple[str, int], list[int]] = {}
    split = []
    for i, (lang, phrase) in enumerate(rows_of(batch, 0, 1)):
        split.append(phrase.encode().split(b" "))
        by.setdefault((lang, len(split[-1])), []).append(i)
    for (lang, k), rows in by.items():
        h = None
        for j in range(k):
            word = word_hashes(lang, [split[i][j] for i in rows])
            h = word if h is None else _mix(h, word)
        out[rows] = h
    return out


def _bits_of(phrases: DataFrame, bits: int, had: np.ndarray | None = None) -> np.ndarray:
    """The bit table of ``phrases``: at most 2 ** bits bits reach the driver, packed in chunks."""
    def places(batches):
        for b in batches:
            place = np.unique(_phrase_hashes(b) >> np.uint64(64 - bits)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((place // CHUNK_BITS).astype(np.int32)),
                                              pa.array((place % CHUNK_BITS).astype(np.int32))], names=["chunk", "place"])

    def fill(batches):
        chunks: dict[int, np.ndarray] = {}
        for b in batches:
            chunk, place = (b.column(i).to_numpy() for i in (0, 1))
            for c in np.unique(chunk).tolist():
                own = place[chunk == c].astype(np.uint64)
                table = chunks.setdefault(c, np.zeros(CHUNK_BITS // 64, np.uint64))
                np.bitwise_or.at(table, own >> np.uint64(6), np.uint64(1) << (own & np.uint64(63)))
        if chunks:
            yield pa.RecordBatch.from_arrays([pa.array(list(chunks), pa.int32()),
                                              pa.array([t.tobytes() for t in chunks.values()], pa.binary())], names=["chunk", "bits"])

    dealt = map_batches(phrases.select("lang", "phrase"), places, "chunk int, place int").repartition("chunk")
    table = np.zeros((1 << bits) // 64, np.uint64) if had is None else had.copy()
    for r in map_batches(dealt, fill, "chunk int, bits binary").collect():
        at = r.chunk * (CHUNK_BITS // 64)
        table[at:at + CHUNK_BITS // 64] |= np.frombuffer(r.bits, np.uint64)
    return table


def _outside(phrases: DataFrame, table) -> DataFrame:
    """The phrases whose bit is not set."""
    def run(batches):
        bits = Bits(table.value)
        for b in batches:
            yield b.filter(pa.array(~bits.has(_phrase_hashes(b))))

    return map_batches(phrases.select("lang", "phrase"), run, "lang string, phrase string")


def frequent_phrases(docs: DataFrame, min_count: int = 30, max_words: int = 4, sample: int = SAMPLE,
                     proposed: int = PROPOSED) -> tuple[DataFrame, DataFrame]:
    """((lang, k, phrase, n) of all phrases of 1 to ``max_words`` words that occur at least
    ``min_count`` times, (lang, words)): exact counts over all documents."""
    spark = docs.sparkSession
    deal = F.pmod(F.xxhash64(F.col("doc_id"), F.octet_length("text")), F.lit(sample)) == 0
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")), deal, text_bytes())
    tokens = stored(map_batches(texts, _tokenise(max_words), _TOKENS), "phrases-tokens")
    table, known = _reaching(tokens.filter("sampled"), max_words - 1, proposed)
    bits, failed, old, passes = (len(table) * 64).bit_length() - 1, None, None, []
    while True:
        new, often = spark.sparkContext.broadcast(table), None
        if failed is None or failed * FEW_FAILURES > known:
            often = spark.sparkContext.broadcast(_reaching(tokens, max_words, min_count, new, old)[0])
        found = _pass(tokens, max_words, new, old, often)
        passes.append(stored(found.filter((F.col("n") >= min_count) | (F.col("k") == 0)), "phrases-counted"))
        if often is not None:
            often.unpersist()
        parts = passes[-1].filter((F.col("k") > 0) & (F.col("k") < max_words))
        failures = stored(_outside(parts, new), "phrases-failed")
        failed = failures.count()
        if not failed:
            break
        table, old, known = _bits_of(failures, bits, table), new, known + failed
    counted = reduce(DataFrame.unionAll, passes)
    words = passes[0].filter("k = 0").select("lang", F.col("n").alias("words"))
    return counted.filter((F.col("k") > 0) & (F.col("n") >= min_count)), words


def mine_phrases(docs: DataFrame, min_count: int = 30, max_words: int = 4, top: int | None = 2000,
                 covered_percent: int = 80, sample: int = SAMPLE, proposed: int = PROPOSED) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of 2 to ``max_words`` words
    of every language (None: all).

    ``a``: occurrences of the phrase; ``l``, ``r``: of its two parts at the cut with the lowest
    score (then the first such cut); ``score``: floor(2000000 * a / (l + r)); ``n``: words of the
    language. A phrase that lies in a longer one with at least ``covered_percent`` of its
    occurrences is left out.

    Edge cases: a null language is ``und``; null, empty and wordless texts hold no phrase; rows
    that repeat count again; doc_id only decides who is in the sample, so null and repeated ids
    change nothing; texts of any length are read whole, a block at a time; bytes that are not
    UTF-8 count as U+FFFD; ties end at the phrase's UTF-8 bytes; other columns are not read; an
    empty table gives an empty result.
    """
    if not 2 <= max_words <= 4:
        raise ValueError("phrases have at most 2 to 4 words")
    known, words = frequent_phrases(docs, min_count, max_words, sample, proposed)
    known = stored(known, "phrases-frequent")
    long = known.filter("k > 1").withColumn("w", F.split("phrase", " ", -1))
    joined = lambda first, size: F.array_join(F.slice("w", first, size), " ")

    # The lowest-scoring cut. Parts of a frequent phrase are frequent, so the joins find them.
    cuts = long.select("lang", "phrase", "w", "k", F.col("n").alias("a"),
                       F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", joined(F.lit(1), F.col("cut")).alias("left"),
                       joined(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"))
    part = known.select("lang", "phrase", "n")
    cuts = (cuts.join(part.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
            .join(part.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"]))
    score = F.expr("CAST(2000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(19, 0)) "
                   "DIV (CAST(l AS DECIMAL(19, 0)) + CAST(r AS DECIMAL(19, 0)))")
    scored = (cuts.withColumn("score", score.cast("long")).groupBy("lang", "phrase", "a")
              .agg(F.min(F.struct("score", "cut", "l", "r")).alias("best")))

    # The longest occurrences that hold a phrase, by the phrases inside longer ones.
    sizes = F.sequence(F.lit(2), F.col("k") - 1)
    inner = long.filter("k > 2").select("lang", "w", "k", "n", F.explode(sizes).alias("size"))
    inner = inner.select("lang", "w", "n", "size", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("at"))
    inner = (inner.select("lang", joined(F.col("at"), F.col("size")).alias("phrase"), "n")
             .groupBy("lang", "phrase").agg(F.max("n").alias("within")))
    kept = (scored.join(inner, ["lang", "phrase"], "left")
            .filter(F.col("within").isNull() | (100 * F.col("within") < covered_percent * F.col("a"))))
    order = Window.partitionBy("lang").orderBy(F.col("best.score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return (ranked.join(words.select(F.col("lang").alias("of"), "words"), F.col("lang") == F.col("of"))
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("best.l").alias("l"),
                    F.col("best.r").alias("r"), F.col("words").alias("n"), F.col("best.score").alias("score")))
