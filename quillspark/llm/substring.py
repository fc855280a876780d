"""Substring dedup on words: seed and extend from winnowed anchors.

Seeds: every window of ``length`` words holds a winnowed anchor (a 6-word seed), about one in
eight words. Occurrences of a seed are joined on its digest. A seed that occurs once ends there.

Extension: a seed's run of windows reaches up to ``length - 6`` words to either side. The whole
run is compared first: where the same segment occurs at an earlier place, the match extends
through all of it. First occurrences of segments whose seed also occurs in other segments, the
edges of matches, are extended window by window against the earlier occurrences. Touching
windows join up, so what is removed is the union of the maximal repeats of at least ``length``
words.

Skew: equal segments and windows met in one task are settled there and only the earliest goes
on, so a passage in a third of all documents costs one row a task, not one an occurrence.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm import repeats as R
from quillspark.llm.common import WordHashes, map_batches, returning_memory, rows_of, stored, text_bytes
from quillspark.session import ship_package

GRAM = 6
_SEEDS = "seed long, seg long, doc long, ref long, n int, known boolean"


def word_digests(words: list[bytes], known: WordHashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def seeds(docs: DataFrame, length: int, gram: int = GRAM) -> DataFrame:
    """(seed, seg, doc, ref, n, known): the anchor runs of all texts.

    ``known``: an earlier equal segment was met in the same task; such rows get keys of their
    own, since they need no partner.
    """
    def of_texts(batches):
        known = WordHashes()
        for b in batches:
            for doc, text in rows_of(b, 0, 1):
                h = word_digests(text.split(), known)
                key = R.text_digest(text) << 32
                for base, lo, hi, _, digest, segment in R.runs(h, length, gram):
                    yield (digest.view(np.int64), segment.view(np.int64), np.full(len(lo), doc, np.int64),
                           lo + (base | key), (hi - lo + 1).astype(np.int32))

    def run(batches):
        for seed, seg, doc, ref, n in R.in_chunks(of_texts(batches)):
            # runs longer than 127 windows do not occur: a run has at most length - gram + 1
            first = R.first_of_equal(seg, doc, ref & 0x7FFFFFFF)
            seed = np.where(first, seed, R.salted(doc, ref))
            yield R.batch((seed, seg, doc, ref, n, ~first), ["seed", "seg", "doc", "ref", "n", "known"])

    return map_batches(docs.select(R.doc_order().alias("doc"), text_bytes()), run, _SEEDS)


def _settled(rows: DataFrame) -> DataFrame:
    """Add ``dup`` (an equal segment starts earlier) and ``edge`` (first of its segment, but its
    seed occurs in other segments too). One exchange, on the seed."""
    rank = F.rank().over(Window.partitionBy("seed", "seg").orderBy(*R.first_start()))
    by_seed = Window.partitionBy("seed")
    out = rows.repartition(F.col("seed")).withColumn("dup", F.col("known") | (rank > 1))
    out = out.withColumn("mixed", F.min("seg").over(by_seed) != F.max("seg").over(by_seed))
    return out.filter("dup or mixed").select("doc", "ref", "n", "dup")


def edge_windows(texts: DataFrame, edges: DataFrame, length: int) -> DataFrame:
    """(digest, doc, ref, known): every window of the edge segments."""
    def of_texts(batches):
        known = WordHashes()
        for b in batches:
            for doc, key, z, at in rows_of(b, 0, 1, 2, 3):
                h = word_digests(R.unpack(z).split(), known)
                at = np.unique(np.array(at, np.int64))
                start = np.unique(np.concatenate([np.arange(a >> 7, (a >> 7) + (a & 127)) for a in at.tolist()]))
                digest = R.mix(np.concatenate([R.roll(h[a:b + length], length) for a, b in _stretches(start)]))
                yield digest.view(np.int64), np.full(len(start), doc, np.int64), start + (key << 32)

    def run(batches):
        for digest, doc, ref in R.in_chunks(of_texts(batches)):
            first = R.first_of_equal(digest, doc, ref & 0x7FFFFFFF)
            yield R.batch((np.where(first, digest, R.salted(doc, ref)), doc, ref, ~first), ["digest", "doc", "ref", "known"])

    joined = R.with_spans(texts, edges, "inner").select("__doc", "__tkey", "__z", "__at")
    return map_batches(joined, run, "digest long, doc long, ref long, known boolean")


def _stretches(start: np.ndarray) -> list[tuple[int, int]]:
    """First and last of every stretch of consecutive numbers in a sorted array."""
    cut = np.flatnonzero(np.diff(start) != 1)
    return list(zip(start[np.concatenate(([0], cut + 1))].tolist(), start[np.concatenate((cut, [len(start) - 1]))].tolist()))


def repeated_spans(docs: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """(doc, ref, n): n windows from a start, each of which also starts earlier."""
    found = stored(_settled(seeds(docs, length)), "substring-runs")
    whole = found.filter("dup").select("doc", "ref", "n")
    windows = edge_windows(texts, found.filter("not dup").select("doc", "ref", "n"), length)
    rank = F.rank().over(Window.partitionBy("digest").orderBy(*R.first_start()))
    single = windows.withColumn("dup", F.col("known") | (rank > 1)).filter("dup").select("doc", "ref", F.lit(1).alias("n"))
    return whole.unionAll(single)


def remove_repeated_words(docs: DataFrame, length: int = 20, keep_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept_text]) per input row.

    A word goes when it lies in a window of ``length`` words that also starts earlier: in a
    smaller doc_id, or earlier in the same document. Windows are judged on the input.

    Edge cases: null and empty texts have no words (the digest is that of the empty text);
    texts under ``length`` words lose nothing; rows that share a doc_id count as one document at
    one place, so identical rows do not remove each other; null doc_ids come after all others;
    texts are read whole, long ones in blocks; other columns are not read; an empty table gives
    an empty result.
    """
    ship_package(docs.sparkSession)
    texts = R.carriers(docs, ["doc_id"])
    joined = R.with_spans(texts, repeated_spans(docs, texts, length), "left")
    kind = "n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * keep_text

    @F.pandas_udf(kind)
    @returning_memory
    def remove(z: pd.Series, at: pd.Series) -> pd.DataFrame:
        out = []
        for packed, spans in zip(z, at):
            words = R.unpack(packed).split()
            gone = R.covered(len(words), spans, length)
            kept = b" ".join(compress(words, (~gone).tolist()))
            row = (len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest())
            out.append((*row, kept.decode()) if keep_text else row)
        return pd.DataFrame(out, columns=[c.split()[0] for c in kind.split(", ")])

    return joined.select(F.col("doc_id").cast("long").alias("doc_id"), remove("__z", "__at").alias("__r")).select("doc_id", "__r.*")
