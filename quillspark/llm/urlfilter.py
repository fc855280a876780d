"""URL filters: a sorted array of 64-bit digests, memory-mapped by every task.

A rule is a (host, path prefix) with a verdict. The rule table is turned into one file: the
sorted xxhash64 digests of ``host + path``, and the full strings in the same order. Spark
ships the file to the executors (``SparkContext.addFile``); tasks memory-map it. For a batch
of urls every (host suffix, path prefix) that a rule could have is hashed, all digests are
looked up with one vectorised binary search, and hits are confirmed against the stored string,
so a digest collision cannot give a verdict.

The file is built on the driver, so its size is checked first (``max_rule_bytes``); a larger
table is joined by shuffle on the same candidate keys (``judge_urls_by_join``), with the same
results.
"""

from __future__ import annotations

import os
import struct
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.common import map_batches, stored
from quillspark.session import ensure_checkpoint_dir

MAX_RULE_BYTES = 256 << 20
_MAGIC = b"URLRULE1"
_VERDICTS = ("allow", "block")


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): host after the first ``://`` with A-Z lower-cased, path up to ? or #."""
    if url is None:
        return "", ""
    at = url.find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3:]
    cut = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    host = rest[:cut].encode().lower().decode()
    path = rest[cut:]
    end = min((i for i in (path.find(c) for c in "?#") if i >= 0), default=len(path))
    return host, path[:end]


def candidates(host: str, path: str, path_lengths: list[int]) -> Iterator[tuple[str, str]]:
    """Every (host suffix at a label, path prefix of a length some rule has), longest first."""
    while host:
        for n in path_lengths:
            if n <= len(path):
                yield host, path[:n]
        dot = host.find(".")
        host = host[dot + 1:] if dot >= 0 else ""


class DigestArray:
    """The rule file: header, sorted digests, string offsets, verdicts, path lengths, strings."""

    def __init__(self, path: str) -> None:
        raw = np.memmap(path, dtype=np.uint8, mode="r")
        if bytes(raw[:8]) != _MAGIC:
            raise ValueError(f"{path} is not a rule file")
        n, n_lengths = struct.unpack("<qq", bytes(raw[8:24]))
        at = 24
        self.digests = raw[at:at + 8 * n].view(np.uint64)
        at += 8 * n
        self.offsets = raw[at:at + 8 * (n + 1)].view(np.int64)
        at += 8 * (n + 1)
        self.path_lengths = raw[at:at + 8 * n_lengths].view(np.int64).tolist()
        at += 8 * n_lengths
        self.verdicts = raw[at:at + n]
        self.strings = raw[at + n:]

    @staticmethod
    def write(rules: list[tuple[str, str, str]], path: str) -> None:
        """``rules``: (verdict, host, path prefix); of rules for one key the last is kept."""
        table = {host + prefix: (verdict, len(prefix)) for verdict, host, prefix in rules}
        rows = sorted((xxhash.xxh64_intdigest(k.encode()), k, v[0]) for k, v in table.items())
        lengths = sorted({v[1] for v in table.values()}, reverse=True)
        blobs = [k.encode() for _, k, _ in rows]
        with open(path, "wb") as f:
            f.write(_MAGIC + struct.pack("<qq", len(rows), len(lengths)))
            f.write(np.array([d for d, _, _ in rows], np.uint64).tobytes())
            f.write(np.cumsum([0, *map(len, blobs)], dtype=np.int64).tobytes())
            f.write(np.array(lengths, np.int64).tobytes())
            f.write(bytes(_VERDICTS.index(v) for _, _, v in rows))
            f.write(b"".join(blobs))

    def lookup(self, keys: list[str]) -> np.ndarray:
        """Index of each key's rule, or -1; digests may collide, strings decide."""
        out = np.full(len(keys), -1, np.int64)
        if not keys or not len(self.digests):
            return out
        blobs = [k.encode() for k in keys]
        d = np.fromiter(map(xxhash.xxh64_intdigest, blobs), np.uint64, len(blobs))
        lo = np.searchsorted(self.digests, d, "left")
        hi = np.searchsorted(self.digests, d, "right")
        for i in np.flatnonzero(hi > lo):
            for j in range(lo[i], hi[i]):
                if self.strings[self.offsets[j]:self.offsets[j + 1]].tobytes() == blobs[i]:
                    out[i] = j
                    break
        return out


def _stage_dir(spark: SparkSession) -> str:
    base = ensure_checkpoint_dir(spark)
    base = base.removeprefix("file:") if base.startswith("file:") else base
    if not base.startswith("/"):
        return tempfile.mkdtemp()  # read by the driver's addFile only
    path = os.path.join("/" + base.lstrip("/"), "urlrules")
    os.makedirs(path, exist_ok=True)
    return path


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], default: str = "allow",
               max_rule_bytes: int = MAX_RULE_BYTES) -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per input row.

    ``rules``: (verdict, host, path prefix). A rule fits its host and all subdomains when the
    url's path starts with the prefix; the longest rule (host + prefix, in characters; equal
    lengths: the longer host) decides. ``rule`` is host + prefix, or null when none fits; then
    the verdict is ``default``: a url that the digest array does not hold is allowed.

    Edge cases: a null url or one without ``://`` has empty host and path, so no rule fits;
    repeated urls and page ids are judged each for itself; an empty rule table gives every row
    the default; other columns are not read; an empty table gives an empty result.
    """
    if sum(len(h) + len(p) + 32 for _, h, p in rules) > max_rule_bytes:
        return judge_urls_by_join(pages, pages.sparkSession.createDataFrame(
            rules, "verdict string, host string, prefix string"), default)
    spark = pages.sparkSession
    name = f"urlrules-{uuid.uuid4().hex}.bin"
    staged = os.path.join(_stage_dir(spark), name)
    DigestArray.write(rules, staged)
    spark.sparkContext.addFile(staged)

    def judge(batches):
        array = DigestArray(SparkFiles.get(name))
        for b in batches:
            parts = [split_url(u) for u in b.column(1).to_pylist()]
            keys: list[str] = []
            owner: list[int] = []
            hosts: list[int] = []
            for i, (h, p) in enumerate(parts):
                for suffix, prefix in candidates(h, p, array.path_lengths):
                    keys.append(suffix + prefix)
                    owner.append(i)
                    hosts.append(len(suffix))
            rule: list[str | None] = [None] * len(parts)
            verdict = [default] * len(parts)
            best = [(-1, -1)] * len(parts)
            found = array.lookup(keys)
            for c in np.flatnonzero(found >= 0):
                i, size = owner[c], (len(keys[c]), hosts[c])
                if size > best[i]:
                    best[i], rule[i] = size, keys[c]
                    verdict[i] = _VERDICTS[array.verdicts[found[c]]]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([h for h, _ in parts], pa.string()),
                 pa.array([p for _, p in parts], pa.string()), pa.array(rule, pa.string()),
                 pa.array(verdict, pa.string())], names=["page_id", "host", "path", "rule", "verdict"])

    schema = "page_id long, host string, path string, rule string, verdict string"
    return map_batches(pages.select(F.col("page_id").cast("long"), "url"), judge, schema)


def judge_urls_by_join(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """The same verdicts for a rule table of any size: an equi-join on the candidate keys.

    The prefix lengths that occur must stay few (they are gathered as one distinct list).
    """
    after = F.regexp_extract("url", r"(?s)^.*?://(.*)$", 1)
    rest = F.when(F.col("url").contains("://"), after).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    # stored: both uses below must see the same row ids
    base = stored(pages.select(F.monotonically_increasing_id().alias("__row"), F.col("page_id").cast("long"),
                               host.alias("host"), path.alias("path")), "url-rows")
    lengths = rules.agg(F.collect_set(F.char_length("prefix")).alias("ns"))
    keyed = (rules.select("verdict", F.concat("host", "prefix").alias("rule"), F.monotonically_increasing_id().alias("at"))
             .groupBy("rule").agg(F.max_by("verdict", "at").alias("verdict")))  # the last rule of a key
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    probe = (base.filter(F.col("host") != "").join(F.broadcast(lengths))
             .select("__row", F.col("path"), F.explode(suffixes).alias("suffix"), "ns")
             .select("__row", "suffix", "path", F.explode("ns").alias("n"))
             .filter(F.col("n") <= F.char_length("path"))
             .select("__row", F.char_length("suffix").alias("h"),
                     F.concat("suffix", F.expr("substring(path, 1, n)")).alias("rule")))
    hits = probe.join(keyed, "rule")
    best = hits.groupBy("__row").agg(
        F.max_by(F.struct("rule", "verdict"), F.struct(F.char_length("rule"), "h")).alias("b"))
    return (base.join(best, "__row", "left")
            .select("page_id", "host", "path", F.col("b.rule").alias("rule"),
                    F.coalesce("b.verdict", F.lit(default)).alias("verdict")))
