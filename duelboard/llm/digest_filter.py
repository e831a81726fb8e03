"""URL rules looked up in a sorted array of 64-bit digests.

The rules (host, path, verdict) are sorted by the xxhash of ``host + path``. Digests,
string offsets and the full strings lie in files that every executor fetches once and
maps into memory, so the workers of a machine share their pages and load only what
they touch. A URL asks for each of its parent domains with each path length that
occurs in the rules beside a host of that length; the keys of all URLs of a batch are
digested into one array and found by one vectorised binary search, and the stored
string decides, so a digest collision cannot give a false match.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelboard.llm.tables import column, free_name, shared_folder

VERDICTS = ("allow", "block")
#: Seed of Spark's xxhash64, so that both sides of a lookup give the same digest.
SEED = 42
#: Rules that the driver holds at once while it writes the files.
ROWS_AT_ONCE = 100_000
#: Keys that a batch of URLs looks up at once: bounds the memory of a worker.
KEYS_AT_ONCE = 200_000
ENTRY = np.dtype([("offset", "<u8"), ("length", "<u4"), ("host", "<u4"), ("verdict", "u1")])


def url_host(url: Column) -> Column:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), upper, lower), F.lit(""))


def url_path(url: Column) -> Column:
    """Path: after the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


class RuleFiles:
    """The three files of a rule list, by the names that executors know them by."""

    def __init__(self, name: str, shapes: list[tuple[int, int]]):
        self.name, self.shapes = name, shapes

    def part(self, kind: str) -> str:
        return f"{self.name}.{kind}"


def write_rules(rules: DataFrame, name: str = "rules") -> RuleFiles:
    """Sort ``rules`` (host, path, verdict) by digest, write the files and hand them to the executors.

    The driver streams the sorted rows and keeps ``ROWS_AT_ONCE`` of them. Of rules with
    the same host and path, ``allow`` beats ``block``; rules with a null are left out.
    """
    spark = rules.sparkSession
    clean = (
        rules.select(url_host(F.concat(F.lit("://"), "host")).alias("host"), "path", "verdict")
        .na.drop()
        .groupBy("host", "path")
        .agg(F.min("verdict").alias("verdict"))
    )
    shapes = clean.select(F.length("host").alias("h"), F.length("path").alias("p")).distinct().collect()
    ordered = (
        clean.select(F.concat("host", "path").alias("rule"), F.octet_length("host").alias("host"), "verdict")
        .withColumn("digest", F.xxhash64("rule"))
        .orderBy("digest", "rule", "host")
    )
    files = RuleFiles(f"{name}-{uuid.uuid4().hex}", sorted({(r["h"], r["p"]) for r in shapes}, key=lambda s: (-s[0] - s[1], -s[0])))
    folder = shared_folder(spark, name)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    outs = {}
    for kind in ("digests", "entries", "strings"):
        path = hadoop(f"{folder}/{files.part(kind)}")
        outs[kind] = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    offset, rows = 0, []

    def flush() -> None:
        nonlocal offset
        texts = [r["rule"].encode() for r in rows]
        entries = np.zeros(len(rows), ENTRY)
        entries["length"] = [len(t) for t in texts]
        entries["offset"] = offset + np.cumsum(entries["length"], dtype=np.uint64) - entries["length"]
        entries["host"] = [r["host"] for r in rows]
        entries["verdict"] = [VERDICTS.index(r["verdict"]) for r in rows]
        blob = b"".join(texts)
        for kind, data in (("digests", np.array([r["digest"] for r in rows], "<i8").tobytes()), ("entries", entries.tobytes()), ("strings", blob)):
            outs[kind].write(bytearray(data))
        offset += len(blob)
        rows.clear()

    for row in ordered.toLocalIterator():
        rows.append(row)
        if len(rows) >= ROWS_AT_ONCE:
            flush()
    flush()
    for kind, out in outs.items():
        out.close()
        spark.sparkContext.addFile(f"{folder}/{files.part(kind)}")
    return files


class RuleIndex:
    """A rule list mapped into memory."""

    def __init__(self, paths: dict[str, str], shapes: list[tuple[int, int]]):
        read = lambda kind, dtype: np.memmap(paths[kind], dtype, "r") if os.path.getsize(paths[kind]) else np.zeros(0, dtype)
        self.digests, self.entries, self.strings = read("digests", "<i8"), read("entries", ENTRY), read("strings", "u1")
        self.path_lengths: dict[int, list[int]] = {}
        for host_length, path_length in shapes:
            self.path_lengths.setdefault(host_length, []).append(path_length)
        for lengths in self.path_lengths.values():
            lengths.sort()

    def keys_of(self, host: str, path: str) -> list[tuple[int, int, str, str]]:
        """(length, host length, domain, path prefix) of all rules that could fit a URL."""
        out, start = [], 0
        while start >= 0:
            size = len(host) - start
            for n in self.path_lengths.get(size, ()):
                if n > len(path):
                    break
                out.append((size + n, size, host[start:], path[:n]))
            start = host.find(".", start) + 1 or -1  # after the last dot the loop ends
        return out

    def find(self, texts: list[bytes], hosts: list[int]) -> np.ndarray:
        """Index of the entry with that full string and host length, -1 where there is none."""
        keys = np.array([xxhash.xxh64_intdigest(t, SEED) for t in texts], np.uint64).view(np.int64)
        at = np.searchsorted(self.digests, keys)
        found = np.full(len(keys), -1)
        open_ = np.arange(len(keys))
        while len(open_):  # entries with the same digest follow one another
            open_ = open_[at[open_] < len(self.digests)]
            open_ = open_[self.digests[at[open_]] == keys[open_]]
            entries = self.entries[at[open_]]
            same = np.array(
                [
                    h == e["host"] and self.strings[int(e["offset"]) : int(e["offset"]) + int(e["length"])].tobytes() == t
                    for e, t, h in zip(entries, (texts[i] for i in open_), (hosts[i] for i in open_))
                ],
                bool,
            )
            found[open_[same]] = at[open_[same]]
            open_ = open_[~same]
            at[open_] += 1
        return found

    def match(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        """Entry of the longest rule that fits each URL, -1 where none fits."""
        best = np.full(len(hosts), -1)
        longest: dict[int, tuple[int, int]] = {}
        texts: list[bytes] = []
        host_bytes: list[int] = []
        owners: list[tuple[int, int, int]] = []

        def look_up() -> None:
            for (i, *size), entry in zip(owners, self.find(texts, host_bytes)):
                if entry >= 0 and tuple(size) > longest.get(i, (-1, -1)):
                    best[i], longest[i] = entry, tuple(size)
            texts.clear(), host_bytes.clear(), owners.clear()

        for i, (host, path) in enumerate(zip(hosts, paths)):
            for length, host_length, domain, prefix in self.keys_of(host, path):
                head = domain.encode()
                texts.append(head + prefix.encode())
                host_bytes.append(len(head))
                owners.append((i, length, host_length))
                if len(owners) >= KEYS_AT_ONCE:
                    look_up()
        look_up()
        return best

    def rule(self, entry: int) -> tuple[str, str]:
        e = self.entries[entry]
        start = int(e["offset"])
        return self.strings[start : start + int(e["length"])].tobytes().decode(), VERDICTS[int(e["verdict"])]


def judge_urls(df: DataFrame, rules: RuleFiles, url: str = "url", default: str = "allow") -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` and ``verdict`` of every URL.

    A rule fits its host and all subdomains if the path starts with the rule's path; the
    longest fitting rule decides, and of equally long ones that with the longer host. A
    URL that no rule fits gets rule null and ``default``. A null URL or one without
    ``://`` has an empty host and path. Repeated URLs are judged alike; columns of these
    names that ``df`` already has are replaced.
    """
    shapes, parts = rules.shapes, {k: rules.part(k) for k in ("digests", "entries", "strings")}

    @F.pandas_udf("rule string, verdict string")
    def look_up(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        index = RuleIndex({k: SparkFiles.get(v) for k, v in parts.items()}, shapes)
        for hosts, paths in batches:
            found = index.match(hosts.tolist(), paths.tolist())
            pairs = [index.rule(e) if e >= 0 else (None, default) for e in found]
            yield pd.DataFrame(pairs, columns=["rule", "verdict"], dtype="object")

    hit = free_name(df, "judged")
    url_column = column(df, url)
    out = df.withColumn(hit, F.struct(url_host(url_column).alias("host"), url_path(url_column).alias("path")))
    out = out.withColumn(f"{hit}_by", look_up(F.col(hit)["host"], F.col(hit)["path"]))
    own = {"host": F.col(hit)["host"], "path": F.col(hit)["path"], "rule": F.col(f"{hit}_by")["rule"], "verdict": F.col(f"{hit}_by")["verdict"]}
    kept = [column(df, c) for c in df.columns if c.lower() not in own]
    return out.select(*kept, *[v.alias(k) for k, v in own.items()])
