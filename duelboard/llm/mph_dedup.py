"""Exact duplicates, with a minimal perfect hash over the distinct digests of a history.

A text's digest is the SHA-256 of its UTF-8 bytes with A-Z lower-cased. The index over a
history is a table of buckets, by digest: each bucket holds a minimal perfect hash of its
distinct digests and, in the slot of each, the full digest, the winner's locator (id and
row) and the number of rows. The hash has levels of bits: a digest that is alone at its
place of a level sets that bit, the others go on to the next level; its slot is the number
of set bits before its own.

Arrivals are first gathered to distinct digests. A digest that is not in the history also
gets a slot (or falls through all levels), so the slot's 32 bytes decide: members are
added to their slot, the others make groups of their own. Digests spread evenly over
buckets whatever the texts, and a bucket meets its arrivals in chunks of bounded size.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelboard.llm.tables import column, cut, free_name
from duelboard.llm.wordkeys import mix

#: Digests of a bucket, on average, and arrivals that meet a bucket at once.
BUCKET = 20_000
#: Bits of a level for each digest that is still without a slot.
SPARSE = 2.0
#: Groups with more than this part of all rows are at most this many; they are joined by broadcast.
HOT_PARTS = 2_000

GROUPS = "digest binary, keep_id long, keep_row long, size long"
INDEX = "bucket int, levels array<long>, bits binary, digests binary, keep_ids array<long>, keep_rows array<long>, sizes array<long>"
_LONGS = pa.list_(pa.int64())
_INDEX_ARROW = pa.schema(
    [("bucket", pa.int32()), ("levels", _LONGS), ("bits", pa.binary()), ("digests", pa.binary()), ("keep_ids", _LONGS), ("keep_rows", _LONGS), ("sizes", _LONGS)]
)
_MERGED_ARROW = pa.schema([("digest", pa.binary()), ("keep_id", pa.int64()), ("keep_row", pa.int64()), ("size", pa.int64()), ("member", pa.bool_())])


def text_digests(texts: pa.Array) -> list[bytes]:
    """SHA-256 of each text in UTF-8, A-Z lower-cased; a null counts as empty."""
    return [hashlib.sha256((text.as_py() or b"").lower()).digest() for text in texts.cast(pa.large_binary())]


def digest_rows(docs: DataFrame, history: Column | None = None, row: Column | None = None) -> DataFrame:
    """id, row, digest, old: a row for every row of ``docs``; ``row`` tells rows apart, ``old`` marks the history."""
    marked = docs.select(
        column(docs, "doc_id").cast("long").alias("id"),
        (F.monotonically_increasing_id() if row is None else row).alias("row"),
        column(docs, "text").alias("text"),
        F.coalesce(F.lit(False) if history is None else history, F.lit(False)).alias("old"),
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = pa.array(text_digests(batch.column("text")), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("row"), digests, batch.column("old")], ["id", "row", "digest", "old"])

    return marked.mapInArrow(hashed, "id long, row long, digest binary, old boolean")


def distinct_digests(rows: DataFrame) -> DataFrame:
    """``GROUPS``: each digest once, with its winner and its rows.

    The largest id wins, of rows that share it any one; without any id the first row.
    """
    return rows.groupBy("digest").agg(
        F.max("id").alias("keep_id"),
        F.coalesce(F.max_by("row", "id"), F.min("row")).alias("keep_row"),
        F.count("*").alias("size"),
    )


def _matrix(digests: pa.Array) -> np.ndarray:
    """Digests as rows of four 64-bit words."""
    return np.frombuffer(b"".join(digests.to_pylist()), "<u8").reshape(len(digests), 4)


class PerfectHash:
    """Levels of bits over distinct digests; ``slots`` gives each member a number of its own."""

    def __init__(self, levels: list[int], bits: np.ndarray):
        self.levels, self.bits = levels, bits
        self.before = np.cumsum(bits) - bits

    @classmethod
    def over(cls, digests: np.ndarray) -> PerfectHash:
        levels, parts, rest = [], [], digests
        while len(rest):
            size = math.ceil(SPARSE * len(rest))
            place = cls.places(rest, len(levels), size)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(size)
            parts.append(alone)
            rest = rest[~alone[place]]
        return cls(levels, np.concatenate(parts) if parts else np.zeros(0, bool))

    @staticmethod
    def places(digests: np.ndarray, level: int, size: int) -> np.ndarray:
        """Place of each digest in a level; every level mixes all four words anew."""
        key = np.full(len(digests), level + 1, np.uint64)
        for word in range(4):
            key = mix(key ^ digests[:, word]) + np.uint64(level)
        return (key % np.uint64(size)).astype(np.int64)

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """Slot of each digest, -1 where every level is passed; what is no member may get a member's slot."""
        out = np.full(len(digests), -1, np.int64)
        rest, start = np.arange(len(digests)), 0
        for level, size in enumerate(self.levels):
            at = start + self.places(digests[rest], level, size)
            hit = self.bits[at]
            out[rest[hit]] = self.before[at[hit]]
            rest = rest[~hit]
            start += size
        return out


def _part(first: int, parts: int) -> Column:
    """Part of a digest by its four bytes from ``first`` on."""
    return (F.conv(F.hex(F.substring("digest", first, 4)), 16, 10).cast("long") % parts).cast("int")


def _chunk_of(digests: np.ndarray, chunks: int) -> np.ndarray:
    """The same as ``_part(5, chunks)``, of many digests."""
    return np.ascontiguousarray(digests).view(">u4")[:, 1].astype(np.int64) % chunks


def build_index(history: DataFrame, buckets: int) -> DataFrame:
    """One row per bucket, from ``GROUPS`` rows with distinct digests."""

    def build(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        digests = _matrix(rows.column("digest"))
        hashed = PerfectHash.over(digests)
        order = np.argsort(hashed.slots(digests))
        slots = rows.select(["keep_id", "keep_row", "size"]).take(pa.array(order)).to_pydict()
        row = {
            "bucket": key[0].as_py(),
            "levels": hashed.levels,
            "bits": np.packbits(hashed.bits).tobytes(),
            "digests": digests[order].tobytes(),
            "keep_ids": slots["keep_id"],
            "keep_rows": slots["keep_row"],
            "sizes": slots["size"],
        }
        return pa.Table.from_pylist([row], schema=_INDEX_ARROW)

    return history.withColumn("bucket", _part(1, buckets)).groupBy("bucket").applyInArrow(build, INDEX)


def merge_arrivals(index: DataFrame, buckets: int, arrivals: DataFrame, chunks: int) -> DataFrame:
    """``GROUPS`` and ``member``: the history's digests with their arrivals added, and the new digests.

    ``arrivals`` are ``GROUPS`` rows with distinct digests; ``member`` is true for the
    digests of the history. Each bucket meets ``chunks`` parts of its arrivals.
    """
    asked = arrivals.select("*", _part(1, buckets).alias("bucket"), _part(5, chunks).alias("chunk"))
    held = index.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))

    def probe(key: tuple[pa.Scalar, ...], slots: pa.Table, asking: pa.Table) -> pa.Table:
        wanted = _matrix(asking.column("digest"))
        member = np.zeros(len(wanted), bool)
        out: dict[str, list] = {"digest": [], "keep_id": [], "keep_row": [], "size": []}
        if len(slots):
            row = slots.to_pylist()[0]
            digests = np.frombuffer(row["digests"], "<u8").reshape(-1, 4)
            bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8))[: sum(row["levels"])].astype(bool)
            slot = PerfectHash(row["levels"], bits).slots(wanted)
            at = np.flatnonzero(slot >= 0)
            member[at] = (digests[slot[at]] == wanted[at]).all(axis=1)  # the stored bytes decide
            ids, rows, sizes = row["keep_ids"], row["keep_rows"], row["sizes"]
            more = asking.filter(pa.array(member)).to_pydict()
            for s, i, r, n in zip(slot[member].tolist(), more["keep_id"], more["keep_row"], more["size"]):
                sizes[s] += n
                if ids[s] is None or (i is not None and i > ids[s]):
                    ids[s], rows[s] = (ids[s], rows[s]) if i is None else (i, r)
            here = np.flatnonzero(_chunk_of(digests, chunks) == key[1].as_py()).tolist()  # each slot is returned by one chunk
            out = {"digest": [digests[s].tobytes() for s in here], "keep_id": [ids[s] for s in here], "keep_row": [rows[s] for s in here], "size": [sizes[s] for s in here]}
        new = asking.filter(pa.array(~member)).to_pydict()
        flags = [True] * len(out["size"]) + [False] * len(new["size"])
        return pa.table({**{k: v + new[k] for k, v in out.items()}, "member": flags}, schema=_MERGED_ARROW)

    return held.groupBy("bucket", "chunk").cogroup(asked.groupBy("bucket", "chunk")).applyInArrow(probe, GROUPS + ", member boolean")


def _group_table(rows: DataFrame) -> DataFrame:
    """``GROUPS`` over all of ``digest_rows``: the index over the history, then the arrivals that it meets."""
    old = cut(distinct_digests(rows.where("old")), "history")
    arrivals = cut(distinct_digests(rows.where("not old")), "arrivals")
    buckets = max(1, math.ceil(old.count() / BUCKET))
    chunks = max(1, math.ceil(arrivals.count() / buckets / BUCKET))
    index = cut(build_index(old, buckets), "index")
    return cut(merge_arrivals(index, buckets, arrivals, chunks).drop("member"), "groups")


def _decided(rows: DataFrame) -> DataFrame:
    """``rows`` with keep_id, keep_row and size of their groups.

    Groups with more than one row in ``HOT_PARTS`` are at most that many, so they go by
    broadcast and their rows stay where they are; the others meet their rows by digest.
    """
    groups = _group_table(rows).where("size > 1")
    total = rows.count()
    hot = F.col("size") * HOT_PARTS > total
    met = rows.join(F.broadcast(groups.where(hot)), "digest", "left")
    names = ["digest", "id", "row", "keep_id", "keep_row", "size"]
    cold = met.where("size is null").select("digest", "id", "row").join(groups.where(~hot), "digest", "left")
    both = met.where("size is not null").select(*names).unionByName(cold.select(*names))
    single = F.col("size").isNull()
    return both.select(
        "digest",
        "id",
        "row",
        F.when(single, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(single, F.col("row")).otherwise(F.col("keep_row")).alias("keep_row"),
        F.coalesce("size", F.lit(1)).cast("long").alias("size"),
    )


def exact_duplicates(docs: DataFrame, history: Column | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of ``docs`` (doc_id, text).

    Texts are equal when they are identical after lower-casing A-Z; null counts as empty.
    Of equal texts the row with the largest id stays; of rows that repeat that id, and of
    a group without any id (keep_id is null), one row stays. ``history`` marks the rows
    that the index is built over, the others are looked up in it; the result is the same
    whatever it marks, a null or no mark being an arrival.
    """
    rows = cut(digest_rows(docs, history), "digests")
    return _decided(rows).select(
        F.col("id").alias("doc_id"),
        "keep_id",
        F.col("size").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_repeats(docs: DataFrame, history: Column | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    name = free_name(docs, "row_number")
    numbered = cut(docs.select("*", F.monotonically_increasing_id().alias(name), F.coalesce(F.lit(False) if history is None else history, F.lit(False)).alias(free_name(docs, "in_history"))), "rows")
    rows = cut(digest_rows(numbered, column(numbered, free_name(docs, "in_history")), column(numbered, name)), "digests")
    staying = _decided(rows).where("row = keep_row").select(F.col("row").alias(name))
    return numbered.join(staying, name, "left_semi").select(*(column(numbered, c) for c in docs.columns))
