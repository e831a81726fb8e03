"""Language-model scores by prediction by partial matching over bytes.

A trie of byte contexts up to five bytes long is learned from all training texts. The
symbol after a context is coded by the longest context that has seen it; each shorter
step costs an escape (method C: as many escape counts as distinct symbols), and symbols
that a longer context has seen are excluded further down. For a fixed trie the code
length of a symbol depends only on the five symbols before it and itself, so it is
computed once per distinct six-symbol string:

1. texts are dealt into blocks of bounded size; a block keeps its texts, compressed, and
   counts its own distinct strings and words, one packed row per range of keys;
2. Spark brings the rows of a range together, whose counts are added up; a range holds all
   strings with the same last two context symbols, so that the trie's levels from two
   upwards are sums over suffixes; lower levels are tables of bounded size;
3. a range answers each block that asked it, and a block scores its texts.

Nothing that grows with the corpus is broadcast or collected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelboard.llm.tables import column, cut, in_fold
from duelboard.llm.wordkeys import buffer_keys, in_blocks, joined

ORDER = 5
BITS = 9
#: Symbols are byte + 1; END closes a text, 0 stands before its start.
END, SYMBOLS = 257, 257
TABLE = SYMBOLS + 1
BLOCK_BYTES = 24_000_000
#: Ranges of keys, as bits of a mixed key.
RANGE_BITS = 10
#: Distinct keys gathered before they are added up.
HELD_KEYS = 1_200_000
STRING, WORD, TEXT = 0, 1, 2
END_WORD = 0
_PACKED = "block int, kind int, range int, size int, keys binary, counts binary"
_SUMS = "kind int, range int, size int, keys binary, counts binary, total long, seen long"
_VALUES = "kind int, range int, size int, keys binary, values binary"
#: A string's value is the logarithm of its probability, a word's its count.
VALUE = {STRING: np.float32, WORD: np.int64}
#: Rows turned into Python strings at once.
ROWS_AT_ONCE = 200


def mask(order: int) -> int:
    """Bits of the last symbol and ``order`` symbols before it."""
    return (1 << BITS * (order + 1)) - 1


def strings(buffer: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For every byte, and for the end of every text, the symbol with the ORDER before it, as one number."""
    code = buffer.astype(np.int64) + 1
    code[ends - 1] = END
    out = code.copy()
    for k in range(1, ORDER + 1):
        out[k:] |= code[:-k] << BITS * k
    starts = np.concatenate(([0], ends[:-1]))
    for d in range(ORDER):  # symbols of the text before do not count
        at = starts + d
        at = at[at < ends]
        out[at] &= mask(d)
    return out


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their counts (of ones)."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[at], np.diff(np.append(at, len(keys))) if counts is None else np.add.reduceat(counts, at)


def text_parts(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts): a column in parts of bounded size."""
    for start in range(0, len(column), ROWS_AT_ONCE):
        texts = column.slice(start, ROWS_AT_ONCE).to_pylist()
        for a, b in in_blocks(texts):
            yield start + a, texts[a:b]


def keys_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(strings, their text ends, word keys, word offsets) of some texts."""
    buffer, ends = joined(texts)
    words, offsets = buffer_keys(buffer, ends)
    return strings(buffer, ends), ends, words.view(np.int64), offsets


def packed(values: np.ndarray) -> bytes:
    """An array's bytes, all first ones, then all second ones and so on, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize)
    return pa.compress(np.ascontiguousarray(planes.T).tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, size: int, dtype: type) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(data, size * width, codec="zstd", asbytes=True), np.uint8).reshape(width, size)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys by their steps."""
    return packed(np.diff(keys.view(np.uint64), prepend=np.uint64(0)))


def unpacked_keys(data: bytes, size: int) -> np.ndarray:
    return np.cumsum(unpacked(data, size, np.uint64), dtype=np.uint64).view(np.int64)


def key_range(kind: int, keys: np.ndarray) -> np.ndarray:
    """Range of each key; strings with the same last two context symbols share theirs."""
    spread = (keys >> BITS & mask(1) if kind == STRING else keys).astype(np.int64).view(np.uint64)
    return (spread * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - RANGE_BITS)).astype(np.int32)


def by_range(kind: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(range, its keys, their counts) of ascending keys."""
    where = key_range(kind, keys)
    order = np.argsort(where, kind="stable")
    found, first = np.unique(where[order], return_index=True)
    for number, at in zip(found.tolist(), np.split(order, first[1:])):
        yield number, keys[at], counts[at]


class Counter:
    """Sums of counts of keys, added up whenever many have gathered."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = self.last = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.size += len(keys)
        if self.size > self.last + max(self.last, HELD_KEYS // 2):
            self.sums()

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys, ascending, and their counts."""
        if len(self.parts) != 1:
            keys, counts = ([p[i] for p in self.parts] for i in (0, 1))
            self.parts = [summed(np.concatenate([np.zeros(0, np.int64), *keys]), np.concatenate([np.zeros(0, np.int64), *counts]))]
        self.size = self.last = len(self.parts[0][0])
        return self.parts[0]


def _table(rows: list[tuple], columns: str) -> pa.Table:
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    named = [c.split() for c in columns.split(", ")]
    return pa.table({name: pa.array([row[i] for row in rows], types[kind]) for i, (name, kind) in enumerate(named)})


def pack_block(table: pa.Table) -> pa.Table:
    """A block's texts in parts, and its distinct keys with their training counts by range; keys of held-out texts only have no count."""
    block, counters = table.column("block")[0].as_py(), {STRING: Counter(), WORD: Counter()}
    train, rows = table.column("train").to_numpy(zero_copy_only=False).astype(bool), []
    for start, texts in text_parts(table.column("text")):
        sink = pa.BufferOutputStream()
        part = table.slice(start, len(texts)).select(["doc_id", "text", "train"])
        with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(part)
        rows.append((block, TEXT, 0, len(texts), sink.getvalue().to_pybytes(), None))
        grams, ends, words, offsets = keys_of(texts)
        own = train[start : start + len(texts)]
        for kind, keys, lengths in ((STRING, grams, np.diff(ends, prepend=0)), (WORD, words, np.diff(offsets))):
            chosen = np.repeat(own, lengths)
            counters[kind].add(*summed(keys[chosen]))
            if not own.all():
                other = summed(keys[~chosen])[0]
                counters[kind].add(other, np.zeros(len(other), np.int64))
        counters[WORD].add(np.array([END_WORD]), np.array([own.sum()]))
    for kind, counter in counters.items():
        rows += [(block, kind, number, len(keys), packed_keys(keys), packed(counts)) for number, keys, counts in by_range(kind, *counter.sums())]
    return _table(rows, _PACKED)


def add_up(rows: pa.Table) -> pa.Table:
    """One row for a range: its keys and counts in all blocks, the sum of the counts, and how many are not zero."""
    counter = Counter()
    for size, keys, counts in zip(*(rows.column(c).to_pylist() for c in ("size", "keys", "counts"))):
        counter.add(unpacked_keys(keys, size), unpacked(counts, size, np.int64))
    keys, counts = counter.sums()
    kind, number = (rows.column(c)[0].as_py() for c in ("kind", "range"))
    return _table([(kind, number, len(keys), packed_keys(keys), packed(counts), int(counts.sum()), int((counts > 0).sum()))], _SUMS)


class Level:
    """One level of the trie: seen strings of one order, and totals of their contexts."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, below: "Level | None"):
        self.grams, self.counts = grams, counts
        self.contexts, first = np.unique(grams >> BITS, return_index=True)
        if len(grams):
            self.total = np.add.reduceat(counts, first)
            self.distinct = np.diff(np.append(first, len(grams)))
            if below is not None:  # what the level below loses by excluding this context's symbols
                lower = below.count(grams & below.mask)
                self.excluded = np.add.reduceat(lower, first)

    def count(self, grams: np.ndarray) -> np.ndarray:
        return _looked_up(self.grams, self.counts, grams)


def _looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


def code_lengths(grams: np.ndarray, counts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """log10 probability of each string's last symbol after its context.

    ``grams`` are all distinct strings of a group, with their training counts (0: not
    seen in training); a group holds every string with the same last two context
    symbols. ``table[c, s]`` counts symbol ``s`` after ``c`` in all training texts.
    """
    levels: dict[int, Level] = {}
    low_grams = np.flatnonzero(table.ravel())
    low = Level((low_grams // TABLE << BITS) | low_grams % TABLE, table.ravel()[low_grams], None)
    zero_counts = table.sum(axis=0)
    zero_grams = np.flatnonzero(zero_counts)
    zero = Level(zero_grams, zero_counts[zero_grams], None)
    zero.mask, low.mask = mask(0), mask(1)
    if len(low.grams):
        low.excluded = np.add.reduceat(zero.count(low.grams & zero.mask), np.unique(low.grams >> BITS, return_index=True)[1])
    levels[0], levels[1] = zero, low
    for order in range(2, ORDER + 1):
        own, n = summed(grams & mask(order), counts)
        levels[order] = Level(own[n > 0], n[n > 0], levels[order - 1])
        levels[order].mask = mask(order)
    out = np.zeros(len(grams))
    open_ = np.arange(len(grams))
    lost, gone = np.zeros(len(grams), np.int64), np.zeros(len(grams), np.int64)  # excluded counts and symbols
    for order in range(ORDER, -1, -1):
        level = levels[order]
        own = grams[open_] & level.mask
        n = level.count(own)
        context = own >> BITS
        total = _looked_up(level.contexts, level.total, context) if len(level.contexts) else np.zeros(len(own), np.int64)
        distinct = _looked_up(level.contexts, level.distinct, context) if len(level.contexts) else np.zeros(len(own), np.int64)
        left, escapes = total - lost[open_], distinct - gone[open_]
        whole = np.maximum(left + escapes, 1)
        seen = n > 0
        out[open_[seen]] += np.log10(n[seen] / whole[seen])
        escape = ~seen & (escapes > 0)
        out[open_[escape]] += np.log10(escapes[escape] / whole[escape])
        if order and len(level.contexts):
            lost[open_] = _looked_up(level.contexts, level.excluded, context)
        gone[open_] = distinct
        open_ = open_[~seen]
    out[open_] -= np.log10(np.maximum(SYMBOLS - gone[open_], 1))  # never seen: any symbol not excluded
    return out


def _symbol_table(counts: DataFrame) -> np.ndarray:
    """Counts of all pairs of neighbouring symbols: at most 258 x 258 rows come to the driver."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << 2 * BITS, np.int64)
        for batch in batches:
            for size, keys, n in zip(*(batch.column(c).to_pylist() for c in ("size", "keys", "counts"))):
                np.add.at(table, unpacked_keys(keys, size) & mask(1), unpacked(n, size, np.int64))
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(table[at])], ["pair", "n"])

    rows = counts.where(F.col("kind") == STRING).select("size", "keys", "counts").mapInArrow(pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    table = np.zeros((TABLE, TABLE), np.int64)
    for row in rows:
        table[row["pair"] >> BITS, row["pair"] & mask(0)] = row["n"]
    return table


def range_values(counts: DataFrame, table: np.ndarray) -> DataFrame:
    """(kind, range, size, keys, values): log10 probability of every counted string, count of every word."""
    shared = counts.sparkSession.sparkContext.broadcast(table)

    def value(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = unpacked(row["counts"], row["size"], np.int64)
                if row["kind"] == STRING:
                    n = code_lengths(unpacked_keys(row["keys"], row["size"]), n, shared.value)
                yield _table([(row["kind"], row["range"], row["size"], row["keys"], packed(n.astype(VALUE[row["kind"]])))], _VALUES).to_batches()[0]

    return counts.select("kind", "range", "size", "keys", "counts").mapInArrow(value, _VALUES)


def answer(asked: pa.Table, values: pa.Table) -> pa.Table:
    """A range's values of the keys that each block asked for."""
    rows = []
    if len(asked):
        kind, number = (asked.column(c)[0].as_py() for c in ("kind", "range"))
        size = values.column("size")[0].as_py()
        keys, value = unpacked_keys(values.column("keys")[0].as_py(), size), unpacked(values.column("values")[0].as_py(), size, VALUE[kind])
        for block, n, own in zip(*(asked.column(c).to_pylist() for c in ("block", "size", "keys"))):
            rows.append((block, kind, number, n, own, packed(value[np.searchsorted(keys, unpacked_keys(own, n))])))
    return _table(rows, _PACKED)


def dealt(rows: DataFrame, blocks: int) -> DataFrame:
    """``rows`` with the number of their block, which does not follow their content: repeated rows are spread too.

    A second evaluation may deal other rows to a block, so what follows is read from one stored evaluation.
    """
    return rows.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))


def score_texts(docs: DataFrame, block_bytes: int = BLOCK_BYTES, order_fold: int = 1) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs`` (doc_id, text).

    A-Z count as a-z, a null text as an empty one, a null id as the id ''. Training uses
    the rows whose ``crc32(doc_id)`` does not leave ``order_fold`` modulo 5. The model
    codes the text's bytes and an end symbol; ``base_score`` is the smoothed word score.
    Without training rows every symbol costs the same and the base score is that of no
    counts. Repeated rows are scored alike. Words are told apart by 64-bit keys.
    """
    text = F.coalesce(column(docs, "text"), F.lit(""))
    held_out = in_fold(column(docs, "doc_id"), order_fold)
    rows = docs.select(column(docs, "doc_id").alias("doc_id"), text.alias("text"), (~held_out).alias("train"))
    total = rows.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 1
    blocks = cut(dealt(rows, max(1, math.ceil(total / block_bytes))).groupBy("block").applyInArrow(pack_block, _PACKED), "blocks")
    asked = blocks.where(F.col("kind") != TEXT)
    counts = cut(asked.groupBy("kind", "range").applyInArrow(add_up, _SUMS), "counts")
    words = counts.where(F.col("kind") == WORD).agg(F.sum("total").alias("all"), F.sum("seen").alias("distinct")).first()
    n_all, n_distinct = words["all"] or 0, words["distinct"] or 0
    values = range_values(counts, _symbol_table(counts))

    def score(texts: pa.Table, answers: pa.Table) -> pa.Table:
        """Scores of a block's texts from the values of its keys."""
        found = {}
        for kind in (STRING, WORD):
            own = answers.filter(pa.compute.equal(answers.column("kind"), kind))
            sizes, packs, packed_values = (own.column(c).to_pylist() for c in ("size", "keys", "counts"))
            keys = np.concatenate([np.zeros(0, np.int64), *map(unpacked_keys, packs, sizes)])
            value = np.concatenate([np.zeros(0, VALUE[kind]), *(unpacked(v, n, VALUE[kind]) for v, n in zip(packed_values, sizes))])
            at = np.argsort(keys)
            found[kind] = keys[at], value[at]
        out = {c: [] for c in ("n_tokens", "n_known", "base_score", "score")}
        scale = math.log10(n_all + 0.5 * (n_distinct + 1))
        keys, value = found[WORD]
        end_count = value[np.searchsorted(keys, END_WORD)]
        ids = []
        for data in texts.column("keys"):
            part = pa.ipc.open_stream(data.as_buffer()).read_all()
            ids.append(part.select(["doc_id", "train"]))
            own = part.column("text").to_pylist()
            grams, ends, word_keys, offsets = keys_of(own)
            at = np.searchsorted(found[STRING][0], grams)
            out["score"].append(np.add.reduceat(found[STRING][1][at].astype(np.float64), np.concatenate(([0], ends[:-1]))))
            c = value[np.searchsorted(keys, word_keys)]
            # an end token closes each text's words
            closed = np.insert(c, offsets[1:], end_count)
            first = offsets[:-1] + np.arange(len(own))
            out["n_tokens"].append(np.diff(offsets) + 1)
            out["n_known"].append(np.add.reduceat((closed > 0).astype(np.int64), first))
            out["base_score"].append(np.add.reduceat(np.log10(closed + 0.5) - scale, first))
        names = pa.concat_tables(ids)
        columns = {c: np.concatenate(v) for c, v in out.items()}
        return pa.table(
            {
                "doc_id": names.column("doc_id"),
                "train": names.column("train"),
                "n_tokens": pa.array(columns["n_tokens"].astype(np.int64)),
                "n_known": pa.array(columns["n_known"].astype(np.int64)),
                "base_score": pa.array(columns["base_score"].astype(np.float64)),
                "score": pa.array(columns["score"].astype(np.float64)),
            }
        )

    answers = asked.select("kind", "range", "block", "size", "keys").groupBy("kind", "range").cogroup(values.groupBy("kind", "range")).applyInArrow(answer, _PACKED)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    scored = (
        blocks.where(F.col("kind") == TEXT)
        .select("block", "keys")
        .groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(score, f"doc_id {id_type}, train boolean, n_tokens long, n_known long, base_score double, score double")
    )
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", F.lit(n_all).cast("long").alias("train_tokens"), "base_score", "score")
