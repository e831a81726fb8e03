"""Hard negatives by inner product, with Fagin's threshold algorithm.

Vectors become whole numbers, floor(256 x). A task holds a block of candidates as one
list per dimension, sorted by that component. For an anchor the lists are read from their
high end where the anchor's component is positive, else from their low end; every row met
is scored in full (random access). What no list has shown yet scores at most the sum of
the anchor's components times the components read last: the threshold. Reading stops once
it lies strictly below the k-th score of what is searched, so that all ties have been seen.

Anchors are a stated query set (one in a hundred rows) and are taken in parts of bounded
size, broadcast to all blocks; candidates never move after they have been written once.
For each part a first pass finds the positives, which set the score windows, and a second
pass the negatives of each window. A block returns at most k rows per search.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelboard.llm.tables import column, cut, shared_folder

ANCHOR_EVERY = 100
K = 5
#: A negative scores at least this many hundredths of the positive's score.
LOWEST_SHARE = 80
SCALE = 256
#: Candidates of a block, and anchors broadcast at once.
BLOCK = 8_192
ANCHORS_AT_ONCE = 20_000
#: Rows read from each list at first; doubled with each step.
FIRST_DEPTH = 8
#: Whole numbers up to here are exact as doubles.
EXACT = 2**53
LONG = 2**63 - 1

_ROWS = "vec_id long, label long, vector array<double>"


def usable_rows(vectors: DataFrame, label: Column) -> DataFrame:
    """``_ROWS`` of the rows that take part; of rows that repeat an id, that with the smallest label and vector."""
    vector = column(vectors, "embedding").cast("array<double>")
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    good = vectors.select(column(vectors, "vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), vector.alias("vector"))
    good = good.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.forall("vector", finite), F.lit(False)))
    first = good.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
    return first.select("vec_id", "row.label", "row.vector")


def whole_numbers(x: np.ndarray) -> np.ndarray:
    """floor(256 x) of each component, as doubles, or as Python integers where doubles are not exact."""
    with np.errstate(over="ignore"):
        out = np.floor(x * SCALE)
    if np.abs(out).max(initial=0) < EXACT:
        return out
    exact = [[math.floor(v) * SCALE if abs(v) >= EXACT else math.floor(v * SCALE) for v in row] for row in x.tolist()]
    return np.array(exact, object).reshape(x.shape)


def as_integers(x: np.ndarray) -> np.ndarray:
    return np.array([int(v) for v in x.ravel().tolist()], object).reshape(x.shape)


class SortedLists:
    """A block of candidates with one sorted list per dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x
        self.order = np.argsort(x, axis=0, kind="stable")

    def search(self, anchor: np.ndarray, wanted: np.ndarray, windows: list[tuple[int, int] | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window of scores (lowest and highest times 100; None: all) its first k rows and their scores.

        Only rows flagged by ``wanted`` count; larger scores come first, ties by id.
        """
        n = len(self.x)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        seen, scores = np.zeros(n, bool), np.zeros(n, self.x.dtype)
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), scores[:0])] * len(windows)
        open_windows, depth, done = list(range(len(windows))), FIRST_DEPTH, 0
        if not len(up) and not len(down):  # every score is 0: nothing to read in order
            depth = n
        while open_windows:
            depth = min(depth, n)
            if len(up) or len(down):
                met = np.zeros(n, bool)
                met[self.order[n - depth : n - done, up]] = True
                met[self.order[done:depth, down]] = True
                new = np.flatnonzero(met & ~seen & wanted)
                seen |= met
            else:
                new = np.flatnonzero(wanted)
            if len(new) * 4 < n:
                scores[new] = self.x[new] @ anchor
            elif len(new):
                scores[new] = (self.x @ anchor)[new]
            limit = None  # no unseen row scores more
            if depth < n:
                last_up, last_down = self.order[n - depth, up], self.order[depth - 1, down]
                limit = self.x[last_up, up] @ anchor[up] + self.x[last_down, down] @ anchor[down]
            still = []
            for w in open_windows:
                window = windows[w]
                fits = new if window is None else new[(scores[new] * 100 >= window[0]) & (scores[new] * 100 <= window[1])]
                rows = np.concatenate((best[w][0], fits))
                rows = rows[np.lexsort((self.ids[rows], -scores[rows]))][:K]
                best[w] = rows, scores[rows]
                full = len(rows) == K and limit is not None and limit < scores[rows[-1]]
                below = limit is not None and window is not None and limit * 100 < window[0]
                if limit is not None and not full and not below:
                    still.append(w)
            open_windows, done, depth = still, depth, depth * 2
        return best


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[SortedLists]:
    """The rows of a task as blocks of vectors of one length."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        lengths = pc.list_value_length(batch.column("vector")).to_numpy()
        for dim in np.unique(lengths).tolist():
            own = batch.filter(pa.array(lengths == dim))
            x = own.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(len(own), dim)
            rows = held.setdefault(dim, [])
            rows.append((own.column("vec_id").to_numpy(), own.column("label").to_numpy(), x))
            if sum(len(r[0]) for r in rows) >= BLOCK:
                yield _block(held.pop(dim))
    for rows in held.values():
        yield _block(rows)


def _block(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> SortedLists:
    ids, labels, x = (np.concatenate(part) for part in zip(*rows))
    return SortedLists(ids, labels, whole_numbers(x))


class Anchors:
    """A part of the anchors, by vector length, with the scores of their positives once these are known."""

    def __init__(self, rows: list):
        by_length: dict[int, list] = {}
        for row in rows:
            by_length.setdefault(len(row["vector"]), []).append(row)
        self.rows = {dim: [(r["vec_id"], r["label"]) for r in own] for dim, own in by_length.items()}
        self.x = {dim: whole_numbers(np.array([r["vector"] for r in own], np.float64).reshape(len(own), dim)) for dim, own in by_length.items()}
        self.positives: dict[int, list[tuple[int, int]]] = {}

    def meet(self, block: SortedLists) -> Iterator[tuple[int, int, np.ndarray]]:
        """(id, label, vector) of the anchors of the block's length; in Python integers where doubles do not hold a hundred scores."""
        dim = block.x.shape[1]
        if dim not in self.rows:
            return
        x, high = self.x[dim], [int(np.abs(v).max(initial=0)) for v in (self.x[dim], block.x)]
        if max(dim, 1) * max(high[0], 1) * max(high[1], 1) * 100 >= EXACT:
            block.x, x = as_integers(block.x), as_integers(x)
        for (anchor, label), vector in zip(self.rows[dim], x):
            yield anchor, label, vector


def _returned(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    clipped = [[max(-LONG, min(LONG, int(v))) for v in c] for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in clipped], names)


def hard_negatives(vectors: DataFrame, label: Column | None = None, anchor_every: int = ANCHOR_EVERY) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, embedding and label (or the column given). Anchors are the rows
    whose vec_id is divisible by ``anchor_every``; an anchor's positives are its first five
    other rows of its label, the negatives of a positive the first five rows of other
    labels that score 80 to 100 hundredths of the positive's score. Larger scores come
    first, ties by vec_id. Rows without an id, a label or a vector, and those with null or
    non-finite components, take no part; of rows that repeat an id one does (the smallest
    label, then the smallest vector). Vectors of different lengths never meet. Scores
    beyond a long are brought to the largest long before windows are drawn from them. An
    empty table gives no rows.
    """
    spark = vectors.sparkSession
    label = column(vectors, "label") if label is None else label
    # blocks of few labels; a label with many rows spreads by their ids
    blocks = max(1, math.ceil(vectors.count() / BLOCK))
    rows = cut(usable_rows(vectors, label).repartitionByRange(blocks, "label", F.xxhash64("vec_id")), "candidates")
    asking = cut(rows.where(F.col("vec_id") % anchor_every == 0), "anchors")
    parts = max(1, math.ceil(asking.count() / ANCHORS_AT_ONCE))
    found = shared_folder(spark, "negatives")
    for part in range(parts):
        own = asking.where(F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == part).collect()  # about ANCHORS_AT_ONCE
        anchors = Anchors(own)
        for r in _positives(rows, anchors).collect():  # at most five for each anchor
            anchors.positives.setdefault(r["anchor_id"], []).append((r["positive_id"], r["positive_score"]))
        _negatives(rows, anchors).write.mode("append").parquet(found)
    return spark.read.schema(
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    ).parquet(found)


def _first(found: DataFrame, keys: list[str], score: str, tie: str) -> DataFrame:
    """The first k rows of each key with their rank, of all blocks' rows."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), tie)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= K)


def _positives(rows: DataFrame, anchors: Anchors) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(anchors)
    names = ["anchor_id", "positive_id", "positive_score"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            held, out = set(block.labels.tolist()), []
            for anchor, label, vector in shared.value.meet(block):
                if label in held:
                    wanted = (block.labels == label) & (block.ids != anchor)
                    at, scores = block.search(vector, wanted, [None])[0]
                    out += [(anchor, i, s) for i, s in zip(block.ids[at].tolist(), scores.tolist())]
            yield _returned(out, names)

    return _first(rows.mapInArrow(find, "anchor_id long, positive_id long, positive_score long"), ["anchor_id"], "positive_score", "positive_id")


def _negatives(rows: DataFrame, anchors: Anchors) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(anchors)
    names = ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            out = []
            for anchor, label, vector in shared.value.meet(block):
                positives = [(p, s) for p, s in shared.value.positives.get(anchor, []) if s >= 0]  # else 80 s > 100 s
                windows = [(LOWEST_SHARE * s, 100 * s) for _, s in positives]
                for (positive, score), (at, scores) in zip(positives, block.search(vector, block.labels != label, windows)):
                    out += [(anchor, positive, i, score, s) for i, s in zip(block.ids[at].tolist(), scores.tolist())]
            yield _returned(out, names)

    kinds = ", ".join(f"{name} long" for name in names)
    first = _first(rows.mapInArrow(find, kinds), ["anchor_id", "positive_id"], "negative_score", "negative_id")
    return first.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
