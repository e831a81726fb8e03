"""Near-duplicate vectors by product quantisation.

Coarse centroids split the vectors into inverted lists; a vector's residual to its
centroid is stored as one 4-bit code per subspace of four dimensions. A query vector
visits its own list and every list whose border to its own is nearer than a link can
reach, and takes its distances to what a list's codes stand for. By the triangle
inequality a code within ``reach + quantisation error`` of the query may be a link; all
of these, and only these, are compared by exact cosine in double precision.

Neighbouring lists are worked off together, in chunks of bounded size, so one list may
hold any share of the vectors, and a query is sent once to all lists of a group. A chunk
returns counts and a spanning forest of its links, never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelboard.llm.components import components
from duelboard.llm.tables import column, cut
from duelboard.llm.wordkeys import mix

COSINE = 0.95
SUBSPACE, CODES = 4, 16
#: Vectors that centroids and codebooks are fitted on, picked by hash: every vector is indexed.
MAX_SAMPLE = 30_000
#: Members of a group of lists that one chunk compares, and how many times as many queries.
CHUNK, QUERIES = 4_000, 4
#: Room for rounding in single precision, on top of exact bounds.
SLACK = 1e-4
_WORK = "bunch int, m_chunk int, q_chunk int, member boolean, list int, node long, n long, code binary, error double, vector binary"



def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmax(x @ centroids.T - 0.5 * (centroids**2).sum(axis=1), axis=1)


def cluster(x: np.ndarray, k: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """``k`` centroids (fewer if there are fewer rows) by Lloyd's rounds from random rows."""
    rng = np.random.Generator(np.random.PCG64(seed))
    centroids = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        own = _nearest(x, centroids)
        order = np.argsort(own, kind="stable")
        found, first = np.unique(own[order], return_index=True)
        centroids[found] = np.add.reduceat(x[order], first) / np.diff(np.append(first, len(x)))[:, None]
    return centroids


class Quantiser:
    """Centroids of the lists and codebooks of the residuals' subspaces."""

    def __init__(self, sample: np.ndarray, lists: int):
        centroids = cluster(sample, lists)
        near = _nearest(centroids, cluster(centroids, math.ceil(math.sqrt(len(centroids)))))
        self.centroids = centroids[np.argsort(near, kind="stable")]  # neighbouring lists have neighbouring numbers
        residuals = self._padded(sample - self.centroids[_nearest(sample, self.centroids)])
        self.books = np.stack([_filled(cluster(part, CODES, seed=s)) for s, part in enumerate(np.split(residuals, residuals.shape[1] // SUBSPACE, axis=1))])
        self.reach = math.sqrt(2 - 2 * COSINE)

    @staticmethod
    def _padded(x: np.ndarray) -> np.ndarray:
        return np.pad(x, ((0, 0), (0, -x.shape[1] % SUBSPACE)))

    def encode(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, length of what the codes miss) of the residuals to the own centroids."""
        residuals = self._padded(x - self.centroids[own]).reshape(len(x), -1, SUBSPACE)
        codes = np.stack([_nearest(residuals[:, s], book) for s, book in enumerate(self.books)], axis=1).astype(np.uint8)
        missed = residuals - self.books[np.arange(len(self.books)), codes]
        return codes, np.sqrt((missed**2).sum(axis=(1, 2)))

    def visits(self, x: np.ndarray, own: np.ndarray, lists: slice = slice(None)) -> np.ndarray:
        """Flags (vectors, lists): lists after the own one whose border is within a link's reach.

        A linked vector in another list lies beyond that list's border, so no link is lost.
        Of two lists within reach only the one with the higher number is visited, so each
        pair of vectors is compared once.
        """
        squares, others = (self.centroids**2).sum(axis=1), self.centroids[lists]
        distance = squares[lists][None] - 2 * x @ others.T
        home = squares[own] - 2 * (x * self.centroids[own]).sum(axis=1)
        between = np.sqrt(np.maximum(squares[own][:, None] + squares[lists][None] - 2 * self.centroids[own] @ others.T, 1e-12))
        border = (distance - home[:, None]) / (2 * between)
        return (border <= self.reach + SLACK) & (np.arange(len(squares))[lists][None] > own[:, None])

    def floors(self, codes: np.ndarray, errors: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vectors that codes stand for, products) in single precision: a unit vector links with a member only if its product reaches the floor.

        The distance to the code's vector is then at most ``reach`` and the member's error.
        """
        decoded = self.books[np.arange(len(self.books)), codes].reshape(len(codes), -1)[:, : self.centroids.shape[1]] + self.centroids[own]
        floor = (1 + (decoded**2).sum(axis=1) - (self.reach + errors) ** 2) / 2 - SLACK
        return decoded.astype(np.float32), floor.astype(np.float32)


def _filled(book: np.ndarray) -> np.ndarray:
    """A codebook of ``CODES`` rows: the last one again where the sample had fewer."""
    return np.concatenate([book, np.repeat(book[-1:], CODES - len(book), axis=0)])


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps the squares finite
    return x / np.sqrt((x**2).sum(axis=1, keepdims=True))


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for the nodes of some links, smallest nodes left out."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def vector_links(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors`` (vec_id, embedding).

    Vectors with a cosine of at least ``cosine`` are linked, those of different lengths
    never. Null, zero and empty vectors, and those with null or non-finite components,
    link with nothing: no links, their own id as component. Equal vectors are one node of
    the search and count as links of one another. Rows without an id count as links too
    and get the component's smallest id; without any id it is null and the row is kept.
    """
    if cosine != COSINE:
        raise ValueError(f"the search is tuned for a cosine of {COSINE}")
    embedding = column(vectors, "embedding")
    wide = "double" if "double" in vectors.select(embedding.alias("e")).dtypes[0][1] else "float"
    plain = embedding.cast(f"array<{wide}>")
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    usable = F.coalesce(F.forall(plain, finite) & F.exists(plain, lambda v: v != 0), F.lit(False))
    rows = vectors.select(column(vectors, "vec_id").alias("vec_id"), F.when(usable, plain).alias("vector"))
    rows = rows.withColumn("node", F.when(F.col("vector").isNotNull(), F.xxhash64("vector")))
    nodes = cut(
        rows.where("vector is not null").groupBy("node", "vector").agg(F.count("*").alias("n"), F.min("vec_id").alias("first_id")), "nodes"
    )
    found = None
    for dim in [r[0] for r in nodes.select(F.size("vector")).distinct().collect()]:
        part = _search(nodes.where(F.size("vector") == dim), dim, np.float64 if wide == "double" else np.float32)
        found = part if found is None else found.unionByName(part)
    found = cut(found if found is not None else vectors.sparkSession.createDataFrame([], "a long, b long, n long"), "found")
    labels = components(found.where("b is not null").select("a", "b"))
    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    own = (
        nodes.drop("vector")
        .join(labels, "node", "left")
        .join(counts, "node", "left")
        .select("node", F.coalesce("component", "node").alias("component"), (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"), "first_id")
    )
    classes = own.groupBy("component").agg(F.min("first_id").alias("component_id"))
    own = own.join(classes, "component").select("node", "n_links", "component_id")
    out = rows.select("vec_id", "node").join(own, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")
    )


def _search(nodes: DataFrame, dim: int, dtype: type) -> DataFrame:
    """(a, null, n): links of node ``a``; (a, b, null): link of the spanning forest of some chunk."""
    spark = nodes.sparkSession
    total = nodes.count()
    sample = nodes.select("vector").orderBy(F.xxhash64("node"), "node").limit(MAX_SAMPLE).toPandas()["vector"]
    sample = _unit(np.stack([np.asarray(v, np.float64) for v in sample]))
    lists = max(1, min(math.ceil(2 * math.sqrt(total)), len(sample) // 8))
    shared = spark.sparkContext.broadcast(Quantiser(sample, lists))  # at most MAX_SAMPLE / 8 centroids

    def vectors_of(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(batch), dim)

    def members_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Members of each list, per task."""
        q = shared.value
        members = np.zeros(len(q.centroids), np.int64)
        for batch in batches:
            members += np.bincount(_nearest(_unit(vectors_of(batch)), q.centroids), minlength=len(members))
        at = np.flatnonzero(members)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(members[at])], ["list", "members"])

    rows = nodes.select("vector").mapInArrow(members_of, "list int, members long").groupBy("list").agg(F.sum("members")).collect()
    members = np.zeros(len(shared.value.centroids), np.int64)  # one row per list
    for number, n in rows:
        members[number] = n
    first, held = [0], 0  # first list of each bunch of neighbouring lists
    for number, n in enumerate(members.tolist()):
        if held and held + n > CHUNK:
            first.append(number)
            held = 0
        held += n
    first = np.array(first)
    bunch_of = np.searchsorted(first, np.arange(len(members)), side="right") - 1

    def bunches(x: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Flags (vectors, bunches): where a vector is a query, its own bunch included."""
        flags = np.logical_or.reduceat(shared.value.visits(x, own), first, axis=1)
        flags[np.arange(len(x)), bunch_of[own]] = True
        return flags

    def queries_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries to each bunch, per task."""
        queries = np.zeros(len(first), np.int64)
        for whole in batches:
            for start in range(0, len(whole), 500):
                x = _unit(vectors_of(whole.slice(start, 500)))
                queries += bunches(x, _nearest(x, shared.value.centroids)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(first), dtype=np.int32)), pa.array(queries)], ["bunch", "queries"])

    rows = nodes.select("vector").mapInArrow(queries_of, "bunch int, queries long").groupBy("bunch").agg(F.sum("queries")).collect()
    held = np.add.reduceat(members, first)
    chunks = {number: (max(1, -(-int(held[number]) // CHUNK)), max(1, -(-n // (QUERIES * CHUNK)))) for number, n in rows}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Member and query rows of each vector, once for each chunk that they meet."""
        q = shared.value
        for whole in batches:
            for start in range(0, len(whole), 500):
                batch = whole.slice(start, 500)
                raw = vectors_of(batch)
                x = _unit(raw)
                own = _nearest(x, q.centroids)
                codes, errors = q.encode(x, own)
                visits = bunches(x, own)
                node, n = batch.column("node").to_numpy(), batch.column("n").to_numpy()
                spread = mix(node.view(np.uint64))
                out: list[tuple] = []
                for i in range(len(batch)):
                    vector, home, number = raw[i].tobytes(), int(bunch_of[own[i]]), int(own[i])
                    m_all, q_all = chunks[home]
                    m_chunk = int(spread[i] % np.uint64(m_all))
                    out += [(home, m_chunk, k, True, number, int(node[i]), int(n[i]), codes[i].tobytes(), float(errors[i]), vector) for k in range(q_all)]
                    for bunch in np.flatnonzero(visits[i]).tolist():
                        m_all, q_all = chunks[bunch]
                        q_chunk = int((spread[i] >> np.uint64(20)) % np.uint64(q_all))
                        out += [(bunch, k, q_chunk, False, number, int(node[i]), int(n[i]), None, 0.0, vector) for k in range(m_all)]
                names = [c.split()[0] for c in _WORK.split(", ")]
                types = [pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.float64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    def compare(rows: pa.Table) -> pa.Table:
        """Links between the members and the queries of one chunk of a bunch of lists."""
        q = shared.value
        is_member = rows.column("member").to_numpy(zero_copy_only=False)
        members, queries = rows.filter(pa.array(is_member)), rows.filter(pa.array(~is_member))
        empty = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        if not len(members) or not len(queries):
            return empty
        unpack = lambda t: _unit(np.frombuffer(b"".join(t.column("vector").to_pylist()), dtype).reshape(len(t), dim))
        members = members.sort_by("list")
        y, codes = unpack(members), np.frombuffer(b"".join(members.column("code").to_pylist()), np.uint8).reshape(len(members), -1)
        errors, y_node, y_n = (members.column(c).to_numpy() for c in ("error", "node", "n"))
        numbers, begin = np.unique(members.column("list").to_numpy(), return_index=True)
        ends = np.append(begin[1:], len(members))
        decoded, floor = q.floors(codes, errors, members.column("list").to_numpy())
        bunch = slice(int(numbers[0]), int(numbers[-1]) + 1)
        links, nodes_out, n_out = [], [], []
        for start in range(0, len(queries), 2_000):
            part = queries.slice(start, 2_000)
            x, x_list, x_node, x_n = unpack(part), *(part.column(c).to_numpy() for c in ("list", "node", "n"))
            visits, single = q.visits(x, x_list, bunch), x.astype(np.float32)
            for number, low, high in zip(numbers.tolist(), begin.tolist(), ends.tolist()):
                asking = np.flatnonzero(visits[:, number - bunch.start] | (x_list == number))
                for at in range(0, len(asking), 1_000):
                    some = asking[at : at + 1_000]
                    near = single[some] @ decoded[low:high].T >= floor[low:high]
                    if number in x_list[some]:  # pairs of one list once
                        near &= (x_list[some] != number)[:, None] | (x_node[some][:, None] < y_node[None, low:high])
                    i, j = np.nonzero(near)
                    for k in range(0, len(i), 200_000):
                        a, b = some[i[k : k + 200_000]], j[k : k + 200_000] + low
                        hit = np.einsum("ij,ij->i", x[a], y[b]) >= COSINE
                        a, b = a[hit], b[hit]
                        if len(a):
                            links.append(_forest(x_node[a], y_node[b]))
                            nodes_out += [x_node[a], y_node[b]]
                            n_out += [y_n[b], x_n[a]]
        if not nodes_out or not sum(map(len, nodes_out)):
            return empty
        node, place = np.unique(np.concatenate(nodes_out), return_inverse=True)
        n = np.zeros(len(node), np.int64)
        np.add.at(n, place, np.concatenate(n_out))
        a, b = _forest(np.concatenate([f[0] for f in links]), np.concatenate([f[1] for f in links]))
        return pa.table(
            {
                "a": np.concatenate((node, a)),
                "b": pa.array(np.concatenate((node, b)), mask=np.arange(len(node) + len(a)) < len(node)),
                "n": pa.array(np.concatenate((n, np.zeros(len(a), np.int64)))),
            }
        )

    return nodes.select("vector", "node", "n").mapInArrow(deal, _WORK).groupBy("bunch", "m_chunk", "q_chunk").applyInArrow(compare, "a long, b long, n long")
