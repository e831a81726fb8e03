"""Near duplicates by BagMinHash signatures of word-shingle bags.

A text is the multiset of its five-word shingles. Weights are discretised at the whole
numbers; the levels [0,1), [1,2), [2,4), [4,8), ... of a shingle are the roots of
Poisson processes, and each point of a root descends by halving to the level it
belongs to, so a shingle of multiplicity ``w`` owns exactly the points below ``w``.
Every point falls into one of the signature's registers, which keep the earliest one:
two registers agree with the probability of the weighted Jaccard similarity. Time
limits that double until all registers are filled keep the number of points near
``W + m log m`` for a text of ``W`` shingles.

Bands of registers bring candidates together; their exact multiset overlap decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelboard.llm.components import components
from duelboard.llm.tables import column, cut, free_name
from duelboard.llm.wordkeys import in_blocks, mix, shingle_keys, word_keys

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: A pair of similarity 0.8 shares no band with probability (1 - 0.8^5)^25 = 5e-5.
BAND_ROWS, BANDS = 5, 25
REGISTERS = BAND_ROWS * BANDS
#: Shingles of a bucket's members that one group compares.
CHUNK_SHINGLES = 100_000
#: Candidate texts looked up by a broadcast of their keys up to this many, by a shuffle beyond.
BROADCAST_KEYS = 1_000_000


_SIGNED = T.StructType().add("weight", "long").add("bands", T.ArrayType(T.LongType()))


def bags(texts: list[str | None], size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle key, multiplicity) of all distinct shingles, ordered by text and key."""
    words, word_offsets = word_keys(texts)
    keys, offsets = shingle_keys(words, word_offsets, size)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((keys, doc))
    keys, doc = keys[order], doc[order]
    first = np.ones(len(keys), bool)
    first[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(first)
    return doc[at], keys[at], np.diff(np.append(at, len(keys)))


def signatures(doc: np.ndarray, keys: np.ndarray, counts: np.ndarray, n: int, m: int = REGISTERS) -> np.ndarray:
    """Registers (n, m) of ``n`` bags; a bag without elements keeps all ones.

    Times are kept as whole multiples of 2^-32, so equal points give equal registers.
    """
    total = np.bincount(doc, counts, n)
    # roots of each element: 0 covers [0,1); k covers [2^(k-1), 2^k)
    roots = np.where(counts > 1, np.ceil(np.log2(np.maximum(counts, 1))).astype(np.int64), 0) + 1
    owner = np.repeat(np.arange(len(keys)), roots)
    root = np.arange(len(owner)) - np.repeat(np.cumsum(roots) - roots, roots)
    low = np.where(root > 0, 2.0 ** (root - 1), 0.0)
    span = np.where(root > 0, low, 1.0)
    node = mix(keys[owner] + root.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    own_doc, weight = doc[owner], counts[owner]
    registers = np.full(n * m, np.inf)
    time, point = np.zeros(len(node)), np.zeros(len(node), np.uint64)

    def advance(i: np.ndarray) -> None:
        point[i] += np.uint64(1)
        draw = mix(node[i] ^ mix(point[i]))
        time[i] -= np.log(((draw >> np.uint64(11)) + np.uint64(1)).astype(np.float64) * 2.0**-53) / span[i]

    advance(np.arange(len(node)))
    limit = m * (np.log(m) + 3) / np.maximum(total, 1)
    open_docs = total > 0
    while open_docs.any():
        active = np.flatnonzero(open_docs[own_doc] & (time <= limit[own_doc]))
        while len(active):
            draw = mix(node[active] + point[active] * np.uint64(0xD1342543DE82EF95))
            place = (draw >> np.uint64(40)).astype(np.int64) % m
            level = low[active] + np.floor((draw & np.uint64(2**40 - 1)).astype(np.float64) * 2.0**-40 * span[active])
            inside = level < weight[active]
            hit = active[inside]
            np.minimum.at(registers, own_doc[hit] * m + place[inside], time[hit])
            advance(active)
            active = active[time[active] <= limit[own_doc[active]]]
        # filled registers below the limit cannot change any more
        open_docs &= registers.reshape(n, m).max(axis=1, initial=0) > limit
        limit = np.where(open_docs, 2 * limit, limit)
    out = np.full(n * m, 2**64 - 1, np.uint64)
    done = np.isfinite(registers)
    out[done] = mix((registers[done] * 2.0**32).astype(np.uint64))
    return out.reshape(n, m)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """Signed 64-bit key of each band of each signature."""
    n = len(registers)
    out = np.zeros((n, BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(BAND_ROWS):
        out = mix(out * np.uint64(0x2545F4914F6CDD1D) + registers[:, k::BAND_ROWS][:, :BANDS])
    return out.view(np.int64)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags (sorted keys, multiplicities)."""
    (keys_a, n_a), (keys_b, n_b) = a, b
    if not len(keys_a) or not len(keys_b):
        return 0.0
    at = np.minimum(np.searchsorted(keys_a, keys_b), len(keys_a) - 1)
    same = keys_a[at] == keys_b
    shared = np.minimum(n_a[at[same]], n_b[same]).sum()
    return float(shared / (n_a.sum() + n_b.sum() - shared))


@F.pandas_udf(_SIGNED)
def _signed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        texts = texts.tolist()
        parts = [pd.DataFrame({"weight": [], "bands": []})]
        for a, b in in_blocks(texts):
            doc, keys, counts = bags(texts[a:b])
            registers = signatures(doc, keys, counts, b - a)
            weight = np.bincount(doc, counts, b - a).astype(np.int64)
            bands = band_keys(registers)
            parts.append(pd.DataFrame({"weight": weight, "bands": [row if w else row[:0] for row, w in zip(bands, weight)]}))
        yield pd.concat(parts[1:] or parts, ignore_index=True)


@F.pandas_udf(T.DoubleType())
def _similarity(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Exact overlap of two texts; a run of rows with the same first text counts its shingles once."""
    last, bag = None, None
    for lefts, rights in batches:
        out = []
        for left, right in zip(lefts, rights):
            if left != last:
                last, bag = left, bags([left])[1:]
            out.append(overlap(bag, bags([right])[1:]))
        yield pd.Series(out, dtype="float64")


@F.pandas_udf(T.BinaryType())
def _packed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Bag of each text as bytes: sorted keys, then multiplicities."""
    for texts in batches:
        packed = []
        for text in texts:
            _, keys, counts = bags([text])
            packed.append(keys.tobytes() + counts.astype(np.uint64).tobytes())
        yield pd.Series(packed, dtype="object")


def _joined_by_links(rows: pa.Table, similarity: float) -> pa.Table:
    """Links (a, b) that join different classes among the members of a bucket's chunks.

    Members of the left chunk are compared with those of the right one, each pair only
    in the first band that it shares. Pairs already in one class are passed over, also
    when links found here have joined them, so at most one link per member comes back.
    """
    size = len(rows)
    node, label, weight = (rows.column(c).to_numpy() for c in ("node", "component", "weight"))
    left = rows.column("left").to_numpy(zero_copy_only=False)
    right = rows.column("right").to_numpy(zero_copy_only=False)
    bands = rows.column("bands").combine_chunks().flatten().to_numpy().reshape(size, BANDS)
    band = rows.column("band")[0].as_py()
    parts = [np.frombuffer(b, np.uint64) for b in rows.column("bag").to_pylist()]
    keys = [p[: len(p) // 2] for p in parts]
    counts = [p[len(p) // 2 :].astype(np.int64) for p in parts]
    owner = np.repeat(np.arange(size), [len(k) for k in keys])
    all_keys, all_counts = np.concatenate(keys), np.concatenate(counts)
    found_a, found_b = [], []
    for i in np.flatnonzero(left):
        other = right & (label != label[i]) & (similarity * np.maximum(weight, weight[i]) <= np.minimum(weight, weight[i]))
        other[i] = False
        other &= ~(bands[:, :band] == bands[i, :band]).any(axis=1)
        if not other.any():
            continue
        chosen = other[owner]
        at = np.minimum(np.searchsorted(keys[i], all_keys[chosen]), len(keys[i]) - 1)
        same = keys[i][at] == all_keys[chosen]
        shared = np.bincount(owner[chosen][same], np.minimum(counts[i][at[same]], all_counts[chosen][same]), size)
        for j in np.flatnonzero(other & (shared >= similarity * (weight + weight[i] - shared))):
            if label[j] != label[i]:
                found_a.append(node[i])
                found_b.append(node[j])
                label = np.where(label == label[j], label[i], label)
    return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})


def text_node(text: Column) -> tuple[Column, Column]:
    """Two independent 64-bit (60-bit) hashes: together they identify a text."""
    return F.xxhash64(text), F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def near_duplicate_classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id, n_class, kept of every row of ``docs`` (doc_id, text).

    Two texts are linked if the weighted Jaccard similarity of their five-word shingle
    bags is at least ``similarity``; a class is a set of texts joined by links, with all
    their exact copies. ``class_id`` is its smallest id, ``kept`` marks the row with that
    id. A text of fewer than five words is one shingle. Texts without words, null ones
    included, are alike only to exact copies: empty ones to empty ones, null to null.
    Rows without an id never give the class id unless no row of the class has one; then
    the id is null and all its rows are kept. Repeated ids get one row each.

    Copies are one node each. Members of a band bucket are compared with its best
    connected member. In buckets whose members still lie in different classes, all of
    these are compared, chunk by chunk, so no link between a bucket's members is lost.
    """
    return _classes(docs, similarity).select("doc_id", "class_id", "n_class", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def _classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, node, check, class_node, class_check, class_id, n_class of every row; node and check are the text's, the class's two tell classes of equal id apart."""
    column_id, text = column(docs, "doc_id"), column(docs, "text")
    node, check = text_node(F.coalesce(text, F.lit("\u0000null")))
    signed = docs.select(column_id.alias("doc_id"), node.alias("node"), check.alias("check"), _signed(text).alias("s"))
    signed = cut(signed.select("doc_id", "node", "check", "s.bands"), "signed")

    # exact copies: one representative per text; hash collisions of the first key stand apart
    firsts = signed.groupBy("node", "check").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
    main = firsts.groupBy("node").agg(F.min("check").alias("check"))
    firsts = cut(firsts.join(main.withColumn("main", F.lit(True)), ["node", "check"], "left"), "firsts")

    # buckets with at least two different texts
    rows = signed.select("node", F.posexplode("bands").alias("band", "bucket"))
    mixed = rows.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("size")).where("low < high")
    members = cut(rows.join(mixed.select("bucket", "size"), "bucket").distinct(), "members")

    texts = _candidate_texts(docs, node, check, members.select("node").distinct(), firsts)
    degrees = members.groupBy("node").agg(F.sum("size").alias("degree"))
    ranked = members.join(degrees, "node")
    top = ranked.groupBy("bucket").agg(F.max("degree").alias("degree"))
    leaders = ranked.join(top, ["bucket", "degree"]).groupBy("bucket").agg(F.min("node").alias("leader"))
    tested = cut(
        _verified(members.select("bucket", "node").join(leaders, "bucket").where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), texts),
        "tested",
    )
    linked = tested.where(F.col("similarity") >= similarity)
    labels = components(linked)

    # what the leaders left apart: all members of different classes, exactly
    more = cut(_rest(members, labels, texts, similarity), "more")
    if not more.isEmpty():
        labels = components(linked.select("a", "b").unionByName(more))

    # back to documents
    own = firsts.where("main").join(labels, "node").select("node", "check", "component", "first_id", "n")
    per_class = own.groupBy("component").agg(F.min("first_id").alias("class_id"), F.sum("n").alias("n_class"))
    classes = firsts.join(own.select("node", "check", "component"), ["node", "check"], "left").join(per_class, "component", "left")
    classes = classes.select(
        "node",
        "check",
        F.coalesce("component", "node").alias("class_node"),
        F.when(F.col("component").isNull(), F.col("check")).otherwise(F.lit(-1)).alias("class_check"),
        F.coalesce("class_id", "first_id").alias("class_id"),
        F.coalesce("n_class", "n").alias("n_class"),
    )
    return signed.select("doc_id", "node", "check").join(classes, ["node", "check"])


def _rest(members: DataFrame, labels: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between members of a bucket that ``labels`` leaves in different classes."""
    labelled = members.select("bucket", "band", "node").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    open_ = labelled.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("bucket")
    rest = cut(labelled.join(open_, "bucket").join(texts.select("node", "weight"), "node"), "rest")
    chunks = rest.groupBy("bucket").agg(F.ceil(F.sum("weight") / CHUNK_SHINGLES).cast("int").alias("chunks"))
    bags_ = cut(texts.join(rest.select("node").distinct(), "node", "left_semi").select("node", "bands", _packed("text").alias("bag")), "bags")
    # each pair of chunks is a group; a member goes to all pairs with its own chunk
    own = rest.join(chunks, "bucket").withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    placed = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "bucket",
        "band",
        "node",
        "component",
        "weight",
        F.least("own", "other").alias("c0"),
        F.greatest("own", "other").alias("c1"),
        (F.col("own") <= F.col("other")).alias("left"),
        (F.col("own") >= F.col("other")).alias("right"),
    )
    return (
        placed.join(bags_, "node")
        .groupBy("bucket", "c0", "c1")
        .applyInArrow(lambda rows: _joined_by_links(rows, similarity), "a long, b long")
    )


def _candidate_texts(docs: DataFrame, node: Column, check: Column, wanted: DataFrame, firsts: DataFrame) -> DataFrame:
    """node, text, weight, bands of the wanted nodes, one row each, written to the shared folder."""
    wanted = wanted.join(firsts.where("main").select("node", "check", "first_id"), "node")
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_KEYS else wanted
    rows = docs.select(column(docs, "doc_id").alias("first_id"), node.alias("node"), check.alias("check"), column(docs, "text").alias("text"))
    # one row each, but for rows without an id and repeated rows
    found = rows.join(wanted.withColumnRenamed("first_id", "id"), ["node", "check"]).where(F.col("first_id").eqNullSafe(F.col("id")))
    found = found.select("node", "text").dropDuplicates(["node"])
    return cut(found.select("node", "text", _signed("text").alias("s")).select("node", "text", "s.weight", "s.bands"), "texts")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b, similarity of the pairs (a, b) of nodes."""
    left, right = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", _similarity("text_a", "text_b").alias("similarity"))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """Rows of ``docs``, unchanged, that stay: one of each near-duplicate class.

    It is the row with the class's smallest id; of rows with that id and different texts
    of the class, one. Rows that repeat both id and text count once; rows without an id
    stay if their class has no id at all.
    """
    rows = _classes(docs).where(F.col("doc_id").eqNullSafe(F.col("class_id")))
    texts = rows.groupBy("class_node", "class_check", "doc_id", "node", "check").agg(F.count("*").alias("n"))
    first = F.min_by(F.struct("node", "check", "n"), F.struct("node", "check")).alias("first")
    named = texts.where("doc_id is not null").groupBy("class_node", "class_check", "doc_id").agg(first).select("doc_id", "first.*")
    classes = cut(named.unionByName(texts.where("doc_id is null").select("doc_id", "node", "check", "n")), "kept")
    kept_id, kept_node, kept_check, copies, text_key = (free_name(docs, n) for n in ("kept_id", "kept_node", "kept_check", "copies", "text_key"))
    wanted = classes.select(F.col("doc_id").alias(kept_id), F.col("node").alias(kept_node), F.col("check").alias(kept_check), F.col("n").alias(copies))
    key = column(docs, "doc_id")
    node, check = text_node(F.coalesce(column(docs, "text"), F.lit("\u0000null")))
    same = (node == F.col(kept_node)) & (check == F.col(kept_check))
    several = (F.col(copies) > 1) & F.col(kept_id).isNotNull()
    single = docs.join(wanted.where(~several).drop(copies), key.eqNullSafe(F.col(kept_id)) & same, "left_semi")
    repeated = wanted.where(several).drop(copies)
    if repeated.isEmpty():
        return single
    again = docs.join(repeated, (key == F.col(kept_id)) & same, "left_semi")
    return single.unionByName(again.withColumn(text_key, node).dropDuplicates(["doc_id", text_key]).drop(text_key))
