"""Benchmark items inside documents, up to an edit distance.

An item that may differ in ``k`` places is split into ``k + 1`` pieces; by the pigeonhole
principle at least one piece occurs unchanged. All pieces of a block of items form one
automaton that reads each document once. The pieces of an item are the leaves of a
binary tree; a node of ``n`` pieces may differ in ``n - 1`` places. If a node is within
its budget, so is one of its children (else both together exceed it), so a hit is
followed from its piece upwards and given up at the first node that Myers' bit-parallel
algorithm does not find around it. At the root, Myers gives the smallest edit distance
of the whole item to a part of the text. No match is lost on the way.
Texts are compared in lower case with white space runs as one space.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelboard.llm.tables import column, free_name

#: Errors allowed per character of an item.
ERROR_RATE = 0.12
#: Characters of items handled in one pass over the documents: bounds a task's automaton.
BLOCK_CHARS = 2_000_000


def plain(text: str | None) -> str:
    """Lower case, white space runs as one space, none at the ends."""
    return " ".join((text or "").lower().split())


def piece_offsets(length: int, errors: int) -> list[int]:
    """Borders of ``errors + 1`` pieces of nearly equal length that make up an item."""
    return [length * i // (errors + 1) for i in range(errors + 2)]


def ancestors(piece: int, n: int) -> list[tuple[int, int]]:
    """Tree nodes (first piece, piece after the last) above a piece, the smallest first, the root left out."""
    low, high, path = 0, n, []
    while high - low > 1:
        path.append((low, high))
        middle = (low + high) // 2
        low, high = (low, middle) if piece < middle else (middle, high)
    return path[:0:-1]


@lru_cache(maxsize=20_000)
def sign_bits(pattern: str) -> dict[str, int]:
    """For each sign of a pattern, the places it stands at."""
    bits: dict[str, int] = {}
    for i, sign in enumerate(pattern):
        bits[sign] = bits.get(sign, 0) | 1 << i
    return bits


def myers(pattern: str, text: str, most: int, first: bool = False) -> int | None:
    """Smallest distance of the pattern to any part of ``text``, if at most ``most``; ``first``: of the first such part."""
    pattern_bits, length = sign_bits(pattern), len(pattern)
    ones, top = (1 << length) - 1, 1 << (length - 1)
    plus, minus, score = ones, 0, length
    best = None
    for sign in text:
        equal = pattern_bits.get(sign, 0)
        x = equal | minus
        d0 = ((((x & plus) + plus) ^ plus) | x) & ones
        up = minus | (~(d0 | plus) & ones)
        down = plus & d0
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = up << 1 & ones  # a match may start anywhere, so the first row stays 0
        minus = up & d0
        plus = (down << 1 & ones) | (~(d0 | up) & ones)
        if score <= most and (best is None or score < best):
            best = score
            if first:
                break
    return best


class Matcher:
    """Automaton of the pieces of one block of items."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.items, owners = [], {}
        for item_id, text in items:
            text = plain(text)
            if not text:
                continue
            errors = int(len(text) * rate)
            cuts = piece_offsets(len(text), errors)
            for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                owners.setdefault(text[a:b], []).append((len(self.items), k))
            self.items.append((item_id, text, errors))
        self.automaton = ahocorasick.Automaton()
        for piece, own in owners.items():
            self.automaton.add_word(piece, (len(piece), own))
        if owners:
            self.automaton.make_automaton()

    def find(self, text: str | None) -> list[tuple[int, int]]:
        """(item id, distance) of every item within its error budget of a part of the text."""
        text = plain(text)
        if not self.items or not text:
            return []
        hits: dict[tuple[int, int], list[int]] = {}
        for end, (size, own) in self.automaton.iter(text):
            for owner in own:
                hits.setdefault(owner, []).append(end + 1 - size)
        starts: dict[int, set[int]] = {}
        whole: set[int] = set()
        for (number, piece), places in hits.items():
            kept = [] if number in whole else self._climb(number, piece, places, text)
            if not kept:
                continue
            if number not in starts and self.items[number][1] in text:
                whole.add(number)
            starts.setdefault(number, set()).update(kept)
        found = [(self.items[number][0], 0) for number in whole]
        for number, places in starts.items():
            item_id, item, errors = self.items[number]
            if number in whole:
                continue
            windows = _windows(sorted(places), len(item), errors, len(text))
            distances = [d for a, b, _ in windows if (d := myers(item, text[a:b], errors)) is not None]
            if distances:
                found.append((item_id, min(distances)))
        return sorted(found)

    def _climb(self, number: int, piece: int, places: list[int], text: str) -> list[int]:
        """Where the item would start, for the places of a piece around which all nodes below the root are found."""
        _, item, errors = self.items[number]
        cuts, first = piece_offsets(len(item), errors), True
        for low, high in ancestors(piece, errors + 1):
            node, most, shift = item[cuts[low] : cuts[high]], high - low - 1, cuts[piece] - cuts[low]
            if first:
                places, first = _beside(node, shift, cuts[piece + 1] - cuts[low], most, places, text), False
            kept = []
            for a, b, own in _windows([p - shift for p in places], len(node), most, len(text)):
                if myers(node, text[a:b], most, first=True) is not None:
                    kept += own
            if not kept:
                return []
            places = [p + shift for p in kept]
        return [p - cuts[piece] for p in places]


def _beside(node: str, start: int, stop: int, most: int, places: list[int], text: str) -> list[int]:
    """Places of ``node[start:stop]`` beside which the rest of the node may follow with ``most`` errors.

    The rest is split into ``most + 1`` parts, of which one must stand there unchanged,
    moved by no more than ``most`` signs.
    """
    parts = []
    for low, high in ((0, start), (stop, len(node))):
        cuts = [low + (high - low) * i // (most + 1) for i in range(most + 2)]
        parts += [(node[a:b], a - start - most, b - start + most) for a, b in zip(cuts, cuts[1:]) if high > low]
    return [p for p in places if any(text.find(part, max(0, p + a), max(0, p + b)) >= 0 for part, a, b in parts)]


def _windows(starts: list[int], length: int, errors: int, end: int) -> Iterator[tuple[int, int, list[int]]]:
    """Parts of the text around ascending starts, grown by the errors on both sides, with their starts; overlapping ones joined."""
    low = high = 0
    own: list[int] = []
    for start in starts:
        a, b = max(0, start - errors), min(end, start + length + errors)
        if own and a <= high:
            high = max(high, b)
            own.append(start)
            continue
        if own:
            yield low, high, own
        low, high, own = a, b, [start]
    if own:
        yield low, high, own


def item_blocks(items: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """Items (item_id, text) in blocks of bounded size; those without a text are left out."""
    block, size = [], 0
    for row in items.select("item_id", "text").na.drop().orderBy("item_id", "text").toLocalIterator():
        if block and size + len(row["text"]) > block_chars:
            yield block
            block, size = [], 0
        block.append((row["item_id"], row["text"]))
        size += len(row["text"])
    if block:
        yield block


def matches_of(text: Column, block, rate: float) -> Column:
    """Array of (item_id, distance) of a broadcast block's items in each whole text."""

    @F.pandas_udf("array<struct<item_id: long, distance: int>>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(block.value, rate)
        for texts in batches:
            yield pd.Series([[{"item_id": i, "distance": d} for i, d in matcher.find(t)] for t in texts], dtype="object")

    return find(text)


def contaminated(docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, distance: every item found in a document, with its smallest edit distance.

    An item of ``n`` characters may differ in ``floor(rate * n)`` of them. Null and empty
    texts hold nothing; empty items match nothing. Repeated document rows and repeated
    items give a row each. Items beyond ``block_chars`` characters are handled in further
    passes over the documents.
    """
    spark, out = docs.sparkSession, None
    for block in item_blocks(items, block_chars):
        hits = matches_of(column(docs, "text"), spark.sparkContext.broadcast(block), rate)
        part = docs.select(column(docs, "doc_id").alias("doc_id"), F.explode(hits).alias("hit")).select("doc_id", "hit.item_id", "hit.distance")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], "doc_id long, item_id long, distance int")


def keep_uncontaminated(docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Rows of ``docs``, unchanged, in which no item is found; passes after the first see only what is left."""
    spark = docs.sparkSession
    for block in item_blocks(items, block_chars):
        name = free_name(docs, "hits")
        hits = matches_of(column(docs, "text"), spark.sparkContext.broadcast(block), rate)
        docs = docs.withColumn(name, hits).where(F.size(name) == 0).drop(name)
    return docs
