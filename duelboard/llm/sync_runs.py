"""Periodic runs of words, found with string synchronising sets.

A run is a maximal stretch of words with smallest period q and at least two periods
long. Texts are laid one after the other with word numbers of their own, so that nothing
repeats across texts and every step below is one pass over arrays:

1. periods up to ``SMALL`` are read off directly: stretches where a word equals the word
   q places on;
2. for tau = 2, 4, 8 ... a synchronising set keeps the places i where the smallest hash
   of the tau-word windows i .. i + tau belongs to the first or the last of them. Equal
   contexts keep equal places, and every 3 tau - 1 words that are not highly periodic
   (period <= tau / 3) hold a place among their first tau. Hence a run with a period in
   3 tau - 1 .. 6 tau - 2 shows as two places with the same 2 tau words, one period apart.
   Places of equal context are more than tau / 3 apart, so each has a bounded number of
   partners in that range: work is linear for each tau;
3. windows inside known runs of period <= tau / 3 take no part. What that omits is a run
   both of whose periods are highly periodic, with the same small period p: it lies
   across two touching runs of period p, and its period follows from their phases.

Each proposal (place, period) is stretched to both sides by comparing hashes of ranges.
Word numbers are exact; ranges are compared by a polynomial hash modulo 2^61 - 1, where a
false match of n words has a chance of about n / 2^61.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelboard.functions.binding import let
from duelboard.llm.tables import column
from duelboard.llm.wordkeys import in_blocks, mix

MIN_WORDS = 12
SMALL = 4
PRIME = np.uint64((1 << 61) - 1)
BASE = 0x1B7F_3C5D_9E24_A681
NEVER = np.uint64(2**64 - 1)
_LOW31, _LOW30 = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
_U = [np.uint64(k) for k in range(64)]
_powers: dict[str, np.ndarray] = {}


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & PRIME) + (x >> _U[61])
    return np.where(x >= PRIME, x - PRIME, x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo 2^61 - 1 of numbers below it."""
    a_high, a_low, b_high, b_low = a >> _U[31], a & _LOW31, b >> _U[31], b & _LOW31
    middle = a_high * b_low + a_low * b_high
    return _reduced((a_high * b_high << _U[1]) + (middle >> _U[30]) + ((middle & _LOW30) << _U[31]) + a_low * b_low)


def _minus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.where(a >= b, a - b, a + (PRIME - b))


def _power_table(name: str, n: int) -> np.ndarray:
    """At least ``n`` powers of the base ("up") or of its inverse ("down")."""
    if len(_powers.get(name, ())) < n:
        step = BASE if name == "up" else pow(BASE, -1, int(PRIME))
        out = np.ones(1 << max(16, (n - 1).bit_length()), np.uint64)
        filled = 1
        while filled < len(out):
            out[filled : 2 * filled] = _times(out[:filled], np.uint64(step))
            step = step * step % int(PRIME)
            filled *= 2
        _powers[name] = out
    return _powers[name]


class Sequence:
    """Word numbers with hashes of their ranges."""

    def __init__(self, numbers: np.ndarray):
        self.numbers, n = numbers, len(numbers)
        self.up, self.down = _power_table("up", n + 1), _power_table("down", n + 1)
        terms = _times(_reduced(mix(numbers.astype(np.uint64) + _U[1])), self.up[:n])
        self.sums = np.zeros(n + 1, np.uint64)
        high, low = np.cumsum(terms >> _U[31]), np.cumsum(terms & _LOW31)
        self.sums[1:] = _reduced(_times(_reduced(high), np.uint64(1 << 31)) + _reduced(low))

    def windows(self, length: int, end: int) -> np.ndarray:
        """Hash of the ``length`` words from every place on, up to ``end``."""
        return _times(_minus(self.sums[length : end + 1], self.sums[: end + 1 - length]), self.down[: end + 1 - length])

    def ranges(self, at: np.ndarray, length: int) -> np.ndarray:
        return _times(_minus(self.sums[at + length], self.sums[at]), self.down[at])

    def stretch(self, at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of the widest stretches around ``at .. at + period`` with that period."""
        n, shift = len(self.numbers), self.up[period]
        ahead, back = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        for k in range(max(1, n).bit_length(), -1, -1):
            to = ahead + (1 << k)
            fits = np.flatnonzero(at + period + to <= n)
            i, q = at[fits], period[fits]
            left = _minus(self.sums[i + to[fits]], self.sums[i])
            right = _minus(self.sums[i + q + to[fits]], self.sums[i + q])
            same = fits[_times(left, shift[fits]) == right]
            ahead[same] = to[same]
            to = back + (1 << k)
            fits = np.flatnonzero(at >= to)
            i, q = at[fits], period[fits]
            left = _minus(self.sums[i], self.sums[i - to[fits]])
            right = _minus(self.sums[i + q], self.sums[i + q - to[fits]])
            same = fits[_times(left, shift[fits]) == right]
            back[same] = to[same]
        return at - back, at + period + ahead


class Runs:
    """Runs found so far; of equal stretches the smallest period stays."""

    def __init__(self):
        self.start = self.end = self.period = np.zeros(0, np.int64)

    def add(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        long = end - start >= 2 * period
        if not long.any():
            return
        start, end, period = (np.concatenate((old, new[long])) for old, new in ((self.start, start), (self.end, end), (self.period, period)))
        order = np.lexsort((period, end, start))
        start, end, period = start[order], end[order], period[order]
        first = np.ones(len(start), bool)
        first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
        self.start, self.end, self.period = start[first], end[first], period[first]

    def places(self, longest_period: int, window: int, n: int) -> np.ndarray | None:
        """Flags of the places whose ``window`` words lie in a run of at most that period."""
        fits = (self.period <= longest_period) & (self.end - self.start >= window)
        if not fits.any():
            return None
        change = np.zeros(n + 1, np.int64)
        np.add.at(change, np.minimum(self.start[fits], n), 1)
        np.add.at(change, np.minimum(self.end[fits] - window + 1, n), -1)
        return np.cumsum(change[:n]) > 0


def all_runs(numbers: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, smallest period) of every maximal repetition, by start and period.

    ``numbers`` holds texts of falling ``lengths``, one after the other, with no number
    in two of them; a scale sees only the texts long enough for its periods.
    """
    found, sequence = Runs(), Sequence(numbers)
    ends = np.cumsum(lengths)
    for q in range(1, SMALL + 1):
        if len(numbers) > q:
            same = np.concatenate(([False], numbers[q:] == numbers[:-q], [False]))
            edges = np.flatnonzero(same[1:] != same[:-1])
            found.add(edges[0::2], edges[1::2] + q, np.full(len(edges) // 2, q))
    tau = 2
    while True:
        fitting = int(np.searchsorted(-lengths, -(6 * tau - 2), side="right"))
        if not fitting:
            break
        at, period = _proposals(sequence, found, tau, int(ends[fitting - 1]))
        if len(at):
            found.add(*sequence.stretch(at, period), period)
        tau *= 2
    at, period = _between_regions(sequence, found)
    if len(at):
        found.add(*sequence.stretch(at, period), period)
    order = np.lexsort((found.period, found.start))
    return found.start[order], found.end[order], found.period[order]


def _proposals(sequence: Sequence, found: Runs, tau: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) from equal contexts of the synchronising set of one scale."""
    window = sequence.windows(tau, n)
    periodic = found.places(tau // 3, tau, len(window))
    if periodic is not None:
        window[periodic] = NEVER
    lowest, width = window, 1
    while width < tau:
        lowest = np.minimum(lowest[:-width], lowest[width:])
        width *= 2
    lowest = np.minimum(lowest[:-1], lowest[1:])
    last = len(lowest)
    chosen = np.flatnonzero(((lowest == window[:last]) | (lowest == window[tau : tau + last])) & (lowest != NEVER))
    context = sequence.ranges(chosen, 2 * tau)
    order = np.argsort(context, kind="stable")
    context, place = context[order], chosen[order]
    first = np.flatnonzero(context[1:] == context[:-1])
    places, periods, step = [], [], 1
    while len(first):  # partners one, two, three ... places further on in their group
        gap = place[first + step] - place[first]
        fits = (gap >= 3 * tau - 1) & (gap < 6 * tau - 1)
        places.append(place[first[fits]])
        periods.append(gap[fits])
        step += 1
        first = first[gap < 6 * tau - 1]
        first = first[first + step < len(context)]
        first = first[context[first + step] == context[first]]
    if not places:
        return chosen[:0], chosen[:0]
    at, period = np.concatenate(places), np.concatenate(periods)
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    new = np.ones(len(at), bool)  # proposals whose contexts touch lie in one stretch
    new[1:] = (period[1:] != period[:-1]) | (at[1:] - at[:-1] > 2 * tau)
    return at[new], period[new]


def _between_regions(sequence: Sequence, found: Runs) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) from touching highly periodic regions of the same small period."""
    regions = np.flatnonzero((found.period > 1) & (found.end - found.start >= 9 * found.period - 1))
    regions = regions[np.lexsort((found.start[regions], found.period[regions]))]
    one, two = regions[:-1], regions[1:]
    touch = (found.period[one] == found.period[two]) & (found.start[two] <= found.end[one])
    places, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for left, right in zip(one[touch].tolist(), two[touch].tolist()):
        p, start, end = int(found.period[left]), int(found.start[right]), int(found.end[left])
        turns = sequence.ranges(np.arange(start, start + p), p)
        phase = np.flatnonzero(turns == sequence.ranges(np.array([end - p]), p))
        if len(phase):
            most = min(end - int(found.start[left]), int(found.end[right]) - start)
            low = 9 * p - 1
            period = np.arange(low + (start + int(phase[0]) - (end - p) - low) % p, most + 1, p)
            places.append(np.full(len(period), end - p))
            periods.append(period)
    return np.concatenate(places), np.concatenate(periods)


def runs_of_texts(texts: list[str | None], min_words: int = MIN_WORDS) -> tuple[list[list[tuple[int, int, int]]], list[str]]:
    """For each text its runs (start, length, period) and its words without the repeats, joined by spaces."""
    words = [(text or "").encode("utf-8", "replace").split() for text in texts]
    lengths = np.array([len(w) for w in words], np.int64)
    order = np.argsort(-lengths, kind="stable")
    numbers, used = [np.zeros(0, np.int64)], 0
    for i in order.tolist():
        number = {word: k for k, word in enumerate(dict.fromkeys(words[i]), used)}
        numbers.append(np.fromiter(map(number.__getitem__, words[i]), np.int64, len(words[i])))
        used += len(number)
    start, end, period = all_runs(np.concatenate(numbers), lengths[order])
    long = end - start >= min_words
    start, end, period = start[long], end[long], period[long]
    offsets = np.concatenate(([0], np.cumsum(lengths[order])))
    bounds = np.searchsorted(start, offsets)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    collapsed = [""] * len(texts)
    for at, i in enumerate(order.tolist()):
        own = slice(bounds[at], bounds[at + 1])
        s, e, q = start[own] - offsets[at], end[own] - offsets[at], period[own]
        runs[i] = list(zip(s.tolist(), (e - s).tolist(), q.tolist()))
        kept = words[i]
        if runs[i]:
            change = np.zeros(len(kept) + 1, np.int64)
            np.add.at(change, s + q, 1)
            np.add.at(change, e, -1)
            kept = [kept[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
        collapsed[i] = b" ".join(kept).decode()
    return runs, collapsed


def periodic_runs(text: Column) -> Column:
    """struct<runs: array<struct<start, length, period>>, collapsed: string> of whole texts."""

    @F.pandas_udf("runs array<struct<start: long, length: long, period: long>>, collapsed string")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch.tolist()
            runs, collapsed = [], []
            for a, b in in_blocks(texts):
                more, kept = runs_of_texts(texts[a:b])
                runs += [[{"start": s, "length": n, "period": q} for s, n, q in own] for own in more]
                collapsed += kept
            yield pd.DataFrame({"runs": pd.Series(runs, dtype="object"), "collapsed": pd.Series(collapsed, dtype="object")})

    return scan(text)


def find_runs(docs: DataFrame) -> DataFrame:
    """doc_id, runs, collapsed: a row for every row of ``docs`` (doc_id, text).

    A run is a stretch of at least 12 words and two periods, with its smallest period,
    that no neighbouring word extends; words are runs of bytes other than space and
    0x09-0x0D and differ by case. ``collapsed`` leaves out every word that some run holds
    after its first period and joins the others by one space. Null, empty and blank texts
    have no runs and an empty ``collapsed``; repeated rows give equal rows; a very long
    text is one sequence of its own.
    """
    found = docs.select(column(docs, "doc_id").alias("doc_id"), periodic_runs(column(docs, "text")).alias("found"))
    return found.select("doc_id", "found.runs", "found.collapsed")


def looped_text(doc_id: Column, text: Column) -> Column:
    """The registered query's input: a tenth of the texts, told by the id's CRC-32, end in a loop of their own words.

    A null id counts as empty text.
    """
    key = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    rest = F.floor(key / 10)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def loop(w: Column) -> Column:
        n = F.size(w).cast("long")
        start = rest % n
        turn = F.lit(1) + F.floor((n - start) / (F.lit(3) + rest % 8))
        again = F.ceil((n - start) / turn).cast("int")
        cycle = F.slice(F.flatten(F.array_repeat(F.slice(w, (start + 1).cast("int"), turn.cast("int")), again)), 1, (n - start).cast("int"))
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, 1, start.cast("int")), cycle), " ")).otherwise(F.lit(""))

    return F.when((key % 10 == 0) & text.isNotNull(), let(words, loop)).otherwise(text)


def run_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run, digests of all runs and of the collapsed text, for looped texts."""
    texts = docs.select(column(docs, "doc_id").alias("doc_id"), looped_text(column(docs, "doc_id"), column(docs, "text")).alias("text"))
    found = find_runs(texts)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / -F.col("best.p")).alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
