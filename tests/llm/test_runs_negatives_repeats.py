"""Periodic runs, hard negatives and exact duplicates against brute force, with edge cases."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from duelboard.llm import mph_dedup, sync_runs, threshold_negatives

# periodic runs


def brute_runs(words, least=12):
    """Every maximal stretch with a period, by trying all periods; a stretch counts for its smallest one."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= 2 * q:
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items() if e - s >= least), key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def looped(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    h, n = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


REPETITIVE = [
    fibonacci(700),
    thue_morse(700),
    "ab" * 60 + "ba" * 55,  # runs across two touching regions of period 2
    "ab" * 60 + "a" + "ab" * 50,
    "aab" * 30 + "aba" * 30,
    "a" * 100 + "b" + "a" * 100,
    ("ab" * 12 + "a") * 10,
    (("aab" * 10 + "ab") * 4 + "b") * 3,
    ("abcde" * 20 + "cdeab" * 20) * 2,
    "a",
    "",
    "ab" * 6,
    "ab" * 5 + "a",
]


@pytest.mark.parametrize("least", [1, 12])
def test_runs_of_repetitive_words(least):
    found, collapsed = sync_runs.runs_of_texts([" ".join(c) for c in REPETITIVE], least)
    for word, runs, kept in zip(REPETITIVE, found, collapsed):
        want = brute_runs(word, least)
        assert runs == want
        assert kept == brute_collapsed(list(word), want)


def test_runs_of_random_words():
    rng = random.Random(5)
    cases = []
    for _ in range(300):
        letters, n = rng.choice(["ab", "abc", "a" * 9 + "b", "abcdefgh"]), rng.randrange(0, 240)
        words = [rng.choice(letters) for _ in range(n)]
        for _ in range(rng.randrange(4) if n > 8 else 0):
            at, p, more = rng.randrange(n), rng.randrange(1, n // 3), rng.randrange(n)
            for j in range(at + p, min(n, at + p + more)):
                words[j] = words[j - p]
        cases.append(words)
    found, _ = sync_runs.runs_of_texts([" ".join(c) for c in cases])
    assert found == [brute_runs(c) for c in cases]


def test_long_periods_and_long_texts():
    rng = random.Random(6)
    period = [f"w{rng.randrange(10**9)}" for _ in range(30_000)]
    text = " ".join(["start"] + (period * 3)[:80_000] + ["end"])
    (runs,), (collapsed,) = sync_runs.runs_of_texts([text])
    assert runs == [(1, 80_000, 30_000)]
    assert len(collapsed.split()) == 30_002


def test_run_digests(spark, make_docs, edge_rows):
    rng = random.Random(7)
    rows = edge_rows + [(100 + i, " ".join(rng.choice("abcdefg") + "é" * (i % 3) for _ in range(rng.randrange(90)))) for i in range(150)]
    rows += [(400, " a　b " * 9), (401, "x\x0b" * 30), (402, "Aa aA " * 8)]
    got = Counter(tuple(r) for r in sync_runs.run_digests(make_docs(rows)).collect())
    want = Counter()
    for doc_id, text in rows:
        words = looped(doc_id, text)
        if len(words) > 3_000:
            runs = sync_runs.runs_of_texts([" ".join(words)])[0][0]  # too long for brute force
        else:
            runs = brute_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        exponent = None if best[0] is None else 1000 * best[1] // best[2]
        want[(doc_id, len(runs), *best, exponent, sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(brute_collapsed(words, runs)))] += 1
    assert got == want


def test_runs_of_no_rows(spark, make_docs):
    assert sync_runs.find_runs(make_docs([])).collect() == []
    assert sync_runs.run_digests(make_docs([])).columns[:2] == ["doc_id", "n_runs"]


# hard negatives


def brute_negatives(rows, every=100):
    best = {}
    for vec_id, label, v in rows:
        if vec_id is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(256 * x) for x in v]
        if vec_id not in best or (label, v) < best[vec_id][:2]:
            best[vec_id] = label, v, whole
    out = []
    for a, (label, _, v) in best.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), b, other) for b, (other, _, w) in best.items() if b != a and len(w) == len(v))
        for ps, p, _ in [s for s in scored if s[2] == label][:5]:
            fits = [(-s, b) for s, b, other in scored if other != label and 80 * -ps <= 100 * -s <= 100 * -ps]
            out += [(a, p, k, b, -ps, s) for k, (s, b) in enumerate(fits[:5], 1)]
    return Counter(out)


KIND = "vec_id long, label int, embedding array<double>, anchor_id string, vector int, rank int"


@pytest.mark.parametrize("block,at_once", [(8_192, 20_000), (37, 3)])
def test_hard_negatives(spark, monkeypatch, block, at_once):
    monkeypatch.setattr(threshold_negatives, "BLOCK", block)
    monkeypatch.setattr(threshold_negatives, "ANCHORS_AT_ONCE", at_once)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(4, 12))
    rows = [(i, int(i % 4), (centres[rng.integers(4)] + rng.normal(size=12)).tolist()) for i in range(400)]
    rows += [(400 + i, 9, [float(x) for x in rng.integers(-1, 2, 12)]) for i in range(300)]  # a large label, many ties
    rows += [(1000 + i, i % 2, rows[401][2]) for i in range(150)]  # many equal vectors
    rows += [(100, 1, rows[5][2]), (100, 1, rows[5][2]), (2000, 3, [0.0] * 12), (2100, 3, [1.0]), (2101, 3, [2.0]), (2102, 4, [1.9]), (2200, 7, []), (2201, 7, []), (2202, 8, [])]
    rows += [(3000, None, [1.0] * 12), (3001, 1, None), (None, 1, [9.0] * 12), (3100, 1, [float("nan")] * 12), (3101, 2, [float("inf")] + [0.0] * 11), (3102, 2, [None] + [1.0] * 11), (-100, 1, rows[7][2])]
    frame = spark.createDataFrame([(i, label, v, "x", 1, 2) for i, label, v in rows], KIND)
    got = threshold_negatives.hard_negatives(frame)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert Counter(tuple(r) for r in got.collect()) == brute_negatives(rows)


def test_hard_negatives_beyond_exact_doubles(spark):
    rng = random.Random(4)
    rows = [(i, i % 3, [rng.uniform(-1, 1) * 2.0 ** rng.randrange(15, 19) for _ in range(5)]) for i in range(0, 400, 2)]
    frame = spark.createDataFrame([(i, label, v, "x", 1, 2) for i, label, v in rows], KIND)
    assert Counter(tuple(r) for r in threshold_negatives.hard_negatives(frame).collect()) == brute_negatives(rows)


def test_hard_negatives_of_no_rows(spark):
    assert threshold_negatives.hard_negatives(spark.createDataFrame([], KIND)).collect() == []


def test_search_stops_before_the_end():
    """With one large component per row the threshold falls fast, and most rows are never scored."""
    rng = np.random.default_rng(5)
    x = np.floor(rng.normal(size=(4_000, 6)) * 3)
    x[np.arange(40), 0] = 1_000 + np.arange(40)
    block = threshold_negatives.SortedLists(np.arange(4_000), np.zeros(4_000, np.int64), x)
    anchor = np.array([100.0, 1, -1, 1, 0, 2])
    scored = []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            if self.ndim == 2:
                scored.append(len(self))
            return np.asarray(self) @ np.asarray(other)

    block.x = x.view(Counted)
    at, scores = block.search(anchor, np.ones(4_000, bool), [None])[0]
    want = np.lexsort((np.arange(4_000), -(x @ anchor)))[:5]
    assert at.tolist() == want.tolist() and sum(scored) < 200


# exact duplicates


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(1)
    digests = rng.integers(0, 2**63, (5_000, 4), dtype=np.uint64)
    digests[1:40, :3] = digests[0, :3]  # differ in their last word only
    index = mph_dedup.PerfectHash.over(digests)
    assert sorted(index.slots(digests).tolist()) == list(range(5_000))
    assert len(mph_dedup.PerfectHash.over(digests[:0]).slots(digests)) == 5_000


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_groups(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[low(text)].append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        kept = [i == keep for i in ids]
        for k in [k for k, flag in enumerate(kept) if flag][1:]:
            kept[k] = False  # of rows that repeat the winning id one stays
        sha = hashlib.sha256(text.encode()).hexdigest()
        out.update((i, keep, len(ids), flag, sha) for i, flag in zip(ids, kept))
    return out


@pytest.fixture
def repeats(edge_rows):
    rows = edge_rows + [(50 + i, f"Text {i % 40}") for i in range(200)] + [(900 + i, "TEXT 3") for i in range(300)]
    return rows + [(None, "no id"), (None, "É"), (2000, "é"), (2001, "É"), (2002, "straße"), (2003, "STRASSE"), (50, "Text 0"), (50, "other")]


@pytest.mark.parametrize("bucket", [20_000, 7])
@pytest.mark.parametrize("history", [None, "doc_id % 3 = 0", "true", "doc_id = 1"])
def test_exact_duplicates(spark, make_docs, repeats, monkeypatch, bucket, history):
    monkeypatch.setattr(mph_dedup, "BUCKET", bucket)
    got = mph_dedup.exact_duplicates(make_docs(repeats), None if history is None else F.expr(history))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == brute_groups(repeats)


def test_drop_repeats(spark, make_docs, repeats):
    docs = make_docs(repeats).withColumn("row_number", F.lit("own")).withColumn("in_history", F.lit(1)).withColumn("digest", F.lit("x"))
    kept = mph_dedup.drop_repeats(docs, F.col("doc_id") % 2 == 0)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert Counter((r["doc_id"], low(r["text"])) for r in rows) == Counter((best, text) for text, best in _winners(repeats).items())
    assert {r["row_number"] for r in rows} == {"own"}


def _winners(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[low(text)].append(doc_id)
    return {text: max((i for i in ids if i is not None), default=None) for text, ids in groups.items()}


def test_members_are_told_by_their_digest(spark, make_docs):
    rows = mph_dedup.digest_rows(make_docs([(i, f"t {i % 60}") for i in range(100)]), F.col("doc_id") < 30)
    old, new = (mph_dedup.distinct_digests(rows.where(c)) for c in ("old", "not old"))
    merged = mph_dedup.merge_arrivals(mph_dedup.build_index(old, 3), 3, new, 2).collect()
    assert len(merged) == 60 and sum(r["member"] for r in merged) == 30
    assert sum(r["size"] for r in merged) == 100


def test_no_documents(spark, make_docs):
    assert mph_dedup.exact_duplicates(make_docs([])).collect() == []
