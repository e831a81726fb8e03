"""Vector links and URL rules against brute force, with edge cases."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from duelboard.llm import digest_filter, pq_dedup
from duelboard.llm.queries import URL_RULES


def brute_links(rows):
    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, np.float64)
        return v / np.linalg.norm(v)

    units = [unit(v) for _, v in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    n = [0] * len(rows)
    for i, a in enumerate(units):
        for j, b in enumerate(units[:i]):
            if a is not None and b is not None and len(a) == len(b) and a @ b >= 0.95:
                n[i] += 1
                n[j] += 1
                parent[max(top(i), top(j))] = min(top(i), top(j))
    ids = defaultdict(list)
    for i, (vec_id, _) in enumerate(rows):
        ids[top(i)].append(vec_id)
    return Counter((vec_id, n[i], min(x for x in ids[top(i)])) for i, (vec_id, _) in enumerate(rows))


@pytest.mark.parametrize("chunk", [40, 2_000])
def test_vector_links(spark, monkeypatch, chunk):
    monkeypatch.setattr(pq_dedup, "CHUNK", chunk)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=16).astype(np.float32).tolist()) for i in range(300)]
    hot = rng.normal(size=16)
    rows += [(1000 + i, (hot + rng.normal(size=16) * 0.16).astype(np.float32).tolist()) for i in range(150)]  # a large group, partly linked by others
    rows += [(2000 + i, rows[5][1]) for i in range(20)] + [(2100, (2 * np.array(rows[6][1])).tolist())]
    rows += [(3000, None), (3001, []), (3002, [0.0] * 16), (3003, [float("nan")] * 16), (3004, [None] + [1.0] * 15), (3005, [float("inf")] * 16), (3006, [1.0, 2.0, 3.0]), (3007, [1.0, 2.0, 3.1]), (3, rows[3][1])]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, node string")
    got = pq_dedup.vector_links(frame).collect()
    want = brute_links(rows)
    found = Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in got)
    links = lambda c: sum(k[1] * n for k, n in c.items())
    assert 0.99 * links(want) <= links(found) <= links(want)
    assert Counter({(k[0], k[2]): n for k, n in found.items()}) == Counter({(k[0], k[2]): n for k, n in want.items()})
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


@pytest.mark.parametrize("rank", [3, 6])
def test_vector_links_of_low_rank(spark, monkeypatch, rank):
    monkeypatch.setattr(pq_dedup, "CHUNK", 300)
    rng = np.random.default_rng(rank)
    x = (rng.normal(size=(2_000, rank)) @ rng.normal(size=(rank, 64))).astype(np.float32)
    unit = x / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r["n_links"] for r in pq_dedup.vector_links(frame).collect()}
    assert [got[i] for i in range(len(x))] == want.tolist()


def test_no_vectors(spark):
    assert pq_dedup.vector_links(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert [tuple(r) for r in pq_dedup.vector_links(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).collect()] == [(1, 0, 1, True)]


def brute_rule(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[2:] if fits else (None, "allow")))


def test_url_rules(spark):
    rng = random.Random(1)
    hosts = ["com", "example.com", "EN.example.com", "www.example.com", "a.www.Example.com", "x.net", "net", "badexample.com", "", "a..com", "é.com", "user@example.com:80"]
    paths = ["", "/", "/en", "/en/", "/en/x/y", "/es/1", "/fr/", "/EN/", "/en/?q=/es/", "?x=/en/", "#/en/"]
    urls = [f"{rng.choice(['http', 'https', ''])}://{h}{p}" for h in hosts for p in paths] + [None, "", "no scheme", "://", "a://b://c/en/", "http://" + "a." * 5000 + "com/", "http://example.com/en/\nnew"]
    more = URL_RULES + [(f"host{i}.org", f"/{i}/" * (i % 3), "block") for i in range(300)]
    urls += [f"http://sub.host{i}.org/{i}/{i}/{i}/" for i in range(300)]
    files = digest_filter.write_rules(spark.createDataFrame(more, "host string, path string, verdict string"))
    frame = spark.createDataFrame([(i, u, "own", "own") for i, u in enumerate(urls)], "page_id long, url string, rule string, judged string")
    out = digest_filter.judge_urls(frame, files)
    assert out.columns == ["page_id", "url", "judged", "host", "path", "rule", "verdict"]
    for r in out.collect():
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute_rule(r["url"], more), r["url"]
    assert digest_filter.judge_urls(frame.limit(0), files).count() == 0


def test_url_digest_collisions_are_settled_by_the_string(tmp_path):
    digests, strings = np.array([7, 7, 7], "<i8"), b"aa/bb/cc/"
    entries = np.zeros(3, digest_filter.ENTRY)
    entries["offset"], entries["length"], entries["host"] = [0, 3, 6], 3, 2
    paths = {}
    for kind, data in (("digests", digests.tobytes()), ("entries", entries.tobytes()), ("strings", strings)):
        paths[kind] = str(tmp_path / kind)
        (tmp_path / kind).write_bytes(data)
    index = digest_filter.RuleIndex(paths, [(2, 1)])
    real = digest_filter.xxhash.xxh64_intdigest
    digest_filter.xxhash.xxh64_intdigest = lambda t, s: 7
    try:
        assert index.find([b"bb/", b"dd/", b"cc/"], [2, 2, 2]).tolist() == [1, -1, 2]
    finally:
        digest_filter.xxhash.xxh64_intdigest = real


def test_urls_with_many_rule_shapes(spark, monkeypatch):
    monkeypatch.setattr(digest_filter, "KEYS_AT_ONCE", 50)
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("ab") for _ in range(n))
    rules = {(f"{word(rng.randint(1, 4))}.{rng.choice(['com', 'co.uk'])}", "/" + word(rng.randint(0, 5))) for _ in range(300)}
    rules = [(h, p, rng.choice(["allow", "block"])) for h, p in rules]
    index_rules = digest_filter.write_rules(spark.createDataFrame(rules, "host string, path string, verdict string"))
    urls = [f"http://{word(2)}.{h}{p}{word(2)}" for h, p, _ in rules] + [f"http://{word(9)}.com/{word(9)}" for _ in range(50)]
    for r in digest_filter.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), index_rules).collect():
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute_rule(r["url"], rules), r["url"]


def test_no_rules(spark):
    files = digest_filter.write_rules(spark.createDataFrame([], "host string, path string, verdict string"))
    row = digest_filter.judge_urls(spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string"), files).first()
    assert (row["host"], row["rule"], row["verdict"]) == ("a.com", None, "allow")
