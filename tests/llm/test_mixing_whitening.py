"""op11 and op12 against brute force."""

import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from halocline.llm import mixing, whitening

words = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))


def brute_targets(sizes, weights=(3.0, 1.0, 2.0), share=1.5, most=2.0):
    """Reshares what is above the bound by weight, again and again, as the contract says it."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    out, rest, free = dict.fromkeys(order, 0.0), share * sum(sizes.values()), set(order)
    while rest > 1e-9 and free:
        unit = rest / sum(w[s] for s in free)
        rest = 0.0
        for s in [*free]:
            out[s] += unit * w[s]
            if out[s] > most * sizes[s]:
                rest += out[s] - most * sizes[s]
                out[s] = most * sizes[s]
                free.discard(s)
    return out


def corpus(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", "y") for i, t, s in rows], "doc_id long, text string, source string, size string, pattern string")


def test_mix_of_the_query(spark, folder, text, odd):
    rows = [(i, text(5 + i * 37 % 160, i), f"s{i % 7}" if i % 3 else "hot") for i in range(900)]
    rows += [(2000 + i, t, [None, "", "é", "hot"][i % 4]) for i, t in enumerate(odd)] + [(5, text(30, 1), "s1"), (5, text(30, 1), "s1"), (None, "a b c", None), (None, "a b", None)]
    d = folder(documents=corpus(spark, rows))
    got = mixing.query(spark, d).collect()
    assert sorted((repr(r["doc_id"]), r["size"]) for r in got) == sorted((repr(i), words(t)) for i, t, _ in rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + words(t)
    want = brute_targets(sizes)
    assert {(r["source_size"], round(r["target"], 4)) for r in got} == {(sizes[s], round(want[s], 4)) for s in sizes}
    assert all(r["taken"] % max(r["size"], 1) == 0 and 0 <= r["taken"] <= 2 * r["size"] for r in got)
    by, largest = {}, {}
    for r in got:
        k = (r["source_size"], r["target"])
        by[k] = by.get(k, 0) + r["taken"]
        largest[k] = max(largest.get(k, 0), r["size"])
    n_of = {k: sum((sizes[s], round(want[s], 4)) == (k[0], round(k[1], 4)) for s in sizes) for k in by}
    assert all(abs(n - n_of[k] * k[1]) <= n_of[k] * largest[k] / 2 + 1 for k, n in by.items())
    big = [(k, n) for k, n in by.items() if k[0] > 5000]
    assert big and all(abs(n - k[1]) <= 0.005 * k[1] for k, n in big)
    again = mixing.query(spark, d).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_mix_of_many_buckets_and_any_partitions(spark, text):
    docs = corpus(spark, [(i, text(1 + i % 23, i), "a" if i % 3 else "b") for i in range(3000)])
    out = []
    for n in (1, 7):
        found = mixing.sized(docs.repartition(n), F.array("source"))
        pats = mixing.patterns(found)
        sent = spark.createDataFrame([("1:a", "1:a", 9000), ("1:b", "1:b", 17_003)], "pattern string, key string, words long")
        got = mixing.chosen(found, pats, sent, bucket=64).groupBy("pattern").agg(F.sum("taken"), F.sum(F.col("doc_id") * F.col("taken"))).collect()
        out.append(sorted(map(tuple, got)))
    assert out[0] == out[1] and [(p, n) for p, n, _ in out[0]] == [("1:a", 9000), ("1:b", 17_003)]


def test_overlapping_sources(spark, text):
    """Words of a and b must go to b: a can fill its quota by itself."""
    rows = [(i, text(20, i), ["a", "b"] if i < 100 else ["a"] if i < 200 else ["b", "c"] if i < 210 else ["c", None]) for i in range(260)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, of array<string>")
    got, aimed = mixing.mix(docs, F.col("of"), weights=(1.0,), share=0.9)
    sources = {r["key"]: r for r in aimed.collect()}
    assert {k: (r["source_size"], r["rank"]) for k, r in sources.items()} == {"1:a": (4000, 0), "1:b": (2200, 1), "1:c": (1200, 2), "~": (1000, 3)}
    taken = {r["for_key"]: r["n"] for r in got.groupBy("for_key").agg(F.sum("taken").alias("n")).collect() if r["n"]}
    # c and null share 1000 words twice and get 200 of b's twice: less than their targets.
    assert taken["1:a"] == pytest.approx(1890, rel=0.2) and taken["1:b"] == pytest.approx(1890, rel=0.25)
    assert sum(taken.values()) == pytest.approx(1890 + 1890 + 2 * 1000 + 2 * 200, abs=20)
    assert got.where("size(sources) = 1 and taken > size").count() == 0  # repeats only where nothing else fills a quota


def test_mix_of_nothing(spark, folder):
    assert mixing.query(spark, folder(documents=corpus(spark, []))).count() == 0
    assert [r["taken"] for r in mixing.query(spark, folder(documents=corpus(spark, [(1, None, None), (2, " ", "a")]))).collect()] == [0, 0]


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 4).flatmap(lambda n: st.tuples(st.lists(st.tuples(st.integers(0, 9), st.sets(st.integers(0, n - 1), min_size=1)), min_size=1, max_size=6), st.lists(st.integers(0, 30), min_size=n, max_size=n))))
def test_flow_fills_what_can_be_filled_at_least_cost(case):
    patterns, quota = case
    capacity, members = [c for c, _ in patterns], [sorted(m) for _, m in patterns]
    sent = mixing.flow(capacity, members, quota)

    def most(k):
        """Maximum flow as the least cut."""
        return min(sum(quota[s] for s in a) + sum(k * c for c, m in zip(capacity, members, strict=True) if not set(m) <= set(a)) for n in range(len(quota) + 1) for a in itertools.combinations(range(len(quota)), n))

    used = [sum(x.values()) for x in sent]
    assert all(0 <= u <= 2 * c for u, c in zip(used, capacity, strict=True)) and all(v >= 0 for x in sent for v in x.values())
    assert all(sum(x.get(s, 0) for x in sent) <= q for s, q in enumerate(quota))
    assert sum(used) == most(2)
    assert sum(max(0, u - c) for u, c in zip(used, capacity, strict=True)) == most(2) - most(1)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1.0) for i, v in rows], "vec_id long, embedding array<float>, n int, whitened double")


def test_whitening_matches_numpy(spark, folder):
    r = np.random.default_rng(3)
    base = (r.normal(size=(120, 12)) * np.linspace(3, 0.3, 12)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(1000 + i, base[7].tolist()) for i in range(40)] + [(3, base[3].tolist()), (None, base[4].tolist())]
    bad = [(5000, None), (5001, []), (5002, [1.0] * 11), (5003, [float("nan")] * 12), (5004, [1.0] * 11 + [None]), (5005, [float("inf")] + [0.0] * 11)]
    got = whitening.query(spark, folder(embeddings=vectors(spark, rows + bad))).toPandas()
    x = {i: np.floor(256 * np.asarray(v, np.float32).astype(float)).astype(np.int64) for i, v in rows}
    u = np.unique(np.array(list(x.values())), axis=0)
    n, s = len(u), u.sum(0)
    c = u - s / n
    v = c.T @ c / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    assert len(got) == 4 * len(rows) and set(got["n"]) == {n} and set(got["component"]) == {1, 2, 3, 4}
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9
    for k in range(4):
        part = got[got["component"] == k + 1]
        assert part["explained"].iloc[0] == pytest.approx(e[k] / np.trace(v), rel=1e-9)
        want = {i: float((y - s / n) @ q[:, k] / np.sqrt(e[k])) for i, y in x.items()}
        pairs = [(w, want[None if i != i else int(i)]) for i, w in zip(part["vec_id"], part["whitened"], strict=True)]
        assert max(abs(a - b) for a, b in pairs) < 1e-9 or max(abs(a + b) for a, b in pairs) < 1e-9
    assert all(d == int(((n * x[None if i != i else int(i)] - s) ** 2).sum()) for i, d in zip(got["vec_id"], got["deviation"], strict=True))


def test_pairs_over_several_aggregations(spark):
    r = np.random.default_rng(5)
    kept = whitening.usable(vectors(spark, [(i, v.tolist()) for i, v in enumerate(r.normal(size=(50, 9)))]).drop("n", "whitened"))
    rows = whitening.distinct_vectors(kept)
    one, many = (whitening.covariance(rows, 50, [0.5] * 9, pairs=p) for p in (4096, 7))
    assert np.allclose(one, many, rtol=1e-12, atol=0)


def test_whitening_without_variance(spark, folder):
    same = whitening.query(spark, folder(embeddings=vectors(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])]))).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in same] == [(1, 0, None, None, None)] * 4
    line = whitening.query(spark, folder(embeddings=vectors(spark, [(1, [0.0, 0.0, 1.0]), (2, [1.0, 1.0, 1.0])]))).collect()
    assert {(r["component"], None if r["whitened"] is None else round(abs(r["whitened"]), 9)) for r in line} == {(1, 1.0), (2, None), (3, None)}
    assert whitening.query(spark, folder(embeddings=vectors(spark, [(1, None)]))).collect() == []
    assert whitening.query(spark, folder(embeddings=vectors(spark, []))).collect() == []


def test_whitening_of_huge_entries(spark, folder):
    got = whitening.query(spark, folder(embeddings=vectors(spark, [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [1.0, 2.0])]))).collect()
    assert len(got) == 6 and all(r["deviation"] is None for r in got if r["vec_id"] != 3)
