"""op1 and op2 against brute force."""

import hashlib
import random
from functools import partial

import numpy as np
import pyarrow as pa
import pytest

from halocline.llm import graph, jaccard_join, substring_dedup
from halocline.llm.fm_index import FMIndex, Wavelet
from halocline.llm.words import blocks, sliding, windows


def shingles(t, k=5):
    w = (t or "").encode().split()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_join(rows):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    rep = {i: min(j for j in sets if sets[j] == s) if s else i for i, s in sets.items()}
    reps = [i for i in sets if rep[i] == i and sets[i]]
    links = {i: [j for j in reps if j != i and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])] for i in reps}
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i in reps:
            best = min([label[i], *(label[j] for j in links[i])])
            changed |= best < label[i]
            label[i] = best
    return {i: (label[rep[i]], rep[i], len(links.get(rep[i], []))) for i in sets}


def near(t, n, seed):
    r, w = random.Random(seed), t.split()
    for _ in range(n):
        w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
    return " ".join(w)


def test_join_matches_brute_force(documents, text, odd):
    rows = [(i, text(150, i)) for i in range(40)]
    rows += [(100 + 10 * i + k, near(text(150, i), k, 7 * i + k)) for i in range(6) for k in range(4)]
    rows += [(300 + i, t) for i, t in enumerate(odd)] + [(400, text(150, 1)), (401, " ".join(text(150, 1).split()) + "\n"), (402, "one two"), (403, "one  two")]
    got = {r["doc_id"]: (r["class_id"], r["rep_id"], r["n_links"]) for r in jaccard_join.join(documents(rows)).collect()}
    assert got == brute_join(rows)


def test_large_group_is_split(spark, documents, text, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_DOCS", 10)
    monkeypatch.setattr(jaccard_join, "LIMIT", 8)
    base = text(120, 3)
    rows = [(i, near(base, 1, i)) for i in range(35)] + [(50, text(100, 9))]
    got = {r["doc_id"]: (r["class_id"], r["rep_id"], r["n_links"]) for r in jaccard_join.join(documents(rows)).collect()}
    assert got == brute_join(rows)


def test_join_repeats_nulls_and_empty(spark, documents, text):
    t = text(60, 1)
    rows = [(1, t), (1, t), (2, t), (None, t), (None, None)]
    got = sorted(jaccard_join.join(documents(rows)).collect(), key=lambda r: repr(r))
    assert len(got) == 5 and {r["class_id"] for r in got if r["doc_id"]} == {1} and {r["class_id"] for r in got if r["doc_id"] is None} == {None}
    assert jaccard_join.join(documents([])).count() == 0
    kept = jaccard_join.one_of_each(documents([(1, t), (2, t), (3, "a b"), (None, t)]))
    assert sorted(kept.select("doc_id").collect(), key=repr) == sorted([(1,), (3,), (None,)], key=repr)


def test_rows_that_share_an_id_are_judged_apart(documents, text):
    """Each text by itself: brute force over (id, text) in place of ids."""
    rows = [(5, text(60, 1)), (5, text(60, 2)), (7, text(60, 2)), (8, near(text(60, 1), 1, 3)), (2, text(60, 9)), (5, None), (5, text(60, 1)), (9, "a b"), (9, ""), (None, text(60, 1))]
    numbers = {x: k for k, x in enumerate(sorted({r for r in rows if r[0] is not None}, key=lambda r: (r[0], r[1] or "")))}
    back = {k: x[0] for x, k in numbers.items()}
    want = brute_join([(k, x[1]) for x, k in numbers.items()])
    expected = sorted((i, back[want[numbers[i, t]][0]], back[want[numbers[i, t]][1]], want[numbers[i, t]][2]) for i, t in rows if i is not None)
    got = jaccard_join.join(documents(rows)).where("doc_id is not null").collect()
    assert sorted((r["doc_id"], r["class_id"], r["rep_id"], r["n_links"]) for r in got) == expected
    kept = jaccard_join.one_of_each(documents(rows))
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == [2, 5, 5, 5, 5, 9, 9]


def test_recall_of_deep_buckets(spark, documents, text, monkeypatch):
    """Buckets of two at most, so that nearly all pairs must be found at depth: pairs just over the threshold."""
    monkeypatch.setattr(jaccard_join, "candidate_links", partial(jaccard_join.candidate_links, limit=2))
    rows = []
    for i in range(150):
        t = text(120, i, 3000)
        rows += [(2 * i, t), (2 * i + 1, near(t, 2, i))]
    for i in range(300):  # many of one kind: their buckets stay large
        rows.append((1000 + i, near(text(120, 9999, 3000), 8, i)))
    want = brute_join(rows)
    close = [i for i in want if want[i][2]]
    got = {r["doc_id"]: r["n_links"] for r in jaccard_join.join(documents(rows)).collect()}
    found, all_links = sum(got[i] for i in close), sum(want[i][2] for i in close)
    assert len(close) > 250 and found <= all_links and found >= 0.99 * all_links


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)]
    got = {r["node"]: r["label"] for r in graph.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_without_is_the_complement_of_members(spark):
    docs = spark.range(500).withColumnRenamed("id", "doc_id").unionAll(spark.createDataFrame([(None,)], "doc_id long"))
    ids = spark.createDataFrame([(i,) for i in range(0, 500, 7)], "doc_id long")
    left = [r[0] for r in graph.without(docs, "doc_id", ids).collect()]
    assert sorted(x for x in left if x is not None) == [i for i in range(500) if i % 7] and None in left
    assert graph.without(docs, "doc_id", ids.limit(0)).count() == 501


def brute_dedup(rows, n=50):
    words = {i: (t or "").encode().split() for i, t in rows}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - n + 1):
            first.setdefault(tuple(words[i][k : k + n]), i)
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            if first[tuple(w[k : k + n])] < i:
                gone[k : k + n] = [True] * n
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def test_dedup_matches_brute_force(documents, text, odd):
    p = text(60, 77)
    rows = [(i, text(120, i)) for i in range(20)]
    rows += [(20 + i, f"{text(30 + i, 100 + i)} {p} {text(20, 200 + i)}") for i in range(15)]
    rows += [(40 + i, text(120, i)) for i in range(5)] + [(50 + i, near(text(200, i), 2, i)) for i in range(4)] + [(60 + i, near(text(200, i), 2, 9 + i)) for i in range(4)]
    exact = text(50, 5000)
    rows += [(70, exact), (71, exact + " more"), (72, text(49, 5001)), (73, text(49, 5001)), (74, "same " * 200), (75, "same " * 60)]
    rows += [(80 + i, t) for i, t in enumerate(odd)]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup.dedup(documents(rows)).collect()}
    assert got == brute_dedup(rows)


def test_dedup_of_hot_marks_matches_brute_force(documents, text, odd, monkeypatch):
    """Marks of more than two documents go window by window, and shards are small enough to be several."""
    monkeypatch.setattr(substring_dedup, "HOT", 2)
    monkeypatch.setattr(substring_dedup, "GROUP", 4)
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", 300)
    monkeypatch.setattr(substring_dedup, "STREAM_WORDS", 500)
    p, q = text(90, 77), text(40, 78)
    rows = [(i, f"{text(10 + i, i)} {p} {text(20, 50 + i)}") for i in range(12)] + [(20 + i, near(text(150, 5), 3, i)) for i in range(9)]
    rows += [(40 + i, f"{text(60, 400 + i)} {q} {text(60, 500 + i)}") for i in range(8)] + [(60, p), (61, p), (62, f"{p} {p}"), (63, text(90, 900)), (64, text(90, 900) + " x")]
    rows += [(80 + i, t) for i, t in enumerate(odd)]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup.dedup(documents(rows)).collect()}
    assert got == brute_dedup(rows)


def test_the_index_decides_the_windows(documents, text):
    """Texts that share a mark, but no window of 50, are streamed too: without the index they would lose words."""
    shared = text(45, 7)
    rows = [(i, f"{text(60, 10 + i)} {shared} {text(60, 30 + i)}") for i in range(5)] + [(9, f"{text(20, 99)} {text(60, 10)}")]

    def all_match(stream, index):
        import pandas as pd

        return pd.DataFrame({"doc_id": stream["doc_id"], "k1": stream["k1"], "lo": stream["start"], "hi": (stream["start"] + stream["n_words"] - 50).astype("int32")})

    removed = lambda **more: {r["doc_id"]: r["n_removed"] for r in substring_dedup.dedup(documents(rows), **more).collect()}
    with_index, without = removed(), removed(search=all_match)
    assert with_index == {i: brute_dedup(rows)[i][1] for i, _ in rows} and with_index[9] == 60
    assert sum(without[i] > 0 for i in range(5)) > 1 and not any(with_index[i] for i in range(5))


def test_dedup_repeats_nulls_and_empty(documents, text):
    t = text(80, 1)
    got = sorted(tuple(r)[:3] for r in substring_dedup.dedup(documents([(5, t), (5, t), (9, t)])).collect())
    assert got == [(5, 80, 0), (5, 80, 0), (9, 80, 80)]
    assert [r["n_removed"] for r in substring_dedup.dedup(documents([(None, t), (1, t)])).collect()] == [0, 0]
    assert substring_dedup.dedup(documents([])).count() == 0
    p = text(60, 2)
    clean = {r["doc_id"]: r["text"] for r in substring_dedup.cleaned(documents([(1, p + "  end"), (2, f"a {p} b"), (3, p), (4, "few\n words")])).collect()}
    assert clean == {1: p + "  end", 2: "a b", 3: "", 4: "few\n words"}


def test_fm_index_matches_search():
    rng = np.random.default_rng(0)
    seq = rng.integers(0, 9, 300)
    w = Wavelet(seq, 9)
    c, i = rng.integers(0, 9, 50), rng.integers(0, 301, 50)
    assert [int(x) for x in w.rank(c, i)] == [int((seq[:b] == a).sum()) for a, b in zip(c, i, strict=True)]
    runs = [rng.integers(0, 3, n).astype(np.uint64) for n in (90, 200, 60)]
    stream = np.concatenate([runs[1][20:150], rng.integers(0, 4, 80).astype(np.uint64), runs[0][10:75]])
    run_of = np.repeat([0, 1, 2], [130, 80, 65])
    for doc in (2, 99):
        index = FMIndex(runs, np.array([1, 5, 3]), 50)
        hit = index.matches(stream, run_of, np.full(len(stream), doc))
        assert (FMIndex.load(index.dump()).matches(stream, run_of, np.full(len(stream), doc)) == hit).all()
        for k in range(len(stream)):
            end = np.searchsorted(run_of, run_of[k], "right")
            want = k + 50 <= end and any((r[j : j + 50] == stream[k : k + 50]).all() and o < doc for r, o in zip(runs, (1, 5, 3), strict=True) for j in range(len(r) - 49))
            assert hit[k] == want


@pytest.mark.parametrize("size", [7, 1 << 22])
def test_words_match_split(odd, size):
    texts = [*odd, "a\tb\x0bc\x0cd\re  f", "ends "]
    got = []
    for b in blocks(pa.array(texts, pa.string()), max_bytes=size):
        got += [[b.word(i) for i in range(b.doc[d], b.doc[d + 1])] for d in range(b.n_docs)]
        h = {b.word(i): x for i, x in enumerate(b.hashes())}
        assert len(set(h.values())) == len(h)
    assert got == [(t or "").encode().split() for t in texts]


def test_windows_and_sliding():
    x = np.random.default_rng(1).integers(0, 50, 200).astype(np.uint64)
    h = windows(x, 5)
    same = {}
    for i in range(196):
        same.setdefault(tuple(x[i : i + 5]), set()).add(int(h[i]))
    assert all(len(v) == 1 for v in same.values()) and len({v for s in same.values() for v in s}) == len(same)
    assert [int(v) for v in sliding(x, 7, np.minimum)[:194]] == [int(x[i : i + 7].min()) for i in range(194)]


def test_runs_reach_the_recall_over_all_sketches():
    """Against drawn sketches: all runs share one, and a branch needs one of a node's positions to agree."""
    import numpy as np

    runs = jaccard_join.runs_for(0.8, 0.9999)
    assert jaccard_join.recall_of(0.8, jaccard_join.DEPTH, runs) >= 0.9999 > jaccard_join.recall_of(0.8, jaccard_join.DEPTH, runs - 1)
    same = np.random.default_rng(0).binomial(jaccard_join.POSITIONS, 0.8, 200_000)
    missed = [(1 - jaccard_join.survival(0.8, jaccard_join.DEPTH, k / jaccard_join.POSITIONS)) ** runs if k >= 16 else 1 for k in range(33)]
    assert np.mean(np.array(missed)[same]) < 2e-4
    assert jaccard_join.runs_for(0.5, 0.9999) < 1000
