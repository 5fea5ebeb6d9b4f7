"""op5, op6, op10 and the pipeline."""

import collections
import json
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from halocline.llm import packing, pitman_yor, shards
from halocline.llm.words import blocks

LOW = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def tokens(t):
    return [*(t or "").encode().translate(LOW).split(), b""]


def test_base_scores_match_brute_force(spark, documents, folder, text, odd):
    rows = [(i, text(60, i, 50)) for i in range(60)] + [(100 + i, t) for i, t in enumerate(odd)] + [(3, text(60, 3, 50)), (None, "A b"), (None, "A b")]
    got = pitman_yor.query(spark, folder(documents=documents(rows))).collect()
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = collections.Counter(w for i, t in rows if not out(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = sorted((repr(i), out(i), len(tokens(t)), sum(w in c for w in tokens(t)), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t)), 6)) for i, t in rows)
    assert sorted((repr(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)


def test_held_out_text_beats_strange_text(spark, documents, text):
    docs = documents([(i, text(80, i, 60)) for i in range(40)])
    model = pitman_yor.fit(docs.select("text"))
    new = documents([(1, text(60, 999, 60)), (2, " ".join(f"q{i * 7919 % 1000}zz" for i in range(60)))])
    a, b = pitman_yor.score(new, model).orderBy("doc_id").collect()
    assert a["n_tokens"] == b["n_tokens"] == 61 and a["n_known"] > 55 and b["n_known"] == 1
    assert a["score"] > b["score"] + 60 and a["score"] / 61 > -3.2


def test_head_and_tail_agree(spark, documents, text):
    docs = documents([(i, text(80, i, 300)) for i in range(40)])
    model = pitman_yor.fit(docs.select("text"))
    a = {r["doc_id"]: (r["n_known"], r["base_score"], r["score"]) for r in pitman_yor.score(docs, model, head=10_000).collect()}
    b = {r["doc_id"]: (r["n_known"], r["base_score"], r["score"]) for r in pitman_yor.score(docs, model, head=5).collect()}
    for i, x in a.items():
        assert x[0] == b[i][0] and x[1:] == pytest.approx(b[i][1:], abs=1e-4)


def test_probabilities_sum_to_at_most_one(spark, documents, text):
    docs = documents([(i, text(50, i, 40)) for i in range(30)])
    model = pitman_yor.fit(docs.select("text"))
    rows = np.array([r["logp"] for r in model.tokens.collect()], float)
    total = (10**rows).sum(0)
    assert (total < 1 + 1e-6).all() and (total > 0.3).all()
    two, three, log2, log3 = model.spelling
    assert np.allclose((10.0 ** log3.astype(float)).sum(1), 1, atol=1e-3) and np.allclose((10.0 ** log2.astype(float)).sum(1), 1, atol=1e-3)


def test_model_of_nothing(spark, documents):
    model = pitman_yor.fit(documents([]).select("text"))
    got = pitman_yor.score(documents([(1, "a b"), (2, None)]), model).select("doc_id", "n_tokens", "n_known").collect()
    assert sorted(map(tuple, got)) == [(1, 3, 0), (2, 1, 0)]
    assert pitman_yor.score(documents([]), model).count() == 0


def test_word_order_counts(spark, documents):
    """Two words of like use after other words: only their order tells texts apart."""
    rows = [(i, " ".join(f"a{j} b{j}" for k in range(40) for j in [(i * 7 + k * k) % 30])) for i in range(40)]
    model = pitman_yor.fit(documents(rows).select("text"))
    assert model.contexts.count() == 61
    right, wrong = " ".join(f"a{j} b{j}" for j in range(30)), " ".join(f"a{j} b{(j + 11) % 30}" for j in range(30))
    a, b = pitman_yor.score(documents([(1, right), (2, wrong)]), model).orderBy("doc_id").collect()
    assert a["base_score"] == pytest.approx(b["base_score"]) and a["score"] > b["score"] + 30


def test_words_late_in_a_partition_count(spark, documents):
    """A context is counted wherever it stands: past the first block of a task, and in any order of the texts."""
    late = [(i, "rare one rare two") for i in range(2, 6)]
    rows = [(1, "x y " * 300_000), *late]
    seen = []
    for r in (rows, rows[::-1]):
        model = pitman_yor.fit(documents(r).select("text").coalesce(1))
        assert model.contexts.count() == 6
        seen.append(sorted(map(tuple, model.pairs.select("u", "w", "n", "c").collect())))
    assert seen[0] == seen[1] and sorted(r[2] for r in seen[0]) == [1, 1, 4, 4, 4, 4, 4, 299_999, 300_000]


def test_spelling_needs_no_room_for_its_contexts(spark, documents, text):
    """What is broadcast of the spelling changes nothing: other three-byte contexts have restaurants too, and shorter ones back them."""
    docs = documents([(i, f"{text(60, i, 400)} żółw{i} {chr(0x4E00 + 40 * i)}{chr(0x3042 + i)}") for i in range(40)])
    whole, part = (pitman_yor.fit(docs.select("text"), contexts=k) for k in (1 << 14, 3))
    assert whole.spellings[-1].whole and not part.spellings[-1].whole and len(part.spelling[1]) == 3
    words = spark.createDataFrame([(i, w.encode()) for i, w in enumerate(["w12x3", "żółw99", "qzzx1", "", "\u4e00\u4e01", "w1w1w1w1"])], "h long, word binary")
    one = whole.spellings[-1]
    few = pitman_yor.Spelt(one.keys, one.log, one.three[:2], one.log3[:2], False, one.restaurants)
    a, b = ({r["h"]: r["log_h"] for r in pitman_yor.spelled(words, x).collect()} for x in (one, few))
    assert len(a) == 6 and a == pytest.approx(b, abs=1e-4)
    assert part.spelling[0].tolist() == whole.spelling[0].tolist()
    # Bytes never seen after these two still follow what was seen after the last, or any.
    where = lambda key: pitman_yor.spell((one.keys, one.log, one.three[:0], one.log3[:0], True), np.frombuffer(key, np.uint8), np.array([0]), np.array([len(key)]))[0][0]
    assert where(b"~~x") > where(b"~~~") + 0.5


def test_scores_do_not_depend_on_files_buckets_or_order(spark, documents, text, tmp_path, monkeypatch):
    """One file or eight, forwards or backwards: equal scores. Many buckets, of which frequent contexts take several, give the same model but for those contexts' draws."""
    rows = [(i, f"the {text(40, i, 80)} the of the {text(10, i + 100, 4000)}") for i in range(80)]
    every = []
    for k, r in enumerate((rows, rows[::-1], rows)):
        path = str(tmp_path / f"d{k}")
        documents(r).repartition(1 if k else 8).write.parquet(path)
        if k == 2:
            monkeypatch.setattr(pitman_yor, "BUCKET_BYTES", 4_000)
        docs = spark.read.parquet(path)
        model = pitman_yor.fit(docs.select("text"))
        every.append(({x["doc_id"]: (x["n_known"], x["base_score"], x["score"]) for x in pitman_yor.score(docs, model, head=300).collect()}, model))
    (a, one), (b, _), (c, many) = every
    assert all(a[i] == pytest.approx(b[i], abs=1e-9) for i in a)
    assert one.over.n == 1 and many.over.n > 5 and len(many.over.frequent) and many.over.spread.max() > 1
    assert all(a[i][:2] == pytest.approx(c[i][:2]) and a[i][2] == pytest.approx(c[i][2], rel=0.01) for i in a)
    pairs = lambda m: sorted(map(tuple, m.pairs.select("u", "w", "n", "c").collect()))
    assert pairs(one) == pairs(many)


def test_seating_agrees_with_one_customer_at_a_time():
    """A restaurant whose customers are removed and seated one by one, with all tables written out, against whole dishes at once."""
    rng, customers, p0, d = np.random.default_rng(3), np.array([1, 2, 5, 9, 14, 20]), np.array([0.3, 0.2, 0.2, 0.1, 0.1, 0.1]), 0.6
    tables, sums, rounds = [[1] * c for c in customers], np.zeros(6), 4000
    for r in range(rounds + 50):
        for w, c in enumerate(customers):
            for _ in range(c):
                at = rng.choice(len(tables[w]), p=np.array(tables[w]) / sum(tables[w]))
                tables[w][at] -= 1
                if not tables[w][at]:
                    tables[w].pop(at)
                total = sum(map(len, tables))
                weights = np.array([*(np.array(tables[w]) - d), (pitman_yor.THETA + d * total) * p0[w]])
                at = rng.choice(len(weights), p=weights / weights.sum())
                if at == len(tables[w]):
                    tables[w].append(1)
                else:
                    tables[w][at] += 1
        sums += (r >= 50) * np.array([len(x) for x in tables])
    t, mine, keys = np.ones(6, np.int64), np.zeros(6), np.arange(6, dtype=np.uint64)
    for r in range(2050):
        for w in range(6):  # dish by dish, as there: restaurants of many dishes are seated with all others as they were
            t[w] = pitman_yor.seated(customers[w : w + 1], p0[w : w + 1], t.sum(keepdims=True), t[w : w + 1], d, keys[w : w + 1], r)[0]
        mine += (r >= 50) * t
    assert mine / 2000 == pytest.approx(sums / rounds, rel=0.06, abs=0.05)


def test_many_customers_and_the_exact_distribution():
    """Draws by the limit for many customers, against the Stirling numbers."""
    keys = np.arange(20_000, dtype=np.uint64)
    for mean in (0.01, 2.0, 40.0):
        x = pitman_yor.poisson(np.full(len(keys), mean), keys, 7)
        assert x.mean() == pytest.approx(mean, rel=0.06, abs=0.003) and x.var() == pytest.approx(mean, rel=0.06, abs=0.003)
    n, d = 900, 0.6
    ways, t = pitman_yor.stirling(d, n)[n, 1:], np.arange(1, n + 1)
    for p0, others in ((1e-4, 50), (0.02, 40), (0.1, 300), (0.3, 3000)):
        weight = ways + np.cumsum(np.log(1 + d * (others + t - 1))) + t * np.log(p0)
        chance = np.exp(weight - weight.max())
        want = (t * chance).sum() / chance.sum()
        drawn = [pitman_yor.seated(np.full(5000, n), np.full(5000, p0), np.full(5000, others + 1), np.ones(5000, np.int64), d, keys[:5000], s).mean() for s in (1, 2)]
        assert np.mean(drawn) == pytest.approx(want, rel=0.08), (p0, others)


def test_scores_match_brute_force(spark, documents, text):
    """The score of a text, from the model's tables read back, written out token by token."""
    rows = [(i, text(30, i, 40)) for i in range(30)]
    model = pitman_yor.fit(documents(rows).select("text"))
    new = [(100, rows[3][1]), (101, text(20, 99, 60) + " Zebra quagga"), (102, "")]
    h = lambda w: int((next(iter(blocks(pa.array([w]), lower=True))).hashes().view(np.int64))[0]) if w else int(np.array([pitman_yor._END]).view(np.int64)[0])
    begin = int(np.array([pitman_yor._BEGIN]).view(np.int64)[0])
    p = {r["h"]: 10 ** np.array(r["logp"]) for r in model.tokens.collect()}
    b = {r["u"]: np.array(r["backoff"]) for r in model.contexts.collect()}
    rooms = pitman_yor.Rooms.of(pitman_yor._parsed(model.rooms.toArrow()))
    single = pitman_yor._parsed(model.rooms.toArrow())["single"][0][0]
    own = {(int(u), int(w)): x for u, w, x in zip(rooms.u[rooms.room].view(np.int64), rooms.words[rooms.place].view(np.int64), rooms.own(model.d), strict=True)}
    own |= {(int(u), int(w)): (1 - model.d) / (1 + n) for u, w, n in zip(np.repeat(rooms.u, rooms.once).view(np.int64), single.view(np.int64), np.repeat(rooms.n, rooms.once), strict=True)}
    total = {u: sum(x for (a, _), x in own.items() if a == u) for u in b}
    assert all(total[u] + b[u].mean() == pytest.approx(1, abs=1e-6) for u in b)  # a distribution after every context
    for r in pitman_yor.score(documents(new), model).collect():
        words, u, want = tokens(dict(new)[r["doc_id"]]), begin, 0.0
        for w in words:
            k = h(w.decode())
            if k not in p:
                word = spark.createDataFrame([(k, w)], "h long, word binary")
                p[k] = np.array([of.backoff() * 10 ** pitman_yor.spelled(word, s).first()["log_h"] for of, s in zip(model.parents, model.spellings, strict=True)])
            want += math.log10(own.get((u, k), 0.0) + (b.get(u, np.ones(2)) * p[k]).mean())
            u = k
        assert r["score"] == pytest.approx(want, abs=1e-3)


def test_seating():
    rng = np.random.default_rng(0)
    c = np.array([0, 1, 2, 10, 10_000, 10_000_000])
    t = pitman_yor.seat(c, np.array([1.0, 1, 1, 1, 1, 1e5]), 0.5, rng)
    assert t[0] == 0 and t[1] == 1 and ((t >= 1) & (t <= np.maximum(c, 1)))[1:].all()
    # Small cells against one-by-one seating.
    def one_by_one(n, a, d):
        k = 1
        for i in range(1, n):
            k += rng.random() < a / (i - d * k + a)
        return k

    many = pitman_yor.seat(np.full(4000, 30), np.full(4000, 0.7), 0.4, rng).mean()
    assert many == pytest.approx(np.mean([one_by_one(30, 0.7, 0.4) for _ in range(4000)]), rel=0.05)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200))
def test_plan_uses_every_piece_once(lengths):
    counts = np.bincount(np.array(lengths, int), minlength=65) if lengths else np.zeros(65, int)
    groups = packing.plan(counts, 64)
    used = np.zeros(65, int)
    for n, slots in groups:
        assert n > 0 and sum(slots) <= 64
        for s in slots:
            used[s] += n
    assert (used == counts).all()
    bound = -(-sum(lengths) // 64)
    assert bound <= sum(n for n, _ in groups) <= bound * 1.7 + 1


def test_pieces_round_trip(spark, documents, text, odd):
    import public_tokenizers
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(i, text(700, i, 90)) for i in range(12)] + [(50 + i, t) for i, t in enumerate(odd)] + [(80, "don't  stop\n\n 12ab, née Ünïcode 中文"), (81, "same"), (82, "same")]
    docs = documents(rows)
    placed = packing.pack_documents(docs)
    got = placed.collect()
    ids = {i: [*exact.encode(t or "", add_special_tokens=False).ids, 2] for i, t in rows}
    by = collections.defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    for i, full in ids.items():
        p = sorted(by[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in p] == list(range(len(p))) and sum(r["length"] for r in p) == len(full)
        for r in p:
            part = np.array(full[r["start"] : r["start"] + r["length"]], "<u4")
            assert r["ids_crc32"] == zlib.crc32(part.tobytes()) and r["length"] <= 1024
            assert r["piece"] == 0 or r["length"] == 1024
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 1024
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(docs, placed).collect()}
    assert {k: len(v) for k, v in whole.items()} == {k: sum(n for _, n in v) for k, v in sequences.items()}
    for r in got:
        assert whole[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]


def test_packing_repeats_and_empty(documents):
    rows = documents([(1, "a b"), (1, "a b"), (None, None)])
    got = packing.pack_documents(rows).collect()
    assert len(got) == 3 and len({(r["sequence_id"], r["offset"]) for r in got}) == 3
    assert packing.pack_documents(documents([])).count() == 0


def test_store(spark, documents, tmp_path):
    store = shards.ShardStore(spark, str(tmp_path / "s"), target_bytes=1 << 20, fanout=3)
    assert store.version() == 0
    with pytest.raises(ValueError):
        store.read()
    for k in range(5):
        store.append(documents([(10 * k + i, f"text {i}") for i in range(4)]))
    store.append(documents([]))
    assert store.version() == 5
    before = sorted(map(tuple, store.read().select("doc_id", "text").collect()))
    old = {r.name for r in store.manifest()["runs"]}  # and the folder of the append without rows
    store.compact()
    now = store.manifest()
    assert store.version() == 6 and len(now["runs"]) == 1 and now["runs"][0].rows == 20
    assert sorted(map(tuple, store.read().select("doc_id", "text").collect())) == before
    assert store.read(5).count() == 20 and store.compact() == 6
    assert store.vacuum() == len(old) + 1 and store.read().count() == 20


def test_store_of_an_empty_table(spark, documents, folder):
    out = shards.query(spark, folder(documents=documents([])))
    assert out.count() == 0 and out.columns == ["doc_id", "source", "lang", "n_chars", "n_bytes", "text_md5"]
    odd = [(1, None), (1, None), (2, ""), (3, "x" * 100_000)]
    assert sorted((r["doc_id"], r["n_bytes"]) for r in shards.query(spark, folder(documents=documents(odd))).collect() if r["n_bytes"] is not None) == [(2, 0), (3, 100_000)]


def test_arrivals_with_nulls(spark, documents, tmp_path):
    store = shards.ShardStore(spark, str(tmp_path / "s"))
    df = documents([(1, None), (1, None), (None, "x")]).withColumn("source", F.when(F.col("text") == "x", F.lit("a/b=c")))
    store.append(df, "source")
    assert len(store.manifest()["runs"]) == 2 and store.read().count() == 3 and store.read().columns == df.columns


def test_a_lost_race_is_tried_again(spark, documents, tmp_path, monkeypatch):
    a, b = (shards.ShardStore(spark, str(tmp_path / "s")) for _ in range(2))
    a.append(documents([(1, "x")]))
    stale = a.manifest()
    first = iter([stale])
    fresh = shards.ShardStore.manifest
    monkeypatch.setattr(a, "manifest", lambda version=None: next(first, None) or fresh(a, version))
    b.append(documents([(2, "y")]))
    a.append(documents([(3, "z")]))
    assert sorted(r["doc_id"] for r in b.read().collect()) == [1, 2, 3] and b.version() == 3
    left = [p.name for p in (tmp_path / "s/manifest").iterdir() if p.name.endswith(".json")]
    assert sorted(left) == [f"v{i:010d}.json" for i in (1, 2, 3)]
    assert json.loads((tmp_path / "s/manifest" / sorted(left)[-1]).read_text())["version"] == 3


def test_merge_plan():
    run = lambda name, size: shards.Run(name, 1, size, 1)
    mb = 1 << 20
    assert shards.merges([run("a", mb), run("b", mb)], 100 * mb) == []
    groups = shards.merges([run(str(i), mb) for i in range(16)] + [run("big", 300 * mb)], 100 * mb)
    assert len(groups) == 1 and len(groups[0]) == 16
    assert shards.merges([shards.Run("x", 1, 10 * mb, 40), shards.Run("y", 1, 300 * mb, 3)], 100 * mb) == [[shards.Run("x", 1, 10 * mb, 40)]]


def test_pipeline_stages(spark, documents, folder, text):
    import corpus_pipeline as pipeline

    item = text(40, 900)
    rows = [(1, text(100, 1)), (2, text(100, 1)), (3, "| # " * 60), (4, f"{text(60, 2)} {item} {text(20, 3)}"), (5, f"{text(60, 4)} password=hunter22 {text(5, 5)}"), (6, None), (7, text(90, 6))]
    d = folder(documents=documents(rows), benchmark=spark.createDataFrame([(1, item)], "item_id long, text string"))
    docs = spark.read.parquet(f"{d}/documents.parquet")
    left = []
    for name, stage in pipeline.STAGES[:-1]:
        docs = pipeline.stored(stage(spark, docs, d), name)
        assert docs.columns == pipeline.COLUMNS
        left.append(sorted(r["doc_id"] for r in docs.collect()))
    assert left == [[1, 2, 4, 5, 7], [1, 4, 5, 7], [1, 5, 7], [1, 5, 7]]
    five = docs.where("doc_id = 5").first()
    assert "hunter22" not in five["text"] and five["n_chars"] == len(five["text"])
    placed = pipeline.run(spark, d)
    assert sorted(r["doc_id"] for r in placed.collect()) == [1, 5, 7]
    empty = folder(documents=documents([]), benchmark=spark.createDataFrame([], "item_id long, text string"))
    assert pipeline.run(spark, empty).count() == 0


def test_pipeline_matches_brute_force(spark, duck, folder, tmp_path):
    """On the smallest driver tables: the first two stages against their SQL, each on its own input, the third and fourth written out, the last by its pieces."""
    import re

    import corpus_pipeline as pipeline

    from halocline.llm import jaccard_join, quality_rules, secret_scan
    from test_filters import brute_leaks, brute_spans

    source = "/root/testdata/sf0.001"
    docs, stages = spark.read.parquet(f"{source}/documents.parquet"), dict(pipeline.STAGES)

    def stage(name, df):
        return pipeline.stored(stages[name](spark, df, source), name)

    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    one = stage("quality_rules", docs)
    assert ids(one) == sorted(r[0] for r in duck(source).execute(f"select doc_id from ({quality_rules.ORACLE}) where kept").fetchall())
    two = stage("jaccard_join", one)
    folder(documents=one)
    con = duck(tmp_path / "none")
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert ids(two) == sorted(r[0] for r in con.execute(f"select doc_id from ({jaccard_join.ORACLE}) where doc_id = class_id").fetchall())
    texts = {r["doc_id"]: r["text"] for r in two.collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{source}/benchmark.parquet").collect()]
    leaked = {doc for doc, _ in brute_leaks(list(texts.items()), items)}
    three = stage("decontaminate", two)
    assert leaked and ids(three) == sorted(set(texts) - leaked)
    four = {r["doc_id"]: r["text"] for r in stage("secret_scan", three).collect()}
    assert sorted(four) == ids(three)
    least = secret_scan.thresholds(found := pipeline.stored(secret_scan.scan(three.select("doc_id", "text")), "found"))
    extra = {r["doc_id"]: [(c["s"], c["e"]) for c in r["found"] if c["bin"] >= least.get(c["length_class"], 10**6)] for r in found.collect()}
    for i, got in four.items():
        spans = sorted([tuple(map(int, x.split(":")[1:])) for x in filter(None, brute_spans(texts[i]).split(","))] + extra[i])
        out, at = [], 0
        for a, b in spans:
            if a > at or not out:
                out.append(texts[i][at:a] + "<secret>")
            at = max(at, b)
        assert got == ("".join(out) + texts[i][at:] if spans else texts[i]) and not re.search(r"AKIA[A-Z0-9]{16}", got)
    placed = pipeline.run(spark, source).collect()
    assert sorted({r["doc_id"] for r in placed}) == sorted(four)


def test_fast_ids_are_the_exact_ones():
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    exact, ids, r = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), packing.tokenizer(), random.Random(4)
    words = ["the", "it's", "Éva", "x1", "12 000", "...", "don't", "\n\n", "  ", "ſ", "ß", "naïve"]
    texts = ["".join(chr(r.randrange(0x250)) for _ in range(r.randrange(1, 60))) for _ in range(3000)] + [" ".join(r.choice(words) for _ in range(30)) for _ in range(500)]
    for t in texts + ["", "a<|endoftext|>b", "日本語 text", "\u2003x", "a" * 9000]:
        assert ids(t).tolist() == exact.encode(t, add_special_tokens=False).ids, repr(t)


def test_number_of_sequences(spark):
    """Near the bound that no packing can beat: all ids by the capacity, or pieces of which no two fit together."""
    placed = packing.query(spark, "/root/testdata/sf0.01")
    r = placed.agg(F.countDistinct("sequence_id").alias("n"), F.sum("length").alias("ids"), F.count(F.when(F.col("length") > 512, 1)).alias("large")).first()
    assert max(-(-r["ids"] // 1024), r["large"]) <= r["n"] <= 1.01 * max(-(-r["ids"] // 1024), r["large"]) + 1
