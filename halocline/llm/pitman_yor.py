"""Scoring with a hierarchical Pitman-Yor language model.

Tokens are words, A-Z in lower case, and one end per text. A token's context is the word before
it, or the begin of the text. Every context seen has a restaurant over tokens; they share one
parent restaurant, whose base spells a token byte by byte: restaurants for the last three, two,
one and no bytes, each the parent of the longer ones, over a uniform base. So every token has a
probability after every context, seen or not.

A Gibbs sweep takes the customers of each dish of each restaurant out and seats them again, given
all others: the number of their tables is drawn from its distribution given the tables of the
other dishes and the parent's probability, exactly up to 256 customers, beyond that from its limit
for many customers. Tables of the context restaurants are customers of the parent, its tables are
customers of the spelling restaurants. Draws depend on the context,
the token and the sweep alone, so the model and the scores are the same however the texts are
dealt over files and tasks. The predictive probabilities of the sweeps after the first are
averaged.

Data travel in few, large rows. Contexts and tokens are dealt over buckets by hash, and each
bucket is one row of packed arrays; a frequent context has its tokens in several buckets. In a
sweep, a bucket of contexts sends its numbers of tables to the buckets of tokens that it holds, and
gets their probabilities back. To score, a text sends each of its pairs that the broadcast head of
the model does not settle to the pair's bucket, which answers with one sum for each text.
"""

from __future__ import annotations

import gc
import math
import pickle
import time
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, wraps

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import hadoop_fs, shared_dir, stored, table
from .words import Block, blocks, hash_spans, mix

HEAD = 1 << 19  #: pairs in the broadcast head, and half the tokens there
FLUSH = 1 << 20  #: different pairs that a task holds before it passes on their counts
SENT = 1 << 18  #: pairs of texts that a task holds before it sends its requests
BUCKET_BYTES = 16 << 20  #: of text for each bucket
SAMPLE_ROWS, FREQUENT = 5_000, 1e-5  #: texts, by hash, that tell frequent contexts; their least share of the words there
BATCH = 2000  #: texts in an Arrow batch
ROUNDS = 2  #: texts are scored in so many parts, of which one at a time has its requests on disk
CONTEXTS = 1 << 15  #: three-byte contexts whose spelling is broadcast; bytes after others are joined to theirs
SWEEPS, BURN_IN = 3, 1
EXACT = 256  #: customers up to which tables are drawn from their distribution
THETA = 1.0
START, STOP, SYMBOLS = 256, 257, 258
_END = np.uint64(0x5851F42D4C957F2D)  #: hash of the end token
_BEGIN = np.uint64(0x14057B7EF767814F)  #: hash of the context of a text's first token


def pack(*arrays) -> bytes:
    return pickle.dumps(arrays, 5)


def small(x: np.ndarray) -> np.ndarray:
    """x, which has no negative values, in the smallest type that holds it."""
    return x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))


def uniform(keys: np.ndarray, *salts: int) -> np.ndarray:
    """A number between 0 and 1 for each key, the same in every run."""
    for salt in salts:
        keys = mix(keys ^ mix(np.array([salt], np.uint64)))
    return ((keys >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53


def poisson(mean: np.ndarray, keys: np.ndarray, *salts: int) -> np.ndarray:
    """Draws by inversion; by the normal distribution from a mean of 30 on."""
    u, many = uniform(keys, *salts, 1), mean >= 30
    out = np.zeros(len(mean), np.int64)
    if many.any():
        z = np.sqrt(-2 * np.log(u[many])) * np.cos(2 * np.pi * uniform(keys[many], *salts, 2))
        out[many] = np.maximum(np.rint(mean[many] + z * np.sqrt(mean[many])), 0)
    at = np.flatnonzero(~many)
    m, mass = mean[at], np.exp(-mean[at])
    below, k = mass.copy(), 0
    while len(at):
        on = (u[at] > below) & (k < 200)
        out[at[~on]] = k
        at, m, mass, below = at[on], m[on], mass[on], below[on]
        k += 1
        mass = mass * m / k
        below = below + mass
    return out


@lru_cache(maxsize=8)
def stirling(discount: float, most: int = EXACT) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers: ways to seat c customers at t tables, weighted by the discount."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[0, 0] = out[1, 1] = 0.0
    for c in range(1, most):
        t = np.arange(1, c + 2)
        stay = out[c, 1 : c + 2] + np.log(np.maximum(c - discount * t, 1e-300))
        out[c + 1, 1 : c + 2] = np.logaddexp(out[c, : c + 1], stay)
    return out


def seated(customers: np.ndarray, p0: np.ndarray, total: np.ndarray, own: np.ndarray, discount: float, keys: np.ndarray, salt: int) -> np.ndarray:
    """Tables of each dish after its customers were taken out and seated again.

    p0: the parent's probability of the dish; total, own: the tables of its restaurant and those of the dish before.
    """
    t = np.minimum(customers, 1).astype(np.int64)
    order = np.argsort(customers, kind="stable")
    cuts = np.searchsorted(customers[order], np.arange(2, EXACT + 2))
    ways, others = stirling(discount), (total - own).astype(float)
    for c in range(2, EXACT + 1):
        rows = order[cuts[c - 2] : cuts[c - 1]]
        for at in np.array_split(rows, max(1, len(rows) * c >> 21)):
            if not len(at):
                continue
            i = np.arange(c)
            weight = ways[c, 1 : c + 1] + np.cumsum(np.log(THETA + discount * (others[at, None] + i)), 1) + (i + 1) * np.log(np.maximum(p0[at, None], 1e-300))
            chance = np.cumsum(np.exp(weight - weight.max(1, keepdims=True)), 1)
            t[at] = np.minimum((chance < uniform(keys[at], salt, 3)[:, None] * chance[:, -1:]).sum(1) + 1, c)
    at = order[cuts[EXACT - 1] :]
    if len(at):
        # One table, and for the rest the limit for many customers: Poisson, with fewer where tables run out of customers.
        c, rest = customers[at].astype(float), np.zeros(len(at))
        for _ in range(3):
            a = np.maximum((THETA + discount * (others[at] + 1 + rest)) * p0[at], 1e-300)
            rest = a / discount * (1 - _left(a, c, discount) ** discount)
        t[at] = np.minimum(1 + poisson(rest, keys[at], salt, 4), customers[at])
    return t


def _left(a: np.ndarray, c: np.ndarray, discount: float) -> np.ndarray:
    """y between 0 and 1 with a * (1 - y) * y ** (discount - 1) = c: where the generating function of the Stirling numbers has its saddle."""
    low, high = np.full(len(a), -700.0), np.zeros(len(a))  # of log y
    for _ in range(60):
        mid = (low + high) / 2
        over = np.log(a) + np.log1p(-np.exp(np.minimum(mid, -1e-16))) + (discount - 1) * mid > np.log(c)
        low, high = np.where(over, mid, low), np.where(over, high, mid)
    return np.exp(low)


def seat(customers: np.ndarray, strength: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish after seating its customers. strength: (theta + d * tables of the restaurant) * base probability."""
    tables = np.minimum(customers, 1).astype(np.int64)
    at = np.flatnonzero(customers > 1)
    k, t, c, a = np.ones(len(at)), np.ones(len(at), np.int64), customers[at], strength[at]
    while len(at):
        step = np.minimum(np.maximum(1, k // 50), c - k)
        p = a / np.maximum(k - discount * t + a, 1e-300)
        t = t + rng.binomial(step.astype(np.int64), np.clip(p, 0, 1))
        k = k + step
        tables[at] = t
        on = k < c
        at, k, t, c, a = at[on], k[on], t[on], c[on], a[on]
    return tables


def discount_of(n1: float, n2: float) -> float:
    """The usual estimate from the numbers of dishes with one and two customers."""
    return float(np.clip(n1 / max(n1 + 2 * n2, 1), 0.1, 0.9))


class Spelling:
    """Restaurants over bytes after the last two, one and no bytes."""

    def __init__(self, contexts: np.ndarray):
        """contexts: sorted keys of two 9-bit symbols, all that occur."""
        self.keys = [np.zeros(1, np.int64), np.unique(contexts & 511), contexts]
        self.parent = [None, *(np.searchsorted(self.keys[d - 1], self.keys[d] & ((1 << (9 * (d - 1))) - 1)) for d in (1, 2))]
        self.p = [np.full((len(k), SYMBOLS), 1 / SYMBOLS, np.float32) for k in self.keys]

    def sweep(self, counts: np.ndarray, rng: np.random.Generator) -> None:
        """counts: customers of depth 2 [contexts, symbols]."""
        seated = []
        for depth in (2, 1, 0):
            base = self.p[depth - 1][self.parent[depth]] if depth else np.full((1, SYMBOLS), 1 / SYMBOLS, np.float32)
            cells = np.nonzero(counts)
            c = counts[cells].astype(np.int64)
            d = discount_of((c == 1).sum(), (c == 2).sum())
            # The tables of a restaurant before this sweep are unknown for new customers; its dishes are the least there can be.
            known = np.bincount(cells[0], minlength=len(counts))
            t = seat(c, (THETA + d * known[cells[0]]) * base[cells], d, rng)
            del base
            seated.append((depth, counts, cells, t, d))
            if depth:
                up = np.zeros((len(self.keys[depth - 1]), SYMBOLS), np.float64)
                np.add.at(up, (self.parent[depth][cells[0]], cells[1]), t)
                counts = up
        for depth, counts, cells, t, d in reversed(seated):
            base = self.p[depth - 1][self.parent[depth]] if depth else np.full((1, SYMBOLS), 1 / SYMBOLS, np.float32)
            total, tables = counts.sum(1, keepdims=True), np.bincount(cells[0], t, len(counts))[:, None]
            p = ((THETA + d * tables) / (THETA + total)).astype(np.float32) * base
            p[cells] += (counts[cells] - d * t) / (THETA + total[cells[0], 0])
            self.p[depth] = (p / p.sum(1, keepdims=True)).astype(np.float32, copy=False)


@dataclass(frozen=True)
class Spelt:
    """A sample of the spelling restaurants: sorted keys and log10 probabilities; three bytes' only for the most used
    contexts, in full on the cluster: (context, backoff, symbol, own). whole: all three-byte contexts are here."""

    keys: list[np.ndarray]
    log: list[np.ndarray]
    three: np.ndarray
    log3: np.ndarray
    whole: bool
    restaurants: DataFrame


def _seat_three(two: np.ndarray, p2: np.ndarray, d: float, sweep: int):
    """A mapInArrow function: (context, symbol, n) of arrays, with the tables t of each symbol."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            context = batch.column(0).to_numpy()
            size = batch.column(1).value_lengths().to_numpy()
            symbol, n = (batch.column(i).flatten().to_numpy() for i in (1, 2))
            row, at = np.repeat(np.arange(len(size)), size), np.searchsorted(two, context & ((1 << 18) - 1))
            key = mix(((context[row] << 9) | symbol).view(np.uint64))
            t = seated(n, p2[at[row], symbol].astype(float), size[row], np.ones(len(row)), d, key, sweep)  # the other symbols have a table each at least
            cuts = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (symbol, n, t))], ["context", "symbol", "n", "t"])

    return work


def spelling_sample(sums: DataFrame, spelling: Spelling | None, most: int, sweep: int, rng: np.random.Generator) -> tuple[Spelling, Spelt]:
    """Seats the customers (context, symbol, n) of the three-byte restaurants, and the tables up the chain."""
    low = F.col("context").bitwiseAND(F.lit((1 << 18) - 1))
    if spelling is None:
        two = np.sort(np.array([r[0] for r in sums.select(low).distinct().collect()], np.int64))  # 258 * 258 at most
        spelling = Spelling(two if len(two) else np.array([(START << 9) | START], np.int64))
    r = sums.agg(F.count(F.when(F.col("n") == 1, 1)), F.count(F.when(F.col("n") == 2, 1))).first()
    d = discount_of(*r)
    # A context has SYMBOLS symbols at most.
    each = sums.groupBy("context").agg(F.sort_array(F.collect_list(F.struct("symbol", "n"))).alias("x")).select("context", "x.symbol", "x.n")
    seated = stored(each.mapInArrow(_seat_three(spelling.keys[2], spelling.p[2], d, sweep), "context long, symbol array<int>, n array<long>, t array<long>"), "three")
    up = seated.select(low.alias("context"), F.explode(F.arrays_zip("symbol", "t")).alias("x")).groupBy("context", "x.symbol").agg(F.sum("x.t").alias("t")).toPandas()  # 258 cells for each of those
    counts = np.zeros((len(spelling.keys[2]), SYMBOLS), np.float64)
    counts[np.searchsorted(spelling.keys[2], up["context"].to_numpy(np.int64)), up["symbol"].to_numpy(int)] = up["t"].to_numpy(float)
    spelling.sweep(counts, rng)
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    own = F.transform(F.zip_with("n", "t", lambda a, b: a - d * b), lambda x: x / (THETA + F.col("total")))
    three = seated.withColumn("total", total("n")).select("context", "total", ((THETA + d * total("t")) / (THETA + F.col("total"))).alias("backoff"), "symbol", own.alias("own"))
    three = stored(three, "restaurants")
    top = three.orderBy(F.desc("total"), "context").limit(most).toPandas().sort_values("context", ignore_index=True)  # `most` rows
    keys = top["context"].to_numpy(np.int64)
    p = top["backoff"].to_numpy(np.float32)[:, None] * spelling.p[2][np.searchsorted(spelling.keys[2], keys & ((1 << 18) - 1))]
    if len(top):
        p[np.repeat(np.arange(len(top)), top["symbol"].map(len)), np.concatenate(top["symbol"].to_list())] += np.concatenate(top["own"].to_list()).astype(np.float32)
    log3 = np.log10(p / p.sum(1, keepdims=True))
    whole = len(top) < most or three.count() == len(top)
    return spelling, Spelt(list(spelling.keys), [np.log10(x) for x in spelling.p], keys, log3, whole, three.select("context", "backoff", "symbol", "own"))


def symbols(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each byte of each word and its stop: word, context key of three symbols, symbol."""
    length = ends - starts + 1
    word = np.repeat(np.arange(len(starts)), length)
    first = np.cumsum(length) - length
    place = np.arange(len(word)) - first[word]
    raw = np.minimum(starts[word] + place, max(len(data) - 1, 0))
    s = np.where(place == length[word] - 1, STOP, data[raw] if len(data) else STOP).astype(np.int64)
    before = lambda k: np.where(place >= k, s[np.maximum(np.arange(len(s)) - k, 0)], START)
    return word, (before(3) << 18) | (before(2) << 9) | before(1), s


def spell(of: tuple, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """log10 probability of each word's spelling by the restaurants here; an empty word is the end token.

    Then of each byte whose three-byte context is not here: word, context, symbol, and its log10 probability after
    the longest shorter context that occurs. Where that context has no restaurant at all, that is its probability.
    """
    keys, logs, three, log3, whole = of
    out, far = np.zeros(len(starts)), [(np.zeros(0, np.int64),) * 3 + (np.zeros(0),)]

    def among(known: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(known):
            return np.zeros(len(key), int), np.zeros(len(key), bool)
        at = np.minimum(np.searchsorted(known, key), len(known) - 1)
        return at, known[at] == key

    for part in np.array_split(np.arange(len(starts)), max(1, int((ends - starts).sum() >> 18))):
        if not len(part):
            continue
        word, key, s = symbols(data, starts[part], ends[part])
        at, here = among(three, key)
        p = np.zeros(len(key))
        p[here] = log3[at[here], s[here]]
        rest = np.flatnonzero(~here)
        low = logs[0][0][s[rest]].astype(float)
        for depth in (1, 2):
            at, has = among(keys[depth], key[rest] & ((1 << (9 * depth)) - 1))
            low[has] = logs[depth][at[has], s[rest[has]]]
        if whole:
            p[rest] = low
        else:
            far.append((part[word[rest]], key[rest], s[rest], low))
        out[part] = np.bincount(word, p, len(part))
    return out, *(np.concatenate(x) for x in zip(*far, strict=True))


def ragged(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of these stretches of data, one after another."""
    lengths = lengths.astype(np.int64)
    ends = np.cumsum(lengths)
    return data[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]


def _pair(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(mix(u) + w)


def grouped(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of x, where each different value begins in it, and one place of each in x. Not stable, which lets numpy sort fast."""
    order = np.argsort(x)
    s = x[order]
    new = np.flatnonzero(np.concatenate([[len(x) > 0], s[1:] != s[:-1]])[: len(x)])
    return order, new, order[new]


def _before(block: Block, x: np.ndarray, begin) -> np.ndarray:
    """What stands before each word, and before the end of each document: the word's x, or begin."""
    some = block.n_words() > 0
    u, last = np.full(len(x), begin), np.full(block.n_docs, begin)
    u[1:] = x[:-1]
    u[block.doc[:-1][some]] = begin
    last[some] = x[block.doc[1:][some] - 1]
    return np.append(u, last)


def _tokens_of(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, token, document) of each token; the documents' end tokens come last."""
    h = block.hashes()
    return _before(block, h, _BEGIN), np.append(h, np.full(block.n_docs, _END)), np.append(block.doc_of_word(), np.arange(block.n_docs))


def _spans(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    _, offs, buf = column.buffers()
    offsets = np.frombuffer(offs, np.int64, len(column) + 1, column.offset * 8)
    return (np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)), offsets[:-1], offsets[1:]


@dataclass(frozen=True)
class Deal:
    """How contexts and tokens are dealt over buckets. frequent: sorted hashes of contexts, and over how many buckets each goes."""

    n: int
    frequent: np.ndarray
    spread: np.ndarray

    def token(self, h: np.ndarray) -> np.ndarray:
        return (mix(h ^ np.uint64(0x1F)) % np.uint64(self.n)).astype(np.int64)

    def wide(self, u: np.ndarray) -> np.ndarray:
        if not len(self.frequent):
            return np.ones(len(u), np.uint64)
        at = np.minimum(np.searchsorted(self.frequent, u), len(self.frequent) - 1)
        return np.where(self.frequent[at] == u, self.spread[at], 1).astype(np.uint64)

    def sorted(self, u: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The order of pairs by bucket, then context, and where each bucket begins."""
        order = np.argsort(u)
        bucket = self.cell(u, w)[order]
        by = np.argsort(bucket.astype(np.min_scalar_type(self.n)), kind="stable")  # in linear time for small numbers
        return order[by], np.searchsorted(bucket[by], np.arange(self.n + 1))

    def cell(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        return ((mix(u ^ np.uint64(0x2F)) + mix(w ^ np.uint64(0x3F)) % self.wide(u)) % np.uint64(self.n)).astype(np.int64)


def deal(texts: DataFrame) -> Deal:
    """From the size of the texts, and the frequent words of those with the least hashes, copies counted once."""
    t = texts.columns[0]
    r = texts.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length(t)), F.lit(0)).alias("bytes")).first()
    n = max(1, math.ceil(r["bytes"] / BUCKET_BYTES))
    if n == 1:
        return Deal(1, np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    share = min(1.0, SAMPLE_ROWS / max(r["n"], 1))
    some = texts.where(F.pmod(F.xxhash64(t), F.lit(1 << 20)) < F.lit(math.ceil(share * (1 << 20)))).dropDuplicates([t])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.uint64), np.zeros(0)
        for batch in batches:
            for block in blocks(batch.column(0), lower=True):
                h = np.append(block.hashes(), np.full(block.n_docs, _BEGIN))
                keys, inverse = np.unique(np.concatenate([keys, h]), return_inverse=True)
                counts = np.bincount(inverse, np.concatenate([counts, np.ones(len(h))]), len(keys))
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))], ["h", "n"])

    sums = stored(some.mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")), "frequent")
    total = sums.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    least = max(1 / (4 * n), FREQUENT) * total
    rows = sums.where(F.col("n") > least).orderBy("h").collect()  # 1 / FREQUENT rows at most
    h, c = np.array([x["h"] for x in rows], np.int64).view(np.uint64), np.array([x["n"] for x in rows], float)
    order = np.argsort(h)
    return Deal(n, h[order], np.minimum(np.ceil(c[order] / total * 4 * n), n).astype(np.uint64))


def _rows(out: list[tuple], schema: str) -> pa.RecordBatch:
    """Rows of (kind, to, data), or of (to, data)."""
    kinds = {"kind": pa.string(), "to": pa.int32(), "data": pa.binary()}
    names = [x.split()[0] for x in schema.split(", ")]
    columns = list(zip(*out, strict=True)) if out else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[n]) for c, n in zip(columns, names, strict=True)], names)


_MESSAGE, _PART = "to int, data binary", "kind string, to int, data binary"


def _gathered(over: Deal):
    """A mapInArrow function: counts of a task's words, to the buckets of tokens, and of its pairs, to those of contexts behind them."""

    def dealt(bucket: np.ndarray, first: int, *arrays: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(over.n + 1))
        for b in range(over.n):
            at = order[cuts[b] : cuts[b + 1]]
            if len(at):
                yield _rows([(first + b, pack(*(x[at] for x in arrays)))], _MESSAGE)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, fresh = np.zeros(0, np.uint64), np.zeros(0, np.int64), []
        lengths, data = np.zeros(0, np.int64), np.zeros(0, np.uint8)
        held: list[tuple] = []

        def grown() -> None:
            nonlocal keys, counts, lengths, data, fresh
            k, n, size = (np.concatenate([a, *(f[i] for f in fresh)]) for i, a in enumerate((keys, counts, lengths)))
            every, starts = np.concatenate([data, *(f[3] for f in fresh)]), np.cumsum(size) - size
            order, new, first = grouped(k)
            keys, counts, lengths, data, fresh = k[first], np.add.reduceat(n[order], new), size[first], ragged(every, starts[first], size[first]), []

        def merged() -> tuple:
            u, w, n = (np.concatenate(x) for x in zip(*held, strict=True))
            order, new, first = grouped(_pair(u, w))
            return u[first], w[first], np.add.reduceat(n[order], new)

        def out(u: np.ndarray, w: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            order, cuts = over.sorted(u, w)
            for b in range(over.n):
                at = order[cuts[b] : cuts[b + 1]]
                if len(at):
                    new = np.flatnonzero(np.concatenate([[True], np.diff(u[at]) != 0]))
                    yield _rows([(over.n + b, pack(u[at][new], small(np.diff(np.append(new, len(at)))), w[at], small(n[at])))], _MESSAGE)

        for batch in batches:
            for block in blocks(batch.column(0), lower=True):
                h = block.hashes()
                _, new, first = grouped(h)
                n, h = np.diff(np.append(new, len(h))), h[first]
                new = np.ones(len(h), bool)
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                    new = keys[at] != h
                    counts[at[~new]] += n[~new]
                size = (block.ends - block.starts)[first[new]]
                fresh.append((h[new], n[new], size, ragged(block.data, block.starts[first[new]], size)))
                fresh.append((np.array([_END]), np.array([block.n_docs]), np.zeros(1, np.int64), np.zeros(0, np.uint8)))
                if sum(len(f[0]) for f in fresh) > max(200_000, len(keys)):
                    grown()
                u, w, _ = _tokens_of(block)
                _, new, first = grouped(_pair(u, w))
                held.append((u[first], w[first], np.diff(np.append(new, len(u)))))
                if sum(len(x[0]) for x in held) > FLUSH:
                    held[:] = [merged()]
                    if len(held[0][0]) > FLUSH // 2:
                        yield from out(*held[0])
                        held.clear()
        if held:
            yield from out(*merged())
        if fresh:
            grown()
        starts, bucket = np.cumsum(lengths) - lengths, over.token(keys)
        for b in range(over.n):
            at = np.flatnonzero(bucket == b)
            if len(at):
                yield _rows([(b, pack(keys[at], counts[at], small(lengths[at]), ragged(data, starts[at], lengths[at])))], _MESSAGE)

    return work


def _merged(over: Deal):
    """An applyInArrow function: what tasks have sent to a bucket -> its parts.

    Of tokens: (tokens) hashes, counts, lengths, bytes. Of contexts: (cells) contexts, customers, pairs seen once; room, word
    and customers of each other pair; those words by bucket. (single) the words of the pairs seen once, by context.
    (base) to the tokens: words, of how many single pairs. (up) to the tokens: words of the other pairs, their tables, one each. (counts) numbers of pairs by
    customers.
    """

    def tokens(b: int, parts: list[tuple]) -> list[tuple]:
        k, n, size = (np.concatenate([p[i] for p in parts]).astype(kind) for i, kind in enumerate((np.uint64, np.int64, np.int64)))
        data, starts = np.concatenate([p[3] for p in parts]), np.cumsum(size) - size
        order, new, first = grouped(k)
        h, c = k[first], np.add.reduceat(n[order], new)
        kept, times = np.unique(c, return_counts=True)
        return [("tokens", b, pack(h, small(c), small(size[first]), ragged(data, starts[first], size[first]))), ("counts", b, pack("tokens", kept, times))]

    def contexts(b: int, parts: list[tuple]) -> list[tuple]:
        u = np.concatenate([np.repeat(p[0], p[1]) for p in parts])
        w, n = (np.concatenate([p[i] for p in parts]).astype(kind) for i, kind in ((2, np.uint64), (3, np.int64)))
        order, new, first = grouped(_pair(u, w))
        u, w, n = u[first], w[first], np.add.reduceat(n[order], new)
        order, new, first = grouped(u)
        w, n, rooms = w[order], n[order], u[first]
        room = np.repeat(np.arange(len(rooms)), np.diff(np.append(new, len(u))))
        one = n == 1
        kept, times = np.unique(n, return_counts=True)
        out = [("counts", b, pack("pairs", kept, times)), ("single", b, pack(w[one]))]
        sent, k = np.unique(w[one], return_counts=True)
        where = over.token(sent)
        out += [("base", int(x), pack(sent[where == x], small(k[where == x]))) for x in np.unique(where)]
        words, place = np.unique(w[~one], return_inverse=True)
        by = np.lexsort((words, over.token(words)))
        rank = np.empty(len(words), np.int64)
        rank[by] = np.arange(len(words))
        words, place = words[by], rank[place]
        out.append(("cells", b, pack(rooms, small(np.bincount(room, n, len(rooms)).astype(np.int64)), small(np.bincount(room[one], minlength=len(rooms))), small(room[~one]), small(place), small(n[~one]), words)))
        return out + _up(over, b, words, np.bincount(place, minlength=len(words)))

    def work(rows: pa.Table) -> pa.Table:
        to, parts = rows.column("to")[0].as_py(), [pickle.loads(x) for x in rows.column("data").to_pylist()]
        out = tokens(to, parts) if to < over.n else contexts(to - over.n, parts)
        return pa.Table.from_batches([_rows(out, _PART)])

    return work


def _up(over: Deal, b: int, words: np.ndarray, tables: np.ndarray) -> list[tuple]:
    """Messages to the tokens' buckets: from where, words, their tables. words are in the order of those buckets."""
    where = over.token(words)
    return [("up", int(x), pack(b, words[where == x], small(tables[where == x]))) for x in np.unique(where)]


class Parts:
    """Rows of (kind, to, data) in the shared folder, a folder for each kind."""

    def __init__(self, rows: DataFrame, name: str):
        self.spark = rows.sparkSession
        self.path = f"{shared_dir(self.spark)}/{name}-{np.random.default_rng().integers(1 << 62):x}"
        # Mostly hashes, which nothing compresses: the least effort.
        rows.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", "1").partitionBy("kind").parquet(self.path)

    def of(self, *kinds: str) -> DataFrame:
        return self.spark.read.schema(_MESSAGE + ", kind string").parquet(self.path).where(F.col("kind").isin(*kinds)).select(*(x.split()[0] for x in _PART.split(", ")))

    def delete(self, *kinds: str) -> None:
        """Frees the space of these kinds, or all, when nothing will read them again."""
        for path in [f"{self.path}/kind={k}" for k in kinds] or [self.path]:
            fs, p = hadoop_fs(self.spark, path)
            fs.delete(p, True)


def free(spark, over: Deal) -> None:
    """Spark deletes the shuffles of plans that nothing refers to, once both collectors have run: Python's lets go of plans, then the driver's finds them."""
    for _ in range(2 if over.n > 1 else 0):  # one bucket is not worth the time
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def _parsed(rows: pa.Table) -> dict[str, list[tuple]]:
    out: dict[str, list[tuple]] = {}
    for kind, data in zip(rows.column("kind").to_pylist(), rows.column("data").to_pylist(), strict=True):
        out.setdefault(kind, []).append(pickle.loads(data))
    return out


@dataclass
class State:
    """A bucket of tokens: hash, count, spelling; customers from single pairs, and all; tables; log10 of the spelling's probability; samples of P(token)."""

    h: np.ndarray
    c: np.ndarray
    lengths: np.ndarray
    data: np.ndarray
    base: np.ndarray
    customers: np.ndarray
    t: np.ndarray
    log_h: np.ndarray
    p: list[np.ndarray]

    def packed(self) -> bytes:
        return pack(self.h, self.c, self.lengths, self.data, small(self.base), small(self.customers), small(self.t), self.log_h.astype(np.float32), self.p)

    @classmethod
    def of(cls, data: bytes) -> State:
        made = cls(*pickle.loads(data))
        made.base, made.customers, made.t = (x.astype(np.int64) for x in (made.base, made.customers, made.t))
        return made

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ends = np.cumsum(self.lengths.astype(np.int64))
        return self.data, ends - self.lengths, ends


@dataclass(frozen=True)
class Parent:
    """Customers, tables and discount of the parent restaurant."""

    n: float
    t: float
    d: float

    def backoff(self) -> float:
        return (THETA + self.d * self.t) / (THETA + self.n)

    def p(self, customers: np.ndarray, t: np.ndarray, log_h: np.ndarray) -> np.ndarray:
        """P(token), from its customers, tables and spelling."""
        return np.maximum(customers - self.d * t, 0) / (THETA + self.n) + self.backoff() * 10.0 ** log_h.astype(float)


def _begun(state: pa.Table, base: pa.Table) -> pa.Table:
    """A bucket's tokens with the customers that single pairs send; one table each."""
    rows = _parsed(state).get("tokens", [])
    if not rows:
        return pa.Table.from_batches([_rows([], _PART)])
    h, c, lengths, data = rows[0]
    sums = np.zeros(len(h), np.int64)
    for words, n in _parsed(base).get("base", []):
        sums[np.searchsorted(h, words)] += n
    ones = np.ones(len(h), np.int64)
    made = State(h, c, lengths, data, sums, np.maximum(sums, 1), ones, np.zeros(len(h), np.float32), [])
    return pa.Table.from_batches([_rows([("state", state.column("to")[0].as_py(), made.packed())], _PART)])


def _parents_seated(of: Parent, sweep: int):
    """A cogroup function: tokens, and the tables that contexts send -> tokens seated in the parent, and replies to the contexts."""

    def work(state: pa.Table, up: pa.Table) -> pa.Table:
        if not state.num_rows:
            return pa.Table.from_batches([_rows([], _PART)])
        now, to, asked = State.of(state.column("data")[0].as_py()), state.column("to")[0].as_py(), _parsed(up).get("up", [])
        places = [np.searchsorted(now.h, words) for _, words, _ in asked]
        now.customers = now.base.copy()
        for at, (_, _, tables) in zip(places, asked, strict=True):
            now.customers[at] += tables
        now.t = np.minimum(now.t, now.customers)
        now.t = seated(now.customers, 10.0 ** now.log_h.astype(float), np.full(len(now.h), of.t), now.t, of.d, mix(now.h), 1000 + sweep)
        out = [("state", to, now.packed())]
        for at, (b, _, _) in zip(places, asked, strict=True):
            out.append(("reply", b, pack(to, small(now.customers[at]), small(now.t[at]), now.log_h[at].astype(np.float32))))
        return pa.Table.from_batches([_rows(out, _PART)])

    return work


@dataclass
class Rooms:
    """A bucket of contexts: their hashes, customers and single pairs; of the other pairs the room, word and customers; the words.

    Then of those pairs the tables, and their sums over the samples; of the contexts the customers in all buckets, and samples of theta + d * tables in
    parts of theta + customers.
    """

    u: np.ndarray
    n: np.ndarray
    once: np.ndarray
    room: np.ndarray
    place: np.ndarray
    customers: np.ndarray
    words: np.ndarray
    t: np.ndarray
    sums: np.ndarray
    everywhere: np.ndarray
    backoff: list[np.ndarray]

    @classmethod
    def of(cls, parts: dict[str, list[tuple]]) -> Rooms:
        u, *numbers, words = parts["cells"][0]
        n, once, room, place, customers = (x.astype(np.int64) for x in numbers)
        t, sums, everywhere, backoff = parts["seats"][0] if "seats" in parts else (np.ones(len(room), np.int64), np.zeros(len(room), np.int64), n, [])
        return cls(u, n, once, room, place, customers, words, t.astype(np.int64), sums.astype(np.int64), everywhere.astype(np.int64), backoff)

    def own(self, d: float) -> np.ndarray:
        """The mean over the samples of (customers - d * tables) / (theta + customers of the context), of each pair seen twice or more."""
        return (self.customers - d * self.sums / len(self.backoff)) / (THETA + self.everywhere[self.room])

    def backoffs(self, over: Deal, frequent: np.ndarray) -> np.ndarray:
        """(context, sample); frequent: those of contexts that have several buckets, which no bucket knows alone."""
        out = np.stack(self.backoff, 1).astype(float)
        wide = np.flatnonzero(over.wide(self.u) > 1)
        out[wide] = frequent[np.searchsorted(over.frequent, self.u[wide])]
        return out


def _contexts_seated(over: Deal, of: Parent, d: float, sweep: int, kept: bool, frequent: dict[str, np.ndarray]):
    """A cogroup function: contexts, and their words' customers in the parent -> new tables, and what they send up.

    frequent: customers n and tables t of the contexts that have several buckets, in the order of the deal.
    """

    def work(rooms: pa.Table, replies: pa.Table) -> pa.Table:
        if not rooms.num_rows:
            return pa.Table.from_batches([_rows([], _PART)])
        now, b = Rooms.of(_parsed(rooms)), rooms.column("to")[0].as_py()
        told = sorted(_parsed(replies).get("reply", []), key=lambda x: x[0])
        p0 = np.concatenate([of.p(c.astype(np.int64), t.astype(np.int64), log_h) for _, c, t, log_h in told]) if told else np.zeros(0)
        own = lambda t: now.once + np.bincount(now.room, t, len(now.u)).astype(np.int64)
        customers, tables = now.n.copy(), own(now.t)
        wide = np.flatnonzero(over.wide(now.u) > 1)
        at = np.searchsorted(over.frequent, now.u[wide])
        mine = tables[wide]
        tables[wide], customers[wide] = frequent["t"][at], frequent["n"][at]
        now.t = seated(now.customers, p0[now.place], tables[now.room], now.t, d, _pair(now.u[now.room], now.words[now.place]), sweep)
        out = own(now.t)
        sent = [("frequent", b, pack(at, out[wide]))] if len(wide) else []
        out[wide] += tables[wide] - mine
        if kept:
            now.sums += now.t
            now.backoff = [*now.backoff, ((THETA + d * out) / (THETA + customers)).astype(np.float32)]
        sent.append(("seats", b, pack(small(now.t), small(now.sums), small(customers), now.backoff)))
        sent += _up(over, b, now.words, np.bincount(now.place, now.t, len(now.words)).astype(np.int64))
        return pa.Table.from_batches([_rows(sent, _PART)])

    return work


def _bytes(first: bool):
    """A mapInArrow function: (context, symbol, n), customers of the spelling restaurants summed by task; of each token's first table, or of its others."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums = np.zeros(0, np.int64), np.zeros(0)
        for batch in batches:
            for row in batch.column("data").to_pylist():
                now = State.of(row)
                data, starts, ends = now.spans()
                some = np.arange(len(now.h)) if first else np.flatnonzero(now.t > 1)
                for part in np.array_split(some, max(1, int((ends - starts)[some].sum()) >> 18)):
                    word, key, s = symbols(data, starts[part], ends[part])
                    n = np.ones(len(word)) if first else (now.t[part] - 1.0)[word]
                    keys, n = np.concatenate([keys, (key << 9) | s]), np.concatenate([sums, n])
                    order, new, one = grouped(keys)
                    keys, sums = keys[one], np.add.reduceat(n[order], new) if len(new) else n
        yield pa.RecordBatch.from_arrays([pa.array(keys >> 9), pa.array((keys & 511).astype(np.int32)), pa.array(np.rint(sums).astype(np.int64))], ["context", "symbol", "n"])

    return work


def _respelled(state: DataFrame, of: Spelt, parent: Parent | None) -> tuple[DataFrame, Broadcast]:
    """The tokens' rows with the probabilities of their spellings; with a parent, P(token) as one more sample. Then what the rows need until they are stored.

    Without a parent only tokens that occur twice are spelled: one that occurs once has one customer and one table, whatever its spelling.
    """
    whole, schema = of.whole, _PART
    here = state.sparkSession.sparkContext.broadcast((of.keys, of.log, of.three, of.log3, whole))

    def done(now: State) -> bytes:
        if parent is not None:
            now.p = [*now.p, parent.p(now.customers, now.t, now.log_h).astype(np.float32)]
        return now.packed()

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for to, row in zip(batch.column("to").to_pylist(), batch.column("data").to_pylist(), strict=True):
                now = State.of(row)
                some = np.arange(len(now.h)) if parent is not None else np.flatnonzero(now.c > 1)
                data, starts, ends = now.spans()
                now.log_h = now.log_h.astype(float)
                now.log_h[some], word, context, symbol, low = spell(here.value, data, starts[some], ends[some])
                far = [] if whole else [(int(w), int(c), int(s), float(x)) for w, c, s, x in zip(some[word], context, symbol, low, strict=True)]
                data = done(now) if whole else now.packed()
                lists = [pa.array([[f[i] for f in far]], pa.list_(kind)) for i, kind in enumerate((pa.int32(), pa.int64(), pa.int32(), pa.float64()))]
                yield pa.RecordBatch.from_arrays([pa.array(["state"]), pa.array([to], pa.int32()), pa.array([data], pa.binary()), *lists], ["kind", "to", "data", "i", "context", "s", "low"])

    rows = state.mapInArrow(near, schema + ", i array<int>, context array<long>, s array<int>, low array<double>")
    if whole:
        return rows.select("kind", "to", "data"), here
    rows = stored(rows, "near")
    far = rows.select("to", F.explode(F.arrays_zip("i", "context", "s", "low")).alias("x")).select("to", "x.i", "x.context", "x.s", F.pow(F.lit(10.0), F.col("x.low")).alias("low"))
    more = far_spelling(far, of).groupBy("to", "i").agg(F.sum("p").alias("more")).groupBy("to").agg(F.collect_list(F.struct("i", "more")).alias("more"))  # a bucket's tokens at most

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for to, row, extra in zip(batch.column("to").to_pylist(), batch.column("data").to_pylist(), batch.column("more").to_pylist(), strict=True):
                now = State.of(row)
                log_h = now.log_h.astype(float)
                for x in extra or []:
                    log_h[x["i"]] += x["more"]
                now.log_h = log_h
                yield _rows([("state", to, done(now))], _PART)

    return rows.select("to", "data").join(more, "to", "left").mapInArrow(add, schema), here


def _known(rows: list[tuple], kind: str) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens, or pairs, occur how often."""
    k, n = (np.concatenate([np.zeros(0, np.int64), *(r[i] for r in rows if r[0] == kind)]) for i in (1, 2))
    kept, inverse = np.unique(k, return_inverse=True)
    return kept, np.bincount(inverse, n, len(kept)).astype(np.int64)


def far_spelling(far: DataFrame, of: Spelt) -> DataFrame:
    """far (.., context, s, low) with p: log10 probability of byte s after a three-byte context; low: that after the shorter one."""
    joined = far.join(of.restaurants, "context", "left")
    # Symbols are sorted and differ, so one place at most is that of s.
    s = F.col("s").cast("int")
    own = F.get("own", (F.array_position("symbol", s) - 1).cast("int"))
    return joined.withColumn("p", F.log10(F.when(F.array_contains("symbol", s), own).otherwise(0.0) + F.coalesce("backoff", F.lit(1.0)) * F.col("low")))


def spelled(rows: DataFrame, of: Spelt) -> DataFrame:
    """(h, log_h) of rows (h, word): log10 probability of the word's spelling."""
    here = (of.keys, of.log, of.three, of.log3, of.whole)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            p, word, context, symbol, low = spell(here, *_spans(batch.column(1)))
            cuts = pa.array(np.searchsorted(word, np.arange(batch.num_rows + 1)).astype(np.int32))
            lists = (pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (context, symbol, low))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), *lists], ["h", "log_h", "context", "symbol", "low"])

    near = rows.select("h", "word").mapInArrow(work, "h long, log_h double, context array<long>, symbol array<long>, low array<double>")
    if of.whole:
        return near.select("h", "log_h")
    near = stored(near, "near")
    far = near.where(F.size("context") > 0).select("h", F.explode(F.arrays_zip("context", "symbol", "low")).alias("x"))
    far = far.select("h", "x.context", F.col("x.symbol").alias("s"), F.pow(F.lit(10.0), F.col("x.low")).alias("low"))
    more = far_spelling(far, of).groupBy("h").agg(F.sum("p").alias("more"))
    return near.select("h", "log_h").join(more, "h", "left").select("h", (F.col("log_h") + F.coalesce("more", F.lit(0.0))).alias("log_h"))


class Model:
    """A fitted model: rows of buckets of contexts (cells, single, seats) and of tokens (state); what holds for all of them.

    tokens (h, c, logp): every training token and its log10 probability in the parent, by sample; contexts (u, backoff):
    by sample; pairs (u, w, n, c): every context and token seen, how often, the token's count.
    """

    def __init__(self, over: Deal, rooms: DataFrame, state: DataFrame, spellings: list[Spelt], parents: list[Parent], d: float, frequent: np.ndarray, tokens: tuple, pairs: tuple):
        self.over, self.rooms, self.state, self.spellings, self.parents, self.d, self.frequent, self.token_counts, self.pair_counts = over, rooms, state, spellings, parents, d, frequent, tokens, pairs
        self.n, self.v, self.n_pairs = int((tokens[0] * tokens[1]).sum()), int(tokens[1].sum()), int(pairs[1].sum())

    @property
    def spelling(self) -> tuple:
        """Of the last sample: keys of two and of the most used three bytes, and their log10 probabilities."""
        of = self.spellings[-1]
        return of.keys[2], of.three, of.log[2], of.log3

    @property
    def tokens(self) -> DataFrame:
        def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.column("data").to_pylist():
                    now = State.of(row)
                    logp = np.log10(np.maximum(np.stack(now.p, 1).astype(float), 1e-300))
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(now.h) + 1, dtype=np.int32) * logp.shape[1]), pa.array(logp.ravel()))
                    yield pa.RecordBatch.from_arrays([pa.array(now.h.view(np.int64)), pa.array(now.c.astype(np.int64)), lists], ["h", "c", "logp"])

        return self.state.mapInArrow(unpacked, "h long, c long, logp array<double>")

    @property
    def contexts(self) -> DataFrame:
        over, frequent = self.over, self.frequent

        def unpacked(rows: pa.Table) -> pa.Table:
            now = Rooms.of(_parsed(rows))
            each = now.backoffs(over, frequent)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(now.u) + 1, dtype=np.int32) * each.shape[1]), pa.array(each.ravel()))
            return pa.table({"u": pa.array(now.u.view(np.int64)), "backoff": lists})

        return self.rooms.groupBy("to").applyInArrow(unpacked, "u long, backoff array<double>").groupBy("u").agg(F.first("backoff").alias("backoff"))

    @property
    def pairs(self) -> DataFrame:
        def unpacked(rows: pa.Table) -> pa.Table:
            parts = _parsed(rows)
            now, single = Rooms.of(parts), parts["single"][0][0]
            u = np.concatenate([now.u[now.room], np.repeat(now.u, now.once)])
            w = np.concatenate([now.words[now.place], single])
            return pa.table({"u": u.view(np.int64), "w": w.view(np.int64), "n": np.concatenate([now.customers, np.ones(len(single), np.int64)])})

        seen = self.rooms.groupBy("to").applyInArrow(unpacked, "u long, w long, n long")
        return seen.join(self.tokens.select(F.col("h").alias("w"), "c"), "w").select("u", "w", "n", "c")


def in_small_batches(f):
    """f(texts, ..) with few texts in an Arrow batch: a batch is in memory several times, in both processes."""

    @wraps(f)
    def run(texts: DataFrame, *args, **more):
        conf, name = texts.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
        before = conf.get(name)
        conf.set(name, str(min(int(before), BATCH) if int(before) > 0 else BATCH))
        try:
            return f(texts, *args, **more)
        finally:
            conf.set(name, before)

    return run


@in_small_batches
def fit(texts: DataFrame, seed: int = 7, contexts: int = CONTEXTS) -> Model:
    """Learns from a one-column table of texts; nulls count as empty. Without rows there is only the uniform spelling."""
    spark, rng, over = texts.sparkSession, np.random.default_rng(seed), deal(texts)
    parts = Parts(texts.mapInArrow(_gathered(over), _MESSAGE).groupBy("to").applyInArrow(_merged(over), _PART), "counts")
    counts = [pickle.loads(r["data"]) for r in parts.of("counts").collect()]  # a row a bucket
    tokens, pairs = _known(counts, "tokens"), _known(counts, "pairs")
    of_kind = lambda known, k: int(known[1][known[0] == k].sum())
    d = discount_of(of_kind(pairs, 1), of_kind(pairs, 2))
    state = Parts(parts.of("tokens").groupBy("to").cogroup(parts.of("base").groupBy("to")).applyInArrow(_begun, _PART), "state")
    parts.delete("tokens", "base")
    free(spark, over)
    of = Parent(float(tokens[1].sum()), float(tokens[1].sum()), discount_of(of_kind(tokens, 1), of_kind(tokens, 2)))

    # Customers of contexts that have several buckets; at first each of their pairs has a table.
    frequent = {"n": np.zeros(len(over.frequent), np.int64), "t": np.zeros(len(over.frequent), np.int64)}

    def wide(rows: pa.Table) -> pa.Table:
        now = Rooms.of(_parsed(rows))
        at = np.flatnonzero(over.wide(now.u) > 1)
        tables = now.once + np.bincount(now.room, minlength=len(now.u))
        return pa.Table.from_batches([_rows([(0, pack(np.searchsorted(over.frequent, now.u[at]), now.n[at], tables[at]))], _MESSAGE)])

    if len(over.frequent):
        for row in parts.of("cells").groupBy("to").applyInArrow(wide, _MESSAGE).collect():  # the frequent contexts of each bucket
            at, n, t = pickle.loads(row["data"])
            np.add.at(frequent["n"], at, n)
            np.add.at(frequent["t"], at, t)

    spelling, firsts, spellings, parents, shared = None, None, [], [], []

    def spelt(rows: DataFrame, sweep: int) -> Spelt:
        """The spelling restaurants, seated once more. Each token's first table always has the same bytes, which are summed once."""
        nonlocal spelling, firsts
        summed = lambda df: stored(df.groupBy("context", "symbol").agg(F.sum("n").alias("n")), "bytes")
        counted = lambda first: rows.mapInArrow(_bytes(first), "context long, symbol int, n long")
        sums = firsts = summed(counted(True)) if firsts is None else firsts
        if sweep:
            sums = summed(firsts.unionAll(counted(False)))
        spelling, frozen = spelling_sample(sums, spelling, contexts, sweep, rng)
        return frozen

    def respelled(old: Parts, frozen: Spelt, of: Parent | None) -> Parts:
        rows, needed = _respelled(old.of("state"), frozen, of)
        new = Parts(rows, "spelled")
        needed.destroy()
        old.delete()
        return new

    def parent(rows: DataFrame) -> Parent:
        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.column("data").to_pylist():
                    now = State.of(row)
                    yield pa.RecordBatch.from_arrays([pa.array([int(x)]) for x in (now.customers.sum(), now.t.sum(), (now.customers == 1).sum(), (now.customers == 2).sum())], ["n", "t", "one", "two"])

        r = rows.mapInArrow(sums, "n long, t long, one long, two long").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "t", "one", "two"))).first()
        return Parent(float(r["n"]), float(r["t"]), discount_of(r["one"], r["two"]))

    state = respelled(state, spelt(state.of("state"), 0), None)
    seats, up = None, parts.of("up")
    for sweep in range(SWEEPS):
        kept = sweep >= BURN_IN
        old, state = state, Parts(state.of("state").groupBy("to").cogroup(up.groupBy("to")).applyInArrow(_parents_seated(of, sweep), _PART), "parents")
        old.delete()
        of = parent(state.of("state"))
        rooms = parts.of("cells") if seats is None else parts.of("cells").unionByName(seats.of("seats"))
        new = Parts(rooms.groupBy("to").cogroup(state.of("reply").groupBy("to")).applyInArrow(_contexts_seated(over, of, d, sweep, kept, frequent), _PART), "seats")
        if seats is not None:
            seats.delete()
        else:
            parts.delete("up")
        seats, up = new, new.of("up")
        if len(over.frequent):
            frequent = frequent | {"t": np.zeros(len(over.frequent), np.int64)}
            for row in seats.of("frequent").collect():
                np.add.at(frequent["t"], *pickle.loads(row["data"]))
        frozen = spelt(state.of("state"), sweep + 1)
        state = respelled(state, frozen, of if kept else None)
        free(spark, over)
        if kept:
            spellings.append(frozen)
            parents.append(of)
            shared.append((THETA + d * frequent["t"]) / (THETA + frequent["n"]))
    rooms = parts.of("cells", "single").unionByName(seats.of("seats"))
    return Model(over, rooms, state.of("state"), spellings, parents, d, np.stack(shared, 1), tokens, pairs)


def _least(known: tuple[np.ndarray, np.ndarray], most: int) -> int:
    """The count above which `most` tokens or pairs occur, or fewer."""
    above = np.cumsum(known[1][::-1])[::-1]
    at = np.flatnonzero(above > most)
    return int(known[0][at[-1]]) if len(at) else 0


def _looked_up(known: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, whether it is there) of each asked value in sorted ones."""
    if not len(known):
        return np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    return at, known[at] == asked


class Hashes:
    """Sorted hashes that are looked up in any order: the first bits say where to look, so a look-up reads two or three places of memory."""

    def __init__(self, known: np.ndarray):
        self.known, self.bits = known, max(1, len(known).bit_length())
        borders = np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)
        self.starts = np.searchsorted(known, borders).astype(np.int32)

    def __call__(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, whether it is there) of each."""
        if not len(self.known):
            return np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
        last = len(self.known) - 1
        at = np.minimum(self.starts[(asked >> np.uint64(64 - self.bits)).astype(np.int64)], last)
        found = self.known[at]
        on = np.flatnonzero((found < asked) & (at < last))
        while len(on):
            at[on] += 1
            found[on] = self.known[at[on]]
            on = on[(found[on] < asked[on]) & (at[on] < last)]
        return at, found == asked


@dataclass(frozen=True)
class Head:
    """The most frequent tokens: hash, count, samples of P(token); the most frequent pairs: key, mean of their own part, samples of the context's backoff."""

    h: np.ndarray
    c: np.ndarray
    p: np.ndarray
    key: np.ndarray
    own: np.ndarray
    backoff: np.ndarray


def head_of(model: Model, most: int) -> Head:
    """Twice `most` tokens and `most` pairs at most, of any model."""
    least_token, least_pair, samples = _least(model.token_counts, 2 * most), _least(model.pair_counts, most), len(model.parents)
    d, over, frequent = model.d, model.over, model.frequent

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.column("data").to_pylist():
                now = State.of(row)
                at = np.flatnonzero(now.c > least_token)
                yield _rows([(0, pack(now.h[at], now.c[at].astype(np.int64), np.stack(now.p, 1)[at]))], _MESSAGE)

    def pairs(rows: pa.Table) -> pa.Table:
        now = Rooms.of(_parsed(rows))
        at = np.flatnonzero(now.customers > max(least_pair, 1))
        room, own = now.room[at], now.own(d)[at]
        return pa.Table.from_batches([_rows([(0, pack(_pair(now.u[room], now.words[now.place[at]]), own.astype(np.float32), now.backoffs(over, frequent)[room].astype(np.float32)))], _MESSAGE)])

    def joined(rows: DataFrame, kinds: tuple, width: tuple) -> tuple:
        got = [pickle.loads(r["data"]) for r in rows.collect()]
        empty = tuple(np.zeros((0, samples) if w else 0, k) for k, w in zip(kinds, width, strict=True))
        parts = [np.concatenate(x) for x in zip(empty, *got, strict=True)]
        order = np.argsort(parts[0])
        return tuple(x[order] for x in parts)

    t = joined(model.state.mapInArrow(tokens, _MESSAGE), (np.uint64, np.int64, np.float32), (0, 0, 1))
    q = joined(model.rooms.where("kind <> 'single'").groupBy("to").applyInArrow(pairs, _MESSAGE), (np.uint64, np.float32, np.float32), (0, 0, 1))
    return Head(t[0], small(t[1]), t[2], *q)


@in_small_batches
def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", head: int = HEAD) -> DataFrame:
    """One row for each row of docs, with its columns but the text, and n_tokens, n_known, base_score, score.

    base_score: sum of log10((c + 1) / (n + v + 1)) over the tokens; score: the model's log10 probability of the text.
    A null or empty text is one end token. Repeated rows and null ids are scored like any other. head: tokens and pairs
    that are broadcast (twice as many tokens), which changes no score.
    """
    over, samples, d, frequent = model.over, len(model.parents), model.d, model.frequent
    shared = docs.sparkSession.sparkContext.broadcast(head_of(model, head))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = shared.value
        pairs = Hashes(top.key)
        asked: list[tuple] = []
        words: list[tuple] = []
        group = None  # texts whose requests are sent together

        def messages() -> Iterator[tuple]:
            u, w, place, doc, times = (np.concatenate(x) for x in zip(*asked, strict=True))
            order, cuts = over.sorted(u, w)
            for b in range(over.n):
                for known in (True, False):  # tokens of the head by their place there, others by their hash
                    at = order[cuts[b] : cuts[b + 1]]
                    at = at[(place[at] >= 0) == known]
                    if len(at):
                        new = np.flatnonzero(np.concatenate([[True], np.diff(u[at]) != 0]))
                        numbers, local = np.unique(doc[at], return_inverse=True)
                        yield b, pack(group, known, u[at][new], small(np.diff(np.append(new, len(at)))), small(place[at]) if known else w[at], numbers, small(local), small(times[at]))
            h, lengths, starts, data = (np.concatenate(x) for x in zip(*((h, n, np.cumsum(n) - n + before, x) for (h, n, x), before in zip(words, np.cumsum([0, *(len(x) for _, _, x in words)]), strict=False)), strict=True))
            h, first = np.unique(h, return_index=True)
            lengths, starts, bucket = lengths[first], starts[first], over.token(h)
            for b in np.unique(bucket):
                at = np.flatnonzero(bucket == b)
                yield over.n + int(b), pack(h[at], small(lengths[at]), ragged(data, starts[at], lengths[at]))
            asked.clear()
            words.clear()

        def sent(schema: pa.Schema) -> Iterator[pa.RecordBatch]:
            for to, data in messages():
                yield pa.RecordBatch.from_arrays([pa.array([to], pa.int32()), pa.array([data], pa.binary()), *(pa.nulls(1, schema.field(i).type) for i in range(2, 7))], schema=schema)

        schema = None
        for batch in batches:
            kinds = [("to", pa.int32()), ("data", pa.binary()), ("row", batch.schema.field(0).type), ("n_tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("logp", pa.float64())]
            schema = pa.schema(kinds)
            for block in blocks(batch.column(1), lower=True):
                row = batch.column(0).slice(block.first, block.n_docs)
                number = row.field("_n").to_numpy()
                h = block.hashes()
                seen, inverse = np.unique(np.concatenate([h, [_END, _BEGIN]]), return_inverse=True)
                w = np.append(inverse[: len(h)], np.full(block.n_docs, inverse[-2]))
                u, doc = _before(block, inverse[: len(h)], inverse[-1]), np.append(block.doc_of_word(), np.arange(block.n_docs))
                key, times = np.unique((doc * len(seen) + u) * len(seen) + w, return_counts=True)
                key, w = key // len(seen), key % len(seen)
                doc, u = key // len(seen), key % len(seen)
                place, known = _looked_up(top.h, seen)
                here = known[w]
                sums = [np.bincount(doc[here], times[here], block.n_docs), np.bincount(doc[here], times[here] * np.log10(top.c[place[w[here]]] + 1.0), block.n_docs)]
                at, found = pairs(_pair(seen[u], seen[w]))
                found &= here
                p = top.own[at[found]].astype(float) + (top.backoff[at[found]].astype(float) * top.p[place[w[found]]]).mean(1) if found.any() else np.zeros(0)
                logp = np.bincount(doc[found], times[found] * np.log10(np.maximum(p, 1e-300)), block.n_docs).astype(float)
                rest = np.flatnonzero(~found)
                asked.append((seen[u[rest]], seen[w[rest]], np.where(here[rest], place[w[rest]], -1), number[doc[rest]], times[rest]))
                new = np.flatnonzero(~known[inverse[: len(h)]])
                h_new, first = np.unique(h[new], return_index=True)
                first = new[first]
                size = block.ends[first] - block.starts[first]
                ends = np.array([_END]) if not known[inverse[-2]] else np.zeros(0, np.uint64)
                words.append((np.append(h_new, ends), np.append(size, np.zeros(len(ends), np.int64)), ragged(block.data, block.starts[first], size)))
                group = 2 * over.n + int(mix(number[:1].astype(np.uint64))[0] % np.uint64(1 << 24)) if group is None else group
                yield pa.RecordBatch.from_arrays([pa.array(np.full(block.n_docs, group, np.int32)), pa.nulls(block.n_docs, pa.binary()), row, pa.array(block.n_words() + 1), pa.array(sums[0].astype(np.int64)), pa.array(sums[1].astype(float)), pa.array(logp)], schema=schema)
                if sum(len(x[0]) for x in asked) > SENT:
                    yield from sent(schema)
                    group = None
        if asked:
            yield from sent(schema)

    names = [c for c in docs.columns if c != text]
    number = lambda r: F.monotonically_increasing_id() + F.lit(r << 60)
    numbered = [docs.where(F.pmod(F.xxhash64(text), F.lit(ROUNDS)) == r).select(F.struct(number(r).alias("_n"), *names).alias("row"), F.col(text)) for r in range(ROUNDS)]
    inner = numbered[0].schema["row"].dataType.simpleString()
    kinds = {"n_tokens": pa.int64(), "known": pa.int64(), "base": pa.float64(), "logp": pa.float64(), "n": pa.int64(), "w": pa.int64(), "c": pa.int64(), "times": pa.int64(), "own": pa.float64(), "b": pa.list_(pa.float64()), "word": pa.binary(), "to": pa.int32(), "data": pa.binary()}
    outer = f"kind string, row {inner}, n_tokens long, known long, base double, logp double, n long, w long, c long, times long, own double, b array<double>, word binary, to int, data binary"

    def answered(left: pa.Table, right: pa.Table) -> pa.Table:
        top = shared.value
        row_type = left.schema.field("row").type

        def rows(kind: str, size: int, **columns) -> pa.Table:
            every = {"kind": pa.array([kind] * size, pa.string()), "row": columns.get("row", pa.nulls(size, row_type))}
            for name, of in kinds.items():
                x = columns.get(name)
                every[name] = pa.nulls(size, of) if x is None else x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, of)
            return pa.table(every)

        def lists(x: np.ndarray) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * samples), pa.array(x.astype(float).ravel()))

        if not left.num_rows:
            return rows("none", 0)
        to = left.column("to")[0].as_py()
        if to >= 2 * over.n:
            return rows("doc", left.num_rows, **{c: left.column(c) for c in ("row", "n_tokens", "known", "base", "logp", "to")})
        got = [pickle.loads(x) for x in left.column("data").to_pylist()]
        if to >= over.n:
            h, lengths = (np.concatenate([g[i] for g in got]).astype(kind) for i, kind in ((0, np.uint64), (1, np.int64)))
            data, starts = np.concatenate([g[2] for g in got]), np.cumsum(lengths) - lengths
            h, first = np.unique(h, return_index=True)
            starts, lengths = starts[first], lengths[first]
            out, known = [], np.zeros(len(h), bool)
            if right.num_rows:
                now = State.of(right.column("data")[0].as_py())
                at, known = _looked_up(now.h, h)
                out.append(rows("word", int(known.sum()), w=h[known].view(np.int64), c=now.c[at[known]].astype(np.int64), b=lists(np.stack(now.p, 1)[at[known]])))
            new = [data[a : a + n].tobytes() for a, n in zip(starts[~known], lengths[~known], strict=True)]
            return pa.concat_tables([*out, rows("new", len(new), w=h[~known].view(np.int64), word=pa.array(new, pa.binary()))])
        parts = _parsed(right)
        if "cells" in parts:
            now, single = Rooms.of(parts), parts["single"][0][0]
            alone = np.repeat(np.arange(len(now.u)), now.once)
            key = np.concatenate([_pair(now.u[now.room], now.words[now.place]), _pair(now.u[alone], single)])
            own = np.concatenate([now.own(d), (1 - d) / (THETA + now.everywhere[alone])])
            order = np.argsort(key)
            key, own, contexts, backoff = key[order], own[order], now.u, np.vstack([now.backoffs(over, frequent), np.ones((1, samples))])
        else:
            key, own, contexts, backoff = np.zeros(0, np.uint64), np.zeros(0), np.zeros(0, np.uint64), np.ones((1, samples))
        cells, out = Hashes(key), []
        for group, known, u, runs, which, numbers, local, times in got:
            local, times, runs = (x.astype(np.int64) for x in (local, times, runs))
            at, has = _looked_up(contexts, u)
            b = backoff[np.repeat(np.where(has, at, len(contexts)), runs)]
            w = top.h[which] if known else which
            at, has = cells(_pair(np.repeat(u, runs), w))
            mine = np.where(has, own[at], 0.0) if len(own) else np.zeros(len(w))
            if known:
                p = times * np.log10(np.maximum(mine + (b * top.p[which]).mean(1), 1e-300))
                out.append(rows("sum", 1, to=[group], data=[pack(numbers, np.bincount(local, p, len(numbers)).astype(float))]))
            else:
                out.append(rows("rare", len(w), n=numbers[local], w=w.view(np.int64), times=times, own=mine, b=lists(b)))
        return pa.concat_tables(out)

    model_rows = model.rooms.unionByName(model.state.select("kind", (F.col("to") + over.n).cast("int").alias("to"), "data"))
    found = None
    for part in numbered:
        free(docs.sparkSession, over)
        asked = part.mapInArrow(work, f"to int, data binary, row {inner}, n_tokens long, known long, base double, logp double")
        told = stored(asked.groupBy("to").cogroup(model_rows.groupBy("to")).applyInArrow(answered, outer), "scored")
        found, asked = told if found is None else found.unionAll(told), None
    shared.destroy()
    new = found.where("kind = 'new'").select(F.col("w").alias("h"), "word").dropDuplicates(["h"])
    unseen = new.select("h", F.expr("cast(array() as array<double>)").alias("p"))
    for of, frozen in zip(model.parents, model.spellings, strict=True):
        unseen = unseen.join(spelled(new, frozen).select("h", "log_h"), "h").select("h", F.concat("p", F.array(of.backoff() * F.pow(F.lit(10.0), F.col("log_h")))).alias("p"))
    lexicon = found.where("kind = 'word'").select("w", "c", F.col("b").alias("p")).dropDuplicates(["w"]).unionByName(unseen.select(F.col("h").alias("w"), F.lit(0).cast("long").alias("c"), "p"))
    rare = found.where("kind = 'rare'").select("n", "w", "times", "own", "b").join(lexicon, "w")
    both = F.aggregate(F.zip_with("b", "p", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x) / samples
    rare = rare.select("n", F.when(F.col("c") > 0, F.col("times")).otherwise(0).alias("known"), (F.col("times") * F.log10(F.col("c") + 1.0)).alias("base"), (F.col("times") * F.log10(F.greatest(F.col("own") + both, F.lit(1e-300)))).alias("logp"))
    sums = rare.groupBy("n").agg(F.sum("known").alias("known2"), F.sum("base").alias("base2"), F.sum("logp").alias("logp2"))
    zero = lambda c: F.coalesce(c, F.lit(0))

    def added(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows or not answers.num_rows:
            return texts.drop_columns(["to"])
        number = texts.column("row").combine_chunks().field("_n").to_numpy()
        logp, order = texts.column("logp").to_numpy().copy(), np.argsort(number)
        for data in answers.column("data").to_pylist():
            numbers, more = pickle.loads(data)
            logp[order[np.searchsorted(number[order], numbers)]] += more
        return texts.drop_columns(["to"]).set_column(4, "logp", pa.array(logp))

    texts = found.where("kind = 'doc'").select("row", "n_tokens", "known", "base", "logp", "to")
    answers = found.where("kind = 'sum'").select("to", "data")
    whole = texts.groupBy("to").cogroup(answers.groupBy("to")).applyInArrow(added, f"row {inner}, n_tokens long, known long, base double, logp double")
    joined = whole.join(sums, F.col("row._n") == F.col("n"), "left")
    per_token = F.log10(F.lit(float(model.n + model.v + 1)))
    return joined.select(
        *(F.col(f"row.`{c}`").alias(c) for c in names), "n_tokens", (F.col("known") + zero("known2")).cast("long").alias("n_known"),
        (F.col("base") + zero("base2") - F.col("n_tokens") * per_token).alias("base_score"), (F.col("logp") + zero("logp2")).alias("score"),
    )


def held_out(doc_id: Column) -> Column:
    """Whether the id's remainder is 2; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def query(spark, sf_dir: str) -> DataFrame:
    """One row a document. Null and empty texts are one end token; repeated rows are scored alike; an empty table has no rows; further columns are ignored."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", held_out(F.col("doc_id")))
    model = fit(docs.where(~F.col("held_out")).select("text"))
    scored = score(docs, model)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"), "base_score", "score")
