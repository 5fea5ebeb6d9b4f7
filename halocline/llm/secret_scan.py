"""Secret scan: patterns, and a randomness battery under length-aware false-discovery control.

Three patterns give the base spans. Besides, every run of 20 or more characters of the usual
encodings is a candidate. Without its separators, its encoding is the smallest alphabet that
holds it, and a battery asks how far it is from a random string of that encoding: chi-squared
uniformity over the alphabet, the number of runs of cases and digits, that of runs of vowels and
consonants, and the lag-1 serial correlation. Neighbours on either side of a separator count in
none of the last three. A string that any test tells from a random one for certain is none.

What the tests say of strings that people write is measured, not assumed: identifiers are put
together from the words of all texts, each at least once, in the usual styles and all lengths. Their means and
covariances, by family of encodings and class of lengths, weigh the dependent tests (Fisher's
discriminant against random strings), and the tail of their scores gives the p-value for "somebody
wrote this". Within each class of lengths, Benjamini-Hochberg picks the candidates that are
reported. The p-values are counted in bins of a tenth of a decade, so the control needs at most a
few hundred counts.

All of it is DataFrame functions; a text is never split into rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.quantiles import quantiles
from .shared import let, stored, table

#: The kinds in their order, with their patterns. A match of `assign` counts if group 2 has 6 characters or more; the
#: lengths of the other two are in the pattern, which finds the same spans because a failing match is a maximal run.
ASSIGN = r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "random"]
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"

#: Encodings, smallest first: characters, size, family, and how many of them are digits, lower and upper case.
ENCODINGS = [
    ("0-9a-f", 16, 2, (10, 6, 0)), ("0-9A-F", 16, 2, (10, 0, 6)), ("a-z", 26, 0, (0, 26, 0)), ("A-Z", 26, 0, (0, 0, 26)), ("A-Z2-7", 32, 2, (6, 0, 26)),
    ("a-z0-9", 36, 2, (10, 26, 0)), ("A-Z0-9", 36, 2, (10, 0, 26)), ("A-Za-z", 52, 1, (0, 26, 26)), ("A-Za-z0-9", 62, 3, (10, 26, 26)),
]
TESTS = ("chi", "runs", "vowels", "serial")
CERTAIN = (6.0, 4.0, 4.0, 4.0)  #: z-scores beyond which a string is not random
SEPARATORS = r"[+/_=-]"
NEIGHBOURS, LETTER_PAIRS = r"[A-Za-z0-9](?=[A-Za-z0-9])", r"[A-Za-z](?=[A-Za-z])"
CLASS_CHANGES = r"[a-z](?=[A-Z0-9])|[A-Z](?=[a-z0-9])|[0-9](?=[A-Za-z])"
VOWEL_CHANGES = r"[aeiouAEIOU](?=[a-zA-Z&&[^aeiouAEIOU]])|[a-zA-Z&&[^aeiouAEIOU]](?=[aeiouAEIOU])"
FAMILIES = 4  #: letters of one case, of both; letters of one case and digits, of both
FDR = 0.01
LENGTHS = [24, 32, 48]  #: borders of the classes of lengths
LONGEST = 96  #: of the written strings that are made
LEAST = 16  #: characters without separators that a candidate has at least
TAIL = 0.01  #: the share of written strings whose scores give the tail
BINS = 300  #: of a tenth of a decade
WRITTEN = 1500  #: made strings for each family and class of lengths, at least
WORD = r"(?<![^\x20\x09-\x0D])[A-Za-z]{2,14}(?![^\x20\x09-\x0D,.;:!?])"
BUCKETS = 1024  #: over which the texts' words are dealt

#: Words for strings that people write, besides those of the texts.
COMMON = (
    "able about account action address after again all also always amount and another answer any area array back base before begin between block body book both box build call case cause change check child city class "
    "clear close code color column come common copy count create current data date day default delete do down each early edit end error even event every example fact false field file find first follow force form from full "
    "get give good great group half hand handle have head help here high hold home hour idea image index input inside into item job just keep key kind know land large last late lead learn leave left length less letter level "
    "life light line list little load long look low main make many map mark match mean menu message middle minute mode money month more most move much must name near need never new next night no note null number object offer "
    "often old only open option order other out over own page paper part path people place plan play point port present print problem process program public question queue range rate read real record result return right room "
    "rule run same save school second section see select send service session set short show side size small some sort source space stand start state step still stop string study such system table take task test text than "
    "that then there thing think this thread three time title today token total true try turn type under unit until update upper use user value version very view visit wait walk want water way week well what when where which while "
    "white who whole why width window with without woman word work world write year yes young zone"
).split()

_SPANS = "array<struct<s:int,rank:int,e:int>>"


def _none() -> Column:
    return F.expr(f"cast(array() as {_SPANS})")


def _found(text: Column, pattern: str, rank: int, group: int = 0, least: int = 0) -> Column:
    """The spans of all matches, whose given group has `least` characters. Pieces between matches tell where those are."""

    def placed(pieces: Column, found: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), _none().alias("out"))

        def step(acc: Column, x: Column) -> Column:
            s = acc["at"] + x["p"]
            span = F.struct(s.alias("s"), F.lit(rank).alias("rank"), (s + x["m"]).alias("e"))
            return F.struct((s + x["m"]).alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

        pairs = F.zip_with(F.slice(pieces, 1, F.size(found)), found, lambda p, m: F.struct(F.length(p).alias("p"), F.length(m).alias("m")))
        return F.aggregate(pairs, start, step, lambda acc: acc["out"])

    pat = F.lit(pattern)
    spans = let(F.split(text, pattern, -1), lambda pieces: let(F.regexp_extract_all(text, pat, F.lit(0)), lambda found: placed(pieces, found)))
    if least:
        spans = let(F.regexp_extract_all(text, pat, F.lit(group)), lambda g: F.filter(spans, lambda x, i: F.length(F.get(g, i)) >= least))
    return F.when(text.rlike(pattern), spans).otherwise(_none())


def base_spans(text: Column) -> Column:
    """Spans (s, rank, e) of the three patterns by start, then kind; code points, end exclusive. None for null texts."""
    t = F.coalesce(text, F.lit(""))
    access = F.when(F.contains(t, F.lit("AKIA")), _found(t, ACCESS, 1)).otherwise(_none())
    return F.array_sort(F.concat(_found(t, ASSIGN, 0, 2, 6), access, _found(t, HEX, 2)))


def length_class(token: Column) -> Column:
    return sum((F.when(F.length(token) >= b, 1).otherwise(0) for b in LENGTHS), F.lit(0)).cast("int")


def tests(token: Column) -> Column:
    """A struct of cell, chi, runs, vowels, serial: the family and class of lengths, and z-scores that are near standard normal for random strings.

    Null for numbers and for strings with too few characters without separators.
    """
    return let(token, lambda t: let(F.regexp_replace(t, SEPARATORS, ""), lambda plain: _tests(t, plain)))


def _tests(token: Column, plain: Column) -> Column:
    n = F.length(plain).cast("double")
    number = F.lit(None).cast("int")
    for i, (cls, *_) in reversed(list(enumerate(ENCODINGS))):
        number = F.when(plain.rlike(rf"\A[{cls}]+\z"), i).otherwise(number)
    number = F.when(plain.rlike(r"\A[0-9]+\z") | (n < LEAST), F.lit(None)).otherwise(number)

    def of(which: Column) -> Column:
        pick = lambda f: F.get(F.array(*(F.lit(f(e)) for e in ENCODINGS)), which)
        size, family = pick(lambda e: float(e[1])), pick(lambda e: e[2])
        change = pick(lambda e: 1 - sum((x / e[1]) ** 2 for x in e[3]))  # how often neighbours in a random string are of two classes
        # Of the letters of a random string, how many are vowels: two of the six of hexadecimal digits, else five of 26.
        vowel_change = F.when(size == 16, 2 * (2 / 6) * (4 / 6)).otherwise(2 * (5 / 26) * (21 / 26))
        z = lambda k, n_pairs, p: F.when((n_pairs > 0) & (p > 0), (k - n_pairs * p) / F.sqrt(n_pairs * p * (1.0 - p))).otherwise(F.lit(0.0))
        # Neighbours are counted by patterns over the whole string; a separator stands between the others.
        counts = F.array(*(F.regexp_count(token, F.lit(p)).cast("double") for p in (NEIGHBOURS, CLASS_CHANGES, LETTER_PAIRS, VOWEL_CHANGES)))
        once = F.filter(F.array_distinct(F.split(plain, "", -1)), lambda c: c != "")
        squares = F.aggregate(once, F.lit(0.0), lambda t, d: t + F.pow(n - F.length(F.replace(plain, d, F.lit(""))).cast("double"), F.lit(2.0)))
        chi = (size * squares / n - n - (size - 1.0)) / F.sqrt(2.0 * (size - 1.0))
        # Serial correlation on character codes, 32 for separators.
        codes = F.transform(F.filter(F.split(F.translate(token, "+/_=-", " " * 5), "", -1), lambda c: c != ""), lambda c: F.ascii(c).cast("double"))
        total = lambda v, f: F.aggregate(v, F.lit(0.0), lambda t, y: t + f(y))

        def serial(x: Column, m: Column) -> Column:
            def around(real: Column, mu: Column) -> Column:
                own = total(real, lambda y: (y - mu) * (y - mu)) / n
                products = F.zip_with(F.slice(x, 1, F.size(x) - 1), F.slice(x, 2, F.size(x) - 1), lambda a, b: F.when((a != 32) & (b != 32), (a - mu) * (b - mu)).otherwise(F.lit(0.0)))
                return let(own, lambda o: F.when(o > 0, total(products, lambda y: y) / m / o).otherwise(F.lit(1.0)))

            return let(F.filter(x, lambda c: c != 32), lambda real: let(total(real, lambda y: y) / n, lambda mu: around(real, mu)))

        def with_counts(k: Column) -> Column:
            m = F.greatest(k[0], F.lit(1.0))
            return F.struct(
                (family * (len(LENGTHS) + 1) + length_class(token)).cast("int").alias("cell"), chi.alias("chi"), z(k[1], m, change).alias("runs"),
                z(k[3], k[2], vowel_change).alias("vowels"), (let(codes, lambda x: serial(x, m)) * F.sqrt(m)).alias("serial"),
            )

        return let(counts, with_counts)

    return let(number, lambda which: F.when(which.isNotNull(), of(which)))


@dataclass(frozen=True)
class Written:
    """What strings that people write look like, by cell: weights of the tests, and where and how steeply the tail of their scores falls."""

    weights: list[tuple[float, ...]]
    border: list[float]
    slope: list[float]

    def score(self, t: Column) -> Column:
        pick = lambda i: F.get(F.array(*(F.lit(float(w[i])) for w in self.weights)), t["cell"])
        return sum((pick(i) * F.abs(t[name]) for i, name in enumerate(TESTS)), F.lit(0.0))

    def bin(self, t: Column) -> Column:
        """Tenths of a decade of the p-value, rounded down: 0 up to the tail, which falls exponentially."""
        pick = lambda values: F.get(F.array(*(F.lit(float(v)) for v in values)), t["cell"])
        over = self.score(t) - pick(self.border)
        decades = F.lit(-math.log10(TAIL)) + over / pick(self.slope) / F.lit(math.log(10))
        certain = reduce(lambda a, b: a | b, (F.abs(t[name]) > limit for name, limit in zip(TESTS, CERTAIN, strict=True)))
        return F.when(t.isNull() | (over <= 0) | certain, F.lit(0)).otherwise(F.least(F.floor(decades * 10.0).cast("int"), F.lit(BINS)))


def written_strings(docs: DataFrame, text: str = "text", each: int = WRITTEN) -> DataFrame:
    """(token, common): made identifiers, about `each` or more for every family and class of lengths.

    Some are of common words, drawn by hash. In the others every word of every text has a part, whole: the distinct words (2 to
    14 ASCII letters between spaces, a punctuation mark may follow) are dealt over buckets, each of one family and length,
    and a bucket's words, in the order of a hash, are put together until that length is reached. Where the texts have few
    words this is repeated in other orders; where they have many there are more strings. Copies of texts count once.
    """
    spark, borders, classes = docs.sparkSession, [20, *LENGTHS, LONGEST], len(LENGTHS) + 1
    cells, middle = FAMILIES * classes, (sum(borders) - (borders[0] + borders[-1]) / 2) / classes
    found = docs.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0))).alias("w")).select(F.lower("w").alias("w"))
    words = stored(found.distinct(), "vocabulary")
    letters = words.agg(F.sum(F.length("w"))).first()[0] or 0
    rounds = math.ceil(cells * each / 2 * middle / max(letters, 1))
    draw = lambda salt, below, *more: F.pmod(F.xxhash64("id", *more, F.lit(salt)), F.lit(below))
    of = F.col("cell") % classes
    low, high = (F.element_at(F.array(*(F.lit(b) for b in side)), (of + 1).cast("int")) for side in (borders[:-1], borders[1:]))
    aimed = lambda df: df.withColumn("aim", (low + draw(9, 1 << 30) % (high - low)).cast("int"))
    # Whose letters before a word are as many times the length belong together. A bucket's words are a thousandth of all.
    dealt = words.select("w", F.explode(F.sequence(F.lit(1), F.lit(rounds))).alias("r")).withColumn("id", F.pmod(F.xxhash64("w", "r"), F.lit(BUCKETS)))
    dealt = aimed(dealt.withColumn("cell", (F.col("id") % cells).cast("int")))
    order = Window.partitionBy("id").orderBy("r", F.xxhash64("r", "w"), "w").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    dealt = dealt.withColumn("at", F.sum(F.length("w")).over(order) - F.length("w")).withColumn("nth", F.floor(F.col("at") / F.col("aim")))
    own = dealt.groupBy("id", "nth", "cell", "aim").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "w"))), lambda x: x["w"]).alias("w"))
    own = own.select(F.xxhash64("id", "nth").alias("id"), "cell", "aim", "w", F.lit(False).alias("common"))
    ids = spark.range(cells * (each // 2 if letters else each)).withColumn("cell", (F.col("id") % cells).cast("int"))
    every = own.unionByName(aimed(ids).withColumns({"w": F.expr("cast(array() as array<string>)"), "common": F.lit(True)}))
    # Common words fill up what is short of the length; what is over is cut, but not of the texts' words.
    short = F.col("aim") - F.length(F.array_join("w", ""))  # words have two letters at least
    more = F.when(short > 0, F.transform(F.sequence(F.lit(1), F.ceil(short / 2)), lambda k: F.get(F.array(*(F.lit(w) for w in COMMON)), draw(1, len(COMMON), k).cast("int")))).otherwise(F.expr("cast(array() as array<string>)"))
    drawn = every.select("id", "cell", "aim", "common", F.size("w").alias("n_own"), F.concat("w", more).alias("w"))
    family = F.floor(F.col("cell") / classes)
    joint = F.element_at(F.array(*(F.lit(x) for x in ("", "_", "-", "/"))), (draw(2, 4) + 1).cast("int"))
    style = draw(3, 3)
    title = lambda x: F.initcap(x)
    cased = F.when(family.isin(0, 2), F.when(style == 0, F.transform("w", F.upper)).otherwise(F.col("w"))).otherwise(F.transform("w", lambda x, k: F.when((style > 0) | (k > 0), title(x)).otherwise(x)))
    # Numbers of one to four digits after some words, one of the first three always.
    numbered = F.transform(cased, lambda x, k: F.when((k == draw(4, 3)) | (draw(5, 6, k) == 0), F.concat(x, draw(6, 10, k).cast("string"), F.when(draw(7, 2, k) == 0, draw(8, 1000, k).cast("string")).otherwise(F.lit("")))).otherwise(x))
    whole = F.transform(F.when(family >= 2, numbered).otherwise(cased), lambda x: F.concat(x, joint))
    styled = drawn.select("aim", "common", "n_own", F.length(joint).alias("gap"), whole.alias("w"))
    length = F.greatest("aim", F.length(F.array_join(F.slice("w", F.lit(1), F.col("n_own")), "")) - F.col("gap"))
    return styled.select(F.substring(F.array_join("w", ""), F.lit(1), length).alias("token"), "common")


def calibrate(docs: DataFrame, text: str = "text") -> Written:
    """Measures written strings. Without texts the common words alone make them."""
    made = stored(written_strings(docs, text).select(tests(F.col("token")).alias("t"), "common").where("t is not null").select("t.*", "common"), "written")
    names, cells = TESTS, FAMILIES * (len(LENGTHS) + 1)
    # However many words the texts have, the strings of common ones count as much as the others: each several times.
    counts = {(r["cell"], r["common"]): r["count"] for r in made.groupBy("cell", "common").count().collect()}
    times = F.array(*(F.lit(max(1, round(counts.get((c, False), 0) / counts.get((c, True), 1)))) for c in range(cells)))
    made = made.withColumn("_", F.explode(F.array_repeat(F.lit(1), F.when(F.col("common"), F.get(times, F.col("cell"))).otherwise(1)))).drop("_")
    # Two-sided: a string that is more even than chance would make it is as far from random as one that is less.
    far = made.select("cell", *(F.abs(a).alias(a) for a in names))
    products = [F.avg(F.col(a) * F.col(b)).alias(f"{a}_{b}") for i, a in enumerate(names) for b in names[i:]]
    rows = {r["cell"]: r for r in far.groupBy("cell").agg(*(F.avg(a).alias(a) for a in names), *products).collect()}
    random_mean, random_var = math.sqrt(2 / math.pi), 1 - 2 / math.pi  # of a standard normal's absolute value
    weights = [(0.0,) * len(names)] * cells
    for cell, r in rows.items():
        mean = [r[a] for a in names]
        both = [[r[f"{names[min(i, j)]}_{names[max(i, j)]}"] - mean[i] * mean[j] + random_var * (i == j) for j in range(len(names))] for i in range(len(names))]
        # Being far from random in a test is never held to speak for a random string.
        weights[cell] = tuple(min(x, 0.0) for x in _solved(both, [random_mean - m for m in mean]))
    scored = made.withColumn("s", Written(weights, [], []).score(F.struct("cell", *names)))
    border = {r["cell"]: r["border"] for r in quantiles(scored, "cell", "s", {"border": 1 - TAIL}, lambda df: stored(df, "tail")).collect()}
    edges = [float(border.get(c, 0.0)) for c in range(cells)]
    over = F.col("s") - F.get(F.array(*(F.lit(x) for x in edges)), F.col("cell"))
    slope = dict(scored.withColumn("o", over).where("o > 0").groupBy("cell").agg(F.avg("o")).collect())
    return Written(weights, edges, [max(float(slope.get(c, 0.0)), 1e-9) for c in range(cells)])


def _solved(m: list[list[float]], v: list[float]) -> list[float]:
    """x of m x = v for a positive definite m, by elimination."""
    rows, n = [[*r, y] for r, y in zip(m, v, strict=True)], len(v)
    for i in range(n):
        rows[i] = [x / rows[i][i] for x in rows[i]]
        rows = [r if k == i else [x - r[i] * y for x, y in zip(r, rows[i], strict=True)] for k, r in enumerate(rows)]
    return [r[-1] for r in rows]


def candidates(text: Column, base: Column, written: Written) -> Column:
    """Structs (s, rank, e, length_class, bin) of the candidates that overlap no base span."""
    t = F.coalesce(text, F.lit(""))
    free = F.filter(_found(t, CANDIDATE, 3), lambda c: ~F.exists(base, lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"])))

    def judged(c: Column) -> Column:
        token = F.regexp_replace(F.substring(t, c["s"] + F.lit(1), c["e"] - c["s"]), "=+$", "")
        return F.struct(c["s"].alias("s"), c["rank"].alias("rank"), c["e"].alias("e"), length_class(token).alias("length_class"), let(tests(token), written.bin).alias("bin"))

    return F.transform(free, judged)


def thresholds(scanned: DataFrame, q: float = FDR) -> dict[int, int]:
    """For each class of lengths the least bin that Benjamini-Hochberg reports. scanned has a column `found` of candidates."""
    counts = scanned.select(F.explode("found").alias("c")).groupBy(F.col("c.length_class").alias("l"), F.col("c.bin").alias("b")).count().collect()
    out = {}
    for cls in {r["l"] for r in counts}:
        bins = sorted(((r["b"], r["count"]) for r in counts if r["l"] == cls), reverse=True)
        total, above = sum(n for _, n in bins), 0
        for b, n in bins:
            above += n
            if b > 0 and 10 ** (-b / 10) <= q * above / total:
                out[cls] = b
    return out


def reported(found: Column, least: dict[int, int]) -> Column:
    """The candidates at or above their class's bin, as spans."""
    ok = lambda c: F.coalesce(F.create_map(*(F.lit(x) for kv in least.items() for x in kv))[c["length_class"]] <= c["bin"], F.lit(False)) if least else F.lit(False)
    return F.transform(F.filter(found, ok), lambda c: F.struct(c["s"].alias("s"), c["rank"].alias("rank"), c["e"].alias("e")))


def joined(spans: Column) -> Column:
    """kind:start:end by start, then kind, joined by commas."""
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.get(kinds, x["rank"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with `base` and `found`. Null and empty texts have neither; rows are never added or lost."""
    written = calibrate(docs, text)
    with_base = docs.withColumn("base", base_spans(F.col(text)))
    return with_base.withColumn("found", candidates(F.col(text), F.col("base"), written))


def redact(docs: DataFrame, text: str = "text", mark: str = "<secret>") -> DataFrame:
    """docs with every span replaced by the mark, spans that touch or overlap by one; a null text stays null.

    The false-discovery control covers all of docs. Other columns, repeated rows and the row order of ties play no part.
    Each text is scanned once: docs are stored with their spans.
    """
    names = docs.columns
    row = F.struct(*(F.col(f"`{c}`") for c in names))
    scanned = stored(scan(docs.select(row.alias("row"), F.col(text).alias("_text")), "_text").select("row", "base", "found"), "scanned")
    least = thresholds(scanned)
    docs = scanned.select("row.*", F.col("base").alias("_base"), F.col("found").alias("_found"))
    t = F.col(text)

    def cut(spans: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out"))

        def step(acc: Column, x: Column) -> Column:
            fresh = F.concat(acc["out"], F.array(F.substring(t, acc["at"] + F.lit(1), x["s"] - acc["at"]), F.lit(mark)))
            return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), F.when((x["s"] > acc["at"]) | (F.size(acc["out"]) == 0), fresh).otherwise(acc["out"]).alias("out"))

        done = F.aggregate(spans, start, step)
        return let(done, lambda acc: F.array_join(F.concat(acc["out"], F.array(F.substring(t, acc["at"] + F.lit(1), F.length(t)))), ""))

    spans = F.array_sort(F.concat("_base", reported(F.col("_found"), least)))
    clean = let(spans, lambda x: F.when(F.size(x) > 0, cut(x)).otherwise(t))
    return docs.withColumn(text, F.when(t.isNull(), t).otherwise(clean)).select(names)


def query(spark, sf_dir: str) -> DataFrame:
    """One row a document: the counts and digest of the base spans, and all spans.

    A null or empty text has no spans: counts of 0, the digest of nothing, and an empty string. Texts of any length are
    scanned whole; repeated rows are judged alike, each by itself, and ties of p-values together. An empty table has no
    rows. Further columns are ignored.
    """
    scanned = stored(scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "base", "found"), "secrets")
    least = thresholds(scanned)
    n = lambda rank: F.size(F.filter("base", lambda x: x["rank"] == rank)).cast("long")
    return scanned.select(
        "doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.concat("base", reported(F.col("found"), least))).alias("spans"),
    )
