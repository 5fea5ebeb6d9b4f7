"""Quality rules as a short-circuit cascade, in DataFrame functions alone.

A rule rejects a text. What each rule rejects and what it costs are estimated on a bounded sample:
the cost in steps, the characters and words that it visits, which unlike seconds are the same in
every run. The rule that rejects most per step comes first, then the one that does so among the
texts that are left, and so on. The rules go into one CASE in that order, so a text that an early
rule rejects never pays for the later ones. The verdict is the same in any order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import let, stored, table

#: Separators of words, and the characters that count as symbols.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 8


def words(text: Column) -> Column:
    """The words of a text, none for a null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), "")


def n_symbols(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SYMBOL)), F.lit(0)).cast("long")


def word_lines(text: Column) -> Column:
    """The lines with a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda line: line.rlike(WORD))


def n_repeat_words(tokens: Column, window: int = WINDOW) -> Column:
    """How many words lie in windows that occur at least twice, the first occurrence included.

    Windows are compared by a 64-bit hash within their text. Most texts have no repeated window, which a hash set
    tells at once; only the others sort theirs and walk the repeated places.
    """

    def combined(h: Column, gap: int) -> Column:
        return let(h, lambda x: F.zip_with(x, F.slice(x, gap + 1, F.greatest(F.size(x) - F.lit(gap), F.lit(0))), lambda a, b: F.xxhash64(a, b)))

    h, gap = F.transform(tokens, lambda w: F.xxhash64(w)), 1
    while gap < window:
        h, gap = combined(h, gap), gap * 2
    assert gap == window, "the window is a power of two"

    def covered(whole: Column) -> Column:
        ordered = F.array_sort(F.transform(whole, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        again = let(ordered, lambda s: F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))))
        places = F.array_sort(F.transform(again, lambda x: x["i"]))
        gaps = let(places, lambda p: F.transform(p, lambda x, k: F.least(F.coalesce(F.get(p, k + 1) - x, F.lit(window)), F.lit(window))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)

    full = F.slice(h, 1, F.greatest(F.size(tokens) - F.lit(window - 1), F.lit(0)))
    found = let(full, lambda x: F.when(F.size(F.array_distinct(x)) < F.size(x), covered(x)).otherwise(F.lit(0).cast("long")))
    return F.when(F.size(tokens) > window, found).otherwise(F.lit(0).cast("long"))


def features(text: Column) -> Column:
    """A struct of n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words. Null and empty texts have zeros."""
    lines = lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))
    counted = lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        n_repeat_words(w).alias("n_repeat_words"),
        let(word_lines(text), lines).alias("lines"),
        n_symbols(text).alias("n_symbols"),
    )
    return let(words(text), counted)


@dataclass(frozen=True)
class Read:
    """What rules ask of a text, worked out from the text and its words where it is asked."""

    text: Column
    words: Column

    def n_words(self) -> Column:
        return F.size(self.words)

    def n_symbols(self) -> Column:
        return n_symbols(self.text)

    def n_repeat_words(self) -> Column:
        return n_repeat_words(self.words)

    def with_word_chars(self, f: Callable[[Column], Column]) -> Column:
        return let(F.length(F.array_join(self.words, "")), f)

    def with_lines(self, f: Callable[[Column, Column], Column]) -> Column:
        """f(lines with a word, those of them that equal an earlier one)."""
        return let(word_lines(self.text), lambda x: f(F.size(x), F.size(x) - F.size(F.array_distinct(x))))

    def n_capitals(self) -> Column:
        return F.size(F.filter(self.words, lambda x: (F.length(x) > 1) & (F.upper(x) == x) & (F.lower(x) != x)))


@dataclass(frozen=True)
class Counted(Read):
    """The same, from features that are at hand; only what they lack is worked out."""

    features: Column

    def n_words(self) -> Column:
        return self.features["n_words"]

    def n_symbols(self) -> Column:
        return self.features["n_symbols"]

    def n_repeat_words(self) -> Column:
        return self.features["n_repeat_words"]

    def with_word_chars(self, f: Callable[[Column], Column]) -> Column:
        return f(self.features["word_chars"])

    def with_lines(self, f: Callable[[Column, Column], Column]) -> Column:
        return f(self.features["lines"]["n_lines"], self.features["lines"]["n_dup_lines"])


@dataclass(frozen=True)
class Rule:
    """reject: true for a text that the rule rejects; a null counts as false. steps: about how many characters and words it visits."""

    name: str
    reject: Callable[[Read], Column]
    steps: Callable[[Read], Column]


_CHARS = lambda x: F.coalesce(F.length(x.text), F.lit(0))

#: Fixed thresholds of the production rules. The first two are the base of the contract.
RULES = [
    Rule("few words", lambda x: x.n_words() < 20, lambda x: F.lit(1)),
    # Four rounds of hashes, a hash set, and for some texts a sort.
    Rule("repeated windows", lambda x: F.lit(100) * x.n_repeat_words() > F.lit(30) * x.n_words(), lambda x: F.lit(1) + F.lit(12) * F.size(x.words)),
    Rule("symbols", lambda x: F.lit(10) * x.n_symbols() > x.n_words(), lambda x: F.lit(1) + _CHARS(x)),
    # A cut, a pattern in each line, a set of them.
    Rule("repeated lines", lambda x: x.with_lines(lambda n, dup: F.lit(2) * (n - dup) < n), lambda x: F.lit(1) + F.lit(2) * _CHARS(x)),
    Rule("word length", lambda x: x.with_word_chars(lambda n: (F.lit(2) * n < F.lit(3) * x.n_words()) | (n > F.lit(20) * x.n_words())), lambda x: F.lit(1) + _CHARS(x) + F.size(x.words)),
    # Each word in upper and in lower case.
    Rule("capitals", lambda x: F.lit(2) * x.n_capitals() > x.n_words(), lambda x: F.lit(1) + F.lit(2) * _CHARS(x) + F.lit(3) * F.size(x.words)),
]


def measured_order(docs: DataFrame, rules: list[Rule], text: str = "text", sample_rows: int = 2000) -> list[tuple[Rule, float, float]]:
    """(rule, steps a row, share rejected) in the order of the cascade, both among the sampled rows that the rules before leave.

    One job over about sample_rows rows, each drawn with the same chance, so nothing is shuffled but sums by which rules
    reject: 2 ** rules rows at most. The order is the same whenever the sample is. Equal rules keep the given order, as do
    all without rows.
    """
    rows = docs.count()
    sample = docs.select(F.col(text).alias("text")).sample(min(1.0, sample_rows / max(rows, 1)), seed=1)
    of = lambda w: Read(F.col("text"), w)
    told = lambda w: F.struct(
        F.array(*(F.coalesce(r.reject(of(w)), F.lit(False)) for r in rules)).alias("rejects"), F.array(*(r.steps(of(w)).cast("double") for r in rules)).alias("steps")
    )
    each = sample.select(let(words(F.col("text")), told).alias("x")).select("x.*")
    sums = each.groupBy("rejects").agg(F.count("*").alias("n"), *(F.sum(F.get("steps", F.lit(i))).alias(f"s{i}") for i in range(len(rules)))).collect() if rules else []
    found, left = [], list(range(len(rules)))
    while left:
        n = max(sum(r["n"] for r in sums), 1)
        share = lambda i: sum(r["n"] for r in sums if r["rejects"][i]) / n  # noqa: E731, B023
        steps = lambda i: max(sum(r[f"s{i}"] for r in sums) / n, 1.0)  # noqa: E731, B023
        best = max(left, key=lambda i: (share(i) / steps(i), -steps(i), -i))
        found.append((rules[best], steps(best), share(best)))
        left.remove(best)
        sums = [r for r in sums if not r["rejects"][best]]
    return found


def rejected_by(text: Column, rules: list[Rule], features: Column | None = None) -> Column:
    """The name of the first rule, in the order given, that rejects the text; else null. The text is cut into words once.

    features: those of the text, if they are at hand.
    """

    def cascade(w: Column) -> Column:
        x, out = Read(text, w) if features is None else Counted(text, w, features), F.lit(None).cast("string")
        for rule in reversed(rules):
            out = F.when(F.coalesce(rule.reject(x), F.lit(False)), F.lit(rule.name)).otherwise(out)
        return out

    return let(words(text), cascade)


def keep(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text", sample_rows: int = 2000) -> DataFrame:
    """The rows that no rule rejects, all columns unchanged.

    A null text counts as empty, so it goes (few words). Repeated rows are judged alike. Neither the row order nor
    the measured order of the rules changes what is kept.
    """
    order = [x[0] for x in measured_order(docs, rules or RULES, text, sample_rows)]
    return docs.where(rejected_by(F.col(text), order).isNull())


def query(spark, sf_dir: str) -> DataFrame:
    """One row a document: the base counts, base_failed, and kept: no rule of the cascade rejects it.

    A null or empty text has counts of 0 and fails (few words). Texts of any length are counted whole; repeated rows are
    judged alike; an empty table has no rows; further columns are ignored.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    order = [x[0] for x in measured_order(docs, RULES)]
    # Counts that the contract asks for in any case are at hand; the cascade reads them in place of the text.
    counted, f = docs.select("doc_id", "text", features(F.col("text")).alias("f")), F.col("f")
    first = Counted(F.col("text"), F.lit(None), f)
    base = RULES[0].reject(first) | RULES[1].reject(first)
    judged = counted.select("doc_id", "f", base.alias("base_failed"), rejected_by(F.col("text"), order, f).isNull().alias("passed"))
    return judged.select(
        "doc_id", f["n_words"].alias("n_words"), f["word_chars"].alias("word_chars"), f["n_symbols"].alias("n_symbols"), f["lines"]["n_dup_lines"].alias("n_dup_lines"), f["n_repeat_words"].alias("n_repeat_words"),
        "base_failed", (~F.col("base_failed") & F.col("passed")).alias("kept"),
    )


ORACLE = r"""
with t as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from documents),
g as (
  select doc_id, unnest(range(1, len(w) - 6)) as i, w from t where len(w) >= 8),
g2 as (select doc_id, i, array_to_string(w[i:i + 7], ' ') as s from g),
c as (select doc_id, i, count(*) over (partition by doc_id, s) as n from g2),
r as (
  select doc_id, sum(least(8, coalesce(nxt - i, 8)))::bigint as n_repeat_words
  from (select doc_id, i, lead(i) over (partition by doc_id order by i) as nxt from c where n > 1) group by doc_id),
f as (
  select t.doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
         len(lines) as n_lines, len(list_filter(w, lambda x: length(x) > 1 and upper(x) = x and lower(x) <> x)) as n_caps
  from t left join r on t.doc_id = r.doc_id),
b as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from f)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or 10 * n_symbols > n_words or 2 * (n_lines - n_dup_lines) < n_lines or 2 * word_chars < 3 * n_words
            or word_chars > 20 * n_words or 2 * n_caps > n_words) as kept
from b
"""
