"""Benchmark decontamination by templates.

A text becomes a sequence of tokens: words without the punctuation around them, A-Z in lower
case, where numbers, names and units are replaced by a placeholder of their type. A number's
placeholder keeps the operators inside it, and punctuation that stands alone between two numbers
is a token of its own, so arithmetic keeps its form. Windows of 13 tokens are hashed and joined to
the windows of the benchmark items, so an item whose numbers or names were exchanged still
matches. A capital at the start of a sentence may or may not be that of a name: windows with one
are hashed both ways. The values behind the placeholders are then compared over all windows of one
alignment: they must map one to one, and windows with a value that does not don't count, unless
all values of the window are equal.

A window of mostly placeholders says little as a template: alone it is hashed with its values, and
matches verbatim only. An item that has no other windows, or is too short for them, is therefore
also sought as a whole: every literal, operator and type of placeholder of it, in order.
"""

from __future__ import annotations

import itertools
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import without
from .shared import let, stored, table
from .words import Block, blocks, hash_spans, mix, windows

WINDOW = 13
SHORT = 8  #: window for benchmark items that have no window of WINDOW tokens
LITERALS = 7  #: of WINDOW tokens no placeholder, at least, and in proportion of fewer; with less a window counts verbatim
WHOLE = 4  #: tokens that an item has at least, one of them a literal word, to be sought as a whole by its template; with less it says nothing but its values
LEAST_BITS, MOST_BITS = 16, 27  #: the filter of benchmark windows has at most 2 ** MOST_BITS bits, 16 MB; of a benchmark of over ten million windows it lets more pass

#: Fixed values.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg lb lbs oz ounce ounces pound pounds ton tons ml l liter liters litre litres gallon gallons "
    "meter meters metre metres kilometer kilometers gram grams kilogram kilograms s sec second seconds min minute minutes h hr hour hours day days week weeks month months "
    "year years cent cents dollar dollars euro euros usd eur gbp percent degree degrees c f k w kw mw v hz khz mhz ghz mb gb tb mph kmh"
).split()

_NUMBER, _NAME, _UNIT, _ENTIRE = mix(np.arange(101, 105, dtype=np.uint64))
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
_OPERATOR = np.zeros(256, bool)
_OPERATOR[list(b"-+*/=<>^")] = True
_ENDS_SENTENCE = np.zeros(256, bool)
_ENDS_SENTENCE[list(b".!?:;\"')")] = True


def _unit_hashes() -> np.ndarray:
    block = next(blocks(pa.array([" ".join(UNITS)])))
    return np.unique(block.hashes())


_UNITS = _unit_hashes()


@cache
def _capitals() -> np.ndarray:
    """Whether each code point below 2 ** 17 is an upper-case letter; there are none above."""
    return np.array([unicodedata.category(chr(c)) == "Lu" for c in range(1 << 17)])


def _first_letters(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The code point of the UTF-8 character that begins at each place."""
    byte = lambda k: data[np.minimum(starts + k, len(data) - 1)].astype(np.int64)
    rest = lambda k: byte(k) & 63
    b = byte(0)
    two, three, four = (b & 31) << 6 | rest(1), (b & 15) << 12 | rest(1) << 6 | rest(2), (b & 7) << 18 | rest(1) << 12 | rest(2) << 6 | rest(3)
    return np.where(b < 0x80, b, np.where(b < 0xE0, two, np.where(b < 0xF0, three, four)))


def _between_numbers(block: Block, some: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Which words of punctuation alone have a number as the next other word of their document on either side."""
    n, at = len(some), np.arange(len(some))
    before = np.maximum.accumulate(np.where(some, at, -1))
    after = np.minimum.accumulate(np.where(some, at, n)[::-1])[::-1]
    counts = np.diff(block.doc)
    inside = (before >= np.repeat(block.doc[:-1], counts)) & (after < np.repeat(block.doc[1:], counts))
    return ~some & inside & number[np.maximum(before, 0)] & number[np.minimum(after, n - 1)]


def templates(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Where each document's tokens begin, their values' hashes, which are operators, and twice each token's template hash and whether it is a placeholder.

    First a capital at the start of a sentence is none of a name, then it is.
    """
    data = block.data
    starts, ends = block.starts.copy(), block.ends.copy()
    at = np.arange(len(starts))
    while len(at := at[(starts[at] < ends[at]) & _PUNCTUATION[data[np.minimum(starts[at], len(data) - 1)]]]):
        starts[at] += 1
    at = np.flatnonzero(starts < ends)
    while len(at := at[(starts[at] < ends[at]) & _PUNCTUATION[data[ends[at] - 1]]]):
        ends[at] -= 1
    # A name begins with a capital letter, of whatever script, and not a sentence, line or document.
    lines = np.concatenate([[0], np.cumsum(data == 10, dtype=np.int32)])
    begins = np.ones(len(starts), bool)
    if len(starts) > 1:
        begins[1:] = _ENDS_SENTENCE[data[block.ends[:-1] - 1]] | (lines[block.starts[1:]] > lines[block.ends[:-1]])
    begins[block.doc[:-1][block.doc[:-1] < len(starts)]] = True
    some = starts < ends
    if len(starts):
        first = data[np.minimum(starts, len(data) - 1)]
        operator = _between_numbers(block, some, some & (first >= 48) & (first <= 57))
        starts, ends = np.where(operator, block.starts, starts), np.where(operator, block.ends, ends)
        some |= operator
        operator = operator[some]
    else:
        operator = some
    starts, ends, begins = starts[some], ends[some], begins[some]
    doc = np.concatenate([[0], np.cumsum(some)])[block.doc]
    capital = _first_letters(data, starts) if len(starts) else np.zeros(0, np.int64)
    number = (capital >= 48) & (capital <= 57)
    capital = _capitals()[np.minimum(capital, (1 << 17) - 1)]
    lower = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    value = hash_spans(lower, starts, ends)
    unit = np.isin(value, _UNITS)
    signs = np.concatenate([[0], np.cumsum(_OPERATOR[data])])
    form = mix(_NUMBER + hash_spans(data[_OPERATOR[data]], signs[starts], signs[ends]))
    ways = []
    for name in (capital & ~begins & ~unit, capital & ~unit):
        ways.append((np.where(number, form, np.where(unit, _UNIT, np.where(name, _NAME, value))), number | unit | name))
    return doc, value, operator, ways


def _listed(bits: np.ndarray | None, widths: tuple[int, ...], entire: tuple[int, ...] = (), whole: bool = False):
    """A mapInArrow function: windows of a text whose hash the filter may have, with the values of their placeholders.

    Windows that match only verbatim (raw) have their values in the hash, and no slots. entire: the lengths of items that
    are sought as a whole by their templates. whole: not windows but each whole text, verbatim if it is shorter than SHORT
    and as a template if it has WHOLE tokens and a literal word.
    """

    def ways_of(block: Block) -> Iterator[tuple[np.ndarray, ...]]:
        """Rows of document, place, width, hash, whether it is raw, whether it is a whole template, the hashes of values, and which are placeholders."""
        starts, value, operator, ways = templates(block)
        n = np.diff(starts)
        doc, place, left = np.repeat(np.arange(block.n_docs), n), np.arange(len(value)) - np.repeat(starts[:-1], n), np.repeat(starts[1:], n) - np.arange(len(value))
        total = lambda x: np.concatenate([[0], np.cumsum(x)])
        at_start = total(ways[1][1] & ~ways[0][1])
        every = {int(x) for x in n if x} if whole else {*widths, *entire}
        for width, (way, (token, slot)) in itertools.product(sorted(every), enumerate(ways)):
            of = lambda x: x[np.minimum(np.arange(len(value)) + width, len(value))] - x[: len(value)]  # noqa: E731, B023
            fits = (place == 0) & (left == width) if whole else left >= width
            differs = of(at_start) > 0 if way else np.ones(len(value), bool)  # the second way only where it is another
            template = windows(token, width) if width in entire or not whole or width >= WHOLE else None
            if width in widths or whole and width < SHORT:
                raw = of(total(~slot)) < width * LITERALS // WINDOW
                if width < SHORT:
                    raw[:] = True
                h = mix((~windows(value, width) if width < SHORT else np.where(raw, ~windows(value, width), template)) + np.uint64(width))
                yield doc, place, width, h, raw, False, value, slot, fits & (differs & ~raw if way else differs)
            if width in entire or whole and width >= WHOLE:
                says = fits & differs
                if whole:
                    says &= of(total(~slot & ~operator)) > 0
                yield doc, place, width, mix((template ^ _ENTIRE) + np.uint64(width)), np.zeros(len(value), bool), True, value, slot, says

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                for doc, place, width, h, raw, is_whole, value, slot, ok in ways_of(block):
                    if bits is not None:
                        bit = (h >> np.uint64(65 - len(bits).bit_length() - 6)).astype(np.int64)
                        ok = ok & ((bits[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1)
                    at = np.flatnonzero(ok)
                    slots = [value[i : i + width][slot[i : i + width] & ~raw[i]].view(np.int64) for i in at]
                    columns = [pa.array(np.full(len(at), width, np.int32)), pa.array(raw[at]), pa.array(np.full(len(at), is_whole)), pa.array(place[at].astype(np.int32)), pa.array(h[at].view(np.int64)), pa.array(slots, pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, block.n_docs).take(pa.array(doc[at])), *columns], _NAMES)

    return work


_SCHEMA = "id long, width int, raw boolean, entire boolean, place int, hash long, slots array<long>"
_NAMES = [x.split()[0] for x in _SCHEMA.split(", ")]


def _filter(hashes: DataFrame) -> np.ndarray:
    """A bitmap of the first bits of the windows' hashes, in words of 64, with about 16 bits for each window up to the most there may be."""
    n_bits = min(MOST_BITS, max(LEAST_BITS, (16 * hashes.count()).bit_length()))
    bit = F.shiftrightunsigned("hash", 64 - n_bits)
    # 2 ** (MOST_BITS - 6) rows of two numbers at most, summed on the cluster.
    words = hashes.select(F.shiftright(bit, 6).alias("word"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - n_bits}) & 63 as int))").alias("b")).groupBy("word").agg(F.bit_or("b").alias("b")).toPandas()
    bits = np.zeros(1 << (n_bits - 6), np.uint64)
    bits[words["word"].to_numpy(np.int64)] = words["b"].to_numpy(np.int64).view(np.uint64)
    return bits


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = WINDOW) -> DataFrame:
    """One row for each document and benchmark item that it holds: doc_id, item_id, n_windows, n_item_windows, verbatim, n_raw_windows.

    n_windows: windows of the document that match the item with placeholder values that are all equal, or that each map
    one to one over their alignment; verbatim: the values of all these windows are equal; n_raw_windows: windows of
    mostly placeholders, which match by equal values only, so a row may have n_windows = 0. Items without a template
    window of 13 tokens are also sought by windows of 8, and those without one of 8 as a whole: as one template window if
    they have 4 tokens and a literal word, and verbatim if they have fewer than 8 tokens. What has neither (numbers or
    names alone, "the 42") is found by equal values only. Each length of such items is one more pass over the tokens.
    Null or empty texts are never found, nor are texts of punctuation alone or rows with a null id. Rows that share an id
    count as one text in turn; repeated items are reported alike. Documents without a match have no row. Texts and items
    of any length are cut into windows whole; an empty table of either gives no rows. Further columns are ignored.
    """
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where(F.col("doc_id").isNotNull())
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text")).where(F.col("item_id").isNotNull()).distinct()
    without_window = lambda of, found: of.join(found.where("not raw").select(F.col("id").alias("item_id")).distinct(), "item_id", "left_anti")
    long = stored(items.mapInArrow(_listed(None, (width,)), _SCHEMA), "items")
    rest = without_window(items, long)
    short = stored(rest.mapInArrow(_listed(None, (SHORT,)), _SCHEMA), "items")
    whole = without_window(rest, short).mapInArrow(_listed(None, (), whole=True), _SCHEMA)
    sought = stored(long.unionByName(short).unionByName(whole), "items")
    widths = sorted((r[0], r[1]) for r in sought.select("width", "entire").distinct().collect())
    return _matches(texts, sought, tuple(w for w, entire in widths if not entire), tuple(w for w, entire in widths if entire))


def _matches(texts: DataFrame, items: DataFrame, widths: tuple[int, ...], entire: tuple[int, ...]) -> DataFrame:
    found = texts.mapInArrow(_listed(_filter(items), widths, entire), _SCHEMA).select(F.col("id").alias("doc_id"), "place", "hash", "slots")
    of_item = items.select(F.col("id").alias("item_id"), "width", "raw", F.col("place").alias("item_place"), "hash", F.col("slots").alias("item_slots"))
    both = stored(found.join(of_item, "hash"), "matches")
    # An alignment has no more windows than its item, and each has `width` values at most.
    window = F.struct("place", "raw", F.arrays_zip("slots", "item_slots").alias("v"))
    aligned = both.groupBy("doc_id", "item_id", "width", (F.col("place") - F.col("item_place")).alias("shift")).agg(F.collect_set(window).alias("windows"))
    values = F.array_distinct(F.flatten(F.transform("windows", lambda x: x["v"])))
    clash = lambda x, y: (x["slots"] == y["slots"]) != (x["item_slots"] == y["item_slots"])
    judged = aligned.withColumn("clashing", let(values, lambda v: F.filter(v, lambda x: F.exists(v, lambda y: clash(x, y)))))
    equal = lambda w: F.forall(w["v"], lambda x: x["slots"] == x["item_slots"])
    kept = judged.select("doc_id", "item_id", "width", F.filter("windows", lambda w: equal(w) | ~F.exists(w["v"], lambda x: F.array_contains("clashing", x))).alias("windows")).where(F.size("windows") > 0)
    places = lambda raw: F.transform(F.filter("windows", lambda w: w["raw"] == F.lit(raw)), lambda w: w["place"])
    kept = kept.select("doc_id", "item_id", "width", places(False).alias("places"), places(True).alias("raws"), F.forall("windows", equal).alias("verbatim"))
    n = lambda c: F.size(F.array_distinct(F.flatten(F.collect_list(c)))).cast("long")
    counted = kept.groupBy("doc_id", "item_id", "width").agg(n("places").alias("n"), n("raws").alias("r"), F.bool_and("verbatim").alias("verbatim"))
    counted = counted.groupBy("doc_id", "item_id").agg(F.sum("n").alias("n_windows"), F.sum("r").alias("n_raw_windows"), F.bool_and("verbatim").alias("verbatim"))
    total = items.groupBy(F.col("id").alias("item_id")).agg(F.countDistinct(F.when(~F.col("raw"), F.struct("width", "place"))).alias("n_item_windows"))
    return counted.join(total, "item_id").select("doc_id", "item_id", "n_windows", "n_item_windows", "verbatim", "n_raw_windows")


def decontaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without those that hold a benchmark item; rows with a null id stay."""
    gone = leaks(docs, benchmark, doc_id, text).select(F.col("doc_id").alias(doc_id)).distinct()
    return without(docs, doc_id, stored(gone, "gone"))


def query(spark, sf_dir: str) -> DataFrame:
    """Each document with each benchmark item that it holds; see leaks() for edge cases."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _windows_sql(of: str, width: str, places: str, entire: bool = False) -> str:
    """Windows of lists of tokens, both ways: their key, and the values of their placeholders. entire: as templates, whatever they are made of."""
    part = lambda c: f"{c}[p:p + width - 1]"
    way = lambda a, b: part(f"(case when way = 0 then {a} else {b} end)")
    raw = "false" if entire else f"width < {SHORT} or len(list_filter(ss, lambda x: not x)) < width * {LITERALS} // {WINDOW}"
    return f"""(select id, width, p, raw, {"'whole ' || " if entire else ""}case when raw then array_to_string(vs, ' ') else array_to_string(ts, ' ') end as key,
    case when raw then [] else list_filter(vs, lambda x, i: ss[i]) end as slots, len(list_filter(ts, lambda x: x[1] = '=')) > 0 as says
  from (select *, {raw} as raw
    from (select id, width, p, way, {part("v")} as vs, {way("ta", "tb")} as ts, {way("sa", "sb")} as ss, {part("st")} as sts
      from (select *, unnest({places}) as p from (select *, {width} as width from {of})), (values (0), (1)) as ways(way)))
  where way = 0 or (not raw and list_contains(sts, true)))"""


ORACLE = rf"""
with t0 as (
  select 'd' as k, doc_id as id, coalesce(text, '') as text from documents where doc_id is not null
  union all select distinct 'i', item_id, coalesce(text, '') from benchmark where item_id is not null),
w0 as (
  select k, id, unnest(regexp_extract_all(text, '([^\x20\x09-\x0D]+)[\x20\x09-\x0D]*', 1)) as w, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+([\x20\x09-\x0D]*)', 1)) as gap,
         unnest(range(1, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 1)) as i from t0),
w1 as (select *, lag(w) over s as pw, lag(gap) over s as pg from w0 window s as (partition by k, id order by i)),
w2 as (
  select k, id, i, w, trim(w, '!"#$%&''()*+,-./:;<=>?@[\]^_`{{|}}~') as x, pw is null or contains('.!?:;"'')', right(pw, 1)) or contains(pg, chr(10)) as begins from w1),
near as (
  select *, last_value(case when x <> '' then x end ignore nulls) over (partition by k, id order by i rows between unbounded preceding and current row) as px,
         first_value(case when x <> '' then x end ignore nulls) over (partition by k, id order by i rows between current row and unbounded following) as nx from w2),
w2b as (
  select k, id, i, begins, x = '' as op, case when x <> '' then x else w end as x from near where x <> '' or (regexp_matches(px, '^[0-9]') and regexp_matches(nx, '^[0-9]'))),
w3 as (select *, translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as v, regexp_matches(x, '^[0-9]') as num, regexp_matches(x, '^\p{{Lu}}') as cap from w2b),
w4 as (select *, list_contains(string_split('{" ".join(UNITS)}', ' '), v) as unit, case when op then '~' || v when num then '#' || regexp_replace(x, '[^-+*/=<>^]', '', 'g') when unit then '@' end as fixed from w3),
l as (
  select k, id, list(v order by i) as v,
         list(coalesce(fixed, case when cap and not begins then '&' else '=' || v end) order by i) as ta, list(coalesce(fixed, case when cap then '&' else '=' || v end) order by i) as tb,
         list(num or unit or (cap and not begins) order by i) as sa, list(num or unit or cap order by i) as sb, list(cap and begins and not unit and not num order by i) as st
  from w4 group by k, id),
li as (select * from l where k = 'i'),
i13 as {_windows_sql("li", str(WINDOW), "range(1, len(v) - width + 2)")},
rest as (select * from li where id not in (select id from i13 where not raw)),
i8 as {_windows_sql("rest", str(SHORT), "range(1, len(v) - width + 2)")},
left_over as (select * from rest where id not in (select id from i8 where not raw)),
parts as (select * from i13 union all select * from i8 union all select * from {_windows_sql(f"(select * from left_over where len(v) < {SHORT})", "len(v)", "[1]")}),
wholes as (select * from {_windows_sql(f"(select * from left_over where len(v) >= {WHOLE})", "len(v)", "[1]", True)} where says),
items as (select * from parts union all select * from wholes),
ld as (select l.*, s.n from l, (select distinct width as n from parts) s where k = 'd'),
le as (select l.*, s.n from l, (select distinct width as n from wholes) s where k = 'd'),
docs as (select * from {_windows_sql("ld", "n", "range(1, len(v) - width + 2)")} union all select * from {_windows_sql("le", "n", "range(1, len(v) - width + 2)", True)}),
m as (
  select distinct d.id as doc_id, i.id as item_id, d.width, d.p - i.p as shift, d.p, d.raw, list_zip(d.slots, i.slots) as pairs
  from docs d join items i on d.width = i.width and d.raw = i.raw and d.key = i.key),
x as (select distinct doc_id, item_id, width, shift, unnest(pairs) as q from m),
c as (
  select distinct a.doc_id, a.item_id, a.width, a.shift, a.q from x a join x b on a.doc_id = b.doc_id and a.item_id = b.item_id and a.width = b.width and a.shift = b.shift
  where (a.q[1] = b.q[1]) <> (a.q[2] = b.q[2])),
cl as (select doc_id, item_id, width, shift, list(q) as clashing from c group by all),
j as (
  select m.*, len(list_filter(pairs, lambda y: y[1] <> y[2])) = 0 as equal, coalesce(len(list_filter(pairs, lambda y: list_contains(clashing, y))), 0) as n_clashes
  from m left join cl on m.doc_id = cl.doc_id and m.item_id = cl.item_id and m.width = cl.width and m.shift = cl.shift),
kept as (select * from j where equal or n_clashes = 0),
total as (select id as item_id, count(distinct case when not raw then width * 1000000 + p end) as n_item_windows from items group by id)
select doc_id, kept.item_id, count(distinct case when not raw then width * 1000000000 + p end)::bigint as n_windows, any_value(n_item_windows)::bigint as n_item_windows, bool_and(equal) as verbatim,
       count(distinct case when raw then width * 1000000000 + p end)::bigint as n_raw_windows
from kept join total on kept.item_id = total.item_id group by doc_id, kept.item_id
"""
