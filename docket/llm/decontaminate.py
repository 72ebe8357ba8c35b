"""Benchmark decontamination by template canonicalisation.

A text becomes a row of tokens: numbers, names and units turn into typed placeholders, other words into lower case.
A capital that begins a sentence may be a name or not, so such windows have both readings. Every window of
five tokens is indexed by its words as written and, if at least two of its tokens are words, by its canonical readings too; so windows that
are nearly all numbers and names count as well, but only as they are written; five numbers alone are not indexed. Windows of documents are joined by hash with those of the benchmark items.
A document and an item that share windows at one distance are aligned; at the placeholders of
aligned windows each value of the item must stand for one value of the document throughout, or the
alignment does not count. So a question asked again with other numbers and names is found,
and text that only has the same shape is not.

A window of the item is covered if it is matched, or if matched windows of one alignment hold all its tokens. An item leaks if
``COVERED`` of all its windows are covered, or a run of ``RUN`` tokens.

The windows of the benchmark are counted first. Up to ``BROADCAST_WINDOWS`` their hashes are
broadcast, and only windows that match leave a document's task; beyond, every window of a
document is joined by a shuffle. Both give the same rows.

Defined results: null and empty texts have no window; items of fewer than five tokens, or of numbers
only, are not searched for; rows with a null id are not
judged; rows with equal ids count as one document; items that are equal after
canonicalisation are each reported; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docket.llm.words import bounded_batches, find_words, mix, pieces, shingle_hashes, span_hashes, text_bytes
from docket.session import staged

SIZE, WORDS = 5, 2
COVERED, RUN = 0.8, 13
BROADCAST_WINDOWS = 2_000_000
NUMBER, NAME, UNIT = (mix(np.array([k], np.uint64), 99)[0] for k in (1, 2, 3))
# Units after a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg t lb lbs oz ounce ounces ton tons pound pounds"
    " ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days"
    " week weeks month months year years cent cents dollar dollars euro euros percent degree degrees meter meters metre metres"
    " kilometer kilometers kilogram kilograms gram grams mph kmh w kw v a hz gb mb kb"
).split()
# Words that begin a sentence and are no names.
OPENERS = (
    "a an the this that these those what which who whom whose when where why how if in on at of to for from by with as and or but so because"
    " after before during while since until although though is are was were be do does did has have had can could will would should shall may"
    " might must let there here it its he she they we you i his her their our your my each every some any all both no not one many much most"
    " given find calculate compute suppose assume name list explain describe show solve write"
).split()


def _hash_words(words: list[str]) -> np.ndarray:
    ends = np.cumsum([len(w.encode()) for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    return np.sort(span_hashes(np.frombuffer("".join(words).encode(), np.uint8), starts, ends)) if words else np.zeros(0, np.uint64)


UNIT_HASHES, OPENER_HASHES = _hash_words(UNITS), _hash_words(OPENERS)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def canonical(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash as written (lower case), hash of the placeholder (or 0), and whether it is only a possible one, of every token.

    A name is a capitalised word; at the beginning of a sentence it is one possibly, if it is not one of ``OPENERS``.
    """
    data, offsets = text_bytes(column)
    # Accented Latin capitals (U+00C0 to U+00DE in UTF-8) as small letters; hashes fold ASCII only.
    accented = np.zeros(len(data), bool)
    accented[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    data = np.where(accented, data + np.uint8(0x20), data)
    starts, ends, rows = find_words(data, offsets, "alnum")
    written = span_hashes(data, starts, ends, lower=True)
    if not len(starts):
        return rows, written, written, np.zeros(0, bool)
    digit = (data >= 48) & (data <= 57)
    digits = np.concatenate([[0], np.cumsum(digit)])
    number = digits[ends] - digits[starts] == ends - starts
    # 3.5 and 1,000 are one number.
    joined = np.zeros(len(starts), bool)
    gap = starts[1:] - ends[:-1] == 1
    joined[1:] = gap & number[1:] & number[:-1] & np.isin(data[ends[:-1].clip(max=len(data) - 1)], [44, 46]) & (rows[1:] == rows[:-1])
    stop = np.isin(data, [10, 33, 46, 58, 63])
    stops = np.concatenate([[0], np.cumsum(stop)])
    begins = np.ones(len(starts), bool)
    begins[1:] = (stops[starts[1:]] > stops[ends[:-1]]) | (rows[1:] != rows[:-1])
    upper = (data >= 65) & (data <= 90)
    second = data[(starts + 1).clip(max=len(data) - 1)]
    title = upper[starts] & (ends - starts > 1) & ((second >= 97) & (second <= 122) | (second >= 128))
    maybe = title & begins & ~_among(written, OPENER_HASHES)
    name = title & ~begins
    keep = ~joined
    rows, written, number, name, maybe = rows[keep], written[keep], number[keep], name[keep], maybe[keep]
    unit = np.zeros(len(rows), bool)
    unit[1:] = number[:-1] & (rows[1:] == rows[:-1]) & _among(written, UNIT_HASHES)[1:]
    holder = np.zeros(len(rows), np.uint64)
    holder[name | maybe], holder[unit], holder[number] = NAME, UNIT, NUMBER
    return rows, written, holder, maybe & ~unit & ~number


def _windows(rows: np.ndarray, written: np.ndarray, holder: np.ndarray, maybe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every reading of every window of one row: as written, and with placeholders where enough words are left."""
    n = len(rows) - SIZE + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    others = np.concatenate([[0], np.cumsum(holder != NUMBER)])
    inside = (rows[:n] == rows[SIZE - 1 :]) & (others[SIZE : SIZE + n] > others[:n])
    plain = shingle_hashes(written, SIZE)
    hashes_at = [plain]
    at, hashes = [np.flatnonzero(inside)], [plain[inside]]
    for slot in ((holder != 0) & ~maybe, holder != 0):
        read = shingle_hashes(np.where(slot, holder, written), SIZE)
        words = np.concatenate([[0], np.cumsum(~slot)])
        new = inside & (words[SIZE : SIZE + n] - words[:n] >= WORDS)
        for h in hashes_at:
            new &= h != read
        at.append(np.flatnonzero(new))
        hashes.append(read[new])
        hashes_at.append(read)
    return np.concatenate(at), np.concatenate(hashes)


WINDOW = "id long, h long, at int, n int, values array<long>, slots array<boolean>"


def windows(table: DataFrame, key: str, only=None) -> DataFrame:
    """Every reading of every window of every text: its hash, its place in the text's tokens, how many windows the text
    has, and its five words as written with flags for placeholders."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = only.value if only is not None else None
        for batch in batches:
            for i, j in pieces(batch.column(1), 1 << 20):
                rows, written, holder, maybe = canonical(batch.column(1)[i:j])
                slot = holder != 0
                at, h = _windows(rows, written, holder, maybe)
                total = np.maximum(np.bincount(rows, minlength=j - i) - SIZE + 1, 0)
                if known is not None:
                    keep = _among(h, known)
                    at, h = at[keep], h[keep]
                if not len(at):
                    continue
                first = np.searchsorted(rows, np.arange(j - i))
                five = at[:, None] + np.arange(SIZE)
                edges = pa.array(np.arange(0, SIZE * len(at) + 1, SIZE, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[i:j].take(pa.array(rows[at])),
                        pa.array(h.view(np.int64)),
                        pa.array((at - first[rows[at]]).astype(np.int32)),
                        pa.array(total[rows[at]].astype(np.int32)),
                        pa.ListArray.from_arrays(edges, pa.array(written[five].ravel().view(np.int64))),
                        pa.ListArray.from_arrays(edges, pa.array(slot[five].ravel())),
                    ],
                    ["id", "h", "at", "n", "values", "slots"],
                )

    return table.select(F.col(key).cast("long"), "text").where(f"{key} is not null").mapInArrow(find, WINDOW)


def _filled(places):
    """Sorted places and those between two of them that are no farther apart than a window."""

    def to_next(p, q):
        return F.sequence(p, F.when(q - p <= SIZE, q - 1).otherwise(p))

    return F.flatten(F.zip_with(places, F.slice(places, 2, F.greatest(F.size(places), F.lit(1))), to_next))


def _longest(places):
    """The longest run of consecutive numbers in a sorted array."""
    zero = F.struct(F.lit(-9).alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(s, x):
        run = F.when(x == s["last"] + 1, s["run"] + 1).otherwise(F.lit(1))
        return F.struct(x.alias("last"), run.alias("run"), F.greatest(s["best"], run).alias("best"))

    return F.aggregate(places, zero, step, lambda s: s["best"])


def leaks(docs: DataFrame, benchmark: DataFrame, covered: float = COVERED, run: int = RUN) -> DataFrame:
    """(doc_id, item_id, coverage, longest_run, changed): the items that leak into documents.

    ``changed`` is true if some placeholder has another value than in the item.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    items = staged(windows(benchmark, "item_id"), "items")
    few = items.select("h").distinct().limit(BROADCAST_WINDOWS + 1)
    if few.count() <= BROADCAST_WINDOWS:
        hashes = np.sort(np.array([r["h"] for r in few.collect()], np.int64).view(np.uint64))
        found = windows(docs, "doc_id", spark.sparkContext.broadcast(hashes))
    else:
        found = windows(docs, "doc_id")
    items = items.select(F.col("id").alias("item_id"), "h", F.col("at").alias("place"), F.col("n").alias("windows"), F.col("values").alias("wanted"), "slots")
    met = found.select(F.col("id").alias("doc_id"), "h", "at", "values").join(items, "h")
    pairs = F.filter(
        F.zip_with(F.arrays_zip("wanted", "values"), F.col("slots"), lambda p, s: F.when(s, p)), lambda p: p.isNotNull()
    )
    lines = met.groupBy("doc_id", "item_id", "windows", (F.col("at") - F.col("place")).alias("distance")).agg(
        F.collect_set("place").alias("places"), F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs")
    )
    # One value of the item, one value of the document.
    sure = F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda p: p["wanted"])))
    changed = F.exists("pairs", lambda p: p["wanted"] != p["values"])
    lines = lines.where(sure).withColumn("places", F.array_sort("places"))
    best = lines.withColumn("covered", _filled(F.col("places"))).groupBy("doc_id", "item_id", "windows").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("covered")))).alias("covered"),
        F.max(_longest(F.col("covered"))).alias("run"),
        F.max(changed).alias("changed"),
    )
    return best.select(
        "doc_id",
        "item_id",
        (F.col("covered") / F.col("windows")).alias("coverage"),
        (F.col("run") + SIZE - 1).alias("longest_run"),
        "changed",
    ).where((F.col("coverage") >= covered) | (F.col("longest_run") >= run))
