"""Toxicity scores over text restored by a noisy-channel decoder.

A written word is seen as a clean word sent through a channel that swaps letters for digits
and signs, puts separators between letters, and repeats letters. Words that show such
traces (any digit or sign of ``STANDS_FOR``, any letter twice), runs of single letters and neighbouring short fragments become a lattice: every character may stand for a few
letters or for nothing, each at a price. A Viterbi search finds the cheapest reading
under a trigram model of letters, counted over all texts. Restored words are scored beside the
words as written.

The score is a logistic model over the presence of words, and of the first ``PREFIX`` bytes that one, or at least two different, longer words have. They are counted by class in labelled training
documents, those that tell the classes apart by the log-likelihood ratio become features, and the
weights are fitted with a ridge penalty, chosen from ``PENALTIES`` by the loss on left-out fifths of the training rows.
Words that mostly occur together share their weight there; so a word whose own toxic share is at least ``DECIDES`` by the lower
end of its interval (Wilson, two standard deviations) gives a text at least that score. The labelled rows used are a bounded
sample in the order of a hash (``TRAINING_ROWS``); everything else covers all data.

Defined results: null or empty text has no word and gets the model's base rate; a null id is in no fold and held_out is
false; labels that are null are not used; without labels of both classes every score is the
share of toxic labels, or 0; equal texts get equal scores; texts are read whole; an empty table
gives no rows; other columns are kept, ``score`` and ``predicted`` are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from docket.llm.words import bounded_batches, find_words, mix, pieces, span_hashes, text_bytes
from docket.session import staged

TRAINING_ROWS = 20_000
FEATURES, LEAST_RATIO = 256, 30.0
THRESHOLD = 0.3
PREFIX = 7
DECIDES = 0.7
PENALTIES, PARTS_LEFT_OUT = (1.0, 0.3, 0.1, 0.03, 0.01), 5
# What a sign may stand for (fixed values), and prices in natural logarithms.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l",
}
SWAP, DROP_SIGN, DROP_DIGIT, REPEAT = -1.0, -1.5, -6.0, -0.7
LETTERS = 27


def _codes() -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[65:91] = table[97:123] = np.arange(1, 27)
    return table


def letter_counts(docs: DataFrame) -> np.ndarray:
    """Counts of letter trigrams over all texts; 0 stands for anything that is no ASCII letter.

    A task hands over at most 27**3 numbers.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = _codes(), np.zeros(LETTERS**3, np.int64)
        for batch in batches:
            for i, j in pieces(batch.column(0), 1 << 20):
                data, offsets = text_bytes(batch.column(0)[i:j])
                code = np.insert(table[data], offsets, 0)
                code = code[(code > 0) | (np.append(1, code[:-1]) > 0)]
                code = np.concatenate([[0], code, [0]])
                total += np.bincount(code[:-2] * LETTERS**2 + code[1:-1] * LETTERS + code[2:], minlength=LETTERS**3)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["code", "n"])

    rows = docs.select("text").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n")).collect()
    out = np.zeros(LETTERS**3)
    for code, n in rows:
        out[code] = n
    return out.reshape(LETTERS, LETTERS, LETTERS)


def letter_model(counts: np.ndarray) -> list[list[list[float]]]:
    """Log probabilities of a letter after two others, interpolated with shorter contexts."""
    pair, one = counts.sum(axis=0), counts.sum(axis=(0, 1))
    p1 = (one + 1) / (one.sum() + LETTERS)
    p2 = (pair + 20 * p1) / (pair.sum(axis=1, keepdims=True) + 20)
    p3 = (counts + 20 * p2[None, :, :]) / (counts.sum(axis=2, keepdims=True) + 20)
    return np.log(p3).tolist()


def restore(word: str, model: list[list[list[float]]]) -> str:
    """The cheapest reading of a written word, by Viterbi search over pairs of letters.

    A space in ``word`` may be one, or a separator between letters of one word.
    """
    states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    before = ""
    for ch in word.lower():
        if "a" <= ch <= "z":
            options = [(ord(ch) - 96, 0.0)] + ([(-1, REPEAT)] if ch == before else [])
        elif ch == " ":
            options = [(0, 0.0), (-1, DROP_SIGN)]
        else:
            options = [(ord(x) - 96, SWAP) for x in STANDS_FOR.get(ch, "")]
            options.append((-1, DROP_DIGIT if ch.isalnum() else DROP_SIGN))
            if ch == before:
                options.append((-1, REPEAT))
        before = ch
        after: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a, b), (price, path) in states.items():
            row = model[a][b]
            for letter, cost in options:
                state, total = ((b, letter), price + cost + row[letter]) if letter >= 0 else ((a, b), price + cost)
                known = after.get(state)
                if known is None or total > known[0]:
                    after[state] = (total, (path, letter) if letter >= 0 else path)
        states = after
    best = max(((price + model[a][b][0], path) for (a, b), (price, path) in states.items()), default=(0.0, ()), key=lambda x: x[0])[1]
    out = []
    while best:
        best, letter = best
        out.append(chr(96 + letter) if letter else " ")
    return "".join(reversed(out))


# Bytes of what may stand for a letter, wherever it is, and signs that must stand between letters.
_SIGN, _SEPARATOR = np.zeros(256, bool), np.zeros(256, bool)
_SIGN[[ord(x) for x in STANDS_FOR if x.isascii()]] = True
_LONG_SIGNS = [np.frombuffer(x.encode(), np.uint8) for x in STANDS_FOR if not x.isascii()]
_SEPARATOR[[*map(ord, "*._-~'")]] = True
_LETTER = _codes() > 0
FRAGMENT, PARTS = 4, 4  # bytes of a fragment of a spaced word, and how many are joined


def _signs(data: np.ndarray) -> np.ndarray:
    """Where a character of ``STANDS_FOR`` begins."""
    sign = _SIGN[data]
    for x in _LONG_SIGNS:
        if len(data) >= len(x):
            here = np.ones(len(data) - len(x) + 1, bool)
            for i, byte in enumerate(x):
                here &= data[i : i + len(here)] == byte
            sign[: len(here)] |= here
    return sign


def _before(mask: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(mask)])


def traces(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Which words show traces of the channel, and runs of three or more single letters."""
    letter, sign = _LETTER[data], _signs(data)
    inner = sign.copy()
    if len(data) > 1:
        # A character twice.
        inner[1:] |= letter[1:] & (_codes()[data[1:]] == _codes()[data[:-1]])
    if len(data) > 2:
        parting = _SEPARATOR[data]
        inner[1:-1] |= parting[1:-1] & (letter[2:] | sign[2:]) & (letter[:-2] | sign[:-2] | parting[:-2])
    marks, readable = _before(inner), _before(letter | sign)
    some = (marks[ends] - marks[starts] > 0) & (readable[ends] - readable[starts] > 1)
    single = (ends - starts == 1) & (letter[starts] | sign[starts]) if len(starts) else np.zeros(0, bool)
    runs = []
    edge = np.flatnonzero(np.diff(np.concatenate([[0], single.astype(np.int8), [0]])))
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        cut = np.flatnonzero(np.diff(rows[a:b])) + 1
        for x, y in zip([0, *cut.tolist()], [*cut.tolist(), b - a]):
            if y - x >= 3:
                runs.append((a + x, a + y))
    return some, runs


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """The bytes of short fragments without the space between them, and the spans and rows of two to ``PARTS`` neighbours, by their number."""
    short = np.flatnonzero(ends - starts <= FRAGMENT)
    sizes = (ends - starts)[short]
    stops = np.cumsum(sizes)
    begins = stops - sizes
    flat = data[np.repeat(starts[short] - begins, sizes) + np.arange(int(sizes.sum()))] if len(short) else data[:0]
    out = []
    for n in range(1, PARTS):
        k = np.arange(max(0, len(short) - n))
        k = k[(short[k + n] - short[k] == n) & (rows[short[k + n]] == rows[short[k]])]
        out.append((begins[k], stops[k + n], rows[short[k]]))
    return flat, out


class Restorer:
    """Restored words of a batch, each distinct written word decoded once per worker."""

    def __init__(self, model: list[list[list[float]]]) -> None:
        self.model, self.known = model, {}

    def word(self, written: str) -> str:
        if len(self.known) > 500_000:
            self.known.clear()
        out = self.known.get(written)
        if out is None:
            # Marks around a word are no part of it.
            out = self.known[written] = restore(written.strip(".,;:?*-_~'\")>"), self.model)
        return out

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and hash of the words of a batch as written, and then of those restored."""
        starts, ends, rows = find_words(data, offsets, "alnum")
        hashes = span_hashes(data, starts, ends, lower=True)
        s, e, r = find_words(data, offsets, "space")
        some, runs = traces(data, s, e, r)
        raw = data.tobytes()
        where, found = [], []
        more_rows, more = [rows], [hashes]
        flat, windows = joined(data, s, e, r)
        letter, twice = _LETTER[flat], np.zeros(len(flat), bool)
        twice[1:] = _codes()[flat[1:]] == _codes()[flat[:-1]]
        odd, readable = _before(~letter | twice), _before(letter | _signs(flat))
        disguised = [(data, s[some], e[some], r[some])]
        for a, b, in_row in windows:
            plain = odd[b] - odd[a] == 0
            more_rows.append(in_row[plain])
            more.append(span_hashes(flat, a[plain], b[plain], lower=True))
            unclear = ~plain & (readable[b] - readable[a] > 1)
            disguised.append((flat, a[unclear], b[unclear], in_row[unclear]))
        for source, x, y, of in disguised:
            # Each distinct word once.
            _, first, inverse = np.unique(span_hashes(source, x, y, lower=True), return_index=True, return_inverse=True)
            if not len(first):
                continue
            text = source.tobytes()
            words = [self.word(text[i:j].decode("utf-8", "ignore")) for i, j in zip(x[first].tolist(), y[first].tolist())]
            full = np.array([len(w) > 0 for w in words])
            stops = np.cumsum([len(w) for w in words])
            letters = np.frombuffer("".join(words).encode("ascii"), np.uint8)
            own = np.zeros(len(words), np.uint64)
            own[full] = span_hashes(letters, np.concatenate([[0], stops[:-1]])[full], stops[full], lower=True)
            more_rows.append(of[full[inverse]])
            more.append(own[inverse][full[inverse]])
        for a, b in runs:
            read = self.word(" ".join(chr(raw[x]) for x in s[a:b].tolist())).split()
            found += read
            where += [int(r[a])] * len(read)
        if found:
            lengths = np.array([len(x) for x in found])
            stops = np.cumsum(lengths)
            flat = np.frombuffer("".join(found).encode("ascii"), np.uint8)
            full = lengths > 0
            read = span_hashes(flat, (stops - lengths)[full], stops[full], lower=True)
            more_rows.append(np.array(where)[full])
            more.append(read)
        # What is read as it stands in the row is there already.
        at, read = np.concatenate(more_rows[1:]), np.concatenate(more[1:])
        new = ~np.isin(read ^ mix(at.astype(np.uint64), 5), hashes ^ mix(rows.astype(np.uint64), 5))
        # Beginnings of longer words have hashes of their own kind, and others if several words of a text share one.
        longer = np.flatnonzero(ends - starts > PREFIX)
        _, first = np.unique(hashes[longer] ^ mix(rows[longer].astype(np.uint64), 5), return_index=True)
        longer = longer[np.sort(first)]
        begins = span_hashes(data, starts[longer], starts[longer] + PREFIX, lower=True)
        _, first, count = np.unique(begins ^ mix(rows[longer].astype(np.uint64), 5), return_index=True, return_counts=True)
        longer, begins, several = longer[first], begins[first], count > 1
        return (
            np.concatenate([rows, at[new], rows[longer], rows[longer[several]]]),
            np.concatenate([hashes, read[new], mix(begins, PREFIX), mix(begins[several], PREFIX + 1)]),
        )


@dataclass
class Model:
    """Letter model, feature hashes in order, their weights, the base log odds, and the least log odds that each feature alone gives."""

    letters: list = field(repr=False)
    features: np.ndarray
    weights: np.ndarray
    base: float
    least: np.ndarray


def in_fold(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def _present(docs: DataFrame, restorer_model, extra: list[str], select: np.ndarray | None = None) -> DataFrame:
    """(extra columns, words): the distinct word hashes of each text, of ``select`` if given."""
    schema = docs.select(*extra).schema.add("words", T.ArrayType(T.LongType()))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Restorer(restorer_model.value)
        for batch in batches:
            for i, j in pieces(batch.column(len(extra)), 1 << 20):
                rows, hashes = tool.words(*text_bytes(batch.column(len(extra))[i:j]))
                if select is not None:
                    at = np.minimum(np.searchsorted(select, hashes), max(0, len(select) - 1))
                    keep = select[at] == hashes if len(select) else np.zeros(len(hashes), bool)
                    rows, hashes = rows[keep], hashes[keep]
                order = np.lexsort((hashes, rows))
                rows, hashes = rows[order], hashes[order]
                new = np.ones(len(rows), bool)
                new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
                rows, hashes = rows[new], hashes[new]
                cuts = np.searchsorted(rows, np.arange(j - i + 1)).astype(np.int32)
                words = pa.ListArray.from_arrays(pa.array(cuts), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([*(batch.column(k)[i:j] for k in range(len(extra))), words], schema.names)

    return docs.select(*extra, "text").mapInArrow(find, schema)


def _newton(x: np.ndarray, toxic: np.ndarray, count: np.ndarray, penalty: float) -> np.ndarray:
    """Weights, the base last, of a ridge-penalised logistic model. A row of ``x`` stands for ``count`` rows, ``toxic`` of them of class 1."""
    w = np.zeros(x.shape[1])
    ridge = np.append(np.full(len(w) - 1, penalty), 1e-6)

    def loss(w: np.ndarray) -> float:
        odds = x @ w
        return float((count * np.logaddexp(0, odds) - toxic * odds).sum() + (ridge * w * w).sum() / 2)

    now = loss(w)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (count * p - toxic) + ridge * w
        step = np.linalg.solve((x * (count * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge), slope)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        before, now = now, loss(w)
        if before - now < 1e-7:
            break
    return w


def _logistic(rows: list[tuple[list[int], int]], n: int) -> tuple[np.ndarray, float]:
    """Weights and base of a logistic model on sparse binary rows, with the penalty that loses least on left-out rows.

    Rows with the same features are one row with a count; fifths are dealt row by row in the order of their features.
    """
    found: dict[tuple, np.ndarray] = {}
    for k, (features, label) in enumerate(sorted((tuple(f), label) for f, label in rows)):
        found.setdefault(features, np.zeros((PARTS_LEFT_OUT, 2)))[k % PARTS_LEFT_OUT, label] += 1
    x = np.zeros((len(found), n + 1))
    x[:, n] = 1
    for i, features in enumerate(found):
        x[i, list(features)] = 1
    cells = np.stack(list(found.values()))

    def left_out(penalty: float) -> float:
        total = 0.0
        for part in range(PARTS_LEFT_OUT):
            rest = cells.sum(axis=1) - cells[:, part]
            if not rest[:, 1].sum():
                continue
            odds = x @ _newton(x, rest[:, 1], rest.sum(axis=1), penalty)
            total += float((cells[:, part].sum(axis=1) * np.logaddexp(0, odds) - cells[:, part, 1] * odds).sum())
        return total

    best = min(PENALTIES, key=left_out) if n else PENALTIES[0]
    w = _newton(x, cells.sum(axis=1)[:, 1], cells.sum(axis=(1, 2)), best)
    return w[:n], float(w[n])


def _sure_share(a: int, b: int, z: float = 2.0) -> float:
    """The lower end of the Wilson interval of a / (a + b)."""
    n = a + b
    p = a / n
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, rows: int = TRAINING_ROWS) -> Model:
    """Learn from labelled documents that are not held out.

    ``labels`` has doc_id and toxic. The letter model counts all of ``docs``. Of the labelled
    training rows the first ``rows`` in the order of a hash of the id are used.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    letters = letter_model(letter_counts(docs))
    shared = spark.sparkContext.broadcast(letters)
    labels = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = labels.where(~held_out).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    chosen = staged(chosen.select(F.col("doc_id").alias("id"), "toxic"), "labels")
    # At most ``rows`` rows: a bounded table.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("toxic", "text")
    sample = staged(_present(sample, shared, ["toxic"]), "labelled")
    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    ones, all_rows = totals.get(1, 0), sum(totals.values())
    if not ones or ones == all_rows:
        share = ones / all_rows if all_rows else 0.0
        base = 40.0 if share == 1 else -40.0
        return Model(letters, np.zeros(0, np.uint64), np.zeros(0), base, np.zeros(0))
    counts = sample.select("toxic", F.explode("words").alias("w")).groupBy("w").agg(
        F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")
    )

    def part(k: Column, n: Column) -> Column:
        return F.when(k > 0, k * F.log(k / n)).otherwise(0.0)

    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    t, s = F.lit(float(ones)), F.lit(float(all_rows - ones))
    share = (a + b) / (t + s)
    ratio = 2 * (part(a, t * share) + part(b, s * share) + part(t - a, t * (1 - share)) + part(s - b, s * (1 - share)))
    top = counts.withColumn("g", ratio).where(F.col("g") >= LEAST_RATIO).orderBy(F.desc("g"), "w").limit(FEATURES)
    top = top.select("w", "a", "b").collect()
    features = np.sort(np.array([r["w"] for r in top], np.int64).view(np.uint64))
    seen = {r["w"]: (r["a"], r["b"]) for r in top}
    as_long = features.view(np.int64).tolist()
    wanted = F.array(*map(F.lit, as_long)).cast(T.ArrayType(T.LongType()))
    place = {w: i for i, w in enumerate(as_long)}
    few = sample.select("toxic", F.array_sort(F.array_intersect("words", wanted)).alias("words")).collect()
    weights, base = _logistic([([place[w] for w in r["words"]], r["toxic"]) for r in few], len(features))
    share = np.array([_sure_share(*seen[w]) for w in as_long])
    least = np.where(share >= DECIDES, np.log(np.maximum(share, 1e-9) / (1 - np.minimum(share, 1 - 1e-9))), -np.inf)
    return Model(letters, features, weights, base, least)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    columns = [c for c in docs.columns if c not in ("score", "predicted")]
    schema = docs.select(*columns).schema.add("score", "double")
    shared = spark.sparkContext.broadcast(model)
    text = columns.index("text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        tool = Restorer(m.letters)
        for batch in batches:
            for i, j in pieces(batch.column(text), 1 << 20):
                rows, hashes = tool.words(*text_bytes(batch.column(text)[i:j]))
                odds = np.full(j - i, m.base)
                if len(m.features):
                    at = np.minimum(np.searchsorted(m.features, hashes), len(m.features) - 1)
                    hit = m.features[at] == hashes
                    pairs = np.unique(rows[hit] * len(m.features) + at[hit])
                    np.add.at(odds, pairs // len(m.features), m.weights[pairs % len(m.features)])
                    np.maximum.at(odds, pairs // len(m.features), m.least[pairs % len(m.features)])
                p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
                yield pa.RecordBatch.from_arrays([*(batch.column(k)[i:j] for k in range(len(columns))), pa.array(p)], schema.names)

    scored = docs.select(*columns).mapInArrow(read, schema)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
