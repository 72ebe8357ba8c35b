"""License scan by a positional index of rare words, in DataFrame functions only.

Every template is a notice with a key phrase that must stand in the text word by word. The
words of the key phrases are looked up in the corpus once, to count in how many
documents each occurs. A phrase is then searched by its two rarest words: their positions in a
document, less their positions in the phrase, are lists of possible beginnings, and only
beginnings in both lists are verified. A document without a rare word is never looked at.
The score is the best share of a template's notice that lies where it should around a
verified phrase. Which words are rare changes the work, never the result.

Defined results: null or empty text has no words, no place, no label and score 0; null ids
are kept; equal rows give equal results; texts of any length are scanned whole; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    phrase: str
    notice: str = ""
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.phrase.split()

    @property
    def around(self) -> list[str]:
        return (self.notice or self.phrase).split()

    @property
    def shift(self) -> int:
        """Where the phrase begins in its notice."""
        n = len(self.words)
        return next(i for i in range(len(self.around)) if self.around[i : i + n] == self.words)


# Phrases and labels of the scan, then further notices by their public wording.
TEMPLATES = (
    Template("gpl", "gnu general public license", "licensed under the gnu general public license version 3", True),
    Template("apache", "apache license", "licensed under the apache license version 2 0", True),
    Template("cc-by", "cc by", "licensed under cc by", True),
    Template("mit", "mit license", "released under the mit license", True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    Template("lgpl", "gnu lesser general public license", "under the terms of the gnu lesser general public license"),
    Template("agpl", "gnu affero general public license", "under the terms of the gnu affero general public license"),
    Template("mpl", "mozilla public license", "subject to the terms of the mozilla public license v 2 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("bsd", "bsd license", "licensed under the bsd license"),
    Template("isc", "isc license", "licensed under the isc license"),
    Template("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    Template("cc-by-sa", "cc by sa", "licensed under cc by sa 4 0"),
    Template("cc-by-nd", "cc by nd", "licensed under cc by nd 4 0"),
    Template("cc-by", "creative commons attribution", "licensed under a creative commons attribution 4 0 international license"),
    Template("unlicense", "free and unencumbered software released into the public domain"),
)


def words_of(text: Column) -> Column:
    """The lower-case words of a text, ASCII letters lowered only."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORDS), F.lit(0))


def document_counts(docs: DataFrame, vocabulary: list[str], text: str = "text") -> dict[str, int]:
    """In how many documents each licence word occurs. At most one row for each word returns."""
    found = F.array_intersect(words_of(F.col(text)), F.array(*map(F.lit, vocabulary)))
    rows = docs.select(F.explode(found).alias("word")).groupBy("word").count().collect()
    return {r["word"]: r["count"] for r in rows}


def rarest(template: Template, counts: dict[str, int], most: int = 2) -> list[tuple[int, str]]:
    """Place and word of a phrase's words of highest inverse document frequency."""
    places = {w: i for i, w in reversed(list(enumerate(template.words)))}
    return sorted(((i, w) for w, i in places.items()), key=lambda x: (counts.get(x[1], 0), x[0]))[:most]


def _array(words: list[str]) -> Column:
    return F.array(*map(F.lit, words))


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, matches): every verified place of every template.

    ``matches`` is an array of (template number, start word, score).
    """
    counts = document_counts(docs, sorted({w for t in templates for w in t.words}), text)
    anchors = [rarest(t, counts) for t in templates]
    first = sorted({a[0][1] for a in anchors})
    every = sorted({w for a in anchors for _, w in a})

    tokens = docs.select(F.col(doc_id).alias("doc_id"), words_of(F.col(text)).alias("words"))
    # Places of rare words, only where some phrase's rarest word occurs.
    places = F.filter(
        F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("word"))), lambda x: x["word"].isin(every)
    )
    none = F.array().cast("array<struct<at:int,word:string>>")
    tokens = tokens.withColumn("places", F.when(F.arrays_overlap("words", _array(first)), places).otherwise(none))

    def beginnings(place: int, word: str) -> Column:
        return F.transform(F.filter("places", lambda x: x["word"] == word), lambda x: x["at"] - place)

    def matches(k: int, t: Template) -> Column:
        starts = beginnings(*anchors[k][0])
        for place, word in anchors[k][1:]:
            starts = F.array_intersect(starts, beginnings(place, word))
        n, around, shift = len(t.words), t.around, t.shift
        sure = F.filter(starts, lambda s: (s >= 0) & (F.slice(F.col("words"), F.greatest(s, F.lit(0)) + 1, F.lit(n)) == _array(t.words)))

        def score(s: Column) -> Column:
            low = F.greatest(s - shift, F.lit(0))
            here = F.slice(F.col("words"), low + 1, F.lit(len(around)) - (low - (s - shift)))
            # The notice's part from the text's beginning on, if the notice would begin before it.
            want = F.slice(_array(around), low - (s - shift) + 1, F.lit(len(around)))
            same = F.zip_with(here, want, lambda a, b: F.when(a == b, 1).otherwise(0))
            return F.aggregate(same, F.lit(0), lambda x, y: x + F.coalesce(y, F.lit(0))) / F.lit(float(len(around)))

        return F.transform(sure, lambda s: F.struct(F.lit(k).alias("template"), s.alias("start"), score(s).alias("score")))

    found = F.concat(*(matches(k, t) for k, t in enumerate(templates)))
    empty = F.array().cast("array<struct<template:int,start:int,score:double>>")
    return tokens.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.when(F.size("places") > 0, found).otherwise(empty).alias("matches"),
    )


def summary(scanned: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row for each document: counts and labels of base phrases, labels and score of all."""
    base = [k for k, t in enumerate(templates) if t.base]
    names = _array([t.label for t in templates])
    based = F.filter("matches", lambda m: m["template"].isin(base))

    def labels(found: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda m: F.element_at(names, m["template"] + 1)))), ",")

    starts = F.transform(based, lambda m: m["start"])
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(based).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        labels(based).alias("base_labels"),
        labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["score"])), F.lit(0.0)).alias("score"),
    )


def oracle(templates: tuple[Template, ...] = TEMPLATES) -> str:
    """The scan in DuckDB SQL: every phrase is tried at every word."""

    def words(ws: list[str]) -> str:
        return "[" + ", ".join(f"'{w}'" for w in ws) + "]"

    def starts(t: Template) -> str:
        n = len(t.words)
        return f"list_filter(range(0, len(w) - {n - 1}), lambda s: list_slice(w, s + 1, s + {n}) = {words(t.words)})"

    def score(t: Template, k: int) -> str:
        around = words(t.around)
        same = f"list_sum(list_transform(range(0, {len(t.around)}), lambda i: case when s - {t.shift} + i >= 0 and w[s - {t.shift} + i + 1] = ({around})[i + 1] then 1 else 0 end))"
        return f"coalesce(list_max(list_transform(p{k}, lambda s: {same})), 0) / {float(len(t.around))}"

    base = [k for k, t in enumerate(templates) if t.base]
    both = " || ".join(f"p{k}" for k in base)

    def labels(ks: list[int]) -> str:
        each = ", ".join(f"case when len(p{k}) > 0 then '{templates[k].label}' end" for k in ks)
        return f"array_to_string(list_sort(list_distinct(list_filter([{each}], lambda x: x is not null))), ',')"

    everything = list(range(len(templates)))
    return f"""
with t as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORDS}') as w from documents),
p as (select doc_id, w, {", ".join(f"{starts(t)} as p{k}" for k, t in enumerate(templates))} from t)
select doc_id, cast(len(w) as bigint) as n_words, cast(len({both}) as bigint) as n_base,
  list_min({both}) as first_word, list_max({both}) as last_word,
  {labels(base)} as base_labels, {labels(everything)} as labels,
  greatest({", ".join(score(t, k) for k, t in enumerate(templates))}) as score
from p
"""
