r"""License scan by a positional rare-token index (JVM expressions only).

A template is a license text in words with mandatory key phrases at known word positions. The index
holds one posting per key phrase under the phrase's highest-IDF word; IDF comes from the document
frequencies of the template vocabulary over the whole corpus. A file's words are looked up in the
index, a posting and a file position give the place where the phrase must start, and the phrase's
words are verified there. A template matches if all its key phrases stand at the template's
relative positions, give or take ``slack`` words. As each phrase holds its own index word, no
match can be lost whatever the IDF values; they only choose the cheapest word to look up.

Defined results: a null text has no words; no place gives null first_word and last_word, empty
labels and score 0; repeated rows are scanned one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Separators: every ASCII character but digits and letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Fixed phrases and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


@dataclass(frozen=True)
class Template:
    """``text``: the license's words; ``keys``: its mandatory phrases, each a run of words of ``text``."""

    label: str
    text: str
    keys: tuple[str, ...]

    def places(self) -> list[int]:
        words = self.text.split()
        return [next(i for i in range(len(words)) if words[i:i + len(k.split())] == k.split()) for k in self.keys]


TEMPLATES = (
    Template("agpl", "gnu affero general public license", ("gnu affero general public license",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             ("redistribution and use in source and binary forms", "with or without modification")),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("gpl-2.0", "gnu general public license version 2", ("gnu general public license", "version 2")),
    Template("gpl-3.0", "gnu general public license version 3", ("gnu general public license", "version 3")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee",
             ("permission to use copy modify", "with or without fee")),
    Template("lgpl", "gnu lesser general public license", ("gnu lesser general public license",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy",
             ("permission is hereby granted free of charge", "obtaining a copy")),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license", "v 2 0")),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             ("free and unencumbered software", "public domain")),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def license_words(text: Column) -> Column:
    """Words of digits, letters and non-ASCII characters; A-Z lowered."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATORS), "")


def phrases(templates=TEMPLATES) -> list[str]:
    return list(dict.fromkeys([*BASE_PHRASES, *(k for t in templates for k in t.keys)]))


def document_frequencies(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Documents that hold each word of the (fixed) template vocabulary, over the whole corpus."""
    vocab = F.array(*[F.lit(w) for w in vocabulary])
    rows = (docs.select(F.explode(F.array_intersect(license_words(F.col("text")), vocab)).alias("word"))
            .groupBy("word").count().collect())  # at most one row per vocabulary word
    return {r["word"]: r["count"] for r in rows}


def rare_word_index(docs: DataFrame, templates=TEMPLATES) -> list[tuple[str, int, int, list[str]]]:
    """Postings (index word, phrase number, the word's position in the phrase, the phrase's words)."""
    found = [p.split() for p in phrases(templates)]
    vocabulary = sorted({w for p in found for w in p})
    df = document_frequencies(docs, vocabulary)
    n = max([1, *df.values()])
    idf = {w: math.log((1 + n) / (1 + df.get(w, 0))) for w in vocabulary}
    out = []
    for k, words in enumerate(found):
        at = max(range(len(words)), key=lambda i: (idf[words[i]], len(words[i]), -i))
        out.append((words[at], k, at, words))
    return out


def _places(words: Column, hits: Column, index) -> Column:
    """Verified places: struct(k phrase number, s start word), from the looked-up positions."""
    postings = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(k).alias("k"), F.lit(at).alias("at"),
                                  F.array(*[F.lit(w) for w in ws]).alias("ws")) for a, k, at, ws in index])
    starts = F.flatten(F.transform(hits, lambda h: F.transform(
        F.filter(postings, lambda p: (p["a"] == h["w"]) & (h["i"] >= p["at"])),
        lambda p: F.struct(p["k"].alias("k"), (h["i"] - p["at"]).alias("s"), p["ws"].alias("ws")))))
    return F.transform(F.filter(starts, lambda x: F.slice(words, x["s"] + 1, F.size(x["ws"])) == x["ws"]),
                       lambda x: F.struct(x["k"].alias("k"), x["s"].alias("s")))


def _is(k: int):
    return lambda place: place["k"] == k


def _follows(first: Column, k: int, distance: int, slack: int):
    return lambda y: (y["k"] == k) & (F.abs((y["s"] - first["s"]) - F.lit(distance)) <= slack)


def _aligned(places: Column, template: Template, number: dict[str, int], slack: int) -> Column:
    """True if all key phrases stand at the template's relative positions."""
    at = template.places()
    ids = [number[k] for k in template.keys]
    rest = list(zip(ids[1:], at[1:]))

    def fits(first):
        ok = first["k"] == ids[0]
        for k, pos in rest:
            ok = ok & F.exists(places, _follows(first, k, pos - at[0], slack))
        return ok
    return F.exists(places, fits)


def scan_licenses(docs: DataFrame, templates=TEMPLATES, slack: int = 4) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, places.

    ``score``: the largest share of a template's key phrases that were verified (1 for a base label).
    No shuffle but that of the document frequencies: index and templates are fixed, small literals."""
    index = rare_word_index(docs, templates)
    names = phrases(templates)
    number = {p: k for k, p in enumerate(names)}
    anchors = F.array(*[F.lit(a) for a in sorted({a for a, *_ in index})])
    none = F.array().cast("array<struct<w:string,i:int>>")
    found = docs.select("doc_id", license_words(F.col("text")).alias("words"))
    w = F.col("words")
    found = found.select("doc_id", "words", F.when(F.arrays_overlap(w, anchors), F.filter(
        F.transform(w, lambda x, i: F.struct(x.alias("w"), i.alias("i"))),
        lambda x: F.array_contains(anchors, x["w"]))).otherwise(none).alias("hits"))
    empty = F.array().cast("array<struct<k:int,s:int>>")
    found = found.select("doc_id", F.size("words").cast("long").alias("n_words"), F.when(
        F.size("hits") > 0, _places(F.col("words"), F.col("hits"), index)).otherwise(empty).alias("places"))
    places, n_base = F.col("places"), len(BASE_PHRASES)
    base = F.filter(places, lambda x: x["k"] < n_base)
    base_labels = F.array(*[F.when(F.exists(places, _is(k)), F.lit(label))
                            for k, label in enumerate(BASE_PHRASES.values())])
    own = F.array(*[F.when(_aligned(places, t, number, slack), F.lit(t.label)) for t in templates])
    partial = F.array(*[sum((F.exists(places, _is(number[p])).cast("double") for p in t.keys), F.lit(0.0))
                        / len(t.keys) for t in templates])
    listed = lambda a: F.array_join(F.sort_array(F.array_distinct(F.array_compact(a))), ",")
    some = F.size(places) > 0
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda x: x["s"])).cast("long").alias("first_word"),
        F.array_max(F.transform(base, lambda x: x["s"])).cast("long").alias("last_word"),
        F.when(some, listed(base_labels)).otherwise("").alias("base_labels"),
        F.when(some, listed(F.concat(base_labels, own))).otherwise("").alias("labels"),
        F.when(F.size(base) > 0, 1.0).when(some, F.array_max(partial)).otherwise(0.0).alias("score"),
        "places")


def _oracle() -> str:
    """DuckDB SQL for the scan, phrase by phrase over word lists."""
    names = phrases()
    number = {p: k for k, p in enumerate(names)}
    values = ", ".join(f"({k}, {p.split()!r}, {len(p.split())})" for p, k in number.items())
    aligned = []
    for t in TEMPLATES:
        at, ids = t.places(), [number[k] for k in t.keys]
        rest = "".join(f" AND EXISTS (SELECT 1 FROM hit y WHERE y.rid = x.rid AND y.k = {k} AND abs((y.s - x.s) - {pos - at[0]}) <= 4)"
                       for k, pos in zip(ids[1:], at[1:]))
        aligned.append(f"SELECT x.rid, '{t.label}' AS label FROM hit x WHERE x.k = {ids[0]}{rest}")
    partial = [f"SELECT rid, count(DISTINCT k) / {len(t.keys)}.0 AS share FROM hit WHERE k IN "
               f"({', '.join(str(number[k]) for k in t.keys)}) GROUP BY rid" for t in TEMPLATES]
    base = " UNION ALL ".join(f"SELECT rid, '{label}' AS label FROM hit WHERE k = {k}" for k, label in enumerate(BASE_PHRASES.values()))
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
       regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
ph(k, words, n) AS (VALUES {values}),
pos AS (SELECT rid, ws, unnest(generate_series(1, len(ws))) AS i FROM d),
hit AS (SELECT pos.rid, ph.k, pos.i - 1 AS s FROM pos JOIN ph ON ws[i] = ph.words[1] AND ws[i:i + ph.n - 1] = ph.words),
bl AS ({base}),
al AS (SELECT * FROM bl UNION ALL {" UNION ALL ".join(aligned)}),
sh AS ({" UNION ALL ".join(partial)}),
b AS (SELECT rid, count(*) AS n_base, min(s) AS f, max(s) AS l FROM hit WHERE k < {len(BASE_PHRASES)} GROUP BY rid),
b2 AS (SELECT rid, string_agg(label, ',' ORDER BY label) AS base_labels FROM (SELECT DISTINCT * FROM bl) GROUP BY rid),
a2 AS (SELECT rid, string_agg(label, ',' ORDER BY label) AS labels FROM (SELECT DISTINCT * FROM al) GROUP BY rid),
s2 AS (SELECT rid, max(share) AS share FROM sh GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, f::BIGINT AS first_word, l::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       (CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END)::DOUBLE AS score
FROM d LEFT JOIN b USING (rid) LEFT JOIN b2 USING (rid) LEFT JOIN a2 USING (rid) LEFT JOIN s2 USING (rid)
"""


ORACLE_SQL = _oracle()
