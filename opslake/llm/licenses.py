"""License scans: a positional rare-token index, DataFrame functions only.

The index lists, for each template, its rarest words (highest IDF over all
documents) with their positions. A file looks up every word of it that the index
holds; every posting votes for (template, position in the file less
position in the template). A place with two or more votes, or all the template's
postings, is aligned with the template word by word; the share of template words
that match is its score. A label needs the score and the template's mandatory
phrases at their places. Base labels come from fixed phrases.

Scale: two scans of the texts and no shuffle of them. IDF is one count per
licence word (a few hundred rows, partially aggregated); the index is a literal
of that size. All verification is row-local.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.llm._common import ascii_lower, read_table

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Fixed values of the contract: phrase and label.
PHRASES = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]
# Label, opening or grant text of public licences, mandatory phrases of it.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction", ["permission is hereby granted free of charge"]),
    ("apache", "licensed under the apache license version 2 0", ["apache license"]),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
     "the free software foundation", ["gnu general public license"]),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as "
     "published by the free software foundation", ["gnu lesser general public license"]),
    ("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license as "
     "published by the free software foundation", ["gnu affero general public license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted provided that the above copyright notice and this permission notice appear in all copies",
     ["with or without fee is hereby granted"]),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["released into the public domain"]),
    ("cc0", "to the extent possible under law the person has waived all copyright and related or neighboring rights to this "
     "work", ["waived all copyright and related or neighboring rights"]),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
     ["creative commons attribution"]),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license",
     ["creative commons attribution sharealike"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("gpl", "licensed under the gnu general public license", ["gnu general public license"]),
]
RARE = 4          # postings of a template
MIN_SCORE = 0.8


def words_of(text: Column) -> Column:
    """Runs of digits, letters and non-ASCII characters of the lower-cased text."""
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS), "")


def vocabulary(templates: list) -> list[str]:
    return sorted({w for _, t, _ in templates for w in t.split()})


def document_frequencies(files: DataFrame, templates: list) -> tuple[int, dict[str, int]]:
    """Documents, and documents that hold each licence word (bounded by the templates)."""
    have = F.array_intersect("words", F.array(*[F.lit(w) for w in vocabulary(templates)]))
    rows = files.select(F.explode(F.concat(have, F.array(F.lit("")))).alias("w")).groupBy("w").count().collect()
    counts = {r["w"]: r["count"] for r in rows}
    return counts.pop("", 0), counts


def rare_words(templates: list, total: int, counts: dict[str, int]) -> tuple[list, dict[str, float]]:
    """Postings (word, template, position) of each template's rarest words, and IDF by word."""
    idf = {w: math.log((total + 1) / (counts.get(w, 0) + 1)) for w in vocabulary(templates)}
    postings = []
    for t, (_, text, _) in enumerate(templates):
        words = text.split()
        rarest = sorted(range(len(words)), key=lambda p: (-idf[words[p]], words[p], p))[:RARE]
        postings += [(words[p], t, p) for p in sorted(rarest)]
    return postings, idf


def _at(words: str, start, phrase: list[str]) -> Column:
    """The phrase's words stand consecutively from ``start``."""
    test = F.lit(True)
    for k, w in enumerate(phrase):
        test = test & F.coalesce(F.get(words, start + k) == w, F.lit(False))
    return test


def _places(phrase: str) -> Column:
    """Starts of the phrase in ``words``; the words are only walked where the
    space-joined text holds the phrase."""
    w = phrase.split()
    starts = F.filter(F.transform("words", lambda x, i: F.when((x == w[0]) & _at("words", i, w), i)), lambda i: i.isNotNull())
    return F.when(F.contains("joined", F.lit(f" {phrase} ")), starts).otherwise(F.array().cast("array<int>"))


def scan_licenses(docs: DataFrame, templates: list = TEMPLATES, phrases: list = PHRASES, min_score: float = MIN_SCORE,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word,
    last_word, base_labels, labels, score, matches (label, start, score).

    ``score`` is the best template's share of matching words, 0 without any.

    Defined cases: null texts count as empty; null ids and repeated rows stay
    rows; very long texts are scanned whole; an empty table gives an empty
    result; extra columns are ignored."""
    files = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                        words_of(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))).alias("words"))
    postings, _ = rare_words(templates, *document_frequencies(files, templates))
    indexed = sorted({w for w, _, _ in postings})
    # The file's own words in the index: all of them, bounded by the templates' postings.
    mine = F.array_intersect(F.array(*[F.lit(w) for w in indexed]), F.col("words"))
    f = files.select("*", mine.alias("rare"), F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")).alias("joined"))
    for k, (phrase, _) in enumerate(phrases):
        f = f.withColumn(f"p{k}", _places(phrase))

    # Templates of one posting, for which one vote is all; and those of which one word may be enough for two votes.
    held = [[w for w, at, _ in postings if at == t] for t in range(len(templates))]
    single = [t for t, ws in enumerate(held) if len(ws) == 1]
    least = 1 if single or any(len(set(ws)) < len(ws) for ws in held) else 2

    # (template, offset) votes of the looked-up words' places.
    by_word: dict[str, list] = {}
    for w, t, p in postings:
        by_word.setdefault(w, []).append((t, p))
    spots = F.filter(F.transform("words", lambda w, i: F.when(w.isin(indexed), F.struct(w.alias("w"), i.alias("i")))),
                     lambda x: x.isNotNull())
    f = f.select("*", F.when(F.size("rare") >= least, spots).alias("spots")).drop("joined")

    def votes(x: Column) -> Column:
        out = F.array().cast("array<struct<t:int,o:int>>")
        for w, where in by_word.items():
            here = F.array(*[F.struct(F.lit(t).alias("t"), (x["i"] - p).cast("int").alias("o")) for t, p in where])
            out = F.when(x["w"] == w, here).otherwise(out)
        return out

    f = f.select("*", F.array_sort(F.flatten(F.transform("spots", votes))).alias("votes")).drop("spots")
    # Two postings of one template agree on the offset: equal neighbours in the sorted votes.
    enough = lambda v, i: F.coalesce(F.get("votes", i - 1) == v, F.lit(False)) | v["t"].isin(single)
    agree = F.array_distinct(F.filter("votes", enough))
    f = f.select("*", agree.alias("agree")).drop("votes")

    def verified(v: Column) -> Column:
        out = F.lit(None).cast("struct<label:string,start:int,score:double>")
        for t, (label, text, mandatory) in enumerate(templates):
            words = text.split()
            same = sum((F.coalesce(F.get("words", v["o"] + k) == w, F.lit(False)).cast("int") for k, w in enumerate(words)), F.lit(0))
            keys = F.lit(True)
            for phrase in mandatory:
                key = phrase.split()
                at = next(k for k in range(len(words)) if words[k:k + len(key)] == key)
                keys = keys & _at("words", v["o"] + at, key)
            share = same / float(len(words))
            out = F.when((v["t"] == t) & keys, F.struct(F.lit(label).alias("label"), v["o"].alias("start"),
                                                       share.alias("score"))).otherwise(out)
        return out

    found = F.filter(F.transform("agree", verified), lambda m: m.isNotNull() & (m["score"] >= min_score))
    f = f.select("*", F.coalesce(found, F.array().cast("array<struct<label:string,start:int,score:double>>")).alias("matches"))
    places = F.concat(*[F.col(f"p{k}") for k in range(len(phrases))])
    base = F.array_compact(F.array(*[F.when(F.size(f"p{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(phrases)]))
    f = f.select("doc_id", "words", "matches", places.alias("places"), base.alias("base"))
    text = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    own = F.transform("matches", lambda m: m["label"])
    return f.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        text(F.col("base")).alias("base_labels"), text(F.concat("base", own)).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["score"])), F.lit(0.0)).alias("score"), "matches")


def op10_license_scan(spark, sf_dir: str) -> DataFrame:
    """Contract query over all documents."""
    return scan_licenses(read_table(spark, sf_dir, "documents"))
