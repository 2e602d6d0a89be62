"""License scans by a positional rare-token index.

Document frequencies over the corpus rank the words of all licence templates.
The index posts each template under the highest-IDF word of its mandatory key
phrase, with the word's position. A file is looked up by those of its words
that are in the index, which are its highest-IDF licence words: every posting
gives a template and an implied start; the template's next rarest key word
has to stand at the same start, and the key phrase is then verified word by
word there. The plan has one size for any number of templates, and the work
for a file grows with its rare licence words, not with the templates. The
score is the IDF-weighted share of the template's words that stand in their
places around the phrase. DataFrame functions only; a file is handled within
its row, and only the frequencies of the fixed licence words are shuffled.

Defined cases: a null text is empty and has no word and no label; rows that
repeat a doc_id are scanned each by itself; an empty table gives no rows."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listenlab.llm.shared import packed, unpacked

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    #: where the mandatory key phrase stands in ``words``
    key_at: int
    key_size: int
    base: bool = False

    @property
    def key(self) -> tuple[str, ...]:
        return self.words[self.key_at:self.key_at + self.key_size]


def template(label: str, text: str, key: str, base: bool = False) -> Template:
    words, phrase = tuple(text.split()), tuple(key.split())
    at = next(i for i in range(len(words)) if words[i:i + len(phrase)] == phrase)
    return Template(label, words, at, len(phrase), base)


TEMPLATES = (
    template("cc-by", "licensed under cc by", "cc by", base=True),
    template("gpl", "this work is licensed under the gnu general public license version", "general public license", base=True),
    template("reserved", "all rights reserved", "all rights reserved", base=True),
    template("mit", "released under the mit license", "mit license"),
    template("mit", """permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation
        files the software to deal in the software without restriction including without limitation the rights to use copy modify merge
        publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so
        subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the software""", "permission is hereby granted free of charge"),
    template("apache", "licensed under the apache license version", "apache license"),
    template("apache", """licensed under the apache license version 2 0 the license you may not use this file except in compliance with the
        license you may obtain a copy of the license at""", "you may not use this file except in compliance"),
    template("lgpl", "gnu lesser general public license", "lesser general public license"),
    template("agpl", "gnu affero general public license", "affero general public license"),
    template("gpl", """this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as
        published by the free software foundation""", "is free software you can redistribute it and or modify"),
    template("mpl", "mozilla public license version", "mozilla public license"),
    template("epl", "eclipse public license", "eclipse public license"),
    template("bsd", "licensed under the bsd license", "bsd license"),
    template("bsd", """redistribution and use in source and binary forms with or without modification are permitted provided that the following
        conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following
        disclaimer""", "redistribution and use in source and binary forms"),
    template("isc", """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided
        that the above copyright notice and this permission notice appear in all copies""", "permission to use copy modify"),
    template("zlib", """this software is provided as is without any express or implied warranty in no event will the authors be held liable for any
        damages arising from the use of this software permission is granted to anyone to use this software for any purpose""",
             "in no event will the authors be held liable"),
    template("cc-by-sa", "licensed under cc by sa", "cc by sa"),
    template("cc-by-nc", "licensed under cc by nc", "cc by nc"),
    template("cc-by-nd", "licensed under cc by nd", "cc by nd"),
    template("cc0", "cc0 universal public domain dedication", "cc0"),
    template("cc", "creative commons attribution license", "creative commons"),
    template("unlicense", """this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile
        sell or distribute this software""", "free and unencumbered software"),
)


def words_of(text: Column) -> Column:
    """Words of the text with A-Z in lower case. ``lower`` also changes other
    letters, which can't make or break a word of ASCII letters but for the
    Kelvin sign, whose lower case is k: that one is replaced first."""
    body = F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ"))
    return F.regexp_extract_all(F.lower(body), F.lit(WORD), F.lit(0))


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def word_frequencies(docs: DataFrame, text: str = "text",
                     templates: tuple[Template, ...] = TEMPLATES) -> tuple[int, dict[str, int]]:
    """Number of documents, and how many hold each licence word. The licence
    words are those of the templates, so the result has a fixed size."""
    vocabulary = sorted({w for t in templates for w in t.words})
    found = docs.select(F.explode(F.concat(
        F.array_intersect(words_of(F.col(text)), _strings(vocabulary)), _strings([""]))).alias("word"))
    counts = {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return counts.pop("", 0), counts


def index(templates: tuple[Template, ...], idf: dict[str, float]) -> dict[str, list[tuple[int, int, int]]]:
    """Postings (template, position in its key phrase, position of the phrase's
    next rarest word) under the rarest word of each key phrase."""
    posted: dict[str, list[tuple[int, int, int]]] = {}
    for k, t in enumerate(templates):
        rare = sorted(range(t.key_size), key=lambda i: (-idf[t.key[i]], i))
        posted.setdefault(t.key[rare[0]], []).append((k, rare[0], rare[min(1, len(rare) - 1)]))
    return posted


def scan(docs: DataFrame, text: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """``docs`` with ``n_words`` and ``licenses``: one struct per verified
    place with label, start (of the key phrase, in words), base, score."""
    total, counts = word_frequencies(docs, text, templates)
    idf = {w: math.log((1 + total) / (1 + counts.get(w, 0))) + 1.0 for t in templates for w in t.words}
    posted = index(templates, idf)
    postings = F.create_map(*[c for w, held in sorted(posted.items()) for c in (F.lit(w), F.array(*[
        F.struct(F.lit(k).alias("template"), F.lit(at).alias("at"), F.lit(other).alias("other")) for k, at, other in held]))])
    catalogue = F.array(*[F.struct(
        F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), _strings(t.words).alias("words"), F.lit(t.key_at).alias("key_at"),
        _strings(t.key).alias("key"), F.array(*[F.lit(idf[w]) for w in t.words]).alias("idf"), F.lit(sum(idf[w] for w in t.words)).alias("whole"))
        for t in templates])
    none = F.array().cast("array<struct<label:string,start:int,base:boolean,score:double>>")

    def score(ws: Column, t: Column, start: Column) -> Column:
        first = start - t["key_at"]
        here = F.zip_with(F.transform(t["words"], lambda w, k: F.get(ws, first + k) == w), t["idf"], lambda same, v: F.when(same, v).otherwise(0.0))
        return F.aggregate(here, F.lit(0.0), lambda acc, v: acc + v) / t["whole"]

    def verified(ws: Column, at: Column, posting: Column) -> Column:
        t, start = F.get(catalogue, posting["template"]), at - posting["at"]
        fits = (start >= 0) & (F.get(ws, start + posting["other"]) == F.get(t["key"], posting["other"]))
        fits &= F.slice(ws, F.greatest(start, F.lit(0)) + 1, F.size(t["key"])) == t["key"]
        return F.when(fits, F.struct(t["label"].alias("label"), start.alias("start"), t["base"].alias("base"), score(ws, t, start).alias("score")))

    def in_row(ws: Column) -> Column:
        rare = F.filter(F.transform(ws, lambda w, i: F.when(w.isin(*posted), F.struct(w.alias("word"), i.alias("at")))), lambda h: h.isNotNull())
        found = F.transform(rare, lambda h: F.transform(F.element_at(postings, h["word"]), lambda p: verified(ws, h["at"], p)))
        return F.filter(F.flatten(found), lambda p: p.isNotNull())

    cut = packed(docs, text, license_words=words_of(F.col(text)))
    words = F.col("license_words")
    # the words are bound once per row by a transform over one element
    bound = F.element_at(F.transform(F.array(words), in_row), 1)
    return unpacked(cut, docs.columns, text, n_words=F.size(words).cast("long"),
                    licenses=F.when(F.arrays_overlap(words, _strings(sorted(posted))), bound).otherwise(none))


def joined_labels(places: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
