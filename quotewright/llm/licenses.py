"""License scans by diagonal voting.

Word k-grams of a text are joined with the places of equal k-grams in license
templates. A text that holds a template has hits on one diagonal, the place in
the text less the place in the template; words put in or left out move it a
little, so neighbouring diagonals are merged before the vote. The vote is as
loose as the edits allow; a word alignment then verifies each merged span.
Version numbers are left out of both.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotewright.llm.common import UPPER, map_batches, row_key, settle

# Phrases and labels of the base rule.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Wording of public licenses that texts carry as notices.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc0", "dedicated to the public domain under CC0 1.0 Universal"),
    ("mit", "Licensed under the MIT License"),
    ("bsd", "Licensed under the BSD License"),
    ("isc", "Licensed under the ISC License"),
    ("mpl-2.0", "Licensed under the Mozilla Public License, Version 2.0"),
    ("lgpl", "Licensed under the GNU Lesser General Public License, version 3"),
    ("cc-by-nc", "CC BY-NC 4.0"),
    ("cc-by-sa", "CC BY-SA 4.0"),
    ("cc-by-nd", "CC BY-ND 4.0"),
    ("cc-by-nc-sa", "CC BY-NC-SA 4.0"),
    ("cc-by-nc-nd", "CC BY-NC-ND 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc-sa", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
)

# Words that name a license, which no edit may touch, and those that make another license of one.
QUALIFIERS = frozenset(b"nc sa nd noncommercial sharealike noderivatives noderivs".split())
NAMES = QUALIFIERS | frozenset(b"apache mit gnu lesser affero mozilla bsd isc cc cc0 commons attribution".split())
VERSION = re.compile(rb"v?[0-9]++|v|version")

GRAM = 2
# Diagonals this near are one; a span has an edit at most for so many words of a template.
NEAR, WORDS_AN_EDIT = 3, 5
CACHE_WORDS = 300_000
FACTOR = np.uint64(0x9E3779B97F4A7C15)

# Every byte that ends a word becomes a space; capitals become small letters.
_ENDS = bytes(b for b in range(0x80) if b < 0x30 or 0x3A <= b <= 0x60 or b > 0x7A)
_TABLE = bytes(
    b + 32 if chr(b) in UPPER else 0x20 if b in _ENDS else b for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    """Lower-cased words: runs of digits, letters and everything beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


class Grams:
    """Hashes of all runs of ``GRAM`` words, versions left out."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        known = self.known
        for word in set(words):
            if word not in known:
                known[word] = 0 if VERSION.fullmatch(word) else xxhash.xxh64_intdigest(word) or 1
        own = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        own = own[own != 0]
        if len(own) < GRAM:
            return np.zeros(0, dtype=np.int64)
        out = own[: len(own) - GRAM + 1].copy()
        for offset in range(1, GRAM):
            out = (out ^ (out >> np.uint64(29))) * FACTOR + own[offset : len(own) - GRAM + 1 + offset]
        return (out ^ (out >> np.uint64(32))).view(np.int64)


def base_places(words: list[bytes]) -> list[tuple[int, str]]:
    """(first word, label) of every place of a base phrase."""
    joined = b" " + b" ".join(words) + b" "
    found = []
    for phrase, label in PHRASES.items():
        sought = f" {phrase} ".encode()
        at, place, counted = joined.find(sought), 0, 0
        while at >= 0:
            place += joined.count(b" ", counted, at)
            counted = at
            found.append((place, label))
            at = joined.find(sought, at + 1)
    return found


def _with_key(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of equal id and text have one key; they have the same result."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (
        documents.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
        .withColumn("text_hash", F.xxhash64("text"))
        .select("doc_id", "text", row_key("doc_id", "text_hash").alias("key"))
    )


def _base(rows: DataFrame) -> DataFrame:
    def start():
        def scan(batch: pa.RecordBatch) -> dict:
            out = {name: [] for name in ("n_words", "n_base", "first_word", "last_word", "base_labels")}
            for text in batch["text"].to_pylist():
                words = words_of(text)
                places = base_places(words)
                starts = [place for place, _ in places]
                out["n_words"].append(len(words))
                out["n_base"].append(len(places))
                out["first_word"].append(min(starts, default=None))
                out["last_word"].append(max(starts, default=None))
                out["base_labels"].append(sorted({label for _, label in places}))
            return {"doc_id": batch["doc_id"], "key": batch["key"], **out}

        return scan

    schema = (
        "doc_id long, key string, n_words long, n_base long, first_word long, last_word long, "
        "base_labels array<string>"
    )
    return map_batches(rows, start, schema)


@dataclass
class Template:
    """A wording without its versions, and how many version words end it."""

    label: str
    words: list[bytes]
    ending: int

    @property
    def edits(self) -> int:
        return len(self.words) // WORDS_AN_EDIT

    @property
    def needed(self) -> int:
        """k-grams that are left whatever the allowed edits are: each breaks ``GRAM`` at most."""
        return max(1, len(self.words) - GRAM + 1 - GRAM * self.edits)


def template_of(label: str, wording: str) -> Template:
    words = words_of(wording)
    kept = [i for i, word in enumerate(words) if not VERSION.fullmatch(word)]
    return Template(label, [words[i] for i in kept], len(words) - 1 - max(kept, default=-1))


def aligned(template: list[bytes], text: list[bytes], edits: int) -> list[tuple[int, int, int]]:
    """(edits, start, end) of the places of a template, the best first and none overlapping.

    A word put in, left out or changed is an edit each; words of ``NAMES`` allow none.
    """
    far = len(template) + len(text) + 1
    left_out = [far if word in NAMES else 1 for word in template]
    column = [(0, 0)]
    for cost in left_out:
        column.append((column[-1][0] + cost, 0))
    found = []
    for place, word in enumerate(text):
        named = far if word in NAMES else 1
        new = [(0, place + 1)]
        for i, own in enumerate(template):
            # Of equal costs the later start, so that nothing is put in before the span.
            cost, start = min(
                (column[i][0] + (0 if own == word else max(named, left_out[i])), -column[i][1]),
                (column[i + 1][0] + named, -column[i + 1][1]),
                (new[i][0] + left_out[i], -new[i][1]),
            )
            new.append((cost, -start))
        column = new
        if column[-1][0] <= edits:
            found.append((column[-1][0], column[-1][1], place + 1))
    # Chosen spans are apart, so only the neighbours by start can be in the way.
    chosen: list[tuple[int, int, int]] = []
    for cost, start, end in sorted(found):
        place = bisect_left(chosen, (start,))
        if place < len(chosen) and chosen[place][0] < end or place and start < chosen[place - 1][1]:
            continue
        chosen.insert(place, (start, end, cost))
    return [(cost, start, end) for start, end, cost in chosen]


def verified(template: Template, words: list[bytes], kept: list[int], first: int, last: int) -> list[tuple[int, int, float]]:
    """(first word, end word, coverage) of the template's places about the hits from first to last.

    ``kept`` are the words of the text that are no versions. A label with a
    version asks for that one, if the text gives any.
    """
    margin = len(template.words) + template.edits
    begin = max(0, first - margin)
    window = [words[i] for i in kept[begin : last + GRAM + margin]]
    version = re.search(r"-([0-9]+)[.0-9]*$", template.label)
    out = []
    for cost, start, end in aligned(template.words, window, template.edits):
        start, end = begin + start, begin + end
        if end < len(kept) and words[kept[end]] in QUALIFIERS:
            continue
        stop = kept[end - 1] + 1
        after = words[stop : kept[end] if end < len(kept) else len(words)]
        given = [word.lstrip(b"v").decode() for word in after if word not in (b"v", b"version")]
        said = len(given) > 1 or len(given) < len(after) or any(word.startswith(b"v") for word in after)
        if version and given and said and given[0] != version[1]:
            continue
        out.append((kept[start], stop + min(template.ending, len(after)), 1 - cost / len(template.words)))
    return out


def template_spans(rows: DataFrame, templates: Iterable[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """key, label, first_word, end_word and coverage of the verified spans of templates.

    ``rows`` have a key and a text. Texts with k-grams enough of any template
    are settled, and their hits of one row, template and diagonal put together
    before the shuffle; diagonals up to ``NEAR`` or the allowed edits apart are
    merged. Where a merged span has the k-grams that the edits must leave,
    the words are aligned. The coverage is the share of words without an edit.
    """
    spark, grams = rows.sparkSession, Grams()
    known = [template_of(label, wording) for label, wording in templates]
    places, sizes = [], []
    for number, template in enumerate(known):
        places += [(gram, number, place) for place, gram in enumerate(grams(template.words).tolist())]
        sizes.append((number, template.needed, max(NEAR, template.edits)))
    # Both have a row per word of the templates at most, which are a list in the driver.
    index = spark.createDataFrame(places, "gram long, template int, template_place int")
    bounds = spark.createDataFrame(sizes, "template int, needed int, near int")
    sought = np.unique(np.array([gram for gram, _, _ in places], np.int64))
    held = np.zeros((len(sought), len(known)), np.int64)
    for gram, number, _ in places:
        held[np.searchsorted(sought, gram), number] += 1
    needed = np.array([template.needed for template in known], np.int64)

    def hash_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts that hold enough k-grams of a template anywhere, with all their k-grams."""
        grams = Grams()
        kinds = pa.schema([("key", pa.string()), ("text", pa.string()), ("grams", pa.list_(pa.int64()))])
        for batch in batches:
            chosen, arrays = [], []
            for place, text in enumerate(batch["text"].to_pylist()):
                own = grams(words_of(text))
                hits = np.isin(sought, own)
                if hits.any() and (held[hits].sum(axis=0) >= needed).any():
                    chosen.append(place)
                    arrays.append(own)
            ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
            values = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))
            own = batch.take(pa.array(chosen, pa.int64()))
            yield pa.RecordBatch.from_arrays([own["key"], own["text"], lists], schema=kinds)

    texts = settle(
        rows.select("key", "text").mapInArrow(hash_all, "key string, text string, grams array<long>"), "license-texts"
    )
    hits = (
        texts.select("key", F.posexplode("grams").alias("place", "gram"))
        .join(F.broadcast(index), "gram")
        .groupBy("key", "template", (F.col("place") - F.col("template_place")).alias("diagonal"))
        .agg(
            F.min("place").alias("first"),
            F.max("place").alias("last"),
            F.collect_set("template_place").alias("held"),
        )
        .join(F.broadcast(bounds), "template")
    )
    along = Window.partitionBy("key", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along) > F.col("near")
    spans = (
        hits.withColumn("apart", F.coalesce(apart, F.lit(False)).cast("int"))
        .withColumn("cluster", F.sum("apart").over(along))
        .groupBy("key", "template", "cluster", "needed")
        .agg(
            F.min("first").alias("first"),
            F.max("last").alias("last"),
            F.size(F.array_distinct(F.flatten(F.collect_list("held")))).alias("held"),
        )
        .filter(F.col("held") >= F.col("needed"))
        .groupBy("key")
        .agg(F.collect_list(F.struct("template", "first", "last")).alias("voted"))
    )

    def start():
        def verify(batch: pa.RecordBatch) -> dict:
            out = {name: [] for name in ("key", "label", "first_word", "end_word", "coverage")}
            for key, text, voted in zip(*(batch[name].to_pylist() for name in ("key", "text", "voted"))):
                words = words_of(text)
                kept = [i for i, word in enumerate(words) if not VERSION.fullmatch(word)]
                for each in voted:
                    template = known[each["template"]]
                    for span in verified(template, words, kept, each["first"], each["last"]):
                        for name, value in zip(out, (key, template.label, *span)):
                            out[name].append(value)
            return out

        return verify

    schema = "key string, label string, first_word long, end_word long, coverage double"
    return map_batches(spans.join(texts.select("key", "text"), "key"), start, schema).distinct()


def scan_licenses(
    documents: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: Iterable[tuple[str, str]] = TEMPLATES,
) -> DataFrame:
    """Words, base places and labels of every whole text, and the labels of template spans.

    Returns doc_id, n_words, n_base, first_word, last_word, base_labels, labels
    and score: the best coverage of a verified span, 1 with a base place, 0 with
    neither. A null or empty text has no words and empty labels. Repeated rows
    have the same result each; null ids stay null; no rows give none; other
    columns are not looked at. The hits of a text go to several tasks by
    template, and no row's k-grams are shuffled unless a template has them.
    """
    rows = _with_key(documents, id_col, text_col)
    base = settle(_base(rows), "license-base")
    found = (
        template_spans(rows, templates)
        .groupBy("key")
        .agg(F.collect_set("label").alias("found"), F.max("coverage").alias("coverage"))
    )
    none = F.array().cast("array<string>")
    every = F.array_sort(F.array_union("base_labels", F.coalesce("found", none)))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("coverage", F.lit(0.0)))
    return base.join(found, "key", "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        score.alias("score"),
    )
