"""License scans: phrases, and an exact set-similarity join of text blocks with license templates.

A block is a run of consecutive words of a text, ``stretch`` times as many as the template has (the whole text, if
that is shorter). Lines play no part, so a notice is found however it is wrapped. Block and template are compared as
sets of words; a block matches when it holds at least ``threshold`` of the template's. Every start in the text is
a block. Neighbouring starts that all match are one match, given by the first start and the best containment. The
join finds every match:

1. One pass counts, over all documents, how many hold each template word. The words are ordered
   from rare to frequent; the table has one row per template word whatever the size of the data.
2. A template is indexed by its prefix: as many of its rarest words as a matching block cannot
   miss all of. A text reaches a template only through such a word (prefix filter), if it holds enough
   template words at all (length filter), and if enough words can follow the place of the shared
   one in both orders (positional filter): what holds for a block holds for its text.
3. Blocks are counted only around the places of prefix words, where enough different words of the template stand.

The templates are a parameter and few (a few kilobytes), so their index goes to every task.

Null and empty texts have no words and no matches. Rows are treated one by one: repeated rows and
null ids each give a result. An empty table gives an empty result. Only ``id_col`` and ``text_col``
are read.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

from tideline.llm.common import table

# Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Sentences of widely used licenses and their labels.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files, to deal in the Software without restriction"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of "
               "the License at"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the "
            "GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
            "fee is hereby granted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)
THRESHOLD = 0.8
STRETCH = 1.5

# Bytes of words keep their value, A-Z become small; all others separate words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b in range(48, 58) or b in range(97, 123) or b > 127
              else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


def places(found: list[bytes], phrase: list[bytes]) -> list[int]:
    """Where the phrase's words stand consecutively."""
    joined, wanted = b" %b " % b" ".join(found), b" %b " % b" ".join(phrase)
    out, at = [], joined.find(wanted)
    while at >= 0:
        out.append(at)
        at = joined.find(wanted, at + 1)
    # A place's word number is the number of separators before it.
    number, last = 0, 0
    for i, at in enumerate(out):
        number += joined.count(b" ", last, at)
        out[i], last = number, at
    return out


class Index:
    """Templates by the rarest words that a matching block cannot all miss."""

    def __init__(self, templates: Sequence[tuple[str, str]], counts: dict[bytes, int], threshold: float,
                 stretch: float = STRETCH):
        lists = [(label, words(text)) for label, text in templates]
        order = sorted(set().union(*(found for _, found in lists)), key=lambda w: (counts.get(w, 0), w)) if lists else []
        self.rank = {w: i for i, w in enumerate(order)}
        self.templates, self.prefixes = [], defaultdict(list)
        for label, found in lists:
            if not found:
                raise ValueError(f"a template of {label} has no words")
            held = set(found)
            need = max(1, math.ceil(threshold * len(held) - 1e-9))
            number = len(self.templates)
            prefix = sorted(held, key=self.rank.get)[:len(held) - need + 1]
            self.templates.append((label, held, need, frozenset(prefix), max(1, math.ceil(stretch * len(found) - 1e-9))))
            for i, w in enumerate(prefix):
                self.prefixes[w].append((number, i))

    def matches(self, found: list[bytes]) -> list[tuple[int, int, float]]:
        """(template, first word of the first block, best containment) of every match."""
        if not self.prefixes or self.prefixes.keys().isdisjoint(found):
            return []
        known = sorted(self.rank.keys() & set(found), key=self.rank.get)
        reached = set()
        for j, word in enumerate(known):
            for number, i in self.prefixes.get(word, ()):
                # The first word shared decides; later ones leave less.
                if number not in reached:
                    _, held, need, _, _ = self.templates[number]
                    reached.add(number if min(len(held) - i, len(known) - j) >= need else -1)
        reached.discard(-1)
        if not reached:
            return []
        spots = [(at, word) for at, word in enumerate(found) if word in self.rank]
        out = []
        for number in sorted(reached):
            _, held, need, prefix, size = self.templates[number]
            own = [spot for spot in spots if spot[1] in held]
            out += [(number, at, most / len(held))
                    for at, most in _blocks(own, prefix, need, size, max(0, len(found) - size))]
        return out


def _blocks(spots: list[tuple[int, bytes]], prefix: frozenset[bytes], need: int, size: int,
            last: int) -> Iterator[tuple[int, int]]:
    """(first start, most words) of each run of starts whose ``size`` words hold ``need`` of those at ``spots``."""
    # Starts of blocks that hold a prefix word, as ranges.
    ranges = []
    for at, word in spots:
        if word in prefix:
            low, high = max(0, at - size + 1), min(last, at)
            if ranges and low <= ranges[-1][1] + 1:
                ranges[-1][1] = high
            elif low <= high:
                ranges.append([low, high])
    for low, high in ranges:
        near = spots[bisect_left(spots, (low, b"")):bisect_left(spots, (high + size, b""))]
        if len({word for _, word in near}) < need:
            continue
        # Only where a word enters or leaves does the count change.
        starts = {low} | {s for at, _ in near for s in (at - size + 1, at + 1) if low < s <= high}
        inside, entered, left, run = Counter(), 0, 0, None
        for start in sorted(starts):
            while entered < len(near) and near[entered][0] < start + size:
                inside[near[entered][1]] += 1
                entered += 1
            while left < entered and near[left][0] < start:
                inside[near[left][1]] -= 1
                if not inside[near[left][1]]:
                    del inside[near[left][1]]
                left += 1
            if len(inside) >= need:
                run = (run[0], max(run[1], len(inside))) if run else (start, len(inside))
            elif run:
                yield run
                run = None
        if run:
            yield run


def word_counts(docs: DataFrame, templates: Sequence[tuple[str, str]], text_col: str = "text") -> dict[bytes, int]:
    """For each word of the templates, the number of documents that hold it; one row per word."""
    wanted = frozenset().union(*(words(text) for _, text in templates))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in batches:
            for value in batch.column(0):
                counts.update(wanted.intersection(words(value.as_py())))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    found = docs.select(text_col).mapInArrow(counted, "word binary, n long")
    return {bytes(r.word): r.n for r in found.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES,
         threshold: float = THRESHOLD, stretch: float = STRETCH) -> DataFrame:
    """One row per document: id, ``n_words``, ``phrases`` (label, word) and ``matches`` of templates.

    A match names its label, its template's number, the first word of the block and the containment.
    """
    index = Index(templates, word_counts(docs, templates, text_col), threshold, stretch)
    wanted = [(label, words(phrase)) for phrase, label in phrases.items()]
    schema = StructType([
        StructField("__id", docs.schema[id_col].dataType), StructField("n_words", LongType()),
        StructField("phrases", ArrayType(StructType([
            StructField("label", StringType()), StructField("word", LongType())]))),
        StructField("matches", ArrayType(StructType([
            StructField("label", StringType()), StructField("template", IntegerType()),
            StructField("word", LongType()), StructField("containment", DoubleType())])))])
    arrow = to_arrow_schema(schema)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, hits, matches = [], [], []
            for value in batch.column(1):
                found = words(value.as_py())
                sizes.append(len(found))
                hits.append([{"label": label, "word": at} for label, phrase in wanted for at in places(found, phrase)])
                matches.append([{"label": index.templates[n][0], "template": n, "word": at, "containment": share}
                                for n, at, share in index.matches(found)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(arrow.field(0).type), pa.array(sizes, pa.int64()),
                 pa.array(hits, arrow.field(2).type), pa.array(matches, arrow.field(3).type)], schema=arrow)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(scanned, schema).withColumnRenamed("__id", id_col)


def op8_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Phrase places and license labels of all documents.

    ``score`` is 1 where a phrase stands, else the best containment of a matching template, else 0.
    """
    def joined(*labels) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.concat(*labels))), ",")

    return scan(table(spark, folder, "documents")).select(
        "doc_id", "n_words", F.size("phrases").cast("long").alias("n_base"),
        F.array_min("phrases.word").alias("first_word"), F.array_max("phrases.word").alias("last_word"),
        joined(F.col("phrases.label")).alias("base_labels"),
        joined(F.col("phrases.label"), F.col("matches.label")).alias("labels"),
        F.when(F.size("phrases") > 0, 1.0)
        .otherwise(F.coalesce(F.array_max("matches.containment"), F.lit(0.0))).alias("score"))
