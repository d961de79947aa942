"""License scans: exact set-similarity join of text blocks with license templates, and plain phrases. JVM side only.

A template of L words meets blocks of 2 L words that start at every L-th word of a text, so that any L consecutive words
stand in one block, wherever lines break. Tokens are ordered by their frequency in the corpus, rarest first. The
texts' words meet a table of the templates' prefixes (their rarest tokens); length and positional filters thin the
candidate blocks, and the sets of the rest are compared."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, broadcast_if_small, whole_text, written

#: Phrases whose words stand consecutively, with their labels. Fixed values.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Notices (lower case, words only), with their labels. Fixed values.
TEMPLATES = {
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
    "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense "
    "and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain "
    "a copy of the license at": "apache-2",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without "
    "warranties or conditions of any kind either express or implied": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of "
    "merchantability or fitness for a particular purpose see the gnu general public license for more details": "gpl",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the "
    "above copyright notice and this permission notice appear in all copies": "isc",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "reserved",
}

#: Part of a template's different words that a block must have.
THRESHOLD = 0.85

#: What stands between words: ASCII but digits and letters. Text is lower-cased before.
NO_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), NO_WORD), "")


@dataclass(frozen=True)
class Template:
    label: str
    length: int  # words, repeats included; a block has twice as many
    tokens: tuple[str, ...]  # different words, rarest in the corpus first
    need: int  # so many of them a block must have

    @property
    def prefix(self) -> tuple[str, ...]:
        """A block that lacks all of these has too few of the others."""
        return self.tokens[: len(self.tokens) - self.need + 1]


def text_key(text: Column) -> list[Column]:
    """Two hashes of a text, together 128 bits: equal texts have equal labels, so these stand for the row."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def small_table(docs: DataFrame, rows: list[dict], schema: str) -> DataFrame:
    """A table of parameters, made by the JVM from a literal."""
    return docs.sparkSession.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def frequencies(docs: DataFrame, tokens: list[str], text_col: str) -> dict[str, int]:
    """How often each of the templates' tokens stands in all texts; one number for each reaches the driver."""
    known = small_table(docs, [{"token": t} for t in tokens], "token string")
    found = docs.select(F.explode(words_of(whole_text(text_col))).alias("w")).join(F.broadcast(known), F.col("w") == F.col("token")).groupBy("token").count()
    return dict.fromkeys(tokens, 0) | {r["token"]: r["count"] for r in found.collect()}


def ordered(templates: dict[str, str], threshold: float, frequency: dict[str, int]) -> list[Template]:
    out = []
    for text, label in templates.items():
        words = text.split()
        tokens = tuple(sorted(set(words), key=lambda w: (frequency[w], w)))
        out.append(Template(label, len(words), tokens, math.ceil(threshold * len(tokens) - 1e-9)))
    return out


def matching_blocks(docs: DataFrame, templates: list[Template], order: list[str], text_col: str) -> DataFrame:
    """h1, h2, label and share for each block and template that meet the threshold. order: all tokens, rarest first.

    Both block and prefix table are sets in the one global order, the block's reduced to tokens of any template. A
    block is judged where its first shared token stands for the first time, so no shuffle is needed to judge it once."""
    rows = [{"token": token, "label": t.label, "length": t.length, "need": t.need, "i": i, "tokens": t.tokens} for t in templates for i, token in enumerate(t.prefix)]
    prefixes = small_table(docs, rows, "token string, label string, length int, need int, i int, tokens array<string>")
    texts = docs.select(whole_text(text_col).alias("text")).select(*text_key(F.col("text")), words_of(F.col("text")).alias("ws"))
    met = texts.select("h1", "h2", "ws", F.posexplode("ws").alias("at", "w")).join(F.broadcast(prefixes), F.col("w") == F.col("token"))
    number = F.explode(F.expr("if(at >= length, array(at div length, at div length - 1), array(at div length))"))
    met = met.withColumn("k", number).withColumn("block", F.expr("slice(ws, cast(k * length + 1 as int), 2 * length)")).drop("ws")
    first = (F.expr("array_position(block, token) = at - k * length + 1")) & (F.expr("get(array_intersect(tokens, block), 0) = token"))
    universe = F.array(*map(F.lit, order))
    met = met.filter(first).withColumn("held", F.array_intersect(universe, F.col("block")))
    long_enough = F.expr("size(held) >= need")
    positions = F.expr("1 + least(size(tokens) - i - 1, size(held) - array_position(held, token)) >= need")
    shared = F.size(F.array_intersect("tokens", "held"))
    met = met.filter(long_enough & positions).withColumn("shared", shared).filter("shared >= need")
    return met.select("h1", "h2", "label", (F.col("shared") / F.size("tokens").cast("double")).alias("share"))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """One row per row of docs: n_words, places of the phrases (n_base, first_word, last_word, base_labels), labels with
    those of the templates, score (largest containment; 1 where a phrase stands).

    Null text counts as empty: no words, no labels (empty strings), score 0. Equal texts get equal results; a text of any
    length or number of copies spreads over its words and tasks, and only the templates, which are parameters, travel.
    Null ids and repeated rows stay; extra columns are ignored; an empty table gives an empty result."""
    tokens = sorted({w for t in templates for w in t.split()})
    frequency = frequencies(docs, tokens, text_col)
    order = sorted(tokens, key=lambda w: (frequency[w], w))
    hits = matching_blocks(docs, ordered(templates, threshold, frequency), order, text_col)
    # At most a label and a share for each label of the templates are gathered for a text.
    found = hits.groupBy("h1", "h2", "label").agg(F.max("share").alias("share")).groupBy("h1", "h2").agg(F.collect_list("label").alias("found"), F.max("share").alias("share"))
    found = broadcast_if_small(written(found.select(F.col("h1").alias("f1"), F.col("h2").alias("f2"), "found", "share"), "licenses"))

    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("l_text"))
    # Each word stands between its own two spaces, so that places of a phrase can be cut out without touching others.
    spaced = F.regexp_replace(ascii_lower(F.col("l_text")), NO_WORD, "  ")
    rows = rows.withColumn("l_trim", F.trim(spaced))
    rows = rows.withColumn("l_words", F.when(F.col("l_trim") == "", F.lit("")).otherwise(F.concat(F.lit(" "), F.col("l_trim"), F.lit(" "))))
    words_in = lambda s: F.when(F.length(s) == 0, F.lit(0)).otherwise(F.size(F.split(s, "  ")))
    places = {}
    for phrase in phrases:
        spread = f" {phrase.replace(' ', '  ')} "
        parts = F.split(F.col("l_words"), spread)
        here = F.contains("l_words", F.lit(spread))
        length = len(phrase.split())
        count = F.when(here, F.size(parts) - 1).otherwise(F.lit(0))
        first = F.when(here, words_in(F.get(parts, F.lit(0))))
        last = F.when(here, words_in(F.col("l_words")) - words_in(F.element_at(parts, -1)) - length)
        places[phrase] = count, first, last
    # The parts between places keep their outer spaces: " a  b " counts its words by the double spaces inside.
    n_base = sum((c for c, _, _ in places.values()), F.lit(0))
    base = F.array_sort(F.array_distinct(F.filter(F.array(*(F.when(c > 0, F.lit(phrases[p])) for p, (c, _, _) in places.items())), lambda x: x.isNotNull())))
    padded = lambda columns: columns if len(columns) > 1 else [*columns, F.lit(None).cast("int")]
    rows = rows.select(
        "doc_id",
        *text_key(F.col("l_text")),
        words_in(F.col("l_words")).cast("long").alias("n_words"),
        n_base.cast("long").alias("n_base"),
        F.least(*padded([f for _, f, _ in places.values()])).cast("long").alias("first_word"),
        F.greatest(*padded([z for _, _, z in places.values()])).cast("long").alias("last_word"),
        base.alias("base"),
    )
    rows = rows.join(found, (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2")), "left")
    labels = F.when(F.col("found").isNull(), F.col("base")).otherwise(F.array_sort(F.array_union("base", "found")))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0)))
    return rows.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"))
