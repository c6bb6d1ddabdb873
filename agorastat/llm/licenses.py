"""Licence notices by Dice similarity of word bigrams (operator 5). DataFrame functions only."""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce
from importlib import resources

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agorastat.llm.common import materialize

AT_LEAST = 0.8
MOST_TEMPLATES = 2_000  # templates that are matched together; more go through the texts in several passes

# Notices as their licences ask for them or as they are commonly written.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions:",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met:",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)

# Whole licences: name and file in the folder license_texts.
WHOLE = (
    ("Apache-2.0", "Apache-2.0"), ("BSD-3-Clause", "BSD-3-Clause"), ("GPL-2.0", "GPL-2"), ("GPL-3.0", "GPL-3"), ("ISC", "ISC"),
    ("LGPL-2.1", "LGPL-2.1"), ("LGPL-3.0", "LGPL-3"), ("MIT", "MIT"), ("MPL-2.0", "MPL-2.0"),
)
LONG = 300  # bigrams from which a template is looked for by all its bigrams, as its telling words are many

COMMON = frozenset("a and any as be by for in is of or that the this to with".split())

# Runs of anything but ASCII letters, digits and characters beyond ASCII become one space.
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Normalised words: lower case (A-Z), separated by anything but letters and digits."""
    return F.filter(F.split(F.regexp_replace(F.translate(text, _UPPER, _LOWER), _GAP, " "), " "), lambda w: w != "")


def bigrams_of(words: Column) -> Column:
    """Distinct pairs of neighbouring words; a single word is paired with nothing, no word gives none."""

    def pairs(w: Column) -> Column:
        joined = F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w)), lambda x, y: F.concat_ws(" ", x, y))
        return F.when(F.size(w) > 1, F.array_distinct(joined)).otherwise(w)

    return F.element_at(F.transform(F.array(words), pairs), 1)  # names the words, so that they are computed once


def size_bounds(size: int, at_least: float) -> tuple[int, int]:
    """Bigrams that a passage must have to reach the similarity with a template of ``size`` bigrams.

    2 c / (a + b) >= t with c <= min(a, b) leaves t b / (2 - t) <= a <= b (2 - t) / t.
    """
    return math.ceil(at_least * size / (2 - at_least) - 1e-9), math.floor(size * (2 - at_least) / at_least + 1e-9)


def normalised(text: str) -> list[str]:
    return [w for w in re.sub(_GAP, " ", "".join(c.lower() if "A" <= c <= "Z" else c for c in text)).split(" ") if w]


def template_bigrams(text: str) -> set[str]:
    words = normalised(text)
    return {" ".join(pair) for pair in zip(words, words[1:])} if len(words) > 1 else set(words)


def telling_words(text: str, at_least: float, few: bool = False) -> list[str]:
    """Words of a template of which a similar passage has at least one.

    A similar passage shares t / (2 - t) of the template's bigrams or more, so words that stand in more
    than the rest of them cannot all be missing; common words come last, long ones first. With ``few``
    words of six letters and more in many bigrams come first, so that fewer are needed.
    """
    bigrams = template_bigrams(text)
    spare = len(bigrams) - at_least * len(bigrams) / (2 - at_least)
    chosen: list[str] = []
    held = Counter(w for b in bigrams for w in set(b.split(" "))) if few else {}
    for word in sorted(set(normalised(text)), key=lambda w: (w in COMMON, few and len(w) < 6, -held.get(w, 0), -len(w), w)):
        if sum(not set(b.split(" ")).isdisjoint(chosen) for b in bigrams) > spare + 1e-9:
            break
        chosen.append(word)
    return chosen


def passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, part, number, text)``: each line, and each paragraph (between blank lines) of several lines, from 0."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_t"))
    blank = r"\n(?:[\x20\x09\x0B-\x0D]*\n)+"
    lines = source.select("doc_id", F.lit("line").alias("part"), F.posexplode(F.split("_t", "\n", -1)).alias("number", "text"))
    paragraphs = source.filter(F.col("_t").contains("\n")).select(
        "doc_id", F.lit("paragraph").alias("part"), F.posexplode(F.split("_t", blank, -1)).alias("number", "text")
    )
    return lines.unionByName(paragraphs.filter(F.col("text").contains("\n")))


def license_findings(
    docs: DataFrame, notices=NOTICES, at_least: float = AT_LEAST, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, part, number, license, similarity)``: the most similar licence of each line and paragraph.

    Similarity is the Dice coefficient of the distinct word bigrams, kept from ``at_least``; of equal ones
    the first template counts. Documents without any telling word of a template are left out early, and
    passages meet only templates within the size bounds. The templates are a list in memory
    of at most ``MOST_TEMPLATES``, so they may be broadcast. Repeated documents are findings of their own; null and empty texts have none.
    """
    if len(notices) > MOST_TEMPLATES:
        raise ValueError("license_windows takes more templates")
    spark = docs.sparkSession
    listed = [(n, name, sorted(template_bigrams(text))) for n, (name, text) in enumerate(notices)]
    rows = [(n, name, len(bigrams), *size_bounds(len(bigrams), at_least), b) for n, name, bigrams in listed for b in bigrams]
    table = spark.createDataFrame(rows, "template int, license string, size int, least int, most int, bigram string")
    words = sorted({w for _, text in notices for w in telling_words(text, at_least)})
    inside = r"A-Za-z0-9\x{80}-\x{10FFFF}"
    telling = F.col(text_col).rlike(f"(?<![{inside}])(?i:{'|'.join(words)})(?![{inside}])")
    numbered = passages(docs.filter(telling).withColumn("_row", F.monotonically_increasing_id()).select(F.struct(F.col(id_col).alias("id"), "_row").alias("doc_id"), text_col), "doc_id", text_col)
    sized = numbered.select("doc_id", "part", "number", bigrams_of(words_of(F.col("text"))).alias("b")).withColumn("n", F.size("b"))
    sized = sized.filter(F.col("n").between(min(r[3] for r in rows), max(r[4] for r in rows)))
    common = sized.select("doc_id", "part", "number", "n", F.explode("b").alias("bigram")).join(F.broadcast(table), "bigram")
    scored = (
        common.filter("n BETWEEN least AND most")
        .groupBy("doc_id", "part", "number", "n", "template", "license", "size")
        .agg(F.count(F.lit(1)).alias("c"))
        .withColumn("similarity", 2 * F.col("c") / (F.col("n") + F.col("size")))
        .filter(F.col("similarity") >= at_least)
    )
    best = scored.groupBy("doc_id", "part", "number").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "template", "license")).alias("m"))
    return best.select(F.col("doc_id.id").alias("doc_id"), "part", F.col("number").cast("long").alias("number"), F.col("m.license").alias("license"), (-F.col("m.s")).alias("similarity"))


def whole_licenses() -> tuple[tuple[str, str], ...]:
    """The names and texts of whole licences."""
    folder = resources.files("agorastat.llm") / "license_texts"
    return tuple((name, (folder / f"{file}.txt").read_text(encoding="utf-8")) for name, file in WHOLE)


def license_windows(
    docs: DataFrame, notices=None, at_least: float = AT_LEAST, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, license, first_word, n_words, similarity)``: licences anywhere in a text, whatever stands around them.

    Lines do not count: the words of a text are one sequence, so comment signs and line breaks are nothing. All windows
    of as many bigrams as the size bounds of a template allow count: up to ``LONG`` bigrams of a template every length
    is compared, beyond that the windows of ``_longest_windows``, which hold every similar
    window inside one as similar (it may be longer where bigrams repeat). Overlapping windows of a licence are one finding, given by its most similar window, unless a
    more similar window of another licence overlaps that. Without ``notices`` the templates are ``NOTICES`` and whole
    licences; any number may be given. Rows with the same id and text count once; null and empty texts have none.
    """
    notices = tuple(NOTICES + whole_licenses() if notices is None else notices)
    parts = [_alike_windows(docs, notices, numbers, at_least, id_col, text_col) for numbers in _parts(len(notices))]
    alike = reduce(DataFrame.unionByName, parts)

    # One finding for overlapping windows of a licence, and the most similar licence where they overlap.
    ends = alike.groupBy("doc_id", "key", "license", "begin").agg(
        F.max("last").alias("end"), F.min(F.struct((-F.col("similarity")).alias("s"), "template", "begin", "last")).alias("m")
    )
    ordered = Window.partitionBy("doc_id", "key", "license").orderBy("begin")
    apart = F.coalesce(F.col("begin") > F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    chained = ends.withColumn("apart", apart.cast("int")).withColumn("number", F.sum("apart").over(ordered))
    best = chained.groupBy("doc_id", "key", "license", "number").agg(F.min("m").alias("m"))
    found = best.groupBy("doc_id", "key").agg(F.collect_list(F.struct("m.*", "license")).alias("f"))
    beaten = "exists(f, y -> y.license <> x.license AND y.begin <= x.last AND x.begin <= y.last AND struct(y.s, y.template) < struct(x.s, x.template))"
    kept = found.select("doc_id", F.inline(F.expr(f"filter(f, x -> NOT {beaten})")))
    n_words = (F.col("last") - F.col("begin") + 2).cast("long").alias("n_words")
    return kept.select("doc_id", "license", F.col("begin").cast("long").alias("first_word"), n_words, (-F.col("s")).alias("similarity"))


def _parts(count: int) -> list[range]:
    return [range(i, min(i + MOST_TEMPLATES, count)) for i in range(0, max(count, 1), MOST_TEMPLATES)]


def one_of(words: list[str]) -> str:
    """A pattern for any of the words, in either case of A-Z; equal beginnings are tried once."""
    tree: dict = {}
    for word in words:
        node = tree
        for letter in word:
            node = node.setdefault(letter, {})
        node[""] = {}

    def pattern(node: dict) -> str:
        branches = [re.escape(letter) + pattern(node[letter]) for letter in sorted(node) if letter]
        if not branches:
            return ""
        inner = branches[0] if len(branches) == 1 else f"(?:{'|'.join(branches)})"
        return f"(?:{inner})?" if "" in node else inner

    return f"(?i:{pattern(tree)})"


def _alike_windows(docs: DataFrame, notices, numbers: range, at_least: float, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, key, template, license, begin, last, similarity)``: windows that are similar to the templates of these numbers."""
    spark = docs.sparkSession
    listed = [(n, name, template_bigrams(text)) for n, (name, text) in ((n, notices[n]) for n in numbers)]
    bounds = {n: size_bounds(len(b), at_least) for n, _, b in listed}
    bigrams = {n: b for n, _, b in listed}
    long = [n for n, _, b in listed if len(b) > LONG]
    table = F.broadcast(spark.createDataFrame([(n, b) for n, _, bs in listed for b in sorted(bs)], "template int, bigram string"))
    sizes = F.broadcast(spark.createDataFrame([(n, name, len(b), *bounds[n]) for n, name, b in listed], "template int, license string, size int, least int, most int"))

    inside = r"A-Za-z0-9\x{80}-\x{10FFFF}"

    def names_one(chosen: list[int], few: bool) -> Column:
        words = sorted({w for n in chosen for w in telling_words(notices[n][1], at_least, few)})
        return F.concat(F.lit(" "), "_t").rlike(f"[^{inside}]{one_of(words)}(?![{inside}])") if words else F.lit(False)

    telling = names_one([n for n, _, _ in listed if n not in long], False)
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_t")).filter(F.col("_t") != "")
    keyed = keyed.select("doc_id", F.xxhash64("_t").alias("key"), telling.alias("telling"), F.col("_t"))
    shortest = min((bounds[n][0] for n in long), default=None)
    if shortest is None:
        keyed = keyed.filter("telling")
    else:  # a text of so many words has a separator less, at least
        keyed = keyed.filter(F.col("telling") | ((F.length("_t") > 2 * shortest) & names_one(long, True)))
    # explode gives one row, from which no filter takes the words apart again
    keyed = keyed.select("doc_id", "key", "telling", F.explode(F.array(_pairs(words_of(F.col("_t"))))).alias("b"))
    whole = [F.when(F.size("b") >= bounds[n][0], _holds("b", bigrams[n], bounds[n][0], n)) for n in long]
    holds = F.array_compact(F.array(*whole)) if whole else F.array().cast("array<int>")
    keyed = keyed.select("doc_id", "key", "telling", "b", F.explode(F.array(holds)).alias("long"))
    keyed = materialize(keyed.filter(F.col("telling") | (F.size("long") > 0)), "license_words")  # texts in question only

    # Where enough bigrams of a template stand close together.
    pairs = keyed.select("doc_id", "key", "telling", "long", F.posexplode("b").alias("pos", "bigram")).join(table, "bigram")
    wanted = F.when(F.col("template").isin(long), F.array_contains("long", F.col("template"))).otherwise(F.col("telling"))
    places = pairs.filter(wanted).groupBy("doc_id", "key", "template").agg(F.sort_array(F.collect_set("pos")).alias("p")).join(sizes, "template")
    close = F.expr("filter(p, (x, k) -> get(p, k + least - 1) < x + most)")
    places = places.withColumn("p", close).filter(F.size("p") > 0)
    places = places.withColumn("firsts", F.expr("filter(p, (x, k) -> k = 0 OR x - get(p, k - 1) > most)"))
    stretch = F.expr("transform(firsts, (x, k) -> struct(x AS first, array_max(filter(p, y -> y < coalesce(get(firsts, k + 1), 2147483647))) - x + 1 AS starts))")
    places = places.select("doc_id", "key", "template", "license", "size", "least", "most", F.inline(stretch))

    # Distinct and shared bigrams of each window there: an occurrence counts for the starts after the one before it.
    own = [F.col("doc_id").eqNullSafe(F.col("_id")), F.col("key") == F.col("_key")]
    texts = keyed.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "b")
    near = places.join(texts, own).drop("_id", "_key").withColumn("b", F.expr("slice(b, first + 1, starts + most - 1)"))
    near = materialize(near.dropDuplicates(["doc_id", "key", "template", "first"]), "license_places").withColumn("until", F.col("first") + F.size("b") - 1)
    place = ["doc_id", "key", "template", "first"]
    seen = near.select(*place, "license", "size", "least", "most", "starts", "until", F.posexplode("b").alias("pos", "bigram"))
    seen = seen.withColumn("before", F.coalesce(F.lag("pos").over(Window.partitionBy(*place, "bigram").orderBy("pos")), F.lit(-1)))
    seen = seen.join(table.withColumn("shared", F.lit(1)), ["template", "bigram"], "left").fillna(0, ["shared"])
    is_long = F.col("size") > LONG
    alike = _all_lengths(seen.filter(~is_long), place)
    if long:
        alike = alike.unionByName(_longest_windows(seen.filter(is_long), place, at_least))
    begin, last = (F.col("first") + F.col("at")).alias("begin"), F.least(F.col("first") + F.col("end"), F.col("until")).alias("last")
    return alike.filter(F.col("similarity") >= at_least).select("doc_id", "key", "template", "license", begin, last, "similarity")


def _all_lengths(seen: DataFrame, place: list[str]) -> DataFrame:
    """The windows of each length within the size bounds, at the starts where their counts change."""
    lengths = F.explode(F.expr("sequence(least, most)"))
    seen = seen.withColumn("length", lengths).withColumn("at", F.greatest(F.col("pos") - F.col("length") + 1, F.col("before") + 1))
    group = [*place, "license", "size", "starts", "until", "length"]
    steps = F.array(F.struct(F.col("at"), F.lit(1).alias("n"), F.col("shared").alias("c")), F.struct((F.col("pos") + 1).alias("at"), F.lit(-1).alias("n"), (-F.col("shared")).alias("c")))
    counted = seen.withColumn("at", F.greatest("at", F.lit(0))).select(*group, F.inline(steps)).filter("at < starts").groupBy(*group, "at").agg(F.sum("n").alias("n"), F.sum("c").alias("c"))
    so_far = Window.partitionBy(*place, "length").orderBy("at")
    counted = counted.withColumn("n", F.sum("n").over(so_far)).withColumn("c", F.sum("c").over(so_far))
    counted = counted.withColumn("similarity", 2 * F.col("c") / (F.col("n") + F.col("size")))
    return counted.select(*place, "license", "until", "at", (F.col("at") + F.col("length") - 1).alias("end"), "similarity")


def _longest_windows(seen: DataFrame, place: list[str], at_least: float) -> DataFrame:
    """The similarity of the windows that no longer window with at least that similarity begins before or ends after.

    A shared bigram that stands once in a place raises both counts of a window by one, any other shared one
    does so or changes nothing, and a foreign one adds at most one bigram to the window. So an extension whose single
    shared bigrams are at least as many as its foreign ones never lowers the similarity, which is 1 at most. With weights
    1, 0 and -1, only positions before which the running sum is lower than ever before can begin such
    a window, and the same holds for ends from the other side. Every window is inside one of these that is as similar.
    """
    there, back = Window.partitionBy(*place).orderBy("pos"), Window.partitionBy(*place).orderBy(F.col("pos").desc())
    earlier = Window.unboundedPreceding, -1
    single = (F.count(F.lit(1)).over(Window.partitionBy(*place, "bigram")) == 1).cast("int")
    rows = seen.withColumn("single", single).withColumn("w", F.when(F.col("shared") == 1, F.col("single")).otherwise(-1))
    rows = rows.withColumn("left", F.sum("w").over(there) - F.col("w")).withColumn("right", F.sum("w").over(back) - F.col("w"))
    # At most 2 shared - t single is twice the shared minus t times the distinct bigrams of a window.
    rows = rows.withColumn("most_gain", 2 * F.col("shared") - at_least * F.col("single"))
    rows = rows.withColumn("gained", F.sum("most_gain").over(there))
    lowest = {side: F.min(side).over(order.rowsBetween(*earlier)) for side, order in (("left", there), ("right", back))}
    record = {side: F.coalesce(F.col(side) < low, F.lit(True)) & (F.col("shared") == 1) for side, low in lowest.items()}
    reach = F.max("gained").over(back) - F.col("gained") + F.col("most_gain")
    rows = rows.withColumn("begins", record["left"] & (reach >= at_least * F.col("size") - 1e-6)).withColumn("ends", record["right"])
    begins = rows.filter("begins").select(*place, F.col("pos").alias("at"))
    windows = begins.join(rows.select(*place, "license", "size", "until", "pos", "before", "shared", "ends"), place).filter("pos >= at")
    fresh = (F.col("before") < F.col("at")).cast("int")
    so_far = Window.partitionBy(*place, "at").orderBy("pos")
    windows = windows.withColumn("n", F.sum(fresh).over(so_far)).withColumn("c", F.sum(fresh * F.col("shared")).over(so_far)).filter("ends")
    similarity = (2 * F.col("c") / (F.col("n") + F.col("size"))).alias("similarity")
    return windows.select(*place, "license", "until", "at", F.col("pos").alias("end"), similarity)


def _pairs(words: Column) -> Column:
    """All pairs of neighbouring words in order."""

    def pairs(w: Column) -> Column:
        joined = F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w)), lambda x, y: F.concat_ws(" ", x, y))
        return F.when(F.size(w) > 1, joined).otherwise(F.array().cast("array<string>"))

    return F.element_at(F.transform(F.array(words), pairs), 1)


def _holds(pairs: str, bigrams: set[str], least: int, template: int) -> Column:
    """The template's number if at least ``least`` of its bigrams are among the pairs, else null."""
    listed = F.split(F.lit("\n".join(sorted(bigrams))), "\n")  # one constant
    return F.when(F.size(F.array_intersect(F.col(pairs), listed)) >= least, F.lit(template))
