"""Licence statements in texts: Dice coefficient over word bigrams against templates.

Candidates are spans of a text's words: every line, the whole text, and for each template every run of
as many words as it has, wherever lines end. So a statement is found on a line of its own, wrapped over
several, or in the middle of one. Both sides are normalised to lower-case words of letters and digits.

With `a` and `b` bigrams, Dice is at most 2 min(a, b) / (a + b), so a template is compared with a line
or text only when that has between s / (2 - s) and (2 - s) / s times its bigrams; longer ones count by
their windows alone. A match shares s / (2 - s) of a template's bigrams, so texts and lines without any
of a few of its words are passed over, and windows start only where enough bigrams of the template lie
in reach. Of spans that overlap, one is reported if none of the others is better: by coefficient, then
the earlier, the shorter, and the template that sorts first.

Edge cases: a null, empty or one-word text has no bigrams and matches nothing. Rows that share an id
are searched each by itself, and equal findings of one id are reported once. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from candlewright.llm.native import let
from candlewright.session import materialize

# Licence statements as their licences word them.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file"
        " except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files (the Software), to deal in the Software"
        " without restriction, including without limitation the rights to use, copy, modify, merge,"
        " publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons"
        " to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3 or later."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version.",
    ),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met:",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright to this work."),
]

WORD = "[^a-z0-9]+"
#: Words found in most texts, of little use to tell that a text may have a statement.
COMMON = frozenset("a an and any are as at by for from in is it not of on or that the this to use was with".split())


def _normal(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), WORD), "")


def _pairs(w: Column) -> Column:
    """All pairs of neighbouring words, in order."""
    at = F.sequence(F.lit(0), F.size(w) - 2)
    joined = F.transform(at, lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1)))
    return F.when(F.size(w) >= 2, joined).otherwise(F.array().cast("array<string>"))


def _bigrams(tokens: Column) -> Column:
    """Distinct pairs of neighbouring words."""
    return let(tokens, lambda w: F.array_distinct(_pairs(w)))


def _key_words(known: list, lowest: float) -> list[str]:
    """Words of which any match has one.

    A match shares at least similarity / (2 - similarity) of a template's pairs. The chosen words,
    the longest first, are in so many of its pairs that the others are fewer than that.
    """
    chosen = set()
    for t in known:
        pairs = [p.split(" ") for p in t["pairs"]]
        for word in sorted({w for p in pairs for w in p}, key=lambda w: (w in COMMON, -len(w), w)):
            if sum(not chosen.intersection(p) for p in pairs) < lowest * len(pairs) - 1e-9:
                break
            chosen.add(word)
    return sorted(chosen)


def _units(texts: DataFrame, known: list, lowest: float, highest: float, similarity: float) -> DataFrame:
    """`id, row, template, start, n, dice` of lines and whole texts, each with its best template."""
    most = max(len(t["pairs"]) for t in known) * highest
    least = min(len(t["pairs"]) for t in known) * lowest
    keys = F.array(*[F.lit(w) for w in _key_words(known, lowest)])
    table = F.array(
        *[
            F.struct(
                F.lit(t["template"]).alias("template"),
                F.array(*[F.lit(p) for p in t["pairs"]]).alias("pairs"),
            )
            for t in known
        ]
    )

    def score(pairs: Column, t: Column) -> Column:
        size, own = F.size(pairs), F.size(t["pairs"])
        near = size.between(own * lowest - 1e-9, own * highest + 1e-9)
        shared = F.size(F.array_intersect(pairs, t["pairs"]))
        return F.struct(
            F.when(near, 2.0 * shared / (size + own)).otherwise(0.0).alias("dice"),
            t["template"].alias("template"),
        )

    def better(a: Column, b: Column) -> Column:
        ahead = (b["dice"] > a["dice"]) | ((b["dice"] == a["dice"]) & (b["template"] < a["template"]))
        return F.when(ahead, b).otherwise(a)

    nothing = F.struct(F.lit(0.0).alias("dice"), F.lit("").alias("template"))

    def best(words: Column) -> Column:
        """Coefficient and name of the best template; every part is evaluated once, and only if needed."""
        of_pairs = lambda p: F.when(
            F.size(p).between(least - 1e-9, most + 1e-9),
            F.aggregate(F.transform(table, lambda t: score(p, t)), nothing, better),
        ).otherwise(nothing)
        compared = (F.size(words).between(2, int(most) + 1)) & F.arrays_overlap(words, keys)
        return F.when(compared, let(_bigrams(words), of_pairs)).otherwise(nothing)

    whole = F.struct(F.lit(-1).alias("line"), F.size("w").alias("n"), best(F.col("w")).alias("best"))
    lines = F.transform(
        F.transform(F.split("body", "\n"), _normal),
        lambda w, i: F.struct(i.alias("line"), F.size(w).alias("n"), best(w).alias("best")),
    )
    units = texts.select("id", "row", "w", lines.alias("lines"), whole.alias("whole"))
    # A line starts after the words of the lines before it.
    before = lambda x: F.aggregate(
        F.slice("lines", 1, F.greatest(x["line"], F.lit(0))), F.lit(0), lambda n, y: n + y["n"]
    )
    found = F.transform(
        F.filter(F.concat("lines", F.array("whole")), lambda x: x["best"]["dice"] >= similarity),
        lambda x: F.struct(
            x["best"]["template"].alias("template"),
            before(x).alias("start"),
            x["n"].alias("n"),
            x["best"]["dice"].alias("dice"),
        ),
    )
    return units.select("id", "row", F.inline(found))


def _windows(texts: DataFrame, templates: DataFrame, lowest: float, similarity: float) -> DataFrame:
    """The same for runs of as many words as a template has."""
    pairs = templates.select("template", "size", F.size("pairs").alias("own"), F.explode("pairs").alias("pair"))
    hits = (
        texts.select("id", "row", F.size("w").alias("words"), F.posexplode(_pairs(F.col("w"))).alias("pos", "pair"))
        .join(pairs, "pair")
        .where("words >= size")
        .groupBy("id", "row", "words", "template", "size", "own")
        .agg(F.sort_array(F.collect_list("pos")).alias("at"))
        .withColumn("need", F.ceil(F.col("own") * lowest - 1e-9).cast("int"))
        .where(F.size("at") >= F.col("need"))
    )
    # From the first hit of a window to the one that makes them enough, it may start as far back as it
    # reaches, and no later than the last window of the text.
    reach = F.col("size") - 2
    starts = F.transform(
        F.slice("at", 1, F.size("at") - F.col("need") + 1),
        lambda first, i: let(
            F.struct(
                F.get("at", i + F.col("need") - 1).alias("last"),
                F.least(first, F.col("words") - F.col("size")).alias("upto"),
            ),
            lambda x: F.when(
                (x["last"] - first <= reach) & (F.greatest(x["last"] - reach, F.lit(0)) <= x["upto"]),
                F.sequence(F.greatest(x["last"] - reach, F.lit(0)), x["upto"]),
            ).otherwise(F.array().cast("array<int>")),
        ),
    )
    spots = hits.select("id", "row", "template", "size", F.explode(F.array_distinct(F.flatten(starts))).alias("start"))
    words = texts.select(F.col("id").alias("at_id"), F.col("row").alias("at_row"), "w")
    cut = (
        spots.join(words, F.col("id").eqNullSafe(F.col("at_id")) & (F.col("row") == F.col("at_row")))
        .select("id", "row", "template", "start", F.col("size").alias("n"), _bigrams(F.slice("w", F.col("start") + 1, F.col("size"))).alias("own"))
        .join(templates.select("template", "pairs"), "template")
    )
    shared = F.size(F.array_intersect("own", "pairs"))
    dice = 2.0 * shared / (F.size("own") + F.size("pairs"))
    return cut.select("id", "row", "template", "start", "n", dice.alias("dice")).where(F.col("dice") >= similarity)


def scan(
    docs: DataFrame,
    similarity: float = 0.8,
    templates: list[tuple[str, str]] = TEMPLATES,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Findings: the id, `license`, `dice`, the span's first word and number of words, and its words."""
    spark = docs.sparkSession
    named = spark.createDataFrame(
        [(f"{name}#{k:03d}", body) for k, (name, body) in enumerate(templates)],
        "template string, body string",
    ).select("template", _normal(F.col("body")).alias("words"))
    named = named.select("template", F.size("words").alias("size"), _bigrams(F.col("words")).alias("pairs"))
    known = named.where(F.size("pairs") > 0).collect()
    if not known:
        return docs.select(
            id_col,
            F.lit("").alias("license"),
            F.lit(0.0).alias("dice"),
            F.lit(0).alias("start"),
            F.lit(0).alias("n_words"),
            F.lit("").alias("statement"),
        ).where(F.lit(False))
    lowest, highest = similarity / (2 - similarity), (2 - similarity) / similarity
    keys = F.array(*[F.lit(w) for w in _key_words(known, lowest)])
    body = F.coalesce(F.col(text), F.lit(""))
    texts = (
        docs.where(F.arrays_overlap(_normal(body), keys))
        .select(F.col(id_col).alias("id"), F.xxhash64(body).alias("row"), body.alias("body"), _normal(body).alias("w"))
        .dropDuplicates(["id", "row"])
    )
    texts = materialize(texts, "texts")
    given = spark.createDataFrame([tuple(t) for t in known], "template string, size int, pairs array<string>")
    spans = _units(texts, known, lowest, highest, similarity).unionByName(
        _windows(texts, given, lowest, similarity)
    )
    spans = spans.distinct().withColumn("end", F.col("start") + F.col("n"))
    # No span is longer than this, so those that overlap one start near it.
    longest = int(max(max(len(t["pairs"]) for t in known) * highest + 1, max(t["size"] for t in known)))
    near = Window.partitionBy("id", "row").orderBy("start").rangeBetween(-longest, longest)
    beside = F.collect_list(F.struct("start", "end", "dice", "n", "template")).over(near)

    def ahead(y: Column) -> Column:
        ranks = [(y[c], F.col(c)) for c in ("start", "n", "template")]
        later = F.lit(False)
        for mine, own in reversed(ranks):
            later = (mine < own) | ((mine == own) & later)
        return (y["dice"] > F.col("dice")) | ((y["dice"] == F.col("dice")) & later)

    outdone = F.exists("beside", lambda y: (y["start"] < F.col("end")) & (y["end"] > F.col("start")) & ahead(y))
    best = spans.withColumn("beside", beside).where(~outdone).drop("beside", "end")
    words = texts.select(F.col("id").alias("at_id"), F.col("row").alias("at_row"), "w")
    return (
        best.join(words, F.col("id").eqNullSafe(F.col("at_id")) & (F.col("row") == F.col("at_row")))
        .select(
            F.col("id").alias(id_col),
            F.regexp_replace("template", "#[0-9]+$", "").alias("license"),
            "dice",
            "start",
            F.col("n").alias("n_words"),
            F.array_join(F.slice("w", F.col("start") + 1, F.col("n")), " ").alias("statement"),
        )
        .distinct()
    )
