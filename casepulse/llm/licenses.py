"""Licences of files by TF-IDF cosine to templates, and by inheritance from licence files above.

A statement is a line, or a sentence of one, that has a licence word, alone or together with a few
lines after it, as headers are wrapped. Its terms are weighted by their frequency in it and the
inverse document frequency over all files, and compared with the templates. A statement of at
least ``LIKE`` cosine that is less like any other licence by ``MARGIN`` names its licence; one
that tells no version from another names none. The best of a file counts, equal ones by name; a
licence that only adds a clause to another one outdoes it. A file that is called a licence file,
or is mostly the text of one, covers its directory: files below without a licence of their own
take that of the nearest directory above. Directories are few against files, so their ancestors
are spread out and joined once for each directory; files join their own, dealt over ``PARTS``
where the directories are too many to be sent.

Only DataFrame functions are used. Statements are scored inside the row; the counts of the
templates' terms are a single small aggregate, and what is broadcast or held by the driver are
the templates' terms alone.

Null and empty texts have no licence of their own. A null path lies in no directory. Repeated
rows keep their rows. If several files cover a directory, the most similar one does, equal ones
by name. Columns other than the path and the text are not looked at, and every row comes back
with the path. Empty tables give empty results.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casepulse.llm.store import cut

# Statements by which licences are recognised, by their common identifiers: what
# source files and pages say, then what licence files do.
_GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
_GNU_ONLY = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {}, version {}, as published by the Free Software Foundation."
HEADERS: dict[str, list[str]] = {
    "AGPL-3.0": [
        "licensed under the GNU Affero General Public License version 3",
        _GNU.format("Affero General Public License", "3"),
        "SPDX-License-Identifier: AGPL-3.0",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License", "SPDX-License-Identifier: BSD-2-Clause"],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License", "SPDX-License-Identifier: BSD-3-Clause"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0",
        "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0",
        "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ],
    "CC0-1.0": ["dedicated to the public domain under CC0 1.0 Universal license", "SPDX-License-Identifier: CC0-1.0"],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2",
        _GNU.format("General Public License", "2"),
        _GNU_ONLY.format("General Public License", "2"),
        "SPDX-License-Identifier: GPL-2.0",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        _GNU.format("General Public License", "3"),
        _GNU_ONLY.format("General Public License", "3"),
        "SPDX-License-Identifier: GPL-3.0",
    ],
    "LGPL-2.1": [
        "licensed under the GNU Lesser General Public License, version 2.1",
        _GNU.format("Lesser General Public License", "2.1"),
        "SPDX-License-Identifier: LGPL-2.1",
    ],
    "LGPL-3.0": [
        "licensed under the GNU Lesser General Public License, version 3",
        _GNU.format("Lesser General Public License", "3"),
        "SPDX-License-Identifier: LGPL-3.0",
    ],
    "MIT": ["Released under the MIT License", "SPDX-License-Identifier: MIT"],
    "MPL-2.0": [
        "subject to the terms of the Mozilla Public License, v. 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "Unlicense": ["SPDX-License-Identifier: Unlicense"],
}
FILES: dict[str, list[str]] = {
    "AGPL-3.0": ["GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "Apache-2.0": ["Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"],
    "BSD-2-Clause": [
        "BSD 2-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "BSD-3-Clause": [
        "BSD 3-Clause License",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission.",
    ],
    "CC-BY-4.0": ["Creative Commons Attribution 4.0 International Public License"],
    "CC-BY-NC-4.0": ["Creative Commons Attribution-NonCommercial 4.0 International Public License"],
    "CC-BY-SA-4.0": ["Creative Commons Attribution-ShareAlike 4.0 International Public License"],
    "CC0-1.0": ["Creative Commons Legal Code CC0 1.0 Universal"],
    "GPL-2.0": ["GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "GPL-3.0": ["GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "LGPL-2.1": ["GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"],
    "LGPL-3.0": ["GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "MIT": [
        "MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "MPL-2.0": ["Mozilla Public License Version 2.0"],
    "Unlicense": ["This is free and unencumbered software released into the public domain, The Unlicense"],
}
TEMPLATES = {name: [*HEADERS.get(name, []), *FILES.get(name, [])] for name in sorted({*HEADERS, *FILES})}
#: Licences that only add to another one.
ADDS_TO = {"BSD-3-Clause": "BSD-2-Clause"}
#: Words of which every template has one; only statements with one can be like a template.
CUE = "(?i)licen[sc]e|permission is hereby|redistribution and use|redistribute it|public domain|neither the name|creative commons"
LICENCE_FILE = r"(?i)(?:^|/)(?:un)?licen[sc]e(?:[._-][^/]*)?$|(?i)(?:^|/)(?:copying|notice)(?:[._-][^/]*)?$"
LIKE, MARGIN = 0.65, 0.005
#: Numbers of lines that are taken together, beginning with one that has a licence word.
LINES = (1, 2, 3, 4, 6)
#: Directories up to which they are sent to all tasks, and parts that the files of one are dealt over beyond.
SENT, PARTS = 50_000, 64
#: Share of a file's words that a statement must make up to cover the directory.
MOSTLY = 0.8
NONE = "none"
TERM = r"[a-z0-9]+(?:\.[0-9]+)*"
#: Where statements are cut.
SENTENCE = r"(?<=[.!?;])\s+(?=[A-Z])|\n"


def terms(text: str) -> list[str]:
    return re.findall(TERM, text.lower())


def vocabulary() -> list[str]:
    return sorted({t for statements in TEMPLATES.values() for s in statements for t in terms(s)})


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def document_frequencies(files: DataFrame, text: str = "text") -> dict[str, int]:
    """In how many files each term of the templates occurs, and the number of files under the empty term."""
    known = F.array(*(F.lit(t) for t in vocabulary()))
    found = F.array_intersect(F.split(F.lower(F.col(text)), r"[^a-z0-9.]+|\.(?![0-9])"), known)
    each = files.select(F.explode(F.concat(F.array(F.lit("")), F.coalesce(found, F.array().cast("array<string>")))).alias("term"))
    return {r["term"]: r["n"] for r in each.groupBy("term").agg(F.count("*").alias("n")).collect()}


def weights(frequencies: dict[str, int]) -> dict[str, float]:
    """Smoothed inverse document frequency of each term of the templates; the empty term's is that of any other word.

    The licences count as documents too, so that names outweigh common words in a small corpus.
    """
    n = frequencies.get("", 0) + len(TEMPLATES)
    of_licence = Counter(t for statements in TEMPLATES.values() for t in {t for s in statements for t in terms(s)})
    return {t: math.log((1 + n) / (1 + frequencies.get(t, 0) + of_licence[t])) + 1.0 for t in vocabulary()} | {"": 1.0}


def _vector(words: list[str], idf: dict[str, float]) -> dict[str, float]:
    raw = {t: c * idf[t] for t, c in Counter(words).items()}
    norm = math.sqrt(sum(v * v for v in raw.values()))
    return {t: v / norm for t, v in raw.items()}


#: The templates one after another: licence, text, whether it is a licence file's.
OPTIONS = [(name, text, text in FILES.get(name, [])) for name, texts in TEMPLATES.items() for text in texts]


def most_words(idf: dict[str, float]) -> int:
    """Distinct words beyond which no statement can be like a template.

    Every word that a template lacks adds one to the square of the statement's length, so a
    statement of all of a template and m other words has a cosine of at most sqrt(T / (T + m)).
    """
    squares = max(sum((c * idf[t]) ** 2 for t, c in Counter(terms(text)).items()) for _, text, _ in OPTIONS)
    return len(vocabulary()) + math.ceil(squares * (1 / LIKE**2 - 1))


def _best(statement: Column, idf: dict[str, float]) -> Column:
    """The likest template of a statement: ``like``, ``licence``, ``of_file``, how like the ``next`` licence is, ``words``."""
    vectors = [_vector(terms(text), idf) for _, text, _ in OPTIONS]
    entries = []
    for term in vocabulary():
        # One literal, folded to an array of constants.
        shares = F.split(F.lit(",".join(repr(v.get(term, 0.0)) for v in vectors)), ",").cast("array<double>")
        entries += [F.lit(term), F.struct(F.lit(idf[term]).alias("idf"), shares.alias("shares"))]
    table = F.create_map(*entries)
    named = F.array(*(F.struct(F.lit(name).alias("licence"), F.lit(of_file).alias("of_file")) for name, _, of_file in OPTIONS))
    nothing = F.struct(F.lit(0.0).alias("like"), F.lit(NONE).alias("licence"), F.lit(False).alias("of_file"), F.lit(0.0).alias("next"))

    def better(held: Column, x: Column) -> Column:
        """The first of the likest, as names are in order, and how like the likest of other licences is."""
        last = F.when(held["licence"] == x["licence"], held["next"]).otherwise(held["like"])
        new = F.struct(x["like"].alias("like"), x["licence"].alias("licence"), x["of_file"].alias("of_file"), last.alias("next"))
        other = F.when(held["licence"] == x["licence"], held["next"]).otherwise(F.greatest(held["next"], x["like"]))
        old = F.struct(held["like"].alias("like"), held["licence"].alias("licence"), held["of_file"].alias("of_file"), other.alias("next"))
        return F.when(x["like"] > held["like"], new).otherwise(old)

    def scored(found: Column) -> Column:
        # In steps, each bound once: the entry of each word, its weight, the products with all templates.
        known = F.transform(F.array_distinct(found), lambda t: F.struct(t.alias("t"), F.try_element_at(table, t).alias("e")))

        def weigh(x: Column) -> Column:
            times = F.size(F.filter(found, lambda y: y == x["t"]))
            return F.struct((times * F.coalesce(x["e"]["idf"], F.lit(idf[""]))).cast("double").alias("w"), x["e"]["shares"].alias("shares"))

        start = F.struct(F.array_repeat(F.lit(0.0), F.lit(len(OPTIONS))).alias("dots"), F.lit(0.0).alias("square"))

        def add(held: Column, x: Column) -> Column:
            moved = F.zip_with(held["dots"], x["shares"], lambda d, v: d + v * x["w"])
            return F.struct(F.when(x["shares"].isNull(), held["dots"]).otherwise(moved).alias("dots"), (held["square"] + x["w"] * x["w"]).alias("square"))

        def options(held: Column) -> Column:
            return F.transform(F.array(F.struct(held["dots"].alias("dots"), F.sqrt(held["square"]).alias("norm"))), likes)[0]

        def likes(held: Column) -> Column:
            every = F.zip_with(
                held["dots"],
                named,
                lambda dot, n: F.struct(F.round(dot / held["norm"], 6).alias("like"), n["licence"].alias("licence"), n["of_file"].alias("of_file")),
            )
            return F.aggregate(every, nothing, better)

        best = F.aggregate(F.transform(known, weigh), start, add, options)
        return F.when(F.size(F.array_distinct(found)) <= most_words(idf), best).otherwise(nothing)

    words = F.transform(F.array(_terms(statement)), lambda found: F.struct(scored(found).alias("best"), F.size(found).alias("words")))[0]
    return F.transform(
        F.array(words), lambda x: F.struct(*(x["best"][name].alias(name) for name in ("like", "licence", "of_file", "next")), x["words"].alias("words"))
    )[0]


def _statements(text: Column) -> Column:
    """Lines and sentences with a licence word, each alone and with those after it."""
    # An array of the one array of pieces, so that they are made once.
    pieces = F.array(F.filter(F.split(text, SENTENCE), lambda s: s.rlike("[A-Za-z0-9]")))

    def begun(p: Column) -> Column:
        places = F.filter(F.sequence(F.lit(1), F.size(p)), lambda i: F.element_at(p, i).rlike(CUE))
        together = lambda i: F.array(*(F.array_join(F.slice(p, i, F.lit(k)), " ") for k in LINES))
        return F.when(F.size(p) > 0, F.array_distinct(F.flatten(F.transform(places, together)))).otherwise(F.array().cast("array<string>"))

    return F.element_at(F.transform(pieces, begun), 1)


def own_licences(
    files: DataFrame, idf: dict[str, float], path: str = "path", text: str = "text", carried: tuple[str, ...] = ()
) -> DataFrame:
    """``path``, ``row`` (the carried columns), ``own`` (the licence a file states, or ``none``), ``like`` and ``covers``."""
    value = F.col(text)
    scored = F.filter(F.transform(_statements(value), lambda s: _best(s, idf)), lambda x: (x["like"] >= LIKE) & (x["like"] - x["next"] >= MARGIN))
    for more, less in ADDS_TO.items():  # bound once, then looked at twice
        scored = F.element_at(
            F.transform(F.array(scored), lambda xs: F.filter(xs, lambda x: (x["licence"] != less) | ~F.exists(xs, lambda y: y["licence"] == more))), 1
        )
    nothing = F.struct(F.lit(0.0).alias("like"), F.lit(NONE).alias("licence"), F.lit(False).alias("of_file"), F.lit(0.0).alias("next"), F.lit(0).alias("words"))
    likest = F.aggregate(scored, nothing, lambda a, x: F.when((x["like"] > a["like"]) | ((x["like"] == a["like"]) & (x["licence"] < a["licence"])), x).otherwise(a))
    best = F.when(value.rlike(CUE), likest).otherwise(nothing)
    row = F.struct(*carried) if carried else F.lit(None)
    stated = files.select(F.col(path).alias("path"), row.alias("row"), value.alias("text"), best.alias("best"))
    found = F.coalesce(F.col("best.licence") != NONE, F.lit(False))
    mostly = F.col("best.of_file") & (F.col("best.words") >= MOSTLY * F.size(_terms(F.col("text"))))
    named = F.coalesce(F.col("path").rlike(LICENCE_FILE), F.lit(False))
    return stated.select(
        "path",
        "row",
        F.when(found, F.col("best.licence")).otherwise(NONE).alias("own"),
        F.when(found, F.col("best.like")).otherwise(0.0).alias("like"),
        (found & F.col("path").isNotNull() & (named | mostly)).alias("covers"),
    )


def directory(path: Column) -> Column:
    """All before the last stroke; the empty string is the top."""
    return F.regexp_replace(path, "(^|/)[^/]*$", "")


def ancestors(folder: Column) -> Column:
    """The directory itself and those above it, with the number of their names; the top has none."""
    names = F.filter(F.split(folder, "/"), lambda x: x != "")
    return F.transform(
        F.sequence(F.lit(0), F.size(names)),
        lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(names, F.lit(1), n), "/").alias("above")),
    )


def scan(files: DataFrame, path: str = "path", text: str = "text", carried: tuple[str, ...] = ()) -> DataFrame:
    """``path``, ``own``, ``like``, ``licence`` and ``origin`` (own, inherited or none), a row for each row.

    Columns named in ``carried`` come back in the struct ``row``.
    """
    idf = weights(document_frequencies(files, text))
    own = own_licences(files, idf, path, text, carried).withColumn("folder", directory(F.col("path")))
    plain = F.array_join(F.filter(F.split("folder", "/"), lambda x: x != ""), "/")
    covered = (
        own.where("covers")
        .groupBy(plain.alias("above"))
        .agg(F.max_by("own", F.struct("like", F.transform(F.split("own", ""), lambda c: -F.ascii(c)))).alias("licence"))
    )
    folders = own.where("folder is not null").select("folder").distinct()
    spread = folders.select("folder", F.explode(ancestors(F.col("folder"))).alias("a")).select("folder", "a.depth", "a.above")
    inherited = cut(spread.join(covered, "above").groupBy("folder").agg(F.max_by("licence", "depth").alias("inherited")))
    if inherited.count() <= SENT:
        joined = own.join(F.broadcast(inherited), "folder", "left")
    else:  # one directory may hold very many files
        part = F.pmod(F.xxhash64("path", "row"), F.lit(PARTS)).cast("int")
        spread_out = inherited.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
        joined = own.withColumn("part", part).join(spread_out, ["folder", "part"], "left")
    return joined.select(
        "path",
        *(["row"] if carried else []),
        "own",
        "like",
        F.when(F.col("own") != NONE, F.col("own")).otherwise(F.coalesce("inherited", F.lit(NONE))).alias("licence"),
        F.when(F.col("own") != NONE, "own").when(F.col("inherited").isNotNull(), "inherited").otherwise(NONE).alias("origin"),
    )
