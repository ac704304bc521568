"""License scan: headers and licence files by TF-IDF cosine to templates, then inheritance down the directories.

* **Windows.** The words of the whole text, whatever the line breaks and comment marks between them. For each template
  every run of as many words as it has is a window; a shorter text is one itself. So a header is found anywhere in a line,
  behind a copyright notice, or wrapped over lines. Windows that cannot reach what is asked of them are not computed:
  running sums of squared weights bound the cover of all windows at once, and with it the cosine.
* **Cosine.** Windows and templates are vectors of words, weighted by term frequency and by the inverse frequency of a word
  over the templates. So a score depends on the window alone, not on the size or the other texts of the corpus. The best
  template of any window at or above ``threshold`` is the file's own licence; ties go to the name that sorts first.
  A window's words must also make up ``COVER`` of the template's squared norm, so a word said again and again states nothing.
  Templates of at most ``SHORT_WORDS`` words need ``SHORT_THRESHOLD``, as one other word among so few says nothing.
* **Tags.** Identifiers behind ``SPDX-License-Identifier:`` that are licences of templates count as a cosine of 1.
* **Inheritance.** A directory's licence comes from its licence files (names in ``LICENCE_FILES``), the best one first.
  Files without a licence of their own are joined with every ancestor of their path, and take the nearest that has one.
  Directories have one row each, so a directory with a third of all files is a key that adaptive execution may split.

Defined cases: null and empty texts have no licence of their own. A null path has no ancestors. Every row is judged by its
own text, whether its ``fid`` is null or repeated, and rows that repeat a path are judged one by one. Very long texts are
read whole. Extra columns are not carried. Without files or templates the result has no licences.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.common import stored

THRESHOLD = 0.5
SHORT_WORDS = 4
SHORT_THRESHOLD = 0.8
COVER = 0.5
#: Opening statements of common licences.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("GPL-2.0", "GNU General Public License version 2"),
    ("GPL-3.0", "GNU General Public License version 3"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License, CC BY 4.0."),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International"),
    ("CC-BY-4.0", "CC BY 4.0"),
    ("CC-BY-NC-4.0", "CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("Proprietary", "All rights reserved."),
]
#: Names of licence files.
LICENCE_FILES = ("license", "licence", "copying", "notice", "unlicense")


def template_table(spark: SparkSession, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    return spark.createDataFrame(sorted(templates or TEMPLATES), "license string, text string")


TOKEN = re.compile(r"[a-z]+|[0-9][0-9.]*[0-9]|[0-9]")
TAG = re.compile(r"spdx-license-identifier:[ \t]*([^\n]*)")
IDENTIFIER = re.compile(r"[a-z0-9.+-]+")


class Matcher:
    """Cosines of the windows of texts with templates."""

    def __init__(self, templates: list[tuple[str, str]], threshold: float = THRESHOLD):
        told = [(name, TOKEN.findall((text or "").lower())) for name, text in templates]
        told = [(name, words) for name, words in told if words]
        often = Counter(word for _, words in told for word in set(words))
        total = len(told) + 1
        self.idf = {word: math.log(1 + total / (n + 1)) for word, n in often.items()}
        self.unknown = math.log(1 + total)
        self.names = {name.lower(): name for name, _ in templates}
        self.templates: list[tuple[str, int, dict[str, float], float]] = []
        for name, words in told:
            vector = {word: (1 + math.log(n)) * self.idf[word] for word, n in Counter(words).items()}
            norm = math.sqrt(sum(v * v for v in vector.values()))
            unit = {word: v / norm for word, v in vector.items()}
            needed = max(threshold, SHORT_THRESHOLD) if len(words) <= SHORT_WORDS else threshold
            self.templates.append((name, len(words), unit, needed))
        self.numbers = {word: n for n, word in enumerate(sorted(often), 1)}
        self.masses = [np.array([0.0, *(unit.get(word, 0.0) ** 2 for word in sorted(often))]) for _, _, unit, _ in self.templates]

    def weight(self, word: str, n: int) -> float:
        return (1 + math.log(n)) * self.idf.get(word, self.unknown) if n else 0.0

    def best(self, text: str | None) -> tuple[float, str] | None:
        """Negative cosine and licence of the best window, if it reaches the threshold."""
        lower = (text or "").lower()
        found = [(-1.0, self.names[base]) for tag in TAG.findall(lower) for x in IDENTIFIER.findall(tag)
                 if (base := re.sub(r"-(only|or-later)$|\+$", "", x)) in self.names]
        words = TOKEN.findall(lower)
        known = np.fromiter((self.numbers.get(word, 0) for word in words), np.int64, len(words))
        if known.any():
            for (name, width, vector, needed), mass in zip(self.templates, self.masses, strict=True):
                reached = np.concatenate([[0.0], mass[known].cumsum()])
                shared = reached[width:] - reached[:-width] if len(words) >= width else reached[-1:]
                starts = np.flatnonzero(shared >= max(needed * needed, COVER) - 1e-9)
                if len(starts):
                    for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
                        cosine = self.slide(words[run[0]:run[-1] + width], width, vector)
                        found += [(-cosine, name)] if cosine >= needed else []
        return min(found, default=None)

    def slide(self, words: list[str], width: int, vector: dict[str, float]) -> float:
        """The highest cosine of a run of ``width`` words that covers enough of the template."""
        held: Counter = Counter()
        dot = square = most = cover = 0.0
        for i, word in enumerate(words):
            for changed, step in ((word, 1), (words[i - width] if i >= width else None, -1)):
                if changed is not None:
                    before, after = self.weight(changed, held[changed]), self.weight(changed, held[changed] + step)
                    held[changed] += step
                    if held[changed] == (step > 0):  # it came first, or went last
                        cover += step * vector.get(changed, 0.0) ** 2
                    dot += (after - before) * vector.get(changed, 0.0)
                    square += after * after - before * before
            if cover >= COVER and (i >= width - 1 or i == len(words) - 1):
                most = max(most, dot / math.sqrt(square))
        return min(most, 1.0)


def own_licences(files: DataFrame, templates: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Each file with the best licence that it states, else nulls: fid, path, own, score."""
    told = [(r.license, r.text) for r in templates.distinct().orderBy("license", "text").collect()]

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(told, threshold)
        for batch in batches:
            best = [matcher.best(t.as_py()) or (None, None) for t in batch.column(2)]
            own, score = pa.array([b[1] for b in best], pa.string()), pa.array([b[0] and -b[0] for b in best], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), own, score], ["fid", "path", "own", "score"])

    kind = files.schema["fid"].dataType.simpleString()
    return files.select("fid", "path", F.col(text).alias("t")).mapInArrow(judged, f"fid {kind}, path string, own string, score double")


def scan(files: DataFrame, templates: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``files(path, text, ...)`` with its ``fid``: license, score, origin (own, inherited, none), from_dir.

    ``templates(license, text)`` must be small: it is sent to all executors.
    """
    judged = stored(own_licences(files, templates, text, threshold), "licence-own")
    name = F.lower(F.regexp_extract("path", r"([^/]*)$", 1))
    official = F.lit(False)
    for word in LICENCE_FILES:
        official = official | name.startswith(word)
    folder = F.regexp_replace(F.coalesce("path", F.lit("")), r"/?[^/]*$", "")
    directories = judged.where(F.col("own").isNotNull() & F.col("path").isNotNull() & official).groupBy(folder.alias("dir")).agg(
        F.min(F.struct((-F.col("score")).alias("c"), F.col("own").alias("license"))).alias("b")).select("dir", F.col("b.license").alias("given"))
    parts = F.split(folder, "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(parts, 1, k), "/").alias("dir")))
    # Per folder, not per file: a folder with a third of all files is one row here and a key that may be split below.
    open_ = judged.where(F.col("own").isNull() & F.col("path").isNotNull()).select(folder.alias("folder"), ancestors.alias("a")).distinct()
    above = open_.select("folder", F.explode("a").alias("a")).select("folder", "a.depth", "a.dir")
    nearest = above.join(directories, "dir").groupBy("folder").agg(F.max(F.struct("depth", "dir", "given")).alias("n")).select(
        "folder", F.col("n.given").alias("given"), F.col("n.dir").alias("from_dir"))
    own = F.col("own").isNotNull()
    wanted = judged.withColumn("folder", F.when(~own & F.col("path").isNotNull(), folder))
    return wanted.join(nearest, "folder", "left").select(
        "fid", "path", F.coalesce("own", "given").alias("license"), F.coalesce("score", F.lit(0.0)).alias("score"),
        F.when(own, "own").when(F.col("given").isNotNull(), "inherited").otherwise("none").alias("origin"), "from_dir")
