"""License scan: TF-IDF cosine of lines to license templates, inherited along directories.

A line's words weigh their count times the inverse document frequency over all documents;
words that no template has weigh as if no document had them. The cosine to each template is
a sum over common words only. A line can't reach the threshold by the frequent words of a
template alone (their share of its length bounds the cosine), so only lines with one of the
other words, the anchors, are scored; none that would reach it is missed.

Whole documents are held against the full license texts in ``license_texts/`` in the same way;
only those with enough of a text's words to reach FILE_THRESHOLD are scored. A document that
reaches it has the text's license, whatever its lines say.

Such a document, or one whose scored lines hold half of its words or more, is a license file
and speaks for its directory. Documents without a license of their own take that of the nearest directory
above that has one, found by joining directories, not documents, with their ancestors.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gradeledger.llm.store import join_small, stored

#: Least cosine of a line to a template.
THRESHOLD = 0.6
#: Least cosine of a whole document to a full license text, where common words weigh more.
FILE_THRESHOLD = 0.85
#: Words: letters and digits, with dots or hyphens inside.
WORD = "[a-z0-9]+(?:[.-][a-z0-9]+)*"
# Names of licenses and the header phrases that grant them.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and modify it under the terms of the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
]


def template_words() -> list[tuple[int, str, int]]:
    """(template number, word, count)."""
    out = []
    for i, (_, text) in enumerate(TEMPLATES):
        found = re.findall(WORD, text.lower())
        out += [(i, w, found.count(w)) for w in sorted(set(found))]
    return out


def full_texts() -> list[tuple[str, Counter[str]]]:
    """(license, its text's words with their counts)."""
    files = sorted((Path(__file__).parent / "license_texts").glob("*.txt"))
    return [(f.stem, Counter(re.findall(WORD, f.read_text("utf-8").lower()))) for f in files]


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), F.lit(1))


def _table(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small table of literals."""
    structs = [F.struct(*(F.lit(v).alias(n) for v, n in zip(r, names, strict=True))) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def frequencies(docs: DataFrame) -> tuple[int, dict[str, int]]:
    """Number of documents, and of those with each word of the templates and texts: a row per word."""
    vocabulary = {w for _, w, _ in template_words()}.union(*(words for _, words in full_texts()))
    rows = docs.select(F.explode(F.array_distinct(_words(F.coalesce(F.col("text"), F.lit(""))))).alias("word"))
    counted = rows.join(F.broadcast(_vocabulary(docs.sparkSession, vocabulary)), "word").groupBy("word").count().collect()
    return docs.count(), {r["word"]: r["count"] for r in counted}


def _array(words: set[str]) -> Column:
    """A literal array; words have no spaces."""
    return F.split(F.lit(" ".join(sorted(words))), " ")


def _vocabulary(spark: SparkSession, words: set[str]) -> DataFrame:
    return spark.range(1).select(F.explode(_array(words)).alias("word"))


def _share(common: Column, squares: dict[str, float]) -> Column:
    """At least the sum of ``squares`` of the words in ``common`` (distinct): words are counted in
    classes, within which the squares differ by less than a half, and weigh as the class's largest.
    Few words are told by their number alone: the largest squares add up to less."""
    classes: dict[int, list[str]] = {}
    for w, x in squares.items():
        classes.setdefault(math.floor(math.log(x, 1.5)), []).append(w)
    total = F.lit(0.0)
    for words in classes.values():
        total = total + F.size(F.array_intersect(common, _array(set(words)))) * max(squares[w] for w in words)
    least, share = 0, 0.0
    for x in sorted(squares.values(), reverse=True):
        if share >= (FILE_THRESHOLD - 1e-9) ** 2:
            break
        least, share = least + 1, share + x
    return F.when(F.size(common) >= least, total).otherwise(0.0)


def whole_files(rows: DataFrame, n: int, found: dict[str, int]) -> DataFrame:
    """(key, file_license, file_score) of the documents that reach a full license text.

    The cosine is at most the share of the text's length that its words in the document make
    up. ``_share`` bounds that share from above, so no document that would reach
    FILE_THRESHOLD is left out, and few others are counted word by word.
    """
    idf = lambda w: math.log((1 + n) / (1 + found.get(w, 0))) + 1
    vectors, bounds, known = [], [], set()
    for i, (_, counts) in enumerate(full_texts()):
        own = {w: c * idf(w) for w, c in counts.items()}
        norm = math.sqrt(sum(v * v for v in own.values()))
        vectors += [(i, w, v / norm) for w, v in own.items()]
        known |= set(own)
        bounds.append({w: (v / norm) ** 2 for w, v in own.items()})

    def enough(common: Column) -> Column:
        found_any = F.lit(False)
        for squares in bounds:
            found_any = found_any | (_share(common, squares) >= (FILE_THRESHOLD - 1e-9) ** 2)
        return found_any

    # within lambdas, so that a text's words and its common ones are found once
    passed = F.filter(
        F.array(_words(F.coalesce("text", F.lit("")))),
        lambda words: F.exists(F.array(F.array_intersect(words, _array(known))), enough),
    )
    likely = rows.select("key", F.explode(passed).alias("words")).dropDuplicates(["key"])
    tokens = stored(likely.select("key", F.explode("words").alias("word")).groupBy("key", "word").agg(F.count("*").alias("tf")), "files")
    spark = rows.sparkSession
    weighed = spark.createDataFrame([(w, idf(w)) for w in sorted(known)], "word string, idf double")
    texts = spark.createDataFrame(vectors, "text int, word string, weight double")
    weighed = tokens.join(F.broadcast(weighed), "word", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(math.log(1 + n) + 1)))
    norms = weighed.groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = weighed.join(F.broadcast(texts), "word").groupBy("key", "text").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    scores = dots.join(norms, "key").withColumn("score", F.round(F.col("dot") / F.col("norm"), 9)).where(F.col("score") >= FILE_THRESHOLD)
    best = scores.groupBy("key").agg(F.max(F.struct("score", (-F.col("text")).alias("t"))).alias("b"))
    names = F.array(*(F.lit(name) for name, _ in full_texts()))
    return stored(best.select("key", F.get(names, -F.col("b.t")).alias("file_license"), F.col("b.score").alias("file_score")), "whole")


def weights(n: int, found: dict[str, int]) -> tuple[dict[str, float], list[tuple[int, str, float]], list[str]]:
    """Inverse document frequencies, unit template vectors, and the anchors."""
    idf = {w: math.log((1 + n) / (1 + found.get(w, 0))) + 1 for _, w, _ in template_words()}
    vectors, common = [], set(idf)
    for i in range(len(TEMPLATES)):
        own = {w: c * idf[w] for j, w, c in template_words() if j == i}
        norm = math.sqrt(sum(v * v for v in own.values()))
        vectors += [(i, w, v / norm) for w, v in own.items()]
        room = (THRESHOLD - 1e-9) ** 2 * norm**2
        for w in sorted(own, key=lambda w: (own[w], w)):
            room -= own[w] ** 2
            if room <= 0:
                common.discard(w)
    return idf, vectors, sorted(set(idf) - common)


def scan(docs: DataFrame, path: Column) -> DataFrame:
    """One row per document: doc_id, path, license, score, n_license_lines, origin (``own``,
    ``inherited`` or ``none``) and license_dir (the directory that it comes from, if inherited).

    ``path`` has directories separated by ``/``; a null path is at the root. A full text
    decides, else the best line, ties by the order of TEMPLATES; of a directory's license files, the best score,
    then the license's name. Null and empty texts have no license of their own. Repeated rows
    stay; further columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce(path, F.lit("")).alias("path"), F.col("text").cast("string").alias("text"))
    n, found = frequencies(rows)
    idf, vectors, anchors = weights(n, found)
    most = math.log(1 + n) + 1
    rows = rows.withColumn("key", F.xxhash64("doc_id", "path", "text"))
    lines = rows.select("key", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line", "t"))
    lines = lines.select("key", "line", _words(F.col("t")).alias("words"))
    lines = lines.where(F.arrays_overlap("words", F.array(*map(F.lit, anchors))))
    tokens = lines.distinct().select("key", "line", F.size("words").alias("n"), F.explode("words").alias("word"))
    tokens = tokens.groupBy("key", "line", "n", "word").agg(F.count("*").alias("tf"))
    known = _table(spark, sorted(idf.items()), ["word", "idf"])
    templates = _table(spark, vectors, ["template", "word", "weight"])
    weighed = tokens.join(F.broadcast(known), "word", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(most)))
    weighed = stored(weighed.select("key", "line", "n", "word", "w"), "lines")
    norms = weighed.groupBy("key", "line", "n").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = weighed.join(F.broadcast(templates), "word").groupBy("key", "line", "template").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    scores = dots.join(norms, ["key", "line"]).withColumn("score", F.col("dot") / F.col("norm")).where(F.col("score") >= THRESHOLD)
    best = F.row_number().over(Window.partitionBy("key", "line").orderBy(F.desc(F.round("score", 9)), "template"))
    per_line = scores.withColumn("r", best).where("r = 1")
    ranked = F.struct(F.round("score", 9).alias("s"), (-F.col("template")).alias("t"))
    per_doc = per_line.groupBy("key").agg(
        F.max(ranked).alias("best"), F.count("*").cast("long").alias("n_license_lines"), F.sum("n").alias("license_words")
    )
    per_doc = stored(per_doc.select("key", F.col("best.s").alias("score"), (-F.col("best.t")).alias("template"), "n_license_lines", "license_words"), "licensed")
    names = F.array(*(F.lit(name) for name, _ in TEMPLATES))

    narrow = rows.select("doc_id", "path", "key", F.size(_words(F.coalesce("text", F.lit("")))).alias("n_words"))
    narrow = narrow.withColumn("dir", F.regexp_extract("path", "^(.*)/[^/]*$", 1))
    own = join_small(narrow, per_doc, ["key"], spread=F.col("doc_id"))
    own = join_small(own, whole_files(rows, n, found), ["key"], spread=F.col("doc_id"))
    own = own.withColumn("license", F.coalesce("file_license", F.get(names, F.col("template")))).withColumn("score", F.coalesce("file_score", "score"))
    own = stored(own, "own")
    whole = F.col("file_license").isNotNull() | (2 * F.col("license_words") >= F.col("n_words"))
    files = own.where(F.col("license").isNotNull() & whole)
    of_dir = files.groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("b"))
    of_dir = of_dir.select(F.col("dir").alias("license_dir"), F.col("b.license").alias("dir_license"))
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.size(parts), F.lit(0), F.lit(-1)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(parts, 1, k), "/").alias("license_dir")))
    dirs = own.select("dir").distinct().select("dir", F.inline(above))
    nearest = dirs.join(of_dir, "license_dir").groupBy("dir").agg(F.max(F.struct("depth", "license_dir", "dir_license")).alias("b"))
    nearest = stored(nearest.select("dir", "b.license_dir", "b.dir_license"), "nearest")
    given = join_small(own, nearest, ["dir"], spread=F.col("key"))
    inherits = F.col("license").isNull() & F.col("dir_license").isNotNull()
    return given.select(
        "doc_id", "path", F.coalesce("license", "dir_license").alias("license"), F.round("score", 4).alias("score"),
        F.coalesce("n_license_lines", F.lit(0)).alias("n_license_lines"),
        F.when(F.col("license").isNotNull(), "own").when(inherits, "inherited").otherwise("none").alias("origin"),
        F.when(inherits, F.col("license_dir")).alias("license_dir"),
    )
