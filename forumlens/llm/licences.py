"""Licence scan: TF-IDF cosine of passages to licence notices, and inheritance from licence files above."""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import stage
from forumlens.operators.skew import look_up

# Licence names and the notices they are known by.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http www.apache.org licenses LICENSE-2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("LGPL-3.0", "under the terms of the GNU Lesser General Public License version 3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
)

#: Full licence texts, with which whole files are compared.
TEXTS = tuple((p.stem, p.read_text(encoding="utf-8")) for p in sorted((Path(__file__).parent / "licence_texts").glob("*.txt")))

MIN_COSINE = 0.75
#: Share of a full text's squared length that its light terms make up.
LIGHT = 0.1
#: Share of a file's words from which its notice makes it a licence file, which speaks for its directory.
FILE_SHARE = 0.5
WORD = r"[a-z0-9]+(?:[.][0-9]+)*"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _idf(files: DataFrame, vocabulary: list[str]) -> tuple[dict[str, float], float]:
    """Inverse document frequency of the notices' terms over all files, and that of a term never seen."""
    known = F.split(F.lit(" ".join(vocabulary)), " ")
    found = files.select(F.explode(F.concat(F.array(F.lit("")), F.array_intersect(words(F.col("text")), known))).alias("term"))
    counts = {r.term: r["count"] for r in found.groupBy("term").count().collect()}
    total = counts.get("", 0)
    weight = lambda n: math.log((total + 1) / (n + 1)) + 1
    return {t: weight(counts.get(t, 0)) for t in vocabulary}, weight(0)


def _telling(vectors: list[dict[str, float]], cosine: float) -> list[str]:
    """Terms of which a passage needs one to come near a notice.

    Without its heaviest terms a notice keeps too little of its length to reach the cosine, whatever the
    passage, so passages that hold none of them can be left out unseen.
    """
    telling = set()
    for vector in vectors:
        rest = sum(w * w for w in vector.values())
        for term, weight in sorted(vector.items(), key=lambda x: (-x[1], x[0])):
            if rest < cosine * cosine:
                break
            telling.add(term)
            rest -= weight * weight
    return sorted(telling)


def _vectors(plain: list[Counter], idf: dict[str, float]) -> list[dict[str, float]]:
    """TF-IDF vectors of length one."""
    out = []
    for terms in plain:
        own = {t: n * idf[t] for t, n in terms.items()}
        length = math.sqrt(sum(w * w for w in own.values()))
        out.append({t: w / length for t, w in own.items()})
    return out


def _levels(vector: dict[str, float]) -> tuple[list[tuple[list[str], float]], float]:
    """A template's heavy terms in levels of like weight, with the largest squared weight of each, and the rest's sum.

    Whatever a text holds, its squared cosine is at most the sum of the squared weights of the terms it holds.
    """
    rest, levels = 1.0, []
    for term, w in sorted(vector.items(), key=lambda x: (-x[1], x[0])):
        if rest <= LIGHT:
            break
        if not levels or w * w < 0.6 * levels[-1][1]:
            levels.append(([], w * w))
        levels[-1][0].append(term)
        rest -= w * w
    return levels, rest


def _near_texts(base: DataFrame, vectors: list[dict[str, float]], idf: dict[str, float], unseen: float, cosine: float) -> DataFrame:
    """Whole files near a full text: path, text_key, notice (the text's number), cosine.

    Only files whose terms can reach the cosine, by the weights of a text's terms that they hold, are split into words.
    """

    def array(terms) -> Column:
        return F.split(F.lit(" ".join(sorted(terms))), " ")

    spark = base.sparkSession
    split = [_levels(v) for v in vectors]
    heavy = {t for levels, _ in split for terms, _ in levels for t in terms}

    def enough(held: Column) -> Column:
        tests = [
            reduce(Column.__add__, [F.size(F.array_intersect(held, array(t))) * F.lit(w) for t, w in levels]) >= cosine**2 - rest - 1e-9
            for levels, rest in split
        ]
        return reduce(Column.__or__, tests)

    # One element, so that the words are looked up once for all tests.
    near = F.exists(F.array(F.array_intersect(words(F.col("text")), array(heavy))), enough)
    weights = spark.createDataFrame([(t, float(w)) for t, w in idf.items()], "term string, idf double")
    shares = spark.createDataFrame(
        [(t, k, float(w)) for k, v in enumerate(vectors) for t, w in v.items()], "term string, notice int, share double"
    )
    key = ["path", "text_key"]
    counted = (
        base.where(near)
        .select(*key, F.explode(words(F.col("text"))).alias("term"))
        .groupBy(*key, "term")
        .count()
        .join(F.broadcast(weights), "term", "left")
        .withColumn("w", F.col("count") * F.coalesce("idf", F.lit(float(unseen))))
    )
    one = counted.groupBy(*key).agg(
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"), F.collect_list(F.struct("term", "w")).alias("terms")
    )
    return (
        one.select(*key, "length", F.inline("terms"))
        .join(F.broadcast(shares), "term")
        .groupBy(*key, "length", "notice")
        .agg(F.sum(F.col("w") * F.col("share")).alias("dot"))
        .select(*key, "notice", F.round(F.col("dot") / F.col("length"), 9).alias("cosine"))
        .where(F.col("cosine") >= cosine)
    )


def scan(files: DataFrame, notices: tuple = NOTICES, min_cosine: float = MIN_COSINE, texts: tuple = TEXTS) -> DataFrame:
    """The licence of each file: its own notice, else that of the nearest licence file above it.

    `files` has path and text; other columns are carried along. Adds licence, cosine (of the own notice
    or text, else null) and inherited_from (the directory, if inherited). Passages are paragraphs, lines and sentences of the
    whole text, compared with the notices by TF-IDF cosine; whole files are compared with full licence texts, and
    one that is near decides before a passage does. Term counts come from all files. A file near a full text, or
    whose notice makes up half of its words or more, speaks for its directory and all below. Ties go to the notice listed
    first, then to the smallest path. Null texts hold nothing; a null path inherits nothing; rows that repeat
    get the same answer; an empty table gives an empty result. A carried column named like an added one is
    replaced.
    """
    added = ("licence", "cosine", "inherited_from")
    carried = [c for c in files.columns if c not in ("path", "text", *added)]
    # Carried columns go by number meanwhile, as their names may be any.
    numbered = [F.col(f"`{c}`").alias(f"carried_{k}") for k, c in enumerate(carried)]
    base = files.select(*numbered, F.col("path").cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    base = base.withColumn("text_key", F.xxhash64("text"))
    plain = [Counter(re.findall(WORD, text.lower())) for _, text in notices]
    plain_texts = [Counter(re.findall(WORD, text.lower())) for _, text in texts]
    every, unseen = _idf(base, sorted(set().union(*plain, *plain_texts)))
    idf = {t: every[t] for t in sorted(set().union(*plain))}
    vectors = _vectors(plain, idf)
    spark = files.sparkSession
    weights = spark.createDataFrame([(t, float(w)) for t, w in idf.items()], "term string, idf double")
    templates = spark.createDataFrame(
        [(t, k, float(w)) for k, v in enumerate(vectors) for t, w in v.items()], "term string, notice int, share double"
    )
    telling = "(?:^|[^a-z0-9])(?:" + "|".join(re.escape(t) for t in _telling(vectors, min_cosine)) + ")(?:[^a-z0-9]|$)"
    cuts = [F.split("text", p) for p in (r"\n\s*\n", r"\n", r"(?<=[.!?])\s+")]
    near = F.filter(F.array_distinct(F.concat(*cuts)), lambda p: F.lower(p).rlike(telling))
    passages = (
        base.where(F.lower("text").rlike(telling))
        .select("path", "text_key", F.size(words(F.col("text"))).alias("file_words"), F.posexplode(near).alias("place", "passage"))
        .select("path", "text_key", "file_words", "place", words(F.col("passage")).alias("terms"))
    )
    key = ["path", "text_key", "place"]
    terms = passages.select(*key, "file_words", F.size("terms").alias("n_words"), F.explode("terms").alias("term"))
    counted = terms.groupBy(*key, "file_words", "n_words", "term").count().join(F.broadcast(weights), "term", "left")
    counted = counted.withColumn("w", F.col("count") * F.coalesce("idf", F.lit(float(unseen))))
    one = counted.groupBy(*key, "file_words", "n_words").agg(
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"), F.collect_list(F.struct("term", "w")).alias("terms")
    )
    dots = (
        one.select(*key, "file_words", "n_words", "length", F.inline("terms"))
        .join(F.broadcast(templates), "term")
        .groupBy(*key, "file_words", "n_words", "length", "notice")
        .agg((F.sum(F.col("w") * F.col("share"))).alias("dot"))
        .withColumn("cosine", F.round(F.col("dot") / F.col("length"), 9))
        .where(F.col("cosine") >= min_cosine)
    )
    def named(found: DataFrame, whole: bool, part: Column, listed: tuple) -> DataFrame:
        names = F.array(*[F.lit(n) for n, _ in listed])
        rank = [F.lit(whole).alias("whole"), "cosine", (-F.col("notice")).alias("order"), part.alias("part")]
        return found.select("path", "text_key", F.struct(*rank, F.get(names, F.col("notice")).alias("own")).alias("b"))

    ranked = named(dots, False, F.col("n_words") / F.col("file_words"), notices)
    if texts:
        near_texts = _near_texts(base, _vectors(plain_texts, every), every, unseen, min_cosine)
        ranked = ranked.unionByName(named(near_texts, True, F.lit(1.0), texts))
    own = stage(ranked.groupBy("path", "text_key").agg(F.max("b").alias("b")).select("path", "text_key", "b.own", "b.cosine", "b.part"))
    folder = folder_of(F.col("path"))
    spoken = (
        own.where(F.col("path").isNotNull() & (F.col("part") >= FILE_SHARE))
        .groupBy(folder.alias("above"))
        .agg(F.min(F.struct((-F.col("cosine")).alias("order"), "path", "own")).alias("s"))
        .select("above", F.col("s.own").alias("theirs"))
    )
    parts = F.split("folder", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    nearest = (
        base.where("path IS NOT NULL")
        .select(folder.alias("folder"))
        .distinct()
        .select("folder", F.explode(F.array_distinct(above)).alias("above"))
        .join(spoken, "above")
        .groupBy("folder")
        .agg(F.max(F.struct(F.length("above").alias("depth"), "above", "theirs")).alias("n"))
    )
    same = F.col("f.path").eqNullSafe(F.col("o.path")) & F.col("f.text_key").eqNullSafe(F.col("o.text_key"))
    found = base.drop("text").alias("f").join(own.alias("o"), same, "left").select(
        *[F.col(f"carried_{k}") for k in range(len(carried))], F.col("f.path").alias("path"),
        folder_of(F.col("f.path")).alias("folder"), "o.own", "o.cosine",
    )
    # A directory may hold a third of all files.
    return look_up(stage(found), nearest, "folder", "left").select(
        *[F.col(f"carried_{k}").alias(c) for k, c in enumerate(carried)],
        "path",
        F.coalesce("own", "n.theirs").alias("licence"),
        "cosine",
        F.when(F.col("own").isNull(), F.col("n.above")).alias("inherited_from"),
    )


def folder_of(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")
