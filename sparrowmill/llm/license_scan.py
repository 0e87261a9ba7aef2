"""Licence scan: TF-IDF cosine to templates, then inheritance from directories.

Built-in functions only. Lines, sentences and paragraphs (so wrapped notices and those in
a longer line are met whole) are scored against notices, headers and titles with binary
word counts; document frequencies of the templates' words are counted over all lines of
all files, other words have frequency zero. Licence files are also scored whole, by term
counts, against whole licence texts; frequencies there are over distinct licence files. An
SPDX tag is one term, so it has cosine 1 with its own id and 0 with others. A file without
a match takes the licence of the nearest directory above it that holds a licence file.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import lower_az, materialise, skew_join

# SPDX ids and the notices they are known by.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]
HEADERS = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Apache License Version 2.0"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "GNU General Public License Version 3"),
    ("MIT", "MIT License"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
]
#: Whole licence texts, in files named by id.
TEXTS = sorted((p.stem, p.read_text()) for p in (Path(__file__).parent / "licences").glob("*.txt"))
MIN_COSINE = 0.75
SPDX = r"(?i)SPDX-License-Identifier:\s*\(*([A-Za-z0-9.-]+)"
#: Ends of a paragraph (a line without words) or of a sentence.
PARAGRAPH = r"\n[^\p{L}\p{N}\n]*\n"
SENTENCE = PARAGRAPH + r"|(?<=[.!?])\s+"
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying)[^/]*$"
_WORD = r"[a-z0-9]+"


def _words(c):
    return F.array_distinct(F.regexp_extract_all(lower_az(c), F.lit(_WORD), F.lit(0)))


def whole_texts(files: DataFrame, texts) -> DataFrame:
    """Per distinct text of licence files: h, b (cosine, id of the best licence text)."""
    f = files.where(F.col("path").rlike(LICENCE_FILE)).select(F.sha2(F.encode("text", "UTF-8"), 256).alias("h"), "text").where("text is not null").dropDuplicates(["h"])
    f = materialise(f.select("h", F.explode(F.regexp_extract_all(lower_az(F.col("text")), F.lit(_WORD), F.lit(0))).alias("w")).groupBy("h", "w").agg(F.count(F.lit(1)).alias("tf")), "terms")
    n, size = f.agg(F.countDistinct("h"), F.count(F.lit(1))).first()
    df = f.groupBy("w").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log((1 + n) / (1 + F.coalesce("df", F.lit(0))) + 1)
    rows = [(i, w, c) for i, t in texts for w, c in Counter(re.findall(_WORD, t.lower())).items()]
    known = f.sparkSession.createDataFrame(rows, "id string, w string, ttf long").join(df, "w", "left").select("id", "w", (F.col("ttf") * idf).alias("x"), idf.alias("idf"))
    known = known.withColumn("t2", F.sum(F.col("x") * F.col("x")).over(Window.partitionBy("id")))  # rows of a licence text: fixed in size
    norm = skew_join(f, df, ["w"], "df", "h", size).groupBy("h").agg(F.sum((F.col("tf") * idf) ** 2).alias("d2"))
    dot = f.join(F.broadcast(known), "w").groupBy("h", "id").agg((F.sum(F.col("tf") * F.col("idf") * F.col("x")) / F.sqrt(F.first("t2"))).alias("dot"))
    return dot.join(norm, "h").select("h", "id", (F.col("dot") / F.sqrt("d2")).alias("cosine")).groupBy("h").agg(F.min(F.struct(-F.col("cosine"), "id")).alias("m")).select(
        "h", F.struct((-F.col("m.col1")).alias("cosine"), F.col("m.id").alias("id")).alias("whole"))


def key_words(terms: list[list[str]], idf2: dict[str, float], min_cosine: float) -> list[str]:
    """The fewest rarest words without which no unit can reach the cosine. If a unit has no key
    word, its product with a template is at most the sum of the squared weights of the words they
    share, and its norm is at least the root of that sum; so its cosine is at most the root of the
    share that the other words have of the template's squared norm."""
    left = {k: sum(idf2[w] for w in ws) for k, ws in enumerate(terms)}
    most = {k: (min_cosine - 1e-9) ** 2 * v for k, v in left.items()}
    keys = []
    for w in sorted(idf2, key=lambda w: (-idf2[w], w)):
        if all(left[k] < most[k] for k in left):
            break
        keys.append(w)
        for k, ws in enumerate(terms):
            left[k] -= idf2[w] * (w in ws)
    return keys


def scan_licences(files: DataFrame, templates=TEMPLATES + HEADERS, min_cosine: float = MIN_COSINE, texts=TEXTS) -> DataFrame:
    """Per row of `files` (file_id, path, text): file_id, path, own, cosine, licence, inherited_from.

    Null or empty text matches nothing; a null path inherits nothing; equal cosines go to the
    first id in order; of several licence files in a directory the best match, then the first
    id, counts; repeated rows are reported each; extra columns are ignored. `cosine` is that of the
    best unit with a key word or of the whole licence file, 0 where there is none."""
    terms = [sorted(set(re.findall(_WORD, t.lower()))) for _, t in templates]
    vocab = sorted({w for ws in terms for w in ws})
    files = files.select("file_id", "path", "text")
    lines = files.select(F.explode(F.array_distinct(F.split(F.coalesce("text", F.lit("")), "\n"))).alias("line"))
    hit = lines.select(F.array_intersect(_words(F.col("line")), F.array(*map(F.lit, vocab))).alias("ws"))
    n, n_files = hit.count(), files.count()
    df = {r.w: r["count"] for r in hit.select(F.explode("ws").alias("w")).groupBy("w").count().collect()}  # at most the vocabulary
    idf2 = {w: math.log((1 + n) / (1 + df.get(w, 0)) + 1) ** 2 for w in vocab}
    other = math.log(2 + n) ** 2
    weight = F.create_map(*[F.lit(x) for w in vocab for x in (w, idf2[w])])
    add = lambda known: F.aggregate(known, F.lit(0.0), lambda s, k: s + k["x"])

    def parse(unit):
        ws = _words(unit)
        known = F.array_intersect(ws, F.array(*map(F.lit, vocab)))
        return F.struct(F.size(ws).alias("n"), F.transform(known, lambda w: F.struct(w.alias("w"), weight[w].alias("x"))).alias("known"))

    def normed(x):
        return F.struct(x["known"].alias("known"), F.sqrt(add(x["known"]) + (x["n"] - F.size(x["known"])) * other).alias("norm"))

    def best_unit(ws):
        dot = lambda x: add(F.filter(x["known"], lambda k: k["w"].isin(ws))) / x["norm"]
        return F.coalesce(F.array_max(F.transform("_l", dot)), F.lit(0.0)) / math.sqrt(sum(idf2[w] for w in ws))

    text = F.coalesce("text", F.lit(""))
    units = F.array_distinct(F.concat(F.split(text, "\n"), F.split(text, PARAGRAPH), F.split(text, SENTENCE)))
    # Only units with a key word can match, so no other text is cut up.
    key = r"(?i)(?<![a-z0-9])(?:" + "|".join(key_words(terms, idf2, min_cosine)) + r")(?![a-z0-9])"
    parsed = F.transform(F.transform(F.filter(units, lambda u: u.rlike(key)), parse), normed)
    parsed = F.when(text.rlike(key), parsed).otherwise(F.array().cast("array<struct<known:array<struct<w:string,x:double>>,norm:double>>"))
    ids = sorted({i for i, _ in [*templates, *texts]})
    tag = F.regexp_replace(F.lower(F.regexp_extract("text", SPDX, 1)), r"(-only|-or-later|\.)$", "")
    tag = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for i in ids for x in (i.lower(), i)]), tag), F.lit(None).cast("string"))
    cand = files.withColumn("_l", parsed)
    per = [F.struct(best_unit(ws).alias("cosine"), F.lit(-k).alias("k"), F.lit(i).alias("id")) for k, ((i, _), ws) in enumerate(zip(templates, terms))]
    licence_file = F.col("path").rlike(LICENCE_FILE)
    # Scores are written, and so are the matches below: several joins read them, and none reads the texts again.
    own = materialise(cand.select("file_id", "path", F.greatest(*per).alias("b"), tag.alias("tag"), F.when(licence_file, F.sha2(F.encode("text", "UTF-8"), 256)).alias("h")), "scores")
    full = own.where("h is not null")
    counts = full.groupBy("h").agg(F.count(F.lit(1)).alias("_m"))
    full = skew_join(full, counts.join(whole_texts(files, texts), "h", "left"), ["h"], "_m", "file_id", n_files).drop("_m")
    own = full.unionByName(own.where("h is null").withColumn("whole", F.lit(None).cast("struct<cosine:double,id:string>")))
    better = F.coalesce(F.col("whole.cosine") > F.col("b.cosine"), F.lit(False))
    best = F.when(F.col("tag").isNotNull(), F.struct(F.lit(1.0).alias("cosine"), F.col("tag").alias("id"))).when(better, F.col("whole")).otherwise(F.struct("b.cosine", "b.id"))
    own = materialise(own.select("file_id", "path", best.alias("b")).select(
        "file_id", "path", F.round("b.cosine", 6).alias("cosine"), F.when(F.col("b.cosine") >= min_cosine, F.col("b.id")).alias("own")), "matches")
    home = F.regexp_replace("path", r"/?[^/]*$", "")
    dirs = own.where(F.col("path").rlike(LICENCE_FILE) & F.col("own").isNotNull()).withColumn("dir", home).groupBy("dir").agg(
        F.min(F.struct(-F.col("cosine"), "own")).alias("m")).select("dir", F.col("m.own").alias("dir_licence"))
    # Ancestors of distinct directories, so the join grows with directories, not files.
    homes = own.where(F.col("path").isNotNull()).withColumn("home", home).groupBy("home").agg(F.count(F.lit(1)).alias("_w"))
    parts = F.split("home", "/")
    above = homes.withColumn("depth", F.explode(F.sequence(F.lit(1), F.size(parts)))).withColumn("dir", F.array_join(F.slice(F.split("home", "/"), F.lit(1), F.col("depth")), "/"))
    near = above.join(dirs, "dir").groupBy("home").agg(F.max(F.struct("depth", "dir", "dir_licence")).alias("m"))
    near = homes.join(near, "home", "left").select("home", "_w", F.col("m.dir").alias("inherited_from"), F.col("m.dir_licence").alias("dir_licence"))
    own = own.withColumn("home", home)
    placed = skew_join(own.where("home is not null"), near, ["home"], "_w", "file_id", n_files)
    bare = own.where("home is null").withColumn("inherited_from", F.lit(None).cast("string")).withColumn("dir_licence", F.lit(None).cast("string"))
    cols = ["file_id", "path", "own", "cosine", "inherited_from", "dir_licence"]
    return placed.select(cols).unionByName(bare.select(cols)).select(
        "file_id", "path", "own", "cosine", F.coalesce("own", "dir_licence").alias("licence"), F.when(F.col("own").isNull(), F.col("inherited_from")).alias("inherited_from"))


def op8_license_scan(spark, sf_dir):
    """Documents as files: /<source>/<doc_id mod 97>/<doc_id>.txt, every 50th named LICENSE-<doc_id>."""
    from .common import table

    d = table(spark, sf_dir, "documents")
    name = F.when(F.col("doc_id") % 50 == 0, F.concat(F.lit("LICENSE-"), F.col("doc_id"))).otherwise(F.concat(F.col("doc_id"), F.lit(".txt")))
    path = F.concat_ws("/", F.lit(""), "source", F.when(F.col("doc_id") % 50 != 0, (F.col("doc_id") % 97).cast("string")), name)
    return scan_licences(d.select(F.col("doc_id").alias("file_id"), path.alias("path"), "text")).withColumnRenamed("file_id", "doc_id")
