"""License scans: TF-IDF cosine to templates, then inheritance along directories.

Every sentence or line of a file that speaks of a licence is a sparse TF-IDF
vector over its words (inverse document frequency over all such lines of the
corpus and the templates). Titles that run over lines, with their version, are
one such line more. An SPDX-License-Identifier line names its licence itself (the
whole expression). Otherwise a file's own licence is the template with the
largest cosine to one of its lines, from ``LEAST`` on. A file named as
licence files are (``_NAMED``), of any length, that has a licence is its
directory's licence file (the most frequent licence, then the first by name,
where there are several). A file without an own licence takes that of the nearest
ancestor directory that has a licence file, found by joining the directories'
ancestors to the licence files.

DataFrame operations only. Templates are a fixed short list, so their vectors
are the only thing broadcast.

Rows: a null text has no licence of its own; a null path has no directory and
inherits nothing; repeated rows give repeated results; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from drivelake.llm.common import written

LEAST = 0.5
#: Notices by which files name their licence, by SPDX identifier.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("ISC", "Released under the ISC License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC0-1.0", "Licensed under CC0 1.0 Universal, dedicated to the public domain."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", "Released under the Unlicense."),
]
_NAMED = r"(?i)(?:^|/)(?:[^/]*[._-])?(?:un)?(?:licen[cs]e|copying|notice)s?(?:[._-](?:mit|apache|bsd|[al]?gpl|mpl|cc|isc|lesser|lib)[a-z0-9.+-]*?)?(?:\.(?:txt|md|rst|html?))?$"
_SPEAKS = r"(?i)licen[cs]e|copyright|redistribut|permission (?:is hereby|to use)|unencumbered|spdx"
_TITLE = r"(?i)(?:GNU (?:Lesser |Affero )?General Public|Apache|Mozilla Public) License\s+Version [0-9.]+[^\n]*"
_SPDX = r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+()-]+(?:[ \t]+(?:AND|OR|WITH)[ \t]+[A-Za-z0-9.+()-]+)*)"
#: The third clause of a full BSD text; without it there are two.
_THIRD = r"(?i)neither\s+the\s+names?\s+of"


def _terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9.+]+"), lambda w: F.length(F.regexp_replace(w, "[.]", "")) > 0)


def _vectors(lines: DataFrame, idf: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., term, w): unit-length TF-IDF of each line."""
    tf = lines.select(*keys, F.explode("terms").alias("term")).select(*keys, F.regexp_replace("term", "[.]+$", "").alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("tf"))
    w = tf.join(idf, "term").select(*keys, "term", ((1 + F.log(F.col("tf").cast("double"))) * F.col("idf")).alias("w"))
    length = w.groupBy(*keys).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    return w.join(length, keys).select(*keys, "term", (F.col("w") / F.col("length")).alias("w"))


def own_licences(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(line hash, licence, score) of the distinct lines that reach ``LEAST``."""
    lines = files.select(F.explode("lines").alias("line")).groupBy("line").agg(F.count("*").alias("seen"))
    lines = written(lines.withColumns({"key": F.sha2("line", 256), "terms": _terms(F.col("line"))}), spark, "licence-lines")
    known = spark.createDataFrame([(f"t{i}", name, line) for i, (name, line) in enumerate(TEMPLATES)], "key string, licence string, line string")
    known = known.withColumns({"seen": F.lit(1).cast("long"), "terms": _terms(F.col("line"))})
    every = lines.select("seen", "terms").union(known.select("seen", "terms"))
    clean = F.array_distinct(F.transform("terms", lambda t: F.regexp_replace(t, "[.]+$", "")))
    total = every.agg(F.sum("seen")).first()[0]
    idf = every.select("seen", F.explode(clean).alias("term")).groupBy("term").agg(F.log(F.lit(1.0 + total) / (1 + F.sum("seen"))).alias("x")).select("term", (F.col("x") + 1).alias("idf"))
    idf = written(idf, spark, "licence-idf")
    a = _vectors(lines, idf, ["key"])
    b = _vectors(known, idf, ["key", "licence"]).select(F.col("key").alias("template"), "licence", "term", F.col("w").alias("v"))
    cosine = a.join(F.broadcast(b), "term").groupBy("key", "template", "licence").agg(F.sum(F.col("w") * F.col("v")).alias("score"))
    best = cosine.where(F.col("score") >= LEAST).groupBy("key").agg(F.min(F.struct(-F.round("score", 9), "licence")).alias("x"))
    return best.select("key", F.col("x.licence").alias("licence"), (-F.col("x.col1")).alias("score"))


def _ancestors(directory: Column) -> Column:
    """The directory and all above it, with their depth."""
    parts = F.split(directory, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(parts, 1, i), "/").alias("up")))


def scan(spark: SparkSession, files: DataFrame, path: Column, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per file: doc_id, path, own_licence, score, licence, origin (own, inherited or none)."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    d = files.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), path.cast("string").alias("path"), text.alias("text"))
    titles = F.transform(F.regexp_extract_all("text", F.lit(_TITLE), F.lit(0)), lambda x: F.regexp_replace(x, r"\s+", " "))
    spoken = F.filter(F.split("text", r"\n|(?<=[.!?])\s+"), lambda x: x.rlike(_SPEAKS) & ~x.contains("SPDX-License-Identifier"))
    lines = F.when(F.col("text").rlike(_SPEAKS), F.concat(spoken, titles))
    spdx = F.when(F.col("text").contains("SPDX-License-Identifier"), F.nullif(F.regexp_extract("text", _SPDX, 1), F.lit("")))
    d = d.withColumns({"spdx": spdx, "two": F.col("text").rlike(r"(?i)redistributions\s+in\s+binary\s+form\s+must") & ~F.col("text").rlike(_THIRD)})
    d = d.select("doc_id", "path", "spdx", "two", F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("directory"), F.coalesce(F.col("path").rlike(_NAMED), F.lit(False)).alias("named"),
                 F.coalesce(F.array_distinct(lines), F.array().cast("array<string>")).alias("lines"), F.monotonically_increasing_id().alias("row_id"))
    d = written(d, spark, "licence-files")
    line = own_licences(spark, d)
    hits = d.where(F.size("lines") > 0).select("row_id", F.explode("lines").alias("line")).select("row_id", F.sha2("line", 256).alias("key")).join(line, "key")
    own = hits.groupBy("row_id").agg(F.min(F.struct((-F.col("score")).alias("score"), "licence")).alias("x")).select("row_id", F.col("x.licence").alias("own_licence"), (-F.col("x.score")).alias("score"))
    d = d.drop("lines").join(own, "row_id", "left")
    clauses = F.when((F.col("own_licence") == "BSD-3-Clause") & F.col("two"), "BSD-2-Clause").otherwise(F.col("own_licence"))
    d = d.withColumns({"own_licence": F.coalesce("spdx", clauses), "score": F.when(F.col("spdx").isNotNull(), F.lit(1.0)).otherwise(F.col("score"))})
    d = written(d.drop("spdx", "two"), spark, "licence-own")
    votes = d.where("named and own_licence is not null").groupBy("directory", "own_licence").agg(F.count("*").alias("n"))
    held = votes.groupBy("directory").agg(F.min(F.struct((-F.col("n")).alias("n"), "own_licence")).alias("x")).select(F.col("directory").alias("up"), F.col("x.own_licence").alias("above"))
    dirs = d.where("path is not null").select("directory").distinct().select("directory", F.explode(_ancestors(F.col("directory"))).alias("a")).select("directory", "a.*")
    near = dirs.join(held, "up").groupBy("directory").agg(F.max(F.struct("depth", "above")).alias("x")).select("directory", F.col("x.above").alias("above"))
    d = d.join(near, "directory", "left").withColumn("above", F.when(F.col("path").isNotNull(), F.col("above")))
    origin = F.when(F.col("own_licence").isNotNull(), "own").when(F.col("above").isNotNull(), "inherited").otherwise("none")
    return d.select("doc_id", "path", "own_licence", "score", F.coalesce("own_licence", "above").alias("licence"), origin.alias("origin"))
