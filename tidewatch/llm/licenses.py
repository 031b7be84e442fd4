"""License scan by diagonal voting.

All rolling word k-gram hashes of a text are joined to the positions of the same k-grams in license
templates, and the words at both places compared. A hit votes for its diagonal (text position less
template position); neighbouring diagonals, as inserted or lost words make them, are merged. A span
counts if enough different positions of its template stand in it, over no more than STRETCH times
the template's words; a merged span that is longer falls back to its best diagonal. All of it is
DataFrame expressions; only per-text sums are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower

K = 3
#: Diagonals that lie at most this far apart are one span.
NEAR = 2
#: A span counts if this share of its template's k-grams voted for it, and if it is at most so many times as long as the template.
SHARE, STRETCH = 0.75, 1.5
#: Words, as the contract of the scan defines them.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases that alone name a license, and its label.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Notices as licenses word them, by label.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _gram(words: Column, i: Column) -> Column:
    return F.xxhash64(*[F.get(words, i + j) for j in range(K)])


def _positions(words: Column) -> Column:
    """Starts of the k-grams of a word array; none if it is shorter."""
    return F.when(F.size(words) >= K, F.sequence(F.lit(0), F.size(words) - K)).otherwise(F.array().cast("array<int>"))


def templates(spark: SparkSession, texts: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """Rows (template, label, grams, gram, word, tpos); as many as the given notices have k-grams, a few hundred."""
    df = spark.createDataFrame([(k, label, text) for k, (label, text) in enumerate(texts)], "template int, label string, body string")
    df = df.select("template", "label", words_of(F.col("body")).alias("w"))
    return df.select("template", "label", (F.size("w") - K + 1).alias("grams"), F.explode(F.transform(_positions(F.col("w")), lambda i: F.struct(i.alias("tpos"), _gram(F.col("w"), i).alias("gram"), F.get(F.col("w"), i).alias("word")))).alias("g")).select("template", "label", "grams", "g.*")


def _base(words: Column, body: Column) -> Column:
    """(start, label) of every place of a base phrase; texts without the word are not walked."""

    def at(i: Column) -> Column:
        is_ = lambda back, w: F.get(words, i - back) == w
        return F.when(~is_(0, "license"), None).when((i >= 1) & is_(1, "mit"), F.struct((i - 1).alias("at"), F.lit("mit").alias("label"))).when((i >= 1) & is_(1, "apache"), F.struct((i - 1).alias("at"), F.lit("apache").alias("label"))).when((i >= 2) & is_(1, "public") & is_(2, "general"), F.struct((i - 2).alias("at"), F.lit("gpl").alias("label")))

    none = F.array().cast("array<struct<at:int,label:string>>")
    return F.when(F.contains(body, F.lit("license")), F.filter(F.transform(F.sequence(F.lit(0), F.size(words) - 1), at), lambda s: s.isNotNull())).otherwise(none)


def scan(docs: DataFrame, texts: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """Scan whole texts for license phrases and notices; a row for each document row.

    doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, and spans: the
    verified spans as (template, label, first word, last word, share of the template). score is
    the largest share of a span, 1 at most; 0 without one. Null and empty texts have no words and
    no labels. Repeated rows and null doc_ids are scanned each; other columns play no part.
    """
    w = F.col("w")
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("rid"), ascii_lower(F.coalesce(F.col("text"), F.lit(""))).alias("body"))
    read = read.select("doc_id", "rid", "body", F.regexp_extract_all("body", F.lit(WORD), F.lit(0)).alias("w"))
    base = F.col("base")
    read = read.select("doc_id", "rid", "w", _base(w, F.col("body")).alias("base"))
    read = read.select(
        "doc_id", "rid", F.size("w").cast("long").alias("n_words"), F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda s: s["at"])).cast("long").alias("first_word"), F.array_max(F.transform("base", lambda s: s["at"])).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(base["label"])).alias("base_set"),
        F.transform(_positions(w), lambda i: F.struct(_gram(w, i).alias("gram"), F.get(w, i).alias("word"))).alias("grams_"),
    )
    keys = ["rid", "doc_id", "n_words", "n_base", "first_word", "last_word", "base_set"]
    hits = read.select(*keys, F.posexplode_outer("grams_").alias("pos", "g")).select(*keys, "pos", "g.*").join(F.broadcast(templates(docs.sparkSession, texts)), ["gram", "word"], "left")
    # A diagonal's votes; all of a text's positions without a hit fold into one row before the shuffle.
    votes = hits.groupBy(*keys, "template", "label", "grams", (F.col("pos") - F.col("tpos")).alias("diagonal")).agg(F.collect_set("tpos").alias("tposes"), F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    by = Window.partitionBy("rid", "template").orderBy("diagonal")
    apart = F.when(F.col("diagonal") - F.lag("diagonal").over(by) <= NEAR, 0).otherwise(1)
    spans = votes.withColumn("apart", apart).withColumn("span", F.sum("apart").over(by)).groupBy(*keys, "template", "label", "grams", "span")
    merged = spans.agg(
        F.struct(F.size(F.array_distinct(F.flatten(F.collect_list("tposes")))).alias("votes"), (-F.min("lo")).alias("from"), F.max("hi").alias("to")).alias("all"),
        F.max(F.struct(F.size("tposes").alias("votes"), (-F.col("lo")).alias("from"), F.col("hi").alias("to"))).alias("best"),
    )
    long = F.col("all.to") + F.col("all.from") + K > STRETCH * (F.col("grams") + K - 1)
    merged = merged.withColumn("s", F.when(long, F.col("best")).otherwise(F.col("all"))).select(*keys, "template", "label", "grams", "s.votes", (-F.col("s.from")).alias("lo"), (F.col("s.to") + K - 1).alias("hi"))
    share = F.least(F.lit(1.0), F.col("votes") / F.col("grams"))
    good = F.when(F.col("template").isNotNull() & (F.col("votes") >= F.ceil(SHARE * F.col("grams"))), F.struct("template", "label", F.col("lo").alias("first_word"), F.col("hi").alias("last_word"), share.alias("share")))
    return (
        merged.groupBy(*keys).agg(F.sort_array(F.collect_list(good)).alias("spans"))
        .select(
            "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_set", ",").alias("base_labels"),
            F.array_join(F.array_sort(F.array_union("base_set", F.col("spans.label"))), ",").alias("labels"),
            F.coalesce(F.array_max("spans.share"), F.lit(0.0)).alias("score"), "spans",
        )
    )


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


#: The same scan in DuckDB's SQL, by the k-grams' words instead of their hashes.
ORACLE = rf"""
    WITH t0 AS (SELECT * FROM (VALUES {", ".join(f"({k}, {_sql(label)}, {_sql(text)})" for k, (label, text) in enumerate(TEMPLATES))}) v(template, label, body)),
    t1 AS (SELECT template, label, regexp_extract_all(translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM t0),
    t2 AS (SELECT template, label, w, len(w) - {K - 1} AS grams, unnest(range(0, len(w) - {K - 1})) AS tpos FROM t1),
    t AS (SELECT template, label, grams, tpos, array_to_string(w[tpos + 1 : tpos + {K}], ' ') AS gram FROM t2),
    d0 AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
    p0 AS (SELECT rid, w, unnest(range(0, len(w))) AS pos FROM d0),
    p AS (SELECT rid, pos, array_to_string(w[pos + 1 : pos + {K}], ' ') AS gram, w[pos + 1] AS a, w[pos + 2] AS b, w[pos + 3] AS c FROM p0),
    b0 AS (SELECT rid, pos, CASE WHEN a = 'mit' AND b = 'license' THEN 'mit' WHEN a = 'apache' AND b = 'license' THEN 'apache' WHEN a = 'general' AND b = 'public' AND c = 'license' THEN 'gpl' END AS label FROM p),
    b AS (SELECT rid, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM b0 WHERE label IS NOT NULL GROUP BY rid),
    v AS (SELECT rid, template, label, grams, pos - tpos AS diagonal, list(tpos) AS tposes, min(pos) AS lo, max(pos) AS hi FROM p JOIN t USING (gram) GROUP BY ALL),
    a AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY rid, template ORDER BY diagonal) <= {NEAR} THEN 0 ELSE 1 END AS apart FROM v),
    s AS (SELECT *, sum(apart) OVER (PARTITION BY rid, template ORDER BY diagonal) AS span FROM a),
    q AS (SELECT rid, label, max(grams) AS grams, CASE WHEN max(hi) - min(lo) + {K} > {STRETCH} * (max(grams) + {K - 1}) THEN max(len(tposes)) ELSE len(list_distinct(flatten(list(tposes)))) END AS votes FROM s GROUP BY rid, template, label, span),
    g AS (SELECT rid, label, least(1.0, votes / grams)::DOUBLE AS share FROM q WHERE votes >= ceil({SHARE} * grams)),
    n AS (SELECT rid, label FROM g UNION SELECT rid, label FROM b0 WHERE label IS NOT NULL),
    l AS (SELECT rid, string_agg(label, ',' ORDER BY label) AS labels FROM n GROUP BY rid),
    m AS (SELECT rid, max(share) AS score FROM g GROUP BY rid)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
    FROM d0 LEFT JOIN b USING (rid) LEFT JOIN l USING (rid) LEFT JOIN m USING (rid)"""
