"""License scans by diagonal voting of word k-grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.llm.common import WORD, as_text

K = 3
#: Fixed phrases of the base scan.
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
#: Further templates, found even where a few words differ: at most 65 words each.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights"),
]


def template_grams(spark: SparkSession, phrases: list[tuple[str, str]], templates: list[tuple[str, str]]) -> DataFrame:
    """``(hash, w0, w1, w2, template, tpos)``: every k-gram of every template, and one that marks each document."""
    rows = [("", "", "", -1, 0)]
    for number, (_, words) in enumerate([*phrases, *templates]):
        w = words.split()
        if not K <= len(w) <= 62 + K:
            raise ValueError(f"a template needs {K} to {62 + K} words: {words}")
        rows += [(*w[i : i + K], number, i) for i in range(len(w) - K + 1)]
    table = spark.createDataFrame(rows, "w0 string, w1 string, w2 string, template int, tpos int")
    return table.select(F.xxhash64("w0", "w1", "w2").alias("hash"), "*")


def lowered(text: Column) -> Column:
    """Lower case in which no character but A-Z becomes an ASCII letter (the Kelvin sign would)."""
    return F.lower(F.replace(text, F.lit("K"), F.lit("ĸ")))


def license_places(docs: DataFrame, phrases: list[tuple[str, str]] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES, slack: int = 3, share: float = 0.7) -> DataFrame:
    """``(doc_id, n_words, spans)`` for each document, spans ``(start, stop, template, exact, coverage)`` in words.

    Every rolling k-gram of the words is looked up by hash among the template positions, a broadcast table of at most
    63 rows for each given template, and verified word for word. Hits vote for their offset diagonal; diagonals of one
    template at most ``slack`` words apart whose hits adjoin are merged, which bridges inserted or missing words. A
    merged span counts if it covers ``share`` of the template's k-grams; a phrase of the base scan is ``exact`` on a
    single diagonal that has all of them.

    A null or empty text has no words and no spans. Votes are sets, and rows are told apart by place, so repeated rows
    come out as often as they come in; null ids stay; other columns are ignored.
    """
    grams = template_grams(docs.sparkSession, phrases, templates)
    size = F.size("w")
    zipped = F.arrays_zip(F.col("w").alias("w0"), F.slice("w", 2, size).alias("w1"), F.slice("w", 3, size).alias("w2"))
    mark = F.array(F.struct(F.lit("").alias("w0"), F.lit("").alias("w1"), F.lit("").alias("w2")))
    words = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"),
        F.regexp_extract_all(lowered(as_text("text")), F.lit(WORD), F.lit(0)).alias("w"),
    )
    rolling = words.select("row", "doc_id", size.cast("long").alias("n_words"), F.posexplode(F.concat(mark, zipped)).alias("pos", "g"))
    keyed = rolling.select("row", "doc_id", "n_words", (F.col("pos") - 1).alias("pos"), F.xxhash64("g.w0", "g.w1", "g.w2").alias("hash"), "g")
    same = (F.col("g.w0") == F.col("w0")) & (F.col("g.w1") == F.col("w1")) & (F.col("g.w2") == F.col("w2"))
    hits = keyed.join(F.broadcast(grams), "hash").where(same)
    votes = hits.groupBy("row", "doc_id", "n_words", "template", (F.col("pos") - F.col("tpos")).alias("diagonal")).agg(
        F.expr("bit_or(shiftleft(1L, tpos))").alias("mask"), F.min("pos").alias("low"), F.max("pos").alias("high")
    )
    order = Window.partitionBy("row", "doc_id", "n_words", "template").orderBy("low", "diagonal")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    opens = (F.col("diagonal") - F.lag("diagonal").over(order) > slack) | (F.lag("diagonal").over(order) - F.col("diagonal") > slack) | (F.col("low") - F.max("high").over(before) > K + slack)
    parted = votes.withColumn("opens", F.coalesce(opens.cast("int"), F.lit(0))).withColumn("part", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    count = F.get(F.array(*[F.lit(len(words.split()) - K + 1) for _, words in [*phrases, *templates]]), F.col("template"))
    full = F.expr("shiftleft(1L, grams) - 1")
    spans = parted.withColumn("grams", count).groupBy("row", "doc_id", "n_words", "template", "grams", "part").agg(
        F.expr("bit_or(mask)").alias("mask"), F.min("low").alias("start"), (F.max("high") + K).alias("stop"),
        F.array_sort(F.collect_list(F.when(F.col("mask") == full, F.col("diagonal")))).alias("exact"),
    )
    coverage = F.bit_count("mask") / F.col("grams")
    span = F.struct("start", "stop", "template", "exact", coverage.alias("coverage"))
    kept = (F.col("template") >= 0) & ((coverage >= share) | (F.size("exact") > 0))
    return spans.groupBy("row", "doc_id", "n_words").agg(F.array_sort(F.collect_list(F.when(kept, span))).alias("spans")).drop("row")


def labels_of(spans: Column, phrases: list[tuple[str, str]] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES, base: bool = False) -> Column:
    """Distinct labels, sorted and comma-joined: those of exact phrases, or of all spans."""
    names = F.array(*[F.lit(label) for label, _ in [*phrases, *templates]])
    chosen = F.filter(spans, lambda s: (s["template"] < len(phrases)) & (F.size(s["exact"]) > 0)) if base else spans
    return F.array_join(F.array_sort(F.array_distinct(F.transform(chosen, lambda s: F.get(names, s["template"])))), ",")


def exact_starts(spans: Column, phrases: list[tuple[str, str]] = PHRASES) -> Column:
    """First words of all places where a phrase of the base scan stands."""
    chosen = F.filter(spans, lambda s: s["template"] < len(phrases))
    return F.flatten(F.transform(chosen, lambda s: s["exact"]))
