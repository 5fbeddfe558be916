"""Licence scan with a positional index of rare template words.

Words of the licence templates are looked up in every document together with their places.  The words of each template
that are rarest in the corpus are indexed, and wherever one of them stands it votes for (template, shift) pairs; a
template counts where its aligned words carry enough weight and its key phrase stands at the aligned place.  Documents
without any key phrase cannot pass and cast no votes.  Templates are a parameter; the index is bounded by them.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeops.llm.common import store, whole

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases that always count, and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Label, key phrase and wording of usual licence notices (lower case, words only).
NOTICES = [
    ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "licensed under the apache license", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license"),
    ("gpl", "gnu general public license", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "gnu general public license", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", "gnu affero general public license", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-3-clause", "may be used to endorse or promote products derived from this software", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("isc", "distribute this software for any purpose with or without fee", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "mozilla public license", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "unencumbered software released into the public domain", "this is free and unencumbered software released into the public domain"),
    ("public-domain", "dedicated to the public domain", "this work is dedicated to the public domain"),
    ("cc0", "waived all copyright and related or neighboring rights", "to the extent possible under law the author has waived all copyright and related or neighboring rights"),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "cc by sa", "licensed under cc by sa 4 0"),
    ("cc-by", "creative commons attribution", "licensed under a creative commons attribution 4 0 international license"),
]
# Links to the licences of one family, by version.
LINKS = [
    (f"cc-{variant}".replace(" ", "-"), f"creativecommons org licenses {variant} {version} 0", f"creativecommons org licenses {variant} {version} 0")
    for variant in ("by", "by nc", "by nd", "by sa", "by nc nd", "by nc sa") for version in (3, 4)
]
TEMPLATES = NOTICES + LINKS
# Template words too plain to index.
PLAIN = "a and any are be by can copy for in is it not of or that the this to use v with without you may work file files free person terms 0 2 3 4".split()
RARE_PER_TEMPLATE = 6  # words of a template in the index
MIN_COVER = 0.5  # weight of a template's indexed words that must align


Template = tuple[str, str, str]  # label, key phrase, wording


def vocabulary(templates: list[Template]) -> list[str]:
    return sorted({w for _, _, text in templates for w in text.split() if w not in PLAIN})


def key_place(key: str, text: str) -> int:
    """Place of the key phrase in the wording; every template must hold its own."""
    ks, ws = key.split(), text.split()
    for i in range(len(ws)):
        if ws[i : i + len(ks)] == ks:
            return i
    raise ValueError(f"key phrase not in the wording: {key!r}")


def array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def evidence(docs: DataFrame, templates: list[Template] = TEMPLATES) -> DataFrame:
    """Per row: doc_id, number of words, base places, places of key phrases, licence words with their places where there
    is a key phrase; no text."""
    tokens, words = F.col("tokens"), vocabulary(templates)
    keys = F.array(*[F.struct(F.lit(k).alias("key"), array(k.split()).alias("ws")) for k in sorted({key for _, key, _ in templates})])

    def places(phrase: str) -> Column:
        ws = phrase.split()
        hit = lambda i: [F.get(tokens, i + k) == w for k, w in enumerate(ws)]

        def all_of(i):
            out = hit(i)[0]
            for x in hit(i)[1:]:
                out = out & x
            return F.coalesce(out, F.lit(False))

        return F.filter(F.sequence(F.lit(0), F.col("n_words") - 1), all_of)

    base = {p: F.when(F.col("body").contains(p.split()[-1]) & F.col("body").contains(p.split()[0]) & (F.col("n_words") > 0), places(p)).otherwise(F.array().cast("array<int>")) for p in BASE}
    joined = F.concat(F.lit(" "), F.array_join(tokens, " "), F.lit(" "))
    # the joined words are bound to a variable, so they are joined once for all phrases
    present = F.get(F.transform(F.array(joined), lambda j: F.filter(keys, lambda k: j.contains(F.concat(F.lit(" "), k["key"], F.lit(" "))))), F.lit(0))
    at = lambda k: F.filter(F.sequence(F.lit(0), F.col("n_words") - 1), lambda i: F.slice(tokens, i + 1, F.size(k["ws"])) == k["ws"])
    hits = F.filter(F.transform(tokens, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: x["w"].isin(*words))
    return (
        docs.select("doc_id", F.translate(whole("text"), string.ascii_uppercase, string.ascii_lowercase).alias("body"))
        .withColumn("tokens", F.regexp_extract_all("body", F.lit(WORD), F.lit(0)))
        .withColumn("n_words", F.size(tokens))
        .withColumn("known", F.array_intersect(tokens, array(words)))
        .withColumn("present", F.when(F.size("known") > 0, present).otherwise(F.slice(keys, 1, 0)))
        .select(
            "doc_id", F.col("n_words").cast("long").alias("n_words"), "known",
            *[v.alias(f"at_{i}") for i, v in enumerate(base.values())],
            F.when(F.size("present") > 0, hits).alias("hits"),
            F.when(F.size("present") > 0, F.transform("present", lambda k: F.struct(k["key"].alias("key"), at(k).alias("at")))).alias("key_at"),
        )
    )


def rare_index(found: DataFrame, n_docs: int, templates: list[Template] = TEMPLATES) -> list[tuple[str, int, int, float]]:
    """(word, template, place in it, weight) of each template's rarest words; bounded by the templates, not the corpus."""
    rows = found.select(F.explode("known").alias("w")).groupBy("w").count().collect()
    seen = {r.w: r["count"] for r in rows}
    idf = {w: math.log((1 + n_docs) / (1 + seen.get(w, 0))) + 1e-9 for w in vocabulary(templates)}
    index = []
    for t, (_, _, text) in enumerate(templates):
        ws = text.split()
        rare = sorted({w for w in ws if w in idf}, key=lambda w: (-idf[w], w))[:RARE_PER_TEMPLATE]
        index += [(w, t, p, idf[w]) for p, w in enumerate(ws) if w in rare]
    return index


def scan(docs: DataFrame, templates: list[Template] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score per row of ``docs``.

    A null or empty text has no words and no labels: counts 0, places null, labels empty, score 0.  ``score`` is 1 with a
    base phrase, else the largest aligned share of a verified template.  Equal places count once per phrase.  Rows that
    repeat are judged each; a text may hold any number of words and notices; other columns of ``docs`` do not matter.
    """
    found = store(evidence(docs, templates), "license_evidence")
    index = rare_index(found, found.count(), templates)
    weight = {}
    for w, t, _, v in index:
        weight.setdefault(t, {})[w] = v
    postings = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(t).alias("t"), F.lit(p).alias("p"), F.lit(v / sum(weight[t].values())).alias("v")) for w, t, p, v in index])
    indexed = sorted({w for w, _, _, _ in index})
    word_votes = F.flatten(F.transform(
        F.filter("hits", lambda h: h["w"].isin(*indexed)),
        lambda h: F.transform(F.filter(postings, lambda p: p["w"] == h["w"]), lambda p: F.struct(p["t"].alias("t"), (h["i"] - p["p"]).alias("shift"), p["w"].alias("w"), p["v"].alias("v"))),
    ))
    # a key phrase votes too, for its own place: with the empty word, which sorts before the words of its alignment
    owners = F.array(*[F.struct(F.lit(key).alias("key"), F.lit(t).alias("t"), F.lit(key_place(key, text)).alias("p")) for t, (_, key, text) in enumerate(templates)])
    key_votes = F.flatten(F.transform("key_at", lambda k: F.flatten(F.transform(
        F.filter(owners, lambda o: o["key"] == k["key"]),
        lambda o: F.transform(k["at"], lambda i: F.struct(o["t"].alias("t"), (i - o["p"]).cast("int").alias("shift"), F.lit("").alias("w"), F.lit(0.0).alias("v"))),
    ))))
    votes = F.concat(key_votes, word_votes)
    # the votes of one alignment lie together once sorted, equal ones side by side, so one fold finds each template's best
    # alignment; done has one entry per template, as a text may hold a notice any number of times
    ordered = F.array_sort("votes")
    start = F.struct(
        F.lit(-1).alias("t"), F.lit(0).alias("shift"), F.lit("").alias("w"), F.lit(False).alias("keyed"), F.lit(0.0).alias("sum"), F.array().cast("array<struct<t:int,cover:double>>").alias("done")
    )

    def fold(a, x):
        same = (a["t"] == x["t"]) & (a["shift"] == x["shift"])
        keyed = (same & a["keyed"]) | (x["w"] == "")
        total = F.when(same & (a["w"] == x["w"]), a["sum"]).when(same, a["sum"] + x["v"]).otherwise(x["v"])
        n, entry = F.size(a["done"]), lambda cover: F.array(F.struct(x["t"].alias("t"), cover.alias("cover")))
        last = F.get(a["done"], n - 1)
        done = (
            F.when(~keyed | (total < MIN_COVER), a["done"])
            .when((n > 0) & (last["t"] == x["t"]), F.concat(F.slice(a["done"], F.lit(1), n - 1), entry(F.greatest(last["cover"], total))))
            .otherwise(F.concat(a["done"], entry(total)))
        )
        return F.struct(x["t"].alias("t"), x["shift"].alias("shift"), x["w"].alias("w"), keyed.alias("keyed"), total.alias("sum"), done.alias("done"))

    label_of = array([x for x, _, _ in templates])
    verified = F.aggregate(ordered, start, fold)["done"]
    at = [F.col(f"at_{i}") for i in range(len(BASE))]
    every = F.array_sort(F.concat(*at))
    base = F.filter(F.array(*[F.when(F.size(a) > 0, F.lit(label)) for a, label in zip(at, BASE.values())]), lambda x: x.isNotNull())
    return (
        found.withColumn("votes", F.when(F.col("hits").isNotNull(), votes))
        .withColumn("verified", F.when(F.size("votes") > 0, verified).otherwise(F.array().cast("array<struct<t:int,cover:double>>")))
        .withColumn("every", every).withColumn("base", base)
        .select(
            "doc_id", "n_words", F.size("every").cast("long").alias("n_base"),
            F.get("every", F.lit(0)).cast("long").alias("first_word"), F.when(F.size("every") > 0, F.element_at("every", -1)).cast("long").alias("last_word"),
            F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
            F.array_join(F.array_sort(F.array_distinct(F.concat("base", F.transform("verified", lambda d: F.get(label_of, d["t"]))))), ",").alias("labels"),
            F.when(F.size("base") > 0, 1.0).otherwise(F.least(F.lit(1.0), F.coalesce(F.array_max(F.transform("verified", lambda d: d["cover"])), F.lit(0.0)))).alias("score"),
        )
    )
