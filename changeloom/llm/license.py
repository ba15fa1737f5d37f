"""Operator 2, license scans by a positional rare-token index, with DataFrame functions only.

The index: every template's mandatory words are ranked by their IDF over the templates, and the rarest ``RARE`` of them
are posted, each under its place in that ranking (first, second, ...): word -> (template, position). The phrases of the
base are templates like the others.

A file is turned into its word array once. A file without any template's rarest word can't match and is done after one
hash test. Of the others the indexed words are looked up, those of highest IDF first (``rare_words`` names the highest),
and each occurrence turns its postings into (template, start) by relative position. The starts that the first, second and
third words of a template give are intersected; at those that are left the mandatory phrases are verified word by word,
and the share of the template's words that stand in place is the score. All of it happens within the row: no shuffle, no
join, and work that is linear in the number of words, times the postings of a word, however often it is repeated.

Defined cases: a null or empty text has no words, no labels and score 0; a null id keeps its row; repeated rows are
scanned each; texts of any length are scanned whole; no rows give no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base phrases and their labels.
BASE = (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))
#: Label, template, mandatory phrases (each occurs once in the template).
TEMPLATES = (
    ("mit", "released under the mit license", ("the mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("hereby granted free of charge", "any person obtaining a copy")),
    ("apache-2", "licensed under the apache license version 2 0", ("apache license version 2",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license", ("commons attribution noncommercial",)),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international license", ("commons attribution sharealike",)),
    ("cc0-1", "cc0 1 0 universal public domain dedication", ("cc0 1 0 universal",)),
    ("gpl-2", "this work is licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    ("lgpl-3", "licensed under the gnu lesser general public license version 3", ("gnu lesser general public license version 3",)),
    ("agpl-3", "licensed under the gnu affero general public license version 3", ("gnu affero general public license version 3",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use in source and binary forms",)),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee", ("permission to use copy modify", "with or without fee")),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", ("above copyright notice and this permission notice", "substantial portions of the software")),
    ("apache-2", "you may not use this file except in compliance with the license", ("may not use this file except in compliance",)),
    ("apache-2", "distributed under the license is distributed on an as is basis without warranties or conditions of any kind", ("without warranties or conditions of any kind",)),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", ("redistributions of source code must retain", "list of conditions and the following disclaimer")),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice", ("redistributions in binary form must reproduce",)),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("gnu general public license as published by the free software foundation",)),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", ("gnu lesser general public license as published",)),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", ("gnu affero general public license as published",)),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license", ("source code form is subject to the terms of the mozilla public license",)),
    ("isc", "provided that the above copyright notice and this permission notice appear in all copies", ("this permission notice appear in all copies",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rare words of a template that are posted and intersected.
RARE = 3
#: Added to starts, so that one before the file's first word stays positive; more than a template's length.
SHIFT = 1 << 20
#: Names of a file's rare words in the result.
NAMED = 5


def _at(words: list[str], phrase: list[str]) -> int:
    return next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)


def index(templates=TEMPLATES) -> list[dict]:
    """For each template, the base's phrases first: its words, the places of its mandatory phrases, and its rarest mandatory words with their places, rarest first."""
    every = [(label, p, (p,)) for label, p in BASE] + list(templates)
    df = Counter(w for _, t, _ in every for w in set(t.split()))
    out = []
    for label, text, phrases in every:
        words = text.split()
        places = [(_at(words, p.split()), p.split()) for p in phrases]
        mandatory = sorted({i + k for i, p in places for k in range(len(p))})
        rare = sorted(mandatory, key=lambda i: (-log(len(every) / df[words[i]]), i))[:RARE]
        out.append({"label": label, "words": words, "phrases": places, "rare": [(i, words[i], log(len(every) / df[words[i]])) for i in rare]})
    return out


def postings(table: list[dict]) -> list[dict[str, list[int]]]:
    """For each place in the ranking: word -> template * 2^32 + SHIFT - position; added to a word's place that is template and start."""
    out: list[dict[str, list[int]]] = [{} for _ in range(RARE)]
    for t, entry in enumerate(table):
        for k in range(RARE):
            at, word, _ = entry["rare"][min(k, len(entry["rare"]) - 1)]
            out[k].setdefault(word, []).append((t << 32) + SHIFT - at)
    return out


def _literal(x: object) -> Column:
    """A constant of lists and dictionaries; they are folded to one literal."""
    if isinstance(x, dict):
        return F.create_map(*[y for k, v in x.items() for y in (F.lit(k), _literal(v))])
    if isinstance(x, (list, tuple)):
        return F.array(*map(_literal, x))
    return F.lit(x).cast("long") if isinstance(x, int) else F.lit(x)


def scanned(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, rare_words`` per row."""
    table = index(templates)
    posted = postings(table)
    idf = {word: x for t in table for _, word, x in t["rare"]}
    ranked = sorted(idf, key=lambda word: (-idf[word], word))
    w = F.col("w")
    word = lambda at: F.get(w, at.cast("int"))
    text = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), UPPER, LOWER)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.array_remove(F.split(text, SEPARATORS), "").alias("w"))
    # The file's indexed words, highest IDF first, and their places; nothing where no template's rarest word occurs.
    may = F.arrays_overlap(w, _literal(sorted(posted[0])))
    rows = rows.select("doc_id", F.size(w).cast("long").alias("n_words"), F.when(may, w).alias("w"))
    rows = rows.select("doc_id", "n_words", "w", F.when(w.isNotNull(), F.array_intersect(_literal(ranked), w)).alias("looked"))
    hits = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: word(i).isin(ranked))
    rows = rows.select("*", F.when(w.isNotNull(), hits).alias("hits"))

    def starts(k: int) -> Column:
        """Template and start of every occurrence of the words posted at place k."""
        own = F.filter("hits", lambda i: word(i).isin(sorted(posted[k])))
        return F.flatten(F.transform(own, lambda i: F.transform(F.element_at(_literal(posted[k]), word(i)), lambda entry: entry + i.cast("long"))))

    met = starts(0)
    for k in range(1, RARE):
        met = F.array_intersect(met, starts(k))
    rows = rows.select("*", F.when(w.isNotNull(), met).alias("met"))
    phrases = _literal([[F.struct(F.lit(at + k).alias("at"), F.lit(x).alias("word")) for at, p in t["phrases"] for k, x in enumerate(p)] for t in table])
    words = _literal([t["words"] for t in table])
    template = lambda c: F.shiftright(c, 32).cast("int")
    start = lambda c: (c.bitwiseAND(F.lit((1 << 32) - 1)) - SHIFT).cast("int")
    stands = lambda c: F.forall(F.get(phrases, template(c)), lambda p: F.coalesce(word(start(c) + p["at"]) == p["word"], F.lit(False)))
    rows = rows.select("*", F.coalesce(F.filter("met", stands), F.array().cast("array<long>")).alias("found"))

    labels = lambda c: F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda x: F.get(_literal([t["label"] for t in table]), template(x))))), ",")
    base = F.filter("found", lambda c: template(c) < len(BASE))
    places = F.transform(base, start)

    def coverage(c: Column) -> Column:
        own = F.get(words, template(c))
        return F.size(F.filter(own, lambda x, k: F.coalesce(word(start(c) + k) == x, F.lit(False)))) / F.size(own).cast("double")

    score = F.when(F.size(base) > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.transform("found", coverage)), F.lit(0.0)))
    return rows.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(places).cast("long").alias("first_word"), F.array_max(places).cast("long").alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("found")).alias("labels"), score.alias("score"), F.coalesce(F.array_join(F.slice("looked", 1, NAMED), ","), F.lit("")).alias("rare_words"),
    )


def _sql_words(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def oracle(templates=TEMPLATES) -> str:
    """The same by plain search: every place of every phrase."""
    table = index(templates)
    idf = {word: x for t in table for _, word, x in t["rare"]}
    ranked = sorted(idf, key=lambda word: (-idf[word], word))
    named = f"case when list_has_any(w, {_sql_words(sorted(postings(table)[0]))}) then coalesce(array_to_string(list_filter({_sql_words(ranked)}, lambda x: list_contains(w, x))[1:{NAMED}], ','), '') else '' end"
    table = table[len(BASE) :]
    places = lambda words: f"list_filter(h, lambda i: w[i] = '{words[0]}' and w[i : i + {len(words) - 1}] = {_sql_words(words)})"
    cols, names, cover = [], [], []
    begins = sorted({p.split()[0] for _, p in BASE} | {phrases[0].split()[0] for _, _, phrases in templates})
    for i, (label, p) in enumerate(BASE):
        cols.append(f"{places(p.split())} as b{i}")
    for i, t in enumerate(table):
        (at, phrase), *rest = t["phrases"]
        also = "".join(f" and i - {at} + {q} >= 1 and w[i - {at} + {q} : i - {at} + {q + len(p) - 1}] = {_sql_words(p)}" for q, p in rest)
        cols.append(f"list_transform(list_filter(h, lambda i: w[i] = '{phrase[0]}' and w[i : i + {len(phrase) - 1}] = {_sql_words(phrase)}{also}), lambda i: i - {at}) as t{i}")
        share = " + ".join(f"(case when s + {k} >= 1 and w[s + {k}] = '{x}' then 1 else 0 end)" for k, x in enumerate(t["words"]))
        cover.append(f"coalesce(list_max(list_transform(t{i}, lambda s: ({share}) / {float(len(t['words']))})), 0.0)")
        names.append((t["label"], f"t{i}"))
    bases = [(label, f"b{i}") for i, (label, _) in enumerate(BASE)]
    joined = lambda parts: "coalesce(array_to_string(list_sort(list_distinct(list_filter([" + ", ".join(f"case when len({c}) > 0 then '{label}' end" for label, c in parts) + "], lambda x: x is not null))), ','), '')"
    all_places = " || ".join(c for _, c in bases)
    return f"""
with words as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') as w from documents),
heads as (select doc_id, w, list_filter(range(1, len(w) + 1), lambda i: w[i] in ({', '.join(repr(b) for b in begins)})) as h from words),
found as (select doc_id, w, {', '.join(cols)} from heads),
placed as (select *, {all_places} as places from found)
select doc_id, cast(len(w) as bigint) as n_words, cast(len(places) as bigint) as n_base,
       cast(list_min(places) - 1 as bigint) as first_word, cast(list_max(places) - 1 as bigint) as last_word,
       {joined(bases)} as base_labels, {joined([*bases, *names])} as labels,
       case when len(places) > 0 then 1.0::double else greatest({', '.join(cover)})::double end as score, {named} as rare_words
from placed
"""
