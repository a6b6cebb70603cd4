"""Licence mentions found by a positional index of rare words.

Every template is a list of words with a mandatory key phrase in it.  The index holds,
for the key phrase's word that is rarest in the whole corpus (of the highest IDF), the
templates and places it stands in.  A text is searched for those words only; each hit
gives a template and, by relative position, the place where the template would begin.
There the key phrase must stand word for word, and the share of the template's words
that stand where they should is the match's score; from ``COVER`` on it counts.

All of it is expressions on the rows of one scan: nothing is shuffled but the counts
of the licence words.  Words are runs of a-z (A-Z as their lower case), digits and
characters outside ASCII.

Defined cases: a NULL text has no words; overlapping and repeated places all count;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = r"[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
COVER = 0.6


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_words(self) -> list[str]:
        return self.key.split()

    @property
    def key_at(self) -> int:
        n = len(self.key_words)
        return next(i for i in range(len(self.words)) if self.words[i : i + n] == self.key_words)


# Phrases that the base must find, then the templates of the method.
TEMPLATES = (
    Template("mit", "under the mit license", "under the mit license", True),
    Template("apache-2", "apache license version 2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", "cc by nc", True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    Template("mit", "released under the mit licence", "mit licence"),
    Template("mit", "spdx license identifier mit", "license identifier mit"),
    Template("apache-2", "you may not use this file except in compliance with the license", "except in compliance with the license"),
    Template("apache-2", "spdx license identifier apache 2 0", "license identifier apache 2 0"),
    Template("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    Template("lgpl-3", "under the gnu lesser general public license version 3", "gnu lesser general public license version 3"),
    Template("agpl-3", "under the gnu affero general public license version 3", "gnu affero general public license version 3"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify and or distribute"),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("cc0", "cc0 1 0 universal", "cc0 1 0"),
    Template("cc-by", "creative commons attribution 4 0 international license", "creative commons attribution 4 0"),
    Template("cc-by-sa", "creative commons attribution sharealike 4 0 international license", "creative commons attribution sharealike"),
    Template("cc-by-nc", "creative commons attribution noncommercial 4 0 international license", "creative commons attribution noncommercial"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
)


def _quoted(words: list[str]) -> str:
    return "array(" + ", ".join(f"'{w}'" for w in words) + ")"


def word_frequencies(docs: DataFrame, text: str, vocabulary: list[str]) -> dict[str, int]:
    """In how many texts of the whole table each of the given words stands.

    At most one row for each word of the vocabulary reaches the driver.
    """
    listed = ", ".join(f"'{w}'" for w in vocabulary)
    found = F.expr(f"array_distinct(filter(transform(regexp_extract_all(body, '{WORD}', 0), w -> lower(w)), w -> w IN ({listed})))")
    counts = docs.select(docs[f"`{text}`"].alias("body")).select(F.explode(found).alias("word")).groupBy("word").count()
    return {word: n for word, n in counts.collect()}


def anchors(templates: tuple[Template, ...], frequencies: dict[str, int]) -> list[tuple[str, int]]:
    """Each template's rarest key word and its place in the template."""
    chosen = []
    for t in templates:
        at = min(range(len(t.key_words)), key=lambda i: (frequencies.get(t.key_words[i], 0), i))
        chosen.append((t.key_words[at], t.key_at + at))
    return chosen


def licence_scan(
    docs: DataFrame, id: str = "doc_id", text: str = "text", templates: tuple[Template, ...] = TEMPLATES, cover: float = COVER
) -> DataFrame:
    """One row for each row of ``docs``.

    Columns: doc_id, n_words, n_base (places of base phrases), first_word and last_word
    (their least and greatest start), base_labels, labels, score (the best match's
    share), places (template's place in the list, start, score of every match).
    """
    vocabulary = sorted({w for t in templates for w in t.key_words})
    chosen = anchors(templates, word_frequencies(docs, text, vocabulary))
    postings: dict[str, list[tuple[int, int]]] = {}
    for i, (word, at) in enumerate(chosen):
        postings.setdefault(word, []).append((i, at))
    index = "map(" + ", ".join(
        f"'{w}', array(" + ", ".join(f"named_struct('t', {t}, 'at', {at})" for t, at in posts) + ")" for w, posts in postings.items()
    ) + ")"
    known = ", ".join(f"'{w}'" for w in postings)
    rare = "(?i)(?<![^\\\\x00-\\\\x2F\\\\x3A-\\\\x40\\\\x5B-\\\\x60\\\\x7B-\\\\x7F])(" + "|".join(postings) + ")(?![^\\\\x00-\\\\x2F\\\\x3A-\\\\x40\\\\x5B-\\\\x60\\\\x7B-\\\\x7F])"
    table = "array(" + ", ".join(
        f"named_struct('label', '{t.label}', 'base', {str(t.base).lower()}, 'words', {_quoted(t.words)}, 'key', {_quoted(t.key_words)}, 'key_at', {t.key_at})"
        for t in templates
    ) + ")"

    rows = docs.select(docs[f"`{id}`"].alias("doc_id"), docs[f"`{text}`"].alias("body"))
    # Only texts with a word of the index are cut into words.
    cut = rows.select(
        "doc_id",
        F.expr(f"coalesce(regexp_count(body, '{WORD}'), 0)").cast("long").alias("n_words"),
        F.expr(f"CASE WHEN body RLIKE '{rare}' THEN transform(regexp_extract_all(body, '{WORD}', 0), w -> CASE WHEN octet_length(w) = length(w) THEN lower(w) ELSE w END) ELSE array() END").alias("words"),
    )
    hits = cut.withColumn(
        "hits", F.expr(f"filter(transform(words, (w, i) -> CASE WHEN w IN ({known}) THEN i END), i -> i IS NOT NULL)")
    )
    looked = hits.withColumn(
        "starts",
        F.expr(f"flatten(transform(hits, i -> transform(element_at({index}, element_at(words, i + 1)), p -> named_struct('t', p.t, 'start', i - p.at))))"),
    )
    proven = looked.withColumn("templates", F.expr(table)).withColumn(
        "kept",
        F.expr(
            "filter(starts, s -> s.start + templates[s.t].key_at >= 0 AND "
            "slice(words, s.start + templates[s.t].key_at + 1, size(templates[s.t].key)) = templates[s.t].key)"
        ),
    )
    share = "size(filter(transform(templates[s.t].words, (w, j) -> s.start + j >= 0 AND coalesce(get(words, s.start + j) = w, false)), m -> m)) / size(templates[s.t].words)"
    scored = proven.withColumn("places", F.expr(f"transform(kept, s -> named_struct('t', s.t, 'start', s.start, 'share', cast({share} as double)))"))
    counted = scored.withColumn("places", F.expr(f"filter(places, p -> p.share >= {float(cover)}D OR templates[p.t].base)")).withColumn(
        "base", F.expr("filter(places, p -> templates[p.t].base)")
    )
    label = "array_join(array_sort(array_distinct(transform({0}, p -> templates[p.t].label))), ',')"
    return counted.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.expr("array_min(transform(base, p -> cast(p.start as long)))").alias("first_word"),
        F.expr("array_max(transform(base, p -> cast(p.start as long)))").alias("last_word"),
        F.expr(label.format("base")).alias("base_labels"),
        F.expr(label.format("places")).alias("labels"),
        F.expr("coalesce(array_max(transform(places, p -> p.share)), 0D)").alias("score"),
        "places",
    )
