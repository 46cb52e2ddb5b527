"""Licence scan by a positional index of rare words (operator 10). DataFrame functions only.

The entries are the notices, titles, short references and SPDX tags of the usual licences; each has a key phrase that
must stand word by word. The document frequency of each licence word is counted over all documents. The index is a map
from a word to postings: an entry is posted under the rarest word of its key phrase (its lead) with the lead's place,
and with the place of the next rarest word.

A file's licence words of highest IDF are looked up, the rarest first, as far as words go that lead an entry; their
postings alone say which entries are examined, and where. A place of the lead gives a start; it stays if the next
rarest word stands at its place relative to that start (the two postings are intersected), and it counts if the whole
key phrase stands there. The score is the largest share of an entry's words found in place. A key phrase cannot stand
in a file without its lead, so no licence is lost, however many a file holds; what the frequencies change is how many
postings are examined (``examined_col``).

The word table has one row per licence word, a fixed number; nothing that grows with the corpus reaches the driver.
The scan itself is one map; only the per-task counts of licence words are shuffled.

Base labels: places where a base phrase's words stand consecutively.

Defined results: a null or empty text has no words, no places, empty labels and score 0; repeated rows are scanned
each; an empty table gives no rows; all other columns are kept, but for those that have a result's name, which it replaces.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, functions as F

#: Word gaps after lower-casing A-Z, with the capitals themselves as word characters.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Base phrases and their labels.
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"),
        ("mit license", "mit"))

#: Fixed values: (label, template words, key phrase inside the template).
SENTENCES = (
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3",
     "gnu general public license version 3"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("mit-release", "released under the mit license", "released under the mit license"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
     "associated documentation files", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
     "that the following conditions are met", "redistribution and use in source and binary forms"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
     "mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
     "hereby granted", "permission to use copy modify and or distribute this software"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "all rights reserved", "all rights reserved"),
)


def _plain(text: str) -> str:
    return " ".join(re.findall("[0-9a-z]+", text.lower()))


def _gnu() -> list[tuple[str, str, str]]:
    """Notices and titles of the GNU licences; without a version they have the family's label."""
    out = []
    for family, name, versions in (("gpl", "gnu general", "123"), ("lgpl", "gnu lesser general", ("2.1", "3")),
                                   ("lgpl", "gnu library general", "2"), ("agpl", "gnu affero general", "3")):
        full = f"{name} public license"
        if family != "gpl":  # plain GPL without a version is a base phrase
            out.append((family, f"licensed under the {full}", full))
        for v in versions:
            label = f"{family}-{v}" if "." in v else f"{family}-{v}.0"
            v = _plain(v)
            key = f"{full} as published by the free software foundation either version {v} of the license"
            out.append((label, "this program is free software you can redistribute it and or modify it under the terms "
                        f"of the {key} or at your option any later version", key))
            key = f"{full} as published by the free software foundation version {v}"
            out.append((label, f"you can redistribute it and or modify it under the terms of the {key}", key))
            key = f"version {v} of the {full}"
            out.append((label, f"under the terms of {key} as published by the free software foundation", key))
            for said in (f"version {v}", f"v{v}", f"v {v}", v):
                out.append((label, f"licensed under the {full} {said}", f"{full} {said}"))
            out += [(label, f"licensed under the {k}", k) for k in (f"{family} v{v}", f"{family}v{v}")
                    if "library" not in name]
    return out


def _creative_commons() -> list[tuple[str, str, str]]:
    words = {"by": "attribution", "nc": "noncommercial", "sa": "sharealike", "nd": "noderivatives"}
    apart = {"nc": "non commercial", "sa": "share alike", "nd": "no derivatives"}
    older = {"nd": "no derivs"}  # the name up to version 2.5; 3.0 has noderivs
    out = []
    for kind in ("by", "by nc", "by sa", "by nd", "by nc sa", "by nc nd"):
        names = {" ".join(x.get(k, words[k]) for k in kind.split())
                 for x in (words, apart, apart | older, {"nd": "noderivs"})}
        for v in ("1 0", "2 0", "2 5", "3 0", "4 0"):
            label = f"cc {kind} ".replace(" ", "-") + v.replace(" ", ".")
            out += [(label, f"licensed under {k}", k) for k in (f"cc {kind} {v}", f"creativecommons org licenses {kind} {v}")]
            for name in sorted(names):
                out.append((label, f"this work is licensed under a creative commons {name} {v} international license",
                            f"creative commons {name} {v}"))
    out.append(("cc", "this work is licensed under a creative commons license", "creative commons"))
    out += [("cc0-1.0", f"licensed under {k}", k) for k in (
        "cc0", "creative commons zero", "creativecommons org publicdomain zero 1 0")]
    return out


def _named() -> list[tuple[str, str, str]]:
    """Licences known by their names: (label, name, versions)."""
    out = []
    for label, name, versions in (
            ("apache", "apache license", ("2.0", "1.1", "1.0")), ("apache", "apache software license", ("2.0", "1.1", "1.0")),
            ("mpl", "mozilla public license", ("2.0", "1.1", "1.0")), ("epl", "eclipse public license", ("2.0", "1.0")),
            ("artistic", "artistic license", ("2.0", "1.0")), ("bsl", "boost software license", ("1.0",)),
            ("busl", "business source license", ("1.1",)), ("cddl", "common development and distribution license", ("1.0", "1.1")),
            ("cpl", "common public license", ("1.0",)), ("eupl", "european union public licence", ("1.1", "1.2")),
            ("eupl", "european union public license", ("1.1", "1.2")), ("gfdl", "gnu free documentation license", ("1.2", "1.3")),
            ("ofl", "sil open font license", ("1.1",)), ("ms-pl", "microsoft public license", ()),
            ("ms-rl", "microsoft reciprocal license", ()), ("afl", "academic free license", ("3.0",)),
            ("odbl", "open database license", ("1.0",)), ("lppl", "latex project public license", ("1.3c",)),
            ("sspl", "server side public license", ()), ("upl", "universal permissive license", ("1.0",)),
            ("edl", "eclipse distribution license", ("1.0",)), ("psf", "python software foundation license", ()),
            ("ncsa", "ncsa open source license", ()), ("wtfpl", "do what the fuck you want to public license", ()),
            ("bsd-2-clause", "bsd 2 clause", ()), ("bsd-2-clause", "2 clause bsd", ()), ("bsd-2-clause", "simplified bsd", ()),
            ("bsd-3-clause", "bsd 3 clause", ()), ("bsd-3-clause", "3 clause bsd", ()), ("bsd-3-clause", "new bsd license", ()),
            ("bsd-4-clause", "bsd 4 clause", ()), ("bsd", "bsd license", ()), ("isc", "isc license", ()),
            ("zlib", "zlib license", ())):
        if name != "apache license":  # a base phrase
            out.append((label, f"licensed under the {name}", name))
        for v in versions:
            for said in (f"version {v}", f"v {v}", f"v{v}", v):
                key = _plain(f"{name} {said}")
                out.append((f"{label}-{v}", f"licensed under the {key}", key))
    return out


#: Whole notices, as (label, notice, key phrase inside it).
NOTICES = (
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in "
     "compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 "
     "unless required by applicable law or agreed to in writing software distributed under the license is distributed "
     "on an as is basis without warranties or conditions of any kind either express or implied",
     "apache org licenses license 2 0"),
    ("mit-grant", "to deal in the software without restriction including without limitation the rights to use copy "
     "modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the "
     "software is furnished to do so", "to deal in the software without restriction"),
    ("bsd-3-clause", "nor the names of its contributors may be used to endorse or promote products derived from this "
     "software without specific prior written permission",
     "may be used to endorse or promote products derived from this software without"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following "
     "acknowledgement", "advertising materials mentioning features or use of this software must display"),
    ("isc", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby "
     "granted provided that the above copyright notice and this permission notice appear in all copies",
     "permission to use copy modify and distribute this software"),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the "
     "software and accompanying documentation covered by this license",
     "permission is hereby granted free of charge to any person or organization obtaining a copy"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be "
     "held liable for any damages arising from the use of this software",
     "in no event will the authors be held liable for any damages arising from the use of this software"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software either in source "
     "code form or as a compiled binary", "anyone is free to copy modify publish use compile sell or distribute"),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public "
     "license 2 0 which is available at https www eclipse org legal epl 2 0", "eclipse org legal epl 2 0"),
    ("epl-1.0", "all rights reserved this program and the accompanying materials are made available under the terms of "
     "the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org "
     "legal epl v10 html", "eclipse org legal epl v10"),
    ("artistic-1.0", "you may redistribute it and or modify it under the same terms as perl itself",
     "under the same terms as perl"),
)

#: SPDX tags.
SPDX = (
    "Apache-2.0 Apache-1.1 GPL-1.0 GPL-2.0 GPL-3.0 LGPL-2.0 LGPL-2.1 LGPL-3.0 AGPL-3.0 MIT ISC BSD-2-Clause BSD-3-Clause "
    "BSD-4-Clause MPL-1.1 MPL-2.0 EPL-1.0 EPL-2.0 Artistic-1.0 Artistic-2.0 BSL-1.0 BUSL-1.1 CDDL-1.0 CDDL-1.1 CC0-1.0 "
    "CC-BY-3.0 CC-BY-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC-BY-NC-4.0 CC-BY-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-NC-ND-4.0 Unlicense "
    "Zlib WTFPL EUPL-1.2 OFL-1.1 MS-PL 0BSD PostgreSQL NCSA UPL-1.0").split()

#: The index: (label, words, key phrase inside them).
TEMPLATES = tuple(dict.fromkeys([
    *SENTENCES, *NOTICES, *_gnu(), *_creative_commons(), *_named(),
    *[(x.lower(), f"spdx license identifier {_plain(x)}", f"spdx license identifier {_plain(x)}") for x in SPDX]]))


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), GAP), "")


def _places(words: Column, wanted: list[str]) -> Column:
    """Places (from 0) of the wanted words."""
    last = F.size(words) - 1
    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), last), lambda i: F.get(words, i).isin(*wanted)))


def _stands(words: Column, at: Column, phrase: list[str]) -> Column:
    out = F.lit(True)
    for k, word in enumerate(phrase):
        out = out & F.coalesce(F.get(words, at + k) == word, F.lit(False))
    return out


def _starts_here(words: Column, phrase: list[str], shift: int = 0):
    return lambda at: _stands(words, at + shift, phrase)


def _bind(value: Column, then) -> Column:
    """``then`` of a value that is worked out once, though a lambda uses it for each element."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def vocabulary() -> list[str]:
    return sorted({w for _, t, _ in TEMPLATES for w in t.split()} | {w for b, _ in BASE for w in b.split()})


def _texts(words: list[str]) -> Column:
    return F.split(F.lit(" ".join(words)), " ")


def word_idf(docs: DataFrame, text_col: str = "text") -> dict[str, float]:
    """IDF of every licence word over all documents: one row per licence word comes back."""
    vocab = vocabulary()
    # The empty word counts the documents. Partial aggregation: one row per task and word is shuffled.
    held = F.concat(F.array(F.lit("")), F.array_intersect(_texts(vocab), _words(F.col(text_col))))
    found = {r["w"]: r["n"] for r in docs.select(F.explode(held).alias("w")).groupBy("w").agg(
        F.count("*").alias("n")).collect()}
    return {w: math.log((found.get("", 0) + 1) / (found.get(w, 0) + 1)) for w in vocab}


def index(idf: dict[str, float]) -> tuple[list[str], Column]:
    """The leads, the rarest first, and the map lead -> postings."""
    posted: dict[str, list[str]] = {}
    for label, template, key in TEMPLATES:
        words = key.split()
        rare = sorted(set(words), key=lambda w: (-idf[w], w))
        lead, after = rare[0], rare[min(1, len(rare) - 1)]
        first = template[:template.index(key)].count(" ")
        posted.setdefault(lead, []).append(
            f"named_struct('label', '{label}', 'words', split('{template}', ' '), 'key', split('{key}', ' '), "
            f"'key_at', {first}, 'at', {first + words.index(lead)}, "
            f"'next', '{after}', 'next_at', {first + words.index(after)})")
    # One expression of literals, folded when the query is planned.
    table = F.expr("map(" + ", ".join(f"'{w}', array({', '.join(ts)})" for w, ts in posted.items()) + ")")
    return sorted(posted, key=lambda w: (-idf[w], w)), table


def _best_share(words: Column, places: Column, t: Column) -> Column:
    """Largest share of the entry's words in place, over the verified starts; null without one.

    ``places`` are those of the entry's lead."""
    listed, key = t["words"], t["key"]
    starts = F.filter(F.transform(places, lambda i: i - t["at"]),
                      lambda s: F.get(words, s + t["next_at"]) == t["next"])

    def stands(s: Column) -> Column:
        return F.size(F.filter(key, lambda x, q: F.get(words, s + t["key_at"] + q) == x)) == F.size(key)

    def share(s: Column) -> Column:
        hits = F.filter(listed, lambda x, q: F.get(words, s + q) == x)
        return F.size(hits) / F.size(listed).cast("double")

    return F.array_max(F.transform(F.filter(starts, stands), share))


def scan(docs: DataFrame, text_col: str = "text", examined_col: str | None = None,
         idf: dict[str, float] | None = None) -> DataFrame:
    """Adds n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``examined_col`` adds the number of postings examined. ``idf`` may give the words' weights (default: counted here)."""
    leads, table = index(idf or word_idf(docs, text_col))
    p = "_l_"
    df = docs.withColumn(p + "w", _words(F.col(text_col)))
    w = F.col(p + "w")
    first = sorted({b.split()[0] for b, _ in BASE})
    # The file's words that lead an entry, the rarest first; and those that begin a base phrase.
    df = df.withColumn(p + "h", F.array_intersect(_texts(leads), w)).withColumn(p + "f", F.arrays_overlap(_texts(first), w))
    held = F.col(p + "h")

    df = df.withColumn(p + "o", F.when(F.col(p + "f"), _places(w, first)))
    for k, (phrase, _) in enumerate(BASE):
        df = df.withColumn(f"{p}b{k}", F.filter(F.col(p + "o"), _starts_here(w, phrase.split())))
    base = [F.col(f"{p}b{k}") for k in range(len(BASE))]

    def looked_up(word: Column, places: Column) -> Column:
        postings = table[word]
        return F.struct(
            (F.size(postings) * F.size(places)).cast("long").alias("examined"),
            F.filter(F.transform(postings, lambda t: F.struct(
                t["label"].alias("label"), _best_share(w, places, t).alias("share"))),
                lambda x: x["share"].isNotNull()).alias("found"))

    def by_lead(places: Column) -> Column:
        return F.transform(held, lambda word: _bind(
            F.filter(places, lambda i: F.get(w, i) == word), lambda at: looked_up(word, at)))

    spots = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.array_contains(held, F.get(w, i)))
    df = df.withColumn(p + "r", F.when(F.size(held) > 0, _bind(spots, by_lead)))
    df = df.withColumn(p + "t", F.flatten(F.transform(F.col(p + "r"), lambda x: x["found"])))
    if examined_col:
        df = df.withColumn(examined_col, F.coalesce(F.aggregate(
            p + "r", F.lit(0).cast("long"), lambda n, x: n + x["examined"]), F.lit(0).cast("long")))
    shares = F.coalesce(F.transform(F.col(p + "t"), lambda x: x["share"]), F.array().cast("array<double>"))
    more = F.coalesce(F.transform(F.col(p + "t"), lambda x: x["label"]), F.array().cast("array<string>"))

    def listed(names: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(names)), ",")

    named = F.array_compact(F.array(*[F.when(F.size(c) > 0, F.lit(name))
                                      for c, (_, name) in zip(base, BASE, strict=True)]))
    places = F.flatten(F.array(*[F.coalesce(c, F.array().cast("array<int>")) for c in base]))
    df = (df.withColumn("n_words", F.size(w).cast("long"))
          .withColumn("n_base", F.size(places).cast("long"))
          .withColumn("first_word", F.array_min(places).cast("long"))
          .withColumn("last_word", F.array_max(places).cast("long"))
          .withColumn("base_labels", listed(named))
          .withColumn("labels", listed(F.concat(named, more))))
    best = F.coalesce(F.array_max(shares), F.lit(0.0))
    df = df.withColumn("score", F.greatest(best, F.when(F.col("n_base") > 0, 0.5).otherwise(0.0)))
    return df.drop(p + "w", p + "h", p + "f", p + "o", p + "r", p + "t", *[f"{p}b{k}" for k in range(len(BASE))])


COLUMNS = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
