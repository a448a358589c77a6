"""License scans: ordered signature rules over normalised words, behind a keyword prefilter.

A rule is a passage of a license's own text, or its name in one of several phrasings. Passages come first; names
have three priorities behind them: identifiers and grants with a version, then names with the word license, then bare
names. All rules of a priority are tried in one pass from left to right, the more specific ones first; what they match
is taken out before the next priority is tried. So a detection that lies inside one of higher priority, or inside a
longer one that begins before it, is suppressed. A label states a version only where the text does.
Everything is a column expression over one row: nothing is shuffled and no Python runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases of the base scan and their labels.
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)


def _versions(names: str, number: str) -> str:
    """A license's names with a version behind them: "name 3", "name v3", "name license, version 3.0"."""
    return rf"(?:{names})(?: licen[cs]e)?(?: as published by the free software foundation)?(?: either)?(?: version | v ?|v| )?{number}(?: 0)?"


_AGPL = r"(?:gnu )?affero general public licen[cs]e|(?:gnu )?agpl"
_LGPL = r"(?:gnu )?(?:lesser|library) general public licen[cs]e|(?:gnu )?lgpl"
_GPL = r"(?:gnu )?general public licen[cs]e|(?:gnu )?gpl"
_APACHE = r"apache (?:software )?licen[cs]e"
_MPL = r"mozilla public licen[cs]e|mpl"

# Label, and the names it goes by in lower-case words, more specific licenses first. A label with a version stands
# for names that state it; a name without one has a label without one.
FAMILIES: tuple[tuple[str, str], ...] = (
    ("agpl-3", _versions(_AGPL, "3")),
    ("agpl", _AGPL),
    ("lgpl-2.1", _versions(_LGPL, "2 1")),
    ("lgpl-2", _versions(_LGPL, "2")),
    ("lgpl-3", _versions(_LGPL, "3")),
    ("lgpl", _LGPL),
    ("gpl-1", _versions(_GPL, "1")),
    ("gpl-2", _versions(_GPL, "2")),
    ("gpl-3", _versions(_GPL, "3")),
    ("gpl", _GPL),
    ("gfdl", r"(?:gnu )?free documentation licen[cs]e|gfdl"),
    ("apache-1.1", _versions(_APACHE, "1 1") + "|apache 1 1"),
    ("apache-1", _versions(_APACHE, "1")),
    ("apache-2", _versions(_APACHE, "2") + r"|apache (?:v ?|version )?2 0(?! \d)|asl 2(?: 0)?"),
    ("apache", _APACHE + "|apache"),
    ("cc-by-nc-nd", r"(?:cc|creative commons) (?:by|attribution) (?:nc|non ?commercial) (?:nd|no ?deriv(?:ative)?s?)"),
    ("cc-by-nc-sa", r"(?:cc|creative commons) (?:by|attribution) (?:nc|non ?commercial) (?:sa|share ?alike)"),
    ("cc-by-nc", r"(?:cc|creative commons) (?:by|attribution) (?:nc|non ?commercial)"),
    ("cc-by-nd", r"(?:cc|creative commons) (?:by|attribution) (?:nd|no ?deriv(?:ative)?s?)"),
    ("cc-by-sa", r"(?:cc|creative commons) (?:by|attribution) (?:sa|share ?alike)"),
    ("cc-by", r"(?:cc|creative commons) (?:by|attribution)"),
    ("cc0", r"cc0|cc zero|creative commons zero|public domain dedication"),
    ("bsd-4-clause", r"(?:4|four) clause bsd|original bsd|bsd 4 clause"),
    ("bsd-3-clause", r"(?:3|three) clause bsd|(?:new|modified|revised) bsd|bsd 3 clause"),
    ("bsd-2-clause", r"(?:2|two) clause bsd|(?:simplified|freebsd) bsd|bsd 2 clause"),
    ("0bsd", r"zero clause bsd|0bsd|bsd zero clause"),
    ("bsd", r"berkeley software distribution|bsd"),
    ("mit-0", r"mit no attribution|mit 0"),
    ("mit", r"mit|expat|x11"),
    ("mpl-1.1", _versions(_MPL, "1 1")),
    ("mpl-1", _versions(_MPL, "1")),
    ("mpl-2", _versions(_MPL, "2")),
    ("mpl", _MPL),
    ("epl-1", _versions(r"eclipse public licen[cs]e|epl", "1")),
    ("epl-2", _versions(r"eclipse public licen[cs]e|epl", "2")),
    ("epl", r"eclipse public licen[cs]e|epl"),
    ("eupl", r"european union public licen[cs]e|eupl"),
    ("cddl", r"common development and distribution licen[cs]e|cddl"),
    ("bsl", r"boost software licen[cs]e|bsl"),
    ("artistic-1", r"artistic (?:licen[cs]e )?(?:version |v ?)1(?: 0)?|artistic licen[cs]e 1(?: 0)?|artistic 1 0"),
    ("artistic-2", r"artistic (?:licen[cs]e )?(?:version |v ?)2(?: 0)?|artistic licen[cs]e 2(?: 0)?|artistic 2 0"),
    ("artistic", r"artistic licen[cs]e|artistic"),
    ("isc", r"internet systems consortium licen[cs]e|isc"),
    ("zlib", r"zlib(?: libpng)?"),
    ("unlicense", r"unlicense"),
    ("wtfpl", r"do what the f\w+ you want to public licen[cs]e|wtfpl"),
    ("odbl", r"open database licen[cs]e|odbl"),
    ("ofl", r"(?:sil )?open font licen[cs]e|ofl"),
)

# Names that are also names of software or institutions: a version behind them is not a license's.
SOFTWARE = frozenset({"mit", "mit-0", "isc", "zlib", "unlicense", "apache", "bsd"})
# Names that are also plain words: nor is a bare number.
AMBIGUOUS = SOFTWARE | {"artistic", "bsl"}
# Labels that state a version: such a name needs no other words.
VERSIONED = frozenset(label for label, _ in FAMILIES if label[-1].isdigit() and label not in ("mit-0", "cc0"))
ALL = frozenset(label for label, _ in FAMILIES)

# Priority, weight and phrasings with the labels that they hold for; {0} is a license's names.
_GIVEN = r"(?:licensed|released|distributed|available|published|provided) under (?:the |an? )?"
PHRASINGS: tuple[tuple[float, tuple[tuple[str, frozenset[str]], ...]], ...] = (
    (
        1.0,
        (
            (r"spdx license identifier (?:{0})(?: \d+)*", ALL),
            (_GIVEN + r"(?:terms of )?(?:the )?(?:{0})(?: public)?(?: licen[cs]e)?(?: version| v)?(?: \d+)+", ALL),
            (r"under the terms of (?:the )?(?:{0})(?: licen[cs]e)?(?: version| v)?(?: \d+)*", ALL),
        ),
    ),
    (
        0.9,
        (
            (_GIVEN + r"(?:{0})(?: licen[cs]e)?", ALL),
            (r"under (?:the |an? )?(?:{0})(?: style)? licen[cs]e", ALL),
            (r"licen[cs]e (?:is |: )?(?:the )?(?:{0})", ALL),
            (r"(?:{0}) (?:international )?(?:public )?licen[cs]e(?: version| v)?(?: \d+)*", ALL),
        ),
    ),
    (
        0.5,
        (
            (r"(?:{0}) licensed", ALL),
            (r"(?:{0}) (?:version|v) ?\d+", ALL - SOFTWARE),
            (r"(?:{0})(?: \d+)+", ALL - AMBIGUOUS),
            (r"(?:{0})", VERSIONED),
        ),
    ),
)
BASE_WEIGHT = 0.9

_BSD = "redistribution and use in source and binary forms with or without modification (?:are|is) permitted"
_NEITHER = r"neither the names? (?:of )?.{1,200}? may be used to endorse or promote products|may not be used to endorse or promote products|without specific prior written permission"
_ADVERTISING = "all advertising materials mentioning features"
_BINARY = "redistributions in binary form must reproduce the above copyright notice"
_MIT = "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"
_MIT_NOTICE = "the above copyright notice and this permission notice(?: including the next paragraph)? shall be included"
_ISC = "permission to use copy modify and (?:and )?(?:or )?distribute this software for any purpose with or without fee is hereby granted"
# Label, name and version of notices that name a license in the words of its own text.
_NOTICES = (
    ("gpl-2", "general public license", "2"),
    ("gpl-3", "general public license", "3"),
    ("lgpl-2", "(?:library|lesser) general public license", "2"),
    ("lgpl-2.1", "lesser general public license", "2 1"),
    ("lgpl-3", "lesser general public license", "3"),
    ("agpl-3", "affero general public license", "3"),
)
# Passages of license texts: label, a phrase that stands in every text that has one, pattern. How far a license's text
# reaches behind its first words is bounded, so that one license is not told apart by words of the next.
BODIES: tuple[tuple[str, str, str], ...] = (
    ("mit", "permission is hereby granted free of charge", rf"{_MIT}(?=.{{0,800}} {_MIT_NOTICE})"),
    ("mit-0", "permission is hereby granted free of charge", rf"{_MIT}(?!.{{0,800}} {_MIT_NOTICE})(?=.{{0,800}} the software is provided as is)"),
    ("bsd-4-clause", "redistribution and use in source and binary forms", rf"{_BSD}(?=.{{0,1200}} {_ADVERTISING})"),
    ("bsd-3-clause", "redistribution and use in source and binary forms", rf"{_BSD}(?!.{{0,1200}} {_ADVERTISING})(?=.{{0,1200}} (?:{_NEITHER}))"),
    ("bsd-2-clause", "redistribution and use in source and binary forms", rf"{_BSD}(?!.{{0,1200}} (?:{_ADVERTISING}|{_NEITHER}))(?=.{{0,800}} {_BINARY})"),
    ("bsd", "redistribution and use in source and binary forms", rf"{_BSD}(?!.{{0,1200}} (?:{_ADVERTISING}|{_NEITHER}|{_BINARY}))"),
    ("isc", "with or without fee is hereby granted", rf"{_ISC} provided that the above copyright notice"),
    ("0bsd", "with or without fee is hereby granted", rf"{_ISC}(?! provided)"),
    ("zlib", "this notice may not be removed or altered from any source distribution", "this notice may not be removed or altered from any source distribution"),
    ("unlicense", "this is free and unencumbered software", "this is free and unencumbered software released into the public domain"),
    ("bsl", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("ofl", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of the font software"),
    *((label, f"either version {number} of the license", rf"it under the terms of the gnu {name} as published by the free software foundation either version {number} of the license") for label, name, number in _NOTICES),
    ("gpl-1", "either version 1 or at your option any later version", "it under the terms of the gnu general public license as published by the free software foundation either version 1"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-1.1", "the contents of this file are subject to the mozilla public license", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("epl-1", "materials are made available under the terms of the eclipse public license", "materials are made available under the terms of the eclipse public license v1 0"),
    ("epl-2", "materials are made available under the terms of the eclipse public license", "materials are made available under the terms of the eclipse public license (?:v ?)?2 0"),
    ("cddl", "subject to the terms of the common development and distribution license", "subject to the terms of the common development and distribution license"),
    ("apache-2", "you may not use this file except in compliance with the license", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("ncsa", "permission is hereby granted free of charge", "to deal with the software without restriction including without limitation the rights to use"),
    ("json", "the software shall be used for good not evil", "the software shall be used for good not evil"),
    ("beerware", "you can do whatever you want with this stuff", "as long as you retain this notice you can do whatever you want with this stuff"),
    ("postgresql", "without a written agreement is hereby granted", "for any purpose without fee and without a written agreement is hereby granted"),
    ("hpnd", "appear in supporting documentation", "permission to use copy modify and distribute this software and its documentation for any purpose (?:and )?without fee is hereby granted provided that the above copyright notice appears? in all copies and that both that copyright notice and this permission notice appear in supporting documentation"),
    ("apache-2", "perpetual worldwide non exclusive no charge royalty free", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to reproduce"),
    ("wtfpl", "you just do what the", r"you just do what the f\w+ you want to"),
    ("cc0", "overtly fully permanently irrevocably", "affirmer hereby overtly fully permanently irrevocably and unconditionally waives"),
    ("artistic-2", "the copyright holder maintains some artistic control", "the copyright holder maintains some artistic control over the development of that package"),
)
BODY_WEIGHT = 1.0
# One of these stands in every text that a rule can match.
KEYWORDS = (
    " licen", "spdx ", "under the terms of ", "ed under ", "available under ",
    " cc ", " cc0 ", " creative commons ", "domain dedication ", "gpl", " gfdl ", " apache ", " asl ", " bsd ", " 0bsd ",
    " mpl", " epl ", " eupl ", " cddl ", " wtfpl ", " odbl ", " ofl ", "software distribution ",
    " bsl v", " artistic v", " artistic 1 0 ", " artistic 2 0 ",
    *dict.fromkeys(f" {phrase} " for _, phrase, _ in BODIES),
)

_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def rules() -> list[tuple[int, str, str]]:
    """Every rule: priority (0 first), label, pattern. Passages of license texts come before names."""
    return [(0, label, pattern) for label, _, pattern in BODIES] + [
        (priority, label, phrasing.format(names))
        for priority, (_, phrasings) in enumerate(PHRASINGS, 1)
        for label, names in FAMILIES
        for phrasing, holds in phrasings
        if label in holds
    ]


def tried(phrasings: Sequence[tuple[str, frozenset[str]]]) -> str:
    """All rules of a priority as one pattern: what phrasings share is tried once for all licenses, in their order."""
    return _any([phrasing.format("|".join(names for label, names in FAMILIES if label in holds)) for phrasing, holds in phrasings])


def _any(patterns: Sequence[str]) -> str:
    return r"(?<= )(?:" + "|".join(f"(?:{p})" for p in patterns) + r")(?= )"


def spaced(text: Column) -> Column:
    """The words of a text in lower case, with one space before, between and after them; no words: one space."""
    # Beyond A-Z this also lowers other letters. It turns none of them into a word of the base phrases (the one
    # letter that becomes a bare ASCII one is the kelvin sign, a k) and does not change where words begin and end.
    small = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    return F.regexp_replace(F.concat(F.lit(" "), small, F.lit(" ")), _BETWEEN, " ")


def _blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    The base scan counts the places where a phrase's words stand in a row (the first word of the text is 0); rules
    add labels, none goes. score is the weight of the best detection, 0 without any. A null, empty or blank text has
    no words, no labels (an empty string) and no places (null). Rows stay as often as they come; other columns are
    not looked at.
    """
    words = docs.select(F.col("doc_id").cast("long").alias("doc_id"), spaced(F.col("text")).alias("words"))
    has = lambda text: F.contains(F.col("words"), F.lit(text))
    gate = F.lit(False)
    for keyword in KEYWORDS:
        gate = gate | has(keyword)
    gated = words.select("doc_id", (_blanks(F.col("words")) - 1).alias("n_words"), F.when(gate, F.col("words")).alias("words"))

    places, firsts, lasts, base = [], [], [], []
    for phrase, label in BASE:
        mark, size = f" {phrase} ", len(phrase.split())
        there = has(mark)
        places.append(F.when(there, F.regexp_count("words", F.lit(f"(?<= ){phrase}(?= )"))).otherwise(0))
        head = F.substring_index("words", mark, 1)
        firsts.append(F.when(there, _blanks(head)))
        tail = F.substring_index("words", mark, -1)
        lasts.append(F.when(there, F.col("n_words") - _blanks(tail) - size))
        base.append(F.when(there, F.lit(label)))

    found, weights = [], []
    held = [has(f" {phrase} ") & F.regexp_like("words", F.lit(_any([pattern]))) for _, phrase, pattern in BODIES]
    passages = F.array_compact(F.array(*[F.when(there, F.lit(label)) for there, (label, _, _) in zip(held, BODIES)]))
    unnamed = F.regexp_replace("words", _any([pattern for _, _, pattern in BODIES]), "#")
    step = gated.select(
        "doc_id",
        "n_words",
        "words",
        sum(places[1:], places[0]).cast("long").alias("n_base"),
        F.least(*firsts).cast("long").alias("first_word"),
        F.greatest(*lasts).cast("long").alias("last_word"),
        F.array_compact(F.array(*base)).alias("base"),
        passages.alias("passages"),
    ).withColumn("rest", F.when(F.size("passages") > 0, unnamed).otherwise(F.col("words")))
    family = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(_any([names])).alias("names")) for label, names in FAMILIES])
    for priority, (weight, phrasings) in enumerate(PHRASINGS):
        pattern = tried(phrasings)
        rest = F.col("rest") if priority == 0 else F.col(f"rest{priority - 1}")
        hits = F.when(rest.isNotNull(), F.array_distinct(F.regexp_extract_all(rest, F.lit(pattern), F.lit(0))))
        step = step.withColumns({f"hits{priority}": hits, f"rest{priority}": F.regexp_replace(rest, pattern, "#")})
        named = F.transform(
            F.col(f"hits{priority}"),
            lambda hit: F.filter(family, lambda f: F.regexp_like(F.concat(F.lit(" "), hit, F.lit(" ")), f["names"]))[0]["label"],
        )
        found.append(F.coalesce(F.array_compact(named), F.array().cast("array<string>")))
        weights.append(F.when(F.size(f"hits{priority}") > 0, F.lit(weight)))
    found.append(F.col("passages"))
    weights.append(F.when(F.size("passages") > 0, F.lit(BODY_WEIGHT)))
    base_labels = F.array_join(F.array_sort(F.array_distinct("base")), ",")
    labels = F.array_join(F.array_sort(F.array_distinct(F.concat(F.col("base"), *found))), ",")
    best = F.greatest(F.lit(0.0), *weights, F.when(F.col("n_base") > 0, F.lit(BASE_WEIGHT)))
    return step.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        base_labels.alias("base_labels"),
        labels.alias("labels"),
        best.alias("score"),
    )
