"""License scan: ordered signature rules, on DataFrame functions only.

A text's words are put side by side, with one space between. One regular expression of the rules'
keywords (their first words) tells which texts are looked at further; in these, a word that
begins a keyword is a place, and the rules of its keyword, no others, are matched against the
next `REACH` words. A match is an interval of words with a priority: headers of files before
full notices, sentences of a license's text, names with a version, and bare names. An interval that lies inside
another one of the same text is suppressed if the other has a better priority, or the same
and is longer or (for equal intervals) stands earlier in the list of rules. Phrases of the base
(`BASE`) are counted beside it and never suppressed.

All of it is one projection of the scan: nothing is shuffled, and a text's places are held in
arrays of that text's own size. An interval has REACH words at most, so whatever can hold it
begins at most REACH places before it: the search is linear in the number of places.

Cases: a null or empty text has no words, null first and last words, empty labels and score 0.
Only A-Z are lower-cased; characters beyond ASCII are parts of words. Repeated rows and ids each
get their row. Columns of other names play no part.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import spare

#: What parts words: all of ASCII but digits and letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Words that a rule can span at most.
REACH = 24
#: Phrases whose places are always counted.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# --- signatures, by hand. In patterns a space is the space between two words; of what a license
# is called, the long form may stand alone, the short form only in a notice, before "license" or
# with a version.
#: label: long forms, short forms, versions ("" for those without)
LICENSES: dict[str, tuple[str, str, str]] = {
    "agpl": ("(?:gnu )?affero general public licen[cs]e", "agpl", "1.0 3.0"),
    "lgpl": ("(?:gnu )?(?:lesser|library) general public licen[cs]e", "lgpl", "2.0 2.1 3.0"),
    "gpl": ("(?:gnu )?general public licen[cs]e", "(?:gnu )?gpl", "1.0 2.0 3.0"),
    "gfdl": ("(?:gnu )?free documentation licen[cs]e", "gfdl|fdl", "1.1 1.2 1.3"),
    "apache": ("apache (?:software )?licen[cs]e", "apache|asl", "1.0 1.1 2.0"),
    "mpl": ("mozilla public licen[cs]e", "mpl", "1.0 1.1 2.0"),
    "epl": ("eclipse public licen[cs]e", "epl", "1.0 2.0"),
    "cpl": ("common public licen[cs]e", "cpl", "1.0"),
    "ipl": ("ibm public licen[cs]e", "ipl", "1.0"),
    "cddl": ("common development and distribution licen[cs]e", "cddl", "1.0 1.1"),
    "eupl": ("european union public licen[cs]e", "eupl", "1.0 1.1 1.2"),
    "afl": ("academic free licen[cs]e", "afl", "1.1 2.0 2.1 3.0"),
    "osl": ("open software licen[cs]e", "osl", "1.0 2.0 2.1 3.0"),
    "artistic": ("(?:perl )?artistic licen[cs]e", "artistic", "1.0 2.0"),
    "bsl": ("boost software licen[cs]e", "bsl|boost", "1.0"),
    "bsd-2-clause": ("(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd) licen[cs]e", "bsd 2 clause|2 clause bsd|simplified bsd", ""),
    "bsd-3-clause": ("(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd) licen[cs]e", "bsd 3 clause|3 clause bsd|new bsd|modified bsd", ""),
    "bsd-4-clause": ("(?:bsd 4 clause|4 clause bsd|original bsd) licen[cs]e", "bsd 4 clause|4 clause bsd|original bsd", ""),
    "0bsd": ("(?:zero clause bsd|bsd zero clause|free public) licen[cs]e", "0bsd", ""),
    "bsd": ("bsd (?:style )?licen[cs]e", "bsd", ""),
    "mit-0": ("mit no attribution", "mit 0", ""),
    "mit": ("mit licen[cs]e|expat licen[cs]e", "mit|expat", ""),
    "x11": ("x11 licen[cs]e|x consortium licen[cs]e", "x11", ""),
    "isc": ("isc licen[cs]e", "isc", ""),
    "zlib": ("zlib licen[cs]e|zlib libpng licen[cs]e", "zlib|zlib libpng", ""),
    "libpng": ("libpng licen[cs]e|png reference library licen[cs]e", "libpng", ""),
    "unlicense": ("the unlicense", "unlicense", ""),
    "wtfpl": ("do what the fuck you want to public licen[cs]e", "wtfpl", "2.0"),
    "ncsa": ("(?:university of illinois )?ncsa open source licen[cs]e", "ncsa", ""),
    "psf": ("python software foundation licen[cs]e", "psf|psfl", "2.0"),
    "python": ("python licen[cs]e", "cnri python", "2.0"),
    "ruby": ("ruby licen[cs]e", "ruby", ""),
    "php": ("php licen[cs]e", "php", "3.0 3.01"),
    "openssl": ("openssl licen[cs]e", "openssl|ssleay", ""),
    "postgresql": ("postgresql licen[cs]e", "postgresql", ""),
    "w3c": ("w3c software (?:notice and )?licen[cs]e", "w3c", ""),
    "ms-pl": ("microsoft public licen[cs]e", "ms pl", ""),
    "ms-rl": ("microsoft reciprocal licen[cs]e", "ms rl", ""),
    "upl": ("universal permissive licen[cs]e", "upl", "1.0"),
    "ofl": ("(?:sil )?open font licen[cs]e", "ofl", "1.0 1.1"),
    "lppl": ("latex project public licen[cs]e", "lppl", "1.0 1.1 1.2 1.3"),
    "mulan": ("mulan permissive software licen[cs]e", "mulan psl|mulanpsl", "1.0 2.0"),
    "cecill": ("cecill free software licen[cs]e", "cecill", "1.0 1.1 2.0 2.1"),
    "cecill-b": ("cecill b free software licen[cs]e", "cecill b", ""),
    "cecill-c": ("cecill c free software licen[cs]e", "cecill c", ""),
    "vim": ("vim licen[cs]e", "vim", ""),
    "qpl": ("q public licen[cs]e", "qpl", "1.0"),
    "sleepycat": ("sleepycat licen[cs]e", "sleepycat", ""),
    "sspl": ("server side public licen[cs]e", "sspl", "1.0"),
    "busl": ("business source licen[cs]e", "busl", "1.1"),
    "elastic": ("elastic licen[cs]e", "elastic", "2.0"),
    "polyform": ("polyform (?:noncommercial|small business|shield|strict|perimeter) licen[cs]e", "polyform", "1.0"),
    "commons-clause": ("commons clause", "commons clause", "1.0"),
    "openrail": ("open responsible ai licen[cs]e|creativeml open rail m", "openrail m|openrail", ""),
    "cc0": ("creative commons zero|cc0 1 0 universal|creative commons public domain dedication", "cc0 1 0|cc0|cc zero", ""),
    "cc-by-nc-nd": ("creative commons attribution non ?commercial no ?deriv(?:ative|ativeswork)?s?", "cc by nc nd", "1.0 2.0 2.5 3.0 4.0"),
    "cc-by-nc-sa": ("creative commons attribution non ?commercial share ?alike", "cc by nc sa", "1.0 2.0 2.5 3.0 4.0"),
    "cc-by-nc": ("creative commons attribution non ?commercial", "cc by nc", "1.0 2.0 2.5 3.0 4.0"),
    "cc-by-nd": ("creative commons attribution no ?deriv(?:ative)?s?", "cc by nd", "1.0 2.0 2.5 3.0 4.0"),
    "cc-by-sa": ("creative commons attribution share ?alike", "cc by sa", "1.0 2.0 2.5 3.0 4.0"),
    "cc-by": ("creative commons attribution", "cc by", "1.0 2.0 2.5 3.0 4.0"),
    "pddl": ("public domain dedication and licen[cs]e", "pddl", "1.0"),
    "odbl": ("open database licen[cs]e", "odbl", "1.0"),
    "odc-by": ("open data commons attribution licen[cs]e", "odc by", "1.0"),
    "ogl": ("open government licen[cs]e", "ogl", "1.0 2.0 3.0"),
    "free-art": ("free art licen[cs]e", "licence art libre|fal", "1.2 1.3"),
    "ecl": ("educational community licen[cs]e", "ecl", "1.0 2.0"),
    "nposl": ("non profit open software licen[cs]e", "nposl", "3.0"),
    "rpl": ("reciprocal public licen[cs]e", "rpl", "1.1 1.5"),
    "cpal": ("common public attribution licen[cs]e", "cpal", "1.0"),
    "apsl": ("apple public source licen[cs]e", "apsl", "1.0 1.1 1.2 2.0"),
    "npl": ("netscape public licen[cs]e", "npl", "1.0 1.1"),
    "sissl": ("sun industry standards source licen[cs]e", "sissl", "1.1 1.2"),
    "zpl": ("zope public licen[cs]e", "zpl", "1.1 2.0 2.1"),
    "efl": ("eiffel forum licen[cs]e", "efl", "1.0 2.0"),
    "blueoak": ("blue oak model licen[cs]e", "blueoak|blue oak", "1.0"),
    "hippocratic": ("hippocratic licen[cs]e", "hippocratic", "1.0 2.1 3.0"),
    "json": ("json licen[cs]e", "json", ""),
    "beerware": ("beer ware licen[cs]e|beerware licen[cs]e", "beerware", ""),
    "cern-ohl": ("cern open hardware licen[cs]e", "cern ohl", "1.1 1.2 2.0"),
    "unicode": ("unicode licen[cs]e", "unicode dfs", ""),
    "icu": ("icu licen[cs]e", "icu", ""),
}
#: (label, sentence of a license's or a notice's text, as a pattern that begins with plain words)
SENTENCES: list[tuple[str, str]] = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "the software is provided as is without warranty of any kind express or implied"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("ntp", "permission to use copy modify and distribute this software and its documentation for any purpose"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistributions of source code must retain the above copyright notice"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", "neither the name of .{1,80}? nor the names of its contributors may be used to endorse"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("gpl", "you should have received a copy of the gnu general public license"),
    ("lgpl", "you should have received a copy of the gnu (?:lesser|library) general public license"),
    ("agpl", "you should have received a copy of the gnu affero general public license"),
    ("gpl", "either version 2 of the license or (?:at your option )?any later version"),
    ("gpl-3.0", "either version 3 of the license or (?:at your option )?any later version"),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("apache-2.0", "you may not use this file except in compliance with the license"),
    ("apache-2.0", "you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-1.1", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("cddl", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software"),
    ("zlib", "this software is provided as is without any express or implied warranty"),
    ("zlib", "altered source versions must be plainly marked as such"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("cc0", "to the extent possible under law .{1,80}? has waived all copyright"),
    ("public-domain", "(?:this work|this file|this software|this code) is in the public domain"),
    ("public-domain", "released into the public domain"),
    ("public-domain", "dedicated to the public domain"),
    ("ofl", "this font software is licensed under the sil open font license"),
    ("lppl", "this work may be distributed and or modified under the conditions of the latex project public license"),
    ("artistic", "you can redistribute it and or modify it under the same terms as perl itself"),
    ("wtfpl", "you just do what the fuck you want to"),
    ("beerware", "you can buy me a beer in return"),
    ("json", "the software shall be used for good not evil"),
    ("ogl", "contains public sector information licensed under the open government licence"),
    ("cc", "this work is licensed under a creative commons"),
    ("proprietary", "this software is proprietary and confidential"),
    ("proprietary", "unauthorized copying of this file via any medium is strictly prohibited"),
    ("proprietary", "no part of this (?:publication|work|book|document) may be reproduced"),
    ("proprietary", "for internal use only"),
    ("noncommercial", "(?:for non commercial|for noncommercial) use only"),
    ("noncommercial", "may not be used for commercial purposes"),
    ("copyright", "copyright (?:c )?(?:19|20)\\d\\d"),
    ("copyright", "(?:this work|this article|this text|this page) is protected by copyright"),
    ("dual", "dual licensed under"),
    ("dual", "(?:this work|this program|this software|this library) is dual licensed"),
    ("custom", "see the license file for"),
    ("custom", "subject to the terms and conditions of this license"),
    ("custom", "use of this source code is governed by"),
    ("bsd", "use of this source code is governed by a bsd style license"),
]
#: Words that bring a notice, and those that may stand between them and the name.
NOTICES = ("licensed under", "released under", "distributed under", "available under", "published under", "provided under", "covered by", "governed by", "subject to", "licensed as", "terms of")
FILLERS = "(?:(?:the|a|an|terms|conditions|of|and|version|v|latest) ){0,6}"

#: Versions that are written without a space.
GLUED = {"agpl-3.0": "agplv3|agpl3", "gpl-1.0": "gplv1|gpl1", "gpl-2.0": "gplv2|gpl2", "gpl-3.0": "gplv3|gpl3", "lgpl-2.1": "lgplv2 1", "lgpl-2.0": "lgplv2|lgpl2", "lgpl-3.0": "lgplv3|lgpl3", "apache-2.0": "apache2|apachev2|asl2", "mpl-2.0": "mplv2|mpl2", "mpl-1.1": "mplv1 1"}

#: Priorities, the best first, with what they add to a text's score.
HEADER, NOTICE, SENTENCE, VERSION, NAME = range(5)
WEIGHTS = (1.0, 0.95, 0.9, 0.8, 0.6)
#: The score of a text with phrases of the base alone.
MENTION = 0.4


@dataclass(frozen=True)
class Rule:
    """The label gets the version that the match ends with, if `versioned`."""

    label: str
    priority: int
    keywords: tuple[str, ...]
    pattern: str
    versioned: bool = False


def _version(versions: str) -> str:
    """What may follow a name: 2.0 is "2 0" or "2", with v or version before."""
    minors: dict[str, list[str]] = {}
    for v in versions.split():
        major, minor = v.split(".")
        minors.setdefault(major, []).append(minor)
    numbers = "|".join(f"{major}(?: (?:{'|'.join(own)}))?" for major, own in minors.items())
    return f" (?:licen[cs]e )?(?:version |ver |v )?v?(?:{numbers})"


def _heads(pattern: str) -> Iterator[str]:
    """The plain words, three at most, that a pattern's alternatives begin with."""
    seen = set()
    for option in _options(pattern):
        plain = []
        for w in option.split(" "):
            if not w.isalnum():
                break
            plain.append(w)
        head = " ".join(plain[:3])
        if head not in seen:
            seen.add(head)
            yield head


def _options(pattern: str) -> list[str]:
    """A pattern's alternatives, those of a leading group too: "(?:a|b )?c" begins with a, b or c."""
    out, depth, at = [], 0, 0
    for k, c in enumerate([*pattern, "|"]):
        depth += (c == "(") - (c == ")")
        if c == "|" and not depth:
            out.append(pattern[at:k])
            at = k + 1
    if len(out) > 1:
        return [x for o in out for x in _options(o)]
    if not pattern.startswith("(?:"):
        return [pattern]
    depth = 0
    for k, c in enumerate(pattern):
        depth += (c == "(") - (c == ")")
        if not depth:
            break
    inner, rest = pattern[3:k], pattern[k + 1 :]
    optional = rest.startswith("?")
    rest = rest.removeprefix("?")
    return [x for o in _options(inner) for x in _options(o + rest)] + (_options(rest) if optional else [])


def rules() -> list[Rule]:
    """The signatures in order; a pattern is tried where one of its own first words stands."""
    out = []

    def add(label: str, priority: int, pattern: str, versioned: bool = False) -> None:
        out.append(Rule(label, priority, tuple(_heads(pattern)), pattern, versioned))

    for label, (full, short, versions) in LICENSES.items():
        ending = f"(?:{_version(versions)})?" if versions else ""
        add(label, HEADER, f"spdx license identifier (?:{full}|{short}){ending}", bool(versions))
        add(label, NOTICE, f"(?:{'|'.join(NOTICES)}) {FILLERS}(?:{full}|(?:{short})(?: licen[cs]e)?){ending}", bool(versions))
    for label, pattern in SENTENCES:
        add(label, SENTENCE, pattern)
    for label, (full, short, versions) in LICENSES.items():
        if versions:
            add(label, VERSION, f"(?:{full}|{short}){_version(versions)}", True)
        add(label, NAME, f"(?:{full}|(?:{short}) licen[cs]ed?)")
    for label, pattern in GLUED.items():
        add(label, VERSION, f"(?:{pattern})")
    return out


# --- matching -----------------------------------------------------------------------------
def _body(text_col: str) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), SEPARATORS, " "))


def _words(spaced: Column) -> Column:
    return F.when(spaced == "", 0).otherwise(F.octet_length(spaced) - F.octet_length(F.replace(spaced, F.lit(" "), F.lit(""))) + 1)


def _trie(keywords: list[str]) -> str:
    """An alternation of keywords, told apart by their first letters."""
    by: dict[str, list[str]] = {}
    for k in keywords:
        by.setdefault(k[0], []).append(k[1:])
    return "|".join(a + (rest[0] if len(rest) == 1 else f"(?:{'|'.join(sorted(rest, key=lambda r: (-len(r), r)))})") for a, rest in sorted(by.items()))


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _matches(place: str, signatures: list[Rule]) -> str:
    """SQL: an array of (a, b, priority, rule, label), one for each rule of the place's keyword that matches."""
    by: dict[tuple[str, ...], list[tuple[int, Rule]]] = {}
    for n, r in enumerate(signatures):
        by.setdefault(r.keywords, []).append((n, r))
    none = "cast(array() AS array<struct<m: string, priority: int, rule: int, label: string, versioned: boolean>>)"
    begins = lambda words: " OR ".join(f"startswith({place}.ahead, '{w} ')" for w in words)

    def tried(keywords: tuple[str, ...], own: list[tuple[int, Rule]]) -> str:
        found = ", ".join(f"named_struct('m', regexp_extract({place}.ahead, {_quoted(f'^(?:{r.pattern})(?= )')}, 0), 'priority', {r.priority}, 'rule', {n}, 'label', '{r.label}', 'versioned', {r.versioned})" for n, r in own)
        return f"CASE WHEN {begins(keywords)} THEN array({found}) ELSE {none} END"

    # rules whose keywords begin with one word are looked at where this word stands
    narrow: dict[str, list[str]] = {}
    wide = []
    for keywords, own in by.items():
        words = {k.split(" ")[0] for k in keywords}
        (narrow.setdefault(words.pop(), []) if len(words) == 1 else wide).append(tried(keywords, own))
    cases = " ".join(f"WHEN {begins([word])} THEN flatten(array({', '.join(parts)}))" for word, parts in narrow.items())
    every = f"flatten(array({', '.join([*wide, f'CASE {cases} ELSE {none} END'] if narrow else [*wide, none])}))"
    version = "replace(regexp_extract(m.m, '[ a-z]([0-9]+(?: [0-9]+)?)$', 1), ' ', '.')"
    label = f"CASE WHEN NOT m.versioned OR {version} = '' THEN m.label WHEN contains({version}, '.') THEN concat(m.label, '-', {version}) ELSE concat(m.label, '-', {version}, '.0') END"
    end = f"cast({place}.at + size(split(m.m, ' ')) AS int)"
    return f"transform(filter({every}, m -> m.m <> ''), m -> named_struct('a', {place}.at, 'b', {end}, 'priority', m.priority, 'rule', m.rule, 'label', {label}))"


def _held(d: Column, near: Column) -> Column:
    """Is the interval d inside a better one of the places near it?"""
    return F.exists(
        near,
        lambda place: F.exists(
            place["found"],
            lambda e: (e["a"] <= d["a"]) & (e["b"] >= d["b"]) & ((e["priority"] < d["priority"]) | ((e["priority"] == d["priority"]) & ((e["b"] - e["a"] > d["b"] - d["a"]) | ((e["b"] - e["a"] == d["b"] - d["a"]) & (e["rule"] < d["rule"]))))),
        ),
    )


def detections(df: DataFrame, keep: list[str], text_col: str = "text", signatures: list[Rule] | None = None) -> DataFrame:
    """The columns of `keep` with n_words; base: an array of (word, label); found: an array of (a, b, priority, rule, label), in text order, of what isn't suppressed."""
    signatures = rules() if signatures is None else signatures
    keywords = sorted({*BASE, *(k for r in signatures for k in r.keywords)})
    alone = [k for k in keywords if " " not in k]
    pairs = sorted({" ".join(k.split(" ")[:2]) for k in keywords if " " in k})
    firsts = sorted({k.split(" ")[0] for k in pairs})
    body, n, words, places, found, base = (spare(df, x) for x in ("body", "n_words", "words", "places", "found", "base"))
    c = lambda name: F.col(f"`{name}`")
    out = df.select(*[c(k) for k in keep], _body(text_col).alias(body))
    asked = c(body).rlike(f"(?i)(?<![^ ])(?:{_trie(keywords)})(?![^ ])")
    out = out.select(*[c(k) for k in keep], _words(c(body)).cast("long").alias(n), F.when(asked, F.split(c(body), " ")).alias(words))
    # places: words that begin a keyword, with the words from there on
    word = lambda i: F.lower(F.get(c(words), i))
    at = F.filter(F.sequence(F.lit(0), F.size(c(words)) - 1), lambda i: word(i).isin(alone) | (word(i).isin(firsts) & F.concat(word(i), F.lit(" "), word(i + 1)).isin(pairs)))
    following = lambda i: F.concat(F.array_join(F.slice(c(words), i + 1, REACH), " "), F.lit(" "))
    ahead = F.transform(at, lambda i: F.struct(i.alias("at"), F.translate(following(i), string.ascii_uppercase, string.ascii_lowercase).alias("ahead")))
    out = out.withColumn(places, F.when(c(words).isNotNull(), ahead))
    matched = F.filter(F.expr(f"transform(`{places}`, p -> named_struct('found', {_matches('p', signatures)}))"), lambda p: F.size(p["found"]) > 0)
    named = lambda p: F.array(*[F.when(F.startswith(p["ahead"], F.lit(k + " ")), F.struct(p["at"].alias("word"), F.lit(v).alias("label"))) for k, v in BASE.items()])
    spotted = F.flatten(F.transform(c(places), lambda p: F.filter(named(p), lambda x: x.isNotNull())))
    out = out.select(*[c(k) for k in keep], c(n), spotted.alias(base), matched.alias(places))
    best = F.flatten(F.transform(c(places), lambda p, i: F.filter(p["found"], lambda d: ~_held(d, F.slice(c(places), F.greatest(F.lit(1), i + 2 - REACH), F.least(i + 1, F.lit(REACH)))))))
    return out.select(*[c(k) for k in keep], c(n).alias("n_words"), F.coalesce(c(base), F.array()).alias("base"), F.coalesce(best, F.array()).alias("found"))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_found."""
    own = detections(df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")), ["id"], "text")
    labels = lambda x: F.transform(x, lambda d: d["label"])
    at = F.transform("base", lambda d: d["word"])
    weight = F.coalesce(F.array_max(F.transform("found", lambda d: F.element_at(F.array(*map(F.lit, WEIGHTS)), d["priority"] + 1))), F.lit(0.0))
    joined = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    return own.select(
        F.col("id").alias(id_col), "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(at).cast("long").alias("first_word"), F.array_max(at).cast("long").alias("last_word"),
        joined(labels(F.col("base"))).alias("base_labels"), joined(F.concat(labels(F.col("base")), labels(F.col("found")))).alias("labels"),
        F.greatest(weight, F.when(F.size("base") > 0, F.lit(MENTION)).otherwise(F.lit(0.0))).alias("score"), F.size("found").cast("long").alias("n_found"),
    )


# --- the same in SQL, for the comparison ------------------------------------------------------
def oracle(table: str = "documents") -> str:
    """DuckDB SQL of `scan`: the rules as rows, places by joins, suppression as an anti-join."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    listed = ", ".join(f"({n}, {quoted(r.label)}, {r.priority}, {r.versioned}, {quoted(k)}, {quoted(r.pattern)})" for n, r in enumerate(rules()) for k in r.keywords)
    heads = ", ".join(quoted(w) for w in sorted({k.split(" ")[0] for k in {*BASE, *(k for r in rules() for k in r.keywords)}}))
    base = ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in BASE.items())
    ascii_lower = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    return f"""
        WITH rules(rule, label, priority, versioned, keyword, pattern) AS (VALUES {listed}), base(phrase, label) AS (VALUES {base}),
        docs AS (SELECT row_number() OVER () AS row, doc_id, list_filter(string_split(regexp_replace({ascii_lower}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g'), ' '), lambda x: x <> '') AS words FROM {table}),
        spots AS (SELECT row, words, unnest(range(0, len(words))) AS k FROM docs),
        places AS (SELECT row, k::INTEGER AS k, array_to_string(words[k + 1 : k + {REACH}], ' ') || ' ' AS ahead FROM spots WHERE words[k + 1] IN ({heads})),
        tried AS (SELECT DISTINCT row, k, rule, label, priority, versioned, regexp_extract(ahead, '^((?:' || pattern || ') )', 1) AS m FROM places, rules WHERE starts_with(ahead, keyword || ' ')),
        named AS (SELECT *, replace(regexp_extract(m, '[ a-z]([0-9]+(?: [0-9]+)?) $', 1), ' ', '.') AS v FROM tried WHERE m <> ''),
        found AS (SELECT row, k AS a, k + len(m) - len(replace(m, ' ', '')) AS b, rule, label || CASE WHEN NOT versioned OR v = '' THEN '' WHEN contains(v, '.') THEN '-' || v ELSE '-' || v || '.0' END AS label, priority FROM named),
        best AS (SELECT * FROM found d WHERE NOT EXISTS (SELECT 1 FROM found e WHERE e.row = d.row AND e.a <= d.a AND e.b >= d.b AND (e.priority < d.priority OR (e.priority = d.priority AND (e.b - e.a > d.b - d.a OR (e.b - e.a = d.b - d.a AND e.rule < d.rule)))))),
        hits AS (SELECT row, k, label FROM places, base WHERE starts_with(ahead, phrase || ' ')),
        b AS (SELECT row, count(*) AS n, min(k) AS low, max(k) AS high, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM hits GROUP BY row),
        w(priority, weight) AS (VALUES {", ".join(f"({k}, {x})" for k, x in enumerate(WEIGHTS))}),
        f AS (SELECT row, count(*) AS n, max(weight)::DOUBLE AS weight FROM best JOIN w USING (priority) GROUP BY row),
        l AS (SELECT row, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT row, label FROM hits UNION ALL SELECT row, label FROM best) GROUP BY row)
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base, b.low::BIGINT AS first_word, b.high::BIGINT AS last_word, coalesce(b.labels, '') AS base_labels, coalesce(l.labels, '') AS labels,
            greatest(coalesce(f.weight, 0), CASE WHEN b.n > 0 THEN {MENTION} ELSE 0 END)::DOUBLE AS score, coalesce(f.n, 0)::BIGINT AS n_found
        FROM docs LEFT JOIN b USING (row) LEFT JOIN f USING (row) LEFT JOIN l USING (row)
    """
