"""License notices found by ordered signature rules.

A text is reduced to its words, lower-cased and joined by one space; every rule
is a regular expression over that line.  A rule runs only on texts that hold one
of the keywords of its form and one of its family; every match has both.  Rules are ordered by priority: sentences of license
texts and addresses before identifiers and full titles, these before grants, grants before mentions.  Detections are taken in that order; one whose
interval lies within an interval already taken is suppressed.  Matching and suppression take time in proportion to the text and
its detections.

``SIGNATURES`` are written one by one; ``FAMILIES`` and ``FORMS`` are written by hand, too, and their product gives the other rules.
Defined results: a null or empty text has no words and score 0; repeated rows are
scanned one by one; texts are scanned whole.
An empty table gives no rows; repeated rows are scanned one by one; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as ar

#: Phrases that always count, with their labels.  Fixed values.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: label, keywords of which every match holds one, names of the license as it stands between words
FAMILIES = [
    ("mit", b"mit|expat", rb"mit(?: x11)?|expat"),
    ("apache-2", b"apache", rb"apache (?:software )?(?:license )?(?:v|version )?2(?: 0)?"),
    ("apache-1.1", b"apache", rb"apache (?:software )?(?:license )?(?:v|version )?1 1"),
    ("apache", b"apache", rb"apache(?: software)?"),
    ("gpl-2", b"gpl|general public license", rb"(?:gnu )?(?:gpl|general public license) ?(?:v|version )?2(?: 0)?"),
    ("gpl-3", b"gpl|general public license", rb"(?:gnu )?(?:gpl|general public license) ?(?:v|version )?3(?: 0)?"),
    ("gpl", b"gpl|general public license", rb"gnu (?:gpl|general public license)|gpl"),
    ("lgpl-2.1", b"lgpl|lesser general public license", rb"(?:gnu )?(?:lgpl|lesser general public license) ?(?:v|version )?2 1"),
    ("lgpl-3", b"lgpl|lesser general public license", rb"(?:gnu )?(?:lgpl|lesser general public license) ?(?:v|version )?3(?: 0)?"),
    ("lgpl", b"lgpl|lesser general public license", rb"gnu (?:lgpl|lesser general public license)|lgpl"),
    ("agpl-3", b"agpl|affero general public license", rb"(?:gnu )?(?:agpl|affero general public license) ?(?:v|version )?3(?: 0)?"),
    ("agpl", b"agpl|affero general public license", rb"gnu (?:agpl|affero general public license)|agpl"),
    ("bsd-2-clause", b"bsd", rb"bsd (?:2|two) clause|2 clause bsd|simplified bsd|freebsd"),
    ("bsd-3-clause", b"bsd", rb"bsd (?:3|three) clause|3 clause bsd|new bsd|revised bsd|modified bsd"),
    ("bsd-4-clause", b"bsd", rb"bsd (?:4|four) clause|4 clause bsd|original bsd"),
    ("bsd", b"bsd", rb"bsd"),
    ("mpl-1.1", b"mpl|mozilla public license", rb"(?:mpl|mozilla public license) ?(?:v|version )?1 1"),
    ("mpl-2", b"mpl|mozilla public license", rb"(?:mpl|mozilla public license) ?(?:v|version )?2(?: 0)?"),
    ("mpl", b"mpl|mozilla public license", rb"mozilla public license|mpl"),
    ("epl-1", b"epl|eclipse public license", rb"(?:epl|eclipse public license) ?(?:v|version )?1(?: 0)?"),
    ("epl-2", b"epl|eclipse public license", rb"(?:epl|eclipse public license) ?(?:v|version )?2(?: 0)?"),
    ("cddl-1", b"cddl|common development and distribution license", rb"(?:cddl|common development and distribution license) ?(?:v|version )?1 [01]"),
    ("cc-by-nc-nd", b"cc by nc nd|attribution non", rb"cc by nc nd(?: \d 0)?|attribution non ?commercial no ?deriv\w+"),
    ("cc-by-nc-sa", b"cc by nc sa|attribution non", rb"cc by nc sa(?: \d 0)?|attribution non ?commercial share ?alike"),
    ("cc-by-nc", b"cc by nc|attribution non", rb"cc by nc(?: \d 0)?|attribution non ?commercial"),
    ("cc-by-nd", b"cc by nd|attribution no", rb"cc by nd(?: \d 0)?|attribution no ?deriv\w+"),
    ("cc-by-sa", b"cc by sa|attribution share", rb"cc by sa(?: \d 0)?|attribution share ?alike"),
    ("cc-by", b"cc by|creative commons attribution", rb"cc by(?: \d 0)?|creative commons attribution"),
    ("cc0", b"cc0|cc zero", rb"cc0(?: 1 0)?|cc zero"),
    ("isc", b"isc", rb"isc"),
    ("zlib", b"zlib", rb"zlib(?: libpng)?"),
    ("bsl-1", b"boost software license|bsl 1 0", rb"boost software license(?: (?:v|version )?1 0)?|bsl 1 0"),
    ("unlicense", b"unlicense", rb"unlicense"),
    ("wtfpl", b"wtfpl|do what the fuck you want", rb"wtfpl|do what the fuck you want to public license"),
    ("artistic-2", b"artistic license", rb"artistic license ?(?:v|version )?2(?: 0)?"),
    ("artistic", b"artistic", rb"artistic"),
    ("ofl-1.1", b"ofl|open font license", rb"(?:sil )?(?:ofl|open font license) ?(?:v|version )?1 1"),
    ("psf-2", b"psf|python software foundation", rb"psf|python software foundation(?: license)?(?: version 2)?"),
    ("eupl-1.2", b"eupl|european union public licen", rb"eupl(?: (?:v|version )?1 2)?|european union public licen[cs]e"),
    ("odbl", b"odbl|open database license", rb"odbl|open database license"),
    ("osl-3", b"osl 3 0|open software license", rb"osl 3 0|open software license ?(?:v|version )?3 0"),
    ("ms-pl", b"ms pl|microsoft public license", rb"ms pl|microsoft public license"),
    ("postgresql", b"postgresql", rb"postgresql"),
    ("openssl", b"openssl", rb"openssl"),
    ("ncsa", b"ncsa", rb"ncsa|university of illinois ncsa open source"),
    ("public-domain", b"public domain", rb"public domain"),
    ("proprietary", b"proprietary", rb"proprietary"),
]

#: label, a keyword that every match holds, the words of a license's text, file header or address, score; more special ones first
SIGNATURES = [
    ("bsl-1", b"person or organization obtaining", rb"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", 1.0),
    ("mit", b"permission is hereby granted", rb"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", 1.0),
    ("postgresql", b"without a written agreement", rb"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted", 1.0),
    ("isc", b"provided that the above copyright notice", rb"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", 1.0),
    ("0bsd", b"with or without fee is hereby granted", rb"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted", 1.0),
    ("bsd-4-clause", b"all advertising materials", rb"all advertising materials mentioning features or use of this software must display the following acknowledge?ment", 1.0),
    ("bsd-3-clause", b"endorse or promote products", rb"neither the names? of (?:\S+ ){1,20}?may be used to endorse or promote products derived from this software", 1.0),
    ("bsd", b"use in source and binary forms", rb"redistributions? and use in source and binary forms with or without modification (?:are|is) permitted", 1.0),
    ("bsd", b"redistributions of source code", rb"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", 0.95),
    ("apache-2", b"apache license version 2 0 january", rb"apache license version 2 0 january 2004", 1.0),
    ("apache-2", b"you may not use this file", rb"licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", 1.0),
    ("apache-2", b"as is basis", rb"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", 0.95),
    ("agpl-3", b"affero general public", rb"under the terms of the gnu affero general public license as published by the free software foundation (?:either )?version 3", 1.0),
    ("agpl", b"affero general public", rb"under the terms of the gnu affero general public license as published by the free software foundation", 1.0),
    ("lgpl-3", b"lesser general public", rb"under the terms of the gnu lesser general public license as published by the free software foundation (?:either )?version 3", 1.0),
    ("lgpl-2.1", b"lesser general public", rb"under the terms of the gnu lesser general public license as published by the free software foundation (?:either )?version 2 1", 1.0),
    ("lgpl-2", b"library general public", rb"under the terms of the gnu library general public license(?: as published by the free software foundation (?:either )?version 2)?", 1.0),
    ("lgpl", b"lesser general public", rb"under the terms of the gnu lesser general public license as published by the free software foundation", 1.0),
    ("gpl-3", b"gnu general public", rb"under the terms of the gnu general public license as published by the free software foundation (?:either )?version 3", 1.0),
    ("gpl-2", b"gnu general public", rb"under the terms of the gnu general public license as published by the free software foundation (?:either )?version 2", 1.0),
    ("gpl", b"gnu general public", rb"under the terms of the gnu general public license as published by the free software foundation", 1.0),
    ("gpl", b"you can redistribute it", rb"is free software you can redistribute it and or modify it", 0.8),
    ("gpl-3", b"version 3 29 june 2007", rb"gnu general public license version 3 29 june 2007", 1.0),
    ("gpl-2", b"version 2 june 1991", rb"gnu general public license version 2 june 1991", 1.0),
    ("agpl-3", b"version 3 19 november 2007", rb"gnu affero general public license version 3 19 november 2007", 1.0),
    ("lgpl-2.1", b"version 2 1 february 1999", rb"gnu lesser general public license version 2 1 february 1999", 1.0),
    ("gfdl", b"free documentation license", rb"(?:under the terms of the )?gnu free documentation license(?: version 1 \d)?", 1.0),
    ("mpl-2", b"source code form is subject", rb"this source code form is subject to the terms of the mozilla public license v 2 0", 1.0),
    ("mpl-1.1", b"contents of this file are subject", rb"the contents of this file are subject to the mozilla public license version 1 1", 1.0),
    ("cddl-1", b"contents of this file are subject", rb"the contents of this file are subject to the terms of the common development and distribution license", 1.0),
    ("epl-2", b"accompanying materials", rb"this program and the accompanying materials are made available under the terms of the eclipse public license (?:v(?:ersion)? )?2 0", 1.0),
    ("epl-1", b"accompanying materials", rb"this program and the accompanying materials are made available under the terms of the eclipse public license (?:v(?:ersion)? )?1 0", 1.0),
    ("zlib", b"in no event will the authors", rb"in no event will the authors be held liable for any damages arising from the use of this software", 1.0),
    ("unlicense", b"free and unencumbered", rb"this is free and unencumbered software released into the public domain", 1.0),
    ("wtfpl", b"you just do what", rb"you just do what the fuck you want to", 1.0),
    ("cc0", b"dedicated the work to the public domain", rb"the person who associated a work with this deed has dedicated the work to the public domain", 1.0),
    ("ofl-1.1", b"font software is licensed", rb"this font software is licensed under the sil open font license version 1 1", 1.0),
    ("artistic", b"intent of this document", rb"the intent of this document is to state the conditions under which a package may be copied", 1.0),
    ("artistic-2", b"everyone is permitted to copy", rb"the artistic license 2 0 (?:\S+ ){0,12}?everyone is permitted to copy and distribute verbatim copies of this license document", 1.0),
    ("openssl", b"openssl project for use", rb"this product includes software developed by the openssl project for use in the openssl toolkit", 1.0),
    ("psf-2", b"psf hereby grants", rb"psf hereby grants licensee a nonexclusive royalty free world wide license", 1.0),
    ("ncsa", b"university of illinois", rb"university of illinois ncsa open source license", 1.0),
    ("cc-by-nc-nd", b"creativecommons org licenses", rb"creativecommons org licenses by nc nd(?: \d \d)?", 1.0),
    ("cc-by-nc-sa", b"creativecommons org licenses", rb"creativecommons org licenses by nc sa(?: \d \d)?", 1.0),
    ("cc-by-nc", b"creativecommons org licenses", rb"creativecommons org licenses by nc(?: \d \d)?", 1.0),
    ("cc-by-nd", b"creativecommons org licenses", rb"creativecommons org licenses by nd(?: \d \d)?", 1.0),
    ("cc-by-sa", b"creativecommons org licenses", rb"creativecommons org licenses by sa(?: \d \d)?", 1.0),
    ("cc-by", b"creativecommons org licenses", rb"creativecommons org licenses by(?: \d \d)?", 1.0),
    ("cc0", b"creativecommons org publicdomain", rb"creativecommons org publicdomain zero(?: 1 0)?", 1.0),
    ("public-domain", b"creativecommons org publicdomain", rb"creativecommons org publicdomain mark(?: 1 0)?", 1.0),
    ("mit", b"opensource org license", rb"opensource org licenses? mit", 1.0),
    ("isc", b"opensource org license", rb"opensource org licenses? isc", 1.0),
    ("bsd-2-clause", b"opensource org license", rb"opensource org licenses? bsd 2 clause", 1.0),
    ("bsd-3-clause", b"opensource org license", rb"opensource org licenses? bsd 3 clause", 1.0),
    ("apache-2", b"apache org licenses", rb"apache org licenses license 2 0", 1.0),
    ("agpl-3", b"gnu org licenses", rb"gnu org licenses agpl(?: 3 0)?", 1.0),
    ("lgpl-2.1", b"gnu org licenses", rb"gnu org licenses (?:old licenses )?lgpl 2 1", 1.0),
    ("lgpl-3", b"gnu org licenses", rb"gnu org licenses lgpl(?: 3 0)?", 1.0),
    ("gpl-2", b"gnu org licenses", rb"gnu org licenses (?:old licenses )?gpl 2 0", 1.0),
    ("gpl-3", b"gnu org licenses", rb"gnu org licenses gpl(?: 3 0)?", 1.0),
    ("gfdl", b"gnu org licenses", rb"gnu org licenses fdl(?: 1 3)?", 1.0),
    ("mpl-2", b"mozilla org", rb"mozilla org (?:en us )?mpl 2 0", 1.0),
    ("epl-2", b"eclipse org legal", rb"eclipse org legal epl (?:v )?2 0", 1.0),
    ("epl-1", b"eclipse org legal", rb"eclipse org legal epl v10", 1.0),
    ("bsl-1", b"boost org license", rb"boost org license 1 0", 1.0),
    ("ofl-1.1", b"scripts sil org", rb"scripts sil org ofl", 1.0),
    ("odbl", b"opendatacommons org", rb"opendatacommons org licenses odbl", 1.0),
    ("unlicense", b"unlicense org", rb"unlicense org", 1.0),
    ("wtfpl", b"wtfpl net", rb"wtfpl net", 1.0),
    ("public-domain", b"public domain", rb"(?:is|are|placed|released|dedicated) (?:hereby )?(?:in|into|to) the public domain", 0.8),
    ("all-rights-reserved", b"all rights reserved", rb"copyright (?:\S+ ){0,10}?all rights reserved", 0.8),
    ("all-rights-reserved", b"all rights reserved", rb"all rights reserved", 0.6),
]

#: priority (less wins), keywords of which every match holds one, expression around NAME, score
FORMS = [
    (0, b"spdx", rb"spdx licen[cs]e identifier (?:NAME)(?: only| or later)?", 1.0),
    (1, b"licensed under |licenced under |released under |distributed under |available under |provided under |published under ",
     rb"(?:licen[cs]ed|released|distributed|available|provided|published|redistributed) under "
     rb"(?:the )?(?:terms (?:and conditions )?of )?(?:the |a )?(?:NAME)(?: licen[cs]e)?(?: only| or later)?", 0.95),
    (2, b"subject to |according to ", rb"(?:subject|according) to (?:the )?(?:terms (?:and conditions )?of )?(?:the )?(?:NAME)(?: licen[cs]e)?", 0.9),
    (3, b"governed by |covered by ", rb"(?:governed|covered) by (?:the )?(?:NAME)(?: licen[cs]e)?", 0.9),
    (4, b"licen", rb"(?:the )?(?:NAME) licen[cs]e(?: agreement)?(?: (?:v|version )?\d(?: \d)?)?", 0.8),
    (5, b"licen", rb"licen[cs]e (?:is |type |name )?(?:NAME)", 0.7),
    (6, b" international | unported | generic ", rb"(?<= )(?:NAME)(?= (?:international|unported|generic))", 0.7),
]


@dataclass(frozen=True)
class Rule:
    priority: tuple[int, int]
    label: str
    keywords: tuple[tuple[bytes, ...], ...]
    pattern: re.Pattern[bytes]
    score: float


def rules() -> list[Rule]:
    """The signatures, then the product of forms and families, in order of priority."""
    out = [
        Rule((-1, order), label, ((keyword,),), re.compile(rb"(?<= )" + words + rb"(?= )"), score)
        for order, (label, keyword, words, score) in enumerate(SIGNATURES)
    ]
    for priority, keyword, form, score in FORMS:
        for order, (label, name_keyword, name) in enumerate(FAMILIES):
            pattern = re.compile(rb"(?<= )" + form.replace(b"NAME", name) + rb"(?= )")
            keywords = tuple(keyword.split(b"|")), tuple(name_keyword.split(b"|"))
            out.append(Rule((priority, order), label, keywords, pattern, score))
    return out


_TO_SPACE = bytes(0x20 if ar.LICENCE_BREAKS[i] else i for i in range(256))


def word_line(text: bytes) -> tuple[bytes, int]:
    """The words of a text, each between single spaces, and their number."""
    words = text.lower().translate(_TO_SPACE).split()
    return b" " + b" ".join(words) + b" ", len(words)


def places(line: bytes, phrase: str) -> list[int]:
    """Numbers of the words at which ``phrase`` starts."""
    needle, out, counted, number = b" " + phrase.encode() + b" ", [], 0, 0
    at = line.find(needle)
    while at >= 0:
        number += line.count(b" ", counted, at)
        counted = at
        out.append(number)
        at = line.find(needle, at + 1)
    return out


class Taken:
    """The widest intervals so far, none within another: their starts and their ends both rise."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def holds(self, start: int, end: int) -> bool:
        at = bisect_right(self.starts, start)
        return at > 0 and self.ends[at - 1] >= end

    def add(self, start: int, end: int) -> None:
        low, high = bisect_left(self.starts, start), bisect_right(self.ends, end)
        self.starts[low:max(low, high)] = [start]
        self.ends[low:max(low, high)] = [end]


def detect(line: bytes, ordered: list[Rule]) -> list[tuple[int, int, str, float]]:
    """start, end, label, score of the detections that are not suppressed."""
    keywords: dict[tuple[bytes, ...], bool] = {}
    found = []
    for rule in ordered:
        for k in rule.keywords:
            if k not in keywords:
                keywords[k] = any(x in line for x in k)
            if not keywords[k]:
                break
        else:
            found += [(rule.priority, m.start(), m.end(), rule) for m in rule.pattern.finditer(line)]
    out: list[tuple[int, int, str, float]] = []
    taken = Taken()
    for _, start, end, rule in sorted(found, key=lambda d: (d[0], d[1], -d[2])):
        if not taken.holds(start, end):
            taken.add(start, end)
            out.append((start, end, rule.label, rule.score))
    return out


ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("label", pa.string())])))])
SCHEMA = ("doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
          "base_labels string, labels string, score double, spans array<struct<start: int, end: int, label: string>>")


def scan(docs: DataFrame) -> DataFrame:
    """One row per document; ``spans`` are the detections in the line of words."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordered = rules()
        first = sorted({k for rule in ordered for k in rule.keywords[0]})
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), ar.text_bytes(batch.column("text")), strict=True):
                line, n = word_line(text)
                base = {phrase: places(line, phrase) for phrase in BASE}
                starts = sorted(s for found in base.values() for s in found)
                base_labels = sorted({BASE[p] for p, found in base.items() if found})
                spans = detect(line, ordered) if any(k in line for k in first) else []
                labels = sorted({*base_labels, *(label for _, _, label, _ in spans)})
                rows.append({
                    "doc_id": doc_id, "n_words": n, "n_base": len(starts),
                    "first_word": starts[0] if starts else None, "last_word": starts[-1] if starts else None,
                    "base_labels": ",".join(base_labels), "labels": ",".join(labels),
                    "score": 1.0 if starts else max((s[3] for s in spans), default=0.0),
                    "spans": [{"start": s, "end": e, "label": label} for s, e, label, _ in spans],
                })
            yield pa.RecordBatch.from_pylist(rows, schema=ARROW)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(search, SCHEMA)
