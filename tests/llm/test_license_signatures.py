"""Sentences of license texts, suppression against its plain form, and the time of long texts."""

import random
import re
import time

import pytest

from gistmill.llm import license_scan as ls


def labels(text):
    line, _ = ls.word_line(text.encode())
    return sorted({d[2] for d in ls.detect(line, ls.rules())})


@pytest.mark.parametrize("text, expected", [
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
     "files (the \"Software\")", ["mit"]),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that", ["bsd"]),
    ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
     "derived from this software", ["bsd-3-clause"]),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
     "published by the Free Software Foundation, either version 3 of the License", ["gpl", "gpl-3"]),
    ("See https://creativecommons.org/licenses/by/4.0 for details", ["cc-by"]),
    ("http://creativecommons.org/licenses/by-nc-sa/3.0/", ["cc-by-nc-sa"]),
    ("http://www.apache.org/licenses/LICENSE-2.0", ["apache-2"]),
    ("Copyright (c) 2019, Some Company Ltd. All rights reserved.", ["all-rights-reserved"]),
    ("This is free and unencumbered software released into the public domain.", ["unlicense"]),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.", ["0bsd"]),
    ("The rights of way were reserved, and permission was granted.", []),
])
def test_texts_of_licenses(text, expected):
    assert labels(text) == expected


def test_every_match_of_a_signature_holds_its_keyword():
    for label, keyword, words, _ in ls.SIGNATURES:
        # the pattern with its optional parts left out and the first of its choices, and with them
        for keep in (False, True):
            text = words.decode()
            text = re.sub(r"\(\?:\\S\+ \)\{\d+,\d+\}\?", "some one ", text)
            while "(?:" in text:
                text = re.sub(r"\(\?:([^()]*)\)(\?)?", lambda m: "" if m[2] and not keep else m[1].split("|")[0], text)
            text = re.sub(r"(\w)\?", r"\1", text).replace(r"\d", "1")
            line, _ = ls.word_line(text.encode())
            assert keyword in line, (label, line)
            assert re.search(rb"(?<= )" + words + rb"(?= )", line), (label, line)


def test_suppression_is_that_of_all_intervals():
    rng = random.Random(2)
    for _ in range(300):
        taken, plain = ls.Taken(), []
        for _ in range(60):
            start = rng.randrange(40)
            end = start + rng.randrange(1, 15)
            held = any(s <= start and end <= e for s, e in plain)
            assert taken.holds(start, end) == held
            if not held:
                taken.add(start, end)
                plain.append((start, end))


def test_places_as_word_by_word():
    rng = random.Random(3)
    text = " ".join(rng.choice(["cc", "by", "nc", "mit"]) for _ in range(3000))
    line, n = ls.word_line(text.encode())
    words = text.split()
    assert ls.places(line, "cc by nc") == [i for i in range(n) if words[i:i + 3] == ["cc", "by", "nc"]]


def test_two_megabytes_of_notices():
    begun = time.time()
    line, _ = ls.word_line(b"released under the terms of the GPL v3. " * 50_000)
    assert len(ls.detect(line, ls.rules())) == 50_000
    line, _ = ls.word_line(b"cc by nc " * 220_000)
    assert len(ls.places(line, "cc by nc")) == 220_000
    assert time.time() - begun < 60
