"""Licence scan: layouts of one licence meet, others do not."""

from __future__ import annotations

import random
from pathlib import Path

from sparkmine.llm import licenses
from sparkmine.llm.license_texts import LICENSES

MIT = LICENSES[0][1]


def scanned(spark, texts):
    df = spark.createDataFrame([(i, t, "l", 0) for i, t in enumerate(texts)], "doc_id long, text string, license string, digest int")
    return {r.doc_id: r for r in licenses.scan(df).collect()}


def test_layouts_of_one_licence(spark):
    other = [
        MIT,
        "MIT License\n\nCopyright (c) 2020-2024 Some Body\nAll rights reserved.\n" + MIT,
        "/*\n * (C) 1999 A\n * © 2001 B\n * " + MIT.replace("\n", "\r\n * ") + "\n */",
        MIT.upper().replace("COPYRIGHT HOLDERS", "copyright owners").replace("SUBLICENSE", "sublicence"),
        " ".join(MIT.split()),
    ]
    got = scanned(spark, other)
    assert [got[i].license for i in range(len(other))] == ["MIT"] * len(other)
    assert len({got[i].digest for i in (0, 3, 4)}) == 1


def test_other_texts_do_not_match(spark):
    got = scanned(spark, [MIT.replace("free of charge", "for a fee"), MIT + " and more", "", None, " \n", "x" * 200_000])
    assert all(r.license is None and r.n_license_lines == 0 and r.line_licenses == "" for r in got.values())
    assert got[2].digest == got[3].digest == got[4].digest


def test_notices_in_documents(spark):
    got = scanned(spark, ["Prose.\nReleased under the MIT licence!\nMore.\nLicensed under CC BY-NC 4.0\nreleased under the mit license", "SPDX-License-Identifier: Apache-2.0"])
    assert (got[0].license, got[0].n_license_lines, got[0].line_licenses) == (None, 3, "CC-BY-NC-4.0,MIT")
    assert (got[1].license, got[1].line_licenses) == ("Apache-2.0", "Apache-2.0")


def test_each_known_text_is_its_own_licence(spark):
    got = scanned(spark, [t for _, t in LICENSES])
    assert [got[i].license for i in range(len(LICENSES))] == [i for i, _ in LICENSES]


def test_empty_table_and_repeats(spark):
    assert scanned(spark, []) == {}
    df = spark.createDataFrame([(None, "x")] * 3, "doc_id long, text string")
    assert licenses.scan(df).count() == 3


def test_whole_texts_of_long_licences(spark):
    """Whole files as they are spread, in a comment and without what follows the terms."""
    files = sorted((Path(licenses.__file__).parent / "known_licenses").glob("*.txt"))
    names = [f.stem for f in files]
    assert {"Apache-2.0", "GPL-2.0-only", "GPL-3.0-only", "LGPL-2.1-only", "LGPL-3.0-only", "MPL-2.0", "CC0-1.0", "Unlicense"} <= set(names)
    texts = [f.read_text() for f in files]
    got = scanned(spark, texts)
    assert [got[i].license for i in range(len(texts))] == names
    got = scanned(spark, ["/*\n * " + t.replace("\n", "\r\n * ") + "\n */" for t in texts])
    assert [got[i].license for i in range(len(texts))] == names
    got = scanned(spark, [t.split("END OF TERMS AND CONDITIONS")[0] + "END OF TERMS AND CONDITIONS\n" for t in texts if "END OF TERMS" in t])
    assert [got[i].license for i in range(len(got))] == [n for n, t in zip(names, texts) if "END OF TERMS" in t]
    got = scanned(spark, [t + "\nUnder one more condition." for t in texts])
    assert all(r.license is None for r in got.values())


def test_identifier_lines(spark):
    names = ["MPL-2.0", "LGPL-2.1-or-later", "AGPL-3.0-only", "Unlicense", "GPL-3.0-or-later", "CC-BY-4.0"]
    got = scanned(spark, [f"# SPDX-License-Identifier: {n}\nimport this" for n in names])
    assert [got[i].line_licenses for i in range(len(names))] == names


HEADERS = [
    "Copyright (c) Microsoft Corporation.", "Copyright The Kubernetes Authors", "Copyright the original author or authors.", "Copyright (c) Jane Doe",
    "Portions Copyright (c) 2010 Some Body", "Copyright by Jane Doe 2020", "Copyright Jane Doe", "Copyright: Jane Doe <j@example.org>", "(c) Jane Doe",
    "(C) The X Authors. All rights reserved.", "© Jane Doe", "Copyright © Jane Doe", "(c) Copyright 2020 Some Body", "(c) Copyright Jane Doe", "Copyright Élan Vital",
    "Portions are copyright Jane Doe", "Modifications © Jane Doe", "SPDX-FileCopyrightText: Jane Doe", "Copyright 3M Company", "Copyright &copy; Jane Doe", "Copyright Noticeboard Ltd.",
]


def test_holder_lines_without_year(spark):
    bsd = next(t for i, t in LICENSES if i == "BSD-3-Clause")
    texts = [f"{h}\n{t}" for h in HEADERS for t in (MIT, bsd)] + [f" * {h}\r\n * Copyright (c) 2001 B\r\n * All rights reserved.\r\n{MIT}" for h in HEADERS]
    got = scanned(spark, texts)
    wrong = [texts[i][:60] for i in range(len(texts)) if got[i].license != ("BSD-3-Clause" if bsd in texts[i] else "MIT")]
    assert not wrong


def test_wrapped_lines_are_no_holder_lines(spark):
    """A known text without its copyright lines is the same however it is wrapped."""
    import re

    stated = re.compile(r"copyright \(c\)|copyright \[yyyy|\(c\) ?(?:year|_|<year)|all rights reserved", re.I)
    wraps = []
    for k, (_, text) in enumerate(LICENSES):
        words = " ".join(x for x in text.split("\n") if not stated.search(x)).split()
        wraps += [(k, " ".join(words)), (k, "\n".join(words))]
        wraps += [(k, "\n".join([" ".join(words[:at]), *(" ".join(words[i : i + 3]) for i in range(at, len(words), 3))])) for at in range(3)]
    df = spark.createDataFrame(wraps, "doc_id long, text string")
    digests = {}
    for r in licenses.scan(df, []).collect():
        digests.setdefault(r.doc_id, set()).add(r.digest)
    assert all(len(d) == 1 for d in digests.values())


def test_prose_lines_stay(spark):
    lines = ["Copyright notices must be kept.", "Copyright infringement is a crime.", "copyright", "copyright the", "(c) you must pay for it", "(c) the licensee pays", "copyright and patents", "A note on copyright Jane"]
    got = scanned(spark, [MIT + "\n" + x for x in lines])
    assert all(r.license is None for r in got.values())


ADDED = [
    "(c) Redistribution for military use is forbidden", "(c) Commercial use needs a fee", "Copyright (c) 2020 X; commercial use forbidden without a fee",
    "(c) Commercial use costs money", "Copyright 2020 X. You must pay", "Copyright X, who must be paid", "Copyright may apply", "(c) May be sold only in " + "far " * 60 + "lands",
]


def test_no_text_with_added_words_matches(spark):
    texts = [t for x in ADDED for t in (f"{x}\n{MIT}", f"{MIT}\n{x}", f"Copyright (c) 2001 B\n{x}\n{MIT}")]
    assert all(r.license is None for r in scanned(spark, texts).values())


def test_names_that_are_words_and_long_holders(spark):
    heads = ["Copyright Will Smith", "Copyright May Lee", "Copyright (c) 2020 Will Smith", "(c) A", "Copyright " + "Very " * 60 + "Long Company Name Inc.", "copyright 2015 jquery foundation and other contributors"]
    got = scanned(spark, [f"{h}\n{MIT}" for h in heads[:3] + heads[4:]])
    assert all(r.license == "MIT" for r in got.values())


def plain_holder(line):
    """The same decision word by word, without a pattern for the line."""
    low = line.lower()
    words, kinds = [], []
    for c in line:
        inside = c.isascii() and c.isalnum() or ord(c) > 127 and c != "©"
        if inside and kinds and kinds[-1]:
            words[-1] += c
        elif inside:
            words.append(c)
        kinds.append(inside)
    if [w.lower() for w in words] == ["all", "rights", "reserved"]:
        return True
    heads = {"portions", "parts", "modifications", "additions", "changes", "contributions"}
    rest = [w.lower() for w in words]
    if rest and rest[0] in heads:
        rest = rest[1:]
        rest = rest[1:] if rest[:1] == ["are"] else rest
    taken = len(words) - len(rest)
    sign = "©" in low or "(c)" in low
    if rest[:1] == ["copyright"]:
        rest = rest[1:]
        rest = rest[1:] if rest[:1] == ["c"] and "(c)" in low or rest[:1] == ["copy"] and "&copy;" in low else rest
    elif rest[:1] == ["c"] and "(c)" in low:
        rest = rest[1:]
        rest = rest[1:] if rest[:1] == ["copyright"] else rest
    elif not (sign and low.lstrip(" *#/-.").startswith("©") or taken and sign):
        return False
    names = words[len(words) - len(rest) :]
    if names[:1] and names[0].lower() == "by":
        names = names[1:]
    joined = " ".join(names).lower()
    while "all rights reserved" in joined:
        cut = next(i for i in range(len(names)) if [w.lower() for w in names[i : i + 3]] == ["all", "rights", "reserved"])
        names = names[:cut] + names[cut + 3 :]
        joined = " ".join(names).lower()
    is_year = lambda w: w.isdigit() and len(w) in (2, 4) or w.lower() in ("year", "yyyy", "present")
    dated = bool(names) and (names[0][:4].isdigit() and len(names[0]) >= 4 or names[0].lower().startswith(("year", "yyyy")))
    names = [w for w in names if not is_year(w)]
    says = [w.lower() for w in names]
    if ";" in line.replace("&copy;", ""):
        return False
    said = says[1:] if len(says) <= 3 and says[:1] and says[0] in licenses.NAMES else says
    if set(said) & set(licenses.SAYS):
        return False
    if dated:
        return True
    first = [w for w in says if w not in licenses.JOINS][:1]
    written = all(not w[0].islower() or not w[0].isascii() or w.lower() in licenses.JOINS + licenses.HOLDERS for w in names)
    return bool(set(says) - set(licenses.JOINS)) and written and not set(first) & set(licenses.BODY)


def test_lines_against_a_plain_twin(spark):
    rnd = random.Random(6)
    marks = ["Copyright", "copyright (c)", "(C)", "©", "Copyright ©", "(c) Copyright", "Portions Copyright", "Modifications are copyright (c)", " * Copyright", "Copyright by", "COPYRIGHT", "copyrighted", "A"]
    parts = ["2020", "1999-2001", "Jane", "Doe", "the", "The", "Authors", "notice", "is", "may", "Will", "holders", "must", "of", "Élan", "jquery", "; fee", ".", ",", "All rights reserved", "Software", "and", "X"]
    lines = [" ".join([rnd.choice(marks), *rnd.choices(parts, k=rnd.randint(0, 5))]) for _ in range(4000)] + HEADERS + ADDED + ["all rights reserved.", "", "(c)"]
    lines = [x for x in lines if "@" not in x and "spdx" not in x.lower()]
    df = spark.createDataFrame([(x,) for x in lines], "x string")
    got = [r[0] for r in df.select(licenses.states_copyright(df["x"])).collect()]
    wrong = [(x, g) for x, g in zip(lines, got) if g != plain_holder(x)]
    assert not wrong, wrong[:10]
    assert 500 < sum(got) < len(got) - 500
