import random
import re
from collections import Counter

from assayer.llm import licenses as N
from assayer.llm.licenses import TEMPLATES, Templates, scan, scanned

from .conftest import edge_rows


def brute_words(text):
    out = []
    for line in text.split("\n"):
        if not re.match(r"\s*(?:copyright\b|\(c\)|©)", line, re.IGNORECASE):
            out += re.findall(r"[^\W_]+(?:[.-][^\W_]+)*", line.lower())
    return out


def dice(a, b):
    a, b = Counter(zip(a, a[1:])), Counter(zip(b, b[1:]))
    return 2 * sum((a & b).values()) / (a.total() + b.total()) if a and b else 0.0


def brute(text):
    """All units and windows against all templates; then the matches by their order, windows only where no word is taken."""
    lines = (text or "").split("\n")
    words, line_of = [], []
    for i, line in enumerate(lines):
        words += brute_words(line)
        line_of += [i] * (len(words) - len(line_of))

    def span(a, b):
        own = [k for k, i in enumerate(line_of) if a <= i < b]
        return (own[0], own[-1] + 1) if own else (0, 0)

    units = [("line", i, *span(i, i + 1)) for i in range(len(lines))]
    if len(lines) > 1:
        units.append(("text", 0, 0, len(words)))
        begin = 0
        for i in range(len(lines) + 1):
            if i == len(lines) or not brute_words(lines[i]):
                if 1 < i - begin < len(lines):
                    units.append(("paragraph", begin, *span(begin, i)))
                begin = i + 1
    hits = []
    for kind, at, a, b in units:
        own = []
        for name, template in FLAT:
            if b - a > 1 and (d := dice(words[a:b], template)) >= N.THRESHOLD and N.marks(words[a:b]) == N.marks(template):
                own.append((-d, 1 - len(template), 0, name, a, b, kind, at))
        hits += sorted(own)[:1]
    present = set(zip(words, words[1:]))
    for name, template in FLAT:
        pairs, last = set(zip(template, template[1:])), len(words) - len(template)
        if sum(p in present for p in zip(template, template[1:])) < N.THRESHOLD * (len(template) - 1):
            continue  # no window can share enough
        for a in range(last + 1):
            b = a + len(template)
            if (a == last or (words[a], words[a + 1]) in pairs) and (d := dice(words[a:b], template)) >= N.THRESHOLD:
                if N.marks(words[a:b]) == N.marks(template):
                    hits.append((-d, 1 - len(template), 1, name, a, b, "window", line_of[a]))
    out, taken = [], set()
    for d, size, window, name, a, b, kind, at in sorted(hits):
        if not (window and taken & set(range(a, b))):
            taken |= set(range(a, b))
            out.append((-d, -size, name, kind, at))
    return out


FLAT = [(name, brute_words(text)) for name, texts in TEMPLATES.items() for text in texts]


def test_documents(documents, texts):
    templates, found = Templates(TEMPLATES), 0
    for text in texts.values():
        hits = scan(text, templates)
        assert hits == brute(text)
        found += bool(hits)
    assert found
    rows = {r["doc_id"]: r for r in scanned(documents).collect()}
    assert rows.keys() == texts.keys()
    notices = ("Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.", "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.")
    for d, text in texts.items():
        with_notice = any(n in text.split("\n") for n in notices)
        assert (rows[d]["license"] is not None) == with_notice and (not with_notice or rows[d]["dice"] == 1.0)


def test_templates_find_themselves_in_any_dress():
    templates = Templates(TEMPLATES)
    for name, texts in TEMPLATES.items():
        for text in texts:
            dressed = "Copyright (c) 2020 Someone\n\n" + re.sub(r"\s+", "  ", text).upper()
            assert {h[2] for h in scan(dressed, templates)} == {name}


def test_licences_within_longer_texts_and_lines():
    templates = Templates(TEMPLATES)
    prose = "A story about a river and the people who lived beside it for years. "
    for name, texts in TEMPLATES.items():
        for text in texts:
            for whole in (
                f"{prose * 9}\n\n{text}\n\n{prose * 30}",  # between paragraphs
                f"{prose * 3}{text} {prose * 4}".replace("\n", " "),  # within a line
                f"{prose}{text}",  # at the end
                f"{prose * 2}{text} {prose * 2}".replace(", ", ",\n"),  # over many lines
            ):
                hits = scan(whole, templates)
                assert {h[2] for h in hits} == {name} and hits[0][0] == 1.0, (whole, hits)
                assert hits == brute(whole)
    two = f"{prose}Released under the MIT License. {prose}\n{prose}Licensed under CC BY 4.0. {prose}"
    assert [(h[2], h[3], h[4]) for h in scan(two, templates)] == [("CC-BY-4.0", "window", 1), ("MIT", "window", 0)]
    near = f"{prose}\n\nDistributed under the Apache License, Version 2.0."
    assert [(h[2], h[3]) for h in scan(near, templates)] == [("Apache-2.0", "line")]
    near = f"{prose}Distributed under the Apache License, Version 2.0."
    assert [(h[2], h[3], h[0]) for h in scan(near, templates)] == [("Apache-2.0", "window", 5 / 6)]
    assert scan(f"{prose}Licensed under the GNU General Public License, version 1. {prose}", templates) == []


def test_windows_against_brute_force():
    """Mixed and broken licences, repeated words, copies side by side."""
    draw = random.Random(3)
    templates, words = Templates(TEMPLATES), sorted({w for _, t in FLAT for w in t})
    for _ in range(150):
        parts = []
        for _ in range(draw.randrange(1, 6)):
            part = list(draw.choice(FLAT)[1]) if draw.random() < 0.7 else draw.choices(words, k=draw.randrange(20))
            for _ in range(draw.randrange(4)):
                if part:
                    part[draw.randrange(len(part))] = draw.choice(words)
            parts.append(" ".join(part[draw.choice((0, 0, 1, 5)) :]))
        text = "".join(p + draw.choice((" ", "\n", "\n\n", ". ")) for p in parts)
        assert scan(text, templates) == brute(text)


def test_near_texts_and_bounds():
    templates = Templates(TEMPLATES)
    mit = TEMPLATES["MIT"][2]
    words = mit.split()
    words[3], words[20] = "changed", "other"
    assert {h[2] for h in scan(" ".join(words), templates)} == {"MIT"}
    assert scan("Permission is hereby granted, free of charge, to nobody at all", templates) == []
    size = templates.sizes[3]
    reach = templates.candidates(size)
    assert 3 in reach and all(0.8 * (size + templates.sizes[i]) <= 2 * min(size, templates.sizes[i]) + 1e-9 for i in reach)


def test_edge_rows(edge, nothing):
    rows = scanned(edge).collect()
    assert len(rows) == len(edge_rows()) and all(r["license"] is None and r["licenses"] is None for r in rows)
    assert scanned(nothing).collect() == []


def test_ties_and_lists(spark):
    text = "Released under the MIT License.\nx\nLicensed under CC BY 4.0.\nReleased under the MIT License."
    row = scanned(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert (row["license"], row["dice"], row["unit"], row["line"], row["licenses"]) == ("CC-BY-4.0", 1.0, "line", 2, "CC-BY-4.0,MIT")


def test_one_licence_for_one_notice(spark):
    """Versions and variants do not fall onto their neighbours, known or not."""
    gnu = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."
    work = "This work is licensed under a Creative Commons Attribution-{} 4.0 International License."
    cases = [
        ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
        ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
        ("This work is licensed under the GNU General Public License, version 1.", None),
        (gnu.format("General Public License", 2), "GPL-2.0"),
        (gnu.format("General Public License", 3), "GPL-3.0"),
        (gnu.format("Affero General Public License", 3), "AGPL-3.0"),
        (gnu.format("Lesser General Public License", 2.1).replace("program", "library"), "LGPL-2.1"),
        (gnu.format("Lesser General Public License", 3), "LGPL-3.0"),
        (work.format("NoDerivatives"), "CC-BY-ND-4.0"),
        (work.format("NonCommercial-ShareAlike"), "CC-BY-NC-SA-4.0"),
        ("This work is licensed under a Creative Commons Attribution 3.0 International License.", None),
    ]
    rows = scanned(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id bigint, text string")).collect()
    assert [(r["license"], r["licenses"]) for r in sorted(rows, key=lambda r: r["doc_id"])] == [(n, n) for _, n in cases]


def test_each_template_is_its_own_best():
    templates = Templates(TEMPLATES)
    for name, texts in TEMPLATES.items():
        for text in texts:
            assert templates.best(brute_words(text))[2] == name
