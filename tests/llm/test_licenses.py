"""Licences by plain code, full texts of licences, headers, and files that declare."""

from __future__ import annotations

import math
import os
from collections import Counter

import pandas as pd
import pytest
import regex

from batchgate.llm import licence_texts, licenses

SMALL = "/root/testdata/sf0.001"
SYSTEM = "/usr/share/common-licenses"
FULL = {
    "Apache-2.0": "Apache-2.0", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0",
    "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0",
}
TEXT = {name: text for name, text in licence_texts.TEXTS}


def plain(texts, templates=licence_texts.TEMPLATES, least=0.7):
    """The best licence, its cosine, and whether a first unit declares, for each text, unit by unit."""
    bags = [(name, Counter(regex.findall(licenses.TERM, t.lower()))) for name, t in templates]
    n = len(bags)
    among = Counter(t for _, bag in bags for t in bag)
    weight = {t: math.log((1 + n) / (1 + c)) + 1 for t, c in among.items()}
    unknown = math.log(1 + n) + 1
    norms = [math.sqrt(sum(c * weight[t] ** 2 for t, c in bag.items())) for _, bag in bags]
    seen, out = {}, {}
    for key, text in texts:
        found = []
        for parts in (text.split("\n"), regex.split(licenses.BLOCK, text), regex.split(licenses.PARAGRAPH, text), [text]):
            for at, part in enumerate(parts):
                if part not in seen:
                    bag = Counter(regex.findall(licenses.TERM, part.lower()))
                    size = math.sqrt(sum(c * weight.get(t, unknown) ** 2 for t, c in bag.items()))
                    seen[part] = [
                        (-round(sum(math.sqrt(c * bag[t]) * weight[t] ** 2 for t, c in held.items() if t in bag) / size / norm, 6), name)
                        for (name, held), norm in zip(bags, norms, strict=True)
                        if len(held.keys() & bag.keys()) > 1
                    ] if size else []
                found += [(c, name, at == 0) for c, name in seen[part] if -c >= least]
        if found:
            best = min(f[:2] for f in found)
            out[key] = (best[1], -best[0], any(f[2] for f in found))
    return out


def owned(llm, texts):
    rows = licenses.own_licences(llm.createDataFrame(texts, "doc_id long, text string")).collect()
    return {r.id: (r.license, r.cosine, r.declares) for r in rows}


def test_bounds_lose_no_unit(llm):
    docs = pd.read_parquet(f"{SMALL}/documents.parquet")
    texts = [(int(d), t) for d, t in zip(docs.doc_id, docs.text, strict=True) if t is not None]
    for i, (_, t) in enumerate(licence_texts.TEMPLATES):
        cut = t.split()
        texts += [
            (100_000 + i, f"# {t}\n\nimport os\nprint('the software')"),
            (200_000 + i, " ".join(cut[: max(1, 2 * len(cut) // 3)])),
            (300_000 + i, f"{t} with some words that say more about the works and their use in the year 2021"),
            (400_000 + i, "first line\n\n" + " ".join(f"{a} {a}" for a in cut)),
        ]
    want = plain(texts)
    got = owned(llm, texts)
    assert len(want) > 150
    assert {k: (v[0], v[2]) for k, v in got.items()} == {k: (v[0], v[2]) for k, v in want.items()}
    assert all(abs(got[k][1] - want[k][1]) < 2e-6 for k in want)


def test_templates_are_told_apart(llm):
    got = owned(llm, [(i, t) for i, (_, t) in enumerate(licence_texts.TEMPLATES)])
    assert {i: got[i][0] for i in got} == {i: name for i, (name, _) in enumerate(licence_texts.TEMPLATES)}


@pytest.mark.skipif(not os.path.isdir(SYSTEM), reason="no licence texts on this machine")
def test_full_texts(llm):
    texts = {}
    for name in FULL:
        with open(os.path.join(SYSTEM, name), encoding="utf-8") as f:
            texts[name] = f.read()
    rows = [(i, f"{i}/LICENSE", t) for i, t in enumerate(texts.values())]
    rows += [(100 + i, f"{i}/src/main.c", "") for i in range(len(texts))]
    files = llm.createDataFrame(rows, "doc_id long, path string, text string")
    got = {r.id: r.license for r in licenses.scan(files).collect()}
    assert {name: got[i] for i, name in enumerate(texts)} == FULL
    assert {name: got[100 + i] for i, name in enumerate(texts)} == FULL


def test_headers_tags_and_licence_files(llm):
    mit = "\n\nCopyright (c) 2019 A. Person\n\n" + licence_texts.TEXTS[3][1].replace("\nTHE SOFTWARE", "\n\nTHE SOFTWARE")
    gpl = dict(licence_texts.TEMPLATES[-len(licence_texts.TEXTS) - 10 : -len(licence_texts.TEXTS)])["GPL-3.0"]
    boxed = "/*\n * part of a tool\n *\n" + "".join(f" * {x}\n" for x in gpl.split("\n")) + " *\n */\nint main() { return 0; }\n"
    rows = [
        (1, "a/LICENSE", mit),
        (2, "a/x/y.py", "import os\n"),
        (3, "b/m.py", "# SPDX-License-Identifier: MIT\nimport os\n"),
        (4, "c/COPYING", "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n\nEveryone is permitted to copy"),
        (5, "c/d/e.c", "int x;"),
        (6, "f/g.c", boxed),
        (7, "h/NOTICE.txt", "This product\nholds parts of others.\n\n" + TEXT["Apache-2.0"]),
        (8, "h/i/j.rs", ""),
        (9, "k/z.js", "/* first */\n\n/* Copyright 2020\n\n" + TEXT["BSD-2-Clause"] + " */\nlet x = 1;\n"),
        (10, "k/w.js", "let y = 2;"),
        (11, "l/m.go", "// SPDX-License-Identifier: LGPL-2.1-or-later\n"),
        (12, "n/o.txt", "The license of a driver is public; its version is 2.0 and the terms are free."),
        (13, "p/q.txt", "// SPDX-License-Identifier: Zlib"),
        (14, "r/s.txt", "er kam\nmit\n\nmit\n\nihr"),
    ]
    files = llm.createDataFrame(rows, "doc_id long, path string, text string")
    got = {r.id: (r.license, r.origin, r.license_dir) for r in licenses.scan(files).collect()}
    assert got == {
        1: ("MIT", "own", None),
        2: ("MIT", "inherited", "a"),
        3: ("MIT", "own", None),
        4: ("GPL-3.0", "own", None),
        5: ("GPL-3.0", "inherited", "c"),
        6: ("GPL-3.0", "own", None),
        7: ("Apache-2.0", "own", None),
        8: ("Apache-2.0", "inherited", "h"),
        9: ("BSD-2-Clause", "own", None),
        10: ("BSD-2-Clause", "inherited", "k"),  # k/z.js is, as a whole, little else than the licence
        11: ("LGPL-2.1", "own", None),
        12: (None, "none", None),
        13: (None, "none", None),
        14: (None, "none", None),
    }


def test_a_text_of_many_blank_and_unlettered_lines(llm):
    text = "-\n" * 200_000 + "Released under the MIT License.\n" + "\n" * 200_000 + "." * 200_000
    assert owned(llm, [(1, text)])[1][0] == "MIT"
