from __future__ import annotations

import random
import re
import textwrap

from studygraph.llm import licenses, queries
from tests.test_queries import same


def test_matches_sql(spark):
    assert same(spark, queries.QUERIES["op8_license_digests"], queries.ORACLES["op8_license_digests"], "/root/testdata/sf0.01") == 1000


def test_cases(spark):
    docs = spark.createDataFrame(
        [
            (1, "Copyright (c) 2020 Someone\n  RELEASED under the -- MIT Licence!", "x"),
            (2, "released UNDER the mit license", "x"),
            (2, "released UNDER the mit license", "x"),
            (3, None, None),
            (4, "", "x"),
            (5, "word " * 200_000 + "\nLicensed under CC BY 4.0.\nAll rights reserved", "x"),
            (None, "Released under the MIT License, or not", "x"),
        ],
        "doc_id long, text string, digest string",
    )
    got = {(r["doc_id"], r["license_id"], tuple(r["notices"])) for r in licenses.scan_licenses(docs).collect()}
    assert got == {(1, "MIT", ("MIT",)), (2, "MIT", ("MIT",)), (3, None, ()), (4, None, ()), (5, None, ("CC-BY-4.0", "proprietary")), (None, None, ())}
    assert licenses.scan_licenses(docs).count() == 7
    assert licenses.scan_licenses(docs.limit(0)).count() == 0


def test_whole_texts(spark):
    title, mit = licenses.TEXTS["MIT"]
    isc = " ".join(licenses.TEXTS["ISC"][1].split())
    docs = [(1, f"{title}\n\nCopyright (c) 2020 Someone\n\n{mit}"), (2, mit.replace("\n", " ")), (3, "some words\n# " + mit.replace("\n", "\n# ") + "\nmore"), (4, mit.replace("free of charge", "at a price")), (5, "a b c " + "\n".join(isc.split(" the ", 1)) + " d"), (6, "x\nRedistribution " + isc), (7, "All rights reserved.\n" + licenses.TEXTS["BSD-2-Clause"][1]), (8, licenses.TEXTS["BSD-3-Clause"][1])]
    got = {r["doc_id"]: (r["license_id"], r["notices"]) for r in licenses.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string"), licenses.KNOWN).collect()}
    assert got == {1: ("MIT", ["MIT"]), 2: ("MIT", ["MIT"]), 3: (None, ["MIT"]), 4: (None, []), 5: (None, []), 6: (None, ["ISC"]), 7: ("BSD-2-Clause", ["BSD-2-Clause", "proprietary"]), 8: ("BSD-3-Clause", ["BSD-3-Clause"])}


def plain_words(text):
    """A form made without the operator's code: lower case, copyright lines out, words, one spelling."""
    lines = [x for x in text.lower().split("\n") if not re.match(r"\s*copyright.*(\(c\)|\d{4})", x)]
    words = re.findall(r"[^\W_]+", "\n".join(lines))
    respelt = {"licence": "license", "sublicence": "sublicense", "favour": "favor", "recognised": "recognized", "merchantibility": "merchantability"}
    return [respelt.get(w, w) for w in words]


def test_planted_whole_licences(spark):
    rng = random.Random(4)
    known = {k: plain_words(t[1]) for k, t in licenses.TEXTS.items()}
    docs = []
    for i in range(120):
        name = rng.choice(sorted(licenses.TEXTS))
        words = licenses.TEXTS[name][1].split()
        if rng.random() < 0.5:
            words = [{"license": "licence", "License": "LICENCE", "sublicense,": "sublicence,", "MERCHANTABILITY": "Merchantibility"}.get(w, w) for w in words]
        if rng.random() < 0.3:
            words[rng.randrange(len(words))] = "changed"
        width = rng.choice([20, 47, 72, 10_000])
        text = "\n".join(textwrap.wrap(" ".join(words), width, break_long_words=False, break_on_hyphens=False))
        text = rng.choice(["", "Copyright (c) 2020 Some One\n\n", "COPYRIGHT 1999 by X\n"]) + text.replace('"', rng.choice(['"', "''", "\u201c"]))
        docs.append((i, text))
    want = {i: next((k for k in sorted(known) if known[k] == plain_words(t)), None) for i, t in docs}
    got = {r["doc_id"]: r["license_id"] for r in licenses.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string"), licenses.KNOWN).collect()}
    assert got == want and sum(v is not None for v in want.values()) > 60


def test_the_form_does_not_depend_on_line_breaks(spark):
    docs = [(1, "The above copyright notice and this permission notice shall\nbe kept"), (2, "The above\ncopyright notice and this permission notice shall be kept"), (3, "licence licence"), (4, "license license"), (5, "one\n(c) item of a list"), (6, "one")]
    got = {r["doc_id"]: r["digest"] for r in licenses.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[1] == got[2] and got[3] == got[4] and got[5] != got[6]
