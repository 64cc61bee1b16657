from __future__ import annotations

import re

import pytest

from llm_fixtures import awkward, nothing, small, small_docs  # noqa: F401
from medlattice.llm import license_scan as l

MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and so on.\n"
    "The above copyright notice and this permission notice shall be included in all copies of it.\n"
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, express or implied.\n'
)
CASES = [
    ("Text.\nReleased under the MIT License.\nMore.", "mitGrant", "MIT", 0),
    ("Licensed under the Apache License, Version 2.0.", "apacheGrant", "Apache-2.0", 0),
    ("This work is LICENCED? no. This work is licensed under the GNU General Public License, version 3.", "unknown,gplGrant3", "GPL-3.0", 1),
    ("Licensed under CC BY-NC 4.0. All rights reserved.", "ccByNc,reserved", "CC-BY-NC-4.0,AllRightsReserved", 0),
    ("Copyright 2020 A\n" + MIT, "holder,mitPermission,mitNotice,asIs", "MIT", 0),
    (MIT + "Released under the MIT License.", "mitPermission,mitNotice,asIs,mitGrant", "MIT,MIT", 0),
    ("Our license is odd.", "unknown", "", 1),
    ("Nothing here at all.", "", "", 0),
    ("A tale of the as isle. With warranty? Nobody knew.", "unknown", "", 1),
]


@pytest.mark.parametrize("case", CASES)
def test_cases(spark, case):
    text, ids, licenses, unknown = case
    row = l.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row["sentence_ids"], row["licenses"], row["n_unknown"]) == (ids, licenses, unknown)


def brute(text: str | None):
    ids = []
    for sentence in re.split(r"\n|(?<=[.!?;])\s+", text or ""):
        if any(cue in sentence.lower() for cue in l.CUES):
            norm = re.sub(r"[\W_]+", " ", sentence.lower().replace("licence", "license")).strip()
            ids.append(next((n for n, p in l.SENTENCES if re.fullmatch(p, norm)), "unknown"))
    found, taken = [], [False] * len(ids)
    for name, wanted in l.RULES:
        i = 0
        while i + len(wanted) <= len(ids):
            if tuple(ids[i : i + len(wanted)]) == wanted and not any(taken[i : i + len(wanted)]):
                taken[i : i + len(wanted)] = [True] * len(wanted)
                found.append((i, name))
                i += len(wanted)
            else:
                i += 1
    return ",".join(ids), ",".join(n for _, n in sorted(found)), ids.count("unknown")


def test_supplied_texts(small, small_docs):
    got = {r["doc_id"]: (r["sentence_ids"], r["licenses"], r["n_unknown"]) for r in l.scan(small_docs).collect()}
    assert got == {i: brute(t) for i, t, _ in small}
    assert any(x[1] for x in got.values())


def test_awkward_and_empty(awkward, nothing):
    assert l.scan(awkward).count() == awkward.count() and l.scan(nothing).count() == 0
    assert {r["licenses"] for r in l.scan(awkward).collect()} == {""}
