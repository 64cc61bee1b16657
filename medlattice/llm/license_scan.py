"""License scan by sentences and ordered rules.

A text is cut into sentences, wrapped ones joined; each is normalised (lower case, spelling, punctuation
and spaces) and mapped to the identifier of a known license sentence. Identifier sequences are then matched against
ordered rules, longest first; what a rule has matched is replaced by its license, so later rules see
only the rest. Sentences that speak of a license but are unknown stay visible as ``unknown``.

All of it is column expressions over one row: no shuffle, no join. Texts without any of ``CUES``
skip the sentence work.

Defined cases: a null or empty text has no sentences and no licenses; a null ``doc_id`` is kept;
repeated rows are scanned each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Wording of published licenses and license notes, normalised, as patterns.
CUES = (
    "licen", "copyright", "permission is hereby", "redistribut", "warrant", "all rights reserved", "public domain", "endorse or promote",
    "no event shall", "cc0", "(c) 19", "(c) 20", "is free software",
)
#: identifiers of ``SPDX-License-Identifier`` notes that are told apart
SPDX_IDS = (
    "Apache-2.0", "MIT", "ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only",
    "GPL-3.0-or-later", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later",
    "MPL-2.0", "EPL-1.0", "EPL-2.0", "BSL-1.0", "Unlicense", "Zlib", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0",
)


def _spdx(name: str) -> tuple[str, str]:
    """Identifier and pattern of the note that names one license."""
    words = re.sub(r"[^a-z0-9]+", " ", name.lower())
    return f"spdx:{name}", f"spdx license identifier {words}"


SENTENCES = (
    *map(_spdx, SPDX_IDS),
    ("spdx", r"spdx license identifier .*"),
    ("apacheGrant", r"((this (file|work|project|software|text|document) is )?licensed|.*licenses this (file|work|project|software) to you) under the apache license,? version 2( 0)?( the license)?"),
    ("apacheUse", r"you may not use this file except in compliance with the license"),
    ("apacheCopy", r"you may obtain a copy of the license at( .*)?"),
    ("apacheAsIs", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis .*"),
    ("apacheSee", r"see the license for the specific language governing permissions and limitations under the license"),
    ("mitGrant", r"((this|the) (file|work|project|software|text|document|code) is )?(released|licensed|distributed) under the (terms of the )?mit license"),
    ("mitPermission", r"permission is hereby granted free of charge to any person obtaining a copy of this software .*"),
    ("mitNotice", r"the above copyright notice and this permission notice shall be included in all copies .*"),
    ("asIs", r"the software is provided as is without warranty of any kind .*"),
    ("noLiability", r"in no event shall the (authors?|copyright|regents|contributors) .*be liable .*"),
    ("bsdGrant", r"(licensed|released|distributed) under the (3 clause |2 clause )?bsd license"),
    ("bsdPermission", r"redistribution and use in source and binary forms with or without modification are permitted provided .*"),
    ("bsdSource", r"redistributions of source code must retain the above copyright notice .*"),
    ("bsdBinary", r"redistributions in binary form must reproduce the above copyright notice .*"),
    ("bsdEndorse", r"neither the name of .* may be used to endorse or promote products .*"),
    ("bsdAsIs", r"this software is provided by .* as is and any express or implied warranties .*"),
    ("gplGrant3", r"(this (file|work|project|software|text|document) is )?licensed under the gnu general public license version 3( or later| only)?"),
    ("gplGrant2", r"(this (file|work|project|software|text|document) is )?licensed under the gnu general public license version 2( or later| only)?"),
    ("gplFree", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license .*"),
    ("agplFree", r"this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license .*"),
    ("lgplFree", r"this (library|program) is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license .*"),
    ("freeSoftware", r"this (program|library|file) is free software"),
    ("gplTerms", r"you can redistribute it and or modify it under the terms of the gnu general public license( .*)?"),
    ("lgplTerms", r"you can redistribute it and or modify it under the terms of the gnu (lesser|library) general public license( .*)?"),
    ("gplVersion2", r"(either )?version 2 of the license( or at your option any later version| only)?"),
    ("lgplVersion21", r"(either )?version 2 1 of the license( or at your option any later version)?"),
    ("gplHope", r"this (program|library) is distributed in the hope that it will be useful but without any warranty( .*)?"),
    ("gplImplied", r"without even the implied warranty of .*"),
    ("gplSee", r"see the gnu (lesser |affero )?general public license for more details"),
    ("gplCopy", r"you should have received a copy of the gnu (lesser |library |affero )?general public license .*"),
    ("gplIfNot", r"if not see (http|https) www gnu org licenses.*"),
    ("lgplGrant", r".*licensed under the gnu lesser general public license.*"),
    ("mplGrant", r"this source code form is subject to the terms of the mozilla public license v( 2 0)?"),
    ("mplCopy", r"if a copy of the mpl was not distributed with this file you can obtain one at .*"),
    ("iscPermission", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that .*"),
    ("iscAsIs", r"the software is provided as is and the author disclaims all warranties .*"),
    ("unlicense", r"this is free and unencumbered software released into the public domain"),
    ("eplGrant", r".*made available under the terms of the eclipse public license( v)?( [12] 0)?( .*)?"),
    ("boostGrant", r"(.*distributed under the )?boost software license version 1 0.*"),
    ("boostPermission", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation .*"),
    ("ccByNc", r"(this (file|work|project|text|document) is )?licensed under (a )?(cc by nc|creative commons attribution noncommercial)( 4 0)?( international)?( license)?"),
    ("ccBySa", r"(this (file|work|project|text|document) is )?licensed under (a )?(cc by sa|creative commons attribution sharealike)( 4 0)?( international)?( license)?"),
    ("ccBy", r"(this (file|work|project|text|document) is )?licensed under (a )?(cc by|creative commons attribution)( 4 0)?( international)?( license)?"),
    ("cc0", r".*(cc0 1 0 universal|dedicated to the public domain).*"),
    ("reserved", r"all rights reserved"),
    ("holder", r"(copyright|c) (c )?[0-9]{4}.*"),
)
#: sentences of one line: what follows on the next line is not part of them
NOTES = ("spdx", "holder", "lgplGrant", "cc0", *[_spdx(name)[0] for name in SPDX_IDS])
#: words that begin a sentence where a line before them has no stop
STARTS = (
    r"copyright[^\p{L}\p{N}\n]*(?:c[^\p{L}\p{N}\n]*)?[0-9]{4}", r"all\s+rights\s+reserved", r"permission\s+is\s+hereby\s+granted",
    r"redistribution\s+and\s+use", r"redistributions\s+(?:of|in)\s", r"the\s+software\s+is\s+provided", r"(?:licensed|released)\s+under\s+the\s",
    r"spdx-license",
)
#: where a sentence ends for certain: a stop, a colon before a line end, a line without letters or digits
#: (but not before the address that completes a sentence), a line end before one of ``STARTS``
_BLANK, _ADDRESS = r"[^\p{L}\p{N}\n]*", r"[^\p{L}\p{N}]{0,80}https?://"
ENDS = r"(?<=[.!?;])\s+|(?<=:)[ \t\r]*\n|\n" + _BLANK + r"\n(?!" + _ADDRESS + r")|\n(?=[^\p{L}\p{N}\n]{0,80}(?i:" + "|".join(STARTS) + "))"
#: license and the identifiers that show it, in order; a rule is tried after all above it
RULES = (
    ("Apache-2.0", ("apacheGrant", "apacheUse", "apacheCopy", "apacheAsIs", "apacheSee")),
    ("BSD-3-Clause", ("bsdPermission", "bsdSource", "bsdBinary", "bsdEndorse", "asIs")),
    ("BSD-3-Clause", ("bsdPermission", "bsdSource", "bsdBinary", "bsdEndorse")),
    ("MIT", ("mitPermission", "mitNotice", "asIs", "noLiability")),
    ("MIT", ("mitPermission", "mitNotice", "asIs")),
    ("GPL", ("gplFree", "gplHope", "gplImplied", "gplSee", "gplCopy", "gplIfNot")),
    ("GPL", ("gplFree", "gplHope", "gplImplied", "gplSee", "gplCopy")),
    ("GPL", ("gplFree", "gplHope", "gplCopy")),
    ("GPL-2.0", ("freeSoftware", "gplTerms", "gplVersion2", "gplHope", "gplImplied", "gplSee", "gplCopy")),
    ("GPL-2.0", ("freeSoftware", "gplTerms", "gplVersion2")),
    ("LGPL-2.1", ("freeSoftware", "lgplTerms", "lgplVersion21", "gplHope", "gplImplied", "gplSee", "gplCopy")),
    ("LGPL-2.1", ("freeSoftware", "lgplTerms", "lgplVersion21")),
    ("AGPL-3.0", ("agplFree", "gplHope", "gplImplied", "gplSee", "gplCopy", "gplIfNot")),
    ("AGPL-3.0", ("agplFree", "gplHope", "gplImplied", "gplSee", "gplCopy")),
    ("LGPL-3.0", ("lgplFree", "gplHope", "gplImplied", "gplSee", "gplCopy")),
    ("ISC", ("iscPermission", "iscAsIs")),
    ("BSL-1.0", ("boostGrant", "boostPermission")),
    ("BSD-2-Clause", ("bsdPermission", "bsdSource", "bsdBinary")),
    ("MIT", ("mitPermission", "mitNotice")),
    ("MPL-2.0", ("mplGrant", "mplCopy")),
    ("Apache-2.0", ("apacheGrant",)),
    ("MIT", ("mitGrant",)),
    ("BSD", ("bsdGrant",)),
    ("GPL-3.0", ("gplGrant3",)),
    ("GPL-2.0", ("gplGrant2",)),
    ("GPL", ("gplFree",)),
    ("LGPL", ("lgplGrant",)),
    ("MPL-2.0", ("mplGrant",)),
    ("CC-BY-NC-4.0", ("ccByNc",)),
    ("CC-BY-SA-4.0", ("ccBySa",)),
    ("CC-BY-4.0", ("ccBy",)),
    ("CC0-1.0", ("cc0",)),
    ("AGPL-3.0", ("agplFree",)),
    ("LGPL-3.0", ("lgplFree",)),
    ("ISC", ("iscPermission",)),
    ("Unlicense", ("unlicense",)),
    ("EPL", ("eplGrant",)),
    ("BSL-1.0", ("boostGrant",)),
    ("BSL-1.0", ("boostPermission",)),
    *[(name, (_spdx(name)[0],)) for name in SPDX_IDS],
    ("SPDX", ("spdx",)),
    ("AllRightsReserved", ("reserved",)),
)


def normalised(sentence: Column) -> Column:
    """Lower case, one spelling of license, letters and digits only, single spaces."""
    low = F.regexp_replace(F.lower(sentence), "licence", "license")
    return F.trim(F.regexp_replace(low, r"[^\p{L}\p{N}]+", " "))


def identifier(sentence: Column) -> Column:
    """Identifier of a normalised sentence, ``unknown`` if no pattern fits."""
    found = F.lit("unknown")
    for name, pattern in reversed(SENTENCES):
        found = F.when(sentence.rlike(f"^({pattern})$"), F.lit(name)).otherwise(found)
    return found


def sentences(text: Column) -> Column:
    """Array of the sentences of a text that hold a cue or are known, normalised, in order.

    A piece of several lines is one sentence if it is known as one, as licenses are published wrapped;
    otherwise, and after a note of one line, each of its lines is one.
    """

    def has(words: tuple[str, ...], part: Column) -> Column:
        low, found = F.lower(part), F.lit(False)
        for word in words:
            found = found | F.contains(low, F.lit(word))
        return found

    def lines(piece: Column) -> Column:
        return F.transform(F.filter(F.split(piece, "\n", -1), lambda line: has(CUES, line)), normalised)

    def whole(piece: Column) -> Column:
        """The piece as one sentence if it has several lines and is known, else its lines."""
        held = F.struct(normalised(piece).alias("all"), lines(piece).alias("lines"), normalised(F.regexp_extract(piece, r"^\s*([^\n]*)", 1)).alias("first"))
        wrapped = lambda x: (identifier(x["all"]) != "unknown") & ~identifier(x["first"]).isin(*NOTES)
        return F.transform(F.array(held), lambda x: F.when(wrapped(x), F.array(x["all"])).otherwise(x["lines"]))[0]

    # cues may be wrapped, so their last words tell which texts to look at
    some = has(tuple(dict.fromkeys(word.split()[-1] if not word.startswith("(c)") else word for word in CUES)), text)
    pieces = F.filter(F.split(text, ENDS, -1), lambda piece: F.contains(piece, F.lit("\n")) | has(CUES, piece))
    found = F.flatten(F.transform(pieces, lambda piece: F.when(F.contains(piece, F.lit("\n")), whole(piece)).otherwise(F.array(normalised(piece)))))
    return F.when(some, found).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, ``sentence_ids``, ``licenses`` (rule names in text order) and ``n_unknown``."""
    ids = docs.select("doc_id", F.transform(sentences(F.coalesce("text", F.lit(""))), identifier).alias("ids"))
    # every identifier stands between bars, so a rule is a run of them; a license is <name>
    trace = F.concat(F.lit("|"), F.array_join(F.transform("ids", lambda i: F.concat(i, F.lit("|"))), "|"))
    for name, wanted in RULES:
        trace = F.replace(trace, F.lit("".join(f"|{i}|" for i in wanted)), F.lit(f"|<{name}>|"))
    marked = ids.select("doc_id", "ids", F.when(F.size("ids") > 0, trace).otherwise(F.lit("")).alias("trace"))
    return marked.select(
        "doc_id", F.array_join("ids", ",").alias("sentence_ids"),
        F.array_join(F.regexp_extract_all("trace", F.lit("<([^>]+)>"), F.lit(1)), ",").alias("licenses"),
        F.size(F.filter("ids", lambda i: i == "unknown")).cast("long").alias("n_unknown"),
    )
