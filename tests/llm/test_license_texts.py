"""Licenses as they are published, with hard-wrapped lines."""

from __future__ import annotations

import pytest

from medlattice.llm import license_scan as l

MIT = """MIT License

Copyright (c) 2021 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD2 = """Copyright (c) 2020, Jane Doe
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES, HOWEVER CAUSED.
"""
ENDORSE = """
3. Neither the name of the University nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
APACHE = """Copyright 2019 Jane Doe

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
GPL = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.

    You should have received a copy of the GNU General Public License
    along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""
GPL2 = """This program is free software; you can redistribute it and/or
modify it under the terms of the GNU General Public License
as published by the Free Software Foundation; either version 2
of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program; if not, write to the Free Software
Foundation, Inc., 51 Franklin Street, Boston, MA 02110-1301, USA.
"""
LGPL21 = GPL2.replace("This program", "This library").replace("General Public License", "Lesser General Public License").replace("version 2\n", "version 2.1\n")
AGPL = GPL.replace("GNU General", "GNU Affero General").replace("GNU\n", "GNU\n").replace("GNU General Public License for", "GNU Affero General Public License for")
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
ISC = """Copyright 2020 Jane Doe

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS.
"""
BOOST = """Distributed under the Boost Software License, Version 1.0.
"""
EPL = """This program and the accompanying materials are made available under the
terms of the Eclipse Public License 2.0 which is available at
https://www.eclipse.org/legal/epl-2.0/
"""
GPL2_IDS = "freeSoftware,gplTerms,gplVersion2,gplHope,gplImplied,gplSee,gplCopy"
APACHE_IDS = "holder,apacheGrant,apacheUse,apacheCopy,apacheAsIs,apacheSee"
BSD_IDS = "holder,reserved,bsdPermission,bsdSource,bsdBinary"


def commented(text: str, mark: str) -> str:
    return "".join(f"{mark} {line}".rstrip() + "\n" for line in text.splitlines())


CASES = [
    (MIT, "unknown,holder,mitPermission,mitNotice,asIs,noLiability", "MIT", 1),
    (BSD2 + BSD_END, f"{BSD_IDS},bsdAsIs,noLiability", "AllRightsReserved,BSD-2-Clause", 0),
    (BSD2 + ENDORSE + BSD_END, f"{BSD_IDS},bsdEndorse,bsdAsIs,noLiability", "AllRightsReserved,BSD-3-Clause", 0),
    (APACHE, APACHE_IDS, "Apache-2.0", 0),
    (commented(APACHE, " *"), APACHE_IDS, "Apache-2.0", 0),
    (commented(APACHE, "#").replace("\n", "\r\n") + "import os\r\n", APACHE_IDS, "Apache-2.0", 0),
    (GPL, "gplFree,gplHope,gplImplied,gplSee,gplCopy,gplIfNot", "GPL", 0),
    (GPL2, GPL2_IDS, "GPL-2.0", 0),
    (commented(GPL2, "#"), GPL2_IDS, "GPL-2.0", 0),
    (LGPL21, "freeSoftware,lgplTerms,lgplVersion21,gplHope,gplImplied,gplSee,gplCopy", "LGPL-2.1", 0),
    (AGPL, "agplFree,gplHope,gplImplied,gplSee,gplCopy,gplIfNot", "AGPL-3.0", 0),
    (ISC, "holder,iscPermission,iscAsIs", "ISC", 0),
    (BOOST, "boostGrant", "BSL-1.0", 0),
    (EPL, "eplGrant", "EPL", 0),
    ("This is free and unencumbered software released into the public domain.", "unlicense", "Unlicense", 0),
    ("// SPDX-License-Identifier: Apache-2.0\nimport x\n", "spdx:Apache-2.0", "Apache-2.0", 0),
    ("/* SPDX-License-Identifier: GPL-2.0-or-later */", "spdx:GPL-2.0-or-later", "GPL-2.0-or-later", 0),
    ("# SPDX-License-Identifier: MIT OR Apache-2.0", "spdx", "SPDX", 0),
    ("Some prose\n" + MIT.split("\n\n", 1)[1] + "More prose", "holder,mitPermission,mitNotice,asIs,noLiability", "MIT", 0),
    ("Neither the name of X nor Y may be used to endorse or promote products of it.", "bsdEndorse", "", 0),
    ("Neither the name of X nor Y may be used to endorse\nor promote products of it.", "bsdEndorse", "", 0),
    ("Copyright 2020 A\nprose on a license\nReleased under the MIT License\nend", "holder,unknown,mitGrant", "MIT", 1),
    ("In no event shall the authors be liable at all.\n(c) 2020 A\nCC0 1.0 Universal", "noLiability,holder,cc0", "CC0-1.0", 0),
]


def test_mozilla_header(spark):
    row = l.scan(spark.createDataFrame([(1, MPL), (2, commented(MPL, "//"))], "doc_id long, text string")).collect()
    assert all(r["sentence_ids"].startswith("mplGrant") and r["licenses"] == "MPL-2.0" for r in row)


@pytest.mark.parametrize("case", CASES)
def test_published_texts(spark, case):
    text, ids, licenses, unknown = case
    row = l.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row["sentence_ids"], row["licenses"], row["n_unknown"]) == (ids, licenses, unknown)
