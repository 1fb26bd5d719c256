"""License scans by canonical digests of whole texts.

A text is brought to a canonical form: lower case, equivalent spellings made one, marks and runs of
blanks reduced to single spaces, copyright lines left out. Its SHA-256 is joined by equality to the digests of
known texts, brought to the same form. A document is looked up whole, and so is every paragraph and
every line of it, each as a text of its own: a notice inside a document is found only if the paragraph
or line is the notice and nothing else.

Only DataFrame operations. Known digests are sent to all tasks up to a number that is checked. Few paragraphs and lines can be a known
text: only those with one of a few words, chosen so that every known text has one of them, get a digest.

Defined cases: null and empty texts, and texts that are empty in canonical form, match nothing. Rows with equal id and
text give one row with their number. Null ids are ids like any other. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bind, bound

#: Equivalent spellings, applied in order to lower-case text.
SPELLINGS = [
    ("licence", "license"), ("sub-license", "sublicense"), ("licensor's", "licensors"), ("merchantibility", "merchantability"),
    ("non-commercial", "noncommercial"), ("non-infringement", "noninfringement"), ("favour", "favor"), ("organisation", "organization"),
    ("acknowledgement", "acknowledgment"), ("per cent", "percent"), ("while", "whilst"), ("https://", "http://"), ("(c)", "copyright"),
    ("©", "copyright"),
]
#: Lines that begin with "copyright" or a sign and have a year or "all rights reserved", or that begin with both word and sign.
COPYRIGHT_LINE = (
    r"(?m)^[\s#*/;-]*(copyright|\(c\)|©)[^\n]*(\d{4}|all rights reserved)[^\n]*$|^[\s#*/;-]*copyright\s*(\(c\)|©)[^\n]*$"
    r"|^[\s#*/;-]*all rights reserved\.?\s*$"
)
#: Known digests that may be sent to every task, 20 MB of them.
BROADCAST_DIGESTS = 200_000

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS
BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS
ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE
LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""
APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to
in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either
express or implied. See the License for the specific language governing permissions and limitations under the License."""
BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the distribution. """
BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived
from this software without specific prior written permission. """
BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,
sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by
any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in
the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and
successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software
under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR
THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to <https://unlicense.org>"""
MPL_HEADER = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with
this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
#: The header paragraphs of the GNU licenses: "{}" stands for the license's name, "{} {}" for name and version.
GNU_HEADER = """This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free
Software Foundation, either version {version} of the License, or (at your option) any later version. This program is distributed in the hope
that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
See the {name} for more details."""
GNU_COPY = "You should have received a copy of the {name} along with this program. If not, see <https://www.gnu.org/licenses/>."
GNU = {
    "GPL-2.0": ("GNU General Public License", 2), "GPL-3.0": ("GNU General Public License", 3), "LGPL-3.0": ("GNU Lesser General Public License", 3),
    "AGPL-3.0": ("GNU Affero General Public License", 3),
}


def _gnu(name: str, version: int) -> list[str]:
    """The header as one text with and without its last paragraph, and its first two paragraphs each."""
    header = GNU_HEADER.format(name=name, version=version)
    return [f"{header} {GNU_COPY.format(name=name)}", header, header[: header.index("This program is distributed")]]


#: Fixed texts: license and its full text or usual header.
FULL_TEXTS = {
    "MIT": [MIT, "MIT License " + MIT, "The MIT License (MIT) " + MIT, "The MIT License " + MIT], "ISC": [ISC, "ISC License " + ISC], "Apache-2.0": [APACHE_HEADER],
    "BSD-2-Clause": [title + BSD_START + BSD_END for title in ("", "BSD 2-Clause License ")],
    "BSD-3-Clause": [title + BSD_START + BSD_THIRD + BSD_END for title in ("", "BSD 3-Clause License ")],
    "Unlicense": [UNLICENSE, UNLICENSE.split(" For more information")[0]], "MPL-2.0": [MPL_HEADER],
} | {license: _gnu(*call) for license, call in GNU.items()}
#: Names by which notices call a license.
NAMES = {
    "MIT": ["MIT License", "MIT", "Expat License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0 License", "Apache-2.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL version 2", "GPLv2", "GPL-2.0"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL version 3", "GPLv3", "GPL-3.0"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "LGPLv3", "LGPL-3.0"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "AGPLv3", "AGPL-3.0"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL-2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License", "BSD-2-Clause"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License", "Modified BSD License", "BSD-3-Clause"],
    "ISC": ["ISC License", "ISC"],
    "Unlicense": ["Unlicense"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal", "CC0-1.0"],
}
for _name in GNU:
    NAMES[_name] += [f"{_name}-only", f"{_name}-or-later", f"{_name}+"]
NAMES |= {
    f"CC-{kind}-{version}": [f"CC {kind} {version}", f"CC-{kind}-{version}", f"Creative Commons {kind} {version}", f"Creative Commons {title} {version} International License"]
    for kind, title in {
        "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-NC": "Attribution-NonCommercial",
        "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
    }.items()
    for version in ("3.0", "4.0")
}
#: Notices: "{}" stands for a name.
NOTICES = [
    "Licensed under {}", "Licensed under the {}", "Released under {}", "Released under the {}", "Distributed under {}", "Distributed under the {}",
    "Published under the {}", "Available under the {}", "This work is licensed under {}", "This work is licensed under the {}", "This work is licensed under a {}",
    "This software is licensed under the {}", "This project is licensed under the {}", "This file is licensed under the {}",
    "This code is released under the {}", "License: {}", "SPDX-License-Identifier: {}",
]


def known_texts() -> list[tuple[str, str]]:
    """(license, text) for all full texts and notices."""
    notices = [(name, notice.format(call)) for name, calls in NAMES.items() for call in calls for notice in NOTICES]
    return [(name, text) for name, texts in FULL_TEXTS.items() for text in texts] + notices


def canonical(text: Column) -> Column:
    text = F.lower(text)
    lines = F.when(text.contains("copyright") | text.contains("(c)") | text.contains("©") | text.contains("rights"), F.regexp_replace(text, COPYRIGHT_LINE, " ")).otherwise(text)
    for old, new in SPELLINGS:
        lines = F.replace(lines, F.lit(old), F.lit(new))
    return F.trim(F.regexp_replace(lines, r"[^\p{L}\p{N}]+", " "))


def digest(text: Column) -> Column:
    """The digest of the canonical form, null if that is empty."""
    form = canonical(text)
    return F.when(form != "", F.sha2(form, 256))


def known_digests(spark: SparkSession, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """(digest, license) of the known texts."""
    rows = spark.createDataFrame(texts if texts is not None else known_texts(), "license string, text string")
    return rows.select(digest(F.col("text")).alias("digest"), "license").where("digest is not null").groupBy("digest").agg(F.min("license").alias("license"))


def anchors(texts: list[tuple[str, str]]) -> list[str]:
    """Words such that every text of a known license's form holds one of them, whatever its spelling.

    A word that no replacement of spellings touches stands in every text of that form; so does the shared beginning of "license" and
    "licence". Words that most texts share are taken first, the longer the better.
    """
    touched = {run for _, new in SPELLINGS for run in re.findall(r"[^\W_]+", new)}
    held: list[set[str]] = []
    for _, text in texts:
        lines = [line for line in text.lower().split("\n") if "copyright" not in line and "rights reserved" not in line]
        found = re.findall(r"[^\W_]+", " ".join(lines)) or re.findall(r"[^\W_]+", text.lower())
        plain = {w for w in found if not any(w in t or t in w for t in touched)}
        held.append(plain | ({"licen"} if any("license" in w or "licence" in w for w in found) else set()))
    if not all(held):
        return [""]  # a text of touched words alone: all units are looked up
    chosen, left = [], held
    while left:
        counts = Counter(w for words in left for w in words)
        best = max(counts, key=lambda w: (counts[w], len(w), w))
        chosen.append(best)
        left = [words for words in left if best not in words]
    return chosen


def _units(text: Column, words: list[str]) -> Column:
    """Paragraphs and lines that hold one of the words."""
    parts = F.array_union(F.split(text, r"\n[\t ]*\n"), F.split(text, "\n"))
    if "" in words:
        return parts

    def able(part: Column) -> Column:
        return bind(F.lower(part), lambda lower: reduce(lambda a, b: a | b, [lower.contains(w) for w in words]))

    return F.filter(parts, able)


def scan(docs: DataFrame, known: DataFrame, words: list[str] | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, digest of the whole text, license of the whole text, licenses of its parts, number of
    matching parts, number of equal rows.

    `known` has a digest and a license, each digest once; `words` are the `anchors` of the known texts, without which every paragraph and line is looked up.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_t"))
    units = bound(rows, ["doc_id", "_t"], _parts=_units(F.col("_t"), [""] if words is None else words))
    whole = bound(units, ["doc_id", "_parts"], digest=digest(F.col("_t")), text_digest=F.sha2("_t", 256))
    parts = whole.select(
        "doc_id", "text_digest", "digest",
        F.posexplode(F.concat(F.array(F.lit("")), F.col("_parts"))).alias("place", "part"),
    )
    looked = parts.select("doc_id", "text_digest", "digest", "place", F.when(F.col("place") == 0, F.col("digest")).otherwise(digest(F.col("part"))).alias("sought"))
    sought = known.select(F.col("digest").alias("sought"), "license")
    few = known.limit(BROADCAST_DIGESTS + 1).count() <= BROADCAST_DIGESTS
    named = looked.join(F.broadcast(sought) if few else sought, "sought", "left")
    part = F.when(F.col("place") > 0, F.col("license"))
    return named.groupBy("doc_id", "text_digest", "digest").agg(
        F.max(F.when(F.col("place") == 0, F.col("license"))).alias("license"),
        F.array_sort(F.collect_set(part)).alias("part_licenses"),
        F.count(part).alias("n_parts"),
        F.count(F.when(F.col("place") == 0, 1)).alias("n_rows"),
    )
