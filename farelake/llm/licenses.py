"""License scan: canonical digests of whole texts and of single lines, looked up among digests of known licenses."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import without

# Spellings that license matching guidelines treat as equal, British or short form first.
SPELLINGS = [
    ("licence", "license"),
    ("sublicence", "sublicense"),
    ("organisation", "organization"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("favour", "favor"),
    ("behaviour", "behavior"),
    ("fulfil ", "fulfill "),
    ("whilst", "while"),
    ("non commercial", "noncommercial"),
    ("merchantibility", "merchantability"),
    ("copyright holder", "copyright owner"),
    ("https ", "http "),
]

#: A line that only states whose work it is: the word or sign, then a sign, a year, "by" or a placeholder.
COPYRIGHT_LINE = r"^[ \t\r*#/;-]*(copyright|\(c\)|©)[ \t]*(\(c\)|©|[0-9]{4}|by |<|\[).*$"
RIGHTS_LINE = r"^[ \t\r*#/;-]*all rights reserved[. \t\r]*$"

# Public licenses and the notices that name them.
KNOWN = [
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:\nThe above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software.\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, '
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n"
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
        "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at\n"
        "http://www.apache.org/licenses/LICENSE-2.0\nUnless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS '
        "OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
    ),
    (
        "MIT-0",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so.\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, '
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        'hereby granted.\nTHE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS '
        "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
        "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
        "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING "
        "OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:\n"
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.\n"
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution.\n"
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
        "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
        "DAMAGE.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:\n"
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.\n"
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution.\n"
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission.\n"
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
        "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
        "DAMAGE.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software.\n"
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and "
        "to alter it and redistribute it freely, subject to the following restrictions:\n"
        "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
        "software. If you use this software in a product, an acknowledgment in the product documentation would be "
        "appreciated but is not required.\n"
        "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the "
        "original software.\n"
        "3. This notice may not be removed or altered from any source distribution.",
    ),
    (
        "BSL-1.0",
        "Boost Software License - Version 1.0 - August 17th, 2003\n"
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        'and accompanying documentation covered by this license (the "Software") to use, reproduce, display, '
        "distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to "
        "permit third-parties to whom the Software is furnished to do so, all subject to the following:\n"
        "The copyright notices in the Software and this entire statement, including the above license grant, this "
        "restriction and the following disclaimer, must be included in all copies of the Software, in whole or in "
        "part, and all derivative works of the Software, unless such copies or derivative works are solely in the form "
        "of machine-executable object code generated by a source language processor.\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
        "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO "
        "EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
        "THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain.\n"
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source "
        "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\n"
        "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all "
        "copyright interest in the software to the public domain. We make this dedication for the benefit of the "
        "public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt "
        "act of relinquishment in perpetuity of all present and future rights to this software under copyright law.\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
        "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
        "THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
        "SOFTWARE.\nFor more information, please refer to <https://unlicense.org/>",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
]
# The titles that license files open with.
TITLES = {
    "MIT": "MIT License",
    "MIT-0": "MIT No Attribution",
    "ISC": "ISC License",
    "0BSD": "BSD Zero Clause License",
    "BSD-2-Clause": "BSD 2-Clause License",
    "BSD-3-Clause": "BSD 3-Clause License",
    "Zlib": "zlib License",
}


def forms(known: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The texts as they stand, under their titles, and with their conditions numbered or not."""
    out = dict.fromkeys(known)
    for name, text in known:
        if "\n" in text:
            for body in (text, re.sub(r"(?m)^[0-9]\. ", "", text)):
                out[name, body] = None
                if name in TITLES:
                    out[name, f"{TITLES[name]}\n{body}"] = None
    return list(out)

_OUT = ["doc_id", "unit", "line_no", "license", "digest"]


def canonical(text: Column) -> Column:
    """Text in lower case without copyright lines, and with one space for every run of characters that are neither
    letters nor digits; line ends stay. Null gives an empty text."""
    out = F.lower(F.coalesce(text, F.lit("")))
    for line in (COPYRIGHT_LINE, RIGHTS_LINE):
        out = F.regexp_replace(out, "(?md)" + line, "")
    return F.regexp_replace(F.replace(out, F.lit("&"), F.lit(" and ")), r"[^\p{L}\p{N}\n]+", " ")


def spelled(body: Column) -> Column:
    """Canonical text without line ends, with one spelling per word."""
    for variant, usual in SPELLINGS:
        body = F.replace(body, F.lit(variant), F.lit(usual))
    return F.trim(body)


def _whole(canon: Column) -> Column:
    return spelled(F.regexp_replace(canon, r"[ \n]+", " "))


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | DataFrame | None = None) -> DataFrame:
    """(license, digest) of known texts: rows of (license, text), or a table with these columns."""
    if not isinstance(known, DataFrame):
        known = spark.createDataFrame(forms(KNOWN) if known is None else known, "license string, text string")
    digest = F.sha2(_whole(canonical(F.col("text"))), 256)
    empty = F.sha2(F.lit(""), 256)
    return known.select("license", digest.alias("digest")).where(F.col("digest") != empty).distinct()


def scan_licenses(docs: DataFrame, known: DataFrame) -> DataFrame:
    """A row for each document whose entire text, and for each line that, equals a known license after normalising.

    ``docs`` has ``doc_id`` and ``text``; ``known`` is what ``known_digests`` returns. Result: ``doc_id``, ``unit``
    ("text" or "line"), ``line_no`` (from 0; -1 for the text), ``license``, ``digest``. A document of one line is
    reported for both units. Null and empty texts, and lines without a letter or digit, match nothing. Each of several
    equal rows reports its own matches; a digest with two license names gives a row for each. Columns besides
    ``doc_id`` and ``text`` are ignored, whatever their names; an empty table gives no rows.

    The join is on digests alone. Spark broadcasts the known side when its size allows, and otherwise shuffles both
    and splits frequent digests.
    """
    canon = docs.select("doc_id", canonical(F.col("text")).alias("canon"))
    lines = F.transform(
        F.split("canon", "\n"),
        lambda line, n: F.struct(F.lit("line").alias("unit"), n.alias("line_no"), spelled(line).alias("body")),
    )
    whole = F.struct(F.lit("text").alias("unit"), F.lit(-1).alias("line_no"), _whole(F.col("canon")).alias("body"))
    units = canon.select("doc_id", F.explode(F.concat(F.array(whole), lines)).alias("u")).where("u.body <> ''")
    digests = units.select("doc_id", "u.unit", "u.line_no", F.sha2("u.body", 256).alias("digest"))
    return digests.join(without(known, ["doc_id", "unit", "line_no"]), "digest").select(*_OUT)


def license_sql() -> str:
    """DuckDB SQL for the scan of ``documents``."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def canon(column: str) -> str:
        out = f"lower(coalesce({column}, ''))"
        for line in (COPYRIGHT_LINE, RIGHTS_LINE):
            out = f"regexp_replace({out}, {quoted('(?m)' + line)}, '', 'g')"
        return f"regexp_replace(replace({out}, '&', ' and '), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"

    def spell(column: str) -> str:
        for variant, usual in SPELLINGS:
            column = f"replace({column}, {quoted(variant)}, {quoted(usual)})"
        return f"trim({column})"

    def whole(column: str) -> str:
        return spell(f"regexp_replace({column}, '[ \\n]+', ' ', 'g')")

    rows = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in forms(KNOWN))
    return f"""
with known as (
  select distinct license, sha256({whole(canon('body'))}) as digest from (values {rows}) as k(license, body)
), canon as (
  select doc_id, {canon('text')} as canon from documents
), numbered as (
  select doc_id, unnest(string_split(canon, chr(10))) as body,
         unnest(range(len(string_split(canon, chr(10))))) as line_no
  from canon
), units as (
  select doc_id, 'text' as unit, -1 as line_no, {whole('canon')} as body from canon
  union all
  select doc_id, 'line', line_no, {spell('body')} from numbered
)
select u.doc_id, u.unit, cast(u.line_no as integer) as line_no, k.license, k.digest
from units u join known k on sha256(u.body) = k.digest
where u.body <> ''
"""
