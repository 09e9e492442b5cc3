"""License scans by canonical digest, in DataFrame functions only.

A text is brought to a canonical form once - lower case, copyright lines emptied, everything but letters and digits a
single space, equivalent spellings made one, line ends kept. The SHA-256 of the entire text, of each entire block of lines
between blank ones, and of each entire line is joined to the digests of known licences: of whole texts, of notices, and
of the paragraphs that one licence alone has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that licence texts use for one another; the left one is read as the right one.
SPELLINGS = {"licence": "license", "licences": "licenses", "licenced": "licensed", "sublicence": "sublicense", "acknowledgement": "acknowledgment", "organisation": "organization", "merchantibility": "merchantability", "holder": "owner", "holders": "owners", "favour": "favor", "v": "version"}
# Whole texts and file headers of licences, paragraphs between blank lines.
TEXTS = {
    '0BSD': (
        'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\n'
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
    ),
    'Apache-2.0': (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\n\n'
        'http://www.apache.org/licenses/LICENSE-2.0\n\n'
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'
    ),
    'BSD-2-Clause': (
        'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n'
        '1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n'
        '2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n'
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
    ),
    'BSD-3-Clause': (
        'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n'
        '1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n'
        '2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n'
        '3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\n'
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
    ),
    'BSL-1.0': (
        'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:\n\n'
        'The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.\n\n'
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
    ),
    'GPL-2.0': (
        'This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.\n\n'
        'This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.\n\n'
        'You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.'
    ),
    'GPL-3.0': (
        'This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.\n\n'
        'This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.\n\n'
        'You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.'
    ),
    'ISC': (
        'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n'
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
    ),
    'MIT': (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\n'
        'The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n'
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
    ),
    'MPL-2.0': (
        'This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.'
    ),
    'Unlicense': (
        'This is free and unencumbered software released into the public domain.\n\n'
        'Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\n\n'
        'In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.\n\n'
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.\n\n'
        'For more information, please refer to <https://unlicense.org/>'
    ),
    'Zlib': (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\n\n"
        'Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:\n\n'
        '1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.\n\n'
        '2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n\n'
        '3. This notice may not be removed or altered from any source distribution.'
    ),
}
# Title lines that whole texts may start with.
TITLES = {"0BSD": ["BSD Zero Clause License"], "BSD-2-Clause": ["BSD 2-Clause License"], "BSD-3-Clause": ["BSD 3-Clause License"], "BSL-1.0": ["Boost Software License - Version 1.0 - August 17th, 2003"], "ISC": ["ISC License"], "MIT": ["MIT License", "The MIT License (MIT)"], "Zlib": ["zlib License"]}
# Notices of one line.
NOTICES = {
    'Apache-2.0': [
        'Licensed under the Apache License, Version 2.0.',
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
        'SPDX-License-Identifier: Apache-2.0',
    ],
    'MIT': [
        'Licensed under the MIT License.',
        'This project is licensed under the terms of the MIT license.',
        'Released under the MIT License.',
        'SPDX-License-Identifier: MIT',
    ],
    'ISC': [
        'SPDX-License-Identifier: ISC',
    ],
    'BSD-2-Clause': [
        'SPDX-License-Identifier: BSD-2-Clause',
    ],
    'BSD-3-Clause': [
        'SPDX-License-Identifier: BSD-3-Clause',
        'Licensed under the BSD 3-Clause License.',
    ],
    'GPL-3.0': [
        'This work is licensed under the GNU General Public License, version 3.',
        'SPDX-License-Identifier: GPL-3.0-only',
        'SPDX-License-Identifier: GPL-3.0-or-later',
    ],
    'GPL-2.0': [
        'This work is licensed under the GNU General Public License, version 2.',
        'SPDX-License-Identifier: GPL-2.0-only',
    ],
    'MPL-2.0': [
        'This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.',
        'SPDX-License-Identifier: MPL-2.0',
    ],
    'CC-BY-4.0': [
        'Licensed under CC BY 4.0.',
        'This work is licensed under a Creative Commons Attribution 4.0 International License.',
    ],
    'CC-BY-NC-4.0': [
        'Licensed under CC BY-NC 4.0.',
        'This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.',
    ],
    'CC-BY-SA-4.0': [
        'Licensed under CC BY-SA 4.0.',
        'This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.',
    ],
    'CC0-1.0': [
        'Dedicated to the public domain under CC0 1.0.',
        'SPDX-License-Identifier: CC0-1.0',
    ],
}
# SHA-256 of the canonical forms of long licence texts as they are commonly installed.
LONG_TEXTS = {
    "Apache-2.0": "95f35d79ea3bab75c250549d6a03cef242e0547d78c99e26fcede49936fb0184",
    "Artistic-1.0": "bc4d0c00d493021b9f3b1041689fa28b4bf980cf2e37601f7cb475a7265e3b93",
    "BSD-3-Clause": "2f8c6e1fbad71537ccf82be397287a98faf8d21ae0d307d8d0201874cbb6705e",
    "CC0-1.0": "0c3e4ca5ed7ced6289d3f5d9a83e4100f9f34d87983b17dc5865376a8a0a98f3",
    "GFDL-1.2": "1bc6bafa55503d8ea18d30ebf13a030199ed831e19af8e28dcbb21453300393e",
    "GFDL-1.3": "c3529026ef52979555f9eb08202968db3ee18b22dd763a8f6e7b591565790fba",
    "GPL-1.0": "ac45842f7794ddb091b364ec443d2fabb216aba9fdcd15eee545d36ca161919f",
    "GPL-2.0": "97528a576c30b3de6309849684162f92ec29612b4775ca4e201c37836127eaf4",
    "GPL-3.0": "cbd0f7d250529c8c1e61fea32aee157cfc943d18865e9b69889337c13b63e14d",
    "LGPL-2.0": "0544cd5e3c9103c496881670cde0a4e9578dc9b9493304a2ce03efff5e943b5e",
    "LGPL-2.1": "108f305f3ba40c920044f3a86a7bba149c60f404a08fc6af6b95b8deb78981b0",
    "LGPL-3.0": "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be",
    "MPL-1.1": "3f0343dd4f3b064be36e0c6584737c9b7bb5c322721694563f9009e088ce96d1",
    "MPL-2.0": "9672a697b80e59f5b1b0201e64d65dee8762b193cdd934dc5bcf2b57350a2ead",
}
# What marks a line as a copyright line.
_COMMENT = r"[\x20\t]*(/\*|\*|#|//|;|--)?[\x20\t]*"
COPYRIGHT_LINES = rf"^{_COMMENT}(copyright|\(c\)|©)[^\n]*[0-9][0-9][0-9][0-9][^\n]*$|^{_COMMENT}all rights reserved[.]?[\x20\t\r]*$"
PART_WORDS = 12  # a paragraph of fewer words is not known on its own
BROADCAST_DIGESTS = 100_000


def canonical(text: Column) -> Column:
    """The canonical form of a text, its lines by single line ends, blank lines kept (copyright lines are blank)."""
    c = F.regexp_replace(F.lower(text), F.lit("(?md)" + COPYRIGHT_LINES), F.lit(""))
    c = F.regexp_replace(c, F.lit(r"[^\p{L}\p{N}\n]+"), F.lit("  "))
    c = F.concat(F.lit(" "), F.replace(c, F.lit("\n"), F.lit(" \n ")), F.lit(" "))
    for word, same in SPELLINGS.items():
        c = F.replace(c, F.lit(f" {word} "), F.lit(f" {same} "))
    return F.trim(F.regexp_replace(F.regexp_replace(c, F.lit(" +"), F.lit(" ")), F.lit(r"\x20?\n\x20?"), F.lit("\n")))


def entire(c: Column) -> Column:
    """A canonical form, or part of one, on one line."""
    return F.trim(F.regexp_replace(c, F.lit(r"\n+"), F.lit(" ")))


def known_licenses(spark: SparkSession, texts: dict[str, list[str]] | None = None) -> DataFrame:
    """(digest, license_id): one row per distinct canonical form. ``texts`` maps ids to texts and notices; by default
    the fixed ones of this module. Paragraphs of ``PART_WORDS`` words or more are known too if one id alone has them."""
    if texts is None:
        whole = {k: [t, *(f"{title}\n\n{t}" for title in TITLES.get(k, []))] for k, t in TEXTS.items()}
        texts = {k: whole.get(k, []) + NOTICES.get(k, []) for k in {*whole, *NOTICES}}
        long = list(LONG_TEXTS.items())
    else:
        long = []
    given = spark.createDataFrame([(k, t) for k, ts in texts.items() for t in ts], "license_id string, text string").select("license_id", canonical(F.col("text")).alias("c"))
    whole = given.select("license_id", F.sha2(entire(F.col("c")), 256).alias("digest"))
    parts = given.select("license_id", F.explode(F.split("c", "\n\n+")).alias("p")).select("license_id", entire(F.col("p")).alias("p")).where(F.size(F.split("p", " ")) >= PART_WORDS)
    alone = parts.groupBy(F.sha2("p", 256).alias("digest")).agg(F.min("license_id").alias("license_id"), F.max("license_id").alias("_other")).where("license_id = _other").select("license_id", "digest")
    fixed = spark.createDataFrame(long, "license_id string, digest string")
    return whole.union(fixed).union(alone).groupBy("digest").agg(F.min("license_id").alias("license_id"))


def license_matches(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, document_digest, whole_license (of the entire text, else null),
    line_licenses array<string> (sorted, distinct: of entire lines and blocks), n_lines_matched and n_blocks_matched
    (blocks of more than one line).

    Null and empty texts have the digest of the empty form and match nothing unless ``known`` holds it. Repeated rows
    each get a row; a null id is kept; digests of ``known`` are unique. Only the two named columns are read, so others
    may have any name; texts of any length are read whole. The canonical form is computed once. ``known`` is broadcast
    only if it has at most ``BROADCAST_DIGESTS`` rows, else joined by a shuffle on the digest; lines and blocks that
    match nothing end at the join, and what is shuffled by row is one digest and its matches.
    """
    listed = F.broadcast(known) if known.limit(BROADCAST_DIGESTS + 1).count() <= BROADCAST_DIGESTS else known
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), canonical(text).alias("c"))
    piece = lambda kind: lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("form"))
    lines = F.filter(F.split("c", "\n+"), lambda x: x != "")
    blocks = F.transform(F.filter(F.split("c", "\n\n+"), lambda x: F.btrim(x, F.lit("\n")).contains("\n")), entire)
    pieces = rows.select("doc_id", "th", F.explode(F.concat(F.array(piece(0)(entire(F.col("c")))), F.transform(blocks, piece(1)), F.transform(lines, piece(2)))).alias("x"))
    met = pieces.select("doc_id", "th", "x.kind", F.sha2("x.form", 256).alias("digest")).join(listed, "digest", "left").where(F.col("license_id").isNotNull() | (F.col("kind") == 0))
    whole, n = F.col("kind") == 0, lambda k: F.count_if((F.col("kind") == k)).alias(f"n{k}")
    by_row = met.groupBy("doc_id", "th").agg(
        F.max(F.when(whole, F.col("digest"))).alias("document_digest"), F.max(F.when(whole, F.col("license_id"))).alias("whole_license"), F.array_sort(F.collect_set(F.when(~whole, F.col("license_id")))).alias("line_licenses"), n(0), n(1), n(2)
    )
    copies = by_row.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("n0"))))
    return copies.select("doc_id", "document_digest", "whole_license", "line_licenses", F.expr("n2 div n0").alias("n_lines_matched"), F.expr("n1 div n0").alias("n_blocks_matched"))
