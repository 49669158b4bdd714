"""License scans: MinHash bands over overlapping windows retrieve templates, exact containment verifies them.

Texts and templates are sequences of words (runs of a-z and 0-9 after lower-casing) and of their five-word
shingles.  A window is ``WINDOW`` consecutive shingles; windows of a text start every ``STRIDE`` shingles,
those of a template at every one.  Each of ``BANDS`` bands is one minimum under its own permutation.  A
verbatim passage has a window at most one shingle off a template's window, a resemblance of 3/5 or more, so
that some band agrees with probability 1 - 0.4 ** 6 > 0.995; a longer passage has several such windows.
Templates too short for a window are retrieved by their single shingles.  The texts with hits, and those only,
are read again and compared shingle by shingle: a template is reported when a text contains at least 0.8 of
its distinct shingles.  The scan is one generated loop over the windows; no text without a hit is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, semi_join

WORDS = 5
WINDOW = 4
STRIDE = 2
BANDS = 6
#: One constant per band; x -> x xor constant permutes the hashes.
_SALTS = [(0x9E3779B97F4A7C15 * (2 * k + 1) + (1 << 63)) % (1 << 64) - (1 << 63) for k in range(BANDS)]

# Notices by which works declare their license.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC0-1.0": (
        "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights to this work."
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT": "Released under the MIT License",
    "MIT-text": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "GPL-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation; either version 2 of the License, or (at your option) any later version. "
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "LGPL-3.0-header": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. "
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."
    ),
    "AGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. "
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details."
    ),
    "MIT-full": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
        "IN THE SOFTWARE."
    ),
    "ISC-full": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
        "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "BSD-2-Clause-full": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. "
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE '
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE "
        "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
        "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
        "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "BSD-3-Clause-full": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. "
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission. "
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE '
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE "
        "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
        "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
        "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "Zlib-full": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from "
        "the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
        "redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you "
        "wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not "
        "required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. "
        "3. This notice may not be removed or altered from any source distribution."
    ),
    "BSL-1.0-full": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by "
        'this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the '
        "Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software "
        "and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the "
        "Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of "
        "machine-executable object code generated by a source language processor."
    ),
    "Unlicense-full": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this "
        "software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that "
        "recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make "
        "this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of "
        "relinquishment in perpetuity of all present and future rights to this software under copyright law."
    ),
}


def _words(text):
    """The words of a text; the last one is empty if the text doesn't end in a word."""
    return F.split(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "^[^a-z0-9]+", ""), "[^a-z0-9]+")


def _size(words: str):
    """How many words there are: the array may end in an empty one."""
    return F.size(words) - F.when(F.element_at(words, -1) == "", 1).otherwise(0)


def _hash(words, i):
    """The hash of the shingle that starts at the word ``i`` (from 0)."""
    return F.xxhash64(*[F.get(words, i + j) for j in range(WORDS)])


def _shingles(words):
    """The shingles of a short array of words, as texts."""
    n = F.size(words) - WORDS
    return F.when(n >= 0, F.transform(F.sequence(F.lit(0), n), lambda i: F.concat_ws(" ", F.slice(words, i + 1, WORDS)))).otherwise(F.array().cast("array<string>"))


def _bands(hashes: list):
    return [F.least(*[h.bitwiseXOR(F.lit(salt)) for h in hashes]) for salt in _SALTS]


def templates(spark: SparkSession, texts: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """(license, shingles, n) of each template, and (band, value, license) by which windows retrieve them."""
    words = {name: re.findall("[a-z0-9]+", text.lower()) for name, text in texts.items()}
    if any(len(w) < WORDS for w in words.values()):
        raise ValueError(f"a template needs {WORDS} words")
    own = spark.createDataFrame(list(words.items()), "license string, words array<string>")
    own = own.withColumn("shingles", F.array_distinct(_shingles(F.col("words")))).withColumn("n", F.size("shingles"))
    at = own.withColumn("i", F.explode(F.sequence(F.lit(0), F.size("words") - WORDS)))
    hashes = [_hash(F.col("words"), F.col("i") + k) for k in range(WINDOW)]
    long = F.size("words") >= WORDS + WINDOW - 1
    inside = F.col("i") + WORDS + WINDOW - 1 <= F.size("words")
    pairs = [F.struct(F.lit(k).alias("band"), v.alias("value")) for k, v in enumerate(_bands(hashes))]
    windows = at.where(long & inside).select("license", F.explode(F.array(*pairs)).alias("b"))
    singles = at.where(~long).select("license", F.struct(F.lit(-1).alias("band"), hashes[0].alias("value")).alias("b"))
    return own.select("license", "shingles", "n"), windows.unionByName(singles).select("license", "b.band", "b.value").distinct()


def scan(docs: DataFrame, *, texts: Mapping[str, str] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text", least: float = 0.8) -> DataFrame:
    """One row per document and license: doc_id, license, containment, passage (its words from the first to the last window that hit).

    ``containment`` is the share of the template's distinct shingles that a text holds.  Null texts and texts of
    fewer than five words have no licenses.  Rows that share an id are one document, those without an id are
    one too: it has the largest containment of its texts.  An empty table gives no rows; other columns aren't read.
    """
    own, bands = templates(docs.sparkSession, texts)
    rows = bands.collect()  # as many as the templates' windows and bands, as the plan's literals are
    values = {k: [r["value"] for r in rows if r["band"] == k] for k in range(-1, BANDS)}
    bands = docs.sparkSession.createDataFrame(rows, bands.schema)
    docs = docs.select(F.coalesce(F.concat(F.lit("="), F.col(f"`{id_col}`").cast("string")), F.lit("")).alias("key"), F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    long = F.col("n") >= WORDS
    words = docs.select("key", _words(F.col("text")).alias("w")).withColumn("n", _size("w")).where(long)
    # windows that reach beyond the text hold fewer shingles
    at = words.select("key", "w", "n", F.explode(F.sequence(F.lit(0), F.col("n") - WORDS, F.lit(STRIDE))).alias("i"))
    w, i, n = F.col("w"), F.col("i"), F.col("n")
    hashes = [F.when(i + k + WORDS <= n, _hash(w, i + k)) for k in range(WINDOW)]
    # the row number keeps the filter from being pushed below, where each hash would be computed for every test
    hashed = at.select("key", "i", F.monotonically_increasing_id().alias("row"), *[h.alias(f"h{k}") for k, h in enumerate(hashes)])
    found = _bands([F.col(f"h{k}") for k in range(WINDOW)])
    tagged = hashed.select("key", "i", "row", *[f"h{k}" for k in range(STRIDE)], *[v.alias(f"b{k}") for k, v in enumerate(found)])
    listed = lambda c, k: F.expr(f"{c} IN ({', '.join(f'{v}L' if v > -(1 << 63) else '(-9223372036854775807L - 1L)' for v in values[k])})")
    hits = [listed(f"b{k}", k) for k in range(BANDS) if values[k]]
    hits += [listed(f"h{k}", -1) for k in range(STRIDE) if values[-1]]
    window = tagged.where(reduce(lambda a, b: a | b, hits, F.lit(False)) & (F.col("row") >= 0))
    keys = [F.struct(F.lit(k).alias("band"), F.col(f"b{k}").alias("value")) for k in range(BANDS)]
    keys += [F.struct(F.lit(-1).alias("band"), F.col(f"h{k}").alias("value")) for k in range(STRIDE)]
    window = window.select("key", "i", F.explode(F.array(*keys)).alias("b")).select("key", "i", "b.band", "b.value")
    # the templates are parameters of the plan
    maybe = window.join(F.broadcast(bands), ["band", "value"]).groupBy("key", "license").agg(F.min("i").alias("first"), F.max("i").alias("last"))
    maybe = materialise(maybe)
    ids = materialise(maybe.select("key").distinct())
    whole = semi_join(docs, "key", ids).select("key", "doc_id", _words(F.col("text")).alias("w")).withColumn("n", _size("w")).where(long)
    whole = whole.select("key", "doc_id", F.slice("w", F.lit(1), F.col("n")).alias("w"))
    both = whole.join(maybe, "key").join(F.broadcast(own), "license")
    share = F.size(F.array_intersect("shingles", _shingles(F.col("w")))) / F.col("n")
    passage = F.slice("w", F.col("first") + 1, F.col("last") - F.col("first") + STRIDE + WINDOW + WORDS)
    both = both.withColumn("containment", share).where(F.col("containment") >= least).withColumn("passage", passage)
    out = both.groupBy("key", "license").agg(F.first("doc_id").alias("doc_id"), F.max("containment").alias("containment"), F.max_by("passage", F.struct("containment", F.size("passage"), "passage")).alias("passage"))
    return out.select("doc_id", "license", "containment", F.concat_ws(" ", "passage").alias("passage"))
