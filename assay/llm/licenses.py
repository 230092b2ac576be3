"""License texts found by MinHash bands over overlapping windows, verified by shingle containment.

Templates are grouped by size. A group has windows of ``width`` shingles at every ``stride``, chosen so
that an occurrence at any place lies wholly inside a window and fills at least a fixed share of it.
A band is one MinHash value; a window and a template are compared when any of ``BANDS`` values agree,
which ``miss_probability`` bounds, and match if the window holds the given share of the template's
shingles.

A window can agree with a template in a band only if it holds the shingle that gives the template its
minimum there. So documents are first joined with these few shingles (templates * BANDS at most) and
only windows around such a shingle are made: the same candidates, without hashing every window.

Only DataFrame expressions are used. What is broadcast is bounded by the templates, a parameter.

Edge cases: null, empty and short texts hold no shingle and match nothing; a template shorter than a
shingle is refused; repeated rows give repeated results only as often as (doc_id, text) differ.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm.common import keep, text_key
from assay.llm.words import alnum_words, ngram_hashes

SHINGLE = 5
BANDS = 32
CONTAINMENT = 0.8

# Notices as their licenses word them.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "GPL-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."
    ),
    "LGPL-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version."
    ),
    "AGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version."
    ),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "EPL-2.0-header": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"
    ),
    "CC0-1.0-header": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring "
        "rights to this software to the public domain worldwide. This software is distributed without any warranty."
    ),
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MIT": "Released under the MIT License.",
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE "
        "SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
        "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "Zlib-text": (
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
        "software for any purpose, including commercial applications, and to alter it and redistribute it freely, "
        "subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not "
        "claim that you wrote the original software. If you use this software in a product, an acknowledgment in the "
        "product documentation would be appreciated but is not required. 2. Altered source versions must be plainly "
        "marked as such, and must not be misrepresented as being the original software. 3. This notice may not be "
        "removed or altered from any source distribution."
    ),
    "Unlicense-text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright "
        "laws, the author or authors of this software dedicate any and all copyright interest in the software to the "
        "public domain. We make this dedication for the benefit of the public at large and to the detriment of our "
        "heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all "
        "present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED AS IS, WITHOUT "
        "WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "MIT-whole": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The "
        "above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
        "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
        "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN "
        "AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
        "OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "BSD-3-Clause-whole": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS "
        "OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS "
        "FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR "
        "ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
        "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
        "DAMAGE."
    ),
    "BSL-1.0-text": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        "and accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, "
        "execute, and transmit the Software, and to prepare derivative works of the Software, and to permit "
        "third-parties to whom the Software is furnished to do so"
    ),
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "BSD-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}


@dataclass(frozen=True)
class Windows:
    """Templates of more than ``width`` / 2 and at most ``width`` shingles share these windows."""

    width: int

    @property
    def stride(self) -> int:
        return max(1, self.width // 4)

    @property
    def span(self) -> int:
        """Shingles of a window: ``width`` from any start lie inside the window at or before it."""
        return self.width + self.stride - 1


def windows_for(shingles: int) -> Windows:
    return Windows(1 << max(0, shingles - 1).bit_length())


def miss_probability(shingles: int, containment: float = CONTAINMENT, bands: int = BANDS) -> float:
    """Chance that no band agrees for an occurrence that holds ``containment`` of the template."""
    shared = containment * shingles
    return (1 - shared / (windows_for(shingles).span + shingles - shared)) ** bands


def seeds() -> list[int]:
    source = random.Random(20240131)
    return [source.getrandbits(63) for _ in range(BANDS)]


def least(shingles: str, seed: int) -> Column:
    """The smallest place of any shingle (a 64-bit hash) in the order of a band."""
    return F.array_min(F.transform(shingles, lambda s: s.bitwiseXOR(F.lit(seed))))


def templates(spark: SparkSession, notices: dict[str, str]) -> DataFrame:
    """(license_id, shingles, n, width, stride, span): distinct shingle hashes and windows."""
    rows = F.array(*[F.struct(F.lit(k).alias("license_id"), F.lit(v).alias("text")) for k, v in notices.items()])
    held = spark.range(1).select(F.inline(rows)).withColumn("words", alnum_words("text"))
    held = held.select("license_id", F.array_distinct(ngram_hashes("words", SHINGLE)).alias("shingles"))
    held = held.withColumn("n", F.size("shingles"))
    short = [r["license_id"] for r in held.filter("n = 0").select("license_id").collect()]  # of the parameter
    if short:
        raise ValueError(f"templates shorter than {SHINGLE} words: {short}")
    width = F.pow(F.lit(2.0), F.ceil(F.log2("n"))).cast("int")
    held = held.withColumn("width", width).withColumn("stride", F.greatest(F.lit(1), F.expr("width div 4")).cast("int"))
    return held.withColumn("span", F.col("width") + F.col("stride") - 1)


def scan(docs: DataFrame, notices: dict[str, str] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, license_id, containment, n_windows, first_word): templates found in each document.

    containment is the largest share of the template's shingles in any window, n_windows how many windows
    match and first_word where the first of them starts.
    """
    known = keep(templates(docs.sparkSession, notices or NOTICES), "license-templates")
    order = seeds()
    values = F.array(*[least("shingles", c) for c in order])
    bands = known.select("license_id", "shingles", "n", "width", "stride", "span", F.posexplode(values).alias("band", "value"))
    # the shingle behind a minimum: exclusive or with the seed undoes itself
    original = item_of(order, "band").bitwiseXOR(F.col("value"))
    anchors = bands.select(original.alias("shingle"), "width", "stride", "span").distinct()

    keyed = docs.select("doc_id", text_key().alias("_th"), alnum_words("text").alias("words")).filter(
        F.size("words") >= SHINGLE
    )
    hashed = keyed.select("doc_id", "_th", ngram_hashes("words", SHINGLE).alias("hashes"))
    spots = hashed.select("doc_id", "_th", "hashes", F.posexplode_outer("hashes").alias("at", "shingle"))
    spots = spots.join(F.broadcast(anchors), "shingle")
    first = F.expr("greatest(0, (at - span + stride) div stride) * stride")
    start = F.explode(F.sequence(first, F.expr("at div stride * stride"), F.col("stride"))).alias("start")
    around = spots.select("doc_id", "_th", "width", "span", "hashes", start)
    window = F.slice("hashes", F.col("start") + 1, F.col("span")).alias("window")
    windows = around.select("doc_id", "_th", "width", "start", window).distinct()
    values = F.array(*[least("window", c) for c in order])
    banded = windows.select("doc_id", "_th", "width", "start", "window", F.posexplode_outer(values).alias("band", "value"))
    agreed = banded.join(F.broadcast(bands.select("license_id", "shingles", "n", "width", "band", "value")), ["width", "band", "value"])
    shared = F.size(F.array_intersect("shingles", "window")) / F.col("n")
    candidates = agreed.select("doc_id", "_th", "license_id", "start", shared.alias("share")).distinct()
    return (
        candidates.filter(F.col("share") >= containment)
        .groupBy("doc_id", "_th", "license_id")
        .agg(F.max("share").alias("containment"), F.count("*").alias("n_windows"), F.min("start").alias("first_word"))
        .select("doc_id", "license_id", "containment", "n_windows", F.col("first_word").cast("long").alias("first_word"))
    )


def item_of(values: list[int], at: str) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.col(at) + 1)


