"""Licence scan: sparse TF-IDF cosine of headers and licence files to templates, then inheritance along directories.

DataFrame functions only. A file with a cue word gives its header candidates (lines with a cue, their sentences, and the
paragraphs, in which a wrapped text is whole) and itself as a whole; each is a vector of its terms. Document frequencies of
the templates' terms are counted over all files; a term off the templates weighs what one weighs that no file holds, and
is a dimension of its own. A file that is like a template as a whole is its directory's licence file.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

#: SPDX id to texts that state the licence; fixed values. Each id's tag is a template, too.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction",
        "MIT License Copyright (c) Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        'and associated documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    ],
    "LGPL-3.0": ["licensed under the GNU Lesser General Public License, version 3"],
    "AGPL-3.0": ["licensed under the GNU Affero General Public License, version 3"],
    "GPL-2.0": [
        "licensed under the GNU General Public License, version 2",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or any later version.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
        "Licensed under the BSD 3-Clause License.",
        "Copyright (c) All rights reserved. Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above "
        "copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior written "
        'permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
        "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
        "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS "
        "OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
        "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
        "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License. CC BY 4.0"],
    "CC-BY-SA-4.0": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License. CC BY-SA 4.0"],
    "CC-BY-NC-4.0": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License. CC BY-NC 4.0",
        "licensed under CC BY-NC 4.0",
    ],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright: Creative Commons CC0 1.0 Universal public domain"],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "
        '"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
        "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "Proprietary": ["Copyright. All rights reserved."],
}
CUE = r"(?i)licen[cs]|copyright|spdx|all rights reserved|redistribut|public domain|permission|creative commons|free software"
SPLIT = r"[^\p{L}\p{N}.]+|\.(?![\p{N}])"
#: Where a line's sentences end, and where paragraphs are parted.
SENTENCE, PARAGRAPH = r"([.;!?])[ \t]+", r"\n[ \t\r]*\n"


def tagged(templates: dict[str, list[str]]) -> dict[str, list[str]]:
    """Templates with the SPDX tag of each licence."""
    return {k: [*v] if k == "Proprietary" else [*v, f"SPDX-License-Identifier: {k}"] for k, v in templates.items()}


def terms(text: Column) -> Column:
    """Lower-case words of a text; version numbers stay whole."""
    return F.filter(F.split(F.lower(text), SPLIT), lambda w: w != "")


def cue_of(templates: dict[str, list[str]]) -> str:
    """CUE, and for each template that it does not match the template's own longest words, three or fewer."""
    own = {w for texts in templates.values() for t in texts if not re.search(CUE, t) for w in sorted(set(re.findall(r"[^\W_]+", t.lower())), key=lambda w: (-len(w), w))[:3]}
    return "|".join([CUE, *(f"(?U)\\b{w}\\b" for w in sorted(own))])


def candidates(text: Column, cue: str = CUE) -> Column:
    """The header candidates of a text."""
    cued = lambda parts: F.filter(parts, lambda x: x.rlike(cue))
    lines = cued(F.split(text, r"\n"))
    sentences = F.flatten(F.transform(lines, lambda x: F.split(F.regexp_replace(x, SENTENCE, "$1\n"), r"\n")))
    return F.array_distinct(F.concat(lines, cued(sentences), cued(F.split(text, PARAGRAPH))))


def _template_rows(df: DataFrame, templates: dict[str, list[str]]) -> DataFrame:
    rows = [(name, k, t) for name, texts in templates.items() for k, t in enumerate(texts)]
    return df.sparkSession.createDataFrame(rows, "license string, variant int, template string")


def scan_licenses(files: DataFrame, least: float = 0.7, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """path, own license with its score and number of header lines, and the license it has or inherits, with whence.

    files: path (`/` parts directories), text. Null and empty texts have no headers and may only inherit. A file that as a
    whole has a cosine of `least` or more to a template is the licence file of its directory; of several, the best score
    counts, then the first id by name. A file without own license takes the one of its nearest ancestor directory with a
    licence file. Rows with one path are scanned apart: each that has a license counts for the path, the best first, and
    they inherit alike. The texts are read twice: for the document frequencies, and for the candidates. A candidate holds a
    cue: an English word of licences (CUE), or one of the longest words of a given template without such (`cue_of`). A
    licence in another language is found by templates in that language.
    """
    templates = TEMPLATES if templates is None else templates
    cue, shown = cue_of(templates), _template_rows(files, tagged(templates))
    shown = shown.select("license", "variant", terms(F.col("template")).alias("ts"))
    known = shown.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ts")))).alias("v")).first()["v"]  # the terms of the given templates
    listed = F.array(*[F.lit(w) for w in known])
    # one row a known term and file, and an empty one for the file itself: as many counts as there are known terms
    held = files.select(F.explode(F.array_union(F.array(F.lit("")), F.array_intersect(F.coalesce(F.split(F.lower("text"), SPLIT), F.array()), listed))).alias("w"))
    counts = {r["w"]: r["n"] for r in held.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = counts.get("", 0)
    foreign = 1 + math.log(n + 1)
    idf = {w: 1 + math.log((n + 1) / (counts.get(w, 0) + 1)) for w in known}
    weights = F.broadcast(files.sparkSession.createDataFrame(list(idf.items()), "w string, idf double"))

    def vectors(texts: DataFrame, keys: list[str]) -> DataFrame:
        """keys, w and x of texts (keys, ts: terms): a row a term."""
        counted = texts.select(*keys, F.explode("ts").alias("w")).groupBy(*keys, "w").agg(F.count(F.lit(1)).alias("tf"))
        return counted.join(weights, "w", "left").select(*keys, "w", (F.col("tf") * F.coalesce("idf", F.lit(foreign))).alias("x"))

    t = checkpointed(vectors(shown, ["license", "variant"]).withColumnRenamed("x", "tx"))
    tnorm = t.groupBy("license", "variant").agg(F.sqrt(F.sum(F.col("tx") * F.col("tx"))).alias("tnorm"))
    # of the texts, only what has a cue goes on
    cued = files.where(F.col("text").rlike(cue)).select("path", "text")
    whole = F.struct(F.lit(True).alias("whole"), F.col("text").alias("unit"))
    units = F.concat(F.array(whole), F.transform(candidates(F.col("text"), cue), lambda x: F.struct(F.lit(False).alias("whole"), x.alias("unit"))))
    n_headers = F.size(F.filter(F.split("text", r"\n"), lambda x: x.rlike(cue)))
    held = cued.select(F.monotonically_increasing_id().alias("row"), "path", n_headers.alias("n_headers"), F.explode(units).alias("u")).select("row", "path", "n_headers", "u.*")
    h = checkpointed(held.withColumn("key", F.md5("unit")))  # the row ids must stay as they are
    v = checkpointed(vectors(h.select("key", terms(F.col("unit")).alias("ts")).dropDuplicates(["key"]), ["key"]))  # the same header stands in many files
    norm = v.groupBy("key").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    dots = v.join(F.broadcast(t), "w").groupBy("key", "license", "variant").agg(F.sum(F.col("x") * F.col("tx")).alias("d"))
    cosine = dots.join(F.broadcast(tnorm), ["license", "variant"]).join(norm, "key").select("key", "license", F.round(F.col("d") / (F.col("norm") * F.col("tnorm")), 6).alias("score"))
    order = F.struct((-F.col("score")).alias("neg"), "license")
    best = cosine.groupBy("key").agg(F.min(order).alias("b"))
    scored = h.join(best, "key").select("row", "path", "n_headers", "whole", "b.license", (-F.col("b.neg")).alias("score")).where(F.col("score") >= least)
    own = scored.groupBy("row", "path", "n_headers").agg(F.min(order).alias("b"), F.min(F.when(F.col("whole"), order)).alias("file"))

    directory = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    of_dir = own.where("file is not null").groupBy(directory.alias("dir")).agg(F.min("file").alias("b")).select("dir", F.col("b.license").alias("dir_license"))
    dirs = files.select(directory.alias("home")).distinct()
    parts = F.split("home", "/")
    up = dirs.select("home", F.explode(F.sequence(F.lit(1), F.size(parts))).alias("depth")).withColumn("dir", F.array_join(F.slice(F.split("home", "/"), F.lit(1), F.col("depth")), "/"))
    nearest = up.join(of_dir, "dir").groupBy("home").agg(F.max(F.struct("depth", "dir", "dir_license")).alias("m")).select("home", F.col("m.dir").alias("dir"), "m.dir_license")
    own = own.groupBy("path").agg(F.min(F.struct(F.col("b.neg").alias("neg"), F.col("b.license").alias("own_license"), "n_headers")).alias("b")).select("path", "b.own_license", (-F.col("b.neg")).alias("score"), "b.n_headers")
    out = files.select("path", directory.alias("home")).join(own, "path", "left").join(nearest, "home", "left")
    license_ = F.coalesce("own_license", "dir_license")
    return out.select("path", "own_license", "score", F.coalesce("n_headers", F.lit(0)).alias("n_headers"), license_.alias("license"), F.when(F.col("own_license").isNotNull(), F.lit("own")).when(F.col("dir_license").isNotNull(), F.concat(F.lit("dir:"), "dir")).alias("whence"))
