"""License scans: sparse TF-IDF cosine of passages to templates, then inheritance by directory.

Every line of a text with a cue of licensing is a passage (lines that follow each other are one, and
long ones are cut into sentences too), and so is every run of words in the paragraphs around a cue (those that follow each other and have
cues) that has the cue's words and a template's length; its TF-IDF vector is compared with the templates', which are statements, headers of
source files, titles, and conditions of license files. The template with the greatest cosine counts; as licenses contain one another, a longer one that fits about as well takes its place if
the passage that fits it has all of its further words (a version, Lesser, a further clause). An SPDX tag names its license or licenses. A
file without a license of its own takes that of the nearest directory above it with a license file.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, written

C = F.col

# Usual statements, headers, titles and conditions of public licenses, by SPDX identifier.
_REDISTRIBUTION = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
_BSD_2 = _REDISTRIBUTION + "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_3 = _BSD_2 + " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_FREE_SOFTWARE = "is free software: you can redistribute it and/or modify it under the terms of the GNU {} General Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
TEMPLATES = [
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-2-Clause", _REDISTRIBUTION),
    ("BSD-2-Clause", _BSD_2),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-3-Clause", _BSD_3),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. CC0 1.0 Universal public domain dedication."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", "This program " + _FREE_SOFTWARE.format("", 2)),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-3.0", "This program " + _FREE_SOFTWARE.format("", 3)),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-2.1", "This library " + _FREE_SOFTWARE.format("Lesser", 2.1)),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "This library " + _FREE_SOFTWARE.format("Lesser", 3)),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("AGPL-3.0", "This program " + _FREE_SOFTWARE.format("Affero", 3)),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software"),
    ("CC-BY-SA-3.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("PostgreSQL", "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies."),
    ("LicenseRef-all-rights-reserved", "All rights reserved."),
]

_CUE = re.compile(r"licen[sc]|permission (?:is|to use)\b|hereby granted|neither the name|rights reserved|public domain|redistribut|free software|spdx|creative commons|\bcc[ -]?(?:by|0)", re.IGNORECASE)
_SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9.\-+() \t]+)", re.IGNORECASE)
_SPDX_NAME = re.compile(r"([A-Za-z0-9.\-]+?)(?:-only|-or-later)?\+?(?![A-Za-z0-9.\-+])", re.IGNORECASE)
#: A line without letters or digits (blank, or a bare comment mark) ends a paragraph.
_BREAK = re.compile(r"\n[^\w\n]*(?=\n)")
_WORD = re.compile(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*")
_SENTENCE = re.compile(r"(?<=[.!?;:])\s+")
LICENSE_FILE = r"(?i)^(?:licen[sc]e|copying|unlicense|notice)(?:[.\-].*)?$"


class Matcher:
    def __init__(self, templates: list[tuple[str, str]] = TEMPLATES, least: float = 0.72):
        self.least = least
        bags = [(name, Counter(_WORD.findall(text.lower()))) for name, text in templates]
        seen = Counter(w for _, bag in bags for w in bag)
        self.idf = {w: math.log((1 + len(bags)) / (1 + n)) + 1 for w, n in seen.items()}
        self.rare = math.log(1 + len(bags)) + 1
        self.by_word: dict[str, list[tuple[int, float]]] = {}
        self.names, self.bags = [name for name, _ in bags], [bag for _, bag in bags]
        self.spdx = {name.lower(): name for name in self.names}
        self.lengths = [bag.total() for _, bag in bags]
        self.longest = max(self.lengths, default=0)
        for k, (_, bag) in enumerate(bags):
            norm = math.sqrt(sum((n * self.idf[w]) ** 2 for w, n in bag.items()))
            for w, n in bag.items():
                self.by_word.setdefault(w, []).append((k, n * self.idf[w] / norm))

    def cosines(self, words: list[str]) -> dict[int, float]:
        """Cosine to each template that has any of the words."""
        bag = Counter(words)
        norm = math.sqrt(sum((n * self.idf.get(w, self.rare)) ** 2 for w, n in bag.items()))
        sums: dict[int, float] = {}
        for w, n in bag.items():
            for k, x in self.by_word.get(w, ()):
                sums[k] = sums.get(k, 0.0) + n * self.idf[w] * x
        return {k: s / norm for k, s in sums.items()}

    def passages(self, text: str) -> Iterator[str]:
        """Lines with a cue, and runs of them; of long ones also the sentences with a cue."""
        at, run = None, []
        for found in _CUE.finditer(text):
            if at is not None and found.start() < at[1]:
                continue
            begin = text.rfind("\n", 0, found.start()) + 1
            end = text.find("\n", found.start())
            end = len(text) if end < 0 else end
            if run and begin > at[1] + 1:
                yield from self._pieces(run)
                run = []
            run.append(text[begin:end])
            at = (begin, end)
        if run:
            yield from self._pieces(run)

    def _pieces(self, run: list[str]) -> Iterator[str]:
        yield from run
        if len(run) > 1:
            yield "\n".join(run)
        for line in run:
            if len(line) > 120:
                yield from (s for s in _SENTENCE.split(line) if _CUE.search(s))

    def stretches(self, text: str) -> Iterator[tuple[list[str], int, int]]:
        """Words around cues, within paragraphs with cues and a template's length, with the places of the first and last word of a cue."""
        breaks = [(m.start(), m.end()) for m in _BREAK.finditer(text)]
        spans = list(zip([0, *(e for _, e in breaks)], [*(b for b, _ in breaks), len(text)], strict=True))
        cues = [(m.start(), m.end()) for m in _CUE.finditer(text)]
        own = [bisect_right(spans, (begin, len(text) + 1)) - 1 for begin, _ in cues]
        at, starts, words = -1, [], []
        for (begin, end), k in zip(cues, own, strict=True):
            if k > at:  # the run of paragraphs with cues that begins here
                at = k
                for other in own:
                    at += other == at + 1
                low = spans[k][0]
                found = [(m.start() + low, m.group()) for m in _WORD.finditer(text[low : spans[at][1]].lower())]
                starts, words = [x for x, _ in found], [w for _, w in found]
            first = max(bisect_right(starts, begin) - 1, 0)
            last = max(bisect_left(starts, end) - 1, first)
            left = max(0, last + 1 - self.longest)
            yield words[left : first + self.longest], first - left, last - left

    def slid(self, words: list[str], first: int, last: int) -> Iterator[tuple[int, float, list[str]]]:
        """(template, cosine, window) of the best of the windows of a template's length that have the words first..last, where it may be `least`."""
        idf = np.array([self.idf.get(w, self.rare) for w in words])
        weights = np.zeros((len(self.lengths), len(words) + 1))
        for i, w in enumerate(words):
            for k, x in self.by_word.get(w, ()):
                weights[k, i + 1] = idf[i] * x
        dots, norms = weights.cumsum(1), np.concatenate([[0.0], (idf**2).cumsum()])
        for k, n in enumerate(self.lengths):
            n = min(n, len(words))
            a = np.arange(max(0, last + 1 - n), min(first, len(words) - n) + 1)
            if not len(a):
                continue
            # repeated words only lengthen a vector, so this is not less than the cosine
            most = (dots[k, a + n] - dots[k, a]) / np.sqrt(norms[a + n] - norms[a])
            best, window = 0.0, []
            for i in np.argsort(-most).tolist():
                if most[i] < max(best, self.least) - 1e-9:
                    break
                x = self.cosines(words[a[i] : a[i] + n]).get(k, 0.0)
                if x > best:
                    best, window = x, words[a[i] : a[i] + n]
            if best:
                yield k, best, window

    def fits(self, text: str) -> dict[int, tuple[float, list[str]]]:
        """The best cosine of a passage of the text to each template, with the passage's words; of those below `least` not all."""
        found: dict[int, tuple[float, list[str]]] = {}

        def add(k: int, x: float, words: list[str]) -> None:
            if x > found.get(k, (0.0,))[0]:
                found[k] = x, words

        for passage in self.passages(text):
            words = _WORD.findall(passage.lower())
            for k, x in self.cosines(words).items():
                add(k, x, words)
        for words, first, last in self.stretches(text):
            for k, x, window in self.slid(words, first, last):
                add(k, x, window)
        return found

    def scores(self, text: str) -> dict[int, float]:
        return {k: x for k, (x, _) in self.fits(text).items()}

    def tagged(self, text: str) -> str | None:
        """The licenses of SPDX tags that are known: of a tag with several all, joined as it joins them; of several tags the last by name."""
        named = []
        for expression in _SPDX.findall(text):
            parts = [x for x in _SPDX_NAME.findall(re.split(r"\s+WITH\s", expression, flags=re.IGNORECASE)[0]) if x]
            joints = {x.upper() for x in parts if x.upper() in ("OR", "AND")}
            known = [self.spdx.get(x.lower()) for x in parts if x.upper() not in ("OR", "AND")]
            if not joints:
                known = known[:1]
            if known and (None not in known or len(joints) != 1):
                known = sorted({x for x in known if x})
                if known:
                    named.append(f" {joints.pop()} ".join(known) if len(joints) == 1 else known[-1])
        return max(named, default=None)

    def best(self, text: str | None) -> tuple[str | None, float]:
        """License and cosine of the template that fits best; the license is null below `least`.

        That is the one of greatest cosine, of equal ones the longest, then the last by name; or the longest of the longer ones within 0.05 of it all of whose words that it
        has more are in the passage that fits it.
        """
        text = text or ""
        if not _CUE.search(text):
            return None, 0.0
        if tag := self.tagged(text):
            return tag, 1.0
        found = self.fits(text)
        top = max(found, key=lambda k: (round(found[k][0], 9), self.lengths[k], self.names[k]), default=None)
        if top is None or found[top][0] < self.least - 1e-9:
            return None, found[top][0] if top is not None else 0.0
        least = max(found[top][0] - 0.05, self.least - 1e-9)
        held = [k for k, (x, words) in found.items() if x >= least and self.lengths[k] > self.lengths[top] and not (self.bags[k] - self.bags[top]) - Counter(words)]
        k = max(held, key=lambda k: (self.lengths[k], found[k][0], self.names[k]), default=top)
        return self.names[k], min(found[k][0], 1.0)


RESULTS = ("own_license", "own_score", "license", "origin", "inherited")


def own_licenses(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, least: float = 0.72) -> DataFrame:
    """files (path, text and others) without text, with own_license and own_score. Whole texts are read; a null or empty text has none.

    Input columns with the names of RESULTS give way; others may have any name.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(templates, least)
        for batch in slices(batches):
            found = [matcher.best(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], names=["_row", "own_license", "own_score"])

    rest = [c for c in files.columns if c not in ("text", *RESULTS)]
    held = files.select(C("text").cast("string").alias("text"), F.struct(*[C(f"`{c}`") for c in rest]).alias("_row"))
    kind = T.StructType([held.schema["_row"], T.StructField("own_license", T.StringType()), T.StructField("own_score", T.DoubleType())])
    return held.mapInArrow(run, kind).select("_row.*", "own_license", "own_score")


def inherited(scanned: DataFrame) -> DataFrame:
    """Adds license (own or inherited), origin (the path it comes from) and inherited to scanned (path, own_license, own_score and others), which is read three times.

    Directories are resolved once each, not file by file; a directory's license file with the best score counts,
    then the first path. A null path has no directory. Repeated rows get equal results. Files of one large directory meet one row in a join that AQE can split.
    """
    files = scanned.select(F.struct("*").alias("_row"), C("path").alias("_path"), C("own_license").alias("_own"), C("own_score").alias("_score"), F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("_folder"))
    name = F.element_at(F.split("_path", "/"), -1)
    given = files.filter(name.rlike(LICENSE_FILE) & C("_own").isNotNull())
    given = given.groupBy(C("_folder").alias("_at")).agg(F.min_by(F.struct(C("_own").alias("license"), C("_path").alias("origin")), F.struct(-C("_score"), "_path")).alias("_given"))
    folders = files.select("_folder").filter(C("_folder").isNotNull()).distinct()
    pieces = F.split("_folder", "/")
    up = folders.withColumn("_depth", F.explode(F.sequence(F.lit(0), F.size(pieces)))).withColumn("_above", F.array_join(F.slice(pieces, F.lit(1), C("_depth")), "/"))
    near = up.join(given, C("_above") == C("_at")).groupBy(C("_folder").alias("_of")).agg(F.max_by("_given", "_depth").alias("_near"))
    out = files.join(near, C("_folder") == C("_of"), "left")
    own = C("_own").isNotNull()
    return out.select(
        *[C("_row")[c].alias(c) for c in scanned.columns], F.coalesce("_own", "_near.license").alias("license"),
        F.when(own, C("_path")).otherwise(C("_near.origin")).alias("origin"), (~own & C("_near").isNotNull()).alias("inherited"),
    )


def scan(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, least: float = 0.72) -> DataFrame:
    """files (path, text and others) without text, with own_license, own_score, license, origin and inherited: own_licenses(), then inherited().

    A row for each row of files: texts are read once, what is found in them is written. Null or empty texts have no license of their own but may
    inherit one; repeated rows get equal results; an empty table gives no rows.
    """
    return inherited(written(own_licenses(files, templates, least)))


def as_tree(docs: DataFrame) -> DataFrame:
    """doc_id, path, text: documents laid out as a tree: source / thousand / fifty; each thousandth and each fiftieth document is its directory's license file.

    A null source is the directory `none`; a null doc_id has a null path; rows that share a doc_id share a path.
    """
    i = C("doc_id")
    thousand, fifty = F.floor(i / 1000).cast("string"), F.floor(i / 50).cast("string")
    source = F.coalesce("source", F.lit("none"))
    inner = F.when(i % 1000 == 0, F.concat_ws("/", source, thousand, F.lit("LICENSE"))).when(i % 50 == 0, F.concat_ws("/", source, thousand, fifty, F.lit("LICENSE")))
    path = F.when(i.isNotNull(), inner.otherwise(F.concat_ws("/", source, thousand, fifty, F.concat(i.cast("string"), F.lit(".txt")))))
    return docs.select("doc_id", path.alias("path"), "text")
