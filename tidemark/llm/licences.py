"""License scans: Dice coefficient over word bigrams against licence templates.

A text is normalised to words (small letters, runs of letters and digits) and its bigrams are looked up among the
bigrams of all templates. Around the hits, word windows are compared with a template by the Dice coefficient of their
sets of distinct bigrams, ``2 |A & B| / (|A| + |B|)``. A window can reach the threshold t only if its size is between
``|B| t / (2 - t)`` and ``|B| (2 - t) / t`` and it shares at least ``|B| t / (2 - t)`` bigrams: templates without that
many hits are never scored, nor are windows of more words than the upper bound.

Neighbouring versions and variants are templates of their own, and a window counts for one of them only if it holds the
words that tell it from the others (``TOLD_BY``). Templates that contain another one (a whole text its header, say) are
searched before it, so that an edit in the rest of a text does not leave the part alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from heapq import heapify, heappop, heappush
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import out_batch, prefix_hash, small, span_hashes, utf8

THRESHOLD = 0.8

# Wording of common licence notices and texts.
TEMPLATES: dict[str, str] = {
    "MIT notice": "Released under the MIT License.",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.""",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.""",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public
License for more details.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

_DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_GNU = """This program is free software{sep} you can redistribute it and/or modify it under the terms of the GNU {name}
as published by the Free Software Foundation{comma} either version {version} of the License, or (at your option) any later
version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."""


def _gnu(name: str, version: str) -> str:
    return _GNU.format(name=f"{name}General Public License", version=version, sep=";", comma=";")


TEMPLATES |= {
    "ISC text": TEMPLATES["ISC"] + """
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    "BSD-2-Clause text": TEMPLATES["BSD-2-Clause"] + _DISCLAIMER,
    "BSD-3-Clause": (_BSD_3 := TEMPLATES["BSD-2-Clause"] + """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission."""),
    "BSD-3-Clause text": _BSD_3 + _DISCLAIMER,
    "GPL-2.0 notice": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-2.1 notice": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0 notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0 notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "GPL-2.0": _gnu("", "2"),
    "LGPL-2.0": _gnu("Library ", "2"),
    "LGPL-2.1": _gnu("Lesser ", "2.1"),
    "LGPL-3.0": _gnu("Lesser ", "3"),
    "AGPL-3.0": _gnu("Affero ", "3"),
    "CC-BY-ND-4.0 notice": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0 notice": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0 notice": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC0-1.0": """To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring
rights to this software to the public domain worldwide. This software is distributed without any warranty.""",
    "Unlicense text": TEMPLATES["Unlicense"] + """
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as
a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all
present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
}
TEMPLATES |= {
    "0BSD text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted.""" + TEMPLATES["ISC text"].removeprefix(TEMPLATES["ISC"]),
    "Zlib text": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you
use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "BSL-1.0 notice": "Distributed under the Boost Software License, Version 1.0.",
    "BSL-1.0 text": """Boost Software License - Version 1.0 - August 17th, 2003
Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and
transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is
furnished to do so, all subject to the following:
The copyright notices in the Software and this entire statement, including the above license grant, this restriction and
the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of
the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by
a source language processor.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT
HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
}

# Identifiers of the public licence list that are looked for behind "SPDX-License-Identifier:".
SPDX_IDS = (
    "0BSD", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause",
    "BSD-3-Clause-Clear", "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-NC-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-ND-4.0",
    "CC-BY-SA-4.0", "CC0-1.0", "EPL-1.0", "EPL-2.0", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only",
    "GPL-3.0-or-later", "ISC", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only",
    "LGPL-3.0-or-later", "MIT", "MIT-0", "MPL-2.0", "Unlicense", "Zlib")
# How one-line notices name a licence (behind "licensed under the").
NAMED_AS: dict[str, tuple[str, ...]] = {
    "MIT": ("MIT License",),
    "Apache-2.0": ("Apache 2.0 License", "Apache License 2.0", "Apache License v2.0", "Apache License, Version 2.0"),
    "BSD": ("BSD License",),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License"),
    "ISC": ("ISC License",),
    "Zlib": ("zlib License",),
    "BSL-1.0": ("Boost Software License 1.0",),
    "Unlicense": ("Unlicense License",),
    "MPL-2.0": ("Mozilla Public License 2.0", "Mozilla Public License v2.0", "MPL 2.0"),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License v2.0", "EPL 2.0"),
    "Artistic-2.0": ("Artistic License 2.0",),
    "GPL-2.0": ("GPLv2", "GPL v2", "GNU GPL v2", "GNU GPLv2", "GNU General Public License v2.0"),
    "GPL-3.0": ("GPLv3", "GPL v3", "GNU GPL v3", "GNU GPLv3", "GNU General Public License v3.0"),
    "LGPL-2.1": ("LGPL v2.1", "GNU LGPL v2.1", "GNU Lesser General Public License v2.1"),
    "LGPL-3.0": ("LGPLv3", "LGPL v3", "GNU LGPL v3", "GNU Lesser General Public License v3.0"),
    "AGPL-3.0": ("AGPLv3", "AGPL v3", "GNU AGPL v3", "GNU Affero General Public License v3.0"),
}
TEMPLATES |= {f"{x} SPDX": f"SPDX-License-Identifier: {x}" for x in SPDX_IDS}
_ONE_LINE = {f"{x} notice, {name}": (f"Licensed under the {name}", f"the {name}")
             for x, names in NAMED_AS.items() for name in names}
_ONE_LINE = {k: v for k, v in _ONE_LINE.items() if v[0] + "." not in TEMPLATES.values()}
TEMPLATES |= {k: text for k, (text, _) in _ONE_LINE.items()}
# Whole texts of the longer licences.
TEMPLATES |= {f"{x.stem} text": x.read_text(encoding="utf-8")
              for x in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))}

# Words (pairs of neighbours among them) that a window must hold to count for a template.
TOLD_BY: dict[str, str] = {
    "MIT notice": "the MIT", "MIT": "this permission notice", "ISC": "above copyright notice", "ISC text": "above copyright notice",
    "BSD-3-Clause": "neither the name", "BSD-3-Clause text": "neither the name",
    "Apache-2.0 notice": "Version 2.0", "Apache-2.0": "Version 2.0", "Apache-2.0 text": "Version 2.0",
    "GPL-2.0 notice": "GNU General Public License, version 2", "GPL-3.0 notice": "GNU General Public License, version 3",
    "LGPL-2.1 notice": "GNU Lesser General Public License, version 2.1", "LGPL-3.0 notice": "GNU Lesser General Public License, version 3",
    "AGPL-3.0 notice": "GNU Affero General Public License, version 3",
    "GPL-2.0": "version 2 of", "GPL-3.0": "version 3 of", "LGPL-2.1": "version 2.1 of",
    "LGPL-3.0": "version 3 of", "AGPL-3.0": "version 3 of",
    "GPL-2.0 text": "Version 2, June 1991", "GPL-3.0 text": "Use with the GNU Affero", "LGPL-2.1 text": "Version 2.1",
    "LGPL-3.0 text": "version 3 of the GNU Lesser", "AGPL-3.0 text": "Remote Network Interaction",
    "MPL-2.0": "v. 2.0", "MPL-2.0 text": "Version 2.0",
    "CC-BY-4.0 notice": "BY 4.0", "CC-BY-SA-4.0 notice": "BY-SA 4.0", "CC-BY-NC-4.0 notice": "BY-NC 4.0", "CC-BY-ND-4.0 notice": "BY-ND 4.0",
    "CC-BY-NC-SA-4.0 notice": "BY-NC-SA 4.0", "CC-BY-NC-ND-4.0 notice": "BY-NC-ND 4.0", "CC-BY-4.0": "Attribution 4.0",
    "CC-BY-SA-4.0": "Attribution-ShareAlike 4.0", "CC-BY-NC-4.0": "Attribution-NonCommercial 4.0",
}
TOLD_BY |= {"BSL-1.0 notice": "Boost Software License, Version 1.0", "BSL-1.0 text": "this entire statement"}
# An identifier and a name in a notice count only as a whole.
TOLD_BY |= {f"{x} SPDX": f"Identifier: {x}" for x in SPDX_IDS} | {k: name for k, (_, name) in _ONE_LINE.items()}
# The GNU headers name their licence by the word before "General".
_GNU_NAMES = {"GPL": "GNU General", "LGPL": "Lesser General", "AGPL": "Affero General"}
TOLD_BY |= {f"{k}-{v}": f"{TOLD_BY[f'{k}-{v}']} . {name}" for k, name in _GNU_NAMES.items() for v in ("2.0", "2.1", "3.0")
            if f"{k}-{v}" in TOLD_BY}
TOLD_BY["LGPL-2.0"] = "Library General"  # the only version of that name
# A template comes before those that it contains for the most part, if it is so much longer.
LONGER = 1.5

# Letters, digits and all bytes from 0x80 up are word characters; capitals become small.
_NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256))
_IS_WORD = np.frombuffer(_NORMAL, np.uint8) != 32


def word_bigrams(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every word bigram, and where each word starts and ends in ``text``."""
    inside = np.zeros(len(text) + 2, dtype=bool)
    inside[1:-1] = _IS_WORD[np.frombuffer(text, np.uint8)]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[0::2], edge[1::2]
    if len(starts) < 2:
        return np.empty(0, np.uint64), starts, ends
    joined = b" ".join(text.translate(_NORMAL).split())
    at = np.concatenate(([0], np.cumsum(ends - starts + 1)))
    return span_hashes(prefix_hash(joined), at[:-2], at[2:] - 1), starts, ends


def _phrases(text: str) -> list[int]:
    """Bigrams within the phrases of ``text``, which " . " sets apart."""
    return [h for x in text.split(" . ") for h in word_bigrams(x.encode())[0].tolist()]


class Templates:
    def __init__(self, templates: Mapping[str, str], threshold: float, told_by: Mapping[str, str] = TOLD_BY):
        self.threshold = threshold
        self.names = list(templates)
        sets = [frozenset(word_bigrams(x.encode())[0].tolist()) for x in templates.values()]
        if not all(sets):
            raise ValueError("a template needs two words or more")
        self.sizes = np.array([len(x) for x in sets])
        self.all = np.array(sorted(frozenset().union(*sets)), dtype=np.uint64)
        self.member = np.array([np.isin(self.all, np.array(list(x), np.uint64)) for x in sets]).T.reshape(-1, len(sets))
        self.needed = [[h for h in _phrases(told_by.get(n, "")) if h in x] for n, x in zip(self.names, sets)]
        self.level = [0] * len(sets)
        for k in np.argsort(-self.sizes, kind="stable").tolist():
            above = [self.level[j] + 1 for j, x in enumerate(sets)
                     if len(x) >= LONGER * len(sets[k]) and len(x & sets[k]) >= threshold * len(sets[k])]
            self.level[k] = max(above, default=0)

    def scan(self, grams: np.ndarray) -> list[tuple[int, float, int, int]]:
        """(template, dice, first bigram, last bigram): the best windows, none inside or across another.

        Each hit starts a best window; the best of all is taken, and a window that runs into a taken one is searched again
        up to there.
        """
        t = self.threshold
        at = np.searchsorted(self.all, grams)
        at[at == len(self.all)] = 0
        known = self.all[at] == grams
        if not known.any():
            return []
        hits_of = self.member[np.unique(at[known])].sum(axis=0)
        candidates = np.flatnonzero(hits_of * (2 - t) >= self.sizes * t - 1e-9).tolist()
        if not candidates:
            return []
        order = np.argsort(grams, kind="stable")
        before = np.full(len(grams), -1)  # where the same bigram stands before
        same = grams[order[1:]] == grams[order[:-1]]
        before[order[1:][same]] = order[:-1][same]
        used = np.zeros(len(grams) + 1, dtype=bool)
        taken: list[tuple[int, float, int, int]] = []
        for level in sorted({self.level[k] for k in candidates}):
            searches, heap = {}, []
            for k in candidates:
                if self.level[k] == level:
                    searches[k] = self._search(k, grams, known & self.member[at, k], before)
                    heap += [found for first in searches[k][0] if (found := searches[k][1](first, len(grams) - 1))]
            heapify(heap)
            while heap:
                dice, _, first, last, k = heappop(heap)
                inside = used[first:last + 2]
                if not inside.any():
                    used[first:last + 2] = True
                    taken.append((k, -dice, first, last))
                elif (free := int(inside.argmax())) > 1 and (found := searches[k][1](first, first + free - 2)):
                    heappush(heap, found)
        return sorted(taken, key=lambda x: x[2])

    def _search(self, k: int, grams: np.ndarray, is_hit: np.ndarray, before: np.ndarray):
        """First bigrams of windows for a template, and the search for the best window from one of them up to a limit."""
        t, size = self.threshold, int(self.sizes[k])
        least, most = math.ceil(size * t / (2 - t) - 1e-9), math.floor(size * (2 - t) / t + 1e-9)
        needed = [np.flatnonzero(grams == np.uint64(h)) for h in self.needed[k]]
        hits = np.flatnonzero(is_hit)
        enough = np.searchsorted(hits, hits + most) - np.arange(len(hits)) >= least

        def best(first: int, limit: int) -> tuple[float, int, int, int, int] | None:
            end = min(first + most - 1, limit) + 1
            if end - first < least:
                return None
            low = first
            for places in needed:
                if (j := int(np.searchsorted(places, first))) == len(places) or places[j] >= end:
                    return None
                low = max(low, int(places[j]))
            fresh = before[first:end] < first
            new = fresh & is_hit[first:end]
            ends = np.flatnonzero(new)  # a longer window with nothing new is no better
            seen = np.arange(1, len(ends) + 1)
            dice = 2 * seen / (np.cumsum(fresh)[ends] + size)
            dice[(seen < least) | (ends < low - first)] = 0.0
            if not len(ends) or dice[j := int(dice.argmax())] < t:
                return None
            return -float(dice[j]), -size, first, first + int(ends[j]), k

        return hits[enough].tolist(), best


FOUND = "doc_id long, licence string, start long, length long, dice double"
_FOUND = pa.schema([("doc_id", pa.int64()), ("licence", pa.string()), ("start", pa.int64()), ("length", pa.int64()),
                    ("dice", pa.float64())])


def scan_licences(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, *, threshold: float = THRESHOLD,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per licence found: ``doc_id, licence, start, length`` (bytes of the UTF-8 text), ``dice``.

    Windows of a document do not overlap: templates that contain others first, then the highest Dice, then the longer
    template. Null, empty and
    one-word texts hold no licence; repeated rows give their findings each; an empty table gives no rows; other
    columns are not read. One pass without a shuffle; the templates are part of the task.
    """
    known = Templates(templates, threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            out: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch, "text")):
                grams, starts, ends = word_bigrams(text)
                for k, dice, first, last in known.scan(grams) if len(grams) else ():
                    start, end = int(starts[first]), int(ends[last + 1])
                    for column, value in zip(out, (doc_id, known.names[k], start, end - start, dice)):
                        column.append(value)
            yield out_batch(_FOUND, out)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
                       ).mapInArrow(run, FOUND)
