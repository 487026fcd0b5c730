"""License scan against a plain search over all windows."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SF01
from tidemark.llm import licences, queries
from tidemark.llm.licences import TEMPLATES, Templates, word_bigrams


def plain_best(words, template, threshold):
    """Highest Dice over all windows of at most the largest size."""
    want = {tuple(template[k:k + 2]) for k in range(len(template) - 1)}
    best = 0.0
    for a in range(len(words)):
        for b in range(a + 1, min(len(words), a + 1 + int(len(want) * (2 - threshold) / threshold + 1e-9))):
            own = {tuple(words[k:k + 2]) for k in range(a, b)}
            best = max(best, 2 * len(own & want) / (len(own) + len(want)))
    return best if best >= threshold - 1e-12 else 0.0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abcdef"), max_size=25), st.lists(st.sampled_from("abcde"), min_size=2, max_size=7),
       st.sampled_from([0.5, 0.7, 0.8, 1.0]))
def test_best_window(words, template, threshold):
    grams, _, _ = word_bigrams(" ".join(words).encode())
    found = Templates({"t": " ".join(template)}, threshold).scan(grams) if len(grams) else []
    got = max((d for _, d, _, _ in found), default=0.0)
    assert abs(got - plain_best(words, template, threshold)) < 1e-9
    spans = sorted((a, b) for _, _, a, b in found)
    assert all(x[1] + 1 < y[0] for x, y in zip(spans, spans[1:]))          # windows share no word


def test_templates_are_found_whole_edited_and_inside_other_text(workers):
    rnd = random.Random(2)
    rows, want = [], {}
    for k, (name, text) in enumerate(TEMPLATES.items()):
        words = re.split(r"\s+", text)
        if len(words) > 40:
            words[rnd.randrange(len(words))] = "changed"
        rows.append((k, "Some é words before;\n" + "\n".join(words).upper() + " and some behind them"))
        want[k] = name
    rows += [(1100, None), (1101, ""), (1102, "one"), (1103, "a licence is not named here"), (1104, rows[0][1]), (1104, rows[0][1])]
    df = workers.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, licence string, start int")
    out = licences.scan_licences(df).collect()
    assert {r.doc_id: r.licence for r in out if r.doc_id < 1000} == want
    assert all(r.dice > 0.9 for r in out) and sum(r.doc_id == 1104 for r in out) == 2 and not {1100, 1101, 1102, 1103} & {r.doc_id for r in out}
    for r in out:
        text = dict(rows)[r.doc_id].encode()
        inside = text[r.start:r.start + r.length].decode()
        assert inside == inside.strip() and inside.split()[0].lower().strip('"') in TEMPLATES[r.licence].lower()
    assert licences.scan_licences(df.limit(0)).collect() == []


def names(text):
    known = Templates(TEMPLATES, licences.THRESHOLD)
    return [known.names[k] for k, _, _, _ in known.scan(word_bigrams(f"Words before it. {text} Words behind it.".encode())[0])]


@pytest.mark.parametrize("name, old, new, want", [
    ("GPL-3.0", "GNU General", "GNU Lesser General", ["LGPL-3.0"]), ("GPL-3.0", "GNU General", "GNU Affero General", ["AGPL-3.0"]),
    ("GPL-3.0", "version 3", "version 2", ["GPL-2.0"]), ("GPL-3.0", "version 3", "version 1", []),
    ("LGPL-3.0", "version 3", "version 2.1", ["LGPL-2.1"]), ("GPL-3.0", "version 3 of the License", "", []),
    ("GPL-3.0 notice", "General", "Lesser General", ["LGPL-3.0 notice"]), ("GPL-3.0 notice", "version 3", "version 2", ["GPL-2.0 notice"]),
    ("Apache-2.0 notice", "2.0", "1.1", []), ("Apache-2.0", "Version 2.0", "Version 1.1", []),
    ("CC-BY-NC-4.0 notice", "4.0", "3.0", []), ("CC-BY-4.0 notice", "BY", "BY-NC-SA", ["CC-BY-NC-SA-4.0 notice"]),
    ("CC-BY-SA-4.0 notice", "4.0", "3.0", []), ("CC-BY-4.0", "4.0", "3.0", []),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the\nSoftware.", "", []),
    ("BSD-3-Clause text", "may be used", "can be used", ["BSD-3-Clause text"]), ("BSD-2-Clause text", "ADVISED", "TOLD", ["BSD-2-Clause text"]),
    ("GPL-2.0 text", "Version 2, June 1991", "Version 1, February 1989", ["GPL-2.0"]),  # the header it quotes
    ("GPL-3.0 text", "freedom", "liberty", ["GPL-3.0 text"]),
    ("AGPL-3.0 text", "freedom", "liberty", ["AGPL-3.0 text"]), ("Apache-2.0 text", "Contributor", "Author", ["Apache-2.0 text"]),
    ("CC0-1.0 text", "Affirmer", "Author", ["CC0-1.0 text"]), ("MPL-2.0 text", "Exhibit", "Annex", ["MPL-2.0 text"])])
def test_versions_and_variants_get_their_own_name(name, old, new, want):
    assert old in TEMPLATES[name]
    text = TEMPLATES[name].replace(old, new)
    assert set(names(text)) == set(want)


@pytest.mark.parametrize("line, want", [
    ("SPDX-License-Identifier: MIT", "MIT SPDX"), ("// SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0-or-later SPDX"),
    ("SPDX-License-Identifier: MIT-0", "MIT-0 SPDX"), ("SPDX-License-Identifier: BSD-3-Clause-Clear", "BSD-3-Clause-Clear SPDX"),
    ("SPDX-License-Identifier: GPL-3.0+", "GPL-3.0 SPDX"), ("SPDX-License-Identifier: Apache-1.1", None),
    ("SPDX-License-Identifier: GPL-1.0", None), ("SPDX-License-Identifier: CC-BY-3.0", None), ("SPDX-License-Identifier:", None),
    ("Licensed under the Apache 2.0 license.", "Apache-2.0 notice, Apache 2.0 License"),
    ("Released under the Apache License 2.0.", "Apache-2.0 notice, Apache License 2.0"),
    ("Licensed under the Apache 1.1 license.", None), ("Licensed under the Apache license.", None),
    ("Released under the GPL v3.", "GPL-3.0 notice, GPL v3"), ("It is distributed under the GPLv2.", "GPL-2.0 notice, GPLv2"),
    ("Released under the GPL v1.", None), ("Released under the GPL.", None),
    ("Licensed under the LGPLv3.", "LGPL-3.0 notice, LGPLv3"),
    ("Released under the GNU Affero General Public License v3.0.", "AGPL-3.0 notice, GNU Affero General Public License v3.0"),
    ("Released under the BSD License.", "BSD notice, BSD License"),
    ("Licensed under the BSD 3-Clause License.", "BSD-3-Clause notice, BSD 3-Clause License"),
    ("Licensed under the 2-clause BSD license.", "BSD-2-Clause notice, 2-Clause BSD License"),
    ("Licensed under the BSD 4-Clause License.", None),
    ("Distributed under the Boost Software License, Version 1.0. (See accompanying file)", "BSL-1.0 notice"),
    ("Distributed under the Boost Software License, Version 2.0.", None),
    ("Licensed under the Mozilla Public License 2.0.", "MPL-2.0 notice, Mozilla Public License 2.0"),
    ("Licensed under the Mozilla Public License 1.1.", None), ("The house was sold under the terms of the contract.", None),
    ("He was licensed under the old law of the land.", None), ("They work under the MIT campus roof.", None)])
def test_one_line_notices_and_identifiers(line, want):
    assert names(line) == ([want] if want else [])


def plain_scan(words, templates, threshold):
    """All windows that start and end with a hit, best first, taken unless they meet a taken one."""
    grams = list(zip(words, words[1:]))
    sets = [set(zip(t, t[1:])) for t in templates]
    found = []
    for k, want in enumerate(sets):
        for a in range(len(grams)):
            for b in range(a, min(len(grams), a + int(len(want) * (2 - threshold) / threshold + 1e-9))):
                own = set(grams[a:b + 1])
                dice = 2 * len(own & want) / (len(own) + len(want))
                if grams[a] in want and grams[b] in want and grams[b] not in grams[a:b] and dice >= threshold:
                    found.append((-dice, -len(want), a, b, k))
    taken = []
    for dice, _, a, b, k in sorted(found):
        if all(b + 1 < x or y + 1 < a for _, _, x, y in taken):
            taken.append((k, -dice, a, b))
    return sorted(taken, key=lambda x: x[2])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcde"), max_size=30),
       st.lists(st.lists(st.sampled_from("abcd"), min_size=3, max_size=4), min_size=1, max_size=3), st.sampled_from([0.5, 0.7, 0.8]))
def test_windows_are_taken_best_first(words, templates, threshold):
    known = Templates({str(k): " ".join(t) for k, t in enumerate(templates)}, threshold)
    grams, _, _ = word_bigrams(" ".join(words).encode())
    if not any(known.level):
        assert (known.scan(grams) if len(grams) else []) == plain_scan(words, templates, threshold)


def test_repeated_notice_is_scanned_in_linear_work():
    grams, _, _ = word_bigrams(b"released under the mit license " * 4000)
    assert len(Templates(TEMPLATES, 0.8).scan(grams)) == 4000


def test_query(workers):
    out = queries.queries()["op10_licences"](workers, SF01).collect()
    lines = {"MIT notice": "Released under the MIT License.", "GPL-3.0 notice": "This work is licensed under the GNU General"}
    docs = {r.doc_id: r.text for r in workers.read.parquet(f"{SF01}/documents.parquet").collect()}
    for name, line in lines.items():
        assert {r.doc_id for r in out if r.licence == name} == {i for i, t in docs.items() if line in t}
