"""Licence notices by Dice coefficient over word bigrams.

Texts and templates are normalised to lower-case words without signs.  Two
pieces of text are compared by their sets of word bigrams: twice the common
ones over the sum of both sizes.  A score of ``t`` needs sizes whose ratio is
at most ``(2 - t) / t``, which prunes templates before anything is compared.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.llm.words import gram_hashes, map_slices, raw, word_hashes, words_of

LEAST_DICE = 0.8

# Names and identifiers of public licences.
LICENCES = {
    "MIT": ("MIT License",),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0"),
    "GPL-2.0": ("GNU General Public License, version 2",),
    "GPL-3.0": ("GNU General Public License, version 3",),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1",),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3",),
    "AGPL-3.0": ("GNU Affero General Public License, version 3",),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License",),
    "BSD-3-Clause": ("BSD 3-Clause License",),
    "ISC": ("ISC License",),
    "Unlicense": ("Unlicense",),
    "CC0-1.0": ("CC0 1.0", "Creative Commons Zero 1.0 Universal"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0",),
    "CC-BY-NC-SA-4.0": ("CC BY-NC-SA 4.0",),
}
PHRASES = (
    "Licensed under {}.",
    "Licensed under the {}.",
    "Released under the {}.",
    "This work is licensed under the {}.",
    "Distributed under the terms of the {}.",
    "This file is subject to the terms of the {}.",
)
# The texts of public licences and notices.
TEXTS = {
    "All-Rights-Reserved": "All rights reserved.",
    "Public-Domain": "This work is released into the public domain.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        'copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY '
        "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
        "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version. This program is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU General Public License for more details."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."
    ),
}
TEMPLATES = tuple(
    (licence, text)
    for licence, text in [
        *((k, p.format(name)) for k, names in LICENCES.items() for name in names for p in PHRASES),
        *TEXTS.items(),
    ]
)

# Complete texts and standard headers beyond the statements above.
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
    "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. "
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission. "
)
_BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
    "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
    "DAMAGE."
)


def _gnu(work: str, kind: str, version: str, later: str, received: str) -> str:
    return (
        f"{work} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} "
        f"General Public License as published by the Free Software Foundation, either version {version} of the "
        f"License, or (at your option) any later version. {work} is distributed in the hope that it will be "
        "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        f"PARTICULAR PURPOSE. See the GNU {kind} General Public License for more details. You should have "
        f"received a copy of the GNU {kind} General Public License along with {received} {later}"
    )


_SEE = "If not, see <https://www.gnu.org/licenses/>."
_WRITE = (
    "if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA "
    "02110-1301 USA."
)


def _creative(name: str, path: str) -> str:
    return (
        f"This work is licensed under the Creative Commons {name} 4.0 International License. To view a copy of "
        f"this license, visit http://creativecommons.org/licenses/{path}/4.0/ or send a letter to Creative "
        "Commons, PO Box 1866, Mountain View, CA 94042, USA."
    )


STANDARD_TEXTS = (
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
        "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
        "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    ("BSD-2-Clause", _BSD + _BSD_DISCLAIMER),
    ("BSD-3-Clause", _BSD + _BSD_NAMES + _BSD_DISCLAIMER),
    ("BSD-3-Clause", _BSD + _BSD_NAMES),
    ("GPL-2.0", _gnu("This program", "", "2", _WRITE, "this program;")),
    ("GPL-2.0", _gnu("This program", "", "2", "", "")),
    ("GPL-3.0", _gnu("This program", "", "3", _SEE, "this program.")),
    ("LGPL-2.1", _gnu("This library", "Lesser", "2.1", _WRITE, "this library;")),
    ("LGPL-2.1", _gnu("This library", "Lesser", "2.1", "", "")),
    ("LGPL-3.0", _gnu("This library", "Lesser", "3", _SEE, "this library.")),
    ("LGPL-3.0", _gnu("This program", "Lesser", "3", _SEE, "this program.")),
    ("AGPL-3.0", _gnu("This program", "Affero", "3", _SEE, "this program.")),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize "
        "copyright laws, the author or authors of this software dedicate any and all copyright interest in the "
        "software to the public domain. We make this dedication for the benefit of the public at large and to the "
        "detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in "
        "perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "
        '"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For "
        "more information, please refer to <https://unlicense.org>",
    ),
    (
        "CC0-1.0",
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring "
        "rights to this software to the public domain worldwide. This software is distributed without any warranty. "
        "You should have received a copy of the CC0 Public Domain Dedication along with this software. If not, see "
        "<http://creativecommons.org/publicdomain/zero/1.0/>.",
    ),
    ("CC-BY-4.0", _creative("Attribution", "by")),
    ("CC-BY-SA-4.0", _creative("Attribution-ShareAlike", "by-sa")),
    ("CC-BY-NC-4.0", _creative("Attribution-NonCommercial", "by-nc")),
    ("CC-BY-ND-4.0", _creative("Attribution-NoDerivatives", "by-nd")),
    ("CC-BY-NC-SA-4.0", _creative("Attribution-NonCommercial-ShareAlike", "by-nc-sa")),
)
# The SQL statement knows TEMPLATES alone.
SCANNED = (*TEMPLATES, *STANDARD_TEXTS)

# Signs and white space part words; lines stay apart.
_NORMAL = np.arange(256, dtype=np.uint8)
_NORMAL[:128] = [
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c == 10 else 32 for c in range(128)
]

MATCHES = "doc_id long, scope string, first_line long, last_line long, licence string, template int, dice double"
MATCH_TYPES = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.float64())


def normalised(text: str) -> str:
    return " ".join(_NORMAL[np.frombuffer(text.encode(), np.uint8)].tobytes().decode().split(" ")).strip()


def bigrams(text: str) -> frozenset[tuple[str, str]]:
    words = normalised(text).split()
    return frozenset(zip(words, words[1:]))


class Prepared(NamedTuple):
    """Bigrams of templates: sets, hashes of all, which template has which, how many with repeats."""

    sets: list[frozenset]
    known: np.ndarray
    member: np.ndarray
    sizes: np.ndarray


@lru_cache(maxsize=4)
def _prepared(templates: tuple[tuple[str, str], ...]) -> Prepared:
    sets = [bigrams(text) for _, text in templates]
    joined = pa.array([" ".join(normalised(text).split()) for _, text in templates], pa.string())
    data, offsets = raw(joined)
    w = words_of(data, offsets)
    grams, template = _line_bigrams(word_hashes(w), w.first)
    known = np.unique(grams)
    member = np.zeros((len(sets), len(known)), bool)
    member[template, np.searchsorted(known, grams)] = True
    return Prepared(sets, known, member, np.bincount(template, minlength=len(sets)))


def _line_bigrams(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and line of every bigram inside a line."""
    line = np.repeat(np.arange(len(first) - 1), np.diff(first))
    inside = np.flatnonzero(line[1:] == line[:-1])
    return gram_hashes(hashes, 2)[inside], line[inside]


def best_template(
    piece: frozenset, sets: list[frozenset], least: float
) -> tuple[int, float] | None:
    """The template of highest Dice coefficient, the first one of equals, if it reaches ``least``."""
    best = None
    for k, s in enumerate(sets):
        # Size bounds: even if one set holds the other, the score stays below ``least``.
        if 2 * min(len(piece), len(s)) < least * (len(piece) + len(s)):
            continue
        score = 2 * len(piece & s) / max(1, len(piece) + len(s))
        if score >= least and (best is None or score > best[1]):
            best = (k, score)
    return best


def best_windows(
    grams: np.ndarray, code: np.ndarray, stop: np.ndarray, prepared: Prepared, least: float
) -> list[tuple[int, int, int, float]]:
    """First and last bigram, template and Dice coefficient of the best disjoint windows.

    ``code`` is the row of a bigram in ``prepared.known`` or -1, ``stop`` the
    end of its text.  ``n`` template bigrams need at least ``n * least / (2 - least)``
    common ones.  A window starts at a bigram of the template that does not
    come again before so many bigrams could follow.  Of overlapping windows
    the one with most common bigrams stays.
    """
    hits = np.flatnonzero(code >= 0)
    found: list[tuple[int, float, int, int, int]] = []
    for k, has in enumerate(prepared.member):
        at = hits[has[code[hits]]]
        n = int(has.sum())
        need = max(1, int(np.ceil(n * least / (2 - least) - 1e-9)))
        if len(at) < need or not n:
            continue
        longest = int(prepared.sizes[k] * (2 - least) / least) + 1
        begin, end = at[: len(at) - need + 1], at[need - 1 :]
        near = (end - begin < longest) & (end < stop[begin])
        if not near.any():
            continue
        order = np.lexsort((at, code[at]))
        again = np.full(len(at), len(grams))
        same = np.flatnonzero(code[at[order[1:]]] == code[at[order[:-1]]])
        again[order[same]] = at[order[same + 1]]
        for a in begin[near & (again[: len(begin)] - begin >= need)].tolist():
            b = min(a + longest, int(stop[a]))
            new = np.zeros(b - a, bool)
            new[np.unique(grams[a:b], return_index=True)[1]] = True
            common = np.cumsum(new & (code[a:b] >= 0) & has[code[a:b]])
            both = np.cumsum(new) + n
            dice = 2 * common / both
            best = int(dice.argmax())
            if dice[best] >= least:
                found.append((int(3 * common[best] - both[best]), float(dice[best]), k, a, a + best))
    found.sort(key=lambda f: (-f[0], -f[1], f[2], f[3]))
    taken = np.zeros(len(grams) + 1, bool)
    out = []
    for _, dice, k, a, b in found:
        if not taken[a : b + 2].any():
            taken[a : b + 2] = True
            out.append((a, b, k, dice))
    return sorted(out)


def scan_batch(batch: pa.RecordBatch, templates, least: float) -> pa.RecordBatch:
    prepared = _prepared(templates)
    sets, known = prepared.sets, prepared.known
    data, offsets = raw(batch.column("text"))
    data = _NORMAL[data]
    newline = np.flatnonzero(data == 10)
    starts = np.union1d(newline + 1, offsets[:-1])
    starts = starts[starts < len(data)]
    text = np.searchsorted(offsets, starts, side="right") - 1
    w = words_of(data, np.append(starts, len(data)))
    hashes = word_hashes(w)
    grams, line = _line_bigrams(hashes, w.first)
    at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
    lines = np.unique(line[known[at] == grams])
    # The number of a line inside its text.
    number = np.arange(len(starts)) - np.searchsorted(starts, offsets[:-1])[text]
    ends = np.append(starts[1:], len(data))
    plain = data.tobytes()
    out: list[tuple] = []

    def piece(a: int, b: int) -> str:
        return plain[starts[a] : ends[b]].decode().replace("\n", " ")

    reported: dict[str, list[tuple[int, int]]] = {}

    def report(scope: str, a: int, b: int, k: int, score: float) -> None:
        doc = batch.column("doc_id")[int(text[a])].as_py()
        out.append((doc, scope, int(number[a]), int(number[b]), templates[k][0], k, score))

    def match(scope: str, a: int, b: int) -> None:
        found = best_template(bigrams(piece(a, b)), sets, least)
        if found:
            report(scope, a, b, *found)
            reported.setdefault(templates[found[0]][0], []).append((a, b))

    for a in lines.tolist():
        match("line", a, a)
    if len(lines):
        apart = (np.diff(lines) > 1) | (np.diff(text[lines]) > 0)
        begins = np.flatnonzero(np.append(True, apart))
        for a, b in zip(lines[begins].tolist(), lines[np.append(begins[1:], len(lines)) - 1].tolist()):
            if b > a:
                match("run", a, b)
    # Words of a text follow each other across its lines.
    line_of = np.repeat(np.arange(len(starts)), np.diff(w.first))
    text_of = text[line_of]
    across = gram_hashes(hashes, 2)
    at = np.minimum(np.searchsorted(known, across), len(known) - 1)
    code = np.where((known[at] == across) & (text_of[1:] == text_of[:-1]), at, -1)
    stop = np.searchsorted(text_of, text_of[: len(across)], side="right") - 1
    for a, b, k, score in best_windows(across, code, stop, prepared, least):
        a, b = int(line_of[a]), int(line_of[b + 1])
        if not any(x <= a and b <= y for x, y in reported.get(templates[k][0], ())):
            report("window", a, b, k, score)
    columns = list(zip(*out)) or [[]] * len(MATCH_TYPES)
    names = [c.split()[0] for c in MATCHES.split(", ")]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, MATCH_TYPES)], names=names)


def scan_licences(
    documents: DataFrame,
    templates: tuple[tuple[str, str], ...] = SCANNED,
    least: float = LEAST_DICE,
) -> DataFrame:
    """Licence notices in whole texts: doc_id, scope, lines, licence, template and Dice coefficient.

    Compared are single lines, and runs of lines that each have a bigram of
    some template, for texts broken over lines.  Each piece gets its best
    template if that reaches ``least``.  Windows of words find the notices
    inside longer lines, across blank lines and between prose; a window is
    left out if a line or run over its lines has the same licence.  Lines are numbered from 0.  Null and
    empty texts and lines of one word match nothing; equal rows give equal
    matches; an empty table gives no rows; other columns are not looked at.
    Nothing is shuffled.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return map_slices(rows, lambda b: scan_batch(b, templates, least), MATCHES)
