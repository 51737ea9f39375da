"""License notices in documents by conditional compression.

Around pairs of words that a template has too, side by side or one apart, blocks
of bounded length are cut out of the text. Each block is compressed alone and
with each template it shares a pair with as a raw dictionary; others could spare
nothing. Templates that make it much smaller are aligned with it word by word,
those that spare most first. The exact wording differences confirm them.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import cache
from itertools import repeat
from operator import itemgetter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shipping import ship

BLOCK_WORDS = 700  # longer stretches are cut into overlapping blocks
# Words around a shared pair that belong to its block: short notices stand out
# in narrow blocks, whole license texts need wide ones.
NARROW, WIDE = (12, 16), (60, 350)
MIN_SHARE = 0.1  # of the template's own size that it has to spare
MIN_MATCHED = 0.8  # of the template's words, in order
MAX_ADDED = 0.25  # words put in, as a share of the template's; one is always let in

# The wording of common public notices, and the words in them that
# tell licenses apart and so must all be there.
TEMPLATES: dict[str, tuple[str, str]] = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0", "apache 2.0"),
    "Apache-2.0 header": (
        "Unless required by applicable law or agreed to in writing, software distributed under"
        " the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF"
        " ANY KIND, either express or implied.",
        "as is",
    ),
    "MIT": ("Released under the MIT License", "mit"),
    "MIT licensed": ("Licensed under the MIT License", "mit"),
    "MIT permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files (the \"Software\"), to deal in the Software"
        " without restriction",
        "permission granted",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3",
        "gnu general 3",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2",
        "gnu general 2",
    ),
    "GPL notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms"
        " of the GNU General Public License as published by the Free Software Foundation",
        "gnu general",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met",
        "redistribution",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "mozilla 2.0",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0", "by 4.0"),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0", "by-sa 4.0"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0", "by-nc 4.0"),
    "all rights reserved": ("All rights reserved", "all rights reserved"),
    "Apache-2.0 name": ("Apache License 2.0", "apache 2.0"),
    "Apache-2.0 short": ("Apache 2.0 License", "apache 2.0"),
    "ISC name": ("ISC License", "isc license"),
    "BSD-2-Clause name": ("BSD 2-Clause License", "bsd 2-clause"),
    "BSD-3-Clause name": ("BSD 3-Clause License", "bsd 3-clause"),
    "LGPL-2.1": (
        "GNU Lesser General Public License version 2.1",
        "gnu lesser general 2.1",
    ),
    "LGPL-3.0": ("GNU Lesser General Public License version 3", "gnu lesser general 3"),
    "AGPL-3.0": ("GNU Affero General Public License version 3", "gnu affero general 3"),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the"
        " Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        "eclipse 2.0",
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or"
        " neighboring rights to this work",
        "waived copyright",
    ),
    "CC-BY-ND-4.0": ("Licensed under CC BY-ND 4.0", "by-nd 4.0"),
    "CC-BY-NC-SA-4.0": ("Licensed under CC BY-NC-SA 4.0", "by-nc-sa 4.0"),
    "MIT text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files (the \"Software\"), to deal in the Software"
        " without restriction, including without limitation the rights to use, copy, modify,"
        " merge, publish, distribute, sublicense, and/or sell copies of the Software, and to"
        " permit persons to whom the Software is furnished to do so, subject to the following"
        " conditions: The above copyright notice and this permission notice shall be included in"
        " all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\","
        " WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE"
        " WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN"
        " NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR"
        " OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT"
        " OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "permission granted sublicense",
    ),
    "ISC text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted, provided that the above copyright notice and this"
        " permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR"
        " DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES"
        " OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,"
        " DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS"
        " OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS"
        " ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
        "permission fee granted",
    ),
    "BSD-3-Clause text": (
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met: 1. Redistributions of source"
        " code must retain the above copyright notice, this list of conditions and the following"
        " disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,"
        " this list of conditions and the following disclaimer in the documentation and/or other"
        " materials provided with the distribution. 3. Neither the name of the copyright holder"
        " nor the names of its contributors may be used to endorse or promote products derived"
        " from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED"
        " BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED"
        " WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND"
        " FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
        "redistributions endorse",
    ),
    "BSD-2-Clause text": (
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met: 1. Redistributions of source"
        " code must retain the above copyright notice, this list of conditions and the following"
        " disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,"
        " this list of conditions and the following disclaimer in the documentation and/or other"
        " materials provided with the distribution.",
        "redistributions reproduce",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free"
        " to copy, modify, publish, use, compile, sell, or distribute this software, either in"
        " source code form or as a compiled binary, for any purpose, commercial or non-commercial,"
        " and by any means.",
        "unencumbered",
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event"
        " will the authors be held liable for any damages arising from the use of this software."
        " Permission is granted to anyone to use this software for any purpose, including"
        " commercial applications, and to alter it and redistribute it freely, subject to the"
        " following restrictions: 1. The origin of this software must not be misrepresented; you"
        " must not claim that you wrote the original software. 2. Altered source versions must be"
        " plainly marked as such, and must not be misrepresented as being the original software."
        " 3. This notice may not be removed or altered from any source distribution.",
        "misrepresented altered",
    ),
    "BSL-1.0": (
        "Boost Software License - Version 1.0 - August 17th, 2003. Permission is hereby granted,"
        " free of charge, to any person or organization obtaining a copy of the software and"
        " accompanying documentation covered by this license (the \"Software\") to use, reproduce,"
        " display, distribute, execute, and transmit the Software, and to prepare derivative works"
        " of the Software, and to permit third-parties to whom the Software is furnished to do so",
        "boost 1.0",
    ),
    "GPL notice without warranty": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY"
        " WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A"
        " PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "hope warranty gnu",
    ),
    "WTFPL": (
        "Everyone is permitted to copy and distribute verbatim or modified copies of this license"
        " document, and changing it is allowed as long as the name is changed.",
        "verbatim changing",
    ),
}

# Words so common that a pair of them tells nothing.
_COMMON = frozenset(
    "a all an and any are as at be by for from has have if in is it its may no not of on or out"
    " shall so such that the their there they this to use was which who will with you your 0 1 2"
    " 3 4".split()
)

_WORD = re.compile(r"\S+")
_MARKS = " \t\n\r\"'()[]{}<>,;:.!?*#/\\|%&$"
_LONE_V = re.compile(r"v(?=[0-9])")
_SAME = {"licence": "license", "licences": "licenses", "licenced": "licensed", "v": "version"}

# Pairs are looked for in rougher words: all marks and blanks part them.
_ROUGH = bytes(
    c + 32 if 65 <= c <= 90 else 32 if chr(c) in _MARKS or c in (11, 12) else c for c in range(256)
)
_ROUGH_WORD = re.compile("[^" + re.escape(_MARKS) + "\x0b\x0c]+")


@dataclass
class Word:
    start: int
    end: int
    plain: str


def words_of(text: str, start: int = 0) -> list[Word]:
    """Words with their places, lower-cased and without marks around them, in one
    spelling of "license" and of version numbers."""
    out = []
    for m in _WORD.finditer(text):
        plain = m[0].strip(_MARKS)
        if plain:
            first = start + m.start() + m[0].index(plain)
            out.append(Word(first, first + len(plain), _plain(plain)))
    return out


def _plain(word: str) -> str:
    word = _LONE_V.sub("", word.lower())
    if word.endswith(".0") and word[:-2].isdigit():
        word = word[:-2]
    return _SAME.get(word, word)


@dataclass
class Template:
    name: str
    words: list[str]
    needed: frozenset[str]
    size: int
    compressor: zstandard.ZstdCompressor

    def __contains__(self, words: list[str]) -> bool:
        """Whether the words come in it, one after the other."""
        n = len(words)
        return any(self.words[i : i + n] == words for i in range(len(self.words) - n + 1))


def _compressor(dictionary: bytes | None) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters.from_level(
        19, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_dict_id=False
    )
    raw = dictionary and zstandard.ZstdCompressionDict(
        dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT
    )
    return zstandard.ZstdCompressor(compression_params=parameters, dict_data=raw or None)


@cache
def _templates() -> list[Template]:
    alone = _compressor(None)
    out = []
    for name, (wording, needed) in TEMPLATES.items():
        plain = [w.plain for w in words_of(wording)]
        data = " ".join(plain).encode()
        out.append(
            Template(
                name,
                plain,
                frozenset(map(_plain, needed.split())),
                len(alone.compress(data)),
                _compressor(data),
            )
        )
    return out


@cache
def _alone() -> zstandard.ZstdCompressor:
    return _compressor(None)


@cache
def _pairs() -> tuple[dict[bytes, int], np.ndarray, list[frozenset[int]]]:
    """Numbers of the words in templates; sorted codes of their pairs, side by
    side or one apart, and the templates each is in."""
    numbers: dict[bytes, int] = {}
    owners: dict[int, set[int]] = {}
    for at, (wording, _) in enumerate(TEMPLATES.values()):
        words = _rough(wording)
        for word in words:
            numbers.setdefault(word, len(numbers) + 1)
        for apart in (1, 2):
            for one, two in zip(words, words[apart:], strict=False):
                if not {one.decode(), two.decode()} <= _COMMON:
                    owners.setdefault(numbers[one] << 20 | numbers[two], set()).add(at)
    codes = sorted(owners)
    return numbers, np.array(codes, np.int64), [frozenset(owners[c]) for c in codes]


def _rough(text: str) -> list[bytes]:
    data = text.encode("utf-8", "surrogatepass").translate(_ROUGH)
    return data.replace(b"licence", b"license").split()


def shared_pairs(text: str) -> list[tuple[int, frozenset[int]]]:
    """(place in the text, templates) of each pair of words that templates have."""
    numbers, codes, owners = _pairs()
    words = _rough(text)
    ids = np.fromiter(map(numbers.get, words, repeat(0)), np.int64, len(words))
    found: dict[int, set[int]] = {}
    for apart in (1, 2):
        one, two = ids[:-apart], ids[apart:]
        both = np.flatnonzero((one > 0) & (two > 0))
        if not len(both):
            continue
        asked = one[both] << 20 | two[both]
        at = np.minimum(np.searchsorted(codes, asked), len(codes) - 1)
        for word, code in zip(both[codes[at] == asked].tolist(), at[codes[at] == asked].tolist(), strict=True):
            found.setdefault(word, set()).update(owners[code])
    if not found:
        return []
    places = {k: m.start() for k, m in enumerate(_ROUGH_WORD.finditer(text)) if k in found}
    return [(places[k], frozenset(found[k])) for k in sorted(found)]


def blocks_of(
    words: list[Word], pairs: list[tuple[int, frozenset[int]]], before: int, after: int
) -> Iterator[tuple[list[Word], list[Template]]]:
    """Runs of words around shared pairs, and the templates these are from; long
    runs in overlapping blocks."""
    runs: list[list[int]] = []
    marks: list[tuple[int, frozenset[int]]] = []
    at = 0
    for place, templates in pairs:
        while at < len(words) and words[at].end <= place:
            at += 1
        marks.append((at, templates))
        low, high = max(0, at - before), min(len(words), at + after)
        if runs and low <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], high)
        else:
            runs.append([low, high])
    known = _templates()
    for low, high in runs:
        for start in range(low, high, BLOCK_WORDS - after):
            end = min(high, start + BLOCK_WORDS)
            first = bisect_left(marks, start, key=itemgetter(0))
            last = bisect_left(marks, end, key=itemgetter(0))
            own = frozenset().union(*{templates for _, templates in marks[first:last]})
            yield words[start:end], [known[i] for i in sorted(own)]
            if start + BLOCK_WORDS >= high:
                break


@dataclass
class Finding:
    name: str
    start: int
    end: int
    missing: str
    added: str
    spared: int


def _align(template: Template, block: list[Word], used: set[int]) -> tuple | None:
    """First to last matched word, and the wording differences between."""
    free = [i for i, w in enumerate(block) if w.start not in used]
    plain = [block[i].plain for i in free]
    parts = SequenceMatcher(None, template.words, plain, autojunk=False).get_matching_blocks()[:-1]
    # The stretch around the longest part, of about the template's length.
    if not parts:
        return None
    longest = max(parts, key=lambda p: p.size)
    room = len(template.words)
    low, high = longest.b - longest.a - room // 2, longest.b + (room - longest.a) + room // 2
    low, high = max(0, low), min(len(plain), high)
    parts = SequenceMatcher(None, template.words, plain[low:high], autojunk=False)
    parts = parts.get_matching_blocks()[:-1]
    first, last = parts[0].b, parts[-1].b + parts[-1].size
    taken_a = {i for p in parts for i in range(p.a, p.a + p.size)}
    taken_b = {i for p in parts for i in range(p.b, p.b + p.size)}
    missing = [w for i, w in enumerate(template.words) if i not in taken_a]
    added = [plain[low + i] for i in range(first, last) if i not in taken_b]
    return [free[low + i] for i in range(first, last)], missing, added


def _best(
    block: list[Word], templates: list[Template], used: set[int], exact: bool
) -> Finding | None:
    """The confirmed template that spares the block's unused words most; of equal
    ones the first by name."""
    data = " ".join(w.plain for w in block if w.start not in used).encode()
    size = len(_alone().compress(data))
    spared = [(size - len(t.compressor.compress(data)), t) for t in templates]
    near: list[tuple[Template, Finding]] = []
    for saving, template in sorted(spared, key=lambda x: (-x[0], x[1].name)):
        aligned = None
        if saving >= MIN_SHARE * template.size:
            aligned = _align(template, block, used)
        if aligned is None:
            continue
        places, missing, added = aligned
        n = len(template.words)
        if (
            n - len(missing) < MIN_MATCHED * n
            or len(added) > max(1, MAX_ADDED * n)
            or template.needed & set(missing)
        ):
            continue
        first, last = block[places[0]], block[places[-1]]
        finding = Finding(
            template.name, first.start, last.end, " ".join(missing), " ".join(added), saving
        )
        if not exact or not (missing or added):
            # A part of a whole text with changes is that text, not the part.
            return next(
                (f for t, f in near if template.words in t and f.start <= finding.start < f.end),
                finding,
            )
        near.append((template, finding))
    return None


def scan(text: str) -> list[Finding]:
    """Confirmed notices in order of their places."""
    pairs = shared_pairs(text)
    if not pairs:
        return []
    words = words_of(text)
    found: dict[tuple[str, int], Finding] = {}
    used: set[int] = set()
    # Exact wordings first, so that no other template takes a part of them; of
    # these whole texts first.
    for exact, around in ((True, WIDE), (True, NARROW), (False, NARROW), (False, WIDE)):
        for block, templates in blocks_of(words, pairs, *around):
            while (finding := _best(block, templates, used, exact)) is not None:
                found[finding.name, finding.start] = finding
                used |= {w.start for w in block if finding.start <= w.start < finding.end}
    return sorted(found.values(), key=lambda f: (f.start, f.name))


_FOUND = (
    "doc_id {id}, license string, start long, `end` long, exact boolean,"
    " missing string, added string, spared long"
)


def license_notices(docs: DataFrame) -> DataFrame:
    """One row per notice of every document: doc_id, license, start and end in
    code points, exact, the template's missing words and the added ones, and the
    bytes spared by it. Null and empty texts and texts without a notice give no
    rows; repeated rows give repeated rows."""
    ship(docs.sparkSession)

    def scan_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "license", "start", "end", "exact", "missing", "added", "spared"]
        kinds = [None, pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.string(), pa.int64()]
        for batch in batches:
            kinds[0] = batch.schema.field(0).type
            rows = [
                (i, f.name, f.start, f.end, not (f.missing or f.added), f.missing, f.added, f.spared)
                for i, text in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                for f in scan(text)
            ]
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.record_batch(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )

    with_text = docs.where(F.col("text") != "").select("doc_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return with_text.mapInArrow(scan_all, _FOUND.format(id=id_type))
