"""License scan: winnowed fingerprints pick chains, alignment between their hits measures them.

Templates are cut into runs of ``GRAM`` words, of which winnowing keeps the least hash of
every ``WINNOW`` in a row.  The kept ones form an inverted index from hash to (template,
word).  A document's runs are looked up in it.  Hits on one diagonal that touch are a segment, and
segments of one template that follow each other in the document and in the template are a chain.  A
jump between diagonals has a price that grows with its length, so that stray runs far away are not
drawn in, and no segment can follow one that lies further back than the price of the whole template
allows.  The words between the hits of a chain, and those before and after it, are aligned in a
band around the chain's diagonals.

A copy is found if one kept run of words is intact, which every copy with ``GRAM + WINNOW - 1``
unchanged words in a row has.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from letterloom.llm import common as c
from letterloom.llm.automaton import _WORD, normal_words
from letterloom.llm.repeats import mix

GRAM, WINNOW = 3, 3
MIN_COVERAGE = 0.8
MIN_MATCHED = 20  # words of a chain's runs, less its jumps, from which a lesser part of a template is reported too
JUMP, REACH = 0.5, 20  # price of a jump over d diagonals: JUMP * log2(1 + d) + d / REACH
BAND = 32  # diagonals to each side of a chain in which words are aligned
TEMPLATE_CHARS = 4_000_000  # all templates together; they are sent to every task

# Notices and texts of public licenses.
TEMPLATES = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "MIT-line": "Released under the MIT License.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."
    ),
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "General Public License for more details. You should have received a copy of the GNU General Public License along "
        "with this program. If not, see <https://www.gnu.org/licenses/>."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "
        '"AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF '
        "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
        "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
        "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
        "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
        "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF "
        "THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior "
        'written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS '
        "OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR "
        "A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
        "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
        "DAMAGE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        'IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
        "USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
        "software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject "
        "to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim "
        "that you wrote the original software. If you use this software in a product, an acknowledgment in the product "
        "documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as "
        "such, and must not be misrepresented as being the original software. 3. This notice may not be removed or "
        "altered from any source distribution."
    ),
    "MPL-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "LGPL-2.1-notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
        "your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "Lesser General Public License for more details. You should have received a copy of the GNU Lesser General Public "
        "License along with this library; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth "
        "Floor, Boston, MA 02110-1301 USA"
    ),
    "AGPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "Affero General Public License for more details. You should have received a copy of the GNU Affero General Public "
        "License along with this program. If not, see <https://www.gnu.org/licenses/>."
    ),
}


def folder_templates(spark: SparkSession, path: str) -> DataFrame:
    """Templates from text files, one license each, such as the whole texts of the longer ones; the file's name is the id."""
    return spark.read.text(path, wholetext=True).select(F.regexp_extract("_metadata.file_name", r"^(.*?)(\.txt)?$", 1).alias("template_id"), F.col("value").alias("text"))


def default_templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TEMPLATES.items()), "template_id string, text string")


def winnow(hashes: np.ndarray, window: int = WINNOW) -> list[int]:
    """Places of the rightmost least hash of every ``window`` in a row; of all if there are fewer."""
    out = []
    for start in range(max(1, len(hashes) - window + 1)):
        part = hashes[start : start + window]
        at = start + len(part) - 1 - int(np.argmin(part[::-1]))
        if not out or out[-1] != at:
            out.append(at)
    return out


@dataclass
class Match:
    template: int
    covered: int  # template words that are aligned with an equal word
    start: int  # document words [start, end)
    end: int


class TemplateIndex:
    """Inverted index from winnowed runs of words to templates."""

    def __init__(self, templates: list[list[bytes]]):
        self.templates = templates
        self.numbers: dict[bytes, int] = {}
        for words in templates:
            for word in words:
                self.numbers.setdefault(word, len(self.numbers) + 1)
        self.coded = [np.array([self.numbers[w] for w in words], np.int64) for words in templates]
        self.index: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for t, code in enumerate(self.coded):
            runs = self._runs(code)
            for at in winnow(mix(runs)):
                self.index[int(runs[at])].append((t, at))

    def _runs(self, code: np.ndarray) -> np.ndarray:
        """Each run of ``GRAM`` words as one number; 0 if it holds a word that no template has."""
        base = np.uint64(len(self.numbers) + 1)
        parts = [code[k : len(code) - GRAM + 1 + k].astype(np.uint64) for k in range(GRAM)]
        value = parts[0]
        for part in parts[1:]:
            value = value * base + part
        return np.where(np.logical_and.reduce([p > 0 for p in parts]), value, np.uint64(0))

    def chains(self, code: np.ndarray) -> list[tuple[int, float, list[tuple[int, int]]]]:
        """(template, score, hits) of the chains of hits, best first within a template; no hit is in two of them.

        A hit is (document word, template word).
        """
        runs = self._runs(code)
        places: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for at in np.flatnonzero(runs).tolist():
            for template, place in self.index.get(int(runs[at]), ()):
                places[template].append((at, place))
        out = []
        for template, hits in places.items():
            out += [(template, score, chain) for score, chain in _chains(hits, len(self.coded[template]))]
        return out

    def scan(self, words: list[bytes], min_coverage: float = MIN_COVERAGE, min_matched: int = MIN_MATCHED) -> list[Match]:
        """Matches with enough coverage or enough words, by start.

        Where spans overlap by half of one or more, the match with more matched less missing
        words stays; equal ones all do.
        """
        if len(words) < GRAM:
            return []
        get = self.numbers.get
        code = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        counts = np.bincount(code, minlength=len(self.numbers) + 1)
        found, most = [], {}
        for template, score, hits in self.chains(code):
            own = self.coded[template]
            if template not in most:  # words that the document has at all
                distinct, wanted = np.unique(own, return_counts=True)
                most[template] = int(np.minimum(counts[distinct], wanted).sum())
            if score < min_matched and most[template] < min_coverage * len(own):
                continue
            covered, start, end = align(own, code, hits)
            if covered >= min_coverage * len(own) or score >= min_matched:
                found.append(Match(template, covered, start, end))
        size = [len(t) for t in self.templates]
        rank = lambda m: (size[m.template] - 2 * m.covered, m.start, m.end)
        found.sort(key=lambda m: (*rank(m), m.template))
        kept: list[Match] = []
        for m in found:
            inside = lambda k: 2 * (min(m.end, k.end) - max(m.start, k.start)) >= min(m.end - m.start, k.end - k.start)
            if all(not inside(k) or (k.template != m.template and rank(k) == rank(m)) for k in kept):
                kept.append(m)
        return sorted(kept, key=lambda m: (m.start, m.template))


def _segments(hits: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Hits of one diagonal whose words touch, or leave no room for a kept run between them; in document order."""
    by_diagonal = sorted(hits, key=lambda h: (h[0] - h[1], h[0]))
    out: list[list[tuple[int, int]]] = []
    for hit in by_diagonal:
        last = out[-1][-1] if out else None
        if last and hit[0] - hit[1] == last[0] - last[1] and hit[0] - last[0] < GRAM + WINNOW:
            out[-1].append(hit)
        else:
            out.append([hit])
    return sorted(out)


def _chains(hits: list[tuple[int, int]], size: int) -> list[tuple[float, list[tuple[int, int]]]]:
    """(score, hits) of the chains of one template of ``size`` words, best first.

    A segment follows the one that gives the best sum of new template words less the price of the
    jump.  A chain is worth ``size`` at most, so a jump of more than ``size * REACH`` never pays, and only
    segments that end within that reach are asked.
    """
    segments = _segments(hits)
    at, place = np.array([x[0] for x in segments]).T
    end_at, end_place = np.array([x[-1] for x in segments]).T + GRAM
    own = np.array([GRAM + sum(min(GRAM, b[1] - a[1]) for a, b in zip(x, x[1:])) for x in segments], float)
    score, before = own.copy(), np.full(len(segments), -1)
    first = np.searchsorted(at, at - (REACH + 2) * size)
    for j in range(1, len(segments)):
        i = slice(first[j], j)
        jump = np.abs((at[j] - place[j]) - (at[i] - place[i]))
        overlap = np.maximum(np.maximum(end_place[i] - place[j], end_at[i] - at[j]), 0)
        follows = (at[i] < at[j]) & (place[i] < place[j]) & (end_at[i] < end_at[j]) & (end_place[i] < end_place[j])
        gain = score[i] - overlap - JUMP * np.log2(1 + jump) - jump / REACH
        gain = np.where(follows, gain, 0)
        if len(gain) and gain.max() > 0:
            k = int(np.argmax(gain))
            score[j], before[j] = own[j] + gain[k], first[j] + k
    used, out = np.zeros(len(segments), bool), []
    for end in np.argsort(-score, kind="stable").tolist():
        chain, k = [], end
        while k >= 0 and not used[k]:
            used[k] = True
            chain.append(k)
            k = int(before[k])
        if chain:
            kept: list[tuple[int, int]] = []
            for hit in (h for k in reversed(chain) for h in segments[k]):
                if not kept or (hit[0] - hit[1] == kept[-1][0] - kept[-1][1] or (hit[0] >= kept[-1][0] + GRAM and hit[1] >= kept[-1][1] + GRAM)):
                    kept.append(hit)
            out.append((float(score[end] - (score[k] if k >= 0 else 0)), kept))
    return out


def _common(a: np.ndarray, b: np.ndarray, below: int, above: int | None = None) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` and each prefix of ``b``, the empty one first.

    Words are matched in a band only: word i of ``a`` with words i - ``below`` to i + ``above`` of ``b``.
    """
    row, above = np.zeros(len(b) + 1, np.int64), below if above is None else above
    for i, word in enumerate(a.tolist()):
        lo, hi = min(len(b), max(0, i - below)), min(len(b), i + above + 1)
        if lo < hi:
            new = np.maximum(row[lo + 1 : hi + 1], row[lo:hi] + (b[lo:hi] == word))
            row[lo + 1 : hi + 1] = np.maximum.accumulate(np.maximum(new, row[lo]))
    return np.maximum.accumulate(row)


def align(template: np.ndarray, code: np.ndarray, hits: list[tuple[int, int]]) -> tuple[int, int, int]:
    """Best alignment through the hits of a chain: equal words, first and last document word.

    Between two hits the band holds the diagonals of both and ``BAND`` more to each side; beyond the ends it is
    ``BAND`` wide on each side.  Ends of the template may stay unaligned, as 2 for equal words and -1 for
    each other word decides; the document's are free.
    """
    first, last = hits[0], hits[-1]
    covered, done_at, done_place = 0, *first
    for at, place in hits:
        if at > done_at:  # words between two hits; what follows on the same diagonal has none
            more = (at - done_at) - (place - done_place)
            band = BAND + max(0, -more), BAND + max(0, more)
            covered += int(_common(template[done_place:place], code[done_at:at], *band)[-1])
        new = min(GRAM, place + GRAM - done_place)
        covered, done_at, done_place = covered + new, at + GRAM, place + GRAM

    def beyond(own: np.ndarray, near: np.ndarray) -> tuple[int, int]:
        """Equal words and document words of the best way on from an end."""
        same = _common(own, near[: len(own) + BAND], BAND)
        k = int(np.argmax(4 * same - np.arange(len(same))))
        return int(same[k]), k

    more, left = beyond(template[: first[1]][::-1], code[: first[0]][::-1])
    also, right = beyond(template[last[1] + GRAM :], code[last[0] + GRAM :])
    return covered + more + also, first[0] - left, last[0] + GRAM + right


_built: dict[str, TemplateIndex] = {}


def scan_licenses(
    docs: DataFrame, templates: DataFrame, min_coverage: float = MIN_COVERAGE, min_matched: int = MIN_MATCHED
) -> DataFrame:
    """One row per match: doc_id, template_id, coverage, matched words, and the span in code points.

    Parts with less than ``min_coverage`` have rows too if their unchanged runs have ``min_matched`` words.

    ``templates`` has ``template_id`` and ``text``; texts of fewer than three words are refused.
    A null or empty document has no matches, repeated rows give repeated matches, and
    templates with equal words are all reported.  A text of any length takes time in proportion to its hits.
    """
    rows = [(r["template_id"], r["text"] or "") for r in templates.select("template_id", "text").orderBy("template_id").collect()]
    if sum(len(t) for _, t in rows) > TEMPLATE_CHARS:
        raise ValueError(f"templates have more than {TEMPLATE_CHARS} characters together; scan them in parts")
    if short := [i for i, t in rows if len(normal_words(t)) < GRAM]:
        raise ValueError(f"templates {short} have fewer than {GRAM} words")
    sent, key = docs.sparkSession.sparkContext.broadcast(rows), uuid.uuid4().hex
    schema = "doc_id long, template_id string, coverage double, n_matched long, start long, end long"

    def run(batches):
        if key not in _built:
            _built.clear()
            _built[key] = TemplateIndex([normal_words(t) for _, t in sent.value])
        index = _built[key]
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                matches = index.scan(normal_words(text), min_coverage, min_matched)
                at = [m.span() for m in _WORD.finditer(text)] if matches else []
                for m in matches:
                    n = len(index.templates[m.template])
                    out.append((doc_id, sent.value[m.template][0], m.covered / n, m.covered, at[m.start][0], at[m.end - 1][1]))
            cols = list(zip(*out)) or [()] * 6
            types = c.arrow_types(schema)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, types)], names=[f.split()[0] for f in schema.split(", ")])

    return c.documents(docs).mapInArrow(run, schema)
