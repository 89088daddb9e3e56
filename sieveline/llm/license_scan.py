"""Licence scan by template markup.

A template is licence wording with markup: ``<<beginOptional>> ... <<endOptional>>`` may be left out, and
``<<var;name=...;most=N>>`` stands for up to N words of any kind.  It compiles into a token automaton, and a text is accepted
where the automaton reads consecutive words of it from a template's first word to its last: mandatory wording has to stand there
exactly.  The longest passage from a place counts, also among templates of one family.  Before an automaton runs, the start of the
template's longest mandatory phrase is looked for; only places near one are tried, which changes no result, as every accepted
passage holds that phrase.

Whole licences (``*-text``) are read from the stored texts, from the first to the last sentence of their terms.

One pass without a shuffle: a text is scanned inside its Arrow batch and nothing is kept between texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm.common import read

# Phrases and labels of the base scan.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

LICENSES = Path(__file__).parent / "licenses"


def whole_text(file: str, first: str, last: str) -> str:
    """The mandatory wording of a stored licence: from ``first`` to ``last``; titles and appendices may be left out."""
    text = " ".join((LICENSES / file).read_text().split())
    begin = text.index(first)
    return text[begin : text.index(last, begin) + len(last)]


def optional(text: str) -> str:
    return f"<<beginOptional>>{text}<<endOptional>>"


def var(name: str, most: int) -> str:
    return f"<<var;name={name};most={most}>>"


def gnu_notices(name: str, title: str, versions: tuple[str, ...]) -> dict[str, str]:
    """The notice that GNU licences ask for, of one version or of that and any later one."""
    found = {}
    for version in versions:
        said = version.removesuffix(".0") + (optional(".0") if version.endswith(".0") else "")
        start = f"redistribute it and/or modify it under the terms of the GNU {title} Public License"
        start += optional(f", version {said},") + " as published by the Free Software Foundation"
        found[f"{name}-{version}-or-later-notice"] = (
            f"{start}{optional(';')} either version {said} of the License, or {optional('(')}at your option{optional(')')} any later version"
        )
        found[f"{name}-{version}-only-notice"] = (
            f"redistribute it and/or modify it under the terms of the GNU {title} Public License as published by the Free Software"
            f" Foundation{optional(';')} {optional('only')} version {said} of the License",
            f"redistribute it and/or modify it under the terms of the GNU {title} Public License, version {said}, as published by the"
            " Free Software Foundation",
        )
    return found


def cc_notices(label: str, short: tuple[str, ...], long: str) -> dict[str, tuple[str, ...]]:
    start = f"Licensed under {optional('a ')}{optional('the ')}"
    tail = f"{optional(' International')}{optional(' Unported')}"
    names = [f"{start}{optional('Creative Commons ')}CC {s}{optional(' 4.0')}{optional(' 3.0')}{tail}" for s in short]
    return {label: (*names, f"{start}Creative Commons Attribution{long}{optional(' 4.0')}{optional(' 3.0')}{tail} {optional('Public ')}License")}


BSD_START = (
    f"Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
    f" conditions are met: {optional('1.')} Redistributions of source code must retain the above copyright notice, this list of conditions"
    f" and the following disclaimer. {optional('2.')} Redistributions in binary form must reproduce the above copyright notice, this list of"
    " conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
BSD_NAMES = (
    f" {optional('3.')} Neither the name of {var('holder', 15)} nor the names of {var('its', 2)} contributors may be used to endorse or"
    " promote products derived from this software without specific prior written permission."
)
BSD_END = (
    f" THIS SOFTWARE IS PROVIDED BY {var('holders', 12)} \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO,"
    " THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL"
    f" {var('holders', 12)} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT"
    " NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER"
    " CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING"
    " IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE"
)
IS_KIND = optional(f"This {var('kind', 3)} is ")

#: Label and template, or templates, of the notices and whole licences the scan knows.  Where several of one family (the label's
#: first word) are read from the same word on, the longest passage gives the label.
TEMPLATES: dict[str, str | tuple[str, ...]] = {
    "apache-2.0-notice": f"Licensed under the {optional('terms of the ')}Apache License{optional(', Version')} 2.0{optional(' (the License)')}",
    "apache-2.0-grant": f"you may not use this {var('thing', 3)} except in compliance with the License. You may obtain a copy of the License at"
    f" {optional('http')}{optional('https')}://{optional('www.')}apache.org/licenses/LICENSE-2.0{optional('.html')}{optional('.txt')} Unless required by"
    " applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT"
    " WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing"
    " permissions and limitations under the License",
    "apache-2.0-text": whole_text("Apache-2.0.txt", "TERMS AND CONDITIONS FOR USE", "any such warranty or additional liability."),
    "gpl-notice": f"{IS_KIND}licensed under the {optional('terms of the ')}GNU General Public License{optional(', version ' + var('version', 1))}",
    "lgpl-notice": tuple(
        f"{IS_KIND}licensed under the {optional('terms of the ')}GNU {name} General Public License{optional(', version ' + var('version', 2))}"
        for name in ("Lesser", "Library")
    ),
    "agpl-notice": f"{IS_KIND}licensed under the {optional('terms of the ')}GNU Affero General Public License{optional(', version ' + var('version', 1))}",
    **gnu_notices("gpl", "General", ("2.0", "3.0")),
    **gnu_notices("lgpl", "Lesser General", ("2.1", "3.0")),
    **gnu_notices("agpl", "Affero General", ("3.0",)),
    "gpl-2.0-text": whole_text("GPL-2.txt", "The licenses for most software", "POSSIBILITY OF SUCH DAMAGES."),
    "gpl-3.0-text": whole_text("GPL-3.txt", "The GNU General Public License is a free", "in return for a fee."),
    "lgpl-2.1-text": whole_text("LGPL-2.1.txt", "The licenses for most software", "SUCH DAMAGES."),
    "lgpl-3.0-text": whole_text("LGPL-3.txt", "This version of the GNU Lesser", "you to choose that version for the Library."),
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
    f" distributed with this file, You can obtain one at {optional('http')}{optional('https')}://{optional('www.')}mozilla.org/MPL/2.0",
    "mpl-2.0-text": whole_text("MPL-2.0.txt", "1. Definitions", "Exhibit B of this License must be attached."),
    "mit-notice": (f"{IS_KIND}Released under the MIT License", f"{IS_KIND}licensed under the {optional('terms of the ')}MIT License"),
    "mit-text": f"Permission is hereby granted, free of charge, to any person obtaining a copy of {var('subject', 12)} to deal in the"
    f" {var('thing', 4)} without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute,"
    f" sublicense, and/or sell copies of the {var('thing', 4)} and to permit persons to whom the {var('thing', 4)} is furnished to do so,"
    f" subject to the following conditions: The above copyright notice and this permission notice {optional('(including the next paragraph)')}"
    f" shall be included in all copies or substantial portions of the {var('thing', 4)} THE {var('thing', 4)} IS PROVIDED \"AS IS\", WITHOUT"
    " WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR"
    f" PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL {var('holders', 12)} BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN"
    f" AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE {var('thing', 4)} OR THE USE OR OTHER"
    f" DEALINGS IN THE {var('thing', 4)}",
    "isc-text": f"Permission to use, copy, modify, and{optional('/or')} distribute this software for any purpose with or without fee is hereby"
    " granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\""
    f" AND {var('holder', 12)} DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND"
    f" FITNESS. IN NO EVENT SHALL {var('holder', 12)} BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES"
    " WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,"
    " ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE",
    "bsd-2-clause-text": BSD_START + BSD_END,
    "bsd-3-clause-text": BSD_START + BSD_NAMES + BSD_END,
    "cc0-1.0-text": whole_text("CC0-1.0.txt", "The laws of most jurisdictions", "this CC0 or use of the Work."),
    **cc_notices("cc-by-notice", ("BY",), ""),
    **cc_notices("cc-by-nc-notice", ("BY-NC",), "-NonCommercial"),
    **cc_notices("cc-by-sa-notice", ("BY-SA",), "-ShareAlike"),
    **cc_notices("cc-by-nd-notice", ("BY-ND",), "-NoDerivatives"),
    **cc_notices("cc-by-nc-sa-notice", ("BY-NC-SA",), "-NonCommercial-ShareAlike"),
    **cc_notices("cc-by-nc-nd-notice", ("BY-NC-ND",), "-NonCommercial-NoDerivatives"),
}

#: Everything that parts words becomes a blank, A-Z become lower case; bytes over 127 belong to words.
_FOLD = bytes(
    c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else c + 32 if 65 <= c <= 90 else 32 for c in range(256)
)
_MARK = re.compile(r"<<(beginOptional|endOptional|var)((?:;[^;>]*)*)>>")
ANY = None
#: Words of the longest mandatory phrase that are looked for.
ANCHOR = 12


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


@dataclass
class Automaton:
    """``steps[s]``: (word or ANY, next state) pairs; ``jumps[s]``: states reached without a word; the last state accepts."""

    label: str
    steps: list[list[tuple[bytes | None, int]]]
    jumps: list[list[int]]
    phrase: bytes
    before: int

    def closed(self, states: set[int]) -> set[int]:
        todo, seen = list(states), set(states)
        while todo:
            for t in self.jumps[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return seen

    def longest_at(self, words: list[bytes], start: int) -> int:
        """Where the longest passage that begins at ``start`` ends; -1 if none is accepted."""
        states, last, end = self.closed({0}), len(self.steps) - 1, -1
        while states:
            if last in states:
                end = start
            if start >= len(words):
                break
            states = self.closed({t for s in states for w, t in self.steps[s] if w is ANY or w == words[start]})
            start += 1
        return end

    def passages(self, words: list[bytes], joined: bytes) -> Iterator[tuple[int, int]]:
        """(start, end) of the longest accepted passage from each place that has one.  ``joined``: the words with a blank around each."""
        at, tried, place, counted = joined.find(self.phrase), -1, 0, 0
        while at >= 0:
            place += joined.count(b" ", counted, at)
            counted = at
            for start in range(max(0, place - self.before, tried + 1), place + 1):
                end = self.longest_at(words, start)
                if end >= 0:
                    yield start, end
            tried = place
            at = joined.find(self.phrase, at + 1)

    def found_in(self, words: list[bytes], joined: bytes) -> bool:
        return any(True for _ in self.passages(words, joined))


def compile_template(label: str, template: str) -> Automaton:
    """The automaton of a template; needs one mandatory word at least, and markup that closes."""
    steps: list[list[tuple[bytes | None, int]]] = [[]]
    jumps: list[list[int]] = [[]]
    opened: list[int] = []
    phrases: list[tuple[list[bytes], int]] = [([], 0)]
    read_words = 0  # words that may stand before this place, at most

    def state() -> int:
        steps.append([])
        jumps.append([])
        return len(steps) - 1

    def cut() -> None:
        phrases.append(([], read_words))

    at = 0
    for mark in [*_MARK.finditer(template), None]:
        for word in words_of(template[at : mark.start() if mark else None]):
            here = len(steps) - 1
            steps[here].append((word, state()))
            if not opened:
                phrases[-1][0].append(word)
            read_words += 1
        if mark is None:
            break
        at = mark.end()
        if mark[1] == "var":
            most = re.search(r";most=(\d+)", mark[2])
            entry = len(steps) - 1
            ends = [entry]
            for _ in range(int(most[1]) if most else 1):
                here = len(steps) - 1
                steps[here].append((ANY, state()))
                ends.append(len(steps) - 1)
                read_words += 1
            out = state()
            for s in ends:
                jumps[s].append(out)
        elif mark[1] == "beginOptional":
            opened.append(len(steps) - 1)
        else:
            if not opened:
                raise ValueError(f"{label}: an optional region ends that never began")
            begin, end = opened.pop(), len(steps) - 1
            out = state()
            jumps[end].append(out)
            jumps[begin].append(out)
        cut()
    if opened:
        raise ValueError(f"{label}: an optional region does not end")
    phrase, before = max(phrases, key=lambda p: len(p[0]))
    if not phrase:
        raise ValueError(f"{label}: a template needs a mandatory word")
    return Automaton(label, steps, jumps, b" " + b" ".join(phrase[:ANCHOR]) + b" ", before)


def scan(text: str | None, automata: list[Automaton], phrases: dict[bytes, str]) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of a whole text.

    The score is 1 if a template accepts a passage, 0.5 if only a phrase is found, else 0.
    """
    words = words_of(text)
    joined = b" " + b" ".join(words) + b" "
    places: list[int] = []
    base = set()
    for phrase, label in phrases.items():
        at, place, counted = joined.find(phrase), 0, 0
        while at >= 0:
            place += joined.count(b" ", counted, at)
            counted = at
            places.append(place)
            base.add(label)
            at = joined.find(phrase, at + 1)
    read: dict[tuple[str, int], tuple[int, str]] = {}
    for a in automata:
        family = a.label.split("-")[0]
        for start, end in a.passages(words, joined):
            read[family, start] = max(read.get((family, start), (-1, "")), (end, a.label))
    own = {label for _, label in read.values()}
    score = 1.0 if own else 0.5 if base else 0.0
    return (
        len(words), len(places), min(places, default=None), max(places, default=None),
        ",".join(sorted(base)), ",".join(sorted(base | own)), score,
    )


SCHEMA = {
    "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
    "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(),
}
SQL_TYPES = {pa.int64(): "bigint", pa.string(): "string", pa.float64(): "double"}


def scan_licenses(
    docs: DataFrame, templates: dict[str, str | tuple[str, ...]] = TEMPLATES, phrases: dict[str, str] = PHRASES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Licence labels of every row's whole text.

    Defined cases: a null or empty text has no words, no labels (empty strings) and null places; a null id stays null;
    repeated rows give repeated rows; places of different phrases may overlap and all count; a very long text is scanned whole, in
    time that grows with its length; an empty table gives no rows;
    other columns are not read, so their names cannot clash.
    """
    automata = [compile_template(label, t) for label, ts in templates.items() for t in ([ts] if isinstance(ts, str) else ts)]
    folded = {b" " + b" ".join(words_of(p)) + b" ": label for p, label in phrases.items()}
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(zip(*[scan(t.as_py(), automata, folded) for t in batch.column(1)])) or [()] * len(SCHEMA)
            arrays = [pa.array(c, k) for c, k in zip(columns, SCHEMA.values())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", *SCHEMA])

    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(scanned, f"doc_id {kind}, " + ", ".join(f"{n} {SQL_TYPES[k]}" for n, k in SCHEMA.items()))


def op8_template_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence labels of every document."""
    return scan_licenses(read(spark, sf_dir, "documents"))


def sql_pattern(template: str) -> str:
    """A template as a regular expression over words that each end in a blank."""
    found, at = [], 0
    for mark in [*_MARK.finditer(template), None]:
        found += [word.decode() + " " for word in words_of(template[at : mark.start() if mark else None])]
        if mark is not None:
            at = mark.end()
            most = re.search(r";most=(\d+)", mark[2])
            found.append({"beginOptional": "(?:", "endOptional": ")?", "var": f"(?:[^ ]+ ){{0,{most[1] if most else 1}}}"}[mark[1]])
    return "".join(found)


def sql_templates() -> str:
    """Rows (label, pattern, longer) of the templates; passages of ``longer`` are read first and count for their own label alone."""
    patterns = {
        label: "(?:" + "|".join(sql_pattern(t) for t in ([ts] if isinstance(ts, str) else ts)) + ")" for label, ts in TEMPLATES.items()
    }
    rows = []
    for label, pattern in patterns.items():
        longer = label.replace("-only-", "-or-later-") if "-only-" in label else ""
        longer = [longer] if longer else []
        if label.startswith("cc-by"):
            own = label.removesuffix("notice")
            longer = [x for x in patterns if x != label and x.startswith(own)]
        after = f"' (?:{'|'.join(patterns[x] for x in longer)})'" if longer else "NULL"
        rows.append(f"('{label}', ' {pattern}', {after})")
    return ",\n           ".join(rows)


#: The templates are read there by regular expressions instead of automata.
OP8_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), phrases(phrase, label) AS (
    VALUES (['gnu', 'general', 'public', 'license'], 'gpl'), (['apache', 'license'], 'apache'), (['cc', 'by'], 'cc-by'), (['mit', 'license'], 'mit')
), places AS (
    SELECT r, label, i - 1 AS place
    FROM (SELECT r, w, label, phrase, unnest(range(1, len(w) - len(phrase) + 2)) AS i FROM d, phrases)
    WHERE w[i:i + len(phrase) - 1] = phrase
), base AS (
    SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS labels FROM places GROUP BY r
), templates(label, pattern, longer) AS (
    VALUES @templates
), own AS (
    SELECT r, list(label) AS labels
    FROM (SELECT r, ' ' || array_to_string(w, ' ') || ' ' AS j FROM d), templates
    WHERE regexp_matches(CASE WHEN longer IS NULL THEN j ELSE regexp_replace(j, longer, ' ', 'g') END, pattern) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_concat(coalesce(base.labels, []), coalesce(own.labels, []))), ','), '') AS labels,
       CASE WHEN own.labels IS NOT NULL THEN 1.0 WHEN n_base IS NOT NULL THEN 0.5 ELSE 0.0 END::DOUBLE AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN own USING (r)
""".replace("@templates", sql_templates())
