"""License scan: templates with optional and replaceable regions as token automata.

A template is wording with ``[[`` ``]]`` around a part that may be missing and
``<<n>>`` for up to ``n`` words of any kind (a name, a year), ``<<*>>`` for as many as
stand before the next mandatory words (a holder).  It is compiled to an
automaton over words: a state per word still to come, moves on one word or on any
word, and moves without a word past optional parts.  A text is accepted where a
stretch of its words runs through the automaton; all mandatory words then stand there
exactly, in order, with nothing else between them.  Words are lower-cased runs of
letters and digits, so case, line breaks and punctuation do not matter.

The scan starts an automaton only where the template's rarest opening words stand, so
texts without license wording cost a substring search.  All states advance together,
one word at a time; a stretch is at most as long as its template allows.  Templates
with ``<<*>>`` are run once over the text from all their places together, as a stretch
has no greatest length there; it ends where the template is first complete.

Defined results: null and empty texts have no words, no labels and score 0; whole texts
are read; equal rows get equal results; an empty table gives an empty result; result
columns replace input columns of their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from trawl.llm.common import ALNUM_TABLE, free_name

#: Fixed values: (phrase, label) of the base rule.
PHRASES: tuple[tuple[str, str], ...] = (
    ("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"),
)

_MIT = (
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
    "files [[the software]] to deal in the software without restriction including without limitation the rights to use copy "
    "modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software "
    "is furnished to do so subject to the following conditions the above copyright notice and this permission notice "
    "[[including the next paragraph]] shall be included in all copies or substantial portions of the software the software is "
    "provided as is without warranty of any kind express or implied including but not limited to the warranties of "
    "merchantability fitness for a particular purpose and noninfringement in no event shall <<100>> be liable for any claim "
    "damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with "
    "the software or the use or other dealings in the software")
_BSD_CONDITIONS = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
    "conditions are met [[1]] [[a]] redistributions of source code must retain the above copyright notice this list of "
    "conditions and the following disclaimer [[2]] [[b]] redistributions in binary form must reproduce the above copyright "
    "notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the "
    "distribution")
_BSD_NAMES = (
    "[[3]] [[c]] neither the name of <<100>> nor the names of [[its]] contributors may be used to endorse or promote products "
    "derived from this software without [[specific]] prior written permission")
_BSD_DISCLAIMER = (
    "this software is provided by <<100>> as is and any express or implied warranties including but not limited to the implied "
    "warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall <<100>> be liable for "
    "any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of "
    "substitute goods or services loss of use data or profits or business interruption however caused and on any theory of "
    "liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the "
    "use of this software even if advised of the possibility of such damage")

_ISC = (
    "permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is hereby granted "
    "provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and "
    "<<100>> disclaims all warranties with regard to this software including all implied warranties of merchantability and "
    "fitness in no event shall <<100>> be liable for any special direct indirect or consequential damages or any damages whatsoever "
    "resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out "
    "of or in connection with the use or performance of this software")
_ZLIB = (
    "this software is provided as is without any express or implied warranty in no event will <<100>> be held liable for any "
    "damages arising from the use of this software permission is granted to anyone to use this software for any purpose including "
    "commercial applications and to alter it and redistribute it freely subject to the following restrictions [[1]] the origin of "
    "this software must not be misrepresented you must not claim that you wrote the original software if you use this software in "
    "a product an acknowledgment in the product documentation would be appreciated but is not required [[2]] altered source "
    "versions must be plainly marked as such and must not be misrepresented as being the original software [[3]] this notice may "
    "not be removed or altered from any source distribution")

#: Spellings that count as the same wording.
EQUIVALENTS: tuple[tuple[str, str], ...] = (
    ("noninfringement", "non infringement"), ("sublicense", "sub license"), ("acknowledgment", "acknowledgement"),
)


def _spellings(label: str, wording: str) -> list[tuple[str, str]]:
    """The wording in each of its equivalent spellings."""
    found = [wording]
    for one, other in EQUIVALENTS:
        found += [w.replace(one, other) for w in found if one in w.split()]
    return [(label, w) for w in found]


#: (label, wording) of whole licenses.  Headings and copyright lines stand before the wording
#: and need no region; names of holders may have up to a hundred words.
TEXTS: tuple[tuple[str, str], ...] = tuple(x for label, wording in (
    ("mit", _MIT),
    ("isc", _ISC),
    ("zlib", _ZLIB),
    ("bsd", f"{_BSD_CONDITIONS} {_BSD_DISCLAIMER}"),
    ("bsd", f"{_BSD_CONDITIONS} {_BSD_NAMES} {_BSD_DISCLAIMER}"),
    ("bsd-3", f"{_BSD_CONDITIONS} {_BSD_NAMES} {_BSD_DISCLAIMER}"),
) for x in _spellings(label, wording))

#: Fixed values: (label, wording) of notice lines, which name a license without stating it.
NOTICES: tuple[tuple[str, str], ...] = (
    ("mit", "[[this <<3>> is]] released under the [[terms of the]] mit license"),
    ("mit", "[[this <<3>> is]] licensed under the [[terms of the]] mit license"),
    ("apache-2", "licensed under the apache license version 2 [[0]] [[the license]]"),
    ("apache-2", "[[you may obtain a copy of the license at]] [[http]] [[https]] www apache org licenses license 2 0"),
    ("gpl-3", "[[this <<3>> is]] licensed under the gnu general public license [[as published by the free software foundation]] "
              "[[either]] version 3 [[of the license]] [[or at your option any later version]]"),
    ("gpl-2", "[[this <<3>> is]] licensed under the gnu general public license [[as published by the free software foundation]] "
              "[[either]] version 2 [[of the license]] [[or at your option any later version]]"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license as published by the free "
            "software foundation"),
    ("lgpl", "[[this <<3>> is]] licensed under the gnu lesser general public license [[version <<2>>]]"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "[[this <<3>> is]] licensed under [[a]] [[the]] cc by nc [[4 0]] [[license]]"),
    ("cc-by", "[[this <<3>> is]] licensed under [[a]] [[the]] cc by 4 0 [[license]]"),
    ("cc-by-sa", "[[this <<3>> is]] licensed under [[a]] [[the]] cc by sa [[4 0]] [[license]]"),
    ("cc0", "to the extent possible under law <<100>> has waived all copyright and related or neighboring rights to"),
)

TEMPLATES = TEXTS + NOTICES

RESULT = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, matches array<struct<label:string,start:int,end:int>>")


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(ALNUM_TABLE).split()


class Automaton:
    """States 0..n; ``moves[s]`` lists (word or None for any word, next state) and
    ``free[s]`` the states reached without a word.  State ``n`` accepts."""

    def __init__(self, label: str, wording: str) -> None:
        self.label = label
        self.moves: list[list[tuple[bytes | None, int]]] = [[]]
        self.free: list[list[int]] = [[]]
        opened: list[int] = []
        run: list[bytes] = []
        runs: list[tuple[int, list[bytes]]] = []
        self.open = False
        for part in re.findall(r"\[\[|\]\]|<<\d+>>|<<\*>>|\w+", wording):
            if part == "[[":
                opened.append(self._last())
            elif part == "]]":
                self.free[opened.pop()].append(self._last())
            elif part == "<<*>>":
                self._add_free([self._last()])
                self.moves[-1].append((None, self._last()))
                self.open = True
            elif part.startswith("<<"):
                start = self._last()
                self._add_free([start, *(self._add(None) for _ in range(int(part[2:-2])))])
            else:
                self._add(part.encode())
            if part[0].isalnum() and not opened:
                if not self.open:
                    run.append(part.encode())
            elif run:
                runs.append((len(runs), run))
                run = []
        if run:
            runs.append((len(runs), run))
        self.accept = self._last()
        #: The longest row of mandatory words (before any open region): it stands in every accepted stretch.
        self.core = b" " + b" ".join(max((r for _, r in runs), key=len)) + b" "
        self.first_words = {w for s in self._closure({0}) for w, _ in self.moves[s]}
        if None in self.first_words:
            raise ValueError(f"a template must begin with a word: {wording}")
        self.longest = sum(1 for m in self.moves if m)

    def _last(self) -> int:
        return len(self.moves) - 1

    def _add(self, word: bytes | None) -> int:
        self.moves[-1].append((word, len(self.moves)))
        self.moves.append([])
        self.free.append([])
        return self._last()

    def _add_free(self, stops: list[int]) -> None:
        """A new state, reached without a word from each of ``stops``."""
        self.moves.append([])
        self.free.append([])
        for s in stops:
            self.free[s].append(self._last())

    def _closure(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in states:
                    states.add(s)
                    todo.append(s)
        return states

    def run(self, words: list[bytes], at: int) -> tuple[int, int]:
        """(end of the longest accepted stretch from ``at`` or -1, furthest state)."""
        states, end, far = self._closure({0}), -1, 0
        for i in range(at, len(words)):
            word = words[i]
            states = self._closure({t for s in states for w, t in self.moves[s] if w is None or w == word})
            if not states:
                break
            far = max(far, max(states))
            if self.accept in states:
                end = i + 1
        return end, far

    def sweep(self, words: list[bytes], starts: set[int]) -> tuple[list[tuple[int, int]], int]:
        """(accepted stretches (start, end), furthest state) of a template with open
        regions: all starts together, of each state only the latest start is kept."""
        found, far = [], 0
        live: dict[int, int] = {}
        at = min(starts, default=len(words))
        for i in range(at, len(words)):
            if i in starts:
                for s in self._closure({0}):
                    live[s] = i
            if not live:
                continue
            word, after = words[i], {}
            for s, start in live.items():
                for w, t in self.moves[s]:
                    if w is None or w == word:
                        for u in self._closure({t}):
                            after[u] = max(start, after.get(u, start))
            live = after
            if live:
                far = max(far, max(live))
            if self.accept in live:
                done = live[self.accept]
                found.append((done, i + 1))
                live = {s: start for s, start in live.items() if start > done}
        return found, far


@cache
def automata() -> tuple[Automaton, ...]:
    return tuple(Automaton(label, wording) for label, wording in TEMPLATES)


def _places(joined: bytes, needle: bytes) -> Iterator[int]:
    """Word numbers at which the blank-framed ``needle`` begins, overlaps included."""
    at, words, seen = joined.find(needle), 0, 0
    while at >= 0:
        words += joined.count(b" ", seen, at)
        seen = at
        yield words
        at = joined.find(needle, at + 1)


def template_matches(words: list[bytes], joined: bytes) -> tuple[list[tuple[str, int, int]], float]:
    """Accepted stretches (label, start, end) and the best share of a template's
    states that any stretch reached."""
    found: dict[tuple[str, int], int] = {}
    best = 0.0
    for a in automata():
        if a.open:
            starts = {s for core in _places(joined, a.core) for s in range(max(0, core - a.longest), core + 1)
                      if words[s] in a.first_words}
            ends, far = a.sweep(words, starts)
            best = max(best, far / a.accept)
            found.update(((a.label, end), start) for start, end in ends)
            continue
        for core in _places(joined, a.core):
            for start in range(max(0, core - a.longest), core + 1):
                if words[start] in a.first_words:
                    end, far = a.run(words, start)
                    best = max(best, far / a.accept)
                    if end > core:
                        best = 1.0
                        found[a.label, end] = min(start, found.get((a.label, end), start))
    return sorted((label, start, end) for (label, end), start in found.items()), best


def scan(text: str | None) -> tuple:
    """The values of ``RESULT`` for one text."""
    words = tokens(text)
    joined = b" " + b" ".join(words) + b" "
    places = [(w, label) for phrase, label in PHRASES for w in _places(joined, b" " + phrase.encode() + b" ")]
    matches, score = template_matches(words, joined)
    base = sorted({label for _, label in places})
    labels = sorted({*base, *(m[0] for m in matches)})
    starts = [w for w, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(base),
            ",".join(labels), 1.0 if base else score,
            [{"label": label, "start": s, "end": e} for label, s, e in matches])


def license_scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns of ``RESULT``; one pass over Arrow batches."""
    result = StructType.fromDDL(RESULT)
    own = {f.name.lower() for f in result}
    carried = [c for c in docs.columns if c.lower() not in own]
    source = docs.select(*carried, docs[text].alias(free_name(docs, "__scanned")))
    out = StructType([*docs.select(*carried).schema.fields, *result.fields])
    n_carried = len(carried)
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(
        pa.struct([("label", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [scan(x.as_py()) for x in b.column(n_carried)]
            cols = zip(*rows, strict=True) if rows else [()] * len(kinds)
            new = [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:n_carried], *new], names=[*out.names])

    return source.mapInArrow(run, out)
