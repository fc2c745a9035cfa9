"""License scan by template markup.

A template is wording with two kinds of regions: ``<<...>>`` is optional and
``[[n]]`` stands for up to n replaceable words. It is compiled to an automaton
over words. A place in a text is accepted where the mandatory wording matches
word for word, as optional parts come or stay away.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marketmill.llm.common import pieces

#: Phrases of the contract and their labels. Fixed values.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Disclaimers that several licenses share. Fixed values.
_AS_IS = (
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of "
    "merchantability fitness for a particular purpose and noninfringement in no event shall the <<authors or copyright holders|authors|"
    "copyright holders|copyright holders or contributors>> be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from "
    "out of or in connection with the software or the use or other dealings in the software"
)
_MIT_GRANT = (
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
    "<<the software>> to deal in the software without restriction including without limitation the rights to use copy modify merge "
    "publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so"
)
_ISC_GRANT = "permission to use copy modify and <<or>> distribute this software for any purpose with or without fee is hereby granted"
_ISC_AS_IS = (
    "the software is provided as is and [[6]] disclaims all warranties with regard to this software including all implied warranties of "
    "merchantability and fitness in no event shall [[6]] be liable for any special direct indirect or consequential damages or any "
    "damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action "
    "arising out of or in connection with the use or performance of this software"
)
_BSD_GRANT = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
    "conditions are met <<1|a>> redistributions of source code must retain the above copyright notice this list of conditions and the "
    "following disclaimer <<2|b>> redistributions in binary form must reproduce the above copyright notice this list of conditions and "
    "the following disclaimer in the documentation and or other materials provided with the distribution"
)
_BSD_NAME = (
    "neither the <<name|names>> of [[12]] nor the names of <<its|their|the|other>> contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission"
)
_BSD_AS_IS = (
    "this software is provided by [[12]] as is and any express or implied warranties including but not limited to the implied "
    "warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall [[12]] be liable for any "
    "direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods "
    "or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract "
    "strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of "
    "the possibility of such damage"
)
_GNU_HOPE = (
    "<<[[4]] is distributed in the hope that it will be useful but without any warranty without even the implied warranty of "
    "merchantability or fitness for a particular purpose see the gnu <<lesser>> general public license for more details>>"
)


def _gnu(version: str, lesser: str = "") -> str:
    return (
        f"<<[[4]] is>> free software you can redistribute it and or modify it under the terms of the gnu {lesser}general public license as "
        f"published by the free software foundation <<either>> version {version} <<1|0>> <<of the license>> <<or at your option any later version>> {_GNU_HOPE}"
    )


#: Wording of public licenses, whole, and of the notices that usually name them. Fixed values.
TEMPLATES = {
    "mit": [
        "<<released|licensed|available|distributed>> under the <<terms of the>> mit license",
        f"{_MIT_GRANT} subject to the following conditions the above copyright notice and this permission notice "
        f"<<including the next paragraph>> shall be included in all copies or substantial portions of the software {_AS_IS}",
    ],
    "mit-0": [f"{_MIT_GRANT} {_AS_IS}"],
    "apache-2": [
        "licensed under the apache license <<version>> 2 <<0>>",
        "licensed under the apache license version 2 0 <<the license>> you may not use this <<file|work|software>> except in compliance with the license "
        "you may obtain a copy of the license at [[8]] unless required by applicable law or agreed to in writing software distributed "
        "under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the "
        "license for the specific language governing permissions and limitations under the license",
    ],
    "cc-by-nc": [
        "<<licensed under|released under>> <<a|the>> <<creative commons>> cc by nc <<[[1]] 0>>",
        "creative commons attribution <<noncommercial|non commercial>> noncommercial [[2]] license",
    ],
    "gpl-2": [_gnu("2")],
    "gpl-3": [
        "<<this [[3]] is>> licensed under the gnu general public license <<as published by the free software foundation>> "
        "<<either>> version 3 <<of the license or at your option any later version>>",
        _gnu("3"),
    ],
    "lgpl-2": [_gnu("2", "lesser ")],
    "lgpl-3": [_gnu("3", "lesser ")],
    "bsd-2-clause": [f"{_BSD_GRANT} {_BSD_AS_IS}"],
    "bsd-3-clause": [f"{_BSD_GRANT} <<3|c>> {_BSD_NAME} {_BSD_AS_IS}"],
    "bsd-4-clause": [
        f"{_BSD_GRANT} <<3|c>> all advertising materials mentioning features or use of this software must display the following "
        f"acknowledgement this product includes software developed by [[20]] <<4|d>> {_BSD_NAME} {_BSD_AS_IS}"
    ],
    "isc": [f"{_ISC_GRANT} provided that the above copyright notice and this permission notice appear in all copies {_ISC_AS_IS}"],
    "0bsd": [f"{_ISC_GRANT} {_ISC_AS_IS}"],
    "zlib": [
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any "
        "damages arising from the use of this software permission is granted to anyone to use this software for any purpose including "
        "commercial applications and to alter it and redistribute it freely subject to the following restrictions <<1>> the origin of "
        "this software must not be misrepresented you must not claim that you wrote the original software if you use this software in a "
        "product an <<acknowledgment|acknowledgement>> in the product documentation would be appreciated but is not required <<2>> altered "
        "source versions must be plainly marked as such and must not be misrepresented as being the original software <<3>> this notice "
        "may not be removed or altered from any source distribution"
    ],
    "unlicense": [
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or "
        "distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by "
        "any means in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright "
        "interest in the software to the public domain we make this dedication for the benefit of the public at large and to the detriment "
        "of our heirs and successors we intend this dedication to be an overt act of relinquishment in perpetuity of all present and "
        f"future rights to this software under copyright law {_AS_IS}"
    ],
    "all-rights-reserved": ["<<copyright [[8]]>> all rights reserved"],
}

# A-Z to a-z; all other ASCII but digits and letters separates words
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words(text: str) -> list[bytes]:
    """Words of a text as UTF-8, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


class Automaton:
    """States are positions of a template; edges read one word or none."""

    def __init__(self, template: str):
        self.edges: list[dict[bytes, set[int]]] = []
        self.any: list[set[int]] = []
        self.free: list[set[int]] = []
        here, self.anchor = self._state(), []
        self.start, best = here, []
        tokens = re.findall(r"<<|>>|\[\[\d+\]\]|\||[^\s<>\[\]|]+", template)
        opened: list[list] = []
        for tok in tokens:
            if tok == "<<":
                opened.append([here, self._state(), []])
                best.append([])
                here = self._next_branch(opened[-1])
            elif tok == "|":
                opened[-1][2].append(here)
                here = self._next_branch(opened[-1])
            elif tok == ">>":
                start, end, ends = opened.pop()
                for s in (start, here, *ends):
                    self.free[s].add(end)
                here = end
            elif tok.startswith("[["):
                end = self._state()
                self.free[here].add(end)
                for _ in range(int(tok[2:-2])):
                    after = self._state()
                    self.any[here].add(after)
                    self.free[after].add(end)
                    here = after
                here = end
                best.append([])
            else:
                after = self._state()
                self.edges[here].setdefault(tok.encode(), set()).add(after)
                here = after
                if not opened:
                    if not best:
                        best.append([])
                    best[-1].append(tok.encode())
                continue
            if not opened:
                best.append([])
        self.final = here
        #: longest mandatory wording without a region in it: a text without it has no match
        self.anchor = max(best, key=len)
        first = self._closure({self.start})
        self.first = {w for s in first for w in self.edges[s]} if not any(self.any[s] for s in first) else None
        self.n_states = len(self.edges)

    def _state(self) -> int:
        self.edges.append({})
        self.any.append(set())
        self.free.append(set())
        return len(self.edges) - 1

    def _next_branch(self, group: list) -> int:
        s = self._state()
        self.free[group[0]].add(s)
        return s

    def _closure(self, states: set[int]) -> set[int]:
        todo, out = list(states), set(states)
        while todo:
            for t in self.free[todo.pop()] - out:
                out.add(t)
                todo.append(t)
        return out

    def match(self, text: list[bytes], at: int) -> int | None:
        """End of the longest match that begins at a word, or None."""
        now, end = self._closure({self.start}), None
        while True:
            if self.final in now:
                end = at
            if at == len(text):
                return end
            after = set()
            for s in now:
                after |= self.edges[s].get(text[at], set()) | self.any[s]
            if not after:
                return end
            now, at = self._closure(after), at + 1


@functools.lru_cache(maxsize=1)
def automata() -> list[tuple[str, Automaton]]:
    return [(label, Automaton(t)) for label, ts in TEMPLATES.items() for t in ts]


def _places(joined: bytes, phrase: bytes) -> Iterator[int]:
    """Offsets at which the words of a phrase stand in a text joined and framed by blanks."""
    needle, at = b" " + phrase + b" ", joined.find(b" " + phrase + b" ")
    while at >= 0:
        yield at
        at = joined.find(needle, at + 1)


def scan_text(text: str) -> dict:
    """Base places, labels and accepted spans (word offsets) of one text."""
    ws = words(text)
    out = {"n_words": len(ws), "base": [], "labels": set(), "spans": []}
    if not ws:
        return out
    joined = b" " + b" ".join(ws) + b" "
    covered = []
    at_word = None

    def word_of(offset: int) -> int:
        nonlocal at_word
        if at_word is None:  # only texts with a find pay for it
            at_word = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        return int(np.searchsorted(at_word, offset))

    for phrase, label in PHRASES.items():
        for offset in _places(joined, phrase.encode()):
            start = word_of(offset)
            out["base"].append((start, label))
            covered.append((start, start + len(phrase.split())))
    for label, a in automata():
        anchor = b" ".join(a.anchor)
        reach = a.n_states
        done = -1
        for offset in _places(joined, anchor):
            here = word_of(offset)
            # a match lies around its anchor, and is no longer than the automaton
            for start in range(max(done, here - reach, 0), here + 1):
                if a.first is not None and ws[start] not in a.first:
                    continue
                end = a.match(ws, start)
                if end is not None and end >= here + len(a.anchor):
                    out["labels"].add(label)
                    out["spans"].append((label, start, end))
                    covered.append((start, end))
                    done = end
                    break
    filled = last = 0
    for start, end in sorted(covered):
        filled += max(0, end - max(start, last))
        last = max(last, end)
    out["score"] = filled / len(ws)
    return out


SPAN = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
FIELDS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_base", T.LongType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("base_labels", T.StringType()),
        T.StructField("labels", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("license_spans", SPAN),
    ]
)


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, n_words, n_base, first_word, last_word, base_labels, labels, score, license_spans.

    ``score`` is the share of a text's words inside phrases and accepted templates (0 to 1). Spans are
    (label, start, end) in words, end exclusive. A null or empty text has no words, no
    places, empty labels and score 0. Repeated rows and ties give equal results, texts are read whole however long, and an
    empty table gives no rows. Other input columns are not returned, whatever their names. Only a
    text's own words are read, so nothing is shuffled.
    """
    out = T.StructType([T.StructField("__id", docs.schema[id_col].dataType), *FIELDS])

    def row(text: str) -> tuple:
        r = scan_text(text)
        at = [s for s, _ in r["base"]]
        base = {label for _, label in r["base"]}
        return (
            r["n_words"], len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | r["labels"])), r.get("score", 0.0),
            [{"label": a, "start": s, "end": e} for a, s, e in sorted(r["spans"], key=lambda x: x[1:])],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(out)
        for batch in pieces(batches):
            cols = zip(*[row(t or "") for t in batch.column(1).to_pylist()])
            arrays = [batch.column(0).cast(target.field(0).type)]
            arrays += [pa.array(list(c), type=f.type) for c, f in zip(cols, list(target)[1:])]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return docs.select(id_col, text).mapInArrow(work, out).withColumnRenamed("__id", id_col)
