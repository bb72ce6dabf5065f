"""Licence scans by patience alignment of texts with notice templates.

A text is a sequence of lower-cased words.  A template and a stretch of the text are aligned as patience
sorting does it: words that are unique in both are anchors, the longest increasing subsequence of
anchors is kept, and the gaps between anchors are aligned in the same way, after their equal beginnings and
ends.  Coverage is the share of the template's words that are aligned; from `least` on it is a match, if the stretch
from the first to the last of them holds at most (1 / least - 1) * n + 2 words more than the n of the template.

A match aligns at least one of any floor((1 - least) * n) + 1 words of the template.  Its words that are rarest among
templates, and aren't everyday ones, are markers; one Aho-Corasick automaton of all markers passes over each text, and
for every marker met the stretch that the template would cover around it is aligned, so what is found doesn't depend on
where in a text it stands.  Every part of a text that could match is aligned, however long the text.

A match also needs the words that tell a template from its siblings, all aligned: those that name the licence, and
those by which it differs from another template that would match it; no other word that names a licence may
stand within it, and none that negates it right before it.  Where matches overlap, that with the most aligned words, then the largest coverage, then the first
in name order stays.

Null and empty texts match nothing.  Repeated rows give repeated results.  An empty table gives no
rows.  Extra columns are ignored.
"""

from __future__ import annotations

import bisect
import itertools
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_parts, lean_worker

_WORD = re.compile(r"[a-z0-9]+(?:[.'+-][a-z0-9]+)*")

# fixed values: the usual notices of common licences, each with the words that name it
_NOTICES = {
    "Apache-2.0": ("apache 2.0", "Licensed under the Apache License, Version 2.0."),
    "Apache-2.0 header": ("apache 2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    "BSD-2-Clause text": ("", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    "BSD-3-Clause text": ("endorse", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    "BSD redistribution": ("", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    "CC0-1.0": ("cc0 1.0", "Released into the public domain under CC0 1.0 Universal."),
    "GPL header": ("gnu general", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    "ISC text": ("", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "MIT permission": ("", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    "MIT text": ("", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    "MPL-2.0": ("mozilla 2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    "Unlicense": ("unencumbered", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    "Zlib text": ("", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely"),
}
for _v in ("2.0", "3.0", "4.0"):
    for _k in ("BY", "BY-NC", "BY-NC-ND", "BY-NC-SA", "BY-ND", "BY-SA"):
        _NOTICES[f"CC-{_k}-{_v}"] = (f"cc {_k} {_v}", f"Licensed under CC {_k} {_v}.")
        _NOTICES[f"CC-{_k}-{_v} name"] = (f"cc-{_k} {_v}", f"CC-{_k} {_v}")
for _name, _kind, _v in (("AGPL-3.0", "Affero General", "3"), ("GPL-1.0", "General", "1"), ("GPL-2.0", "General", "2"), ("GPL-3.0", "General", "3"), ("LGPL-2.1", "Lesser General", "2.1"), ("LGPL-3.0", "Lesser General", "3")):
    _NOTICES[_name] = (f"gnu {_kind} {_v}", f"This work is licensed under the GNU {_kind} Public License, version {_v}.")
for _name in ("BSD", "ISC", "MIT", "X11", "Zlib"):
    _NOTICES[_name] = (_name, f"Released under the {_name} License.")

# fixed values: names of licences in machine-readable lines
for _name in "0BSD AGPL-3.0-only AGPL-3.0-or-later Apache-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 CC-BY-4.0 CC-BY-SA-4.0 CC0-1.0 EPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later MIT MPL-2.0 Unlicense Zlib".split():
    _NOTICES[f"{_name} (SPDX)"] = (_name, f"SPDX-License-Identifier: {_name}")
# fixed values: titles of licences' texts
for _name, _named, _title in (
    ("AGPL-3.0", "affero 3", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("Apache-2.0", "apache 2.0", "Apache License Version 2.0, January 2004"),
    ("EPL-2.0", "eclipse 2.0", "Eclipse Public License 2.0"),
    ("GPL-2.0", "gnu general 2", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "gnu general 3", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-2.1", "gnu lesser 2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "gnu lesser 3", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("MPL-2.0", "mozilla 2.0", "Mozilla Public License Version 2.0"),
):
    _NOTICES[f"{_name} title"] = (_named, _title)
for _v in ("2.0", "3.0"):
    for _then in ("only", "or later"):
        _NOTICES[f"GPL-{_v}-{_then.replace(' ', '-')} title"] = (f"gnu general v{_v} {_then}", f"GNU General Public License v{_v} {_then}")
for _k in ("Attribution", "Attribution-NonCommercial", "Attribution-NoDerivatives", "Attribution-ShareAlike"):
    _NOTICES[f"CC {_k} 4.0 title"] = (f"commons {_k} 4.0", f"Creative Commons {_k} 4.0 International License")
for _v in ("2", "3"):
    _NOTICES[f"GPL-{_v}.0 header"] = (f"gnu general {_v}", f"{_NOTICES['GPL header'][1]}, either version {_v} of the License, or (at your option) any later version.")

TEMPLATES = {name: text for name, (_, text) in _NOTICES.items()}
# words without which a notice names another licence or version
NAMING = {name: named for name, (named, _) in _NOTICES.items()}
# fixed values: other names that make a notice one of another licence
OTHERS = "artistic boost clear eclipse european expat library nonfree postgresql python ruby"
NEGATIONS = {"never", "nicht", "not"}  # right before a notice they say that it doesn't hold
EVERYDAY = "a above all an and any are as at by copies copy distribute following for free from in is it may must not of or other permission provided public released software that the this to use version with without you"


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of places of equal words, ascending in both."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        ca, cb = Counter(a[a0:a1]), Counter(b[b0:b1])
        at = {w: i for i, w in enumerate(b[b0:b1], b0) if cb[w] == 1 and ca[w] == 1}
        anchors = increasing([(i, at[w]) for i, w in enumerate(a[a0:a1], a0) if w in at])
        if anchors:
            out.extend(anchors)
            ends = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
            todo.extend((x + 1, u, y + 1, v) for (x, y), (u, v) in zip(ends, ends[1:]))
    return sorted(out)


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence, in order, whose second parts increase."""
    tops, piles, before = [], [], []
    for i, (_, y) in enumerate(pairs):
        p = bisect.bisect_left(tops, y)
        before.append(piles[p - 1] if p else -1)
        if p == len(tops):
            tops.append(y)
            piles.append(i)
        else:
            tops[p], piles[p] = y, i
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(pairs[i])
        i = before[i]
    return out[::-1]


class Scanner:
    def __init__(self, templates: dict[str, str], least: float):
        import ahocorasick

        self.least = least
        self.templates = {name: words(t) for name, t in sorted(templates.items()) if words(t)}
        self.naming: dict[str, set[int]] = {}
        self.names = set(words(OTHERS))
        for name, t in self.templates.items():
            named = set(words(NAMING.get(name, ""))) if t == words(TEMPLATES.get(name, "")) else set()
            self.names |= named - {"general"}  # a word of two families, and of theirs only
            self.naming[name] = {i for i, w in enumerate(t) if w in named}
            for other in self.templates.values():
                same = {i for i, _ in align(t, other)}
                if len(t) > len(same) >= least * max(len(t), len(other)):
                    self.naming[name] |= set(range(len(t))) - same
        common = Counter(w for t in self.templates.values() for w in set(t))
        everyday = set(words(EVERYDAY))
        self.markers: dict[str, list[tuple[str, int]]] = {}
        for name, t in self.templates.items():
            need = int((1 - least) * len(t) + 1e-9) + 1
            order = sorted(range(len(t)), key=lambda i: (t[i] in everyday, len(t[i]) < 3, common[t[i]], -len(t[i]), i))
            self.markers[name] = [(t[i], i) for i in order[:need]]
        self.wanted = {w for some in self.markers.values() for w, _ in some}
        self.automaton = ahocorasick.Automaton()
        for marker in self.wanted:
            self.automaton.add_word(marker, marker)
        self.automaton.make_automaton()

    def spare(self, n: int) -> int:
        """How many words more than a template of n words a match may hold."""
        return int(n / self.least + 1e-9) - n + 2

    def scan(self, text: str) -> list[tuple[str, float, int, int]]:
        """(licence, coverage, first word, end word) of each match, by place."""
        low = text.lower()
        if not self.templates or next(self.automaton.iter(low), None) is None:
            return []
        seen = _WORD.findall(low)
        places: dict[str, list[int]] = {}
        for i, w in enumerate(seen):
            if w in self.wanted:
                places.setdefault(w, []).append(i)
        found = []
        for name, t in self.templates.items():
            n = len(t)
            spare = self.spare(n)
            starts = {p - i - spare for w, i in self.markers[name] for p in places.get(w, ())}
            if not starts:
                continue
            own = set(t)
            held = list(itertools.accumulate((w in own for w in seen), initial=0))
            for at in sorted(starts):
                # with room for further words, and as long as the template, where words beside it can't hide anchors
                for a, b in ((at, at + n + 2 * spare), (at + spare, at + spare + n)):
                    a, b = max(0, a), min(len(seen), b)
                    if a < b and held[b] - held[a] >= self.least * n:
                        found.append(self._aligned(name, t, seen, a, b))
        kept: list[tuple[str, float, int, int]] = []
        for _, coverage, name, a, b in sorted(set(found) - {None}):
            if all(b <= x or a >= y for _, _, x, y in kept):
                kept.append((name, -coverage, a, b))
        return sorted(kept, key=lambda m: (m[2], m[0]))

    def _aligned(self, name: str, t: list[str], seen: list[str], a: int, b: int) -> tuple[int, float, str, int, int] | None:
        """(-aligned words, -coverage, name, first word, end word) if the stretch a..b holds a match."""
        pairs = align(t, seen[a:b])
        if len(pairs) < self.least * len(t) or not self.naming[name] <= {i for i, _ in pairs}:
            return None
        first, end = a + pairs[0][1], a + pairs[-1][1] + 1
        if end - first > len(t) + self.spare(len(t)):
            return None
        if first and seen[first - 1] in NEGATIONS:
            return None
        taken = {a + j for _, j in pairs}
        if any(seen[j] in self.names for j in range(first, end) if j not in taken):
            return None
        return -len(pairs), -len(pairs) / len(t), name, first, end


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, license, coverage, matches, first_word): per document and licence its best coverage, how often it
    occurs and the word it first starts at."""
    templates = TEMPLATES if templates is None else templates

    def scanned(batches):
        lean_worker()
        scanner = Scanner(templates, least)
        for batch in in_parts(batches):
            rows = []
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                best: dict[str, list] = {}
                for name, coverage, a, _ in scanner.scan(t or ""):
                    held = best.setdefault(name, [coverage, 0, a])
                    held[0], held[1], held[2] = max(held[0], coverage), held[1] + 1, min(held[2], a)
                rows.extend((d, name, *held) for name, held in sorted(best.items()))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = (pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "license", "coverage", "matches", "first_word"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text).mapInArrow(scanned, "doc_id long, license string, coverage double, matches int, first_word long")
