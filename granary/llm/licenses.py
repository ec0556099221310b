"""Licence scans: sentences are mapped to known identifiers, and their order is held against licence rules."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf

# Sentences of public licences, normalised as normalise() does, and their identifiers.
SENTENCES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-condition",
    "the software is provided as is without warranty of any kind express or implied": "mit-warranty",
    "licensed under the apache license version # the license": "apache-notice",
    "you may not use this file except in compliance with the license": "apache-compliance",
    "you may obtain a copy of the license at": "apache-copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis": "apache-warranty",
    "apache license version # january #": "apache-title",
    "terms and conditions for use reproduction and distribution": "apache-terms",
    "this program is free software you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl-grant",
    "you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl-grant",
    "under the terms of the gnu general public license version # as published by the free software foundation": "gpl-only",
    "you can redistribute it and/or modify it under the terms of the gnu lesser general public license as published by the free software foundation": "lgpl-grant",
    "under the terms of the gnu lesser general public license version # as published by the free software foundation": "lgpl-only",
    "you can redistribute it and/or modify it under the terms of the gnu affero general public license as published by the free software foundation": "agpl-grant",
    "either version # of the license or at your option any later version": "fsf-later",
    "this program is distributed in the hope that it will be useful but without any warranty": "gpl-warranty",
    "is distributed in the hope that it will be useful but without any warranty": "gpl-warranty",
    "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed": "fsf-verbatim",
    "gnu general public license version # # june #": "gpl-title",
    "gnu general public license version # june #": "gpl-title",
    "gnu lesser general public license version # # june #": "lgpl-title",
    "gnu lesser general public license version # february #": "lgpl-title",
    "gnu affero general public license version # # november #": "agpl-title",
    "this source code form is subject to the terms of the mozilla public license v #": "mpl-grant",
    "permission to use copy modify and/or distribute this software for any purpose with or without fee is hereby granted": "bsd-zero-grant",
    "permission to use copy modify and/or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "the software is provided as is and the author disclaims all warranties with regard to this software": "isc-warranty",
    "this is free and unencumbered software released into the public domain": "unlicense-grant",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license": "boost-grant",
    "this software is provided as-is without any express or implied warranty": "zlib-warranty",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely": "zlib-grant",
    "this program and the accompanying materials are made available under the terms of the eclipse public license v #": "epl-grant",
    "this program and the accompanying materials are made available under the terms of the eclipse public license #": "epl-grant",
    "has waived all copyright and related or neighboring rights to": "cc#-waiver",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-endorse",
    "may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-endorse",
    "this software is provided by the copyright holders and contributors as is": "bsd-warranty",
    "this software is provided by the regents and contributors as is": "bsd-warranty",
    "this software is provided by the author and contributors as is": "bsd-warranty",
    "all rights reserved": "reserved",
}
# Names that a notice gives a licence, normalised; "#" is its version. Names in the second table are
# words of other meanings, too, and only count where the sentence ends with them.
NAMES = {
    "mit license": "mit", "expat license": "mit", "x11 license": "mit",
    "apache license version #": "apache", "apache license #": "apache", "apache software license version #": "apache",
    "apache license": "apache", "apache-#": "apache", "apache # license": "apache", "apache # licence": "apache",
    "bsd #-clause license": "bsd", "#-clause bsd license": "bsd", "bsd-#-clause license": "bsd", "bsd-#-clause": "bsd",
    "bsd #-clause": "bsd", "bsd license": "bsd", "new bsd license": "bsd",
    "mozilla public license version #": "mpl", "mozilla public license v #": "mpl", "mozilla public license #": "mpl",
    "mozilla public license": "mpl", "mpl #": "mpl", "mpl-#": "mpl",
    "isc license": "isc", "zlib license": "zlib", "zlib/libpng license": "zlib", "unlicense": "unlicense",
    "boost software license version #": "boost", "boost software license #": "boost", "boost software license": "boost", "bsl-#": "boost",
    "eclipse public license version #": "epl", "eclipse public license v #": "epl", "eclipse public license #": "epl",
    "eclipse public license": "epl", "epl-#": "epl",
    "cc0 #": "cc#", "cc0-#": "cc#", "creative commons zero": "cc#",
}
LAST_NAMES = {"mit": "mit", "apache": "apache", "bsd": "bsd", "isc": "isc", "zlib": "zlib", "cc0": "cc#", "mpl": "mpl", "gpl": "gpl", "lgpl": "lgpl", "agpl": "agpl"}
_VERBS = ("licensed", "released", "distributed", "available", "published", "provided", "covered", "governed", "dual-licensed", "offered")
_NOT = ("not", "never", "t", "longer")  # "isn't" is two words here
# Rules by licence, the most specific first; a rule holds where its identifiers occur in this order.
RULES = (
    ("MIT", ("mit-grant", "mit-condition", "mit-warranty")),
    ("MIT", ("mit-notice",)),
    ("Apache", ("apache-notice", "apache-compliance", "apache-copy", "apache-warranty")),
    ("Apache", ("apache-title", "apache-terms")),
    ("Apache", ("apache-notice",)),
    ("LGPL", ("lgpl-grant", "fsf-later", "gpl-warranty")),
    ("LGPL", ("lgpl-grant", "fsf-later")),
    ("LGPL", ("lgpl-only",)),
    ("LGPL", ("lgpl-title", "fsf-verbatim")),
    ("LGPL", ("lgpl-notice",)),
    ("AGPL", ("agpl-grant", "fsf-later", "gpl-warranty")),
    ("AGPL", ("agpl-grant", "fsf-later")),
    ("AGPL", ("agpl-title", "fsf-verbatim")),
    ("AGPL", ("agpl-notice",)),
    ("GPL", ("gpl-grant", "fsf-later", "gpl-warranty")),
    ("GPL", ("gpl-grant", "gpl-warranty")),
    ("GPL", ("gpl-only",)),
    ("GPL", ("gpl-title", "fsf-verbatim")),
    ("GPL", ("gpl-notice",)),
    ("MPL", ("mpl-grant",)),
    ("MPL", ("mpl-notice",)),
    ("ISC", ("isc-grant", "isc-warranty")),
    ("ISC", ("isc-notice",)),
    ("0BSD", ("bsd-zero-grant", "isc-warranty")),
    ("Unlicense", ("unlicense-grant",)),
    ("Unlicense", ("unlicense-notice",)),
    ("BSL", ("boost-grant",)),
    ("BSL", ("boost-notice",)),
    ("Zlib", ("zlib-warranty", "zlib-grant")),
    ("Zlib", ("zlib-notice",)),
    ("EPL", ("epl-grant",)),
    ("EPL", ("epl-notice",)),
    ("BSD-3-Clause", ("bsd-source", "bsd-binary", "bsd-endorse", "bsd-warranty")),
    ("BSD-2-Clause", ("bsd-source", "bsd-binary", "bsd-warranty")),
    ("BSD", ("bsd-notice",)),
    ("CC0", ("cc#-waiver",)),
    ("CC0", ("cc#-notice",)),
    ("CC-BY", ("cc-by",)),
    ("CC-BY-SA", ("cc-by-sa",)),
    ("CC-BY-NC", ("cc-by-nc",)),
    ("CC-BY-ND", ("cc-by-nd",)),
    ("CC-BY-NC-SA", ("cc-by-nc-sa",)),
    ("CC-BY-NC-ND", ("cc-by-nc-nd",)),
    ("Proprietary", ("reserved",)),
)


def notice_names() -> dict[str, str]:
    """All names a notice may give, with the identifier of that notice: the fixed ones, and those made by rule."""
    out = {name: f"{of}-notice" for name, of in NAMES.items()}
    for of, words in (("gpl", "general"), ("lgpl", "lesser general"), ("agpl", "affero general")):
        for full in (f"gnu {words} public license", f"gnu {of}"):
            out |= {full + end: f"{of}-notice" for end in ("", " version #", " #", " v #")}
        short = (f"{of} #", f"{of} version #", f"{of}-#", f"{of}-#-only", f"{of}-#-or-later", f"{of}v#", f"{of} license", f"{of} v #")
        out |= {name: f"{of}-notice" for name in short}
    kinds = {"by": "attribution", "by-sa": "attribution-sharealike", "by-nc": "attribution-noncommercial", "by-nd": "attribution-noderivatives",
             "by-nc-sa": "attribution-noncommercial-sharealike", "by-nc-nd": "attribution-noncommercial-noderivatives"}
    for kind, words in kinds.items():
        for name in (f"cc {kind}", f"cc-{kind}", f"creative commons {kind}", f"creative commons {words}"):
            out |= {f"{name} #": f"cc-{kind}", f"{name}-#": f"cc-{kind}"}
    return out


# Marks of a comment at the beginning of a line; clauses of so many words are found within sentences.
_COMMENT = re.compile(r"[ \t]*(?:(?:#+|//+|/\*+|\*+/?|;+|--+|<!--)[ \t]*)?")
CLAUSE = 9
_BREAK = re.compile(r"(?<=[.!?;:])[ \t\r]+")
_NUMBER = re.compile(r"\bv?\d+(?:\.\d+)*\b|(?<=gplv)\d(?:\.\d)?\b")
_OTHER = re.compile(r"[^\w#/-]+")
_LOOSE = re.compile(r"(?<!\w)[-/]+|[-/]+(?!\w)")
_TAG = "spdx-license-identifier"


def normalise(sentence: str) -> str:
    """Lower case, version numbers as ``#``, no punctuation but within words, single spaces."""
    text = _OTHER.sub(" ", _NUMBER.sub("#", sentence.lower().replace("#", " ").replace("licence", "license")))
    return " ".join(_LOOSE.sub(" ", text).split())


class Known:
    """The tables of a scan, prepared once."""

    def __init__(self, sentences: dict[str, str]):
        self.sentences = {normalise_known(s): known for s, known in sentences.items()}
        self.names = {normalise_known(s): known for s, known in notice_names().items()}
        self.last = {s: f"{of}-notice" for s, of in LAST_NAMES.items()}
        self.clauses = sorted((s for s, known in self.sentences.items() if len(s.split()) >= CLAUSE), key=lambda s: (-len(s), s))
        self.short = {s: known for s, known in self.sentences.items() if len(s.split()) < CLAUSE}
        self.most = max((len(s.split()) for s in self.short), default=0)
        self.longest_name = max(len(s.split()) for s in self.names)
        words = {max((w for w in s.split() if w.isalpha()), key=lambda w: (len(w), w)) for s in self.sentences}
        # A text with a known sentence, notice or tag holds one of these words.
        self.anchors = re.compile("|".join(sorted(map(re.escape, words | {"spdx", *(f"{v} under" for v in _VERBS)}))).replace("\\ ", r"\W+"), re.IGNORECASE)

    def name_at(self, words: list[str], at: int, ends: set[int]) -> tuple[str, int] | None:
        """The notice that the longest name from a word on makes, and the number of its words."""
        for n in range(min(self.longest_name, len(words) - at), 0, -1):
            name = " ".join(words[at:at + n])
            if found := self.names.get(name):
                return found, n
            if n == 1 and at + 1 in ends and (found := self.last.get(name)):
                return found, n
        return None


def normalise_known(sentence: str) -> str:
    """A sentence of a table, whose ``#`` stands for a version."""
    return " ".join(_LOOSE.sub(" ", sentence.lower()).split())


def recognise(text: str, sentences: dict[str, str] | Known) -> list[tuple[str, int, int]]:
    """Known sentences of a text in order, as (identifier, start, end); see :func:`recognise_versions`."""
    return [found[:3] for found in recognise_versions(text, sentences if isinstance(sentences, Known) else Known(sentences))]


def recognise_versions(text: str, known: Known) -> list[tuple[str, int, int, str]]:
    """Known sentences of a text in order, as (identifier, start, end, version or nothing).

    Sentences end at a stop before white space, and comment marks that begin a
    line are no part of it. Clauses of ``CLAUSE`` words or more are found wherever
    they stand, over any number of lines; shorter ones are whole sentences or
    lines, or several lines together. A notice is a verb, "under" and a known
    name, within any sentence, unless a "not" stands before it. A machine-readable
    tag gives a notice for each name on its line.
    """
    pieces, numbers, tags, at = [], [], [], 0
    for line in text.split("\n"):
        start = at + _COMMENT.match(line).end()
        for part in _BREAK.split(line[start - at:]):
            found = text.find(part, start) if part else start
            if plain := normalise(part):
                if plain.startswith(_TAG):
                    tags.append((len(pieces), line[line.lower().find(_TAG) + len(_TAG):]))
                pieces.append((found, found + len(part), plain))
                numbers += _NUMBER.findall(part.lower().replace("#", " "))
            start = found + len(part)
        at += len(line) + 1
    out, words, piece_of, ends = [], [], [], set()
    for k, (_, _, plain) in enumerate(pieces):
        words += plain.split()
        piece_of += [k] * (len(words) - len(piece_of))
        ends.add(len(words))
    joined, places, taken = f" {' '.join(words)} ", [], []
    length = 1
    for word in words:
        places.append(length)
        length += len(word) + 1
    seen = [0]  # version numbers up to each word
    for word in words:
        seen.append(seen[-1] + word.count("#"))

    def add(identifier: str, first: int, last: int) -> None:
        """Known words from ``first`` up to ``last``."""
        version = numbers[seen[first]] if seen[last] > seen[first] and seen[first] < len(numbers) else ""
        out.append((first, (identifier, pieces[piece_of[first]][0], pieces[piece_of[last - 1]][1], version.removeprefix("v"))))

    for sentence in known.clauses:
        found = joined.find(f" {sentence} ")
        while found >= 0:
            end = found + 1 + len(sentence)
            if all(end <= x or found + 1 >= y for x, y in taken):  # not within a longer clause
                taken.append((found + 1, end))
                add(known.sentences[sentence], bisect_right(places, found + 1) - 1, bisect_right(places, end - 1))
            found = joined.find(f" {sentence} ", end)
    inside = [(bisect_right(places, x) - 1, bisect_right(places, y - 1)) for x, y in sorted(taken)]
    starts = [0, *sorted(ends)]
    k = 0
    while k < len(pieces):
        n = 1
        while k + n <= len(pieces) and starts[k + n] - starts[k] <= known.most:
            if identifier := known.short.get(" ".join(words[starts[k]:starts[k + n]])):
                add(identifier, starts[k], starts[k + n])
                k += n - 1
                break
            n += 1
        k += 1
    for at, word in enumerate(words):
        if word != "under" or not at or words[at - 1] not in _VERBS or at > 1 and words[at - 2] in _NOT:
            continue
        at += 1
        for lead in (["the", "terms", "of"], ["either"], ["the"], ["a"], ["an"]):
            at += len(lead) if words[at:at + len(lead)] == lead else 0
        found = known.name_at(words, at, ends)
        if found and not any(x < at + found[1] and at < y for x, y in inside):
            add(found[0], at, at + found[1])
    for k, rest in tags:
        first, end = pieces[k][0], text.find("\n", pieces[k][0])
        for name in re.split(r"[\s():*]+", rest.lower()):
            plain = normalise(name)
            if identifier := known.names.get(plain) or known.last.get(plain):
                version = "".join(_NUMBER.findall(name)[:1])
                later = "-or-later" if version and name.endswith(("-or-later", "+")) else ""
                out.append((starts[k], (identifier, first, end if end >= 0 else len(text), version + later)))
    return [found for _, found in sorted(out)]


def _versioned(licence: str, version: str, later: bool) -> str:
    """Identifier of a licence with its version, as far as a text tells it."""
    if licence == "BSD":
        return f"BSD-{version}-Clause" if version else "BSD"
    if not version or licence in ("MIT", "ISC", "Zlib", "Unlicense", "Proprietary", "0BSD") or licence.startswith("BSD-"):
        return licence
    return f"{licence}-{version if '.' in version else version + '.0'}{'-or-later' if later else ''}"


def match_rules(found: list[str], rules: tuple) -> list[str]:
    """Licences whose identifiers occur in order, each identifier used by the first rule that holds."""
    return sorted({licence for licence, _ in match_versions(found, [""] * len(found), rules)})


def match_versions(found: list[str], versions: list[str], rules: tuple) -> list[tuple[str, str]]:
    """The same as (licence, licence with version); of a notice that is repeated, one for each version."""
    used, out = [False] * len(found), []
    for licence, sequence in rules:
        places, at = [], 0
        for wanted in sequence:
            while at < len(found) and (used[at] or found[at] != wanted):
                at += 1
            if at == len(found):
                break
            places.append(at)
            at += 1
        if len(places) == len(sequence):
            if len(sequence) == 1:
                told = {versions[k] for k, known in enumerate(found) if known == sequence[0] and not used[k]}
            else:
                told = {next((versions[k] for k in places if versions[k]), "")}
            out += [(licence, _versioned(licence, version, "fsf-later" in sequence)) for version in sorted(told)]
            for k, known in enumerate(found):  # repeats of a notice say nothing new
                used[k] = used[k] or known in sequence
    return out


def scan(text: Column, sentences: dict[str, str] = SENTENCES, rules: tuple = RULES) -> Column:
    """A struct (licenses, sentence_ids, starts, ends, license_ids) of each whole text, without a shuffle.

    ``license_ids`` are the licenses with their versions, as far as told. Null and
    empty texts have empty arrays, and repeated rows the same ones each. Starts
    and ends count code points. Known sentences without a complete rule are listed
    but give no licence. A text without any anchor word of the table can't hold a
    known sentence and isn't split.
    """
    @pandas_udf("licenses array<string>, sentence_ids array<string>, starts array<long>, ends array<long>, license_ids array<string>")
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Known(sentences)
        for batch in batches:
            rows = []
            for t in batch:
                found = recognise_versions(t, known) if isinstance(t, str) and known.anchors.search(t) else []
                ids = [f[0] for f in found]
                matched = match_versions(ids, [f[3] for f in found], rules)
                rows.append((sorted({m[0] for m in matched}), ids, [f[1] for f in found], [f[2] for f in found], sorted({m[1] for m in matched})))
            yield pd.DataFrame(rows, columns=["licenses", "sentence_ids", "starts", "ends", "license_ids"])

    return scanned(text)
