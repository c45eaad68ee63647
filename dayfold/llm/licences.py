"""Licence scan: normalised text compared to licence templates by the Dice coefficient over word bigrams.

A document is looked at as a whole and line by line and, with ``windows``, through every run of words that has as many
bigrams as the template, wherever it starts and whatever line ends it crosses. Words are runs of ASCII letters and digits and all non-ASCII
bytes, A-Z lower-cased; a segment's bigrams are a multiset (one word alone is its own bigram). Dice is twice the shared
count over the sum of both counts, so a segment can only reach the threshold with a template whose size lies between
t / (2 - t) and (2 - t) / t of its own: templates of other sizes are pruned before anything is compared, and a segment
none of whose bigrams is a template's is dropped at once. The templates are a parameter and are sent to every task;
their size is checked. A bigram adds to the windows in which it is not yet one more than the template has, which are
neighbours; so all windows of a text are compared by adding up where those runs of windows begin and end, and a text
with too few of a template's bigrams is left out before.

Everything is done where the text is read: there is no shuffle but the one that keeps a document's best segment, and
that only sees the hits.

Defined results: null, blank and wordless texts have no segments; a document without a hit has no row; equal scores go
to the longer segment, then to the first line (of a window, the one it starts in), then to the template's name; repeated rows of a doc_id are one
document; a null doc_id is a value like any other; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .common import batch, text_column
from .decontaminate import PLAIN_TABLE

#: Short licence notices as they are usually written, by their common identifiers.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
#: Licence texts and file headers of several lines, without the lines that name the holder.
TEXTS = {
    "Apache-2.0 header": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
    "BSD-2-Clause text": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.""",
    "GPL-3.0 header": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.
This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the
GNU General Public License for more details.""",
    "ISC text": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
    "MIT text": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.""",
}
#: Bytes of templates that tasks may be sent.
MOST_TEMPLATE_BYTES = 8 << 20
RUN = 1 << 19


def bigrams(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h, s, _ = K.words(buf, offs, PLAIN_TABLE)
    return K.shingles(h, K.doc_word_offsets(s, offs), 2)


def template_bigrams(templates: dict[str, str]) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(name, distinct bigrams, counts) of the templates that have words."""
    out = []
    for name, text in sorted(templates.items()):
        buf = np.frombuffer(text.encode(), np.uint8)
        sh, _ = bigrams(buf, np.array([0, len(buf)]))
        if len(sh):
            out.append((name, *np.unique(sh, return_counts=True)))
    return out


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold_percent: int = 80, id_col: str = "doc_id",
         text_col: str = "text", windows: bool = False) -> DataFrame:
    """doc_id, licence, dice, scope ('text', 'line' or 'window'), line (from 0; null for the whole text), n_bigrams: each
    document's best segment for every template that reaches the threshold."""
    templates = NOTICES if templates is None else templates
    if sum(len(k) + len(t) for k, t in templates.items()) > MOST_TEMPLATE_BYTES:
        raise ValueError("too many templates to send to every task")
    known = template_bigrams(templates)
    shared = docs.sparkSession.sparkContext.broadcast(known)
    t = threshold_percent
    schema = pa.schema([("doc_id", pa.int64()), ("licence", pa.string()), ("dice", pa.float64()), ("scope", pa.string()),
                        ("line", pa.int64()), ("n_bigrams", pa.int64())])

    def hits(buf, offs):
        """(segment, template, dice, size) of the segments that reach the threshold."""
        known = shared.value
        if not known or not len(buf):
            return
        sh, first = bigrams(buf, offs)
        size = np.diff(first)
        every = np.unique(np.concatenate([b for _, b, _ in known]))
        at = np.minimum(np.searchsorted(every, sh), len(every) - 1)
        mine = np.flatnonzero(every[at] == sh)
        segment = np.searchsorted(first, mine, "right") - 1
        for name, grams, counts in known:
            n = int(counts.sum())
            fits = (size * (200 - t) >= n * t) & (n * (200 - t) >= size * t)
            here = mine[fits[segment]]
            place = np.minimum(np.searchsorted(grams, sh[here]), len(grams) - 1)
            ok = grams[place] == sh[here]
            seg = np.searchsorted(first, here[ok], "right") - 1
            pair, times = np.unique(seg * len(grams) + place[ok], return_counts=True)
            shared_ = np.bincount(pair // len(grams), np.minimum(times, counts[pair % len(grams)]), len(size))
            for s in np.flatnonzero((200 * shared_ >= t * (size + n)) & (shared_ > 0)):
                yield int(s), name, 2 * shared_[s] / (size[s] + n), int(size[s])

    def window_hits(buf, offs):
        """(document, template, dice, size, start byte) of each document's best windows that reach the threshold."""
        known = shared.value
        if not known or not len(buf):
            return
        h, starts, _ = K.words(buf, offs, PLAIN_TABLE)
        word = K.doc_word_offsets(starts, offs)
        sh, first = K.shingles(h, word, 2)
        every = np.unique(np.concatenate([b for _, b, _ in known]))
        at = np.minimum(np.searchsorted(every, sh), len(every) - 1)
        mine = np.flatnonzero(every[at] == sh)
        of = np.searchsorted(first, mine, "right") - 1
        for name, grams, counts in known:
            n = int(counts.sum())
            place = np.minimum(np.searchsorted(grams, sh[mine]), len(grams) - 1)
            ok = (grams[place] == sh[mine]) & (np.diff(first)[of] >= n)
            enough = 100 * np.bincount(of[ok], minlength=len(first)) >= t * n
            ok &= enough[of]
            pos, doc, place = mine[ok], of[ok], place[ok]
            order = np.argsort(place, kind="stable")
            pos, doc, place = pos[order], doc[order], place[order]
            times, row = counts[place], np.arange(len(pos))
            back = np.maximum(row - times, 0)
            known_before = (row >= times) & (place[back] == place)
            low = np.maximum(np.where(known_before, pos[back] + 1, 0), np.maximum(pos - n + 1, first[doc]))
            high = np.minimum(pos, first[doc + 1] - n)
            use = low <= high
            edge, back = np.unique(np.concatenate([low[use], high[use] + 1]), return_inverse=True)
            step = np.where(np.arange(len(back)) < use.sum(), 1, -1)
            shared_ = np.cumsum(np.bincount(back, step, len(edge))).astype(np.int64)
            hit = np.flatnonzero((100 * shared_ >= t * n) & (shared_ > 0))
            doc = np.searchsorted(first, edge[hit], "right") - 1
            order = np.lexsort((edge[hit], -shared_[hit], doc))
            for i in order[np.flatnonzero(np.diff(doc[order], prepend=-1))]:
                s, d = int(edge[hit[i]]), int(doc[i])
                yield d, name, shared_[hit[i]] / n, n, int(starts[word[d] + s - first[d]])

    def run(batches):
        for rb in batches:
            buf, offs = K.text_buffer(rb.column(1))
            for a, b in K.doc_runs(offs, RUN):
                ids = rb.column(0).slice(a, b - a).to_pylist()
                part, o = buf[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
                ends = np.flatnonzero(part == 10)
                lines = np.unique(np.concatenate([o, ends + 1]))
                doc = np.searchsorted(o, lines, "right") - 1
                head = np.searchsorted(lines, o)
                out = [(ids[s], name, dice, "text", None, n) for s, name, dice, n in hits(part, o)]
                out += [(ids[doc[s]], name, dice, "line", int(s - head[doc[s]]), n) for s, name, dice, n in hits(part, lines)]
                if windows:
                    out += [(ids[d], name, dice, "window", int(np.searchsorted(lines, byte, "right") - 1 - head[d]), n)
                            for d, name, dice, n, byte in window_hits(part, o)]
                if out:
                    yield batch(schema, *zip(*out))

    found = text_column(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, licence string, dice double, scope string, line long, n_bigrams long")
    best = found.groupBy("doc_id", "licence").agg(F.min(F.struct(
        (-F.col("dice")).alias("minus"), (-F.col("n_bigrams")).alias("size"), F.coalesce("line", F.lit(-1)).alias("at"),
        "scope", "line")).alias("b"))
    return best.select("doc_id", "licence", (-F.col("b.minus")).alias("dice"), "b.scope", "b.line",
                       (-F.col("b.size")).alias("n_bigrams"))
