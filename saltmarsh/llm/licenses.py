"""License notices by conditional compression.

A candidate block is the text around a mention of licensing. It is compressed once alone and once with
each template as raw-content zstandard dictionary; what the dictionary saves ranks the templates. The
ranking only proposes: a template is named after its words have been laid against the block's, by the
number of words missing and added, and numbers (versions) must agree.
"""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import ship

#: fixed values: notices as they are printed, by SPDX identifier
TEMPLATES = {
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
    ],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3."],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
#: fixed values: what a notice mentions, in any case
MENTION = r"(?i)licen[sc]e|copyright|spdx|creative commons|\bcc[ -]?(?:by|0)\b|public domain|redistribution|hereby granted"
AROUND = 320
#: longest block that is compressed at once; longer ones are cut into blocks that overlap by ``OVERLAP``
WINDOW, OVERLAP = 4096, 1024
LEVEL = 19
#: share of a template's words that may be missing or added
TOLERANCE = 0.2

_WORD = re.compile(r"[^\W_]+(?:\.\d+)*")


def words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def blocks(text: str, around: int = AROUND) -> list[tuple[int, int]]:
    """Spans of ``around`` characters before and behind each mention, joined where they touch, cut to a bounded length."""
    spans: list[list[int]] = []
    for m in re.finditer(MENTION, text):
        a, b = max(0, m.start() - around), min(len(text), m.end() + around)
        if spans and a <= spans[-1][1]:
            spans[-1][1] = b
        else:
            spans.append([a, b])
    return [(x, min(b, x + WINDOW)) for a, b in spans for x in range(a, max(a + 1, b - OVERLAP), WINDOW - OVERLAP)]


def places(template: list[str], block: list[str]) -> list[tuple[int, int, tuple[int, int]]]:
    """Where the template lies in the block, closely enough and with all its numbers: its words that are missing,
    foreign words inside, and the place as a span of words. Places may overlap."""
    out = []
    most, head = max(1, int(TOLERANCE * len(template))), set(template[:2])
    known = SequenceMatcher(None, [], template, autojunk=False)  # what it learns of the second list is kept
    for i in [i for i, w in enumerate(block) if w in head] or [0]:
        known.set_seq1(block[i:i + len(template) + len(template) // 4 + 1])
        runs = [r for r in known.get_matching_blocks() if r.size]
        if not runs:
            continue
        hit = sum(r.size for r in runs)
        end = runs[-1].a + runs[-1].size
        missing, added = len(template) - hit, end - runs[0].a - hit
        kept = {template[r.b + k] for r in runs for k in range(r.size)}
        if missing + added <= most and all(w in kept for w in template if w[0].isdigit()):
            out.append((missing, added, (i + runs[0].a, i + end)))
    return out


def scanner(templates: dict[str, list[str]] = TEMPLATES, level: int = LEVEL):
    """A function from a text to its notices: (license, start, end, saved, missing, added)."""
    import zstandard as z

    alone = z.ZstdCompressor(level=level)
    given = [(name, words(t), z.ZstdCompressor(level=level, dict_data=z.ZstdCompressionDict(t.encode(), dict_type=z.DICT_TYPE_RAWCONTENT)))
             for name, ts in templates.items() for t in ts]

    def scan_block(text: str, a: int, b: int):
        body = text[a:b].encode("utf-8", "surrogatepass")
        plain = len(alone.compress(body))
        ranked = sorted(((plain - len(c.compress(body)), -i) for i, (_, _, c) in enumerate(given)), reverse=True)
        at = [(m.start(), m.end()) for m in _WORD.finditer(text, a, b)]
        own = [text[s:e].lower() for s, e in at]
        found = []
        for saved, i in ranked:
            name, wanted, _ = given[-i]
            if saved > 0:
                found += [(missing + added, -saved, name, span, missing, added) for missing, added, span in places(wanted, own)]
        taken = bytearray(len(own))
        for _, less, name, (i, j), missing, added in sorted(found):
            if not any(taken[i:j]):  # of notices that overlap, the closest
                taken[i:j] = b"\1" * (j - i)
                yield name, at[i][0], at[j - 1][1], -less, missing, added

    def scan(text: str):
        out = []
        for a, b in blocks(text):
            # what lies outside all finds is looked at again: there another template may save most
            todo = [(a, b)]
            while todo:
                x, y = todo.pop()
                got = list(scan_block(text, x, y))
                out += got
                edges = [x, *[e for g in sorted(got, key=lambda g: g[1]) for e in g[1:3]], y]
                if got:
                    todo += [(p, q) for p, q in zip(edges[::2], edges[1::2]) if re.search(MENTION, text[p:q])]
        # a notice in two overlapping blocks counts once, and one cut by a border gives way to the whole
        kept: list[tuple] = []
        for g in sorted(set(out), key=lambda g: (g[1], g[4] + g[5], -g[2])):
            if not kept or g[1] >= kept[-1][2]:
                kept.append(g)
            elif g[4] + g[5] < kept[-1][4] + kept[-1][5]:
                kept[-1] = g
        return kept

    return scan


def license_notices(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """One row per notice found: doc_id, license, start, n_chars, saved (bytes), n_missing, n_added, exact, wording.

    ``exact`` means that no word is missing or added. Null, empty and unrelated texts give no row; rows
    that repeat give their notices each. Texts without a mention never leave the JVM.
    """
    ship(docs.sparkSession)
    some = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text")).where(F.col("text").rlike(MENTION))
    schema = T.StructType([T.StructField("doc_id", some.schema["doc_id"].dataType), T.StructField("license", T.StringType())])
    for name in ("start", "n_chars", "saved", "n_missing", "n_added"):
        schema = schema.add(name, T.LongType())
    schema = schema.add("exact", T.BooleanType()).add("wording", T.StringType())

    def run(batches):
        scan = scanner(templates)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                rows += [{"doc_id": doc, "license": n, "start": a, "n_chars": b - a, "saved": s, "n_missing": m, "n_added": d,
                          "exact": not m and not d, "wording": text[a:b]} for n, a, b, s, m, d in scan(text)]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                    ("doc_id", batch.schema.field("doc_id").type), ("license", pa.string()), *[(c, pa.int64()) for c in ("start", "n_chars", "saved", "n_missing", "n_added")],
                    ("exact", pa.bool_()), ("wording", pa.string())]))

    return some.mapInArrow(run, schema)
