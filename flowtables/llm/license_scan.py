"""License scan: MinHash bands over overlapping text windows, verified by shingle containment.

Templates are grouped by their number of five-word shingles n, rounded up to a power of two c.
A document's shingles are cut into windows of 2c positions, one beginning every c, so a
passage of n shingles lies whole in at least one window. A window that holds a template whole
has a Jaccard similarity of at least n / 2c > 1/4 with it, and ``BANDS`` bands of one MinHash
value each miss it with a chance below 0.75 ** BANDS (one in a million). A retrieved window
is verified exactly: the share of the template's shingles that it contains.

An edited passage that still contains four fifths of a template's shingles has a similarity of
at least 0.19 with a window that holds it, which the bands miss with a chance of four in 100,000.

A band can only agree where the window holds the template's own smallest shingle of that band,
so values are computed for windows with at least one such shingle, and for no others; the
windows retrieved are the same.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from flowtables.llm.blocks import Block
from flowtables.llm.common import id_text, mix64
from flowtables.llm.decontamination import _FOLD
from flowtables.llm.substring_dedup import words_of

SIZE = 5
BANDS = 48
#: Templates are sent to every task; this bounds them, in bytes of text.
TEMPLATE_BYTES = 16 << 20
_STEP, _SEED = np.uint64(0xE7037ED1A0B428DB), np.uint64(0x8EBC6AF09C88C6E3)
_SLICE = 2 << 20


def positions(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingle, first word) of all runs of five words, and each text's number of shingles.

    Words are lower-case runs of ASCII letters, digits and all characters beyond ASCII.
    """
    data = [t.translate(_FOLD) for t in texts]
    ends = np.cumsum([len(d) for d in data], dtype=np.int64)
    starts = ends - np.array([len(d) for d in data], np.int64)
    names, _, _, docs = words_of(Block([], starts, ends, np.frombuffer(b"".join(data), np.uint8)))
    counts = np.bincount(docs, minlength=len(texts))
    rolled = np.zeros(len(names), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(SIZE):
            rolled[: max(0, len(names) - k)] += mix64(names[k:] + np.uint64(k + 1) * _STEP)
    index = np.arange(len(names)) - np.repeat(np.cumsum(counts) - counts, counts)
    whole = index + SIZE <= np.repeat(counts, counts)
    return rolled[whole], index[whole], np.maximum(counts - SIZE + 1, 0)


def _values(shingles: np.ndarray, band: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(shingles ^ (np.uint64(band + 1) * _SEED))


class Templates:
    """Templates by class, with their MinHash values and the shingles these come from."""

    def __init__(self, templates: list[tuple[str, str]]):
        if sum(len(t) for _, t in templates) > TEMPLATE_BYTES:
            raise ValueError(f"templates of more than {TEMPLATE_BYTES} bytes in all")
        self.names = [name for name, _ in templates]
        self.shingles: list[np.ndarray] = []
        self.classes: dict[int, dict] = {}
        for number, (name, text) in enumerate(templates):
            shingles = np.unique(positions([text.encode()])[0])
            if not len(shingles):
                raise ValueError(f"template {name} has fewer than {SIZE} words")
            self.shingles.append(shingles)
            places = positions([text.encode()])[2][0]
            own = self.classes.setdefault(1 << int(places - 1).bit_length(), {"targets": set(), "bands": [defaultdict(list) for _ in range(BANDS)]})
            for band in range(BANDS):
                values = _values(shingles, band)
                own["targets"].add(int(shingles[values.argmin()]))
                own["bands"][band][int(values.min())].append(number)
        for own in self.classes.values():
            own["targets"] = np.array(sorted(own["targets"]), np.uint64)

    def retrieve(self, shingles: np.ndarray, c: int) -> Iterator[tuple[int, int]]:
        """(begin of a window, template) of windows of 2c positions that share a band with a template of class c."""
        own = self.classes[c]
        place = np.searchsorted(own["targets"], shingles)
        hits = np.flatnonzero(own["targets"][np.minimum(place, len(own["targets"]) - 1)] == shingles)
        begins = {int(b) * c for h in np.unique(hits // c) for b in (h - 1, h) if b >= 0} | ({0} if len(hits) else set())
        for begin in sorted(begins):
            window = shingles[begin : begin + 2 * c]
            found = set()
            for band, values in enumerate(own["bands"]):
                found.update(values.get(int(_values(window, band).min()), ()))
            for template in sorted(found):
                yield begin, template


def _over(spans: list[tuple[int, int, float]], start: int, stop: int) -> list[tuple[int, int, float]]:
    """Those of disjoint sorted spans that share a word with [start, stop)."""
    first = max(0, bisect_right(spans, (start,)) - 1)
    return [s for s in spans[first : bisect_left(spans, (stop,))] if s[1] > start]


def _apart(found: set[tuple[float, int, int]]) -> list[tuple[int, int, float]]:
    """Disjoint (start, stop, containment) in order, from (-containment, size in shingles, start), the best first."""
    kept: list[tuple[int, int, float]] = []
    for share, size, start in sorted(found):
        stop = start + size + SIZE
        if not _over(kept, start, stop):
            insort(kept, (start, stop, -share))
    return kept


def license_matches(docs: DataFrame, templates: list[tuple[str, str]], containment: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """License passages of every document: doc_id and matches.

    A match is (license, start, stop, containment, shared, best): its words from ``start`` up to
    before ``stop``, and the share and number of the template's shingles in the window. Of
    overlapping matches of one template the one with the larger containment stays, then the
    shorter, then the first. Licenses that quote each other match the same passage: ``best`` is
    false where a match of another license that shares a word with it has more shared shingles,
    or as many at a larger containment.

    Whole texts are scanned, each in one task; other columns are not read, whatever their names. Null, empty and short texts have no matches; rows with null or
    repeated ids are scanned each by itself; no templates give no matches. Templates of fewer
    than five words are an error.
    """
    known = Templates(templates)

    def scan(shingles: np.ndarray) -> list[dict]:
        found: dict[int, set] = defaultdict(set)
        for c in known.classes:
            for begin, template in known.retrieve(shingles, c):
                window, wanted = shingles[begin : begin + 2 * c], known.shingles[template]
                inside = np.flatnonzero(np.isin(window, wanted))
                share = len(np.unique(window[inside])) / len(wanted)
                if share >= containment:
                    found[template].add((-share, int(inside[-1] - inside[0]), begin + int(inside[0])))
        kept = {template: _apart(spans) for template, spans in found.items()}
        rank = {t: {start: (round(share * len(known.shingles[t])), share) for start, _, share in spans} for t, spans in kept.items()}
        out = []
        for t, spans in kept.items():
            others = [o for o in kept if known.names[o] != known.names[t]]
            for start, stop, share in spans:
                shared, _ = own = rank[t][start]
                best = all(rank[o][other] <= own for o in others for other, _, _ in _over(kept[o], start, stop))
                out.append({"license": known.names[t], "start": start, "stop": stop, "containment": share, "shared": shared, "best": best})
        return sorted(out, key=lambda m: (m["start"], m["license"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, size = [], [], 0
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                ids.append(doc)
                texts.append(text.as_py().encode())
                size += len(texts[-1])
                if size > _SLICE:
                    yield scanned(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield scanned(ids, texts)

    targets = np.unique(np.concatenate([np.zeros(0, np.uint64), *(own["targets"] for own in known.classes.values())]))

    def scanned(ids: list, texts: list[bytes]) -> pa.RecordBatch:
        shingles, _, counts = positions(texts)
        ends = np.cumsum(counts)
        matches: list[list] = [[] for _ in ids]
        if len(targets) and len(shingles):
            place = np.minimum(np.searchsorted(targets, shingles), len(targets) - 1)
            for d in np.unique(np.searchsorted(ends, np.flatnonzero(targets[place] == shingles), "right")):
                matches[d] = scan(shingles[ends[d] - counts[d] : ends[d]])
        return pa.record_batch([pa.array(ids, pa.int64()), pa.array(matches, _MATCHES)], names=["doc_id", "matches"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, matches array<struct<license:string,start:long,stop:long,containment:double,shared:long,best:boolean>>")


_MATCHES = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("containment", pa.float64()), ("shared", pa.int64()), ("best", pa.bool_())]))

# Short public notices by which texts state their license.
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("LGPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("AGPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
]


def bodies() -> list[tuple[str, str]]:
    """(SPDX name, whole text) of the license bodies beside this module."""
    return [(p.stem, p.read_text(encoding="utf-8")) for p in sorted((Path(__file__).parent / "licenses").glob("*.txt"))]


def templates() -> list[tuple[str, str]]:
    """All templates that the scan knows: notices and whole bodies."""
    return NOTICES + bodies()
