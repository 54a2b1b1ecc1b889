"""License scans with a positional rare-token index.

Templates (whole phrases and license notices) are indexed by their rarest words, with each word's place in the template.
A file's licence words of highest IDF look up postings; these are intersected by where the template would start: as many
anchors must agree on it as can't all be wrong in a hit.  A hit counts when enough of the template's words stand at their
places and every mandatory key phrase stands there whole.  Document frequencies of the licence words are counted over all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.llm import textkit as tk

#: Base phrases and labels; fixed values.
BASE = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

#: Notices that the method adds: label, words, mandatory key phrases.
NOTICES = [
    ("agpl", "gnu affero general public license", ["affero general public license"]),
    ("all-rights-reserved", "all rights reserved", ["all rights reserved"]),
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ["source and binary forms"]),
    ("cc-by-4.0", "licensed under cc by 4 0", ["cc by 4 0"]),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ["cc by nc 4 0"]),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ["cc by sa 4 0"]),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ["general public license version 2"]),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ["general public license version 3"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["use copy modify and or distribute"]),
    ("lgpl", "gnu lesser general public license", ["lesser general public license"]),
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software", ["permission is hereby granted free of charge"]),
    (
        "mit-text",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
        "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense "
        "and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions "
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
        ["permission is hereby granted free of charge", "shall be included in all copies or substantial portions"],
    ),
    (
        "apache-2.0-header",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at",
        ["apache license version 2 0", "in compliance with the license"],
    ),
    (
        "gpl-header",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
        ["gnu general public license", "free software foundation"],
    ),
    (
        "bsd-text",
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form "
        "must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
        ["must retain the above copyright notice", "must reproduce the above copyright notice"],
    ),
    (
        "mpl-2.0-header",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at",
        ["mozilla public license v 2 0"],
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software",
        ["free and unencumbered software released into the public domain"],
    ),
    (
        "zlib",
        "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
        ["including commercial applications and to alter it and redistribute it freely"],
    ),
    ("mit-release", "released under the mit license", ["the mit license"]),
    ("mpl-2.0", "mozilla public license version 2 0", ["mozilla public license"]),
]

#: Rarest words by which a template is indexed, and the share of its IDF that must stand in place.
RARE = 4
SHARE = 0.75


class Templates:
    """Templates over a vocabulary of licence words, with the postings of their rarest words."""

    def __init__(self, base=BASE, notices=NOTICES, idf: dict[str, float] | None = None, rare: int = RARE):
        self.base = [x for _, x in base]
        rows = [(label, phrase.split(), [phrase.split()]) for phrase, label in base]
        rows += [(label, words.split(), [k.split() for k in keys]) for label, words, keys in notices]
        self.vocabulary = sorted({w for _, words, keys in rows for w in words + sum(keys, [])})
        self.hashes = tk.word_hash(self.vocabulary)
        self.labels = [r[0] for r in rows]
        self.n_base = len(base)
        at = {w: i for i, w in enumerate(self.vocabulary)}
        self.idf = np.array([(idf or {}).get(w, 1.0) for w in self.vocabulary])
        self.words = [np.array([at[w] for w in words]) for _, words, _ in rows]
        self.keys = []
        for _, words, keys in rows:
            places = []
            for key in keys:
                starts = [i for i in range(len(words) - len(key) + 1) if words[i : i + len(key)] == key]
                places += [np.arange(i, i + len(key)) for i in starts[:1]]
            self.keys.append(np.unique(np.concatenate(places)) if places else np.zeros(0, int))
        post = []
        for t, words in enumerate(self.words):
            # one anchor is enough for a phrase that must stand whole; a notice that may lose words gets several
            rarest = sorted(set(words.tolist()), key=lambda w: (-self.idf[w], w))[: 1 if t < self.n_base else rare]
            post += [(w, t, i) for i, w in enumerate(words.tolist()) if w in rarest]
        # Anchors that must agree on a place: as many as can't all be wrong while enough of the template's weight stands.
        self.need = np.ones(len(self.words), np.int64)
        for t, words in enumerate(self.words):
            weight = np.sort(self.idf[[w for w, u, _ in post if u == t]])
            spare = 0.0 if t < self.n_base else (1 - SHARE) * self.idf[words].sum() + 1e-9
            self.need[t] = max(1, len(weight) - int(np.searchsorted(np.cumsum(weight), spare, "right")))
        post.sort()
        self.post_word, self.post_template, self.post_place = (np.array(x, np.int64) for x in zip(*post, strict=True))
        self.post_at = np.searchsorted(self.post_word, np.arange(len(self.vocabulary) + 1))

    def hits(self, ids: np.ndarray, doc: np.ndarray, pos: np.ndarray, first: np.ndarray, end: np.ndarray):
        """(template, document, start word, share) of every hit.  ids: of each word of a slice, -1 outside the vocabulary;
        pos: its index in the slice; first and end: of each document's words."""
        found = pos[ids >= 0]
        own = ids[found]
        count = self.post_at[own + 1] - self.post_at[own]
        which = np.repeat(np.arange(len(found)), count)
        if not len(which):
            return [np.zeros(0, np.int64)] * 3 + [np.zeros(0)]
        post = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.post_at[own], count)
        template = self.post_template[post]
        start = found[which] - self.post_place[post]
        of = doc[found[which]]
        length = np.array([len(w) for w in self.words])[template]
        inside = (start >= first[of]) & (start + length <= end[of])
        cases, agree = np.unique(np.stack([template[inside], of[inside], start[inside]]), axis=1, return_counts=True)
        cases = cases[:, agree >= self.need[cases[0]]]
        kept, shares = [], []
        for t in np.unique(cases[0]):
            mine = cases[:, cases[0] == t]
            same = ids[mine[2][:, None] + np.arange(len(self.words[t]))] == self.words[t]
            weight = self.idf[self.words[t]]
            share = same @ weight / weight.sum()
            good = same[:, self.keys[t]].all(axis=1) & (same.all(axis=1) if t < self.n_base else share >= SHARE)
            kept.append(mine[:, good])
            shares.append(share[good])
        if not kept:
            return [np.zeros(0, np.int64)] * 3 + [np.zeros(0)]
        return [*np.concatenate(kept, axis=1), np.concatenate(shares)]


def document_frequencies(docs: DataFrame, text: str, words: list[str]) -> tuple[int, dict[str, int]]:
    """The number of rows, and in how many of them each word stands; over whole texts of all rows."""
    hashes = tk.word_hash(words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = tk.HashIndex(hashes)
        total, rows = np.zeros(len(hashes), np.int64), 0
        for batch in batches:
            for _, _, buf, off in tk.slices(batch.column(0)):
                w = tk.Words(buf, off, tk.ALNUM)
                ids = index.find(w.hash)
                pairs = np.unique(w.doc[ids >= 0] * len(hashes) + ids[ids >= 0])
                total += np.bincount(pairs % len(hashes), minlength=len(hashes))
                rows += len(off) - 1
        yield pa.RecordBatch.from_arrays([pa.array([*range(len(hashes)), -1], pa.int32()), pa.array([*total, rows], pa.int64())], names=["w", "n"])

    got = docs.select(F.col(text).cast("string").alias("_t")).mapInArrow(count, "w int, n long").groupBy("w").agg(F.sum("n").alias("n")).collect()
    df = {r["w"]: r["n"] for r in got}
    return df.get(-1, 0), {word: df.get(i, 0) for i, word in enumerate(words)}


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", base=BASE, notices=NOTICES) -> DataFrame:
    """License labels of every row, from its whole text.

    A null or empty text has no words and no labels (empty strings), null places and score 0.  Repeated rows are scanned
    each, very long texts whole; a null key stays null; other columns aren't read, whatever their names; an empty table gives
    no rows.  The score is 1 for a base phrase, else the best share of a notice's IDF in place.
    """
    plain = Templates(base, notices)
    rows, df = document_frequencies(docs, text, plain.vocabulary)
    idf = {w: float(np.log((rows + 1) / (n + 0.5)) + 0.01) for w, n in df.items()}
    templates = Templates(base, notices, idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = tk.HashIndex(templates.hashes)
        for batch in batches:
            for i, j, buf, off in tk.slices(batch.column(1)):
                w = tk.Words(buf, off, tk.ALNUM)
                n = j - i
                ids = index.find(w.hash)
                t, doc, start, share = templates.hits(ids, w.doc, np.arange(len(w)), w.first[:-1], w.first[1:])
                is_base = t < templates.n_base
                place = start - w.first[doc]
                n_base = np.bincount(doc[is_base], minlength=n)
                low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
                np.minimum.at(low, doc[is_base], place[is_base])
                np.maximum.at(high, doc[is_base], place[is_base])
                score = np.zeros(n)
                np.maximum.at(score, doc, np.minimum(share, 1.0))
                labels: list[set] = [set() for _ in range(n)]
                bases: list[set] = [set() for _ in range(n)]
                for a, b in zip(t.tolist(), doc.tolist(), strict=True):
                    labels[b].add(templates.labels[a])
                    if a < templates.n_base:
                        bases[b].add(templates.labels[a])
                none = n_base == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, n), pa.array(w.count, pa.int64()), pa.array(n_base, pa.int64()),
                        pa.array(low, pa.int64(), mask=none), pa.array(high, pa.int64(), mask=none),
                        pa.array([",".join(sorted(x)) for x in bases]), pa.array([",".join(sorted(x)) for x in labels]), pa.array(score),
                    ],
                    names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
                )

    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return docs.select(F.col(key).cast("long").alias("_k"), F.col(text).cast("string").alias("_t")).mapInArrow(run, schema)


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
