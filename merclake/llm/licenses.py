"""License scans with a positional index of rare tokens.

The index holds, for every word of the licence templates, its postings (template, position). A first pass counts in
how many documents each of these words occurs. In the second a file's licence words are ranked by that inverse
frequency; for each template the rarest of them that it has are looked up, and every place of such a word in the file
votes for the offset at which the template would lie there. Offsets with enough votes are kept, neighbouring ones
taken together, as a year or a name more or less moves the rest. At such an offset the template's mandatory key
phrases must stand, word for word and within a few words of their place; then the share of template words found in
place is its score.

The plain phrases are found by the same index: the places of a phrase's rarest word are looked up and the words
around them compared. They are a label each of its own, whatever the templates say.

Defined results: a null or empty text has no words, no labels and score 0. Words are runs of digits, letters a-z
(A-Z lower-cased) and all characters beyond ASCII. Words of equal frequency rank by the alphabet. Overlapping
places of a phrase all count. Repeated rows are judged each. Without rows the result is empty. Further columns are
not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merclake.llm.common import documents, small_batches, text_bytes
from merclake.llm.registry import query

#: Plain phrases and their labels. Fixed values.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Templates: label, mandatory key phrases, and the wording of the notice that authors put into files. Fixed values.
TEMPLATES = (
    ("mit", ("mit license",), "released under the mit license"),
    ("mit", ("permission is hereby granted free of charge",), "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("apache-2.0", ("apache license", "version 2 0"), "licensed under the apache license version 2 0"),
    ("apache-2.0", ("under the apache license version 2 0", "except in compliance with the license"), "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("gpl-2.0", ("gnu general public license", "version 2"), "this work is licensed under the gnu general public license version 2"),
    ("gpl-3.0", ("gnu general public license", "version 3"), "this work is licensed under the gnu general public license version 3"),
    ("gpl", ("gnu general public license", "free software foundation"), "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", ("gnu lesser general public license",), "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("agpl", ("gnu affero general public license",), "under the terms of the gnu affero general public license as published by the free software foundation"),
    ("mpl-2.0", ("mozilla public license",), "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("bsd", ("redistribution and use in source and binary forms",), "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", ("permission to use copy modify and or distribute this software",), "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc-by", ("cc by 4 0",), "licensed under cc by 4 0"),
    ("cc-by", ("creative commons attribution",), "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", ("cc by nc",), "licensed under cc by nc 4 0"),
    ("cc-by-nc", ("creative commons attribution noncommercial",), "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", ("cc by sa",), "licensed under cc by sa 4 0"),
    ("cc0", ("cc0 1 0",), "released under cc0 1 0 universal public domain dedication"),
    ("unlicense", ("released into the public domain",), "this is free and unencumbered software released into the public domain"),
)
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


class Index:
    """Postings of the template words, and how the scan uses them: ``rare`` words of a template that a file must be
    looked up for at most, the share of these that must agree on an offset, and the words by which parts may be moved."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES, rare: int = 6, agree: float = 0.5, moved: int = 4):
        self.rare, self.agree, self.moved = rare, agree, moved
        split = lambda s: [w.encode() for w in s.split()]
        self.templates = [(label, split(text), [split(k) for k in keys]) for label, keys, text in templates]
        self.phrases = [(split(p), label) for p, label in phrases.items()]
        self.needed = [frozenset(w for key in keys for w in key) for _, _, keys in self.templates]
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, (_, text, _) in enumerate(self.templates):
            for i, w in enumerate(text):
                self.postings[w].append((t, i))
        self.words = frozenset(self.postings) | {w for p, _ in self.phrases for w in p} | {w for n in self.needed for w in n}
        self.idf: dict[bytes, float] = {}

    def weigh(self, documents: int, frequency: dict[bytes, int]) -> None:
        self.idf = {w: math.log((documents + 1) / (frequency.get(w, 0) + 0.5)) for w in self.words}
        rank = lambda w: (-self.idf[w], w)
        self.ranked = [sorted(set(text), key=rank) for _, text, _ in self.templates]
        self.anchor = [min(range(len(p)), key=lambda i: rank(p[i])) for p, _ in self.phrases]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, str]], dict[str, float]]:
        """Places of plain phrases as (word, label), and the best score of each template label found."""
        present = self.words.intersection(words)
        phrases = [i for i, (p, _) in enumerate(self.phrases) if present.issuperset(p)]
        candidates = {}
        for t, needed in enumerate(self.needed):
            if present >= needed:
                candidates[t] = [w for w in self.ranked[t] if w in present][: self.rare]
        if not phrases and not candidates:
            return [], {}
        wanted = {w for own in candidates.values() for w in own} | {self.phrases[i][0][self.anchor[i]] for i in phrases}
        places: dict[bytes, list[int]] = defaultdict(list)
        for at, w in enumerate(words):
            if w in wanted:
                places[w].append(at)
        found = []
        for i in phrases:
            phrase, label = self.phrases[i]
            back = self.anchor[i]
            found += [(at - back, label) for at in places[phrase[back]] if at >= back and words[at - back : at - back + len(phrase)] == phrase]
        scores: dict[str, float] = {}
        for t, rare in candidates.items():
            label = self.templates[t][0]
            for offset in self._offsets(t, rare, places):
                score = self._verified(t, offset, words)
                if score:
                    scores[label] = max(scores.get(label, 0.0), score)
        return found, scores

    def _offsets(self, t: int, rare: list[bytes], places: dict[bytes, list[int]]) -> list[int]:
        """Offsets at which enough of the rare words' postings meet the file, near ones taken as one."""
        votes: dict[int, set[bytes]] = defaultdict(set)
        for w in rare:
            own = [i for u, i in self.postings[w] if u == t]
            for at in places[w]:
                for i in own:
                    votes[at - i].add(w)
        least = max(1, math.ceil(self.agree * len(rare)))
        kept, last = [], None
        for offset in sorted(votes):
            agreeing = set().union(*(votes.get(o, ()) for o in range(offset, offset + self.moved + 1)))
            if len(agreeing) >= least and (last is None or offset - last > self.moved):
                best = max(range(offset, offset + self.moved + 1), key=lambda o: (len(votes.get(o, ())), -o))
                kept.append(best)
                last = offset
        return kept

    def _verified(self, t: int, offset: int, words: list[bytes]) -> float:
        """Share of the template's words in place, each by at most ``moved`` words; 0 if a key phrase is missing."""
        _, text, keys = self.templates[t]
        lo, hi = max(0, offset - self.moved), offset + len(text) + self.moved
        near = words[lo:hi]
        for key in keys:
            if not any(near[i : i + len(key)] == key for i in range(len(near) - len(key) + 1)):
                return 0.0
        there = Counter()
        for i, w in enumerate(text):
            window = words[max(0, offset + i - self.moved) : max(0, offset + i + self.moved + 1)]
            there[w in window] += 1
        return there[True] / len(text)


def _frequencies(vocabulary: frozenset[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, counts = 0, Counter()
        for batch in batches:
            for text in text_bytes(batch.column("text")):
                total += 1
                counts.update(vocabulary.intersection(words_of(text)))
        rows = [("", total), *((w.decode(), n) for w, n in sorted(counts.items()))]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())], ["word", "n"])

    return run


_COLUMNS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def _scan(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in text_bytes(batch.column("text")):
                words = words_of(text)
                places, scores = index.scan(words)
                base = {label for _, label in places}
                at = [p for p, _ in places]
                best = max([0.0, *scores.values(), *([0.5] if base else [])])
                rows.append((len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | set(scores))), best))
            cols = list(zip(*rows)) if rows else [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            names = [c.split()[0] for c in _COLUMNS.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds))], ["doc_id", *names])

    return run


def scan(docs: DataFrame, index: Index | None = None) -> DataFrame:
    """doc_id, n_words, n_base (all places of plain phrases), first_word and last_word (the first and last of their
    starts), base_labels, labels (with those of the templates) and score: the best template's share of words in place,
    at least 0.5 where a plain phrase stands."""
    small_batches(docs.sparkSession)
    index = index or Index()
    counts = docs.select("text").mapInArrow(_frequencies(index.words), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    frequency = {r["word"].encode(): r["n"] for r in counts.collect()}  # at most one row for each template word
    index.weigh(frequency.pop(b"", 0), frequency)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_scan(index), f"doc_id {kind}, {_COLUMNS}")


@query("op1_license_scans")
def op1_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))
