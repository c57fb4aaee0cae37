"""Licence scans with a generalised suffix automaton over licence words.

All templates and phrases make one automaton. A text's words run through it once and give, at
each place, the longest match that ends there. Matches that cannot be extended are chained per
template, in the order of text and template, into spans; a span that covers most of its
template is a finding. Phrases are found at every place.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases and their labels, and usual short notices of public licences.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
TEMPLATES = (
    ("apache-2", "licensed under the apache license version 2 0"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl-2", "licensed under the gnu general public license version 2"),
    ("gpl-3", "under the terms of the gnu general public license as published by the free software foundation either version 3"),
    ("lgpl-3", "licensed under the gnu lesser general public license version 3"),
    ("agpl-3", "licensed under the gnu affero general public license version 3"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by-4", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa-4", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
MIN_MATCH = 4
MAX_GAP = 6
MIN_COVERED = 0.8
RESULT = "n_words long, spans array<struct<label:string,base:boolean,first:long,end:long,covered:double>>"

#: Letters in lower case; every other ASCII byte but digits ends a word.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


class Automaton:
    """Suffix automaton of several word sequences.

    Per state: arcs, the longest match, the failure link, the end of a first occurrence in
    every sequence that has it, and the phrases that end there, with those of the links above.
    """

    def __init__(self, phrases=PHRASES, templates=TEMPLATES):
        self.word: dict[bytes, int] = {}
        self.arcs: list[dict[int, int]] = [{}]
        self.length, self.link = [0], [-1]
        self.ends: list[dict[int, int]] = [{}]
        self.templates = [(label, text.encode().split()) for label, text in templates]
        rows = [[self.word.setdefault(w, len(self.word)) for w in words] for _, words in self.templates]
        phrase_rows = [[self.word.setdefault(w, len(self.word)) for w in text.encode().split()] for _, text in phrases]
        for k, row in enumerate(rows + phrase_rows):
            at = 0
            for place, w in enumerate(row):
                at = self._extend(at, w)
                self.ends[at].setdefault(k, place)
        for s in sorted(range(1, len(self.arcs)), key=lambda s: -self.length[s]):
            for k, place in self.ends[s].items():
                self.ends[self.link[s]].setdefault(k, place)
        self.ends = [{k: p for k, p in e.items() if k < len(rows)} for e in self.ends]
        self.phrases: list[tuple[tuple[str, int], ...]] = [()] * len(self.arcs)
        final = {}
        for (label, _), row in zip(phrases, phrase_rows, strict=True):
            s = 0
            for w in row:
                s = self.arcs[s][w]
            final.setdefault(s, []).append((label, len(row)))
        for s in sorted(range(1, len(self.arcs)), key=lambda s: self.length[s]):
            self.phrases[s] = (*final.get(s, ()), *self.phrases[self.link[s]])

    def _state(self, length: int, arcs: dict[int, int], link: int) -> int:
        self.arcs.append(arcs)
        self.length.append(length)
        self.link.append(link)
        self.ends.append({})
        return len(self.arcs) - 1

    def _split(self, p: int, w: int) -> int:
        """The state of exactly the words of p and then w."""
        q = self.arcs[p][w]
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(self.length[p] + 1, dict(self.arcs[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.arcs[p].get(w) == q:
            self.arcs[p][w] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, w: int) -> int:
        if w in self.arcs[last]:
            return self._split(last, w)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and w not in self.arcs[p]:
            self.arcs[p][w] = new
            p = self.link[p]
        self.link[new] = self._split(p, w) if p >= 0 else 0
        return new

    def scan(self, words: list[bytes], min_match: int, max_gap: int, min_covered: float) -> list[tuple[str, bool, int, int, float]]:
        """(label, base, first word, end, covered share of the template) of all findings."""
        word, arcs, link, length, phrases = self.word, self.arcs, self.link, self.length, self.phrases
        found, matches = [], []
        s = l = 0
        before = -2
        for i, w in [(i, word[w]) for i, w in enumerate(words) if w in word]:
            if i != before + 1:
                if l >= min_match:
                    matches.append((before, l, s))
                s = l = 0
            elif l >= min_match and w not in arcs[s]:
                matches.append((before, l, s))
            while s and w not in arcs[s]:
                s = link[s]
                l = length[s]
            if w in arcs[s]:
                s = arcs[s][w]
                l += 1
            for label, n in phrases[s]:
                if n <= l:
                    found.append((label, True, i - n + 1, i + 1, 1.0))
            before = i
        if l >= min_match:
            matches.append((before, l, s))
        return found + self._chained(matches, max_gap, min_covered)

    def _chained(self, matches: list[tuple[int, int, int]], max_gap: int, min_covered: float) -> list:
        """Chains per template: both sides go on, with few words between."""
        open_: dict[int, list[int]] = {}  # first word, end, end in the template, covered words
        done: list[tuple[int, list[int]]] = []
        for last, n, s in matches:
            for k, place in self.ends[s].items():
                chain = open_.get(k)
                if chain and last - n + 1 - chain[1] <= max_gap and place > chain[2]:
                    chain[3] += min(n, last + 1 - chain[1], place - chain[2])
                    chain[1], chain[2] = last + 1, place
                else:
                    if chain:
                        done.append((k, chain))
                    open_[k] = [last - n + 1, last + 1, place, n]
        done += open_.items()
        out = []
        for k, (first, end, _, covered) in done:
            label, words = self.templates[k]
            if (share := min(1.0, covered / len(words))) >= min_covered:
                out.append((label, False, first, end, share))
        return out


def license_spans(
    text: Column, phrases=PHRASES, templates=TEMPLATES, min_match=MIN_MATCH, max_gap=MAX_GAP, min_covered=MIN_COVERED
) -> Column:
    """Struct of n_words and spans (label, base, first, end, covered) of each whole text."""

    @F.pandas_udf(RESULT)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = Automaton(phrases, templates)
        names = ("label", "base", "first", "end", "covered")
        for batch in batches:
            n, spans = [], []
            for text in batch:
                words = words_of(text)
                n.append(len(words))
                rows = automaton.scan(words, min_match, max_gap, min_covered)
                spans.append([dict(zip(names, x, strict=True)) for x in rows])
            yield pd.DataFrame({"n_words": n, "spans": spans})

    return scan(text.cast("string"))


def scan_licenses(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """Documents with n_words and spans, and from these n_base, first_word, last_word,
    base_labels, labels and score.

    Only ``text`` is read; other columns stay, those of the new names are replaced. Null and
    empty texts have no words and no spans. Repeated rows are scanned each. One text is scanned
    by one task in time linear in its words. An empty table gives no rows. The score is the
    largest covered share of a template, 1 for a phrase, 0 without findings.
    """
    new = ("n_words", "spans", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    kept = [c for c in docs.columns if c not in new or c == text]
    spans = F.col("__found.spans")
    base = F.filter(spans, lambda s: s["base"])
    joined = lambda rows: F.array_join(F.array_sort(F.array_distinct(F.transform(rows, lambda s: s["label"]))), ",")
    firsts = F.transform(base, lambda s: s["first"])
    return docs.select(*kept, license_spans(F.col(text), **options).alias("__found")).select(
        *kept,
        "__found.n_words",
        spans.alias("spans"),
        F.size(base).cast("long").alias("n_base"),
        F.array_min(firsts).alias("first_word"),
        F.array_max(firsts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(spans).alias("labels"),
        F.coalesce(F.array_max(F.transform(spans, lambda s: s["covered"])), F.lit(0.0)).alias("score"),
    )
