"""License notices by templates with optional and replaceable regions.

A template is wording with marks: ``<<beginOptional>>`` ... ``<<endOptional>>`` around what may be
left out, and ``<<var;words=N>>`` for up to N words of any kind. Each template becomes an automaton
over words. A text has the template's label wherever the automaton accepts, so all wording outside
of such regions must stand there word for word. Base phrases are templates without regions. Texts of
licenses are templates from their first to their last word (:mod:`opinarium.llm.license_texts`).

Words are runs of digits, letters and characters beyond ASCII, with A-Z in lower case; everything
else separates. Null and empty texts have no words. Whole texts are searched. Rows may repeat. An
empty table gives no rows. Further columns of the input are not used.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from opinarium.llm.arrays import mapped, Block, block_of, blocks, byte_class, kept_in_worker, per_row, span_hashes, spans
from opinarium.llm.license_texts import WHOLE_TEXTS

# Phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Names of licenses, then whole texts and notices, accepted with all of their wording only.
TEMPLATES = {
    "apache-2.0": "apache license <<var;words=1>> version 2.0",
    "gpl-2.0": "gnu general public license <<beginOptional>>as published by the free software foundation"
               "<<endOptional>> <<beginOptional>>either<<endOptional>> version 2",
    "gpl-3.0": "gnu general public license <<beginOptional>>as published by the free software foundation"
               "<<endOptional>> <<beginOptional>>either<<endOptional>> version 3",
    "lgpl": "gnu <<beginOptional>>library or<<endOptional>> lesser general public license",
    "cc-by-4.0": "cc by 4.0",
    "cc-by-nc-4.0": "cc by nc 4.0",
    "cc-by-sa-4.0": "cc by sa 4.0",
    "cc-by-nd-4.0": "cc by nd 4.0",
    "cc0-1.0": "cc0 <<beginOptional>>1.0<<endOptional>> universal",
    "mit-notice": "released under <<beginOptional>>the terms of<<endOptional>> the <<beginOptional>>expat or<<endOptional>> mit license",
    **WHOLE_TEXTS,
}

_WORD = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFE))


def word_hashes(text: str) -> list[int]:
    block = block_of([text]).lowered()
    return span_hashes(block.data, *spans(block.data, _WORD)).tolist()


class Automaton:
    """States 0 .. accept; a state has word steps, at most one any-word step, and free steps."""

    def __init__(self, label: str, template: str, base: bool = False):
        self.label, self.base = label, base
        self.words: list[dict[int, set[int]]] = [{}]
        self.any: list[set[int]] = [set()]
        self.free: list[set[int]] = [set()]
        state, opened = 0, []
        for mark, plain in re.findall(r"<<(.*?)>>|([^<]+)", template):
            if mark == "beginOptional":
                opened.append(state)
            elif mark == "endOptional":
                self.free[opened.pop()].add(state)
            elif mark.startswith("var"):
                first = state
                between = [first]
                for _ in range(int(mark.partition("words=")[2])):
                    following = self._new()
                    self.any[state].add(following)
                    state = following
                    between.append(state)
                for s in between[:-1]:
                    self.free[s].add(state)
            else:
                for word in word_hashes(plain):
                    following = self._new()
                    self.words[state].setdefault(word, set()).add(following)
                    state = following
        if opened:
            raise ValueError(f"an optional region of {label} is not closed")
        self.accept = state
        self.first = frozenset(w for s in self._closed({0}) for w in self.words[s])
        if any(self.any[s] for s in self._closed({0})) or self.accept in self._closed({0}):
            raise ValueError(f"the template of {label} must begin with wording")

    def _new(self) -> int:
        for table in (self.words, self.any, self.free):
            table.append({} if table is self.words else set())
        return len(self.words) - 1

    def _closed(self, states: set[int]) -> set[int]:
        states, new = set(states), list(states)
        while new:
            for s in self.free[new.pop()]:
                if s not in states:
                    states.add(s)
                    new.append(s)
        return states

    def accepts(self, words: np.ndarray, start: int, end: int) -> int:
        """Where the shortest accepted run of words from ``start`` ends, or -1."""
        states = self._closed({0})
        for at in range(start, end):
            word = int(words[at])
            following = set()
            for s in states:
                following |= self.words[s].get(word, set()) | self.any[s]
            if not following:
                return -1
            states = self._closed(following)
            if self.accept in states:
                return at + 1
        return -1


class Scanner:
    def __init__(self, base: dict[str, str], templates: dict[str, str]):
        self.automata = [*(Automaton(label, phrase, True) for phrase, label in base.items()),
                         *(Automaton(label, text) for label, text in templates.items())]
        self.by_first: dict[int, list[Automaton]] = {}
        for automaton in self.automata:
            for word in automaton.first:
                self.by_first.setdefault(word, []).append(automaton)
        self.first = np.array(sorted(self.by_first), dtype=np.uint64)

    def scan(self, block: Block) -> tuple[np.ndarray, list[list[tuple[int, int, Automaton]]]]:
        """Words per row, and per row the matches as (first word, end, automaton), words from 0."""
        block = block.lowered()
        starts, ends = spans(block.data, _WORD)
        hashes = span_hashes(block.data, starts, ends)
        bounds = per_row(block, starts)
        matches: list[list] = [[] for _ in range(len(block))]
        place = np.minimum(np.searchsorted(self.first, hashes), len(self.first) - 1)
        hits = np.flatnonzero(self.first[place] == hashes)
        rows = np.searchsorted(bounds, hits, side="right") - 1
        for at, row in zip(hits.tolist(), rows.tolist()):
            for automaton in self.by_first[int(hashes[at])]:
                end = automaton.accepts(hashes, at, int(bounds[row + 1]))
                if end >= 0:
                    low = int(bounds[row])
                    matches[row].append((at - low, end - low, automaton))
        return np.diff(bounds), matches


def find_licenses(docs: DataFrame, base: dict[str, str] = BASE, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    ``score`` is 1 - 0.5 ** (places of phrases + 2 * places of templates). ``spans`` lists
    label:first word:end of every match.
    """
    schema = T.StructType([docs.schema["doc_id"]])
    for name in ("n_words", "n_base", "first_word", "last_word"):
        schema = schema.add(name, T.LongType())
    for name in ("base_labels", "labels"):
        schema = schema.add(name, T.StringType())
    schema = schema.add("score", T.DoubleType()).add("spans", T.StringType())
    name = f"licenses {hash((tuple(base.items()), tuple(templates.items())))}"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = kept_in_worker(name, lambda: Scanner(base, templates))
        for batch in batches:
            for block in blocks(batch.column("text")):
                words, matches = scanner.scan(block)
                phrases = [[m for m in found if m[2].base] for found in matches]
                firsts = [[m[0] for m in p] for p in phrases]
                score = [1.0 - 0.5 ** (2 * len(found) - len(p)) for found, p in zip(matches, phrases)]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(block.first, len(block)),
                    pa.array(words, pa.int64()), pa.array([len(p) for p in phrases], pa.int64()),
                    pa.array([min(f, default=None) for f in firsts], pa.int64()),
                    pa.array([max(f, default=None) for f in firsts], pa.int64()),
                    pa.array([",".join(sorted({m[2].label for m in p})) for p in phrases], pa.string()),
                    pa.array([",".join(sorted({m[2].label for m in f})) for f in matches], pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array([",".join(f"{m[2].label}:{m[0]}:{m[1]}" for m in f) for f in matches], pa.string()),
                ], schema.names)

    return mapped(docs.select("doc_id", "text"), run, schema)
