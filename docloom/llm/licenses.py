"""License scans (operator 4).

Method: exact set-similarity join of text blocks with license templates. A block is a rolling window of as many words as a template
has, across line ends. Tokens are ordered by their frequency over the whole corpus, rare first. A block meets a template when it holds at
least ``threshold`` of the template's distinct tokens. Then

* prefix filter: of the template's ``n`` tokens, ``need = ceil(threshold * n)`` are in the block, so one of its rarest
  ``n - need + 1`` tokens is: only texts with such a token are looked at, by an index from token to templates;
* length filter: the text has at least ``need`` words, and ``need`` of the template's tokens;
* positional filter: a window opens at a token of the template, and only while at least ``need`` of them are left behind it.

What passes is verified by counting distinct tokens, so the join is exact. Templates of fewer than ``ORDERED`` words say little as sets:
their words have to stand in order, one after the other. Base matches are places where the words of a phrase stand consecutively, across lines.

The template side is a parameter of fixed size and is sent to every task; texts are scanned twice, for the token
counts and for the join, and never shuffled. Counts leave a task as one row per template token.

Defined cases: null text counts as empty (no words, no labels, score 0); a null ``doc_id`` stays null; repeated rows are
scanned row by row; an empty table gives no rows; clashing extra columns are not taken along.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docloom.llm.license_texts import TEMPLATES

THRESHOLD = 0.9
#: Phrases of the base scan and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Templates of fewer words are matched as phrases.
ORDERED = 8
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text: str) -> list[str]:
    return WORD.findall(text.translate(LOWER))


def template_words(templates: Mapping[str, list[str]] = TEMPLATES) -> list[tuple[str, list[str]]]:
    return [(label, words(t)) for label, texts in sorted(templates.items()) for t in texts]


def token_counts(docs: DataFrame, tokens: set[str], text: str = "text") -> dict[str, int]:
    """How often each of the given tokens occurs in all texts. One row per task and token is shuffled."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if t:
                    found = Counter(words(t))
                    total.update({w: found[w] for w in tokens & found.keys()})
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["token", "n"])

    rows = docs.select(text).mapInArrow(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return {r["token"]: r["n"] for r in rows.collect()}


class Index:
    """Templates with their tokens in corpus order, and the prefix index."""

    def __init__(self, templates: list[tuple[str, list[str]]], counts: Mapping[str, int], threshold: float):
        self.templates, self.prefix, self.phrases = [], {}, []
        for label, found in templates:
            if len(found) < ORDERED:
                self.phrases.append((label, found))
                continue
            order = sorted(set(found), key=lambda w: (counts.get(w, 0), w))
            need = math.ceil(threshold * len(order) - 1e-9)
            for token in order[: len(order) - need + 1]:
                self.prefix.setdefault(token, []).append(len(self.templates))
            self.templates.append((label, frozenset(order), need, len(found)))
        self.rare = frozenset(self.prefix)
        self.firsts = frozenset(p[0] for _, p in self.phrases)

    def matches(self, text: list[str]) -> list[tuple[int, str, float]]:
        """(first word, label, containment) of the best window per template that the text meets, the first one on ties."""
        there, out = set(text), []
        if not self.firsts.isdisjoint(there):
            for label, phrase in self.phrases:
                at = next(places(text, phrase), None) if phrase[0] in there else None
                if at is not None:
                    out.append((at, label, 1.0))
        for k in {k for token in self.rare & there for k in self.prefix[token]}:
            label, tokens, need, length = self.templates[k]
            if len(text) < need or len(tokens & there) < need:
                continue
            best, at = best_window(text, tokens, length, need)
            if best >= need:
                out.append((at, label, best / len(tokens)))
        return out


def places(text: list[str], phrase: list[str]) -> Iterator[int]:
    """Where the words of ``phrase`` stand one after the other."""
    at = -1
    for _ in range(text.count(phrase[0])):
        at = text.index(phrase[0], at + 1)
        if text[at:at + len(phrase)] == phrase:
            yield at


def best_window(text: list[str], tokens: frozenset[str], length: int, need: int) -> tuple[int, int]:
    """Most distinct ``tokens`` in a window of ``length`` words, and the first start of such a window at a token. Linear in the text."""
    hits = [i for i, w in enumerate(text) if w in tokens]
    held: dict[str, int] = {}
    best, at, end = 0, -1, 0
    for k, i in enumerate(hits):
        if len(hits) - k < need:
            break
        while end < len(hits) and hits[end] < i + length:
            w = text[hits[end]]
            held[w] = held.get(w, 0) + 1
            end += 1
        if len(held) > best:
            best, at = len(held), i
        held[text[i]] -= 1
        if not held[text[i]]:
            del held[text[i]]
    return best, at


def scan(docs: DataFrame, templates: Mapping[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD,
         phrases: Mapping[str, str] = PHRASES, text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` and ``blocks``.

    ``blocks`` lists the best window of each template found as (first word from 0, label, containment); ``score`` is the highest containment, 1 with a base match.
    """
    known = template_words(templates)
    counts = token_counts(docs, set().union(*[w for _, w in known]), text)
    wanted = [(p.split(), label) for p, label in phrases.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(known, counts, threshold)
        firsts = {p[0] for p, _ in wanted}
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                rows = [one(t or "", index, firsts) for t in part.column(1).to_pylist()]
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names=["doc_id", *names])

    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "blocks"]
    block = pa.struct([("word", pa.int64()), ("label", pa.string()), ("containment", pa.float64())])
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(block)]

    def one(t: str, index: Index, firsts: set[str]):
        found = words(t)
        starts, base = [], set()
        if not firsts.isdisjoint(found):
            for phrase, label in wanted:
                for at in places(found, phrase):
                    starts.append(at)
                    base.add(label)
        blocks = [{"word": at, "label": label, "containment": c} for at, label, c in index.matches(found)]
        labels = base | {b["label"] for b in blocks}
        score = 1.0 if base else max([0.0, *(b["containment"] for b in blocks)])
        return (len(found), len(starts), min(starts, default=None), max(starts, default=None),
                ",".join(sorted(base)), ",".join(sorted(labels)), score, sorted(blocks, key=lambda b: (b["word"], b["label"], b["containment"])))

    schema = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
              "blocks array<struct<word: long, label: string, containment: double>>")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text)).mapInArrow(run, schema)
