"""Benchmark decontamination by pigeonhole edit matching.

A test item that occurs in a document with at most ``k`` edits, cut into ``k + 1`` pieces, has a piece without an
edit. One automaton (Aho-Corasick) finds all exact hits of pieces; around each hit, Myers' bit-parallel algorithm
(1999) gives the least edit distance of the item to any part of the document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import ahocorasick
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docrel.llm.shared import checkpointed

#: Edits allowed, as a share of an item's characters.
ERROR_RATE = 0.05
#: Items are scanned for in blocks of so many characters, so that automata stay small; each block reads all documents.
BLOCK_CHARS = 2_000_000
#: Shorter items (in characters, normalised) count only where they occur without an edit, as whole words.
LEAST_CHARS = 40

_OTHER = re.compile(r"[\W_]+")


def normalise(text: str | None) -> str:
    """Lower case, with every run of other characters than letters and digits as one blank."""
    return _OTHER.sub(" ", (text or "").lower()).strip()


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` pieces of nearly equal length, with their offsets."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: str, text: str) -> int:
    """The least edit distance of ``pattern`` to any substring of ``text``."""
    m = len(pattern)
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    full, high = (1 << m) - 1, 1 << m - 1
    pv, mv, score = full, 0, m
    best = m
    for c in text:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & high:
            score += 1
        if mh & high:
            score -= 1
            if score < best:
                best = score
        ph = ph << 1 & full
        mh = mh << 1 & full
        pv = mh | (full & ~(xv | ph))
        mv = ph & xv
    return best


class Matcher:
    """Finds items, given as ``(item_id, text)``, in documents."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float = ERROR_RATE, least_chars: int = LEAST_CHARS):
        self.items, found = [], {}
        for item_id, text in items:
            text = normalise(text)
            if text:
                budget = int(len(text) * error_rate) if len(text) >= least_chars else 0
                for at, piece in pieces(text, budget):
                    found.setdefault(piece, []).append((len(self.items), at))
                self.items.append((item_id, text, budget, len(text) < least_chars))
        self.automaton = ahocorasick.Automaton() if found else None
        for piece, uses in found.items():
            self.automaton.add_word(piece, (len(piece), uses))
        if found:
            self.automaton.make_automaton()

    def find(self, text: str | None) -> dict[int, int]:
        """``{item_id: least distance}`` of the items that occur within their budget."""
        if self.automaton is None:
            return {}
        doc, spots = normalise(text), {}
        for end, (n, uses) in self.automaton.iter(doc):
            for item, at in uses:
                spots.setdefault(item, set()).add(end + 1 - n - at)
        out: dict[int, int] = {}
        for item, starts in spots.items():
            item_id, pattern, budget, short = self.items[item]
            if short:
                starts = [s for s in starts if doc[max(0, s - 1) : s].strip() == "" and doc[s + len(pattern) : s + len(pattern) + 1].strip() == ""]
            best, upto = budget + 1, -1
            for start in sorted(starts):
                if best == 0:
                    break
                if doc.startswith(pattern, start) and start >= 0:
                    best = 0
                elif start + len(pattern) + budget > upto:
                    # one window for all starts that lie within a budget of the first
                    window = doc[max(0, start - budget) : start + len(pattern) + 2 * budget]
                    upto = start + len(pattern) + 2 * budget
                    best = min(best, myers(pattern, window))
            if best <= budget:
                out[item_id] = min(best, out.get(item_id, best))
        return out


_matchers: dict[tuple, Matcher] = {}


def _matcher(items: tuple, error_rate: float, least_chars: int) -> Matcher:
    """The worker's own automaton; one at a time is kept."""
    at = (hash(items), error_rate, least_chars)
    if at not in _matchers:
        _matchers.clear()
        _matchers[at] = Matcher(list(items), error_rate, least_chars)
    return _matchers[at]


def _blocks(items: DataFrame, item: str, text: str, unnumbered: bool) -> Iterator[tuple]:
    """Items in blocks of at most BLOCK_CHARS characters (or one item); the driver holds one block at a time."""
    block, size = [], 0
    for item_id, body in (items if unnumbered else items.where(F.col(item).isNotNull())).select(item, text).toLocalIterator():
        if block and size + len(body or "") > BLOCK_CHARS:
            yield tuple(block)
            block, size = [], 0
        block.append((item_id, body or ""))
        size += len(body or "")
    if block:
        yield tuple(block)


def _leaks(block: Broadcast, kind: T.ArrayType, error_rate: float, least_chars: int):
    @F.pandas_udf(kind)
    def leaks(texts: pd.Series) -> pd.Series:
        matcher = _matcher(block.value, error_rate, least_chars)
        return pd.Series([[{"item_id": i, "distance": d} for i, d in sorted(matcher.find(t).items(), key=lambda x: (x[0] is None, x[0] or 0))] for t in texts])

    return leaks


def annotate(docs: DataFrame, items: DataFrame, name: str = "__leaks", text: str = "text", item: str = "item_id", item_text: str = "text",
             error_rate: float = ERROR_RATE, least_chars: int = LEAST_CHARS, unnumbered: bool = False) -> DataFrame:
    """``docs`` with one more column, an array of ``(item_id, distance int)`` of the items that each row holds.

    Items that fit in one block are one pass over whole texts without an exchange. Beyond, every block is a job of its
    own, of which only texts that hold an item leave a row, by the SHA-256 of the text; so workers and driver hold one block
    at a time. Texts and items are compared normalised. Null and empty texts hold nothing. Ids are of any type. Items under
    ``least_chars`` are searched for word for word. Items without an id are skipped, or with ``unnumbered`` give one element
    with a null id, whichever of them a row holds. An empty table of items gives empty arrays. ``name`` may not be a column
    of ``docs``.
    """
    if name in docs.columns:
        raise ValueError(f"column {name} is there already")
    kind = T.ArrayType(T.StructType([T.StructField("item_id", items.schema[item].dataType), T.StructField("distance", T.IntegerType())]))
    context, blocks = docs.sparkSession.sparkContext, _blocks(items, item, item_text, unnumbered)
    first = next(blocks, ())
    second = next(blocks, None)
    if second is None:
        return docs.withColumn(name, _leaks(context.broadcast(first), kind, error_rate, least_chars)(F.col(text)))
    parts, digest = [], F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    for block in chain((first, second), blocks):
        shared = context.broadcast(block)
        found = docs.select(digest.alias("__digest"), _leaks(shared, kind, error_rate, least_chars)(F.col(text)).alias("__found")).where(F.size("__found") > 0)
        parts.append(checkpointed(found.groupBy("__digest").agg(F.first("__found").alias("__found"))))
        shared.destroy()
    every = reduce(DataFrame.unionByName, parts).groupBy("__digest").agg(F.flatten(F.collect_list("__found")).alias("__found"))
    own, other = docs.select(F.struct(*docs.columns).alias("row"), digest.alias("__digest")), checkpointed(every)
    met = own.join(other, "__digest", "left")
    return met.select("row.*", F.coalesce("__found", F.array().cast(kind)).alias(name))


def _free_name(docs: DataFrame) -> str:
    name = "__leaks"
    while name in docs.columns:
        name += "_"
    return name


def decontaminate(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that hold no item, with their columns."""
    name = _free_name(docs)
    return annotate(docs, items, name, **settings).where(F.size(name) == 0).drop(name)


def report(docs: DataFrame, items: DataFrame, key: str = "doc_id", **settings) -> DataFrame:
    """``key, contaminated, n_items, item_ids, least_distance`` of every row; the last is null for clean rows."""
    found = annotate(docs.select(key, settings.get("text", "text")), items, **settings)
    ids = F.array_sort(F.transform("__leaks", lambda x: x["item_id"]))
    return found.select(key, (F.size("__leaks") > 0).alias("contaminated"), F.size("__leaks").cast("long").alias("n_items"),
                        F.array_join(ids.cast("array<string>"), ",").alias("item_ids"),
                        F.array_min(F.transform("__leaks", lambda x: x["distance"])).alias("least_distance"))
