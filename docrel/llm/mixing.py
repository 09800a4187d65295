"""Mixing sources to target weights by iterative proportional fitting.

Tokens are counted by source, language and topic. Raking scales the cells of this table to each marginal in turn until
all fit; a document is then kept with a probability in proportion to its cell's factor, decided by a hash of its key.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

#: Fixed number of rounds over the three marginals.
ROUNDS = 30
OTHER = "other"
#: Production targets: shares of tokens. Values that are not named count as ``other``.
SOURCES: Mapping[str, float] = {"src0": 0.12, **{f"src{i}": 0.045 for i in range(1, 20)}, OTHER: 0.025}
LANGS: Mapping[str, float] = {"en": 0.5, "de": 0.2, "fr": 0.18, "es": 0.1, OTHER: 0.02}
TOPICS: Mapping[str, float] = {"tabular": 0.05, "figures": 0.15, "long": 0.5, "short": 0.3}
#: Tokens that the pipeline keeps, as a share of those it gets.
BUDGET = 0.1


def topic_of(text: Column) -> Column:
    """The topic: tabular with 5 bars or more, figures with a run of 3 digits, else long from 2,000 characters, else short."""
    bars = F.length(text) - F.length(F.replace(text, F.lit("|")))
    return F.when(bars >= 5, "tabular").when(text.rlike("[0-9]{3}"), "figures").when(F.length(text) >= 2000, "long").otherwise("short")


def tokens_of(text: Column) -> Column:
    """Runs of characters other than ASCII blanks, 1 at least, so that every document has a weight."""
    return F.greatest(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(1)).cast("long")


def _named(value: Column, targets: Mapping[str, float]) -> Column:
    return F.when(value.isin([t for t in targets if t != OTHER]), value).otherwise(OTHER)


def rake(cells: Mapping[tuple[str, ...], float], targets: list[Mapping[str, float]], rounds: int = ROUNDS) -> dict[tuple[str, ...], float]:
    """Weights of ``cells`` whose sums over each place of their names follow the targets, total 1.

    Targets of values that no cell has are left out and the others scaled to 1; a value without a target, or with a
    target of 0, gets no weight. Cells go in the order of their names, so the sums, to the last bit, do not depend on
    how the table came.
    """
    names = sorted(cells)
    weights = [float(cells[n]) for n in names]
    for _ in range(rounds):
        for place, target in enumerate(targets):
            sums: dict[str, float] = {}
            for n, w in zip(names, weights):
                sums[n[place]] = sums.get(n[place], 0.0) + w
            whole = sum(target.get(v, 0.0) for v in sorted(sums) if sums[v] > 0)
            weights = [w * (target.get(n[place], 0.0) / whole / sums[n[place]] if whole and sums[n[place]] else 0.0) for n, w in zip(names, weights)]
    return dict(zip(names, weights))


def _shares(caps: Mapping[str, float], target: Mapping[str, float], budget: float) -> dict[str, float]:
    """Tokens of each value: in proportion to its target, but no more than ``caps`` has; the others share what is short."""
    open_, out, left = {v for v in caps if target.get(v, 0.0) > 0}, dict.fromkeys(caps, 0.0), budget
    while open_:
        whole = sum(target[v] for v in sorted(open_))
        full = {v for v in open_ if left * target[v] / whole >= caps[v]}
        if not full:
            return out | {v: left * target[v] / whole for v in open_}
        out |= {v: float(caps[v]) for v in full}
        left, open_ = max(0.0, left - sum(caps[v] for v in sorted(full))), open_ - full
    return out


def _scale(cells: list[tuple[float, float]], want: float) -> float:
    """``s`` such that ``n * min(1, m * s)`` of the cells ``(m, n)`` sum to ``want``."""
    cells = sorted((c for c in cells if c[0] > 0), reverse=True)
    held, loose = 0.0, sum(m * n for m, n in cells)
    for m, n in cells:
        s = (want - held) / loose if loose > 0 else 0.0
        if m * s <= 1:
            return max(0.0, s)
        held, loose = held + n, loose - m * n
    return 1 / cells[-1][0] if cells else 0.0


def rake_within(cells: Mapping[tuple[str, ...], float], targets: list[Mapping[str, float]], budget: float, rounds: int = ROUNDS) -> dict[tuple[str, ...], float]:
    """Tokens to keep of each cell, ``budget`` in all where that many can be had, raked to the targets.

    No cell gives more than it has. What a value is short of its target goes to the other values of its place in
    proportion to their targets, so a rare value moves no more than its own tokens.
    """
    names = sorted(cells)
    wanted = []
    for place, target in enumerate(targets):
        caps: dict[str, float] = {}
        for n in names:
            if all(t.get(v, 0.0) > 0 for v, t in zip(n, targets)):
                caps[n[place]] = caps.get(n[place], 0.0) + cells[n]
        wanted.append(_shares(caps, target, budget))
    factors = {n: 1.0 if all(w.get(v, 0.0) > 0 for v, w in zip(n, wanted)) else 0.0 for n in names}
    for _ in range(rounds):
        for place, want in enumerate(wanted):
            for value in sorted(want):
                own = [n for n in names if n[place] == value]
                scale = _scale([(factors[n], cells[n]) for n in own], want[value])
                factors |= {n: factors[n] * scale for n in own}
    return {n: cells[n] * min(1.0, factors[n]) for n in names}


def shortfall(cells: Mapping[tuple[str, ...], float], targets: list[Mapping[str, float]], budget: float) -> list[tuple[int, str, float, float]]:
    """``(place, value, tokens wanted, tokens kept)`` of the targets, of those that cells have, that ``rake_within`` misses by over 1 %."""
    kept, out = rake_within(cells, targets, budget), []
    for place, target in enumerate(targets):
        found = sorted({n[place] for n in cells if target.get(n[place], 0.0) > 0})
        whole = sum(target[v] for v in found)
        for v in found:
            want, got = budget * target[v] / whole, sum(kept[n] for n in sorted(kept) if n[place] == v)
            if got < 0.99 * want:
                out.append((place, v, want, got))
    return out


def _cells(docs: DataFrame, targets: list[Mapping[str, float]], source: str, lang: str, text: str, topic: Column | None) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns({
        "__source": _named(F.col(source), targets[0]), "__lang": _named(F.col(lang), targets[1]),
        "__topic": _named(topic_of(body) if topic is None else topic, targets[2]), "__tokens": tokens_of(body)})


def weigh(docs: DataFrame, targets: list[Mapping[str, float]] | None = None, key: str = "doc_id", source: str = "source", lang: str = "lang",
          text: str = "text", topic: Column | None = None, seed: int = 20, budget: float | None = None) -> DataFrame:
    """``docs`` with ``__source, __lang, __topic, __tokens, __factor, __probability, __draw, __keep``.

    ``__factor`` is a cell's share after raking over its share before; ``__probability`` is the factor over the largest
    one, so that no probability passes 1 and the expected tokens kept follow the targets exactly; ``__draw`` comes from
    the key's MD5, so that a document's fate does not change with partitions or retries.

    That lets the rarest cell decide how much is kept of all. With ``budget``, a share of the tokens, the cells give
    what ``rake_within`` says: the probability is the share of a cell's tokens to keep, and targets that the data
    cannot fill are logged as short.

    The driver receives one row for each cell of the three target lists, ``other`` included: at most the product of
    their lengths, whatever the data. Null and unnamed values count as ``other``, null and empty texts as one token;
    null keys draw as empty texts; rows that repeat a key share its draw. An empty table gives no rows.
    """
    targets = [SOURCES, LANGS, TOPICS] if targets is None else targets
    placed = _cells(docs, targets, source, lang, text, topic)
    table = placed.groupBy("__source", "__lang", "__topic").agg(F.sum("__tokens").alias("n")).collect()
    cells = {(r[0], r[1], r[2]): r.n for r in table}
    whole = sum(cells.values())
    if budget is None:
        weights = rake(cells, targets)
        factors = {c: weights[c] / (cells[c] / whole) for c in cells}
        top = max(factors.values(), default=0.0) or 1.0
    else:
        weights, top = rake_within(cells, targets, budget * whole), 1 / budget
        factors = {c: weights[c] / cells[c] / budget for c in cells}
        for place, value, want, got in shortfall(cells, targets, budget * whole):
            log.warning("%s %s: %.0f tokens kept of %.0f wanted", ("source", "lang", "topic")[place], value, got, want)
    flat = [x for c, f in sorted(factors.items()) for x in (F.lit("\x1f".join(c)), F.lit(float(f)))]
    chosen = F.create_map(*flat) if flat else F.lit(None).cast("map<string,double>")
    factor = F.try_element_at(chosen, F.concat_ws("\x1f", "__source", "__lang", "__topic"))
    out = placed.withColumn("__factor", factor).withColumn("__probability", F.col("__factor") / top)
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("")))), 1, 12)
    return out.withColumn("__draw", F.conv(digits, 16, 10).cast("double") / float(2**48)).withColumn("__keep", F.col("__draw") < F.col("__probability"))


def sample(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that ``weigh`` keeps, with their columns."""
    return weigh(docs, **settings).where("__keep").select(*docs.columns)
