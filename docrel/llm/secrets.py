"""Secret scans with character Markov models, in DataFrame operations only.

Three fixed patterns give the base spans. Two first-order character models, one of random strings and one of
ordinary identifiers, are trained from labelled samples; a long token whose log-likelihood ratio favours the
random model is a further span of kind ``random``.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docrel.llm.shared import let

# The base patterns and the least length of what they must hold, in the order of kinds.
ASSIGN = r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]+"
ASSIGN_HEAD = r"^(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 12, "access": 18, "hex": 16}

#: Tokens that the models judge; shorter ones hold too few transitions.
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
#: What a model tells apart: letters, any digit as 0, any other character as _.
SYMBOLS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0_"
#: Milli-nats a transition by which the random model must be likelier.
MARGIN = 250

#: Labelled samples of ordinary identifiers: words that are joined in the usual ways.
WORDS = ("account action address amount application array average background balance batch buffer builder button cache "
         "callback category channel character client collection column command component config connection container "
         "content context control count counter create customer data database default delete description device "
         "document element email enable entry error event exception executor factory field file filter format "
         "function global group handler header height identifier image index information input instance interface "
         "internal interval invoice item job key label language layer length level library license limit line link "
         "list listener load local location manager message method model module name network node notification "
         "number object offset operation option order output package page parameter parent password path payment "
         "permission position process product profile property protocol provider query queue reader record reference "
         "register remove report request resource response result return role schedule schema score search section "
         "select server service session setting shared size source start state status step storage stream string "
         "system table target task template text thread time token total transaction transfer transform type "
         "update upload url user utility validate value variable version view width window worker writer "
         "schlüssel gestellung verarbeitung keiten lichkeit ablauf erzeugung nachricht quelque établissement "
         "mentation ciones cuenta fecha usuario nombre tiempo mente").split()


def labelled_samples(seed: int = 7, each: int = 3000) -> list[tuple[str, int]]:
    """``(text, label)`` samples; 1 is a random string. They follow from the seed alone."""
    rng, out = random.Random(seed), []
    base64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    alphabets = [base64, base64[:62], base64[:62] + "-_", base64[26:62], base64[:26] + base64[52:62], "0123456789abcdef"]
    for i in range(each):
        letters = alphabets[i % len(alphabets)]
        out.append(("".join(rng.choice(letters) for _ in range(rng.randint(20, 48))), 1))
        words = [rng.choice(WORDS) for _ in range(rng.randint(2, 5))]
        way = i % 6
        text = ("_".join(words), "-".join(words), words[0] + "".join(w.capitalize() for w in words[1:]), "/".join(words),
                "".join(words), "_".join(words).upper())[way]
        out.append((text + (str(rng.randint(0, 2030)) if rng.random() < 0.2 else ""), 0))
    return out


SPANS = "array<struct<start:int,rank:int,end:int,kind:string,token:string>>"
BLOCK = 500


def symbols_of(text: Column) -> Column:
    """Every character of ``text`` as one of SYMBOLS."""
    return F.regexp_replace(F.regexp_replace(text, "[0-9]", "0"), "[^A-Za-z0]", "_")


def train(samples: DataFrame) -> DataFrame:
    """``(a, b, gain)``: milli-nats by which the random model holds ``b`` after ``a`` likelier than the other does.

    ``samples`` has text and label. Counts get one half added for each pair of symbols. Null texts, and texts of
    fewer than two characters, add nothing. The result has one row for each pair of symbols.
    """
    spark, n = samples.sparkSession, len(SYMBOLS)
    s = symbols_of(F.col("text"))
    pairs = samples.where(F.length("text") >= 2).select("label", s.alias("s")).select(
        "label", F.explode(F.transform(F.sequence(F.lit(1), F.length("s") - 1), lambda i: F.substring("s", i, F.lit(2)))).alias("p"))
    counts = pairs.groupBy("p").agg(F.sum("label").cast("double").alias("r"), F.sum(1 - F.col("label")).cast("double").alias("o"))
    every = spark.range(n * n).select(F.col("id"), F.concat(
        F.substring(F.lit(SYMBOLS), (F.expr(f"id div {n}") + 1).cast("int"), F.lit(1)),
        F.substring(F.lit(SYMBOLS), (F.col("id") % n + 1).cast("int"), F.lit(1))).alias("p"))
    filled = every.join(counts, "p", "left").select("id", F.substring("p", 1, 1).alias("a"), F.substring("p", 2, 1).alias("b"),
                                                    *[(F.coalesce(c, F.lit(0.0)) + 0.5).alias(c) for c in "ro"])
    sums = filled.groupBy("a").agg(F.sum("r").alias("rs"), F.sum("o").alias("os"))
    gain = F.round((F.log(F.col("r") / F.col("rs")) - F.log(F.col("o") / F.col("os"))) * 1000).cast("int")
    return filled.join(sums, "a").select("id", "a", "b", gain.alias("gain"))


def train_reference(samples: list[tuple[str, int]]) -> list[int]:
    """What ``train`` gives, as a list by pair, computed without Spark; for tests and the SQL check."""
    n, at = len(SYMBOLS), {c: i for i, c in enumerate(SYMBOLS)}
    counts = [[0.5] * (n * n) for _ in range(2)]
    for text, label in samples:
        s = [at["0" if "0" <= c <= "9" else c if c in at and c not in "0_" else "_"] for c in text]
        for a, b in zip(s, s[1:]):
            counts[label][a * n + b] += 1
    sums = [[sum(c[a * n:a * n + n]) for a in range(n)] for c in counts]
    value = [1000 * (math.log(counts[1][i] / sums[1][i // n]) - math.log(counts[0][i] / sums[0][i // n])) for i in range(n * n)]
    return [math.floor(abs(v) + 0.5) * (1 if v >= 0 else -1) for v in value]


def gains(samples: DataFrame) -> list[int]:
    """The trained table in order of pairs; its size is that of SYMBOLS squared, whatever the samples."""
    return [r.gain for r in train(samples).orderBy("id").collect()]


def _found(hits: Column, gaps: Column, kind: str, rank: int, passes) -> Column:
    """Spans of the matches of a pattern, left to right, that pass, from the matches and the texts between them."""
    empty = F.array().cast(SPANS)

    def spans(hits: Column, gaps: Column) -> Column:
        def step(acc, i):
            start = acc["at"] + F.length(F.get(gaps, i))
            end = start + F.length(F.get(hits, i))
            span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), F.get(hits, i).alias("token"))
            return F.struct(end.alias("at"), F.array_append(acc["out"], span).alias("out"))

        def block(acc, k):
            # appending copies an array, so that long lists are made in blocks
            inner = F.aggregate(F.sequence(k * BLOCK, F.least(k * BLOCK + BLOCK, F.size(hits)) - 1), F.struct(acc["at"].alias("at"), empty.alias("out")), step)
            return let(inner, lambda x: F.struct(x["at"].alias("at"), F.array_append(acc["out"], x["out"]).alias("out")))

        none = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPANS}>").alias("out"))
        return F.flatten(F.aggregate(F.sequence(F.lit(0), F.floor((F.size(hits) - 1) / BLOCK).cast("int")), none, block)["out"])

    return let(hits, lambda h: F.when(F.size(h) > 0, F.filter(let(gaps, lambda g: spans(h, g)), passes)).otherwise(empty))


def scan(docs: DataFrame, table: list[int], key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, assign, access, hex, random, spans``: arrays of ``(start, rank, end, kind, token)`` spans of every text.

    Offsets are code points, ends exclusive. ``table`` is what ``gains`` gives. Of a kind, matches are leftmost and do not
    overlap; one whose held part is too short is dropped after it was matched. ``random`` holds tokens of 20
    characters or more whose mean gain reaches MARGIN and that overlap no base span. One pass over the rows, no
    exchange. Null and empty texts have no spans; keys may be null or repeat; other columns are ignored.
    """
    n = len(SYMBOLS)
    body = F.coalesce(F.col(text), F.lit(""))
    # a cheap look first: the exact patterns run on texts that can match
    rows = docs.select(F.col(key).alias("key"), body.alias("body"))
    lower = F.lower("body")
    hinted = rows.withColumns({
        "for_assign": F.when(lower.contains("passw") | lower.contains("secret") | lower.contains("token") | lower.contains("api"), F.col("body")).otherwise(""),
        "for_access": F.when(F.col("body").contains("AKIA"), F.col("body")).otherwise(""),
        "for_hex": F.when(F.col("body").rlike("[0-9a-f]{16}"), F.col("body")).otherwise(""),
        "for_random": F.when(F.col("body").rlike(TOKEN), F.col("body")).otherwise("")})
    long_enough = {
        "assign": lambda s: F.length(F.regexp_replace(s["token"], ASSIGN_HEAD, "")) >= LEAST["assign"],
        "access": lambda s: F.length(s["token"]) >= LEAST["access"],
        "hex": lambda s: F.length(s["token"]) >= LEAST["hex"]}
    # maximal runs of 16 and more are the runs of HEX that pass
    kinds = {"assign": ASSIGN, "access": ACCESS, "hex": "[0-9a-f]{16,}", "random": TOKEN}
    cut = hinted.select("key", *[c for k, p in kinds.items() for c in (
        F.regexp_extract_all(F.col(f"for_{k}"), F.lit(p), F.lit(0)).alias(f"hits_{k}"), F.split(F.col(f"for_{k}"), p).alias(f"gaps_{k}"))])
    tokens = cut.select("key", *[_found(F.col(f"hits_{k}"), F.col(f"gaps_{k}"), k, rank, long_enough.get(k, lambda s: F.lit(True))).alias("tokens" if k == "random" else k)
                                 for rank, k in enumerate(kinds)])
    values = F.lit(table)

    def gain(token):
        # codes are an array, made once a token: characters of a text can only be reached by counting from its start
        codes = F.transform(F.filter(F.split(symbols_of(token), ""), lambda c: c != ""), lambda c: F.call_function("locate", c, F.lit(SYMBOLS)) - 1)
        total = lambda c: F.aggregate(F.sequence(F.lit(1), F.size(c) - 1), F.lit(0), lambda acc, i: acc + F.get(values, F.get(c, i - 1) * n + F.get(c, i)))
        return let(codes, total)

    base = tokens.withColumn("base", F.array_sort(F.concat("assign", "access", "hex")))

    def clear(base: Column) -> Column:
        return F.filter("tokens", lambda t: ~F.exists(base, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])) & (gain(t["token"]) >= MARGIN * (F.length(t["token"]) - 1)))

    scored = base.withColumn("random", let(F.col("base"), clear))
    return scored.select(F.col("key").alias(key), "assign", "access", "hex", "base", "random",
                         F.array_sort(F.concat("base", "random")).alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of base spans, the SHA-256 of their list and the list of all spans."""
    return found.select(
        key, *[F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))
