"""Removal of repeated passages by content-defined chunks of lines, in DataFrame operations only.

A text is cut into lines, at line ends and after sentences, each with the blank or line end behind it, so that the
lines of a text joined are the text. A rolling hash over the hashes of two neighbouring lines decides after which line
a chunk ends: boundaries depend on content alone, so a passage has the same chunks wherever it stands, but for its
edges. Paragraphs of 50 words or more have chunks of their own. Chunks of several lines, or of 50 words, that occur
more than once are repeated if their bytes are equal; all but the first go.

What lies between two ends of chunks of a repeated passage, or beside them, stays so. ``remove_runs`` therefore takes
the rolling window at every line, not only at chunk ends: each line that stands in a repeated window goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docrel.llm.shared import checkpointed, free_shuffles, let

#: One line in so many ends a chunk; lines of the rolling window; words that make a paragraph, or a line, long.
DIVISOR, WINDOW, LONG_WORDS = 3, 2, 50


#: Repeated hashes are broadcast to where chunks are up to so many rows of two longs (some 50 MB); beyond, they are joined.
BROADCAST_ROWS = 1_000_000
SPANS, BLOCK = "array<struct<start:int,end:int>>", 64


def _words(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "))) + 1


def lines_of(text: Column) -> Column:
    """Array of ``(line, end, opens, closes)``: ``end`` is the line end behind a paragraph, else empty; the others tell
    whether the line is the first, or the last, of a long paragraph."""

    def sentences(paragraph: Column) -> Column:
        # marks and a plain split in place of a pattern, for texts without the mark
        marked = paragraph
        for stop in (". ", "! ", "? "):
            marked = F.replace(marked, F.lit(stop), F.lit(stop + "\0"))
        return F.when(F.contains(paragraph, F.lit("\0")), F.split(paragraph, r"(?<=[.!?] )")).otherwise(F.split(marked, "\0"))

    def cut(paragraph: Column, end: Column) -> Column:
        def lines(parts: Column, long: Column) -> Column:
            last = lambda i: i == F.size(parts) - 1
            return F.transform(parts, lambda x, i: F.struct(
                x.alias("line"), F.when(last(i), end).otherwise("").alias("end"), (long & (i == 0)).alias("opens"), (long & last(i)).alias("closes")))

        blank = F.array(F.struct(F.lit("").alias("line"), end.alias("end"), F.lit(False).alias("opens"), F.lit(False).alias("closes")))
        found = let(F.filter(sentences(paragraph), lambda x: x != ""), lambda parts: let(_words(paragraph) >= LONG_WORDS, lambda long: lines(parts, long)))
        return F.when(paragraph == "", blank).otherwise(found)

    cuts = let(F.split(text, "\n"), lambda ps: F.flatten(F.transform(ps, lambda p, i: cut(p, F.when(i == F.size(ps) - 1, "").otherwise("\n")))))
    return F.filter(cuts, lambda x: (x["line"] != "") | (x["end"] != ""))


def chunks_of(text: Column) -> Column:
    """Array of ``(n, body, end, several)`` chunks of a text; bodies, each with the line end behind it, joined are the text."""

    def ends(lines: Column, h: Column) -> Column:
        def ends_here(x: Column, i: Column) -> Column:
            rolled = F.xxhash64(*[F.get(h, i - back) for back in range(WINDOW - 1, -1, -1)])
            following = F.coalesce(F.get(lines, i + 1)["opens"], F.lit(True))  # no line follows the last
            return x["closes"] | following | (F.pmod(rolled, F.lit(DIVISOR)) == 0)

        return F.filter(F.transform(lines, lambda x, i: F.when(ends_here(x, i), i)), lambda i: i.isNotNull())

    def chunks(lines: Column, marks: Column) -> Column:
        def chunk(end: Column, n: Column) -> Column:
            start = F.coalesce(F.get(marks, n - 1) + 1, F.lit(0))
            before = F.array_join(F.transform(F.slice(lines, start + 1, end - start), lambda x: F.concat(x["line"], x["end"])), "")
            last = F.get(lines, end)
            return F.struct(n.alias("n"), F.concat(before, last["line"]).alias("body"), last["end"].alias("end"), (end > start).alias("several"))

        return F.transform(marks, chunk)

    def whole(lines: Column) -> Column:
        hashes = F.transform(lines, lambda x: F.xxhash64(F.trim(x["line"])))
        return let(let(hashes, lambda h: ends(lines, h)), lambda marks: chunks(lines, marks))

    return let(lines_of(text), whole)


def chunked(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, row, parts``: the hash of the text (null: empty) and its chunks that may be removed, ``(n, body, hash)``.

    ``n`` counts all chunks from 0; bodies are without blanks at their ends and the line end behind them.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    may_go = F.filter(chunks_of(body), lambda x: (x["several"] | (_words(x["body"]) >= LONG_WORDS)) & (F.trim(x["body"]) != ""))
    bare = F.transform(may_go, lambda x: let(F.trim(x["body"]), lambda b: F.struct(x["n"].alias("n"), b.alias("body"), F.xxhash64(b).alias("hash"))))
    return docs.select(F.col(key).alias("key"), F.xxhash64(body).alias("row"), bare.alias("parts"))


#: Between a line and the next one; the same where what follows holds more than blanks.
_BREAK, _UNIT = r"(?<=[.!?] |\n)", r"(?<=[.!?] |\n)(?![ \t\r]*(?:\n|\z))"
_BLANKS = " \t\r\n"


def _marked(text: Column) -> Column:
    """The text with a mark behind each line."""
    for stop in (". ", "! ", "? ", "\n"):
        text = F.replace(text, F.lit(stop), F.lit(stop + "\0"))
    return text


def _lines(text: Column) -> Column:
    """The lines of a text, each with the blank or line end behind it; some may hold blanks alone."""
    # marks and a plain split in place of a pattern, for texts without the mark
    return F.when(F.contains(text, F.lit("\0")), F.split(text, _BREAK)).otherwise(F.split(_marked(text), "\0"))


def _bare(lines: Column) -> Column:
    return F.transform(lines, lambda x: F.btrim(x, F.lit(_BLANKS)))


def bare_lines(text: Column) -> Column:
    """The lines of a text that hold more than blanks, without the blanks at their ends."""
    return F.array_remove(_bare(_lines(text)), "")


def units_of(text: Column) -> Column:
    """For each of ``bare_lines`` all up to the next one, the first from the start of the text; joined they are the text."""

    def whole(parts: Column) -> Column:
        blank = F.btrim(F.get(parts, F.lit(0)), F.lit(_BLANKS)) == ""
        joined = F.concat(F.array(F.concat(F.get(parts, F.lit(0)), F.get(parts, F.lit(1)))), F.slice(parts, F.lit(3), F.size(parts)))
        return F.when(~F.coalesce(blank, F.lit(False)), parts).when(F.size(parts) > 1, joined).otherwise(F.array().cast("array<string>"))

    def units(lines: Column) -> Column:
        rest = let(F.array_remove(F.split(text, _UNIT), ""), whole)
        return F.when(F.array_contains(_bare(lines), "") | F.contains(text, F.lit("\0")), rest).otherwise(lines)

    # empty lines go to the line before at once, which leaves few texts to the pattern
    return let(F.array_remove(F.split(F.replace(_marked(text), F.lit("\0\n"), F.lit("\n")), "\0"), ""), units)


def _hash(*values: Column) -> Column:
    return F.xxhash64(*values)


def windows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, row, n, hash`` of the windows of each text, whose hash is ``row`` (null: empty).

    Two neighbouring lines, of which line k is the first, have the number 2 k and a hash that rolls over the hashes of the
    lines; line k alone, if it has 50 words, has 2 k + 1 and the line's hash. The last line has 2 k and no hash.
    """

    def pairs(h: Column) -> Column:
        return F.transform(h, lambda x, k: F.struct((2 * k).alias("n"), F.when(k < F.size(h) - 1, _hash(x, F.get(h, k + 1))).alias("hash")))

    def found(lines: Column) -> Column:
        # 50 words have 99 bytes, but for blanks that follow one another
        long = lambda x: ((F.octet_length(x) >= 2 * LONG_WORDS - 1) | F.contains(x, F.lit("  "))) & (_words(x) >= LONG_WORDS)
        alone = F.transform(lines, lambda x, k: F.when(long(x), F.struct((2 * k + 1).alias("n"), _hash(x).alias("hash"))))
        return F.concat(let(F.transform(lines, lambda x: _hash(x)), pairs), F.filter(alone, lambda x: x.isNotNull()))

    body = F.coalesce(F.col(text), F.lit(""))
    # hashed below the generator: beside it a text would be hashed for each of its windows
    rows = docs.select(F.col(key).alias("key"), body.alias("body"), _hash(body).alias("row"))
    return rows.select("key", "row", F.inline(let(bare_lines(F.col("body")), found)))


def repeated_chunks(docs: DataFrame, key: str = "doc_id", text: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, DataFrame]:
    """Small rows of all chunks that may go, and the table of repeated ones.

    The first has ``key, row, n, hash, again`` without texts; ``row`` is the hash of the row's text. The second has
    ``hash, first`` for chunks that occur at least twice, ``first`` the smallest key that holds them. Hashes that occur
    twice are candidates; only their chunks move with their bytes, which are compared: where different bytes share a
    hash, which 64 bits make rare, it does not count as repeated. Copies combine before each exchange.
    """
    # in order of hashes a chunk that an earlier one of its row equals stands behind it
    order = F.array_sort(F.transform("parts", lambda x: F.struct(x["hash"].alias("hash"), x["n"].alias("n"))))
    slim = let(order, lambda o: F.transform(o, lambda x, i: F.struct(x["hash"].alias("hash"), x["n"].alias("n"), F.coalesce(F.get(o, i - 1)["hash"] == x["hash"], F.lit(False)).alias("again"))))
    marked = chunked(docs, key, text).select("key", "row", slim.alias("order"))
    small = checkpointed(marked.select("key", "row", F.inline("order")))
    often = checkpointed(small.groupBy("hash").agg(F.count(F.lit(1)).alias("many"), F.min("key").alias("first")).where("many > 1").select("hash", "first"))
    few = often.count() <= broadcast_rows
    bodies = chunked(docs, key, text).select(F.inline("parts")).select("hash", "body")
    met = bodies.join(F.broadcast(often.select("hash")) if few else often.select("hash"), "hash")
    texts = met.groupBy("hash", "body").agg(F.count(F.lit(1)).alias("many"))
    equal = texts.groupBy("hash").agg(F.count(F.lit(1)).alias("texts")).where("texts = 1").select("hash")
    return small, checkpointed(often.join(equal, "hash"))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``docs`` with cleaned ``text`` and ``__n_chunks``, ``__removed``: an array of ``(start, end)`` code points that went.

    Of a repeated chunk the first occurrence stays: all that its smallest key holds once, the others go. Documents
    without a key go by those that have one; where none has, all keep the chunk. Rows that repeat a key count as one
    document. Null texts stay null and hold nothing; empty tables give no rows; other columns stay as they are.
    Texts move once, to meet the numbers of the chunks that go.
    """
    return _cleaned(docs, key, text, *repeated_chunks(docs, key, text, **settings), chunks_of)


def _with(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """``left`` with the columns of ``right`` of equal ``key, row``; null keys are equal."""
    a, b = left.alias("a"), right.alias("b")
    met = a.join(b, (F.col("a.row") == F.col("b.row")) & F.col("a.key").eqNullSafe(F.col("b.key")), how)
    return met.select("a.*", *[F.col(f"b.{c}") for c in right.columns if c not in ("key", "row")])


def repeated_windows(table: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``key, row, wins`` of the texts that hold a repeated window of ``windows``: array of ``(hash, n, goes)``.

    A window goes if a smaller key holds it, or an earlier place of its own text.
    """
    often = table.where("hash IS NOT NULL").groupBy("hash").agg(F.count(F.lit(1)).alias("many"), F.min("key").alias("first")).where("many > 1")
    often = checkpointed(often.select("hash", "first"))
    met = table.join(F.broadcast(often) if often.count() <= broadcast_rows else often, "hash")
    found = met.groupBy("key", "row").agg(F.collect_set(F.struct("hash", "n", (~F.col("key").eqNullSafe(F.col("first"))).alias("later"))).alias("wins"))

    def judged(wins: Column) -> Column:
        again = lambda x, i: F.coalesce(F.get(wins, i - 1)["hash"] == x["hash"], F.lit(False))
        return F.transform(wins, lambda x, i: F.struct(x["hash"].alias("hash"), x["n"].alias("n"), (x["later"] | again(x, i)).alias("goes")))

    return checkpointed(found.select("key", "row", let(F.sort_array("wins"), judged).alias("wins")))


def _named(docs: DataFrame, key: str, text: str, other: DataFrame, how: str) -> DataFrame:
    """``docs`` as ``__text, __rest`` (its other columns), with the columns of ``other`` of equal ``key, row``."""
    names = [c for c in docs.columns if c != text]
    body = F.coalesce(F.col(text), F.lit(""))
    return _with(docs.select(F.col(key).alias("key"), F.col(text).alias("__text"), F.struct(*names).alias("__rest"), _hash(body).alias("row")), other, how)


def unequal(docs: DataFrame, repeated: DataFrame, sizes: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``whole, hash`` of windows, and of whole texts, whose hash stands for different bytes.

    Of texts with one hash the windows of that with the smallest key are compared, and all texts whole.
    """
    copies = sizes.groupBy("row").agg(F.min("key").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1").select("row", "head")
    marked = repeated.join(copies.withColumn("copied", F.lit(True)), "row", "left")
    marked = marked.select("key", "row", F.col("copied").isNotNull().alias("copied"), F.when(F.col("copied").isNull() | F.col("key").eqNullSafe(F.col("head")), F.col("wins")).alias("wins"))
    body, kind = F.coalesce(F.col("__text"), F.lit("")), "array<struct<whole:boolean,hash:bigint,body:string>>"

    def bodies(lines: Column) -> Column:
        pair = lambda k: F.concat(F.get(lines, k), F.lit("\n"), F.get(lines, k + 1))
        of = lambda n: F.when(n % 2 == 0, pair(F.shiftright(n, 1))).otherwise(F.get(lines, F.shiftright(n, 1)))
        return F.transform("wins", lambda x: F.struct(F.lit(False).alias("whole"), x["hash"].alias("hash"), of(x["n"]).alias("body")))

    windows = F.when(F.col("wins").isNull(), F.array().cast(kind)).otherwise(let(bare_lines(body), bodies))
    texts = F.when(F.col("copied"), F.array(F.struct(F.lit(True).alias("whole"), F.col("row").alias("hash"), body.alias("body")))).otherwise(F.array().cast(kind))
    found = _named(docs.select(key, text), key, text, marked, "inner").select(F.inline(F.concat(windows, texts)))
    return found.groupBy("whole", "hash", "body").agg(F.count(F.lit(1)).alias("n")).groupBy("whole", "hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("whole", "hash")


def remove_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """As ``remove_repeats``, for every run of two lines or more, or line of 50 words, that an earlier place holds.

    ``__n_chunks`` counts the lines that hold more than blanks. What a passage shares beyond whole lines stays. Of every
    line some occurrence stays: a line goes only for an equal one with a smaller key, or before it in its own text.
    Texts move twice, one exchange after the other: to compare bytes, and to meet the numbers of the lines that go.
    """
    table = checkpointed(windows(docs, key, text))
    sizes = checkpointed(table.where("hash IS NULL").groupBy("key", "row").agg((F.max("n") / 2 + 1).cast("int").alias("__n")))
    repeated = repeated_windows(table, broadcast_rows)
    del table
    free_shuffles(docs.sparkSession)
    wrong = checkpointed(unequal(docs, repeated, sizes, key, text))
    free_shuffles(docs.sparkSession)
    if not wrong.isEmpty():
        # equal hashes of different bytes: those windows, and all of those texts, stay
        flat = repeated.select("key", "row", F.inline("wins")).join(wrong.where("NOT whole").select("hash"), "hash", "left_anti")
        flat = flat.join(wrong.where("whole").select(F.col("hash").alias("row")), "row", "left_anti")
        repeated = flat.groupBy("key", "row").agg(F.collect_list(F.struct("n", "goes")).alias("wins"))
    lines = F.flatten(F.transform(F.filter("wins", lambda x: x["goes"]), lambda x: F.when(
        x["n"] % 2 == 0, F.array(F.shiftright(x["n"], 1), F.shiftright(x["n"], 1) + 1)).otherwise(F.array(F.shiftright(x["n"], 1)))))
    gone = repeated.select("key", "row", F.sort_array(F.array_distinct(lines)).alias("__gone")).where(F.size("__gone") > 0)
    met = _named(docs, key, text, checkpointed(_with(sizes, gone, "left")), "left")
    body = F.coalesce(F.col("__text"), F.lit(""))

    def cleaned(units: Column) -> Column:
        n, empty = F.size(units), F.array().cast(SPANS)

        def step(acc, i):
            # gone numbers are in order, so that one look tells whether this line is among them
            end, goes = acc["at"] + F.length(F.get(units, i)), F.coalesce(F.get(F.col("__gone"), acc["next"]) == i, F.lit(False))
            return F.struct(end.alias("at"), (acc["next"] + goes.cast("int")).alias("next"), F.when(
                goes, F.array_append(acc["out"], F.struct(acc["at"].alias("start"), end.alias("end")))).otherwise(acc["out"]).alias("out"))

        def block(acc, k):
            # appending copies an array, so that long lists are made in blocks
            inner = F.aggregate(F.sequence(k * BLOCK, F.least(k * BLOCK + BLOCK, n) - 1), F.struct(acc["at"].alias("at"), acc["next"].alias("next"), empty.alias("out")), step)
            return let(inner, lambda x: F.struct(x["at"].alias("at"), x["next"].alias("next"), F.array_append(acc["out"], x["out"]).alias("out")))

        zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("next"), F.array().cast(f"array<{SPANS}>").alias("out"))
        spans = F.flatten(F.aggregate(F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")), zero, block)["out"])
        stays = F.array_except(F.sequence(F.lit(0), n - 1), F.col("__gone"))
        return F.struct(F.array_join(F.transform(stays, lambda i: F.get(units, i)), "").alias("kept"), n.alias("n"), spans.alias("spans"))

    same = F.struct(F.lit(None).cast("string").alias("kept"), F.coalesce("__n", F.lit(0)).alias("n"), F.array().cast(SPANS).alias("spans"))
    done = F.when(F.col("__gone").isNotNull(), let(units_of(body), cleaned)).otherwise(same)
    found = met.select("__rest", "__text", F.explode(F.array(done)).alias("__done"))
    clean = F.coalesce("__done.kept", "__text")
    return found.select(*[(clean if c == text else F.col("__rest")[c]).alias(c) for c in docs.columns], F.col("__done.n").alias("__n_chunks"), F.col("__done.spans").alias("__removed"))


def _cleaned(docs: DataFrame, key: str, text: str, small: DataFrame, repeated: DataFrame, cut) -> DataFrame:
    """``docs`` without the parts, of those that ``cut`` gives, whose numbers go."""
    goes = small.join(repeated, "hash").where(F.col("again") | ~F.col("key").eqNullSafe(F.col("first")))
    gone = checkpointed(goes.groupBy("key", "row").agg(F.array_sort(F.collect_set("n")).alias("__gone")).select(F.col("key").alias("__key"), F.col("row").alias("__row"), "__gone"))
    own = docs.withColumn("__own", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    met = own.join(gone, (F.col("__own") == F.col("__row")) & F.col(key).eqNullSafe(F.col("__key")), "left")
    names = [c for c in docs.columns if c != text]
    carried = met.select(F.col(key).alias("__id"), F.col(text).alias("__text"), F.coalesce("__gone", F.array().cast("array<int>")).alias("__gone"), F.struct(*names).alias("__rest"))
    none = F.array().cast("array<struct<start:int,end:int>>")

    def cleaned(parts: Column, gone: Column) -> Column:
        def step(acc, x):
            # gone numbers are in order, so that one look tells whether this chunk is among them
            end, goes = acc["at"] + F.length(x["body"]) + F.length(x["end"]), F.coalesce(F.get(gone, acc["next"]) == x["n"], F.lit(False))
            return F.struct(end.alias("at"), (acc["next"] + goes.cast("int")).alias("next"), F.when(
                goes, F.array_append(acc["spans"], F.struct(acc["at"].alias("start"), end.alias("end")))).otherwise(acc["spans"]).alias("spans"))

        zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("next"), none.alias("spans"))
        stays = F.array_except(F.transform(parts, lambda x: x["n"]), gone)
        kept = F.array_join(F.transform(stays, lambda i: let(F.get(parts, i), lambda x: F.concat(x["body"], x["end"]))), "")
        some = F.size(gone) > 0
        return F.struct(F.when(some, kept).alias("kept"), F.size(parts).alias("n"), F.when(some, F.aggregate(parts, zero, step)["spans"]).otherwise(none).alias("spans"))

    done = let(F.col("__gone"), lambda gone: let(cut(F.coalesce(F.col("__text"), F.lit(""))), lambda parts: cleaned(parts, gone)))
    found = carried.select("__rest", "__text", F.array(done).alias("__done")).select("__rest", "__text", F.explode("__done").alias("__done"))
    out = found.select("__rest", F.coalesce("__done.kept", "__text").alias("__clean"), F.col("__done.n").alias("__n_chunks"), F.col("__done.spans").alias("__removed"))
    return out.select(*[(F.col("__clean") if c == text else F.col("__rest")[c]).alias(c) for c in docs.columns], "__n_chunks", "__removed")


def digest(cleaned: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_chunks, n_removed, removed_chars, removed, clean_sha256`` of ``remove_repeats``."""
    spans = F.col("__removed")
    return cleaned.select(
        key, F.col("__n_chunks").cast("long").alias("n_chunks"), F.size(spans).cast("long").alias("n_removed"),
        F.aggregate(spans, F.lit(0), lambda s, x: s + x["end"] - x["start"]).cast("long").alias("removed_chars"),
        F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["start"], x["end"])), ",").alias("removed"),
        F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("clean_sha256"))
