"""Line dedup over content-defined chunks of lines.

A hash rolls over the hashes of neighbouring lines and chooses where a segment of lines ends, so the segments of a shared passage come out alike wherever
it stands in a text. A chunk is two neighbouring segments, hence at least two lines, and chunks overlap by a segment: a passage loses no more than the
partial segments at its two ends. Chunks that occur before, in the whole corpus, are removed, after their bytes have been compared with those of
the first occurrence. Native expressions only.

With ``divisor`` 1 the hash lets a segment end behind every line. Any coarser rule misses passages: whether a passage of two lines has a boundary at
its start depends on the line before it, so only chunks of every two neighbouring lines find all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brevita.llm.common import let
from brevita.session import pin

# A segment ends behind one line in so many on average.
DIVISOR = 1
# Chunks of more than one row in so many, and of up to so many bytes, are joined without a shuffle of their rows.
HOT_CHUNKS = 1000
HOT_BYTES = 1 << 16


def segments(text: Column, divisor: int = DIVISOR) -> Column:
    """The text's segments as an array of strings with their lines joined by a line feed; null has none.

    A segment ends behind a line if the hash over the hashes of this line and the one before is divisible by ``divisor``, and at the end.
    """

    if divisor == 1:  # every hash is divisible
        return F.split(text, "\n", -1)

    def ends(lines: Column) -> Column:
        # The hash before the first line is that of no line.
        hashed = F.transform(lines, lambda x: F.xxhash64(x))

        def of(h: Column) -> Column:
            last = F.size(h)
            rolled = F.transform(
                h, lambda x, i: F.pmod(F.xxhash64(F.when(i > 0, F.get(h, i - 1)), x), F.lit(divisor)) == 0
            )
            cut = F.transform(rolled, lambda x, i: F.when(x | (i + 1 == last), i + 1))
            return F.filter(cut, lambda x: x.isNotNull())

        return let(hashed, of)

    def joined(lines: Column) -> Column:
        def of(stops: Column) -> Column:
            def piece(stop: Column, i: Column) -> Column:
                start = F.when(i > 0, F.get(stops, i - 1)).otherwise(F.lit(0))
                return F.array_join(F.slice(lines, start + 1, stop - start), "\n")

            return F.transform(stops, piece)

        return let(ends(lines), of)

    return let(F.split(text, "\n", -1), joined)


def line_count(chunk: Column) -> Column:
    return F.length(chunk) - F.length(F.replace(chunk, F.lit("\n"), F.lit(""))) + 1


def _keys(ident: Column, text: Column) -> list[Column]:
    """The id, and a hash that tells texts without an id, or with the same one, apart."""
    return [ident.alias("k1"), F.xxhash64(text).alias("k2")]


def _same(left: str, right: str) -> Column:
    return F.col(f"{left}1").eqNullSafe(F.col(f"{right}1")) & F.col(f"{left}2").eqNullSafe(F.col(f"{right}2"))


def _chunks(text: Column, divisor: int) -> Column:
    """(at, hash, bytes) of each two neighbouring segments that are not both white space; null and single segments have none."""

    def of(lines: Column) -> Column:
        def pair(x: Column, i: Column) -> Column:
            y = F.get(lines, i + 1)
            size = F.octet_length(x) + F.octet_length(y) + 1
            return F.when(
                F.concat(x, y).rlike(r"\S"), F.struct(i.alias("at"), F.xxhash64(x, y).alias("hash"), size.alias("bytes"))
            )

        return F.filter(F.transform(F.slice(lines, 1, F.size(lines) - 1), pair), lambda x: x.isNotNull())

    return let(segments(text, divisor), of)


def _chunk_at(lines: Column, at: Column) -> Column:
    return F.concat(F.get(lines, at), F.lit("\n"), F.get(lines, at + 1))


def _met(many: DataFrame, few: DataFrame, hot: DataFrame) -> DataFrame:
    """``many`` joined with ``few``, which has one row for a chunk. Rows of hot chunks stay where they are; the others meet by a shuffle."""
    chunk = ["hash", "bytes"]
    there = many.join(F.broadcast(few.join(F.broadcast(hot), chunk, "left_semi")), chunk)
    return there.unionByName(many.join(F.broadcast(hot), chunk, "left_anti").join(few, chunk))


def remove_repeated_chunks(docs: DataFrame, divisor: int = DIVISOR) -> DataFrame:
    """``docs`` with ``text`` cut by every chunk that occurs earlier, and two more columns: ``_n_lines`` of the input and ``_n_removed``, the lines cut.

    A segment goes if it and a neighbour also stand next to each other, in this order, at an earlier place: an earlier document or an earlier line of
    this one. All places are judged on the input. With ``divisor`` 1 each run of two or more lines that an earlier document holds goes whole, and a
    copy of several lines becomes empty; a larger one cuts fewer, longer chunks. Where a segment follows itself, a repeat does not cut the segments of its
    own first occurrence. Single lines, and passages of white space, stay.

    Reads ``doc_id`` and ``text``; all other columns pass, whatever their names. Lines end at a line feed. The first occurrence, by doc_id, then a hash of the
    text, then place, stays; a null doc_id comes last. So rows of one id with different texts are documents of their own, and rows equal in id and text are
    one document that keeps what it has. A null text stays null with 0 lines, an empty one is one empty line. A text that is nothing but repeats becomes
    empty. A very long text is one value of its task. An empty table gives an empty result.

    Hashes find the candidates; a chunk goes only if its bytes equal those of the first occurrence.
    """
    keyed = docs.select(*_keys(F.col("doc_id"), F.col("text")), "text")
    # Narrow: where each chunk stands. Only chunks whose hash repeats are ordered.
    places = pin(keyed.select("k1", "k2", F.explode(_chunks(F.col("text"), divisor)).alias("p")).select("k1", "k2", "p.*"))
    twice = pin(places.groupBy("hash", "bytes").agg(F.count("*").alias("n")).filter("n > 1"))
    # Fewer than HOT_CHUNKS keys can have that share of the rows each, so what is broadcast is bounded, with their bytes, too.
    share = F.col("n") * HOT_CHUNKS > F.lit(places.count())
    hot = pin(twice.filter(share & (F.col("bytes") <= HOT_BYTES)).select("hash", "bytes"))
    held = pin(_met(places, twice.select("hash", "bytes"), hot))
    place = F.struct(F.col("k1").isNull().alias("no"), "k1", "k2", "at")
    first = (
        held.groupBy("hash", "bytes")
        .agg(F.min(place).alias("first"))
        .select("hash", "bytes", F.col("first.k1").alias("f1"), F.col("first.k2").alias("f2"), F.col("first.at").alias("f_at"))
    )
    first = pin(first)
    others = (
        _met(held, first, hot)
        .filter(~(_same("k", "f") & (F.col("at") == F.col("f_at"))))
        .select("hash", "bytes", "k1", "k2", "at", (_same("k", "f") & (F.col("at") == F.col("f_at") + 1)).alias("overlaps"))
        .distinct()
    )
    # Texts meet their narrow side by a sort on both keys at every size.
    wanted = first.groupBy("f1", "f2").agg(F.collect_list(F.struct("f_at", "hash", "bytes")).alias("wanted"))

    def pick(lines: Column) -> Column:
        return F.transform(
            F.col("wanted"),
            lambda w: F.struct(w["hash"].alias("hash"), w["bytes"].alias("bytes"), _chunk_at(lines, w["f_at"]).alias("chunk")),
        )

    sources = (
        keyed.join(wanted.hint("merge"), _same("k", "f"))
        .select(F.explode(let(segments(F.col("text"), divisor), pick)).alias("p"))
        .select("p.*")
        .groupBy("hash", "bytes")
        .agg(F.first("chunk").alias("chunk"))
    )
    gone = (
        _met(pin(others), pin(sources), hot)
        .groupBy(F.col("k1").alias("g1"), F.col("k2").alias("g2"))
        .agg(F.collect_list(F.struct("at", "overlaps", "chunk")).alias("_gone"))
    )
    names = docs.columns
    rows = docs.select(F.struct(*names).alias("_row"), *_keys(F.col("doc_id"), F.col("text")))
    matched = rows.join(pin(gone).hint("merge"), _same("k", "g"), "left")

    def left_over(lines: Column) -> Column:
        equal = F.filter("_gone", lambda g: _chunk_at(lines, g["at"]) == g["chunk"])
        cut = F.flatten(
            F.transform(equal, lambda g: F.when(g["overlaps"], F.array(g["at"] + 1)).otherwise(F.array(g["at"], g["at"] + 1)))
        )
        return F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), cut), lambda i: F.get(lines, i))

    lines = F.coalesce(line_count(F.col("_row.text")), F.lit(0)).cast("bigint")
    left = F.aggregate("_left", F.lit(0).cast("bigint"), lambda n, x: n + line_count(x))
    uncut = F.col("_left").isNull()
    return matched.withColumn("_left", F.when(F.col("_gone").isNotNull(), let(segments(F.col("_row.text"), divisor), left_over))).select(
        *[
            (F.when(uncut, F.col("_row.text")).otherwise(F.array_join("_left", "\n")) if c == "text" else F.col(f"_row.`{c}`")).alias(c)
            for c in names
        ],
        lines.alias("_n_lines"),
        F.when(uncut, F.lit(0)).otherwise(lines - left).cast("bigint").alias("_n_removed"),
    )
