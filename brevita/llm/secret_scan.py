"""Scan for secrets: three fixed patterns, and character Markov models for strings that only look random.

Two first-order Markov models over characters are trained, one on random strings, one on ordinary words and identifiers. Each
transition of a run of key characters gains its log-likelihood ratio, less a drift; transitions at ``/ _ -``, which join keys and names
alike, gain nothing. A stretch of the run is a suspect if its sum exceeds a bound, so a key is found whatever path or identifier it is joined to. Drift and
bound come from labelled strings that the models were not trained on. All of it runs in Spark's own expressions: runs are found by regular expressions, positions are running sums of
piece lengths, and stretches come from one fold over the run, linear in its length.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brevita.llm.common import let, uniform
from brevita.session import pin

# The patterns of the base kinds, in the order in which equal starts are listed.
ASSIGN = (
    r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|"
    r"[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "markov")

# A run of key characters long enough to be scored.
CANDIDATE = r"[A-Za-z0-9+/_-]{16,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-"
JOINERS = "/_-"
BETWEEN_JOINERS = "[A-Za-z0-9+]*"
# Aim for ordinary runs taken for secrets; share of the held-out ordinary strings that may lie above the bound; one in so many is held out.
FALSE_RATE = 1e-6
SAMPLE_RATE = 0.001
HELD_OUT = 4
# Digests for each document of the sample.
DRAWS = 8
FOLD_BLOCK = 256


class Model(NamedTuple):
    """``gains`` of each transition within ``ALPHABET``, row by row, and the ``bound`` above which the sum of a stretch makes a suspect."""

    gains: list[float]
    bound: float


_FOUND = "array<struct<start:int,end:int,match:string>>"


def _empty(kind: str) -> Column:
    return F.array().cast(kind)


def located(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as an array of (start, end, match), in code points, end exclusive.

    A start is the sum of what lies before it. The sum runs in blocks, and then over blocks, so that a text
    with very many matches costs no quadratic copying of the growing array.
    """
    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(pieces.alias("gap"), found.alias("match"))

    def in_block(block: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), _empty(_FOUND).alias("items"))

        def step(held: Column, x: Column) -> Column:
            begin = held["at"] + F.length(x["gap"])
            end = begin + F.length(x["match"])
            item = F.struct(begin.alias("start"), end.alias("end"), x["match"].alias("match"))
            return F.struct(end.alias("at"), F.array_append(held["items"], item).alias("items"))

        return F.aggregate(block, start, step)

    def over_blocks(blocks: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), _empty(f"array<{_FOUND}>").alias("parts"))

        def shifted(items: Column, by: Column) -> Column:
            return F.transform(
                items,
                lambda x: F.struct(
                    (x["start"] + by).alias("start"), (x["end"] + by).alias("end"), x["match"].alias("match")
                ),
            )

        def step(held: Column, x: Column) -> Column:
            return F.struct(
                (held["at"] + x["at"]).alias("at"),
                F.array_append(held["parts"], shifted(x["items"], held["at"])).alias("parts"),
            )

        return F.flatten(F.aggregate(blocks, start, step)["parts"])

    def of_pairs(p: Column) -> Column:
        # The last piece has no match behind it.
        matches = F.size(p) - 1
        firsts = F.sequence(F.lit(1), matches, F.lit(FOLD_BLOCK))
        blocks = F.transform(
            firsts, lambda i: in_block(F.slice(p, i, F.least(F.lit(FOLD_BLOCK), matches - i + 1)))
        )
        return F.when(matches > 0, over_blocks(blocks)).otherwise(_empty(_FOUND))

    return F.when(text.rlike(pattern), let(pairs, of_pairs)).otherwise(_empty(_FOUND))


def labelled_strings(docs: DataFrame, rows: int = 4000, seed: int = 5) -> DataFrame:
    """Labelled samples (text, random) from about ``rows`` documents, chosen by a hash of their id.

    Ordinary: the distinct ASCII words of the texts outside base spans, also in capitals, and three neighbours joined as an identifier. Random:
    digests of the ids, written in the alphabets that keys use.
    """
    total = docs.count()
    picked = docs.filter(uniform(F.col("doc_id"), F.lit(seed)) < min(1.0, rows / max(1, total)))
    plain = F.coalesce("text", F.lit(""))
    for pattern in (ASSIGN, ACCESS, HEX):
        plain = F.regexp_replace(plain, pattern, " ")
    words = F.regexp_extract_all(plain, F.lit(r"[A-Za-z_][A-Za-z0-9_]{2,}"), F.lit(0))
    snake = lambda w: F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(w)), F.lit(3)), lambda i: F.array_join(F.slice(w, i, 3), "_")
    )
    ordinary = picked.select(F.explode(let(F.array_distinct(words), lambda w: F.concat(w, snake(w)))).alias("text"))
    ordinary = ordinary.distinct()
    ordinary = ordinary.select(F.explode(F.array("text", F.upper("text"))).alias("text"), F.lit(False).alias("random"))
    draw = F.explode(F.sequence(F.lit(1), F.lit(DRAWS))).alias("draw")
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), "draw", F.col("doc_id").cast("string")), 256)
    long = F.base64(F.unhex(digest))
    forms = F.array(
        F.rtrim(long, F.lit("=")), F.translate(long, "+/=", "-_"), F.upper(F.regexp_replace(long, "[^A-Za-z0-9]", "")), digest
    )
    digests = picked.select("doc_id", draw).select(F.explode(forms).alias("text"), F.lit(True).alias("random"))
    return ordinary.unionByName(digests)


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio, random against ordinary, of each transition within ``ALPHABET``, row by row.

    ``samples`` has ``text`` and ``random``. Null texts and characters outside the alphabet count for nothing. Transitions are counted in
    Spark over all samples; at most twice the squared alphabet comes back. Add-one smoothing, so an empty table gives zeros.
    """
    width = len(ALPHABET)
    steps = F.transform(
        F.sequence(F.lit(1), F.length("text") - 1),
        lambda i: _class(F.col("text"), i) * width + _class(F.col("text"), i + 1),
    )
    counted = (
        samples.filter(F.length("text") > 1)
        .select("random", F.explode(steps).alias("step"))
        .filter("step is not null")
        .groupBy("random", "step")
        .agg(F.count("*").alias("n"))
        .collect()
    )
    counts = {kind: [[1] * width for _ in range(width)] for kind in (True, False)}
    for kind, step, n in counted:
        counts[kind][step // width][step % width] += n

    def log_rate(kind: bool, a: int, b: int) -> float:
        return math.log(counts[kind][a][b] / sum(counts[kind][a]))

    return [
        round(log_rate(True, a, b) - log_rate(False, a, b), 6) for a in range(width) for b in range(width)
    ]


def _class(text: Column, at: Column) -> Column:
    """Place of a character in the alphabet, from 0; null outside it."""
    place = F.instr(F.lit(ALPHABET), F.substring(text, at, F.lit(1)))
    return F.when(place > 0, place - 1)


def _literals(values: list) -> Column:
    # One string split once: a literal array after constant folding.
    return F.split(F.lit(",".join(map(str, values))), ",")


def evidence(run: Column, gains: list[float]) -> Column:
    """Gains of the transitions of a run within the alphabet, as an array."""
    places = _literals([max(0, ALPHABET.find(chr(c))) for c in range(128)]).cast("array<int>")
    table = _literals(gains).cast("array<double>")
    # A split, since taking characters of a very long run by their position would be quadratic.
    classes = F.transform(F.split(run, "", -1), lambda c: F.element_at(places, F.ascii(c) + 1))
    return let(
        F.slice(classes, 1, F.length(run)),
        lambda k: F.transform(
            F.sequence(F.lit(2), F.size(k)),
            lambda i: F.element_at(table, F.element_at(k, i - 1) * len(ALPHABET) + F.element_at(k, i) + 1),
        ),
    )


def stretches(gains: Column, bound: float) -> Column:
    """Parts of an array whose sums exceed ``bound``, as (first, last), from 0.

    A part begins where the running sum rises from nothing, ends where that sum is greatest, and the next one begins once the sum has
    fallen back to nothing. One pass.
    """
    found = "array<struct<first:int,last:int>>"
    start = F.struct(
        F.lit(0).alias("at"), F.lit(0).alias("first"), F.lit(0).alias("last"), F.lit(0.0).alias("sum"),
        F.lit(0.0).alias("best"), _empty(found).alias("found"),
    )

    def noted(held: Column) -> Column:
        part = F.struct(held["first"].alias("first"), held["last"].alias("last"))
        return F.when(held["best"] > bound, F.array_append(held["found"], part)).otherwise(held["found"])

    def step(held: Column, gain: Column) -> Column:
        total = held["sum"] + gain
        over = total <= 0
        better = total > held["best"]
        return F.struct(
            (held["at"] + 1).alias("at"),
            F.when(over, held["at"] + 1).otherwise(held["first"]).alias("first"),
            F.when(better, held["at"]).otherwise(held["last"]).alias("last"),
            F.greatest(total, F.lit(0.0)).alias("sum"),
            F.when(over, F.lit(0.0)).when(better, total).otherwise(held["best"]).alias("best"),
            F.when(over, noted(held)).otherwise(held["found"]).alias("found"),
        )

    return F.aggregate(gains, start, step, noted)


def highest(gains: Column) -> Column:
    """The greatest sum of any part of an array, at least 0."""
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))

    def step(held: Column, gain: Column) -> Column:
        total = F.greatest(held["sum"] + gain, F.lit(0.0))
        return F.struct(total.alias("sum"), F.greatest(held["best"], total).alias("best"))

    return F.aggregate(gains, start, step, lambda held: held["best"])


def fit(samples: DataFrame, false_rate: float = FALSE_RATE, sample_rate: float = SAMPLE_RATE) -> Model:
    """Both models, and a drift and a bound from labelled strings that they were not trained on, one in ``HELD_OUT`` by hash.

    The drift is half of the mean ratio in random strings. A sum of log-likelihood ratios exceeds x by chance with a probability near exp(-x), so the
    bound is at least ``-log(false_rate)``; it is higher if more than ``sample_rate`` of the ordinary strings would exceed that. Without random
    strings to hold out nothing is ever above the bound.
    """
    labelled = pin(samples.filter("text is not null").withColumn("part", F.pmod(F.xxhash64("text"), F.lit(HELD_OUT))))
    width = len(ALPHABET)
    inner = [not {ALPHABET[i // width], ALPHABET[i % width]} & set(JOINERS) for i in range(width * width)]
    ratios = [r if counts else 0.0 for r, counts in zip(train(labelled.filter("part > 0")), inner)]
    # Strings of any length count, up to their first character outside the alphabet.
    run = F.regexp_extract("text", "^[A-Za-z0-9+/_-]{2,}", 0)
    held = labelled.filter("part = 0").select("random", run.alias("run")).filter("run != ''")
    steps = held.filter("random").select(F.explode(evidence(F.col("run"), ratios)).alias("ratio"))
    mean = steps.agg(F.avg("ratio")).first()[0]
    drift = max(0.0, (mean or 0.0) / 2)
    gains = [round(r - drift, 6) if counts else 0.0 for r, counts in zip(ratios, inner)]
    sums = held.filter("not random").select(highest(evidence(F.col("run"), gains)).alias("sum"))
    sampled = sums.agg(F.percentile("sum", F.lit(1 - sample_rate))).first()[0] or 0.0
    return Model(gains, math.inf if mean is None else max(sampled, -math.log(false_rate)))


def suspects(runs: Column, model: Model) -> Column:
    """Suspect stretches of located runs, as (start, end), each widened to the joiners or the ends of its run around it."""

    def of_run(run: Column) -> Column:
        found = stretches(evidence(run["match"], model.gains), model.bound)

        def widened(part: Column) -> Column:
            before = F.length(F.regexp_extract(F.substring(run["match"], F.lit(1), part["first"]), BETWEEN_JOINERS + "$", 0))
            behind = F.length(F.regexp_extract(F.substring(run["match"], part["last"] + 3, F.length(run["match"])), "^" + BETWEEN_JOINERS, 0))
            return F.struct(
                (run["start"] + part["first"] - before).alias("start"), (run["start"] + part["last"] + 2 + behind).alias("end")
            )

        return F.array_distinct(F.transform(found, widened))

    return F.flatten(F.transform(runs, of_run))


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """Spans of each document, one row per input row: doc_id, base and all, arrays of (start, rank, end), rank as in ``KINDS``.

    Reads ``doc_id`` and ``text``; other columns are ignored. Positions are code points, end exclusive; a null text counts as empty. Base spans are the
    leftmost non-overlapping matches of each kind: an assignment with a value of 8 or more characters, an access key of 16 or more, a
    hexadecimal run of 32 or more. ``all`` adds the stretches of runs of key characters whose evidence exceeds the model's bound and that lie in no base
    span. A stretch reaches to the joiners around it, and may take in a neighbouring word whose end looks random; a run of few characters in rare order
    (``abababab``) is a suspect like a random one. Repeated rows, null ids and very long texts are rows like any other; an empty table gives an empty result.
    """
    text = F.coalesce("text", F.lit(""))
    found = docs.select(
        "doc_id",
        F.filter(located(text, ASSIGN), lambda x: F.length(F.regexp_extract(x["match"], ASSIGN, 2)) >= 8).alias("assign"),
        located(text, ACCESS).alias("access"),
        located(text, HEX).alias("hex"),
        suspects(located(text, CANDIDATE), model).alias("markov"),
    )

    def spans(kind: str) -> Column:
        rank = F.lit(KINDS.index(kind)).alias("rank")
        return F.transform(F.col(kind), lambda x: F.struct(x["start"].alias("start"), rank, x["end"].alias("end")))

    based = found.select("doc_id", F.sort_array(F.concat(*map(spans, KINDS[:3]))).alias("base"), spans("markov").alias("added"))
    free = lambda x: ~F.exists("base", lambda b: (b["start"] <= x["start"]) & (b["end"] >= x["end"]))
    return based.select("doc_id", "base", F.sort_array(F.concat("base", F.filter("added", free))).alias("all"))


def written(spans: Column) -> Column:
    """``kind:start:end``, comma-joined, in the order of the array."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["rank"] + 1), x["start"], x["end"])), ","
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["rank"] == KINDS.index(kind))).cast("bigint")
