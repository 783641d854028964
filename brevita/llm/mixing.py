"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is to be taken ``target / size of the source`` times on average. The whole part of that rate is
certain; the fractional parts are rounded jointly. Two documents with fractions meet: a random one gains what the other
loses, counted in words, until one of them is whole. The other one goes on to the next meeting. So the words taken from a source
never move away from its target until a single document with a fraction is left.

Meetings run in a tree: leaves hold some dozens of documents each, the document left over in a leaf goes up to a node over
some dozens of leaves, and so on to one root per source. Only native expressions are used, on rows of a few numbers; texts are read once
and never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brevita.llm.common import WORD, ranked, uniform
from brevita.session import pin

FANOUT = 64
COPY_BLOCK = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _level(sources: DataFrame, share: float, cap: float) -> float:
    """Words per unit of weight, after sources at their cap have handed their excess to the others.

    Each round is one aggregate that returns two numbers. A round fills at least one more source, usually many.
    """
    full = F.col("source_size") * F.lit(cap)
    total, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    if not total:
        return 0.0
    goal, level, known = share * total, share * total / weight, None
    while True:
        above = full <= F.col("weight") * F.lit(level)
        capped, free = sources.agg(
            F.coalesce(F.sum(F.when(above, F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)),
        ).first()
        if (capped, free) == known or not free:
            return level
        known, level = (capped, free), (goal - cap * capped) / free


def source_targets(groups: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """One row per source: its number ``src`` in code point order (null last), size, target, members with words."""
    sized = groups.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count_if(F.col("size") > 0).alias("members")
    )
    numbered = ranked(sized, F.col("source").isNull(), F.col("source"), name="src")
    pick = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("src") % len(weights) + 1).cast("int"))
    weighed = pin(numbered.withColumn("weight", pick))
    level = _level(weighed, share, cap)
    target = F.least(F.col("source_size") * F.lit(cap), F.col("weight") * F.lit(level))
    return weighed.select("source", "src", "source_size", "members", target.cast("double").alias("target"))


def _meet(held: Column, came: Column) -> Column:
    """State after ``came`` has met ``held``: one of them is decided and noted in ``won``, the other is held."""
    ratio = came["w"] / held["w"]
    up = F.least(1 - held["f"], came["f"] * ratio)
    down = F.least(held["f"], (1 - came["f"]) * ratio)
    raised = came["u"] * (up + down) < down
    done = F.when(raised, up >= 1 - held["f"]).otherwise(down >= held["f"])
    f_held = F.when(raised, held["f"] + up).otherwise(held["f"] - down)
    f_came = F.when(raised, came["f"] - up / ratio).otherwise(came["f"] + down / ratio)
    inside = lambda f: F.least(F.greatest(f, F.lit(0.0)), F.lit(1.0))
    note = lambda pos, hit: F.array_append(held["won"], F.struct(pos.alias("pos"), hit.alias("hit")))

    def state(one: Column, f: Column, won: Column) -> Column:
        return F.struct(one["pos"].alias("pos"), one["w"].alias("w"), inside(f).alias("f"), won.alias("won"))

    return F.when(done, state(came, f_came, note(held["pos"], raised))).otherwise(
        state(held, f_held, note(came["pos"], ~raised))
    )


def rounded(items: Column) -> Column:
    """Fold of an array of (w, f, u): struct of ``won``, the decided (pos, hit), and the one left over: pos, w, f."""
    numbered = F.transform(
        items,
        lambda x, i: F.struct(
            i.alias("pos"), x["w"].cast("double").alias("w"), x["f"].alias("f"), x["u"].alias("u")
        ),
    )
    start = F.struct(
        F.lit(-1).alias("pos"),
        F.lit(0.0).alias("w"),
        F.lit(0.0).alias("f"),
        F.array().cast("array<struct<pos:int,hit:boolean>>").alias("won"),
    )
    first = lambda x, held: F.struct(
        x["pos"].alias("pos"), x["w"].alias("w"), x["f"].alias("f"), held["won"].alias("won")
    )
    return F.aggregate(numbered, start, lambda held, x: F.when(held["pos"] < 0, first(x, held)).otherwise(_meet(held, x)))


def _fates(leaves: DataFrame, widest: int, fanout: int, seed: int) -> DataFrame:
    """(src, leaf, hit): what becomes of each leaf's left-over document, from the levels above the leaves."""
    up = leaves.select("src", "leaf", F.col("leaf").alias("node"), F.col("folded.w").alias("w"), F.col("folded.f").alias("f"))
    decided, depth = [], 0
    while widest > 1:
        depth += 1
        widest = -(-widest // fanout)
        drawn = uniform(F.col("src"), F.col("leaf"), F.lit(seed), F.lit(depth))
        nodes = (
            up.withColumn("node", F.floor(F.col("node") / fanout))
            .groupBy("src", "node")
            .agg(F.sort_array(F.collect_list(F.struct("leaf", "w", "f", drawn.alias("u")))).alias("items"))
            .withColumn("folded", rounded(F.col("items")))
        )
        nodes = pin(nodes)
        leaf_at = lambda pos: F.element_at("items", pos + 1)["leaf"]
        won = nodes.select("src", "items", F.explode("folded.won").alias("w"))
        decided.append(won.select("src", leaf_at(F.col("w.pos")).alias("leaf"), F.col("w.hit").alias("hit")))
        up = nodes.select(
            "src", leaf_at(F.col("folded.pos")).alias("leaf"), "node", F.col("folded.w").alias("w"), F.col("folded.f").alias("f")
        )
    last = uniform(F.col("src"), F.col("leaf"), F.lit(seed), F.lit(-1)) < F.col("f")
    fates = up.select("src", "leaf", last.alias("hit"))
    for part in decided:
        fates = fates.unionByName(part)
    return fates


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    fanout: int = FANOUT,
    seed: int = 17,
) -> DataFrame:
    """How many copies of each document the mix takes. Reads ``doc_id``, ``text`` and ``source``; other columns are ignored.

    The mix holds ``share`` times all words. Sources in code point order, null last, weigh ``weights``, repeating. A target stops
    at ``cap`` times its source's size and the excess goes to the others by weight. Returns one row per input row: doc_id, source,
    size (words, null text: 0), source_size, target, copies, taken (copies times size). The words taken from a source differ
    from its target by less than the size of one of its documents.

    A null ``doc_id`` or ``source`` is a value of its own. Rows without words take ``floor(rate)`` copies of nothing. Rows with equal id,
    source and size share their group's copies evenly, so that a repeated row, however frequent, is one row until the end. All draws
    depend on ids, sizes and ``seed`` only: reruns agree whatever the partitioning. A very long text is a row with a large size. An empty table gives an empty result.
    """
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    groups = pin(sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n")))
    sources = pin(source_targets(groups, weights, share, cap))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    over = F.col("n") * (F.col("rate") - F.col("base"))
    renamed = sources.withColumnRenamed("source", "_source")
    items = (
        groups.join(renamed, F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source")
        .withColumn("rate", rate)
        .withColumn("base", F.floor("rate"))
        .withColumn("sure", F.floor(over))
        .withColumn("f", over - F.col("sure"))
    )
    fractional = (F.col("size") > 0) & (F.col("f") > 0)
    kept = ("doc_id", "source", "size", "n", "source_size", "target", "base", "sure")
    settled = items.filter(~fractional).select(*kept, F.lit(False).alias("hit"))

    leaf = F.pmod(F.xxhash64("doc_id", "size", F.lit(seed)), F.ceil(F.col("members") / fanout))
    item = F.struct(uniform(F.col("doc_id"), F.col("size"), F.lit(seed)).alias("u"), "f", F.col("size").alias("w"), *kept)
    leaves = pin(
        items.filter(fractional)
        .withColumn("leaf", leaf)
        .groupBy("src", "leaf")
        .agg(F.sort_array(F.collect_list(item)).alias("items"))
        .withColumn("folded", rounded(F.col("items")))
    )
    most = sources.agg(F.max("members")).first()[0] or 0
    fates = _fates(leaves, -(-most // fanout), fanout, seed)
    # The decided ones, and the one left over with its fate from above, in the order of the leaf.
    left = F.array(F.struct(F.col("folded.pos").alias("pos"), F.col("hit").alias("hit")))
    in_order = F.sort_array(F.concat(F.col("folded.won"), left))
    met = (
        leaves.join(fates, ["src", "leaf"])
        .select(F.explode(F.arrays_zip(F.col("items").alias("item"), in_order.alias("fate"))).alias("x"))
        .select(*[F.col(f"x.item.{c}").alias(c) for c in kept], F.col("x.fate.hit").alias("hit"))
    )
    extra = F.col("sure") + F.col("hit").cast("int")
    copies = (F.col("base") + (F.col("copy_no") < extra).cast("int")).cast("int")
    block = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / COPY_BLOCK).cast("int")))
    first = F.col("block") * F.lit(COPY_BLOCK).cast("bigint")
    row = F.explode(F.sequence(first, F.least(F.col("n"), first + COPY_BLOCK) - 1))
    return (
        settled.unionByName(met)
        .withColumn("block", block)
        .withColumn("copy_no", row)
        .withColumn("copies", copies)
        .select(
            "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
        )
    )
