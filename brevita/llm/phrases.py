"""Phrase collocations, counted with a burstable trie of hash containers in tasks and sorted runs between them.

A task counts words and phrases of up to three words in one trie a language: below each first word stands a hash container of what
follows; a container that grows too large bursts into containers by the second word. When the trie holds too many entries, its largest
subtrees leave as sorted runs, dealt to prefix partitions and cut into blocks. The task of a prefix partition reads the blocks in the
order of their first phrases, so a phrase is complete as soon as a block begins behind it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brevita.llm.words import mixed
from brevita.session import pin

MOST_WORDS = 3
LEAST = 10
TOP = 2000
# Entries of a task's tries, of a run, of a container before it bursts, of a block of a run, and waiting in a merge before complete ones go.
ENTRIES = 1_000_000
RUN = 300_000
BURST = 4096
BLOCK = 4096
WAITING = 300_000
# Word occurrences for each prefix partition.
PART_WORDS = 1_000_000
# Phrases of one two-word prefix are dealt over so many partitions by what follows.
FOLLOWERS = 16
GROUP_BYTES = 4 << 20

# A-Z to lower case, tab to blank; marks and line ends that part pieces to a byte that UTF-8 never has.
_CUT = 0xFF
_BYTES = bytes(_CUT if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_MARK = bytes([_CUT])
_BITS = 21
_MASK = (1 << _BITS) - 1
_TEXT = pa.large_binary()


class Words(dict):
    """Number of each word in order of appearance, from 1; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({_MARK: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Trie:
    """Counts of number sequences of one to three words. Below the first word stands a container {rest: count}, or, once burst, a
    dict of such containers by second word. ``rest`` is second word and third word in one number; no word is 0."""

    def __init__(self, burst: int = BURST):
        self.root: dict[int, dict] = {}
        self.burst_at = burst
        self.burst: set[int] = set()
        self.size: dict[int, int] = {}
        self.entries = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """``keys``: sorted, distinct, 21 bits a word, the first word on top."""
        if not len(keys):
            return
        first = keys >> (2 * _BITS)
        starts = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
        firsts, stops = first[starts].tolist(), [*starts[1:].tolist(), len(keys)]
        rests, times = (keys & ((1 << 2 * _BITS) - 1)).tolist(), counts.tolist()
        root, begin = self.root, 0
        for word, end in zip(firsts, stops, strict=True):
            node = root.get(word)
            if node is None:
                root[word] = node = dict(zip(rests[begin:end], times[begin:end], strict=True))
                self.size[word] = len(node)
                self.entries += len(node)
            elif word in self.burst:
                self._below(word, node, rests[begin:end], times[begin:end])
            else:
                get, before = node.get, len(node)
                for rest, n in zip(rests[begin:end], times[begin:end], strict=True):
                    node[rest] = get(rest, 0) + n
                self.size[word] = len(node)
                self.entries += len(node) - before
            if len(node) > self.burst_at and word not in self.burst:
                self._burst(word, node)
            begin = end

    def _below(self, word: int, node: dict, rests: list[int], counts: list[int]) -> None:
        grown = 0
        for rest, n in zip(rests, counts, strict=True):
            second, third = rest >> _BITS, rest & _MASK
            container = node.get(second)
            if container is None:
                node[second] = {third: n}
                grown += 1
            elif third in container:
                container[third] += n
            else:
                container[third] = n
                grown += 1
        self.size[word] += grown
        self.entries += grown

    def _burst(self, word: int, node: dict[int, int]) -> None:
        below: dict[int, dict[int, int]] = {}
        for rest, n in node.items():
            below.setdefault(rest >> _BITS, {})[rest & _MASK] = n
        self.root[word] = below
        self.burst.add(word)

    def take(self, firsts: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Keys and counts of whole subtrees, which leave the trie."""
        tops, sizes, rests, counts = [], [], [], []
        for word in firsts:
            node, top = self.root.pop(word), word << (2 * _BITS)
            if word in self.burst:
                for second, container in node.items():
                    tops.append(top | (second << _BITS))
                    sizes.append(len(container))
                    rests += container
                    counts += container.values()
                self.burst.discard(word)
            else:
                tops.append(top)
                sizes.append(len(node))
                rests += node
                counts += node.values()
            self.entries -= self.size.pop(word)
        above = np.repeat(np.array(tops, np.int64), np.array(sizes, np.int64))
        return above | np.array(rests, np.int64), np.array(counts, np.int64)

    def portions(self, firsts: list[int], most: int) -> Iterator[list[int]]:
        """The first words in lists whose subtrees have about ``most`` entries together; a larger subtree is a list of its own."""
        chosen, held = [], 0
        for word in firsts:
            if chosen and held + self.size[word] > most:
                yield chosen
                chosen, held = [], 0
            chosen.append(word)
            held += self.size[word]
        if chosen:
            yield chosen

    def largest(self, share: float) -> list[int]:
        """First words of the largest subtrees, which together hold at least that share of the entries."""
        chosen, held = [], 0
        for first in sorted(self.size, key=lambda f: (-self.size[f], f)):
            if held >= share * self.entries:
                break
            chosen.append(first)
            held += self.size[first]
        return chosen


def _tally(ids: np.ndarray, carried: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and their counts, of all sequences of up to three words that end behind the first ``carried`` numbers."""
    held = ids > 0
    two = held[1:] & held[:-1]
    keys = [ids[carried:][held[carried:]] << (2 * _BITS)]
    if len(ids) > 1:
        pairs = (ids[:-1] << (2 * _BITS)) | (ids[1:] << _BITS)
        new = np.arange(1, len(ids)) >= carried
        keys.append(pairs[two & new])
        if len(ids) > 2:
            keys.append((pairs[:-1] | ids[2:])[two[:-1] & two[1:] & new[1:]])
    return np.unique(np.concatenate(keys), return_counts=True)


def _pieces(data: bytes) -> Iterator[bytes]:
    """The text in parts of about ``GROUP_BYTES`` that end between words."""
    start = 0
    while len(data) - start > GROUP_BYTES:
        at = max(data.find(b" ", start + GROUP_BYTES), -1)
        mark = data.find(_MARK, start + GROUP_BYTES, at if at >= 0 else len(data))
        stop = mark if mark >= 0 else at
        if stop < 0:
            break
        yield data[start:stop]
        start = stop
    yield data[start:]


class Counter:
    """Counts the texts of a task, and gives up runs as rows."""

    def __init__(self, parts: int, entries: int = ENTRIES):
        self.parts, self.limit = parts, entries
        self.words, self.tries, self.totals = Words(), {}, {}
        self.rows: list[tuple] = []

    def add(self, lang: str, texts: list[bytes]) -> None:
        number = self.words.__getitem__
        trie = self.tries.setdefault(lang, Trie())
        carry = np.zeros(0, np.int64)
        for data in _pieces(_MARK.join(texts).translate(_BYTES)):
            words = data.replace(_MARK, b" " + _MARK + b" ").split()
            new = np.fromiter(map(number, words), np.int64, len(words))
            ids = np.concatenate([carry, new])
            self.totals[lang] = self.totals.get(lang, 0) + int((new > 0).sum())
            trie.add(*_tally(ids, len(carry)))
            carry = ids[-2:]
            if len(self.words) > _MASK // 4:  # room for the words of one more part, of four bytes or more on average
                kept = [list(self.words)[i] for i in carry.tolist()]
                self.spill(0)
                carry = np.array([self.words[w] for w in kept], np.int64)
                number, trie = self.words.__getitem__, self.tries.setdefault(lang, Trie())
            elif sum(t.entries for t in self.tries.values()) > self.limit:
                self.spill(self.limit // 2)

    def spill(self, down_to: int) -> None:
        """Largest subtrees leave until no more than ``down_to`` entries are held; at 0 all, and the words are forgotten."""
        held = sum(t.entries for t in self.tries.values())
        share = (held - down_to) / held if held else 0
        # Every word with the blank behind it, so phrases sort by their bytes; no word is nothing.
        names = [b"", *[w + b" " for w in self.words][1:]]
        place = np.empty(len(names), np.int64)
        order = sorted(range(1, len(names)), key=names.__getitem__)
        place[0], place[order] = 0, np.arange(1, len(names))
        hashes = pd.util.hash_array(np.array(names, dtype=object), categorize=False)
        hashes[0] = 0
        spelled = pa.array(names, _TEXT)
        for lang, trie in self.tries.items():
            for firsts in trie.portions(list(trie.size) if not down_to else trie.largest(share), RUN):
                self.rows += _run(lang, *trie.take(firsts), spelled, place, hashes, self.parts)
        if not down_to:
            self.words, self.tries = Words(), {}

    def finish(self) -> None:
        self.spill(0)
        for lang, n in self.totals.items():
            self.rows.append((0, lang, b"", *_packed(b"", np.array([n]))))


def _packed(phrases: bytes, counts: np.ndarray) -> tuple[bytes, bytes]:
    compress = zstandard.ZstdCompressor(level=1).compress
    return compress(phrases), compress(counts.astype(np.int64).tobytes())


def _unpacked(phrases: bytes, counts: bytes) -> tuple[list[bytes], list[int]]:
    decompress = zstandard.ZstdDecompressor().decompress
    return decompress(phrases).split(b"\n"), np.frombuffer(decompress(counts), np.int64).tolist()


def _run(lang: str, keys: np.ndarray, counts: np.ndarray, names: pa.Array, place: np.ndarray, hashes: np.ndarray, parts: int):
    """Blocks of the sorted run of these entries for each prefix partition: part, lang, first phrase, phrases, counts."""
    a, b, c = keys >> (2 * _BITS), (keys >> _BITS) & _MASK, keys & _MASK
    with np.errstate(over="ignore"):
        prefix = hashes[a] * np.uint64(3) + hashes[b] * np.uint64(5)
        follower = np.where(c > 0, hashes[c] % np.uint64(FOLLOWERS), 0)
        part = (mixed(prefix + follower.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort((place[a] << (2 * _BITS)) | (place[b] << _BITS) | place[c])
    order = order[np.argsort(part[order], kind="stable")]
    part, counts = part[order], counts[order]
    # Each phrase ends with a line feed, which no word has; a block leaves out the last one.
    line_end = pa.scalar(b"\n", _TEXT)
    phrases = pc.binary_join_element_wise(*[names.take(pa.array(x[order])) for x in (a, b, c)], line_end, pa.scalar(b"", _TEXT))
    offsets, data = np.frombuffer(phrases.buffers()[1], np.int64, len(phrases) + 1).tolist(), memoryview(phrases.buffers()[2])
    edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
    for begin, end in zip(edges, edges[1:], strict=False):
        for at in range(begin, end, BLOCK):
            to = min(at + BLOCK, end)
            head = bytes(data[offsets[at] : offsets[at + 1] - 1])
            yield int(part[at]), lang, head, *_packed(data[offsets[at] : offsets[to] - 1], counts[at:to])


_RUN = pa.schema([("part", pa.int32()), ("lang", pa.string()), ("head", pa.binary()), ("phrases", pa.binary()), ("counts", pa.binary())])
_RUN_SQL = "part int, lang string, head binary, phrases binary, counts binary"


def _counted(parts: int, entries: int):
    def emitted(counter: Counter) -> Iterator[pa.RecordBatch]:
        rows, counter.rows = counter.rows, []
        for at in range(0, len(rows), 512):
            columns = zip(*rows[at : at + 512], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _RUN.types, strict=True)], schema=_RUN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, held, size = Counter(parts, entries), {}, 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                data = text.as_py()
                held.setdefault(lang, []).append(data)
                size += len(data)
                if size > GROUP_BYTES:
                    for one, texts in held.items():
                        counter.add(one, texts)
                    held, size = {}, 0
                    yield from emitted(counter)
        for one, texts in held.items():
            counter.add(one, texts)
        counter.finish()
        yield from emitted(counter)

    return run


def _merged(least: int, waiting: int):
    """Task over blocks sorted by part, lang and first phrase: phrases that occur at least ``least`` times, and the totals (no words)."""

    def given(lang: str, found: dict[bytes, int], before: bytes | None) -> pa.RecordBatch:
        """What is complete leaves ``found``; all of it without ``before``."""
        if before is None:
            rows = [(p, n) for p, n in found.items() if n >= least or not p]
            found.clear()
        else:
            done = [p for p in found if p < before]
            rows = [(p, n) for p in done if (n := found.pop(p)) >= least or not p]
        names = pa.array([p[:-1].decode() for p, _ in rows], pa.string())
        counts = pa.array([n for _, n in rows], pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(rows), pa.string()), names, counts], names=["lang", "phrase", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, found, limit = None, {}, waiting
        for batch in batches:
            for part, lang, head, phrases, counts in zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True):
                if key != (part, lang):
                    if key is not None:
                        yield given(key[1], found, None)
                    key, found, limit = (part, lang), {}, waiting
                elif len(found) > limit:
                    yield given(lang, found, head)
                    limit = max(waiting, 2 * len(found))
                new = dict(zip(*_unpacked(phrases, counts), strict=True))
                for p in new.keys() & found.keys():
                    new[p] += found[p]
                found |= new
        if key is not None:
            yield given(key[1], found, None)

    return run


def count_phrases(docs: DataFrame, least: int = LEAST, part_words: int = PART_WORDS, entries: int = ENTRIES) -> DataFrame:
    """lang, phrase, words, f: how often each phrase of one to three words occurs in the texts of a language, ``least`` times or more.

    A row of no words (phrase '', words 0) has the number of all words of the language. Texts are cut into pieces at ``.,;:!?`` and line ends
    (line feed, vertical tab, form feed, carriage return), and into words at blanks and tabs, A-Z in lower case. Phrases lie within pieces and may
    overlap. A null text is empty, a null lang is ``und``; rows repeat as often as they are there. Other columns are not read. An empty
    table gives no row. Very long texts are read in parts; only a single word has to fit whole. Counts stay below 2^63.
    """
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Words are taken as six bytes long; that only sets how many partitions there are.
    parts = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // (6 * part_words)))
    runs = texts.mapInArrow(_counted(parts, entries), _RUN_SQL)
    merged = (
        runs.repartitionById(parts, "part")
        .sortWithinPartitions("part", "lang", "head")
        .mapInArrow(_merged(least, WAITING), "lang string, phrase string, f bigint")
    )
    words = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
    return merged.select("lang", "phrase", words.alias("words"), "f")


def _part(words: str, start: int, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, cover: int = 50, **count) -> DataFrame:
    """The ``top`` phrases of two or three words of each language: lang, rank (from 1), phrase, a, l, r, n, score.

    ``a`` is how often the phrase occurs, at least ``least`` times. Of its cuts into a first part (``l`` times) and a rest (``r`` times) the one of the smallest
    score counts, score = floor(1000000 a a / (l r)), ties to the shortest first part. ``n`` is the number of words of the language. A phrase that lies
    in a longer one of ``least`` or more occurrences is dropped if that occurs in at least ``cover`` per cent of its own. By score and ``a``,
    largest first, then by the bytes of the phrase. Texts, languages, nulls, repeated rows and empty tables are as in ``count_phrases``.
    Exact in decimals while counts stay below 10^15; beyond that an error is raised.
    """
    counts = pin(count_phrases(docs, least, **count))
    longer = counts.filter("words = 3").withColumn("w", F.split("phrase", " "))
    inner = longer.select("lang", "f", F.explode(F.array(_part("w", 1, 2), _part("w", 2, 2))).alias("phrase"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("f").alias("longest"))
    phrases = (
        counts.filter("words > 1")
        .join(inner, ["lang", "phrase"], "left")
        .filter(F.coalesce(100 * F.col("longest") < cover * F.col("f"), F.lit(True)))
        .select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    )
    cuts = phrases.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", _part("w", 1, F.col("k")).alias("first"), _part("w", F.col("k") + 1, F.size("w")).alias("rest")
    )
    parts = counts.filter("words between 1 and 2")
    firsts = parts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rests = parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    exact = {c: f"cast({c} as decimal(15,0))" for c in "alr"}
    score = F.expr(f"(cast(1000000 as decimal(7,0)) * ({exact['a']} * {exact['a']})) div ({exact['l']} * {exact['r']})")
    fits = F.assert_true(F.greatest("a", "l", "r") < 10**15, F.lit("counts of 10^15 and more are not exact"))
    scored = cuts.join(firsts, ["lang", "first"]).join(rests, ["lang", "rest"]).filter(fits.isNull()).withColumn("score", score)
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    totals = counts.filter("words = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return (
        lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
        .withColumn("rank", F.row_number().over(order).cast("bigint"))
        .filter(F.col("rank") <= top)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
