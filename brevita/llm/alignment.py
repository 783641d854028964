"""Alignment of two tokenizers' tokens over the same texts, and how often their ids meet.

Both tokenizers cover the same bytes of a text. Where a token of each ends at the same byte the two agree, and such common ends cut
the text into groups. They are found by halving: from the middle end of the one side, the nearest ends on either hand that the other side has
too, by bisect, cut an interval into a left half, a group without cuts, and a right half; halves go on, all intervals of many texts a step.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brevita.llm.words import groups
from brevita.session import pin

FOLDER = "/opt/tokenizers"
BYTE_LEVEL, PIECES = f"{FOLDER}/byte_bpe_50k.json", f"{FOLDER}/piece_bpe_32k.model"
# Fixed: the words that a byte-level tokenizer with its own pattern splits a text into.
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LONG_BLANK = re.compile(r"\s{1000}")
# Texts are aligned in parts of about so many bytes, whose arrays fit a core's cache.
PART_BYTES = 256 << 10
# Links of a block of documents, whose id pairs get their counts together. A longer document is a block of its own.
BLOCK_LINKS = 4_000_000


# --- tokenizers, in tasks ------------------------------------------------------------------------------------------------------


def _byte_of() -> dict[str, int]:
    """The bytes that the characters of a byte-level vocabulary stand for: printable Latin-1 for itself, the rest in order from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass
class Tokens:
    """A tokenizer: ``encode`` gives the ids of each text, ``spelled`` the bytes of each id."""

    encode: object
    spelled: list[bytes]
    sizes: np.ndarray = field(init=False)

    def __post_init__(self):
        self.sizes = np.array([len(x) for x in self.spelled], np.int64)


def _ranks(data: bytes, spelled: list[bytes]) -> dict[bytes, int] | None:
    """Bytes to ids, if the file's pairs merge in the order of their ids and nothing else bears on the result; else None."""
    file = json.loads(data)
    model, split = file["model"], file["pre_tokenizer"] or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and not file["normalizer"]
    odd = any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    if model["type"] != "BPE" or odd or not plain:
        return None
    ids, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    singles = set(ids) - {x + y for x, y in merges} - {x["content"] for x in file["added_tokens"]}
    if len(singles) != 256 or any(ids.get(x + y) != 256 + i for i, (x, y) in enumerate(merges)):
        return None
    return {spelled[i]: i for i in range(256 + len(merges))}


def byte_level(data: bytes) -> Tokens:
    """From a tokenizer's JSON with a byte-level vocabulary; texts get a blank in front, special tokens' strings are plain text.

    A vocabulary whose ids follow its merges is encoded by ranks, which gives the same ids several times as fast. Texts with long runs of white space, which
    overflow the regular expression there, and other vocabularies take the tokenizer of the file.
    """
    # Tasks already use all cores.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_buffer(data)
    tokenizer.encode_special_tokens = True
    of = _byte_of()
    vocabulary = tokenizer.get_vocab()
    spelled = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        spelled[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
    ranks = _ranks(data, spelled)
    by_rank = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={}) if ranks else None

    def encode(texts: list[str]) -> list[list[int]]:
        if by_rank is None:
            return [e.ids for e in tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        return [
            tokenizer.encode(" " + t, add_special_tokens=False).ids if _LONG_BLANK.search(t) else by_rank.encode_ordinary(" " + t) for t in texts
        ]

    return Tokens(encode, spelled)


def pieces(data: bytes) -> Tokens:
    """From a model of pieces, which puts a blank in front itself; U+2581 stands for a blank, <0xHH> for a byte."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_proto=data)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    spelled = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
    return Tokens(lambda texts: model.encode(texts, num_threads=1), spelled)


_loaded: dict[tuple, Tokens] = {}


def _load(kind, data: bytes) -> Tokens:
    """Once for each worker process."""
    key = (kind.__name__, hashlib.sha256(data).digest())
    if key not in _loaded:
        _loaded[key] = kind(data)
    return _loaded[key]


def read_file(spark: SparkSession, path: str, most: int = 64 << 20) -> bytes:
    """A vocabulary file, read by Spark from any store, at most ``most`` bytes: it goes to every task."""
    (row,) = spark.read.format("binaryFile").load(path).select("length", "content").collect()
    if row.length > most:
        raise ValueError(f"{path} has more than {most} bytes")
    return bytes(row.content)


# --- cuts and links, in tasks --------------------------------------------------------------------------------------------------


def _nearest(ends_a: np.ndarray, ends_b: np.ndarray, at: np.ndarray, last: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """From each place ``at`` in ``ends_a`` towards ``last`` (included), the first whose end is one of ``ends_b``: its places in both, or -1."""
    found_a, found_b = np.full(len(at), -1, np.int64), np.full(len(at), -1, np.int64)
    at, left = at.copy(), np.flatnonzero((last - at) * step >= 0)
    while len(left):
        end = ends_a[at[left]]
        place = np.minimum(np.searchsorted(ends_b, end), len(ends_b) - 1)
        hit = ends_b[place] == end
        found_a[left[hit]], found_b[left[hit]] = at[left[hit]], place[hit]
        left = left[~hit]
        at[left] += step
        left = left[(last[left] - at[left]) * step >= 0]
    return found_a, found_b


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, stops_a: np.ndarray, stops_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places, in both, of all ends that ``ends_a`` and ``ends_b`` (ascending) share, the ``stops`` (places behind each text's last) included."""
    cut_a, cut_b = np.zeros(len(ends_a), bool), np.zeros(len(ends_b), bool)
    cut_a[stops_a - 1] = cut_b[stops_b - 1] = True
    # Open intervals: tokens [low, high) of each side, with the ends at both borders shared.
    low_a, high_a = np.concatenate([[0], stops_a[:-1]]), stops_a
    low_b, high_b = np.concatenate([[0], stops_b[:-1]]), stops_b
    while True:
        # One token on a side: a group.
        wide = (high_a - low_a > 1) & (high_b - low_b > 1)
        low_a, high_a, low_b, high_b = low_a[wide], high_a[wide], low_b[wide], high_b[wide]
        if not len(low_a):
            return np.flatnonzero(cut_a), np.flatnonzero(cut_b)
        middle = (low_a + high_a - 2) // 2
        left_a, left_b = _nearest(ends_a, ends_b, middle, low_a, -1)
        right_a, right_b = _nearest(ends_a, ends_b, middle + 1, high_a - 2, 1)
        for at_a, at_b in ((left_a, left_b), (right_a, right_b)):
            cut_a[at_a[at_a >= 0]] = True
            cut_b[at_b[at_b >= 0]] = True
        # What lies between the two cuts is a group, or all of it if there are none.
        has_left, has_right = left_a >= 0, right_a >= 0
        low_a, high_a, low_b, high_b = (
            np.concatenate([low_a[has_left], right_a[has_right] + 1]),
            np.concatenate([left_a[has_left] + 1, high_a[has_right]]),
            np.concatenate([low_b[has_left], right_b[has_right] + 1]),
            np.concatenate([left_b[has_left] + 1, high_b[has_right]]),
        )


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray, starts_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of tokens whose byte ranges overlap, by the second side's place; ranges of each side follow without gaps."""
    first = np.searchsorted(ends_a, starts_b, "right")
    many = np.searchsorted(ends_a, ends_b, "left") - first + 1
    place_b = np.repeat(np.arange(len(ends_b)), many)
    return np.arange(len(place_b)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many), place_b


@functools.cache
def _signs(top: int) -> list[str]:
    """Each id below ``top`` with a comma, as inside a group's side, then with a bar, as between the sides, then with a semicolon, as behind a group."""
    return [f"{i}{mark}" for mark in ",|;" for i in range(top)]


@dataclass
class Aligned:
    """Tokens of many texts one after another: ids, places behind each text's last, and places of the shared ends."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    stops_a: np.ndarray
    stops_b: np.ndarray
    cuts_a: np.ndarray
    cuts_b: np.ndarray
    links: np.ndarray  # id pairs, the first side's id on top
    link_stops: np.ndarray

    def group_counts(self) -> np.ndarray:
        return np.diff(np.searchsorted(self.cuts_a, np.concatenate([[0], self.stops_a])))

    def written(self) -> list[str]:
        """Of each text ``a1,a2|b1;a3|b2,b3``: groups in order, each with the ids of both sides."""
        n, m = len(self.ids_a), len(self.ids_b)
        close_a, close_b = np.zeros(n, bool), np.zeros(m, bool)
        close_a[self.cuts_a] = close_b[self.cuts_b] = True
        # A group's first ids stand behind all second ids of the groups before, its second ids behind all first ids up to it.
        before_b = np.concatenate([[0], self.cuts_b + 1])
        up_to_a = np.concatenate([self.cuts_a + 1, [n]])
        place_a = np.arange(n) + before_b[np.cumsum(close_a) - close_a]
        place_b = np.arange(m) + up_to_a[np.cumsum(close_b) - close_b]
        top = 1 << int(max(self.ids_a.max(initial=0), self.ids_b.max(initial=0))).bit_length()
        table = _signs(top)
        signs = np.empty(n + m, np.int64)
        signs[place_a], signs[place_b] = self.ids_a + top * close_a, self.ids_b + 2 * top * close_b
        signs = signs.tolist()
        stops, begin, out = (self.stops_a + self.stops_b).tolist(), 0, []
        for stop in stops:
            out.append("".join([table[s] for s in signs[begin:stop]])[:-1])
            begin = stop
        return out


def align_texts(texts: list[str | None], a: Tokens, b: Tokens) -> Aligned:
    """Tokens of each text with a blank in front; none where the bytes of a side differ from it, or the text is empty or null."""
    chosen = [i for i, t in enumerate(texts) if t]
    ids_a, ids_b = [[] for _ in texts], [[] for _ in texts]
    given = [texts[i] for i in chosen]
    for i, t, x, y in zip(chosen, given, a.encode(given) if given else [], b.encode(given) if given else [], strict=True):
        whole = (" " + t).encode()
        if b"".join([a.spelled[k] for k in x]) == whole and b"".join([b.spelled[k] for k in y]) == whole:
            ids_a[i], ids_b[i] = x, y
    stops_a, stops_b = np.cumsum([len(x) for x in ids_a], dtype=np.int64), np.cumsum([len(x) for x in ids_b], dtype=np.int64)
    flat_a, flat_b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (ids_a, ids_b))
    ends_a, sizes_b = np.cumsum(a.sizes[flat_a]), b.sizes[flat_b]
    ends_b = np.cumsum(sizes_b)
    full = np.diff(stops_a, prepend=0) > 0
    if not full.any():
        none = np.zeros(0, np.int64)
        return Aligned(flat_a, flat_b, stops_a, stops_b, none, none, none, np.zeros(len(texts), np.int64))
    cuts_a, cuts_b = shared_cuts(ends_a, ends_b, stops_a[full], stops_b[full])
    at_a, at_b = overlaps(ends_a, ends_b, ends_b - sizes_b)
    links = (flat_a[at_a] << 32) | flat_b[at_b]
    return Aligned(flat_a, flat_b, stops_a, stops_b, cuts_a, cuts_b, links, np.searchsorted(at_b, stops_b))


# --- the operator ----------------------------------------------------------------------------------------------------------------


def align(docs: DataFrame, a: str = BYTE_LEVEL, b: str = PIECES, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The alignment of each text under two tokenizers: ``row`` (a struct of the columns in ``keep``, whatever their names), n_a and n_b (tokens), n_groups,
    n_links, ``groups`` (``a1,a2|b1;a3|b2,b3``: ids of both sides by group; '' without tokens), and block, place, codes for ``link_counts``.

    ``a`` names a byte-level tokenizer's JSON, ``b`` a model of pieces; both are read by Spark and sent to the tasks. Texts get one blank in front;
    special tokens' strings in them are plain text. A text that is null or empty, or whose bytes a side doesn't spell, has no tokens. A link is a
    pair of tokens, one of each side, whose byte ranges overlap. Reads ``text`` only; repeated rows and ids are rows of their own, an empty table gives no row.
    A very long text is held whole by its task, at some hundred bytes a token.
    """
    spark = docs.sparkSession
    files = [read_file(spark, path) for path in (a, b)]
    sent = spark.sparkContext.broadcast(files)
    rows = docs.select(F.struct(*keep).alias("row"), F.col("text"))
    shape = rows.schema["row"].dataType.simpleString()
    return rows.select("row", "text", F.spark_partition_id().alias("part")).mapInArrow(
        _blocks(sent),
        f"row {shape}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, block bigint, codes binary, "
        "pairs array<bigint>, times array<bigint>",
    )


def _blocks(sent):
    """Task that aligns its texts. Behind the documents of a block comes a row without ``row``: the block's distinct links by falling number
    of times. A document's ``codes`` are places in that list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = sent.value
        a, b = _load(byte_level, files[0]), _load(pieces, files[1])
        held, links, block = [], 0, 0
        for batch in batches:
            part, shape = batch.column("part")[0].as_py() if batch.num_rows else 0, batch.column("row").type
            for piece in groups(batch.column("text").cast(pa.binary()).to_pylist(), PART_BYTES):
                rows = batch.slice(piece.start, piece.stop - piece.start)
                found = align_texts(rows.column("text").to_pylist(), a, b)
                held.append((rows.column("row"), found))
                links += len(found.links)
                if links >= BLOCK_LINKS:
                    yield from finished(held, (part << 32) + block, shape)
                    held, links, block = [], 0, block + 1
        if held:
            yield from finished(held, (part << 32) + block, shape)

    def finished(held: list, block: int, shape: pa.DataType) -> Iterator[pa.RecordBatch]:
        codes, pairs = pd.factorize(np.concatenate([x.links for _, x in held]))
        times = np.bincount(codes, minlength=len(pairs))
        order = np.lexsort((pairs, -times))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        codes, begin = place[codes], 0
        for rows, x in held:
            own = codes[begin : begin + len(x.links)]
            begin += len(x.links)
            starts = np.concatenate([[0], x.link_stops[:-1]])
            packed = [_packed(own[i:j]) for i, j in zip(starts, x.link_stops, strict=True)]
            yield _batch(
                rows, np.diff(x.stops_a, prepend=0), np.diff(x.stops_b, prepend=0), x.group_counts(), x.link_stops - starts, x.written(), block, packed, None
            )
        if len(pairs):
            none = [None]
            yield _batch(pa.nulls(1, shape), none, none, none, none, none, block, none, (pairs[order], times[order]))

    return run


def _batch(rows, n_a, n_b, n_groups, n_links, written, block, codes, pairs) -> pa.RecordBatch:
    listed = pa.list_(pa.int64())
    arrays = [
        rows, *[pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_links)], pa.array(written, pa.string()),
        pa.array([block] * len(rows), pa.int64()), pa.array(codes, pa.binary()),
        *[pa.nulls(len(rows), listed) if pairs is None else pa.array([x], listed) for x in pairs or (None, None)],
    ]
    return pa.RecordBatch.from_arrays(
        arrays, names=["row", "n_a", "n_b", "n_groups", "n_links", "groups", "block", "codes", "pairs", "times"]
    )


def _packed(codes: np.ndarray) -> bytes:
    """Numbers below 2^32, byte by byte, compressed; most are small, since frequent links come first."""
    split = codes.astype("<u4").view(np.uint8).reshape(-1, 4)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(split.T).tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def link_counts(aligned: DataFrame) -> DataFrame:
    """From ``align``: a, b, n (how many links of the corpus hold the two ids linked), best (n is the highest of all pairs with this b)."""
    each = aligned.filter("pairs is not null").select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    n = pin(each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("n")))
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    highest = n.groupBy(b.alias("b")).agg(F.max("n").alias("highest"))
    return n.withColumn("b", b).join(highest, "b").select(F.shiftright("pair", 32).alias("a"), "b", "n", (F.col("n") == F.col("highest")).alias("best"))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task over rows sorted by block, the block's counts before its documents: the sums of each document."""
    names = ["row", "n_a", "n_b", "n_groups", "n_links", "digest", "n_best", "count_sum"]
    block, ready, places, counts, best = None, True, [], [], []
    for batch in batches:
        blocks, place = batch.column("block").to_numpy(), batch.column("place").to_numpy()
        edges = np.flatnonzero((blocks[1:] != blocks[:-1]) | ((place[1:] < 0) != (place[:-1] < 0))) + 1
        for i, j in zip([0, *edges.tolist()], [*edges.tolist(), len(blocks)], strict=True):
            if i == j:
                continue
            rows = batch.slice(i, j - i)
            if place[i] >= 0:
                if block != blocks[i] or ready:
                    block, ready, places, counts, best = blocks[i], False, [], [], []
                places.append(place[i:j])
                counts.append(rows.column("n").to_numpy(zero_copy_only=False))
                best.append(rows.column("best").to_numpy(zero_copy_only=False).astype(bool))
                continue
            if not ready:
                order = np.concatenate(places)
                n, top = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
                n[order], top[order], ready = np.concatenate(counts), np.concatenate(best), True
            sums = []
            for data in rows.column("codes").to_pylist():
                codes = _unpacked(data)
                sums.append((int(top[codes].sum()), int(n[codes].sum())) if len(codes) else (0, 0))
            n_best, total = zip(*sums, strict=True)
            yield pa.RecordBatch.from_arrays(
                [*[rows.column(c) for c in names[:6]], pa.array(n_best, pa.int64()), pa.array(total, pa.int64())], names=names
            )


def score_links(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """Each document of ``align`` (written, with ``digest`` in place of ``groups``) with n_best, its links whose pair is the most frequent one of its second
    id, ties included, and count_sum, the sum of its links' counts.

    Links do not travel one by one: a block of documents gets the counts of its distinct pairs, and a document has places in their list. A pair that
    all documents hold is one row a block. Sums stay below 2^63.
    """
    wanted = aligned.filter("pairs is not null").select("block", F.posexplode("pairs").alias("place", "pair"))
    a, b = F.shiftright("pair", 32), F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    known = counts.select(F.col("a").alias("_a"), F.col("b").alias("_b"), "n", "best")
    known = wanted.withColumn("a", a).withColumn("b", b).join(known, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")))
    rows = aligned.filter("pairs is null").select("row", "n_a", "n_b", "n_groups", "n_links", "digest", "block", "codes")
    rows = rows.withColumns({"place": F.lit(-1), "n": F.lit(None).cast("bigint"), "best": F.lit(None).cast("boolean")})
    both = rows.unionByName(known.select("block", "place", "n", "best"), allowMissingColumns=True)
    shape = aligned.schema["row"].dataType.simpleString()
    return (
        both.repartition("block")
        .sortWithinPartitions("block", F.col("place") < 0)
        .mapInArrow(
            _summed,
            f"row {shape}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, digest string, n_best bigint, count_sum bigint",
        )
    )
