"""Hierarchical Pitman-Yor language model, trained and applied on packed token blocks.

Words are the dishes. Every previous word has a context restaurant of its own, and so has the
start of a text; words are told apart by 48 bits of their hash there. All
restaurants share the root restaurant as their parent, whose base is uniform. Seating follows the Chinese-restaurant process and is resampled by Gibbs
sweeps: in each, the tables of every dish are drawn again given the restaurant's other tables
and the parent's probabilities of the sweep before. The predictive probabilities of several
sweeps are averaged.

All tokens of a word are in one block, so a sweep needs nothing from other blocks but the
customers and tables of the restaurants that it meets. After a sweep each block hands on its
numbers by restaurant, and gets back the sums over all blocks; neither a task nor
the driver holds all restaurants. Blocks are written once, in buckets, so that they stay where they are while
sums and seats come to them. A document's score is the sum of what the blocks found for its tokens.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlens.llm.shingles import U, word_hashes
from meterlens.storage import durable, durable_buckets, recorded, remove_tables

#: Bits of a word's hash that name its restaurant. Among ten million words, 0.2 pairs share one.
CONTEXT_BITS = 48
#: Documents of a slice, at most; the bit above their numbers marks training tokens.
SLICE_DOCS = TRAIN_BIT = 1 << 15
#: The context of a text's first token.
START = U(0x5EED057A27)
END = U(0x5EED0FE2D)
BURN_IN, SAMPLES = 1, 3
CONCENTRATION = (1.0, 1.0)
#: Bytes of text in one slice of documents, and of text a block stands for, about.
SLICE_BYTES = 8 << 20
BLOCK_BYTES = 10 << 20
#: Blocks whose restaurants one part of the exchange adds up, about.
PART_BLOCKS = 16
#: Customers seated one by one; further ones in doubling groups.
ONE_BY_ONE = 32


def tokens(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, context of each) of a text's tokens, the end among them."""
    h = word_hashes(data)
    return np.append(h, END), np.append(START, h & U((1 << CONTEXT_BITS) - 1))


def packed(*arrays: np.ndarray) -> bytes:
    """The arrays' bytes, equal places of the numbers together, which compresses better."""
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() for a in arrays if len(a)]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpacked(blob: bytes, *shapes: tuple) -> list[np.ndarray]:
    data, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    for kind, count in shapes:
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(data, np.uint8, width * count, at).reshape(width, count)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += planes.nbytes
    return out


def dealt_tokens(docs: DataFrame, blocks: int) -> DataFrame:
    """Slices of documents as packed tokens, dealt by word: (block, slice, docs, blob, sizes).

    Block -1 of a slice holds its documents: ids, training flags and numbers of tokens.
    """
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = 0
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns)))
            at = 0
            while at < len(rows):
                end, size = at, 0
                while end < len(rows) and end - at < SLICE_DOCS and (end == at or size + len(rows[end][2]) <= SLICE_BYTES):
                    size += len(rows[end][2])
                    end += 1
                yield one_slice(rows[at:end], serial)
                serial += 1
                at = end

    def one_slice(rows: list[tuple], serial: int) -> pa.RecordBatch:
        found = [tokens(np.frombuffer(d, np.uint8)) for _, _, d in rows]
        counts = np.array([len(w) for w, _ in found])
        word, context = (np.concatenate(x) for x in zip(*found))
        train = np.array([not held for _, held, _ in rows], bool)
        marked = np.arange(len(rows), dtype=np.uint16) + train.astype(np.uint16) * np.uint16(TRAIN_BIT)
        doc = np.repeat(marked, counts)
        name = hashlib.blake2b(
            repr([TaskContext.get().partitionId(), serial, [r[0] for r in rows[:64]]]).encode(), digest_size=8)
        number = int.from_bytes(name.digest(), "little", signed=True)
        block = (word >> U(20)) % U(blocks)
        order = np.lexsort((context, word, block))
        word, context, doc, block = word[order], context[order], doc[order], block[order]
        edge = np.searchsorted(block, np.arange(blocks + 1, dtype=U))
        out = []
        for b in range(blocks):
            part = slice(edge[b], edge[b + 1])
            if edge[b] == edge[b + 1]:
                continue
            w, c = word[part], context[part]
            new_word = np.append(True, w[1:] != w[:-1])
            first = np.flatnonzero(new_word | np.append(True, c[1:] != c[:-1]))
            words = np.flatnonzero(new_word)
            types_of = np.diff(np.append(np.searchsorted(first, words), len(first))).astype(np.uint32)
            tokens_of = np.diff(np.append(first, len(w))).astype(np.uint32)
            out.append((b, number, len(rows), packed(w[words], types_of, c[first], tokens_of, doc[part]),
                        [len(words), len(first), len(w)], None))
        out.append((-1, number, len(rows), packed(train, counts), None,
                    [r[0] for r in rows]))
        columns = list(zip(*out))
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()),
                 pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)],
            names=["block", "slice", "docs", "blob", "sizes", "ids"])

    return docs.mapInArrow(
        deal, "block int, slice long, docs int, blob binary, sizes array<long>, ids array<long>")


@dataclass
class Block:
    """One block's words, their types (word, context), and of each type context, training count."""

    number: int
    types_of: np.ndarray
    context: np.ndarray
    train: np.ndarray


def gathered_blocks(dealt: DataFrame, blocks: int) -> DataFrame:
    """One row per block: (at, slices, docs, sizes, types, keys, places, ids).

    ``types`` has the block's types by word and context, whose contexts are numbers of the sorted
    ``keys``; ``places`` has each token's document. The slices' own rows go through as they are, with
    ``places`` and ``ids`` alone; ``at`` is the number of a block, or of a slice.
    """
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] < 0:
                    yield gathered(row[1], [row[1]], [row[2]], None, None, None, row[3], row[5])
                    continue
                if held and held[-1][0] != row[0]:
                    yield merge(held)
                    held = []
                held.append(row)
        if held:
            yield merge(held)

    def gathered(at: int, slices: list, docs: list, sizes: list | None, types: bytes | None,
                 keys: bytes | None, places: bytes, ids: list | None = None) -> pa.RecordBatch:
        longs = pa.list_(pa.int64())
        return pa.RecordBatch.from_pydict({
            "at": pa.array([at], pa.int64()), "slices": pa.array([slices], longs),
            "docs": pa.array([docs], longs), "sizes": pa.array([sizes], longs),
            "types": pa.array([types], pa.binary()), "keys": pa.array([keys], pa.binary()),
            "places": pa.array([places], pa.binary()), "ids": pa.array([ids], longs)})

    def merge(rows: list[tuple]) -> pa.RecordBatch:
        words, contexts, counts, places, trains = [], [], [], [], []
        offset = 0
        for _, _, docs, blob, (n_words, n_types, n_tokens), _ in rows:
            w, t, c, n, d = unpacked(
                blob, (U, n_words), (np.uint32, n_words), (U, n_types), (np.uint32, n_types), (np.uint16, n_tokens))
            words.append(np.repeat(w, t))
            contexts.append(c)
            counts.append(n)
            places.append((d & np.uint16(TRAIN_BIT - 1)).astype(np.uint32) + np.uint32(offset))
            trains.append(d >= TRAIN_BIT)
            offset += docs
        word, context, count, place, train = map(np.concatenate, (words, contexts, counts, places, trains))
        del words, contexts, counts, places, trains
        order = np.lexsort((context, word))
        word, context = word[order], context[order]
        new_word = np.append(True, word[1:] != word[:-1])
        new_type = new_word | np.append(True, context[1:] != context[:-1])
        type_of = np.empty(len(order), np.uint32)
        type_of[order] = np.cumsum(new_type) - 1
        type_of = np.repeat(type_of, count)
        place = place[np.argsort(type_of, kind="stable")]
        first = np.flatnonzero(new_type)
        tokens_of = np.bincount(type_of, minlength=len(first)).astype(np.uint32)
        customers = np.bincount(type_of[train], minlength=len(first)).astype(np.uint32)
        types_of = np.add.reduceat(new_type.astype(np.int64), np.flatnonzero(new_word)).astype(np.uint32)
        keys, index = np.unique(context[first], return_inverse=True)
        return gathered(
            rows[0][0], [r[1] for r in rows], [r[2] for r in rows],
            [len(types_of), len(first), len(place), len(keys)],
            packed(types_of, index.astype(np.uint32), customers), packed(keys), packed(tokens_of, place))

    # A block's rows lie together; the slices' own rows are spread. Both lie where their numbers say.
    at = F.when(F.col("block") < 0, F.col("slice")).otherwise(F.col("block").cast("long"))
    return dealt.repartition(blocks, at).sortWithinPartitions("block", "slice").mapInArrow(
        gather, "at long, slices array<long>, docs array<long>, sizes array<long>, types binary, "
                "keys binary, places binary, ids array<long>")


def read_block(at: int, sizes: list[int], types: bytes) -> Block:
    types_of, context, train = unpacked(
        types, (np.uint32, sizes[0]), (np.uint32, sizes[1]), (np.uint32, sizes[1]))
    return Block(at, types_of, context, train.astype(np.int64))


def seat(customers: np.ndarray, strength: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables that ``customers`` of each dish take; a new one has weight ``strength``."""
    tables = np.minimum(customers, 1).astype(float)
    left = np.flatnonzero(customers > 1)
    seated = 1
    while len(left):
        n = customers[left]
        a, t = strength[left], tables[left]
        if seated < ONE_BY_ONE:
            tables[left] += rng.random(len(left)) < a / (seated - discount * t + a)
            seated += 1
        else:
            until = np.minimum(n, 2 * seated)
            mean = a * np.log((until - discount * t + a) / (seated - discount * t + a))
            tables[left] += np.minimum(rng.poisson(mean), until - seated)
            seated *= 2
        left = left[n > seated]
    return tables


@dataclass(frozen=True)
class Totals:
    """Numbers of the whole corpus: tokens, words, discounts, the root's customers and tables."""

    n: float
    v: float
    discounts: tuple[float, float]
    root_customers: float
    root_tables: float


class Seating:
    """The seats of a block's dishes after one sweep.

    ``customers`` and ``others`` are the customers and tables that the restaurants of the block's
    contexts have in all blocks.
    """

    def __init__(self, block: Block, totals: Totals | None = None, tables: np.ndarray | None = None,
                 root_tables: np.ndarray | None = None, customers: np.ndarray | None = None,
                 others: np.ndarray | None = None):
        self.block, self.totals, self.customers, self.others = block, totals, customers, others
        self.word_of = np.repeat(np.arange(len(block.types_of)), block.types_of)
        # At first all customers of a dish share a table.
        self.tables = np.minimum(block.train, 1).astype(float) if tables is None else tables
        self.root = self.of_words(self.tables)
        self.root_tables = np.minimum(self.root, 1) if root_tables is None else root_tables

    def of_words(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.word_of, x, minlength=len(self.block.types_of))

    def root_probability(self) -> np.ndarray:
        """Of each word, by the root restaurant."""
        t, d0 = self.totals, self.totals.discounts[1]
        new = (CONCENTRATION[1] + d0 * t.root_tables) / (t.v + 1)
        return (self.root - d0 * self.root_tables + new) / (CONCENTRATION[1] + t.root_customers)

    def swept(self, rng: np.random.Generator) -> Seating:
        """All tables drawn again, given the totals of this sweep."""
        t, (d1, d0) = self.totals, self.totals.discounts
        others = np.maximum(self.others[self.block.context] - self.tables, 0)
        strength = (CONCENTRATION[0] + d1 * others) * self.root_probability()[self.word_of]
        tables = seat(self.block.train, strength, d1, rng)
        root = self.of_words(tables)
        new = np.full(len(root), (CONCENTRATION[1] + d0 * t.root_tables) / (t.v + 1))
        return Seating(self.block, tables=tables, root_tables=seat(root.astype(np.int64), new, d0, rng))

    def predictive(self) -> np.ndarray:
        """Probability of each type."""
        d1, u = self.totals.discounts[0], self.block.context
        own = self.block.train - d1 * self.tables
        new = (CONCENTRATION[0] + d1 * self.others[u]) * self.root_probability()[self.word_of]
        return (own + new) / (CONCENTRATION[0] + self.customers[u])


def seated(block: Block, totals: Totals, known: list[dict]) -> Seating:
    """The seats that ``known``, a block's rows of ``exchanged``, tell."""
    known = sorted(known, key=lambda r: r["part"])
    tables, root_tables = unpacked(
        known[0]["blob"], (np.uint32, len(block.train)), (np.uint32, len(block.types_of)))
    sums = [unpacked(r["blob"], (U, r["n"]), (U, r["n"])) for r in known[1:]]
    customers, others = (np.concatenate(x).astype(float) for x in zip(*sums))
    return Seating(block, totals, tables.astype(float), root_tables.astype(float), customers, others)


#: Rows of a sweep. Part -1 holds a block's seats and ``sums``; the others tables by restaurant.
SWEPT = "part int, at long, n int, blob binary, sums array<double>"


def handed_on(seating: Seating, keys: np.ndarray, parts: int) -> pa.RecordBatch:
    """The rows of a block's sweep: its seats, and customers and tables of each restaurant, by part."""
    block, tables, root = seating.block, seating.tables, seating.root
    of_word = seating.of_words((block.train > 0).astype(float))
    sums = [block.train.sum(), (of_word > 0).sum(), (block.train == 1).sum(), (block.train == 2).sum(),
            (of_word == 1).sum(), (of_word == 2).sum(), root.sum(), seating.root_tables.sum()]
    customers = np.bincount(block.context, block.train, minlength=len(keys)).astype(U)
    met = np.bincount(block.context, tables, minlength=len(keys)).astype(U)
    rows = [(-1, None, packed(tables.astype(np.uint32), seating.root_tables.astype(np.uint32)),
             [float(x) for x in sums])]
    shift = U(CONTEXT_BITS - parts.bit_length() + 1)
    edge = np.searchsorted(keys >> shift, np.arange(parts + 1, dtype=U)).tolist()
    for part, (a, b) in enumerate(zip(edge, edge[1:])):
        if a < b:
            rows.append((part, b - a, packed(keys[a:b], customers[a:b], met[a:b]), None))
    part, n, blob, sums = zip(*rows)
    return pa.RecordBatch.from_pydict({
        "part": pa.array(part, pa.int32()), "at": pa.array([block.number] * len(rows), pa.int64()),
        "n": pa.array(n, pa.int32()), "blob": pa.array(blob, pa.binary()),
        "sums": pa.array(sums, pa.list_(pa.float64()))})


def exchanged(rows: DataFrame, parts: int) -> DataFrame:
    """``rows`` of a sweep, where a restaurant's numbers are the sums over all blocks that have it.

    They come back in the order in which the block gave its restaurants.
    """
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] < 0:
                    yield answers([row])
                    continue
                if held and held[-1][0] != row[0]:
                    yield answers(summed(held))
                    held = []
                held.append(row)
        if held:
            yield answers(summed(held))

    def summed(held: list[tuple]) -> list[tuple]:
        found = [unpacked(blob, (U, n), (U, n), (U, n)) for _, _, n, blob, _ in held]
        keys, customers, tables = (np.concatenate(x) for x in zip(*found))
        _, of = np.unique(keys, return_inverse=True)
        customers, tables = (np.bincount(of, x).astype(U)[of] for x in (customers, tables))
        ends = np.cumsum([n for _, _, n, _, _ in held])
        return [(part, at, n, packed(customers[end - n:end], tables[end - n:end]), None)
                for (part, at, n, _, _), end in zip(held, ends.tolist())]

    def answers(found: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.float64())]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*found), kinds)], names=["part", "at", "n", "blob", "sums"])

    # Seats go through as they are, and are spread.
    seats = F.when(F.col("part") < 0, F.col("at"))
    return rows.repartition(parts, "part", seats).sortWithinPartitions("part", "at").mapInArrow(add, SWEPT)


def by_block(sweeps: list[DataFrame], blocks: int) -> DataFrame:
    """(at, known): of each block the rows of ``sweeps``, with the number of their sweep."""
    rows = [s.select("at", F.struct(F.lit(i).alias("sweep"), "part", "n", "blob").alias("r"))
            for i, s in enumerate(sweeps)]
    union = rows[0]
    for r in rows[1:]:
        union = union.unionByName(r)
    return union.repartition(blocks, "at").groupBy("at").agg(F.collect_list("r").alias("known"))


def corpus_totals(sweep: DataFrame) -> Totals:
    sums = sweep.where("part < 0").agg(*[F.sum(F.col("sums")[i]) for i in range(8)]).first()
    n, v, one, two, root_one, root_two, customers, tables = (x or 0.0 for x in sums)

    def discount(once: float, twice: float) -> float:
        return float(np.clip((once + 1) / (once + 2 * twice + 2), 0.05, 0.95))

    return Totals(n, v, (discount(one, two), discount(root_one, root_two)), customers, tables)


def fit(words: DataFrame, blocks: int, seed: int) -> tuple[list[DataFrame], list[Totals]]:
    """The seats and sums of the sweeps that are samples, and the totals of each."""
    parts = max(8, 1 << (-(-blocks // PART_BLOCKS) - 1).bit_length())
    read = words.select("at", "sizes", "types", "keys")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, sizes, types, keys in zip(*(c.to_pylist() for c in batch.columns)):
                yield handed_on(Seating(read_block(at, sizes, types)), unpacked(keys, (U, sizes[3]))[0], parts)

    def sweep_with(totals: Totals, number: int):
        def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at, sizes, types, keys, known in zip(*(c.to_pylist() for c in batch.columns)):
                    seating = seated(read_block(at, sizes, types), totals, known)
                    seating = seating.swept(np.random.default_rng([seed, at, number]))
                    yield handed_on(seating, unpacked(keys, (U, sizes[3]))[0], parts)

        return sweep

    sweeps, totals, paths = [], [], []
    for number in range(BURN_IN + SAMPLES + 1):
        rows = read.mapInArrow(count, SWEPT) if not number else read.join(
            by_block(sweeps[-1:], blocks), "at").mapInArrow(sweep_with(totals[-1], number), SWEPT)
        with recorded() as made:
            sweeps.append(durable(exchanged(rows, parts)))
        del rows
        # The sweep before has been read, unless it is a sample; shuffles behind it go too.
        remove_tables(words.sparkSession, paths[-1:] if number <= BURN_IN + 1 else [])
        paths += made
        totals.append(corpus_totals(sweeps[-1]))
    return sweeps[-SAMPLES:], totals[-SAMPLES:]


def score_block(block: Block, tokens_of: np.ndarray, place: np.ndarray, samples: list[Seating]) -> tuple[np.ndarray, ...]:
    """(place, known tokens, base score, log10 probability) of every document in the block."""
    totals = samples[0].totals
    p = sum(s.predictive() for s in samples) / len(samples)
    of_word = samples[0].of_words(block.train)
    word_of = samples[0].word_of
    base = np.log10((of_word + 0.5) / (totals.n + 0.5 * (totals.v + 1)))[word_of]
    known = (of_word > 0).astype(float)[word_of]
    type_of = np.repeat(np.arange(len(p)), tokens_of)
    order = np.argsort(place, kind="stable")
    place, type_of = place[order], type_of[order]
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    known, base, p = (np.add.reduceat(x[type_of], first) for x in (known, base, np.log10(p)))
    return place[first], known.astype(np.uint32), base, p


#: What a block found for documents of a slice: their numbers, known tokens and both scores.
FOUND = (np.uint16, np.uint32, np.float64, np.float64)


def score_texts(
    docs: DataFrame, held_out: Column, text: str = "text", key: str = "doc_id", seed: int = 1
) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) per row.

    The model learns from the rows that are not ``held_out`` and scores all. Tokens are words,
    A-Z in lower case, and one end; a null text is empty and has its end alone. ``score`` is the
    model's log10 probability, averaged over the samples token by token; ``base_score`` that of the
    smoothed word frequencies. Without training rows the model is uniform. Repeated rows are
    texts of their own. No rows give none.
    """
    data = F.coalesce(F.encode(text, "UTF-8"), F.lit(b""))
    read = docs.select(F.col(key).cast("long").alias("k"), held_out.alias("h"), data.alias("d"))
    size = read.agg(F.sum(F.length("d"))).first()[0] or 0
    blocks = max(8, -(-int(size) // BLOCK_BYTES))
    gathered = durable_buckets(gathered_blocks(dealt_tokens(read, blocks), blocks), "at", blocks)
    remove_tables(docs.sparkSession, [])  # no table, but the shuffle behind the blocks
    words = gathered.where("ids is null")
    sweeps, totals = fit(words, blocks, seed)
    train_tokens = int(totals[-1].n)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, slices, docs, sizes, types, places, known in zip(*(c.to_pylist() for c in batch.columns)):
                block = read_block(at, sizes, types)
                tokens_of, place = unpacked(places, (np.uint32, sizes[1]), (np.uint32, sizes[2]))
                place, *found = score_block(block, tokens_of, place, [
                    seated(block, t, [r for r in known if r["sweep"] == i]) for i, t in enumerate(totals)])
                edges = np.cumsum([0, *docs])
                cuts = np.searchsorted(place, edges).tolist()
                blobs = [packed((place[a:b] - edge).astype(np.uint16), *(x[a:b] for x in found))
                         for edge, a, b in zip(edges, cuts, cuts[1:])]
                yield pa.RecordBatch.from_pydict({
                    "slice": pa.array(slices, pa.int64()),
                    "n": pa.array([b - a for a, b in zip(cuts, cuts[1:])], pa.int32()),
                    "blob": pa.array(blobs, pa.binary())})

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come by slice, its own first.
        ids, train, counts, x = None, None, None, None
        for batch in batches:
            for _, n, blob, own in zip(*(c.to_pylist() for c in batch.columns)):
                if own is None:
                    doc, *found = unpacked(blob, *((kind, n) for kind in FOUND))
                    for total, part in zip(x, found):
                        total[doc] += part
                    continue
                if ids is not None:
                    yield slice_rows(ids, train, counts, x)
                ids, x = own, np.zeros((3, len(own)))
                train, counts = unpacked(blob, (bool, n), (np.int64, n))
        if ids is not None:
            yield slice_rows(ids, train, counts, x)

    def slice_rows(ids: list, train: np.ndarray, counts: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            key: pa.array(ids, pa.int64()), "held_out": pa.array(~train),
            "n_tokens": pa.array(counts), "n_known": pa.array(x[0].round().astype(np.int64)),
            "train_tokens": pa.array([train_tokens] * len(ids), pa.int64()),
            "base_score": pa.array(x[1]), "score": pa.array(x[2])})

    parts = words.select("at", "slices", "docs", "sizes", "types", "places").join(
        by_block(sweeps, blocks), "at").mapInArrow(score, "slice long, n int, blob binary").withColumn(
        "ids", F.lit(None).cast("array<long>"))
    own = gathered.where("ids is not null").select(
        F.col("at").alias("slice"), F.col("docs")[0].cast("int").alias("n"), F.col("places").alias("blob"), "ids")
    schema = (f"{key} long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
              "base_score double, score double")
    by_slice = parts.unionByName(own).withColumn("rest", F.col("ids").isNull()).repartition("slice")
    return by_slice.sortWithinPartitions("slice", "rest").drop("rest").mapInArrow(finish, schema)
