"""Near duplicates by SimHash, found through an inverted index of byte positions.

A 64-bit fingerprint is eight bytes at eight positions. Fingerprints that differ in at most
``BITS`` bits differ in at most as many bytes, so they share at least 8 - ``BITS`` positional
bytes: the count a pair has to reach. Distinct fingerprints are indexed only once, however
many texts have them.

The lists of single bytes would hold 1/256 of all fingerprints each. A pair that shares five
of eight bytes shares three in one half of the positions, so the lists are intersected
in threes first: eight lists a fingerprint, one for each three positions of a half. A list that is long still is
split by two more positions, which such a pair shares too. In a list, members are
compared in blocks: the shared positional bytes of each pair are tallied, pairs below the
minimum are dropped, and the bits of the rest are counted. Only links that join what is
still apart leave a task, so rows grow with lists and not with pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterlens.llm.minhash import connected
from meterlens.storage import durable

WORDS, SEED, BITS = 3, 42, 3
#: Positional bytes that two linked fingerprints share at least.
SHARED = 8 - BITS
HALVES = ((0, 1, 2, 3), (4, 5, 6, 7))
#: Three positions of a half: one of these lists holds both members of any linked pair.
TRIPLES = tuple(t for half in HALVES for t in combinations(half, 3))
#: Members above which a list is split, members of a block, and shingles hashed at a time.
LONG, BLOCK, CHUNK = 2048, 1024, 1 << 16
#: A fingerprint is hot if more than one row in this many has it: at most so many are.
HOT_SHARE = 1000

BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
ONES = BYTE_BITS.sum(axis=1).astype(np.uint8)


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """64 majority bits of the hashes of all ``words``-word shingles; A-Z are lower-cased."""
    joined = b" ".join(text.lower().split())
    if not joined:
        return 0
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(spaces + 1).tolist()]
    ends = [*spaces.tolist(), len(joined)][min(words, len(starts)) - 1:]
    ones = np.zeros((8, 8), np.int64)
    hash64 = xxhash.xxh64_intdigest
    for at in range(0, len(ends), CHUNK):
        hashes = np.fromiter(
            (hash64(joined[a:b], SEED) for a, b in zip(starts[at:at + CHUNK], ends[at:at + CHUNK])), np.uint64)
        planes = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
        for position in range(8):
            ones[position] += np.bincount(planes[:, position], minlength=256) @ BYTE_BITS
    bits = (2 * ones > len(ends)).astype(np.uint8)
    return int.from_bytes(np.packbits(bits, axis=1).tobytes(), "big")


def fingerprints(docs: DataFrame, key: str, text: str, words: int = WORDS) -> DataFrame:
    """(id, print) per row: the fingerprint as a signed 64-bit number."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t or b"", words) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], names=["id", "print"])

    named = docs.select(F.col(key).alias("id"), F.encode(text, "UTF-8").alias("data"))
    schema = StructType([named.schema["id"], *StructType.fromDDL("print long").fields])
    return named.mapInArrow(read, schema)


def byte_at(position: int) -> Column:
    return F.shiftrightunsigned("print", 56 - 8 * position).bitwiseAND(F.lit(255))


def list_key(positions: tuple[int, ...]) -> Column:
    """The list of ``positions`` that a fingerprint is in: which positions, and their bytes."""
    mask = sum(0xFF << (56 - 8 * p) for p in positions)
    signed = mask - (1 << 64) if mask >> 63 else mask
    return F.struct(F.lit(sum(1 << p for p in positions)).alias("positions"),
                    F.col("print").bitwiseAND(F.lit(signed)).alias("bytes"))


def posting_lists(prints: DataFrame, long: int = LONG) -> DataFrame:
    """(positions, bytes, print, n): lists of two or more in which every linked pair meets.

    ``positions`` is a bit set. Lists of more than ``long`` members are split once by
    every two of their other positions.
    """
    def sized(lists: DataFrame) -> DataFrame:
        sizes = lists.groupBy("positions", "bytes").agg(F.count("*").alias("n")).where("n > 1")
        return lists.join(sizes, ["positions", "bytes"])

    triples = durable(sized(prints.select("print", F.explode(F.array(
        *[list_key(t) for t in TRIPLES])).alias("list")).select("print", "list.*")))
    finer = F.lit(None)
    for t in TRIPLES:
        others = [p for p in range(8) if p not in t]
        split = F.array(*[list_key(t + pair) for pair in combinations(others, SHARED - 3)])
        finer = F.when(F.col("positions") == sum(1 << p for p in t), split).otherwise(finer)
    fine = triples.where(F.col("n") > long).select("print", F.explode(finer).alias("list")).select(
        "print", "list.*").distinct()
    return triples.where(F.col("n") <= long).unionByName(sized(fine))


def linked_rows(prints: np.ndarray, group: np.ndarray, own: np.ndarray, across: np.ndarray,
                bits: int = BITS) -> list[tuple[int, int]]:
    """Links between rows of equal ``group`` (ascending) that join what is apart.

    Every pair of a group has the positional bytes it shares tallied; where they reach the minimum
    its bits are counted. In a group that stands for two different blocks (``across``) only pairs between
    the blocks count. Pairs are looked at by distance in the group, all groups at once.
    """
    n, parent, out = len(prints), np.arange(len(prints)), []
    ends = np.searchsorted(group, group, side="right")
    # Rows whose group reaches on to the row at this distance.
    rows, distance = np.arange(n), 1
    while True:
        rows = rows[rows + distance < ends[rows]]
        if not len(rows):
            return out
        look = rows[~across[rows] | (own[rows] != own[rows + distance])]
        look = look[parent[look] != parent[look + distance]]
        differing = (prints[look] ^ prints[look + distance]).view(np.uint8).reshape(-1, 8)
        enough = (differing == 0).sum(axis=1) >= 8 - bits
        close = ONES[differing[enough]].sum(axis=1) <= bits
        for i in look[enough][close].tolist():
            a, b = i, i + distance
            while parent[a] != a:
                a = parent[a]
            while parent[b] != b:
                b = parent[b]
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((int(prints[i].view(np.int64)), int(prints[i + distance].view(np.int64))))
        while close.any():  # every row's root, for the pairs to come
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
        distance += 1


def links(lists: DataFrame, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """(a, b): verified links between fingerprints that connect whatever is linked in ``lists``.

    Every two blocks of a list are a group of their own; no group grows with its list. Groups are
    mostly small, so a task reads them in order and compares many at a time.
    """
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("print"), blocks).cast("int")
    group = ["positions", "bytes", "low", "high"]
    cells = lists.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1))
    ).select("positions", "bytes", F.least("own", "other").alias("low"),
             F.greatest("own", "other").alias("high"), "own", "print")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(columns: list[np.ndarray]) -> pa.RecordBatch:
            positions, places, low, high, own, prints = columns
            starts = np.ones(len(prints), bool)
            starts[1:] = np.any([c[1:] != c[:-1] for c in columns[:4]], axis=0)
            pairs = linked_rows(prints.view(np.uint64), np.cumsum(starts), own, low != high, bits)
            a, b = zip(*pairs) if pairs else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        held = None
        for batch in batches:
            columns = [np.array(c.to_numpy(zero_copy_only=False)) for c in batch.columns]
            if held is not None:
                columns = [np.concatenate(c) for c in zip(held, columns)]
            # The last group may go on in the next batch.
            same = np.all([c == c[-1] for c in columns[:4]], axis=0)
            cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            held = [c[cut:] for c in columns]
            if cut:
                yield found([c[:cut] for c in columns])
        if held is not None and len(held[0]):
            yield found(held)

    ordered = cells.repartition(*group).sortWithinPartitions(*group, "own", "print")
    return ordered.mapInArrow(compare, "a long, b long")


def simhash_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS
) -> DataFrame:
    """(key, fingerprint, component_id) per row.

    Fingerprints (16 hex digits) link at ``BITS`` or fewer differing bits; ``component_id`` is the
    least id reachable. A null, empty or blank text has fingerprint zero and is linked like
    any other; very long texts count whole. Rows that repeat an id link through each of their
    texts. A null id stands for no document: it lends its fingerprint to its group and gets the group's
    component, null if no row of the group has an id. No rows give none.
    """
    read = durable(fingerprints(docs, key, text, words))
    # A repeated id joins its fingerprints, whatever their bits.
    classes = durable(read.groupBy("print").agg(F.min("id").alias("least"), F.count("*").alias("n")))
    several = read.where("id is not null").distinct().groupBy("id").agg(
        F.min("print").alias("a"), F.max("print").alias("b"), F.count("*").alias("n")).where("n > 1")
    middle = read.distinct().join(several.select("id", "a"), "id").where("a <> print").select(
        "a", F.col("print").alias("b"))
    edges = links(posting_lists(classes.select("print"))).unionByName(middle)
    components = connected(edges)
    labelled = classes.join(components, classes.print == components.node, "left").select(
        "print", "least", "n", F.coalesce("component", "print").alias("component"))
    least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    named = durable(labelled.join(least, "component").select("print", "component_id", "n"))
    # Fingerprints of more than a 1000th of the rows are fewer than 1000: they are broadcast.
    rows = read.count()
    hot = named.where(F.col("n") * HOT_SHARE > rows).select("print", "component_id")
    usual = named.where(F.col("n") * HOT_SHARE <= rows).select("print", "component_id")
    by_hot = read.join(F.broadcast(hot), "print")
    by_usual = read.join(F.broadcast(hot), "print", "left_anti").join(usual, "print")
    return by_hot.unionByName(by_usual).select(
        F.col("id").alias(key), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
