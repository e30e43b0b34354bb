"""Removal of repeated byte strings by block-wise suffix sorting with a difference cover.

Which bytes are covered by a 50-byte string that an earlier document has is a question about
neighbours in the order of the suffixes, taken to 50 bytes. Suffixes are sorted a bucket at a time.

1. Buckets. Of every 50-byte window the 16-byte gram of least hash names the bucket, so equal
   windows share one. Consecutive windows with one such gram make a run, whose bytes are its
   context. A run whose whole context an earlier document has goes at once, and a bucket with one
   context needs no sorting.
2. Each bucket that is left gets one run per distinct context, of the earliest document, as
   bytes. The positions of a difference cover modulo 3 are ranked by doubling; then
   suffixes are sorted by at most two bytes, the rank of the cover position behind them, and the bytes left to
   50. So ties, however long, are settled by the ranks, and no suffix is ever copied: memory is a
   few numbers a byte. In every run of equal suffixes the later documents' windows go.

So what moves is 24 bytes a run, and bytes only around places where repeats begin or end. Sending
all suffixes, one for each byte, would take some twenty times the text's size in shuffles.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterlens.llm.arrow_words import slices
from meterlens.llm.shingles import BYTE_VALUES, U, mix64, powers
from meterlens.storage import durable, recorded, remove_tables

LENGTH = 50
GRAM = 16
#: Bytes whose ranks are computed at the positions of the difference cover.
COVER = 48
#: Window starts whose suffixes are sorted at a time.
BUCKET_ROWS = 1 << 17
#: Bytes of compressed text that a task looks at, or finishes, at a time.
LOOK_BYTES = 1 << 20
#: Text whose samples one partition takes, about 24 bytes for every 18 of text.
PARTITION_BYTES = 64 << 20


def runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, sample, context) of each run; window starts ``start`` to ``end`` - 1.

    ``sample`` is the hash of the windows' sampled gram, ``context`` that of all their bytes.
    """
    n = len(data) - LENGTH + 1
    if n < 1:
        none = np.empty(0, np.int64)
        return none, none, none.astype(U), none.astype(U)
    terms = BYTE_VALUES[data]
    terms *= powers(len(data))
    sums = np.zeros(len(data) + 1, U)
    np.cumsum(terms, out=sums[1:])
    inverse = powers(len(data), True)
    h = mix64((sums[GRAM:] - sums[:-GRAM]) * inverse[: len(data) - GRAM + 1])
    least, width, wanted = h, 1, LENGTH - GRAM + 1
    while width * 2 <= wanted:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if wanted > width:
        least = np.minimum(least[: len(least) - (wanted - width)], least[wanted - width:])
    start = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
    end = np.append(start[1:], n)
    stop = end + LENGTH - 1
    context = mix64((sums[stop] - sums[start]) * inverse[start] + (stop - start).astype(U))
    return start, end, least[start], context


def sample_rows(docs: DataFrame, key: str, data: str) -> DataFrame:
    """(sample, context, doc): the distinct runs of each document."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 1)):
            samples, contexts, numbers = [], [], []
            for k, d in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                _, _, s, c = runs(np.frombuffer(d, np.uint8))
                samples.append(s)
                contexts.append(c)
                numbers.append(np.full(len(s), k, np.int64))
            if not samples:
                continue
            s, c, n = map(np.concatenate, (samples, contexts, numbers))
            # A document's own repeats count once.
            order = np.lexsort((c, n))
            s, c, n = s[order], c[order], n[order]
            keep = np.ones(len(s), bool)
            keep[1:] = (n[1:] != n[:-1]) | (c[1:] != c[:-1]) | (s[1:] != s[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(s[keep].view(np.int64)), pa.array(c[keep].view(np.int64)), pa.array(n[keep])],
                names=["sample", "context", "doc"])

    return docs.select(key, data).mapInArrow(read, "sample long, context long, doc long")


def classify(rows: DataFrame, partitions: int) -> DataFrame:
    """(doc, pair, gone) of the runs that are not alone.

    ``pair`` is the hash of sample and context. ``gone`` is true where an earlier document has
    the pair, false for the earliest document of a pair whose sample has several contexts: its
    suffixes have to be sorted. A task holds its partition as numbers, 24 bytes a row.
    """
    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[c.to_numpy() for c in batch.columns] for batch in batches]
        if not parts:
            return
        s, c, n = (np.concatenate(x) for x in zip(*parts))
        del parts
        order = np.lexsort((n, c, s))
        s, c, n = s[order], c[order], n[order]
        new_sample = np.ones(len(s), bool)
        new_sample[1:] = s[1:] != s[:-1]
        new_pair = new_sample.copy()
        new_pair[1:] |= c[1:] != c[:-1]
        pair_at, sample_at = np.flatnonzero(new_pair), np.flatnonzero(new_sample)
        pair_of, sample_of = np.cumsum(new_pair) - 1, np.cumsum(new_sample) - 1
        gone = n > n[pair_at][pair_of]
        # Several contexts, and not all of them of one document.
        several = np.add.reduceat(new_pair.astype(np.int64), sample_at) > 1
        several &= np.minimum.reduceat(n, sample_at) < np.maximum.reduceat(n, sample_at)
        sort = ~gone & several[sample_of]
        keep = np.flatnonzero(gone | sort)
        yield pa.RecordBatch.from_arrays(
            [pa.array(n[keep]), pa.array(pair_hash(s[keep].view(U), c[keep].view(U)).view(np.int64)),
             pa.array(gone[keep])], names=["doc", "pair", "gone"])

    return rows.repartition(partitions, "sample").mapInArrow(
        reduce, "doc long, pair long, gone boolean")


def pair_hash(sample: np.ndarray, context: np.ndarray) -> np.ndarray:
    return mix64(sample * U(3) ^ context)


def ranks(keys: np.ndarray) -> np.ndarray:
    """The place of each key among the distinct ones, in their order."""
    order = np.argsort(keys)
    new = np.ones(len(keys), np.int64)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    out = np.empty(len(keys), U)
    out[order] = np.cumsum(new) - 1
    return out


def cover_ranks(text: np.ndarray) -> np.ndarray:
    """Ranks of the ``COVER`` bytes from each sample position of ``text``, by doubling.

    Sample positions are those of the difference cover {1, 2} modulo 3: for any two
    positions there is a step of 0, 1 or 2 after which both are in the sample. Their first six bytes are a
    number; ranks of twice the length come from two ranks, six, twelve and 24 bytes apart, which
    are positions of the sample again. Entries of other positions, and near the end, are 0.
    """
    n = len(text)
    out = np.zeros(n, U)
    places = np.arange(n - COVER + 1)
    places = places[places % 3 != 0]
    # All sample positions that a doubling step looks at.
    seen = np.arange(n - 5)
    seen = seen[seen % 3 != 0]
    first = np.zeros(len(seen), U)
    for i in range(6):
        first = first << U(8) | text[seen + i]
    rank = np.zeros(n + COVER, U)
    rank[seen] = ranks(first)
    for width in (6, 12, 24):
        reach = seen[seen <= n - 2 * width]
        rank[reach] = ranks(rank[reach] << U(32) | rank[reach + width])
        seen = reach
    out[places] = rank[places]
    return out


def sorted_repeats(text: np.ndarray, starts: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Which windows of ``LENGTH`` bytes, at ``starts`` in ``text``, an earlier document has too.

    Windows are sorted by the bytes before the next sample position that both sides of a
    comparison have, the rank of the ``COVER`` bytes there, and the bytes left: no more than
    that is compared, however long equal stretches are. Each of the three steps brings two of
    the three residues together.
    """
    rank, least = cover_ranks(text), docs.copy()
    residue = starts % 3
    byte = text.astype(U)
    for step in range(3):
        # Residues that are in the sample after this step.
        some = np.flatnonzero((residue + step) % 3 != 0)
        at = starts[some]
        key = rank[at + step]
        for i in [*range(step), *range(step + COVER, LENGTH)]:
            key = key << U(8) | byte[at + i]
        order = np.argsort(key)
        key, owner = key[order], docs[some[order]]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        lengths = np.diff(np.append(first, len(key)))
        low = np.repeat(np.minimum.reduceat(owner, first), lengths) if len(key) else owner
        least[some[order]] = np.minimum(least[some[order]], low)
    return docs > least


def bucket_repeats(contexts: DataFrame, partitions: int) -> DataFrame:
    """(doc, row, start, end): runs of windows of ``contexts`` (bucket, doc, row, start, bytes) that go.

    Equal windows are in one bucket. Buckets share tasks; a task sorts the suffixes of one
    slice of its buckets at a time, ``BUCKET_ROWS`` or one whole bucket.
    """
    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for b, doc, row, start, data in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= BUCKET_ROWS and held[-1][0] != b:
                    yield repeats(held)
                    held, size = [], 0
                held.append((b, doc, row, start, data))
                size += len(data) - LENGTH + 1
        if held:
            yield repeats(held)

    def repeats(held: list[tuple]) -> pa.RecordBatch:
        text = np.frombuffer(b"".join(h[4] for h in held), np.uint8)
        lengths = np.array([len(h[4]) for h in held])
        sizes = lengths - LENGTH + 1
        # No window reaches from one context into the next.
        offsets = np.cumsum(lengths) - lengths
        within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        doc, own, start = (np.repeat(np.array([h[i] for h in held], np.int64), sizes) for i in (1, 2, 3))
        gone = np.flatnonzero(sorted_repeats(text, np.repeat(offsets, sizes) + within, doc))
        # Neighbouring windows of a row are one run.
        doc, own, at = doc[gone], own[gone], (start + within)[gone]
        new = np.ones(len(gone), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(gone)) - 1
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (doc[first], own[first], at[first], at[last] + 1)] if len(gone) else
            [pa.array([], pa.int64())] * 4, names=["doc", "row", "start", "end"])

    return contexts.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(
        sort, "doc long, row long, start long, end long")


def remove_bytes(data: bytes, starts: list[int], ends: list[int]) -> tuple[int, int, str]:
    """(bytes removed, maximal removed runs, digest of the rest) for runs of windows."""
    spans: list[list[int]] = []
    for start, end in sorted(zip(starts, ends)):
        stop = end + LENGTH - 1
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], stop)
        else:
            spans.append([start, stop])
    kept, done = hashlib.sha256(), 0
    for start, stop in spans:
        kept.update(data[done:start])
        done = stop
    kept.update(data[done:])
    return sum(b - a for a, b in spans), len(spans), kept.hexdigest()


RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
LOOKED = ("doc long, row long, bucket long, start long, bytes binary, starts array<long>, ends array<long>, "
          + RESULT)


def pack(docs: DataFrame, data: str) -> DataFrame:
    """``docs`` with ``data`` compressed, so that texts move in less than half their size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in (part for whole in batches for part in slices(whole, whole.schema.get_field_index(data))):
            at = batch.schema.get_field_index(data)
            columns = list(batch.columns)
            columns[at] = pa.array([squeeze.compress(d) for d in columns[at].to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def look(docs: DataFrame) -> DataFrame:
    """Rows of three kinds from ``docs`` (_key, doc, row, data, pairs, gone).

    A document without runs to sort is finished. One with such runs gives them as contexts
    for the buckets, and waits with its text and what is already known to go.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, squeeze = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        for batch in (part for whole in batches for part in slices(whole, 3, LOOK_BYTES)):
            out: list[tuple] = []
            for k, doc, row, packed, pairs, gone in zip(*(c.to_pylist() for c in batch.columns)):
                data = unpack.decompress(packed)
                if not pairs:
                    out.append((k, doc, row, None, None, None, None, None, len(data), *remove_bytes(data, [], [])))
                    continue
                view = np.frombuffer(data, np.uint8)
                start, end, sample, context = runs(view)
                pair = pair_hash(sample, context).view(np.int64)
                gone = np.array(gone)
                pairs = np.array(pairs)
                away = np.isin(pair, pairs[gone])
                sort = np.flatnonzero(np.isin(pair, pairs[~gone]) & ~away)
                starts, ends = start[away].tolist(), end[away].tolist()
                if not len(sort):
                    out.append((k, doc, row, None, None, None, None, None, len(data), *remove_bytes(data, starts, ends)))
                    continue
                out.append((k, doc, row, None, None, squeeze.compress(data), starts, ends, None, None, None, None))
                buckets = sample[sort].view(np.int64).tolist()
                for b, i in zip(buckets, sort):
                    out.append((None, doc, row, b, int(start[i]), data[start[i]:end[i] + LENGTH - 1],
                                None, None, None, None, None, None))
            columns = list(zip(*out)) if out else [[]] * len(schema.names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [batch.schema.types[0], *kinds])],
                names=schema.names)

    longs = pa.list_(pa.int64())
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), longs, longs,
             pa.int64(), pa.int64(), pa.int64(), pa.string()]
    schema = StructType(docs.select("_key").schema.fields + StructType.fromDDL(LOOKED).fields)
    return docs.select("_key", "doc", "row", "data", "pairs", "gone").mapInArrow(run, schema)


def finish(waiting: DataFrame) -> DataFrame:
    """The result of ``waiting`` (_key, bytes, starts, ends, late_starts, late_ends)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in (part for whole in batches for part in slices(whole, 1, LOOK_BYTES)):
            out = []
            for _, packed, starts, ends, more, more_ends in zip(*(c.to_pylist() for c in batch.columns)):
                data = unpack.decompress(packed)
                out.append((len(data), *remove_bytes(
                    data, starts + (more or []), ends + (more_ends or []))))
            columns = list(zip(*out)) if out else [[]] * 4
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds))], names=schema.names)

    schema = StructType(waiting.select("_key").schema.fields + StructType.fromDDL(RESULT).fields)
    return waiting.select("_key", "bytes", "starts", "ends", "late_starts", "late_ends").mapInArrow(
        run, schema)


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256) per row.

    A byte goes if a 50-byte string over it also starts in a document with a smaller key,
    judged on the texts as they are. Null texts are empty, texts below 50 bytes stay. Rows
    that repeat a key are one document: none removes from the other. A row with a null
    key loses and removes nothing. Very long texts are judged whole; other columns are not read.
    No rows give none.
    """
    data = F.coalesce(F.encode(text, "UTF-8"), F.lit(b""))
    size = docs.agg(F.sum(F.length(data))).first()[0] or 0
    partitions = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                     -(-int(size) // PARTITION_BYTES))
    read = docs.select(F.col(key).alias("_key"), F.col(key).cast("long").alias("doc"),
                       F.xxhash64(key, text).alias("row"), data.alias("data"))
    with recorded() as made:
        found = durable(classify(sample_rows(read.where("doc is not null"), "doc", "data"), partitions))
    remove_tables(docs.sparkSession, [])
    marks = found.groupBy("doc").agg(F.collect_list(F.struct("pair", "gone")).alias("m")).select(
        "doc", F.col("m.pair").alias("pairs"), F.col("m.gone").alias("gone"))
    looked = durable(look(pack(read, "data").join(marks, "doc", "left")))
    remove_tables(docs.sparkSession, made)
    late = bucket_repeats(
        looked.where("bucket is not null").select("bucket", "doc", "row", "start", "bytes"),
        partitions)
    late = durable(late).groupBy("doc", "row").agg(F.collect_list(F.struct("start", "end")).alias("r")).select(
        "doc", "row", F.col("r.start").alias("late_starts"), F.col("r.end").alias("late_ends"))
    waiting = looked.where("bucket is null and n_bytes is null").join(late, ["doc", "row"], "left")
    columns = ["_key", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    done = looked.where("n_bytes is not null").select(*columns)
    return done.unionByName(finish(waiting)).withColumnRenamed("_key", key)
