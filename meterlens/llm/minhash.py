"""Near duplicates by one-permutation MinHash, banded buckets and star-shaped edges.

Every text's set of word shingles is hashed once; the top bits of a hash choose its bin, and
the least hash of each bin is the signature. Empty bins copy a filled bin found by a hash
sequence that depends only on the bin (optimal densification), so two sets still agree in a
bin with the chance of their similarity. Bands of bins are bucket keys.

Texts with equal sets are one class. Within a bucket of classes no pairs are emitted:
every class is compared with a hub, the member with the most company in all its buckets,
by exact intersection of the full sets. Where the classes of a bucket are still in several
components, blocks of the bucket are compared inside tasks, and only links that join
components come out. So no candidate is given up, rows grow with the buckets and not with
their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterlens.llm.arrow_words import slices
from meterlens.llm.shingles import U, mix64, shingle_set
from meterlens.llm.workers import lean
from meterlens.storage import durable, recorded, remove_tables

WORDS = 5
SIMILARITY = 75
BINS = 128
#: 32 bands of 4 bins miss a pair of similarity 0.75 with a chance of 5e-6.
ROWS = 4
#: Members of a bucket in one block, and rows of a block compared at a time.
BLOCK, CHUNK = 1024, 32
#: Sets of ``BINS`` hashes or more agree in fewer bins than this share with a chance of about
#: 2e-5 if they are alike.
CLEARLY_LESS = 0.55


def _probes(bins: int, columns: int) -> np.ndarray:
    """For each bin, the bins it looks at in turn when it is empty."""
    grid = np.arange(bins, dtype=U)[:, None] * U(1 << 20) + np.arange(columns, dtype=U)[None, :]
    return (mix64(grid + U(0x51)) % U(bins)).astype(np.int64)


def signature(hashes: np.ndarray, bins: int = BINS) -> np.ndarray:
    """One-permutation signature of a sorted, not empty set of hashes."""
    shift = U(64 - bins.bit_length() + 1)
    bin_of = (hashes >> shift).astype(np.int64)
    filled, first = np.unique(bin_of, return_index=True)
    out = np.zeros(bins, U)
    out[filled] = hashes[first]
    full = np.zeros(bins, bool)
    full[filled] = True
    empty = np.flatnonzero(~full)
    done, columns = 0, 64
    while len(empty):
        table = _PROBES[:, done:done + columns] if done + columns <= _PROBES.shape[1] else None
        if table is None:  # hardly ever: longer sequences than the table holds
            table = _probes(bins, done + columns)[:, done:]
        hit = full[table[empty]]
        found = hit.any(axis=1)
        out[empty[found]] = out[table[empty[found], hit[found].argmax(axis=1)]]
        empty = empty[~found]
        done += columns
    return out


_PROBES = _probes(BINS, 2048)


def band_keys(hashes: np.ndarray, bins: int = BINS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band."""
    bands = signature(hashes, bins).reshape(-1, rows)
    h = np.arange(1, len(bands) + 1, dtype=U)
    for i in range(rows):
        h = mix64(h * U(0x9E3779B97F4A7C15) + bands[:, i])
    return h


def shingled(docs: DataFrame, key: str, text: str, words: int = WORDS) -> DataFrame:
    """(key, n_shingles, set_id, bands): ``set_id`` is a 128-bit digest of the set.

    Texts without words have no set: size 0, null digest and bands.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 1)):
            sizes, digests, bands = [], [], []
            for data in batch.column(1).to_pylist():
                s = shingle_set(np.frombuffer(data or b"", np.uint8), words)
                sizes.append(len(s))
                if not len(s):
                    digests.append(None)
                    bands.append(None)
                    continue
                a = np.bitwise_xor.reduce(mix64(s + U(0x1234567)))
                b = np.add.reduce(mix64(s ^ U(0xABCDEF0123)), dtype=U)
                digests.append(a.tobytes() + b.tobytes())
                bands.append(band_keys(s).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))],
                names=[key, "n_shingles", "set_id", "bands"])

    schema = StructType(docs.select(key).schema.fields + StructType.fromDDL(
        "n_shingles long, set_id binary, bands array<long>").fields)
    return docs.select(key, F.encode(text, "UTF-8")).mapInArrow(lean(read), schema)


def shingle_sets(docs: DataFrame, key: str, text: str, words: int = WORDS) -> DataFrame:
    """(key, hashes): the full sets as sorted arrays of 64-bit hashes in one binary."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 1)):
            sets = [shingle_set(np.frombuffer(d or b"", np.uint8), words).tobytes()
                    for d in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.binary())], names=[key, "hashes"])

    schema = StructType(docs.select(key).schema.fields + StructType.fromDDL("hashes binary").fields)
    return docs.select(key, F.encode(text, "UTF-8")).mapInArrow(lean(read), schema)


def similar(pairs: DataFrame, percent: int = SIMILARITY) -> DataFrame:
    """(a, b) of the pairs whose full sets, ``a_set`` and ``b_set``, are alike enough."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 2)):
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, U), np.frombuffer(y, U)
                common = np.intersect1d(x, y, assume_unique=True).size
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    # Sets whose sizes differ too much can't be alike.
    small, large = F.least(F.length("a_set"), F.length("b_set")), F.greatest(
        F.length("a_set"), F.length("b_set"))
    alike = pairs.where(100 * small >= percent * large)
    return alike.select("a", "b", "a_set", "b_set").mapInArrow(lean(compare), "a long, b long")


def connected(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node of ``edges`` (a, b).

    Every round gives a node the least label around it and then that label's own label
    (pointer jumping), and is written to the shared folder.
    """
    both = durable(edges.select("a", "b").unionByName(edges.select(
        F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    labels = durable(both.groupBy(F.col("a").alias("node")).agg(
        F.min("b").alias("m")).select("node", F.least("node", "m").alias("component")))
    while True:
        around = both.join(labels, both.b == labels.node).groupBy("a").agg(
            F.min("component").alias("m"))
        stepped = labels.join(around, labels.node == around.a).select(
            "node", F.col("component").alias("old"), F.least("component", "m").alias("c"))
        own = stepped.select(F.col("node").alias("n2"), F.col("c").alias("c2"))
        labels_next = durable(stepped.join(own, stepped.c == own.n2, "left").select(
            "node", "old", F.coalesce("c2", "c").alias("component")))
        moved = labels_next.where("old <> component").limit(1).count()
        labels = labels_next.drop("old")
        if not moved:
            return labels


def star_pairs(buckets: DataFrame) -> DataFrame:
    """(a, b) between each member of a bucket (bucket, member, company) and its hub.

    The hub is the member with most company in all its buckets, the least id of those; one
    pair a member, however large the bucket.
    """
    hubs = buckets.groupBy("bucket").agg(
        F.max(F.struct("company", (-F.col("member")).alias("minus"))).alias("top")
    ).select("bucket", (-F.col("top.minus")).alias("hub"))
    return buckets.join(hubs, "bucket").where("member <> hub").select(
        F.least("member", "hub").alias("a"), F.greatest("member", "hub").alias("b")).distinct()


def verified(pairs: DataFrame, sets: DataFrame, percent: int = SIMILARITY) -> DataFrame:
    """The (a, b) of ``pairs`` whose full ``sets`` (member, hashes) are alike enough."""
    return similar(pairs.join(
        sets.select(F.col("member").alias("a"), F.col("hashes").alias("a_set")), "a"
    ).join(sets.select(F.col("member").alias("b"), F.col("hashes").alias("b_set")), "b"), percent)


def block_links(
    ids: list[np.ndarray], components: list[np.ndarray], sets: list[list[np.ndarray]],
    band: int, percent: int = SIMILARITY,
) -> list[tuple[int, int]]:
    """Links that join components, between two blocks of a bucket (or within one, given once).

    A pair is looked at in the first band in which its signatures agree, so in one bucket
    only, and only while its components are apart. Signatures rule out what is far from
    alike; the rest is decided by exact intersection.
    """
    same = len(ids) == 1
    left, right = (0, 0) if same else (0, 1)
    signatures = [np.stack([(signature(s) & U(0xFFFF)).astype(np.uint16) for s in block])
                  for block in sets]
    sizes = [np.array([len(s) for s in block]) for block in sets]
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    out = []
    for start in range(0, len(ids[left]), CHUNK):
        rows = slice(start, start + CHUNK)
        equal = signatures[left][rows, None, :] == signatures[right][None, :, :]
        agree = equal.sum(axis=2)
        bands = equal.reshape(*agree.shape, -1, ROWS).all(axis=3)
        a, b = sizes[left][rows, None], sizes[right][None, :]
        small, large = np.minimum(a, b), np.maximum(a, b)
        look = (bands.argmax(axis=2) == band) & bands[:, :, band] & (100 * small >= percent * large)
        look &= (small < BINS) | (agree >= CLEARLY_LESS * BINS)
        look &= components[left][rows, None] != components[right][None, :]
        if same:
            look &= np.arange(start, start + len(agree))[:, None] < np.arange(len(b[0]))[None, :]
        i, j = np.nonzero(look)
        for at in np.argsort(-agree[i, j], kind="stable"):
            p, q = start + i[at], j[at]
            x, y = find(int(components[left][p])), find(int(components[right][q]))
            if x == y:
                continue
            s, t = sets[left][p], sets[right][q]
            common = np.intersect1d(s, t, assume_unique=True).size
            if 100 * common >= percent * (len(s) + len(t) - common):
                parent[max(x, y)] = min(x, y)
                out.append((int(ids[left][p]), int(ids[right][q])))
    return out


def remaining_links(
    buckets: DataFrame, sets: DataFrame, percent: int = SIMILARITY
) -> DataFrame:
    """Links (a, b) between different components inside ``buckets``.

    ``buckets`` has (bucket, band, member, n, component). Buckets are dealt in blocks of at
    most ``BLOCK`` members, and each pair of blocks is a group of its own, so no group grows with its
    bucket and no pair becomes a row.
    """
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("member"), blocks).cast("int")
    # A block meets every block: as the first of the pair or the second.
    cells = buckets.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1))
    ).select("bucket", "band", "member", "component", "own",
             F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    shipped = cells.join(sets, "member")

    def cell(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [g for _, g in rows.groupby("own", sort=True)]
        if rows["low"].iloc[0] != rows["high"].iloc[0] and len(parts) < 2:
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        found = block_links(
            [g["member"].to_numpy() for g in parts], [g["component"].to_numpy() for g in parts],
            [[np.frombuffer(h, U) for h in g["hashes"]] for g in parts],
            int(rows["band"].iloc[0]), percent)
        return pd.DataFrame({"a": [min(p) for p in found], "b": [max(p) for p in found]}, dtype="int64")

    return shipped.groupBy("bucket", "low", "high").applyInPandas(cell, "a long, b long")


def bucket_links(buckets: DataFrame, sets: DataFrame, percent: int = SIMILARITY) -> DataFrame:
    """Verified links (a, b) that connect whatever is alike in ``buckets`` (bucket, band, member, n).

    Stars first; then, in buckets whose members are still in several components, what hubs
    could not show.
    """
    company = buckets.groupBy("member").agg(F.sum("n").alias("company"))
    shared = buckets.join(company, "member")
    sets = durable(sets.join(company.select("member"), "member", "left_semi"))
    stars = durable(verified(star_pairs(shared), sets, percent))
    components = connected(stars)
    labelled = buckets.join(components, buckets.member == components.node, "left").select(
        "bucket", "band", "member", "n", F.coalesce("component", "member").alias("component"))
    several = labelled.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    rest = labelled.join(several.select("bucket"), "bucket", "left_semi")
    return stars.unionByName(durable(remaining_links(rest, sets, percent)))


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS,
    percent: int = SIMILARITY,
) -> DataFrame:
    """(key, n_shingles, component_id, kept) per row.

    Links hold between documents with ``100 * intersection >= percent * union`` of their
    distinct shingles; ``component_id`` is the least id reachable. A null, empty or blank text
    is linked with nothing. Rows that repeat an id are one node: linked with what any of them
    is linked with. A row with a null id is linked with nothing: its component is null and it is kept.
    No rows give none.
    """
    read = durable(shingled(docs, key, text, words))
    with recorded() as made:
        components = linked_components(docs, read, key, text, words, percent)
    # The components are the last table of their making; sets and buckets have been read.
    remove_tables(docs.sparkSession, made[:-1])
    component = F.coalesce(components.component, read[key])
    return read.join(components, read[key] == components.node, "left").select(
        read[key], "n_shingles", component.alias("component_id"),
        F.coalesce(component == read[key], F.lit(True)).alias("kept"))


def linked_components(
    docs: DataFrame, read: DataFrame, key: str, text: str, words: int, percent: int
) -> DataFrame:
    """(node, component) of all ids in groups of two or more; ``read`` is ``shingled(docs)``."""
    with_set = read.where(F.col("set_id").isNotNull() & F.col(key).isNotNull())
    classes = durable(with_set.groupBy("set_id").agg(F.min(key).alias("member")))
    member = with_set.join(classes, "set_id").select(F.col(key).alias("id"), "member")
    # The copy that stands for its class gives the class's bands.
    chosen = with_set.join(
        classes, (with_set.set_id == classes.set_id) & (with_set[key] == classes.member)
    ).select("member", "bands").dropDuplicates(["member", "bands"])
    buckets = chosen.select("member", F.posexplode("bands").alias("band", "bucket")).distinct()
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    buckets = durable(buckets.join(sizes, "bucket"))
    in_buckets = buckets.select("member").distinct()
    texts = docs.join(in_buckets, docs[key] == in_buckets.member, "left_semi")
    sets = shingle_sets(texts, key, text, words).withColumnRenamed(key, "member")
    edges = member.where("id <> member").select(F.col("id").alias("a"), F.col("member").alias("b"))
    return connected(edges.unionByName(bucket_links(buckets, sets, percent)))
