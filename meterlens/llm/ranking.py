"""Ranked search of all documents by integer BM25-like scores.

Documents are read once into a stored forward index of the query terms. Every task turns a
run of documents (a shard) into posting lists and answers all items of a block on it:

* the short lists of an item are summed term at a time into accumulators, which from then on
  are one more list with a known bound per run of documents;
* the accumulators and the long lists are walked document at a time in runs. A run whose
  bounds together stay below the item's threshold is skipped; otherwise documents that are only in
  lists too weak to reach the threshold aren't looked at, and the others look
  up those lists only while they can still reach it.

The threshold is the worst of the item's best documents in all shards the task has seen, so it
rises from shard to shard. A task returns at most the wanted number of documents per item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from meterlens.llm.arrow_words import slices, terms_of
from meterlens.storage import durable

TOP = 50
#: Fixed values of the score: its scale, the saturation of a term's count, and the share in
#: percent of a document's length in it.
SCALE, SATURATION, LENGTH_PERCENT = 1_000_000_000, 20, 50
#: Distinct (item, term) rows answered in one pass over the index.
BLOCK_TERMS = 1 << 18
#: Documents and postings of a shard, documents of a run.
SHARD_DOCS, SHARD_POSTINGS, RUN = 1 << 14, 1 << 21, 1 << 10
#: A list is long if it holds more than this share of its shard's documents.
LONG = 1 / 16
#: Groups in which the tasks' answers to an item are cut before they meet.
SALTS = 64


class Block(NamedTuple):
    """Items of one pass: their numbers, their terms as positions, and the terms' weights."""

    numbers: list[int]
    terms: list[np.ndarray]
    weights: np.ndarray


def item_terms(items: DataFrame, text: str) -> DataFrame:
    """(number, terms) per item row: its distinct terms; ``number`` is the row's own."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                found = terms_of(part.column(1))
                words = [found.dictionary.take(pa.array(np.unique(
                    found.codes[a:b]))).to_pylist() for a, b in zip(found.offsets, found.offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(words, pa.list_(pa.string()))], names=["number", "terms"])

    return items.select("_number", text).mapInArrow(read, "number long, terms array<string>")


def forward_index(docs: DataFrame, key: str, text: str, vocabulary: pa.Array) -> DataFrame:
    """(key, n, terms, counts) per row: length in terms, and the query terms it holds."""
    size = len(vocabulary)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                found = terms_of(part.column(1))
                place = pc.fill_null(pc.index_in(found.dictionary, value_set=vocabulary), -1)
                place = place.to_numpy(zero_copy_only=False).astype(np.int64)
                lengths = np.diff(found.offsets)
                term = place[found.codes]
                doc = np.repeat(np.arange(len(lengths)), lengths)[term >= 0]
                pairs, counts = np.unique(doc * max(1, size) + term[term >= 0], return_counts=True)
                doc, term = np.divmod(pairs, max(1, size))
                ends = pa.array(np.searchsorted(doc, np.arange(part.num_rows + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lengths, pa.int64()),
                     pa.ListArray.from_arrays(ends, pa.array(term, pa.int32())),
                     pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64()))],
                    names=["id", "n", "terms", "counts"])

    schema = StructType([
        docs.select(F.col(key).alias("id")).schema.fields[0],
        *StructType.fromDDL("n long, terms array<int>, counts array<long>").fields])
    return docs.select(F.col(key).alias("id"), F.col(text)).mapInArrow(read, schema)


class Shard:
    """Posting lists of a run of documents, with what each posting adds to a score."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, count: np.ndarray, norm: np.ndarray,
                 weights: np.ndarray):
        order = np.lexsort((doc, term))
        self.docs, term, count = doc[order], term[order], count[order]
        self.size = len(norm)
        self.adds = weights[term] * ((SCALE * count) // (1000 * count + SATURATION * norm[self.docs]))
        self.ends = np.searchsorted(term, np.arange(len(weights) + 1))
        self.edges = np.arange(0, self.size + RUN, RUN)
        # Where each run starts in a long list, and the most it adds within the run.
        self.starts, self.bounds = {}, {}
        for t in np.flatnonzero(np.diff(self.ends) > LONG * self.size):
            a, b = self.ends[t], self.ends[t + 1]
            at = np.searchsorted(self.docs[a:b], self.edges)
            most = np.zeros(len(at) - 1, np.int64)
            filled = np.flatnonzero(np.diff(at))
            most[filled] = np.maximum.reduceat(self.adds[a:b], at[filled])
            self.starts[int(t)], self.bounds[int(t)] = at + a, most

    def accumulate(self, terms: list[int]) -> np.ndarray:
        """Term at a time: what ``terms`` add to every document."""
        total = np.zeros(len(self.edges[1:]) * RUN, np.int64)
        for t in terms:
            a, b = self.ends[t], self.ends[t + 1]
            total[self.docs[a:b]] += self.adds[a:b]
        return total

    def best(self, terms: np.ndarray, threshold: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of at least ``threshold``, which may rise to the ``top``-th found.

        Nothing among the ``top`` best of at least ``threshold`` is missing; ties are kept.
        """
        terms = [int(t) for t in terms if self.ends[t] < self.ends[t + 1]]
        long = [t for t in terms if t in self.bounds]
        total = self.accumulate([t for t in terms if t not in self.bounds])
        runs = total.reshape(-1, RUN)
        if len(total) > top:  # what is still to come adds nothing below 0
            threshold = max(threshold, int(np.partition(total, len(total) - top)[len(total) - top]))
        own = runs.max(axis=1)
        bounds = np.array([self.bounds[t] for t in long]).reshape(len(long), len(own))
        docs, scores = [], []
        for run in np.flatnonzero(own + bounds.sum(axis=0) >= threshold):
            base, partial = run * RUN, runs[run]
            order = np.argsort(bounds[:, run], kind="stable")
            reach = np.cumsum(bounds[order, run])
            weak = int(np.searchsorted(reach, threshold))
            for i in order[weak:]:
                a, b = self.starts[long[i]][run:run + 2]
                partial[self.docs[a:b] - base] += self.adds[a:b]
            found = np.flatnonzero(partial)
            for j in range(weak - 1, -1, -1):
                found = found[partial[found] + reach[j] >= threshold]
                a, b = self.starts[long[order[j]]][run:run + 2]
                inside = self.docs[a:b] - base
                at = np.minimum(np.searchsorted(inside, found), b - a - 1)
                hit = inside[at] == found if b > a else np.zeros(len(found), bool)
                partial[found[hit]] += self.adds[a:b][at[hit]]
            found = found[partial[found] >= threshold]
            docs.append(found + base)
            scores.append(partial[found])
            if sum(map(len, scores)) >= top:
                all_scores = np.concatenate(scores)
                threshold = max(threshold, int(np.partition(all_scores, len(all_scores) - top)[len(all_scores) - top]))
        if not docs:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        docs, scores = np.concatenate(docs), np.concatenate(scores)
        return docs[scores >= threshold], scores[scores >= threshold]


def shards(batches: Iterator[pa.RecordBatch], n_docs: int, n_terms: int, weights: np.ndarray
           ) -> Iterator[tuple[pa.Array, Shard]]:
    """(ids, posting lists) of runs of bounded numbers of documents and postings."""
    rows: list[pa.RecordBatch] = []
    held, postings = 0, 0

    def build() -> tuple[pa.Array, Shard]:
        table = pa.Table.from_batches(rows).combine_chunks()
        lists = table["terms"].combine_chunks()
        norm = 100 - LENGTH_PERCENT + np.array(
            [(LENGTH_PERCENT * n * n_docs) // n_terms for n in table["n"].to_pylist()], np.int64)
        doc = np.repeat(np.arange(table.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        return table["id"].combine_chunks(), Shard(
            doc, pc.list_flatten(lists).to_numpy(zero_copy_only=False),
            pc.list_flatten(table["counts"].combine_chunks()).to_numpy(zero_copy_only=False), norm, weights)

    for batch in batches:
        lengths = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(lengths), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            room = int(np.searchsorted(ends, before + SHARD_POSTINGS - postings, side="right")) - start
            take = min(batch.num_rows - start, SHARD_DOCS - held, max(room, 0 if rows else 1))
            if take:
                rows.append(batch.slice(start, take))
                held += take
                postings += int(ends[start + take - 1] - before)
                start += take
            if start < batch.num_rows:  # the shard is full
                yield build()
                rows, held, postings = [], 0, 0
    if rows:
        yield build()


def best_per_task(index: DataFrame, block: Block, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(number, id, score, salt): the best ``top`` documents of every item in each task."""
    id_type = pa.int64()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best_ids = [None] * len(block.numbers)
        best_scores = [np.empty(0, np.int64)] * len(block.numbers)
        thresholds = [1] * len(block.numbers)
        for ids, shard in shards(batches, n_docs, n_terms, block.weights):
            for i, terms in enumerate(block.terms):
                docs, scores = shard.best(terms, thresholds[i], top)
                if not len(docs):
                    continue
                found = ids.take(pa.array(docs))
                if best_ids[i] is not None:
                    found = pa.concat_arrays([best_ids[i], found])
                    scores = np.concatenate([best_scores[i], scores])
                order = pc.sort_indices(pa.table({"s": scores, "id": found}), [
                    ("s", "descending"), ("id", "ascending")]).to_numpy()[:top]
                best_ids[i], best_scores[i] = found.take(pa.array(order)), scores[order]
                if len(order) == top:
                    thresholds[i] = int(best_scores[i][-1])
        salt = TaskContext.get().partitionId() % SALTS
        for number, ids, scores in zip(block.numbers, best_ids, best_scores):
            if ids is not None:
                n = len(scores)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, number)), ids, pa.array(scores), pa.array(np.full(n, salt, np.int32))],
                    names=["number", "id", "score", "salt"])

    schema = StructType([*StructType.fromDDL("number long").fields, index.schema["id"],
                         *StructType.fromDDL("score long, salt int").fields])
    return index.mapInArrow(search, schema)


def rank_documents(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", item: str = "item_id",
    text: str = "text", item_text: str = "text", top: int = TOP,
) -> DataFrame:
    """(item, rank, key, score): each item's ``top`` best documents of a score above 0.

    Equal scores rank by ascending id, null ids last. A null or empty text has no terms: such a document
    is found by nothing and doesn't count, such an item finds nothing. Very long texts
    count whole. Each row is a document or an item of its own, so repeated rows are all ranked,
    and a repeated item has its ranks once for each row. Empty tables give no rows. Columns not named
    are never read.

    Items are answered in blocks of about ``BLOCK_TERMS`` terms, which are what the driver
    holds; each block reads the documents once.
    """
    spark = docs.sparkSession
    named = durable(items.select(F.col(item).alias("_item"), item_text,
                                 F.monotonically_increasing_id().alias("_number")))
    wanted = durable(item_terms(named, item_text).where(F.size("terms") > 0))
    n_terms_all = wanted.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, -(-n_terms_all // BLOCK_TERMS))
    dealt = wanted.withColumn("block", F.pmod(F.xxhash64("number"), F.lit(blocks)))
    found = None
    for number in range(blocks):
        rows = dealt.where(F.col("block") == number).select("number", "terms").collect()
        vocabulary = pa.array(sorted({t for r in rows for t in r["terms"]}), pa.string())
        place = {t: i for i, t in enumerate(vocabulary.to_pylist())}
        index = durable(forward_index(docs, key, text, vocabulary))
        totals = index.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
        n_docs, n_terms = totals["docs"], totals["terms"] or 0
        held = np.zeros(len(vocabulary), np.int64)
        counts = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
        for row in counts.collect():  # one row a term of the block at most
            held[row["term"]] = row["df"]
        weights = np.array([math.floor(1000 * math.log(float(2 * n_docs + 2) / float(2 * df + 1)))
                            for df in held.tolist()], np.int64)
        block = Block([r["number"] for r in rows],
                      [np.array(sorted(place[t] for t in r["terms"])) for r in rows], weights)
        part = best_per_task(index.where(F.size("terms") > 0), block, n_docs, n_terms, top)
        found = part if found is None else found.unionByName(part)
    order = [F.desc("score"), F.asc_nulls_last("id")]
    salted = Window.partitionBy("number", "salt").orderBy(*order)
    whole = Window.partitionBy("number").orderBy(*order)
    ranked = (
        found.withColumn("_n", F.row_number().over(salted)).where(F.col("_n") <= top)
        .withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= top)
    )
    return ranked.join(named, ranked.number == named._number).select(
        F.col("_item").alias(item), "rank", F.col("id").alias(key), "score")
