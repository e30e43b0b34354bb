"""BPE encoding and decoding with content-defined chunks that documents share.

A rolling hash cuts every text into chunks at places that depend on the bytes around them
only, so a passage shared by documents gives the same chunks in all of them. Chunks found in more
than one place are encoded once, by the document with the least id that holds them; all others
borrow the ids. What is borrowed lies between a chunk's first and last white space; what lies
around a chunk join is encoded again from the document's own text. At either end of
a borrowed stretch the words around the cut are encoded together and apart: only if the ids agree exactly is
it borrowed; otherwise the chunk is encoded with its surroundings, which widens the repair to
the next cut, if need be over the whole text. So the ids are those of the whole text.

Text that is encoded is cut into words, with the white space before them if the tokenizer keeps it;
a word met again in the task is not encoded again. Whether words may be cut apart is
found out from the tokenizer itself, and checked on a stretch of every slice of text.

Which chunks are shared is decided by digests. The directory of shared chunks sent to the
executors has at most ``MAX_SHARED`` entries, those with the most copies; a chunk outside it is
encoded where it stands. That bounds memory and changes no result. Texts move only as the ids
of their parts, once. A chunk with many copies lends its ids in several lanes, so that no task
joins all its borrowers.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterlens.llm.workers import give_back, held, lean
from meterlens.storage import durable

#: Chunks end where the top bits of the hash are zero: 1 KiB apart on average.
CUT_BITS = 10
MIN_CHUNK, MAX_CHUNK = 256, 8192
MAX_SHARED = 1 << 18
#: Copies of a chunk that borrow from one lane.
LANE_COPIES = 128
#: Bytes of text encoded in one call, and planned at a time.
CALL_BYTES, SLICE_BYTES = 1 << 17, 1 << 20
WHITE = b" \t\n\r\x0b\x0c"
SPACE = re.compile(b"[" + WHITE + b"]")
WORD = re.compile(b"[^" + WHITE + b"]+")
#: A word with the white space before it, or white space at the end.
SPACED_WORD = re.compile(b"[" + WHITE + b"]*[^" + WHITE + b"]+|[" + WHITE + b"]+")
#: What stands between words encoded in one call: a word that is one id of its own.
MARK = b" \x01 "
#: Words remembered by a worker, words encoded in one call, and bytes checked in every slice.
MAX_WORDS, CALL_WORDS, CHECKED = 1 << 18, 4096, 2048

GEAR = np.random.default_rng(20240501).integers(0, 1 << 32, 256, dtype=np.uint32)


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """Gear hash of the 32 bytes up to each position, by doubling the window."""
    h = GEAR[data]
    width = 1
    while width < 32:
        longer = h.copy()
        longer[width:] += h[:-width] << np.uint32(width)
        h = longer
        width *= 2
    return h


def chunk_ends(data: bytes) -> list[int]:
    """Ends of the chunks of a UTF-8 text; no chunk ends inside a code point."""
    n = len(data)
    if not n:
        return []
    view = np.frombuffer(data, np.uint8)
    starts = np.ones(n + 1, bool)
    starts[:n] = (view & 0xC0) != 0x80
    cuts = np.flatnonzero((rolling_hash(view) >> np.uint32(32 - CUT_BITS)) == 0) + 1
    cuts = cuts[starts[cuts]]
    ends, last = [], 0
    for cut in [*cuts.tolist(), n]:
        while cut - last > MAX_CHUNK:
            end = last + MAX_CHUNK
            while not starts[end]:
                end -= 1
            ends.append(end)
            last = end
        if cut - last >= MIN_CHUNK or cut == n and cut > last:
            ends.append(cut)
            last = cut
    return ends


def inner_range(chunk: bytes) -> tuple[int, int] | None:
    """From a chunk's first white space to before its last, None if there is nothing between.

    White space stays with the word after it.
    """
    found = SPACE.search(chunk)
    if found is None:
        return None
    last = run_start(chunk, max(chunk.rfind(c) for c in (b"%c" % w for w in WHITE)))
    return (found.start(), last) if last > found.start() else None


def run_start(data: bytes, at: int) -> int:
    """Where the white space around position ``at`` starts."""
    while at > 0 and data[at - 1] in WHITE:
        at -= 1
    return at


def around(data: bytes, cut: int, words: int = 2) -> tuple[bytes, bytes]:
    """The last words before ``cut`` and the first after it, white space included."""
    start, end = cut, cut
    for _ in range(words):
        while start > 0 and data[start - 1] in WHITE:
            start -= 1
        while start > 0 and data[start - 1] not in WHITE and cut - start < 256:
            start -= 1
        while end < len(data) and data[end] in WHITE:
            end += 1
        while end < len(data) and data[end] not in WHITE and end - cut < 256:
            end += 1
    while 0 < start < cut and data[start] & 0xC0 == 0x80:
        start += 1
    while cut < end < len(data) and data[end] & 0xC0 == 0x80:
        end += 1
    return data[start:cut], data[cut:end]


def digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def parts_at_spaces(piece: bytes, most: int = CALL_BYTES) -> Iterator[bytes]:
    """The piece cut before white space, in parts of little more than ``most`` bytes."""
    start = 0
    while len(piece) - start > most:
        found = SPACE.search(piece, start + most)
        if found is None:
            break
        cut = run_start(piece, found.start())
        if cut <= start:  # nothing but white space so far
            word = WORD.search(piece, found.start())
            found = word and SPACE.search(piece, word.end())
            if not found:
                break
            cut = found.start()
        yield piece[start:cut]
        start = cut
    yield piece[start:]


class PieceEncoder:
    """Ids of pieces of text that begin and end at white space or at an end of the text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size()
        self.digits = list(map(str, range(size)))
        self.strings = list(map(self.tokenizer.id_to_token, range(size)))
        # Words remembered, their ids one after the other, and where each word's begin: a few
        # bytes a word, which as objects of their own would take some hundred.
        self.words = pa.array([], pa.binary())
        self.ids, self.starts = np.empty(0, np.uint32), np.zeros(1, np.int64)
        self.mark = np.frombuffer(self.raw([MARK])[0], np.uint32)
        # How a text may be cut into pieces that are encoded apart; None if it may not.
        self.pattern = next((p for p in (WORD, SPACED_WORD) if self.probe(p)), None)

    def distinct_ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word. Words that may stand apart go into few calls, a mark between them."""
        if self.pattern is not WORD or len(self.mark) != 1:
            return self.raw(words)
        out = []
        for at in range(0, len(words), CALL_WORDS):
            some = words[at:at + CALL_WORDS]
            ids = np.frombuffer(self.raw([MARK.join(some)])[0], np.uint32)
            marks = np.flatnonzero(ids == self.mark[0])
            if len(marks) != len(some) - 1:  # a word holds the mark itself
                out += self.raw(some)
                continue
            edges = [0, *(marks + 1).tolist()], [*marks.tolist(), len(ids)]
            out += [ids[a:b].tobytes() for a, b in zip(*edges)]
        return out

    def raw(self, texts: list[bytes]) -> list[bytes]:
        """Ids as 32-bit numbers, each text by itself."""
        found = self.tokenizer.encode_batch_fast(
            [t.decode("utf-8", "surrogatepass") for t in texts], add_special_tokens=False)
        return [np.array(one.ids, np.uint32).tobytes() for one in found]

    def cut_agrees(self, text: bytes, pattern: re.Pattern) -> bool:
        whole, *words = self.raw([text, *pattern.findall(text)])
        return whole == b"".join(words)

    def probe(self, pattern: re.Pattern) -> bool:
        """Whether words cut by ``pattern`` have the ids they have in a text."""
        runs = [b" ", b"  ", b"   ", b"\n", b"\n\n", b" \n", b"\t", b"\r\n", b"\x0b\x0c "]
        words = [b"word", b"don't", b"12", b"(x)", "é".encode(), b"?", b"A", "日本".encode(), MARK.strip()]
        texts = [a + r + b + r for r in runs for a in words for b in words] + [*runs, b" lead", b"trail "]
        return all(self.cut_agrees(t, pattern) for t in texts)

    def agree(self, cuts: list[tuple[bytes, bytes]]) -> list[bool]:
        """Whether the text before a cut and the text after it have the same ids apart and together."""
        found = self.raw([x for left, right in cuts for x in (left + right, left, right)])
        return [found[i] == found[i + 1] + found[i + 2] for i in range(0, len(found), 3)]

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as 32-bit numbers."""
        longest = max(pieces, key=len, default=b"")
        if self.pattern is not None and longest:
            stretch = next(parts_at_spaces(longest, CHECKED))
            if not self.cut_agrees(stretch, self.pattern):
                self.pattern = None
        if self.pattern is None:
            return self.raw(pieces)
        out: list[list[bytes]] = [[] for _ in pieces]
        call: list[tuple[int, bytes]] = []
        size = 0

        def flush() -> None:
            for (i, _), ids in zip(call, self.by_words([part for _, part in call])):
                out[i].append(ids)
            call.clear()

        for i, piece in enumerate(pieces):
            for part in parts_at_spaces(piece, SLICE_BYTES):
                call.append((i, part))
                size += len(part)
                if size >= SLICE_BYTES:
                    flush()
                    size = 0
        flush()
        return [b"".join(x) for x in out]

    def by_words(self, parts: list[bytes]) -> list[bytes]:
        """Ids of each part put together from those of its words, distinct ones encoded once."""
        if self.pattern is WORD:
            split = pa.compute.ascii_split_whitespace(pa.array(parts, pa.binary()).cast(pa.string()))
            words, ends = split.flatten().cast(pa.binary()), split.offsets.to_numpy()
        else:
            found = [self.pattern.findall(part) for part in parts]
            words = pa.array([w for one in found for w in one], pa.binary())
            ends = np.cumsum([0, *map(len, found)])
        if not len(words):
            return [b""] * len(parts)
        coded = words.dictionary_encode()
        places = coded.indices.to_numpy(zero_copy_only=False)
        known = pa.compute.index_in(coded.dictionary, value_set=self.words)
        unknown = coded.dictionary.filter(known.is_null())
        found = self.distinct_ids(unknown.to_pylist())
        # The ids of the unknown words follow those remembered.
        at = known.to_numpy(zero_copy_only=False)
        at = np.where(np.isnan(at), np.cumsum(np.isnan(at)) - 1 + len(self.words), at).astype(np.int64)
        flat = np.concatenate([self.ids, np.frombuffer(b"".join(found), np.uint32)])
        starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(
            [len(ids) // 4 for ids in found], dtype=np.int64)])
        lengths = np.diff(starts)[at][places]
        stops = np.concatenate([[0], np.cumsum(lengths)])
        shifts = starts[at][places] - stops[:-1]
        ids = flat[np.repeat(shifts, lengths) + np.arange(stops[-1])]
        self.remember(unknown, flat, starts)
        edges = stops[ends]
        return [ids[a:b].tobytes() for a, b in zip(edges, edges[1:])]

    def remember(self, new: pa.Array, ids: np.ndarray, starts: np.ndarray) -> None:
        """Keep the first of the ``new`` words, ``MAX_WORDS`` in all, and their ``ids``."""
        new = new.slice(0, max(0, MAX_WORDS - len(self.words)))
        if len(new):
            self.words = pa.concat_arrays([self.words, new])
            self.starts = starts[:len(self.words) + 1].copy()
            self.ids = ids[:self.starts[-1]].copy()

    def decode(self, numbers: list[int]) -> str:
        """As the tokenizer decodes; without a decoder it joins tokens by blanks."""
        if self.tokenizer.decoder is None:
            return " ".join(map(self.strings.__getitem__, numbers))
        return self.tokenizer.decode(numbers, skip_special_tokens=False)

    def finish(self, ids: bytes) -> tuple[int, str, str]:
        """(number of ids, digest of the ids, digest of the decoded text)."""
        numbers = np.frombuffer(ids, np.uint32).tolist()
        shown = " ".join(map(self.digits.__getitem__, numbers))
        return (len(numbers), hashlib.sha256(shown.encode()).hexdigest(),
                hashlib.sha256(self.decode(numbers).encode()).hexdigest())


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a tokenizer file."""
    return held(path, lambda: PieceEncoder(path))


def shared_chunks(
    docs: DataFrame, number: str, data: str, max_shared: int
) -> dict[bytes, tuple[int, int]]:
    """Digest of each shared chunk: the least ``number`` of a row that holds it, and its lanes.

    At most ``max_shared`` entries: those with at least so many copies that they fit.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, digests = [], []
            for n, d in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                last = 0
                for end in chunk_ends(d):
                    numbers.append(n)
                    digests.append(digest(d[last:end]))
                    last = end
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int64()), pa.array(digests, pa.binary())],
                names=["number", "chunk"])

    chunks = docs.select(number, data).mapInArrow(lean(cut), "number long, chunk binary")
    counted = durable(chunks.groupBy("chunk").agg(
        F.count("*").alias("copies"), F.min("number").alias("owner")).where("copies > 1"))
    sizes = counted.groupBy(F.least("copies", F.lit(1 << 16)).alias("copies")).agg(
        F.count("*").alias("n")).collect()
    total, least = 0, 1 << 62
    for row in sorted(sizes, key=lambda r: -r["copies"]):
        total += row["n"]
        if total > max_shared:
            break
        least = row["copies"]
    rows = counted.where(F.col("copies") >= least).collect()
    return {bytes(row["chunk"]): (row["owner"], -(-row["copies"] // LANE_COPIES)) for row in rows}


def encode_texts(
    docs: DataFrame, path: str, text: str = "text", key: str = "doc_id",
    max_shared: int = MAX_SHARED,
) -> DataFrame:
    """Rows of three kinds: whole texts, parts of texts, and chunks that others borrow.

    The ids of a text are its parts' ids in order of ``part``, as 32-bit numbers; a part with a
    ``chunk`` has the ids of that chunk, from lane ``lane``. A row without a part lends a
    chunk's ids in ``lane`` lanes. ``number`` and the key identify the text. A text of one part
    is finished at once.
    """
    spark = docs.sparkSession
    data = F.coalesce(F.encode(text, "UTF-8"), F.lit(b""))
    # A row is known by the hash of its id and text: repeated rows are equal in every result.
    numbered = docs.select(F.col(key), F.xxhash64(key, text).alias("_number"), data.alias("_data"))
    directory = spark.sparkContext.broadcast(
        shared_chunks(numbered, "_number", "_data", max_shared))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, codec = directory.value, encoder(path)
        for batch in batches:
            for piece in slices(batch, 2, SLICE_BYTES):
                yield encode_slice(piece, shared, codec)
            give_back()  # the words' own objects, many and small

    def encode_slice(batch: pa.RecordBatch, shared: dict, codec: PieceEncoder) -> pa.RecordBatch:
        keys, numbers, texts = (c.to_pylist() for c in batch.columns)
        plans = plan_slice(texts, numbers, shared, codec)
        rows = list(zip(keys, numbers, plans))
        found = iter(codec.encode([piece for _, _, (pieces, owned) in rows for piece in
                                   [*(p for p, h in pieces if h is None), *owned.values()]]))
        out: list[tuple] = []
        for k, n, (pieces, owned) in rows:
            if len(pieces) <= 1 and not any(h for _, h in pieces):
                ids = next(found) if pieces else b""
                out.append((k, n, 0, None, None, None, *codec.finish(ids)))
            else:
                out += [(k, n, i, next(found), None, None, None, None, None) if h is None else
                        (k, n, i, None, h, (n + i) % shared[h][1], None, None, None)
                        for i, (_, h) in enumerate(pieces)]
            out += [(None, None, None, next(found), h, shared[h][1], None, None, None)
                    for h in owned]
        columns = list(zip(*out)) if out else [[] for _ in ENCODED.split(", ")]
        kinds = [batch.schema.types[0], pa.int64(), pa.int32(), pa.binary(), pa.binary(),
                 pa.int64(), pa.int64(), pa.string(), pa.string()]
        names = [key, "number", "part", "ids", "chunk", "lane", "n_tokens", "ids_sha256",
                 "decoded_sha256"]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds)], names=names)

    schema = StructType(docs.select(key).schema.fields + StructType.fromDDL(ENCODED).fields)
    return numbered.mapInArrow(lean(encode, path), schema)


ENCODED = ("number long, part int, ids binary, chunk binary, lane long, n_tokens long, "
           "ids_sha256 string, decoded_sha256 string")


def slices(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have about ``most`` bytes, one row at least."""
    sizes = np.cumsum(pa.compute.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(sizes):
        before = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, before + most, "right")))
        yield batch.slice(start, end - start)
        start = end


def plan_slice(
    texts: list[bytes], numbers: list[int], shared: dict[bytes, tuple[int, int]],
    codec: PieceEncoder,
) -> list[tuple[list[tuple[bytes, bytes | None]], dict[bytes, bytes]]]:
    """(parts in order, chunks to encode for others) of each text.

    A part is either bytes to encode here or the digest of a chunk whose ids to borrow. What
    lies between two borrowed stretches, joins included, is one part. A stretch is
    borrowed only if the ids agree at both of its ends.
    """
    stretches: list[tuple[int, int, int, bytes]] = []
    owned: list[dict[bytes, bytes]] = [{} for _ in texts]
    for i, (data, number) in enumerate(zip(texts, numbers)):
        last = 0
        for end in chunk_ends(data):
            chunk = data[last:end]
            h = digest(chunk)
            inner = inner_range(chunk) if h in shared else None
            if inner is not None and shared[h][0] == number:
                owned[i][h] = chunk[inner[0]:inner[1]]
            elif inner is not None:
                stretches.append((i, last + inner[0], last + inner[1], h))
            last = end
    agreed = codec.agree([
        around(texts[i], cut) for i, start, end, _ in stretches for cut in (start, end)])
    parts: list[list[tuple[bytes, bytes | None]]] = [[] for _ in texts]
    done = [0] * len(texts)
    for at, (i, start, end, h) in enumerate(stretches):
        if agreed[2 * at] and agreed[2 * at + 1]:
            if start > done[i]:
                parts[i].append((texts[i][done[i]:start], None))
            parts[i].append((b"", h))
            done[i] = end
    for i, data in enumerate(texts):
        if done[i] < len(data):
            parts[i].append((data[done[i]:], None))
    return list(zip(parts, owned))


def encode_documents(
    docs: DataFrame, path: str, text: str = "text", key: str = "doc_id",
    max_shared: int = MAX_SHARED,
) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) per row, of the whole text.

    Ids are those of the tokenizer in the file ``path`` without added special tokens;
    they are decoded with special tokens kept. Null and empty texts have no ids, very long ones are
    encoded whole. Rows that are equal in key and text give equal rows; no rows give none. A
    chunk that ties for its owner is encoded by each row of the least number. Other columns are not
    read.
    """
    encoded = durable(encode_texts(docs, path, text, key, max_shared))
    whole = encoded.where("n_tokens is not null").select(
        key, "n_tokens", "ids_sha256", "decoded_sha256")
    lent = encoded.where("part is null").select(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("lane") - 1)).alias("lane"),
        F.col("ids").alias("lent")).dropDuplicates(["chunk", "lane"])
    parts = encoded.where("part is not null and n_tokens is null")
    borrowed = parts.where("chunk is not null").drop("ids").join(lent, ["chunk", "lane"])
    columns = [key, "number", "part"]
    filled = parts.where("chunk is null").select(*columns, "ids").unionByName(
        borrowed.select(*columns, F.col("lent").alias("ids")))
    # Rows equal in key and text repeat every part as often as the first. Both groupings need
    # the rows of a number together: one shuffle serves them.
    once = filled.repartition("number").groupBy(*columns).agg(
        F.first("ids").alias("ids"), F.count("*").alias("copies"))
    joined = once.groupBy(key, "number").agg(
        F.max("copies").alias("copies"),
        F.array_sort(F.collect_list(F.struct("part", "ids"))).alias("p")
    ).select("copies", key, F.col("p.ids").alias("ids"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(path)
        for batch in batches:
            done = [codec.finish(b"".join(p)) for p in batch.column(2).to_pylist()]
            counts, ids, texts = zip(*done) if done else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()),
                 pa.array(ids, pa.string()), pa.array(texts, pa.string())],
                names=["copies", key, "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = StructType(joined.select("copies", key).schema.fields + StructType.fromDDL(
        "n_tokens long, ids_sha256 string, decoded_sha256 string").fields)
    assembled = joined.mapInArrow(lean(finish, path), schema)
    repeated = assembled.withColumn(
        "_", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    out = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
    return whole.select(*out).unionByName(repeated.select(*out))
