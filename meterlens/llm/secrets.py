"""Secret scan: fixed patterns, and a randomness test battery over token-like runs.

Runs of 16 or more characters from ``[A-Za-z0-9+/_-]`` with their padding are candidates if an encoding can be
inferred (hex, base 32, base 64 or its URL form: digits and letters of the needed kinds).
Over the digit values of its encoding each candidate takes three tests: chi-squared uniformity
of the alphabet, runs about its middle, and serial correlation. Their results combine into
one p-value of "this is ordinary text, or an ordered pattern", under the corpus's own letter
frequencies.

Benjamini-Hochberg selects candidates per length class, over the whole corpus, so the longer
tokens' power doesn't pay for the short ones'. p-values are rounded up to steps of a
fixed grid: a table of at most (classes x steps) counts gives the thresholds, and rounding up
keeps the false-discovery rate below its level.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from meterlens.llm.workers import lean

#: Fixed patterns of the three base kinds, in their order of listing.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_ASSIGN, MIN_ACCESS = 8, 16
KINDS = ("assign", "access", "hex", "random")
#: An equals sign is padding at the end of a run and separates runs elsewhere.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")

HEX_DIGITS = "0123456789abcdef"
BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE64_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
ENCODINGS = {"hex": HEX_DIGITS, "base32": BASE32_DIGITS, "base64": BASE64_DIGITS}
#: False-discovery rate.
FDR = 0.01
#: Length classes: from each of these lengths to the next.
LENGTHS = (16, 20, 24, 32, 40, 64, 128)
#: Steps of -log10 p.
STEPS_PER_DECADE, MAX_DECADES = 20, 30

SPAN = "struct<kind:string,start:int,end:int>"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then kind as listed."""
    spans = [
        ("assign", m.start(), m.end()) for m in ASSIGN.finditer(text)
        if m.end(2) - m.start(2) >= MIN_ASSIGN
    ]
    spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)
              if m.end() - m.start() >= MIN_ACCESS]
    spans += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return in_order(spans)


def in_order(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def infer_encoding(token: str) -> str | None:
    """The narrowest encoding whose digits the token has, None for words and numbers."""
    body = token.rstrip("=")
    if not body:
        return None
    lower, upper = any(c.islower() for c in body), any(c.isupper() for c in body)
    digit = any(c.isdigit() for c in body)
    if digit and lower != upper:
        if not set(body.lower()) - set(HEX_DIGITS):
            return "hex"
        if upper and not set(body) - set(BASE32_DIGITS):
            return "base32"
    if digit and (lower or upper) or lower and sum(c.isupper() for c in body[1:]) >= 3:
        return "base64"
    return None


def digit_values(token: str, encoding: str) -> np.ndarray:
    body = token.rstrip("=")
    if encoding == "hex":
        body = body.lower()
    if encoding == "base64":
        body = body.replace("-", "+").replace("_", "/")
    digits = ENCODINGS[encoding]
    return np.array([digits.index(c) for c in body])


def _log_normal(x: float, mean: float, variance: float) -> float:
    variance = max(variance, 1e-9)
    return -0.5 * ((x - mean) ** 2 / variance + math.log(2 * math.pi * variance))


def uniformity_p(values: np.ndarray, frequencies: np.ndarray) -> float:
    """Chance that ordinary text repeats its digits as little as the token does.

    The chi-squared statistic against the uniform alphabet grows with the number of equal
    pairs. Among digits drawn with ``frequencies`` that number has a known mean and variance; the
    p-value is its lower tail.
    """
    n = len(values)
    counts = np.bincount(values, minlength=len(frequencies))
    pairs = (counts * (counts - 1)).sum() / 2
    s2, s3 = (frequencies**2).sum(), (frequencies**3).sum()
    mean = n * (n - 1) / 2 * s2
    variance = n * (n - 1) / 2 * (s2 * (1 - s2) + 2 * (n - 2) * (s3 - s2 * s2))
    if variance <= 0:
        return 1.0
    return 0.5 * math.erfc((mean - pairs - 0.5) / math.sqrt(2 * variance))


def order_log_e(values: np.ndarray, frequencies: np.ndarray) -> float:
    """Logarithm of the e-value of runs about the alphabet's middle and of serial correlation.

    Each is the density of the test's statistic for random digits over the greater of its
    densities for text's frequencies and for a pattern, which may give any value. Under either
    its mean is at most 1.
    """
    n, alphabet = len(values), len(frequencies)
    high = values >= alphabet / 2
    runs = 1 + int((high[1:] != high[:-1]).sum())

    def runs_density(share: float) -> float:
        change = 2 * share * (1 - share)
        return _log_normal(runs, 1 + (n - 1) * change, (n - 1) * change * (1 - change))

    text = runs_density(float(frequencies[(alphabet + 1) // 2:].sum()))
    log_e = runs_density(0.5) - max(text, -math.log(n))
    x = values - values.mean()
    r = float(x[1:] @ x[:-1]) / max(1e-12, float(x @ x))
    independent = _log_normal(r, -1 / n, 1 / n)
    return log_e + independent - max(independent, -math.log(2))


def evidence(values: np.ndarray, frequencies: np.ndarray) -> float:
    """-log10 of the battery's one p-value: that of uniformity divided by the e-value of order.

    A p-value over an e-value of other aspects of the token is a p-value again, so all
    three tests are under false-discovery control. A sequence or repeated pattern, however
    many different digits it has, has an e-value near 0.
    """
    p = max(uniformity_p(values, frequencies), 1e-99)
    return (order_log_e(values, frequencies) - math.log(p)) / math.log(10)


def character_counts(docs: DataFrame, text: str) -> np.ndarray:
    """Occurrences of each ASCII character over all texts: one row of 128 numbers a task."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, np.int64)
        for batch in batches:
            column = batch.column(0)
            for part in column.to_pylist():
                if part:
                    total += np.bincount(np.frombuffer(part, np.uint8), minlength=256)
        yield pa.RecordBatch.from_pydict({
            "c": pa.array(range(128), pa.int32()), "n": pa.array(total[:128], pa.int64())})

    rows = (
        docs.select(F.encode(text, "UTF-8").alias("b")).mapInArrow(lean(count), "c int, n long")
        .groupBy("c").agg(F.sum("n").alias("n")).collect()
    )
    out = np.zeros(128)
    for row in rows:  # 128 rows
        out[row["c"]] = row["n"]
    return out


def digit_frequencies(counts: np.ndarray) -> dict[str, np.ndarray]:
    """Ordinary text's frequency of each digit of an encoding, one added to each."""
    out = {}
    for name, digits in ENCODINGS.items():
        seen = np.array([counts[ord(c)] + 1 for c in digits])
        if name == "hex":
            seen = seen + np.array([counts[ord(c.upper())] if c.isalpha() else 0 for c in digits])
        if name == "base32":  # words are written in small letters
            seen = seen + np.array([counts[ord(c.lower())] if c.isalpha() else 0 for c in digits])
        out[name] = seen / seen.sum()
    return out


def scan_text(text: str, frequencies: dict[str, np.ndarray]) -> tuple[list, list]:
    """(base spans, candidates outside them) of one whole text."""
    base = base_spans(text)
    candidates = []
    for m in CANDIDATE.finditer(text):
        token = m.group()
        encoding = infer_encoding(token)
        if encoding is None or any(s < m.end() and m.start() < e for _, s, e in base):
            continue
        values = digit_values(token, encoding)
        if len(values) < LENGTHS[0]:
            continue
        decades = min(MAX_DECADES, max(0.0, evidence(values, frequencies[encoding])))
        length = sum(len(values) >= x for x in LENGTHS) - 1
        candidates.append((m.start(), m.end(), length, int(decades * STEPS_PER_DECADE)))
    return base, candidates


def selected_steps(candidates: DataFrame, fdr: float = FDR) -> DataFrame:
    """(class, least step) by Benjamini-Hochberg within each length class.

    ``candidates`` has (class, step, n). At most ``len(LENGTHS)`` times the grid's steps counts
    are ordered.
    """
    counts = candidates.groupBy("class", "step").agg(F.sum("n").alias("n"))
    total = F.sum("n").over(Window.partitionBy("class"))
    above = F.sum("n").over(Window.partitionBy("class").orderBy(F.desc("step")))
    bound = F.pow(F.lit(10.0), -F.col("step") / STEPS_PER_DECADE)
    return (
        counts.withColumns({"total": total, "above": above})
        .where((F.col("step") > 0) & (bound <= fdr * F.col("above") / F.col("total")))
        .groupBy("class").agg(F.min("step").alias("least"))
    )


def find_secrets(
    docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), fdr: float = FDR
) -> DataFrame:
    """``keep`` and ``spans``, an array of (kind, start, end), per row; code points, end exclusive.

    Base spans come from the fixed patterns; ``random`` spans are the battery's and touch no
    base span. Sorted by start, then by kind as listed. A null or empty text has none, a very
    long one is scanned whole; every row is judged on its own, so repeated rows give equal results;
    of spans that tie in start and kind the shorter comes first. No rows give none. Columns
    not in ``keep`` are not read; names in it must differ from ``base`` and ``spans``.

    Texts are read three times and nothing of them is stored: for character counts, for the
    candidates' levels, and for the spans.
    """
    frequencies = digit_frequencies(character_counts(docs, text))

    def levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[int, int], int] = {}
        for batch in batches:
            for t in batch.column(0).to_pylist():
                for _, _, length, step in scan_text(t or "", frequencies)[1]:
                    counts[length, step] = counts.get((length, step), 0) + 1
        yield pa.RecordBatch.from_arrays([
            pa.array([c for c, _ in counts], pa.int32()), pa.array([s for _, s in counts], pa.int32()),
            pa.array(list(counts.values()), pa.int64())], names=["class", "step", "n"])

    counted = docs.select(text).mapInArrow(lean(levels), "class int, step int, n long")
    # At most one number for each of the length classes.
    limits = {row["class"]: row["least"] for row in selected_steps(counted, fdr).collect()}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

        def column(rows: list[list[tuple]]) -> pa.Array:
            return pa.array([[dict(zip(("kind", "start", "end"), s)) for s in row] for row in rows], kind)

        for batch in batches:
            base, spans = [], []
            for t in batch.column(batch.num_columns - 1).to_pylist():
                found, candidates = scan_text(t or "", frequencies)
                random = [("random", a, b) for a, b, length, step in candidates
                          if step >= limits.get(length, 1 << 30)]
                base.append(found)
                spans.append(in_order(found + random))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], column(base), column(spans)],
                names=[*batch.schema.names[:-1], "base", "spans"])

    added = StructType.fromDDL(f"base array<{SPAN}>, spans array<{SPAN}>")
    schema = StructType(docs.select(*keep).schema.fields + added.fields)
    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(lean(scan), schema)


def redact(docs: DataFrame, spans: str, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of ``spans`` replaced by ``mark``; overlapping spans are one.

    A null text stays null.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            out = []
            for t, found in zip(batch.column(at).to_pylist(),
                                batch.column(batch.schema.get_field_index(spans)).to_pylist()):
                if t is not None and found:
                    parts, end = [], 0
                    for s in found:
                        if s["start"] >= end:
                            parts += [t[end:s["start"]], mark]
                        end = max(end, s["end"])
                    t = "".join(parts) + t[end:]
                out.append(t)
            columns = list(batch.columns)
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(lean(cut), docs.schema)
