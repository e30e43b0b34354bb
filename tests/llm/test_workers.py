"""What Python processes hold between tasks, and the batches they are handed."""

from __future__ import annotations

import pyarrow as pa

import corpus_pipeline
from meterlens.llm import workers
from meterlens.llm.bpe import encode_documents
from meterlens.llm.queries import TOKENIZER
from meterlens.storage import BATCH_BYTES

_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def anonymous() -> int:
    with open("/proc/self/smaps_rollup") as lines:
        return next(int(line.split()[1]) for line in lines if line.startswith("Anonymous:")) << 10


def test_a_task_drops_what_others_held_and_gives_memory_back():
    batch = pa.RecordBatch.from_pydict({"n": [1]})
    before = anonymous()
    workers.held("other", lambda: [b"%d" % i * 20 for i in range(400_000)])
    # Small objects around the freed ones keep the heap from shrinking by itself.
    pins = [b"%d" % i * 20 for i in range(1000)]
    grown = anonymous() - before
    own = workers.held("own", list)
    assert list(workers.lean(lambda batches: batches, "own")(iter([batch]))) == [batch]
    assert workers.held("own", dict) is own and workers._HELD.keys() == {"own"}
    assert grown > 30 << 20 and anonymous() - before < grown / 2
    assert pins
    workers._HELD.clear()


def test_the_encoder_goes_when_other_work_begins(spark):
    def look(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [len(workers._HELD)] * batch.num_rows})

    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(40)], "doc_id long, text string")
    assert encode_documents(docs, TOKENIZER).count() == 40
    found = docs.repartition(8).mapInArrow(workers.lean(look), "n long").collect()
    assert len(found) == 40 and not any(row["n"] for row in found)


def test_stages_leave_batches_small(spark):
    docs = spark.createDataFrame(
        [(i, f"some words {i}", "en", "s", 12) for i in range(40)],
        "doc_id long, text string, lang string, source string, n_chars long")
    kept = spark.conf.get(_LIMIT, None)
    try:
        for name, stage in corpus_pipeline.STAGES:
            spark.conf.unset(_LIMIT)
            assert stage(spark, docs, "").count() and spark.conf.get(_LIMIT) == str(BATCH_BYTES), name
        spark.conf.set(_LIMIT, "1m")  # a session's own limit stays
        assert corpus_pipeline.STAGES[0][1](spark, docs, "").count() and spark.conf.get(_LIMIT) == "1m"
    finally:
        spark.conf.unset(_LIMIT) if kept is None else spark.conf.set(_LIMIT, kept)


def test_remembered_words_take_few_bytes(monkeypatch):
    """Their ids are right whether a word is new, remembered or past the limit."""
    from meterlens.llm import bpe

    codec = bpe.PieceEncoder(TOKENIZER)
    texts = [" ".join(f"w{i % 997}x{i * j % 5003} é" for i in range(600)).encode() for j in range(1, 9)]
    whole = codec.raw(texts)
    for most in (1 << 18, 1000, 0):
        monkeypatch.setattr(bpe, "MAX_WORDS", most)
        codec = bpe.PieceEncoder(TOKENIZER)
        for _ in range(2):
            assert [codec.encode([text])[0] for text in texts] == whole
        assert len(codec.words) <= most and len(codec.words) == len(set(codec.words.to_pylist()))
        held = codec.words.nbytes + codec.ids.nbytes + codec.starts.nbytes
        assert (most == 0) == (not len(codec.words)) and held <= 64 * (len(codec.words) + 1)
