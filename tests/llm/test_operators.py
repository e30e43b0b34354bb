"""The text operators against brute force, exact round trips and held-out rows."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlens.llm import queries as llm
from meterlens.llm.bpe import encode_documents
from meterlens.llm.digests import edited_fingerprints
from meterlens.llm.langid import predict_languages, train_language_model
from meterlens.llm.minhash import near_duplicates
from meterlens.llm.mixing import mix_to_targets, targets
from meterlens.llm.neighbours import nearest
from meterlens.llm.pitman_yor import Block, Seating, Totals, score_texts
from meterlens.llm.secrets import find_secrets, redact
from meterlens.llm.shingles import word_hashes
from meterlens.llm.suffixes import remove_repeats
from meterlens.llm.warc import NAMED, derive_records, plain_text, references_read, warc_text

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Extra columns whose names the operators may use inside.
SCHEMA = ("doc_id long, text string, source string, lang string, data string, number int, row int, "
          "size int, component_id int, part string, chunk string")


def table(spark, texts, sources=None, langs=None, ids=None):
    rows = [(i if ids is None else ids[i], t, sources[i] if sources else "a",
             langs[i] if langs else None, "x", 1, 2, 3, 4, "p", "c") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    """Copies, near copies, shared passages, nulls, empty and long texts."""
    rng = random.Random(3)
    shared = prose(rng, 700)
    base = prose(rng, 60)
    near = base.split()
    near[-1] = "changed"
    return [
        base, base.upper(), " ".join(near), base, None, "", " \t\n ", "one two",
        "ONE  two", "one two three", shared + " " + prose(rng, 300), prose(rng, 200) + " " + shared,
        prose(rng, 5) + shared + prose(rng, 5), "é é ﬁ Ünïcode 😀 " * 40,
        "x" * 30_000, prose(rng, 30_000), "a\x0bb\x0cc\x1cd e <|endoftext|> [UNK] </w>",
        *[prose(rng, 40) for _ in range(10)],
    ]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return table(spark, texts).cache()


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_bpe_equals_the_tokenizer(docs, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(llm.TOKENIZER)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    for shared in (1 << 18, 0):
        found = by_id(encode_documents(docs, llm.TOKENIZER, max_shared=shared))
        assert len(found) == len(texts)
        for i, text in enumerate(texts):
            ids = tokenizer.encode(text or "", add_special_tokens=False).ids
            shown = tokenizer.decode(ids, skip_special_tokens=False)
            assert tuple(found[i]) == (
                i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(shown.encode()).hexdigest()), i


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_bpe_of_any_white_space(spark, name):
    """A tokenizer that keeps blanks, and one that drops them, on texts that share passages."""
    import public_tokenizers
    from tokenizers import Tokenizer

    rng = random.Random(21)
    white = [" ", " ", " ", "  ", "\n", "\n\n  ", "\t", " \n ", "\u00a0", "\u3000 ", "\r\n"]

    def passage(n):
        return "".join(rng.choice(white) + rng.choice(["word", "don't", "x1", "é", "(a)", "I'll", "日本語", "..."])
                       for _ in range(n))

    common = [passage(900) for _ in range(3)]
    texts = [passage(rng.randrange(40)) + rng.choice(common) + passage(rng.randrange(40))
             for _ in range(24)] + [c[1:] for c in common] + common + [" ", "\n\n", " a", "b ", "x" * 5000]
    path = public_tokenizers.path(name)
    tokenizer = Tokenizer.from_file(path)
    found = by_id(encode_documents(table(spark, texts), path))
    for i, text in enumerate(texts):
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert found[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), i
        shown = tokenizer.decode(ids, skip_special_tokens=False)
        assert found[i]["decoded_sha256"] == hashlib.sha256(shown.encode()).hexdigest(), i


def test_disagreeing_cuts_are_not_borrowed():
    """Where the ids at a cut differ, the chunk is encoded with its surroundings."""
    from meterlens.llm import bpe

    rng = random.Random(6)
    passage = prose(rng, 4000).encode()
    texts = [passage, b"lead " + passage + b" trail"]
    shared = {}
    last = 0
    for end in bpe.chunk_ends(texts[1]):
        shared[bpe.digest(texts[1][last:end])] = (0, 1)
        last = end

    class Codec:
        def __init__(self, answer):
            self.answer = answer

        def agree(self, cuts):
            for left, right in cuts:
                assert (left + right) in texts[1] and len(left + right) < 600
            return [self.answer] * len(cuts)

    plans = bpe.plan_slice([texts[1]], [1], shared, Codec(True))
    assert sum(h is not None for _, h in plans[0][0]) > 5
    plans = bpe.plan_slice([texts[1]], [1], shared, Codec(False))
    assert plans[0][0] == [(texts[1], None)]


def shingles(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def test_near_duplicates_equal_brute_force(docs, texts):
    sets = [shingles(t) for t in texts]
    least = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 75 * len(a | b):
                    least[i] = least[j] = min(least[i], least[j])
    found = by_id(near_duplicates(docs))
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in found.items()} == {
        i: (len(s), least[i], least[i] == i) for i, s in enumerate(sets)}


def test_repeats_equal_brute_force(docs, texts):
    first, data = {}, [(t or "").encode() for t in texts]
    for i, d in enumerate(data):
        for k in range(len(d) - 49):
            first.setdefault(d[k:k + 50], i)
    found = by_id(remove_repeats(docs))
    for i, d in enumerate(data):
        gone = np.zeros(len(d) + 1, bool)
        for k in range(len(d) - 49):
            if first[d[k:k + 50]] < i:
                gone[k:k + 50] = True
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        assert tuple(found[i]) == (i, len(d), int(gone.sum()), spans,
                                   hashlib.sha256(kept).hexdigest()), i


def test_secrets(spark):
    rng = random.Random(8)
    key = base64.b64encode(rng.randbytes(48)).decode()
    texts = [
        'api-key = "abcdefgh" then password:short', "AKIA" + "B7" * 8, "f" * 40 + " g",
        "😀 token: 12345678\nSECRET='AAAA_BBBB-CC'", "blob " + key + " end",
        "a plain sentence about internationalisation and documents", None, "", prose(rng, 5000),
    ]
    rows = by_id(find_secrets(table(spark, texts)))
    spans = {i: [tuple(s) for s in r["spans"]] for i, r in rows.items()}
    pattern = re.compile(r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)"""
                         r"([A-Za-z0-9+/_.=-]+)")
    for i, text in enumerate(texts):
        wanted = [("assign", m.start(), m.end()) for m in pattern.finditer(text or "")
                  if len(m[2]) >= 8]
        assert [s for s in spans[i] if s[0] == "assign"] == wanted
    assert ("access", 0, 20) in spans[1] and ("hex", 0, 40) in spans[2]
    assert spans[4] == [("random", 5, 5 + len(key))]
    assert all(not spans[i] for i in (5, 6, 7, 8))
    kept = find_secrets(table(spark, texts), keep=("doc_id", "text"))
    assert by_id(redact(kept.drop("base"), "spans"))[4]["text"] == "blob [SECRET] end"


def test_mix_meets_targets(spark):
    rng = random.Random(5)
    sources = ["hot"] * 60 + ["rare"] * 5 + [None] * 20 + ["x"] * 30
    texts = [prose(rng, rng.randrange(1, 80)) for _ in sources]
    texts[0], texts[1], texts[3] = None, "", texts[2]
    df = table(spark, texts, sources)
    rows = mix_to_targets(df).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mix_to_targets(df.repartition(3)).collect()))
    size = [len(WORD.findall(t or "")) for t in texts]
    names = ["hot", "rare", "x", None]
    total = {n: sum(s for s, m in zip(size, sources) if m == n) for n in names}
    wanted = dict(zip(names, targets([total[n] for n in names], [5, 2, 1, 5])))
    assert math.isclose(sum(wanted.values()), sum(size))
    for r in rows:
        name = sources[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == total[name]
        assert math.isclose(r["target"], wanted[name]) and 0 <= r["taken"] <= 3 * r["size"]
    for n in names:
        taken = sum(r["taken"] for r in rows if sources[r["doc_id"]] == n)
        assert abs(taken - wanted[n]) <= max(size)


def test_language_model_scores(spark, docs, texts):
    held = {i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 5 == 1}

    def words(text):
        return [*WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")), None]

    counts = {}
    for i, t in enumerate(texts):
        for w in words(t) if i not in held else []:
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    found = by_id(score_texts(docs, F.col("doc_id").isin(sorted(held))))
    for i, t in enumerate(texts):
        r, ws = found[i], words(t)
        base = sum(math.log10((counts.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            i in held, len(ws), sum(w in counts for w in ws), n)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert math.isfinite(r["score"]) and r["score"] < 0


def test_language_model_beats_word_frequencies(spark):
    rng = random.Random(4)
    after = {c: [f"{c}{d}" for d in rng.sample("abcdefghijkl", 2)] for c in "abcdefghijkl"}

    def chain(n):
        word, out = "aa", []
        for _ in range(n):
            word = rng.choice(after[word[-1]])
            out.append(word)
        return " ".join(out)

    rows = score_texts(table(spark, [chain(300) for _ in range(60)]), F.col("doc_id") % 5 == 1).collect()
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.8 * sum(r["base_score"] for r in held)


def test_every_previous_word_has_its_own_restaurant(spark):
    """Two words that agree in the first 16 bits of their hashes are told apart."""
    seen: dict[int, str] = {}
    for word in (f"w{i}" for i in range(100_000)):
        part = int(word_hashes(np.frombuffer(word.encode(), np.uint8))[0]) >> 48
        if part in seen:
            break
        seen[part] = word
    one, other = seen[part], word
    rows = by_id(score_texts(table(
        spark, [f"{one} left", f"{other} right"] * 40 + [f"{one} left", f"{one} right"]), F.col("doc_id") >= 80))
    assert rows[80]["score"] > rows[81]["score"] + 1


def test_language_model_sums_to_one():
    """Over all words and an unknown one, in restaurants that several blocks share."""
    rng = np.random.default_rng(3)
    counts = rng.poisson(0.7, size=(30, 5))  # of word and context
    counts[:, 4] = 0
    blocks = []
    for number, words in enumerate((range(12), range(12, 30))):
        types = [(w, u) for w in words for u in range(5)]
        train = np.array([counts[t] for t in types], np.int64)
        blocks.append(Block(number, np.full(len(words), 5, np.uint32), np.array([u for _, u in types]), train))
    seatings = [Seating(b) for b in blocks]
    discounts = (0.6, 0.4)
    for number in range(4):
        others = sum(np.bincount(b.context, s.tables, minlength=5) for b, s in zip(blocks, seatings))
        totals = Totals(counts.sum(), (counts.sum(axis=1) > 0).sum(), discounts,
                        sum(s.root.sum() for s in seatings), sum(s.root_tables.sum() for s in seatings))
        seatings = [Seating(b, totals, s.tables, s.root_tables, counts.sum(axis=0).astype(float), others)
                    for b, s in zip(blocks, seatings)]
        for s in seatings:
            assert ((s.tables >= (s.block.train > 0)) & (s.tables <= s.block.train)).all()
        p = sum(np.bincount(b.context, s.predictive(), minlength=5) for b, s in zip(blocks, seatings))
        unknown = (1 + discounts[1] * totals.root_tables) / (totals.v + 1) / (1 + totals.root_customers)
        p += (1 + discounts[0] * others) / (1 + counts.sum(axis=0)) * unknown * (
            1 + totals.v - (counts.sum(axis=1) >= 0).sum())
        assert np.allclose(p, 1)
        seatings = [s.swept(np.random.default_rng([number, s.block.number])) for s in seatings]


def test_language_id_on_held_out_rows(spark):
    rng = random.Random(2)
    words = {"en": "the of and with house river which night walking".split(),
             "de": "der und mit haus fluss welche nacht gehen straße".split(),
             "fr": "le et avec maison rivière quelle nuit marcher où".split()}
    langs = [rng.choice(list(words)) for _ in range(240)]
    texts = [" ".join(rng.choices(words[x], k=12)) for x in langs]
    texts += [None, "", "123 456"]
    df = table(spark, texts, langs=langs + ["en"] * 3)
    model = train_language_model(df.where("doc_id % 4 != 2"), key=F.col("doc_id"))
    rows = by_id(predict_languages(df, model, keep=("doc_id",)))
    held = [i for i in range(240) if i % 4 == 2]
    assert sum(rows[i]["lang_pred"] == langs[i] for i in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    assert [rows[i]["lang_pred"] for i in (240, 241, 242)] == ["und"] * 3


def test_fingerprints(docs, texts):
    found = by_id(edited_fingerprints(docs))
    order = sorted(range(len(texts)), reverse=True)
    for at, i in enumerate(order):
        own, other = texts[i] or "", texts[order[(at + 1) % len(order)]] or ""
        cut = len(own) // 3
        edited = own[:len(own) - cut] + other[:cut]
        assert found[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert found[i]["n_chars"] == len(own)
        assert 0 <= found[i]["near_edited"] <= 1 and 0 <= found[i]["near_next"] <= 1
    assert found[0]["fingerprint"] == found[3]["fingerprint"]
    assert found[15]["near_edited"] > found[15]["near_next"]


@pytest.mark.parametrize("index_block, query_block, rows", [(8192, 1024, 64), (150, 8, 2)])
def test_neighbours_against_brute_force(spark, monkeypatch, index_block, query_block, rows):
    """In one block, and in many index and query blocks."""
    from meterlens.llm import neighbours

    monkeypatch.setattr(neighbours, "INDEX_BLOCK", index_block)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", query_block)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", rows)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 24)) * rng.uniform(0.5, 2, size=(900, 1))
    x[10] = x[20]
    x[31:36] = 3 * x[40]
    rows = [(i, v.tolist(), "c") for i, v in enumerate(x)]
    rows += [(900, None, "c"), (920, [0.0] * 24, "c"), (940, [float("nan")] * 24, "c")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, _x string")
    found = {}
    for r in nearest(df, F.col("vec_id") % 20 == 0).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert sorted(found) == list(range(0, 900, 20))
    hits = 0
    for q, ranks in found.items():
        assert sorted(ranks) == list(range(1, 21))
        scores = x @ x[q]
        best = [int(i) for i in np.lexsort((np.arange(900), -scores)) if i != q][:20]
        hits += len(set(best) & {v for v, _ in ranks.values()})
        assert all(math.isclose(s, scores[v], rel_tol=1e-9, abs_tol=1e-12) for v, s in ranks.values())
    assert hits >= 0.9 * 20 * len(found)
    # Equal vectors come in the order of their ids.
    assert [found[40][r][0] for r in range(1, 6)] == [31, 32, 33, 34, 35]


def test_windows_stay_small_where_vectors_have_structure():
    """In well separated groups few vectors are verified, and nearly all neighbours found."""
    from meterlens.llm.neighbours import SortedArrays

    rng = np.random.default_rng(4)
    centres = rng.normal(size=(100, 48))
    x = np.repeat(centres, 60, axis=0) + 0.15 * rng.normal(size=(6000, 48))
    ids = np.arange(len(x))
    arrays = SortedArrays(ids, x, float(np.linalg.norm(x, axis=1).max()))
    hits = looked = 0
    asked = np.arange(0, 6000, 200)
    for q, (near, scores, verified) in zip(asked, arrays.search(asked, x[asked], 20)):
        order = np.lexsort((ids, -(x @ x[q])))
        hits += len(set(order[order != q][:20].tolist()) & set(near.tolist()))
        looked += verified
        assert np.allclose(scores, x[near] @ x[q]) and q not in near
    assert hits >= 0.9 * 20 * 30
    assert looked < 0.5 * 30 * len(x)


def test_derived_records_are_linked(spark):
    page = "<html><head><title>T &amp; U</title></head><body><p>One</p><script>no</script>Two &lt;3</body></html>"
    rows = [("<urn:uuid:1>", "http://a/", "2020-01-01T00:00:00Z", "HTTP/1.1 200 OK\r\nX-A: b", page, 1),
            ("<urn:uuid:2>", None, None, None, None, 2)]
    df = spark.createDataFrame(rows, "record_id string, target_uri string, date string, headers string, "
                                     "body string, block int")
    got = {(r["refers_to"], r["record_type"]): r for r in derive_records(df).collect()}
    assert len(got) == 4
    text = got["<urn:uuid:1>", "conversion"]
    meta = got["<urn:uuid:1>", "metadata"]
    assert "One" in text["block"] and "Two <3" in text["block"] and "no" not in text["block"].split()
    assert meta["concurrent_to"] == text["record_id"] and "X-A" in meta["block"]
    for r in got.values():
        block = (r["block"] or "").encode()
        digest = base64.b32encode(hashlib.sha1(block).digest()).decode()
        assert r["block_digest"] == f"sha1:{digest}" and r["content_length"] == len(block)


def test_character_references(spark):
    """Against Python's own reading of references that end in a semicolon."""
    import html

    texts = ["caf&eacute; &#8217;x&#x27; &mdash; &amp;lt; &lt;b&gt;", "&copy; 2024 &middot; a &unknown; b & c",
             "&#0;&#xD800;&#x110000;&#128;&#x9F;&#9999999;", "&NotEqualTilde;&CounterClockwiseContourIntegral;",
             "no references", "&", "&&amp;&;", "&#x1F600;&#X41;&#65", "a&nbsp;b", "&AMP;&Amp;"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(
        references_read(F.col("t"))).collect()]
    def read(m):
        return html.unescape(m[0]).replace("\xa0", " ") if m[1][0] == "#" or m[1] in NAMED else m[0]
    wanted = [re.sub(r"&(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});", read, t) for t in texts]
    # Python drops some numbers that stand for no character; here they are shown as unknown.
    assert [g.replace("\ufffd", "").replace("\x9d", "") for g in got] == [w.replace("\ufffd", "") for w in wanted]


def test_pages_without_end_tags(spark):
    pages = ["<p>one<!-- two", "<p>one<script>two" * 500, "<head><title>t</title><p>one", "x" * 300_000, "", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(pages)], "i int, t string").select(
        "i", plain_text(F.col("t")).alias("p")).orderBy("i").collect()
    assert [r.p for r in rows] == ["one", "one", "one", "x" * 300_000, "", None]


def test_records_in_warc_form(spark):
    rows = [("<urn:uuid:1>", "http://a/", "2020-01-01T00:00:00Z", "HTTP/1.1 200 OK", "<p>é</p>")]
    df = spark.createDataFrame(rows, "record_id string, target_uri string, date string, headers string, body string")
    for r in warc_text(derive_records(df)).collect():
        head, block = r.value.split("\r\n\r\n", 1)
        lines = head.split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        assert lines[0] == "WARC/1.1" and fields["WARC-Refers-To"] == "<urn:uuid:1>"
        assert int(fields["Content-Length"]) == len(block.encode())
        assert (fields["WARC-Type"] == "metadata") == ("WARC-Concurrent-To" in fields)


def test_null_keys_and_repeated_rows(spark):
    df = table(spark, ["same text of a document"] * 4 + [None], ids=[7, 7, None, 8, None])
    calls = [lambda d: encode_documents(d, llm.TOKENIZER), near_duplicates, remove_repeats, find_secrets,
             mix_to_targets, edited_fingerprints, lambda d: score_texts(d, F.lit(False))]
    for call in calls:
        assert call(df).count() == 5, call


def test_empty_tables_give_no_rows(spark):
    df = table(spark, ["x"]).where("doc_id < 0")
    calls = [lambda d: encode_documents(d, llm.TOKENIZER), near_duplicates, remove_repeats, find_secrets,
             mix_to_targets, edited_fingerprints, lambda d: score_texts(d, F.lit(False)),
             lambda d: predict_languages(d, train_language_model(d))]
    for call in calls:
        assert call(df).count() == 0, call
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert nearest(vectors, F.lit(True)).count() == 0
    responses = spark.createDataFrame(
        [], "record_id string, target_uri string, date string, headers string, body string")
    assert derive_records(responses).count() == 0


def test_extra_columns_and_long_texts(spark):
    """Columns called like the operators' own, and a text of two million characters."""
    long = "the river " * 200_000
    df = spark.createDataFrame(
        [(1, long, "en", 1, 2, 3, "x"), (2, "der fluss", "de", 1, 2, 3, "x"), (3, None, "en", 1, 2, 3, "x")],
        "doc_id long, text string, lang string, spans int, lang_pred int, _has_letter int, block string")
    model = train_language_model(df, key=F.col("doc_id"))
    assert predict_languages(df, model, keep=("doc_id", "text")).count() == 3
    assert find_secrets(df).where(F.size("spans") > 0).count() == 0
    pages = df.select("doc_id", F.lit("r").alias("record_id"), F.lit("u").alias("target_uri"), F.lit("d").alias("date"),
                      F.lit("").alias("headers"), F.col("text").alias("body"), "block", "spans")
    sizes = {r["doc_id"]: r["content_length"] for r in derive_records(pages, keep=("doc_id",)).where(
        "record_type = 'conversion'").collect()}
    assert sizes == {1: len(long) - 1, 2: 9, 3: 0}


def test_pipeline_keeps_clean_documents(spark, folder):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_dedup", "secret_scan", "source_mix", "bpe"]
    rows = corpus_pipeline.run(spark, folder)
    assert set(rows.columns) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}
    assert rows.count() > 0


def test_secrets_in_any_punctuation(spark):
    """Runs with inner equals signs, padding and every ASCII character around them."""
    rng = random.Random(5)
    alphabet = "".join(map(chr, range(32, 127)))
    texts = ["open http://x.org/a?sessionid=ABCDEF1234567890 now", "a=b" * 40, "=" * 60,
             "QUJDREVGR0hJSktMTU5PUA==abcdefgh1234567890", "key=" + "aB3" * 30 + "==="]
    texts += ["".join(rng.choice(alphabet) for _ in range(300)) for _ in range(60)]
    texts += ["".join(rng.choice("AZaz09+/_=-. ") for _ in range(300)) for _ in range(60)]
    rows = find_secrets(table(spark, texts), keep=("doc_id", "text")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        for s in r["spans"]:
            assert 0 <= s["start"] < s["end"] <= len(r["text"])
            if s["kind"] == "random":
                assert re.fullmatch(r"[A-Za-z0-9+/_-]{16,}={0,2}", r["text"][s["start"]:s["end"]])


def test_battery_finds_random_tokens_and_few_others(spark):
    """Planted tokens by length, among identifiers and patterns: power and false discoveries."""
    rng = random.Random(11)
    digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    words = "alpha index value buffer table counter handler request session module parser".split()

    def name():
        return "".join(rng.choice(words).capitalize() for _ in range(6)) + str(rng.randrange(99))

    planted = {n: ["".join(rng.choice(digits) for _ in range(n)) for _ in range(40)] for n in (32, 48, 90)}
    others = [name() for _ in range(300)]
    others += ["abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "aB1" * 20, "a" * 40 + "1B",
               "0123456789abcdef0123456789abcdeF"]
    tokens = [(t, n) for n, ts in planted.items() for t in ts] + [(t, 0) for t in others]
    plain = "the quick brown fox jumps over a lazy dog while seven wizards box with mighty power".split()
    texts = [" ".join(rng.choices(plain, k=60)) + " " + t + " " + " ".join(rng.choices(words, k=60))
             for t, _ in tokens]
    found = by_id(find_secrets(table(spark, texts), keep=("doc_id", "text")))
    hits = {n: 0 for n in (*planted, 0)}
    for i, (token, n) in enumerate(tokens):
        at = texts[i].index(token)
        hits[n] += any(s["kind"] == "random" and s["start"] == at and s["end"] == at + len(token)
                       for s in found[i]["spans"])
    # 32 digits differ too little from words for the chi-squared test among so many identifiers.
    assert hits[90] >= 39 and hits[48] >= 32, hits
    assert hits[0] <= 0.02 * sum(hits.values()), hits


def test_the_battery_is_fair():
    """Over digits drawn like ordinary text p-values are not too small, e-values not too large."""
    from meterlens.llm.secrets import evidence, order_log_e

    rng = np.random.default_rng(3)
    for concentration in (0.3, 2.0):
        frequencies = rng.dirichlet(np.full(64, concentration))
        for n in (20, 50, 100):
            drawn = [rng.choice(64, n, p=frequencies) for _ in range(3000)]
            assert np.mean([math.exp(order_log_e(v, frequencies)) for v in drawn]) < 1.1
            strong = np.array([evidence(v, frequencies) for v in drawn])
            assert np.mean(strong >= 1) <= 0.12 and np.mean(strong >= 2) <= 0.015
    random_digits = [rng.integers(0, 64, 64) for _ in range(300)]
    skewed = np.where(np.arange(64) < 12, 0.95 / 12, 0.05 / 52)
    assert np.mean([evidence(v, skewed) > 3 for v in random_digits]) > 0.95
    patterns = [np.arange(62), np.tile([0, 26, 53], 20), np.repeat([3, 40], 20), np.arange(64)[::-1]]
    assert max(evidence(v, skewed) for v in patterns) < 0.5


def test_cover_ranks_and_sorted_windows():
    """Ranks of the cover positions order as their bytes do; windows as one by one."""
    from meterlens.llm.suffixes import COVER, LENGTH, cover_ranks, sorted_repeats

    rng = np.random.default_rng(9)
    for trial in range(30):
        parts = [rng.integers(97, 97 + int(rng.integers(1, 4)), int(rng.integers(LENGTH, 400))).astype(np.uint8)
                 for _ in range(int(rng.integers(1, 8)))]
        parts += [np.concatenate([parts[0][-60:], parts[-1][:70]]), parts[0].copy(), np.zeros(120, np.uint8)]
        text = np.concatenate(parts)
        data = text.tobytes()
        rank = cover_ranks(text)
        places = [p for p in range(len(data) - COVER + 1) if p % 3]
        by_bytes = {w: i for i, w in enumerate(sorted({data[p:p + COVER] for p in places}))}
        assert [by_bytes[data[p:p + COVER]] for p in places] == rank[places].tolist()
        offsets = np.cumsum([0, *map(len, parts)])[:-1]
        starts = np.concatenate([o + np.arange(len(p) - LENGTH + 1) for o, p in zip(offsets, parts)])
        docs = np.repeat(rng.integers(0, 6, len(parts)), [len(p) - LENGTH + 1 for p in parts])
        least = {}
        for at, doc in zip(starts.tolist(), docs.tolist()):
            w = data[at:at + LENGTH]
            least[w] = min(doc, least.get(w, doc))
        wanted = [doc > least[data[at:at + LENGTH]] for at, doc in zip(starts.tolist(), docs.tolist())]
        assert sorted_repeats(text, starts, docs).tolist() == wanted
