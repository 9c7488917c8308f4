"""Archives, the license scan, tokens, packing, toxicity and the pipeline."""

import base64
import gzip
import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import common, packing, toxicity, warc
from tidemark.llm.byte_bpe import decode, encode
from tidemark.llm.common import slices
from tidemark.llm.licenses import NOTICES, notices, scan
from tidemark.llm.packing import pack_documents
from tidemark.llm.registry import QUERIES
from tidemark.llm.token_counts import count_tokens
from tidemark.llm.toxicity import score_toxicity
from tidemark.llm.warc import round_trip

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "\n\n  x", "it's <|endoftext|> here", "ß" * 300, "a" * 5000, "日本語 text 123 !!", "x" * 3 + "\r\n\r\ny"]


def docs(spark, texts):
    return spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")


def table_texts(spark):
    return [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def test_round_trip_of_pages(spark):
    long, url = "<p>" + "x" * 200, "http://www.a.example:80/b?c"
    rows = [(5, url, long), (3, url, long), (9, None, long), (1, url, None), (2, url, "é" * 49), (4, url, "é" * 49)]
    rows += [(6, "u\r\nv", "a\r\n\r\nb" * 40), (None, url, long), (7, url, "é" * 50), (8, url, "é" * 50)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string")
    got = {r["page_id"]: r for r in round_trip(pages, size=300, block=2).collect()}
    first = {5: 3, 9: 3, 8: 7}
    assert len(got) == len(rows)
    for page, _, html in rows:
        data = (html or "").encode()
        own = got[page]
        assert (own["payload_bytes"], own["payload_digest"]) == (len(data), hashlib.sha256(data).hexdigest())
        assert own["refers_to"] == first.get(page)
        assert own["record_type"] == ("revisit" if page in first else "response")
        assert own["payload"] is None if page in first else bytes(own["payload"]) == data
    assert round_trip(pages.where("false")).collect() == []


def test_archives_are_gzip_files_of_records(spark, folder):
    pages = spark.createDataFrame(
        [(1, "http://a.b/c", "<p>" + "x" * 200), (2, None, "<p>" + "x" * 200), (None, "http://a.b/\r\nd", None), (3, "u", "é" * 5_000)],
        "page_id long, url string, html string",
    )
    warc.write_archives(warc.records(pages, 100), folder, 300)
    found = [tuple(r)[1:] for r in warc.captures(spark, folder).collect()]
    assert sorted((page, key) for page, key, *_ in found if page) == [(1, "b,a)/c"), (2, ")"), (3, "u)")]
    contents = {r["archive"]: bytes(r["content"]) for r in warc.archives(spark, folder).collect()}
    assert len(contents) > 1
    for page, _, archive, start, length in found:
        fields, payload = warc.told(gzip.decompress(contents[archive][start : start + length]))
        assert fields[b"WARC-Type"] == (b"revisit" if page == 2 else b"response")
        assert len(payload) == {1: 203, 2: 0, 3: 10_000, None: 0}[page]
    # Members lie end to end: any GZIP reader reads a whole archive.
    assert sum(gzip.decompress(data).count(b"WARC/1.1\r\n") for data in contents.values()) == 4


def test_records_of_several_members(spark, monkeypatch):
    long = "".join(random.Random(1).choices("abc<>", k=(1 << 24) + 1000))
    pages = [(1, "http://a/", long), (2, "http://b/", "short"), (3, "http://c/", long)]
    got = {r["page_id"]: r for r in round_trip(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert bytes(got[1]["payload"]).decode() == long and got[3]["refers_to"] == 1
    for size, feed in ((40, 7), (1 << 24, 1 << 16)):
        monkeypatch.setattr(warc, "MEMBER", size)
        monkeypatch.setattr(warc, "FEED", feed)
        records = [b"WARC/1.1\r\nContent-Length: %d\r\n\r\n" % n + b"y" * n for n in (0, 3, 500)]
        data = b"".join(map(warc.members, records))
        places = [(start, length) for start, length, _ in warc.records_in(memoryview(data))]
        assert [gzip.decompress(data[start : start + length]) for start, length in places] == records


def test_license_scan(spark):
    filler = " ".join(f"word{i}" for i in range(300))
    texts = [f"{filler}\n{notice}\n{filler}" for _, notice in NOTICES] + [filler, None, "", "Licensed under"]
    got = [(r["doc_id"], r["template"], r["contained"]) for r in scan(docs(spark, texts), notices(spark)).collect()]
    assert sorted(got) == [(i, name, 1.0) for i, (name, _) in enumerate(NOTICES)]
    assert scan(docs(spark, texts), notices(spark).where("false")).collect() == []


def test_encoding_and_decoding(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ODD + table_texts(spark)
    encoded = encode(docs(spark, texts), path, public_tokenizers.PATTERN)
    for row in decode(encoded, path, keep=("doc_id", "ids")).collect():
        text = texts[row["doc_id"]] or ""
        assert np.frombuffer(row["ids"], "<u4").tolist() == library.encode_ordinary(text)
        assert bytes(row["decoded"]) == text.encode()


def test_token_counts(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, texts = Tokenizer.from_file(path), ODD + table_texts(spark)
    for row in count_tokens(docs(spark, texts), path).collect():
        text = texts[row["doc_id"]] or ""
        assert row["n_tokens"] == len(library.encode(text, add_special_tokens=False).ids)
        assert row["n_bytes"] == len(text.encode())


def check_packing(pieces, texts, ids_of):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(texts)
    for key, own in by_doc.items():
        ids, at = ids_of(texts[key]), 0
        for r in sorted(own, key=lambda r: r["start"]):
            part = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(part))
            at += r["length"]
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= 2048


@lru_cache(maxsize=1)
def word_tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(text):
    return word_tokenizer().encode(text or "", add_special_tokens=False).ids + [1]


def test_packing(spark):
    texts = dict(enumerate(ODD + table_texts(spark)[:80]))
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = pack_documents(docs(spark, list(texts.values())), path).selectExpr("*", "crc32(ids) AS ids_crc32").collect()
    check_packing(pieces, texts, ids_of)


def test_words_equal_the_library_with_any_memory(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    library, rng = Tokenizer.from_file(path), random.Random(3)
    texts = ["<|endoftext|> a", "a<|startoftext|>", "(word's)", "", "a " * 50]
    for letters in ("ab'sdé́̀  \n\t\x01\x00<|endoftext|>1!\u200d\U0001f600ﬁÅ가 ", "aZ'std éÉßẞÅKſ.,!'`^~ÀÿÞ×÷µªº\x1c\x85\xa0"):
        texts += ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(3000)]
    want = [library.encode(text, add_special_tokens=False).ids for text in texts]
    for memory in (1 << 19, 10):
        monkeypatch.setattr(packing, "MEMO", memory)
        own = packing.Words(path)
        for start in range(0, len(texts), 700):
            ids, at = own.ids(pa.array(["xx yy", *texts[start : start + 700]]).slice(1))
            assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == want[start : start + 700]
        assert len(own.memo) <= memory


def test_plain_words_are_not_matched(monkeypatch):
    path, pattern, matched = public_tokenizers.path("word_bpe_49k.json"), packing.PARTS, []

    class Noted:
        @staticmethod
        def fullmatch(word):
            matched.append(word)
            return pattern.fullmatch(word)

    monkeypatch.setattr(packing, "PARTS", Noted)
    text = "Plain WORDS, plain words don't (straße) 7th Plain"
    ids, _ = packing.Words(path).ids(pa.array([text]))
    assert ids.tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert sorted(matched) == ["(straße)", "7th", "WORDS,", "don't"]


def test_rare_words_of_neighbouring_texts_are_merged_once(monkeypatch):
    monkeypatch.setattr(packing, "MEMO", 10)
    own, merged = packing.Words(public_tokenizers.path("word_bpe_49k.json")), Counter()
    letters = own._merged
    monkeypatch.setattr(own, "_merged", lambda word: merged.update([word]) or letters(word))
    rare = ["".join(w) for w in itertools.product("abcdefgh", repeat=4)]
    text = " ".join(rare * 70)  # 1.4 MB
    for _, texts in slices(pa.array([text, text]), packing.AT_ONCE):
        own.ids(texts)
    assert set(merged.values()) == {1} and len(merged) == len(rare)


def test_a_worker_remembers_one_thing():
    common.forget()
    path = public_tokenizers.path("word_bpe_49k.json")
    held = packing.words(path)
    assert packing.words(path) is held
    other = common.remembered(("other",), list)
    assert common.remembered(("other",), list) is other
    assert packing.words(path) is not held
    common.forget()


def test_slices_hold_all_texts_once():
    texts = ["", "a" * 30, "b" * 4, "c" * 6, "d", "", "e" * 11, ""]
    found = [(k, part.to_pylist()) for k, part in slices(pa.array(["x", *texts]).slice(1), 10)]
    assert [text for _, part in found for text in part] == texts
    assert [k for k, _ in found] == [0, 1, 2, 4, 6, 7]
    assert list(slices(pa.array([], pa.string()), 10)) == []


def test_padding_and_repeated_rows(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [(i % 300, f"row {i % 7} " * (1 + i % 400), 0) for i in range(900)]
    table = spark.createDataFrame(rows, "doc_id long, text string, start int").coalesce(1)
    pieces = pack_documents(table, path)
    counts = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    tokens, windows = sum(r["n"] for r in counts), len(counts)
    assert max(r["n"] for r in counts) <= 2048
    assert tokens == sum(n * len(ids_of(text)) for text, n in Counter(t for _, t, _ in rows).items())
    # A window more than the tokens need, or one in a hundred.
    assert windows <= max(-(-tokens // 2048) + 1, 1.01 * tokens / 2048)
    assert pack_documents(table.where("false"), path).collect() == []


def test_toxicity_on_held_out_rows(spark):
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("aeioustrm"), 6)) for _ in range(300)]
    texts = [None, ""] + [" ".join(rng.choice(words, 20)) for _ in range(600)]
    insults = ["blockhead", "nitwit", "dullard"]
    toxic = [i % 4 == 0 for i in range(len(texts))]
    texts = [f"{t} you {insults[i % 3]} here" if bad and t else t for i, (t, bad) in enumerate(zip(texts, toxic, strict=True))]
    labels = spark.createDataFrame([(i, 1, int(b)) for i, b in enumerate(toxic)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in score_toxicity(docs(spark, texts), labels).collect()}
    assert len(got) == len(texts)
    for i, row in got.items():
        assert row["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.7)
        assert row["predicted"] == int(toxic[i] and bool(texts[i]))
    none = score_toxicity(docs(spark, texts), labels.where("false")).collect()
    assert {r["score"] for r in none} == {0.0}


def test_decisions_equal_the_kernel():
    """All at once, by fingerprints and sums, as one by one over the features of each string."""
    rng = random.Random(1)
    word = lambda a, b, letters="abcdefgh": "".join(rng.choices(letters, k=rng.randint(a, b)))
    toxic = [("^" + word(4, 12), 1.0 + i % 3) for i in range(60)]
    clean = [("^" + word(4, 12, "efghijk"), 1.0) for _ in range(90)]
    machine = toxicity.Machine(toxic, clean)
    words = [word(1, 14) for _ in range(300)] + [word(20, 90) for _ in range(20)] + ["a" * 12, "", "é\U0001f600xyzabc", "ab"]

    def decision(text):
        return machine.bias + sum(x * machine.weights.get(key, 0.0) for key, x in toxicity.subsequences(text).items())

    want = [max(decision(s) for s in toxicity.strings_of(w)) for w in words]
    assert np.allclose(machine.judge_words(words), want, atol=1e-12)
    assert np.allclose(machine.judge(["", "a", "^abc", "^abcd"]), [decision(s) for s in ("", "a", "^abc", "^abcd")], atol=1e-12)
    assert machine.judge_words([]) == []


def test_toxicity_of_odd_rows(spark):
    """Null ids, repeated rows, very long words and texts; labels that no text has."""
    rng = random.Random(2)
    words = ["".join(rng.choices("aeioustrm", k=6)) for _ in range(200)]
    rows = [(i, " ".join(rng.choices(words, k=15)) + (" blockhead numbskull" if i % 4 == 0 else ""), 1) for i in range(400)]
    rows += [(None, rows[4][1], 1), (None, None, 1), rows[8], rows[8], (1000, "x" * 200_000, 1), (1001, "blockhead " * 50_000, 1)]
    table = spark.createDataFrame(rows, "doc_id long, text string, score int").repartition(4)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(None, 1), (5000, 1)], "doc_id long, toxic int")
    got = score_toxicity(table, labels).collect()
    assert len(got) == len(rows)
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False, False]
    assert len({(r["score"], r["predicted"]) for r in got if r["doc_id"] == 8}) == 1
    scores = {r["doc_id"]: r["score"] for r in got if r["doc_id"] is not None}
    assert scores[1000] < 0.7 and min(scores[i] for i in range(0, 400, 4)) > max(scores[i] for i in range(1, 400, 4))
    assert score_toxicity(table.where("false"), labels).collect() == []


def test_pipeline(spark):
    found = corpus_pipeline.run(spark, SF).collect()
    scores = {r["doc_id"]: r["predicted"] for r in QUERIES["op6_toxicity"](spark, SF).collect()}
    assert found and all(scores[r["doc_id"]] == 0 for r in found)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard", "remove_repeats", "packing"]


def test_cut_characters_go_whole(spark):
    cut = ["a\u00e9b".encode()[:2], "\u20ac\ufffd\uffff".encode()[1:], b"\xf0\x9f\x98x\xbf", "\uffff1\ufffd0".encode(), b""]
    frame = spark.createDataFrame([(i, bytearray(data)) for i, data in enumerate(cut)], "i long, d binary")
    got = {r["i"]: r["t"] for r in frame.select("i", corpus_pipeline.whole_characters(F.col("d")).alias("t")).collect()}
    assert got == {i: data.decode("utf-8", "ignore") for i, data in enumerate(cut)}
