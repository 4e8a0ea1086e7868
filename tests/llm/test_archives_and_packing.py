import gzip
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from sievework.llm import packing, warc
from sievework.llm.common import new_path

PAGES = "page_id long, url string, html string, n int, payload string, header string"


def pages():
    trap = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\nWARC/1.1\r\n"
    long = "<p>é" + "x" * 2000
    data = [(1, "http://a", long), (2, "http://b", long), (9, None, long), (3, "http://c\r\nX: y", "small"), (4, "http://d", "small"), (5, "http://e", ""), (6, "http://f", None), (7, "http://g", trap * 20), (8, "http://h", "\r\n\r\n" * 600), (10, "http://i", "y" * 300_000), (11, "http://j", "e" * 1000), (12, "http://k", "e" * 1000), (13, "l", "é" * 500), (14, "l", "é" * 500), (15, "l", "q" * 999), (16, "l", "q" * 999)]
    return [(*r, 0, "p", "h") for r in data]


def wanted(rows):
    by = defaultdict(list)
    for i, _, h, *_ in rows:
        by[h or ""].append(i)
    out = []
    for i, _, h, *_ in rows:
        body, top = (h or "").encode(), max(by[h or ""])
        old = len(body) >= 1000 and i < top
        out.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if old else "response", top if old else None))
    return sorted(out)


def test_roundtrip(spark):
    df = spark.createDataFrame(pages(), PAGES).repartition(3)
    assert sorted(tuple(r) for r in warc.roundtrip(df).collect()) == wanted(pages())
    assert warc.roundtrip(spark.createDataFrame([], PAGES)).count() == 0


def test_rows_that_stand_twice(spark):
    df = spark.createDataFrame(pages() + pages()[:3], PAGES)
    assert sorted(tuple(r) for r in warc.roundtrip(df).collect()) == wanted(pages() + pages()[:3])


def test_null_ids(spark, monkeypatch):
    long, other = "n" * 1500, "m" * 1500
    data = [(None, "u", long), (4, "u", long), (None, "u", "short"), (3, "u", "short"), (None, None, other), (None, "v", other), (None, None, None)]
    df = spark.createDataFrame([(*r, 0, "p", "h") for r in data], PAGES)
    sha = lambda x: hashlib.sha1(x.encode()).hexdigest()
    want = [(None, 1500, sha(long), "revisit", 4), (4, 1500, sha(long), "response", None)]
    want += [(i, 5, sha("short"), "response", None) for i in (None, 3)] + [(None, 1500, sha(other), "response", None)] * 2 + [(None, 0, sha(""), "response", None)]
    assert sorted((tuple(r) for r in warc.roundtrip(df).collect()), key=str) == sorted(want, key=str)
    # the one row that holds a payload has no id
    alone = df.where("page_id is null")
    assert warc.roundtrip(alone).where("payload_bytes = 1500 and record_type = 'response'").count() == 3


def test_files_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK_BYTES", 1 << 16)
    monkeypatch.setattr(warc, "FILE_CHUNKS", 2)
    rng = np.random.default_rng(0)
    big = [(i, "u", rng.bytes(30_000).hex(), 0, "p", "h") for i in range(40)] + [(99, "u", "x" * (1 << 24), 0, "p", "h")]
    df = spark.createDataFrame(big, PAGES).repartition(1)
    path = new_path(spark, "t")
    warc.store(df, f"{path}/store")
    warc.write_files(warc.restore(spark, f"{path}/store"), f"{path}/files")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/files").collect()
    assert len(files) > 5 and max(f["length"] for f in files) < 2 * ((1 << 16) + 60_000)
    heads = 0
    for f in files:
        # members can be unzipped one by one, and each begins a record but those of a very long one
        rest = bytes(f["content"])
        while rest:
            z = zlib.decompressobj(31)
            heads += z.decompress(rest).startswith(b"WARC/1.1\r\n")
            assert z.eof
            rest = z.unused_data
    assert heads == 41
    got = {r["page_id"]: bytes(r["payload"]).decode() for r in warc.read_files(spark, f"{path}/files").collect()}
    assert got == {r[0]: r[2] for r in big}


def test_many_copies_use_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_IDS", 1)
    assert sorted(tuple(r) for r in warc.roundtrip(spark.createDataFrame(pages(), PAGES)).collect()) == wanted(pages())


def test_payloads_are_stored_once_and_restored_exactly(spark):
    path = new_path(spark, "t")
    warc.store(spark.createDataFrame(pages(), PAGES), path)
    assert spark.read.parquet(f"{path}/payloads").count() == len({h or "" for _, _, h, *_ in pages()})
    got = {r["page_id"]: bytes(r["payload"]) for r in warc.restore(spark, path).collect()}
    assert got == {i: (h or "").encode() for i, _, h, *_ in pages()}
    heads = {r["page_id"]: r["header"] for r in spark.read.parquet(f"{path}/headers").collect()}
    assert "WARC-Refers-To: <urn:page:9>" in heads[1] and "\r\nX: y" not in heads[3] and heads[1].endswith("\r\n\r\n")
    bad = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.concat("payload", F.lit(b"!")))
    bad.write.parquet(f"{path}x/payloads")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{path}x/headers")
    with pytest.raises(Exception, match="does not match its digest"):
        warc.restore(spark, f"{path}x").select(F.sum(F.length("payload"))).collect()


def test_a_damaged_record_is_noticed():
    head = b"WARC/1.1\r\nContent-Length: 3\r\n\r\n"
    assert [b for _, b in warc.parse(head + b"abc\r\n\r\n" + head + b"def\r\n\r\n")] == [b"abc", b"def"]
    with pytest.raises(ValueError, match="Content-Length"):
        list(warc.parse(head + b"abcd\r\n\r\n"))
    with pytest.raises(ValueError, match="Content-Length"):
        list(warc.parse(head + b"ab"))
    assert gzip.decompress(gzip.compress(b"x")) == b"x"


def test_pieces_are_binary():
    for n in (1, 2, 3, 1023, 1024, 1025, 5000):
        got = packing.piece_lengths(n)
        assert sum(got) == n and all(x & (x - 1) == 0 and x <= 1024 for x in got) and got == sorted(got, reverse=True)


def test_ids_are_those_of_the_tokenizer(spark, docs, rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: [*t.encode(x or "", add_special_tokens=False).ids, 0] for i, x, *_ in rows}
    got = defaultdict(dict)
    seen = set()
    for r in packing.pack(docs).collect():
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert len(ids) == r["length"] and zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and r["offset"] == 0
        assert r["doc_tokens"] == len(want[r["doc_id"]]) and r["sequence_id"] not in seen
        seen.add(r["sequence_id"])
        got[r["doc_id"]][r["start"]] = ids
    assert {i: [x for s in sorted(p) for x in p[s]] for i, p in got.items()} == want
    assert seen == set(range(len(seen)))


def test_long_white_space_has_the_ids_of_the_tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [f"{a}{gap * k}{b}" for a in ("", "a", "it's", "\x1c", ".", "\u4e2d") for gap in (" ", "\n", " \t", "\u3000", "\x1c", "\x85", "\u200b") for k in (1, 2, 9) for b in ("", "b", " c", "\u00e9", "\x1c", "'s", "_1", "\u0301")]
    encode = packing.Encoder(packing.default_vocabulary())
    for x in [*texts, " ".join(texts), "a" + " " * 1_200_000 + "b", "a b " * 100_000]:
        assert encode(x) == np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes()


def test_a_full_store_changes_no_ids(rows):
    small, large = packing.Encoder(packing.default_vocabulary(), stored=40, at_once=7), packing.Encoder(packing.default_vocabulary())
    for _, x, *_ in rows:
        assert small(x or "") == large(x or "")
        assert small.size <= 40 + 7 * max(map(len, (x or "").split(" ")), default=0)


def test_special_tokens_in_texts_have_the_ids_of_the_tokenizer(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng, end = random.Random(2), "<|endoftext|>"
    texts = [f"a {end} b", end, end * 2, f"{end}x", f"x{end}", f" {end} ", f"\n{end}\n\n{end}\t", f"<|endoftext{end}|>", "<|endoftext|", "<|ENDOFTEXT|>", f"é{end}é"]
    parts = [end, end, " ", "  ", "\n", "a", "it's", "12", "é", "<|", "|>", "\x1c", "word"]
    texts += ["".join(rng.choices(parts, k=rng.randrange(12))) for _ in range(3000)]
    encode = packing.Encoder(packing.default_vocabulary())
    for x in texts:
        assert encode(x) == np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes()
    df = spark.createDataFrame(list(enumerate(texts[:50])), "doc_id long, text string")
    got = {r["doc_id"]: r["doc_tokens"] for r in packing.pack(df, with_ids=False).collect()}
    assert got == {i: len(t.encode(x, add_special_tokens=False).ids) + 1 for i, x in enumerate(texts[:50])}


def test_sequences_are_numbered_by_bucket(docs, empty, odd):
    out = packing.pack(docs, with_ids=False).orderBy("sequence_id").collect()
    assert [r["length"] for r in out] == sorted((r["length"] for r in out), reverse=True)
    again = packing.pack(docs.repartition(2), with_ids=False)
    assert sorted(tuple(r) for r in again.collect()) == sorted(tuple(r) for r in out)
    assert packing.pack(empty).count() == 0
    assert sum(r["length"] for r in packing.pack(odd, with_ids=False).collect() if r["doc_id"] == 3) == 1


def test_plain_words_need_the_model_alone_and_the_store_is_trimmed():
    rng = random.Random(3)
    bits = ["the", "naïve", "Ünder", "ñ", "ÿ", "×", "don't", "DOG'S", ",", ".", "...", "***", "!?", "\n", "\n\n", "7", "a1", "_x", "ĳ", "中", "<|endoftext|>", "\xa0", "\xad", "'ll", "-"]
    words = ["".join(rng.choices(bits, k=rng.randint(1, 5))) for _ in range(4000)]
    encode = packing.Encoder(packing.default_vocabulary(), stored=3000)
    for at in range(0, len(words), 50):
        text = " ".join(words[at : at + 50])
        want = encode.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode(text), "<u4").tolist() == want, text
    asked, whole = [], encode._ids
    encode._ids = lambda parts: asked.extend(parts) or whole(parts)
    encode("It begins: hereabouts,\nNowhere... else!! andé é1")
    assert asked == ["It", " é1"]
    encode.trim(40)
    assert 0 < encode.size == sum(map(len, encode.store)) <= 40
