import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from postlens.llm import rank_bpe, token_files
from postlens.llm.chunk_tokens import ChunkEncoder
from postlens.llm.memo import Memo
from postlens.llm.queries import tokenizer
from postlens.llm.store import fresh_path

PARTS = ["a", "B", "é", "é", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "'s", "'RE", "9", "Σ", "İ", "ſ", "<|endoftext|>", "<|startoftext|>",
         "<|", "日本", "👍🏽", "​", "　", "!", ",", ".", "#", "\r\n", "́", "ﬁ", "²", "\x00", "_", "the", "ing"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(0)
    made = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    return made + ["".join(rng.choice("abcdeth") for _ in range(n)) for n in (30, 31, 32, 33, 34, 500)]


def test_equal_to_the_library(texts):
    for name, spaced in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        whole, own = Tokenizer.from_file(tokenizer(name)), ChunkEncoder(tokenizer(name), spaced, "<u2")
        for text in texts:
            assert np.frombuffer(own.encode(text), "<u2").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_rank_bpe_round_trip(texts):
    path = tokenizer("word_bpe_49k.json")
    whole, own = Tokenizer.from_file(path), rank_bpe.RankBpe(path)
    for text, (ids, decoded) in zip(texts, own.round_trips(texts), strict=True):
        expected = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected, text
        assert decoded == own.decode(expected) == whole.decode(expected, skip_special_tokens=False)


def test_memo_is_bounded():
    calls = []
    memo = Memo(lambda k: calls.append(k) or len(k), most=3, longest=5)
    assert [memo[k] for k in ("a", "b", "c", "d", "a", "e", "toolong")] == [1, 1, 1, 1, 1, 1, 7]
    assert calls == ["a", "b", "c", "d", "e", "toolong"] and "toolong" not in memo and len(memo) <= 3


def test_rank_bpe_frames(odd_docs, no_docs):
    path = tokenizer("word_bpe_49k.json")
    docs = odd_docs.withColumnRenamed("spans", "ids")
    whole = Tokenizer.from_file(path)
    split = rank_bpe.decode(rank_bpe.encode(docs.select("doc_id", "text"), path), path, out="decoded")
    both = rank_bpe.round_trip(docs.select("doc_id", "text"), path)
    a, b = sorted(map(str, split.collect())), sorted(map(str, both.collect()))
    assert a == b and len(a) == docs.count()
    texts = sorted(str(whole.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect())
    assert sorted(str(list(r.ids)) for r in both.collect()) == texts
    assert rank_bpe.encode(no_docs, path).count() == 0 and "ids" in rank_bpe.encode(docs, path, out="tokens").columns


def test_token_files(spark, odd_docs, no_docs):
    path = tokenizer("word_bpe_49k.json")
    out = fresh_path(spark, "test-tokens")
    manifest = token_files.write_tokens(odd_docs.repartition(5), out, path, end_id=1)
    rows = sorted(token_files.read_tokens(spark, out).collect(), key=lambda r: r.start)
    assert manifest.agg({"n_docs": "sum"}).first()[0] == len(rows) == odd_docs.count()
    whole = Tokenizer.from_file(path)
    expected = sorted(((r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or "") for r in odd_docs.collect()))
    start = 0
    for r, (known, doc, _, text) in zip(rows, expected, strict=True):
        ids = np.array(whole.encode(text, add_special_tokens=False).ids + [1], "<u4").tobytes()
        assert (r.doc_id, r.start, r.n_tokens, bytes(r.ids)) == (doc if known else None, start, len(ids) // 4, ids)
        assert zlib.crc32(r.ids) == zlib.crc32(ids)
        start += r.n_tokens
    none = fresh_path(spark, "test-tokens")
    token_files.write_tokens(no_docs, none, path, end_id=1)
    assert token_files.read_tokens(spark, none).count() == 0


def test_long_chunks_are_not_kept():
    held = rank_bpe.RankBpe(tokenizer("word_bpe_49k.json"))
    texts = ["x" * 5000 + str(i) for i in range(20)] + ["short words", "y" * 65]
    first = held.round_trips(texts)
    assert held.chunks and max(map(len, held.chunks)) <= rank_bpe.LONGEST_CHUNK
    assert held.round_trips(texts) == first


def test_columns_named_like_outputs(spark):
    path = tokenizer("word_bpe_49k.json")
    docs = spark.createDataFrame([(1, "a b", "old", "old")], "doc_id long, text string, ids string, decoded string")
    for made in (rank_bpe.encode(docs, path), rank_bpe.round_trip(docs, path), rank_bpe.decode(rank_bpe.encode(docs, path), path, out="decoded")):
        assert len(set(made.columns)) == len(made.columns) and len(made.first().ids) == 2


def test_one_id_spreads_over_shards(spark):
    path = tokenizer("word_bpe_49k.json")
    docs = spark.createDataFrame([(None if i % 3 else 7, f"{i % 97} text {i}") for i in range(2000)], "doc_id long, text string").repartition(4)
    out, coalesce = fresh_path(spark, "test-tokens"), "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    manifest = token_files.write_tokens(docs, out, path, end_id=1).collect()
    spark.conf.set(coalesce, "true")
    assert len(manifest) > 2 and max(m["n_docs"] for m in manifest) < 1333
    rows = sorted(token_files.read_tokens(spark, out).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None] * 1333 + [7] * 667


def test_slices_of_texts_equal_the_library(texts):
    for name, spaced in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        whole, own = Tokenizer.from_file(tokenizer(name)), ChunkEncoder(tokenizer(name), spaced, "<u2")
        for some in (texts, texts[:1], ["", "", "a"], [""], []):
            ids, at = own.encode_many(some)
            assert len(at) == len(some) + 1 and at[0] == 0 and at[-1] == len(ids)
            for text, a, b in zip(some, at, at[1:]):
                assert ids[a:b].tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_a_word_of_a_slice_is_looked_up_once(monkeypatch):
    own, seen = ChunkEncoder(tokenizer("word_bpe_49k.json"), False, "<u2"), []
    told_apart = own.told_apart
    monkeypatch.setattr(own, "told_apart", lambda piece: seen.append(piece) or told_apart(piece))
    own.encode_many(["the sea, the\nsea"] * 100)
    assert sorted(seen) == ["sea", "sea,", "the"]


def test_new_words_of_a_slice_take_one_call(monkeypatch):
    own, seen = ChunkEncoder(tokenizer("byte_bpe_50k.json"), True, "<u4"), []
    assert own.by_letters
    for name in ("library_ids", "letter_ids"):
        plain = getattr(own, name)
        monkeypatch.setattr(own, name, lambda x, plain=plain: seen.append(x) or plain(x))
    texts = ["The sea, the\nsea é9 the sea."] * 100
    ids, at = own.encode_many(texts)
    whole = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    assert all(ids[a:b].tolist() == whole.encode(t, add_special_tokens=False).ids for t, a, b in zip(texts, at, at[1:]))
    assert [sorted(x) for x in seen if isinstance(x, list)] == [["sea", "the"]] and len(seen) <= 3


def test_words_of_letters_equal_the_library():
    rng = random.Random(3)
    own, whole = ChunkEncoder(tokenizer("byte_bpe_50k.json"), True, "<u4"), Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    words = sorted({"".join(rng.choices("abcdeghinorstuyABéßñ日本Σªا", k=rng.randint(1, 14))) for _ in range(3000)})
    pieces = words + [w + ".,"[k % 2] for k, w in enumerate(words)] + ["\n" + w for w in words] + [w + "\u00a0x" for w in words[:50]]
    for piece, ids in zip(pieces, own.spaced_pieces(pieces), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(piece if piece[0] == "\n" else " " + piece, add_special_tokens=False).ids, piece
    assert own.spaced_pieces(["", "\n", " a", "a\t", "\n\n", "\x85"]) == [False] * 6
