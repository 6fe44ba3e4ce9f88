"""Token counts, byte-level BPE and id files against the libraries themselves."""

import base64
import hashlib
import pickle
import random
import tracemalloc
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from vantage.llm import bytebpe, pieces, planes
from vantage.llm.keys import QUERIES
from vantage.llm.merges import merge_pairs

from .conftest import SCHEMA, odd_texts

PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


def texts(n, seed, pool):
    choose = random.Random(seed)
    return ["".join(choose.choice(pool) for _ in range(choose.randint(0, 30))) for _ in range(n)]


@pytest.fixture(scope="module")
def tiktoken_encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def words_library():
    return Tokenizer.from_file(WORDS)


def test_merge_takes_lowest_rank_then_leftmost():
    assert merge_pairs(list("aaa"), {"aa": 1}) == (["aa", None, "a"], 1)
    assert [s for s in merge_pairs(list("abcd"), {"ab": 5, "bc": 1, "bcd": 2, "abcd": 9})[0] if s] == ["abcd"]
    assert merge_pairs([], {"aa": 1}) == ([], 0)


def test_short_and_long_slices_merge_alike(monkeypatch):
    coder = bytebpe.BytePairs(RANKS)
    some = [t.encode() for t in texts(2000, 6, list("abcdeinorst") + ["the", "ing", "é"]) if t]
    short = [coder.merge(t) for t in some]
    monkeypatch.setattr(bytebpe, "SHORT", 0)
    assert [coder.merge(t) for t in some] == short


def test_counts_equal_sentencepiece():
    library, counter = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.PieceCounter(PIECES)
    pool = list("  \n\tabtheionr.,'!<s>/▁日𠮷é0123 ") + ["<unk>", "</s>", "▁▁", "　", "\x00", " the"]
    for t in texts(4000, 1, pool):
        assert counter.count(t) == len(library.encode(t)), repr(t)


@pytest.mark.parametrize("c", ["\ufffd", "\t", "😀", "\x00", "。"])
def test_long_rows_of_one_character(c):
    library, counter = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.PieceCounter(PIECES)
    for t in (c * 100_000, "word" + c * 100_000, "a  " + c * 3000 + "end " + c * 3000):
        assert counter.count(t) == len(library.encode(t))


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBER", 5)
    counter = pieces.PieceCounter(PIECES)
    counter.count(" ".join(f"w{k}" for k in range(100)))
    assert len(counter.spaced) <= 5


def test_slices_equal_the_pattern():
    import regex

    pattern = regex.compile(public_tokenizers.PATTERN)
    for t in texts(4000, 2, list("  \n\tabestmdrvl'''e日é01²Ⅷ.,!\xa0　\x85\x1c") + ["'re", "'ll", "\r\n", " the"]):
        assert bytebpe.slices(t) == pattern.findall(t), repr(t)


def test_every_codepoint_class(tiktoken_encoding):
    coder = bytebpe.BytePairs(RANKS)
    some = [f"a{chr(c)}a1{chr(c)}1!{chr(c)}! {chr(c)}" for c in range(0, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    for t, ids in zip(some, coder.encode_all(some), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tiktoken_encoding.encode_ordinary(t), repr(t)


def test_every_codepoint_before_a_contraction(tiktoken_encoding):
    """Letters, numbers and others before 's, which is a match of its own after the first two only."""
    coder = bytebpe.BytePairs(RANKS)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    some = ["".join(f"{chr(c)}'s a{chr(c)}1" for c in points[k:k + 512]) for k in range(0, len(points), 512)]
    for t, ids in zip(some, coder.encode_all(some), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tiktoken_encoding.encode_ordinary(t), hex(ord(t[0]))


def test_transition_functions_compose_associatively():
    n = len(bytebpe.THEN)
    a, b, c = np.meshgrid(*[np.arange(n)] * 3)
    assert (bytebpe.THEN[bytebpe.THEN[a, b], c] == bytebpe.THEN[a, bytebpe.THEN[b, c]]).all()


def test_round_trip_and_ranges(tiktoken_encoding):
    coder = bytebpe.BytePairs(RANKS)
    pool = list("  \n\tabestmdrvl'e日é01.,!\xa0") + ["'re", "<|endoftext|>", " the"]
    some = texts(2000, 3, pool) + ["".join(texts(3000, 4, pool))]
    for t, ids in zip(some, coder.encode_all(some), strict=True):
        raw, ends = t.encode(), coder.ends(ids)
        assert np.frombuffer(ids, "<u4").tolist() == tiktoken_encoding.encode_ordinary(t)
        assert coder.decode(ids) == raw
        a = len(raw) // 3
        assert coder.decode_range(ids, ends, a, 2 * a) == raw[a:2 * a]


def test_byte_bpe_over_odd_rows(odd, empty, tiktoken_encoding):
    rows = bytebpe.digests(odd, RANKS).collect()
    expected = []
    for i, t in odd_texts():
        ids = tiktoken_encoding.encode_ordinary(t or "")
        expected.append((str(i), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256((t or "").encode()).hexdigest(), "x", 0.5))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256, r.digest, r.score) for r in rows) == sorted(expected)
    back = bytebpe.decode(bytebpe.encode(odd, RANKS, ids="found", ends="to"), RANKS, "found").select("text", "decoded").collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in back)
    assert bytebpe.digests(empty, RANKS).count() == 0
    assert bytebpe.encode(empty, RANKS, ids="a", ends="b").count() == 0


def test_byte_bpe_leaves_no_coder_in_the_workers(odd, spark):
    """Workers are used again by whatever comes next, which needs their memory."""
    def coders(batches):
        import gc
        list(batches)
        gc.collect()
        yield pd.DataFrame({"n": [sum(type(x).__name__ == "BytePairs" for x in gc.get_objects())]})

    bytebpe.digests(odd, RANKS).collect()
    assert {r.n for r in spark.range(0, 64, 1, 16).mapInPandas(coders, "n long").collect()} == {0}


def test_a_sent_coder_gives_the_same_ids_without_what_it_remembered():
    coder = bytebpe.BytePairs(RANKS)
    want = coder.encode_all(["some words here", "and zxqvw"])
    sent = pickle.loads(pickle.dumps(coder))
    assert coder.known and not sent.known
    assert sent.encode_all(["some words here", "and zxqvw"]) == want


def test_counts_over_odd_rows(odd, empty):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = pieces.with_token_counts(odd, PIECES, out="n").collect()
    assert sorted((str(r.doc_id), r.n, r.fp) for r in rows) == sorted((str(i), len(library.encode(t or "")), 7) for i, t in odd_texts())
    assert pieces.with_token_counts(empty, PIECES).columns == [f.name for f in SCHEMA] + ["n_tokens"]
    assert pieces.with_token_counts(empty, PIECES).count() == 0


def test_planes_round_trip():
    for kind in ("byte", "bit"):
        for n in (0, 1, 7, 65536):
            ids = np.random.default_rng(n).integers(0, 2 ** 32, n).astype("<u4")
            frames, ends = planes.shuffle_block(ids, kind)
            assert len(ends) == (4 if kind == "byte" else 32)
            assert (planes.restore_block(frames, ends, n, kind) == ids).all()
    with pytest.raises(ValueError):
        planes.shuffle_block(np.zeros(1, "<u4"), "nibble")


def test_joined_checksums():
    a, b = b"some bytes", bytes(range(256)) * 9
    assert planes.crc32_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert planes.crc32_joined(zlib.crc32(a), 0, 0) == zlib.crc32(a)


def test_words_equal_the_library(words_library):
    encoder = planes.WordEncoder(WORDS)
    pool = list("  \n\tAbeST.,'!é日ÀΣσ0123\xa0　ćक़") + ["'re", "<|endoftext|>", " the", "İ", "ẞ"]
    some = texts(4000, 5, pool)
    for t, ids in zip(some, encoder.encode_all(some), strict=True):
        assert ids.tolist() == words_library.encode(t, add_special_tokens=False).ids, repr(t)


def test_words_forget_and_stay_right(monkeypatch, words_library):
    monkeypatch.setattr(planes, "REMEMBER", 10)
    encoder = planes.WordEncoder(WORDS)
    for k in range(20):
        t = f"one two, three{k} four{k}."
        assert encoder.encode_all([t])[0].tolist() == words_library.encode(t, add_special_tokens=False).ids


def test_words_of_letters_are_learned_in_few_calls(words_library):
    """Joined by spaces alone: no call and no mark for each word."""
    encoder = planes.WordEncoder(WORDS)
    letters = [f"{a}{b}" for a in ("river", "Haus", "señor", "été", "日本", "ǅ", "ﬁ", "ſ", "ß") for b in ("", "x", "ly", "ñ", "語")]
    calls = []
    encoder.library = type("Counted", (), {"encode_batch_fast": lambda self, texts, **k: calls.append(texts) or words_library.encode_batch_fast(texts, **k)})()
    found = encoder.encode_all([" ".join(letters)])[0]
    assert found.tolist() == words_library.encode(" ".join(letters), add_special_tokens=False).ids
    assert len(calls[0]) == 1 and "." not in calls[0][0] and [t for c in calls[1:] for t in c] == []
    # the marks after a known word are asked for once
    calls.clear()
    marked = " ".join(f"{w}{m}" for w in ("river", "Haus", "señor", "été") for m in ("***", "&&&", "!", ").", "%%%%", "'"))
    for _ in range(2):
        assert encoder.encode_all([marked])[0].tolist() == words_library.encode(marked, add_special_tokens=False).ids
    assert len([x for c in calls for x in c]) == 4 + 4 * 2
    # a letter that is no letter in lower case: its words are asked for one by one
    calls.clear()
    for t in ("İzmir one two", "one İ two", "İ"):
        assert encoder.encode_all([t])[0].tolist() == words_library.encode(t, add_special_tokens=False).ids


def test_words_that_differ_by_case_and_marks_are_remembered_once(words_library):
    encoder = planes.WordEncoder(WORDS)
    some = ["River, river RIVER! (river) river", "", " river.\nRiver***", "r\u00edo R\u00edo, \u65e5\u672c. a<b A<B !!! \u0130. x" + "y" * 80 + "?", "\n"]
    for t, ids in zip(some, encoder.encode_all(some), strict=True):
        assert ids.tolist() == words_library.encode(t, add_special_tokens=False).ids, repr(t)
    # before, each form had an entry and was looked up wherever it stood
    assert {w for w in encoder.known if "river" in w.lower()} == {"river", "(river"}
    assert encoder.encode_all([]) == [] and max(map(len, encoder.known)) <= planes.LONGEST


def test_ids_are_put_together_in_little_memory():
    parts = [[], [7], [1, 2, 3], [4, 5]]
    order = np.random.default_rng(3).integers(0, 4, 300_000)
    flat, sizes = np.array(sum(parts, []), "<u4"), np.array([len(p) for p in parts])
    tracemalloc.start()
    ids, n = planes._picked(flat, sizes, order)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ids.tolist() == [i for k in order for i in parts[k]] and n.tolist() == sizes[order].tolist()
    # before, two more numbers of 64 bits for each id
    assert peak < ids.nbytes + n.nbytes + 4_000_000
    assert [x.tolist() for x in planes._picked(flat[:0], sizes[:1], order[:0])] == [[], []]


def expected_files(rows, library):
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((str(i), start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return sorted(out)


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_id_files_over_odd_rows(spark, odd, empty, tmpdir_path, words_library, kind):
    planes.write_ids(odd, tmpdir_path + "/ids", WORDS, 1, kind=kind)
    got = planes.document_checksums(spark, tmpdir_path + "/ids").collect()
    assert sorted((str(r.doc_id), r.start, r.n_tokens, r.ids_crc32) for r in got) == expected_files(odd_texts(), words_library)
    # the long text spans blocks
    blocks = spark.read.parquet(tmpdir_path + "/ids")
    assert blocks.where("n_ids = 65536").count() > 0 and blocks.where("n_ids > 65536").count() == 0
    planes.write_ids(empty, tmpdir_path + "/none", WORDS, 1)
    assert planes.document_checksums(spark, tmpdir_path + "/none").count() == 0


def test_places_pass_32_bits(spark, tmpdir_path, words_library):
    rows = [(k, t) for k, t in enumerate(["one two three", "", "four words of text", None, "long " * 70000, "five six seven"])]
    planes.write_ids(spark.createDataFrame(rows, "doc_id long, text string"), tmpdir_path + "/ids", WORDS, 1)
    blocks, expected = spark.read.parquet(tmpdir_path + "/ids"), expected_files(rows, words_library)
    # the first passes 32 bits inside of a block, which gave negative places, the others failed
    for before in (2 ** 31 - 4, 2 ** 31, 2 ** 33 + 1):
        path = f"{tmpdir_path}/after-{before}"
        blocks.withColumn("first", blocks["first"] + before).write.parquet(path)
        got = planes.document_checksums(spark, path).collect()
        assert sorted((str(r.doc_id), r.start - before, r.n_tokens, r.ids_crc32) for r in got) == expected


def test_queries_on_whole_table(spark, tiktoken_encoding, words_library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = QUERIES["op1_plane_files"](spark, SF).collect()
    assert sorted((str(r.doc_id), r.start, r.n_tokens, r.ids_crc32) for r in got) == expected_files(docs, words_library)
    encoded = {i: tiktoken_encoding.encode_ordinary(t or "") for i, t in docs}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op5_byte_bpe"](spark, SF).collect()}
    assert got == {i: (len(encoded[i]), hashlib.sha256(" ".join(map(str, encoded[i])).encode()).hexdigest(),
                       hashlib.sha256((t or "").encode()).hexdigest()) for i, t in docs}
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op10_token_counts"](spark, SF).collect()}
    assert got == {i: (len((t or "").encode()), n := len(library.encode(t or "")), n > 4096) for i, t in docs}
