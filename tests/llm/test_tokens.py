"""Token counts and byte-level BPE against the libraries, on odd texts and a whole small table."""
import random
from collections import Counter

import pytest
import regex

public_tokenizers = pytest.importorskip("public_tokenizers")
import tiktoken  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from retail_analytics.llm import bpe, token_count  # noqa: E402

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
BITS = ["a", "é", "  ", "\n", "   ", "'s", "1", "the", "　", "日本", "!!", " ", "\t", "aaaaaaaa", "ing", "\U0001f600", "<|endoftext|>", "̀"]
SF = "/root/testdata/sf0.001"


def texts(n=150, most=120):
    rnd = random.Random(2)
    return ["".join(rnd.choices(BITS, k=rnd.randint(0, most))) for _ in range(n)]


@pytest.fixture(scope="module")
def coder():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS)["ranks"], special_tokens={})


def frame(spark):
    rows = [(i, t, 1) for i, t in enumerate(texts())] + [(1000, None, None), (1001, "", 1), (1002, "x" * 400, 1), (None, "null id " * 30, 1),
                                                        (1003, " " * 300, 1), (1003, " " * 300, 1), (1003, "ab " * 200, 1), (1003, "ab " * 200, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens int"), rows


def test_counts_match_the_library(spark):
    df, rows = frame(spark)
    tok = Tokenizer.from_file(JSON)
    want = Counter((i, len((t or "").encode()), n := len(tok.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t, _ in rows)
    assert Counter(tuple(r) for r in token_count.token_counts(df, JSON).collect()) == want


def test_heap_merging_of_long_words():
    own, tok = token_count.load_merges(JSON), Tokenizer.from_file(JSON)
    for word in ("a" * 3000, "thethethe" * 300, "日本" * 500):
        assert token_count.count_merged(word.encode(), own["first"], own["merges"]) == len(tok.encode(word, add_special_tokens=False).ids)


def test_pattern_is_the_vocabulary_s():
    assert all(regex.findall(token_count.PATTERN, t) == regex.findall(public_tokenizers.PATTERN, t) for t in texts())


def test_chunks_are_stitched_as_one_scan(spark, coder):
    df, rows = frame(spark)
    for chunk, overlap in ((24, 8), (1 << 16, 1 << 12)):
        got = Counter((r.doc_id, tuple(r.ids)) for r in bpe.bpe_encode(df, RANKS, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap).collect())
        assert got == Counter((i, tuple(coder.encode_ordinary(t or ""))) for i, t, _ in rows)


def test_seams_after_white_space(spark, coder):
    runs = ["\n\n", "  ", " \n", "\n ", "\t\t\t", "\r\n\r\n", "\u3000\n", "\xa0 ", "\x1c\n\n", "\x85\n"]
    rows = [(100 * k + n, "x" * n + f"{run}Next{run}1{run}!" * 12) for k, run in enumerate(runs) for n in range(1, 25)]     # a seam after each run
    got = {r.doc_id: r.ids for r in bpe.bpe_encode(spark.createDataFrame(rows, "doc_id long, text string"), RANKS, public_tokenizers.PATTERN,
                                                   chunk=24, overlap=16).collect()}
    assert got == {i: coder.encode_ordinary(t) for i, t in rows}


def test_round_trip(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = bpe.bpe_decode(bpe.bpe_encode(docs, RANKS, public_tokenizers.PATTERN, chunk=512, overlap=128), RANKS)
    assert {r.doc_id: bytes(r.raw) for r in out.collect()} == {r.doc_id: (r.text or "").encode() for r in docs.collect()}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_count.token_counts(empty, JSON).count() == 0 and bpe.digest(empty, RANKS, public_tokenizers.PATTERN).count() == 0
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert [(r.n_tokens, r.ids, bytes(r.raw)) for r in bpe.bpe_decode(nothing, RANKS).collect()] == [(0, [], b"")]
