"""Cross-tokenizer alignment against brute force over the libraries' tokens."""
import hashlib

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from brute import aligned
from retail_analytics.llm import cross_align
from retail_analytics.llm.token_count import byte_symbols

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", *cross_align.MEASURES, "groups"]
ODD = [(1, None), (2, ""), (3, " "), (4, "a▁b"), (5, "x  y\n\nz\t"), (6, "<s> <0x41> <unk> <|endoftext|>"), (7, "é中文字 ①🙂"), (7, "same"), (7, "same"), (None, "same"),
       (8, "\x00\r\n"), (9, "word " * 40_000), (10, ("ab cd. " * 20 + "x" * 500 + "\n") * 100), (11, "y" * 70_000), (12, "tail of A text " * 9_000 + "a▁b")]


def tokens():
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    byte_of = {c: k for k, c in enumerate(byte_symbols())}

    def both(text):
        pieces = [(i, b.id_to_piece(i)) for i in b.encode(text)]
        return ([(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids],
                [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in pieces])
    return both


def found(df):
    return sorted(map(str, map(tuple, df.select(COLUMNS).collect())))


@pytest.mark.parametrize("broadcast", [0, 10**6])
def test_odd_texts(spark, broadcast):
    df = spark.createDataFrame([(i, t, "q", 1) for i, t in ODD], "doc_id long, text string, key string, docs int").repartition(2)
    assert found(cross_align.align(df, A, B, max_broadcast_pairs=broadcast)) == sorted(map(str, aligned(ODD, tokens())))
    assert found(cross_align.align(df.limit(0), A, B)) == []


def test_seams_leave_no_trace(spark, monkeypatch):
    """The ids of a whole text are those of its units, one after the other."""
    both = tokens()
    odd = ["Some words, and 'more' of them's. " * 40, "it's  a\ttest " * 30 + "é" * 50, "á é, ñ. x", "a \u0301b c", "1 2 x1 ( y ) '", "a\u00a0b c\u2003d e", "中 文 x", "x \n y \r\n z"]
    for t in odd:
        units = cross_align.units_of(t)
        assert all([x for u in units for x in both(u)[k]] == both(t)[k] for k in (0, 1)), t
    monkeypatch.setattr(cross_align, "SEGMENT", 50)
    for t in odd[:2]:
        assert len(cross_align.segments(t)) > 1 and [u for p in cross_align.segments(t) for u in cross_align.units_of(p)] == cross_align.units_of(t)


def test_query_is_the_digest_of_the_groups(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = [(*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[7] else "") for r in aligned(rows, tokens())]
    got = cross_align.query(spark, SF)
    assert got.columns == ["doc_id", *cross_align.MEASURES, "groups_sha256"]
    assert found(got.withColumnRenamed("groups_sha256", "groups")) == sorted(map(str, want))
