import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from firmroll.llm import bpe

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def plain(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def digests(text):
    ids = plain(text)
    decoded = LIBRARY.decode(ids, skip_special_tokens=False)
    return (
        len(ids),
        hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
        hashlib.sha256(decoded.encode()).hexdigest(),
    )


def test_whole_table_against_the_library(spark, sf_dir):
    from firmroll.llm import registry

    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = registry.queries()["op7_bpe"](spark, sf_dir).collect()
    assert sorted(tuple(r) for r in got) == sorted((r.doc_id, *digests(r.text)) for r in rows)


ODD = "abzé'sdtmrevl  \n\t 019²½!.<|>endoftx\x1c\x85\xa0ñʼÿĀɏ中文日本ー한ไทย👍🏽̈​"


@settings(deadline=None, max_examples=400)
@given(st.text(alphabet=st.sampled_from(ODD), max_size=80) | st.text(max_size=60), st.integers(1, 12))
def test_tree_equals_library(text, leaf):
    assert bpe.codec().encode_tree(text, leaf) == plain(text)


@settings(deadline=None, max_examples=200)
@given(
    st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", " '", "'ll", "'re", "  ", "\n\n", " a", "zz", "12", "!!", "é"]), max_size=30),
    st.integers(1, 9),
)
def test_tree_equals_library_around_special_cases(parts, leaf):
    text = "".join(parts)
    assert bpe.codec().encode_tree(text, leaf) == plain(text)


@pytest.mark.parametrize("alphabet", ["a", "ab", "abcdefgh", " ", " \n", "0123456789", "!?", "a1", "abc!", "日本", "éa"])
def test_unsplit_texts(alphabet):
    rng = random.Random(alphabet)
    text = "".join(rng.choice(alphabet) for _ in range(6000))
    assert bpe.codec().encode_tree(text, 64) == plain(text)


def test_every_common_character(spark):
    one = bpe.codec()
    for code in range(0x250):
        text = f"a{chr(code)}b {chr(code)} 1{chr(code)}2 {chr(code)}{chr(code)}'s"
        assert one.encode(text) == plain(text)
        assert one.decode(one.encode(text)) == text


def test_odd_rows(spark):
    long = "y" * 70_000 + " word" * 20_000
    rows = [(1, None, "x"), (2, "", "x"), (2, "", "x"), (None, "<|endoftext|>", "x"), (3, long, "x"), (3, long, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = Counter(tuple(r) for r in bpe.round_trip(docs, piece_chars=5000).collect())
    assert got == Counter((d, *digests(t or "")) for d, t, _ in rows)
    assert bpe.round_trip(docs.limit(0)).count() == 0
    back = bpe.with_decoded(bpe.with_token_ids(docs, "n"), "n").select("text", "decoded").collect()
    assert all((r.text or "") == r.decoded for r in back)
