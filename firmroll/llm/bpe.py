"""Byte-level BPE encoding and decoding, with tree concatenation for long texts.

Method: a text longer than a leaf is halved, the halves are encoded on their own (those of very long texts in parallel
tasks), and each join is repaired: a window around it is encoded anew and grows until both sides agree exactly. A side
agrees if the window's edge is

- an end of the text, or a place where words are certainly split (a blank after a non-blank, or a change between
  letters, digits and other characters that no contraction spans), or
- inside a run of one kind of character, and the window's outermost token there is the very token that the half has.

In the second case every two neighbouring tokens of the result have been neighbours in a correct encoding of a run of
that kind. For BPE with merges in rank order that makes the whole sequence the correct one.

Leaves are encoded with the ranks of the tokenizer file by a fast engine where every character is below U+0250, whose
classes all Unicode versions agree on, and by the tokenizers library otherwise. Both give the library's ids.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from firmroll.llm.common import text_or_empty

VOCABULARY = "byte_bpe_50k.json"
LEAF_CHARS = 4096
PIECE_CHARS = 32768
FIRST_WINDOW = 32
# White space as Unicode defines it.
SPACES = "\t\n\x0b\x0c\r \x85\xa0                　"
_UNUSUAL = re.compile("[^\x00-ɏ]")


def _byte_of_character() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    shifted = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(shifted)}


def kind(character: str) -> str:
    """letter, number, space, other; empty where Unicode versions could disagree."""
    if character in SPACES:
        return "space"
    now = unicodedata.category(character)
    if now != unicodedata.ucd_3_2_0.category(character) or now == "Cn":
        return ""
    return {"L": "letter", "N": "number"}.get(now[0], "other")


class Codec:
    """One tokenizer file: encode, decode, and encode by tree concatenation."""

    def __init__(self, path: str) -> None:
        self.path = path
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        to_byte = _byte_of_character()
        vocabulary = spec["model"]["vocab"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        words = {bytes(map(to_byte.__getitem__, w)): i for w, i in vocabulary.items() if w not in added}
        self.bytes_of = [b""] * (1 + max([*words.values(), *added.values()]))
        for word, i in [*words.items(), *((w.encode(), i) for w, i in added.items())]:
            self.bytes_of[i] = word
        self.lengths = [len(b) for b in self.bytes_of]
        self.decimals = [str(i) for i in range(len(self.bytes_of))]
        self.added = added
        self.longest_added = max((len(w.encode()) for w in added), default=0)
        merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in spec["model"]["merges"]]
        in_rank_order = all(vocabulary[m] == 256 + i for i, m in enumerate(merges)) and len(words) == 256 + len(merges)
        self.engine = None
        if in_rank_order and len(added) <= 1:
            self.engine = tiktoken.Encoding(
                "corpus", pat_str=public_tokenizers.PATTERN, mergeable_ranks=words, special_tokens={}
            )

    @cached_property
    def library(self) -> Tokenizer:
        """Loaded by the first text that needs it, since it takes as much memory as the rest of a worker."""
        library = Tokenizer.from_file(self.path)
        library.no_truncation()
        library.no_padding()
        return library

    def encode(self, text: str) -> list[int]:
        """A text in one go."""
        if self.engine is None or _UNUSUAL.search(text):
            return self.library.encode(text, add_special_tokens=False).ids
        for word, i in self.added.items():
            if word in text:
                ids: list[int] = []
                for n, part in enumerate(text.split(word)):
                    ids += [i] * (n > 0) + self.engine.encode_ordinary(part)
                return ids
        return self.engine.encode_ordinary(text)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")

    def encode_tree(self, text: str, leaf: int = LEAF_CHARS) -> list[int]:
        """The same ids as :meth:`encode`, by halves."""
        if len(text) <= leaf:
            return self.encode(text)
        middle = len(text) // 2
        parts = [text[:middle], text[middle:]]
        return self.join(parts, [self.encode_tree(p, leaf) for p in parts])

    def join(self, texts: list[str], ids: list[list[int]]) -> list[int]:
        """Join neighbouring texts and their ids, as a tree."""
        if len(texts) == 1:
            return ids[0]
        if len(texts) > 2:
            half = len(texts) // 2
            ids = [self.join(texts[:half], ids[:half]), self.join(texts[half:], ids[half:])]
            texts = ["".join(texts[:half]), "".join(texts[half:])]
        left, right = ids
        if not left or not right:
            return left + right
        raw, cut = "".join(texts).encode(), len(texts[0].encode())
        window = FIRST_WINDOW
        while True:
            i, a = len(left), cut
            while a > 0 and (cut - a < window or not self._edge(raw, a)):
                i -= 1
                a -= self.lengths[left[i]]
            j, b = 0, cut
            while b < len(raw) and (b - cut < window or not self._edge(raw, b)):
                b += self.lengths[right[j]]
                j += 1
            middle = self.encode(raw[a:b].decode())
            if (a == 0 or self._edge(raw, a) == "split" or middle[:1] == left[i : i + 1]) and (
                b == len(raw) or self._edge(raw, b) == "split" or middle[-1:] == right[j - 1 : j]
            ):
                return left[:i] + middle + right[j:]
            window *= 2

    def _edge(self, raw: bytes, place: int) -> str:
        """What lies at a place inside ``raw``: a certain split, the inside of a run, or nothing to rely on."""
        if raw[place] & 0xC0 == 0x80:
            return ""
        reach = self.longest_added - 1
        around = raw[max(0, place - reach) : place + reach]
        if any(word.encode() in around for word in self.added):
            return ""
        start = place - 1
        while raw[start] & 0xC0 == 0x80:
            start -= 1
        before, after = raw[start:place].decode(), raw[place : place + 4].decode("utf-8", "ignore")[:1]
        x, y = kind(before), kind(after)
        if not x or not y or before == "'" or after == "'":
            return ""
        if x == y:
            return "run"
        return "split" if x != "space" else ""

    def digests(self, ids: list[int]) -> tuple[int, str, str]:
        """n_tokens, ids_sha256, decoded_sha256."""
        listed = ",".join(map(self.decimals.__getitem__, ids)).encode()
        return len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(self.decode(ids).encode()).hexdigest()


@lru_cache(maxsize=2)
def codec(vocabulary: str = VOCABULARY) -> Codec:
    """The codec of a file that comes with the tokenizers package, or of a path; one per worker."""
    return Codec(vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary))


DIGESTS = ["n_tokens", "ids_sha256", "decoded_sha256"]
_DIGEST_TYPE = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def with_token_ids(docs: DataFrame, out: str = "ids", vocabulary: str = VOCABULARY, text: str = "text") -> DataFrame:
    """Add the ids of each whole text as an array; a null text counts as empty."""

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([codec(vocabulary).encode_tree(x) for x in texts])

    return docs.withColumn(out, encode(text_or_empty(text)))


def with_decoded(docs: DataFrame, ids: str = "ids", out: str = "decoded", vocabulary: str = VOCABULARY) -> DataFrame:
    """Add the text of an array of ids; a null array gives a null."""

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for arrays in batches:
            yield pd.Series([None if x is None else codec(vocabulary).decode(x) for x in arrays], dtype=object)

    return docs.withColumn(out, decode(F.col(ids)))


def round_trip(docs: DataFrame, vocabulary: str = VOCABULARY, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """One row per row: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Texts of up to ``piece_chars`` are encoded where they lie. Longer ones are cut into pieces that travel to tasks of
    their own; only their ids and texts meet again. A null text counts as empty and has no tokens; repeated rows give
    repeated results; other columns are ignored.
    """
    texts = docs.select(F.col("doc_id"), text_or_empty().alias("text"))

    @F.pandas_udf(_DIGEST_TYPE)
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        one = codec(vocabulary)
        for batch in batches:
            yield pd.DataFrame([one.digests(one.encode_tree(x)) for x in batch], columns=DIGESTS)

    @F.pandas_udf("binary")
    def piece_ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = codec(vocabulary)
        for batch in batches:
            yield pd.Series([np.array(one.encode_tree(x), "<u4").tobytes() for x in batch])

    def joined(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        one = codec(vocabulary)
        ids = one.join(list(rows["piece"]), [np.frombuffer(x, "<u4").tolist() for x in rows["ids"]])
        return pd.DataFrame([(rows["doc_id"].iloc[0], *one.digests(ids))], columns=["doc_id", *DIGESTS])

    short = texts.where(F.length("text") <= piece_chars).select("doc_id", digest("text").alias("d"))
    pieces = (
        texts.where(F.length("text") > piece_chars)
        .withColumn("owner", F.monotonically_increasing_id())
        .select(
            "owner", "doc_id",
            F.posexplode(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{piece_chars}}}"), F.lit(0))).alias("place", "piece"),
        )
        .repartition("owner", "place")
        .withColumn("ids", piece_ids("piece"))
    )
    schema = f"doc_id {dict(texts.dtypes)['doc_id']}, {_DIGEST_TYPE}"
    long = pieces.groupBy("owner").applyInPandas(joined, schema)
    return short.select("doc_id", "d.*").unionByName(long)


