"""BPE encoding and decoding with a word-end vocabulary, whole texts, no cut-off.

Method: inside a word, the ranks of all adjacent pairs are the leaves of a segment tree whose nodes
hold the minimum of (rank, position).  The root is the leftmost merge of lowest rank; a merge changes
three leaves, each a logarithmic point update, until no pair can merge.  Words repeat, so a bounded
cache keeps the ids of recent ones; a word of any length costs O(n log n).

Edge cases: null and empty texts give no tokens; tokens of the added vocabulary in a text are taken
whole, as the vocabulary file asks; repeated rows give repeated results; other columns are kept, and
columns named like a result are replaced.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
import zlib
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boundaryspark.llm.common import append_columns, table
from boundaryspark.llm.registry import query

#: Entries of each per-process cache of words; a full cache starts anew.
CACHED_WORDS = 180_000
NONE = 1 << 96
#: Children of an inner node of the tree of ranks.
FAN = 16
#: str.split() also splits at these, which the vocabulary's pattern takes as ordinary characters.
SEPARATORS = re.compile("[\x1c-\x1f]")
SPACE = "\t-\r \x85\xa0  -     　"


# Unicode of the tokenizers library where Python's tables differ.  Letters, numbers and lower-casing of
# versions 16 and 17; marks added since version 9, which the library does not reorder or compose.
NEWER = {
    "L": "1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D4A-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B 1138E 11390-113B5 113B7 113D1 113D3 "
         "11BC0-11BE0 13460-143FA 16100-1611D 16D40-16D6C 18CFF 1E5D0-1E5ED 1E5F0",
    "N": "10D40-10D49 116D0-116E3 11BF0-11BF9 16130-16139 16D70-16D79 1CCF0-1CCF9 1E5F1-1E5FA",
    "marks": "07FD 0898-089F 08CA-08D3 09FE 0C3C 0D3B-0D3C 0EBA 1715 1ABF-1ACE 1DF6-1DFA A82C 10D24-10D27 10EAB-10EAC 10EFD-10EFF 10F46-10F50 "
             "10F82-10F85 11070 1133B 1145E 11839-1183A 11930 1193D-1193E 11943 119E0 11A34 11A47 11A99 11D42 11D44-11D45 11D97 11F41-11F42 "
             "16FF0-16FF1 1E08F 1E130-1E136 1E2AE 1E2EC-1E2EF 1E4EC-1E4EF",
    "lower": "1C89>1C8A A7CB>0264 A7CC>A7CD A7CE>A7CF A7D2>A7D3 A7D4>A7D5 A7DA>A7DB A7DC>019B 10D50-10D65>10D70 16EA0-16EB8>16EBB",
}


def _ranges(kind: str) -> list[list[int]]:
    return [[int(x, 16) for x in (r.split(">")[0].split("-") * 2)[:2]] for r in NEWER[kind].split()]


_NEWER_MARK = re.compile("([" + "".join(f"{chr(a)}-{chr(b)}" for a, b in _ranges("marks")) + "])")
_NEWER_LOWER = {a + k: int(r.split(">")[1], 16) + k for (a, b), r in zip(_ranges("lower"), NEWER["lower"].split(), strict=True) for k in range(b - a + 1)}
_NEWER_CASED = re.compile("[" + "".join(map(chr, _NEWER_LOWER)) + "]")


def normalized(text: str) -> str:
    """NFC and lower case, as the library has them."""
    if text.isascii():
        return text.lower()
    if _NEWER_MARK.search(text):
        text = "".join(unicodedata.normalize("NFC", part) for part in _NEWER_MARK.split(text))
    else:
        text = unicodedata.normalize("NFC", text)
    text = text.replace("Σ", "σ").lower()
    return text.translate(_NEWER_LOWER) if _NEWER_CASED.search(text) else text


def category_class(first: str) -> str:
    """The characters of a Unicode category as ranges for a pattern's set."""
    ranges: list[list[int]] = _ranges(first)
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(chr(c))[0] == first:
            if ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
    return "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in ranges)


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def merge_pairs(ids: list[int], pairs: dict[int, int]) -> list[int]:
    """Apply merges, lowest rank first and leftmost among equals.

    `pairs` maps left << 17 | right to rank << 17 | merged.  Inner nodes of the tree hold the minimum of
    `FAN` nodes below them, so that a short word is a root over its leaves.
    """
    n = len(ids)
    if n < 2:
        return ids
    shift, get = n.bit_length(), pairs.get
    mask, symbols = (1 << shift) - 1, (1 << 17) - 1
    leaves = [NONE] * n
    left = ids[0]
    for i in range(1, n):
        right = ids[i]
        found = get(left << 17 | right)
        if found is not None:
            leaves[i - 1] = found << shift | i - 1
        left = right
    levels = [leaves]
    while len(levels[-1]) > FAN or len(levels) == 1:
        below = levels[-1]
        levels.append([min(below[k:k + FAN]) for k in range(0, len(below), FAN)])
    flat, after, before = len(levels) == 2 and n <= FAN, list(range(1, n + 1)), list(range(-1, n - 1))
    top = levels[-1]
    least = min(top)
    while least != NONE:
        i = least & mask
        merged = ids[i] = least >> shift & symbols
        j = after[i]
        k = after[i] = after[j]
        leaves[j] = leaves[i] = NONE
        if k < n:
            before[k] = i
            found = get(merged << 17 | ids[k])
            if found is not None:
                leaves[i] = found << shift | i
        p = before[i]
        if p >= 0:
            found = get(ids[p] << 17 | merged)
            leaves[p] = NONE if found is None else found << shift | p
        if flat:
            least = min(leaves)
        else:
            for leaf in (j, i, p) if p >= 0 else (j, i):
                for depth in range(1, len(levels)):
                    leaf //= FAN
                    levels[depth][leaf] = min(levels[depth - 1][leaf * FAN:(leaf + 1) * FAN])
            least = min(top)
    out, i = [], 0
    while i < n:
        out.append(ids[i])
        i = after[i]
    return out


class Vocabulary:
    """One vocabulary file: normalising, splitting, encoding and decoding."""

    def __init__(self, content: bytes) -> None:
        spec = json.loads(content)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pairs = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.pairs.setdefault(vocab[a] << 17 | vocab[b], rank << 17 | vocab[a + b])
        letters = byte_alphabet()
        self.inner = [vocab.get(c) for c in letters]
        self.last = [vocab.get(c + self.suffix) for c in letters]
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        letter, number = category_class("L"), category_class("N")
        self.word = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^{SPACE}{letter}{number}]+")
        self.space = re.compile(f"[{SPACE}]+")
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        self.names = names_of(spec)

    def encode_word(self, word: str) -> bytes:
        data = word.encode("utf-8", "replace")
        ids = [self.inner[b] for b in data[:-1]]
        ids.append(self.last[data[-1]])
        return array("I", merge_pairs([i for i in ids if i is not None], self.pairs)).tobytes()

    def encode_chunk(self, chunk: str) -> bytes:
        """The packed ids of a run without white space."""
        text = normalized(chunk)
        out = []
        for word in self.word.findall(text):
            ids = self.words.get(word)
            if ids is None:
                if len(self.words) >= CACHED_WORDS:
                    self.words.clear()
                ids = self.words[word] = self.encode_word(word)
            out.append(ids)
        ids = b"".join(out)
        if len(chunk) <= 64:
            if len(self.chunks) >= CACHED_WORDS:
                self.chunks.clear()
            self.chunks[chunk] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        out = []
        for part in self.special.split(text) if "<|" in text or not self.suffix else (text,):
            if part in self.added:
                out.append(array("I", [self.added[part]]).tobytes())
                continue
            chunks = self.space.split(part) if SEPARATORS.search(part) else part.split()
            known = self.chunks
            out += [known.get(c) or (self.encode_chunk(c) if c else b"") for c in chunks]
        return b"".join(out)


def names_of(spec: dict) -> dict[int, str]:
    """Token of each id; all that decoding needs of a vocabulary file."""
    return {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}


def decode(ids: bytes, names: dict[int, str]) -> str:
    """Text of packed ids, token by token."""
    return " ".join(map(names.__getitem__, array("I", ids)))


_LOADED: dict[int, Vocabulary] = {}


def _vocabulary(content: bytes) -> Vocabulary:
    key = zlib.crc32(content)
    if key not in _LOADED:
        _LOADED[key] = Vocabulary(content)
    return _LOADED[key]


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _content(path: str | None) -> bytes:
    with open(path or default_path(), "rb") as file:
        return file.read()


def encode_texts(df: DataFrame, path: str | None = None, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Add `ids` (packed little-endian unsigned 32-bit integers) and `n_tokens`."""
    content = _content(path)

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        vocabulary = _vocabulary(content)
        column = batch.column(batch.schema.get_field_index(text))
        ids = [vocabulary.encode(x.as_py() or "") for x in column]
        return [pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())]
    fields = [T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())]
    return append_columns(df, fields, run, () if keep_text else (text,))


def decode_ids(df: DataFrame, path: str | None = None, ids: str = "ids") -> DataFrame:
    """Add `decoded`, the text of packed ids; null ids give an empty text."""
    content, state = _content(path), []

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        if not state:
            state.append(names_of(json.loads(content)))
        column = batch.column(batch.schema.get_field_index(ids))
        return [pa.array([decode(x.as_py() or b"", state[0]) for x in column], pa.string())]
    return append_columns(df, [T.StructField("decoded", T.StringType())], run)


def round_trip(df: DataFrame, path: str | None = None, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Add `ids`, `n_tokens` and `decoded`, the text of these ids, in one pass: chained, the two
    functions above would run two Python processes in every task."""
    content = _content(path)

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        vocabulary = _vocabulary(content)
        column = batch.column(batch.schema.get_field_index(text))
        ids = [vocabulary.encode(x.as_py() or "") for x in column]
        return [pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([decode(x, vocabulary.names) for x in ids], pa.string())]
    fields = [T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType()), T.StructField("decoded", T.StringType())]
    return append_columns(df, fields, run, () if keep_text else (text,))


@query("op1_bpe")
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = round_trip(documents, keep_text=False)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"))
