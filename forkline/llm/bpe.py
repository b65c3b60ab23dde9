"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches."""

from __future__ import annotations

import base64
import functools
import hashlib
import os
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import add_columns, documents

#: Vocabulary: the file of ranks, and the same vocabulary for the tokenizers library.
RANKS, MODEL = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"


@functools.cache
def byte_to_char() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary.

    Bytes that print in Latin-1 stand for themselves, the others follow from U+0100 in order.
    """
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(prints)]
    return {b: chr(b) for b in prints} | {b: chr(0x100 + i) for i, b in enumerate(others)}


#: Pieces remembered by a worker; then it starts anew.
PIECES = 300_000


class Codec:
    """Encode texts to ranks with offsets, and decode ranks to bytes or text."""

    def __init__(self, ranks_path: str, model_path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker on each core
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.model = Tokenizer.from_file(model_path)
        self.model.encode_special_tokens = True
        # The model gets one match of the pattern at a time, and only maps its bytes to characters.
        self.model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=False, use_regex=False)
        self.pattern = regex.compile(pattern)
        self.ids: dict[str, str] = {}
        self.raw: dict[str, bytes] = {}
        back = {c: b for b, c in byte_to_char().items()}
        self.table: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, r in ranks.items():
            self.table[r] = token
        # The model's ids must be the ranks: its tokens are turned back to bytes by the reversed byte table.
        for token, i in self.model.get_vocab(with_added_tokens=False).items():
            if all(c in back for c in token) and (raw := bytes(back[c] for c in token)) in ranks and ranks[raw] != i:
                raise ValueError(f"id {i} of the model isn't the rank {ranks[raw]}")

    def pieces_of(self, texts: list[str]) -> list[list[str]]:
        """The pieces of each text, which are the matches of the pattern. Those not seen before are encoded together, and their ids decoded."""
        every = [self.pattern.findall(t) for t in texts]
        if len(self.ids) > PIECES:
            self.ids.clear()
            self.raw.clear()
        known = self.ids
        unknown = {p for pieces in every for p in pieces if p not in known}
        if unknown:
            new = list(unknown)
            for p, e in zip(new, self.model.encode_batch_fast(new, add_special_tokens=False), strict=True):
                ids = e.ids
                known[p] = " ".join(map(str, ids))
                self.raw[p] = self.decode_bytes(ids)
        return every

    def encode_to_text(self, texts: list[str]) -> list[tuple[str, bytes]]:
        """Of each text, its ids as decimal text joined by a space, and the bytes that these ids decode to."""
        ids, raw = self.ids.__getitem__, self.raw.__getitem__
        return [(" ".join(map(ids, pieces)), b"".join(map(raw, pieces))) for pieces in self.pieces_of(texts)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(s.split(), np.int32) for s, _ in self.encode_to_text(texts)]

    def encode_with_offsets(self, texts: list[str]) -> list[tuple[list[int], list[tuple[int, int]]]]:
        """Ids, and for each the (start, end) of the characters that its bytes belong to."""
        out = []
        for text in texts:
            ids: list[int] = []
            offsets: list[tuple[int, int]] = []
            places = [m.span() for m in self.pattern.finditer(text)]
            for (start, end), e in zip(places, self.model.encode_batch([text[a:b] for a, b in places], add_special_tokens=False), strict=True):
                ids += e.ids
                offsets += [(min(start + a, end), min(start + b, end)) for a, b in e.offsets]
            out.append((ids, offsets))
        return out

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.table.__getitem__, ids))

    def decode_stream(self, ids: Iterable[int]) -> Iterator[str]:
        """Text as far as it is whole after each id; a character split over ids comes with its last one."""
        import codecs

        part = codecs.getincrementaldecoder("utf-8")("replace")
        for i in ids:
            yield part.decode(self.table[i])
        yield part.decode(b"", final=True)


@functools.lru_cache(2)
def codec(ranks_path: str, model_path: str, pattern: str) -> Codec:
    return Codec(ranks_path, model_path, pattern)


def default_paths() -> tuple[str, str, str]:
    import public_tokenizers as P

    return P.path(RANKS), P.path(MODEL), P.PATTERN


FIELDS = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())]
DIGESTS = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]


def encode_documents(docs: DataFrame, text_col: str = "text", paths: tuple[str, str, str] | None = None) -> DataFrame:
    """Append n_tokens, ids (ranks of the vocabulary) and decoded (the bytes that the ids give back).

    A null or empty text has no tokens. All other columns stay; the three names must be free. Texts
    are taken whole; rows are independent, so the pass has no shuffle and a lost task is just run again.
    """
    paths = paths or default_paths()

    def make():
        def f(values: list) -> list[list]:
            both = codec(*paths).encode_to_text([v or "" for v in values])
            ids = [np.array(s.split(), np.int32) for s, _ in both]
            return [[len(x) for x in ids], ids, [raw for _, raw in both]]

        return f

    return add_columns(docs, text_col, FIELDS, make)


def digest_documents(docs: DataFrame, text_col: str = "text", paths: tuple[str, str, str] | None = None) -> DataFrame:
    """Like encode_documents(), with SHA-256 digests in place of the ids and bytes, so that these never leave the worker."""
    paths = paths or default_paths()

    def make():
        def f(values: list) -> list[list]:
            sha = lambda x: hashlib.sha256(x).hexdigest()
            both = codec(*paths).encode_to_text([v or "" for v in values])
            return [[s.count(" ") + 1 if s else 0 for s, _ in both], [sha(s.encode()) for s, _ in both], [sha(raw) for _, raw in both]]

        return f

    return add_columns(docs, text_col, DIGESTS, make)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded bytes, for every document."""
    return digest_documents(documents(spark, sf_dir)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
