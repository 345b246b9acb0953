"""Encoding with a public byte-level BPE vocabulary through a sentencepiece model that is written from it."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import spread

FOLDER = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fixed value: the pre-token pattern of this vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE = 200_000


@lru_cache(1)
def _byte_letters() -> list[str]:
    """A visible letter for each byte: printable Latin-1 bytes stand for themselves, the rest follow U+0100 in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def serialise(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model whose piece i is token i: bytes as letters, score minus rank, no normalisation."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    letters, model = _byte_letters(), pb.ModelProto()
    by_id = {i: b for b, i in ranks.items()}
    for i in range(max(by_id) + 1):
        piece = model.pieces.add()
        if i in by_id:
            piece.piece, piece.score, piece.type = "".join(letters[b] for b in by_id[i]), -float(i), pb.ModelProto.SentencePiece.NORMAL
        else:
            piece.piece, piece.score, piece.type = f"<unused {i}>", 0.0, pb.ModelProto.SentencePiece.UNUSED
    end = model.pieces.add()
    end.piece, end.score, end.type = "<unk>", 0.0, pb.ModelProto.SentencePiece.UNKNOWN
    t, n = model.trainer_spec, model.normalizer_spec
    t.model_type, t.vocab_size, t.unk_id, t.bos_id, t.eos_id, t.pad_id = pb.TrainerSpec.BPE, len(model.pieces), len(model.pieces) - 1, -1, -1, -1
    t.byte_fallback, t.treat_whitespace_as_suffix = False, False
    n.name, n.add_dummy_prefix, n.remove_extra_whitespaces, n.escape_whitespaces, n.precompiled_charsmap = "identity", False, False, False, b""
    return model.SerializeToString()


class Codec:
    """Encodes and decodes whole texts; ids of frequent pre-tokens are remembered, at most CACHE of them."""

    def __init__(self, path: str):
        import regex
        import sentencepiece

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes = {i: b for b, i in self.ranks.items()}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(self.ranks))
        self.pieces = regex.compile(PATTERN)
        self.table = dict(enumerate(_byte_letters()))
        self.known: dict[str, list[int]] = {}

    def encode_all(self, texts: list[str | None]) -> list[list[int]]:
        """Token ids of each text; an empty list for an empty or null one."""
        cut = [self.pieces.findall(t) if t else [] for t in texts]
        new = list({p for ps in cut for p in ps if p not in self.known})
        known = self.known
        if new:
            spelt = [p.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.table) for p in new]
            fresh = dict(zip(new, self.model.encode(spelt, num_threads=1)))
            if len(known) + len(fresh) <= CACHE:
                known.update(fresh)
            else:
                known = _Both(fresh, known)
        return [[i for p in ps for i in known[p]] for ps in cut]

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.bytes[i] for i in ids).decode("utf-8", "replace")


class _Both(dict):
    def __init__(self, fresh: dict, old: dict):
        super().__init__(fresh)
        self.old = old

    def __missing__(self, key):
        return self.old[key]


@lru_cache(4)
def codec(path: str) -> Codec:
    """One codec per Python worker and file."""
    return Codec(path)


def vocabulary_path(folder: str = FOLDER, name: str = VOCABULARY) -> str:
    return os.path.join(folder, name)


def slices(texts: list, most: int = 4_000_000) -> Iterator[list]:
    """Consecutive runs of about most characters, so that a batch of very long texts needs bounded memory."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t or "")
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """key, ids (array<int>) of every row of df, in its partitions: no shuffle. Empty and null texts give an empty array.

    path: the vocabulary file, at the same place on every machine. Special strings in a text are ordinary text.
    """
    path = path or vocabulary_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(path)
        for pdf in batches:
            at = 0
            for part in slices(pdf["text"].tolist()):
                ids = [np.asarray(x, np.int32) for x in c.encode_all(part)]
                yield pd.DataFrame({"key": pdf["key"].iloc[at : at + len(part)], "ids": ids})
                at += len(part)

    kind = df.schema[key].dataType.simpleString()
    out = spread(df.select(F.col(key).alias("key"), F.col(text).alias("text"))).mapInPandas(run, f"key {kind}, ids array<int>")
    return out.withColumnRenamed("key", key)


def lengths(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """key, n_tokens of every row."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(path)
        for pdf in batches:
            n = [len(ids) for part in slices(pdf["text"].tolist()) for ids in c.encode_all(part)]
            yield pd.DataFrame({"key": pdf["key"], "n_tokens": n})

    kind = df.schema[key].dataType.simpleString()
    return spread(df.select(F.col(key).alias("key"), F.col(text).alias("text"))).mapInPandas(run, f"key {kind}, n_tokens bigint").withColumnRenamed("key", key)


def decode(df: DataFrame, key: str = "doc_id", ids: str = "ids", path: str | None = None) -> DataFrame:
    """key, text: the inverse of encode for every valid text; null and empty ids give an empty text."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(path)
        for pdf in batches:
            yield pd.DataFrame({"key": pdf["key"], "text": [c.decode(x.tolist()) if x is not None else "" for x in pdf["ids"]]})

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("key"), F.col(ids).alias("ids")).mapInPandas(run, f"key {kind}, text string").withColumnRenamed("key", key)
