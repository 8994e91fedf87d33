"""Byte-level BPE through a sentencepiece model that is written straight from a vocabulary of ranks.

Each byte is written as one printable character, so a token is a string of such characters and a piece of the model.
Its score is the negative rank: sentencepiece merges the pair with the highest score, ties from the left, which is the
merge of least rank. The model's normalisation is the identity and adds no space. It is serialised by hand (`serialised`),
never trained. Texts are cut into pre-tokens by the vocabulary's pattern, each pre-token is encoded by itself, and ids are
decoded by the inverse of the byte mapping. A token that merges don't lead to is still its own encoding where it is a
whole pre-token, as usual encoders have it: `Codec` finds these tokens once (none in the default vocabulary).

`encoded` gives ids, `decoded` gives bytes; both are maps without a shuffle. Long texts go through in parts, cut where white
space follows another character: there a pre-token ends whatever stands before or behind. The cache of pre-tokens holds
MEMO of them between chunks and is emptied beyond.

Defined results: null and empty texts have no ids and decode to no bytes; null ids decode to null. Repeated rows give their
rows each; null keys are kept; other columns are not looked at. Strings of special tokens are ordinary text. Ids that the
vocabulary lacks are an error, and so is a vocabulary without one of the 256 bytes. No rows give no rows.
"""

from __future__ import annotations

import base64
import os
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenweave.llm.common import CHUNK_CHARS, chunks, table, tidy

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The published split pattern of the vocabulary, a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pre-tokens whose ids a worker remembers between chunks.
MEMO = 400_000
#: Fields of sentencepiece's model file, fixed values: ModelProto, SentencePiece, TrainerSpec, NormalizerSpec.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE, SCORE, TYPE = 1, 2, 3
MODEL_TYPE, UNK_ID, BOS_ID, EOS_ID, PAD_ID = 3, 40, 41, 42, 43
NAME, DUMMY_PREFIX, EXTRA_WHITESPACES, ESCAPE_WHITESPACES = 1, 3, 4, 5
NORMAL, UNKNOWN, BPE = 1, 2, 2

_loaded: dict[str, Codec] = {}


def alphabet() -> str:
    """A printable character for each byte: itself where Latin-1 has one, else one from U+0100 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return "".join(chr(b if b in plain else next(rest)) for b in range(256))


def _varint(n: int) -> bytes:
    n &= 2**64 - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def serialised(tokens: list[bytes], ranks: list[int]) -> bytes:
    """The model file: piece k is token k; the unknown piece comes last."""
    chars = alphabet()
    pieces = [_field(PIECE, "".join(chars[b] for b in t).encode()) + _field(SCORE, -float(r)) + _field(TYPE, NORMAL) for t, r in zip(tokens, ranks)]
    pieces.append(_field(PIECE, b"<unk>") + _field(SCORE, 0.0) + _field(TYPE, UNKNOWN))
    trainer = _field(MODEL_TYPE, BPE) + _field(UNK_ID, len(tokens)) + b"".join(_field(f, -1) for f in (BOS_ID, EOS_ID, PAD_ID))
    normalizer = _field(NAME, b"identity") + b"".join(_field(f, 0) for f in (DUMMY_PREFIX, EXTRA_WHITESPACES, ESCAPE_WHITESPACES))
    return b"".join(_field(PIECES, p) for p in pieces) + _field(TRAINER, trainer) + _field(NORMALIZER, normalizer)


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Codec:
    """Encodes texts to ids (the ranks) and ids to bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        import regex
        import sentencepiece

        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"the vocabulary lacks {len(missing)} of the 256 bytes, the first is {missing[0]}")
        if max(ranks.values()) >= 1 << 24:
            raise ValueError("a score holds ranks below 2^24 only")
        tokens = sorted(ranks, key=ranks.__getitem__)
        self.id = [ranks[t] for t in tokens]
        self.chars = {b: c for b, c in enumerate(alphabet())}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialised(tokens, self.id))
        byte = {c: b for b, c in self.chars.items()}
        self.bytes: list[bytes | None] = [None] * (self.id[-1] + 1)
        for k, i in enumerate(self.id):
            self.bytes[i] = bytes(byte[c] for c in self.model.id_to_piece(k))
        self.pretoken = regex.compile(pattern)
        self.cut = regex.compile(r"(?<=\S)(?=\s)")
        self.unreached: dict[bytes, tuple[int, ...]] = {}
        for t, found in zip(tokens, self._pieces(tokens)):
            if found != (ranks[t],):
                self.unreached[t] = (ranks[t],)
        self.memo: dict[str, tuple[int, ...]] = {}

    def _pieces(self, raw: list[bytes]) -> list[tuple[int, ...]]:
        mapped = [r.decode("latin-1").translate(self.chars) for r in raw]
        return [tuple(map(self.id.__getitem__, x)) for x in self.model.encode(mapped, num_threads=1)]

    def parts(self, text: str, limit: int = CHUNK_CHARS) -> Iterator[str]:
        """The text in parts of about `limit` characters that end where a pre-token does."""
        at = 0
        while len(text) - at > limit and (found := self.cut.search(text, at + limit)):
            yield text[at : found.start()]
            at = found.start()
        yield text[at:] if at else text

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; texts that fit in a part are looked at together."""
        short = [k for k, t in enumerate(texts) if len(t) <= CHUNK_CHARS]
        out = dict(zip(short, self._ids([self.pretoken.findall(texts[k]) for k in short])))
        for k, t in enumerate(texts):
            if k not in out:
                out[k] = np.concatenate([self._ids([self.pretoken.findall(p)])[0] for p in self.parts(t)])
        return [out[k] for k in range(len(texts))]

    def _ids(self, found: list[list[str]]) -> list[np.ndarray]:
        """The ids of each list of pre-tokens; those that the cache lacks are encoded once."""
        if len(self.memo) > MEMO:
            self.memo.clear()
        new = list(set(chain.from_iterable(found)).difference(self.memo))
        raw = [w.encode() for w in new]
        self.memo.update(zip(new, self._pieces(raw)))
        if self.unreached:
            self.memo.update((w, self.unreached[r]) for w, r in zip(new, raw) if r in self.unreached)
        return [np.fromiter(chain.from_iterable(map(self.memo.__getitem__, words)), dtype=np.int32) for words in found]

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.bytes)):
            raise ValueError("an id that the vocabulary lacks")
        try:
            return b"".join(map(self.bytes.__getitem__, ids.tolist()))
        except TypeError as e:
            raise ValueError("an id that the vocabulary lacks") from e


def codec(path: str) -> Codec:
    if path not in _loaded:
        _loaded[path] = Codec(ranks_of(path))
    return _loaded[path]


def _sent(df: DataFrame, vocabulary: str) -> str:
    """The vocabulary is a file of the driver; Spark sends it to the executors."""
    df.sparkSession.sparkContext.addFile(vocabulary)
    return os.path.basename(vocabulary)


def encoded(docs: DataFrame, text: str = "text", key: str = "doc_id", vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, ids): the ids of each whole text, in order."""
    name = _sent(docs, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(SparkFiles.get(name))
        for b in batches:
            texts = b.column(1).to_pylist()
            for part in chunks(texts):
                ids = own.encode_all([t or "" for t in texts[part]])
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays([b.column(0)[part], pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], names=["key", "ids"])
        tidy()

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(run, f"key {kind}, ids array<int>")
    return out.withColumnRenamed("key", key)


def decoded(found: DataFrame, ids: str = "ids", keep: tuple[str, ...] = (), vocabulary: str = VOCABULARY) -> DataFrame:
    """The columns `keep` of each row, and `decoded`, the bytes of its ids."""
    name = _sent(found, vocabulary)
    kept = found.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(ids).cast("array<int>").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(SparkFiles.get(name))
        for b in batches:
            column = b.column(b.num_columns - 1)
            size = np.asarray(column.value_lengths().fill_null(0).cast(pa.int64()).to_numpy(zero_copy_only=False))
            flat, there = column.flatten().to_numpy(zero_copy_only=False), column.is_valid().to_numpy(zero_copy_only=False)
            end = np.cumsum(size)
            made = [own.decode(flat[e - n : e]) if ok else None for e, n, ok in zip(end.tolist(), size.tolist(), there.tolist())]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(made, pa.binary())], names=[*b.schema.names[:-1], "decoded"])
        tidy()

    kinds = [f"k{i} {found.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)]
    return kept.mapInArrow(run, ", ".join([*kinds, "decoded binary"])).withColumnsRenamed({f"k{i}": c for i, c in enumerate(keep)})


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = encoded(table(spark, sf_dir, "documents"))
    found = ids.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"))
    out = decoded(found, keep=("doc_id", "n_tokens", "ids_sha256"))
    return out.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
