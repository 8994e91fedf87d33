"""Token counts by section: each document is encoded once, and its tokens are attributed to sections by their offsets.

Tokens come from a byte-level BPE vocabulary, so the tokens' bytes follow each other and their offsets are sums of
lengths. Sections are character spans, sorted and without overlap; they are turned into byte spans and joined with the
token spans by binary search. A token that has bytes in one section only belongs to it. Of a token that crosses a
boundary, rule "majority" gives it to the section with most of its bytes (ties: the earlier one), rule "start" to the
section in which it begins, or else the first that it reaches. Tokens outside all sections are counted under the null
section. `n_crossing` counts those of a section's tokens that also have bytes outside of it.

The default sections are the lines, each with its line end, numbered from 0.

Defined results: null and empty texts have one section 0 from 0 to 0 without tokens. Sections without tokens have
count 0. Texts that hold special tokens' strings are ordinary text. Repeated rows each give their rows; other columns
are not looked at.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenweave.llm.common import chunks, table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The published split pattern of this vocabulary, a fixed value.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""

Sections = Callable[[str], list[tuple[int, int, int]]]
_loaded: dict[str, tuple] = {}


def lines(text: str) -> list[tuple[int, int, int]]:
    """(number, begin, end) of each line with its line end."""
    out, at = [], 0
    for k, line in enumerate(text.split("\n")):
        end = min(len(text), at + len(line) + 1)
        if end > at or not k:
            out.append((k, at, end))
        at = end
    return out


def encoder(path: str) -> tuple:
    """The encoder of a vocabulary file, and the length in bytes of each token."""
    if path not in _loaded:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        size = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            size[rank] = len(token)
        _loaded[path] = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), size
    return _loaded[path]


def byte_offsets(text: str) -> np.ndarray | None:
    """Byte offset of each character and of the end; None where they are the same."""
    if text.isascii():
        return None
    raw = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
    return np.concatenate([np.flatnonzero((raw & 0xC0) != 0x80), [len(raw)]])


def attribute(size: np.ndarray, begin: np.ndarray, end: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """For tokens of these byte lengths, the section index of each (-1: none) and whether it crosses a boundary."""
    stop = np.cumsum(size)
    start = stop - size
    first = np.searchsorted(end, start, side="right")
    last = np.searchsorted(begin, stop, side="left") - 1
    owner = np.where(first <= last, first, -1)
    safe = np.minimum(first, max(len(begin) - 1, 0))
    inside = (start >= begin[safe]) & (stop <= end[safe]) if len(begin) else np.zeros(len(size), bool)
    if rule == "majority":
        for k in np.flatnonzero(first < last):
            i = np.arange(first[k], last[k] + 1)
            owner[k] = i[np.argmax(np.minimum(end[i], stop[k]) - np.maximum(begin[i], start[k]))]
    elif rule != "start":
        raise ValueError(f"no such rule: {rule}")
    return owner, (owner >= 0) & ~inside


def counted(docs: DataFrame, text: str = "text", key: str = "doc_id", sections: Sections = lines, rule: str = "majority", vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, section, char_start, char_end, n_tokens, n_crossing), a row for each section and, if needed, one for tokens outside of all.

    The vocabulary is a file of the driver; Spark sends it to the executors.
    """
    docs.sparkSession.sparkContext.addFile(vocabulary)
    name = os.path.basename(vocabulary)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding, length = encoder(SparkFiles.get(name))
        for b in batches:
            keys, texts = b["key"].to_numpy(), b["text"].tolist()
            for part in chunks(texts):
                out = []
                for key_, t in zip(keys[part], texts[part]):
                    t = t or ""
                    spans = sections(t)
                    span = np.array([s[1:] for s in spans], dtype=np.int64).reshape(-1, 2)
                    at = byte_offsets(t)
                    edges = span if at is None else at[span]
                    size = length[np.array(encoding.encode_ordinary(t), dtype=np.int64)]
                    owner, crossing = attribute(size, edges[:, 0], edges[:, 1], rule)
                    n = np.bincount(owner + 1, minlength=len(spans) + 1)
                    c = np.bincount(owner[crossing] + 1, minlength=len(spans) + 1)
                    out += [(key_, s[0], s[1], s[2], n[i + 1], c[i + 1]) for i, s in enumerate(spans)]
                    if n[0]:
                        out.append((key_, None, None, None, n[0], 0))
                names = ["doc_id", "section", "char_start", "char_end", "n_tokens", "n_crossing"]
                yield pd.DataFrame({c: pd.array(v, dtype="Int64") if c != "doc_id" else v for c, v in zip(names, map(list, zip(*out)))}, columns=names)

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInPandas(run, f"doc_id {kind}, section long, char_start long, char_end long, n_tokens long, n_crossing long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted(table(spark, sf_dir, "documents"))
