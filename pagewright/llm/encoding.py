"""Problem 8: the whole corpus as token ids of a public byte-level BPE vocabulary.

Some pairs of bytes stand side by side in no token of the vocabulary, so a token boundary lies between them wherever
they meet.  A text is cut at such pairs, the fragments (mostly words) are encoded independently, each different one
once, and the ids are concatenated.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

#: Where the public vocabularies lie; a parameter of every function below.
TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k"
#: Fixed value: how this vocabulary splits text before it merges bytes.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Fragments whose ids a task remembers.
REMEMBERED = 500_000


def load_ranks(folder: str = TOKENIZERS, name: str = VOCABULARY) -> dict[bytes, int]:
    lines = Path(folder, f"{name}.tiktoken").read_bytes().splitlines()
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line)}


def never_adjacent(ranks: dict[bytes, int]) -> np.ndarray:
    """256 x 256: whether the two bytes are neighbours in no token."""
    never = np.ones((256, 256), bool)
    for token in ranks:
        for a, b in zip(token, token[1:]):
            never[a, b] = False
    return never


class Encoder:
    """Encodes by forced boundaries.

    A boundary is used only after a letter or digit: there the splitting pattern, too, finds the same pieces in the
    fragments as in the whole (it looks ahead only in white space, and contractions begin with an apostrophe).
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.never = never_adjacent(ranks)
        self.after = np.zeros(256, bool)
        self.after[[c for c in range(128) if chr(c).isalnum()]] = True
        self.starts = np.array([(b & 0xC0) != 0x80 for b in range(256)])
        self.whole = tiktoken.Encoding(VOCABULARY, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, list[int]] = {}

    def fragments(self, text: str) -> list[str]:
        if text.isascii():
            raw = np.frombuffer(text.encode(), np.uint8)
            cuts = (np.flatnonzero(self.never[raw[:-1], raw[1:]] & self.after[raw[:-1]]) + 1).tolist() if len(raw) > 1 else []
        else:
            cuts = []
            before, last = "", 0
            for at, c in enumerate(text):
                first = ord(c) if c < "\x80" else c.encode("utf-8", "surrogatepass")[0]
                if at and self.never[last, first] and before.isalnum() and (before.isalpha() or before.isdecimal()):
                    cuts.append(at)
                before, last = c, ord(c) if c < "\x80" else c.encode("utf-8", "surrogatepass")[-1]
        return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]

    def __call__(self, text: str | None) -> list[int]:
        ids: list[int] = []
        known = self.known
        for fragment in self.fragments(text) if text else ():
            own = known.get(fragment)
            if own is None:
                own = self.whole.encode_ordinary(fragment)
                if len(known) < REMEMBERED:
                    known[fragment] = own
            ids.extend(own)
        return ids


def encoded(documents: DataFrame, folder: str = TOKENIZERS, name: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids) of (doc_id, text) rows, one for each row; null and empty texts get an empty list.

    The driver reads the vocabulary (about 1 MB) and sends it to the executors.
    """
    sent = documents.sparkSession.sparkContext.broadcast(load_ranks(folder, name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(sent.value)
        for batch in batches:
            ids = [encode(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")
