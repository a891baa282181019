"""Token counts: batch encoding in Arrow functions that return lengths only.

Texts are split at safe boundaries, places where no token of the tokenizer can lie across, so that the
counts of the pieces add up to the count of the text. For byte-level BPE with the usual word pattern, a
white-space character after a character that is none is such a place: no class of the pattern goes from
one to the other. Pieces of ordinary words recur all the time, so every worker remembers the counts of
short pieces (REMEMBERED of them at most, then it starts anew) and encodes only new ones, in batches of
BATCH_BYTES. A tokenizer whose rules don't grant safe boundaries (another pattern, a normaliser, added
tokens with white space, SentencePiece models) gets whole texts, in batches by bytes as well.

The tokenizer's file is read by the driver and broadcast, so executors need no copy of it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path
from typing import ClassVar

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: UTF-8 bytes of a batch, about; a longer piece is a batch of its own.
BATCH_BYTES = 256 << 10
#: Pieces a worker remembers, and the characters of the longest one of them.
REMEMBERED, SHORT = 1 << 19, 64
#: Unicode White_Space, as the word pattern's \s has it, for a character class.
SPACE = "\t\n\x0b\x0c\r \x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
PIECE = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
#: Inside longer pieces: between an ASCII letter and a digit the pattern changes its class as well.
INNER = re.compile("(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")


def has_safe_boundaries(rules: dict) -> bool:
    """Whether a tokenizer's file has the byte-level word pattern and nothing that could cross a boundary."""
    pre, added = rules.get("pre_tokenizer") or {}, rules.get("added_tokens") or []
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    crossing = any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(f"[{SPACE}]", t["content"]) or INNER.search(t["content"]) for t in added)
    model = rules.get("model") or {}
    return plain and not crossing and rules.get("normalizer") is None and model.get("type") == "BPE" and not model.get("dropout")


def pieces(text: str) -> list[str]:
    """Pieces of a text between safe boundaries; joined they are the text."""
    found = PIECE.findall(text)
    if any(len(p) > SHORT for p in found):
        found = [q for p in found for q in (INNER.split(p) if len(p) > SHORT else [p])]
    return found


def batches_by_bytes(texts: Iterable[str], most: int = BATCH_BYTES) -> Iterator[list[str]]:
    """Runs of texts of `most` bytes each, about, taking four bytes a character at worst."""
    batch, size = [], 0
    for t in texts:
        n = len(t) if t.isascii() else len(t.encode("utf-8", "surrogatepass"))
        if batch and size + n > most:
            yield batch
            batch, size = [], 0
        batch.append(t)
        size += n
    if batch:
        yield batch


class Counter:
    """Counts of texts by one tokenizer file; lives in a worker, over its tasks."""

    live: ClassVar[dict] = {}

    @classmethod
    def of(cls, file: bytes, kind: str) -> Counter:
        if (file, kind) not in cls.live:
            cls.live = {(file, kind): cls(file, kind)}  # one tokenizer at a time, so that memory stays bounded
        return cls.live[file, kind]

    def __init__(self, file: bytes, kind: str):
        self.safe, self.known = False, {}
        if kind == ".json":
            import os

            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
            from tokenizers import Tokenizer

            own = Tokenizer.from_str(file.decode())
            own.no_padding(), own.no_truncation()
            self.safe = has_safe_boundaries(json.loads(file))
            self.encode: Callable[[list[str]], list[int]] = lambda texts: [len(e) for e in own.encode_batch_fast(texts, add_special_tokens=False)]
        elif kind == ".model":
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_proto=file)
            self.encode = lambda texts: [len(e) for e in model.encode(texts, num_threads=1)]
        else:
            raise ValueError(f"a tokenizer file ends in .json or .model, not in {kind}")

    def _learn(self, new: set[str]) -> dict[str, int]:
        order = sorted(new, key=len)
        return dict(zip(order, (n for batch in batches_by_bytes(order) for n in self.encode(batch))))

    def counts(self, texts: list[str]) -> list[int]:
        if not self.safe:
            order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
            found = (n for batch in batches_by_bytes(texts[i] for i in order) for n in self.encode(batch))
            return [n for _, n in sorted(zip(order, found))]
        out = []
        for text in texts:
            own = pieces(text)
            long = [p for p in own if len(p) > SHORT]
            fresh = {p for p in own if p not in self.known}.difference(long)
            if fresh:
                if len(self.known) + len(fresh) > REMEMBERED:
                    self.known.clear()
                    fresh = {p for p in own if len(p) <= SHORT}
                self.known.update(self._learn(fresh))
            n = 0
            if long:
                n = sum(c for batch in batches_by_bytes(long) for c in self.encode(batch))
                own = [p for p in own if len(p) <= SHORT]
            out.append(n + sum(map(self.known.__getitem__, own)))
        return out


def count_tokens(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = 1024) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) for each row: UTF-8 bytes, tokens of the whole text, n_tokens > limit.

    `tokenizer` is a .json file of the tokenizers library or a .model file of SentencePiece; counts are those
    of that library without begin, end or added special tokens, padding or truncation, and strings of
    special tokens inside a text are handled as its default is. A null or empty text has 0 bytes and 0
    tokens; bytes that aren't UTF-8 count as they are and are encoded as replacement characters. Texts of
    any length are counted whole. Rows are independent: repeated rows repeat, null keys stay null, an empty
    table gives no rows, other columns are not read. No shuffle.
    """
    import pyarrow as pa

    path = Path(tokenizer)
    file = docs.sparkSession.sparkContext.broadcast((path.read_bytes(), path.suffix))
    names = [key, "n_bytes", "n_tokens"]

    def count(it):
        counter = Counter.of(*file.value)
        for b in it:
            raw = [x.as_py() or b"" for x in b.column(1)]
            n = counter.counts([x.decode("utf-8", "replace") for x in raw])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) for x in raw], pa.int64()), pa.array(np.array(n, np.int64))], names)

    rows = docs.select(F.col(key).alias("k"), F.col(text).cast("binary").alias("t"))
    kind = docs.schema[key].dataType.simpleString()
    counted = rows.mapInArrow(count, f"`{key}` {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
