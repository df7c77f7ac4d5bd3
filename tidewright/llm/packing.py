"""Hierarchical multi-length packing into fixed token windows.

Each document becomes its ids plus an end id. Whole windows are cut off first. What is left is
routed to a tier by length: (512, 1024], (256, 512], ... for a window of 1024. Every tier opens windows of
its own size, longest tier first; the gap behind a document is filled with the longest remainder from the
shorter tiers that fits, and at last by cutting the shortest one, whose rest is routed again. When a pool of
documents runs out, its open tokens are laid out as sequences whose lengths are powers of two, which need no
padding. Sequences of a tier are numbered over all tasks and dealt into steps of ``STEP_TOKENS``, so a step
group holds one length only and all groups weigh the same, but for the last one of each tier.

The packing moves no text: a pool is a bounded run of documents in one task, and a pool leaves no
padding, so merging pools could not save any. The pieces are saved once, as the numbers need the sequences
of every task and tier counted. Ids come from the vocabulary file of the tokenizer,
whose path is a parameter; pieces between spaces are encoded once and kept, as the tokenizer never
joins across them. A text that spells a special token goes to the tokenizer whole, which gives it that token's id.

Null text is empty and gives the end id only. Repeated rows are packed as separate documents. A
document longer than a pool is a pool of its own. Extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import cached_property

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidewright.llm.common import arrow_schema, given_back, kept, record_batch, saved, small_batches

WINDOW, END = 1024, 0
#: Tokens of a pool (4 bytes each), documents of a pool, tokens of a step group, kept encodings.
POOL_TOKENS, POOL_DOCS, STEP_TOKENS, KEPT = 2 << 20, 4096, 1 << 16, 120_000
#: Characters of a kept piece; with its ids one takes 400 bytes or less, so a task keeps under 50 MB.
LONGEST_KEPT = 48

#: A space inside a run of white space that is not the run's last: there pieces depend on each other.
_ODD = re.compile(r"\s (?=\s|$)")


def _bytes(ids: list[int]) -> bytes:
    """Unsigned, 32 bits, little-endian."""
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit integers. The vocabulary stays with the worker for one stage; kept pieces go with their task."""

    def __init__(self, path: str):
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = {chr(c): b for b, c in _byte_letters().items()}
        self.special = tuple(t["content"] for t in spec.get("added_tokens", ()))
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        self.fast = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.kept: dict[str, bytes] = {}

    def piece(self, text: str) -> bytes:
        found = self.kept.get(text)
        if found is None:
            # The two libraries give the same ids; their Unicode tables may differ beyond the Latin blocks.
            ids = self.fast.encode_ordinary(text) if text.isascii() or max(text) < "ɐ" else self._slow(text)
            found = _bytes(ids)
            if len(self.kept) < KEPT and len(text) <= LONGEST_KEPT:
                self.kept[text] = found
        return found

    @cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _slow(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> bytes:
        if any(token in text for token in self.special) or _ODD.search(text):
            return _bytes(self._slow(text))
        get, piece = self.kept.get, self.piece
        first, *rest = text.split(" ")
        head = [piece(first)] if first else []
        return b"".join(head + [get(p) or piece(p) for p in [" " + r for r in rest]])


def _byte_letters() -> dict[int, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(others)}


def encoder(path: str) -> Encoder:
    return kept(f"encoder {path}", lambda: Encoder(path))


def pack(lengths: list[int], window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length); every sequence is full or a power of two long."""
    sequences, left = [], []
    for i, n in enumerate(lengths):
        whole = n // window
        sequences += [[(i, j * window, window)] for j in range(whole)]
        if n % window:
            left.append((n % window, -i, whole * window))
    left.sort()
    while left:
        length, i, start = left.pop()
        tier = min(window, 1 << (length - 1).bit_length())
        sequence, gap = [(-i, start, length)], tier - length
        while gap and left:
            at = bisect_right(left, (gap, 1, 0)) - 1
            if at >= 0:
                length, i, start = left.pop(at)
                sequence.append((-i, start, length))
            else:  # none fits: cut the shortest
                length, i, start = left.pop(0)
                sequence.append((-i, start, gap))
                left.insert(bisect_right(left, (length - gap, i, start + gap)), (length - gap, i, start + gap))
                length = gap
            gap -= length
        if not gap:
            sequences.append(sequence)
        else:  # the pool is used up: powers of two, largest first
            size, room, part = tier - gap, 0, []
            for i, start, length in sequence:
                while length:
                    if not room:
                        room = 1 << (size.bit_length() - 1)
                        size -= room
                        part = []
                        sequences.append(part)
                    take = min(room, length)
                    part.append((i, start, take))
                    start, length, room = start + take, length - take, room - take
    return sequences


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group and, with_ids, ids."""
    fields = ("id long,start long,length long,ids_crc32 long,doc_tokens long,sequence_id long,offset long,"
              "tier int,task long,place long,ids binary")

    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, coder, end = arrow_schema(fields), encoder(path), END.to_bytes(4, "little")
        task, places = TaskContext.get().partitionId(), defaultdict(int)
        pool, tokens, made = [], 0, 0

        def flush():
            nonlocal made
            rows = []
            for pieces in pack([len(ids) // 4 for _, ids in pool], window):
                tier, offset = sum(p[2] for p in pieces), 0
                for i, start, length in pieces:
                    ids = pool[i][1][4 * start:4 * (start + length)]
                    rows.append((pool[i][0], start, length, zlib.crc32(ids), len(pool[i][1]) // 4, (task << 40) + made, offset, tier, task,
                                 places[tier], ids if with_ids else None))
                    offset += length
                places[tier] += 1
                made += 1
            columns = list(zip(*rows)) or [[]] * len(schema)
            return record_batch(schema, **dict(zip(schema.names, map(list, columns))))

        for batch in batches:
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                pool.append((doc_id, coder.ids(text.as_py()) + end))
                tokens += len(pool[-1][1]) // 4
                if tokens >= POOL_TOKENS or len(pool) >= POOL_DOCS:
                    yield flush()
                    pool, tokens = [], 0
        if pool:
            yield flush()
        coder.kept.clear()

    texts = small_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    packed = saved(texts.mapInArrow(run, fields.replace(",", ", ")), "packed")
    # One row a task and tier: the number of its first sequence among all of the tier.
    before = Window.partitionBy("tier").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = (packed.groupBy("task", "tier").agg((F.max("place") + 1).alias("n"))
             .select("task", "tier", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    step = (F.shiftleft(F.col("tier").cast("long"), 44) + F.floor((F.col("first") + F.col("place")) * F.col("tier") / STEP_TOKENS)).alias("step_group")
    columns = [c.split()[0] for c in fields.split(",") if c.split()[0] not in ("task", "place", "ids")]
    numbered = packed.join(first, ["task", "tier"]).select(*columns, step, *["ids"] * with_ids)
    return numbered.withColumnRenamed("id", id_col)
