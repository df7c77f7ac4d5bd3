"""Exact dedup by an exchange of Golomb-coded fingerprints.

1. One scan computes each document's fingerprint (the first 8 bytes of the SHA-256 of its
   normalised text) and records it with the number of the scan's partition.
2. Each partition sends every owner (a range of the fingerprint space) its sorted distinct
   fingerprints, Rice-coded, a few bytes each. The owner answers with one bit a fingerprint:
   seen elsewhere, or twice in that partition.
3. Only documents with a set bit (suspects) shuffle their text: equal bytes are merged in the
   map task first, so a group holding a third of all rows sends one copy a task. The job fails
   rather than merge two texts that share a SHA-256.

A text is judged after deleting ``[\\x20\\x09-\\x0D]``; null counts as empty, and empty texts
are equal to each other. Of a group the row with the most code points stays, then the smallest
id (null ids last); of fully equal rows exactly one. Extra columns are ignored, an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidewright.llm.common import arrow_schema, free_names, given_back, power_of_two, record_batch, saved, small_batches, utf8, WHITE

#: Owners hold about this many fingerprints each, up to the largest number of owners.
PER_OWNER, MOST_OWNERS = 1 << 16, 4096
#: Bits of the suspect filter: 2 MB whatever the input. A full filter lets more text through, never less.
FILTER_BITS = 24

_NARROW = "part int,row long,id long,n_chars long,sha binary,fp long,check long,n_bytes long"


def rice_encode(values: np.ndarray, bits: int) -> bytes:
    """Sorted distinct uint64 values below 2**bits: a Rice parameter byte, unary quotients, fixed-width remainders."""
    gaps = np.diff(values, prepend=values[:1] * 0)
    b = max(0, bits - max(1, len(values)).bit_length())
    quotients = (gaps >> np.uint64(b)).astype(np.int64)
    unary = np.ones(int(quotients.sum()) + len(gaps), np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 0
    shifts = np.arange(b, dtype=np.uint64)
    fixed = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    return bytes([b]) + len(unary).to_bytes(8, "little") + np.packbits(unary).tobytes() + np.packbits(fixed.ravel()).tobytes()


def rice_decode(data: bytes, n: int) -> np.ndarray:
    b, long = data[0], int.from_bytes(data[1:9], "little")
    body = np.frombuffer(data, np.uint8, offset=9)
    cut = (long + 7) // 8
    zeros = np.flatnonzero(np.unpackbits(body[:cut], count=long) == 0)
    quotients = np.diff(zeros, prepend=-1).astype(np.uint64) - np.uint64(1)
    fixed = np.unpackbits(body[cut:], count=n * b).reshape(n, b).astype(np.uint64)
    remainders = (fixed << np.arange(b, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return np.cumsum((quotients << np.uint64(b)) | remainders, dtype=np.uint64)


@given_back
def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, part, row = arrow_schema(_NARROW), TaskContext.get().partitionId(), 0
    for batch in batches:
        shas, checks, sizes, chars = [], [], [], []
        for text in batch.column("text").to_pylist():
            bare = text.translate(None, WHITE)
            shas.append(hashlib.sha256(bare).digest())
            checks.append(xxhash.xxh3_64_intdigest(bare))
            sizes.append(len(bare))
            chars.append(len(text.decode("utf-8", "replace")))
        n = len(shas)
        heads = np.frombuffer(b"".join(s[:8] for s in shas), ">u8").astype(np.uint64).view(np.int64)
        yield record_batch(
            schema, part=np.full(n, part, np.int32), row=np.arange(row, row + n) + (part << 40),
            id=batch.column("id"), n_chars=chars, sha=shas, fp=heads,
            check=np.array(checks, np.uint64).view(np.int64), n_bytes=sizes,
        )
        row += n


def mark_suspects(narrow: DataFrame, owners: int) -> DataFrame:
    """``narrow`` (part, fp, ...) plus ``suspect``: the fingerprint occurs more than once in the table."""
    bits = 64 - (owners.bit_length() - 1)

    def send(table: pa.Table) -> pa.Table:
        prints, counts = np.unique(table.column("fp").to_numpy().view(np.uint64), return_counts=True)
        of = (prints >> np.uint64(bits)).astype(np.int64) if bits < 64 else np.zeros(len(prints), np.int64)
        cuts = np.flatnonzero(np.diff(of, prepend=-1))
        rows = []
        for start, stop in zip(cuts, [*cuts[1:], len(prints)]):
            own = prints[start:stop] & np.uint64((1 << bits) - 1)
            rows.append((int(of[start]), len(own), rice_encode(own, bits), np.packbits(counts[start:stop] > 1).tobytes()))
        part = table.column("part")[0].as_py()
        return pa.table({
            "part": pa.array([part] * len(rows), pa.int32()), "owner": pa.array([r[0] for r in rows], pa.int32()),
            "n": pa.array([r[1] for r in rows], pa.int32()), "coded": pa.array([r[2] for r in rows], pa.binary()),
            "twice": pa.array([r[3] for r in rows], pa.binary()),
        })

    def answer(table: pa.Table) -> pa.Table:
        sent = [(rice_decode(c, n), np.unpackbits(np.frombuffer(t, np.uint8), count=n).astype(bool))
                for c, n, t in zip(table.column("coded").to_pylist(), table.column("n").to_pylist(), table.column("twice").to_pylist())]
        prints, counts = np.unique(np.concatenate([p for p, _ in sent]), return_counts=True)
        again = prints[counts > 1]
        hits = [np.packbits(twice | np.isin(p, again, assume_unique=True)).tobytes() for p, twice in sent]
        return pa.table({"part": table.column("part"), "owner": table.column("owner"), "n": table.column("n"),
                         "hits": pa.array(hits, pa.binary())})

    def select(rows: pa.Table, answers: pa.Table) -> pa.Table:
        answers = answers.sort_by("owner")
        hits = np.concatenate([np.unpackbits(np.frombuffer(h, np.uint8), count=n).astype(bool)
                               for h, n in zip(answers.column("hits").to_pylist(), answers.column("n").to_pylist())])
        _, place = np.unique(rows.column("fp").to_numpy().view(np.uint64), return_inverse=True)
        return rows.append_column("suspect", pa.array(hits[place], pa.bool_()))

    sent = narrow.select("part", "fp").groupBy("part").applyInArrow(
        send, "part int, owner int, n int, coded binary, twice binary")
    answers = sent.groupBy("owner").applyInArrow(answer, "part int, owner int, n int, hits binary")
    return narrow.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(
        select, ", ".join(f"{n} {t}" for n, t in (*narrow.dtypes, ("suspect", "boolean"))))


def _suspect_filter(suspects: DataFrame) -> bytes:
    """A bitmap over the leading ``FILTER_BITS`` bits of the suspects' fingerprints, gathered in 4 kB pieces."""
    page = 1 << 15

    def piece(table: pa.Table) -> pa.Table:
        flags = np.zeros(page, np.uint8)
        flags[table.column("place").to_numpy() % page] = 1
        return pa.table({"page": table.column("page").slice(0, 1), "bits": pa.array([np.packbits(flags).tobytes()], pa.binary())})

    places = suspects.select(F.shiftrightunsigned("fp", 64 - FILTER_BITS).alias("place")).distinct()
    pieces = places.withColumn("page", (F.col("place") / page).cast("int")).groupBy("page").applyInArrow(piece, "page int, bits binary")
    out = bytearray((1 << FILTER_BITS) // 8)
    for page_no, bits in pieces.toLocalIterator():
        out[page_no * page // 8:(page_no + 1) * page // 8] = bits
    return bytes(out)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256 (hex)."""
    texts = small_batches(docs).select(F.col(id_col).cast("long").alias("id"), utf8(text_col).alias("text"))
    narrow = saved(texts.mapInArrow(_scan, _NARROW.replace(",", ", ")), "prints")
    marked = saved(mark_suspects(narrow, power_of_two(docs.count() / PER_OWNER, 16, MOST_OWNERS)), "suspects")
    suspects = marked.where("suspect")
    flags = docs.sparkSession.sparkContext.broadcast(_suspect_filter(suspects))

    @given_back
    def suspect_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, schema = flags.value, arrow_schema("sha binary,bare binary")
        for batch in batches:
            shas, bares = [], []
            for text in batch.column("text").to_pylist():
                bare = text.translate(None, WHITE)
                sha = hashlib.sha256(bare).digest()
                place = int.from_bytes(sha[:8], "big") >> (64 - FILTER_BITS)
                if bitmap[place >> 3] & (128 >> (place & 7)):
                    shas.append(sha)
                    bares.append(bare)
            yield record_batch(schema, sha=shas, bare=bares)

    # One row per byte string and SHA; a SHA with two byte strings stops the job.
    verified = (
        texts.select("text").mapInArrow(suspect_texts, "sha binary, bare binary")
        .groupBy("sha", "bare").agg(F.lit(1).alias("one"))
        .groupBy("sha").agg(F.count("*").alias("variants"))
        .select("sha", F.when(F.col("variants") > 1, F.raise_error(F.lit("two texts share a SHA-256")).cast("long"))
                .otherwise(F.col("variants")).alias("variants"))
    )
    best = F.struct("n_chars", F.col("id").isNotNull().alias("known"), (-F.col("id")).alias("low"), "row")
    groups = suspects.groupBy("sha", "check", "n_bytes").agg(
        F.max_by(F.struct("id", "row"), best).alias("keep"), F.count("*").alias("size"))
    # Fingerprints may agree where texts do not: such a group has one row and stays whole.
    groups = groups.join(verified, "sha").select("sha", "check", "n_bytes", "keep", (F.col("size") * F.col("variants")).alias("size"))
    grouped = suspects.join(groups, ["sha", "check", "n_bytes"]).select(
        F.col("id").alias(id_col), F.col("keep.id").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("row") == F.col("keep.row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
    alone = marked.where("not suspect").select(
        F.col("id").alias(id_col), F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
    return alone.unionByName(grouped)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`exact_dedup` keeps, all columns unchanged."""
    key, of = free_names(docs, "_key", "_kept")
    kept = exact_dedup(docs, id_col, text_col).where("kept").select(_row_key(F.col(id_col), F.col("text_sha256")).alias(of))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    bare = F.translate(text, WHITE.decode(), "")
    keyed = docs.withColumn(key, _row_key(F.col(id_col), F.sha2(bare.cast("binary"), 256)))
    rows = keyed.join(kept, F.col(key) == F.col(of), "left_semi")
    # Rows may share an id and a text: the one with the most code points stays.
    first = rows.groupBy(key).agg(F.max_by(F.struct(*docs.columns), F.struct(F.length(text), text)).alias("row"))
    return first.select("row.*")


def _row_key(doc_id, sha):
    return F.concat(F.coalesce(doc_id.cast("long").cast("string"), F.lit("-")), F.lit(":"), sha)
