"""Substring dedup with super-k-mers.

A window is ``k`` consecutive words of one document. Each window's minimiser is the ``m``-word
run in it with the least hash. Consecutive windows that share a minimiser travel together as one
packed string to the bucket of that minimiser, where equal windows must meet. In a bucket the
windows are sorted by (hash, document, start); rows whose hashes agree are compared byte by byte,
and every window but the first of its text is reported back. A word is removed when a reported
window covers it; windows are judged on the input.

Hot keys: a first pass counts all runs and lists those above a fixed share of them (the list's
length is bounded by that share). A listed run ranks after all others, so a window
takes it only when every run in it is listed: then it lies inside a passage that many documents
share, its super-k-mer is the same string everywhere, and tasks send each string once. Strings
repeated within a task are resolved there: all their windows start earlier in the first copy.

Words are runs of ``[^\\x20\\x09-\\x0D]``, unchanged; null has none. Documents are ordered by id,
null ids last; rows with equal id and equal words are one document listed twice and are judged
alike, rows with equal id and other words are ordered by a hash of the words. Extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from tidewright.llm.common import arrow_schema, power_of_two, record_batch, saved, small_batches, utf8
from tidewright.llm.tokens import Stretches

WINDOW, RUN = 20, 3
#: Runs above this share of all runs are listed as hot: 131,072 entries, 1 MB, at most. Below it a run's bucket stays
#: within its mean size plus this share of the corpus.
HOT_SHARE = 1 / (1 << 17)
#: Text bytes that a bucket should hold, that are hashed at once, and that a task gathers before it sends.
BUCKET_BYTES, PIECE_BYTES, FLUSH_BYTES, MOST_BUCKETS = 4 << 20, 1 << 20, 24 << 20, 1 << 16


class Words(Stretches):
    """Words of one-space-joined texts laid end to end, with hashes of any stretch of words."""

    def __init__(self, data: bytes):
        super().__init__(data)
        gaps = np.flatnonzero(self.raw == 32)
        self.starts = np.concatenate([[0], gaps + 1])
        self.ends = np.concatenate([gaps, [len(data)]])

    def hashes(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return self.hash(self.starts[first], self.ends[last])


def split(words: Words, lengths: np.ndarray, k: int, m: int, hot: np.ndarray):
    """Super-k-mers of documents with ``lengths`` words: (minimiser hash, first word, number of windows, document)."""
    docs = np.repeat(np.arange(len(lengths)), np.maximum(lengths - k + 1, 0))
    if not len(docs):
        return None
    offsets = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    seen = np.concatenate([[0], np.cumsum(np.maximum(lengths - k + 1, 0))])[:-1]
    starts = np.arange(len(docs)) - seen[docs] + offsets[docs]
    runs = np.arange(int(lengths.sum()) - m + 1)
    value = words.hashes(runs, runs + m - 1)
    value >>= np.uint64(1)
    if len(hot):
        listed = hot[np.minimum(np.searchsorted(hot, value), len(hot) - 1)] == value
        value[listed] |= np.uint64(1 << 63)
    # Least hash over the k - m + 1 runs of a window, by doubling.
    width, done, least = k - m + 1, 1, value
    while done * 2 <= width:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    if done < width:
        rest = width - done
        least = np.minimum(least[:-rest], least[rest:])
    of = least[starts]
    heads = np.flatnonzero((np.diff(of, prepend=of[:1] + np.uint64(1)) != 0) | (np.diff(docs, prepend=-1) != 0))
    counts = np.diff(np.append(heads, len(of)))
    return of[heads] & np.uint64((1 << 63) - 1), starts[heads], counts, docs[heads]


def document_key(line: bytes) -> int:
    return xxhash.xxh3_64_intdigest(line) >> 1


def _pieces(batches: Iterator[pa.RecordBatch], k: int):
    """Bounded lists of (id, key, first word, words joined, number of words); a long text is cut with k - 1 words of overlap."""
    rows, size = [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text")):
            words = text.as_py().split()
            if len(words) < k:
                continue
            line = b" ".join(words)
            key = document_key(line)
            step = len(words) if len(line) <= PIECE_BYTES else max(1, len(words) * PIECE_BYTES // len(line))
            for at in range(0, len(words) - k + 1, step):
                part = words[at:at + step + k - 1]
                rows.append((doc_id, key, at, line if len(part) == len(words) else b" ".join(part), len(part)))
                size += len(rows[-1][3])
                if size >= PIECE_BYTES:
                    yield rows
                    rows, size = [], 0
    if rows:
        yield rows


def repeated_windows(texts: DataFrame, n_bytes: int, k: int = WINDOW, m: int = RUN) -> DataFrame:
    """(id, key, start, n): windows start..start+n-1 of a document whose words also start earlier. ``texts``: id, text (binary)."""
    spark = texts.sparkSession
    buckets = power_of_two(3 * n_bytes / BUCKET_BYTES, 16, MOST_BUCKETS)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("run long,n long")
        for rows in _pieces(batches, k):
            words = Words(b" ".join(r[3] for r in rows))
            at = np.arange(len(words.starts) - m + 1)
            value, counts = np.unique(words.hashes(at, at + m - 1) >> np.uint64(1), return_counts=True)
            many = counts > max(1, int(len(at) * HOT_SHARE))
            yield record_batch(schema, run=np.append(value[many].view(np.int64), -1), n=np.append(counts[many], len(at)))

    tallied = saved(texts.mapInArrow(tally, "run long, n long").groupBy("run").agg(F.sum("n").alias("n")), "runs")
    total = tallied.where("run = -1").agg(F.sum("n")).first()[0] or 0
    listed = tallied.where((F.col("run") >= 0) & (F.col("n") > max(64, total * HOT_SHARE))).select("run")
    hot = spark.sparkContext.broadcast(np.sort(listed.toArrow().column("run").to_numpy()).view(np.uint64))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("bucket int,packed binary,id long,key long,start int,n int")
        squeeze = zstandard.ZstdCompressor(level=7).compress
        pending: dict[int, list[tuple[np.ndarray, bytes]]] = {}
        held = 0

        def flush():
            buckets_now = sorted(pending)
            packs = []
            for bucket in buckets_now:
                head = np.concatenate([h for h, _ in pending[bucket]], axis=1)
                packs.append(squeeze(head.shape[1].to_bytes(4, "little") + head.tobytes() + b" ".join(t for _, t in pending[bucket])))
            none = pa.nulls(len(packs), pa.int64())
            pending.clear()
            return record_batch(schema, bucket=buckets_now, packed=packs, id=none, key=none,
                                start=none.cast(pa.int32()), n=none.cast(pa.int32()))

        for rows in _pieces(batches, k):
            words = Words(b" ".join(r[3] for r in rows))
            lengths = np.array([r[4] for r in rows])
            value, first, count, doc = split(words, lengths, k, m, hot.value)
            ids = np.array([-1 if r[0] is None else r[0] for r in rows], np.int64)[doc]
            known = np.array([r[0] is not None for r in rows])[doc]
            keys = np.array([r[1] for r in rows], np.int64)[doc]
            local = first - (np.cumsum(lengths) - lengths)[doc] + np.array([r[2] for r in rows])[doc]
            data, begin, end = words.data, words.starts[first].tolist(), words.ends[first + count + k - 2].tolist()
            # In the order of documents, then of starts: the first copy of a string is its earliest.
            order = np.lexsort((local, keys, ids, ~known))
            fresh, mine, again = {}, [], []
            for i in order.tolist():
                j = fresh.setdefault(data[begin[i]:end[i]], i)
                if j == i:
                    mine.append(i)
                elif (ids[i], known[i], keys[i], local[i]) != (ids[j], known[j], keys[j], local[j]):
                    again.append(i)
            of = (value & np.uint64(buckets - 1)).astype(np.int64)
            if again:
                i = np.array(again)
                yield record_batch(schema, bucket=of[i].astype(np.int32), packed=pa.nulls(len(i), pa.binary()),
                                   id=pa.array(ids[i], mask=~known[i]), key=keys[i],
                                   start=local[i].astype(np.int32), n=count[i].astype(np.int32))
            i = np.array(mine)
            i = i[np.argsort(of[i], kind="stable")]
            cuts = np.flatnonzero(np.diff(of[i], prepend=-1))
            for start, stop in zip(cuts, [*cuts[1:], len(i)]):
                j = i[start:stop]
                head = np.array([ids[j], known[j], keys[j], local[j], count[j]], np.int64)
                text = b" ".join([data[begin[x]:end[x]] for x in j.tolist()])
                pending.setdefault(int(of[j[0]]), []).append((head, text))
                held += len(text)
            if held >= FLUSH_BYTES:
                yield flush()
                held = 0
        if pending:
            yield flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket; ranges that a map task has settled pass through."""
        schema, now, packs = arrow_schema("id long,key long,start int,n int"), None, []
        for batch in batches:
            settled = batch.filter(batch.column("packed").is_null())
            if settled.num_rows:
                yield settled.select(["id", "key", "start", "n"])
            for bucket, packed in zip(batch.column("bucket").to_pylist(), batch.column("packed").to_pylist()):
                if packed is not None:
                    if bucket != now:
                        yield from _judge(packs, k, schema)
                        now, packs = bucket, []
                    packs.append(packed)
        yield from _judge(packs, k, schema)

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(buckets, 4096) // 8)
    return (texts.mapInArrow(send, "bucket int, packed binary, id long, key long, start int, n int")
            .repartition(parts, "bucket").sortWithinPartitions("bucket")
            .mapInArrow(meet, "id long, key long, start int, n int"))


def _judge(packs: list[bytes], k: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Windows of one bucket that are not the first of their text."""
    if not packs:
        return
    heads, lines = [], []
    expand = zstandard.ZstdDecompressor().decompress
    for packed in packs:
        raw = expand(packed)
        n = int.from_bytes(raw[:4], "little")
        heads.append(np.frombuffer(raw, np.int64, 5 * n, 4).reshape(5, n))
        lines.append(raw[4 + 40 * n:])
    ids, known, keys, first, count = np.concatenate(heads, axis=1)
    words = Words(b" ".join(lines))
    which = np.repeat(np.arange(len(count)), count)
    inner = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    at = np.repeat(np.cumsum(count + k - 1) - (count + k - 1), count) + inner
    value = words.hashes(at, at + k - 1)
    start = first[which] + inner
    order = np.lexsort((start, keys[which], ids[which], 1 - known[which], value))
    same = np.diff(value[order], prepend=value[order[:1]] + np.uint64(1)) == 0
    group = np.cumsum(~same) - 1
    head = order[np.flatnonzero(~same)][group]
    place = np.argsort(order)
    left, right = order[same], head[same]
    data, b, e = words.data, words.starts[at], words.ends[at + k - 1]
    equal = np.fromiter((data[p:q] == data[r:s] for p, q, r, s in zip(
        b[left].tolist(), e[left].tolist(), b[right].tolist(), e[right].tolist())), bool, len(left))
    hit = np.zeros(len(which), bool)
    hit[left[equal]] = True
    identity = np.array([ids, known, keys])
    if not equal.all():  # hashes agree, texts do not: settle those groups by their texts
        firsts: dict[bytes, int] = {}
        unsure = np.isin(head[place], right[~equal])
        for i in order.tolist():
            if unsure[i]:
                hit[i] = firsts.setdefault(data[b[i]:e[i]], i) != i
                head[place[i]] = firsts[data[b[i]:e[i]]]
    # A row listed twice is one document: its own windows are not earlier ones.
    by = head[place]
    hit &= (start != start[by]) | (identity[:, which] != identity[:, which[by]]).any(axis=0)
    if not hit.any():
        return
    # Neighbouring hits of a super-k-mer travel as one range.
    i = np.flatnonzero(hit)
    new = (np.diff(i, prepend=-2) != 1) | (np.diff(which[i], prepend=-1) != 0)
    cuts = np.flatnonzero(new)
    h = i[cuts]
    yield record_batch(schema, id=pa.array(ids[which[h]], mask=known[which[h]] == 0), key=keys[which[h]],
                       start=start[h].astype(np.int32), n=np.diff(np.append(cuts, len(i))).astype(np.int32))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """One row per document: id, n_words, n_removed, kept_sha256 and, with_text, kept (the words that stay, joined by one space)."""
    texts = small_batches(docs).select(F.col(id_col).cast("long").alias("id"), utf8(text_col).alias("text"))
    n_bytes = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    ranges = repeated_windows(texts, n_bytes).groupBy("id", "key").agg(F.collect_list(F.struct("start", "n")).alias("ranges"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, squeeze = arrow_schema("id long,key long,line binary"), zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            keys, lines = [], []
            for text in batch.column("text"):
                line = b" ".join(text.as_py().split())
                keys.append(document_key(line))
                lines.append(squeeze(line))
            yield record_batch(schema, id=batch.column("id"), key=keys, line=lines)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("id long,n_words long,n_removed long,kept_sha256 string,kept binary")
        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = ([], [], [], [])
            for line, ranges in zip(batch.column("line").to_pylist(), batch.column("ranges").to_pylist()):
                line = expand(line)
                words = line.split()
                n, gone = len(words), 0
                if ranges:
                    steps = np.zeros(n + 1, np.int32)
                    np.add.at(steps, [r["start"] for r in ranges], 1)
                    np.add.at(steps, [r["start"] + r["n"] + WINDOW - 1 for r in ranges], -1)
                    stay = np.cumsum(steps[:-1]) == 0
                    gone = n - int(stay.sum())
                    line = b" ".join([words[i] for i in np.flatnonzero(stay).tolist()])
                for column, x in zip(out, (n, gone, hashlib.sha256(line).hexdigest(), line)):
                    column.append(x)
            yield record_batch(schema, id=batch.column("id"), n_words=out[0], n_removed=out[1], kept_sha256=out[2],
                               kept=out[3] if with_text else pa.nulls(len(out[3]), pa.binary()))

    rows = texts.mapInArrow(keyed, "id long, key long, line binary")
    joined = rows.join(ranges.withColumnRenamed("id", "of").withColumnRenamed("key", "word_key"),
                       F.col("id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("word_key")), "left")
    cleaned = joined.select("id", "line", "ranges").mapInArrow(
        cut, "id long, n_words long, n_removed long, kept_sha256 string, kept binary").withColumnRenamed("id", id_col)
    return cleaned.withColumn("kept", F.col("kept").cast("string")) if with_text else cleaned.drop("kept")
