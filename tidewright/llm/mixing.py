"""Mixing sources to target weights by pivotal dependent rounding.

A source's target is its weight's share of all words, at most ``most`` times the source's words;
what a capped source leaves is shared again by weight until none is above its cap. Each document
should be taken target / words times: the whole part is certain, the fraction is a probability.

Within a source the fractions are rounded in pairs. Words move from one document of the pair to the
other, in a random direction whose odds keep every expectation, until one of the two is taken wholly
or not at all; the other meets the next document. The words taken therefore never drift from the
target: only the last document of a source is open. It goes to the nearer side, and documents of
the last node that fit into the words it is off by change sides too, largest first. Chunks of a
source are rounded side by side and their one open document each moves up a reduction tree.

Random numbers are hashes of the seed and the two documents, so reruns agree. Sources are ordered by
code point (Spark's byte order of UTF-8), null last, and are one narrow row each. Null text has size 0
and is taken 0 words; sizes of 0 everywhere give targets of 0. Repeated rows are separate documents;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tidewright.llm.common import free_names, saved

#: Documents rounded by one task call, and open documents that meet in one node of the tree.
CHUNK, FAN = 4096, 256
WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3.0
_EPS = 1e-9


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size, n, target) of ``sizes`` (source, size); weights repeat along the ordered sources."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    place = (F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1) % len(weights)
    table = saved(per.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), (place + 1).cast("int"))), "sources")
    total = float(table.agg(F.sum("source_size")).first()[0] or 0)
    level, cap = 0.0, most * F.col("source_size")
    while total > 0:
        # Sources whose share at this level is above their cap stay at the cap; the rest is shared by weight.
        capped = (F.col("weight") * level > cap) if level else F.lit(False)
        fixed, free = table.agg(F.sum(F.when(capped, cap)), F.sum(F.when(~capped, F.col("weight")))).first()
        if not free:
            break
        raised = (total - float(fixed or 0)) / free
        if raised <= level * (1 + 1e-15):
            break
        level = raised
    return table.select("source", "source_size", "n", F.least(cap.cast("double"), F.col("weight") * F.lit(level)).alias("target"))


def _round_chunk(size: np.ndarray, prob: np.ndarray, ids: list[int], seed: int) -> tuple[np.ndarray, int]:
    """Probabilities after pairing the documents in the given order; the index of the open one, or -1."""
    p, opened = prob.copy(), -1
    for j in range(len(p)):
        if p[j] <= _EPS or p[j] >= 1 - _EPS or size[j] == 0:
            p[j] = round(p[j]) if size[j] else 0.0
            continue
        if opened < 0:
            opened = j
            continue
        i, si, sj = opened, float(size[opened]), float(size[j])
        up = min((1 - p[i]) * si, p[j] * sj)      # words that can move to i
        down = min(p[i] * si, (1 - p[j]) * sj)    # words that can move to j
        draw = xxhash.xxh3_64_intdigest(f"{seed}:{ids[i]}:{ids[j]}".encode()) / 2.0 ** 64
        moved = up if draw * (up + down) < down else -down
        p[i] += moved / si
        p[j] -= moved / sj
        for x in (i, j):
            if p[x] <= _EPS or p[x] >= 1 - _EPS:
                p[x] = round(p[x])
        opened = next((x for x in (i, j) if 0 < p[x] < 1), -1)
    return p, opened


def _close(size: np.ndarray, prob: np.ndarray, p: np.ndarray, opened: int) -> None:
    """Round the open document to the nearer side and let smaller ones make up for it."""
    off = (p[opened] - round(p[opened])) * float(size[opened])  # words still to take, or taken too many
    p[opened] = round(p[opened])
    for j in range(len(p)):
        if j != opened and _EPS < prob[j] < 1 - _EPS and 0 < size[j] <= abs(off) and p[j] == (off < 0):
            off += size[j] if off < 0 else -size[j]
            p[j] = 1 - p[j]


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = WEIGHTS, most: float = MOST, seed: int = 42) -> DataFrame:
    """One row per document: id, source, size, source_size, target, copies, taken, text_hash (XXH64 of the text)."""
    sizes = saved(docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"), F.monotonically_increasing_id().alias("uid")), "sizes")
    plan = saved(targets(sizes, weights, most), "targets")
    chunks = F.greatest(F.lit(1), F.ceil(F.col("n") / CHUNK)).cast("long")
    wanted = (
        sizes.join(plan, sizes["source"].eqNullSafe(plan["source"])).drop(plan["source"])
        .withColumn("times", F.when(F.col("source_size") > 0, F.least(F.lit(most), F.col("target") / F.col("source_size"))).otherwise(0.0))
        .withColumn("whole", F.floor(F.col("times") + _EPS))
        .withColumn("p", F.greatest(F.lit(0.0), F.col("times") - F.col("whole")))
        .withColumn("node", F.pmod(F.xxhash64("id", "size"), chunks)))
    fields = "uid long, id long, source string, size long, node long, p double, open boolean"

    def settle(last: bool):
        def chunk(table: pa.Table) -> pa.Table:
            size, p = table.column("size").to_numpy(), table.column("p").to_numpy()
            ids = [(-1 << 62) if x is None else x for x in table.column("id").to_pylist()]
            # Large documents first, so that the open one is small.
            order = np.lexsort((table.column("uid").to_numpy(), np.array(ids, np.int64), -size))
            rounded, opened = _round_chunk(size[order], p[order], [ids[i] for i in order], seed)
            if last and opened >= 0:
                _close(size[order], p[order], rounded, opened)
                opened = -1
            out, flags = np.empty_like(p), np.zeros(len(p), bool)
            out[order] = rounded
            if opened >= 0:
                flags[order[opened]] = True
            at = table.column_names
            return (table.set_column(at.index("p"), "p", pa.array(out)).set_column(at.index("open"), "open", pa.array(flags)))
        return chunk

    def rounded(rows: DataFrame, last: bool) -> DataFrame:
        return saved(rows.groupBy("source", "node").applyInArrow(settle(last), fields), "rounded")

    depth, most_chunks = 1, max(1.0, (plan.agg(F.max("n")).first()[0] or 0) / CHUNK)
    while most_chunks > 1:
        depth, most_chunks = depth + 1, most_chunks / FAN
    level = rounded(wanted.select("uid", "id", "source", "size", "node", "p", F.lit(False).alias("open")), depth == 1)
    decided = level.where("not open")
    for step in range(1, depth):
        opened = level.where("open").withColumn("node", F.floor(F.col("node") / FAN)).withColumn("open", F.lit(False))
        level = rounded(opened, step == depth - 1)
        decided = decided.unionByName(level.where("not open"))
    extra = decided.select("uid", F.round("p").cast("long").alias("extra"))
    return (wanted.join(extra, "uid")
            .withColumn("copies", F.col("whole").cast("long") + F.col("extra"))
            .select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken"), "text_hash"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, all columns unchanged."""
    decided = mix(docs, id_col, text_col, source_col, **options)
    # Rows that share id and text are interchangeable: their copies are summed.
    own, own_id, of, of_id, copies, copy = free_names(docs, "_own", "_as", "_hash", "_id", "_times", "_copy")
    times = decided.where("copies > 0").groupBy(F.col(id_col).alias(of_id), F.col("text_hash").alias(of)).agg(F.sum("copies").cast("int").alias(copies))
    keyed = docs.withColumn(own, F.xxhash64(F.col(text_col).cast("string"))).withColumn(own_id, F.col(id_col).cast("long"))
    rows = keyed.dropDuplicates([own_id, own]).join(times, F.col(own_id).eqNullSafe(F.col(of_id)) & (F.col(own) == F.col(of)))
    return rows.withColumn(copy, F.explode(F.sequence(F.lit(1), copies))).select(*docs.columns)
