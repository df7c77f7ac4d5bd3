"""Exact top-k search by inner product over norm-sorted vectors.

Components x become floor(scale * x). Candidates are sorted by descending length and packed into
blocks; queries are packed into groups. Each (query group, slot of blocks) is one stream: the
longest vectors of the table come first to set the thresholds, then the slot's blocks, longest
first. A block whose length times the query's cannot reach the query's k-th score is skipped. The
rest are rotated by the singular vectors of the table, so that few leading coordinates hold most of
the product: the partial sum over those plus the Cauchy-Schwarz bound of the two residual lengths
decides which pairs are computed in full, in integers. Bounds keep ties. The slots' best lists are
merged by a ranked window; a query has at most k rows a slot there.

Vectors that are null or hold a null or non-finite component take no part, and neither do rows with
a null id; an empty vector scores 0, and of vectors of unequal lengths the shorter counts as padded
with zeros. Every row is its own candidate: repeated ids and repeated vectors rank as separate rows,
and only the query's own row is left out. Ties go to the smaller id. Scores beyond a long saturate.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewright.llm.common import arrow_schema, record_batch, saved

#: Rows a candidate block, rows a query group, blocks a slot.
BLOCK, GROUP, SLOT = 1024, 2048, 64
_TILE = 256


def exact_topk(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding",
               k: int = 20, scale: float = 64.0) -> DataFrame:
    """query_id, rank (from 1), id, score: the k best other rows of each row for which ``is_query`` holds."""
    spark = vectors.sparkSession
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = saved(
        vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull())
        .select(F.col(id_col).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("query"),
                F.transform(vector_col, lambda x: x.cast("double")).alias("v"))
        .where(F.forall("v", sound))
        .select("id", "query", F.monotonically_increasing_id().alias("uid"),
                F.transform("v", lambda x: F.floor(x * F.lit(scale)).cast("long")).alias("v"))
        .withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))),
        "vectors")
    facts = rows.agg(F.count("*"), F.count_if("query"), F.max(F.size("v")), F.max("norm2")).first()
    n, n_queries, width, most = facts[0], facts[1] or 0, max(1, facts[2] or 1), facts[3] or 0.0
    groups, blocks = max(1, -(-n_queries // GROUP)), max(1, -(-n // BLOCK))
    slots = max(1, -(-blocks // SLOT))
    exact = most < 2.0 ** 52
    rotation = spark.sparkContext.broadcast(_rotation(rows, width))

    def packed(ids, uids, vs) -> tuple[bytes, bytes, bytes]:
        matrix = np.zeros((len(ids), width), np.int64)
        for i, v in enumerate(vs):
            matrix[i, :len(v)] = v
        small = np.int16 if np.abs(matrix).max(initial=0) < 1 << 15 else np.int64
        return np.asarray(ids, np.int64).tobytes(), np.asarray(uids, np.int64).tobytes(), matrix.astype(small).tobytes()

    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come longest first."""
        schema = arrow_schema("norm double,n int,ids binary,uids binary,vectors binary")
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                ids, uids, matrix = packed(part.column("id").to_pylist(), part.column("uid").to_pylist(), part.column("v").to_pylist())
                yield record_batch(schema, norm=[part.column("norm2")[0].as_py() ** 0.5], n=[part.num_rows], ids=[ids], uids=[uids], vectors=[matrix])

    ordered = rows.repartitionByRange(max(1, -(-blocks // 8)), F.col("norm2").desc(), "uid").sortWithinPartitions(F.col("norm2").desc(), "uid")
    table = saved(ordered.select("id", "uid", "v", "norm2").mapInArrow(
        to_blocks, "norm double, n int, ids binary, uids binary, vectors binary"), "blocks")
    table = table.withColumn("kind", F.lit(2)).withColumn("slot", F.pmod(F.xxhash64("uids"), F.lit(slots)).cast("int"))
    best = table.select("norm", "n").orderBy(F.desc("norm")).limit(4 * (k + 1)).collect()
    floor, seen = float("inf"), 0
    for norm, count in best:
        if seen <= k:
            floor, seen = norm, seen + count
    everywhere = table.where(F.col("norm") >= floor).withColumn("kind", F.lit(1)).withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))

    def to_group(rows_: pa.Table) -> pa.Table:
        ids, uids, matrix = packed(rows_.column("id").to_pylist(), rows_.column("uid").to_pylist(), rows_.column("v").to_pylist())
        return pa.table({"grp": rows_.column("grp").slice(0, 1), "n": pa.array([len(rows_)], pa.int32()), "ids": pa.array([ids], pa.binary()),
                         "uids": pa.array([uids], pa.binary()), "vectors": pa.array([matrix], pa.binary())})

    queries = (
        rows.where("query").withColumn("grp", F.pmod(F.xxhash64("uid"), F.lit(groups)).cast("int")).groupBy("grp")
        .applyInArrow(to_group, "grp int, n int, ids binary, uids binary, vectors binary")
        .withColumn("kind", F.lit(0)).withColumn("norm", F.lit(0.0))
        .withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))))
    streams = queries.unionByName(
        table.unionByName(everywhere).withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            for row in batch.to_pylist():
                if state is None or (row["grp"], row["slot"]) != state.key:
                    if state is not None:
                        yield from state.result()
                    state = _Search((row["grp"], row["slot"]), k, rotation.value, exact)
                matrix = np.frombuffer(row["vectors"], np.int16 if len(row["vectors"]) == 2 * row["n"] * width else np.int64).reshape(row["n"], width)
                ids, uids = (np.frombuffer(row[c], np.int64) for c in ("ids", "uids"))
                if row["kind"] == 0:
                    state.start(ids, uids, matrix)
                else:
                    state.scan(ids, uids, matrix, threshold_only=row["kind"] == 1)
        if state is not None:
            yield from state.result()

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(groups * slots, 1 << 14))
    found = (streams.repartition(parts, "grp", "slot").sortWithinPartitions("grp", "slot", "kind", F.desc("norm"))
             .mapInArrow(search, "query_uid long, query_id long, id long, uid long, score long"))
    order = Window.partitionBy("query_uid").orderBy(F.desc("score"), "id", "uid")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))


def _rotation(rows: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of the table, from its Gram matrix; the driver gets width x width sums."""
    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                matrix = np.zeros((min(BLOCK, batch.num_rows - at), width))
                for i, v in enumerate(batch.column("v").slice(at, BLOCK).to_pylist()):
                    matrix[i, :len(v)] = v
                total += matrix.T @ matrix
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = np.sum(np.stack([x.values.to_numpy() for x in table.column("sums")]), axis=0)
        return pa.table({"i": table.column("i").slice(0, 1), "sums": pa.array([total], pa.list_(pa.float64()))})

    sums = rows.select("v").mapInArrow(gram, "i int, sums array<double>").groupBy("i").applyInArrow(add, "i int, sums array<double>").collect()
    matrix = np.eye(width)
    for i, line in sums:
        matrix[i] = line
    matrix = np.nan_to_num(matrix, posinf=0, neginf=0)
    _, basis = np.linalg.eigh((matrix + matrix.T) / 2)
    return basis[:, ::-1].copy()


class _Search:
    """Best lists of one query group while blocks stream by."""

    def __init__(self, key, k: int, rotation: np.ndarray, exact: bool):
        self.key, self.k, self.rotation, self.exact, self.ids = key, k, rotation, exact, None
        self.head = max(1, len(rotation) // 4)

    def _parts(self, matrix: np.ndarray):
        turned = matrix.astype(np.float64) @ self.rotation
        head, tail = turned[:, :self.head], turned[:, self.head:]
        return head, np.sqrt((tail ** 2).sum(axis=1)), np.sqrt((turned ** 2).sum(axis=1))

    def start(self, ids, uids, matrix) -> None:
        self.ids, self.uids, self.matrix = ids, uids, matrix.astype(np.float64)
        self.whole = matrix.astype(np.int64)
        self.heads, self.tails, self.norms = self._parts(matrix)
        self.threshold = np.full(len(ids), -np.inf)
        none = np.zeros(0, np.int64)
        self.best = [none] * 4  # query, id, uid, score

    def scan(self, ids, uids, matrix, threshold_only: bool) -> None:
        if self.ids is None:
            return
        heads, tails, norms = self._parts(matrix)
        found = [self.best]
        for at in range(0, len(ids), _TILE):
            tile = slice(at, at + _TILE)
            slack = 1e-6 + 1e-9 * self.norms * norms[tile].max(initial=0)
            alive = np.flatnonzero(self.norms * norms[tile].max(initial=0) + slack >= self.threshold)
            if not len(alive):
                continue
            bound = self.heads[alive] @ heads[tile].T + self.tails[alive, None] * tails[None, tile]
            q, c = np.nonzero(bound + slack[alive, None] >= self.threshold[alive, None])
            q, c = alive[q], c + at
            other = self.uids[q] != uids[c]
            q, c = q[other], c[other]
            score = self._scores(q, c, matrix, at)
            good = score >= self.threshold[q]
            found.append([q[good], ids[c[good]], uids[c[good]], score[good]])
            merged = self._top([np.concatenate(x) for x in zip(*found)])
            found = [merged]
            counts = np.bincount(merged[0], minlength=len(self.ids))
            full = np.flatnonzero(counts >= self.k)
            last = np.cumsum(counts)[full] - 1
            self.threshold[full] = np.maximum(self.threshold[full], merged[3][last])
        if not threshold_only:
            self.best = found[0]

    def _scores(self, q, c, matrix, at: int) -> np.ndarray:
        if not self.exact:
            limit = (1 << 63) - 1
            dots = (self.whole[q].astype(object) * matrix[c].astype(object)).sum(axis=1)
            return np.array([max(-limit - 1, min(limit, int(x))) for x in dots], np.int64)
        if len(q) * 4 > len(self.ids) * _TILE:
            return (self.matrix @ matrix[at:at + _TILE].astype(np.float64).T)[q, c - at].astype(np.int64)
        out = np.empty(len(q), np.int64)
        for low in range(0, len(q), 1 << 17):
            part = slice(low, low + (1 << 17))
            out[part] = np.einsum("ij,ij->i", self.matrix[q[part]], matrix[c[part]].astype(np.float64))
        return out

    def _top(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        query, ids, uids, score = rows
        order = np.lexsort((uids, ids, -score, query)) if self.exact else np.lexsort((uids, ids, ~score, query))
        query = query[order]
        starts = np.flatnonzero(np.diff(query, prepend=-1))
        rank = np.arange(len(query)) - np.repeat(starts, np.diff(np.append(starts, len(query))))
        order = order[rank < self.k]
        return [x[order] for x in rows]

    def result(self) -> Iterator[pa.RecordBatch]:
        if self.ids is not None and len(self.best[0]):
            query, ids, uids, score = self.best
            yield record_batch(arrow_schema("query_uid long,query_id long,id long,uid long,score long"),
                               query_uid=self.uids[query], query_id=self.ids[query], id=ids, uid=uids, score=score)
