"""N-gram Jaccard join by parity sketches, as components of linked documents.

A document is the set of its distinct word shingles. At ``percent`` 90 two linked sets of sizes a and b differ in at most
(a + b) / 19 shingles. XOR is a sketch of a set whose difference is the sketch of the symmetric difference: shingles are dealt to
blocks by hash, and the XOR of a block's 64-bit shingle hashes agrees between two sets wherever no differing
shingle fell. So with more blocks than differences some block agrees (pigeonhole), and equality of (size band,
block, XOR) finds every linked pair:

* sizes lie in bands; a set close above a band's border stands in that band too. A band has one number of blocks;
* blocks of one shingle or none are shared by chance, so there are spare blocks, and those poor blocks are indexed only
  for sets that have more of them than spares;
* small bands have half the blocks instead, each with its XOR and those without one of its shingles, so that a block
  with one difference still meets.

Sets that share a key are proposals. Each key ties its sets to the smallest one (no pairs within a key), and the components of
these ties are families. The sets of a family meet in tasks, in tiles of bounded size when the family is large; there
parity bits, whose Hamming distance is never above the symmetric difference, reject pairs by whole rows at a time, and
what is left is verified on the shingle hashes, unless the pair is connected already. Only verified links that join something leave
a task; their components are the result. Equal sets are one from the start. All steps are exact but for 64-bit hashes of
shingles and 128-bit keys of sets, taken to differ when their contents do.

A family of t tiles makes t copies of each of its sets and t**2 / 2 tasks; everything else grows in proportion.

Null text is empty; an empty set is linked with nothing and is its own component. Rows with one doc_id are one document: their sets
link through it. Rows without doc_id belong to the component of their set, which is null if no row of the set has one.
Repeated rows come out repeated. Further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewright.llm.common import arrow_schema, power_of_two, record_batch, saved, small_batches, utf8
from tidewright.llm.components import components
from tidewright.llm.simhash import shingle_hashes
from tidewright.llm.tokens import mix

SHINGLE, PERCENT = 3, 90
#: Ratio of a band's borders; most differences of a band that drops single shingles; shingles of a poor block.
BAND, FEW, POOR = 1.4, 7, 1
#: Shingles of a tile (8 bytes each), most parity bits of a set.
TILE, MOST_BITS = 1 << 20, 4096


@dataclass(frozen=True)
class Band:
    """Sets of ``low`` to ``high`` shingles, borders included; pairs of them differ in ``most`` shingles or fewer."""

    number: int
    most: int

    @property
    def dropping(self) -> bool:
        return self.most <= FEW

    @property
    def spare(self) -> int:
        return 0 if self.dropping else 3 + self.most // 16

    @property
    def blocks(self) -> int:
        return self.most // 2 + 1 if self.dropping else self.most + 1 + self.spare


def differences(sizes: int, percent: int) -> int:
    """Most shingles by which linked sets with ``sizes`` shingles together differ."""
    return sizes * (100 - percent) // (100 + percent)


def bands(n: int, percent: int) -> list[Band]:
    """The bands of a set of ``n`` shingles; none if it can be linked with equal sets only."""
    if differences(n + n * 100 // percent, percent) < 1:
        return []
    own = int(math.log(n) / math.log(BAND))
    found = []
    for number in (own, own - 1):
        above = math.ceil(BAND ** (number + 1))  # sizes from here on are of later bands
        high = (above - 1) * 100 // percent  # the largest set that links with one below the border
        if n <= max(high, above):
            found.append(Band(number, differences(2 * max(high, above), percent)))
    return found


def block_keys(codes: np.ndarray, percent: int) -> np.ndarray:
    """The keys under which a set of shingle hashes is found."""
    out = []
    for band in bands(len(codes), percent):
        salt = np.uint64(band.number * 0x9E3779B97F4A7C15 % (1 << 64))
        block = (mix(codes ^ salt) >> np.uint64(16)) % np.uint64(band.blocks)
        order = np.argsort(block, kind="stable")
        block, hashed = block[order], mix(codes[order] + salt)
        counts = np.bincount(block.astype(np.int64), minlength=band.blocks)
        sums = np.zeros(band.blocks, np.uint64)
        filled = np.flatnonzero(counts)
        sums[filled] = np.bitwise_xor.reduceat(hashed, (np.cumsum(counts) - counts)[filled])
        place = mix(np.arange(band.blocks, dtype=np.uint64) + salt)
        if band.dropping:
            out += [mix(sums ^ place), mix(sums[block] ^ hashed ^ place[block])]
        else:
            rich = counts > POOR
            if np.count_nonzero(~rich) > band.spare:
                rich[:] = True
            out.append(mix(sums[rich] ^ place[rich]))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def set_keys(codes: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    return tuple(int(mix(codes ^ np.uint64(s)).sum(dtype=np.uint64).astype(np.int64)) for s in (1, 2))


def _codes(text: bytes, shingle: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, shingle))


def linked(ids: list[int], sets: list[np.ndarray], tiles: list[int], percent: int) -> list[tuple[int, int]]:
    """Verified links that connect the sets; of two different tiles, if there are two."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    sets, tile = [sets[i] for i in order], np.array(tiles)[order]
    sizes = np.array([len(s) for s in sets], np.int64)
    bits = power_of_two(4 * differences(2 * int(sizes[-1]), percent), 64, MOST_BITS)
    sketches = np.empty((len(sets), bits // 64), np.uint64)
    for i, codes in enumerate(sets):
        odd = np.bincount((mix(codes) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
        sketches[i] = np.packbits(odd.astype(bool)).view(np.uint64)
    root, out, two = np.arange(len(sets)), [], len(set(tiles)) > 1
    ends = np.searchsorted(sizes, sizes * 100 // percent, side="right")
    for i in range(len(sets)):
        later = slice(i + 1, ends[i])
        apart = np.bitwise_count(sketches[later] ^ sketches[i]).sum(axis=1, dtype=np.int64)
        near = (apart * (100 + percent) <= (sizes[later] + sizes[i]) * (100 - percent)) & (root[later] != root[i])
        if two:
            near &= tile[later] != tile[i]
        for j in np.flatnonzero(near) + i + 1:
            if root[j] == root[i]:
                continue
            small, big = sets[i], sets[j]
            at = np.minimum(np.searchsorted(big, small), len(big) - 1)
            both = int(np.count_nonzero(big[at] == small))
            if 100 * both >= percent * (len(small) + len(big) - both):
                out.append((ids[order[i]], ids[order[j]]))
                root[root == root[j]] = root[i]
    return out


def parity_join(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, id_col: str = "doc_id",
                text_col: str = "text", tile: int = TILE) -> DataFrame:
    """One row per document: id, n_shingles, component_id (the smallest id reachable by links)."""
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [_codes(t, shingle) for t in batch.column("text").to_pylist()]
            keys = list(zip(*map(set_keys, sets))) or [[], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(list(map(len, sets)), pa.int64()), pa.array(keys[0], pa.int64()), pa.array(keys[1], pa.int64()),
                 pa.array([block_keys(s, percent).view(np.int64) for s in sets], pa.list_(pa.int64()))],
                names=["id", "n", "k", "l", "blocks"])

    texts = small_batches(docs).select(F.col(id_col).cast("long").alias("id"), utf8(text_col).alias("text"))
    rows = saved(texts.mapInArrow(index, "id long, n long, k long, l long, blocks array<long>"), "sketches")
    same = ["n", "k", "l"]
    classes = saved(rows.groupBy(*same).agg(F.min("id").alias("first")), "classes")
    firsts = classes.where((F.col("n") > 0) & F.col("first").isNotNull())

    # Families only decide who meets, so the first half of the key may stand for a set here; equal sets fold before the shuffle.
    entries = rows.select("k", F.explode("blocks").alias("block"))
    heads = saved(entries.groupBy("block").agg(F.min("k").alias("head"), F.max("k").alias("last")).where("head < last").select("block", "head"),
                  "heads")
    # Both joins may be large on either side; one plan for every size, which AQE splits at hot keys.
    ties = entries.join(heads.hint("merge"), "block").select(F.col("head").alias("a"), F.col("k").alias("b"))
    families = components(ties).withColumnsRenamed({"node": "k", "root": "family"})

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "family", "tiles", "codes"]
        for batch in batches:
            found = [_codes(t, shingle) for t in batch.column("text").to_pylist()]
            # Rows that share the id with other words belong to other sets.
            same_set = pa.array([set_keys(f) == tuple(key) for f, *key in zip(found, *[batch.column(c).to_pylist() for c in "kl"])], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names[:3]], pa.array([f.view(np.int64) for f in found], pa.list_(pa.int64()))],
                names=names).filter(same_set)

    members = saved(families.join(firsts, "k").select(F.col("first").alias("id"), "n", "k", "l", "family"), "families")
    shares = members.groupBy("family").agg(F.ceil(F.sum("n") / tile).alias("tiles"))
    members = saved(members.join(shares, "family").drop("n"), "members")
    bodies = texts.join(members.hint("merge"), "id").mapInArrow(sets, "id long, family long, tiles long, codes array<long>")
    mine, other = F.pmod(F.xxhash64("id"), "tiles"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    met = (bodies.select("id", "family", "codes", mine.alias("mine"), other.alias("other"))
           .select("id", "family", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "mine", "codes"))

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, current, held = arrow_schema("a long,b long"), None, []

        def flush():
            found = linked([h[0] for h in held], [h[2] for h in held], [h[1] for h in held], percent) if len(held) > 1 else []
            return record_batch(schema, a=[a for a, _ in found], b=[b for _, b in found])

        for batch in batches:
            codes = batch.column("codes")
            flat, ends = codes.flatten().to_numpy().view(np.uint64), np.concatenate([[0], np.cumsum(codes.value_lengths().to_numpy())])
            for i, at in enumerate(zip(*[batch.column(c).to_pylist() for c in ("family", "low", "high")])):
                if at != current:
                    if held:
                        yield flush()
                    current, held = at, []
                held.append((batch.column("id")[i].as_py(), batch.column("mine")[i].as_py(), flat[ends[i]:ends[i + 1]].copy()))
        if held:
            yield flush()

    edges = (met.repartition("family", "low", "high").sortWithinPartitions("family", "low", "high", "id")
             .mapInArrow(links, "a long, b long"))
    found = components(edges)
    roots = firsts.select(*same, F.col("first").alias("node")).join(found, "node", "left").select(*same, F.coalesce("root", "node").alias("root"))
    out = rows.select("id", *same).join(roots, same, "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("root")).alias("component_id"))
