"""SimHash near-dedup with a hierarchical index over Gray-ordered fingerprints.

Distinct fingerprints are sorted by Gray rank and cut into shards. In a shard every run of
neighbouring fingerprints becomes a node that holds the bits all of them share; groups of nodes
become upper nodes the same way, up to a root. A search goes down from the root adding up the
differences on the bits that each node newly fixes, and drops a whole group once the sum passes
the radius. The shards' own shared bits form the top of the same tree: they decide which shards
a fingerprint visits. Nothing is capped, so the links are exact.

A shard reports a link only where it connects two sets of its local union-find, so a dense group
costs its size and not its square; components are then found over those links.

``near_duplicates`` is the form for a similarity threshold: fingerprints of ``SHINGLE`` words within
the radius propose pairs, and so do equal fingerprints over small samples of a text's shingles (the
``DRAWN`` least ones under each of ``VIEWS`` hashes), because two texts at the threshold differ in
more bits than any radius can search; at a similarity of 0.8 a sample agrees with odds 0.6. Texts that
agree in a sample are paired with one head of it, and every proposed pair is checked on its whole shingle sets.
The first samples connect most of a group, so of the others only texts that are still apart are paired; at last these
are dealt again by further samples where some texts have found partners. Proposals alone miss pairs, and the links of the radius
search are a forest whose tree edges may fail the check, so an exact pass follows: ``prefix_pairs`` meets every
pair at the threshold whose texts are not in one group yet.

Texts: A-Z are lower-cased, words are runs of ``[^\\x20\\x09-\\x0D]``, shingles of ``shingle``
words joined by one space, repeats included; a shorter text is one shingle; no word (null, empty)
gives fingerprint zero, which links like any other. Shingles are hashed with XXH64, seed 42; a bit
is set when it is set in over half of the hashes. Equal rows stay separate rows of the result;
the component of rows that only have null ids is null. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidewright.llm.common import arrow_schema, given_back, power_of_two, record_batch, saved, small_batches, utf8
from tidewright.llm.components import components
from tidewright.llm.tokens import mix

SEED = 42
#: Fingerprints a shard should hold; the number of shards is bounded, as every task carries their masks (24 bytes each).
SHARD, MOST_SHARDS = 65536, 8192
FANOUT = 8
#: The similarity form: words a shingle, sampled fingerprints, shingles in each.
SHINGLE, VIEWS, DRAWN = 5, 16, 2
#: Samples whose texts meet a head before groups are known; how often a bucket of several texts is dealt again after that.
FIRST, DEPTH = 2, 6
#: (fingerprint, node) pairs expanded at once.
FRONTIER = 1 << 20
#: The exact pass: one text of so many is counted to order shingles, most shingles with a count, pairs compared at once.
COUNTED, MOST_COMMON, COMPARED = 16, 1 << 18, 1 << 17
#: Most parity bits of a set.
MOST_PARITY = 1 << 16


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """XXH64 of every shingle in order; none for a text without words."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    hashed, seed = xxhash.xxh64_intdigest, SEED
    if len(words) <= shingle:
        return np.array([hashed(line, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    return np.array([hashed(line[s:e], seed) for s, e in zip(starts, ends[shingle - 1:].tolist())], np.uint64)


def majority(codes: np.ndarray) -> int:
    """The bits set in over half of the codes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(codes), 1 << 16):
        bits = np.unpackbits(codes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(codes), bitorder="little").view(np.uint64)[0])


def fingerprint(text: bytes, shingle: int) -> int:
    return majority(shingle_hashes(text, shingle))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the Gray sequence, where neighbours differ in one bit."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class HammingTree:
    """Nodes over a sequence of leaves, each leaf given by the bits its members share."""

    def __init__(self, both: np.ndarray, either: np.ndarray):
        """``both``: AND of a leaf's fingerprints; ``either``: their OR."""
        levels = [(both, either)]
        while len(levels[-1][0]) > FANOUT:
            low, high = levels[-1]
            cuts = np.arange(0, len(low), FANOUT)
            levels.append((np.bitwise_and.reduceat(low, cuts), np.bitwise_or.reduceat(high, cuts)))
        self.levels = [(low, ~(low ^ high)) for low, high in reversed(levels)]
        # Bits that a node fixes beyond its parent.
        self.fresh = [self.levels[0][1]] + [
            mask & ~upper[1][np.arange(len(mask)) // FANOUT]
            for upper, (_, mask) in zip(self.levels, self.levels[1:])]

    def search(self, codes: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(index of code, leaf) pairs whose shared bits differ in ``radius`` places at most."""
        top = len(self.levels[0][0])
        step = max(1, FRONTIER // (8 * FANOUT * FANOUT))
        for at in range(0, len(codes), step):
            part = codes[at:at + step]
            who = np.repeat(np.arange(len(part)), top)
            node = np.tile(np.arange(top), len(part))
            spent = np.zeros(len(who), np.uint8)
            for depth, (value, _) in enumerate(self.levels):
                if depth:
                    who, spent = np.repeat(who, FANOUT), np.repeat(spent, FANOUT)
                    node = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                    inside = node < len(value)
                    who, node, spent = who[inside], node[inside], spent[inside]
                spent = spent + np.bitwise_count((part[who] ^ value[node]) & self.fresh[depth][node])
                near = spent <= radius
                who, node, spent = who[near], node[near], spent[near]
            yield who + at, node


class _Union:
    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return int(x)

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Which of the pairs connected two sets."""
        new = np.zeros(len(left), bool)
        for i, (a, b) in enumerate(zip(left.tolist(), right.tolist())):
            a, b = self.find(a), self.find(b)
            if a != b:
                self.parent[max(a, b)] = min(a, b)
                new[i] = True
        return new


def links(prints: DataFrame, radius: int, shard: int = SHARD) -> DataFrame:
    """Links (a, b) within ``radius`` that connect the distinct fingerprints of ``prints`` (fp long) as all such links would."""
    spark = prints.sparkSession
    parts = int(min(MOST_SHARDS, max(1, -(-prints.count() // (shard // 4 + 1)))))

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column("fp").to_numpy()
            # Flipping the top bit makes Spark's signed order the unsigned order of the rank.
            rank = gray_rank(codes.view(np.uint64)) ^ np.uint64(1 << 63)
            yield pa.RecordBatch.from_arrays([batch.column("fp"), pa.array(rank.view(np.int64))], names=["fp", "rank"])

    ordered = prints.select("fp").mapInArrow(ranked, "fp long, rank long")
    placed = saved(ordered.repartitionByRange(parts, "rank").withColumn("part", F.spark_partition_id()).select("part", "fp"), "ranges")
    # Neighbouring ranges join into shards of about ``shard`` fingerprints; the driver gets one row a range.
    ranges = sorted(placed.groupBy("part").agg(F.count("*"), F.expr("bit_and(fp)"), F.expr("bit_or(fp)")).collect())
    shard_of, masks, room = {}, [], 0
    for part, n, both, either in ranges:
        if n > room:
            masks.append([both, either])
            room = shard
        shard_of[part], room = len(masks) - 1, room - n
        masks[-1] = [masks[-1][0] & both, masks[-1][1] | either]
    n_shards = max(1, len(masks))
    low, high = (np.array([m[i] for m in masks], np.int64).view(np.uint64) for i in (0, 1))
    home_of = np.zeros(max(shard_of, default=0) + 1, np.int32)
    home_of[list(shard_of)] = list(shard_of.values())

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Residents (kind 0) to their shard; visitors (kind 1) to every later shard within reach."""
        schema, tree = arrow_schema("shard int,kind int,fp long"), HammingTree(low, high)
        for batch in batches:
            codes, home = batch.column("fp").to_numpy(), home_of[batch.column("part").to_numpy()]
            yield record_batch(schema, shard=home, kind=np.zeros(len(home), np.int32), fp=codes)
            for who, leaf in tree.search(codes.view(np.uint64), radius):
                later = leaf > home[who]
                who, leaf = who[later], leaf[later]
                yield record_batch(schema, shard=leaf.astype(np.int32), kind=np.ones(len(who), np.int32), fp=codes[who])

    @given_back
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by shard and kind: load a shard's residents, then stream its visitors past them."""
        schema, state = arrow_schema("a long,b long"), None

        def edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            return record_batch(schema, a=a.view(np.int64), b=b.view(np.int64))

        def index():
            codes = np.concatenate(state["residents"])
            codes = codes[np.argsort(gray_rank(codes), kind="stable")]
            tree, union = HammingTree(codes, codes), _Union(len(codes))
            state["index"] = (codes, tree, union)
            for who, leaf in tree.search(codes, radius):
                later = leaf > who
                who, leaf = who[later], leaf[later]
                new = union.join(who, leaf)
                yield edges(codes[who[new]], codes[leaf[new]])

        def visit(visitors: np.ndarray):
            codes, tree, union = state["index"]
            for who, leaf in tree.search(visitors, radius):
                order = np.argsort(who, kind="stable")
                who, leaf = who[order], leaf[order]
                # The visitor's first match, and each further one that it connects to the first.
                first = np.diff(who, prepend=-1) != 0
                new = first | union.join(leaf[np.maximum.accumulate(np.where(first, np.arange(len(who)), 0))], leaf)
                yield edges(visitors[who[new]], codes[leaf[new]])

        for batch in batches:
            shards, kinds = batch.column("shard").to_numpy(), batch.column("kind").to_numpy()
            codes = batch.column("fp").to_numpy().view(np.uint64)
            cuts = np.flatnonzero((np.diff(shards, prepend=-1) != 0) | (np.diff(kinds, prepend=-1) != 0))
            for start, stop in zip(cuts, [*cuts[1:], len(shards)]):
                if state is None or state["shard"] != shards[start]:
                    if state is not None and "index" not in state:
                        yield from index()
                    state = {"shard": shards[start], "residents": []}
                if kinds[start] == 0:
                    state["residents"].append(codes[start:stop])
                else:
                    if "index" not in state:
                        yield from index()
                    yield from visit(codes[start:stop])
        if state is not None and "index" not in state:
            yield from index()

    routed = placed.mapInArrow(route, "shard int, kind int, fp long")
    return (routed.repartition(max(n_shards, int(spark.conf.get("spark.sql.shuffle.partitions"))), "shard")
            .sortWithinPartitions("shard", "kind").mapInArrow(match, "a long, b long"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp) a document, written once."""
    @given_back
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("id long,fp long")
        for batch in batches:
            codes = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], np.uint64)
            yield record_batch(schema, id=batch.column("id"), fp=codes.view(np.int64))

    texts = small_batches(docs).select(F.col(id_col).cast("long").alias("id"), utf8(text_col).alias("text"))
    return saved(texts.mapInArrow(scan, "id long, fp long"), "simhash")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 3, radius: int = 2, shard: int = SHARD) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id (smallest id reachable)."""
    rows = fingerprints(docs, id_col, text_col, shingle)
    least = saved(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    found = components(links(least.select("fp"), radius, shard))
    rooted = least.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.join(named, "root").select("fp", "component_id")
    return rows.join(labels, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _proposals(buckets: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(left, right) pairs to check, from ``buckets`` (key, root, views, view, code); ``root`` names the group of a key known so far.

    Each bucket pairs its members with a head, but for those of the head's group. Where members have found
    partners already, the others may have some there too and not at the head: they are paired with a
    second head and, if there are more than three, dealt again by one more view, up to ``depth`` times.
    """
    found, order, member = [], F.xxhash64("key", "view", "code"), F.struct("key", "root")
    for step in range(1, depth + 1):
        heads = buckets.groupBy("view", "code").agg(
            F.min_by(member, order).alias("head"), F.max_by(member, order).alias("other"), F.count("*").alias("n"),
            F.count_if(F.col("root") != F.col("key")).alias("grouped"), F.min("root").alias("low"), F.max("root").alias("high")
        ).where("low < high").drop("low", "high")
        met = saved(buckets.join(heads, ["view", "code"]), "met")
        found += [met.where(where).where(F.col("root") != F.col(f"{head}.root")).select(F.col(f"{head}.key").alias("left"), F.col("key").alias("right"))
                  for head, where in (("head", "true"), ("other", "grouped > 0"))]
        following = F.get("views", F.pmod(F.col("view") + step, F.lit(VIEWS)))
        buckets = met.where("n > 3 and grouped > 0").select("key", "root", "views", "view", F.xxhash64("code", following).alias("code"))
        if buckets.isEmpty():
            break
    return reduce(DataFrame.union, found).select(F.least("left", "right").alias("left"), F.greatest("left", "right").alias("right")).distinct()


def _distinct_shingles(text: bytes) -> np.ndarray:
    return np.unique(shingle_hashes(text, SHINGLE))


def parity_bits(codes: np.ndarray) -> bytes:
    """Parities of the shingles dealt to a power of two of bits; in these two sets differ no more than in shingles."""
    bits = power_of_two(len(codes) // 2, 64, MOST_PARITY)
    odd = np.bincount((mix(codes) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def parity_distance(a: bytes, b: bytes) -> int:
    """Differing bits, after folding the longer one to the length of the other."""
    short = min(len(a), len(b))
    x, y = (reduce(int.__xor__, (int.from_bytes(c[at:at + short]) for at in range(0, len(c), short))) for c in (a, b))
    return (x ^ y).bit_count()


def _common_shingles(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Common shingles, ascending, and their counts in a part of ``texts``. They only order shingles: links are the same by any order."""
    @given_back
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_distinct_shingles(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64))], names=["code"])

    part = texts.where(F.pmod(F.xxhash64("text"), F.lit(COUNTED)) == 0).select("text")
    counts = saved(part.mapInArrow(scan, "code long").groupBy("code").agg(F.count("*").alias("n")).where("n > 1"), "common")
    least, room = None, MOST_COMMON
    for n, shingles in sorted(counts.groupBy("n").agg(F.count("*")).collect(), reverse=True):
        room -= shingles
        if room < 0:
            break
        least = n
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    chosen = counts.where(F.col("n") >= least).toArrow()
    codes = chosen.column("code").to_numpy().view(np.uint64)
    order = np.argsort(codes)
    return codes[order], chosen.column("n").to_numpy()[order]


def prefix_pairs(texts: DataFrame, roots: DataFrame, similarity: Fraction) -> DataFrame:
    """(left, right) keys of all pairs of texts with ``similarity`` or more and two roots, among others that may have it.

    ``roots`` (node, root) names the group of a key; a key without one is alone. Shingles have one order, rare ones
    first. Of two sets of n and m shingles at similarity t the first common one is among the first n - ceil(t n) + 1 of
    either, and what is left from there on in both is t / (1 + t) of n + m or more. Nothing is capped.
    """
    top, bottom = similarity.numerator, similarity.denominator
    common, counts = _common_shingles(texts)

    @given_back
    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, sizes, heads = batch.column("text").to_pylist(), [], []
            for text in bodies:
                codes = _distinct_shingles(text)
                n = len(codes)
                if len(common):
                    at = np.minimum(np.searchsorted(common, codes), len(common) - 1)
                    codes = codes[np.argsort(np.where(common[at] == codes, counts[at], 0), kind="stable")]
                sizes.append(n)
                heads.append(codes[:n + top * -n // bottom + 1].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(map(word_key, bodies)), pa.int64()), pa.array(sizes, pa.int64()), pa.array(heads, pa.list_(pa.int64()))],
                names=["key", "n", "codes"])

    def compared(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Pairs of two roots among the rows of each code; rows are sorted by code and root."""
        code, root, key, place = rows
        room, n = place >> 32, place & 0xFFFFFFFF
        new = np.diff(code, prepend=code[0]) != 0
        runs = np.concatenate([[0], np.flatnonzero(new), [len(code)]])
        groups = np.concatenate([[0], np.flatnonzero(new | (np.diff(root, prepend=root[0]) != 0)), [len(code)]])
        stop, group_stop = np.repeat(runs[1:], np.diff(runs)), np.repeat(groups[1:], np.diff(groups))
        who = np.flatnonzero(stop > group_stop)
        many = (stop - group_stop)[who]
        cuts = np.flatnonzero(np.diff(np.cumsum(many) // COMPARED)) + 1
        for some, size in zip(np.split(who, cuts), np.split(many, cuts)):
            left = np.repeat(some, size)
            right = np.arange(len(left)) + np.repeat(group_stop[some] - (np.cumsum(size) - size), size)
            near = np.minimum(room[left], room[right]) * (top + bottom) >= top * (n[left] + n[right])
            left, right = key[left[near]], key[right[near]]
            pairs = np.unique(np.stack([np.minimum(left, right), np.maximum(left, right)]), axis=1)
            yield pa.RecordBatch.from_arrays(list(map(pa.array, pairs)), names=["left", "right"])

    @given_back
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(c).to_numpy() for c in ("code", "root", "key", "place")])
            last = int(np.searchsorted(rows[0], rows[0, -1]))
            if held and (last or held[-1][0, -1] != rows[0, -1]):
                yield from compared(np.concatenate([*held, rows[:, :last]], axis=1))
                held = []
            elif last:
                yield from compared(rows[:, :last])
            held.append(rows[:, last:])
        if held:
            yield from compared(np.concatenate(held, axis=1))

    heads = (texts.select("text").mapInArrow(prefixes, "key long, n long, codes array<long>")
             .groupBy("key").agg(F.first("n").alias("n"), F.first("codes").alias("codes")))
    rooted = heads.join(roots.withColumnRenamed("node", "key").hint("merge"), "key", "left")
    entries = (rooted.select("key", F.coalesce("root", "key").alias("root"), "n", F.posexplode("codes").alias("at", "code"))
               .select("code", "root", "key", (F.shiftleft(F.col("n") - F.col("at"), 32) + F.col("n")).alias("place")))
    return entries.repartition("code").sortWithinPartitions("code", "root").mapInArrow(match, "left long, right long").distinct()


def _alike(pairs: DataFrame, marks: DataFrame, similarity: Fraction) -> DataFrame:
    """The (left, right) pairs whose parity bits (``marks``: key, n, parity) do not rule out ``similarity``."""
    top, bottom = similarity.numerator, similarity.denominator

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("n", "m", "a", "b")]
            alike = [parity_distance(a, b) * (bottom + top) <= (n + m) * (bottom - top) for n, m, a, b in zip(*columns)]
            yield batch.select(["left", "right"]).filter(pa.array(alike, pa.bool_()))

    return (pairs.join(marks.withColumnsRenamed({"key": "left", "parity": "a"}), "left")
            .join(marks.withColumnsRenamed({"key": "right", "n": "m", "parity": "b"}), "right")
            .mapInArrow(check, "left long, right long"))


def near_duplicates(docs: DataFrame, similarity: float = 0.8, text_col: str = "text", id_col: str = "doc_id",
                    radius: int = 2, shard: int = SHARD) -> DataFrame:
    """(key, id, component) of every row that is in a group with other texts or other rows; ``key`` is :func:`word_key` of the text.

    Texts with equal lower-cased words have one key. Groups are the components of all pairs whose
    shingle sets have a Jaccard similarity of ``similarity`` or more.
    """
    share = Fraction(str(similarity))

    @given_back
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = mix(np.arange(1, VIEWS + 1, dtype=np.uint64))
        for batch in batches:
            keys, prints, views, sizes, parities = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                codes = shingle_hashes(text, SHINGLE)
                keys.append(word_key(text))
                prints.append(majority(codes))
                found, distinct = [], np.unique(codes)
                sizes.append(len(distinct))
                parities.append(parity_bits(distinct))
                for seed in seeds:
                    ranked = mix(distinct ^ seed)
                    if len(ranked) > DRAWN:
                        ranked = np.partition(ranked, DRAWN - 1)[:DRAWN]
                    found.append(int(mix(ranked).sum(dtype=np.uint64)))
                views.append(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(keys, pa.int64()), pa.array(np.array(prints, np.uint64).view(np.int64)),
                 pa.array(views, pa.list_(pa.int64())), pa.array(sizes, pa.int64()), pa.array(parities, pa.binary())],
                names=["id", "key", "fp", "views", "n", "parity"])

    texts = small_batches(docs).select(F.col(id_col).cast("long").alias("id"), utf8(text_col).alias("text"))
    rows = saved(texts.mapInArrow(scan, "id long, key long, fp long, views array<long>, n long, parity binary"), "views")
    nodes = rows.groupBy("key").agg(F.first("fp").alias("fp"), F.first("views").alias("views"))
    least = saved(nodes.groupBy("fp").agg(F.min("key").alias("least")), "distinct")
    linked = links(least.select("fp"), radius, shard)
    near = (linked.join(least.select(F.col("fp").alias("a"), F.col("least").alias("left")), "a")
            .join(least.select(F.col("fp").alias("b"), F.col("least").alias("right")), "b").select("left", "right"))
    dealt = (nodes.select("key", "views", F.posexplode("views").alias("view", "code"))
             .union(nodes.select("key", "views", F.lit(-1), "fp")))
    several = dealt.groupBy("view", "code").agg(F.count("*").alias("n")).where("n > 1")
    buckets = saved(dealt.join(several, ["view", "code"], "left_semi"), "buckets")
    first = _proposals(buckets.where(F.col("view") < FIRST).withColumn("root", F.col("key")), 1)
    pairs = saved(first.union(near.select(F.least("left", "right"), F.greatest("left", "right"))).distinct(), "candidates")

    @given_back
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column("text").to_pylist()
            found = [_distinct_shingles(t).view(np.int64) for t in bodies]
            yield pa.RecordBatch.from_arrays([pa.array(list(map(word_key, bodies)), pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["key", "codes"])

    def members(of: DataFrame) -> DataFrame:
        return of.select(F.col("left").alias("key")).union(of.select("right")).distinct()

    def shingles_of(keys: DataFrame) -> DataFrame:
        # A key's rows have the same shingles: one of them stands for all.
        # Written first, so that a few ids spare the texts a shuffle.
        chosen = saved(rows.join(keys, "key").groupBy("key").agg(F.min("id").alias("id")), "chosen")
        bodies = texts.join(chosen.select(F.col("id").alias("of")), F.col("id").eqNullSafe(F.col("of")), "left_semi")
        return saved(bodies.select("text").mapInArrow(sets, "key long, codes array<long>").join(keys, "key", "left_semi")
                     .dropDuplicates(["key"]), "shingles")

    def verified(of: DataFrame, shingles: DataFrame) -> DataFrame:
        """(a, b) of the pairs that have the similarity, compared in whole numbers."""
        both, either = F.col("both").cast("long"), F.size("a") + F.size("b") - F.col("both")
        return (of.join(shingles.withColumnsRenamed({"key": "left", "codes": "a"}), "left")
                .join(shingles.withColumnsRenamed({"key": "right", "codes": "b"}), "right")
                .withColumn("both", F.size(F.array_intersect("a", "b")))
                .where((both * share.denominator >= either * F.lit(share.numerator).cast("long")) | ((F.size("a") == 0) & (F.size("b") == 0)))
                .select(F.col("left").alias("a"), F.col("right").alias("b")))

    shingles = shingles_of(members(pairs).union(buckets.select("key")).distinct())
    found = components(verified(pairs, shingles))
    for depth in (1, DEPTH):
        grouped = buckets.join(found.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
        apart = saved(_proposals(grouped, depth).join(pairs, ["left", "right"], "left_anti"), "candidates")
        found = components(verified(apart, shingles).union(found))
        pairs = pairs.union(apart)
    met = saved(prefix_pairs(texts, found, share).join(pairs, ["left", "right"], "left_anti"), "met_by_prefix")
    marks = saved(rows.select("key", "n", "parity").join(members(met), "key", "left_semi").dropDuplicates(["key"]), "marks")
    rest = saved(_alike(met, marks, share), "rest")
    if not rest.isEmpty():
        more = saved(members(rest).join(shingles.select("key"), "key", "left_anti"), "more")
        held = shingles.join(members(rest), "key", "left_semi")
        joined = saved(verified(rest, held.union(shingles_of(more))), "joined")
        if not joined.isEmpty():
            found = components(joined.union(found.select("node", "root")))
    grouped = rows.select("id", "key").join(found.select(F.col("node").alias("key"), F.col("root").alias("component")), "key", "left")
    grouped = grouped.withColumn("component", F.coalesce("component", "key"))
    many = grouped.groupBy("component").agg(F.count("*").alias("n")).where("n > 1").select("component")
    return grouped.join(many, "component").select("key", "id", "component")


def word_key(text: bytes) -> int:
    """63-bit hash of the lower-cased words."""
    return xxhash.xxh3_64_intdigest(b" ".join(text.lower().split())) >> 1
