"""Prefix trie of rebuilt conversations, from whole sequences.

Every conversation is rebuilt: it opens with the first turns of its family's first member. Identical
rebuilt conversations collapse into one weighted sequence with the list of those that end there; from then on
only distinct sequences are walked. A sequence that is a proper prefix of another one goes by an anti-join, which
leaves the leaves. Weighted prefixes are then aggregated: a node is (depth, key), where the key of a prefix is the
XOR of two 64-bit hashes of (position, role, text) over its turns, so it is a running value in a window, and the key of
the parent is the same without the last turn. Keys have 128 bits from SHA-256; different prefixes are taken to differ.

Subtree sums need no walk down the tree. A node belongs to the sequence with its smallest member, and the nodes of a
sequence are a tail of its path, so the words of distinct nodes below a node are, summed over the sequences through it,
min(words from here on, words of the sequence's own nodes).

A conversation may be of any length: turns are numbered in range partitions and walked in chunks of ``CHUNK``, with a
carry of one row a chunk. The digest of a list of ends has to read it in order, so it is taken from a sorted stream of
packed pieces with constant memory.

Null role or text is empty; rows without conv_id belong to no conversation. Turns that tie are ordered by their content keys, so
reruns agree; repeated rows are turns of their own. A conversation may end up without turns and then ends at the root. An
empty table has no nodes. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewright.llm.common import arrow_schema, record_batch, saved
from tidewright.llm.turns import content_keys, numbered

#: Turns of a chunk; ids of a packed piece of ends; conversations of a family; bound of the shared opening (exclusive).
CHUNK, PIECE, FAMILY, OPENING = 4096, 4096, 20, 4
NODE = ["depth", "x", "y"]


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id) of all conversations, and their rebuilt turns (conv_id, position, a, b, words)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", *content_keys(role, text), words(text).alias("words"))
    local, starts = numbered(rows, "conv_id", ["turn", "a", "b"], "turns")
    starts = saved(starts, "starts")
    first = starts.where(F.col("before") < OPENING - 1)
    heads = (local.where(F.col("local") < OPENING).join(first, ["conv_id", "part"])
             .select(F.col("conv_id").alias("of"), (F.col("before") + F.col("local")).alias("position"), "a", "b", "words")
             .where(F.col("position") < OPENING))
    ids = starts.groupBy("conv_id").agg(F.max("total").alias("total")).select(
        "conv_id", "total", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("of"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % OPENING).alias("opening"))
    sizes = ids.select(F.col("conv_id").alias("of"), F.col("total").alias("has"))
    ids = saved(ids.join(sizes, "of", "left").withColumn("has", F.least("opening", F.coalesce("has", F.lit(0)))), "conversations")
    opened = (ids.where("has > 0").join(heads, "of").where("position <= opening")
              .select("conv_id", "position", "a", "b", "words"))
    shift = starts.join(ids.select("conv_id", "opening", "has"), "conv_id")
    own = (local.join(shift, ["conv_id", "part"]).withColumn("position", F.col("before") + F.col("local"))
           .where("position > opening")
           .select("conv_id", (F.col("position") - F.col("opening") + F.col("has")).alias("position"), "a", "b", "words"))
    return ids.select("conv_id"), opened.union(own)


def digests(pieces: DataFrame, key: list[str]) -> DataFrame:
    """(key, sha) of the comma-joined ``piece`` strings of each key in the order of ``bucket``; one piece in memory at a time."""
    ddl = ",".join(f"{c} long" for c in key) + ",sha string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, current, state, done = arrow_schema(ddl), None, None, []

        def flush():
            columns = list(zip(*done)) or [[]] * len(schema)
            done.clear()
            return record_batch(schema, **dict(zip(schema.names, map(list, columns))))

        for batch in batches:
            for *at, piece in zip(*[batch.column(c).to_pylist() for c in key], batch.column("piece")):
                if at != current:
                    if current is not None:
                        done.append([*current, state.hexdigest()])
                    current, state = at, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(piece.as_py().encode())
            yield flush()
        if current is not None:
            done.append([*current, state.hexdigest()])
            yield flush()

    return (pieces.repartition(*key).sortWithinPartitions(*key, "bucket").select(*key, "piece")
            .mapInArrow(run, ddl.replace(",", ", ")))


def sequences(ids: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct sequences (m, depth, x, y, weight, total) with the digest of their ends, and the chunk carries of all turns."""
    chunks = saved(turns.groupBy("conv_id", "chunk").agg(
        F.count("*").alias("n"), F.bit_xor("sa").alias("x"), F.bit_xor("sb").alias("y"), F.sum("words").alias("words")), "chunks")
    zero = F.lit(0).cast("long")
    whole = ids.join(chunks.groupBy("conv_id").agg(F.sum("n").alias("depth"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"),
                                                   F.sum("words").alias("total")), "conv_id", "left")
    whole = saved(whole.select("conv_id", *[F.coalesce(c, zero).alias(c) for c in (*NODE, "total")]), "whole")
    distinct = whole.groupBy(*NODE).agg(F.min("conv_id").alias("m"), F.count("*").alias("weight"), F.max("total").alias("total"))
    pieces = (whole.groupBy(*NODE, F.floor(F.col("conv_id") / PIECE).alias("bucket"))
              .agg(F.array_join(F.array_sort(F.collect_list("conv_id")), ",").alias("piece")))
    return saved(distinct.join(digests(pieces, NODE).withColumnRenamed("sha", "ends"), NODE, "left"), "sequences"), chunks


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    ids, turns = rebuilt(conversations)
    turns = saved(turns.select(
        "conv_id", "position", F.floor((F.col("position") - 1) / CHUNK).alias("chunk"), "words",
        F.xxhash64("position", "a", "b").alias("sa"), F.xxhash64(F.lit("b"), "position", "b", "a").alias("sb")), "rebuilt")
    found, chunks = sequences(ids, turns)

    # Every prefix of every distinct sequence, with the words from its last turn on.
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = (chunks.join(found.select(F.col("m").alias("conv_id")), "conv_id")
               .select("conv_id", "chunk", *[F.coalesce(f(c).over(earlier), F.lit(0)).alias(f"before_{c}") for f, c in
                                             ((F.bit_xor, "x"), (F.bit_xor, "y"), (F.sum, "words"))])
               .join(found.select(F.col("m").alias("conv_id"), "weight", "total"), "conv_id"))
    running = Window.partitionBy("conv_id", "chunk").orderBy("position").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    walked = (turns.join(carried, ["conv_id", "chunk"])
              .withColumn("x", F.bit_xor("sa").over(running).bitwiseXOR(F.col("before_x")))
              .withColumn("y", F.bit_xor("sb").over(running).bitwiseXOR(F.col("before_y")))
              .withColumn("read", F.sum("words").over(running) + F.col("before_words")))
    zero = F.lit(0).cast("long")
    steps = walked.select(
        F.col("conv_id").alias("m"), F.col("position").alias("depth"), "x", "y", F.col("x").bitwiseXOR(F.col("sa")).alias("px"),
        F.col("y").bitwiseXOR(F.col("sb")).alias("py"), "words", "weight", (F.col("total") - F.col("read") + F.col("words")).alias("rest"))
    roots = found.select("m", *[zero.alias(c) for c in ("depth", "x", "y", "px", "py", "words")], "weight", F.col("total").alias("rest"))
    steps = saved(steps.union(roots), "steps")

    nodes = saved(steps.groupBy(*NODE).agg(
        F.min("m").alias("conv_id"), F.sum("weight").alias("n_convs"), F.min("words").alias("words"), F.min("px").alias("px"),
        F.min("py").alias("py"), F.sum(F.col("weight") * F.col("rest")).alias("all_words")), "nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")).agg(
        F.count("*").alias("n_children"))
    children = saved(children, "children")
    leaves = found.join(children, NODE, "left_anti").select("m", F.lit(1).alias("leaf"))
    owned = nodes.groupBy(F.col("conv_id").alias("m")).agg(F.sum("words").alias("own"))
    facts = (found.select("m", F.explode(F.sequence(zero, F.floor(F.col("depth") / CHUNK))).alias("chunk"))
             .join(leaves, "m", "left").join(owned, "m", "left").na.fill(0, ["leaf", "own"]))
    below = (steps.withColumn("chunk", F.floor(F.col("depth") / CHUNK)).join(facts, ["m", "chunk"]).groupBy(*NODE)
             .agg(F.sum("leaf").alias("n_leaves"), F.sum(F.least("rest", "own")).alias("distinct_words")))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x").alias("px"), F.col("y").alias("py"),
                           F.col("conv_id").alias("parent_conv_id"))
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return (nodes.join(children, NODE, "left").join(below, NODE).join(found.select(*NODE, "ends"), NODE, "left")
            .join(parents, ["depth", "px", "py"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
                    F.col("n_leaves").cast("long").alias("n_leaves"),
                    (F.col("all_words") - F.col("distinct_words")).alias("saved_tokens"),
                    F.coalesce("ends", empty).alias("ends_sha256")))
