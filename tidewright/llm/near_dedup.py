"""Keep one document of each group of near duplicates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType

from tidewright.llm.common import free_names, saved, utf8
from tidewright.llm.simhash import near_duplicates, word_key


@F.arrow_udf(LongType())
def _key(texts: pa.Array) -> pa.Array:
    return pa.array(np.array([word_key(t) for t in texts.to_pylist()], np.int64))


def keep_one(docs: DataFrame, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without all but the row with the smallest id (null last) of each group, all columns unchanged.

    Rows of one group that share that id and its words are the same document; one of them stays.
    Empty texts are equal to each other.
    """
    grouped = saved(near_duplicates(docs, similarity, text_col, id_col), "groups")
    order = F.struct(F.col("id").isNull(), "id", "key")
    keep = grouped.groupBy("component").agg(F.min_by(F.struct("id", "key"), order).alias("keep"))
    own, of, keep_id, keep_key = free_names(docs, "_key", "_of", "_keep_id", "_keep_key")
    plan = grouped.join(keep, "component").groupBy(F.col("key").alias(of)).agg(F.first("keep.id").alias(keep_id), F.first("keep.key").alias(keep_key))
    keyed = docs.withColumn(own, _key(utf8(text_col)))
    joined = keyed.join(plan, F.col(own) == F.col(of), "left")
    mine = F.col(id_col).cast("long").eqNullSafe(F.col(keep_id)) & (F.col(own) == F.col(keep_key))
    alone = joined.where(F.col(of).isNull()).select(*docs.columns)
    first = joined.where(F.col(of).isNotNull() & mine).dropDuplicates([own]).select(*docs.columns)
    return alone.unionByName(first)
