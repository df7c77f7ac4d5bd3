"""Toxicity from two class-conditional Kneser-Ney models.

The score compares the log-likelihoods of a text under a toxic and an ordinary word-bigram model,
each divided by the number of words. A bigram backs off to the word by its number of distinct left
neighbours, a word to its stem (first ``STEM`` bytes), and a stem to its share in the whole corpus:
these last counts cover every document, labelled or not, and are shared by both models, so a rare
expression weighs the same on both sides unless its relatives tell. Stems that the sample lacks are
counted with all they hold and stand as one row of their mean share.

Class counts come from labelled rows of the caller's training set, at most ``MOST_A_CLASS`` of each
class (chosen by a hash of the id); a further part of those rows, held out from the counts, sets the
logistic curve that turns the length-normalised difference into a score. Labels, language, source
and id are never inputs of a score. Every sampled word is kept, as a word and as a context. Bigrams seen
fewer than ``LEAST_BIGRAM`` times in a class leave their mass to the word model, which keeps the model
small enough for every task to hold.

Null text is empty. Empty texts get the curve's value at 0 difference. Without any labelled row of
one of the classes every score is the share of toxic rows (0 without labels). Repeated rows are
scored alike; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewright.llm.common import arrow_schema, given_back, record_batch, saved, small_batches, utf8
from tidewright.llm.tokens import Tokens, logistic, lookup, mix, pieces

STEM, LEAST_BIGRAM, DISCOUNT = 4, 3, 0.75
MOST_A_CLASS = 12_000
#: Of the sampled rows one in this many sets the curve; the rest is counted.
CURVE = 4


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * np.uint64(3) + right)


def bounded_sample(labels: DataFrame, label: str, most: int, id_col: str = "doc_id") -> tuple[DataFrame, dict[int, tuple[int, int]]]:
    """(id, y) with about ``most`` rows a class at most, and {class: (rows, rows kept)}; one row an id, the larger label wins."""
    rows = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(label).cast("int").alias("y")).where("id is not null")
    counts = dict(rows.groupBy("y").count().collect())
    place = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("y") == 1, min(1.0, most / max(1, counts.get(1, 0)))).otherwise(min(1.0, most / max(1, counts.get(0, 0))))
    return rows.where(place < share), {c: (n, min(n, most)) for c, n in counts.items()}


class Models:
    """Both models as sorted arrays; class 0 ordinary, class 1 toxic."""

    def __init__(self, words, cont, total, kept, pairs, pair_counts, stems, stem_cont, stem_types, stem_shared, other_stems, other_shared):
        def rows(x):  # one more row stands for what the sample lacks
            return np.vstack([x, np.zeros(2)]).astype(np.float32)

        self.words, self.pairs, self.stems = words, pairs, stems
        self.pair_counts, self.total, self.kept = rows(pair_counts), rows(total), rows(kept)
        n = np.maximum(stem_cont.sum(axis=0), 1.0)
        # The row of other stems: their mean, and one more for a stem that no document has.
        shared = np.append(stem_shared + 1.0, (other_shared + other_stems + 1.0) / (other_stems + 1.0))
        shared /= shared[:-1].sum() + other_shared + other_stems + 1.0
        back = DISCOUNT * (stem_cont > 0).sum(axis=0) / n
        p_stem = np.vstack([np.maximum(stem_cont - DISCOUNT, 0) / n, np.zeros(2)]) + back * shared[:, None]
        self.p_new = (p_stem / np.append(stem_types + 1.0, 1.0)[:, None]).astype(np.float32)
        p_word = np.maximum(cont - DISCOUNT, 0) / n
        self.back_word = (1 - p_word.sum(axis=0)).clip(1e-6)
        self.p_word = rows(p_word)

    def ratios(self, tokens: Tokens) -> np.ndarray:
        """log p(word | toxic) - log p(word | ordinary) for every word."""
        word = tokens.words()
        previous = np.concatenate([np.zeros(1, np.uint64), word[:-1]])[:len(word)]
        previous[np.diff(tokens.of, prepend=-1) != 0] = 0
        at, before, stem = lookup(self.words, word), lookup(self.words, previous), lookup(self.stems, tokens.stems(STEM))
        p = self.p_word[at] + self.back_word * self.p_new[stem]
        total = self.total[before]
        seen = total > 0
        pair = lookup(self.pairs, _pair(previous, word))
        count = self.pair_counts[pair]
        safe = np.where(seen, total, 1.0)
        p = np.where(seen, np.maximum(count - DISCOUNT, 0) / safe + (1 - self.kept[before] / safe) * p, p)
        return np.log(p[:, 1]) - np.log(p[:, 0])

    def features(self, texts: list[bytes]) -> np.ndarray:
        """Per text: mean log ratio, the mean of its part above 1, and the log of the sum of its part above 2."""
        tokens = Tokens(texts)
        out = np.zeros((len(texts), 3))
        if len(tokens.starts):
            ratio = self.ratios(tokens)
            n = np.maximum(np.bincount(tokens.of, minlength=len(texts)), 1)
            out[:, 0] = np.bincount(tokens.of, ratio, len(texts)) / n
            out[:, 1] = np.bincount(tokens.of, np.maximum(ratio - 1, 0), len(texts)) / n
            out[:, 2] = np.log1p(np.bincount(tokens.of, np.maximum(ratio - 2, 0), len(texts)))
        return out


def fit(texts: DataFrame, sample: DataFrame) -> Models:
    """``texts``: id, text (binary) of all documents; ``sample``: bounded (id, y) whose rows are counted."""
    @given_back
    def count_stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Arrays, not a dict: a worker never gives the memory of many small objects back.
        schema, kept, counts, held = arrow_schema("stem long,n long"), [], [], 0

        def folded():
            values, at = np.unique(np.concatenate(kept or [np.zeros(0, np.uint64)]), return_inverse=True)
            return values, np.bincount(at, np.concatenate(counts or [np.zeros(0, np.int64)]), len(values)).astype(np.int64)

        for batch in pieces(batches):
            value, n = np.unique(Tokens(batch.column("text").to_pylist()).stems(STEM), return_counts=True)
            kept.append(value)
            counts.append(n)
            held += len(value)
            if held > 800_000:
                value, n = folded()
                kept, counts, held = [value], [n], len(value)
                if held > 400_000:
                    yield record_batch(schema, stem=value.view(np.int64), n=n)
                    kept, counts, held = [], [], 0
        value, n = folded()
        yield record_batch(schema, stem=value.view(np.int64), n=n)

    @given_back
    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("y int,prev long,word long,stem long,n long")
        for batch in pieces(batches):
            tokens = Tokens(batch.column("text").to_pylist())
            if not len(tokens.starts):
                continue
            word, stem, y = tokens.words(), tokens.stems(STEM), batch.column("y").to_numpy()[tokens.of]
            previous = np.concatenate([np.zeros(1, np.uint64), word[:-1]])
            previous[np.diff(tokens.of, prepend=-1) != 0] = 0
            _, first, n = np.unique(mix(_pair(previous, word) + y.astype(np.uint64)), return_index=True, return_counts=True)
            yield record_batch(schema, y=y[first], prev=previous[first].view(np.int64), word=word[first].view(np.int64),
                               stem=stem[first].view(np.int64), n=n)

    marked = texts.join(F.broadcast(sample), "id").select("text", "y")
    pairs = saved(marked.mapInArrow(count_pairs, "y int, prev long, word long, stem long, n long")
                  .groupBy("y", "prev", "word").agg(F.sum("n").alias("n"), F.first("stem").alias("stem")), "pairs")
    by_class = lambda value: [F.sum(F.when(F.col("y") == c, value).otherwise(0)).cast("double").alias(f"c{c}") for c in (0, 1)]
    columns = lambda table, *names: np.column_stack([table.column(n).to_numpy() for n in names])
    by_word = saved(pairs.groupBy("word").agg(F.first("stem").alias("stem"), *by_class(F.lit(1))), "words")
    words = by_word.drop("stem").toArrow()
    kept_mass = F.when(F.col("n") >= LEAST_BIGRAM, F.col("n") - DISCOUNT).otherwise(0)
    contexts = pairs.groupBy("prev").agg(*by_class(F.col("n")), *[x.alias(f"k{i}") for i, x in enumerate(by_class(kept_mass))]).toArrow()
    frequent = pairs.where(F.col("n") >= LEAST_BIGRAM).groupBy("prev", "word").agg(*by_class(F.col("n"))).toArrow()
    # The whole corpus is counted; the stems that the sample lacks reach the model as their number and sum.
    sampled = by_word.groupBy("stem").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"), F.count("*").cast("double").alias("types"))
    corpus = saved(texts.select("text").mapInArrow(count_stems, "stem long, n long").groupBy("stem").agg(F.sum("n").alias("n")), "stems")
    shared = corpus.join(sampled, "stem").toArrow()
    n_stems, n_words = corpus.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()

    codes = lambda table, name: table.column(name).to_numpy().view(np.uint64)
    # 0 is the context at the start of a text and no word.
    key, stems = np.append(codes(words, "word"), np.uint64(0)), codes(shared, "stem")
    order, by_stem = np.argsort(key), np.argsort(stems)
    key, cont = key[order], np.vstack([columns(words, "c0", "c1"), np.zeros(2)])[order]
    total, kept = np.zeros((len(key), 2)), np.zeros((len(key), 2))
    at = lookup(key, codes(contexts, "prev"))
    total[at], kept[at] = columns(contexts, "c0", "c1"), columns(contexts, "k0", "k1")
    pair = _pair(codes(frequent, "prev"), codes(frequent, "word"))
    by_pair = np.argsort(pair)
    return Models(key, cont, total, kept, pair[by_pair], columns(frequent, "c0", "c1")[by_pair], stems[by_stem],
                  columns(shared, "c0", "c1")[by_stem], shared.column("types").to_numpy()[by_stem], columns(shared, "n")[by_stem, 0].astype(float),
                  float(n_stems - len(stems)), float(n_words - shared.column("n").to_numpy().sum()))


def toxicity_scorer(docs: DataFrame, labels: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", most: int = MOST_A_CLASS) -> Callable[[Column], Column]:
    """Fit on ``docs`` and ``labels``; the result turns a text column into a struct (score, mean_ratio)."""
    context = docs.sparkSession.sparkContext
    texts = small_batches(docs).select(F.col(id_col).cast("long").alias("id"), utf8(text_col).alias("text"))
    sample, kept = bounded_sample(labels.where(training), label_col, most, id_col)
    sample = saved(sample, "sample")
    part = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(CURVE))
    models = curve = None
    share = kept.get(1, (0, 0))[0] / max(1, sum(n for n, _ in kept.values()))
    if len(kept) == 2:
        models = context.broadcast(fit(texts, sample.where(part != 0)))

        @given_back
        def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches):
                x = models.value.features(batch.column("text").to_pylist())
                yield record_batch(arrow_schema("y int,a double,b double,c double"), y=batch.column("y"), a=x[:, 0], b=x[:, 1], c=x[:, 2])

        got = texts.join(F.broadcast(sample.where(part == 0)), "id").select("text", "y").mapInArrow(
            features, "y int, a double, b double, c double").toArrow()
        x, y = np.column_stack([got.column(c).to_numpy() for c in "abc"]), got.column("y").to_numpy()
        if 0 < y.sum() < len(y):
            mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
            weight = np.where(y == 1, kept[1][0] / max(1, y.sum()), kept[0][0] / max(1, (y == 0).sum()))
            curve = (mean, spread, logistic((x - mean) / spread, y, weight, ridge=1e-4))

    @F.arrow_udf("struct<score: double, mean_ratio: double>")
    def score(bodies: pa.Array) -> pa.Array:
        scores, ratios = [np.zeros(0)], [np.zeros(0)]
        for batch in pieces([pa.RecordBatch.from_arrays([bodies], names=["text"])]):
            if curve is None:
                z, ratio = np.full(batch.num_rows, share), np.zeros(batch.num_rows)
            else:
                x = models.value.features(batch.column("text").to_pylist())
                mean, spread, w = curve
                z = 1 / (1 + np.exp(-np.clip((x - mean) / spread @ w[:-1] + w[-1], -30, 30)))
                ratio = x[:, 0]
            scores.append(z)
            ratios.append(ratio)
        return pa.StructArray.from_arrays([pa.array(np.concatenate(scores)), pa.array(np.concatenate(ratios))], names=["score", "mean_ratio"])

    return lambda text: score(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def toxicity(docs: DataFrame, labels: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: id, score (0 to 1), mean_ratio. ``training`` picks the rows of ``labels`` (by ``id_col``) to learn from."""
    scorer = toxicity_scorer(docs, labels, training, id_col, text_col, **options)
    return docs.select(F.col(id_col), scorer(F.col(text_col)).alias("found")).select(id_col, "found.score", "found.mean_ratio")
