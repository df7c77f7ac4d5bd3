"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Every line is described by its own counts and those of the line before and after it. The chain has
two states, good and bad. It is fitted on lines of labelled documents, each line carrying its
document's label; forward-backward marginals give each line's probability of being good, and their
mean weighted by line length is the document's quality, put on a 0-to-1 scale by a logistic curve
fitted on labelled documents that the chain has not seen.

The fit uses at most ``MOST_A_CLASS`` labelled documents of each class, chosen by a hash of the id,
from the caller's training set. Labels, language, source and id are never inputs of a score.

Lines end at \\n. Null text is empty; an empty text is one empty line. Without labelled rows of both
classes every score is the share of good rows (0.5 without labels). Repeated rows are scored alike;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewright.llm.common import arrow_schema, record_batch, saved, small_batches, utf8
from tidewright.llm.tokens import Stretches, logistic, pieces
from tidewright.llm.toxicity import bounded_sample

MOST_A_CLASS, CURVE = 3000, 3
STEPS, RATE, RIDGE = 150, 0.1, 1e-3


def _classes() -> np.ndarray:
    """0 other ASCII symbol, 1 space, 2 lower, 3 upper, 4 digit, 5 sentence mark, 6 beyond ASCII."""
    kind = np.zeros(256, np.uint8)
    kind[[9, 11, 12, 13, 32]] = 1
    kind[97:123], kind[65:91], kind[48:58], kind[128:] = 2, 3, 4, 6
    kind[[ord(c) for c in ".,;:?!'\"-"]] = 5
    return kind


_KIND = _classes()
N_OWN = 15


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, length in bytes, text number) of every line of ``texts``."""
    data = b"\n".join(texts)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    bytes_ = Stretches(data)
    raw = bytes_.raw
    ends = np.append(np.flatnonzero(raw == 10), len(raw))
    starts = np.concatenate([[0], ends[:-1] + 1])
    of = np.searchsorted(np.cumsum(lengths + 1), starts, side="right")
    size = ends - starts
    kind = _KIND[raw]
    n = len(starts)
    line_of = np.cumsum(raw == 10) - (raw == 10)
    counts = np.bincount(line_of * 8 + kind, minlength=n * 8).reshape(-1, 8)[:n].astype(float)
    counts[:, 0] -= np.bincount(line_of[raw == 10], minlength=n)[:n]  # the line ends themselves
    # Words: runs that are neither white space nor a line end.
    inside = (kind != 1) & (raw != 10)
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    w_start, w_end = edges[::2], edges[1::2]
    w_line = np.searchsorted(ends, w_start, side="right")
    w_line = np.minimum(w_line, n - 1)
    words = np.bincount(w_line, minlength=n).astype(float)
    w_len = np.bincount(w_line, w_end - w_start, n)
    w_square = np.bincount(w_line, (w_end - w_start) ** 2.0, n)
    code = bytes_.hash(w_start, w_end) if len(w_start) else np.zeros(0, np.uint64)
    same = np.zeros(len(code), bool)
    same[1:] = (code[1:] == code[:-1]) & (w_line[1:] == w_line[:-1])
    order = np.lexsort((code, w_line))
    fresh = np.ones(len(code), bool)
    fresh[1:] = (code[order][1:] != code[order][:-1]) | (w_line[order][1:] != w_line[order][:-1])
    distinct = np.bincount(w_line[order], fresh, n)
    capital = np.bincount(w_line, kind[w_start] == 3, n)
    marked = np.bincount(w_line, np.isin(kind[np.maximum(w_end - 1, 0)], (0, 5)), n)
    line_code = bytes_.hash(starts, ends)
    by = np.lexsort((np.arange(n), line_code, of))
    again = np.zeros(n)
    again[by[1:]] = (line_code[by][1:] == line_code[by][:-1]) & (of[by][1:] == of[by][:-1]) & (size[by][1:] > 0)
    per, per_word = np.maximum(size, 1), np.maximum(words, 1)
    mean = w_len / per_word
    own = np.column_stack([
        np.log1p(size), np.log1p(words), np.minimum(mean, 40) / 10, np.sqrt(np.maximum(w_square / per_word - mean ** 2, 0)).clip(0, 40) / 10,
        counts[:, 3] / per, counts[:, 4] / per, counts[:, 0] / per, counts[:, 5] / per, counts[:, 6] / per, counts[:, 1] / per,
        np.bincount(w_line, same, n) / per_word, distinct / per_word, capital / per_word, marked / per_word, again])
    before, after = np.zeros_like(own), np.zeros_like(own)
    joined = np.diff(of) == 0
    before[1:][joined], after[:-1][joined] = own[:-1][joined], own[1:][joined]
    first = np.append(True, ~joined)
    last = np.append(~joined, True)
    quadratic = own[:, [2, 4, 6, 7, 10, 11, 13]] ** 2
    return np.column_stack([own, quadratic, before, after, first, last, np.ones(n)]), size, of


def _forward_backward(scores: np.ndarray, turn: np.ndarray, lengths: np.ndarray):
    """Marginals of state 1, of equal neighbours' transitions, and log Z, for padded chains (chain, line, state)."""
    n, longest, _ = scores.shape
    forward, backward = np.empty_like(scores), np.zeros_like(scores)
    forward[:, 0] = scores[:, 0]
    for t in range(1, longest):
        step = forward[:, t - 1, :, None] + turn[None]
        forward[:, t] = np.logaddexp(step[:, 0], step[:, 1]) + scores[:, t]
    for t in range(longest - 2, -1, -1):
        step = turn[None] + (scores[:, t + 1] + backward[:, t + 1])[:, None, :]
        moved = np.logaddexp(step[:, :, 0], step[:, :, 1])
        backward[:, t] = np.where((t + 1 < lengths)[:, None], moved, 0.0)
    z = np.logaddexp.reduce(forward[np.arange(n), lengths - 1], axis=1)
    return forward, backward, z


def _padded(x: np.ndarray, of: np.ndarray):
    """Chains of lines as (chain, line) index arrays: chain number, place, lengths."""
    lengths = np.bincount(of)
    place = np.arange(len(of)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return place, lengths


def marginals(scores: np.ndarray, turn: np.ndarray, of: np.ndarray) -> np.ndarray:
    """P(good) of every line; chains of like length are padded together."""
    place, lengths = _padded(scores, of)
    out = np.empty(len(of))
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        most = max(16, int(lengths[order[at]] * 1.5))
        group = order[at:][lengths[order[at:]] <= most]
        group = group[:max(1, (1 << 18) // most)]
        at += len(group)
        longest = int(lengths[group].max())
        cell = np.minimum(starts[group, None] + np.arange(longest), len(of) - 1)
        block = scores[cell]
        forward, backward, z = _forward_backward(block, turn, lengths[group])
        good = np.exp(forward[:, :, 1] + backward[:, :, 1] - z[:, None])
        valid = np.arange(longest) < lengths[group, None]
        out[cell[valid]] = good[valid]
    return out


class Chain:
    def __init__(self, mean, spread, weights, turn):
        self.mean, self.spread, self.weights, self.turn = mean, spread, weights, turn

    def scores(self, x: np.ndarray) -> np.ndarray:
        good = ((x - self.mean) / self.spread) @ self.weights
        return np.column_stack([-good / 2, good / 2])

    def good_lines(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x, size, of = line_features(texts)
        return marginals(self.scores(x), self.turn, of), size, of

    def features(self, texts: list[bytes]) -> np.ndarray:
        """Length-weighted mean marginal of each text, as a probability and as clipped log odds."""
        good, size, of = self.good_lines(texts)
        weight = size + 1.0
        mean = np.bincount(of, good * weight, len(texts)) / np.bincount(of, weight, len(texts))
        return np.column_stack([mean, np.clip(np.log((mean + 1e-6) / (1 - mean + 1e-6)), -8, 8)])


def fit_chain(texts: list[bytes], labels: np.ndarray) -> Chain:
    """Maximum likelihood by Adam steps; gradients from forward-backward over all chains at once."""
    x, _, of = line_features(texts)
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    mean[-1], spread[-1] = 0.0, 1.0
    x = (x - mean) / spread
    y = labels[of].astype(float)
    weight_of = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum()))
    place, lengths = _padded(x, of)
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(lengths, kind="stable")
    blocks = [b for b in np.array_split(order, max(1, min(12, len(order) // 8))) if len(b)]
    w, turn = np.zeros(x.shape[1]), np.zeros((2, 2))
    m1, v1, m2, v2 = np.zeros_like(w), np.zeros_like(w), np.zeros_like(turn), np.zeros_like(turn)
    for step in range(1, STEPS + 1):
        good = x @ w
        scores = np.column_stack([-good / 2, good / 2])
        expected, pulls = np.zeros(len(of)), np.zeros((2, 2))
        for group in blocks:
            longest = int(lengths[group].max())
            cell = np.minimum(starts[group, None] + np.arange(longest), len(of) - 1)
            block = scores[cell]
            forward, backward, z = _forward_backward(block, turn, lengths[group])
            valid = np.arange(longest) < lengths[group, None]
            expected[cell[valid]] = np.exp(forward[:, :, 1] + backward[:, :, 1] - z[:, None])[valid]
            if longest > 1:
                edge = np.exp(np.minimum(0, forward[:, :-1, :, None] + turn + (block + backward)[:, 1:, None, :] - z[:, None, None, None]))
                inner = valid[:, 1:] * weight_of[group][:, None]
                pulls -= np.einsum("nlij,nl->ij", edge, inner)
                both = labels[group]
                for c in (0, 1):
                    pulls[c, c] += inner[both == c].sum()
        g = x.T @ (weight_of[of] * (y - expected)) - RIDGE * w
        pulls -= RIDGE * turn
        m1, v1 = 0.9 * m1 + 0.1 * g, 0.99 * v1 + 0.01 * g * g
        m2, v2 = 0.9 * m2 + 0.1 * pulls, 0.99 * v2 + 0.01 * pulls * pulls
        a, b = 1 - 0.9 ** step, 1 - 0.99 ** step
        w = w + RATE * (m1 / a) / (np.sqrt(v1 / b) + 1e-8)
        turn = turn + RATE * (m2 / a) / (np.sqrt(v2 / b) + 1e-8)
    return Chain(mean, spread, w, turn)


def line_quality(docs: DataFrame, labels: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "quality", most: int = MOST_A_CLASS) -> DataFrame:
    """One row per document: id, score (0 to 1), good_share (length-weighted mean marginal), n_lines, n_good_lines."""
    context = docs.sparkSession.sparkContext
    texts = small_batches(docs).select(F.col(id_col).cast("long").alias("id"), utf8(text_col).alias("text"))
    sample, kept = bounded_sample(labels.where(training), label_col, most, id_col)
    share = kept.get(1, (0, 0))[0] / sum(n for n, _ in kept.values()) if kept else 0.5
    model = None
    if len(kept) == 2:
        rows = texts.join(F.broadcast(saved(sample, "sample")), "id").select(
            "y", "text", F.pmod(F.xxhash64("id", F.lit(11)), F.lit(CURVE)).alias("part"), F.xxhash64("id").alias("place")).toArrow().sort_by("place")
        y, fold, bodies = rows.column("y").to_numpy(), rows.column("part").to_numpy() == 0, rows.column("text").to_pylist()
        pick = lambda mask: [bodies[i] for i in np.flatnonzero(mask)]
        if all(0 < y[f].sum() < f.sum() for f in (fold, ~fold)):
            chain = fit_chain(pick(~fold), y[~fold])
            x, y_curve = chain.features(pick(fold)), y[fold]
            mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
            weight = np.where(y_curve == 1, kept[1][0] / y_curve.sum(), kept[0][0] / (y_curve == 0).sum())
            model = context.broadcast((chain, mean, spread, logistic((x - mean) / spread, y_curve, weight, ridge=1e-4)))

    fields = "id long,score double,good_share double,n_lines long,n_good_lines long"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(fields)
        for batch in pieces(batches):
            bodies = batch.column("text").to_pylist()
            if model is None:
                n, lines = len(bodies), [b.count(b"\n") + 1 for b in bodies]
                yield record_batch(schema, id=batch.column("id"), score=np.full(n, share), good_share=np.full(n, share), n_lines=lines, n_good_lines=lines)
                continue
            chain, mean, spread, w = model.value
            good, size, of = chain.good_lines(bodies)
            n, weight = len(bodies), size + 1.0
            part = np.bincount(of, good * weight, n) / np.bincount(of, weight, n)
            x = np.column_stack([part, np.clip(np.log((part + 1e-6) / (1 - part + 1e-6)), -8, 8)])
            z = (x - mean) / spread @ w[:-1] + w[-1]
            yield record_batch(schema, id=batch.column("id"), score=1 / (1 + np.exp(-np.clip(z, -30, 30))), good_share=part,
                               n_lines=np.bincount(of, minlength=n), n_good_lines=np.bincount(of, good >= 0.5, n).astype(np.int64))

    return texts.mapInArrow(score, fields.replace(",", ", ")).withColumnRenamed("id", id_col)
