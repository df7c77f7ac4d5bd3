"""Secret scan: fixed patterns, and a password guess-cost measure for values in credential contexts.

Base kinds are literal patterns (assign, access, hex). The method adds kind ``guess``: a value that
follows a credential word and is expensive to guess. Its cost is the least sum, over all ways to cut
the value into segments, of the segments' guess counts (log10): a word by its rank in the corpus or
among common passwords, with capitals and look-alike digits; a date or year; a repeated unit; an
alphabetic or numeric sequence; a walk over neighbouring keys; or a brute-force stretch by the size
of its alphabet. Dynamic programming over the end position finds the minimum. ``password =
summer2020`` is cheap and stays unflagged by the method; a generated token is not. Values of letters only
are measured like all others; after a mere blank or ``is``, where ordinary words follow, they count from
``COSTLY_WORD``. A value that is itself a credential word with a separator gives way to its own value.

Word ranks come from the whole corpus: all documents are counted, the ``RANKED`` most frequent words
are kept as the dictionary (a fixed size, whatever the input). Null text is empty. Whole texts and
whole values are read. Repeated rows are reported alike; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidewright.llm.common import arrow_schema, record_batch, small_batches, utf8
from tidewright.llm.tokens import Tokens, pieces

RANKED, RANK_PARTS = 20_000, 8
#: log10 of guesses from which a value counts as a secret.
COSTLY = 10.0
#: The same for letters only after a blank or " is ": above an unknown word of 11 letters.
COSTLY_WORD = 16.0
LONGEST_WORD, LONGEST_REPEAT = 24, 12
#: A walk or sequence may end at any of its first characters up to this many, or where it ends by itself.
INNER_ENDS = 64

ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
_ASSIGN_HINTS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
#: Credential contexts of the method: wider than the base pattern.
_VALUE = r"[^\s\"'`,;<>()\[\]{}]"
#: Ends where the value starts; the group is the separator, none for a blank or " is ".
CONTEXT = re.compile(
    r"(?:pass(?:word|wd|phrase|code|key)?|pwd|pin|secret|token|(?:api|access|private|secret|auth)[_ -]?key|auth(?:orization)?|bearer|"
    r"credentials?|login|client[_ -]?secret)[\"']?(?:\x20*(:=|=>|[:=])\x20*|\x20+is\x20+|\x20+)[\"'`]?(?=" + _VALUE + "{6})", re.I | re.A)
VALUE = re.compile(_VALUE + "+")
_CONTEXT_HINTS = (b"pass", b"pwd", b"pin", b"secret", b"token", b"key", b"auth", b"bearer", b"credential", b"login")

# Frequent passwords, most frequent first.
COMMON = (
    "password", "admin", "welcome", "letmein", "monkey", "dragon", "football", "baseball", "iloveyou", "master", "sunshine",
    "princess", "shadow", "superman", "michael", "login", "secret", "test", "guest", "root", "user", "changeme", "default",
    "example", "summer", "winter", "spring", "autumn", "hello", "love",
)
_LOOKALIKE = str.maketrans("013457@$!", "oieastasi")
_ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
_DATE = re.compile(r"(?:19|20)\d\d[-/._]?(?:1[0-2]|0?[1-9])[-/._]?(?:3[01]|[12]\d|0?[1-9])|(?:3[01]|[12]\d|0?[1-9])[-/._]?(?:1[0-2]|0?[1-9])[-/._]?(?:19|20)\d\d|(?:19|20)\d\d")


def _neighbours() -> frozenset[tuple[str, str]]:
    """Pairs of keys that touch on the keyboard rows, each row shifted by half a key."""
    out = set()
    for r, row in enumerate(_ROWS):
        for i, key in enumerate(row):
            around = [(r, i - 1), (r, i + 1), (r + 1, i - 1), (r + 1, i), (r - 1, i), (r - 1, i + 1)]
            out |= {(key, _ROWS[a][b]) for a, b in around if 0 <= a < len(_ROWS) and 0 <= b < len(_ROWS[a])}
    return frozenset(out)


_TOUCH = _neighbours()


def _alphabet(c: str) -> float:
    return 1.0 if c.isdigit() else math.log10(26) if c.isascii() and c.isalpha() else math.log10(33) if c.isascii() else 3.0


def _runs(value: str, linked) -> list[int]:
    """For each position the end of the longest stretch whose neighbouring characters are all linked."""
    ends = list(range(1, len(value) + 1))
    for i in range(len(value) - 2, -1, -1):
        if linked(value[i], value[i + 1]):
            ends[i] = ends[i + 1]
    return ends


def _repeats(value: str, unit: int) -> list[int]:
    """For each position how many characters from there equal the one ``unit`` later, without a gap."""
    same = [0] * len(value)
    for i in range(len(value) - unit - 1, -1, -1):
        if value[i] == value[i + unit]:
            same[i] = same[i + 1] + 1
    return same


def guess_cost(value: str, ranks: dict[str, int]) -> float:
    """log10 of the guesses that the cheapest segmentation of ``value`` needs."""
    n, low = len(value), value.lower()
    if len(low) != n:
        low = value
    plain = low.translate(_LOOKALIKE)
    walks = _runs(low, lambda a, b: (a, b) in _TOUCH)
    up, down = (_runs(low, lambda a, b, d=d: a.isalnum() and b.isalnum() and ord(b) - ord(a) == d) for d in (1, -1))
    repeats = [_repeats(value, unit) for unit in range(1, min(LONGEST_REPEAT, n // 2) + 1)]
    hard = math.log10(2) if value != low and value != value.upper() else 0.0
    best = [0.0] + [math.inf] * n

    def offer(end: int, cost: float) -> None:
        if cost < best[end]:
            best[end] = cost

    for i in range(n):
        here = best[i] + (0.3 if i else 0.0)  # log10(2): where one segment ends and the next begins
        # Brute force; a stretch pays the boundary once, as single characters extend it for free.
        offer(i + 1, best[i] + _alphabet(value[i]) + (hard if value[i].isalpha() else 0.0))
        for size in range(3, min(LONGEST_WORD, n - i) + 1):
            end = i + size
            rank = ranks.get(low[i:end])
            turned = rank is None
            if turned:
                rank = ranks.get(plain[i:end])
            if rank is not None:
                piece = value[i:end]
                caps = 0.0 if piece == low[i:end] else math.log10(2) if piece[1:] == low[i + 1:end] or piece.isupper() else size * math.log10(2) / 2
                offer(end, here + math.log10(rank + 2) + caps + (0.6 if turned else 0.0))
        for ends, base in ((walks, 40), (up, 62), (down, 62)):
            for end in range(i + 3, min(ends[i], i + INNER_ENDS) + 1):
                offer(end, here + math.log10(base * (end - i)))
            if ends[i] > i + INNER_ENDS:
                offer(ends[i], here + math.log10(base * (ends[i] - i)))
        date = _DATE.match(value, i)
        if date:
            offer(date.end(), here + (2.0 if date.end() - i == 4 else 4.6))
        for unit, same in enumerate(repeats, 1):
            times = 1 + same[i] // unit
            if times > 1 and unit * times >= 3:
                offer(i + unit * times, here + sum(map(_alphabet, value[i:i + unit])) + math.log10(times))
    return best[n]


def scan(text: str, ranks: dict[str, int]) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, float]]]:
    """(base spans as (start, kind number, end)), (guess spans as (start, end, cost))."""
    raw = text.encode("utf-8", "replace").lower()
    base, guesses = [], []
    if any(h in raw for h in _ASSIGN_HINTS):
        base += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    base += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if any(h in raw for h in _CONTEXT_HINTS):
        end = 0
        for m in CONTEXT.finditer(text):
            start = m.end()
            if start < end:  # inside a value that was measured as a whole
                continue
            within = CONTEXT.match(text, start)
            if within and within[1]:
                continue
            end = VALUE.match(text, start).end()
            value = text[start:end]
            cost = _cached(value, ranks)
            if cost >= (COSTLY_WORD if m[1] is None and _wordlike(value) else COSTLY):
                guesses.append((start, end, cost))
    return sorted(base), guesses


_COSTS: dict[str, float] = {}


def _wordlike(value: str) -> str:
    """The letters of a value of letters only, the first perhaps a capital, without marks at the end; else empty."""
    bare = value.rstrip(".!?:")
    return bare if bare.isalpha() and bare[1:] == bare[1:].lower() else ""


def _cached(value: str, ranks: dict[str, int]) -> float:
    if value not in _COSTS:
        if len(_COSTS) > 50_000:
            _COSTS.clear()
        word = _wordlike(value)
        if word:  # a capital at the start of a word doubles the guesses once
            _COSTS[value] = guess_cost(word.lower(), ranks) + (0.0 if word[0].islower() else math.log10(2))
        else:
            _COSTS[value] = guess_cost(value, ranks) if value.rstrip(".!?:") else 0.0
    return _COSTS[value]


KINDS = ("assign", "access", "hex", "guess")


def dictionary(texts: DataFrame) -> dict[str, int]:
    """Rank of the most frequent words of all documents, common passwords first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, held = arrow_schema("word string,n long"), {}
        for batch in pieces(batches):
            tokens = Tokens(batch.column("text").to_pylist())
            size = tokens.ends - tokens.starts
            fit = (size >= 3) & (size <= LONGEST_WORD)
            start, end = tokens.starts[fit], tokens.ends[fit]
            _, first, n = np.unique(tokens.hash(start, end), return_index=True, return_counts=True)
            body = tokens.data
            for s, e, c in zip(start[first].tolist(), end[first].tolist(), n.tolist()):
                word = body[s:e]
                held[word] = held.get(word, 0) + c
            if len(held) > 300_000:
                yield record_batch(schema, word=[w.decode("utf-8", "replace") for w in held], n=list(held.values()))
                held = {}
        yield record_batch(schema, word=[w.decode("utf-8", "replace") for w in held], n=list(held.values()))

    totals = texts.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    # Ranked in a fixed number of parts first: tasks would each send their own best to the driver otherwise.
    part = Window.partitionBy(F.pmod(F.xxhash64("word"), F.lit(RANK_PARTS))).orderBy(F.desc("n"), "word")
    top = (totals.withColumn("place", F.row_number().over(part)).where(F.col("place") <= RANKED)
           .orderBy(F.desc("n"), "word").limit(RANKED))
    ranks: dict[str, int] = {}
    for word in (*COMMON, *(r.word for r in top.select("word").collect())):
        ranks.setdefault(word, len(ranks))
    return ranks


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, spans array of (kind, start, end, cost), base spans first at equal starts."""
    texts = small_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ranks = docs.sparkSession.sparkContext.broadcast(dictionary(texts.select("id", utf8("text").alias("text"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("cost", pa.float64())])
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                base, guesses = scan(text, ranks.value)
                spans = sorted([(s, k, e, None) for s, k, e in base] + [(s, 3, e, c) for s, e, c in guesses], key=lambda x: x[:3])
                out.append([{"kind": KINDS[k], "start": s, "end": e, "cost": c} for s, k, e, c in spans])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.list_(kind))], names=["id", "spans"])

    return texts.mapInArrow(run, "id long, spans array<struct<kind: string, start: long, end: long, cost: double>>").withColumnRenamed("id", id_col)
