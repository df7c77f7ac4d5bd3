"""The n-gram join, the structure repair and the prefix trie on hard rows, against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tidewright.llm import parity_join as pj, prefix_trie as pt, structure_repair as sr, turns

DOCS = "doc_id long, text string, id long, n long, k long, family long, tiles long"
CONVS = "conv_id long, turn long, role string, text string, part int, position long, fault string, x long"


# --- n-gram join ---------------------------------------------------------------------------------------------------

def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 3]) for i in range(max(1, len(words) - 2))) if len(words) >= 3 else frozenset([tuple(words)])


def components_of(rows):
    sets, least = [(i, shingle_set(t)) for i, t in rows], {}
    nodes = list({(s if i is None else i) for i, s in sets})
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    kinds = defaultdict(set)
    for i, s in sets:
        kinds[s].add(s if i is None else i)
    for s, members in kinds.items():
        if s:
            first, *others = members
            for other in others:
                parent[find(other)] = find(first)
    known = [s for s in kinds if s and any(isinstance(m, int) for m in kinds[s])]
    for x in range(len(known)):
        for y in range(x):
            a, b = known[x], known[y]
            if 100 * len(a & b) >= 90 * len(a | b):
                parent[find(next(iter(kinds[a])))] = find(next(iter(kinds[b])))
    for n in nodes:
        if isinstance(n, int):
            least[find(n)] = min(n, least.get(find(n), n))
    return sorted(((i, len(s), i if not s else least.get(find(s if i is None else i))) for i, s in sets), key=repr)


def near_texts():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    out = [None, "", " \n\t", "one", "One", "a b", "A  b", "a b c", "b a", "é É x", "word " * 60]
    for n in (9, 10, 11, 12, 20, 22, 40, 60, 90, 150, 300, 900):
        base = [rng.choice(words) for _ in range(n)]
        for edits in (0, 1, 1, 2, 3, n // 60, n // 40, n // 30, n // 20):
            copy = list(base)
            for _ in range(edits):
                at = rng.randrange(len(copy))
                copy[at:at + 1] = rng.choice([[], [rng.choice(words)], [copy[at], rng.choice(words)]])
            out.append(" ".join(copy))
        out += [" ".join(base + base[:n // 9]), " ".join(base[:-1])]
    long = [rng.choice(words) for _ in range(30_000)]
    return out + [" ".join(long), " ".join(long[:29_000]), " ".join(long[:20_000]), out[30], out[30]]


@pytest.mark.parametrize("tile", [pj.TILE, 300])
def test_parity_join(spark, tile):
    texts = near_texts()
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)] + [(None, "a b c"), (None, "all alone here"), (None, None), (7, texts[1])]
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4, 5) for r in rows], DOCS).repartition(4)
    got = sorted((tuple(r) for r in pj.parity_join(docs, tile=tile).collect()), key=repr)
    want = components_of(rows)
    # Row (7, "") shares its id with a one-word text, which its own empty set does not join.
    assert got == want


def test_parity_join_of_nothing(spark):
    assert pj.parity_join(spark.createDataFrame([], DOCS)).count() == 0


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(4)
    for n in [*range(9, 40), 70, 100, 200, 700, 3000]:
        for _ in range(6):
            common = rng.integers(0, 1 << 62, n, dtype=np.uint64)
            extra = pj.differences(2 * n + 2 * n // 19, 90)
            cut = rng.integers(0, extra + 1)
            a = np.unique(np.concatenate([common, rng.integers(0, 1 << 62, cut, dtype=np.uint64)]))
            b = np.unique(np.concatenate([common, rng.integers(0, 1 << 62, extra - cut, dtype=np.uint64)]))
            if 100 * n >= 90 * (len(a) + len(b) - n):
                assert np.intersect1d(pj.block_keys(a, 90), pj.block_keys(b, 90)).size or (a.size == b.size == n), (n, cut, extra)


# --- structure repair ----------------------------------------------------------------------------------------------

def cheapest(initials, faults):
    """(cost, edits) over all edit sequences with at most two insertions in a row."""
    best = {0: (0, ""), 3: (0, "")}

    def opened(ends):
        out = dict(ends)
        for _ in range(2):
            for q, to in enumerate(sr.EXPECTED):
                if to in out and (new := (out[to][0] + 2, "I" + out[to][1])) < out.get(q, (1 << 60, "")):
                    out[q] = new
        return out

    best = opened(best)
    for initial, fault in reversed(list(zip(initials, faults))):
        new, stump = {}, fault == "t"
        for q in range(4):
            ways = [(best[q][0] + 3, "D" + best[q][1])] if q in best else []
            if fault not in "bd":
                to = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "e": {q: q}}.get(initial, {}).get(q)
                if to in best:
                    ways.append((best[to][0] + stump, "K" + best[to][1]))
                if sr.EXPECTED[q] in best:
                    ways.append((best[sr.EXPECTED[q]][0] + 2 + stump, "R" + best[sr.EXPECTED[q]][1]))
            if ways:
                new[q] = min(ways)
        best = opened(new)
    return best[0]


def by_blocks(initials, faults, size):
    """The same through the auction, in blocks of ``size`` rows."""
    cuts = [(initials[i:i + size], faults[i:i + size]) for i in range(0, len(initials), size)]
    end = tuple(0 if q in sr.ENDS else None for q in range(4))
    exits = [end]
    if len(cuts) > 1:
        exits = sr.border_prices([sr.crossing(*c) for c in cuts[:-1]], sr.Lattice(*cuts[-1], end, tail=True)) + [end]
    state, cost, out = 0, None, []
    for i, (cut, exit_prices) in enumerate(zip(cuts, exits)):
        found = {q: way for q, *way in sr._solve(*cut, exit_prices, i == len(cuts) - 1, tuple(range(4)))}
        edits, to, price = found[state]
        cost = price if cost is None else cost
        out.append(edits)
        state = to
    return cost, "".join(out)


def test_auction_against_every_way():
    rng = random.Random(8)
    for n in [1, 2, 3, 4, 5, 6, 7, 8, 12, 20] * 12:
        odds = rng.choice(["suax", "uuaa", "suaxe", "ua", "xxes"])
        initials = "".join(rng.choice(odds) for _ in range(n))
        faults = "".join(rng.choice(rng.choice(["o", "oootbd", "bd", "tto"])) for _ in range(n))
        want = cheapest(initials, faults)
        assert by_blocks(initials, faults, 64) == want, (initials, faults)
        for size in (1, 2, 3, 5):
            assert by_blocks(initials, faults, size) == want, (initials, faults, size)


def test_auction_on_long_blocks():
    rng = random.Random(9)
    for odds in ("ua", "u", "x", "suax"):
        initials = "".join(rng.choice(odds) for _ in range(600))
        faults = "".join(rng.choice("ooootbd") for _ in range(600))
        assert by_blocks(initials, faults, sr.BLOCK) == cheapest(initials, faults)


def repaired(rows):
    """{conv_id: row} by plain Python."""
    convs = defaultdict(list)
    for conv_id, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        convs[conv_id]
        if kind == 4:
            role = "user"
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        convs[conv_id] += [(turn, role, text)] * ((kind != 0) + (kind == 3))
    out = {}
    for conv_id, held in convs.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0))  # ties: rows that are equal throughout
        seen, faults, initials = set(), "", ""
        for _, role, text in held:
            body = text.strip(" \t\n\x0b\x0c\r")
            faults += "b" if not body else "d" if (role, text) in seen else "o" if body[-1] in ".!?" else "t"
            seen.add((role, text))
            initials += "e" if not role else role[0] if role[0] in "sua" else "x"
        known = [t for t, *_ in held if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(initials[i:i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))
        cost, audit = cheapest(initials, faults)
        lines, state, at = [], 0, 0
        for edit in audit:
            if edit == "I":
                state = sr.EXPECTED[state]
                lines.append(sr.ROLES[state] + ":")
                continue
            _, role, text = held[at]
            if edit == "R":
                state = sr.EXPECTED[state]
                lines.append(sr.ROLES[state] + ":" + text)
            elif edit == "K":
                state = {"s": 1, "u": 2, "a": 3}.get(initials[at], state)
                lines.append(role + ":" + text)
            at += 1
        out[conv_id] = (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit,
                        hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def hard_turns():
    rng = random.Random(10)
    rows = []
    roles = ["user", "assistant", "system", "tool", "User", "", None, "user", "assistant", "user", "assistant"]
    for conv_id in [*range(-25, 40), None, 1 << 40]:
        turns_here = list(range(rng.randint(1, 9)))
        if rng.random() < 0.3:
            turns_here[0] = None
        for turn in turns_here:
            text = rng.choice(["Hi.", "Yes!", "So", None, "", " \t", "Long\x0b text? ", "Hi.", "é…", "A.B!C?"])
            if rng.random() < 0.5:
                text = f"{text} {rng.random()}" + rng.choice([".", ""])
            rows.append((conv_id, turn, rng.choice(roles), text))
    rows += [(500, i, ("user", "assistant")[i % 2] if rng.random() < 0.8 else rng.choice(roles), f"Turn {i % 170}" + rng.choice([".", "", "?"]))
             for i in range(400)]
    rows += [(501, 0, "user", "x" * 200_000 + "."), (501, 1, "assistant", "Twice."), (501, 1, "assistant", "Twice.")]
    return rows


@pytest.fixture(scope="module")
def conversations(spark):
    return spark.createDataFrame([(*r, 1, 2, "f", 3) for r in hard_turns()], CONVS).repartition(5)


def test_structure_repair(spark, conversations):
    got = sr.repair(conversations)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == repaired(hard_turns())


def test_structure_repair_of_nothing(spark):
    assert sr.repair(spark.createDataFrame([], CONVS)).count() == 0


# --- prefix trie ---------------------------------------------------------------------------------------------------

def trie(rows):
    convs = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            convs[conv_id].append((turn, role or "", text or ""))
    for held in convs.values():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    plain = {c: [r[1:] for r in held] for c, held in convs.items()}
    made = {}
    for c, own in plain.items():
        h, base = zlib.crc32(str(c).encode()) % 4, c - int(np.fmod(c, 20))
        made[c] = tuple(plain.get(base, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, seq in made.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node in members:
        own = (len(members[node]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += own
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), children.get(n, 0), leaves[n], saved[n],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(made[c]) == len(n)).encode()).hexdigest()) for n, m in members.items())


def shared_turns():
    rng = random.Random(12)
    rows, talk = [], [("user", "Hello there."), ("assistant", "Hello you  too"), ("user", None), (None, "x"), ("user", "Bye now")]
    for conv_id in [*range(-21, 130), None, 10 ** 12]:
        if conv_id in (40, 60):
            continue  # families without their first member
        for turn in range(rng.randint(1, 6)):
            role, text = talk[turn % 5] if rng.random() < 0.85 else (rng.choice(["user", "tool"]), rng.choice(["odd", "words of   its own", ""]))
            rows.append((conv_id, None if turn == 0 and rng.random() < 0.3 else turn, role, text))
    return rows + [(900, i, "user", f"turn {i // 2}") for i in range(30)] + [(901, i, "user", f"turn {i // 2}") for i in range(25)]


@pytest.mark.parametrize("chunk", [pt.CHUNK, 3])
def test_prefix_trie(spark, monkeypatch, chunk):
    monkeypatch.setattr(pt, "CHUNK", chunk)
    monkeypatch.setattr(pt, "PIECE", chunk)
    frame = spark.createDataFrame([(*r, 1, 2, "f", 3) for r in shared_turns()], CONVS).repartition(5)
    got = sorted(tuple(r) for r in pt.prefix_trie(frame).collect())
    assert got == trie(shared_turns())


def test_prefix_trie_of_nothing(spark):
    assert pt.prefix_trie(spark.createDataFrame([], CONVS)).count() == 0


def test_turns_are_numbered_across_parts(spark):
    frame = spark.range(1000).selectExpr("id % 2 * 7 AS conv_id", "id AS turn", "0L AS a", "0L AS b")
    local, starts = turns.numbered(frame, "conv_id", ["turn", "a", "b"], "numbered")
    got = local.join(starts, ["conv_id", "part"]).selectExpr("conv_id", "turn", "before + local AS at", "total").collect()
    assert all(r.at == r.turn // 2 + 1 and r.total == 500 for r in got) and len({r.conv_id for r in got}) == 2
