"""Each operator on hard rows: nulls, empty and long texts, ties, repeats, clashing columns, empty tables."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewright.llm import common, guess_cost, line_quality, packing, page_text, simhash, super_kmers
from tidewright.llm.common import held_out
from tidewright.llm.exact_dedup import exact_dedup, keep_first, rice_decode, rice_encode
from tidewright.llm.exact_topk import exact_topk
from tidewright.llm.mixing import mix, mixed
from tidewright.llm.near_dedup import keep_one
from tidewright.llm.queries import tokenizer_path
from tidewright.llm.toxicity import toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, key long, score double"


def texts():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    long = " ".join(rng.choice(words) for _ in range(40_000))
    out = [None, "", " \n\t", "one", "One", "a b", "a  b\n", "b a", "word " * 50, "x y", long, long + " tail"]
    for i in range(40):
        body = [rng.choice(words) for _ in range(rng.randint(5, 120))]
        out.append(" ".join(body) + (f"\n{passage} " if i % 3 == 0 else ".\n") + " ".join(rng.choice(words) for _ in range(30)))
    near = [rng.choice(words) for _ in range(200)]
    for i in range(12):
        copy = list(near)
        copy[17 * i % 200] = f"edit{i}"
        out.append(" ".join(copy))
    return out + [out[20]] * 6


@pytest.fixture(scope="module")
def rows():
    made = [(i + 1, t, "en", [None, "b", "a", "é"][i % 4]) for i, t in enumerate(texts())]
    return made + [made[25], made[25], (None, "orphan words", None, None), (None, None, None, "a")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, 0, 7, 8, 0.5) for r in rows], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_rice_code_round_trip():
    rng = np.random.default_rng(1)
    for n in (1, 2, 1000):
        values = np.unique(rng.integers(0, 1 << 60, n, dtype=np.uint64))
        assert (rice_decode(rice_encode(values, 60), len(values)) == values).all()


def test_exact_dedup(docs, rows, nothing):
    got = exact_dedup(docs).collect()
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    want = Counter()
    for bare, members in groups.items():
        keep = min(members)[3]
        for i, (*_, doc_id) in enumerate(sorted(members)):
            want[doc_id, keep, len(members), i == 0, hashlib.sha256(bare.encode()).hexdigest()] += 1
    assert Counter(map(tuple, got)) == want
    kept = keep_first(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_dedup(nothing).count() == 0 and keep_first(nothing).count() == 0


def brute_windows(rows):
    seen, out = set(), []
    order = sorted({(r[0] is None, r[0] or 0, " ".join((r[1] or "").split(" ")), r[0], r[1]) for r in rows}, key=lambda x: (x[0], x[1], x[2]))
    for *_, doc_id, text in order:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for i in range(len(words) - 19):
            window = tuple(words[i:i + 20])
            if window in seen:
                gone[i:i + 20] = [True] * 20
            seen.add(window)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc_id, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


def test_substring_dedup(docs, rows, nothing, monkeypatch):
    want = brute_windows(rows)
    got = {tuple(r) for r in super_kmers.substring_dedup(docs).collect()}
    assert got == set(want)
    monkeypatch.setattr(super_kmers, "PIECE_BYTES", 3000)
    monkeypatch.setattr(super_kmers, "HOT_SHARE", 1e-4)
    assert {tuple(r) for r in super_kmers.substring_dedup(docs).collect()} == set(want)
    assert super_kmers.substring_dedup(docs).count() == len(rows)
    assert super_kmers.substring_dedup(nothing).count() == 0


@pytest.mark.parametrize("shard", [4, 65536])
def test_simhash_components(docs, rows, nothing, shard):
    got = simhash.simhash_components(docs, shard=shard).collect()
    codes = [simhash.fingerprint((r[1] or "").encode(), 3) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(least.get(find(i), 1 << 60), r[0] if r[0] is not None else 1 << 60)
    known = lambda x: x if x < 1 << 60 else None
    want = Counter((r[0], format(codes[i], "016x"), known(least[find(i)])) for i, r in enumerate(rows))
    assert Counter(map(tuple, got)) == want
    assert simhash.simhash_components(nothing).count() == 0


def test_fingerprint_by_hand():
    words, hashes = "a b c d".split(), []
    for i in range(2):
        hashes.append(simhash.xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42))
    assert simhash.fingerprint(b"A  b\nC d", 3) == hashes[0] & hashes[1]


def test_hamming_tree_against_all_pairs():
    rng = np.random.default_rng(2)
    codes = np.unique(rng.integers(0, 1 << 12, 700, dtype=np.uint64))
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    found = {(int(a), int(b)) for w, leaf in simhash.HammingTree(codes, codes).search(codes, 2) for a, b in zip(w, leaf)}
    assert found == {(i, j) for i in range(len(codes)) for j in range(len(codes)) if int(codes[i] ^ codes[j]).bit_count() <= 2}


def test_near_dedup_keeps_one_of_each_group(docs, rows, nothing):
    sets = [frozenset(simhash.shingle_hashes((r[1] or "").encode(), 5).tolist()) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] == sets[j] or both and both >= 0.8 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    want = Counter()
    for g in {find(i) for i in range(len(rows))}:
        want[min((rows[i][0] is None, rows[i][0] or 0, rows[i][0]) for i in range(len(rows)) if find(i) == g)[2]] += 1
    assert Counter(r.doc_id for r in kept.collect()) == want
    assert keep_one(nothing).count() == 0


def test_near_duplicates_within_a_shared_passage(spark):
    """Pairs of like texts among many that share a long passage with them and are no near duplicates."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    passage, bodies = [word() for _ in range(150)], []
    for i in range(120):
        own = [word() for _ in range(50)]
        bodies.append(" ".join(passage + own))
        if i % 4 == 0:
            own[25] = "changed"
            bodies.append(" ".join(passage + own))
    frame = spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text string").repartition(4)
    found = {r.id: r.component for r in simhash.near_duplicates(frame).collect()}
    sets = [set(simhash.shingle_hashes(b.encode(), 5).tolist()) for b in bodies]
    linked = {(i, j) for i in range(len(sets)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    assert linked and {(i, j) for i in found for j in found if j < i and found[i] == found[j]} == linked


def test_near_duplicates_leave_out_no_pair_of_a_large_family(spark):
    """Pairs over the threshold in a family whose other pairs are just below it: samples meet heads, not partners."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    passage, bodies = [word() for _ in range(172)], []
    for i in range(300):
        own = [word() for _ in range(28)]
        bodies.append(" ".join(passage + own))
        if i % 3 == 0:
            bodies.append(" ".join(passage + own[:14] + [word() for _ in range(14)]))
    frame = spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text string").repartition(4)
    found = {r.id: r.component for r in simhash.near_duplicates(frame).collect()}
    sets = [set(simhash.shingle_hashes(b.encode(), 5).tolist()) for b in bodies]
    linked = {(i, j) for i in range(len(sets)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    assert len(linked) == 100 and {(i, j) for i in found for j in found if j < i and found[i] == found[j]} == linked


def test_near_duplicates_check_few_pairs_of_a_dense_group(spark, monkeypatch):
    rng, checked, saved = random.Random(11), [], simhash.saved

    def counted(df, label):
        out = saved(df, label)
        if label in ("candidates", "rest"):
            checked.append(out.count())
        return out

    monkeypatch.setattr(simhash, "saved", counted)
    base = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(150)]
    bodies = [" ".join(base)]
    for i in range(200):
        bodies.append(" ".join(base[:20 + i % 110] + [f"x{i}"] + base[21 + i % 110:]))
    frame = spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text string").repartition(4)
    found = simhash.near_duplicates(frame).collect()
    assert len(found) == 201 and len({r.component for r in found}) == 1
    assert sum(checked) <= 12 * len(bodies)


@pytest.mark.parametrize("counted, common, compared", [(16, 1 << 18, 1 << 17), (1, 1 << 18, 7), (1, 40, 1000)])
def test_prefix_pairs_against_all_pairs(spark, monkeypatch, counted, common, compared):
    monkeypatch.setattr(simhash, "COUNTED", counted)
    monkeypatch.setattr(simhash, "MOST_COMMON", common)
    monkeypatch.setattr(simhash, "COMPARED", compared)
    rng, bodies = random.Random(8), [b"", b"a", b"A b", b"a b c d", b"a b c d e"]
    for _ in range(50):
        words = [rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(rng.randint(5, 60))]
        for _ in range(3):
            bodies.append(" ".join(words).encode())
            words[rng.randrange(len(words))] = rng.choice("xyz")
            words = words[:rng.randint(len(words) - 2, len(words))]
    bodies += bodies[:20]
    sets = {simhash.word_key(b): set(simhash.shingle_hashes(b, 5).tolist()) for b in bodies}
    texts = spark.createDataFrame([(bytearray(b),) for b in bodies], "text binary").repartition(3)
    keys = sorted(sets)
    roots = {k: keys[i - i % 2] for i, k in enumerate(keys) if i % 10 < 2}
    frame = spark.createDataFrame(list(roots.items()), "node long, root long")
    for share in (simhash.Fraction(4, 5), simhash.Fraction(1, 2), simhash.Fraction(1)):
        got = [tuple(r) for r in simhash.prefix_pairs(texts, frame, share).collect()]
        want = {(a, b) for a in keys for b in keys if a < b and roots.get(a, a) != roots.get(b, b) and sets[a] & sets[b]
                and len(sets[a] & sets[b]) >= share * len(sets[a] | sets[b])}
        assert len(got) == len(set(got)) and want <= set(got)
        assert all(a < b and roots.get(a, a) != roots.get(b, b) for a, b in got)


def test_parity_bits_never_differ_in_more_than_the_sets():
    rng = np.random.default_rng(4)
    for _ in range(300):
        pool = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
        one, two = (np.unique(rng.choice(pool, int(rng.integers(0, 2000)))) for _ in range(2))
        apart = len(np.setxor1d(one, two))
        assert simhash.parity_distance(simhash.parity_bits(one), simhash.parity_bits(two)) <= apart
    assert simhash.parity_distance(simhash.parity_bits(one), simhash.parity_bits(one)) == 0


def test_a_worker_drops_what_other_stages_kept(monkeypatch):
    made, stage = [], [1]
    monkeypatch.setattr(common, "_KEPT", {})
    monkeypatch.setattr(common.TaskContext, "get", classmethod(lambda cls: SimpleNamespace(stageId=lambda: stage[0])))
    make = lambda: made.append(1) or len(made)
    task = common.given_back(lambda batches: iter([len(common._KEPT)]))
    assert [common.kept("a", make), common.kept("a", make), *task(iter([]))] == [1, 1, 1]
    stage[0] = 2
    assert list(task(iter([]))) == [0] and common.kept("a", make) == 2


def test_exact_topk(spark):
    rng = np.random.default_rng(3)
    vectors = [(i, [float(x) for x in rng.normal(size=6) * rng.choice([0.1, 1, 5])]) for i in range(70)]
    vectors += [(i, vectors[3][1]) for i in range(70, 110)] + [(5, vectors[5][1]), (40, [1.0]), (60, [])]
    bad = [(200, None), (201, [1.0, None]), (220, [float("nan")] * 6), (240, [float("inf")]), (None, [1.0] * 6)]
    df = spark.createDataFrame([(*v, 1.0) for v in vectors + bad], "vec_id long, embedding array<float>, score double").repartition(4)
    ints = [[int(np.floor(64.0 * float(np.float32(x)))) for x in v] + [0] * (6 - len(v)) for _, v in vectors]
    want = Counter()
    for a, (i, _) in enumerate(vectors):
        if i % 20 == 0:
            best = sorted((-sum(x * y for x, y in zip(ints[a], ints[b])), j) for b, (j, _) in enumerate(vectors) if b != a)[:20]
            want.update((i, r + 1, j, -s) for r, (s, j) in enumerate(best))
    assert Counter(map(tuple, exact_topk(df, F.col("vec_id") % 20 == 0).collect())) == want
    few = exact_topk(df.where("vec_id in (0, 1, 2)").limit(3), F.col("vec_id") % 20 == 0)
    assert few.count() == 2
    huge = spark.createDataFrame([(0, [1e30]), (1, [1e30]), (2, [-1e30])], "vec_id long, embedding array<float>")
    assert [r.score for r in exact_topk(huge, F.col("vec_id") == 0).collect()] == [(1 << 63) - 1, -(1 << 63)]
    assert exact_topk(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_packing_covers_every_id_once(docs, rows, nothing):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    pieces = packing.pack_documents(docs, tokenizer_path(), with_ids=True).collect()
    sequences = defaultdict(list)
    for p in pieces:
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length
        sequences[p.sequence_id].append(p)
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024 and at & (at - 1) == 0
    want, got = Counter(), Counter()
    for doc_id, text, *_ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        want[doc_id] += len(ids)
    for p in pieces:
        got[p.doc_id] += p.length
    assert got == want
    single = [r for r in rows if r[0] is not None and Counter(x[0] for x in rows)[r[0]] == 1]
    by = defaultdict(list)
    for p in pieces:
        by[p.doc_id].append(p)
    for doc_id, text, *_ in single:
        whole = b"".join(p.ids for p in sorted(by[doc_id], key=lambda p: p.start))
        assert whole == b"".join(i.to_bytes(4, "little") for i in tokenizer.encode(text or "", add_special_tokens=False).ids + [0])
    assert packing.pack_documents(nothing, tokenizer_path()).count() == 0


def test_encoder_equals_tokenizer_on_odd_white_space():
    from tokenizers import Tokenizer

    tokenizer, coder = Tokenizer.from_file(tokenizer_path()), packing.Encoder(tokenizer_path())
    rng = random.Random(9)
    for _ in range(600):
        text = "".join(rng.choice([" ", " ", "\n", "\t", "a", "Bc", "é", "1", "!", "'s", " ", "　", "日", "<|endoftext|>", "\x1c", "  "]) for _ in range(rng.randint(0, 14)))
        assert coder.ids(text) == b"".join(i.to_bytes(4, "little") for i in tokenizer.encode(text, add_special_tokens=False).ids), repr(text)


def test_mixing(docs, rows, nothing, monkeypatch):
    got = mix(docs).collect()
    sizes = defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    capped, total = set(), sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[t] for t in order if t not in capped) for s in order if s not in capped}
        over = {s for s in share if share[s] > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    taken = Counter()
    for r in got:
        assert r.target == pytest.approx(share.get(r.source, 3.0 * sizes[r.source])) and r.source_size == sizes[r.source]
        assert 0 <= r.copies <= 3
        taken[r.source] += r.taken
    biggest = Counter()
    for r in got:
        biggest[r.source] = max(biggest[r.source], r.size)
    assert len(got) == len(rows)
    assert all(abs(taken[r.source] - r.target) <= biggest[r.source] / 2 + 1 for r in got)
    assert Counter(map(tuple, mix(docs.repartition(3)).collect())) == Counter(map(tuple, got))
    whole = mixed(docs)
    assert whole.columns == docs.columns and whole.count() == sum(r.copies for r in got)
    assert mix(nothing).count() == 0 and mixed(nothing).count() == 0
    monkeypatch.setattr("tidewright.llm.mixing.CHUNK", 4)  # three levels of the tree
    monkeypatch.setattr("tidewright.llm.mixing.FAN", 2)
    again = Counter()
    for r in mix(docs).collect():
        again[r.source] += r.taken
    assert all(abs(again[r.source] - r.target) <= biggest[r.source] for r in got)


def labelled(spark, n=400):
    rng = random.Random(4)
    words = ["".join(rng.choice("aeioustrn") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        toxic, bad = i % 4 == 0, i % 3 == 0
        lines = []
        for _ in range(rng.randint(1, 5)):
            line = [rng.choice(words) for _ in range(rng.randint(5, 25))]
            if toxic:
                line[rng.randrange(len(line))] = rng.choice(["zqfool", "zqscum", "zqvile"])
            text = " ".join(line).capitalize() + "."
            lines.append(text.upper().replace(" ", "!! ") if bad else text)
        rows.append((i, "\n".join(lines)))
        labels.append((i, int(not bad), int(toxic)))
    rows += [(n, None), (n + 1, ""), (n + 1, ""), (None, "words"), (n + 2, "\n\n  \n"), (n + 3, "x " * 60_000)]
    docs = spark.createDataFrame([(*r, 9.0, 1) for r in rows], "doc_id long, text string, score double, id long")
    return docs, spark.createDataFrame(labels + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int"), {x[0]: x for x in labels}


@pytest.mark.parametrize("operator,column,at", [(toxicity, 2, 0.5), (line_quality.line_quality, 1, 0.7)])
def test_classifiers_on_held_out_rows(spark, operator, column, at):
    docs, labels, truth = labelled(spark)
    out = operator(docs, labels, ~held_out("doc_id", 5, 0)).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    tested = [(r.score >= at) == truth[r.doc_id][column] for r in out if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(tested) > 50 and np.mean(tested) > 0.95
    empty = operator(docs, labels.limit(0), ~held_out("doc_id", 5, 0)).collect()
    assert len({r.score for r in empty}) == 1
    assert operator(docs.limit(0), labels, ~held_out("doc_id", 5, 0)).count() == 0


def test_chain_marginals_against_enumeration():
    rng = np.random.default_rng(6)
    scores, turn = rng.normal(size=(9, 2)), rng.normal(size=(2, 2))
    of = np.array([0] * 5 + [1] * 3 + [2])
    got = line_quality.marginals(scores, turn, of)
    for d in range(3):
        at = np.flatnonzero(of == d)
        total, good = 0.0, np.zeros(len(at))
        for code in range(2 ** len(at)):
            path = [(code >> i) & 1 for i in range(len(at))]
            weight = np.exp(sum(scores[at[i], s] for i, s in enumerate(path)) + sum(turn[a, b] for a, b in zip(path, path[1:])))
            total += weight
            good += weight * np.array(path)
        assert got[at] == pytest.approx(good / total)


def test_page_text(spark):
    side = '<nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="box7"><span>Call us now</span></div>'
    page = ("<!DOCTYPE html><html><head><title>T</title><script>var a='</p>';</script></head><body>" + side
            + "<div id=content><h1>Head &amp; tail {i}</h1><p>First\n  line {i} <b>bold<br><p>Second &eacute;{i}<div class='comments'><p>nice</p></div>"
            + "<form><p>ask</p></form></div><footer>&copy; us</footer></body></html>")
    rows = [(i, "http://Host.example:80/x", page.replace("{i}", str(i))) for i in range(12)]
    rows += [(20, None, None), (21, "u", ""), (22, "u", "<p>open <i>tag"), (23, "u", "plain &lt;text&gt;  here"), (24, "u", "<article><p>A</p><p>A</p></article>out"),
             (None, None, "< <<>> </div><p"), (22, "u", "<p>open <i>tag")]
    got = page_text.page_text(spark.createDataFrame([(*r, 1, "z") for r in rows], "page_id long, url string, html string, host long, parts string")).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert by[3].text == "Head & tail 3\n\nFirst line 3 bold\n\nSecond é3"
    assert by[20].text == by[21].text == "" and by[22].text == "open tag"
    assert by[23].text == "plain <text> here" and by[24].text == "A\n\nA"
    assert page_text.page_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_secret_scan(docs, rows, nothing, spark):
    key = "AKIA" + "Q7" * 8
    odd = [(900, f'é password = "hunter22" {key} {"0af" * 9} passphrase is kX9$vLq2!mZr7', "en", "a"), (901, 'token:short api_key=x secret : "abcdef"', "en", "a"),
           (902, "AKIASHORT " + "a" * 23 + " my login wonderful", "en", "a")]
    df = docs.unionByName(spark.createDataFrame([(*r, 0, 7, 8, 0.5) for r in odd], SCHEMA))
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in guess_cost.secret_scan(df).collect() if r.doc_id}
    text = odd[0][1]
    at = lambda kind, part: (kind, text.index(part), text.index(part) + len(part))
    assert got[900] == [at("assign", 'password = "hunter22'), at("access", key), at("hex", "0af" * 9), at("guess", "kX9$vLq2!mZr7")]
    assert [s[0] for s in got[901]] == ["assign"] and got[902] == []
    assert got[1] == [] and guess_cost.secret_scan(nothing).count() == 0


def test_guess_cost_prefers_cheap_segments():
    ranks = {"summer": 5, "password": 0}
    cost = lambda v: guess_cost.guess_cost(v, ranks)
    assert cost("summer2020") < 4 and cost("P4ssword") < 3 and cost("qwertyuiop") < 4 and cost("abcabcabcabc") < 6
    assert cost("kX9$vLq2!mZr7") > 12 and cost("0af3b29c77de41aa") > 12 and cost("aaaaaaaa") < 3 and cost("19841231") < 6


def test_guess_cost_of_very_long_values():
    from tidewright.llm.guess_cost import guess_cost

    assert guess_cost("a" * 20_000, {}) < 7
    assert guess_cost("qw" * 10_000, {}) < 7
    assert guess_cost("abcdefgh" * 2_000, {}) < 16
    assert guess_cost("x9Kq7ZpL2vTe", {}) > 10


def test_pages_of_a_busy_host_lose_their_template(spark):
    from tidewright.llm.page_text import page_text

    rows = [(i, f"http://{'busy' if i % 3 else f'h{i}'}.org/{i}", f"<body><div>Shared strip</div><p>Text {i}</p></body>") for i in range(90)]
    found = {r.page_id: r.text for r in page_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {i: f"Text {i}" if i % 3 else f"Shared strip\n\nText {i}" for i in range(90)}


def test_recurring_containers_inside_articles_go(spark):
    """A strip of text blocks inside the article, on a busy and on a small host; a quoted paragraph and copies of a page stay."""
    strip = "<div class='x7'><p>Read also our other pieces</p></div>"
    body = "<article><h1>Title {i}</h1><p>Text of number {i}, long enough to outweigh the strip</p>{x}</article>"
    rows = [(i, f"http://busy.org/{i}", body.format(i=i, x=strip if i % 11 == 0 else "<p>Quoted by all</p>")) for i in range(200)]
    rows += [(1000 + i, f"http://small.org/{i}", body.format(i=i, x=strip)) for i in range(4)]
    rows += [(2000 + i, f"http://copies.org/{i}", "<article><div><p>The one text</p><p>in copies</p></div></article>") for i in range(20)]
    rows += [(3000 + i, f"http://plain.org/{i}", f"<body><div><p>Text of number {i}, long enough</p></div>{'<div><p>Notice</p></div>' if i % 11 == 0 else ''}</body>") for i in range(200)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    found = {r.page_id: r.text for r in page_text.page_text(frame).collect()}
    text = lambda i: f"Title {i}\n\nText of number {i}, long enough to outweigh the strip"
    want = {i: text(i) + ("" if i % 11 == 0 else "\n\nQuoted by all") for i in range(200)}
    want |= {1000 + i: text(i) for i in range(4)} | {2000 + i: "The one text\n\nin copies" for i in range(20)}
    assert found == want | {3000 + i: f"Text of number {i}, long enough" for i in range(200)}


def test_values_of_letters_and_values_behind_other_credential_words():
    ranks = {w: i for i, w in enumerate(("wonderful", "credentials", "password", "token", "authorization", "understanding"))}
    found = lambda text: [text[s:e] for s, e, _ in guess_cost.scan(text, ranks)[1]]
    key, letters = "kX9$vLq2!mZr7", "qzxvkwjhbpdlmnrt"
    for text in (f"passphrase: {letters}", f"bearer {letters}", f"pwd = {letters}", f"the pin is {letters.capitalize()}"):
        assert [v.lower() for v in found(text)] == [letters], text
    for text in (f"login password: {key}", f"auth token: {key}", f"login password {key}", f"pwd          =          {key}",
                 f"auth token={key} and no more", f"bearer is   credentials => '{key}'"):
        assert found(text) == [key], text
    assert found("pwd = pin=kX9$vLq2") == ["kX9$vLq2"] and found("pwd: pin=kX9$!") == ["pin=kX9$!"]
    for text in ("login wonderful.", "bearer understanding", "password: wonderful", "token authorization: wonderful", "a login Zugangsdat "):
        assert found(text) == [], text
    assert len(found("token=" * 50_000 + key)) == 1 and found("pwd" + " " * 200_000) == []


def test_packing_routes_remainders_to_tiers():
    sequences = packing.pack([300, 212] * 4 + [600, 424, 1100, 52])
    sizes = Counter(sum(p[2] for p in s) for s in sequences)
    assert sizes == {1024: 2, 512: 4, 128: 1} and all(len(s) <= 2 for s in sequences)
    assert sum(len(s) for s in sequences) == 13  # only the document of 1,100 is cut


def test_packing_balances_steps_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(packing, "STEP_TOKENS", 4096)
    rng = random.Random(8)
    made = [(i, " ".join(rng.choice(("one", "two", "three")) for _ in range(rng.randint(1, 900)))) for i in range(400)]
    frame = spark.createDataFrame(made, "doc_id long, text string").repartition(7)
    groups, tiers = defaultdict(int), defaultdict(set)
    for p in packing.pack_documents(frame, tokenizer_path()).collect():
        groups[p.tier, p.step_group] += p.length
        tiers[p.step_group].add(p.tier)
    assert all(len(t) == 1 for t in tiers.values()) and len({t for t, _ in groups}) > 4
    for tier in {t for t, _ in groups}:
        weights = [groups[k] for k in sorted(groups) if k[0] == tier]
        assert set(weights[:-1]) <= {4096} and weights[-1] <= 4096


def test_toxicity_model_keeps_rare_words_and_counts_other_stems(spark):
    from tidewright.llm import toxicity as module

    texts = [(0, b"alpha beta alpha beta alpha beta"), (1, b"alpha zqonce beta"), (2, b"unlabelled other words words")]
    frame = spark.createDataFrame(texts, "id long, text binary")
    models = module.fit(frame, spark.createDataFrame([(0, 0), (1, 1)], "id long, y int"))
    words = module.Tokens([b"alpha beta zqonce"]).words()
    assert set(words) | {0} == set(models.words.tolist())  # zqonce has one left neighbour
    at = module.lookup(models.words, words)
    assert models.total[at].min(axis=0).tolist() == [0, 0] and (models.total[at].sum(axis=1) > 0).tolist() == [True, True, True]
    assert models.total[module.lookup(models.words, np.zeros(1, np.uint64))].tolist() == [[1, 1]]
    # Sampled stems: alph 4, beta 4, zqon 1, plus one each; other stems: 3 with 4 words, plus one each, plus one unseen.
    back = 0.75 * np.array([2, 3]) / np.array([3, 3])
    assert models.p_new[-1] == pytest.approx(back * (4 + 3 + 1) / 4 / (9 + 3 + 4 + 3 + 1))


@pytest.mark.parametrize("broken", ["<a ", "<b>", "<div>", "<!", "<a<a", "<p>", '<a "', "</x>", "<li><p>", "<!--", "<script>"])
def test_broken_pages_take_linear_time(broken):
    page = broken * (1_000_000 // len(broken)) + '">'
    started = time.monotonic()
    page_text.main_text(page)
    assert time.monotonic() - started < 30


def test_broken_markup_reads_as_before():
    for html, tree in (("<a title='x>y'>t</a>u", [("a", ["t"]), "u"]), ("<a <b>t", [("a", ["t"])]), ("<p>a<p>b", [("p", ["a"]), ("p", ["b"])]),
                       ("<ul><li>a<b>c<li>d</ul>e", [("ul", [("li", ["a", ("b", ["c"])]), ("li", ["d"])]), "e"]),
                       ("x < y <1> </i>z", ["x ", "<", " y ", "<", "1> ", "z"]), ("<b>a<div>c</b>d</div>e", [("b", ["a", ("div", ["c", "d"]), "e"])])):
        def plain(node):
            return [p if isinstance(p, str) else (p.tag, plain(p)) for p in node.parts]

        assert plain(page_text.parse(html)) == tree


@pytest.mark.parametrize("stage", [keep_first, keep_one, mixed])
def test_stages_leave_columns_that_clash_with_their_own_names(stage, docs):
    names = ("_key", "_KEPT", "_of", "_keep_id", "_keep_key", "_own", "_as", "_hash", "_id", "_times", "_copy")
    marked = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    out = stage(marked)
    assert out.columns == marked.columns
    rows = out.where("doc_id is not null").collect()
    assert rows and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names)
    assert sorted(map(str, out.select(*docs.columns).collect())) == sorted(map(str, stage(docs).collect()))
