"""Conversation repair, MinHash and centroid clustering against brute force, and on odd tables."""

from __future__ import annotations

import hashlib
import heapq
import math
import re
import zlib

import numpy as np
import pytest

from veloflow.llm import clustering, minhash, repair, secrets

SF = "/root/testdata/sf0.001"

# 11 conversation repair


def brute_repair(rows):
    """Least cost, then least letters, by always taking up the least (cost, letters) of all beginnings: Dijkstra's way."""
    role_of = {"u": "user", "a": "assistant"}
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, letters, i, last, kept = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            return cost, letters, "\n".join(f"{r}:{t}" for r, t in kept)
        if (i, last) in done:
            continue
        done.add((i, last))
        for initial in "ua":
            if (last, initial) in step:
                heapq.heappush(heap, (cost + 2, letters + "I", i, initial, (*kept, (role_of[initial], ""))))
        if i == len(rows):
            continue
        role, text, fault = rows[i]
        heapq.heappush(heap, (cost + 3, letters + "D", i + 1, last, kept))
        if fault in ("blank", "duplicate"):
            continue
        more = int(fault == "truncated")
        if (last, role[:1]) in step:
            heapq.heappush(heap, (cost + more, letters + "K", i + 1, role[:1], (*kept, (role, text))))
        for initial in "ua":
            if (last, initial) in step:
                heapq.heappush(heap, (cost + 2 + more, letters + "R", i + 1, initial, (*kept, (role_of[initial], text))))


def brute_conversations(rows):
    talks = {}
    for conv, turn, role, text in rows:
        mine = talks.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        case = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if case == 0:
            continue
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        mine += [(turn, "user" if case == 4 else role, text)] * (2 if case == 3 else 1)
    for conv, mine in talks.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        faults, seen = [], set()
        for _, role, text in mine:
            core = re.sub(r"[\x20\x09-\x0D]+$", "", text)
            faults.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = {t for t, _, _ in mine if t is not None}
        cost, letters, text = brute_repair([(r, t, f) for (_, r, t), f in zip(mine, faults)])
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        gaps = min(max(turns) - min(turns) + 1 - len(turns), (1 << 63) - 1) if turns else 0
        yield (conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, letters, hashlib.sha256(text.encode()).hexdigest())


@pytest.mark.parametrize("stretch", [1, 3, 64])
def test_cheapest_edits(monkeypatch, stretch):
    monkeypatch.setattr(repair, "STRETCH", stretch)
    rng = np.random.default_rng(stretch)
    for _ in range(400):
        rows = [("suax"[rng.choice(4, p=[0.15, 0.4, 0.35, 0.1])], "t", ["", "truncated", "blank"][rng.choice(3, p=[0.6, 0.2, 0.2])]) for _ in range(rng.integers(0, 12))]
        codes = bytes(repair.BAD if f == "blank" else repair.INITIALS.get(r, repair.OTHER) | (repair.TRUNCATED if f else 0) for r, _, f in rows)
        assert repair.cheapest(codes) == brute_repair(rows)[:2], rows


def test_prices_are_distances_and_no_arc_is_overbid():
    rng = np.random.default_rng(1)
    for _ in range(50):
        codes = bytes(rng.choice([0, 1, 2, 3, 4, 5, 6, 7, 8], rng.integers(0, 30)).tolist())
        out, prices = repair.solved(codes, (0, repair.FAR, repair.FAR, 0))
        assert all(prices[at] <= cost + prices[to] for at, ways in enumerate(out) for _, cost, to in ways)


def test_long_conversation_takes_linear_time():
    cost, letters = repair.cheapest(bytes([1, 1, 8, 2, 5]) * 20_000)
    assert len(letters) >= 100_000 and cost > 60_000


@pytest.fixture(scope="module")
def odd_talks(spark):
    rows = [
        (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes!"), (1, 1, "assistant", "Yes!"), (2, None, "system", "Be kind."), (2, None, None, None), (2, 5, "tool", "x"), (2, 9, "user", "a\tb?\n "),
        (None, 0, "user", "q?"), (None, None, None, None), (None, 3, "assistant", ""), (3, 1, "", "no role."), (4, -(1 << 63), "user", "low."), (4, (1 << 63) - 1, "assistant", "high."),
        (5, 2, "user", "long " * 50_000), (5, 3, "assistant", " \n"), *((6, t, "uaus"[t % 4].replace("u", "user").replace("s", "system") if t % 4 != 1 else "assistant", f"t{t // 3}.") for t in range(200)),
    ]
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, audit string, rank int")


@pytest.mark.parametrize("which", ["table", "odd"])
def test_repair(spark, odd_talks, which):
    talks = odd_talks if which == "odd" else spark.read.parquet(f"{SF}/conversations.parquet")
    want = brute_conversations([(r.conv_id, r.turn, r.role, r.text) for r in talks.collect()])
    got = repair.repair(talks).collect()
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_repair_nothing(spark, odd_talks):
    assert repair.repair(odd_talks.limit(0)).count() == 0
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = repair.repair(spark.createDataFrame([(lost, 0, "user", "gone.")], "conv_id long, turn long, role string, text string")).collect()
    assert [tuple(r) for r in got] == [(lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


# 12 MinHash


def word_sets(rows, width=4):
    words = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) for _, t in rows]
    return [{tuple(w[i : i + width]) for i in range(max(len(w) - width + 1, 1))} if w else set() for w in words]


def brute_min_hash(rows, width=4):
    sets = word_sets(rows, width)
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 100 * len(a & b) >= 80 * len(a | b):
                root[top(i)] = top(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[top(i)] = min(k, least.get(top(i), k))
    return [(k, len(s), least.get(top(i)), k == least.get(top(i))) for i, ((k, _), s) in enumerate(zip(rows, sets))]


def found(df):
    null_last = lambda r: tuple((v is None, v or 0) for v in r)
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=null_last)


def wanted(rows):
    return sorted(brute_min_hash(rows), key=lambda r: tuple((v is None, v or 0) for v in r))


def test_min_hash_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert found(minhash.min_hash_duplicates(docs)) == wanted([(r.doc_id, r.text or "") for r in docs.collect()])


@pytest.mark.parametrize("block", [1 << 18, 200])
def test_min_hash_chains_and_groups(spark, monkeypatch, block):
    """Copies with edits around one text, many of them between 0.6 and 0.9 similar, in one bucket or in parts of it."""
    monkeypatch.setattr(minhash.similar_links, "__defaults__", (None, block))
    rng = np.random.default_rng(7)
    rows = []
    for d in range(6):
        base = [f"w{d}x{i}" for i in range([5, 40, 60, 80, 100, 120][d])]
        for copy in range(40):
            now = list(base)
            for at in rng.integers(0, len(now), rng.integers(0, max(2, len(now) // 12))):
                now[at] = f"e{rng.integers(0, 9)}"
            rows.append((d * 100 + copy, " ".join(now)))
    rows += [(1000 + i, " ".join(f"c{j}" for j in range(3 * i, 3 * i + 60))) for i in range(20)]  # a chain: only neighbours are similar
    assert found(minhash.min_hash_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == wanted(rows)


def test_min_hash_odd(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, "A b C d e"), (2, "a B c D e"), (3, None), (4, ""), (5, " \t\n"), (None, "a b c d e"), (None, None), (7, long), (8, long + " end"), (9, "x"), (9, "x"), (9, "other words here now"), (10, "Ä b"), (11, "ä b"), (12, "a\xa0b c")]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, mark string, component_id int")
    assert found(minhash.min_hash_duplicates(df)) == wanted([(k, t or "") for k, t in rows])
    assert minhash.min_hash_duplicates(df.limit(0)).count() == 0


def test_sketches_agree_as_sets_do():
    """In a bin with the probability of the similarity, also for sets far smaller than the sketch."""
    rng = np.random.default_rng(2)
    for both, own in ((4, 1), (40, 10), (400, 100)):
        agreed = []
        for _ in range(300):
            x = rng.integers(0, 1 << 63, both + own, np.int64).astype(np.uint64) * np.uint64(2)
            agreed.append((minhash.sketch(np.sort(x)) == minhash.sketch(np.sort(x[:both]))).mean())
        assert abs(np.mean(agreed) - both / (both + own)) < 0.02


# 13 clustering


def brute_clusters(rows, count=16, rounds=3):
    kept = [(k, [math.floor(64 * float(x)) for x in v]) for k, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) and abs(math.floor(64 * x)) < 1 << 27 for x in v)]
    centroids = [v for _, v in sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:count]]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    place = lambda: [min(range(len(centroids)), key=lambda c: (gap(v, centroids[c]), c)) for _, v in kept]
    for _ in range(rounds):
        at = place()
        mine = [[v for (_, v), a in zip(kept, at) if a == c] for c in range(len(centroids))]
        centroids = [[sum(xs) // len(m) for xs in zip(*m)] if m else centroids[c] for c, m in enumerate(mine)]
    at = place()
    far = [gap(v, centroids[a]) for (_, v), a in zip(kept, at)]
    within = [sum(d for d, a in zip(far, at) if a == c) for c in range(len(centroids))]
    return [(k, a, d, within[a], sum(far), hashlib.sha256(",".join(map(str, centroids[a])).encode()).hexdigest()) for (k, _), a, d in zip(kept, at, far)]


def vectors(df):
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_clusters_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert vectors(clustering.cluster(table)) == sorted(brute_clusters([(r.vec_id, r.embedding) for r in table.collect()]))


def test_clusters_odd(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-3, 4, 64).astype(float).tolist()) for i in range(30)]
    rows += [(100 + i, [float(i % 2)] * 64) for i in range(40)]  # ties and equal vectors
    rows += [(5, rows[5][1]), (5, rows[6][1]), (None, rows[7][1]), (200, None), (201, []), (202, [1.0] * 63), (203, [1.0] * 65), (204, [None] + [1.0] * 63), (205, [float("nan")] + [1.0] * 63)]
    rows += [(206, [float("inf")] + [1.0] * 63), (207, [1e30] * 64), (208, [2.0**20] * 64), (209, [-(2.0**20)] * 64), (210, [0.015] * 64), (211, [-0.015] * 64)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, cluster int, distance string")
    exact = [(k, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for k, v in rows]
    assert vectors(clustering.cluster(df)) == sorted(brute_clusters(exact), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("rows", [0, 1, 5])
def test_clusters_of_few(spark, rows):
    df = spark.createDataFrame([(i, [float(i)] * 64) for i in range(rows)], "vec_id long, embedding array<double>")
    assert vectors(clustering.cluster(df)) == sorted(brute_clusters([(r.vec_id, r.embedding) for r in df.collect()]))


def test_tournament_is_the_nearest():
    rng = np.random.default_rng(4)
    centroids, points = rng.integers(-5, 6, (16, 64)), rng.integers(-5, 6, (2000, 64))
    centroids[9] = centroids[3]
    far = ((points[:, None, :] - centroids[None]) ** 2).sum(2)
    assert (clustering.Tournament(centroids).nearest(points) == far.argmin(1)).all()


# 2 secret scans: constants that are handed on many times, and padded values


def test_constants_are_handed_on_in_linear_time():
    doubled = "token = 'q8Fh2kLm9'\n" + "token = token + token\n" * 10_000
    assert (9, 18, "literal") in secrets.spans(doubled) or any(s <= 9 and 18 <= e for s, e, _ in secrets.spans(doubled))
    chain = "a0 = 'Zx9#kQ2!vv'\n" + "".join(f"a{i} = a{i - 1}\n" for i in range(1, 5000)) + "client_secret_value = a4999\n"
    assert [chain[s:e] for s, e, k in secrets.spans(chain) if k == "literal"] == ["Zx9#kQ2!vv"]
    assert len(secrets.assignments(doubled)) == 10_001


@pytest.mark.parametrize("text", ["SECRET_KEY=YWJjZGVmZ2hpams=", "db_pwd=YWJjZGVmZ2hpams=", "x\ndb_pwd = YWJjZGVmZ2hpams==\ny"])
def test_padding_belongs_to_the_value(text):
    literal = text[text.index("YWJ") :].split("\n")[0]
    assert any(literal in text[s:e] for s, e, _ in secrets.spans(text)) and "YWJ" not in secrets.masked(text) and "[SECRET]" in secrets.masked(text)
