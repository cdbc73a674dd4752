import hashlib
import math
import zlib
from collections import Counter, defaultdict

from pulsemill.llm import histogram_sort as H
from pulsemill.llm import mixing as M
from tests.llm.data import documents, frame, prose, spaced

LABELS = "doc_id long, quality int, toxic int"


def many():
    rows = documents() + [(100 + i, prose(20 + i % 70, i), "en", f"s{i % 5}", 0) for i in range(400)]
    return rows + [(1000 + i, prose(50, 1), "en", "s0", 0) for i in range(200)]  # a third are copies


def check_shards(rows, found, n_shards, tolerance):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    slots, sizes = defaultdict(list), Counter()
    for r in found:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    total, largest = sum(sizes.values()), max(r.size for r in found)
    below = 0
    for j in range(1, n_shards):
        below += sizes[j - 1]
        assert abs(below - total * j / n_shards) <= max(tolerance * total / n_shards, largest)


def test_shards(spark):
    rows = many()
    for n in (1, 3, 8, 40):
        check_shards(rows, H.shard_rows(frame(spark, rows), n).collect(), n, H.TOLERANCE)


def test_equal_rows_are_divided(spark):
    """A third of all bytes are rows that nothing tells apart."""
    rows = [(None, prose(20, 1), None, None, 0)] * 200 + [(i, prose(20, 50 + i), None, None, 0) for i in range(400)]
    found = H.shard_rows(frame(spark, rows), 40).collect()
    check_shards(rows, found, 40, H.TOLERANCE)
    sizes = Counter()
    for r in found:
        sizes[r.shard] += r.size
    assert max(sizes.values()) <= 1.2 * min(sizes.values())


def test_key_order_and_groups(spark):
    rows = [(i, prose(40, i % 150), "en", "s", 0) for i in range(600)]  # groups of 4 equal texts
    found = H.sharded_documents(frame(spark, rows), 4, 0.05).select("text", "shard", "slot").collect()
    assert len({(r.text, r.shard) for r in found}) == 150
    order = [r.text for r in sorted(found, key=lambda r: (r.shard, r.slot))]
    assert all(len({i for i, t in enumerate(order) if t == x}) == 4
               and max(i for i, t in enumerate(order) if t == x) - order.index(x) == 3 for x in set(order))


def test_documents_keep_their_columns(spark):
    result = H.sharded_documents(frame(spark), 3)
    assert {"doc_id", "text", "shard", "slot", "size", "node"} <= set(result.columns)
    rows = result.collect()  # theirs of these names are replaced, others kept
    assert len(rows) == 20 and all(r.shard in range(3) and r.slot >= 0 and r["size"] >= 16 for r in rows)
    assert all(r.first == r.major == r.node == "theirs" for r in rows)
    assert H.shard_rows(frame(spark, []), 3).count() == 0


def test_extreme_and_equal_keys(spark):
    low, high = -(1 << 63), (1 << 63) - 1
    keys = [(low, low, 5), (low, low, 5), (high, high, 5), (high, high, 5), (0, 0, 5), (-1, 7, 5), (3, high, 5)]
    df = spark.createDataFrame(keys, "major long, minor long, size long")
    for n in (2, 3, 7):
        bounds = H.splitters(df, n)
        assert bounds == sorted(bounds) and len(bounds) == n - 1
        assert H.sharded(df, n).count() == 7


def brute_mix(rows, weights):
    sizes = Counter()
    docs = []
    for i, t, _, source, _ in rows:
        key = hashlib.md5(f"{'' if i is None else i}|{t or ''}{M.SEED}".encode()).hexdigest()
        u = (int(key[:13], 16) + 0.5) / (1 << 52)
        docs.append((source, -math.log(u) / weights.get(i, 1.0), -1 if i is None else i, len(spaced(t)), t))
        sizes[source] += docs[-1][3]
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: M.SOURCE_WEIGHTS[k % 3] for k, s in enumerate(names)}
    total = sum(sizes.values())
    full: set = set()
    while True:
        level = (total - sum(3 * sizes[s] for s in full)) / max(sum(w[s] for s in names if s not in full), 1)
        more = {s for s in names if s not in full and level * w[s] > 3 * sizes[s]}
        if not more:
            break
        full |= more
    target = {s: 3 * sizes[s] if s in full else level * w[s] for s in names}
    out = []
    for s in names:
        epochs = int(target[s] // sizes[s]) if sizes[s] else 0
        rest, before = target[s] - epochs * sizes[s], 0
        for d in sorted((d for d in docs if d[0] == s), key=lambda d: (d[1], d[2])):
            n = epochs + (d[3] > 0 and 2 * before + d[3] <= 2 * rest)
            before += d[3]
            out.append((None if d[2] < 0 else d[2], d[3], sizes[s], round(target[s], 6), n * d[3]))
    return sorted(out, key=str)


def test_mix_equals_brute_force(spark):
    rows = many() + [(5000, "tiny", "en", "zz", 0), (5001, "", "en", "empty", 0), (5002, None, "en", "empty", 0)]
    labels = [(100 + i, i % 2, 0) for i in range(0, 400, 3)] + [(100, 1, 1), (None, 1, 0), (103, None, None)]
    grouped = defaultdict(list)
    for i, q, t in labels:
        if i is not None:
            grouped[i].append((1 if q is None else q) > 0 and not t)
    weights = {i: M.GOOD if all(x) else M.POOR for i, x in grouped.items()}
    found = M.mixed(frame(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    assert sorted(((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in found),
                  key=str) == brute_mix(rows, weights)
    taken, target, largest = Counter(), {}, max(r["size"] for r in found)
    for r in found:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 3 * r["size"]
    assert all(abs(taken[s] - target[s]) <= largest for s in target)


def test_mix_of_nothing(spark):
    labels = spark.createDataFrame([], LABELS)
    assert M.mixed(frame(spark, []), labels).count() == 0
    rows = [(1, None, None, "a", 0), (2, "", None, None, 0)]
    assert [r.taken for r in M.mixed(frame(spark, rows), labels).collect()] == [0, 0]


def test_sources_that_reach_their_bound_at_one_level(spark):
    """Both stop at 180 a weight, the level is 60: the first of them decides."""
    rows = spark.createDataFrame([("=a", "a", 300), ("=b", "b", 120)], "name string, source string, source_size long")
    assert {r.source: r.target for r in M.targets(rows).collect()} == {"a": 300.0, "b": 120.0}
