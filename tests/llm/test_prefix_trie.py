"""The conversation trie against a walk over the rebuilt conversations."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pulsemill.llm import prefix_trie as P
from pulsemill.llm.trie_sql import OP13_SQL
from pulsemill.session import temporary_conf
from tests.compare import _rows

SCHEMA = "conv_id long, turn long, role string, text string"


def by_hand(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs[conv].append((turn is not None, turn or 0, digest, role, text))
    turns = {c: [x[3:] for x in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        built[c] = tuple(turns.get(base, [])[:h] + own[h:])
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
    out = []
    for node, ids in members.items():
        d = len(node)
        below = [n for n in members if n[:d] == node]
        parents = {n[:-1] for n in members if n}
        ends = ",".join(str(c) for c in ids if len(built[c]) == d)
        out.append((
            ids[0], d, members[node[:-1]][0] if d else None, len(ids),
            sum(n[:-1] == node for n in below if len(n) == d + 1), sum(n not in parents for n in below),
            sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n),
            hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    ).collect()), key=str)


def recorded(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-12, 120), n):
        shared = rng.choice(["a", "b", "c"])
        for i in range(rng.choice([1, 2, 3, 9, 14])):
            text = f"{shared}{i}" if rng.random() < 0.85 else f"own {c} {i} é"
            rows.append((c, i, rng.choice(["user", "user", "user", None]), text))
    rows += [(7, None, "x", "first"), (7, None, None, None), (7, 3, "x", "tie"), (7, 3, "a", "tie"),
             (11, 2, "user", "again"), (11, 2, "user", "again"), (None, 1, "user", "nobody"), (200, 1, None, None)]
    rows += [(10_000 + 5 * i, 0, "user", "hello") for i in range(20)] + [(301, t, "user", "x" * t) for t in range(60)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_equals_the_walk(spark, seed):
    rows = recorded(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("digest", "slice", "depth", "h1", "bytes", "local", "place", "alone", "base", "n"):
        df = df.withColumn(name, F.lit("theirs"))
    assert got(P.trie(df)) == by_hand(rows)


def test_a_full_sketch_only_screens_less(spark, monkeypatch):
    monkeypatch.setattr(P, "LEAST_CELL_BITS", 4)
    monkeypatch.setattr(P, "MOST_CELL_BITS", 4)
    monkeypatch.setattr(P, "HOT_CHILDREN", 2)
    rows = recorded(5, 40)
    df = spark.createDataFrame(rows, SCHEMA)
    assert P.screened(P.prefixes(df)).where("alone").count() == 0
    assert got(P.trie(df)) == by_hand(rows)


def test_screening_proves_most_tails(spark):
    rows = [(i, t, "user", f"{i if t else 0}-{t}") for i in range(200) for t in range(12)]
    screened = P.screened(P.prefixes(spark.createDataFrame(rows, SCHEMA)))
    counts = screened.groupBy("depth", "h1", "h2").agg(
        F.count("*").alias("n"), F.max("alone").alias("alone")).groupBy("n", "alone").count().collect()
    found = {(r.n > 1, r.alone): 0 for r in counts}
    for r in counts:
        found[r.n > 1, r.alone] += r["count"]
    assert (True, True) not in found
    assert found[False, True] > 10 * found.get((False, False), 0)
    assert screened.where("top").count() == screened.where("alone").select("conv_id").distinct().count()


def test_a_long_conversation_is_cut(spark):
    """Half of all turns are one conversation's: several slices, the same digests."""
    rows = [(10_000, t, "user", f"t{t}") for t in range(3000)] + [(2 + i, 0, "user", "x") for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    with temporary_conf(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        ranked = P._ranked(P._narrow(df)).where("conv_id = 10000").collect()
        nodes = got(P.trie(df).where("conv_id = 10000 or depth = 0"))
    assert len({r.slice for r in ranked}) >= 3
    assert sorted(r.place for r in ranked) == list(range(1, 3001))
    assert len(nodes) == 3001
    assert [n[1] for n in nodes if n[4] == 0 and n[0] == 10_000] == [3000]


def test_empty_and_long(spark):
    assert P.trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert P.trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).count() == 0
    rows = [(0, 0, "user", "é" * 300_000), (6, 0, "user", ""), (0, 1, "user", "y")]
    assert got(P.trie(spark.createDataFrame(rows, SCHEMA))) == by_hand(rows)


def test_sql_twin(spark):
    import duckdb

    rows = recorded(9, 30)
    con = duckdb.connect()
    frame = spark.createDataFrame(rows, SCHEMA)
    con.register("conversations", frame.toArrow())
    assert _rows(con.execute(OP13_SQL).df()) == _rows(P.trie(frame).toPandas())
