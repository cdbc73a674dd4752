import random

import numpy as np

from pulsemill.llm import near_dedup as N
from pulsemill.llm import words as W
from pulsemill.llm.graph import components
from tests.llm.data import frame, prose, shingle_set


def brute(rows):
    """Class of each row: least id of the component over Jaccard similarities."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both / len(sets[i] | sets[j]) >= N.SIMILARITY:
                parent[find(i)] = find(j)
    out = []
    for i, (own, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((own, own if not sets[i] else min(ids, default=None)))
    return sorted(out, key=str)


def check(df):
    classes, links = N.near_duplicates(df)
    mine = sorted(((r.doc_id, r.class_id) for r in classes.collect()), key=str)
    assert mine == brute([(r.doc_id, r.text) for r in df.collect()])
    return links


def test_awkward_documents(spark):
    links = check(frame(spark))
    assert links.count() == 1  # base and its near copy; other copies share a word sequence


def test_empty_table(spark):
    classes, links = N.near_duplicates(frame(spark, []))
    assert classes.count() == 0 and links.count() == 0


def test_families_that_stars_split(spark):
    """Chains of edits and a passage in many documents: the prefix join must close them."""
    base, rows = prose(150, 5).split(), []
    for i in range(40):
        words = list(base)
        for k in range(i, i + 3):
            words[(k * 7) % 150] = f"edit{k}"
        rows.append((i, " ".join(words)))
    passage = prose(60, 6)
    rows += [(100 + i, f"{prose(25 + i % 5, 200 + i)} {passage}") for i in range(40)]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_repetition_hides_no_link(spark):
    """Texts of the same lines, each as often as chance has it."""
    rows = []
    for i in range(60):
        lines = [prose(10, 1000 * (i // 2) + k) for k in range(12)]
        rng = random.Random(i)
        rows.append((i, "\n".join(x for x in lines for _ in range(rng.choice((1, 1, 8, 40))))))
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_sketch_estimates_probability_jaccard():
    import pyarrow as pa

    a, b = prose(600, 7).split(), prose(600, 7).split()
    b[::60] = [f"x{i}" for i in range(10)]
    texts = [" ".join(a), " ".join(b)]
    w = W.words(pa.array(texts), W.ALNUM)
    keys, text, weight = N.weighted(*W.shingles(w, 5))
    ids = N.sketches(keys, text, weight, 2) & np.uint64(0xFFFFFFFF)
    x, y = map(shingle_set, texts)
    assert abs((ids[0] == ids[1]).mean() - len(x & y) / len(x | y)) < 0.15


def test_early_end_changes_nothing():
    """A sketch equals the one of all arrivals, computed register by register."""
    keys = W.random_values(50, 3) >> np.uint64(20)
    weight = 1 + np.log(1 + np.arange(50) % 3)
    quick = N.sketches(keys, np.zeros(50, np.int64), weight, 1)[0]
    m = N.REGISTERS
    seed = W.mix(keys * np.uint64(2) + np.uint64(1))
    shift = (W.mix(seed + np.uint64(1)) & np.uint64(m - 1)).astype(np.int64)
    stride = (W.mix(seed + np.uint64(2)) & np.uint64(m - 1)).astype(np.int64) | 1
    best = [(np.inf, 0)] * m
    for k in range(50):
        time = 0.0
        for i in range(m):
            u = (float(int(W.mix(seed[k:k + 1] ^ W.random_values(m, 3)[i])[0]) >> 11) + 0.5) * 2.0**-53
            time -= np.log(u) / (weight[k] * (1 - i / m))
            r = int(shift[k] + stride[k] * i) % m
            best[r] = min(best[r], (time, int(seed[k]) & 0xFFFFFFFF))
    assert [int(x) & 0xFFFFFFFF for x in quick] == [x for _, x in best]


def test_components(spark):
    links = [(i, i + 1) for i in range(20)] + [(30, 31), (31, 30), (40, 40), (None, 3)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(21)}, 30: 30, 31: 30}
