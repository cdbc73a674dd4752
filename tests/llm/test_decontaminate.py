import hashlib

from pulsemill.llm import decontaminate as D
from tests.llm.data import folded, frame, prose

ITEMS = "item_id long, text string"


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        w, hit, found = folded(text), set(), set()
        for item, t in items:
            v = folded(t)
            if not v:
                continue
            size = min(13, len(v))
            windows = {tuple(v[i:i + size]) for i in range(len(v) - size + 1)}
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in windows:
                    hit |= set(range(i, i + size))
                    found |= {str(item)} - {"None"}
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest,
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def test_equals_brute_force(spark):
    base = [r for r in frame(spark).select("doc_id", "text").collect()]
    passage = prose(30, 50)
    docs = base + [(20, f"{prose(40, 51)} {passage.upper()}, {prose(20, 52)}"), (21, prose(900, 53) + " " + passage),
                   (22, " ".join(passage.split()[3:17])), (23, "tiny item here"), (24, "a tiny item"),
                   (25, prose(25, 60)), (26, prose(300, 61) + " " + prose(25, 60))]
    items = [(1, passage), (2, passage), (2, passage), (3, None), (4, ""), (5, "Tiny ITEM!"), (None, passage),
             (None, prose(25, 60)), (None, None),
             (6, " ".join(passage.split()[10:])), (7, prose(4000, 10)), (8, "two")]
    df = spark.createDataFrame([tuple(r) for r in docs], "doc_id long, text string")
    bench = spark.createDataFrame(items, ITEMS)
    expected = brute([tuple(r) for r in docs], items)
    for block in (50_000, 700):  # one block of windows, and several
        found = sorted((tuple(r) for r in D.contamination(df, bench, block).collect()), key=str)
        assert found == expected


def test_empty_tables(spark):
    bench = spark.createDataFrame([], ITEMS)
    assert D.contamination(frame(spark, []), bench).count() == 0
    rows = D.contamination(frame(spark), bench).collect()
    assert len(rows) == 20 and not any(r.contaminated or r.n_items for r in rows)


def test_kept_documents_keep_their_columns(spark):
    bench = spark.createDataFrame([(1, "one two")], ITEMS)
    docs = frame(spark)
    kept = D.decontaminated(docs, bench)
    assert kept.columns == docs.columns
    assert {8, 9}.isdisjoint({r.doc_id for r in kept.collect()}) and kept.count() == 18
