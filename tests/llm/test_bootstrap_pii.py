"""Strict forms against the literal expressions; learnt forms in made-up contexts."""

import hashlib
import random
import re

import pytest

from pulsemill.llm import bootstrap_pii as B
from pulsemill.llm import identifiers as I
from tests.llm.data import DOCS, frame, prose

LITERAL = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def by_hand(text):
    out = []
    for k, (kind, pattern) in enumerate(LITERAL.items()):
        for m in re.finditer(pattern, text or ""):
            n = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda m=m: True,
                "ip": lambda m=m: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda n=n: 14 <= len(n) <= 19 and sum(
                    int(c) if i % 2 == 0 else (2 * int(c)) // 10 + (2 * int(c)) % 10
                    for i, c in enumerate(reversed(n))) % 10 == 0,
                "phone": lambda n=n: 10 <= len(n) <= 15,
            }[kind]()
            if good:
                out.append((m.start(), k, kind, m.end()))
    return ",".join(f"{kind}:{s}:{e}" for s, _, kind, e in sorted(out))


def check(rows, texts):
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, *_ in texts)
    want = sorted((str(i), hashlib.sha256(by_hand(t).encode()).hexdigest()) for i, t, *_ in texts)
    assert sorted((str(r.doc_id), r.base_sha256) for r in rows) == want
    for r in rows:
        spans = r.spans.split(",") if r.spans else []
        assert len(spans) == r.n_email + r.n_ip + r.n_card + r.n_phone + r.n_learnt


def test_strict_forms_equal_the_expressions():
    rng = random.Random(5)
    alphabet = list("0123456789") * 2 + list("..@@--  +()aZ_%é\n\t🙂") + ["255.", "10.0.0.1", "a@b.co", "+1 ", "4111 1111 1111 1111"]
    for _ in range(20_000):
        text = "".join(rng.choices(alphabet, k=rng.randint(1, 40)))
        mine = sorted((s, k, e) for k, s, e in I.strict(text))
        assert ",".join(f"{I.KINDS[k]}:{s}:{e}" for s, k, e in mine) == by_hand(text), repr(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 100_000, "+1" + ")" * 200_000, "a@" * 100_000, "1:" * 100_000):
        I.loose(text, I.strict(text))


def loose_texts():
    """Numbers without a plus behind 'reach me on', which mostly holds real numbers; order numbers elsewhere."""
    rows = []
    for i in range(40):
        rows.append((i, f"{prose(12, i)} please reach me on +1 (555) {200 + i}-{1000 + i} anytime soon {prose(9, 90 + i)}"))
    rows += [(100 + i, f"{prose(8, i)} please reach me on 555-{300 + i}-{2000 + i} anytime soon {prose(5, i)}") for i in range(6)]
    rows += [(200 + i, f"{prose(9, i)} the order was 555-{700 + i}-{4000 + i} {prose(5, i)}") for i in range(30)]
    rows += [(300 + i, f"write to {name} (at) mail [dot] example [dot] org today é {prose(4, i)}") for i, name in enumerate("abc")]
    rows += [(310 + i, f"{prose(3, i)} write to {name}@mail.example.org today {prose(4, i)}") for i, name in enumerate("defghijk")]
    # learnt in the second round only: its pattern holds numbers that the first round has learnt
    rows += [(400 + i, f"{prose(5, i)} dial fast 555-{300 + i % 4}-{2000 + i % 4} now please") for i in range(8)]
    rows += [(420, "dial fast 555-999-1234 now please"), (500, None), (501, ""), (None, "reach me on 555-300-2000 anytime soon")]
    rows += [(502, "+1 (555) 200-1000 twice +1 (555) 200-1000"), (502, "x")]
    return rows


def test_contexts_discover_unseen_identifiers(spark):
    rows = loose_texts()
    docs = frame(spark, [(i, t, None, None, 0) for i, t in rows])
    found, learnt = B.personal_data(docs)
    result = found.collect()
    check(result, rows)
    values = {(I.KINDS[r.kind], r.value): r["round"] for r in learnt.collect()}
    assert {v for k, v in values if k == "phone"} == {f"555{300 + i}{2000 + i}" for i in range(6)} | {"5559991234"}
    assert values["phone", "5559991234"] == 2 and values["phone", "5553002000"] == 1
    assert {v for k, v in values if k == "email"} == {f"{n}@mail.example.org" for n in "abc"}
    by_id = {r.doc_id: r for r in result if r.doc_id not in (502,)}
    text = dict(rows)[103]
    start = text.index("555-303")
    assert by_id[103].spans == f"phone:{start}:{start + 12}" and by_id[103].n_phone == 0
    assert all(by_id[200 + i].n_learnt == 0 for i in range(30))
    assert by_id[None].n_learnt == 1


def test_a_pattern_shared_with_ordinary_words_is_not_trusted(spark):
    rows = [(i, f"the +1 (555) {200 + i}-1000 end") for i in range(20)]
    rows += [(100 + i, f"the word{i} end the thing the other") for i in range(60)] + [(900, "the 555-777-8888 is")]
    found, learnt = B.personal_data(frame(spark, [(i, t, None, None, 0) for i, t in rows]))
    assert learnt.count() == 0 and found.agg({"n_learnt": "sum"}).first()[0] == 0


def test_awkward_documents(spark):
    docs = frame(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    check(B.personal_data(docs)[0].collect(), rows)
    assert B.personal_data(frame(spark, []))[0].count() == 0


@pytest.mark.parametrize("text", ["é 1.2.3.4 🙂 a@b.co", "🙂" * 50 + "+1 (555) 123-4567" + "é"])
def test_places_are_code_points(spark, text):
    row = B.personal_data(spark.createDataFrame([(1, text, None, None, 0)], DOCS))[0].first()
    assert row.spans == by_hand(text) != ""
