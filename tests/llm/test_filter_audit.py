"""The filter audit against running every order over the documents."""

from itertools import permutations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tabforge.llm import filter_audit


def brute(rows, filters="ABCDE"):
    """rows: (part, set of failed filters, good, toxic); every order is run as it stands."""
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        total = dict.fromkeys(filters, 0)
        steps = []
        for order in permutations(filters):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                fails = [r for r in own if f in r[1]]
                total[f] += len(gone)
                steps.append((part, "".join(order), step, len(left), len(gone), len(fails) - len(gone),
                              sum(r[1] == {f} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone)))
        for s in steps:
            out[s[:3]] = (*s[3:], total[s[1][s[2] - 1]])
    return out


def as_dict(rows):
    return {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"],
                                                        r["toxic_lost"], r["shapley"]) for r in rows}


PROSE = " ".join(f"w{i}" for i in range(120))
TEXTS = [PROSE, PROSE + " tail", PROSE + " #", "short", "SHORT TEXT", "a " * 200, ("AB CD " * 60), None, "", PROSE + " & more", "$" * 50,
         "word " * 90 + PROSE, "É" * 10 + "A", "x" * 9 + "A", "one\x0btwo\x0cthree\rfour\x1cfive"]


def failed(text, doc_id, docs):
    text = text or ""
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
    out = set()
    if len(words) < 100:
        out.add("A")
    if 100 * len(set(words)) < 80 * len(words):
        out.add("B")
    if 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text):
        out.add("C")
    if any(c in "#$%&*|" for c in text):
        out.add("D")
    if doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, *_ in docs):
        out.add("E")
    return out


def test_audit_equals_every_order_run(spark):
    docs = [(i, t, ["en", "de", None, ""][i % 4]) for i, t in enumerate(TEXTS * 3)]
    docs += [(None, PROSE, "en"), (None, PROSE, "en"), (3, "short", "en"), (0, PROSE, "de")]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 40)] + [(4, None, None), (5, 0, 1), (None, 1, 1), (None, 1, 1)]
    frame = spark.createDataFrame([(*d, 7, 7, 7) for d in docs], "doc_id long, text string, lang string, part int, mask int, n int")
    marks = spark.createDataFrame([(*x, 1) for x in labels], "doc_id long, quality int, toxic int, good int")
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    want = brute([(p or "", failed(t, i, docs), i in good, i in toxic) for i, t, p in docs])
    assert as_dict(filter_audit.audit(frame, marks).collect()) == want
    assert filter_audit.audit(frame.limit(0), marks).count() == 0
    bare = filter_audit.audit(frame, marks.limit(0)).collect()
    assert len(bare) == 3 * 600 and not any(r["good_lost"] or r["toxic_lost"] for r in bare)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 31), st.integers(1, 50), min_size=1))
def test_walk_equals_subset_counts(cells):
    masks, counts = list(cells), np.array([[n, n // 2, n // 3] for n in cells.values()])
    states = filter_audit.survivors(masks, counts, 5)
    for subset in range(32):
        assert states[subset].tolist() == counts[[m & subset == 0 for m in masks]].sum(axis=0).tolist()


def test_long_text_and_invalid_bytes(spark):
    rows = spark.sql("SELECT 1L AS doc_id, CAST(unhex('61FF62') AS STRING) AS text, 'en' AS lang UNION ALL SELECT 2L, repeat('Abc def ', 200000), 'en'")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = as_dict(filter_audit.audit(rows, labels).collect())
    assert got["en", "ABCDE", 1][:2] == (1, 1) and got["en", "BACDE", 1][:2] == (1, 1) and got["en", "CABDE", 1][:2] == (1, 1)
