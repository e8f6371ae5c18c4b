"""The filter audit against an audit that applies every order to every document."""

import re
from itertools import permutations
from math import factorial

import pytest

from tablemend.llm import filter_audit

NAMES = "ABCDE"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def _fails(rows):
    """The letters that each row fails."""
    out = []
    for key, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": any(k is not None and key is not None and k < key and (t or "") == text for k, t, _ in rows),
        }
        out.append({x for x, f in fails.items() if f})
    return out


def _brute(rows, good, toxic):
    fails, out = _fails(rows), {}
    for part in {lang or "" for _, _, lang in rows}:
        mine = [(k, f) for (k, _, lang), f in zip(rows, fails) if (lang or "") == part]
        sums = dict.fromkeys(NAMES, 0)
        for order in permutations(NAMES):
            left = list(mine)
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if letter in d[1]]
                left = [d for d in left if letter not in d[1]]
                sums[letter] += len(gone)
                out[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    sum(letter in f for _, f in mine) - len(gone),
                    sum(f == {letter} for _, f in mine),
                    sum(k in good for k, _ in gone),
                    sum(k in toxic for k, _ in gone),
                ]
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(sums[order[step - 1]])
    return out


def _run(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "m", 1, 2) for r in rows], "doc_id long, text string, lang string, mask string, n int, key int")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return filter_audit.audit_documents(docs.repartition(3), marks)


def test_audit_equals_all_orders(spark):
    long = " ".join(f"word{i}" for i in range(220))
    loud = " ".join(f"WORD{i}" for i in range(220))
    texts = [long, long, long + " $", loud, loud, "again " * 300, "again " * 300, "", None, "few\twords\x0bhere", "A", " \n\r\x0c ", "é" * 10 + "A", long]
    rows = [(i, t, ("en", "fr", None, "")[i % 4]) for i, t in enumerate(texts)]
    rows += [(3, loud, "en"), (None, long, "en"), (None, long, "de"), (None, None, None), (0, long, "en"), (0, long, "fr"), (-1, "again " * 300, "xx")]
    labels = [(i, i % 2, i % 3 % 2) for i in range(12)] + [(2, 1, 1), (None, 1, 1), (99, 1, 0), (1, None, None)]
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    got = _run(spark, rows, labels)
    found = {(r.part, r.filter_order, r.step): [r[c] for c in COUNTS] for r in got.collect()}
    want = _brute(rows, good, toxic)
    assert found == want
    assert got.count() == len(want) == 600 * len({lang or "" for _, _, lang in rows})


def test_no_rows_give_no_audit(spark):
    assert _run(spark, [], []).collect() == []


def test_one_text_in_a_third_of_all_rows(spark):
    rows = [(i, "the same" if i % 3 else f"text {i}", "en") for i in range(3000)]
    got = _run(spark, rows, []).where("filter_order = 'EABCD' AND step = 1").first()
    assert (got.removed, got.kept) == (1999, 1001)


@pytest.mark.parametrize("n", [1, 3, 5])
def test_paths_by_either_pass(n):
    forward, backward = filter_audit.path_counts(n)
    for state in range(1 << n):
        k = state.bit_count()
        assert (forward[state], backward[state]) == (factorial(k), factorial(n - k))


def test_step_rows_add_up_to_the_shapley_sum(spark):
    rows = [(i, "x " * (i * 7 % 400) + "$" * (i % 3 == 0), "en") for i in range(200)]
    got = _run(spark, rows, []).collect()
    for letter in NAMES:
        steps = [r for r in got if r.filter_order[r.step - 1] == letter]
        assert {r.shapley for r in steps} == {sum(r.removed for r in steps)}
