"""The filter audit against a plain count over rows."""

import itertools

import pytest
from pyspark.sql import functions as F

from sieveline.llm import filter_audit
from tests.llm import small

LABELS = [(k, 1 if k % 3 == 0 else 0, 1 if k % 5 == 0 else None) for k in range(0, 60, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1)]


def masks(rows):
    first = {}
    for doc, text, _ in rows:
        if doc is not None:
            first[text or ""] = min(first.get(text or "", doc), doc)
    for doc, text, part in rows:
        t = text or ""
        own = small.words(t)
        fails = {
            "A": len(own) < 50,
            "B": 100 * len(set(own)) < 65 * len(own),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
            "D": any(c in t for c in "#$%&*|"),
            "E": doc is not None and first[t] < doc,
        }
        good = doc is not None and any(d == doc and q == 1 for d, q, _ in LABELS)
        toxic = doc is not None and any(d == doc and x == 1 for d, _, x in LABELS)
        yield part or "", {f for f, bad in fails.items() if bad}, good, toxic


def audit(rows):
    """Filters every order row by row."""
    judged, out = list(masks(rows)), set()
    for part in {p for p, *_ in judged}:
        own = [r[1:] for r in judged if r[0] == part]
        steps, total = [], dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone, stay = [r for r in left if f in r[0]], [r for r in left if f not in r[0]]
                redundant = sum(f in r[0] for r in own) - len(gone)
                total[f] += len(gone)
                steps.append((part, "".join(order), step, len(stay), len(gone), redundant, sum(r[0] == {f} for r in own), sum(r[1] for r in gone), sum(r[2] for r in gone)))
                left = stay
        out |= {(*s, total[s[1][s[2] - 1]]) for s in steps}
    return out


@pytest.fixture(scope="module")
def rows():
    found = [(k, t, None if k % 11 == 0 else f"s{k % 3}") for k, t in enumerate(small.texts())]
    found += [(100, "", ""), (101, "A B # C", "s1"), (101, "A B # C", "s1"), (102, "A B # C", "s2"), (None, "A B # C", "s2"), (None, None, None)]
    return found + [(200 + k, "copied " * 60, "s0") for k in range(40)]


@pytest.fixture(scope="module")
def tables(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1, "d") for r in rows], "doc_id bigint, text string, source string, part string, mask int, digest string")
    return docs.repartition(3), spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int")


def collected(docs, labels):
    out = filter_audit.interactions(filter_audit.mask_counts(docs, labels))
    names = ["part", "filter_order", "step", *filter_audit.MEASURES]
    found = [tuple(r[c] for c in names) for r in out.collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_every_order_of_every_part(tables, rows):
    assert collected(*tables) == audit(rows)


def test_a_sketch_that_is_full_changes_nothing(tables, rows, monkeypatch):
    monkeypatch.setattr(filter_audit, "MAX_SLOTS", 16)
    assert collected(*tables) == audit(rows)


def test_only_possible_repeats_carry_texts(spark):
    docs = spark.createDataFrame([(k, f"text {k % 900}", "s") for k in range(1000)], "doc_id bigint, text string, source string").repartition(5)
    out = filter_audit.judged(docs).where(F.col("text").isNotNull()).agg(F.count("text").alias("n"), F.count_distinct("text").alias("d")).first()
    assert out.n >= 200 and out.d <= 150  # the 100 that occur twice, and few others


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert filter_audit.interactions(filter_audit.mask_counts(docs, spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))).collect() == []
