"""Conversation repair against a search over all edit sequences."""

import hashlib
import heapq
import random
import re
import zlib

from sieveline.llm import conversation_repair as cr

BLANK = re.compile("[\x20\x09-\x0d]*")


def damage(rows):
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = (" " if x is None else x for x in (role, text))
        fault = zlib.crc32(name.encode()) % 20
        if fault == 0:
            yield conv, None
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        for _ in range(2 if fault == 3 else 1):
            yield conv, (turn, "user" if fault == 4 else role, text)


def cheapest(rows):
    """(cost, audit, lines) by Dijkstra over (rows read, place in the role pattern); rows are (role, text, must go, truncated)."""
    # places: 0 nothing yet, 1 after s, 2 after u, 3 after a
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, at, place, lines = heapq.heappop(heap)
        if (at, place) in done:
            continue
        done.add((at, place))
        if at == len(rows) and place in (0, 3):
            return cost, audit, lines
        for token, role in (("u", "user"), ("a", "assistant")):
            if (place, token) in step:
                heapq.heappush(heap, (cost + 3, audit + "I", at, step[place, token], (*lines, f"{role}:")))
        if at < len(rows):
            role, text, must_go, truncated = rows[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, place, lines))
            if not must_go:
                if (place, role[:1]) in step:
                    heapq.heappush(heap, (cost + 3 * truncated, audit + "K", at + 1, step[place, role[:1]], (*lines, f"{role}:{text}")))
                for token, new in (("u", "user"), ("a", "assistant")):
                    if (place, token) in step:
                        heapq.heappush(heap, (cost + 3 + 3 * truncated, audit + "R", at + 1, step[place, token], (*lines, f"{new}:{text}")))


def expected(rows):
    """One result row per conversation of (conv, (turn, role, text) or None) rows."""
    convs = {}
    for conv, row in rows:
        convs.setdefault(conv, []).extend([row] if row else [])
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0, r[1].encode(), r[2].encode()))
        seen, judged, counts = set(), [], [0, 0, 0]
        for _, role, text in own:
            body = text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")
            fault = 0 if BLANK.fullmatch(text) else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
            if fault is not None:
                counts[fault] += 1
            seen.add((role, text))
            judged.append((role, text, fault in (0, 1), fault == 2))
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, lines = cheapest(judged)
        yield conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def conversations():
    draw = random.Random(11)
    texts = ["Hello there.", "What?", "cut off", "cut off", "", " \t\n", "é!", "Done. ", "漢字", "two\nlines."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "Sam", "a"]
    rows = []
    for conv in range(400):
        n = draw.choice([1, 1, 2, 3, 4, 5, 6, 8, 12])
        proper = draw.random() < 0.5
        for turn in range(n):
            role = ("user", "assistant")[turn % 2] if proper and draw.random() < 0.9 else draw.choice(roles)
            rows.append((conv if conv else None, None if draw.random() < 0.05 else turn * draw.choice([1, 1, 1, 2]), role, draw.choice([*texts, None, f"no {draw.random()}."])))
    rows += [(1000, turn, "tool", f"{turn}.") for turn in range(300)]
    rows += [(1001, turn, ("user", "assistant")[turn % 2], f"{turn}.") for turn in range(700)]
    return [*rows, *rows[:5]]


def test_damage_and_repair_of_all_rows(spark):
    rows = conversations()
    draw = random.Random(2)
    mixed = [(t, r, x, c, "y", True) for c, t, r, x in draw.sample(rows, len(rows))]
    df = spark.createDataFrame(mixed, "turn bigint, role string, text string, conv_id bigint, audit string, gone boolean").repartition(5)
    got = cr.repair(cr.damaged(df), gone="gone")
    assert got.columns == ["conv_id", *cr.NAMES]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected(damage(rows)), key=repr)


def test_repair_without_damage(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    told = [(c, (t, " " if r is None else r, " " if x is None else x)) for c, t, r, x in rows]
    assert sorted(map(tuple, cr.repair(df).collect()), key=repr) == sorted(expected(told), key=repr)


def test_a_conversation_that_lost_all_rows(spark):
    df = spark.createDataFrame([("c", 1, "user", "x.", True)], "conv_id string, turn int, role string, text string, gone boolean")
    assert tuple(cr.repair(df, gone="gone").first()) == ("c", 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())


def test_a_long_conversation_keeps_few_parses():
    own = cr.Repair()
    for turn in range(20_000):
        own.row(("user", "assistant")[turn % 2], f"{turn}.", False, False)
        assert len(own.tops) <= 6 and max(len(p.audit) for p in own.tops.values()) <= 80
    assert own.result()[:2] == (0, "K" * 20_000)


def test_no_rows(spark):
    assert cr.repair(cr.damaged(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")), gone="gone").collect() == []
