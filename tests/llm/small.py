"""Small tables with awkward rows, and brute-force answers to hold operators against."""

import random
import re

import numpy as np

BLANK = "[\x20\x09-\x0d]"
LINE = "This very line is found in many documents, word for word."
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, n_words string, batch int, label int"


def texts():
    draw = random.Random(5)
    vocabulary = ["".join(draw.choice("abcdeilnorstu") for _ in range(draw.randint(2, 9))) for _ in range(300)]
    prose = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    found = [None, "", " \n\t ", "one", "two words", prose(3), prose(40000), "\n".join([LINE] * 3), "ÄÖ é ñ " + prose(30)]
    found += [prose(draw.randint(5, 400)).capitalize() + ".\n" + prose(60) for _ in range(40)]
    near = prose(300)
    found += [near, near, near + " more", "x " + near]
    found += [prose(30) + "\n  " + LINE.upper() + " \n" + prose(9) for _ in range(7)]
    found += ["Released under the MIT License.\n" + prose(20), "licensed under CC BY-NC 4.0; apache license mit license"]
    found += ["\x00 odd\x1c\x85\xa0 white space <|endoftext|>", "İ ß ŉ ǅ é १२ 漢字"]
    return found


def documents(spark):
    """Repeated rows, null ids and columns whose names operators use for their own."""
    rows = [(k, t, "en", None if k % 11 == 0 else f"s{k % 3}", 7, 0.5, "x", 1, 2) for k, t in enumerate(texts())]
    rows += [rows[12], rows[12], (None, "no id here at all", None, None, None, None, None, None, None), (None, None, *[None] * 7)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def fingerprint(text):
    import xxhash

    own = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(own[i : i + 3]) for i in range(len(own) - 2)] if len(own) >= 3 else [" ".join(own)] if own else []
    h = np.array([xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles], np.uint64)
    return sum(1 << b for b in range(64) if 2 * int((h >> np.uint64(b) & np.uint64(1)).sum()) > len(h))


def components(rows, radius=3):
    """{row place: smallest id reachable} over (id, text) rows."""
    prints = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [(f"{prints[i]:016x}", least.get(find(i))) for i in range(len(rows))]


def line_deduped(rows, min_chars=40, min_docs=5):
    """(id, text, lines, dropped) of every (id, text) row."""
    low = -(2**63)
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), re.sub(f"^{BLANK}+|{BLANK}+$", "", x))
    held = {}
    for doc, text in rows:
        for x in (text or "").split("\n"):
            if len(key(x)) >= min_chars:
                held.setdefault(key(x), set()).add(low if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if len(held.get(key(x), ())) < min_docs or max(held[key(x)]) == (low if doc is None else doc)]
        out.append((doc, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return out
