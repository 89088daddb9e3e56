"""Each operator on awkward rows, against brute force, a round trip or a planted answer."""

import random
import zlib
from array import array
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sieveline.llm import (
    html_extract,
    license_scan,
    line_dedup,
    mixing,
    packing,
    quality_knn,
    quality_rules,
    simhash,
    topk_search,
    toxicity,
)
from sieveline.llm.common import word_count
from tests.llm import small

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return small.documents(spark).cache()


@pytest.fixture(scope="module")
def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def same(got, want):
    assert sorted(map(repr, got)) == sorted(map(repr, want))


# --- mixing


def test_mix_meets_entropy_and_budget(spark):
    rows = [(k, "s0" if k % 3 else f"s{k % 7}", 5 + k % 4) for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, n bigint")
    out = mixing.mix(docs, F.col("n"), entropy_gain=0.5, budget_share=0.7).collect()
    total = Counter()
    for _, s, n in rows:
        total[s] += n
    shares = np.array(list(total.values())) / sum(total.values())
    now, most = -(shares * np.log(shares)).sum(), np.log(len(shares))
    budget = {r.source: r.mix_budget for r in out}
    weights = np.array(list(budget.values())) / sum(budget.values())
    assert abs(-(weights * np.log(weights)).sum() - (now + most) / 2) < 1e-3
    drawn = Counter()
    for r in out:
        drawn[r.source] += r.n
    assert all(0 <= drawn[s] - b < 9 for s, b in budget.items())
    assert max(Counter((r.doc_id, r.mix_block) for r in out).values()) == 1


def test_mix_repeats_in_whole_permutations_up_to_its_limit(spark):
    docs = spark.createDataFrame([(k, "big" if k < 900 else "small", 1) for k in range(1000)], "doc_id bigint, source string, n bigint")
    out = mixing.mix(docs, F.col("n"), target_entropy=9.0, most_repeats=3.0).collect()
    times = Counter(r.doc_id for r in out if r.source == "small")
    assert set(times.values()) <= {2, 3} and 295 <= sum(times.values()) <= 301
    first = [r.doc_id for r in sorted((r for r in out if r.source == "small" and r.mix_block == 0), key=lambda r: r.mix_order)]
    second = [r.doc_id for r in sorted((r for r in out if r.source == "small" and r.mix_block == 1), key=lambda r: r.mix_order)]
    assert sorted(first) == sorted(second) == list(range(900, 1000)) and first != second


def test_mix_of_awkward_rows(spark, docs):
    out = mixing.mix(docs, word_count(F.col("text")), entropy_gain=0.5, most_repeats=2.0)
    assert out.columns == docs.columns + ["mix_tokens", "mix_block", "mix_order", "mix_budget"]
    assert all(small.words(r.text) for r in out.collect())
    assert mixing.mix(small.nothing(spark), F.lit(1), entropy_gain=0.5).count() == 0
    plain = mixing.mix(docs, word_count(F.col("text")))  # no target: as it is
    same([(r.doc_id, r.text) for r in plain.collect()], [(r.doc_id, r.text) for r in docs.collect() if small.words(r.text)])


def test_mix_fills_what_its_weights_allow(spark):
    how = {"entropy_gain": 0.5, "most_repeats": 1.0, "budget_share": 0.8, "fill": True}
    for sources in (lambda k: "only", lambda k: f"s{k % 5}", lambda k: "big" if k % 5 else "small"):
        docs = spark.createDataFrame([(k, sources(k), 3) for k in range(1000)], "doc_id bigint, source string, n bigint")
        out = mixing.mix(docs, F.col("n"), **how).collect()
        assert len({r.doc_id for r in out}) == len(out)
        total, drawn = Counter(sources(k) for k in range(1000)), Counter(r.source for r in out)
        assert any(drawn[s] == n for s, n in total.items()) and len(out) >= 800  # a source is drawn whole: more would repeat it
        if len(set(total.values())) == 1:
            assert len(out) == 1000


def test_mix_with_every_document(spark):
    for sources in (lambda k: "only", lambda k: f"s{k % 5}", lambda k: "big" if k % 50 else "small", lambda k: None if k % 3 else f"s{k % 11}"):
        rows = [(k, sources(k), k % 4) for k in range(1200)]
        docs = spark.createDataFrame(rows, "doc_id bigint, source string, n bigint")
        out = mixing.mix(docs, F.col("n"), entropy_gain=0.5, most_repeats=2.0, every=True).collect()
        times = Counter(r.doc_id for r in out)
        assert set(times) == set(range(1200)) and max(times.values()) <= 2 and all(times[k] == 1 for k, _, n in rows if n == 0)
        total, drawn = Counter(), Counter()
        for _, s, n in rows:
            total[s] += n
        for r in out:
            drawn[r.source] += r.n
        largest = max(total, key=total.get)
        assert drawn[largest] == total[largest]
        shares = [n / sum(total.values()) for n in total.values()]
        weights = [n / sum(drawn.values()) for n in drawn.values()]
        entropy = lambda ps: -sum(p * np.log(p) for p in ps)
        assert entropy(weights) >= entropy(shares) - 1e-9
        for s in total:
            assert 0 <= drawn[s] - next(r.mix_budget for r in out if r.source == s and r.n) < 4
    rows = [(None, "s", 0), (None, None, 0)]
    assert mixing.mix(spark.createDataFrame(rows, "doc_id bigint, source string, n bigint"), F.col("n"), every=True).count() == 2


def test_mix_spreads_rows_without_an_id_and_minds_no_names(spark):
    names = ["doc_id", "source", "tokens", "row", "d1", "key", "before", "__tokens", "a.b"]
    rows = [(None, "s", k % 50, f"r{k}", 1, 2, 3, 4, k) for k in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, tokens bigint, row string, d1 int, key int, before int, __tokens int, `a.b` int")
    out = mixing.mix(docs, F.col("tokens"), entropy_gain=0.5, every=True, identity=F.col("row"))
    assert out.columns[:9] == names
    same([tuple(r)[:9] for r in out.collect()], rows)
    cells = {r.mix_order >> 44 for r in out.collect()}
    assert len(cells) > 1500  # cells of a window; by id alone there is one


# --- html


PAGE = """<html><head><title>t</title><script>var x="<p>no</p>";</script></head><body><header class="top"><ul class="menu"><li><a href=/>Home</a></li></ul>
</header><div class="ad">Buy &amp; save now</div><article><h1>A  title</h1><p>First &lt;paragraph&gt;, with <b>bold</b><br>and&nbsp;more words in it.
<p>Second one, never closed, that goes on for a while.</article><section class="comments"><p>I disagree with all of it, as a reader.</p></section>
<form>Your mail <input> <button>Go</button></form><footer>&copy; 2024</footer></body></html>"""
MAIN = "A title\n\nFirst <paragraph>, with bold and more words in it.\n\nSecond one, never closed, that goes on for a while."


@pytest.fixture(scope="module")
def labeller():
    draw = random.Random(3)
    prose = lambda n: " ".join("".join(draw.choice("aeinrst") for _ in range(draw.randint(2, 8))) for _ in range(n)) + "."
    pages = []
    for _ in range(120):
        body = "".join(f"<p>{prose(draw.randint(5, 60))}</p>" for _ in range(draw.randint(1, 9)))
        menu = "".join(f"<li><a href=x>{prose(1)}</a></li>" for _ in range(5))
        pages.append(f"<body><nav><ul>{menu}</ul></nav><div class=ad>{prose(6)}</div><article><h1>{prose(5)}</h1>{body}</article><footer>{prose(4)}</footer>")
    return html_extract.train([html_extract.leaf_blocks(p) for p in pages])


def test_blocks_and_main_text(labeller):
    assert html_extract.main_texts([PAGE, None, "", "  ", "<!-- <p>x", "<p"], labeller)[:5] == [MAIN, "", "", "", ""]
    found = html_extract.leaf_blocks("a<p>b<div>c</div>d<td>e")
    assert [b[0] for b in found] == ["a", "b", "c", "d", "e"]
    deep = html_extract.leaf_blocks("<div>" * 300 + "x" + "</div>" * 300 + "<p>" + "y " * 50000)
    assert [len(b[0]) for b in deep] == [1, 99999]


def test_elements_left_open_hide_no_text():
    texts = lambda page: [b[0] for b in html_extract.leaf_blocks(page)]
    assert texts("<html><head><title>t</title><meta charset=x><div><p>One<p>Two</div>") == ["One", "Two"]
    assert texts("<head><title>t</title>Words") == ["Words"]
    for name in ("button", "video", "svg", "object", "select"):
        assert texts(f"<article><div><{name}></div><p>One</p><p>Two</p></article><div>x</div>") == ["One", "Two", "x"]
        assert texts(f"<article><{name}><p>One</p><p>Two</p></article>") == ["One", "Two"]
        assert texts(f"<p>a <{name}>no <b>no</b><div>no</div></{name}> b</p><p>c") == ["a b", "c"]
    assert texts("<p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds") == ["So x = 2 holds"]


@pytest.mark.parametrize("unit", ["<div>x", "<a ", "<svg>x", "<svg>x<div>y", "</b><p>z</div>", "<div class='a b c d'>x</p>", "<!x ", "<script ", "<td>x<li>y", "<a \"x"])
def test_pages_are_parsed_in_proportion(labeller, unit):
    import time

    seconds = []
    for size in (1 << 17, 1 << 19):
        started = time.process_time()
        html_extract.leaf_blocks(unit * (size // len(unit)))
        seconds.append(time.process_time() - started)
    assert seconds[1] < 8 * max(seconds[0], 0.1)


def test_a_page_of_many_blocks_is_labelled_whole(labeller):
    text = html_extract.main_texts(["<body><nav>Home</nav><article>" + "<p>A sentence with several words in it, as usual." * 20_000 + "</article>"], labeller)[0]
    assert text.count("A sentence") == 20_000 and "Home" not in text


def test_vectors_of_blocks_without_a_dense_matrix():
    draw = np.random.default_rng(3)
    rows = [(draw.integers(0, 50, n), draw.integers(1, 9, n) if n % 2 else None) for n in draw.integers(1, 40, 300)]
    vectors = draw.standard_normal((50, 6)).astype(np.float32)
    keep, html_extract.TOKENS_AT_ONCE = html_extract.TOKENS_AT_ONCE, 100
    try:
        got = html_extract.mean_vectors(rows, vectors)
    finally:
        html_extract.TOKENS_AT_ONCE = keep
    assert np.allclose(got, html_extract.shares(rows, 50) @ vectors, atol=1e-5)


def test_short_blocks_of_plain_pages_follow_their_neighbours():
    long = "A line of running text that is well over forty characters long."
    page = f"<body><div><h1>Title</h1><p>{long}</p><p>Short.</p><p>{long}</p></div><div class=menu><span>Go</span></div><div><div>Elsewhere</div></div>"
    blocks = html_extract.leaf_blocks(page)
    assert [(b[0] if len(b[0]) < 40 else "long", m) for b, m in zip(blocks, html_extract.weak_labels(blocks))] == [
        ("Title", 1), ("long", 1), ("Short.", 1), ("long", 1), ("Go", 0), ("Elsewhere", 0)]


def test_renamed_containers_are_told_apart(labeller):
    page = PAGE.replace("<article>", '<div id="story">').replace("</article>", "</div>").replace('"ad"', '"sponsored box"')
    text = html_extract.main_texts([page], labeller)[0]
    assert "First <paragraph>" in text and "Second one" in text and "Buy" not in text and "disagree" not in text and "2024" not in text


def test_lstm_gradient():
    pages = [html_extract.encoded(html_extract.leaf_blocks(PAGE)), html_extract.encoded(html_extract.leaf_blocks("<p>a<p>b c"))]
    labels = [[0, 0, 1, 1, 1, 0, 0, 0], [1, 0]]
    model = html_extract.Labeller()
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}

    def loss():
        chance = np.concatenate(model.chances(pages))
        truth = np.concatenate(labels)
        return -(truth * np.log(chance) + (1 - truth) * np.log(1 - chance)).mean()

    caught = {}
    keep, html_extract.STEP = html_extract.STEP, 0.0
    model.step(pages, labels)
    html_extract.STEP = keep
    caught = {k: v / 0.1 for k, v in model.m.items()}
    for name, at in (("hf", (3, 5)), ("xb", (2, 70)), ("out", (4,)), ("cb", (30,))):
        before = model.w[name][at]
        model.w[name][at] = before + 1e-4
        up = loss()
        model.w[name][at] = before - 1e-4
        down = loss()
        model.w[name][at] = before
        assert abs((up - down) / 2e-4 - caught[name][at]) < 1e-4


def test_extract_over_a_table(spark, labeller):
    rows = [(1, "u", PAGE, 5), (1, "u", PAGE, 5), (None, None, None, None), (3, "v", "", 1)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, n_chars int")
    out = html_extract.extract(pages, labeller)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    same([tuple(r) for r in out.collect()], [(1, "u", MAIN, len(MAIN))] * 2 + [(None, None, "", 0), (3, "v", "", 0)])
    assert html_extract.extract(pages.limit(0), html_extract.fit(pages.limit(0))).count() == 0


# --- rules


def test_ledger_measures(docs, pairs):
    def brute(text):
        own = small.words(text)
        windows = Counter(tuple(own[i : i + 5]) for i in range(len(own) - 4))
        covered = {i + k for i in range(len(own) - 4) if windows[tuple(own[i : i + 5])] > 1 for k in range(5)}
        lines = [x for x in (text or "").split("\n") if small.words(x)]
        return len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)

    got = quality_rules.ledger(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    same([tuple(r) for r in got.collect()], [(d, *brute(t)) for d, t in pairs])


def test_repeated_windows():
    for seed in range(60):
        own = [b"%d" % random.Random(seed * 99 + i).randint(0, 1 + seed % 5) for i in range(seed)]
        windows = Counter(tuple(own[i : i + 5]) for i in range(len(own) - 4))
        covered = {i + k for i in range(len(own) - 4) if windows[tuple(own[i : i + 5])] > 1 for k in range(5)}
        assert quality_rules.repeated_window_words(own) == len(covered)


def test_policies_and_ablations(docs):
    rows = quality_rules.ledger(docs)
    policy = quality_rules.POLICIES["2024-2"]
    bits = [r.failed_bits for r in rows.collect()]
    assert sum(r.kept for r in quality_rules.apply_policy(rows, policy).collect()) == sum(b & policy == 0 for b in bits)
    for r in quality_rules.ablations(rows, policy).collect():
        bit = quality_rules.BITS[r.rule]
        assert r.n_failed == sum(b & bit > 0 for b in bits) and r.n_kept_without == sum(b & policy & ~bit == 0 for b in bits)
        assert r.n_only_this == sum(b & policy == bit for b in bits)
    assert quality_rules.ledger(docs.limit(0)).count() == 0


# --- near copies


def test_components_match_brute_force(spark, docs, pairs):
    got = simhash.near_duplicates(docs, tile=4).collect()
    want = [(d, *c) for (d, _), c in zip(pairs, small.components(pairs))]
    same([(r.doc_id, f"{r.fp & (2**64 - 1):016x}", r.component_id) for r in got], want)
    assert simhash.near_duplicates(small.nothing(spark)).count() == 0


@pytest.mark.parametrize("parts", [1, 2, 4])
def test_links_of_planted_fingerprints(spark, parts):
    draw = random.Random(parts)
    prints = [draw.getrandbits(64) for _ in range(60)]
    for p in prints[:40]:
        for _ in range(draw.randint(1, 4)):  # chains and distances about the radius
            prints.append(p ^ sum(1 << b for b in draw.sample(range(64), draw.randint(1, 5))))
    prints += [0, 1, 2**64 - 1, 2**63, 2**63 + 1]
    signed = sorted({p - 2**64 if p >> 63 else p for p in prints})
    edges = simhash.link_edges(spark.createDataFrame([(p,) for p in signed], "fp bigint"), parts=parts, tile=8)
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    want = {p: p for p in signed}
    changed = True
    while changed:
        changed = False
        for a in signed:
            for b in signed:
                if ((a ^ b) & (2**64 - 1)).bit_count() <= 3 and want[a] != want[b]:
                    want[a] = want[b] = min(want[a], want[b])
                    changed = True
    assert {p: roots.get(p, p) for p in signed} == want


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(k + 1, k) for k in range(500)], "u bigint, v bigint")
    assert {(r.node, r.root) for r in simhash.components(edges).collect()} == {(k, 0) for k in range(1, 501)}


def test_one_of_each_stays(docs, pairs):
    kept = [(r.doc_id, r.text) for r in simhash.keep_one_of_each(docs).collect()]
    want = {d for (d, _), (_, c) in zip(pairs, small.components(pairs)) if d is not None and d == c}
    assert sorted(d for d, _ in kept if d is not None) == sorted(want)
    assert sum(d is None for d, _ in kept) == 2


def test_keepers_are_rows_not_ids(spark):
    draw = random.Random(12)
    prose = lambda: " ".join("".join(draw.choice("aeilnorst") for _ in range(6)) for _ in range(200))
    one, two, three = prose(), prose(), prose()
    rows = [(5, one), (2, one + " x"), (5, two + " longer"), (9, two), (7, prose()), (7, prose() + " more"), (None, three), (None, three + " y"), (9, two)]
    prints = [simhash.fingerprint(t) & (2**64 - 1) for _, t in rows]
    assert all((prints[i] ^ prints[j]).bit_count() <= 3 for i, j in ((0, 1), (2, 3), (6, 7)))
    kept = simhash.keep_one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string"))
    same([tuple(r) for r in kept.collect()], [rows[1], rows[2], rows[4], rows[5], rows[6]])


def test_keepers_are_settled_by_all_columns_and_mind_no_names(spark):
    schema = "doc_id bigint, text string, source string, __length int, hash string, `row` string, id int"
    rows = [(1, "one and the same text here", f"s{k}", k, "h", "r", 5) for k in range(40)] + [(None, None, "n", None, None, None, None)]
    kept = [simhash.keep_one_of_each(spark.createDataFrame(rows, schema).repartition(n)).collect() for n in (1, 4)]
    assert len(kept[0]) == 2 and sorted(map(repr, kept[0])) == sorted(map(repr, kept[1]))
    assert kept[0][0].__fields__ == ["doc_id", "text", "source", "__length", "hash", "row", "id"]


# --- search


def test_top_k_on_awkward_vectors(spark):
    import duckdb
    import pyarrow as pa

    draw = np.random.default_rng(1)
    centres = draw.standard_normal((6, 8)) * 3
    vectors = [(int(k), (centres[k % 6] + draw.standard_normal(8) * 0.05).tolist(), "x") for k in range(400)]
    vectors += [(1000 + k, vectors[7][1], "copy") for k in range(50)]
    vectors += [vectors[0]] * 3 + [vectors[200], (100, vectors[5][1], "other"), (7, vectors[9][1], "z")] + [(None, vectors[0][1], "no id")] * 2
    odd = [(2000, None, ""), (2001, [1.0, None] * 4, ""), (2002, [float("nan")] * 8, ""), (2003, [float("inf")] * 8, ""), (2004, [], ""), (None, [1.0] * 8, "")]
    rows = vectors + odd + [(5000, [1.0, 2.0], "short"), (5100, [3.0, 1.0], "short"), (5200, [2.0], "alone")]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score string").repartition(3)
    con = duckdb.connect()
    con.register("embeddings", pa.table({"vec_id": [r[0] for r in rows], "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float64()))}))
    want = con.execute(topk_search.OP5_SQL).fetchall()
    assert len(want) > 80
    for data_block, query_block in ((64, 4), (4096, 4096), (30, 1)):
        got = topk_search.top_k(table, table.where("vec_id % 100 = 0"), data_block=data_block, query_block=query_block).collect()
        same([tuple(r) for r in got], want)
    assert topk_search.top_k(table.limit(0), table.limit(0)).count() == 0


def test_trees_of_vectors_without_clusters_have_levels_and_prune():
    draw = np.random.default_rng(5)

    def searched(points, queries):
        seen = Counter()
        ids = np.arange(len(points))
        found = topk_search.dual_tree_top_k(points[queries], ids[queries], points, ids, 10, seen=seen)
        for at, q in enumerate(queries):
            scores = points @ points[q]
            order = [i for i in np.lexsort((ids, -scores)) if i != q][:10]
            assert found[1][found[0] == at].tolist() == order and found[3][found[0] == at].tolist() == scores[order].tolist()
        return seen, topk_search.cover_tree(points).nodes()

    flat = np.floor(1024 * draw.standard_normal((1500, 64)) / 8)
    seen, nodes = searched(flat, np.arange(0, 1500, 100))
    assert nodes > 1000 and seen["pairs"] > 1000
    centres = draw.standard_normal((40, 64)) / 8
    clustered = np.floor(1024 * (centres[draw.integers(0, 40, 1500)] + draw.standard_normal((1500, 64)) / 200))
    seen, nodes = searched(clustered, np.arange(0, 1500, 5))
    assert nodes > 50 and seen["pruned"] > 0.2 * seen["pairs"] and seen["products"] < 0.4 * 300 * 1500


def test_a_known_bound_prunes_and_changes_nothing():
    draw = np.random.default_rng(6)
    centres = draw.standard_normal((30, 16))
    points = np.floor(1024 * (centres[draw.integers(0, 30, 900)] + draw.standard_normal((900, 16)) / 50))
    ids, queries = np.arange(900), np.arange(0, 900, 9)
    plain, seeded = Counter(), Counter()
    found = topk_search.dual_tree_top_k(points[queries], ids[queries], points, ids, 5, seen=plain)
    least = np.array([found[3][found[0] == at].min() for at in range(len(queries))])
    again = topk_search.dual_tree_top_k(points[queries], ids[queries], points, ids, 5, least=least, seen=seeded)
    assert all(x.tolist() == y.tolist() for x, y in zip(found, again)) and seeded["products"] < plain["products"]


def test_cover_tree_covers_and_separates():
    draw = np.random.default_rng(2)
    points = np.concatenate([draw.standard_normal((200, 3)) * 0.1 + c for c in draw.standard_normal((5, 3)) * 9])

    def visit(node):
        gaps = np.linalg.norm(points[node.rows] - points[node.rows[0]], axis=1)
        assert gaps.max() <= node.radius + 1e-12
        if node.children:
            scale = 2.0 ** (np.ceil(np.log2(node.radius)) - 1)
            centres = np.array([c.centre for c in node.children])
            apart = np.linalg.norm(centres[:, None] - centres[None], axis=2) + np.eye(len(centres)) * 1e9
            assert apart.min() > scale and sorted(np.concatenate([c.rows for c in node.children])) == sorted(node.rows)
            assert all(c.radius <= scale for c in node.children)
            for c in node.children:
                visit(c)

    tree = topk_search.cover_tree(points)
    assert tree.children
    visit(tree)


def test_products_beyond_double_precision():
    big = np.array([[3e8, 1.0], [3e8, 2.0], [3e8, 3.0]])
    ids = np.array([1, 2, 3])
    found = topk_search.dual_tree_top_k(big[:1], ids[:1], big, ids, 2)
    assert [x.tolist() for x in found] == [[0, 0], [3, 2], [1, 1], [9 * 10**16 + 3, 9 * 10**16 + 2]]


# --- classifiers


def test_quality_of_held_out_rows(spark):
    draw = random.Random(8)
    vocabulary = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 8))) for _ in range(500)]
    prose = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    rows = [(k, prose(80).upper() + "!!" if k % 4 == 0 else prose(80), int(k % 4 > 0)) for k in range(400)]
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, q, 0) for k, _, q in rows] + [(None, 1, 1), (5, None, None)], "doc_id bigint, quality int, toxic int")
    scored = {r.doc_id: r.s for r in quality_knn.with_scores(docs, quality_knn.fit(docs, labels), out="s").collect()}
    held = [(k, q) for k, _, q in rows if zlib.crc32(str(k).encode()) % 5 == 0]
    assert sum((scored[k] >= 0.3) == q for k, q in held) >= 0.95 * len(held)


def test_votes_one_by_one_with_ties():
    draw = np.random.default_rng(4)
    sample = quality_knn.unit(draw.integers(-1, 2, (150, 6)) + 0.001).astype(np.float32)  # many equal vectors
    votes = draw.integers(0, 2, 150).astype(np.float32)
    vectors = quality_knn.unit(draw.integers(-1, 2, (80, 6)) + 0.001).astype(np.float32)
    got = quality_knn.vote(vectors, sample, votes)
    near = np.maximum(vectors @ sample.T, 0)
    for row, score in enumerate(got):
        nearest = sorted(range(150), key=lambda j: (-near[row, j], j))[: quality_knn.NEIGHBOURS]
        weights = [float(near[row, j]) ** quality_knn.SHARPNESS for j in nearest]
        want = sum(w * votes[j] for w, j in zip(weights, nearest)) / sum(weights) if sum(weights) else votes.mean()
        assert abs(score - want) < 1e-6


def test_quality_scores_text_by_text(spark, docs):
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(60)], "doc_id bigint, quality int, toxic int")
    space, sample, votes = model = quality_knn.fit(docs, labels)
    for r in quality_knn.with_scores(docs, model, out="s").select("text", "s").distinct().collect():
        at, value = quality_knn.bag(r.text)
        vector = quality_knn.unit((value @ space[at] if len(at) else np.zeros(space.shape[1]))[None, :].astype(np.float32))
        assert abs(quality_knn.vote(vector, sample, votes)[0] - r.s) < 1e-4


def test_toxicity_reaches_misspellings_and_long_texts(spark):
    draw = random.Random(9)
    vocabulary = ["".join(draw.choice("aeilnorst") for _ in range(draw.randint(2, 8))) for _ in range(400)]

    def text(k, n=60):
        own = [draw.choice(vocabulary) for _ in range(n)]
        if k % 3 == 0:
            for _ in range(3):
                own[draw.randrange(n)] = draw.choice(["dumbhead", "vilegoblin", "mudbrain"])
        return " ".join(own)

    rows = [(k, text(k)) for k in range(450)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, 1, int(k % 3 == 0)) for k, _ in rows], "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    held = [k for k, _ in rows if zlib.crc32(str(k).encode()) % 3 == 1]
    scored = {r.doc_id: r.s for r in toxicity.with_scores(docs, model, out="s").collect()}
    assert sum((scored[k] >= 0.7) == (k % 3 == 0) for k in held) >= 0.95 * len(held)
    clean = " ".join(draw.choice(vocabulary) for _ in range(3000))
    probes = spark.createDataFrame([(1, clean), (2, clean + " such a dumbheadd and vilegobblin"), (3, None), (4, "")], "doc_id int, text string")
    got = {r.doc_id: r.s for r in toxicity.with_scores(probes, model, out="s").collect()}
    assert got[1] < 0.7 <= got[2] and got[3] == got[4]


def test_toxicity_passage_by_passage(spark, docs):
    number, offset = model = np.random.default_rng(5).standard_normal(toxicity.BUCKETS).astype(np.float32), -0.3
    for r in toxicity.with_scores(docs, model, out="s").select("text", "s").distinct().collect():
        each = []
        for word in toxicity.words_of(r.text):
            raw = f"<{word}>"
            parts = [raw] + [raw[i : i + n] for n in toxicity.GRAMS for i in range(len(raw) - n + 1)]
            each.append(np.mean([float(number[zlib.crc32(p.encode()) % toxicity.BUCKETS]) for p in parts]))
        half = toxicity.PASSAGE // 2
        worst = max((np.mean(each[i : i + toxicity.PASSAGE]) for i in range(0, max(1, len(each) - half), half)), default=0.0) if each else 0.0
        assert abs(1 / (1 + np.exp(-(worst + offset))) - r.s) < 1e-6


@pytest.mark.parametrize("module, label", [(quality_knn, "quality"), (toxicity, "toxic")])
def test_classifiers_on_awkward_rows(spark, docs, module, label):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    out = module.with_scores(docs, module.fit(docs, none), out="score")
    assert sorted(out.columns) == sorted(docs.columns) and {r.score for r in out.collect()} == {0.5}
    one = spark.createDataFrame([(k, 1, 1) for k in range(60)], "doc_id bigint, quality int, toxic int")
    assert all(r.score > 0.9 for r in module.with_scores(docs, module.fit(docs, one), out="score").where("doc_id > 8").collect())
    mixed = spark.createDataFrame([(k, k % 2, k % 2) for k in range(60)], "doc_id bigint, quality int, toxic int")
    rows = module.with_scores(docs, module.fit(docs, mixed), out="score").collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert module.with_scores(small.nothing(spark), module.fit(small.nothing(spark), none)).count() == 0


# --- licences


def test_automaton_reads_markup():
    a = license_scan.compile_template("t", "Grant <<beginOptional>>of rights<<endOptional>> to <<var;name=who;most=2>> free of charge")
    yes = ["grant to free of charge", "GRANT, of rights to all people, free of charge!", "x grant to you free of charge y"]
    no = ["grant of to free of charge", "grant to a b c free of charge", "grant to free of", "free of charge", ""]
    find = lambda t: a.found_in(w := license_scan.words_of(t), b" " + b" ".join(w) + b" ")
    assert all(map(find, yes)) and not any(map(find, no))
    for bad in ("<<beginOptional>>x", "x<<endOptional>>", "<<beginOptional>>x<<endOptional>>", ""):
        with pytest.raises(ValueError):
            license_scan.compile_template("t", bad)


def test_scan_of_awkward_rows(spark, docs):
    got = {r.doc_id: r for r in license_scan.scan_licenses(docs).collect()}
    assert got[0].n_words == 0 and got[0].first_word is None and got[0].labels == ""
    both = next(r for r in got.values() if "cc-by" in r.base_labels)
    assert (both.base_labels, both.labels, both.n_base, both.first_word, both.last_word) == ("apache,cc-by,mit", "apache,cc-by,cc-by-nc-notice,mit", 3, 2, 9)
    assert license_scan.scan_licenses(small.nothing(spark)).count() == 0


def found_labels(text):
    automata = [license_scan.compile_template(k, t) for k, ts in license_scan.TEMPLATES.items() for t in ([ts] if isinstance(ts, str) else ts)]
    return set(filter(None, license_scan.scan(text, automata, {})[5].split(",")))


MIT = """Copyright (c) 2020 A. Person
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"),
to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,
and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
IN THE SOFTWARE."""


def test_whole_licences_need_every_sentence():
    texts = {"mit-text": MIT}
    for file, label in (
        ("Apache-2.0", "apache-2.0-text"), ("CC0-1.0", "cc0-1.0-text"), ("GPL-2", "gpl-2.0-text"), ("GPL-3", "gpl-3.0-text"),
        ("LGPL-2.1", "lgpl-2.1-text"), ("LGPL-3", "lgpl-3.0-text"), ("MPL-2.0", "mpl-2.0-text"),
    ):
        texts[label] = (license_scan.LICENSES / f"{file}.txt").read_text()
    plain = lambda t: license_scan._MARK.sub(" ", t.replace("<<var;", "some one <<var;"))
    for label in ("isc-text", "bsd-2-clause-text", "bsd-3-clause-text"):
        texts[label] = plain(license_scan.TEMPLATES[label])
    for label, text in texts.items():
        assert label in found_labels("x " + text + " y"), label
        words = text.split()
        for at in (0.3, 0.5, 0.8):
            k = int(len(words) * at)
            assert label not in found_labels(" ".join(words[:k] + words[k + 20 :])), label
        k = len(words) // 2
        assert label not in found_labels(" ".join(words[:k] + "but never on a Sunday nor in any month that has an R in it".split() + words[k:])), label
    assert "mit-text" not in found_labels(MIT.replace("The above copyright notice and this permission notice shall be included in all copies", ""))
    assert "mit-text" not in found_labels(MIT[: MIT.index("IN NO EVENT")])


def test_usual_notices():
    gnu = "you can redistribute it and/or modify it under the terms of the GNU %s Public License as published by the Free Software Foundation; "
    later = "either version %s of the License, or (at your option) any later version."
    assert found_labels(gnu % "General" + later % "3") == {"gpl-3.0-or-later-notice"}
    assert found_labels(gnu % "General" + later % "2") == {"gpl-2.0-or-later-notice"}
    assert found_labels(gnu % "General" + "version 2 of the License.") == {"gpl-2.0-only-notice"}
    assert found_labels(gnu % "Lesser General" + later % "2.1") == {"lgpl-2.1-or-later-notice"}
    assert found_labels(gnu % "Affero General" + later % "3") == {"agpl-3.0-or-later-notice"}
    assert found_labels("the terms of the Mozilla Public License, v. 2.0.") == set()
    assert found_labels("Licensed under the MIT license") == {"mit-notice"}


def test_versions_and_variants_are_told_apart():
    assert found_labels("Licensed under the Apache License, Version 2.0.") == {"apache-2.0-notice"}
    for text in ("Licensed under the Apache License, Version 1.1", "Licensed under the Apache License", "under the Apache License 2.0"):
        assert found_labels(text) == set()
    for other in ("http://www.mozilla.org/MPL/", "http://www.apache.org/licenses/LICENSE-1.1"):
        assert found_labels(f"you may not use this file except in compliance with the License. You may obtain a copy of the License at {other}") == set()
    assert found_labels("licensed under CC BY 4.0") == {"cc-by-notice"}
    for variant in ("NC", "SA", "ND", "NC-SA", "NC-ND"):
        assert found_labels(f"Licensed under CC BY-{variant} 4.0.") == {f"cc-by-{variant.lower()}-notice"}
    long = "licensed under a Creative Commons Attribution%s 4.0 International License"
    assert found_labels(long % "") == {"cc-by-notice"} and found_labels(long % "-NonCommercial-ShareAlike") == {"cc-by-nc-sa-notice"}
    found = license_scan.compile_template("t", "a <<beginOptional>>b c<<endOptional>>")
    words = [b"a", b"b", b"c", b"d"]
    assert list(found.passages(words, b" a b c d ")) == [(0, 3)] and found.longest_at(words, 1) == -1


def test_long_texts_are_scanned_in_proportion():
    import time

    automata = [license_scan.compile_template(k, t) for k, ts in license_scan.TEMPLATES.items() for t in ([ts] if isinstance(ts, str) else ts)]
    phrases = {b" mit license ": "mit"}
    started = time.process_time()
    found = license_scan.scan("mit license " * 400_000, automata, phrases)  # 5 MB
    assert found[1:4] == (400_000, 0, 799_998) and time.process_time() - started < 20


def test_sql_reads_whole_licences_and_near_misses(spark):
    import duckdb
    import pyarrow as pa

    whole = {p.stem: p.read_text() for p in license_scan.LICENSES.glob("*.txt")} | {"mit": MIT}
    texts = [None, "", "mit license apache license"]
    for text in whole.values():
        words = text.split()
        texts += [text, "so " + text + " and so on", " ".join(words[: len(words) // 2]), " ".join(words[:-30] + ["but", "not"] + words[-30:])]
        texts.append(" ".join(words[: len(words) // 3] + ["never"] + words[len(words) // 3 :]))
    texts += [whole["mit"] + "\n" + whole["Apache-2.0"], whole["mit"] + whole["mit"]]
    gnu = "redistribute it and/or modify it under the terms of the GNU %s Public License%s as published by the Free Software Foundation; "
    for name in ("General", "Lesser General", "Affero General"):
        for version in ("2", "2.0", "2.1", "3", "3.0"):
            for said in ("", f", version {version},"):
                texts += [gnu % (name, said) + f"either version {version} of the License, or (at your option) any later version."]
                texts += [gnu % (name, said) + f"version {version} of the License.", gnu % (name, said)]
    for cc in ("BY", "BY-NC", "BY-SA", "BY-ND", "BY-NC-SA", "BY-NC-ND", "BY-XX", "Attribution", "Attribution-NonCommercial-ShareAlike"):
        texts += [f"Licensed under a Creative Commons {cc} 4.0 International License", f"licensed under CC {cc}", f"licensed under the CC {cc} 3.0 Unported, then CC BY"]
    texts += [f"Licensed under the Apache License{v}" for v in ("", ", Version 2.0", " 2.0", ", Version 1.1")] + ["is Licensed under the terms of the MIT License"]
    rows = [(k, t) for k, t in enumerate(texts)]
    got = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4))
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": [k for k, _ in rows], "text": [t for _, t in rows]}))
    cursor = con.execute(license_scan.OP8_SQL)
    names = [d[0] for d in cursor.description]
    want = {r[names.index("doc_id")]: r for r in cursor.fetchall()}
    for r in got.collect():
        assert tuple(r[c] for c in names) == want[r.doc_id], texts[r.doc_id][:200]
    assert sum(r.score == 1.0 for r in got.collect()) > 60


# --- lines


def test_lines_match_brute_force(spark, docs, pairs):
    for batches, fan in ((1, 2), (4, 2), (5, 3)):
        out = line_dedup.drop_frequent_lines(docs, batches=batches, fan=fan, out=("score", "batch"))
        same([(r.doc_id, r.text, r.score, r.batch) for r in out.collect()], small.line_deduped(pairs))
    assert line_dedup.drop_frequent_lines(small.nothing(spark)).count() == 0


def test_runs_are_merged_without_a_shuffle(spark):
    runs = line_dedup.LineRuns(3, 2, buckets=4)
    batch = lambda low: spark.range(500).selectExpr("unhex(md5(cast(id % 90 as string))) AS hash", f"{low} - id AS doc")
    plans, keep = [], line_dedup.write_bucketed

    def watched(run, path, keys, buckets, dealt=False):
        plans.append((dealt, run._jdf.queryExecution().executedPlan().toString()))
        return keep(run, path, keys, buckets, dealt)

    line_dedup.write_bucketed = watched
    try:
        for low in (5000, 3000, 1000):
            runs.add(batch(low))
        found = runs.frequent()
    finally:
        line_dedup.write_bucketed = keep
    merges = [plan for dealt, plan in plans if dealt]
    assert len(merges) == 2 and all("Exchange" not in plan and plan.count("Bucketed: true") == 2 for plan in merges)
    anti = [plan for dealt, plan in plans if not dealt and "LeftAnti" in plan]
    assert anti and all("SortMergeJoin" in plan and "BroadcastHashJoin" not in plan for plan in anti)
    assert sorted((r.hash, r.keeper) for r in found.collect()) == sorted((r.hash, r.k) for r in batch(5000).groupBy("hash").agg(F.max("doc").alias("k")).collect())


def test_rows_without_an_id_have_lists_of_their_own(spark):
    common = "a line of forty characters and a few more, that is shared"
    rows = [(None, f"{common}\nown words of row {k} that make up a line of some length, kept", "x", k) for k in range(300)]
    rows += [(k, f"{common}\n{k}", "y", k) for k in range(600)] + [(7, common, "z", 0)] * 3
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, doc string, drops int").repartition(3)
    out = line_dedup.drop_frequent_lines(docs)
    same([(r.doc_id, r.text, r.dedup_n_lines, r.dedup_n_dropped) for r in out.collect()], small.line_deduped([r[:2] for r in rows]))
    assert out.columns == ["doc_id", "text", "doc", "drops", "dedup_n_lines", "dedup_n_dropped"]
    kept = []
    plain = line_dedup.stored
    line_dedup.stored = lambda df, what, *by: kept.append(plain(df, what, *by)) or kept[-1]
    try:
        line_dedup.drop_frequent_lines(docs).count()
    finally:
        line_dedup.stored = plain
    lines = kept[0]
    assert lines.where("doc = -9223372036854775808").groupBy("doc", "row").count().agg(F.max("count")).first()[0] == 2


# --- packing


def test_ids_and_windows(docs, pairs):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    rows = packing.pack(docs, TOKENIZER, with_ids=True).collect()
    want = Counter(zlib.crc32(array("I", [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]).tobytes()) for _, t in pairs)
    by_doc = {}
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(array("I", r.ids).tobytes()) and len(r.ids) == r.length
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    got = Counter()
    for found in by_doc.values():
        pieces = sorted(found, key=lambda r: r.start)
        copies = Counter(r.start for r in pieces)[0]
        starts = sorted({r.start for r in pieces})
        if copies == 1:
            assert [r.start for r in pieces] == starts
            got[zlib.crc32(array("I", [i for r in pieces for i in r.ids]).tobytes())] += 1
    assert not got - want
    assert sum(r.length for r in rows) == sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in pairs)
    windows = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_ids_of_marked_letters():
    model, encode = Tokenizer.from_file(TOKENIZER), packing.word_encoder(TOKENIZER)
    read = lambda text: list(array("I", encode(text)))
    marks = [chr(c) for c in range(0x300, 0x370)]
    draw = random.Random(6)
    pool = [*"ATHJWYXZathjwyé \n.,!1", *marks]
    texts = [f"{a}{m}x and {a}{m}{n}" for a in map(chr, range(65, 91)) for m, n in zip(marks, marks[1:])]
    texts += ["".join(draw.choice(pool) for _ in range(draw.randint(0, 30))) for _ in range(3000)] + ["T\u0344 <|x T\u0308"]
    for text in texts:
        assert read(text) == model.encode(text, add_special_tokens=False).ids, ascii(text)


def test_windows_do_not_depend_on_what_is_asked(spark, docs):
    with_ids = [tuple(r)[:-1] for r in packing.pack(docs, TOKENIZER, with_ids=True).collect()]
    same(map(tuple, packing.pack(docs, TOKENIZER).collect()), with_ids)


def test_best_fit_takes_the_tightest_window():
    draw = random.Random(4)
    for _ in range(30):
        lengths = array("I", [draw.randint(1, 64) for _ in range(draw.randint(0, 120))])
        windows, offsets, n = packing.best_fit_decreasing(lengths, list(range(len(lengths))), 64)
        room, placed = [], {}
        for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
            fits = [c for c in room if c >= lengths[i]]
            if fits:
                room.remove(min(fits))
                room.append(min(fits) - lengths[i])
            else:
                room.append(64 - lengths[i])
        for i, w in enumerate(windows):
            placed.setdefault(w, []).append((offsets[i], lengths[i]))
        assert len(room) == n and sorted(64 - sum(x for _, x in p) for p in placed.values()) == sorted(room)


def test_pack_of_nothing(spark):
    assert packing.pack(small.nothing(spark), TOKENIZER).count() == 0


def test_toxicity_reads_long_words_whole():
    long = "".join(chr(97 + i * 7 % 26) for i in range(1003))
    pieces = toxicity.words_of(f"short {long} end")
    assert pieces[0] == "short" and pieces[-1] == "end" and max(map(len, pieces)) == toxicity.LONGEST
    step = toxicity.LONGEST // 2
    assert pieces[1] + "".join(p[step:] for p in pieces[2:-1]) == long
    assert toxicity.words_of("a" * toxicity.LONGEST) == ["a" * toxicity.LONGEST]
    assert toxicity.words_of(None) == []
