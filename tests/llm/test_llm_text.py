import random

import numpy as np
import pytest
from sqlcheck import SF, compare

from ambitus.llm import leakage, lookalike, mixing, queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_as_sql(spark, name):
    compare(spark, queries.QUERIES[name], queries.SQL[name])


def test_suffix_array_sorts_suffixes():
    rng = np.random.default_rng(1)
    text = rng.integers(1, 4, 300).astype(np.int32)
    sa = leakage.suffix_array(text, 12).tolist()
    keys = [tuple(text[i : i + 12]) for i in sa]
    assert sorted(sa) == list(range(300)) and keys == sorted(keys)


def test_leaks_same_as_brute_force(spark):
    rng = random.Random(7)
    vocab = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choices(vocab, k=25)), None if i == 3 else " ".join(rng.choices(vocab, k=14))) for i in range(8)]
    docs = []
    for d in range(60):
        ws = rng.choices([*vocab, "zz", "yy"], k=40)
        if d % 3 == 0:
            src = items[rng.randrange(8)][1].split()
            s, n = rng.randrange(0, 12), rng.choice([10, 11, 12, 13])
            ws[5 : 5 + n] = src[s : s + n]
        docs.append((d, " ".join(ws)))
    docs += [(900, None), (901, ""), (902, items[0][1].upper().replace(" ", "\n> ")), (903, "<p>" + items[1][1].replace(" ", "&nbsp;<b>") + "</b>"), (904, items[2][1].replace("w", "​w").replace(" ", "\\n"))]
    docs.append(docs[0])
    want = set()
    for d, text in docs:
        w = leakage.words(text)
        for i, *fields in items:
            grams = {tuple(f.split()[k : k + 12]) for f in fields if f for k in range(len(f.split()) - 11)}
            if any(tuple(w[k : k + 12]) in grams for k in range(len(w) - 11)):
                want.add((d, i))
    D, I = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, prompt string, answer string")
    leaks = leakage.find_leaks(D.selectExpr("*", "1 AS item_id"), "doc_id", "text", I, "item_id", ["prompt", "answer"], shard_words=200)
    assert {(r["doc_id"], r["item_id"]) for r in leaks.collect()} == want and {902, 903, 904} <= {d for d, _ in want}
    assert leakage.remove_leaked(D, leaks, "doc_id").count() == len([d for d, _ in docs if d not in {x for x, _ in want}])
    assert leakage.find_leaks(D, "doc_id", "text", I.limit(0), "item_id", ["prompt"]).count() == 0


def test_long_tags_and_comments():
    passage = " ".join(f"w{i}" for i in range(12))
    link = passage.replace("w5", f'<a href="{"x" * 5_000}">w5</a>').replace("w8", f"<!-- {'y ' * 3_000} -->w8")
    assert leakage.words(link) == passage.split()
    assert leakage.words("a <!-- b") == ["a", "b"] and leakage.words("<" * 200_000 + "z") == ["z"] and leakage.words("<!--" * 100_000)[:1] == []


def test_matches_by_portions(spark):
    """However few matches are looked at together, and however small the shards, the same runs are found."""
    items = [(i, f"do all of the following steps with great care and without any haste now {i} end", None) for i in range(30)]
    docs = [(d, items[d % 30][1] + " other words " + items[(d * 7) % 30][1]) for d in range(40)]
    tests = leakage.Passages([(i, "prompt", t) for i, t, _ in items], 12)
    text = np.concatenate([np.array([tests.ids.get(w, 0) for w in leakage.words(t)] + [0], np.int32) for _, t in docs])
    found = [sorted((int(q), int(a), int(n)) for part in leakage.search_shard(tests, text, k) for q, a, n in zip(*part)) for k in (1, 50, 10**7)]
    assert found[0] == found[1] == found[2] and len(found[0]) >= 40 * 30


def test_lookalikes(spark):
    long = "x" * 100_000
    rows = [(1, "Café de  1"), (2, "Café de  1"), (3, "Ｃafé de  1"), (4, "Cafe de  1"), (5, "café de  1"), (6, "C­afé de  1"), (7, "Café de  1"), (8, None), (9, ""), (10, "​"), (11, "Сafé de  1"), (12, "ﬁx"), (13, "fix"), (14, long), (15, long + "‍"), (2, "Café de  1"), (16, "Café de 1")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 AS member", "8 AS class_id")
    same = [1, 2, 3, 6, 7, 11]
    want = {(a, b) for a in same for b in same if a < b} - {(1, 7)} | {(12, 13), (14, 15)}
    assert {tuple(r) for r in lookalike.lookalike_pairs(df, "doc_id", "text").collect()} == want
    canon = {r["doc_id"]: r["canonical_text"] for r in lookalike.canonical_text(df.where("doc_id in (1, 2, 5, 8)"), "doc_id", "text").collect()}
    assert canon == {1: "Café de  1", 2: "Café de  1", 5: "café de  1", 8: None}
    assert lookalike.lookalike_pairs(df.limit(0), "doc_id", "text").collect() == []


def test_water_filling():
    got = mixing.water_fill({"a": 100, "b": 1000, "c": 50}, {"a": 0.5, "b": 0.3, "c": 0.2}, {"a": 2, "b": 1, "c": 4}, 1000)
    assert got == {"a": 200.0, "c": 200.0, "b": 600.0}
    assert mixing.water_fill({"a": 10}, {"a": 1.0, "x": 0.5}, {"a": 3, "x": 2}, 500) == {"a": 30.0, "x": 0.0}
    assert mixing.water_fill({}, {"a": 0.0}, {}, 5) == {"a": 0.0}


def test_mix(spark):
    rows = [(i, "some words here " * (i % 7), "A-a" if i % 3 else " b_B ") for i in range(90)] + [(500, None, "b b"), (501, "x", None), (502, "y", "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS copies")
    targets = spark.createDataFrame([("a_a", 0.3, 1), ("b_b", 0.7, 2), ("none_here", 0.1, 3), (None, 0.5, 1)], "source string, target_share double, max_repeats int")
    used, report = mixing.mix(docs, "doc_id", "text", "source", targets)
    again, _ = mixing.mix(docs, "doc_id", "text", "source", targets)
    a, r = sorted(map(tuple, used.collect())), {x["source"]: x for x in report.collect()}
    assert a == sorted(map(tuple, again.collect())) and set(r) == {"a_a", "b_b", "none_here"}
    assert all(c <= {"a_a": 1, "b_b": 2}[s] for _, s, _, c in a) and r["b_b"]["clamped"] and r["none_here"]["tokens"] == 0
    total = sum(n * c for _, _, n, c in a)
    assert abs(sum(x["tokens"] for x in r.values()) - total) == 0 and abs(sum(x["actual_share"] for x in r.values()) - 1) < 1e-9
    wanted = mixing.water_fill({s: r[s]["available_tokens"] for s in r}, {s: r[s]["target_share"] for s in r}, {"a_a": 1, "b_b": 2, "none_here": 3}, sum(r[s]["available_tokens"] for s in r))
    assert all(abs(r[s]["tokens"] - wanted[s]) <= 30 for s in r)
    assert mixing.repeat_rows(used).count() == sum(c for *_, c in a)
    assert mixing.mix(docs.limit(0), "doc_id", "text", "source", targets)[0].count() == 0


def test_queries_run(spark):
    for name in ("p7_leaked_items", "p8_mix_shares", "p6_misses"):
        assert queries.QUERIES[name](spark, SF).count() > 0
