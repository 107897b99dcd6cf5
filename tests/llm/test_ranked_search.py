import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from vecloom.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_ranking(docs, items, k):
    found = [(i, Counter(terms(t))) for i, t in docs]
    found = [(i, c) for i, c in found if c]
    n, total = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    for item, wanted in asked.items():
        scores = []
        for i, c in found:
            m = 50 + 50 * sum(c.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in wanted if c[t])
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def corpus():
    draw = random.Random(11)
    common = [f"w{i}" for i in range(12)]
    rare = [f"Rare{i}É" for i in range(300)]
    rows = []
    for i in range(700):
        n = draw.choice([0, 1, 5, 30, 200])
        rows.append((i * 7 % 701, " ".join(draw.choice(common if draw.random() < 0.8 else rare) for _ in range(n)).replace("w3 ", "w3--W3\n")))
    rows += [(2000 + i, "one same text of w1 w2 rare5É") for i in range(120)] + [(3000, None), (3001, ""), (None, "w1 Rare7É"), (3002, "w1 " * 20000 + "rare9é"), (5, rows[5][1])]
    draw.shuffle(rows)
    items = [(i, " ".join(draw.choice(rare + common) for _ in range(25))) for i in range(20)]
    return rows, items + [(20, None), (21, "not there at all?!"), (22, "same SAME text"), (22, "of"), (None, "rare7É"), (23, "w1"), (24, "RARE9é w1")]


def items_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 3) for r in rows], "item_id bigint, text string, score string, terms int")


def test_ranking_equals_plain_scores(spark, docs_of):
    rows, items = corpus()
    docs, queries = docs_of(rows).repartition(3), items_of(spark, items)
    for k, shard_bytes in ((50, 1 << 14), (7, 8 << 20), (1, 1 << 12)):
        found = ranked_search.search(ranked_search.build(docs, shard_bytes=shard_bytes), queries, k=k, block_terms=100).collect()
        assert sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in found], key=str) == plain_ranking(rows, items, k)


def test_empty_tables(spark, docs_of):
    rows, items = corpus()
    assert ranked_search.rank(docs_of([]), items_of(spark, items)).count() == 0
    assert ranked_search.rank(docs_of(rows), items_of(spark, [])).count() == 0
    assert ranked_search.rank(docs_of([(1, None), (2, "...")]), items_of(spark, items)).count() == 0


def shard_of(n, seed=3):
    draw = random.Random(seed)
    texts = [" ".join([f"t{draw.randint(0, 40)}" for _ in range(60)] + (["needle pin"] if i % 997 == 5 else [])) for i in range(n)]
    return ranked_search.Shard.of(pa.array(range(n), pa.int64()), pa.array(texts)), texts


def test_intervals_below_the_best_are_not_opened():
    shard, texts = shard_of(8000)
    wanted, _ = ranked_search.text_terms(pa.array(["needle pin t1"]))
    held, places = ranked_search.found_in(shard.terms, np.sort(wanted))
    lists = ranked_search.Lists(shard, places, len(texts), int(shard.lengths.sum()))
    df = shard.start[places + 1] - shard.start[places]
    weights = np.array([ranked_search.weight(int(d), len(texts)) for d in df])
    docs, scores = lists.best(np.arange(3), weights, 5, 1)
    opened = lists.opened
    every, whole = lists.whole(lists.begin[None], lists.end[None], weights)
    order = np.lexsort((every, -whole))[:5]
    assert docs.tolist() == every[order].tolist() and scores.tolist() == whole[order].tolist()
    assert set(docs.tolist()) <= set(range(5, 8000, 997))
    postings = int(df.sum())
    assert opened < postings / 50
    lists.best(np.arange(3), weights, 5, int(scores[-1]) + 1)
    assert lists.opened <= opened


def test_range_maximum():
    shard, _ = shard_of(300)
    lists = ranked_search.Lists(shard, np.arange(len(shard.terms)), 300, int(shard.lengths.sum()))
    draw = random.Random(1)
    for _ in range(500):
        t = draw.randrange(len(lists.begin))
        a, b = sorted(draw.randint(lists.begin[t], lists.end[t]) for _ in range(2))
        place, value = lists.largest(np.array([a]), np.array([b]))
        part = lists.impact[a:b]
        assert value[0] == (part.max() if len(part) else 0)
        assert not len(part) or (a <= place[0] < b and lists.impact[place[0]] == value[0])


def test_shards_come_back_as_written(tmp_path):
    shard, _ = shard_of(100)
    again = ranked_search.Shard.read(shard.write(str(tmp_path)))
    for name in ("terms", "start", "docs", "tf", "lengths"):
        assert np.array_equal(getattr(shard, name), getattr(again, name))
    assert shard.ids.equals(again.ids)
