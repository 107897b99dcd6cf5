import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from llm_reference import near_components, shingle_set

from vecloom.llm import ngram_join
from vecloom.llm.shingles import shingle_sets


def family(rng, base, changes):
    words = base.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"w{rng.randrange(500)}"
    return " ".join(words)


def corpus(seed=3):
    rng = random.Random(seed)

    def text(n):
        return " ".join(f"w{rng.randrange(500)}" for _ in range(n))

    passage = text(60)
    texts = [text(rng.choice([1, 3, 4, 5, 6, 12, 40, 90])) for _ in range(40)]
    for size in (6, 40, 130):
        base = text(size)
        texts += [family(rng, base, rng.randrange(4)) for _ in range(30)]
    texts += [f"{text(20)} {passage} {text(rng.randrange(12))}" for _ in range(30)]
    texts += [None, "", " \t\n ", "Ünï CODE", "ünï code", texts[0], texts[0].upper(), texts[0].replace(" ", "\n\n")]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("long, cells", [(64, 16), (2, 16), (1, 6)])
def test_equals_all_pairs(docs_of, long, cells):
    rows = corpus()
    found = ngram_join.join(docs_of(rows), cells_log2=cells, long=long).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == near_components(rows)


def test_keeps_one_of_each_group(docs_of):
    rows = corpus(5)
    docs = docs_of(rows)
    kept = ngram_join.keep_one(docs)
    want = {i for i, (_, c) in near_components(rows).items() if c == i}
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == want


def test_null_and_repeated_ids(docs_of):
    same = "one two three four five six seven"
    rows = [(None, same), (4, same), (4, same), (None, None), (7, "other words stand here alone today"), (7, same), (None, "a b")]
    found = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in ngram_join.join(docs_of(rows)).collect())
    assert found == sorted([(-1, 3, 4), (4, 3, 4), (4, 3, 4), (-1, 0, -1), (7, 2, 7), (7, 3, 4), (-1, 1, -1)])
    kept = sorted((r.doc_id or -1, r.text or "") for r in ngram_join.keep_one(docs_of(rows)).collect())
    assert kept == sorted([(4, same), (4, same), (-1, ""), (7, "other words stand here alone today"), (-1, "a b")])


def test_empty_table(docs_of):
    assert ngram_join.join(docs_of([])).count() == 0


def test_merge_counts_and_probe():
    lists = [[1, 4, 9], [4, 9], [4], []]
    assert ngram_join.merge_short(lists, 1) == [(1, 1), (4, 3), (9, 2)]
    assert ngram_join.merge_short(lists, 2) == [(4, 3), (9, 2)]
    assert ngram_join.probe_long(np.array([3, 5, 8]), np.array([1, 5, 8, 11])) == 2
    assert ngram_join.probe_long(np.array([3]), np.array([], np.int64)) == 0


def test_prefixes_share_what_is_counted_on():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randrange(1, 200)
        a = rng.sample(range(1000), n)
        b = [x for x in a if rng.random() < 0.93] + rng.sample(range(1000, 2000), rng.randrange(0, n // 9 + 1))
        common, union = len(set(a) & set(b)), len(set(a) | set(b))
        if b and 100 * common >= 80 * union:
            cut = [set(sorted(x)[: len(x) - ngram_join.least_overlap(len(x)) + ngram_join.shared(len(x))]) for x in (a, b)]
            assert len(cut[0] & cut[1]) >= ngram_join.shared(min(len(a), len(b)))


def links_found(spark, sets, labels):
    """Pairs that remaining_links finds among ``sets``: cid to shingles."""
    frame = spark.createDataFrame([(c, list(s)) for c, s in sets.items()], "cid bigint, set array<bigint>")
    known = spark.createDataFrame(list(labels.items()), "node bigint, label bigint")
    return {(r.a, r.b) for r in ngram_join.remaining_links(frame, known, ngram_join.PERCENT).collect()}


def joined_labels(labels, nodes, links):
    """Labels after the links, as a partition of the nodes."""
    parent = {c: labels.get(c, c) for c in nodes}
    for a, b in links:
        x, y = parent[a], parent[b]
        parent = {c: min(x, y) if p in (x, y) else p for c, p in parent.items()}
    return {frozenset(c for c in nodes if parent[c] == p) for p in parent.values()}


def true_links(sets, labels):
    out = set()
    for a, b in itertools.combinations(sets, 2):
        common = len(set(sets[a]) & set(sets[b]))
        if labels.get(a, a) != labels.get(b, b) and 100 * common >= 80 * (len(set(sets[a])) + len(set(sets[b])) - common):
            out.add((a, b))
    return out


def test_links_across_split_main_lists(spark):
    # Shingles 1 to 40 are led by the component of class 1, 41 to 80 by that of class 2.
    sets = {1: range(1, 81), 2: range(1, 101)}
    sets |= {c: [*range(1, 41), *range(1000 * c, 1000 * c + 40)] for c in range(10, 13)}
    sets |= {c: [*range(41, 81), *range(1000 * c, 1000 * c + 60)] for c in range(20, 23)}
    labels = {c: 1 if c == 1 or 10 <= c < 20 else 2 for c in sets}
    assert {frozenset(p) for p in links_found(spark, sets, labels)} == {frozenset((1, 2))}


@pytest.mark.parametrize("chunk", [4096, 7])
def test_remaining_links_join_what_all_pairs_join(spark, monkeypatch, chunk):
    monkeypatch.setattr(ngram_join, "CHUNK", chunk)
    monkeypatch.setattr(ngram_join, "ASKING", 5)
    rng = random.Random(7)
    sets = {}
    for group in range(6):
        base = rng.sample(range(10_000), 60)
        for i in range(20):
            kept = [x for x in base if rng.random() < rng.choice([1.0, 0.97, 0.9, 0.8])]
            sets[100 * group + i] = kept + rng.sample(range(20_000, 90_000), rng.randrange(8))
    labels = {c: c % 5 + 1000 * (c // 100) for c in sets if c % 4}
    found, want = links_found(spark, sets, labels), true_links(sets, labels)
    assert want and all((min(p), max(p)) in want for p in found)
    assert joined_labels(labels, sets, found) == joined_labels(labels, sets, want)


def test_a_loose_group_hands_on_links_only(spark):
    rng = random.Random(3)
    base = rng.sample(range(10_000), 100)
    sets = {c: rng.sample(base, 70) + rng.sample(range(20_000, 10**6), 30) for c in range(150)}
    assert true_links(sets, {}) == set() == links_found(spark, sets, {})


def test_shingles_equal_word_tuples():
    texts = ["A b c d e f", "a B c\td  e\nf", "x", "", None, "É é", "é É", "a" * 5000 + " b", "b c d e f a b c d e f"]
    sets = shingle_sets(pa.array(texts), 5)
    assert [len(s) for s in sets] == [len(shingle_set(t)) for t in texts]
    assert np.array_equal(sets[0], sets[1])
    assert not np.array_equal(sets[5], sets[6])
    assert len(np.intersect1d(sets[0], sets[8])) == len(shingle_set(texts[0]) & shingle_set(texts[8]))
