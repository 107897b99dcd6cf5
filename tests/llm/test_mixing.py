from collections import Counter, defaultdict

import pytest

from vecloom.llm import mixing


def water_filled(sizes, weights, share, cap):
    """Targets by the plain loop: sources above their cap are set to it, the excess is shared again."""
    left, full = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in sizes if s not in full]
        total = sum(weights[s] for s in rest)
        given = {s: weights[s] * (left - sum(full.values())) / total if total else 0.0 for s in rest}
        above = [s for s in rest if given[s] > cap * sizes[s]]
        if not above:
            return full | given
        full |= {s: float(cap * sizes[s]) for s in above}


def made(spark, rows):
    data = [(i, t, s, 1, "x", 2.5) for i, t, s in rows]
    return spark.createDataFrame(data, "doc_id bigint, text string, source string, copies int, size string, target double")


def words(n):
    return " \t\n".join(f"w{k}" for k in range(n)) + "\r\n"


def corpus():
    rows = [(i, words(1 + i * i % 97), f"s{i % 3}") for i in range(900)]
    rows += [(i, words(3), "S") for i in range(900, 905)] + [(905, words(4000), "ß"), (906, words(9), None)]
    rows += [(907, None, "s0"), (908, "", "s0"), (909, " \n\x0b", "empty"), (None, words(12), "s1"), (910, "a b", "s2")]
    return rows + [(911, words(50), "s0")] * 400


def test_words_taken_meet_targets(spark):
    rows = corpus()
    found = mixing.decide(made(spark, rows)).collect()
    size = {(i, s): len([w for w in t.replace("\x0b", " ").replace(" ", "_").split()]) if t else 0 for i, t, s in rows}
    held, longest = Counter(), defaultdict(int)
    for i, _, s in rows:
        held[s] += size[i, s]
        longest[s] = max(longest[s], size[i, s])
    order = sorted(held, key=lambda s: (s is None, s or ""))
    weights = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(order)}
    want = water_filled(held, weights, 1.5, 2)
    source_of = {i: s for i, _, s in rows}
    assert len(found) == len(rows)
    taken = Counter()
    for r in found:
        s = source_of[r.doc_id]
        assert r.size == size[r.doc_id, s] and r.source_size == held[s] and r.target == pytest.approx(want[s], rel=1e-12)
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        taken[s] += r.taken
    for s in held:
        assert abs(taken[s] - want[s]) <= longest[s] + 1
    assert sum(want.values()) == pytest.approx(1.5 * sum(held.values()))


def test_copies_do_not_depend_on_partitions(spark):
    def rows(df):
        return sorted(map(str, mixing.decide(df).collect()))

    df = made(spark, corpus())
    assert rows(df.repartition(1)) == rows(df.repartition(13)) == rows(df.orderBy("size", "doc_id"))
    other = sorted(map(str, mixing.decide(df, seed="again").collect()))
    assert other != rows(df)


def test_mixed_rows_keep_their_columns(spark):
    df = made(spark, corpus())
    out = mixing.mix(df, {"s0": 1, "s1": 4, None: 2}, share=0.5)
    assert out.schema == df.schema
    copies = Counter({r.doc_id: 0 for r in df.collect()})
    decided = Counter()
    for r in mixing.decide(df, {"s0": 1, "s1": 4, None: 2}, share=0.5).collect():
        decided[r.doc_id] += r.copies
    for r in out.collect():
        copies[r.doc_id] += 1
    assert copies == decided and sum(copies.values()) > 100
    assert not [r for r in out.collect() if r.source in ("s2", "S", "ß")]


def test_empty_table_and_tables_without_words(spark):
    assert mixing.decide(made(spark, [])).count() == 0 and mixing.mix(made(spark, [])).count() == 0
    assert [(r.taken, r.target) for r in mixing.decide(made(spark, [(1, None, None), (2, "", "a")])).collect()] == [(0, 0.0)] * 2


def test_targets_for_a_share_at_the_cap(spark):
    sources = spark.createDataFrame([("=a", 10), ("=b", 0), ("", 7)], "_source string, _words bigint")
    assert {r["_source"]: r["_target"] for r in mixing.targets(sources, share=2.0).collect()} == {"=a": 20.0, "=b": 0.0, "": 14.0}


def test_main_path_is_native(spark, plan_of):
    plan = plan_of(mixing.decide(made(spark, corpus())))
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
