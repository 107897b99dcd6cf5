import hashlib
import re
import string

from vecloom.llm import decontamination, digest_index

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def leaks(text, items, window=10):
    found, hit, names = words(text), set(), set()
    for item, other in items:
        w = words(other)
        n = min(len(w), window)
        grams = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(found) - n + 1):
            if n and tuple(found[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                names.add(str(item))
    return len(found), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


ITEMS = [(1, "One two three four five six seven eight nine TEN eleven"), (2, "élan, Vital"), (10, "x"), (3, None), (4, "..."), (5, "one two three four five six seven eight nine ten")]
TEXTS = [
    "zero one-two three\nfour five six seven eight nine ten eleven twelve one two three four five six seven eight nine ten",
    "ÉLAN vital élan VITAL",
    "X marks; x",
    None,
    "",
    "?!",
    "one two three four five six seven eight nine",
    "élan vital x",
]


def test_decontamination_equals_plain_search(spark, docs_of):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    rows = list(enumerate(TEXTS))
    for blocks in (200_000, 2):
        found = decontamination.report(docs_of(rows), items, block_windows=blocks).collect()
        assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found} == {i: leaks(t, ITEMS) for i, t in rows}


def test_documents_or_spans_leave(spark, docs_of):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = docs_of([(1, "Before: élan,\nvital! After."), (2, "clean"), (None, None), (None, "x"), (2, "clean"), (2, "x y")])
    kept = decontamination.drop_documents(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, ""), (2, "clean"), (2, "clean")]
    left = decontamination.remove_spans(docs, items)
    assert sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == [(0, ""), (0, ""), (1, "Before! After."), (2, " y"), (2, "clean"), (2, "clean")]


def test_repeated_rows_and_empty_tables(spark, docs_of):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    rows = [(1, "x"), (1, "x"), (1, "y"), (None, "x")]
    assert sorted((r.doc_id or 0, r.n_hit) for r in decontamination.report(docs_of(rows), items).collect()) == [(0, 1), (1, 0), (1, 1), (1, 1)]
    assert decontamination.report(docs_of([]), items).count() == 0
    assert [r.n_hit for r in decontamination.report(docs_of(rows[:1]), items.limit(0)).collect()] == [0]


def decisions(found):
    return sorted((r.doc_id is None, r.doc_id or 0, -1 if r.keep_id is None else r.keep_id, r.group_size, r.kept) for r in found.collect())


def test_exact_dedup(docs_of):
    rows = [(3, "a  b"), (1, "a\t\nb"), (2, "a b"), (4, " a b"), (5, None), (6, ""), (7, "A b")]
    found = digest_index.decide(docs_of(rows))
    assert decisions(found) == [(False, 1, 1, 3, True), (False, 2, 1, 3, False), (False, 3, 1, 3, False), (False, 4, 4, 1, True), (False, 5, 5, 2, True), (False, 6, 5, 2, False), (False, 7, 7, 1, True)]


def test_exact_dedup_of_null_and_repeated_ids(docs_of):
    rows = [(None, "a"), (2, "a"), (2, "a"), (None, "b"), (None, "b"), (2, "c")]
    found = digest_index.decide(docs_of(rows))
    assert decisions(found) == [(False, 2, 2, 1, True), (False, 2, 2, 3, False), (False, 2, 2, 3, True), (True, 0, -1, 2, False), (True, 0, -1, 2, True), (True, 0, 2, 3, False)]
    kept = digest_index.deduplicate(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, "b"), (2, "a"), (2, "c")]
    assert digest_index.deduplicate(docs_of([])).count() == 0


def test_index_persists(spark, docs_of, tmp_path):
    path = str(tmp_path / "index")
    first = digest_index.deduplicate(docs_of([(1, "a"), (2, "b"), (3, "b")]), digest_index.DigestIndex(spark, path, 4))
    assert sorted(r.doc_id for r in first.collect()) == [1, 2]
    again = digest_index.DigestIndex(spark, path, 4)
    found = digest_index.decide(docs_of([(0, "b"), (9, "c"), (8, "c")]), again)
    assert decisions(found) == [(False, 0, 2, 1, False), (False, 8, 8, 2, True), (False, 9, 8, 2, False)]
    assert again.rows().count() == 3


def test_index_is_not_shuffled(spark, docs_of, tmp_path, plan_of):
    index = digest_index.DigestIndex(spark, str(tmp_path / "index"), 4)
    groups = digest_index.digests(docs_of([(1, "a")]))
    plan = plan_of(index.new_groups(groups))
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") <= 1
