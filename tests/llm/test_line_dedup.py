import random

from vecloom.llm import line_dedup


def removed(rows, percent=80):
    """(doc_id, text) to line numbers that an earlier line matches, all pairs of lines compared."""
    earlier, out = [], {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        gone = []
        for i, line in enumerate((text or "").split("\n")):
            words = frozenset(line.split())
            if words:
                if any(100 * len(words & o) >= percent * len(words | o) for o in earlier):
                    gone.append(i)
                earlier.append(words)
        out[doc_id, text] = gone
    return out


def corpus(seed):
    rng = random.Random(seed)

    def line(n):
        return " ".join(f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(n))

    pool = [line(rng.choice([1, 2, 4, 5, 9, 10, 25, 200])) for _ in range(60)]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(rng.randrange(0, 7)):
            text = rng.choice(pool).split()
            for _ in range(rng.randrange(4) if rng.random() < 0.5 else 0):
                text[rng.randrange(len(text))] = f"z{rng.randrange(30)}"
            rng.shuffle(text)
            lines.append((" " * rng.randrange(3)).join(["", *text]) if rng.random() < 0.2 else " ".join(text))
            lines += [""] * (rng.random() < 0.2)
        rows.append((i, "\n".join(lines)))
    return rows


def as_read(found):
    return {r.doc_id: (r.n_lines, r.n_removed, list(r.removed)) for r in found.collect()}


def test_equals_all_pairs(docs_of):
    rows = corpus(1) + corpus(2)
    rows = list(enumerate(t for _, t in rows))
    want = removed(rows)
    found = as_read(line_dedup.decide(docs_of(rows)))
    assert found == {i: (len(t.split("\n")), len(want[i, t]), want[i, t]) for i, t in rows}


def test_lines_leave_the_text(docs_of):
    rows = [(2, "a b c d e\nq r\n\nlast words"), (1, "e d c b a\n\nx"), (3, "q r"), (4, None), (5, "")]
    docs = docs_of(rows)
    kept = line_dedup.remove_lines(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id: r.text for r in kept.collect()} == {1: "e d c b a\n\nx", 2: "q r\n\nlast words", 3: "", 4: None, 5: ""}


def test_null_and_repeated_ids(docs_of):
    rows = [(None, "one two"), (5, "two one\nthree"), (5, "two one\nthree"), (None, None)]
    found = sorted(((r.doc_id or -1), r.n_lines, list(r.removed)) for r in line_dedup.decide(docs_of(rows)).collect())
    assert found == [(-1, 1, []), (-1, 1, [0]), (5, 2, [])]


def test_empty_table(docs_of):
    assert line_dedup.decide(docs_of([])).count() == 0


def test_no_python_on_the_main_path(docs_of, plan_of):
    plan = plan_of(line_dedup.decide(docs_of([(1, "a b")])))
    assert "Python" not in plan and "Arrow" not in plan


def test_a_family_is_not_verified_pair_by_pair(spark, docs_of, monkeypatch):
    """One earlier partner settles a line: word sets are joined to about a pair per line, and texts are not shuffled."""
    words = [f"w{k}" for k in range(40)]
    rows = [(i, " ".join([*words[:20], f"x{i}", *words[21:]])) for i in range(60)] + [(100 + i, f"lone{i} line{i}") for i in range(5)] + [(200, "q1 q2 q3 q4 q5"), (201, "q1 q2 q3 q4 z5")]
    made, cut = [], line_dedup.cut_lineage

    def counting(df):
        out = cut(df)
        made.append((df.columns, out))
        return out

    monkeypatch.setattr(line_dedup, "cut_lineage", counting)
    monkeypatch.setattr(line_dedup, "sets_of", lambda *a, f=line_dedup.sets_of: asked.append(a[2].count()) or f(*a))
    asked = []
    found = as_read(line_dedup.decide(docs_of(rows)))
    want = removed(rows)
    assert found == {i: (1, len(want[i, t]), want[i, t]) for i, t in rows}
    pairs = next(t for c, t in made if c == ["a", "b", "met"]).count()
    settled, rest = [t.count() for c, t in made if c == ["key"]][-2:]
    assert asked == [60] and pairs == 60 * 59 // 2 and settled == 59 and rest == 0


def test_a_large_family_is_not_listed_pair_by_pair(docs_of, monkeypatch):
    """Lines that the earliest of a large group settles ask for no pairs, whichever words differ; results stay whole."""
    rng = random.Random(5)
    words = [f"w{k}" for k in range(40)]
    rows = [(0, " ".join(words))]
    for i in range(1, 300):
        at = rng.randrange(40)
        rows.append((i, "\t ".join([*words[:at], f"x{i}", *words[at + 1 :]])))
    rows += [(300, "w0 w1 w2 w3 w4 lone"), (301, " ".join(words[:30])), (302, " ".join(words[:31]))]
    made, cut = [], line_dedup.cut_lineage

    def counting(df):
        out = cut(df)
        made.append((df.columns, out))
        return out

    monkeypatch.setattr(line_dedup, "cut_lineage", counting)
    found = as_read(line_dedup.decide(docs_of(rows)))
    want = removed(rows)
    assert found == {i: (1, len(want[i, t]), want[i, t]) for i, t in rows}
    assert next(t for c, t in made if c == ["a", "b", "met"]).count() < 10 * len(rows)
