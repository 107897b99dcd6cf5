import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from vecloom.llm import quality, toxicity


def triple_kernel(a, b):
    """The string kernel by its definition: all triples within reach, weighted by their gaps."""

    def features(word):
        codes, out = toxicity.letter_codes(np.array([ord(c) for c in word], np.int64)).tolist(), {}
        for i in range(len(codes)):
            for j in range(i + 1, len(codes)):
                for k in range(j + 1, min(len(codes), i + toxicity.REACH)):
                    if codes[i] and codes[j] and codes[k]:
                        t = (codes[i], codes[j], codes[k])
                        out[t] = out.get(t, 0) + toxicity.DECAY ** (k - i - 2)
        return out

    x, y = features(a), features(b)
    norm = np.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
    return sum(v * y.get(t, 0) for t, v in x.items()) / norm if norm else 0


def test_kernel_equals_its_definition():
    words = ["idiot", "id.iot", "i-d-i-o-t", "idiots", "banana", "ab", "", "élèves", "x1y2z3", "aaaaaa"]
    window, triple, weight, _ = toxicity.normalised(words)
    rows = np.zeros((toxicity.CODES, len(words)))
    rows[triple, window] = weight
    found = toxicity.kernel(words, rows)
    assert np.allclose(found, [[triple_kernel(a, b) for b in words] for a in words])


def labelled_texts(seed, n):
    rng = random.Random(seed)

    def word():
        return "".join(rng.choice(["an", "er", "tho", "in", "le", "que", "st"]) for _ in range(rng.randrange(1, 5)))

    rows = []
    for _ in range(n):
        words, bad = [word() for _ in range(rng.randrange(20, 200))], rng.random() < 0.3
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["moron", "idiot", "scumbag", "losers"])
        rows.append((" ".join(words), int(bad)))
    return rows


@pytest.fixture(scope="module")
def model():
    return toxicity.fit(labelled_texts(1, 400))


def test_held_out_toxicity(model):
    rows = labelled_texts(2, 300)
    scores = model.scores(toxicity.Scorer(model)(pa.array([t for t, _ in rows])))
    assert np.mean((scores >= 0.3) == [y for _, y in rows]) > 0.97


def test_gaps_and_signs_do_not_hide_insults(model):
    scorer = toxicity.Scorer(model)
    texts = ["thean idiot erle", "thean IDIOT! erle", "thean id.iot erle", "thean i-d-i-o-t erle", "thean i d i o t erle", "thean mo-ron erle", "thean xxxxxxxxxxxxxxxxxxxxidiot erle"]
    clean = scorer(pa.array(["thean erle inst", "", None, " \n"]))
    assert scorer(pa.array(texts)).min() > clean.max()


def test_scores_of_a_batch_do_not_depend_on_it(model):
    texts = [t for t, _ in labelled_texts(5, 40)] + ["", None]
    whole = toxicity.Scorer(model)(pa.array(texts))
    assert np.allclose(whole, [toxicity.Scorer(model)(pa.array([t], pa.string()))[0] for t in texts])


DISGUISED = ["i.d.i.o.t", "i*d*i*o*t", "i--d--i--o--t", "i  d  i  o  t", "idxxiot", "ixdxixoxt", "\u00a0idiot\u00a0", "i\u00a0d\u00a0i\u00a0o\u00a0t", "wor-th-less", "tra_sh"]


def test_held_out_rows_of_the_tables():
    base = "/root/testdata/sf0.1"
    text = {r["doc_id"]: r["text"] for r in pq.read_table(f"{base}/documents.parquet", columns=["doc_id", "text"]).to_pylist()}
    labels = [(r["doc_id"], r["toxic"]) for r in pq.read_table(f"{base}/labels.parquet").to_pylist()]
    kept = [(text[i], y) for i, y in sorted(labels) if zlib.crc32(str(i).encode()) % 4 != 2]
    held = [(text[i], y) for i, y in sorted(labels) if zlib.crc32(str(i).encode()) % 4 == 2]
    found = toxicity.fit(kept)
    scorer = toxicity.Scorer(found)
    scores, y = found.scores(scorer(pa.array([t for t, _ in held]))), np.array([y for _, y in held])
    above = (scores[y == 1][:, None] > scores[y == 0]).mean() + (scores[y == 1][:, None] == scores[y == 0]).mean() / 2
    said = scores >= toxicity.THRESHOLD
    assert above > 0.95 and said[y == 1].mean() > 0.85 and said[y == 0].mean() < 0.02
    assert found.scores(scorer(pa.array([f"the {d} is" for d in DISGUISED]))).min() >= toxicity.THRESHOLD
    assert found.scores(scorer(pa.array(["the idea is", "a b c d e f g", ""]))).max() < toxicity.THRESHOLD


def plain_margin(model, word):
    """A word's largest margin, triple by triple."""
    best = -np.inf
    for piece in toxicity.pieces(word):
        codes, out = toxicity.letter_codes(np.array([ord(c) for c in piece], np.int64)).tolist(), {}
        for i, j, k in itertools.combinations(range(len(codes)), 3):
            if k - i < toxicity.REACH:
                t = (codes[i] * toxicity.LETTERS + codes[j]) * toxicity.LETTERS + codes[k]
                out[t] = out.get(t, 0) + toxicity.DECAY ** (k - i - 2)
        norm = np.sqrt(sum(v * v for v in out.values()))
        best = max(best, model.bias + sum(v * model.table[t] for t, v in out.items()) / (norm or 1))
    return best


def test_scores_equal_the_definition(spark, docs_of, model):
    texts = [t for t, _ in labelled_texts(6, 12)] + ["x " * 9, "i d i o t", "\u00a0mo-ron\u2003", "a" * 70 + "idiot", None, "", "l--o--s--e--r--s but o n"]
    found = {r.doc_id: r.score for r in toxicity.classify(docs_of(list(enumerate(texts))), None, model).collect()}
    for i, text in enumerate(texts):
        words = (text or "").split() + toxicity._SPACED.findall(text or "")
        margin = max([plain_margin(model, w) for w in words], default=model.bias)
        assert found[i] == pytest.approx(float(model.scores(np.array([margin]))[0]), abs=1e-9)


def test_words_of_any_length_are_learned_from():
    rows = [(f"{t} {'q' * 30}{'zorkmid' if y else 'blanket'}", y) for t, y in labelled_texts(9, 200)]
    rows = [(t.replace("moron", "").replace("idiot", "").replace("scumbag", "").replace("losers", ""), y) for t, y in rows]
    found = toxicity.fit(rows)
    scores = found.scores(toxicity.Scorer(found)(pa.array(["q" * 30 + "zorkmid", "q" * 30 + "blanket"])))
    assert scores[0] > 0.5 and scores[1] < 0.3


def test_toxicity_frames(spark, docs_of):
    rows = list(enumerate(t for t, _ in labelled_texts(3, 200)))
    labels = spark.createDataFrame([(i, 1, y) for i, (_, y) in enumerate(labelled_texts(3, 200))] + [(None, 1, 1), (7, None, None)], "doc_id bigint, quality int, toxic int")
    docs = docs_of(rows + [(None, None), (0, ""), (0, "")])
    found = toxicity.classify(docs, labels).collect()
    assert len(found) == 203 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in found)
    assert toxicity.classify(docs_of([]), labels).count() == 0
    assert {r.score for r in toxicity.classify(docs, labels.limit(0)).collect()} == {0.5}


def junk(seed, n):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        words, good = [rng.choice(["the", "river", "runs", "under", "old", "bridges"]) for _ in range(rng.randrange(30, 300))], rng.random() < 0.7
        if not good:
            at = rng.randrange(len(words))
            words[at : at + 40] = [w + "$$$" for w in words[at : at + 40]]
        rows.append((" ".join(words), int(good)))
    return rows


def test_held_out_quality():
    rows = junk(1, 400)
    good = sum(y for _, y in rows)
    model = quality.fit(rows, {0: len(rows) - good, 1: good})
    rest = junk(2, 200)
    x, begins = quality.passages(pa.array([t for t, _ in rest]))
    assert np.mean((model.forward(x, begins)["p"] >= 0.5) == [y for _, y in rest]) > 0.95


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    x, begins = quality.passages(pa.array([t for t, _ in junk(4, 12)]))
    y, cost = rng.integers(0, 2, 12).astype(float), rng.uniform(1, 2, 12)
    model = quality.AttentionModel(x.mean(axis=0), x.std(axis=0) + 1e-3, rng)

    def loss():
        p = model.forward(x, begins)["p"]
        decay = sum((w**2).sum() for w in model.weights.values()) * quality.DECAY / 2
        return -(cost * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / cost.sum() + decay

    grads = model.gradients(model.forward(x, begins), begins, y, cost)
    for name, w in model.weights.items():
        at = tuple(rng.integers(0, s) for s in w.shape)
        w[at] += 1e-5
        up = loss()
        w[at] -= 2e-5
        down = loss()
        w[at] += 1e-5
        assert abs((up - down) / 2e-5 - grads[name][at]) < 1e-6


def test_passages_do_not_depend_on_their_batch():
    texts = ["a b c", None, "", " \n", "x" * 70, "one two " * 100, "| a | b |", "é ç\n" * 90]
    x, begins = quality.passages(pa.array(texts))
    assert np.diff(begins).tolist() == [1, 1, 1, 1, 1, 4, 1, 3]
    for i, t in enumerate(texts):
        alone, _ = quality.passages(pa.array([t], pa.string()))
        assert np.allclose(x[begins[i] : begins[i + 1]], alone)


def test_quality_frames(spark, docs_of):
    rows = junk(3, 150)
    labels = spark.createDataFrame([(i, y, 0) for i, (_, y) in enumerate(rows)] + [(None, 1, 1)], "doc_id bigint, quality int, toxic int")
    docs = docs_of([(i, t) for i, (t, _) in enumerate(rows)] + [(None, None), (0, ""), (0, "")])
    found = quality.classify(docs, labels).collect()
    assert len(found) == 153 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    assert quality.classify(docs_of([]), labels).count() == 0
    assert {r.score for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}


def test_pipeline_runs_and_keeps_columns(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    at = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, at, tables)
        assert after.columns == docs.columns
        assert after.count() <= at.count()
        at = after
    pieces = corpus_pipeline.run(spark, tables)
    left = {r.doc_id for r in at.select("doc_id").collect()}
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == left
