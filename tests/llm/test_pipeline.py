import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from llm_reference import near_components
from test_classifiers import labelled_texts
from test_native import leaks
from test_tokens import crc_of
from tokenizers import Tokenizer

import corpus_pipeline
from vecloom.llm import packing

ITEM = "Seven wise OWLS counted silver coins beneath the old stone bridge"


def planted(seed=11):
    """(doc_id, text, toxic): labelled texts, and copies, near copies, leaks and insults among each other."""
    rng = random.Random(seed)
    rows = [(1000 + i, t, y) for i, (t, y) in enumerate(labelled_texts(1, 300))]

    def clean():
        return [f"{rng.choice(['an', 'er', 'tho', 'le'])}{rng.choice(['in', 'que', 'st'])}" for _ in range(150)]

    def changed(words, *at, by="tholein"):
        return " ".join(by if i in at else w for i, w in enumerate(words))

    for k in range(0, 60, 10):
        words = clean()
        rows += [(k, changed(words), 0), (k + 1, "  \n".join(words), 0), (k + 2, changed(words, 40), 0), (k + 3, changed(words, 40, 100, 110), 0)]
        # An insult or a leak has a smaller id than its near copy, which depends on the order of the stages.
        words = clean()
        rows += [(k + 4, changed(words, 70, by="idiot"), 1), (k + 5, changed(words), 0)]
        words = clean()
        rows += [(k + 6, f"{changed(words)} {ITEM.lower()}", 0), (k + 7, changed(words, 3), 0)]
        rows += [(k + 8, f"{changed(clean()[:20])} {ITEM}!", 0), (k + 9, f"{changed(clean()[:20])} {ITEM[:30]}", 0)]
    rows += [(2000, None, 0), (2001, "", 0), (2002, " \n", 0), (2003, "one", 0), (2004, "ONE", 0)]
    rng.shuffle(rows)
    return rows


def left_by_hand(rows):
    """(doc_id, text) after the first four stages."""
    docs = [(i, t) for i, t, toxic in rows if not toxic]
    copies = defaultdict(list)
    for i, t in docs:
        copies[re.sub(r"[ \t-\r]+", " ", t or "")].append(i)
    first = {min(ids) for ids in copies.values()}
    docs = [(i, t) for i, t in docs if i in first]
    group = near_components(docs)
    return [(i, t) for i, t in docs if group[i][1] == i and not leaks(t, [(1, ITEM)])[-1]]


def test_rows_equal_stages_by_hand(spark, tmp_path):
    rows = planted()
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t, _ in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, _, y in rows if 1000 <= i < 2000], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    tokenizer, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), Counter()
    for doc_id, text in left_by_hand(rows):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        for piece, start in enumerate(range(0, len(ids), packing.CAPACITY)):
            part = ids[start : start + packing.CAPACITY]
            want[doc_id, piece, start, len(part), crc_of(np.array(part))] += 1
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    slots = defaultdict(list)
    for r in found:
        slots[r.sequence_id].append((r.offset, r.length))
    for held in slots.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
