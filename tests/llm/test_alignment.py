import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from vecloom.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def byte_of():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def plain_groups(text, tokenizers):
    """Groups of (A ids, B ids) of one text, whole-text encoding; none where the tokens do not give it back."""
    a, b = tokenizers
    if not text:
        return []
    of, want = byte_of(), f" {text}".encode()
    found = a.encode(f" {text}", add_special_tokens=False)
    bytes_a = [bytes(of[c] for c in t) for t in found.tokens]
    ids_b = b.encode(text)
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, map(b.id_to_piece, ids_b), strict=True)]
    if b"".join(bytes_a) != want or b"".join(bytes_b) != want:
        return []
    ends_a, ends_b = np.cumsum([len(t) for t in bytes_a]).tolist(), np.cumsum([len(t) for t in bytes_b]).tolist()
    common, groups, i, j = set(ends_a) & set(ends_b), [], 0, 0
    for end in sorted(common):
        x, y = [], []
        while i < len(ends_a) and ends_a[i] <= end:
            x.append(found.ids[i])
            i += 1
        while j < len(ends_b) and ends_b[j] <= end:
            y.append(ids_b[j])
            j += 1
        groups.append((x, y))
    return groups


def plain_alignment(texts, tokenizers):
    every = [plain_groups(t, tokenizers) for t in texts]
    linked = [Counter((a, b) for x, y in groups for a in x for b in y) for groups in every]
    count = Counter(p for found in linked for p in found)
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for groups, found in zip(every, linked, strict=True):
        shown = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        best = sum(n for (a, b), n in found.items() if count[a, b] == most[a])
        out.append((sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(found.values()), best, sum(n * count[p] for p, n in found.items()), hashlib.sha256(shown.encode()).hexdigest() if groups else ""))
    return out


TEXTS = [
    "The quick brown fox jumps over the lazy dog.",
    "Élan vital, naïveté; 12345678 tokens\n\tand  double   spaces ",
    "日本語のテキスト and ελληνικά 👩‍👩‍👧 mixed",
    "<|endoftext|> and <s> stay </s> text <0x41>",
    "▁ is another sign", "a ▁b", "end▁",
    "", None, " ", "  two", "\n", "x", "Hello", "Hello",
    "zero\x00byte \x7f   ﻿ bom",
    "=" * 700 + " " + "ab" * 900,
    "the " * 3000,
    "unspacedtextwithoutanybreak" * 150,
    "ﬁ Ａ ½ Å Å", "don't can't I'll we've 3.14 1,000,000",
]


def test_alignment_equals_plain(spark, docs_of, tokenizers):
    texts = TEXTS + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(120).collect()]
    rows = list(enumerate(texts)) + [(None, TEXTS[0]), (3, TEXTS[3])]
    want = plain_alignment([t for _, t in rows], tokenizers)
    found = alignment.align(docs_of(rows).repartition(4), A, B).collect()
    got = sorted([(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in found], key=str)
    assert got == sorted([(i, *w) for (i, _), w in zip(rows, want, strict=True)], key=str)


def test_cold_pairs_and_partial_counts(spark, docs_of, tokenizers, monkeypatch):
    texts = TEXTS + ["Éàü çñ œuvre", "œuvre Éàü"]
    want = plain_alignment(texts, tokenizers)
    monkeypatch.setattr(alignment, "HOT_SHARE", 20)
    found = {r.doc_id: r for r in alignment.align(docs_of(list(enumerate(texts))), A, B).collect()}
    assert [(found[i].n_best, found[i].count_sum) for i in range(len(texts))] == [w[4:6] for w in want]


def test_large_groups_and_forgetting(tokenizers, monkeypatch):
    monkeypatch.setattr(alignment, "LISTED", 1)
    monkeypatch.setattr(alignment, "MEMO_CUTS", 3)
    both = alignment.Aligner(A, B)
    for _ in range(2):
        counts, digests, row, pair, times = both(pa.array(TEXTS))
        for i, text in enumerate(TEXTS):
            groups = plain_groups(text, tokenizers)
            linked = Counter(a * both.n_b + b for x, y in groups for a in x for b in y)
            mine = row == i
            assert dict(zip(pair[mine].tolist(), times[mine].tolist(), strict=True)) == linked
            assert counts[i].tolist() == [sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(linked.values())]


def test_identity_map(tokenizers):
    both = alignment.Aligner(A, B)
    a, b = tokenizers
    assert both.same[a.token_to_id("Ġthe")] == b.piece_to_id("▁the")
    assert both.same[a.token_to_id("a")] == b.piece_to_id("a")
    assert both.same[a.token_to_id("Ċ")] == b.piece_to_id("<0x0A>")


def test_empty_table(spark, docs_of):
    assert alignment.align(docs_of([]), A, B).count() == 0
    row = alignment.align(docs_of([(1, None)]), A, B).first()
    assert (row.n_a, row.n_best, row.count_sum, row.groups_sha256) == (0, 0, 0, "")


ODD_CUTS = [" a", " the", " xé", "  ", " 中文", " \U0001f600", " <|endoftext|>", " 0.25,", " \n", " Über", " á", " ", " ▁x", " <0x41>", " end"]


def test_cuts_have_the_ids_of_the_encoder():
    both = alignment.Aligner(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    for new in (ODD_CUTS, ODD_CUTS[:2], ODD_CUTS[3:4], [f" w{i}" for i in range(8000)], []):
        ids, bounds = both.ids_a(new, [c.encode() for c in new])
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [e.ids for e in both.encoder.tokenizer.encode_batch(new, add_special_tokens=False)]
    both.size_a = both.size_a + 1  # sizes that do not add up are not used
    ids, bounds = both.ids_a(ODD_CUTS, [c.encode() for c in ODD_CUTS])
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [e.ids for e in both.encoder.tokenizer.encode_batch(ODD_CUTS, add_special_tokens=False)]


def test_each_cut_is_judged_by_its_own_bytes():
    both = alignment.Aligner(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    raw = [c.encode() for c in ODD_CUTS]
    lists = both.pieces.encode([c[1:] for c in ODD_CUTS])
    own = [b"".join(both.bytes_b[i] for i in x) == c for x, c in zip(lists, raw)]
    for given in (list(range(len(raw))), [i for i, g in enumerate(own) if g], [i for i, g in enumerate(own) if not g]):
        good, n_b, b = both.giving_back([lists[i] for i in given], [raw[i] for i in given])
        assert good.tolist() == [own[i] for i in given]
        assert n_b.tolist() == [len(lists[i]) * own[i] for i in given]
        assert b.tolist() == [x for i in given if own[i] for x in lists[i]]
