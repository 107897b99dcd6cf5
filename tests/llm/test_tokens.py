import io
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from vecloom.llm import encoding, packing, token_files
from vecloom.llm.encoding import encoder, with_end

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
TEXTS = ["", None, "  a  b\n\n c ", "x  y é é", "é ́x e ́", "don't 'll  \t\n z I'm", "<|endoftext|> hi", "a ", " a", "日本 語 x", "\x1c a \x85 b  c 　 d", "Σ ΑΣ σς", "a" * 3000, "1 22 333 ½ ²", "é ́ z", "😀 😀x 👨‍👩‍👧 "]


def crc_of(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_cuts_do_not_change_ids(path):
    coder = encoder(path)
    ids, bounds = coder.encode(pa.array(TEXTS))
    want = [coder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in TEXTS]
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aZé \n\t'.1ñ日́  ß👍"), max_size=30), min_size=1, max_size=8))
def test_any_text_is_encoded_whole(texts):
    for path in (WORD, BYTE):
        coder = encoder(path)
        ids, bounds = coder.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("as_text", [False, True])
@pytest.mark.parametrize("path", [WORD, BYTE])
def test_ids_equal_a_fresh_tokenizer(path, as_text):
    tokenizer, rng = Tokenizer.from_file(path), random.Random(8)
    tokenizer.encode_special_tokens = as_text
    bits = ["<|endoftext|>", "<|startoftext|>", "<|", "endoftext|>", "a", "hello", " ", " ", "  ", "\n", "é", ".", "1", "日", "'s"]
    texts = ["x <|endoftext|> y", "<|endoftext|>", None, *("".join(rng.choice(bits) for _ in range(rng.randrange(14))) for _ in range(500))]
    ids, bounds = encoder(path, as_text).encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    special = tokenizer.token_to_id("<|endoftext|>")
    assert (ids[bounds[1] : bounds[2]].tolist() == [special]) != as_text


def test_end_ids():
    ids, bounds = with_end(np.array([5, 6, 7], np.uint32), np.array([0, 2, 2, 3]), 1)
    assert ids.tolist() == [5, 6, 1, 1, 7, 1] and bounds.tolist() == [0, 3, 4, 6]


def checked(histogram, capacity):
    """Sequences of a plan, after holding every slot against the others."""
    runs, used, placed = packing.best_fit(histogram, capacity), {}, Counter()
    for length, start, end, first, each, offset in runs:
        for rank in range(start, end):
            nth = rank - start
            used.setdefault(first + nth // each, []).append((offset + nth % each * length, length))
            placed[length] += 1
    assert placed == Counter(histogram)
    for slots in used.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= capacity
    return len(used)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), min_size=1))
def test_plan_is_whole_and_tight(histogram):
    total = sum(k * n for k, n in histogram.items())
    found = checked(histogram, 64)
    assert max(-(-total // 64), sum(n for k, n in histogram.items() if k > 32)) <= found <= 2 * total // 64 + 1


def test_plan_equals_best_fit_of_single_items():
    rng = random.Random(2)
    for _ in range(30):
        items = sorted((rng.randrange(1, 101) for _ in range(rng.randrange(1, 200))), reverse=True)
        spaces = []
        for item in items:
            fitting = [s for s in spaces if s >= item]
            if fitting:
                spaces.remove(min(fitting))
                spaces.append(min(fitting) - item)
            else:
                spaces.append(100 - item)
        assert checked(dict(Counter(items)), 100) == len(spaces)


def test_packed_pieces(spark, docs_of):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["one", "two", "Three,"]) for _ in range(rng.randrange(120)))) for i in range(60)]
    rows += [(100, None), (101, ""), (101, ""), (None, "one two"), (102, "one " * 300)]
    packed = packing.pack(docs_of(rows), WORD, capacity=128, with_ids=True)
    tokenizer = encoder(WORD).tokenizer
    want = Counter()
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for piece in range(-(-len(ids) // 128)):
            part = ids[piece * 128 : piece * 128 + 128]
            want[doc_id, piece, piece * 128, len(part), crc_of(part)] += 1
    found = packed.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length, r.ids))
    for slots in by_sequence.values():
        ends = [0]
        for offset, length, _ in sorted(slots):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 128
    joined = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    assert joined == {k: b"".join(p for _, _, p in sorted(v)) for k, v in by_sequence.items()}
    assert packing.pack(docs_of([]), WORD).count() == 0


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_round_trip(kind):
    rng = np.random.default_rng(1)
    sizes = rng.integers(0, 90, 200)
    ids = rng.integers(0, 1 << 32, int(sizes.sum()), dtype=np.uint32)
    held = io.BytesIO()
    held.close, closed = (lambda: None), held.close
    writer = token_files.PlaneWriter(held, kind, block_ids=1000)
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    for a in range(0, 200, 30):
        b = min(a + 30, 200)
        writer.add([None if i == 7 else i for i in range(a, b)], sizes[a:b], ids[bounds[a] : bounds[b]])
    writer.close()
    reader = token_files.PlaneReader(held)
    assert np.array_equal(reader.ids(0, len(ids)), ids)
    assert np.array_equal(reader.ids(1990, 3011), ids[1990:3011])
    assert np.array_equal(np.concatenate([x for _, _, x in reader.documents(500)]), ids)
    assert np.array_equal(reader.bounds, bounds) and reader.nulls.sum() == 1
    with pytest.raises(ValueError):
        token_files.PlaneReader(io.BytesIO(held.getvalue()[:-3]))
    closed()


def test_written_and_read_back(spark, docs_of, tmp_path):
    rows = [(i, t) for i, t in enumerate(TEXTS * 3)] + [(None, "no id"), (5, "again five")]
    rng = random.Random(6)
    rng.shuffle(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    manifest = token_files.write(docs_of(rows).repartition(3), str(tmp_path / "planes"), BYTE)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = sorted(token_files.read(manifest, with_ids=True).collect(), key=lambda r: r.start)
    assert manifest.count() > 1
    tokenizer = encoder(BYTE).tokenizer
    ids = {k: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for k, t in enumerate([t for _, t in rows])}
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == Counter((d, len(ids[k]), crc_of(ids[k])) for k, (d, _) in enumerate(rows))
    at = 0
    for r in found:
        assert r.start == at and crc_of(np.frombuffer(r.ids, "<u4")) == r.ids_crc32
        at += r.n_tokens
    order = [(r.doc_id is not None, r.doc_id or 0) for r in found]
    assert order == sorted(order)
    assert token_files.read(token_files.write(docs_of([]), str(tmp_path / "none"), BYTE)).count() == 0


def test_a_small_memo_gives_the_same_ids(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [" ".join(f"word{i * j % 97}x common the of" for j in range(60)) for i in range(40)]
    want = [Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(encoding, "MEMO_WORDS", 30)
    small = encoding.Encoder(path)
    for k in range(0, 40, 4):
        ids, bounds = small.encode(pa.array(texts[k : k + 4]))
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == want[k : k + 4]
    assert len(small.words) <= 30 + 4 * 62 and len(small.words) == len(small.slices) == len(small.starts)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_most_cuts_need_no_token_places(path):
    """Token places cost most of a cut's time; cuts of Latin letters and line ends are told apart by bytes."""
    rng = random.Random(11)
    words = ["".join(rng.choice("abeuxQZéèßüñÇ,.'7") for _ in range(rng.randint(1, 9))) + rng.choice(["", "", "\n", ".\nÉ"]) + "a" for _ in range(3000)]
    odd = ["x", "İstanbul", "KKx", "ée", "日本", "a\x1cb", "a b", "<|endoftext|>", "ſ"]
    texts = [" ".join(rng.sample(words, 200)) for _ in range(20)] + [" ".join(odd + words[:5] + odd)]
    coder = encoding.Encoder(path)
    placed, by_places = [], coder.by_places

    def counting(cuts):
        placed.extend(cuts.to_pylist())
        return by_places(cuts)

    coder.by_places = counting
    ids, bounds = coder.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(placed) < 60
