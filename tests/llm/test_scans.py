import hashlib
import random
import re
import string
import time
import zlib
from collections import Counter

import pytest

from vecloom.llm import licenses, warc
from vecloom.llm.shared_files import open_stream

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def base_places(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in licenses.BASE_PHRASES.items():
        parts = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(parts)] == parts:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


TEXTS = [
    "Licensed under the Apache License, Version 2.0.",
    "MIT-License mit\nlicense MIT  License",
    "the GNU Lesser General Public License and the General/Public/License",
    "submit license, mit licenses, é mit license é",
    "SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0\nmore",
    "# spdx-license-identifier: MIT AND\n",
    "Licensed under CC BY-NC 4.0.",
    None,
    "",
    "license " * 5000,
]


def test_base_places_equal_plain_search(docs_of):
    rows = list(enumerate(TEXTS)) + [(None, TEXTS[0]), (3, TEXTS[1])]
    found = licenses.scan(docs_of(rows)).collect()
    want = sorted([(str(i), *base_places(t)) for i, t in rows], key=str)
    assert sorted([(str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found], key=str) == want
    by_id = {r.doc_id: r for r in found if r.doc_id not in (None, 3)}
    assert by_id[2].labels == "gpl,lgpl"
    assert by_id[4].labels == "asks:weak-copyleft,spdx:apache-2.0,spdx:gpl-2.0-only,spdx:mit" and by_id[4].score == 1
    assert by_id[5].labels == "asks:permissive,spdx:mit"
    assert by_id[6].labels == "cc-by,cc-by-nc" and by_id[6].score == 0.9
    assert by_id[7].labels == "" and by_id[7].score == 0
    assert licenses.scan(docs_of([])).count() == 0


def test_expressions():
    assert licenses.to_postfix("a or b and c with d".split()) == "a b c d with and or".split()
    assert licenses.to_postfix("( a or b ) and c".split()) == "a b or c and".split()
    assert licenses.evaluate("mit or gpl-3.0".split()) == ({"mit", "gpl-3.0"}, 0)
    assert licenses.evaluate("mit and gpl-3.0".split()) == ({"mit", "gpl-3.0"}, 2)
    for bad in ("", "and", "a b", "( a", "a )", "a or", "a ( b )"):
        with pytest.raises(ValueError):
            licenses.to_postfix(bad.split())


def plain_expression(tokens):
    """The longest beginning that the parser takes, tried one by one."""
    best = 0
    for n in range(1, len(tokens) + 1):
        try:
            licenses.to_postfix(tokens[:n])
            best = n
        except ValueError:
            pass
    return tokens[:best]


def test_longest_expression_of_a_line():
    draw = random.Random(4)
    atoms = ["mit", "gpl-3.0", "and", "or", "with", "(", ")"]
    for _ in range(3000):
        tokens = [draw.choice(atoms) for _ in range(draw.randint(0, 9))]
        found = licenses.expression_at(" ".join(tokens).encode())
        # Two names in a row end the expression for good, as plain words follow it.
        assert found == plain_expression(tokens)
    assert licenses.expression_at(b" mit and apache-2.0. see the file") == ["mit", "and", "apache-2.0"]


@pytest.mark.parametrize("line", ["(" * 1_000_000, "mit and " * 125_000, "(" * 400_000 + "mit" + ")" * 400_000, "(mit or " * 100_000 + "x" + ")" * 100_000, " ".join(f"l{i} and" for i in range(100_000)) + " z", "spdx-license-identifier: and " * 35_000])
def test_long_expressions_take_linear_time(line):
    started = time.time()
    n, _, _, _, _, labels, _ = licenses.scan_text(b"SPDX-License-Identifier: " + line.encode())
    assert time.time() - started < 2


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, html string, digest string, intact int")


LONG = "<p>é</p>" * 900


def test_archives_round_trip(spark, tmp_path):
    rows = [(4, "http://a/4", LONG), (2, None, LONG), (9, "http://a/9\n b", LONG), (3, "u", "short"), (1, "u", "short"), (5, "u", None), (6, "u", "x" * 99), (7, "u", "x" * 99), (8, "u", "y" * 100), (10, "u", "y" * 100), (11, "u", "\r\n\r\n0\r\n\r\n"), (None, "u", "y" * 100), (12, "u", "z" * 50_000)]
    found = {r.page_id: r for r in warc.archive(pages_of(spark, rows), str(tmp_path / "warc"), segment_bytes=700).collect()}
    first = {}
    for page, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        payload = (html or "").encode()
        keeper = first.setdefault(payload, page) if len(payload) >= 100 else page
        again = keeper != page
        r = found[page]
        assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha256(payload).hexdigest())
        assert (r.record_type, r.refers_to, r.intact) == ("revisit" if again else "response", keeper if again else None, True)
    assert len(found) == len(rows)
    assert warc.archive(pages_of(spark, []), str(tmp_path / "none")).count() == 0


def test_repeated_pages_are_records_of_their_own(spark, tmp_path):
    long, other = LONG * 8, "o" * 50_000
    rows = [(1, "u", long), (1, "u", long), (1, "v", long), (2, "u", long), (2, "u", long), (3, "u", "short"), (3, "u", "short"), (None, "u", other), (None, "u", other), (None, "u", "tiny"), (None, "u", "tiny"), (4, "u", None), (4, None, None), (1, "u", other), (5, "u", "only"), (6, "w", long + "!")]
    rows += [(7, "u", "hot" * 400)] * 300 + [(8, "u", "hot" * 400)] * 40
    manifest = warc.write(pages_of(spark, rows).repartition(5), str(tmp_path / "warc"), segment_bytes=700)
    names = []
    for r in manifest.collect():
        with open_stream(r.uri) as stream:
            names += [(p["origin"], p["segment"]) for p in warc.parsed(stream)]
    assert len(set(names)) == len(names)
    responses = {n for n, s in names if s in (None, 1)}
    assert {r.refers_record for r in warc.records(manifest).filter("type = 'revisit'").collect()} <= responses
    found = warc.read(manifest).collect()
    first = {}
    for page, _, html in rows:
        payload = (html or "").encode()
        if len(payload) >= 100 and page is not None:
            first[payload] = min(first.get(payload, page), page)
    want = Counter()
    for page, _, html in rows:
        payload = (html or "").encode()
        keeper = first.get(payload, page)
        want[page, len(payload), hashlib.sha256(payload).hexdigest(), "response" if keeper == page else "revisit", None if keeper == page else keeper, True] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.intact) for r in found) == want


def test_segments_and_broken_records(spark, tmp_path):
    manifest = warc.write(pages_of(spark, [(1, "u", LONG)]), str(tmp_path / "warc"), segment_bytes=1000)
    with open_stream(manifest.first().uri) as stream:
        parts = list(warc.parsed(stream))
    assert [p["segment"] for p in parts] == list(range(1, len(parts) + 1)) and len(parts) > 5
    assert parts[-1]["total"] == sum(len(p["block"]) for p in parts)
    found = warc.records(manifest)
    whole = warc.payloads(warc.reassembled(found)).first()
    assert whole.intact and bytes(whole.payload).decode() == LONG
    for broken in (found.filter("segment <> 3"), found.union(found.filter("segment = 2")), found.filter("total is null")):
        row = warc.payloads(warc.reassembled(broken)).first()
        assert not row.intact and row.payload is None


def test_chunked_framing():
    for payload in (b"", b"a", b"\r\n" * 500, bytes(range(256)) * 40):
        assert warc.unchunked(warc.chunked(payload, 100)) == payload
    assert warc.unchunked(b"3;name=x\r\nabc\r\n0\r\nTrailer: y\r\n\r\n") == b"abc"
    for broken in (b"5\r\nabc\r\n0\r\n\r\n", b"zz\r\n", b"3\r\nabc\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(broken)


def test_members_are_gzip(spark, tmp_path):
    manifest = warc.write(pages_of(spark, [(1, "u", "a"), (2, "u", "b")]), str(tmp_path / "warc"))
    raw = b"".join(open(r.uri.removeprefix("file://"), "rb").read() for r in manifest.collect())
    assert zlib.decompress(raw, 31).startswith(b"WARC/1.1\r\nWARC-Type: response")
