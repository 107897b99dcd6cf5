"""License scan: identifier tags, notice phrases and license expressions.

One Aho-Corasick automaton finds all phrases in the words of a text; another finds identifier
tags in the text itself. The expression behind a tag is parsed by shunting-yard and evaluated
to its licenses and to how much it asks of a user.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from vecloom.llm.batches import bounded

SLICE_BYTES = 8 << 20

# The base phrases and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Further notices, as words, and their labels.
NOTICE_PHRASES = {
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "bsd license": "bsd",
    "isc license": "isc",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "cc0 1 0": "cc0",
    "public domain": "public-domain",
    "the unlicense": "unlicense",
    "all rights reserved": "reserved",
}
TAGS = ("spdx-license-identifier:", "license-identifier:")
# What a license of a family asks: 0 nothing or a notice, 1 sharing of changed files, 2 sharing of the whole, 3 unknown or no use.
FAMILIES = {"0bsd": 0, "apache": 0, "bsd": 0, "bsl": 0, "cc0": 0, "cc-by": 0, "isc": 0, "mit": 0, "unlicense": 0, "zlib": 0, "epl": 1, "lgpl": 1, "mpl": 1, "agpl": 2, "cc-by-sa": 2, "gpl": 2, "cc-by-nc": 3, "cc-by-nd": 3}
KINDS = ("permissive", "weak-copyleft", "copyleft", "unknown")
BINDING = {"or": 1, "and": 2, "with": 3}
_ATOM = re.compile(rb"[()]|[a-z0-9][a-z0-9.+:-]*")

# Bytes of words stay, letters A-Z become lower case, all others separate.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def family(identifier: str) -> str:
    """``apache-2.0`` is of ``apache``; the longest family that begins the identifier counts."""
    found = [f for f in FAMILIES if identifier == f or identifier.startswith((f"{f}-", f"{f}+"))]
    return max(found, key=len, default="")


def to_postfix(tokens: list[str]) -> list[str]:
    """Shunting-yard: ``with`` binds before ``and``, ``and`` before ``or``, all to the left.

    Raises ValueError where operands and operators do not alternate or a bracket is open.
    """
    out: list[str] = []
    held: list[str] = []
    operand = True
    for token in tokens:
        if token == "(" and operand:
            held.append(token)
        elif token == ")" and not operand:
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                raise ValueError("closing bracket without an opening one")
            held.pop()
        elif token in BINDING and not operand:
            while held and held[-1] != "(" and BINDING[held[-1]] >= BINDING[token]:
                out.append(held.pop())
            held.append(token)
            operand = True
        elif token not in BINDING and token not in "()" and operand:
            out.append(token)
            operand = False
        else:
            raise ValueError(f"unexpected {token}")
    if operand or "(" in held:
        raise ValueError("expression breaks off")
    return out + held[::-1]


def evaluate(tokens: list[str]) -> tuple[set[str], int]:
    """Licenses named, and what the whole asks: the most of ``and``, the least of ``or``.

    ``with`` lets an exception turn the whole's sharing into that of changed files.
    """
    stack: list[tuple[set[str], int]] = []
    for token in to_postfix(tokens):
        if token in BINDING:
            (right, more), (left, asked) = stack.pop(), stack.pop()
            if token == "with":
                stack.append((left, min(asked, 1) if asked < 3 else 3))
                continue
            # The smaller set goes into the larger one, so that a long chain is not copied at every step.
            small, large = sorted((left, right), key=len)
            large |= small
            stack.append((large, (max if token == "and" else min)(asked, more)))
        else:
            stack.append(({token}, FAMILIES.get(family(token), 3)))
    return stack.pop()


def expression_at(text: bytes, start: int = 0, stop: int = sys.maxsize) -> list[str]:
    """Tokens of the longest well-formed expression that begins a line of lower-case text, which runs from ``start`` to ``stop``.

    One pass: it is known after every token whether an operand must follow and how many
    brackets are open, so the last place where the tokens so far were well-formed is kept, and
    reading stops at the first token that nothing can mend. Any length is read in linear time.
    """
    tokens: list[str] = []
    best = depth = 0
    end, operand = start, True
    for atom in _ATOM.finditer(text, start, stop):
        if text[end : atom.start()].strip() and tokens:
            break
        token = atom[0].decode().rstrip(".:") or atom[0].decode()
        if operand != (token not in BINDING and token != ")"):
            break
        if token == "(":
            depth += 1
        elif token == ")":
            depth -= 1
            if depth < 0:
                break
        else:
            operand = token in BINDING
        tokens.append(token)
        end = atom.end()
        if not operand and not depth:
            best = len(tokens)
    return tokens[:best]


@lru_cache(maxsize=1)
def automata() -> tuple[ahocorasick.Automaton, ahocorasick.Automaton]:
    phrases, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    for phrase, label in (NOTICE_PHRASES | BASE_PHRASES).items():
        phrases.add_word(f" {phrase} ", (phrase, label))
    for tag in TAGS:
        tags.add_word(tag, tag)
    phrases.make_automaton()
    tags.make_automaton()
    return phrases, tags


def scan_text(text: bytes) -> tuple[int, int, int | None, int | None, set[str], set[str], float]:
    """Words, base places, first and last place, base labels, all labels and score of one text in UTF-8."""
    phrases, tags = automata()
    words = text.translate(_WORDS).split()
    # Each word between single spaces; bytes as characters, so that a match's end is a byte's place.
    joined = f" {b' '.join(words).decode('latin-1')} "
    places: list[int] = []
    base: set[str] = set()
    labels: set[str] = set()
    for end, (phrase, label) in phrases.iter(joined):
        labels.add(label)
        if phrase in BASE_PHRASES:
            base.add(label)
            places.append(end - len(phrase) - 1)
    score = 0.9 if labels else 0.0
    lower = text.lower()
    if b"license-identifier:" in lower:
        stop = 0
        for end, _ in tags.iter(lower.decode("latin-1")):
            if stop <= end:
                stop = lower.find(b"\n", end)
                stop = stop if stop >= 0 else len(lower)
            tokens = expression_at(lower, end + 1, stop)
            if tokens:
                names, asked = evaluate(tokens)
                labels |= {f"spdx:{n}" for n in names} | {f"asks:{KINDS[asked]}"}
                score = 1.0
    starts = [joined.count(" ", 0, p) for p in (min(places), max(places))] if places else [None, None]
    return len(words), len(places), starts[0], starts[1], base, labels, score


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    A base place is where the words of a base phrase stand one after the other, whatever
    separates them. Labels of identifiers are ``spdx:`` and the identifier, and ``asks:`` with
    what the expression asks. The score is 1 with a well-formed identifier, 0.9 with notices
    only, else 0. Of a line behind a tag, the longest well-formed expression that begins it
    counts, whatever its length. Null and empty texts have no words. No rows meet, so repeats, null ids and
    other columns do not matter.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text", SLICE_BYTES):
            texts = batch.column("text").fill_null("").cast(pa.large_binary())
            rows = [scan_text(t.as_py()) for t in texts]
            n, n_base, first, last, base, labels, score = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(n_base, pa.int64()),
                    pa.array(first, pa.int64()),
                    pa.array(last, pa.int64()),
                    pa.array([",".join(sorted(b)) for b in base], pa.string()),
                    pa.array([",".join(sorted(x)) for x in labels], pa.string()),
                    pa.array(score, pa.float64()),
                ],
                names=names,
            )

    schema = f"doc_id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"
    return docs.select("doc_id", "text").mapInArrow(scanned, schema)
