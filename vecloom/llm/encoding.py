"""Whole texts to token ids with a vocabulary of the ``tokenizers`` library.

A text is cut at single spaces between two visible characters. Both vocabularies start a new
word there whatever stands around it, so the ids of the cuts, one after the other, are the
ids of the text; a test compares them with whole-text encoding. Strings of special tokens are
one id each, as the vocabulary is loaded; they hold no space, so no cut falls inside. Each distinct cut of a batch
is looked up once and encoded only if the process has not met it.
"""

from __future__ import annotations

import bisect
import os
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from vecloom.llm.batches import release_memory, spans, text_buffer

SLICE_BYTES = 2 << 20
#: Beyond so many cuts the memo keeps those that several slices had, half as many at most.
MEMO_WORDS = 400_000
JOINED = 24
#: Texts given to the library in one call: its results are large until their ids are taken.
AT_ONCE = 250

_ids = np.arange(256)
# Lead bytes of characters that are never white space; of others only ASCII is judged here.
_VISIBLE = (_ids > 32) & (_ids < 127)
_LETTER_LEAD = (_ids >= 0xC3) & (_ids <= 0xDF)
_BLANK = np.isin(_ids, [9, 10, 13, 32])
# Bytes of other characters than ASCII ones and U+00C0 to U+00FF: their lead bytes, and controls.
_UNTRUSTED = ((_ids < 32) & ~_BLANK) | (_ids == 127) | ((_ids >= 0xC0) & (_ids != 0xC3))


def cuts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the cuts of all rows begin; every row that is not empty begins one."""
    if not len(data):
        return np.empty(0, np.int64)
    at = np.flatnonzero(data == 32)
    at = at[(at > 1) & (at < len(data) - 1)]
    before, lead, after = data[at - 1], data[at - 2], data[at + 1]
    good = (_VISIBLE[before] | ((before >= 128) & (before < 192) & _LETTER_LEAD[lead])) & (_VISIBLE[after] | _LETTER_LEAD[after])
    begins = np.zeros(len(data), bool)
    begins[at[good]] = True
    begins[ends[:-1][ends[:-1] < ends[1:]]] = True
    return np.flatnonzero(begins)


def visible(character: str) -> bool:
    return 32 < ord(character) < 127 or 0xC0 <= ord(character) <= 0x7FF


class Encoder:
    """Token ids of text columns; holds what the process has encoded so far."""

    def __init__(self, path: str, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.sizes, self.space = self.byte_sizes()
        self.forget()

    def byte_sizes(self) -> tuple[np.ndarray | None, int]:
        """Bytes of text behind each id, and whether tokens hold white space (1) or not (0); None if neither adds up.

        Without a normalizer the bytes are those of the text. With one they are so for the characters that ``plain`` lets pass.
        """
        vocabulary = self.tokenizer.get_vocab()
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None) or ""
        sizes = np.zeros(max(vocabulary.values(), default=-1) + 1, np.int64)
        for token, i in vocabulary.items():
            sizes[i] = len(token.removesuffix(suffix))
        probe = " a wörd, Thén\n12 more"
        found = int(sizes[self.tokenizer.encode(probe, add_special_tokens=False).ids].sum())
        space = {len(probe.encode()): 1, len("".join(probe.split()).encode()): 0}
        return (sizes, space[found]) if found in space else (None, 0)

    def plain(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Which cuts are regular and have tokens whose bytes add up for certain, and how many bytes each cut's tokens have.

        A normalizer is trusted with ASCII and the letters of Latin-1, which keep their size in lower case and have no marks to join.
        """
        data, ends = text_buffer(words)
        start, stop = ends[:-1], ends[1:]
        good = stop - start > 1
        first, last = data[start[good] + 1], data[stop[good] - 1]
        good[good] = (data[start[good]] == 32) & (_VISIBLE[first] | _LETTER_LEAD[first]) & (_VISIBLE[last] | ((last >= 128) & (last < 192) & _LETTER_LEAD[data[stop[good] - 2]]))
        lengths = stop - start
        if self.tokenizer.normalizer is not None:
            good &= np.diff(np.concatenate(([0], np.cumsum(_UNTRUSTED[data])))[ends]) == 0
        if not self.space:
            lengths = lengths - np.diff(np.concatenate(([0], np.cumsum(_BLANK[data])))[ends])
        return good, lengths

    def forget(self) -> None:
        self.words = pa.array([], pa.large_string())
        self.starts, self.lengths, self.pool = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint32)
        self.slices = np.empty(0, np.int32)

    def shrink(self) -> None:
        """Drops the cuts that few slices had; those that stay count anew from one."""
        least = 2
        while (keep := self.slices >= least).sum() > MEMO_WORDS // 2:
            least += 1
        self.pool = self.pool[spans(self.lengths[keep], self.starts[keep])]
        self.lengths = self.lengths[keep]
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)))[:-1].astype(np.int64)
        self.words = self.words.filter(pa.array(keep))
        self.slices = np.ones(len(self.lengths), np.int32)

    def regular(self, texts: list[str]) -> list[int]:
        """Places of the cuts that begin with a space and end visibly: joined for one call they have the ids they have alone."""
        return [i for i, t in enumerate(texts) if len(t) > 1 and t[0] == " " and visible(t[1]) and visible(t[-1])]

    def lists_by_bytes(self, texts: list[str], lengths: list[int], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of regular cuts of so many UTF-8 bytes and where each one's end, by the ids' ``sizes`` in bytes; None if the bytes do not add up."""
        return self.cut_by_bytes(["".join(texts[k : k + JOINED]) for k in range(0, len(texts), JOINED)], np.array(lengths, np.int64), sizes)

    def cut_by_bytes(self, parts: list[str], lengths: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """As ``lists_by_bytes``, of cuts that are joined to ``parts`` already."""
        found = []
        for k in range(0, len(parts), AT_ONCE):
            # The fast form leaves out where tokens stand in the text, which their sizes tell.
            joined = [e.ids for e in self.tokenizer.encode_batch_fast(parts[k : k + AT_ONCE], add_special_tokens=False)]
            found.append(np.fromiter(chain.from_iterable(joined), np.int64, sum(map(len, joined))))
        ids = np.concatenate([np.empty(0, np.int64), *found])
        # A token ends in its own cut, though it may begin with the space before its word.
        ends, stops = np.cumsum(sizes[ids]), np.cumsum(lengths)
        count = np.searchsorted(ends, stops, side="right")
        whole = len(ids) > 0 and len(stops) > 0 and ends[-1] == stops[-1] and bool((ends[count - 1] == stops).all())
        return (ids, count) if whole else None

    def learn(self, words: pa.Array) -> np.ndarray:
        """Encodes new cuts and returns the order in which they are kept.

        Plain ones are told apart in their joined ids by the tokens' bytes, the others by the tokens' places.
        """
        plain, lengths = self.plain(words)
        if self.sizes is None or not plain.any():
            self.keep(words, *self.by_places(words))
            return np.arange(len(words))
        some = words.filter(pa.array(plain))
        data, ends = text_buffer(some)
        bounds = np.append(ends[:-1:JOINED], ends[-1])
        parts = pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)]).to_pylist()
        found = self.cut_by_bytes(parts, lengths[plain], self.sizes)
        if found is None:
            self.keep(words, *self.by_places(words))
            return np.arange(len(words))
        self.keep(some, np.diff(found[1], prepend=0), found[0])
        rest = words.filter(pa.array(~plain))
        self.keep(rest, *self.by_places(rest))
        return np.concatenate((np.flatnonzero(plain), np.flatnonzero(~plain)))

    def keep(self, words: pa.Array, lengths: np.ndarray, ids: np.ndarray) -> None:
        """Adds cuts with their numbers of ids and all their ids."""
        self.starts = np.concatenate((self.starts, len(self.pool) + np.cumsum(lengths) - lengths))
        self.lengths = np.concatenate((self.lengths, lengths))
        self.pool = np.concatenate((self.pool, ids.astype(np.uint32)))
        self.slices = np.concatenate((self.slices, np.zeros(len(words), np.int32)))
        self.words = pa.concat_arrays([self.words, words])

    def by_places(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids of cuts, and their ids. The regular ones are joined for one call; the rest go alone."""
        texts = words.to_pylist()
        regular = self.regular(texts)
        ids: list[list[int]] = [[]] * len(texts)
        parts = [regular[k : k + JOINED] for k in range(0, len(regular), JOINED)]
        for some in (parts[k : k + AT_ONCE] for k in range(0, len(parts), AT_ONCE)):
            joined = self.tokenizer.encode_batch(["".join(texts[i] for i in part) for part in some], add_special_tokens=False)
            for part, found in zip(some, joined, strict=True):
                # A token ends in its own cut, though it may begin with the space before its word.
                ends = [e for _, e in found.offsets]
                at, place, got = 0, 0, found.ids
                for i in part:
                    place += len(texts[i])
                    stop = bisect.bisect_right(ends, place, at)
                    ids[i] = got[at:stop]
                    at = stop
        alone = sorted(set(range(len(texts))) - set(regular))
        for k in range(0, len(alone), AT_ONCE):
            part = alone[k : k + AT_ONCE]
            for i, e in zip(part, self.tokenizer.encode_batch([texts[i] for i in part], add_special_tokens=False), strict=True):
                ids[i] = e.ids
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return lengths, np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum()))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All rows' ids, and where each row's begin and the last one's end; null rows are empty."""
        data, ends = text_buffer(column)
        starts = cuts(data, ends)
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(column) + 1, np.int64)
        offsets = np.append(starts, len(data)).astype(np.int64)
        pieces = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        if len(self.words) > MEMO_WORDS:
            self.shrink()
        known = pc.index_in(pieces.dictionary, value_set=self.words)
        if known.null_count:
            first = len(self.words)
            missing = known.is_null().to_numpy(zero_copy_only=False)
            order = self.learn(pieces.dictionary.filter(pa.array(missing)))
            at = known.fill_null(0).to_numpy().astype(np.int64)
            at[np.flatnonzero(missing)[order]] = np.arange(first, len(self.words))
            # The library's results are many small objects; what they leave free is not kept.
            release_memory()
        else:
            at = known.to_numpy().astype(np.int64)
        self.slices[at] += 1
        word = at[pieces.indices.to_numpy()]
        lengths = self.lengths[word]
        ids = self.pool[spans(lengths, self.starts[word])]
        total = np.concatenate(([0], np.cumsum(lengths)))
        return ids, total[np.searchsorted(starts, ends)]


@lru_cache(maxsize=2)
def encoder(path: str, special_as_text: bool = False) -> Encoder:
    """One encoder per vocabulary in a worker process, which serves many tasks.

    With ``special_as_text`` the strings of special tokens in a text are ordinary text.
    """
    return Encoder(path, special_as_text)


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows' ids with ``end_id`` after each row."""
    rows = len(bounds) - 1
    out = np.insert(ids, bounds[1:], np.uint32(end_id)) if rows else ids
    return out, bounds + np.arange(rows + 1)


def crc(ids: np.ndarray) -> int:
    """CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4", copy=False).tobytes())
