"""Toxicity by a subsequence string kernel, Nyström landmarks and a support vector machine.

The kernel compares two words by the triples of letters that both have in order; a triple
counts less, by DECAY, for every letter between its own. A letter put into an insult, or left
out of it, changes some triples and leaves the rest. Signs and digits are dropped first, so any
number of them between two letters is no gap; beginning and end of a word are letters too.

Landmark words give the Nyström features of a word. The machine is linear in them, so that
its margin is one weighted sum over triples: a table of weights is all that scoring needs.
A sentence is as toxic as its worst word and a document as its worst sentence, hence as its
worst word; which words of a toxic document are the toxic ones is learned with the machine.
Insults are learned with disguises of their own: letters put in, a letter left out.
"""

from __future__ import annotations

import random
import re
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.llm.batches import bounded, text_buffer
from vecloom.llm.labelled import fitted, held_out

SLICE_BYTES = 8 << 20
DECAY = 0.6
#: Triples reach over so many letters, and words are read in windows of so many.
REACH = 7
WINDOW, STEP = 16, 8
FIRST, LAST, LEAST = "\x02", "\x03", 4
LETTERS, BEGIN, END = 37, 35, 36
CODES = LETTERS**3
#: Labelled documents of a class and bytes of a text that the model is fitted on, and clean words it takes as negatives.
TRAIN_PER_CLASS, TRAIN_BYTES, NEGATIVES = 2000, 64 << 10, 20_000
LANDMARKS, ROUNDS, PENALTY = 320, 4, 3e-4
#: Pieces of a toxic document that are taken as positives, and pieces whose disguises are learned.
POSITIVES, DISGUISED = 6, 40
#: Letters that a piece's disguises put in, and what each disguise weighs beside the piece.
INSERTED, DISGUISE_COST = 4, 0.25
#: A further positive piece has this share of the worst one's margin, or is in so many toxic documents.
LIKE_WORST, OFTEN = 0.8, 10
#: Worst pieces of a clean document that are taken as negatives, and what each time weighs.
WORST, HARD_COST = 3, 4.0
#: A document in so many is left out of the machine and fits the curve from margin to score.
CALIBRATION = 5
MEMO_WORDS = 600_000
#: Words whose triples are in memory at once, alone and against all landmarks.
WORDS_AT_ONCE, KERNEL_ROWS = 5_000, 250
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
_OFFSETS = [(j, k, DECAY ** (k - 2)) for k in range(2, REACH) for j in range(1, k)]
#: Letters that stand alone between blanks or signs, four or more in a row, are read as one word too.
_SPACED = re.compile(r"(?<![^\W\d_])[^\W\d_](?:[\W\d_]{1,4}[^\W\d_]){3,}(?![^\W\d_])")
_SIGNS = re.compile(r"[\W\d_]+")


def letter_codes(points: np.ndarray) -> np.ndarray:
    """Code points to letter classes: 1 to 26 for a to z in either case, 27 to 34 for other letters, 35 and 36 for a beginning and an end, 0 for signs."""
    lower = points | 32
    plain = (lower >= 97) & (lower <= 122) & (points < 128)
    mark = np.where(points == ord(FIRST), BEGIN, np.where(points == ord(LAST), END, 0))
    return np.where(points < 4, mark, np.where(plain, lower - 96, np.where(points >= 0xC0, 27 + points % 8, 0))).astype(np.int64)


def pieces(word: str) -> list[str]:
    """What the kernel reads of a word: its letters between marks of beginning and end, in windows if they are many.

    Words of fewer letters than LEAST say nothing: one triple would be all they have.
    """
    letters = _SIGNS.sub("", word).lower()
    if len(letters) < LEAST:
        return [""]
    letters = FIRST + letters + LAST
    if len(letters) <= WINDOW:
        return [letters]
    return [letters[k : k + WINDOW] for k in range(0, len(letters) - WINDOW + STEP, STEP)]


def words_of(text: str) -> list[str]:
    """The words of a text, and letters that stand alone in a row as one word."""
    words = pc.utf8_split_whitespace(pa.array([text]))[0].as_py()
    return words + _SPACED.findall(text)


def triples(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window, triple and weight of every distinct triple of each window, by window."""
    window = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    keys, weight = [], []
    for j, k, w in _OFFSETS:
        n = len(codes) - k
        if n <= 0:
            continue
        first, second, third = codes[:n], codes[j : n + j], codes[k : n + k]
        good = np.flatnonzero((window[:n] == window[k : n + k]) & (first > 0) & (second > 0) & (third > 0))
        keys.append(window[good] * CODES + (first[good] * LETTERS + second[good]) * LETTERS + third[good])
        weight.append(np.full(len(good), w))
    if not keys or not (n := sum(map(len, keys))):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    key, value = np.concatenate(keys), np.concatenate(weight)
    order = np.argsort(key, kind="stable")
    key, value = key[order], value[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    key = key[first]
    return key // CODES, key % CODES, np.add.reduceat(value, first)


def normalised(some: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(piece, triple, weight), where the weights of a piece have length one, and that length before."""
    points = np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    bounds = np.concatenate(([0], np.cumsum(np.fromiter(map(len, some), np.int64, len(some)))))
    piece, triple, weight = triples(letter_codes(points), bounds)
    norm = np.sqrt(np.bincount(piece, weight**2, minlength=len(some)))
    return piece, triple, weight / norm[piece] if len(piece) else weight, norm


def kernel(some: list[str], landmarks: np.ndarray) -> np.ndarray:
    """Kernel of each piece with landmark rows of shape (CODES, landmarks)."""
    out = np.zeros((len(some), landmarks.shape[1]))
    for a in range(0, len(some), KERNEL_ROWS):
        piece, triple, weight, _ = normalised(some[a : a + KERNEL_ROWS])
        if len(piece):
            first = np.flatnonzero(np.concatenate(([True], piece[1:] != piece[:-1])))
            out[a + piece[first]] = np.add.reduceat(landmarks[triple] * weight[:, None], first)
    return out


@dataclass
class Model:
    table: np.ndarray
    bias: float
    slope: float = 4.0
    shift: float = 0.0

    def of_pieces(self, some: list[str]) -> np.ndarray:
        out = [np.empty(0)]
        for k in range(0, len(some), WORDS_AT_ONCE):
            part = some[k : k + WORDS_AT_ONCE]
            piece, triple, weight, _ = normalised(part)
            out.append(np.bincount(piece, self.table[triple] * weight, minlength=len(part)) + self.bias)
        return np.concatenate(out)

    def margins(self, words: list[str]) -> np.ndarray:
        """Each word's largest margin among its pieces."""
        if not words:
            return np.empty(0)
        cut = [pieces(w) for w in words]
        each = self.of_pieces([p for c in cut for p in c])
        ends = np.cumsum([len(c) for c in cut])
        return np.maximum.reduceat(each, np.concatenate(([0], ends[:-1])))

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -40, 40)))


def machine(features: np.ndarray, label: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Linear support vector machine with squared hinge loss, by Newton steps over its support vectors."""
    x = np.hstack([features, np.ones((len(features), 1))])
    w, last = np.zeros(x.shape[1]), None
    ridge = PENALTY * cost.sum() * np.eye(x.shape[1])
    for _ in range(30):
        inside = label * (x @ w) < 1
        if last is not None and np.array_equal(inside, last):
            break
        last, z = inside, x[inside]
        w = np.linalg.solve(ridge + (z * cost[inside][:, None]).T @ z, (z * (cost * label)[inside][:, None]).sum(axis=0))
    return w


def calibrated(margins: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve from margin to label, with softened targets."""
    target = np.where(label == 1, (label.sum() + 1) / (label.sum() + 2), 1 / ((1 - label).sum() + 2))
    x, w = np.stack([margins, np.ones(len(margins))], axis=1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (p - target) + 1e-6 * w)
        w = w - np.clip(step, -2, 2)
    return float(w[0]), float(w[1])


def disguises(piece: str) -> list[str]:
    """The piece as insults are disguised: letters put in at one place or into every gap, a letter left out."""
    draw = random.Random(piece)
    body = piece.removeprefix(FIRST).removesuffix(LAST)
    head, tail = piece[: piece.index(body)], piece[piece.index(body) + len(body) :]
    out = []
    for letter in draw.sample(string.ascii_lowercase, INSERTED):
        at = draw.randrange(1, len(body))
        out.append(head + body[:at] + 2 * letter + body[at:] + tail)
        out.append((head + letter.join(body) + tail)[:WINDOW])
    at = draw.randrange(1, len(body))
    return [*out, head + body[:at] + body[at + 1 :] + tail]


def learned(bags: list[np.ndarray], labels: np.ndarray, everything: list[str]) -> Model:
    """The machine over pieces; ``bags`` are places in ``everything``.

    Rounds go back and forth between machine and toxic sentences: a toxic document's positive
    pieces are at first those most particular to toxic documents, later those of the largest
    margins; to the negatives come the worst pieces of clean documents.
    """
    toxic, clean = ([b for b, y in zip(bags, labels, strict=True) if y == c] for c in (1, 0))
    seen, elsewhere = (np.bincount(np.concatenate(b), minlength=len(everything)) for b in (toxic, clean))
    long = np.fromiter((len(p) > LEAST for p in everything), bool, len(everything))
    particular = seen / (seen + 3 * len(toxic) / len(clean) * elsewhere + 3) * long
    # A piece is positive only if it is more often in toxic documents than in clean ones by far.
    able = long & (seen * len(clean) > 8 * elsewhere * len(toxic))
    chosen = [b[able[b]] for b in toxic]
    chosen = [b[np.argsort(-particular[b], kind="stable")[:POSITIVES]] for b in chosen]
    chosen = [c[(particular[c] >= 0.5) | (np.arange(len(c)) == 0)] for c in chosen]
    pool = [i for i in np.argsort(-elsewhere, kind="stable").tolist() if elsewhere[i]]
    even = pool[: NEGATIVES // 2] + pool[NEGATIVES // 2 :: max(1, -(-len(pool) * 2 // NEGATIVES))]
    hard: Counter[int] = Counter()
    for _ in range(ROUNDS):
        often = Counter(i for c in chosen for i in c.tolist())
        positive = sorted(often, key=lambda i: (-often[i], everything[i]))
        negative = sorted(set(even).union(hard) - set(positive))
        names = [everything[i] for i in positive]
        longer = [i for i in positive if len(everything[i]) > LEAST + 1][:DISGUISED]
        disguised = [p for i in longer for p in disguises(everything[i])]
        marks = names[: LANDMARKS // 2] + disguised[: LANDMARKS // 4] + [everything[i] for i, _ in hard.most_common(LANDMARKS // 8)]
        marks += [everything[i] for i in negative[:: max(1, len(negative) * 8 // LANDMARKS)]][: LANDMARKS // 8]
        piece, triple, weight, _ = normalised(marks)
        rows_of = np.zeros((CODES, len(marks)), np.float32)
        rows_of[triple, piece] = weight
        own = kernel(marks, rows_of)
        value, vector = np.linalg.eigh((own + own.T) / 2)
        keep = value > 1e-8 * value.max()
        to_features = vector[:, keep] / np.sqrt(value[keep])
        x = kernel(names + disguised + [everything[i] for i in negative], rows_of) @ to_features
        y = np.repeat([1.0, 1.0, -1.0], [len(names), len(disguised), len(negative)])
        cost = np.concatenate([np.sqrt([often[i] for i in positive]), np.repeat([DISGUISE_COST * often[i] ** 0.5 for i in longer], 2 * INSERTED + 1), [1.0 + HARD_COST * hard[i] for i in negative]])
        some = len(names) + len(disguised)
        cost[:some] *= cost[some:].sum() / cost[:some].sum() / 2
        w = machine(x, y, cost)
        model = Model(rows_of @ (to_features @ w[:-1]), float(w[-1]))
        margin = model.of_pieces(everything)
        worst = (b[np.argsort(-margin[b], kind="stable")[:WORST]].tolist() for b in clean)
        hard.update(i for some in worst for i in some)
        chosen = [b[able[b]] for b in toxic]
        chosen = [b[np.argsort(-margin[b], kind="stable")[:POSITIVES]] for b in chosen]
        # Beside the worst piece, those of a like margin or seen often; pieces that only came along drop out.
        like = [margin[c] > max(0.0, LIKE_WORST * margin[c[:1]].max(initial=0.0)) for c in chosen]
        first = [(np.arange(len(c)) == 0) & (margin[c] > -1) for c in chosen]
        chosen = [c[x | y | (seen[c] >= OFTEN)] for c, x, y in zip(chosen, like, first, strict=True)]
    return model


def fit(rows: list[tuple[str, int]]) -> Model:
    """Model from texts with labels; without a row of either class, one that scores all alike.

    One document in CALIBRATION is kept from the machine; its margin fits the curve to scores.
    """
    place: dict[str, int] = {}
    bags, labels = [], []
    for text, label in rows:
        found = {p for w in words_of(text) for p in pieces(w)}
        if found:
            bags.append(np.array(sorted(place.setdefault(p, len(place)) for p in sorted(found)), np.int32))
            labels.append(label)
    y = np.array(labels)
    if not rows or not (y == 1).any() or not (y == 0).any():
        return Model(np.zeros(CODES), 0.0, 1.0, 0.0 if not rows else 2.0 if (y == 1).any() else -2.0)
    everything = list(place)
    order = np.argsort(y, kind="stable")
    apart = np.zeros(len(y), bool)
    apart[order[:: CALIBRATION]] = True
    if not all((y[~apart] == c).any() and (y[apart] == c).any() for c in (0, 1)):
        apart[:] = False
    model = learned([b for b, out in zip(bags, apart, strict=True) if not out], y[~apart], everything)
    margin = model.of_pieces(everything)
    judged = apart if apart.any() else ~apart
    model.slope, model.shift = calibrated(np.array([margin[b].max() for b, j in zip(bags, judged, strict=True) if j]), y[judged])
    return model


class Scorer:
    """Largest margin of each row of a text column; holds the words that the process has met."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.words, self.margins = pa.array([], pa.string()), np.empty(0)

    def of_words(self, words: pa.Array) -> np.ndarray:
        if len(self.words) + len(words) > MEMO_WORDS:
            self.forget()
        known = pc.index_in(words, value_set=self.words)
        new = known.is_null().to_numpy(zero_copy_only=False)
        at = known.fill_null(0).to_numpy().astype(np.int64)
        if new.any():
            first, more = len(self.words), words.filter(pa.array(new))
            margins = [self.model.margins(more.slice(k, 50_000).to_pylist()) for k in range(0, len(more), 50_000)]
            self.margins = np.concatenate([self.margins, *margins])
            self.words = pa.concat_arrays([self.words, more])
            at[new] = np.arange(first, len(self.words))
        return self.margins[at]

    def __call__(self, column: pa.Array) -> np.ndarray:
        column = column.fill_null("").cast(pa.string())
        split = pc.utf8_split_whitespace(column)
        words = split.flatten().dictionary_encode()
        margin = self.of_words(words.dictionary)[words.indices.to_numpy()] if len(words) else np.empty(0)
        lengths = pc.list_value_length(split).to_numpy()
        # Splitting leaves an empty word at white space on either end; it has no triple.
        out = np.full(len(column), self.model.bias)
        some = np.flatnonzero(lengths)
        if len(some):
            out[some] = np.maximum(out[some], np.maximum.reduceat(margin, (np.cumsum(lengths) - lengths)[some]))
        rows = np.flatnonzero(with_lone_letters(column))
        for i, text in zip(rows.tolist(), column.take(pa.array(rows)).to_pylist(), strict=True):
            if spaced := _SPACED.findall(text):
                out[i] = max(out[i], self.model.margins(spaced).max())
        return out


def with_lone_letters(column: pa.Array) -> np.ndarray:
    """Rows where four letters a-z that stand alone lie close together; only there letters in a row are looked for."""
    data, ends = text_buffer(column)
    lower = data | 32
    letter = (lower >= 97) & (lower <= 122) & (data < 128)
    near = np.zeros(len(data) + 2, bool)
    near[1:-1] = letter
    at = np.flatnonzero(letter & ~near[:-2] & ~near[2:])
    row = np.searchsorted(ends, at, side="right") - 1
    out = np.zeros(len(column), bool)
    if len(at) > 3:
        # Four letters with up to four characters, of up to four bytes, between two of them.
        out[row[3:][(row[3:] == row[:-3]) & (at[3:] - at[:-3] <= 51)]] = True
    return out


def train(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_PER_CLASS, max_bytes: int = TRAIN_BYTES) -> Model:
    return fitted(docs, labels, "toxic", FOLDS, HELD_OUT, per_class, max_bytes, lambda rows, _: fit(rows))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``_score``; null and empty texts have the score of a text without any triple."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.withColumn("_score", F.lit(0.0)).schema

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(held.value)
        for batch in bounded(batches, "text", SLICE_BYTES):
            scores = held.value.scores(scorer(batch.column("text")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, "_score"])

    return docs.mapInArrow(scored, schema)


def classify(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. Repeated and null ids are scored by their text; an empty table gives no rows."""
    found = score(docs.select("doc_id", "text"), model or train(docs, labels))
    return found.select("doc_id", held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """The documents below the threshold, all columns as they were; one pass, nothing is shuffled."""
    return score(docs, model or train(docs, labels)).filter(F.col("_score") < THRESHOLD).drop("_score")
