"""Line quality rules: base counts per text, and a linear-chain CRF over lines decoded by Viterbi.

Every line that has a word becomes one position of a chain with two states, content and boilerplate.
A line's features are bits of one integer; the chain has a weight per (state, feature) and per
(state, state). ``fit`` trains the weights by maximum likelihood (forward-backward, Adam) on a
bounded sample of labelled documents; ``rules`` decodes whole texts in one pass without a shuffle
and keeps a document when the words of content lines make up enough of its characters.

Defined cases: a null or empty text has no words, so it fails the base rules. A null ``doc_id``
passes through. Repeated rows are judged each on their own. Without usable labels the model has
zero weights and keeps what the base rules keep. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm import common

CONTENT, BOILERPLATE = 1, 0
FEATURES = ("bias", "symbol", "symbols_tenth", "symbols_half", "bars", "shout", "shouts_fifth", "upper", "digits_fifth",
            "link", "words_to_3", "words_to_9", "words_30", "distinct_under_half", "distinct_under_four_fifths",
            "short_words", "long_words", "ends_sentence", "seen_before", "begins_text")
#: Labelled documents of each class that the model is fitted on (chosen by hash of the id).
FIT_DOCUMENTS = 1000
#: A document is kept when at least this share of its word characters lies in content lines.
CONTENT_SHARE = 0.5
#: Base rules: fewest words, and most words in repeated 8-word windows, in hundredths.
LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8
SYMBOLS = "#*$%&|<>"
#: Bytes of text judged at once: a task holds some fifteen times as much in arrays and strings.
JUDGED_BYTES = 1 << 20

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, content_share double, n_lines long, n_content_lines long")

_SYMBOL = re.compile("[" + re.escape(SYMBOLS) + "]")
_DIGIT = re.compile("[0-9]")


def line_features(line: str, seen: bool, begins: bool) -> int:
    """The feature bits of one line that has a word."""
    parts = line.split()
    n, chars = max(1, len(parts)), len(line)
    symbols = len(_SYMBOL.findall(line))
    shouts = line.count("!")
    distinct = len(set(parts))
    mean = (chars - n + 1) / n
    low = line.lower()
    flags = (True, symbols > 0, 10 * symbols >= n, 2 * symbols >= n, 4 * line.count("|") >= n, shouts > 0, 5 * shouts >= n,
             line.isupper(), 5 * len(_DIGIT.findall(line)) >= chars, "http" in low or "www." in low or "@" in low,
             n <= 3, n <= 9, n >= 30, 2 * distinct < n, 5 * distinct < 4 * n,
             mean < 3, mean > 12, line.rstrip()[-1:] in ".!?", seen, begins)
    return sum(1 << k for k, on in enumerate(flags) if on)


def lines_of(text: str) -> tuple[list[int], list[int], int]:
    """(feature bits, word characters) of every line that has a word, and how many equal an earlier one."""
    bits, sizes, earlier, again = [], [], set(), 0
    for line in text.split("\n"):
        size = len(line) - sum(map(line.count, common.WHITE))
        if not size:
            continue
        seen = line in earlier
        again += seen
        earlier.add(line)
        bits.append(line_features(line, seen, not bits))
        sizes.append(size)
    return bits, sizes, again


def _matrix(bits: np.ndarray) -> np.ndarray:
    return ((bits[:, None] >> np.arange(len(FEATURES))) & 1).astype(np.float64)


class Model:
    """Weights of the chain: ``emit[state, feature]`` and ``step[from, to]``."""

    def __init__(self, emit: np.ndarray | None = None, step: np.ndarray | None = None):
        self.emit = np.zeros((2, len(FEATURES))) if emit is None else emit
        self.step = np.zeros((2, 2)) if step is None else step

    def scores(self, bits: np.ndarray) -> np.ndarray:
        return _matrix(bits) @ self.emit.T

    def decode(self, scores: np.ndarray) -> np.ndarray:
        """Best state of each position (Viterbi); a tie goes to content."""
        (bb, bc), (cb, cc) = self.step.tolist()
        back, b, c = [], 0.0, 0.0
        for k, (to_b, to_c) in enumerate(scores.tolist()):
            if k:
                from_b, from_c = (CONTENT if c + cb >= b + bb else BOILERPLATE), (CONTENT if c + cc >= b + bc else BOILERPLATE)
                back.append((from_b, from_c))
                b, c = max(b + bb, c + cb) + to_b, max(b + bc, c + cc) + to_c
            else:
                b, c = to_b, to_c
        state = CONTENT if c >= b else BOILERPLATE
        out = [state]
        for pair in reversed(back):
            state = pair[state]
            out.append(state)
        return np.array(out[::-1], dtype=np.int64)


def train(chains: list[tuple[np.ndarray, np.ndarray]], rounds: int = 150, ridge: float = 1e-3, rate: float = 0.1) -> Model:
    """Maximum-likelihood weights for (feature bits, states) chains.

    Chains are laid side by side, longest first, so each step of forward and backward is one
    vector operation over the chains that are still running.
    """
    chains = sorted((c for c in chains if len(c[0])), key=lambda c: -len(c[0]))
    model = Model()
    if not chains:
        return model
    lengths = np.array([len(c[0]) for c in chains])
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    x = _matrix(np.concatenate([c[0] for c in chains]))
    y = np.concatenate([c[1] for c in chains])
    longest = int(lengths[0])
    running = [int((lengths > t).sum()) for t in range(longest)]
    inner = np.ones(len(y), bool)
    inner[first] = False
    follow = np.flatnonzero(inner)
    emp_emit = np.stack([x[y == s].sum(0) for s in (0, 1)])
    emp_step = np.zeros((2, 2))
    np.add.at(emp_step, (y[follow - 1], y[follow]), 1)
    params = np.zeros(2 * len(FEATURES) + 4)
    m, v = np.zeros_like(params), np.zeros_like(params)
    for k in range(1, rounds + 1):
        emit, step = params[:-4].reshape(2, -1), params[-4:].reshape(2, 2)
        score = x @ emit.T
        alpha, beta = np.empty_like(score), np.zeros_like(score)
        for t in range(longest):
            at = first[:running[t]] + t
            if t == 0:
                alpha[at] = score[at]
            else:
                z = alpha[at - 1][:, :, None] + step
                alpha[at] = np.logaddexp(z[:, 0], z[:, 1]) + score[at]
        for t in range(longest - 2, -1, -1):
            at = first[:running[t + 1]] + t
            z = step + (score[at + 1] + beta[at + 1])[:, None, :]
            beta[at] = np.logaddexp(z[:, :, 0], z[:, :, 1])
        ends = first + lengths - 1
        norm = np.repeat(np.logaddexp(alpha[ends, 0], alpha[ends, 1]), lengths)
        post = np.exp(alpha + beta - norm[:, None])
        grad_emit = emp_emit - post.T @ x
        pair = alpha[follow - 1][:, :, None] + step + (score[follow] + beta[follow])[:, None, :] - norm[follow][:, None, None]
        grad_step = emp_step - np.exp(pair).sum(0)
        grad = np.concatenate([grad_emit.ravel(), grad_step.ravel()]) / len(y) - ridge * params
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        params = params + rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return Model(params[:-4].reshape(2, -1).copy(), params[-4:].reshape(2, 2).copy())


def fit(docs: DataFrame, labels: DataFrame, per_class: int = FIT_DOCUMENTS) -> Model:
    """Train on at most ``per_class`` labelled documents of each class (smallest hashes of the id).

    A low-quality document's lines are boilerplate; a good one's are content, but for lines that
    repeat an earlier line of it. Only feature bits travel to the driver. Null labels are no labels.
    """
    known = labels.select("doc_id", "quality").where("doc_id is not null and quality in (0, 1)").distinct()
    picks = [known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for q in (0, 1)]
    ids = F.broadcast(picks[0].unionByName(picks[1]))          # at most 2 * per_class rows of two numbers
    rows = (docs.select("doc_id", "text").join(ids, "doc_id")
            .mapInArrow(_chain_bits, "doc_id long, quality int, bits binary"))
    chains = []
    for row in rows.orderBy("doc_id", "quality", "bits").toLocalIterator():
        bits = np.frombuffer(row["bits"], dtype=np.int32).astype(np.int64)
        seen = (bits >> FEATURES.index("seen_before")) & 1
        chains.append((bits, np.where((row["quality"] == 1) & (seen == 0), CONTENT, BOILERPLATE)))
    return train(chains)


def _chain_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches, most=JUDGED_BYTES):
        bits = [np.array(lines_of(t or "")[0], dtype=np.int32).tobytes() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), batch.column("quality").cast(pa.int32()), pa.array(bits, pa.binary())],
            names=["doc_id", "quality", "bits"])


def repeated_words(w: common.Words, size: int = WINDOW) -> np.ndarray:
    """Per document: words in windows of ``size`` words found twice or more in the same text."""
    total = int(w.offsets[-1])
    inside = np.flatnonzero(common.starts_inside(w.offsets, size))
    if not inside.size:
        return np.zeros(w.offsets.size - 1, np.int64)
    owner = np.repeat(np.arange(w.offsets.size - 1, dtype=np.uint64), np.diff(w.offsets))
    key = common.grams(w.hashes, size)[inside] ^ common.mix(owner[inside] + np.uint64(1))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(key.size, bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    return common.per_document(common.covered(inside[twice], size, total), w.offsets)


def verdicts(part: pa.RecordBatch, model: Model, content_share: float) -> list[tuple]:
    """One tuple per row of the slice: the columns of ``SCHEMA`` after ``doc_id``."""
    raw, offsets = common.text_buffer(part.column("text"))
    w = common.words(raw, offsets)
    n_words, repeated = np.diff(w.offsets), repeated_words(w)
    rows = []
    for text, n, again in zip(part.column("text").to_pylist(), n_words.tolist(), repeated.tolist(), strict=True):
        text = text or ""
        bits, sizes, dups = lines_of(text)
        chars = sum(sizes)
        failed = n < LEAST_WORDS or 100 * again > MOST_REPEATED * n
        share, good = 0.0, 0
        if bits:
            states = model.decode(model.scores(np.array(bits, dtype=np.int64)))
            good = int(states.sum())
            share = float(np.dot(states, sizes)) / chars
        rows.append((n, chars, sum(map(text.count, SYMBOLS)), dups, again, failed,
                     not failed and share >= content_share, share, len(bits), good))
    return rows


def rules(docs: DataFrame, model: Model, content_share: float = CONTENT_SHARE) -> DataFrame:
    """Counts, base verdict and final verdict of every document (see ``SCHEMA``)."""
    kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] + [pa.int64()] * 2
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches, most=JUDGED_BYTES):
            rows = zip(*verdicts(part, model, content_share), strict=True)
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()),
                                              *(pa.array(c, k) for c, k in zip(rows, kinds, strict=True))], names=names)

    return docs.select("doc_id", "text").mapInArrow(judge, SCHEMA)


def filtered(docs: DataFrame, model: Model, content_share: float = CONTENT_SHARE) -> DataFrame:
    """The documents that the rules keep, with all their columns, in one pass over each text."""
    kept = SCHEMA.split(", ").index("kept boolean") - 1

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches, most=JUDGED_BYTES):
            yield part.filter(pa.array([row[kept] for row in verdicts(part, model, content_share)], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
