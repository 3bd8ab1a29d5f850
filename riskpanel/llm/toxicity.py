"""Toxicity: a linear-chain conditional random field over the words of a text.

Only documents carry labels, so words are labelled first: in a toxic training document,
the words whose spelling (the word, or one of its beginnings) is much more frequent in
toxic documents than in others are the toxic span; every other word is clean. A field
with two states learns these sequences. Its forward-backward marginals give every word a
probability; a document's score comes from its words' probabilities, and runs of words
above one half are the offending spans.

The marginals of many documents are computed together, as products of 2 x 2 matrices in
blocks, so a text of any length costs its length and no more steps than a short one.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel.llm.common import packed, ship

_WORDS = re.compile(r"[^\W\d_]+")
_PREFIXES = range(3, 9)
_LONGEST_WORD = 40
_MEMO_ENTRIES = 200_000
_SCAN = 32
_TOKENS_AT_ONCE = 1 << 16
_ROWS_AT_ONCE = 512


def spellings(word: str) -> list[str]:
    """The word and its beginnings, as feature names."""
    return ["=" + word[:_LONGEST_WORD], *(word[:n] for n in _PREFIXES if n <= len(word))]


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of 2 x 2 matrices held as rows (4, ...), scaled to sum to one."""
    out = np.empty_like(b)
    out[0] = a[0] * b[0] + a[1] * b[2]
    out[1] = a[0] * b[1] + a[1] * b[3]
    out[2] = a[2] * b[0] + a[3] * b[2]
    out[3] = a[2] * b[1] + a[3] * b[3]
    out /= out[0] + out[1] + out[2] + out[3]
    return out


def running_products(m: np.ndarray) -> np.ndarray:
    """Products of the first 1, 2, ... matrices of (4, n), each scaled to sum to one."""
    n = m.shape[1]
    if n <= 8:
        out = m.copy()
        for i in range(1, n):
            out[:, i] = _times(out[:, i - 1], m[:, i])
        return out
    blocks = -(-n // _SCAN)
    padded = np.zeros((4, blocks * _SCAN))
    padded[:, :n], padded[0, n:], padded[3, n:] = m, 1.0, 1.0
    inner = np.ascontiguousarray(padded.reshape(4, blocks, _SCAN).transpose(2, 0, 1))  # steps first
    for i in range(1, _SCAN):
        inner[i] = _times(inner[i - 1], inner[i])
    if blocks > 1:
        before = running_products(np.ascontiguousarray(inner[-1][:, :-1]))
        for i in range(_SCAN):
            inner[i][:, 1:] = _times(before, inner[i][:, 1:])
    return inner.transpose(1, 2, 0).reshape(4, -1)[:, :n]


@dataclass
class Chain:
    """Weights of the field and of the document score."""

    weights: dict[str, float]
    bias: float
    moves: np.ndarray  # log-potentials from state to state
    start: np.ndarray
    document: np.ndarray  # of a constant and the document features

    def __post_init__(self):
        self.openings = {s.removeprefix("=")[:3] for s in self.weights}

    def unary(self, word: str) -> float:
        """Log-potential of the toxic state against the clean one."""
        if word[:3] not in self.openings:
            return self.bias
        return self.bias + sum(self.weights.get(s, 0.0) for s in spellings(word))


def marginals(unary: np.ndarray, lengths: np.ndarray, moves: np.ndarray, start: np.ndarray, with_moves: bool = False):
    """P(toxic) of each word of the concatenated texts, and the expected moves over all of them.

    Whole texts are taken together up to some number of words, which bounds the memory.
    """
    lengths = lengths[lengths > 0]
    p, pairs = np.empty(len(unary)), np.zeros((2, 2))
    ends = np.cumsum(lengths)
    at = done = 0
    while at < len(lengths):
        stop = max(at + 1, int(np.searchsorted(ends, done + _TOKENS_AT_ONCE, side="right")))
        part = slice(done, int(ends[stop - 1]))
        p[part], some = _marginals(unary[part], lengths[at:stop], moves, start, with_moves)
        pairs += some
        at, done = stop, part.stop
    return p, pairs


def _marginals(unary: np.ndarray, lengths: np.ndarray, moves: np.ndarray, start: np.ndarray, with_moves: bool):
    """``marginals`` of texts that all have words."""
    first = np.zeros(len(unary), bool)
    first[np.concatenate([[0], np.cumsum(lengths)[:-1]])] = True
    toxic = np.exp(np.clip(unary, -30, 30))
    e = np.exp(moves)
    step = np.stack([np.full(len(unary), e[0, 0]), e[0, 1] * toxic, np.full(len(unary), e[1, 0]), e[1, 1] * toxic])
    into = step.copy()
    into[0::2, first] = math.exp(start[0])  # what came before doesn't matter
    into[1::2, first] = math.exp(start[1]) * toxic[first]
    product = running_products(into)
    forward = np.stack([product[0] + product[2], product[1] + product[3]])
    onward = np.empty_like(step)
    onward[:, :-1] = step[[0, 2, 1, 3], 1:]
    onward[:, np.append(first[1:], True)] = 1.0
    product = running_products(onward[:, ::-1])[:, ::-1]
    backward = np.stack([product[0] + product[2], product[1] + product[3]])
    both = forward * backward
    p = both[1] / (both[0] + both[1])
    if not with_moves:
        return p, np.zeros((2, 2))
    at = np.flatnonzero(~first)
    pairs = np.repeat(forward[:, at - 1], 2, axis=0) * step[:, at] * np.tile(backward[:, at], (2, 1))
    pairs /= pairs.sum(axis=0)
    return p, pairs.sum(axis=1).reshape(2, 2)


def document_features(p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per document: a constant, the largest marginal, and the log of their sum and share."""
    ends = np.cumsum(lengths)
    total = np.concatenate([[0.0], np.cumsum(p)])
    mass = total[ends] - total[ends - lengths]
    top = np.zeros(len(lengths))
    filled = lengths > 0
    if filled.any():
        top[filled] = np.maximum.reduceat(p, (ends - lengths)[filled])
    share = mass / np.maximum(lengths, 1)
    return np.stack([np.ones(len(lengths)), top, np.log1p(mass), np.log(share + 1e-3) + 7], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30, penalty: float = 1e-2) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (q * (1 - q))[:, None]).T @ x + penalty * np.eye(len(w))
        w += np.linalg.solve(hessian, x.T @ (y - q) - penalty * w)
    return w


def fit(texts: list[str], labels: list[int], least: float = 16.0, rounds: int = 30, penalty: float = 0.05) -> Chain:
    """A field from labelled texts.

    A spelling marks a word of a toxic text as toxic if it is more frequent in toxic texts
    and the likelihood ratio of the two frequencies (G squared) is at least ``least``.
    Without texts of both labels the score is the (smoothed) share of toxic ones.
    """
    y = np.array(labels, float)
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    flat = np.zeros((2, 2))
    if not n1 or not n0:
        prior = math.log((n1 + 1) / (n0 + 1)) if labels else 0.0
        return Chain({}, -10.0, flat, np.zeros(2), np.array([prior, 0.0, 0.0, 0.0]))
    words = [_WORDS.findall(t.lower()) for t in texts]
    counts = Counter(), Counter()
    for found, label in zip(words, labels, strict=True):
        counts[label].update({s for w in set(found) for s in spellings(w)})
    odds = {}
    for s, c1 in counts[1].items():
        c0, share = counts[0][s], n1 / (n1 + n0)
        ratio = c1 * math.log(c1 / ((c0 + c1) * share)) + (c0 and c0 * math.log(c0 / ((c0 + c1) * (1 - share))))
        if c1 > (c0 + c1) * share and 2 * ratio >= least:
            odds[s] = math.log((c1 + 0.5) / (n1 + 1)) - math.log((c0 + 0.5) / (n0 + 1))
    names = {s: i for i, s in enumerate(sorted(odds))}
    marked = {}

    def of(word: str) -> list[int]:
        if word not in marked:
            marked[word] = [names[s] for s in spellings(word) if s in names]
        return marked[word]

    lengths = np.array([len(w) for w in words])
    rows, columns, target = [], [], np.zeros(int(lengths.sum()))
    at = 0
    for found, label in zip(words, labels, strict=True):
        for w in found:
            if hits := of(w):
                rows += [at] * len(hits)
                columns += hits
                target[at] = label
            at += 1
    rows, columns = np.array(rows, np.int64), np.array(columns, np.int64)
    first = np.concatenate([[0], np.cumsum(lengths[lengths > 0])[:-1]]) if at else np.zeros(0, int)
    truth = np.zeros((2, 2))
    inner = np.ones(at, bool)
    inner[first] = False
    kind = target.astype(int)
    np.add.at(truth, (kind[:-1][inner[1:]], kind[inner]), 1)
    begun = np.bincount(kind[first], minlength=2) if at else np.zeros(2)
    theta = np.zeros(len(names) + 1 + 4 + 2)  # spellings, bias, moves, start
    theta[len(names)] = math.log((target.sum() + 1) / (at - target.sum() + 1))
    theta[: len(names)] = [odds[s] / 2 for s in names]
    squares = np.full_like(theta, 1e-8)
    for _ in range(rounds):
        unary = np.full(at, theta[len(names)])
        unary += np.bincount(rows, theta[columns], minlength=at)
        moves, start = theta[-6:-2].reshape(2, 2), theta[-2:]
        p, pairs = marginals(unary, lengths, moves, start, with_moves=True)
        rest = target - p
        gradient = np.empty_like(theta)
        gradient[: len(names)] = np.bincount(columns, rest[rows], minlength=len(names))
        gradient[len(names)] = rest.sum()
        gradient[-6:-2] = (truth - pairs).ravel()
        gradient[-2:] = begun - np.array([len(first) - p[first].sum(), p[first].sum()])
        gradient -= penalty * theta
        squares += gradient**2
        theta += 0.5 * gradient / np.sqrt(squares)
    unary = np.full(at, theta[len(names)])
    unary += np.bincount(rows, theta[columns], minlength=at)
    moves, start = theta[-6:-2].reshape(2, 2).copy(), theta[-2:].copy()
    p, _ = marginals(unary, lengths, moves, start)
    document = _logistic(document_features(p, lengths), y)
    return Chain({s: float(theta[i]) for s, i in names.items()}, float(theta[len(names)]), moves, start, document)


class _Unaries(dict):
    """Log-potentials of words met so far."""

    def __init__(self, chain: Chain):
        super().__init__()
        self.chain = chain

    def __missing__(self, word: str) -> float:
        if len(self) >= _MEMO_ENTRIES:
            self.clear()
        self[word] = value = self.chain.unary(word)
        return value


def tag(chain: Chain, memo: dict[str, float], texts: list[str]) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
    """Score of each text and the character offsets of its toxic spans."""
    scores, spans = np.zeros(len(texts)), [[] for _ in texts]
    start = 0
    while start < len(texts):
        stop, lengths, unary = start, [], []
        while stop < len(texts) and (stop == start or sum(lengths) < _TOKENS_AT_ONCE):
            found = _WORDS.findall(texts[stop].lower())
            lengths.append(len(found))
            unary.append(np.fromiter(map(memo.__getitem__, found), float, len(found)))
            stop += 1
        size = np.array(lengths)
        p, _ = marginals(np.concatenate(unary), size, chain.moves, chain.start)
        scores[start:stop] = 1 / (1 + np.exp(-np.clip(document_features(p, size) @ chain.document, -30, 30)))
        ends = np.cumsum(size)
        for i in np.unique(np.searchsorted(ends, np.flatnonzero(p > 0.5), side="right")):
            spans[start + i] = _spans(texts[start + i], p[ends[i] - size[i] : ends[i]])
        start = stop
    return scores, spans


def _spans(text: str, p: np.ndarray) -> list[tuple[int, int]]:
    """Runs of toxic words as (start, end) in the text as it stands."""
    lowered = text.lower()
    # a character may have a longer lower case: then each place is that of its character
    place = [i for i, c in enumerate(text) for _ in c.lower()] if len(lowered) != len(text) else range(len(text))
    out, before = [], -2
    for i, match in enumerate(_WORDS.finditer(lowered)):
        if p[i] > 0.5:
            start, end = place[match.start()], place[match.end() - 1] + 1
            out.append((out.pop()[0], end) if before == i - 1 else (start, end))
            before = i
    return out


def is_held_out(doc_id: str = "doc_id"):
    """Whether a row's label must not be learned from."""
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 2000, sample_chars: int = 8_000) -> Chain:
    """A field from at most ``sample_rows`` labelled rows that aren't held out, half of each label.

    The rows with the smallest hash of doc_id are taken, among texts of at most
    ``sample_chars`` characters; this bounds what the driver holds. Rows without a label
    or text teach nothing; of several labels of one document the larger counts.
    """
    marks = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out())
    marks = marks.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("label"))
    known = docs.filter(F.col("text").isNotNull() & (F.char_length("text") <= sample_chars))
    known = known.select("doc_id").distinct().join(marks, "doc_id")
    chosen = [
        known.filter(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows // 2) for v in (0, 1)
    ]
    ids = {r["doc_id"]: r["label"] for r in chosen[0].unionByName(chosen[1]).collect()}
    wanted = docs.sparkSession.createDataFrame([(i,) for i in ids], "wanted long")
    rows = docs.select("doc_id", "text").join(F.broadcast(wanted), F.col("doc_id") == F.col("wanted"))
    texts = rows.groupBy("doc_id").agg(F.min("text").alias("text")).orderBy("doc_id").collect()
    texts = [r for r in texts if len(r["text"]) <= sample_chars]
    return fit([r["text"] for r in texts], [ids[r["doc_id"]] for r in texts])


def score(docs: DataFrame, chain: Chain, threshold: float = 0.7) -> DataFrame:
    """Every row of ``docs`` as a struct ``row`` with ``score``, ``predicted`` and ``spans``.

    ``score`` lies in 0 to 1, ``predicted`` is 1 from ``threshold`` on, ``spans`` are the
    toxic runs as character offsets. A null or wordless text is scored as one without toxic
    words. Repeated rows are scored alike; an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(chain)
    rows = docs.withColumn("text", F.col("text").cast("string"))
    rows = rows.select(packed(rows).alias("row"))  # the text goes along once, within its row
    out_type = f"row {rows.schema['row'].dataType.simpleString()}, score double, predicted int, spans array<struct<start:int,end:int>>"

    def run(batches):
        memo = _Unaries(model.value)
        parts = (b.slice(i, _ROWS_AT_ONCE) for b in batches for i in range(0, b.num_rows, _ROWS_AT_ONCE))
        for batch in parts:
            texts = [t or "" for t in batch.column("row").field("text").to_pylist()]
            found, spans = tag(model.value, memo, texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array(found),
                    pa.array((found >= threshold).astype(np.int32)),
                    pa.array(
                        [[{"start": s, "end": e} for s, e in x] for x in spans],
                        pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
                    ),
                ],
                ["row", "score", "predicted", "spans"],
            )

    return rows.mapInArrow(run, out_type)
