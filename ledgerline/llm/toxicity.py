"""Toxicity: a linear-chain conditional random field over the words of a text.

Training
    Labels say only that a whole document is toxic.  A word is labelled toxic
    when it stands in a toxic document and one of its features (the word, its
    beginnings, its end) is found in toxic documents far more often than chance
    allows.  On these labelled words a chain with two tags, toxic and not, is
    fitted by gradient ascent on its conditional likelihood: feature weights,
    a bias and four transition weights, gradients by forward-backward.  Last, a
    logistic curve is fitted from what the chain says of a document (expected
    toxic words above those of a text without any sign, their share, and the
    largest marginal) to the document's label.

    The sample is bounded: ``SAMPLE_DOCS`` documents of each label, chosen by a
    hash of their id over all labelled rows of the training part.

Scoring
    Forward-backward marginals of every word of every whole text, added up to
    the document's score; runs of words with a marginal of one half or more are
    the offending spans.  A text without any learned feature has the chain's
    resting marginals and so the curve's smallest value.

Defined results
* null, empty or blank text: the score of a text without signs, no spans;
* without a labelled row of either kind every score is 0;
* labels without a document, null labels and null ids are left out of training;
  a document with several labels is toxic if one of them says so;
* rows are scored one by one: repeated rows and null ids give one result each
  (``held_out`` is false for a null id); other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bodies, crc_mod, lean, unwrapped, whole_rows, words_of

THRESHOLD = 0.7
#: Documents of each label that training reads, at most.
SAMPLE_DOCS = 1500
#: Segments of their words that the chain is fitted on, at most; both labels keep their shares.
SAMPLE_SEGMENTS = 20_000
#: Features that the chain has weights for, at most: the strongest signs first.
MAX_FEATURES = 5000
#: A feature is a sign when chance would give its counts with a probability below exp(-SIGN).
SIGN = 9.0
#: A sign in this part of all toxic documents needs no document of its own.
COMMON = 0.025
TRAIN_STEPS = 120
SEGMENT = 48
SPAN_MARGINAL = 0.5
#: Cells (documents x words) of a forward-backward table.
TABLE_CELLS = 1 << 18
CACHE_WORDS = 200_000
TOKEN = re.compile(rb"[^\x20\x09-\x0D]+")
EDGE = b".,;:!?()[]{}<>\"'*#$%&|-_/\\~`^+="


def features(word: bytes) -> list[bytes]:
    """The lower-cased word without edge punctuation, its beginnings and its end."""
    w = word.strip(EDGE)
    if not w:
        return []
    return [b"w:" + w, *[b"p%d:" % n + w[:n] for n in (4, 5, 6) if len(w) > n], *([b"s:" + w[-4:]] if len(w) > 4 else [])]


@dataclass
class Model:
    weights: dict[bytes, float] = field(default_factory=dict)
    bias: float = -4.0
    transitions: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    curve: np.ndarray | None = None      # None: nothing was learned, every score is 0

    def emission(self, word: bytes) -> float:
        return sum(self.weights.get(f, 0.0) for f in features(word))


class Emissions(dict):
    """word -> weight of the toxic tag, remembered."""

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.model = model

    def __missing__(self, word: bytes) -> float:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = self.model.emission(word)
        return value


def marginals(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """P(toxic) of each word; rows are sequences, ``scores`` the toxic tag's weight against the other's.

    Forward and backward messages are ratios of the two tags' weights, so they
    need one number a word and cannot overflow.
    """
    n, length = scores.shape
    t = np.exp(transitions - transitions.max())
    e = np.exp(np.clip(scores, -40, 40))
    forward = np.empty((n, length))
    backward = np.ones((n, length))
    forward[:, 0] = e[:, 0]
    for i in range(1, length):
        a = forward[:, i - 1]
        forward[:, i] = e[:, i] * np.clip((t[0, 1] + t[1, 1] * a) / (t[0, 0] + t[1, 0] * a), 1e-30, 1e30)
    for i in range(length - 2, -1, -1):
        b = e[:, i + 1] * backward[:, i + 1]
        ratio = (t[1, 0] + t[1, 1] * b) / (t[0, 0] + t[0, 1] * b)
        backward[:, i] = np.where(i + 1 < lengths, np.clip(ratio, 1e-30, 1e30), 1.0)
    odds = forward * backward
    p = odds / (1 + odds)
    p[np.arange(length)[None, :] >= lengths[:, None]] = 0.0
    return p


def pair_marginals(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray
                   ) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of words, and the sum over neighbours of each pair of tags (for the gradient)."""
    p = marginals(scores, lengths, transitions)
    t = np.exp(transitions - transitions.max())
    e = np.exp(np.clip(scores, -40, 40))
    pairs = np.zeros((2, 2))
    n, length = scores.shape
    # P(y_i, y_i+1) from the marginal of y_i and the chance of y_i+1 after it
    backward = np.ones(n)
    for i in range(length - 2, -1, -1):
        inside = i + 1 < lengths
        b = e[:, i + 1] * backward
        to1_from0 = t[0, 1] * b / (t[0, 0] + t[0, 1] * b)
        to1_from1 = t[1, 1] * b / (t[1, 0] + t[1, 1] * b)
        p1, p0 = p[inside, i], 1 - p[inside, i]
        pairs[1, 1] += (p1 * to1_from1[inside]).sum()
        pairs[1, 0] += (p1 * (1 - to1_from1[inside])).sum()
        pairs[0, 1] += (p0 * to1_from0[inside]).sum()
        pairs[0, 0] += (p0 * (1 - to1_from0[inside])).sum()
        ratio = np.clip((t[1, 0] + t[1, 1] * b) / (t[0, 0] + t[0, 1] * b), 1e-30, 1e30)
        backward = np.where(inside, ratio, 1.0)
    return p, pairs


def _gain(n1: int, n0: int, share: float) -> float:
    """How much likelier the counts are at their own share of toxic documents than at the share of all."""
    p = n1 / max(1, n1 + n0)
    if p <= share:
        return 0.0
    return n1 * float(np.log(p / share)) + (n0 * float(np.log((1 - p) / (1 - share))) if n0 else 0.0)


def find_signs(toxic: list[list[bytes]], clean: list[list[bytes]]) -> dict[bytes, float]:
    """Features of toxic documents that chance does not explain, with the strength of the evidence.

    The strongest come first.  A weaker one counts only by documents that no
    sign has explained yet, or if it is common among toxic documents: words that
    merely go along with a sign, as those of its language do, stay out.
    """
    seen: list[dict[bytes, list[int]]] = [{}, {}]
    for k, docs in enumerate((clean, toxic)):
        for i, words in enumerate(docs):
            for f in {f for w in set(words) for f in features(w)}:
                seen[k].setdefault(f, []).append(i)
    share = len(toxic) / max(1, len(toxic) + len(clean))
    candidates = []
    for f, docs in seen[1].items():
        n0 = len(seen[0].get(f, ()))
        gain = _gain(len(docs), n0, share)
        if gain >= SIGN and len(docs) >= 0.8 * (len(docs) + n0):
            candidates.append((-gain, f, n0))
    explained = np.zeros(len(toxic), bool)
    signs: dict[bytes, float] = {}
    for gain, f, n0 in sorted(candidates):
        docs = np.array(seen[1][f])
        common = len(docs) >= COMMON * len(toxic) and len(docs) >= 0.95 * (len(docs) + n0)
        if common or _gain(int((~explained[docs]).sum()), n0, share) >= SIGN:
            signs[f] = -gain
            explained[docs] = True
            if len(signs) >= MAX_FEATURES:
                break
    return signs


def spread(n: int, most: int) -> list[int]:
    """At most ``most`` of the numbers below ``n``, from all of them alike and the same each time."""
    if n <= most:
        return list(range(n))
    return np.sort(np.random.default_rng(n).permutation(n)[:most]).tolist()


def fit(toxic: list[list[bytes]], clean: list[list[bytes]]) -> Model:
    """A model from the words of toxic and of clean documents."""
    if not toxic or not clean:
        return Model()
    signs = find_signs(toxic, clean)
    index = {f: i for i, f in enumerate(signs)}

    # segments of labelled words: all with a sign, and some without
    segments: list[tuple[list[list[int]], list[int]]] = []
    for k, docs in ((1, toxic), (0, clean)):
        for words in docs:
            known = [[index[f] for f in features(w) if f in index] for w in words]
            for s in range(0, len(words), SEGMENT):
                part = known[s:s + SEGMENT]
                if any(part) or s == 0:
                    segments.append((part, [int(k == 1 and bool(x)) for x in part]))
    segments = [segments[i] for i in spread(len(segments), SAMPLE_SEGMENTS)]
    n = len(segments)
    lengths = np.array([len(x) for x, _ in segments])
    tags = np.zeros((n, SEGMENT), np.int64)
    at_row, at_col, at_feature = [], [], []
    for r, (part, y) in enumerate(segments):
        tags[r, :len(y)] = y
        for c, fs in enumerate(part):
            at_row += [r] * len(fs)
            at_col += [c] * len(fs)
            at_feature += fs
    at_row, at_col, at_feature = (np.array(x, np.int64) for x in (at_row, at_col, at_feature))
    inside = np.arange(SEGMENT)[None, :] < lengths[:, None]
    both = inside[:, 1:]
    seen_pairs = np.array([[((tags[:, :-1] == a) & (tags[:, 1:] == b) & both).sum() for b in (0, 1)] for a in (0, 1)])
    total = inside.sum()

    # Adam on the mean log-likelihood
    size = len(index)
    theta = np.zeros(size + 5)
    theta[size] = -2.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    scale = 1.0 / max(1, total)
    for step in range(1, TRAIN_STEPS + 1):
        scores = np.full((n, SEGMENT), theta[size])
        np.add.at(scores, (at_row, at_col), theta[at_feature])
        transitions = theta[size + 1:].reshape(2, 2)
        p, pairs = pair_marginals(scores, lengths, transitions)
        error = np.where(inside, tags - p, 0.0)
        gradient = np.zeros_like(theta)
        gradient[:size] = np.bincount(at_feature, weights=error[at_row, at_col], minlength=size)[:size]
        gradient[size] = error.sum()
        gradient[size + 1:] = (seen_pairs - pairs).ravel()
        gradient = gradient * scale - 1e-6 * theta
        m = 0.9 * m + 0.1 * gradient
        v = 0.99 * v + 0.01 * gradient ** 2
        theta += 0.15 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-12)
    model = Model({f: float(theta[i]) for f, i in index.items()}, float(theta[size]),
                  theta[size + 1:].reshape(2, 2).copy())

    emissions = Emissions(model)
    x = np.array([evidence(e) for e in chain(model, [emission_of(w, emissions) for w in [*toxic, *clean]])])
    y = np.r_[np.ones(len(toxic)), np.zeros(len(clean))]
    design = np.c_[np.ones(len(x)), x]
    curve = np.zeros(design.shape[1])
    for _ in range(60):     # Newton steps with a small penalty, so separable data settle too
        p = 1 / (1 + np.exp(-np.clip(design @ curve, -30, 30)))
        penalty = np.r_[1e-3, np.full(x.shape[1], 1e-2)]
        hessian = (design * (p * (1 - p))[:, None]).T @ design + np.diag(penalty)
        change = np.linalg.solve(hessian, design.T @ (y - p) - penalty * curve)
        curve += np.clip(change, -2, 2)
        if np.abs(change).max() < 1e-6:
            break
    model.curve = curve
    return model


def emission_of(words: list[bytes], emissions: Emissions) -> np.ndarray:
    return np.fromiter(map(emissions.__getitem__, words), np.float64, len(words))


def chain(model: Model, docs: list[np.ndarray]) -> list[np.ndarray | None]:
    """Marginals of each document's words; None where no word has a learned feature."""
    out: list[np.ndarray | None] = [None] * len(docs)
    todo = sorted((i for i, e in enumerate(docs) if e.any()), key=lambda i: len(docs[i]))
    while todo:
        longest = len(docs[todo[-1]])
        take = max(1, TABLE_CELLS // longest)
        some, todo = todo[-take:], todo[:-take]
        lengths = np.array([len(docs[i]) for i in some])
        scores = np.zeros((len(some), longest))
        for r, i in enumerate(some):
            scores[r, :lengths[r]] = docs[i]
        p = marginals(scores + model.bias, lengths, model.transitions)
        for r, i in enumerate(some):
            out[i] = p[r, :lengths[r]]
    return out


def evidence(p: np.ndarray | None) -> tuple[float, float, float]:
    """What a document's marginals say: expected toxic words, their share, the largest marginal."""
    if p is None or not len(p):
        return 0.0, 0.0, 0.0
    # the middle word of most texts bears no sign: what lies above it is evidence
    over = np.maximum(p - np.median(p), 0.0) if np.median(p) < SPAN_MARGINAL else p
    return float(np.log1p(over.sum())), float(min(1.0, 10 * over.mean())), float(over.max())


def score_of(model: Model, p: np.ndarray | None) -> float:
    if model.curve is None:
        return 0.0
    z = float(np.r_[1.0, evidence(p)] @ model.curve)
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def spans_of(body: bytes, p: np.ndarray | None) -> list[dict]:
    """Runs of words with a marginal of one half or more: character offsets and the run's mean marginal."""
    if p is None or not (p >= SPAN_MARGINAL).any():
        return []
    toxic = np.flatnonzero(np.diff(np.r_[0, (p >= SPAN_MARGINAL).astype(np.int8), 0]))
    places = [m.span() for m in TOKEN.finditer(body)]
    chars = lambda at: len(body[:at].decode("utf-8", "replace"))
    return [{"start": chars(places[a][0]), "end": chars(places[b - 1][1]), "marginal": float(p[a:b].mean())}
            for a, b in zip(toxic[::2].tolist(), toxic[1::2].tolist(), strict=True)]


def sample(docs: DataFrame, labels: DataFrame, held_out: Column, per_label: int) -> dict[int, list[list[bytes]]]:
    """Words of at most ``per_label`` training documents of each label."""
    labelled = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
                .where(~held_out).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    known = labelled.join(docs.select("doc_id").where("doc_id is not null").distinct(), "doc_id", "left_semi")
    out: dict[int, list[list[bytes]]] = {0: [], 1: []}
    ids: list[tuple[int, int]] = []
    for label in (0, 1):
        ids += [(r["doc_id"], label) for r in known.where(F.col("toxic") == label).select("doc_id")
                .orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label).collect()]
    if not ids:
        return out
    chosen = docs.sparkSession.createDataFrame(ids, "doc_id long, toxic int")
    texts = bodies(docs).join(F.broadcast(chosen), "doc_id").where("body is not null")
    for r in texts.groupBy("doc_id", "toxic").agg(F.min("body").alias("body")).collect():
        out[r["toxic"]].append(words_of(bytes(r["body"])))
    for label in out:
        out[label].sort()       # the same sample gives the same model
    return out


def train(docs: DataFrame, labels: DataFrame, held_out: Column, per_label: int = SAMPLE_DOCS) -> Model:
    """A model from the labelled documents that are not held out (``held_out`` over doc_id)."""
    words = sample(docs, labels, held_out, per_label)
    return fit(words[1], words[0])


def analyse(model: Model, emissions: Emissions, texts: list[bytes | None]) -> list[tuple[float, np.ndarray | None]]:
    """(score, marginals) of each text."""
    p = chain(model, [emission_of(words_of(t), emissions) for t in texts])
    return [(score_of(model, x), x) for x in p]


def held_out_rows(id_col: str = "doc_id") -> Column:
    return F.coalesce(crc_mod(F.col(id_col), 3) == 1, F.lit(False))


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted, spans."""
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("marginal", pa.float64())])

    @lean
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emissions = Emissions(model)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                texts = part.column(1).to_pylist()
                found = analyse(model, emissions, texts)
                scores = [s for s, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(scores, pa.float64()),
                     pa.array([int(s >= THRESHOLD) for s in scores], pa.int32()),
                     pa.array([spans_of(t or b"", p) for t, (_, p) in zip(texts, found, strict=True)], pa.list_(span))],
                    ["doc_id", "score", "predicted", "spans"])

    scored = bodies(docs, id_col, text_col).mapInArrow(
        rows, "doc_id long, score double, predicted int, spans array<struct<start long, end long, marginal double>>")
    return scored.select("doc_id", held_out_rows().alias("held_out"), "score", "predicted", "spans")


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that are not predicted toxic."""
    rows = whole_rows(docs, id_col, text_col)

    @lean
    def clean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emissions = Emissions(model)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                found = analyse(model, emissions, part.column("body").to_pylist())
                yield part.select(["body", "row"]).filter(pa.array([s < THRESHOLD for s, _ in found], pa.bool_()))

    kept = rows.mapInArrow(clean, rows.select("body", "row").schema)
    return unwrapped(kept.withColumn("text", F.col("body").cast("string")), docs.columns, text_col, "text")
