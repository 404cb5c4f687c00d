"""Toxicity by a linear-chain conditional random field over words.

The field has two tags, clean and toxic, and its sequences are the lines of a
text. A word's evidence is the sum of weights of its features (itself,
beginnings and an ending); a 2 x 2 matrix ties neighbouring tags.
Forward-backward gives each word's marginal chance of being toxic; marginals
make the document's score and the offending places.

Labels are known for documents only. The words of toxic documents are labelled
from them: a word is toxic there if one of its features is many times more
frequent in toxic than in clean documents. The field then learns from those
labelled words what to make of words it has not seen.
"""

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from carrel.llm.common import whole_text

TOKEN = re.compile(r"[^\W_]+|\n")
MOST = 30.0  # evidence is held within this range


def features(word):
    """Features of a word in lower case: itself, beginnings of 3 to 6 bytes, the last 3; none where it is shorter."""
    data = word.lower().encode("utf-8", "replace")
    return [b"w" + data, *[b"%d" % n + data[:n] for n in range(3, min(6, len(data)) + 1)], b"e" + data[-3:]]


@dataclass(frozen=True)
class Model:
    """Weights by feature, ``bias`` of every word, log ties ``ties[from][to]``, and the document's logistic weights."""

    weights: dict
    bias: float
    ties: np.ndarray
    document: np.ndarray


class _Lines:
    """Sequences laid out for vector steps: the longest first."""

    def __init__(self, lengths):
        lengths = np.asarray(lengths, np.int64)
        starts = np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")
        self.starts, lengths = starts[order], lengths[order]
        self.steps = int(lengths[0]) if len(lengths) else 0
        self.active = np.searchsorted(-lengths, -np.arange(1, self.steps + 1), side="right")


def marginals(evidence, lines, ties, pairs=False):
    """Chance of the toxic tag at each word and, with ``pairs``, the sums of neighbouring tags.

    Works on odds: one number per word instead of two, so nothing under- or
    overflows however long a line is.
    """
    odds = np.exp(np.clip(evidence, -MOST, MOST))
    (oo, ot), (to, tt) = np.exp(ties)
    ahead, behind = np.empty_like(odds), np.ones_like(odds)
    for t in range(lines.steps):
        at = lines.starts[: lines.active[t]] + t
        if t == 0:
            ahead[at] = odds[at]
        else:
            f = ahead[at - 1]
            ahead[at] = odds[at] * (ot + tt * f) / (oo + to * f)
    for t in range(lines.steps - 2, -1, -1):
        at = lines.starts[: lines.active[t + 1]] + t
        x = odds[at + 1] * behind[at + 1]
        behind[at] = (to + tt * x) / (oo + ot * x)
    both = ahead * behind
    chance = both / (1 + both)
    if not pairs:
        return chance
    last = np.ones(len(odds), bool)
    for t in range(lines.steps - 1):
        last[lines.starts[: lines.active[t + 1]] + t] = False
    at = np.flatnonzero(~last)
    f, x = ahead[at], odds[at + 1] * behind[at + 1]
    mass = np.stack([np.full(len(at), oo), ot * x, to * f, tt * f * x])
    return chance, (mass / mass.sum(0)).sum(1).reshape(2, 2), at


def _split(text):
    """Words of a text and the lengths of its lines, empty lines left out."""
    words, lengths, n = [], [], 0
    for token in TOKEN.findall(text):
        if token != "\n":
            words.append(token)
            n += 1
        elif n:
            lengths.append(n)
            n = 0
    if n:
        lengths.append(n)
    return words, lengths


def _adam(value, grad, state, rate):
    m, v, n = state
    n += 1
    m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
    step = rate * (m / (1 - 0.9**n)) / (np.sqrt(v / (1 - 0.999**n)) + 1e-8)
    return value - step, (m, v, n)


def train(texts, toxic, rounds=50, rate=0.15, decay=2e-3, least=10.0, times=12.0):
    """A model of labelled texts; equal input in equal order gives an equal model, repeated texts count once.

    ``least`` and ``times``: a feature marks toxic words if the labels of the
    texts that have it gain so much log likelihood from it (10: about one in
    20,000 by chance), and it is so many times as frequent in toxic texts.
    """
    known = {}
    for text, label in zip(texts, toxic):
        known[text or ""] = known.get(text or "", False) or bool(label)
    texts, toxic = list(known), np.array(list(known.values()), bool)
    number, rows, lengths, owner = {}, [], [], []
    for place, text in enumerate(texts):
        words, own = _split(text or "")
        rows.append(np.array([number.setdefault(w.lower(), len(number)) for w in words], np.int32))
        lengths += own
        owner += [place] * len(own)
    ties = np.log(np.array([[0.9, 0.1], [0.5, 0.5]]))
    if not len(number) or toxic.all() or not toxic.any():
        return Model({}, -MOST, ties, np.array([-3.0, 0.0, 0.0]))
    slots = {b"": 0}
    table = np.zeros((len(number), 6), np.int32)
    for word, row in zip(number, table):
        own = features(word)
        row[: len(own)] = [slots.setdefault(f, len(slots)) for f in own]

    seen = np.zeros((2, len(slots)))
    for kind, words in zip(toxic, rows):
        seen[int(kind)][np.unique(table[words])] += 1
    # Copies with small edits repeat a word next to the same word: those count once.
    none = len(table)
    pairs = [np.zeros(0, np.int64)]
    for kind, words in zip(toxic, rows):
        if kind and len(words):
            pairs.append(words.astype(np.int64) * (none + 1) + np.concatenate([[none], words[:-1]]))
    places = np.bincount(np.unique(np.concatenate(pairs)) // (none + 1), minlength=none)
    seen[1] = np.minimum(seen[1], np.bincount(table.ravel(), np.repeat(places, 6), len(slots)))
    rates = (seen + np.array([[0.5], [0.0]])) / np.array([[(~toxic).sum() + 1.0], [toxic.sum()]])
    part = toxic.mean()
    own = np.clip(seen[1] / np.maximum(seen.sum(0), 1), 1e-9, 1 - 1e-9)
    gain = seen[1] * np.log(own / part) + seen[0] * np.log((1 - own) / (1 - part))
    marks = (gain >= least) & (rates[1] > times * rates[0])
    marks[0] = False
    marked = marks[table].any(1)

    # Learn from lines with marked words and as many others, spread over all.
    owner, lengths = np.array(owner), np.array(lengths)
    tokens = np.concatenate(rows)
    labels = marked[tokens] & np.repeat(toxic[owner], lengths)
    ends = np.cumsum(lengths)
    hit = np.add.reduceat(labels, ends - lengths) > 0
    others = np.flatnonzero(~hit)
    chosen = np.zeros(len(lengths), bool)
    chosen[hit] = True
    chosen[others[:: max(1, len(others) // max(2_000, 2 * int(hit.sum())))]] = True
    keep = np.repeat(chosen, lengths)
    words, labels, lines = tokens[keep], labels[keep], _Lines(lengths[chosen])

    target = np.zeros((2, 2))
    weights = np.zeros(len(slots))
    bias, states = np.array([-4.0]), [(0.0, 0.0, 0)] * 3
    for _ in range(rounds):
        chance, pair, at = marginals((weights[table].sum(1) + bias)[words], lines, ties, pairs=True)
        if not target.any():
            np.add.at(target, (labels[at].astype(int), labels[at + 1].astype(int)), 1)
        off = chance - labels
        by_word = np.bincount(words, off, len(table))
        grad = np.bincount(table.ravel(), np.repeat(by_word, 6), len(slots)) + decay * len(words) ** 0.5 * weights
        grad[0] = 0.0
        weights, states[0] = _adam(weights, grad, states[0], rate)
        ties, states[1] = _adam(ties, pair - target, states[1], rate / 5)
        bias, states[2] = _adam(bias, np.array([off.sum()]), states[2], rate / 5)
    known = {f: float(weights[i]) for f, i in slots.items() if i and abs(weights[i]) > 0.02}
    model = Model(known, float(bias[0]), ties, np.zeros(3))

    facts = np.array([_facts(m) for m in _chances(model, texts)])
    inputs = np.column_stack([np.ones(len(facts)), facts])
    share = np.where(toxic, 0.5 / toxic.sum(), 0.5 / (~toxic).sum()) * len(toxic)
    document = np.zeros(3)
    for _ in range(50):  # Newton steps with some decay
        p = 1 / (1 + np.exp(-np.clip(inputs @ document, -MOST, MOST)))
        slope = inputs.T @ (share * (p - toxic)) + 0.5 * document
        bend = (inputs * (share * p * (1 - p))[:, None]).T @ inputs + 0.5 * np.eye(3)
        document = document - np.linalg.solve(bend, slope)
    return Model(known, model.bias, ties, document)


class _Evidence(dict):
    """Evidence of a word as written, worked out once; emptied when it grows large."""

    def __init__(self, model, most=250_000):
        super().__init__()
        self.weights, self.bias, self.most = model.weights, model.bias, most

    def __missing__(self, word):
        if len(self) >= self.most:
            self.clear()
        weights, value = self.weights, self.bias
        for feature in features(word):
            value += weights.get(feature, 0.0)
        self[word] = value
        return value


def _chances(model, texts, evidence=None):
    """Marginals of the words of each text."""
    evidence = _Evidence(model) if evidence is None else evidence
    values, counts, lengths = [], [], []
    for text in texts:
        words, own = _split(text or "")
        values.append(np.fromiter(map(evidence.__getitem__, words), np.float64, len(words)))
        counts.append(len(words))
        lengths += own
    flat = np.concatenate(values) if values else np.empty(0)
    chance = marginals(flat, _Lines(lengths), model.ties)
    return np.split(chance, np.cumsum(counts)[:-1]) if counts else []


def _facts(chance):
    """What the document's score is made of: the strongest word, and the mass of likely ones."""
    if not len(chance):
        return [-6.0, 0.0]
    top = float(np.clip(chance.max(), 1e-6, 1 - 1e-6))
    return [max(-6.0, np.log(top / (1 - top))), np.log1p(chance[chance > 0.1].sum())]


def _fitted(most_bytes):
    def run(batches):
        texts, toxic, size = [], [], 0
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("_label").to_pylist()):
                size += len(text.encode())
                if size <= most_bytes:
                    texts.append(text)
                    toxic.append(label == 1)
        model = train(texts, toxic)
        yield pa.record_batch({"model": pa.array([pickle.dumps(model)], pa.binary())})

    return run


def fit(
    docs, labels, sample=1200, clean_sample=2400, most_bytes=24_000_000, where=None, seed=3,
    id_col="doc_id", text="text", label="toxic",
):
    """A model from at most ``sample`` toxic and ``clean_sample`` clean labelled documents, in a seeded order of ids.

    Of these, whole texts are taken in that order as long as they have at most
    ``most_bytes`` together. The bounds hold for the fit alone, which is one
    task; what reaches the driver is the model. The ids only choose rows and are
    no input. ``where`` limits the labelled rows that may be used. A repeated
    label counts as toxic if one of its rows is; null labels are not used.
    Without labelled documents of both kinds every score is low.
    """
    known = labels.where(F.col(label).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(label).alias("_label"))
    if where is not None:
        known = known.where(where(F.col("_id")))
    order = F.xxhash64(F.col("_id").cast("string"), F.lit(seed))
    bounds = {0: clean_sample, 1: sample}
    kinds = [known.where(F.col("_label") == k).orderBy(order, "_id").limit(n) for k, n in bounds.items()]
    chosen = kinds[0].unionByName(kinds[1])
    rows = (
        docs.select(F.col(id_col).alias("doc_id"), whole_text(text).alias("text"))
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
        .select("text", "_label", order.alias("_order"))
        .orderBy("_order", "text")
        .limit(sample + clean_sample)
    )
    found = rows.mapInArrow(_fitted(most_bytes), "model binary").first()
    return pickle.loads(found.model) if found else train([], [])


_SCORE = pa.struct([("score", pa.float64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])


def score(docs, model, limit=0.7, likely=0.5, text="text"):
    """Adds ``score`` (0 to 1), ``predicted`` (score at least ``limit``) and ``toxic_spans``.

    Spans (code points, end exclusive) are the words whose marginal is at least
    ``likely``, neighbours joined. Whole texts are read; null and empty texts
    have the score of a text without toxic words; repeated rows are scored
    each. No row moves to another task; columns of these names are replaced.
    """

    @F.arrow_udf("struct<score:double,spans:array<struct<start:int,end:int>>>")
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        evidence = _Evidence(model)
        for batch in batches:
            rows = []
            for low in range(0, len(batch), 2048):
                texts = batch.slice(low, 2048).to_pylist()
                for body, chance in zip(texts, _chances(model, texts, evidence)):
                    value = 1 / (1 + np.exp(-float(np.clip(model.document @ [1.0, *_facts(chance)], -MOST, MOST))))
                    rows.append({"score": value, "spans": _places(body, chance >= likely)})
            yield pa.array(rows, type=_SCORE)

    scored = docs.withColumn("_scored", apply(whole_text(text)))
    return (
        scored.withColumn("score", F.col("_scored.score"))
        .withColumn("predicted", (F.col("_scored.score") >= limit).cast("int"))
        .withColumn("toxic_spans", F.col("_scored.spans"))
        .drop("_scored")
    )


def _places(text, marked):
    if not marked.any():
        return []
    spans, words = [], (m for m in TOKEN.finditer(text) if m[0] != "\n")
    before = False
    for match, hit in zip(words, marked):
        if hit and before:
            spans[-1]["end"] = match.end()
        elif hit:
            spans.append({"start": match.start(), "end": match.end()})
        before = hit
    return spans


def held_out(id_column):
    """The rows whose labels are never learned from."""
    return F.crc32(F.encode(id_column.cast("string"), "UTF-8")) % 3 == 1
