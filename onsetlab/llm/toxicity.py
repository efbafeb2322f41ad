"""Toxic spans and document scores from a linear-chain conditional random field.

Documents are labelled, tokens are not, so tokens are labelled first: in a toxic
document a token is toxic if its word or one of its prefixes is far commoner in
toxic documents than in others. On these tokens a chain of two states (clean,
toxic) is trained, with hashed word, prefix and suffix features. The
forward-backward marginals of a text give its spans, and a logistic curve over
them its score.

Two states need no tables: the recursions run on ratios toxic / clean, over
many texts at once, one step per token position.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onsetlab.llm.quality import bounded_sample, one_label

WORD = re.compile(r"\w+")
FEATURE_BITS = 18
FIT_ROWS = 8192
SEQUENCE = 256
#: Tokens whose marginals are held at once while the chain is trained.
TOKENS_AT_ONCE = 1 << 20
CACHE_WORDS = 400_000
TEXTS_AT_ONCE = 2048


def features(word: str) -> list[int]:
    """Hashed features of a lower-cased word."""
    names = [word, *("^" + word[:n] for n in range(3, 7) if len(word) > n), *("$" + word[-n:] for n in (3, 4) if len(word) > n)]
    return [crc32(name.encode("utf-8", "surrogatepass")) & ((1 << FEATURE_BITS) - 1) for name in names]


def tokens(text: str) -> list[str]:
    """Lower-cased words, as many as WORD finds in the text."""
    lower = text.lower()
    if len(lower) == len(text):
        return WORD.findall(lower)
    return [word.lower() for word in WORD.findall(text)]


class Lanes:
    """Sequences side by side: step t holds the t-th token of each that has one."""

    def __init__(self, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        steps = int(self.lengths[0]) if len(lengths) else 0
        self.active = np.searchsorted(-self.lengths, -np.arange(1, steps + 1), "right")
        self.steps = np.concatenate([[0], np.cumsum(self.active)])
        # Where the tokens of the sequences, written one after another, go.
        firsts = np.concatenate([[0], np.cumsum(lengths)])[:-1][self.order]
        lane = np.arange(len(lengths))
        self.source = np.concatenate(
            [np.zeros(0, np.int64), *(firsts[:n] + t for t, n in enumerate(self.active.tolist()))]
        )
        self.lane = np.concatenate([np.zeros(0, np.int64), *(lane[:n] for n in self.active.tolist())])


def forward_backward(lanes: Lanes, odds: np.ndarray, start: float, moves: np.ndarray) -> tuple[np.ndarray, ...]:
    """Forward and backward ratios by token (in step order) and log P(all clean) by lane.

    ``odds`` are toxic / clean emissions in step order, ``moves[i, j]`` the
    weight of going from state i to state j.
    """
    (m00, m01), (m10, m11) = moves
    f, b = np.empty_like(odds), np.ones_like(odds)
    clean = np.zeros(len(lanes.order))
    at, n = lanes.steps.tolist(), lanes.active.tolist()
    for t in range(len(n)):
        here = slice(at[t], at[t + 1])
        if t == 0:
            f[here] = odds[here] * start
            continue
        before = f[at[t - 1] : at[t - 1] + n[t]]
        base = m00 + m10 * before
        f[here] = odds[here] * (m01 + m11 * before) / base
        clean[: n[t]] += np.log(m00 / base)
    for t in range(len(n) - 2, -1, -1):
        x = odds[at[t + 1] : at[t + 2]] * b[at[t + 1] : at[t + 2]]
        b[at[t] : at[t] + n[t + 1]] = (m10 + m11 * x) / (m00 + m01 * x)
    lasts = np.array([at[k - 1] for k in lanes.lengths.tolist() if k], np.int64)
    has = lanes.lengths > 0
    clean[has] -= np.log1p(f[lasts + np.arange(len(lanes.order))[has]])
    return f, b, clean


@dataclass
class ToxicityModel:
    """Feature weights of the toxic state, chain weights (logs) and the curve."""

    weight: np.ndarray
    start: float
    moves: np.ndarray
    curve: np.ndarray

    def emission(self, word: str) -> float:
        return float(np.clip(self.weight[features(word)].sum() + self.weight[-1], -30, 30))

    def marginals(self, emissions: np.ndarray, lengths: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Per text the probability of each token to be toxic; log P(all clean).

        ``emissions`` are those of the tokens of all texts, one after another.
        """
        lanes = Lanes(lengths)
        odds = np.exp(emissions[lanes.source])
        f, b, clean = forward_backward(lanes, odds, np.exp(self.start), np.exp(self.moves))
        p = np.empty(len(emissions))
        p[lanes.source] = f * b / (1 + f * b)
        back = np.empty(len(lengths))
        back[lanes.order] = clean
        return np.split(p, np.cumsum(lengths)[:-1]) if len(lengths) else [], back

    def score(self, marginals: np.ndarray, clean: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.curve @ summary(marginals, clean), -60, 60))))


class Emissions(dict):
    """Emissions of words met so far."""

    def __init__(self, model: ToxicityModel):
        self.model = model

    def __missing__(self, word: str) -> float:
        value = self[word] = self.model.emission(word)
        return value


def summary(marginals: np.ndarray, clean: float) -> np.ndarray:
    """What the score of a text rests on: is any token toxic, how many, how densely; a constant."""
    any_toxic = -np.expm1(min(clean, 0.0)) if len(marginals) else 0.0
    count = marginals.sum()
    return np.array([
        np.log((any_toxic + 1e-4) / (1 - any_toxic + 1e-4)),
        np.log(count + 0.05),
        np.log((count + 0.05) / (len(marginals) + 5)),
        1.0,
    ])


class Vocabulary:
    """Numbers of words, and the hashed features of each."""

    def __init__(self) -> None:
        self.numbers: dict[str, int] = {}
        self.flat, self.ends = array("i"), array("q", [0])

    def read(self, text: str) -> np.ndarray:
        """The numbers of the words of a text."""
        out = array("i")
        for word in tokens(text):
            number = self.numbers.get(word)
            if number is None:
                number = self.numbers[word] = len(self.numbers)
                self.flat.extend(features(word))
                self.ends.append(len(self.flat))
            out.append(number)
        return np.frombuffer(out, np.int32) if out else np.zeros(0, np.int32)

    def close(self) -> None:
        self.feature = np.array(self.flat, np.int64)
        self.sizes = np.diff(np.array(self.ends, np.int64))
        self.word = np.repeat(np.arange(len(self.numbers)), self.sizes)

    def features_of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The features of some words, and the place of the word of each."""
        sizes = self.sizes[words]
        ends = np.cumsum(sizes)
        first = np.cumsum(self.sizes)[words] - sizes
        at = np.repeat(first - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self.feature[at], np.repeat(np.arange(len(words)), sizes)


def toxic_features(
    vocabulary: Vocabulary,
    texts: list[np.ndarray],
    toxic: np.ndarray,
    least: int = 3,
    odds: float = 3.0,
    most: int = 10,
) -> np.ndarray:
    """A mask of the features that mark toxic tokens.

    They occur in at least ``least`` toxic documents, whatever the number of
    these, e**(odds / 2) times as often as in others counted by document, and
    e**odds times as often counted by token. A document speaks for a feature at
    most ``most`` times, or one that says a word very often would outvote others.
    """
    docs, occurrences = np.zeros((2, 1 << FEATURE_BITS)), np.zeros((2, 1 << FEATURE_BITS))
    for words, label in zip(texts, toxic.tolist(), strict=True):
        known, counts = np.unique(words, return_counts=True)
        found, place = vocabulary.features_of(known)
        met, which = np.unique(found, return_inverse=True)
        docs[label][met] += 1
        occurrences[label][met] += np.minimum(np.bincount(which, counts[place], len(met)), most)
    n = np.array([[len(toxic) - toxic.sum()], [toxic.sum()]])

    def ratio(counts: np.ndarray) -> np.ndarray:
        clean, bad = np.log((counts + 0.5) / (n + 1))
        return bad - clean

    return (docs[1] >= least) & (ratio(docs) >= odds / 2) & (ratio(occurrences) >= odds)


class _Group:
    """Sequences that are trained side by side: word numbers and labels in the order of steps."""

    def __init__(self, words: np.ndarray, y: np.ndarray, lengths: np.ndarray):
        lanes = Lanes(lengths)
        self.words, self.y = words[lanes.source].astype(np.int32), y[lanes.source].astype(np.uint8)
        self.opening = int(lanes.active[0]) if len(lanes.active) else 0
        after = np.arange(self.opening, len(self.words))
        self.before = (after - lanes.active[np.searchsorted(lanes.steps, after, "right") - 2]).astype(np.int32)
        lanes.source = lanes.lane = np.zeros(0, np.int64)
        self.lanes = lanes

    def pairs(self) -> np.ndarray:
        return np.bincount(2 * self.y[self.before] + self.y[self.opening :], minlength=4).astype(float)

    def expect(self, odds: np.ndarray, start: float, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Label less marginal of each token, expected moves, and expected toxic first tokens."""
        own = odds[self.words]
        f, b, _ = forward_backward(self.lanes, own, start, moves)
        x, g = own[self.opening :] * b[self.opening :], f[self.before]
        whole = moves[0, 0] + moves[0, 1] * x + moves[1, 0] * g + moves[1, 1] * g * x
        joint = [moves[0, 0] / whole, moves[0, 1] * x / whole, moves[1, 0] * g / whole, moves[1, 1] * g * x / whole]
        f *= b
        f /= 1 + f
        return self.y - f, np.array([j.sum() for j in joint]), float(f[: self.opening].sum())


def _groups(texts: list[np.ndarray], labels: list[np.ndarray]) -> Iterator[_Group]:
    """Texts cut into sequences, and these dealt into groups of about TOKENS_AT_ONCE tokens."""
    words, y, lengths, size = [], [], [], 0
    for text, label in zip(texts, labels, strict=True):
        for at in range(0, len(text), SEQUENCE):
            words.append(text[at : at + SEQUENCE])
            y.append(label[at : at + SEQUENCE])
            lengths.append(len(words[-1]))
            size += lengths[-1]
            if size >= TOKENS_AT_ONCE:
                yield _Group(np.concatenate(words), np.concatenate(y), np.array(lengths, np.int64))
                words, y, lengths, size = [], [], [], 0
    if words:
        yield _Group(np.concatenate(words), np.concatenate(y), np.array(lengths, np.int64))


def train_chain(
    vocabulary: Vocabulary, texts: list[np.ndarray], labels: list[np.ndarray],
    rounds: int = 60, rate: float = 0.25, decay: float = 1e-3,
) -> ToxicityModel:
    """Maximise the penalised likelihood of the labelled tokens with Adam."""
    used, feature = np.unique(vocabulary.feature, return_inverse=True)
    feature = feature.astype(np.int32)
    owner, n_words = vocabulary.word, len(vocabulary.numbers)
    groups = list(_groups(texts, labels))
    total = max(sum(len(g.words) for g in groups), 1)
    # Gold counts of the chain: first states, and moves between neighbours.
    pairs = sum((g.pairs() for g in groups), np.zeros(4)).reshape(2, 2)
    first = sum(int(g.y[: g.opening].sum()) for g in groups)
    theta = np.zeros(len(used) + 5)  # features, constant, start, three moves
    theta[-5] = -2.0
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        moves = np.exp(np.array([[0.0, theta[-3]], [theta[-2], theta[-1]]]))
        emission = np.bincount(owner, theta[:-5][feature], n_words) + theta[-5]
        odds = np.exp(np.clip(emission, -30, 30))
        by_word, expected, opened = np.zeros(n_words), np.zeros(4), 0.0
        # What the groups expect adds up, so only one of them is at hand at a time.
        for group in groups:
            miss, joint, start = group.expect(odds, np.exp(theta[-4]), moves)
            by_word += np.bincount(group.words, miss, n_words)
            expected += joint
            opened += start
        gradient = np.concatenate([
            np.bincount(feature, by_word[owner], len(used)),
            [by_word.sum(), first - opened],
            (pairs.ravel() - expected)[1:],
        ])
        gradient = gradient / np.sqrt(total) - decay * theta
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient * gradient
        theta += rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-4)
    weight = np.zeros((1 << FEATURE_BITS) + 1)
    weight[used], weight[-1] = theta[:-5], theta[-5]
    moves = np.array([[0.0, theta[-3]], [theta[-2], theta[-1]]])
    return ToxicityModel(weight, float(theta[-4]), moves, np.array([1.0, 0.0, 0.0, 0.0]))


def _curve(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Logistic regression with a weak prior, by Newton steps that are halved until they help."""
    c, prior = np.array([0.5, 0.5, 0.5, 0.0]), np.diag([1e-1, 1e-1, 1e-1, 1e-2])

    def loss(c: np.ndarray) -> float:
        z = x @ c
        return float((np.logaddexp(0, z) - y * z).sum() + c @ prior @ c / 2)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -500, 500)))
        gradient = x.T @ (p - y) + prior @ c
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + prior, gradient)
        now, part = loss(c), 1.0
        while part > 1e-6 and loss(c - part * step) > now - 1e-4 * part * (gradient @ step):
            part /= 2
        c = c - part * step
        if np.abs(part * step).max() < 1e-8:
            break
    return c


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    fit_rows: int = FIT_ROWS,
) -> ToxicityModel:
    """Learn from the whole texts of at most ``fit_rows`` labelled documents.

    The bound limits what the driver holds: a number and a label for each token of them.
    Null labels, ids with both labels and labels without a document teach
    nothing. Without toxic or without other documents every text gets the same
    score. One in four of the documents sets the curve and not the chain.
    """
    sample = bounded_sample(one_label(labels, id_col, label_col), fit_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = (
        texts.where("text IS NOT NULL")
        .join(F.broadcast(sample), "id")
        .select("label", "text")
        .toArrow()
        .sort_by([("label", "ascending"), ("text", "ascending")])
    )
    y = np.array(rows.column("label").to_pylist(), np.int64)
    # The same order whatever the tasks were.
    order = np.random.default_rng(1).permutation(len(y))
    y = y[order]
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return ToxicityModel(
            np.zeros((1 << FEATURE_BITS) + 1), 0.0, np.zeros((2, 2)), np.array([0.0, 0.0, 0.0, np.log(share / (1 - share))])
        )
    held = np.arange(len(y)) % 4 == 0
    if len(np.unique(y[~held])) < 2 or len(np.unique(y[held])) < 2:
        held[:] = False
    vocabulary = Vocabulary()
    words = [vocabulary.read(rows.column("text")[int(i)].as_py()) for i in order]
    del rows
    vocabulary.close()
    taught = np.flatnonzero(~held)
    marks = toxic_features(vocabulary, [words[i] for i in taught], y[taught])
    marked = np.bincount(vocabulary.word, marks[vocabulary.feature], len(vocabulary.numbers)) > 0
    gold = [marked[words[i]].astype(np.uint8) * np.uint8(y[i]) for i in taught]
    model = train_chain(vocabulary, [words[i] for i in taught], gold)
    seen = np.flatnonzero(held) if held.any() else taught
    emission = np.bincount(vocabulary.word, model.weight[vocabulary.feature], len(vocabulary.numbers)) + model.weight[-1]
    emission = np.clip(emission, -30, 30)
    summaries = []
    for at in range(0, len(seen), TEXTS_AT_ONCE // 8):
        part = [words[i] for i in seen[at : at + TEXTS_AT_ONCE // 8]]
        p, clean = model.marginals(emission[np.concatenate(part)], np.array([len(w) for w in part], np.int64))
        summaries += [summary(a, c) for a, c in zip(p, clean, strict=True)]
    model.curve = _curve(np.array(summaries), y[seen].astype(float))
    return model


def with_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", name: str = "toxicity", least: float = 0.5) -> DataFrame:
    """All columns of ``docs`` and a struct ``name``: score, spans.

    ``spans`` are maximal runs of tokens with a marginal of ``least`` or more,
    as character offsets (end not included) with their highest marginal. Null
    and empty texts and texts without words have no spans and the score of a
    text without toxic words. A column called ``name`` is replaced.
    """

    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Emissions(model)
        kind = pa.struct([
            ("score", pa.float64()),
            ("spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("marginal", pa.float64())]))),
        ])
        for batch in batches:
            out = []
            for at in range(0, len(batch), TEXTS_AT_ONCE):
                texts = batch.slice(at, TEXTS_AT_ONCE).to_pylist()
                if len(known) > CACHE_WORDS:
                    known.clear()
                words = [tokens(t) for t in texts]
                lengths = np.array([len(w) for w in words], np.int64)
                emissions = np.fromiter((known[w] for t in words for w in t), np.float64, lengths.sum())
                found, clean = model.marginals(emissions, lengths)
                for text, p, c in zip(texts, found, clean, strict=True):
                    spans = toxic_spans(text, p, least) if len(p) and p.max() >= least else []
                    out.append({"score": model.score(p, c), "spans": spans})
            yield pa.array(out, kind)

    udf = F.arrow_udf(judge, "score double, spans array<struct<first:long,last:long,marginal:double>>")
    return docs.withColumn(name, udf(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))


def toxic_spans(text: str, marginals: np.ndarray, least: float) -> list[dict]:
    """Maximal runs of tokens whose marginal is ``least`` or more."""
    spans: list[dict] = []
    last = -2
    for i, (match, p) in enumerate(zip(WORD.finditer(text), marginals.tolist(), strict=False)):
        if p >= least:
            if last == i - 1:
                spans[-1]["last"] = match.end()
                spans[-1]["marginal"] = max(spans[-1]["marginal"], p)
            else:
                spans.append({"first": match.start(), "last": match.end(), "marginal": p})
            last = i
    return spans
