"""Toxicity by a support vector machine on a subsequence string kernel with Nyström landmarks."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from millrace.llm.common import kept_apart, restored, smallest_rows

#: Subsequences of three characters within a span of five, each character of the span weighing 0.7.
REACH = 5
DECAY = 0.7
PAIRS = [(i, j) for i in range(1, REACH) for j in range(i + 1, REACH)]
#: Kernel values below this are 0, so that ordinary words have an empty row.
FLOOR = 0.5
LETTERS = 64
WIDTH = 32
LANDMARKS = 48
TRAINING_ROWS = 2000
ROUNDS = 3
COST = 10.0
#: Evidence that a landmark needs; chance gives this to about one word in a million.
SIGNIFICANT = 24.0
SENTENCE_ENDS = ".!?"
PUNCTUATION = ".!?,;:"
BATCH_TOKENS = 1 << 16
GROUP_CHARS = 4 << 20
#: Characters that stand for the ends of a word.
FIRST, LAST = "\x02", "\x03"
#: Landmarks are whole words and beginnings of this many characters.
STEMS = range(4, 8)
#: A word is compared once the parts around inserted marks are put together.
MARKS = re.compile(r"[^\w]+|_")


def _cut(token: str) -> list[str]:
    """The word between marks of its ends; a long one as overlapping pieces, so that no part of it is left out."""
    word = f"{FIRST}{token}{LAST}"
    return [word] if len(word) <= WIDTH else [word[i : i + WIDTH] for i in range(0, len(word) - WIDTH // 2, WIDTH // 2)]


def _plain(token: str) -> str:
    """The word in a token: without punctuation after it and marks inside it."""
    word = token.rstrip(PUNCTUATION)
    return word if word.isalnum() else MARKS.sub("", word)


def _spelled(tokens: list[str]) -> list[tuple[int, str]]:
    """Runs of three or more single characters, joined, with the place of the last.

    A neighbouring one-letter word may stand at either end, so the run also counts without these.
    """
    found, run = [], []
    for at, token in enumerate(tokens):
        word = token.rstrip(PUNCTUATION)
        if len(word) == 1:
            run.append(word)
        if len(word) != 1 or at == len(tokens) - 1:
            if len(run) >= 3:
                whole, place = "".join(run), at - (len(word) != 1)
                found += [(place, w) for w in (whole, whole[1:], whole[:-1], whole[1:-1]) if len(w) > 2]
            run = []
    return found


@dataclass
class Kernel:
    """Normalised gap-weighted subsequence kernel between words and fixed landmark words."""

    landmarks: list[str]
    letters: dict[int, int] = field(init=False)
    rows: np.ndarray = field(init=False)
    weights: np.ndarray = field(init=False)
    inner: np.ndarray = field(init=False)

    def __post_init__(self):
        used = Counter(c for word in self.landmarks for c in word)
        self.letters = {ord(c): k + 1 for k, (c, _) in enumerate(used.most_common(LETTERS - 1))}
        self.rows, self.weights = np.zeros(LETTERS**3, np.int32), np.zeros((1, len(self.landmarks)), np.float32)
        coded, _ = self._coded(self.landmarks)
        features: dict[int, np.ndarray] = {}
        norms = np.zeros(len(self.landmarks))
        for at in range(len(self.landmarks)):
            own: dict[int, float] = {}
            for i, j in PAIRS:
                triples = self._triples(coded[at : at + 1], i, j)[0]
                for triple in map(int, triples):
                    if triple // LETTERS**2 and triple // LETTERS % LETTERS and triple % LETTERS:
                        own[triple] = own.get(triple, 0.0) + DECAY ** (j + 1)
            norms[at] = np.sqrt(sum(v * v for v in own.values())) or 1.0
            for triple, value in own.items():
                features.setdefault(triple, np.zeros(len(self.landmarks)))[at] = value / norms[at]
        triples = sorted(features)
        self.rows[triples] = np.arange(1, len(triples) + 1)
        self.weights = np.vstack([self.weights, *(features[t] for t in triples)]).astype(np.float32)
        self.inner = self.values(self.landmarks)

    def _coded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Letters as small numbers, 0 for letters that no landmark has; and the lengths."""
        lengths = np.array([len(w) for w in words])
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        small = np.zeros(len(points), np.uint32)
        table = np.zeros(0x10000, np.uint32)
        for point, number in self.letters.items():
            if point < 0x10000:
                table[point] = number
        plane = points < 0x10000
        small[plane] = table[points[plane]]
        coded = np.zeros((len(words), WIDTH + REACH), np.uint32)
        coded[np.repeat(np.arange(len(words)), lengths), np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = small
        return coded, lengths

    @staticmethod
    def _triples(coded: np.ndarray, i: int, j: int, width: int = WIDTH) -> np.ndarray:
        """Numbers of the triples at distances ``i`` and ``j``; one with a foreign letter has a digit 0 and is in no landmark."""
        return (coded[:, :width] * LETTERS + coded[:, i : i + width]) * LETTERS + coded[:, j : j + width]

    def values(self, words: list[str]) -> np.ndarray:
        """Kernel of each word with each landmark; values under the floor are 0."""
        out = np.zeros((len(words), len(self.landmarks)), np.float32)
        order = np.argsort([len(w) for w in words], kind="stable")  # alike lengths share a narrow matrix
        for low in range(0, len(words), BATCH_TOKENS):
            places = order[low : low + BATCH_TOKENS]
            coded, lengths = self._coded([words[p] for p in places])
            width = max(int(lengths.max()), 1)
            sums = np.zeros((len(places), len(self.landmarks)), np.float32)
            for i, j in PAIRS:
                found = self.rows[self._triples(coded, i, j, width)]
                at, place = np.nonzero(found)
                if len(at):
                    starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
                    sums[at[starts]] += np.float32(DECAY ** (j + 1)) * np.add.reduceat(self.weights[found[at, place]], starts, axis=0)
            out[places] = sums / self._norms(lengths)[:, None]
        out[out < FLOOR] = 0
        return np.minimum(out, 1.0)

    @staticmethod
    def _norms(lengths: np.ndarray) -> np.ndarray:
        """Norm of a word whose subsequences are all different: it depends on the length alone."""
        squares = np.zeros(len(lengths))
        for _, j in PAIRS:
            squares += np.maximum(lengths - j, 0) * DECAY ** (2 * (j + 1))
        return np.sqrt(np.maximum(squares, DECAY**6))


@dataclass
class Model:
    kernel: Kernel | None
    project: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margins(self, texts: list[str]) -> np.ndarray:
        """The highest margin of any sentence of each text."""
        if self.kernel is None:
            return np.zeros(len(texts))
        base = np.full(len(texts), self.bias)
        for rows, owners in _grouped_rows(self.kernel, texts):
            np.maximum.at(base, owners, rows @ self.project @ self.weights + self.bias)
        return base

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(texts) + self.offset, -40, 40)))


def _near_words(kernel: Kernel, words: list[str]) -> dict[str, np.ndarray]:
    """Kernel rows of the words that come near a landmark, the best piece of a long word for each."""
    found: dict[str, np.ndarray] = {}
    for low in range(0, len(words), BATCH_TOKENS):
        pieces = [(p, w) for w in words[low : low + BATCH_TOKENS] for p in _cut(w)]
        values = kernel.values([p for p, _ in pieces])
        for at in np.flatnonzero(values.any(1)):
            word = pieces[at][1]
            found[word] = np.maximum(found[word], values[at]) if word in found else values[at]
    return found


def _sentence_rows(kernel: Kernel, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A row for each sentence with a word near a landmark: the best value per landmark."""
    tokens = [text.lower().split() for text in texts]
    plain = {t: w for t in set().union(*tokens) if len(w := _plain(t)) > 2}
    known = _near_words(kernel, sorted(set(plain.values())))
    near = {t: known[w] for t, w in plain.items() if w in known}
    spelled = [_spelled(t) if 1 in map(len, t) else [] for t in tokens]
    odd = _near_words(kernel, sorted({w for runs in spelled for _, w in runs}))
    rows, owners = [], []
    for at, (words, runs) in enumerate(zip(tokens, spelled)):
        places: dict[int, np.ndarray] = {}
        for k, word in runs:
            if word in odd:
                places[k] = np.maximum(places[k], odd[word]) if k in places else odd[word]
        if not places and near.keys().isdisjoint(words):
            continue
        best = None
        for k, word in enumerate(words):
            for value in (near.get(word), places.get(k)):
                if value is not None:
                    best = value if best is None else np.maximum(best, value)
            if best is not None and (word[-1] in SENTENCE_ENDS or k == len(words) - 1):
                rows.append(best)
                owners.append(at)
                best = None
    return np.array(rows, np.float32).reshape(len(rows), len(kernel.landmarks)), np.array(owners, np.int64)


def _grouped_rows(kernel: Kernel, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sentence rows of groups of texts of bounded size."""
    at = 0
    while at < len(texts):
        size, end = 0, at
        while end < len(texts) and (end == at or size + len(texts[end]) <= GROUP_CHARS):
            size, end = size + len(texts[end]), end + 1
        rows, owners = _sentence_rows(kernel, texts[at:end])
        if len(rows):
            yield rows, owners + at
        at = end


def _all_rows(kernel: Kernel, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    groups = [*_grouped_rows(kernel, texts)] or [(np.zeros((0, len(kernel.landmarks)), np.float32), np.zeros(0, np.int64))]
    return np.vstack([r for r, _ in groups]), np.concatenate([o for _, o in groups])


def _evidence(a: int, n: int, b: int, m: int) -> float:
    """Log-likelihood ratio of a word in ``a`` of ``n`` toxic and ``b`` of ``m`` clean documents."""
    rate = (a + b) / (n + m)
    expected = [(a, n * rate), (n - a, n * (1 - rate)), (b, m * rate), (m - b, m * (1 - rate))]
    return 2 * sum(x * np.log(x / e) for x, e in expected if x and e)


def _pick_landmarks(toxic: list[str], clean: list[str], count: int) -> list[str]:
    """Words that tell toxic documents best, none too near one that was picked before."""
    def counted(texts: list[str], only=None) -> Counter:
        counter = Counter()
        for text in texts:
            words = {w for t in text.lower().split() if 3 < len(w := t.rstrip(PUNCTUATION)) <= WIDTH - 2 and w.isalnum()}
            found = {f"{FIRST}{w}{LAST}" for w in words} | {FIRST + w[:n] for w in words for n in STEMS if len(w) > n}
            counter.update(found if only is None else found & only)
        return counter

    tell = {w: a for w, a in counted(toxic).items() if a > 1}
    usual = counted(clean, tell.keys())
    n, m = max(len(toxic), 1), max(len(clean), 1)
    signal = {w: g for w, a in tell.items() if a / n > 2 * usual[w] / m and (g := _evidence(a, n, usual[w], m)) >= SIGNIFICANT}
    ranked = sorted(signal, key=lambda w: (-signal[w], -len(w), w))[: 20 * count]
    picked: list[str] = []
    while ranked and len(picked) < count:
        picked.append(ranked.pop(0))
        near = Kernel(picked[-1:]).values(ranked)[:, 0] if ranked else []
        ranked = [w for w, k in zip(ranked, near) if k < 0.85]
    return picked


def _fit_svm(x: np.ndarray, y: np.ndarray, cost: float = COST) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, classes weighed alike, by Newton steps on its active set."""
    z = np.hstack([x, np.ones((len(x), 1))])
    share = np.where(y > 0, len(y) / (2 * max((y > 0).sum(), 1)), len(y) / (2 * max((y < 0).sum(), 1)))
    beta = np.zeros(z.shape[1])
    for _ in range(30):
        active = y * (z @ beta) < 1
        part, weight = z[active], share[active]
        matrix = np.eye(z.shape[1]) + 2 * cost * (part * weight[:, None]).T @ part
        new = np.linalg.solve(matrix, 2 * cost * (part * weight[:, None]).T @ y[active])
        if np.allclose(new, beta, atol=1e-6):
            break
        beta = new
    return beta[:-1], float(beta[-1])


def fit(toxic: list[str], clean: list[str], landmarks: int = LANDMARKS) -> Model:
    """Train on whole documents: a toxic one has at least one toxic sentence, a clean one has none.

    The sentence that speaks most for a toxic document is its example, chosen
    anew each round with the machine of the last. All sentences of clean
    documents with a word near a landmark, and the empty row, are counterexamples.
    """
    share = (len(toxic) + 1) / (len(toxic) + len(clean) + 4)
    constant = Model(None, np.zeros((0, 0)), np.zeros(0), 0.0, 0.0, float(np.log(share / (1 - share))))
    if not toxic or not clean:
        return constant
    chosen = _pick_landmarks(toxic, clean, landmarks)
    if not chosen:
        return constant
    kernel = Kernel(chosen)
    values, vectors = np.linalg.eigh((kernel.inner + kernel.inner.T).astype(float) / 2)
    kept = values > 1e-3
    project = vectors[:, kept] / np.sqrt(values[kept])
    good, _ = _all_rows(kernel, clean)
    bad, owner = _all_rows(kernel, toxic)
    good, bad = np.vstack([good, np.zeros((1, len(kernel.landmarks)))]) @ project, bad @ project
    model = Model(kernel, project, np.zeros(project.shape[1]), 0.0, 1.0, 0.0)
    if not len(bad):
        return constant
    # Landmark words with one character more are examples too: the machine must tolerate what the kernel does.
    whole = [w[1:-1] for w in kernel.landmarks if w.endswith(LAST)]
    odd = _near_words(kernel, sorted({w[:k] + c + w[k:] for w in whole for k in range(1, len(w)) for c in ("x", w[k])}))
    marred = np.array([*odd.values()], np.float32).reshape(len(odd), len(kernel.landmarks)) @ project
    strength = np.linalg.norm(bad, axis=1)
    for _ in range(ROUNDS):
        order = np.lexsort((-strength, owner))
        best = order[np.append(True, np.diff(owner[order]) != 0)]
        model.weights, model.bias = _fit_svm(np.vstack([bad[best], marred, good]), np.repeat([1.0, -1.0], [len(best) + len(marred), len(good)]))
        strength = bad @ model.weights
    margins = np.concatenate([model.margins(toxic), model.margins(clean)])
    truth = np.concatenate([np.ones(len(toxic)), np.zeros(len(clean))])
    # Platt's targets.
    target = np.where(truth > 0, (len(toxic) + 1) / (len(toxic) + 2), 1 / (len(clean) + 2))
    z, beta = np.stack([margins, np.ones(len(margins))], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -40, 40)))
        hessian = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(2)
        beta = np.clip(beta + np.linalg.solve(hessian, z.T @ (target - p) - 1e-2 * beta), -30, 30)
    model.slope, model.offset = float(beta[0]), float(beta[1])
    return model


def train(labelled: DataFrame, rows: int = TRAINING_ROWS, landmarks: int = LANDMARKS) -> Model:
    """Fit on at most ``rows`` toxic and twice as many clean rows of ``doc_id``, ``text``, ``toxic``: those of the smallest hash."""
    order = F.xxhash64(F.col("doc_id").cast("string"))  # of the id alone: texts of other rows need not move

    def some(label: int, most: int) -> list[str]:
        chosen = labelled.where((F.col("toxic") == label) & F.col("text").isNotNull()).select("doc_id", "text")
        return [r["text"] for r in smallest_rows(chosen, order, most).collect()]

    return fit(some(1, rows), some(0, 2 * rows), landmarks)


def score_toxicity(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """Add ``score`` (0 to 1, higher: more likely toxic) and ``predicted`` (1 from the threshold on) to every row.

    Every word of the whole text is compared with the landmarks, marks inside
    words are skipped and runs of single characters are joined; a sentence
    takes the best value of its words per landmark, the document its worst sentence.

    Null and empty texts score like one without any insult. Repeated rows stay; an
    empty table gives an empty result; a model without toxic or clean examples
    gives one constant score. Input columns named like an added one are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores([t or "" for t in texts.to_pylist()]), pa.float64())

    scored = kept_apart(docs, text=text).withColumn("score", score("text"))
    return restored(scored.withColumn("predicted", (F.col("score") >= threshold).cast("int")), docs.columns, "score", "predicted")
