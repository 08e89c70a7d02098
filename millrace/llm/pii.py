"""Personal data: pattern detectors, and a skip-chain conditional random field that keeps a document consistent."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from millrace.llm.common import kept_apart, restored, smallest_rows

KINDS = ("email", "ip", "card", "phone")
#: Fixed patterns of the detectors.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SHORT = re.compile(r"[0-9]{3}-[0-9]{4}")
HINT = re.compile(r"[0-9@]")
TOKEN = re.compile(r"\S+")
EDGES = ".,;:!?()[]{}<>\"'"

OUT = 0
LABELS = 1 + len(KINDS)
FEATURES = 26
SKIP_PRIOR = 5.0
ITERATIONS = 12
DAMPING = 0.3
CERTAIN = 0.95
#: Evidence of a detector for its tokens, in nats.
OBSERVED = 12.0
TRAINING_ROWS = 2000
STEPS = 400
SPAN = ArrayType(StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("base", IntegerType())]))


def luhn(digits: str) -> bool:
    total = 0
    for at, d in enumerate(reversed(digits)):
        value = int(d) * (1 + at % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the run of local characters before each @, if a domain follows."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``kind``, start, end (code points, end exclusive) of the detectors' matches, by kind and start."""
    found = [(0, *s) for s in _emails(text)] if "@" in text else []
    if HINT.search(text):
        found += [(1, *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split("."))]
        found += [(2, *m.span()) for m in CARD.finditer(text) if 13 <= len(d := _digits(m.group())) <= 19 and luhn(d)]
        if "+" in text:
            found += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return found


@dataclass
class Tokens:
    """The candidate tokens of some texts: those with a digit or @. All other words are outside by definition."""

    text: list[int]
    start: list[int]
    end: list[int]
    features: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def _features(core: str) -> list[float]:
    digits = _digits(core)
    n, dots = len(digits), core.count(".")
    ip = IP.fullmatch(core)
    valid = bool(ip) and all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in core.split("."))
    card = 13 <= n <= 19 and all(c in "0123456789-" for c in core)
    domain = core.partition("@")[2]
    return [
        1.0, "@" in core, "@" in core and core[0] != "@" and bool(DOMAIN.fullmatch(domain)), "@" in core and "." not in domain,
        n == 0, 1 <= n <= 3, 4 <= n <= 6, n == 7, n == 8, 9 <= n <= 12, 13 <= n <= 19, n > 19,
        dots == 0, dots == 3, dots > 3, bool(ip), valid, bool(ip) and not valid, card, card and luhn(digits), card and not luhn(digits),
        core[0] == "+", bool(SHORT.fullmatch(core)), "(" in core, any(c.isalpha() for c in core), "=" in core or '"' in core,
    ]


def _keys(core: str, digits: str) -> list[str]:
    """What makes two tokens of a document the same or similar: all digits, the last seven, the local part."""
    keys = []
    if len(digits) >= 4 and "@" not in core:
        keys.append(f"d{digits}")
    if len(digits) >= 7 and "@" not in core:
        keys.append(f"l{digits[-7:]}")
    if "@" in core and len(core.partition("@")[0]) >= 3:
        keys.append(f"a{core.partition('@')[0].lower()}")
    return keys


def tokens_of(texts: list[str]) -> Tokens:
    """Candidates with chain edges between neighbours and skip edges from each token to the next one like it."""
    text, start, end, rows, chain, skip = [], [], [], [], [], []
    for at, whole in enumerate(texts):
        if not HINT.search(whole):
            continue
        last, seen = -2, {}
        for place, match in enumerate(TOKEN.finditer(whole)):
            token = match.group()
            if not HINT.search(token):
                continue
            lead = len(token) - len(token.lstrip(EDGES))
            core = token.strip(EDGES)
            if not core:
                continue
            node = len(rows)
            if last == place - 1:
                chain.append((node - 1, node))
            last = place
            for key in _keys(core, _digits(core)):
                if key in seen:
                    skip.append((seen[key], node))
                seen[key] = node
            text.append(at)
            start.append(match.start() + lead)
            end.append(match.start() + lead + len(core))
            rows.append(_features(token.rstrip(".,;:!?") or token))
    pairs = lambda edges: np.array(sorted(set(edges)), np.int64).reshape(-1, 2)
    return Tokens(text, start, end, np.array(rows, float).reshape(-1, FEATURES), pairs(chain), pairs(skip))


@dataclass
class Field:
    """Potentials of a token's features, of neighbours, and of distant tokens alike."""

    node: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def marginals(self, tokens: Tokens, observed: np.ndarray) -> np.ndarray:
        """Label probabilities by loopy sum-product messages, all edges at once, damped; detectors are evidence."""
        own = tokens.features @ self.node
        own[observed > 0, observed[observed > 0]] += OBSERVED
        if not len(own):
            return own
        edges = np.concatenate([tokens.chain, tokens.skip])
        table = np.concatenate([np.repeat(self.chain[None], len(tokens.chain), 0), np.repeat(self.skip[None], len(tokens.skip), 0)])
        source, target = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
        pairwise = np.concatenate([table, table.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        messages = np.zeros((len(source), LABELS))
        for _ in range(ITERATIONS if len(edges) else 0):
            belief = own.copy()
            np.add.at(belief, target, messages)
            sent = (belief[source] - messages[back])[:, :, None] + pairwise
            top = sent.max(1, keepdims=True)
            new = np.log(np.exp(sent - top).sum(1)) + top[:, 0]
            new -= new.max(1, keepdims=True)
            messages = DAMPING * messages + (1 - DAMPING) * new
        belief = own.copy()
        np.add.at(belief, target, messages)
        belief = np.exp(belief - belief.max(1, keepdims=True))
        return belief / belief.sum(1, keepdims=True)


def _detected(tokens: Tokens, spans: list[list[tuple]]) -> np.ndarray:
    """Label of each token after the first detector whose span it overlaps, 0 without one."""
    labels, ordered, at, next_span = np.zeros(len(tokens.text), np.int64), [], -1, 0
    for node, text in enumerate(tokens.text):
        if text != at:
            at, next_span = text, 0
            ordered = sorted((s[1], s[2], s[0] + 1) for s in spans[text])
        while next_span < len(ordered) and ordered[next_span][1] <= tokens.start[node]:
            next_span += 1
        near = [k for s, e, k in ordered[next_span : next_span + LABELS] if s < tokens.end[node] and tokens.start[node] < e]
        labels[node] = min(near, default=OUT)
    return labels


def fit(texts: list[str]) -> Field:
    """Pseudo-likelihood on the detectors' labels: each token given its features and its neighbours' labels.

    Skip potentials have a prior that favours equal labels, as repeats are rare.
    """
    prior = SKIP_PRIOR * np.eye(LABELS)
    node = np.zeros((FEATURES, LABELS))
    node[0, OUT] = 1.0
    chain, skip = np.zeros((LABELS, LABELS)), prior.copy()
    tokens = tokens_of(texts)
    if not len(tokens.text):
        return Field(node, chain, skip)
    truth = np.eye(LABELS)[_detected(tokens, [base_spans(t) for t in texts])]
    (a, b), (c, d) = tokens.chain.T, tokens.skip.T
    parameters = [node, chain, skip]
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    for step in range(1, STEPS + 1):
        score = tokens.features @ node
        np.add.at(score, b, truth[a] @ chain)
        np.add.at(score, a, truth[b] @ chain.T)
        np.add.at(score, d, truth[c] @ skip)
        np.add.at(score, c, truth[d] @ skip.T)
        p = np.exp(score - score.max(1, keepdims=True))
        error = p / p.sum(1, keepdims=True) - truth
        size = len(error)
        gradients = [
            tokens.features.T @ error / size + 1e-4 * node,
            (truth[a].T @ error[b] + error[a].T @ truth[b]) / size + 1e-4 * chain,
            (truth[c].T @ error[d] + error[c].T @ truth[d]) / size + 1e-3 * (skip - prior),
        ]
        for k, g in enumerate(gradients):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            parameters[k] -= 0.1 * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return Field(node, chain, (skip + skip.T) / 2)


def find_spans(field: Field, texts: list[str]) -> list[list[tuple[str, int, int, int]]]:
    """All spans of each text: kind, start, end, and 1 for those of the detectors; by kind, then start."""
    found = [[(*s, 1) for s in base_spans(t)] for t in texts]
    tokens = tokens_of(texts)
    observed = _detected(tokens, found)
    chances = field.marginals(tokens, observed)
    joined = set(map(tuple, tokens.chain.tolist()))
    added: list[list] = []
    for node in np.flatnonzero(chances[:, 1:].max(1, initial=0) >= CERTAIN) if len(chances) else []:
        at, kind = tokens.text[node], int(chances[node, 1:].argmax())
        start, end = tokens.start[node], tokens.end[node]
        if observed[node]:
            continue
        if added and added[-1][:2] == [at, kind] and (added[-1][4], node) in joined:
            added[-1][3:] = [end, node]
        else:
            added.append([at, kind, start, end, node])
    for at, kind, start, end, _ in added:
        found[at].append((kind, start, end, 0))
    return [[(KINDS[k], s, e, own) for k, s, e, own in sorted(spans)] for spans in found]


def train(docs: DataFrame, rows: int = TRAINING_ROWS, text: str = "text") -> Field:
    """Fit on at most ``rows`` texts with a digit or @: those of the smallest hash."""
    chosen = docs.select(F.col(f"`{text}`").cast("string").alias("text")).where(F.col("text").rlike("[0-9@]"))
    return fit([r["text"] for r in smallest_rows(chosen, F.xxhash64("text"), rows).collect()])


def find_personal_data(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """Add ``personal_data`` to every row: an array of kind, start, end and base (1 from a detector, 0 from the field).

    Positions count code points of the whole text, ends exclude. The detectors'
    spans always stay; the field adds tokens that it holds for personal data
    with a chance of at least 0.95, mostly repeats of a detected one in another form,
    and never overlaps a detector's span. Words without a digit or @ are
    never personal data.

    Null and empty texts have none. Repeated rows stay; an empty table gives an
    empty result; an input column named like the added one is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.int32())]))

    @F.arrow_udf(SPAN)
    def spans(texts: pa.Array) -> pa.Array:
        found = find_spans(shared.value, [t or "" for t in texts.to_pylist()])
        return pa.array([[dict(zip(("kind", "start", "end", "base"), s)) for s in row] for row in found], kind)

    return restored(kept_apart(docs, text=text).withColumn("personal_data", spans("text")), docs.columns, "personal_data")
