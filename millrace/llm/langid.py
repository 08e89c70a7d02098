"""Language identification by interpolated Kneser-Ney character models."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from millrace.llm.common import kept_apart, materialize, restored, smallest_rows, text_key, text_or_empty

ORDER = 4
UNIT_BITS = 16
#: Tables of up to this size in all are looked up in memory, larger ones are joined.
BROADCAST_BYTES = 64 << 20
BLOCK = 1 << 19
FLUSH_GRAMS = 1 << 20
CALIBRATION_ROWS = 3000
UNDETERMINED = "und"
PLAUSIBLE_SPREADS = 4.0
GRAMS = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])
SPACE = 32


@cache
def _unit_table() -> np.ndarray:
    """For each code point its 16-bit unit: a letter is itself, beyond the first plane 0xFFFF, all else a space."""
    points = np.arange(0x110000, dtype=np.uint32)
    letters = np.fromiter((chr(p).isalpha() for p in range(0x110000)), bool, 0x110000)
    return np.where(letters, np.minimum(points, 0xFFFF), SPACE).astype(np.uint64)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _units(text: str) -> np.ndarray:
    """Lower-cased letters with runs of anything else as one space; three spaces before, one after."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    units = _unit_table()[codes]
    blank = units == SPACE
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    return np.concatenate([np.full(ORDER - 1, SPACE, np.uint64), units[keep], np.full(1, SPACE, np.uint64)])


def _grams(units: np.ndarray) -> np.ndarray:
    """Four units per place, the last in the lowest bits."""
    grams = np.zeros(len(units) - ORDER + 1, np.uint64)
    for k in range(ORDER):
        grams = (grams << np.uint64(UNIT_BITS)) | units[k : k + len(grams)]
    return grams


def _pieces(text: str) -> Iterator[np.ndarray]:
    """Grams of a text in blocks of bounded size; a later block starts with the last units of the one before."""
    last = None
    for low in range(0, max(len(text), 1), BLOCK):
        units = _units(text[low : low + BLOCK])
        if last is not None:
            units[: ORDER - 1] = last
        if low + BLOCK < len(text):
            units = units[:-1]
            last = units[1 - ORDER:]
        yield _grams(units)


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    grams, place = np.unique(np.concatenate(keys), return_inverse=True)
    return grams, np.bincount(place, np.concatenate(counts)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[list, list]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, (keys, counts) in held.items():
            grams, n = _merged(keys, counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang]).take(pa.array(np.zeros(len(grams), np.int32))), pa.array(grams.view(np.int64)), pa.array(n)], schema=GRAMS)
        held.clear()

    for batch in batches:
        waiting: dict[str, tuple[list, list]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for grams in _pieces(text):
                keys, size = waiting.setdefault(lang, ([], [0]))
                keys.append(grams)
                size[0] += len(grams)
                if size[0] >= BLOCK:
                    _add(held, lang, keys)
                    del waiting[lang]
        for lang, (keys, _) in waiting.items():
            _add(held, lang, keys)
        for lang, (keys, counts) in held.items():
            if len(keys) > 16:
                grams, n = _merged(keys, counts)
                held[lang] = ([grams], [n])
        if sum(len(k) for keys, _ in held.values() for k in keys) > FLUSH_GRAMS:
            yield from flush()
    yield from flush()


def _add(held: dict, lang: str, keys: list[np.ndarray]) -> None:
    grams, n = np.unique(np.concatenate(keys), return_counts=True)
    kept = held.setdefault(lang, ([], []))
    kept[0].append(grams)
    kept[1].append(n)


def _low(gram: Column, units: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << UNIT_BITS * units) - 1))


def gram_counts(labelled: DataFrame, languages: list[str]) -> DataFrame:
    """Counts of all four-character grams over every row of ``lang``, ``text``: ``gram`` and a column ``n<k>`` per language."""
    counted = labelled.select("lang", "text").mapInArrow(_count, "lang string, gram bigint, n bigint")
    sums = [F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).alias(f"n{k}") for k, lang in enumerate(languages)]
    return materialize(counted.groupBy("gram").agg(*sums), "gram-counts")


def _discounts(counts: DataFrame, size: int) -> list[float]:
    """Absolute discount of each language from its numbers of grams seen once and twice."""
    row = counts.agg(*(F.count_if(F.col(f"n{k}") == times).alias(f"c{k}_{times}") for k in range(size) for times in (1, 2))).first()
    return [min(0.95, max(0.05, row[f"c{k}_1"] / (row[f"c{k}_1"] + 2 * row[f"c{k}_2"] + 1e-9))) for k in range(size)]


def _estimates(counts: DataFrame, lower: DataFrame | None, order: int, size: int, alphabet: int) -> tuple[DataFrame, DataFrame]:
    """Interpolated probabilities ``p<k>`` of every gram of one order under every language, and ``left<k>`` of every context.

    A gram that a language lacks has its backed-off probability there, so that one
    look-up serves all languages; a context that it lacks leaves everything to
    the lower order.
    """
    discounts = _discounts(counts, size)
    keyed = counts.withColumn("context", F.shiftrightunsigned("gram", UNIT_BITS))
    totals = keyed.groupBy("context").agg(
        *(F.sum(f"n{k}").alias(f"t{k}") for k in range(size)), *(F.count_if(F.col(f"n{k}") > 0).alias(f"kinds{k}") for k in range(size))
    )
    left = [F.when(F.col(f"t{k}") > 0, d * F.col(f"kinds{k}") / F.col(f"t{k}")).otherwise(1.0).alias(f"left{k}") for k, d in enumerate(discounts)]
    contexts = materialize(totals.select("context", *(f"t{k}" for k in range(size)), *left), "contexts")
    joined = keyed.join(contexts, "context")
    if lower is not None:
        below = lower.select(F.col("gram").alias("low"), *(F.col(f"p{k}").alias(f"below{k}") for k in range(size)))
        joined = joined.withColumn("low", _low(F.col("gram"), order - 1)).join(below, "low")

    def estimate(k: int) -> Column:
        under = F.lit(1.0 / alphabet) if lower is None else F.col(f"below{k}")
        seen = F.greatest(F.col(f"n{k}") - discounts[k], F.lit(0.0)) / F.greatest(F.col(f"t{k}"), F.lit(1))
        return (seen + F.col(f"left{k}") * under).alias(f"p{k}")

    return materialize(joined.select("gram", *(f"n{k}" for k in range(size)), *map(estimate, range(size))), "gram-estimates"), contexts


@dataclass
class Table:
    """Grams of one order, ascending, with a log probability (or log weight) per language."""

    keys: np.ndarray
    values: np.ndarray

    def find(self, grams: np.ndarray) -> np.ndarray:
        """The place of each gram; -1 if it is not there."""
        if not len(self.keys):
            return np.full(len(grams), -1, np.int64)
        place = np.minimum(np.searchsorted(self.keys, grams), len(self.keys) - 1)
        return np.where(self.keys[place] == grams, place, -1)


def _table(rows: DataFrame, size: int) -> Table:
    """Collect all of ``gram``, ``logs``; to be called for tables of a known, small size only."""
    found = rows.toArrow().combine_chunks()
    grams = found.column("gram").to_numpy().view(np.uint64) if found.num_rows else np.zeros(0, np.uint64)
    values = found.column("logs").combine_chunks().flatten().to_numpy().reshape(-1, size) if found.num_rows else np.zeros((0, size), np.float32)
    ascending = np.argsort(grams)
    return Table(grams[ascending], np.ascontiguousarray(values[ascending]))


def _logs(rows: DataFrame, key: str, value: str, size: int) -> DataFrame:
    return rows.select(F.col(key).alias("gram"), F.array(*(F.log(f"{value}{k}").cast("float") for k in range(size))).alias("logs"))


@dataclass
class Model:
    languages: list[str]
    grams: list[Table]
    contexts: list[Table]
    floor: float
    centre: np.ndarray
    spread: np.ndarray
    slope: float
    offset: float
    #: Per order the grams and the contexts as written tables of ``gram``, ``logs``, if they are too large for ``grams`` and ``contexts``.
    written: list[tuple[DataFrame, DataFrame]] | None = None

    def entropies(self, texts: list[str]) -> np.ndarray:
        """Cross-entropy per character (nats) of each text under each language; blocks bound the memory."""
        total, size = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        keys, owner, held = [], [], 0
        for at, text in enumerate(texts):
            for grams in _pieces(text):
                keys.append(grams)
                owner.append(at)
                held += len(grams)
                if held >= BLOCK:
                    self._score(keys, owner, total, size)
                    keys, owner, held = [], [], 0
        if keys:
            self._score(keys, owner, total, size)
        return -total / np.maximum(size, 1)[:, None]

    def _score(self, keys: list, owner: list, total: np.ndarray, size: np.ndarray) -> None:
        lengths = np.array([len(k) for k in keys])
        filled = lengths > 0
        grams = np.concatenate(keys)
        starts = (np.cumsum(lengths) - lengths)[filled]
        owners = np.array(owner)[filled]
        if not len(grams):
            return
        logs = np.zeros((len(grams), len(self.languages)), np.float32)
        rest = np.arange(len(grams))
        for order in range(ORDER, 0, -1):
            low = grams[rest] & np.uint64((1 << UNIT_BITS * order) - 1)
            place = self.grams[order - 1].find(low)
            hit = place >= 0
            logs[rest[hit]] += self.grams[order - 1].values[place[hit]]
            rest, low = rest[~hit], low[~hit]
            if not len(rest):
                break
            context = self.contexts[order - 1].find(low >> np.uint64(UNIT_BITS))
            known = context >= 0
            logs[rest[known]] += self.contexts[order - 1].values[context[known]]
        else:
            logs[rest] += self.floor
        np.add.at(total, owners, np.add.reduceat(logs, starts, axis=0, dtype=np.float64))
        np.add.at(size, owners, lengths[filled])

    def judge(self, entropies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the best language, and the calibrated chance that it is right."""
        best = entropies.argmin(1)
        lowest = entropies.min(1)
        margin = np.partition(entropies, 1, 1)[:, 1] - lowest if entropies.shape[1] > 1 else np.full(len(entropies), 1.0)
        sure = 1 / (1 + np.exp(-(self.slope * margin + self.offset)))
        odd = np.maximum(0, (lowest - self.centre[best]) / self.spread[best] - PLAUSIBLE_SPREADS)
        return best, sure * np.exp(-odd / PLAUSIBLE_SPREADS)


def train(labelled: DataFrame, calibration_rows: int = CALIBRATION_ROWS, broadcast_bytes: int = BROADCAST_BYTES) -> Model | None:
    """Fit the models on all rows of ``doc_id``, ``lang``, ``text``; None without any.

    Counts cover every character of every row. Highest-order probabilities come
    from counts, lower ones from the numbers of distinct left neighbours, each
    with its discount. A gram that some language lacks has its backed-off
    probability there, so that one look-up serves all languages. The confidence
    is calibrated on ``calibration_rows`` rows, those of the smallest hash of the id.

    The model keeps every gram: in memory if all tables take ``broadcast_bytes`` or
    less, else as written tables that texts are joined with.
    """
    labelled = labelled.where("lang is not null and text is not null")
    languages = sorted(r[0] for r in labelled.select("lang").distinct().collect())
    if not languages:
        return None
    size = len(languages)
    orders = [gram_counts(labelled, languages)]
    for order in range(ORDER - 1, 0, -1):
        kinds = orders[0].withColumn("gram", _low(F.col("gram"), order)).groupBy("gram")
        orders.insert(0, materialize(kinds.agg(*(F.count_if(F.col(f"n{k}") > 0).alias(f"n{k}") for k in range(size))), "gram-kinds"))
    alphabet = max(2, orders[0].count() + 1)
    written, lower = [], None
    for order in range(1, ORDER + 1):
        lower, weights = _estimates(orders[order - 1], lower, order, size, alphabet)
        written.append((_logs(lower, "gram", "p", size), _logs(weights, "context", "left", size)))
    entries = sum(rows.count() for pair in written for rows in pair)
    model = Model(languages, [], [], -float(np.log(alphabet)), np.zeros(size), np.ones(size), 1.0, 0.0)
    if entries * (8 + 4 * size) <= broadcast_bytes:
        model.grams, model.contexts = [_table(g, size) for g, _ in written], [_table(c, size) for _, c in written]
    else:
        model.written = written
    _calibrate(model, labelled, calibration_rows)
    return model


def _calibrate(model: Model, labelled: DataFrame, rows: int) -> None:
    """Centre and spread of the entropies per language; a logistic curve of the margin, with a weak prior."""
    scored = _entropy_rows(smallest_rows(labelled, F.xxhash64(F.col("doc_id").cast("string")), rows), model)
    found = [(r["lang"], np.array(r["entropies"])) for r in scored.select("lang", "entropies").collect() if r["entropies"] is not None]
    if not found:
        return
    margin, right = [], []
    for at, lang in enumerate(model.languages):
        own = np.array([e[at] for known, e in found if known == lang and e.argmin() == at])
        if len(own):
            model.centre[at], model.spread[at] = float(np.median(own)), max(0.05, float(np.std(own)))
    for lang, e in found:
        ordered = np.sort(e)
        margin.append(ordered[1] - ordered[0] if len(ordered) > 1 else 1.0)
        right.append(model.languages[int(e.argmin())] == lang)
    x = np.stack([np.array(margin), np.ones(len(margin))], 1)
    # Two rows of a prior: no margin is a coin toss, one nat is certain.
    x, y = np.concatenate([x, [[0.0, 1.0], [0.0, 1.0], [1.0, 1.0]]]), np.array([*map(float, right), 0.0, 1.0, 1.0])
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 1e-2])
        beta = np.clip(beta + np.linalg.solve(hessian, x.T @ (y - p) - np.array([1e-3, 1e-2]) * beta), -60, 60)
    model.slope, model.offset = float(beta[0]), float(beta[1])


def _text_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for piece in _pieces(text) if has_letter(text) else ():
                grams, n = np.unique(piece, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([key] * len(grams), pa.binary()), pa.array(grams.view(np.int64)), pa.array(n.astype(np.int64))], ["text_id", "gram", "n"])


def _gram_logs(grams: DataFrame, model: Model) -> DataFrame:
    """``gram`` and its log probabilities ``logs`` under all languages, by joins: each order takes what the one above lacks."""
    size = len(model.languages)
    plus = lambda a, b: F.transform(a, lambda x, k: x + b[k])
    rest, done = grams.select("gram").distinct().withColumn("sum", F.array(*[F.lit(0.0)] * size)), []
    for order in range(ORDER, 0, -1):
        of_grams, of_contexts = model.written[order - 1]
        low = rest.withColumn("low", _low(F.col("gram"), order) if order < ORDER else F.col("gram"))
        low = low.withColumn("context", F.shiftrightunsigned("low", UNIT_BITS))
        low = low.join(of_grams.select(F.col("gram").alias("low"), F.col("logs").alias("own")), "low", "left")
        low = low.join(of_contexts.select(F.col("gram").alias("context"), F.col("logs").alias("left")), "context", "left")
        either = F.when(F.col("own").isNotNull(), plus(F.col("sum"), F.col("own"))).when(F.col("left").isNotNull(), plus(F.col("sum"), F.col("left"))).otherwise(F.col("sum"))
        tried = materialize(low.select("gram", either.alias("sum"), F.col("own").isNotNull().alias("found")), "gram-logs")
        done.append(tried.where("found").select("gram", "sum"))
        rest = tried.where("not found").select("gram", "sum")
    for part in done:
        rest = rest.union(part) if part is not done[0] else rest.select("gram", F.transform("sum", lambda x: x + model.floor)).union(part)
    return rest.toDF("gram", "logs")


def _joined_entropies(rows: DataFrame, model: Model) -> DataFrame:
    """Add ``entropies`` by joins, for tables of any size; a text is known by its digest, so repeats only scale both sums."""
    rows = rows.withColumn("text_id", text_key(text_or_empty(F.col("text"))))
    grams = materialize(rows.where("text is not null").select("text_id", "text").mapInArrow(_text_grams, "text_id binary, gram bigint, n bigint"), "text-grams")
    scored = grams.join(materialize(_gram_logs(grams, model), "all-gram-logs"), "gram")
    sums = [F.sum(F.col("n") * F.col("logs")[k]).alias(f"s{k}") for k in range(len(model.languages))]
    found = scored.groupBy("text_id").agg(F.sum("n").alias("size"), *sums)
    entropies = F.array(*(-F.col(f"s{k}") / F.col("size") for k in range(len(model.languages))))
    return rows.join(materialize(found.select("text_id", entropies.alias("entropies")), "text-entropies"), "text_id", "left").drop("text_id")


def _entropy_rows(rows: DataFrame, model: Model) -> DataFrame:
    if model.written is not None:
        return _joined_entropies(rows, model)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(ArrayType(DoubleType()))
    def entropies(texts: pa.Array) -> pa.Array:
        found = texts.to_pylist()
        known = [at for at, t in enumerate(found) if has_letter(t)]
        values: list = [None] * len(found)
        if known:
            for at, e in zip(known, shared.value.entropies([found[at] for at in known]).tolist()):
                values[at] = e
        return pa.array(values, pa.list_(pa.float64()))

    return rows.withColumn("entropies", entropies("text"))


def identify(docs: DataFrame, model: Model | None, text: str = "text", reject_below: float = 0.5) -> DataFrame:
    """Add ``lang_pred``, ``score`` (0 to 1) and ``rejected`` to every row.

    The language with the lowest cross-entropy per character wins; the score is the
    calibrated chance that it is right, lower for a text unlike anything learned.
    ``rejected`` marks scores under ``reject_below``.

    A null text, one without a letter, and every text if nothing was learned is
    ``und`` with score 0. Long texts pass in blocks. Repeated rows stay; an empty
    table gives an empty result; input columns named like an added one are replaced.
    """
    rows = kept_apart(docs, text=text)
    languages = model.languages if model else []
    joined = model is not None and model.written is not None
    shared = docs.sparkSession.sparkContext.broadcast(replace(model, written=None) if joined else model)
    result = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def judged(size: int, known: list[int], entropies: Callable[[], np.ndarray]) -> pa.StructArray:
        names, scores = [UNDETERMINED] * size, [0.0] * size
        if known:
            best, sure = shared.value.judge(entropies())
            for at, b, s in zip(known, best.tolist(), sure.tolist()):
                names[at], scores[at] = languages[b], s
        return pa.StructArray.from_arrays([pa.array(names), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    @F.arrow_udf(result)
    def predict(texts: pa.Array) -> pa.Array:
        found = texts.to_pylist()
        known = [at for at, t in enumerate(found) if languages and has_letter(t)]
        return judged(len(found), known, lambda: shared.value.entropies([found[at] for at in known]))

    @F.arrow_udf(result)
    def predict_scored(entropies: pa.Array) -> pa.Array:
        found = entropies.to_pylist()
        known = [at for at, e in enumerate(found) if e is not None]
        return judged(len(found), known, lambda: np.array([found[at] for at in known]))

    if joined:
        found = _entropy_rows(rows, model).select("row", predict_scored("entropies").alias("found"))
    else:
        found = rows.select("row", predict("text").alias("found"))
    found = found.select("row", "found.lang_pred", "found.score")
    return restored(found.withColumn("rejected", F.col("score") < reject_below), docs.columns, "lang_pred", "score", "rejected")
