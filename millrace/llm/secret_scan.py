"""Secrets: certain patterns, and weak candidates that count only beside the other parts of a credential."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import kept_apart, materialize, restored

#: Kinds of the certain patterns, then of the linked parts. Spans at one place are listed in this order.
BASE_KINDS = ("assign", "access", "hex")
PART_KINDS = ("identifier", "material", "endpoint")
KINDS = BASE_KINDS + PART_KINDS
#: Roles of a part in a credential: who, with what, where.
IDENTIFIER, SECRET, ENDPOINT = 0, 1, 2
#: The certain kinds take part as identifiers and secrets.
ROLE = {"assign": SECRET, "access": IDENTIFIER, "hex": SECRET, "identifier": IDENTIFIER, "material": SECRET, "endpoint": ENDPOINT}

#: Fixed patterns of the certain kinds. Only ASCII letters are alike in either case.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGNED_LENGTH = 6

#: Weak candidates: a name that says what the value is, or a value that looks like it.
NAMED = r"""(?<![A-Za-z0-9])(?:[A-Za-z0-9]+[_.-])*(?:%s)["']?[\x20\t]*(?:=|:(?!//))[\x20\t]*["']?(%s)"""
WHO = re.compile(NAMED % (r"user(?:_?name|_?id)?|login|account(?:_?id)?|client_?id|access_?key(?:_?id)?|key_?id|app_?id", r"[A-Za-z0-9._@%+-]{3,}"), re.I | re.A)
WHAT = re.compile(NAMED % (r"pass|pwd|pw|auth|credentials?|private_?key|access_?key|signing_?key|signature|key|pin", r"[A-Za-z0-9+/_.=~!@#$%^&*-]{6,}"), re.I | re.A)
BARE = re.compile(r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[A-Z])(?=[A-Za-z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/=_-])")
WHERE = re.compile(
    r"(?<![A-Za-z0-9])(?:[a-z][a-z0-9+.-]*://[^\s\"'<>]+|(?:(?:host|endpoint|server|region|url)[\"']?[\x20\t]*[:=][\x20\t]*[\"']?)[A-Za-z0-9][A-Za-z0-9./:_-]+)", re.I | re.A
)
SCOPE_END = re.compile(r"\n[\x20\t\r]*\n")

#: Parts of one credential lie in one paragraph and no farther apart than this many code points.
REACH = 300
SPANS = "array<struct<kind:string,start:int,end:int,base:int>>"
PART_FIELDS = ("kind", "start", "end", "base", "role", "scope")
PARTS = T.ArrayType(T.StructType([T.StructField(n, T.StringType() if n == "kind" else T.IntegerType()) for n in PART_FIELDS]))
ARROW = pa.list_(pa.struct([(n, pa.string() if n == "kind" else pa.int32()) for n in PART_FIELDS]))


def base_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """Leftmost matches of the certain patterns that do not overlap, per kind; one that fails its length is passed over whole."""
    for m in ASSIGN.finditer(text):
        if len(m.group(2)) >= ASSIGNED_LENGTH:
            yield "assign", *m.span()
    for m in ACCESS.finditer(text):
        yield "access", *m.span()
    for m in HEX.finditer(text):
        yield "hex", *m.span()


def weak_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """Candidates that mean nothing alone; of a named one the value."""
    for m in WHO.finditer(text):
        yield "identifier", *m.span(1)
    for m in WHAT.finditer(text):
        yield "material", *m.span(1)
    for m in BARE.finditer(text):
        yield "material", *m.span()
    for m in WHERE.finditer(text):
        yield "endpoint", *m.span()


def parts_of(text: str) -> list[tuple]:
    """All parts of a text: kind, start, end, base, role and the paragraph that it starts in.

    A weak candidate that touches a certain span or an earlier, longer candidate is no part of its own.
    """
    found = [(*s, 1) for s in base_spans(text)]
    weak = sorted(set(weak_spans(text)), key=lambda s: (s[1], -s[2], KINDS.index(s[0])))
    if weak:
        taken = sorted((s, e) for _, s, e, _ in found)
        at, upto = 0, 0
        for kind, start, end in weak:
            while at < len(taken) and taken[at][1] <= start:
                at += 1
            if start >= upto and (at == len(taken) or taken[at][0] >= end):
                found.append((kind, start, end, 0))
                upto = end
    found.sort(key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    ends, scope, parts = [m.end() for m in SCOPE_END.finditer(text)] if weak else [], 0, []
    for kind, start, end, base in found:
        while scope < len(ends) and ends[scope] <= start:
            scope += 1
        parts.append((kind, start, end, base, ROLE[kind], scope))
    return parts


@F.arrow_udf(PARTS)
def _parts(texts: pa.Array) -> pa.Array:
    return pa.array([[dict(zip(PART_FIELDS, p)) for p in parts_of(t or "")] for t in texts.to_pylist()], ARROW)


def _near(parts: DataFrame) -> DataFrame:
    """``row_id``, ``start``, ``end`` of the weak parts with the roles ``near`` them, as bits.

    An interval join: two parts are near in one paragraph with at most REACH between the end of one and
    the start of the other. Places are cut into cells of that width, so that a part looks into its own cells
    and their neighbours. Per cell and role only the last end and the first start are kept, which
    decide whether any part is near; so no pairs are formed, however many parts a cell has.
    """
    cell = lambda place: F.call_function("div", place, F.lit(REACH))
    both = F.array_distinct(F.array(cell(F.col("start")), cell(F.col("end"))))
    cells = (
        parts.select("row_id", "scope", "role", "start", "end", F.explode(both).alias("cell"))
        .groupBy("row_id", "scope", "cell", "role").agg(F.min("start").alias("first"), F.max("end").alias("last"))
    )
    cells = materialize(cells.withColumnsRenamed({"row_id": "of_row", "scope": "of_scope", "cell": "at_cell"}), "secret-cells")
    looked = F.explode(F.sequence(cell(F.col("start")) - 1, cell(F.col("end")) + 1)).alias("look")
    weak = parts.where("base = 0").select("row_id", "scope", "start", "end", "role", looked)
    meets = (F.col("row_id") == F.col("of_row")) & (F.col("scope") == F.col("of_scope")) & (F.col("look") == F.col("at_cell"))
    own, other = F.col("role"), F.col("other")
    met = weak.join(cells.withColumnRenamed("role", "other"), meets).where(own != other)
    close = (F.col("first") - F.col("end") <= REACH) & (F.col("start") - F.col("last") <= REACH)
    return met.where(close).groupBy("row_id", "start", "end").agg(F.bit_or(F.call_function("shiftleft", F.lit(1), other)).alias("near"))


def _complete(role: Column, near: Column) -> Column:
    """Whether a part with these roles near it belongs to a credential.

    An identifier needs a secret and a secret an identifier; an endpoint needs both.
    """
    has = lambda r: near.bitwiseAND(F.lit(1 << r)) != 0
    return F.when(role == IDENTIFIER, has(SECRET)).when(role == SECRET, has(IDENTIFIER)).otherwise(has(IDENTIFIER) & has(SECRET))


def find_secrets(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Add ``secrets`` to every row: an array of kind, start, end and base (1 for a certain pattern, 0 for a linked part).

    Positions count code points of the whole text, ends exclude; the order is by start, then kind
    as in ``KINDS``. The certain patterns always stay. Weak candidates - values named like an
    identifier, a secret or an endpoint, and bare mixed tokens of 20 characters or more - are added only where
    complementary parts stand in the same paragraph within 300 code points: identifiers beside secrets, secrets
    beside identifiers, endpoints beside both. ``carry`` names the columns to keep, all by default; they
    are written once on the way.

    Null and empty texts have none; a long text's parts are spread over many groups of the join. Repeated rows
    stay; an empty table gives an empty result; an input column named like the added one is replaced.
    """
    kept = list(docs.columns if carry is None else carry)
    packed = kept_apart(docs, text=text).select(
        F.struct(F.lit(1).alias("_"), *(F.col(f"row.`{c}`").alias(c) for c in kept)).alias("row"), _parts(F.col("text").cast("string")).alias("parts")
    )
    rows = materialize(packed.withColumn("row_id", F.monotonically_increasing_id()), "secret-parts")
    weak = F.exists("parts", lambda p: p["base"] == 0)
    parts = materialize(rows.where(weak).select("row_id", F.inline("parts")), "secret-candidates")
    near = _near(parts).select(F.col("row_id").alias("of_row"), F.col("start").alias("of_start"), F.col("end").alias("of_end"), "near")
    mine = (F.col("row_id") == F.col("of_row")) & (F.col("start") == F.col("of_start")) & (F.col("end") == F.col("of_end"))
    linked = parts.where("base = 0").join(near, mine).where(_complete(F.col("role"), F.col("near")))
    added = materialize(linked.groupBy(F.col("row_id").alias("of_row")).agg(F.collect_list(F.struct("kind", "start", "end")).alias("linked")), "secret-links")
    joined = rows.join(added, F.col("row_id") == F.col("of_row"), "left")
    base = F.filter("parts", lambda p: p["base"] == 1)
    order = F.array(*(F.lit(k) for k in KINDS))
    keyed = F.transform(
        F.concat(
            F.transform(base, lambda p: F.struct(p["start"], p["kind"], p["end"], F.lit(1).alias("base"))),
            F.transform(F.coalesce("linked", F.array().cast("array<struct<kind:string,start:int,end:int>>")), lambda p: F.struct(p["start"], p["kind"], p["end"], F.lit(0).alias("base"))),
        ),
        lambda p: F.struct(p["start"].alias("start"), F.array_position(order, p["kind"]).alias("place"), p["end"].alias("end"), p["kind"].alias("kind"), p["base"].alias("base")),
    )
    secrets = F.transform(F.sort_array(keyed), lambda p: F.struct(p["kind"].alias("kind"), p["start"].alias("start"), p["end"].alias("end"), p["base"].alias("base")))
    return restored(joined.select("row", secrets.cast(SPANS).alias("secrets")), kept, "secrets")
