"""Secret scans: all rules in one automaton, one pass over the bytes of a text.

A rule is a head (any pattern) followed by a run of body characters.  The combined automaton searches for
"head and a first body character" of every rule at once; where it accepts, the reversed head gives the
leftmost start, the run gives the greedy end, and a run that is too short is a match that is consumed but
not reported - as a regex search that filters its matches would do.  A rule without a head is a bare run;
its least length is compiled into the automaton.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import Automaton, compile_automaton, longest, parse, reverse
from .common import small_batches


@dataclass(frozen=True)
class Rule:
    kind: str
    head: str
    body: str
    least: int  # body characters
    ignore_case: bool = False  # of the head


# The three base kinds and, after them, formats that issuers publish for their keys.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", r"[A-Za-z0-9+/_.=-]", 12, True),
    Rule("access", r"AKIA", r"[A-Z0-9]", 14),
    Rule("hex", r"", r"[0-9a-f]", 16),
)
MORE = (
    Rule("forge", r"(gh[pousr]|github_pat)_", r"[A-Za-z0-9_]", 22),
    Rule("chat", r"xox[abprs]-", r"[A-Za-z0-9-]", 10),
    Rule("cloud", r"AIza", r"[A-Za-z0-9_-]", 35),
    Rule("payment", r"[sr]k_(live|test)_", r"[A-Za-z0-9]", 16),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.", r"[A-Za-z0-9_-]", 8),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"[A-Za-z0-9+/=\x20\x09-\x0D]", 32),
)
RULES = BASE + MORE


class Scanner:
    """Finds the spans of ``rules`` in bytes."""

    def __init__(self, rules: Sequence[Rule] = RULES) -> None:
        self.rules = tuple(rules)
        heads = [parse(r.head, r.ignore_case) for r in rules]
        bodies = [parse(r.body) for r in rules]
        found = [("cat", [h, b]) if r.head else ("rep", b, r.least, None) for r, h, b in zip(rules, heads, bodies, strict=True)]
        self.all: Automaton = compile_automaton(found, search=True)
        self.forward = [compile_automaton([h], search=False) for h in heads]
        self.back = [compile_automaton([reverse(h)], search=False) for h in heads]
        self.body = [bytes(b[1][0][1] >> x & 1 for x in range(256)) for b in bodies]

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, number of the rule, end) in bytes, by start, then rule."""
        table, accepting, accepts = self.all.table, self.all.accepting, self.all.accepts
        out: list[tuple[int, int, int]] = []
        done = [0] * len(self.rules)  # up to where each rule has consumed the text
        s = self.all.start
        for i, b in enumerate(data):
            s = table[s + b]
            if s >= accepting:
                for k in accepts[s >> 8]:
                    if i >= done[k]:
                        self._settle(data, k, i, done, out)
        out.sort()
        return out

    def _settle(self, data: bytes, k: int, i: int, done: list[int], out: list) -> None:
        rule, body = self.rules[k], self.body[k]
        if rule.head:
            start = longest(self.back[k], data, i, done[k], -1)
            if start < 0:
                return
            begin = longest(self.forward[k], data, start, i, 1)
        else:
            start = i
            while start > done[k] and body[data[start - 1]]:
                start -= 1
            begin = start
        end = i + 1
        while end < len(data) and body[data[end]]:
            end += 1
        done[k] = end
        if end - begin >= rule.least:
            out.append((start, k, end))


@functools.lru_cache(4)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


def _points(data: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Byte offsets as code points, each stretch of the text decoded once."""
    edges = sorted({x for s, _, e in spans for x in (s, e)})
    at, point, seen = 0, 0, {}
    for x in edges:
        point += len(data[at:x].decode("utf-8", "replace"))
        at = x
        seen[x] = point
    return [(seen[s], k, seen[e]) for s, k, e in spans]


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id`` and ``found``, an array of (kind, start, end) in code points, end exclusive.

    Spans of one kind don't overlap; they stand by start, then in the order of the rules.  A null or empty
    text has none.  Repeated rows each give a row; texts of any length are scanned whole.
    """
    small_batches(docs.sparkSession)
    rules = tuple(rules)
    schema = "doc_id " + docs.schema[id_col].dataType.simpleString() + ", found array<struct<kind:string,start:bigint,end:bigint>>"

    def run(batches: Iterator):
        import pyarrow as pa

        find = scanner(rules)
        kinds = [r.kind for r in rules]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            found = []
            for text in batch.column(1).cast(pa.binary()):
                data = text.as_py() or b""
                spans = find.spans(data)
                found.append([{"kind": kinds[k], "start": s, "end": e} for s, k, e in _points(data, spans)] if spans else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=["doc_id", "found"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def joined(found):
    """``kind:start:end`` of an array of spans, comma-joined."""
    one = F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.concat_ws(",", one)


def digest(found: DataFrame, base: Sequence[Rule] = BASE) -> DataFrame:
    """The counts, the hash of the base spans and all spans as text, of what :func:`scan` returns."""
    kinds = [r.kind for r in base]
    own = F.filter("found", lambda s: s["kind"].isin(kinds))

    def count(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in kinds],
        F.sha2(joined(own).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )


def base_sha256(text: str | None) -> str:
    """The digest of the base spans of one text, by the automaton."""
    data = (text or "").encode()
    find = scanner(BASE)
    spans = _points(data, find.spans(data))
    return hashlib.sha256(",".join(f"{BASE[k].kind}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()
