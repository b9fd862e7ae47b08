"""Secrets in texts, by regular expressions behind a trigram index.

Each rule is a regular expression from which a Boolean query of trigrams is derived. Each
batch of texts gets an inverted index from the trigrams that any rule asks for to the texts
that hold them; a rule's query intersects and joins these postings, and only the texts that it
leaves are searched. A rule without mandatory trigrams searches every text. Texts are never
cut, and nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.text import text_blocks
from tradewind.llm.trigrams import grams_of, trigram_query


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches, leftmost and not overlapping, of which those with a group shorter than ``least`` are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# Letters in either case are ASCII letters: the patterns are compiled with re.ASCII.
BASE_RULES = (
    Rule("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+(?:-----END [A-Z ]*PRIVATE KEY-----)?"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,15}://[^\s/:@]{1,64}:[^\s/@]{3,128}@"),
    Rule("bearer", r"(?i:bearer) [A-Za-z0-9._~+/-]{20,}=*"),
    Rule("code_host", r"(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("map_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"(?:sk|rk)_(?:live|test)_[A-Za-z0-9]{16,}"),
)
RULES = BASE_RULES + MORE_RULES


def postings(data: np.ndarray, offsets: np.ndarray, wanted: dict[int, bytes]) -> dict[bytes, np.ndarray]:
    """The rows, rising, that hold each wanted trigram; keys of ``wanted`` are trigrams as numbers."""
    out = {gram: np.zeros(0, np.int64) for gram in wanted.values()}
    if len(data) < 3 or not wanted:
        return out
    low = data.astype(np.int32)
    low[(data >= 65) & (data <= 90)] += 32
    codes = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]
    asked = np.zeros(1 << 24, bool)
    asked[list(wanted)] = True
    at = np.flatnonzero(asked[codes])
    row = np.searchsorted(offsets, at, "right") - 1
    inside = at + 3 <= offsets[row + 1]
    pairs = np.unique((codes[at[inside]].astype(np.int64) << 32) | row[inside])
    grams = pairs >> 32
    for code in np.unique(grams):
        first, last = np.searchsorted(grams, [code, code + 1])
        out[wanted[int(code)]] = pairs[first:last] & 0xFFFFFFFF
    return out


def candidates(query, index: dict[bytes, np.ndarray], n: int) -> np.ndarray:
    """The rows that satisfy a query, rising."""
    if query is None:
        return np.arange(n)
    if isinstance(query, frozenset):
        found = None
        for rows in sorted((index[g] for g in query), key=len):
            found = rows if found is None else np.intersect1d(found, rows, assume_unique=True)
        return found
    parts = [candidates(q, index, n) for q in query[1]]
    found = parts[0]
    for p in parts[1:]:
        found = np.intersect1d(found, p, assume_unique=True) if query[0] == "and" else np.union1d(found, p)
    return found


def matches(rule: Rule, pattern: re.Pattern, text: str) -> Iterator[tuple[int, int]]:
    for m in pattern.finditer(text):
        if m.end(rule.group) - m.start(rule.group) >= rule.least:
            yield m.span()


def _scan(batches: Iterator[pa.RecordBatch], rules: Sequence[Rule]) -> Iterator[pa.RecordBatch]:
    compiled = [re.compile(r.pattern, re.ASCII) for r in rules]
    queries = [trigram_query(r.pattern, re.ASCII) for r in rules]
    wanted = {int.from_bytes(g): g for q in queries for g in grams_of(q)}
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        texts = batch.column("text")
        found: list[list[tuple[int, int, int]]] = [[] for _ in range(batch.num_rows)]
        for first, last, data, offsets in text_blocks(texts):
            index = postings(data, offsets, wanted)
            held: dict[int, str] = {}
            for k, (rule, pattern, query) in enumerate(zip(rules, compiled, queries, strict=True)):
                for row in candidates(query, index, last - first).tolist():
                    if row not in held:
                        held[row] = data[offsets[row] : offsets[row + 1]].tobytes().decode()
                    found[first + row] += [(start, k, end) for start, end in matches(rule, pattern, held[row])]
        listed = [[{"kind": rules[k].kind, "start": s, "end": e} for s, k, e in sorted(row)] for row in found]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(listed, spans)], names=[*batch.schema.names, "spans"]
        )


def with_secrets(docs: DataFrame, columns: Sequence[str] = (), rules: Sequence[Rule] = RULES) -> DataFrame:
    """``columns`` and ``text`` of each row, and spans: an array of (kind, start, end).

    Positions count code points, the end is exclusive; spans are sorted by start, then by the
    order of the rules. Spans of different kinds may overlap. A null text has no spans. Rows
    stay as they are, whatever their other columns hold.
    """
    rows = docs.select(*columns, "text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    found = "spans array<struct<kind: string, start: long, end: long>>"
    return rows.mapInArrow(partial(_scan, rules=tuple(rules)), f"{fields}, {found}")


def redacted(text, spans):
    """``text`` with each run of overlapping spans replaced by [kind] of its first span."""
    ends = F.aggregate(
        spans,
        F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at")),
        lambda s, x: F.when(x["end"] <= s["at"], s).otherwise(
            F.struct(
                F.when(
                    x["start"] >= s["at"],
                    F.concat(s["done"], F.substring(text, (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int")), F.lit("["), x["kind"], F.lit("]")),
                ).otherwise(s["done"]).alias("done"),
                x["end"].alias("at"),
            )
        ),
        lambda s: F.concat(s["done"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text))),
    )
    return F.when(F.size(spans) == 0, text).otherwise(ends)
