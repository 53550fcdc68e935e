"""Secret scans: all rules in one automaton, one pass over the bytes of every text."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.automaton import Automaton
from tidewatch.llm.batches import map_texts, pieces


def whole(match: bytes) -> bytes:
    return match


def assigned(match: bytes) -> bytes:
    """What stands behind the sign, its spaces and an opening quote."""
    return match[re.search(rb"[:=] *[\"']?", match).end() :]


@dataclass(frozen=True)
class Rule:
    """`least` is the number of characters that `value` of a match needs; base rules are those of the contract."""

    kind: str
    pattern: str
    least: int
    base: bool = False
    value: Callable[[bytes], bytes] = whole


KEYWORD = r"(?i:password|passwd|secret|token|api_?key)[\"']? *[:=] *[\"']?"

#: The base rules as given, then formats that issuers of credentials have published.
RULES = (
    Rule("assign", KEYWORD + r"[A-Za-z0-9+/_.=-]+", 12, True, assigned),
    Rule("access", r"AKIA[A-Z0-9]+", 18, True),
    Rule("hex", r"[0-9a-f]{16,}", 16, True),
    Rule("github", r"gh[opsru]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 24),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----", 27),
)
SPAN = "struct<kind:string,start:bigint,end:bigint,base:boolean>"


def find(automaton: Automaton, rules: tuple[Rule, ...], text: str | None) -> list[tuple[str, int, int, bool]]:
    """Spans of one text in code points, by start, then by order of rules."""
    if not text:
        return []
    data = text.encode("utf-8", "surrogatepass")
    hits = [
        (start, r, end) for r, start, end in automaton.spans(data) if len(rules[r].value(data[start:end])) >= rules[r].least
    ]
    if hits and len(data) != len(text):
        first = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
        at = np.concatenate([[0], np.cumsum(first)])
        hits = [(int(at[start]), r, int(at[end])) for start, r, end in hits]
    return [(rules[r].kind, start, end, rules[r].base) for start, r, end in sorted(hits)]


def scan_secrets(
    df: DataFrame, id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES, keep: list[str] | None = None
) -> DataFrame:
    """One row per row of `df`: `id`, `spans` (array of kind, start, end, base) and the columns named in `keep`.

    Matches are leftmost, longest and not overlapping within each kind; offsets count code points, ends are exclusive. A
    null or empty text has an empty array, a null id stays, repeated rows each give a row, an empty table gives none.
    Other columns of `df` are not read, so their names cannot clash. No shuffle.
    """
    automaton = Automaton([r.pattern for r in rules])
    keep = [c for c in (keep or []) if c not in (id, text)]
    types = dict(df.dtypes)
    schema = ", ".join([f"`{id}` {types[id]}", *[f"`{c}` {types[c]}" for c in keep], f"spans array<{SPAN}>"])

    def run(parts: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for part in parts:
            spans = [
                [{"kind": k, "start": a, "end": b, "base": base} for k, a, b, base in find(automaton, rules, t)]
                for t in part.pop(text)
            ]
            yield part | {"spans": spans}

    return map_texts(df.select(id, *keep, text), run, schema, text)


def redact_secrets(df: DataFrame, id: str = "doc_id", text: str = "text", mask: str = "[secret]") -> DataFrame:
    """The rows and columns of `df`, every secret in `text` replaced by `mask`; overlapping secrets become one mask.

    Null texts stay null. No row is dropped.
    """
    rules = RULES
    automaton = Automaton([r.pattern for r in rules])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masked = [
                _masked(automaton, rules, t, mask) for part in pieces([batch.select([text])], text) for t in part[text]
            ]
            at = batch.schema.get_field_index(text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(masked, batch.schema.field(at).type))

    return df.mapInArrow(run, df.schema)


def _masked(automaton: Automaton, rules: tuple[Rule, ...], text: str | None, mask: str) -> str | None:
    spans = find(automaton, rules, text)
    if not spans:
        return text
    out, at = [], 0
    for _, start, end, _ in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def secret_report(found: DataFrame, id: str = "doc_id") -> DataFrame:
    """Counts per base kind, the digest of base spans and all spans as text, from the rows of `scan_secrets`."""
    shown = "array_join(transform({}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"
    base = "filter(spans, s -> s.base)"
    counts = [
        F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in ("assign", "access", "hex")
    ]
    return found.select(
        id,
        *counts,
        F.expr(f"sha2({shown.format(base)}, 256)").alias("base_sha256"),
        F.expr(shown.format("spans")).alias("spans"),
    )
