"""Secret scans with one combined deterministic automaton (operator 12).

All rules are compiled together (``automaton.compile_rules``: subset construction, then
minimisation into transition arrays) and found in one pass over the bytes of a text. A scan reads
each row where it lies: no shuffle, no state between rows, and a lost executor costs the
re-read of its files. Texts are joined with a byte that no UTF-8 text has and scanned in windows
of 2 MB, so memory does not follow the length of a text.

Matches of a rule are leftmost and do not overlap, those too short are dropped; other rules do not disturb
them, so the rules beyond the first three only add spans. Offsets are code points, ends are
exclusive.

Defined cases: a null or empty text has no span; null ids and repeated rows pass through, one
result per row; an empty table gives no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlens.llm import automaton
from assetlens.llm.common import id_and_text, text_slices

SLICE_BYTES = 4 << 20


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``least``: characters of the match, or of its ``value`` (from the character
    at which the expression is first satisfied: the value must be the expression's last, repeated
    class), that it must have."""
    kind: str
    pattern: str
    least: int = 0
    value: bool = False


# The base rules of the contract. Runs of 16 or more hex digits are runs that are
# long enough, so the length is in the expression.
BASE_RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", 12, True),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]{16,}"),
)
# Public formats of credentials, beyond the base rules.
MORE_RULES = (
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 24),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+", 40),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES

SPANS = "array<struct<kind: string, start: long, end: long, value_start: long>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                            ("value_start", pa.int64())]))


def find_spans(scanner: automaton.Scanner, rules: tuple[Rule, ...], texts: list[bytes]) -> list[list[dict]]:
    """Spans of each text (UTF-8), by start, then in the order of the rules."""
    joined = bytes([automaton.RESET]).join([*texts, b""])
    begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    found: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
    for k, start, first, end in scanner.matches(joined):
        rule = rules[k]
        if end - (first if rule.value else start) >= rule.least:
            text = int(np.searchsorted(begins, start, "right")) - 1
            found[text].append((start - int(begins[text]), k, end - int(begins[text]), first - int(begins[text])))
    out = []
    for data, spans in zip(texts, found):
        if spans and not data.isascii():
            points = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)  # characters up to each byte
            spans = [(int(points[s]) - 1, k, int(points[e - 1]), int(points[v]) - 1) for s, k, e, v in spans]
        out.append([{"kind": rules[k].kind, "start": s, "end": e, "value_start": v if rules[k].value else s}
                    for s, k, e, v in sorted(spans)])
    return out


def scan_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of ``docs``: doc_id, spans (kind, start, end, value_start)."""
    scanner = docs.sparkSession.sparkContext.broadcast(automaton.compile_rules([r.pattern for r in rules]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, SLICE_BYTES):
            spans = find_spans(scanner.value, rules, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, _SPAN)], ["doc_id", "spans"])

    rows = id_and_text(docs).withColumn("text", F.col("text").cast("binary"))
    return rows.mapInArrow(run, f"doc_id long, spans {SPANS}")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def with_digest(found: DataFrame) -> DataFrame:
    """doc_id, the number of spans of each base kind, the SHA-256 of the base spans as text, and all
    spans as text."""
    base, spans = [r.kind for r in BASE_RULES], F.col("spans")

    def of(*kinds: str) -> Column:
        return F.filter(spans, lambda s: s["kind"].isin(*kinds))

    return found.select("doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base],
                        F.sha2(_joined(of(*base)), 256).alias("base_sha256"), _joined(spans).alias("spans"))
