"""Language identification by cross-parsing entropy (operator 8).

Per language a suffix automaton of labelled text recognises every substring of that text.
A document is parsed into phrases, each the longest match from where the last one ended (a
symbol that the language lacks is a phrase by itself). The cost of a language is phrases
times log2 of its training length, per symbol; the language of lowest cost wins.

Symbols are the bytes (UTF-8) of lower-case letters, and one space for each run of anything else.
So every letter of every script is told apart, without an alphabet to bound, and a letter that a
language lacks costs it as many phrases as it has unknown bytes.

The automata of all languages are one transition table by row displacement: the state is the place
its row is laid at, the entry at ``state + symbol`` names its owner and the next state, and an entry
of another owner means that the match ends. A table takes some 10 bytes per training symbol, so the
model, which is broadcast, is at most MAX_LANGUAGES * TRAINING_SYMBOLS * 40 bytes, and 1 MB for
each language as a rule. numpy steps all documents of a slice in all languages together. A
document is parsed in stretches of STRETCH symbols, which adds at most one phrase per stretch, to
every language alike; no symbol is left out.

The training sample is bounded, the same way at every size: the MAX_LANGUAGES commonest labels;
of each about SAMPLE_DOCS different texts by hash; of each text at most EXCERPT characters, from a
place in it that its hash chooses; and of these up to TRAINING_SYMBOLS symbols a language, every
text giving as much as the others, or all it has.

Defined cases: a text that is null or has no letter is ``und`` with score 0, and so is every
text when nothing was learned; ties go to the first language in order of name. The score is
the second-best cost's share of the two lowest costs (0.5 to 1; 1 if one language only).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlens.llm.common import held_out, id_and_text, text_slices

SAMPLE_DOCS, EXCERPT, TRAINING_SYMBOLS, MAX_LANGUAGES = 64, 3000, 24_000, 200
STRETCH = 4096
SLICE_BYTES = 4 << 20
UNKNOWN = "und"
SPACE = 0x20
BYTES = 256

_LETTER: np.ndarray | None = None


def is_letter() -> np.ndarray:
    """For each code point, whether it is a letter."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _LETTER


def symbols_of(text: str) -> np.ndarray:
    """The symbols of a text; none if it has no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letter = is_letter()[points]
    if not letter.any():
        return np.zeros(0, np.uint8)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of a run of others stays, as a space
    keep[:1] = True
    points = np.where(letter, points, SPACE)[keep].astype(np.uint32)
    if points.max() < 0x80:
        return points.astype(np.uint8)
    return np.frombuffer(points.tobytes().decode("utf-32-le").encode(), np.uint8)


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions (symbol to state, per state) of the automaton of all substrings. State 0 is
    the root."""
    following: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in symbols:
        new = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in following[p]:
            following[p][c] = new
            p = link[p]
        if p >= 0:
            q = following[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(following)
                following.append(dict(following[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and following[p].get(c) == q:
                    following[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return following


def displaced(following: list[dict[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row displacement: the place of each state's row, the owner's place of each entry (-1: nobody's)
    and its next state's place. No two rows have one place; the longest rows are laid first."""
    size = 4 * sum(map(len, following)) + 2 * len(following) + 8 * BYTES
    taken, used = np.zeros(size, bool), np.zeros(size, bool)
    place = np.zeros(len(following), np.int64)
    used[0] = True
    taken[list(following[0])] = True
    low = 1
    for state in sorted((k for k in range(1, len(following)) if len(following[k]) > 1), key=lambda k: -len(following[k])):
        row, at = list(following[state]), low
        while True:
            busy = used[at:at + 1024].copy()
            for c in row:
                busy |= taken[at + c:at + c + 1024]
            first = int(busy.argmin())
            if not busy[first]:
                break
            at += 1024
            low = max(low, at - 4096)  # it is dense there: look further on from now on
        at += first
        used[at] = True
        taken[at + np.array(row)] = True
        place[state] = at
    free = iter(np.flatnonzero(~taken).tolist())
    spare: list[int] = []  # free entries that did not suit the rows before
    for state, own in enumerate(following):
        if len(own) == 1 and state:
            symbol = next(iter(own))
            at = next((e - symbol for e in spare if e >= symbol and not used[e - symbol]), None)
            while at is None:
                e = next(free)
                at = e - symbol if e >= symbol and not used[e - symbol] else None
                if at is None and len(spare) < 8:
                    spare.append(e)
            if at + symbol in spare:
                spare.remove(at + symbol)
            used[at] = True
            place[state] = at
    unused = iter(np.flatnonzero(~used).tolist())
    for state, own in enumerate(following):
        if not own and state:
            place[state] = next(unused)
    owner = np.full(int(place.max()) + BYTES, -1, np.int32)
    after = np.zeros(len(owner), np.int32)
    for state, own in enumerate(following):
        at = place[state] + np.fromiter(own, np.int64, len(own))
        owner[at] = place[state]
        after[at] = place[list(own.values())]
    return place, owner, after


def sampled(texts: list[str], budget: int) -> np.ndarray:
    """Symbols of the texts, about ``budget`` of them: each text gives as many as the others, or all it
    has."""
    each = [x for x in map(symbols_of, texts) if len(x)]
    share, left = 0, budget
    for k, size in enumerate(sorted(map(len, each))):
        share = left // (len(each) - k)
        if size > share:
            break
        left -= size
        share = size
    parts = [np.append(x[:max(share, 1)], SPACE).astype(np.uint8) for x in each]
    return np.concatenate([np.zeros(0, np.uint8), *parts])


class CrossParser:
    """The automata of all languages in one table (``displaced``), learned from texts by language."""

    def __init__(self, texts: dict[str, list[str]]):
        self.languages, self.scale = sorted(texts), []
        owners, afters, roots = [], [], []
        self.restart = np.zeros((len(texts), BYTES), np.int32)
        base = 0
        for k, language in enumerate(self.languages):
            symbols = sampled(texts[language], TRAINING_SYMBOLS)
            following = suffix_automaton(symbols.tolist())
            place, owner, after = displaced(following)
            self.restart[k] = base
            for symbol, state in following[0].items():
                self.restart[k, symbol] = place[state] + base
            # Whatever follows the root starts a phrase, as where a match ends: its row is nobody's.
            owners.append(np.where(owner > 0, owner + base, -1).astype(np.int32))
            afters.append((after + base).astype(np.int32))
            roots.append(base)
            base += len(owner)
            self.scale.append(np.log2(max(2, len(symbols))))
        none = np.zeros(0, np.int32)
        self.owner, self.after = np.concatenate([none, *owners]), np.concatenate([none, *afters])
        self.roots = np.array(roots, np.int32)

    def costs(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cost of each language (rows) for each text, and the symbols of each text."""
        each = [symbols_of(t) for t in texts]
        sizes = np.array([len(s) for s in each], np.int64)
        flat = np.concatenate([*each, np.zeros(1, np.uint8)])
        first = np.cumsum(sizes) - sizes
        stretches = -(-sizes // STRETCH)
        doc = np.repeat(np.arange(len(texts)), stretches)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(stretches) - stretches, stretches)
        size = np.minimum(STRETCH, sizes[doc] - nth * STRETCH)
        order = np.argsort(-size, kind="stable")  # the stretches still running are a prefix
        doc, size, at = doc[order], size[order], (first[doc] + nth * STRETCH)[order]
        state = np.repeat(self.roots[:, None], len(doc), 1)
        phrases = np.zeros((len(self.languages), len(doc)), np.int32)
        running = np.searchsorted(-size, -np.arange(STRETCH), "left") if len(doc) else []
        for t in range(int(size[0]) if len(size) else 0):
            n = running[t]
            symbol, now = flat[at[:n] + t], state[:, :n]
            entry = now + symbol
            ended = self.owner.take(entry) != now
            after = self.after.take(entry)
            np.copyto(after, self.restart.take(symbol, axis=1), where=ended)
            phrases[:, :n] += ended
            state[:, :n] = after
        total = np.zeros((len(self.languages), len(texts)))
        for k in range(len(self.languages)):
            total[k] = np.bincount(doc, phrases[k], len(texts)) * self.scale[k] / np.maximum(sizes, 1)
        return total, sizes

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        cost, sizes = self.costs(texts)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        best = cost.argmin(0)
        if len(self.languages) > 1:
            two = np.partition(cost, 1, axis=0)[:2]
            score = two[1] / np.maximum(two.sum(0), 1e-12)
        else:
            score = np.ones(len(texts))
        known = sizes > 0
        return ([self.languages[b] if k else UNKNOWN for b, k in zip(best, known)], np.where(known, score, 0.0))


def fit(docs: DataFrame) -> CrossParser:
    """Learns from text and non-null lang of the rows that are not held out."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang")) \
        .filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))) \
        .filter(F.col("text").rlike(r"\p{L}")).select("lang", "text", F.xxhash64("text").alias("draw"))
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("draw").alias("n")) \
        .orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect()
    if not counts:
        return CrossParser({})
    bound = docs.sparkSession.createDataFrame(
        [(r["lang"], min(1 << 30, (SAMPLE_DOCS << 30) // max(1, r["n"]) + 1)) for r in counts], "lang string, bound long")
    begin = F.pmod(F.col("draw"), F.greatest(F.length("text") - EXCERPT, F.lit(0)) + 1).cast("int") + 1
    sample = (rows.join(F.broadcast(bound), "lang").filter(F.pmod("draw", F.lit(1 << 30)) < F.col("bound"))
              .select("lang", "draw", F.substring("text", begin, F.lit(EXCERPT)).alias("text"))
              .dropDuplicates(["lang", "draw"]).collect())
    texts: dict[str, list[str]] = {}
    for r in sorted(sample, key=lambda r: r["draw"]):
        texts.setdefault(r["lang"], []).append(r["text"])
    return CrossParser(texts)


def identify(docs: DataFrame, model: CrossParser) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, SLICE_BYTES):
            langs, scores = shared.value.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                "lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores, pa.float64())})

    rows = id_and_text(docs).withColumn("held_out", held_out(F.col("doc_id")))
    return rows.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double")
