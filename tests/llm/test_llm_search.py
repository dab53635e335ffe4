"""Prefix trie, secret scan and lexical search: SQL on the given tables, brute force on odd ones."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from assetlens.llm import automaton, ball_tree, lexical_search, prefix_trie, secret_scan
from conftest import SF_SMALL
from oracle_compare import compare, duck

KEYS = ["op11_prefix_trie", "op12_secret_automaton", "op13_ball_tree_search"]


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, key):
    ok, said = compare(entry_mod.queries()[key](spark, SF_SMALL), duck(SF_SMALL), entry_mod.oracle_sql()[key])
    assert ok, said


# ------------------------------------------------------------------------- prefix trie

def trie_by_hand(conversations):
    """{(depth, path)} of rebuilt conversations -> the contract's row."""
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    rows = []
    children = Counter(p[:-1] for p in members if p)
    for path, own in members.items():
        below = [p for p in members if p[:len(path)] == path]
        ends = ",".join(str(c) for c in sorted(own) if len(conversations[c]) == len(path))
        rows.append((min(own), len(path), min(members[path[:-1]]) if path else None, len(own), children[path],
                     sum(not children[p] for p in below),
                     sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p),
                     hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def rebuilt_by_hand(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    out = {}
    for c, turns in own.items():
        h, head = zlib.crc32(str(c).encode()) % 6, own.get(c - int(math.fmod(c, 100)), [])
        out[c] = head[:h] + turns[h:]
    return out


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
TURNS = "conv_id long, turn long, role string, text string"


def test_trie_against_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    texts = ["", None, "a", "b", "né", "漢字", "long " * 9]
    rows = []
    for c in [*range(0, 60), *range(100, 130), 205, 299, -3, -100, -150, 2**40, 2**62]:
        for t in range(rng.choice([1, 2, 4, 6, 9, 17, 40])):
            text = texts[0] if t < 12 and rng.random() < 0.8 else rng.choice(texts)
            rows.append((c, t * 3 - 5, rng.choice(["user", None]) if t > 20 else "user", text))
    rows += [(5, None, "system", "first")] + [(None, 1, "user", "x")] * 3
    want = trie_by_hand(rebuilt_by_hand(rows))
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("x") for c in ("pos", "block", "part", "n1", "depth")})
    for settings in ({}, {"SUPER_BLOCK": 2, "TURN_BITS": 2, "CHUNK_BITS": 1, "WIDTH": 3}):
        for name, value in settings.items():
            monkeypatch.setattr(prefix_trie, name, value)
        got = prefix_trie.shared_opening_trie(df).select(COLUMNS).collect()
        assert sorted((tuple(r) for r in got), key=str) == want


def test_trie_of_ties_repeats_and_nothing(spark):
    rows = [(7, 1, "user", "b"), (7, 1, "user", "b"), (7, 1, "agent", "z"), (8, 1, "agent", "z")]
    nodes, ends = prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS))
    got = {(r["depth"], r["n_convs"], r["conv_id"]) for r in nodes.collect()}
    assert got == {(0, 2, 7), (1, 2, 7), (2, 1, 7), (3, 1, 7)}  # by role; equal rows are two turns
    assert sorted(r["ids"] for r in ends.collect()) == [[7], [8]]
    empty = spark.createDataFrame([], TURNS)
    assert prefix_trie.shared_opening_trie(empty).collect() == []
    assert prefix_trie.prefix_trie(empty)[0].collect() == []


def test_trie_prunes_before_it_groups(spark):
    blocks = prefix_trie.column_blocks(spark.createDataFrame([(1, 1, 5, 6, 7)], "conv_id long, pos long, h1 long, h2 long, tokens long"),
                                       spark.createDataFrame([(1,)], "conv_id long"))
    plan = prefix_trie._rollup(blocks, "min(conv_id) AS owner")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min") < plan.index("Filter") < plan.index("Expand")
    assert "SortAggregate" not in plan


# ------------------------------------------------------------------------- secret scan

def spans_by_hand(text):
    """(start, rule, end) by the contract's wording, with Python's own expressions."""
    word = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
                    for w in ("password", "passwd", "secret", "token", "api_?key"))
    out = []
    for k, rule in enumerate(secret_scan.RULES):
        pattern = {"assign": rf"""(?:{word})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                   "hex": "[0-9a-f]+"}.get(rule.kind, rule.pattern)
        least = {"assign": 12, "access": 18, "hex": 16}.get(rule.kind, rule.least)
        out += [(m.start(), k, m.end()) for m in re.finditer(pattern, text)
                if len(m.group(1) if rule.kind == "assign" else m.group()) >= least]
    return sorted(out)


FRAGMENTS = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", "ſecret", " ", "  ", ":", "=", '"', "'", "AKIA",
             "akia", "A1B2C3D4E5F6G7", "0123456789abcdef", "deadbeef", "é", "漢", "\n", "x", "-", "--", "-----BEGIN ",
             "RSA ", "PRIVATE KEY-----", "eyJ", "abcDEF123_", ".", "ghp_", "xoxb-", "AIza", "Zz9" * 6, "k" * 14, "\x00", "😀"]


def test_scan_against_re():
    rng, found = random.Random(5), 0
    scanner = automaton.compile_rules([r.pattern for r in secret_scan.RULES])
    kinds = [r.kind for r in secret_scan.RULES]
    texts = ["".join(rng.choice(FRAGMENTS) for _ in range(rng.choice([0, 1, 3, 30, 300]))) for _ in range(1500)]
    texts.append("".join(rng.choice(FRAGMENTS) for _ in range(40_000)))
    for begin in range(0, len(texts), 100):
        part = texts[begin:begin + 100]
        for text, spans in zip(part, secret_scan.find_spans(scanner, secret_scan.RULES, [t.encode() for t in part])):
            got = [(s["start"], kinds.index(s["kind"]), s["end"]) for s in spans]
            assert got == spans_by_hand(text)
            for s in spans:
                if s["kind"] == "assign":
                    assert re.fullmatch(r"[A-Za-z0-9+/_.=-]{12,}", text[s["value_start"]:s["end"]])
            found += len(got)
    assert found > 5000


def test_windows_and_segments_make_no_difference(monkeypatch):
    rng = random.Random(9)
    text = "".join(rng.choice(FRAGMENTS) for _ in range(3000)).encode()
    scanner = automaton.compile_rules([r.pattern for r in secret_scan.RULES])
    want = sorted(scanner.matches(text))
    for segment, window in ((1, 64), (7, 70), (64, 4096)):
        monkeypatch.setattr(automaton, "SEGMENT", segment)
        monkeypatch.setattr(automaton, "WINDOW", window)
        assert sorted(scanner.matches(text)) == want


def test_minimised_automaton_is_smaller_and_odd_rules_are_refused():
    assert len(automaton.compile_rules(["abc|xbc"]).matched) == 4  # after a or x, after b, after c
    for bad in ("a", "ab*|abbc", "a?", "(?:ab)+", "abcd|bc"):
        with pytest.raises(ValueError):
            automaton.compile_rules([bad])


def test_scan_of_odd_documents(spark):
    long = "word " * 200_000 + "AKIA" + "Q" * 20
    rows = [(1, "é password: abcdefghijklmnop"), (1, "é password: abcdefghijklmnop"), (None, "token=" + "x" * 12), (2, None),
            (3, ""), (4, "token=short"), (5, long), (6, "secret=token:abcdefghijklmnop")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("spans", "kind")})
    got = secret_scan.with_digest(secret_scan.scan_documents(df)).collect()
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    assert len(got) == len(rows) and len(by[1]) == 2
    assert by[1][0]["spans"] == "assign:2:28" and by[None][0]["spans"] == "assign:0:18"
    assert by[5][0]["spans"] == f"access:{len(long) - 24}:{len(long)}" and by[5][0]["n_access"] == 1
    for doc in (2, 3, 4, 6):
        assert by[doc][0]["spans"] == "" and by[doc][0]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert secret_scan.scan_documents(df.limit(0)).collect() == []


# ---------------------------------------------------------------------- lexical search

def ranked_by_hand(docs, items, k=10):
    def terms(text):
        return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    bags = [(d, Counter(terms(t))) for d, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n_docs, n_terms = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, b in bags for t in b)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(terms(t))
    out = []
    for item, own in wanted.items():
        scores = []
        for (d, bag), n in zip(bags, sizes):
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10**9 * bag[t] // (1000 * bag[t] + 8 * (10 + 90 * n * n_docs // n_terms)))
                        for t in own if bag[t])
            if score > 0:
                scores.append((-score, d is None, d))
        out += [(item, rank + 1, s[2], -s[0]) for rank, s in enumerate(sorted(scores, key=lambda s: s[:2] + (s[2] or 0,))[:k])]
    return sorted(out, key=str)


def test_search_against_brute_force(spark, monkeypatch):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(60)] + ["Été", "漢字", "a", "B2", "ÉTÉ"]
    texts = [" ".join(rng.choices(words, weights=[1 / (i + 1) for i in range(len(words))], k=rng.choice([1, 5, 40, 200])))
             for _ in range(300)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, texts[0]) for i in range(80)]  # copies
    docs += [(3, texts[3]), (None, texts[4]), (None, texts[4]), (2000, None), (2001, ""), (2002, "!?\n --"),
             (2003, "long w7 " * 200_000)]
    items = [(1, "w1 w50, W51"), (2, texts[0]), (2, "漢字 été"), (None, "w9 w10 B2"), (4, None), (5, "unseen"), (6, "w0!"), (7, "--")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumn("n", F.lit("x"))
    queries = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("x"))
    want = ranked_by_hand(docs, items)
    for block, piece in ((lexical_search.BLOCK_BYTES, lexical_search.PIECE_BYTES), (30, 50)):
        monkeypatch.setattr(lexical_search, "BLOCK_BYTES", block)
        monkeypatch.setattr(lexical_search, "PIECE_BYTES", piece)
        got = lexical_search.search(df, queries).select("item_id", "rank", "doc_id", "score").collect()
        assert sorted((tuple(r) for r in got), key=str) == want
    assert lexical_search.search(df.limit(0), queries).collect() == []
    assert lexical_search.search(df, queries.limit(0)).collect() == []


def test_tree_bounds_hold_and_prune():
    rng = np.random.default_rng(2)
    width, rows = 300, 3000
    topic = rng.integers(0, 4, rows)
    terms = [np.unique(rng.integers(0, 75, 12) * 4 + t) for t in topic]  # 4 topics with words of their own
    indptr = np.append(0, np.cumsum([len(t) for t in terms]))
    flat = np.concatenate(terms)
    values = rng.integers(1, 10**6, len(flat))
    ids = np.arange(rows).astype(object)
    tree = ball_tree.BallTree(ids, indptr, flat, values, width)
    dense = np.zeros((rows, width), np.int64)
    dense[np.repeat(np.arange(rows), np.diff(indptr)), flat] = values
    queries = np.where(rng.random((10, width)) < 0.05, rng.integers(0, 14000, (10, width)), 0)
    queries[0] = np.where(np.arange(width) % 4 == 3, 5000, 0)  # about one topic
    bounds = tree.bounds(queries.T.astype(float))
    for q in range(10):
        exact = dense @ queries[q]
        inside = exact[tree.ids.astype(int)]
        for level, bound in enumerate(bounds):
            begin = tree.first_row[:-1][::1 << (tree.depth - level)]
            assert (np.maximum.reduceat(inside, begin) <= bound[:, q]).all()
        best: list = []
        scored = tree.search(queries[q], bounds, q, 10, best)
        want = sorted(((int(s), -d) for d, s in enumerate(exact) if s > 0), reverse=True)[:10]
        assert sorted(best, reverse=True) == want
        if q == 0:
            assert scored <= (1 << tree.depth) // 2
