"""Dedup operators against brute force."""

import hashlib
import itertools
import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assetlens.llm import exact_dedup, queries, simhash_dedup, substring_dedup, suffix_dedup
from assetlens.llm.components import components
from assetlens.llm.common import read_table
from assetlens.session import fresh_dir, materialize
from conftest import SF_SMALL
from oracle_compare import compare, duck
from assetlens.llm.oracle import ORACLE


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_its_sql(spark, key):
    ok, message = compare(queries.QUERIES[key](spark, SF_SMALL), duck(SF_SMALL), ORACLE[key])
    assert ok, message


def test_index_takes_a_second_batch(spark):
    index = exact_dedup.DigestIndex(spark, fresh_dir(spark, "index"), 4)
    def rows(xs):
        return spark.createDataFrame(xs, "doc_id long, text string")
    first = exact_dedup.dedup_batch(rows([(5, "a  b"), (6, "a b"), (7, "c")]), index).collect()
    assert {(r["doc_id"], r["keep_id"], r["kept"]) for r in first} == {(5, 5, True), (6, 5, False), (7, 7, True)}
    batch = rows([(1, "a\tb"), (2, "d"), (3, "d")])
    for _ in range(2):  # the second time the batch finds itself and gets the same answer
        again = exact_dedup.dedup_batch(batch, index).collect()
        assert {(r["doc_id"], r["keep_id"], r["kept"]) for r in again} == {(1, 5, False), (2, 2, True), (3, 2, False)}
        assert index.read().count() == 3
    reopened = exact_dedup.DigestIndex(spark, index.path, 4)
    assert reopened.read().count() == 3
    with pytest.raises(ValueError):
        exact_dedup.DigestIndex(spark, index.path, 8)


def test_index_is_written_anew_when_files_or_digests_pile_up(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MOST_FILES", 2)
    monkeypatch.setattr(exact_dedup, "LEAST_BUCKETS", 2)
    monkeypatch.setattr(exact_dedup, "BUCKET_DIGESTS", 10)
    index = exact_dedup.new_index(spark)
    def batch(ids):
        return spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string")
    for n in range(4):
        exact_dedup.dedup_batch(batch(range(8 * n, 8 * n + 8)), index)
        assert index.files() <= 2 * index.buckets and index.read().count() == 8 * n + 8
    assert index.generation == 1 and index.buckets == 3  # 24 digests at the rebuild
    exact_dedup.dedup_batch(batch(range(200)), index)
    assert index.generation == 2 and index.buckets == 20
    reopened = exact_dedup.DigestIndex(spark, index.path)
    assert (reopened.buckets, reopened.generation, reopened.read().count()) == (20, 2, 200)
    plan = reopened.unseen(batch([1]).select(F.unhex(F.sha2("text", 256)).alias("digest")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    again = exact_dedup.dedup_batch(batch([5, 300]).withColumn("doc_id", F.col("doc_id") + 1000), reopened).collect()
    assert {(r["doc_id"], r["keep_id"]) for r in again} == {(1005, 5), (1300, 1300)}
    # A rebuild that died before its settings were written counts for nothing, and the next one starts afresh.
    table = reopened._create_table(3, 20)
    reopened.read().write.insertInto(table)
    assert exact_dedup.DigestIndex(spark, index.path).generation == 2
    reopened.rebuild(5)
    assert (reopened.generation, reopened.files(), reopened.read().count()) == (3, 5, 201)


def test_a_throw_away_index_leaves_nothing_behind(spark):
    before = {t.name for t in spark.catalog.listTables()}
    docs = spark.createDataFrame([(1, "a"), (2, "a")], "doc_id long, text string")
    assert {(r["doc_id"], r["keep_id"]) for r in exact_dedup.exact_duplicates(docs).collect()} == {(1, 1), (2, 1)}
    assert {t.name for t in spark.catalog.listTables()} == before


def test_a_throw_away_index_has_a_file_a_bucket_however_many_partitions(spark, monkeypatch):
    wide, files = spark.newSession(), []
    wide.conf.set("spark.sql.shuffle.partitions", "70")
    monkeypatch.setattr(exact_dedup.DigestIndex, "discard", lambda index: files.append((index.files(), index.buckets, index.generation)))
    docs = wide.createDataFrame([(i, f"text {i}") for i in range(2000)], "doc_id long, text string")
    assert exact_dedup.dedup_once(docs).filter("kept").count() == 2000
    assert files == [(70, 70, 0)]


def test_index_side_of_the_join_is_not_shuffled(spark):
    index = exact_dedup.new_index(spark, 4)
    groups = spark.createDataFrame([(b"x", 1)], "digest binary, keep_id long")
    index.append(groups)
    plan = index.unseen(groups)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 1


def naive_fingerprint(text):
    words = text.encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))).split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash_against_all_pairs(spark):
    docs = [(r["doc_id"], r["text"]) for r in read_table(spark, SF_SMALL, "documents").collect()]
    fps = {d: naive_fingerprint(t or "") for d, t in docs}
    parent = {d: d for d in fps}
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(fps)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    got = queries.QUERIES["op2_simhash_anchor_dedup"](spark, SF_SMALL).collect()
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in got} == {
        (d, f"{fps[d]:016x}", find(d)) for d in ids}


@pytest.mark.parametrize("count", [100, 1 << 30])
def test_links_lose_no_pair(spark, count):
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(40)}
    for f in list(fps):
        for _ in range(8):
            g = f
            for b in rng.sample(range(64), rng.randint(1, 4)):
                g ^= 1 << b
            fps.add(g)
    fps |= {0, 1, 3, 7, (1 << 64) - 1, (1 << 63)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = {frozenset((r["a"], r["b"])) for r in
           simhash_dedup.links(spark.createDataFrame([(f,) for f in signed], "fp long"),
                               codes=simhash_dedup.codes_for(count)).collect()}
    want = {frozenset((a, b)) for a in signed for b in signed if a != b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    assert got == want


def test_anchor_rows_are_never_broadcast(spark):
    """Spark takes the anchors, 61 rows for a fingerprint, for as small as the fingerprints."""
    few = spark.range(1000).select(F.xxhash64("id").alias("fp"))
    plan = simhash_dedup.links(few)._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_golay_code_is_perfect_and_cover_is_complete():
    cover = simhash_dedup.Cover(simhash_dedup.GOLAY[0], 2)
    words = np.random.default_rng(1).integers(0, 1 << 23, 300)
    all_words = np.arange(1 << 23)
    code = all_words[(cover.low[all_words & 0xFFF] ^ cover.high[all_words >> 12]) == 0]
    assert len(code) == 1 << 12
    for w in words.tolist():
        away = np.bitwise_count(code ^ w)
        for beyond in range(3):
            anchors, real = cover.anchors(np.array([w]), beyond)
            want = code[away <= 3] if beyond == 0 else code[away == 3 + beyond]
            assert sorted(anchors[real].tolist()) == sorted(want.tolist())
        assert (away <= 3).sum() == 1


def test_anchors_grow_with_the_fingerprints():
    """Many fingerprints get a third code; what one of them reaches grows 2.5 times, the anchors 2,048 times."""
    few, many = simhash_dedup.codes_for(1 << 24), simhash_dedup.codes_for((1 << 24) + 1)
    fps = np.random.default_rng(2).integers(-(1 << 63), (1 << 63) - 1, 2000)
    reached, homes = [], []
    for codes in (few, many):
        covers = [simhash_dedup.Cover(code, 2) for code in codes]
        parts = [b for b in itertools.product(range(3), repeat=len(codes)) if sum(b) <= 2]
        reached.append(sum(len(simhash_dedup.anchors_of(fps, covers, b)[0]) for b in parts) / len(fps))
        anchor, row = simhash_dedup.anchors_of(fps, covers, (0,) * len(codes))
        assert row.tolist() == list(range(len(fps)))  # exactly one home
        homes.append(anchor)
    assert 59 < reached[0] < 63 and 148 < reached[1] < 158
    assert (homes[1] & (1 << 46) - 1 == homes[0]).all()


def test_components_of_chains_stars_and_cliques(spark):
    rng = random.Random(5)
    names = rng.sample(range(-10**12, 10**12), 300)
    edges = [(names[i], names[i + 1]) for i in range(99)]  # a chain
    edges += [(names[100], names[i]) for i in range(101, 200)]  # a star
    edges += [(names[i], names[j]) for i in range(200, 215) for j in range(200, 215) if i != j]  # a clique
    rng.shuffle(edges)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    for one in (names[:100], names[100:200], names[200:215]):
        assert {got[n] for n in one} == {min(one)}
    assert len(got) == 215


def brute_removed(docs, length=50):
    seen, out = {}, {}
    for d, t in docs:
        for i in range(len(t) - length + 1):
            w = t[i:i + length]
            seen[w] = min(seen.get(w, d), d)
    for k, (d, t) in enumerate(docs):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] < d:
                gone[i:i + length] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[k] = (d, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return sorted(out.values())


@pytest.mark.parametrize("hot_gram", [1 << 15, 12, 0])
def test_suffix_dedup_against_brute_force_on_small_alphabets(spark, monkeypatch, hot_gram):
    rng = random.Random(11)
    monkeypatch.setattr(suffix_dedup, "HOT_GRAM", hot_gram)
    shared = ["".join(rng.choices("ab ", k=rng.randint(30, 400))) for _ in range(12)]
    docs = []
    for d in range(150):
        parts = []
        for _ in range(rng.randint(1, 5)):
            s = rng.choice(shared)
            i = rng.randint(0, len(s) - 1)
            parts += [s[i:i + rng.randint(1, 400)], "".join(rng.choices("abcdé \n", k=rng.randint(0, 60)))]
        docs.append((rng.randint(0, 120), "".join(parts)))
    docs += [(200, "xyz" * 100), (201, "yzx" * 60), (202, "é" * 200), (203, "é" * 90), (204, "")]
    monkeypatch.setattr(suffix_dedup, "RUN_BYTES", 6_000)
    monkeypatch.setattr(suffix_dedup, "MAX_STREAMS", 3)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = sorted(tuple(r) for r in suffix_dedup.with_digest(suffix_dedup.remove_repeats(df)).collect())
    assert got == brute_removed([(d, t.encode()) for d, t in docs])


def test_suffix_query_against_brute_force(spark):
    docs = [(r["doc_id"], (r["text"] or "").encode()) for r in read_table(spark, SF_SMALL, "documents").collect()]
    got = sorted(tuple(r) for r in queries.QUERIES["op4_suffix_run_dedup"](spark, SF_SMALL).collect())
    assert got == brute_removed(docs)


def test_segments_of_a_run_lose_no_window(monkeypatch):
    rng = random.Random(2)
    texts = ["".join(rng.choices("abc", k=n)).encode() for n in (700, 0, 49, 50, 51, 333)]
    run = suffix_dedup.Run(suffix_dedup.Run.blob(list(range(6)), texts))
    for size in (1 << 20, 64, 100):
        monkeypatch.setattr(suffix_dedup, "SEGMENT_BYTES", size)
        windows = sorted(s for s1, s2, *_ in run.anchors(50) for a, b in zip(s1, s2) for s in range(a, b + 1))
        ends = np.cumsum([len(t) for t in texts])
        want = [s for b, e in zip([0, *ends], ends) for s in range(b, e - 49)]
        assert windows == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=9), max_size=9), min_size=1, max_size=7))
def test_loser_tree_merges_and_tracks_prefixes(lists):
    lists = [sorted({k + b"\x07" for k in keys}) for keys in lists]
    streams = [suffix_dedup.entries_of(suffix_dedup.front_coded(keys, [1] * len(keys), [0] * len(keys)), i)
               for i, keys in enumerate(lists) if keys]
    out = list(suffix_dedup.merge(streams)) if streams else []
    assert [e[1] for e in out] == sorted(k for keys in lists for k in keys)
    for (_, a, *_), (common, b, *_) in zip(out, out[1:]):
        n = min(len(a), len(b))
        assert common == next((i for i in range(n) if a[i] != b[i]), n)


def test_line_dedup_offsets_point_at_the_lines(spark):
    docs = {r["doc_id"]: r["text"] for r in read_table(spark, SF_SMALL, "documents").collect()}
    got = substring_dedup.removed_spans(read_table(spark, SF_SMALL, "documents")).collect()
    assert {r["kind"] for r in got} == {"line", "sentence"}
    for r in got:
        one = docs[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        first = docs[r["first_doc_id"]][r["first_start"]:]
        assert "\n" not in one and first.lower().split()[:len(one.split())] == one.lower().split()
        assert (r["first_doc_id"], r["first_start"]) < (r["doc_id"], r["start"])


def test_a_common_line_stays_once(spark):
    for line in ("one two three four five six", "one"):
        docs = spark.range(500).select(F.col("id").alias("doc_id"),
                                       F.concat(F.lit(line + "\nown "), F.col("id").cast("string")).alias("text"))
        removed = substring_dedup.removed_spans(docs)
        assert removed.count() == 499 and removed.filter("doc_id = 0").count() == 0


def test_a_passage_inside_other_lines_is_found(spark):
    passage = "and so it went on. The long passage was pasted here again. Nobody knew why it came back! It did so"
    docs = spark.createDataFrame([(1, f"first words of one {passage} and its end"), (2, f"others came {passage} to stop"),
                                  (3, "The clean text has nothing in common with those two. At all.")],
                                 "doc_id long, text string")
    removed = materialize(substring_dedup.removed_spans(docs), "passage")
    assert [r["doc_id"] for r in removed.orderBy("unit").collect()] == [2, 2]
    texts = {r["doc_id"]: r["text"] for r in substring_dedup.cleaned(docs, removed).collect()}
    assert texts[2] == "others came and so it went on. It did so to stop" and passage in texts[1]


def test_whole_lines_of_any_length_are_units(spark):
    many = "The and. So it is. At all. No one. Well then. Yes. It was so. Yes."
    docs = spark.createDataFrame([
        (1, f"short\n{many}\n今天天气很好我们去公园\nown one"),
        (2, f"own two\nShort \n{many}\n今天天气很好我们去公园\nlast"),
        (3, "先说别的。今天天气很好我们去公园。再说一句"), (4, "不同的。今天天气很好我们去公园。完"),
        (5, "Before it. One short. Tail\nnext"),
        (6, "Other words. One short.\nafter")], "doc_id long, text string")
    removed = materialize(substring_dedup.removed_spans(docs), "whole")
    got = {(r["doc_id"], r["kind"], r["first_doc_id"]) for r in removed.collect()}
    assert got == {(1, "sentence", 1), (2, "line", 1), (4, "sentence", 3), (6, "sentence", 5)}
    texts = {r["doc_id"]: r["text"] for r in substring_dedup.cleaned(docs, removed).collect()}
    assert texts[2] == "own two\nlast" and texts[4] == "不同的。完" and texts[6] == "Other words. \nafter"


def test_whole_line_query_leaves_no_line_twice(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    lines = [line for r in docs.collect() for line in (" ".join(x.lower().split()) for x in (r["text"] or "").split("\n")) if line]
    got = [r for r in queries.op1_line_dedup(spark, SF_SMALL).collect() if r["kind"] == "line"]
    assert len(got) == len(lines) - len(set(lines)) > 0
    assert any(len(line.split()) < 6 for line in lines if lines.count(line) > 1)


def test_merge_in_passes(monkeypatch):
    rng = random.Random(9)
    monkeypatch.setattr(suffix_dedup, "MAX_STREAMS", 3)
    lists = [sorted({bytes(rng.choices(b"abc", k=rng.randint(1, 12))) + b"\x01" for _ in range(30)}) for _ in range(20)]
    streams = [suffix_dedup.entries_of(suffix_dedup.front_coded(keys, [1] * len(keys), [0] * len(keys)), i)
               for i, keys in enumerate(lists)]
    out = list(suffix_dedup.merge(streams))
    assert [e[1] for e in out] == sorted(k for keys in lists for k in keys)
    for (_, a, *_), (common, b, *_) in zip(out, out[1:]):
        n = min(len(a), len(b))
        assert common == next((i for i in range(n) if a[i] != b[i]), n)
