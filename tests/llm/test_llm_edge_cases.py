"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing column names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from assetlens.llm import (decontamination, exact_dedup, language_id, packing, quality, queries, simhash_dedup,
                           substring_dedup, suffix_dedup, token_files, url_filter)
from assetlens.llm.common import keep_marked
from assetlens.session import materialize

CLASHING = ["keep_id", "digest", "text_key", "blob", "run", "fp", "kept", "held_out", "part", "label", "right_id",
            "right_key", "features", "node", "root", "bucket"]
WORDS = [f"word{i}" for i in range(40)]
LINE = " ".join(WORDS[:12])


def rows():
    long = " ".join(WORDS[i * 7 % 40] + str(i % 97) for i in range(60_000))
    texts = [(1, LINE), (2, LINE), (2, LINE), (2, "other text of id two"), (None, LINE), (None, None), (3, None), (4, ""),
             (5, "   \n\t "), (6, long), (7, long), (8, "ünïcödé ß 漢字 " * 5), (9, "a"), (10, "\x00\x01 bytes")]
    return [(d, t, "en" if i % 3 else None, None if i % 4 == 0 else "s", None) for i, (d, t) in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    base = spark.createDataFrame(rows(), "doc_id long, text string, lang string, source string, n_chars long")
    return materialize(base.select("*", *[F.lit("x").alias(c) for c in CLASHING]), "edge-docs")


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (6, 0, 0), (None, 1, 0), (3, None, None), (1, 1, 0)],
                                 "doc_id long, quality int, toxic int")


def test_exact_dedup(docs, none):
    got = [tuple(r) for r in exact_dedup.exact_duplicates(docs).collect()]
    assert len(got) == len(rows())
    by = {}
    for doc, keep, size, kept, sha in got:
        by.setdefault(sha, []).append((doc, keep, size, kept))
    line = [g for g in by.values() if len(g) == 4][0]
    assert sorted(map(str, line)) == sorted(map(str, [(1, 1, 4, True), (2, 1, 4, False), (2, 1, 4, False),
                                                      (None, 1, 4, False)]))
    empty = [g for g in by.values() if {x[0] for x in g} == {None, 3, 4}][0]
    assert {x[1] for x in empty} == {3}
    assert exact_dedup.exact_duplicates(none).count() == 0


def test_keep_marked_keeps_columns_and_one_of_equal_rows(spark, docs):
    report = materialize(exact_dedup.dedup_batch(docs, exact_dedup.new_index(spark)), "edge-report")
    kept = keep_marked(docs, report)
    assert kept.columns == docs.columns
    ids = sorted(str(r["doc_id"]) for r in kept.collect())
    assert ids == sorted(map(str, [1, 2, 3, 5, 6, 8, 9, 10]))
    twice = docs.filter("doc_id = 2").unionByName(docs.filter("doc_id = 2"))
    report = materialize(exact_dedup.dedup_batch(twice, exact_dedup.new_index(spark)), "edge-report")
    assert keep_marked(twice, report).count() == 2  # two texts, each on several rows


def test_simhash(docs, none):
    got = simhash_dedup.with_hex(simhash_dedup.near_duplicates(docs)).collect()
    assert len(got) == len(rows())
    zero = {r["doc_id"] for r in got if r["fingerprint"] == "0" * 16}
    assert zero == {None, 3, 4, 5}
    assert all(r["component_id"] == 3 for r in got if r["fingerprint"] == "0" * 16)
    assert {r["component_id"] for r in got if r["doc_id"] in (6, 7)} == {6}
    assert simhash_dedup.near_duplicates(none).count() == 0


def test_quality(docs, none, labels):
    got = quality.score_documents(docs, labels).collect()
    assert len(got) == len(rows()) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in quality.score_documents(docs, labels.limit(0)).collect()} == {0.5}
    one = quality.score_documents(docs, labels.filter("quality = 1")).collect()
    assert all(r["score"] > 0.99 for r in one) or all(r["score"] == 0.5 for r in one)
    assert quality.score_documents(none, labels).count() == 0
    assert quality.keep_accepted(docs, labels).columns == docs.columns


def test_suffix_dedup(docs, none):
    got = suffix_dedup.with_digest(suffix_dedup.remove_repeats(docs)).collect()
    assert len(got) == len(rows())
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[1][0]["n_removed"] == 0 and by[6][0]["n_removed"] == 0
    assert by[7][0]["n_removed"] == by[7][0]["n_bytes"] and by[7][0]["n_spans"] == 1
    assert sorted(r["n_removed"] for r in by[2]) == [0, len(LINE), len(LINE)]  # equal ids do not remove each other
    assert sorted(r["n_removed"] for r in by[None]) == [0, len(LINE)]
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_line_dedup(docs, none):
    got = {(r["doc_id"], r["first_doc_id"]) for r in substring_dedup.removed_spans(docs).collect()}
    assert got >= {(2, 1), (None, 1), (7, 6)} and not any(d == 1 or d == 6 for d, _ in got)
    removed = materialize(substring_dedup.removed_spans(docs), "edge-removed")
    clean = substring_dedup.cleaned(docs, removed)
    assert clean.columns == docs.columns and clean.count() == len(rows())
    texts = {(r["doc_id"], r["text"]) for r in clean.collect()}
    assert (7, "") in texts and (3, None) in texts and (2, "other text of id two") in texts
    assert substring_dedup.removed_spans(none).count() == 0


def test_tokens_and_packing(docs, none):
    shards = token_files.write_token_files(docs, queries.WORD_BPE, queries.WORD_BPE_SIZE)
    back = token_files.read_token_files(shards).collect()
    assert len(back) == len(rows())
    assert {r["n_tokens"] for r in back if r["doc_id"] in (3, 4, 5)} == {1}
    assert token_files.read_token_files(
        token_files.write_token_files(none, queries.WORD_BPE, queries.WORD_BPE_SIZE)).count() == 0
    pieces = packing.with_digest(packing.pack_documents(docs, queries.BYTE_BPE)).collect()
    assert sum(r["length"] for r in pieces if r["doc_id"] == 4) == 1
    assert packing.pack_documents(none, queries.BYTE_BPE).count() == 0


def test_language(docs, none):
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(docs, language_id.fit(docs)).collect()}
    assert got[4] == got[5] == got[3] == "und" and got[1] == "en"
    nothing = language_id.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in language_id.identify(docs, nothing).collect()} == {"und"}
    assert language_id.identify(none, language_id.fit(none)).count() == 0


def test_decontamination(spark, docs, none):
    bench = spark.createDataFrame([(1, LINE), (2, None), (None, ""), (4, "a"), (5, LINE), (5, LINE)],
                                  "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminations(docs, bench).collect()}
    assert found >= {(1, 1), (2, 1), (None, 5), (9, 4)} and not any(d in (3, 4, 5) for d, _ in found)
    assert decontamination.contaminations(docs, bench.limit(0)).count() == 0
    assert decontamination.contaminations(none, bench).count() == 0


def test_pipeline_on_odd_and_empty_tables(spark, docs, none, labels, tmp_path):
    bench = spark.createDataFrame([(1, "not in any document at all here")], "item_id long, text string")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    for start in (docs, none):
        at = start
        for name, stage in corpus_pipeline.STAGES:
            at = materialize(stage(spark, at, str(tmp_path)), f"edge-{name}")
            if name != "packing":
                assert at.columns == docs.columns
        assert (at.count() == 0) == (start is none)


def test_url_filter(spark):
    """Very long urls, nulls, repeated rows and columns named as the operator's own."""
    deep = "http://long.org/" + "a/" * 40_000 + "end"
    wide = "http://" + "x." * 20_000 + "wide.org/a"
    captures = spark.createDataFrame([(1, deep, 5), (2, wide, 5), (3, "http://long.org/b", 5), (3, "http://long.org/b", 5),
                                      (None, None, None), (4, "", 5), (5, deep, None)], "page_id long, url string, day int")
    entries = spark.createDataFrame([("l", "long.org/a/a", "add", 1), ("l", "wide.org", "add", 1), ("l", "wide.org", "add", 1),
                                     (None, None, None, None)], "list_name string, pattern string, action string, day int")
    clashing = ("key", "bucket", "b", "best", "matches", "blocked", "valid_from", "valid_to")
    got = url_filter.evaluate(captures.select("*", *[F.lit("x").alias(c) for c in clashing]),
                              entries.select("*", *[F.lit("x").alias(c) for c in ("bucket", "removed", "valid_to", "url")]))
    assert sorted((str(r["page_id"]), r["blocked"], r["pattern"]) for r in got.collect()) == [
        ("1", True, "long.org/a/a"), ("2", True, "wide.org"), ("3", False, None), ("4", False, None), ("5", False, None),
        ("None", False, None)]
