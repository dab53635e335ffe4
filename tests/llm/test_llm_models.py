"""Classifier, language identification, decontamination, URL filters: accuracy and brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from assetlens.llm import decontamination, language_id, quality, queries, url_filter
from assetlens.llm.common import read_table
from conftest import SF_MID, SF_SMALL


def test_quality_on_held_out_documents(spark):
    labels = {r["doc_id"]: r["quality"] for r in read_table(spark, SF_MID, "labels").collect()}
    got = queries.QUERIES["op3_rule_ensemble_quality"](spark, SF_MID).collect()
    assert len(got) == read_table(spark, SF_MID, "documents").count()
    held = [r for r in got if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) >= 0.95
    good = [r for r in held if labels[r["doc_id"]] == 1]
    assert np.mean([r["predicted"] for r in good]) >= 0.98
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in got)


def test_rules_compile_to_the_sum_they_stand_for(spark):
    model = quality.RuleEnsemble(-0.5, ((( ("upper", ">", 0.1), ("lines", "<=", 0.2)), 2.0), ((("digits", "<=", 0.0),), -1.0)))
    docs = spark.createDataFrame([("ABC def",), ("abc 1",), ("",)], "text string")
    stats = quality.text_stats(F.col("text"))
    got = [r[0] for r in docs.select(model.score(stats)).collect()]
    want = [1 / (1 + np.exp(-z)) for z in (-0.5 + 2 - 1, -0.5, -0.5 - 1)]
    assert np.allclose(got, want)


def test_stats_of_a_text(spark):
    row = spark.createDataFrame([(" Aa bb\nbb&& 12. ",)], "text string").select(
        *[c.alias(n) for n, c in quality.text_stats(F.col("text")).items()]).first()
    assert row["distinct_words"] == 1.0 and row["chars_per_word"] == 16 / 4
    assert row["upper"] == 1 / 16 and row["digits"] == 2 / 16 and row["stops"] == 1 / 16
    assert row["symbols"] == 2 / 16 and row["symbol_runs"] == 1 / 16 and row["lines"] == 1 / 16


def test_labels_of_held_out_rows_are_not_learned(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    labels = read_table(spark, SF_SMALL, "labels")
    from assetlens.llm.common import held_out
    flipped = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (sorted((r["doc_id"], r["score"]) for r in quality.score_documents(docs, x).collect())
                for x in (labels, flipped))
    assert one == two


def test_language_on_held_out_documents(spark):
    langs = {r["doc_id"]: r["lang"] for r in read_table(spark, SF_MID, "documents").select("doc_id", "lang").collect()}
    held = [r for r in queries.QUERIES["op8_cross_parsing_language"](spark, SF_MID).collect() if r["held_out"]]
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in held]) >= 0.98


def naive_phrases(text, training):
    """Greedy longest matches; a symbol that the training text lacks is a phrase."""
    s, t = bytes(language_id.symbols_of(text)), bytes(training)
    phrases = 0
    for begin in range(0, len(s), language_id.STRETCH):
        part, i = s[begin:begin + language_id.STRETCH], 0
        while i < len(part):
            n = 1
            while i + n < len(part) and part[i:i + n + 1] in t:
                n += 1
            phrases += 1
            i += n
    return phrases


def test_cross_parsing_against_longest_matches(monkeypatch):
    monkeypatch.setattr(language_id, "STRETCH", 64)
    rng = random.Random(4)
    texts = {"x": ["".join(rng.choices("abc d", k=700)), "漢字é"], "y": ["".join(rng.choices("bcde ", k=500))]}
    model = language_id.CrossParser(texts)
    asked = ["", "...", "abcq", "Z z z", "漢é漢字 字", "é b漢c"] + ["".join(rng.choices("abcdez .", k=rng.randint(1, 300))) for _ in range(40)]
    cost, sizes = model.costs(asked)
    for i, text in enumerate(asked):
        if not sizes[i]:
            continue
        for k, lang in enumerate(model.languages):
            want = naive_phrases(text, language_id.sampled(texts[lang], 10**6))
            got = cost[k, i] * sizes[i] / model.scale[k]
            assert abs(got - want) < 1e-6, (text, got, want)


def test_suffix_automaton_accepts_exactly_the_substrings():
    text = [0, 1, 0, 0, 1, 2, 0, 1]
    following = language_id.suffix_automaton(text)
    place, owner, after = language_id.displaced(following)
    assert len(set(place.tolist())) == len(following) and place[0] == 0
    subs = {tuple(text[i:j]) for i in range(8) for j in range(i, 9)}
    for n in range(1, 5):
        for code in range(3 ** n):
            word = tuple(code // 3 ** k % 3 for k in range(n))
            state = 0
            for c in word:
                state = after[state + c] if state >= 0 and owner[state + c] == state else -1
            assert (state >= 0) == (word in subs)


def test_sample_is_spread_over_all_texts():
    texts = ["a" * 5000, "b" * 10, "c" * 3000, "...", "d" * 100]
    got = bytes(language_id.sampled(texts, 1000)).decode()
    assert [got.count(c) for c in "abcd"] == [445, 10, 445, 100]
    assert len(language_id.sampled([], 10)) == 0


def test_many_languages_with_letters_of_their_own(spark):
    """Twenty languages of 300 letters each, beside four Latin ones that make up most of the rows."""
    rng = random.Random(12)
    letters = {f"cjk{k}": [chr(0x4E00 + 300 * k + i) for i in range(300)] for k in range(20)}
    letters |= {f"lat{k}": [a + b for a in "bcdfgh"[k:k + 3] for b in "aeiou"] for k in range(4)}
    texts = [(lang, "".join(rng.choices(own, k=400))) for lang, own in letters.items()
             for _ in range(30 if lang.startswith("cjk") else 90)]
    rng.shuffle(texts)
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(texts)], "doc_id long, text string, lang string")
    model = language_id.fit(docs)
    assert model.owner.nbytes + model.after.nbytes < 24 * 40 * language_id.TRAINING_SYMBOLS
    for n, least in ((10, 0.8), (60, 0.95)):
        asked = [(lang, "".join(rng.choices(own, k=n))) for lang, own in letters.items() if lang.startswith("cjk") for _ in range(20)]
        guessed, _ = model.predict([t for _, t in asked])
        assert np.mean([g == lang for g, (lang, _) in zip(guessed, asked)]) >= least


def naive_tiles(text, item, least):
    """Greedy string tiling by trying every pair of places."""
    free_t, free_i, tiles = [True] * len(text), [True] * len(item), []
    while True:
        best = (0, 0, 0)
        for t in range(len(text)):
            for i in range(len(item)):
                n = 0
                while (t + n < len(text) and i + n < len(item) and text[t + n] == item[i + n] >= 0
                       and free_t[t + n] and free_i[i + n]):
                    n += 1
                if n > best[0]:
                    best = (n, t, i)
        n, t, i = best
        if n < least:
            return tiles
        tiles.append((t, i, n))
        free_t[t:t + n] = [False] * n
        free_i[i:i + n] = [False] * n


def test_tiling_covers_as_much_as_the_naive_form():
    rng = random.Random(8)
    same = 0
    for _ in range(150):
        item = [rng.randint(0, 12) for _ in range(rng.randint(3, 30))]
        text = []
        for _ in range(rng.randint(1, 5)):
            a = rng.randint(0, len(item) - 1)
            text += item[a:a + rng.randint(1, 20)] + [rng.randint(-1, 12) for _ in range(rng.randint(0, 4))]
        got = decontamination.tile(text, item, 3)
        for t, i, n in got:
            assert text[t:t + n] == item[i:i + n] and n >= 3
        for side in (0, 1):
            used = [p for tile in got for p in range(tile[side], tile[side] + tile[2])]
            assert len(used) == len(set(used))
        want = naive_tiles(text, item, 3)
        assert got[:1] == [] == want or max(x[2] for x in got) == want[0][2]  # the longest first
        same += sum(x[2] for x in got) == sum(x[2] for x in want)
    assert same >= 140  # ties may be broken another way


def test_reordered_and_reformatted_passages_are_caught(spark):
    words = [f"w{i}" for i in range(40)]
    item = " ".join(words)
    reordered = " ".join(words[20:] + ["between"] + words[:20])
    loud = " ".join(words).upper().replace(" ", ", ")
    half = " ".join(words[:15])
    filler = " ".join(f"x{i}" for i in range(300))
    docs = spark.createDataFrame([(1, f"{filler} {reordered} {filler}"), (2, loud), (3, half), (4, filler),
                                  (5, f"{filler} {item}")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (8, "never seen anywhere in these few texts at all")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["coverage"] for r in decontamination.contaminations(docs, bench).collect()}
    assert set(found) == {(1, 7), (2, 7), (5, 7)} and min(found.values()) == 1.0


def test_rolled_hashes_are_those_of_the_runs():
    rng = random.Random(2)
    words = [rng.randint(-1, 3) for _ in range(200)]
    free = [rng.random() < 0.95 for _ in words]
    for length in (1, 2, 5, 9):
        rolled = dict(decontamination.run_hashes(words, free, length))
        runs = {i: tuple(words[i:i + length]) for i in range(len(words) - length + 1)
                if all(free[i:i + length]) and min(words[i:i + length]) >= 0}
        assert rolled.keys() == runs.keys()
        assert len(set(rolled.values())) == len(set(runs.values())) == len(set(zip(rolled.values(), runs.values())))
        ids = np.array([w + 1 for w in words], np.int64)
        hashed, plain = decontamination.rolling(ids, length).tolist(), [tuple(ids[i:i + length]) for i in range(len(ids) - length + 1)]
        assert len(set(hashed)) == len(set(plain)) == len(set(zip(hashed, plain)))


def test_colliding_hashes_are_verified(monkeypatch):
    monkeypatch.setattr(decontamination, "PRIME", 3)
    text, item = [7, 1, 2, 3, 4, 9, 5, 6, 7], [1, 2, 3, 4, 5, 6, 7]
    assert sorted(decontamination.tile(text, item, 3)) == [(1, 0, 4), (6, 4, 3)]


def test_short_items_in_another_order(spark):
    bench = spark.createDataFrame([(1, "red fox jumps over lazy dogs"), (2, "one two three four five six seven eight nine")],
                                  "item_id long, text string")
    filler = " ".join(f"x{i}" for i in range(60))
    docs = spark.createDataFrame([
        (1, f"{filler} over lazy dogs red fox jumps {filler}"), (2, f"six seven eight nine, one two three four five {filler}"),
        (3, f"red fox jumps {filler} over lazy dogs"), (4, "red fox jumps over lazy cats"), (5, f"one two three {filler} seven eight nine")],
        "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminations(docs, bench).collect()}
    assert found == {(1, 1), (2, 2)}


def test_short_items_leave_clean_documents(spark):
    bench = spark.createDataFrame([(1, "paris"), (2, "what is the capital city of france today"), (3, "北京是中国的首都城市")],
                                  "item_id long, text string")
    docs = spark.createDataFrame([
        (1, "We went to Paris in spring."), (2, "He asked: what is the capital city of Norway?"),
        (3, "A question. What is the capital city of France, today?"), (4, "The answer:\nParis\nwas right"),
        (5, "我们知道北京是中国的首都城市没有错"), (6, "我们知道上海不是中国的首都")], "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminations(docs, bench).collect()}
    assert found == {(3, 2), (4, 1), (5, 3)}


def test_blocks_hold_every_item(spark, monkeypatch):
    docs, bench = (read_table(spark, SF_SMALL, t) for t in ("documents", "benchmark"))
    whole = sorted((r["doc_id"], r["item_id"], r["coverage"]) for r in decontamination.contaminations(docs, bench).collect())
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 3000)
    blocks = sorted((r["doc_id"], r["item_id"], r["coverage"]) for r in decontamination.contaminations(docs, bench).collect())
    assert whole and blocks == whole


def test_verbatim_benchmark_texts_are_all_found(spark):
    docs, bench = (read_table(spark, SF_MID, t).collect() for t in ("documents", "benchmark"))
    want = {(d["doc_id"], b["item_id"]) for d in docs for b in bench if b["text"] in (d["text"] or "")}
    got = {(r["doc_id"], r["item_id"]) for r in queries.QUERIES["op7_tiling_decontamination"](spark, SF_MID).collect()}
    assert want and want <= got


def test_url_filter_against_replay(spark):
    rng = random.Random(6)
    urls = ["http://a.x.com/p/1", "https://x.com", "http://b.a.x.com/q?z=1", "HTTP://Y.org/p", "notaurl", None, "http://y.org:80/p/2"]
    captures = [(i, rng.choice(urls), rng.randint(0, 200)) for i in range(300)]
    patterns = ["x.com", "a.x.com", "y.org", "y.org/p", "a.x.com/p", "com"]
    entries = [(rng.choice(["l1", "l2"]), rng.choice(patterns), rng.choice(["add", "remove"]), rng.randint(0, 220))
               for _ in range(80)] + [("l1", "x.com", "add", None), (None, "x.com", "add", 1)]
    got = {r["page_id"]: (r["blocked"], r["matches"], r["pattern"]) for r in url_filter.evaluate(
        spark.createDataFrame(captures, "page_id long, url string, day int"),
        spark.createDataFrame(entries, "list_name string, pattern string, action string, day int")).collect()}
    keys = {"http://a.x.com/p/1": ["a.x.com", "x.com", "a.x.com/p"], "https://x.com": ["x.com"],
            "http://b.a.x.com/q?z=1": ["b.a.x.com", "a.x.com", "x.com", "b.a.x.com/q"], "HTTP://Y.org/p": ["y.org", "y.org/p"],
            "http://y.org:80/p/2": ["y.org", "y.org/p"]}
    for page, url, day in captures:
        met = set()
        for lst in ("l1", "l2"):
            for key in keys.get(url, []):
                past = [(d, a == "remove") for l, p, a, d in entries if l == lst and p == key and d is not None and d <= day]
                if past and not max(past)[1]:
                    met.add((lst, key))
        best = max(((len(k), k, l) for l, k in met), default=(0, None, None))
        assert got[page] == (bool(met), len(met), best[1]), (page, url, day)


def test_url_filter_normalises_patterns_and_urls(spark):
    urls = ["http://user:pw@Shop.example.org/a/b/c?x=1", "http://www.other.net./", "https://deep.example.com:8080/A/b/", "http://clean.org/a"]
    captures = spark.createDataFrame([(i, u, 5) for i, u in enumerate(urls)], "page_id long, url string, day int")
    def blocked(*patterns):
        entries = spark.createDataFrame([("l", p, "add", 1) for p in patterns], "list_name string, pattern string, action string, day int")
        return {r["page_id"] for r in url_filter.evaluate(captures, entries).collect() if r["blocked"]}
    assert blocked("shop.example.org/a/b", "Other.NET", "https://Deep.example.com/A/b/") == {0, 1, 2}
    assert blocked("http://shop.example.org/a/b/c?x=1", "user", "deep.example.com/A/bb", "shop.example.org/a/b/c?x=2") == {0}
    odd = spark.createDataFrame([("l", p, "add", 1) for p in ("*.example.org", "/only/path", None, "fine.org/x")],
                                "list_name string, pattern string, action string, day int")
    assert sorted(r["problem"] for r in url_filter.unsupported_entries(odd).collect()) \
        == ["null_field", "unsupported_pattern", "unsupported_pattern"]


def test_url_filter_without_entries(spark):
    captures = spark.createDataFrame([(1, "http://x.com", 3), (1, "http://x.com", 3), (None, None, None)],
                                     "page_id long, url string, day int")
    none = spark.createDataFrame([], "list_name string, pattern string, action string, day int")
    got = url_filter.evaluate(captures, none).collect()
    assert len(got) == 2 and not any(r["blocked"] for r in got)
    assert url_filter.evaluate(captures.limit(0), none).count() == 0
