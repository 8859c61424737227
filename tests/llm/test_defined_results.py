"""Nulls, empty and long texts, ties, repeated rows, empty tables, extra columns of clashing names."""

import os
import sys

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tabforge.llm import language, licenses, line_rules, mixing, near_dups, pieces, substrings, topk, toxicity, urls, words
from tabforge.llm.queries import TOKENIZER

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, score int, kept int, _id int, _text string, _key int, v int, band int"
PROSE = " ".join(f"word{i}" for i in range(120))
ROWS = [(1, PROSE, "en", "a"), (2, PROSE, "en", "a"), (2, PROSE, "en", "a"), (3, None, None, None), (4, "", "de", "b"),
        (None, PROSE + " tail", "en", None), (5, " \n\t ", "de", "b"), (6, "x " * 60_000 + "end", "de", "b"), (7, "1234 %%%", "de", "c")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, 0, 9, 9, 9, 9, "z", 9, 9, 9) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def test_near_duplicates(odd, none):
    got = near_dups.near_duplicates(odd).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append((r["class_id"], r["class_size"]))
    assert len(got) == len(ROWS) and by[1] == [(1, 4)] and by[2] == [(1, 4)] * 2 and by[None] == [(1, 4)]
    assert by[3] == [(3, 1)] and by[4] == [(4, 1)] and by[6] == [(6, 1)]
    assert sorted(str(r["doc_id"]) for r in near_dups.keep_first(odd).collect()) == ["1", "3", "4", "5", "6", "7"]
    assert near_dups.near_duplicates(none).count() == 0


def test_substrings(odd, none):
    got = {}
    for r in substrings.dedup_substrings(odd, cells_log2=16).collect():
        got.setdefault(r["doc_id"], []).append((r["n_words"], r["n_removed"]))
    assert got == {1: [(120, 0)], 2: [(120, 120)] * 2, 3: [(0, 0)], 4: [(0, 0)], None: [(121, 0)], 5: [(0, 0)], 6: [(60_001, 0)], 7: [(2, 0)]}
    assert substrings.dedup_substrings(none, cells_log2=16).count() == 0


def test_saturated_sketch_loses_nothing(spark, odd):
    few = {(r["doc_id"], r["n_removed"]) for r in substrings.dedup_substrings(odd, cells_log2=6).collect()}
    assert (2, 120) in few and (1, 0) in few


def test_mixing(odd, none):
    got = mixing.mix_sources(odd).collect()
    assert len(got) == len(ROWS) and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    taken = {}
    for r in got:
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert all(abs(taken[r["source"]] - r["target"]) <= 1 for r in got)
    assert mixing.mix_sources(none).count() == 0


def test_language(odd, none):
    model = language.train(odd, per_class=10)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(odd.drop("score"), model).collect()}
    assert got[3] == got[4] == got[5] == ("und", 0.0) and got[1][0] == "en" and got[6][0] == "de"
    assert {r["lang_pred"] for r in language.predict(odd.drop("score"), language.train(none)).collect()} == {"und"}
    assert language.predict(none.drop("score"), model).count() == 0


def test_toxicity(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (6, 0), (None, 1), (1, 0)], "doc_id long, toxic int")
    model = toxicity.train(odd, labels, epochs=2, min_df=1)
    got = [r["score"] for r in toxicity.score(odd.drop("score"), model).collect()]
    assert len(got) == len(ROWS) and all(0 <= s <= 1 for s in got)
    assert toxicity.score(none.drop("score"), toxicity.train(none, labels)).count() == 0


def test_quality(odd, none):
    got = {r["doc_id"]: r for r in line_rules.judge_quality(odd).collect()}
    assert not got[3]["kept"] and got[3]["cleaned"] == "" and got[1]["kept"] and not got[6]["kept"]
    assert got[6]["n_repeat_words"] == 60_000
    assert line_rules.judge_quality(none).count() == 0


def test_pieces(odd, none):
    lib = sentencepiece.SentencePieceProcessor(model_file=TOKENIZER)
    for r in pieces.encode(odd.select("doc_id", "text"), TOKENIZER, decoded=True, keep=["text"]).collect():
        assert r["ids"] == lib.encode(r["text"] or "", add_eos=True) and r["decoded"] == lib.decode(r["ids"])
        assert len(r["begins"]) == len(r["ends"]) == len(r["ids"])
    assert pieces.encode(none, TOKENIZER).count() == 0


_coder = pieces.PieceCoder(open(TOKENIZER, "rb").read())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t▁ab<s>é日😀."), st.characters(blacklist_categories=["Cs"])), max_size=60))
def test_pieces_equal_the_library(text):
    want = _coder.lib.encode(text)
    ids = _coder.ids(text)
    assert ids.tolist() == want
    begin, end = _coder.spans(text, ids)
    raw = text.encode()
    assert b"".join(raw[b:e] for b, e in zip(begin, end, strict=True)) == raw


def test_character_map_takes_the_longest_key():
    found = pieces.CharacterMap(b"")
    assert found.longest(b"abc", 0) is None


def test_licenses(odd, none, spark):
    texts = spark.createDataFrame([(1, "x.\nReleased under the MIT License."), (1, "x.\nReleased under the MIT License."),
                                   (2, "All rights reserved"), (3, None), (4, "released under the"), (None, "Licensed under CC BY-NC 4.0")],
                                  "doc_id long, text string")
    got = {(r["doc_id"], r["license"]) for r in licenses.scan_licenses(texts).collect()}
    assert got == {(1, "MIT"), (2, "Proprietary"), (None, "CC-BY-NC-4.0")}
    assert licenses.scan_licenses(none).count() == 0 and licenses.scan_licenses(odd).count() == 0


def test_urls(spark):
    rules = [urls.Rule("block", "net/es/", True), urls.Rule("allow", "com/", True), urls.Rule("block", "||ads.*/x^"), urls.Rule("block", "*")]
    pages = spark.createDataFrame([(1, "http://A.Net/es/1"), (1, "http://A.Net/es/1"), (2, None), (3, "no host"), (None, "http://x.com/"),
                                   (4, "http://ads.org/q/x?y"), (5, "HTTP://x.com")], "page_id long, url string")
    got = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.filter_urls(pages, rules[:3]).collect()]
    assert got == [(1, "a.net", "/es/1", "net/es/", "block")] * 2 + [(2, "", "", None, "allow"), (3, "", "", None, "allow"), (None, "x.com", "/", "com/", "allow"),
                                                                     (4, "ads.org", "/q/x", None, "block"), (5, "x.com", "", None, "allow")]
    assert {r["verdict"] for r in urls.filter_urls(pages.where("page_id = 3"), rules).collect()} == {"block"}
    assert urls.filter_urls(pages.limit(0), rules).count() == 0


def test_topk_ties_and_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (3, [1.0, 1.0]), (2, [1.0, 1.0]), (4, None), (5, [float("nan"), 1.0]), (6, [1.0, None]), (7, [1.0]), (8, [1e15, 1e15])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.search(df, df.where("vec_id % 100 = 0"), k=2, bins=4).orderBy("query_id", "rank").collect()]
    big = 1024 * 1024 * 10 ** 15
    assert got == [(0, 1, 8, min(big, 2 ** 63 - 1)), (0, 2, 2, 1024 * 1024), (100, 1, 8, min(big, 2 ** 63 - 1)), (100, 2, 2, 1024 * 1024)]
    assert topk.search(df.limit(0), df.limit(0)).count() == 0


def test_bag_signatures_are_unbiased():
    rng, agree, n = np.random.default_rng(1), [], 60
    for _ in range(n):
        e = rng.integers(0, 2 ** 63, 30).astype(np.uint64)
        a, b = rng.integers(1, 9, 30), rng.integers(1, 9, 30)
        s = near_dups.bag_signatures([(e, a), (e, b)])
        agree.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(agree)) < 0.03


def test_parity_never_exceeds_the_difference():
    rng = np.random.default_rng(3)
    for k in rng.integers(0, 60, 200):
        a = rng.integers(0, 70, 150).astype(np.uint64)  # repeats among them
        b = a.copy()
        b[:k] = rng.integers(0, 90, k)
        odd = [near_dups.parity(*np.unique(x, return_counts=True)) for x in (a, b)]
        places = int(np.unpackbits((odd[0] ^ odd[1]).view(np.uint8)).sum())
        assert places <= len(np.setxor1d(near_dups.numbered(a), near_dups.numbered(b)))


def test_words_match_bytes_split():
    text = "a  bé\x0bc\n　d ".encode()
    assert len(words.word_hashes(text)) == len(text.split())
    assert words.word_hashes(b"same same")[0] == words.word_hashes(b"same same")[1]


def test_pipeline_stages(spark, odd):
    import corpus_pipeline as cp

    docs = odd.select(cp.COLUMNS)
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, "").select(cp.COLUMNS)
        docs = spark.createDataFrame(docs.collect(), "doc_id long, text string, lang string, source string, n_chars long")
    last = cp.STAGES[-1][1](spark, docs, "").collect()
    assert {r["doc_id"] for r in last} <= {1, 6} and all(r["round_trip"] for r in last) and last
