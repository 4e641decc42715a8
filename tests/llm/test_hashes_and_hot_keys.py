"""Strings that collide under weak hashes, long words, hot passages, clashing names."""

import hashlib
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lendspark.llm import common, features, mixing, near_dedup, quality_rules, substring_dedup


def _thue_morse(n, zero="a", one="b"):
    return "".join(one if bin(i).count("1") & 1 else zero for i in range(n))


A, B = _thue_morse(4096), _thue_morse(4096, "b", "a")


def test_doubled_strings_have_different_hashes():
    raw = (A + B).encode()
    data = np.frombuffer(raw, np.uint8)
    for size in (2, 64, 1024, 2048, 4096):
        start = np.arange(0, len(raw), size)
        h = common.span_hashes(data, start, start + size)
        pieces = [raw[s:s + size] for s in start]
        assert len(set(h.tolist())) == len(set(pieces)) and len(set(zip(h.tolist(), pieces))) == len(set(pieces))


def test_span_hashes_of_long_buffers_agree_with_short_ones():
    r = np.random.default_rng(1)
    data = r.integers(0, 256, (1 << 24) + 5000, np.uint8)
    start = r.integers(0, len(data) - 300, 50)
    far = common.span_hashes(data, start, start + 300)
    near = np.concatenate([common.span_hashes(data[s:s + 300], np.array([0]), np.array([300])) for s in start.tolist()])
    assert far.tolist() == near.tolist()


def test_different_lines_are_no_duplicates(spark):
    texts = [A + "\n" + B, A + "\n" + A + "\n \n \n" + B, "x y\nx y\r\nx y", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_dup_lines for r in quality_rules.quality_rules(docs).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 3: 0, 4: 0}  # "x y\r" differs from "x y"


def test_texts_of_colliding_words_are_not_linked(spark):
    docs = spark.createDataFrame([(1, " ".join([A, "p", "q", "r", "s"])), (2, " ".join([B, "p", "q", "r", "s"]))], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs).collect()} == {1: 1, 2: 2}


def _removed(texts, gram):
    """Bytes kept of each text when every gram that starts twice goes."""
    raw = [(t or "").encode() for t in texts]
    count = Counter(t[i:i + gram] for t in raw for i in range(len(t) - gram + 1))
    out = []
    for t in raw:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - gram + 1):
            if count[t[i:i + gram]] > 1:
                gone[i:i + gram] = True
        out.append(hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest())
    return out


@pytest.mark.parametrize("hot", [500, 1 << 19])
def test_hot_passage_gives_one_row_a_place(spark, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT_BYTES", hot)
    r = np.random.default_rng(3)
    words = lambda n: " ".join("".join(r.choice(list("abcdefgh"), r.integers(2, 8))) for _ in range(n))
    passage = words(110)[:600]
    texts = [words(60) + " " + passage[:int(r.integers(150, 600))] + " " + words(40) for _ in range(60)]
    texts += [passage, passage + "!", A[:700], B[:700], A[:700] + B[:300], "z" * 900, "y" * 200, None, "", passage]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {x.doc_id: x.kept_sha256 for x in substring_dedup.repeated_substrings(docs).collect()}
    assert [got[i] for i in range(len(texts))] == _removed(texts, 200)


def test_windows_sorted_or_not_are_the_same():
    r = np.random.default_rng(5)
    for _ in range(30):
        base = bytes(r.integers(97, 100, 900, np.uint8))
        texts = [base[int(r.integers(0, 400)):int(r.integers(500, 900))] + bytes(r.integers(97, 123, int(r.integers(0, 500)), np.uint8)) for _ in range(6)]
        weights = r.integers(1, 3, 6).tolist()
        texts[3] = texts[2][:150]
        count = Counter()
        for t, w in zip(texts, weights):
            for i in range(len(t) - 199):
                count[t[i:i + 200]] += w
        expected = {(d, i) for d, t in enumerate(texts) for i in range(len(t) - 199) if count[t[i:i + 200]] > 1}
        found = substring_dedup.repeated_windows(texts, weights)
        assert {(d, i) for d, a, b in found for i in range(a, b)} == expected
        assert all(x[0] != y[0] or x[2] < y[1] for x, y in zip(found, found[1:]))
    assert substring_dedup.repeated_windows([], []) == [] and substring_dedup.repeated_windows([b""], [3]) == []


def test_long_words_are_hashed_in_linear_time():
    short = features.Points(["ab " * 10, "a" * 64, "b" * 65, "a" * 70 + " " + "a" * 70])
    h = short.words()
    value, slow = short.value, []
    for s, e in zip(short.start.tolist(), short.end.tolist()):
        total = np.zeros(1, common.U64)
        for k in range(s, e):
            total = total * common.ODD[1] + value[k]
        slow.append(int(common.mix(total)[0]))
    assert h.tolist() == slow
    text = "ab cd " * 75_000 + "x" * 1_000_000
    p, t = features.Points([text]), time.time()
    p.words()
    assert time.time() - t < 2


def test_pipeline_stages_take_clashing_names(spark):
    docs = spark.createDataFrame([(i, f"word{i} some more words here {i}", "s", "gone?", 1, "d") for i in range(6)],
                                 "doc_id long, text string, source string, gone string, __copy int, d string")
    for stage in (corpus_pipeline.exact, corpus_pipeline.near, corpus_pipeline.mix):
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and out.agg(F.max("__copy"), F.min("gone")).first() == (1, "gone?")
    assert corpus_pipeline.rules(spark, docs, "").columns == docs.columns


def test_pipeline_on_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").collect() == []


def test_too_many_sources_are_refused(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_SOURCES", 3)
    docs = spark.range(5).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.col("id").cast("string").alias("source"))
    assert mixing.mix_sources(docs.where("doc_id < 3")).count() == 3
    with pytest.raises(Exception, match="too many sources"):
        mixing.mix_sources(docs).collect()


def test_parity_maps_never_differ_more_than_the_sets():
    r = np.random.default_rng(2)
    for _ in range(50):
        pool = r.integers(0, 2**63, 900, dtype=np.uint64)
        a, b = pool[:int(r.integers(1, 800))], pool[int(r.integers(0, 700)):]
        maps = near_dedup.parity_maps(np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), 3)
        bits = sum(bin(int(x) & 2**64 - 1).count("1") for x in maps[0] ^ maps[1])
        assert bits <= len(set(a.tolist()) ^ set(b.tolist())) and not maps[2].any()


def test_unlinked_look_alikes_make_few_candidates(spark):
    """Pages of 20 blocks with two choices each, any two pages two blocks apart
    or more: they share bands and rare shingles, but no pair is a link."""
    r = np.random.default_rng(6)
    block = [[" ".join("".join(r.choice(list("abcdefghijkl"), 6)) for _ in range(18)) for _ in range(2)] for _ in range(20)]
    for n in (200, 800):
        choice = r.integers(0, 2, (4 * n, 20))
        choice[:, 19] = choice[:, :19].sum(1) % 2  # even weight: two of them differ in an even number of blocks
        choice = np.unique(choice, axis=0)[:n]
        texts = [" ".join(block[k][x] for k, x in enumerate(c)) for c in choice.tolist()]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
        sets = docs.mapInArrow(near_dedup._sets, "doc_id long, shingles array<long>, map array<long>").cache()
        open_ = docs.select(F.col("doc_id").alias("cid"), F.col("doc_id").alias("component"))
        assert near_dedup._prefix_pairs(open_, sets, 85).count() <= n
        assert near_dedup.near_duplicates(docs).where("kept").count() == len(texts) == n
