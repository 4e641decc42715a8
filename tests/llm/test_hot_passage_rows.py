"""A passage in every text: the rows of its places on the way back from the inner levels."""

import hashlib
import random
from collections import Counter

from lendspark.llm import substring_dedup


def _text(rnd, n):
    return "".join(rnd.choices("abcdefgh ", k=n))


def _kept(texts):
    gram, raw = substring_dedup.GRAM, [t.encode() for t in texts]
    times = Counter(r[i:i + gram] for r in raw for i in range(len(r) - gram + 1))
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - gram + 1):
            if times[r[i:i + gram]] > 1:
                gone[i:i + gram] = b"\1" * gram
        yield hashlib.sha256(bytes(c for c, g in zip(r, gone) if not g)).hexdigest()


def test_places_of_inner_levels_stay_one_row(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT_BYTES", 2000)
    plans, keep = [], substring_dedup.stored

    def stored(df, name):
        if name == "ranges":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return keep(df, name)

    monkeypatch.setattr(substring_dedup, "stored", stored)
    rnd = random.Random(3)
    passage = _text(rnd, 260)
    texts = [_text(rnd, 150) + passage + _text(rnd, 150) for _ in range(40)]
    # a gap in the passage: two ranges under one content
    texts += [_text(rnd, 150) + passage[:230] + "#" + passage[20:] + _text(rnd, 150) for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["kept_sha256"] for r in substring_dedup.repeated_substrings(docs).collect()}
    assert got == dict(enumerate(_kept(texts)))
    assert len(plans) > 1  # the passage was split
    assert not any("Generate" in p for p in plans)  # what an inner level found is not opened into a row a range


def _inner_rows(spark, monkeypatch, texts):
    """Rows of the units inside hot keys; the result is compared with brute force."""
    rows, keep = [], substring_dedup.stored

    def stored(df, name):
        out = keep(df, name)
        if name == "units":
            rows.append(out.count())
        return out

    monkeypatch.setattr(substring_dedup, "stored", stored)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["kept_sha256"] for r in substring_dedup.repeated_substrings(docs).collect()}
    assert got == dict(enumerate(_kept(texts)))
    assert len(rows) > 1  # a key was hot
    return sum(rows[1:])


def test_periodic_contents_are_not_split_into_their_windows(spark, monkeypatch):
    # the windows of a line repeated for long are the same few: they made a row each, in each text
    monkeypatch.setattr(substring_dedup, "HOT_BYTES", 2000)
    rnd = random.Random(5)
    line = _text(rnd, 60)
    texts = [_text(rnd, 150) + line * (8 + k) + _text(rnd, 150) for k in range(30)]
    assert _inner_rows(spark, monkeypatch, texts) < 20 * len(texts)


def test_surroundings_of_a_passage_are_not_split(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT_BYTES", 4000)
    rnd = random.Random(6)
    passage = _text(rnd, 400)
    texts = [_text(rnd, 200) + passage + _text(rnd, 200) for _ in range(60)]
    texts += [t[:300 + k] + "#" + t[301 + k:] for k, t in enumerate(texts[:20])]  # near copies
    texts += [passage[:250] * 3 + _text(rnd, 30), passage[100:], "", passage]
    assert _inner_rows(spark, monkeypatch, texts) < 30 * len(texts)
