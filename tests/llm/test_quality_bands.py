"""The compression bands of the quality rules: their rule, and texts that only they reject."""

import base64
import random
import zlib

import pytest

from lendspark.llm import common, quality_bands, quality_rules

SF = "/root/testdata/sf0.1"


def _words(seed, letters, n_bytes):
    r, out, size = random.Random(seed), [], 0
    while size < n_bytes:
        out.append("".join(r.choices(letters, k=r.randint(3, 9))))
        size += len(out[-1]) + 1
    return " ".join(out)


def _far(prose):
    """A long passage that comes again, far from its first place and in under half of the words."""
    return prose + " " + prose[:int(0.3 * len(prose))]


@pytest.fixture(scope="module")
def clean(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").select("doc_id")
    return common.documents(spark, SF).join(labels, "doc_id").cache()


def test_fit_is_that_of_the_labelled_clean_rows(spark):
    documents, chunk = quality_bands.fit_bands(common.documents(spark, SF).repartition(5), spark.read.parquet(f"{SF}/labels.parquet"))
    near = lambda a, b: all(abs(x - y) <= 1e-4 for x, y in zip(a, b))
    assert documents.keys() == quality_rules.DOCUMENT_FIT.keys() and near(chunk, quality_rules.CHUNK_FIT)
    assert all(near(documents[g], quality_rules.DOCUMENT_FIT[g]) for g in documents)


def test_fit_on_nothing(spark):
    docs = spark.createDataFrame([(1, None), (None, "x"), (2, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int")
    assert quality_bands.fit_bands(docs, labels) == ({}, None)


def test_bands_reject_what_passes_the_base_rules(spark, clean):
    prose = max((r["text"] for r in clean.where("length(text) between 9000 and 16000").collect()), key=lambda t: (len(t), t))
    r = random.Random(1)
    junk = base64.b64encode(r.randbytes(len(prose) * 3 // 4)).decode()
    texts = {"prose": prose, "hex": _words(2, "0123456789abcdef", 10_000), "letters": _words(3, "abcdefghijklmnopqrstuvwxyz", 10_000),
             "short hex": _words(4, "0123456789abcdef", 2_200), "long hex": _words(5, "0123456789abcdef", 300_000),
             "half base64": prose + " " + junk, "fifth base64": prose + " " + junk[:len(junk) // 4], "far repeats": _far(prose)}
    df = spark.createDataFrame(list(enumerate(texts.values())), "doc_id long, text string")
    got = {list(texts)[r["doc_id"]]: r for r in quality_rules.quality_rules(df).collect()}
    assert not any(r["base_failed"] for r in got.values())
    assert [k for k, r in got.items() if r["kept"]] == ["prose"]


def test_bands_keep_held_out_clean_rows_and_reject_bad_ones(spark, clean):
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    rows = [r for r in quality_rules.quality_rules(clean).where("not base_failed").collect() if held(r["doc_id"])]
    assert len(rows) > 800 and all(r["kept"] for r in rows)
    bad = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 0").select("doc_id")
    rows = [r for r in quality_rules.quality_rules(common.documents(spark, SF).join(bad, "doc_id")).where("not base_failed").collect() if held(r["doc_id"])]
    assert sum(not r["kept"] for r in rows) >= len(rows) / 4
