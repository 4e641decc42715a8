"""Scores of the fitted models against plain Python versions of their formulas,
one text and one feature at a time."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lendspark.llm import common, language_id, quality_model, toxicity

ODD = [int(x) for x in common.ODD]
TEXTS = [None, "", " \t\n", "plain words here", "Vile vile VILE words and vile words and", "é ü straße 日本語 \x00 x" * 3,
         "w" * 200 + " tail", "the cat sat the cat sat the cat", "a b c d e f g", "vile mean words here " * 400]


def _mix(x):
    x &= 2**64 - 1
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
    x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
    return x ^ x >> 31


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def _word(word):
    total = 0
    for c in word:
        total = (total * ODD[1] + _mix(ord(c) * ODD[0])) % 2**64
    return _mix(total)


def _runs(text, n):
    """Hashes of the runs of n code points inside words."""
    return [_mix(sum(_mix(ord(c) * ODD[0]) * ODD[k] for k, c in enumerate(w[i:i + n])) + n)
            for w in _words(text) for i in range(len(w) - n + 1)]


def _logistic(x):
    return 1 / (1 + math.exp(-min(max(x, -60), 60)))


class Held:
    def __init__(self, value):
        self.value = value


def _scored(run):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(TEXTS)), pa.int64()), pa.array(TEXTS, pa.string())], names=["doc_id", "text"])
    return [tuple(r.values()) for b in run(iter([batch])) for r in b.to_pylist()]


def test_toxicity_scores():
    train = ["plain words here and there"] * 40 + ["vile plain words"] * 10 + ["vile mean words"] * 10 + ["vile mean vile mean"] * 10
    model = toxicity.fit(train, np.array([0] * 40 + [1] * 30))
    weight = dict(zip(model["chosen"].tolist(), model["w"].tolist()))
    assert weight
    got = _scored(toxicity._score(Held(model)))
    for text, (_, severity) in zip(TEXTS, got, strict=True):
        low = (text or "").lower()
        found = Counter(h % toxicity.BUCKETS for h in [*map(_word, _words(low)), *_runs(low, toxicity.NGRAM)])
        s = sum(weight[f] * math.log1p(n) for f, n in found.items() if f in weight)
        assert severity == pytest.approx(sum(_logistic(s - c) for c in model["cuts"]), abs=1e-9)
    assert got[4][1] > got[3][1]


def test_quality_scores():
    train = ["good prose of many kinds", "the same words the same words the same words"] * 60
    gain, bias = quality_model.fit(train, np.array([1, 0] * 60))
    got = _scored(quality_model._score(Held((gain, bias))))
    for text, (_, score) in zip(TEXTS, got, strict=True):
        words = _words(text or "")
        found = [_word(w) % quality_model.BUCKETS for w in words]
        found += [h % quality_model.BUCKETS for n in quality_model.NGRAMS for h in _runs(text or "", n)]
        seen = set()
        for pair in zip(words, words[1:]):
            found.append(quality_model.AGAIN if pair in seen else quality_model.FRESH)
            seen.add(pair)
        assert score == pytest.approx(_logistic(sum(float(gain[f]) for f in found) / max(1, len(found)) + bias), abs=1e-9)


def _plain_languages(pages, names, table):
    """The fusion of language_id.identify, page by page: text posterior x declared x host prior without the page's own share."""
    def normal(logs):
        raised = [math.exp(x - max(logs)) for x in logs]
        return [x / sum(raised) for x in raised]

    rows, n = [], len(names)
    for page_id, url, html in pages:
        text = language_id.visible(html or "").lower()
        ids = [h % language_id.BUCKETS for k in language_id.NGRAMS for h in _runs(text, k)]
        log = [float(sum(float(table[l][i]) for i in ids)) * language_id.TEMPER for l in range(n)]
        host = (re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", url or "") or [None, ""])[1].lower()
        suffix = "" if re.fullmatch(r"[0-9.]*", host) else host.rsplit(".", 1)[-1]
        said = re.search(r"""(?is)<html\b[^>]*?\s(?:xml:)?lang\s*=\s*["']?([A-Za-z]{2,3})""", html or "")
        rows.append((page_id, host, suffix, said[1].lower() if said else "", log, normal(log)))
    sums = [defaultdict(lambda: [0.0] * n) for _ in range(4)]
    for _, host, suffix, declared, _, post in rows:
        for table_, key in zip(sums, (host, suffix, declared, None)):
            table_[key] = [a + b for a, b in zip(table_[key], post)]
    by_host, by_suffix, by_declared, everything = (*sums[:3], sums[3][None])
    base = [(x + language_id.FLOOR) / (sum(everything) + language_id.FLOOR * n) for x in everything]
    out = {}
    for page_id, host, suffix, declared, log, post in rows:
        size = sum(by_suffix[suffix]) + language_id.SUFFIX_PRIOR
        prior = [(s + a * language_id.SUFFIX_PRIOR) / size for s, a in zip(by_suffix[suffix], base)]
        fused = normal([x + math.log(max(h - p, 0.0) + s * language_id.HOST_PRIOR)
                        + math.log((d + language_id.FLOOR) / (a + language_id.DECLARED_PRIOR))
                        for x, h, p, s, d, a in zip(log, by_host[host], post, prior, by_declared[declared], everything)])
        out[page_id] = (names[fused.index(max(fused))], max(fused), names[post.index(max(post))], declared, host, suffix)
    return out


def test_language_fusion(spark):
    docs = spark.createDataFrame([("the cat and the dog", "en"), ("le chat et le chien", "fr"), ("der hund und die katze", "de")] * 3, "text string, lang string")
    pages = [(1, "https://a.fr/x", "<html lang=fr><p>le chat et le chien"), (2, "https://a.fr/y", "<html lang='fr'><p>the cat and the dog"),
             (3, "http://u@B.de:80/", "<p>der hund</p><script>the the the</script>"), (4, None, None), (5, "http://1.2.3.4/", "<html xml:lang=en-GB>und die katze"),
             (6, "https://a.fr/z", "<html lang=fr>"), (7, "no url", "the dog &amp; the cat"), (8, "https://big.de/", "<b>le chat</b> " * 3000)]
    got = {r["page_id"]: tuple(r)[1:] for r in language_id.identify(spark.createDataFrame(pages, "page_id long, url string, html string"), docs).collect()}
    want = _plain_languages(pages, *language_id.fit(docs))
    assert set(got) == set(want)
    for page, row in want.items():
        assert got[page][1] == pytest.approx(row[1], abs=1e-6)
        assert got[page][2:] == (row[2], *row[3:]) and got[page][0] == row[0]


def test_language_without_the_declaration(spark):
    """The declared language of the pages, found again once it is taken out of their markup."""
    docs = common.documents(spark, "/root/testdata/sf0.01")
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    said = F.lower(F.regexp_extract("html", r'<html lang="([a-z]+)"', 1))
    bare = pages.select("page_id", said.alias("said"), "url", F.regexp_replace("html", r'<html lang="[a-z]+"', "<html").alias("html"))
    out = language_id.identify(bare, docs).join(bare.select("page_id", "said").where("said <> ''"), "page_id")
    right, n = out.where("declared = ''").agg(F.avg((F.col("lang") == F.col("said")).cast("double")), F.count("*")).first()
    print("declared language found without the declaration:", right, "of", n)
    assert n > 0 and right > 0.9


def test_pages_are_read_in_bounded_runs(monkeypatch):
    """Few bytes of pages are open at a time; a page above the bound is a run of its own; results do not change."""
    names, table = ["en", "fr"], np.log(np.random.default_rng(2).uniform(0.1, 1, (2, language_id.BUCKETS))).astype(np.float32)
    pages = [None, "", "the cat", "le chat " * 50, "<p>x</p>" * 30] * 5
    columns = [pa.array(range(len(pages)), pa.int64())] + [pa.array([""] * len(pages))] * 3 + [pa.array(pages, pa.string())]
    batch = pa.RecordBatch.from_arrays(columns, names=["page_id", "host", "suffix", "declared", "html"])
    whole = [r for b in language_id._likelihoods(Held((names, table)))(iter([batch])) for r in b.to_pylist()]
    sizes = []
    small = lambda column: common.chunks(column, 200)
    monkeypatch.setattr(language_id, "chunks", small)
    parts = [b for b in language_id._likelihoods(Held((names, table)))(iter([batch]))]
    sizes = [b.num_rows for b in parts]
    assert len(sizes) > 5 and sum(sizes) == len(pages)
    for a, b in zip(whole, [r for p in parts for r in p.to_pylist()], strict=True):
        assert a["page_id"] == b["page_id"] and a["log"] == pytest.approx(b["log"], abs=1e-6)
