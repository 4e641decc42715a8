"""Periodic runs, decontamination and whitening against brute force, and on edge rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

import __spark_entry__ as E
from lendspark.llm import decontamination, periodic_runs, whitening

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
CLASH = "key string, block string, place string, id string, term string, words string, h string, n string, x string, size string"


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ----------------------------------------------------------- periodic runs

def _runs(w, least=6, power=4):
    """Every maximal stretch for every period, kept if no smaller period holds."""
    out = []
    for q in range(1, len(w) // power + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, power * q) and j > i:
                s = w[i:j + q]
                if not any(s[p:] == s[:-p] for p in range(1, q)):
                    out.append((i, j - i + q, q))
            i = max(i + 1, j)
    return sorted(out)


def _op11(doc_id, text):
    w = WORD.findall(text or "")
    if doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]
    runs = _runs(w)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    return (doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
            _sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), _sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


def test_runs_of_random_words_equal_brute_force():
    r = random.Random(1)
    for _ in range(400):
        texts = []
        for _ in range(r.randint(1, 4)):
            t = []
            while r.random() < 0.85:
                p = [r.randint(0, r.choice([1, 2, 5])) for _ in range(r.randint(1, 9))] * r.choice([1, 1, 2])
                t += (p * 7)[:r.randint(1, 7 * len(p))]
            texts.append(t)
        offs = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        got = periodic_runs.find_runs(np.array(sum(texts, []), np.int32), offs)
        assert list(map(tuple, got.tolist())) == [(k, *x) for k, t in enumerate(texts) for x in _runs(t)]


@pytest.mark.parametrize("least,power", [(1, 3), (6, 4), (22, 4), (9, 6)])
def test_runs_for_other_limits(least, power):
    r = random.Random(least)
    for _ in range(150):
        w = [x for _ in range(r.randint(0, 6)) for x in [r.randint(0, 2) for _ in range(r.randint(1, 6))] * r.randint(1, 8)]
        got = periodic_runs.find_runs(np.array(w, np.int32), np.array([0, len(w)]), least, power)
        assert [tuple(x[1:]) for x in got.tolist()] == _runs(w, least, power)


def test_long_and_hostile_texts_are_linear_in_their_words():
    n = 300_000
    thue = np.array([bin(i).count("1") & 1 for i in range(n)], np.int32)
    assert len(periodic_runs.find_runs(thue, np.array([0, n]))) == 0  # overlap-free
    tiled = np.tile(thue[:3000], 100)
    assert periodic_runs.find_runs(tiled, np.array([0, n])).tolist() == [[0, 0, n, 3000]]
    assert periodic_runs.find_runs(np.zeros(n, np.int32), np.array([0, n])).tolist() == [[0, 0, n, 1]]


def _documents(spark):
    r = random.Random(5)
    texts = [None, "", " \n\t", "a", "a a a a a", "a a a a a a", "ab ab\tab\nab ab ab ab", "x y x y x y x y x", "é ß é ß é ß é ß z",
             "p q r " * 9 + "p q", "a b a b a b a b c c c c c c c d", "one two three four five six seven"]
    texts += [" ".join(r.choice("ab") for _ in range(r.randint(1, 60))) for _ in range(150)]
    texts += [" ".join(f"w{r.randint(0, 40)}" for _ in range(r.randint(1, 400))) for _ in range(40)]
    texts.append(" ".join(["long", "text"] * 90_000 + ["end"]))
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, None), (None, "a a a a a a a"), (5, "a a a a a a"), (5, "a a a a a a")]
    return rows, spark.createDataFrame([(*x, *"0123456789") for x in rows], "doc_id long, text string, " + CLASH).repartition(3)


def test_periodic_runs_of_documents(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "CHUNK_BYTES", 1 << 20)
    rows, docs = _documents(spark)
    got = periodic_runs.digest(periodic_runs.periodic_runs(periodic_runs.repeat_tails(docs)))
    expected = Counter(_op11(*x) for x in rows if x[1] is None or len(x[1]) < 100_000)
    found = Counter(map(tuple, got.collect()))
    long_id = next(i for i, t in rows if t and len(t) > 100_000)
    (long_row,) = [x for x in found if x[0] == long_id]
    del found[long_row]
    assert found == expected
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, t in rows if i is not None and t) > 5
    assert periodic_runs.digest(periodic_runs.periodic_runs(periodic_runs.repeat_tails(docs.limit(0)))).collect() == []


def test_run_spans_and_collapsed_text(spark):
    docs = spark.createDataFrame([(1, "go x y x y x y x y stop stop"), (2, "a " * 200_000)], "doc_id long, text string")
    one, two = periodic_runs.periodic_runs(docs).orderBy("doc_id").collect()
    assert [tuple(x) for x in one.runs] == [(1, 8, 2)] and one.collapsed == "go x y stop stop" and one.n_words == 11
    assert [tuple(x) for x in two.runs] == [(0, 200_000, 1)] and two.collapsed == "a"


def test_periodic_runs_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    short = {d.doc_id: d.text for d in docs if d.text is None or len(WORD.findall(d.text)) < 500}
    got = {r.doc_id: tuple(r) for r in E.queries()["op11_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(docs) and len(short) > len(docs) / 2
    for i, text in short.items():
        assert got[i] == _op11(i, text)


# ---------------------------------------------------------- decontamination

def _terms(text):
    return TERM.findall((text or "").translate(LOWER))


def _windows(items, size=10):
    out = defaultdict(set)
    for item, text in items:
        w = _terms(text)
        for k in range(max(len(w) - size + 1, 1) if w else 0):
            out[tuple(w[k:k + size])].add(None if item is None else str(item))
    return out


def _op12(rows, items):
    windows = _windows(items)
    sizes = {len(w) for w in windows}
    for doc_id, text in rows:
        w, hit, found = _terms(text), set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if tuple(w[k:k + size]) in windows:
                    hit |= set(range(k, k + size))
                    found |= windows[tuple(w[k:k + size])] - {None}
        yield doc_id, len(w), len(hit), len(found), _sha(",".join(sorted(found))), bool(hit)


def _benchmark(spark):
    r = random.Random(9)
    prose = lambda n, k=30: " ".join(f"w{r.randint(0, k)}" for _ in range(n))
    a, b, rare = prose(30), prose(14), " ".join(f"rare{k}" for k in range(25))
    items = [(1, a), (2, b), (10, rare), (3, a), (3, a), (4, None), (5, "... !"), (6, "Lone"), (7, "the the the"), (None, "null item"),
             (8, "Ünï çödé 3rd"), (9, "the " * 12)]
    texts = [None, "", "--", "lone", "LONE ranger", "the the", "the the the the", "the " * 700, a, a.upper() + "!", prose(20) + " " + a[:60] + " " + b,
             " ".join(rare.split()[3:13]), " ".join(rare.split()[3:12]), "x " * 505 + rare + " y" * 40, "x " * 1019 + rare, "null. item", "ünï ÇÖDÉ 3rd",
             "ünï çödé 3RD", prose(3000, 3)]
    texts += [prose(r.randint(1, 80)) + " " + " ".join(b.split()[:r.randint(8, 14)]) for _ in range(40)]
    texts += [" ".join(rare.split()) + " copy"] * 30
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, rare), (None, None), (8, a), (8, a)]
    docs = spark.createDataFrame([(*x, *"0123456789") for x in rows], "doc_id long, text string, " + CLASH).repartition(4)
    bench = spark.createDataFrame([(*x, "k", "w", "t") for x in items], "item_id long, text string, key string, win string, terms string")
    return rows, items, docs, bench


def test_contamination_equals_brute_force(spark):
    rows, items, docs, bench = _benchmark(spark)
    got = Counter(map(tuple, decontamination.contamination(docs, bench).collect()))
    assert got == Counter(_op12(rows, items))
    assert any(n > 10 for _, _, n, *_ in got) and len({n for _, _, _, n, *_ in got}) > 2


def test_contamination_of_empty_tables(spark):
    rows, items, docs, bench = _benchmark(spark)
    assert decontamination.contamination(docs.limit(0), bench).collect() == []
    clean = decontamination.contamination(docs, bench.where("item_id = 4")).collect()
    assert len(clean) == len(rows) and not any(r.contaminated or r.n_items for r in clean)


def test_phrase_matches_give_places(spark):
    docs = spark.createDataFrame([(1, "z " * 510 + "a b c d e"), (2, "b a c")], "doc_id long, text string")
    bench = spark.createDataFrame([("i", "a b c")], "item_id string, text string")
    assert [tuple(r) for r in decontamination.matches(docs, bench).collect()] == [(1, 510, 3, "i")]


def test_proximity_matches_equal_brute_force(spark):
    r = random.Random(2)
    items = [("i", "a b c d e f g h i j k l"), ("s", "m n o"), ("o", "q")]
    rows = []
    for k in range(60):
        w = [x for x in "abcdefghijklmnoq" if r.random() < 0.9]
        for _ in range(r.randint(0, 6)):
            w.insert(r.randint(0, len(w)), f"x{r.randint(0, 9)}")
        if k % 3 == 0:
            i = r.randint(0, len(w) - 2)
            w[i], w[i + 1] = w[i + 1], w[i]
        rows.append((k, "z " * r.choice([0, 3, 500, 509]) + " ".join(w)))
    slop, expected = 2, set()
    for doc_id, text in rows:
        w = _terms(text)
        for passage, named in _windows(items).items():
            if any(set(passage) <= set(w[s:s + len(passage) + slop]) for s in range(len(w))):
                expected |= {(doc_id, x) for x in named}
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")
    found = decontamination.matches(docs, bench, slop=slop).collect()
    assert {(m.doc_id, m.item_id) for m in found} == expected
    words = {i: _terms(t) for i, t in rows}
    by_item = {i: _terms(t) for i, t in items}
    for m in found:
        stretch = words[m.doc_id][m.start:m.start + m["size"]]
        assert any(set(by_item[m.item_id][k:k + 10]) <= set(stretch) for k in range(max(len(by_item[m.item_id]) - 9, 1)))


def test_contamination_plan_has_no_python(spark):
    rows, items, docs, bench = _benchmark(spark)
    plan = decontamination.contamination(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct", plan)


# ---------------------------------------------------------------- whitening

def _op13(rows, components=4):
    """{(vec_id, component): (n, deviation, whitened, explained)} by exact sums and a dense eigensolver."""
    x = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows
         if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(v) for _, v in x})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array(fit, float) - np.array([s / n for s in sums])
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    k = min(components, int((e > 1e-9 * e[0]).sum()))
    out = []
    for i, row in x:
        w = (np.array(row) - np.array([s / n for s in sums])) @ v[:, :k] / np.sqrt(e[:k])
        out += [(i, c + 1, n, sum((n * a - s) ** 2 for a, s in zip(row, sums)), w[c], e[c] / e.sum()) for c in range(k)]
    return out


def _same(got, expected):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3])
    got, expected = sorted(map(tuple, got), key=key), sorted(expected, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in expected]
    sign = {}
    for g, w in zip(got, expected):
        if abs(w[4]) > 1e-3:
            sign.setdefault(w[1], math.copysign(1, g[4] * w[4]))
        assert abs(g[4] * sign.get(w[1], 1) - w[4]) < 1e-7 * (1 + abs(w[4]))
        assert abs(g[5] - w[5]) < 1e-9 * w[5] and g[6] < 1e-9


def test_whitening_equals_a_dense_eigensolver(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    r = np.random.default_rng(4)
    base = (r.normal(size=(400, 12)) * np.array([9, 5, 3, 2, 1.4, 1, .7, .5, .3, .2, .1, .05])) @ np.linalg.qr(r.normal(size=(12, 12)))[0]
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(base)]
    rows += [(400 + i, rows[7][1]) for i in range(300)] + [(None, rows[3][1]), (7, rows[7][1])]
    rows += [(900, None), (901, []), (902, [None] * 12), (903, [float("nan")] * 12), (904, [float("-inf")] + [0.0] * 11), (905, [0.5] * 11 + [None])]
    odd = [(906, [1.0, 2.0])]
    table = spark.createDataFrame([(*x, "x", "n") for x in rows + odd], "vec_id long, embedding array<float>, x string, n string").repartition(7)
    _same(whitening.whiten(table).collect(), _op13(rows))


def test_whitening_of_few_and_equal_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect() == []
    rows = [(1, [0.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, [4.0, 0.0, 0.0])]
    got = whitening.whiten(spark.createDataFrame(rows, schema)).collect()
    _same(got, _op13(rows))
    assert {r.component for r in got} == {1}
    # equal eigenvalues: any basis of their space will do, and the whitened list is still white
    cross = [(k, [float(x) for x in v]) for k, v in enumerate(np.vstack([np.eye(5), -np.eye(5)]))]
    got = whitening.whiten(spark.createDataFrame(cross, schema)).collect()
    assert len(got) == 40 and max(r.identity_error for r in got) < 1e-9


def test_deviation_beyond_a_long_is_null():
    x = np.array([[2**40, 0], [3, 4]])
    assert whitening._deviations(x, 2**20, [2**30, 0]) == [None, (3 * 2**20 - 2**30) ** 2 + (4 * 2**20) ** 2]
    assert whitening._deviations(x[1:], 3, [2, 1]) == [49 + 121]


@pytest.mark.parametrize("kind", range(6))
def test_bidiagonal_qd_against_numpy(kind):
    r = np.random.default_rng(kind)
    for _ in range(15):
        d = int(r.integers(1, 40))
        a = r.normal(size=(int(r.integers(1, 120)), d))
        if kind == 1:
            a = a * np.logspace(0, -8, d)
        if kind == 2:
            a[:, d // 2:] = a[:, :1]
        if kind == 3:
            a = np.round(a * 4)
        if kind == 4:
            a = np.vstack([np.eye(d)] * 3)
        if kind == 5:
            a[:, 0] *= 1e6
        tri, q = np.zeros((d, d)), np.linalg.qr(a, mode="r")
        tri[:len(q)] = q
        values, z = whitening.principal(tri, 4)
        true = np.concatenate([np.linalg.svd(a, compute_uv=False), np.zeros(d)])[:d]
        assert np.abs(np.sqrt(values) - true).max() <= 1e-13 * true[0]
        assert np.abs(z.T @ z - np.eye(z.shape[1])).max(initial=0) < 1e-13
        assert np.abs(a.T @ (a @ z) - z * values[:z.shape[1]]).max(initial=0) < 1e-12 * values[0]


def test_dqds_keeps_small_values_accurate():
    a, b = np.array([1.0, 1e-3, 1e-6, 1e-9]), np.array([1e-2, 1e-5, 1e-8])
    product = math.prod(a.tolist()) ** 2
    assert abs(math.prod(whitening.squared_singular_values(a, b).tolist()) / product - 1) < 1e-13


def test_whitening_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    _same(E.queries()["op13_whitening"](spark, SF).collect(), _op13(rows))
