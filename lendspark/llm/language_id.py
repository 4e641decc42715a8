"""Language of web pages by Bayesian fusion of text, declared language,
address suffix and host."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, stored
from .features import Points, point_chunks

MOST_LANGUAGES = 500    # more distinct values of lang are refused: the model has a row for each
BUCKETS = 1 << 14
SALTS = 64              # parts of a host's pages
NGRAMS = (1, 2, 3)
TEMPER = 0.1            # overlapping n-grams are far from independent evidence
HOST_PRIOR, SUFFIX_PRIOR, DECLARED_PRIOR, FLOOR = 20.0, 50.0, 5.0, 0.5  # pseudo-counts

_DROP = re.compile(r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>")
_TAG = re.compile(r"(?s)<[^>]*>")
_ENTITY = re.compile(r"&[#\w]+;")


def visible(html: str) -> str:
    """Text outside of tags, comments, scripts and styles."""
    return _ENTITY.sub(" ", _TAG.sub(" ", _DROP.sub(" ", html)))


def _ngrams(p: Points) -> tuple[np.ndarray, np.ndarray]:
    parts = [p.ngrams(n) for n in NGRAMS]
    return np.concatenate([(h % BUCKETS).astype(np.int64) for h, _ in parts]), np.concatenate([t for _, t in parts])


def _counts(names: list[str]):
    """(language number, bucket, n) of the n-grams in the texts of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(names) * BUCKETS, np.int64)
        for batch in batches:
            at = pc.index_in(batch.column("lang"), pa.array(names, batch.schema.field("lang").type)).to_numpy(zero_copy_only=False).astype(np.int64)
            for i, _, p in point_chunks(batch, lower=True):
                ids, text = _ngrams(p)
                total += np.bincount(at[i + text] * BUCKETS + ids, minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some // BUCKETS), pa.array(some % BUCKETS), pa.array(total[some])], names=["at", "bucket", "n"])
    return run


def fit(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log probability of each n-gram bucket in each), add-one
    smoothed, from all rows of docs(text, lang) that have both.  Counts are
    plain sums: each task gives one for each language and bucket it met."""
    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null")
    names = sorted(r[0] for r in rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"lang has more than {MOST_LANGUAGES} distinct values")
    count = np.ones((len(names), BUCKETS))
    if names:
        sums = rows.mapInArrow(_counts(names), "at long, bucket long, n long").groupBy("at", "bucket").agg(F.sum("n").alias("n")).toArrow()
        at, bucket, n = (sums.column(c).to_numpy() for c in ("at", "bucket", "n"))
        count[at, bucket] += n
    return names, np.log(count / count.sum(1, keepdims=True)).astype(np.float32)


def _likelihoods(spread_model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table = spread_model.value
        for batch in batches:
            for lo, hi, data, offs in chunks(batch.column("html")):
                raw = data.tobytes()
                p = Points([visible(raw[a:b].decode("utf-8", "replace")).lower() for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())])
                ids, text = _ngrams(p)
                log = np.stack([np.bincount(text, row[ids], p.n) for row in table], 1) * TEMPER
                log -= log.max(1, keepdims=True)
                part = batch.slice(lo, hi - lo)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(p.n + 1, dtype=np.int32) * len(names)), pa.array(log.ravel()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("page_id", "host", "suffix", "declared")), lists],
                                                 names=["page_id", "host", "suffix", "declared", "log"])
    return run


def _normal(column):
    """exp of logs, summing to one."""
    top = F.array_max(column)
    raised = F.transform(column, lambda x: F.exp(x - top))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda a, b: a + b))


def _sums(df: DataFrame, key: list, n: int, name: str, of: str = "post") -> DataFrame:
    """Sums of arrays (the text posteriors) by key, one column each, so that the aggregate is partial and hashed."""
    rows = df.groupBy(*key).agg(*[F.sum(F.col(of)[k]).alias(f"s{k}") for k in range(n)])
    return rows.select(*key, F.array(*[F.col(f"s{k}") for k in range(n)]).alias(name))


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """(page_id, lang, posterior, text_lang, declared, host, suffix) for each row of pages(page_id, url, html, ...).

    Evidence, multiplied: the likelihood of the page's visible text under
    n-gram models of each language, fitted on all rows of docs(text, lang);
    the chance that a page of that language declares what this one's markup
    does; and the host's prior.  Priors and chances come from
    grouped sums of text posteriors over all pages: a host's counts are
    smoothed by those of its address suffix, these by those of all pages, and
    a page's own share is taken out of its host's counts first.  Sums are
    partial aggregates, so a host with a third of all pages is SALTS rows a task;
    its prior goes back to the salts that hold its pages, joined by host and salt.

    Null or empty html has equal likelihoods, a null url has its own host and
    suffix (none), markup without a language declares none.  Ties go to the
    first language by name.  Repeated rows give repeated results, other
    columns are ignored; no pages give no rows, no labelled documents the
    language null; more than MOST_LANGUAGES languages are refused.
    """
    spark = pages.sparkSession
    names, table = fit(docs)
    n = len(names)
    host = F.coalesce(F.lower(F.regexp_extract(F.col("url").cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)), F.lit(""))
    given = F.coalesce(F.lower(F.regexp_extract(F.col("html").cast("string"), r"""(?is)<html\b[^>]*?\s(?:xml:)?lang\s*=\s*["']?([A-Za-z]{2,3})""", 1)), F.lit(""))
    rows_ = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), given.alias("declared"), F.col("html").cast("string").alias("html"))
    rows_ = rows_.select("page_id", "host", F.when(F.col("host").rlike(r"^[0-9.]*$"), "").otherwise(F.substring_index("host", ".", -1)).alias("suffix"), "declared", "html")
    if not names:
        none = F.lit(None).cast("string")
        return rows_.select("page_id", none.alias("lang"), F.lit(None).cast("double").alias("posterior"), none.alias("text_lang"), "declared", "host", "suffix")
    spread = spark.sparkContext.broadcast((names, table))
    base = stored(rows_.mapInArrow(_likelihoods(spread), "page_id long, host string, suffix string, declared string, log array<double>")
                  .withColumn("post", _normal(F.col("log")))
                  .withColumn("salt", F.pmod(F.xxhash64("page_id", "log"), F.lit(SALTS)).cast("int")), "pages")

    salted = _sums(base, ["host", "suffix", "salt"], n, "part")
    by_host, by_suffix = _sums(salted, ["host", "suffix"], n, "host_sum", "part"), _sums(base, ["suffix"], n, "suffix_sum")
    everything, by_declared = _sums(base, [], n, "all_sum"), _sums(base, ["declared"], n, "declared_sum")
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    # one row for all pages, joined to the suffixes and declared languages, which a page has at most one of
    suffix = by_suffix.crossJoin(everything).withColumn("all_prior", F.transform("all_sum", lambda x: (x + FLOOR) / (total(F.col("all_sum")) + FLOOR * n)))
    suffix = suffix.select("suffix", F.zip_with("suffix_sum", "all_prior", lambda s, a: (s + a * SUFFIX_PRIOR) / (total(F.col("suffix_sum")) + SUFFIX_PRIOR)).alias("suffix_prior"))
    shown = by_declared.crossJoin(everything).select("declared", F.zip_with("declared_sum", "all_sum", lambda d, a: F.log((d + FLOOR) / (a + DECLARED_PRIOR))).alias("declared_log"))
    hosts = by_host.join(suffix, "suffix")
    hosts = salted.select("host", "suffix", "salt").join(hosts, ["host", "suffix"])  # at most SALTS rows a host
    fused = base.join(hosts, ["host", "suffix", "salt"]).join(shown, "declared")
    own = F.zip_with("host_sum", "post", lambda h, p: F.greatest(h - p, F.lit(0.0)))
    prior = F.zip_with(own, "suffix_prior", lambda h, s: F.log(h + s * HOST_PRIOR))
    log = F.zip_with(F.zip_with("log", prior, lambda a, b: a + b), "declared_log", lambda a, b: a + b)
    fused = fused.withColumn("fused", _normal(log))
    listed = F.array(*map(F.lit, names))
    first = lambda c: F.element_at(listed, F.array_position(F.col(c), F.array_max(c)).cast("int"))
    return fused.select("page_id", first("fused").alias("lang"), F.array_max("fused").alias("posterior"), first("post").alias("text_lang"), "declared", "host", "suffix")
