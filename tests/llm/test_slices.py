"""Stretches cut out of texts leave in runs of bounded bytes (op8)."""

import pyarrow as pa

from lendspark.llm import substring_dedup

WANTED = pa.list_(pa.struct([("key", pa.int64()), ("content", pa.int64()), ("weight", pa.int64()), ("start", pa.int32()), ("length", pa.int32())]))


def test_slices_of_many_overlapping_stretches_come_in_bounded_runs(monkeypatch):
    monkeypatch.setattr(substring_dedup, "CHUNK_BYTES", 1000, raising=False)
    texts = [b"", bytes(range(256)) * 3, b"x" * 10, bytes(range(255, -1, -1)) * 10, b"y" * 1500]
    wanted = [[], [{"key": i, "content": -i, "weight": i + 1, "start": i, "length": 300} for i in range(400)], [],
              [{"key": 7, "content": 8, "weight": 1, "start": 0, "length": 2560}], [{"key": 9, "content": 9, "weight": 2, "start": 0, "length": 0}]]
    batch = pa.RecordBatch.from_arrays([pa.array([b"cut off", *texts], pa.binary()), pa.array([[], *wanted], WANTED)], names=["bytes", "wanted"]).slice(1)
    out = list(substring_dedup._slices(iter([batch])))
    assert len(out) > 100 and all(b.num_rows == 1 or sum(map(len, b.column("bytes").to_pylist())) <= 1000 for b in out)
    got = [tuple(r.values()) for b in out for r in b.to_pylist()]
    assert got == [(w["key"], w["content"], w["weight"], t[w["start"]:w["start"] + w["length"]])
                   for t, ws in zip(texts, wanted) for w in ws]
    assert out[0].schema.field("bytes").type == pa.binary()
