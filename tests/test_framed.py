"""Message segments: frames, offsets, limits, broken and growing segments, batch and stream."""

import os
import random
import struct
import time

import pytest

from tracewright.operators.decode import decode_messages
from tracewright.sources import framed
from tracewright.sources.framed import Range, frames, read_segments, segment_stream, segments, whole_frames, write_segments


def frame(message):
    return struct.pack(">i", len(message)) + message


def put(folder, name, data, mode="wb"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", mode) as f:
        f.write(data)


def test_frames_of_any_range_and_size(tmp_dir, monkeypatch):
    rng = random.Random(1)
    messages = [rng.randbytes(rng.choice([0, 1, 3, 50, 5000])) for _ in range(60)]
    put(tmp_dir, "segment-0", b"".join(map(frame, messages)))
    size = os.path.getsize(f"{tmp_dir}/segment-0")
    for block in (1, 7, 1 << 20):
        monkeypatch.setattr(framed, "BLOCK", block)
        found = list(frames(tmp_dir, Range("segment-0", 0, size)))
        assert [m for _, m in found] == messages
        some = found[20][0], found[45][0]
        assert [m for _, m in frames(tmp_dir, Range("segment-0", *some))] == messages[20:45]
    assert whole_frames(tmp_dir, "segment-0", 0, size) == size
    assert whole_frames(tmp_dir, "segment-0", 0, size - 1) == found[-1][0] == whole_frames(tmp_dir, "segment-0", found[5][0], size - 1)


def test_small_frames_cost_as_much_as_their_bytes(tmp_dir):
    put(tmp_dir, "segment-0", frame(b"12345678") * 200_000)
    began = time.process_time()
    assert sum(1 for _ in frames(tmp_dir, Range("segment-0", 0, 2_400_000))) == 200_000
    assert time.process_time() - began < 3  # a copy of what is left of the block for each frame takes far longer


@pytest.mark.parametrize("tail", [struct.pack(">i", -5) + b"xyz", struct.pack(">i", 2**30) + b"xyz", struct.pack(">i", 50) + b"xyz", b"\x00\x00"])
def test_a_broken_frame_ends_among_the_dead_letters(spark, tmp_dir, tail):
    put(tmp_dir, "segment-000", frame(b"[]") + tail)
    put(tmp_dir, "segment-001", frame(b'[{"traceId":"a","id":"b"}]'))
    decoded = decode_messages(read_segments(spark, tmp_dir))
    assert [(r.trace_id, r.id) for r in decoded.spans.collect()] == [(10, 11)]
    assert [(bytes(r.value), r.reason) for r in decoded.dead_letters.collect()] == [(tail, "bad_thrift")]


def test_written_segments_are_read_back(spark, tmp_dir):
    rows = [(bytes([i % 256]) * (i % 40),) for i in range(500)] + [(None,)]
    messages = spark.createDataFrame(rows, "value binary").repartition(3)
    for _ in range(2):
        write_segments(messages, f"{tmp_dir}/in", segment_bytes=2000)
    names = [n for n, _ in segments(f"{tmp_dir}/in")]
    assert len(names) > 6 and names == [f"segment-{i:012d}" for i in range(len(names))]
    assert all(s <= 2000 + 44 for _, s in segments(f"{tmp_dir}/in"))
    found = read_segments(spark, f"{tmp_dir}/in")
    assert sorted(bytes(r.value) for r in found.collect()) == sorted([v or b"" for (v,) in rows] * 2)
    assert found.select("segment", "at").distinct().count() == found.count()
    assert not [f for f in os.listdir(f"{tmp_dir}/in") if f.startswith(".") and not f.endswith(".crc")]


def test_offsets_lie_between_frames_and_replay_the_same(tmp_dir):
    reader = framed._StreamReader(tmp_dir, 100, f"{tmp_dir}/progress")
    start = reader.initialOffset()
    assert reader.latestOffset() == start  # no segment yet
    for k in range(3):
        put(tmp_dir, f"segment-{k}", b"".join(frame(b"x" * 30) for _ in range(5)))
    put(tmp_dir, "segment-2", frame(b"y" * 30)[:-1], "ab")  # still growing
    seen, offset = [], start
    while (end := reader.latestOffset()) != offset:
        parts = reader.partitions(offset, end)
        assert sum(p.stop - p.start for p in parts) <= 100 + 33
        batch = [m for p in parts for _, m in frames(tmp_dir, p)]
        assert batch == [m for p in framed._StreamReader(tmp_dir, None).partitions(offset, end) for _, m in frames(tmp_dir, p)]
        seen += batch
        offset = end
    assert seen == [b"x" * 30] * 15
    put(tmp_dir, "segment-2", b"y", "ab")
    assert [m for p in reader.partitions(offset, reader.latestOffset()) for _, m in frames(tmp_dir, p)] == [b"y" * 30]
    assert framed._StreamReader(tmp_dir, 100, f"{tmp_dir}/progress").last == {"segment": "segment-2", "at": 204}
    assert framed._StreamReader(tmp_dir, 100).latestOffset() == {"segment": "segment-2", "at": 204}  # start unknown: all there is


def test_stream_goes_on_after_a_restart(spark, tmp_dir):
    def run():
        q = segment_stream(spark, f"{tmp_dir}/in", 60, f"{tmp_dir}/progress").writeStream.format("parquet").option("path", f"{tmp_dir}/out")
        q = q.option("checkpointLocation", f"{tmp_dir}/ck").start()
        try:
            q.processAllAvailable()
            return q.lastProgress["batchId"] if q.lastProgress else None
        finally:
            q.stop()

    first = [bytes([65 + i]) * 20 for i in range(10)]
    put(f"{tmp_dir}/in", "segment-00", b"".join(map(frame, first)))
    assert run() >= 3  # more than one batch
    put(f"{tmp_dir}/in", "segment-00", frame(b"more"), "ab")
    put(f"{tmp_dir}/in", "segment-01", frame(b"next"))
    run()
    run()
    found = sorted(bytes(r.value) for r in spark.read.schema("value binary").parquet(f"{tmp_dir}/out").collect())
    assert found == sorted([*first, b"more", b"next"])


def test_whole_segments_are_looked_for_once(tmp_dir, monkeypatch):
    for k in range(40):
        put(tmp_dir, f"segment-{k:02d}", frame(b"x" * 46))
    looked = []
    monkeypatch.setattr(framed, "segments", lambda folder: looked.append(folder) or segments(folder))
    reader = framed._StreamReader(tmp_dir, 100, f"{tmp_dir}/progress")
    seen, offset = [], reader.initialOffset()
    while (end := reader.latestOffset()) != offset:
        seen += [p.segment for p in reader.partitions(offset, end)]
        offset = end
    assert seen == [f"segment-{k:02d}" for k in range(40)] and len(looked) <= 4  # of 20 batches
    put(tmp_dir, "segment-40", frame(b"new"))
    end = reader.latestOffset()
    assert [p.segment for p in reader.partitions(offset, end)] == ["segment-40"]
    again = [p.segment for p in reader.partitions(reader.initialOffset(), end)]  # a batch from before
    assert again == [f"segment-{k:02d}" for k in range(41)]


def test_columns_of_the_decoder_are_built_once(spark):
    from tracewright.operators import decode

    decode_messages(spark.createDataFrame([(b"[]",)], "value binary"))
    hits = decode._decoding.cache_info().hits
    found = decode_messages(spark.createDataFrame([(b"not spans",)], "value binary"))
    assert decode._decoding.cache_info().hits == hits + 1
    assert [r.reason for r in found.dead_letters.collect()] == ["bad_thrift"]
