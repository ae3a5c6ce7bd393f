"""Decode edge cases (the reference has no decode tests; FIXTURES.md lists ours)."""

import json
import struct

from pyspark.sql import functions as F

from helpers import ann, df_of, rows, span, tag
from tracewright.operators import decode as D
from tracewright.operators.thrift import ThriftError, read_spans
from tracewright.schema import MESSAGE_SCHEMA
from tracewright.sources.messages import span_thrift, thrift_list

GOOD = {
    "traceId": "abfb01327cc4d38f",
    "id": "cdd29fb81067d374",
    "name": "get",
    "timestamp": 1442493420635000,
    "duration": 2045000,
    "annotations": [{"timestamp": 1442493420635000, "value": "sr", "endpoint": {"serviceName": "a", "port": 9411}}],
    "binaryAnnotations": [{"key": "k", "value": "v"}],
}


def _msgs(spark, payloads):
    return spark.createDataFrame([(p,) for p in payloads], MESSAGE_SCHEMA)


def _decode(spark, payloads):
    d = D.decode_messages(_msgs(spark, payloads))
    return rows(d.spans), sorted(r["reason"] for r in d.dead_letters.collect())


def test_formats_detected(spark):
    df = _msgs(spark, [b"", b"[]", bytes([12, 0, 0, 0, 0]), b"not spans", b"{}"])
    got = [r[0] for r in df.select(D.message_format()).collect()]
    assert got == ["empty", "json", "thrift_list", "thrift", "thrift"]


def test_empty_and_empty_list_give_no_spans_and_no_dead_letters(spark):
    spans, dead = _decode(spark, [b"", b"[]"])
    assert spans == [] and dead == []


def test_one_and_many_spans(spark):
    two = [GOOD, dict(GOOD, id="0000000000000002", parentId="cdd29fb81067d374")]
    spans, dead = _decode(spark, [json.dumps([GOOD]).encode(), json.dumps(two).encode()])
    assert len(spans) == 3 and dead == []
    s = spans[0]
    assert s["trace_id"] == -6054243957716233329 and s["trace_id_high"] == 0
    assert s["id"] == int.from_bytes(bytes.fromhex("cdd29fb81067d374"), "big", signed=True)
    assert s["annotations"][0]["endpoint"]["port"] == 9411
    assert s["binary_annotations"][0]["value"] == b"v"


def _tagged(value, kind=None):
    tag_ = {"key": "k", "value": value} | ({"type": kind} if kind else {})
    return json.dumps([dict(GOOD, binaryAnnotations=[tag_])]).encode()


def test_json_tag_kinds_have_the_bytes_of_thrift(spark):
    cases = [
        (True, None, "BOOL", b"\x01"),
        (False, None, "BOOL", b"\x00"),
        ("true", None, "STRING", b"true"),
        ("//4=", "BYTES", "BYTES", b"\xff\xfe"),
        (-2, "I16", "I16", b"\xff\xfe"),
        (258, "I32", "I32", b"\x00\x00\x01\x02"),
        (-1, "I64", "I64", b"\xff" * 8),
        ("-1", "I64", "I64", b"\xff" * 8),
        (0.5, "DOUBLE", "DOUBLE", struct.pack(">d", 0.5)),
        ("1e300", "DOUBLE", "DOUBLE", struct.pack(">d", 1e300)),
        (7, "DOUBLE", "DOUBLE", struct.pack(">d", 7.0)),
    ]
    spans, dead = _decode(spark, [_tagged(v, k) for v, k, _, _ in cases])
    got = [(s["binary_annotations"][0]["type"], s["binary_annotations"][0]["value"]) for s in spans]
    assert dead == [] and sorted(got) == sorted((k, b) for _, _, k, b in cases)


def test_json_tag_that_does_not_fit_its_kind_is_a_dead_letter(spark):
    bad = [(7, None), ("x", "I16"), (1.5, "I32"), (70000, "I16"), ("!", "BYTES"), ("x", "NONE"), ("true", "BOOL"), ({"a": 1}, None), (None, None)]
    spans, dead = _decode(spark, [_tagged(v, k) for v, k in bad])
    assert spans == [] and dead == ["bad_json"] * len(bad)


def test_128_bit_trace_id(spark):
    m = json.dumps([dict(GOOD, traceId="00000000000000ab" + "abfb01327cc4d38f")]).encode()
    spans, _ = _decode(spark, [m])
    assert spans[0]["trace_id_high"] == 0xAB and spans[0]["trace_id"] == -6054243957716233329


def test_bad_messages_are_dead_letters_whole(spark):
    good = json.dumps([GOOD]).encode()
    bad_field = json.dumps([GOOD, dict(GOOD, timestamp="soon")]).encode()
    bad_hex = json.dumps([dict(GOOD, id="xyz")]).encode()
    payloads = [good[:-5], b"[1]", bad_field, bad_hex, b"not spans", b"[\xff\xfe]", good]
    spans, dead = _decode(spark, payloads)
    assert len(spans) == 1  # only the last, intact message
    assert dead == ["bad_json"] * 5 + ["bad_thrift"]


def test_thrift_round_trip(spark):
    src = [
        span(trace_id=-5, id=2, parent_id=1, name="get", timestamp=10, duration=20, high=7,
             annotations=[ann(10, "cs"), ann(30, "cr", None)], tags=[tag("http.path", "/x")]),
        span(trace_id=9, id=3, name="", annotations=[], tags=[]),
    ]
    df = df_of(spark, src)
    single = [bytes(r[0]) for r in df.select(span_thrift()).collect()]
    as_list = df.agg(thrift_list(F.collect_list(span_thrift()))).collect()[0][0]
    spans, dead = _decode(spark, single + [bytes(as_list)])
    assert dead == []
    key = lambda s: (s["id"], s["trace_id"])
    assert sorted(spans, key=key) == sorted(rows(df) * 2, key=key)


def test_thrift_reader_rejects_garbage():
    for payload in (b"not spans", bytes([12, 0, 0, 0, 5]), bytes([10, 0, 1]) + struct.pack(">q", 1) + b"\x00junk"):
        try:
            read_spans(payload)
        except ThriftError:
            continue
        raise AssertionError(f"accepted {payload!r}")


def test_json_round_trip_of_fixture(spark):
    """decode(encode(spans)) == spans, on the driver's own data."""
    from tracewright.operators.flat import flat_spans
    from tracewright.sources.events import spans_table
    from tracewright.sources.messages import span_json_struct

    spans = spans_table(spark, "/root/testdata/sf0.001")
    msgs = spans.select(F.concat(F.lit("["), F.to_json(span_json_struct()), F.lit("]")).cast("binary").alias("value"))
    back = D.decode_messages(msgs).spans
    assert flat_spans(back).exceptAll(flat_spans(spans)).count() == 0
    assert flat_spans(spans).exceptAll(flat_spans(back)).count() == 0


def test_text_behind_a_list_is_refused(spark):
    good = json.dumps([GOOD]).encode()
    tails = [b"garbage", b"}", b"]", b"}]", b"]}", b",", b",1", b',"b":1', b",[]", b'}{"a":[]', b"][", b" x"]
    spans, dead = _decode(spark, [good + t for t in tails])
    assert spans == [] and dead == ["bad_json"] * len(tails)
    spans, dead = _decode(spark, [good + b" \n", b" ".join([good, b""])])
    assert len(spans) == 2 and dead == []


def test_deeply_nested_unknown_fields_are_skipped():
    from tracewright.operators.thrift import T_STRUCT, _Reader

    depth = 20_000
    reader = _Reader(b"\x0c\x00\x01" * depth + b"\x00" * (depth + 1) + b"tail")
    reader.skip(T_STRUCT)
    assert reader.take(4) == b"tail"


def test_names_and_numbers_are_strict(spark):
    good = [dict(GOOD, name=5), dict(GOOD, name=None), dict(GOOD, timestamp="1442493420635000"), dict(GOOD, name='{"a":1}')]
    spans, dead = _decode(spark, [json.dumps([s]).encode() for s in good])
    assert [s["name"] for s in spans] == ["5", "", "get", '{"a":1}'] and dead == []
    assert spans[2]["timestamp"] == 1442493420635000
    ep = {"serviceName": "a", "port": " 9411"}
    bad = [dict(GOOD, name={"a": 1}), dict(GOOD, name=["x"]), dict(GOOD, name=True), dict(GOOD, timestamp=" 5 "), dict(GOOD, duration="5 ")]
    bad += [dict(GOOD, duration="1e3"), dict(GOOD, timestamp="9" * 25), dict(GOOD, annotations=[{"timestamp": "5 ", "value": "x"}])]
    bad += [dict(GOOD, annotations=[{"timestamp": 5, "value": "x", "endpoint": ep}])]
    spans, dead = _decode(spark, [json.dumps([s]).encode() for s in bad])
    assert spans == [] and dead == ["bad_json"] * len(bad)


def _one_by_one(payloads):
    """What the reader of single messages makes of them."""
    out = []
    for p in payloads:
        try:
            out.append({"spans": None if p is None else read_spans(p), "reason": None})
        except ThriftError:
            out.append({"spans": None, "reason": "bad_thrift"})
    return out


def test_messages_read_together_are_those_read_one_by_one(spark):
    import random

    import pyarrow as pa

    from tracewright.sources.fixtures import stored_spans

    rng = random.Random(4)
    odd = [span(id=1), span(id=2, name="x" * 300, annotations=[ann(5, ""), ann(-1, "é")], tags=[tag("", b"", kind="BYTES"), tag("k", b"\xff", kind="I16")])]
    odd += [span(id=i, annotations=[ann(i, "v", None)] * i, tags=[tag("k", "v", None)] * i) for i in range(3, 9)]
    encoded = stored_spans(spark, "/root/testdata/sf0.001").unionByName(df_of(spark, odd)).select(span_thrift().alias("v")).collect()
    singles = [bytes(r.v) for r in encoded]
    payloads = [None, b"", b"\x0c", b"\x00", b"\x0c\x0c\x00\x00\x00\x00"] + singles
    payloads += [b"\x0c" + struct.pack(">i", n) + b"".join(rng.sample(singles, n)) for n in range(1, 40)]
    payloads += [b"\x0c" + struct.pack(">i", n + d) + b"".join(rng.sample(singles, n)) for n in (1, 5) for d in (-1, 1, 2**30)]
    flag, unknown = b"\x02\x00\x09\x01", b"\x0c\x00\x63\x0b\x00\x01\x00\x00\x00\x01z\x00"
    payloads += [extra + s for extra in (flag, unknown, b"\x0b\x00\x63\x00\x00\x00\x02zz", b"\x0a\x00\x01" + bytes(8)) for s in singles[:20]]
    lists = b"\x0f\x00\x06\x0c\x00\x00\x00\x00"
    payloads += [lists + s for s in singles[:20]]  # annotations given twice
    for p in rng.sample(payloads[5:], 300):
        cut = bytearray(p)
        if rng.random() < 0.4:
            del cut[rng.randrange(len(cut)) :]
        else:
            for _ in range(rng.randint(1, 3)):
                cut[rng.randrange(len(cut))] = rng.randrange(256)
        payloads.append(bytes(cut))
    rng.shuffle(payloads)
    want = _one_by_one(payloads)
    assert D._decode_thrift_array(pa.array(payloads, pa.binary())).to_pylist() == want
    part = pa.array(payloads, pa.binary()).slice(11, 200)
    assert D._decode_thrift_array(part).to_pylist() == want[11:211]
    for none in ([], [None], [b""], [None, b"\x0c"]):
        assert D._decode_thrift_array(pa.array(none, pa.binary())).to_pylist() == _one_by_one(none)
