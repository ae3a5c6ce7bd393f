"""Property tests: decode(encode(x)) == x for random spans, in both encodings."""

import json
import struct

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import df_of, rows
from tracewright.operators import decode as D
from tracewright.operators.adjust import issue343_adjuster
from tracewright.sources.messages import span_json_struct, span_thrift, thrift_list

i64 = st.integers(min_value=-(2**63), max_value=2**63 - 1)
text = st.text(alphabet=st.characters(min_codepoint=32, max_codepoint=0x2FF, blacklist_categories=("Cs",)), max_size=12)
endpoint = st.one_of(
    st.none(),
    st.fixed_dictionaries(
        {
            "service_name": st.one_of(st.none(), text),
            "ipv4": st.one_of(st.none(), st.tuples(*[st.integers(0, 255)] * 4).map(lambda t: ".".join(map(str, t)))),
            "port": st.one_of(st.none(), st.integers(0, 65535)),
        }
    ),
)
annotation = st.fixed_dictionaries({"timestamp": i64, "value": text, "endpoint": endpoint})
kinds = st.one_of(
    st.tuples(st.just("STRING"), text.map(str.encode)),
    st.tuples(st.just("BOOL"), st.sampled_from([b"\x00", b"\x01"])),
    st.tuples(st.just("BYTES"), st.binary(max_size=12)),
    st.tuples(st.just("I16"), st.binary(min_size=2, max_size=2)),
    st.tuples(st.just("I32"), st.binary(min_size=4, max_size=4)),
    st.tuples(st.just("I64"), st.binary(min_size=8, max_size=8)),
    st.tuples(st.just("DOUBLE"), st.floats(-1e12, 1e12).map(lambda d: struct.pack(">d", d + 0.0))),
)
tag = st.tuples(text, kinds, endpoint).map(lambda t: {"key": t[0], "value": t[1][1], "type": t[1][0], "endpoint": t[2]})
span = st.fixed_dictionaries(
    {
        "trace_id_high": st.one_of(st.just(0), i64),
        "trace_id": i64,
        "id": i64,
        "parent_id": st.one_of(st.none(), i64),
        "name": text,
        "timestamp": st.one_of(st.none(), i64),
        "duration": st.one_of(st.none(), i64),
        "annotations": st.lists(annotation, max_size=3),
        "binary_annotations": st.lists(tag, max_size=3),
    }
)

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _canon(rs):
    return sorted(json.dumps(r, sort_keys=True, default=lambda b: b.hex()) for r in rs)


@SETTINGS
@given(st.lists(span, min_size=1, max_size=12))
def test_json_round_trip(spark, spans):
    df = df_of(spark, spans)
    msgs = df.select(F.concat(F.lit("["), F.to_json(span_json_struct()), F.lit("]")).cast("binary").alias("value"))
    back = D.decode_messages(msgs)
    assert back.dead_letters.count() == 0
    assert _canon(rows(back.spans)) == _canon(rows(df))


@SETTINGS
@given(st.lists(span, min_size=1, max_size=12))
def test_thrift_round_trip(spark, spans):
    df = df_of(spark, spans)
    single = df.select(span_thrift().alias("value"))
    as_list = df.agg(thrift_list(F.collect_list(span_thrift())).alias("value"))
    back = D.decode_messages(single.union(as_list))
    assert back.dead_letters.count() == 0
    assert _canon(rows(back.spans)) == _canon(rows(df) * 2)


@SETTINGS
@given(st.lists(span, min_size=1, max_size=12))
def test_issue343_idempotent(spark, spans):
    df = df_of(spark, spans)
    once = issue343_adjuster()(df)
    assert _canon(rows(issue343_adjuster()(once))) == _canon(rows(once))
