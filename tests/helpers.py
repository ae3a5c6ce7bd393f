"""Row builders for the reference's test cases (FIXTURES.md section 1)."""

from __future__ import annotations

from tracewright.schema import SPAN_SCHEMA

EP = {"service_name": "my-host", "ipv4": "127.0.0.1", "port": 9411}
EP_NO_PORT = {"service_name": "my-host", "ipv4": "127.0.0.1", "port": None}
EP_CLIENT_PORT = {"service_name": "my-host", "ipv4": "127.0.0.1", "port": 63840}


def ann(ts, value, ep=EP):
    return {"timestamp": ts, "value": value, "endpoint": ep}


def tag(key, value, ep=EP, kind="STRING"):
    v = value.encode() if isinstance(value, str) else value
    return {"key": key, "value": v, "type": kind, "endpoint": ep}


def span(trace_id=1, id=1, parent_id=None, name="", timestamp=None, duration=None, annotations=(), tags=(), high=0):
    return {
        "trace_id_high": high,
        "trace_id": trace_id,
        "id": id,
        "parent_id": parent_id,
        "name": name,
        "timestamp": timestamp,
        "duration": duration,
        "annotations": list(annotations),
        "binary_annotations": list(tags),
    }


def df_of(spark, spans):
    return spark.createDataFrame(spans, SPAN_SCHEMA)


def rows(df):
    out = []
    for r in df.collect():
        d = r.asDict(recursive=True)
        for t in d.get("binary_annotations") or []:
            if isinstance(t.get("value"), (bytearray, memoryview)):
                t["value"] = bytes(t["value"])
        out.append(d)
    return out


# Finagle server span of the reference test (trace/span ids as given there).
TRACE = -6054243957716233329
SPAN_ID = -3615651937927048332


def finagle_server_span():
    return span(
        trace_id=TRACE,
        id=SPAN_ID,
        parent_id=TRACE,
        name="my-span",
        annotations=[ann(1442493420635000, "sr"), ann(1442493422680000, "ss")],
        tags=[
            tag("srv/finagle.version", "6.28.0"),
            tag("sa", b"\x01", EP, "BOOL"),
            tag("ca", b"\x01", EP_CLIENT_PORT, "BOOL"),
        ],
    )
