"""Token files, WARC archives, sharding and packing: round trips, brute force and defined cases."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tracewright.llm import packing, sharding, simple8b, warc
from tracewright.llm.shared_files import listed
from tracewright.llm.tokens import tokenizer, tokenizer_path

DOCS = "doc_id long, text string"


# --- tokens and Simple-8b ----------------------------------------------------


def test_ids_are_those_of_the_library():
    t = tokenizer(tokenizer_path())
    texts = [
        "", " \n", "Plain words, here.", "DON'T I'll we've 's", "éÀñ straße ÆØ Ÿ ΣΑΣ İi ǅ ﬁ é", "a\x1cb\x1fc", "<|endoftext|> x<|startoftext|>",
        "12 a1b2 x_y __ %%% word!!! (a) [b] {c} ~d` a.b, c@d.e", "你好 мир nb", "x" * 5000, "!" * 300,
    ]
    for text in texts:
        assert t.ids(text).tolist() == t.library.encode(text, add_special_tokens=False).ids, text
    ids, lengths = t.batch([*texts, None], end_id=7)
    want = [[*t.library.encode(x, add_special_tokens=False).ids, 7] for x in [*texts, ""]]
    assert ids.tolist() == sum(want, []) and lengths.tolist() == [len(w) for w in want]


def test_a_small_word_table_gives_the_same_ids():
    from tracewright.llm.tokens import TextTokenizer

    small, large = TextTokenizer(tokenizer_path(), words=20), tokenizer(tokenizer_path())
    rng = random.Random(1)
    for _ in range(30):
        text = " ".join("".join(rng.choice("abcdé.") for _ in range(rng.randint(1, 6))) for _ in range(30))
        assert small.ids(text).tolist() == large.ids(text).tolist()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 70_000), st.integers(0, 2**64 - 1)), max_size=600), st.integers(1, 6))
def test_simple8b_round_trip(values, times):
    ids = np.array(values * times, dtype=np.uint64)
    words, offsets = simple8b.encode(ids)
    assert np.array_equal(simple8b.decode(words, offsets, len(ids)), ids)


def test_simple8b_selectors_and_damage():
    assert len(simple8b.encode(np.zeros(240, np.uint64))[0]) == 1
    assert len(simple8b.encode(np.full(60, 1, np.uint64))[0]) == 1
    look_alike = np.array([2**64 - 1, int(simple8b._ESCAPE), 5], dtype=np.uint64)
    words, offsets = simple8b.encode(look_alike)
    assert np.array_equal(simple8b.decode(words, offsets, 3), look_alike)
    data = simple8b.pack_file(np.array([1]), np.array([3]), np.array([1, 2, 3], np.uint32))
    assert simple8b.unpack_file(data)[2].tolist() == [1, 2, 3]
    with pytest.raises(ValueError):
        simple8b.unpack_file(data[:-9] + b"x" + data[-8:])


def test_token_files_round_trip(spark, tmp_dir):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["cat", "Dog,", "sun.", "12"]) for _ in range(rng.randint(0, 50)))) for i in range(1500)]
    rows += [(2000, None), (2001, ""), (5, rows[5][1]), (None, "first of all")]
    df = spark.createDataFrame(rows, DOCS).repartition(6).withColumns({"start": F.lit("a"), "part": F.lit(1)})
    manifest = simple8b.write_token_files(df, f"file://{tmp_dir}/ids", ids_per_file=200)
    assert manifest.count() > 8 and len(listed(f"file://{tmp_dir}/ids", ".s8b")) == manifest.count()
    got = sorted(simple8b.read_token_files(manifest).collect(), key=lambda r: r.start)
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    t, start = tokenizer(tokenizer_path()), 0
    assert len(got) == len(rows)
    for r, (key, text) in zip(got, rows):
        ids = np.append(t.ids(text), 1).astype("<u4")
        assert (r.doc_id, r.start, r.n_tokens, bytes(r.ids)) == (key, start, len(ids), ids.tobytes())
        start += len(ids)
    assert simple8b.round_trip(df.where("false")).count() == 0


# --- WARC --------------------------------------------------------------------


def test_warc_round_trip(spark):
    tricky = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    pages = [(i, f"http://x/{i}", f"<p>{i % 7}</p>") for i in range(60)] + [(100, None, None), (101, "u", ""), (102, "u\nv", tricky), (1, "again", "<p>1</p>"), (None, "n", "<p>2</p>"), (103, "w", "é" * 70_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"digest": F.lit(1), "first": F.lit("x")})
    first = {}
    for i, _, html in pages:
        if i is not None:
            first[html or ""] = min(first.get(html or "", 1 << 60), i)
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(df).collect())
    want = Counter()
    for i, _, html in pages:
        body = (html or "").encode()
        lead = first[html or ""]
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        want[i, len(body), digest, "response" if i == lead else "revisit", None if i == lead else lead] += 1
    assert got == want
    large = warc.round_trip(df, min_revisit_bytes=1000).where("record_type = 'revisit'")
    assert large.count() == 0
    assert warc.round_trip(df.where("false")).count() == 0


def test_warc_ranges_and_pushdown(spark, tmp_dir):
    tricky = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 900000\r\n\r\nabc" * 3
    pages = [(i, "u", tricky + "y" * (i * 37 % 500)) for i in range(40)]
    warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1), f"file://{tmp_dir}/w")
    whole = warc.read_archives(spark, f"file://{tmp_dir}/w")
    for size in (100, 997, 5000):
        parts = spark.read.format("warc").option("rangeBytes", str(size)).load(f"file://{tmp_dir}/w")
        assert sorted((r.page_id, bytes(r.payload or b"")) for r in parts.collect()) == sorted((r.page_id, bytes(r.payload or b"")) for r in whole.collect())
    reader = warc.WarcReader({"path": f"file://{tmp_dir}/w", "payload": "false"})
    from pyspark.sql.datasource import EqualTo, GreaterThan

    left = list(reader.pushFilters([EqualTo(("page_id",), 7), GreaterThan(("page_id",), 3)]))
    assert len(left) == 1 and reader.tests == [("page_id", frozenset([7]))]
    rows = [r for p in reader.partitions() for r in reader.read(p)]
    assert [(r[3], r[7]) for r in rows] == [(7, None)]
    assert whole.where("record_type = 'revisit'").count() == 40 - len({p[2] for p in pages})


def test_truncated_archive_is_refused(spark, tmp_dir):
    import os

    os.makedirs(f"{tmp_dir}/t")
    body = warc.record(1, "u", b"abcdef", warc.payload_digest(b"abcdef"), None, False)
    with open(f"{tmp_dir}/t/part-0.warc", "wb") as f:
        f.write(body[:-9])
    reader = warc.WarcReader({"path": f"{tmp_dir}/t"})
    with pytest.raises(ValueError):
        [r for p in reader.partitions() for r in reader.read(p)]


# --- sharding ----------------------------------------------------------------


def naive_jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


def test_jump_hash_against_scalar_form():
    rng = random.Random(3)
    keys = np.array([0, 1, 2**64 - 1, *(rng.getrandbits(64) for _ in range(500))], dtype=np.uint64)
    for shards in (1, 2, 16, 17, 1000):
        assert sharding.jump_hash(keys, shards).tolist() == [naive_jump(int(k), shards) for k in keys]


def test_shards_slots_and_growth(spark):
    rows = [(i, f"té {i}" * (i % 4)) for i in range(500)] + [(7, "again"), (None, None), (600, "")]
    df = spark.createDataFrame(rows, DOCS).withColumns({"shard": F.lit("x"), "slot": F.lit("y"), "size": F.lit(0)})
    got = sharding.shard_documents(df, 16).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    by_shard = {}
    for r in got:
        assert r.grown_shard in (r.shard, 16)
        by_shard.setdefault(r.shard, []).append(r)
    for members in by_shard.values():
        assert sorted(r.slot for r in members) == list(range(len(members)))
        keys = [r.doc_id if r.doc_id is not None else -(10**9) for r in sorted(members, key=lambda r: r.slot)]
        assert keys == sorted(keys)
    assert 0.02 < sum(r.grown_shard == 16 for r in got) / len(got) < 0.12
    assert sharding.shard_documents(df.where("false")).count() == 0


# --- packing -----------------------------------------------------------------


def check_plan(plan, demand, capacity):
    held = Counter()
    for p, c in plan.items():
        assert c > 0 and sum(p) <= capacity and list(p) == sorted(p, reverse=True)
        for length in p:
            held[length] += c
    assert held == +demand


def test_genetic_steps_keep_every_piece():
    rng = np.random.default_rng(4)
    for trial in range(40):
        capacity = int(rng.integers(5, 60))
        demand = Counter(rng.integers(1, capacity + 1, int(rng.integers(1, 300))).tolist())
        a = packing.best_fit(demand, capacity)
        b = packing.mutate(a, capacity, 0.5, rng)
        c = packing.crossover(a, b, demand, capacity, 0.5, rng)
        best = packing.evolve([a, b], demand, capacity, packing.Settings(), trial)[0]
        for plan in (a, b, c, best):
            check_plan(plan, demand, capacity)
        assert packing.sequences(best) <= packing.sequences(a)


def test_search_beats_best_fit_where_it_can(spark):
    # Best fit, longest first, needs 3 sequences of 10 here; 5 + 3 + 2 twice needs 2.
    rng = random.Random(5)
    found = 0
    for _ in range(6):
        demand = Counter(rng.randint(20, 60) for _ in range(60))
        first = packing.sequences(packing.best_fit(demand, 100))
        best = packing.sequences(packing.search(spark, demand, 100))
        floor = -(-sum(k * n for k, n in demand.items()) // 100)
        assert floor <= best <= first
        found += best < first or best == floor
    assert found


def test_pack_places_all_pieces(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["cat", "dog", "sun"]) for _ in range(rng.randint(0, 90)))) for i in range(200)]
    rows += [(300, None), (301, ""), (302, "cat " * 700), (5, rows[5][1]), (None, "cat")]
    df = spark.createDataFrame(rows, DOCS).repartition(5).withColumns({"piece": F.lit("x"), "offset": F.lit("y")})
    pieces = packing.token_pieces(df, capacity=64, end_id=0)
    placed = packing.pack(pieces, capacity=64).collect()
    t = tokenizer(tokenizer_path())
    want = Counter()
    for key, text in rows:
        ids = np.append(t.ids(text), 0).astype("<u4")
        for k, a in enumerate(range(0, len(ids), 64)):
            want[key, k, a, ids[a : a + 64].tobytes()] += 1
    assert Counter((r.doc_id, r.piece, r.start, bytes(r.ids)) for r in placed) == want
    groups = {}
    for r in placed:
        groups.setdefault(r.sequence_id, []).append(r)
    for members in groups.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at and r.length * 4 == len(r.ids)
            at += r.length
        assert at <= 64
    total = sum(r.length for r in placed)
    assert len(groups) <= 1.02 * -(-total // 64) + 1
    stored = packing.packed_sequences(packing.pack(pieces, capacity=64)).collect()
    assert sum(len(r.ids) for r in stored) == 4 * total and all(len(r.ids) <= 256 for r in stored)
    assert packing.pack(packing.token_pieces(df.where("false"), capacity=64), capacity=64).count() == 0


def fewest_sequences(lengths, capacity):
    """Exact optimum, by trying all ways to place each piece."""
    best = len(lengths)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(lengths):
            best = len(rooms)
            return
        for i in range(len(rooms)):
            if rooms[i] >= lengths[k] and rooms[i] not in rooms[:i]:
                place(k + 1, [*rooms[:i], rooms[i] - lengths[k], *rooms[i + 1 :]])
        place(k + 1, [*rooms, capacity - lengths[k]])

    lengths = sorted(lengths, reverse=True)
    place(0, [])
    return best


def test_search_finds_the_optimum_of_small_cases(spark):
    rng = random.Random(3)
    s = packing.Settings()
    for _ in range(40):
        lengths = [rng.randint(15, 60) for _ in range(rng.randint(5, 11))]
        demand = Counter(lengths)
        people = [packing.evolve([packing.best_fit(demand, 100)], demand, 100, s, s.seed + i)[0] for i in range(s.islands)]
        assert all(packing._held(p) == demand for p in people)
        assert min(map(packing.sequences, people)) == fewest_sequences(lengths, 100)
    demand = Counter([44, 24, 24, 22, 21, 17, 8, 8, 6, 6] * 3)  # 9 full sequences of 60, which plain best fit does not find
    assert packing.sequences(packing.best_fit(demand, 60)) == 10
    found = packing.search(spark, demand, 60)
    assert packing._held(found) == demand and packing.sequences(found) == 9


def test_islands_are_partitions_of_their_own(spark):

    demand = Counter({30: 50, 45: 50, 36: 40})
    plan = packing.best_fit(demand, 100)
    for n in (1, 2):
        table = packing.island_table(spark, {i: [plan] * n for i in range(4)})
        assert [{r.island for r in part} for part in table.rdd.glom().collect()] == [{0}, {1}, {2}, {3}]
    found = packing.search(spark, demand, 100)
    assert packing._held(found) == demand and packing.sequences(found) <= packing.sequences(plan)


def test_files_of_attempts_that_did_not_count_are_not_read(spark, tmp_dir):
    pages = spark.createDataFrame([(i, f"http://u/{i}", f"<p>{i % 3}</p>") for i in range(20)], "page_id long, url string, html string")
    warc.write_archives(pages.repartition(3), f"{tmp_dir}/a")
    names = warc.manifest(f"{tmp_dir}/a")
    assert len(names) >= 1 and all(n.endswith(".warc") for n in names)
    with open(f"{tmp_dir}/a/{sorted(names)[0]}", "rb") as f:
        again = f.read()
    for lost in ("part-000000-000000-999.warc", "part-000009-000000-7.warc"):
        with open(f"{tmp_dir}/a/{lost}", "wb") as f:
            f.write(again)
    assert sorted(r.page_id for r in warc.read_archives(spark, f"{tmp_dir}/a").collect()) == list(range(20))
    with open(f"{tmp_dir}/plain.warc", "wb") as f:  # a folder without a manifest is read whole
        f.write(again)
    assert warc.read_archives(spark, tmp_dir).count() > 0
