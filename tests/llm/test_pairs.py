"""SimHash, components, SpotSigs and decontamination against brute force, with their defined cases."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tracewright.llm import decontam, simhash, spotsigs
from tracewright.llm.components import component_labels

DOCS = "doc_id long, text string"


def naive_simhash(text):
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def naive_components(values, near):
    """Smallest index reachable, for each index."""
    root = list(range(len(values)))
    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                a, b = root[i], root[j]
                if a != b:
                    root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def test_simhash_of_texts():
    rng = random.Random(1)
    texts = [None, "", " \t\n", "one", "A b\x0bC", "É É é a", "x " * 5000]
    texts += [" ".join(rng.choice("ab cd ef gh".split()) for _ in range(rng.randint(1, 40))) for _ in range(50)]
    for t in texts:
        assert simhash.simhash(None if t is None else t.encode()) == naive_simhash(t)


@pytest.mark.parametrize("chunk", [3, 4096])
def test_links_keep_every_component(spark, chunk):
    rng = random.Random(2)
    values = [rng.getrandbits(64) for _ in range(40)]
    for _ in range(160):  # near copies, chains of near copies, and pairs just too far apart
        v = rng.choice(values)
        for b in rng.sample(range(64), rng.choice([1, 2, 4, 5])):
            v ^= 1 << b
        values.append(v)
    values = sorted(set(values))
    signed = [simhash._signed(v) for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = {r.node: r.label for r in component_labels(simhash.links(fps, 4, chunk=chunk)).collect()}
    root = naive_components(values, lambda a, b: (a ^ b).bit_count() <= 4)
    groups = {}
    for v, r in zip(signed, root):
        groups.setdefault(r, set()).add(v)
    for members in groups.values():
        labels = {found.get(v, v) for v in members}
        assert len(labels) == 1 and labels <= members
    assert len({found.get(v, v) for v in signed}) == len(groups)


def test_every_close_pair_shares_blocks():
    rng = random.Random(3)
    masks = simhash.block_masks(4, 2)
    for _ in range(500):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 4):
            b ^= 1 << bit
        assert any(a & m == b & m for m in masks)


def test_components_of_paths_and_stars(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7)]
    edges += [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(30)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(7)
    found = {r.node: r.label for r in component_labels(df).collect()}
    nodes = sorted({x for e in edges for x in e})
    linked = {frozenset(e) for e in edges}
    root = naive_components(nodes, lambda a, b: frozenset((a, b)) in linked)
    for n, r in zip(nodes, root):
        assert found.get(n, n) == nodes[r]


def test_one_row_of_a_component_stays_if_ids_repeat(spark):
    rng = random.Random(10)
    bits = lambda a, b: (simhash.simhash(a.encode()) ^ simhash.simhash(b.encode())).bit_count()

    def near_copies():
        words = [f"w{rng.randrange(10**6)}" for _ in range(400)]
        text = " ".join(words)
        copies = (" ".join([*words[:k], "other", *words[k + 1 :]]) for k in range(400))
        return text, next(c for c in copies if 1 <= bits(text, c) <= 4)

    (a, b), (c, d), (e, f) = near_copies(), near_copies(), near_copies()
    rows = [(1, a), (1, b), (1, a), (None, c), (None, d), (2, e), (None, f), (1, "far from all of them")]
    kept = [(r.doc_id, r.text) for r in simhash.keep_one(spark.createDataFrame(rows, DOCS)).collect()]
    assert len(kept) == 4 and (2, e) in kept and (1, "far from all of them") in kept
    assert sum(k in ((1, a), (1, b)) for k in kept) == 1 and sum(k in ((None, c), (None, d)) for k in kept) == 1


def test_near_duplicates_defined_cases(spark):
    body = " ".join(f"w{i}" for i in range(60))
    rows = [(5, body), (3, body), (9, None), (8, ""), (7, "alone and different"), (7, "alone and different"), (None, body)]
    df = spark.createDataFrame(rows, DOCS).withColumns({"fp": F.lit("x"), "component_id": F.lit(1), "label": F.lit(2)})
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.component_id) for r in simhash.near_duplicates(df).collect())
    assert got == [(-1, 3), (3, 3), (5, 3), (7, 7), (7, 7), (8, 8), (9, 8)]
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 7, 8]
    empty = spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


# --- SpotSigs ----------------------------------------------------------------


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_signatures_are_chains_after_anchors():
    found = spotsigs.signatures("The cat sat on a mat.\nMat alone")
    chains = ["^ cat sat", "the cat sat", "on mat", "a mat", "^ mat alone"]
    assert sorted(found.tolist()) == sorted(xxhash.xxh64_intdigest(c) for c in chains)
    assert len(spotsigs.signatures(None)) == 0 and len(spotsigs.signatures("the of")) == 0
    assert spotsigs.from_text(spotsigs.as_text(found)).tolist() == found.tolist()


def test_likeness_is_jaccard_and_prunes():
    rng = random.Random(5)
    for _ in range(200):
        a, b = ({rng.randint(0, 30) for _ in range(rng.randint(0, 20))} for _ in range(2))
        x, y = (np.array(sorted(s), dtype=np.uint64) for s in (a, b))
        want = jaccard(a, b)
        assert spotsigs.likeness(x, y) == pytest.approx(want)
        assert spotsigs.likeness(x, y, 0.5) == pytest.approx(want if want >= 0.5 else 0.0)


def test_neighbours_against_brute_force(spark):
    rng = random.Random(6)
    words = "the of and in cat dog sun moon tree bird la de und die".split()
    rows = [(i * 3 - 20, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(80)]
    rows[10], rows[20] = (10, None), (40, "x" * 200_000)
    rows[31] = (rows[31][0], rows[30][1])
    df = spark.createDataFrame(rows, DOCS).repartition(5).withColumns({"range": F.lit("a"), "key": F.lit(1), "home": F.lit(2)})
    got = {r.doc_id: r for r in spotsigs.neighbour_fingerprints(df).collect()}
    rows.sort()
    assert sorted(got) == [r[0] for r in rows]
    for i, (key, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        a, b, c = (set(spotsigs.signatures(t).tolist()) for t in (text, changed, after))
        r = got[key]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert r.near_edited == pytest.approx(jaccard(a, b)) and r.near_next == pytest.approx(jaccard(a, c))
        assert r.fingerprint == spotsigs.as_text(spotsigs.signatures(text))


def test_neighbours_of_few_repeated_and_no_rows(spark):
    one = spark.createDataFrame([(1, "the cat sat")], DOCS)
    r = spotsigs.neighbour_fingerprints(one).first()
    assert r.near_next == 1.0 and r.n_chars == 11
    twice = spark.createDataFrame([(1, "the cat"), (1, "the cat"), (None, None)], DOCS)
    assert spotsigs.neighbour_fingerprints(twice).count() == 3
    assert spotsigs.neighbour_fingerprints(spark.createDataFrame([], DOCS)).count() == 0


def test_similar_documents_against_brute_force(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        if rows and rng.random() < 0.6:
            text = rng.choice(rows)[1].split()
            for _ in range(rng.randint(0, 6)):
                text[rng.randrange(len(text))] = rng.choice(words)
        else:
            text = [w for _ in range(rng.randint(5, 60)) for w in ("the", rng.choice(words))]
        rows.append((i, " ".join(text)))
    rows += [(100, None), (101, "")]
    got = {r.doc_id: r for r in spotsigs.similar_documents(spark.createDataFrame(rows, DOCS), 0.8).collect()}
    sets = [frozenset(spotsigs.signatures(t).tolist()) for _, t in rows]
    root = naive_components(sets, lambda a, b: jaccard(a, b) >= 0.8)
    for i, (key, _) in enumerate(rows):
        assert got[key].class_id == rows[root[i]][0]
        assert got[key].links == len({s for s in sets if s != sets[i] and jaccard(s, sets[i]) >= 0.8})


# --- decontamination ---------------------------------------------------------


def edits_of_best_place(item, text):
    """Least edits of ``item`` against any part of ``text``."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        prev, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            prev, row[j] = row[j], min(prev + (a != b), row[j] + 1, row[j - 1] + 1)
    return min(row)


def test_matches_against_brute_force(spark):
    rng = random.Random(8)
    make = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))
    items = [(k, make(rng.randint(8, 30))) for k in range(12)]
    docs = []
    for i in range(60):
        text = make(rng.randint(0, 60))
        if rng.random() < 0.7:
            part = list(rng.choice(items)[1])
            for _ in range(rng.randint(0, 9)):
                at, kind = rng.randrange(len(part)), rng.random()
                part[at : at + 1] = [] if kind < 0.3 else [part[at], rng.choice("xyz")] if kind < 0.6 else [rng.choice("xyz")]
            text = f"{text} {''.join(part).upper()}, {make(3)}"
        docs.append((i, text))
    s = decontam.Settings()
    df, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.part): r for r in decontam.matches(df, bench).collect()}
    parts = 0
    for key, text in docs:
        for item, passage in items:
            whole = (key, item, 0) in got
            for part, p in enumerate(decontam.windows(decontam.plain(passage), s)):
                budget = int(s.rate * len(p)) if len(p) >= s.shortest else 0
                least = edits_of_best_place(p, decontam.plain(text))
                there = (key, item, part) in got
                assert there == (least <= budget and not (part and whole)), (key, item, part, least, budget)
                if there:
                    r = got[key, item, part]
                    parts += part > 0
                    assert r.edits == least
                    assert abs(len(decontam.plain(text[r.start : r.stop])) - len(p)) <= budget
    assert parts > 0
    kept = {r.doc_id for r in decontam.without_matches(df, bench).collect()}
    assert kept == {k for k, _ in docs} - {k for k, *_ in got}


def test_decontamination_defined_cases(spark):
    bench = spark.createDataFrame([(1, "Short one"), (2, None), (3, "..."), (4, "q"), (1, "Short one")], "item_id int, text string")
    rows = [(1, "a SHORT, one!"), (1, "a SHORT, one!"), (2, None), (3, ""), (None, "short one q"), (5, "shorter ones")]
    df = spark.createDataFrame(rows, DOCS).withColumn("item_id", F.lit("clash"))
    got = sorted((r.doc_id or 0, r.item_id, r.start, r.stop) for r in decontam.matches(df, bench).collect())
    assert got == [(0, 1, 0, 9), (0, 4, 10, 11), (1, 1, 2, 12), (1, 1, 2, 12)]
    assert sorted(r.doc_id for r in decontam.without_matches(df, bench).collect()) == [2, 3, 5]
    none = bench.where("false")
    assert decontam.matches(df, none).count() == 0 and decontam.without_matches(df, none).count() == len(rows)
    assert decontam.matches(df.where("false"), bench).count() == 0


def test_long_items_are_found_by_parts_and_in_blocks(spark):
    rng = random.Random(9)
    long_item = " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300))
    bench = spark.createDataFrame([(1, long_item), (2, long_item[::-1])], "item_id long, text string")
    df = spark.createDataFrame([(1, "x " * 40 + long_item[500:1200]), (2, "y " * 900)], DOCS)
    small = decontam.Settings(block_chars=1000, batch_chars=300)
    assert {(r.doc_id, r.item_id) for r in decontam.matches(df, bench, small).collect()} == {(1, 1)}
    assert [r.doc_id for r in decontam.without_matches(df, bench, small).collect()] == [2]


def words_of(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))


def test_parts_of_short_items_are_found(spark):
    rng = random.Random(11)
    item, short, least = words_of(rng, 67), words_of(rng, 30), words_of(rng, 12)  # 401, 179 and 71 characters
    bench = spark.createDataFrame([(1, item), (2, short), (3, least)], "item_id long, text string")
    texts = [f"{words_of(rng, 20)} {item[a : a + 320]} {words_of(rng, 20)}" for a in (0, 37, 81)]
    texts += [item, f"{words_of(rng, 9)} {item[:150]} {words_of(rng, 9)}", short, short[20:164], words_of(rng, 90), least, least[:60]]
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    got = {(r.doc_id, r.item_id, r.part) for r in decontam.matches(df, bench).collect()}
    assert {(k, i) for k, i, _ in got} == {(0, 1), (1, 1), (2, 1), (3, 1), (5, 2), (6, 2), (8, 3)}
    assert all((part == 0) == (key in (3, 5, 8)) for key, _, part in got)  # an item found whole is one row
    assert sorted(r.doc_id for r in decontam.without_matches(df, bench).collect()) == [4, 7, 9]


def test_quotes_of_items_of_every_length_are_found():
    """80 % of an item, from 75 characters on, and one and a half windows of a long one; a few words are changed."""
    rng = random.Random(13)
    s = decontam.Settings()
    missed = asked = 0
    for n in [*range(75, 540, 5), 511, 512, 513, 520, 700, 1023, 1024, 1025, 1400, 3000]:
        item = decontam.plain(words_of(rng, n // 5))[:n].strip()
        size = min(-(-len(item) * 4 // 5), s.window * 3 // 2)
        texts = []
        for _ in range(4):
            at = rng.randint(0, len(item) - size)
            quote = list(item[at : at + size])
            for _ in range(size // 100):
                quote[rng.randrange(size)] = "z"
            texts.append(decontam.plain(f"{words_of(rng, 20)} {''.join(quote)} {words_of(rng, 20)}"))
        found = {t for t, *_ in decontam.Index([(1, item)], s).search([*texts, words_of(rng, 200)])}
        assert 4 not in found
        asked, missed = asked + 4, missed + 4 - len(found)
    assert missed <= 0.1 * asked
    exact = decontam.Index([(1, item)], s)
    assert {t for t, *_ in exact.search([item[a : a + 768] for a in range(0, len(item) - 768, 97)], any_one=True)} == set(range(-(-(len(item) - 768) // 97)))


@pytest.mark.parametrize("token, text", [("0 ", "0 " * 500_000), ("ab ab ", "ab " * 200_000), ("0 0 0 1 ", "0 " * 300_000), ("xyz ", "a" * 400_000)])
def test_repetitive_texts_cost_as_much_as_others(token, text):
    import time
    import tracemalloc

    index = decontam.Index([(1, decontam.plain(token * 100))], decontam.Settings())
    plain = decontam.plain(text)
    tracemalloc.start()
    began = time.process_time()
    found = list(index.search([plain]))
    taken, most = time.process_time() - began, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {(f[0], f[2]) for f in found} == ({(0, 0)} if decontam.plain(token * 100) in plain else set())
    assert taken < 30 and most < 500e6


def test_plain_form_is_letters_and_digits_with_single_spaces():
    import re

    def whole(text):
        return re.sub(r"[\W_]+", " ", text.lower()).strip()

    signs = [chr(i) for i in [*range(0x250), 0x130, 0x2028, 0x3000, 0x660, 0x1F600]]
    rng = random.Random(3)
    texts = [f"a{c}B" for c in signs] + ["".join(rng.choices(signs if k % 2 else signs[:128], k=9)) for k in range(2000)]
    assert [decontam.plain(t) for t in texts] == [whole(t) for t in texts]
    assert decontam.plain(None) == decontam.plain("") == decontam.plain(" _-") == ""


def test_bands_counted_in_parts_are_those_counted_at_once():
    rng = random.Random(4)
    words = ["".join(rng.choices("abc", k=4)) for _ in range(12)]
    items = [(i, " ".join(rng.choices(words, k=40))) for i in range(5)]
    texts = [" ".join(rng.choices(words, k=80)) + " " + items[i % 5][1] for i in range(6)] + ["zzzzzzzz " * 20]
    found = [list(decontam.Index(items, decontam.Settings(entries=n)).search(texts)) for n in (7, 500_000)]
    assert found[0] == found[1] and {f[0] for f in found[0]} == set(range(6))
    assert not list(decontam.Index(items, decontam.Settings()).search(["zzzzzzzz " * 20]))


def test_links_of_many_partitions_need_few_rounds(spark, monkeypatch):
    from tracewright.llm import components

    n, written = 2000, []
    path = [(i, i + 1) for i in range(n)] + [(n + 10, n + 11)]
    random.Random(5).shuffle(path)
    kept = components.stored
    monkeypatch.setattr(components, "stored", lambda df, name: written.append(name) or kept(df, name))
    found = component_labels(spark.createDataFrame(path, "a long, b long").repartition(16))
    assert {r.node: r.label for r in found.collect()} == {i: 0 for i in range(n + 1)} | {n + 10: n + 10, n + 11: n + 10}
    assert len(written) <= 14
