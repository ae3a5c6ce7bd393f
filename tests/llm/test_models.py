"""Language profiles, the quality classifier, transcripts and the pipeline: brute force, held-out accuracy, defined cases."""

import random
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MID, SF_SMALL
from tracewright.llm import langid, quality, queries, transcripts

DOCS = "doc_id long, text string"


# --- language ----------------------------------------------------------------


def naive_grams(text):
    counts = Counter()
    for w in langid.words_of(text):
        marked = f"_{w}_"
        for n in (1, 2, 3):
            for i in range(len(marked) - n + 1):
                g = marked[i : i + n]
                if g != "_":
                    code = 0
                    for c in g:
                        code = code << 21 | ord(c)
                    counts[code] += n > 0
    return counts


def test_profiles_and_distances_against_brute_force(spark):
    rng = random.Random(1)
    letters = {"aa": "abcde", "bb": "defgh", "cc": "éñxyz"}
    rows = [(lang, " ".join("".join(rng.choice(abc) for _ in range(rng.randint(1, 7))) for _ in range(20))) for lang, abc in letters.items() for _ in range(10)]
    df = spark.createDataFrame([*rows, (None, "skipped"), ("aa", None)], "lang string, text string").repartition(4)
    got = langid.learn_profiles(df)
    want = {}
    for lang in letters:
        total = sum((naive_grams(t) for k, t in rows if k == lang), Counter())
        want[lang] = [g for g, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))][: langid.PROFILE]
    assert got == want
    model = langid.Identifier(got)
    for _, text in rows[::3] + [("", "abc xyz ñ"), ("", "中文 only")]:
        mine = [g for g, _ in sorted(naive_grams(text).items(), key=lambda x: (-x[1], x[0]))][: langid.PROFILE]
        far = {lang: sum(abs(i - p.index(g)) if g in p else langid.PROFILE for i, g in enumerate(mine)) for lang, p in want.items()}
        best = min(sorted(far), key=far.get)
        assert model.predict(text) == (best, pytest.approx(1 - far[best] / (langid.PROFILE * len(mine))))


def test_language_defined_cases(spark):
    rows = [(1, None), (2, ""), (3, "12 !! ___ 3"), (4, "abc"), (4, "abc")]
    df = spark.createDataFrame(rows, DOCS).withColumns({"lang_pred": F.lit(1), "score": F.lit("x")})
    profiles = langid.learn_profiles(spark.createDataFrame([("xx", "abc abd")], "lang string, text string"))
    got = [tuple(r.p) for r in df.select(langid.predicted(F.col("text"), profiles).alias("p")).collect()]
    assert got[:3] == [("und", 0.0)] * 3 and got[3] == got[4] and got[3][0] == "xx"
    nothing = langid.learn_profiles(spark.createDataFrame([], "lang string, text string"))
    assert nothing == {} and langid.Identifier(nothing).predict("abc") == ("und", 0.0)


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang")
    got = queries.op6_language(spark, SF_MID).join(docs, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("a"), F.count("*").alias("n")).first()
    assert got.n > 200 and got.a > 0.97


def test_language_stage_rejects_texts_that_no_profile_knows(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = ["这是一个没有任何语言模型的文本", "Это текст на языке без профиля", "123 456", None]
    foreign = spark.createDataFrame([(10_000 + k, t) for k, t in enumerate(texts)], DOCS)
    kept = corpus_pipeline.language(spark, docs.unionByName(foreign, allowMissingColumns=True), SF_SMALL)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
    scores = spark.createDataFrame([(0.1,), *[(0.6,)] * 150], "score double")
    assert langid.score_floor(scores) == 0.3 and langid.score_floor(scores.where("false")) == 0.0


# --- quality -----------------------------------------------------------------


def test_word_shares_give_the_same_score_as_the_average():
    s = quality.Settings(buckets=256, width=4, epochs=3)
    rng = random.Random(2)
    good = [" ".join(rng.choice(["cat", "dog", "sun"]) for _ in range(9)) for _ in range(60)]
    bad = [" ".join(rng.choice(["$$$", "!!!", "cat"]) for _ in range(9)) for _ in range(60)]
    m = quality.train(good + bad, [1] * 60 + [0] * 60, s)
    scorer = quality.Scorer(m.word_parts(), float(m.bias[1] - m.bias[0]), s)
    for text in [good[0], bad[0], "cat cat", "new words", ""]:
        words = text.split()
        ids = sum((quality.features(w, s) for w in words), []) + [quality.again(s)] * quality.repeats(words)
        hidden = m.vectors[ids].mean(axis=0) if ids else np.zeros(s.width)
        out = hidden @ m.layer + m.bias
        assert scorer.score(text) == pytest.approx(float(np.exp(out[1]) / np.exp(out).sum()), rel=1e-3)
    assert scorer.score(good[1]) > 0.9 > 0.1 > scorer.score(bad[1])


def test_the_order_of_words_counts():
    s = quality.Settings(buckets=4096, epochs=20, pairs=True)
    ring = ["cat", "dog", "sun", "hat", "box"]
    rng = random.Random(6)
    turned = lambda words: " ".join([*words[(k := rng.randrange(5)) :], *words[:k]] * rng.randint(2, 4))
    good, bad = [turned(ring) for _ in range(60)], [turned(ring[::-1]) for _ in range(60)]
    m = quality.train(good + bad, [1] * 60 + [0] * 60, s)
    scorer = quality.Scorer(m.word_parts(), float(m.bias[1] - m.bias[0]), s)
    assert min(map(scorer.score, good)) > 0.5 > max(map(scorer.score, bad))
    words = good[0].split()
    ids = [*sum((quality.features(w, s) for w in words), []), *quality.pair_buckets(np.array([quality.word_hash(w) for w in words]), s)]
    out = m.vectors[ids].mean(axis=0) @ m.layer + m.bias
    assert scorer.score(good[0]) == pytest.approx(float(np.exp(out[1]) / np.exp(out).sum()), rel=1e-3)


def test_quality_defined_cases(spark):
    docs = spark.createDataFrame([(1, "fine words here"), (2, "$$$ !!!"), (3, None), (4, ""), (1, "fine words here")], DOCS).withColumn("label", F.lit("x"))
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 1), (9, 0), (4, None), (None, 1), (2, 7)], "doc_id long, label int")
    model = quality.fit(docs, labels, quality.Settings(buckets=1024, width=4))
    got = [r.s for r in docs.select(quality.scored(F.col("text"), model).alias("s")).collect()]
    assert all(0 <= s <= 1 for s in got) and got[0] == got[4] and got[2] == got[3] and got[0] > got[1]
    untrained = quality.fit(docs, labels.where("false"))
    assert [r.s for r in docs.select(quality.scored(F.col("text"), untrained).alias("s")).collect()] == [0.5] * 5
    assert docs.where("false").select(quality.scored(F.col("text"), model)).count() == 0


def test_quality_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet").select("doc_id", "quality")
    got = queries.op5_quality(spark, SF_MID).join(labels, "doc_id").where("held_out")
    r = got.agg(F.avg((F.col("quality") == F.col("predicted")).cast("double")).alias("a"), F.count("*").alias("n")).first()
    assert r.n > 60 and r.a > 0.95


# --- transcripts -------------------------------------------------------------


def naive_viterbi(model, lines):
    """Score of the best path, by trying all."""
    best = -np.inf
    for path in product(range(len(model.states)), repeat=len(lines)):
        score = model.start[path[0]]
        for k, s in enumerate(path):
            score += model.scores(lines[k], k == 0)[s] + (model.move[path[k - 1], s] if k else 0)
        best = max(best, score)
    return best


def path_score(model, lines, path):
    place = {s: i for i, s in enumerate(model.states)}
    states = [place[p] for p in path]
    score = model.start[states[0]]
    for k, s in enumerate(states):
        score += model.scores(lines[k], k == 0)[s] + (model.move[states[k - 1], s] if k else 0)
    return score


@pytest.fixture()
def toy_model():
    c = Counter
    t, f = True, False
    starts = c({("user", t): 8, ("bot", t): 2})
    moves = c({(("user", t), ("user", f)): 3, (("user", t), ("bot", t)): 6, (("bot", t), ("bot", f)): 9, (("bot", f), ("user", t)): 5, (("bot", f), ("bot", f)): 4})
    emits = c({(("user", t), "m:user"): 7, (("bot", t), "m:assistant"): 6, (("user", t), "m:none"): 3, (("bot", f), "m:none"): 9, (("user", t), "e:?"): 5, (("bot", f), "e:."): 8, (("user", t), "n:1"): 4})
    return transcripts.smoothed(["bot", "user"], starts, moves, emits)


@pytest.mark.parametrize("segment", [2, 3, 1024])
def test_decoding_by_segments_finds_a_best_path(spark, monkeypatch, toy_model, segment):
    monkeypatch.setattr(transcripts, "SEGMENT", segment)
    rng = random.Random(3)
    rows = []
    for conv in range(6):
        rows += [(str(conv), k, rng.choice(["User: hi?", "Assistant: yes.", "and so on.", "", None, "what?"])) for k in range(rng.randint(1, 7))]
    df = spark.createDataFrame(rows, "conv string, line long, text string").repartition(3)
    got = {}
    for r in transcripts.decode(df, toy_model).collect():
        got.setdefault(r.conv, []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    for conv, found in got.items():
        found.sort(key=lambda r: r.line)
        lines = [r.text for r in found]
        assert lines == [t for c, _, t in rows if c == conv]
        assert path_score(toy_model, lines, [(r.role, r.first) for r in found]) == pytest.approx(naive_viterbi(toy_model, lines))


def test_counts_do_not_depend_on_segments(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(str(c), k, f"{rng.choice(['User:', ''])} w", rng.choice(["user", "assistant"]), rng.random() < 0.5) for c in range(4) for k in range(9)]
    df = spark.createDataFrame([*rows, ("z", 1, "x", None, True)], "conv string, line long, text string, role string, first boolean")
    models = []
    for segment in (1, 4, 1024):
        monkeypatch.setattr(transcripts, "SEGMENT", segment)
        models.append(transcripts.fit(df))
    for m in models[1:]:
        assert m.states == models[0].states and np.array_equal(m.move, models[0].move) and np.array_equal(m.start, models[0].start)
        assert m.emit.keys() == models[0].emit.keys() and all(np.array_equal(m.emit[k], models[0].emit[k]) for k in m.emit)


def test_a_long_transcript_is_dealt_to_many_tasks(spark, monkeypatch, toy_model):
    """Turns of one line each, as the query numbers them: segments go across turns, and no task of any round holds the transcript."""
    rng = random.Random(5)
    turns = [("7", k, rng.choice(["user", "assistant"]), rng.choice(["hi?", "yes.", "and so on.", ""])) for k in range(300)] + [("8", 0, "user", "x")]
    lines = transcripts.raw_lines(spark.createDataFrame(turns, "conv_id string, turn long, role string, text string")).repartition(5).cache()
    whole = transcripts.decode(lines, toy_model).orderBy("conv", "turn", "line").collect()
    held = [(r.conv, r.line, r.text) for r in whole if r.conv == "7"]
    front, came = None, []
    for k, (_, _, text) in enumerate(held):
        front, way = ((toy_model.start + toy_model.scores(text, True))[None, :], None) if not k else transcripts.advance(toy_model, front, text, False)
        came.append(way)
    path = [(r.role, r.first) for r in whole if r.conv == "7"]
    assert path_score(toy_model, [t for *_, t in held], path) == pytest.approx(front.max())
    places = transcripts.numbered(lines).orderBy("conv", "turn", "line").collect()
    assert [r["at"] for r in places] == [*range(len(held)), *range(len(places) - len(held))] and len(held) >= 300

    monkeypatch.setattr(transcripts, "SEGMENT", 8)
    monkeypatch.setattr(transcripts, "FAN", 4)
    rounds, write = [], transcripts.stored

    def counted(df, name):
        out = write(df, name)
        if name == "transcript-matrices":
            rounds.append(out.where("conv = '7'").count())
        return out

    monkeypatch.setattr(transcripts, "stored", counted)
    again = transcripts.decode(lines, toy_model).orderBy("conv", "turn", "line").collect()
    want = [-(-len(held) // 8)]  # segments of 8 lines, then runs of 4
    while want[-1] > 4:
        want.append(-(-want[-1] // 4))
    assert rounds == want and len(want) > 2
    assert path_score(toy_model, [t for *_, t in held], [(r.role, r.first) for r in again if r.conv == "7"]) == pytest.approx(front.max())


def test_markers():
    assert transcripts.marker("User: hello") == ("user", 6)
    assert transcripts.marker("### Assistant") == ("assistant", 13)
    assert transcripts.marker("<|system|>\nx")[0] == "system"
    assert transcripts.marker("[USER] x") == ("user", 7) and transcripts.marker("Note: x") == ("none", 0)
    assert transcripts.marker("") == ("none", 0)


def test_transcript_defined_cases(spark, toy_model):
    rows = [(None, None, None), (None, 1, "User: a"), ("a", 1, "x"), ("a", 1, "x"), ("b", None, "y")]
    df = spark.createDataFrame(rows, "conv string, line long, text string").withColumns({"role": F.lit(1), "seg": F.lit("x"), "opens": F.lit(2)})
    out = transcripts.rendered(transcripts.decode(df, toy_model)).collect()
    assert len(out) == len(rows)
    assert all(("<|" in r.piece) == r.first for r in out)
    empty = df.where("false")
    assert transcripts.decode(empty, toy_model).count() == 0
    assert transcripts.fit(empty.select("conv", "line", "text", F.lit("u").alias("role"), F.lit(True).alias("first"))).states[0] == ("user", True)


def test_lines_of_any_turns_keep_their_order(spark, toy_model):
    """Two rows of one turn, equal rows, null and huge turns, and a turn of very many lines."""
    far, many = 2**43, "\n".join(f"l{i}" for i in range(3000))
    rows = [(1, 5, "user", "a1\na2\na3"), (1, 5, "user", "b1\nb2\nb3"), (1, far, "user", "c1\nc2"), (1, None, "user", "n1\nn2")]
    rows += [(1, 6, "user", "e1\ne2")] * 3 + [(1, 4, "user", many), (None, 1, None, None)]
    lines = transcripts.raw_lines(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)).cache()
    placed = transcripts.numbered(lines).where("conv = '1'").orderBy("at").collect()
    texts = [r.text.split(" ")[-1].split("\t")[-1] for r in placed if not r.text.startswith("###")]
    pairs = [["a1", "a2", "a3"], ["b1", "b2", "b3"]]
    between = texts[3002:3008]
    assert texts[:2] == ["n1", "n2"] and texts[2:3002] == many.split("\n")
    assert between in (sum(pairs, []), sum(reversed(pairs), []))
    assert texts[3008:] == ["e1", "e2"] * 3 + ["c1", "c2"]
    found = transcripts.decode(transcripts.numbered(lines), toy_model)
    assert found.count() == lines.count() and found.where(f"turn = {far}").count() == lines.where(f"turn = {far}").count()
    assert found.where("turn is null").count() == lines.where("turn is null").count() > 0


def test_chat_held_out_accuracy(spark):
    turns = spark.read.parquet(f"{SF_MID}/conversations.parquet").select("conv_id", "turn", "role")
    got = queries.op10_chat(spark, SF_MID)
    assert got.count() == transcripts.raw_lines(spark.read.parquet(f"{SF_MID}/conversations.parquet")).count()
    r = got.where("held_out").join(turns, ["conv_id", "turn"]).agg(F.avg((F.col("role") == F.col("role_pred")).cast("double")).alias("a")).first()
    assert r.a > 0.85


def test_numbers_that_are_no_digits_are_no_letters(spark):
    profiles = {"aa": [ord("a")], "bb": [ord("b")]}
    identifier = langid.Identifier(profiles)
    for text in ("½ ²", "①②", "Ⅷ", "12 3", "_ _", "", None):
        assert identifier.predict(text) == ("und", 0.0)
    assert langid.words_of("m² Ⅷb ab½cd é") == ["m", "b", "ab", "cd", "é"]


def test_training_does_not_depend_on_the_order_of_rows(spark):
    rng = random.Random(6)
    docs = [(i, f"good fine text number {i} {rng.random()}" if i % 2 else f"bad bad junk {i} {rng.random()}") for i in range(60)]
    docs += [(i, f"another text of {i}") for i in range(0, 60, 3)]
    labels = [(i, i % 2) for i in range(60)] + [(i, 1 - i % 2) for i in range(0, 60, 5)] + [(1000 + i, 1) for i in range(500)]
    s = quality.Settings(pairs=True, sample_docs=40)
    models = []
    for seed in range(3):
        rng.shuffle(docs)
        rng.shuffle(labels)
        of = lambda rows, kind: spark.createDataFrame(rows, kind).repartition(1 + seed)  # noqa: B023, E731
        models.append(quality.fit(of(docs, DOCS), of(labels, "doc_id long, label int"), s))
    assert all(np.array_equal(m.vectors, models[0].vectors) and np.array_equal(m.layer, models[0].layer) for m in models)
    assert np.abs(models[0].vectors).sum() > 0  # labels without documents do not crowd out the others


def test_columns_of_documents_stay_whatever_their_names(spark):
    from tracewright.llm import simhash

    rows = [(1, "a b c d e", "x", 1.0, "y"), (1, "a b c d e", "x", 1.0, "y"), (2, "a b c d e", "z", 2.0, "w"), (3, "other words are here", "q", 3.0, "r")]
    for some in (rows, rows[1:]):  # with and without repeated ids
        docs = spark.createDataFrame(some, "doc_id long, text string, __fp string, fp double, row string")
        kept = simhash.keep_one(docs)
        assert kept.columns == docs.columns
        assert sorted(tuple(r) for r in kept.collect()) == [rows[0], rows[3]]


# --- pipeline ----------------------------------------------------------------


def test_pipeline_stages_against_brute_force(spark):
    import corpus_pipeline
    from tracewright.llm import decontam, simhash

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    extra = spark.createDataFrame([(10_000, None, None, None, None), (10_001, "", None, None, 0), (10_002, "123 456", "en", "s", 7)], docs.schema)
    current = docs.unionByName(extra).withColumn("score", F.lit("clash"))
    columns = current.columns
    profiles = langid.Identifier(queries.language_profiles(spark, SF_SMALL))
    model = queries.quality_model(spark, SF_SMALL)
    scorer = quality.Scorer(model.word_parts(), float(model.bias[1] - model.bias[0]), model.settings)
    items = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in current.collect()}
        current = stage(spark, current, SF_SMALL)
        assert current.columns == columns
        after = {r.doc_id for r in current.collect()}
        if name == "language_id":
            want = {k for k, t in before.items() if profiles.predict(t)[0] != "und"}
        elif name == "quality_classifier":
            want = {k for k, t in before.items() if scorer.score(t) >= 0.7}
        elif name == "simhash_near_dedup":
            keys = sorted(before)
            prints = [simhash.simhash(before[k].encode()) for k in keys]
            root = list(range(len(keys)))
            for i in range(len(keys)):
                for j in range(i):
                    if (prints[i] ^ prints[j]).bit_count() <= 4 and root[i] != root[j]:
                        low, high = sorted((root[i], root[j]))
                        root = [low if r == high else r for r in root]
            want = {keys[r] for r in root}
        else:
            held = [decontam.plain(t) for t in items]
            exact = {k for k, t in before.items() if any(i in decontam.plain(t) for i in held)}
            want = after
            assert not exact & after and len(before) - len(after) <= len(exact) + 2
        assert after == want, name
    packed = corpus_pipeline.STAGES[-1][1](spark, current, SF_SMALL)
    assert {r.doc_id for r in packed.collect()} == after
    assert corpus_pipeline.run(spark, SF_SMALL).count() == packed.count()
