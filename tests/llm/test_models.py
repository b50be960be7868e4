"""The learned operators: their smoothing by hand, and their accuracy on held-out rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tributary.llm import charlm, langid
from tributary.llm.langid import identify, letters
from tributary.llm.quality import ORDER, classify, drop_poor, evened
from tributary.llm.toxicity import CASCADE, FEATURES, SYMBOLS, Grammar, Reader, composed, drop_toxic, score_documents

SF = "/root/testdata/sf0.01"


def plain_model(texts, order):
    """Interpolated modified Kneser-Ney probabilities of one class, straight from the definition."""
    top = Counter()
    for t in texts:
        stream = charlm.BEGIN * (order - 1) + t + charlm.END
        top.update(stream[i : i + order] for i in range(len(t) + 1))
    tables = {order: top}
    raw = {order: top}
    for n in range(order - 1, 0, -1):
        kinds, sums = Counter(g[1:] for g in tables[n + 1]), Counter()
        for g, c in raw[n + 1].items():
            sums[g[1:]] += c
        raw[n] = sums
        tables[n] = Counter({g: sums[g] if g.startswith(charlm.BEGIN) else kinds[g] for g in kinds})

    def discounts(t):
        n = [sum(1 for c in t.values() if c == i) for i in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] + n[1] else 0.5
        return [min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.1), 0.95 * i) if n[i - 1] else 0.5 * i for i in (1, 2, 3)]

    def p(gram):
        n = len(gram)
        if n == 0:
            return 1 / (len(tables[1]) + 1)
        t, d = tables[n], discounts(tables[n])
        same = {g: c for g, c in t.items() if g[:-1] == gram[:-1]}
        if not same:
            return p(gram[1:])
        total, rest = sum(same.values()), sum(d[min(c, 3) - 1] for c in same.values())
        c = same.get(gram, 0)
        return (c - d[min(c, 3) - 1] if c else 0) / total + rest / total * p(gram[1:])

    return p


def plain_total(p, text, order):
    stream = charlm.BEGIN * (order - 1) + text + charlm.END
    return sum(math.log(p(stream[i : i + order])) for i in range(len(text) + 1))


TEXTS = ["the cat sat on the mat", "a cat, a hat, that", "on the mat \x02 the cat", "the the the"]


@pytest.mark.parametrize("order", [2, 3])
def test_smoothing_is_the_definition(spark, order):
    rows = spark.createDataFrame([("x", t) for t in TEXTS], "class string, text string")
    model = charlm.smoothed(charlm.gram_counts(rows, evened, order), order)
    p = plain_model([evened(charlm.unmarked(t)) for t in TEXTS], order)
    new = ["the cat", "zzz", "hat mat", "tt", "the " * 9]
    wanted = [plain_total(p, evened(t), order) for t in new]
    totals, lengths = charlm.as_arrays(model, ["x"]).totals([evened(t) for t in new])
    assert totals[:, 0] == pytest.approx(wanted, abs=1e-4) and lengths.tolist() == [len(evened(t)) + 1 for t in new]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(new)] + [(0, new[0]), (9, " ")], "i int, text string")
    grams = charlm.gram_counts(docs.select(F.lit("").alias("class"), "text"), evened, order).select("gram")
    got = {r.i: r for r in charlm.score_by_joins(docs, charlm.scored_grams(grams, model, ["x"]), evened, order, ["x"]).collect()}
    assert [got[i].total_0 for i in range(len(new))] == pytest.approx(wanted, abs=1e-9)
    assert (got[0].copies, got[1].copies, got[9].length) == (2, 1, 0)


def test_scores_of_each_order_have_a_plan_of_their_own(spark, monkeypatch):
    """All orders in one plan took the driver more memory than it has."""
    order, joins = 4, []
    count = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Join ")
    model = charlm.smoothed(charlm.gram_counts(spark.createDataFrame([("x", "abcab ca b")], "class string, text string"), evened, order), order)
    grams = charlm.gram_counts(spark.createDataFrame([("", "abc xab")], "class string, text string"), evened, order).select("gram")
    write = charlm.materialise
    monkeypatch.setattr(charlm, "materialise", lambda df, label: joins.append(count(df)) or write(df, label))
    scores = charlm.scored_grams(grams, model, ["x"])
    assert count(scores) == 0 and max(joins) == 3
    assert sorted(r.gram for r in scores.collect()) == sorted(r.gram for r in grams.collect())


@pytest.fixture
def no_small_broadcasts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def shuffled(spark):
    """Bytes written to shuffles so far."""
    return spark._jsc.sc().statusStore().executorList(False).apply(0).totalShuffleWrite()


def test_only_rare_grams_are_shuffled(spark, monkeypatch, no_small_broadcasts):
    """Beyond the bound every n-gram of every text was shuffled, some 20 times the input."""
    import random

    rng = random.Random(5)
    plain = [" ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(9)) for _ in range(30)]
    docs = [(i, " ".join(rng.choice(plain) for _ in range(40)) + " " + "".join(rng.choice("uvwxyz") for _ in range(12))) for i in range(300)]
    rows = spark.createDataFrame([*docs, docs[7], (400, "x" * 700_000 + "zuyvwx"), (401, None)], "i int, text string").repartition(4).localCheckpoint()
    grams = charlm.gram_counts(rows.select(F.lit("x").alias("class"), "text"), evened, 4)
    scores = charlm.scored_grams(grams.select("gram", "n"), charlm.smoothed(grams, 4), ["x"])
    found, moved = [], []
    for most in (charlm.BROADCAST_ROWS, 2500, 0):
        monkeypatch.setattr(charlm, "BROADCAST_ROWS", most)
        before = shuffled(spark)
        found.append({r.i: r for r in charlm.score_by_joins(rows, scores, evened, 4, ["x"]).collect()})
        moved.append(shuffled(spark) - before)
    assert scores.count() > 2500 and moved[1] < moved[2] / 4
    for other in found[1:]:
        assert other.keys() == found[0].keys() and other[7].copies == 2 and other[401].length == 0
        assert [other[i].total_0 for i in found[0]] == pytest.approx([r.total_0 for r in found[0].values()], rel=1e-9)


def test_windows_cover_long_texts():
    texts = ["ab" * 40, "", "c", "de" * 17]
    for chars in (5, 7, 1000):
        seen = Counter()
        for w in charlm.windows(texts, 3, chars):
            seen.update((int(t), w.stream[p - 2 : p + 1]) for t, p in zip(w.text, w.place))
        assert seen == Counter((i, f"\x02\x02{t}\x03"[k : k + 3]) for i, t in enumerate(texts) for k in range(len(t) + 1))


def held_out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_quality_equals_a_plain_model(spark):
    some = ["the cat sat on the mat", "a cat and a hat", "the hat on the cat", "that cat sat", "on a mat the cat sat"]
    docs = [(i, some[i % 5] + " and so on" * (i % 3), "en" if i % 4 else None) for i in range(60)] + [(100, "qx zzq xqz " * 4, "en"), (101, "the cat " * 150_000, "fr"), (5, some[0] + " and so on" * 2, "en")]
    labels = [(i, 1) for i in range(0, 60)] + [(7, 0)]
    rows = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, lang string, deviation string")
    got = classify(rows, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert Counter(r.doc_id for r in got) == Counter(d[0] for d in docs)
    trusted = {i for i, _ in labels} - {7}
    p = plain_model([evened(t) for i, t, _ in docs if i in trusted and not held_out(i)], ORDER)
    memo = {}
    for r in got:
        text = evened(next(t for i, t, _ in docs if i == r.doc_id))
        if len(text) < 1000:
            if text not in memo:
                memo[text] = math.exp(-plain_total(p, text, ORDER) / (len(text) + 1))
            assert r.perplexity == pytest.approx(memo[text], rel=1e-9) and r.n_tokens == len(text.split())
            assert r.kept == (r.low <= r.deviation <= r.high)
    by = {r.doc_id: r for r in got}
    assert not by[100].kept and by[101].n_tokens == 300_000


def test_languages_equal_plain_models_by_either_route(spark, monkeypatch):
    words = {"aa": "the cat sat on the mat", "bb": "die katze sitzt im haus", "cc": "le chat est sur la table"}
    docs = [(i, f"{t} {t[: i % 9]} {i}", k) for i in range(40) for k, t in words.items()]
    docs += [(200, "the katze chat", "zz1"), (201, "\u00bd \u00b2 \u2167", "aa"), (202, "\u4e00\u4e8c", None), (203, None, "aa"), (200, "the katze chat", "bb"), (None, "la table", "cc")]
    rows = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, lang string, score int")
    found = {}
    for route in (charlm.ARRAY_ROWS, -1):
        monkeypatch.setattr(charlm, "ARRAY_ROWS", route)
        found[route] = identify(rows).collect()
    assert Counter((r.doc_id, r.lang_pred) for r in found[-1]) == Counter((r.doc_id, r.lang_pred) for r in found[charlm.ARRAY_ROWS if charlm.ARRAY_ROWS > 0 else 3_000_000])
    train = [(i, letters(t), k) for i, t, k in docs if t and k and letters(t) and (i is None or not held_out(i))]
    models = {k: plain_model([t for _, t, own in train if own == k], langid.ORDER) for k in {k for *_, k in train}}
    for got in found.values():
        assert Counter(r.doc_id for r in got) == Counter(d[0] for d in docs)
        for r in got:
            texts = {letters(t or "") for i, t, _ in docs if i == r.doc_id}
            if texts == {""}:
                assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
                continue
            totals = [{k: plain_total(p, t, langid.ORDER) for k, p in models.items()} for t in texts]
            best = [max(sorted(t), key=t.get) for t in totals]
            assert r.lang_pred in best
            if len(texts) == 1:
                n = len(next(iter(texts))) + 1
                assert r.cross_entropy == pytest.approx(-totals[0][best[0]] / n, abs=1e-4)
                assert r.score == pytest.approx(1 / sum(math.exp((x - totals[0][best[0]]) / n * n**0.5) for x in totals[0].values()), abs=1e-3)


def test_letters_are_of_category_l():
    assert letters("Ab \u00bdc\u00b2 9x_y \u2167 \u4e00") == "ab c x y \u4e00"


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = identify(docs)
    assert got.count() == docs.count()
    held = got.where("held_out and lang_pred <> 'und'").join(docs.select("doc_id", "lang"), "doc_id")
    right, n = held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 100 and right > 0.97
    odd = spark.createDataFrame([(1, None, None), (2, "123 !?", "en"), (3, "", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in identify(odd).orderBy("doc_id").collect()] == [("und", 0.0)] * 3
    assert identify(odd.limit(0)).count() == 0


def test_quality_of_documents(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = classify(docs, labels).cache()
    assert got.count() == docs.count()
    of = {r.quality: r.kept for r in got.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert of[1] > 0.98 and of[0] < 0.25


def test_quality_without_labels_or_text(spark):
    docs = spark.createDataFrame([(1, None, None, "a"), (2, "", "en", "b"), (3, "some words", "xx", "c"), (3, "some words", "xx", "c")], "doc_id long, text string, lang string, low string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.kept for r in classify(docs, none).collect()] == [True] * 4
    some = spark.createDataFrame([(3, 1, 0), (None, 1, 0), (9, None, None)], "doc_id long, quality int, toxic int")
    kept = drop_poor(docs, some)
    assert kept.columns == docs.columns and kept.count() == 4
    assert classify(docs.limit(0), none).count() == 0


@pytest.mark.parametrize("kind", ["long", "string"])
def test_many_ids_move_no_texts(spark, monkeypatch, no_small_broadcasts, kind):
    """More trusted or poor ids than are sent as a table made a shuffle of all documents with their texts."""
    from tributary.llm import common, quality

    docs = [(i, f"the cat {'sat on the mat' if i % 3 else 'saw a hat'} " * (1 + i % 4), "en") for i in range(80)] + [(None, "the cat", "en"), (90, "qx zzq xqz " * 9, "en"), (0, "the hat", None)]
    rows = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumn("doc_id", F.col("doc_id").cast(kind))
    labels = spark.createDataFrame([(i, int(i != 3)) for i in range(70)], "doc_id int, quality int")
    labels = labels.withColumn("doc_id", F.col("doc_id").cast("string")) if kind == "string" else labels
    rows = common.materialise(rows, "rows")  # few files, read alike
    plans, count = [], charlm.gram_counts
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(charlm, "gram_counts", lambda df, *a: plans.append(plan(df)) or count(df, *a))
    found = []
    for few, listed in ((quality.BROADCAST_ROWS, 99), (0, 99), (0, -1))[: 3 if kind == "long" else 2]:
        monkeypatch.setattr(quality, "BROADCAST_ROWS", few)
        monkeypatch.setattr(common, "LISTED_KEYS", listed)
        kept = drop_poor(rows, labels)
        plans.append(plan(kept))
        found.append(sorted(map(repr, kept.collect())))
    assert all(rows == found[0] for rows in found) and 0 < len(found[0]) < len(docs)
    moves = ["Exchange hashpartitioning" in p.replace("BroadcastExchange", "") for p in plans]
    assert not any(moves[2:4]) and all(moves[4:])


def test_grammar_scores_clauses():
    reader = Reader(Grammar(words=frozenset(["dolt"]), stems=frozenset(["blen"])))
    at = lambda text, f: reader.features(text)[FEATURES.index(f)]
    assert at("You are a dolt.", "affirmed") == 1 and at("You are a dolt.", "targeted") == 1
    assert at("You are not a dolt.", "denied") == 1 and at("You are not a dolt.", "affirmed") == 0
    assert at("She said: fine. She called him a dolt.", "reported") == 1
    assert at("not now. dolt", "affirmed") == 1 and at("blending blender", "repeated") == 1
    assert not reader.features("plain text").any() and not reader.features("").any()


def test_threats_in_each_language():
    reader = Reader(Grammar())
    at = lambda text: reader.features(text)[FEATURES.index("threats")]
    for text in ("I will kill you.", "ich werde dich töten", "er will euch umbringen", "te voy a matar", "je vais te tuer", "je vais le tuer"):
        assert at(text) == 1, text
    for text in ("I will not kill you.", "kill time", "tuer le temps", "he said he would kill you", "wir wollen die zeit töten"):
        assert at(text) == 0, text


def test_inflected_threats_in_each_language():
    reader = Reader(Grammar())
    at = lambda text: reader.features(text)[FEATURES.index("threats")]
    for text in (
        *("I killed you", "he kills you", "I am going to shoot you", "They're killing you", "we stabbed you", "You'll see, we destroy them", "I shot you"),
        *("ich töte dich", "er tötet euch", "ich habe dich getötet", "ich erschieße ihn", "sie zerstören euch"),
        *("je te tue", "je t'ai frappé", "je t’ai tué", "nous vous détruirons", "je vais les massacrer"),
        *("te mato", "te mataré", "voy a matarte", "os destruyen", "quiero aplastarlos"),
    ):
        assert at(text) == 1, text
    for text in (
        *("The flood killed 12 people.", "smoking kills people", "he shot them a look", "I don't kill you", "I won't hurt you", "he told me he would kill you"),
        *("die Krankheit tötet Menschen", "er tötete ihn", "nicht dich töte ich"),
        *("je ne te tue pas", "il tue le temps", "je n’ai tué elle", "un ataque mató a ellos", "no te mato", "su mata"),
    ):
        assert at(text) == 0, text


def test_word_forms_equal_a_plain_list():
    from tributary.llm.toxicity import FORMS, STEMS_AND_ENDINGS, symbol_of

    plain = {}
    for symbol, listed in FORMS.items():
        for form in listed.split():
            assert plain.setdefault(form, symbol) == symbol, form
    for stems, endings in STEMS_AND_ENDINGS:
        for stem in stems.split():
            for symbol, listed in endings.items():
                for ending in listed.split():
                    form = stem if ending == "-" else stem + ending
                    assert plain.setdefault(form, symbol) == symbol, form
    for form, symbol in plain.items():
        assert symbol_of(form) == symbol
        for other in (form[:-1], form + "x", form + form[-1], ""):
            assert symbol_of(other) == plain.get(other, "OTHER")


def test_toxicity_scores_equal_a_plain_reckoning(spark):
    """Induction, events and scores against loops over whole texts: each machine of the cascade in turn, words from the list."""
    import random
    import re

    from tributary.llm import toxicity as t

    rng, plain = random.Random(3), "the cat a house we see is it on mat".split()
    docs = []
    for i in range(240):
        words = [rng.choice(plain) for _ in range(rng.randrange(4, 14))]
        if i % 3 == 0:
            words[rng.randrange(len(words))] = rng.choice(("dolt", "blender", "blending"))
            words.insert(rng.randrange(len(words)), rng.choice(("you", "not", "said", "you")))
        docs.append((i, " ".join(words) + rng.choice((".", "", "! I kill you"))))
    labels = [(i, int(i % 3 == 0)) for i in range(200)]
    got = {r.doc_id: r for r in score_documents(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    fitted = [(text, y) for (i, text), (_, y) in zip(docs, labels) if not held_out(i)]
    tokens = lambda text: re.findall(r"[^\W\d_]+|[.!?]", text.lower())
    features = lambda w: {w + "$"} | {w[:n] for n in t.STEMS if len(w) >= n}
    contexts, in_texts, n_of = {}, {0: Counter(), 1: Counter()}, Counter(y for _, y in fitted)
    for text, y in fitted:
        words = [w for w in tokens(text) if w not in ".!?"]
        in_texts[y].update(set().union(*map(features, words)))
        for before, w, after in zip(["", *words], words, [*words[1:], ""]):
            for f in features(w) if y else ():
                contexts.setdefault(f, set()).add((before, w, after))
    kept = {f for f, own in contexts.items() if len(own) >= t.MIN_CONTEXTS and in_texts[0][f] / n_of[0] <= t.MAX_CLEAN * in_texts[1][f] / n_of[1]}
    assert {"dolt$", "blend"} <= kept and not {f for f in kept if f.rstrip("$") in plain}

    def events(text):
        total, clauses = Counter(), re.split(r"[.!?]", text.lower())
        for clause in clauses:
            symbols = ["INSULT" if features(w) & kept else t.symbol_of(w) for w in re.findall(r"[^\W\d_]+", clause)]
            for make in CASCADE:
                symbols, own = make().run(symbols)
                total += own
        return np.log1p([float(total[f]) for f in FEATURES])

    x, y = np.array([events(text) for text, _ in fitted]), np.array([y for _, y in fitted], float)
    weights, bias = np.array(t.PRIOR), 0.0
    for _ in range(200):  # Newton's steps, each component in full form
        p = 1 / (1 + np.exp(-(x @ weights + bias)))
        slope = np.append(x.T @ (p - y) + (weights - t.PRIOR), (p - y).sum() + 1e-3 * bias)
        x1 = np.column_stack([x, np.ones(len(x))])
        change = np.linalg.solve((x1.T * (p * (1 - p))) @ x1 + np.diag([1.0] * len(FEATURES) + [1e-3]), slope)
        weights, bias = weights - 0.5 * change[:-1], bias - 0.5 * change[-1]
    for i, text in docs:
        assert got[i].score == pytest.approx(1 / (1 + np.exp(-(events(text) @ weights + bias))), abs=1e-4), text


@given(st.lists(st.sampled_from(SYMBOLS), max_size=40))
def test_the_composed_transducer_does_what_the_cascade_does(symbols):
    passed, events = list(symbols), Counter()
    for make in CASCADE:
        passed, own = make().run(passed)
        events += own
    arcs, final = composed()
    total, state = np.zeros(len(FEATURES)), 0
    for symbol in symbols:
        weight, state = arcs[state][SYMBOLS.index(symbol)]
        total += 0 if weight is None else weight
    total += 0 if final[state] is None else final[state]
    assert dict(zip(FEATURES, total)) == {f: events[f] for f in FEATURES}


def test_toxicity_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, "you dolt " * 120_000, "a"), (1, "you dolt " * 120_000, "a"), (2, None, "b"), (3, "x" * 300_000, "c")], ["doc_id", "text", "meta.url"])
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    got = score_documents(docs, labels).collect()
    assert sorted(r.doc_id for r in got) == [1, 1, 2, 3] and len({r.score for r in got if r.doc_id == 1}) == 1
    assert drop_toxic(docs, labels).columns == docs.columns


def test_toxicity_of_held_out_documents(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = score_documents(docs, labels).cache()
    assert got.count() == docs.count() and got.where("score < 0 or score > 1 or (score >= 0.3) <> (predicted = 1)").count() == 0
    held = got.where("held_out").join(labels, "doc_id").toPandas()
    assert (held.predicted == held.toxic).mean() > 0.9
    kept = drop_toxic(docs, labels)
    assert kept.count() == got.where("predicted = 0").count() and kept.columns == docs.columns


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, None, 1.0), (2, "", 2.0), (3, "words", None)], "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.predicted for r in score_documents(docs, none).collect()] == [0, 0, 0]
    assert drop_toxic(docs, none).count() == 3 and score_documents(docs.limit(0), none).count() == 0
