import random
import re

from tributary.llm.decontaminate import drop_contaminated, find_contained


def words(text):
    return re.findall(rb"[0-9A-Za-z_\x80-\xff]+", text.lower().encode())


def shingles(tokens, width):
    return {tuple(tokens[i : i + width]) for i in range(len(tokens) - width + 1)}


def brute(docs, items):
    out = set()
    for i, item in items:
        tokens = words(item or "")
        if not tokens:
            continue
        wanted = shingles(tokens, min(5, len(tokens)))
        for d, text in docs:
            held = wanted & shingles(words(text or ""), min(5, len(tokens)))
            if len(held) >= 0.8 * len(wanted):
                out.add((d, i, len(held), len(wanted)))
    return out


def test_against_all_pairs(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefé", k=4))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(rng.choice([1, 3, 8, 30, 90]))) for i in range(40)] + [(50, None), (51, ""), (52, "?!")]
    docs = [(1000, None), (1001, "")]
    for n in range(120):
        own = [text(rng.choice([2, 20, 200]))]
        for _ in range(rng.choice([0, 1, 1, 3])):
            picked = rng.choice(items[:40])[1].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                picked[rng.randrange(len(picked))] = word()
            own.append("; ".join([" ".join(picked).upper()]) if rng.random() < 0.5 else "\n".join(picked))
        own.append(text(rng.choice([0, 50])))
        docs.append((n, " ".join(own)))
    a = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, item_id int")
    b = spark.createDataFrame([(i, t, "x") for i, t in items] + [(items[0][0], items[0][1], "y")], "item_id long, text string, doc_id string")
    got = [(r.doc_id, r.item_id, r.shared, r.shingles) for r in find_contained(a, b).collect()]
    wanted = brute(docs, items)
    assert len(got) == len(set(got)) and set(got) == wanted and len(wanted) > 50
    kept = drop_contaminated(a, b)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({d for d, _ in docs} - {d for d, *_ in wanted}) and kept.columns == a.columns


def test_empty_sides(spark):
    a = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert find_contained(a, b.limit(0)).count() == 0 and find_contained(a.limit(0), b).count() == 0
    assert drop_contaminated(a, b.limit(0)).count() == 1 and drop_contaminated(a, b).count() == 0


def test_item_ids_of_any_type(spark):
    """Batches with and without hits; ids that are text, int, dates or null."""
    import datetime

    texts = ["nothing of the kind is here at all"] * 3 + ["so: the quick brown fox jumps over a lazy dog"]
    docs = spark.createDataFrame([(f"d{n}", t) for n, t in enumerate(texts)], "doc_id string, text string").repartition(4)
    for kind, ids in (("string", ["a", None]), ("int", [1, None]), ("date", [datetime.date(2024, 1, 1), None]), ("decimal(20,2)", [None, None])):
        items = spark.createDataFrame([(i, t) for i, t in zip(ids, ["the quick brown fox jumps over", "a text that no one has"])], f"item_id {kind}, text string")
        got = find_contained(docs, items).collect()
        assert [(r.doc_id, r.item_id) for r in got] == [("d3", ids[0])] and find_contained(docs, items).schema["item_id"].dataType == items.schema["item_id"].dataType
        assert sorted(r.doc_id for r in drop_contaminated(docs, items).collect()) == ["d0", "d1", "d2"]
