import random

from corvane.llm.decontam import contaminated, without_contaminated

SF = "/root/testdata/sf0.001"
B = "item_id long, text string, place int"


def pairs(docs, bench):
    return {(r.doc_id, r.item_id): (r.n_windows, r.matched, r.changed) for r in contaminated(docs, bench).collect()}


def test_leaks_of_the_tables(spark):
    """Brute force: an item's lower-cased words in a row."""
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [(b.item_id, f" {' '.join(b.text.lower().split())} ") for b in bench.collect()]
    want = {(d.doc_id, i) for d in docs.collect() for i, t in items if t in f" {' '.join(d.text.lower().split())} "}
    got = pairs(docs, bench)
    assert want and set(got) == want and all(c == 0 for _, _, c in got.values())


Q = "A train leaves Paris at 30 km per hour and then a second train leaves Rome at 45 km per hour, so how many hours pass before Paris sees both?"


def test_slots(spark):
    bench = spark.createDataFrame([(1, Q, 0), (2, "too short here", 0), (3, None, 0), (None, Q, 0)], B)
    rnd = random.Random(1)
    noise = " ".join(f"word{rnd.randrange(900)}" for _ in range(200))
    same = Q.replace("Paris", "Oslo").replace("Rome", "Bern").replace("30", "31").replace("45", "62").replace("km", "miles")
    mixed = Q.replace("Paris", "Oslo", 1)
    docs = [(1, f"{noise} {Q} {noise}"), (2, f"{noise} {same}\n{noise}"), (3, mixed), (4, noise), (5, None), (6, ""), (7, Q[:40]), (8, same.replace("Bern", "Oslo")), (None, Q)]
    got = pairs(spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, hash string"), bench)
    assert set(got) == {(1, 1), (2, 1)}
    assert got[1, 1][2] == 0 and got[2, 1][2] == 5


def test_filter_and_empty(spark):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    kept = without_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - {d for d, _ in pairs(docs, bench)}
    assert pairs(docs.limit(0), bench) == {} and pairs(docs, bench.limit(0)) == {}


def test_copies_in_other_case(spark):
    item = "Der Zug nach Köln hält in Straßburg um 9 Uhr, und Anna Müller steigt mit Otto aus, weil sie dort Jürgen Groß am alten Rathaus treffen will"
    sums = "Anna Bruno Carla Dora 12 + 30 und Emil Franz holen dann die 4 Kisten aus dem kleinen Keller"
    bench = spark.createDataFrame([(1, Q, 0), (2, item, 0), (3, sums, 0)], B)
    docs = [(10 * i + k, f"some words before it. {t} and after") for i, text in ((1, Q), (2, item), (3, sums)) for k, t in enumerate((text, text.upper(), text.lower(), text.title()))]
    got = pairs(spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, hash string"), bench)
    assert set(got) == {(d, d // 10) for d, _ in docs} and all(n == m and c == 0 for n, m, c in got.values())


def test_case_folded_copies_of_larger_tables(spark):
    """Brute force: an item's case-folded words in a row, without marks at their edges; the first three say where to look."""
    told = lambda text: [t for t in (x.strip(".,;:!?()[]{}\"'`") for x in (text or "").casefold().split()) if t]
    sf = "/root/testdata/sf0.1"
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    items = {}
    for b in bench.collect():
        w = told(b.text)
        items.setdefault(tuple(w[:3]), []).append((b.item_id, w))
    want = set()
    for d in docs.select("doc_id", "text").collect():
        w = told(d.text)
        for at, head in enumerate(zip(w, w[1:], w[2:], strict=False)):
            want |= {(d.doc_id, i) for i, t in items.get(head, ()) if w[at : at + len(t)] == t}
    assert {(1699, 130), (6420, 37), (8376, 101)} <= want <= set(pairs(docs, bench))


def test_values_that_coincide_and_items_without_templates(spark):
    apples = "If you have 5 red apples in one basket and 3 green apples in another basket then how many apples are in both?"
    items = [(1, apples), (2, "12 + 30 = 42"), (3, "Capital of France?"), (4, "7 kg 3 km 40 miles 5 hours 12 cents 9 pounds"), (5, "Alice Bob Carol Dave Erin"), (6, "..."), (7, "photosynthesis")]
    bench = spark.createDataFrame([(*i, 0) for i in items], B)
    docs = [(1, apples.replace("5", "4").replace("3", "4")), (2, "we know 12 + 30 = 42 well"), (3, "the CAPITAL of FRANCE, is"), (4, f"so {items[3][1].upper()} it was"), (5, "met Alice Bob Carol Dave Erin there")]
    docs += [(6, "12 + 30 = 43"), (7, "the capital of Spain"), (8, "met Alice Bob Carol Erin Dave"), (9, "7 kg 3 km"), (10, "about Photosynthesis."), (11, "12 + 30"), (12, "... =")]
    got = pairs(spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, hash string"), bench)
    assert set(got) == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (10, 7)}
    assert got[1, 1][2] == 2 and got[2, 2] == (1, 1, 0) and got[3, 3] == (1, 1, 0)


def test_windows_that_all_items_share_make_no_candidates(spark, monkeypatch):
    import corvane.llm.decontam as module

    tables, keep = {}, module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, name: tables.setdefault(name, keep(df, name)))
    rnd = random.Random(5)
    opening = "read the passage below with care and then answer the question that comes after it"
    tail = lambda: " ".join(f"t{rnd.randrange(10**6)}x" for _ in range(14))
    items = [(i, f"{opening} {tail()}", 0) for i in range(300)]
    docs = [(i, f"{tail()} {opening} {tail()}") for i in range(300)] + [(1000 + i, f"{tail()} {items[i][1]} {tail()}") for i in range(0, 300, 7)]
    got = pairs(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, B))
    assert set(got) == {(1000 + i, i) for i in range(0, 300, 7)}
    assert tables["candidates"].count() == len(got)


def test_items_of_common_words_are_not_looked_for(spark):
    bench = spark.createDataFrame([(1, "the", 0), (2, "a lot", 0), (3, "photosynthesis", 0), (4, "of the same", 0)], B)
    docs = spark.createDataFrame([(1, "the end of a lot"), (2, "on photosynthesis"), (3, "more of the same"), (4, "the")], "doc_id long, text string")
    assert set(pairs(docs, bench)) == {(2, 3), (3, 4)}
