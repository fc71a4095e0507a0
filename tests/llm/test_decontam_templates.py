import random
import re

from corvane.llm.decontam import NUMBER_WORDS, UNITS, contaminated

MARKS = ".,;:!?()[]{}\"'`"
NAMES = "Paris Oslo Bern Anna Bruno Carla Dmitri Erik Fatima Grete Hugo Irma".split()
THINGS = "apples pears baskets trains lamps stones ropes books coins boxes".split()
TEMPLATES = (
    "{a} has {n} red {x} and {n} green {y} in the old shed. How many of them does {b} count there",
    "In {a} a shop sells {x} for {m} cents each and {y} for {n} cents each. What do both cost together",
    "Yesterday {a} walked {n} km to the market near {b} and then {m} km back along the river. How long was that walk",
    "{a} and {b} share {n} {x} so that {b} gets {m} more of the {x} than the other child gets",
)


def filled(template, rnd, numbers=str):
    a, b = rnd.sample(NAMES, 2)
    x, y = rnd.sample(THINGS, 2)
    return lambda: template.format(a=a, b=b, x=x, y=y, n=numbers(rnd.randrange(2, 99)), m=numbers(rnd.randrange(2, 99)))


def tokens(text):
    """Words with what they are: literal, number, unit, name, or a capital that opens a sentence."""
    out, opening = [], True
    for raw in text.split():
        word = raw.strip(MARKS)
        low = word.casefold()
        if word:
            kind = "number" if re.match(r"[+\-$#]?\d", word) or low in NUMBER_WORDS else "unit" if low in UNITS else ("maybe" if opening else "name") if word[0].isupper() else ""
            out.append((low, kind))
            opening = False
        opening = opening or any(c in raw[len(raw.rstrip(MARKS)) :] for c in ".!?:")
    return out


def windows(t, reading):
    """Places of windows of five with three literals at least -> their template."""
    slots = {"number", "unit", "name"} | ({"maybe"} if reading else set())
    found = {}
    for i in range(len(t) - 4):
        w = t[i : i + 5]
        if sum(k in slots for _, k in w) <= 2 and (not reading or any(k == "maybe" for _, k in w)):
            found[i] = tuple(("name" if k == "maybe" else k) if k in slots else x for x, k in w)
    return found


def brute(docs, items):
    """Every document against every item at every offset."""
    out = set()
    for d, doc in docs:
        dt = tokens(doc)
        for i, item in items:
            it = tokens(item)
            need, got = set(windows(it, 0)), set()
            for shift in range(-len(it), len(dt)):
                spots, pairs = set(), set()
                for reading in (0, 1):
                    there = windows(dt, reading)
                    for at, w in windows(it, reading).items():
                        if there.get(at + shift) == w:
                            spots.add(at)
                            pairs |= {(x[1], x[0], y[0]) for x, y in zip(it[at : at + 5], dt[at + shift : at + shift + 5], strict=True) if x[1] in ("unit", "name")}
                plain = [at for at in need if at + shift >= 0 and [x for x, _ in dt[at + shift : at + shift + 5]] == [x for x, _ in it[at : at + 5]]]
                spots |= set(plain)
                names = [(x, y) for k, x, y in pairs if k == "name"]
                if len({(k, x) for k, x, _ in pairs}) == len(pairs) and len({y for _, y in names}) == len(names):
                    got |= spots
            if need and len(got) >= 0.8 * len(need):
                out.add((d, i))
    return out


def test_reparameterised_questions_against_brute_force(spark):
    rnd = random.Random(7)
    noise = lambda: " ".join(f"word{rnd.randrange(500)}" for _ in range(rnd.randrange(5, 30)))
    items, docs, planted = [], [], set()
    for i in range(12):
        own = "abcdefghijkl"[i] * 3
        template = TEMPLATES[i % 4].replace("old shed", f"old shed{own}").replace("shop", f"shop{own}").replace("market", f"market{own}").replace("child", f"child{own}")
        make = filled(template, rnd)
        question = make()
        items.append((i, question))
        for k in range(4):
            text = question if k == 0 else make() if k == 1 else re.sub(r"\d+", lambda m: rnd.choice(NUMBER_WORDS[:12]), question) if k == 2 else make()
            if k == 3:
                swap = dict(zip(NAMES, rnd.sample(NAMES, len(NAMES)), strict=True))
                text = " ".join(swap.get(w.strip("."), w.strip(".")) + ("." if w.endswith(".") else "") for w in text.split())
            docs.append((100 * i + k, f"{noise()}. {text}. {noise()}"))
            planted.add((100 * i + k, i))
        docs.append((100 * i + 50, f"{noise()} {' '.join(reversed(question.split()))}"))
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, item_id string")
    got = {(r.doc_id, r.item_id) for r in contaminated(frame, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == brute(docs, items)
    assert len(got & planted) >= 0.9 * len(planted) and got <= planted


def test_probes(spark):
    base = "Tom has 12 red apples and 12 green pears in his basket, so how many fruits does he own in all"
    items = [(1, base), (2, "Compute 3 + 4."), (3, "Шла Маша по шоссе и несла 5 красных яблок домой, а потом Маша съела 2 яблока сразу")]
    docs = [(1, base.replace("Tom", "Jane")), (2, base.replace("12 red", "7 red").replace("12 green", "9 green")), (3, base.replace("Tom", "Eve").replace("12 red", "7 red").replace("12 green", "9 green"))]
    docs += [(4, base.replace("12", "three")), (5, "then Compute 3 + 4. was asked"), (6, "Compute 3 + 5."), (7, items[2][1].replace("Маша", "Даша").replace("5", "8")), (8, "long " * 200_000 + base), (8, "long " * 200_000 + base), (9, None), (10, "")]
    got = {(r.doc_id, r.item_id) for r in contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 1), (5, 2), (7, 3), (8, 1)}
