import random

from eventmart.llm import templates

ITEM = "Anna Smith buys 12 apples for 3 dollars each. Later Anna Smith eats 12 apples and sells the rest to Bob."
OTHER = "Les maisons de la rue sont grandes, vertes et calmes. Une porte reste toujours ouverte au bout du jardin."


def frames(spark):
    again = ITEM.replace("Anna Smith", "Marie Curie").replace("12", "47").replace("Bob", "Paul").replace("3 dollars", "9 euros")
    mixed = ITEM.replace("Anna Smith buys 12", "Carl Gauss buys 5")  # one value, two meanings
    rows = [
        (1, "Before the text some words. " + ITEM + " And after it some more."),
        (2, "Words come first here. " + again),
        (3, "An other text about apples and the rest of it all, with 12 apples."),
        (4, "| ".join(OTHER.upper().split())),
        (5, None), (6, ""), (7, "13 7 12 3 4 5 6 7 8 9"), (None, ITEM), (1, ITEM),
        (8, OTHER[:40]), (9, ("filler words go on and on " * 9000) + OTHER),
        (10, mixed), (11, "red blue green"),
    ]
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id bigint, text string, h string, pos int")
    items = spark.createDataFrame(
        [(10, ITEM, 0), (11, OTHER, 0), (12, None, 0), (13, "12 3", 0), (14, "red blue green", 0), (11, OTHER, 0)], "item_id bigint, text string, size int"
    )
    return docs, items


def test_verbatim_and_reparameterised_items_are_found(spark):
    docs, items = frames(spark)
    got = {(r.doc_id, r.item_id): r for r in templates.leaks(docs, items).collect()}
    assert set(got) >= {(1, 10), (2, 10), (4, 11), (9, 11), (None, 10), (11, 14)}
    assert not {d for d, _ in got} & {3, 5, 6, 7, 8}
    assert got[(1, 10)].exact and not got[(2, 10)].exact


def test_decontaminated_keeps_clean_rows_and_columns(spark):
    docs, items = frames(spark)
    left = templates.decontaminated(docs, items)
    assert left.columns == docs.columns
    assert {3, 5, 6, 7, 8, None} <= {r.doc_id for r in left.collect()} and not {1, 2, 4, 9, 11} & {r.doc_id for r in left.collect()}
    assert templates.leaks(docs.limit(0), items).count() == 0 and templates.leaks(docs, items.limit(0)).count() == 0


def test_inconsistent_slots_are_no_copy(spark):
    item = "In May Tom pays Ann and Tom calls Ann while Tom greets Ann so Tom thanks Ann and then Tom leaves Ann there."
    other = "In May Jim pays Sue and Max calls Eva while Lou greets Pia so Kim thanks Joe and then Ned leaves Zoe there."
    fair = item.replace("Tom", "Jim").replace("Ann", "Sue")
    docs = spark.createDataFrame([(1, "In all this. " + other), (2, "In all this. " + fair)], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    assert [r.doc_id for r in templates.leaks(docs, items).collect()] == [2]


def test_other_line_breaks_change_nothing(spark):
    item = "Which of these Paris cafes\nsells tea to Anna Smith\nand to her brother\nA) the Blue Door on the hill\nB) the old red mill"
    lists = "Paris\nLondon\nRome\nMadrid\nBerlin\nVienna"
    words = item.split()
    wraps = {w: "\n".join(" ".join(words[i : i + w]) for i in range(0, len(words), w)) for w in (1, 2, 3, 4, 6, 8, 10, 12, 99)}
    rows = [(w, f"Here some words come first. {text} Then others follow") for w, text in wraps.items()]
    rows += [(200, item), (201, "go on and\n" + lists), (202, item.replace("\n", "\n\n")), (203, item.replace("Anna Smith", "Marie Curie").replace("\n", " "))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    items = spark.createDataFrame([(1, item), (2, lists)], "item_id bigint, text string")
    got = [(r.doc_id, r.item_id) for r in templates.leaks(docs, items).collect()]
    assert sorted(got) == sorted([(d, 1) for d, _ in rows if d != 201] + [(201, 2)])


def plain_readings(text):
    """Lists of (token, value): the template's token, and the slot's value or None."""
    words, first, line = [], True, False
    for word in (text or "").replace("\n", " \n ").split(" "):
        if word == "\n":
            line = True
            continue
        if not word.split():
            continue
        core = word.strip(templates.OUTER)
        words.append((core, first, line))
        first, line = word.rstrip("\"'”’»)]")[-1:] in (".", "?", "!", ":", ";", "…", "。", "！", "？"), False

    def reading(with_lines):
        out = []
        for core, start, line in words:
            start = start or with_lines and line
            low = core.lower()
            if not core:
                continue
            if templates.NUMBER.fullmatch(core) or low in templates.NUMBERS:
                out.append(("<num>", low))
            elif low in templates.UNITS:
                out.append(("<unit>", low))
            elif core[0].isupper() and core[1:].lower() == core[1:] and not start:
                if not out or out[-1][0] != "<name>":
                    out.append(("<name>", low))
            else:
                out.append((low, None))
        return out

    flat, broken = reading(False), reading(True)
    return [flat] if flat == broken else [flat, broken]


def plain_leaks(docs, items):
    found = set()
    for doc_id, text in docs:
        for item_id, said in items:
            for item in plain_readings(said):
                size, n = len(item), min(templates.WINDOW, len(item))
                covered = set()
                for doc in plain_readings(text) if size >= templates.LEAST_TOKENS else []:
                    for diagonal in range(-size, len(doc)):
                        at, pairs = set(), set()
                        for i in range(size - n + 1):
                            a, b = item[i : i + n], doc[max(0, i + diagonal) : i + diagonal + n] if i + diagonal >= 0 else []
                            if [t for t, _ in a] == [t for t, _ in b] and any(v is None for _, v in a):
                                at.add(i)
                                pairs |= {(x, y) for (_, x), (_, y) in zip(a, b) if x is not None}
                        if len({x for x, _ in pairs}) >= templates.CONSISTENT * len(pairs):
                            covered |= {i + j for i in at for j in range(n)}
                if covered and len(covered) >= templates.COVERED * size:
                    found.add((doc_id, item_id))
    return found


def test_leaks_match_brute_force(spark):
    rng = random.Random(17)
    words = "the red fox Anna Bob Carl 3 7 12 km hours runs to and sells apples, Then buys? two Paris .. ( over".split()
    say = lambda n: "".join(rng.choice(words) + rng.choice([" "] * 9 + ["\n"]) for _ in range(n))
    items = [(i, say(rng.choice([2, 3, 4, 6, 9, 14, 20]))) for i in range(40)] + [(90, None), (91, ""), (92, "3 7 12 3 7")]
    swap = {"Anna": "Eva", "Bob": "Tom", "3": "45", "7": "8", "12": "600"}
    docs = [(0, None), (1, ""), (2, "3 7 12 3 7 12")]
    for i in range(3, 90):
        said = rng.choice(items[:40])[1].split(" ")
        kind = rng.randrange(5)
        if kind == 1:  # other values, the same throughout
            said = [swap.get(w, w) for w in said]
        elif kind == 2:  # some values, at random
            said = [swap.get(w, w) if rng.random() < 0.5 else w for w in said]
        elif kind == 3:  # some words lost
            said = [w for w in said if rng.random() < 0.9]
        docs.append((i, say(rng.randint(0, 12)) + " ".join(said if kind < 4 else []) + " " + say(rng.randint(0, 12))))
    got = templates.leaks(
        spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3), spark.createDataFrame(items, "item_id bigint, text string")
    )
    want = plain_leaks(docs, items)
    assert len(want) > 40 and {(r.doc_id, r.item_id) for r in got.collect()} == want
