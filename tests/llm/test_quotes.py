from lakework.llm import quotes

SCHEMA = "conv_id long, turn long, role string, text string"


def by_turn(df, conv):
    return {r["turn"]: r for r in df.filter(df.conv_id == conv).collect()}


def test_levels_and_passages():
    got = quotes.passages("a\n> b\n>> c\n> > d\n>e\n\nf")
    assert [(level, [x for x in lines if x]) for level, lines in got] == [(0, ["a"]), (1, ["b"]), (2, ["c", "d"]), (1, ["e"]), (0, ["f"])]


def test_links_order_and_bodies(spark):
    rows = [
        (1, 0, "user", "How do I merge two tables?\nThey are both large."),
        (1, 1, "assistant", "Use a join on the key of both tables."),
        (1, 2, "user", "On Monday, A wrote:\n> Use a join on the key   of both tables.\n\nWhich key should it be?"),
        (1, 3, "user", "Unrelated question about windows."),
        (1, 4, "assistant", "Ann wrote:\n> On Monday, A wrote:\n>> Use a join on the key of both tables.\n> Which key should it be?\nThe customer's number."),
        (1, 5, "assistant", "> They are both large.\nThen partition them first."),
        (1, 6, "user", "> nobody ever said this line\nhm"),
        (2, 1, "assistant", "> Use a join on the key of both tables.\nother conversation"),
    ]
    got = by_turn(quotes.reply_order(spark.createDataFrame(rows, SCHEMA)), 1)
    assert {t: r["reply_to"] for t, r in got.items()} == {0: None, 1: None, 2: 1, 3: None, 4: 2, 5: 0, 6: None}
    assert {t: (r["root_turn"], r["depth"]) for t, r in got.items()} == {0: (0, 0), 1: (1, 0), 2: (1, 1), 3: (3, 0), 4: (1, 2), 5: (0, 1), 6: (6, 0)}
    assert got[2]["body"] == "Which key should it be?" and got[4]["body"] == "The customer's number."
    assert got[6]["body"] == "hm" and got[6]["n_quotes"] == 1
    order = sorted(got, key=lambda t: (got[t]["root_turn"], got[t]["depth"], t))
    assert order == [0, 5, 1, 2, 4, 3, 6]


def test_short_whole_messages(spark):
    rows = [(1, 0, "user", "ok"), (1, 1, "user", "为什么？"), (1, 2, "user", "> ok\nfine"), (1, 3, "user", "> 为什么？\n因为"), (1, 4, "user", "Thanks.\n\nBye now"), (1, 5, "user", "> Thanks.\nany time")]
    got = by_turn(quotes.reply_order(spark.createDataFrame(rows, SCHEMA)), 1)
    assert {t: r["reply_to"] for t, r in got.items()} == {0: None, 1: None, 2: 0, 3: 1, 4: None, 5: 4}


def test_long_chain(spark):
    rows = [(1, 0, "user", "message number 0 starts it")]
    rows += [(1, t, "user", f"> message number {t - 1} starts it\nmessage number {t} starts it") for t in range(1, 40)]
    got = by_turn(quotes.reply_order(spark.createDataFrame(rows, SCHEMA)), 1)
    assert all(r["depth"] == t and r["root_turn"] == 0 for t, r in got.items())


def test_edge_rows(spark):
    rows = [
        (None, 0, "user", "the same words here"), (None, 1, "user", "> the same words here\nyes"), (1, None, None, None), (1, 0, "user", ""),
        (1, 1, "user", "> > >"), (1, 2, "user", "word " * 100_000), (1, 2, "user", "word " * 100_000), (3, 0, "user", "> the same words here\n"),
    ]
    frame = spark.createDataFrame([(*r, 1) for r in rows], f"{SCHEMA}, depth int")
    got = quotes.reply_order(frame).collect()
    assert len(got) == len(rows) and all(r["reply_to"] is None for r in got)
    assert quotes.reply_order(spark.createDataFrame([], SCHEMA)).collect() == []


def test_parts_of_messages(spark):
    """A sentence out of a longer line; two of three paragraphs, wrapped anew; two sentences over a line break."""
    rows = [
        (1, 0, "user", "Hi, good morning. Is it done by Friday? Tell me when you know."),
        (1, 1, "user", "> Is it done by Friday?\nYes."),
        (1, 2, "user", "The first paragraph is\nabout tables.\n\nThe second one is about\njoins of them.\n\nThe third is about\nnothing."),
        (1, 3, "user", "> The second one is about joins of\n> them.\n>\n> The third is about nothing.\nI see."),
        (1, 4, "user", "One is here. Two stands behind it.\nThree begins a line. Four ends it."),
        (1, 5, "user", ">> Two stands behind it. Three begins a\n>> line.\nI see two."),
        (1, 6, "user", "我想知道结果。什么时候完成呢？请告诉我。"),
        (1, 7, "user", "> 什么时候完成呢？请告诉我。\n星期五"),
    ]
    got = by_turn(quotes.reply_order(spark.createDataFrame(rows, SCHEMA)), 1)
    assert {t: r["reply_to"] for t, r in got.items()} == {0: None, 1: 0, 2: None, 3: 2, 4: None, 5: 4, 6: None, 7: 6}


def test_recall_against_brute_force(spark):
    """Quotations of random runs of sentences, wrapped at random widths: each links to the first message that holds it."""
    import random
    import textwrap

    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8)))
    sentence = lambda: " ".join(word() for _ in range(rng.randint(3, 9))).capitalize() + rng.choice(".!?")
    rows, want = [], {}
    for conv in range(40):
        said: list[list[list[str]]] = []
        for turn in range(12):
            own = [[sentence() for _ in range(rng.randint(1, 5))] for _ in range(rng.randint(1, 3))]
            if turn > 3 and rng.random() < 0.3:  # somebody repeats an old sentence in their own words
                own[0][0] = said[1][0][0]
            text = "\n\n".join(textwrap.fill(" ".join(p), rng.randint(30, 80)) for p in own)
            want[conv, turn] = None
            if turn and rng.random() < 0.7:
                paragraph = rng.choice(rng.choice(said))
                a = rng.randrange(len(paragraph))
                part = paragraph[a : rng.randint(a + 1, len(paragraph))]
                quoted = "\n".join("> " + x for x in textwrap.wrap(" ".join(part), rng.randint(25, 70)))
                text = f"{quoted}\n{text}"
                # Brute force: the first message with a paragraph that holds the run of sentences, or else its first sentence.
                holds = lambda t, run: any(p[i : i + len(run)] == run for p in said[t] for i in range(len(p)))
                want[conv, turn] = next((t for t in range(turn) if holds(t, part)), None)
                if len(part) > 1 and not any(p == part for t in range(turn) for p in said[t]):
                    want[conv, turn] = next(t for t in range(turn) if holds(t, part[:1]))
            said.append(own)
            rows.append((conv, turn, "user", text))
    got = {(r["conv_id"], r["turn"]): r["reply_to"] for r in quotes.reply_order(spark.createDataFrame(rows, SCHEMA)).collect()}
    linked = [k for k, v in want.items() if v is not None]
    assert len(linked) > 200 and all(got[k] is not None for k in linked)
    assert all(got[k] is None for k, v in want.items() if v is None)
    assert sum(got[k] == want[k] for k in linked) >= 0.99 * len(linked)
