from verdigris.llm import chat

PAIRS = "pair_id long, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>, prompt string, turns int"


def formatted(spark, pairs):
    rows = [(number, chosen, rejected, "clash", 1) for number, chosen, rejected in pairs]
    return {r.pair_id: r for r in chat.format_preferences(spark.createDataFrame(rows, PAIRS), ["pair_id"]).collect()}


def written(turns):
    return "".join(f"<|turn|>{role or ''}\n{text or ''}<|end|>\n" for role, text in turns)


def test_prompt_is_the_longest_common_start(spark):
    system, user = ("system", "Be kind."), ("user", "Hi 😀")
    good, bad = ("assistant", "Hello"), ("assistant", "What")
    more = [("user", "And?"), ("assistant", "So.")]
    rows = formatted(spark, [
        (1, [system, user, good], [system, user, bad]), (2, [user, good, *more], [user, bad]), (3, [good], [user]),
        (4, [user, good], [user, good]), (5, [user, good], [user]), (6, [], []), (7, None, [good]), (8, [user, (None, None)], [user, ("assistant", None)]),
    ])
    assert [rows[k].n_prompt_turns for k in range(1, 9)] == [2, 1, 0, 2, 1, 0, 0, 1]
    assert rows[1].prompt == written([system, user]) and rows[1].chosen_text == written([good]) and rows[1].rejected_text == written([bad])
    assert [rows[k].usable for k in range(1, 9)] == [True, True, False, False, False, False, False, False]
    assert rows[8].chosen_text == written([(None, None)])
    # The mask covers text and end mark of each reply, in code points of the completion.
    spans = [(s.start, s.end) for s in rows[2].chosen_spans]
    assert [rows[2].chosen_text[a:b] for a, b in spans] == ["Hello<|end|>\n", "So.<|end|>\n"]


def test_pairs_of_conversations(spark):
    turns = [
        (1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "r"), (1, 3, "assistant", "b"), (1, 4, "user", "open"),
        (2, 1, "assistant", "only"), (2, 0, "user", "q"), (3, 0, "user", "q"), (4, 0, "assistant", None), (None, 0, "user", None),
        (5, 0, "user", "q"), (5, 0, "user", "q"), (5, 1, "assistant", "z"),
    ]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    pairs = {r.conv_id: r for r in chat.weakened_pairs(chat.gather_turns(table)).collect()}
    texts = lambda side: [t.text for t in side]
    assert texts(pairs[1].chosen) == ["q", "a", "r", "b"] and texts(pairs[1].rejected) == ["q", "a", "r", "a"]
    assert texts(pairs[2].chosen) == ["q", "only"] and texts(pairs[2].rejected) == ["q", ""]
    assert pairs[3].chosen == pairs[3].rejected and texts(pairs[4].rejected) == [""] and len(pairs) == 6
    assert texts(pairs[5].chosen) == ["q", "q", "z"]


def test_empty_table(spark):
    table = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_preferences(chat.weakened_pairs(chat.gather_turns(table)), ["conv_id"]).count() == 0


def test_turns_without_a_key(spark):
    """A third of the turns has no key: each is a conversation of its own; very long turns and clashing columns pass."""
    long = "word " * 200_000
    turns = [(None if n % 3 == 0 else n % 5, n, "assistant" if n % 2 else "user", long if n == 7 else f"t{n}", "x") for n in range(300)]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, turns string")
    found = chat.gather_turns(table).collect()
    assert sorted(len(row.turns) for row in found if row.conv_id is None) == [1] * 100
    assert sum(len(row.turns) for row in found) == 300 and len(found) == 105
    usable = chat.format_preferences(chat.weakened_pairs(chat.gather_turns(table)), ["conv_id"]).filter("usable").count()
    assert usable == 5 + 50
