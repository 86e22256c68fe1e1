from postlens.llm.preference_pairs import conversation_pairs, format_pairs


def render(turns):
    return "".join(f"<|{r or ''}|>\n{t or ''}<|end|>\n" for r, t in turns)


def test_format(spark):
    a = [("system", "s"), ("user", "hi"), ("assistant", "yés"), ("user", "u"), ("assistant", "z")]
    b = a[:2] + [("assistant", "no")]
    cases = [(1, a, b), (2, a, a), (3, a, a[:3]), (4, None, b), (5, [], []), (6, [("user", None), (None, "x")], [("user", None), (None, "y")]), (None, a, b), (1, a, b)]
    frame = spark.createDataFrame([(i, c, r, "p") for i, c, r in cases], "pair_id long, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>, prompt_turns_ string")
    rows = format_pairs(frame).collect()
    assert len(rows) == len(cases)
    for row in rows:
        c, r = next((c or [], r or []) for i, c, r in cases if i == row.pair_id)
        n = 0
        while n < min(len(c), len(r)) and c[n] == r[n]:
            n += 1
        assert (row.prompt_turns, row.prompt) == (n, render(c[:n]))
        for turns, text, mask in ((c[n:], row.chosen_text, row.chosen_mask), (r[n:], row.rejected_text, row.rejected_mask)):
            assert text == render(turns)
            assert [text[s.start : s.end] for s in mask] == [f"{t}<|end|>" for role, t in turns if role == "assistant"]
    assert format_pairs(frame.limit(0)).count() == 0


def pairs(rows):
    """Brute force: (id, number, chosen, rejected)."""
    held = {}
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1], r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")):
        held.setdefault(conv, []).append((role, text))
    answers = {c: [t for t in turns if t[0] == "assistant"] for c, turns in held.items() if any(t[0] == "assistant" for t in turns)}
    ids, out = sorted(answers), []
    for i, c in enumerate(ids):
        others, number = answers[ids[(i + 1) % len(ids)]], 0
        for place, turn in enumerate(held[c]):
            if turn[0] == "assistant":
                out.append((c, number + 1, held[c], [*held[c][:place], others[number % len(others)], *held[c][place + 1 :]]))
                number += 1
    return sorted(out, key=str)


def test_pairs_from_conversations(spark):
    import random
    rng = random.Random(9)
    rows = [(0, 1, "assistant", "a0"), (0, 0, "user", "u0"), (6, 0, "user", "u1"), (6, 1, "assistant", "a1"), (6, 2, "user", "v1"), (6, 3, "assistant", None), (8, 0, "user", "x"), (9, 0, "assistant", "y"), (None, 0, "assistant", "n"), (11, 0, None, "z")]
    rows += [(rng.randrange(-50, 900) * 4, t, rng.choice(["user", "assistant"]), f"t{rng.randrange(40)}") for _ in range(150) for t in range(rng.randint(1, 5))]
    for some in (rows, rows[:2], rows[4:5]):
        frame = spark.createDataFrame([(*r, "e") for r in some], "conv_id long, turn int, role string, text string, places string").repartition(4)
        got = sorted(((r.pair_id, r.answer_no, [tuple(t) for t in r.chosen], [tuple(t) for t in r.rejected]) for r in conversation_pairs(frame).collect()), key=str)
        assert got == pairs(some)
    found = format_pairs(conversation_pairs(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))).collect()
    assert len({r.prompt_turns for r in found}) > 3  # differences at every turn
    assert conversation_pairs(frame.limit(0)).count() == 0


def test_columns_named_like_outputs_are_replaced(spark):
    kind = "array<struct<role:string,text:string>>"
    frame = spark.createDataFrame([([("user", "u")], [("user", "v")], "p", "x")], f"chosen {kind}, rejected {kind}, prompt string, other string")
    made = format_pairs(frame)
    assert made.columns.count("prompt") == 1 and made.first().prompt == "" and made.first().other == "x"
