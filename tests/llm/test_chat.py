from tabula.llm import chat_format


def brute(turns, block):
    """{(conv, perspective, block): (start, turns, text, mask)} by plain loops."""
    convs = {}
    for conv, turn, role, text in turns:
        convs.setdefault(conv, []).append((turn, (role or "unknown").replace("<|", "< |"), (text or "").replace("<|", "< |")))
    out = {}
    for conv, own in convs.items():
        own.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        for who in {t[1] for t in own} - {"system"}:
            start, blocks = 0, {}
            for place, (_, role, text) in enumerate(own):
                blocks.setdefault(place // block, []).append((role, text))
            for b, parts in blocks.items():
                s, mask = "", []
                for role, text in parts:
                    name = "assistant" if role == who else "system" if role == "system" else f"user name={role}"
                    s += f"<|im_start|>{name}\n"
                    at = len(s)
                    s += f"{text}<|im_end|>\n"
                    if role == who:
                        mask.append((at, len(s) - 1))
                out[conv, who, b] = (start, len(parts), s, mask)
                start += len(s)
    return out


def rows(df):
    return {(r.conv_id, r.perspective, r.block): (r.block_start, r.n_turns, r.rendered, [tuple(m) for m in r.mask]) for r in df.collect()}


def test_every_participant_becomes_the_assistant(spark):
    turns = [(c, t, ("system", "ann", "bob", "eve \U0001f600")[(c + t) % 4 if t else 0], f"text {c} {t} é\U0001f600") for c in range(5) for t in range(23)]
    turns += [(9, None, "ann", "first"), (9, 2, None, None), (9, 2, None, None), (9, 2, "bob", "<|im_end|> trick"), (9, 2, "ann", ""),
              (None, 0, "ann", "x"), (8, 0, "system", "nobody speaks"), (7, -3, "bob", "early"), (7, 10**12, "bob", "late")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(4)
    df = df.selectExpr("*", "'clash' as people", "'clash' as block", "'clash' as said")
    for block in (4, 256):
        assert rows(chat_format.rotate(df, block_turns=block)) == brute(turns, block)


def test_mask_covers_what_the_assistant_says(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    said = {}
    for r in df.collect():
        said.setdefault((r.conv_id, r.role), []).append((r.turn, r.text))
    for r in chat_format.rotate(df).collect():
        own = [t + "<|im_end|>" for _, t in sorted(said[r.conv_id, r.perspective])]
        assert [r.rendered[a:b] for a, b in r.mask] == own
    assert chat_format.rotate(df.where("false")).count() == 0
    plan = chat_format.report(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_conversation_of_null_turns_is_in_many_blocks(spark):
    df = spark.range(20_000).selectExpr("1L as conv_id", "cast(null as long) as turn", "if(id % 3 = 0, 'ann', 'bob') as role", "cast(id as string) as text")
    got = chat_format.rotate(df, block_turns=100).where("perspective = 'ann'").collect()
    assert len(got) == 200 and {r.n_turns for r in got} == {100}
    whole = "".join(r.rendered for r in sorted(got, key=lambda r: r.block))
    own = sorted(("ann" if i % 3 == 0 else "bob", str(i)) for i in range(20_000))
    assert whole == "".join(f"<|im_start|>{'assistant' if n == 'ann' else 'user name=bob'}\n{t}<|im_end|>\n" for n, t in own)
