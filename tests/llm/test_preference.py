"""Operator 8 against a plain rendering of each pair."""

from tessera.llm import preference as p

SCHEMA = "conv_id long, turn long, role string, text string, prompt string"


def plain(rows):
    """pair -> (prompt turns, prompt, chosen, rejected, loss chars of both)."""
    convs = {}
    for conv, turn, role, text in {r[:4] for r in rows}:
        if conv is not None:
            convs.setdefault(conv, {}).setdefault(-1 if turn is None else turn, []).append((role, text))
    key = lambda m: tuple((x is not None, x or "") for x in m)
    convs = {c: [(t, sorted(m, key=key)) for t, m in sorted(turns.items())] for c, turns in convs.items()}
    say = lambda m: f"<|{m[0] or ''}|>\n{m[1] or ''}<|end|>\n"
    out = {}
    for k in {c // 2 for c in convs}:
        a, b = convs.get(2 * k, []), convs.get(2 * k + 1, [])
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        text = lambda turns: "".join(say(m) for _, ms in turns for m in ms)
        loss = lambda turns: sum(len(m[1] or "") + 8 for _, ms in turns for m in ms if m[0] == "assistant")
        out[k] = (n, text(a[:n]), text(a[n:]), text(b[n:]), loss(a[n:]), loss(b[n:]))
    return out


def check(spark, rows):
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    got = {}
    for r in p.rendered_pairs(df).orderBy("pair_id", "chunk").collect():
        new = (r.n_prompt_turns, r.prompt, r.chosen, r.rejected, r.chosen_loss_chars, r.rejected_loss_chars)
        old = got.get(r.pair_id)
        got[r.pair_id] = new if old is None else tuple(x + y for x, y in zip(old, new))
    assert got == plain(rows)


def test_prefixes_and_edges(spark):
    q, a, b = ("user", "question"), ("assistant", "yes"), ("assistant", "no")
    rows = [(0, 0, *q), (0, 1, *a), (1, 0, *q), (1, 1, *b),                   # one shared turn
            (2, 0, *q), (3, 0, "system", "x"),                                  # nothing shared
            (4, 0, *q), (4, 1, *a), (5, 0, *q), (5, 1, *a),                     # equal
            (6, 0, *q), (6, 1, *a), (6, 2, *q), (7, 0, *q),                     # one is the other's prefix
            (8, 0, *q), (11, 0, *a),                                            # one side missing
            (12, None, *q), (12, 3, None, None), (13, None, *q), (13, 3, "", ""),   # nulls
            (14, 0, *q), (14, 0, *q), (14, 0, *a), (15, 0, *a), (15, 0, *q),    # repeated and tied rows
            (16, 0, "user", ""), (17, 0, "user", "long " * 20_000),
            (None, 0, *q), (-2, 0, *q), (-1, 0, *q)]
    check(spark, rows)


def test_long_pair_continues_in_chunks(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"t{t}" if t < 2500 or c == 0 else f"u{t}")
            for c in (0, 1) for t in range(3000)]
    check(spark, rows)
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    assert p.rendered_pairs(df).count() == 3


def test_masks(spark):
    rows = [(0, 0, "user", "q", ""), (0, 1, "assistant", "good", ""), (0, 2, "user", "more", ""),
            (1, 0, "user", "q", ""), (1, 1, "assistant", "bad", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    r = p.format_pairs(df, p.neighbour_pairs(df)).first()
    assert [(s.text, s.loss) for s in r.chosen] == [
        ("<|assistant|>\n", False), ("good<|end|>\n", True), ("<|user|>\n", False), ("more<|end|>\n", False)]
    assert [(s.text, s.loss) for s in r.rejected] == [("<|assistant|>\n", False), ("bad<|end|>\n", True)]


def test_empty_table(spark):
    assert p.rendered_pairs(spark.createDataFrame([], SCHEMA)).count() == 0
