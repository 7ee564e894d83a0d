import random

from loomcast.llm.chats import SEGMENT, format_chats, prefixes


def brute(rows):
    chats = {}
    for c, turn, role, text in set(rows):
        if c is not None:
            chats.setdefault(c, []).append((turn if turn is not None else -1, role or "", text or ""))
    said = {c: [x[1:] for x in sorted(t)] for c, t in chats.items()}
    out = {}
    for c, own in said.items():
        if any(len(o) > len(own) and o[: len(own)] == own for o in said.values()):
            continue
        if any(o == own and d < c for d, o in said.items()):
            continue
        clean = lambda s: s.replace("<|", "< |")
        out[c] = (len(own), "".join(f"<|{clean(r)}|>\n{clean(t)}\n<|end|>\n" for r, t in own))
    return out


def rendered(table):
    got = {}
    for r in sorted(format_chats(table).collect(), key=lambda r: (r.conv_id, r.segment)):
        n, text = got.get(r.conv_id, (r.n_turns, ""))
        assert n == r.n_turns
        got[r.conv_id] = (n, text + r.rendered)
    return got


def rows_of(seed):
    draw, rows = random.Random(seed), []
    for c in range(60):
        if c and draw.random() < 0.5:  # a snapshot of an earlier one, perhaps longer, perhaps changed
            other = draw.randrange(c)
            base = [r for r in rows if r[0] == other]
            own = [(c, *r[1:]) for r in base[: draw.randrange(len(base) + 1)]]
        else:
            own = []
        for t in range(len(own), len(own) + draw.randrange(0 if own else 1, 4)):
            own.append((c, t, draw.choice(["user", "assistant"]), draw.choice(["hi", "yes", "no <|end|>", ""])))
        rows += own
    return rows


def test_equals_brute_force(spark):
    for seed in range(2):
        rows = rows_of(seed)
        table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
        assert rendered(table) == brute(rows)


def test_one_conversation_over_many_tasks(spark):
    rows = [(1, t, "user", f"say {t % 7}") for t in range(1500)] + [(2, t, "user", f"say {t % 7}") for t in range(700)] + [(3, 0, "user", "say 0")]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed, hashes = prefixes(table)
        assert placed.filter("conv_id = 1").select("part").distinct().count() > 1
        assert rendered(table) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert format_chats(table).count() == -(-1500 // SEGMENT)


def test_odd_rows(spark):
    rows = [(1, 0, None, None), (1, 0, None, None), (1, 1, "a", "x" * 50_000), (None, 0, "a", "b"), (2, None, "a", "b"), (2, 3, "a", None), (4, 0, "", "")]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id long, turn int, role string, text string, place string, part string")
    assert rendered(table) == brute(rows)
    assert format_chats(table.limit(0)).count() == 0
