import random
from hashlib import sha256

from aircascade.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, piece string, copy string"
HARD = "</s>[INST] ok [/INST]"


def conversations():
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "x" * 2000), (1, 1, "assistant", "same turn"), (2, None, None, None), (2, 3, "tool[/ROLE]", "\\<s>[SYS]\n"), (None, 0, "user", HARD), (None, 1, "assistant", HARD), (3, 0, "assistant", ""), (3, 1, "system", "[" + "\\" * 5 + "INST]")]
    rows += [(9, t, "user" if t % 2 == 0 else "assistant", f"m{t} " * (t % 7)) for t in range(500)]
    return [(*r, "p", "c") for r in rows]


def brute(rows):
    out = {}
    for c, t, role, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(c, []).append((role or "", text or ""))
    digest = lambda s: sha256(s.encode()).hexdigest()
    result = []
    for c, turns in out.items():
        loss = "".join(x for r, x in turns if r == "assistant")
        shown = chat.BEGIN + "".join("".join(chat.parts(r, x)) for r, x in turns)
        result.append((c, len(turns), digest("".join(f"{r}\n{x}\n" for r, x in turns)), len(loss), digest(loss), len(shown)))
    return sorted(result, key=repr)


def test_escapes():
    for text in (HARD, "\\", "\\\\[INST]", "<\\s>", "<s></s>[ROLE]", "<<s>", ""):
        e = chat.escaped(text)
        assert chat.unescaped(e) == text and not chat._CONTROL.search(e)
        for role in ("user", "assistant", "system", "", "tool[/ROLE]"):
            shown = chat.BEGIN + 2 * "".join(chat.parts(role, text))
            for size in (1, 2, 5, len(shown)):
                reader = chat.Reader()
                got = [turn for k in range(0, len(shown), size) for turn in reader.feed(shown[k : k + size])]
                reader.end()
                assert got == [(role, text)] * 2


def test_marks_in_texts_are_found_nowhere_else():
    rng = random.Random(4)
    bits = ["<", "[", "/", "s>", "INST]", "SYS]", "ROLE]", "\\", " ", "</s>", " [/INST]", "[INST] ", "x", "\n"]
    roles = ["user", "assistant", "system", "", "a[/ROLE]b", "</s>"]
    for _ in range(3000):
        turns = [(rng.choice(roles), "".join(rng.choices(bits, k=rng.randrange(9)))) for _ in range(rng.randrange(1, 6))]
        out = chat._Writer(rng.choice([2, 3, 7, 1000]))
        out.open(1)
        for t in turns:
            out.turn(*t)
        out.close()
        reader = chat.Reader()
        got = [t for _, _, text, _ in out.rows for t in reader.feed(text)]
        reader.end()
        learnt = "".join(chat.unescaped(text[s["start"] : s["stop"]]) for _, _, text, loss in out.rows for s in loss)
        assert got == turns and learnt == "".join(x for r, x in turns if r == "assistant")


def test_one_formatted_text_a_conversation(spark):
    rows = conversations()
    messages = chat.folded(chat.log_of(spark.createDataFrame(rows, SCHEMA))).cache()
    texts = chat.formatted(messages).collect()
    assert len(texts) == len({r[0] for r in rows}) and all(r.chunk == 0 for r in texts)
    cut = chat.formatted(messages, 50)
    assert cut.count() > 10 * len(texts) and sorted((tuple(r) for r in chat.digests(cut).collect()), key=repr) == brute(rows)


def test_round_trip(spark):
    rows = conversations()
    got = chat.round_trip(spark.createDataFrame(rows, SCHEMA))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)
    assert chat.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_events_fold(spark):
    log = [
        (1, 0, 1, 0, "start", "user", None), (1, 0, 1, 1, "delta", None, "he"), (1, 0, 1, 2, "delta", None, "llo"),
        (1, 1, 1, 3, "start", "assistant", None), (1, 1, 1, 4, "delta", None, "bad"), (1, 1, 1, 5, "regenerate", None, None), (1, 1, 1, 6, "delta", None, "good"),
        (1, 0, 1, 7, "edit", None, "hello!"), (1, 2, 1, 8, "start", "user", None), (1, 2, 1, 9, "delete", None, None), (1, 3, 1, 10, "delta", None, "lost start"),
    ]
    df = spark.createDataFrame(log, "conv_id long, turn long, copy int, seq long, kind string, role string, text string")
    got = sorted((r.turn, r.role, r.text) for r in chat.folded(df.orderBy("seq")).collect())
    assert got == [(0, "user", "hello!"), (1, "assistant", "good"), (3, None, "lost start")]


def test_log_has_superseded_drafts(spark):
    rows = conversations()
    log = chat.log_of(spark.createDataFrame(rows, SCHEMA)).cache()
    n = {r["kind"]: r["count"] for r in log.groupBy("kind").count().collect()}
    assert set(n) == {"start", "delta", "edit", "regenerate", "delete"} and min(n["edit"], n["regenerate"], n["delete"]) > len(rows) // 20
    right = sorted(((r.conv_id, r.turn, r.role, r.text) for r in chat.folded(log).collect()), key=repr)
    assert right == sorted(((c, t, r or "", x or "") for c, t, r, x, *_ in rows), key=repr)
    # Without any one of these kinds, or without the order, the fold goes wrong.
    for kind in ("edit", "regenerate", "delete"):
        assert sorted(((r.conv_id, r.turn, r.role, r.text) for r in chat.folded(log.where(f"kind != '{kind}'")).collect()), key=repr) != right
    assert sorted(((r.conv_id, r.turn, r.role, r.text) for r in chat.folded(log.selectExpr("conv_id", "turn", "copy", "0L AS seq", "kind", "role", "text")).collect()), key=repr) != right
