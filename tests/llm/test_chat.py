import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidewater.llm import chat as C

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def test_escape_is_reversible_and_safe():
    r = random.Random(2)
    bits = [*C.CONTROL, "\\", "-", "n", "\n", "<", "|", ">", "s", "[", "/", "é", "<|turn", "|>"]
    for _ in range(5000):
        t = "".join(r.choices(bits, k=r.randint(0, 12)))
        e = C.escape(t)
        assert C.unescape(e) == t and not any(c in e for c in C.CONTROL)
        role = "".join(r.choices(bits, k=r.randint(0, 3)))
        assert C.read_back(C.render([(role, t), ("user", "x")])) == [(role, t), ("user", "x")]


def expected(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        h = hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in turns).encode()).hexdigest()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), h, len(loss), hashlib.sha256(loss.encode()).hexdigest(),
                     len(C.render([(r, t) for _, _, r, t in turns])))
    return out


def test_digests(spark):
    rows = [(1, 0, "user", "hi </s>"), (1, 1, "assistant", "a\\b [INST]"), (1, 2, "user", None), (1, 3, "assistant", ""),
            (2, 5, None, "x"), (2, 5, None, "x"), (2, 5, "assistant", "same turn"), (None, 0, "user", "no id"), (3, None, "sys\ntem", "n"),
            (4, 0, "user", "😀" * 50_000)]
    rows += [(9, k, "user" if k % 2 else "assistant", f"turn {k}") for k in range(500)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("place", F.lit(1)).withColumn("piece", F.lit("x"))
    got = {r["conv_id"]: tuple(r)[1:6] for r in C.digests(C.format_conversations(df)).collect()}
    assert got == expected(rows)
    assert C.digests(C.format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0


def test_spans_point_into_the_whole_output(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", f"t{k} <s> \\ {C.END}") for k in range(9)]
    pieces = sorted(C.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect(), key=lambda r: r["place"])
    whole = C.render([(r, t) for _, _, r, t in rows])
    assert "".join(p["piece"] for p in pieces) == whole
    for p, (_, _, role, text) in zip(pieces, rows, strict=True):
        assert whole[p["start"]:p["start"] + len(p["piece"])] == p["piece"]
        assert C.unescape(p["piece"][p["content_start"]:p["content_end"]]) == text
        assert p["trained"] == (role == "assistant") and not p["rewrites"] and not p["unstable"]


def foreign_templates():
    """Nested, so that they travel to the workers by value."""
    def last_only(messages):  # drops the thoughts of all but the last turn, so history changes
        return "".join(f"<{r}>{t if k == len(messages) - 1 else t.split('|')[-1]}</{r}>" for k, (r, t) in enumerate(messages))

    def bos(messages):
        return "<s>" + "".join(f"({r}) {t}\n" for r, t in messages)

    def trims(messages):
        return "".join(f"({r}) {t.strip()}\n" for r, t in messages)

    return last_only, bos, trims


def test_templates_that_rewrite_history_are_detected(spark):
    last_only, bos, _ = foreign_templates()
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "thought|answer"), (1, 2, "user", "next"), (2, 0, "user", "plain")]
    got = C.format_conversations(spark.createDataFrame(rows, SCHEMA), last_only).collect()
    assert [r["rewrites"] for r in sorted(got, key=lambda r: (r["conv_id"], r["place"]))] == [False, False, True, False]
    clean = C.format_conversations(spark.createDataFrame(rows, SCHEMA), bos).collect()
    assert not any(r["rewrites"] or r["unstable"] for r in clean)


def test_located_content_of_a_foreign_template():
    _, bos, trims = foreign_templates()
    locator = C.TurnLocator(bos)
    for role, text in [("user", "a\n"), ("assistant", "\n\n"), ("user", ""), ("user", "(user) ")]:
        piece, first, end, rewrites, unstable = locator.feed((role, text))
        assert piece[first:end] == text and not rewrites and not unstable
    assert C.TurnLocator(trims).feed(("user", " a "))[0] == "(user) a\n"


def test_history_rewritten_from_far_back(spark):
    def moved(messages):  # the system text stands in the last user turn; a first system turn is required
        assert messages[0][0] == "system"
        last = max((k for k, (r, _) in enumerate(messages) if r == "user"), default=None)
        return "<s>" + "".join(f"<{r}>{messages[0][1] + '/' if k == last else ''}{t}</{r}>"
                               for k, (r, t) in enumerate(messages) if k)

    rows = [(1, 0, "system", "be brief"), *((1, k, "user" if k % 2 else "assistant", f"t{k}") for k in range(1, 12))]
    got = sorted(C.format_conversations(spark.createDataFrame(rows, SCHEMA), moved).collect(), key=lambda r: r["place"])
    assert [r["rewrites"] for r in got] == [role == "user" and k > 1 for _, k, role, _ in rows]
    for k, p in enumerate(got):
        whole = moved([(r, t) for _, _, r, t in rows[:k + 1]])
        assert whole[p["start"]:] == p["piece"]
        assert k % 2 == 0 or p["piece"].endswith(f"<user>be brief/t{k}</user>")


def test_read_back_refuses_damage():
    with pytest.raises(ValueError):
        C.read_back(C.render([("user", "x")])[:-2])
