"""Chat formatting: round trip, merged turns, parts, loss mask, edge cases."""

import hashlib
import itertools
import random

from pyspark.sql import functions as F

from voxspark.llm import chat

KIND = "conv_id long, turn long, role string, text string, part string, n_parts string, runs int, formatted string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, "z") for r in rows], KIND).repartition(3)


def in_order(rows):
    """Rows of one conversation, by turn (null first), role and text."""
    return sorted(((t is not None, t or 0, r or "", x or "") for _, t, r, x in rows))


def escaped(text):
    out, i = "", 0
    while i < len(text):
        k = i + 1
        while text[i] == "<" and k < len(text) and text[k] == "\\":
            k += 1
        if text[i] == "<" and k < len(text) and text[k] == "|":
            out += "<\\" + text[i + 1 : k + 1]
            i = k + 1
        else:
            out += text[i]
            i += 1
    return out


def written(rows):
    return "".join(
        "<|im_start|>" + escaped(role).replace("\n", "<|nl|>") + "\n" + "<|im_sep|>".join(escaped(x) for *_, x in run) + "<|im_end|>\n"
        for role, run in itertools.groupby(in_order(rows), key=lambda r: r[2]))


def check(spark, rows, span):
    parts = chat.format_turns(table(spark, rows), span=span)
    whole = {}
    for p in sorted(parts.collect(), key=lambda p: p["part"]):
        w = whole.setdefault(p["conv_id"], ["", ""])
        w[0] += p["formatted"]
        w[1] += "".join(p["formatted"][s["start"] : s["start"] + s["length"]] + "|" for s in p["loss_spans"])
    got = {r["conv_id"]: r for r in chat.digests(parts).collect()}
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    assert whole.keys() == by.keys() == got.keys() and parts.where("n_parts > 1").isEmpty() == (span > 100)
    for conv, own in by.items():
        assert whole[conv][0] == written(own)
        assert whole[conv][1] == "".join(escaped(x) + "|" for _, _, r, x in in_order(own) if r == "assistant")
        said = "".join(f"{r}\n{x}\n" for _, _, r, x in in_order(own))
        loss = "".join(x for _, _, r, x in in_order(own) if r == "assistant")
        digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
        assert got[conv].asDict() == {
            "conv_id": conv, "n_turns": len(own), "turns_sha256": digest(said), "loss_chars": len(loss), "loss_sha256": digest(loss),
            "formatted_chars": len(whole[conv][0])}


def test_round_trip_in_one_and_many_parts(spark):
    rng = random.Random(3)
    bits = ["<", "|", "\\", "im_end", "|>", "<|im_end|>", "<|im_start|>", "<|im_sep|>", "\n", "é", "😀", "<\\|", "a ", "$1", "<|nl|>"]
    roles = ["user", "assistant", "assistant", "system", "", "a\nb", "<|nl|>", "<|im_end|>\n"]
    rows = [(c, t, rng.choice(roles), "".join(rng.choices(bits, k=rng.randint(0, 6)))) for c in range(6) for t in range(30)]
    for span in (1, 4, 1000):
        check(spark, rows, span)


def test_edge_cases(spark):
    rows = [
        (1, None, "user", "first"), (1, 5, "user", "x"), (1, 5, "user", "x"), (1, 5, None, None), (1, -70, "assistant", None), (1, 9, "assistant", ""),
        (None, 1, "assistant", "no id"), (None, 200, "assistant", "same run"), (2, 0, None, None), (3, 0, "assistant", "word " * 100_000),
        *[(4, t, "assistant", "same role all along") for t in range(300)],
    ]
    check(spark, rows, 64)
    assert chat.digests(chat.format_turns(table(spark, rows).limit(0))).count() == 0


def test_no_python_and_one_shuffle_of_the_texts(spark):
    rows = table(spark, [(c, t, "user", "x") for c in range(3) for t in range(90)])
    plan = chat.digests(chat.format_turns(rows))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert chat.format_turns(rows).where(F.col("formatted").contains("<|im_start|>")).count() > 0
