import hashlib
import random

import pyarrow as pa
import pytest

from wayside.llm import chat
from wayside.llm.chat import digests, escape, format_conversations, read_turns, unescape

SCHEMA = "conv_id long, turn long, role string, text string, part int, loss string"
NASTY = ["", "</s>[INST] ok [/INST]", "\\", "\\\\s>", "<\\s>", "<<s>s>", "[/[/INST]INST]", "a\nb", "é🙂", None, "[INST][/INST]</s><s>"]


def make(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def test_escapes_are_reversible_and_leave_no_control_string():
    rng = random.Random(0)
    texts = [t for t in NASTY if t is not None]
    texts += ["".join(rng.choice("<s>/[]INST\\") for _ in range(rng.randrange(30))) for _ in range(3000)]
    escaped = escape(pa.array(texts))
    assert not [e for e in escaped.to_pylist() if any(c in e for c in chat.CONTROL)]
    assert unescape(escaped).to_pylist() == texts


def conversations(seed):
    rng = random.Random(seed)
    rows = [(-7, 0, "user", NASTY[1]), (-7, 1, "assistant", NASTY[1]), (None, 0, None, "no conversation"), (5, None, "assistant", "no turn")]
    for c in range(30):
        for t in range(rng.randrange(1, 8)):
            rows.append((c, t // 2 if c % 5 == 0 else t, rng.choice(["user", "assistant", "system", "a<s>b", None]), rng.choice(NASTY) if t % 2 else "t" * rng.randrange(60)))
    rows += [(77, t, "assistant" if t % 2 else "user", f"long {t} " + "é" * 50) for t in range(200)]
    return rows + rows[40:50]


def expected(rows):
    out = {}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", (r[3] or "").encode())
    for c in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == c), key=order)
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)
        learnt = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        out[c] = (len(mine), hashlib.sha256(turns.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    return out


@pytest.mark.parametrize("part_bytes", [8 << 20, 300, 1])
def test_round_trip(spark, monkeypatch, part_bytes):
    rows = conversations(1)
    monkeypatch.setattr(chat, "PART_BYTES", part_bytes)
    formatted = format_conversations(make(spark, rows)).toPandas().sort_values(["conv_id", "part"])
    want = expected(rows)
    for c, g in formatted.groupby("conv_id", dropna=False):
        n, turns_sha, n_loss, loss_sha = want[None if c != c else int(c)]
        assert g.part.tolist() == list(range(len(g)))
        turns = [t for f in g.formatted for t in read_turns(f)]
        assert len(turns) == n == g.n_turns.sum()
        assert hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest() == turns_sha
        learnt = [f.encode()[s["start"] : s["start"] + s["length"]].decode() for f, loss in zip(g.formatted, g.loss) for s in loss]
        assert hashlib.sha256("".join(unescape(pa.array(learnt, pa.string())).to_pylist()).encode()).hexdigest() == loss_sha
    if part_bytes == 1:
        assert formatted.groupby("conv_id").size()[77] > 100


@pytest.mark.parametrize("part_bytes", [8 << 20, 300])
def test_digests(spark, monkeypatch, part_bytes):
    rows = conversations(2)
    monkeypatch.setattr(chat, "PART_BYTES", part_bytes)
    got = digests(format_conversations(make(spark, rows))).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == expected(rows)
    assert all(r.formatted_chars >= 20 * r.n_turns for r in got)


def test_empty_table(spark):
    assert digests(format_conversations(make(spark, []))).collect() == []


def test_template(spark):
    rows = make(spark, [(1, 0, "user", "hi"), (1, 1, "assistant", "a[INST]b")])
    (r,) = format_conversations(rows).collect()
    assert r.formatted == "<s>user[INST]hi[/INST]</s><s>assistant[INST]a[\\INST]b[/INST]</s>"
    assert [r.formatted.encode()[s.start : s.start + s.length] for s in r.loss] == [b"a[\\INST]b"]
