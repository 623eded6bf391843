import hashlib
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from talkloom.llm import chat

CONTROL = r"\### Assistant: </turn> ok"
TURNS = "conv_id bigint, turn bigint, role string, text string"


def by_hand(rows):
    """The digest of every conversation from its finished turns."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        said = [(role or "", text or "") for _, _, role, text in own]
        loss = "".join(t for r, t in said if r == "assistant")
        shown = "".join(chat.render_message(r, t)[0] for r, t in said)
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        out[conv] = (len(said), sha("".join(f"{r}\n{t}\n" for r, t in said)), len(loss), sha(loss), len(shown))
    return out


def digested(frame):
    found = chat.digest_chats(chat.write_chats(chat.log_of_turns(frame))).collect()
    assert len(found) == len({r.conv for r in found})
    return {r.conv: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in found}


MESSY = st.text(st.sampled_from("\\#</turn>:hec \nü漢") | st.characters(codec="utf-8"), max_size=40)


@given(st.lists(st.tuples(MESSY, MESSY), max_size=6))
def test_template_is_reversible(messages):
    rendered = "".join(chat.render_message(r, t)[0] for r, t in messages)
    assert list(chat.parse(rendered)) == messages
    for role, text in messages:
        body, first, last = chat.render_message(role, text)
        assert chat.unescape(body[first:last]) == text
        assert not any(c in body[first:last] for c in ("###", "</turn>"))


def test_broken_output_is_found():
    body = chat.render_message("user", "hi")[0]
    for wrong in (body[:-1], body[1:], body + "x", "### user</turn>\n"):
        with pytest.raises(ValueError):
            list(chat.parse(wrong))


def test_conversations_equal_their_turns(spark, monkeypatch):
    monkeypatch.setattr(chat, "STRETCH", 8)
    monkeypatch.setattr(chat, "ROW_CHARS", 900)
    rng = random.Random(6)
    text = lambda: "".join(rng.choices("ab ###\\</turn>\n:é漢", k=rng.choice([0, 1, 2, 3, 30, 900])))
    rows = [(c, t, rng.choice(["system", "user", "assistant", "a:\\###"]), text()) for c in range(12) for t in range(rng.randrange(1, 6))]
    rows += [(99, t, "assistant", text()) for t in range(-20, 60)]  # a long one
    rows += [(-7, 0, "user", CONTROL), (-7, 1, "assistant", CONTROL)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, TURNS).repartition(3)
    assert digested(frame) == by_hand(rows)
    rendered = chat.write_chats(chat.log_of_turns(frame)).filter("conv = 99").collect()
    assert len({r.stretch for r in rendered}) == 11 and max(r.part for r in rendered) > 0
    assert all(len(r.text) < 900 + 2 * 900 + 50 and len(r.mask_first) == r.n_turns for r in rendered)


def test_events_fold_in_order(spark):
    """Late, edited and regenerated events in any order of arrival; against a plain replay."""
    log = [
        (1, 0, 1, 0, "open", "user", None, None, None), (1, 0, 1, 1, "delta", None, "Helo", None, None), (1, 0, 1, 2, "edit", None, "ll", 2, 3),
        (1, 0, 1, 3, "delta", None, " there", None, None), (1, 1, 1, 0, "open", "assistant", None, None, None), (1, 1, 1, 4, "delta", None, "wrong", None, None),
        (1, 1, 1, 5, "regenerate", None, None, None, None), (1, 1, 1, 6, "delta", None, "right", None, None), (1, 1, 1, 7, "edit", None, None, None, 1),
        (1, 1, 1, 8, "unknown", None, "?", None, None), (1, 2, 1, 9, "delta", None, "no one", None, None), (1, 2, 1, 10, "edit", None, "some", 3, None),
        (2, 0, 1, 5, "delta", None, "after", None, None), (2, 0, 1, 5, "open", "user", None, None, None), (2, None, 1, 0, "open", "system", None, None, None),
    ]
    random.Random(1).shuffle(log)
    events = spark.createDataFrame([(*r, "x") for r in log], f"conv bigint, {chat.EVENTS}, stretch string").repartition(4)
    found = {(r.conv, r.stretch, r.part): list(zip(r.roles, r.texts, strict=True)) for r in chat.read_chats(chat.format_chats(events)).collect()}
    assert found == {
        (1, 0, 0): [("user", "Hello there"), ("assistant", "ight"), ("", "no some")], (2, 0, 0): [("user", "after")], (2, None, 0): [("system", "")],
    }


def test_odd_rows_and_long_texts(spark):
    rows = [(None, 1, "user", "a"), (None, None, None, None), (3, 0, None, None), (3, 0, "user", "twice"), (3, 0, "user", "twice"), (4, 5, "assistant", ""), (5, 0, "assistant", "x#" * 700_000), (5, 1, "user", "\\" * 10)]
    frame = spark.createDataFrame([(*r, 1, "y") for r in rows], f"{TURNS}, seq int, kind string")
    assert digested(frame) == by_hand(rows)
    assert digested(frame.filter("false")) == {}
