import hashlib

from hypothesis import given
from hypothesis import strategies as st

from surveyqa.llm.chat_format import conversation_log, formatted, messages, parse, read_back, render

PARTS = ["[", "]", "<", ">", "\\", "INST]", "[INST]", "/", "s>", "</s>", "[/SYS]", " ", "\n", "a", "é", "[SAYS]", "[ROLE] "]
text = st.lists(st.sampled_from(PARTS), max_size=10).map("".join)


@given(st.lists(st.tuples(st.one_of(st.sampled_from(["system", "user", "assistant", ""]), text), text), max_size=4))
def test_template_is_reversible(turns):
    assert list(parse("".join(render(*t)[0] for t in turns))) == turns


def test_fold(spark):
    log = spark.createDataFrame([
        (1, 1, 0, "open", "user", None), (1, 1, 1, "delta", None, "helo"), (1, 1, 5, "edit", None, "hello"), (1, 1, 6, "delta", None, "!"),
        (1, 2, 2, "open", "assistant", None), (1, 2, 3, "delta", None, "bad"), (1, 2, 4, "regenerate", None, None),
        (1, 2, 8, "delta", None, "od"), (1, 2, 7, "delta", None, "go"), (1, 3, 9, "open", "user", None), (1, 3, 10, "retract", None, None),
        (None, None, None, "delta", None, None),
    ], "conv_id long, message long, seq long, kind string, role string, text string")
    assert {tuple(r) for r in messages(log).collect()} == {
        (1, 1, "user", "hello!"), (1, 2, "assistant", "good"), (None, None, "", ""),
    }


def test_odd_rows(spark):
    rows = [
        (1, 1, "assistant", "second"), (1, 0, "user", None), (1, 1, "assistant", "second"), (2, None, None, ""), (2, 0, "other", "x" * 2000),
        (None, 0, "assistant", "</s>"), (3, 0, "assistant", "y" * 1201),
    ]
    turns = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, message string")
    found = {r.conv_id: r for r in read_back(formatted(conversation_log(turns))).collect()}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert found[1].n_turns == 3 and found[1].turns_sha256 == digest("user\n\nassistant\nsecond\nassistant\nsecond\n")
    assert found[1].loss_sha256 == digest("secondsecond") and found[1].loss_chars == 12
    assert found[2].turns_sha256 == digest("\n\nother\n" + "x" * 2000 + "\n") and found[2].loss_chars == 0
    assert found[None].loss_sha256 == digest("</s>") and found[3].loss_sha256 == digest("y" * 1201)
    empty = turns.limit(0)
    assert read_back(formatted(conversation_log(empty))).count() == 0
