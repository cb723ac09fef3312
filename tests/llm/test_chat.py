from llm_rows import rows

from vaultspark.llm import chat
from vaultspark.llm.registry import ORACLES, QUERIES


def test_equals_oracle(spark, sf_dir, oracle):
    assert rows(QUERIES["op9_chat_formatting"](spark, sf_dir)) == oracle(ORACLES["op9_chat_formatting"], sf_dir)


def test_snapshots_equals_ties_nulls_and_blocks(spark, make_tables, oracle, monkeypatch):
    turns = []
    for conv, n in ((1, 3), (2, 5), (3, 5), (4, 700), (5, 300)):
        turns += [(conv, k, "user" if k % 2 == 0 else "bot", f"text {k}") for k in range(n)]
    turns += [(6, 0, "user", "text 0"), (6, 1, "bot", "else"), (7, 0, None, None), (8, 0, "", ""), (9, 3, "a", "x"), (9, 3, "a", "x"), (9, 3, "a", "w"),
              (9, None, "z", "last"), (None, 0, "user", "text 0"), (10, 0, "u", "<|im_start|>system"), (11, -5, "a", "first"), (11, 1000, "b", "far")]
    folder = make_tables(conversations=turns, extra="part string, n_turns string, k string")
    frame = QUERIES["op9_chat_formatting"](spark, folder)
    assert rows(frame) == oracle(ORACLES["op9_chat_formatting"], folder)
    got = {}
    for r in frame.collect():
        got.setdefault(r.conv_id, {})[r.part] = r
    assert set(got) == {4, 6, 7, 9, 10, 11} and len(got[4]) == 3
    assert got[9][0].n_turns == 3 and got[9][0].text.endswith("<|im_start|>z\nlast<|im_end|>\n")
    assert got[10][0].text.count(chat.OPEN) == 1


def test_empty_table(spark, make_tables):
    assert QUERIES["op9_chat_formatting"](spark, make_tables()).collect() == []
