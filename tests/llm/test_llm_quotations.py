import random
import textwrap

import pytest

from millrace.llm import quotations as Q

DDL = "conv_id long, turn long, role string, text string, body string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], DDL)


@pytest.fixture(scope="module")
def threads(spark):
    rows = [
        (1, 0, "user", "Hello there friends.\nHow are you today?"),
        (1, 1, "assistant", "> Hello there friends.\n> How are you today?\n\nI am fine, thanks."),
        (1, 2, "user", ">> Hello there friends.\n> I am fine,   THANKS.\nGood to hear."),
        (1, 3, "assistant", "> Good to hear.\nYes.\n> How are you today?\nStill fine, thank you."),
        (1, 4, "user", "> nothing known\nBye"),
        (1, 5, "user", "> > I am fine, thanks.\n>> Hello there friends.\nSo be it"),
        (2, 0, "user", "Good to hear."),
        (2, 1, "user", "> Hello there friends.\nNo."),
        (2, 1, "user", "> Hello there friends.\nNo."),
        (None, 1, "user", "> Good to hear.\nalone"),
        (2, None, None, None),
        (3, 0, "user", "same line"),
        (3, 1, "user", "same line"),
        (3, 2, "user", "> same line\n> same line"),
    ]
    return {(r.conv_id, r.turn, r.role): r for r in Q.link_quotations(frame(spark, rows)).collect()}, Q.link_quotations(frame(spark, rows)).count(), rows


def test_parents_roots_and_depths(threads):
    got, _, _ = threads
    tree = {k: (r.parent_turn, r.root_turn, r.depth) for k, r in got.items()}
    assert tree[1, 0, "user"] == (None, 0, 0)
    assert tree[1, 1, "assistant"] == (0, 0, 1)
    assert tree[1, 2, "user"] == (1, 0, 2)
    assert tree[1, 3, "assistant"] == (0, 0, 1)  # four quoted words of turn 0, three of turn 2
    assert tree[1, 4, "user"] == (None, 4, 0)
    assert tree[1, 5, "user"] == (1, 0, 2)  # equal words of turns 1 and 0: the later one
    assert tree[2, 1, "user"] == (None, 1, 0)  # known in another conversation only
    assert tree[None, 1, "user"] == (None, 1, 0)
    assert tree[2, None, None] == (None, None, 0)
    assert tree[3, 2, "user"] == (1, 1, 1)  # the latest of equal messages


def test_texts_lose_their_quotes(threads):
    got, count, rows = threads
    assert count == len(rows)
    assert got[1, 1, "assistant"].text == "I am fine, thanks."
    assert got[1, 3, "assistant"].text == "Yes.\nStill fine, thank you."
    assert got[3, 2, "user"].text == ""
    assert got[2, None, None].text == "" and got[2, None, None].formatted == "<|user|>\n\n<|end|>"
    assert got[1, 0, "user"].formatted == "<|user|>\nHello there friends.\nHow are you today?\n<|end|>"


def test_long_chain_and_order(spark):
    rows = [(9, 0, "user", "message number 0")] + [(9, i, "user", f"> message number {i - 1}\nmessage number {i}") for i in range(1, 40)]
    out = Q.link_quotations(frame(spark, rows)).orderBy("root_turn", "depth", "turn").collect()
    assert [(r.turn, r.parent_turn, r.depth) for r in out] == [(i, i - 1 if i else None, i) for i in range(40)]


def test_empty_table(spark):
    out = Q.link_quotations(frame(spark, []))
    assert out.count() == 0 and "clash" not in out.columns


def test_wrapped_paragraphs_sentences_and_parts_of_them(spark):
    a = "The first paragraph is one long line of many words, which a mail program will wrap when somebody quotes it. It ends here."
    b = "Here the second paragraph begins, and it is long enough to be wrapped at seventy-two columns as well, without any doubt."
    wrap = lambda t: "\n".join("> " + x for x in textwrap.wrap(t, 72))
    rows = [
        (1, 0, "user", f"{a}\n\n{b}"),
        (1, 1, "assistant", f"{wrap(a)}\n>\n{wrap(b)}\n\nAgreed with both."),
        (1, 2, "user", "> It ends here.\nDoes it?"),
        (1, 3, "user", "> and it is long enough to be wrapped at seventy-two columns as well\nNo."),
        (1, 4, "user", f"{wrap(a + ' ' + b)}\nBoth in one."),
        (1, 5, "user", "> it is wrapped as well\nNot said by anybody."),
    ]
    tree = {r.turn: (r.parent_turn, r.depth) for r in Q.link_quotations(frame(spark, rows)).collect()}
    assert tree == {0: (None, 0), 1: (0, 1), 2: (0, 1), 3: (0, 1), 4: (0, 1), 5: (None, 0)}


def test_announcing_lines_and_forwarded_messages(spark):
    rows = [
        (1, 0, "user", "The plan is to leave at noon.\nOn Monday my friend wrote: nothing new."),
        (1, 1, "assistant", "On Mon, 3 Feb 2025, Ann <ann@x.org> wrote:\n> The plan is to leave at noon.\nI agree."),
        (1, 2, "user", "See below.\n\n-----Original Message-----\nFrom: Ann\nSubject: plan\n\nI agree.\n> The plan is to leave at noon."),
        (1, 3, "user", "On Tue, Bob wrote:\n\n> See below.\nDone."),
        (2, 0, "user", "--- Forwarded message ---\nsaid by nobody"),
    ]
    got = {(r.conv_id, r.turn): r for r in Q.link_quotations(frame(spark, rows)).collect()}
    assert {k: (r.parent_turn, r.root_turn, r.depth) for k, r in got.items()} == {
        (1, 0): (None, 0, 0), (1, 1): (0, 0, 1), (1, 2): (1, 0, 2), (1, 3): (2, 0, 3), (2, 0): (None, 0, 0)
    }
    assert [got[k].text for k in sorted(got)] == [rows[0][3], "I agree.", "See below.", "Done.", ""]


@pytest.mark.parametrize("seed", [1, 2])
def test_planted_trees(spark, seed):
    rng = random.Random(seed)
    rows, want = [], {}
    for conv in range(20):
        said, quoted, parents = [], [], []
        for turn in range(rng.randrange(1, 9)):
            own = [" ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(rng.randrange(12, 30))) + "." for _ in range(rng.randrange(1, 4))]
            parent = rng.choice([None, *range(turn)])
            before = []
            if parent is not None:
                part = textwrap.wrap(rng.choice(said[parent]), rng.choice([40, 72]))
                before = [">" + x if x.startswith(">") else "> " + x for x in [*quoted[parent], *part]]
            said.append(own)
            quoted.append(before)
            parents.append(parent)
            depth = 0 if parent is None else want[conv, parent][1] + 1
            want[conv, turn] = (parent, depth, "\n\n".join(own))
            text = "\n".join([*before, "\n\n".join(own)])
            rows += [(conv, turn, "user", text)] * rng.choice([1, 1, 3])
    rng.shuffle(rows)
    out = Q.link_quotations(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    assert {(r.conv_id, r.turn): (r.parent_turn, r.depth, r.text) for r in out} == want
