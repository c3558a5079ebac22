from collections import Counter

import numpy as np
import pytest

from postloom.llm.personal import KINDS, add_document, find_items, fit, model, replace_items, Graph, _lower_runs
from postloom.llm.personal_training import examples


def found(text):
    return [(text[s:e], k) for s, e, k in model().items([text])[0]]


def test_held_out_accuracy():
    held = examples(600, seed=4711)
    right, wrong, missed = Counter(), Counter(), Counter()
    for (_, items), got in zip(held, model().items([t for t, _ in held])):
        a, b = {(s, k) for s, _, k in items}, {(s, k) for s, _, k in got}
        right.update(k for _, k in a & b)
        wrong.update(k for _, k in b - a)
        missed.update(k for _, k in a - b)
    for kind in set(KINDS.values()):
        assert right[kind] / (right[kind] + wrong[kind]) > 0.98
        assert right[kind] / (right[kind] + missed[kind]) > (0.88 if kind == "name" else 0.97)  # nearly half of the names stand in no list


# Texts no grammar of the repository wrote: {kind:item}.
FOREIGN = """
Please contact {name:Oluwaseun Adeyemi} by Thursday.
The invitation was sent by {name:Élise Moreau} <{email:elise.moreau@univ-paris.example}>.
From: {name:Dmitri Volkov} <{email:d.volkov@nauka.example}>
Ask {name:Nguyen Van Thieu} whether the ferry runs.
Dr. {name:Mei Zhang} gave the keynote in Oslo.
Dear {name:Gustavo Petro}, we thank you for the parcel.
Cc: {name:Иван Петров} <{email:petrov@spb.example}>
According to {name:Fatima Al-Rashid}, the shop closes at five.
I spoke with Mr {name:Kwabena Mensah} about the lease.
{name:Søren Kierkegård} wrote:
> thanks
Contact: {name:Hiroshi Tanaka}, tel. {phone:+81-3-5555-0123}
{name:Ngozi Okonkwo} ({email:ngozi@lagos.example}) keeps the books.
Call our Paris office on {phone:+33 1 42 68 53 00} tomorrow.
Berlin: tel {phone:030 / 1234567}, mornings only.
Fax {phone:01 42 68 53 00} is out of paper.
Phone {phone:(0221) 987654} if you are late.
Try {phone:+7 495 123-45-67} first.
Our bank account is DE89 3704 0044 0532 0130 00 as always.
{name:John Smith} and {name:Maria Gonzalez} are on leave.
{name:J. Q. Smith} signed it.
{name:SMITH, JOHN} is on the list twice.
we met {name:thomas miller} at the pier.
Mrs. {name:Wanjiru Kamau} sends her regards.
Quoting {name:Ludwig van Beethoven}:
> ta ta ta
signed, {name:Yevgenia Sokolova}
The ticket was issued to {name:Anna Nowak}, {address:12 Garden Street, Leeds}.
My SSN is {id_number:078-05-1120}, do not tell.
Passport {id_number:X1234567} was found.
-- 
{name:Chidi Eze}
{email:chidi.eze@abuja.example}
The Red Lantern serves noodles. Golden Gate is a bridge. Part no. 078-05-1121 is here.
Central Park Opens In Spring. New York and Los Angeles voted.
""".strip()


def test_texts_of_another_hand():
    import re

    parts, items, text = re.split(r"\{(name|email|phone|id_number|address):([^}]*)\}", FOREIGN), [], ""
    for i, p in enumerate(parts):
        if i % 3 == 1:
            continue
        if i % 3 == 2:
            items.append((len(text), parts[i - 1]))
        text += p
    # Each line by itself, so that no mention helps another; the last signature stays together.
    got, want = {(s, k) for s, _, k in model().items([text])[0]}, set(items)
    assert len(got & want) / len(want) >= 0.9, sorted(want - got)
    assert len(got & want) / len(got) >= 0.9, sorted(got - want)


def test_messages_travel_until_they_settle():
    """The first of a hundred doubtful mentions hears from a clear one at the far end."""
    m = model()

    def first(tail):
        g = Graph()
        add_document(g, m.feats, 0, "Stone Tarnik. " * 100 + tail)
        return 1 - m.marginals(g)[0, 0]

    clear = "Dear Mr Stone Tarnik, Contact: Stone Tarnik <stone.tarnik@a.example> wrote. " * 3
    assert abs(first(clear) - first("")) > 0
    g = Graph()
    add_document(g, m.feats, 0, "Stone Tarnik. " * 100 + clear)
    settled = m.marginals(g)
    import postloom.llm.personal as personal

    personal.SETTLED, kept = 1e-6, personal.SETTLED
    try:
        assert np.abs(m.marginals(g) - settled).max() < 0.02
    finally:
        personal.SETTLED = kept


@pytest.mark.parametrize("line", ["Ask Hugo Merrowin at hugo@a.example or 555-123-4567, http://x.example/a.\n", "> Stone Tarnik has 12 of 3456789 bytes here.\n", "a.b@c.example\n", "hugo merrowin "])
def test_time_grows_with_the_length(line):
    import time

    def took(n):
        began = time.perf_counter()
        add_document(Graph(), model().feats, 0, line * n)
        return time.perf_counter() - began

    took(500)
    assert min(took(8000) for _ in range(2)) < 12 * min(took(2000) for _ in range(3)) + 0.2


@pytest.mark.parametrize(
    ("text", "items"),
    [
        ("Ask Hugo\n> Merrowin about it, or Trellman, Joan.", [("Hugo\n> Merrowin", "name"), ("Trellman, Joan", "name")]),
        ("Best,\nMartin", []),
        ("Cheers,\nMartin\n\nMartin Kelderman", [("Martin Kelderman", "name")]),
        ("Ring me ((292) 555-0143) or (555-0100).", [("(292) 555-0143", "phone"), ("555-0100", "phone")]),
        ("Part no. 387-32-2921 is out of stock, take 283-9043 instead.", []),
        ("They printed my social security number, 666-26-2452, on the badge!", [("666-26-2452", "id_number")]),
        ("Write to j.merrow at cs dot hill dot example when down.", [("j.merrow at cs dot hill dot example", "email")]),
        ("In message <3e7cc1382.index@hill.example> you write:", []),
        ("I moved to Flat 27, 98 Mill Terrace, Ardmere in May.", [("Flat 27, 98 Mill Terrace, Ardmere", "address")]),
        ("Copper Gate and Paper Mint merged in 1990, port 139.", []),
        ("Kelderman Institute of Computing", []),
    ],
)
def test_examples(text, items):
    assert found(text) == items


def test_recurring_tokens_are_linked():
    g = Graph()
    add_document(g, model().feats, 0, "Ask Hugo Merrowin. M. Merrowin agrees with Hugo Merrowni.")
    assert {kind for *_, kind in g.edges} >= {0, 2, 3}


def test_distant_mentions_inform_one_another():
    """A doubtful mention gets likelier to be a name when clear mentions of the same word stand elsewhere."""
    m = model()

    def chance(text, word):
        g = Graph()
        add_document(g, m.feats, 0, text)
        return 1 - m.marginals(g)[g.names.index(word), 0]

    doubtful = "They say that Tarnik Gate opens it. "
    assert chance(doubtful + "Contact Tarnik Gate before Friday. Dear Tarnik Gate, go.", "tarnik") > chance(doubtful, "tarnik")


def test_fit_is_repeatable():
    a, b = fit(examples(50)), fit(examples(50))
    assert (a.nodes == b.nodes).all() and (a.pairs == b.pairs).all()


def test_frames_and_corner_cases(spark):
    long = "plain words here. " * 30_000 + "Ask Hugo Merrowin. " * 3000
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "mail a.b@c.example", "x"), (3, "mail a.b@c.example", "x"), (4, long, "x")], "pos long, body string, kind string")
    rows = find_items(df).collect()
    assert sorted((r.pos, r.kind, r.start_at) for r in rows if r.pos == 3) == [(3, "email", 6)] * 2
    assert sum(r.pos == 4 for r in rows) == 3000
    clean = {r.pos: r.clean_text for r in replace_items(df).collect()}
    assert clean[1] is None and clean[2] == "" and clean[3] == "mail [EMAIL]" and "Merrowin" not in clean[4]
    assert find_items(df.limit(0)).count() == 0


def test_stretches_of_a_batch(monkeypatch):
    import postloom.llm.personal as personal

    monkeypatch.setattr(personal, "BATCH", 3)
    monkeypatch.setattr(personal, "BATCH_CHARS", 10)
    texts = [None, "ab", "x" * 50, "", "abc", "abcd", "abcdefgh", None, None, None, None]
    assert [x for a, b in personal._parts(texts) for x in range(a, b)] == list(range(len(texts)))
    assert all(b - a <= 3 and (b - a == 1 or sum(len(t or "") for t in texts[a:b]) <= 10) for a, b in personal._parts(texts))
    assert list(personal._parts([])) == []


def test_small_letter_names_are_taken_whole():
    word = "hallwick" * 12
    for gap in (" ", "\n" + "> " * 40):
        text = f"we met gregory{gap}{word} there"
        assert _lower_runs(text, 7, 14) == [(f"gregory{gap}{word}", 7)]
        text = f"we met {word},{gap}gregory"
        start = len(text) - 7
        assert _lower_runs(text, start, len(text)) == [(text[7:], 7)]
    assert _lower_runs("a@hallwick, gregory", 12, 19) == []
    assert _lower_runs("\n> > hallwick,\n> > gregory.", 19, 26) == [("hallwick,\n> > gregory", 5)]
