import itertools
import random

import pytest

from postloom.llm.lookalike import LOOKS, lookalike_pairs, normalise_texts, one_form, one_form_reported, resolve_token

SAME = [
    ["cafe\u0301 near", "caf\u00e9 near", "c\u0430f\u0435\u0301\u00a0near", "\uff43\uff41\uff46\u00e9 near", "ca\u200bf\u00e9\u2007ne\u00adar"],
    ["\u212bland \u2126 \u212a", "\u00c5land \u03a9 K", "A\u030aland \u03a9 \u041a"],
    ["yours; ok", "yours\u037e ok", "yours\uff1b ok"],
    ["a\r\nb", "a\nb", "a\rb"],
    ["Тожытя", "Tожытя"],
    ["сосо", "coco", "соcо"],
]
DIFFERENT = ["x2", "x\u00b2", "cafe", "caf\u00e9", "Cafe", "cafe.", "cafe!", "cafe ", "ca fe", "cafe\n", "rn", "m", "l", "1", "I", "O", "0", "\u03b1", "a", "\u043a", "k", "\u0437", "3"]


def test_same_look_same_form():
    for group in SAME:
        assert len({one_form(t) for t in group}) == 1, group


def test_other_look_other_form():
    forms = [one_form(t) for t in DIFFERENT]
    assert len(set(forms)) == len(forms)
    for a, b in itertools.combinations(SAME, 2):
        assert one_form(a[0]) != one_form(b[0])


def test_tokens_take_one_script():
    assert resolve_token("Tожытя") == ("Тожытя", True, False)
    assert resolve_token("сос") == ("coc", False, True)
    assert resolve_token("\u039d\u0435xt") == ("Next", True, False)
    assert resolve_token("слово") == ("слово", False, False)
    assert one_form_reported("p\u0430y сосо, plain слово") == ("pay coco, plain слово", 1, 1)


@pytest.mark.parametrize(
    ("a", "b"),
    [("\u2011", "-"), ("\u2010", "-"), ("\u00b5", "\u03bc"), ("\u0475", "v"), ("\u03bd", "v"), ("\u03f2", "c"), ("\u04cf", "l"), ("\u0585", "o"), ("\u13aa", "A"), ("\u2170", "i"), ("\u2167", "VIII"), ("\U0001d400", "A"), ("\U0001d6c2", "\u03b1"), ("\U0001d7ce", "0"), ("\u043a", "\u03ba"), ("\u2019", "\u02bc"), ("\ufb01", "fi"), ("\uff76", "\u30ab"), ("\u0259", "\u04d9"), ("\u00fe", "\u03f8")],
)
def test_signs_of_one_look(a, b):
    assert one_form(a) == one_form(b) == one_form(one_form(a))
    assert one_form(f"x {a} y") == one_form(f"x {b} y")


@pytest.mark.parametrize(("a", "b"), [("2", "\u00b2"), ("2", "\u2082"), ("1", "\u2460"), ("C", "\u2102"), ("A", "\U0001d504"), ("-", "\u2013"), ("'", "\u2019"), ("\u2018", "\u2019"), ("s", "\u017f"), ("...", "\u2026"), ("k", "\u043a"), ("a", "\u03b1"), ("n", "\u043f")])
def test_signs_of_another_look(a, b):
    assert one_form(a) != one_form(b)


def test_form_depends_on_the_look_alone():
    r = random.Random(4)
    plain = "Copper harbour; the index is so cheap.\nAsk Ida: yes? Жа бо. Δα μο ".split(" ")
    for _ in range(500):
        text = " ".join(r.choice(plain) for _ in range(6))
        out = ""
        for c in text:
            looks = [x for x in LOOKS if c in x]
            options = [c] + [x for look in looks for x in look if x != "-"]
            if "!" <= c <= "~":
                options.append(chr(ord(c) + 0xFEE0))
            if c == " ":
                options += ["\u00a0", "\u2007", "\u3000"]
            out += r.choice(options) + ("\u200b" if r.random() < 0.1 else "")
        assert one_form(out) == one_form(text)
        assert one_form(one_form(text)) == one_form(text)


def test_pairs_against_brute_force(spark):
    texts = [t for g in SAME for t in g] + DIFFERENT + [SAME[0][0], SAME[0][1], None, "", " ", "\u200b", "\n"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, form string")
    want = {(i, j) for (i, a), (j, b) in itertools.combinations(enumerate(texts), 2) if a and b and a != b and one_form(a) == one_form(b) and one_form(a).strip()}
    got = [(r.doc_a, r.doc_b) for r in lookalike_pairs(df).collect()]
    assert set(got) == want and len(got) == len(want)


def test_empty_long_and_null(spark):
    df = spark.createDataFrame([(1, None), (2, "\u0430" * 500_000), (3, "")], "doc_id long, text string")
    rows = {r.doc_id: r for r in normalise_texts(df).collect()}
    assert rows[1].form is None and not rows[1].visible and rows[2].form == "a" * 500_000 and not rows[3].visible
    assert normalise_texts(df.limit(0)).count() == lookalike_pairs(df.limit(0)).count() == 0
